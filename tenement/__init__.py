"""PySpark-native analytics for rental-listing open data."""
