

from . import catalog, fields, listings, releases, scrape  # noqa: F401
