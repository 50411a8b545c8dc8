"""Every registered query with SQL agrees with an independent engine on the small tables."""

import duckdb
import pandas as pd
import pytest

from tenement.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df: pd.DataFrame) -> list:
    def text(v):
        if not isinstance(v, (list, dict)) and pd.isna(v):
            return "None"
        if isinstance(v, bool) or type(v).__name__ == "bool_":
            return str(bool(v))
        try:
            return f"{float(v):.6g}" if not isinstance(v, str) else v
        except (TypeError, ValueError):
            return str(pd.Timestamp(v))
    return sorted(tuple(text(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = rows(catalog.QUERIES[name](spark, SF).toPandas()), rows(con.execute(catalog.ORACLE[name]).df())
    assert got == want


DEALS = {  # history as day:status -> status, deal day, days
    "basic": ("1:0 2:0 3:0 4:2", (2, 4, 4)), "double": ("1:0 2:2 3:0 4:2", (2, 4, 2)), "fast": ("4:2", (2, 4, 1)),
    "cont": ("1:0 2:2 3:1 4:0 5:2 6:2 7:2", (2, 5, 3)), "gone": ("1:0 2:0 3:0 4:2 5:1 6:1 7:1 8:1", (2, 4, 4)),
    "holes": ("1:0 2:0 3:1 4:1 5:1 6:2", (2, 6, 6)), "closed": ("1:0 2:0 3:1 4:1 5:0 6:1", (1, None, None)),
    "gap": ("1:0 2:0 3:2 10:0 11:1", (1, None, None)), "gap_deal": ("1:0 2:0 3:2 10:0 11:1 12:2", (2, 12, 3)),
    "all_deal": ("1:2 2:2 3:2", (2, None, None)), "deal_first": ("1:2 2:1", (1, None, None)),
}


def test_deal_inference(spark):
    from tenement.operators.history import infer_deal

    data = [(k, f"2018-08-{int(p.split(':')[0]):02d}", int(p.split(":")[1])) for k, (h, _) in DEALS.items() for p in h.split()]
    hist = spark.createDataFrame(data, "id string, day string, status int").selectExpr("id", "cast(day as date) as day", "status")
    got = {r.id: (r.deal_status, r.deal_day.day if r.deal_day else None, r.n_day_deal) for r in infer_deal(hist, "id", "day", "status").collect()}
    assert got == {k: want for k, (_, want) in DEALS.items()}
