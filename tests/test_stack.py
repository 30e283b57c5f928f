import duckdb

from strataframe.suite.flagship import FLAGSHIP_ORACLE, flagship

SF = "/root/testdata/sf0.001"


def test_flagship_matches_plain_table(spark):
    got = sorted((r["siteID"], r["o_orderstatus"], r["mean_price"], r["n_orders"]) for r in flagship(spark, SF).collect())
    con = duckdb.connect()
    for t in ("orders", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = sorted(tuple(r) for r in con.execute(FLAGSHIP_ORACLE).fetchall())
    assert got == want


def test_registry_contract():
    import __spark_entry__ as E

    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60
