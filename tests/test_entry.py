import importlib

import duckdb

SF = "/root/testdata/sf0.001"
CHEAP = ["scan_zones", "geocode_lookup", "pickup_date", "join_dropoff_zone", "station_rows",
         "nearest_station_join", "upsert_table", "extract_links", "html_rows", "forward_selection"]


def test_entry_runs(spark):
    E = importlib.import_module("__spark_entry__")
    df = E.entry(spark)
    assert df.count() > 0
    assert "distance_km" in df.columns and "station" in df.columns


def test_every_query_has_an_oracle():
    E = importlib.import_module("__spark_entry__")
    sql = E.oracle_sql()
    assert set(sql) <= set(E.queries())
    assert set(E._reference_queries()) <= set(sql)


def test_cheap_queries_match_duckdb(spark):
    E = importlib.import_module("__spark_entry__")
    qs, sql = E.queries(), E.oracle_sql()
    con = duckdb.connect()
    for t in ("region nation customer orders events pages").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for k in CHEAP:
        sdf = qs[k](spark, SF)
        cols = sorted(sdf.columns)
        s_rows = sorted(tuple(str(r[c]) for c in cols) for r in sdf.collect())
        cur = con.execute(sql[k])
        names = [d[0] for d in cur.description]
        assert sorted(names) == cols, k
        d_rows = sorted(tuple(str(r[names.index(c)]) for c in cols) for r in cur.fetchall())
        assert s_rows == d_rows, k
