"""The driver contract: entry() runs, every query has an oracle, names line up."""

import duckdb

import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"month", "Category", "n_txn", "total_dr", "total_cr"}


def test_every_query_has_oracle():
    from tallyspark.plans import catalog

    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_flagship_matches_oracle_on_smallest_tables(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{sf}/lineitem.parquet')")
    for name in ("E3_monthly_category", "C_category_resolution", "P_rejects"):
        df = E.queries()[name](spark, sf)
        got = sorted(tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())
        rel = con.sql(E.oracle_sql()[name])
        cols = rel.columns
        idx = sorted(range(len(cols)), key=lambda i: cols[i])
        want = sorted(tuple(str(r[i]) for i in idx) for r in rel.fetchall())
        assert got == want, name


def test_entry_goes_on_without_a_library_of_the_optional_part():
    import os
    import subprocess
    import sys
    code = ("import sys, warnings; sys.modules['xxhash'] = None; warnings.simplefilter('ignore'); import __spark_entry__ as E; "
            "from tallyspark.plans import catalog; assert set(E.queries()) == set(catalog.QUERIES) and set(E.oracle_sql()) == set(catalog.ORACLE)")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(E.__file__))
