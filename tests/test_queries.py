import duckdb
import pytest

from klangwerk.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(registry.ORACLES[name]).df()
    got = registry.QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    key = lambda f: sorted(tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in f[sorted(f.columns)].itertuples(index=False))
    assert key(got) == key(want)
