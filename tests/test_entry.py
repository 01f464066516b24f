import re

import pytest

from tests.paths import SF01


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert df.columns == ["start_local", "end_local", "minutes", "hours", "mean_spread_pct",
                          "max_spread_pct", "area_pct_minutes"]


def test_registry_consistent():
    import __spark_entry__ as e
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q)
    own = {n for n in q if not re.match(r"op\d+_|pipeline$", n)}
    assert own <= set(o)


def _names():
    import __spark_entry__ as e
    return sorted(e.queries())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, name):
    from tests.oracle_compare import compare
    r = compare(spark, name, SF01)
    assert r["status"] in ("ok", "no-oracle"), r
    assert r["spark_rows"] > 0
