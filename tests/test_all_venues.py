"""The bronze queries over every venue land and return all events."""

import pytest

from tests.paths import SF01
from tests.oracle_compare import compare
from tickwave.plans.registry import QUERIES, load_all
from tickwave.plans.standins import table

NAMES = ["bronze_roundtrip_trades", "bronze_roundtrip_klines", "tolerant_scan", "ingest_health", "streaming_bars",
         "bronze_coverage", "trade_pages_normalised"]


@pytest.mark.parametrize("name", NAMES)
def test_every_venue(spark, name):
    r = compare(spark, name, SF01)
    assert r["status"] == "ok" and r["spark_rows"] > 0, r


def test_all_events_are_landed(spark):
    load_all()
    n = table(spark, SF01, "events").count()
    assert sum(r["records"] for r in QUERIES["ingest_health"](spark, SF01).collect()) == n
    assert QUERIES["bronze_roundtrip_trades"](spark, SF01).count() == n
