"""Links at other thresholds than op9's, on pairs just above the threshold."""

import pytest

from tickwave.llm import near_duplicates as N


def pairs(percent, n):
    """Texts 2i and 2i + 1 share just enough of their one-word shingles."""
    rows = []
    for i in range(n):
        shared = 2 * percent + 1  # of 200 in the union
        rest = 200 - shared
        words = [f"p{i}w{j}" for j in range(shared)]
        rows += [(2 * i, " ".join(words + [f"p{i}a{j}" for j in range(rest // 2)])),
                 (2 * i + 1, " ".join(words + [f"p{i}b{j}" for j in range(rest - rest // 2)]))]
    return rows


@pytest.mark.parametrize("percent", [70, 80])
def test_no_link_is_lost(spark, percent):
    rows = pairs(percent, 150)
    sets = {i: set(t.split()) for i, t in rows}
    want = {i + 1 for i in range(0, len(rows), 2) if 100 * len(sets[i] & sets[i + 1]) >= percent * len(sets[i] | sets[i + 1])}
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=1, percent=percent).collect()
    assert len(want) == 150 and {r.doc_id for r in got if not r.kept} == want


def test_limits_follow_from_percent():
    assert [N.band_rows(N.BINS, p) for p in (85, 80, 75, 70)] == [6, 4, 4, 3]
    assert N.bit_limit(N.BINS, 70) > N.bit_limit(N.BINS, 80) > N.bit_limit(N.BINS, 85) >= 63
