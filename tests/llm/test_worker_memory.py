"""What tasks of the operators take and leave in a Python worker process."""

import random
import tracemalloc

import pyarrow as pa

from tickwave.llm import doc_statistics as D
from tickwave.llm import near_duplicates as N
from tickwave.llm import pieces as P
from tickwave.llm import token_counts as C
from tickwave.llm import token_records as T
from tickwave.llm import words as W
from tickwave.llm.queries import tokenizer_path


def peak_mb(run) -> float:
    run()  # tables of powers and the like are made once
    W.give_back()
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_sketches_and_comparisons_stay_small():
    rng = random.Random(3)
    texts = pa.array([" ".join("w%d" % rng.randrange(90_000) for _ in range(300)) for _ in range(2000)])
    ids = pa.array(range(2000))
    one = pa.RecordBatch.from_arrays([ids, texts], names=["doc_id", "text"])
    two = pa.RecordBatch.from_arrays([ids, ids, texts, texts.take(pa.array(range(1999, -1, -1)))], names=["a", "b", "ta", "tb"])

    def use(batches):
        return sum(b.num_rows for b in batches)

    assert use(N._describe(5, 192, 6)([one])) == 2000
    assert peak_mb(lambda: use(N._describe(5, 192, 6)([one]))) < 60
    assert peak_mb(lambda: use(N._confirm(5, 85)([two]))) < 60


def test_a_worker_that_turns_to_other_work_drops_what_the_last_one_kept():
    path = tokenizer_path()
    for made, name in ((T.encoder, "encoder"), (C.merger, "merger")):
        made(path)
        assert list(W.trimmed(iter, name)([1, 2])) == [1, 2]
        assert made.cache_info().currsize == 1
        assert list(W.trimmed(iter)([3])) == [3]
        assert made.cache_info().currsize == 0


def test_statistics_stay_small():
    rng = random.Random(4)
    texts = pa.array([" ".join("w%d" % rng.randrange(90_000) for _ in range(300)) for _ in range(2000)])
    one = pa.RecordBatch.from_arrays([pa.array(range(2000)), texts], names=["doc_id", "text"])
    assert sum(b.num_rows for b in D._run([one])) == 2000
    assert peak_mb(lambda: sum(b.num_rows for b in D._run([one]))) < 60


def test_what_an_encoder_keeps_stays_small():
    texts = pa.array([" ".join("w%d" % j for j in range(i, i + 400)) for i in range(0, 360_000, 400)])
    tracemalloc.start()
    try:
        enc = T.Encoder(tokenizer_path())
        for lo, hi in W.slices(texts, 256 << 10):
            enc.encode(W.texts_of(texts.slice(lo, hi - lo)))
        assert tracemalloc.get_traced_memory()[0] / 1e6 < 40
    finally:
        tracemalloc.stop()


def test_units_that_share_rows_keep_their_own_ids():
    rng = random.Random(5)
    words = ["w%d" % i for i in range(500)] + ["x" * 23, "x" * 24, "x" * 40, "a\0", "a", "a\0\0", "\u6f22" * 7, "\U0001f642" * 6, "0123456789" * 2]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(200)] + ["", None]
    enc = T.Encoder(tokenizer_path())
    want = [b"".join(enc._plain([x or ""])) + enc.end for x in texts]
    for size in (1, 7, 97):
        enc.units = P.Table(size, enc.kind)
        for _ in range(2):
            got = [x for i in range(0, len(texts), 10) for x in enc.encode(W.texts_of(pa.array(texts[i:i + 10], pa.string())))]
            assert got == want
