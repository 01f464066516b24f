"""The word before is the context: words with one ending are told apart."""

import random

from tickwave.llm import pitman_yor as Y


def test_word_contexts_beat_the_base(spark):
    r = random.Random(3)
    rows = [(i, " ".join(f"head{x}zz tail{x}" for x in r.choices(range(40), k=60))) for i in range(120)]
    got = [x for x in Y.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect() if x.held_out]
    assert got and sum(x.score for x in got) > 0.75 * sum(x.base_score for x in got)  # both negative
