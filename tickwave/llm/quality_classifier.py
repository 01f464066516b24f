"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of all texts are computed once and stored (a few hundred bytes a
document).  The trees are fitted on a bounded, hash-chosen sample of labelled
rows (``sample`` rows of 19 numbers) and flattened into arrays; every task
walks all its rows through a tree at once, one level at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwave.llm import words as W
from tickwave.llm.doc_statistics import SHARES, SLICE_BYTES, describe_texts, document_statistics, labelled_ids, labelled_sample
from tickwave.session import materialize

#: At most about this many labelled documents are fitted on.
SAMPLE = 40_000
#: A document is predicted good from this score on.
THRESHOLD = 0.7


@dataclass
class Trees:
    """All trees end to end.  Node i tests ``x[feature[i]] <= split[i]`` and goes
    to ``left[i]`` or ``left[i] + 1``; a leaf has feature -1 and ``value``."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    value: np.ndarray
    root: np.ndarray
    start: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.start)
        row = np.arange(len(x))
        for at in self.root:
            node = np.full(len(x), at)
            for _ in range(self.depth):
                f = self.feature[node]
                go_right = x[row, np.maximum(f, 0)] > self.split[node]
                node = np.where(f < 0, node, self.left[node] + go_right)
            z += self.value[node]
        return 1 / (1 + np.exp(-z))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64,
              rate: float = 0.15, least_weight: float = 5.0, ridge: float = 1.0) -> Trees:
    """Newton boosting of the log loss; splits are searched in per-feature
    histograms over quantile bins.  One class only (or no rows) gives a model
    of no trees whose score is the label share (0.5 without rows)."""
    share = float(y.mean()) if len(y) else 0.5
    share = min(max(share, 1e-3), 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        empty = np.zeros(0, np.int64)
        return Trees(empty, np.zeros(0), empty, np.zeros(0), empty, start, 0)
    n_features = x.shape[1]
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(n_features)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(n_features)], 1)
    feature, split, left, value, root = [], [], [], [], []

    def add() -> int:
        feature.append(-1), split.append(0.0), left.append(0), value.append(0.0)
        return len(feature) - 1

    z = np.full(len(y), start)
    offset = np.arange(n_features) * bins
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, w = y - p, p * (1 - p)
        root.append(add())
        level = [(root[-1], np.arange(len(y)))]
        for d in range(depth + 1):
            following = []
            for node, rows in level:
                sg, sw = g[rows].sum(), w[rows].sum()
                value[node] = rate * sg / (sw + ridge)
                if d < depth:
                    flat = (binned[rows] + offset).ravel()
                    hist = lambda v: np.bincount(flat, np.repeat(v, n_features), n_features * bins)
                    cg, cw = (hist(v[rows]).reshape(n_features, bins).cumsum(1) for v in (g, w))
                    gain = cg ** 2 / (cw + ridge) + (sg - cg) ** 2 / (sw - cw + ridge) - sg ** 2 / (sw + ridge)
                    gain[(cw < least_weight) | (sw - cw < least_weight)] = -1
                    f, b = divmod(int(gain.argmax()), bins)
                    if gain[f, b] > 1e-6 and b < len(edges[f]):
                        goes = binned[rows, f] > b
                        feature[node], split[node] = f, edges[f][b]
                        left[node] = add()
                        following += [(left[node], rows[~goes]), (add(), rows[goes])]
                        continue
                z[rows] += value[node]
            level = following
    return Trees(*map(np.array, (feature, split, left, value, root)), start, depth)


def score_statistics(stats: DataFrame, model: Trees) -> DataFrame:
    def run(batches):
        for b in batches:
            x = np.stack([b.column(c).to_numpy() for c in SHARES], 1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    return stats.select("doc_id", *SHARES).mapInArrow(W.trimmed(run), "doc_id long, score double")


def held_out(divisor: int, remainder: int):
    """True for documents set aside: crc32 of doc_id as text, modulo divisor."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor == remainder, F.lit(False))


def train(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    return fit_trees(*labelled_sample(stats.filter(~held_out(4, 2)), labels, "quality", sample))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Fitted on labelled rows that are not held out (crc32(doc_id) mod 4 is not
    2).  Null and empty texts are scored like any other, from zero statistics.
    Repeated rows give a row each; a null doc_id is scored but never learnt
    from.  Without usable labels every score is 0.5.  Only doc_id and text of
    ``docs`` and doc_id and quality of ``labels`` are read, whatever other
    columns exist.  An empty table gives an empty result.
    """
    stats = materialize(document_statistics(docs), "statistics")
    scored = score_statistics(stats, train(stats, labels, sample))
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, all columns.

    Rows are judged by their own text (a null one is empty), so repeated rows and
    null doc_ids are rows like any other; columns of any name come back as they
    were, and an empty table gives an empty result.  Statistics for training are computed for the sampled labelled documents
    only; then one pass scores and filters every row where it lies."""
    known = labels.filter(~held_out(4, 2))
    some = docs.join(F.broadcast(labelled_ids(known, "quality", sample).select("doc_id")), "doc_id", "left_semi")
    model = fit_trees(*labelled_sample(document_statistics(some), known, "quality", sample))
    place = docs.columns.index("text")

    def run(batches):
        for b in batches:
            texts = b.column(place)
            for lo, hi in W.slices(texts, SLICE_BYTES):
                s = describe_texts(texts.slice(lo, hi - lo))
                score = model.score(np.stack([s[c] for c in SHARES], 1).astype(np.float64))
                yield b.slice(lo, hi - lo).filter(pa.array(score >= threshold))

    return docs.mapInArrow(W.trimmed(run), docs.schema)
