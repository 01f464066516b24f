"""Language identification by hierarchical discrimination.

A document's features are hashed byte n-grams of its lower-cased letters (1 to
3 bytes, words apart), counted over the whole text, damped by a logarithm and
scaled to length 1.  A first layer of one-versus-one linear support vector
machines picks the language family; within the family another layer separates
its languages.  The machines are fitted on a bounded, hash-chosen sample of
``SAMPLE`` documents a language; prediction is one pass over the texts with a
weight matrix of fixed size, and nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwave.llm import words as W
from tickwave.llm.doc_statistics import sample_cells
from tickwave.llm.quality_classifier import held_out

#: At most about this many documents a language are learned from.
SAMPLE = 1500
FEATURES = 4096
GRAMS = 3
UNKNOWN = "und"
#: Families by language code; a language not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nl no nb nn sv yi",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "indic": "bn gu hi mr ne pa ur",
    "turkic": "az kk ky tr uz",
    "baltic": "lt lv",
    "semitic": "ar he mt",
    "celtic": "cy ga gd",
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(lang: str) -> str:
    return FAMILY.get(lang.lower().split("-")[0].split("_")[0], lang)


#: Bytes that take part: ASCII letters and everything beyond ASCII.
_KEEP = np.zeros(256, bool)
_KEEP[97:123] = True
_KEEP[65:91] = True
_KEEP[128:] = True


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of the non-zero entries, rows of length 1."""
    t = W.texts_of(texts)
    n = len(t)
    keep = _KEEP[t.data]
    x = W.FOLD[t.data].astype(np.uint32)
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(t.offset))
    x[~keep] = 32
    # a word edge is a run of other bytes: keep its first byte only
    stay = keep.copy()
    stay[1:] |= keep[:-1]
    if len(stay):
        starts = t.offset[:-1][np.diff(t.offset) > 0]
        stay[starts] = True
    x, doc = x[stay], doc[stay]
    counts = np.zeros(n * FEATURES)
    code = np.zeros(len(x), np.uint32)
    for g in range(GRAMS):
        m = len(x) - g
        if m <= 0:
            break
        code = code[:m] * np.uint32(256) + x[g:] + np.uint32(1)
        ok = doc[:m] == doc[g:]
        h = (W.mix(code[ok].astype(np.uint64) + np.uint64(g << 40)) >> np.uint64(40)) % np.uint64(FEATURES)
        counts += np.bincount(doc[:m][ok] * FEATURES + h.astype(np.int64), minlength=n * FEATURES)
    at = np.flatnonzero(counts)
    value = 1 + np.log(counts[at])
    row = at // FEATURES
    norm = np.sqrt(np.bincount(row, value * value, minlength=n))
    return row, at % FEATURES, value / norm[row]


@dataclass
class Layer:
    """One-versus-one machines: classes, the pairs, and a weight row a pair."""

    classes: list[str]
    pairs: list[tuple[int, int]]
    weight: np.ndarray
    bias: np.ndarray

    def predict(self, row: np.ndarray, col: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Winning class and confidence: the smallest logistic of its margins."""
        if len(self.classes) == 1:
            return np.zeros(n, np.int64), np.ones(n)
        margin = np.stack([np.bincount(row, value * w[col], minlength=n) for w in self.weight], 1) + self.bias
        votes = np.zeros((n, len(self.classes)))
        for k, (a, b) in enumerate(self.pairs):
            votes[:, a] += (margin[:, k] > 0) + 1e-3 * np.tanh(margin[:, k])
            votes[:, b] += (margin[:, k] <= 0) - 1e-3 * np.tanh(margin[:, k])
        best = votes.argmax(1)
        sure = np.ones(n)
        for k, (a, b) in enumerate(self.pairs):
            p = 1 / (1 + np.exp(-4 * margin[:, k]))
            sure = np.where(best == a, np.minimum(sure, p), np.where(best == b, np.minimum(sure, 1 - p), sure))
        return best, sure


def fit_layer(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[str], rounds: int = 12, c: float = 1.0) -> Layer:
    """Linear support vector machines by dual coordinate descent (hinge loss)."""
    classes = sorted(set(labels))
    y = np.array([classes.index(v) for v in labels])
    pairs = list(combinations(range(len(classes)), 2))
    weight, bias = np.zeros((len(pairs), FEATURES)), np.zeros(len(pairs))
    rng = np.random.default_rng(7)
    for k, (a, b) in enumerate(pairs):
        idx = np.flatnonzero((y == a) | (y == b))
        alpha = np.zeros(len(y))
        w, w0 = np.zeros(FEATURES), 0.0
        for _ in range(rounds):
            moved = 0.0
            for i in rng.permutation(idx):
                col, v = rows[i]
                s = 1.0 if y[i] == a else -1.0
                grad = s * (w[col] @ v + w0) - 1
                new = min(max(alpha[i] - grad / (v @ v + 1.0), 0.0), c)
                step = (new - alpha[i]) * s
                if step:
                    w[col] += step * v
                    w0 += step
                    alpha[i] = new
                    moved += abs(step)
            if moved < 1e-3 * len(idx):
                break
        weight[k], bias[k] = w, w0
    return Layer(classes, pairs, weight, bias)


@dataclass
class Hierarchy:
    families: Layer
    languages: list[Layer]

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        n = len(texts)
        row, col, value = features(texts)
        family, sure = self.families.predict(row, col, value, n)
        out = np.empty(n, object)
        score = np.zeros(n)
        for f, layer in enumerate(self.languages):
            mine = family == f
            if mine.any():
                at = mine[row]
                place = np.cumsum(mine) - 1
                best, p = layer.predict(place[row[at]], col[at], value[at], int(mine.sum()))
                out[mine] = [layer.classes[i] for i in best]
                score[mine] = p * sure[mine]
        return list(out), score


def learn(docs: DataFrame, sample: int = SAMPLE) -> Hierarchy | None:
    """Fit on texts and languages of documents whose crc32(doc_id) mod 5 is not 0."""
    known = docs.filter(~held_out(5, 0) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull()
                        & F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    labelled = docs.filter(~held_out(5, 0) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
    n = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # one row a language
    if not n:
        return None
    share = F.create_map(*(x for k, v in n.items() for x in (F.lit(k), F.lit(sample_cells(sample, v)))))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share[F.col("lang")])
    # one row a doc_id, so that a repeated one is not collected whole
    chosen = chosen.groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("x")).select("doc_id", "x.lang", "x.text")

    def run(batches):
        for b in batches:
            for lo, hi in W.slices(b.column(2)):
                row, col, value = features(b.column(2).slice(lo, hi - lo))
                cut = np.searchsorted(row, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo),
                    pa.array([col[i:j].astype(np.uint16).tobytes() for i, j in zip(cut, cut[1:])], pa.binary()),
                    pa.array([value[i:j].astype(np.float32).tobytes() for i, j in zip(cut, cut[1:])], pa.binary())],
                    names=["doc_id", "lang", "col", "value"])

    got = sorted(chosen.mapInArrow(run, "doc_id long, lang string, col binary, value binary").collect(), key=lambda r: (r.doc_id, r.lang, bytes(r.col), bytes(r.value)))
    if not got:
        return None
    rows = [(np.frombuffer(r.col, np.uint16).astype(np.int64), np.frombuffer(r.value, np.float32).astype(np.float64)) for r in got]
    langs = [r.lang for r in got]
    families = [family_of(v) for v in langs]
    top = fit_layer(rows, families)
    under = []
    for f in top.classes:
        at = [i for i, v in enumerate(families) if v == f]
        under.append(fit_layer([rows[i] for i in at], [langs[i] for i in at]))
    return Hierarchy(top, under)


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``.

    Learned from text and non-null lang of documents that are not held out
    (crc32(doc_id) mod 5 is not 0).  A text that is null or has no letter is
    ``und`` with score 0, and so is everything if nothing can be learned.
    Repeated rows give a row each; a null doc_id is predicted but not learned
    from.  An empty table gives an empty result; other columns are ignored.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = learn(d, sample)

    def run(batches):
        for b in batches:
            ids, texts, letters = b.column(0), b.column(1), b.column(2).to_numpy(zero_copy_only=False)
            for lo, hi in W.slices(texts):
                if model is None:
                    lang, score = [UNKNOWN] * (hi - lo), np.zeros(hi - lo)
                else:
                    lang, score = model.predict(texts.slice(lo, hi - lo))
                has = letters[lo:hi].astype(bool)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(lo, hi - lo), pa.array([v if ok else UNKNOWN for v, ok in zip(lang, has)], pa.string()),
                    pa.array(np.where(has, score, 0.0))], names=["doc_id", "lang_pred", "score"])

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    out = d.select("doc_id", "text", letter.alias("letter")).mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score")
