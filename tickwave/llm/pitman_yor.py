"""Language-model scoring with a hierarchical Pitman-Yor model.

Words are the dishes.  The base is uniform over the training words and one
unseen word; a root restaurant draws from it; one restaurant for each context
draws from the root, so all contexts share one parent.  A context is the word
before (letters A-Z lower-cased), or the start of a text; a context without
customers gives the root's probabilities.  Seating is sampled by Gibbs sweeps:
for every (context, word) the customers are reseated one after the other, each
opening a new table with the Chinese-restaurant probability given all other
counts, and every table sends one customer to the root, whose dishes are
reseated likewise.  After ``BURN_IN`` sweeps the predictive probabilities are
averaged over ``SAMPLES`` states; they give the log10 probability and
perplexity of a text.

Scale: a block is the tokens of some megabytes of text.  It sends its distinct
words once to the dictionary, which is dealt over parts by the words' hash and
answers each with a number (small for frequent words) and a training count;
after that only numbers travel, sorted and as differences.  The block then sends
each distinct (context, word) once, with its count, to the context's shard.  A
context of more than ``HOT`` training tokens is spread over several shards by
its words.  So the totals of nearly all contexts stay in their shard; what
shards share are tables of words and totals of spread contexts, which go to a
part by the key's hash, where they are added up and the root's dishes are
reseated.  Blocks, asks and shard states are tables bucketed by the key that
they are grouped by: a sweep reads its state where it lies and shuffles only
totals.  Arrays are stored as compressed byte planes; two numbers a sweep reach
the driver.  A lost executor's work is read again from the stored tables.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwave.llm import files
from tickwave.llm import words as W
from tickwave.llm.quality_classifier import held_out
from tickwave.session import materialize, scratch_path

#: The dictionary and the totals are dealt over a part for each so many shards,
#: and over a few at least.
SHARDS_A_PART, PARTS = 4, 12
#: Number of the context at the start of a text; words have numbers above it.
START = 0
BURN_IN, SAMPLES = 3, 3
DISCOUNT = (0.5, 0.75)
STRENGTH = (10.0, 10.0)
BLOCK_BYTES = 16 << 20
#: A shard holds the contexts of about so much text.
SHARD_BYTES = 16 << 20
#: A context is spread over one shard more for each so many training tokens.
HOT = 1 << 16
#: Log10 probabilities travel as whole multiples of this.
STEP = 2.0 ** -14
#: Customers seated one by one; later ones in blocks growing by this share,
#: inside which the chance of a new table is held fixed.
ONE_BY_ONE, GROWTH = 32, 0.1
END = np.uint64(0x5EED0FE17D)
SEED = 11


def pack(a: np.ndarray) -> bytes:
    """Whole numbers from 0 up in as few bytes as the largest needs, as
    compressed byte planes after a byte that holds the width."""
    top = int(a.max()) if len(a) else 0
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(k).max)
    a = np.ascontiguousarray(a.astype(kind))
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T
    return bytes([a.itemsize]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(b: bytes, kind=np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), np.uint8).reshape(b[0], -1)
    return planes.T.copy().view(f"u{b[0]}").reshape(-1).astype(kind)


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=a.dtype.type(0)))


def unpack_sorted(b: bytes, kind=np.int64) -> np.ndarray:
    return np.cumsum(unpack(b, kind), dtype=kind)


def _short(a: np.ndarray, limit: int) -> np.ndarray:
    """Numbers below ``limit`` in a type that numpy sorts by radix, if they fit."""
    return a.astype(np.uint16 if limit <= 1 << 16 else np.int64)


def _run_starts(x: np.ndarray) -> np.ndarray:
    """First places of the runs of equal values of a sorted array."""
    return np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)


def pack_pairs(x: np.ndarray, y: np.ndarray) -> tuple[bytes, bytes]:
    """Pairs sorted by x and then y, as differences; y starts anew with each x."""
    d = np.diff(y, prepend=0)
    first = _run_starts(x)
    d[first] = y[first]
    return pack_sorted(x), pack(d)


def unpack_pairs(x: bytes, y: bytes) -> tuple[np.ndarray, np.ndarray]:
    x, d = unpack_sorted(x), unpack(y)
    total, first = np.cumsum(d), _run_starts(x)
    return x, total - np.repeat(total[first] - d[first], np.diff(np.append(first, len(x))))


def bucketed(df: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    """``df`` stored in the shared folder by the hash of ``key``, so that
    grouping by it needs no shuffle.  The table's name is given up at once; the
    files stay."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, key).option("path", scratch_path(spark, name)).saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out


def _rows(schema: list[tuple[str, pa.DataType]], rows: list):
    return [pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(schema)], [n for n, _ in schema]


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word hash, text index) of all tokens, an end after each text."""
    t = W.texts_of(texts)
    t.data = W.FOLD[t.data]
    n = len(t)
    r = W.runs(t, W.SPACES)
    h = W.hashes(t, r)
    first, count = W.first_and_count(r.doc, n)
    # place every text's words and its end in one sequence
    doc = np.repeat(np.arange(n), count + 1)
    word = np.empty(len(doc), np.uint64)
    is_end = np.zeros(len(doc), bool)
    is_end[np.cumsum(count + 1) - 1] = True
    word[~is_end], word[is_end] = h, END
    return word, doc


_BLOCK = [("block", pa.string()), ("part", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("n", pa.int64())]
_BLOCK_TYPE = "block string, part int, a binary, b binary, c binary, n long"


def _larger(batches):
    """Consecutive batches joined up to about the size of a block."""
    held, size = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            size += b.column(2).nbytes
        if size >= BLOCK_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _blocks(parts: int):
    """(doc_id, held_out, text) -> a row for each block and a row for the words
    that it asks of each part of the dictionary.

    Block row: a = doc ids, null flags and held-out flags, b = tokens a text,
    c = place of every token among the block's n distinct words, which are
    ordered by part and hash.  Word row: a = hashes, b = training counts, in
    that order."""
    def run(batches):
        for batch in _larger(batches):
            for lo, hi in W.slices(batch.column(2), BLOCK_BYTES):
                b = batch.slice(lo, hi - lo)
                held = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
                hashed, docs = [], []
                for x, z in W.slices(b.column(2)):
                    w, d = tokens(b.column(2).slice(x, z - x))
                    hashed.append(w)
                    docs.append((d + x).astype(np.int32))
                word, doc = np.concatenate(hashed), np.concatenate(docs)
                key, place = np.unique(word, return_inverse=True)
                order, cut = _dealt(key, parts)
                to = np.empty(len(key), np.int64)
                to[order] = np.arange(len(key))
                place = to[place]
                key = key[order]
                counts = np.bincount(place, weights=~held[doc], minlength=len(key)).astype(np.int64)
                ids = b.column(0)
                who = np.concatenate([ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), held]).astype(np.int64)
                name = uuid.uuid4().hex
                rows = [(name, None, pack(who), pack(np.bincount(doc, minlength=hi - lo)), pack(place), len(key))]
                rows += [(name, p, pack_sorted(key[i:j]), pack(counts[i:j]), None, int(i)) for p, (i, j) in enumerate(zip(cut, cut[1:])) if j > i]
                arrays, names = _rows(_BLOCK, rows)
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def _dealt(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys by part, and where each part begins and the last ends."""
    part = _short(W.mix(keys + np.uint64(7)) % np.uint64(parts), parts)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


_WORD = [("block", pa.string()), ("at", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("tokens", pa.int64()), ("vocabulary", pa.int64())]
_WORD_TYPE = "block string, at long, a binary, b binary, tokens long, vocabulary long"


def _dictionary(parts: int):
    """All words asked of one part -> numbers (a) and training counts (b) for
    each block, in its order; and a row without block that holds the part's
    training tokens and words.  Numbers are above 0, smaller for more frequent
    words, and no two parts give the same one."""
    def run(table: pa.Table) -> pa.Table:
        asked = sorted(table.to_pylist(), key=lambda r: r["block"])
        keys = [unpack_sorted(r["a"], np.uint64) for r in asked]
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.bincount(at, np.concatenate([unpack(r["b"]) for r in asked]), len(key)).astype(np.int64)
        number = np.empty(len(key), np.int64)
        number[np.argsort(-count, kind="stable")] = np.arange(len(key)) * parts + asked[0]["part"] + 1
        rows = [(None, None, None, None, int(count.sum()), int((count > 0).sum()))]
        for r, x in zip(asked, np.split(at, np.cumsum([len(k) for k in keys])[:-1])):
            rows.append((r["block"], r["n"], pack(number[x]), pack(count[x]), None, None))
        return pa.Table.from_arrays(*_rows(_WORD, rows))

    return run


def _known(rows: list, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and training counts of a block's words from the dictionary's answers."""
    number, count = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for r in rows:
        v = unpack(r["a"])
        number[r["at"]:r["at"] + len(v)], count[r["at"]:r["at"] + len(v)] = v, unpack(r["b"])
    return number, count


def _pairs(block: dict, number: np.ndarray, count: np.ndarray, shards: int, hot: int):
    """The block's distinct (word, context) by shard, word and context, whether
    the context is spread, the shard, and each token's place among them."""
    n, size = block["n"], unpack(block["b"])
    order = np.argsort(number)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(1, n + 1)  # the start of a text is before all words
    place = rank[unpack(block["c"])]
    before = np.concatenate(([0], place[:-1]))
    before[np.cumsum(size)[:-1]] = 0  # every text has its end, so none is empty
    key, at = np.unique(place * (n + 1) + before, return_inverse=True)
    word, c = number[order][key // (n + 1) - 1], key % (n + 1)
    context = np.append(START, number[order])[c]
    spread = np.minimum(np.append(shards, count[order] // hot + 1)[c], shards)
    salt = np.zeros(len(key), np.uint64)
    many = spread > 1
    salt[many] = W.mix(word[many].astype(np.uint64)) % spread[many].astype(np.uint64)
    shard = _short(W.mix(W.mix(context.astype(np.uint64) + np.uint64(1)) + salt) % np.uint64(shards), shards)
    order = np.argsort(shard, kind="stable")
    to = np.empty(len(key), np.int64)
    to[order] = np.arange(len(key))
    return word[order], context[order], many[order], shard[order], to[at]


_ASK = [("shard", pa.int32()), ("block", pa.string()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("spread", pa.binary()), ("n", pa.int64())]
_ASK_TYPE = "shard int, block string, a binary, b binary, c binary, spread binary, n long"


def _asks(shards: int, hot: int):
    """Block and the dictionary's answers -> for each shard its words (a) and
    contexts (b) with training counts (c), and which contexts are spread."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block = left.to_pylist()[0]
        word, context, spread, shard, place = _pairs(block, *_known(right.to_pylist(), block["n"]), shards, hot)
        held = unpack(block["a"]).reshape(3, -1)[2]
        counts = np.bincount(place, weights=np.repeat(1 - held, unpack(block["b"])), minlength=len(word)).astype(np.int64)
        cut = np.searchsorted(shard, np.arange(shards + 1))
        rows = [(k, block["block"], *pack_pairs(word[i:j], context[i:j]), pack(counts[i:j]), pack_sorted(np.unique(context[i:j][spread[i:j]])), int(i))
                for k, (i, j) in enumerate(zip(cut, cut[1:])) if j > i]
        return pa.Table.from_arrays(*_rows(_ASK, rows))

    return run


_STATE_BINARY = ["words", "sizes", "contexts", "context", "counts", "tables", "spread"]
_STATE = [("shard", pa.int32()), *((x, pa.binary()) for x in _STATE_BINARY), ("samples", pa.list_(pa.binary()))]
_STATE_TYPE = f"shard int, {', '.join(x + ' binary' for x in _STATE_BINARY)}, samples array<binary>"


def _gather(table: pa.Table) -> pa.Table:
    """All asks of one shard -> its words with their numbers of contexts, its
    contexts, and for each (word, context) the context's place, the training
    count and one table if the context has seen the word."""
    asked = table.to_pylist()
    pairs = [unpack_pairs(r["a"], r["b"]) for r in asked]
    word, context = (np.concatenate(x) for x in zip(*pairs))
    words, word = np.unique(word, return_inverse=True)
    contexts, context = np.unique(context, return_inverse=True)
    key, at = np.unique(word * len(contexts) + context, return_inverse=True)
    counts = np.bincount(at, np.concatenate([unpack(r["c"]) for r in asked])).astype(np.int64)
    spread = np.unique(np.concatenate([unpack_sorted(r["spread"]) for r in asked]))
    word, context = pack_pairs(key // len(contexts), key % len(contexts))
    row = (asked[0]["shard"], pack_sorted(words), pack(np.bincount(key // len(contexts))), pack_sorted(contexts), context,
           pack(counts), pack((counts > 0).astype(np.int64)), pack_sorted(spread), [])
    return pa.Table.from_arrays(*_rows(_STATE, [row]))


class Shard:
    """A shard's state with its words and contexts numbered in order."""

    def __init__(self, r: dict):
        self.words, self.sizes = unpack_sorted(r["words"]), unpack(r["sizes"])
        self.spread, self.row = unpack_sorted(r["spread"]), r
        self.first = np.cumsum(self.sizes) - self.sizes

    def pairs(self) -> None:
        """Take the (word, context) apart."""
        r = self.row
        self.contexts, self.counts = unpack_sorted(r["contexts"]), unpack(r["counts"])
        d = unpack(r["context"])
        total = np.cumsum(d)
        self.context = total - np.repeat(total[self.first] - d[self.first], self.sizes)
        self.spread_at = np.searchsorted(self.contexts, self.spread)

    def by_word(self, tables: np.ndarray) -> np.ndarray:
        return np.add.reduceat(tables, self.first)

    def by_context(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.context, v, len(self.contexts)).astype(np.int64)

    def pull(self, tables, guests, root, spread_tables, common) -> np.ndarray:
        """Weight of a new table for each pair."""
        served = self.by_context(tables)
        served[self.spread_at] = spread_tables
        parent = (guests - DISCOUNT[0] * root + common[0]) / (STRENGTH[0] + common[1])
        return (STRENGTH[1] + DISCOUNT[1] * served)[self.context] * np.repeat(parent, self.sizes)

    def weights(self, spread_customers) -> np.ndarray:
        """Strength and customers of each pair's context."""
        customers = self.by_context(self.counts)
        customers[self.spread_at] = spread_customers
        return (STRENGTH[1] + customers)[self.context]


def reseat(customers: np.ndarray, pull: np.ndarray, discount: float, rng) -> np.ndarray:
    """Tables after seating each dish's customers anew.  ``pull`` is the weight
    of a new table: (strength + discount * all tables) * parent probability."""
    tables = (customers > 0).astype(np.int64)
    live = np.flatnonzero(customers > 1)
    j = 1
    while len(live):
        step = 1 if j < ONE_BY_ONE else max(1, int(j * GROWTH))
        many = np.minimum(step, customers[live] - j)
        chance = pull[live] / (j - discount * tables[live] + pull[live])
        tables[live] += (rng.random(len(live)) < chance) if step == 1 else rng.binomial(many, chance)
        j += step
        live = live[customers[live] > j]
    return np.minimum(tables, customers)


_OWN = [("part", pa.int32()), ("shard", pa.int32()), ("is_word", pa.bool_()), ("k", pa.binary()), ("a", pa.binary()), ("b", pa.binary())]
_OWN_TYPE = "part int, shard int, is_word boolean, k binary, a binary, b binary"
_SUM = [("part", pa.int32()), ("shard", pa.int32()), ("is_word", pa.bool_()), ("a", pa.binary()), ("b", pa.binary()), ("root_customers", pa.int64()), ("root_tables", pa.int64())]
_SUM_TYPE = "part int, shard int, is_word boolean, a binary, b binary, root_customers long, root_tables long"


def _own(parts: int):
    """Shard state -> for each part the tables (b) of the shard's words, and the
    customers (a) and tables (b) of its spread contexts."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                s, tables, rows = Shard(r), unpack(r["tables"]), []
                customers = served = s.spread
                if len(s.spread):
                    s.pairs()
                    customers, served = s.by_context(s.counts)[s.spread_at], s.by_context(tables)[s.spread_at]
                for is_word, key, a, b in ((False, s.spread, customers, served), (True, s.words, None, s.by_word(tables))):
                    order, cut = _dealt(key.astype(np.uint64), parts)
                    rows += [(p, r["shard"], is_word, pack_sorted(key[order[i:j]]), None if is_word else pack(a[order[i:j]]), pack(b[order[i:j]]))
                             for p, (i, j) in enumerate(zip(cut, cut[1:])) if j > i]
                arrays, names = _rows(_OWN, rows)
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def _summed(number: int, new_root: float):
    """What the shards sent to one part -> to each shard, for its words, all
    customers (a) and tables (b) of the root, seated here, and for its spread
    contexts all customers and tables; and a row without shard that holds the
    part's share of the root's customers and tables."""
    def run(table: pa.Table) -> pa.Table:
        part, rows, common = table["part"][0].as_py(), [], (0, 0)
        sent = sorted(table.to_pylist(), key=lambda r: r["shard"])
        for is_word in (False, True):
            mine = [r for r in sent if r["is_word"] == is_word]
            if not mine:
                continue
            keys = [unpack_sorted(r["k"]) for r in mine]
            key, at = np.unique(np.concatenate(keys), return_inverse=True)
            add = lambda x: np.bincount(at, np.concatenate([unpack(r[x]) for r in mine]), len(key)).astype(np.int64)  # noqa: B023, E731
            b = add("b")
            if is_word:
                root = reseat(b, np.full(len(b), new_root), DISCOUNT[0], np.random.default_rng([SEED, number, part, 1])) if number else (b > 0).astype(np.int64)
                common = (int(b.sum()), int(root.sum()))
                a, b = b, root
            else:
                a = add("a")
            for r, x in zip(mine, np.split(at, np.cumsum([len(k) for k in keys])[:-1])):
                rows.append((part, r["shard"], is_word, pack(a[x]), pack(b[x]), None, None))
        rows.append((part, None, None, None, None, *common))
        return pa.Table.from_arrays(*_rows(_SUM, rows))

    return run


def _sweep(number: int, parts: int, common: tuple[float, float], keep: bool, last: bool):
    """One Gibbs sweep over a shard's state, given its totals; with ``keep`` the
    state that comes in is added to the samples, with its totals; the ``last``
    sweep only does that."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        r = left.to_pylist()[0]
        s, tables = Shard(r), unpack(r["tables"])
        s.pairs()
        got = sorted(right.to_pylist(), key=lambda x: x["part"])

        def shared(key, is_word, column):
            order, _ = _dealt(key.astype(np.uint64), parts)
            v = np.empty(len(key), np.int64)
            v[order] = np.concatenate([np.zeros(0, np.int64), *(unpack(x[column]) for x in got if x["is_word"] == is_word)])
            return v

        guests, root = (shared(s.words, True, c) for c in "ab")
        customers, served = (shared(s.spread, False, c) for c in "ab")
        samples = r["samples"]
        if keep:
            samples = [*samples, r["tables"], *map(pack, (guests, root, customers, served)), pack(np.array(common).view(np.int64))]
        if not last:
            tables = reseat(s.counts, s.pull(tables, guests, root, served, common), DISCOUNT[1], np.random.default_rng([SEED, number, r["shard"]]))
        row = [r["shard"], *(r[x] for x in _STATE_BINARY), samples]
        row[1 + _STATE_BINARY.index("tables")] = pack(tables)
        return pa.Table.from_arrays(*_rows(_STATE, [row]))

    return run


_REPLY = [("block", pa.string()), ("at", pa.int64()), ("logp", pa.binary())]
_REPLY_TYPE = "block string, at long, logp binary"


def _answer(left: pa.Table, right: pa.Table) -> pa.Table:
    """Asks and the state of one shard -> averaged log10 probability for each
    ask, in the asks' order, in multiples of ``STEP``."""
    out = []
    if right.num_rows:
        r = right.to_pylist()[0]
        s, x = Shard(r), r["samples"]
        s.pairs()
        total = np.zeros(len(s.counts))
        for i in range(0, len(x), 6):
            tables, guests, root, customers, served, common = map(unpack, x[i:i + 6])
            total += s.counts - DISCOUNT[1] * tables + s.pull(tables, guests, root, served, common.view(np.float64))
        total /= s.weights(customers) * (len(x) // 6)  # customers are the same in all states
        logp = np.rint(-np.log10(total) / STEP).astype(np.int64)
        key = np.repeat(np.arange(len(s.words)), s.sizes) * len(s.contexts) + s.context
        for block, a, b, n in zip(*(left[c].to_pylist() for c in ("block", "a", "b", "n"))):
            w, c = unpack_pairs(a, b)
            at = np.searchsorted(key, np.searchsorted(s.words, w) * len(s.contexts) + np.searchsorted(s.contexts, c))
            out.append((block, n, pack(logp[at])))
    return pa.Table.from_arrays(*_rows(_REPLY, out))


def _score(train_tokens: int, vocabulary: int, shards: int, hot: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        b, rows = left.to_pylist()[0], right.to_pylist()
        number, known = _known([r for r in rows if r["logp"] is None], b["n"])
        word, _, _, _, place = _pairs(b, number, known, shards, hot)
        logp = np.zeros(len(word))
        for r in rows:
            if r["logp"] is not None:
                v = unpack(r["logp"])
                logp[r["at"]:r["at"] + len(v)] = -STEP * v
        who = unpack(b["a"]).reshape(3, -1)
        size, count = unpack(b["b"]), known[unpack(b["c"])]
        start = np.cumsum(size) - size
        base = np.add.reduceat(np.log10((count + 1) / (train_tokens + vocabulary + 1)), start)
        score = np.add.reduceat(logp[place], start)  # every text has its end
        return pa.Table.from_arrays([
            pa.array(who[0], mask=who[1].astype(bool)), pa.array(who[2].astype(bool)), pa.array(size), pa.array(np.add.reduceat((count > 0).astype(np.int64), start)),
            pa.array(np.full(len(size), train_tokens)), pa.array(base), pa.array(score), pa.array(10 ** np.minimum(-score / size, 300.0))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return run


def score_texts(docs: DataFrame, burn_in: int = BURN_IN, hot: int = HOT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity for every row of ``docs``.

    Learned from rows whose crc32(doc_id) mod 7 is not 2 (a null doc_id is
    learned from).  A null or empty text is its end token alone.  Repeated
    rows count as often as they occur and give a row each.  Without training
    rows the model is its uniform base.  An empty table gives an empty result;
    other columns are ignored.  A token's log10 probability is rounded to
    ``STEP``.
    """
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(7, 2).alias("held_out"), F.col("text").cast("string").alias("text"))
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    parts = max(PARTS, shards // SHARDS_A_PART)
    blocks = bucketed(d.mapInArrow(_blocks(parts), _BLOCK_TYPE), "block", shards, "blocks")
    numbered = blocks.filter("part is not null").select("part", "block", "a", "b", "n").groupBy("part").applyInArrow(_dictionary(parts), _WORD_TYPE)
    numbered = bucketed(numbered.repartition(shards, "block"), "block", shards, "dictionary")
    common = numbered.filter("block is null").agg(*(F.coalesce(F.sum(x), F.lit(0)) for x in ("tokens", "vocabulary"))).first()
    train_tokens, vocabulary = int(common[0]), int(common[1])
    blocks, numbered = blocks.filter("part is null"), numbered.filter("block is not null").select("block", "at", "a", "b")
    asks = blocks.groupBy("block").cogroup(numbered.groupBy("block")).applyInArrow(_asks(shards, hot), _ASK_TYPE)
    asks = bucketed(asks.repartition(shards, "shard"), "shard", shards, "asks")
    state = bucketed(asks.groupBy("shard").applyInArrow(_gather, _STATE_TYPE), "shard", shards, "seating")
    new_root = 0.0
    for number in range(burn_in + SAMPLES):
        last = number == burn_in + SAMPLES - 1
        sums = materialize(state.mapInArrow(_own(parts), _OWN_TYPE).groupBy("part").applyInArrow(_summed(number, new_root), _SUM_TYPE), "totals")
        root = sums.agg(*(F.coalesce(F.sum(x), F.lit(0)) for x in ("root_customers", "root_tables"))).first()
        new_root = (STRENGTH[0] + DISCOUNT[0] * root[1]) / (vocabulary + 1)
        old, state = state, bucketed(state.groupBy("shard").cogroup(sums.filter("shard is not null").groupBy("shard")).applyInArrow(
            _sweep(number, parts, (new_root, float(root[0])), number >= burn_in, last), _STATE_TYPE), "shard", shards, "seating")
        files.discard(old)  # the new state is stored
        files.discard(sums)
    replies = asks.select("shard", "block", "a", "b", "n").groupBy("shard").cogroup(state.groupBy("shard")).applyInArrow(_answer, _REPLY_TYPE)
    none = F.lit(None).cast("binary")
    answers = numbered.withColumn("logp", none).unionByName(replies.select("block", "at", none.alias("a"), none.alias("b"), "logp"))
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score(train_tokens, vocabulary, shards, hot), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, perplexity double")
