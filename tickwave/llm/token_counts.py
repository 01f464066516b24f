"""Token counts by heap-and-linked-list byte-pair merging, without making ids.

A pre-token's bytes are its first symbols.  They form a doubly linked list; a
heap holds every adjacent pair that has a merge rank.  The pair of the lowest
rank (the leftmost of equal ones) is popped again and again, joined if both
symbols are still there, and its new neighbours are pushed.  A pre-token has as
many tokens as it had symbols, less the merges made.  Nothing is looked up in a
vocabulary of ids.

The tokenizer file is read as plain JSON: merge ranks, added tokens, and the
pre-tokenizer's kind.  Texts are cut into units with numpy (:mod:`pieces`); each
distinct unit of a batch is split into pre-tokens and merged once, and counts
are kept in a bounded cache for later batches of the same worker.  Work and
memory of a task follow its batch, whatever the table's size; the only shuffle
is none at all.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwave.llm import pieces as P
from tickwave.llm import words as W

LIMIT = 512
CACHE_UNITS = 300_000
#: Longer units are counted each time they occur and not kept.
CACHE_BYTES = 64
# Fixed value: the pre-token pattern of byte-level BPE vocabularies.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 characters stand for themselves, the others follow from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class Merger:
    """Counts tokens of units with the merge ranks of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        odd = [model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")]
        added = spec.get("added_tokens") or []
        if (model.get("type", "BPE") != "BPE" or any(odd) or spec.get("normalizer") or pre.get("type") != "ByteLevel"
                or pre.get("add_prefix_space") or not pre.get("use_regex", True)
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)):
            raise ValueError(f"{path} is no plain byte-level BPE")
        symbols = byte_symbols()
        if missing := [s for s in symbols if s not in model["vocab"]]:
            raise ValueError(f"{path} has no symbol for {len(missing)} bytes")
        # symbols are numbered as they appear; a pair leads to its rank and the joined symbol
        number = {s: i for i, s in enumerate(symbols)}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            joined = number.setdefault(a + b, len(number))
            self.pairs.setdefault((number.setdefault(a, len(number)), number.setdefault(b, len(number))), (rank, joined))
        self.marks = sorted((t["content"] for t in added), key=len, reverse=True)
        self.mark_bytes = [m.encode() for m in self.marks]
        self.at_mark = re.compile("|".join(map(re.escape, self.marks)) or r"(?!)")
        self.split = regex.compile(PRE_TOKENS).findall
        self.units = P.Recent(CACHE_UNITS)

    def merged(self, piece: bytes) -> int:
        """Tokens of one pre-token."""
        n = len(piece)
        if n < 2:
            return n
        pairs = self.pairs
        symbol = list(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            if (found := pairs.get((symbol[i], symbol[i + 1]))) is not None:
                heap.append((found[0], i, symbol[i], symbol[i + 1]))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if symbol[i] != left or j >= n or symbol[j] != right:
                continue  # one of the two was joined to something else meanwhile
            new = pairs[left, right][1]
            symbol[i], symbol[j] = new, -1
            k = after[i] = after[j]
            merges += 1
            if k < n:
                before[k] = i
                if (found := pairs.get((new, symbol[k]))) is not None:
                    heapq.heappush(heap, (found[0], i, new, symbol[k]))
            h = before[i]
            if h >= 0 and (found := pairs.get((symbol[h], new))) is not None:
                heapq.heappush(heap, (found[0], h, symbol[h], new))
        return n - merges

    def unit(self, unit: bytes) -> int:
        found = self.split(unit.decode("utf-8"))
        if len(found) == 1:
            return self.merged(unit)
        total = 0
        for p in found:
            piece = p.encode()
            n = self.units.young.get(piece)  # a pre-token is a unit of itself
            if n is None:
                n = self.merged(piece)
                if len(piece) <= CACHE_BYTES:
                    self.units.young[piece] = n
            total += n
        return total

    def text(self, text: str) -> int:
        """Tokens of a whole text that may hold added tokens: one each, and
        what lies between them is pre-tokenized on its own."""
        return sum(self.unit(part.encode()) for part in self.at_mark.split(text)) + len(self.at_mark.findall(text))

    def counts(self, t: W.Texts) -> np.ndarray:
        """Tokens of every text."""
        r = P.units(t)
        some, place = P.distinct(t, r)
        made = {u: self.unit(u) for u in self.units.missing(some)}
        have = self.units.young
        of = np.fromiter((have[u] if u in have else made[u] for u in some), np.int64, len(some))
        have.update((u, n) for u, n in made.items() if len(u) <= CACHE_BYTES)
        total = np.concatenate(([0], np.cumsum(of[place])))
        first = np.searchsorted(r.doc, np.arange(len(t) + 1))
        out = total[first[1:]] - total[first[:-1]]
        for doc in P.holding(t, self.mark_bytes):
            out[doc] = self.text(t.data[t.offset[doc]:t.offset[doc + 1]].tobytes().decode("utf-8"))
        return out


@lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    """One merger a worker process, so that its cache serves all its tasks."""
    W.KEPT["merger"] = merger.cache_clear
    return Merger(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text.

    A null or empty text has no bytes and no tokens.  Every row gives a row, so
    repeated rows and null doc_ids stay; an empty table gives an empty result;
    other columns are ignored.  The strings of added tokens inside a text count
    as one token each, as the library's default has it.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches):
        m = None
        for b in batches:
            m = m or merger(tokenizer)
            for lo, hi in W.slices(b.column(1)):
                part = b.slice(lo, hi - lo)
                t = W.texts_of(part.column(1))
                n = m.counts(t)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(t.offset)), pa.array(n), pa.array(n > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(W.trimmed(run, "merger"), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
