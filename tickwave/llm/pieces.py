"""Units of byte-level BPE texts, found with numpy over a batch's UTF-8 bytes.

The pre-tokens of a byte-level BPE (words with one leading space, numbers, other
marks, white space) never reach across the places where this module cuts:

- a unit is a maximal run of non-space characters with the one plain space before it;
- of a white-space run before a word, everything but the last character is a
  unit, and so is the last character where it isn't a plain space;
- a white-space run at the end of a text is one unit;
- a unit ends before an ASCII mark (other than an apostrophe) that follows an
  ASCII letter or digit.

So the tokens of a text are those of its units in order, and equal units are
looked at once a batch.  White space is what Unicode calls so.  Texts that hold
the string of an added token must be cut there first; :func:`holding` finds them.
"""

from __future__ import annotations

import numpy as np

from tickwave.llm import words as W

# UTF-8 bytes of the white space beyond ASCII.
_TWO = [0xC285, 0xC2A0]
_THREE = [0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080]

_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[33:127] = ~_ALNUM[33:127]
_MARK[ord("'")] = False

_LEAD = np.zeros(256, bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def spaces(data: np.ndarray) -> np.ndarray:
    """True for every byte of a white-space character."""
    out = W.SPACES[data]
    at = np.flatnonzero(_LEAD[data])
    if len(at):
        last = len(data) - 1
        b = [data[np.minimum(at + j, last)].astype(np.int64) for j in range(3)]
        two = at[np.isin(b[0] << 8 | b[1], _TWO)]
        three = at[np.isin(b[0] << 16 | b[1] << 8 | b[2], _THREE)]
        for j in range(2):
            out[two + j] = True
        for j in range(3):
            out[three + j] = True
    return out


def _runs(member: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of maximal runs of True that stay inside one text."""
    if not len(member):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    full = offset[:-1][np.diff(offset) > 0]
    before = np.concatenate(([False], member[:-1]))
    before[full] = False
    after = np.concatenate((member[1:], [False]))
    after[full[1:] - 1] = False
    return np.flatnonzero(member & ~before), np.flatnonzero(member & ~after) + 1


def units(t: W.Texts) -> W.Runs:
    """All units of the texts, in order."""
    space = spaces(t.data)
    start, end = _runs(~space, t.offset)
    cut = np.flatnonzero(_MARK[t.data[1:]] & _ALNUM[t.data[:-1]]) + 1
    cut = cut[~np.isin(cut, t.offset)]  # what a text begins with is no place to cut
    start, end = np.sort(np.concatenate((start, cut))), np.sort(np.concatenate((end, cut)))
    doc = np.searchsorted(t.offset, start, "right") - 1
    joined = (start > t.offset[doc]) & (t.data[np.maximum(start - 1, 0)] == 32) if len(start) else np.zeros(0, bool)
    start = start - joined
    s, e = _runs(space, t.offset)
    sdoc = np.searchsorted(t.offset, s, "right") - 1
    word_after = e < t.offset[sdoc + 1]
    final = t.data[e - 1] if len(e) else np.zeros(0, np.uint8)
    width = np.where(final < 0x80, 1, np.where(t.data[np.maximum(e - 2, 0)] >= 0xC0, 2, 3)) if len(e) else np.zeros(0, np.int64)
    cut = np.where(word_after, e - width, e)
    some = s < cut
    alone = word_after & (final != 32)
    start = np.concatenate((start, s[some], cut[alone]))
    end = np.concatenate((end, cut[some], e[alone]))
    doc = np.concatenate((doc, sdoc[some], sdoc[alone]))
    order = np.argsort(start, kind="stable")
    return W.Runs(doc[order], start[order], end[order])


def firsts(t: W.Texts, r: W.Runs) -> tuple[W.Runs, np.ndarray, np.ndarray]:
    """The first of each of the distinct units, their hashes and, for every unit,
    its place among them.  Units are told apart by a 64-bit hash: within a slice
    of 2 MB two of them are confused with odds below 1e-8."""
    h, first, place = np.unique(W.hashes(t, r), return_index=True, return_inverse=True)
    return W.Runs(r.doc[first], r.start[first], r.end[first]), h, place


def bytes_of(t: W.Texts, r: W.Runs) -> list[bytes]:
    data = t.data.tobytes()
    return [data[a:b] for a, b in zip(r.start.tolist(), r.end.tolist())]


def distinct(t: W.Texts, r: W.Runs) -> tuple[list[bytes], np.ndarray]:
    """The distinct units as bytes and, for every unit, its place among them."""
    if not len(r):
        return [], np.zeros(0, np.int64)
    some, _, place = firsts(t, r)
    return bytes_of(t, some), place


def holding(t: W.Texts, marks: list[bytes]) -> list[int]:
    """The texts that hold one of the marks."""
    if not marks or not len(t.data):
        return []
    data, found = t.data.tobytes(), set()
    for mark in marks:
        at = data.find(mark)
        while at >= 0:
            doc = int(np.searchsorted(t.offset, at, "right")) - 1
            if at + len(mark) <= t.offset[doc + 1]:
                found.add(doc)
            at = data.find(mark, at + 1)
    return sorted(found)


class Recent:
    """Results of the units met lately, in two generations: when the younger one
    is full it becomes the older, so units that keep coming back stay."""

    def __init__(self, size: int):
        self.size = size
        self.young: dict = {}
        self.old: dict = {}

    def missing(self, wanted: list[bytes]) -> list[bytes]:
        """Those of the wanted units that have to be made; the others are now young."""
        if len(self.young) + len(wanted) > self.size:
            self.old, self.young = self.young, {}
        young, old, out = self.young, self.old, []
        for u in wanted:
            if u not in young:
                v = old.get(u)
                if v is None:
                    out.append(u)
                else:
                    young[u] = v
        return out


#: Longest unit (bytes) and most ids that a row of :class:`Table` holds.
UNIT_BYTES, UNIT_IDS = 24, 8


class Table:
    """Ids of the units met lately, in one array of fixed size: a unit's hash names
    its row, and the unit that comes last has it.  A row holds the unit's bytes too,
    so what is found is exact; what doesn't fit a row is not kept.  Half a million
    rows take 22 MB, a fifth of what dictionaries of as many units take."""

    def __init__(self, size: int, kind: str):
        self.kind = kind
        self.rows = np.zeros(size, [("unit", np.uint8, UNIT_BYTES), ("length", np.uint8), ("n", np.uint8), ("ids", kind, UNIT_IDS)])

    def find(self, t: W.Texts, r: W.Runs, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A row for each unit (hashes ``h``), and whether it holds the unit's ids;
        the others are ready for :meth:`keep`."""
        n = r.end - r.start
        padded = np.concatenate((t.data, np.zeros(UNIT_BYTES, np.uint8)))
        unit = np.lib.stride_tricks.sliding_window_view(padded, UNIT_BYTES)[r.start]
        unit *= np.arange(UNIT_BYTES) < n[:, None]
        rows = self.rows[self._at(h)]
        hit = (rows["length"] == n) & (rows["unit"] == unit).all(axis=1)
        rows["unit"] = unit
        rows["length"] = np.where(n <= UNIT_BYTES, n, 0)
        return rows, hit

    def keep(self, rows: np.ndarray, h: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        """Put in the ids (end to end, ``size`` each) of the units with these rows."""
        fits = (rows["length"] > 0) & (size <= UNIT_IDS)
        ids = ids[np.repeat(fits, size)]
        rows, h, size = rows[fits], h[fits], size[fits]
        some = np.zeros((len(rows), UNIT_IDS), self.kind)
        some[np.arange(UNIT_IDS) < size[:, None]] = ids
        rows["n"], rows["ids"] = size, some
        self.rows[self._at(h)] = rows

    def _at(self, h: np.ndarray) -> np.ndarray:
        return (h % np.uint64(len(self.rows))).astype(np.int64)
