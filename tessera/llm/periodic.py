"""Periodic runs of words: Lyndon arrays from the first phase of a grouping suffix
sorter, and their roots extended to runs.

A run is a maximal stretch of words with a smallest period.  By the runs theorem the
Lyndon root of every run is, under one of the two orders of the words, the longest
Lyndon word that starts at some position of the run.  The first phase of Baier's
suffix sorter groups positions by exactly these words, so that it yields both Lyndon
arrays directly; each root is then extended to both sides by longest common
extensions, which come from names of blocks of 1, 2, 4, ... words.

A text is worked on by one task, in memory proportional to its words.  Stretches in
which no run can lie are left out first: within a run of the asked length and
exponent every block of ``_block`` words occurs again, so only stretches of repeated
blocks are grouped.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
_RUNS = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
_MULT = np.uint64(0x9E3779B97F4A7C15)


def lyndon_lengths(ranks: list[int]) -> array:
    """Length of the longest Lyndon word that starts at each position, the end of the
    text being less than every word.

    Positions are grouped by a prefix of the text from them on, at first by one word,
    and groups are taken from the greatest down.  A taken group's prefix is final: it
    is the longest Lyndon word.  It is appended to the prefix of the nearest position
    before that is not taken yet, which ends right there; positions whose prefix grows
    by the same number of copies form a new group right above their old one."""
    n = len(ranks)
    length = array("i", [1]) * n
    group = array("i", ranks)
    count = max(ranks) + 1 if n else 0
    members: list[list[int]] = [[] for _ in range(count)]
    for i, r in enumerate(ranks):
        members[r].append(i)
    lower = array("i", range(-1, count - 1))
    upper = array("i", range(1, count + 1))
    taken = bytearray(n)
    before = array("i", [0]) * n            # of a taken position: the nearest one not taken, as of then
    copies = array("i", [0]) * n
    at = count - 1
    while at >= 0:
        here = sorted(i for i in members[at] if group[i] == at)
        members[at] = []
        if here:
            grown: dict[int, int] = {}
            for i in here:
                p = i - 1
                while p >= 0 and taken[p]:
                    p = before[p]
                if p >= 0 and group[p] == at:
                    copies[i] = copies[p] + 1
                    p = before[p]
                else:
                    copies[i] = 1
                before[i] = p
                if p >= 0:
                    grown[p] = copies[i]
            size = length[here[0]]
            for i in here:
                taken[i] = 1
            parts: dict[tuple[int, int], list[int]] = {}
            for p, k in grown.items():
                length[p] += k * size
                parts.setdefault((group[p], k), []).append(p)
            for (old, k) in sorted(parts, reverse=True):
                new = len(members)
                members.append(parts[old, k])
                above = upper[old]
                upper.append(above)
                lower.append(old)
                lower[above] = new
                upper[old] = new
                for p in members[new]:
                    group[p] = new
        at = lower[at]
    return length


class Extensions:
    """Longest common extensions of pairs of positions, for many pairs at once.

    ``names[k][i]`` is equal for equal blocks of 2**k words; levels stop where all
    blocks differ."""

    def __init__(self, ids: np.ndarray):
        self.n = len(ids)
        self.names = [np.asarray(ids, np.int64)]
        size = 1
        while 2 * size <= self.n:
            last = self.names[-1]
            _, named = np.unique(last[:-size] * np.int64(self.n + 1) + last[size:], return_inverse=True)
            if len(named) and int(named.max()) + 1 == len(named):
                break
            self.names.append(named.astype(np.int64))
            size *= 2

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words from ``i`` and from ``j > i`` on that agree."""
        got = np.zeros(len(i), np.int64)
        for k in self._levels():
            a, b = i + got, j + got
            fits = np.flatnonzero(b + (1 << k) <= self.n)
            fits = fits[self.names[k][a[fits]] == self.names[k][b[fits]]]
            got[fits] += 1 << k
        return got

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words right before ``i`` and right before ``j > i`` that agree."""
        got = np.zeros(len(i), np.int64)
        for k in self._levels():
            a, b = i - got - (1 << k), j - got - (1 << k)
            fits = np.flatnonzero(a >= 0)
            fits = fits[self.names[k][a[fits]] == self.names[k][b[fits]]]
            got[fits] += 1 << k
        return got

    def _levels(self) -> Iterator[int]:
        """From the largest block down: two blocks twice as large differ everywhere, so
        no level is needed twice."""
        return iter(range(len(self.names) - 1, -1, -1))


def _block(min_length: int, min_exponent: int) -> int:
    """Words of a block that must occur again within a run.  A run of length L and
    period q holds, for a block of L - 2q + 1 words or fewer, another one q words
    before or after; L >= min_length and L >= min_exponent * q."""
    return min_length * (min_exponent - 2) // min_exponent + 1


def _stretches(ids: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int]]:
    """(from, to) of the stretches whose every block of words occurs again in the text;
    equal hashes of different blocks only make stretches longer."""
    w = _block(min_length, min_exponent)
    if len(ids) < min_length:
        return []
    keys = np.zeros(len(ids) - w + 1, np.uint64)
    for k in range(w):
        keys = (keys ^ (keys >> np.uint64(31))) * _MULT + ids[k:k + len(keys)].astype(np.uint64)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(keys) + 2, bool)
    again[1 + order[1:][same]] = True
    again[1 + order[:-1][same]] = True
    edges = np.flatnonzero(again[1:] != again[:-1])
    return [(int(a), int(b) + w - 1) for a, b in zip(edges[::2], edges[1::2]) if b + w - 1 - a >= min_length]


def _runs_of(ids: np.ndarray, min_length: int, min_exponent: int) -> set[tuple[int, int, int]]:
    """(start, length, period) of the runs of one stretch."""
    _, ranks = np.unique(ids, return_inverse=True)
    n, top = len(ranks), int(ranks.max())
    same = Extensions(ranks)
    found = set()
    for order in (ranks, top - ranks):
        period = np.asarray(lyndon_lengths(order.tolist()), np.int64)
        root = np.flatnonzero((period * min_exponent <= n) & (np.arange(n) + period <= n))
        if min_exponent >= 3:
            # Some root of a run is followed by a whole further period: most others end here.
            root = root[root + 2 * period[root] <= n]
            root = root[ranks[root] == ranks[root + period[root]]]
        period = period[root]
        right = same.right(root, root + period)
        if min_exponent >= 3:
            root, period, right = (x[right >= period] for x in (root, period, right))
        left = same.left(root, root + period)
        length = left + period + right
        ok = (length >= min_length) & (length >= min_exponent * period)
        found.update(zip((root - left)[ok].tolist(), length[ok].tolist(), period[ok].tolist()))
    return found


def word_runs(ids: np.ndarray, min_length: int = 24, min_exponent: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of at least ``min_length`` words and
    ``min_exponent`` (2 or more) periods, by start, then period."""
    found = set()
    for a, b in _stretches(ids, min_length, min_exponent):
        found.update((a + s, length, q) for s, length, q in _runs_of(ids[a:b], min_length, min_exponent))
    return sorted(found, key=lambda r: (r[0], r[2]))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 24,
              min_exponent: int = 3) -> DataFrame:
    """Per row of ``docs``: the id, ``n_words``, ``runs`` (array of start, length and
    period in words, by start, then period) and ``collapsed``: the words that no run
    holds after its first period, joined by one space.

    Words are stretches without ASCII white space.  A null text counts as empty: no
    words, no runs, collapsed "".  Every row stands for itself, so null ids and
    repeated rows stay; other columns are left out.  An empty table gives no rows.
    """
    if min_exponent < 2:
        raise ValueError("a run holds at least two periods")
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    schema = T.StructType([T.StructField(id_col, rows.schema["id"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])

    def one(text: str | None):
        words = text.encode("utf-8").split() if text else []
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
        runs = word_runs(ids, min_length, min_exponent)
        if runs:
            kept = np.ones(len(words), bool)
            for start, length, period in runs:
                kept[start + period:start + length] = False
            words = [words[i] for i in np.flatnonzero(kept).tolist()]
        return len(ids), runs, b" ".join(words)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [one(t.as_py()) for t in batch.column(1)]
            runs = [[dict(zip(("start", "length", "period"), r)) for r in g[1]] for g in got]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array(runs, _RUNS),
                 pa.array([g[2] for g in got], pa.binary()).cast(pa.string())], names=schema.fieldNames())

    return rows.mapInArrow(fn, schema)


def with_period(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text``: with h the crc32 of the decimal id and g = h // 10, the text of every
    row with h % 10 = 0 is a periodic one from word a = g % n on: word i becomes word
    a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8).  Rows of null id keep their text."""
    h = F.crc32(docs[id_col].cast("string").cast("binary"))
    rows = docs.select(docs[id_col].alias(id_col), docs[text_col].cast("string").alias("text"), h.alias("h"))
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    rows = rows.withColumn("n", F.size("w")).withColumn("g", F.floor(F.col("h") / 10))
    some = F.col("n") > 0
    rows = rows.withColumn("a", F.when(some, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    turns = F.ceil(rest / F.col("p")).cast("int")
    periodic = F.concat(F.slice("w", F.lit(1), F.col("a")),
                        F.slice(F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), turns)), F.lit(1), rest))
    return rows.select(id_col, F.when(some, F.array_join(periodic, " ")).otherwise(F.col("text")).alias("text"))


def longest_lived(runs: Column) -> Column:
    """Of runs by start, then period, the first of greatest exact length / period; null if none."""
    return F.aggregate(runs, F.lit(None).cast(RUN), lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
