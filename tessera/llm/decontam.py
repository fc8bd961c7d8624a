"""Benchmark passages in documents, found up to an edit distance.

The CGK random walk copies words of a sequence to the steps of a walk, staying on
a word or going on by a random bit of the word and the step.  Some edits leave a
run of the item's words whole, and a walk of as many steps as that run has words
cannot leave it.  So short walks start at every word of the item, and at every word
of every document; where all samples of a few walks agree (bit-sampling LSH), the
window is verified by its exact edit distance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import PUNCT_TABLE, mix, row_pieces, utf8, word_hashes, word_spans

WALKS = 3                    # walks from a word, all of whose steps are sampled into one key
TOLERANCE = 0.2              # edits for each word of the item
RECALL = 1.0                 # least share of the passages within the tolerance that are found
INDEX_BYTES = 32 << 20       # benchmark text searched for in one pass
BATCH_BYTES = 1 << 19        # text searched together: its arrays stay in the processor's cache


def whole_run(words: int, tolerance: float = TOLERANCE) -> int:
    """Words of an item that stay together under any edits within the tolerance:
    ``most`` edits part the other words into ``most + 1`` runs."""
    most = int(words * tolerance)
    return -(-(words - most) // (most + 1))


def _seeds(steps: int) -> np.ndarray:
    return mix(np.arange(1, WALKS + 1, dtype=np.uint64) + np.uint64(steps * 4096))


def _walk(words: np.ndarray, at: np.ndarray, steps: int, pass_filter=None):
    """(survivors, keys): the walks from each position and their key over all steps.
    ``pass_filter(k, keys)`` tells after each sample which keys can still be found."""
    alive, key, k = np.arange(len(at)), np.full(len(at), steps, np.uint64), 0
    for walk, seed in enumerate(_seeds(steps)):
        pointer = at[alive]
        for step in range(steps):
            if step:
                bit = (mix(words[pointer] ^ seed) >> np.uint64(step)) & np.uint64(1)
                pointer = pointer + bit.astype(np.int64)
            elif walk:
                continue             # every walk starts on the same word
            key = mix(key ^ words[pointer])
            if pass_filter is not None:
                ok = pass_filter(k, key)
                alive, pointer, key = alive[ok], pointer[ok], key[ok]
            k += 1
    return alive, key


class Index:
    """Keys of the walks from all words of the items, made from ``(id, text)`` items."""

    def __init__(self, items: list[tuple[int, str]], tolerance: float = TOLERANCE):
        self.tolerance = tolerance
        data, offsets = utf8(pa.array([t for _, t in items], pa.string()))
        starts, ends, bounds = word_spans(data, offsets, PUNCT_TABLE)
        hashes = word_hashes(data, starts, ends)
        kept = [(i, a, b) for (i, _), a, b in zip(items, bounds[:-1].tolist(), bounds[1:].tolist()) if b > a]
        self.items = [(i, hashes[a:b]) for i, a, b in kept]
        runs = np.array([whole_run(b - a, tolerance) for _, a, b in kept], np.int64)
        self.passes, self._tables = [], None
        for steps in np.unique(runs).tolist():
            own = np.flatnonzero(runs == steps)
            count = np.array([kept[k][2] - kept[k][1] - steps + 1 for k in own], np.int64)
            offset = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            at = offset + np.repeat(np.array([kept[k][1] for k in own], np.int64), count)
            # Bits of a key in the maps that drop windows early: some 64 places for each key.
            shift = np.uint64(64 - min(24, max(16, len(at).bit_length() + 6)))
            maps = []

            def note(_, keys, shift=shift, maps=maps):
                bits = np.zeros(1 << int(64 - shift), bool)
                bits[keys >> shift] = True
                maps.append(np.packbits(bits))
                return slice(None)

            _, keys = _walk(hashes, at, steps, note)
            order = np.argsort(keys, kind="stable")
            self.passes.append((steps, shift, keys[order], np.repeat(own, count)[order].astype(np.int32), offset[order].astype(np.int32), maps))

    def search(self, words: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item, distance, first word, end word) of every passage within the
        tolerance, for rows whose words are ``words[bounds[r]:bounds[r + 1]]``; of
        passages of one item that overlap, the one of least distance."""
        if not len(words) or not self.items:
            return []
        padded = np.concatenate([words, np.zeros(max(p[0] for p in self.passes) + 1, np.uint64)])
        starts = []
        if self._tables is None:
            self._tables = [[np.unpackbits(m).view(bool) for m in p[-1]] for p in self.passes]
        for (steps, shift, keys, whose, offset, _), tables in zip(self.passes, self._tables):
            at = np.arange(len(words))
            alive, key = _walk(padded, at, steps, lambda k, x, t=tables, s=shift: t[k][x >> s])
            at = at[alive]
            lo, hi = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            n = hi - lo
            if n.sum():
                which = np.repeat(lo, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                starts.append(np.stack([whose[which], np.repeat(at, n) - offset[which], np.repeat(at, n)], 1))
        if not starts:
            return []
        found = np.concatenate(starts)
        found = np.unique(np.concatenate([found[:, :2], (np.searchsorted(bounds, found[:, 2], "right") - 1)[:, None]], 1), axis=0)
        return self._verify(words, bounds, found)

    def _verify(self, words, bounds, found):
        best: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for k, start, row in found.tolist():
            item = self.items[k][1]
            most = int(len(item) * self.tolerance)
            lo, hi = int(bounds[row]), int(bounds[row + 1])
            kept = best.setdefault((row, k), [])
            if any(a - most <= start <= a + most and d == 0 for d, a, _ in kept):
                continue
            a, b = max(lo, start - most), min(hi, start + len(item) + most)
            if start >= lo and start + len(item) <= hi and np.array_equal(words[start:start + len(item)], item):
                hit = (0, start, start + len(item))
            else:
                hit = passage(item, words[a:b], most)
                if hit is None:
                    continue
                hit = (hit[0], hit[1] + a, hit[2] + a)
            overlapping = [h for h in kept if h[1] < hit[2] and hit[1] < h[2]]
            if all(hit < h for h in overlapping):
                kept[:] = [h for h in kept if h not in overlapping] + [hit]
        return [(row, self.items[k][0], d, a - int(bounds[row]), b - int(bounds[row]))
                for (row, k), hits in best.items() for d, a, b in sorted(hits, key=lambda h: h[1])]


def passage(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the part of ``text`` of least edit distance to
    ``item``, null if above ``most``; of equal ones the one that ends first, and
    of these the shortest."""
    # Every item word that the text does not hold costs an edit.
    there = set(text.tolist())
    if sum(w not in there for w in item.tolist()) > most:
        return None
    ends = _last_row(item, text)
    end = int(ends.argmin())
    distance = int(ends[end])
    if distance > most:
        return None
    back = _last_row(item[::-1], text[:end][::-1], anchored=True)
    return distance, end - int(np.flatnonzero(back == distance)[0]), end


def _last_row(item: np.ndarray, text: np.ndarray, anchored: bool = False) -> np.ndarray:
    """Edit distance of the item to the best part of the text that ends at each
    position (``anchored``: to the text up to there)."""
    index = np.arange(len(text) + 1)
    row = index.copy() if anchored else np.zeros(len(text) + 1, np.int64)
    for word in item:
        new = row + 1
        np.minimum(new[1:], row[:-1] + (text != word), out=new[1:])
        row = np.minimum.accumulate(new - index) + index
    return row



def find_passages(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", tolerance: float = TOLERANCE, row_col: str | None = None) -> DataFrame:
    """``id_col, item_col, distance, first_word, n_words``: the passages of every
    whole text that are within ``tolerance`` word edits per item word of an item.

    Words are runs of letters and digits, A-Z lower-cased.  Every passage within the
    tolerance (below one) is found, or one of no greater distance that overlaps it.
    Items without words (null, empty) are never found; null or empty texts hold
    nothing; items of equal text are all reported.  Repeated rows each give their
    rows; empty tables give none; other columns are ignored, but a long ``row_col``,
    if named, is passed on.

    The benchmark, a curated set, is read in passes of ``INDEX_BYTES`` of its text;
    each pass broadcasts an index of that bounded size and reads the documents once.
    """
    rows = benchmark.select(F.col(item_col).cast("long"), F.col(item_text_col).cast("string")).filter(F.col(item_text_col).isNotNull())
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"),
                       *([F.col(row_col).cast("long").alias("row")] if row_col else []))
    schema = "id long, item long, distance int, first_word int, n_words int" + (", row long" if row_col else "")
    out = None
    for block in _item_blocks(rows):
        shared = spark.sparkContext.broadcast(Index(block, tolerance))
        part = base.mapInArrow(_searcher(shared), schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], schema)
    out = out.withColumnRenamed("id", id_col).withColumnRenamed("item", item_col)
    return out.withColumnRenamed("row", row_col) if row_col else out


def _item_blocks(rows: DataFrame):
    """Items in blocks of bounded size, one block at a time on the driver."""
    block, size = [], 0
    for ident, text in rows.toLocalIterator():
        if block and size + len(text) > INDEX_BYTES:
            yield block
            block, size = [], 0
        block.append((ident, text))
        size += len(text)
    if block:
        yield block


def _searcher(shared):
    def run(batches):
        index = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in row_pieces(np.diff(offsets), BATCH_BYTES):
                part = data[offsets[i]:offsets[j]]
                starts, ends, bounds = word_spans(part, offsets[i:j + 1] - offsets[i], PUNCT_TABLE)
                hits = index.search(word_hashes(part, starts, ends), bounds)
                columns = [pa.array([h[k] for h in hits], pa.int32()) for k in (2, 3)] + [pa.array([h[4] - h[3] for h in hits], pa.int32())]
                passed = [c.slice(i, j - i).take(pa.array([h[0] for h in hits], pa.int64())) for c in [batch.column(0), *batch.columns[2:]]]
                yield pa.RecordBatch.from_arrays(
                    [passed[0], pa.array([h[1] for h in hits], pa.int64()), *columns, *passed[1:]],
                    ["id", "item", "distance", "first_word", "n_words", "row"][:5 + len(passed) - 1])
    return run
