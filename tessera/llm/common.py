"""Helpers shared by the operators: tables in the shared folder, and vectorised
word handling over Arrow string columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import shared_dir

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
ASCII_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
# Bytes hashed in one piece; numpy needs about 40 bytes of working memory for each.
PIECE = 1 << 20

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SPACE_TABLE = np.zeros(256, dtype=bool)
SPACE_TABLE[list(ASCII_SPACE)] = True

# Word characters for fuzzy matching: ASCII letters and digits, and every non-ASCII byte.
PUNCT_TABLE = np.ones(256, dtype=bool)
PUNCT_TABLE[48:58] = PUNCT_TABLE[65:91] = PUNCT_TABLE[97:123] = False
PUNCT_TABLE[128:] = False


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and
    the rows outlive the executors that made them."""
    path = shared_dir(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow string column, and the offsets of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    _, offsets, data = column.buffers()
    if not n or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_spans(data: np.ndarray, offsets: np.ndarray, delimiter: np.ndarray = SPACE_TABLE):
    """(starts, ends, bounds) of the words: byte positions, and for each row the
    index of its first word (``bounds`` has one entry more than there are rows)."""
    inside = ~delimiter[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    before[heads] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    tails = offsets[1:] - 1
    after[tails[(tails >= 0) & (offsets[1:] > offsets[:-1])]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, A-Z lower-cased; memory is bounded by ``PIECE``
    and the longest word."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + PIECE)))
        s, e = starts[i:j], ends[i:j]
        n = e - s
        first = np.cumsum(n) - n
        at = np.arange(int(n.sum())) - np.repeat(first, n)
        power = np.ones(int(n.max()), np.uint64)
        power[1:] = _STEP
        power = np.multiply.accumulate(power)
        value = _BYTE[LOWER[data[at + np.repeat(s, n)]]] * power[at]
        out[i:j] = np.add.reduceat(value, first)
        i = j
    return mix(out)


def row_pieces(weights: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges whose weights sum to about ``most``; a heavier row is alone."""
    i, total = 0, np.concatenate([[0], np.cumsum(weights)])
    while i < len(weights):
        j = max(i + 1, int(np.searchsorted(total, total[i] + most, side="right")) - 1)
        yield i, j
        i = j


def ascii_lower(col):
    """A-Z to a-z, nothing else (``lower`` would also change other alphabets)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sample_texts(df: DataFrame, id_col: str, text_col: str, most: int, seed: int) -> DataFrame:
    """``t``: texts of the ids of least hash, at most ``most`` ids, in an order that
    does not depend on the partitioning.  Ids are chosen before any text moves."""
    rows = df.select(F.xxhash64(F.lit(seed), F.col(id_col)).alias("h"), F.col(text_col).cast("string").alias("t"))
    least = rows.select("h").distinct().orderBy("h").limit(most)
    return rows.join(least, "h", "left_semi").orderBy("h", "t").limit(2 * most).select("t")
