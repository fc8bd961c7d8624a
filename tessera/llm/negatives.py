"""Hard-negative mining by angular triangle filtering.

Rows are integer vectors; the score of two rows is their inner product.  Every row
keeps its angles to a few reference directions.  For two vectors whose angles to a
reference are s and t, their own angle lies between |s - t| and min(s + t, 2 pi - s - t):
the tightest of these intervals, as cosines times the norms and widened against
rounding, bound the score.  Rows of one label with like angles lie together in tiles;
a tile is scored, in integers, for the anchors alone whose windows its bounds meet.

Anchors in blocks meet tiles on a grid of (row part, anchor part) cells: every tile is
copied to the anchor parts, every anchor block to the row parts, and each pair meets in
one cell.  Partial results are the best of each window; no cell holds more than a tile
and the windows of some blocks in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import partitions, stored

REFERENCES = 16         # directions
SAMPLE = 512            # rows that directions are chosen from, by least hash of the id
TILE = 256              # rows of a tile, anchors of a block
HELD = 64               # anchor blocks whose windows a task holds at once
MOST_NORM = float(1 << 28)
_SLACK = 1e-6           # radians; rounding of an angle is below 1e-7
_LEAST, _MOST = -(1 << 62), 1 << 62


def quantised(rows: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id, label, v``: component x becomes floor(scale * x).

    No part take rows of null id, label or vector, with a null or non-finite component,
    or whose norm reaches ``MOST_NORM`` (scores of two such rows would not fit a long).
    Of several rows of one id the least by label and vector counts."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & finite)
    scaled = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), scaled.alias("s"))
    norm = F.sqrt(F.aggregate("s", F.lit(0.0), lambda acc, x: acc + x * x))
    rows = rows.filter(norm < MOST_NORM).select("id", "label", F.transform("s", lambda x: x.cast("int")).alias("v"))
    one = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"))
    return one.select("id", "r.label", "r.v")


def reference_directions(rows: DataFrame, dims: int, count: int = REFERENCES, sample: int = SAMPLE) -> np.ndarray:
    """Unit vectors, each the sampled direction farthest from those before it.  At most
    ``sample`` rows come to the driver."""
    picked = rows.select("v").orderBy(F.xxhash64(F.lit(12), "id"), "id").limit(sample).collect()
    points = np.zeros((len(picked) + 1, max(dims, 1)))
    points[0, 0] = 1.0                      # so that there is a direction in any case
    for i, r in enumerate(picked):
        points[i + 1, :len(r["v"])] = r["v"]
    norms = np.linalg.norm(points, axis=1)
    points = (points / np.maximum(norms, 1e-300)[:, None])[norms > 0]
    chosen = [len(points) - 1]
    nearest = points @ points[-1]
    while len(chosen) < min(count, len(points)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, points @ points[chosen[-1]])
    return points[chosen]


def angles(vectors: np.ndarray, norms: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angle of each row to each direction; a right one where the norm is 0."""
    cosines = np.clip(vectors @ directions.T / np.maximum(norms, 1e-300)[:, None], -1.0, 1.0)
    return np.arccos(np.where(norms[:, None] > 0, cosines, 0.0))


def score_bounds(anchor_angles: np.ndarray, anchor_norms: np.ndarray, low_angles: np.ndarray, high_angles: np.ndarray,
                 low_norm: float, high_norm: float) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) possible score of each anchor with any row whose angles to the
    directions and whose norm lie in the given intervals."""
    near = np.maximum(anchor_angles - high_angles, low_angles - anchor_angles).max(axis=1) - _SLACK
    far = np.minimum(anchor_angles + high_angles, 2 * np.pi - anchor_angles - low_angles).min(axis=1) + _SLACK
    most, least = np.cos(np.clip(near, 0.0, np.pi)), np.cos(np.clip(far, 0.0, np.pi))
    margin = 1.0 + 1e-9 * anchor_norms * high_norm
    return (anchor_norms * np.where(least > 0, least * low_norm, least * high_norm) - margin,
            anchor_norms * np.where(most > 0, most * high_norm, most * low_norm) + margin)


def _with_angles(rows: DataFrame, directions: np.ndarray) -> DataFrame:
    """Adds ``norm``, ``theta`` (angles) and ``near`` (the nearest direction); vectors are
    filled up with zeros to the common length."""
    dims = directions.shape[1]
    schema = T.StructType(rows.schema.fields + [
        T.StructField("norm", T.DoubleType()), T.StructField("theta", T.ArrayType(T.DoubleType())), T.StructField("near", T.IntegerType())])

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("v")
            lists = batch.column(at)
            sizes = np.diff(np.asarray(lists.offsets))
            vectors = np.zeros((batch.num_rows, dims))
            vectors[np.arange(dims) < sizes[:, None]] = np.asarray(lists.flatten())
            norms = np.linalg.norm(vectors, axis=1)
            theta = angles(vectors, norms, directions)
            full = pa.ListArray.from_arrays(pa.array(np.arange(0, vectors.size + 1, dims), pa.int32()), pa.array(vectors.astype(np.int32).ravel()))
            offsets = pa.array(np.arange(0, theta.size + 1, theta.shape[1]), pa.int32())
            columns = [full if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(norms), pa.ListArray.from_arrays(offsets, pa.array(theta.ravel())),
                                                        pa.array(theta.argmin(axis=1).astype(np.int32))], names=schema.fieldNames())

    return rows.mapInArrow(fn, schema)


def _packed(rows: DataFrame, with_windows: bool = False) -> DataFrame:
    """Sorted rows -> tiles of at most ``TILE`` rows of one label, as byte strings, with the
    intervals of their angles and norms."""
    ordered = rows.repartitionByRange(partitions(rows.sparkSession), "label", "near", F.element_at("theta", F.col("near") + 1), "id")
    ordered = ordered.sortWithinPartitions("label", "near", F.element_at("theta", F.col("near") + 1), "id")
    columns = ["id", "label", "v", "norm", "theta"] + (["windows"] if with_windows else [])
    parts = ["ids", "v", "norms", "theta"] + (["windows"] if with_windows else [])
    schema = T.StructType([T.StructField("tile", T.LongType()), rows.schema["label"], T.StructField("size", T.IntegerType())]
                          + [T.StructField(c, T.BinaryType()) for c in parts])

    def emit(table: pa.Table) -> pa.RecordBatch:
        def flat(name):
            return np.ascontiguousarray(np.asarray(table[name].combine_chunks().flatten()))

        ids = np.asarray(table["id"])
        data = [ids, flat("v").astype(np.int32), np.asarray(table["norm"]), flat("theta")]
        if with_windows:
            spans = table["windows"].combine_chunks().flatten()
            data.append(np.stack([np.asarray(f) for f in spans.flatten()], axis=1))
        values = [pa.array([int(ids[0])], pa.int64()), table["label"][:1].combine_chunks(), pa.array([len(ids)], pa.int32())]
        return pa.RecordBatch.from_arrays(values + [pa.array([d.tobytes()], pa.binary()) for d in data], names=schema.fieldNames())

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            while held.num_rows:
                label = held["label"][0]
                n = min(TILE, held.num_rows)
                same = held["label"][:n].to_pylist()
                cut = next((i for i, x in enumerate(same) if x != label.as_py()), n)
                if cut == held.num_rows and cut < TILE:
                    break                   # the next batch may go on with this label
                yield emit(held[:cut])
                held = held[cut:]
        if held is not None and held.num_rows:
            yield emit(held)

    return ordered.select(*columns).mapInArrow(fn, schema)


class _Block:
    """Anchors of a block and the best rows so far in each of their windows."""

    def __init__(self, row: dict, windows: int, best: int):
        n = row["a_size"]
        self.ids = np.frombuffer(row["a_ids"], np.int64)
        self.vectors = np.frombuffer(row["a_v"], np.int32).reshape(n, -1)
        self.norms = np.frombuffer(row["a_norms"])
        self.theta = np.frombuffer(row["a_theta"]).reshape(n, -1)
        spans = np.frombuffer(row["a_windows"], np.int64).reshape(n, windows, 3)
        self.keys, self.low, self.high = spans[..., 0], spans[..., 1].copy(), spans[..., 2]
        self.scores = np.full((n, windows, best), _LEAST, np.int64)
        self.found = np.full((n, windows, best), _MOST, np.int64)

    def meet(self, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray, theta: np.ndarray) -> None:
        least, most = score_bounds(self.theta, self.norms, theta.min(axis=0), theta.max(axis=0), norms.min(), norms.max())
        # A row of the score of a window's last may still come before it, by its id.
        open_ = (most[:, None] >= self.low) & (least[:, None] <= self.high) & (self.low <= self.high)
        some = np.flatnonzero(open_.any(axis=1))
        if not len(some):
            return
        kind = np.float64 if self.norms[some].max() * norms.max() < (1 << 52) else np.int64
        scores = (self.vectors[some].astype(kind) @ vectors.astype(kind).T).astype(np.int64)
        other = self.ids[some][:, None] != ids
        for w in range(self.low.shape[1]):
            fits = (scores >= self.low[some, w][:, None]) & (scores <= self.high[some, w][:, None]) & other
            hit = np.flatnonzero(fits.any(axis=1))
            if not len(hit):
                continue
            rows = some[hit]
            best = self.scores.shape[2]
            s = np.concatenate([self.scores[rows, w], np.where(fits[hit], scores[hit], _LEAST)], axis=1)
            f = np.concatenate([self.found[rows, w], np.where(fits[hit], ids, _MOST)], axis=1)
            order = np.lexsort((f, -s), axis=1)[:, :best]
            self.scores[rows, w] = np.take_along_axis(s, order, axis=1)
            self.found[rows, w] = np.take_along_axis(f, order, axis=1)
            # A full window takes no score below its last one any more.
            self.low[rows, w] = np.maximum(self.low[rows, w], self.scores[rows, w, -1])

    def rows(self) -> pa.RecordBatch:
        a, w, _ = at = np.nonzero(self.found != _MOST)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (self.ids[a], self.keys[a, w], self.found[at], self.scores[at])],
                                          names=["anchor_id", "key", "id", "score"])


def _grid(spark: SparkSession) -> tuple[int, int]:
    """(row parts, anchor parts): about one cell a shuffle partition.  Anchors being one
    row in a hundred or so, blocks are copied to more parts than tiles are."""
    cells = partitions(spark)
    across = max(1, round((cells / 100) ** 0.5))
    return -(-cells // across), across


def search(spark: SparkSession, tiles: DataFrame, anchors: DataFrame, same_label: bool, windows: int, best: int) -> DataFrame:
    """``anchors(id, label, v, norm, theta, near, windows array<struct<key, low, high>>)``, with
    exactly ``windows`` windows each -> ``anchor_id, key, id, score, rank``: for each window the
    ``best`` rows of the same, or of other, labels with a score in it, by score, then id.
    The anchor's own row is never among them."""
    down, across = _grid(spark)
    blocks = _packed(anchors, with_windows=True)
    blocks = blocks.select(*[F.col(c).alias(f"a_{c}") for c in blocks.columns])
    blocks = blocks.withColumn("part", F.pmod(F.xxhash64("a_tile"), F.lit(across))).withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))
    rows = tiles.withColumn("cell", F.pmod(F.xxhash64("tile"), F.lit(down)).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(across - 1).cast("long"))))
    label = F.col("label") == F.col("a_label")
    here = (blocks["cell"] == rows["cell"]) & (blocks["part"] == rows["part"]) & (label if same_label else ~label)
    # Sorted by cell, a block meets all tiles of its cell one after the other.
    pairs = blocks.hint("merge").join(rows, here).select(*[c for c in blocks.columns if c.startswith("a_")], "ids", "v", "norms", "theta", "size")

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, _Block] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column("a_ids")[i].as_py()
                if name not in held:
                    if len(held) == HELD:
                        yield from (b.rows() for b in held.values())
                        held = {}
                    held[name] = _Block({c: batch.column(c)[i].as_py() for c in batch.schema.names if c.startswith("a_")}, windows, best)
                row = {c: batch.column(c)[i].as_py() for c in ("ids", "v", "norms", "theta", "size")}
                n = row["size"]
                held[name].meet(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["v"], np.int32).reshape(n, -1),
                                np.frombuffer(row["norms"]), np.frombuffer(row["theta"]).reshape(n, -1))
        yield from (b.rows() for b in held.values())

    found = pairs.mapInArrow(fn, "anchor_id long, key long, id long, score long")
    order = Window.partitionBy("anchor_id", "key").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)


def _windows(*spans: tuple[Column, Column, Column]) -> Column:
    return F.array(*[F.struct(key.cast("long").alias("key"), low.cast("long").alias("low"), high.cast("long").alias("high"))
                     for key, low, high in spans])


def mine(spark: SparkSession, rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 5,
         percent: int = 80) -> DataFrame:
    """``rows(id long, label, v array<int>)`` of distinct ids, see ``quantised`` ->
    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows for which ``is_anchor`` (of ``id``) holds.  An anchor's positives
    are its ``n_positives`` best other rows of its label; for each of them the negatives
    are the ``n_negatives`` best rows of other labels whose score is at least ``percent``
    percent of the positive's and at most the positive's, which no row is where the
    positive's score is negative.  Best is by score, ties by the smaller id.  Shorter
    vectors count as filled up with zeros.  Anchors without positives, and positives
    without negatives, give no rows; so does an empty table."""
    rows = stored(spark, rows, "vectors")
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 1
    rows = stored(spark, _with_angles(rows, reference_directions(rows, dims)), "angles")
    tiles = stored(spark, _packed(rows), "tiles")
    anchors = rows.filter(is_anchor)
    whole = _windows((F.lit(0), F.lit(_LEAST), F.lit(_MOST)))
    positives = search(spark, tiles, anchors.withColumn("windows", whole), True, 1, n_positives)
    positives = stored(spark, positives.select("anchor_id", "id", "score"), "positives")
    spans = F.struct(F.col("id").alias("key"), F.expr(f"(score * {percent} + 99) div 100").alias("low"), F.col("score").alias("high"))
    none = F.struct(F.lit(0).cast("long").alias("key"), F.lit(1).cast("long").alias("low"), F.lit(0).cast("long").alias("high"))
    spans = positives.filter("score >= 0").groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(spans).alias("windows"))
    spans = spans.withColumn("windows", F.concat("windows", F.array_repeat(none, F.lit(n_positives) - F.size("windows"))))
    found = search(spark, tiles, anchors.join(spans, "id"), False, n_positives, n_negatives)
    scores = positives.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = found.select("anchor_id", F.col("key").alias("positive_id"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(scores, ["anchor_id", "positive_id"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
