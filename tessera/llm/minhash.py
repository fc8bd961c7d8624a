"""Near-duplicate documents by circulant MinHash.

One permutation scatters the word shingles over a circle of positions; a second
one, shifted by one position for each coordinate, gives all signature
coordinates.  Bands of coordinates select candidates, and the exact Jaccard
similarity of the full shingle sets decides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import mix, stored, utf8, word_hashes, word_spans
from tessera.llm.graph import components

CIRCLE_BITS = 22
HUB_ROUNDS = 2
RARE = 64                    # sets that hold a rare shingle at most; a pairing by shingles costs half as many rows for each
PARITIES = 1024              # cells whose parities tell sets apart before their shingles are compared
ROWS, BANDS = 5, 24          # a link of similarity 0.8 shares no band with probability 7e-5
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_SHORT = np.uint64(0xA24BAED4963EE407)


@lru_cache(maxsize=2)
def _circle(k: int, seed: int = 7) -> np.ndarray:
    """Windows of ``k`` consecutive values of the second permutation, by start."""
    order = np.random.default_rng(seed).permutation(1 << CIRCLE_BITS).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[:k - 1]]), k)


def shingle_sets(texts, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingles of each text of an Arrow column; a text of
    fewer words is one shingle, an empty one has none."""
    data, offsets = utf8(texts)
    starts, ends, bounds = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends)
    for i in range(len(bounds) - 1):
        w = hashes[bounds[i]:bounds[i + 1]]
        if not len(w):
            yield w
            continue
        n = min(words, len(w))
        h = np.full(len(w) - n + 1, np.uint64(n) if n < words else _SHORT, np.uint64)
        for j in range(n):
            h = (h ^ w[j:len(w) - n + 1 + j]) * _PAIR + np.uint64(j + 1)
            h ^= h >> np.uint64(29)
        yield np.unique(mix(h))


def signature(shingles: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` coordinates: least value of the second permutation, shifted by
    0..k-1, over the positions that the first one gives the shingles."""
    circle = _circle(k)
    at = (shingles >> np.uint64(64 - CIRCLE_BITS)).astype(np.int64)
    least = np.full(k, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(at), 4096):
        np.minimum(least, circle[at[i:i + 4096]].min(axis=0), out=least)
    return least


def band_keys(coordinates: np.ndarray, rows: int, bands: int) -> np.ndarray:
    parts = coordinates.reshape(bands, rows).astype(np.uint64)
    h = np.arange(1, bands + 1, dtype=np.uint64) * _SHORT
    for j in range(rows):
        h = mix(h ^ (parts[:, j] + _PAIR))
    return h.view(np.int64)


def _signatures(words: int, rows: int, bands: int):
    def run(batches):
        for batch in batches:
            size, key, keys = [], [], []
            for s in shingle_sets(batch.column(1), words):
                size.append(len(s))
                key.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                keys.append(band_keys(signature(s, rows * bands), rows, bands) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(key, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), batch.column(2)], ["id", "n", "set", "bands", "row"])
    return run


def parities(shingles: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles in each of ``PARITIES`` cells, as bits: two
    sets differ in at least as many shingles as their parities do in bits."""
    odd = np.bincount((shingles & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _keyed_sets(words: int):
    def run(batches):
        for batch in batches:
            sets = [s for s in shingle_sets(batch.column(1), words)]
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                 pa.array([parities(s) for s in sets], pa.list_(pa.int64()))], ["set", "shingles", "parity"])
    return run


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b, na, nb)`` whose full sets reach the similarity.  The pairs
    are thin rows; a set that many of them name is replicated by the skew join."""
    left = sets.select(F.col("set").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("set").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    return (pairs.join(left, "a").join(right, "b").withColumn("both", both)
            .filter(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent)
            .select("a", "b"))


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = 5, percent: int = 80, rows: int = ROWS, bands: int = BANDS, row_col: str | None = None) -> DataFrame:
    """One row per input row: ``id_col``, ``n_shingles``, ``component_id`` (least
    id of the linked group), ``kept`` (it is that least id).

    Words are split at ASCII white space after lower-casing A-Z.  Texts with the
    same set are one class from the start, so a group of copies is a partial
    minimum.  In a bucket of different sets, members are compared with a hub, first
    any, then the member of most links: a tight group costs comparisons in
    proportion to its size.  Members that are connected by then need no further
    comparison.  The rest are compared with all members of their buckets that they
    are not connected to, but for pairs whose overlap cannot suffice: sets
    that share no rare shingle (one of at most ``RARE`` sets) share at most their
    other ones, and those that share one are found by it; and the parities of two sets
    bound from below in how many shingles they differ.  So no link between candidates
    is lost.

    Null or empty text: ``n_shingles`` 0, linked with nothing.  A null id has a
    null ``component_id`` and is kept unless a linked row has an id.  Repeated rows each give a
    row.  An empty table gives an empty result.  Other columns are ignored, but a
    long ``row_col``, if named, is passed on, with ``root``: the hash of one set of
    the linked group, which tells groups apart that have no id (null without words).
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"),
                       (F.col(row_col) if row_col else F.lit(None)).cast("long").alias("row"))
    marks = stored(spark, base.mapInArrow(_signatures(words, rows, bands), "id long, n long, set binary, bands array<long>, row long"), "signatures")
    classes = (marks.filter("set is not null").groupBy("set")
               .agg(F.min("id").alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands")))
    classes = stored(spark, classes, "classes")
    members = classes.select("set", "n", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("c")).filter("c > 1").select("bucket")
    active = stored(spark, members.join(shared, "bucket").select("bucket", "set", "n"), "buckets")
    wanted = active.select("set").distinct().join(classes.select("set", "least"), "set")
    # One text of every class that shares a bucket; the set is found again from it.
    text = (base.join(wanted.withColumnRenamed("least", "id").select("id").distinct(), "id", "left_semi")
            .unionByName(base.filter("id is null"))
            .select(F.lit(None).cast("binary").alias("set"), "t"))
    sets = stored(spark, text.mapInArrow(_keyed_sets(words), "set binary, shingles array<long>, parity array<long>")
                  .dropDuplicates(["set"]).join(wanted.select("set"), "set", "left_semi"), "sets")
    labels = classes.select("set", F.col("set").alias("root")).limit(0)
    links = None
    for _ in range(HUB_ROUNDS):
        now = stored(spark, _now(active, labels, links), "members")
        hub = (now.groupBy("bucket").agg(F.max(F.struct("degree", "set", "n", "root")).alias("h"))
               .select("bucket", F.col("h.set").alias("hub"), F.col("h.n").alias("hub_n"), F.col("h.root").alias("hub_root")))
        spokes = now.join(hub, "bucket").filter("set <> hub").drop("degree")
        alike = F.expr(f"root <> hub_root and least(n, hub_n) * 100 >= greatest(n, hub_n) * {percent}")
        pairs = _pairs(spokes.filter(alike), "set", "n", "hub", "hub_n")
        found = stored(spark, _linked(pairs, sets, percent), "links")
        links = found if links is None else links.unionByName(found)
        labels = _relabel(spark, labels, found)
        # The hub is settled with its whole bucket; the others go on where they are not connected yet.
        active = stored(spark, _unconnected(spokes.select("bucket", "set", "n"), labels), "buckets")
    now = _now(active, labels, links).select("bucket", "set", "n", "root")
    rare = stored(spark, _rare(now, sets), "rare")
    most = rare.groupBy("set").agg(F.count("*").alias("rare"))
    now = stored(spark, now.join(most, "set", "left").withColumn("most", F.col("n") - F.coalesce("rare", F.lit(0))).drop("rare")
                 .join(sets.select("set", "parity"), "set"), "members")
    main = (now.groupBy("bucket", "root").agg(F.count("*").alias("c")).groupBy("bucket")
            .agg(F.max(F.struct("c", "root")).alias("m")).select("bucket", F.col("m.root").alias("main")))
    probe = now.join(main, "bucket").filter("root <> main").drop("main")
    other = now.select("bucket", F.col("set").alias("hub"), F.col("n").alias("hub_n"), F.col("root").alias("hub_root"), F.col("most").alias("hub_most"),
                       F.col("parity").alias("hub_parity"))
    shared_most = F.expr(f"root <> hub_root and least(most, hub_most) * {100 + percent} >= (n + hub_n) * {percent}")
    apart = " + ".join(f"bit_count(parity[{k}] ^ hub_parity[{k}])" for k in range(PARITIES // 64))
    near = F.expr(f"({apart}) * {100 + percent} <= (n + hub_n) * {100 - percent}")
    pairs = _pairs(probe.join(other, "bucket").filter(shared_most).filter(near), "set", "n", "hub", "hub_n")
    pairs = pairs.unionByName(_sharing(rare, percent)).distinct()
    labels = _relabel(spark, labels, stored(spark, _linked(pairs, sets, percent), "links"))
    named = classes.join(labels, "set", "left").select("set", "least", F.coalesce("root", "set").alias("root"))
    group = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(group, "root").select("set", "root", "component_id")
    return (marks.join(named, "set", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"),
                    *([F.col("row").alias(row_col), "root"] if row_col else []))
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))))


def _now(active: DataFrame, labels: DataFrame, links: DataFrame | None) -> DataFrame:
    """Members with the root they are connected to and the number of their links."""
    out = active.join(labels, "set", "left").withColumn("root", F.coalesce("root", "set"))
    if links is None:
        return out.withColumn("degree", F.lit(0).cast("long"))
    degree = links.select(F.explode(F.array("a", "b")).alias("set")).groupBy("set").agg(F.count("*").alias("degree"))
    return out.join(degree, "set", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))


def _unconnected(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one root."""
    split = (members.join(labels, "set", "left").withColumn("root", F.coalesce("root", "set"))
             .groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("bucket"))
    return members.join(split, "bucket")


def _rare(now: DataFrame, sets: DataFrame) -> DataFrame:
    """``set, n, root, s, c, at``: the shingles that at most ``RARE`` of the open sets
    hold, with the number of those, and their place in the set, rarest first."""
    held = (sets.join(now.select("set", "n", "root").distinct(), "set")
            .select("set", "n", "root", F.explode("shingles").alias("s")))
    counts = held.groupBy("s").agg(F.count("*").alias("c")).filter(F.col("c") <= RARE)
    place = F.row_number().over(Window.partitionBy("set").orderBy("c", "s")) - 1
    return held.join(counts, "s").withColumn("at", place)


def _sharing(rare: DataFrame, percent: int) -> DataFrame:
    """Pairs of different roots that share a rare shingle early enough.  The rarest
    shingle that two linked sets share is among the first ``n - least overlap`` of
    both, as those before it are not shared."""
    early = rare.filter(F.expr(f"c > 1 and (n - at) * 100 >= n * {percent}")).select("s", "set", "n", "root", "at")
    other = early.select("s", F.col("set").alias("hub"), F.col("n").alias("hub_n"), F.col("root").alias("hub_root"), F.col("at").alias("hub_at"))
    enough = F.expr(f"least(n - at, hub_n - hub_at) * {100 + percent} >= (n + hub_n) * {percent}")
    return _pairs(early.join(other, "s").filter("set < hub and root <> hub_root").filter(enough), "set", "n", "hub", "hub_n")


def _pairs(rows: DataFrame, a: str, na: str, b: str, nb: str) -> DataFrame:
    """Distinct unordered pairs ``(a, b, na, nb)``."""
    first = F.struct(F.col(a).alias("set"), F.col(na).alias("n"))
    second = F.struct(F.col(b).alias("set"), F.col(nb).alias("n"))
    return (rows.select(F.least(first, second).alias("x"), F.greatest(first, second).alias("y")).distinct()
            .select(F.col("x.set").alias("a"), F.col("y.set").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb")))


def _relabel(spark: SparkSession, labels: DataFrame, found: DataFrame) -> DataFrame:
    """Labels after new links: the old roots are joined, then the old labels follow."""
    def rooted(side: str) -> DataFrame:
        return labels.select(F.col("set").alias(side), F.col("root").alias("r" + side))
    roots = (found.join(rooted("a"), "a", "left").join(rooted("b"), "b", "left")
             .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
    moved = components(spark, roots)
    old = (labels.join(moved.select(F.col("node").alias("root"), F.col("root").alias("new")), "root", "left")
           .select("set", F.coalesce("new", "root").alias("root")))
    new = moved.select(F.col("node").alias("set"), "root").join(labels.select("set"), "set", "left_anti")
    return stored(spark, old.unionByName(new), "labels")
