"""Toxicity by a linear classifier over character n-grams whose features are
scaled by naive Bayes log-count ratios, trained on labelled text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import row_pieces, utf8

ORDERS = (3, 4, 5)
BITS = 20
TRAIN_ROWS = 4000            # most labelled rows that the classifier is fitted on
LEAST_TEXTS = 3              # labelled texts that an n-gram must occur in
BATCH_CHARS = 1 << 21
NO_MODEL = -30.0             # bias without any labelled row: every score is near 0


def gram_sets(texts: list[str]) -> Iterator[np.ndarray]:
    """Distinct hashed character n-grams of each lower-cased text (a space on
    either side), as indices below ``2**BITS``."""
    padded = [f" {t.lower()} " for t in texts]
    size = np.array([len(t) for t in padded], np.int64)
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    hashes, h = {}, codes.copy()
    for n in range(2, max(ORDERS) + 1):
        h = h[:-1] * np.uint32(0x01000193) + codes[n - 1:] if len(h) > 1 else h[:0]
        if n in ORDERS:
            x = h ^ np.uint32(n * 0x27D4EB2F & 0xFFFFFFFF)
            x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            x = (x ^ (x >> np.uint32(12))) * np.uint32(0x297A2D39)
            hashes[n] = ((x ^ (x >> np.uint32(15))) >> np.uint32(32 - BITS)).astype(np.int32)
    last = np.empty(1 << BITS, np.int32)
    end = np.cumsum(size)
    for s, e in zip((end - size).tolist(), end.tolist()):
        grams = np.concatenate([hashes[n][s:max(s, e - n + 1)] for n in ORDERS])
        at = np.arange(len(grams), dtype=np.int32)
        last[grams] = at              # of equal entries the last one written is kept
        yield grams[last[grams] == at]


def fit(texts: list[str], labels: list[int], rounds: int = 40, rate: float = 0.2, penalty: float = 30.0) -> tuple[np.ndarray, float]:
    """(weights, bias).  Presence features times their log-count ratio, logistic
    loss, Adam over all rows.  Depends on nothing but its arguments."""
    y = np.asarray(labels, np.float64)
    if not len(y):
        return np.zeros(1 << BITS, np.float32), NO_MODEL
    sets = []
    for i, j in row_pieces(np.array([len(t) for t in texts]), BATCH_CHARS):
        sets.extend(gram_sets(texts[i:j]))
    # N-grams of few texts say nothing about others.  The sets stay apart, and no array is
    # as long as all of them: a set holds an n-gram once, so plain indexing counts it.
    texts_of = np.zeros(1 << BITS, np.int32)
    for s in sets:
        texts_of[s] += 1
    used = np.flatnonzero(texts_of >= LEAST_TEXTS)
    number = np.full(1 << BITS, -1, np.int32)
    number[used] = np.arange(len(used), dtype=np.int32)
    for i, s in enumerate(sets):
        s = number[s]
        sets[i] = s[s >= 0]
    size = np.array([len(s) for s in sets], np.int64)
    p, q = np.ones(len(used)), np.ones(len(used))
    for s, label in zip(sets, y):
        (p if label > 0 else q)[s] += 1.0
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    scale = 1.0 / np.sqrt(np.maximum(size, 1)).mean()     # one constant: keeps first steps small
    v, bias = np.zeros(len(used)), float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    # Both classes weigh the same in the loss.
    weight = np.where(y > 0, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, len(y) - y.sum()))
    m, s, mb, sb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for t in range(1, rounds + 1):
        each = v * ratio * scale
        z = np.array([each[s].sum() for s in sets]) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) * weight
        grad = np.zeros(len(used))
        for g, e in zip(sets, error.tolist()):
            grad[g] += e
        grad = grad * ratio * scale + penalty * v / len(used)
        gb = error.sum()
        m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * grad * grad
        mb, sb = 0.9 * mb + 0.1 * gb, 0.999 * sb + 0.001 * gb * gb
        step = rate * np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)
        v -= step * m / (np.sqrt(s) + 1e-10)
        bias -= step * mb / (np.sqrt(sb) + 1e-10)
    out = np.zeros(1 << BITS, np.float32)
    out[used] = v * ratio * scale
    return out, float(bias)


def train(spark: SparkSession, labelled: DataFrame, most: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Fit on ``labelled(id, t, y)``: at most ``most`` rows, those of least id
    hash, in one task.  The weights (fixed size) come to the driver."""
    sample = (labelled.filter("y is not null and t is not null").withColumn("h", F.xxhash64(F.lit(17), "id"))
              .orderBy("h", "id", "t", "y").limit(most).select("t", "y"))

    def run(batches):
        texts, labels = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            labels += batch.column(1).to_pylist()
        w, b = fit(texts, labels)
        at = np.flatnonzero(w).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array([at.tobytes()]), pa.array([w[at].tobytes()]), pa.array([b])], ["at", "w", "b"])

    weights, bias = np.zeros(1 << BITS, np.float32), NO_MODEL
    for row in sample.repartition(1).mapInArrow(run, "at binary, w binary, b double").collect():
        weights[np.frombuffer(row["at"], np.int32)] = np.frombuffer(row["w"], np.float32)
        bias = row["b"]
    return weights, bias


def score_texts(texts: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    z = np.array([float(weights[g].sum(dtype=np.float64)) for g in gram_sets(texts)]) + bias
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def score(spark: SparkSession, docs: DataFrame, weights: np.ndarray, bias: float, id_col: str = "doc_id", text_col: str = "text",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``id_col, *keep, score``: every row's whole text scored; a null text
    is an empty one.  The weights broadcast have a fixed size of ``2**BITS``."""
    shared = spark.sparkContext.broadcast((weights, bias))
    base = docs.select(*dict.fromkeys([id_col, *keep, text_col]))
    kept = [c for c in dict.fromkeys([id_col, *keep])]
    schema = ", ".join(f"`{c}` {base.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches):
        w, b = shared.value
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            _, offsets = utf8(column)
            for i, j in row_pieces(np.diff(offsets), BATCH_CHARS):
                texts = [t or "" for t in column.slice(i, j - i).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(batch.schema.get_field_index(c)).slice(i, j - i) for c in kept] + [pa.array(score_texts(texts, w, b))],
                    [*kept, "score"])

    return base.mapInArrow(run, schema + ", score double")


def held_out(doc_id):
    """The fifth of the ids that labels are never learned from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", keep: tuple[str, ...] = (), most: int = TRAIN_ROWS) -> DataFrame:
    """``id_col, *keep, held_out, score, predicted`` for every row of ``docs``.

    The classifier is fitted on a bounded sample of the labelled rows that are not
    held out; only texts and their labels enter it.  Null or empty texts have a
    score too; null labels and labels without a document are ignored; without any
    label every score is near 0.  Repeated rows each give a row, an empty table
    none; other columns are ignored.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter(~held_out(F.col("id")))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    # The sample is drawn from ids first, so that only its texts move.
    chosen = (known.filter("y is not null").join(texts.select("id").distinct(), "id", "left_semi").distinct()
              .withColumn("h", F.xxhash64(F.lit(17), "id")).orderBy("h", "id", "y").limit(most).select("id", "y"))
    weights, bias = train(spark, texts.join(chosen, "id"), 2 * most)
    out = score(spark, docs, weights, bias, id_col, text_col, keep)
    return (out.withColumn("held_out", held_out(F.col(id_col)))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
