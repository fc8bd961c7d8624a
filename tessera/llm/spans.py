"""Exact substring deduplication over runs of consecutive sentences.

Every run of several sentences is hashed, runs are joined globally, and the
sentences that a repeated run covers go from all documents but the first.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import stored

# Sentences partition the text: up to and with a run of end marks or line ends
# and the white space after it.
SENTENCE = r"[^.!?\n]*[.!?\n]+[ \t\r\n]*|[^.!?\n]+"
# (sentences, least words) of the runs that are hashed.  Runs of fewer sentences
# count only when they are long, so that passages of few long sentences are found.
RUNS = ((3, 8), (2, 25), (1, 50))
# Besides, from and up to every sentence as many as hold so many words, whatever their
# number, so that lists of short lines and single whole sentences are found.
GROW = 25
_SENTENCE = re.compile(SENTENCE)
_BLANK = re.compile(r"[\x20\x09-\x0D]+")


def sentences(text: str | None) -> list[str]:
    return _SENTENCE.findall(text or "")


def _grown(total: list[int], least: int) -> list[tuple[int, int]]:
    """(first sentence, sentences) of the shortest runs of ``least`` words from and up
    to every sentence with words; ``total`` counts the words before each sentence."""
    found, n = set(), len(total) - 1
    end = begin = 0
    for i in range(n):
        if total[i + 1] > total[i]:
            while end < n and total[end] - total[i] < least:
                end += 1
            if total[end] - total[i] >= least:
                found.add((i, end - i))
    for end in range(1, n + 1):
        if total[end] > total[end - 1]:
            while total[end] - total[begin + 1] >= least:
                begin += 1
            if total[end] - total[begin] >= least:
                found.add((begin, end - begin))
    return sorted(found)


def runs(parts: list[str], rules=RUNS, grow: int | None = GROW):
    """(first sentence, sentences, 128-bit hash) of every run; white space within it does not matter."""
    words = [[w for w in _BLANK.split(p) if w] for p in parts]
    plain = [" ".join(w).encode("utf-8", "surrogatepass") for w in words]
    total = [0]
    for w in words:
        total.append(total[-1] + len(w))
    for n, least in rules:
        for i in range(len(parts) - n + 1):
            if total[i + n] - total[i] >= least:
                yield i, n, xxhash.xxh3_128_digest(b"\n".join(plain[i:i + n]))
    hashed = dict(rules)
    for i, n in _grown(total, grow) if grow else ():
        if n not in hashed or total[i + n] - total[i] < hashed[n]:
            yield i, n, xxhash.xxh3_128_digest(b"\n".join(plain[i:i + n]))


def _spans(rules, grow):
    def run(batches):
        for batch in batches:
            which, at, size, hashes = [], [], [], []

            def flush():
                keys = batch.select(["id", "h1", "h2"]).take(pa.array(which, pa.int32()))
                made = pa.RecordBatch.from_arrays([*keys.columns, pa.array(at, pa.int32()), pa.array(size, pa.int32()),
                                                   pa.array(hashes, pa.binary())], ["id", "h1", "h2", "at", "n", "hash"])
                for column in (which, at, size, hashes):
                    column.clear()
                return made

            for k, text in enumerate(batch.column("t")):
                for i, n, h in runs(sentences(text.as_py()), rules, grow):
                    which.append(k)
                    at.append(i)
                    size.append(n)
                    hashes.append(h)
                if len(at) > 20_000:
                    yield flush()
            yield flush()
    return run


def _cut(batches):
    """Texts without the covered sentences."""
    for batch in batches:
        n, removed, texts = [], [], []
        for text, covered in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            parts = sentences(text)
            gone = set(covered or ())
            n.append(len(parts))
            removed.append(len(gone))
            texts.append("".join(p for i, p in enumerate(parts) if i not in gone))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                          pa.array(texts, pa.string()), batch.column(3)],
                                         ["id", "n_sentences", "n_removed", "text", "sources"])


def dedup_spans(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RUNS,
                grow: int | None = GROW) -> DataFrame:
    """``id_col, n_sentences, n_removed, text, sources``, one row per input row:
    the text without the sentences that a repeated run covers, and the ids of the
    documents that hold those runs first (its own id where a text repeats itself).

    A row is named by its id and a 128-bit hash of its text, so that each text of an id,
    or of no id, is cut at its own sentences; rows that are equal in both count as one
    and are cut alike.  The first of equal runs is that of the least (id, text hash,
    position), a null id before all others; it stays.  Null or empty texts have no
    sentences; an empty table gives no rows; other columns are ignored.  Without
    ``grow`` only the runs of ``rules`` count.  A run of any number of occurrences costs
    a partial minimum and a join that the planner can split; no group is gathered.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    base = base.select("id", F.xxhash64("t").alias("h1"), F.xxhash64(F.lit(1), "t").alias("h2"), "t")
    key = ["id", "h1", "h2"]
    place = F.struct(*key, "at")
    spans = base.mapInArrow(_spans(rules, grow), "id long, h1 long, h2 long, at int, n int, hash binary")
    again = spans.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last")
    again = stored(spark, again.select("hash", "first"), "repeated")
    covers = spans.join(again, "hash").filter(~place.eqNullSafe(F.col("first")))
    marks = (covers.select(*key, F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)).alias("at"), F.col("first.id").alias("source"))
             .groupBy(*key).agg(F.collect_set("at").alias("covered"), F.sort_array(F.collect_set("source")).alias("sources")))
    marks = stored(spark, marks, "covered").select(F.col("id").alias("marked"), F.col("h1").alias("m1"), F.col("h2").alias("m2"), "covered", "sources")
    rows = base.join(marks, (F.col("h1") == F.col("m1")) & (F.col("h2") == F.col("m2")) & F.col("id").eqNullSafe(F.col("marked")), "left")
    return (rows.select("id", "t", "covered", "sources")
            .mapInArrow(_cut, "id long, n_sentences long, n_removed long, text string, sources array<long>")
            .withColumnRenamed("id", id_col))
