"""Document fingerprints by consistent weighted sampling (DataFrame functions only).

A document is the weighted set of its words, the weight being the count.  For
each sample k and word, gamma-distributed r and c and a uniform b are derived
from the word's hash; the word of least ``c / (y e^r)`` with
``y = exp(r (t - b))``, ``t = floor(ln(weight) / r + b)`` is drawn, together with
t.  Two documents draw the same pair with a probability equal to the generalised
Jaccard similarity of their weights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, partitions, stored

SAMPLES = 40
GROUP = 2                    # samples of one row: the generated method stays small enough to be compiled
SPREAD = 2                   # partitions of whole texts for each shuffle partition: their words take several times the texts' memory
_SCALE = float(1 << 23)      # resolution of the logarithm that samples are compared by
_SHIFT = 128.0
_NONE = (1 << 63) - 1


def _uniform(h: Column, bit: int) -> Column:
    """20 bits of a hash, strictly between 0 and 1."""
    return (F.shiftrightunsigned(h, bit).bitwiseAND(F.lit(0xFFFFF)).cast("double") + 0.5) / float(1 << 20)


def _sample(r: Column, c: Column, b: Column, h: Column, log_weight: Column) -> Column:
    """ln of the value to be least (high bits) and the drawn (word, t) (low bits)."""
    t = F.floor(log_weight / r + b)
    value = c - r * (t - b + 1.0)
    return F.shiftleft(((value + _SHIFT) * _SCALE).cast("long"), 32).bitwiseOR(
        h.bitwiseXOR(t * F.lit(0x9E3779B1)).bitwiseAND(F.lit(0xFFFFFFFF)))


def signatures(terms: DataFrame, id_col: str, weights: tuple[str, ...], samples: int = SAMPLES, group: int = GROUP) -> DataFrame:
    """``terms(id, term long, *weights)`` -> ``id, part, <weight>_sig array<long>``:
    for each weight column the drawn samples of part ``part`` (``group`` of them).
    A null or zero weight is none.  The rows of an id should lie together."""
    d, first = terms, weights[0]
    for w in weights:
        ln = F.when(F.col(w) > 0, F.ln(F.col(w).cast("double")))
        # Most weights of a term are equal: their logarithm is that of the first.
        d = d.withColumn(f"ln_{w}", ln if w == first else F.when(F.col(w) == F.col(first), F.col(f"ln_{first}")).otherwise(ln))
    d = d.withColumn("part", F.explode(F.array([F.lit(p) for p in range(samples // group)])))
    for j in range(group):
        k = F.col("part") * group + j
        d = d.withColumn(f"h{j}", F.xxhash64("term", k)).withColumn(f"g{j}", F.xxhash64("term", k + samples))
    for j in range(group):
        h, g = F.col(f"h{j}"), F.col(f"g{j}")
        d = d.withColumn(f"r{j}", -F.ln(_uniform(h, 0) * _uniform(h, 20)))
        d = d.withColumn(f"c{j}", F.ln(-F.ln(_uniform(g, 0) * _uniform(g, 20))))
        d = d.withColumn(f"b{j}", _uniform(h, 40))
    cols = []
    for w in weights:
        for j in range(group):
            s = _sample(F.col(f"r{j}"), F.col(f"c{j}"), F.col(f"b{j}"), F.col(f"g{j}"), F.col(f"ln_{w}"))
            cols.append(F.min(s).alias(f"{w}_{j}"))
    out = d.groupBy(id_col, "part").agg(*cols)
    low = lambda c: F.coalesce(F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(0))
    return out.select(id_col, "part", *[F.array(*[low(f"{w}_{j}") for j in range(group)]).alias(f"{w}_sig") for w in weights])


def _hex(parts: Column) -> Column:
    """Samples of all parts in order, eight hexadecimal digits each."""
    return F.array_join(F.transform(F.flatten(parts), lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Part of the samples that two fingerprints share: the estimate of the
    generalised Jaccard similarity; null if either is null."""
    same = [(F.substring(a, 8 * k + 1, 8) == F.substring(b, 8 * k + 1, 8)).cast("int") for k in range(samples)]
    total = same[0]
    for s in same[1:]:
        total = total + s
    return total.cast("double") / float(samples)


def words(text: Column) -> Column:
    """Hashes of the words: runs of other than ASCII white space, A-Z lower-cased."""
    return F.filter(F.split(ascii_lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def with_next(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``rows(row, id, n, next)`` with the row after it by (id, text hash), the
    first one after the last.  Thin rows are range-partitioned; each partition
    finds its successors, and the first row of the next one closes it."""
    n = partitions(spark)
    thin = docs.repartitionByRange(n, "id", "row").withColumn("part", F.spark_partition_id())
    thin = stored(spark, thin, "order")          # a row's partition stays what it is
    first = thin.groupBy("part").agg(F.min(F.struct("id", "row")).alias("first"))
    parts = spark.range(n).select(F.col("id").cast("int").alias("part")).join(first, "part", "left")
    after = Window.orderBy("part").rowsBetween(1, Window.unboundedFollowing)      # one row per partition
    least = F.min("first").over(Window.partitionBy())
    parts = parts.select("part", F.coalesce(F.first("first", ignorenulls=True).over(after), least).alias("then"))
    inside = Window.partitionBy("part").orderBy("id", "row")
    return (thin.withColumn("next", F.lead("row").over(inside)).join(parts, "part")
            .select("row", "id", "n", F.coalesce("next", F.col("then.row")).alias("next")))


def fingerprints(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``
    for every row.

    The edited text has the last ``floor(n_chars / 4)`` code points replaced by the
    first as many (or all) of the next document's, by ascending id; the first one
    follows the last.  Rows of one id follow each other by a hash of their text,
    and count as one document if that is the same too.  A null text is empty; a
    text without words has a fingerprint of zeros.  A null id comes first.  An
    empty table gives no rows; other columns are ignored.

    Texts are shuffled once, by row; counting words and drawing samples need no
    further shuffle.  A word that occurs often is counted before it is hashed on.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("t"))
    base = base.withColumn("row", F.xxhash64(F.coalesce("id", F.lit(-1)), F.isnull("id"), "t"))
    thin = base.select("row", "id", F.char_length("t").cast("long").alias("n"))
    copies = thin.groupBy("row", "id", "n").count()          # rows repeated as a whole
    order = stored(spark, with_next(spark, copies.select("row", "id", "n")), "next")
    n = partitions(spark)
    # Every text once, by its row: joined with what the document before it takes, and with the head it takes itself.
    taken = order.select(F.col("next").alias("row"), F.col("row").alias("taker"), F.floor(F.col("n") / 4).alias("quarter"))
    one = base.select("row", "t").repartition(SPREAD * n, "row").dropDuplicates(["row"])
    heads = (one.join(taken, "row").select(F.col("taker").alias("row"), F.expr("substr(t, 1, int(quarter))").alias("head")))
    pair = (one.join(heads, "row").select("row", "t", "head", F.char_length("t").cast("long").alias("n"))
            .select("row", "n", "t", F.concat(F.expr("substr(t, 1, int(n - floor(n / 4)))"), "head").alias("e")))
    sides = pair.select("row", F.explode(F.array(
        F.struct(F.lit(1).alias("a"), F.lit(0).alias("b"), F.col("t").alias("x")),
        F.struct(F.lit(0).alias("a"), F.lit(1).alias("b"), F.col("e").alias("x")))).alias("s"))
    # A text without words has one null word of no weight, so every row has its samples.
    weight = lambda c: F.when(F.isnull("word"), 0).otherwise(F.col(c))
    terms = (sides.select("row", "s.a", "s.b", F.explode_outer(words(F.col("s.x"))).alias("word"))
             .select("row", weight("a").alias("a"), weight("b").alias("b"), F.xxhash64("word").alias("term"))
             .groupBy("row", "term").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    signs = (signatures(terms, "row", ("a", "b")).groupBy("row")
             .agg(F.sort_array(F.collect_list(F.struct("part", "a_sig", "b_sig"))).alias("p"))
             .select("row", _hex(F.col("p.a_sig")).alias("fingerprint"), _hex(F.col("p.b_sig")).alias("edited_fingerprint")))
    # The samples stand left: a merge join has them drawn, and their memory given back, before it looks at the texts again.
    facts = (signs.join(pair.select("row", "n", F.sha2(F.encode("e", "UTF-8"), 256).alias("edited_sha256")), "row")
             .select("row", "n", "edited_sha256", "fingerprint", "edited_fingerprint"))
    facts = stored(spark, facts, "fingerprints")
    after = facts.select(F.col("row").alias("next"), F.col("fingerprint").alias("next_fingerprint"))
    out = (order.select("row", "id", "next").join(copies.select("row", "count"), "row").join(facts, "row").join(after, "next")
           .withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), "count"))))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_chars"), "edited_sha256", "fingerprint", "edited_fingerprint",
                      likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                      likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
