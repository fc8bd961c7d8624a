"""WARC archives: writing, and reading by boundary-chain verification.

Archives are written as uncompressed WARC/1.0 files through Spark's file writer
(tasks can be retried; only committed files count).  Reading splits files at the
magic, wherever it occurs; each piece is a candidate record that names the offset
of its successor.  Pointer jumping from the start of the file keeps the records
of the chain, so a magic inside a payload is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored
from tessera.session import shared_dir

# Fixed values of the format.
MAGIC = "WARC/1.0\r\n"
RECORD_END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(text: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a text's UTF-8 bytes: 20 bits at a time."""
    digest = F.sha1(F.encode(text, "UTF-8"))
    parts = [F.lpad(F.conv(F.substring(digest, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _field(name: str, value: Column) -> Column:
    """A header line; a null value has none.  Line ends in a value are escaped."""
    value = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_archives(spark: SparkSession, pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """One record per row.  Of the records with equal payloads of at least
    ``least_bytes`` bytes the one of the largest id is a response, the others are
    revisits without payload that refer to it; smaller ones are all responses.
    Among rows of equal id and payload all but the id's are alike: they are all
    responses.  A null html is an empty payload; rows of null id are responses.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    marks = rows.select("id", F.octet_length("html").cast("long").alias("bytes"), base32_sha1(F.col("html")).alias("digest"))
    marks = stored(spark, marks.filter(f"bytes >= {least_bytes} and id is not null"), "digests")
    groups = marks.groupBy("digest").agg(F.max("id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    revisits = stored(spark, marks.join(groups, "digest").filter("id <> first")
                      .groupBy("id", F.col("digest").alias("of")).agg(F.max("first").alias("first")), "revisits")
    # Only revisits are joined to the pages; Spark broadcasts their table where it is small.
    rows = (rows.withColumn("digest", base32_sha1(F.col("html")))
            .join(revisits, (rows["id"] == revisits["id"]) & (F.col("digest") == F.col("of")), "left").drop(revisits["id"]))
    seen = F.col("first").isNotNull()
    body = F.when(seen, F.lit("")).otherwise(F.concat(F.lit(HTTP_HEAD), F.col("html")))
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    head = F.concat(
        F.lit(MAGIC), _field("WARC-Type", F.when(seen, F.lit("revisit")).otherwise(F.lit("response"))),
        _field("WARC-Record-ID", F.coalesce(urn(F.col("id")), F.lit("<urn:page:>"))), _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.col("url")), _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _field("X-Payload-Length", F.octet_length("html").cast("string")),
        _field("WARC-Refers-To", urn(F.col("first"))),
        _field("WARC-Profile", F.when(seen, F.lit(REVISIT_PROFILE))),
        _field("Content-Type", F.when(~seen, F.lit("application/http; msgtype=response"))),
        _field("Content-Length", F.octet_length(body).cast("string")), F.lit("\r\n"))
    # The writer ends every row with the two line ends that end a record.
    rows.select(F.concat(head, body).alias("value")).write.option("lineSep", RECORD_END).text(path)


def _head(value: Column) -> Column:
    return F.substring_index(value, RECORD_END, 1)


def _successor(value: Column) -> Column:
    """Bytes from the magic to the next record: magic, head, empty line, content, record end."""
    length = F.regexp_extract(_head(value), r"(?:^|\r\n)Content-Length: ([0-9]{1,18})(?:\r\n|$)", 1)
    whole = (F.instr(value, RECORD_END) > 0) & (length != "")
    return F.when(whole, F.octet_length(_head(value)).cast("long") + length.cast("long") + len(MAGIC) + 2 * len(RECORD_END))


def _payload(value: Column) -> Column:
    """Payload of a complete record: its content without the HTTP head."""
    size = F.length(_head(value)) + F.lit(len(RECORD_END))
    content = F.substr(value, size + 1, F.length(value) - size - len(RECORD_END))
    return F.when(F.instr(_head(value), "application/http") > 0,
                  F.substr(content, F.instr(content, RECORD_END) + len(RECORD_END))).otherwise(content)


def candidates(spark: SparkSession, path: str, payloads: bool = False, only: DataFrame | None = None) -> DataFrame:
    """``file, start, next, head, digest, payload_bytes, value``: every piece that
    follows a magic, its offset, and the offset where its own length says that the
    next record starts (null: it has no record head).

    Files are read in splits, and once; offsets are running sums of the lengths.
    Digest and length are those of the payload if the piece is a whole record;
    ``value`` is the piece's text (with ``payloads``).  ``only(file)`` names the files to keep.
    """
    value = F.col("value")
    size = F.octet_length(value).cast("long") + F.lit(len(MAGIC))
    raw = (spark.read.schema("value string").option("lineSep", MAGIC).text(path)
           .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("row"))
           .withColumn("size", size).withColumn("span", _successor(value)))
    if only is not None:
        raw = raw.join(only, "file", "left_semi")
    full = F.coalesce(F.col("size") == F.col("span"), F.lit(False))
    raw = raw.withColumn("full", full).withColumn("payload", F.when(full, _payload(value)))
    raw = stored(spark, raw.select(
        "file", "block", "row", "size", "span", F.when(F.col("span").isNotNull(), _head(value)).alias("head"),
        F.when(F.col("full"), base32_sha1(F.col("payload"))).alias("digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        (value if payloads else F.lit(None).cast("string")).alias("value")), "pieces")
    # What precedes the first magic is a piece too (empty in a sound file).
    order = Window.partitionBy("file").orderBy("block", "row")
    thin = raw.select("file", "block", "row", "size", "span")
    thin = (thin.withColumn("end", F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("k", F.row_number().over(order)).filter("k > 1")
            .withColumn("start", F.col("end") - len(MAGIC)).withColumn("next", F.col("start") + F.col("span"))
            .select("file", "block", "row", "start", "next"))
    rest = raw.select("file", "block", "row", "head", "digest", "payload_bytes", "value")
    return stored(spark, thin.join(rest, ["file", "block", "row"]).drop("block", "row"), "candidates")


def chain(spark: SparkSession, cands: DataFrame) -> DataFrame:
    """``file, start``: the candidates reachable from offset 0 of their file.

    Candidates that name their neighbour as successor make a run; a run also
    starts wherever the successor of another candidate lands.  Runs are entered at
    their heads only, and pointer jumping goes over runs: in files without a magic
    in payloads there is one run, and nothing to jump.
    """
    order = Window.partitionBy("file").orderBy("start")
    c = (cands.select("file", "start", "next").withColumn("adjacent", F.lead("start").over(order))
         .withColumn("follows", F.coalesce(F.lag("next").over(order) == F.col("start"), F.lit(False))))
    jumps = c.filter("next <> adjacent").select("file", F.col("next").alias("start"), F.lit(True).alias("target")).distinct()
    c = c.join(jumps, ["file", "start"], "left")
    head = (~F.col("follows") | F.coalesce("target", F.lit(False))).cast("long")
    c = stored(spark, c.withColumn("run", F.sum(head).over(order.rowsBetween(Window.unboundedPreceding, 0)))
               .select("file", "start", "next", "run"), "runs")
    runs = c.groupBy("file", "run").agg(F.min("start").alias("head"), F.max_by("next", "start").alias("next"))
    reached = runs.filter("head = 0").select("file", "head")
    most = runs.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    jump = (runs.select("file", "head", "next")
            .join(runs.select("file", F.col("head").alias("next")), ["file", "next"], "left_semi"))
    for _ in range(max(0, int(most - 1).bit_length())):
        jump = stored(spark, jump.select("file", "head", "next"), "jumps")
        further = reached.join(jump, ["file", "head"]).select("file", F.col("next").alias("head"))
        reached = stored(spark, reached.unionByName(further).distinct(), "reached")
        then = jump.select("file", F.col("head").alias("next"), F.col("next").alias("then"))
        jump = jump.join(then, ["file", "next"]).select("file", "head", F.col("then").alias("next"))
    kept = runs.join(reached, ["file", "head"], "left_semi").select("file", "run")
    return c.join(kept, ["file", "run"], "left_semi").select("file", "start")


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """``file, start, record_type, id, url, payload_digest, payload_bytes, refers_to, intact``
    (and ``payload`` if asked for): the records of the verified chains.

    ``id`` and ``refers_to`` are null for names that are no page ids.  ``intact``
    says whether the digest of the payload that was read is the recorded one
    (true for revisits, which have none).  A record whose payload holds the magic
    is put together from its pieces.  An empty folder gives no rows.
    """
    cands = candidates(spark, path, payloads)
    real = chain(spark, cands).withColumn("real", F.lit(True))
    marked = cands.join(real, ["file", "start"], "left")
    order = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    # Files with a record in several pieces are read again for the texts of all their pieces.
    broken = stored(spark, marked.filter("real and digest is null").select("file").distinct(), "broken")
    pieces = marked
    if broken.head(1) and not payloads:
        texts = candidates(spark, path, True, broken).select("file", "start", "value")
        pieces = marked.drop("value").join(texts, ["file", "start"])
    owned = pieces.withColumn("owner", F.last(F.when(F.col("real"), F.col("start")), ignorenulls=True).over(order)).filter("owner is not null")
    # Records in several pieces; what lies beyond the end of the record is not of it.
    ends = marked.filter("real and digest is null").select("file", F.col("start").alias("owner"), F.col("next").alias("upto"))
    parts = owned.join(ends, ["file", "owner"]).filter("start < upto")
    joined = (parts.groupBy("file", F.col("owner").alias("start"))
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "value"))), lambda p: p["value"]), MAGIC).alias("whole")))
    rows = marked.filter("real").join(joined, ["file", "start"], "left")
    whole = F.coalesce("whole", "value")
    body = _payload(whole)
    rows = rows.withColumn("digest", F.coalesce("digest", base32_sha1(body))).withColumn(
        "payload_bytes", F.coalesce("payload_bytes", F.octet_length(body).cast("long")))
    field = lambda name, pattern: F.nullif(F.regexp_extract("head", rf"(?:^|\r\n){name}: {pattern}(?:\r\n|$)", 1), F.lit(""))
    kind, said = field("WARC-Type", r"(\w+)"), field("WARC-Payload-Digest", r"sha1:(\w+)")
    revisit = kind == "revisit"
    out = ["file", "start", kind.alias("record_type"), field("WARC-Record-ID", r"<urn:page:(-?\d+)>").cast("long").alias("id"),
           field("WARC-Target-URI", r"([^\r\n]*)").alias("url"), said.alias("payload_digest"),
           F.when(revisit, field("X-Payload-Length", r"(\d+)").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
           field("WARC-Refers-To", r"<urn:page:(-?\d+)>").cast("long").alias("refers_to"),
           (revisit | (F.col("digest") == said)).alias("intact")]
    return rows.select(*out, *([F.when(~revisit, body).alias("payload")] if payloads else []))


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives in the shared folder."""
    return shared_dir(spark, "llm", "warc")
