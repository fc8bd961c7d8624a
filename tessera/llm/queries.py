"""The operators as queries over the driver tables, with their oracle SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, fingerprint, htmlcut, minhash, negatives, periodic, pii, secretscan, sentencepiece, spans, toxicity, urlrules, warc
from tessera.llm.common import read

# Vocabulary file of a public tokenizer; any SentencePiece model file can be named.
# Scores of a file that is no unigram model are replaced by those of the documents.
TOKENIZER = os.environ.get("TESSERA_SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


@query("op1_minhash_dedup", """
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) = 1 THEN [w[1]]
        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
hits AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM hits JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE c * 100 >= 80 * (p.n + q.n - c)),
two AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, b.y FROM reach r JOIN two b ON b.x = r.y),
least AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN least l ON l.doc_id = d.doc_id
""")
def op1(spark, sf_dir):
    """Near-duplicate groups of ``documents``."""
    return minhash.near_duplicates(spark, read(spark, sf_dir, "documents"), words=2, percent=80)


@query("op5_url_filters", """
WITH u AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*(/[^?#]*)', 1) AS path FROM pages),
r(rule_host, rule_path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f AS (SELECT host, path, rule_host || rule_path AS rule, verdict,
        row_number() OVER (PARTITION BY host, path ORDER BY length(rule_host || rule_path) DESC, length(rule_path) DESC) AS k
      FROM (SELECT DISTINCT host, path FROM u) JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM u LEFT JOIN f ON f.host = u.host AND f.path = u.path AND f.k = 1
""")
def op5(spark, sf_dir):
    """Verdict of every page url."""
    return urlrules.judge_urls(spark, read(spark, sf_dir, "pages"), urlrules.rule_table(spark, urlrules.RULES))


@query("op10_warc")
def op10(spark, sf_dir):
    """``pages`` written to archives and read back."""
    path = warc.archive_folder(spark)
    warc.write_archives(spark, read(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


@query("op3_toxicity")
def op3(spark, sf_dir):
    """Toxicity score of every document."""
    return toxicity.classify(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op4_substring_dedup", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^.!?\n]*[.!?\n]+[ \t\r\n]*|[^.!?\n]+') AS p FROM documents),
q AS (SELECT doc_id, p, list_transform(p, lambda x: list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS w FROM d),
r(n, least) AS (VALUES (3, 8), (2, 25), (1, 50)),
l AS (SELECT doc_id, i, c, sum(c) OVER (PARTITION BY doc_id ORDER BY i) AS upto
      FROM (SELECT doc_id, unnest(range(1, len(p) + 1)) AS i, unnest(list_transform(w, lambda x: len(x))) AS c FROM q)),
z AS (SELECT doc_id, i, upto, upto - c AS before, upto - 25 AS most, upto - c + 25 AS least FROM l WHERE c > 0),
s AS (
  SELECT doc_id, i, n FROM (SELECT doc_id, n, least, w, unnest(range(1, len(p) - n + 2)) AS i FROM q, r WHERE len(p) >= n)
  WHERE list_sum(list_transform(w[i:i + n - 1], lambda x: len(x))) >= least
  UNION SELECT a.doc_id, a.i, b.i - a.i + 1 FROM z a ASOF JOIN z b ON a.doc_id = b.doc_id AND a.least <= b.upto
  UNION SELECT a.doc_id, b.i, a.i - b.i + 1 FROM z a ASOF JOIN z b ON a.doc_id = b.doc_id AND a.most >= b.before),
t AS (SELECT doc_id, n, i, array_to_string(list_transform(w[i:i + n - 1], lambda x: array_to_string(x, ' ')), chr(10)) AS g
      FROM s JOIN q USING (doc_id)),
f AS (SELECT g, min((doc_id, i)) AS first, count(*) AS c FROM t GROUP BY g HAVING count(*) > 1),
c AS (SELECT t.doc_id, t.n, t.i, (f.first)[1] AS src FROM t JOIN f ON f.g = t.g WHERE (t.doc_id, t.i) <> f.first),
k AS (SELECT doc_id, list(DISTINCT j) AS js FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM c) GROUP BY 1),
o AS (SELECT doc_id, min(src)::BIGINT AS first_source, count(DISTINCT src)::BIGINT AS n_sources FROM c GROUP BY 1)
SELECT d.doc_id, len(p)::BIGINT AS n_sentences, coalesce(len(js), 0)::BIGINT AS n_removed,
  sha256(array_to_string(list_transform(list_filter(range(1, len(p) + 1), lambda j: NOT list_contains(coalesce(js, []), j)), lambda j: p[j]), '')) AS text_sha256,
  first_source, coalesce(n_sources, 0)::BIGINT AS n_sources
FROM d LEFT JOIN k ON k.doc_id = d.doc_id LEFT JOIN o ON o.doc_id = d.doc_id
""")
def op4(spark, sf_dir):
    """Documents without sentences of repeated runs."""
    out = spans.dedup_spans(spark, read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_sentences", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"),
                      F.try_element_at("sources", F.lit(1)).alias("first_source"),
                      F.coalesce(F.size("sources"), F.lit(0)).cast("long").alias("n_sources"))


@query("op9_benchmark_decontamination")
def op9(spark, sf_dir):
    """Benchmark passages in documents."""
    return decontam.find_passages(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op2_sentencepiece")
def op2(spark, sf_dir):
    """Documents encoded and decoded; the digest of the ids, and whether the text came back."""
    docs = read(spark, sf_dir, "documents")
    out = sentencepiece.roundtrip(spark, docs, sentencepiece.unigram_model(spark, docs, TOKENIZER))
    return out.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), "n_bytes",
                      F.sha2(F.encode(F.array_join("tokens", ","), "UTF-8"), 256).alias("tokens_sha256"), "same")


@query("op7_document_fingerprints")
def op7(spark, sf_dir):
    """Fingerprints of the documents and of their edited texts."""
    return fingerprint.fingerprints(spark, read(spark, sf_dir, "documents"))


@query("op8_pii")
def op8(spark, sf_dir):
    """Personal data in every document."""
    return pii.find(spark, read(spark, sf_dir, "documents"))


@query("op6_html_extraction")
def op6(spark, sf_dir):
    """Main text of every page."""
    return htmlcut.extract(spark, read(spark, sf_dir, "pages"))


@query("op11_periodic_runs")
def op11(spark, sf_dir):
    """Periodic runs of words of every document, one in ten of them made periodic."""
    out = periodic.find_runs(periodic.with_period(read(spark, sf_dir, "documents")))
    best = periodic.longest_lived(F.col("runs"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    out = out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                     F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                     F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                      F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
                      "runs_sha256", "collapsed_sha256")


def _secret_sql() -> str:
    """Spans of every rule from the texts between its matches; one arm for each rule."""
    arm = """SELECT doc_id, {k} AS k, '{kind}' AS kind, unnest(range(1, len(m) + 1)) AS i, m, gaps, v FROM (SELECT doc_id,
      regexp_extract_all(t, '{p}', 0) AS m, regexp_split_to_array(t, '{p}') AS gaps, regexp_extract_all(t, '{p}', {group}) AS v FROM d)"""
    arms = [arm.format(k=k, kind=r.kind, p=r.pattern.replace("'", "''"), group=r.group) for k, r in enumerate(secretscan.RULES)]
    least = " ".join(f"WHEN {k} THEN {r.least}" for k, r in enumerate(secretscan.RULES))
    base = ", ".join(str(k) for k, r in enumerate(secretscan.RULES) if r.base)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secretscan.RULES if r.base)
    names = ", ".join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in secretscan.RULES if r.base)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
a AS ({" UNION ALL ".join(arms)}),
s AS (SELECT doc_id, k, kind, length(m[i]) AS n,
        list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS b
      FROM a WHERE length(v[i]) >= CASE k {least} END),
g AS (SELECT doc_id, {counts},
        string_agg(kind || ':' || b::BIGINT || ':' || (b + n)::BIGINT, ',' ORDER BY b, k) FILTER (k IN ({base})) AS base,
        string_agg(kind || ':' || b::BIGINT || ':' || (b + n)::BIGINT, ',' ORDER BY b, k) AS spans FROM s GROUP BY doc_id)
SELECT d.doc_id, {names}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (doc_id)"""


@query("op13_secret_scans", _secret_sql())
def op13(spark, sf_dir):
    """Secrets in every document."""
    out = secretscan.scan(spark, read(spark, sf_dir, "documents"))
    base = [r.kind for r in secretscan.RULES if r.base]

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in base]
    return out.select("doc_id", *counts, F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
                      joined(F.col("spans")).alias("spans"))


@query("op12_hard_negatives", """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
      FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) QUALIFY rank <= 5
""")
def op12(spark, sf_dir):
    """Hard negatives of every hundredth vector."""
    rows = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.quantised(rows.withColumn("label", label), "vec_id", "label", "embedding", 256)
    return negatives.mine(spark, rows, F.col("id") % 100 == 0)
