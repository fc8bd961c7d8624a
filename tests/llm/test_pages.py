"""URL rules, HTML extraction, archives and fingerprints against brute force."""

import base64
import hashlib
import itertools
import math
import random
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import fingerprint, htmlcut, urlrules, warc

# -- URL rules -------------------------------------------------------------------


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def test_rules_against_every_rule(spark):
    rng = random.Random(1)
    labels = ["a", "b", "net", "org", "x-y"]
    rules = sorted({(".".join(rng.choice(labels) for _ in range(rng.randint(1, 4))), rng.choice(["/", "/e", "/en/", "/en/x/"])) for _ in range(60)})
    rules = [(h, p, rng.choice(["allow", "block"])) for h, p in rules]
    urls = [None, "", "no scheme", "http://", "://a.net/", "HTTP://A.Net/en/", "http://net?x=/en/", "http://net#/", "http://É.NET/a", "x://y://net/en/", "http://a.net./e",
            "http://net\n.a/e\n?", "http://a.b:80/en/"]
    urls += ["http://" + ".".join(rng.choice(labels) for _ in range(rng.randint(1, 5))) + rng.choice(["", "/", "/en/x/1", "/e", "/fr/?q", "/en/#a"]) for _ in range(400)]
    rows = [(i, u, "clash") for i, u in enumerate(urls)] + [(3, urls[20], "c"), (None, urls[21], "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = urlrules.judge_urls(spark, df, urlrules.rule_table(spark, rules)).collect()

    def judge(url):
        host, path = split_url(url)
        fit = [(len(h + p), len(p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *(max(fit)[2:] if fit else (None, "allow")))
    # rules of one host and path are unique here, so the longest rule is one
    assert sorted(map(str, [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got])) == sorted(map(str, [(i, *judge(u)) for i, u, _ in rows]))
    assert urlrules.judge_urls(spark, df.limit(0), urlrules.rule_table(spark, rules)).count() == 0


# -- HTML ------------------------------------------------------------------------

def cost(gain, edges, labels):
    own = sum(max(g, 0) if not x else max(-g, 0) for g, x in zip(gain, labels))
    return own + sum(c for i, j, c in edges if labels[i] != labels[j])


def test_cut_is_the_cheapest_labelling():
    rng = np.random.default_rng(3)
    for _ in range(150):
        n = int(rng.integers(1, 9))
        gain = rng.normal(0, 1, n)
        edges = [(int(a), int(b), float(rng.random())) for a, b in rng.integers(0, n, (2 * n, 2)) if a != b]
        best = min(cost(gain, edges, labels) for labels in itertools.product([False, True], repeat=n))
        assert cost(gain, edges, htmlcut.min_cut(gain, edges)) == pytest.approx(best)


PAGE = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><header><a href=/>Site name</a></header>"
        "<nav><ul><li><a href=a>Home</a><li><a href=b>News</a></ul></nav><!-- <p>no</p> --><div class='ad'>Buy this thing now, it is good.</div>"
        "<article><h1>A  title &amp; more</h1><p>First&nbsp;paragraph, with <b>bold<br>text</b> in it.<p>Second &#233; one is here."
        "<div class='ad'>Sponsored words in an article.</div><ul><li>An item of the text, in a list.</li></ul></article>"
        "<section id='comments'><p>I read this and liked it very much, thank you.</p></section><aside><p>Other stories, which you may like.</p></aside>"
        "<form><label>Name</label><textarea>typed</textarea></form><footer>&copy; Site, all rights.</footer></body></html>")


def test_main_text(spark):
    weights = htmlcut.train_weights([PAGE])
    want = "A title & more\nFirst paragraph, with bold text in it.\nSecond é one is here.\nAn item of the text, in a list."
    for w in (weights, htmlcut.PRIOR):
        assert htmlcut.main_text(PAGE, w) == want
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<p>" * 20_000 + "x"), (None, "u", "<a <b \"<" * 5000), (6, "u", "<!-- open <p>Some words of a paragraph, never shown.")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = htmlcut.extract(spark, df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id == 1] == [want, want] and all(r.text == "" for r in got if r.page_id in (2, 3, 6))
    assert htmlcut.extract(spark, df.limit(0)).count() == 0


# -- WARC ------------------------------------------------------------------------

def test_archives_come_back(spark, tmp_path):
    inner = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    html = ["<p>a</p>", "<p>a</p>", "", None, "é\r\n\r\nx", "x" * 300_000, "WARC/1.0\r\n", "a" + inner + inner + "b", inner, "WARC/1.0\r\n" * 9, "<p>a</p>"]
    rows = [(i + 1, "http://u/\r\nWARC/1.0\r\n%d" % i, h) for i, h in enumerate(html)] + [(3, None, ""), (None, "n", "<p>a</p>"), (1, "again", "<p>a</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).repartition(3)
    path = str(tmp_path / "w")
    warc.write_archives(spark, df, path)
    got = warc.read_archives(spark, path, payloads=True).collect()
    best = {}
    for i, _, h in rows:
        if i is not None:
            best[h or ""] = max(i, best.get(h or "", i))
    want = []
    for i, _, h in rows:
        h = h or ""
        first = i is None or best[h] == i
        digest = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        want.append((i, len(h.encode()), digest, "response" if first else "revisit", None if first else best[h], h if first else None))
    have = [(r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload) for r in got]
    assert sorted(map(str, have)) == sorted(map(str, want))
    assert all(r.intact for r in got)


def test_small_splits_and_empty_table(spark, tmp_path):
    rows = [(i, "u", "WARC/1.0\r\nContent-Length: %d\r\n\r\n" % (i * 7) + "y" * (i % 50)) for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = str(tmp_path / "w")
    warc.write_archives(spark, df.coalesce(1), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
    try:
        got = warc.read_archives(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.id, r.payload_bytes) for r in got) == [(i, len(h)) for i, _, h in rows] and all(r.intact for r in got)
    warc.write_archives(spark, df.limit(0), str(tmp_path / "e"))
    assert warc.read_archives(spark, str(tmp_path / "e")).count() == 0


# -- fingerprints ------------------------------------------------------------------

def brute_fingerprint(text):
    """The samples computed word by word."""
    counts = {}
    for w in text.encode().lower().split():
        term = struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(w, 42)))[0]
        counts[term] = counts.get(term, 0) + 1
    out = []
    for k in range(fingerprint.SAMPLES):
        best = None
        for term, weight in counts.items():
            # the term hashed, then the sample number with that hash as seed
            seed = xxhash.xxh64_intdigest(struct.pack("<q", term), 42)
            h, g = (xxhash.xxh64_intdigest(struct.pack("<i", n), seed) for n in (k, k + fingerprint.SAMPLES))
            u = lambda x, bit: ((x >> bit & 0xFFFFF) + 0.5) / (1 << 20)
            r, c, b = -math.log(u(h, 0) * u(h, 20)), math.log(-math.log(u(g, 0) * u(g, 20))), u(h, 40)
            t = math.floor(math.log(weight) / r + b)
            value = int((c - r * (t - b + 1) + 128) * (1 << 23)) << 32 | (g ^ (t * 0x9E3779B1)) & 0xFFFFFFFF
            best = value if best is None else min(best, value)
        out.append(0 if best is None else best & 0xFFFFFFFF)
    return "".join("%08x" % x for x in out)


def test_fingerprints_against_brute_force(spark):
    rng = random.Random(2)
    words = ["w%d" % i for i in range(60)] + ["É", "🙂"]
    rows = [(i * 2, " ".join(rng.choice(words) for _ in range(rng.randint(0, 120)))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, rows[4][1]), (103, "one")]
    df = spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id long, text string, n int")
    got = {r.doc_id: r for r in fingerprint.fingerprints(spark, df).collect()}
    rows.sort()
    texts = [t or "" for _, t in rows]
    same = lambda a, b: np.mean([a[i:i + 8] == b[i:i + 8] for i in range(0, len(a), 8)])
    for n, (i, _) in enumerate(rows):
        text, after = texts[n], texts[(n + 1) % len(texts)]
        q = len(text) // 4
        edited = text[:len(text) - q] + after[:q]
        r, fp = got[i], brute_fingerprint(text)
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == fp and r.edited_fingerprint == brute_fingerprint(edited)
        assert r.near_edited == pytest.approx(same(fp, brute_fingerprint(edited))) and r.near_next == pytest.approx(same(fp, brute_fingerprint(after)))


def test_collisions_estimate_generalised_jaccard(spark):
    rng = random.Random(6)
    rows, want = [], {}
    for i in range(60):
        a = [rng.randint(0, 5) for _ in range(40)]
        b = [max(0, x + rng.choice([0, 0, 1, -1, 3])) for x in a]
        rows += [(i, t, a[t], b[t]) for t in range(40)]
        want[i] = sum(map(min, a, b)) / sum(map(max, a, b))
    df = spark.createDataFrame(rows, "id long, term long, a long, b long")
    got = {}
    for r in fingerprint.signatures(df, "id", ("a", "b")).collect():
        got.setdefault(r.id, []).extend(x == y for x, y in zip(r.a_sig, r.b_sig))
    assert abs(np.mean([np.mean(v) for v in got.values()]) - np.mean(list(want.values()))) < 0.03


def test_samples_are_drawn_before_the_texts_are_held_again(spark, monkeypatch):
    kept, stored, merge = {}, fingerprint.stored, "spark.sql.autoBroadcastJoinThreshold"
    monkeypatch.setattr(fingerprint, "stored", lambda spark, df, name: kept.setdefault(name, df) and stored(spark, df, name))
    before = spark.conf.get(merge)
    spark.conf.set(merge, "-1")
    try:
        df = spark.createDataFrame([(1, "a b c d"), (2, ""), (3, "e f")], "doc_id long, text string")
        got = {r.doc_id: r for r in fingerprint.fingerprints(spark, df).collect()}
        plan = kept["fingerprints"]._jdf.queryExecution().simpleString()
    finally:
        spark.conf.set(merge, before)
    assert got[2].fingerprint == got[2].edited_fingerprint == "0" * 8 * fingerprint.SAMPLES
    joins = [x for x in plan.splitlines() if "SortMergeJoin" in x]
    assert len(joins) == 5 and "Inner" in joins[0]       # the samples' own, and two for each look at the texts
    assert plan.index("ObjectHashAggregate") < plan.index("sha2(")
    assert f"{fingerprint.SPREAD * int(spark.conf.get('spark.sql.shuffle.partitions'))}), REPARTITION_BY_NUM" in plan


def test_repeated_rows_null_ids_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "x y"), (2, "a b"), (2, "c")], "doc_id long, text string")
    got = fingerprint.fingerprints(spark, df).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 1, 2, 2]
    assert len({(r.fingerprint, r.near_next) for r in got if r.doc_id == 1}) == 1
    assert fingerprint.fingerprints(spark, df.limit(0)).count() == 0


@pytest.mark.parametrize("html,texts", [
    ("<p>a <svg/> b goes on.</p><p>More.</p>", ["a b goes on.", "More."]),
    ("<p>x</p><noscript><p>y z</p>", ["x", "y z"]),
    ("<p>x</p><video src=x><p>y</p><video>gone</video>z", ["x", "z"]),
    ("<p>x</p><VIDEO src=x><p>y</p>", ["x", "y"]),
    ("<p>x</p><script>var a = '<p>no</p>';", ["x"]),
    ("<option>one<option>two<p>three</p>", ["one two", "three"]),
    ("a<style>b</style >c<iframe></iframe>d", ["a c d"])])
def test_dropped_elements_take_no_other_text(html, texts):
    assert [" ".join(b.text.split()) for b in htmlcut.blocks(html)] == texts


@pytest.mark.parametrize("names,said", [
    ("side-note", 0), ("share-of-market", 0), ("sidebar-left", -1), ("social-share", -1), ("ad-slot", -1), ("post-content", 1), ("entry", 1),
    ("widget wide", -1), ("story related", -1), ("main", 1), ("", 0), ("cookie_notice__inner", -1), ("commentary", 0)])
def test_names_speak_by_all_their_words(names, said):
    assert htmlcut._said(names) == said


def test_ordinary_names_leave_an_article_whole():
    body = "".join(f"<p class='side-note'>Sentence {i} of the article says a little more than the one before it.</p>" for i in range(6))
    page = f"<nav><a href=x>Home</a></nav><article><div id=share-of-market>{body}</div></article><footer>Copyright 2020</footer>"
    found = htmlcut.blocks(page)
    assert [b.names for b in found if b.text.startswith("Sentence")] == [0] * 6
    assert [b.place for b in found if b.text.startswith("Sentence")] == [1] * 6
