"""SentencePiece, toxicity, decontamination and PII against brute force."""

import hashlib
import random
import re
import struct
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import decontam, pii, sentencepiece, toxicity
from tessera.llm.common import PUNCT_TABLE, utf8, word_hashes, word_spans

# -- SentencePiece -------------------------------------------------------------


def model_bytes(pieces):
    """A model file of (piece, score, type)."""
    def varint(n):
        out = b""
        while True:
            out += bytes([n & 0x7F | (0x80 if n > 0x7F else 0)])
            n >>= 7
            if not n:
                return out
    out = b""
    for text, score, kind in pieces:
        raw = text.encode()
        body = b"\x0a" + varint(len(raw)) + raw + b"\x15" + struct.pack("<f", score) + b"\x18" + varint(kind)
        out += b"\x0a" + varint(len(body)) + body
    return out


BYTES = [("<unk>", 0.0, 2), ("<s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]


def random_model(seed):
    rng = random.Random(seed)
    texts = {"".join(rng.choice("abc▁") for _ in range(rng.randint(1, 4))) for _ in range(40)} | {"a", "b", "▁"}
    texts = {t for t in texts if "▁" not in t.lstrip("▁")}
    return BYTES + [(t, -rng.randint(1, 400) / 16, 1) for t in sorted(texts)]


def best_score(model, marked):
    """Greatest total score of any segmentation, by trying every piece at every place."""
    table = {p: model.score[i] for i, p in enumerate(model.pieces) if i >= 258}
    best = [0.0] + [None] * len(marked)
    for end in range(1, len(marked) + 1):
        options = [best[a] + table[marked[a:end]] for a in range(end) if marked[a:end] in table]
        if marked[end - 1] not in table:
            options.append(best[end - 1] + model.unknown_score)
        best[end] = max(options)
    return best[-1]


@pytest.mark.parametrize("seed", range(4))
def test_segmentation_is_the_best_one(seed):
    model = sentencepiece.Model(model_bytes(random_model(seed)))
    rng = random.Random(seed + 100)
    texts = ["".join(rng.choice("abc ab dé") for _ in range(rng.randint(0, 90))) for _ in range(60)] + ["", " ", "a  b", "c" * 300 + "é" * 3]
    ids, bounds = model.encode_all(texts)
    for text, a, b in zip(texts, bounds[:-1], bounds[1:]):
        got = ids[a:b].tolist()
        assert model.decode(got) == text
        if text:
            fallback = {c for c in text.replace(" ", "▁") if c not in model.pieces}
            total = sum(model.score[i] for i in got if i >= 258) + sum(model.unknown_score for c in "▁" + text.replace(" ", "▁") if c in fallback)
            assert total == pytest.approx(best_score(model, "▁" + text.replace(" ", "▁")))


def test_long_words_do_not_depend_on_the_blocks(monkeypatch):
    """Pieces and expected counts of a long word, looked up in blocks of any size."""
    model = sentencepiece.Model(model_bytes(random_model(3)))
    rng = random.Random(3)
    for n in (49, 120, 333):
        word = "▁" + "".join(rng.choice("abc日") for _ in range(n))
        got = []
        for block in (1, 7, 64, 1 << 14):
            monkeypatch.setattr(sentencepiece, "LONG_BLOCK", block)
            out = np.zeros(len(model.pieces), np.int64)
            model._expect_one(word, 3, out)
            got.append((model._segment_one(word), out.tolist()))
        assert all(g == got[0] for g in got)
        monkeypatch.setattr(sentencepiece, "LONG_WORD", n + 1)
        assert model.segment([word]) == [got[0][0]]
        assert np.abs(model.expected([word], [3]) - got[0][1]).max() <= 3 * len(word)
        monkeypatch.undo()


def test_products_out_of_range_go_by_logarithms():
    """A word so unlikely that its probability is no number any more."""
    model = sentencepiece.Model(model_bytes(BYTES + [("a", -40.0, 1), ("b", -1.0, 1), ("▁", -30.0, 1)]))
    word = "▁" + "a" * 40
    want = np.zeros(len(model.pieces), np.int64)
    model._expect_one(word, 2, want)
    assert model.expected([word], [2]).tolist() == want.tolist() and want[258] == 80 * sentencepiece.PART


def test_words_are_counted_as_the_model_cuts_them(spark):
    model = sentencepiece.Model(model_bytes(random_model(4)))
    texts = ["a b  a", " ", "   x y ", "", None, "a▁b", "line\nend a", "a b  a"]
    docs = spark.createDataFrame([(t,) for t in texts], "t string")
    want = {}
    for t in texts:
        for w in model.words(t or ""):
            want[w] = want.get(w, 0) + 1
    assert {r.word: r.n for r in sentencepiece.word_counts(docs, True).collect()} == want
    whole = {r.word: r.n for r in sentencepiece.word_counts(docs, False).collect()}
    assert whole["▁a▁b▁▁a"] == 2 and "" not in whole and len(whole) == 5


def test_encode_and_decode_tables(spark, tmp_path):
    path = str(tmp_path / "m.model")
    with open(path, "wb") as f:
        f.write(model_bytes(random_model(9)))
    rows = [(1, "abc ab", "x"), (1, "abc ab", "x"), (2, None, "x"), (3, "", "x"), (None, "日本 \n\t🙂 " + "a" * 5000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, tokens string")
    tokens = sentencepiece.encode(spark, df, path)
    back = sorted((r.doc_id or 0, r.text) for r in sentencepiece.decode(spark, tokens, path).collect())
    assert back == sorted((i or 0, t or "") for i, t, _ in rows)
    assert all(r.same for r in sentencepiece.roundtrip(spark, df, path).collect())
    assert sentencepiece.encode(spark, df.limit(0), path).count() == 0


def all_segmentations(word, table):
    """Every list of pieces that makes up the word."""
    if not word:
        return [[]]
    return [[word[:n], *rest] for n in range(1, len(word) + 1) if word[:n] in table for rest in all_segmentations(word[n:], table)]


def bpe_file(tmp_path):
    """A file of type BPE: its scores are merge ranks, in an order that misleads a sum of them."""
    rng = random.Random(12)
    texts = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(2, 4))) for _ in range(14)})
    pieces = BYTES + [(t, -float(k), 1) for k, t in enumerate([*texts, "\u2581", "\u2581ab", "a", "b", "c"])]
    path = str(tmp_path / "bpe.model")
    with open(path, "wb") as f:
        f.write(model_bytes(pieces) + b"\x12\x02\x18\x02")
    return path, pieces


def test_merge_ranks_are_no_log_scores(spark, tmp_path):
    """Files of another type are rejected; their vocabulary gets the scores of EM over all words."""
    path, pieces = bpe_file(tmp_path)
    rng = random.Random(13)
    texts = [" ".join("".join(rng.choice("aabc") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 12))) for _ in range(80)] + ["", None, "a  b", "c" * 70]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    with pytest.raises(ValueError):
        sentencepiece.Model(open(path, "rb").read())
    trained = sentencepiece.unigram_model(spark, df, path, rounds=2)
    model = sentencepiece.Model(trained)
    assert model.pieces == [p for p, _, _ in pieces]

    table = {p: 0.0 for p, _, kind in pieces if kind == 1}
    words = [w for t in texts for w in model.words(t or "") if len(w) < 60]
    for _ in range(2):
        seen = dict.fromkeys(table, 0.5)
        for w in words:
            paths = [(p, np.exp(sum(table[x] for x in p))) for p in all_segmentations(w, table)]
            for p, weight in paths:
                for x in p:
                    seen[x] += weight / sum(v for _, v in paths)
        # The long word alone: its only pieces are runs of c and the marker.
        word = "\u2581" + "c" * 70
        runs = [p for p in table if set(p) == {"c"}]
        ahead, behind = [1.0] + [0.0] * 70, [0.0] * 70 + [1.0]
        for k in range(1, 71):
            ahead[k] = sum(ahead[k - len(p)] * np.exp(table[p]) for p in runs if len(p) <= k)
        for k in range(69, -1, -1):
            behind[k] = sum(behind[k + len(p)] * np.exp(table[p]) for p in runs if len(p) <= 70 - k)
        for p in runs:
            seen[p] += sum(ahead[k] * np.exp(table[p]) * behind[k + len(p)] for k in range(71 - len(p))) / ahead[70]
        seen["\u2581"] += 1
        table = {p: np.log(n / sum(seen.values())) for p, n in seen.items()}
    for p, s in table.items():
        assert model.score[model.pieces.index(p)] == pytest.approx(s, abs=1e-4), p
    assert sentencepiece.unigram_model(spark, df.coalesce(1), path, rounds=2) == trained
    assert all(r.same for r in sentencepiece.roundtrip(spark, df, trained).collect())
    # A unigram file keeps its own scores; without documents all pieces score alike.
    unigram = str(tmp_path / "u.model")
    with open(unigram, "wb") as f:
        f.write(trained)
    assert sentencepiece.unigram_model(spark, df, unigram) == trained
    assert len(set(sentencepiece.Model(sentencepiece.unigram_model(spark, df.limit(0), path)).score[258:])) == 1


# -- toxicity ------------------------------------------------------------------

def labelled(n, seed=2):
    rng = random.Random(seed)
    calm = ["sun", "river", "table", "walking", "green", "letter", "music", "under"]
    rude = ["scoundrel", "vermin", "rotter"]
    out = []
    for i in range(n):
        y = int(rng.random() < 0.3)
        words = [rng.choice(calm) + rng.choice(["", "s", "ly"]) for _ in range(rng.randint(20, 60))]
        if y:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(rude)
        out.append((i, " ".join(words), y))
    return out


def test_held_out_accuracy_and_edge_rows(spark):
    rows = labelled(400)
    docs = spark.createDataFrame([(i, t, "a") for i, t, _ in rows] + [(1000, None, "a"), (1001, "", "a"), (None, "calm", "a"), (3, rows[3][1], "a"),
                                                                     (1002, "x" * 200_000, "a")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5, None), (9999, 1), (None, 1)], "doc_id long, toxic int")
    got = toxicity.classify(spark, docs, labels).collect()
    assert len(got) == 405 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.97


def test_no_labels_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.classify(spark, docs, labels).first().score < 0.01
    assert toxicity.classify(spark, docs.limit(0), labels).count() == 0


def test_fit_needs_little_more_memory_than_the_sets():
    rng = np.random.default_rng(5)
    texts = ["".join(map(chr, row)) for row in rng.integers(97, 123, (1200, 3000)).tolist()]
    grams = 12 * sum(map(len, toxicity.gram_sets(texts[:100])))
    tracemalloc.start()
    try:
        toxicity.fit(texts, [i % 2 for i in range(1200)], rounds=2)
        assert tracemalloc.get_traced_memory()[1] < 20 * grams
    finally:
        tracemalloc.stop()


# -- decontamination -----------------------------------------------------------

def edit_passage(item, text):
    """Least edit distance of the item to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (w != v)))
        row = new
    return min(row)


def test_passages_against_all_alignments(spark):
    rng = random.Random(8)
    vocabulary = ["v%d" % i for i in range(500)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate([1, 3, 5, 9, 20, 33, 50, 60])]
    docs = []
    for d in range(160):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
        if d % 2:
            w = items[rng.randrange(4, 8)][1].split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                at = rng.randrange(len(w))
                w[at:at + 1] = rng.choice([[], [w[at], "zz"], ["zz"]])
            at = rng.randint(0, len(words))
            words[at:at] = w
        docs.append((d, " ".join(words)))
    want = {}
    for d, text in docs:
        for i, item in items:
            w = item.split()
            distance = edit_passage(w, text.split())
            if distance <= int(len(w) * decontam.TOLERANCE):
                want[d, i] = distance
    df = spark.createDataFrame([(d, t.replace(" ", ", ").upper(), 1) for d, t in docs] + [(900, None, 1), (901, "", 1), (None, items[5][1], 1)],
                               "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([*items, (50, None), (51, ""), (52, items[6][1])], "item_id long, text string")
    got = {}
    for r in decontam.find_passages(spark, df, bench).collect():
        got[r.doc_id, r.item_id] = min(r.distance, got.get((r.doc_id, r.item_id), 99))
    assert got.pop((None, 5)) == 0
    assert {(d, 52) for d, i in got if i == 6} == {k for k in got if k[1] == 52}
    got = {k: v for k, v in got.items() if k[1] != 52}
    assert set(got) <= set(want) and all(got[k] == want[k] for k in got)
    assert {k for k, v in want.items() if v == 0} <= set(got)
    assert len(got) >= decontam.RECALL * len(want)
    assert decontam.find_passages(spark, df.limit(0), bench).count() == 0
    assert decontam.find_passages(spark, df, bench.limit(0)).count() == 0


@pytest.mark.parametrize("n", range(5, 41))
def test_every_passage_at_full_tolerance_is_found(n):
    rng = random.Random(n)
    items = [(k, " ".join("w%d" % rng.randrange(3000) for _ in range(n))) for k in range(12)]
    index = decontam.Index(items)
    rows = []
    for k, item in items * 6:
        words = item.split()
        for at in sorted(rng.sample(range(n), int(n * decontam.TOLERANCE)), reverse=True):
            words[at:at + 1] = rng.choice([["zz"], [], ["zz", words[at]]])
        rows.append((k, ["a%d" % rng.randrange(50) for _ in range(9)] + words + ["b%d" % rng.randrange(50) for _ in range(9)]))
    rows.append((0, ["\u201c" + items[0][1].split()[0], *items[0][1].split()[1:]]))
    data, offsets = utf8(pa.array([" ".join(w) for _, w in rows]))
    starts, ends, bounds = word_spans(data, offsets, PUNCT_TABLE)
    got = {(row, item): distance for row, item, distance, _, _ in index.search(word_hashes(data, starts, ends), bounds)}
    for row, (k, words) in enumerate(rows):
        assert got[row, k] == edit_passage(items[k][1].split(), words)


# -- PII -------------------------------------------------------------------------

PLAIN = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(text):
    out = []
    for k, pattern in enumerate(PLAIN):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if (k == 0 or k == 1 and all(int(p) <= 255 for p in m[0].split(".")) or k == 2 and 12 <= len(digits) <= 19 and pii.luhn(digits)
                    or k == 3 and 9 <= len(digits) <= 15):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_are_the_patterns_matches():
    rng = random.Random(4)
    pieces = ["a.b@c.d", "x@y", "@", "@@", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1111", "5", " ", "-", ".", "+",
              "+1 (743) 555-3824", "+49", "(0)", "abc", "é", "a@b.c@d.e", "..", "%", "1234567890123456789012", "\n", "0001.2.3.4"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("1" * 200_000 + "a" * 200_000 + "+1" + " " * 100_000) == []


def test_gradients():
    tagger = pii.Tagger(hidden=3)
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 130, (2, 5)), rng.integers(0, 9, (2, 5))
    _, grads = tagger.loss(x, y)
    for name, g in grads.items():
        at = tuple(rng.integers(0, n) for n in g.shape)
        if name[0] == "x":
            at = (x[0, 2], at[1])
        tagger.p[name][at] += 1e-5
        up = tagger.loss(x, y)[0]
        tagger.p[name][at] -= 2e-5
        down = tagger.loss(x, y)[0]
        tagger.p[name][at] += 1e-5
        assert g[at] == pytest.approx((up - down) / 2e-5, abs=1e-5)


@pytest.fixture(scope="module")
def tagger():
    texts = ["Write to ann.b@mail.example.com or +1 (743) 555-3824 now, host 10.2.3.4 has it." * 2, "Pay 4111111111111111 in 30 days, order 20931."] * 4
    return pii.Tagger().fit(*pii.training_windows(texts, most=480))


def test_network_adds_and_tells_decoys_apart(tagger):
    x, y = pii.training_windows(["Some plain words stand here and 12 there, or so they say."], most=200, seed=77)
    assert (tagger.decode(x) == y).all(1).mean() >= 0.8      # windows it was not trained on
    long = "word " * 500
    text = long + "reach john.doe [at] example.org today, " + long
    (base, spans), = pii.find_all(tagger, [text])
    assert not base and [text[a:b] for a, _, b in spans] == ["john.doe [at] example.org"]


def test_table_of_edge_rows(spark, tagger):
    texts = [None, "", "plain", "mail a@b.co and 1.2.3.4 é +1 (743) 555-3824 x", "4111111111111111 " * 3000]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)] + [(None, texts[3], "c"), (3, texts[3], "c")], "doc_id long, text string, spans string")
    got = pii.find(spark, df, tagger=tagger).collect()
    assert len(got) == 7
    for r in got:
        text = texts[3 if r.doc_id is None else r.doc_id] or ""
        want = plain_spans(text)
        named = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == n for _, k, _ in want) for n in range(4))
        assert r.base_sha256 == hashlib.sha256(named.encode()).hexdigest()
        assert set(named.split(",")) <= set(r.spans.split(","))
    hidden = {r.doc_id: r.text for r in pii.masked(spark, df, tagger=tagger).collect()}
    assert hidden[0] is None and hidden[2] == "plain" and hidden[3] == "mail <EMAIL> and <IP> é <PHONE> x"
    assert pii.find(spark, df.limit(0), tagger=tagger).count() == 0


def test_runs_are_cut_at_base_spans():
    """A phone that the pattern loses to the number behind it."""
    text = "call +1 (826) 555-4081 190.137.4.5 or so"
    base = pii.base_spans(text)
    assert [text[a:b] for a, _, b in base] == ["190.137.4.5"]
    tags = {i: 8 for i in range(5, 34)}
    tags[5] = 7
    assert [(text[a:b], pii.KINDS[k]) for a, k, b in pii.added_spans(text, tags, base)] == [("+1 (826) 555-4081", "phone")]
    inside = {i: 8 for i in range(23, 34)}
    assert pii.added_spans(text, inside, base) == []


def test_training_draws_from_whole_texts():
    text = " ".join(["word"] * 9000) + " number 12345678901 here " + " ".join(["word"] * 100)
    rng = np.random.default_rng(1)
    assert pii._some(rng, [1, 2], 3) == [1, 2] and len(set(pii._some(rng, list(range(100)), 4))) == 4
    x, _ = pii.training_windows([text], most=64)
    assert (x != pii.training_windows([""], most=64)[0]).any()


def test_words_cut_together_are_those_cut_apart(spark):
    model = sentencepiece.Model(sentencepiece.write_model([("<unk>", 0.0, sentencepiece.UNKNOWN), (sentencepiece.MARKER, -2.0, 1), ("a", -1.0, 1), ("b", -1.5, 1), (sentencepiece.MARKER + "a", -1.2, 1)]))
    texts = ["", "a b", " a", "a ", "a  b", "a▁b", " ", "ab" * 60 + " b", "xé a", "▁", "a b"]
    ids, bounds = model.encode_all(texts)
    apart = [[i for part in model.segment(model.words(t)) for i in part] for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == apart
    assert [raw.decode("utf-8", "replace") for raw in model.decode_all(ids, bounds)] == [model.decode(x) for x in apart]
    counted = {r["word"]: r["n"] for r in sentencepiece.word_counts(spark.createDataFrame([(t,) for t in texts], "t string"), True).collect()}
    expected = {}
    for t in texts:
        for w in model.words(t):
            expected[w] = expected.get(w, 0) + 1
    assert counted == expected


def test_words_are_counted_before_they_are_rows(spark, monkeypatch):
    docs = spark.createDataFrame([("a b a",), ("b  c",)], "t string").coalesce(1)
    plan = sentencepiece.word_counts(docs, True)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "MapInArrow" in plan
    texts = ["a b a", "b  c", None, "", " ", "d e f g a", "a▁b"]
    want = {"▁a": 4, "▁b": 3, "▁▁c": 1, "▁▁": 1, "▁d": 1, "▁e": 1, "▁f": 1, "▁g": 1}
    batches = [pa.record_batch([pa.array(texts[i:i + 2])], names=["t"]) for i in range(0, len(texts), 2)]
    for most in (1, 6, 1 << 20):
        monkeypatch.setattr(sentencepiece, "COUNTED", most)
        got, rows = {}, 0
        for out in sentencepiece._counted(batches):
            rows += len(out)
            for word, n in zip(out["word"].to_pylist(), out["n"].to_pylist()):
                got[word] = got.get(word, 0) + n
        assert got == want and (most <= 6 or rows == len(want))
