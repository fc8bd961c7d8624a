"""Near duplicates and repeated spans against brute force."""

import random

import numpy as np
import pytest

from tessera.llm import minhash, spans
from tessera.llm.graph import components


def brute_groups(rows, words, percent):
    """{row index: least id of the group} by all pairs of full shingle sets."""
    def shingles(text):
        w = (text or "").encode().lower().split()
        if not w:
            return frozenset()
        return frozenset(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1)))
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (ident, _) in enumerate(rows):
        if ident is not None:
            least[root(i)] = min(ident, least.get(root(i), ident))
    return [(ident, len(sets[i]), least.get(root(i))) for i, (ident, _) in enumerate(rows)]


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)]
    rows = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 120))]
        for _ in range(rng.randint(1, 14)):
            w = list(base)
            for _ in range(rng.randint(0, len(w) // 8)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append(" ".join(w))
    rows += ["", None, "one", "One", "one two", " \t\n", "ÄÖ äö", "äö äö"]
    rows += [rows[0]] * 5
    rng.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("words,percent", [(2, 80), (5, 80)])
def test_groups_are_those_of_all_pairs(spark, words, percent):
    rows = corpus(words)
    rows += [rows[3], (None, rows[5][1]), (None, None)]
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, bucket string, n long")
    got = minhash.near_duplicates(spark, df, words=words, percent=percent).collect()
    want = [(i, n, c if c is not None else i) for i, n, c in brute_groups(rows, words, percent)]
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=key) == sorted(want, key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("rare", [1, 3, 64])
def test_pairing_by_rare_shingles_loses_no_link(spark, monkeypatch, rare):
    """Without hubs, the last comparison alone finds every link."""
    monkeypatch.setattr(minhash, "HUB_ROUNDS", 0)
    monkeypatch.setattr(minhash, "RARE", rare)
    rows = corpus(7)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(spark, df, words=2, percent=80).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_groups(rows, 2, 80))


def test_hub_that_alone_connects_a_group(spark):
    """Copies that are near the base but not near each other are one group."""
    rng = random.Random(3)
    base = ["b%d" % i for i in range(200)]
    rows = []
    for i in range(30):
        w = list(base)
        for p in rng.sample(range(0, 200, 3), 9):
            w[p] = "e%d_%d" % (i, p)
        rows.append((i + 10, " ".join(w)))
    rows.append((99, " ".join(base)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark, df, words=2).collect()}
    assert got == {i: c for i, _, c in brute_groups(rows, 2, 80)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(spark, df).count() == 0
    assert spans.dedup_spans(spark, df).count() == 0


def test_coordinates_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 1500, dtype=np.uint64) * np.uint64(2)
    a, b = np.unique(pool[:1000]), np.unique(pool[500:])
    same = (minhash.signature(a, 512) == minhash.signature(b, 512)).mean()
    assert abs(same - 1 / 3) < 0.08


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components(spark, df).collect()}
    assert got == {**{i: 1 for i in range(2, 41)}, **{i: 100 for i in range(101, 160)}}


def brute_sentences(text):
    """Up to and with a run of end marks and the white space after it."""
    out, i, n = [], 0, len(text or "")
    while i < n:
        j = i
        while j < n and text[j] not in ".!?\n":
            j += 1
        while j < n and text[j] in ".!?\n":
            j += 1
        if j > i and text[j - 1] in ".!?\n":
            while j < n and text[j] in " \t\r\n":
                j += 1
        out.append(text[i:j])
        i = j
    return out


def brute_places(text):
    """(first sentence, sentences, words) of every run that counts: three sentences of 8
    words, two of 25, one of 50, and the shortest of 25 words from and up to a sentence."""
    words = [x.split(" ") if x else [] for x in (" ".join(p.replace("\t", " ").replace("\n", " ").replace("\r", " ").split()) for p in brute_sentences(text))]
    n = len(words)
    size = lambda i, j: sum(len(w) for w in words[i:j])
    found = {(i, i + k) for k, least in ((3, 8), (2, 25), (1, 50)) for i in range(n - k + 1) if size(i, i + k) >= least}
    for i in range(n):
        if words[i]:
            found |= set([(i, j) for j in range(i + 1, n + 1) if size(i, j) >= 25][:1])
            found |= set([(j, i + 1) for j in range(i, -1, -1) if size(j, i + 1) >= 25][:1])
    return [(i, j, tuple(map(tuple, words[i:j]))) for i, j in found]


def brute_spans(rows):
    """Every run of a row but the first of its kind is cut; which of two rows of one id is
    the first is the operator's choice, so the fixture has no run shared by such rows alone."""
    seen = {(i, t) for i, t in rows}
    order = lambda r: (r[0] is not None, r[0] or 0)
    first = {}
    for row in seen:
        for i, j, g in brute_places(row[1]):
            place = (order(row), i)
            first[g] = min(first.get(g, place), place)
    out = []
    for row in rows:
        gone = {k for i, j, g in brute_places(row[1]) if first[g] != (order(row), i) for k in range(i, j)}
        out.append((row[0], "".join(p for k, p in enumerate(brute_sentences(row[1])) if k not in gone)))
    return out


def test_texts_of_one_id_are_cut_apart(spark):
    """One is repeated elsewhere, the other is clean; so with rows of no id."""
    copy = "This sentence stands in several texts of the table. It has another one after it. And a third one ends it. "
    clean = ["The first clean text says this. Then it goes on with that. Bye.", "Nothing here is said anywhere else. Not one word of it. The end is near."]
    rows = [(1, copy), (7, copy + "More of seven."), (7, clean[0]), (None, clean[1]), (9, copy), (9, copy)]
    got = spans.dedup_spans(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.text for r in got) == sorted([copy, "More of seven.", *clean, "", ""])
    rows = [(None, copy), (None, clean[0]), (None, copy + clean[1])]
    got = sorted(r.text for r in spans.dedup_spans(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got in (sorted([copy, clean[0], clean[1]]), sorted(["", clean[0], copy + clean[1]]))


def test_spans_against_brute_force(spark):
    rng = random.Random(5)
    sentence = lambda: " ".join("w%d" % rng.randrange(300) for _ in range(rng.randint(1, 12))).capitalize() + rng.choice([". ", "! ", ".\n"])
    passages = [[sentence() for _ in range(8)] for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [sentence() for _ in range(rng.randint(0, 10))]
        if rng.random() < 0.6:
            at = rng.randint(0, len(parts))
            parts[at:at] = rng.choice(passages)
        rows.append((i, "".join(parts)))
    rows += [(70, None), (71, ""), (72, "".join(passages[0]) + "Own end here. " + "".join(passages[0])), (None, "".join(passages[1]))]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, hash string")
    got = spans.dedup_spans(spark, df).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted([(r.doc_id, r.text) for r in got], key=key) == sorted(brute_spans(rows), key=key)
    assert any(r.n_removed for r in got) and any(r.n_removed == 0 and r.n_sentences > 3 for r in got)
    whole = {r.doc_id: r for r in got}
    assert whole[70].text == "" and whole[70].n_sentences == 0


def test_long_passage_of_few_sentences_is_found(spark):
    long = " ".join("word%d" % i for i in range(60)) + "."
    rows = [(1, "Start here now. " + long + " End of one."), (2, "Another start. " + long + " Other end.")]
    got = {r.doc_id: r for r in spans.dedup_spans(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_removed == 0 and "word5 " not in got[2].text and "Another start" in got[2].text
    assert got[2].sources == [1]


def test_lists_and_single_sentences_are_found(spark):
    """Passages of one-word lines and of one whole sentence below the fixed minima."""
    lines = "".join("item%d\n" % i for i in range(60))
    whole = " ".join("word%d" % i for i in range(33)) + ". "
    rows = [(1, "Own start here.\n" + lines + "Own end."), (2, "Other start there.\n" + lines + "Other end."),
            (3, "Third start. " + whole + "Third end."), (4, "Fourth start. " + whole + "Fourth end."), (5, "Few. . . . . words\n" * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in spans.dedup_spans(spark, df).collect()}
    assert got == {1: rows[0][1], 2: "Other start there.\nOther end.", 3: rows[2][1], 4: "Fourth start. Fourth end.", 5: rows[4][1]}


@pytest.mark.parametrize("seed", range(3))
def test_runs_grow_to_the_word_minimum(seed):
    rng = random.Random(seed)
    parts = [" ".join(["w"] * rng.choice([0, 1, 1, 2, 5, 30])) + "." for _ in range(80)]
    size = [0 if p == "." else len(p.split()) for p in parts]
    want = set()
    for i in range(80):
        if size[i]:
            want |= {(i, n) for n in [next((n for n in range(1, 81 - i) if sum(size[i:i + n]) >= 25), 0)] if n}
            want |= {(i + 1 - n, n) for n in [next((n for n in range(1, i + 2) if sum(size[i + 1 - n:i + 1]) >= 25), 0)] if n}
    total = [sum(size[:i]) for i in range(81)]
    assert set(spans._grown(total, 25)) == want
