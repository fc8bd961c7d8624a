"""The near-duplicate and contamination stages of the pipeline, row by row."""

import random

import pytest

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def passage(seed, n=40):
    rng = random.Random(seed)
    return " ".join("t%d" % rng.randrange(3000) for _ in range(n))


def frame(spark, rows):
    """Rows of (id, text); the other columns as in ``documents``."""
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A folder with a benchmark of one item."""
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, passage(100, 20)), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def key(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=key)


def test_rows_without_id_are_documents_of_their_own(spark, folder):
    """Unrelated rows of null id all stay; of linked ones one does, none beside a row with an id."""
    near = passage(1) + " more"
    rows = [(None, passage(k)) for k in range(2, 6)] + [(None, passage(1)), (None, near), (None, ""), (None, None), (None, " \n"),
                                                         (7, passage(7)), (None, passage(7)), (8, passage(7) + " x"), (9, ""), (9, passage(9))]
    got = pairs(corpus_pipeline.drop_near_duplicates(spark, frame(spark, rows), folder))
    sure = [(None, passage(k)) for k in range(2, 6)] + [(None, ""), (None, None), (None, " \n"), (7, passage(7)), (9, ""), (9, passage(9))]
    assert [(i, t) for i, t in got if t not in (passage(1), near)] == sorted(sure, key=key)
    assert sum(t in (passage(1), near) for _, t in got) == 1


def test_contamination_is_of_the_row(spark, folder):
    leak = passage(30) + " " + passage(100, 20) + " " + passage(31)
    clean = [(None, passage(32)), (None, None), (None, ""), (4, passage(33)), (4, passage(34)), (5, passage(35)), (5, passage(35))]
    got = corpus_pipeline.drop_contaminated(spark, frame(spark, [*clean, (None, leak), (4, leak), (6, leak)]), folder)
    assert pairs(got) == sorted(clean, key=key)
    assert got.columns == corpus_pipeline.COLUMNS
