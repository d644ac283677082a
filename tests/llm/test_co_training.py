"""Co-training: held-out accuracy, the sums against one fit in memory, odd inputs."""

import numpy as np
import pandas as pd
import pytest

from stratalake.llm import co_training
from stratalake.llm.registry import op7_quality

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def result(spark):
    return op7_quality(spark, SF).toPandas()


def test_held_out_documents_are_told_apart(result):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    assert sorted(result.doc_id) == sorted(docs.doc_id) and result.score.between(0, 1).all()
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    held = result[result.held_out].merge(labels, on="doc_id")
    good = held.quality == 1
    for column, least in (("score", 0.98), ("content_score", 0.97), ("metadata_score", 0.85)):
        ranks = held[column].rank()
        auc = (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
        assert auc > least, (column, auc)
    assert ((held.predicted == 1) == good).mean() > 0.97
    assert held[good].predicted.mean() > 0.98


def test_sums_over_tasks_are_those_over_all_rows(spark):
    rng = np.random.default_rng(4)
    rows = [
        (rng.random(co_training._CONTENT).astype("f4").tobytes(), rng.random(co_training._META).astype("f4").tobytes(), float(i % 2), i % 5)
        for i in range(300)
    ]
    frame = spark.createDataFrame(rows, "content binary, meta binary, label double, fold long").repartition(7)
    beta = rng.random(co_training._CONTENT)

    def sums(batch):
        x, label, _ = co_training._rows(batch)
        return co_training._newton_sums(x[0], label, np.ones(len(label)), beta)

    x = np.stack([np.frombuffer(r[0], "f4") for r in rows]).astype(float)
    y = np.array([r[2] for r in rows])
    assert np.allclose(co_training._summed(frame, sums), co_training._newton_sums(x, y, np.ones(300), beta))


def _frame(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, schema).selectExpr("*", "1 AS content", "2 AS label", "'x' AS fold")


def test_pseudo_labels_reach_the_other_view(spark):
    """Few labels; what the metadata view is sure of teaches the content view new words."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        good = i % 2
        words = rng.choice(["fine", "clear", "plain", "calm"] if good else ["spam###", "junk***", "buy!!"], 30)
        rows.append((i, " ".join(words), "en", "s", 100 if good else 9000))
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 120)], "doc_id long, quality int")
    got = co_training.score_quality(_frame(spark, rows), labels).toPandas()
    assert ((got.predicted == 1) == (got.doc_id % 2 == 1)).all()


def test_odd_rows(spark):
    rows = [(i, "some words here" if i % 2 else "x### x### x###", "en", "s", 20) for i in range(80)]
    odd = [(None, None, None, None, None), (500, "", "", "", 0), (500, "", "", "", 0), (501, "a\n" * 100_000, None, "é", -5)]
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(80)] + [(None, 1), (3, None), (3, 0), (999, 1)], "doc_id long, quality int"
    )
    got = co_training.score_quality(_frame(spark, rows + odd), labels).toPandas()
    assert len(got) == 84 and got.score.between(0, 1).all()
    for some in ([], [(2, 1)]):
        few = spark.createDataFrame(some, "doc_id long, quality int")
        flat = co_training.score_quality(_frame(spark, rows), few).toPandas()
        assert flat.score.nunique() == 1
    assert co_training.score_quality(_frame(spark, []), labels).collect() == []
