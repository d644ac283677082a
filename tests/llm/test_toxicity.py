"""The field against enumeration of all tag sequences; held-out accuracy; odd inputs."""

import itertools
import math
import random
import zlib

import numpy as np
import pandas as pd
import pytest

from stratalake.llm import toxicity
from stratalake.llm.registry import op3_toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def result(spark):
    return op3_toxicity(spark, SF).toPandas()


def test_held_out_documents_are_told_apart(result):
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    held = result[result.held_out].merge(labels, on="doc_id")
    ranks, toxic = held.score.rank(), held.toxic == 1
    n1, n0 = toxic.sum(), (~toxic).sum()
    assert n1 > 50 and (ranks[toxic].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) > 0.93
    assert ((held.predicted == 1) == toxic).mean() > 0.97
    assert held[~toxic].predicted.mean() < 0.01


def test_one_row_per_document_and_spans_lie_in_the_text(result):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    assert sorted(result.doc_id) == sorted(docs.doc_id)
    assert result.score.between(0, 1).all() and ((result.score >= 0.5) == (result.predicted == 1)).all()
    both = result[result.predicted == 1].merge(docs, on="doc_id")
    spans = [(r.text, s) for r in both.itertuples() for s in r.spans]
    assert len(spans) > len(both) / 2
    for text, span in spans:
        token = text[span["start"] : span["end"]]
        assert token and not any(map(str.isspace, token)) and 0.5 <= span["marginal"] <= 1


def test_scores_do_not_depend_on_the_rows_around(spark, result):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 50 = 3")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    again = toxicity.score_documents(docs, model).toPandas().merge(result, on="doc_id")
    assert np.allclose(again.score_x, again.score_y, atol=1e-9)


def _enumerated(model, emission):
    """Marginals by adding up all tag sequences."""
    moves = {(0, 0): 0.0, (0, 1): model.enter, (1, 0): model.leave, (1, 1): model.stay}
    total, on = 0.0, np.zeros(len(emission))
    for tags in itertools.product((0, 1), repeat=len(emission)):
        score = sum(e for e, t in zip(emission, tags) if t) + model.start * tags[0]
        score += sum(moves[p] for p in zip(tags, tags[1:]))
        total += math.exp(score)
        on += math.exp(score) * np.array(tags)
    return on / total


def test_marginals_are_those_of_all_tag_sequences():
    rng = np.random.default_rng(0)
    model = toxicity.Field(start=0.7, enter=-1.2, leave=0.4, stay=1.5)
    lengths = np.array([5, 0, 1, 9, 3])
    emission = rng.normal(0, 3, lengths.sum())
    parts = np.split(emission, np.cumsum(lengths)[:-1])
    expected = np.concatenate([_enumerated(model, p) if len(p) else p for p in parts])
    assert np.allclose(toxicity.marginals(model, emission, lengths), expected, atol=1e-12)


def test_windows_do_not_show():
    rng = np.random.default_rng(1)
    model = toxicity.Field(start=-1.0, enter=-1.5, leave=-1.5, stay=1.5)
    lengths = np.array([5000, 3, 0, 700, 1500])
    emission = rng.normal(0, 2, lengths.sum())
    got = np.split(toxicity.marginals(model, emission, lengths), np.cumsum(lengths)[:-1])
    for part, chances in zip(np.split(emission, np.cumsum(lengths)[:-1]), got):
        if len(part):
            edge = np.zeros((1, len(part)), bool)
            first, last = edge.copy(), edge.copy()
            first[0, 0] = last[0, -1] = True
            ahead, back = toxicity.forward_backward(model, part[None, :], first, last)
            assert np.allclose(chances, 1 / (1 + np.exp(-(ahead + back)[0])), atol=1e-10)


def _tiny(spark):
    rng = random.Random(2)
    plain = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    rows = [(i, " ".join(rng.choices(plain, k=12) + ["blarg"] * (i % 4 == 0))) for i in range(400)]
    labels = [(i, int(i % 4 == 0)) for i in range(400)]
    return rows, labels


def test_odd_rows(spark):
    rows, labels = _tiny(spark)
    odd = [(None, None), (900, ""), (900, ""), (901, "Blarg! " * 30_000), (902, "\x1c blarg x"), (None, "BLARG")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS label")
    known = spark.createDataFrame(
        labels + [(None, 1), (5, None), (5, 0), (9999, 1)], "doc_id long, toxic int"
    ).selectExpr("*", "'x' AS text")
    got = toxicity.score_documents(docs, toxicity.fit(docs, known)).toPandas()
    assert len(got) == len(rows) + len(odd)
    by_id = got.groupby("doc_id").predicted.first()
    assert all(by_id[i] == int(i % 4 == 0) for i in range(400))
    assert by_id[900] == 0 and by_id[901] == 1 and by_id[902] == 1
    assert sorted(got[got.doc_id.isna()].predicted) == [0, 1]
    assert toxicity.score_documents(docs.limit(0), toxicity.Field()).collect() == []


def test_without_labels_of_both_kinds(spark):
    rows, labels = _tiny(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for known in ([], [(1, 0), (2, 0)]):
        frame = spark.createDataFrame(known, "doc_id long, toxic int")
        got = toxicity.score_documents(docs, toxicity.fit(docs, frame)).toPandas()
        assert got.score.nunique() == 1 and 0 < got.score[0] <= 0.5


def test_an_id_is_one_row_of_the_sample_and_bytes_are_bounded(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5][:200]
    docs = [(i, f"text of {i}") for i in ids] + [(ids[0], f"again {k} " + "x" * (k % 50)) for k in range(20_000)]
    docs += [(ids[1], None), (ids[2], "long " * 5000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, toxic int")
    whole = toxicity.labelled_sample(frame, labels, sample=1000).collect()
    assert sorted(r.doc_id for r in whole) == sorted(ids)
    texts = {r.doc_id: r.text for r in whole}
    assert texts[ids[0]] == min((t for i, t in docs if i == ids[0]), key=lambda t: (len(t), t))
    assert texts[ids[1]] == "" and texts[ids[2]] == f"text of {ids[2]}"
    assert len(toxicity.labelled_sample(frame, labels, sample=3).collect()) == 6
    some = toxicity.labelled_sample(frame, labels, sample=1000, sample_bytes=600).collect()
    for label in (0, 1):
        own = [r.text for r in some if r.label == label]
        assert 250 < sum(map(len, own)) <= 300
    only = spark.createDataFrame([(ids[3], "y" * 1000)], "doc_id long, text string")
    assert toxicity.labelled_sample(only, labels, sample_bytes=1000).collect() == []
