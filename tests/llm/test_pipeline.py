"""Every stage against a plain model on its own input, and odd rows through all of them."""

import pandas as pd
import pytest

import corpus_pipeline
from test_decontamination import brute as contaminated
from test_exact_dedup import brute as copies
from test_jaccard_join import brute as near_copies
from test_packing import check_laws

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage got and gave."""
    out, docs = {}, spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        folder = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(folder)
        given, docs = docs, spark.read.parquet(folder)
        out[name] = (given.toPandas(), docs.toPandas())
    return out


def _ids(frame):
    return set(frame.doc_id)


def test_all_but_the_last_return_the_rows_they_keep_unchanged(steps):
    for name, (given, kept) in list(steps.items())[:-1]:
        assert list(kept.columns) == list(given.columns)
        both = kept.merge(given, on="doc_id", suffixes=("", "_given"))
        assert len(both) == len(kept) < len(given), name
        assert (both.text == both.text_given).all()


def test_toxic_documents_go_and_clean_ones_stay(steps):
    given, kept = steps["toxicity"]
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    clean = set(labels[labels.toxic == 0].doc_id)
    assert len(clean - _ids(kept)) <= 0.01 * len(clean)
    toxic = set(labels[labels.toxic == 1].doc_id)
    assert len(toxic & _ids(kept)) < 0.5 * len(toxic)


def test_largest_id_of_equal_texts_stays(steps):
    given, kept = steps["exact_dedup"]
    assert _ids(kept) == {k for _, k, _, _ in copies(given[["doc_id", "text"]].values.tolist())}


def test_smallest_id_of_linked_documents_stays(steps):
    given, kept = steps["jaccard_join"]
    expected = {c for _, _, c in near_copies(given[["doc_id", "text"]].values.tolist())}
    assert _ids(kept) == expected


def test_contaminated_documents_go(steps):
    given, kept = steps["decontamination"]
    items = pd.read_parquet(f"{SF}/benchmark.parquet")[["item_id", "text"]].values.tolist()
    found = contaminated(given[["doc_id", "text"]].values.tolist(), items)
    assert _ids(given) - _ids(kept) == {f[0] for f in found} != set()


def test_all_that_is_left_is_packed(steps):
    given, packed = steps["packing"]
    check_laws(packed, given[["doc_id", "text"]].values.tolist())


def test_odd_rows(spark, tmp_path):
    rows = [
        (1, "one two three four five six", 1), (1, "ONE two three four five six", 2), (None, None, 3),
        (None, "", 4), (None, "seven eight", 5), (2, "seven eight nine " * 20_000, 6),
        (None, "seven eight nine " * 20_000 + "x", 7),
    ]
    schema = "doc_id long, text string, __file long"
    for n, some in enumerate((rows, [])):
        folder = tmp_path / str(n)
        spark.createDataFrame(some, schema).write.parquet(str(folder / "documents.parquet"))
        for name in ("labels", "benchmark"):
            source = spark.read.parquet(f"{SF}/{name}.parquet")
            source.limit(0 if n else 10**6).write.parquet(str(folder / f"{name}.parquet"))
        packed = corpus_pipeline.run(spark, str(folder)).toPandas()
        firsts = packed[packed.start == 0]
        # The copy of 1, one of the two empty texts and the near copy of 2 without an id are gone.
        assert len(firsts) == (4 if some else 0)
        assert firsts.doc_id.notna().sum() == (2 if some else 0)
