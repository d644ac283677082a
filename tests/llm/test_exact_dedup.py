"""Streaming exact deduplication: equal rows to SQL, wrong hits, recovery and odd inputs."""

import hashlib

import pytest
from pyspark.sql import functions as F

from stratalake.llm.exact_dedup import SQL, DedupState, exact_dedup, without_copies
from stratalake.llm.registry import op4_exact_dedup
from oracle import connect, differences

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, file string, row string, `_metadata` int"


@pytest.fixture
def written(spark, tmp_path):
    def write(rows, schema=SCHEMA):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "docs"))
        return spark.read.parquet(str(tmp_path / "docs"))

    return write


ROWS = [
    (1, "Same text", "a", "x", 1),
    (2, "sAME tEXT", "b", None, 2),
    (3, "other", None, "y", None),
    (4, None, None, None, None),
    (5, "", "c", "z", 5),
    (None, "same text", "d", "z", 5),
    (2, "sAME tEXT", "b", None, 2),
    (6, "École", None, None, None),
    (7, "école", None, None, None),
    (8, "long " * 50_000, None, None, None),
    (9, "LONG " * 50_000, None, None, None),
]


def brute(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault((text or "").translate(low), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def _got(df):
    cols = ["doc_id", "keep_id", "group_size", "text_sha256"]
    return sorted([tuple(r) for r in df.select(cols).collect()], key=str)


def test_query_gives_the_rows_of_its_sql(spark):
    assert differences(op4_exact_dedup(spark, SF), connect(SF), SQL) == []


def test_odd_rows(written):
    found = exact_dedup(written(ROWS))
    assert _got(found) == brute(ROWS)
    assert found.where("kept").count() == len({r[3] for r in brute(ROWS)})


def test_wrong_digest_hits_are_put_right_by_their_bytes(written):
    found = exact_dedup(written(ROWS), digest=lambda text: F.length(text).cast("string"))
    assert _got(found) == brute(ROWS)


def test_every_row_hits_one_digest(written):
    assert _got(exact_dedup(written(ROWS), digest=lambda text: F.lit("x"))) == brute(ROWS)


def test_rows_that_stay_keep_all_columns(written):
    docs = written(ROWS)
    stay = without_copies(docs)
    assert stay.columns == docs.columns
    assert stay.count() == len({r[3] for r in brute(ROWS)})


def test_empty_table(written):
    docs = written([])
    assert exact_dedup(docs).collect() == [] and without_copies(docs).collect() == []


def test_later_files_meet_the_stored_state(spark, tmp_path):
    schema = "digest string, doc_id bigint, file string, row bigint"
    folder = str(tmp_path / "in")
    state = DedupState(str(tmp_path / "state"))
    for rows in ([("a", 1, "f", 0), ("b", 2, "f", 1)], [("a", 9, "g", 0)], [("a", 5, "h", 0)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(folder)
        state.ingest(spark.readStream.schema(schema).parquet(folder))
    now = {r.digest: (r.keep.doc_id, r.keep.file, r.group_size) for r in state.current(spark).collect()}
    assert now == {"a": (9, "g", 3), "b": (2, "f", 1)}
    assert "HDFSBacked" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
