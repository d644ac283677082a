"""Stratified interleaving against a plain model of the same rule."""

import hashlib
import zlib
from collections import Counter

import pandas as pd

from stratalake.llm import sharding
from stratalake.llm.registry import op8_sharding
from stratalake.llm.sharding import stratified_shards

SF = "/root/testdata/sf0.01"


def model(rows, shards, seed=2718):
    """rows: (doc_id, source, text)."""
    strata = {}
    for doc_id, source, text in rows:
        data = (text or "").encode()
        key = hashlib.md5(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        stratum = "-" if source is None else f"={source}"
        ident = (key, -1 if doc_id is None else doc_id, len(data) + 1, zlib.crc32(data))
        strata.setdefault(stratum, []).append(ident)
    placed = []
    for stratum, items in strata.items():
        for rank, item in enumerate(sorted(items)):
            placed.append(((2 * rank + 1) / (2 * len(items)), stratum, *item))
    placed.sort()
    n, out = len(placed), []
    for place, (_, stratum, _, doc_id, size, crc) in enumerate(placed):
        shard = place * shards // n
        slot = place - -(-shard * n // shards)
        out.append((None if doc_id == -1 else doc_id, size, crc, shard, slot))
    return sorted(out, key=str)


def _got(df):
    return sorted([(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in df.collect()], key=str)


def test_query_follows_the_rule_over_all_documents(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    found = op8_sharding(spark, SF)
    assert _got(found) == model(docs[["doc_id", "source", "text"]].values.tolist(), 16)


def test_shards_are_level_and_match_the_mixture(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", "x" * (i % 50)) for i in range(1000)]
    found = stratified_shards(spark.createDataFrame(rows, "doc_id long, source string, text string"), 7)
    got = found.collect()
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for source, n in Counter(r[1] for r in rows).items():
        per = Counter(r.shard for r in got if r.source == source)
        # Either cut of a shard is off by at most half a row per source, shared out in proportion.
        assert all(abs(per[s] - n / 7) <= 8 * n / 1000 + 1 for s in range(7))


def test_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "a", ""), (2, "a", "é" * 100_000), (3, "", "x")]
    schema = "doc_id long, source string, text string"
    docs = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS stratum", "2 AS shard", "3 AS rank")
    found = _got(stratified_shards(docs, 3))
    assert [(d, s, c) for d, s, c, _, _ in found] == [(d, s, c) for d, s, c, _, _ in model(rows, 3)]
    assert Counter(f[3:] for f in found) == Counter(f[3:] for f in model(rows, 3))
    assert stratified_shards(spark.createDataFrame([], schema), 3).collect() == []


def test_no_python_and_no_single_partition_in_the_plan(spark):
    plan = op8_sharding(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_of_one_id_or_without_one_are_spread(spark, monkeypatch):
    monkeypatch.setattr(sharding, "_MANY", 50)
    rows = [(None, "same", "a")] * 3000 + [(7, f"t{i}", "a") for i in range(2000)] + [(i + 100, "x", "b") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    largest = []
    original = sharding._ranked

    def watched(frame, strata, bucket, order, out):
        counts = frame.groupBy(*strata, bucket).count()
        largest.append(counts.agg({"count": "max"}).first()[0])
        return original(frame, strata, bucket, order, out)

    monkeypatch.setattr(sharding, "_ranked", watched)
    got = sharding.stratified_shards(docs).collect()
    counts = Counter(r.shard for r in got)
    assert len(got) == 5100 and max(counts.values()) - min(counts.values()) <= 1
    assert {(r.shard, r.slot) for r in got} == {(s, i) for s, n in counts.items() for i in range(n)}
    assert max(largest) < 20
    by_source = Counter((r.shard, r.source) for r in got)
    assert all(5 <= by_source[s, "b"] <= 8 for s in counts)
