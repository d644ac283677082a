"""Scores against a model counted in plain dictionaries."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd

from stratalake.llm import interpolated_lm as lm
from stratalake.llm.registry import op9_lm_scoring

SF = "/root/testdata/sf0.01"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)) + [None]


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7


def brute(rows):
    learned, learned_pairs, main, main_pairs = Counter(), Counter(), Counter(), Counter()
    for doc_id, text in rows:
        t = tokens(text)
        if fold(doc_id) != 2:
            learned.update(t)
            learned_pairs.update(zip([None, *t], t))
        if fold(doc_id) not in (2, 3):
            main.update(t)
            main_pairs.update(zip([None, *t], t))
    n, v = sum(learned.values()), len(learned)

    def parts(a, b, words, pairs, total):
        c = words[a]
        bucket = min(int(math.log2(c)) + 1, lm.BUCKETS - 1) if c else 0
        return bucket, (pairs[a, b] / c if c else 0.0), words[b] / max(total, 1)

    events, n_main = [], sum(main.values())
    for doc_id, text in rows:
        if fold(doc_id) == 3:
            t = tokens(text)
            events += [parts(a, b, main, main_pairs, n_main) for a, b in zip([None, *t], t)]
    rounded = lambda x: round(lm._GRID * math.log10(x)) if x else lm._NONE
    grid = Counter((b, rounded(r2), rounded(r1)) for b, r2, r1 in events)
    frame = pd.DataFrame([(*k, c) for k, c in grid.items()], columns=["bucket", "b2", "b1", "n"])
    weights = lm.learn_weights(frame.astype("int64"), 1 / (len(main) + 1))
    out = {}
    for doc_id, text in rows:
        t, score = tokens(text), 0.0
        for a, b in zip([None, *t], t):
            bucket, r2, r1 = parts(a, b, learned, learned_pairs, n)
            score += math.log10(weights[bucket] @ np.array([r2, r1, 1 / (v + 1)]))
        base = sum(math.log10((learned[w] + 1) / (n + v + 1)) for w in t)
        known = sum(learned[w] > 0 for w in t)
        out[doc_id] = (fold(doc_id) == 2, len(t), known, n, base, score)
    return out


def _compare(found, rows):
    expected = brute(rows)
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        held, n, known, total, base, score = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-7)


def test_query_over_all_documents(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")[["doc_id", "text"]].values.tolist()
    found = op9_lm_scoring(spark, SF).cache()
    _compare(found, docs)
    held = [r for r in found.collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    found.unpersist()


def test_odd_rows_and_small_batches(spark, tmp_path, monkeypatch):
    rows = [(i, f"the Cat sat on the mat {i % 5} École " * (i % 4)) for i in range(60)]
    rows += [(100, None), (101, ""), (None, " \t\n"), (2**60 + 1, "x " * 50_000)]
    schema = "doc_id long, text string"
    frame = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS batch", "2 AS score", "'x' AS `__row`")
    frame.repartition(3).write.parquet(str(tmp_path / "a"))
    docs = spark.read.parquet(str(tmp_path / "a"))
    _compare(lm.score_corpus(docs), rows)
    monkeypatch.setattr(lm, "BATCH_BYTES", 20_000)
    monkeypatch.setattr(lm, "_BLOCK_ENTRIES", 1000)
    _compare(lm.score_corpus(docs), rows)


def test_nothing_to_learn_from_and_empty(spark, tmp_path):
    alone = next(i for i in range(100) if fold(i) == 2)
    for name, rows in (("one", [(alone, "a b")]), ("none", [])):
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / name))
        _compare(lm.score_corpus(spark.read.parquet(str(tmp_path / name))), rows)


def test_weights_add_up_and_follow_the_events():
    events = pd.DataFrame({"bucket": [3, 3, 0], "b2": [-5, lm._NONE, lm._NONE], "b1": [-60, -40, -40], "n": [900, 100, 50]})
    weights = lm.learn_weights(events, 1e-6)
    assert np.allclose(weights.sum(1), 1) and weights[3, 0] > 0.8 and weights[0, 0] == 0


def test_hashes_survive_packing():
    values = np.unique(np.random.default_rng(0).integers(0, 2**64, 1000, dtype=np.uint64))
    assert (lm._unpacked(lm._packed(values)) == values).all()
    assert len(lm._unpacked(lm._packed(values[:0]))) == 0


def test_all_learning_documents_count(spark, tmp_path, monkeypatch):
    weights = np.tile([0.5, 0.3, 0.2], (lm.BUCKETS, 1))
    monkeypatch.setattr(lm, "learn_weights", lambda events, r0: weights)
    monkeypatch.setattr(lm, "BATCH_BYTES", 500)
    rows = [(i, f"the cat {i % 6} sat on only{i} mat") for i in range(80)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame.repartition(2).write.parquet(str(tmp_path / "a"))
    words, pairs = Counter(), Counter()
    for i, text in rows:
        if fold(i) != 2:
            t = tokens(text)
            words.update(t)
            pairs.update(zip([None, *t], t))
    n, r0 = sum(words.values()), 1 / (len(words) + 1)
    expected = {}
    for i, text in rows:
        t = tokens(text)
        expected[i] = sum(
            math.log10(0.5 * (pairs[a, b] / words[a] if words[a] else 0) + 0.3 * words[b] / n + 0.2 * r0)
            for a, b in zip([None, *t], t)
        )
    got = lm.score_corpus(spark.read.parquet(str(tmp_path / "a"))).collect()
    assert len(got) == len(rows)
    assert all(math.isclose(r.score, expected[r.doc_id], rel_tol=1e-9) for r in got)


def test_long_texts_that_stand_together_share_no_large_batch(spark, tmp_path):
    rows = [(i, "w" * (40_000 if 100 <= i < 140 else 700_000 if i == 7 else 50)) for i in range(3000)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "a"))
    docs = spark.read.parquet(str(tmp_path / "a"))
    size = sum(len(t) + 1 for _, t in rows)
    mean, limit = size / len(rows), 100_000
    placed = lm._documents(docs, "doc_id", "text", max(1, int(limit * len(rows) // size)), mean).toPandas()
    batches = placed.groupby("batch")["text"].agg([lambda x: sum(map(len, x)), "size"])
    sizes = batches.iloc[:, 0]
    assert ((sizes <= 4 * limit) | (batches["size"] == 1)).all() and len(placed) == len(rows)
    _compare(lm.score_corpus(docs), rows)
