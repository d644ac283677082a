"""The blocked product against a comparison of all pairs, and its components against union-find."""

import random
import re
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from stratalake.llm import jaccard_join
from stratalake.llm.components import connected_components
from stratalake.llm.jaccard_join import jaccard_components
from stratalake.llm.registry import op5_jaccard_join

SF = "/root/testdata/sf0.01"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """All pairs that share a shingle, compared in full."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(
        [(doc_id, len(sets[i]), least.get(find(i))) for i, (doc_id, _) in enumerate(rows)], key=str
    )


def _got(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()], key=str)


def test_query_over_all_documents(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")[["doc_id", "text"]]
    found = _got(op5_jaccard_join(spark, SF))
    assert found == brute(docs.values.tolist())
    assert any(c != d for d, _, c in found)


def _corpus(seed):
    """Near copies of many degrees, a common passage, short texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    passage = [word() for _ in range(40)]
    rows = []
    for _ in range(4):
        base = [word() for _ in range(rng.randint(8, 120))]
        for _ in range(rng.randint(5, 40)):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy[: rng.randint(int(len(copy) * 0.8), len(copy))]))
    rows += [" ".join(passage + [word() for _ in range(rng.randint(0, 30))]) for _ in range(40)]
    rows += [" ".join(word() for _ in range(rng.randint(1, 7))) for _ in range(20)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("long_column", [2, 8, 64])
def test_all_links_are_found_with_hot_columns_too(spark, long_column):
    for seed in (1, 2):
        rows = _corpus(seed)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        assert _got(jaccard_components(docs, long_column=long_column)) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A\tB"), (None, "a b"), (5, "A\tB"), (6, "b a"),
        (7, "x y z u v w " * 4000), (8, "X y z u v w " * 4000 + "end"), (None, "alone"), (None, None),
        (9, "é à"), (10, "É à"), (11, "a b c"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS class", "2 AS n", "'x' AS component"
    )
    assert _got(jaccard_components(docs)) == brute(rows)
    assert jaccard_components(docs.limit(0)).collect() == []


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)]
    edges += [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)] + [(400, 400)]
    parent = {n: n for e in edges for n in e}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    alone = {400} | {a for a, b in edges if a == b}
    assert got == {n: find(n) for n in parent if n in got}
    assert set(parent) - set(got) <= alone


def test_strangers_on_one_shingle_form_no_pairs(spark, monkeypatch):
    """Texts that share a third of their shingles, all of them hot, without being linked."""
    template = " ".join(f"t{i}" for i in range(10))
    seen = {}
    original = jaccard_join.staged

    def counted(df, purpose):
        found = original(df, purpose)
        seen[purpose] = seen.get(purpose, 0) + found.count()
        return found

    monkeypatch.setattr(jaccard_join, "staged", counted)
    for n in (500, 1000):
        rows = [(i, f"{template} " + " ".join(f"u{i}x{j}" for j in range(9))) for i in range(n)]
        rows += [(n + i, f"s{i} s{i + 1} s{i + 2} hot hot hot hot hot") for i in range(n)]
        seen.clear()
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        got = jaccard_join.jaccard_components(docs).collect()
        assert all(r.component_id == r.doc_id for r in got) and len(got) == 2 * n
        assert seen.get("jaccard-across", 0) + seen["jaccard-pairs"] <= 4 * n


def test_only_texts_that_are_asked_for_are_cut_into_shingles(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "g h i j k l")], "doc_id long, text string")
    rows = {r.doc_id: r for r in jaccard_join._profiles(docs, ["doc_id"], "text").where("n > 0").collect()}

    def found(class_of, spot_of):
        wanted = [(rows[class_of]["class"], rows[spot_of].spot if "spot" in rows[spot_of] else 0)]
        wanted = spark.createDataFrame(wanted, "class long, spot long")
        return jaccard_join._sets(docs, "text", wanted).count()

    assert found(1, 1) == 1
    assert found(1, 2) == 0


def test_block_is_multiplied_in_little_memory():
    """A full block of columns: two tasks of an executor do so at a time, beside its heap."""
    rng, per, docs = np.random.default_rng(7), 10_000, 5_000
    pool = rng.integers(0, 1 << 62, jaccard_join._BLOCK_ENTRIES // 2, dtype=np.uint64)
    blobs = []
    for _ in range(jaccard_join._BLOCK_ENTRIES // per):
        entry = np.empty(per, jaccard_join._BLOB_ENTRY)
        entry["value"], entry["doc"] = rng.choice(pool, per), rng.integers(0, docs, per)
        entry["pos"] = rng.integers(0, 80, per)
        about = np.empty(docs, jaccard_join._BLOB_DOC)
        about["class"], about["n"] = rng.integers(0, 1 << 60, docs), 320
        data = b"".join(entry[f].tobytes() for f in jaccard_join._BLOB_ENTRY.names)
        blobs.append((data, about.tobytes()))
    group = pd.DataFrame(blobs, columns=["data", "docs"])
    tracemalloc.start()
    found = jaccard_join._multiply_block(75, 8)(group)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) and peak < 30e6
