"""Near duplicates by sketches against a comparison of all pairs."""

import math
import random
import re

import pandas as pd
import pytest

from stratalake.llm.bottom_k import least_common, near_duplicates, prefix_length
from stratalake.llm.registry import op12_minhash_dedup

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    found = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOW))
    if len(found) < 5:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + 5]) for i in range(len(found) - 4))


def brute(docs, percent=85):
    sets = [shingles(text) for _, text in docs]
    by_set = {}
    for i, s in enumerate(sets):
        by_set.setdefault(s, []).append(i)
    parent = {s: s for s in by_set}

    def root(s):
        while parent[s] != s:
            s = parent[s]
        return s

    holders = {}
    for s in by_set:
        met = {}
        for x in s:
            for other in holders.setdefault(x, []):
                met[other] = met.get(other, 0) + 1
            holders[x].append(s)
        for other, common in met.items():
            if 100 * common >= percent * (len(s) + len(other) - common):
                parent[root(s)] = root(other)
    least = {}
    for s, rows in by_set.items():
        ids = [docs[i][0] for i in rows if docs[i][0] is not None]
        if ids:
            least[root(s)] = min([least.get(root(s), math.inf), *ids])
    return sorted(
        ((doc_id, len(s), least.get(root(s)) if s else doc_id) for (doc_id, _), s in zip(docs, sets, strict=True)),
        key=str,
    )


def _got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_finds_what_all_pairs_find(spark, sf):
    docs = pd.read_parquet(f"{sf}/documents.parquet")[["doc_id", "text"]].values.tolist()
    found = op12_minhash_dedup(spark, sf)
    rows = found.collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str) == brute(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert len({r.component_id for r in rows}) < len(rows)


ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one two"),
    (5, "ONE  two"),
    (None, "one two"),
    (None, "only without an id"),
    (None, None),
    (6, "a b c d e f g h i j k"),
    (6, "a b c d e f g h i j k"),
    (7, "a b c d e"),
    (8, "É b c d e"),
    (9, "é b c d e"),
    (10, "long " * 30_000 + "end"),
    (11, " ".join(f"x{i}" for i in range(5_000))),
    (12, " ".join(f"x{i}" for i in range(5_000)) + " y z"),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr(
        "*", "1 AS n", "'q' AS class", "2 AS component", "3 AS spot", "4 AS value"
    )
    assert _got(near_duplicates(docs)) == brute(ODD)
    assert near_duplicates(docs.limit(0)).collect() == []


def _edited(rng, base, edits):
    text = list(base)
    for _ in range(edits):
        text[rng.randrange(len(text))] = f"new{rng.randrange(40)}"
    return " ".join(text)


@pytest.mark.parametrize("sketch", [16, 64, 128])
def test_groups_of_near_copies_of_all_sizes(spark, sketch):
    rng = random.Random(sketch)
    docs = []
    for group in range(60):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([6, 20, 60, 150, 400]))]
        docs += [_edited(rng, base, rng.randrange(6)) for _ in range(rng.choice([1, 2, 5, 40]))]
    docs = [(rng.randrange(10**6), text) for text in docs]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert _got(near_duplicates(frame, sketch=sketch, long_list=4)) == brute(docs)


def test_a_template_of_a_third_of_all_rows(spark):
    """Strangers on one template, and variants of it of which only neighbours are linked."""
    rng = random.Random(3)
    template = [f"t{i}" for i in range(100)]
    strangers = [" ".join(template[:80] + [f"s{i}x{j}" for j in range(20)]) for i in range(300)]
    chain = [" ".join(template[:60] + [f"c{i + j}" for j in range(60)]) for i in range(200)]
    rest = [" ".join(f"r{rng.randrange(9000)}" for _ in range(50)) for _ in range(400)]
    docs = list(enumerate(strangers + chain + rest))
    rng.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for sketch in (32, 128):
        assert _got(near_duplicates(frame, sketch=sketch)) == brute(docs)


def test_bounds():
    least = least_common(128, 85)
    tail = sum(math.comb(128, i) * 0.85**i * 0.15 ** (128 - i) for i in range(least))
    assert tail <= 1e-12 < tail + math.comb(128, least) * 0.85**least * 0.15 ** (128 - least)
    assert [prefix_length(n, 128, 85, least) for n in (1, 6, 7, 100, 108)] == [1, 1, 2, 16, 17]
    assert prefix_length(10_000, 128, 85, least) == 128 - least + 1
