"""Containment search against a comparison of every item with every document."""

import pandas as pd

from stratalake.llm.decontamination import contained_items
from stratalake.llm.registry import op1_decontamination

SF = "/root/testdata/sf0.01"


def shingles(text, width):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", (text or "").translate(low)) if w]
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}, len(words)


def brute(docs, items, threshold=0.75):
    out = []
    for item_id, item_text in items:
        n = shingles(item_text, 1)[1]
        asked = shingles(item_text, min(5, n))[0] if n else set()
        for doc_id, text in docs if asked else []:
            overlap = len(asked & shingles(text, min(5, n))[0])
            if overlap >= threshold * len(asked):
                out.append((doc_id, item_id, len(asked), overlap))
    return sorted(out, key=str)


def _got(df):
    return sorted([(r.doc_id, r.item_id, r.item_shingles, r.overlap) for r in df.collect()], key=str)


def test_query_finds_what_brute_force_finds(spark):
    small = SF.replace("0.01", "0.001")
    docs = pd.read_parquet(f"{small}/documents.parquet")[["doc_id", "text"]].values.tolist()
    items = pd.read_parquet(f"{small}/benchmark.parquet")[["item_id", "text"]].values.tolist()
    found = _got(op1_decontamination(spark, small))
    assert found == brute(docs, items) and found


DOCS = [
    (1, "Some filler " * 3000 + "the quick brown fox jumps over the lazy dog today and then sleeps " + "x y z " * 9000),
    (2, "the quick brown fox jumps over the lazy dog today and"),
    (3, "THE QUICK\tbrown\nfox jumps"),
    (4, None),
    (5, ""),
    (None, "hello world one two three four"),
    (1, "hello   WORLD"),
    (7, "école hello"),
]
ITEMS = [
    (0, "the quick brown fox jumps over the lazy dog today and then sleeps"),
    (1, "the quick brown fox jumps over the lazy dog today and THEN"),
    (2, "Hello world"),
    (3, None),
    (4, ""),
    (5, "école"),
    (6, "École"),
    (0, "hello"),
    (None, "fox jumps"),
    (8, "q w e r t y u i o p"),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "'q' AS item_id", "1 AS block")
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "2 AS overlap")
    for block_bytes in (1 << 20, 64):
        assert _got(contained_items(docs, items, block_bytes=block_bytes)) == brute(DOCS, ITEMS)
    assert contained_items(docs, items.limit(0)).collect() == []
    assert contained_items(docs.limit(0), items).collect() == []


def test_part_of_an_item_counts_from_three_quarters_on(spark):
    words = [f"w{i}" for i in range(44)]  # 40 shingles
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    docs = [(n, "a b c " * 2000 + " ".join(words[:n]) + " d e" * 100) for n in range(30, 44)]
    found = contained_items(spark.createDataFrame(docs, "doc_id long, text string"), items)
    assert sorted(r.doc_id for r in found.collect()) == list(range(34, 44))
