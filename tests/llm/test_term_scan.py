"""Ranked search against its SQL and against a score of every item and document."""

import math
import re
from collections import Counter

import pytest

from oracle import connect, differences
from stratalake.llm.registry import op11_ranked_search
from stratalake.llm.term_scan import SQL, automaton_of, guarded, n_terms, ranked_documents, term_frequencies

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute(docs, items, top=10):
    held = [(doc_id, Counter(found), len(found)) for doc_id, text in docs if (found := terms_of(text))]
    n, total = len(held), sum(size for _, _, size in held)
    df = Counter(t for _, counts, _ in held for t in counts)
    asked = {}
    for item_id, text in items:
        asked.setdefault(item_id, set()).update(terms_of(text))
    out = []
    for item_id, terms in asked.items():
        scored = []
        for doc_id, counts, size in held:
            m = 10 + 90 * size * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
                for t in terms
                if (tf := counts[t])
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        scored.sort(key=lambda x: x[:3])
        out += [(item_id, i, x[3], -x[0]) for i, x in enumerate(scored[:top], 1)]
    return sorted(out, key=str)


def _got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_has_the_rows_of_its_sql(spark, sf):
    df = op11_ranked_search(spark, sf)
    assert df.columns == ["item_id", "rank", "doc_id", "score"] and df.count() > 0
    assert differences(df, connect(sf), SQL) == []


def test_hits_are_whole_terms_and_neighbours_share_a_guard():
    automaton = automaton_of([b"a", b"ab", "é".encode(), b"a1"])
    text = guarded("A a,a ab abc é éa a1 1a".encode())
    found, counts = term_frequencies(automaton, text)
    assert dict(zip(found.tolist(), counts.tolist(), strict=True)) == {0: 3, 1: 1, 2: 1, 3: 1}
    assert n_terms(text) == 9 and n_terms(b"") == 0 and n_terms(b"  ") == 0


DOCS = [
    (1, "The quick brown fox, the lazy dog. " + "filler words " * 4000 + "rare1"),
    (2, "quick quick Quick fox"),
    (3, "quick quick quick fox"),
    (None, "quick quick quick FOX"),
    (2, "quick quick quick fox"),
    (4, None),
    (5, ""),
    (6, " .,!\x00\x7f"),
    (7, "École 東京 rare1"),
    (8, "école"),
    (-9, "dog's fox-trot"),
    *((100 + i, "same words in all of these") for i in range(25)),
]
ITEMS = [
    (0, "quick FOX fox"),
    (1, "école rare1 東京"),
    (2, None),
    (3, ""),
    (4, "!!"),
    (5, "nothing of the kind"),
    (0, "dog"),
    (None, "s trot"),
    (6, "same words"),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "1 AS score", "'x' AS terms", "2 AS n")
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "3 AS term", "4 AS doc_id")
    for top, block_bytes in ((10, 1 << 20), (2, 40)):
        got = ranked_documents(docs.repartition(3), items, top=top, block_bytes=block_bytes)
        assert _got(got) == brute(DOCS, ITEMS, top)
    for no_docs, no_items in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("doc_id = 6"), items)):
        assert ranked_documents(no_docs, no_items).collect() == []


def test_many_ties_and_one_hot_term(spark):
    docs = [(i * 7919 % 3001, f"hot hot{i % 3} word{i % 50}") for i in range(3000)]
    items = [(i, f"hot hot{i % 3} word{i}") for i in range(60)]
    got = ranked_documents(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(6),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert _got(got) == brute(docs, items)
