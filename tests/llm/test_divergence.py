"""Source divergence against its SQL and against sums over all kept terms."""

import re
from collections import Counter, defaultdict

import pytest

from oracle import connect, differences
from stratalake.llm.divergence import SQL, source_divergence
from stratalake.llm.registry import op13_source_divergence

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    counts, documents, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))
        group = (lang or "", source or "")
        groups.add(group)
        counts[group].update(found)
        documents[group[0]].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in documents[lang].items() if n >= least)
        own = [g for g in groups if g[0] == lang]

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 5) // total for t in kept}

        p = {g: shares(counts[g]) for g in own}
        q = shares(sum((counts[g] for g in own), Counter()))
        for g in own:
            pairs = [(h[1], sum(abs(p[g][t] - p[h][t]) for t in kept)) for h in own if h != g]
            terms = [(t, p[g][t] - q[t]) for t in kept if counts[g][t] and p[g][t] > q[t]]
            for part, listed, limit in (("pair", pairs, None), ("term", terms, top)):
                listed.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(*g, part, item, value, i) for i, (item, value) in enumerate(listed[:limit], 1)]
    return sorted(out)


def _got(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_has_the_rows_of_its_sql(spark, sf):
    df = op13_source_divergence(spark, sf)
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert differences(df, connect(sf), SQL) == []


ROWS = [
    ("A b a, c! École ÉCOLE", "en", "x"),
    ("a a b1b", "en", "y"),
    ("a b", "en", "y"),
    ("a b", "en", "y"),
    ("c c c d", "en", None),
    (None, "en", "empty"),
    ("", None, None),
    ("123 !?", "fr", "x"),
    ("mot", "fr", "y"),
    ("mot mot   \U0001f600a", None, "y"),
    ("a " * 50_000 + "z", "en", "long"),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, "text string, lang string, source string").selectExpr(
        "*", "1 AS term", "2 AS n", "3 AS base", "CAST(NULL AS bigint) AS doc_id"
    )
    for least, top, postings in ((1, 2, 3), (2, 50, 1), (3, 50, 100)):
        got = source_divergence(docs, least_documents=least, top_terms=top, block_postings=postings)
        assert _got(got) == brute(ROWS, least, top)
    assert source_divergence(docs.limit(0)).collect() == []


def test_a_language_without_kept_terms_has_pairs_of_nothing(spark):
    docs = spark.createDataFrame(ROWS[:4], "text string, lang string, source string")
    assert _got(source_divergence(docs)) == [
        ("en", "x", "pair", "y", 0, 1),
        ("en", "y", "pair", "x", 0, 1),
    ]


def test_one_source_with_most_rows_and_many_small_ones(spark):
    rows = [(f"w{chr(97 + i % 7)} v{chr(97 + i % 5)} same", "en", "hot") for i in range(600)]
    rows += [(f"w{chr(97 + i % 7)} same u{chr(97 + i % 3)}", "en", f"s{i % 40}") for i in range(300)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert _got(source_divergence(docs, block_postings=20)) == brute(rows, 30, 50)
