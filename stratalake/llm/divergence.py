"""How far the sources of a language are from one another: Gustavson row accumulation.

Terms are counted per task and group (lang, source) before they are shuffled. The counts of the kept
terms are the term-major index: for each term the groups that use it. It is cut by term into blocks.
In a block every group is a row of a sparse product: its terms are scattered through the index into
one dense accumulator with a place per peer, so pairs of postings are never rows. The accumulator is
64-bit; a block gives one number per pair of groups that met in it, and blocks are summed.

Zero baselines: a term that a group lacks still has the smoothed share ``base`` there. For a pair
(g, h) with shares p, q and B = base of the group meant, the sum over all V kept terms of |p - q| is

    sum over g's terms of |p - B(h)|  +  sum over h's terms of |B(g) - q|
    + (V - terms of g - terms of h) * |B(g) - B(h)|
    + sum over shared terms of |p - q| - |p - B(h)| - |B(g) - q| + |B(g) - B(h)|

The last line is what is scattered. The first two need the terms of one group alone, held as a
histogram: shares are equal where counts are, so it is short.

Defined cases: NULL text, lang or source is the empty text. Repeated rows count as often as they
stand there; ids are not used. A group without kept terms is a peer like others. A language without
kept terms (V = 0) has pairs of value 0 and no terms. An empty table gives an empty result. Other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import ASCII_LOWER, settings
from stratalake.session import staged

LEAST_DOCUMENTS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
_HELD_TERMS = 400_000
_BLOCK_POSTINGS = 200_000
_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}

#: Letters stay, A-Z as a-z, and so does every byte of a longer character; all else is a space.
_LETTERS = bytes(
    code if code >= 0x80 or chr(code).isalpha() else 0x20 for code in ASCII_LOWER
)
_COUNTED = ["lang", "source", "term", "n", "docs"]


def term_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows (lang, source, term, n, docs): occurrences and documents of each term in each group.

    A group also has a row with a NULL term, so that groups without terms are known.
    """
    named = docs.select(
        *[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
        docs[text_col].cast("string").cast("binary").alias("text"),
    )
    partial = named.mapInArrow(_count, "lang string, source string, term string, n bigint, docs bigint")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            occurrences, documents = held.setdefault((lang, source), (Counter(), Counter()))
            found = text.translate(_LETTERS).split() if text else []
            occurrences.update(found)
            documents.update(set(found))
        if sum(len(documents) for _, documents in held.values()) > _HELD_TERMS:
            yield from _counted(held)
            held = {}
    yield from _counted(held)


def _counted(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (occurrences, documents) in held.items():
        terms = list(occurrences)
        rows = len(terms) + 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * rows, pa.string()),
                pa.array([source] * rows, pa.string()),
                pa.array([None, *terms], pa.binary()).cast(pa.string()),
                pa.array([0, *occurrences.values()], pa.int64()),
                pa.array([0, *(documents[t] for t in terms)], pa.int64()),
            ],
            _COUNTED,
        )


def _share(count: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (count + SMOOTHING) / (total + SMOOTHING * kept)), in exact integers."""
    return F.expr(
        f"1 + (CAST({SCALE} AS DECIMAL(20,0)) * CAST({count} + {SMOOTHING} AS DECIMAL(18,0)))"
        f" div CAST({total} + {SMOOTHING} * {kept} AS DECIMAL(20,0))"
    )


def _scatter(index: pd.DataFrame) -> pd.DataFrame:
    """Rows (lang, source, item, shared) of a block of the term-major index of one language."""
    peers, row = np.unique(index["source"].to_numpy(dtype=object), return_inverse=True)
    term = pd.factorize(index["term"])[0]
    share, base = (index[c].to_numpy(np.int64) for c in ("p", "base"))
    by_term = np.argsort(term, kind="stable")
    starts = np.searchsorted(term[by_term], np.arange(term.max() + 2))
    by_row = np.argsort(row, kind="stable")
    row_ends = np.searchsorted(row[by_row], np.arange(len(peers) + 1))
    out: list[tuple[np.ndarray, ...]] = []
    for group in range(len(peers)):
        own = by_row[row_ends[group] : row_ends[group + 1]]
        first, lengths = starts[term[own]], starts[term[own] + 1] - starts[term[own]]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1]) + np.repeat(first - (ends - lengths), lengths)
        met = by_term[places]
        p, b, q, h = np.repeat(share[own], lengths), base[own[0]], share[met], base[met]
        accumulator = np.zeros(len(peers), np.int64)
        np.add.at(accumulator, row[met], np.abs(p - q) - np.abs(p - h) - np.abs(b - q) + np.abs(b - h))
        accumulator[group] = 0
        peer = np.flatnonzero(accumulator)
        out.append((np.full(len(peer), group), peer, accumulator[peer]))
    group, peer, shared = (np.concatenate(c) for c in zip(*out, strict=True))
    return pd.DataFrame(
        {"lang": index["lang"].iloc[0], "source": peers[group], "item": peers[peer], "shared": shared}
    )


def source_divergence(
    docs: DataFrame,
    text_col: str = "text",
    least_documents: int = LEAST_DOCUMENTS,
    top_terms: int = TOP_TERMS,
    block_postings: int = _BLOCK_POSTINGS,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank).

    ``pair``: the distance to each other source of the language, farthest first. ``term``: kept
    terms that the group uses more than its language does, at most ``top_terms``.
    """
    with settings(docs.sparkSession, _BATCHES):
        counts = staged(term_counts(docs, text_col), "divergence-counts")
    terms = counts.where("term IS NOT NULL")
    kept = (
        terms.groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least_documents)
        .select("lang", "term", "lang_n")
    )
    used = staged(terms.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "divergence-used")
    langs = (
        used.groupBy("lang", "term")
        .agg(F.first("lang_n").alias("lang_n"))
        .groupBy("lang")
        .agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    )
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("terms"))
    groups = (
        counts.where("term IS NULL")
        .select("lang", "source")
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .na.fill(0, ["total", "terms", "v", "lang_total"])
        .withColumn("base", F.when(F.col("v") > 0, _share("0", "total", "v")).otherwise(0))
    )
    groups = staged(groups, "divergence-groups")
    shares = used.join(groups, ["lang", "source"]).withColumns(
        {"p": _share("n", "total", "v"), "q": _share("lang_n", "lang_total", "v")}
    )
    index = staged(shares.select("lang", "source", "term", "p", "q", "base"), "divergence-index")
    return _pairs(index, groups, block_postings).unionByName(_terms(index, top_terms))


def _pairs(index: DataFrame, groups: DataFrame, block_postings: int) -> DataFrame:
    blocks = max(1, math.ceil(index.count() / block_postings))
    met = (
        index.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks)))
        .groupBy("lang", "block")
        .applyInPandas(_scatter, "lang string, source string, item string, shared bigint")
        .groupBy("lang", "source", "item")
        .agg(F.sum("shared").alias("shared"))
    )
    histogram = (
        index.groupBy("lang", "source", "p")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("lang", "source")
        .agg(F.collect_list(F.struct("p", "n")).alias("shares"))
    )
    sides = groups.join(histogram, ["lang", "source"], "left").select(
        "lang", "source", "terms", "v", "base", F.coalesce("shares", F.expr("CAST(array() AS array<struct<p: bigint, n: bigint>>)")).alias("shares")
    )
    other = sides.select(
        "lang", *[F.col(c).alias(f"h_{c}") for c in ("terms", "base", "shares")], F.col("source").alias("item")
    )
    alone = "aggregate({0}, 0L, (s, x) -> s + x.n * abs(x.p - {1}))"
    value = F.expr(
        f"{alone.format('shares', 'h_base')} + {alone.format('h_shares', 'base')}"
        " + (v - terms - h_terms) * abs(base - h_base) + coalesce(shared, 0)"
    )
    pairs = (
        sides.join(other, "lang")
        .where("source != item")
        .join(met, ["lang", "source", "item"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    )
    return pairs.withColumn("rank", _rank())


def _rank() -> Column:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return F.row_number().over(order)


def _terms(index: DataFrame, top_terms: int) -> DataFrame:
    more = index.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )
    return more.withColumn("rank", _rank()).where(F.col("rank") <= top_terms)


SQL = """
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text,
         row_number() OVER () AS r
  FROM documents
), tokens AS (
  SELECT lang, source, r, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM d
), tf AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM tokens GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(n) AS n FROM tf GROUP BY ALL HAVING sum(docs) >= 30
), langs AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), g AS (
  SELECT DISTINCT lang, source FROM d
), filled AS (
  SELECT g.lang, g.source, k.term, coalesce(tf.n, 0) AS n, k.n AS lang_n
  FROM g JOIN kept k ON k.lang = g.lang
  LEFT JOIN tf ON tf.lang = g.lang AND tf.source = g.source AND tf.term = k.term
), shares AS (
  SELECT f.lang, f.source, f.term, f.n,
         1 + (1000000000::HUGEINT * (f.n + 5)) // (sum(f.n) OVER (PARTITION BY f.lang, f.source) + 5 * l.v) AS p,
         1 + (1000000000::HUGEINT * (f.lang_n + 5)) // (l.total + 5 * l.v) AS q
  FROM filled f JOIN langs l USING (lang)
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce((SELECT sum(abs(x.p - y.p)) FROM shares x JOIN shares y
                   ON y.lang = x.lang AND y.term = x.term
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
)
SELECT lang, source, part, item, value, rank::INT AS rank FROM ranked
WHERE part = 'pair' OR rank <= 50
"""
