"""Ranked search without a document index: an Aho-Corasick scan of the documents.

The terms of the asked items, each with a guard on both sides, form one automaton that is broadcast.
Every text is read once; separators become the guard, so a hit is a whole term and its number of hits
is the term frequency. What a document holds of the terms, and per task how many documents hold
each, is staged: corpus statistics are known only after all documents have been read. The scores
follow from the staged counts. An output of the automaton is a term; a list per term names the items
that ask for it, and contributions are added into one place per document and item. Tasks keep the
best rows of each item, by the full order, and those meet in one last ranking.

Bounds: items are dealt into blocks by a hash of their id, so that a block's terms and lists stay
near ``BLOCK_BYTES`` (a larger item is a block of its own); the documents are read once per block, and
a block's broadcasts end with it. Documents are never shuffled. A task holds an Arrow batch of texts
and ``_CELLS`` scores. All documents count for the statistics and are ranked.

Defined cases: a NULL or empty text, or one without terms, has no terms, does not count as a
document and matches nothing; an item without terms has no rows. Item rows with the same id are one
item with the terms of all. Document rows with the same id are ranked one by one, and a NULL id comes
last among equal scores. Empty tables give an empty result. Other columns, whatever their names, are
ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import ASCII_LOWER, settings
from stratalake.session import shared_folder, staged

TOP = 10
BLOCK_BYTES = 8 << 20
_CELLS = 1 << 20
_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}

#: Letters, digits and bytes of longer characters stay, A-Z as a-z; all else is the guard.
_GUARDED = bytes(
    code if code >= 0x80 or chr(code).isalnum() else 0x20 for code in ASCII_LOWER
)
_HIT = itemgetter(1)


def guarded(text: bytes | None) -> bytes:
    return text.translate(_GUARDED) if text else b""


def n_terms(guarded_text: bytes) -> int:
    """Number of terms of a guarded text."""
    inside = np.frombuffer(guarded_text, np.uint8) != 0x20
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]) + inside[:1].sum())


def automaton_of(terms: list[bytes]) -> ahocorasick.Automaton:
    """Outputs the place of a term in ``terms``. Bytes are fed as characters of one byte."""
    built = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for number, term in enumerate(terms):
        built.add_word(f" {term.decode('latin-1')} ", number)
    built.make_automaton()
    return built


def term_frequencies(automaton: ahocorasick.Automaton, guarded_text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the terms in a text, ascending, and how often each occurs."""
    hits = automaton.iter(f" {guarded_text.decode('latin-1')} ")
    return np.unique(np.fromiter(map(_HIT, hits), np.int64), return_counts=True)


#: The automaton of this worker: name of the block, automaton. A worker holds one at a time.
_HELD: list = ["", None]


def _automaton(name: str, terms: list[bytes]) -> ahocorasick.Automaton | None:
    if _HELD[0] != name:
        _HELD[:] = [name, None]
        _HELD[1] = automaton_of(terms) if terms else None
    return _HELD[1]


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct rows (item_id, term)."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(guarded(text).split())) for text in batch[1].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch[0], pa.array(found, pa.list_(pa.binary()))], ["item_id", "terms"]
            )

    named = items.select(
        items[id_col].cast("bigint").alias("item_id"), items[text_col].cast("string").cast("binary").alias("text")
    )
    split_items = named.mapInArrow(split, "item_id bigint, terms array<binary>")
    return split_items.select("item_id", F.explode("terms").alias("term")).distinct()


def _scan(name: str, held):
    """Rows of documents with hits, and a row of statistics per task."""
    names = ["doc_id", "n", "terms", "counts", "documents", "total"]

    def rows(ids, sizes, terms, counts, documents, total) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array(sizes, pa.int64()),
                pa.array(terms, pa.list_(pa.int32())),
                pa.array(counts, pa.list_(pa.int64())),
                pa.array(documents, pa.int64()),
                pa.array(total, pa.int64()),
            ],
            names,
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = held.value
        automaton = _automaton(name, terms)
        containing, documents, total = np.zeros(len(terms), np.int64), 0, 0
        for batch in batches:
            at, sizes, found, counts = [], [], [], []
            for i, text in enumerate(batch[1].to_pylist()):
                clean = guarded(text)
                n = n_terms(clean)
                documents += n > 0
                total += n
                if not n:
                    continue
                own, often = term_frequencies(automaton, clean)
                if len(own):
                    containing[own] += 1
                    at.append(i)
                    sizes.append(n)
                    found.append(own.astype(np.int32))
                    counts.append(often)
            if at:
                nothing = [None] * len(at)
                yield rows(batch[0].take(pa.array(at, pa.int64())), sizes, found, counts, nothing, nothing)
        used = np.flatnonzero(containing)
        yield rows(
            pa.nulls(1, pa.int64()), [None], [used.astype(np.int32)], [containing[used]], [int(documents)], [total]
        )

    return scan


class _Best:
    """The best rows of each item so far."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.least = np.ones(items, np.int64)
        self.rows = tuple(np.zeros(0, np.int64) for _ in range(4))  # item, score, NULL id, id

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        """``scores``: a row per document, a column per item."""
        doc, item = np.nonzero(scores >= self.least)
        fresh = (item, scores[doc, item], no_id[doc], ids[doc])
        item, score, missing, doc_id = (np.concatenate(x) for x in zip(self.rows, fresh, strict=True))
        order = np.lexsort((doc_id, missing, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order, item, place = order[place < self.top], item[place < self.top], place[place < self.top]
        self.rows = (item, score[order], missing[order], doc_id[order])
        last = place == self.top - 1
        self.least[item[last]] = self.rows[1][last]


def _score(held, top: int):
    """Best rows (item_id, doc_id, score) of a task."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, starts, asking, weights, documents, total = held.value
        best = _Best(len(items), top)
        for batch in batches:
            missing = batch["doc_id"].is_null().to_numpy(zero_copy_only=False)
            ids = batch["doc_id"].fill_null(0).to_numpy()
            ends = batch["terms"].offsets.to_numpy() - batch["terms"].offsets[0].as_py()
            term = batch["terms"].flatten().to_numpy().astype(np.int64)
            tf = batch["counts"].flatten().to_numpy()
            doc = np.repeat(np.arange(len(ids)), np.diff(ends))
            length = 100 - 90 + (90 * batch["n"].to_numpy() * documents) // total
            part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * length[doc]))
            lists = starts[term + 1] - starts[term]
            until = np.concatenate([[0], np.cumsum(lists)])
            first = 0
            while first < len(ids):
                # As many documents as fit, in cells of scores and in list entries; one at least.
                fits = np.searchsorted(until[ends], until[ends[first]] + 2 * _CELLS, "right") - 1
                after = max(first + 1, min(fits, first + _CELLS // len(items), len(ids)))
                own = slice(ends[first], ends[after])
                n = lists[own]
                entry = np.repeat(starts[term[own]] - np.cumsum(n) + n, n) + np.arange(n.sum())
                cells = np.zeros((after - first, len(items)), np.int64)
                place = np.repeat(doc[own] - first, n) * len(items) + asking[entry]
                np.add.at(cells.reshape(-1), place, np.repeat(part[own], n))
                best.add(cells, ids[first:after], missing[first:after].astype(np.int64))
                first = after
        item, scored, no_id, doc_id = best.rows
        yield pa.RecordBatch.from_arrays(
            [
                items.take(pa.array(item)),
                pa.array(doc_id, pa.int64(), mask=no_id.astype(bool)),
                pa.array(scored, pa.int64()),
            ],
            ["item_id", "doc_id", "score"],
        )

    return score


def _block(texts: DataFrame, asked: pa.Table, top: int) -> DataFrame | None:
    """The best rows of each task for the items of one block; ``asked`` holds its (item_id, term)."""
    context = texts.sparkSession.sparkContext
    by_term = asked.column("term").combine_chunks().dictionary_encode()
    by_item = asked.column("item_id").combine_chunks().dictionary_encode("encode")
    terms = by_term.dictionary.to_pylist()
    order = np.argsort(by_term.indices.to_numpy(), kind="stable")
    starts = np.searchsorted(by_term.indices.to_numpy()[order], np.arange(len(terms) + 1))
    asking = by_item.indices.to_numpy()[order].astype(np.int64)

    held = context.broadcast(terms)
    schema = "doc_id bigint, n bigint, terms array<int>, counts array<bigint>, documents bigint, total bigint"
    counted = staged(texts.mapInArrow(_scan(uuid.uuid4().hex, held), schema), "scan-counts")
    held.unpersist()
    by_task = counted.where("documents IS NOT NULL")
    documents, total = by_task.agg(F.sum("documents"), F.sum("total")).first()
    if not total:
        return None
    containing = np.zeros(len(terms), np.int64)
    found = (
        by_task.select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
        .groupBy(F.col("x.terms").alias("term"))
        .agg(F.sum("x.counts").alias("n"))
        .toArrow()  # at most a row per term of the block
    )
    containing[found["term"].to_numpy()] = found["n"].to_numpy()
    weights = np.floor(1000 * np.log((2 * documents + 2) / (2 * containing + 1))).astype(np.int64)
    held = context.broadcast((by_item.dictionary, starts, asking, weights, documents, total))
    rows = counted.where("documents IS NULL").select("doc_id", "n", "terms", "counts")
    best = staged(rows.mapInArrow(_score(held, top), "item_id bigint, doc_id bigint, score bigint"), "scan-best")
    held.unpersist()
    return best


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the ``top`` documents of each item with a score."""
    spark = docs.sparkSession
    texts = docs.select(
        docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").cast("binary").alias("text")
    )
    asked = staged(_item_terms(items, item_col, item_text_col), "scan-items")
    size = asked.agg(F.sum(F.length("term") + 8)).first()[0] or 0
    blocks = math.ceil(2 * size / block_bytes)
    block = F.pmod(F.xxhash64("item_id"), F.lit(max(blocks, 1)))
    folder = shared_folder(spark, "scan-best")
    best = spark.createDataFrame([], "item_id bigint, doc_id bigint, score bigint")
    with settings(spark, _BATCHES):
        for number in range(blocks):
            own = asked.where(block == number).toArrow()
            if own.num_rows and (found := _block(texts, own, top)) is not None:
                found.write.mode("append").parquet(folder)
                best = spark.read.schema(best.schema).parquet(folder)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


SQL = """
WITH lowered AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
), sized AS (
  SELECT r, doc_id, terms, len(terms)::BIGINT AS n FROM lowered WHERE len(terms) > 0
), corpus AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM sized
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark
), counted AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM sized) GROUP BY ALL
), weighted AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counted, corpus GROUP BY term
), scored AS (
  SELECT a.item_id, c.r, c.doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total))))::BIGINT AS score
  FROM asked a JOIN counted c USING (term) JOIN weighted USING (term), corpus
  GROUP BY a.item_id, c.r, c.doc_id
), ranked AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST)::INT AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
