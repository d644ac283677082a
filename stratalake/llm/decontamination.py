"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is contained in a document if at least the threshold of its distinct shingles occur in
it. Items are partitioned by the size of their set. An item's sketch is its k smallest shingle
hashes with k = n - ceil(threshold * n) + 1: a document that lacks at most n - ceil(threshold * n)
shingles cannot lack all of the sketch, so looking up the sketch finds every contained item, however
long the document. A partition's smallest size also bounds the documents that can hold any of its
items. Every (document, item) found is verified by comparing the shingles themselves.

The items are searched in blocks with a bounded number of shingles; one pass over the documents per
block, without a shuffle. Items with fewer than five words are one shingle of their own length and
are looked for among the documents' word runs of that length.

Defined cases: a NULL or empty text holds nothing, an item without words is found nowhere. NULL ids
are passed on. Repeated documents or items give a row each. An empty table gives an empty result.
Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import words
from stratalake.llm.shingles import WIDTH, shingle_sets, windows, word_hashes

THRESHOLD = 0.75
#: Bytes of item text that one broadcast block of items may hold.
BLOCK_BYTES = 4_000_000


@dataclass
class Partition:
    """Items of one shingle width and one size class, with the sketch of each."""

    width: int
    least: int  # shingles that a document must have to contain any of the items
    sketch: np.ndarray  # hashes, ascending
    item: np.ndarray  # the item behind each hash


def needed(size: int, threshold: float) -> int:
    """Shingles out of ``size`` that a document must hold."""
    return math.ceil(threshold * size - 1e-9)


def partitions(texts: list[bytes | None], threshold: float) -> list[Partition]:
    parts: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
    for i, (text, found) in enumerate(zip(texts, shingle_sets(texts), strict=True)):
        if len(found):
            width = min(WIDTH, len(words(text)))
            parts.setdefault((width, len(found).bit_length()), []).append((i, found))
    made = []
    for (width, _), members in sorted(parts.items()):
        hashes, items = [], []
        for i, found in members:
            k = len(found) - needed(len(found), threshold) + 1
            hashes.append(found[:k])
            items.append(np.full(k, i))
        sketch, item = np.concatenate(hashes), np.concatenate(items)
        order = np.argsort(sketch, kind="stable")
        least = min(needed(len(found), threshold) for _, found in members)
        made.append(Partition(width, least, sketch[order], item[order]))
    return made


def candidates(hashes: np.ndarray, parts: list[Partition]) -> set[int]:
    """Items of which a sketch hash occurs in a document with these word hashes."""
    runs, found = {}, set()
    for part in parts:
        if part.width not in runs:
            runs[part.width] = windows(hashes, part.width)
        own = runs[part.width]
        if len(own) >= part.least:
            low = np.searchsorted(part.sketch, own, "left")
            hit = (low < len(part.sketch)) & (
                part.sketch[np.minimum(low, len(part.sketch) - 1)] == own
            )
            for value in np.unique(own[hit]):
                left = np.searchsorted(part.sketch, value, "left")
                right = np.searchsorted(part.sketch, value, "right")
                found.update(part.item[left:right].tolist())
    return found


def _runs(found: list[bytes], width: int) -> set[bytes]:
    return {b" ".join(found[i : i + width]) for i in range(len(found) - width + 1)}


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    keys: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Rows (*keys, item_id, item_shingles, overlap, containment) of all contained items."""
    spark = docs.sparkSession
    listed = items.select(
        items[item_col].cast("bigint").alias("item_id"),
        items[item_text_col].cast("string").cast("binary").alias("text"),
    ).where("length(text) > 0")
    size = listed.agg(F.sum(F.length("text") + 16)).first()[0] or 0
    # Blocks by hash: each holds about half of block_bytes.
    blocks = math.ceil(2 * size / block_bytes) or 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    narrow = docs.select(*keys, docs[text_col].cast("string").cast("binary").alias("__text"))
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema[:-1]]
        + ["item_id bigint", "item_shingles bigint", "overlap bigint", "containment double"]
    )
    found = None
    for number in range(blocks):
        rows = listed.where(block == number).collect()
        held = spark.sparkContext.broadcast([(r.item_id, bytes(r.text)) for r in rows])
        part = narrow.mapInArrow(_search(held, threshold, len(keys)), schema)
        found = part if found is None else found.unionByName(part)
    return found


def _search(held, threshold: float, n_keys: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts = zip(*held.value, strict=True) if held.value else ((), ())
        parts = partitions(list(texts), threshold)
        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch[n_keys].to_pylist() if parts else []):
                hashes, _ = word_hashes([text])
                near = candidates(hashes, parts)
                own = words(text) if near else []
                runs: dict[int, set[bytes]] = {}
                for k in sorted(near):
                    item = words(texts[k])
                    width = min(WIDTH, len(item))
                    if width not in runs:
                        runs[width] = _runs(own, width)
                    asked = _runs(item, width)
                    overlap = len(asked & runs[width])
                    if overlap >= needed(len(asked), threshold):
                        at.append(i)
                        rows.append((ids[k], len(asked), overlap, overlap / len(asked)))
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
            taken = [batch[i].take(pa.array(at, pa.int64())) for i in range(n_keys)]
            names = [*batch.schema.names[:n_keys], "item_id", "item_shingles", "overlap", "containment"]
            yield pa.RecordBatch.from_arrays(
                taken + [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
            )

    return search
