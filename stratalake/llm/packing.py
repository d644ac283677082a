"""Packing documents into training sequences by bounded-space online best fit.

Documents are tokenised in the tasks; only pieces (place, length, checksum) travel on. Pieces meet
in groups of about ``_GROUP_SEQUENCES`` sequences' worth of tokens, so a group never grows with the
corpus, and every group is packed by itself. Pieces arrive longest first. A fixed number of bins
is open; a bit set marks which amounts of free space occur among them, so the tightest bin that
still fits is the lowest set bit from the piece's length upwards. When all bins are open and none
fits, the fullest closes. With ``OPEN_BINS`` above a group's usual number of sequences that happens
only if most pieces are longer than half a sequence; else a group is plain best fit decreasing.

Defined cases: a NULL text is empty; an empty document is its end token alone. A NULL id and
repeated rows are packed like any others. An empty table gives an empty result. Other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import json
import math
import re
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import settings
from stratalake.session import staged

MAX_TOKENS = 2048
OPEN_BINS = 4096
_GROUP_SEQUENCES = 3500
_GROUP_PIECES = 200_000
_CACHED_PARTS = 200_000
_CACHED_LENGTH = 32
_TOKEN_BYTES = 4
#: A space that is not before a word, found fast; one that also has white space before it.
_LOOSE, _INSIDE = re.compile(r" (?:\s|\Z)"), re.compile(r"\s (?:\s|\Z)")


class Tokenizer:
    """Byte-level BPE from a file of ranks; gives a text's ids as little-endian 32-bit numbers.

    The split pattern takes one space into the word after it and never looks back over it, so a
    text falls apart at its spaces and frequent parts are looked up. A space after white space that is
    not before a word lies inside a run of white space (of any script), which the pattern takes as one
    part: texts with such a space are encoded whole.
    """

    def __init__(self, ranks_path: str, pattern: str, added: tuple[tuple[str, int], ...] = ()):
        from tiktoken import Encoding
        from tiktoken.load import load_tiktoken_bpe

        ranks = load_tiktoken_bpe(ranks_path)
        self._ids = Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self._known: dict[str, bytes] = {}
        self._added = {token: i.to_bytes(_TOKEN_BYTES, "little") for token, i in added}
        self._borders = re.compile(f"({'|'.join(map(re.escape, self._added))})")

    def _raw(self, text: str) -> bytes:
        ids = array("I", self._ids(text))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _part(self, part: str) -> bytes:
        """Ids of a part with the space before it."""
        ids = self._known.get(part)
        if ids is None:
            ids = self._raw(" " + part)
            if len(part) <= _CACHED_LENGTH:
                if len(self._known) >= _CACHED_PARTS:
                    self._known.clear()
                self._known[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of ``text``; added tokens in it have their own and end the text before them."""
        if self._added and any(token in text for token in self._added):
            parts = self._borders.split(text)
            return b"".join(self._added[p] if p in self._added else self._plain(p) for p in parts if p)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if "  " in text or _LOOSE.search(text) and _INSIDE.search(text):
            return self._raw(text)
        first, *rest = text.split(" ")
        return self._raw(first) + b"".join(map(self._part, rest))


def added_tokens(json_path: str) -> tuple[tuple[str, int], ...]:
    """The added tokens of a ``tokenizers`` file and their ids."""
    with open(json_path, encoding="utf-8") as file:
        return tuple((t["content"], t["id"]) for t in json.load(file)["added_tokens"])


_TOKENIZERS: dict[tuple, Tokenizer] = {}


def tokenizer(ranks_path: str, pattern: str, added: tuple[tuple[str, int], ...] = ()) -> Tokenizer:
    """One tokenizer per worker process and file."""
    key = (ranks_path, pattern, added)
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = Tokenizer(*key)
    return _TOKENIZERS[key]


def cut(length: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, but for the first if it is long."""
    if length <= limit:
        return [(0, length)]
    first = length % limit or limit
    return [(0, first)] + [(start, limit) for start in range(first, length, limit)]


def token_pieces(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    max_tokens: int = MAX_TOKENS,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    added: tuple[tuple[str, int], ...] = (),
) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32[, ids]) of all documents."""
    end = end_id.to_bytes(_TOKEN_BYTES, "little")
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if with_ids:
        schema, names = schema + ", ids binary", [*names, "ids"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(ranks_path, pattern, added).encode
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = encode(text.as_py() or "") + end
                for i, (start, length) in enumerate(cut(len(ids) // _TOKEN_BYTES, max_tokens)):
                    part = ids[start * _TOKEN_BYTES : (start + length) * _TOKEN_BYTES]
                    row = (doc_id, i, start, length, zlib.crc32(part))
                    rows.append((*row, part) if with_ids else row)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=False)], names
            )

    narrow = docs.select(
        docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text")
    )
    return narrow.mapInArrow(pieces, schema)


def best_fit(lengths: list[int], capacity: int, open_bins: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece, packed in the given order."""
    free = 0  # bit f is set if an open bin has f tokens of free space
    by_space: dict[int, list[int]] = {}
    bins, offsets, made, n_open = [], [], 0, 0

    def take(space: int) -> int:
        nonlocal free, n_open
        members = by_space[space]
        chosen = members.pop()
        if not members:
            free &= ~(1 << space)
        n_open -= 1
        return chosen

    for length in lengths:
        fitting = free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            chosen = take(space)
        else:
            if n_open >= open_bins:
                take((free & -free).bit_length() - 1)  # the fullest closes
            chosen, space = made, capacity
            made += 1
        bins.append(chosen)
        offsets.append(capacity - space)
        left = space - length
        if left:
            by_space.setdefault(left, []).append(chosen)
            free |= 1 << left
            n_open += 1
    return bins, offsets


def pack_pieces(
    pieces: DataFrame, max_tokens: int = MAX_TOKENS, open_bins: int = OPEN_BINS
) -> DataFrame:
    """``pieces``, rows of Parquet files, with sequence_id and offset."""
    totals = pieces.agg(F.sum("length").alias("tokens"), F.count(F.lit(1)).alias("pieces")).first()
    groups = max(
        1,
        math.ceil((totals.tokens or 0) / (max_tokens * _GROUP_SEQUENCES)),
        math.ceil(totals.pieces / _GROUP_PIECES),
    )
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(
            ["length", "ids_crc32", "doc_id", "piece"], ascending=[False, True, True, True]
        )
        bins, offsets = best_fit(group["length"].tolist(), max_tokens, open_bins)
        number = int(group["bucket"].iloc[0])
        group["sequence_id"] = [(number << 32) + b for b in bins]
        group["offset"] = offsets
        return group.drop(columns="bucket")

    # The place in the file tells repeated rows apart, so they do not meet in one group.
    place = pieces.metadataColumn("_metadata").getField("row_index")
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", place), F.lit(groups))
    schema = (
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
        "sequence_id bigint, offset bigint"
    )
    return (
        pieces.select(*names, bucket.alias("bucket")).groupBy("bucket").applyInPandas(pack, schema)
    )


def pack_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    max_tokens: int = MAX_TOKENS,
    added: tuple[tuple[str, int], ...] = (),
    **columns: str,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxBytesPerBatch": "16m"}):
        pieces = staged(
            token_pieces(docs, ranks_path, pattern, max_tokens, added=added, **columns), "token-pieces"
        )
    return pack_pieces(pieces, max_tokens)
