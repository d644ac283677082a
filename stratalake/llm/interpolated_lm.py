"""Language-model scoring by deleted interpolation.

The model mixes the maximum-likelihood estimates of the orders 2, 1 and 0,
    p(w | v) = l2 c(v w) / c(v) + l1 c(w) / N + l0 / (V + 1),
with weights that depend on how often the context v was seen (buckets by the power of two of its
frequency). The weights are learned by expectation-maximisation on a deleted fold, with counts of the
other learning documents; scores then come from the counts of all learning documents. V + 1 leaves
room for one unknown word.

Counting is done once per batch and column block. A batch (documents that stand together in a file)
sends the distinct words and word pairs it holds, with its own counts, to the block of their hash;
the block adds the counts up and sends back one number per word or pair. So what travels is
pre-aggregated, a frequent word weighs one entry per batch, and no table of counts is ever held
by one task. Words and pairs are told apart by 64-bit hashes.

The expectation-maximisation sees every event of the deleted fold in a histogram over (bucket, ratio
of the pair, ratio of the word) with ratios rounded to a twentieth of a power of ten: its size
is bounded by that grid, not by the corpus.

Defined cases: a NULL or empty text is its end token alone. The first token has the end token as
context. A NULL id counts as empty text for the folds. Repeated rows count and are scored like any
others. If nothing may be learned from, all counts are 0 and p = 1 for the unknown word. Other columns,
whatever their names, are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import FILE, ROW, settings
from stratalake.llm.shingles import combined, word_hashes
from stratalake.session import staged

FOLDS, HELD_OUT, DELETED = 7, 2, 3
#: Bytes of text that a batch holds on average.
BATCH_BYTES = 7_000_000
BUCKETS = 24
_KINDS = 32  # sizes of documents, by powers of four of the mean
_BLOCK_ENTRIES = 1_000_000
_GRID = 20  # steps per power of ten in the histogram
_NONE = -32768  # a ratio of 0
_END = np.uint64(0x5851F42D4C957F2D)  # stands for the end token, which no word is equal to
_SETTINGS = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def fold(doc_id: str | None) -> int:
    return zlib.crc32((doc_id or "").encode()) % FOLDS


@dataclass
class Tokens:
    """The tokens of the documents of a batch, end to end."""

    word: np.ndarray  # hash of each token
    pair: np.ndarray  # hash of each token with the one before it
    context: np.ndarray  # hash of the one before it
    length: np.ndarray  # tokens per document


def tokens_of(texts: list[bytes | None]) -> Tokens:
    hashes, lengths = word_hashes(texts)
    length = lengths + 1
    ends = np.cumsum(length) - 1
    word = np.empty(int(length.sum()), np.uint64)
    is_end = np.zeros(len(word), bool)
    is_end[ends] = True
    word[is_end], word[~is_end] = _END, hashes
    context = np.r_[_END, word[:-1]] if len(word) else word
    return Tokens(word, combined([context, word]) if len(word) else word, context, length)


def _summed(values: np.ndarray, learned: np.ndarray, main: np.ndarray):
    """Distinct values, and how often each occurs in the learning documents and the main ones."""
    distinct, place = np.unique(values, return_inverse=True)
    n = len(distinct)
    return distinct, np.bincount(place[learned], minlength=n), np.bincount(place[main], minlength=n)


def _blocks_of(values: np.ndarray, blocks: int) -> np.ndarray:
    """Where each block of an ascending array begins, and its end."""
    bounds = [(b << 64) // blocks for b in range(blocks)]
    return np.r_[np.searchsorted(values, np.array(bounds, dtype=np.uint64)), len(values)]


_REQUEST = (
    "kind int, block int, file string, batch bigint, part bigint, hashes binary, learned binary, "
    "main binary"
)


def _packed(hashes: np.ndarray) -> bytes:
    """Ascending hashes as differences, byte plane by byte plane: the upper planes are empty."""
    steps = np.diff(hashes, prepend=np.uint64(0)).astype("<u8")
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _small(counts: np.ndarray) -> bytes:
    """Counts, deflated: most are 0 or 1."""
    return zlib.compress(counts.astype("<i8").tobytes(), 1)


def _counts(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), "<i8")


def _documents(docs: DataFrame, id_col: str, text_col: str, batch_rows: int, mean: float) -> DataFrame:
    """Documents with their place and the number of their batch in their file.

    ``batch_rows`` rows of mean size are ``BATCH_BYTES``. Documents over four times the mean are in
    batches of their own kind, of a quarter as many rows, those over sixteen times of a sixteenth,
    and so on: a batch has at most four times the bytes, or one document, however long texts stand
    together.
    """
    meta = docs.metadataColumn("_metadata")
    text, row = docs[text_col].cast("string"), meta.getField("row_index")
    size = F.coalesce(F.octet_length(text), F.lit(0)) + 1
    kind = F.greatest(F.floor(F.log(size / F.lit(max(mean, 1.0))) / math.log(4)), F.lit(0)).cast("int")
    rows = F.greatest(F.floor(batch_rows / F.pow(F.lit(4.0), kind)), F.lit(1)).cast("bigint")
    return docs.select(
        docs[id_col].cast("bigint").cast("string").alias("doc_id"),
        text.cast("binary").alias("text"),
        meta.getField("file_path").alias(FILE),
        row.alias(ROW),
        (F.floor(row / rows) * _KINDS + kind).alias("batch"),
    )


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, list, list]]:
    """(file, batch, first row, ids, texts) of the stretches of a batch that lie in one task.

    One batch of each kind of size is open at a time.
    """
    open_parts: dict[int, tuple] = {}
    for arrow in batches:
        for doc_id, text, file, row, batch in zip(*(c.to_pylist() for c in arrow.columns), strict=True):
            held = open_parts.get(batch % _KINDS)
            if held is None or held[:2] != (file, batch):
                if held is not None:
                    yield held
                held = open_parts[batch % _KINDS] = (file, batch, row, [], [])
            held[3].append(doc_id)
            held[4].append(text)
    yield from open_parts.values()


def _deleted_apart(ids: list, texts: list) -> list[tuple[int, list, list]]:
    """A part's documents of the deleted fold, and the others: (is deleted, ids, texts)."""
    chosen = [fold(i) == DELETED for i in ids]
    return [
        (int(want), [i for i, c in zip(ids, chosen, strict=True) if c == want], [t for t, c in zip(texts, chosen, strict=True) if c == want])
        for want in (True, False)
    ]


def _requests(docs: DataFrame, blocks: int) -> DataFrame:
    """The distinct words and pairs of every part of every batch, by block."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, batch, first, all_ids, all_texts in _parts(batches):
            for deleted, ids, texts in _deleted_apart(all_ids, all_texts):
                if not ids:
                    continue
                t = tokens_of(texts)
                folds = np.repeat(np.array([fold(i) for i in ids]), t.length)
                learned = folds != HELD_OUT
                main = learned & (folds != DELETED)
                for kind, values in enumerate((t.word, t.pair)):
                    distinct, n_learned, n_main = _summed(values, learned, main)
                    bounds = _blocks_of(distinct, blocks)
                    rows = [
                        (
                            kind, block, file, batch, 2 * first + deleted, _packed(distinct[a:b]),
                            _small(n_learned[a:b]), _small(n_main[a:b]),
                        )
                        for block, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))
                        if a < b
                    ]
                    columns = zip(zip(*rows, strict=True), _REQUEST_ARROW, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in columns], schema=_REQUEST_ARROW
                    )

    return docs.mapInArrow(ask, _REQUEST)


_REQUEST_ARROW = pa.schema(
    [
        ("kind", pa.int32()), ("block", pa.int32()), ("file", pa.string()), ("batch", pa.int64()),
        ("part", pa.int64()), ("hashes", pa.binary()), ("learned", pa.binary()), ("main", pa.binary()),
    ]
)
_REPLY = (
    "kind int, block int, file string, batch bigint, part bigint, learned binary, main binary, "
    "vocabulary bigint, n_learned bigint, n_main bigint, vocabulary_main bigint"
)


def _reply(asked: pd.DataFrame) -> pd.DataFrame:
    """Add up a block's counts and answer every part in the order of its hashes; counts without the
    deleted fold go to its own documents alone. The first row carries the block's totals."""
    hashes = [_unpacked(h) for h in asked["hashes"]]
    distinct, place = np.unique(np.concatenate(hashes), return_inverse=True)
    totals = {}
    for column in ("learned", "main"):
        counts = np.concatenate([_counts(c) for c in asked[column]])
        totals[column] = np.zeros(len(distinct), np.int64)
        np.add.at(totals[column], place, counts)
    ends = np.cumsum([len(h) for h in hashes])
    out = asked[["kind", "block", "file", "batch", "part"]].copy()
    places = np.split(place, ends[:-1])
    deleted = (asked["part"] % 2 == 1).to_numpy()
    out["learned"] = [_small(totals["learned"][p]) for p in places]
    out["main"] = [_small(totals["main"][p]) if d else None for p, d in zip(places, deleted, strict=True)]
    first = np.arange(len(out)) == 0
    learned, main = totals["learned"], totals["main"]
    for name, value in (
        ("vocabulary", (learned > 0).sum()), ("n_learned", learned.sum()),
        ("n_main", main.sum()), ("vocabulary_main", (main > 0).sum()),
    ):
        out[name] = np.where(first, value, 0)
    return out


@dataclass
class Totals:
    learned: int  # tokens N of the learning documents
    vocabulary: int  # distinct tokens V in them
    main: int  # tokens of those without the deleted fold, from which weights are learned
    vocabulary_main: int


def bucket_of(context_count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + the power of two of its frequency."""
    return np.minimum(np.log2(np.maximum(context_count, 0.5)).astype(np.int64) + 1, BUCKETS - 1) * (
        context_count > 0
    )


def _looked_up(replies: pd.DataFrame, texts: list, counted: str) -> tuple[Tokens, np.ndarray, ...]:
    """Tokens, and per token the counts (learned or main) of word, context and pair."""
    t = tokens_of(texts)
    columns = []
    for kind, values in enumerate((t.word, t.pair)):
        own = replies[replies["kind"] == kind].sort_values("block")
        distinct, place = np.unique(values, return_inverse=True)
        counts = np.concatenate([_counts(c) for c in own[counted]])
        columns.append(counts[place])
        if kind == 0:  # every context is a token of the same part
            columns.append(counts[np.searchsorted(distinct, t.context)])
    return t, *columns


def _groups(documents: pd.DataFrame, replies: pd.DataFrame):
    """The documents of a batch with the replies to their part: parts are stretches of rows, split
    into documents of the deleted fold (odd) and others (even)."""
    parts = np.sort(replies["part"].unique())
    starts = np.unique(parts // 2)
    documents = documents.sort_values(ROW)
    stretch = starts[np.searchsorted(starts, documents[ROW].to_numpy(), "right") - 1]
    deleted = np.array([int(fold(i) == DELETED) for i in documents["doc_id"]])
    part = 2 * stretch + deleted
    for number in np.unique(part):
        own = documents[part == number]
        yield own, replies[replies["part"] == number]


def _ratios(context, pair, word, tokens: int, vocabulary: int):
    r2 = np.where(context > 0, pair / np.maximum(context, 1), 0.0)
    r1 = word / max(tokens, 1)
    return r2, r1, 1.0 / (vocabulary + 1)


def _binned(ratio: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(ratio > 0, np.round(_GRID * np.log10(np.maximum(ratio, 1e-300))), _NONE).astype(np.int64)


def learn_weights(events: pd.DataFrame, r0: float, rounds: int = 50) -> np.ndarray:
    """Weights (bucket, order 2 / 1 / 0) by expectation-maximisation over the histogram."""
    weights = np.tile([1 / 3, 1 / 3, 1 / 3], (BUCKETS, 1))
    weights[0] = [0.0, 0.5, 0.5]
    b = events["bucket"].to_numpy(np.int64)
    r = np.stack(
        [np.where(events[c] == _NONE, 0.0, 10.0 ** (events[c] / _GRID)) for c in ("b2", "b1")] + [np.full(len(events), r0)], axis=1
    )
    n = events["n"].to_numpy(float)
    for _ in range(rounds):
        share = weights[b] * r
        share *= (n / np.maximum(share.sum(1), 1e-300))[:, None]
        for bucket in range(BUCKETS):
            mine = share[b == bucket].sum(0)
            if mine.sum() > 0:
                # One event per order keeps rare buckets from ruling an order out.
                weights[bucket] = (mine + (0.0 if bucket == 0 else 1.0, 1.0, 1.0)) / (mine.sum() + (2 if bucket == 0 else 3))
    return weights


def score_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs`` (rows of Parquet files): doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score."""
    spark = docs.sparkSession
    about = docs.select(F.sum(F.octet_length(docs[text_col])), F.count(F.lit(1))).first()
    size = (about[0] or 0) + about[1]
    blocks = max(1, math.ceil(size / 12 / _BLOCK_ENTRIES))
    batch_rows = max(1, BATCH_BYTES * about[1] // max(size, 1))
    rows = _documents(docs, id_col, text_col, batch_rows, size / max(about[1], 1))
    with settings(spark, _SETTINGS):
        replies = staged(_requests(rows, blocks).groupBy("kind", "block").applyInPandas(_reply, _REPLY), "lm-replies")
        sums = replies.where("kind = 0").agg(*[F.sum(c) for c in ("n_learned", "vocabulary", "n_main", "vocabulary_main")]).first()
        totals = Totals(*(int(x or 0) for x in sums))
        answers = replies.select(F.col("file").alias(FILE), "batch", "kind", "block", "part", "learned", "main")
        weights = learn_weights(_events(rows, answers, totals).toArrow().to_pandas(), 1.0 / (totals.vocabulary_main + 1))
        return _scored(rows, answers.drop("main"), totals, weights)


def _events(batched: DataFrame, answers: DataFrame, totals: Totals) -> DataFrame:
    """Histogram of the deleted fold's tokens over the grid (bucket, b2, b1)."""

    def count(documents: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        for own, mine in _groups(documents, replies) if len(documents) else ():
            _, word, context, pair = _looked_up(mine, own["text"].tolist(), "main")
            r2, r1, _ = _ratios(context, pair, word, totals.main, totals.vocabulary_main)
            out.append(pd.DataFrame({"bucket": bucket_of(context), "b2": _binned(r2), "b1": _binned(r1)}))
        if not out:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("bucket", "b2", "b1", "n")})
        return pd.concat(out).groupby(["bucket", "b2", "b1"], as_index=False).size().rename(columns={"size": "n"})

    deleted = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == DELETED
    found = (
        batched.where(deleted)
        .groupBy(FILE, "batch")
        .cogroup(answers.where("part % 2 = 1").drop("learned").groupBy(FILE, "batch"))
        .applyInPandas(count, "bucket bigint, b2 bigint, b1 bigint, n bigint")
    )
    return found.groupBy("bucket", "b2", "b1").agg(F.sum("n").alias("n"))


def _scored(batched: DataFrame, answers: DataFrame, totals: Totals, weights: np.ndarray) -> DataFrame:
    """Scores under the counts of all learning documents."""
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def score(documents: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        for own, mine in _groups(documents, replies) if len(documents) else ():
            t, learned, context, pair = _looked_up(mine, own["text"].tolist(), "learned")
            r2, r1, r0 = _ratios(context, pair, learned, totals.learned, totals.vocabulary)
            w = weights[bucket_of(context)]
            logs = np.log10(w[:, 0] * r2 + w[:, 1] * r1 + w[:, 2] * r0)
            base = np.log10((learned + 1) / (totals.learned + totals.vocabulary + 1))
            starts = np.cumsum(t.length) - t.length
            ids = own["doc_id"]
            out.append(
                pd.DataFrame(
                    {
                        "doc_id": ids,
                        "held_out": [fold(i) == HELD_OUT for i in ids],
                        "n_tokens": t.length,
                        "n_known": np.add.reduceat(learned > 0, starts, dtype=np.int64),
                        "train_tokens": totals.learned,
                        "base_score": np.add.reduceat(base, starts),
                        "score": np.add.reduceat(logs, starts),
                    }
                )
            )
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in names})

    schema = (
        "doc_id string, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double"
    )
    scored = (
        batched.groupBy(FILE, "batch").cogroup(answers.groupBy(FILE, "batch")).applyInPandas(score, schema)
    )
    return scored.withColumn("doc_id", F.col("doc_id").cast("bigint"))
