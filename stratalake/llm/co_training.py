"""Quality classifier by co-training two views of a document.

The content view holds shares of word shapes, repetition and hashed words of the text. The metadata
view holds the document's language, source and stored length and the page statistics of its layout:
lines, line lengths, repeated and blank lines, shares of character classes. A logistic model is
trained per view on the labelled documents. Over rounds each view labels the unlabelled documents it
is sure of, and these pseudo-labels go, with a small weight, to the other view's training. At the
end both views' log-odds are calibrated and combined by a logistic fit on a fold of labels that no
view was trained on, and every document is scored.

Features are computed once and staged; every training step is a Newton step whose sums run over all
documents in the tasks and meet in a fixed number of rows.

Folds by the checksum of the id: 0 is held out of everything, 1 calibrates, 2 to 4 train.

Defined cases: a NULL or empty text has no words or lines. NULL language, source, length or id are
values like any others. A NULL label is none; of several labels of a document the largest counts.
Labels of one kind or none leave every score at the smoothed share. Repeated rows are scored one by
one. An empty table gives an empty result. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import fold_of, settings
from stratalake.session import staged

FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
ROUNDS, STEPS = 3, 6
SURE = 0.98
PSEUDO_WEIGHT = 0.2
_PENALTY = 1.0
_SUM_ROWS = 64
_CACHED_WORDS = 200_000
_HASHED_WORDS, _HASHED_META = 32, 8
_SHAPES = (
    re.compile(r"^[^\W\d_]+[.,;:?!]?$"),  # a word, maybe with its mark
    re.compile(r"^[\W_]+$"),  # marks only
    re.compile(r"^\d[\d.,:/-]*$"),  # a number
    re.compile(r"^[^\W\d_].*[\W_]{2,}$"),  # a word with a run of marks
    re.compile(r"\d"),
    re.compile(r"^(?:https?:|www\.)|@"),
)
_CONTENT = len(_SHAPES) + 1 + 3 + 5 + _HASHED_WORDS + 1
_META = 11 + 2 * _HASHED_META + 1
_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def _look(word: str) -> tuple[int, int, int]:
    """Shape, case (lower, capitalised, upper) and bucket of a word."""
    shape = next((i for i, p in enumerate(_SHAPES) if p.search(word)), len(_SHAPES))
    case = 2 if len(word) > 1 and word.isupper() else int(word[:1].isupper())
    return shape, case, zlib.crc32(word.lower().encode("utf-8", "replace")) % _HASHED_WORDS


_KNOWN: dict[str, tuple[int, int, int]] = {}


def content_view(text: str) -> np.ndarray:
    words = text.split()
    looks = []
    for word in words:
        look = _KNOWN.get(word)
        if look is None:
            look = _look(word)
            if len(_KNOWN) >= _CACHED_WORDS:
                _KNOWN.clear()
            if len(word) <= 40:
                _KNOWN[word] = look
        looks.append(look)
    n = max(len(words), 1)
    table = np.array(looks, dtype=np.int64).reshape(-1, 3)
    shares = [np.bincount(table[:, i], minlength=m) / n for i, m in enumerate((len(_SHAPES) + 1, 3, _HASHED_WORDS))]
    counts = Counter(words)
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    numbers = [
        repeats / n,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        len(set(zip(words, words[1:], strict=False))) / n,
        sum(map(len, words)) / n / 10,
    ]
    return np.concatenate([*shares, numbers, [1.0]]).astype(np.float32)


def _one_of(value: str | None) -> np.ndarray:
    out = np.zeros(_HASHED_META)
    out[zlib.crc32(("-" if value is None else "=" + value).encode()) % _HASHED_META] = 1.0
    return out


def metadata_view(text: str, lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    lines = text.split("\n")
    raw = text.encode("utf-8", "replace")
    codes = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = max(len(raw), 1)
    numbers = [
        math.log1p(max(n_chars or 0, 0)) / 10,
        math.log1p(len(lines)) / 10,
        math.log1p(len(text) / len(lines)) / 10,
        math.log1p(max(map(len, lines))) / 10,
        1 - len(set(lines)) / len(lines),
        sum(not line.strip() for line in lines) / len(lines),
        codes[65:91].sum() / n,
        codes[48:58].sum() / n,
        codes[128:].sum() / n,
        (codes[9:14].sum() + codes[32]) / n,
        (codes[33:48].sum() + codes[58:65].sum() + codes[91:97].sum() + codes[123:127].sum()) / n,
    ]
    return np.concatenate([numbers, _one_of(lang), _one_of(source), [1.0]]).astype(np.float32)


def views(docs: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows (*keys, content, meta): both views as packed 32-bit floats."""
    narrow = docs.select(
        *keys,
        docs["text"].cast("string").alias("__text"),
        docs["lang"].cast("string").alias("__lang"),
        docs["source"].cast("string").alias("__source"),
        docs["n_chars"].cast("bigint").alias("__n_chars"),
    )
    n = len(keys)
    types = [(f.name, f.dataType.simpleString()) for f in narrow.schema[:n]]
    schema = ", ".join(f"`{a}` {t}" for a, t in types) + ", content binary, meta binary"

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, meta = [], []
            for text, *about in zip(*(batch[n + i].to_pylist() for i in range(4)), strict=True):
                content.append(content_view(text or "").tobytes())
                meta.append(metadata_view(text or "", *about).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch[i] for i in range(n)] + [pa.array(content, pa.binary()), pa.array(meta, pa.binary())],
                [*batch.schema.names[:n], "content", "meta"],
            )

    return narrow.mapInArrow(compute, schema)


@dataclass
class Model:
    """Weights of the views, and of the combination of their log-odds."""

    content: np.ndarray
    meta: np.ndarray
    combined: np.ndarray

    def odds(self, x: list[np.ndarray]) -> np.ndarray:
        return np.stack([x[0] @ self.content, x[1] @ self.meta, np.ones(len(x[0]))], axis=1)


def _chance(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, "<f4").reshape(-1, width).astype(np.float64)


def _rows(batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    x = [_matrix(batch.column("content"), _CONTENT), _matrix(batch.column("meta"), _META)]
    label = batch.column("label").to_pandas().to_numpy(float)
    return x, label, batch.column("fold").to_numpy()


def _newton_sums(x: np.ndarray, y: np.ndarray, weight: np.ndarray, beta: np.ndarray) -> np.ndarray:
    p = _chance(x @ beta)
    gradient = x.T @ (weight * (y - p))
    hessian = (x * (weight * p * (1 - p))[:, None]).T @ x
    return np.concatenate([gradient, hessian.ravel()])


def _summed(rows: DataFrame, sums) -> np.ndarray | None:
    """Add up an array per batch over all rows, in ``_SUM_ROWS`` groups and then here."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = sums(batch)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(p) for p in group["part"]], axis=0)
        return pd.DataFrame({"part": [total.tobytes()]})

    parts = rows.mapInArrow(partial, "part binary")
    groups = parts.groupBy(F.pmod(F.xxhash64("part"), F.lit(_SUM_ROWS))).applyInPandas(merge, "part binary")
    found = [np.frombuffer(bytes(r.part)) for r in groups.collect()]
    return np.sum(found, axis=0) if found else None


def _stepped(beta: np.ndarray, sums: np.ndarray, penalty: float) -> np.ndarray:
    k = len(beta)
    hessian = sums[k:].reshape(k, k) + penalty * np.eye(k)
    return beta + np.linalg.solve(hessian, sums[:k] - penalty * beta)


def _pseudo(odds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels and weights that a view gives to documents without one."""
    p = _chance(odds)
    return (p >= 0.5).astype(float), np.where(np.abs(p - 0.5) >= SURE - 0.5, PSEUDO_WEIGHT, 0.0)


def train(rows: DataFrame) -> Model:
    """Co-train on ``rows`` (content, meta, label, fold)."""
    counts = rows.where("label IS NOT NULL AND fold != 0").agg(F.count("label"), F.sum("label")).first()
    n, good = counts[0], int(counts[1] or 0)
    share = (good + 0.5) / (n + 1)
    model = Model(np.zeros(_CONTENT), np.zeros(_META), np.array([0.0, 0.0, math.log(share / (1 - share))]))
    if not 0 < good < n:
        return model
    for number in range(ROUNDS):
        before = None if number == 0 else (model.content, model.meta)
        for _ in range(STEPS if number == 0 else STEPS // 2):

            def sums(batch: pa.RecordBatch, now=(model.content, model.meta), before=before) -> np.ndarray:
                x, label, fold = _rows(batch)
                known = ~np.isnan(label)
                out = []
                for view in (0, 1):
                    y, weight = np.nan_to_num(label), (known & (fold > CALIBRATION)).astype(float)
                    if before is not None:  # the other view's sure labels
                        guess, sure = _pseudo(x[1 - view] @ before[1 - view])
                        y = np.where(known, y, guess)
                        weight = np.where(known | (fold == HELD_OUT), weight, sure)
                    out.append(_newton_sums(x[view], y, weight, now[view]))
                return np.concatenate(out)

            total = _summed(rows, sums)
            cut = _CONTENT * (_CONTENT + 1)
            model.content = _stepped(model.content, total[:cut], _PENALTY)
            model.meta = _stepped(model.meta, total[cut:], _PENALTY)
    labelled = rows.where(f"label IS NOT NULL AND fold = {CALIBRATION}")
    for _ in range(STEPS):

        def fitted(batch: pa.RecordBatch, model=model) -> np.ndarray:
            x, label, _ = _rows(batch)
            z = np.clip(model.odds(x), -30, 30)
            return _newton_sums(z, label, np.ones(len(label)), model.combined)

        total = _summed(labelled, fitted)
        if total is None:
            model.combined = np.array([0.5, 0.5, 0.0])
            break
        model.combined = _stepped(model.combined, total, 0.1)
    return model


def score_quality(docs: DataFrame, labels: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows (*keys, held_out, score, predicted, content_score, metadata_score) of all documents."""
    known = (
        labels.select(labels["doc_id"].alias("__id"), labels["quality"].cast("double").alias("label"))
        .where("__id IS NOT NULL AND label IS NOT NULL")
        .groupBy("__id")
        .agg(F.max("label").alias("label"))
    )
    extra = () if "doc_id" in keys else ("doc_id",)
    with settings(docs.sparkSession, _BATCHES):
        seen = staged(views(docs, (*keys, *extra)), "quality-views")
        rows = staged(
            seen.withColumn("fold", fold_of(F.col("doc_id"), FOLDS))
            .join(known, F.col("doc_id") == F.col("__id"), "left")
            .select(*keys, "content", "meta", "label", "fold"),
            "quality-rows",
        )
        model = train(rows.select("content", "meta", "label", "fold"))
    n = len(keys)
    types = [(f.name, f.dataType.simpleString()) for f in rows.schema[:n]]
    schema = ", ".join(f"`{a}` {t}" for a, t in types) + (
        ", held_out boolean, score double, predicted int, content_score double, metadata_score double"
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, _, fold = _rows(batch)
            odds = np.clip(model.odds(x), -30, 30)
            p = _chance(odds @ model.combined)
            columns = [fold == HELD_OUT, p, (p >= 0.5).astype(np.int32), _chance(odds[:, 0]), _chance(odds[:, 1])]
            yield pa.RecordBatch.from_arrays(
                [batch[i] for i in range(n)] + [pa.array(c) for c in columns],
                [*batch.schema.names[:n], "held_out", "score", "predicted", "content_score", "metadata_score"],
            )

    return rows.mapInArrow(score, schema)
