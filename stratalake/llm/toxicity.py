"""Toxicity: a linear-chain conditional random field that tags toxic spans.

Only documents are labelled, so token labels come from the labelled documents first: a word form or
word beginning that occurs in so many toxic and so few clean documents that chance does not explain
it marks its tokens as toxic. Toxic documents so explained are set aside and the search goes on with
the others, until nothing more stands out. The field (two tags, features of the word, its beginnings
and its endings, tag transitions) is then trained on these token sequences by its log-likelihood.

Scoring runs forward and backward over every token of every text. The marginals of a document are
summed up (chance that no token is toxic, number of tokens that are) and a logistic fit on the
labelled sample turns that into a score; tokens with a marginal of a half or more give the offending
offsets.

Fitting uses at most ``SAMPLE`` labelled documents per label, taken by the checksum of their id,
never held-out ones. Language, source and id are no inputs.

Defined cases: a NULL or empty text has no tokens and gets the score of a text without toxic ones.
A NULL label, or a label without its document, is left out; of several labels of a document the
largest counts. Without labels of both kinds every score is the share of toxic ones, smoothed. A
NULL id counts as empty text for the fold. Repeated rows are scored one by one. An empty table gives
an empty result. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import fold_of
from stratalake.session import staged

SAMPLE = 3000
SAMPLE_BYTES = 64 << 20
FOLDS = 5
_BUCKETS = 1 << 18
_BEGINNINGS = range(3, 8)
_ENDINGS = range(3, 7)
_CHUNK = 64
_CLIP = 1.5  # of transitions, so that what lies _WARM_UP tokens back has no influence left
_WINDOW, _WARM_UP = 1024, 128
_CACHED_WORDS = 200_000
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_SPAN = "array<struct<start: int, end: int, marginal: double>>"


def word_form(token: str) -> str:
    return _EDGE.sub("", token.lower())


def stems(word: str) -> list[str]:
    """The word and its beginnings."""
    return ["w:" + word, *("b:" + word[:k] for k in _BEGINNINGS if len(word) > k)]


def features(word: str) -> list[int]:
    names = stems(word) + ["e:" + word[-k:] for k in _ENDINGS if len(word) > k]
    return [zlib.crc32(name.encode()) % _BUCKETS for name in names]


@dataclass
class Field:
    """Weights; tag O has emission 0 and O-O transition 0."""

    weight: np.ndarray = field(default_factory=lambda: np.zeros(_BUCKETS, np.float32))
    bias: float = 0.0
    start: float = 0.0
    enter: float = 0.0  # O to T
    leave: float = 0.0  # T to O
    stay: float = 0.0  # T to T
    fit: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)  # of the document score

    def emission(self, token: str) -> float:
        word = word_form(token)
        return float(self.weight[features(word)].sum()) + self.bias if word else self.bias


def _log_ratio(a, x, b):
    """log((exp(a) + exp(x)) / (1 + exp(b)))"""
    return np.logaddexp(a, x) - np.logaddexp(0.0, b)


def forward_backward(model: Field, emission: np.ndarray, first: np.ndarray, last: np.ndarray):
    """Log-odds of T given what lies before (own emission included), and given what lies after.

    Rows are sequences in step; ``first`` and ``last`` mark where texts begin and end in them.
    """
    steps = emission.shape[1]
    ahead, back = np.empty_like(emission), np.zeros_like(emission)
    ahead[:, 0] = emission[:, 0] + model.start
    for t in range(1, steps):
        r = ahead[:, t - 1]
        carried = _log_ratio(model.enter, model.stay + r, model.leave + r)
        ahead[:, t] = emission[:, t] + np.where(first[:, t], model.start, carried)
    for t in range(steps - 2, -1, -1):
        x = emission[:, t + 1] + back[:, t + 1]
        carried = _log_ratio(model.leave, model.stay + x, model.enter + x)
        back[:, t] = np.where(last[:, t], 0.0, carried)
    return ahead, back


def marginals(model: Field, emission: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Chance of T for every token of texts laid end to end.

    The stream is cut into windows that all advance in step, each with a run-up on both sides; the
    chain forgets its state within the run-up (to below 1e-11), so the cut does not show.
    """
    n = len(emission)
    if not n:
        return emission
    ends = np.cumsum(lengths[lengths > 0])
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    first[np.r_[0, ends[:-1]]] = True
    last[ends - 1] = True
    rows = -(-n // _WINDOW)
    at = np.arange(rows)[:, None] * _WINDOW + np.arange(-_WARM_UP, _WINDOW + _WARM_UP)[None, :]
    inside = (at >= 0) & (at < n)
    place = np.clip(at, 0, n - 1)
    spread = np.where(inside, emission[place], 0.0)
    ahead, back = forward_backward(
        model, spread, np.where(inside, first[place], True), np.where(inside, last[place], True)
    )
    odds = (ahead + back)[:, _WARM_UP : _WARM_UP + _WINDOW].ravel()[:n]
    return 1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500)))


class Stems:
    """Numbers for the stems of a sample's words. Documents are arrays of numbers: sets of texts
    would take many times the memory."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.of_word: dict[str, np.ndarray] = {}

    def of(self, word: str) -> np.ndarray:
        found = self.of_word.get(word)
        if found is None:
            numbers = [self.number.setdefault(s, len(self.number)) for s in stems(word)] if word else []
            found = self.of_word[word] = np.array(numbers, np.int32)
        return found

    def document(self, words: set[str]) -> np.ndarray:
        parts = [self.of(w) for w in words]
        return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int32)


def toxic_stems(docs: list[np.ndarray], toxic: list[bool], n_stems: int) -> set[int]:
    """Numbers of the stems that mark toxic documents."""

    def counted(members: list[np.ndarray]) -> np.ndarray:
        return np.bincount(np.concatenate([np.zeros(0, np.int32), *members]), minlength=n_stems)

    clean = counted([d for d, y in zip(docs, toxic, strict=True) if not y])
    n_clean = sum(not y for y in toxic)
    open_docs = [d for d, y in zip(docs, toxic, strict=True) if y]
    found: set[int] = set()
    while open_docs:
        inside = counted(open_docs)
        rate = len(open_docs) / (len(open_docs) + n_clean)
        tests = int((inside > 0).sum())

        def chance(n: int, missed: int) -> float:
            """Expected number of stems as one-sided as this one, by chance (log)."""
            ways = math.lgamma(n + missed + 1) - math.lgamma(n + 1) - math.lgamma(missed + 1)
            return ways + n * math.log(rate) + missed * math.log1p(-rate) + math.log(tests)

        one_sided = np.flatnonzero((inside > 0) & (inside >= 15 * clean))
        new = [s for s in one_sided.tolist() if chance(int(inside[s]), int(clean[s])) < math.log(0.3)]
        if not new:
            break
        found.update(new)
        marked = np.array(new, np.int32)
        open_docs = [d for d in open_docs if not np.isin(d, marked).any()]
    return found


def _chunks(
    texts: list[str], toxic: list[bool], marked: set[int], forms: dict[str, str], known: Stems
):
    """Token sequences and tags: all chunks with a toxic token, and as many without."""
    with_t, without = [], []
    is_marked = {w: not marked.isdisjoint(n.tolist()) for w, n in known.of_word.items()}
    for text, y in zip(texts, toxic, strict=True):
        tokens = [forms[t] for t in text.split()]
        tags = [y and is_marked[w] for w in tokens]
        for i in range(0, len(tokens), _CHUNK):
            chunk = (tokens[i : i + _CHUNK], tags[i : i + _CHUNK])
            (with_t if any(chunk[1]) else without).append(chunk)
    rng = np.random.default_rng(7)
    keep = rng.permutation(len(without))[: max(len(with_t), 100)]
    return with_t + [without[i] for i in keep]


def train_field(
    chunks: list, epochs: int = 3, updates: int = 800, rate: float = 0.5, batch: int = 64
) -> Field:
    """Maximise the log-likelihood of the tags by adaptive gradient steps."""
    tagged = sum(map(sum, (t for _, t in chunks))) / sum(len(t) for _, t in chunks)
    model = Field(bias=math.log(tagged / (1 - tagged)) if 0 < tagged < 1 else 0.0)
    epochs = max(epochs, math.ceil(updates * batch / len(chunks)))
    known: dict[str, list[int]] = {}
    for words, _ in chunks:
        for w in words:
            if w not in known:
                known[w] = features(w) if w else []
    squares = np.full(_BUCKETS, 1e-6, np.float32)
    global_squares = np.full(5, 1e-6)
    rng = np.random.default_rng(11)
    for _ in range(epochs):
        order = rng.permutation(len(chunks))
        for at in range(0, len(order), batch):
            part = [chunks[i] for i in order[at : at + batch]]
            lengths = np.array([len(w) for w, _ in part])
            steps = int(lengths.max())
            valid = np.arange(steps)[None, :] < lengths[:, None]
            flat = [known[w] for words, _ in part for w in words]
            sizes = np.array([len(f) for f in flat])
            index = np.fromiter((i for f in flat for i in f), np.int64, int(sizes.sum()))
            owner = np.repeat(np.arange(len(flat)), sizes)
            scores = np.bincount(owner, model.weight[index], len(flat)) + model.bias
            emission = np.zeros(valid.shape)
            emission[valid] = scores
            tags = np.zeros(valid.shape)
            tags[valid] = [float(t) for _, tag in part for t in tag]
            first = np.zeros(valid.shape, bool)
            first[:, 0] = True
            last = np.arange(steps)[None, :] == lengths[:, None] - 1
            ahead, back = forward_backward(model, emission, first, last)
            chance = 1.0 / (1.0 + np.exp(-np.clip(ahead + back, -500, 500)))
            error = np.where(valid, tags - chance, 0.0)
            # Pairs of neighbouring tags: expected against given.
            x = emission[:, 1:] + back[:, 1:]
            r = ahead[:, :-1]
            logs = np.stack([np.zeros_like(x), model.enter + x, model.leave + r, model.stay + x + r])
            pairs = np.exp(logs - logs.max(0))
            pairs = np.where(valid[:, 1:], pairs / pairs.sum(0), 0.0).sum((1, 2))
            before, after = tags[:, :-1] * valid[:, 1:], tags[:, 1:]
            seen = [((1 - before) * after).sum(), (before * (1 - after) * valid[:, 1:]).sum(), (before * after).sum()]
            gradient = np.array(
                [error.sum(), error[:, 0].sum(), *(s - p for s, p in zip(seen, pairs[1:], strict=True))]
            )
            global_squares += gradient**2
            step = rate * gradient / np.sqrt(global_squares)
            model.bias += step[0]
            model.start = float(np.clip(model.start + step[1], -_CLIP, _CLIP))
            model.enter = float(np.clip(model.enter + step[2], -_CLIP, _CLIP))
            model.leave = float(np.clip(model.leave + step[3], -_CLIP, _CLIP))
            model.stay = float(np.clip(model.stay + step[4], -_CLIP, _CLIP))
            sums = np.bincount(index, error[valid][owner], _BUCKETS)
            touched = np.unique(index)
            g = sums[touched].astype(np.float32) - 1e-5 * model.weight[touched]
            squares[touched] += g * g
            model.weight[touched] += rate * g / np.sqrt(squares[touched])
    return model


def summed_up(chances: np.ndarray) -> tuple[float, float, float]:
    """Log-odds that some token is toxic, that the most toxic one is, and the number of toxic
    tokens on a log scale."""
    none = float(np.log1p(-np.minimum(chances, 1 - 1e-9)).sum()) if len(chances) else 0.0
    some = max(-math.expm1(none), 1e-9)
    odds = math.log(some) - max(none, -20.0)
    most = min(max(float(chances.max(initial=0.0)), 1e-9), 1 - 1e-9)
    return min(odds, 20.0), math.log(most / (1 - most)), math.log1p(float(chances.sum()))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1) -> np.ndarray:
    """Newton's method for a penalised logistic fit."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(x.shape[1])
        beta += np.linalg.solve(hessian, x.T @ (y - p) - penalty * beta)
    return beta


def train(texts: list[str | None], toxic: list[int]) -> Field:
    texts = [t or "" for t in texts]
    labels = [bool(y) for y in toxic]
    if not any(labels) or all(labels):
        model = Field(bias=-20.0)
        share = (sum(labels) + 0.5) / (len(labels) + 1)
        model.fit = (math.log(share / (1 - share)), 0.0, 0.0, 0.0)
        return model
    forms = {t: word_form(t) for text in texts for t in text.split()}
    known = Stems()
    docs = [known.document({forms[t] for t in text.split()}) for text in texts]
    marked = toxic_stems(docs, labels, len(known.number))
    del docs
    chunks = _chunks(texts, labels, marked, forms, known)
    del known, forms
    model = train_field(chunks)
    del chunks
    sums = []
    for at in range(0, len(texts), 500):
        sums += [[1.0, *summed_up(c)] for c in _scored(model, texts[at : at + 500], {})]
    x = np.array(sums)
    model.fit = tuple(_logistic(x, np.array(labels, float)).tolist())
    return model


def _scored(model: Field, texts: list[str], known: dict[str, float]) -> Iterator[np.ndarray]:
    """The marginals of each text's tokens."""
    per_text = []
    for text in texts:
        tokens = text.split()
        scores = np.empty(len(tokens))
        for i, token in enumerate(tokens):
            score = known.get(token)
            if score is None:
                score = model.emission(token)
                if len(known) >= _CACHED_WORDS:
                    known.clear()
                known[token] = score
            scores[i] = score
        per_text.append(scores)
    lengths = np.array([len(s) for s in per_text], dtype=np.int64)
    chances = marginals(model, np.concatenate(per_text) if per_text else np.zeros(0), lengths)
    yield from np.split(chances, np.cumsum(lengths)[:-1])


def _spans(text: str, chances: np.ndarray) -> list[dict]:
    if not (chances >= 0.5).any():
        return []
    return [
        {"start": m.start(), "end": m.end(), "marginal": float(p)}
        for m, p in zip(re.finditer(r"\S+", text), chances, strict=True)
        if p >= 0.5
    ]


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    sample: int = SAMPLE,
    sample_bytes: int = SAMPLE_BYTES,
) -> DataFrame:
    """At most ``sample`` (text, label) rows and ``sample_bytes`` / 2 of text per label, none of the
    held-out fold.

    An id is one row: of rows with the same id the shortest text stands for it, the first in byte
    order among those. Ids are taken in a fixed random order; a text longer than all the bytes of its
    label is left out, and so is what comes after the bytes are used up.
    """
    known = (
        labels.select(labels["doc_id"].alias("doc_id"), labels[label_col].alias("label"))
        .where("doc_id IS NOT NULL AND label IS NOT NULL")
        .where(fold_of(F.col("doc_id"), FOLDS) != 0)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    order = F.crc32(F.concat(F.lit("sample:"), F.col("doc_id").cast("string")).cast("binary"))
    chosen = None
    for value in (0, 1):
        some = known.where(F.col("label") == value).orderBy(order, "doc_id").limit(sample)
        chosen = some if chosen is None else chosen.unionByName(some)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    sized = docs.select(docs["doc_id"].alias("doc_id"), F.struct(F.octet_length(text).alias("size"), text.alias("text")).alias("t"))
    # At most 2 * sample ids on the small side; rows that repeat an id shrink before they meet.
    rows = (
        sized.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("t").alias("t"))
        .select("doc_id", "label", "t.size", "t.text")
    )
    most = sample_bytes // 2
    held = staged(rows.where(F.col("size") <= most), "toxicity-sample")
    so_far = Window.partitionBy("label").orderBy(order, "doc_id")
    fits = held.select("doc_id", "label", "size").withColumn("total", F.sum("size").over(so_far))
    fits = fits.where(F.col("total") <= most).select("doc_id")
    return held.join(F.broadcast(fits), "doc_id").select("doc_id", "text", "label")


def fit(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES
) -> Field:
    """Train on the sample, bounded in rows and bytes, in one task."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "text"])
        return pd.DataFrame({"model": [pickle.dumps(train(rows["text"].tolist(), rows["label"].tolist()))]})

    chosen = labelled_sample(docs, labels, sample=sample, sample_bytes=sample_bytes).withColumn("one", F.lit(1))
    found = chosen.groupBy("one").applyInPandas(run, "model binary").collect()
    return pickle.loads(found[0].model) if found else train([], [])


def score_documents(docs: DataFrame, model: Field, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows (*keys, score, predicted, spans); a span is a token's character offsets."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select(*keys, docs["text"].cast("string").alias("__text"))
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema[:-1]]
        + ["score double", "predicted int", f"spans {_SPAN}"]
    )
    n_keys = len(keys)
    span_type = pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())])
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = held.value, {}
        for batch in batches:
            scores, spans = [], []
            for at in range(0, batch.num_rows, 1000):
                texts = [t or "" for t in batch[n_keys].slice(at, 1000).to_pylist()]
                for text, chances in zip(texts, _scored(model, texts, known), strict=True):
                    odds = float(np.dot(model.fit, [1.0, *summed_up(chances)]))
                    scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
                    spans.append(_spans(text, chances))
            yield pa.RecordBatch.from_arrays(
                [batch[i] for i in range(n_keys)]
                + [
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                    pa.array(spans, span_type),
                ],
                [*batch.schema.names[:n_keys], "score", "predicted", "spans"],
            )

    return narrow.mapInArrow(score, schema)
