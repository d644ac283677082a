"""N-gram Jaccard join as a blocked sparse matrix product.

The incidence matrix has a row per distinct shingle set (equal sets are one row) and a column per
shingle. Its product with its transpose holds the overlaps of all pairs. Size-derived bounds keep
that product sparse: with columns in one global order, two linked rows meet in the first
n - ceil(t n) + 1 columns of both, and the first column in which they meet is so early that what
follows it can still reach the overlap that their sizes ask for. Only those entries are multiplied,
block by block of columns. Pairs that meet too late for the bound are discarded, and so are those
whose parities (a bit per range of columns) differ in too many places; for the others the whole
overlap is accumulated and compared with the bound.

* Order: columns that occur often come last. Which they are is counted in every task and summed;
  ``ORDERED_COLUMNS`` bounds how many are told apart. This shapes the work, never the result.
* Hot columns: a column with more than ``LONG_COLUMN`` entries is not multiplied out. Its entries
  are first compared with the one that has the most left after it; then only entries outside the
  column's largest component meet the others, joined by the shapes (size, place) for which the bound
  leaves room. Links inside a component add nothing to it.

Links join sets into components. Two links of different sets are never lost, equal sets are linked
by being one row of the matrix.

Defined cases: a NULL or empty text, or one without words, has the empty set and is linked with
nothing; fewer than five words are one shingle. A NULL id is passed on and never the name of a
component with other ids. Repeated rows are linked. An empty table gives an empty result. Other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import settings
from stratalake.llm.components import connected_components
from stratalake.llm.shingles import shingle_sets
from stratalake.session import staged

PERCENT = 75
ORDERED_COLUMNS = 1 << 19
LONG_COLUMN = 8
_BLOCK_ENTRIES = 250_000
_TASK_ENTRIES = 2_000_000
_FILTER_BITS = 1 << 22
_LEAST_BITS = 256
_PROFILE = ["spot", "n", "class", "parity", "hashes", "counts"]
_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def overlap_needed(sizes, percent: int):
    """Least overlap of linked sets with these sizes in sum."""
    return -(-percent * sizes // (100 + percent))


def prefix_length(size, percent: int):
    """Columns of a set in which it must meet any set it is linked with."""
    return size + percent * -size // 100 + 1


def set_class(found: np.ndarray) -> int:
    """One number per distinct set."""
    return xxhash.xxh3_64_intdigest(found.tobytes(), seed=len(found)) - (1 << 63)


def parity(found: np.ndarray) -> np.ndarray:
    """Whether the number of shingles in each hash range is odd: a bit per range, and twice as many
    ranges as shingles, rounded up to a power of two. Two sets differ in at least as many shingles
    as their parities differ in bits. The halves of a parity, one over the other, are the parity
    over half as many ranges, so sets of different sizes can be compared."""
    bits = max(_LEAST_BITS, 1 << (2 * len(found) - 1).bit_length()) if len(found) else _LEAST_BITS
    bits = min(bits, 1 << 24)
    counts = np.bincount((found >> np.uint64(40)).astype(np.int64) % bits, minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _signed(values) -> pa.Array:
    return pa.array(np.asarray(values).view(np.int64))


def _lists(values: np.ndarray, kind) -> pa.Array:
    return pa.array([values], pa.list_(kind))


def _texts(docs: DataFrame, text_col: str, *keys) -> DataFrame:
    """``keys``, a hash of the text that tells most texts apart, and the text."""
    text = docs[text_col].cast("string").cast("binary").alias("__text")
    return docs.select(*keys, F.xxhash64(text).alias("__spot"), text)


def _profiles(docs: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """Rows (*keys, spot, n, class) of the documents, and rows (hashes, counts) of columns that occur
    more than once in a stretch of a task. ``spot`` is a hash of the text."""
    narrow = _texts(docs, text_col, *keys)
    types = {f.name: f.dataType.simpleString() for f in narrow.schema.fields[:-2]}
    schema = ", ".join(f"`{k}` {t}" for k, t in types.items()) + (
        ", spot bigint, n int, class bigint, parity array<bigint>, hashes array<bigint>, counts array<int>"
    )
    n_keys = len(keys)

    def often(sets: list[np.ndarray], key_types) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(sets), return_counts=True)
        values, counts = values[counts > 1], counts[counts > 1]
        columns = [pa.nulls(1, t) for t in key_types] + [
            pa.nulls(1, pa.int64()),
            pa.nulls(1, pa.int32()),
            pa.nulls(1, pa.int64()),
            pa.nulls(1, pa.list_(pa.int64())),
            _lists(values.view(np.int64), pa.int64()),
            _lists(counts.astype(np.int32), pa.int32()),
        ]
        return pa.RecordBatch.from_arrays(columns, [*keys, *_PROFILE])

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen, entries, key_types = [], set(), 0, []
        for batch in batches:
            key_types = [batch.schema.field(i).type for i in range(n_keys)]
            sets = shingle_sets(batch[n_keys + 1].to_pylist())
            classes = [set_class(s) if len(s) else None for s in sets]
            rows = len(sets)
            columns = [batch[i] for i in range(n_keys + 1)] + [
                pa.array([len(s) for s in sets], pa.int32()),
                pa.array(classes, pa.int64()),
                pa.array([parity(s) for s in sets], pa.list_(pa.int64())),
                pa.nulls(rows, pa.list_(pa.int64())),
                pa.nulls(rows, pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*keys, *_PROFILE])
            for found, number in zip(sets, classes, strict=True):
                if number is not None and number not in seen:
                    seen.add(number)
                    held.append(found)
                    entries += len(found)
            if entries > _TASK_ENTRIES:
                yield often(held, key_types)
                held, seen, entries = [], set(), 0
        if held:
            yield often(held, key_types)

    return narrow.mapInArrow(profile, schema)


def _frequent_columns(profiles: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent columns, at most ``ORDERED_COLUMNS``, and their counts."""
    counted = (
        profiles.where("hashes IS NOT NULL")
        .select(F.explode(F.arrays_zip("hashes", "counts")).alias("x"))
        .groupBy(F.col("x.hashes").alias("value"))
        .agg(F.sum("x.counts").alias("n"))
        .where("n > 3")
    )
    counted = staged(counted, "jaccard-columns")
    # The least count for which all columns fit: exact powers of two need only a short histogram.
    level = F.floor(F.log2("n")).cast("int")
    histogram = {r.level: r.n for r in counted.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()}
    kept, least = 0, 0
    for at in sorted(histogram, reverse=True):
        if kept + histogram[at] > ORDERED_COLUMNS:
            least = at + 1
            break
        kept += histogram[at]
    found = counted.where(level >= least).toArrow()
    values = found["value"].to_numpy().view(np.uint64)
    order = np.argsort(values)
    return values[order], found["n"].to_numpy()[order]


def _ordered_prefix(
    found: np.ndarray, places: np.ndarray, often: np.ndarray, counts: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """First columns of a set in the global order, and the known count of each (0: not frequent)."""
    length = int(prefix_length(len(found), percent))
    rare = found[~often]
    if len(rare) >= length:
        return rare[:length], np.zeros(length, np.int64)
    common, known = found[often], counts[places[often]]
    order = np.lexsort((common, known))[: length - len(rare)]
    return (
        np.concatenate([rare, common[order]]),
        np.concatenate([np.zeros(len(rare), np.int64), known[order]]),
    )


_BLOB_DOC = np.dtype([("class", "<i8"), ("n", "<i4")])
_BLOB_ENTRY = np.dtype([("value", "<u8"), ("doc", "<u4"), ("pos", "<u4")])


def _entries(
    docs: DataFrame, text_col: str, frequent, blocks: int, percent: int, long_column: int
) -> DataFrame:
    """The entries inside the size-derived bounds: packed per block of columns, and as lists for
    hot columns."""
    schema = (
        "block int, data binary, docs binary, "
        "hot array<struct<value: bigint, class: bigint, n: int, pos: int>>"
    )
    held = docs.sparkSession.sparkContext.broadcast(frequent)
    hot_type = pa.list_(
        pa.struct(
            [("value", pa.int64()), ("class", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())]
        )
    )
    names = ["block", "data", "docs", "hot"]

    def flush(members: list, parts: list) -> Iterator[pa.RecordBatch]:
        about = np.array(members, dtype=_BLOB_DOC)
        doc = np.repeat(np.arange(len(parts), dtype=np.uint32), [len(p[0]) for p in parts])
        value = np.concatenate([p[0] for p in parts])
        known = np.concatenate([p[1] for p in parts])
        pos = np.concatenate([np.arange(len(p[0]), dtype=np.uint32) for p in parts])
        is_hot = known > long_column
        if is_hot.any():
            hot_docs = doc[is_hot]
            columns = pa.StructArray.from_arrays(
                [
                    _signed(value[is_hot]),
                    pa.array(about["class"][hot_docs]),
                    pa.array(about["n"][hot_docs]),
                    pa.array(pos[is_hot].astype(np.int32)),
                ],
                ["value", "class", "n", "pos"],
            )
            n = len(columns)
            for at in range(0, n, 50_000):
                piece = columns.slice(at, 50_000)
                lists = pa.ListArray.from_arrays(pa.array([0, len(piece)], pa.int32()), piece)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), lists.cast(hot_type)],
                    names,
                )
        entry = np.empty(int((~is_hot).sum()), dtype=_BLOB_ENTRY)
        entry["value"], entry["doc"], entry["pos"] = value[~is_hot], doc[~is_hot], pos[~is_hot]
        block = ((entry["value"] >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
        order = np.argsort(block, kind="stable")
        entry, block = entry[order], block[order]
        for number in np.unique(block).tolist():
            left, right = np.searchsorted(block, [number, number + 1])
            part = entry[left:right]
            used, local = np.unique(part["doc"], return_inverse=True)
            part = part.copy()
            part["doc"] = local
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int32()),
                    pa.array([b"".join(part[f].tobytes() for f in _BLOB_ENTRY.names)], pa.binary()),
                    pa.array([about[used].tobytes()], pa.binary()),
                    pa.nulls(1, hot_type),
                ],
                names,
            )

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, counts = held.value
        members, parts, seen, entries = [], [], set(), 0
        for batch in batches:
            for found in shingle_sets(batch[1].to_pylist()):
                if not len(found) or (number := set_class(found)) in seen:
                    continue
                seen.add(number)
                if len(columns):
                    places = np.minimum(np.searchsorted(columns, found), len(columns) - 1)
                    often = columns[places] == found
                else:
                    places, often = np.zeros(len(found), np.int64), np.zeros(len(found), bool)
                part = _ordered_prefix(found, places, often, counts, percent)
                members.append((number, len(found)))
                parts.append(part)
                entries += len(part[0])
            if entries > _TASK_ENTRIES // 4:
                yield from flush(members, parts)
                members, parts, seen, entries = [], [], set(), 0
        if parts:
            yield from flush(members, parts)

    return _texts(docs, text_col).mapInArrow(multiply, schema)


#: A pair (a, b), or an entry of a long column (value, class a, n, pos).
_PRODUCT = ["a", "b", "value", "n", "pos"]


def _unpack(data: bytes, docs: bytes) -> tuple[np.ndarray, ...]:
    count = len(data) // _BLOB_ENTRY.itemsize
    value = np.frombuffer(data, "<u8", count)
    doc = np.frombuffer(data, "<u4", count, 8 * count)
    pos = np.frombuffer(data, "<u4", count, 12 * count)
    about = np.frombuffer(docs, _BLOB_DOC)
    return value, about["class"][doc], about["n"][doc], pos


def _multiply_block(percent: int, long_column: int):
    """Pairs that meet early enough in a block of columns; long columns are handed on."""

    def product(blobs: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpack(*blob) for blob in zip(blobs["data"], blobs["docs"], strict=True)]
        value, number, size, pos = (np.concatenate([p[i] for p in parts]) for i in range(4))
        del parts  # a block's columns are the memory of a task: none is held in two forms
        order = np.lexsort((number, value))
        value, number = value[order], number[order]
        first = np.ones(len(value), bool)  # copies of a set in other tasks are the same row
        first[1:] = (value[1:] != value[:-1]) | (number[1:] != number[:-1])
        value, number, order = value[first], number[first], order[first]
        size, pos = size[order], pos[order]
        del order, first
        lengths = np.diff(np.flatnonzero(np.r_[True, value[1:] != value[:-1], True]))
        runs = np.repeat(lengths.astype(np.int32), lengths)
        long = runs > long_column
        handed_on = pd.DataFrame(
            {
                "a": number[long],
                "n": size[long].astype(np.int64),
                "value": value[long].view(np.int64),
                "pos": pos[long].astype(np.int64),
            }
        )
        keep = (runs > 1) & ~long
        value, number = value[keep], number[keep]
        size, pos = size[keep].astype(np.int64), pos[keep].astype(np.int64)
        del runs, long, keep
        left, right = [], []
        at = np.arange(len(value))
        for lag in range(1, long_column):
            at = at[at + lag < len(value)]
            at = at[value[at] == value[at + lag]]
            if not len(at):
                break
            other = at + lag
            rest = np.minimum(size[at] - pos[at], size[other] - pos[other])
            good = rest >= overlap_needed(size[at] + size[other], percent)
            left.append(at[good])
            right.append(other[good])
        i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
        pairs = pd.DataFrame({"a": number[i], "b": number[j]})
        # Nullable integers before the frames meet: a gap would turn 64-bit numbers into floats.
        both = [x.drop_duplicates().astype("Int64") for x in (pairs, handed_on)]
        return pd.concat([x.reindex(columns=_PRODUCT).astype("Int64") for x in both])

    return product


def _sets(docs: DataFrame, text_col: str, wanted: DataFrame) -> DataFrame:
    """Rows (class, shingles) of the classes in ``wanted`` (class, spot of one of its texts).

    A bit map of fixed size over the texts that are asked for lets tasks leave out most others
    before their words are read; the join afterwards is exact.
    """
    spot = f"pmod(spot, {_FILTER_BITS})"
    words = (
        wanted.selectExpr(
            f"{spot} div 64 AS word",
            f"shiftleft(CAST(1 AS BIGINT), CAST({spot} % 64 AS INT)) AS bit",
        )
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .collect()
    )
    bits = np.zeros(_FILTER_BITS // 64, dtype=np.int64)
    for row in words:  # at most _FILTER_BITS / 64 rows
        bits[row.word] = row.bits
    held = docs.sparkSession.sparkContext.broadcast(bits)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            spots = batch[0].to_numpy() % _FILTER_BITS
            asked = np.flatnonzero((held.value[spots // 64] >> (spots % 64)) & 1)
            classes, sets = [], []
            for found in shingle_sets(batch[1].take(pa.array(asked)).to_pylist()):
                if not len(found) or (number := set_class(found)) in seen:
                    continue
                if len(seen) > 100_000:
                    seen.clear()
                seen.add(number)
                classes.append(number)
                sets.append(found.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(classes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                ["class", "shingles"],
            )

    near = _texts(docs, text_col).mapInArrow(select, "class bigint, shingles array<bigint>")
    return near.join(wanted, "class", "left_semi").dropDuplicates(["class"])


def _may_link(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose parities leave room for the overlap they need."""
    sides = [
        classes.select(*[F.col(c).alias(f"{c}_{side}") for c in ("n", "parity")], F.col("class").alias(side))
        for side in ("a", "b")
    ]
    # Linked sets differ by less than half in size, so at most one folding makes parities alike.
    folded = "zip_with(slice({0}, 1, size({0}) div 2), slice({0}, size({0}) div 2 + 1, size({0}) div 2), (x, y) -> x ^ y)"
    alike = "CASE WHEN size({0}) > size({1}) THEN " + folded + " ELSE {0} END"
    left, right = alike.format("parity_a", "parity_b"), alike.format("parity_b", "parity_a")
    differ = f"aggregate(zip_with({left}, {right}, (x, y) -> bit_count(x ^ y)), 0, (s, c) -> s + c)"
    sizes = "(CAST(n_a AS BIGINT) + n_b)"
    need = f"({percent} * {sizes} + {99 + percent}) div {100 + percent}"
    return (
        pairs.join(sides[0], "a").join(sides[1], "b").where(f"{differ} <= {sizes} - 2 * ({need})").select("a", "b")
    )


def _verified(
    docs: DataFrame, text_col: str, pairs: DataFrame, classes: DataFrame, percent: int
) -> DataFrame:
    """The pairs (a, b) that are linked, by their full overlap."""
    near = staged(_may_link(pairs, classes, percent), "jaccard-near")
    if near.isEmpty():
        return near
    asked = near.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    wanted = classes.select("class", "spot").join(asked, "class", "left_semi")
    sets = staged(_sets(docs, text_col, staged(wanted, "jaccard-wanted")), "jaccard-sets")
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("sb"))
    overlap = F.size(F.array_intersect("sa", "sb")).cast("bigint")
    sizes = F.size("sa").cast("bigint") + F.size("sb")
    linked = near.join(left, "a").join(right, "b").where(overlap * (100 + percent) >= sizes * percent)
    return staged(linked.select("a", "b"), "jaccard-edges")


def _reachable(percent: int, left: str, right: str) -> str:
    """Position bound of two entries of a column, as SQL."""
    need = f"({percent} * ({left}.n + {right}.n) + {99 + percent}) div {100 + percent}"
    return f"least({left}.n - {left}.pos, {right}.n - {right}.pos) >= {need}"


def _ordered_pairs(left: str, right: str) -> list:
    a, b = F.col(f"{left}.class"), F.col(f"{right}.class")
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _first_of_column(hot: DataFrame, percent: int) -> DataFrame:
    """Pairs of each entry of a hot column with the one that has most of its set after it."""
    leader = F.min(F.struct((F.col("pos") / F.col("n")).alias("part"), "class", "n", "pos"))
    leaders = hot.groupBy("value").agg(leader.alias("l")).select("value", "l.class", "l.n", "l.pos")
    return (
        hot.alias("x")
        .join(leaders.alias("y"), "value")
        .where(f"x.class != y.class AND {_reachable(percent, 'x', 'y')}")
        .select(*_ordered_pairs("x", "y"))
        .distinct()
    )


def _across_components(hot: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Pairs of a hot column's entries in different components, none of both in its largest or
    one of them."""
    entries = (
        hot.join(found.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
        .select("value", "class", "n", "pos", "component")
    )
    shares = entries.groupBy("value", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = (
        shares.groupBy("value")
        .agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1")
        .select("value", "largest")
    )
    mixed = staged(entries.join(largest, "value"), "jaccard-mixed")
    # Entries of about the same size and share of the set from their place on are one shape. Shapes
    # too late for the bound are not joined, so entries that cannot be linked form no pairs.
    step, parts, needed = 1.02, 50, percent / (100 + percent)
    shaped = mixed.withColumns(
        {
            "size": F.floor(F.log("n") / math.log(step)).cast("int"),
            "rest": F.ceil(parts * (F.col("n") - F.col("pos")) / F.col("n")).cast("int"),
        }
    )
    shapes = shaped.select("value", "size", "rest").distinct()
    early = "{0}.rest / {2} + 1e-9 >= {3} * (1 + pow({4}, {1}.size - {0}.size - 1))"
    fits = (
        shapes.alias("x")
        .join(shapes.alias("y"), "value")
        .where(" AND ".join(early.format(*ends, parts, needed, step) for ends in ("xy", "yx")))
        .select("value", *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in "xy" for c in ("size", "rest")])
    )
    left, right = (
        shaped.select(
            "value",
            *[F.col(c).alias(f"{side}_{c}") for c in ("size", "rest")],
            F.struct("class", "n", "pos", "component", "largest").alias(side),
        )
        for side in "xy"
    )
    return (
        left.where("x.component != x.largest")
        .join(fits, ["value", "x_size", "x_rest"])
        .join(right, ["value", "y_size", "y_rest"])
        .where(f"x.component != y.component AND {_reachable(percent, 'x', 'y')}")
        .select(*_ordered_pairs("x", "y"))
        .distinct()
    )


def linked_classes(
    docs: DataFrame,
    profiles: DataFrame,
    text_col: str = "text",
    percent: int = PERCENT,
    long_column: int = LONG_COLUMN,
) -> DataFrame:
    """Rows (node, component) of the shingle-set classes that are linked with others."""
    frequent = _frequent_columns(profiles)
    total = profiles.agg(F.sum(F.col("n") * (100 - percent) / 100 + 1)).first()[0] or 0
    blocks = max(1, math.ceil(total / _BLOCK_ENTRIES))
    entries = staged(_entries(docs, text_col, frequent, blocks, percent, long_column), "jaccard-entries")
    fields = ", ".join(f"{c} bigint" for c in _PRODUCT)
    blobs = entries.where("block IS NOT NULL").select("block", "data", "docs")
    product = staged(
        blobs.groupBy("block").applyInPandas(_multiply_block(percent, long_column), fields), "jaccard-product"
    )
    hot = staged(
        entries.select(F.explode("hot").alias("x"))
        .select("x.*")
        .unionByName(
            product.where("value IS NOT NULL").selectExpr(
                "value", "a AS class", "CAST(n AS INT) AS n", "CAST(pos AS INT) AS pos"
            )
        )
        .dropDuplicates(["value", "class"]),
        "jaccard-hot",
    )
    met = product.where("b IS NOT NULL").select("a", "b")
    pairs = staged(
        met.unionByName(_first_of_column(hot, percent)).distinct(), "jaccard-pairs"
    )
    classes = staged(
        profiles.where("class IS NOT NULL").select("class", "spot", "n", "parity").dropDuplicates(["class"]),
        "jaccard-classes",
    )
    edges = _verified(docs, text_col, pairs, classes, percent)
    found = connected_components(edges)
    if hot.isEmpty():
        return found
    across = staged(
        _across_components(hot, found, percent).join(pairs, ["a", "b"], "left_anti"),
        "jaccard-across",
    )
    more = _verified(docs, text_col, across, classes, percent)
    if more.isEmpty():
        return found
    return connected_components(edges.unionByName(more))


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keys: tuple[str, ...] = (),
    percent: int = PERCENT,
    long_column: int = LONG_COLUMN,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, component and ``keys``.

    ``component`` names the component whatever its ids are; NULL for the empty set.
    """
    named = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col], *keys)
    with settings(docs.sparkSession, _BATCHES):
        profiles = staged(_profiles(named, ["doc_id", *keys], text_col), "jaccard-profiles")
        rows = profiles.where("n IS NOT NULL").select("doc_id", *keys, "n", "class")
        found = linked_classes(docs, profiles, text_col, percent, long_column)
    least = rows.groupBy("class").agg(F.min("doc_id").alias("least"))
    classes = (
        least.where("class IS NOT NULL")
        .join(found.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    named_by = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = classes.join(named_by, "component").select("class", "component", "component_id")
    return rows.join(by_class, "class", "left").select(
        "doc_id",
        *keys,
        F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("doc_id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
        "component",
    )
