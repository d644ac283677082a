"""Near duplicates by bottom-k sketches of one hash function.

The sketch of a set is its ``SKETCH`` smallest shingle hashes; a set that is not larger is its own
sketch. Sets are told apart by a 120-bit digest, and equal sets are one node.

* Inverted lists: a linked pair shares at least ``least`` of its retained values: the exact overlap
  that its sizes ask for if both sketches are whole sets, else the number of the union's smallest
  values that a linked pair has in common but with probability ``RISK``. So it shares one of the
  first s - least + 1 values of both in any common order. Values that many sketches retain come last
  in that order, the rest by hash; only those first values enter the lists.
* Overlaps: members of a list are paired where sizes and places leave room for ``least``. Long lists
  are not multiplied out: each member meets the leader of its size.
* Filter: for a pair the smallest values of the union of both sketches, and how many of them are
  common, estimate the similarity; pairs below ``least`` go. Two whole sets are decided here exactly.
* Verification: full sets of the others, shingled again from the texts that are asked for.
* Long lists whose members fell into several components are where a sketch is too coarse: near
  copies just below the threshold share most retained values. The members of such a list are compared
  with their consensus T, the values that more than half of them have, and only what tells them from
  it is kept: l values of T that a set lacks, and those it has besides. Two of them have
  |T| - l - l' + (differences in common) values in common, exactly. Where |T| - l - l' is enough they
  are linked, and so is each of both with the member of the group nearest to T; that one link per
  member stands for all of these. Any other linked pair has a known least number of differences in
  common, so it meets in inverted lists of differences, which hold no value of the template.

Links become components. A pair of different sets at or above the threshold is lost with a
probability of at most ``RISK`` if one of them is larger than a sketch, and never otherwise.

Defined cases: a NULL or empty text, or one without words, has the empty set and is linked with
nothing; fewer than five words are one shingle. A NULL id is passed on and names a component only if
all its ids are NULL. Repeated rows are linked. An empty table gives an empty result. Other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import settings
from stratalake.llm.components import connected_components
from stratalake.llm.shingles import combined, shingle_sets
from stratalake.session import staged

PERCENT = 85
SKETCH = 128
RISK = 1e-12
LONG_LIST = 8
#: At most so many frequent values are told apart for the order; it shapes the work, not the result.
ORDERED_VALUES = 1 << 19
_FILTER_BITS = 1 << 22
_SALTS = 32
_CLASS = pa.decimal128(38, 0)
_SETTINGS = {
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def least_common(sketch: int, percent: int, risk: float = RISK) -> int:
    """Of the union's ``sketch`` smallest values, how many a linked pair has in common at least, but
    with probability ``risk``: each is common with a chance of ``percent`` or more."""
    p, tail = percent / 100, 0.0
    for common in range(sketch + 1):
        tail += math.comb(sketch, common) * p**common * (1 - p) ** (sketch - common)
        if tail > risk:
            return max(common, 1)
    return sketch


def prefix_length(n: int, sketch: int, percent: int, least: int) -> int:
    """Values of a sketch that enter the inverted lists."""
    if 100 * n <= percent * sketch:  # every set it may be linked with is a whole sketch too
        return n + percent * -n // 100 + 1
    return max(min(n, sketch) - least + 1, 1)


def _classes(sets: list[np.ndarray]) -> pa.Array:
    """A number per distinct set, NULL for the empty one."""
    digests = b"".join(xxhash.xxh3_128_digest(s.tobytes(), seed=len(s))[:15] + b"\0" for s in sets)
    numbers = pa.Array.from_buffers(_CLASS, len(sets), [None, pa.py_buffer(digests)])
    return pc.if_else(pa.array([len(s) > 0 for s in sets], pa.bool_()), numbers, pa.scalar(None, _CLASS))


def _texts(docs: DataFrame, text_col: str, *keys) -> DataFrame:
    text = docs[text_col].cast("string")
    return docs.select(*keys, F.xxhash64(text).alias("__spot"), text.cast("binary").alias("__text"))


def _profiles(docs: DataFrame, keys: list[str], text_col: str, sketch: int) -> DataFrame:
    """Rows (*keys, spot, n, class, sketch); ``spot`` is a hash of the text."""
    narrow = _texts(docs, text_col, *keys)
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-2])
    n_keys = len(keys)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch[n_keys + 1].to_pylist())
            retained = [np.sort(s.view(np.int64))[:sketch] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: n_keys + 1],
                    pa.array([len(s) for s in sets], pa.int64()),
                    _classes(sets),
                    pa.array(retained, pa.list_(pa.int64())),
                ],
                [*keys, "spot", "n", "class", "sketch"],
            )

    return narrow.mapInArrow(
        profile, f"{own}, spot bigint, n bigint, class decimal(38,0), sketch array<bigint>"
    )


def _frequent_values(classes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Values that many sketches retain, at most ``ORDERED_VALUES``, and by how many."""
    counted = staged(
        classes.select(F.explode("sketch").alias("value"))
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 3"),
        "bottom-k-values",
    )
    level = F.floor(F.log2("n")).cast("int")
    levels = counted.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()
    room, least = ORDERED_VALUES, 0
    for row in sorted(levels, reverse=True):
        room -= row.n
        if room < 0:
            least = row.level + 1
            break
    found = counted.where(level >= least).toArrow()
    values = found["value"].to_numpy()
    order = np.argsort(values)
    return values[order], found["n"].to_numpy()[order]


def _entries(rows: DataFrame, about: list[str], prefix_of) -> DataFrame:
    """Rows (*about, pos, value, known) of the inverted lists of ``rows`` (*about, sketch): the first
    values of each, ``prefix_of`` a batch many. ``known``: how many retain the value, if frequent."""
    held = rows.sparkSession.sparkContext.broadcast(_frequent_values(rows))
    types = dict(rows.dtypes)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, counts = held.value
        for batch in batches:
            values, known = [], []
            for length, retained in zip(prefix_of(batch), batch["sketch"], strict=True):
                own = retained.values.to_numpy()
                count = np.zeros(len(own), np.int64)
                if len(often):
                    place = np.minimum(np.searchsorted(often, own), len(often) - 1)
                    count = np.where(often[place] == own, counts[place], 0)
                order = np.lexsort((own, count))[: max(length, 0)]
                values.append(own[order])
                known.append(count[order])
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (values, known)]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in about), *lists], [*about, "value", "known"]
            )

    schema = ", ".join([f"{c} {types[c]}" for c in about] + ["value array<bigint>", "known array<bigint>"])
    lists = rows.select(*about, "sketch").mapInArrow(enter, schema)
    each = lists.select(*about, F.posexplode(F.arrays_zip("value", "known")).alias("pos", "x"))
    return each.select(*about, F.col("pos").cast("bigint").alias("pos"), "x.value", "x.known")


class _Bounds:
    """The bounds of a pair of members of a list of retained values, as SQL."""

    def __init__(self, sketch: int, percent: int, least: int):
        self.sketch, self.percent, self.least = sketch, percent, least

    def size(self) -> str:
        return f"100 * least(x.n, y.n) >= {self.percent} * greatest(x.n, y.n)"

    def room(self) -> str:
        """Whether enough of both sketches is left from their places on."""
        left = [f"least({side}.n, {self.sketch}) - {side}.pos" for side in "xy"]
        exact = f"({self.percent} * (x.n + y.n) + {99 + self.percent}) div {100 + self.percent}"
        needed = f"IF(greatest(x.n, y.n) <= {self.sketch}, {exact}, {self.least}L)"
        return f"least({', '.join(left)}) >= {needed}"


class _Differences(_Bounds):
    """The bounds of a pair of members of a list of differences from a consensus.

    ``gap`` of a set is (100 + percent) (|T| - 2 l) - 2 percent n. Two sets are linked if the sum of
    their gaps and 2 (100 + percent) times the number of their common differences is not negative.
    ``d`` is the number of differences of a set.
    """

    def needed(self, gaps: str) -> str:
        unit = 2 * (100 + self.percent)
        return f"((-({gaps}) + {unit - 1}) div {unit})"

    def room(self) -> str:
        """Pairs whose gaps are enough are linked by way of the group's nearest member."""
        gaps = "x.gap + y.gap"
        return f"{gaps} < 0 AND least(x.d - x.pos, y.d - y.pos) >= {self.needed(gaps)}"


def _size_class(percent: int) -> Column:
    """Sizes of linked sets lie in the same class or in neighbouring ones."""
    return F.floor(F.log(F.col("n")) / (-1.001 * math.log(percent / 100))).cast("int")


def _pair() -> list[Column]:
    a, b = F.col("x.class"), F.col("y.class")
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _short_lists(entries: DataFrame, bounds: _Bounds, long_list: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of members of short lists, and the members of long ones."""
    rest = entries.where(F.col("known") <= long_list).drop("known")
    lengths = rest.groupBy("value").agg(F.count(F.lit(1)).alias("length")).where("length > 1")
    listed = staged(rest.join(lengths, "value"), "bottom-k-lists")
    short = listed.where(F.col("length") <= long_list)
    pairs = (
        short.alias("x")
        .join(short.alias("y"), "value")
        .where(f"x.class < y.class AND {bounds.size()} AND {bounds.room()}")
        .where("x.component IS NULL OR x.component != y.component")
        .select(*_pair())
    )
    long = entries.where(F.col("known") > long_list).drop("known")
    return pairs, long.unionByName(listed.where(F.col("length") > long_list).drop("length"))


def _with_leaders(long: DataFrame, bounds: _Bounds) -> DataFrame:
    """Pairs of every member of a long list with the first one of its size class.

    The first is that of the least class, so that lists of the same members have the same leader.
    """
    sized = long.withColumn("size_class", _size_class(bounds.percent))
    about = [c for c in long.columns if c != "value"]  # the class comes first
    leaders = sized.groupBy("value", "size_class").agg(F.min(F.struct(*about)).alias("l"))
    # A list may hold a third of all sets: its members meet copies of the leader in several tasks.
    copies = leaders.select("value", "size_class", "l.*", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    spread = sized.withColumn("salt", F.pmod(F.xxhash64("class"), F.lit(_SALTS)).cast("int"))
    return (
        spread.alias("x")
        .join(copies.alias("y"), ["value", "size_class", "salt"])
        .where(f"x.class != y.class AND {bounds.size()} AND {bounds.room()}")
        .where("x.component IS NULL OR x.component != y.component")
        .select(*_pair())
    )


def _mixed(long: DataFrame, found: DataFrame) -> DataFrame:
    """Members of long lists of several components: their component, the largest of the list, and
    the list's hub, its least class."""
    placed = (
        long.drop("component")
        .join(found.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    shares = placed.groupBy("value", "component").agg(
        F.count(F.lit(1)).alias("n"), F.min("class").alias("least")
    )
    largest = (
        shares.groupBy("value")
        .agg(
            F.max_by("component", F.struct("n", "component")).alias("largest"),
            F.min("least").alias("hub"),
            F.count(F.lit(1)).alias("parts"),
        )
        .where("parts > 1")
        .select("value", "largest", "hub")
    )
    return placed.join(largest, "value")


def _differences(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Rows (class, n, component, hub, gap, d, sketch) of the members (hub, class, component) of
    groups: ``sketch`` holds a number for each difference from the group's consensus."""
    members = groups.join(sets, "class")
    sizes = groups.groupBy("hub").agg(F.count(F.lit(1)).alias("members"))
    shared = (
        members.select("hub", F.explode("sketch").alias("value"))
        .groupBy("hub", "value")
        .agg(F.count(F.lit(1)).alias("holders"))
        .join(sizes, "hub")
        .where("2 * holders > members")
    )
    # Fewer than twice the values of a mean member.
    consensus = shared.groupBy("hub").agg(F.collect_list("value").alias("consensus"))
    whole = members.join(consensus, "hub", "left").select(
        "class", "component", "hub", F.xxhash64("hub").alias("salt"), "sketch", "consensus"
    )

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gaps, found = [], [], []
            for salt, own, shared in zip(batch["salt"], batch["sketch"], batch["consensus"], strict=True):
                values = own.values.to_numpy()
                template = shared.values.to_numpy() if shared.is_valid else np.zeros(0, np.int64)
                lost = np.setdiff1d(template, values, assume_unique=True)
                added = np.setdiff1d(values, template, assume_unique=True)
                salts = np.full(2, salt.as_py(), np.int64).view(np.uint64)
                numbers = [
                    combined([v.view(np.uint64), np.full(len(v), s), np.full(len(v), sign, np.uint64)])
                    for v, s, sign in ((lost, salts[0], 1), (added, salts[1], 2))
                ]
                sizes.append(len(values))
                gaps.append((100 + percent) * (len(template) - 2 * len(lost)) - 2 * percent * len(values))
                found.append(np.concatenate(numbers).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["class"],
                    pa.array(sizes, pa.int64()),
                    batch["component"],
                    batch["hub"],
                    pa.array(gaps, pa.int64()),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                ["class", "n", "component", "hub", "gap", "d", "sketch"],
            )

    return whole.mapInArrow(
        differ,
        "class decimal(38,0), n bigint, component decimal(38,0), hub decimal(38,0), gap bigint, d bigint, "
        "sketch array<bigint>",
    )


def _across_components(mixed: DataFrame, bounds: _Differences) -> DataFrame:
    """Pairs of members of a long list of differences in different components that have room.

    Members of equal gap and number of differences from their place on are one shape; only shapes
    that have room are joined.
    """
    shaped = mixed.withColumn("rest", F.col("d") - F.col("pos"))
    shape = ["value", "gap", "rest"]
    shapes = shaped.select(*shape).distinct()
    fits = (
        shapes.alias("x")
        .join(shapes.alias("y"), "value")
        .where(f"x.gap + y.gap < 0 AND least(x.rest, y.rest) >= {bounds.needed('x.gap + y.gap')}")
        .select("value", *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in "xy" for c in shape[1:]])
    )
    sides = [
        shaped.select(
            "value", *[F.col(c).alias(f"{side}_{c}") for c in shape[1:]], F.struct("class", "component", "largest", "n").alias(side)
        )
        for side in "xy"
    ]
    return (
        sides[0]
        .where("x.component != x.largest")
        .join(fits, ["value", "x_gap", "x_rest"])
        .join(sides[1], ["value", "y_gap", "y_rest"])
        .where(f"x.component != y.component AND {bounds.size()}")
        .select(*_pair())
    )


def _padded(lists: pa.ListArray, width: int) -> np.ndarray:
    """A row per list, filled up with the greatest number."""
    ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    lengths = np.diff(ends)
    rows = np.full((len(lengths), width), np.iinfo(np.int64).max)
    row = np.repeat(np.arange(len(lengths)), lengths)
    rows[row, np.arange(ends[-1]) - np.repeat(ends[:-1], lengths)] = lists.flatten().to_numpy()
    return rows


def shared_values(a: np.ndarray, b: np.ndarray, sketch: int) -> tuple[np.ndarray, np.ndarray]:
    """For rows of padded sketches: values in common, and those among the union's ``sketch`` least."""
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    again = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != np.iinfo(np.int64).max)
    rank = 1 + np.cumsum(~again, axis=1)
    return again.sum(axis=1), (again & (rank <= sketch)).sum(axis=1)


def _estimated(pairs: DataFrame, classes: DataFrame, bounds: _Bounds) -> DataFrame:
    """Rows (a, b, whole) of the pairs that the union of both sketches leaves; ``whole``: linked."""
    sketch, percent, least = bounds.sketch, bounds.percent, bounds.least

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = batch["n_a"].to_numpy(), batch["n_b"].to_numpy()
            common, shared = shared_values(_padded(batch["s_a"], sketch), _padded(batch["s_b"], sketch), sketch)
            whole = np.maximum(n_a, n_b) <= sketch
            linked = common * (100 + percent) >= percent * (n_a + n_b)
            stays = pa.array(np.where(whole, linked, shared >= least))
            columns = [batch["a"], batch["b"], pa.array(whole)]
            yield pa.RecordBatch.from_arrays([c.filter(stays) for c in columns], ["a", "b", "whole"])

    left, right = (
        classes.select(F.col("class").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}"))
        for side in "ab"
    )
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "s_a", "s_b")
    return both.mapInArrow(estimate, "a decimal(38,0), b decimal(38,0), whole boolean")


def _sets(docs: DataFrame, text_col: str, wanted: DataFrame) -> DataFrame:
    """Rows (class, sketch) of the classes in ``wanted`` (class, spot); the sketch is the whole set.

    A bit map of fixed size over the texts that are asked for lets tasks leave out the others; the
    join afterwards is exact.
    """
    spot = f"pmod(spot, {_FILTER_BITS})"
    asked = (
        wanted.selectExpr(f"{spot} div 64 AS word", f"shiftleft(1L, CAST({spot} % 64 AS INT)) AS bit")
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()  # at most _FILTER_BITS / 64 rows
    )
    bits = np.zeros(_FILTER_BITS // 64, np.int64)
    bits[asked["word"].to_numpy()] = asked["bits"].to_numpy()
    held = docs.sparkSession.sparkContext.broadcast(bits)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            spots = batch[0].to_numpy() % _FILTER_BITS
            fits = (held.value[spots // 64] >> (spots % 64)) & 1
            at = [i for i in np.flatnonzero(fits).tolist() if batch[0][i].as_py() not in seen]
            if len(seen) > 100_000:
                seen.clear()
            seen.update(batch[0][i].as_py() for i in at)
            sets = shingle_sets(batch[1].take(pa.array(at, pa.int64())).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [_classes(sets), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                ["class", "sketch"],
            )

    near = _texts(docs, text_col).mapInArrow(select, "class decimal(38,0), sketch array<bigint>")
    return near.join(wanted, "class", "left_semi").dropDuplicates(["class"])


def _links(pairs: DataFrame, classes: DataFrame, bounds: _Bounds, sets_of) -> DataFrame:
    """The pairs (a, b) that are linked; ``sets_of`` gives the full sets of asked classes."""
    near = staged(_estimated(pairs.distinct(), classes, bounds), "bottom-k-near")
    certain = near.where("whole").select("a", "b")
    asked = near.where("NOT whole")
    if asked.isEmpty():
        return certain
    sets = sets_of(asked.select(F.explode(F.array("a", "b")).alias("class")).distinct())
    left, right = (sets.select(F.col("class").alias(s), F.col("sketch").alias(f"s_{s}")) for s in "ab")
    overlap = F.size(F.array_intersect("s_a", "s_b")).cast("bigint")
    sizes = F.size("s_a").cast("bigint") + F.size("s_b")
    verified = (
        asked.join(left, "a")
        .join(right, "b")
        .where(overlap * (100 + bounds.percent) >= sizes * bounds.percent)
        .select("a", "b")
    )
    return certain.unionByName(staged(verified, "bottom-k-links"))


def _linked(
    docs: DataFrame, classes: DataFrame, text_col: str, bounds: _Bounds, long_list: int
) -> DataFrame:
    """Rows (node, component) of the classes that are linked with others."""

    def sets_of(asked: DataFrame) -> DataFrame:
        wanted = staged(classes.select("class", "spot").join(asked, "class", "left_semi"), "bottom-k-wanted")
        return staged(_sets(docs, text_col, wanted), "bottom-k-sets")

    sketch, percent, least = bounds.sketch, bounds.percent, bounds.least
    nowhere = classes.withColumn("component", F.lit(None).cast("decimal(38,0)"))

    def retained(batch: pa.RecordBatch) -> list[int]:
        return [prefix_length(n, sketch, percent, least) for n in batch["n"].to_pylist()]

    entries = staged(_entries(nowhere, ["class", "n", "component"], retained), "bottom-k-entries")
    pairs, long = _short_lists(entries, bounds, long_list)
    links = _links(pairs.unionByName(_with_leaders(long, bounds)), classes, bounds, sets_of)
    found = connected_components(links)
    groups = staged(_mixed(long, found).select("hub", "class", "component").distinct(), "bottom-k-groups")
    if groups.isEmpty():
        return found

    differing = _Differences(sketch, percent, least)
    sets = sets_of(groups.select("class").distinct())
    apart = staged(_differences(groups, sets, percent), "bottom-k-differences")
    nearest = apart.groupBy("hub").agg(F.max(F.struct("gap", "class")).alias("h"))
    nearest = nearest.select("hub", F.col("h.gap").alias("most"), F.col("h.class").alias("nearest"))
    led = staged(apart.join(nearest, "hub"), "bottom-k-led")
    near = led.where("gap + most >= 0 AND class != nearest").select(
        F.least("class", "nearest").alias("a"), F.greatest("class", "nearest").alias("b")
    )
    # No member has a greater gap than the nearest one.
    needed = F.expr(f"greatest(1L, {differing.needed('gap + most')})")
    prefixed = led.withColumn("prefix", F.col("d") - needed + 1).where("prefix > 0")
    about = ["class", "n", "component", "gap", "d"]
    entries = staged(
        _entries(prefixed, [*about, "prefix"], lambda batch: batch["prefix"].to_pylist()).drop("prefix"),
        "bottom-k-entries",
    )
    pairs, long = _short_lists(entries, differing, long_list)
    more = _links(pairs.unionByName(_with_leaders(long, differing)), classes, bounds, lambda asked: sets)
    links = links.unionByName(near).unionByName(more)
    found = connected_components(links)
    across = staged(_across_components(_mixed(long, found), differing), "bottom-k-across")
    if across.isEmpty():
        return found
    return connected_components(links.unionByName(_links(across, classes, bounds, lambda asked: sets)))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keys: tuple[str, ...] = (),
    percent: int = PERCENT,
    sketch: int = SKETCH,
    long_list: int = LONG_LIST,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``keys``, n_shingles, component_id and component.

    ``component`` names the component whatever its ids are; NULL for the empty set.
    """
    named = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col], *keys)
    bounds = _Bounds(sketch, percent, least_common(sketch, percent))
    with settings(docs.sparkSession, _SETTINGS):
        profiles = staged(_profiles(named, ["doc_id", *keys], text_col, sketch), "bottom-k-profiles")
        classes = staged(
            profiles.where("class IS NOT NULL")
            .groupBy("class")
            .agg(*[F.first(c).alias(c) for c in ("n", "sketch", "spot")], F.min("doc_id").alias("least_id")),
            "bottom-k-classes",
        )
        found = _linked(named, classes, text_col, bounds, long_list)
    placed = classes.select("class", "least_id").join(
        found.withColumnRenamed("node", "class"), "class", "left"
    ).withColumn("component", F.coalesce("component", "class"))
    names = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_class = placed.join(names, "component").select("class", "component", "component_id")
    return profiles.select("doc_id", *keys, "n", "class").join(by_class, "class", "left").select(
        "doc_id",
        *keys,
        F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "component",
    )
