"""JSON-stat cubes to long rows.

A cube lists its cells row-major, the last dimension (time) fastest: ``value`` is an array, or, for a
sparse cube, an object from the cell's position to its value. ``size`` gives the members of each
dimension, so a position is a number in mixed radix whose digits are the members' places.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.constants import PSA_LIVE_SOURCE
from stratalake.functions.numeric import unit_of
from stratalake.operators.columns import computed_once

# Values and dimensions stay raw text at first: values are a list or an object, and next to the
# dimensions offices put "id", "size" and "role". The cube sits below "dataset" or is the document.
_CUBE = "value string, dimension map<string,string>, id array<string>, size array<bigint>"
_DOCUMENT = f"dataset struct<{_CUBE.replace(' ', ':').replace(',:', ', ')}>, {_CUBE}"
_NOT_DIMENSIONS = ("id", "size", "role")
_CATEGORY = "category struct<label:map<string,string>,index:string>"
_CELLS = "array<struct<position: bigint, value: double>>"


def _codes(category: Column) -> Column:
    """Member codes in the order of ``index`` (list or positions), else that of the labels."""
    index = category["index"]
    placed = F.map_entries(F.from_json(index, "map<string,int>"))
    by_place = F.array_sort(
        F.transform(placed, lambda e: F.struct(e["value"].alias("at"), e["key"].alias("code")))
    )
    codes = F.when(
        F.substring(F.ltrim(index), 1, 1) == "[", F.from_json(index, "array<string>")
    ).otherwise(F.transform(by_place, lambda e: e["code"]))
    return F.coalesce(codes, F.map_keys(category["label"]), F.array().cast("array<string>"))


def _is_list(value: Column) -> Column:
    return F.substring(F.ltrim(value), 1, 1) == "["


def _listed(value: Column) -> Column:
    return F.when(_is_list(value), F.from_json(value, "array<string>"))


def _sparse(value: Column) -> Column:
    return F.when(~_is_list(value), F.from_json(value, "map<string,string>"))


def _cubes(documents: DataFrame, doc: str, keep: Sequence[str]) -> DataFrame:
    """``keep...`` and ``_cube``: listed, sparse, members (number of dimensions), dims (name, codes,
    labels), strides and sizes. Each step's values are computed once and not copied by Catalyst.
    """
    parsed = computed_once(documents.select(*keep, doc), {"_doc": F.from_json(doc, _DOCUMENT)})
    value = F.coalesce("_doc.dataset.value", "_doc.value")
    raw = F.coalesce("_doc.dataset.dimension", "_doc.dimension")
    steps = computed_once(
        parsed.select(
            *keep,
            value.alias("_given"),
            raw.alias("_raw"),
            F.coalesce("_doc.dataset.id", "_doc.id").alias("_id"),
            F.coalesce("_doc.dataset.size", "_doc.size").alias("_size"),
            F.map_filter(raw, lambda name, _: ~name.isin(*_NOT_DIMENSIONS)).alias("_members"),
        ),
        {
            "_listed": _listed(F.col("_given")),
            "_sparse": _sparse(F.col("_given")),
            "_order": F.coalesce(
                "_id",
                F.from_json(F.try_element_at("_raw", F.lit("id")), "array<string>"),
                F.map_keys("_members"),
            ),
            "_sizes": F.coalesce(
                "_size", F.from_json(F.try_element_at("_raw", F.lit("size")), "array<bigint>")
            ),
        },
    )
    categories = F.transform(
        "_order",
        lambda name: F.struct(
            name.alias("name"),
            F.from_json(F.try_element_at("_members", name), _CATEGORY)["category"].alias("category"),
        ),
    )
    coded = computed_once(steps.drop("_given", "_raw", "_id", "_size"), {"_categories": categories})
    dims = F.transform(
        "_categories",
        lambda d: F.struct(
            d["name"].alias("name"), _codes(d["category"]).alias("codes"), d["category"]["label"].alias("names")
        ),
    )
    named = computed_once(coded, {"_dims": dims})
    labelled = F.transform(
        "_dims",
        lambda d: F.struct(
            d["name"].alias("name"),
            d["codes"].alias("codes"),
            F.transform(
                d["codes"], lambda code: F.coalesce(F.try_element_at(d["names"], code), code)
            ).alias("labels"),
        ),
    )
    sizes = F.coalesce(
        F.when(F.size("_sizes") == F.size("_dims"), F.col("_sizes")),
        F.transform("_dims", lambda d: F.size(d["codes"]).cast("bigint")),
    )
    sized = computed_once(
        named.select(*keep, "_listed", "_sparse", "_members", "_dims", labelled.alias("_labelled"), sizes.alias("_sizes")),
        {
            # Cells between neighbours of each dimension: the product of the sizes after it.
            "_strides": F.transform(
                "_sizes",
                lambda _, i: F.aggregate(
                    F.slice("_sizes", i + 2, F.size("_sizes")), F.lit(1).cast("bigint"), lambda a, n: a * n
                ),
            )
        },
    )
    return sized.select(
        *keep,
        F.struct(
            F.col("_listed").alias("listed"),
            F.col("_sparse").alias("sparse"),
            F.size("_members").alias("members"),
            F.col("_labelled").alias("dims"),
            F.col("_sizes").alias("sizes"),
            F.col("_strides").alias("strides"),
        ).alias("_cube"),
    )


def _last(values: str) -> Column:
    return F.try_element_at(F.col(values), F.lit(-1))


def _numbers(texts: Column, first: Column) -> Column:
    """Cells of a stretch of a listed cube; a text that is no number is no value."""
    return F.transform(
        texts,
        lambda text, i: F.struct((first + i).alias("position"), text.try_cast("double").alias("value")),
    )


def _slice_cells(where: Mapping[str, str]) -> Column:
    """The cells of one line along the last dimension, NULL if it has no such line.

    Every other dimension is held at the member that ``where`` names by code or label, else at its
    first. As the last dimension is the fastest, the line is a stretch of positions.
    """
    chosen = F.lit(0).cast("bigint")
    if where:
        names = F.create_map(*[F.lit(x) for pair in where.items() for x in pair])

        def place(dim: Column) -> Column:
            asked = F.try_element_at(names, dim["name"])
            by_code = F.array_position(dim["codes"], asked)
            at = F.when(by_code > 0, by_code).otherwise(F.array_position(dim["labels"], asked))
            return F.when(asked.isNull(), 0).when(at > 0, at - 1).cast("bigint")

        held = F.transform(
            F.slice("_cube.dims", 1, F.greatest(F.size("_cube.dims") - 1, F.lit(0))),
            lambda dim, i: place(dim) * F.get(F.col("_cube.strides"), i),
        )
        unknown = F.array(*[F.lit(n) for n in where])
        known = F.size(F.array_except(unknown, F.transform("_cube.dims", lambda d: d["name"]))) == 0
        chosen = F.when(known, F.aggregate(held, F.lit(0).cast("bigint"), lambda a, x: a + x))
    length = F.size(_last("_cube.dims")["labels"])
    listed = _numbers(
        F.slice(F.col("_cube.listed"), (chosen + 1).cast("int"), F.greatest(length, F.lit(0))), chosen
    )
    sparse = F.transform(
        F.sequence(chosen, chosen + length - 1),
        lambda p: F.struct(
            p.alias("position"),
            F.try_element_at(F.col("_cube.sparse"), p.cast("string")).try_cast("double").alias("value"),
        ),
    )
    found = F.when(F.col("_cube.listed").isNotNull(), listed).when(length > 0, sparse)
    return F.when(chosen.isNotNull(), found)


def _labelled_line(cells: Column) -> Column:
    labels = _last("_cube.dims")["labels"]
    return F.transform(
        cells,
        lambda cell, i: F.struct(
            i.alias("position"), F.get(labels, i).alias("label"), cell["value"].alias("value")
        ),
    )


def rejected_cubes(documents: DataFrame, doc: str, key: str, min_dimensions: int = 2) -> DataFrame:
    """``key, reason`` of the documents whose first line gives no cell at all."""
    cube = _cubes(documents, doc, [key])
    lines = computed_once(cube, {"_line": _slice_cells({})})
    no_values = F.col("_cube.listed").isNull() & F.col("_cube.sparse").isNull()
    reason = (
        F.when(no_values | (F.col("_cube.members") < 0), "no cube")
        .when(F.col("_cube.members") < min_dimensions, "too few dimensions")
        .when(F.coalesce(F.size(_last("_cube.dims")["labels"]), F.lit(0)) <= 0, "no labels")
        .when(~F.coalesce(F.exists("_line", lambda c: c["value"].isNotNull()), F.lit(False)), "no values")
    )
    found = computed_once(lines, {"reason": reason})
    return found.select(key, "reason").filter("reason IS NOT NULL")


def decode_json_stat(
    documents: DataFrame,
    doc: str,
    keep: Sequence[str] = (),
    min_dimensions: int = 2,
    where: Mapping[str, str] = {},
) -> DataFrame:
    """One row per labelled, non-NULL cell of a line: ``keep..., position, label, value``.

    The line runs along the last dimension, whose members give position and label; every other
    dimension is held at the member that ``where`` names by code or label, else at its first.
    Cubes with fewer than ``min_dimensions`` dimensions, or without a member that is asked for,
    give no row, nor do values beyond the labels.
    """
    cubes = _cubes(documents, doc, keep).filter(F.col("_cube.members") >= min_dimensions)
    lines = computed_once(cubes, {"_cells": _labelled_line(_slice_cells(where))})
    # Each output row carries its own cell, not the whole label list.
    cells = lines.select(*keep, F.explode("_cells").alias("_cell"))
    label, value = F.col("_cell")["label"], F.col("_cell")["value"]
    return cells.filter(value.isNotNull() & (label != "")).select(
        *keep, F.col("_cell")["position"].alias("position"), label.alias("label"), value.alias("value")
    )


def decode_cells(
    documents: DataFrame, doc: str, keep: Sequence[str] = (), min_dimensions: int = 1
) -> DataFrame:
    """Every non-NULL cell of cubes of any number of dimensions, listed or sparse:
    ``keep..., position, codes, labels, value``, the maps from dimension to its member.

    Positions that the sizes do not reach are left out, and so is a position that is no number.
    """
    cubes = _cubes(documents, doc, keep).filter(F.col("_cube.members") >= min_dimensions)
    entries = F.transform(
        F.map_entries("_cube.sparse"),
        lambda e: F.struct(
            e["key"].try_cast("bigint").alias("position"), e["value"].try_cast("double").alias("value")
        ),
    )
    every = F.coalesce(_numbers(F.col("_cube.listed"), F.lit(0).cast("bigint")), entries)
    last = F.aggregate("_cube.sizes", F.lit(1).cast("bigint"), lambda a, n: a * n)
    inside = F.filter(
        every, lambda c: c["value"].isNotNull() & (c["position"] >= 0) & (c["position"] < last)
    )

    def members(cell: Column, what: str) -> Column:
        places = F.zip_with(
            "_cube.sizes", "_cube.strides", lambda n, stride: F.floor(cell["position"] / stride) % n
        )
        found = F.zip_with(
            F.col("_cube.dims"), places, lambda dim, at: F.get(dim[what], at.cast("int"))
        )
        return F.map_from_arrays(F.transform("_cube.dims", lambda d: d["name"]), found)

    cells = computed_once(
        cubes,
        {
            "_cells": F.transform(
                inside,
                lambda c: F.struct(
                    c["position"].alias("position"),
                    members(c, "codes").alias("codes"),
                    members(c, "labels").alias("labels"),
                    c["value"].alias("value"),
                ),
            )
        },
    )
    return cells.select(*keep, F.explode("_cells").alias("_cell")).select(*keep, "_cell.*")


def cpi_records(documents: DataFrame, doc: str, series_code: Column) -> DataFrame:
    """Bronze-shaped price records from one cube document per series."""
    coded = documents.withColumn("_series", series_code)
    cells = decode_json_stat(coded, doc, ["_series"])
    return cells.select(
        F.col("_series").alias("series_code"),
        F.col("label").alias("period"),
        "value",
        unit_of(F.col("_series")).alias("unit"),
        F.lit(PSA_LIVE_SOURCE).alias("source"),
    )
