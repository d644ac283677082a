"""HTML tables to rows of cell texts, and the two published tables built on them.

A page is turned into delimited text by a few regular-expression passes over the whole document,
inside the JVM, and then split. Unclosed rows and cells end where the next one starts. The rows of a
table nested in the first one are rows like its others. A cell that spans rows or columns fills them.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from html import entities

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.constants import (
    FX_FIRST_YEAR,
    FX_LIVE_SOURCE,
    POLICY_LIVE_SOURCE,
    POLICY_RATE_MAX,
    POLICY_RATE_MIN,
    USD_PHP,
)
from stratalake.functions.numeric import parse_rate
from stratalake.functions.temporal import date_from_parts, iso_text, parse_date
from stratalake.operators.columns import computed_once
from stratalake.operators.filters import min_year

_IGNORED = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
# A control character, which HTML text cannot hold, frames the names of structural tags.
_MARK = "\x1d"
_SPACE = "[\\s\u00a0]*"

_REPLACEMENT = "\ufffd"
#: Names that the HTML standard also knows without a semicolon, the longest first.
_OPEN_NAMES = "|".join(sorted((n for n in entities.html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
_REFERENCE = rf"&(?:#\d+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*;|(?:{_OPEN_NAMES}))"


def _named_references() -> Column:
    """The named character references of the HTML standard, as a map from name to characters."""
    names = {f"&{name}": text for name, text in entities.html5.items()}
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def _character(reference: Column) -> Column:
    """What a character reference stands for; of an unknown name the longest known beginning."""
    digits = F.regexp_extract(reference, r"^&#0*(\d+);?$", 1)
    hexes = F.regexp_extract(reference, r"^&#[xX]0*([0-9a-fA-F]+);?$", 1)
    # More digits than the largest code point has cannot be one.
    code = F.when((digits != "") & (F.length(digits) <= 7), digits.try_cast("int")).when(
        (hexes != "") & (F.length(hexes) <= 6), F.conv(hexes, 16, 10).try_cast("int")
    )
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    character = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code)), 8, "0")), "UTF-32")
    beginning = F.regexp_extract(reference, f"^&(?:{_OPEN_NAMES})", 0)
    known = F.try_element_at(_named_references(), beginning)
    partly = F.concat(known, F.substr(reference, F.length(beginning) + 1))
    named = F.coalesce(F.try_element_at(_named_references(), reference), partly, reference)
    numeric = F.coalesce(character, F.lit(_REPLACEMENT))
    return F.when(F.substring(reference, 2, 1) == "#", numeric).otherwise(named)


def decode_entities(text: Column) -> Column:
    """Named and numeric character references to characters, in one pass.

    The text is split at its references and put together again, so what a reference gives is never
    read as a reference itself. A number that is no character becomes U+FFFD. A semicolon may be
    missing after numbers and after the names for which the HTML standard allows it.
    """
    between = F.split(text, _REFERENCE)
    found = F.concat(F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0)), F.array(F.lit("")))
    pieces = F.zip_with(
        between,
        found,
        lambda piece, reference: F.concat(
            piece, F.when(reference == "", reference).otherwise(_character(reference))
        ),
    )
    return F.when(text.contains("&") & text.rlike(_REFERENCE), F.array_join(pieces, "")).otherwise(text)


def _first_container(html: Column, container: str) -> Column:
    """The content of the first ``container``, with everything nested in it.

    The page is cut before every start and end tag of the container. A running sum over the pieces
    gives the one at which as many containers have ended as have begun.
    """
    after = F.regexp_extract(html, rf"(?is)<{container}\b[^>]*>(.*)\z", 1)
    simple = F.regexp_extract(after, rf"(?is)\A(.*?)(?:</{container}\s*>|\z)", 1)
    pieces = F.split(after, rf"(?i)(?=</?{container}\b)")
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("taken"))
    end = F.aggregate(
        pieces,
        start,
        lambda acc, piece: F.when(acc["depth"] == 0, acc).otherwise(
            F.struct(
                (
                    acc["depth"]
                    + F.when(piece.rlike(rf"(?i)\A</{container}"), -1)
                    .when(piece.rlike(rf"(?i)\A<{container}"), 1)
                    .otherwise(0)
                ).alias("depth"),
                (acc["taken"] + 1).alias("taken"),
            )
        ),
    )
    nested = F.array_join(F.slice(pieces, F.lit(1), end["taken"]), "")
    return F.when(simple.rlike(rf"(?i)<{container}\b"), nested).otherwise(simple)


# A second control character frames how many rows or columns a cell spans, in front of its text.
_SPAN = "\x1c"
_MOST_COLUMNS, _MOST_ROWS = 1000, 65534  # fixed values: limits of the HTML standard


def _with_spans(body: Column, cell_tags: Sequence[str]) -> Column:
    """Note the spans of cells behind their start tags."""
    marked = body
    for name, sign in (("rowspan", "R"), ("colspan", "C")):
        attribute = rf"(?<![\w-]){name}\s*=\s*[\"']?\s*(\d{{1,9}})"
        cell = rf"(?i)(<(?:{'|'.join(cell_tags)})\b[^>]*?{attribute}[^>]*>){_SPACE}"
        marked = F.regexp_replace(marked, cell, f"$1{_SPAN}{sign}$2{_SPAN}")
    return F.when(body.rlike(r"(?i)(?:row|col)span"), marked).otherwise(body)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _cell(raw: Column) -> Column:
    """Text of a cell, the rows (0: all that follow) and the columns it spans."""
    rows = F.regexp_extract(raw, f"{_SPAN}R(\\d+){_SPAN}", 1).try_cast("int")
    columns = F.regexp_extract(raw, f"{_SPAN}C(\\d+){_SPAN}", 1).try_cast("int")
    return F.struct(
        F.regexp_replace(raw, f"{_SPAN}[RC]\\d+{_SPAN}", "").alias("text"),
        F.least(F.coalesce(rows, F.lit(1)), F.lit(_MOST_ROWS)).alias("rows"),
        F.least(F.greatest(F.coalesce(columns, F.lit(1)), F.lit(1)), F.lit(_MOST_COLUMNS)).alias("columns"),
    )


def _next_row(open_cells: Column, row: Column) -> Column:
    """The cells of a row by column, ``(at, left, text)``: those open from above and its own.

    Its own cells take the columns that no cell from above takes, from left to right.
    """
    single = F.flatten(
        F.transform(
            F.transform(row, _cell),
            lambda c: F.array_repeat(F.struct(c["rows"].alias("left"), c["text"].alias("text")), c["columns"]),
        )
    )

    def placed(own: Column) -> Column:
        taken = F.transform(open_cells, lambda o: o["at"])
        most = F.size(own) + F.size(open_cells)
        free = F.filter(F.sequence(F.lit(0), most), lambda at: ~F.array_contains(taken, at))
        fresh = F.zip_with(
            F.slice(free, F.lit(1), F.size(own)),
            own,
            lambda at, c: F.struct(at.alias("at"), c["left"].alias("left"), c["text"].alias("text")),
        )
        return F.array_sort(F.concat(open_cells, fresh))

    return _let(single, placed)


def _filled_rows(rows: Column) -> Column:
    """Rows of raw cells with every cell repeated in all rows and columns that it spans.

    A fold over the rows carries the cells that reach further down. A row without a cell of its own
    stays empty.
    """
    nothing = F.array().cast("array<struct<at: int, left: int, text: string>>")
    start = F.struct(nothing.alias("open"), F.array().cast("array<array<string>>").alias("done"))

    def step(acc: Column, row: Column) -> Column:
        def carried(placed: Column) -> Column:
            below = F.transform(
                F.filter(placed, lambda c: c["left"] != 1),
                lambda c: F.struct(
                    c["at"].alias("at"), F.greatest(c["left"] - 1, F.lit(0)).alias("left"), c["text"].alias("text")
                ),
            )
            texts = F.map_from_entries(F.transform(placed, lambda c: F.struct(c["at"], c["text"])))
            width = F.array_max(F.transform(placed, lambda c: c["at"]))
            cells = F.transform(
                F.sequence(F.lit(0), width), lambda at: F.coalesce(F.try_element_at(texts, at), F.lit(""))
            )
            own = F.when(F.size(row) > 0, cells).otherwise(F.array().cast("array<string>"))
            return F.struct(below.alias("open"), F.concat(acc["done"], F.array(own)).alias("done"))

        return _let(_next_row(acc["open"], row), carried)

    return F.aggregate(rows, start, step, lambda acc: acc["done"])


def _marked(names: Sequence[str]) -> str:
    return f"(?i){_MARK}(?:{'|'.join(names)}){_MARK}"


def extract_rows(
    pages: DataFrame,
    html: str,
    keep: Sequence[str] = (),
    container: str = "table",
    row_tags: Sequence[str] = ("tr",),
    cell_tags: Sequence[str] = ("td", "th"),
) -> DataFrame:
    """Rows of the first ``container`` of each page: ``keep..., row_index, cells``.

    A cell's text nodes are trimmed and joined; text outside of cells is dropped. A cell that spans
    rows or columns stands in each of them. References are decoded cell by cell, after the page has
    been split, so what they stand for is text and nothing else. Each step is a projection of its own,
    which keeps Catalyst from copying one step's work into the next.
    """
    structural = [*row_tags, *cell_tags]
    tag_pattern = rf"(?i){_SPACE}<(/?(?:{'|'.join(structural)}))\b[^>]*>{_SPACE}"
    body = _first_container(F.regexp_replace(html, _IGNORED, ""), container)
    blanks = F.regexp_replace("_body", r"(?i)&(?:nbsp|#160|#xa0);", "\u00a0")

    text = F.regexp_replace("_body", tag_pattern, f"{_MARK}$1{_MARK}")
    text = F.regexp_replace(text, f"{_SPACE}<[^>]*>{_SPACE}", "")
    closing = _marked([f"/{name}" for name in structural])
    text = F.regexp_replace(text, f"{closing}[^{_MARK}]*", "")

    texts = (
        pages.select(*keep, F.translate(body, _MARK + _SPAN, "").alias("_body"))
        .withColumn("_body", F.when(F.col("_body").contains("&"), blanks).otherwise(F.col("_body")))
        .withColumn("_body", _with_spans(F.col("_body"), cell_tags))
        .select(*keep, text.alias("_text"))
    )
    # What precedes the first mark of a page or of a row belongs to no row or cell.
    rows = F.transform(
        F.slice(F.split("_text", _marked(row_tags)), F.lit(2), F.greatest(F.length("_text"), F.lit(0))),
        lambda row: F.slice(F.split(row, _marked(cell_tags)), F.lit(2), F.length(row)),
    )
    split = computed_once(texts, {"_rows": rows})
    spanning = F.col("_text").contains(_SPAN)
    filled = F.when(spanning, _filled_rows(F.col("_rows"))).otherwise(F.col("_rows"))
    listed = split.select(*keep, F.posexplode(filled).alias("row_index", "_cells"))
    decoded = F.when(
        F.exists("_cells", lambda c: c.contains("&")), F.transform("_cells", decode_entities)
    ).otherwise(F.col("_cells"))
    return listed.filter(F.size("_cells") > 0).select(*keep, "row_index", decoded.alias("cells"))


def fx_records(
    pages: DataFrame, html: str, first_year: int = FX_FIRST_YEAR, keep: Sequence[str] = ()
) -> DataFrame:
    """Year-by-month average rates: ``keep..., rate_date, currency_pair, rate, source``."""
    rows = extract_rows(pages, html, keep).withColumn("_year", F.get("cells", F.lit(0)))
    months = (
        min_year(rows, "_year", first_year)
        .select(
            *keep,
            F.col("_year").try_cast("int").alias("year"),
            # A short row simply has fewer months.
            F.posexplode(F.slice("cells", 2, 12)).alias("month_index", "text"),
        )
    )
    rates = computed_once(months, {"rate": parse_rate(F.col("text"))})
    return rates.filter(F.col("rate").isNotNull()).select(
        *keep,
        iso_text(date_from_parts(F.col("year"), F.col("month_index") + 1)).alias("rate_date"),
        F.lit(USD_PHP).alias("currency_pair"),
        "rate",
        F.lit(FX_LIVE_SOURCE).alias("source"),
    )


def policy_records(pages: DataFrame, html: str, keep: Sequence[str] = ()) -> DataFrame:
    """Decisions with a readable date and a plausible rate; direction is decided in silver."""
    decisions = computed_once(
        extract_rows(pages, html, keep),
        {
            "day": parse_date(F.get("cells", F.lit(0))),
            "overnight_rp": parse_rate(F.get("cells", F.lit(1))),
            "overnight_srp": parse_rate(F.get("cells", F.lit(2))),
        },
    ).filter(
        F.col("day").isNotNull() & F.col("overnight_rp").between(POLICY_RATE_MIN, POLICY_RATE_MAX)
    )
    return decisions.select(
        *keep,
        iso_text(F.col("day")).alias("decision_date"),
        "overnight_rp",
        "overnight_srp",
        F.lit(None).cast("string").alias("direction"),
        F.lit(POLICY_LIVE_SOURCE).alias("source"),
    )
