"""Decoders. Documents are built from the tables by Spark, one small document per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.constants import MONTHS
from stratalake.functions.digest import fingerprint, row_digest
from stratalake.functions.numeric import parse_rate
from stratalake.functions.temporal import parse_date
from stratalake.operators.filters import min_year
from stratalake.operators.monthly import pivot_months, unpivot_months
from stratalake.plans.bronze import content_digests, first_copies, resolve_paths
from stratalake.session import shared_folder, staged
from stratalake.sources.fallback import concat_series, primary_or_fallback
from stratalake.sources.html_table import decode_entities, extract_rows, fx_records, policy_records
from stratalake.sources.json_stat import cpi_records, decode_cells, decode_json_stat, rejected_cubes
from stratalake.sources.seed_csv import read_cpi_seed, read_fx_seed
from workload import query
from workload.tables import table

# ---------------------------------------------------------------- scalar decoders

_TEXTS = """
texts AS (
  SELECT l_orderkey, l_linenumber,
         CASE l_linenumber WHEN 1 THEN format('{:,.2f}', l_extendedprice)
              WHEN 2 THEN '  ' || l_extendedprice || ' ' WHEN 3 THEN '-' WHEN 4 THEN 'n.a.'
              WHEN 5 THEN l_extendedprice || 'd' WHEN 6 THEN '+' || l_extendedprice || 'e2'
              ELSE CAST(l_extendedprice AS VARCHAR) END AS text
  FROM lineitem)"""


@query(
    "number_clean",
    f"""
    WITH {_TEXTS}, cleaned AS (SELECT *, replace(trim(text), ',', '') AS c FROM texts)
    SELECT l_orderkey, l_linenumber, text,
           CASE WHEN regexp_full_match(c, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')
                THEN CAST(c AS DOUBLE) END AS rate
    FROM cleaned""",
)
def _number_clean(spark: SparkSession, sf: str) -> DataFrame:
    line, price = F.col("l_linenumber"), F.col("l_extendedprice")
    text = (
        F.when(line == 1, F.format_number(price, 2))
        .when(line == 2, F.concat(F.lit("  "), price, F.lit(" ")))
        .when(line == 3, "-")
        .when(line == 4, "n.a.")
        .when(line == 5, F.concat(price, F.lit("d")))
        .when(line == 6, F.concat(F.lit("+"), price, F.lit("e2")))
        .otherwise(price.cast("string"))
    )
    texts = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.alias("text"))
    return texts.withColumn("rate", parse_rate(F.col("text")))


@query(
    "date_multi_format",
    """
    WITH texts AS (
      SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%B %-d, %Y')
             WHEN '2-HIGH' THEN strftime(o_orderdate, '%-d %B %Y')
             WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%-m-%-d')
             WHEN '5-LOW' THEN strftime(o_orderdate, '%-m/%-d/%Y')
             ELSE o_orderpriority END AS text
      FROM orders)
    SELECT o_orderkey, text, strftime(coalesce(
             try_strptime(text, '%B %d, %Y'), try_strptime(text, '%d %B %Y'),
             try_strptime(text, '%Y-%m-%d'), try_strptime(text, '%m/%d/%Y')), '%Y-%m-%d') AS day
    FROM texts""",
)
def _date_multi_format(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("o_orderpriority")
    layouts = {
        "1-URGENT": "MMMM d, yyyy", "2-HIGH": "d MMMM yyyy", "3-MEDIUM": "yyyy-M-d", "5-LOW": "M/d/yyyy",
    }
    text = F.coalesce(
        *[F.when(kind == k, F.date_format("o_orderdate", f)) for k, f in layouts.items()], kind
    )
    texts = table(spark, sf, "orders").select("o_orderkey", text.alias("text"))
    return texts.withColumn("day", parse_date(F.col("text")))


# ---------------------------------------------------------------- wide tables


@query(
    "unpivot_wide",
    """
    SELECT l_suppkey, strftime(make_date(CAST(year(l_shipdate) AS INTEGER),
             CAST(month(l_shipdate) AS INTEGER), 1), '%Y-%m-%d') AS rate_date,
           max(l_extendedprice) AS rate
    FROM lineitem WHERE year(l_shipdate) >= 1997
    GROUP BY l_suppkey, year(l_shipdate), month(l_shipdate)""",
)
def _unpivot_wide(spark: SparkSession, sf: str) -> DataFrame:
    wide = _wide(spark, sf).withColumn("year", F.col("year").cast("string"))
    kept = min_year(wide, "year", 1997).withColumn("year", F.col("year").cast("int"))
    return unpivot_months(kept, "year")


def _wide(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier and year rows with the largest price of each month."""
    lines = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    return pivot_months(
        lines, ["l_suppkey", "year"], F.col("l_shipdate"), F.col("l_extendedprice")
    )


# ---------------------------------------------------------------- JSON


@query("json_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _json_props(spark: SparkSession, sf: str) -> DataFrame:
    parsed = F.from_json("props", "k bigint")
    return table(spark, sf, "events").select("event_id", parsed["k"].alias("k"))


@query(
    "json_stat_decode",
    """
    WITH cells AS (
      SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'CPI_ALL_ITEMS' ELSE 'CPI_YOY_CHANGE' END
               || ':' || l_suppkey AS series_code,
             strftime(l_shipdate, '%YM%m') AS period, max(l_extendedprice) AS value
      FROM lineitem GROUP BY ALL)
    SELECT *, CASE WHEN series_code LIKE '%ALL_ITEMS%' THEN 'index (2018=100)' ELSE 'percent' END
             AS unit, 'psa_openstat' AS source
    FROM cells""",
)
def _json_stat_decode(spark: SparkSession, sf: str) -> DataFrame:
    """A cube per supplier and year, two regions by twelve months; the first region is wanted."""
    year = F.col("year").cast("string")
    labels = F.create_map(
        *[
            part
            for i in range(12)
            for part in (F.lit(str(i)), F.concat(year, F.lit(f"M{i + 1:02d}")))
        ]
    )
    regions = F.create_map(F.lit("0"), F.lit("national"), F.lit("1"), F.lit("other"))

    def dimension(members: F.Column) -> F.Column:
        return F.struct(F.struct(members.alias("label")).alias("category"))

    values = F.array(*[F.col(m) for m in MONTHS], *[-F.col(m) for m in MONTHS])
    cube = F.struct(
        values.alias("value"),
        F.create_map(
            F.lit("Geolocation"), dimension(regions), F.lit("Period"), dimension(labels)
        ).alias("dimension"),
    )
    documents = _wide(spark, sf).select(
        "l_suppkey", F.to_json(F.struct(cube.alias("dataset"))).alias("doc")
    )
    kind = F.when(F.col("l_suppkey") % 2 == 0, "CPI_ALL_ITEMS").otherwise("CPI_YOY_CHANGE")
    return cpi_records(documents, "doc", F.concat_ws(":", kind, "l_suppkey"))


# ---------------------------------------------------------------- HTML


@query(
    "html_rows",
    """
    SELECT page_id, CAST(row_index AS INTEGER) AS row_index, trim(cell) AS cell
    FROM (SELECT page_id, unnest(items) AS cell,
                 generate_subscripts(items, 1) - 1 AS row_index
          FROM (SELECT page_id, regexp_extract_all(
                  regexp_extract(html, '<ul>(.*?)</ul>', 1), '<li><a[^>]*>(.*?)</a></li>', 1) AS items
                FROM pages))""",
)
def _html_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = extract_rows(table(spark, sf, "pages"), "html", ["page_id"], "ul", ["li"], ["a"])
    return rows.select("page_id", "row_index", F.get("cells", F.lit(0)).alias("cell"))


def _cell(value: F.Column, tag: str = "td") -> F.Column:
    return F.concat(F.lit(f"<{tag} class='n'> <b>"), value, F.lit(f"</b>&nbsp;</{tag}>"))


@query(
    "fx_table_decode",
    """
    SELECT l_suppkey, strftime(make_date(CAST(year(l_shipdate) AS INTEGER),
             CAST(month(l_shipdate) AS INTEGER), 1), '%Y-%m-%d') AS rate_date,
           'USD/PHP' AS currency_pair, max(l_extendedprice) AS rate, 'bsp_table12' AS source
    FROM lineitem WHERE year(l_shipdate) >= 1996
    GROUP BY l_suppkey, year(l_shipdate), month(l_shipdate)""",
)
def _fx_table_decode(spark: SparkSession, sf: str) -> DataFrame:
    """A page per supplier and year with a header row, thousands separators and gaps."""
    months = [_cell(F.coalesce(F.format_number(m, 2), F.lit(".."))) for m in MONTHS]
    header = "<tr><th>Year</th>" + "".join(f"<th>{m}</th>" for m in MONTHS) + "</tr>"
    page = F.concat(
        F.lit(f"<html><!-- <table> --><table border=1>{header}<tr>"),
        _cell(F.col("year").cast("string"), "th"),
        *months,
        F.lit("</tr></table><table><tr><td>2001</td><td>1</td></tr></table></html>"),
    )
    pages = _wide(spark, sf).select("l_suppkey", page.alias("html"))
    return fx_records(pages, "html", first_year=1996, keep=["l_suppkey"])


@query(
    "policy_table_decode",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS decision_date,
           round(o_totalprice / 25000, 2) AS overnight_rp, CAST(o_custkey AS DOUBLE) AS overnight_srp,
           'bsp_monetary_policy' AS source
    FROM orders
    WHERE round(o_totalprice / 25000, 2) BETWEEN 0.5 AND 20.0
      AND o_orderpriority <> '4-NOT SPECIFIED'""",
)
def _policy_table_decode(spark: SparkSession, sf: str) -> DataFrame:
    """A page per order; one priority has no readable date and drops out."""
    kind = F.col("o_orderpriority")
    layouts = {
        "1-URGENT": "MMMM d, yyyy", "2-HIGH": "d MMMM yyyy", "3-MEDIUM": "yyyy-MM-dd", "5-LOW": "MM/dd/yyyy",
    }
    day = F.coalesce(
        *[F.when(kind == k, F.date_format("o_orderdate", f)) for k, f in layouts.items()], kind
    )
    page = F.concat(
        F.lit("<table><tr><th>Date</th><th>RP</th><th>SRP</th></tr><tr>"),
        _cell(day),
        _cell(F.round(F.col("o_totalprice") / 25000, 2).cast("string")),
        _cell(F.format_number("o_custkey", 0)),
        F.lit("</tr></table>"),
    )
    pages = table(spark, sf, "orders").select("o_orderkey", page.alias("html"))
    return policy_records(pages, "html", keep=["o_orderkey"]).drop("direction")


# ---------------------------------------------------------------- CSV


@query(
    "csv_seed_fx",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS rate_date, event_type AS currency_pair,
           CASE WHEN value <= 200 THEN value END AS rate, 'bsp_fixture' AS source
    FROM events WHERE event_type <> 'error' OR value > 200""",
)
def _csv_seed_fx(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a seed file without a source column; "error" rows carry an unreadable rate."""
    value = F.col("value")
    rate = F.when(value > 200, "").when(F.col("event_type") == "error", "broken").otherwise(
        value.cast("string")
    )
    folder = shared_folder(spark, "csv-seed-fx")
    table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("rate_date"),
        F.col("event_type").alias("currency_pair"),
        rate.alias("rate"),
    ).write.option("header", True).csv(folder)
    return read_fx_seed(spark, folder)


@query(
    "csv_seed_cpi",
    """
    SELECT o_orderpriority AS series_code, strftime(o_orderdate, '%YM%m') AS period,
           CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS value, 'idx' AS unit,
           'psa_fixture' AS source
    FROM orders""",
)
def _csv_seed_cpi(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark, "csv-seed-cpi")
    open_value = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("string"))
    table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("series_code"),
        F.date_format("o_orderdate", "yyyy'M'MM").alias("period"),
        F.coalesce(open_value, F.lit("")).alias("value"),
        F.lit("idx").alias("unit"),
    ).write.option("header", True).csv(folder)
    return read_cpi_seed(spark, folder)


@query(
    "csv_mixed_headers",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS rate_date, event_type AS currency_pair, value AS rate,
           CASE event_id % 3 WHEN 0 THEN 'bsp_fixture' WHEN 1 THEN 'a' ELSE 'b' END AS source
    FROM events""",
)
def _csv_mixed_headers(spark: SparkSession, sf: str) -> DataFrame:
    """One folder of seed files with three headers: two column orders, and no source column."""
    folder = shared_folder(spark, "csv-mixed-headers")
    day = F.date_format("ts", "yyyy-MM-dd").alias("rate_date")
    pair, rate = F.col("event_type").alias("currency_pair"), F.col("value").alias("rate")
    layouts = {
        0: [day, pair, rate],
        1: [rate, F.lit("a").alias("source"), pair, day],
        2: [day, pair, rate, F.lit("b").alias("source")],
    }
    for rest, columns in layouts.items():
        part = table(spark, sf, "events").filter(F.col("event_id") % 3 == rest).select(*columns)
        part.write.mode("append").option("header", True).csv(folder)
    return read_fx_seed(spark, folder)


@query(
    "csv_bad_cells",
    """
    SELECT o_orderpriority AS series_code, strftime(o_orderdate, '%YM%m') AS period,
           CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS value, '' AS unit,
           'psa_fixture' AS source
    FROM orders""",
)
def _csv_bad_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Every fourth value is no number: it costs the value, not the job."""
    folder = shared_folder(spark, "csv-bad-cells")
    value = F.when(F.col("o_orderkey") % 4 == 0, "n/k").otherwise(F.col("o_totalprice").cast("string"))
    table(spark, sf, "orders").select(
        value.alias("value"),
        F.date_format("o_orderdate", "yyyy'M'MM").alias("period"),
        F.col("o_orderpriority").alias("series_code"),
    ).write.option("header", True).csv(folder)
    return read_cpi_seed(spark, folder)


# ---------------------------------------------------------------- documents that offices serve


@query(
    "html_entities",
    """
    SELECT c_custkey, 'é' || chr(CAST(65 + c_custkey % 26 AS INTEGER)) || '&lt;' || c_name || '\ufffd' AS text
    FROM customer""",
)
def _html_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Named, padded, escaped and impossible character references around a name."""
    number = F.lpad((65 + F.col("c_custkey") % 26).cast("string"), 12, "0")
    text = F.concat(F.lit("&eacute;&#"), number, F.lit(";&#38;lt;"), F.col("c_name"), F.lit("&#9999999;"))
    return table(spark, sf, "customer").select("c_custkey", decode_entities(text).alias("text"))


@query(
    "html_nested_table",
    """
    SELECT o_orderkey, strftime(make_date(CAST(y AS INTEGER), 1, 1), '%Y-%m-%d') AS rate_date, rate
    FROM (SELECT o_orderkey, unnest([2011, 2013, 2012]) AS y,
                 unnest([o_totalprice, o_totalprice + 1, o_totalprice + 2]) AS rate FROM orders)""",
)
def _html_nested_table(spark: SparkSession, sf: str) -> DataFrame:
    """Rows before, inside and after a table nested in the first one; the next table is not read."""

    def row(year: int, more: int) -> list[F.Column]:
        return [F.lit(f"<tr><td>{year}</td><td>"), (F.col("o_totalprice") + more).cast("string"), F.lit("</td></tr>")]

    page = F.concat(
        F.lit("<table>"), *row(2011, 0), F.lit("<tr><td><table>"), *row(2013, 1),
        F.lit("</table></td></tr>"), *row(2012, 2), F.lit("</table><table>"), *row(2014, 3), F.lit("</table>"),
    )
    pages = table(spark, sf, "orders").select("o_orderkey", page.alias("html"))
    return fx_records(pages, "html", keep=["o_orderkey"]).select("o_orderkey", "rate_date", "rate")


@query(
    "html_spans",
    """
    WITH cells AS (
      SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, l_linestatus AS status,
             max(l_extendedprice) FILTER (WHERE month(l_shipdate) <= 6) AS first_half,
             max(l_extendedprice) FILTER (WHERE month(l_shipdate) > 6) AS second_half
      FROM lineitem GROUP BY ALL)
    SELECT l_suppkey, CAST(year AS VARCHAR) AS year, status,
           coalesce(CAST(first_half AS VARCHAR), 'n.a.') AS first_half,
           coalesce(CAST(second_half AS VARCHAR), 'n.a.') AS second_half,
           'to the end & on' AS note
    FROM cells""",
)
def _html_spans(spark: SparkSession, sf: str) -> DataFrame:
    """A page per supplier: the year spans its rows, an empty half-year row its columns, a note all rows."""
    half = F.when(F.month("l_shipdate") <= 6, 1).otherwise(2)
    price = F.col("l_extendedprice")
    rows = (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey", F.year("l_shipdate").alias("year"), F.col("l_linestatus").alias("status"))
        .agg(*[F.max(F.when(half == i, price)).cast("string").alias(f"half{i}") for i in (1, 2)])
    )
    values = F.concat(
        F.lit("<td>"), "status", F.lit("<td>"), F.coalesce("half1", F.lit("n&#46;a.")),
        F.lit("</td><td>"), F.coalesce("half2", F.lit("n&#46a.")), F.lit("</td>"),
    )
    by_year = rows.groupBy("l_suppkey", "year").agg(F.sort_array(F.collect_list(values)).alias("rows"))
    head = F.concat(
        F.lit("<tr><th ROWSPAN='"), F.size("rows").cast("string"), F.lit("'> "), F.col("year").cast("string"), F.lit(" </th>")
    )
    year = F.concat(head, F.array_join("rows", "</tr><tr>"), F.lit("</tr>"))
    pages = by_year.groupBy("l_suppkey").agg(F.array_join(F.sort_array(F.collect_list(year)), "").alias("years"))
    # The first row spans five columns; a note beside it reaches down to the last row.
    page = F.concat(
        F.lit('<table><tr><td colspan="5">all<td data-colspan="9" rowspan = 0>to the end &amp on</tr>'),
        "years",
        F.lit("</table>"),
    )
    found = extract_rows(pages.select("l_suppkey", page.alias("html")), "html", ["l_suppkey"])
    names = ("year", "status", "first_half", "second_half")
    # A row of the table has four columns before the note's; the fifth is empty.
    columns = [F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(names)]
    return found.filter("row_index > 0").select("l_suppkey", *columns, F.get("cells", F.lit(5)).alias("note"))


def _full_cubes(spark: SparkSession, sf: str) -> DataFrame:
    """A cube per order with id, size and role, members in the order of an index; some unusable."""
    doc = F.format_string(
        '{"dataset":{"value":[%s,%s],"dimension":{"id":["Geo","Time"],"size":[1,2],"role":{"time":["Time"]},'
        '"Geo":{"category":{"label":{"p":"PH"}}},"Time":{"category":{"index":{"b":1,"a":0},'
        '"label":{"b":"2024M02","a":"2024M01"}}}}}}',
        F.col("o_orderkey").cast("string"),
        F.col("o_custkey").cast("string"),
    )
    kind = F.col("o_orderkey") % 5
    broken = F.when(kind == 3, "no json").when(kind == 4, '{"value":[1],"dimension":{"Time":{}}}').otherwise(doc)
    return table(spark, sf, "orders").select("o_orderkey", broken.alias("doc"))


@query(
    "json_stat_full",
    """
    SELECT o_orderkey, label, CAST(value AS DOUBLE) AS value
    FROM (SELECT o_orderkey, unnest(['2024M01', '2024M02']) AS label,
                 unnest([o_orderkey, o_custkey]) AS value FROM orders WHERE o_orderkey % 5 < 3)""",
)
def _json_stat_full(spark: SparkSession, sf: str) -> DataFrame:
    cells = decode_json_stat(_full_cubes(spark, sf), "doc", ["o_orderkey"])
    return cells.select("o_orderkey", "label", "value")


@query(
    "document_rejects",
    """
    SELECT o_orderkey, CASE o_orderkey % 5 WHEN 3 THEN 'no cube' ELSE 'too few dimensions' END AS reason
    FROM orders WHERE o_orderkey % 5 >= 3""",
)
def _document_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that give no cell, and why."""
    return rejected_cubes(_full_cubes(spark, sf), "doc", "o_orderkey")


def _quantity_cubes(spark: SparkSession, sf: str, listed: F.Column) -> DataFrame:
    """A cube per supplier, return flag x line status x line number, mostly empty: as a list where
    ``listed``, else as an object from position to value."""
    flag = F.array_position(F.array(*[F.lit(x) for x in "ANR"]), F.col("l_returnflag")) - 1
    status = F.when(F.col("l_linestatus") == "O", 1).otherwise(0)
    position = (flag * 14 + status * 7 + F.col("l_linenumber") - 1).cast("int")
    sums = (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey", position.alias("position"))
        .agg(F.sum("l_quantity").alias("value"))
    )
    cubes = sums.groupBy("l_suppkey").agg(
        F.map_from_entries(F.collect_list(F.struct("position", "value"))).alias("cells")
    )
    dense = F.transform(F.sequence(F.lit(0), F.lit(41)), lambda p: F.try_element_at("cells", p))
    value = F.when(listed, F.concat(F.lit("["), F.array_join(dense.cast("array<string>"), ",", "null"), F.lit("]")))
    lines = "".join(f',"{n}":"line {n}"' for n in range(1, 8))[1:]
    dimensions = (
        '{"flag":{"category":{"index":["A","N","R"]}},"status":{"category":{"index":{"O":1,"F":0},'
        '"label":{"O":"open","F":"final"}}},"line":{"category":{"label":{' + lines + "}}}}"
    )
    document = F.concat(
        F.lit('{"class":"dataset","id":["flag","status","line"],"size":[3,2,7],"dimension":' + dimensions + ',"value":'),
        F.coalesce(value, F.to_json("cells")),
        F.lit("}"),
    )
    return cubes.select("l_suppkey", document.alias("doc"))


@query(
    "json_stat_sparse",
    """
    SELECT l_suppkey, l_returnflag AS flag, CASE l_linestatus WHEN 'O' THEN 'open' ELSE 'final' END AS status,
           'line ' || l_linenumber AS line, CAST(l_linenumber AS VARCHAR) AS line_code, sum(l_quantity) AS value
    FROM lineitem GROUP BY ALL""",
)
def _json_stat_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """All cells of three-dimensional cubes, every other one sparse, with the members they belong to."""
    documents = _quantity_cubes(spark, sf, F.col("l_suppkey") % 2 == 0)
    cells = decode_cells(documents, "doc", ["l_suppkey"])
    names = [F.col("labels")[name].alias(name) for name in ("flag", "status", "line")]
    return cells.select("l_suppkey", *names, F.col("codes")["line"].alias("line_code"), "value")


@query(
    "json_stat_slice",
    """
    SELECT l_suppkey, CAST(l_linenumber - 1 AS INTEGER) AS position, 'line ' || l_linenumber AS label,
           sum(l_quantity) AS value
    FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY ALL""",
)
def _json_stat_slice(spark: SparkSession, sf: str) -> DataFrame:
    """One line of each cube: the flag named by code, the status by label."""
    documents = _quantity_cubes(spark, sf, F.col("l_suppkey") % 3 == 0)
    return decode_json_stat(
        documents, "doc", ["l_suppkey"], where={"flag": "R", "status": "final"}
    )


# ---------------------------------------------------------------- fallback and union


@query(
    "fallback_source",
    """
    SELECT 'empty primary' AS tried, c_custkey AS key, c_name AS name FROM customer
    UNION ALL
    SELECT 'filled primary', s_suppkey, s_name FROM supplier""",
)
def _fallback_source(spark: SparkSession, sf: str) -> DataFrame:
    """The fallback twice: behind a primary without rows, and behind one with rows."""
    suppliers = table(spark, sf, "supplier").selectExpr("s_suppkey AS key", "s_name AS name")
    customers = table(spark, sf, "customer").selectExpr("c_custkey AS key", "c_name AS name")
    none = suppliers.filter(F.col("key") < 0)
    return concat_series(
        primary_or_fallback(none, customers).withColumn("tried", F.lit("empty primary")),
        primary_or_fallback(suppliers, customers).withColumn("tried", F.lit("filled primary")),
    )


# ---------------------------------------------------------------- content hashing

_DIGEST = "sha256(length(lang) || ':' || lang || length(text) || ':' || text)"


@query(
    "content_dedup",
    f"""
    WITH hashed AS (SELECT doc_id, source, {_DIGEST} AS sha256_hash FROM documents)
    SELECT *, min(doc_id) OVER (PARTITION BY source, sha256_hash) AS first_doc_id FROM hashed""",
)
def _content_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Texts are read once; the join works on their digests."""
    digests = content_digests(table(spark, sf, "documents"), "doc_id", ["source"], ["text", "lang"])
    rows = first_copies(staged(digests, "content-digests"), "doc_id", ["source"])
    return rows.select("doc_id", "source", "sha256_hash", "first_doc_id")


@query(
    "content_fingerprint",
    f"""
    WITH hashed AS (SELECT source, {_DIGEST} AS h FROM documents),
    lanes AS (
      SELECT source, count(*) AS row_count,
             sum(CAST('0x' || h[1:15] AS BIGINT)) AS l0, sum(CAST('0x' || h[16:30] AS BIGINT)) AS l1,
             sum(CAST('0x' || h[31:45] AS BIGINT)) AS l2, sum(CAST('0x' || h[46:60] AS BIGINT)) AS l3
      FROM hashed GROUP BY source)
    SELECT source, row_count, sha256(row_count || ':' || CAST(l0 AS VARCHAR) || ':'
             || CAST(l1 AS VARCHAR) || ':' || CAST(l2 AS VARCHAR) || ':' || CAST(l3 AS VARCHAR))
             AS sha256_hash
    FROM lanes""",
)
def _content_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprint(table(spark, sf, "documents"), ["lang", "text"], ["source"])


@query(
    "landing_resolve",
    f"""
    WITH hashed AS (SELECT doc_id, source, lang, {_DIGEST} AS sha256_hash,
                           'bronze/' || source || '/' || doc_id || '.parquet' AS file_path
                    FROM documents),
    manifest AS (SELECT source, sha256_hash, arg_min(file_path, doc_id) AS file_path
                 FROM hashed WHERE lang = 'en' GROUP BY ALL)
    SELECT doc_id, h.sha256_hash, coalesce(m.file_path, h.file_path) AS file_path,
           m.file_path IS NOT NULL AS is_duplicate
    FROM hashed h LEFT JOIN manifest m ON m.source = h.source AND m.sha256_hash = h.sha256_hash""",
)
def _landing_resolve(spark: SparkSession, sf: str) -> DataFrame:
    """English documents have landed; every document is then landed again."""
    path = F.concat(F.lit("bronze/"), "source", F.lit("/"), "doc_id", F.lit(".parquet"))
    new = table(spark, sf, "documents").select(
        "doc_id", "source", "lang", row_digest(["lang", "text"]).alias("sha256_hash"),
        path.alias("file_path"),
    )
    manifest = (
        new.filter(F.col("lang") == "en")
        .groupBy("source", "sha256_hash")
        .agg(F.min_by("file_path", "doc_id").alias("file_path"))
    )
    return resolve_paths(new, manifest).select("doc_id", "sha256_hash", "file_path", "is_duplicate")
