"""Decoders."""

import json
from datetime import date

from pyspark.sql import functions as F

from stratalake.sources.fallback import primary_or_fallback
from stratalake.sources.html_table import decode_entities, extract_rows, fx_records, policy_records
from stratalake.sources.json_stat import cpi_records, decode_cells, decode_json_stat, rejected_cubes
from stratalake.sources.seed_csv import read_cpi_seed, read_fx_seed


def _cube(values, periods, bare=False, dimensions=("Geolocation", "Period")):
    dims = {d: {"category": {"label": {"0": "PHILIPPINES"}}} for d in dimensions[:-1]}
    dims[dimensions[-1]] = {"category": {"label": {str(i): p for i, p in enumerate(periods)}}}
    cube = {"value": values, "dimension": dims}
    return json.dumps(cube if bare else {"dataset": cube})


def _decode(spark, *documents):
    frame = spark.createDataFrame([(i, d) for i, d in enumerate(documents)], "id int, doc string")
    return [tuple(r) for r in decode_json_stat(frame, "doc", ["id"]).orderBy("id", "position").collect()]


def test_json_stat_skips_nulls_and_surplus_values(spark):
    document = _cube([1.0, None, 3.0, 99.0], ["2024M01", "2024M02", "2024M03"])
    assert _decode(spark, document) == [(0, 0, "2024M01", 1.0), (0, 2, "2024M03", 3.0)]


def test_json_stat_fewer_values_than_labels(spark):
    assert _decode(spark, _cube([5], ["2024M01", "2024M02"])) == [(0, 0, "2024M01", 5.0)]


def test_json_stat_bare_document_and_bad_ones(spark):
    good = _cube([7.5], ["2024M01"], bare=True)
    one_dimension = _cube([7.5], ["2024M01"], dimensions=("Period",))
    assert _decode(spark, good, "not json", "{}", one_dimension, None) == [(0, 0, "2024M01", 7.5)]


def test_cpi_records_add_unit_and_source(spark):
    frame = spark.createDataFrame(
        [("CPI_ALL_ITEMS", _cube([104.1], ["2023M01"])), ("CPI_YOY_CHANGE", _cube([8.7], ["2023M01"]))],
        "code string, doc string",
    )
    rows = cpi_records(frame, "doc", F.col("code")).orderBy("series_code").collect()
    assert [tuple(r) for r in rows] == [
        ("CPI_ALL_ITEMS", "2023M01", 104.1, "index (2018=100)", "psa_openstat"),
        ("CPI_YOY_CHANGE", "2023M01", 8.7, "percent", "psa_openstat"),
    ]


FX_PAGE = """<html><body><p>no table</p><!-- <table><tr><td>2011</td><td>1</td></tr></table> -->
<TABLE class=x><thead><tr><th>Year</th><th>Jan</th></tr></thead>
<tr><td>1999</td><td>38.4</td></tr>
<tr>stray<td> <b>20</b>10 </td>stray<td>46.03&nbsp;</td><td>..</td><td>n.a.</td><td>1,045.5</td></tr>
<tr><td>2011<td>44.17<td>&#52;3.70
<tr><td>total</td><td>1</td></tr>
</TABLE><table><tr><td>2012</td><td>9</td></tr></table></body></html>"""


def test_fx_table(spark):
    pages = spark.createDataFrame([(FX_PAGE,)], "html string")
    rows = fx_records(pages, "html").orderBy("rate_date").collect()
    assert [(r.rate_date, r.rate) for r in rows] == [
        ("2010-01-01", 46.03),
        ("2010-04-01", 1045.5),
        ("2011-01-01", 44.17),
        ("2011-02-01", 43.7),
    ]
    assert {(r.currency_pair, r.source) for r in rows} == {("USD/PHP", "bsp_table12")}


def test_html_cells_and_entities(spark):
    html = "<table><tr><td>a &amp; b</td><td>x<br> y </td><td>&lt;5&gt; &#8212; &#x20B1;</td></tr></table>"
    pages = spark.createDataFrame([(1, html), (2, "<p>none</p>"), (3, None)], "id int, html string")
    rows = extract_rows(pages, "html", ["id"]).collect()
    assert [(r.id, r.row_index, r.cells) for r in rows] == [(1, 0, ["a & b", "xy", "<5> \u2014 \u20b1"])]


def test_policy_table(spark):
    html = """<table><tr><th>Date</th><th>RP</th></tr>
    <tr><td>June 20, 2024</td><td>6.50</td><td>-</td></tr>
    <tr><td>16 May 2024</td><td>6.50</td><td>6.00</td></tr>
    <tr><td>2024-4-8</td><td>0.2</td></tr>
    <tr><td>soon</td><td>6.25</td></tr>
    <tr><td>02/15/2024</td></tr></table>"""
    rows = policy_records(spark.createDataFrame([(html,)], "html string"), "html").collect()
    assert sorted((r.decision_date, r.overnight_rp, r.overnight_srp) for r in rows) == [
        ("2024-05-16", 6.5, 6.0),
        ("2024-06-20", 6.5, None),
    ]


def test_seed_files(spark, tmp_path):
    cpi = tmp_path / "cpi.csv"
    cpi.write_text("series_code,period,value\nCPI_ALL_ITEMS,2023M01,104.1\nCPI_ALL_ITEMS,2023M02,\n")
    rows = read_cpi_seed(spark, str(cpi)).orderBy("period").collect()
    assert [tuple(r) for r in rows] == [
        ("CPI_ALL_ITEMS", "2023M01", 104.1, "", "psa_fixture"),
        ("CPI_ALL_ITEMS", "2023M02", None, "", "psa_fixture"),
    ]
    fx = tmp_path / "fx.csv"
    fx.write_text("rate_date,rate\n2023-01-01,56.18\n2023-02-01,\n2023-03-01,broken\n")
    rows = read_fx_seed(spark, str(fx)).orderBy("rate_date").collect()
    assert [tuple(r) for r in rows] == [
        ("2023-01-01", "USD/PHP", 56.18, "bsp_fixture"),
        ("2023-02-01", "USD/PHP", None, "bsp_fixture"),
    ]


def test_fallback_only_for_an_empty_primary(spark):
    filled = spark.createDataFrame([(1,)], "x int")
    other = spark.createDataFrame([(2,), (3,)], "x int")
    assert [r.x for r in primary_or_fallback(filled, other).collect()] == [1]
    assert sorted(r.x for r in primary_or_fallback(filled.filter("x > 9"), other).collect()) == [2, 3]


def test_policy_date_type(spark):
    html = "<table><tr><td>June 20, 2024</td><td>6.5</td></tr></table>"
    row = policy_records(spark.createDataFrame([(html,)], "html string"), "html").first()
    assert date.fromisoformat(row.decision_date) == date(2024, 6, 20)


def test_every_reference_is_decoded_once(spark):
    cases = {
        "&#00000065;": "A", "&eacute;&Auml;": "éÄ", "&#9999999;": "\ufffd", "&#xD800;": "\ufffd", "&#0;": "\ufffd",
        "&#99999999999999;": "\ufffd", "&#38;lt;": "&lt;", "&amp;amp;": "&amp;", "&nosuch;&": "&nosuch;&",
        "a&lt;b&gt;c": "a<b>c", "&#x1F600;": "\U0001f600",
    }
    frame = spark.createDataFrame([(k, v) for k, v in cases.items()], "text string, expected string")
    for row in frame.withColumn("got", decode_entities(F.col("text"))).collect():
        assert row.got == row.expected, row.text


def test_rows_around_a_nested_table_stay(spark):
    html = """<table><tr><td>2011</td><td>1</td></tr><tr><td><table><tr><td>2013</td><td>3</td></tr></table></td></tr>
    <tr><td>2012</td><td>2</td></tr></table><table><tr><td>2014</td><td>4</td></tr></table>"""
    rows = fx_records(spark.createDataFrame([(html,)], "html string"), "html").collect()
    assert sorted((r.rate_date, r.rate) for r in rows) == [("2011-01-01", 1.0), ("2012-01-01", 2.0), ("2013-01-01", 3.0)]


def test_csv_columns_are_bound_by_name_in_every_file(spark, tmp_path):
    folder = tmp_path / "fx files"
    folder.mkdir()
    (folder / "a.csv").write_text("rate_date,currency_pair,rate,source\n2023-01-01,USD/PHP,56.1,s\n")
    (folder / "b.csv").write_text("rate,source,currency_pair,rate_date\n56.2,t,EUR/PHP,2023-02-01\nbad,t,x,2023-04-01\n")
    (folder / "c.csv").write_text("rate_date,rate\n2023-03-01,56.3\n")
    rows = read_fx_seed(spark, str(folder)).orderBy("rate_date").collect()
    assert [tuple(r) for r in rows] == [
        ("2023-01-01", "USD/PHP", 56.1, "s"), ("2023-02-01", "EUR/PHP", 56.2, "t"), ("2023-03-01", "USD/PHP", 56.3, "bsp_fixture"),
    ]
    cpi = tmp_path / "cpi.csv"
    cpi.write_text("period,value,series_code\n2023M01,abc,CPI_ALL_ITEMS\n2023M02,7,CPI_ALL_ITEMS\n")
    assert [r.value for r in read_cpi_seed(spark, str(cpi)).orderBy("period").collect()] == [None, 7.0]


def test_json_stat_with_id_size_and_role(spark):
    dims = {"Geo": {"category": {"label": {"p": "PH"}}}, "Time": {"category": {"index": {"b": 1, "a": 0}, "label": {"b": "2024M02", "a": "2024M01"}}}}
    inside = {"dataset": {"value": [1, 2], "dimension": {"id": ["Geo", "Time"], "size": [1, 2], "role": {"time": ["Time"]}, **dims}}}
    bare = {"id": ["Time", "Geo"], "size": [2, 1], "value": [5], "dimension": {"Time": dims["Time"], "Geo": {"category": {"index": ["p"]}}}}
    got = _decode(spark, json.dumps(inside), json.dumps(bare))
    assert got == [(0, 0, "2024M01", 1.0), (0, 1, "2024M02", 2.0), (1, 0, "p", 5.0)]
    frame = spark.createDataFrame([(1, json.dumps(inside)), (2, "nonsense"), (3, "{}"), (4, None)], "id int, doc string")
    assert sorted(r.id for r in rejected_cubes(frame, "doc", "id").collect()) == [2, 3, 4]


def _three_dimensions(value):
    dims = {
        "A": {"category": {"index": ["x", "y"]}},
        "B": {"category": {"index": {"q": 1, "p": 0, "r": 2}, "label": {"p": "P", "q": "Q", "r": "R"}}},
        "T": {"category": {"label": {"1": "Jan", "2": "Feb"}}},
    }
    return json.dumps({"id": ["A", "B", "T"], "size": [2, 3, 2], "dimension": dims, "value": value})


def test_json_stat_cells_of_any_number_of_dimensions(spark):
    listed = [float(i) for i in range(12)]
    listed[5], listed[7] = None, ":"
    sparse = {"0": 5, "1": 6, "11": 7.5, "12": 8, "-1": 9, "x": 1, "4": None, "3": "n/a"}
    frame = spark.createDataFrame(
        [(0, _three_dimensions(listed)), (1, _three_dimensions(sparse)), (2, "{}"), (3, None), (4, _three_dimensions({}))],
        "id int, doc string",
    )
    rows = decode_cells(frame, "doc", ["id"]).collect()
    names = [("x", "y"), ("P", "Q", "R"), ("Jan", "Feb")]
    place = {i: (names[0][i // 6], names[1][i // 2 % 3], names[2][i % 2]) for i in range(12)}
    want = [(0, i, *place[i], float(i)) for i in range(12) if i not in (5, 7)]
    want += [(1, i, *place[i], v) for i, v in ((0, 5.0), (1, 6.0), (11, 7.5))]
    assert sorted((r.id, r.position, *(r.labels[n] for n in "ABT"), r.value) for r in rows) == want
    assert {r.codes["B"] for r in rows if r.labels["B"] == "Q"} == {"q"}


def test_json_stat_other_members_than_the_first(spark):
    sparse = {"0": 5, "1": 6, "8": 7, "9": 8}
    frame = spark.createDataFrame(
        [(0, _three_dimensions([float(i) for i in range(12)])), (1, _three_dimensions(sparse))], "id int, doc string"
    )

    def line(**where):
        rows = decode_json_stat(frame, "doc", ["id"], where=where).collect()
        return sorted((r.id, r.position, r.label, r.value) for r in rows)

    assert line() == [(0, 0, "Jan", 0.0), (0, 1, "Feb", 1.0), (1, 0, "Jan", 5.0), (1, 1, "Feb", 6.0)]
    assert line(A="y", B="Q") == [(0, 0, "Jan", 8.0), (0, 1, "Feb", 9.0), (1, 0, "Jan", 7.0), (1, 1, "Feb", 8.0)]
    assert line(B="r") == [(0, 0, "Jan", 4.0), (0, 1, "Feb", 5.0)]
    assert line(B="none of them") == [] and line(Z="x") == []


def test_json_stat_parses_once(spark):
    frame = spark.createDataFrame([(0, "{}")], "id int, doc string")
    for df in (rejected_cubes(frame, "doc", "id"), decode_json_stat(frame, "doc", ["id"]), decode_cells(frame, "doc", ["id"])):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") <= 10, plan.count("from_json")


def _rows(spark, *pages):
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "id int, html string")
    return [(r.id, r.row_index, r.cells) for r in extract_rows(frame, "html", ["id"]).orderBy("id", "row_index").collect()]


def test_cells_that_span_rows_and_columns(spark):
    page = """<table>
    <tr><td rowspan=3>A</td><td colspan="2">B</td></tr>
    <tr><td>c</td><td rowspan='2'> d </td></tr>
    <tr><td>e</td></tr>
    <tr><td>f</td><td rowspan=0>g</td></tr>
    <tr></tr>
    <tr><td>h</td><td>i</td><td colspan=0>j</td></tr>
    <tr><td>k</tr></table>"""
    assert _rows(spark, page) == [
        (0, 0, ["A", "B", "B"]),
        (0, 1, ["A", "c", "d"]),
        (0, 2, ["A", "e", "d"]),
        (0, 3, ["f", "g"]),
        (0, 5, ["h", "g", "i", "j"]),
        (0, 6, ["k", "g"]),
    ]


def test_an_open_cell_beyond_a_short_row_leaves_a_gap(spark):
    page = "<table><tr><td>a<td>b<td rowspan=2>c</tr><tr><td>d</tr></table>"
    assert _rows(spark, page) == [(0, 0, ["a", "b", "c"]), (0, 1, ["d", "", "c"])]


def test_a_year_over_two_rows_stays_the_year(spark):
    page = "<table><tr><td rowspan=2>2043</td><td>56.1</td></tr><tr><td>2044</td></tr></table>"
    frame = spark.createDataFrame([(page,)], "html string")
    rows = fx_records(frame, "html", 2000).collect()
    assert sorted((r.rate_date, r.rate) for r in rows) == [("2043-01-01", 56.1), ("2043-01-01", 2044.0)]


def test_references_are_text_of_their_cell(spark):
    page = "<table><tr><td>a&#29;td&#29;b</td><td>x&#28;R2&#28;y</td><td>&lt;td&gt;</td></tr></table>"
    assert _rows(spark, page) == [(0, 0, ["a\x1dtd\x1db", "x\x1cR2\x1cy", "<td>"])]


def test_references_without_a_semicolon(spark, one):
    for text, want in {
        "&copy 2024": "\u00a9 2024",
        "&copyright;": "\u00a9right;",
        "&notin;": "\u2209",
        "&notit;": "\u00acit;",
        "&#169 x": "\u00a9 x",
        "&#xA9g": "\u00a9g",
        "&amp;lt;": "&lt;",
        "&unknown; & &x": "&unknown; & &x",
        "AT&T": "AT&T",
    }.items():
        assert one(decode_entities, text) == want, text


def test_deeply_nested_table(spark):
    page = "<table>" + "<tr><td>x<table>" * 200 + "<tr><td>in" + "</table>" * 200 + "<tr><td>out</table><table><tr><td>no"
    cells = [cells for _, _, cells in _rows(spark, page)]
    assert cells[-2:] == [["in"], ["out"]] and len(cells) == 202
