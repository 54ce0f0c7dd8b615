import datetime
import random
from decimal import Decimal

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridgepole.operators.fixed_width import format_lines, parse_lines, parse_lines_inferred
from ridgepole.operators.layout import Field, Layout, column_spans, describe_fields, infer_layout, usable_fields
from ridgepole.sources.tables import read_layout
from ridgepole.sources.text_lines import read_lines


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_positions_skip_the_separator():
    layout = Layout.of([("a", 1), ("b", 7), ("c", 2)])
    assert [(f.start, f.width) for f in layout.fields] == [(0, 1), (2, 7), (10, 2)]
    assert Layout.of([("a", 3), ("b", 4)], separator_width=0).fields[1].start == 3


def test_names_become_unique():
    layout = Layout.of([("a", 1), (" a ", 1), ("a_2", 1), ("", 1), (None, 1), ("a", 1), ("  ", 1)])
    assert layout.names == ["a", "a_2", "a_2_2", "unnamed", "None", "a_3", "unnamed_2"]


def test_layout_errors():
    with pytest.raises(ValueError):
        Layout.of([("a", 1)], separator_width=-1)
    with pytest.raises(ValueError):
        Layout.of([])
    with pytest.raises(ValueError):
        Layout.of([("a", 1)]).renamed(["x", "y"])


def test_parse(spark):
    layout = Layout.of([("code", 2), ("amount", 5), ("name", 4)]).typed({"amount": "bigint"})
    df = parse_lines(lines(spark, "06    12 Ann ", "", "   ", "07", "08 x     NA", "09\t   34\tBo"), layout)
    assert rows(df) == [
        ("06", 12, "Ann"),
        ("07", None, None),
        ("08", None, None),
        ("09", 34, "Bo"),
    ]


def test_missing_tokens_are_optional(spark):
    layout = Layout.of([("name", 4)])
    assert rows(parse_lines(lines(spark, "NA"), layout, missing=())) == [("NA",)]
    assert rows(parse_lines(lines(spark, "NA"), layout)) == [(None,)]


def test_inferred_types(spark):
    layout = Layout.of([("a", 3), ("b", 4), ("c", 3), ("d", 2)])
    df = parse_lines_inferred(lines(spark, "006 1.5  x1", "    2    7 ", "12  3    9 "), layout)
    assert df.dtypes == [("a", "bigint"), ("b", "double"), ("c", "string"), ("d", "double")]
    assert rows(df) == [(None, 2.0, "7", None), (12, 3.0, "9", None), (6, 1.5, "x1", None)]


def test_latin1_file_with_all_line_ends(spark, tmp_path):
    path = tmp_path / "x.txt"
    path.write_bytes("é1 a\r\nü2 b\n\nß3 c".encode("latin-1"))
    layout = Layout.of([("k", 2), ("v", 1)])
    assert rows(parse_lines(read_lines(spark, str(path)), layout)) == [("ß3", "c"), ("é1", "a"), ("ü2", "b")]
    assert rows(parse_lines(read_lines(spark, str(path)), layout).select("v")) == [("a",), ("b",), ("c",)]
    with pytest.raises(ValueError):
        read_lines(spark, str(path), "utf-16")
    path.write_text("é1 ü\n", encoding="utf-8")
    assert rows(parse_lines(read_lines(spark, str(path), "utf-8"), layout)) == [("é1", "ü")]


@pytest.mark.parametrize("as_bytes", [True, False])
def test_values_of_every_type(spark, as_bytes):
    layout = Layout.of([("i", 4), ("d", 4), ("m", 6), ("t", 10), ("s", 4)]).typed(
        {"i": "bigint", "d": "double", "m": "decimal(5,2)", "t": "date"}
    )
    given = lines(
        spark, " 1\t  2.5    1.25 2020-01-02 a b ", "NA   NaN  n/a    NA         null", "x    nan  1e9    2020-13-01 \tz\t",
        "1.5  1e3  999.999", "     inf",
    )
    if as_bytes:
        given = given.select(F.encode("value", "ISO-8859-1").alias("value"))
    day = datetime.date(2020, 1, 2)
    assert rows(parse_lines(given, layout)) == rows(
        spark.createDataFrame(
            [(1, 2.5, Decimal("1.25"), day, "a b"), (None,) * 5, (None, None, None, None, "z"),
             (None, 1000.0, Decimal("999.99"), None, None), (None, float("inf"), None, None, None)],
            "i bigint, d double, m decimal(5,2), t date, s string",
        )
    )
    # a token that reads as a value needs the token test
    assert parse_lines(given, layout, missing=("2.5",)).where("d = 2.5").count() == 0
    assert parse_lines(given, layout, missing=()).where("isnan(d)").count() == 2


def test_too_wide_value_fails(spark):
    with pytest.raises(Exception, match="wider"):
        format_lines(spark.createDataFrame([("abc",)], "a string"), Layout.of([("a", 2)])).collect()


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 10**9), st.one_of(st.none(), st.text("abcäé.", min_size=1, max_size=6))), min_size=1, max_size=8))
def test_round_trip(spark, data):
    layout = Layout.of([("n", 10), ("t", 6)]).typed({"n": "bigint"})
    df = spark.createDataFrame(data, "n bigint, t string")
    assert rows(parse_lines(format_lines(df, layout), layout)) == rows(df)
    assert rows(parse_lines(format_lines(df, layout, as_bytes=True), layout)) == rows(df)


def test_dictionary_file(spark, tmp_path):
    path = tmp_path / "2023_x_combined.csv"
    path.write_text(
        "Field #,Field Width,Field Name,Values,Description / Comments,NameNum\n"
        '2,1,Flag,"1 = A\n2 = B","says ""hi"", twice",\n'
        '1,7,"Record\nNumber",,,\n'
        "3,n/a,Ghost,,,\n"
        "4,2,Flag,,,\n"
    )
    layout = read_layout(spark, str(path))
    # file order, not field number order
    assert [(f.name, f.start, f.width) for f in layout.fields] == [("Flag", 0, 1), ("Record\nNumber", 2, 7), ("Flag_2", 10, 2)]
    spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(path)).coalesce(1).write.parquet(
        str(tmp_path / "d.parquet")
    )
    assert read_layout(spark, str(tmp_path / "d.parquet")) == layout
    with pytest.raises(ValueError):
        read_layout(spark, str(path), fmt="xlsx")
    with pytest.raises(ValueError):
        read_layout(spark, str(path), name="Label")


def test_describe_fields_across_blocks(spark):
    data = [("d1" if i % 3 else "d2", i, "x" if i % 2 else f"n{i % 5}", (i * 7) % 9 + 1) for i in range(1, 200)]
    df = spark.createDataFrame(data, "doc string, ord bigint, `Field Name` string, `Field Width` int")
    got = describe_fields(usable_fields(df, keep=("doc", "ord")), ["doc"], "ord", blocks=8)
    want, cursor, seen = [], {}, {}
    for doc, ord_, name, width in data:
        start = cursor.get(doc, 0)
        cursor[doc] = start + width + 1
        seen[doc, name] = seen.get((doc, name), 0) + 1
        unique = name if seen[doc, name] == 1 else f"{name}_{seen[doc, name]}"
        want.append((doc, ord_, unique, width, start))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_spans_longer_than_a_chunk(spark):
    text = ["ab" + " " * 70 + "xyz  q", " b" + " " * 70 + "x", "", " " * 130 + "\tz"]
    used = sorted({i for t in text for i, c in enumerate(t) if c not in " \t"})
    spans = rows(column_spans(lines(spark, *text)))
    assert sorted(p for s, w in spans for p in range(s, s + w)) == used
    assert sorted(spans) == [(0, 2), (72, 3), (77, 1), (131, 1)]
    as_bytes = lines(spark, *text).select(F.encode("value", "ISO-8859-1").alias("value"))
    assert sorted(rows(column_spans(as_bytes))) == sorted(spans)
    layout = infer_layout(lines(spark, *text), ["a", "b", "c", "d"])
    assert rows(parse_lines(lines(spark, text[0]), layout)) == [("ab", "xyz", "q", None)]


def test_lines_without_a_field_are_dropped(spark):
    """What stands between the fields, or behind them, makes no record."""
    layout = Layout.of([("a", 3), ("b", 3)])
    text = ["   |   ", "       z", "   | x ", "x", "    \u00f1", " \t", "      y", "\u4e2d  |", "  \r", "     |  "]
    want = [("x", None), (None, "\u00f1"), (None, "x"), (None, "y"), (None, "|"), ("\u4e2d", None)]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, parse_lines(lines(spark, *text), layout).collect()), key=key) == sorted(want, key=key)
    latin = [t for t in text if "\u4e2d" not in t]
    as_bytes = lines(spark, *latin).select(F.encode("value", "ISO-8859-1").alias("value"))
    assert sorted(map(tuple, parse_lines(as_bytes, layout).collect()), key=key) == sorted(want[:-1], key=key)
    late = Layout((Field("k", 4, 2), Field("z", 9, 0)))
    assert rows(parse_lines(lines(spark, "abcd", "abcdef", "    e"), late)) == [("e", None), ("ef", None)]


def test_spans_of_many_lines_and_odd_ones(spark):
    """Random lines by every position, in one task and in many, and batches of empty lines."""
    rng = random.Random(8)
    text = ["".join(rng.choice("  \t xé中") for _ in range(rng.randint(0, 40))) for _ in range(300)] + ["", " "] * 5
    used = sorted({i for t in text for i, c in enumerate(t) if c not in " \t"})
    for parts in (1, 7):
        spans = rows(column_spans(lines(spark, *text).repartition(parts)))
        assert sorted(p for s, w in spans for p in range(s, s + w)) == used
    assert column_spans(lines(spark, "", " ")).count() == 0
    assert column_spans(lines(spark, "x").where("false")).count() == 0


def test_only_selected_fields_are_cut(spark):
    layout = Layout.of([(f"f{i}", 2) for i in range(20)])
    plan = parse_lines(lines(spark, "x"), layout).select("f3")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("substring") == 1


def test_filter_on_keep_columns(spark):
    df = spark.createDataFrame([("f", "ab 1")], "src string, value string")
    assert rows(parse_lines(df, Layout.of([("a", 2), ("b", 1)]), keep=("src",)).where(F.col("b") == "1")) == [("f", "ab", "1")]


def test_lines_are_made_once(spark):
    """A filter on lines stays above what makes them, and a record's fields are not fused into one method that runs interpreted."""
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(key)
    layout = Layout.of([("a", 3), ("b", 4)])
    df = spark.range(5).selectExpr("cast(id as string) as a", "cast(id + 7 as string) as b")
    parsed = parse_lines(format_lines(df, layout, as_bytes=True), layout)
    assert spark.conf.get(key) == "8000"
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rpad(") == 2  # each field once
    assert rows(parsed) == rows(df)
