import datetime
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgepole.functions import dates, paths, text, years
from ridgepole.operators import columns as cols
from ridgepole.operators import expand
from ridgepole.operators.dedupe import keep_first, keep_last
from ridgepole.operators.dictionary import combine_tables
from ridgepole.operators.expand import expand_numbers, explode_range
from ridgepole.operators.gaps import missing_numbers, missing_preview, missing_ranges
from ridgepole.operators.halves import null_key_counts, outer_join_halves
from ridgepole.operators.keys import fill_from_yearly, tract_key, tract_key_by_vintage
from ridgepole.operators.prune import recent_subset
from ridgepole.operators.resolve import resolve_dictionaries
from ridgepole.operators.rules import (
    NullIfIn,
    NumberAfterPrefix,
    Scale,
    ScaleToWhole,
    apply_rules,
    before,
)
from ridgepole.operators.running import Total, rank_blocks, running_totals
from ridgepole.operators.union import common_type, union_relaxed, union_strict


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column(F.col("c"))).first()[0]


# --- unions ---


def test_common_type():
    i, b, s, d, n = T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType(), T.NullType()
    assert common_type([i, b]) == b
    assert common_type([i, d, n]) == d
    assert common_type([b, s]) == s
    assert common_type([n]) == s
    assert common_type([T.BooleanType(), i]) == i
    assert common_type([T.DateType(), T.TimestampType()]) == T.TimestampType()
    assert common_type([T.DecimalType(10, 2), b]) == T.DecimalType(22, 2)
    assert common_type([T.DecimalType(38, 0), T.DecimalType(38, 18)]) == s  # 56 digits
    with pytest.raises(TypeError):
        common_type([T.DateType(), i])


def test_relaxed_union_keeps_text(spark):
    a = spark.createDataFrame([(1, 5)], "k int, v bigint")
    b = spark.createDataFrame([("n/a", 2)], "v string, k bigint")
    c = spark.createDataFrame([(True,)], "K boolean")
    df = union_relaxed([a, b, c])
    assert df.dtypes == [("k", "bigint"), ("v", "string")]
    assert rows(df) == [(1, None), (1, "5"), (2, "n/a")]


def test_relaxed_union_pushes_filters(spark, tmp_path):
    for y in (1, 2):
        spark.range(5).write.parquet(f"{tmp_path}/{y}")
    df = union_relaxed([cols.tag(spark.read.parquet(f"{tmp_path}/{y}"), Year=y) for y in (1, 2)])
    plan = df.where("Year = 2 and id > 3")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "GreaterThan(id,3)" in plan


def test_strict_union_refuses_drift(spark):
    a, b = spark.range(1), spark.range(1).select(F.col("id").cast("int").alias("id"))
    with pytest.raises(ValueError):
        union_strict([a, b])
    with pytest.raises(ValueError):
        union_strict([])
    assert union_strict([a, a]).count() == 2


# --- rules ---


def test_rules_run_in_order_in_one_stage(spark):
    df = spark.createDataFrame([(2018, 0.5, 2), (2019, 50.0, 2), (None, 1.0, 1)], "Year int, p double, q int")
    out = apply_rules(df, [Scale(("p", "absent"), 100, before("Year", 2019)), NullIfIn(("p",), [50])], drop=("Year",))
    assert rows(out) == [(None, 2), (None, 2), (1.0, 1)]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.dtypes == [("p", "double"), ("q", "int")]


def test_year_rule_needs_the_year(spark):
    df = spark.createDataFrame([(0.5,)], "p double")
    with pytest.raises(ValueError, match="Year"):
        apply_rules(df, [Scale(("p",), 100, before("Year", 2019))])
    # without the scaled column the year is not needed either
    assert apply_rules(df, [Scale(("other",), 100, before("Year", 2019))]).count() == 1


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_property_type_fails(spark, ansi):
    was = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("PT03",), (None,)], "c string")
        assert rows(apply_rules(df, [NumberAfterPrefix(("c",), "PT")])) == [(None,), (3,)]
        with pytest.raises(Exception, match="whole number"):
            apply_rules(spark.createDataFrame([("PTx",)], "c string"), [NumberAfterPrefix(("c",), "PT")]).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", was)


def test_tract_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0.025,), (0.035,), (27.01,), (None,)], "c double")
    got = [r[0] for r in apply_rules(df, [ScaleToWhole(("c",), 100)]).collect()]
    assert got == [round(2.5), round(3.5000000000000004), 2701.0, None]


# --- dates ---


def test_dates(spark):
    date = datetime.date
    assert one(spark, lambda c: dates.lenient_date(c, "M/d/yyyy"), "1/2/2019") == date(2019, 1, 2)
    assert one(spark, lambda c: dates.lenient_date(c, "M/d/yyyy"), "2019-01-02") is None
    assert one(spark, lambda c: dates.lenient_date(c, "M/d/yyyy"), "1/2/2300") is None
    assert one(spark, lambda c: dates.lenient_date(c, "M/d/yyyy"), "1/2/1600") is None
    assert one(spark, lambda c: dates.strict_date(c, "M/d/yy"), None) is None
    with pytest.raises(Exception, match="date"):
        one(spark, lambda c: dates.strict_date(c, "M/d/yy"), "soon")
    read = lambda c: dates.not_after(dates.two_digit_year(dates.strict_date(c, "M/d/yy")), F.lit(date(2024, 6, 1)))
    assert one(spark, read, "02/29/32") == date(1932, 2, 29)
    assert one(spark, read, "5/1/24") == date(2024, 5, 1)
    assert one(spark, read, "7/1/24") == date(1924, 7, 1)
    assert one(spark, read, "7/1/75") == date(1975, 7, 1)
    # 2000-02-29 a century earlier is the 28th
    late = lambda c: dates.not_after(dates.two_digit_year(dates.strict_date(c, "M/d/yy")), F.lit(date(1999, 6, 1)))
    assert one(spark, late, "2/29/00") == date(1900, 2, 28)


# --- names ---


@pytest.mark.parametrize(
    "name, year",
    [
        ("fnma_sf2019c_loans.txt", 2019),
        ("2008_2010_PUDB.zip", 2010),
        ("x20190.txt", None),
        ("a1989b2036", None),
        ("id12019-2001", 2001),
        ("", None),
    ],
)
def test_year_in_name(spark, name, year):
    assert one(spark, years.year_in_name, name) == year


@pytest.mark.parametrize(
    "name, ext, stem",
    [
        ("a/b.TXT", ".txt", "b"),
        ("a/.profile", "", ".profile"),
        ("a.tar.gz", ".gz", "a.tar"),
        ("noext", "", "noext"),
        ("x/y..b", ".b", "y."),
    ],
)
def test_path_parts(spark, name, ext, stem):
    assert one(spark, paths.extension, name) == ext
    assert one(spark, paths.stem, name) == stem


def test_urls_resolve_like_the_standard(spark):
    from urllib.parse import urljoin, urlparse

    base = "https://h.example.org/a/b/c.html?q=1#f"
    refs = ["x.zip", "/x.zip", "../x.zip", "../../../x.zip", "./d/./x.zip?y=/z", "//o.example/x.zip", "http://e.example/x.zip",
            "?q=2", "#top", "d/..", "mailto:a@b", "d/e/../x.zip#s", "/a/./b/../x"]
    df = spark.createDataFrame([(base, r) for r in refs], "b string, r string")
    got = {r.r: (r.u, r.p) for r in df.select("r", paths.absolute_url(F.col("b"), F.col("r")).alias("u"),
                                               paths.url_path(paths.absolute_url(F.col("b"), F.col("r"))).alias("p")).collect()}
    for r in refs:
        want = urljoin(base, r)
        assert got[r][0] == want, r
        assert got[r][1] == urlparse(want).path, r


def test_zero_fill_never_cuts(spark):
    assert one(spark, lambda c: text.zero_fill(c, 3), "12345") == "12345"
    assert one(spark, lambda c: text.zero_fill(c, 3), "7") == "007"


def test_number_tests(spark):
    whole = {"7": True, "-7": True, "+7": True, "7.0": False, "x": False, "9" * 19: False, "9223372036854775807": True, "1D": False}
    number = {"7": True, "7.5": True, ".5": True, "1e3": True, "x": False, "1D": False, "2f": False, "inf": True, "-Inf": True, "1 2": False}
    for given, want in whole.items():
        assert one(spark, text.looks_whole, given) is want, given
    for given, want in number.items():
        assert one(spark, text.looks_numeric, given) is want, given
    assert one(spark, text.number_or_null, "9.5") == 9.5 and one(spark, text.number_or_null, "n/a") is None


# --- headers ---


def test_header_operators(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a_b ` int, `x\ny` int, `Unnamed: 3` int")
    assert cols.respell(df, text.upper_words).columns[0] == "A B"
    assert cols.respell(df, text.one_line).columns[1] == "x y"
    assert cols.drop_unnamed(df).columns == ["a_b ", "x\ny"]
    assert cols.rename_by_map(df, {"x\ny": "z", "none": "q"}).columns == ["a_b ", "z", "Unnamed: 3"]
    assert cols.drop_present(df, ["x\ny", "none"]).columns == ["a_b ", "Unnamed: 3"]
    assert cols.find_column(df, ["nope", "X  Y"]) == "x\ny"
    assert rows(cols.tag(df, **{"x\ny": 9}).select("`x\ny`")) == [(9,)]


# --- keys ---


def test_tract_keys(spark):
    df = spark.createDataFrame([(2021, 6, 37, 2701.0, 1), (2022, 6, 37, 2701.0, 1), (None, 6, 37, 2701.0, 1), (2022, 6, 37, 2701.0, None)],
                               "y int, s int, c int, t10 double, t20 int")
    key = tract_key_by_vintage(F.col("y"), [F.col("s"), F.col("c"), F.col("t10")], [F.col("s"), F.col("c"), F.col("t20")])
    assert [r[0] for r in df.select(key).collect()] == ["06037002701", "06037000001", None, None]
    assert df.select(tract_key(F.lit(123), F.lit(0), F.lit(0))).first()[0] == "123000000000"


def test_fill_from_yearly(spark):
    df = spark.createDataFrame([(1, None, 2, 3), (2, None, None, None)], "k int, `2012 I` int, `2013 I` int, `2015 I` int")
    out = fill_from_yearly(df, "I", [f"{y} I" for y in range(2012, 2017)])
    assert out.columns == ["k", "I"] and rows(out) == [(1, 2), (2, None)]
    assert fill_from_yearly(df, "J", ["2012 J"]).dtypes[-1] == ("J", "double")
    mixed = spark.createDataFrame([(1, 5, None), (2, None, 7), (3, 8, 9)], "k int, I int, `2012 I` int")
    assert rows(fill_from_yearly(mixed, "I", ["2012 I"]).select("k", "I")) == [(1, 5), (2, 7), (3, 9)]
    assert rows(fill_from_yearly(mixed, "I", ["1999 I"]).select("k", "I")) == [(1, 5), (2, None), (3, 8)]


# --- first and last rows, gaps, expansion ---


def test_keep_first_and_last(spark):
    data = [("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z"), (None, 1, "n")]
    df = spark.createDataFrame(data, "k string, o int, v string")
    assert rows(keep_first(df, ["k"], ["o"])) == [(None, 1, "n"), ("a", 1, "y"), ("b", 3, "z")]
    assert rows(keep_last(df, ["k"], ["o"])) == [(None, 1, "n"), ("a", 2, "x"), ("b", 3, "z")]


@pytest.mark.parametrize("blocks", [1, 4, 40])
def test_gaps_against_brute_force(spark, blocks):
    rng = random.Random(5)
    data = [(rng.choice("ab"), rng.choice([None, rng.randint(-40, 40), rng.randint(1000, 1010)])) for _ in range(60)]
    df = spark.createDataFrame(data, "k string, n bigint")
    want = []
    for k in "ab":
        have = {n for key, n in data if key == k and n is not None}
        want += [(k, n) for n in range(min(have), max(have) + 1) if n not in have]
    ranges = missing_ranges(df, ["k"], "n", blocks)
    assert sorted(map(tuple, missing_numbers(ranges, ["k"]).collect())) == sorted(want)
    for r in missing_preview(ranges, ["k"]).collect():
        mine = [n for k, n in want if k == r["k"]]
        assert r["missing"] == mine[:20] and r["missing_count"] == len(mine)


def test_gap_preview_without_keys(spark):
    df = spark.createDataFrame([(1,), (4,), (100,)], "n bigint")
    got = missing_preview(missing_ranges(df, [], "n"), []).first()
    assert got["missing"] == [2, 3, *range(5, 23)] and got["missing_count"] == 97
    assert missing_numbers(missing_ranges(df, [], "n"), []).count() == 97


def test_gaps_of_huge_numbers(spark):
    df = spark.createDataFrame([("a", 2**60), ("a", 2**60 + 3)], "k string, n bigint")
    assert [r[1] for r in missing_numbers(missing_ranges(df, ["k"], "n"), ["k"]).orderBy("missing").collect()] == [2**60 + 1, 2**60 + 2]


def test_blocks_hold_equal_shares_of_numbers_far_apart(spark):
    """Half of all rows under one key, 70,000 apart: neither window may hold much more than a task's share."""
    n = 60_000
    far = spark.range(n).select(F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"), (F.col("id") * 70_000).alias("v"))
    cut = rank_blocks(far, ["k"], "v", blocks=16)
    sizes = [r["count"] for r in cut.groupBy("_block").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * n / 16
    groups = cut.groupBy("k", "_block").agg(F.count("*").alias("rows")).agg(F.max("rows"), F.count("*")).first()
    assert groups[0] < 3 * n / 16 and groups[1] < 26 + 16  # rows of the first window; all rows of the second, over all keys
    # within a key, blocks and numbers go up together
    spans = cut.where("k = 0").groupBy("_block").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("_block").collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(spans, spans[1:])) and len(spans) >= 7
    ranges = missing_ranges(far, ["k"], "v", blocks=16)
    assert ranges.count() == n - 26
    assert ranges.where("k = 0").agg(F.sum(F.col("gap_end") - F.col("gap_start") + 1)).first()[0] == (n // 2 - 1) * 139_999


def test_running_totals_across_blocks_and_null_keys(spark):
    data = [(None if i % 5 == 0 else "a", i * 90_001, i % 7) for i in range(500)]
    df = spark.createDataFrame(data, "k string, o bigint, v int")
    got = running_totals(df, "o", [Total(["k"], F.col("v"), "upto"), Total(["k"], F.lit(1), "before", inclusive=False)], blocks=9)
    upto, count, want = {}, {}, []
    for k, o, v in data:
        upto[k] = upto.get(k, 0) + v
        want.append((k, o, v, upto[k], count.get(k, 0)))
        count[k] = count.get(k, 0) + 1
    assert rows(got) == rows(spark.createDataFrame(want, "k string, o bigint, v int, a bigint, b bigint"))
    assert running_totals(df.where("false"), "o", [Total([], F.lit(1), "n")]).count() == 0


def test_explode_range_pieces(spark):
    df = spark.createDataFrame([(0, 200_000), (5, 3), (None, 1), (7, 7)], "s bigint, e bigint")
    out = explode_range(df, "s", "e", "n", spread=True)
    assert out.count() == 200_002 and out.select("n").distinct().count() == 200_001
    assert out.select(F.spark_partition_id()).distinct().count() > 1


def test_explode_range_in_two_levels(spark, monkeypatch):
    monkeypatch.setattr(expand, "PIECE", 4)
    df = spark.createDataFrame([(-5, 101), (3, 18)], "s bigint, e bigint")
    assert sorted(r["n"] for r in explode_range(df, "s", "e", "n").collect()) == sorted([*range(-5, 102), *range(3, 19)])


def test_expand_numbers(spark):
    data = [(1, "7", "Solo"), (2, "19–23", "Origin 1—5"), (3, "30, 32-33", "Pair 1-2"), (4, "n/a", "x"), (5, "9-8", "y"), (6, None, "z")]
    df = spark.createDataFrame(data, "r int, `FIELD_#` string, Name string")
    got = rows(expand_numbers(df, "FIELD_#", "Name").select("`Field #`", "Name", "r", "NameNum"))
    assert got == sorted(
        [(7, "Solo", 1, None), *[(18 + i, f"Origin {i}", 2, i) for i in range(1, 6)], (30, "Pair 1-2", 3, None), (32, "Pair 1", 3, 1), (33, "Pair 2", 3, 2)],
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def test_combine_tables(spark):
    first = spark.createDataFrame([("d", 1, 1, 1, "2, 1-2", "A"), ("d", 1, 1, 2, "1", "B")], "doc string, page int, table_no int, row_no int, `field #` string, `Variable Name` string")
    again = first.withColumn("page", F.lit(2))
    other = spark.createDataFrame([("d", 1, 2, 1, "x")], "doc string, page int, table_no int, row_no int, code string")
    out = combine_tables([again, other, first])
    assert rows(out.select("`Field #`", "page", "row_no", "`Variable Name`")) == [(1, 1, 1, "A"), (2, 1, 1, "A")]
    with pytest.raises(ValueError):
        combine_tables([first, spark.createDataFrame([("d", 1, 1, 1, "1")], "doc string, page int, table_no int, row_no int, `Field #` string")])


# --- joins, pruning, resolution ---


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_outer_join_halves_against_brute_force(spark, broadcast):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        rng = random.Random(3)
        pick = lambda: (rng.choice([1, 2, None]), rng.choice([1, 2, 3, 4, None]))
        left = [(*pick(), i, i * 10) for i in range(25)]
        right = [(*pick(), i, f"r{i}") for i in range(20)]
        l_df = spark.createDataFrame(left, "a int, b int, v int, p int")
        r_df = spark.createDataFrame(right, "a int, b int, v int, q string")
        want = [(l[0], l[1], l[2], l[3], r[2], r[3]) for l in left for r in right if l[:2] == r[:2]]
        want += [(l[0], l[1], l[2], l[3], None, None) for l in left if l[:2] not in {r[:2] for r in right}]
        want += [(r[0], r[1], None, None, r[2], r[3]) for r in right if r[:2] not in {l[:2] for l in left}]
        out = outer_join_halves(l_df, r_df, ["a", "b"])
        assert out.columns == ["a", "b", "v_x", "p", "v_y", "q"]
        key = lambda r: str(r)
        assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_outer_join_shuffles_each_half_once(spark, tmp_path):
    spark.range(50).selectExpr("id % 7 as k", "id as v").write.parquet(str(tmp_path / "l"))
    spark.range(40).selectExpr("id % 5 as k", "id as w", "id as v").write.parquet(str(tmp_path / "r"))
    was = {n: spark.conf.get(n) for n in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = outer_join_halves(spark.read.parquet(str(tmp_path / "l")), spark.read.parquet(str(tmp_path / "r")), ["k"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ReusedExchange") == 2
        assert out.count() == sum(len([l for l in range(50) if l % 7 == k]) * 8 for k in range(5)) + sum(1 for l in range(50) if l % 7 >= 5)
    finally:
        for name, value in was.items():
            spark.conf.set(name, value)


def test_outer_join_with_null_keys_unmatched(spark):
    left = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (None, None, "c")], "k int, j int, v string")
    right = spark.createDataFrame([(1, None, "x"), (1, None, "y"), (1, 2, "z")], "k int, j int, w string")
    assert rows(outer_join_halves(left, right, ["k", "j"], match_nulls=False)) == rows(
        spark.createDataFrame(
            [(1, 2, "b", "z"), (1, None, "a", None), (None, None, "c", None), (1, None, None, "x"), (1, None, None, "y")], "k int, j int, v string, w string"
        )
    )
    assert rows(null_key_counts(left, right, ["k", "j"])) == [(False, True, 1, 2), (True, True, 1, 0)]


def test_outer_join_of_one_table_with_itself(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 6)], "a int, b int, v int")
    out = outer_join_halves(df.where("b = 1"), df, ["a", "b"])
    assert rows(out) == [(1, 1, 5, 5), (1, 2, None, 6)]


def test_recent_subset(spark):
    df = spark.createDataFrame([(2017, 1, 1, None), (2018, 1, None, None), (2019, None, 2, None)], "y int, old int, new int, never int")
    out = recent_subset(df, "y", 2018, 2019)
    assert out.columns == ["y", "new"] and rows(out) == [(2018, None), (2019, 2)]


def available(spark, *names):
    data = [(int(n[:4]), n.rsplit(".", 1)[0], n.rsplit(".", 1)[1], f"/d/{n}") for n in names]
    return spark.createDataFrame(data, "dictionary_year int, dictionary_name string, format string, dictionary_path string")


def resolved(spark, name, *offers, **options):
    files = spark.createDataFrame([(name,)], "file_name string")
    return resolve_dictionaries(files, available(spark, *offers), **options).first()["dictionary_path"]


SF_C = "2023_Single_Family_Census_Tract_File_C_combined"
UNIT = "2023_Multifamily_National_File_Unit_Class-Level_Data_File_B_combined"
PROPERTY = "2023_Multifamily_National_File_Property-Level_Data_File_B_combined"


def test_resolution_reads_the_files_once(spark, tmp_path):
    spark.createDataFrame([("fnma_sf2019c.txt",), ("none.txt",)], "file_name string").write.parquet(str(tmp_path / "files"))
    offered = [(2019, "2019_Single_Family_Census_Tract_File_C_combined", "csv", "/d.csv")]
    available = spark.createDataFrame(offered, "dictionary_year int, dictionary_name string, format string, dictionary_path string")
    found = resolve_dictionaries(spark.read.parquet(str(tmp_path / "files")), available)
    assert rows(found.select("file_name", "dictionary_path")) == [("fnma_sf2019c.txt", "/d.csv"), ("none.txt", None)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_resolution(spark):
    assert resolved(spark, "fnma_sf2023c_loans.txt", SF_C + ".csv", SF_C + ".parquet") == f"/d/{SF_C}.parquet"
    assert resolved(spark, "fnma_sf2023c_loans.txt", SF_C + ".csv", SF_C + ".parquet", prefer="csv") == f"/d/{SF_C}.csv"
    assert resolved(spark, "fnma_sf2023a_loans.txt", SF_C + ".csv") is None
    assert resolved(spark, "fnma_sf_2023.txt", SF_C + ".csv") == f"/d/{SF_C}.csv"
    assert resolved(spark, "fhlmc_mf2023b_units.txt", UNIT + ".csv", PROPERTY + ".parquet") == f"/d/{UNIT}.csv"
    assert resolved(spark, "fhlmc_mf2023b_units_loans.txt", UNIT + ".csv", PROPERTY + ".csv") == f"/d/{PROPERTY}.csv"
    assert resolved(spark, "fhlmc_mf2023b.txt", UNIT + ".csv") == f"/d/{UNIT}.csv"
    assert resolved(spark, "fnma_2023.txt", UNIT + ".csv") == f"/d/{UNIT}.csv"
    assert resolved(spark, "fnma_sfc.txt", SF_C + ".csv") is None
    short = "2011_Single_Family_Census_Tract_File_combined"
    assert resolved(spark, "fnma_sf2011c.txt", short + ".csv") == f"/d/{short}.csv"
    assert resolved(spark, "fnma_sf2011c.txt", short + ".csv", strict=True) is None
    with pytest.raises(ValueError):
        resolved(spark, "x", SF_C + ".csv", prefer="xml")
