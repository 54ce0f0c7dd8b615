"""End-to-end jobs over files in a temporary folder."""

import datetime
import gzip
import os
import zipfile

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from ridgepole import BankData, DataPaths, LoadOptions, LoanFiles, LoanLimits, Medallion, write_hive
from ridgepole.checks.jobs import plain_files, sorted_parts, zip_files
from ridgepole.operators.layout import Layout
from ridgepole.operators.prune import recent_subset
from ridgepole.plans import rule_tables
from ridgepole.sources import archives, files, footers, links, sinks, tables
from ridgepole.sources.tables import read_layout
from ridgepole.sources.text_lines import read_lines
from ridgepole.streaming.incremental import convert_new, parsed_stream
from ridgepole.streaming.mixed import convert_mixed

HEADER = "Field #,Field Width,Field Name,Values,Description / Comments,NameNum\n"


def put(path, content, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode(encoding))
    return path


def put_gzip(path, content):
    return put(path, gzip.compress(content.encode()))


@pytest.fixture
def release(tmp_path):
    """Two years, two enterprises, layouts that drift; one file without a dictionary."""
    for year, fields in ((2019, "1,1,Flag,,,\n2,3,State Code,,,\n3,4,Amount,,,\n"), (2020, "1,1,Flag,,,\n2,4,Amount,,,\n3,2,New,,,\n")):
        name = f"{year}_Single_Family_Census_Tract_File_C_combined.csv"
        put(tmp_path / f"dictionaries/{year}/{name}", HEADER + fields)
    put(tmp_path / "raw/2019/fnma_sf2019c_loans.txt", "1 006  100\n1 001     \n")
    put(tmp_path / "raw/2019/fhlmc_sf2019c_loans.TXT", "2 013 7.50\n\n2 ñ01    9\n", "latin-1")
    put(tmp_path / "raw/2020/fnma_sf2020c_loans.txt", "1  300 xy\n")
    put(tmp_path / "raw/2020/fnma_mf2020b_loans.txt", "1\n")
    put(tmp_path / "raw/2020/readme.md", "no")
    put(tmp_path / "raw/misc/fnma_sf2020c_loans.txt", "no")
    return DataPaths.under(str(tmp_path))


def test_convert_and_combine(spark, release):
    job = LoanFiles(spark, release)
    found = {r["file_name"]: r["dictionary_path"] for r in job.resolve_years().collect()}
    assert set(found) == {"fnma_sf2019c_loans.txt", "fhlmc_sf2019c_loans.TXT", "fnma_sf2020c_loans.txt", "fnma_mf2020b_loans.txt"}
    assert found["fnma_mf2020b_loans.txt"] is None

    done = {c.target.rsplit("/", 1)[1]: c.status for c in job.convert_all(infer=True)}
    assert done == {
        "fnma_sf2019c_loans.parquet": "written",
        "fhlmc_sf2019c_loans.parquet": "written",
        "fnma_sf2020c_loans.parquet": "written",
        "fnma_mf2020b_loans.parquet": "no dictionary",
    }
    one = spark.read.parquet(f"{release.clean}/2019/fhlmc_sf2019c_loans.parquet")
    assert one.dtypes == [("Flag", "bigint"), ("State Code", "string"), ("Amount", "double")]
    assert rows(one) == [(2, "013", 7.5), (2, "ñ01", 9.0)]

    # nothing is done twice, an unfinished output is done again
    assert [c.status for c in job.convert_all(infer=True)] == ["no dictionary"]
    os.remove(f"{release.clean}/2020/fnma_sf2020c_loans.parquet/_SUCCESS")
    assert sorted(c.status for c in job.convert_all(infer=True)) == ["no dictionary", "written"]
    assert job.convert_all(years_list=[2019]) == []

    assert job.clean_years() == [2019, 2020]
    path = job.combine_by_type("sf{year}c_loans", min_year=2019)
    assert path.endswith("/combined/sfYYYYc_loans_2019-2020_fhlmc-fnma.parquet")
    combined = spark.read.parquet(path)
    assert set(combined.columns) == {"Flag", "State Code", "Amount", "New", "Year", "Enterprise"}
    assert rows(combined.select("Year", "Enterprise", "`State Code`", "Amount", "New")) == [
        (2019, "fhlmc", "013", 7.5, None),
        (2019, "fhlmc", "ñ01", 9.0, None),
        (2019, "fnma", "1", None, None),
        (2019, "fnma", "6", 100.0, None),
        (2020, "fnma", None, 300.0, "xy"),
    ]
    text = job.combine_by_type("sf{year}c_loans", enterprises=["FNMA"], years_list=[2020], fmt="csv")
    assert text.endswith("sfYYYYc_loans_2020-2020_fnma.csv")
    assert spark.read.option("header", True).csv(text).count() == 1
    with pytest.raises(FileNotFoundError):
        job.combine_by_type("sf{year}a")
    with pytest.raises(ValueError):
        job.combine_by_type("sf{year}c_loans", enterprises=["other"])
    with pytest.raises(ValueError):
        job.combine_by_type("sf{year}c_loans", fmt="xml")


def test_overwrite_converts_again(spark, release):
    LoanFiles(spark, release).convert_all(years_list=[2020])
    again = LoanFiles(spark, release, LoadOptions(overwrite=True)).convert_all(min_year=2020, types={"Amount": "int"})
    assert sorted(c.status for c in again) == ["no dictionary", "written"]
    assert spark.read.parquet(f"{release.clean}/2020/fnma_sf2020c_loans.parquet").dtypes[1] == ("Amount", "int")


def test_one_bad_file_does_not_stop_the_rest(spark, release, tmp_path):
    put(tmp_path / "dictionaries/2019/2019_Single_Family_National_File_A_combined.csv", HEADER + "1,x,Flag,,,\n")
    put(tmp_path / "raw/2019/fnma_sf2019a_loans.txt", "1\n")
    status = {c.source.rsplit("/", 1)[1]: c.status for c in LoanFiles(spark, release).convert_all(max_year=2019)}
    assert status["fnma_sf2019a_loans.txt"] == "failed" and status["fnma_sf2019c_loans.txt"] == "written"


def test_load_errors(spark, release):
    job = LoanFiles(spark, release)
    dictionary = f"{release.dictionaries}/2019/2019_Single_Family_Census_Tract_File_C_combined.csv"
    with pytest.raises(FileNotFoundError):
        job.load("/none.txt", dictionary)
    with pytest.raises(FileNotFoundError):
        job.load(f"{release.raw}/2019/fnma_sf2019c_loans.txt", "/none.csv")
    df = job.load(f"{release.raw}/2019/fnma_sf2019c_loans.txt", dictionary, types={"Amount": "int"})
    assert rows(df) == [("1", "001", None), ("1", "006", 100)]


def test_missing_folders_give_empty_results(spark, tmp_path):
    job = LoanFiles(spark, DataPaths.under(str(tmp_path / "none")))
    assert job.convert_all() == [] and job.clean_years() == []


def test_dictionary_store(spark, tmp_path):
    job = LoanFiles(spark, DataPaths.under(str(tmp_path)))
    raw = spark.createDataFrame(
        [("d", 1, 1, 1, "1", "Flag", "1"), ("d", 1, 1, 2, "3-4", "Race 1-2", "2")],
        "doc string, page int, table_no int, row_no int, `Field #` string, `Field Name` string, `Field Width` string",
    )
    gaps = job.write_dictionary([raw], 2023, "2023_Single_Family_Census_Tract_File_C")
    assert [tuple(r) for r in gaps.select("missing", "missing_count").collect()] == [([2], 1)]
    offered = {(r.dictionary_year, r.dictionary_name, r.format) for r in job.available_dictionaries().collect()}
    assert offered == {(2023, "2023_Single_Family_Census_Tract_File_C_combined", f) for f in ("csv", "parquet")}
    for fmt in ("csv", "parquet"):
        layout = tables.read_layout(spark, f"{tmp_path}/dictionaries/2023/2023_Single_Family_Census_Tract_File_C_combined.{fmt}")
        assert layout == Layout.of([("Flag", 1), ("Race 1", 2), ("Race 2", 2)])
    assert job.write_dictionary([raw], 2023, "2023_Single_Family_Census_Tract_File_C") is None


def test_one_document_a_file(spark, tmp_path):
    job = LoanFiles(spark, DataPaths.under(str(tmp_path)))
    raw = spark.createDataFrame(
        [(d, 1, 1, 1, "1", "Flag", "1") for d in ("d1", "d2")],
        "doc string, page int, table_no int, row_no int, `Field #` string, `Field Name` string, `Field Width` string",
    )
    with pytest.raises(ValueError, match="write_dictionaries"):
        job.write_dictionary([raw], 2023, "2023_Single_Family_Census_Tract_File_C")


def test_store_of_many_documents(spark, tmp_path):
    job = LoanFiles(spark, DataPaths.under(str(tmp_path)))
    schema = "year int, doc string, page int, table_no int, row_no int, `Field #` string, `Field Name` string, `Field Width` string"
    rows_of = lambda year, doc, *cells: [(year, doc, 1, 1, i, n, name, w) for i, (n, name, w) in enumerate(cells)]
    first = spark.createDataFrame(
        [
            *rows_of(2019, "2019_Single_Family_National_File_A", ("2-3", "Race 1-2", "2"), ("1", "Fl ag", "1"), ("12", " x, y:z ", "7"), ("1", "again", "9")),
            *rows_of(2020, "007", ("1", "Flag", "1"), ("4", "  ", "3")),
            *rows_of(1980, "old", ("1", "Flag", "1")),
        ],
        schema,
    )
    other = spark.createDataFrame(rows_of(2020, "b c+d%e", ("1", None, "5")), schema).withColumn("Notes", F.lit("two\nlines"))
    report = {(r.year, r.document): (r.n_fields, r.missing_count, r.missing) for r in job.write_dictionaries([first, other], min_year=1990).collect()}
    assert report == {
        (2019, "2019_Single_Family_National_File_A"): (4, 8, list(range(4, 12))),
        (2020, "007"): (2, 2, [2, 3]),
        (2020, "b c+d%e"): (1, 0, None),
    }
    want = [
        (2019, "2019_Single_Family_National_File_A", 1, "Fl ag", 1, 0),
        (2019, "2019_Single_Family_National_File_A", 2, "Race 1", 2, 2),
        (2019, "2019_Single_Family_National_File_A", 3, "Race 2", 2, 5),
        (2019, "2019_Single_Family_National_File_A", 12, "x, y:z", 7, 8),
        (2020, "007", 1, "Flag", 1, 0),
        (2020, "007", 4, "unnamed", 3, 2),
        (2020, "b c+d%e", 1, "None", 5, 0),
    ]
    for fmt in ("csv", "parquet"):
        found = job.layouts(fmt).select("year", "document", "field_order", "column_name", "column_width", "column_start")
        assert rows(found) == sorted(want, key=lambda r: tuple(map(str, r)))
    offered = {(r.dictionary_year, r.dictionary_name, r.format): r.dictionary_path for r in job.available_dictionaries().collect()}
    assert set(offered) == {(y, f"{d}_combined", f) for y, d in report for f in ("csv", "parquet")}
    for fmt in ("csv", "parquet"):
        path = offered[2019, "2019_Single_Family_National_File_A_combined", fmt]
        wanted = Layout.of([("Fl ag", 1), ("Race 1", 2), ("Race 2", 2), ("x, y:z", 7)])
        assert tables.read_layout(spark, path) == wanted and job.read_layouts({path}) == {path: wanted}
    # stored documents stay, new ones come in; overwriting replaces whole documents
    changed = spark.createDataFrame([*rows_of(2020, "007", ("1", "Other", "2")), *rows_of(2021, "new", ("1", "Flag", "1"))], schema)
    assert [r.document for r in job.write_dictionaries([changed]).collect()] == ["new"]
    replaced = LoanFiles(spark, job.data, LoadOptions(overwrite_dictionaries=True))
    replaced.write_dictionaries([changed.where("year = 2020")])
    assert rows(replaced.layouts().where("document = '007'").select("column_name")) == [("Other",)]
    assert replaced.layouts().select("document").distinct().count() == 4


def test_many_files_of_three_layouts(spark, tmp_path, monkeypatch):
    """Two hundred files over years and kinds: as many write jobs as layouts, though every year has its own dictionaries."""
    kinds = {"a": "Single_Family_National_File_A", "b": "Single_Family_National_File_B", "c": "Single_Family_Census_Tract_File_C"}
    for year in range(2010, 2020):
        for n, (letter, title) in enumerate(kinds.items(), 2):
            fields = "".join(f"{i},3,f{i},,,\n" for i in range(1, n))
            put(tmp_path / f"dictionaries/{year}/{year}_{title}_combined.csv", HEADER + fields)
            for k in range(7 if letter != "c" else 6):
                lines = "\n" if (year, letter, k) == (2012, "b", 3) else f"{k:3} {year % 1000:3} x\n" * (k + 1)
                put(tmp_path / f"raw/{year}/fnma_sf{year}{letter} part+{k}%.txt", lines)
    put(tmp_path / "raw/2015/FNMA_SF2015A PART+1%.txt", "  1\n")  # a target of its own: names are told apart by case
    put(tmp_path / "raw/2015/fnma_sf2015a part+1%.TXT", "  9\n")
    jobs, own = [], sinks.write_partitions
    monkeypatch.setattr(sinks, "write_partitions", lambda df, path, *a: jobs.append(path) or own(df, path, *a))
    done = LoanFiles(spark, DataPaths.under(str(tmp_path))).convert_all()
    assert len(done) == 202 and len(jobs) == 3
    assert sorted({c.status for c in done}) == ["same target", "written"] and sum(c.status == "same target" for c in done) == 1
    for c in done:
        assert os.path.exists(f"{c.target}/_SUCCESS")
    three = spark.read.parquet(str(tmp_path / "clean/2013/fnma_sf2013c part+4%.parquet"))
    assert three.columns == ["f1", "f2", "f3"] and rows(three) == [("4", "13", "x")] * 5
    nothing = spark.read.parquet(str(tmp_path / "clean/2012/fnma_sf2012b part+3%.parquet"))
    assert nothing.columns == ["f1", "f2"] and nothing.count() == 0
    assert LoanFiles(spark, DataPaths.under(str(tmp_path))).convert_all() == []


def test_a_failing_batch_goes_file_by_file(spark, release, tmp_path, monkeypatch):
    put(tmp_path / "raw/2019/other_sf2019c_loans.txt", "3 002    5\n")
    own, sizes = LoanFiles._convert, []

    def convert(self, layout, rows, encoding):
        sizes.append(len(rows))
        if any("fhlmc" in r["path"] for r in rows):
            raise OSError("lost its disk")
        own(self, layout, rows, encoding)

    monkeypatch.setattr(LoanFiles, "_convert", convert)
    status = {c.source.rsplit("/", 1)[1]: (c.status, c.detail) for c in LoanFiles(spark, release).convert_all(years_list=[2019])}
    assert status == {"fhlmc_sf2019c_loans.TXT": ("failed", "lost its disk"), "fnma_sf2019c_loans.txt": ("written", ""), "other_sf2019c_loans.txt": ("written", "")}
    assert sorted(sizes) == [1, 1, 1, 3]


def test_mixed_stream_runs_a_batch_again(spark, release, tmp_path):
    """A batch that died after writing is run again: its records are there once."""
    job = LoanFiles(spark, release)

    def run(checkpoint):
        convert_mixed(
            spark, f"{release.raw}/*", job.available_dictionaries, job.read_layouts, f"{tmp_path}/out", f"{tmp_path}/{checkpoint}", {"Amount": "double"}, glob="*.{txt,TXT}"
        ).awaitTermination()

    def found():
        whole = spark.read.option("mergeSchema", True).parquet(f"{tmp_path}/out/Single_Family_Census_Tract_File_C-*/batch_id=*")
        return rows(whole.select("source_file", "year", "Amount"))

    run("first")
    want = [
        ("fhlmc_sf2019c_loans.TXT", 2019, 7.5), ("fhlmc_sf2019c_loans.TXT", 2019, 9.0),
        ("fnma_sf2019c_loans.txt", 2019, 100.0), ("fnma_sf2019c_loans.txt", 2019, None), ("fnma_sf2020c_loans.txt", 2020, 300.0),
        ("fnma_sf2020c_loans.txt", 2020, None),  # the one in the folder misc
    ]
    assert found() == rows(spark.createDataFrame(want, "f string, y int, a double"))
    run("second")  # a lost checkpoint gives batch 0 again
    assert found() == rows(spark.createDataFrame(want, "f string, y int, a double"))
    lost = spark.read.parquet(f"{tmp_path}/out/without_dictionary/batch_id=*")
    assert {r.source_file for r in lost.collect()} == {"fnma_mf2020b_loans.txt"}
    assert len(os.listdir(tmp_path / "out")) == 3  # one kind in two layouts, and what was lost


def test_archives(spark, tmp_path):
    zips = tmp_path / "zips"
    zips.mkdir()
    with zipfile.ZipFile(zips / "pudb_2019.ZIP", "w") as z:
        z.writestr("deep/er/fnma_sf2019c.txt", "é1\r\nb2\n".encode("latin-1"))
        z.writestr("docs/", "")
        z.writestr("docs/2005_guide.PDF", b"%PDF")
        z.writestr("other/fnma_sf2019c.txt", b"second")
        z.writestr("skip.csv", b"x")
    with zipfile.ZipFile(zips / "plain.zip", "w") as z:
        z.writestr("a_2008_b.txt", b"old")
        z.writestr("b.txt", b"none")
    put(zips / "broken_2010.zip", b"not a zip")
    put(zips / "note.txt", b"x")
    assert [(r.member, r.readable) for r in archives.list_members(spark, str(zips)).where("not readable").collect()] == [(None, False)]
    put(tmp_path / "raw/unknown/b.txt", b"kept")
    job = LoanFiles(spark, DataPaths.under(str(tmp_path)))
    done = {r["target"][len(str(tmp_path)):]: r["bytes"] for r in job.unpack_archives(str(zips)).where("status = 'copied'").collect()}
    assert done == {"/raw/2019/fnma_sf2019c.txt": 7, "/dictionaries/2019/2005_guide.PDF": 4, "/raw/2008/a_2008_b.txt": 3}
    assert (tmp_path / "raw/2019/fnma_sf2019c.txt").read_bytes() == "é1\r\nb2\n".encode("latin-1")
    assert (tmp_path / "raw/unknown/b.txt").read_bytes() == b"kept"
    assert not list(tmp_path.rglob("*.part"))
    assert [(r["status"], r["member"]) for r in job.unpack_archives(str(zips)).collect()] == [("unreadable", None)]
    lines = archives.member_lines(
        archives.list_members(spark, str(zips)).where("member like '%/er/%'"), rows_per_batch=1
    )
    assert [tuple(r)[2:] for r in lines.orderBy("line_no").collect()] == [(0, "é1"), (1, "b2")]


def test_many_members_one_damaged(spark, tmp_path):
    """Members are dealt over tasks; a damaged one fails alone; with overwriting the last of two names wins."""
    zips = tmp_path / "zips"
    zips.mkdir()
    with zipfile.ZipFile(zips / "many_2020.zip", "w", zipfile.ZIP_STORED) as z:
        for i in range(120):
            z.writestr(f"a/f{i}.txt", f"member {i}")
        z.writestr("b/f3.txt", "second")
    raw = bytearray((zips / "many_2020.zip").read_bytes())
    at = raw.index(b"member 77")
    raw[at : at + 6] = b"MEMBER"
    (zips / "many_2020.zip").write_bytes(bytes(raw))
    members = archives.list_members(spark, str(zips))
    targets = archives.routed_members(members, last=True).withColumn("target", F.concat(F.lit(f"{tmp_path}/out/"), "base_name"))
    copied = archives.unpack(targets)
    assert copied.select(F.spark_partition_id()).distinct().count() > 1
    status = {r["member"]: (r["status"], r["detail"]) for r in copied.collect()}
    assert len(status) == 120 and status["a/f77.txt"][0] == "failed" and "CRC" in status["a/f77.txt"][1]
    assert sum(s == "copied" for s, _ in status.values()) == 119
    assert (tmp_path / "out/f3.txt").read_bytes() == b"second" and not list((tmp_path / "out").glob("*.part"))


def test_a_directory_is_read_once_for_a_run_of_members(tmp_path, monkeypatch):
    """Else unpacking takes time with the square of an archive's members."""
    opened, real = [], zipfile.ZipFile
    for name in ("a.zip", "b.zip"):
        with real(tmp_path / name, "w") as z:
            for i in range(30):
                z.writestr(f"{i}.txt", f"{name} {i}")
    monkeypatch.setattr(archives.zipfile, "ZipFile", lambda f, *more: opened.append(f) or real(f, *more))
    wanted = [(f"{tmp_path}/{n}", f"{i}.txt", i, f"{tmp_path}/out/{n}/{i}") for n in ("a.zip", "b.zip") for i in range(30)]
    batches = [pd.DataFrame(part, columns=["archive", "member", "position", "target"]) for part in (wanted[:20], wanted[20:])]
    told = pd.concat(archives._unpack(iter(batches)))
    assert len(opened) == 2 and set(told["status"]) == {"copied"} and len(told) == 60
    assert (tmp_path / "out/b.zip/29").read_text() == "b.zip 29"


def test_plain_files_are_sorted_in_parts(spark, tmp_path):
    """The lines of one file are dealt over tasks; the file has them in order, once each."""
    lines = spark.range(0, 5000, 1, 4).selectExpr("if(id % 50 = 0, 'few.csv', 'many rows%.csv') as name", "5000 - id as at", "concat('line ', 5000 - id) as value")
    assert len(sorted_parts(lines, f"{tmp_path}/parts", "at")["many rows%.csv"]) > 1
    plain_files(lines, f"{tmp_path}/plain", "at")
    numbers = {"few.csv": range(50, 5001, 50), "many rows%.csv": [i for i in range(1, 5001) if i % 50]}
    for name, expected in numbers.items():
        assert (tmp_path / "plain" / name).read_text() == "".join(f"line {i}\n" for i in expected)


def test_zip_members_from_stored_parts(spark, tmp_path):
    """A member is read from files through a buffer, in their order; it is never a cell."""
    parts = [str(put(tmp_path / f"part{i}", f"line {i}\n" * 3)) for i in range(4)]
    schema = "archive string, position int, member string, data array<string>, damaged boolean"
    zip_files(spark.createDataFrame([("a.zip", 0, "in/a.txt", parts, False), ("a.zip", 1, "b.txt", parts[:1], True)], schema), f"{tmp_path}/zips")
    with zipfile.ZipFile(tmp_path / "zips/a.zip") as z:
        assert z.read("in/a.txt").decode() == "".join(f"line {i}\n" * 3 for i in range(4))
        with pytest.raises(zipfile.BadZipFile):
            z.read("b.txt")


def test_dictionary_keeps_its_order(spark, tmp_path):
    """Part files are read by name, whatever their sizes."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fields = spark.createDataFrame([(f"f{i:03d}" + "x" * (120 - i), i % 9 + 1) for i in range(120)], "`Field Name` string, `Field Width` int")
        for fmt in ("csv", "parquet"):
            path = f"{tmp_path}/d.{fmt}"
            writer = fields.repartitionByRange(30, "Field Name").write
            writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path)
            layout = read_layout(spark, path)
            assert [f.name[:4] for f in layout.fields] == [f"f{i:03d}" for i in range(120)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_medallion(spark, tmp_path):
    raw = tmp_path / "set/raw"
    raw.mkdir(parents=True)
    with zipfile.ZipFile(raw / "a.zip", "w") as z:
        z.writestr("x/one.csv", b"k,v\n1,a\n")
        z.writestr("y/one.csv", b"k,v\n2,b\n")
        z.writestr("y/two.CSV", b'k,v\n3,"c\nd"\n')
        z.writestr("y/skip.txt", b"no")
    put(raw / "three.csv", b"k,v\n4,e\n")
    layers = Medallion(spark, str(tmp_path), "set")
    bronze = layers.promote(str(raw / "a.zip"))
    assert [p.rsplit("/", 1)[1] for p in bronze] == ["one.csv", "two.CSV"]
    assert (tmp_path / "set/bronze/one.csv").read_bytes() == b"k,v\n2,b\n"
    layers.promote(str(raw / "three.csv"))
    put(tmp_path / "set/bronze/three.csv", b"k,v\n5,f\n")
    assert len(layers.promote(str(raw / "three.csv"), overwrite=False)) == 1
    assert (tmp_path / "set/bronze/three.csv").read_bytes() == b"k,v\n5,f\n"
    assert layers.promote(str(raw / "three.csv"), allowed=(".zip",)) == []
    with pytest.raises(FileNotFoundError):
        layers.promote(str(raw / "none.csv"))
    put(tmp_path / "set/bronze/note.txt", b"x")
    assert [r["path"].rsplit("/", 1)[1] for r in layers.list_layer("bronze").collect()] == ["note.txt", "one.csv", "three.csv", "two.CSV"]
    chosen = [str(tmp_path / "set/bronze" / n) for n in ("one.csv", "three.csv", "note.txt")]
    out = layers.build_silver(chosen, transform=lambda df: df.where("k > 2"), schema="k int, v string")
    assert out.endswith("/silver/set_silver.parquet") and rows(spark.read.parquet(out)) == [(5, "f")]
    text = layers.build_silver(chosen, sink="csv", output_name="all.csv")
    assert rows(spark.read.option("header", True).csv(text)) == [("2", "b"), ("5", "f")]
    with pytest.raises(ValueError):
        layers.build_silver(chosen, sink="json")
    with pytest.raises(ValueError):
        layers.build_silver([str(tmp_path / "set/bronze/note.txt")])
    with pytest.raises(ValueError):
        Medallion(spark, str(tmp_path), "empty").build_silver()
    spark.range(3).write.parquet(str(tmp_path / "set/bronze/p.parquet"))
    with pytest.raises(ValueError, match="schemas differ"):
        layers.build_silver([*chosen, str(tmp_path / "set/bronze/p.parquet")])


def test_hive(spark, tmp_path):
    df = spark.createDataFrame([(1, 2019, "a"), (2, 2020, None), (3, 2020, "b")], "id int, Year int, enterprise_flag string")
    df.write.parquet(str(tmp_path / "in"))
    out = write_hive([str(tmp_path / "in")], str(tmp_path / "out"), spark=spark)
    assert (tmp_path / "out/year=2020").exists() or (tmp_path / "out/Year=2020").exists()
    back = spark.read.parquet(out)
    assert rows(back.select("id", "year", "enterprise_flag")) == rows(df)
    with pytest.raises(FileExistsError):
        write_hive([df], out)
    write_hive([df.where("id = 1")], out, overwrite=True)
    assert spark.read.parquet(out).count() == 1
    with pytest.raises(ValueError):
        write_hive([], out)
    plan = spark.read.parquet(out).where("year = 2019")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan


def test_hive_splits_a_hot_partition(spark, tmp_path):
    keys = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    spark.conf.set(keys[0], "64kb")
    spark.conf.set(keys[1], "16kb")
    try:
        df = spark.range(0, 200_000, 1, 8).select(
            F.expr("uuid()").alias("v"), F.lit(2020).alias("year"), F.when(F.col("id") % 50 == 0, "a").otherwise("b").alias("enterprise_flag")
        )
        out = write_hive([df], str(tmp_path / "out"))
        hot = list((tmp_path / "out/year=2020/enterprise_flag=b").glob("part-*.parquet"))
        assert len(hot) > 1 and spark.read.parquet(out).count() == 200_000
    finally:
        for k in keys:
            spark.conf.unset(k)


def test_write_formats(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.write_table(spark.range(1), str(tmp_path / "x"), "orc")
    sinks.write_table(spark.range(1), str(tmp_path / "x"))
    with pytest.raises(Exception, match="already exists"):
        sinks.write_table(spark.range(1), str(tmp_path / "x"), overwrite=False)
    assert sinks.combined_name(spark, "mf{year}b_loans/x", None, None, ["fnma"], "csv") == "mfYYYYb_loans_x_all_fnma.csv"
    assert sinks.combined_name(spark, "sf{year}c", 2018, 2020, ["fnma", "fhlmc", "fnma"], "parquet") == "sfYYYYc_2018-2020_fhlmc-fnma.parquet"


def test_acquisitions(spark, tmp_path):
    put(tmp_path / "dict/fields.csv", 'yr,Year\nLTV,LTV Ratio Percent\n"Loan, Amt",Loan Amount\nnone,Nothing\n')
    put(
        tmp_path / "raw/2018_PUDB_EXPORT_123118.csv",
        "Unnamed: 0,yr,Loan Acquisition Date,LTV,Property Type,Prepayment Penalty Expiration Date,Old Col,Index Source Type\n"
        "0,2018,2018,0.8,PT01,12/31/9999,5,99\n1,2018,2018,0.5,PT12,1/2/2020,,1\n",
    )
    put(
        tmp_path / "raw/2019_PUDB_EXPORT_123119.csv",
        'yr,Loan Acquisition Date,LTV,"Loan, Amt",Property Type,Prepayment Penalty Expiration Date,Total Yearly Income Amount\n'
        "2019,2019,80,7,PT02,9999-12-31,1000\n2019,2019,70,8,PT03,2021-03-04,\n",
    )
    banks = BankData(spark)
    written = banks.import_acquisitions(str(tmp_path / "raw"), str(tmp_path / "clean"), str(tmp_path / "dict/fields.csv"), 2018, 2019)
    old = spark.read.parquet(written[0])
    assert old.columns == ["Loan Acquisition Date", "LTV Ratio Percent", "Property Type", "Prepayment Penalty Expiration Date", "Old Col", "Index Source Type"]
    assert rows(old) == [(2018, 50.0, 12, datetime.date(2020, 1, 2), None, 1), (2018, 80.0, 1, None, 5, None)]
    new = spark.read.parquet(written[1])
    assert rows(new.select("`Loan Amount`", "`Total Yearly Income Amount`")) == [(7, 12000), (8, None)]
    (recent,) = banks.combine_acquisitions(str(tmp_path / "clean"), str(tmp_path / "out"), 2018, 2019)
    kept = spark.read.parquet(recent)
    assert kept.count() == 4 and "Old Col" not in kept.columns and "Index Source Type" not in kept.columns
    old.withColumn("Loan Acquisition Date", F.lit(2017)).write.parquet(str(tmp_path / "clean/fhlb_acquisitions_2017.parquet"))
    whole, recent = banks.combine_acquisitions(str(tmp_path / "clean"), str(tmp_path / "out2"), 2017, 2019)
    assert whole.endswith("fhlb_acquisitions_2017-2019.parquet") and recent.endswith("fhlb_acquisitions_2018-2019.parquet")
    assert spark.read.parquet(whole).count() == 6 and "Old Col" in spark.read.parquet(whole).columns
    assert spark.read.parquet(recent).count() == 4 and "Old Col" not in spark.read.parquet(recent).columns
    with pytest.raises(FileNotFoundError):
        banks.load_acquisitions(str(tmp_path / "raw"), 2020, {})


def test_members(spark, tmp_path):
    put(tmp_path / "in/FHLB_Members_Q42013_Release.csv", "FHFBID,MEM_NAME,APPR DATE\n1,A,2001-05-06\n")
    put(tmp_path / "in/FHLB_Members_Q32014_Release.csv", "fhfb_id,Mem Name,Appr_Date,MEM DATE,Unnamed: 4\n2,B,05/06/32,bad,x\n3,C,05/06/01,1/2/99,y\n")
    put(tmp_path / "in/FHLB_Members_Q12020_Release.csv", "Some title,,\nFHFA ID,MEM NAME,APPR DATE\n4,D,1/1/20\n")
    put(tmp_path / "in/FHLB_Members_Q12025_Release.csv", "FHFA ID\n9\n")
    out = BankData(spark).combine_members(str(tmp_path / "in"), str(tmp_path / "out"), 2013, 2023, as_of=datetime.date(2024, 1, 1))
    df = tables.read_delimited(spark, out)
    assert set(df.columns) == {"FHFB ID", "MEMBER NAME", "APPROVAL DATE", "MEM DATE", "SOURCE FILE", "YEAR", "QUARTER"}
    assert rows(df.select("`FHFB ID`", "`MEMBER NAME`", "`APPROVAL DATE`", "`MEM DATE`", "YEAR", "QUARTER")) == [
        ("1", "A", "2001-05-06", None, "2013", "4"),
        ("2", "B", "1932-05-06", None, "2014", "3"),
        ("3", "C", "2001-05-06", "1999-01-02", "2014", "3"),
        ("4", "D", "2020-01-01", None, "2020", "1"),
    ]
    assert BankData(spark).combine_members(str(tmp_path / "in"), str(tmp_path / "out"), 1990, 1991) is None


def test_limits(spark, tmp_path):
    put(tmp_path / "in/FullCountyLoanLimitList2011_HERA_b.csv", 'Title,,\n"State\nCode",Name,Limit\n1,X,9\n')
    put(tmp_path / "in/FullCountyLoanLimitList2011_HERA_a.csv", 'Title,,\n"State\nCode",Name,Limit\n1,A,100\n2,"B\nC",200\n')
    put(tmp_path / "in/FullCountyLoanLimitList2013_HERA.csv", "Title\nState Code,CBSA\n3,C1\n")
    out = LoanLimits(spark).combine(str(tmp_path / "in"), str(tmp_path / "out"), 2011, 2013)
    assert out.endswith("conforming_loan_limits_2011-2013.csv.gz")
    df = spark.read.option("header", True).option("multiLine", True).csv(out)
    assert rows(df.select("`State Code`", "Name", "Limit", "Year", "CBSA")) == [
        ("1", "A", "100", "2011", None),
        ("2", "B\nC", "200", "2011", None),
        ("3", None, None, "2013", "C1"),
    ]
    assert LoanLimits(spark).combine(str(tmp_path / "in"), str(tmp_path / "out"), 1990, 1991) is None


def test_split_releases(spark, tmp_path):
    for who, flag in (("fnma", 1), ("fhlmc", 2)):
        put_gzip(tmp_path / f"{who}_sf2021c_loans_file1.csv.gz", f"Enterprise Flag|Record Number|A|S\n{flag}|1|x|1\n{flag}||n|1\n{flag}|2|y|1\n")
        put_gzip(tmp_path / f"{who}_sf2021c_loans_file2.csv.gz", f"Enterprise Flag|Record Number|B|S\n{flag}|1|5|2\n{flag}||6|2\n{flag}|3|7|2\n")
    job = LoanFiles(spark, DataPaths.under(str(tmp_path)))
    out = job.read_typed(job.combine_halves(str(tmp_path), 2021))
    assert out.columns == ["Enterprise Flag", "Record Number", "A", "S_x", "B", "S_y"]
    assert rows(out.where("`Enterprise Flag` = 2").drop("Enterprise Flag")) == [
        (None, "n", 1, 6, 2),
        (1, "x", 1, 5, 2),
        (2, "y", 1, None, None),
        (3, None, None, 7, 2),
    ]
    assert out.count() == 8


def test_yearly_loans(spark, tmp_path):
    job = LoanFiles(spark, DataPaths.under(str(tmp_path)))
    for year in (2012, 2013):
        put_gzip(
            tmp_path / f"gse_sf{year}c_loans.csv.gz",
            f"k|{year} Local Area Median Income|{year} Area Median Family Income\n{year}|{year * 10}|{year * 20}\n",
        )
    early = job.read_typed(job.combine_before_2018(str(tmp_path), str(tmp_path), 2012, 2013))
    assert rows(early.select("k", "year", "`Local Area Median Income`", "`Area Median Family Income`")) == [
        (2012, 2012, 20120, 40240),
        (2013, 2013, 20130, 40260),
    ]
    put_gzip(
        tmp_path / "gse_sf2021c_loans.csv.gz",
        "US Postal State Code|County - 2010 Census|Census Tract - 2010 Census|2021 Local Area Median Income|Borrower Gender|HOEPA Status\n"
        "6|37|2701|50|4|9\n",
    )
    put_gzip(
        tmp_path / "gse_sf2022c_loans.csv.gz",
        "US Postal State Code|County - 2020 Census|Census Tract - 2020 Census|2022 Local Area Median Income|Borrower Sex|Note Amount\n"
        "12|1|100|60|2|999999999\n12|1||61|9|5\n",
    )
    text, stored = job.combine_since_2018(str(tmp_path), str(tmp_path), 2021, 2022)
    df = spark.read.parquet(stored)
    assert rows(df.select("year", "`Local Area Median Income`", "`Borrower Gender`", "`Borrower Sex`", "`HOEPA Status`", "`Note Amount`", "census_string")) == [
        (2021, 50, None, None, None, None, "06037002701"),
        (2022, 60, None, 2, None, None, "12001000100"),
        (2022, 61, None, None, None, 5, None),
    ]
    assert tables.read_delimited(spark, text).count() == 3


def test_multifamily_without_dictionary(spark, tmp_path):
    widths = [3 + i % 4 for i in range(len(rule_tables.MULTIFAMILY_NAMES))]
    lines = [" ".join(str((i + n) % 10 ** (w - 1)).rjust(w) if n else "9" * w for i, w in enumerate(widths)) for n in range(30)]
    path = put(tmp_path / "fnma_mf2019c_loans.txt", "\n".join(lines))
    job = LoanFiles(spark, DataPaths.under(str(tmp_path)))
    df = job.load_multifamily(str(path))
    assert df.columns == [*rule_tables.MULTIFAMILY_NAMES, "Year"] and df.count() == 30
    assert df.orderBy("Record Number").first()["Enterprise Flag"] == 1 and df.first()["Year"] == 2019
    out = job.combine_multifamily([str(path)], str(tmp_path))
    assert out.endswith("combined_multifamily.csv") and tables.read_delimited(spark, out).count() == 30


def test_multifamily_archives(spark, tmp_path):
    """Equal member names in two archives are both read; a damaged one and other members are left out."""
    widths = [3 + i % 4 for i in range(len(rule_tables.MULTIFAMILY_NAMES))]
    line = lambda n: " ".join(str((i + n) % 10 ** (w - 1) + 1).rjust(w) if n else "9" * w for i, w in enumerate(widths))
    for archive, first in (("a_MFCensus2019.zip", 0), ("b_MFCensus2019.zip", 5), ("other.zip", 9)):
        with zipfile.ZipFile(tmp_path / archive, "w") as packed:
            packed.writestr("readme.txt", "no")
            packed.writestr("in/fnma_mf2019c_loans.txt", "\n".join(line(n) for n in range(first, first + 5)) + "\n" + line(0))
            packed.writestr("fnma_mf2020c_loans.txt", line(0))
            packed.filelist[-1].CRC ^= 1
    (tmp_path / "torn_MFCensus.zip").write_bytes(b"no archive")
    job = LoanFiles(spark, DataPaths.under(str(tmp_path)))
    found = tables.read_delimited(spark, job.combine_multifamily_archives(str(tmp_path), str(tmp_path / "out")))
    assert found.columns == [*rule_tables.MULTIFAMILY_NAMES, "Year"]
    assert found.count() == 12 and {r["Year"] for r in found.select("Year").collect()} == {"2019"}
    with pytest.raises(FileNotFoundError):
        job.combine_multifamily_archives(str(tmp_path), str(tmp_path / "out"), containing=["fnma_mf2020"])


def test_sheets_by_header(spark, tmp_path):
    """One scan for each header; title rows are skipped by file; a header that is missing is an error."""
    put(tmp_path / "a b+c%.csv", 'T\n\n"k\nx",v\n1,"two\nlines"\n2,\n')
    put(tmp_path / "b.csv", '"k\nx",v\n3,z\n')
    put(tmp_path / "c.csv", "k,v,\n4,y,extra\n")
    put(tmp_path / "d.csv", "only\n5\n")
    put(tmp_path / "e.csv", "only\n")
    listed = [r["path"] for r in files.list_files(spark, str(tmp_path)).orderBy("path").collect()]
    found = tables.read_sheets(spark, listed, {"a b+c%.csv": 1, "b.csv": 0})
    assert [(frame.columns, len(own)) for own, frame in found] == [(["k\nx", "v", "_file"], 2), (["k", "v", "Unnamed: 2", "_file"], 1), (["only", "_file"], 2)]
    assert [rows(frame.drop("_file")) for _, frame in found] == [[("1", "two\nlines"), ("2", None), ("3", "z")], [("4", "y", "extra")], [("5",)]]
    assert rows(tables.read_sheet(spark, listed[1])) == [("3", "z")]
    with pytest.raises(ValueError, match="e.csv"):
        tables.read_sheets(spark, listed, {"e.csv": 1})


def test_live_columns_from_footers(spark, tmp_path, monkeypatch):
    """Against counting all values: files all early, all late, on both sides, without rows, and without statistics."""
    schema = "y int, a int, b string, c double, `d e` int, f struct<x: int, z: string>, g array<int>, h int"
    parts = {
        "early": [(2017, 1, "x", 1.0, 1, (1, "q"), [1], None), (2018, None, "x", None, None, None, None, None)],
        "late": [(2019, None, "x", None, None, (None, "q"), None, None), (2020, None, None, None, None, None, None, None)],
        "mixed": [(2018, 5, None, 5.0, 5, None, [5], None), (2019, None, None, None, 7, None, None, None), (None, 9, None, 9.0, None, None, [9], None)],
        "nothing": [],
    }
    table = str(tmp_path / "table.parquet")
    for part in parts.values():
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(table)
    whole = spark.read.parquet(table)
    want = recent_subset(whole, "y", 2018, 2019)
    got = footers.recent_subset_of(spark, table, "y", 2018, 2019)
    assert got.columns == want.columns == ["y", "b", "d e", "f"] and rows(got.select("y", "b")) == rows(want.select("y", "b"))
    scanned = []
    own = footers.live_columns
    monkeypatch.setattr(footers, "live_columns", lambda df, where: scanned.append((df.inputFiles(), df.columns)) or own(df, where))
    assert footers.live_columns_of(spark, table, "y", 2019) == want.columns
    ((read, asked),) = scanned
    assert len(read) < 4 and "b" not in asked and "y" not in asked  # the early and the late file are not read
    assert footers.live_columns_of(spark, table, "c", 5) == own(whole, F.col("c") >= 5)


def test_incremental(spark, tmp_path):
    layout = Layout.of([("k", 2), ("v", 1)])

    def run():
        stream = parsed_stream(spark, str(tmp_path / "in"), layout, files_per_batch=1)
        convert_new(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out"))

    put(tmp_path / "in/fnma_sf2019c.txt", "é1 a\nb2 b\n", "latin-1")
    assert run().count() == 2
    assert run().count() == 2
    put(tmp_path / "in/fnma_sf2020c.txt", "c3 c\n")
    df = run()
    assert rows(df.select("k", "v", "source_file", "year")) == [
        ("b2", "b", "fnma_sf2019c.txt", 2019),
        ("c3", "c", "fnma_sf2020c.txt", 2020),
        ("é1", "a", "fnma_sf2019c.txt", 2019),
    ]


def test_links(spark):
    html = """<body><!-- <a href="/gone.zip"> --><A class='x>y' HREF='Data/One.ZIP'>1</A><a data-href="no.zip">n</a>
    <a href=/two.zip?x=1&amp;y=2>2</a><a href="">e</a><a href="https://o.example/dir/">d</a><a href="one.zip">r</a>
    <a title="a" href="//cdn.example/Three.Zip#t">3</a><abbr href="bad.zip"></abbr></body>"""
    pages = spark.createDataFrame([(1, "https://h.example/p/index.html", html), (2, "https://h.example/q/", '<a href="two.zip">')], "page_id long, url string, html string")
    found = links.page_links(pages)
    assert [tuple(r) for r in found.where("page_id = 1").orderBy("position").select("file_url", "file_name").collect()] == [
        ("https://h.example/p/Data/One.ZIP", "One.ZIP"),
        ("https://h.example/two.zip?x=1&y=2", "two.zip"),
        ("https://h.example/p/one.zip", "one.zip"),
        ("https://cdn.example/Three.Zip#t", "Three.Zip"),
    ]
    names = lambda df: sorted(r["file_name"] for r in df.collect())
    assert names(links.wanted_links(found, [".ZIP"], ["ONE", "three"])) == ["One.ZIP", "Three.Zip", "one.zip"]
    assert names(links.wanted_links(found, [".zip"], ["one"], case_sensitive=True)) == ["one.zip"]
    assert names(links.wanted_links(found, [".pdf"])) == []
    first = {r["file_name"]: r["page_id"] for r in links.first_per_file(found).collect()}
    assert first == {"One.ZIP": 1, "two.zip": 1, "one.zip": 1, "Three.Zip": 1}


def test_long_files_are_split(spark, tmp_path):
    put(tmp_path / "big.txt", "x" * 99 + "\n" + ("y" * 99 + "\n") * 20_000)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256kb")
    try:
        lines = read_lines(spark, str(tmp_path / "big.txt"))
        assert lines.rdd.getNumPartitions() > 4 and lines.count() == 20_001
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_listing(spark, tmp_path):
    put(tmp_path / "b/2.txt", "x")
    put(tmp_path / "a.txt", "xy")
    assert [(r["path"].rsplit("/", 1)[1], r["length"]) for r in files.list_layer(spark, str(tmp_path)).collect()] == [("a.txt", 2), ("2.txt", 1)]
    assert files.list_files(spark, str(tmp_path / "none")).count() == 0
