"""Jobs from stored files to stored tables: what they read, Spark writes from the test tables first."""

from __future__ import annotations

import datetime
import hashlib
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgepole.checks.dictionaries import _CELLS_SQL, _cells
from ridgepole.checks.registry import check, table
from ridgepole.config import DataPaths
from ridgepole.operators.fixed_width import format_lines
from ridgepole.operators.layout import Layout
from ridgepole.plans import rule_tables
from ridgepole.plans.bank_data import BankData
from ridgepole.plans.limits import LoanLimits
from ridgepole.plans.loan_files import LoanFiles
from ridgepole.session import many_tasks, remove_dir, scratch_dir, spread
from ridgepole.sources import archives, files, tables
from ridgepole.streaming.mixed import convert_mixed


def sorted_parts(rows: DataFrame, staged: str, order: str | None = None) -> dict[str, list[str]]:
    """The ``value`` lines of each ``name`` (by ``order`` if given) as files under ``staged``, to be read one after the other.

    The lines are dealt by ranges, so a task sorts its share of all lines, not a whole file.
    """
    spark = rows.sparkSession
    keyed = rows.withColumns({"_key": F.md5(F.col("name").cast("binary")), "_at": F.col(order) if order else F.xxhash64("value")})
    dealt = keyed.repartitionByRange(many_tasks(spark), "_key", "_at").sortWithinPartitions("_key", "_at")
    dealt.select("value", "_key").write.partitionBy("_key").text(staged)
    names = [row["name"] for row in rows.select("name").distinct().toLocalIterator()]
    # a task's number leads the name of its file
    return {name: sorted(files.glob(spark, f"{staged}/_key={hashlib.md5(name.encode()).hexdigest()}/part-*")) for name in names}


def _read_on(uris: Iterable[str]) -> Iterator[bytes]:
    """The bytes of files one after the other, through a fixed-size buffer."""
    for uri in uris:
        system, where = archives._open(uri)
        with system.open_input_file(where) as source:
            while chunk := source.read(archives.BUFFER):
                yield chunk


def _join_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for parts, target in zip(batch["parts"], batch["target"]):
            system, where = archives._open(target)
            with system.open_output_stream(where) as out:
                for chunk in _read_on(parts):
                    out.write(chunk)
        yield pd.DataFrame({"n": [len(batch)]})


def plain_files(rows: DataFrame, root: str, order: str | None = None) -> None:
    """One plain file under ``root`` for each ``name``, of its ``value`` lines (by ``order`` if given).

    Spark writes a folder for each name.  Its only part file is moved to the name; of
    several, one task copies the bytes there.
    """
    spark = rows.sparkSession
    staged = scratch_dir(spark, "plain-files")
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    several = []
    for name, parts in sorted_parts(rows, staged, order).items():
        target = path(f"{root}/{name}")
        system.mkdirs(target.getParent())
        if len(parts) > 1:
            several.append((parts, system.makeQualified(target).toUri().toString()))
        elif not system.rename(path(parts[0]), target):
            raise OSError(f"{parts[0]} could not be moved to {name}")
    if several:
        joined = spread(spark.createDataFrame(several, "parts array<string>, target string"), F.col("target"))
        joined.mapInPandas(_join_parts, "n int").collect()
    remove_dir(spark, staged)


@check(
    f"""
    with {_CELLS_SQL},
    rows as (
        select 2015 + n.p_partkey % 6 as year, p.p_brand as document, n.p_partkey // 100 as page, n.p_partkey as row_no, n.n as field_order,
               case when n.p_partkey % 7 = 0 then 'None' when n.p_partkey % 11 = 0 then 'unnamed' else p.p_name end as base, p.p_size
        from numbers n join part p using (p_partkey) where 2015 + n.p_partkey % 6 between 2016 and 2019
        qualify row_number() over (partition by year, document, field_order order by page, row_no) = 1),
    usable as (select *, cast(p_size as bigint) as column_width from rows where p_size % 10 <> 0)
    select year, document, field_order,
           base || case when row_number() over (partition by year, document, base order by field_order) > 1
               then '_' || row_number() over (partition by year, document, base order by field_order) else '' end as column_name,
           column_width,
           cast(coalesce(sum(column_width + 1) over (partition by year, document order by field_order
               rows between unbounded preceding and 1 preceding), 0) as bigint) as column_start
    from usable
    """
)
def dictionary_store(spark, sf_dir):
    """Extracted tables of every brand's document of six years to a store, and all layouts of four years back.

    Tables come in two shapes; one run stores 2016 to 2018, a second one 2017 to 2019, of
    which only 2019 is new.  Odd years are read from the text form.
    """
    key, size = F.col("p_partkey"), F.col("p_size")
    numbers = _cells(spark, sf_dir).select("p_partkey", "`Field_ #`")
    rows = table(spark, sf_dir, "part").join(numbers, "p_partkey").select(
        (key % 6 + 2015).cast("int").alias("year"), F.col("p_brand").alias("doc"), F.floor(key / 100).alias("page"), F.lit(1).alias("table_no"),
        key.alias("row_no"), "Field_ #",
        F.when(key % 7 == 0, None).when(key % 11 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), "p_name")).alias("Field Name"),
        F.when(size % 10 == 0, F.lit("n/a")).otherwise(size.cast("string")).alias("Field Width"),
    )
    plain, noted = rows.where(key_is_even := F.col("row_no") % 2 == 0), rows.where(~key_is_even).withColumn("Notes", F.lit("two\nlines, \"quoted\""))
    job = LoanFiles(spark, DataPaths.under(scratch_dir(spark, "dictionary-store")))
    job.write_dictionaries([plain, noted], min_year=2016, max_year=2018)
    job.write_dictionaries([plain, noted], min_year=2017, max_year=2019)
    odd = F.col("year") % 2 == 1
    found = job.layouts("parquet").where(~odd).union(job.layouts("csv").where(odd))
    return found.select("year", "document", "field_order", "column_name", "column_width", "column_start")


KINDS = {
    "F": ("fnma_sf", "c_loans", "Single_Family_Census_Tract_File_C", Layout.of([("o_orderkey", 19), ("o_custkey", 19), ("o_orderpriority", 20)])),
    "O": ("fhlmc_sf", "a_loans", "Single_Family_National_File_A", Layout.of([("o_orderkey", 19), ("o_totalprice", 18)])),
    "P": ("fnma_mf", "b_loans", "Multifamily_National_File_Property-Level_Data_File_B", Layout.of([("o_orderkey", 19), ("o_orderdate", 10), ("o_orderstatus", 1)])),
}
LOAN_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "decimal(18,2)", "o_orderdate": "date"}


def loan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as records of three kinds of files, one file for each year and kind."""
    orders = table(spark, sf_dir, "orders").withColumns(
        {"o_totalprice": F.col("o_totalprice").cast("decimal(18,2)"), "o_orderdate": F.col("o_orderdate").cast("date"), "year": F.year("o_orderdate")}
    )
    whole = None
    for status, (before, after, _, layout) in KINDS.items():
        own = orders.where(F.col("o_orderstatus") == status)
        year = F.col("year").cast("string")
        lines = format_lines(own.withColumn("name", F.concat(year, F.lit(f"/{before}"), year, F.lit(f"{after}.txt"))), layout, keep=("name", "year"))
        whole = lines if whole is None else whole.union(lines)
    return whole


def loan_dictionaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionaries of those files, as extracted rows; none for what was pending in 1995."""
    rows = [(s, title, str(i + 1), f.name, str(f.width)) for s, (_, _, title, layout) in KINDS.items() for i, f in enumerate(layout.fields)]
    described = spark.createDataFrame(rows, "o_orderstatus string, title string, `Field #` string, `Field Name` string, `Field Width` string")
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), "o_orderstatus").distinct()
    wanted = years.where("not (year = 1995 and o_orderstatus = 'P')").join(described, "o_orderstatus")
    return wanted.select(
        "year", F.concat(F.col("year").cast("string"), F.lit("_"), "title").alias("doc"), F.lit(1).alias("page"), F.lit(1).alias("table_no"),
        F.col("Field #").cast("int").alias("row_no"), "Field #", "Field Name", "Field Width",
    )


def read_back(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows and sum of keys of each written table."""
    where = F.col("_metadata.file_path")
    rows = spark.read.parquet(*paths).select("o_orderkey", F.regexp_extract(where, r"/([^/]+)\.parquet/[^/]+$", 1).alias("stem"))
    return rows.groupBy("stem").agg(F.count("*").alias("n_rows"), F.sum("o_orderkey").alias("key_sum"))


_KINDS_SQL = """
    files as (
        select year(o_orderdate) as year, o_orderstatus as kind, count(*) as n_rows, cast(sum(o_orderkey) as bigint) as key_sum,
               case o_orderstatus when 'F' then 'fnma_sf' || year(o_orderdate) || 'c_loans' when 'O' then 'fhlmc_sf' || year(o_orderdate) || 'a_loans'
                    else 'fnma_mf' || year(o_orderdate) || 'b_loans' end as stem
        from orders group by all)
"""


@check(
    f"""
    with {_KINDS_SQL}
    select 1 as run, year, stem, case when kind = 'P' and year = 1995 then 'no dictionary' else 'written' end as status,
           case when not (kind = 'P' and year = 1995) then n_rows end as n_rows, case when not (kind = 'P' and year = 1995) then key_sum end as key_sum
    from files
    union all
    select 2, year, stem, 'no dictionary', null, null from files where kind = 'P' and year = 1995
    """
)
def convert_by_layout(spark, sf_dir):
    """Stored files of three layouts and many years through a store of dictionaries; a second run finds nothing new."""
    paths = DataPaths.under(scratch_dir(spark, "convert"))
    job = LoanFiles(spark, paths)
    plain_files(loan_lines(spark, sf_dir), paths.raw)
    job.write_dictionaries([loan_dictionaries(spark, sf_dir)])
    first = job.convert_all(types=LOAN_TYPES)
    again = job.convert_all(types=LOAN_TYPES)
    status = job.status_table(first).withColumn("run", F.lit(1)).union(job.status_table(again).withColumn("run", F.lit(2)))
    written = None
    for before, after, _, _ in KINDS.values():
        own = [c.target for c in first if c.status == "written" and f"/{before}" in c.target and c.target.endswith(f"{after}.parquet")]
        found = read_back(spark, own)
        written = found if written is None else written.union(found)
    return status.join(written.withColumn("run", F.lit(1)), ["run", "stem"], "left").select("run", "year", "stem", "status", "n_rows", "key_sum")


@check(
    f"""
    with {_KINDS_SQL}
    select stem || '.txt' as source_file, case when kind = 'P' and year = 1995 then 'without_dictionary' else kind end as kind,
           case when not (kind = 'P' and year = 1995) then year end as year,
           case when not (kind = 'P' and year = 1995) then n_rows end as n_rows, case when not (kind = 'P' and year = 1995) then key_sum end as key_sum
    from files
    """
)
def incremental_mixed(spark, sf_dir):
    """Files of three kinds that arrive in two portions, in three runs: each is converted by its own dictionary, once."""
    root = scratch_dir(spark, "mixed")
    paths = DataPaths.under(root)
    job = LoanFiles(spark, paths)
    job.write_dictionaries([loan_dictionaries(spark, sf_dir)])
    lines = loan_lines(spark, sf_dir)
    kind = F.regexp_extract("name", r"_(sf|mf)", 1)
    early = (F.col("year") < 1995) & (kind == "sf")

    def run():
        convert_mixed(
            spark, f"{paths.raw}/*", job.available_dictionaries, job.read_layouts, f"{root}/converted", f"{root}/checkpoint", LOAN_TYPES, glob="*.txt"
        ).awaitTermination()

    plain_files(lines.where(early), paths.raw)
    run()
    plain_files(lines.where(~early), paths.raw)
    run()
    run()
    found = None
    for status, (_, _, title, _) in KINDS.items():
        rows = spark.read.parquet(f"{root}/converted/{title}-*/batch_id=*")
        counted = rows.groupBy("source_file", F.lit(status).alias("kind"), "year").agg(F.count("*").alias("n_rows"), F.sum("o_orderkey").alias("key_sum"))
        found = counted if found is None else found.union(counted)
    lost = spark.read.parquet(f"{root}/converted/without_dictionary/batch_id=*")
    return found.union(lost.select("source_file", F.lit("without_dictionary"), F.lit(None).cast("int"), F.lit(None).cast("bigint"), F.lit(None).cast("bigint")))


def zip_files(members: DataFrame, root: str) -> None:
    """ZIP archives under ``root`` from rows of ``archive, position, member, data, damaged``, written as a stream.

    A member's ``data`` are its bytes, or the places of stored files, read one after the
    other.  A damaged member's recorded checksum is wrong.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = handle = packed = None
        for batch in batches:
            for archive, member, data, damaged in zip(batch["archive"], batch["member"], batch["data"], batch["damaged"]):
                if archive != name:
                    if packed is not None:
                        packed.close()
                        handle.close()
                    system, folder = archives._open(root)
                    system.create_dir(folder, recursive=True)
                    name, handle = archive, system.open_output_stream(f"{folder}/{archive}")
                    packed = zipfile.ZipFile(handle, "w", zipfile.ZIP_DEFLATED)
                if isinstance(data, bytes):
                    packed.writestr(member, data)
                else:
                    with packed.open(member, "w", force_zip64=True) as out:
                        for chunk in _read_on(data):
                            out.write(chunk)
                if damaged:
                    packed.filelist[-1].CRC ^= 1
        if packed is not None:
            packed.close()
            handle.close()
        yield pd.DataFrame({"n": [0]})

    members.repartition("archive").sortWithinPartitions("archive", "position").select("archive", "member", "data", "damaged").mapInPandas(write, "n int").collect()


@check(
    """
    with m as (
        select case when doc_id % 3 = 0 then 'pudb_' || (2005 + doc_id % 20) || '.zip' else source || '.ZIP' end as archive,
               lang || '/' || case when doc_id % 2 = 0 then cast(2000 + doc_id % 45 as varchar) || '_' else '' end
               || (n_chars % 500) || case doc_id % 4 when 0 then '.txt' when 1 then '.PDF' when 2 then '.csv' else '.TXT' end as member,
               doc_id as position, coalesce(text, '') as said
        from documents),
    r as (
        select *, case when member ilike '%.pdf' then 'dictionaries' when member ilike '%.txt' then 'raw' end as route,
               regexp_extract(member, '([^/]*)$', 1) as base_name,
               coalesce(case when archive like 'pudb%' then substr(archive, 6, 4) end,
                        case when regexp_matches(member, '/\\d{4}_') and cast(regexp_extract(member, '/(\\d{4})_', 1) as integer) <= 2035
                             then regexp_extract(member, '/(\\d{4})_', 1) end, 'unknown') as year
        from m where contains(member, 'en/') or contains(member, '2')),
    chosen as (
        select * from r where route is not null
        qualify row_number() over (partition by route, year, base_name order by archive, position) = 1)
    select archive, member, route || '/' || year || '/' || base_name as target,
           case when position % 97 = 13 then 'failed' else 'copied' end as status,
           case when position % 97 <> 13 then strlen(said) end as bytes, case when position % 97 <> 13 then md5(said) end as content
    from chosen
    union all
    select 'torn.zip', null, null, 'unreadable', null, null
    """
)
def archive_unpack(spark, sf_dir):
    """Documents as members of real archives, some damaged, one archive torn: what was unpacked where, and its content."""
    doc = F.col("doc_id")
    suffix = F.element_at(F.array(*[F.lit(x) for x in (".txt", ".PDF", ".csv", ".TXT")]), (doc % 4 + 1).cast("int"))
    members = table(spark, sf_dir, "documents").select(
        F.when(doc % 3 == 0, F.concat(F.lit("pudb_"), (doc % 20 + 2005).cast("string"), F.lit(".zip")))
        .otherwise(F.concat("source", F.lit(".ZIP"))).alias("archive"),
        F.concat(
            "lang", F.lit("/"), F.when(doc % 2 == 0, F.concat((doc % 45 + 2000).cast("string"), F.lit("_"))).otherwise(""),
            (F.col("n_chars") % 500).cast("string"), suffix,
        ).alias("member"),
        doc.alias("position"), F.coalesce("text", F.lit("")).cast("binary").alias("data"), (doc % 97 == 13).alias("damaged"),
    )
    root = scratch_dir(spark, "archives")
    zip_files(members, f"{root}/zips")
    plain_files(members.limit(1).select(F.lit("torn.zip").alias("name"), F.lit("no archive").alias("value")), f"{root}/zips")
    paths = DataPaths.under(root)
    report = LoanFiles(spark, paths).unpack_archives(f"{root}/zips", containing=["en/", "2"])
    last = lambda c, n: F.concat_ws("/", F.slice(F.split(c, "/"), F.lit(-n), F.lit(n)))
    content = spark.read.format("binaryFile").option("recursiveFileLookup", True).load([paths.raw, paths.dictionaries])
    content = content.select(last(F.col("path"), 3).alias("target"), F.md5("content").alias("content"))
    told = report.select(last(F.col("archive"), 1).alias("archive"), "member", F.when(F.col("target").isNotNull(), last(F.col("target"), 3)).alias("target"), "status", "bytes")
    return told.join(content, "target", "left").select("archive", "member", "target", "status", "bytes", "content")


@check(
    """
    select year(o_orderdate) as "Year", count(*) as n_loans, cast(sum(o_orderkey) as bigint) as record_sum,
           cast(sum(100000 + o_custkey) as bigint) as value_sum, count(case when o_orderkey % 3 <> 0 then 1 end) as n_notes
    from orders where o_orderstatus <> 'F' group by 1
    """
)
def multifamily_archives(spark, sf_dir):
    """Yearly multifamily files in archives, among other members, with the layout read from the text alone."""
    names = rule_tables.MULTIFAMILY_NAMES
    key = F.col("o_orderkey")
    given = {"Record Number": key, "Property Value": F.col("o_custkey") + 100_000, "Note Amount": F.when(key % 3 != 0, key % 1000)}
    cells = [given.get(n, (key + i) % 7 + 1).cast("string").alias(f"c{i}") for i, n in enumerate(names)]
    layout = Layout.of([(f"c{i}", 10) for i in range(len(names))])
    year = F.year("o_orderdate").cast("string")
    orders = table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select(year.alias("year"), "o_orderkey", *cells)
    lines = format_lines(orders, layout, keep=("year", "o_orderkey")).withColumnRenamed("year", "name")
    root = scratch_dir(spark, "multifamily-archives")
    yearly = sorted_parts(lines, f"{root}/lines", "o_orderkey")
    plain_files(spark.createDataFrame([("about.txt", "no loans")], "name string, value string"), root)
    about = [f"{root}/about.txt"]
    members = [
        m
        for y, parts in yearly.items()
        for m in ((f"FHFA_MFCensus{y}.zip", 0, "about.txt", about, False), (f"FHFA_MFCensus{y}.zip", 1, f"in/fnma_mf{y}c_loans.txt", parts, False))
    ]
    if yearly:
        first = min(yearly)
        members.append(("FHFA_SFNational.zip", 1, f"in/fnma_mf{first}c_loans.txt", yearly[first], False))  # not wanted
    zip_files(spark.createDataFrame(members, "archive string, position int, member string, data array<string>, damaged boolean"), f"{root}/zips")
    remove_dir(spark, f"{root}/lines")
    out = LoanFiles(spark, DataPaths.under(root)).combine_multifamily_archives(f"{root}/zips", root)
    loans = tables.read_delimited(spark, out)
    number = lambda n: F.col(n).cast("double").cast("bigint")
    return loans.groupBy(F.col("Year").cast("int").alias("Year")).agg(
        F.count("*").alias("n_loans"), F.sum(number("Record Number")).alias("record_sum"), F.sum(number("Property Value")).alias("value_sum"),
        F.count("Note Amount").alias("n_notes"),
    )


def sheet_lines(rows: DataFrame, name: str, columns: dict[str, Column], titles: Sequence[str] = (), order: str = "_order") -> DataFrame:
    """An exported sheet: title rows, a header, and the rows in order, for ``plain_files``."""
    spark = rows.sparkSession
    data = rows.select(F.col(order).alias("_order"), F.to_csv(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(columns.values())]), {"escape": '"'}).alias("value"))
    quoted = ",".join('"' + n + '"' if "\n" in n or "," in n else n for n in columns)
    heads = spark.createDataFrame([(i - len(titles) - 1, line) for i, line in enumerate([*titles, quoted])], "_order bigint, value string")
    return heads.union(data).select(F.lit(name).alias("name"), "_order", "value")


def stacked(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames)


@check(
    """
    with m as (
        select *, date '1960-01-01' + cast(c_custkey * 13 % 20000 as integer) as d from customer),
    e as (
        select *, cast(case when d > date '2010-06-30' then d - interval 100 year else d end as date) as fixed from m)
    select c_custkey as "FHFB ID", c_name as "MEMBER NAME", strftime(d, '%d.%m.%Y') as "APPROVAL DATE", null as "MEM DATE", c_nationkey as "CERT NO",
           case when c_custkey % 2 = 0 then 'FHLB_Members_Q12009_Release.csv' else 'FHLB_Members_Q42013_Release.csv' end as "SOURCE FILE",
           case when c_custkey % 2 = 0 then 2009 else 2013 end as "YEAR", case when c_custkey % 2 = 0 then 1 else 4 end as "QUARTER"
    from m where c_mktsegment in ('AUTOMOBILE', 'BUILDING')
    union all
    select c_custkey, c_name, strftime(fixed, '%Y-%m-%d'), case when c_nationkey <> 3 then strftime(fixed, '%Y-%m-%d') end, null,
           'FHLB_Members_Q32014_Release.csv', 2014, 3
    from e where c_mktsegment = 'FURNITURE'
    union all
    select c_custkey, c_name, strftime(fixed, '%Y-%m-%d'), null, null, 'FHLB_Members_Q12020_Release.csv', 2020, 1
    from e where c_mktsegment in ('HOUSEHOLD', 'MACHINERY')
    """
)
def member_sheets(spark, sf_dir):
    """Stored quarterly sheets, one with a title row, two with equal headers, through the whole job."""
    day = F.date_add(F.lit(datetime.date(1960, 1, 1)), (F.col("c_custkey") * 13 % 20000).cast("int"))
    short, key, name = F.date_format(day, "MM/dd/yy"), F.col("c_custkey"), F.col("c_name")
    customer = table(spark, sf_dir, "customer").withColumn("_order", key)
    old = {"FHFBID": key, "mem_name": name, "APPR DATE": F.date_format(day, "dd.MM.yyyy"), "Cert_No ": F.col("c_nationkey")}
    bad = F.when(F.col("c_nationkey") == 3, F.lit("bad")).otherwise(short)
    segment = lambda *names: customer.where(F.col("c_mktsegment").isin(*names))
    early = segment("AUTOMOBILE", "BUILDING")
    sheets = [
        sheet_lines(early.where(key % 2 == 0), "FHLB_Members_Q12009_Release.csv", old),
        sheet_lines(early.where(key % 2 == 1), "FHLB_Members_Q42013_Release.csv", old),
        sheet_lines(
            segment("FURNITURE"), "FHLB_Members_Q32014_Release.csv", {"FHFA ID": key, "Member_Name": name, "Appr_Date": short, "MEM DATE": bad, "Unnamed: 9": F.lit(1)}
        ),
        sheet_lines(segment("HOUSEHOLD", "MACHINERY"), "FHLB_Members_Q12020_Release.csv", {"fhfb_id": key, "MEM NAME": name, "APPROVAL_DATE": short}, ["Members,,"]),
        sheet_lines(customer, "FHLB_Members_Q12031_Release.csv", {"fhfb_id": key}),  # out of the range of years
    ]
    root = scratch_dir(spark, "members")
    plain_files(stacked(sheets), f"{root}/in", "_order")
    out = BankData(spark).combine_members(f"{root}/in", f"{root}/out", 2009, 2023, as_of=datetime.date(2010, 6, 30))
    found = tables.read_delimited(spark, out)
    whole = ("FHFB ID", "CERT NO", "YEAR", "QUARTER")
    return found.select(*[F.col(n).cast("bigint").alias(n) if n in whole else F.col(n) for n in found.columns])


@check(
    """
    select s_suppkey as "Fips County Code", s_name || case when s_suppkey % 5 = 0 then chr(10) || '"quoted", two lines' else '' end as "County Name",
           s_acctbal as "One-Unit Limit", case when s_nationkey >= 16 then s_nationkey end as "CBSA",
           case when s_nationkey < 8 then 2011 when s_nationkey < 16 then 2012 else 2013 end as "Year"
    from supplier
    """
)
def limit_sheets(spark, sf_dir):
    """Stored yearly limit sheets with title rows, two of them with equal headers, through the whole job."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    supplier = table(spark, sf_dir, "supplier").withColumn("_order", key)
    name = F.when(key % 5 == 0, F.concat("s_name", F.lit('\n"quoted", two lines'))).otherwise(F.col("s_name"))
    same = {"Fips\nCounty Code": key, "County Name": name, "One-Unit\nLimit": F.col("s_acctbal")}
    other = {"Fips County Code": key, "County Name": name, "One-Unit Limit": F.col("s_acctbal"), "CBSA": nation}
    sheets = [
        sheet_lines(supplier.where(nation < 8), "FullCountyLoanLimitList2011_HERA-BASED.csv", same, ["County limits,,"]),
        sheet_lines(supplier.where(nation < 3), "FullCountyLoanLimitList2011_HERA-again.csv", same, ["County limits,,"]),  # a second one of its year
        sheet_lines(supplier.where(nation.between(8, 15)), "FullCountyLoanLimitList2012_HERA-BASED.csv", same, ["County limits"]),
        sheet_lines(supplier.where(nation >= 16), "FullCountyLoanLimitList2013_HERA-BASED.csv", other, ['"County limits, all",,,']),
    ]
    root = scratch_dir(spark, "limits")
    plain_files(stacked(sheets), f"{root}/in", "_order")
    out = LoanLimits(spark).combine(f"{root}/in", f"{root}/out", 2011, 2013)
    found = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(out)
    kinds = {"Fips County Code": "bigint", "One-Unit Limit": "double", "CBSA": "bigint", "Year": "bigint"}
    return found.select(*[F.col(n).cast(kinds.get(n, "string")).alias(n) for n in found.columns])


@check(
    """
    with l as (select *, year(l_shipdate) + 20 as y from lineitem)
    select y as "Loan Acquisition Date", l_orderkey as "Loan Number", l_linenumber as "Line", case when y < 2019 then l_discount * 100 else l_discount end as "LTV Ratio Percent",
           l_linenumber as "Property Type", case when l_linenumber <> 4 then cast(l_shipdate as date) end as "Prepayment Penalty Expiration Date",
           case when y >= 2019 then cast(l_quantity as bigint) * 12 end as "Total Yearly Income Amount",
           (select count(*) from l) as n_all, (select count(*) from l where y < 2019 and l_suppkey % 2 = 0) as n_old
    from l where y >= 2018
    """
)
def acq_import_combine(spark, sf_dir):
    """Yearly bank exports and a stored name map, imported, combined, and cut to what recent years use."""
    year = F.year("l_shipdate") + 20
    items = table(spark, sf_dir, "lineitem").withColumns({"y": year, "_order": F.col("l_orderkey") * 10 + F.col("l_linenumber")})
    root = scratch_dir(spark, "acquisitions")
    sheets = []
    for y in range(2015, 2022):
        day = F.when(F.col("l_linenumber") == 4, F.lit("12/31/9999" if y < 2019 else "9999-12-31")).otherwise(
            F.date_format("l_shipdate", "M/d/yyyy" if y < 2019 else "yyyy-MM-dd")
        )
        columns = {
            "Unnamed: 0": F.col("_order"), "yr": F.col("y"), "Loan Acquisition Date": F.col("y"), "No, of Loan": F.col("l_orderkey"), "Line": F.col("l_linenumber"),
            "LTV": F.col("l_discount"), "Property Type": F.concat(F.lit("PT0"), F.col("l_linenumber").cast("string")), "Prepayment Penalty Expiration Date": day,
        }
        if y < 2019:
            columns["Old Col"] = F.when(F.col("l_suppkey") % 2 == 0, F.col("l_suppkey"))
        else:
            columns["Total Yearly Income Amount"] = F.col("l_quantity").cast("bigint")
        sheets.append(sheet_lines(items.where(F.col("y") == y), tables.bank_export_name(y), columns))
    names = [(0, "yr,Year"), (1, "LTV,LTV Ratio Percent"), (2, '"No, of Loan",Loan Number'), (3, "not there,Nothing")]
    sheets.append(spark.createDataFrame(names, "_order bigint, value string").select(F.lit("fields.csv").alias("name"), "_order", "value"))
    plain_files(stacked(sheets), f"{root}/raw", "_order")
    banks = BankData(spark)
    banks.import_acquisitions(f"{root}/raw", f"{root}/clean", f"{root}/raw/fields.csv", 2015, 2021)
    whole, recent = [spark.read.parquet(p) for p in banks.combine_acquisitions(f"{root}/clean", f"{root}/out", 2015, 2021)]
    counts = whole.agg(F.count("*").alias("n_all"), F.count("Old Col").alias("n_old"))
    return recent.join(F.broadcast(counts))  # one row of counts
