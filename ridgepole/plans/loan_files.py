"""Enterprise loan files: archives, dictionaries, conversion, combination."""

from __future__ import annotations

import hashlib
import logging
import posixpath
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgepole.config import DataPaths, LoadOptions
from ridgepole.functions import paths, years
from ridgepole.operators import columns as cols
from ridgepole.operators.dictionary import ORDINALS, combine_tables
from ridgepole.operators.fixed_width import parse_lines, parse_lines_inferred
from ridgepole.operators.gaps import missing_preview, missing_ranges
from ridgepole.operators.halves import outer_join_halves
from ridgepole.operators.infer import infer_types, infer_types_by, with_types
from ridgepole.operators.keys import fill_from_yearly, tract_key_by_vintage
from ridgepole.operators.layout import Layout, describe_fields, infer_layout, usable_fields
from ridgepole.operators.resolve import dictionary_catalog, pending_files, resolve_dictionaries, years_between
from ridgepole.operators.rules import apply_rules
from ridgepole.operators.union import common_type, union_relaxed
from ridgepole.plans import rule_tables
from ridgepole.session import remove_dir, scratch_dir, tune
from ridgepole.sources import archives, files, sinks, tables
from ridgepole.sources.text_lines import read_lines

log = logging.getLogger(__name__)

_FILE = "_source_file"


def _file_key(path: str) -> str:
    return hashlib.md5("/".join(path.split("/")[-2:]).encode()).hexdigest()


@dataclass(frozen=True)
class Converted:
    source: str
    target: str
    status: str
    detail: str = ""


def with_census_key(df: DataFrame, year: str = "year", out: str = "census_string") -> DataFrame:
    """Add the tract key of the vintage each year uses; absent columns count as null."""

    def parts(names: Sequence[str]):
        return [cols.col(n) if n in df.columns else F.lit(None).cast("bigint") for n in names]

    key = tract_key_by_vintage(cols.col(year), parts(rule_tables.TRACT_2010), parts(rule_tables.TRACT_2020))
    return df.withColumn(out, key)


def merge_halves(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join the two halves of one enterprise-year; key types are aligned first."""
    keys = ("Enterprise Flag", "Record Number")
    aligned = []
    for side, other in ((left, right), (right, left)):
        types = {k: common_type([side.schema[k].dataType, other.schema[k].dataType]) for k in keys}
        aligned.append(
            side.select(*[cols.col(n).cast(types[n]).alias(n) if n in types else cols.col(n) for n in side.columns])
        )
    return outer_join_halves(*aligned, keys)


def yearly_income_sources(name: str, first_year: int, last_year: int) -> list[str]:
    """Spellings under which a yearly income was published, oldest year first."""
    return [s for y in range(first_year, last_year + 1) for s in (f"{y} {name}", f"{name} ({y})")]


class LoanFiles:
    def __init__(self, spark: SparkSession, data: DataPaths, options: LoadOptions | None = None) -> None:
        self.spark = tune(spark)
        self.data = data
        self.options = options or LoadOptions()

    # --- archives ---

    def unpack_archives(self, zip_folder: str, containing: Sequence[str] | None = None) -> DataFrame:
        """Unpack text records under raw and dictionaries under dictionaries, by year.

        ``containing`` keeps the members whose names hold one of these texts.
        Existing targets stay unless overwriting is on; then of two members with one
        target the last wins.  The work is done here, once; the result reports every
        member (``copied`` with its bytes, or ``failed``) and every ``unreadable`` archive.
        """
        listed = archives.list_members(self.spark, zip_folder)
        members = archives.routed_members(archives.members_containing(listed, containing), last=self.options.overwrite)
        root = F.when(F.col("route") == "raw", F.lit(self.data.raw)).otherwise(F.lit(self.data.dictionaries))
        targets = members.withColumn("target", F.concat_ws("/", root, F.col("year"), F.col("base_name")))
        for kind, folder, replace in (
            ("raw", self.data.raw, self.options.overwrite),
            ("dictionary", self.data.dictionaries, self.options.overwrite_dictionaries),
        ):
            if replace:
                continue
            present = files.list_files(self.spark, f"{folder}/*", recursive=False).select(
                F.lit(kind).alias("route"),
                F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("year"),
                paths.base_name(F.col("path")).alias("base_name"),
            )
            targets = targets.join(present, ["route", "year", "base_name"], "left_anti")
        # stored, so that looking at the report does not copy everything again
        report = sinks.write_table(archives.unpack(targets).union(archives.unreadable(listed)), scratch_dir(self.spark, "unpacked") + "/report")
        return self.spark.read.parquet(report)

    # --- dictionaries ---

    def write_dictionary(
        self, table_shapes: Sequence[DataFrame], year: int, stem: str, formats: Iterable[str] = ("csv", "parquet")
    ) -> DataFrame | None:
        """Normalise the tables of one document and store them; reports numbering gaps.

        Nothing is done when both forms exist and overwriting is off.
        """
        base = f"{self.data.dictionaries}/{year}/{stem}_combined"
        if not self.options.overwrite_dictionaries and all(files.exists(self.spark, f"{base}.{f}") for f in sinks.FORMATS):
            return None
        combined = combine_tables(table_shapes)
        if combined.select(ORDINALS[0]).distinct().limit(2).count() > 1:
            raise ValueError("the tables of more than one document; see write_dictionaries")
        # one file: its lines are the order of the fields, and a dictionary is as long as a record is wide
        ordered = combined.drop(*ORDINALS).repartition(1).sortWithinPartitions(cols.col("Field #"))
        for fmt in formats:
            sinks.write_table(ordered, f"{base}.{fmt}", fmt)
        gaps = missing_preview(missing_ranges(combined, [ORDINALS[0]], "Field #"), [ORDINALS[0]])
        for row in gaps.toLocalIterator():
            log.warning("%s skips %d field numbers, first %s", stem, row["missing_count"], row["missing"])
        return gaps

    def write_dictionaries(
        self,
        table_shapes: Sequence[DataFrame],
        years_list: list[int] | None = None,
        min_year: int | None = None,
        max_year: int | None = None,
        formats: Iterable[str] = sinks.FORMATS,
    ) -> DataFrame:
        """Normalise the extracted tables of all documents of all years and store them, in one job a format.

        The rows name their ``year`` and ``doc``; tables of different documents may differ in
        their columns.  Each document becomes one sorted file under
        ``store.<format>/year=<year>/document=<doc>``, with the order of its fields in a column of
        its own: a document goes to one task, and is as long as a record is wide.  Documents
        that are stored in both forms stay unless overwriting is on; others are replaced
        whole, so a job that is run again leaves the same.  Reports each document's number of
        fields and its numbering gaps.
        """
        wanted = [years_between(t, "year", years_list, min_year, max_year) for t in table_shapes]
        if not self.options.overwrite_dictionaries:
            there = self.stored_documents()
            wanted = [t.join(there, (t["year"] == there["_year"]) & (t["doc"] == there["_doc"]), "left_anti") for t in wanted]
        combined = combine_tables(wanted, within=("year",), relaxed=True)
        rest = [cols.col(n) for n in combined.columns if n not in {"year", "Field #", *ORDINALS}]
        fields = combined.select(
            cols.col("Field #").cast("bigint").alias(tables.FIELD_ORDER), cols.col("Field #"), *rest, F.col("year").cast("int").alias("year"), F.col("doc").alias("document")
        )
        kept = sinks.write_table(fields, scratch_dir(self.spark, "dictionaries") + "/fields")
        fields = self.spark.read.parquet(kept)
        keys = ["year", "document"]
        ordered = fields.repartition(*keys).sortWithinPartitions(*keys, tables.FIELD_ORDER)
        for fmt in formats:
            sinks.write_partitions(ordered, tables.store_path(self.data.dictionaries, fmt), keys, fmt)
        gaps = missing_preview(missing_ranges(fields, keys, tables.FIELD_ORDER), keys)
        counts = fields.groupBy(*keys).agg(F.count("*").alias("n_fields"))
        return counts.join(gaps, keys, "left").withColumn("missing_count", F.coalesce("missing_count", F.lit(0)))

    def stored_documents(self) -> DataFrame:
        """``_year, _doc`` of the documents that the store holds in both forms."""
        listed = self.available_dictionaries().where(F.col("dictionary_path").rlike(rf"/{tables.STORE}\.\w+/"))
        both = listed.groupBy("dictionary_year", "dictionary_name").agg(F.countDistinct("format").alias("n")).where(F.col("n") == len(sinks.FORMATS))
        return both.select(F.col("dictionary_year").alias("_year"), F.regexp_replace("dictionary_name", "_combined$", "").alias("_doc"))

    def layouts(self, fmt: str = "parquet", separator_width: int = 1) -> DataFrame:
        """Names, widths and start positions of the fields of every stored document, in one job."""
        keys = ("year", "document")
        fields = usable_fields(tables.read_store(self.spark, self.data.dictionaries, fmt), keep=(*keys, tables.FIELD_ORDER))
        return describe_fields(fields, keys, tables.FIELD_ORDER, separator_width)

    def available_dictionaries(self) -> DataFrame:
        """Dictionaries under ``<root>/<year>`` and in the store; a Parquet one may be a folder of parts."""
        listed = files.list_files(self.spark, f"{self.data.dictionaries}/*")
        # the parts of a table folder all stand for the folder
        whole = F.regexp_replace("path", r"(\.(?:parquet|csv))/[^/]*$", "$1")
        single = dictionary_catalog(listed.select(whole.alias("path")).distinct())
        pattern = rf"^(.*/{tables.STORE}\.(csv|parquet)/year=(\d+)/document=([^/]+))/[^/]+$"
        part = lambda n: F.regexp_extract("path", pattern, n)
        stored = listed.where(F.col("path").rlike(pattern)).select(
            part(3).cast("int").alias("dictionary_year"),
            F.concat(F.url_decode(F.replace(part(4), F.lit("+"), F.lit("%2B"))), F.lit("_combined")).alias("dictionary_name"),
            part(2).alias("format"),
            part(1).alias("dictionary_path"),
        )
        return single.union(stored.distinct())

    def resolve_years(
        self,
        years_list: list[int] | None = None,
        min_year: int | None = None,
        max_year: int | None = None,
        prefer: str = "parquet",
        strict: bool = False,
    ) -> DataFrame:
        """Raw files of the wanted years with the dictionary that describes each."""
        listing = files.list_files(self.spark, f"{self.data.raw}/*", recursive=False)
        catalog = years_between(files.raw_text_catalog(listing), "year", years_list, min_year, max_year)
        return resolve_dictionaries(catalog, self.available_dictionaries(), "file_name", prefer, strict)

    # --- fixed-width loading ---

    def load(
        self,
        data_path: str,
        dictionary_path: str,
        encoding: str = "latin-1",
        dictionary_format: str | None = None,
        name_column: str = "Field Name",
        width_column: str = "Field Width",
        separator_width: int = 1,
        types: dict[str, str] | None = None,
        infer: bool = False,
    ) -> DataFrame:
        """One record file as a table.

        Columns are text unless ``types`` declares them; ``infer=True`` reads the types
        from all values with one extra pass.
        """
        for needed in (data_path, dictionary_path):
            if not files.exists(self.spark, needed):
                raise FileNotFoundError(needed)
        layout = tables.read_layout(
            self.spark, dictionary_path, dictionary_format, name_column, width_column, separator_width
        )
        lines = read_lines(self.spark, data_path, encoding)
        if infer:
            return parse_lines_inferred(lines, layout)
        return parse_lines(lines, layout.typed(types or {}))

    def convert_all(
        self,
        years_list: list[int] | None = None,
        min_year: int | None = None,
        max_year: int | None = None,
        encoding: str = "latin-1",
        separator_width: int = 1,
        prefer: str = "parquet",
        types: dict[str, str] | None = None,
        infer: bool = False,
    ) -> list[Converted]:
        """Convert every raw file that has a dictionary to ``<clean>/<year>/<stem>.parquet``.

        Files of one layout are one job, however many they are: one scan and one write without
        a shuffle, dealt into a folder for each file, which is then moved to its place and
        marked.  Only where such a job fails, its files are converted one by one, so one bad
        file does not stop the rest.  Inferred types are those of each file's own values, read
        in one more pass over a layout's files; files of equal types are then one job.
        A target counts as done only once it is marked.  Of files with one target (``a.txt``
        and ``a.TXT``) the first by path is converted.
        """
        found = self.resolve_years(years_list, min_year, max_year, prefer)
        if not self.options.overwrite:
            found = pending_files(found, self.converted_catalog())
        # as many rows as there are files
        rows = [r.asDict() for r in found.orderBy("year", "stem", "path").toLocalIterator()]
        known = self.read_layouts({r["dictionary_path"] for r in rows if r["dictionary_path"] is not None}, separator_width)
        done: dict[str, Converted] = {}
        targets: set[str] = set()
        batches: dict[Layout, list[dict]] = {}
        for row in rows:
            row["target"] = f"{self.data.clean}/{row['year']}/{row['stem']}.parquet"
            layout = known.get(row["dictionary_path"])
            if row["dictionary_path"] is None:
                log.warning("no dictionary for %s", row["path"])
                done[row["path"]] = Converted(row["path"], row["target"], "no dictionary")
            elif row["target"] in targets:
                done[row["path"]] = Converted(row["path"], row["target"], "same target")
            elif isinstance(layout, Exception):
                done[row["path"]] = self._failed(row, layout)
            else:
                targets.add(row["target"])
                batches.setdefault(layout.typed(types or {}), []).append(row)

        def convert(batch: tuple[Layout, list[dict]]) -> list[Converted]:
            layout, rows = batch
            try:
                for typed, same in (self._inferred(layout, rows, encoding) if infer else {layout: rows}).items():
                    self._convert(typed, same, encoding)
            except Exception as problem:  # reported per file, the others go on
                if len(rows) == 1:
                    return [self._failed(rows[0], problem)]
                log.warning("converting %d files together failed, they go one by one: %s", len(rows), problem)
                return [c for row in rows for c in convert((layout, [row]))]
            return [Converted(row["path"], row["target"], "written") for row in rows]

        with ThreadPoolExecutor(self.options.parallel_jobs) as pool:
            for result in pool.map(convert, batches.items()):
                done.update({c.source: c for c in result})
        return [done[row["path"]] for row in rows]

    def _failed(self, row: dict, problem: Exception) -> Converted:
        log.error("converting %s failed: %s", row["path"], problem)
        return Converted(row["path"], row["target"], "failed", str(problem).split("\n")[0])

    def _lines_by_file(self, rows: Sequence[dict], encoding: str) -> DataFrame:
        """Lines of several files in one scan, each with a hash of its file's name, which no folder name has to escape."""
        lines = read_lines(self.spark, [r["path"] for r in rows], encoding)
        path = F.url_decode(F.replace("file_path", F.lit("+"), F.lit("%2B")))
        return lines.withColumn(_FILE, F.md5(F.regexp_extract(path, r"([^/]*/[^/]*)$", 1).cast("binary")))

    def _inferred(self, layout: Layout, rows: Sequence[dict], encoding: str) -> dict[Layout, list[dict]]:
        """Files by the types of their own values, all read in one pass."""
        as_text = parse_lines(self._lines_by_file(rows, encoding), layout.typed(dict.fromkeys(layout.names, "string")), keep=(_FILE,))
        types, empty = infer_types_by(as_text, _FILE, layout.names), dict.fromkeys(layout.names, "double")
        found: dict[Layout, list[dict]] = {}
        for row in rows:
            found.setdefault(layout.typed(types.get(_file_key(row["path"]), empty)), []).append(row)
        return found

    def _convert(self, layout: Layout, rows: Sequence[dict], encoding: str) -> None:
        """Files of one layout, read and written together; each ends in its own marked folder."""
        parsed = parse_lines(self._lines_by_file(rows, encoding), layout, keep=(_FILE,))
        staged = scratch_dir(self.spark, "converted")
        sinks.write_partitions(parsed, staged, [_FILE])
        try:
            for row in rows:
                folder = f"{staged}/{_FILE}={_file_key(row['path'])}"
                if files.exists(self.spark, folder):
                    files.publish(self.spark, folder, row["target"])
                else:  # a file without records
                    sinks.write_new(self.spark, parsed.where("false").drop(_FILE), row["target"], overwrite=True)
        finally:
            remove_dir(self.spark, staged)

    def read_layouts(self, paths_wanted: Iterable[str], separator_width: int = 1) -> dict[str, Layout | Exception]:
        """Layouts of dictionaries by path, those of a store in one job; an unreadable one gives its error."""
        found: dict[str, Layout | Exception] = {}
        wanted = sorted(paths_wanted)
        for fmt in sinks.FORMATS:
            root = f"/{tables.STORE}.{fmt}/"
            inside = {p: p.rsplit("/", 2) for p in wanted if root in p}
            if not inside:
                continue
            fields = usable_fields(tables.read_store(self.spark, self.data.dictionaries, fmt), keep=("year", "document", tables.FIELD_ORDER))
            years_wanted = sorted({int(y.removeprefix("year=")) for _, y, _ in inside.values()})
            by_document: dict[tuple, list] = {}
            # as many rows as the wanted years' records have fields
            for r in fields.where(F.col("year").isin(years_wanted)).orderBy("year", "document", tables.FIELD_ORDER).toLocalIterator():
                by_document.setdefault((r["year"], r["document"]), []).append((r["column_name"], r["column_width"]))
            for path, (_, year, document) in inside.items():
                pairs = by_document.get((int(year.removeprefix("year=")), unquote(document.removeprefix("document="))), [])
                try:
                    found[path] = Layout.of(pairs, separator_width)
                except ValueError as problem:
                    found[path] = problem

        def read(path: str) -> Layout | Exception:
            try:
                return tables.read_layout(self.spark, path, separator_width=separator_width)
            except Exception as problem:  # reported per file
                return problem

        rest = [p for p in wanted if p not in found]
        with ThreadPoolExecutor(self.options.parallel_jobs) as pool:
            found.update(zip(rest, pool.map(read, rest)))
        return found

    def status_table(self, done: Sequence[Converted]) -> DataFrame:
        """One row for each file of a conversion: year, stem, source, target, status, detail."""
        rows = [(c.source, c.target, c.status, c.detail) for c in done]
        listed = self.spark.createDataFrame(rows, "source string, target string, status string, detail string")
        year = F.regexp_extract("target", r"([^/]+)/[^/]+$", 1).cast("int")
        return listed.select(year.alias("year"), paths.stem(F.col("target")).alias("stem"), *listed.columns)

    def converted_catalog(self) -> DataFrame:
        """Year and stem of the committed tables under the clean root."""
        done = [(p,) for p in files.glob(self.spark, f"{self.data.clean}/*/*.parquet/_SUCCESS")]
        folder = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
        return self.spark.createDataFrame(done, "path string").select(
            F.regexp_extract(folder, r"([^/]+)/[^/]+$", 1).cast("int").alias("year"),
            paths.stem(folder).alias("stem"),
        )

    # --- combination ---

    def clean_years(self) -> list[int]:
        listed = files.list_files(self.spark, f"{self.data.clean}/*/*.parquet", recursive=False)
        year = years.year_folder(F.regexp_extract("path", r"([^/]+)/[^/]+/[^/]+$", 1))
        found = listed.select(year.alias("year")).where("year is not null").distinct()
        return [r["year"] for r in found.orderBy("year").toLocalIterator()]

    def combined(self, pattern: str, found: Sequence[tuple[int, str, str]]) -> DataFrame:
        return union_relaxed(
            [cols.tag(self.spark.read.parquet(path), Year=year, Enterprise=who) for year, who, path in found]
        )

    def combine_by_type(
        self,
        pattern: str,
        enterprises: Iterable[str] = tables.ENTERPRISES,
        years_list: Iterable[int] | None = None,
        min_year: int | None = None,
        max_year: int | None = None,
        output_path: str | None = None,
        fmt: str = "parquet",
    ) -> str:
        """All converted tables of one kind (``sf{year}c``) as one table with provenance."""
        if fmt not in sinks.FORMATS:
            raise ValueError(f"output format must be one of {sinks.FORMATS}")
        chosen = tables.checked_enterprises(enterprises)
        wanted = sorted({int(y) for y in years_list}) if years_list is not None else self.clean_years()
        if min_year is not None or max_year is not None:
            # The open end of a half-open range
            low = 2008 if min_year is None else min_year
            high = 2035 if max_year is None else max_year
            wanted = [y for y in wanted if low <= y <= high]
        found = tables.converted_paths(self.spark, self.data.clean, pattern, chosen, wanted)
        low, high = (min(wanted), max(wanted)) if wanted else (None, None)
        target = output_path or f"{self.data.clean}/combined/{sinks.combined_name(self.spark, pattern, low, high, chosen, fmt)}"
        return sinks.write_table(self.combined(pattern, found), target, fmt)

    # --- split and yearly delimited releases ---

    def read_typed(self, path: str) -> DataFrame:
        raw = tables.read_delimited(self.spark, path)
        return with_types(raw, infer_types(raw))

    def combine_halves(self, folder: str, year: int) -> str:
        frames = []
        for who in sorted(tables.ENTERPRISES):
            halves = [self.read_typed(f"{folder}/{who}_sf{year}c_loans_file{n}.csv.gz") for n in (1, 2)]
            frames.append(merge_halves(*halves))
        return sinks.write_delimited(union_relaxed(frames), f"{folder}/gse_sf{year}c_loans.csv.gz")

    def yearly_loans(self, folder: str, first_year: int, last_year: int) -> DataFrame:
        return union_relaxed(
            [
                cols.tag(self.read_typed(f"{folder}/gse_sf{year}c_loans.csv.gz"), year=year)
                for year in range(first_year, last_year + 1)
            ]
        )

    def combine_before_2018(self, raw_folder: str, clean_folder: str, first_year: int = 2010, last_year: int = 2017) -> str:
        whole = self.yearly_loans(raw_folder, first_year, last_year)
        for income in rule_tables.YEARLY_INCOMES:
            # Years whose income columns carry the year
            whole = fill_from_yearly(whole, income, yearly_income_sources(income, 2012, 2017))
        return sinks.write_delimited(whole, f"{clean_folder}/gse_sfc_loans_{first_year}-{last_year}.csv.gz")

    def clean_since_2018(self, whole: DataFrame, first_year: int, last_year: int) -> DataFrame:
        for income in rule_tables.YEARLY_INCOMES:
            whole = fill_from_yearly(whole, income, yearly_income_sources(income, first_year, last_year))
        return with_census_key(apply_rules(whole, rule_tables.loan_rules()))

    def combine_since_2018(self, raw_folder: str, clean_folder: str, first_year: int = 2018, last_year: int = 2023) -> list[str]:
        cleaned = self.clean_since_2018(self.yearly_loans(raw_folder, first_year, last_year), first_year, last_year)
        base = f"{clean_folder}/gse_sfc_loans_clean_{first_year}-{last_year}"
        stored = sinks.write_table(cleaned, f"{base}.parquet")
        # the text form is written from the stored table, not by cleaning twice
        return [sinks.write_delimited(self.spark.read.parquet(stored), f"{base}.csv.gz"), stored]

    def load_multifamily(self, path: str, encoding: str = "latin-1") -> DataFrame:
        """A multifamily file without a dictionary: spans from the text, fixed names."""
        lines = read_lines(self.spark, path, encoding)
        layout = infer_layout(lines, rule_tables.MULTIFAMILY_NAMES)
        parsed = parse_lines_inferred(lines, layout)
        name = posixpath.basename(path)
        return cols.tag(parsed, Year=int(name.split("_mf")[1].split("c_")[0]))

    def combine_multifamily_archives(
        self, zip_folder: str, save_folder: str, archive_holds: str = "MFCensus", containing: Sequence[str] = ("loans.txt",)
    ) -> str:
        """All multifamily records in the archives of a folder, as one table.

        The wanted members are unpacked side by side to the scratch folder, each under its
        archive and place, so members of one name do not replace each other.  Members that
        cannot be read are logged and left out; without any readable one it is an error.
        """
        listed = archives.list_members(self.spark, zip_folder).where(paths.base_name(F.col("archive")).contains(archive_holds))
        folder = scratch_dir(self.spark, "multifamily")
        base = paths.base_name(F.col("member"))
        target = F.concat_ws("/", F.lit(folder), F.md5(F.col("archive").cast("binary")), F.col("position").cast("string"), base)
        wanted = archives.members_containing(listed, containing).withColumn("target", target)
        report = sinks.write_table(archives.unpack(wanted).union(archives.unreadable(listed)), f"{folder}/report")
        # one row for each yearly file
        outcome = self.spark.read.parquet(report).orderBy("archive", "target").collect()
        for row in outcome:
            if row["status"] != "copied":
                log.warning("%s of %s left out: %s", row["member"], row["archive"], row["detail"])
        found = [r["target"] for r in outcome if r["status"] == "copied"]
        if not found:
            raise FileNotFoundError(f"no readable member of {zip_folder} holds one of {list(containing)}")
        return self.combine_multifamily(found, save_folder)

    def combine_multifamily(self, source_paths: Sequence[str], save_folder: str) -> str:
        whole = union_relaxed([self.load_multifamily(p) for p in source_paths])
        return sinks.write_delimited(whole, f"{save_folder}/combined_multifamily.csv", compression="none")
