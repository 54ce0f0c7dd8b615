"""Which data dictionary describes which data file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgepole.functions import paths, years

# Dictionary names, as <year>_<name>_combined.<format>.
SF_A = "Single_Family_National_File_A"
SF_B = "Single_Family_National_File_B"
SF_CENSUS = "Single_Family_Census_Tract_File_C"
SF_D = "Single_Family_National_File_C"
MF_PROPERTY = "Multifamily_National_File_Property-Level_Data_File_B"
MF_UNIT = "Multifamily_National_File_Unit_Class-Level_Data_File_B"
MF_CENSUS = "Multifamily_Census_Tract_File_C"

# Fixed values: (family, letter after the year, unit file?) -> names to try in turn.
# None stands for "any".
CANDIDATES = [
    ("sf", "a", None, [SF_A]),
    ("sf", "b", None, [SF_B]),
    ("sf", "c", None, [SF_CENSUS]),
    ("sf", "d", None, [SF_D]),
    ("sf", "", None, [SF_D, SF_CENSUS, SF_B, SF_A]),
    ("mf", "c", None, [MF_CENSUS]),
    ("mf", None, True, [MF_UNIT, MF_PROPERTY]),
    ("mf", None, False, [MF_PROPERTY, MF_UNIT]),
    ("", None, None, [SF_D, SF_CENSUS, SF_B, SF_A, MF_PROPERTY, MF_UNIT, MF_CENSUS]),
]

# Shorter spellings used by the 2011 release.
ALIASES_2011 = {
    SF_CENSUS: "Single_Family_Census_Tract_File",
    MF_CENSUS: "Multifamily_Census_Tract_File",
    MF_PROPERTY: "Multifamily_National_File_Property-Level_Data",
    MF_UNIT: "Multifamily_National_File_Unit_Class-Level_Data",
}

SIGNATURE = ("file_year", "family", "letter", "unit_file")


def with_signature(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Add what the name says about a file: year, family, letter, unit file."""
    base = paths.base_name(F.col(name))
    low = F.lower(base)
    return files.withColumns(
        {
            "file_year": years.year_in_name(base),
            "family": F.when(low.contains("sf"), "sf").when(low.contains("mf"), "mf").otherwise(""),
            "letter": F.regexp_extract(low, r"(?:sf|mf)(?:19|20)\d{2}([a-d])", 1),
            "unit_file": low.contains("units") & ~low.contains("loans"),
        }
    )


def signatures(spark: SparkSession) -> DataFrame:
    """Every signature a file name with a year can have."""
    each = lambda name, values: F.explode(F.array(*[F.lit(v) for v in values])).alias(name)
    rows = spark.range(years.FIRST_YEAR, years.LAST_YEAR + 1).select(F.col("id").cast("int").alias("file_year"))
    for name, values in (("family", ("sf", "mf", "")), ("letter", ("a", "b", "c", "d", "")), ("unit_file", (True, False))):
        rows = rows.select("*", each(name, values))
    return rows


def candidate_names(strict: bool = False):
    """Candidate dictionary names of a signature, in order of preference."""
    chosen = None
    for family, letter, unit, names in CANDIDATES:
        test = F.col("family") == family
        if letter is not None:
            test = test & (F.col("letter") == letter)
        if unit is not None:
            test = test & (F.col("unit_file") == F.lit(unit))
        spelled = []
        for n in names:
            spelled.append(F.lit(n))
            if not strict and n in ALIASES_2011:
                # a null in any other year: joins nothing
                spelled.append(F.when(F.col("file_year") == 2011, F.lit(ALIASES_2011[n])))
        value = F.array(*spelled)
        chosen = F.when(test, value) if chosen is None else chosen.when(test, value)
    return chosen


def resolve_dictionaries(
    files: DataFrame,
    available: DataFrame,
    name: str = "file_name",
    prefer: str = "parquet",
    strict: bool = False,
) -> DataFrame:
    """Add ``dictionary_path`` to every file, null where nothing fits.

    ``available`` has ``dictionary_year``, ``dictionary_name`` (``<year>_..._combined``
    stem), ``format`` and ``dictionary_path``.  The answer depends on the name signature
    only, and there are 46 years x 3 families x 5 letters x 2 of those, written down as
    a table of constants.  So the candidates are matched once per signature, that small
    table is what is broadcast to the files, and the files are read once and never shuffled.
    """
    if prefer not in {"csv", "parquet"}:
        raise ValueError("prefer must be csv or parquet")
    signed = with_signature(files, name)
    wanted = (
        signatures(files.sparkSession)
        .select(*SIGNATURE, F.posexplode(candidate_names(strict)).alias("_rank", "_name"))
        .select(
            *SIGNATURE,
            "_rank",
            F.col("file_year").alias("dictionary_year"),
            F.concat(F.col("file_year").cast("string"), F.lit("_"), F.col("_name"), F.lit("_combined")).alias("dictionary_name"),
        )
    )
    offered = (
        available.where(F.col("format").isin("csv", "parquet"))
        .groupBy(F.col("dictionary_year").cast("int").alias("dictionary_year"), "dictionary_name", "format")
        .agg(F.min("dictionary_path").alias("dictionary_path"))
    )
    order = F.struct(F.col("_rank"), F.when(F.col("format") == prefer, 0).otherwise(1))
    answer = (
        wanted.join(offered, ["dictionary_year", "dictionary_name"])
        .groupBy(*SIGNATURE)
        .agg(F.min_by("dictionary_path", order).alias("dictionary_path"))
    )
    return signed.join(F.broadcast(answer), list(SIGNATURE), "left").select(
        *[F.col(c) for c in files.columns], "file_year", "dictionary_path"
    )


def dictionary_catalog(listing: DataFrame, path: str = "path") -> DataFrame:
    """Available dictionaries among listed files: the parent folder is the year."""
    p = F.col(path)
    return listing.select(
        years.year_folder(F.regexp_extract(p, r"([^/]+)/[^/]+$", 1)).alias("dictionary_year"),
        paths.stem(p).alias("dictionary_name"),
        F.regexp_replace(paths.extension(p), r"^\.", "").alias("format"),
        p.alias("dictionary_path"),
    ).where(F.col("dictionary_year").isNotNull() & F.col("format").isin("csv", "parquet"))


def pending_files(catalog: DataFrame, converted: DataFrame, keys: tuple[str, ...] = ("year", "stem")) -> DataFrame:
    """Catalogue rows whose output does not exist yet."""
    return catalog.join(converted.select(*keys).distinct(), list(keys), "left_anti")


def years_between(
    catalog: DataFrame, year: str, years_list: list[int] | None = None, lowest: int | None = None, highest: int | None = None
) -> DataFrame:
    """Rows of the wanted years; an explicit list and bounds both apply."""
    wanted = catalog
    if years_list is not None:
        wanted = wanted.where(F.col(year).isin(*sorted({int(y) for y in years_list})))
    if lowest is not None:
        wanted = wanted.where(F.col(year) >= lowest)
    if highest is not None:
        wanted = wanted.where(F.col(year) <= highest)
    return wanted
