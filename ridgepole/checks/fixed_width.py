"""Fixed-width parsing and layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgepole.checks.registry import check, table
from ridgepole.config import DataPaths
from ridgepole.operators.fixed_width import format_lines, parse_lines, parse_lines_inferred
from ridgepole.operators.layout import Layout, column_spans, describe_fields, usable_fields
from ridgepole.plans.loan_files import LoanFiles
from ridgepole.session import scratch_dir
from ridgepole.sources import sinks

LINE_ITEM = Layout.of(
    [
        ("l_orderkey", 19),
        ("l_partkey", 19),
        ("l_suppkey", 19),
        ("l_linenumber", 4),
        ("l_quantity", 12),
        ("l_extendedprice", 18),
        ("l_discount", 8),
        ("l_tax", 8),
        ("l_returnflag", 1),
        ("l_linestatus", 1),
        ("l_shipdate", 10),
    ]
).typed(
    {
        "l_orderkey": "bigint",
        "l_partkey": "bigint",
        "l_suppkey": "bigint",
        "l_linenumber": "bigint",
        "l_quantity": "double",
        "l_extendedprice": "decimal(18,2)",
        "l_discount": "double",
        "l_tax": "double",
        "l_shipdate": "date",
    }
)


def line_item_lines(spark: SparkSession, sf_dir: str, as_bytes: bool = True) -> DataFrame:
    """Whole line items as records."""
    items = table(spark, sf_dir, "lineitem").withColumns(
        {
            "l_extendedprice": F.col("l_extendedprice").cast("decimal(18,2)"),
            "l_shipdate": F.col("l_shipdate").cast("date"),
        }
    )
    return format_lines(items, LINE_ITEM, as_bytes=as_bytes)


@check(
    """
    select l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as bigint) as l_linenumber, l_quantity,
           cast(cast(l_extendedprice as decimal(18,2)) as double) as l_extendedprice,
           l_discount, l_tax, l_returnflag, l_linestatus, cast(l_shipdate as date) as l_shipdate
    from lineitem
    """
)
def fixed_width_parse(spark, sf_dir):
    parsed = parse_lines(line_item_lines(spark, sf_dir), LINE_ITEM)
    return parsed.withColumn("l_extendedprice", F.col("l_extendedprice").cast("double"))


@check(
    """
    select l_returnflag, count(*) as n_items, cast(sum(cast(l_quantity as bigint)) as bigint) as sum_qty,
           cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as sum_price,
           min(cast(l_shipdate as date)) as first_ship, max(cast(l_shipdate as date)) as last_ship
    from lineitem group by l_returnflag
    """
)
def fixed_width_agg(spark, sf_dir):
    return summary(parse_lines(line_item_lines(spark, sf_dir), LINE_ITEM))


def summary(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("l_returnflag").agg(
        F.count("*").alias("n_items"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("sum_qty"),
        F.sum("l_extendedprice").cast("double").alias("sum_price"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )


@check(
    """
    select l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as bigint) as l_linenumber, l_quantity,
           cast(cast(l_extendedprice as decimal(18,2)) as double) as l_extendedprice,
           l_discount, l_tax, l_returnflag, l_linestatus, cast(l_shipdate as date) as l_shipdate
    from lineitem
    """
)
def fixed_width_load(spark, sf_dir):
    """Stored lines and a stored dictionary, loaded together as a job would."""
    root = scratch_dir(spark, "load")
    line_item_lines(spark, sf_dir, as_bytes=False).write.text(f"{root}/lines.txt")
    dictionary = [(i + 1, f.width, f" {f.name} ") for i, f in enumerate(LINE_ITEM.fields)]
    described = spark.createDataFrame(dictionary, "`Field #` int, `Field Width` int, `Field Name` string")
    sinks.write_table(described.coalesce(1), f"{root}/dictionary.csv", "csv")
    job = LoanFiles(spark, DataPaths.under(root))
    loaded = job.load(f"{root}/lines.txt", f"{root}/dictionary.csv", types={f.name: f.type for f in LINE_ITEM.fields})
    return loaded.withColumn("l_extendedprice", F.col("l_extendedprice").cast("double"))


SHORT = Layout.of([("k", 19), ("p", 19), ("s", 19), ("flag", 1)]).typed({"k": "bigint", "p": "bigint", "s": "bigint"})


@check(
    """
    select l_orderkey as k,
           case when l_linenumber % 5 >= 2 then l_partkey end as p,
           case when l_linenumber % 5 >= 3 then l_suppkey end as s,
           case when l_linenumber % 5 >= 4 then l_returnflag end as flag
    from lineitem where l_linenumber % 5 >= 1
    """
)
def fixed_width_short_lines(spark, sf_dir):
    """Lines cut after some of their fields; a line cut to nothing disappears."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"),
        F.col("l_partkey").alias("p"),
        F.col("l_suppkey").alias("s"),
        F.col("l_returnflag").alias("flag"),
        (F.col("l_linenumber") % 5).alias("fields"),
    )
    lines = format_lines(items, SHORT, keep=("fields",))
    cut = lines.select(F.substring(F.col("value"), F.lit(1), F.col("fields") * 20).alias("value"))
    return parse_lines(cut, SHORT)


@check(
    """
    select o_orderkey, cast(o_totalprice as double) as o_totalprice, o_orderpriority,
           nullif(o_custkey, 7) as o_custkey
    from orders
    """
)
def fixed_width_infer_types(spark, sf_dir):
    """Types read from all values: whole numbers (with blanks), decimals, text."""
    return parse_lines_inferred(untyped_order_lines(spark, sf_dir), UNTYPED_ORDER)


UNTYPED_ORDER = Layout.of([("o_orderkey", 19), ("o_totalprice", 18), ("o_orderpriority", 20), ("o_custkey", 19)])


def untyped_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("o_custkey", F.when(F.col("o_custkey") != 7, F.col("o_custkey")))
    return format_lines(orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)")), UNTYPED_ORDER, as_bytes=True)


@check(
    """
    with lines as (
        select rpad(cast(o_orderkey as varchar), 19, ' ') || ' '
            || rpad(cast(o_custkey as varchar), 19, ' ') || ' '
            || rpad(o_orderstatus, 1, ' ') || ' '
            || rpad(cast(cast(o_totalprice as decimal(18,2)) as varchar), 18, ' ') || ' '
            || rpad(strftime(o_orderdate, '%Y-%m-%d'), 10, ' ') || ' '
            || rpad(o_orderpriority, 20, ' ') as value
        from orders),
    used as (
        select distinct i as pos from lines, generate_series(0, 91) t(i) where substr(value, i + 1, 1) not in (' ', '')),
    runs as (select pos, pos - row_number() over (order by pos) as run from used)
    select min(pos) as start, max(pos) - min(pos) + 1 as width from runs group by run
    """
)
def fixed_width_infer_layout(spark, sf_dir):
    return column_spans(spaced_order_lines(spark, sf_dir))


def spaced_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = Layout.of(
        [("o_orderkey", 19), ("o_custkey", 19), ("o_orderstatus", 1), ("o_totalprice", 18), ("o_orderdate", 10), ("o_orderpriority", 20)]
    )
    orders = table(spark, sf_dir, "orders").withColumns(
        {"o_totalprice": F.col("o_totalprice").cast("decimal(18,2)"), "o_orderdate": F.col("o_orderdate").cast("date")}
    )
    return format_lines(orders, layout, as_bytes=True)


def _labelled_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts in the role of dictionary rows: some nameless, some without a usable width."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        "p_brand",
        "p_partkey",
        F.when(key % 7 == 0, None).when(key % 11 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), "p_name")).alias("Field Name"),
        F.when(F.col("p_size") % 10 == 0, F.lit("n/a")).otherwise(F.col("p_size").cast("string")).alias("Field Width"),
    )


_LABELLED_SQL = """
    labelled as (
        select p_brand, p_partkey,
               case when p_partkey % 7 = 0 then 'None' when p_partkey % 11 = 0 then 'unnamed' else p_name end as base,
               cast(p_size as bigint) as column_width
        from part where p_size % 10 <> 0)
"""


@check(
    f"""
    with {_LABELLED_SQL}
    select p_brand, p_partkey,
           base || case when nth > 1 then '_' || nth else '' end as column_name,
           column_width, column_start
    from (select *, row_number() over (partition by p_brand, base order by p_partkey) as nth,
                 cast(coalesce(sum(column_width + 1) over (partition by p_brand order by p_partkey
                      rows between unbounded preceding and 1 preceding), 0) as bigint) as column_start
          from labelled)
    """
)
def layout_build(spark, sf_dir):
    """Names, widths and start positions of one layout per brand."""
    fields = usable_fields(_labelled_parts(spark, sf_dir), keep=("p_brand", "p_partkey"))
    return describe_fields(fields, ["p_brand"], "p_partkey")


@check(
    """
    select p_partkey, p_name || case when nth > 1 then '_' || nth else '' end as column_name
    from (select p_partkey, p_name, row_number() over (partition by p_name order by p_partkey) as nth from part)
    """
)
def layout_dedupe_names(spark, sf_dir):
    """All parts as one document whose names repeat."""
    fields = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("column_name"), F.lit(1).alias("column_width"))
    return describe_fields(fields, [], "p_partkey").select("p_partkey", "column_name")
