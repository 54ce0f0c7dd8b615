"""Stacking, joining and pruning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgepole.checks.registry import check, table
from ridgepole.config import DataPaths
from ridgepole.functions import text
from ridgepole.operators import columns as cols
from ridgepole.operators.prune import recent_subset
from ridgepole.operators.union import union_relaxed, union_strict
from ridgepole.plans.loan_files import LoanFiles, merge_halves
from ridgepole.session import scratch_dir


@check(
    """
    select o_orderkey, o_custkey, o_totalprice, null::varchar as o_orderstatus, null::varchar as o_orderpriority, 1996 as "Year"
    from orders where o_orderdate < timestamp '1997-01-01'
    union all by name
    select o_orderkey, o_orderstatus, o_orderpriority, 1998 as "Year"
    from orders where o_orderdate >= timestamp '1997-01-01' and o_orderdate < timestamp '1999-01-01'
    union all by name
    select o_orderkey, o_totalprice, o_orderpriority, 2000 as "Year"
    from orders where o_orderdate >= timestamp '1999-01-01'
    """,
    name="union_relaxed",
)
def union_relaxed_columns(spark, sf_dir):
    """Releases with different columns; the year tag is a literal per release."""
    orders = table(spark, sf_dir, "orders")
    date = F.col("o_orderdate")
    first = orders.where(date < "1997-01-01").select("o_orderkey", "o_custkey", "o_totalprice")
    second = orders.where((date >= "1997-01-01") & (date < "1999-01-01")).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    third = orders.where(date >= "1999-01-01").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return union_relaxed([cols.tag(first, Year=1996), cols.tag(second, Year=1998), cols.tag(third, Year=2000)])


@check(
    """
    select o_orderkey, cast(o_custkey as varchar) as ref, o_totalprice as amount from orders where o_orderstatus = 'F'
    union all
    select o_orderkey, cast(o_custkey as varchar), floor(o_totalprice) from orders where o_orderstatus = 'O'
    union all
    select o_orderkey, 'C-' || o_custkey, null from orders where o_orderstatus not in ('F', 'O')
    """
)
def union_relaxed_types(spark, sf_dir):
    """bigint, int and text under one name; double and bigint under another."""
    orders = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    return union_relaxed(
        [
            orders.where(status == "F").select("o_orderkey", F.col("o_custkey").alias("ref"), F.col("o_totalprice").alias("amount")),
            orders.where(status == "O").select(
                "o_orderkey", F.col("o_custkey").cast("int").alias("ref"), F.floor("o_totalprice").alias("amount")
            ),
            orders.where(~status.isin("F", "O")).select(
                "o_orderkey", F.concat(F.lit("C-"), F.col("o_custkey").cast("string")).alias("ref")
            ),
        ]
    )


@check(
    """
    select l_returnflag, l_linestatus, count(*) as n_items, cast(sum(l_linenumber) as bigint) as line_sum
    from lineitem group by all
    """,
    name="union_strict",
)
def union_strict_counts(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    returned = F.col("l_returnflag") == "R"
    whole = union_strict([items.where(returned), items.where(~returned)])
    return whole.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n_items"), F.sum("l_linenumber").alias("line_sum")
    )


@check(
    """
    select greatest(1996, least(2000, year(o_orderdate) // 2 * 2)) as "Year",
           case when o_orderstatus = 'F' then 'fnma' else 'fhlmc' end as "Enterprise",
           count(*) as n_loans, count(case when o_orderstatus = 'F' then o_custkey end) as n_customers,
           cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
    from orders group by all
    """
)
def combine_by_type(spark, sf_dir):
    """Converted tables per year and enterprise, found by name pattern and combined.

    One enterprise lacks a column and stores amounts as text.
    """
    root = scratch_dir(spark, "combine")
    orders = table(spark, sf_dir, "orders").withColumn(
        "_year", F.greatest(F.lit(1996), F.least(F.lit(2000), F.floor(F.year("o_orderdate") / 2).cast("int") * 2))
    )
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    for year in (1996, 1998, 2000):
        loans = orders.where(F.col("_year") == year)
        loans.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", amount.alias("amount")).write.parquet(
            f"{root}/clean/{year}/fnma_sf{year}c.parquet"
        )
        loans.where("o_orderstatus <> 'F'").select("o_orderkey", amount.cast("string").alias("amount")).write.parquet(
            f"{root}/clean/{year}/fhlmc_sf{year}c.parquet"
        )
    combined = LoanFiles(spark, DataPaths.under(root)).combine_by_type("sf{year}c")
    return spark.read.parquet(combined).groupBy("Year", "Enterprise").agg(
        F.count("*").alias("n_loans"),
        F.count("o_custkey").alias("n_customers"),
        F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("total"),
    )


@check(
    """
    select o_orderpriority,
           regexp_replace('sfYYYY ' || o_orderpriority, '[^A-Za-z0-9_-]', '_', 'g')
               || '_' || min(year(o_orderdate)) || '-' || max(year(o_orderdate))
               || '_' || string_agg(distinct case when o_orderstatus = 'F' then 'fnma' else 'fhlmc' end, '-'
                                    order by case when o_orderstatus = 'F' then 'fnma' else 'fhlmc' end)
               || '.parquet' as label
    from orders group by o_orderpriority
    """
)
def combined_label(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderpriority",
        F.year("o_orderdate").alias("y"),
        F.when(F.col("o_orderstatus") == "F", "fnma").otherwise("fhlmc").alias("who"),
    )
    spans = orders.groupBy("o_orderpriority").agg(
        F.min("y").alias("low"), F.max("y").alias("high"), F.collect_set("who").alias("who")
    )
    label = text.combined_label(F.concat(F.lit("sfYYYY "), "o_orderpriority"), F.col("low"), F.col("high"), F.col("who"), "parquet")
    return spans.select("o_orderpriority", label.alias("label"))


@check(
    """
    with l as (
        select case when o_orderpriority < '3' then 1 else 2 end as flag,
               case when o_totalprice >= 20000 then o_orderkey end as record,
               o_totalprice as amount, o_orderdate as left_date
        from orders where o_orderstatus <> 'P'),
    r as (
        select case when o_orderpriority < '3' then 1 else 2 end as flag,
               case when o_orderkey <> 0 then o_orderkey end as record,
               o_custkey as amount, o_orderpriority as priority
        from orders where o_orderstatus <> 'F' or o_orderkey = 0)
    select coalesce(l.flag, r.flag) as "Enterprise Flag", coalesce(l.record, r.record) as "Record Number",
           l.amount as "Amount_x", cast(l.left_date as date) as "Left Date", r.amount as "Amount_y", r.priority as "Priority"
    from l full outer join r on l.flag is not distinct from r.flag and l.record is not distinct from r.record
    """
)
def outer_join_halves(spark, sf_dir):
    """Two halves that overlap in part; many null record numbers on one side, one on the other."""
    orders = table(spark, sf_dir, "orders")
    flag = F.when(F.col("o_orderpriority") < "3", 1).otherwise(2).alias("Enterprise Flag")
    left = orders.where("o_orderstatus <> 'P'").select(
        flag,
        F.when(F.col("o_totalprice") >= 20000, F.col("o_orderkey")).alias("Record Number"),
        F.col("o_totalprice").alias("Amount"),
        F.col("o_orderdate").cast("date").alias("Left Date"),
    )
    right = orders.where("o_orderstatus <> 'F' or o_orderkey = 0").select(
        flag,
        F.when(F.col("o_orderkey") != 0, F.col("o_orderkey")).alias("Record Number"),
        F.col("o_custkey").alias("Amount"),
        F.col("o_orderpriority").alias("Priority"),
    )
    return merge_halves(left, right)


@check(
    """
    select year(l_shipdate) + 20 as "Loan Acquisition Date", l_orderkey, l_linenumber, l_quantity,
           case when year(l_shipdate) + 20 > 2020 then l_tax end as late_column
    from lineitem where year(l_shipdate) + 20 >= 2018
    """
)
def acq_recent_columns(spark, sf_dir):
    """A column that stopped in 2018 and one that never had values disappear."""
    year = F.year("l_shipdate") + 20
    whole = table(spark, sf_dir, "lineitem").select(
        year.alias("Loan Acquisition Date"),
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.when(year < 2019, F.col("l_discount")).alias("retired_column"),
        F.when(year > 2020, F.col("l_tax")).alias("late_column"),
        F.lit(None).cast("string").alias("empty_column"),
    )
    return recent_subset(whole, "Loan Acquisition Date", rows_from=2018, columns_from=2019)
