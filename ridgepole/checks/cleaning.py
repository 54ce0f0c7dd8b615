"""Cleaning rules, keys and headers."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ridgepole.checks.registry import check, table
from ridgepole.functions import dates, text, years
from ridgepole.operators import columns as cols
from ridgepole.operators.keys import fill_from_yearly
from ridgepole.operators.rules import (
    NullFrom,
    NumberAfterPrefix,
    Recode,
    Scale,
    ScaleToWhole,
    apply_rules,
    before,
    sentinels,
    since,
)
from ridgepole.operators.union import union_relaxed
from ridgepole.plans import rule_tables
from ridgepole.plans.bank_data import clean_acquisitions, harmonise_members
from ridgepole.plans.limits import harmonise_limits
from ridgepole.plans.loan_files import with_census_key, yearly_income_sources
from ridgepole.session import scratch_dir
from ridgepole.sources.tables import read_name_map, rename_and_drop

# the test tables span 1995-2001, so the change of units is moved into that span
CHANGED = 1998


def _items(spark, sf_dir, **columns):
    base = {"Year": F.year("l_shipdate")}
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", *[c.alias(n) for n, c in (base | columns).items()]
    )


@check(
    """
    select l_orderkey, l_partkey, l_linenumber, year(l_shipdate) as "Year",
           case when year(l_shipdate) < 1998 then l_discount * 100 else l_discount end as "LTV Ratio Percent",
           case when year(l_shipdate) < 1998 then l_tax * 100 else l_tax end as "Note Rate Percent"
    from lineitem
    """
)
def acq_scale_percent(spark, sf_dir):
    df = _items(spark, sf_dir, **{"LTV Ratio Percent": F.col("l_discount"), "Note Rate Percent": F.col("l_tax")})
    return apply_rules(df, [Scale(rule_tables.PERCENT_COLUMNS, 100, before("Year", CHANGED))])


@check(
    """
    select l_orderkey, l_partkey, l_linenumber, year(l_shipdate) as "Year",
           case when year(l_shipdate) >= 1998 then l_extendedprice * 12 else l_extendedprice end as "Total Yearly Income Amount"
    from lineitem
    """
)
def acq_annualize_income(spark, sf_dir):
    df = _items(spark, sf_dir, **{"Total Yearly Income Amount": F.col("l_extendedprice")})
    return apply_rules(df, [Scale(("Total Yearly Income Amount",), 12, since("Year", CHANGED))])


@check(
    """
    select l_orderkey, l_partkey, l_linenumber, year(l_shipdate) as "Year",
           case when year(l_shipdate) < 1998 and l_linenumber = 2 then 0 else l_linenumber end
               as "Borrower First Time Homebuyer Indicator"
    from lineitem
    """
)
def acq_indicator_recode(spark, sf_dir):
    df = _items(spark, sf_dir, **{"Borrower First Time Homebuyer Indicator": F.col("l_linenumber")})
    return apply_rules(df, [Recode(rule_tables.INDICATOR_COLUMNS, 2, 0, before("Year", CHANGED))])


@check(
    """
    select l_orderkey, l_partkey, l_linenumber, year(l_shipdate) as "Year",
           round_even((l_quantity / 8) * 100, 0) as "Census Tract Identifier"
    from lineitem
    """
)
def acq_tract_round(spark, sf_dir):
    """Eighths times 100 end in .5 often, so rounding half to even shows."""
    df = _items(spark, sf_dir, **{"Census Tract Identifier": F.col("l_quantity") / 8})
    return apply_rules(df, [ScaleToWhole(("Census Tract Identifier",), 100)])


@check("""select p_partkey, p_size as "Property Type" from part""")
def acq_property_type(spark, sf_dir):
    df = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit("PT"), text.zero_fill(F.col("p_size").cast("string"), 2)).alias("Property Type")
    )
    return apply_rules(df, [NumberAfterPrefix(("Property Type",), "PT")])


@check(
    """
    select l_orderkey, l_partkey, l_linenumber, year(l_shipdate) as "Year",
           case when l_quantity * 25 < 1000 then l_quantity * 25 end as "Total Debt Expense Ratio Percent"
    from lineitem
    """
)
def acq_cap_ratio(spark, sf_dir):
    df = _items(spark, sf_dir, **{"Total Debt Expense Ratio Percent": F.col("l_quantity") * 25})
    return apply_rules(df, [NullFrom(("Total Debt Expense Ratio Percent",), 1000)])


def _expiry(fmt: str, open_ended: str, bad: str, far: str):
    given = F.date_format("o_orderdate", fmt)
    return (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(open_ended))
        .when(F.col("o_custkey") == 1, F.lit(bad))
        .when(F.col("o_custkey") == 2, F.lit(far))
        .otherwise(given)
        .alias("Prepayment Penalty Expiration Date")
    )


@check(
    """
    select o_orderkey,
           case when o_orderpriority <> '1-URGENT' and o_custkey not in (1, 2) then cast(o_orderdate as date) end
               as "Prepayment Penalty Expiration Date"
    from orders
    """
)
def acq_date_parse(spark, sf_dir):
    """Two date formats by file year; open-ended, unreadable and out-of-span dates are null."""
    orders = table(spark, sf_dir, "orders")
    old = orders.where(F.year("o_orderdate") < CHANGED).select("o_orderkey", _expiry("M/d/yyyy", "12/31/9999", "13/45/1999", "01/01/1500"))
    new = orders.where(F.year("o_orderdate") >= CHANGED).select("o_orderkey", _expiry("yyyy-MM-dd", "9999-12-31", "n/a", "2300-01-01"))
    return union_relaxed([clean_acquisitions(old, CHANGED - 1, {}, CHANGED), clean_acquisitions(new, CHANGED, {}, CHANGED)])


@check(
    """
    with src as (
        select l_orderkey as "Loan Number", l_partkey, l_linenumber as line, year(l_shipdate) as y, l_quantity as q,
               l_extendedprice as price, l_discount as d, l_tax as t, cast(l_shipdate as date) as shipped
        from lineitem),
    a as (
        select *, case when y < 1998 then d * 100 else d end as ltv, case when y < 1998 then t * 100 else t end as rate,
               case when line = 1 then 999 when line = 2 then 999.99 else q * 25 end as debt0,
               case when line = 3 then 999 else q end as housing0
        from src),
    b as (
        select *, case when y < 1998 then debt0 * 100 else debt0 end as debt1,
               case when y < 1998 then housing0 * 100 else housing0 end as housing1
        from a)
    select "Loan Number", l_partkey, y as "Loan Acquisition Date", ltv as "LTV Ratio Percent", rate as "Note Rate Percent",
           case when debt1 >= 1000 or debt1 in (999, 999.99) then null else debt1 end as "Total Debt Expense Ratio Percent",
           case when housing1 >= 1000 or housing1 in (999, 999.99) then null else housing1 end as "Housing Expense Ratio Percent",
           case when y >= 1998 then price * 12 else price end as "Total Yearly Income Amount",
           case when y < 1998 and line = 2 then 0 else line end as "Borrower First Time Homebuyer Indicator",
           round_even((q / 8) * 100, 0) as "Census Tract Identifier",
           line as "Property Type",
           case when line + 92 = 98 then null else line + 92 end as "Unit 1 - Number of Bedrooms",
           case when line + 95 in (98, 99) then null else line + 95 end as "Borrower 2 Age at Application Years Count",
           case when line <> 4 then shipped end as "Prepayment Penalty Expiration Date"
    from b
    """
)
def acq_clean_full(spark, sf_dir):
    """All rules in order over an old and a new yearly file, then their union."""
    line, q, year = F.col("l_linenumber"), F.col("l_quantity"), F.year("l_shipdate")

    def release(file_year, fmt, open_ended, where):
        source = table(spark, sf_dir, "lineitem").where(where)
        raw = source.select(
            F.col("l_orderkey").alias("loan_no"),
            "l_partkey",
            year.alias("Year"),
            year.alias("Loan Acquisition Date"),
            F.col("l_discount").alias("LTV Ratio Percent"),
            F.col("l_tax").alias("Note Rate Percent"),
            F.when(line == 1, 999.0).when(line == 2, 999.99).otherwise(q * 25).alias("Total Debt Expense Ratio Percent"),
            F.when(line == 3, 999.0).otherwise(q).alias("Housing Expense Ratio Percent"),
            F.col("l_extendedprice").alias("Total Yearly Income Amount"),
            line.alias("Borrower First Time Homebuyer Indicator"),
            (q / 8).alias("Census Tract Identifier"),
            F.concat(F.lit("PT0"), line.cast("string")).alias("Property Type"),
            (line + 92).alias("Unit 1 - Number of Bedrooms"),
            (line + 95).alias("Borrower 2 Age at Application Years Count"),
            F.when(line == 4, F.lit(open_ended)).otherwise(F.date_format("l_shipdate", fmt)).alias("Prepayment Penalty Expiration Date"),
            F.lit("x").alias("Unnamed: 0"),
        )
        return clean_acquisitions(raw, file_year, {"loan_no": "Loan Number"}, CHANGED)

    return union_relaxed(
        [
            release(CHANGED - 1, "MM/dd/yyyy", "12/31/9999", year < CHANGED),
            release(CHANGED, "yyyy-MM-dd", "9999-12-31", year >= CHANGED),
        ]
    )


@check(
    """
    select l_orderkey, l_partkey, l_linenumber, year(l_shipdate) as "Year",
           case when l_linenumber + 92 <> 98 then l_linenumber + 92 end as "Unit 1 - Number of Bedrooms",
           case when l_linenumber + 95 not in (98, 99) then l_linenumber + 95 end as "Borrower 2 Age at Application Years Count",
           case when l_linenumber not in (1, 2) then l_quantity end as "Margin Rate Percent",
           case when l_linenumber <> 3 then l_orderkey end as "Unit 1 - Reported Rent"
    from lineitem
    """
)
def sentinel_to_null(spark, sf_dir):
    line = F.col("l_linenumber")
    df = _items(
        spark,
        sf_dir,
        **{
            "Unit 1 - Number of Bedrooms": line + 92,
            "Borrower 2 Age at Application Years Count": line + 95,
            "Margin Rate Percent": F.when(line == 1, 9999.0).when(line == 2, 99999.0).otherwise(F.col("l_quantity")),
            "Unit 1 - Reported Rent": F.when(line == 3, F.lit(9999999999)).otherwise(F.col("l_orderkey")),
        },
    )
    return apply_rules(df, sentinels(rule_tables.ACQUISITION_CODES))


@check(
    """
    select l_orderkey, l_partkey, l_linenumber, year(l_shipdate) as "Year",
           case when l_linenumber <> 4 then l_linenumber end as "Borrower Sex",
           case when l_linenumber + 2 <> 9 then l_linenumber + 2 end as "First-Time Home Buyer",
           case when l_linenumber <> 6 then l_linenumber end as "Automated Underwriting System (AUS) Name",
           case when l_linenumber <> 1 then l_extendedprice end as "Note Amount",
           case when l_linenumber <> 5 then l_linenumber + 4 end as "Co-Borrower  Race or
National Origin 3",
           case when l_linenumber not in (2, 3) then cast(l_linenumber as varchar) end as "Credit Score Model - Borrower"
    from lineitem
    """
)
def sentinel_to_null_loans(spark, sf_dir):
    """Loan codes; names match across spellings and line breaks, text codes too."""
    line = F.col("l_linenumber")
    df = _items(
        spark,
        sf_dir,
        **{
            "Borrower Sex": line,
            "First-Time Home Buyer": line + 2,
            "Automated Underwriting System (AUS) Name": line,
            "Note Amount": F.when(line == 1, 999999999.0).otherwise(F.col("l_extendedprice")),
            "Co-Borrower  Race or\nNational Origin 3": line + 4,
            "Credit Score Model - Borrower": F.when(line == 2, "9").when(line == 3, "99").otherwise(line.cast("string")),
        },
    )
    return apply_rules(df, rule_tables.loan_rules())


@check(
    """
    select o_orderkey, cast(case when d > date '1998-06-30' then d - interval 100 year else d end as date) as approved
    from (select o_orderkey, cast(strptime(strftime(o_orderdate, '%m/%d/%y'), '%m/%d/%y') as date) as d from orders)
    """
)
def century_fix(spark, sf_dir):
    written = F.date_format("o_orderdate", "MM/dd/yy")
    read = dates.two_digit_year(dates.strict_date(written, "M/d/yy"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.not_after(read, F.lit(datetime.date(1998, 6, 30))).alias("approved")
    )


@check(
    """
    select o_orderkey, case when o_orderstatus = 'O' and year(o_orderdate) < 1995 then o_totalprice + 1
                            when year(o_orderdate) >= 1995 or o_orderpriority = '1-URGENT' then o_totalprice end as "Local Area Median Income",
           case when o_orderstatus = 'F' then o_custkey
                when year(o_orderdate) >= 1999 then cast(o_orderkey as bigint) end as "Area Median Family Income"
    from orders
    """
)
def coalesce_year_columns(spark, sf_dir):
    """Year-tagged incomes, one filled per year; of two filled ones the earlier year wins."""
    year = F.year("o_orderdate")
    tagged = {f"{y} Local Area Median Income": F.when(year == y, F.col("o_totalprice")) for y in range(1995, 2003)}
    tagged["Area Median Family Income (1996)"] = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))
    tagged["1999 Area Median Family Income"] = F.when(year >= 1999, F.col("o_orderkey"))
    # some years spell the field plainly
    plain = F.when((F.col("o_orderstatus") == "O") & (year < 1995), F.col("o_totalprice") + 1).when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice"))
    tagged["Local Area Median Income"] = plain
    df = table(spark, sf_dir, "orders").select("o_orderkey", *[c.alias(n) for n, c in tagged.items()])
    for income in ("Local Area Median Income", "Area Median Family Income"):
        df = fill_from_yearly(df, income, yearly_income_sources(income, 1995, 2002))
    return df


@check(
    """
    select c_custkey, y as year,
           case when tract is not null then lpad(cast(cast(c_nationkey as bigint) * 1000000000 + county * 1000000 + tract as varchar), 11, '0') end
               as census_string
    from (select c_custkey, c_nationkey, 2018 + c_custkey % 6 as y, c_custkey % 1000 as county,
                 case when c_acctbal < 0 then null when 2018 + c_custkey % 6 < 2022 then c_custkey * 7 % 1000000
                      else c_custkey * 11 % 1000000 end as tract
          from customer)
    """
)
def tract_key(spark, sf_dir):
    key = F.col("c_custkey")
    known = F.col("c_acctbal") >= 0
    df = table(spark, sf_dir, "customer").select(
        "c_custkey",
        (key % 6 + 2018).alias("year"),
        F.col("c_nationkey").alias("US Postal State Code"),
        (key % 1000).alias("County - 2010 Census"),
        F.when(known, key * 7 % 1000000).alias("Census Tract - 2010 Census"),
        (key % 1000).alias("County - 2020 Census"),
        F.when(known, key * 11 % 1000000).alias("Census Tract - 2020 Census"),
    )
    return with_census_key(df).select("c_custkey", "year", "census_string")


@check("""select c_custkey as "FHFB ID", c_name as "MEMBER NAME", c_nationkey as "NATION", c_mktsegment, c_acctbal from customer""")
def rename_by_map(spark, sf_dir):
    """Names from a header-less map file; an entry for an absent column is ignored."""
    path = scratch_dir(spark, "names") + "/map.csv"
    pairs = [("c_custkey", "FHFB ID"), ("c_name", "MEMBER NAME"), ("c_nationkey", "NATION"), ("not there", "X")]
    spark.createDataFrame(pairs, "old string, new string").write.csv(path)
    return rename_and_drop(table(spark, sf_dir, "customer"), read_name_map(spark, path))


@check("select c_custkey, c_name from customer")
def drop_unnamed(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("Unnamed: 1"), "c_name", F.col("c_nationkey").alias("UNNAMED_3")
    )
    return cols.drop_unnamed(df)


@check(
    """
    select quarter(o_orderdate) as "QUARTER", year(o_orderdate) as "YEAR", count(*) as n_files
    from orders group by all
    """
)
def quarter_from_name(spark, sf_dir):
    d = F.col("o_orderdate")
    name = F.concat(F.lit("FHLB_Members_Q"), F.quarter(d).cast("string"), F.year(d).cast("string"), F.lit("_Release_Q9.csv"))
    named = table(spark, sf_dir, "orders").select(name.alias("name"))
    return named.groupBy(
        years.quarter_in_name(F.col("name")).alias("QUARTER"), years.quarter_year_in_name(F.col("name")).alias("YEAR")
    ).agg(F.count("*").alias("n_files"))


_SEGMENTS = {
    "FHLB_Members_Q12009_Release.csv": ("AUTOMOBILE", "BUILDING"),
    "FHLB_Members_Q32014_Release.csv": ("FURNITURE",),
    "FHLB_Members_Q12020_Release.csv": ("HOUSEHOLD", "MACHINERY"),
}


@check(
    """
    with m as (
        select *, date '1960-01-01' + cast(c_custkey * 13 % 20000 as integer) as d from customer),
    e as (
        select *, cast(case when d > date '2010-06-30' then d - interval 100 year else d end as date) as fixed from m)
    select c_custkey as "FHFB ID", c_name as "MEMBER NAME", strftime(d, '%d.%m.%Y') as "APPROVAL DATE", null as "MEM DATE",
           c_nationkey as "CERT NO", 'FHLB_Members_Q12009_Release.csv' as "SOURCE FILE", 2009 as "YEAR", 1 as "QUARTER"
    from m where c_mktsegment in ('AUTOMOBILE', 'BUILDING')
    union all
    select c_custkey, c_name, strftime(fixed, '%Y-%m-%d'),
           case when c_nationkey <> 3 then fixed end,
           null, 'FHLB_Members_Q32014_Release.csv', 2014, 3
    from e where c_mktsegment = 'FURNITURE'
    union all
    select c_custkey, c_name, strftime(fixed, '%Y-%m-%d'),
           null, null, 'FHLB_Members_Q12020_Release.csv', 2020, 1
    from e where c_mktsegment in ('HOUSEHOLD', 'MACHINERY')
    """
)
def members_harmonize(spark, sf_dir):
    """Three sheets whose headers, dates and columns drift."""
    day = F.date_add(F.lit(datetime.date(1960, 1, 1)), (F.col("c_custkey") * 13 % 20000).cast("int"))
    short = F.date_format(day, "MM/dd/yy")
    columns = {
        "FHLB_Members_Q12009_Release.csv": [
            F.col("c_custkey").alias("FHFBID"), F.col("c_name").alias("mem_name"),
            F.date_format(day, "dd.MM.yyyy").alias("APPR DATE"), F.col("c_nationkey").alias("Cert_No "),
        ],
        "FHLB_Members_Q32014_Release.csv": [
            F.col("c_custkey").alias("FHFA ID"), F.col("c_name").alias("Member_Name"), short.alias("Appr_Date"),
            F.when(F.col("c_nationkey") == 3, F.lit("bad")).otherwise(short).alias("MEM DATE"), F.lit(1).alias("Unnamed: 9"),
        ],
        "FHLB_Members_Q12020_Release.csv": [
            F.col("c_custkey").alias("fhfb_id"), F.col("c_name").alias("MEM NAME"), short.alias("APPROVAL_DATE"),
        ],
    }
    customer = table(spark, sf_dir, "customer")
    sheets = [
        harmonise_members(
            customer.where(F.col("c_mktsegment").isin(*segments)).select(*columns[name]), name, datetime.date(2010, 6, 30)
        )
        for name, segments in _SEGMENTS.items()
    ]
    return cols.drop_unnamed(union_relaxed(sheets))


@check(
    """
    select s_suppkey as "Fips County Code", s_name as "County Name", s_acctbal as "One-Unit Limit", null as "CBSA", 2011 as "Year"
    from supplier where s_nationkey < 12
    union all
    select s_suppkey, s_name, s_acctbal, s_nationkey, 2012 from supplier where s_nationkey >= 12
    """
)
def limits_combine(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    key, name = F.col("s_suppkey").alias("Fips\nCounty Code"), F.col("s_name").alias("County Name")
    limit = F.col("s_acctbal")
    first = supplier.where("s_nationkey < 12").select(key, name, limit.alias("One-Unit Limit"))
    second = supplier.where("s_nationkey >= 12").select(key, name, limit.alias("One-Unit\nLimit"), F.col("s_nationkey").alias("CBSA"))
    return union_relaxed([harmonise_limits(first, 2011), harmonise_limits(second, 2012)])
