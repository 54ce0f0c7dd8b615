"""Dictionary tables, resolution, years."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgepole.checks.registry import check, table
from ridgepole.functions import text, years
from ridgepole.operators.dedupe import keep_first
from ridgepole.operators.dictionary import combine_tables, label_role
from ridgepole.operators.expand import expand_numbers, explode_tokens
from ridgepole.operators.gaps import missing_numbers, missing_preview, missing_ranges
from ridgepole.operators.resolve import pending_files as not_yet_converted
from ridgepole.operators.resolve import resolve_dictionaries, years_between
from ridgepole.plans.limits import first_path_per_year


@check(
    """
    select p_partkey, key as label_key,
           case when key = 'field#' then 'number' when key in ('fieldname', 'variablename', 'name') then 'name' end as role
    from (select p_partkey, regexp_replace(lower(
              case p_partkey % 5 when 0 then 'Field #' when 1 then 'FIELD_ ' || chr(10) || '#' when 2 then 'Variable ' || chr(10) || 'Name'
                   when 3 then p_name else 'Na me' end), '[\\s_]+', '', 'g') as key
          from part)
    """
)
def label_normalize(spark, sf_dir):
    pick = F.col("p_partkey") % 5
    label = (
        F.when(pick == 0, "Field #").when(pick == 1, "FIELD_ \n#").when(pick == 2, "Variable \nName")
        .when(pick == 3, F.col("p_name")).otherwise("Na me")
    )
    keyed = table(spark, sf_dir, "part").select("p_partkey", text.label_key(label).alias("label_key"))
    return keyed.withColumn("role", label_role(F.col("label_key")))


def _cells(spark, sf_dir):
    """Number cells in every spelling: single, range with any dash, list, reversed, none."""
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    end = (F.col("p_size") + F.col("p_partkey") % 4).cast("string")
    far = (F.col("p_size") + 10).cast("string")
    cell = (
        F.when(key % 5 == 0, size)
        .when(key % 5 == 1, F.concat(size, F.lit("–"), end))
        .when(key % 5 == 2, F.concat(size, F.lit(" — "), end, F.lit(", "), far))
        .when(key % 5 == 3, F.concat(far, F.lit("-"), size, F.lit(" , no "), size))
        .otherwise(F.lit("n/a"))
    )
    name = F.when(key % 2 == 0, F.concat("p_name", F.lit(" 1-"), (key % 4 + 1).cast("string"))).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", cell.alias("Field_ #"), name.alias("Variable Name"))


_CELLS_SQL = """
    cells as (
        select p_partkey, case p_partkey % 5
                   when 0 then cast(p_size as varchar)
                   when 1 then p_size || '-' || (p_size + p_partkey % 4)
                   when 2 then p_size || ' - ' || (p_size + p_partkey % 4) || ', ' || (p_size + 10)
                   when 3 then (p_size + 10) || '-' || p_size || ' , no ' || p_size
                   else 'n/a' end as cell,
               case when p_partkey % 2 = 0 then p_name || ' 1-' || (p_partkey % 4 + 1) else p_name end as label
        from part),
    tokens as (select p_partkey, label, trim(unnest(string_split(cell, ','))) as token from cells),
    bounds as (
        select *, try_cast(nullif(regexp_extract(token, '(\\d+)', 1), '') as bigint) as s,
               coalesce(try_cast(nullif(regexp_extract(token, '\\d+\\s*-\\s*(\\d+)', 1), '') as bigint),
                        try_cast(nullif(regexp_extract(token, '(\\d+)', 1), '') as bigint)) as e
        from tokens),
    numbers as (select *, unnest(generate_series(s, e)) as n from bounds where s is not null and e >= s)
"""


@check(f"with {_CELLS_SQL} select p_partkey, token from tokens")
def token_explode(spark, sf_dir):
    return explode_tokens(_cells(spark, sf_dir), "Field_ #").select("p_partkey", "token")


@check(f"""with {_CELLS_SQL} select p_partkey, label as "Variable Name", n as "Field #" from numbers""")
def range_expand(spark, sf_dir):
    return expand_numbers(_cells(spark, sf_dir), "Field_ #")


@check(
    f"""
    with {_CELLS_SQL},
    named as (
        select *, try_cast(nullif(regexp_extract(label, '(\\d+)\\s*-\\s*(\\d+)\\s*$', 1), '') as bigint) as a,
               try_cast(nullif(regexp_extract(label, '(\\d+)\\s*-\\s*(\\d+)\\s*$', 2), '') as bigint) as b
        from numbers)
    select p_partkey, n as "Field #", case when b - a = e - s then a + n - s end as "NameNum",
           case when b - a = e - s then trim(regexp_replace(label, '\\s*\\d+\\s*-\\s*\\d+\\s*$', '')) || ' ' || (a + n - s)
                else label end as "Variable Name"
    from named
    """
)
def range_expand_names(spark, sf_dir):
    return expand_numbers(_cells(spark, sf_dir), "Field_ #", "Variable Name")


@check(
    f"""
    with {_CELLS_SQL},
    rows as (
        select 'Brand ' || (p_partkey % 3) as doc, p_partkey // 100 as page, 1 as table_no, p_partkey as row_no,
               n as "Field #", label, token, s, e
        from numbers)
    select doc, page, table_no, row_no, "Field #", case when b - a = e - s then a + "Field #" - s end as "NameNum",
           case when b - a = e - s then trim(regexp_replace(label, '\\s*\\d+\\s*-\\s*\\d+\\s*$', '')) || ' ' || (a + "Field #" - s)
                else label end as "Variable Name"
    from (select *, try_cast(nullif(regexp_extract(label, '(\\d+)\\s*-\\s*(\\d+)\\s*$', 1), '') as bigint) as a,
                 try_cast(nullif(regexp_extract(label, '(\\d+)\\s*-\\s*(\\d+)\\s*$', 2), '') as bigint) as b from rows)
    qualify row_number() over (partition by doc, "Field #" order by page, table_no, row_no) = 1
    """
)
def dictionary_combine(spark, sf_dir):
    """Raw tables of three documents to one clean relation, first row per number."""
    key = F.col("p_partkey")
    described = _cells(spark, sf_dir).select(
        F.concat(F.lit("Brand "), (key % 3).cast("string")).alias("doc"),
        F.floor(key / 100).alias("page"),
        F.lit(1).alias("table_no"),
        key.alias("row_no"),
        "Field_ #",
        "Variable Name",
    )
    other = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return combine_tables([described, other])


@check(
    """
    select o_custkey, o_orderkey, cast(o_orderdate as date) as o_orderdate, o_totalprice
    from orders qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1
    """
)
def dedupe_keep_first(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice"
    )
    return keep_first(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


_GAPS_SQL = """
    spans as (select o_orderstatus, min(o_orderkey) as lo, max(o_orderkey) as hi from orders group by 1),
    gaps as (
        select s.o_orderstatus, s.n as missing
        from (select o_orderstatus, unnest(generate_series(lo, hi)) as n from spans) s
        anti join orders o on s.o_orderstatus = o.o_orderstatus and s.n = o.o_orderkey)
"""


@check(f"with {_GAPS_SQL} select * from gaps")
def gap_detect(spark, sf_dir):
    """Order numbers each status skips between its least and greatest."""
    ranges = missing_ranges(table(spark, sf_dir, "orders"), ["o_orderstatus"], "o_orderkey")
    return missing_numbers(ranges, ["o_orderstatus"])


@check(
    f"""
    with {_GAPS_SQL},
    ranked as (select *, row_number() over (partition by o_orderstatus order by missing) as r from gaps)
    select o_orderstatus, string_agg(missing, ',' order by missing) filter (where r <= 20) as missing,
           count(*) as missing_count
    from ranked group by 1
    """
)
def gap_preview(spark, sf_dir):
    ranges = missing_ranges(table(spark, sf_dir, "orders"), ["o_orderstatus"], "o_orderkey")
    shown = missing_preview(ranges, ["o_orderstatus"])
    return shown.withColumn("missing", F.array_join(F.col("missing").cast("array<string>"), ","))


@check(
    """
    select o_orderkey, list_max(list_filter(list_transform(list_filter(regexp_split_to_array(name, '[^0-9]+'), lambda x: length(x) = 4),
                                                          lambda x: cast(x as integer)), lambda y: y between 1990 and 2035)) as year
    from (select o_orderkey, case o_orderpriority
                     when '1-URGENT' then 'fnma_sf' || year(o_orderdate) || 'c_loans.txt'
                     when '2-HIGH' then 'rev' || (year(o_orderdate) + 3) || '_of_' || year(o_orderdate) || '.zip'
                     when '3-MEDIUM' then 'x' || year(o_orderdate) || '7.txt'
                     when '5-LOW' then 'a' || (year(o_orderdate) + 40) || 'b1989.txt'
                     else 'no year ' || o_orderkey end as name
          from orders)
    """
)
def year_infer(spark, sf_dir):
    y = F.year("o_orderdate")
    s = y.cast("string")
    name = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("fnma_sf"), s, F.lit("c_loans.txt")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("rev"), (y + 3).cast("string"), F.lit("_of_"), s, F.lit(".zip")))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("x"), s, F.lit("7.txt")))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("a"), (y + 40).cast("string"), F.lit("b1989.txt")))
        .otherwise(F.concat(F.lit("no year "), F.col("o_orderkey").cast("string")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", years.year_in_name(name).alias("year"))


@check(
    """
    select distinct cast(folder as integer) as year
    from (select case when o_orderpriority = '5-LOW' then 'misc' else cast(year(o_orderdate) as varchar) end as folder from orders)
    where folder <> 'misc' and cast(folder as integer) between 1996 and 1999
    """
)
def year_range_filter(spark, sf_dir):
    """Distinct year folders within bounds; folders that are no years are passed over."""
    folder = F.when(F.col("o_orderpriority") == "5-LOW", "misc").otherwise(F.year("o_orderdate").cast("string"))
    catalog = table(spark, sf_dir, "orders").select(years.year_folder(folder).alias("year"))
    return years_between(catalog, "year", lowest=1996, highest=1999).distinct().orderBy("year")


@check(
    """
    with files as (
        select o_orderkey,
               case when o_orderstatus = 'F' then 'fnma_' else 'fhlmc_' end
               || case o_custkey % 5 when 0 then 'mf' when 4 then 'xx' else 'sf' end
               || case when o_custkey % 31 = 0 then 'none' else cast(2008 + o_orderkey % 16 as varchar) end
               || case o_orderkey % 7 when 0 then 'a' when 1 then 'b' when 2 then 'c' when 3 then 'd' when 4 then 'b_units' when 5 then 'b_loans' else '' end
               || '.txt' as file_name
        from orders),
    parsed as (
        select *, try_cast(nullif(regexp_extract(file_name, '(?:sf|mf|xx)((?:19|20)\\d{2})', 1), '') as integer) as y,
               case when contains(file_name, 'sf') then 'sf' when contains(file_name, 'mf') then 'mf' else '' end as fam,
               regexp_extract(file_name, '(?:sf|mf)(?:19|20)\\d{2}([a-d])', 1) as letter,
               contains(file_name, 'units') as units
        from files),
    rules(fam, letter, units, name, pri) as (values
        ('sf', 'a', null, 'Single_Family_National_File_A', 1),
        ('sf', 'b', null, 'Single_Family_National_File_B', 1),
        ('sf', 'c', null, 'Single_Family_Census_Tract_File_C', 1),
        ('sf', 'd', null, 'Single_Family_National_File_C', 1),
        ('sf', '', null, 'Single_Family_National_File_C', 1),
        ('sf', '', null, 'Single_Family_Census_Tract_File_C', 2),
        ('sf', '', null, 'Single_Family_National_File_B', 3),
        ('sf', '', null, 'Single_Family_National_File_A', 4),
        ('mf', 'c', null, 'Multifamily_Census_Tract_File_C', 1),
        ('mf', 'other', true, 'Multifamily_National_File_Unit_Class-Level_Data_File_B', 1),
        ('mf', 'other', true, 'Multifamily_National_File_Property-Level_Data_File_B', 2),
        ('mf', 'other', false, 'Multifamily_National_File_Property-Level_Data_File_B', 1),
        ('mf', 'other', false, 'Multifamily_National_File_Unit_Class-Level_Data_File_B', 2),
        ('', '', null, 'Single_Family_National_File_C', 1),
        ('', '', null, 'Single_Family_Census_Tract_File_C', 2),
        ('', '', null, 'Single_Family_National_File_B', 3),
        ('', '', null, 'Single_Family_National_File_A', 4),
        ('', '', null, 'Multifamily_National_File_Property-Level_Data_File_B', 5),
        ('', '', null, 'Multifamily_National_File_Unit_Class-Level_Data_File_B', 6),
        ('', '', null, 'Multifamily_Census_Tract_File_C', 7)),
    offered as (
        select distinct 2008 + p_partkey % 16 as y,
               case p_size % 7 when 0 then 'Single_Family_National_File_A' when 1 then 'Single_Family_National_File_B'
                    when 2 then 'Single_Family_Census_Tract_File_C' when 3 then 'Single_Family_National_File_C'
                    when 4 then 'Multifamily_National_File_Property-Level_Data_File_B'
                    when 5 then 'Multifamily_National_File_Unit_Class-Level_Data_File_B'
                    else 'Multifamily_Census_Tract_File_C' end as name,
               case when p_brand < 'Brand#2' then 'parquet' else 'csv' end as format
        from part where p_size % 16 <> p_partkey % 16),
    matched as (
        select p.o_orderkey, p.y || '_' || o.name || '_combined.' || o.format as dictionary_path,
               row_number() over (partition by p.o_orderkey order by r.pri, case o.format when 'parquet' then 0 else 1 end) as rank
        from parsed p
        join rules r on p.fam = r.fam
             and r.letter = case when p.fam = 'mf' and p.letter <> 'c' then 'other' else p.letter end
             and (r.units is null or r.units = p.units)
        join offered o on o.y = p.y and o.name = r.name)
    select p.o_orderkey, p.file_name, p.y as file_year, m.dictionary_path
    from parsed p left join matched m on m.o_orderkey = p.o_orderkey and m.rank = 1
    """
)
def resolve_dictionary(spark, sf_dir):
    """File names of every family, letter and year against an incomplete set of dictionaries."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    letters = ["a", "b", "c", "d", "b_units", "b_loans", ""]
    letter = F.element_at(F.array(*[F.lit(x) for x in letters]), (order % 7 + 1).cast("int"))
    name = F.concat(
        F.when(F.col("o_orderstatus") == "F", "fnma_").otherwise("fhlmc_"),
        F.when(customer % 5 == 0, "mf").when(customer % 5 == 4, "xx").otherwise("sf"),
        F.when(customer % 31 == 0, "none").otherwise((order % 16 + 2008).cast("string")),
        letter,
        F.lit(".txt"),
    )
    files = table(spark, sf_dir, "orders").select("o_orderkey", name.alias("file_name"))
    titles = [
        "Single_Family_National_File_A",
        "Single_Family_National_File_B",
        "Single_Family_Census_Tract_File_C",
        "Single_Family_National_File_C",
        "Multifamily_National_File_Property-Level_Data_File_B",
        "Multifamily_National_File_Unit_Class-Level_Data_File_B",
        "Multifamily_Census_Tract_File_C",
    ]
    key, size = F.col("p_partkey"), F.col("p_size")
    title = F.element_at(F.array(*[F.lit(x) for x in titles]), (size % 7 + 1).cast("int"))
    offered = table(spark, sf_dir, "part").where(size % 16 != key % 16).select(
        (key % 16 + 2008).alias("dictionary_year"),
        F.concat((key % 16 + 2008).cast("string"), F.lit("_"), title, F.lit("_combined")).alias("dictionary_name"),
        F.when(F.col("p_brand") < "Brand#2", "parquet").otherwise("csv").alias("format"),
    )
    offered = offered.withColumn("dictionary_path", F.concat_ws(".", "dictionary_name", "format"))
    return resolve_dictionaries(files, offered, strict=True)


@check(
    """
    select year(o_orderdate) as year,
           min('/in/FullCountyLoanLimitList' || year(o_orderdate) || '_HERA-' || o_orderkey || '.csv') as path
    from orders where o_orderpriority <> '5-LOW' group by 1
    """
)
def first_per_group(spark, sf_dir):
    """First limits sheet per year by path; files of another kind are passed over."""
    year = F.year("o_orderdate").cast("string")
    name = F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("/in/Other"), year)).otherwise(
        F.concat(F.lit("/in/FullCountyLoanLimitList"), year, F.lit("_HERA-"), F.col("o_orderkey").cast("string"), F.lit(".csv"))
    )
    return first_path_per_year(table(spark, sf_dir, "orders").select(name.alias("path")))


@check(
    """
    select year(o_orderdate) as year, 'fnma_sf_' || o_orderkey as stem
    from orders where o_orderkey not in (select l_orderkey from lineitem)
    """
)
def pending_files(spark, sf_dir):
    """Orders stand for raw files, those with line items for converted ones."""
    year, stem = F.year("o_orderdate").alias("year"), F.concat(F.lit("fnma_sf_"), F.col("o_orderkey").cast("string")).alias("stem")
    orders = table(spark, sf_dir, "orders")
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    converted = orders.join(items, "o_orderkey", "left_semi").select(year, stem)
    return not_yet_converted(orders.select(year, stem), converted)
