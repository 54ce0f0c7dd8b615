"""Sinks, layers, archives, links and incremental conversion."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgepole.checks.registry import check, table
from ridgepole.functions import paths
from ridgepole.operators.fixed_width import format_lines
from ridgepole.operators.infer import infer_types, with_types
from ridgepole.operators.layout import Layout
from ridgepole.plans.medallion import Medallion
from ridgepole.session import scratch_dir
from ridgepole.sources import archives, links, sinks, tables
from ridgepole.streaming.incremental import convert_new, parsed_stream


def _loans(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.year("o_orderdate").alias("year"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("enterprise_flag"),
    )


@check(
    """
    select year(o_orderdate) as year, case when o_orderstatus <> 'P' then o_orderstatus end as enterprise_flag,
           count(*) as n_loans, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
    from orders group by all
    """
)
def hive_partition_roundtrip(spark, sf_dir):
    """Partitioned by year and a flag that is null at times, then read back."""
    path = sinks.write_hive([_loans(spark, sf_dir)], scratch_dir(spark, "hive") + "/loans")
    return spark.read.parquet(path).groupBy("year", "enterprise_flag").agg(
        F.count("*").alias("n_loans"), F.sum("amount").cast("double").alias("total")
    )


@check(
    """
    select o_orderkey, cast(cast(o_totalprice as decimal(18,2)) as double) as amount
    from orders where year(o_orderdate) = 1998 and o_orderstatus = 'F'
    """
)
def hive_partition_prune(spark, sf_dir):
    """A filter on the partition columns reads only the matching folders."""
    path = sinks.write_hive([_loans(spark, sf_dir)], scratch_dir(spark, "hive") + "/loans")
    return spark.read.parquet(path).where("year = 1998 and enterprise_flag = 'F'").select(
        "o_orderkey", F.col("amount").cast("double").alias("amount")
    )


@check("select c_custkey, c_name, c_nationkey, c_acctbal, nullif(c_mktsegment, 'BUILDING') as c_mktsegment from customer")
def pipe_csv_roundtrip(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    path = sinks.write_delimited(customer, scratch_dir(spark, "pipe") + "/customer.csv.gz")
    raw = tables.read_delimited(spark, path)
    return with_types(raw, infer_types(raw))


@check(
    """
    select o_orderstatus, count(*) as n_loans, cast(sum(o_orderkey) as bigint) as key_sum
    from orders where o_orderstatus <> 'P' group by 1
    """
)
def write_modes(spark, sf_dir):
    """A second write to a finished table is skipped, a forced one replaces it."""
    path = scratch_dir(spark, "modes") + "/loans.parquet"
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey")
    sinks.write_new(spark, orders.where("o_orderstatus = 'P'"), path, overwrite=False)
    sinks.write_new(spark, orders.where("o_orderstatus <> 'P'"), path, overwrite=True)
    sinks.write_new(spark, orders, path, overwrite=False)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(
        F.count("*").alias("n_loans"), F.sum("o_orderkey").alias("key_sum")
    )


@check(
    """
    select event_type, count(*) as n_events, cast(sum(cast(value as decimal(18,2))) as double) as total
    from events group by 1
    """
)
def silver_build(spark, sf_dir):
    """A CSV and a Parquet bronze table, a user transform, a Parquet silver table."""
    layers = Medallion(spark, scratch_dir(spark, "medallion"), "events")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    even = F.col("user_id") < 50
    sinks.write_table(events.where(even), f"{layers.paths.bronze}/first.csv", "csv")
    sinks.write_table(events.where(~even), f"{layers.paths.bronze}/second.parquet")
    schema = "event_id bigint, user_id bigint, event_type string, value double"

    def per_type(df):
        return df.groupBy("event_type").agg(
            F.count("*").alias("n_events"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")
        )

    return spark.read.parquet(layers.build_silver(transform=per_type, schema=schema))


@check(
    """
    select base_name, archive, member, position
    from (select split_part(url, '/', 3) as archive, url as member, page_id as position,
                 regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1) as base_name from pages)
    qualify row_number() over (partition by base_name order by archive desc, position desc) = 1
    """
)
def bronze_promote(spark, sf_dir):
    """Pages stand for archive members: of equal base names the last one wins."""
    members = table(spark, sf_dir, "pages").select(
        F.element_at(F.split("url", "/"), 3).alias("archive"), F.col("url").alias("member"), F.col("page_id").alias("position")
    )
    flat = members.withColumn("_full", F.col("member")).withColumn("member", F.regexp_replace("member", r"[?#].*$", ""))
    return archives.bronze_members(flat, allowed=None).select("base_name", "archive", F.col("_full").alias("member"), "position")


@check(
    """
    with m as (
        select case when doc_id % 3 = 0 then 'pudb_' || (2005 + doc_id % 20) || '.zip' else source || '.ZIP' end as archive,
               lang || '/' || case when doc_id % 2 = 0 then cast(2000 + doc_id % 45 as varchar) || '_' else '' end
               || (n_chars % 500) || case doc_id % 4 when 0 then '.txt' when 1 then '.PDF' when 2 then '.csv' else '.TXT' end as member,
               doc_id as position
        from documents),
    r as (
        select *, case when member ilike '%.pdf' then 'dictionary' when member ilike '%.txt' then 'raw' end as route,
               regexp_extract(member, '([^/]*)$', 1) as base_name,
               coalesce(case when archive like 'pudb%' then substr(archive, 6, 4) end,
                        case when regexp_matches(member, '/\\d{4}_') and cast(regexp_extract(member, '/(\\d{4})_', 1) as integer) <= 2035
                             then regexp_extract(member, '/(\\d{4})_', 1) end, 'unknown') as year
        from m)
    select route, year, base_name, archive, member, position from r where route is not null
    qualify row_number() over (partition by route, year, base_name order by archive, position) = 1
    """
)
def archive_routing(spark, sf_dir):
    """Documents stand for archive members: routed by suffix and year, first per target."""
    doc = F.col("doc_id")
    suffix = F.element_at(F.array(*[F.lit(x) for x in (".txt", ".PDF", ".csv", ".TXT")]), (doc % 4 + 1).cast("int"))
    members = table(spark, sf_dir, "documents").select(
        F.when(doc % 3 == 0, F.concat(F.lit("pudb_"), (doc % 20 + 2005).cast("string"), F.lit(".zip")))
        .otherwise(F.concat("source", F.lit(".ZIP"))).alias("archive"),
        F.concat(
            "lang", F.lit("/"),
            F.when(doc % 2 == 0, F.concat((doc % 45 + 2000).cast("string"), F.lit("_"))).otherwise(""),
            (F.col("n_chars") % 500).cast("string"), suffix,
        ).alias("member"),
        doc.alias("position"),
    )
    return archives.routed_members(members)


_LINKS_SQL = """
    hrefs as (
        select page_id, url, unnest(list_zip(h, range(len(h)))) as pair
        from (select page_id, url, regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
                  '(?is)<a(?:\\s(?:[^>"'']|"[^"]*"|''[^'']*'')*?)?\\shref\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s>"'']+)', 1) as h from pages)),
    links as (
        select page_id, pair[2] as position, trim(regexp_replace(pair[1], '^["'']|["'']$', '', 'g')) as href,
               regexp_extract(url, '^(https?://[^/?#]*)', 1) as site
        from hrefs),
    named as (
        select page_id, position, href, case when href like 'http%' then href else site || href end as file_url,
               regexp_extract(regexp_replace(regexp_replace(href, '[?#].*$', ''), '^https?://[^/]*', ''), '([^/]*)$', 1) as file_name
        from links where href <> '')
"""


@check(f"with {_LINKS_SQL} select page_id, position, href, file_url, file_name from named where file_name <> ''")
def page_links(spark, sf_dir):
    return links.page_links(table(spark, sf_dir, "pages"))


@check(
    f"""
    with {_LINKS_SQL}
    select page_id, position, href, file_url, file_name from named
    where contains(lower(file_name), 'th') or contains(lower(file_name), 'en')
    qualify row_number() over (partition by file_name order by page_id, position) = 1
    """
)
def page_links_filtered(spark, sf_dir):
    """Links by substring (the test pages' links have no suffix), first one per file name."""
    found = links.page_links(table(spark, sf_dir, "pages"))
    return links.first_per_file(links.wanted_links(found, None, ["TH", "en"]))


EVENT_RECORD = Layout.of([("event_id", 19), ("user_id", 19), ("event_type", 20), ("value", 12)]).typed(
    {"event_id": "bigint", "user_id": "bigint", "value": "double"}
)


@check(
    """
    select 'events_' || case when user_id < 50 then 2018 else 2019 end || '.txt' as source_file,
           case when user_id < 50 then 2018 else 2019 end as year, event_id, user_id, event_type, value
    from events
    """
)
def incremental_convert(spark, sf_dir):
    """Three runs over a growing folder: one file, one more file, nothing new."""
    root = scratch_dir(spark, "incremental")
    events = table(spark, sf_dir, "events")

    def arrive(year, where):
        format_lines(events.where(where), EVENT_RECORD).write.text(f"{root}/incoming/events_{year}.txt")

    def run():
        # a table folder per arrival: its name stands in for the file name of its parts
        records = parsed_stream(spark, f"{root}/incoming/*", EVENT_RECORD, name_level=1)
        convert_new(records, f"{root}/clean", f"{root}/checkpoint").awaitTermination()

    arrive(2018, "user_id < 50")
    run()
    arrive(2019, "user_id >= 50")
    run()
    run()
    return spark.read.parquet(f"{root}/clean").select(
        "source_file", "year", "event_id", "user_id", "event_type", "value"
    )


@check(
    """
    select ext as extension, stem, count(*) as n_pages
    from (select regexp_extract(base, '^.+(\\.[^.]*)$', 1) as ext, regexp_replace(base, '^(.+)\\.[^.]*$', '\\1') as stem
          from (select regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1) as base from pages))
    group by all
    """
)
def path_parts(spark, sf_dir):
    base = F.regexp_replace("url", r"[?#].*$", "")
    return table(spark, sf_dir, "pages").groupBy(
        paths.extension(base).alias("extension"), paths.stem(base).alias("stem")
    ).agg(F.count("*").alias("n_pages"))
