"""Download links found on stored pages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgepole.functions import paths
from ridgepole.operators import columns as cols
from ridgepole.operators.dedupe import keep_first

# An anchor tag up to the value of its href attribute.  Quoted values of other attributes
# are stepped over; the loop never backtracks, so broken markup costs linear time.
ANCHOR = (
    r"""(?is)<a(?=[\s/])(?:(?!\shref\s*=)(?:[^>"']|"[^"]*"|'[^']*'))*+"""
    r"""\shref\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
)


def hrefs(html: Column) -> Column:
    """Link targets of all anchors of a page, in page order."""
    visible = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    raw = F.regexp_extract_all(visible, F.lit(ANCHOR), 1)

    def clean(value: Column) -> Column:
        bare = F.regexp_replace(value, r"""^["']|["']$""", "")
        for entity, char in (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
            bare = F.replace(bare, F.lit(entity), F.lit(char))
        return F.trim(bare)

    return F.transform(raw, clean)


def page_links(pages: DataFrame, keys: Iterable[str] = ("page_id",), url: str = "url", html: str = "html") -> DataFrame:
    """One row per link that names a file: position, absolute URL and file name."""
    k = [cols.col(x) for x in keys]
    links = pages.select(*k, cols.col(url).alias("_base"), F.posexplode(hrefs(cols.col(html))).alias("position", "href"))
    full = links.where(F.col("href") != "").select(
        *k,
        F.col("position").cast("bigint").alias("position"),
        "href",
        paths.absolute_url(F.col("_base"), F.col("href")).alias("file_url"),
    )
    return full.withColumn("file_name", paths.base_name(paths.url_path(F.col("file_url")))).where(F.col("file_name") != "")


def wanted_links(
    links: DataFrame,
    extensions: Iterable[str] | None,
    substrings: Iterable[str] | None = None,
    case_sensitive: bool = False,
) -> DataFrame:
    """Links whose file has an allowed suffix and holds any of the substrings."""
    kept = links
    name = F.col("file_name")
    if extensions is not None:
        kept = kept.where(paths.extension(name).isin(*[e.lower() for e in extensions]))
    parts = list(substrings or ())
    if parts:
        subject = name if case_sensitive else F.lower(name)
        test = F.lit(False)
        for part in parts:
            test = test | subject.contains(part if case_sensitive else part.lower())
        kept = kept.where(test)
    return kept


def first_per_file(links: DataFrame, order: Iterable[str] = ("page_id", "position")) -> DataFrame:
    """The first link of every file name: later ones would only repeat the download."""
    return keep_first(links, ["file_name"], list(order))
