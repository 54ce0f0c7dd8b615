"""File paths and links as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def extension(name: Column) -> Column:
    """Lower-case suffix with its dot, empty when there is none (``.profile`` has none)."""
    return F.lower(F.regexp_extract(base_name(name), r"^\.*[^.].*(\.[^.]*)$", 1))


def stem(name: Column) -> Column:
    base = base_name(name)
    return F.when(base.rlike(r"^\.*[^.].*\.[^.]*$"), F.regexp_replace(base, r"\.[^.]*$", "")).otherwise(base)


def _without_dot_segments(path: Column) -> Column:
    segments = F.split(path, "/")
    last = F.element_at(segments, -1)

    def step(seen: Column, segment: Column) -> Column:
        # the leading empty segment stands for the root and is never popped
        popped = F.slice(seen, F.lit(1), F.greatest(F.size(seen) - 1, F.lit(1)))
        return (
            F.when(segment == "..", popped)
            .when(segment == ".", seen)
            .otherwise(F.concat(seen, F.array(segment)))
        )

    empty = F.array().cast("array<string>")
    kept = F.aggregate(segments, empty, step)
    # "a/b/.." and "a/b/." name the folder itself
    closed = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.rlike(r"(^|/)\.{1,2}(/|$)"), F.array_join(closed, "/")).otherwise(path)


def absolute_url(base: Column, href: Column) -> Column:
    """Resolve a link against the page it stands on (RFC 3986 reference resolution)."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    page_path = F.substring(page, F.length(site) + 1, F.length(page))
    folder = F.regexp_extract(page_path, r"^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    ref_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    ref_tail = F.substring(href, F.length(ref_path) + 1, F.length(href))
    query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("#"), F.concat(page, query, href))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("/"), F.concat(site, _without_dot_segments(ref_path), ref_tail))
        .otherwise(F.concat(site, _without_dot_segments(F.concat(folder, ref_path)), ref_tail))
    )


def url_path(url: Column) -> Column:
    """Path part of a URL: no scheme, host, query or fragment."""
    bare = F.regexp_extract(url, r"^([^?#]*)", 1)
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.\-]*:", "")
    return F.regexp_replace(bare, r"^//[^/]*", "")
