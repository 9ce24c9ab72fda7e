"""URL columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import bound

# Parts of any reference: scheme, authority, path, query, fragment (RFC 3986, appendix B).
_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(?s:(#.*))?$"


def _part(url: Column, n: int) -> Column:
    return F.regexp_extract(url, _PARTS, n)


def _resolve(path: Column) -> Column:
    """Path with '.' and '..' segments worked out, always rooted."""
    ends_in_dots = F.regexp_like(path, F.lit(r"(^|/)\.\.?$"))
    segments = F.filter(F.split(path, "/"), lambda s: s != ".")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, s: F.when(
            s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        ).otherwise(F.concat(done, F.array(s))),
    )
    joined = F.concat(F.array_join(kept, "/"), F.when(ends_in_dots, "/").otherwise(""))
    return F.concat(F.lit("/"), F.ltrim(joined, F.lit("/")))


def absolute_url(url: Column, base: Column) -> Column:
    """Resolve a reference against a base URL (RFC 3986)."""

    def parts(u):
        names = ("scheme", "authority", "path", "query", "fragment")
        return F.struct(u.alias("url"), *[_part(u, n).alias(name) for n, name in enumerate(names, 1)])

    def resolve(u, b):
        folder = F.regexp_replace(b["path"], "[^/]*$", "")
        # Empty segments inside a relative path collapse.
        merged = F.regexp_replace(F.concat(folder, u["path"]), "/{2,}", "/")
        rooted = F.startswith(u["path"], F.lit("/"))
        path = F.when(u["path"] == "", b["path"]).otherwise(_resolve(F.when(rooted, u["path"]).otherwise(merged)))
        query = F.when((u["path"] == "") & (u["query"] == ""), b["query"]).otherwise(u["query"])
        scheme = F.concat(b["scheme"], F.lit(":"))
        return (
            F.when(u["url"] == "", b["url"])
            .when(u["scheme"] != "", u["url"])
            .when(u["authority"] != "", F.concat(scheme, u["url"]))
            .otherwise(F.concat(scheme, b["authority"], path, query, u["fragment"]))
        )

    return bound(parts(url), lambda u: bound(parts(base), lambda b: resolve(u, b)))


def file_type(url: Column) -> Column:
    """Extension before the query or the end, 'pdf' when there is none."""
    ext = F.regexp_extract(F.lower(url), r"\.([a-z0-9]+)(?:\?|$)", 1)
    return F.when(F.coalesce(url, F.lit("")) == "", None).when(ext == "", "pdf").otherwise(ext)


def url_path(url: Column) -> Column:
    return _part(url, 3)


def last_segment(url: Column) -> Column:
    return F.regexp_extract(url_path(url), "([^/]*)/*$", 1)


def url_file_name(url: Column) -> Column:
    """Last path part when it is a PDF, else a name made from the URL's hash."""
    name = F.element_at(F.split(url_path(url), "/"), -1)
    hashed = F.concat(F.lit("document_"), F.substring(F.md5(url), 1, 8), F.lit(".pdf"))
    return F.when(F.endswith(name, F.lit(".pdf")), name).otherwise(hashed)


def is_valid_url(url: Column) -> Column:
    """Scheme and host are both there."""
    return (_part(url, 1) != "") & (F.length(_part(url, 2)) > 2)


def page_urls(ranges: DataFrame, template: str = "template", first: str = "first", last: str = "last", chunk: int = 10_000) -> DataFrame:
    """One search URL per page number of each row's range, both ends included: the row's columns, page, url, error.

    A row with a bad range gives one row that says why, without page and URL. A range is first cut into chunks, which
    are dealt to all tasks, so that one row with most of all pages is many tasks' work.
    """
    low, high, text = F.col(first).cast("bigint"), F.col(last).cast("bigint"), F.col(template)
    error = (
        F.when(text.isNull() | low.isNull() | high.isNull(), "template, first or last page is missing")
        .when(low < 0, "first page is negative")
        .when(low > high, "range ends before it starts")
        .when((low < high) & ~F.contains(text, F.lit("{page}")), "several pages need {page} in the template")
    )
    kept = [c for c in ranges.columns if c not in ("page", "url", "error")]
    starts = F.when(F.col("error").isNull(), F.sequence(low, high, F.lit(chunk)))
    chunks = ranges.withColumn("error", error).select(*kept, "error", F.explode_outer(starts).alias("_start"))
    pages = F.when(F.col("error").isNull(), F.sequence(F.col("_start"), F.least(F.col("_start") + (chunk - 1), high)))
    rows = chunks.repartition("_start", template).select(*kept, F.explode_outer(pages).alias("page"), "error")
    url = F.when(F.col("error").isNull(), F.replace(text, F.lit("{page}"), F.col("page").cast("string")))
    return rows.select(*kept, "page", url.alias("url"), "error")
