"""Main text of web pages by the template of their host, deduced from equivalence classes of tokens."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.page_tokens import MAIN, blocks, layout
from ledgerline.llm.tables import cut

IN_MAIN = rf"(^|/)({'|'.join(MAIN)})(\.[^/]*)?(/|$)"
# text that a template repeats where other text varies counts as the template's from so many words on
WORDS = 4
# a layout of so many pages has a template of its own
ALONE = 3
HOLDER = r"(^|/)(article|main|section|div|td|body)(\.[^/]*)?$"


def _counted(own: list) -> list[dict]:
    """A page's blocks. The first of equal ones on a path holds their number, and whether all are apart; the others hold 0."""
    times = Counter((b.path, b.text) for b in own)
    open_ones = {(b.path, b.text) for b in own if not b.aside}
    return [{"path": b.path, "aside": b.aside, "text": b.text, "n": times.pop((b.path, b.text), 0), "apart": (b.path, b.text) not in open_ones} for b in own]


def tokens(pages: DataFrame) -> DataFrame:
    """(row, page_id, url, host, layout, tags, blocks): the number of the page's layout, how often each path of elements opens, and the text blocks in page order."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("path", pa.string()), ("n", pa.int64())])
        block = pa.struct([("path", pa.string()), ("aside", pa.bool_()), ("text", pa.string()), ("n", pa.int64()), ("apart", pa.bool_())])
        for part in parts:
            htmls = part.column(4).to_pylist()
            for first in range(0, len(htmls), 200):
                found = [blocks(h or "") for h in htmls[first : first + 200]]
                tags = [[{"path": p, "n": n} for p, n in Counter(t).items()] for t, _ in found]
                texts = [_counted(own) for _, own in found]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k).slice(first, len(found)) for k in range(4)), pa.array([layout(t) for t, _ in found], pa.int64()), pa.array(tags, pa.list_(kind)), pa.array(texts, pa.list_(block))],
                    ["row", "page_id", "url", "host", "layout", "tags", "blocks"])

    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1), F.lit("")))
    kind = pages.schema["page_id"].dataType.simpleString()
    given = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", host.alias("host"), F.col("html").cast("string").alias("html"))
    return given.mapInArrow(run, f"row long, page_id {kind}, url string, host string, layout long, tags array<struct<path: string, n: long>>, "
                                 "blocks array<struct<path: string, aside: boolean, text: string, n: long, apart: boolean>>")


def templates(parsed: DataFrame) -> DataFrame:
    """(host, layout, holder, repeated): where a host's pages of a layout hold their main text, and hashes of text that its template repeats.

    Tokens are tags with their path and text blocks with theirs. Their occurrence vector over the pages is kept as sums
    (pages, occurrences, hashed pages times occurrences), so equal vectors are found without holding one. Tokens of equal vectors are a
    class; a class is valid when several tokens share it and at least half of the pages have it. Valid classes nest by
    their paths. The slots are the text blocks whose own token is in no valid class; the holder is the innermost template element around
    nearly all slot text, where an article or main element counts before others. Repeated text is that of valid classes on paths
    without slots; on the path of a slot it has to be WORDS words on nearly all pages. Every page counts, and
    a host is only ever sums, however many pages it has.
    Layouts of fewer than ALONE pages are one group of their host.
    """
    sizes = cut(parsed.groupBy("host", "layout").agg(F.count("*").alias("layout_pages")).withColumn(
        "in_group", F.when(F.col("layout_pages") >= ALONE, F.col("layout"))))
    group = F.struct("host", F.col("in_group").alias("layout"))
    tags = parsed.select("row", "host", "layout", F.explode("tags").alias("t")).select("row", "host", "layout", "t.path", F.lit(0).cast("long").alias("text"), "t.n", F.lit(0).alias("chars"), F.lit(0).alias("words"), F.lit(False).alias("aside"))
    texts = parsed.select("row", "host", "layout", F.explode(F.filter("blocks", lambda b: b["n"] > 0)).alias("b")).select(
        "row", "host", "layout", "b.path", F.xxhash64("b.text").alias("text"), "b.n", F.length("b.text").alias("chars"),
        F.size(F.split("b.text", " ")).alias("words"), F.col("b.apart").alias("aside"))
    own = tags.union(texts).groupBy("host", "layout", "path", "text").agg(
        F.count("*").alias("pages"), F.sum("n").alias("n"), F.expr("bit_xor(xxhash64(row, n))").alias("vector"),
        F.first("chars").alias("chars"), F.first("words").alias("words"), F.min("aside").alias("aside"))
    # the text of a single page is in no class: of a layout's such texts only their length on each path counts
    single = F.col("in_group").isNotNull() & (F.col("pages") == 1) & (F.col("text") != 0)
    own = own.join(sizes, ["host", "layout"]).where(~(single & F.col("aside"))).withColumns({"host": group, "mass": F.col("chars") * F.col("n")})
    own = own.withColumn("pages", F.when(single, 0).otherwise(F.col("pages"))).withColumn("text", F.when(F.col("pages") > 0, F.col("text")))
    vectors = cut(own.groupBy("host", "path", "text").agg(
        F.sum("pages").alias("pages"), F.sum("n").alias("n"), F.expr("bit_xor(vector)").alias("vector"),
        F.first("chars").alias("chars"), F.first("words").alias("words"), F.min("aside").alias("aside"), F.sum("mass").alias("mass")))
    hosts = cut(sizes.withColumn("host", group).groupBy("host").agg(F.sum("layout_pages").alias("all_pages")))
    classes = vectors.groupBy("host", "pages", "n", "vector").agg(F.count("*").alias("members")).join(hosts, "host").where(
        "pages >= 2 AND members >= 2 AND 2 * pages >= all_pages").select("host", "pages", "n", "vector")
    template = vectors.join(classes, ["host", "pages", "n", "vector"], "left_semi")
    slots = (vectors.where("(text IS NULL OR text <> 0) AND NOT aside").join(classes, ["host", "pages", "n", "vector"], "left_anti")
             .groupBy("host", "path").agg(F.sum("mass").alias("chars")))
    holders = template.where((F.col("text") == 0) & F.col("path").rlike(HOLDER)).select("host", F.col("path").alias("holder"))
    inside = (slots.join(holders, "host").where("path = holder OR startswith(path, concat(holder, '/'))")
              .groupBy("host", "holder").agg(F.sum("chars").alias("chars")))
    whole = slots.groupBy("host").agg(F.sum("chars").alias("all_chars"))
    best = (inside.join(whole, "host").where("10 * chars >= 9 * all_chars")
            .groupBy("host").agg(F.max_by("holder", F.struct(F.col("holder").rlike(IN_MAIN), F.length("holder"), "holder")).alias("holder")))
    varied = slots.select("host", "path", F.lit(True).alias("varies"))
    repeated = (template.where((F.col("text") != 0) & ~F.col("aside") & (F.col("pages") >= 3)).join(hosts, "host").join(varied, ["host", "path"], "left")
                .where(f"varies IS NULL OR words >= {WORDS} AND 10 * pages >= 9 * all_pages")
                .groupBy("host").agg(F.array_sort(F.collect_set(F.xxhash64("path", "text"))).alias("repeated")))
    found = hosts.join(best, "host", "left").join(repeated, "host", "left").select(
        F.col("host.host").alias("host"), F.col("host.layout").alias("in_group"), "holder", "repeated")
    return sizes.alias("s").join(found.alias("f"), F.expr("s.host = f.host AND s.in_group <=> f.in_group")).select("s.host", "s.layout", "holder", "repeated")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row: the blocks of main text joined by one space.

    A page gives the text in its layout's holder on its host without what the host's template repeats, unless that is most of it, as in a copied page.
    Only where the layout gives no holder, or the page has no text there, the tags decide: the text in an article or main element,
    or else all text that the template does not repeat, or else all text. Menus, headers, footers, sidebars, forms and elements named
    as adverts, notices or comments that do not hold most of the page never count, nor does markup. Null and
    empty pages have an empty text; rows that repeat an id are rows of their own; a null url is a host of its own.
    """
    parsed = cut(tokens(pages), "zstd")
    given = parsed.join(cut(templates(parsed)), ["host", "layout"], "left")
    own = F.filter("blocks", lambda b: ~b["aside"])
    main = F.filter("own", lambda b: b["path"].rlike(IN_MAIN))
    held = F.filter("own", lambda b: (b["path"] == F.col("holder")) | F.startswith(b["path"], F.concat("holder", F.lit("/"))))
    fresh = lambda blocks: F.filter(blocks, lambda b: ~F.array_contains(
        F.coalesce("repeated", F.array().cast("array<bigint>")), F.xxhash64(b["path"], F.xxhash64(b["text"]))))
    chars = lambda blocks: F.aggregate(blocks, F.lit(0), lambda n, b: n + F.length(b["text"]))
    given = given.withColumns({"own": own}).withColumns({"main": main, "held": held, "fresh": fresh("own")}).withColumn("core", fresh("held"))
    chosen: Column = (F.when(F.size("held") > 0, F.when(2 * chars("core") >= chars("held"), F.col("core")).otherwise(F.col("held")))
                      .when(F.size("main") > 0, F.col("main")).when(F.size("fresh") > 0, F.col("fresh")).otherwise(F.col("own")))
    text = F.array_join(F.transform(chosen, lambda b: b["text"]), " ")
    return given.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
