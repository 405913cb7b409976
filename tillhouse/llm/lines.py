"""Line dedup by site-relative frequency. DataFrame functions only.

For each host, the number of its pages that hold a line is divided by the number of its pages. A
line above the boilerplate ratio, and on `min_pages` pages at least, is dropped from every page of
that host; all other lines stay as they are and in their order.

A page counts each of its lines once, and counts are summed before they are shuffled, so a line or
a host of any size is spread. Where rows have classes (near copies, say), those of one host and class
are one page: what is shuffled then is a digest of each line, and the class of a row meets its lines by
the row's digest, not its text. The lines to drop of a host are few whatever its size: the ratios of
all lines of a host sum to the mean number of distinct lines of its pages, so no more than that
over the ratio can exceed it. They go to the pages as one list per host, in a join that adaptive
execution can split, and texts are not taken apart into rows again.

Defined results: lines are compared without spaces, tabs and carriage returns at their ends; lines
that are empty then are never boilerplate. A null text has no lines and stays null. Null hosts form one
host. Repeated rows are pages of their own, or, with classes, one page, so that copies of a page do not make
its lines boilerplate. An empty table gives an empty result. Columns of the
input travel inside a struct, so no name can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import ROW, keep, packed
from tillhouse.operators.joins import splittable_join

RATIO = 0.1
MIN_PAGES = 5


def host_of(url: Column) -> Column:
    """The lower-case host of a URL, without user and port; null where there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", F.lower(host))


def visible_lines(html: Column) -> Column:
    """The text of a page: scripts, styles and comments go, block tags break lines, other tags vanish."""
    for pattern, by in (
        (r"(?s)<!--.*?-->", ""),
        (r"(?is)<script\b.*?</script\s*>", ""),
        (r"(?is)<style\b.*?</style\s*>", ""),
        (r"(?i)</?(?:p|div|li|ul|ol|h[1-6]|br|tr|table|nav|header|footer|article|section|title|body|head|html)\b[^>]*>", "\n"),
        (r"<[^>]*>", ""),
    ):
        html = F.regexp_replace(html, pattern, by)
    return html


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _own(text: Column) -> Column:
    return F.array_distinct(F.transform(F.split(text, "\n"), _bare))


def _exceeding(counts: DataFrame, totals: DataFrame, ratio: float, min_pages: int) -> DataFrame:
    """(host, lines): the lines of `counts` (host, line, n) that exceed the ratio of their host's pages."""
    often = counts.where(F.col("n") >= min_pages).select(F.col("host").alias("h"), "line", "n")
    found = often.join(totals, F.col("h").eqNullSafe(F.col("host"))).where(F.col("n") > F.col("pages") * ratio)
    return found.groupBy("host").agg(F.collect_list("line").alias("lines"))


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines) for `pages` (host, text): the lines of each host that exceed the ratio."""
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    held = pages.select("host", F.explode(_own(F.col("text"))).alias("line")).where("line != ''")
    return _exceeding(held.groupBy("host", "line").agg(F.count("*").alias("n")), totals, ratio, min_pages)


def line_digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def boilerplate_of_classes(
    pages: DataFrame, classes: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """(host, lines) for `pages` (row, host, text), where the rows of a host and a class are one page.

    `classes` holds (row, class) once for each row digest. `lines` are digests (`line_digest`).
    """
    bare = F.filter(_own(F.col("text")), lambda line: line != "")
    # The empty line stands for the page itself.
    marks = F.array_union(F.array(F.lit("")), F.coalesce(bare, F.array().cast("array<string>")))
    held = pages.select("row", "host", F.explode(F.transform(marks, line_digest)).alias("line"))
    # Rows that are copies of each other meet before they look for their class.
    met = splittable_join(held.distinct(), classes, "row").select("host", "class", "line").distinct()
    counts = keep(met.groupBy("host", "line").agg(F.count("*").alias("n")), "line-counts")
    page = F.col("line") == line_digest(F.lit(""))
    totals = counts.where(page).select("host", F.col("n").alias("pages"))
    return _exceeding(counts.where(~page), totals, ratio, min_pages)


def drop_boilerplate(
    docs: DataFrame, host: Column, text: Column, ratio: float = RATIO, min_pages: int = MIN_PAGES,
    row: Column | None = None, classes: DataFrame | None = None,
) -> DataFrame:
    """The rows of `docs` inside `ROW`, with their host, n_lines, n_dropped and the remaining `text`.

    `host` and `text` are expressions over `docs`. With `classes` (row, class), rows of one host and class
    count as one page; `row` is the expression over `docs` that finds a row's class.
    """
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias(ROW)
    # A null host is a host like any other: its name is null, its key is the empty string.
    key = F.coalesce(F.concat(F.lit("h"), host), F.lit(""))
    pages = docs.select(whole, key.alias("host"), text.alias("text"))
    if classes is None:
        found, name = boilerplate(pages.select("host", "text"), ratio, min_pages), lambda line: line
    else:
        keyed = docs.select(row.alias("row"), key.alias("host"), text.alias("text"))
        found, name = boilerplate_of_classes(keyed, classes, ratio, min_pages), line_digest
    split = splittable_join(pages.withColumn("all", F.split("text", "\n")), keep(found, "boilerplate"), "host", "left")
    # First the few lines of the page that are boilerplate, then the page without those.
    hit = F.array_intersect(F.transform("all", lambda line: name(_bare(line))), "lines")
    stay = F.when(F.coalesce(F.size("hit"), F.lit(0)) <= 0, F.col("all")).otherwise(
        F.filter("all", lambda line: ~F.array_contains(F.col("hit"), name(_bare(line))))
    )
    return split.withColumn("hit", hit).withColumn("stay", stay).select(
        ROW,
        F.when(F.col("host") != "", F.substr("host", F.lit(2))).alias("host"),
        F.greatest(F.coalesce(F.size("all"), F.lit(0)), F.lit(0)).cast("long").alias("n_lines"),
        F.greatest(F.coalesce(F.size("all") - F.size("stay"), F.lit(0)), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join("stay", "\n").alias("text"),
    )
