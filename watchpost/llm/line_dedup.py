"""Line dedup by site-relative frequency.

A line that stands on a large share of a host's pages is boilerplate of that host, however rare
it is elsewhere.  For each host and line, pages that hold the line are divided by the host's
pages; lines above the ratio are dropped from that host's pages.

Lines are counted by 128-bit hash with map-side combine, so a host or a line with a third of all
rows is only as many rows as tasks.  A host's boilerplate is a short list whatever its size: no
more lines than an average page of the host has, divided by the ratio.  The lists are written,
so Spark knows their size when it joins them to the pages: it broadcasts them or splits a hot host.

Edge cases: a null or empty page has no lines; a page without a host, or a host with fewer pages
than ``min_pages``, keeps all its lines; a line counts once for a page that repeats it; repeated
rows are pages of their own; an empty table has an empty result.  Time grows in proportion to a page's
length, whatever it is made of.  Only the columns named are looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchpost.llm.storage import written

RATIO = (3, 10)  # a line on more than this share of the host's pages goes
MIN_PAGES = 4  # of a host, below which nothing is said about its lines

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
# What is no text, with a text up to the last place where such a thing ends; block elements, which end a line, and other elements, which
# don't.  A tag has no "<" inside, so that one without an end isn't looked for twice.
REMOVED = {
    r"(?is)<script\b[^<>]*+>.*?</script\s*+>": r"(?is)^(.*</script\s*+>)",
    r"(?is)<style\b[^<>]*+>.*?</style\s*+>": r"(?is)^(.*</style\s*+>)",
    r"(?s)<!--.*?-->": r"(?s)^(.*-->)",
}
BLOCK = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|"
    r"nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^<>]*+>"
)
INLINE = r"<[^<>]*+>"
BLANKS = r"[\t\x0B\f\r ]+"


def host_of(url: Column) -> Column:
    """Lower-case host of an address; null without one."""
    return F.nullif(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _without(text: Column, pattern: str, until_last_end: str) -> Column:
    """Up to the last end, each beginning finds one; after it, none does and none is looked for."""
    return _bound(
        text,
        lambda t: _bound(
            F.regexp_extract(t, until_last_end, 1),
            lambda closed: F.concat(F.regexp_replace(closed, pattern, " "), F.substr(t, F.length(closed) + 1)),
        ),
    )


def page_lines(html: Column) -> Column:
    """Lines of a page's text that aren't blank, white space reduced to single spaces."""
    text = F.coalesce(html, F.lit(""))
    for pattern, until_last_end in REMOVED.items():
        text = _without(text, pattern, until_last_end)
    text = F.regexp_replace(F.regexp_replace(text, BLOCK, "\n"), INLINE, "")
    lines = F.transform(F.split(F.regexp_replace(text, BLANKS, " "), "\n"), lambda line: F.trim(line))
    return F.filter(lines, lambda line: line != "")


def boilerplate(lined: DataFrame, *, ratio: tuple[int, int] = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, boilerplate)`` with the hashes of the host's boilerplate lines, from pages with ``host``
    and ``hashes`` of their lines."""
    hosted = lined.where(F.col("host").isNotNull())
    totals = hosted.groupBy("host").agg(F.count("*").alias("total")).where(F.col("total") >= min_pages)
    counts = (
        hosted.select("host", F.explode(F.array_distinct("hashes")).alias("hash"))
        .groupBy("host", "hash")
        .agg(F.count("*").alias("pages"))
        # Fewer can't be above the ratio on any host that is looked at.
        .where(F.col("pages") * ratio[1] > ratio[0] * min_pages)
    )
    dropped = counts.join(totals, "host").where(F.col("pages") * ratio[1] > ratio[0] * F.col("total"))
    return dropped.groupBy("host").agg(F.sort_array(F.collect_list("hash")).alias("boilerplate"))


def drop_boilerplate_lines(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    ratio: tuple[int, int] = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``(id_col, host, n_lines, n_dropped, text)`` for each page; ``text``: the lines that are left."""
    cut = pages.select(
        F.col(id_col).alias("page"), host_of(F.col(url_col)).alias("host"), page_lines(F.col(html_col)).alias("lines")
    )
    # Pages are cut into lines once; what is written is shorter than the pages.
    lined = written(cut, "page-lines").withColumn("hashes", F.transform("lines", F.md5))
    table = written(boilerplate(lined, ratio=ratio, min_pages=min_pages), "boilerplate")
    lists = table.withColumnRenamed("host", "__host")
    joined = lined.drop("hashes").join(lists, F.col("host") == F.col("__host"), "left")
    left = F.filter("lines", lambda line: ~F.array_contains("boilerplate", F.md5(line)))
    kept = F.when(F.col("boilerplate").isNull(), F.col("lines")).otherwise(left)
    return joined.withColumn("kept", kept).select(
        F.col("page").alias(id_col),
        "host",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.array_join("kept", "\n").alias("text"),
    )
