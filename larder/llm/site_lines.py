"""Line dedup by site-relative frequency.

Pages are grouped by host. A line is boilerplate of its host if more than
``RATIO`` of the host's pages contain it, and at least ``LEAST`` of them do, as a
single page cannot show that a line repeats. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from larder.llm.common import stored, text_or_empty

RATIO = 0.1
LEAST = 2

# tags that end a line; others are dropped in place
_BLOCK = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main"
    r"|nav|ol|p|pre|section|table|td|th|title|tr|ul)(?:\s[^<>]*)?/?>"
)
_HIDDEN = [r"(?is)<!--.*?-->", r"(?is)<script(?:\s[^<>]*)?>.*?</script\s*>", r"(?is)<style(?:\s[^<>]*)?>.*?</style\s*>"]
_TAG = r"<[!/a-zA-Z][^<>]*>"
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), _HOST, 1))


def html_lines(html: Column) -> Column:
    """The text lines of a page, blank ones left out."""
    text = F.coalesce(html.cast("string"), F.lit(""))
    for pattern in _HIDDEN:
        text = F.regexp_replace(text, pattern, "\n")
    text = F.regexp_replace(F.regexp_replace(text, _BLOCK, "\n"), _TAG, "")
    text = F.regexp_replace(text, r"[ \t\r\f]+", " ")
    return F.filter(F.transform(F.split(text, "\n"), lambda line: F.trim(line)), lambda line: line != "")


def boilerplate(pages: DataFrame, ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """(host, common): the boilerplate lines of each host that has any.

    ``pages`` has ``host`` and ``lines``. A host's list is short: each of its
    lines is on more than ``ratio`` of the pages, so there are at most the mean
    number of lines of a page over ``ratio``. A line counts once per page.
    """
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    counts = pages.select("host", F.explode(F.array_distinct("lines")).alias("line")).groupBy("host", "line").agg(
        F.count("*").alias("with_line")
    )
    common = counts.where(F.col("with_line") >= least).join(totals, "host")
    return common.where(F.col("with_line") > F.col("pages") * F.lit(ratio)).groupBy("host").agg(F.array_sort(F.collect_set("line")).alias("common"))


def without_boilerplate(pages: DataFrame, ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, host, n_lines, n_dropped, kept_text.

    Pages without a readable host form one site, named by the empty string. A
    null or empty page has no lines. Rows that repeat a page count as pages of
    their own. An empty table gives no rows.
    """
    lines = pages.select("page_id", host_of(F.col("url")).alias("host"), html_lines(F.col("html")).alias("lines"))
    common = stored(boilerplate(lines, ratio, least), "boilerplate")
    kept = F.filter("lines", lambda line: ~F.array_contains(F.coalesce("common", F.array().cast("array<string>")), line))
    return (
        lines.join(common, "host", "left")
        .withColumn("kept", kept)
        .select(
            "page_id",
            "host",
            F.size("lines").cast("bigint").alias("n_lines"),
            (F.size("lines") - F.size("kept")).cast("bigint").alias("n_dropped"),
            F.array_join("kept", "\n").alias("kept_text"),
        )
    )
