"""Boilerplate lines by their share of a site's pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import line_key, lines_of, small, without_lines, without_positions, written

#: A line is boilerplate on a host where more than RATIO of the pages, and at least LEAST_PAGES, hold it.
RATIO = 0.1
LEAST_PAGES = 5


def boilerplate_positions(
    pages: DataFrame, key: Column, host: Column, lines: Column, ratio: float = RATIO, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """``(line_id, line_positions)``: 0-based positions of boilerplate lines, for pages that have any.

    Pages with a line, each counted once, are divided by all pages of the host. Lines are compared without white
    space at their ends; blank lines are never boilerplate. Pages with a null host belong to no site and keep all
    lines; rows with a null key count as pages of their host but yield no positions; repeated rows count as pages and, under
    one key, have one row of positions, the same for all of them.
    Counts are combined in each task before they are shuffled by a 128-bit digest of the line, so a host or a line
    that fills a third of the table is one row per task; the way back to the lines is a join that broadcasts the
    boilerplate if it is counted to be small and else may be split where it is skewed.
    """
    named = pages.select(key.alias("line_id"), host.alias("host"), lines.alias("lines")).where(F.col("host").isNotNull())
    trimmed = F.transform("lines", lambda line: F.regexp_replace(line, r"^\s+|\s+$", ""))
    totals = named.groupBy("host").agg(F.count("*").alias("pages"))
    digest = F.unhex(F.md5("line"))
    once = named.select("host", F.explode(F.array_distinct(trimmed)).alias("line")).where("line <> ''")
    counts = once.groupBy("host", digest.alias("digest")).agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    totals = small(written(totals.withColumnRenamed("host", "of_host"), "host-pages"))
    often = counts.join(totals, F.col("host") == F.col("of_host")).where(F.col("n") > ratio * F.col("pages"))
    often = small(written(often.select(F.col("host").alias("of_host"), F.col("digest").alias("of_digest")), "boilerplate"))
    each = named.where(F.col("line_id").isNotNull()).select("line_id", "host", F.posexplode(trimmed).alias("at", "line"))
    each = each.where("line <> ''").select("line_id", "host", "at", digest.alias("digest"))
    match = (F.col("host") == F.col("of_host")) & (F.col("digest") == F.col("of_digest"))
    return each.join(often, match, "left_semi").groupBy("line_id").agg(F.array_sort(F.collect_set("at")).alias("line_positions"))


def drop_boilerplate(
    documents: DataFrame,
    host_column: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """``documents`` with the boilerplate lines of each host cut from the texts. No row is dropped: a text made of
    boilerplate only becomes empty, a null text stays null. Rows that share an id are cut each by its own text; rows
    without an id stay whole; an empty table gives an empty result; extra columns stay, whatever their names."""
    key = line_key(documents[id_column], documents[host_column], documents[text_column])
    lines = lines_of(documents[text_column])
    positions = boilerplate_positions(documents, key, documents[host_column], lines, ratio, least_pages)
    return without_lines(documents, positions, key, text_column)


def page_lines(html: str | Column) -> Column:
    """Non-blank lines of text in raw HTML: scripts, styles and comments go, inline marks join, other tags break."""
    html = F.coalesce(F.col(html) if isinstance(html, str) else html, F.lit(""))
    text = F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", "")
    text = F.regexp_replace(text, r"(?i)</?(a|b|i|em|strong|span)(\s[^>]*)?>", "")
    lines = F.split(F.regexp_replace(text, r"<[^>]*>", "\n"), "\n", -1)
    return F.filter(F.transform(lines, lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")


def url_host(url: str | Column) -> Column:
    """Lower-case host of a URL, null if it has none."""
    host = F.regexp_extract(F.lower(F.col(url) if isinstance(url, str) else url), r"^[a-z][a-z0-9+.-]*://([^/?#:]+)", 1)
    return F.when(host != "", host)


def page_boilerplate(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``(page_id, host, n_lines, n_dropped, text)`` per page of ``(page_id, url, html)``: its text without the
    host's boilerplate lines. Null pages have no lines; pages without an id or a host keep all; pages that share an id
    are cut each by its own lines; an empty table gives an empty result; other columns are not read."""
    rows = pages.select(
        pages["page_id"].alias("page_id"), url_host(pages["url"]).alias("host"), page_lines(pages["html"]).alias("lines")
    )
    keyed = rows.withColumn("line_key", line_key(F.col("page_id"), F.col("host"), F.array_join("lines", "\n")))
    rows = written(keyed, "page-lines")
    positions = boilerplate_positions(rows, F.col("line_key"), F.col("host"), F.col("lines"), ratio, least_pages)
    wide = rows.join(positions, F.col("line_key") == F.col("line_id"), "left")
    dropped = F.coalesce("line_positions", F.array().cast("array<int>"))
    return wide.select(
        "page_id",
        "host",
        F.size("lines").cast("long").alias("n_lines"),
        F.size(dropped).cast("long").alias("n_dropped"),
        F.array_join(without_positions(F.col("lines"), dropped), "\n").alias("text"),
    )
