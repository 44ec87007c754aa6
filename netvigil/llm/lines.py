"""Line dedup by site-relative frequency: a line on too large a share of a host's pages is boilerplate there.

Counts are one aggregation per (host, line) with partial sums before the shuffle, on line hashes. A host can have no
more boilerplate lines than lines per page divided by the ratio, so the table of them stays small; Spark joins it to
the pages by its size (broadcast below the session's threshold, a skew-splitting join beyond).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netvigil.llm.common import private
from netvigil.session import stored

#: A line goes from a host's pages when more than this share of them, and more than one, hold it.
RATIO, LEAST_PAGES = 0.1, 2


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """Two independent 64-bit hashes of a line without outer spaces."""
    line = F.trim(line)
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def boilerplate(pages: DataFrame, host: str, text: str, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, keys): hashes of the lines that exceed the ratio on each host that has such lines."""
    rows = pages.select(F.col(host).alias("host"), F.col(text).cast("string").alias("text"))
    totals = rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    lines = rows.select("host", F.explode(F.array_distinct(F.transform(
        F.filter(_lines(F.col("text")), lambda x: F.trim(x) != ""), _key
    ))).alias("key"))
    counts = stored(lines.groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_pages), "lines")
    totals = totals.select(F.col("host").alias("of"), "pages")
    often = counts.join(totals, F.col("host").eqNullSafe(F.col("of"))).where(F.col("n") > ratio * F.col("pages"))
    return often.groupBy("host").agg(F.collect_set("key").alias("keys"))


def drop_boilerplate(
    pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """``pages`` with its columns as they are, but ``text`` without the lines that are boilerplate on the row's host.

    Lines are what line feeds separate, compared without outer spaces; empty lines are neither counted nor dropped.
    A line counts once per row however often it repeats there; each row is a page, repeated rows too. Rows without
    a host are a host of their own. A null text stays null and counts as a page; a text of nothing but boilerplate
    becomes empty. Hosts with fewer than ``least_pages`` pages keep everything. Texts of any length are split whole; an
    empty table stays empty.
    """
    lines, kept = private(pages, "lines_of_page"), private(pages, "lines_kept")
    done = _marked(pages, host, text, ratio, least_pages, lines, kept)
    return done.withColumn(text, F.array_join(kept, "\n")).select(*[f"`{c}`" for c in pages.columns])


def _marked(
    pages: DataFrame, host: str, text: str, ratio: float, least_pages: int, lines: str, kept: str
) -> DataFrame:
    """``pages`` with the array of each row's lines and of those that stay."""
    site, keys = private(pages, "site_of_lines"), private(pages, "keys_of_lines")
    drop = stored(boilerplate(pages, host, text, ratio, least_pages), "boilerplate").toDF(site, keys)
    joined = pages.join(drop, F.col(f"`{host}`").eqNullSafe(F.col(site)), "left")
    joined = joined.withColumn(lines, _lines(F.col(f"`{text}`").cast("string")))
    return joined.withColumn(kept, F.when(F.col(keys).isNull(), F.col(lines)).otherwise(
        F.filter(lines, lambda x: ~F.array_contains(F.col(keys), _key(x)))
    ))


def line_counts(pages: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """(doc_id, text, n_lines, n_dropped): the text that ``drop_boilerplate`` leaves of each row, the lines it had and
    the lines that went; null texts have null counts."""
    lines, kept = F.col("lines"), F.col("kept")
    rows = pages.select("doc_id", F.col(f"`{host}`").alias("site"), F.col(f"`{text}`").alias("text"))
    done = _marked(rows, "site", "text", RATIO, LEAST_PAGES, "lines", "kept")
    return done.select(
        "doc_id", F.array_join(kept, "\n").alias("text"), F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(kept)).cast("long").alias("n_dropped"),
    )


LINE_SQL = f"""
WITH totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
numbered AS (SELECT row_number() OVER () AS r, source, text FROM documents),
held AS (SELECT DISTINCT r, source, line FROM
  (SELECT r, source, trim(unnest(string_split(text, chr(10)))) AS line FROM numbered) WHERE line <> ''),
counts AS (SELECT source, line, count(*) AS n FROM held GROUP BY source, line HAVING count(*) >= {LEAST_PAGES}),
bad AS (SELECT c.source, list(line) AS gone FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
  WHERE n > {RATIO} * pages GROUP BY c.source),
parts AS (SELECT doc_id, string_split(text, chr(10)) AS lines, coalesce(gone, []) AS gone
  FROM documents d LEFT JOIN bad b ON d.source IS NOT DISTINCT FROM b.source),
done AS (SELECT doc_id, lines, list_filter(lines, lambda x: NOT list_contains(gone, trim(x))) AS kept FROM parts)
SELECT doc_id, CASE WHEN lines IS NOT NULL THEN array_to_string(kept, chr(10)) END AS text,
  len(lines) AS n_lines, len(lines) - len(kept) AS n_dropped FROM done
"""
