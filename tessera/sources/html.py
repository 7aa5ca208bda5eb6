"""HTML tables and links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def links(pages: DataFrame) -> DataFrame:
    """(page_id, place, link): each page's distinct links and the place of the first of each, from 1."""
    found = F.regexp_extract_all("html", F.lit(r'(?i)<a\s+href="([^"]*)"'), 1)
    x = pages.select("page_id", F.posexplode(found).alias("place", "link"))
    return x.groupBy("page_id", "link").agg((F.min("place") + 1).cast("bigint").alias("place"))


def rating_table(pages: DataFrame) -> DataFrame:
    """(name, rating) of the rows of tables of class ``player-rating``: the text of the first two cells."""
    tables = F.explode(F.regexp_extract_all("html", F.lit(r"""(?is)<table[^>]*\bclass\s*=\s*["']?[^"'>]*player-rating[^>]*>(.*?)</table>"""), 1))
    rows = pages.select(tables.alias("t")).select(F.explode(F.regexp_extract_all("t", F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)).alias("r"))
    cells = rows.select(F.regexp_extract_all("r", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), 1).alias("c")).where(F.size("c") >= 2)
    text = lambda c: F.trim(F.regexp_replace(c, r"<[^>]*>", ""))
    return cells.select(text(F.col("c")[0]).alias("name"), text(F.col("c")[1]).try_cast("double").alias("rating")).where("rating IS NOT NULL")
