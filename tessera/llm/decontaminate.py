"""Benchmark decontamination: MinHash containment search in size partitions of the items, verified on exact shingles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpoint, let, set_aside, small, words

WIDTH = 5
CONTAINMENT = 0.8
#: Size partitions of the items, of about equally many each.
PARTITIONS = 16


def lowered(text: Column) -> Column:
    return words(F.lower(F.coalesce(text, F.lit(""))))


def windows(tokens: Column, width: Column, of) -> Column:
    """``of(window)`` for every run of ``width`` tokens; null if there are fewer tokens."""
    return let(
        tokens,
        lambda ws: F.when(
            F.size(ws) >= width, F.transform(F.sequence(F.lit(1), F.size(ws) - width + 1), lambda i: of(F.slice(ws, i, width)))
        ),
    )


def item_words(items: DataFrame) -> DataFrame:
    """(item_id, d_ws): the words of each item that has any."""
    return items.select("item_id", lowered(F.col("text")).alias("d_ws")).where(F.size("d_ws") > 0)


def described(classes: DataFrame) -> DataFrame:
    """(item_id, d_width, d_grams) of rows (item_id, d_ws); an item of fewer than five words is one shingle of all its words."""
    width = F.least(F.size("d_ws"), F.lit(WIDTH))
    return classes.select("item_id", width.alias("d_width"), F.array_distinct(windows(F.col("d_ws"), width, lambda w: F.array_join(w, " "))).alias("d_grams"))


def item_classes(items: DataFrame) -> DataFrame:
    """(item_id, d_width, d_grams): one row per distinct word sequence, named by its smallest item_id; an item without words has no row."""
    return described(item_words(items).groupBy("d_ws").agg(F.min("item_id").alias("item_id")))


def size_bounds(classes: DataFrame, parts: int = PARTITIONS) -> list[int]:
    """The greatest number of shingles in each size partition, ascending: quantiles of the items' sizes, ``parts`` numbers at most."""
    n = F.size("d_grams")
    t = classes.agg(F.percentile_approx(n, [k / parts for k in range(1, parts)], 10_000).alias("q"), F.max(n).alias("most")).first()
    return sorted({*(t.q or []), t.most}) if t.most else []


def least_found(n: Column) -> Column:
    """How many of ``n`` shingles a text must have: 80 %, rounded up."""
    return F.ceil(n * F.lit(CONTAINMENT) - F.lit(1e-9)).cast("int")


def sketches(classes: DataFrame, bounds: list[int]) -> DataFrame:
    """(d_part, d_width, d_hash, item_id, d_least): the items' bottom-k MinHash sketches, with k fixed for each size partition.

    A text with at least 80 % of an item's n shingles lacks at most ``n - ceil(0.8 n)`` of them, so one at least of the item's
    ``n - ceil(0.8 n) + 1`` least shingle hashes is in the text. A partition's k is that number for its greatest size, so its
    sketches miss no item of it, however long the text is, where MinHash similarity of an item and a long text would tend to zero.
    ``d_least`` is the least number of shingles that any item of the partition asks of a text.
    """
    n = F.size("d_grams")
    part, depth, least = F.lit(0), F.lit(1), F.lit(1)
    for k, (below, top) in enumerate(zip([0, *bounds], bounds, strict=False)):
        inside = n > below
        part = F.when(inside, F.lit(k)).otherwise(part)
        depth = F.when(inside, F.lit(top) - least_found(F.lit(top)) + 1).otherwise(depth)
        least = F.when(inside, least_found(F.lit(below + 1))).otherwise(least)
    hashes = F.array_sort(F.transform("d_grams", lambda g: gram_hash(F.split(g, " "))))
    return classes.select(part.alias("d_part"), "d_width", "item_id", least.alias("d_least"), F.explode(F.slice(hashes, 1, depth)).alias("d_hash"))


def gram_hash(gram: Column) -> Column:
    """The hash of an array of words; its parts are hashed in turn, as by ``window_hashes``."""
    return F.xxhash64(gram)


def window_hashes(tokens: Column, width: int) -> Column:
    """``gram_hash`` of every run of ``width`` tokens, without an array for each; null if there are fewer tokens."""
    of = lambda ws: F.transform(F.sequence(F.lit(0), F.size(ws) - width), lambda i: F.xxhash64(*(ws[i + k] for k in range(width))))
    return let(tokens, lambda ws: F.when(F.size(ws) >= width, of(ws)))


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment): texts that contain at least 80 % of an item's distinct five-word shingles.

    Words are compared in lower case, letters of any alphabet included. ``item_id`` names a class of items with equal words, by the smallest of their ids.
    Null and empty texts contain nothing; items without words are contained nowhere; an item of fewer words than five counts as contained where all its words
    stand in a row. Repeated rows of ``docs`` with one doc_id count as one document, of which all texts count. Empty tables give an
    empty result. Only doc_id and text, item_id and text are read.

    Each text is scanned whole. Its own sketches are its shingle hashes up to the greatest hash in a partition's sketches, for the partitions
    whose items aren't too large for it; they meet the items' there. Items' sketches are broadcast if they are few and small by count, and joined by
    a shuffle of hashes otherwise. The pairs found are then verified on the shingles' words: the ids of texts with candidates are
    broadcast likewise, so only those texts move.
    """
    return class_leaks(docs.select("doc_id", "text"), checkpoint(item_classes(items.select("item_id", "text"))))


def find_member_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``find_leaks`` for every item: those with equal words are searched once, and each of their ids has its own row.

    An item_id that stands for several texts has a row for each of them that is found.
    """
    words_of = item_words(items.select("item_id", "text"))
    classes = checkpoint(words_of.select("d_ws").distinct().withColumn("d_class", F.monotonically_increasing_id()))
    members = checkpoint(words_of.join(classes, "d_ws").select("d_class", F.col("item_id").alias("d_member")).distinct())
    found = class_leaks(docs.select("doc_id", "text"), checkpoint(described(classes.select(F.col("d_class").alias("item_id"), "d_ws"))))
    return found.join(small(members), F.col("item_id") == F.col("d_class")).select(
        "doc_id", F.col("d_member").alias("item_id"), "n_shingles", "n_found", "containment"
    )


def class_leaks(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``find_leaks`` for checkpointed classes (item_id, d_width, d_grams)."""
    sketch = checkpoint(sketches(classes, size_bounds(classes)))
    cuts = sketch.groupBy("d_width").agg(F.max("d_hash").alias("top"), F.min("d_least").alias("least")).orderBy("d_width").collect()  # widths 1 to 5
    small_sketch = small(sketch)
    found = None
    for c in cuts:
        found_in = lambda d: F.when(F.size(d) >= c.least, F.transform(F.filter(d, lambda h: h <= F.lit(c.top)), lambda h: F.struct(h.alias("d_hash"), F.size(d).alias("d_n"))))  # noqa: B023, E731
        own = let(window_hashes(lowered(F.col("text")), c.d_width), found_in)
        hashes = docs.select("doc_id", F.explode(own).alias("d_own")).select("doc_id", "d_own.d_hash", "d_own.d_n")
        hits = hashes.join(small_sketch.where(F.col("d_width") == c.d_width), "d_hash").where("d_n >= d_least").select("doc_id", "item_id")
        found = hits if found is None else found.unionAll(hits)
    if found is None:
        found = docs.select("doc_id").crossJoin(classes.select("item_id")).limit(0)
    candidates = checkpoint(found.distinct())
    held = small(candidates.select(F.col("doc_id").alias("d_doc")).distinct())
    texts = docs.join(held, docs["doc_id"].eqNullSafe(held["d_doc"]), "left_semi")
    grams = (
        candidates.join(texts, candidates["doc_id"].eqNullSafe(texts["doc_id"])).select(candidates["doc_id"], "item_id", "text")
        .join(small(classes), "item_id")
        .select("doc_id", "item_id", "d_grams", windows(lowered(F.col("text")), F.col("d_width"), lambda w: F.array_join(w, " ")).alias("d_own"))
    )
    n, k = F.col("n_shingles"), F.col("n_found")
    return (
        grams.select("doc_id", "item_id", F.size("d_grams").cast("bigint").alias("n_shingles"), F.size(F.array_intersect("d_grams", "d_own")).cast("bigint").alias("n_found"))
        .groupBy("doc_id", "item_id").agg(F.max("n_shingles").alias("n_shingles"), F.max("n_found").alias("n_found"))
        .where(k * 10 >= n * 8).withColumn("containment", F.round(k / n, 6))
    )


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents in which ``find_leaks`` finds an item; columns and repeated rows stay as they are."""
    inner = set_aside(docs, "doc_id", "text")
    leaked = checkpoint(find_leaks(inner, items).select(F.col("doc_id").alias("d_leaked")).distinct())
    return inner.join(small(leaked), F.col("doc_id").eqNullSafe(F.col("d_leaked")), "left_anti").toDF(*docs.columns)


#: DuckDB SQL for ``find_member_leaks``.
ORACLE = """WITH i AS (SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM benchmark),
d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
ig AS (SELECT DISTINCT item_id, w, array_to_string(ws[k:k + w - 1], ' ') AS g FROM (
SELECT item_id, ws, least(len(ws), 5) AS w, unnest(range(1, CAST(len(ws) - least(len(ws), 5) + 2 AS BIGINT))) AS k FROM i WHERE len(ws) > 0)),
dg AS (SELECT DISTINCT doc_id, w, array_to_string(ws[k:k + w - 1], ' ') AS g FROM (
SELECT doc_id, ws, w, unnest(range(1, CAST(len(ws) - w + 2 AS BIGINT))) AS k FROM d, (SELECT DISTINCT w FROM ig) WHERE len(ws) >= w)),
n AS (SELECT item_id, count(*) AS n_shingles FROM ig GROUP BY item_id),
f AS (SELECT doc_id, item_id, count(*) AS n_found FROM ig JOIN dg ON ig.g = dg.g AND ig.w = dg.w GROUP BY doc_id, item_id)
SELECT doc_id, f.item_id, CAST(n_shingles AS BIGINT) AS n_shingles, CAST(n_found AS BIGINT) AS n_found, round(n_found / n_shingles, 6) AS containment
FROM f JOIN n ON f.item_id = n.item_id WHERE n_found * 10 >= n_shingles * 8"""
