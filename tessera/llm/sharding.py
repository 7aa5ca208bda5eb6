"""Sharding by bytes: Karmarkar-Karp differencing of groups of equal texts."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import checkpoint, partitions, small

SHARDS = 40
EXTRA_BYTES = 16
#: Packs that a bucket's small groups are balanced into before the last differencing; groups in a bucket.
PACKS = 8
BUCKET_GROUPS = 100_000
#: At least so many buckets, so that packs are small beside a shard.
BUCKETS = 256
#: While there are more packs than this, packs are packed again in tasks, so many at a time into so many larger ones, but for
#: one bucket of them, which stay as they are to fill the gaps.
MOST_PACKS = 16_384
AGAIN, INTO = 4096, 1024
#: A group over the 1/FINE part of a shard, in bytes or rows, is not packed; there can be no more than 2 * FINE * shards of these.
FINE = 64


def differencing(sizes: np.ndarray, parts: int) -> np.ndarray:
    """The part, 0 to ``parts - 1``, of each size: Karmarkar-Karp differencing into ``parts`` sums.

    Every size begins as a partial partition whose other sums are zero. The two of largest spread are combined, one in ascending order
    of sums and one in descending, so that large sums meet small ones; sums are kept less their least. When one is left,
    the orders used are followed back to the sizes.
    """
    n = len(sizes)
    out = np.zeros(n, np.int64)
    if n < 2 or parts < 2:
        return out
    zero = np.zeros(parts, np.int64)
    heap: list[tuple[int, int, np.ndarray]] = []
    for k, s in enumerate(sizes.tolist()):
        sums = zero.copy()
        sums[-1] = s
        heap.append((-s, k, sums))
    heapq.heapify(heap)
    merged: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)
        _, b, y = heap[0]
        sums = x + y[::-1]  # both ascend
        order = np.argsort(sums, kind="stable")
        sums = sums[order]
        sums -= sums[0]
        merged.append((a, b, order))
        heapq.heapreplace(heap, (-int(sums[-1]), n + len(merged) - 1, sums))
    places: dict[int, np.ndarray] = {n + len(merged) - 1: np.arange(parts)}
    for k in range(len(merged) - 1, -1, -1):
        a, b, order = merged[k]
        labels = np.empty(parts, np.int64)
        labels[order] = places.pop(n + k)  # the part of x's sum at each place before the sort
        for child, own in ((a, labels), (b, labels[::-1])):
            if child < n:
                out[child] = own[-1]
            else:
                places[child] = own
    return out


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, g1, g2): g1 and g2, two hashes of the text, name its group; a null text is as an empty one."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", (F.octet_length(text) + EXTRA_BYTES).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("g1"), F.xxhash64(F.lit(1), text).alias("g2"),
    )


def packed(units: DataFrame, buckets: int, parts: int, whole: bool = False) -> DataFrame:
    """``units`` (id, bytes) with the pack of each: a bucket by the hash of the id, balanced into ``parts`` packs by differencing, a task at a time.

    With ``whole``, each unit of the first bucket is a pack by itself.
    """
    kind = units.schema["id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        x = pa.Table.from_batches(tables).combine_chunks()
        size, bucket, tie = (x.column(k).to_numpy() for k in (1, 2, 3))
        order = np.lexsort((tie, bucket))
        for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            alone = whole and bucket[own[0]] == 0
            part = -1 - np.arange(len(own)) if alone else differencing(size[own], parts)
            ids = x.column(0).take(pa.array(own)).combine_chunks()
            yield pa.RecordBatch.from_arrays([ids, pa.array(size[own]), pa.array(bucket[own] * parts + part)], ["id", "bytes", "pack"])

    n = min(buckets, max(partitions(units.sparkSession), buckets // 8))
    dealt = units.withColumn("tie", F.xxhash64("id")).select("id", "bytes", F.pmod("tie", F.lit(buckets)).cast("bigint").alias("bucket"), "tie")
    return dealt.repartition(n, "bucket").mapInArrow(pack, f"id {kind}, bytes bigint, pack bigint")


def assign(rows: DataFrame, shards: int = SHARDS, bucket_groups: int = BUCKET_GROUPS, most: int = MOST_PACKS, again: int = AGAIN, into: int = INTO) -> DataFrame:
    """(g1, g2, shard) for each group of ``rows`` (size, g1, g2), which should be cheap to read again.

    Groups are summed with partial aggregates. Small groups are dealt to buckets by hash, and each bucket is balanced into
    packs by differencing, a task at a time. While there are more than ``most`` packs, those are packed in the same way. What is left, and the few large
    groups, whose number is bounded, is balanced into the shards by differencing on the driver, which so holds at most ``most`` packs and 128 groups a shard.
    """
    spark = rows.sparkSession
    groups = checkpoint(rows.groupBy("g1", "g2").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")))
    t = groups.agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups")).first()
    schema = "g1 bigint, g2 bigint, shard int"
    if not t.groups:
        return spark.createDataFrame([], schema)
    is_large = f"bytes > {t.bytes // (FINE * shards)} OR n > {t.n // (FINE * shards)} AND n > 1"
    large = groups.where(is_large).orderBy("g1", "g2").collect()
    buckets = max(BUCKETS, -(-t.groups // bucket_groups))
    units = groups.where(f"NOT ({is_large})").select(F.struct("g1", "g2").alias("id"), "bytes")
    levels = [checkpoint(packed(units, buckets, PACKS))]
    while (n := (packs := levels[-1].groupBy("pack").agg(F.sum("bytes").alias("bytes"))).count()) > most:
        levels.append(checkpoint(packed(packs.withColumnRenamed("pack", "id"), -(-n // again), into, whole=True)))
    top = packs.orderBy("pack").collect()
    shard = differencing(np.array([r["bytes"] for r in top] + [r["bytes"] for r in large], np.int64), shards).tolist()
    placed = spark.createDataFrame([(r.pack, s) for r, s in zip(top, shard, strict=False)], "pack bigint, shard int")
    for level in reversed(levels):
        placed = level.join(small(placed), "pack").select("id", "shard").withColumnRenamed("id", "pack")
    of_large = spark.createDataFrame([(r.g1, r.g2, s) for r, s in zip(large, shard[len(top) :], strict=True)], schema)
    return placed.select("pack.g1", "pack.g2", "shard").unionByName(of_large)


def shard_table(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of ``docs``, under the law ``bytes``.

    A document's size is its UTF-8 bytes and 16. Equal texts (null counts as empty) are one group, which stays in one shard; the
    shards' bytes are nearly equal unless a single group exceeds a shard's share, in which case it fills its shard alone and
    the others are equal. Slots number a shard's rows without gaps from 0 in an order that hashes give. Rows that are repeated have slots of
    their own. An empty table gives an empty result; only doc_id and text are read, the texts once.

    Slots are counted in two steps, within pieces of a shard and over the pieces' counts, so no task numbers a whole shard.
    """
    rows = checkpoint(sized(docs.select("doc_id", "text")))
    groups = checkpoint(assign(rows, shards))
    heavy = checkpoint(groups.join(rows.groupBy("g1", "g2").count().where(f"count > {10_000}"), ["g1", "g2"]).select("g1", "g2", "shard"))
    by = ["g1", "g2"]
    hot = small(heavy)
    placed = rows.join(hot, by).unionByName(rows.join(hot, by, "left_anti").join(groups, by)) if not heavy.isEmpty() else rows.join(groups, by)
    piece = F.pmod(F.xxhash64("doc_id", "g1"), F.lit(max(8, partitions(docs.sparkSession) // 4))).cast("int")
    placed = checkpoint(placed.withColumn("piece", piece))
    counts = placed.groupBy("shard", "piece").count()
    before = F.sum("count").over(Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("shard", "piece", F.coalesce(before, F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("shard", "piece").orderBy(F.xxhash64("g1", "doc_id"), "g1", "g2", "doc_id"))
    return placed.withColumn("k", within).join(small(checkpoint(starts)), ["shard", "piece"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("start") + F.col("k") - 1).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
