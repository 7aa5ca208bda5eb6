"""Layout of records in files: splits, interleaves, buckets, shuffles and manifests."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.plans.physical import global_rank


def split_ceil(df: DataFrame, by: Sequence[str | Column], files: int) -> DataFrame:
    """O3: files of ceil(n / files) rows in order; the last can be short and trailing ones missing."""
    x = global_rank(df, by)
    n = df.count()
    return x.withColumn("file_no", F.floor((F.col("rn") - 1) / max(1, -(-n // files))).cast("bigint")).drop("rn")


def split_even(df: DataFrame, by: Sequence[str | Column], files: int) -> DataFrame:
    """Files that differ by one row at most, the longer ones first, as ntile deals them."""
    x = global_rank(df, by)
    base, over = divmod(df.count(), files)
    at = F.col("rn") - 1
    head = over * (base + 1)
    file_no = F.when(at < head, F.floor(at / (base + 1))).otherwise(over + F.floor((at - head) / max(base, 1)))
    return x.withColumn("file_no", file_no.cast("bigint")).drop("rn")


def split_fixed(df: DataFrame, by: Sequence[str | Column], rows: int) -> DataFrame:
    """Files of ``rows`` rows each, in order."""
    return global_rank(df, by).withColumn("file_no", F.floor((F.col("rn") - 1) / rows).cast("bigint")).drop("rn")


def whole_groups(df: DataFrame, files: str, rows: int) -> DataFrame:
    """Only the files that are full."""
    full = df.groupBy(files).count().where(F.col("count") == rows).select(files)
    return df.join(full, files, "left_semi")


def greedy_fit(df: DataFrame, by: str, order: Sequence[str], size: str, most: int) -> DataFrame:
    """Next-fit: in order, a row opens a new output if the open one holds something and would exceed ``most``.

    The running total restarts, so a group is folded in order; groups are independent. Rows stream through in sorted order with
    one running total, so no group is held in memory.
    """
    schema = df.schema.simpleString()[len("struct<") : -1]

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, total, out = None, 0, 0
        for pdf in batches:
            outputs = []
            for k, s in zip(pdf[by].tolist(), pdf[size].tolist(), strict=True):
                if k != key:
                    key, total, out = k, 0, 0
                if total > 0 and total + s > most:
                    total, out = 0, out + 1
                total += s
                outputs.append(out)
            yield pdf.assign(output=outputs)

    sorted_rows = df.repartition(by).sortWithinPartitions(by, *order)
    return sorted_rows.mapInPandas(fold, f"{schema}, output bigint")


def round_robin(df: DataFrame, source: str, order: Sequence[str | Column]) -> DataFrame:
    """One row of each source in turn until all are used up; ``position`` counts from 1."""
    x = df.withColumn("o_turn", F.row_number().over(Window.partitionBy(source).orderBy(*order)))
    return global_rank(x, ["o_turn", source], "position").drop("o_turn")


def weighted_round_robin(df: DataFrame, source: str, order: Sequence[str | Column], weight: Column) -> DataFrame:
    """Stride scheduling: the k-th row of a source, from 0, has its turn at k / weight; sources settle ties."""
    k = F.row_number().over(Window.partitionBy(source).orderBy(*order)) - 1
    return global_rank(df.withColumn("o_turn", k / weight), ["o_turn", source], "position").drop("o_turn")


def xor_bucket(words: Sequence[Column], buckets: int, seed: int = 0) -> Column:
    """The bucket of a 32-byte position: its four words xor the seed, as unsigned, modulo ``buckets``."""
    x = F.lit(seed).cast("bigint")
    for w in words:
        x = x.bitwiseXOR(w)
    wide = x.cast("decimal(20,0)") + F.when(x < 0, F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(F.lit(0).cast("decimal(20,0)"))
    return (wide % buckets).cast("int")


def seeded_shuffle(df: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    """A permutation that depends on the keys and the seed only; ``position`` counts from 1."""
    x = df.withColumn("o_hash", F.xxhash64(F.lit(seed), *keys))
    return global_rank(x, ["o_hash", *keys], "position").drop("o_hash")


def choose(df: DataFrame, by: str, keys: Sequence[str], seed: int) -> DataFrame:
    """One row of each group by hash, in place of a draw by the clock."""
    return df.groupBy(by).agg(F.min_by(F.struct(*keys), F.struct(F.xxhash64(F.lit(seed), by, *keys), *keys)).alias("r")).select(by, "r.*")


def cyclic(items: Column, offset: Column, at: Column) -> Column:
    """The item at (offset + at) modulo the list's length."""
    return F.element_at(items, (F.pmod(offset + at, F.size(items)) + 1).cast("int"))


def manifest(df: DataFrame, output: str, source: str, size: Column) -> DataFrame:
    """K5: bytes, rows and sources of each output."""
    return df.groupBy(output).agg(F.sum(size).cast("bigint").alias("bytes"), F.count(F.lit(1)).alias("records"), F.count_distinct(source).alias("sources"))


def write_numbered(df: DataFrame, path: str, order: Sequence[str], format: str = "parquet", force: bool = False) -> None:
    """A folder ``file_no=<n>`` for each file, rows in order in each; refuses to overwrite unless ``force``."""
    out = df.repartitionByRange("file_no").sortWithinPartitions("file_no", *order)
    out.write.mode("overwrite" if force else "errorifexists").partitionBy("file_no").format(format).save(path)


def write_lines(df: DataFrame, path: str, at: str) -> None:
    """K7: (at, line) as text in order: each file holds a range of places, and a line begins with its place and a tab."""
    out = df.repartitionByRange(at).sortWithinPartitions(at)
    out.select(F.concat(F.col(at).cast("string"), F.lit("\t"), "line").alias("value")).write.text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(at, line) of what ``write_lines`` has written."""
    return spark.read.text(path).select(F.split("value", "\t", 2)[0].cast("bigint").alias("at"), F.split("value", "\t", 2)[1].alias("line"))


def backup_name(base: Column, stamp: Column, n: Column, ply: Column) -> Column:
    """``base-YYYYMMDDHHMMSS_n`` and ``_ply<l>`` if a limit is given."""
    return F.concat(base, F.lit("-"), stamp, F.lit("_"), n.cast("string"), F.coalesce(F.concat(F.lit("_ply"), ply.cast("string")), F.lit("")))


def latest_backups(names: DataFrame, name: str) -> DataFrame:
    """(base, stamp, n, ply): the newest backup of each base name; names of another form are passed over."""
    form = r"^(.*)-(\d{14})_(\d+)(?:_ply(\d+))?$"
    part = lambda k: F.regexp_extract(name, form, k)
    x = names.where(F.col(name).rlike(form)).select(part(1).alias("base"), part(2).alias("stamp"), part(3).cast("bigint").alias("n"), F.nullif(part(4), F.lit("")).cast("int").alias("ply"))
    newest = F.struct("stamp", "n")
    return x.groupBy("base").agg(F.max_by(F.struct("stamp", "n", "ply"), newest).alias("b")).select("base", "b.*")
