"""Mixing sources to target weights: exact block quotas, split among shards by a multivariate-hypergeometric tree, and permuted blocks drawn for them."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import checkpoint, partitions, set_aside, small, words

WEIGHTS = (1, 2, 3)
REPEATS = 3
SHARDS = 16
BLOCK_WORDS = 1 << 18
SEED = 20_240_601
#: Blocks whose words are added up as one in the first of two steps that find where a source's last copy ends.
STRETCH = 4096


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, repeats: float = REPEATS) -> list[float]:
    """Shares of ``total`` by weight, none above ``repeats`` times its size; what exceeds that is reshared by weight."""
    out, free = [0.0] * len(sizes), list(range(len(sizes)))
    while free:
        rest = total - sum(out[k] for k in range(len(sizes)) if k not in set(free))
        unit = rest / sum(weights[k] for k in free)
        full = [k for k in free if unit * weights[k] > repeats * sizes[k]]
        for k in full or free:
            out[k] = float(repeats * sizes[k]) if full else unit * weights[k]
        if not full:
            break
        free = [k for k in free if k not in set(full)]
    return out


def split_tree(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (row) in each shard (column); rows add up to the quotas, columns differ by one block at most.

    A node draws the blocks of its left half of the shards without replacement from its own, a multivariate
    hypergeometric draw, and passes the rest to its right half, so each shard's blocks are a random
    sample of all blocks while every quota is met exactly. Each node has its own seed.
    """
    out = np.zeros((len(quotas), shards), np.int64)
    todo = [(np.asarray(quotas, np.int64), 0, shards)]
    while todo:
        have, a, b = todo.pop()
        if b - a == 1:
            out[:, a] = have
            continue
        mid, n = (a + b) // 2, int(have.sum())
        per, over = divmod(n, b - a)
        left = per * (mid - a) + min(over, mid - a)
        rng = np.random.default_rng([seed, a, b])
        taken = rng.multivariate_hypergeometric(have, left, method="marginals") if n else have
        todo += [(taken, a, mid), (have - taken, mid, b)]
    return out


def fitted(sizes: np.ndarray, goal: int) -> np.ndarray:
    """Which of the sizes to take for a sum near ``goal``: in order each that still fits, then the best exchanges of one for one."""
    take, left = np.zeros(len(sizes), bool), goal
    for k, x in enumerate(sizes.tolist()):
        if x <= left:
            take[k], left = True, left - x
    for _ in range(16):
        inside, outside = np.flatnonzero(take), np.flatnonzero(~take)
        if not left or not len(outside):
            break
        outside = outside[np.argsort(sizes[outside], kind="stable")]
        have = np.append(sizes[inside], 0)  # the last: nothing goes out
        at = np.searchsorted(sizes[outside], have + left)
        misses = [np.abs(sizes[outside[np.clip(at - d, 0, len(outside) - 1)]] - have - left) for d in (0, 1)]
        d = int(misses[1].min() < misses[0].min())
        k = int(misses[d].argmin())
        if misses[d][k] >= abs(left):
            break
        new = outside[min(max(at[k] - d, 0), len(outside) - 1)]
        left -= int(sizes[new] - have[k])
        take[new] = True
        if k < len(inside):
            take[inside[k]] = False
    return take


def order_key(seed: int) -> Column:
    """The document's place in its source's random order; it depends on the document and the seed only."""
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("x_size"))


def sized(docs: DataFrame, seed: int) -> DataFrame:
    """``docs`` with ``x_size``, its words, and ``x_u``, its place in the random order."""
    return docs.withColumn("x_size", F.size(words(F.col("text"))).cast("bigint")).withColumn("x_u", order_key(seed))


def permutation(source: str | None, copy: int, blocks: int, seed: int) -> tuple[int, int]:
    """(a, c) of the permutation ``b -> (a * b + c) mod blocks`` in which a copy's blocks are drawn."""
    rng = np.random.default_rng([seed, copy, *(source or "").encode(), 0 if source is None else 1])
    c, a = int(rng.integers(blocks)), int(rng.integers(blocks)) | 1
    while math.gcd(a, blocks) != 1:
        a += 1
    return a % blocks, c


def plan(base: DataFrame, weights: Sequence[float], repeats: int, shards: int, block_words: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The draws, as two tables, from ``base`` (doc_id, source, x_size, x_u), which should be cheap to read again.

    The first has a row per source: its size, target and blocks, the permutation of each copy, the place of the block that is drawn in part (or -1), and the ends of
    the shards' runs in its list of blocks: the tree's quotas, added up. The second has the documents drawn from that last block:
    in random order every one that still fits, then exchanges of one for another that bring the sum nearer.

    The driver holds a row per source and a count per source and shard, never a row per document or block.
    """
    spark = base.sparkSession
    rows = base.groupBy("source").agg(F.sum("x_size").alias("size")).collect()
    rows.sort(key=lambda r: (r.source is None, r.source or ""))  # str order is by code point
    sizes = [r["size"] or 0 for r in rows]
    goals = targets(sizes, [weights[k % len(weights)] for k in range(len(rows))], float(sum(sizes)), repeats)
    copies = [min(repeats, int(g // s)) if s else 0 for g, s in zip(goals, sizes, strict=True)]
    rest = [max(0, round(g - c * s)) if c < repeats else 0 for g, c, s in zip(goals, copies, sizes, strict=True)]
    blocks = [max(1, math.ceil(s / block_words)) for s in sizes]
    turns = [[permutation(r.source, k, b, seed) for k in range(repeats)] for r, b in zip(rows, blocks, strict=True)]
    parts = [(r.source, x, b, *t[min(c, repeats - 1)]) for r, x, b, t, c in zip(rows, rest, blocks, turns, copies, strict=True) if x]
    per = spark.createDataFrame(parts, "x_source string, x_rest bigint, x_blocks bigint, x_a bigint, x_c bigint")
    same = F.col("source").eqNullSafe(F.col("x_source"))
    dealt = base.join(small(per), same).withColumn("x_place", F.expr("pmod(x_a * pmod(x_u, x_blocks) + x_c, x_blocks)"))
    sums = checkpoint(dealt.groupBy("x_source", "x_place", "x_rest").agg(F.sum("x_size").alias("n")).withColumn("x_stretch", F.floor(F.col("x_place") / STRETCH)))
    before = lambda by: F.sum("n").over(Window.partitionBy("x_source").orderBy(by)) - F.col("n")
    wide = sums.groupBy("x_source", "x_stretch", "x_rest").agg(F.sum("n").alias("n")).withColumn("x_before", before("x_stretch"))
    wide = wide.where("x_before < x_rest AND x_rest <= x_before + n").select(F.col("x_source").alias("w_source"), F.col("x_stretch").alias("w_stretch"), "x_before")
    inside = F.col("x_source").eqNullSafe(F.col("w_source")) & (F.col("x_stretch") == F.col("w_stretch"))
    ends = (
        sums.join(small(wide), inside).withColumn("x_before", F.col("x_before") + before("x_place"))
        .where("x_before < x_rest AND x_rest <= x_before + n")
        .select(F.col("x_source").alias("e_source"), F.col("x_place").alias("x_edge"), (F.col("x_rest") - F.col("x_before")).alias("x_left"))
    )
    ends = checkpoint(ends)
    at = F.col("x_source").eqNullSafe(F.col("e_source"))
    edge = dealt.join(small(ends), at & (F.col("x_place") == F.col("x_edge"))).where("x_size > 0")
    units = edge.groupBy("source", "doc_id", "x_u", "x_left").agg(F.sum("x_size").alias("n"))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["x_u", "doc_id"], kind="stable")
        take = fitted(pdf["n"].to_numpy(), int(pdf["x_left"].iloc[0]))
        return pdf.loc[take, ["source", "doc_id", "x_u"]]

    kind = base.schema["doc_id"].dataType.simpleString()
    filled = checkpoint(units.groupBy("source").applyInPandas(fill, f"source string, doc_id {kind}, x_u bigint"))
    edges = {r.e_source: r.x_edge for r in ends.collect()}
    quotas = [c * b + (edges[r.source] + 1 if r.source in edges else 0) for r, c, b in zip(rows, copies, blocks, strict=True)]
    ends_of = np.cumsum(split_tree(quotas, shards, seed), axis=1).tolist() if rows else []
    last = [c * b + edges[r.source] if r.source in edges else -1 for r, c, b in zip(rows, copies, blocks, strict=True)]
    full = [(r.source, s, g, b, [[*x] for x in t], e, o) for r, s, g, b, t, e, o in zip(rows, sizes, goals, blocks, turns, last, ends_of, strict=True)]
    kinds = "x_source string, x_source_size bigint, x_target double, x_blocks bigint, x_turns array<array<bigint>>, x_last bigint, x_ends array<bigint>"
    chosen = filled.select(F.col("source").alias("f_source"), F.col("doc_id").alias("f_id"), F.col("x_u").alias("f_u"), F.lit(True).alias("x_filled"))
    return spark.createDataFrame(full, kinds), chosen


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    repeats: int = REPEATS,
    shards: int = SHARDS,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
    base: DataFrame | None = None,
) -> DataFrame:
    """``docs`` with ``x_size``, ``x_source_size``, ``x_target`` and ``x_draws``: array of (copy, block, place, shard), one for each time it is drawn.

    Sources in code point order, null last, weigh ``weights`` in turn and share the words of all; a target stops at ``repeats`` times
    its source's words, and the excess is reshared. A source's list of blocks is its copies one after the other, each in a permutation of its own;
    a block is hashed from its documents. The source's quota is the number of blocks at the head of that list whose words reach the target. The
    splitting tree deals the quotas to the shards, and each shard draws its number of blocks from every list, where the one before it has
    stopped: so blocks are disjoint, and a document is taken exactly as often as its block lies in some shard's run. Documents are drawn whole. Only
    the last block of a quota is drawn in part.

    ``docs`` needs doc_id, text and source; other columns pass through, but none may begin with ``x_`` (``mixed`` sets them aside). A null or empty text has no
    words; it is drawn with its block. Rows with the same source, doc_id and size are drawn alike. A null source is a source of its own. An
    empty table gives an empty result. The same rows and seed always give the same draws. ``base`` may give the narrow (doc_id, source, x_size,
    x_u) of ``docs`` where it has been computed before.
    """
    if base is None:
        base = checkpoint(sized(docs.select("doc_id", "source", "text"), seed).drop("text"))
    per, chosen = plan(base, weights, repeats, shards, block_words, seed)
    chosen = small(chosen)
    rows = docs if "x_u" in docs.columns else sized(docs, seed)
    rows = rows.join(small(per), F.col("source").eqNullSafe(F.col("x_source")), "left").withColumn("x_block", F.expr("pmod(x_u, x_blocks)"))
    one = F.col("source").eqNullSafe(F.col("f_source")) & F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("x_u") == F.col("f_u"))
    rows = rows.join(chosen, one, "left")
    place = lambda t, k: k * F.col("x_blocks") + F.pmod(t[0] * F.col("x_block") + t[1], F.col("x_blocks"))
    draws = F.transform(
        F.transform("x_turns", lambda t, k: F.struct((k + 1).cast("bigint").alias("copy"), F.col("x_block").alias("block"), place(t, k).alias("place"))),
        lambda d: F.struct(d["copy"].alias("copy"), d["block"].alias("block"), d["place"].alias("place"), F.size(F.filter("x_ends", lambda e: e <= d["place"])).alias("shard")),
    )
    drawn = F.filter(draws, lambda d: (d["shard"] < F.size("x_ends")) & ((d["place"] != F.col("x_last")) | F.coalesce("x_filled", F.lit(False)) | (F.col("x_size") == 0)))
    gone = ["x_source", "x_blocks", "x_turns", "x_last", "x_ends", "x_block", "f_source", "f_id", "f_u", "x_filled"]
    return rows.withColumn("x_draws", drawn).drop(*gone)


def mixed(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The rows of the mix with the columns of ``docs``: each document as often as it is drawn, by shard, in a random order in each."""
    inner = set_aside(docs, "doc_id", "text", "source")
    out = mix(inner, seed=seed, **options).select(*inner.columns, "x_u", F.explode("x_draws").alias("x_draw"))
    n = max(partitions(docs.sparkSession), options.get("shards", SHARDS))
    place = F.xxhash64(F.lit(seed + 1), "x_u", "x_draw.copy")
    return out.repartition(n, "x_draw.shard", F.pmod(F.col("x_draw.block"), F.lit(8))).sortWithinPartitions("x_draw.shard", place).select(*inner.columns).toDF(*docs.columns)


def mix_table(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, shards) for each row of ``docs``: ``shards`` are those that draw it, one for each time.

    ``taken`` is the words of these draws. Nulls, empty texts, repeated rows and an empty table are as in ``mix``; other columns are not read.
    """
    base = checkpoint(sized(docs.select("doc_id", "source", "text"), SEED).drop("text"))
    out = mix(base, base=base)
    return out.select(
        "doc_id", F.col("x_size").alias("size"), F.col("x_source_size").alias("source_size"), F.col("x_target").alias("target"),
        (F.col("x_size") * F.size("x_draws")).cast("bigint").alias("taken"), F.transform("x_draws", lambda d: d["shard"]).alias("shards"),
    )
