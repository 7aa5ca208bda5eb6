"""Connected components of a graph given as edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpoint


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for each end of an edge; ``component`` is some id of the component, the same for all of it.

    ``edges`` has columns ``src`` and ``dst`` of one orderable type. In each round every vertex hooks on to
    the neighbour (itself included) of least rank, where ranks are hashes salted by the round; the edges are then
    rewritten between those and loops dropped. Random ranks make long chains shrink by a constant
    factor a round, so rounds grow with the logarithm of the size whatever the order of the ids. A round's minimum is a partial
    aggregate, so a vertex with very many edges sends one row per task. Nothing but the count of remaining edges
    reaches the driver.

    No edges give no rows. Edges with a null end and loops are ignored; repeated edges count once.
    """
    edge = F.struct(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v"))
    e = checkpoint(edges.where("src <> dst").select(edge.alias("e")).select("e.*").distinct())
    hooks: list[DataFrame] = []
    while not e.isEmpty():
        salt = F.lit(len(hooks))
        rank = lambda c: F.struct(F.xxhash64(salt, c).alias("r"), F.col(c).alias("id"))
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hook = checkpoint(
            both.groupBy("u").agg(F.min(rank("v")).alias("m")).select("u", F.least("m", rank("u"))["id"].alias("p"))
        )
        at = lambda c: hook.select(F.col("u").alias(c), F.col("p").alias(f"p{c}"))
        hooks.append(hook)
        e = checkpoint(
            e.join(at("u"), "u").join(at("v"), "v").where("pu <> pv")
            .select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct()
        )
    if not hooks:
        return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    out = hooks[-1].select(F.col("u").alias("id"), F.col("p").alias("component"))
    for hook in reversed(hooks[:-1]):
        up = out.select(F.col("id").alias("p"), F.col("component").alias("c"))
        out = hook.join(up, "p", "left").select(F.col("u").alias("id"), F.coalesce("c", "p").alias("component"))
    return out
