"""The domain's functions under names that SQL can call."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from tessera.functions import codec, rules

#: Functions of built-in expressions, as SQL: their calls are inlined and stay in the JVM.
INLINE = {
    "flip_move": ("move STRING", "STRING", r"""CASE WHEN move RLIKE '^([1-9][a-i]|[A-Z]\\*)[1-9][a-i]\\+?$' THEN translate(move, '123456789abcdefghi', '987654321ihgfedcba') ELSE move END"""),
    "trim_ply": ("sfen STRING", "STRING", r"regexp_replace(trim(sfen), '\\s+\\d+$', '')"),
    "held_eval": ("value INT", "INT", "greatest(least(value, 32767), -32767)"),
}


@udtf(returnType="ply int, prefix array<string>")
class Prefixes:
    """Every prefix of a list of moves, the empty one first."""

    def eval(self, moves: list):
        for k in range(len(moves or ()) + 1):
            yield k, list((moves or ())[:k])


def register(spark: SparkSession) -> None:
    """Registers for the session: flip_move, trim_ply, held_eval, pack_sfen, unpack_sfen, replay, successors, and the table function prefixes."""
    for name, (arguments, kind, body) in INLINE.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {body}")
    for name, f in (("pack_sfen", codec.pack_sfen), ("unpack_sfen", codec.unpack_sfen), ("replay", rules.replayed), ("successors", rules.successors)):
        spark.udf.register(name, f)
    spark.udtf.register("prefixes", Prefixes)
