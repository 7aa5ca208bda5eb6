"""Registered queries of the domain's functions, formats, walks and streams, over relations and files made from the test tables, with their DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.functions import codec, scalars, sfen
from tessera.functions.codec import little
from tessera.operators import books, games, graph, layout, lookups, positions, walks, windows
from tessera.plans.catalog import EDGE, edges, roots
from tessera.plans.physical import checkpoint, global_rank, scratch
from tessera.plans.projections import projection, sql
from tessera.plans.registry import moves, query, table
from tessera.sources import records, sinks, training
from tessera.streaming import rates

# ---- positions, moves and numbers ----

#: Positions for the queries, by the number of a part: a board of two kings and some pieces, a side, hands and a ply.
BOARD = "CAST(p_size % 8 + 1 AS STRING) || 'k' || CASE p_size % 3 WHEN 0 THEN '+P' WHEN 1 THEN 'r' ELSE 'G' END || CASE WHEN p_size % 8 = 7 THEN '' ELSE '' END || '/9/9/' || CASE WHEN p_partkey % 2 = 0 THEN '4p4' ELSE '3+bN4' END || '/9/9/9/9/4K4'"
SIDE = "CASE WHEN p_partkey % 3 = 0 THEN 'w' ELSE 'b' END"
HANDS = "CASE p_partkey % 4 WHEN 0 THEN '-' WHEN 1 THEN '2Pp' WHEN 2 THEN 'RG3s' ELSE 'b4l' END"
POSITION = f"{BOARD} || ' ' || {SIDE} || ' ' || {HANDS} || ' ' || CAST(p_partkey % 97 + 1 AS STRING)"
#: The same turned by hand: the board from the end, pieces' colours swapped, hands swapped.
TURNED = f"""'4k4/9/9/9/9/' || CASE WHEN p_partkey % 2 = 0 THEN '4P4' ELSE '4n+B3' END || '/9/9/' || CASE p_size % 3 WHEN 0 THEN '+p' WHEN 1 THEN 'R' ELSE 'g' END || 'K' || CAST(p_size % 8 + 1 AS STRING) || ' ' ||
CASE WHEN p_partkey % 3 = 0 THEN 'b' ELSE 'w' END || ' ' || CASE p_partkey % 4 WHEN 0 THEN '-' WHEN 1 THEN 'P2p' WHEN 2 THEN '3Srg' ELSE 'B4L' END"""


def positions_of(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", F.expr(POSITION).alias("sfen"))


def duck(text: str) -> str:
    return text.replace("AS STRING", "AS VARCHAR")


@query(duck(f"SELECT p_partkey, {SIDE} AS side, CAST(p_partkey % 97 + 1 AS INT) AS ply, {BOARD} || ' ' || {SIDE} || ' ' || {HANDS} AS key FROM part WHERE p_partkey % 97 + 1 <= 40"))
def sfen_fields(spark, sf_dir):
    x, s = positions_of(spark, sf_dir), F.col("sfen")
    return x.where(sfen.ply(s) <= 40).select("p_partkey", sfen.side(s).alias("side"), sfen.ply(s).alias("ply"), sfen.trim_ply(s).alias("key"))


@query(duck(f"SELECT p_partkey, {TURNED} || ' ' || CAST(p_partkey % 97 + 1 AS STRING) AS turned, {POSITION} AS again FROM part"))
def flipped_positions(spark, sf_dir):
    turned = sfen.flip_sfen(F.col("sfen"))
    return positions_of(spark, sf_dir).select("p_partkey", turned.alias("turned"), sfen.flip_sfen(turned).alias("again"))


#: A full set of pieces, as packed positions need: the board differs by where the rooks and the pawns of a file stand, and by the hands.
FULL = """'lnsgkgsnl/1r5b1/ppppppp' || CASE k % 3 WHEN 0 THEN 'pp' ELSE '2' END || '/' || CASE k % 5 WHEN 0 THEN '9' WHEN 1 THEN '4+P4' ELSE '3+n5' END || '/9/9/' || CASE WHEN k % 5 = 1 THEN 'PPPP1PPPP' ELSE 'PPPPPPPPP' END ||
'/1B5R1/L' || CASE WHEN k % 5 > 1 THEN '1' ELSE 'N' END || 'SGKGSNL ' || CASE k % 2 WHEN 0 THEN 'b ' ELSE 'w ' END || CASE k % 3 WHEN 0 THEN '-' WHEN 1 THEN '2P' ELSE 'Pp' END || ' ' || CAST(k % 300 + 1 AS STRING)"""


@query(duck(f"SELECT k, {FULL} AS sfen, CAST(32 AS INT) AS bytes, k % 2 AS side FROM (SELECT s_suppkey AS k FROM supplier)"))
def packed_positions(spark, sf_dir):
    x = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")).withColumn("sfen", F.expr(FULL))
    x = x.withColumns({"packed": codec.pack_sfen("sfen"), "ply": sfen.ply(F.col("sfen"))})
    side = training.side_to_move(F.col("packed")).cast("bigint")
    return x.select("k", codec.unpack_sfen("packed", "ply").alias("sfen"), F.length("packed").alias("bytes"), side.alias("side"))


MOVE = """CASE WHEN k % 11 = 0 THEN substr('PLNSBRG', CAST(k % 7 + 1 AS INT), 1) || '*' ELSE CAST(k % 9 + 1 AS STRING) || substr('abcdefghi', CAST(k % 8 + 1 AS INT), 1) END ||
CAST((k + 3) % 9 + 1 AS STRING) || substr('abcdefghi', CAST((k + 1) % 9 + 1 AS INT), 1) || CASE WHEN k % 11 <> 0 AND k % 5 = 0 THEN '+' ELSE '' END"""
CODE = """((k + 3) % 9 * 9 + (k + 1) % 9) + 128 * CASE WHEN k % 11 = 0 THEN k % 7 + 1 ELSE k % 9 * 9 + k % 8 END + CASE WHEN k % 11 = 0 THEN 16384 WHEN k % 5 = 0 THEN 32768 ELSE 0 END"""


@query(duck(f"SELECT k, {MOVE} AS move, CAST(CASE WHEN {CODE} >= 32768 THEN {CODE} - 65536 ELSE {CODE} END AS INT) AS signed FROM (SELECT c_custkey AS k FROM customer)"))
def move_codes(spark, sf_dir):
    x = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).select("k", F.expr(CODE).cast("int").alias("m"))
    raw = sinks.bits(F.col("m"), 2)
    return x.select("k", codec.usi_of(little(raw, 0, 2)).alias("move"), little(raw, 0, 2, True).alias("signed"))


@query(duck(f"""SELECT k, translate(move, '123456789abcdefghi', '987654321ihgfedcba') AS turned, CASE WHEN k % 4 = 0 THEN 'none' ELSE move END AS normal FROM (SELECT k, {MOVE} AS move FROM (SELECT c_custkey AS k FROM customer))"""))
def move_texts(spark, sf_dir):
    x = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).withColumn("move", F.expr(MOVE))
    raw = F.expr(f"CASE k % 4 WHEN 0 THEN element_at(array('None', 'resign', '', ' NONE '), CAST(k DIV 4 % 4 + 1 AS INT)) ELSE concat(' ', {MOVE}, ' ') END")
    return x.select("k", sfen.flip_move(F.col("move")).alias("turned"), sfen.normal_move(raw).alias("normal"))


@query("""SELECT k, CASE WHEN k % 2 = 0 THEN greatest(least(v, 30000), -30000) WHEN n > 0 THEN 32000 - n ELSE -32000 - n END AS score,
CAST(CASE WHEN abs(o) > 90000 THEN CASE WHEN o > 0 THEN o - 68000 ELSE o + 68000 END ELSE greatest(least(o, 32000), -32000) END AS INT) AS legacy,
greatest(least(v, 32767), -32767) AS held, CAST(v % 65536 + CASE WHEN v % 65536 < 0 THEN 65536 ELSE 0 END - CASE WHEN (v % 65536 + 65536) % 65536 >= 32768 THEN 65536 ELSE 0 END AS INT) AS wrapped
FROM (SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS INT) - 100000 AS v, CAST(o_orderkey % 61 - 30 + CASE WHEN o_orderkey % 61 = 30 THEN 1 ELSE 0 END AS INT) AS n,
CASE WHEN o_orderkey % 3 = 0 THEN 99990 + CAST(o_orderkey % 10 AS INT) WHEN o_orderkey % 3 = 1 THEN -99999 ELSE CAST(o_orderkey % 70000 - 35000 AS INT) END AS o FROM orders)""")
def evaluations(spark, sf_dir):
    x = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k", "CAST(floor(o_totalprice) AS INT) - 100000 AS v", "CAST(o_orderkey % 61 - 30 + CASE WHEN o_orderkey % 61 = 30 THEN 1 ELSE 0 END AS INT) AS n",
        "CASE WHEN o_orderkey % 3 = 0 THEN 99990 + CAST(o_orderkey % 10 AS INT) WHEN o_orderkey % 3 = 1 THEN -99999 ELSE CAST(o_orderkey % 70000 - 35000 AS INT) END AS o",
    )
    even, v = F.col("k") % 2 == 0, F.col("v")
    text = F.when(even, v.cast("string")).when(F.abs("n") == 1, F.when(F.col("n") > 0, "+").otherwise("-")).otherwise(F.col("n").cast("string"))
    return x.select(
        "k", sfen.score(F.when(even, "cp").otherwise("mate"), text).alias("score"), sfen.legacy_eval(F.col("o")).alias("legacy"),
        sfen.clamp16(v).alias("held"), sfen.signed16(F.pmod(v, F.lit(65536))).alias("wrapped"),
    )


@query("""SELECT p_partkey, round(CASE WHEN v = 1 THEN 30000.0 WHEN v = 0 THEN -30000.0 ELSE greatest(least(-600 * ln(1 / nullif(nullif(v, 0), 1) - 1), 30000.0), -30000.0) END, 4) AS score,
round(power(0.0001 / 0.01, 1.0 / greatest(p_size - 3, 1)), 9) AS gamma, CAST(greatest(floor(p_size * (p_partkey % 7) / 8.0 + 0.5), 1) AS BIGINT) AS nodes FROM (SELECT *, (p_partkey % 101) / 100.0 AS v FROM part)""")
def rates_and_logits(spark, sf_dir):
    x = table(spark, sf_dir, "part")
    return x.select(
        "p_partkey", F.round(scalars.value_score((F.col("p_partkey") % 101) / 100.0, 600.0), 4).alias("score"),
        F.round(scalars.decay_rate(F.lit(0.01), F.lit(0.0001), F.col("p_size") - 3), 9).alias("gamma"),
        scalars.scaled_nodes(F.col("p_size"), (F.col("p_partkey") % 7) / 8.0).alias("nodes"),
    )


@query("""SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE make_date(2020 + c_custkey % 5, c_custkey % 12 + 1, c_custkey % 28 + 1) END AS day FROM customer""")
def first_dates(spark, sf_dir):
    """A date that doesn't exist stands before the one that does; every seventh text has none."""
    y, m, d = (F.lpad(F.expr(e).cast("string"), n, "0") for e, n in (("2020 + c_custkey % 5", 4), ("c_custkey % 12 + 1", 2), ("c_custkey % 28 + 1", 2)))
    dash = F.expr("element_at(array('-', '/', '', '.'), CAST(c_custkey % 4 + 1 AS INT))")
    text = F.when(F.col("c_custkey") % 7 == 0, "on 2025-02-30, or 20251301").otherwise(F.concat(F.lit("from 2025-02-30 "), y, dash, m, dash, d, F.lit(" to 2031-01-01")))
    return table(spark, sf_dir, "customer").select("c_custkey", records.first_date(text).alias("day"))


@query("""SELECT n AS nation, CASE WHEN n % 3 = 0 THEN make_date(2000 + n, 1, 1) WHEN n % 3 = 1 THEN make_date(2000 + n, n % 12 + 1, 5) END AS first,
CASE WHEN n % 3 = 0 THEN make_date(2000 + n, 12, 31) WHEN n % 3 = 1 THEN make_date(2000 + n, n % 12 + 1, 5) END AS last, CAST(n % 4 AS INT) AS days FROM (SELECT n_nationkey AS n FROM nation)""")
def date_bounds(spark, sf_dir):
    x = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("n"))
    text = F.expr("CASE n % 3 WHEN 0 THEN concat(' ', CAST(2000 + n AS STRING)) WHEN 1 THEN concat(CAST(2000 + n AS STRING), '/', CAST(n % 12 + 1 AS STRING), '-5') ELSE '2025-02-30' END")
    text = F.regexp_replace(text, r"^(\d{4}/\d+)-5$", "$1/05")
    start = F.lit("2024-02-27").cast("date")
    return x.select(
        F.col("n").alias("nation"), scalars.bound_day(text, False).alias("first"), scalars.bound_day(text, True).alias("last"),
        F.size(scalars.days(start, F.date_add(start, F.col("n") % 4 - 1))).alias("days"),
    )


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 6 = 5 THEN NULL ELSE s_suppkey * CASE s_suppkey % 6 WHEN 1 THEN 1024 WHEN 2 THEN 1048576 WHEN 3 THEN 1073741824 WHEN 4 THEN 1099511627776 ELSE 1 END END AS bytes,
CAST(CASE s_suppkey % 4 WHEN 0 THEN -s_suppkey WHEN 1 THEN 0 WHEN 2 THEN s_suppkey ELSE 9 END AS BIGINT) AS number FROM supplier""")
def sizes_and_numbers(spark, sf_dir):
    size = F.expr("concat(' ', CAST(s_suppkey AS STRING), element_at(array('', 'K', 'MB', 'GiB', 't', 'x'), CAST(s_suppkey % 6 + 1 AS INT)))")
    text = F.expr("CASE s_suppkey % 4 WHEN 0 THEN concat('-', CAST(s_suppkey AS STRING), 'abc') WHEN 1 THEN 'abc12' WHEN 2 THEN concat('+', CAST(s_suppkey AS STRING), ' 7') ELSE '' END")
    return table(spark, sf_dir, "supplier").select("s_suppkey", records.size_bytes(size).alias("bytes"), scalars.leading_number(text, 9).alias("number"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '..' WHEN 1 THEN 'a_b_' || CAST(p_size AS VARCHAR) ELSE 'x_y_z' END AS safe,
'f(' || CAST(7 AS VARCHAR) || ', a_10, b_a_1) ' || CASE WHEN p_size % 2 = 0 THEN 'a_1' ELSE '7' END || ' ' || CAST(p_size AS VARCHAR) AS replaced, p_size % 2 = 0 AS spaceless FROM part""".replace("CASE WHEN p_size % 2 = 0 THEN 'a_1' ELSE '7' END", "'7'"))
def text_helpers(spark, sf_dir):
    name = F.expr("CASE p_partkey % 3 WHEN 0 THEN '..' WHEN 1 THEN concat('a:b|', CAST(p_size AS STRING)) ELSE 'x\\ty?z' END")
    line = F.expr("concat('f(a_1, a_10, b_a_1) a_1 ', CAST(p_size AS STRING))")
    spaced = F.expr("CASE WHEN p_size % 2 = 0 THEN 'int  x =\\t3 ;' ELSE 'int y = 3;' END")
    return table(spark, sf_dir, "part").select(
        "p_partkey", scalars.safe_part(name).alias("safe"), scalars.replace_names(line, {"a_1": "7", "a": "a_1"}).alias("replaced"), spaced.rlike(scalars.spaceless("int x=3;")).alias("spaceless")
    )


@query("""SELECT n_nationkey, CAST(CASE n_nationkey % 5 WHEN 0 THEN 1989 + n_nationkey % 5 + 1 WHEN 1 THEN 1990 + n_nationkey + 6 WHEN 2 THEN 2020 WHEN 3 THEN 2000 + n_nationkey END AS INT) AS year FROM nation""")
def event_years(spark, sf_dir):
    path = F.expr("""CASE n_nationkey % 5 WHEN 0 THEN concat('/k/wcsc', CAST(n_nationkey % 5 + 1 AS STRING), '/a.csa') WHEN 1 THEN concat('WCSC', CAST(n_nationkey + 6 AS STRING))
    WHEN 2 THEN 'x/wcso1/g.kif' WHEN 3 THEN concat('wdoor', CAST(2000 + n_nationkey AS STRING), '/b') ELSE 'other' END""")
    return table(spark, sf_dir, "nation").select("n_nationkey", games.event_year(path).alias("year"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{"event":"' || event_type || '","user":' || CAST(user_id AS VARCHAR) || '}' AS line, CAST(list_position(['view', 'click', 'error'], event_type) AS BIGINT) AS place FROM events""".replace(
    "CAST(list_position(['view', 'click', 'error'], event_type) AS BIGINT)", "CAST(CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'error' THEN 2 ELSE -1 END AS BIGINT)"))
def json_messages(spark, sf_dir):
    x = table(spark, sf_dir, "events")
    line = scalars.message([("event", F.col("event_type")), ("user", F.col("user_id")), ("none", F.lit(None).cast("string"))])
    known = F.array(*map(F.lit, ("view", "click", "error")))
    return x.select("event_id", scalars.command(F.col("props"), "k bigint")["k"].alias("k"), line.alias("line"), scalars.place_of(known, F.col("event_type")).alias("place"))


@query("""SELECT c_custkey, TRY_CAST(CASE WHEN c_custkey % 9 = 0 THEN 'x' ELSE CAST(c_custkey AS VARCHAR) END AS INT) AS number, CASE WHEN c_custkey % 4 = 0 THEN 400 ELSE CAST(c_custkey AS INT) END AS eval_limit,
CASE WHEN c_custkey % 5 = 0 THEN 32 ELSE CAST(c_custkey AS INT) END AS book_ply FROM customer""")
def defaults_and_bad_fields(spark, sf_dir):
    """nulls of options become defaults; fields that can't be read become null."""
    x = table(spark, sf_dir, "customer").select(
        "c_custkey", F.expr("CASE WHEN c_custkey % 9 = 0 THEN 'x' ELSE CAST(c_custkey AS STRING) END").try_cast("int").alias("number"),
        F.expr("CASE WHEN c_custkey % 4 > 0 THEN CAST(c_custkey AS INT) END").alias("eval_limit"), F.expr("CASE WHEN c_custkey % 5 > 0 THEN CAST(c_custkey AS INT) END").alias("book_ply"),
    )
    return lookups.with_defaults(x, {"eval_limit": 400, "book_ply": 32})


# ---- filters and lookups ----


@query(duck(f"""SELECT p_partkey, CAST(CASE WHEN p_size % 3 = 2 OR p_size % 3 < 2 THEN 2 + 1 + CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 2 END END
+ CASE p_partkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 3 WHEN 2 THEN 5 ELSE 5 END AS INT) AS pieces, true AS handicap FROM part"""))
def handicaps(spark, sf_dir):
    s = F.col("sfen")
    return positions_of(spark, sf_dir).select("p_partkey", positions.pieces(s).cast("int").alias("pieces"), positions.is_handicap(s, F.lit(sfen.STARTPOS)).alias("handicap"))


@query(f"""WITH {sql("book_move")}, f AS (SELECT key, arg_min(value - 45000, seq) AS value FROM book_move WHERE depth = 3 GROUP BY key) SELECT key, value FROM f WHERE value <= 20000 AND value >= -20000""")
def balanced_starts(spark, sf_dir):
    x = moves(spark, sf_dir).select("key", F.col("depth").alias("ply"), (F.col("value") - 45000).alias("value"), "seq")
    return positions.balanced_starts(x, 3, 20000)


CANDIDATES = """c AS (SELECT key, move % 40 AS move, value AS score, depth <> 1 AS legal, seq, row_number() OVER (PARTITION BY key ORDER BY seq, move) = 2 AS selected FROM book_move)"""


@query(f"""WITH {sql("book_move")}, {CANDIDATES}, o AS (SELECT *, row_number() OVER (PARTITION BY key, move ORDER BY CAST(selected AS INT) DESC, score DESC) AS k FROM c WHERE legal),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY CAST(selected AS INT) DESC, score DESC, move) AS rank, max(score) OVER (PARTITION BY key) AS best FROM o WHERE k = 1)
SELECT key, move, score, selected FROM r WHERE selected OR (rank <= 3 AND best - score <= 15000)""")
def pruned_candidates(spark, sf_dir):
    x = moves(spark, sf_dir)
    x = x.selectExpr("key", "move % 40 AS move", "value AS score", "depth <> 1 AS legal", "row_number() OVER (PARTITION BY key ORDER BY seq, move) = 2 AS selected")
    return positions.prune_candidates(x, "key", 3, 15000).select("key", "move", "score", "selected")


@query(f"""WITH {sql("book_move")}, l_m AS (SELECT key, move, arg_max(depth, seq) AS depth, min(seq) AS slot FROM book_move WHERE book % 2 = 0 AND key % 2 = 0 GROUP BY key, move),
r_m AS (SELECT key, move, arg_max(depth, seq) AS depth, min(seq) AS slot FROM book_move WHERE book % 2 = 1 AND key % 2 = 1 GROUP BY key, move)
SELECT key, 'left' AS chosen, CAST(count(*) AS INT) AS n FROM l_m GROUP BY key UNION ALL SELECT key, 'right', CAST(count(*) AS INT) FROM r_m GROUP BY key""")
def side_merge(spark, sf_dir):
    a, b = (books.positions(moves(spark, sf_dir, f"book % 2 = {k}")) for k in (0, 1))
    side = F.when(F.col("key") % 2 == 0, "b").otherwise("w")
    return books.merge_sides(a, b, side).select("key", "chosen", F.size("moves").alias("n"))


@query(duck(f"""WITH p AS (SELECT p_partkey, {POSITION} AS key, {TURNED} || ' ' || CAST(p_partkey % 97 + 1 AS STRING) AS turned FROM part)
SELECT p_partkey, p_partkey % 3 < 2 AS found, p_partkey % 3 = 1 AS flipped, CASE p_partkey % 3 WHEN 0 THEN '7g7f' WHEN 1 THEN '3c3d' END AS move FROM p"""))
def flip_lookups(spark, sf_dir):
    """A third of the positions is in the book as it is, a third as its image, a third isn't. Each position's hands are marked by its number, so keys are unique."""
    own = F.concat(F.regexp_replace("sfen", r" \d+$", ""), F.lit(" "), F.col("p_partkey").cast("string"))
    x = positions_of(spark, sf_dir).select("p_partkey", own.alias("key"))
    book = x.where("p_partkey % 3 < 2").select(F.when(F.col("p_partkey") % 3 == 0, F.col("key")).otherwise(sfen.flip_sfen(F.col("key"))).alias("key"), F.array(F.struct(F.lit("7g7f").alias("move"))).alias("moves"))
    found = books.flip_lookup(x.select("key"), book)
    return x.join(found, "key").select("p_partkey", "found", "flipped", F.col("moves")[0]["move"].alias("move"))


@query(f"""WITH {sql("game")}, r AS (SELECT c_custkey AS player, c_acctbal AS rate FROM customer UNION ALL SELECT s_suppkey, s_acctbal + 4000 FROM supplier), b AS (SELECT player, max(rate) AS best FROM r GROUP BY player),
g AS (SELECT game.*, x.best AS bb, y.best AS wb FROM game LEFT JOIN b x ON black = x.player LEFT JOIN b y ON white = y.player WHERE black IN (SELECT c_custkey FROM customer) OR true)
SELECT game FROM g WHERE coalesce(bb >= 7000 AND wb >= 7000, false) OR (winner = 0 AND coalesce(wb >= 12000, false)) OR (winner = 1 AND coalesce(bb >= 12000, false)) OR (winner = 2 AND (coalesce(bb >= 9000, false) OR coalesce(wb >= 9000, false)))""")
def external_ratings(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    x = projection(spark, sf_dir, "game").withColumns({"black_rate": F.lit(None).cast("double"), "white_rate": F.lit(None).cast("double")})
    ext = c.select(F.col("c_custkey").alias("player"), F.col("c_acctbal").alias("rate"))
    more = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("player"), (F.col("s_acctbal") + 4000).alias("rate"))
    return games.rating_semi_join(x, 7000, 12000, 9000, ext.unionByName(more)).select("game")


@query(f"""WITH {sql("book_move")}, b AS (SELECT key, book % 2 AS odd, arg_max(move, (value, -seq, -move)) AS move FROM book_move GROUP BY key, odd)
SELECT o_orderkey, o.ply, b.move FROM (SELECT o_orderkey, o_orderkey * 7 % 1500 + 1 AS key, o_custkey % 10 AS ply FROM orders) o LEFT JOIN b ON b.key = o.key AND b.odd = o.ply % 2""")
def duel_lookups(spark, sf_dir):
    own, other = (books.best_move(moves(spark, sf_dir, f"book % 2 = {k}")).select("key", "move") for k in (0, 1))
    plies = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderkey * 7 % 1500 + 1 AS key", "o_custkey % 10 AS ply")
    return lookups.duel_lookup(plies, own, other).select("o_orderkey", "ply", "move")


@query(duck(f"""WITH p AS (SELECT {BOARD} || ' ' || {SIDE} || ' ' || {HANDS} AS a, {TURNED} AS b, CAST(p_partkey % 97 AS INT) AS ply FROM part) SELECT least(a, b) AS key, min(greatest(ply, 1)) AS ply FROM p GROUP BY least(a, b)"""))
def frontier_plies(spark, sf_dir):
    x = positions_of(spark, sf_dir).select(sfen.trim_ply(F.col("sfen")).alias("key"), (F.col("p_partkey") % 97).cast("int").alias("ply"))
    return books.frontier(x)


@query(duck(f"""WITH p AS (SELECT {BOARD} || ' ' || {SIDE} || ' ' || {HANDS} AS a, {TURNED} AS b, p_partkey AS seq, CASE WHEN p_partkey % 5 > 0 THEN p_size END AS value, CAST(p_partkey % 9 AS INT) AS depth, CASE p_partkey % 2 WHEN 0 THEN '7g7f' ELSE '2g2f' END AS move FROM part),
n AS (SELECT *, first_value(a) OVER (PARTITION BY least(a, b) ORDER BY seq) AS name FROM p),
m AS (SELECT name, CASE WHEN name = a THEN move WHEN move = '7g7f' THEN '3c3d' ELSE '8c8d' END AS move, value, depth, seq FROM n)
SELECT name AS key, move, arg_min(struct_pack(v := value), (CAST(value IS NULL AS INT), seq)).v AS value, arg_min(depth, (CAST(value IS NULL AS INT), seq)) AS depth, min(seq) AS seq FROM m GROUP BY name, move"""))
def merged_images(spark, sf_dir):
    x = positions_of(spark, sf_dir).select(
        sfen.trim_ply(F.col("sfen")).alias("key"), F.col("p_partkey").alias("seq"), F.expr("CASE WHEN p_partkey % 5 > 0 THEN p_size END").alias("value"),
        (F.col("p_partkey") % 9).cast("int").alias("depth"), F.expr("CASE p_partkey % 2 WHEN 0 THEN '7g7f' ELSE '2g2f' END").alias("move"),
    )
    return books.merge_flipped(x)


@query("""WITH s AS (SELECT l_partkey % 50 AS name, l_orderkey * 100000000 + l_suppkey * 100000 + l_linenumber * 10000 + l_partkey % 10000 AS seq, CAST(CAST(l_quantity AS INT) % 3 - 1 AS DOUBLE) / 2 * CAST(l_partkey % 8 AS DOUBLE) * 0.25 AS d FROM lineitem WHERE l_linenumber < 3),
l AS (SELECT name, list(d ORDER BY seq) AS ds FROM s GROUP BY name) SELECT name, list_reduce(list_prepend(CAST(10 AS DOUBLE), ds), lambda a, x: least(greatest(a + x, 8.0), 12.0)) AS v FROM l""")
def clamped_gradient(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").where("l_linenumber < 3").selectExpr(
        "l_partkey % 50 AS name", "l_orderkey * 100000000 + l_suppkey * 100000 + l_linenumber * 10000 + l_partkey % 10000 AS seq", "10.0D AS v", "8.0D AS least", "12.0D AS most",
        "CAST(CAST(l_quantity AS INT) % 3 - 1 AS DOUBLE) / 2 AS shift", "CAST(l_partkey % 8 AS DOUBLE) AS step", "1.0D AS delta",
    )
    return games.gradient(x, 0.25)


@query(f"WITH {sql('book_move')} SELECT key, move, arg_max(value, seq) AS value, CAST(sum(move_count) AS BIGINT) AS move_count FROM book_move GROUP BY key, move")
def merged_runs(spark, sf_dir):
    """Each book merged by itself, then the books' results; the newest book is the one whose moves were read last."""
    part = moves(spark, sf_dir).groupBy("book", "key", "move").agg(F.max_by("value", "seq").alias("value"), F.max("seq").alias("seq"), F.sum("move_count").alias("n"))
    return part.groupBy("key", "move").agg(F.max_by("value", "seq").alias("value"), F.sum("n").cast("bigint").alias("move_count"))


# ---- distinct, order, sets ----


@query("SELECT row_number() OVER (ORDER BY p_type, p_size) AS position, p_type, p_size FROM (SELECT DISTINCT p_type, p_size FROM part)")
def distinct_in_order(spark, sf_dir):
    """Whole records once, in order."""
    return global_rank(table(spark, sf_dir, "part").select("p_type", "p_size").distinct(), ["p_type", "p_size"], "position")


@query("SELECT DISTINCT p_partkey % 7 AS part, p_type, p_size FROM part")
def distinct_by_part(spark, sf_dir):
    return table(spark, sf_dir, "part").select((F.col("p_partkey") % 7).alias("part"), "p_type", "p_size").dropDuplicates(["part", "p_type", "p_size"])


@query("SELECT o_custkey, array_to_string(list(p ORDER BY k), ',') AS names FROM (SELECT o_custkey, o_orderpriority AS p, min(o_orderkey) AS k FROM orders GROUP BY o_custkey, p) GROUP BY o_custkey")
def ordered_set(spark, sf_dir):
    x = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))).alias("l"))
    return x.select("o_custkey", F.array_join(F.array_distinct("l.o_orderpriority"), ",").alias("names"))


@query("SELECT c_custkey, c_name FROM customer")
def unique_or_error(spark, sf_dir):
    return books.assert_unique(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), ["c_custkey"])


@query("SELECT text, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1")
def duplicate_report(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("text IS NOT NULL").groupBy("text").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 700 AS file_no FROM orders QUALIFY (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 700 < (SELECT count(*) // 700 FROM orders)")
def whole_files(spark, sf_dir):
    x = layout.split_fixed(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 700)
    return layout.whole_groups(x, "file_no", 700).select("o_orderkey", "file_no")


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS file_no FROM orders QUALIFY (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 < 2")
def output_limit(spark, sf_dir):
    return layout.split_fixed(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 1000).where("file_no < 2")


@query("SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS epoch, row_number() OVER (ORDER BY CASE WHEN event_type <> 'error' THEN user_id END ASC NULLS LAST, event_id) AS place FROM events")
def report_order(spark, sf_dir):
    x = table(spark, sf_dir, "events").select("event_id", F.expr("CASE WHEN event_type <> 'error' THEN user_id END").alias("epoch"))
    return global_rank(x, [F.col("epoch").asc_nulls_last(), F.col("event_id")], "place")


@query("SELECT event_id, ['a', 'b', 'c', 'd', 'e'][(3 + event_id) % 5 + 1] AS item FROM events")
def cyclic_schedule(spark, sf_dir):
    items = F.array(*map(F.lit, "abcde"))
    return table(spark, sf_dir, "events").select("event_id", layout.cyclic(items, F.lit(3), F.col("event_id")).alias("item"))


@query("SELECT c_nationkey AS nation, count(*) AS n FROM (SELECT c_nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier) GROUP BY nation")
def union_all(spark, sf_dir):
    a, b = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")), table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"))
    return a.unionByName(b).groupBy("nation").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey AS player FROM customer WHERE c_acctbal > 8000 UNION SELECT s_suppkey FROM supplier WHERE s_acctbal > 2000")
def union_of_sets(spark, sf_dir):
    a = table(spark, sf_dir, "customer").where("c_acctbal > 8000").select(F.col("c_custkey").alias("player"))
    return a.unionByName(table(spark, sf_dir, "supplier").where("s_acctbal > 2000").select(F.col("s_suppkey").alias("player"))).distinct()


# ---- streams, as batches of the same functions ----


@query("""SELECT s AS start, count(*) AS n, max(value) - min(value) AS rise FROM (SELECT value, unnest(generate_series(time_bucket(INTERVAL 1 MINUTES, ts) - INTERVAL 9 MINUTES, time_bucket(INTERVAL 1 MINUTES, ts), INTERVAL 1 MINUTES)) AS s FROM events) GROUP BY s""")
def sliding_rate(spark, sf_dir):
    return rates.sliding(table(spark, sf_dir, "events")).select(F.col("start").cast("timestamp_ntz").alias("start"), "n", "rise")


@query("""SELECT user_id AS task, CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS deferred, count(*) FILTER (event_type = 'error') > 5 AS given_up FROM events GROUP BY user_id""")
def deferred_tasks(spark, sf_dir):
    return rates.deferrals(table(spark, sf_dir, "events"), "user_id", "event_type = 'error'", 5)


@query("""SELECT event_id, user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS turn FROM events WHERE event_type = 'error' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 5""")
def requeued_tasks(spark, sf_dir):
    return rates.requeued(table(spark, sf_dir, "events"), "user_id", "event_type = 'error'", 5).select("event_id", "user_id", "turn")


@query("SELECT time_bucket(INTERVAL 3 HOURS, ts) AS start, max(event_id) AS revision, count(*) AS changes FROM events GROUP BY start")
def dirty_snapshots(spark, sf_dir):
    return rates.snapshots(table(spark, sf_dir, "events")).select(F.col("start").cast("timestamp_ntz").alias("start"), "revision", "changes")


def drained(stream, mode: str, name: str):
    """All that a stream of the files present gives, as a table in memory."""
    spark = stream.sparkSession
    run = stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", scratch(spark)).trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.table(name)


@query("SELECT user_id AS job, count(*) AS taken, CAST(count(*) FILTER (event_type = 'purchase') AS BIGINT) AS done FROM events GROUP BY user_id")
def job_progress(spark, sf_dir):
    """The table's files as a stream, and the last state that each job reported."""
    stream = rates.event_stream(spark, sf_dir, pattern="events.parquet")
    found = drained(rates.progress(stream), "update", f"job_progress_{uuid.uuid4().hex}")
    return found.groupBy("job").agg(F.max("taken").alias("taken"), F.max("done").alias("done"))


# ---- walks ----


@query(f"""WITH {EDGE}, d AS (SELECT src, dst, value, idx, CAST(dst % 4 = 0 AS INT) AS depth FROM e WHERE src % 3 <> 0),
best AS (SELECT src, max(value) AS best FROM d GROUP BY src),
l0 AS (SELECT CAST(n AS BIGINT) AS node, coalesce(best, 0) AS rb FROM (SELECT unnest([1, 2, 3, 4, 5]) AS n) LEFT JOIN best ON src = n),
l1 AS (SELECT DISTINCT d.dst AS node FROM l0 JOIN d ON d.src = node JOIN best ON best.src = node WHERE value >= best),
l2 AS (SELECT DISTINCT d.dst AS node FROM l1 JOIN d ON d.src = node JOIN best ON best.src = node),
seen AS (SELECT node FROM l0 UNION SELECT node FROM l1 UNION SELECT node FROM l2),
o AS (SELECT src, dst FROM d WHERE idx = 1)
SELECT d.src AS node, d.dst, d.value, o.dst AS old_move FROM d JOIN o ON o.src = d.src JOIN d m ON m.src = o.src AND m.dst = o.dst
WHERE d.idx = 0 AND d.depth = 0 AND d.dst NOT IN (SELECT src FROM d) AND d.dst <> o.dst AND d.value - m.value >= 10 AND d.src IN (SELECT node FROM seen)""")
def refuted_exits(spark, sf_dir):
    e = edges(spark, sf_dir).where("src % 3 <> 0").withColumn("depth", (F.col("dst") % 4 == 0).cast("int"))
    old = e.where("idx = 1").select(F.col("src").alias("key"), F.col("dst").alias("move"))
    return walks.refuted_exits(e, roots(spark), old, 0, 10_000_000, 2, 10)


@query(f"""WITH {EDGE}, d AS (SELECT * FROM e WHERE src % 3 <> 0), best AS (SELECT src, max(value) AS best FROM d GROUP BY src),
l0 AS (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS BIGINT) AS node), l1 AS (SELECT DISTINCT d.dst AS node FROM l0 JOIN d ON d.src = node JOIN best ON best.src = node WHERE value >= best),
l2 AS (SELECT DISTINCT d.dst AS node FROM l1 JOIN d ON d.src = node), l3 AS (SELECT DISTINCT d.dst AS node FROM (SELECT node FROM l2 WHERE node NOT IN (SELECT node FROM l0) AND node NOT IN (SELECT node FROM l1)) JOIN d ON d.src = node JOIN best ON best.src = node WHERE value >= best),
seen AS (SELECT node FROM l0 UNION SELECT node FROM l1 UNION SELECT node FROM l2 UNION SELECT node FROM l3)
SELECT node FROM seen WHERE node NOT IN (SELECT src FROM d) AND EXISTS (SELECT 1 FROM e WHERE e.src = node AND e.dst IN (SELECT src FROM d))""")
def rejoining_leaves(spark, sf_dir):
    e = edges(spark, sf_dir)
    return walks.rejoining_leaves(e.where("src % 3 <> 0"), roots(spark), e.select(F.col("src").alias("node"), "dst"), 0, 10_000_000, 3)


@query(f"""WITH RECURSIVE {EDGE}, f AS (SELECT src, dst, value FROM e WHERE idx = 0), l AS (SELECT o_custkey AS line, o_custkey AS node, 0 AS ply FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey <= 400)
UNION ALL SELECT line, node * 3 % 2000 + 1, ply + 1 FROM l WHERE ply < 5),
v AS (SELECT l.*, f.value FROM l JOIN f ON f.src = node), r AS (SELECT line, value AS root FROM v WHERE ply = 0),
k AS (SELECT v.line, v.ply, v.node FROM v JOIN r ON r.line = v.line WHERE v.ply < 4 AND root - value * CASE WHEN ply % 2 = 0 THEN 1 ELSE -1 END < 30000),
w AS (SELECT node AS root, node, [node] AS seen, false AS done, 0 AS k FROM (SELECT DISTINCT node FROM k) UNION ALL
SELECT root, CASE WHEN done OR dst IS NULL OR node IS NULL THEN node WHEN list_contains(seen, dst) THEN NULL ELSE dst END,
CASE WHEN done OR dst IS NULL OR node IS NULL OR list_contains(seen, dst) THEN seen ELSE list_append(seen, dst) END,
done OR dst IS NULL OR node IS NULL OR list_contains(seen, dst), k + 1 FROM w LEFT JOIN (SELECT src, dst FROM f WHERE src % 5 <> 0) g ON g.src = node WHERE k < 12)
SELECT k.line, CAST(k.ply AS INT) AS ply, w.node AS leaf FROM k JOIN w ON w.root = k.node WHERE w.k = 12 AND w.node IS NOT NULL AND (w.done OR w.node % 5 = 0 OR w.node NOT IN (SELECT src FROM f))""")
def unsolved_lines(spark, sf_dir):
    """Lines of six positions; walks stop at every fifth position, which the book for walks hasn't."""
    path = F.expr("aggregate(sequence(1, 5), array(o_custkey), (a, i) -> array_append(a, element_at(a, -1) * 3 % 2000 + 1))")
    lines = table(spark, sf_dir, "orders").where("o_custkey <= 400").select("o_custkey").distinct().select(F.col("o_custkey").alias("line"), path.alias("path"))
    e = edges(spark, sf_dir)
    best = checkpoint(e.where("idx = 0").select("src", F.when(F.col("src") % 5 != 0, F.col("dst")).alias("dst"), "value", "idx"))
    return walks.unsolved_lines(lines, best, 30000, 12, 4)


@query(f"WITH {sql('book_move')} SELECT key, move, value FROM book_move WHERE key IN (7, 130, 991, 4000)")
def probed_keys(spark, sf_dir):
    walks.store_book(moves(spark, sf_dir).select("key", "move", "value"), place := scratch(spark))
    return walks.probe(spark.read.parquet(place), [7, 130, 991, 4000])


@query(f"WITH {sql('book_move')} SELECT key, move, value FROM book_move WHERE key IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def probed_many(spark, sf_dir):
    return walks.probe_many(moves(spark, sf_dir).select("key", "move", "value"), table(spark, sf_dir, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("key")))
