"""The registered queries of the engine's operators on projections of the test tables, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.sfen import flip_move
from tessera.operators import books, games, graph, layout, windows
from tessera.plans.projections import projection, sql
from tessera.plans.registry import moves, query, table

MERGED = """merged AS (SELECT key, move, arg_max(value, seq) AS value, arg_max(depth, seq) AS depth, CAST(sum(move_count) AS BIGINT) AS move_count,
min(seq) AS slot FROM book_move GROUP BY key, move)"""


@query(f"WITH {sql('book_move')}, {MERGED} SELECT key, move, value, depth, move_count, slot FROM merged")
def book_dedup(spark, sf_dir):
    return books.merge_duplicates(moves(spark, sf_dir))


def _side(name: str, parity: int) -> str:
    return f"""{name}_m AS (SELECT key, move, arg_max(depth, seq) AS depth, CAST(sum(move_count) AS BIGINT) AS c, min(seq) AS slot
FROM book_move WHERE book % 2 = {parity} GROUP BY key, move),
{name} AS (SELECT key, arg_min(depth, (slot, move)) AS d, arg_min(move, (slot, move)) AS m, count(*) AS n, CAST(sum(c) AS BIGINT) AS c FROM {name}_m GROUP BY key)"""


@query(f"""WITH {sql("book_move")}, {_side("l", 0)}, {_side("r", 1)},
x AS (SELECT coalesce(l.key, r.key) AS key, l.d AS ld, r.d AS rd, l.m AS lm, r.m AS rm, l.n AS ln, r.n AS rn, l.c AS lc, r.c AS rc,
CASE WHEN r.key IS NULL THEN false WHEN l.key IS NULL THEN true WHEN l.d <> r.d THEN r.d > l.d ELSE r.n > l.n END AS w FROM l FULL JOIN r ON l.key = r.key)
SELECT key, CASE WHEN w THEN 'right' ELSE 'left' END AS chosen, CAST(CASE WHEN w THEN rn ELSE ln END AS INT) AS n_moves,
CASE WHEN w THEN rm ELSE lm END AS first_move, CASE WHEN w THEN rd ELSE ld END AS first_depth, CASE WHEN w THEN rc ELSE lc END AS move_count FROM x""")
def book_merge_outer(spark, sf_dir):
    a, b = (books.positions(moves(spark, sf_dir, f"book % 2 = {k}")) for k in (0, 1))
    m = F.col("moves")
    total = F.aggregate(m, F.lit(0).cast("bigint"), lambda s, x: s + x["move_count"])
    return books.merge_books(a, b).select(
        "key", "chosen", F.size(m).alias("n_moves"), m[0]["move"].alias("first_move"), m[0]["depth"].alias("first_depth"), total.alias("move_count")
    )


@query(f"""WITH {sql("book_move")}, l AS (SELECT DISTINCT key FROM book_move WHERE book % 2 = 0), r AS (SELECT DISTINCT key FROM book_move WHERE book % 2 = 1)
SELECT count(*) FILTER (l.key = r.key) AS same, count(*) FILTER (r.key IS NULL) AS only_left, count(*) FILTER (l.key IS NULL) AS only_right FROM l FULL JOIN r ON l.key = r.key""")
def book_merge_counts(spark, sf_dir):
    a, b = (moves(spark, sf_dir, f"book % 2 = {k}").select("key").distinct() for k in (0, 1))
    return books.merge_counts(a, b)


@query(f"WITH {sql('book_move')} SELECT key, move, depth, seq FROM (SELECT *, min(depth) OVER (PARTITION BY key) AS m FROM book_move) WHERE depth = m")
def min_ply_filter(spark, sf_dir):
    return books.least_ply(moves(spark, sf_dir).select("key", "move", "depth", "seq"), "key", "depth")


@query(f"WITH {sql('book_move')} SELECT key, move, value, depth FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY value DESC, seq, move) AS k FROM book_move) WHERE k = 1")
def best_move(spark, sf_dir):
    return books.best_move(moves(spark, sf_dir))


@query(f"""WITH {sql("book_move")}, k AS (SELECT key, move, seq, value / 10000.0 AS score, row_number() OVER (PARTITION BY key ORDER BY value DESC, seq, move) AS rank FROM book_move),
e AS (SELECT *, exp(score - max(score) OVER (PARTITION BY key)) AS e FROM k WHERE rank <= 3)
SELECT key, move, seq, CAST(rank AS INT) AS rank, round(e / sum(e) OVER (PARTITION BY key), 6) AS prob, CAST(floor(round(e / sum(e) OVER (PARTITION BY key), 9) * 65535) AS INT) AS u16 FROM e""")
def topk_softmax(spark, sf_dir):
    scored = moves(spark, sf_dir).select("key", "move", "seq", (F.col("value") / 10000.0).alias("score"))
    return windows.top_softmax(scored, "key", "score", ["seq", "move"], 3).select("key", "move", "seq", "rank", F.round("prob", 6).alias("prob"), "u16")


@query(f"""WITH {sql("book_move")}, b AS (SELECT key, move, CAST(floor(value / 10000) AS INT) AS value, seq FROM book_move),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY value DESC, seq, move) AS rank, max(value) OVER (PARTITION BY key) AS best FROM b)
SELECT key, move, seq, CAST(rank AS INT) AS rank, CASE WHEN value = best AND rank > 1 THEN value - 1 ELSE value END AS value FROM r""")
def tie_break_decrement(spark, sf_dir):
    coarse = moves(spark, sf_dir).select("key", "move", F.floor(F.col("value") / 10000).cast("int").alias("value"), "seq")
    return books.break_ties(coarse)


@query(f"WITH {sql('book_move')} SELECT key, move, value, seq FROM (SELECT *, max(value) OVER (PARTITION BY key) AS best FROM book_move) WHERE value >= best - 5000")
def eval_window(spark, sf_dir):
    return books.within_window(moves(spark, sf_dir), 5000).select("key", "move", "value", "seq")


@query(f"WITH {sql('position_eval')} SELECT game, ply, value FROM position_eval WHERE abs(value) < 9000")
def eval_clip_filter(spark, sf_dir):
    return games.eval_below(projection(spark, sf_dir, "position_eval"), 9000).select("game", "ply", "value")


@query(f"WITH {sql('game')} SELECT game, black, white FROM game WHERE winner <> 2")
def drop_draws(spark, sf_dir):
    return games.drop_draws(projection(spark, sf_dir, "game")).select("game", "black", "white")


@query(f"WITH {sql('game')} SELECT game, played FROM game WHERE played > TIMESTAMP '1995-01-01' AND played <= TIMESTAMP '1996-01-01'")
def date_range(spark, sf_dir):
    at = F.col("played")
    return projection(spark, sf_dir, "game").where(games.played_between(at, F.to_date(at), "1995-01-01", "1995-12-31")).select("game", "played")


@query(f"""WITH {sql("game")}, g AS (SELECT opponent, nodes, grouping(opponent, nodes) AS level, count(*) AS games, count(*) FILTER (winner = 0) AS wins,
count(*) FILTER (winner = 1) AS losses, count(*) FILTER (winner = 2) AS draws FROM game GROUP BY GROUPING SETS ((), (opponent), (nodes), (opponent, nodes)) HAVING count(*) >= 10)
SELECT opponent, nodes, CAST(level AS BIGINT) AS level, games, wins, losses, draws, round(wins / (wins + losses), 6) AS rate,
round(-400 * log10(1 / (wins / (wins + losses)) - 1), 4) AS elo FROM g""")
def win_rate_sets(spark, sf_dir):
    return games.win_rates(projection(spark, sf_dir, "game"), ["opponent", "nodes"])


@query(f"""WITH {sql("game")}, p AS (SELECT black AS player, 'black' AS colour, winner = 0 AS w, winner = 1 AS l, winner = 2 AS d FROM game
UNION ALL SELECT white, 'white', winner = 1, winner = 0, winner = 2 FROM game)
SELECT player, colour, count(*) AS games, count(*) FILTER (w) AS wins, count(*) FILTER (l) AS losses, count(*) FILTER (d) AS draws FROM p GROUP BY player, colour""")
def player_colour_stats(spark, sf_dir):
    return games.colour_stats(projection(spark, sf_dir, "game"))


@query(f"""WITH {sql("game")}, p AS (SELECT game, black AS player, winner = 0 AS w, winner = 1 AS l, winner = 2 AS d FROM game
UNION ALL SELECT game, white, winner = 1, winner = 0, winner = 2 FROM game)
SELECT count(DISTINCT game) AS matched_games, count(*) FILTER (w) AS wins, count(*) FILTER (l) AS losses, count(*) FILTER (d) AS draws FROM p WHERE player % 10 = 7""")
def player_stats(spark, sf_dir):
    return games.player_stats(projection(spark, sf_dir, "game"), lambda p: p % 10 == 7)


@query(f"""WITH {sql("game")}, r AS (SELECT *, row_number() OVER (PARTITION BY opponent ORDER BY played DESC, game DESC) AS k, count(*) OVER (PARTITION BY opponent) AS t FROM game)
SELECT opponent, CAST(n AS INT) AS n, count(*) FILTER (winner = 0) AS wins, count(*) FILTER (winner = 1) AS losses
FROM r, (SELECT unnest([10, 20, 40, 80, 160]) AS n) WHERE k <= n AND n <= t GROUP BY opponent, n""")
def trailing_winrate(spark, sf_dir):
    order = [F.col("played").desc(), F.col("game").desc()]
    return games.trailing_rates(projection(spark, sf_dir, "game"), order, [10, 20, 40, 80, 160], "opponent")


RATED = f"""{sql("game")}, rated AS (SELECT g.*, b.c_acctbal AS black_rate, w.c_acctbal AS white_rate FROM game g
LEFT JOIN customer b ON g.black = b.c_custkey LEFT JOIN customer w ON g.white = w.c_custkey)"""


def rated(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    x = projection(spark, sf_dir, "game")
    for side in ("black", "white"):
        x = x.join(c.select(F.col("c_custkey").alias(side), F.col("c_acctbal").alias(f"{side}_rate")), side, "left")
    return x


@query(f"""WITH {RATED}, p AS (SELECT black AS player, black_rate AS r FROM rated UNION ALL SELECT white, white_rate FROM rated)
SELECT game, black, white, winner FROM rated WHERE
(black IN (SELECT player FROM p WHERE r >= 6000) AND white IN (SELECT player FROM p WHERE r >= 6000))
OR (CASE winner WHEN 0 THEN white WHEN 1 THEN black END IN (SELECT player FROM p WHERE r >= 9000))
OR (winner = 2 AND (black IN (SELECT player FROM p WHERE r >= 8000) OR white IN (SELECT player FROM p WHERE r >= 8000)))""")
def rating_semi_join(spark, sf_dir):
    return games.rating_semi_join(rated(spark, sf_dir), 6000, 9000, 8000).select("game", "black", "white", "winner")


@query(f"WITH {RATED} SELECT game FROM rated WHERE black_rate >= 5000 AND white_rate >= 5000")
def both_rated(spark, sf_dir):
    return rated(spark, sf_dir).where(games.both_rated(5000, F.col("black_rate"), F.col("white_rate"))).select("game")


@query("""SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM supplier s WHERE s.s_nationkey = c.c_nationkey
AND (contains(c.c_name, right(s.s_name, 2)) OR contains(c.c_mktsegment, right(s.s_name, 2))))""")
def finalist_contains(spark, sf_dir):
    g = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("event"), F.col("c_name").alias("black"), F.col("c_mktsegment").alias("white"))
    f = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("event"), F.expr("right(s_name, 2)").alias("name")).distinct()
    return games.finalist_games(g, f).select("c_custkey")


@query(f"""WITH {sql("book_move")}, o AS (SELECT key, move FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY value DESC, seq, move) AS k FROM book_move WHERE book % 2 = 0) WHERE k = 1),
n AS (SELECT key, move, arg_max(value, seq) AS value FROM book_move GROUP BY key, move)
SELECT n.key, n.move, n.value, o.move AS old_move, m.value AS old_value FROM n JOIN o ON n.key = o.key JOIN n m ON m.key = o.key AND m.move = o.move
WHERE n.move <> o.move AND n.value - m.value >= 1000""")
def refutation(spark, sf_dir):
    old = books.best_move(moves(spark, sf_dir, "book % 2 = 0"))
    return books.refutations(old, books.merge_duplicates(moves(spark, sf_dir)).select("key", "move", "value"), 1000)


@query(f"""WITH {sql("position_eval")}, w AS (SELECT game, value, max(value) OVER x AS most, min(value) OVER x AS least FROM position_eval
WINDOW x AS (PARTITION BY game, side ORDER BY ply, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT DISTINCT game FROM w WHERE (most >= 20000 AND value < 0) OR (least <= -20000 AND value > 0)""")
def reversal_games(spark, sf_dir):
    return games.reversals(projection(spark, sf_dir, "position_eval"), 20000)


@query(f"""WITH {RATED} SELECT CASE WHEN winner = 2 THEN 'draw' WHEN NOT coalesce(black_rate >= 2000 AND white_rate >= 2000, false) THEN 'rating'
WHEN played < TIMESTAMP '1995-01-01' THEN 'date' END AS reason, count(*) AS n FROM rated GROUP BY reason""")
def first_skip_reason(spark, sf_dir):
    reasons = [
        ("draw", F.col("winner") == 2),
        ("rating", ~games.both_rated(2000, F.col("black_rate"), F.col("white_rate"))),
        ("date", F.col("played") < F.lit("1995-01-01").cast("timestamp_ntz")),
    ]
    return games.skip_reasons(rated(spark, sf_dir), reasons)


@query("SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text")
def first_occurrence(spark, sf_dir):
    return windows.first_occurrence(table(spark, sf_dir, "documents").select("text", "doc_id"), ["text"], "doc_id")


def orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("source"))


RANKED = "r AS (SELECT o_orderkey, o_custkey, o_orderpriority AS source, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM orders)"


@query(f"WITH {RANKED} SELECT o_orderkey, pos // ((n + 6) // 7) AS file_no FROM r")
def split_ceil(spark, sf_dir):
    return layout.split_ceil(orders(spark, sf_dir).select("o_orderkey"), ["o_orderkey"], 7)


@query("SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS file_no FROM orders")
def split_ntile(spark, sf_dir):
    return layout.split_even(orders(spark, sf_dir).select("o_orderkey"), ["o_orderkey"], 7)


@query(f"WITH {RANKED} SELECT o_orderkey, pos // 1000 AS file_no FROM r")
def split_fixed(spark, sf_dir):
    return layout.split_fixed(orders(spark, sf_dir).select("o_orderkey"), ["o_orderkey"], 1000)


@query(f"""WITH {sql("book_move")}, l AS (SELECT book, list(struct_pack(key := key, move := move, seq := seq, n := move_count) ORDER BY seq, key, move) AS xs FROM book_move GROUP BY book),
f AS (SELECT book, list_reduce(list_transform(xs, lambda x: [struct_pack(key := x.key, move := x.move, seq := x.seq, total := x.n, output := CAST(0 AS BIGINT))]),
lambda a, b: list_append(a, struct_pack(key := b[1].key, move := b[1].move, seq := b[1].seq,
total := CASE WHEN a[-1].total > 0 AND a[-1].total + b[1].total > 100 THEN b[1].total ELSE a[-1].total + b[1].total END,
output := CASE WHEN a[-1].total > 0 AND a[-1].total + b[1].total > 100 THEN a[-1].output + 1 ELSE a[-1].output END))) AS ys FROM l)
SELECT book, y.key AS key, y.move AS move, y.seq AS seq, y.output AS output FROM (SELECT book, unnest(ys) AS y FROM f)""")
def greedy_fit(spark, sf_dir):
    x = moves(spark, sf_dir).select("book", "key", "move", "seq", "move_count")
    return layout.greedy_fit(x, "book", ["seq", "key", "move"], "move_count", 100).drop("move_count")


@query("""WITH t AS (SELECT o_orderkey, o_orderpriority AS source, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS k FROM orders)
SELECT o_orderkey, source, row_number() OVER (ORDER BY k, source) AS position FROM t""")
def round_robin(spark, sf_dir):
    return layout.round_robin(orders(spark, sf_dir).select("o_orderkey", "source"), "source", ["o_orderkey"])


@query("""WITH t AS (SELECT o_orderkey, o_orderpriority AS source, CAST(left(o_orderpriority, 1) AS INT) AS w,
row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS k FROM orders)
SELECT o_orderkey, source, row_number() OVER (ORDER BY k / w, source) AS position FROM t""")
def weighted_round_robin(spark, sf_dir):
    weight = F.expr("CAST(left(source, 1) AS INT)")
    return layout.weighted_round_robin(orders(spark, sf_dir).select("o_orderkey", "source"), "source", ["o_orderkey"], weight)


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST((CASE WHEN x < 0 THEN CAST(x AS HUGEINT) + 18446744073709551616 ELSE x END) % 1000 AS INT) AS bucket FROM (
SELECT *, xor(xor(xor(xor(CAST(-77 AS BIGINT), l_orderkey), l_partkey), l_suppkey), CAST(l_linenumber AS BIGINT)) AS x FROM lineitem)""")
def xor_bucket(spark, sf_dir):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    words = [F.col(c).cast("bigint") for c in keys]
    return table(spark, sf_dir, "lineitem").select(*keys, layout.xor_bucket(words, 1000, seed=-77).alias("bucket"))


@query("""WITH i AS (SELECT DISTINCT o_custkey, o_orderkey FROM orders), g AS (SELECT *, o_orderkey - row_number() OVER (PARTITION BY o_custkey % 10 ORDER BY o_orderkey) AS gap FROM i)
SELECT o_custkey % 10 AS source, min(o_orderkey) AS first, max(o_orderkey) AS last, count(*) AS n FROM g GROUP BY o_custkey % 10, gap""")
def islands(spark, sf_dir):
    x = orders(spark, sf_dir).select((F.col("o_custkey") % 10).alias("source"), "o_orderkey")
    return windows.islands(x, ["source"], "o_orderkey")


@query("""SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM events""")
def carry_forward(spark, sf_dir):
    x = projection(spark, sf_dir, "event").withColumn("carried", F.expr("CASE WHEN event_type = 'purchase' THEN value END"))
    return windows.carry_forward(x, ["user_id"], ["ts", "event_id"], ["carried"]).select("event_id", "user_id", "carried")


@query("""WITH m AS (SELECT *, event_type = 'purchase' AS is_move, CASE WHEN event_type = 'click' THEN value END AS v FROM events),
g AS (SELECT *, coalesce(sum(CAST(is_move AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS grp FROM m)
SELECT event_id, user_id, v FROM (SELECT event_id, user_id, is_move, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id, grp ORDER BY ts, event_id
ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM g) WHERE is_move""")
def pending_eval(spark, sf_dir):
    x = projection(spark, sf_dir, "event").withColumn("v", F.expr("CASE WHEN event_type = 'click' THEN value END"))
    return windows.pending(x, ["user_id"], ["ts", "event_id"], F.col("event_type") == "purchase", "v").select("event_id", "user_id", "v")


@query(f"""WITH {sql("book_move")}, e AS (SELECT key, move, seq, exp((value - max(value) OVER (PARTITION BY key)) / 20000.0) AS e, count(*) OVER (PARTITION BY key) AS n FROM book_move),
s AS (SELECT *, round(e / sum(e) OVER (PARTITION BY key) * greatest(100 - n, 0), 9) AS share FROM e),
p AS (SELECT *, floor(share) AS whole, round(share - floor(share), 6) AS frac FROM s),
q AS (SELECT *, greatest(100 - n, 0) - sum(whole) OVER (PARTITION BY key) AS rest, row_number() OVER (PARTITION BY key ORDER BY frac DESC, seq, move) AS place FROM p)
SELECT key, move, seq, CAST(least(1 + whole + CASE WHEN place <= rest THEN 1 ELSE 0 END, 65535) AS BIGINT) AS visits FROM q""")
def largest_remainder(spark, sf_dir):
    x = moves(spark, sf_dir).select("key", "move", "seq", "value")
    return windows.apportion(x, "key", "value", ["seq", "move"], 100, 20000.0).select("key", "move", "seq", "visits")


@query("""WITH l AS (SELECT o_custkey, list(o_orderkey ORDER BY o_orderkey) AS ms FROM orders GROUP BY o_custkey)
SELECT o_custkey, CAST(ply AS INT) AS ply, array_to_string(ms[1:ply], ' ') AS prefix FROM (SELECT *, unnest(range(0, CAST(len(ms) + 1 AS BIGINT))) AS ply FROM l)""")
def prefixes(spark, sf_dir):
    x = orders(spark, sf_dir).groupBy("o_custkey").agg(F.sort_array(F.collect_list("o_orderkey")).alias("ms"))
    return windows.prefixes(x, "ms").select("o_custkey", "ply", F.concat_ws(" ", F.col("prefix").cast("array<string>")).alias("prefix"))


@query("""SELECT conv_id, turn, role, ponder FROM (SELECT *, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS ponder, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS t FROM conversations)
WHERE t IS NOT NULL""")
def lead_pairs(spark, sf_dir):
    return windows.pairs(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), "conv_id", ["turn"], "role", "ponder")


@query(f"""WITH {sql("position_eval")}, d AS (SELECT game, ply, value, tie, first_value(value) OVER w - value * CASE WHEN (ply - first_value(ply) OVER w) % 2 = 0 THEN 1 ELSE -1 END AS loss
FROM position_eval WINDOW w AS (PARTITION BY game ORDER BY ply, tie)) SELECT game, ply, value FROM d WHERE loss < 5000""")
def eval_drop(spark, sf_dir):
    return windows.eval_drop(projection(spark, sf_dir, "position_eval"), "game", ["ply", "tie"], "ply", "value", 5000).select("game", "ply", "value")


EDGE = f"""{sql("edge")}, e AS MATERIALIZED (SELECT src, dst, value, CAST(k - 1 AS INT) AS idx FROM (
SELECT *, row_number() OVER (PARTITION BY src ORDER BY value DESC, seq, dst) AS k FROM edge) WHERE k <= 2)"""


def edges(spark, sf_dir) -> DataFrame:
    return graph.book_edges(projection(spark, sf_dir, "edge"), 2)


def roots(spark, n: int = 5) -> DataFrame:
    return spark.range(1, n + 1).select(F.col("id").alias("node"), (F.col("id") - 1).alias("idx"))


BFS = f"""WITH RECURSIVE {EDGE}, w AS (SELECT unnest([1, 2, 3, 4, 5]) AS node, 0 AS level UNION ALL SELECT e.dst, w.level + 1 FROM w JOIN e ON e.src = w.node WHERE w.level < 5),
b AS (SELECT CAST(node AS BIGINT) AS node, CAST(min(level) AS INT) AS level FROM w GROUP BY node)"""


@query(f"{BFS} SELECT node, level FROM b")
def bfs_ply(spark, sf_dir):
    return graph.bfs(edges(spark, sf_dir), roots(spark), 5)


@query(f"""{BFS.replace("e AS MATERIALIZED (", "e AS MATERIALIZED (SELECT * FROM (").replace("WHERE k <= 2)", "WHERE k <= 2) WHERE src % 3 <> 0)", 1)}
SELECT node, level FROM b WHERE node NOT IN (SELECT src FROM e)""")
def bfs_leaves(spark, sf_dir):
    return graph.leaves(edges(spark, sf_dir).where("src % 3 <> 0"), roots(spark), 5)


def _pruned(depth: int, turn: int, diff: int) -> str:
    out = [f"WITH {EDGE}, best AS (SELECT src, max(value) AS best FROM e GROUP BY src)",
           "l0 AS (SELECT CAST(n AS BIGINT) AS node, 0 AS level, [CAST(n - 1 AS INT)] AS path, coalesce(best, 0) AS rb FROM (SELECT unnest([1, 2, 3, 4, 5]) AS n) LEFT JOIN best ON src = n)"]
    for k in range(1, depth + 1):
        bound = "best" if (k - 1) % 2 == turn else f"rb - {diff}"
        seen = " UNION ALL ".join(f"SELECT node FROM l{j}" for j in range(k))
        out.append(f"""l{k} AS (SELECT node, {k} AS level, path, rb FROM (SELECT e.dst AS node, list_append(path, idx) AS path, -rb AS rb,
row_number() OVER (PARTITION BY e.dst ORDER BY list_append(path, idx)) AS k FROM l{k - 1} JOIN e ON e.src = node JOIN best ON best.src = node WHERE value >= {bound}) WHERE k = 1 AND node NOT IN ({seen}))""")
    every = " UNION ALL ".join(f"SELECT * FROM l{j}" for j in range(depth + 1))
    return ", ".join(out) + f" SELECT node, CAST(level AS INT) AS level, array_to_string(path, '/') AS path FROM ({every})"


@query(_pruned(4, 0, 200000))
def bfs_pruned(spark, sf_dir):
    x = graph.pruned_bfs(edges(spark, sf_dir), roots(spark), 0, 200000, 4)
    return x.select("node", "level", F.concat_ws("/", F.col("path").cast("array<string>")).alias("path"))


@query(f"""WITH RECURSIVE {EDGE}, w AS (SELECT n AS root, n AS node, [n] AS seen, false AS done, 0 AS k FROM (SELECT CAST(unnest(range(1, 51)) AS BIGINT) AS n) UNION ALL
SELECT root, CASE WHEN done OR dst IS NULL OR node IS NULL THEN node WHEN list_contains(seen, dst) THEN NULL ELSE dst END,
CASE WHEN done OR dst IS NULL OR node IS NULL OR list_contains(seen, dst) THEN seen ELSE list_append(seen, dst) END,
done OR dst IS NULL OR node IS NULL OR list_contains(seen, dst), k + 1 FROM w LEFT JOIN (SELECT src, dst FROM e WHERE idx = 0) f ON f.src = node WHERE k < 6)
SELECT root, CASE WHEN done OR f.src IS NULL THEN node END AS node, CAST(len(seen) - 1 AS BIGINT) AS length FROM w LEFT JOIN (SELECT src FROM e WHERE idx = 0) f ON f.src = node WHERE k = 6""")
def pv_walk(spark, sf_dir):
    return graph.best_walk(edges(spark, sf_dir), roots(spark, 50), 6)


def _minimax(depth: int) -> str:
    out = [f"WITH {EDGE}, v0 AS (SELECT src, max(value) AS value FROM e GROUP BY src)"]
    out += [f"v{k} AS (SELECT e.src, max(coalesce(-v.value, e.value)) AS value FROM e LEFT JOIN v{k - 1} v ON v.src = e.dst GROUP BY e.src)" for k in range(1, depth + 1)]
    return ", ".join(out) + f" SELECT src AS node, value FROM v{depth}"


@query(_minimax(4))
def minimax_k(spark, sf_dir):
    return graph.minimax(edges(spark, sf_dir), "value", 4)


@query(f"""WITH {EDGE} SELECT a.src, a.dst, a.idx, f.dst AS ponder FROM e a LEFT JOIN (SELECT * FROM e WHERE idx = 0) f ON f.src = a.dst""")
def child_ponder(spark, sf_dir):
    return graph.child_ponder(edges(spark, sf_dir))


@query("""SELECT user_id, CASE WHEN count(DISTINCT event_type) = 1 THEN min(event_type) WHEN count(event_type) > 0 THEN 'mixed' END AS value FROM events GROUP BY user_id""")
def mixed_or_value(spark, sf_dir):
    return games.value_or_mixed(projection(spark, sf_dir, "event"), "user_id", F.col("event_type"))


@query("SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 10 MINUTES PRECEDING AND CURRENT ROW) AS recent FROM events")
def rolling_10min(spark, sf_dir):
    return windows.rolling_rate(projection(spark, sf_dir, "event"), "user_id", "ts", 10).select("event_id", "user_id", "recent")


@query("SELECT time_bucket(INTERVAL 10 MINUTES, ts) AS start, count(*) AS n FROM events GROUP BY start")
def tumbling_10min(spark, sf_dir):
    return windows.tumbling_counts(projection(spark, sf_dir, "event"), "ts", 10)


@query("SELECT c_custkey FROM customer WHERE (regexp_matches(lower(c_name), '1[0-4]$') AND regexp_matches(lower(c_mktsegment), '1[0-4]$')) OR regexp_matches(lower(c_name), '7$') OR regexp_matches(lower(c_mktsegment), 'auto')")
def name_filter(spark, sf_dir):
    keep = games.names_match(["1[0-4]$"], ["7$", "AUTO"], F.col("c_name"), F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").where(keep).select("c_custkey")


@query("""SELECT page_id, CAST(min(i) AS BIGINT) AS place, link FROM (SELECT page_id, unnest(l) AS link, generate_subscripts(l, 1) AS i FROM (
SELECT page_id, regexp_extract_all(html, '(?i)<a\\s+href="([^"]*)"', 1) AS l FROM pages)) GROUP BY page_id, link""")
def html_links(spark, sf_dir):
    from tessera.sources.html import links

    return links(table(spark, sf_dir, "pages"))


@query("""SELECT r_name, t AS p_type, s AS p_size FROM region, (SELECT DISTINCT p_type AS t FROM part WHERE p_size <= 25), (SELECT DISTINCT p_size AS s FROM part WHERE p_size <= 5) WHERE r_name <> 'ASIA'""")
def config_cross(spark, sf_dir):
    from tessera.operators.lookups import config_cross as cross

    p = table(spark, sf_dir, "part")
    regions = table(spark, sf_dir, "region").select("r_name").where("r_name <> 'ASIA'")
    return cross(regions, p.where("p_size <= 25").select("p_type").distinct(), p.where("p_size <= 5").select("p_size").distinct())


@query("SELECT c_nationkey AS name FROM customer WHERE c_acctbal > 9000 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def name_intersect(spark, sf_dir):
    from tessera.operators.lookups import common_names

    a = table(spark, sf_dir, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("name"))
    return common_names(a, table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("name")))


@query("""SELECT coalesce(c.n, s.n) AS name, coalesce(s.v, c.v) AS v, CASE WHEN c.n IS NULL THEN 'added' WHEN s.n IS NULL THEN 'kept' ELSE 'changed' END AS state
FROM (SELECT c_custkey AS n, c_acctbal AS v FROM customer) c FULL JOIN (SELECT s_suppkey * 3 AS n, s_acctbal AS v FROM supplier) s ON c.n = s.n""")
def param_upsert(spark, sf_dir):
    from tessera.operators.lookups import upsert

    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("name"), F.col("c_acctbal").alias("v"))
    new = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 3).alias("name"), F.col("s_acctbal").alias("v"))
    return upsert(old, new, "name", "v")


@query("SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY day")
def daily_counts(spark, sf_dir):
    return games.daily_counts(table(spark, sf_dir, "orders"), "o_orderdate")


@query(f"""WITH {sql("edge")}, v AS (SELECT DISTINCT l_partkey AS node FROM lineitem WHERE l_quantity < 10)
SELECT DISTINCT dst FROM edge WHERE dst NOT IN (SELECT node FROM v)""")
def visited_anti_join(spark, sf_dir):
    seen = table(spark, sf_dir, "lineitem").where("l_quantity < 10").select(F.col("l_partkey").alias("dst"))
    return projection(spark, sf_dir, "edge").select("dst").distinct().join(seen, "dst", "left_anti")


@query(f"""WITH {EDGE}, leaf AS (SELECT DISTINCT dst AS node FROM e WHERE dst % 3 = 0), book AS (SELECT DISTINCT src AS node FROM e WHERE src % 5 = 0)
SELECT node FROM leaf WHERE EXISTS (SELECT 1 FROM e JOIN book ON book.node = e.dst WHERE e.src = leaf.node)""")
def rejoin_leaves(spark, sf_dir):
    e = edges(spark, sf_dir)
    leaf = e.where("dst % 3 = 0").select(F.col("dst").alias("node")).distinct()
    return graph.rejoin(leaf, e.select(F.col("src").alias("node"), "dst"), e.where("src % 5 = 0").select(F.col("src").alias("node")))


@query("SELECT l_orderkey, l_partkey, arg_max(l_extendedprice, (l_suppkey * 100 + l_linenumber) * 1000000 + l_extendedprice) AS price FROM lineitem GROUP BY l_orderkey, l_partkey")
def newest_wins(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.col("l_extendedprice").alias("price"), F.expr("(l_suppkey * 100 + l_linenumber) * 1000000 + l_extendedprice").alias("run"))
    return books.newest_wins(x, ["l_orderkey", "l_partkey"], "run").select("l_orderkey", "l_partkey", "price")


@query(f"""WITH {sql("book_move")}, o AS (SELECT key, move, arg_max(value, seq) AS v, arg_max(depth, seq) AS d FROM book_move WHERE book % 2 = 0 GROUP BY key, move),
n AS (SELECT key, move, CASE WHEN arg_max(depth, seq) > 2 THEN arg_max(value, seq) END AS v, arg_max(depth, seq) AS d FROM book_move WHERE book % 2 = 1 GROUP BY key, move)
SELECT coalesce(o.key, n.key) AS key, coalesce(o.move, n.move) AS move, CASE WHEN o.key IS NULL OR n.v IS NOT NULL THEN n.v ELSE o.v END AS value,
CASE WHEN o.key IS NULL OR n.v IS NOT NULL THEN n.d ELSE o.d END AS depth FROM o FULL JOIN n ON o.key = n.key AND o.move = n.move""")
def update_known(spark, sf_dir):
    old = books.merge_duplicates(moves(spark, sf_dir, "book % 2 = 0"))
    new = books.merge_duplicates(moves(spark, sf_dir, "book % 2 = 1")).withColumn("value", F.when(F.col("depth") > 2, F.col("value")))
    return books.update_known(old, new)


@query("SELECT user_id, max(CASE WHEN event_type = 'click' THEN value END) AS a, max(CASE WHEN event_type = 'view' THEN value END) AS b FROM events GROUP BY user_id")
def greatest_by_command(spark, sf_dir):
    x = projection(spark, sf_dir, "event")
    for name, kind in (("a", "click"), ("b", "view")):
        x = x.withColumn(name, F.when(F.col("event_type") == kind, F.col("value")))
    return games.greatest_by(x, "user_id", ["a", "b"])


@query("""SELECT o_orderpriority AS output, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS bytes, count(*) AS records, count(DISTINCT o_custkey) AS sources FROM orders GROUP BY output""")
def manifest(spark, sf_dir):
    x = table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "output")
    return layout.manifest(x, "output", "o_custkey", F.floor("o_totalprice").cast("bigint"))


@query("""SELECT s_suppkey, translate(CAST(s_suppkey % 9 + 1 AS VARCHAR) || 'g' || CAST(s_nationkey % 9 + 1 AS VARCHAR) || 'f', '123456789abcdefghi', '987654321ihgfedcba') AS move FROM supplier""")
def flipped_moves(spark, sf_dir):
    move = F.expr("concat(CAST(s_suppkey % 9 + 1 AS STRING), 'g', CAST(s_nationkey % 9 + 1 AS STRING), 'f')")
    return table(spark, sf_dir, "supplier").select("s_suppkey", flip_move(move).alias("move"))


@query("SELECT user_id, event_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) WHERE k = 1")
def latest_checkpoint(spark, sf_dir):
    return windows.latest(projection(spark, sf_dir, "event").select("user_id", "event_id", "ts", "value"), "user_id", "event_id")


@query("""SELECT coalesce(a.k, b.k) AS epoch, a.n AS plain, b.n AS averaged FROM (SELECT l_linenumber AS k, count(*) AS n FROM lineitem WHERE l_quantity < 20 GROUP BY k) a
FULL JOIN (SELECT p_size AS k, count(*) AS n FROM part GROUP BY k) b ON a.k = b.k""")
def attach_by_epoch(spark, sf_dir):
    from tessera.operators.lookups import attach

    a = table(spark, sf_dir, "lineitem").where("l_quantity < 20").groupBy(F.col("l_linenumber").alias("epoch")).agg(F.count(F.lit(1)).alias("plain"))
    b = table(spark, sf_dir, "part").groupBy(F.col("p_size").alias("epoch")).agg(F.count(F.lit(1)).alias("averaged"))
    return attach(a, b, ["epoch"])


@query()
def seeded_shuffle(spark, sf_dir):
    return layout.seeded_shuffle(orders(spark, sf_dir).select("o_orderkey"), ["o_orderkey"], 7)


@query()
def random_choice(spark, sf_dir):
    return layout.choose(orders(spark, sf_dir), "o_custkey", ["o_orderkey"], 7)
