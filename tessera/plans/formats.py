"""Registered queries that write files in the domain's formats from the test tables and read them again, with the DuckDB SQL of what must come back."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import functions as F

from tessera.functions import codec, sfen
from tessera.functions.codec import little
from tessera.operators import books, games, layout, positions, walks, windows
from tessera.plans.catalog import EDGE, edges
from tessera.plans.domain import CODE, FULL, MOVE, duck
from tessera.plans.physical import scratch
from tessera.plans.projections import sql
from tessera.plans.registry import moves, query, table
from tessera.sources import archives, html, records, sinks, training
from tessera.sources import books as book_files


def text_files(lines, folder: str, by: str | None = None) -> str:
    """Lines (text) written as text files; with ``by``, a file for each of its values, in a folder ``<by>=<value>``."""
    if by is None:
        lines.select("text").write.text(folder)
    else:
        lines.repartition(by).sortWithinPartitions(by, "at").select(by, "text").write.partitionBy(by).text(folder)
    return folder


# ---- books ----

MERGED = """m AS (SELECT key, move, arg_max(value, seq) AS value, arg_max(depth, seq) AS depth, CAST(sum(move_count) AS BIGINT) AS move_count, min(seq) AS slot FROM book_move GROUP BY key, move)"""


@query(f"""WITH {sql("book_move")}, {MERGED} SELECT 'p' || CAST(key AS VARCHAR) || CASE WHEN key % 2 = 0 THEN ' b' ELSE ' w' END || ' - ' || CAST(key % 50 + 1 AS VARCHAR) AS key, CAST(move AS VARCHAR) AS move, 'none' AS ponder, value, depth, move_count,
CAST(row_number() OVER (PARTITION BY key ORDER BY move_count DESC, value DESC, slot) - 1 AS INT) AS seq FROM m""")
def db_book(spark, sf_dir):
    """A text book."""
    name = F.concat(F.lit("p"), F.col("key").cast("string"), F.when(F.col("key") % 2 == 0, " b").otherwise(" w"), F.lit(" - "), (F.col("key") % 50 + 1).cast("string"))
    m = books.merge_duplicates(moves(spark, sf_dir)).select(name.alias("key"), F.col("move").cast("string").alias("move"), F.lit("none").alias("ponder"), "value", "depth", "move_count", F.col("slot").alias("seq"))
    book_files.write_db(m, place := scratch(spark))
    return book_files.read_db(spark, place).drop("block")


@query("""SELECT 'p' || CAST(s_suppkey AS VARCHAR) || ' b -' AS key, 'm' || CAST(s_nationkey AS VARCHAR) AS move, CAST(CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE 1 END AS INT) AS depth, CAST(s_suppkey % 100 - 50 AS INT) AS value FROM supplier WHERE s_suppkey % 3 > 0""")
def miner_book(spark, sf_dir):
    """S3: a miner's book: commas or spaces, missing depths, moves without a value, a prelude that is no position."""
    x = table(spark, sf_dir, "supplier")
    value = F.expr("CASE WHEN s_suppkey % 3 = 0 THEN 'None' ELSE CAST(s_suppkey % 100 - 50 AS STRING) END")
    gap = F.expr("CASE WHEN s_suppkey % 2 = 0 THEN ',' ELSE ' ' END")
    line = F.concat(F.concat(F.lit("m"), F.col("s_nationkey").cast("string")), gap, F.lit("none"), gap, value, F.when(F.col("s_suppkey") % 4 > 0, F.concat(gap, F.lit("1"))).otherwise(""))
    block = F.concat(F.lit("sfen p"), F.col("s_suppkey").cast("string"), F.lit(" b - 3\n// seen\n"), line)
    head = spark.createDataFrame([("#a miner's book\nnot a position",)], "text string")
    place = scratch(spark)
    head.unionByName(x.select(block.alias("text"))).coalesce(1).write.text(place)
    return book_files.read_db(spark, place, ignore_ply=True, miner=True).select("key", "move", "depth", "value")


@query(duck(f"""WITH p AS (SELECT s_suppkey AS k, {FULL.replace("k %", "s_suppkey %")} AS sfen FROM supplier), d AS (SELECT min(k) AS k, regexp_replace(sfen, ' [0-9]+$', '') AS key FROM p GROUP BY key)
SELECT key, CAST(k % 300 + 1 AS INT) AS ply, CAST(i AS INT) AS seq, {MOVE.replace("k %", "(k + i) %")} AS move, CAST(k % 200 - 100 + i AS INT) AS value, CAST(i + 3 AS INT) AS depth FROM d, (SELECT unnest([0, 1, 2]) AS i)"""))
def ybb_book(spark, sf_dir):
    """A binary book with a sorted index."""
    x = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")).withColumn("sfen", F.expr(FULL))
    d = x.groupBy(sfen.trim_ply(F.col("sfen")).alias("key")).agg(F.min("k").alias("k")).withColumn("i", F.explode(F.array(*map(F.lit, range(3)))))
    rows = d.select(
        codec.pack_sfen("key").alias("packed"), (F.col("k") % 300 + 1).cast("int").alias("ply"), F.col("i").alias("seq"), F.expr(MOVE.replace("k %", "(k + i) %")).alias("move"),
        (F.col("k") % 200 - 100 + F.col("i")).cast("int").alias("value"), (F.col("i") + 3).alias("depth"),
    )
    sinks.write_ybb(rows, place := scratch(spark) + ".ybb")
    return book_files.read_ybb(spark, place).withColumn("key", sfen.trim_ply(codec.unpack_sfen("packed", "ply"))).drop("packed")


@query("""SELECT CAST(k AS VARCHAR) AS key, m AS move16, CAST(least(n, 65535) AS INT) AS count, score FROM (SELECT CASE WHEN c_custkey % 2 = 0 THEN CAST(18446744073709551615 AS HUGEINT) - c_custkey ELSE c_custkey END AS k,
CAST(c_custkey * 37 % 65536 AS INT) AS m, c_custkey * 90 AS n, CAST(floor(c_acctbal) AS INT) AS score FROM customer)""")
def apery_book(spark, sf_dir):
    """Unsigned keys, counts that stop at 65535, negative scores."""
    rows = table(spark, sf_dir, "customer").selectExpr(
        "CASE WHEN c_custkey % 2 = 0 THEN CAST('18446744073709551615' AS DECIMAL(20, 0)) - c_custkey ELSE CAST(c_custkey AS DECIMAL(20, 0)) END AS key", "CAST(c_custkey * 37 % 65536 AS INT) AS move16",
        "CAST(c_custkey * 90 AS INT) AS count", "CAST(floor(c_acctbal) AS INT) AS score",
    )
    sinks.write_apery(rows.withColumn("key", F.col("key").cast("decimal(20,0)")), place := scratch(spark) + ".bin")
    return book_files.read_apery(spark, place).withColumn("key", F.col("key").cast("string"))


# ---- training records ----

RECORD = """SELECT o_orderkey AS k, CAST(o_orderkey % 60001 - 30000 AS INT) AS eval, CAST(o_orderkey * 31 % 65536 AS INT) AS move16, CAST(o_orderkey % 3 AS INT) AS result FROM orders"""


def hcpe_rows(spark, sf_dir):
    """Positions are 32 bytes whose first bit is the side to move and whose next bytes are the order's number."""
    x = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS k", "CAST(o_orderkey % 60001 - 30000 AS INT) AS eval", "CAST(o_orderkey * 31 % 65536 AS INT) AS move16", "CAST(o_orderkey % 3 AS INT) AS result")
    return x.withColumn("hcp", F.concat(sinks.bits(F.col("k") % 2, 1), sinks.bits(F.col("k"), 4), F.unhex(F.lit("0A00FF0D2000C3A9" * 3)), F.unhex(F.lit("C0AFE2"))))


@query(f"SELECT CAST(k AS INT) AS k, eval, move16, result FROM ({RECORD})")
def hcpe_records(spark, sf_dir):
    """Records written side by side and read again, whatever bytes they hold."""
    sinks.write_hcpe(hcpe_rows(spark, sf_dir), place := scratch(spark))
    return training.read_hcpe(spark, place).select(little(F.col("hcp"), 1, 4, True).alias("k"), "eval", "move16", "result")


@query(f"""SELECT CAST(k AS INT) AS k, eval AS score, move16, CAST(0 AS INT) AS ply, CAST(CASE WHEN result = 0 THEN 0 WHEN (result = 1) = (k % 2 = 0) THEN 1 ELSE -1 END AS INT) AS result, result AS again FROM ({RECORD})""")
def psv_records(spark, sf_dir):
    """Hcpe to psv, written, read, and back."""
    sinks.write_psv(training.hcpe_to_psv(hcpe_rows(spark, sf_dir)), place := scratch(spark))
    x = training.read_psv(spark, place)
    again = training.absolute_result(F.col("result"), training.side_to_move(F.col("sfen")))
    return x.select(little(F.col("sfen"), 1, 4, True).alias("k"), "score", "move16", "ply", "result", again.alias("again"))


GAME = duck(f"""g AS (SELECT c_custkey AS g, c_custkey % 3 AS result, unnest(range(0, c_custkey % 6)) AS i FROM customer WHERE c_custkey <= 300),
p AS (SELECT *, g + 17 * i AS k, CAST(g * 7 % 1000 - 500 + i AS INT) AS eval FROM g), q AS (SELECT g, result, i, eval, {MOVE} AS move FROM p)""")


def game_rows(spark, sf_dir, candidates: bool):
    x = table(spark, sf_dir, "customer").where("c_custkey <= 300").select(F.col("c_custkey").alias("g"))
    each = x.where("g % 6 > 0").withColumn("i", F.explode(F.expr("sequence(0, CAST(g % 6 AS INT) - 1)"))).withColumn("k", F.col("g") + 17 * F.col("i"))
    ply = [F.expr(CODE).cast("int").alias("move16"), F.expr("CAST(g * 7 % 1000 - 500 + i AS INT)").alias("eval")]
    if candidates:
        ply.append(F.array(F.struct(F.expr(CODE).cast("int").alias("move16"), (F.col("i") + 1).cast("int").alias("visits"))).alias("candidates"))
    plies = each.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("i", F.struct(*ply).alias("p")))).alias("l")).select("g", F.col("l.p").alias("plies"))
    start = F.concat(sinks.bits(F.col("g"), 4), F.unhex(F.lit("00" * 28)))
    none = F.array().cast(plies.schema["plies"].dataType)
    return x.join(plies, "g", "left").select("g", start.alias("start"), (F.col("g") % 3).cast("int").alias("result"), F.coalesce("plies", none).alias("plies"))


@query(f"""WITH {GAME} SELECT CAST(g AS INT) AS g, CAST(result AS INT) AS result, CAST(i AS INT) AS at, move, eval, lead(move) OVER (PARTITION BY g ORDER BY i) AS ponder, CAST(i + 1 AS INT) AS visits FROM q""")
def hcpe3_games(spark, sf_dir):
    """Games with candidates, concatenated in one file, and a row for each ply."""
    x = game_rows(spark, sf_dir, True).select(F.col("start").alias("hcp"), "result", F.lit(0).alias("info"), "plies")
    sinks.write_games(x, place := scratch(spark) + ".hcpe3", "hcpe3")
    found = training.game_moves(training.read_games(spark, place, "hcpe3").withColumn("visits", F.transform("plies", lambda p: p["candidates"][0]["visits"])))
    return found.select(little(F.col("hcp"), 0, 4, True).alias("g"), "result", "at", "move", "eval", "ponder", F.col("visits")[F.col("at")].alias("visits"))


@query(f"""WITH {GAME}, n AS (SELECT g, count(*) AS n FROM q GROUP BY g) SELECT CAST(c_custkey AS INT) AS g, CAST(c_custkey % 3 AS INT) AS result, CAST(c_custkey % 5 AS INT) AS reason, CAST(c_custkey % 100 + 1 AS INT) AS ply,
CAST(coalesce(n, 0) AS INT) AS plies, (SELECT move FROM q WHERE q.g = c_custkey AND i = 0) AS first FROM customer LEFT JOIN n ON n.g = c_custkey WHERE c_custkey <= 300""")
def pack_games(spark, sf_dir):
    """Self-delimiting games, some without moves."""
    x = game_rows(spark, sf_dir, False).selectExpr("start", "CAST(g % 100 + 1 AS INT) AS ply", "result", "CAST(g % 5 AS INT) AS reason", "plies")
    sinks.write_games(x, place := scratch(spark) + ".pack", "pack")
    first = codec.usi_of(F.get(F.col("plies"), F.lit(0))["move16"])
    return training.read_games(spark, place, "pack").select(little(F.col("start"), 0, 4, True).alias("g"), "result", "reason", "ply", F.size("plies").alias("plies"), first.alias("first"))


#: Openings, and the positions before each of their moves.
OPENINGS = ("startpos moves 7g7f 3c3d 2g2f", "startpos moves 7g7f 3c3d 8h2b+ 3a2b", "startpos moves 2g2f 8c8d 2f2e 9a9z")
KEYS = {
    "start": "lnsgkgsnl/1r5b1/ppppppppp/9/9/9/PPPPPPPPP/1B5R1/LNSGKGSNL b -",
    "7g7f": "lnsgkgsnl/1r5b1/ppppppppp/9/9/2P6/PP1PPPPPP/1B5R1/LNSGKGSNL w -",
    "7g7f 3c3d": "lnsgkgsnl/1r5b1/pppppp1pp/6p2/9/2P6/PP1PPPPPP/1B5R1/LNSGKGSNL b -",
    "2g2f": "lnsgkgsnl/1r5b1/ppppppppp/9/9/7P1/PPPPPPP1P/1B5R1/LNSGKGSNL w -",
}


@query(f"""WITH s(line, key, move, ponder) AS (VALUES (0, '{KEYS["start"]}', '7g7f', '3c3d'), (0, '{KEYS["7g7f"]}', '3c3d', '2g2f'), (1, '{KEYS["start"]}', '7g7f', '3c3d'), (1, '{KEYS["7g7f"]}', '3c3d', '8h2b+'),
(1, '{KEYS["7g7f 3c3d"]}', '8h2b+', '3a2b'), (2, '{KEYS["start"]}', '2g2f', '8c8d'), (2, '{KEYS["2g2f"]}', '8c8d', '2f2e'))
SELECT key, move, min(ponder) AS ponder, count(*) AS move_count FROM orders JOIN s ON o_orderkey % 3 = line GROUP BY key, move""")
def games_to_book(spark, sf_dir):
    """The last move of a game and what follows an illegal one have no row."""
    line = F.element_at(F.array(*map(F.lit, OPENINGS)), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return positions.games_to_book(table(spark, sf_dir, "orders").select(line.alias("position")), 10)


@query(f"""WITH k(node, key) AS (VALUES (0, '{KEYS["start"]}'), (1, '{KEYS["7g7f"]}'), (2, '{KEYS["7g7f 3c3d"]}')) SELECT key, CAST(node AS INT) AS level FROM k WHERE EXISTS (SELECT 1 FROM region)""")
def book_levels(spark, sf_dir):
    """G8 and G9 over legal moves: with a budget of one unregistered position, the third is reached by way of the second, which is not in the book for walks."""
    keys = spark.createDataFrame([(KEYS["start"],), (KEYS["7g7f"],), (KEYS["7g7f 3c3d"],)], "key string")
    labels = positions.ply_labels(keys, sfen.STARTPOS, 3)
    walk = positions.budgeted_walk(keys.where(F.col("key") != KEYS["7g7f"]), sfen.STARTPOS, 1, 2)
    return labels.join(walk.select("key", F.col("level").alias("w")), "key", "left").where("w IS NULL AND level = 1 OR w = level").select("key", "level")


# ---- text records ----


@query("""SELECT c_custkey AS game, 'p' || CAST(c_custkey % 7 AS VARCHAR) AS black, CASE WHEN c_custkey % 5 > 0 THEN 'q é' END AS white, CAST(CASE WHEN c_custkey % 2 = 0 THEN 1000.5 + c_custkey END AS DOUBLE) AS black_rate, CAST(c_custkey % 4 AS INT) AS plies,
CASE c_custkey % 3 WHEN 0 THEN CASE WHEN c_custkey % 4 % 2 = 0 THEN 1 ELSE 0 END WHEN 1 THEN 2 ELSE NULL END AS winner FROM customer WHERE c_custkey <= 40""")
def csa_games(spark, sf_dir):
    """Records of games, one a file, of which only the columns asked for are parsed."""
    x = table(spark, sf_dir, "customer").where("c_custkey <= 40").select(F.col("c_custkey").alias("game"))
    text = F.concat_ws(
        "\n", F.lit("V2.2"), F.expr("concat('N+p', CAST(game % 7 AS STRING))"), F.expr("CASE WHEN game % 5 > 0 THEN 'N-q é' END"), F.expr("CASE WHEN game % 2 = 0 THEN concat('''black_rate:x:', CAST(1000.5D + game AS STRING)) END"),
        F.lit("PI\n+"), F.expr("array_join(slice(array('+7776FU', '-3334FU\nT5', '+2726FU'), 1, CAST(game % 4 AS INT)), '\n')"), F.expr("CASE game % 3 WHEN 0 THEN '%TORYO' WHEN 1 THEN '%SENNICHITE' ELSE '%CHUDAN' END"),
    )
    place = text_files(x.select("game", F.lit(0).alias("at"), text.alias("text")), scratch(spark), "game")
    return records.csa_games(spark, place).select(
        F.regexp_extract("path", r"game=(\d+)", 1).cast("bigint").alias("game"), "black", "white", "black_rate", F.size("moves").alias("plies"), "winner"
    )


@query("""SELECT c_custkey AS game, '先手' || CAST(c_custkey AS VARCHAR) AS black, make_date(2024, 2, c_custkey % 28 + 1) AS played, '7g7f 3c3d 8h2b+ 3a2b B*4e' AS moves, CASE c_custkey % 2 WHEN 0 THEN CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 1 END ELSE 2 END AS winner, c_custkey % 3 = 0 AS handicap FROM customer WHERE c_custkey <= 30""")
def kif_games(spark, sf_dir):
    """KIF records in UTF-8; the moves of each are read from its lines."""
    x = table(spark, sf_dir, "customer").where("c_custkey <= 30").select(F.col("c_custkey").alias("game"))
    body = "手合割：平手\n手数----指手\n   1 ７六歩(77)\n   2 ３四歩(33)   ( 0:01/)\n*note\n   3 ２二角成(88)\n   4 同　銀(31)\n   5 ４五角打\n   6 "
    text = F.concat(F.lit("開始日時：2024/02/"), F.lpad((F.col("game") % 28 + 1).cast("string"), 2, "0"), F.lit("\n先手："), F.concat(F.lit("先手"), F.col("game").cast("string")), F.lit("\n後手：x\n" + body), F.expr("CASE WHEN game % 2 = 0 THEN '反則勝ち' ELSE '千日手' END"))
    text = F.when(F.col("game") % 3 == 0, F.replace(text, F.lit("手合割：平手"), F.lit("手合割：二枚落ち\u3000"))).otherwise(text)
    place = text_files(x.select("game", F.lit(0).alias("at"), text.alias("text")), scratch(spark), "game")
    found = records.kif_games(spark, f"{place}/*/*.txt").withColumn("handicap", F.col("start") == "lnsgkgsnl/9/ppppppppp/9/9/9/PPPPPPPPP/1B5R1/LNSGKGSNL w - 1")
    return found.select("handicap", F.regexp_extract("path", r"game=(\d+)", 1).cast("bigint").alias("game"), "black", "played", F.array_join("moves", " ").alias("moves"), "winner")


NOTES = """CASE WHEN event_id % 3 = 0 THEN CASE WHEN event_id % 2 = 0 THEN '+7776FU' ELSE '-3334FU' END || CASE WHEN event_id % 9 = 0 THEN ' ** 7' ELSE '' END
WHEN event_id % 5 = 0 THEN chr(39) || '** ' || CAST(event_id AS VARCHAR) || ' x' WHEN event_id % 7 = 0 THEN chr(39) || '評価値 -' || CAST(event_id AS VARCHAR) ELSE 'T1' END"""


@query(f"""WITH l AS (SELECT user_id AS path, event_id AS pos, {NOTES} AS line FROM events),
x AS (SELECT path, pos, CASE WHEN line LIKE '+%' THEN 0 WHEN line LIKE '-%' THEN 1 END AS side, TRY_CAST(nullif(regexp_extract(line, '(?:[*][*]|評価値) *(-?[0-9]+)', 1), '') AS INT) AS v FROM l),
g AS (SELECT *, coalesce(sum(CAST(side IS NOT NULL AS INT)) OVER (PARTITION BY path ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part FROM x),
c AS (SELECT path, pos, side, last_value(v IGNORE NULLS) OVER (PARTITION BY path, part ORDER BY pos) AS value FROM g) SELECT path, pos, side, value FROM c WHERE side IS NOT NULL AND value IS NOT NULL""")
def csa_evals(spark, sf_dir):
    """An evaluation waits for the next move."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("path"), F.col("event_id").alias("at"), F.expr(NOTES.replace("AS VARCHAR", "AS STRING")).alias("line"))
    return records.csa_evals(rows).withColumnRenamed("at", "pos")


KIF_NOTES = """CASE WHEN event_id % 3 = 0 THEN '  ' || CAST(event_id % 100 AS VARCHAR) || ' ７六歩(77)' WHEN event_id % 2 = 0 THEN '**解析 評価値 ' || CAST(event_id AS VARCHAR) ELSE '*x' END"""


@query(f"""WITH l AS (SELECT user_id AS path, event_id AS pos, {KIF_NOTES} AS line FROM events),
x AS (SELECT path, pos, TRY_CAST(nullif(regexp_extract(line, '^ +([0-9]+) ', 1), '') AS INT) AS n, TRY_CAST(nullif(regexp_extract(line, '評価値 ([0-9]+)', 1), '') AS INT) AS value FROM l),
c AS (SELECT path, pos, last_value(CAST(1 - n % 2 AS INT) IGNORE NULLS) OVER (PARTITION BY path ORDER BY pos) AS side, value FROM x) SELECT path, pos, side, value FROM c WHERE side IS NOT NULL AND value IS NOT NULL""")
def kif_evals(spark, sf_dir):
    """An evaluation belongs to the move before it."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("path"), F.col("event_id").alias("at"), F.expr(KIF_NOTES.replace("AS VARCHAR", "AS STRING")).alias("line"))
    return records.kif_evals(rows).withColumnRenamed("at", "pos")


@query("SELECT n_nationkey, 'é ü 先手 ' || n_name AS text FROM nation")
def decoded_texts(spark, sf_dir):
    """Texts in the first encoding that fits: UTF-8 with and without its mark; others are tested on fixtures."""
    x = table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("é ü 先手 "), "n_name").alias("t"))
    raw = F.concat(F.when(F.col("n_nationkey") % 2 == 0, F.unhex(F.lit("EFBBBF"))).otherwise(F.unhex(F.lit(""))), F.encode("t", "UTF-8"))
    return x.select("n_nationkey", records.decoded(raw).alias("text"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dt FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1995-02-01'")
def dated_folders(spark, sf_dir):
    """A folder for each month, of which the filter on the folder's name reads one; days are then filtered within."""
    x = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("dt"), F.date_format("o_orderdate", "yyyyMM").cast("int").alias("month"))
    x.repartition("month").write.partitionBy("month").parquet(place := scratch(spark))
    return spark.read.parquet(place).where("month = 199501").select("o_orderkey", "dt")


@query("SELECT s_name AS name, CAST(s_nationkey * 100 + 0.5 AS DOUBLE) AS rating FROM supplier WHERE s_suppkey <= 60")
def rating_tables(spark, sf_dir):
    """The rows of a page's rating table; other tables on it are passed over."""
    x = table(spark, sf_dir, "supplier").where("s_suppkey <= 60")
    row = F.concat(F.lit("<tr><td><a href='x'>"), "s_name", F.lit("</a></td><td>"), (F.col("s_nationkey") * 100 + 0.5).cast("string"), F.lit("</td><td>9</td></tr>"))
    page = x.groupBy((F.col("s_suppkey") % 3).alias("page_id")).agg(F.array_join(F.collect_list(row), "\n").alias("rows"))
    page = page.select("page_id", F.concat(F.lit("<html><table><tr><td>no</td><td>1</td></tr></table><table class='player-rating'><tr><th>Name</th><th>Rate</th></tr>"), "rows", F.lit("</table></html>")).alias("html"))
    return html.rating_table(page).select("name", "rating")


LOG = """CASE WHEN event_id % 11 = 0 THEN 'teacher = t' || CAST(event_id AS VARCHAR) || '.bin' WHEN event_id % 7 = 0 THEN 'lr=0.5' WHEN event_id % 5 = 0 THEN 'batchsize=' || CAST(event_id AS VARCHAR)
WHEN event_id % 4 = 0 THEN 'position_num = ' || CAST(event_id AS VARCHAR) WHEN event_id % 3 = 0 THEN 'epoch = ' || CAST(event_id AS VARCHAR) || ', steps = 10, train loss avr = 0.25' ELSE 'noise' END"""


@query(f"""WITH l AS (SELECT user_id AS path, event_id AS pos, {LOG} AS line FROM events),
x AS (SELECT *, TRY_CAST(nullif(regexp_extract(line, 'batchsize=([0-9]+)', 1), '') AS INT) AS b, TRY_CAST(nullif(regexp_extract(line, 'lr=([0-9.]+)', 1), '') AS DOUBLE) AS r, nullif(regexp_extract(line, 'teacher = (.*)', 1), '') AS t,
TRY_CAST(nullif(regexp_extract(line, 'position_num = ([0-9]+)', 1), '') AS BIGINT) AS p, TRY_CAST(nullif(regexp_extract(line, 'epoch = ([0-9]+)', 1), '') AS INT) AS epoch FROM l),
n AS (SELECT *, count(t) OVER (PARTITION BY path ORDER BY pos) AS part FROM x),
c AS (SELECT path, epoch, last_value(b IGNORE NULLS) OVER (PARTITION BY path ORDER BY pos) AS batchsize, last_value(r IGNORE NULLS) OVER (PARTITION BY path ORDER BY pos) AS lr,
last_value(t IGNORE NULLS) OVER (PARTITION BY path, part ORDER BY pos) AS teacher, last_value(p IGNORE NULLS) OVER (PARTITION BY path, part ORDER BY pos) AS positions FROM n)
SELECT path, epoch, CAST(10 AS BIGINT) AS steps, CAST(0.25 AS DOUBLE) AS loss, batchsize, lr, teacher, positions FROM c WHERE epoch IS NOT NULL""")
def train_logs(spark, sf_dir):
    """Settings last seen before each summary; a teacher's line begins a stretch."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("path"), F.col("event_id").alias("at"), F.expr(LOG.replace("AS VARCHAR", "AS STRING")).alias("line"))
    return records.train_log(rows).drop("val_lambda")


@query("""SELECT 'par' || CAST(s_suppkey AS VARCHAR) AS name, 'int' AS type, CAST(s_nationkey AS DOUBLE) AS v, CAST(-10 AS DOUBLE) AS least, CAST(99.5 AS DOUBLE) AS most, CAST(2 AS DOUBLE) AS step, CAST(0.1 AS DOUBLE) AS delta,
CASE WHEN s_suppkey % 2 = 0 THEN 'a note' ELSE '' END AS comment, s_suppkey % 5 = 0 AS not_used FROM supplier WHERE s_suppkey % 7 > 0""")
def parameter_files(spark, sf_dir):
    """Lines of too few fields are left out."""
    text = F.expr("""concat('par', CAST(s_suppkey AS STRING), ', int, ', CASE WHEN s_suppkey % 7 = 0 THEN '1' ELSE concat(CAST(s_nationkey AS STRING), ', -10, 99.5, 2, 0.1') END,
    CASE WHEN s_suppkey % 2 = 0 THEN ' // a note' ELSE '' END, CASE WHEN s_suppkey % 5 = 0 THEN ' [[NOT USED]]' ELSE '' END, '\r\n')""")
    return records.parameters(spark, text_files(table(spark, sf_dir, "supplier").select(text.alias("text")), scratch(spark)))


@query("""SELECT DISTINCT 'startpos moves ' || m AS command, CAST(len(string_split(m, ' ')) AS INT) AS plies, CAST(CASE WHEN k % 2 = 0 THEN 400 END AS INT) AS eval_limit FROM (SELECT o_custkey AS k, string_agg(CAST(o_orderkey AS VARCHAR), ' ' ORDER BY o_orderkey) AS m FROM orders GROUP BY o_custkey)""")
def position_files(spark, sf_dir):
    """Position lines written once each, in the order in which they first occur, and read with their options."""
    x = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list("o_orderkey")).alias("l"))
    line = F.concat(F.lit("startpos moves "), F.array_join(F.transform("l", lambda v: v.cast("string")), " "), F.when(F.col("o_custkey") % 2 == 0, ", eval_limit = 400").otherwise(""))
    twice = x.select(line.alias("text"), F.col("o_custkey").alias("at")).crossJoin(spark.range(2).withColumnRenamed("id", "n"))
    once = windows.first_occurrence(twice.select("text", "at"), ["text"], "at")
    place = text_files(once.orderBy("at").unionByName(spark.createDataFrame([("# end", 0), ("  ", 0)], "text string, at bigint")), scratch(spark))
    found = records.position_lines(spark.read.text(place), "value")
    return found.select("command", F.size("moves").alias("plies"), F.element_at("options", "eval_limit").alias("eval_limit"))


@query("""SELECT 'id' || CAST(c_custkey AS VARCHAR) || ' x' AS name, 'spin' AS type, CAST(c_nationkey AS VARCHAR) AS value, '1' AS least, '99' AS most FROM customer""")
def option_lines(spark, sf_dir):
    line = F.concat(F.lit("option name id"), F.col("c_custkey").cast("string"), F.lit(" x type spin default "), F.col("c_nationkey").cast("string"), F.lit(" min 1 max 99"))
    o = records.option_line(line)
    return table(spark, sf_dir, "customer").select(o["name"].alias("name"), o["type"].alias("type"), o["default"].alias("value"), o["least"].alias("least"), o["most"].alias("most"))


# ---- written layouts ----


@query("SELECT o_orderkey, CAST(ntile(5) OVER (ORDER BY o_orderkey) - 1 AS INT) AS file_no FROM orders")
def numbered_files(spark, sf_dir):
    """Numbered files, read again; a second write without force is refused."""
    x = layout.split_even(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 5)
    layout.write_numbered(x, place := scratch(spark), ["o_orderkey"])
    try:
        layout.write_numbered(x, place, ["o_orderkey"])
    except Exception as e:
        if "already exists" not in str(e).lower():
            raise
    else:
        raise AssertionError("overwritten")
    return spark.read.parquet(place).select("o_orderkey", "file_no")


@query("""WITH t AS (SELECT o_orderkey, o_orderstatus = 'F' AS black, row_number() OVER (PARTITION BY o_orderstatus = 'F' ORDER BY o_orderkey) AS k FROM orders WHERE o_orderstatus IN ('F', 'O'))
SELECT row_number() OVER (ORDER BY k, black) AS position, 'startpos moves ' || CAST(o_orderkey AS VARCHAR) AS line FROM t""")
def interleaved_lines(spark, sf_dir):
    """The lines of both sides in turn, written as text with their places."""
    x = table(spark, sf_dir, "orders").where("o_orderstatus IN ('F', 'O')").select("o_orderkey", (F.col("o_orderstatus") == "F").alias("black"))
    out = layout.round_robin(x, "black", ["o_orderkey"])
    layout.write_lines(out.select("position", F.concat(F.lit("startpos moves "), F.col("o_orderkey").cast("string")).alias("line")), place := scratch(spark), "position")
    return layout.read_lines(spark, place).withColumnsRenamed({"at": "position"})


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def csv_report(spark, sf_dir):
    """K8."""
    table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal").write.option("header", True).csv(place := scratch(spark))
    return spark.read.schema("c_custkey bigint, c_name string, c_acctbal double").option("header", True).csv(place)


@query("""SELECT c_nationkey AS nation, max(c_custkey) AS n, strftime(make_timestamp(2024, 1, 1, 0, 0, 0) + to_seconds(max(c_custkey)), '%Y%m%d%H%M%S') AS stamp FROM customer GROUP BY c_nationkey""")
def latest_backups(spark, sf_dir):
    """The newest of time-stamped names, and what its name tells."""
    stamp = F.date_format(F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, c_custkey)"), "yyyyMMddHHmmss")
    name = layout.backup_name(F.concat(F.lit("book"), F.col("c_nationkey").cast("string")), stamp, F.col("c_custkey"), F.when(F.col("c_custkey") % 2 == 0, F.lit(40)))
    x = layout.latest_backups(table(spark, sf_dir, "customer").select(name.alias("name")), "name")
    return x.select(F.regexp_extract("base", r"(\d+)$", 1).cast("int").alias("nation"), "n", "stamp")


@query("""SELECT c_custkey AS game FROM customer WHERE c_custkey <= 40 AND c_custkey % 2 = 0 AND c_custkey % 7 IN (1, 2)""")
def header_filter(spark, sf_dir):
    """F16: games kept by their headers alone: neither moves nor results are parsed."""
    x = table(spark, sf_dir, "customer").where("c_custkey <= 40").select(F.col("c_custkey").alias("game"))
    text = F.expr("concat('N+p', CAST(game % 7 AS STRING), '\nN-q\n', CASE WHEN game % 2 = 0 THEN '''black_rate:x:2000\n' ELSE '' END, '+7776FU\n%TORYO')")
    place = text_files(x.select("game", F.lit(0).alias("at"), text.alias("text")), scratch(spark), "game")
    kept = records.csa_games(spark, place).where("black_rate >= 2000").where(games.names_match([], ["^p[12]$"], F.col("black"), F.col("white")))
    return kept.select(F.regexp_extract("path", r"game=(\d+)", 1).cast("bigint").alias("game"))


# ---- around the engine ----


@query("""SELECT n_nationkey AS nation, 'g/' || CAST(i AS VARCHAR) || '.csa' AS member, n_name || CAST(i AS VARCHAR) AS text FROM nation, (SELECT unnest([0, 1, 2]) AS i) WHERE n_nationkey % 5 < 3""")
def archive_members(spark, sf_dir):
    """Archives of a range of years, by their names, and the files in them."""
    place = scratch(spark)
    for r in table(spark, sf_dir, "nation").select("n_nationkey", "n_name").toLocalIterator():  # 25 rows
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
            for i in range(3):
                z.writestr(f"g/{i}.csa", f"{r.n_name}{i}")
        sinks.write_file(spark, f"{place}/wdoor{2015 + r.n_nationkey % 5}-{r.n_nationkey}.zip", [held.getvalue()])
    found = archives.members(spark, place, (2015, 2017))
    return found.select(F.regexp_extract("path", r"-(\d+)\.zip", 1).cast("int").alias("nation"), "member", records.decoded("content").alias("text"))


@query("""SELECT c_custkey AS url, c_nationkey AS size FROM customer WHERE (c_custkey, c_nationkey) NOT IN (SELECT s_suppkey * 3, s_nationkey FROM supplier)""")
def changed_files(spark, sf_dir):
    """What an incremental download fetches; the transfer itself is outside of the engine."""
    listing = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("url"), F.col("c_nationkey").alias("size"))
    return archives.changed(listing, table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 3).alias("url"), F.col("s_nationkey").alias("size")))


@query("SELECT n_nationkey, 'e' || CAST(n_nationkey AS VARCHAR) AS engine, CAST(n_regionkey AS INT) AS multipv FROM nation")
def settings_files(spark, sf_dir):
    """A settings file that names every nation, read on the driver as settings are."""
    rows = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey").collect()  # 25 rows
    items = "\n".join(f"""  {{id: {r.n_nationkey}, /* a // note */ 'engine': 'e{r.n_nationkey}', "multipv": {r.n_regionkey},}}, // of {r.n_nationkey}""" for r in rows)
    sinks.write_file(spark, place := scratch(spark) + ".json5", [f"// settings\n{{engines: [\n{items}\n],}}\n".encode()])
    found = records.settings(spark.read.text(place, wholetext=True).first().value)
    return spark.createDataFrame([(e["id"], e["engine"], e["multipv"]) for e in found["engines"]], "n_nationkey int, engine string, multipv int")


@query(f"""WITH RECURSIVE {EDGE}, b AS (SELECT src AS node, max(value) - 50000 AS value FROM e WHERE src % 4 > 0 GROUP BY src), l AS (SELECT DISTINCT o_custkey AS line, o_custkey AS node, 0 AS ply FROM orders
UNION ALL SELECT line, node * 3 % 2000 + 1, ply + 1 FROM l WHERE ply < 5), x AS (SELECT l.*, b.value, lead(b.value) OVER (PARTITION BY line ORDER BY ply) AS beyond FROM l LEFT JOIN b ON b.node = l.node),
r AS (SELECT *, CASE WHEN value IS NULL THEN 'unknown' WHEN ply < 5 AND beyond IS NULL AND abs(value) > 20000 THEN 'decided' WHEN ply = 5 THEN 'end' END AS reason FROM x)
SELECT line, CAST(ply AS INT) AS ply, node, reason FROM r WHERE reason IS NOT NULL QUALIFY row_number() OVER (PARTITION BY line ORDER BY ply) = 1""")
def mining_starts(spark, sf_dir):
    path = F.expr("aggregate(sequence(1, 5), array(o_custkey), (a, i) -> array_append(a, element_at(a, -1) * 3 % 2000 + 1))")
    lines = table(spark, sf_dir, "orders").select("o_custkey").distinct().select(F.col("o_custkey").alias("line"), path.alias("path"))
    book = edges(spark, sf_dir).where("src % 4 > 0").select(F.col("src").alias("node"), (F.col("value") - 50000).alias("value"))
    return walks.mining_starts(lines, book, 20000)
