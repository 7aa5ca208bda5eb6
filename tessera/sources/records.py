"""Game records, logs and parameter files in text."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.sfen import STARTPOS
from tessera.operators.windows import carry_forward, pending


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, at, line): lines without BOM, line ends and outer blanks; empty ones are left out.

    Files split among tasks. ``at`` orders a file's lines: the block of the file that they were read from, then their number in it.
    """
    x = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n")).alias("at"),
        F.trim(F.regexp_replace("value", "[\ufeff\r]", "")).alias("line"),
    )
    return x.where("line <> ''")


def csa_games(spark: SparkSession, path: str, any_encoding: bool = False) -> DataFrame:
    """(path, black, white, black_rate, white_rate, moves, result, winner) of CSA files, in UTF-8, or with ``any_encoding`` in those of ``ENCODINGS``.

    The result token is judged from the side to move, the other than the last mover's: 0 Black won, 1 White won, 2 draw, null unknown.
    """
    if any_encoding:
        whole = spark.read.format("binaryFile").load(path).select("path", decoded("content").alias("t"))
    else:
        whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("t"))
    one = lambda pattern: F.nullif(F.regexp_extract("t", pattern, 1), F.lit(""))
    moves = F.regexp_extract_all("t", F.lit(r"(?m)^([+-]\d{4}[A-Z]{2})"), 1)
    x = whole.select(
        "path", one(r"(?m)^N\+([^\r\n]*)").alias("black"), one(r"(?m)^N-([^\r\n]*)").alias("white"),
        one(r"(?m)^'black_rate:[^:\r\n]*:([\d.]+)").try_cast("double").alias("black_rate"), one(r"(?m)^'white_rate:[^:\r\n]*:([\d.]+)").try_cast("double").alias("white_rate"),
        moves.alias("moves"), one(r"(?m)^%([A-Z+_-]+)").alias("result"),
    )
    last = F.element_at(F.col("moves"), -1)
    turn = F.when(F.size("moves") == 0, "+").when(F.substring(last, 1, 1) == "+", "-").otherwise("+")
    own, other = F.when(turn == "+", 0).otherwise(1), F.when(turn == "+", 1).otherwise(0)
    lost, won, drawn = ("TORYO", "TIME_UP", "TSUMI", "ILLEGAL_MOVE"), ("KACHI",), ("SENNICHITE", "HIKIWAKE", "JISHOGI")
    winner = F.when(F.col("result").isin(*lost), other).when(F.col("result").isin(*won), own).when(F.col("result").isin(*drawn), 2)
    return x.withColumn("winner", winner)


def comment_value(line: Column) -> Column:
    """The evaluation that a comment names: after its word, ``score cp`` or ``**``, in this order; null without one."""
    one = lambda p: F.nullif(F.regexp_extract(line, p, 1), F.lit("")).try_cast("int")
    return F.coalesce(one(r"評価値\s*([-+]?\d+)"), one(r"(?i)score\s+cp\s+([-+]?\d+)"), one(r"\*\*\s*([-+]?\d+)"))


def csa_evals(rows: DataFrame) -> DataFrame:
    """(path, at, side, value) of CSA lines (path, at, line): a comment's evaluation belongs to the next move, 0 Black or 1 White.

    A value on the move's own line goes before one that waits, and a move uses up what waits.
    """
    side = F.when(F.col("line").rlike(r"^\+\d{4}[A-Z]{2}"), 0).when(F.col("line").rlike(r"^-\d{4}[A-Z]{2}"), 1)
    x = rows.withColumns({"side": side, "value": comment_value(F.col("line"))})
    return pending(x, ["path"], ["at"], F.col("side").isNotNull(), "value").where("value IS NOT NULL").select("path", "at", "side", "value")


def kif_evals(rows: DataFrame) -> DataFrame:
    """(path, at, side, value) of KIF lines (path, at, line): an evaluation belongs to the move before it, by the parity of that move's number."""
    number = F.nullif(F.regexp_extract("line", r"^\s*(\d+)\s+\S", 1), F.lit("")).try_cast("int")
    x = rows.withColumns({"side": F.when(number % 2 == 1, 0).when(number % 2 == 0, 1), "value": comment_value(F.col("line"))})
    return carry_forward(x, ["path"], ["at"], ["side"]).where("value IS NOT NULL AND side IS NOT NULL").select("path", "at", "side", "value")


def settings(text: str) -> dict:
    """A settings file: JSON with comments, trailing commas, names without quotes and strings in single quotes."""
    quoted = r'"(?:[^"\\]|\\.)*"' + r"|'(?:[^'\\]|\\.)*'"

    def one(m: re.Match) -> str:
        token = m[0]
        if token[0] == "'":
            return json.dumps(token[1:-1].replace("\\'", "'"))
        if token[0] == ",":
            return ""
        return token if token[0] == '"' else json.dumps(token)

    bare = re.sub(rf"{quoted}|//[^\n]*|/\*.*?\*/", lambda m: " " if m[0][0] == "/" else m[0], text, flags=re.S)
    return json.loads(re.sub(rf"{quoted}|,(?=\s*[}}\]])|[A-Za-z_$][\w$]*(?=\s*:)", one, bare))


def parameters(spark: SparkSession, path: str) -> DataFrame:
    """(name, type, v, least, most, step, delta, comment, not_used) of parameter files; lines of fewer fields are left out."""
    x = lines(spark, path)
    body, comment = F.split("line", "//", 2)[0], F.coalesce(F.get(F.split("line", "//", 2), F.lit(1)), F.lit(""))
    f = F.transform(F.split(F.replace(body, F.lit("[[NOT USED]]"), F.lit("")), ","), lambda s: F.trim(s))
    unused = F.col("line").contains("[[NOT USED]]")
    number = lambda k, n: F.col("f")[k].try_cast("double").alias(n)
    return x.select("at", f.alias("f"), F.trim(F.replace(comment, F.lit("[[NOT USED]]"), F.lit(""))).alias("comment"), unused.alias("not_used")).where(F.size("f") >= 7).select(
        F.col("f")[0].alias("name"), F.col("f")[1].alias("type"), number(2, "v"), number(3, "least"), number(4, "most"), number(5, "step"), number(6, "delta"), "comment", "not_used"
    )


def position_lines(rows: DataFrame, line: str = "line") -> DataFrame:
    """(command, moves, options) of lines such as ``startpos moves 7g7f, eval_limit=400``; blank and # lines are left out."""
    x = rows.where((F.trim(line) != "") & ~F.trim(line).startswith("#"))
    parts = F.split(F.col(line), r"\s*,\s*")
    command = F.regexp_replace(F.trim(parts[0]), r"\s+", " ")
    moves = F.when(command.contains(" moves "), F.split(F.regexp_extract(command, r" moves (.*)$", 1), " ")).otherwise(F.array().cast("array<string>"))
    pairs = F.transform(F.slice(parts, 2, F.size(parts)), lambda s: F.split(s, r"\s*=\s*"))
    options = F.map_from_entries(F.transform(F.filter(pairs, lambda p: F.size(p) == 2), lambda p: F.struct(p[0], p[1].try_cast("int"))))
    return x.select(command.alias("command"), moves.alias("moves"), options.alias("options"))


def train_log(rows: DataFrame) -> DataFrame:
    """A row per epoch summary of (path, at, line) log lines, with the settings last seen before it.

    A line that names the teacher begins a new stretch, in which the number of positions isn't known yet.
    """
    find = lambda pattern, kind="string": F.nullif(F.regexp_extract("line", pattern, 1), F.lit("")).try_cast(kind)
    x = rows.withColumns({
        "batchsize": find(r"\bbatchsize\s*=\s*(\d+)", "int"), "lr": find(r"\blr\s*=\s*([\d.eE+-]+)", "double"), "val_lambda": find(r"\bval_lambda\s*=\s*([\d.]+)", "double"),
        "teacher": find(r"\bteacher\s*[=:]\s*(\S+)"), "positions": find(r"\bposition(?:_num|s)\s*=\s*(\d+)", "bigint"),
        "epoch": find(r"\bepoch\s*=\s*(\d+)", "int"), "steps": find(r"\bsteps\s*=\s*(\d+)", "bigint"), "loss": find(r"\btrain loss avr\s*=\s*([\d.eE+-]+)", "double"),
    })
    x = carry_forward(x, ["path"], ["at"], ["batchsize", "lr", "val_lambda"])
    new = F.sum(F.when(F.col("teacher").isNotNull(), 1).otherwise(0)).over(Window.partitionBy("path").orderBy("at"))
    x = carry_forward(x.withColumn("part", new), ["path", "part"], ["at"], ["teacher", "positions"])
    return x.where("epoch IS NOT NULL").select("path", "epoch", "steps", "loss", "batchsize", "lr", "val_lambda", "teacher", "positions")


def first_date(text: Column) -> Column:
    """The first valid date in a text, separated or compact: 2025-02-30 is passed over."""
    found = F.regexp_extract_all(text, F.lit(r"(\d{4})[-/.]?(\d{2})[-/.]?(\d{2})"), 0)
    days = F.transform(found, lambda s: F.try_to_timestamp(F.regexp_replace(s, r"[-/.]", ""), F.lit("yyyyMMdd")).cast("date"))
    return F.get(F.filter(days, lambda d: d.isNotNull()), F.lit(0))


#: Encodings in the order in which they are tried.
ENCODINGS = ("utf-8-sig", "utf-8", "cp932", "shift_jis")


def decode(data: bytes) -> str:
    for name in ENCODINGS:
        try:
            return data.decode(name)
        except UnicodeDecodeError:
            continue
    return data.decode("utf-8", "replace")


@F.pandas_udf(T.StringType())
def decoded(data: pd.Series) -> pd.Series:
    """The text of bytes in the first encoding that fits."""
    return data.map(lambda x: decode(bytes(x)), na_action="ignore")


# The signs of files, ranks, pieces and ends of KIF records.
KIF_FILES, KIF_RANKS = "１２３４５６７８９", "一二三四五六七八九"
KIF_PIECES = {"歩": "P", "香": "L", "桂": "N", "銀": "S", "金": "G", "角": "B", "飛": "R"}
#: The first two ranks of the starts with a handicap, by name; the rest is as in an even game, and White moves first.
KIF_STARTS = {
    "香落ち": "lnsgkgsn1/1r5b1", "右香落ち": "1nsgkgsnl/1r5b1", "角落ち": "lnsgkgsnl/1r7", "飛車落ち": "lnsgkgsnl/7b1", "飛香落ち": "lnsgkgsn1/7b1", "二枚落ち": "lnsgkgsnl/9",
    "四枚落ち": "1nsgkgsn1/9", "六枚落ち": "2sgkgs2/9", "八枚落ち": "3gkg3/9", "十枚落ち": "4k4/9",
}
KIF_MOVE = re.compile(r"^\s*\d+\s+(?:([１-９])([一二三四五六七八九])|同[\s　]*)([成と馬龍竜]?[歩香桂銀金角飛玉王杏圭全と馬龍竜]?)(成|打)?(?:\((\d)(\d)\))?")


def kif_moves(text: str) -> list[str]:
    """The moves of a KIF record in USI; lines that are no moves are passed over."""
    out, last = [], ""
    for line in text.splitlines():
        if not (m := KIF_MOVE.match(line)):
            continue
        to = str(KIF_FILES.index(m[1]) + 1) + "abcdefghi"[KIF_RANKS.index(m[2])] if m[1] else last
        if not to or not (m[4] == "打" or m[5]):
            continue
        if m[4] == "打":
            if m[3] not in KIF_PIECES:
                continue
            out.append(f"{KIF_PIECES[m[3]]}*{to}")
        else:
            out.append(m[5] + "abcdefghi"[int(m[6]) - 1] + to + ("+" if m[4] == "成" else ""))
        last = to
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def kif_moves_of(text: pd.Series) -> pd.Series:
    return text.map(kif_moves, na_action="ignore")


def kif_games(spark: SparkSession, path: str) -> DataFrame:
    """(path, black, white, played, start, moves, result, winner) of KIF files in any of the encodings.

    The winner follows from the last line's word and from whose turn it is: 0 Black, 1 White, 2 draw, null unknown. ``start`` is the start position, of a game
    with a handicap too; it is null for a handicap of another name.
    """
    x = spark.read.format("binaryFile").load(path).select("path", decoded("content").alias("t"))
    one = lambda pattern: F.nullif(F.trim(F.regexp_extract("t", pattern, 1)), F.lit(""))
    x = x.select(
        "path", one(r"(?m)^(?:先手|下手)[：:]([^\r\n]*)").alias("black"), one(r"(?m)^(?:後手|上手)[：:]([^\r\n]*)").alias("white"),
        first_date(F.coalesce(one(r"(?m)^開始日時[：:]([^\r\n]*)"), F.lit(""))).alias("played"), kif_moves_of("t").alias("moves"),
        F.coalesce(one(r"(?m)^手合割[：:]([^\r\n]*)"), F.lit("平手")).alias("handicap"),
        one(r"(?m)^\s*\d+\s+(投了|中断|千日手|持将棋|詰み|切れ負け|反則負け|反則勝ち|入玉勝ち)").alias("result"),
    )
    boards = F.create_map(*(F.lit(v) for k, b in KIF_STARTS.items() for v in (k, f"{b}/ppppppppp/9/9/9/PPPPPPPPP/1B5R1/LNSGKGSNL w - 1")))
    even = F.col("handicap").startswith("平手")
    x = x.withColumn("start", F.when(even, STARTPOS).otherwise(F.element_at(boards, F.trim(F.replace("handicap", F.lit("\u3000"), F.lit(" "))))))
    turn = (F.size("moves") + F.when(even, 0).otherwise(1)) % 2
    lost = F.col("result").isin("投了", "詰み", "切れ負け", "反則負け")
    winner = F.when(lost, 1 - turn).when(F.col("result").isin("入玉勝ち", "反則勝ち"), turn).when(F.col("result").isin("千日手", "持将棋"), 2)
    return x.withColumn("winner", winner).drop("handicap")


def size_bytes(text: Column) -> Column:
    """A size such as 512M or 2KiB in bytes; null if it is none."""
    number = F.regexp_extract(text, r"(?i)^\s*(\d+)\s*(?:[KMGT](?:i?B)?|B)?\s*$", 1).try_cast("bigint")
    unit = F.upper(F.regexp_extract(text, r"(?i)^\s*\d+\s*([KMGT])", 1))
    return number * F.when(unit == "K", 1 << 10).when(unit == "M", 1 << 20).when(unit == "G", 1 << 30).when(unit == "T", 1 << 40).otherwise(1)


def option_line(text: Column) -> Column:
    """(name, type, default, least, most) of an engine's option line."""
    one = lambda pattern: F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    return F.struct(
        one(r"\bname\s+(.*?)\s+type\b").alias("name"), one(r"\btype\s+(\S+)").alias("type"), one(r"\bdefault\s+(\S+)").alias("default"),
        one(r"\bmin\s+(\S+)").alias("least"), one(r"\bmax\s+(\S+)").alias("most"),
    )
