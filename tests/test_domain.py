"""Positions, moves, codecs, readers and writers on small files in the domain's formats."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from tessera.functions import codec, register, rules, scalars, sfen
from tessera.operators import books, games, layout, lookups, positions, windows
from tessera.sources import books as book_files
from tessera.sources import archives, html, records, sinks, training

START = sfen.STARTPOS
MID = "lnsgkgsnl/1r5b1/p1ppppppp/1p7/9/9/PPPPPP3/1B5R1/LNSGKGSNL b 2Pp 7"
PROMOTED = "ln1g1k1nl/1r1s3+P1/p1pp1p1pp/4p4/1p7/2P1P4/PP1P1P1PP/1B3S1R1/LN1GKG1NL w BGSsp 34"


def value(spark, column, **literals):
    return spark.range(1).select(column(*(F.lit(v) for v in literals.values()))).first()[0]


@pytest.mark.parametrize("move,flipped", [("7g7f", "3c3d"), ("P*2c", "P*8g"), ("8h2b+", "2b8h+"), ("resign", "resign")])
def test_flip_move(spark, move, flipped):
    assert value(spark, sfen.flip_move, m=move) == flipped and value(spark, sfen.flip_move, m=flipped) == move


@pytest.mark.parametrize("position", [START, MID, PROMOTED])
def test_flip_sfen(spark, position):
    image = value(spark, sfen.flip_sfen, s=position)
    assert value(spark, sfen.flip_sfen, s=image) == position and image.split()[1] != position.split()[1] and image.split()[3] == position.split()[3]


def test_flip_hands(spark):
    assert value(spark, sfen.flip_sfen, s="9/9/9/9/9/9/9/9/9 w P2p").split()[1:] == ["b", "2Pp"]


@pytest.mark.parametrize("kind,text,want", [("mate", "1", 31999), ("mate", "-3", -31997), ("mate", "+", 31999), ("cp", "40000", 30000), ("cp", "-12", -12)])
def test_score(spark, kind, text, want):
    assert value(spark, sfen.score, k=kind, v=text) == want


@pytest.mark.parametrize("old,new", [(99999, 31999), (-99998, -31998), (50000, 32000), (400, 400)])
def test_legacy_eval(spark, old, new):
    assert value(spark, sfen.legacy_eval, v=old) == new


def test_small_functions(spark):
    assert [value(spark, sfen.ply, s=x) for x in (START, "a b c", PROMOTED)] == [1, 0, 34]
    assert value(spark, sfen.trim_ply, s=START) == START[:-2]
    assert [value(spark, sfen.normal_move, m=m) for m in ("None", "", "resign", "7g7f")] == ["none", "none", "none", "7g7f"]
    assert value(spark, sfen.unsigned64, v=-1) == 2**64 - 1 and value(spark, sfen.clamp16, v=-40000) == -32767
    assert round(value(spark, sfen.elo, w=60, l=40), 1) == 70.4
    for path, year in (("x/wcsc5/a", 1994), ("wcsc6", 1996), ("wcsc36", 2026), ("wcso1", 2020), ("wdoor2019", 2019), ("z", None)):
        assert value(spark, games.event_year, p=path) == year
    assert str(value(spark, records.first_date, t="on 2025-02-30 or 20250301")) == "2025-03-01"


@pytest.mark.parametrize("position", [START, MID, PROMOTED, "4k4/9/9/9/9/9/9/9/4K4 b 2R2B4G4S4N4L18P 1"])
def test_pack(position):
    packed = codec.pack(position)
    assert len(packed) == 32 and codec.unpack(packed, int(position.split()[3])) == position


def test_pack_boxed_pieces():
    position = "4k4/9/9/9/9/9/9/9/4K4 b R2p 5"
    assert codec.unpack(codec.pack(position), 5) == position
    with pytest.raises(ValueError):
        codec.pack("4k4/9/9/9/9/9/9/9/4K4 b 3R 1")
    with pytest.raises(ValueError):
        codec.pack("4k4/9/9/9/9/9/9/9/4K5 b - 1")


def test_moves(spark):
    moves = ["7g7f", "8h2b+", "P*5e", "G*1a", "none", "null", "resign", "win", "9i1a"]
    assert [codec.usi(codec.move16(m)) for m in moves] == moves
    frame = spark.createDataFrame([(codec.move16(m),) for m in moves] + [(5 | 5 << 7,)], "m int")
    assert [r[0] for r in frame.select(codec.usi_of(F.col("m"))).collect()] == [*moves, "none"]


DB = (
    book_files.DB_HEADER + "\r\n# NOE:2\r\nsfen a b - 1\r\n7g7f 3c3d 10 3 2\r\n# note\r\n2g2f none 5 3 1\r\n7g7f none 30 4 5\r\n"
    "// x\r\n\r\nsfen c w - 2\r\n3c3d,none,None,1\r\n8c8d none -7\r\n"
)


def test_db_book(spark, tmp_path):
    (tmp_path / "book.db").write_bytes(DB.encode())
    rows = book_files.read_db(spark, str(tmp_path / "book.db")).collect()
    assert [(r.key, r.move, r.value, r.depth, r.move_count) for r in sorted(rows, key=lambda r: (r.key, r.seq))] == [
        ("a b - 1", "7g7f", 10, 3, 2), ("a b - 1", "2g2f", 5, 3, 1), ("a b - 1", "7g7f", 30, 4, 5), ("c w - 2", "3c3d", 0, 1, 0), ("c w - 2", "8c8d", -7, 0, 0)
    ]
    merged = books.merge_duplicates(book_files.read_db(spark, str(tmp_path / "book.db"))).where("move = '7g7f'").first()
    assert (merged.value, merged.depth, merged.move_count, merged.slot) == (30, 4, 7, 0)
    assert book_files.read_db(spark, str(tmp_path / "book.db"), miner=True).where("move = '3c3d'").isEmpty()
    book_files.write_db(book_files.read_db(spark, str(tmp_path / "book.db")), str(tmp_path / "out"))
    text = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    assert text.startswith(book_files.DB_HEADER.encode() + b"\r\nsfen a b - 1\r\n7g7f none 30 4 5\r\n") and text.count(b"sfen ") == 2


def test_db_prelude(spark, tmp_path):
    body = "sfen a b - 1\r\n7g7f none 1 1 1\r\n"
    for k, before in enumerate(("", "\ufeff", "made by hand\r\n8c8d none 9 9 9\r\n", book_files.DB_HEADER + "\n", "\n\n// x\n7g7f none 5 5 5\n")):
        (tmp_path / f"{k}.db").write_text(before + body, newline="")
        assert [(r.key, r.move, r.value) for r in book_files.read_db(spark, str(tmp_path / f"{k}.db")).collect()] == [("a b - 1", "7g7f", 1)]


def test_ybb_book(spark, tmp_path):
    moves = [("7g7f", 10, 3), ("2g2f", -5, 1)]
    data = book_files.encode_ybb([(codec.pack(START), 1, moves), (codec.pack(MID), 7, moves[:1])])
    (tmp_path / "b.ybb").write_bytes(data)
    rows = book_files.read_ybb(spark, str(tmp_path / "b.ybb")).withColumn("sfen", codec.unpack_sfen("packed", "ply")).collect()
    assert {(r.sfen, r.seq, r.move, r.value, r.depth) for r in rows} == {(START, 0, "7g7f", 10, 3), (START, 1, "2g2f", -5, 1), (MID, 0, "7g7f", 10, 3)}
    with pytest.raises(ValueError):
        book_files.encode_ybb([(b"a" * 32, 1, []), (b"a" * 32, 1, [])])
    with pytest.raises(ValueError):
        list(book_files.decode_ybb(data[:40] + b"\0" * 100))


def test_apery(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(book_files.APERY.pack(2**64 - 1, 5, 9, -3) + book_files.APERY.pack(1, 2, 70, 4))
    rows = book_files.read_apery(spark, str(tmp_path / "a.bin")).orderBy("key").collect()
    assert [(int(r.key), r.move16, r["count"], r.score) for r in rows] == [(1, 2, 70, 4), (2**64 - 1, 5, 9, -3)]


def test_fixed_records(spark, tmp_path):
    black, white = codec.pack(START), codec.pack(PROMOTED)
    rows = [(black, -200, 7, 1), (white, 30000, 9, 1), (white, 1, 2, 0)]
    (tmp_path / "x.hcpe").write_bytes(b"".join(struct.pack("<32shHBB", *r, 0) for r in rows))
    hcpe = training.read_hcpe(spark, str(tmp_path / "x.hcpe"))
    assert sorted((bytes(r.hcp), r.eval, r.move16, r.result) for r in hcpe.collect()) == sorted(rows)
    psv = training.hcpe_to_psv(hcpe)
    assert sorted((r.score, r.ply, r.result) for r in psv.collect()) == [(-200, 0, 1), (1, 0, 0), (30000, 0, -1)]
    back = training.psv_to_hcpe(psv)
    assert sorted((bytes(r.hcp), r.eval, r.move16, r.result) for r in back.collect()) == sorted(rows)
    (tmp_path / "x.psv").write_bytes(struct.pack("<32shHHbB", white, -5, 3, 12, -1, 0))
    assert [tuple(r)[1:] for r in training.read_psv(spark, str(tmp_path / "x.psv")).collect()] == [(-5, 3, 12, -1)]


def test_games(spark, tmp_path):
    a, b = codec.move16("7g7f"), codec.move16("3c3d")
    game = training.encode_hcpe3(codec.pack(START), 1, 0, [(a, 10, [(a, 7), (b, 3)]), (b, -10, [])])
    (tmp_path / "x.hcpe3").write_bytes(game * 3)
    rows = training.read_games(spark, str(tmp_path / "x.hcpe3"), "hcpe3").collect()
    assert len(rows) == 3 and [(p["move16"], p["eval"], [tuple(c) for c in p["candidates"]]) for p in rows[0].plies] == [(a, 10, [(a, 7), (b, 3)]), (b, -10, [])]
    with pytest.raises(ValueError):
        list(training.decode_hcpe3(game[:-1]))
    packed = training.encode_pack(None, 1, 2, 4, [(a, 99999), (b, -5)]) + training.encode_pack(codec.pack(MID), 7, 0, 1, [])
    (tmp_path / "x.pack").write_bytes(packed)
    got = training.read_games(spark, str(tmp_path / "x.pack"), "pack")
    assert [(r.ply, r.result, r.reason, [tuple(p) for p in r.plies]) for r in got.orderBy("ply").collect()] == [(1, 2, 4, [(a, 32000), (b, -5)]), (7, 0, 1, [])]
    assert [(r.move, r.ponder) for r in training.game_moves(got).orderBy("at").collect()] == [("7g7f", "3c3d"), ("3c3d", None)]


CSA = "V2.2\nN+alice\nN-bob\n'black_rate:alice:2500.5\n'white_rate:bob:1900\nPI\n+\n+7776FU\nT1\n-3334FU\n%TORYO\n"


def test_csa(spark, tmp_path):
    (tmp_path / "g.csa").write_text(CSA)
    r = records.csa_games(spark, str(tmp_path)).first()
    assert (r.black, r.white, r.black_rate, r.white_rate, r.moves, r.result, r.winner) == ("alice", "bob", 2500.5, 1900.0, ["+7776FU", "-3334FU"], "TORYO", 1)


def test_text_records(spark, tmp_path):
    (tmp_path / "params.txt").write_text("a, int, 5, 0, 10, 1, 0.5 // first\nb, int, 1, 0, 2, 1, 1 // x [[NOT USED]]\nshort, 1\n")
    rows = records.parameters(spark, str(tmp_path / "params.txt")).orderBy("name").collect()
    assert [(r.name, r.v, r.most, r.comment, r.not_used) for r in rows] == [("a", 5.0, 10.0, "first", False), ("b", 1.0, 2.0, "x", True)]
    (tmp_path / "train.log").write_text("batchsize=100\nlr=0.5\nteacher=t1\npositions=9\nepoch = 1, steps = 10, train loss avr = 0.25\nteacher=t2\nlr=0.1\nepoch = 2, steps = 20, train loss avr = 0.2\n")
    rows = records.train_log(records.lines(spark, str(tmp_path / "train.log"))).orderBy("epoch").collect()
    assert [tuple(r)[1:] for r in rows] == [(1, 10, 0.25, 100, 0.5, None, "t1", 9), (2, 20, 0.2, 100, 0.1, None, "t2", None)]
    (tmp_path / "pos.txt").write_text("# c\nstartpos moves 7g7f 3c3d, eval_limit=400\n\nstartpos\n")
    rows = records.position_lines(records.lines(spark, str(tmp_path / "pos.txt"))).collect()
    assert [(r.moves, r.options) for r in rows] == [(["7g7f", "3c3d"], {"eval_limit": 400}), ([], {})]


def test_rating_table(spark):
    page = '<table class="x player-rating"><tr><th>n</th></tr><tr><td><a>ann</a></td><td>2100.5</td></tr><tr><td>z</td><td>-</td></tr></table>'
    assert [tuple(r) for r in html.rating_table(spark.createDataFrame([(page,)], "html string")).collect()] == [("ann", 2100.5)]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_book_rules(spark):
    schema = "key string, moves array<struct<slot:int,move:string,value:int,depth:int,move_count:bigint>>"
    item = lambda d, n: [(k, "m", 0, d, 1) for k in range(n)]
    left = frame(spark, [("a", item(3, 1)), ("b", item(5, 2)), ("c", []), ("d", item(1, 1))], schema)
    right = frame(spark, [("a", item(5, 1)), ("b", item(5, 2)), ("c", item(1, 1)), ("e", item(1, 1))], schema)
    assert {r.key: r.chosen for r in books.merge_books(left, right).collect()} == {"a": "right", "b": "left", "c": "right", "d": "left", "e": "right"}
    ties = frame(spark, [("k", m, v, s) for s, (m, v) in enumerate([("a", 50), ("b", 50), ("c", 50), ("d", 49)])], "key string, move string, value int, seq int")
    assert [r.value for r in books.break_ties(ties).orderBy("rank").collect()] == [50, 49, 49, 49]
    image = spark.range(1).select(sfen.flip_sfen(F.lit(MID))).first()[0]
    book = frame(spark, [(MID, [(0, "7g7f", 0, 0, 0)])], schema)
    found = books.flip_lookup(frame(spark, [(MID,), (image,), (START,)], "key string"), book).collect()
    assert {r.key: (r.found, r.flipped, r.moves and r.moves[0]["move"]) for r in found} == {MID: (True, False, "7g7f"), image: (True, True, "3c3d"), START: (False, False, None)}
    both = frame(spark, [(MID, "7g7f", None, 0, 0), (image, "3c3d", 5, 3, 1)], "key string, move string, value int, depth int, seq int")
    assert [tuple(r) for r in books.merge_flipped(both).collect()] == [(MID, "7g7f", 5, 3, 0)]
    with pytest.raises(Exception, match="duplicate key"):
        books.assert_unique(ties, ["key"]).collect()


def test_layout_rules(spark):
    sizes = frame(spark, [("g", k, s) for k, s in enumerate([5, 4, 3, 9, 1])], "g string, k int, size int")
    assert [r.output for r in layout.greedy_fit(sizes, "g", ["k"], "size", 8).orderBy("k").collect()] == [0, 1, 1, 2, 3]
    rows = frame(spark, [(s, k) for s, n in (("A", 3), ("B", 2)) for k in range(n)], "s string, k int")
    order = layout.weighted_round_robin(rows, "s", ["k"], F.when(F.col("s") == "A", 3).otherwise(2)).orderBy("position").collect()
    assert "".join(r.s for r in order) == "ABABA"
    for n, files, ceil, even in ((10, 4, [3, 3, 3, 1], [3, 3, 2, 2]), (5, 4, [2, 2, 1], [2, 1, 1, 1])):
        x = spark.range(n)
        for split, want in ((layout.split_ceil, ceil), (layout.split_even, even)):
            assert [r["count"] for r in split(x, ["id"], files).groupBy("file_no").count().orderBy("file_no").collect()] == want


def test_window_rules(spark):
    scores = frame(spark, [("k", 0, 100), ("k", 1, 0)], "key string, seq int, score int")
    assert [r.visits for r in windows.apportion(scores, "key", "score", ["seq"], 10, 100.0).orderBy("seq").collect()] == [7, 3]
    assert [r.visits for r in windows.apportion(scores, "key", "score", ["seq"], 10, 0).orderBy("seq").collect()] == [10, 0]
    for values, want in (([60, 10, -1], True), ([40, -10], False), ([-70, 5], True)):
        e = frame(spark, [("g", 0, k, v, 0) for k, v in enumerate(values)], "game string, side int, ply int, value int, tie int")
        assert games.reversals(e, 50).isEmpty() != want
    steps = frame(spark, [("p", 5.0, 0.0, 6.0, k, s, 1.0, 1.0) for k, s in enumerate([1.0, 1.0, -1.0])], "name string, v double, least double, most double, seq int, shift double, step double, delta double")
    assert games.gradient(steps, 1.0).first().v == 5.0
    plies = frame(spark, [(0, "a"), (1, "a"), (2, "b")], "ply int, key string")
    own, other = frame(spark, [("a", 1), ("b", 2)], "key string, m int"), frame(spark, [("a", 9)], "key string, m int")
    assert [(r.ply, r.m) for r in lookups.duel_lookup(plies, own, other).orderBy("ply").collect()] == [(0, 1), (1, 9), (2, 2)]


def test_dates(spark):
    x = frame(spark, [("2025-01-01 00:00:00",), ("2025-01-01 00:00:01",), ("2025-01-02 00:00:00",), (None,)], "t string").withColumn("at", F.col("t").cast("timestamp_ntz"))
    keep = games.played_between(F.col("at"), F.lit(None).cast("date"), "2025-01-01", "2025-01-01")
    assert [r.k for r in x.select(keep.alias("k")).collect()] == [False, True, True, False]


def perft(position, depth):
    return 1 if not depth else sum(perft(position.after(m), depth - 1) for m in position.legal())


@pytest.mark.parametrize("depth,want", [(1, 30), (2, 900), (3, 25470)])
def test_legal_moves(depth, want):
    assert perft(rules.Position.read(START), depth) == want


def test_rules():
    drop_mate = rules.Position.read("8k/7GS/9/7L1/9/9/9/9/4K4 b P 1")
    assert "P*1b" not in drop_mate.legal() and not any(m.startswith("P*") and m[3] == "a" for m in drop_mate.legal())
    two = rules.Position.read("4k4/9/9/9/9/9/4P4/9/4K4 b P 1")
    assert not any(m.startswith("P*5") for m in two.legal()) and "P*4b" in two.legal()
    last = rules.Position.read("4k4/P8/9/9/9/9/9/9/4K4 b - 1")
    assert "9b9a+" in last.legal() and "9b9a" not in last.legal()
    assert [m for _, m in rules.replay("startpos moves 7g7f 3c3d 8h2b+ 9a9a")] == ["7g7f", "3c3d", "8h2b+", ""]


def test_legality_by_piece(monkeypatch):
    rand, at = random.Random(5), rules.Position.read(START)
    for _ in range(150):
        moves = at.legal()
        for side, other in ("bw", "wb"):
            king = at.board.index("K" if side == "b" else "k")
            assert at.checked(side) == any(king in at.targets(k) for k, p in enumerate(at.board) if at.own(p, other))
        texts = [*at.candidates(), "", "7", "*", "P*", "p*5e", "K*5e", "resign", "7g7f++", "5e5e"]
        assert [m for m in texts if at.is_legal(m)] == moves
        at = at.after(rand.choice(moves))
    monkeypatch.setattr(rules.Position, "candidates", None)  # a move is judged without the other pieces' moves
    assert [m for _, m in rules.replay("startpos moves 7g7f 3c3d 8h2b+ 3a2b B*5e resign")] == ["7g7f", "3c3d", "8h2b+", "3a2b", "B*5e", ""]


def test_shared_moves_are_played_once(spark, monkeypatch):
    heads = ["startpos", "sfen " + START, START[:-1] + "9", "nonsense", "4k4/9/9/9/9/9/4P4/9/4K4 b P 1"]
    moves = ["7g7f 3c3d 2g2f", "7g7f 3c3d 8h2b+ 3a2b B*4e", "7g7f 3c3d 9a9a 2g2f", "7g7f 3c3d 9a9a", "7g7f 3c3d 9a9b", "resign 7g7f", "7g7f", "P*5c 5a5b 5g5f 5b5c 5f5e", ""]
    lines = [f"{h} moves {m}" for h in heads for m in moves] * 3 + ["", "startpos"]
    for limit in (0, 1, 2, 10):
        want = {}
        for line in lines:
            if not line.startswith("nonsense"):
                steps = [s for s in rules.replay(line) if s[1]][: limit + 1]
                for (key, move), (_, ponder) in zip(steps, steps[1:]):
                    x = key.rsplit(" ", 1)[0], move
                    least, n = want.get(x, (ponder, 0))
                    want[x] = min(least, ponder), n + 1
        book = positions.games_to_book(frame(spark, [*((x,) for x in lines), (None,)], "position string"), limit).collect()
        assert {(r.key, r.move): (r.ponder, r.move_count) for r in book} == want and len(book) == len(want)
    made, after = [], rules.Position.after
    monkeypatch.setattr(rules.Position, "after", lambda self, move: made.append(move) or after(self, move))
    assert sum(n for *_, n in rules.book_moves([("startpos moves 7g7f 3c3d 2g2f 8c8d " + "2f2e " * (k % 2) + "x" * k, 5) for k in range(1000)], 3)) == 15000
    assert made == ["7g7f", "3c3d", "2g2f", "8c8d"]


def test_rules_operators(spark):
    games_ = frame(spark, [("startpos moves 7g7f 3c3d 2g2f",), ("startpos moves 7g7f 8c8d",), ("nonsense",)], "position string")
    book = positions.games_to_book(games_, 10)
    base = " ".join(START.split()[:3])
    assert {(r.move, r.ponder, r.move_count) for r in book.where(F.col("key") == base).collect()} == {("7g7f", "3c3d", 2)}
    labels = {r.key: r.level for r in positions.ply_labels(book, START, 4).collect()}
    assert sorted(labels.values()) == [0, 1]
    assert {r.level for r in positions.budgeted_walk(book, START, 0, 2).collect()} == {0, 1}
    assert positions.leaf_children(book).where(F.col("key") == base).count() == 29
    assert value(spark, positions.pieces, s="4k4/9/9/9/9/9/9/9/4K4 b 2Pp 1") == 5 and value(spark, positions.pieces, s=START) == 40
    rows = [("k", "a", 10, True, False), ("k", "a", 10, True, False), ("k", "b", 9, True, False), ("k", "c", -50, True, True), ("k", "d", 99, False, False), ("k", "e", -40, True, False)]
    kept = positions.prune_candidates(frame(spark, rows, "k string, move string, score int, legal boolean, selected boolean"), "k", 3, 30)
    assert sorted(r.move for r in kept.collect()) == ["a", "b", "c"]
    starts = frame(spark, [("a", 32, 20, 0), ("a", 32, 500, 1), ("b", 32, 51, 0), ("c", 31, 0, 0)], "key string, ply int, value int, seq int")
    assert [r.key for r in positions.balanced_starts(starts).collect()] == ["a"]


KIF = "手合割：平手\n先手：甲\n後手：乙\n開始日時：2024/05/06 10:00:00\n手数----指手---------消費時間--\n   1 ７六歩(77)   ( 0:01/00:00:01)\n*#評価値 30\n   2 ３四歩(33)\n   3 ２二角成(88)\n   4 同　銀(31)\n   5 角打\n   5 ５五角打\n   6 投了\n"


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "cp932"])
def test_kif(spark, tmp_path, encoding):
    (tmp_path / "g.kif").write_bytes(KIF.encode(encoding))
    r = records.kif_games(spark, str(tmp_path)).first()
    assert (r.black, r.white, str(r.played), r.winner) == ("甲", "乙", "2024-05-06", 0)
    assert r.moves == ["7g7f", "3c3d", "8h2b+", "3a2b", "B*5e"]


def test_sizes(spark):
    assert [value(spark, records.size_bytes, s=x) for x in ("512M", "1g", "10", "2KiB", "x")] == [512 << 20, 1 << 30, 10, 2048, None]
    row = spark.range(1).select(records.option_line(F.lit("option name Hash type spin default 16 min 1 max 1024")).alias("o")).first().o
    assert (row.name, row.type, row.default, row.least, row.most) == ("Hash", "spin", "16", "1", "1024")


def test_ybb_checks():
    moves = [("7g7f", 10, 3)]
    keys = sorted(bytes([k % 7]) + bytes([k]) + b"k" * 30 for k in range(40))
    data = book_files.encode_ybb([(k, 1, moves * (i % 4)) for i, k in enumerate(keys)], depths=False)
    found = [r for part in book_files.decode_ybb(data, 7) for r in part.itertuples(index=False)]
    assert [(r.packed, r.seq, r.value, r.depth) for r in found] == [(k, j, 10, 0) for i, k in enumerate(keys) for j in range(i % 4)]
    swapped = bytearray(data)
    a, b = (slice(32 + 44 * k, 32 + 44 * k + 32) for k in (3, 4))
    swapped[a], swapped[b] = data[b], data[a]
    for broken in (bytes(swapped), data[:-1], data[:200], b"x" + data[1:], data[:24] + b"\2" + data[25:]):
        with pytest.raises(ValueError):
            list(book_files.decode_ybb(broken))


def test_sinks(spark, tmp_path):
    sinks.write_file(spark, str(tmp_path / "f"), [b"ab", b"", b"c" * 3_000_000])
    assert (tmp_path / "f").read_bytes() == b"ab" + b"c" * 3_000_000
    with pytest.raises(FileExistsError):
        sinks.write_file(spark, str(tmp_path / "f"), [b"x"])
    sinks.write_file(spark, str(tmp_path / "f"), [b"x"], force=True)
    assert (tmp_path / "f").read_bytes() == b"x" and not (tmp_path / "f.tmp").exists()
    rows = spark.createDataFrame([(b"k" * 32, 1, 0, "7g7f", 1, 1), (b"k" * 32, 2, 0, "2g2f", 1, 1)], "packed binary, ply int, seq int, move string, value int, depth int")
    with pytest.raises(ValueError):
        sinks.write_ybb(rows, str(tmp_path / "b.ybb"))
    assert [spark.range(1).select(sinks.bits(F.lit(v), n)).first()[0] for v, n in ((-2, 2), (258, 4), (65535, 2))] == [b"\xfe\xff", b"\2\1\0\0", b"\xff\xff"]


def test_scalars(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(scalars.value_score(F.lit(0.5), 600.0)) == 0 and one(scalars.value_score(F.lit(1.0), 600.0)) == 30000 and one(scalars.value_score(F.lit(0.0), 600.0)) == -30000
    assert one(scalars.scaled_nodes(F.lit(3), F.lit(0.5))) == 2 and one(scalars.scaled_nodes(F.lit(3), F.lit(0.0))) == 1
    assert [one(scalars.leading_number(F.lit(t), 5)) for t in ("", "x", "-12a", "+7", "0012")] == [5, 0, -12, 7, 12]
    assert one(scalars.replace_names(F.lit("foo_1 foo_10 xfoo_1 foo_1"), {"foo_1": "9"})) == "9 foo_10 xfoo_1 9" and one(scalars.replace_names(F.lit("a"), {})) == "a"
    assert one(scalars.safe_part(F.lit("a<b>:c\x7f"))) == "a_b__c_" and one(scalars.safe_part(F.lit(".."))) == ".."
    assert [str(one(scalars.bound_day(F.lit(t), True))) for t in ("2024", "2024/2/9", "2024-02-30", "x")] == ["2024-12-31", "2024-02-09", "None", "None"]
    assert one(scalars.decay_rate(F.lit(0.01), F.lit(0.0001), F.lit(2))) == pytest.approx(0.1)


def test_settings():
    text = """// a
    {engines: [{path: 'a//b', "n": 1, /* x, */ 'it\\'s': true,},], limit: null, "url": "http://x/{a: 1,}",}"""
    assert records.settings(text) == {"engines": [{"path": "a//b", "n": 1, "it's": True}], "limit": None, "url": "http://x/{a: 1,}"}


def test_archives(spark, tmp_path):
    import zipfile

    for name, member in (("wdoor2019.zip", "a/b.csa"), ("other.zip", "c.csa")):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            z.writestr(member, name)
    found = {(r.member, bytes(r.content).decode()) for r in archives.members(spark, str(tmp_path)).collect()}
    assert found == {("a/b.csa", "wdoor2019.zip"), ("c.csa", "other.zip")}
    assert [r.member for r in archives.members(spark, str(tmp_path), (2019, 2019)).collect()] == ["a/b.csa"]
    assert [archives.safe_member(x) for x in ("a/b", "../a", "/a", "a/../../b", "C:/x", "a..b")] == [True, False, False, False, False, True]


def test_broadcast_bound(spark):
    from tessera.plans import physical

    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    wide = spark.range(100).selectExpr("id", "repeat('x', 1000) AS t")
    assert hinted(physical.small(wide)) and not hinted(physical.small(wide, rows=50)) and not hinted(physical.small(wide, most=50_000))


def test_registered(spark):
    register.register(spark)
    row = spark.sql(f"""SELECT flip_move('7g7f') AS a, flip_move('P*2c') AS b, flip_move('resign') AS c, trim_ply('{START}') AS d, held_eval(-40000) AS e,
    unpack_sfen(pack_sfen('{MID}'), 7) AS f, size(successors('{START}')) AS g, size(replay('startpos moves 7g7f 3c3d')) AS h""").first()
    assert tuple(row) == ("3c3d", "P*8g", "resign", START[:-2], -32767, MID, 30, 3)
    found = spark.sql("SELECT p.ply, p.prefix FROM (SELECT array('7g7f', '3c3d') AS m) t, LATERAL prefixes(t.m) p ORDER BY p.ply").collect()
    assert [(r.ply, list(r.prefix)) for r in found] == [(0, []), (1, ["7g7f"]), (2, ["7g7f", "3c3d"])]


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "cp932"])
def test_csa_encodings(spark, tmp_path, encoding):
    (tmp_path / "x.csa").write_bytes("N+先手\nN-後手\n+7776FU\n%TORYO\n".encode(encoding))
    row = records.csa_games(spark, str(tmp_path), any_encoding=True).first()
    assert (row.black, row.white, row.winner) == ("先手", "後手", 0)
