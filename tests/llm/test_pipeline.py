"""The pipeline's stages in order, each held against what its operator decides or against brute force, and on rows that are hard to handle."""

from collections import Counter

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from tessera.llm import decontaminate, quality

SF = "/root/testdata/sf0.001"
VOCABULARY = [f"w{k}" for k in range(200)]


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(VOCABULARY, n))


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def alike(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / max(1, len(x | y))


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(out := str(tmp_path / name))
        after = spark.read.parquet(out)
        if k < 4:
            assert after.columns == columns
        if k == 0:
            kept = {r.doc_id for r in quality.quality_table(docs).where("kept").collect()}
            assert sorted(r.doc_id for r in after.collect()) == sorted(kept)
        if k == 1:
            rows = {r.doc_id: r.text for r in docs.collect()}
            left = {r.doc_id for r in after.collect()}
            pairs = {(a, b): alike(rows[a], rows[b]) for a in rows for b in rows if a < b and shingles(rows[a]) & shingles(rows[b])}
            close = [p for p, j in pairs.items() if j >= 0.8]
            assert close and sum(not set(p) <= left for p in close) >= 0.9 * len(close)
            assert all(b in left or any(j >= 0.5 for (x, y), j in pairs.items() if b in (x, y)) for b in rows)
        if k == 2:
            leaks = {r.doc_id for r in decontaminate.find_leaks(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            assert {r.doc_id for r in after.collect()} == {r.doc_id for r in docs.collect()} - leaks
        if k == 3:
            assert after.groupBy("doc_id").count().where("count > 3").isEmpty()
        if k == 4:
            assert after.count() == docs.count() and after.agg(F.countDistinct("shard")).first()[0] <= 40
        docs = after
    assert corpus_pipeline.run(spark, SF).count() == docs.count()


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard int, x_u string, s_row string, q_kept string, d_leaked string, item_id int"


def hard_rows():
    texts = [prose(120, k) for k in range(30)]
    rows = [(k, t, "en", ("a", None, "é")[k % 3], len(t), k, "x", "s", "q", "d", k) for k, t in enumerate(texts)]
    rows += [rows[0], rows[0], (7, texts[9], None, None, None, *[None] * 6), (None, texts[3], "en", "a", 1, *[None] * 6), (None, None, None, None, None, *[None] * 6)]
    return rows + [(40, "", "en", "a", 0, *[None] * 6), (41, " \n", "en", "a", 2, *[None] * 6), (42, prose(60_000, 99), "en", "a", 1, *[None] * 6)]


def test_stages_on_hard_rows(spark):
    rows = hard_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    stages = dict(corpus_pipeline.STAGES)
    by_text = Counter(r[1] for r in rows)
    kept = stages["quality_rules"](spark, docs, SF)
    assert kept.columns == docs.columns
    found = Counter(tuple(r) for r in kept.collect())
    assert not any(len((r[1] or "").split()) < 50 for r in found) and found == Counter(r for r in rows if r in found)
    unique = stages["near_dedup"](spark, docs, SF)
    assert unique.columns == docs.columns
    once = unique.collect()
    assert Counter(r.text or "" for r in once if (r.text or "").split()) == Counter(t for t in by_text if (t or "").split())
    assert len([r for r in once if not (r.text or "").split()]) == 1
    assert {r.doc_id for r in once if r.text == rows[9][1]} == {7} and {r.doc_id for r in once if r.text == rows[3][1]} == {3}
    clean = stages["benchmark_decontamination"](spark, docs, SF)
    assert clean.columns == docs.columns and Counter(tuple(r) for r in clean.collect()) == Counter(rows)
    mixed = stages["source_mixing"](spark, docs, SF)
    assert mixed.columns == docs.columns
    drawn = Counter(tuple(r) for r in mixed.collect())
    assert set(drawn) <= set(rows) and all(n <= 3 * rows.count(r) for r, n in drawn.items())
    sharded = stages["byte_sharding"](spark, docs, SF).collect()
    assert Counter(r.doc_id for r in sharded) == Counter(r[0] for r in rows)


def test_stages_on_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        assert out.collect() == [] and (k == 4 or out.columns == docs.columns)
