"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from tessera.llm import decontaminate, html, mixing, quality, secrets, sharding, simhash, substrings, suffixes, urls
from tessera.llm.common import table
from tessera.llm.pipeline import run


def op1_extract(spark, sf_dir):
    return html.extract_table(table(spark, sf_dir, "pages"))


def op2_decontaminate(spark, sf_dir):
    return decontaminate.find_member_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_mix(spark, sf_dir):
    return mixing.mix_table(table(spark, sf_dir, "documents"))


def op4_shard(spark, sf_dir):
    return sharding.shard_table(table(spark, sf_dir, "documents"))


def op5_quality(spark, sf_dir):
    return quality.quality_table(table(spark, sf_dir, "documents"))


def op6_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_urls(spark, sf_dir):
    return urls.url_table(table(spark, sf_dir, "pages"))


def op8_passages(spark, sf_dir):
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"))


def op9_substrings(spark, sf_dir):
    return substrings.deduplicate(table(spark, sf_dir, "documents"))


def op10_secrets(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    return run(spark, sf_dir)


def queries():
    found = (op1_extract, op2_decontaminate, op3_mix, op4_shard, op5_quality, op6_simhash, op7_urls, op8_passages, op9_substrings, op10_secrets, pipeline)
    return {f.__name__: f for f in found}


def oracle_sql():
    return {"op2_decontaminate": decontaminate.ORACLE, "op5_quality": quality.ORACLE, "op7_urls": urls.ORACLE, "op8_passages": suffixes.ORACLE, "op9_substrings": substrings.ORACLE}
