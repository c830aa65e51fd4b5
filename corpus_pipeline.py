"""A corpus pipeline of five stages over documents; each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rooftop.llm import bpe, common, exact, langid, mix, near

STAGES = [
    ("language_id", langid.stage_langid),
    ("exact_dedup", exact.stage_exact_dedup),
    ("near_dedup", near.stage_near_dedup),
    ("mix_sources", mix.stage_mix),
    ("encode_bpe", bpe.stage_bpe),
]

#: A learned classifier and pseudorandom draws aren't SQL: tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; what a stage returns is written as Parquet and read again by the next."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
