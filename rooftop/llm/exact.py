"""Exact deduplication: 128-bit content hash, byte comparison inside groups, smallest stable id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftop.llm import common


def normalised(text: str = "text"):
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), common.BLANKS + "+", "")


def _decided(docs: DataFrame, id_col: str, text_col: str, digest: Column) -> DataFrame:
    """doc_id, n, body, sha of every row, and size, keep and body_kept of its group if it has more rows than one."""
    norm = normalised(text_col)
    hashed = docs.select(
        F.col(id_col).alias("doc_id"),
        norm.alias("norm"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("n"),
        digest.alias("body"),
    )
    hashed = hashed.withColumn("h", F.unhex(F.md5("norm")))
    rows = common.written(hashed.select("doc_id", "n", "body", "h", F.unhex(F.sha2("norm", 256)).alias("sha")), "exact")
    total = rows.count()
    repeated = common.written(rows.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h"), "repeated")
    side = F.broadcast(repeated) if repeated.count() <= common.BROADCAST_ROWS else repeated
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id", "body"))
    classes = hashed.join(side, "h", "left_semi").groupBy("h", "norm").agg(F.count(F.lit(1)).alias("size"), best.alias("best"))
    classes = classes.select(
        "h",
        F.unhex(F.sha2("norm", 256)).alias("sha"),
        "size",
        F.col("best.doc_id").alias("keep"),
        F.col("best.body").alias("body_kept"),
    )
    return common.hot_left_join(rows, common.written(classes, "classes"), ["h", "sha"], "size", total)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups documents whose texts are identical without ASCII white space.

    Only hashes, ids and lengths of all rows are written and shuffled. Texts move for hashes that at least two rows
    carry, and copies collapse before that shuffle because the bytes themselves are the grouping key: two texts that
    share a hash but differ get groups of their own. The row with the most code points stays, then the one with
    the smallest id.

    Null texts count as empty; an empty table gives an empty result; columns other than the id and the text are
    ignored. Rows that repeat an id are members each; kept tells whether a row has its group's keep_id, so rows of
    that id are all marked. A null id loses every tie. Returns id, keep_id, group_size, kept, text_sha256.
    """
    out = _decided(docs, id_col, text_col, F.lit(None).cast("binary"))
    keep = F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep"))
    return out.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(common.table(spark, sf_dir, "documents"))


OP8_SQL = r"""
with t as (select doc_id, coalesce(text, '') as raw, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm from documents),
g as (select norm, count(*) as group_size, arg_min(doc_id, (-length(raw), doc_id)) as keep_id from t group by norm)
select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, sha256(t.norm) as text_sha256 from t join g using (norm)
"""


def stage_exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, with its columns as they are.

    The row that exact_duplicates names stays; of rows that share its id the longest, then the one with the least
    digest of its text; of rows alike in both one. Null and empty texts and texts of white space are one group.
    """
    mark = common.mark()
    rows = _decided(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id", "text", common.content()).where("size is not null")
    kept = F.col("doc_id").eqNullSafe(F.col("keep")) & (F.col("body") == F.col("body_kept"))
    out = common.keep_decided(docs, rows.select("doc_id", F.col("body").alias("content"), kept.alias("kept")))
    common.release(spark, mark, out)
    return out
