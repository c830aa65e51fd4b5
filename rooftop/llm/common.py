"""Helpers that the operators share: reading tables, scratch tables in the shared folder, joins that survive hot keys."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rooftop import session
from rooftop.llm import words
from rooftop.session import scratch_path  # noqa: F401  the operators' path for files of their own

#: A key with over 1/HOT_SHARE of all rows is hot; fewer than HOT_SHARE keys can be, so a table of them may be broadcast.
HOT_SHARE = 1000
#: A table of at most so many narrow rows, counted before, is broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000
#: The six ASCII white-space bytes that the contracts name.
BLANKS = r"[\x20\x09-\x0D]"


#: Rows of an Arrow batch at most: texts are long, and a batch is held by the JVM and by the worker, with what it makes of it.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches for operators that hand whole texts or shingle sets to Python workers."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_tables: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """session.written, listed for release."""
    out = session.written(df, name)
    _tables.extend(out.scratch)
    return out


def mark() -> int:
    """A point in the list of scratch tables, for release."""
    return len(_tables)


def release(spark: SparkSession, since: int, *keep: DataFrame) -> None:
    """Removes the scratch tables written since a mark, but for those of the frames to keep."""
    kept = {at for df in keep for at in getattr(df, "scratch", [])}
    for at in [at for at in _tables[since:] if at not in kept]:
        _tables.remove(at)
        session.remove(spark, at)


def hot_left_join(rows: DataFrame, facts: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """rows left join facts (unique by keys), where facts.weight is the number of rows that carry the key.

    Keys with over total / HOT_SHARE rows are fewer than HOT_SHARE: they are broadcast, and their rows are not
    shuffled. All others go through an ordinary join, in which no key is large.
    """
    hot = facts.where(F.col(weight) * HOT_SHARE > F.lit(total))
    cold = facts.where(~(F.col(weight) * HOT_SHARE > F.lit(total)))
    near = rows.join(F.broadcast(hot), keys)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys, "left")
    return near.unionByName(rest)


def content(text_col: str = "text") -> Column:
    """128 bits that stand for a text among the rows of one id; null is a content of its own."""
    return F.when(F.col(text_col).isNull(), F.lit(b"")).otherwise(F.unhex(F.md5(F.encode(F.col(text_col), "UTF-8"))))


def keep_decided(docs: DataFrame, decided: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of docs, their columns as they are, by decided: doc_id, content, kept, a row for each row that is decided on.

    A row whose id and content aren't listed stays; a listed one that isn't kept goes. Of kept rows that are alike in
    id and content one stays. Ids may be null or repeat: the decision is by row. Only what changes something is
    joined: the list is broadcast if its count allows, else texts are shuffled once.
    """
    listed = decided.groupBy(F.col("doc_id").alias("__id"), F.col("content").alias("__content")).agg(
        F.max("kept").alias("__kept"),
        (F.count(F.lit(1)) > 1).alias("__many"),
    )
    listed = written(listed.where(~F.col("__kept") | F.col("__many")), "decided")
    side = F.broadcast(listed) if listed.count() <= BROADCAST_ROWS else listed
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
        F.col(id_col).cast("long").alias("__key"),
        content(text_col).alias("__body"),
    )
    rows = rows.join(side, F.col("__key").eqNullSafe(F.col("__id")) & (F.col("__body") == F.col("__content")), "left")
    many = listed.where(F.col("__kept")).limit(1).count()
    alone = rows.where(F.col("__kept").isNull())
    if many:
        alone = alone.unionByName(rows.where(F.col("__kept")).dropDuplicates(["__key", "__body"]))
    out = alone.select("__row.*")
    out.scratch = listed.scratch
    return out


def tidy(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A worker's function that gives freed memory back to the system when its task ends: workers live from task to task."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    words.forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def then_give_back(work: Callable[..., pa.Table], *tables: pa.Table) -> pa.Table:
    """What work makes of a group's tables; freed memory goes back to the system."""
    out = work(*tables)
    give_back()
    return out


def bucketed_offsets(rows: DataFrame, group: list[str], bucket: str, weight: Column) -> DataFrame:
    """For each group and bucket: the sum of weight in the group's earlier buckets."""
    sums = rows.groupBy(*group, bucket).agg(F.sum(weight).alias("own"))
    before = F.sum("own").over(Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1))
    return sums.select(*group, bucket, F.coalesce(before, F.lit(0)).cast("long").alias("before"))


def placed(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """Adds 0, 1, 2... in the order of the columns by, ranges of which are numbered in parallel; no row's place is shared."""
    dealt = written(df.repartitionByRange(*by).withColumn("__p", F.spark_partition_id()), "ranges")
    number = F.row_number().over(Window.partitionBy("__p").orderBy(*by))
    offsets = bucketed_offsets(dealt, [], "__p", F.lit(1))  # a row for each partition
    return dealt.join(F.broadcast(offsets), "__p").withColumn(name, (F.col("before") + number - 1).cast("long")).drop("__p", "before")
