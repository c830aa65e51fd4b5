"""K-d tree sharding: split at distributed weighted medians along the widest metadata dimension."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rooftop.llm import common

SHARDS = 16
#: Bins of one refinement round, and the share of a leaf's bytes that the bin at the cut may hold in the end.
BINS, NEAR = 1024, 0.0005
#: Copies of one text with over this share of a shard's bytes may be parted where a cut falls among them.
GROUP_SHARE = 1 / 64
#: Bits of a key below the value: the text's, which order texts alike in value, and the row's within a large group.
TEXT_BITS, ROW_BITS = 20, 11

_SCALES = (2.0**24, 2.0**26, 2.0**28)


def _dimensions(text: Column) -> list[Column]:
    """log2 of the size, bytes a code point, blanks a code point: each up to a few tens."""
    n, chars = F.octet_length(text).cast("double"), F.greatest(F.length(text), F.lit(1)).cast("double")
    blanks = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    return [F.log2(n + 1), n / chars, blanks / chars]


def _located(docs: DataFrame, id_col: str, text_col: str, leaves: int) -> DataFrame:
    """doc_id, size, crc and one key a dimension: the quantised value, bits of the text's hash, bits of the row's.

    Copies of a text are one key, so that no cut parts them, unless they are too large for near equal shards: then
    they are a run of keys, which only a cut that falls within it parts.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    values = [F.floor(d * s).cast("long").alias(f"q{i}") for i, (d, s) in enumerate(zip(_dimensions(text), _SCALES, strict=True))]
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"),
        F.unhex(F.md5(text)).alias("digest"),
        *values,
    )
    base = common.written(base, "located")
    total = int(base.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0])
    most = max(1, int(total / leaves * GROUP_SHARE))
    large = base.groupBy("digest").agg(
        F.sum("size").alias("whole"),
        F.count(F.lit(1)).alias("copies"),
    ).where((F.col("whole") > most) & (F.col("copies") > 1))
    large = common.written(large.select("digest", F.col("copies"), F.lit(True).alias("large")), "large")
    few = large.count() <= common.BROADCAST_ROWS
    base = base.join(F.broadcast(large), "digest", "left") if few else common.hot_left_join(base, large, ["digest"], "copies", base.count())
    tie = F.pmod(F.xxhash64("digest"), F.lit(1 << TEXT_BITS)) * (1 << ROW_BITS)
    tie = tie + F.when(F.col("large"), F.pmod(F.xxhash64("doc_id"), F.lit(1 << ROW_BITS))).otherwise(0)
    keys = [(F.shiftleft(F.col(f"q{i}"), TEXT_BITS + ROW_BITS) + tie).alias(f"k{i}") for i in range(len(_SCALES))]
    return common.written(base.select("doc_id", "size", "crc", *keys, F.lit(0).cast("long").alias("leaf")), "keys")


def _small(df: DataFrame) -> DataFrame:
    """A written table, to be broadcast if its count allows."""
    return F.broadcast(df) if df.count() <= common.BROADCAST_ROWS else df


def _opened(rows: DataFrame, leaves: DataFrame, widest: list[int]) -> DataFrame:
    """leaves (leaf, share, first) with rows: their bytes, widest dimension, its bounds, and the bytes to go left."""
    dims = range(len(widest))
    found = rows.groupBy("leaf").agg(
        F.sum("size").alias("size"),
        *[F.struct(F.min(f"k{i}").alias("lo"), F.max(f"k{i}").alias("hi")).alias(f"w{i}") for i in dims],
    )
    sides = F.array(
        *[F.struct(((F.col(f"w{i}.hi") - F.col(f"w{i}.lo")) / widest[i]).alias("wide"), F.lit(-i).alias("less"), F.col(f"w{i}.lo").alias("lo"), F.col(f"w{i}.hi").alias("hi")) for i in dims]
    )
    found = found.join(leaves, "leaf").withColumn("x", F.array_max(sides))
    half = F.floor(F.col("share") / 2)
    return found.select(
        "leaf",
        "share",
        "first",
        "size",
        (-F.col("x.less")).alias("dim"),
        "x.lo",
        "x.hi",
        (F.col("size") * half / F.col("share")).alias("goal"),
        F.lit(0).cast("long").alias("below"),
        F.col("x.hi").alias("cut"),
        ((F.col("share") > 1) & (F.col("x.hi") > F.col("x.lo"))).alias("open"),
    )


def _key() -> Column:
    return F.get(F.array(*[F.col(f"k{i}") for i in range(len(_SCALES))]), F.col("dim"))


def _closer(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    """One round: a histogram of the rows between each open leaf's bounds, and the bin in which its weighted median lies."""
    step = F.greatest(F.lit(1), F.ceil((F.col("hi") - F.col("lo") + 1) / BINS))
    opened = leaves.where("open").withColumn("step", step)
    inside = rows.join(_small(opened.select("leaf", "dim", "lo", "hi", "step")), "leaf").withColumn("key", _key()).where("key between lo and hi")
    bins = inside.groupBy("leaf", F.floor((F.col("key") - F.col("lo")) / F.col("step")).alias("bin")).agg(F.sum("size").alias("own"))
    bins = bins.join(opened, "leaf").withColumn("end", F.col("below") + F.sum("own").over(Window.partitionBy("leaf").orderBy("bin")))
    reached = F.col("end") >= F.col("goal")
    at = bins.groupBy("leaf").agg(
        F.min(
            F.struct((~reached).alias("late"), F.when(reached, F.col("bin")).otherwise(-F.col("bin")).alias("order"), "bin", "own", "end")
        ).alias("x")
    )
    at = opened.join(at, "leaf").withColumns(
        {
            "from": F.col("lo") + F.col("x.bin") * F.col("step"),
            "to": F.least(F.col("hi"), F.col("lo") + (F.col("x.bin") + 1) * F.col("step") - 1),
            "start": F.col("x.end") - F.col("x.own"),
        }
    )
    done = (F.col("step") == 1) | (F.col("x.own") <= NEAR * F.col("size"))
    with_it = F.abs(F.col("x.end") - F.col("goal")) <= F.abs(F.col("start") - F.col("goal"))
    found = F.when(done, F.when(with_it, F.col("to")).otherwise(F.col("from") - 1)).otherwise(F.col("cut"))
    moved = at.select(
        "leaf",
        "share",
        "first",
        "size",
        "dim",
        F.col("from").alias("lo"),
        F.col("to").alias("hi"),
        "goal",
        F.col("start").cast("long").alias("below"),
        found.alias("cut"),
        (~done).alias("open"),
    )
    return common.written(leaves.where(~F.col("open")).unionByName(moved), "leaves")


def kd_tree_shards(docs: DataFrame, leaves: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, crc, shard (0 to leaves - 1): sizes near equal, copies of a text together but at cuts among many.

    Each level takes one aggregation for the leaves' widths, then rounds of histograms that close in on the weighted
    medians of all leaves at once. Bounds of leaves are a table, with BINS sums a leaf in a round; the driver sees
    counts only. A null text has size 1; an empty table gives no rows; repeated rows and null ids are rows of their
    own; other columns are ignored. For a target in bytes take leaves = ceil(bytes / target).
    """
    rows = _located(docs, id_col, text_col, leaves)
    tree = common.written(docs.sparkSession.createDataFrame([(0, leaves, 0)], "leaf long, share long, first long"), "leaves")
    whole = rows.agg(*[(F.max(f"k{i}") - F.min(f"k{i}")) for i in range(len(_SCALES))]).first()
    widest = [max(1, w or 0) for w in whole]
    for _ in range(math.ceil(math.log2(leaves)) if leaves > 1 else 0):
        now = common.written(_opened(rows, tree, widest), "leaves")
        while now.where("open").limit(1).count():
            now = _closer(rows, now)
        cuts = now.where("share > 1").select("leaf", "dim", "cut")
        right = F.coalesce(_key() > F.col("cut"), F.lit(False)).cast("long")
        rows = common.written(
            rows.join(_small(cuts), "leaf", "left").select(
                "doc_id",
                "size",
                "crc",
                *[f"k{i}" for i in range(len(_SCALES))],
                (F.col("leaf") * 2 + right).alias("leaf"),
            ),
            "rows",
        )
        half = F.floor(F.col("share") / 2)
        left, whole_ = F.struct((F.col("leaf") * 2).alias("leaf"), half.alias("share"), F.col("first").alias("first")), F.struct(
            (F.col("leaf") * 2).alias("leaf"),
            F.col("share").alias("share"),
            F.col("first").alias("first"),
        )
        other = F.struct((F.col("leaf") * 2 + 1).alias("leaf"), (F.col("share") - half).alias("share"), (F.col("first") + half).alias("first"))
        tree = common.written(
            tree.select(F.explode(F.when(F.col("share") > 1, F.array(left, other)).otherwise(F.array(whole_))).alias("x")).select("x.*"),
            "leaves",
        )
    return rows.join(_small(tree.select("leaf", F.col("first").cast("int").alias("shard"))), "leaf").select("doc_id", "size", "crc", "shard")


def with_slots(rows: DataFrame, group: str = "shard") -> DataFrame:
    """Adds slot: a number from 0 without gaps in each group, by hash bucket and id; buckets are numbered in parallel."""
    rows = common.written(rows, "sharded")
    rows = rows.withColumn("b", F.pmod(F.xxhash64("doc_id", "crc"), F.lit(max(1, math.isqrt(rows.count())))))
    offsets = common.written(common.bucketed_offsets(rows, [group], "b", F.lit(1)), "offsets")
    side = F.broadcast(offsets) if offsets.count() <= common.BROADCAST_ROWS else offsets
    number = F.row_number().over(Window.partitionBy(group, "b").orderBy("doc_id", "crc", "size"))
    return rows.join(side, [group, "b"]).withColumn("slot", (F.col("before") + number - 1).cast("long")).drop("b", "before")


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_slots(kd_tree_shards(common.table(spark, sf_dir, "documents"), SHARDS))
    return rows.select(
        "doc_id",
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
