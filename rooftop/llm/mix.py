"""Mixing sources to target weights: fixed-length blocks drawn through pseudorandom permutations of block indexes."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rooftop.llm import common

#: Words of a block; output shards; largest number of times that a source is taken; seed of all draws.
BLOCK, OUT_SHARDS, MOST, SEED = 256, 16, 3, 17
#: Slots that a row of the draws stands for at most, before they are listed.
PIECE = 1 << 16


def n_words(text: Column) -> Column:
    """Number of runs without ASCII white space, without making the words."""
    return F.length(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "w"), common.BLANKS + "+", "")).cast("long")


def with_targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """Adds target to sources (size, weight): shares of all words by weight; none above most times its size, the excess reshared.

    Words for a weight of 1 grow from round to round, so that number alone tells which sources are full: a round is one
    sum over the sources, and rounds end when no further source is full.
    """
    size, weight, per, full = F.col("size"), F.col("weight"), 0.0, -1
    while True:
        over = F.lit(per) * weight > most * size
        now = sources.agg(
            F.count_if(over).alias("full"),
            F.sum("size").alias("whole"),
            F.sum(F.when(over, most * size).otherwise(0)).alias("taken"),
            F.sum(F.when(~over, weight).otherwise(0)).alias("left"),
        ).first()
        if now.full == full or not now.left:
            return sources.withColumn("target", F.when(over, most * size).otherwise(F.lit(per) * weight).cast("double"))
        per, full = float(now.whole - now.taken) / now.left, now.full


def _affine(source, size: int, go: int) -> tuple[int, int]:
    """Multiplier and shift of the permutation i -> (a * i + b) mod size of a source's blocks on its pass go."""
    h = hashlib.sha256(f"{SEED}|{go}|{source!r}".encode()).digest()
    a = int.from_bytes(h[:8], "big") % max(1, size) or 1
    while np.gcd(a, size) != 1:
        a += 1
    return a % max(1, size) if size > 1 else 0, int.from_bytes(h[8:16], "big") % max(1, size)


def _mulmod(a: Column, b: Column, m: Column) -> Column:
    """a * b mod m without overflow for m up to 2^42, by two digits of 21 bits."""
    high, low = F.shiftright(b, 21), b.bitwiseAND(F.lit((1 << 21) - 1))
    return F.pmod(F.pmod(F.pmod(a * high, m) * F.lit(1 << 10), m) * F.lit(1 << 11) + a * low, m)


class Plan(NamedTuple):
    """How a source is taken: full passes, slots of the last pass, words of its last slot, blocks, their permutation."""

    passes: int
    slots: int
    cut: int
    blocks: int
    a: int
    b: int


def plan(source, size: int, target: float, block: int = BLOCK) -> Plan:
    words, blocks = round(target), -(-size // block)
    whole, rest = divmod(words, size) if size else (0, 0)
    a, b = _affine(source, blocks, whole)
    tail = size - (blocks - 1) * block  # words of the last block
    slots, cut = -(-rest // block), (rest - 1) % block + 1 if rest else 0
    if rest and blocks:
        # slot of the short last block: the j with a * j + b = blocks - 1
        at = (blocks - 1 - b) * pow(a, -1, blocks) % blocks if blocks > 1 else 0
        if at < slots:
            more = rest - tail  # words beyond the short block
            if rest <= at * block + tail:  # the short block is the last slot taken
                slots, cut = (at + 1, rest - at * block) if rest > at * block else (slots, cut)
            else:
                slots, cut = 1 + -(-more // block), (more - 1) % block + 1
    return Plan(whole, slots, cut, blocks, a, b)


def shard_draws(slots: int, shards: int, source) -> list[int]:
    """Multinomial counts of a source's slots on the output shards."""
    seed = int.from_bytes(hashlib.sha256(f"{SEED}|draw|{source!r}".encode()).digest()[:8], "big")
    return np.random.default_rng(seed).multinomial(slots, [1 / shards] * shards).tolist()


_FACTS = (
    "none boolean, source string, source_size long, n long, target double, passes int, slots long, cut int, blocks long, a long, b "
    "long, draws array<long>"
)


def planned(rows: DataFrame, weights: dict | None, block: int) -> DataFrame:
    """Of each source: its size and rows, its target, its plan and the multinomial draws of its slots by output shard."""
    sources = rows.groupBy("none", "source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    if weights is None:
        sources = common.placed(sources, ["none", "source"], "place").withColumn("weight", 1 + F.col("place") % 3)
    else:
        given = rows.sparkSession.createDataFrame(
            [(s is None, s or "", float(w)) for s, w in weights.items()],
            "none boolean, source string, weight double",
        )
        sources = sources.join(F.broadcast(given), ["none", "source"], "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    sources = with_targets(common.written(sources.select("none", "source", "size", "n", "weight"), "sources"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _FACTS.split(", ")]
        kinds = [
            pa.bool_(),
            pa.string(),
            pa.int64(),
            pa.int64(),
            pa.float64(),
            pa.int32(),
            pa.int64(),
            pa.int32(),
            *[pa.int64()] * 3,
            pa.list_(pa.int64()),
        ]
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                source = None if r["none"] else r["source"]
                made = plan(source, r["size"], r["target"], block)
                out.append((r["none"], r["source"], r["size"], r["n"], r["target"], *made, shard_draws(made.slots, OUT_SHARDS, source)))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], names)

    return common.written(sources.mapInArrow(run, _FACTS), "facts")


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: dict | None = None,
    block: int = BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """(documents, blocks) of a mix of all sources to target weights.

    Documents of a source, in pseudorandom order, are one stream of words cut into blocks; a pass over the source
    takes its blocks in the order of a permutation of their indexes. The mix takes whole passes and a part of one
    more, so that the words taken are the target rounded, and no word is taken more than MOST times. Weights by
    source (0 for one without); without them 1, 2, 3 repeating by code point, null last. An empty or null text has no
    words and gives nothing; repeated rows are rows of their own; null ids are ids; other columns are ignored; an
    empty table gives no rows. The driver sees sums over all sources only.

    documents: doc_id, content, source, size, source_size, target, start, taken, passes, extra (parts of the last pass
    as array of from, to in words of the document). blocks: none, source, block, shard, limit (words) of each slot.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).isNull().alias("none"),
        F.coalesce(F.col(source_col), F.lit("")).alias("source"),
        n_words(F.col(text_col)).alias("size"),
        common.content(text_col).alias("content"),
    )
    rows = common.written(rows, "sized")
    total, key = rows.count(), ["none", "source"]
    facts = planned(rows, weights, block)
    # Offsets of documents in their source's stream: buckets by hash of the id, sums by bucket, then within buckets.
    # About as many buckets as rows in one, so that neither of the two windows grows as the rows do.
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "content"), F.lit(max(1, math.isqrt(total)))))
    sums = common.written(common.bucketed_offsets(rows, key, "bucket", F.col("size")), "sums")
    order = Window.partitionBy(*key, "bucket").orderBy(
        F.xxhash64("doc_id", F.lit(SEED)),
        "doc_id",
        "content",
        "size",
    ).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(order), F.lit(0))).join(sums, [*key, "bucket"])
    rows = rows.withColumn("start", F.col("before") + F.col("inside")).drop("bucket", "before", "inside")
    own = facts.select(*key, "source_size", "target", "passes", "n")
    rows = rows.join(F.broadcast(own), key) if facts.count() <= common.BROADCAST_ROWS else common.hot_left_join(rows, own, key, "n", total)
    rows = common.written(rows.select("doc_id", "content", *key, "size", "source_size", "target", "passes", "start"), "placed")

    # The slots of the last pass, dealt to output shards by multinomial draws, and mapped to block indexes.
    first = F.aggregate(F.slice("draws", 1, F.col("shard")), F.lit(0).cast("long"), lambda x, y: x + y)
    per = facts.select("*", F.posexplode("draws").alias("shard", "own")).where("own > 0").withColumn("first", first)
    per = per.withColumn(
        "at",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("own") - 1, F.lit(PIECE).cast("long"))),
    ).drop("draws").repartition(*key, "shard", "at")
    slot = per.withColumn("j", F.explode(F.sequence(F.col("first") + F.col("at"), F.col("first") + F.least(F.col("at") + PIECE, F.col("own")) - 1)))
    index = F.pmod(_mulmod(F.col("a"), F.col("j"), F.col("blocks")) + F.col("b"), F.col("blocks"))
    slot = slot.select(
        *key,
        index.alias("block"),
        "shard",
        F.when(F.col("j") == F.col("slots") - 1, F.col("cut")).otherwise(F.lit(block)).alias("limit"),
    )

    # Documents' parts by block, joined to the taken blocks by index: both grow with the corpus, so neither is broadcast.
    parts = rows.where("size > 0").select(
        *key,
        F.struct("doc_id", "content", "start").alias("row"),
        "start",
        "size",
        F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))).alias("block"),
    )
    low = F.greatest(F.col("start"), F.col("block") * block)
    high = F.least(F.col("start") + F.col("size"), F.col("block") * block + F.col("limit"))
    taken = parts.join(slot.hint("merge"), [*key, "block"]).where(high > low)
    taken = taken.select(*key, "row", F.struct((low - F.col("start")).alias("from"), (high - F.col("start")).alias("to")).alias("part"))
    extra = taken.groupBy(*key, "row").agg(F.array_sort(F.collect_list("part")).alias("extra"))
    out = rows.withColumn("row", F.struct("doc_id", "content", "start")).join(extra.hint("merge"), [*key, "row"], "left").drop("row")
    more = F.aggregate(
        F.coalesce("extra", F.array().cast("array<struct<from:bigint,to:bigint>>")),
        F.lit(0).cast("long"),
        lambda acc, x: acc + x["to"] - x["from"],
    )
    out = out.withColumns({"taken": (F.col("passes") * F.col("size") + more).cast("long"), "source": F.when(~F.col("none"), F.col("source"))})
    return out, slot


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = mixed(common.table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: a row for each whole pass, and one with the words of the last, partial pass.

    The columns are those of documents. The partial row has the taken words, joined by one space. A document with no
    words, and one of which nothing is taken, gives no row. Texts are shuffled once, to meet what is taken of them.
    """
    mark = common.mark()
    rows, _ = mixed(docs)
    plans = rows.where("size > 0 and taken > 0").select(
        F.col("doc_id").alias("__id"),
        F.col("source").alias("__source"),
        F.col("content").alias("__body"),
        "passes",
        "extra",
    )
    plans = common.written(plans, "plans")
    repeated = common.written(plans.groupBy("__id", "__source", "__body").agg(F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"), "repeated")
    common.release(spark, mark, plans, repeated)
    same = F.col("__row.doc_id").eqNullSafe(F.col("__id")) & F.col("__row.source").eqNullSafe(F.col("__source")) & (F.col("__content") == F.col("__body"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), common.content().alias("__content"))
    if n := repeated.count():
        # Rows alike in id, source and text: one of them meets what each of them gives.
        side = F.broadcast(repeated) if n <= common.BROADCAST_ROWS else repeated
        alike = keyed.join(side, same, "left_semi").withColumns(
            {"__k1": F.col("__row.doc_id"), "__k2": F.col("__row.source")}
        ).dropDuplicates(["__k1", "__k2", "__content"])
        keyed = keyed.join(side, same, "left_anti").unionByName(alike.select("__row", "__content"))
    full = keyed.join(plans.hint("merge"), same).select("__row.*", F.struct("passes", "extra").alias("__plan"))
    words = F.filter(F.split("text", common.BLANKS + "+"), lambda w: w != "")
    plan_ = F.col("__plan")
    full = full.withColumn("__words", F.when(plan_["extra"].isNotNull(), words))
    pieces = F.transform(
        plan_["extra"],
        lambda e: F.array_join(F.slice(F.col("__words"), (e["from"] + 1).cast("int"), (e["to"] - e["from"]).cast("int")), " "),
    )
    part = F.when(plan_["extra"].isNotNull(), F.array(F.struct(F.array_join(pieces, " ").alias("text"), F.lit(False).alias("all"))))
    whole = F.array_repeat(F.struct(F.col("text").alias("text"), F.lit(True).alias("all")), plan_["passes"])
    out = full.withColumn("__made", F.explode(F.concat(whole, F.coalesce(part, F.array().cast("array<struct<text:string,all:boolean>>")))))
    made = {"text": F.col("__made.text")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.when(F.col("__made.all"), F.col("n_chars")).otherwise(F.length("__made.text").cast(docs.schema["n_chars"].dataType))
    return out.withColumns(made).select(*docs.columns)
