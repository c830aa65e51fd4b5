"""Near-duplicates by MinHash with tensored banding, links confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rooftop.llm import common
from rooftop.llm.words import bodies, grouped, hashed, mix

#: Words of a shingle.
SHINGLE = 5
#: Minimum hashes of a collection; each pair of collections is a table, so a table's key has 2 * HALF hashes.
HALF = 4
#: Bits of the one-bit sketches of minimum hashes, short and long.
BITS, LONG_BITS = 64, 2048
#: Probabilities that a pair at the threshold shares no table, and that its short or long sketches rule it out.
MISS, RULED_OUT = 2e-4, (1e-8, 1e-6)
#: Documents that share a rare shingle and are compared in one task; larger lists are dealt as pairs of blocks.
LIST_ROWS = 1000
#: Rows of one task's lists.
GROUP_ROWS = 20_000
#: Columns of shingles that are hashed together.
_BLOCK = 4096


class Limits(NamedTuple):
    """What follows from a similarity: a link needs 100 * common shingles >= percent * all shingles of the two."""

    percent: int
    collections: int
    most_bits: int
    most_long: int


def _most(bits: int, rate: float, under: float) -> int:
    """The least number that a binomial count exceeds with a probability below under."""
    left, chance = 1.0, (1 - rate) ** bits
    for m in range(bits):
        left -= chance
        if left < under:
            return m
        chance *= (bits - m) / (m + 1) * rate / (1 - rate)
    return bits


@cache
def limits(percent: int) -> Limits:
    if not 0 < percent <= 100:
        raise ValueError("a similarity is a per cent above 0, at most 100")
    same, n = (percent / 100) ** HALF, BITS // HALF
    while (1 - same) ** n + n * same * (1 - same) ** (n - 1) > MISS:
        n += 1
    return Limits(percent, n, *(_most(bits, (1 - percent / 100) / 2, under) for bits, under in zip((BITS, LONG_BITS), RULED_OUT, strict=True)))


@cache
def _hashes(collections: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What the minimum hashes are taken with, and the factors of a collection's."""
    fixed = mix(np.arange(1, 2 * collections * HALF + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return fixed[: collections * HALF, None], fixed[collections * HALF :, None] | np.uint64(1), fixed[:HALF]


_LONG = mix(np.arange(10**6, 10**6 + 2 * LONG_BITS, dtype=np.uint64))
_LONG_XOR, _LONG_ODD = _LONG[:LONG_BITS, None], (_LONG[LONG_BITS:, None] | np.uint64(1))
_PLACE = mix(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Of each text: its distinct shingles as sorted 64-bit hashes; the whole sequence as one for fewer words."""
    words, at = hashed(texts)
    n = len(words) - SHINGLE + 1
    runs = sum(words[i : i + n] * _PLACE[i] for i in range(SHINGLE)) if n > 0 else words[:0]
    runs = mix(runs) if n > 0 else runs
    bounds = at.tolist()
    for a, b in zip(bounds, bounds[1:], strict=False):
        if b - a >= SHINGLE:
            yield np.unique(runs[a : b - SHINGLE + 1])
        elif b > a:
            yield mix(np.array([(words[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64))
        else:
            yield words[:0]


def _minima(shingles: np.ndarray, xor: np.ndarray, odd: np.ndarray) -> np.ndarray:
    low, step = None, _BLOCK * BITS // len(xor)
    for i in range(0, len(shingles), step):
        part = ((shingles[None, i : i + step] ^ xor) * odd).min(axis=1)
        low = part if low is None else np.minimum(low, part)
    return mix(low)


def long_sketch(shingles: np.ndarray) -> bytes:
    """One bit of each of LONG_BITS minimum hashes."""
    return np.packbits((_minima(shingles, _LONG_XOR, _LONG_ODD) & np.uint64(1)).astype(np.uint8)).tobytes()


def signature(shingles: np.ndarray, collections: int) -> tuple[int, int, int, list[int]]:
    """Two 64-bit digests of a set, its one-bit sketch, and the hashes of its collections."""
    xor, odd, factors = _hashes(collections)
    low = _minima(shingles, xor, odd)
    halves = mix((low.reshape(collections, HALF) * factors).sum(axis=1, dtype=np.uint64))
    sketch = np.packbits((low[:BITS] & np.uint64(1)).astype(np.uint8)).view(np.int64)[0]
    digest = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64), mix(shingles * np.uint64(0xDA942042E4DD58B5)).sum(dtype=np.uint64)
    return int(digest[0].astype(np.int64)), int(digest[1].astype(np.int64)), int(sketch), halves.view(np.int64).tolist()


_SIGNED = "doc_id long, content binary, n long, d1 long, d2 long, sketch long, halves array<long>"


def _sign(batches: Iterator[pa.RecordBatch], collections: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for group in grouped(bodies(batch.column(2))):
            for s in shingle_sets(group):
                out.append((len(s), *signature(s, collections)) if len(s) else (0, 0, 0, 0, None))
        kinds = (*[pa.int64()] * 4, pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *[pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)]],
            ["doc_id", "content", "n", "d1", "d2", "sketch", "halves"],
        )


def _tables(batches: Iterator[pa.RecordBatch], collections: int) -> Iterator[pa.RecordBatch]:
    """A row for each pair of collections: the key formed from their two hashes."""
    first, second = np.triu_indices(collections, 1)
    salt = mix(np.arange(1, len(first) + 1, dtype=np.uint64))
    for whole in batches:
        for at in range(0, len(whole), 2000):
            batch = whole.slice(at, 2000)
            halves = batch.column(0).flatten().to_numpy().view(np.uint64).reshape(-1, collections)
            keys = mix(halves[:, first] * np.uint64(0x9E3779B97F4A7C15) + mix(halves[:, second] + salt))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(batch.column(1).to_numpy(), len(first)))],
                ["key", "rep"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [s.tobytes() for group in grouped(bodies(batch.column(1))) for s in shingle_sets(group)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.large_binary()).cast(pa.binary())], ["rep", "shingles"])


def _singly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of a set."""
    for whole in batches:
        for at in range(0, len(whole), 200):
            batch = whole.slice(at, 200)
            sets = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(1)]
            sizes = [len(x) for x in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(sets)),
                    pa.array(np.repeat(batch.column(0).to_numpy(), sizes)),
                    pa.array(np.repeat(sizes, sizes).astype(np.int64)),
                ],
                ["shingle", "rep", "n"],
            )


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = [long_sketch(np.frombuffer(x.as_buffer(), np.uint64)) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary())], ["rep", "bits"])


def _lists(rows: pa.Table, given: Limits) -> pa.Table:
    """Pairs of documents of one list (shingle, i, j) that may be linked: sizes, components and long sketches allow it."""
    rows = rows.sort_by([("shingle", "ascending"), ("i", "ascending"), ("j", "ascending")])
    shingle, i, j, own, rep, n, comp = (rows.column(c).to_numpy() for c in ("shingle", "i", "j", "own", "rep", "n", "comp"))
    bits = np.frombuffer(b"".join(rows.column("bits").to_pylist()), np.uint64).reshape(len(rows), -1)
    new = np.flatnonzero(
        (np.diff(shingle, prepend=shingle[0] ^ 1) != 0) | (np.diff(i, prepend=-1) != 0) | (np.diff(j, prepend=-1) != 0)
    ).tolist() + [len(rows)]
    out = [np.zeros((0, 2), np.int64)]
    for a, b in zip(new, new[1:], strict=False):
        for x in range(a, b - 1):
            y = np.arange(x + 1, b)
            y = y[(comp[y] != comp[x]) & (100 * np.minimum(n[y], n[x]) >= given.percent * np.maximum(n[y], n[x]))]
            if i[x] != j[x]:  # within a block the pair of the block with itself compares
                y = y[own[y] != own[x]]
            if len(y):
                y = y[np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1) <= given.most_long]
                out.append(np.stack([np.minimum(rep[y], rep[x]), np.maximum(rep[y], rep[x])], axis=1))
    pairs = np.unique(np.concatenate(out), axis=0)
    return pa.table([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], ["a", "b"])


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(100 * both >= percent * (len(x) + len(y) - both))
        yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))


def _alike(given: Limits) -> F.Column:
    """Whether a member (n, sketch) and its bucket's centre (cn, csketch) have sizes that a link can have and sketches near enough."""
    n, m = F.col("n"), F.col("cn")
    return (100 * F.least(n, m) >= given.percent * F.greatest(n, m)) & (F.bit_count(F.col("sketch").bitwiseXOR(F.col("csketch"))) <= given.most_bits)


def full_sets(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """rep, shingles (sorted 64-bit hashes) of the texts that reps (rep, doc_id, content) name. docs: doc_id, content, text."""
    reps = reps.select("rep", F.col("doc_id").alias("__id"), F.col("content").alias("__content"))
    n = reps.count()
    side = F.broadcast(reps) if n <= common.BROADCAST_ROWS else reps
    rows = docs.join(side, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("content") == F.col("__content")))
    sets = common.written(rows.select("rep", "text").mapInArrow(common.tidy(_sets), "rep long, shingles binary"), "sets")
    # Rows that repeat an id and its text come more than once.
    return sets if sets.count() == n else common.written(sets.dropDuplicates(["rep"]), "sets")


def confirmed(docs: DataFrame, reps: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b of reps whose full shingle sets are alike enough."""
    ends = common.written(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "ends")
    sets = full_sets(docs, common.written(reps.select("rep", "doc_id", "content").join(_small(ends), "rep"), "ends"))
    rows = pairs.join(
        sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y")),
        "b",
    ).join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x")), "a")
    return common.written(rows.select("a", "b", "x", "y").mapInArrow(common.tidy(lambda x: _confirm(x, percent)), "a long, b long"), "links")


def _small(df: DataFrame) -> DataFrame:
    """A written table, to be broadcast if its count allows."""
    return F.broadcast(df) if df.count() <= common.BROADCAST_ROWS else df


def _by_shingle(docs: DataFrame, reps: DataFrame, some: DataFrame, given: Limits) -> DataFrame:
    """Pairs a, b among some (rep, n, comp) that can be linked across components, found by prefixes of their sets.

    Shingles are put in order, the rarest among these documents first. Two linked sets of n shingles or more share one
    of the first n - ceil(percent % of n) + 1 of each, so only these rows meet. A set with more shingles of its own
    than that is linked with nothing and leaves at once. The documents of a shingle are compared by long sketches in
    the task that holds their list, and only pairs that may be linked are given out; long lists are dealt as pairs of
    blocks.
    """
    sets = full_sets(docs, common.written(reps.select("rep", "doc_id", "content").join(_small(some.select("rep")), "rep"), "ends"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = sets.select("rep", "shingles").mapInArrow(common.tidy(_singly), "shingle long, rep long, n long").repartition(parts, "shingle")
    counts = rows.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("df"),
        F.min("rep").alias("lo"),
        F.max("n").alias("hi"),
    ).where("df > 1").select("shingle", "df")
    rows = common.written(rows.join(counts, "shingle"), "shingles")
    free = F.col("n") - F.ceil(F.col("n") * given.percent / 100) + 1  # places in the prefix
    known = rows.groupBy("rep", "n").agg(F.count(F.lit(1)).alias("m")).select(
        "rep",
        (free - (F.col("n") - F.col("m"))).alias("left"),
    ).where("left > 0")
    place = F.row_number().over(Window.partitionBy("rep").orderBy("df", "shingle"))
    first = rows.join(known, "rep").withColumn("place", place).where(F.col("place") <= F.col("left")).select("shingle", "rep", "df")
    bits = common.written(sets.select("rep", "shingles").mapInArrow(common.tidy(_sketched), "rep long, bits binary"), "long")
    blocks = F.ceil(F.col("df") / LIST_ROWS).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    first = first.withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0), blocks - 1))})
    first = first.select("shingle", "rep", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    first = common.written(first.join(some.select("rep", "n", "comp").join(bits, "rep"), "rep"), "lists")
    groups = max(1, first.count() // GROUP_ROWS)
    lists = first.withColumn("g", F.pmod(F.xxhash64("shingle", "i", "j"), F.lit(groups)))
    return lists.groupBy("g").applyInArrow(lambda t: _lists(t, given), "a long, b long").distinct()


def _apart(placed: DataFrame) -> DataFrame:
    """rep, n, comp of all members (key, rep, n, comp) of the components that share a bucket with another one.

    A bucket's members collapse to its components before any join: what is joined doesn't grow with a component's
    members times their buckets.
    """
    held = common.written(placed.select("key", "comp").distinct(), "held")
    mixed = held.groupBy("key").agg(F.count(F.lit(1)).alias("comps")).where("comps > 1").select("key")
    comps = held.join(mixed, "key", "left_semi").select("comp").distinct()
    return placed.select("rep", "n", "comp").distinct().join(comps, "comp", "left_semi").select("rep", "n", "comp")


def components(links: DataFrame) -> DataFrame:
    """v, label of every end of a link a, b: the smallest id that it reaches.

    Rounds of taking the neighbours' least label and then that label's own label; tables are written between rounds.
    """
    edges = common.written(links.select(F.col("a").alias("v"), F.col("b").alias("u")).union(links.select("b", "a")).distinct(), "edges")
    labels = common.written(edges.groupBy("v").agg(F.min("u").alias("u")).select("v", F.least("v", "u").alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("v").alias("u"), "label"), "u").groupBy("v").agg(F.min("label").alias("near"))
        step = labels.join(near, "v").select("v", "label", F.least("label", "near").alias("new"))
        step = common.written(step, "step")
        jump = labels.select(F.col("v").alias("new"), F.col("label").alias("beyond"))
        moved = common.written(
            step.join(jump, "new", "left").select(
                "v",
                F.least("new", F.coalesce("beyond", "new")).alias("label"),
                (F.least("new", F.coalesce("beyond", "new")) < F.col("label")).alias("moved"),
            ),
            "labels",
        )
        labels = moved.select("v", "label")
        if not moved.where("moved").limit(1).count():
            return labels


def _classes(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(signed, classes): doc_id, content, n, d1, d2 of every row; d1, d2, n, size, doc_id, content of every set of shingles.

    A class's doc_id and content are those of its component's first row: the smallest id, null last, then the least
    content. docs: doc_id, content, text.
    """
    given = limits(percent)
    signed = common.written(docs.mapInArrow(common.tidy(lambda x: _sign(x, given.collections)), _SIGNED), "signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content", "sketch", "halves")).alias("x")
    reps = signed.where("n > 0").groupBy("d1", "d2", "n").agg(first, F.count(F.lit(1)).alias("size"))
    # Ids may repeat or be null: sets get numbers of their own, fixed by writing them.
    reps = common.written(
        reps.select(F.monotonically_increasing_id().alias("rep"), "d1", "d2", "n", "size", "x.none", "x.doc_id", "x.content", "x.sketch", "x.halves"),
        "reps",
    )
    facts = reps.select("rep", "n", "sketch")
    # Keys are shuffled once: the counts and the members of a bucket are found in the same partitions.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = reps.select("halves", "rep").mapInArrow(
        common.tidy(lambda x: _tables(x, given.collections)),
        "key long, rep long",
    ).repartition(parts, "key")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("rep").alias("lo")).where("c > 1").select("key", "c")
    members = common.written(keys.join(shared, "key"), "members")
    degree = members.groupBy("rep").agg(F.sum(F.col("c") - 1).alias("degree"))
    members = common.written(members.join(degree.join(facts, "rep"), "rep"), "members")
    # Counts and centres are small sums of a bucket, so they collapse before their shuffle; hot buckets' members aren't shuffled.
    centre = members.groupBy("key").agg(F.first("c").alias("size"), F.max(F.struct("degree", (-F.col("rep")).alias("r"), "n", "sketch")).alias("x"))
    centre = common.written(
        centre.select("key", "size", (-F.col("x.r")).alias("centre"), F.col("x.n").alias("cn"), F.col("x.sketch").alias("csketch")),
        "centres",
    )
    if centre.count() <= common.BROADCAST_ROWS:
        others = members.join(F.broadcast(centre), "key")
    else:
        others = common.hot_left_join(members, centre, ["key"], "size", members.count())
    others = others.where("rep <> centre")
    others = common.written(others.select("key", "rep", "n", "c", "centre", _alike(given).alias("alike")), "others")
    star = common.written(
        others.where("alike").select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")).distinct(),
        "star",
    )
    links = confirmed(docs, reps, star, percent)
    labels = components(links)

    # Buckets whose members, the centre apart, are still in different components: only there pairs are left to compare.
    placed = common.written(
        others.where("c > 2").join(labels.withColumnRenamed("v", "rep"), "rep", "left").select(
            "key",
            "rep",
            "n",
            F.coalesce("label", "rep").alias("comp"),
        ),
        "placed",
    )
    some = common.written(_apart(placed), "mixed")
    rest = _by_shingle(docs, reps, some, given).join(star, ["a", "b"], "left_anti")
    more = confirmed(docs, reps, common.written(rest, "rest"), percent)
    if more.limit(1).count():
        labels = components(links.union(more))
    placed = common.written(
        reps.select(
            "rep",
            "d1",
            "d2",
            "n",
            "size",
            F.struct("none", "doc_id", "content").alias("first"),
        ).join(labels.withColumnRenamed("v", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep")),
        "placed",
    )
    best = placed.where("rep <> label").select("label").distinct().join(placed, "label").groupBy("label").agg(F.min("first").alias("best"))
    classes = placed.join(best, "label", "left").select("d1", "d2", "n", "size", F.coalesce("best", "first").alias("x"))
    return signed, common.written(classes.select("d1", "d2", "n", "size", "x.doc_id", "x.content"), "classes")


def _decided(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """doc_id, content, n, and id and body, those of the component's first row (null without shingles), of every row."""
    spark = docs.sparkSession
    common.small_batches(spark)
    mark = common.mark()
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.content(text_col).alias("content"), F.col(text_col).alias("text"))
    signed, classes = _classes(docs, percent)
    common.release(spark, mark, signed, classes)
    classes = classes.withColumnsRenamed({"doc_id": "id", "content": "body"})
    return common.hot_left_join(signed.select("doc_id", "content", "n", "d1", "d2"), classes, ["d1", "d2", "n"], "size", signed.count())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row; linked are sets with a similarity of percent or more.

    Equal sets collapse first. Sets that share a table's key are candidates. In each table's bucket the member that
    shares most keys is compared with all others, so a bucket of copies costs its size, not its square. Where a
    bucket's other members are still in different components, these meet by rare shingles, which leaves out no pair
    that could join two components. Sizes and sketches rule pairs out before their full sets are compared.

    Links are between rows' texts. Null and empty texts and texts without words have no shingles and no links. Rows
    that repeat an id are linked each by its own text. A null id is no component's id unless all its rows lack one.
    Other columns are ignored; an empty table gives no rows.
    """
    rows = _decided(docs, id_col, text_col, percent)
    found = F.when(F.col("n") > 0, F.col("id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), found.alias("component_id"), found.eqNullSafe(F.col("doc_id")).alias("kept"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"), percent=85)


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component at a similarity of 80 per cent, with its columns as they are.

    The row with the smallest id stays, null last; of rows that share it the one with the least digest of its text; of
    rows alike in both one. Rows without shingles (null and empty texts, texts without words) stay.
    """
    mark = common.mark()
    rows = _decided(docs, "doc_id", "text", 80).where("n > 0")
    kept = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("content") == F.col("body"))
    out = common.keep_decided(docs, rows.select("doc_id", "content", kept.alias("kept")))
    common.release(spark, mark, out)
    return out
