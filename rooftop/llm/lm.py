"""Stupid-backoff scores: n-gram count tables partitioned by hash, joined to the documents' n-grams, summed by document.

Rows of the relations are blocks: the distinct n-grams of a chunk of documents that fall in one hash bucket, sorted,
with their counts. A bucket's blocks meet in one task, which sums the counts of each n-gram over all chunks (the count
table of that bucket) and joins them back to the blocks; each chunk gets the counts of its n-grams and sums the
scores of its documents. A frequent n-gram is one entry a chunk, however often it occurs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftop.llm import common
from rooftop.llm.mix import n_words
from rooftop.llm.words import bodies, grouped, hashed, mix

#: Longest n-gram, factor of a step back, and the least count of an n-gram of two words or more that isn't backed off.
ORDER, ALPHA, LEAST = 3, 0.4, 2
#: Least text bytes of a chunk, and bytes of a block that a corpus should give at least.
CHUNK_BYTES, BLOCK_BYTES = 14 << 20, 1024
#: Bytes of all blocks for a byte of text, about.
GROWTH = 1.4

_PLACE = mix(np.arange(101, 101 + 8, dtype=np.uint64)) | np.uint64(1)
_BLOCKS = "bucket int, ngram int, chunk int, keys binary, counts binary"
_TOTALS = "bucket int, ngram int, chunk int, counts binary"


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers as compressed planes of bytes."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def _spread(hashes: np.ndarray, chunks: int, at: int) -> np.ndarray:
    """The chunk of each row: by its hash; rows that repeat one in a batch are spread, by the batch's number as well."""
    order = np.argsort(hashes, kind="stable")
    new = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order[:1]]) != 0)
    again = np.empty(len(hashes), np.uint64)
    again[order] = np.arange(len(hashes)) - np.repeat(new, np.diff(np.append(new, len(hashes))))
    moved = np.where(again > 0, mix(again + np.uint64(at << 20)), np.uint64(0))
    return ((hashes.view(np.uint64) + moved) % np.uint64(chunks)).astype(np.int32)


def _packed(batches: Iterator[pa.RecordBatch], chunks: int) -> Iterator[pa.RecordBatch]:
    """The documents of a batch that go to one chunk as one row, their texts compressed together."""
    press, task = zstandard.ZstdCompressor(level=1), TaskContext.get()
    for number, batch in enumerate(batches):
        chunk = _spread(batch.column(0).to_numpy(), chunks, (task.partitionId() if task else 0) * 100_003 + number)
        order = np.argsort(chunk, kind="stable")
        edges = np.flatnonzero(np.diff(chunk[order], prepend=-1)).tolist() + [len(order)]
        out = []
        for i, j in zip(edges, edges[1:], strict=False):
            mine = batch.take(order[i:j])
            texts = list(bodies(mine.column(2)))
            out.append((chunk[order[i]], mine.column(1).to_pylist(), [len(t) for t in texts], press.compress(b"".join(texts))))
        kinds = (pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], ["chunk", "ids", "sizes", "body"])


def _texts(rows: pa.Table) -> list[bytes]:
    out = []
    for sizes, body in zip(rows.column("sizes"), rows.column("body"), strict=True):
        whole, at = zstandard.ZstdDecompressor().decompress(body.as_buffer()) if len(body.as_buffer()) else b"", 0
        for n in sizes.as_py():
            out.append(whole[at : at + n])
            at += n
    return out


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's begin, and the end."""
    some = [hashed(group) for group in grouped(texts)]
    if not some:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    return np.concatenate([w for w, _ in some]), np.concatenate([[0], np.cumsum(np.concatenate([np.diff(a) for _, a in some]))])


def ngrams(words: np.ndarray, at: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """For n = 1 to order, one after the other: the hash of the n-gram that ends at each word, 0 where a text has fewer before."""
    yield words
    place, total = np.arange(len(words)) - np.repeat(at[:-1], np.diff(at)), words * _PLACE[0]
    for n in range(2, order + 1):
        total = total[1:] + words[: len(words) - n + 1] * _PLACE[n - 1] if len(words) >= n else total[:0]
        keys = np.concatenate([np.zeros(len(words) - len(total), np.uint64), mix(total + np.uint64(n))])
        keys[place < n - 1] = 0
        yield keys


def chunk_size(size: int, least: int) -> int:
    """Text bytes of a chunk. Buckets are as many as chunks, so a chunk that grows with the root of the corpus keeps
    blocks at BLOCK_BYTES and their number in proportion to the corpus: 270 MB at 100 TB, `least` up to 270 GB."""
    return max(least, math.isqrt(int(size * BLOCK_BYTES / GROWTH)))


def _bits(chunks: int) -> int:
    """log2 of the number of buckets: as many as chunks."""
    return max(3, (chunks - 1).bit_length())


def score_documents(
    docs: DataFrame,
    order: int = ORDER,
    alpha: float = ALPHA,
    least: int = LEAST,
    chunk_bytes: int = CHUNK_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, mean_log_score, log_score (sum of the natural logs of the words' scores) of every document.

    Texts of unlike lengths are compared by the mean; the sum grows with a text.

    Counts cover all documents. A word's score is count / count of its context for the longest n-gram that occurs
    at least `least` times, times alpha for each step back; a single word's is its count / all words. Words are
    runs without ASCII white space, A-Z lower-cased. Texts that are null or have no words have n_words 0, log_score
    0 and no mean; repeated rows count and are scored each, and are spread over chunks; null ids are ids; other
    columns are ignored; an empty table gives no rows. A worker holds a chunk's words, some 8 bytes a byte of text.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sums = docs.agg(
        F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0)).alias("size"),
        F.coalesce(F.sum(n_words(F.col("text"))), F.lit(0)).alias("words"),
    ).first()
    chunks, words = max(1, -(-int(sums.size) // chunk_size(int(sums.size), chunk_bytes))), int(sums.words)
    bits = _bits(chunks)
    docs = docs.select(F.xxhash64("doc_id", "text").alias("hash"), "doc_id", "text")
    docs = docs.mapInArrow(common.tidy(lambda x: _packed(x, chunks)), "chunk int, ids array<long>, sizes array<int>, body binary")

    def counted(rows: pa.Table) -> pa.Table:
        out = []
        chunk = rows.column("chunk")[0].as_py()
        for n, keys in enumerate(ngrams(*words_of(_texts(rows)), order), 1):
            distinct, counts = np.unique(keys[n - 1 :] if n > 1 else keys, return_counts=True)
            edges = np.searchsorted(distinct, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).tolist() + [len(distinct)]
            out += [
                (
                    b,
                    n,
                    chunk,
                    pack_sorted(distinct[i:j]),
                    pack(counts[i:j].astype(np.uint32)),
                ) for b, (i, j) in enumerate(zip(edges, edges[1:], strict=False)) if j > i
            ]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], ["bucket", "ngram", "chunk", "keys", "counts"])

    def totalled(rows: pa.Table) -> pa.Table:
        out, bucket, kind = [], rows.column("bucket")[0].as_py(), rows.column("ngram").to_numpy()
        for n in range(1, order + 1):
            mine = rows.take(np.flatnonzero(kind == n))
            if not len(mine):
                continue
            keys = [unpack_sorted(x.as_py()) for x in mine.column("keys")]
            counts = np.concatenate([unpack(x.as_py(), np.uint32) for x in mine.column("counts")])
            distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
            sums = np.bincount(place, counts, len(distinct)).astype(np.uint64)[place]
            ends = np.cumsum([len(k) for k in keys])
            out += [(bucket, n, c, pack(x.copy())) for c, x in zip(mine.column("chunk").to_pylist(), np.split(sums, ends[:-1]), strict=True)]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
        return pa.table([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], ["bucket", "ngram", "chunk", "counts"])

    def scored(rows: pa.Table, totals: pa.Table) -> pa.Table:
        own, at = words_of(_texts(rows))
        totals = totals.sort_by([("ngram", "ascending"), ("bucket", "ascending")])
        kind, logs, shorter = totals.column("ngram").to_numpy(), np.zeros(0), np.zeros(0)
        for n, keys in enumerate(ngrams(own, at, order), 1):
            _, place = np.unique(keys[n - 1 :] if n > 1 else keys, return_inverse=True)
            mine = [unpack(x.as_py(), np.uint64) for x in totals.column("counts").take(np.flatnonzero(kind == n))]
            seen = np.zeros(len(keys))
            seen[len(keys) - len(place) :] = np.concatenate(mine)[place] if mine else 0
            if n == 1:
                logs = np.log(alpha) * (order - 1) + np.log(seen / max(words, 1))
            else:
                use = np.flatnonzero((seen >= least) & (keys != 0))
                logs[use] = np.log(alpha) * (order - n) + np.log(seen[use] / shorter[use - 1])
                seen[keys == 0] = 0
            shorter = seen
        # where a text has too few words before, no step back was made
        before = np.arange(len(logs)) - np.repeat(at[:-1], np.diff(at))
        logs -= np.log(alpha) * np.maximum(order - 1 - before, 0)
        n = np.diff(at)
        lone = [float(logs[a:b].sum()) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        mean = [s / k if k else None for s, k in zip(lone, n.tolist(), strict=True)]
        ids = pa.concat_arrays([x.values for x in rows.column("ids")])
        return pa.table(
            [ids, pa.array(n, pa.int64()), pa.array(mean, pa.float64()), pa.array(lone, pa.float64())],
            ["doc_id", "n_words", "mean_log_score", "log_score"],
        )

    # Workers live on: what a group took is given back after it.
    def count(rows: pa.Table) -> pa.Table:
        return common.then_give_back(counted, rows)

    def total(rows: pa.Table) -> pa.Table:
        return common.then_give_back(totalled, rows)

    def score(rows: pa.Table, totals: pa.Table) -> pa.Table:
        return common.then_give_back(scored, rows, totals)

    # As many partitions as groups at least, so that what a task reads stays the size of a chunk.
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), chunks)
    docs = docs.repartition(parts, "chunk")
    blocks = docs.groupBy("chunk").applyInArrow(count, _BLOCKS)
    totals = blocks.repartition(parts, "bucket").groupBy("bucket").applyInArrow(total, _TOTALS)
    return docs.groupBy("chunk").cogroup(totals.repartition(parts, "chunk").groupBy("chunk")).applyInArrow(
        score,
        "doc_id long, n_words long, mean_log_score double, log_score double",
    )


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(common.table(spark, sf_dir, "documents"))
