"""Byte-level BPE: distinct words are folded by ranked merges over their bytes; decoding joins the ids' binary pieces."""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftop.llm import common

RANKS = "byte_bpe_50k.tiktoken"
#: Code points of Unicode's White_Space property.
SPACES = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Word ends that the pattern splits off after an apostrophe, in its order.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]
#: Distinct words whose ids a task keeps; beyond it the table starts anew. Characters that are split at once.
KEPT, CHARS = 400_000, 1 << 20
LETTER, NUMBER, SPACE = 1, 2, 3


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Of each code point: letter, number, white space or other."""
    kinds = np.fromiter(
        ({"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], 0) for c in range(sys.maxunicode + 1)),
        np.uint8,
        sys.maxunicode + 1,
    )
    kinds[SPACES] = SPACE
    return kinds


def split(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All texts' bytes, the byte where each word begins (and the end), and the number of words of each text.

    Words are the matches of public_tokenizers.PATTERN, found for all texts at once from the runs of one kind.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    whole = "".join(texts)
    n = len(whole)
    data = whole.encode()
    if not n:
        return data, np.zeros(1, np.int64), np.zeros(len(texts), np.int64)
    cp = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    kind = _kinds()[cp]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    first = np.zeros(n + 1, bool)  # a text begins here, or all end
    first[starts] = True
    run = first.copy()
    run[1:n] |= kind[1:] != kind[:-1]
    flag = run[:n].copy()
    follows = ~first[1:n]  # of i + 1: the same text goes on
    blank = kind == SPACE
    # The last blank before a word belongs to it, or stands alone if it isn't a space.
    last = np.flatnonzero(blank[:-1] & ~blank[1:] & follows)
    flag[last] = True
    flag[last[cp[last] == 32] + 1] = False
    # An apostrophe alone, not after a space, then an ending.
    quote = np.flatnonzero((cp == 39) & flag & run[:n])
    if quote.size:
        ends = {len(e): [] for e in ENDINGS}
        for q in quote.tolist():
            stop = starts[np.searchsorted(starts, q, "right")]
            rest = whole[q + 1 : min(q + 3, stop)]
            for e in ENDINGS:
                if rest.startswith(e):
                    ends[len(e)].append(q)
                    break
        for k, qs in ends.items():
            if qs:
                qs = np.array(qs)
                flag[qs + 1] = False
                after = qs + 1 + k
                after = after[after < n]
                # where a letter run goes on a new word begins; a space before a word keeps its place
                flag[after[(kind[after] == LETTER) & ~run[after]]] = True
    at = np.flatnonzero(flag)
    width = 1 + (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)
    byte = np.concatenate([[0], np.cumsum(width)])
    counts = np.diff(np.searchsorted(at, starts))
    return data, np.concatenate([byte[at], [len(data)]]), counts


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word: the adjacent pair with the lowest rank is merged, the leftmost first, until none has a rank."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    if len(word) > 300:
        return _merge_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    none, get = len(ranks) + 1, ranks.get
    pairs = [get(word[i : i + 2], none) for i in range(len(word) - 1)]
    while pairs and (low := min(pairs)) < none:
        i = pairs.index(low)
        parts[i] += parts.pop(i + 1)
        del pairs[i]
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As merge, in n log n for words of any length: a heap of pairs over a linked list."""
    n = len(word)
    end, prev, nxt = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n

    def push(i: int) -> None:
        if i >= 0 and nxt[i] < n and (r := ranks.get(word[i : end[nxt[i]]])) is not None:
            heapq.heappush(heap, (r, i, end[nxt[i]]))

    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or nxt[i] >= n or end[nxt[i]] != stop:
            continue
        j = nxt[i]
        alive[j], end[i], nxt[i] = False, end[j], nxt[j]
        if nxt[j] < n:
            prev[nxt[j]] = i
        push(i)
        push(prev[i])
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def read_ranks(spark: SparkSession, path: str) -> bytes:
    """The rank file's content, read through Spark: its size is that of a vocabulary. Bounds the session's Arrow batches."""
    common.small_batches(spark)
    return "\n".join(r.value for r in spark.read.text(path if "://" in path else f"file://{path}").collect()).encode()


class Codec:
    """Encodes and decodes by a rank file's content; keeps the ids of words seen."""

    def __init__(self, content: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}
        self.pieces = {b"%d" % i: piece for piece, i in self.ranks.items()}
        self.known: dict[bytes, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text in decimal, joined by blanks."""
        data, at, counts = split(texts)
        bounds = at.tolist()
        words = [data[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        if len(self.known) > KEPT:
            self.known.clear()
        for word in set(words) - self.known.keys():
            self.known[word] = b" ".join(b"%d" % i for i in merge(word, self.ranks))
        ids = list(map(self.known.__getitem__, words))
        out, i = [], 0
        for n in counts.tolist():
            out.append(b" ".join(ids[i : i + n]))
            i += n
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids.split(b" "))) if ids else b""


def _grouped(texts: list[str]) -> Iterator[list[str]]:
    """Texts in turn, in lists of about CHARS characters."""
    group, n = [], 0
    for t in texts:
        group.append(t)
        n += len(t)
        if n >= CHARS:
            yield group
            group, n = [], 0
    if group:
        yield group


def _texts(batch: pa.RecordBatch) -> list[str]:
    return ["" if t is None else t for t in batch.column(1).to_pylist()]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array<int>) of every row; null and empty texts have none, repeated rows are encoded each."""
    content = docs.sparkSession.sparkContext.broadcast(read_ranks(docs.sparkSession, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(content.value)
        for batch in batches:
            ids = [[int(i) for i in e.split()] for group in _grouped(_texts(batch)) for e in codec.encode(group)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
    ).mapInArrow(common.tidy(run), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and body (binary) of rows of doc_id and ids; null ids give an empty body."""
    content = encoded.sparkSession.sparkContext.broadcast(read_ranks(encoded.sparkSession, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(content.value)
        for batch in batches:
            body = [codec.decode(b" ".join(b"%d" % i for i in ids or [])) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(body, pa.binary())], ["doc_id", "body"])

    return encoded.select("doc_id", "ids").mapInArrow(common.tidy(run), "doc_id long, body binary")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes, then decodes the ids, in one pass over the texts."""
    content = docs.sparkSession.sparkContext.broadcast(read_ranks(docs.sparkSession, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(content.value)
        for batch in batches:
            counts, coded, decoded = [], [], []
            for group in _grouped(_texts(batch)):
                for ids in codec.encode(group):
                    counts.append(ids.count(b" ") + 1 if ids else 0)
                    coded.append(hashlib.sha256(ids).hexdigest())
                    decoded.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        common.tidy(run),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(common.table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


def stage_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row of docs; null and empty texts have no tokens.

    Repeated rows and ids are encoded each, a null id stays null; an empty table gives no rows.
    """
    return digests(docs, public_tokenizers.path(RANKS))
