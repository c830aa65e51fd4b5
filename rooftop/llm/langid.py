"""Language identification: averaged hashed subword embeddings and a linear softmax, trained by SGD, with calibrated rejection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from rooftop.llm import common

UNKNOWN = "und"
#: Buckets of the hashed subwords, size of an embedding, lengths of a subword in bytes (word ends count as a byte).
BUCKETS, WIDTH, LENGTHS = 1 << 14, 16, (2, 3, 4)
#: The training sample's bound: about so many labelled rows of each language.
TRAIN_ROWS = 1200
#: Epochs, rows of a step, step size, part of the sample that calibrates, seed.
EPOCHS, STEP_ROWS, RATE, HELD, SEED = 12, 32, 0.5, 0.25, 11
#: Share of right predictions on the calibration rows that rejection may cost.
LOST = 0.001
#: Bytes that are looked at together.
CHUNK = 1 << 20

_BYTES = np.full(256, 32, np.uint8)  # lower-case ASCII letters and bytes of other letters stay, all else ends a word
_BYTES[97:123] = np.arange(97, 123)
_BYTES[128:] = np.arange(128, 256)


def subwords(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: positions of the subwords in a stream of lower-case bytes, and their buckets.

    A subword lies in one word, its ends included; the stream begins and ends with a blank.
    """
    b = _BYTES[data]
    blank = b == 32
    wide = b.astype(np.uint32)
    code, inside = wide, None
    for n in range(2, max(LENGTHS) + 1):
        m = len(b) - n + 1
        if m <= 0:
            return
        code = code[:m] * np.uint32(0x01000193) ^ wide[n - 1 :]
        if n == 2:  # a letter at one end
            ok = ~(blank[:m] & blank[1:])
        else:  # letters between the ends
            inside = ~blank[n - 2 : n - 2 + m] if inside is None else inside[:m] & ~blank[n - 2 : n - 2 + m]
            ok = inside
        if n in LENGTHS:
            at = np.flatnonzero(ok)
            mixed = code[at] * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)
            yield at, mixed >> np.uint32(32 - 14)


@dataclass
class Model:
    """Scores by bucket (embedding times weights), biases, temperature, and the score below which a text is rejected."""

    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    heat: float = 1.0
    least: float = 0.0

    def logits(self, texts: pa.Array) -> np.ndarray:
        """Mean scores of each text's subwords; texts without any get the biases."""
        out = np.zeros((len(texts), len(self.langs)), np.float64)
        counts = np.zeros(len(texts), np.int64)
        for rows, data, starts in _streams(texts):
            for at, bucket in subwords(data):
                row = np.searchsorted(starts, at, "right") - 1
                for i in range(len(self.langs)):
                    out[rows, i] += np.bincount(row, self.table[i][bucket], len(rows))
                counts[rows] += np.bincount(row, minlength=len(rows))
        return out / np.maximum(counts, 1)[:, None] + self.bias

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Languages and scores; und with score 0 for null texts and texts without letters."""
        texts = texts.cast(pa.string())
        letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        p = softmax(self.logits(texts) / self.heat)
        best = p.argmax(1) if len(texts) else np.zeros(0, int)
        return [self.langs[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)], np.where(letters, p[np.arange(len(texts)), best], 0.0)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True)) if len(x) else x
    return e / e.sum(1, keepdims=True) if len(x) else x


def _streams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, their lower-case bytes with a blank between texts, and where each begins; CHUNK bytes at a time."""
    lower = pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), ""))
    rows, bodies, n = [], [], 0
    for i, text in enumerate(lower):
        body = text.as_buffer()
        rows.append(i)
        bodies.append(body.to_pybytes())
        n += body.size
        if n >= CHUNK:
            yield _stream(rows, bodies)
            rows, bodies, n = [], [], 0
    if rows:
        yield _stream(rows, bodies)


def _stream(rows: list[int], bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.cumsum([len(b) + 1 for b in bodies[:-1]], dtype=np.int64)])
    return np.array(rows), np.frombuffer(b" " + b" ".join(bodies) + b" ", np.uint8), starts


def _rows(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text: distinct buckets and their shares."""
    out = []
    for i in range(len(texts)):
        (_, data, _) = next(_streams(texts.slice(i, 1)))
        found = [bucket for _, bucket in subwords(data)]
        bucket, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint32), np.zeros(0))
        out.append((bucket, (n / max(1, n.sum())).astype(np.float32)))
    return out


def train(texts: list[str], langs: list[str]) -> Model:
    """Fits embeddings and weights by stochastic gradient descent; heat and least score come from rows put aside."""
    names = sorted(set(langs), key=lambda s: s.encode())
    if not names:
        return Model([], np.zeros((0, BUCKETS), np.float32), np.zeros(0))
    rng = np.random.default_rng(SEED)
    x, y = _rows(pa.array(texts, pa.string())), np.array([names.index(v) for v in langs])
    order = rng.permutation(len(x))
    held = order[: int(len(x) * HELD)] if len(x) >= 40 else order[:0]
    fit = order[len(held) :]
    embed = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    weight, bias = np.zeros((WIDTH, len(names)), np.float32), np.zeros(len(names), np.float32)
    weight += rng.normal(0, 0.1, weight.shape).astype(np.float32)
    # Languages weigh alike, and steps reach buckets by their share: scaled up to a usual size of a row.
    share = 1 / (np.bincount(y[fit], minlength=len(names)) + 1.0)
    share = share / (share[y[fit]].mean() if len(fit) else 1)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        todo = rng.permutation(fit)
        for at in range(0, len(todo), STEP_ROWS):
            rows = todo[at : at + STEP_ROWS]
            mean = np.stack([w @ embed[b] if len(b) else np.zeros(WIDTH, np.float32) for b, w in (x[r] for r in rows)])
            p = softmax(mean @ weight + bias)
            p[np.arange(len(rows)), y[rows]] -= 1
            p = (p * share[y[rows], None] / len(rows)).astype(np.float32)
            back = p @ weight.T
            weight -= rate * 20 * mean.T @ p
            bias -= rate * p.sum(0)
            for r, g in zip(rows, back, strict=True):
                b, w = x[r]
                embed[b] -= rate * 100 * w[:, None] * g
    model = Model(names, np.ascontiguousarray((embed @ weight).T), bias.astype(np.float64))
    if len(held):
        raw = np.stack([x[r][1] @ model.table.T[x[r][0]] if len(x[r][0]) else np.zeros(len(names)) for r in held]) + model.bias
        heats = np.geomspace(0.05, 20, 60)
        loss = [-np.log(softmax(raw / h)[np.arange(len(held)), y[held]] + 1e-12).mean() for h in heats]
        model.heat = float(heats[int(np.argmin(loss))])
        p = softmax(raw / model.heat)
        right = p.argmax(1) == y[held]
        if right.any():
            model.least = min(float(np.quantile(p.max(1)[right], LOST)), 1.0) * 0.9
    return model


def remainder(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5))


def fit(docs: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Trains on a sample of labelled rows: by hash of the id, about rows of each language, from ids whose remainder isn't 0."""
    known = docs.where(
        F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & (remainder(id_col) != 0)
    ).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return train([], [])
    part = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 30))
    most = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1 << 30, int(rows / n * (1 << 30)) + 1))])
    sample = known.where(part < most[F.col("lang")]).toArrow().sort_by("id")
    return train(sample.column("text").to_pylist(), sample.column("lang").to_pylist())


#: Columns that identify adds; columns of these names in its input are replaced.
ADDED = ("lang_pred", "score", "accepted")


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds lang_pred, score and accepted to docs, without a shuffle.

    Null texts and texts without letters get und and score 0 and aren't accepted, nor are texts whose score is below
    the calibrated least. Whole texts are read; no other column is.
    """
    common.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c not in ADDED]
    docs = docs.select(*names)
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            langs, scores = m.predict(batch.column(at))
            extra = [
                pa.array(langs, pa.string()),
                pa.array(scores, pa.float64()),
                pa.array([lang != UNKNOWN and s >= m.least for lang, s in zip(langs, scores, strict=True)], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*names, "lang_pred", "score", "accepted"])

    schema = StructType(
        [*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("accepted", BooleanType())]
    )
    return docs.mapInArrow(common.tidy(run), schema)


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    out = identify(docs.select("doc_id", (remainder() == 0).alias("held_out"), "text"), fit(docs))
    return out.select("doc_id", "held_out", "lang_pred", "score", "accepted")


def stage_langid(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the operator accepts, with their columns as they are, whatever their names.

    Each row is judged by its text alone, so repeated rows and ids stay together. Null texts and texts without letters
    go; an empty table gives no rows.
    """
    own = {c: f"__own_{c}" for c in docs.columns if c in ADDED}
    kept = identify(docs.withColumnsRenamed(own), fit(docs)).where("accepted").drop(*ADDED)
    return kept.withColumnsRenamed({new: c for c, new in own.items()}).select(*docs.columns)
