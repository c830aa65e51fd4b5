"""CSV sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rooftop.functions.values import no_nan
from rooftop.session import written

#: Columns that the pipeline reads, with their types; others pass through as text.
A_SCHEMA = {
    "id": "string",
    "geometry": "string",
    "area_sq_m": "double",
    "gkh_floor_count_min": "double",
    "gkh_floor_count_max": "double",
    "gkh_address": "string",
    "address": "string",
}
B_SCHEMA = {
    "id": "string",
    "geometry": "string",
    "wkt": "string",
    "height": "double",
    "stairs": "double",
    "avg_floor_height": "double",
    "name_street": "string",
    "number": "string",
    "district": "string",
    "locality": "string",
    "purpose_of_building": "string",
    "type": "string",
}
#: Texts that stand for a missing value.
NULLS = ["", "NA", "N/A", "nan", "NaN", "null", "NULL", "None"]


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """All columns as text, quoted fields with line ends included, and row_idx: a row's place in the files, by name.

    A file whose quoted fields may hold line ends is one task's. Without them (multi_line=False) files are split.
    """
    raw = spark.read.options(header=True, quote='"', escape='"', multiLine=multi_line).csv(path)
    split = {"__f": F.col("_metadata.file_path"), "__b": F.col("_metadata.file_block_start"), "__m": F.monotonically_increasing_id()}
    placed = written(raw.drop(*[c for c in raw.columns if c in ("_c0", "Unnamed: 0", "")]).withColumns(split), "csv")
    before = F.sum("n").over(Window.orderBy("__f", "__b").rowsBetween(Window.unboundedPreceding, -1))  # a row for each file split
    offsets = placed.groupBy("__f", "__b").agg(F.count(F.lit(1)).alias("n"), F.min("__m").alias("__lo")).select(
        "__f",
        "__b",
        "__lo",
        F.coalesce(before, F.lit(0)).alias("__o"),
    )
    placed = placed.join(F.broadcast(offsets), ["__f", "__b"])
    return placed.withColumn("row_idx", F.col("__o") + F.col("__m") - F.col("__lo")).drop("__m", "__f", "__b", "__o", "__lo")


def ensure_columns(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Casts the columns of a schema and adds missing ones as nulls; missing texts and numbers that can't be read are null."""
    found = {
        c: F.when(
            ~F.trim(F.col(c)).isin(NULLS),
            F.col(c),
        ) if t == "string" else F.expr(f"try_cast(`{c}` as {t})") for c, t in schema.items() if c in df.columns
    }
    missing = {c: F.lit(None).cast(t) for c, t in schema.items() if c not in df.columns}
    return no_nan(df.withColumns({**found, **missing}))


def drop_duplicates(df: DataFrame, keys: list[str], order: str = "row_idx") -> DataFrame:
    """The first row of each full duplicate, then of each key; nulls equal nulls. Copies collapse before the shuffle."""
    rest = [c for c in df.columns if c != order]
    df = df.groupBy(*rest).agg(F.min(order).alias(order)).select(*df.columns)
    if not keys:
        return df
    others = [c for c in df.columns if c not in (*keys, order)]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(F.col(order), *others), F.col(order)).alias("__r"))
    return first.select(*[F.col(c) if c in keys else F.col(f"__r.{c}").alias(c) for c in df.columns])


def _load(spark: SparkSession, path: str, schema: dict[str, str], geometry: list[str], multi_line: bool) -> DataFrame:
    raw = read_csv(spark, path, multi_line)
    there = [c for c in geometry if c in raw.columns]
    if not there:
        raise KeyError(f"the source must have a column {' or '.join(geometry)}")
    raw = drop_duplicates(raw, ["id", there[0]] if "id" in raw.columns else [])
    df = ensure_columns(raw, schema)
    return df if there[0] == "geometry" else df.withColumn("geometry", F.col(there[0]))


def load_a(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The register: WKT in geometry, areas, floors, addresses."""
    return _load(spark, path, A_SCHEMA, ["geometry"], multi_line)


def load_b(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The height survey: WKT in geometry, or else in wkt."""
    return _load(spark, path, B_SCHEMA, ["geometry", "wkt"], multi_line)


def load_sources(spark: SparkSession, path_a: str, path_b: str, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    return load_a(spark, path_a, multi_line), load_b(spark, path_b, multi_line)


def save_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with headers; arrays and structs as JSON."""
    plain = [F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("array", "struct", "map") else F.col(f.name) for f in df.schema]
    df.select(*plain).write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)
