"""Rectangular footprints made from the tables part and customer, by SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftop.operators import matching

BLD_B = """
 select cast(p_partkey as bigint) as row_idx,
  350000e0 + (p_partkey % 50)*28 + (p_partkey*7 % 13) as x0,
  6640000e0 + cast(floor(p_partkey/50e0) as int)*28 + (p_partkey*11 % 17) as y0,
  10e0 + p_size % 23 as w,
  12e0 + (p_partkey*5 % 19) as h,
  case when p_partkey % 9 = 0 then null when p_partkey % 97 = 0 then 500e0 when p_partkey % 31 = 0 then 190e0 else p_size*1.1e0 end as height,
  case when p_partkey % 11 = 0 then null when p_partkey % 89 = 0 then 120e0 else cast(1 + floor(p_size/3e0) as double) end as stairs,
  case when p_partkey % 13 = 0 then null when p_partkey % 83 = 0 then 12e0 else 2.6e0 + (p_partkey % 7)*0.1e0 end as avg_floor_height,
  case when p_partkey % 17 = 0 then cast(null as varchar(20)) when p_partkey % 6 = 0 then concat(cast(p_partkey % 40 as varchar(20)),'А') else cast(p_partkey % 40 as varchar(20)) end as number,
  case when p_partkey % 8 = 0 then null else p_brand end as district,
  p_type as type
 from part"""
BLD_A = """
 select cast(c_custkey as bigint) as row_idx,
  350000e0 + (c_custkey % 50)*28 + (c_custkey*5 % 11) as x0,
  6640000e0 + cast(floor(c_custkey/50e0) as int)*28 + (c_custkey*3 % 23) as y0,
  14e0 + (c_custkey*13 % 41) as w,
  11e0 + (c_custkey*17 % 29) as h,
  case when c_custkey % 19 = 0 then null when c_custkey % 71 = 0 then 12e0 else 40e0 + (c_custkey*37 % 3000) end as area_sq_m,
  case when c_custkey % 7 = 0 then null when c_custkey % 67 = 0 then 0e0 else 1e0 + c_custkey % 12 end as gkh_floor_count_min,
  case when c_custkey % 7 = 0 then null else 1e0 + (c_custkey*3) % 14 end as gkh_floor_count_max,
  case when c_custkey % 10 = 0 then null else concat('ул. Тёплая, д. ', cast(c_custkey % 40 as varchar(20)),
  case when c_custkey % 6 = 0 then 'а' else '' end) end as gkh_address
 from customer"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def buildings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Register and survey with boxes, areas and centroids."""
    a = spark.sql(BLD_A.replace("from customer", "from {customer}"), customer=table(spark, sf_dir, "customer"))
    b = spark.sql(BLD_B.replace("from part", "from {part}"), part=table(spark, sf_dir, "part"))
    return matching.rectangle(a), matching.rectangle(b)


def with_wkt(df: DataFrame, name: str = "geom_wkt") -> DataFrame:
    """Adds the rectangle as WKT; every fourth ring runs clockwise."""
    corner = lambda dx, dy: F.concat_ws(
        " ",
        (F.col("x0") + F.col("w") * dx).cast("bigint"),
        (F.col("y0") + F.col("h") * dy).cast("bigint"),
    )
    ccw = F.array(*[corner(*c) for c in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))])
    ring = F.when(F.col("row_idx") % 4 == 0, F.reverse(ccw)).otherwise(ccw)
    return df.withColumn(name, F.concat(F.lit("POLYGON (("), F.array_join(ring, ", "), F.lit("))")))
