"""One query for each operator, over the provided tables, and the same result in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftop import config
from rooftop.functions import geometry, shapes, text
from rooftop.functions.values import array_mean, array_weighted_mean
from rooftop.operators import cleaning, heights, learning, matching, risk, serving, spatial, statistics, topology
from rooftop.plans.fixtures import BLD_A, BLD_B, buildings, table, with_wkt
from rooftop.session import scratch_path, written
from rooftop.sources import geojson, tables
from rooftop.sources import vector_tiles as mvt

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function as a query under its name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _r(*columns: str) -> list:
    return [F.round(c, 6).alias(c) for c in columns]


# ---------------------------------------------------------------- SQL building blocks
FIX = f"with recursive bld_b as ({BLD_B}), bld_a as ({BLD_A})"


def _between(c: str, low: float, high: float) -> str:
    return f"({c} >= {low} and {c} <= {high})"


def _bad(c: str) -> str:
    return f"coalesce(not {_between(c, *config.BOUNDS[c])}, false)"


def _fences(c: str, source: str, name: str) -> str:
    return f"{name} as (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3 from {source})"


CAND = """, cand as (select a.row_idx as idx_a, b.row_idx as idx_b, a.w*a.h as area_a, b.w*b.h as area_b,
  greatest(least(a.x0+a.w, b.x0+b.w) - greatest(a.x0, b.x0), 0e0) * greatest(least(a.y0+a.h, b.y0+b.h) - greatest(a.y0, b.y0), 0e0) as inter_area
 from bld_a a join bld_b b on a.x0 <= b.x0+b.w and b.x0 <= a.x0+a.w and a.y0 <= b.y0+b.h and b.y0 <= a.y0+a.h)"""
PAIRS = CAND + """, pm as (select *, inter_area/nullif(area_a+area_b-inter_area, 0) as iou, inter_area/nullif(area_a, 0) as overlap_a,
  inter_area/nullif(area_b, 0) as overlap_b from cand where inter_area > 0)"""
STRONG = PAIRS + """, strong as (select *, iou >= 0.3 as strong_by_iou, overlap_a >= 0.8 as strong_by_a, overlap_b >= 0.8 as strong_by_b from pm
  where iou >= 0.3 or overlap_a >= 0.8 or overlap_b >= 0.8)"""
MEMBERS = STRONG + """, edges as (select idx_a*2 as u, idx_b*2+1 as v from strong union select idx_b*2+1, idx_a*2 from strong),
 nodes as (select 'A' as source, row_idx, row_idx*2 as node from bld_a union all select 'B', row_idx, row_idx*2+1 from bld_b),
 reach as (select node as v, node as l from nodes union select e.v, r.l from reach r join edges e on e.u = r.v),
 members as (select source, row_idx, min(l) as label from nodes join reach on v = node group by source, row_idx)"""
TYPE = (
    "case when n_a > 0 and n_b = 0 then 'A_only' when n_a = 0 and n_b > 0 then 'B_only' when n_a = 1 and n_b = 1 then '1:1' "
    "when n_a = 1 then '1:N' when n_b = 1 then 'N:1' else 'N:N' end"
)
COMP = MEMBERS + f""", comp0 as (select label, count(*) filter (source = 'A') as n_a, count(*) filter (source = 'B') as n_b,
  min(row_idx) filter (source = 'A') as min_a, min(row_idx) filter (source = 'B') as min_b from members group by label),
 comp as (select label, cast(row_number() over (order by min_a nulls last, min_b) - 1 as bigint) as component_id, n_a, n_b, min_a, min_b,
  {TYPE} as match_type from comp0)"""
METRICS = COMP + """, mets as (select label, max(iou) as max_iou, avg(iou) as mean_iou, max(overlap_a) as max_overlap_a,
  max(overlap_b) as max_overlap_b from strong join members on source = 'A' and row_idx = idx_a group by label)"""
_NORM = r"trim(regexp_replace(regexp_replace(replace(lower(trim({c})), 'ё', 'е'), '[^\pL\pN_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
_HOUSE = r"regexp_extract(' ' || {c} || ' ', '[^\pL\pN_](\d+[а-яa-z]?)[^\pL\pN_]', 1)"
ADDRESS = f""", addr_a as (select row_idx, coalesce({_NORM.format(c="gkh_address")}, '') as address_a_norm from bld_a),
 house_a as (select row_idx, address_a_norm, {_HOUSE.format(c="address_a_norm")} as house_a from addr_a),
 house_b as (select row_idx, coalesce({_NORM.format(c="number")}, '') as house_b from bld_b)"""
VALID = METRICS + ADDRESS + """, sets as (select label, list(distinct house_a) filter (house_a <> '') as ha,
  list(distinct house_b) filter (house_b <> '') as hb from members m left join house_a a on m.source = 'A' and a.row_idx = m.row_idx left
  join house_b b on m.source = 'B' and b.row_idx = m.row_idx group by label),
 valid as (select label, coalesce(len(ha) > 0 and len(hb) > 0 and list_has_any(ha, hb), false) as ok,
  coalesce(len(ha) > 0 and len(hb) > 0 and not list_has_any(ha, hb), false) as conflict from sets)"""
REVIEW = VALID + """, review as (select comp.*, max_iou, mean_iou, max_overlap_a, max_overlap_b, ok, conflict, conflict or coalesce(max_iou < 0.4,
  false) or match_type in ('1:N', 'N:1', 'N:N') as needs_review from comp left join mets using (label) left join valid using (label))"""
_LOW, _HIGH = (f"case when {_between(c, *config.BOUNDS[c])} then {c} end" for c in ("gkh_floor_count_min", "gkh_floor_count_max"))
CLEAN = f""", fa0 as (select row_idx, {_LOW} as lo, {_HIGH} as hi from bld_a),
 fa as (select row_idx, case when lo > hi then hi else lo end as fmin, case when lo > hi then lo else hi end as fmax, (lo + hi)/2 as fmid from fa0),
 fb as (select row_idx, w*h as area, district, type, {", ".join(f"case when {_between(c, *config.BOUNDS[c])} then {c} end as {n}" for c, n in (("height", "hc"), ("stairs", "sc"), ("avg_floor_height", "ac")))} from bld_b)"""
LISTS = CLEAN + """, mb as (select label, count(hc) as nh, count(sc) as ns, count(ac) as nf, avg(sc) as ms, avg(ac) as mf,
  sum(hc*area) filter (hc is not null)/nullif(sum(area) filter (hc is not null), 0) as wh, max(hc) as h1, sum(hc) as sum_h, sum(area) as sum_area,
  arg_min(hc, row_idx) filter (hc is not null) as first_h, arg_min(district, row_idx) filter (district is not null) as district_comp, arg_min(type,
  row_idx) filter (type is not null) as type_comp from members join fb using (row_idx) where source = 'B' group by label),
 ma as (select label, count(fmin) as nmin, count(fmax) as nmax, min(fmin) as fmin, max(fmax) as fmax, avg(fmin) as mmin, avg(fmax) as mmax,
  avg(fmid) as mmid, sum(fmid) as sum_mid from members join fa using (row_idx) where source = 'A' group by label)"""
HEIGHT = LISTS + """, hr as (select r.*, coalesce(nh, 0) as nh, case when nh = 1 then h1 when nh > 1 then wh end as hb, ms*mf as expected,
  case when nmin > 0 and nmax > 0 then fmin*2.8e0 end as lo, case when nmin > 0 and nmax > 0 then fmax*3e0 end as hi from review r left
  join mb using (label) left join ma using (label)),
 hs as (select *, case when nh = 1 then abs(hb - expected) <= 3e0 end as ok_b, case when nh > 0 then hb >= lo and hb <= hi end as agree from hr),
 sel as (select *, case when nh = 0 then (lo + hi)/2 else hb end as height_final,
  case when nh = 1 and ok_b and coalesce(agree, true) then 'B_direct_high' when nh = 1 and not agree then 'B_conflict_with_A' when nh = 1 then 'B_direct_medium'
  when nh > 1 and not agree then 'B_weighted_conflict_with_A' when nh > 1 then 'B_weighted' when lo is not null and hi is not null then 'A_range_only' else 'unknown' end as height_source,
  case when nh = 1 and ok_b and agree then 0.95e0 when nh = 1 and ok_b and agree is null then 0.9e0 when nh = 1 and not agree then 0.6e0 when nh = 1 then 0.8e0
  when nh > 1 and not agree then 0.55e0 when nh > 1 then 0.75e0 when lo is not null and hi is not null then 0.45e0 else 0e0 end as confidence_score from hs)"""
FLAGS = HEIGHT + """, flg as (select *, height_source = 'unknown' or height_final is null as needs_ml,
  needs_review or height_source in ('B_conflict_with_A', 'B_weighted_conflict_with_A') or confidence_score < 0.65 as needs_visual_review from sel)"""
POINTS = FLAGS + """, pts as (select f.*, coalesce(b.x0 + b.w/2, a.x0 + a.w/2) as cx, coalesce(b.y0 + b.h/2, a.y0 + a.h/2) as cy, coalesce(b.w,
  a.w) as pw, coalesce(b.h, a.h) as ph from flg f left join bld_b b on b.row_idx = f.min_b left join bld_a a on a.row_idx = f.min_a)"""


def _rank(c: str) -> str:
    return f"(rank() over (order by {c}) + (count(*) over (partition by {c}) - 1)/2e0)/count({c}) over ()"


RADIUS = (
    "select p.{id} as id, count(q.{id}) as n, coalesce(sum(q.area), 0e0) as s from {t} p left join {t} q on p.{id} <> q.{id} "
    "and (p.cx-q.cx)*(p.cx-q.cx) + (p.cy-q.cy)*(p.cy-q.cy) <= {d} group by p.{id}"
)
DENSE = f""", geo as (select *, pw*ph as area from pts), nb as ({RADIUS.format(t="geo", id="component_id", d="62500e0")}),
 cov as (select geo.*, n as neighbors_250m, s as neighbor_footprint_sum_250m, s/(pi()*62500e0) as coverage_ratio_250m from geo
  join nb on id = component_id),
 thr as (select quantile_cont(neighbors_250m, 0.9) as tn, quantile_cont(coverage_ratio_250m, 0.9) as tc from cov),
 dns as (select cov.*, neighbors_250m >= tn as dense_by_neighbors, coverage_ratio_250m >= tc as dense_by_coverage,
  {_rank("neighbors_250m")}*0.5e0 + {_rank("coverage_ratio_250m")}*0.5e0 as dense_score from cov, thr)"""
RISK_CASE = " ".join(f"when '{k}' then {v}e0" for k, v in config.MATCH_RISK.items())
ECO = DENSE + f""", med as (select median(height_final) as mh
  from dns), er0 as (select dns.*, coalesce(height_final, mh) as hh, n_a + n_b as raw, case match_type {RISK_CASE} else 0.5e0 end as mr
  from dns, med),
 er1 as (select *, {_rank("hh")} as height_score, {_rank("area")} as footprint_score, {_rank("raw")} as complexity from er0),
 er2 as (select *, least(greatest(0.45e0*dense_score + 0.25e0*height_score + 0.15e0*footprint_score + 0.15e0*(0.7e0*mr + 0.3e0*complexity), 0e0),
  1e0) as score from er1),
 eco as (select *, dense_by_neighbors or dense_by_coverage as dense_area,
  case when score <= 0.33 then 'low' when score <= 0.66 then 'medium' else 'high' end as eco_risk_level from er2)"""


# ---------------------------------------------------------------- the same in Spark
def _physically_clean(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    a = cleaning.clean_area(cleaning.clean_floors(cleaning.physical_flags(a, cleaning.A_COLUMNS)))
    b = cleaning.physical_flags(b, cleaning.B_COLUMNS)
    names = {"height": "height_clean_final", "stairs": "stairs_clean", "avg_floor_height": "avg_floor_height_clean"}
    return a, b.withColumns({n: F.when(~F.col(f"{c}_phys_bad"), F.col(c)) for c, n in names.items()})


class Chain:
    """The fixture's tables up to the one that a query needs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.settings = config.Settings()
        self.a, self.b = buildings(spark, sf_dir)

    def pairs(self) -> DataFrame:
        return matching.match_pairs(self.a, self.b, self.settings)

    def strong(self) -> DataFrame:
        return matching.strong_pairs(self.pairs())

    def matched(self) -> Chain:
        self.strong_ = written(self.strong(), "strong")
        self.members = written(matching.membership(self.a, self.b, self.strong_), "members")
        self.components = matching.component_table(self.members)
        return self

    def reviewed(self) -> DataFrame:
        table_ = matching.component_metrics(self.components, self.members, self.strong_)
        return matching.review_flags(matching.address_validation(table_, self.members, *matching.address_features(self.a, self.b)))

    def lists(self) -> DataFrame:
        return heights.member_lists(self.reviewed(), self.members, *_physically_clean(self.a, self.b))

    def selected(self, compat: bool = False) -> DataFrame:
        return heights.pipeline_flags(heights.select_height(self.lists(), compat=compat))

    def points(self) -> DataFrame:
        """Components with the place of their first survey footprint, or of their first register footprint."""
        first = lambda df, s: df.select(F.col("row_idx").alias(f"__{s}"), *[F.col(c).alias(f"{s}_{c}") for c in ("cx", "cy", "w", "h")])
        df = self.selected().withColumns({"__a": F.get("a_idxs", F.lit(0)), "__b": F.get("b_idxs", F.lit(0))})
        df = df.join(first(self.a, "a"), "__a", "left").join(first(self.b, "b"), "__b", "left")
        pick = {c: F.coalesce(f"b_{c}", f"a_{c}") for c in ("cx", "cy", "w", "h")}
        df = df.withColumns(pick).withColumns(
            {"row_idx": F.col("component_id"), "footprint_area_m2": F.col("w") * F.col("h"), "height_final_full": F.col("height_final")}
        )
        return written(df.drop("__a", "__b"), "points")

    def layer(self) -> DataFrame:
        return written(risk.risk_scoring(self.points()), "layer")


def _lisa_stand_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The survey with flags; every seventh row stands for one that local autocorrelation marks."""
    _, b = buildings(spark, sf_dir)
    b = statistics.with_iqr_flags(cleaning.physical_flags(b, cleaning.B_COLUMNS), cleaning.B_COLUMNS)
    b = b.withColumn("lisa_flag", F.col("row_idx") % 7 == 0)
    return cleaning.domain_cap(cleaning.height_clean_final(cleaning.review_groups(cleaning.needs_review(b))))


_IQR3 = ", ".join(f"{_fences(c, 'bld_b', f'f{i}')}" for i, c in enumerate(cleaning.B_COLUMNS))
_IQR_BAD = {
    c: f"coalesce({c} < f{i}.q1 - 1.5*(f{i}.q3 - f{i}.q1) or {c} > f{i}.q3 + 1.5*(f{i}.q3 - f{i}.q1), false)" for i, c in enumerate(cleaning.B_COLUMNS)
}
FLAGGED = f"""{FIX}, {_IQR3}, fl as (select bld_b.*, {", ".join(f"{_bad(c)} as {c}_p, {_IQR_BAD[c]} as {c}_i" for c in cleaning.B_COLUMNS)},
  row_idx % 7 = 0 as lisa from bld_b, f0, f1, f2)"""


# ---------------------------------------------------------------- matching
@query(
        f"{FIX}{STRONG} select idx_a, idx_b, round(inter_area, 6) as inter_area, round(iou, 6) as iou, round(overlap_a, 6) as "
        f"overlap_a, round(overlap_b, 6) as overlap_b, strong_by_iou, strong_by_a, strong_by_b from strong"
)
def strong_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Chain(spark, sf_dir).strong().select(
        "idx_a",
        "idx_b",
        *_r("inter_area", "iou", "overlap_a", "overlap_b"),
        "strong_by_iou",
        "strong_by_a",
        "strong_by_b",
    )


@query(f"{FIX}{CAND} select idx_a, idx_b from cand")
def bbox_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.candidates(*buildings(spark, sf_dir)).select("idx_a", "idx_b")


@query(
        f"{FIX}{PAIRS} select idx_a, idx_b, round(inter_area, 6) as inter_area, area_a, area_b, round(iou, 6) as iou, round(overlap_a, "
        f"6) as overlap_a, round(overlap_b, 6) as overlap_b from pm"
)
def pair_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Chain(spark, sf_dir).pairs().select("idx_a", "idx_b", "area_a", "area_b", *_r("inter_area", "iou", "overlap_a", "overlap_b"))


@query(SQL["pair_metrics"])
def polygon_pair_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (with_wkt(x) for x in buildings(spark, sf_dir))
    return matching.match_pairs(a, b, config.Settings(), polygons=True).select(
        "idx_a",
        "idx_b",
        "area_a",
        "area_b",
        *_r("inter_area", "iou", "overlap_a", "overlap_b"),
    )


@query(f"{FIX}{MEMBERS} select source, row_idx, label from members")
def connected_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Chain(spark, sf_dir).matched().members


@query(f"{FIX}{COMP} select component_id, label, n_a, n_b, match_type, min_a, min_b from comp")
def component_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = Chain(spark, sf_dir).matched().components
    return df.select(
        "component_id",
        "label",
        F.col("n_a").cast("long").alias("n_a"),
        F.col("n_b").cast("long").alias("n_b"),
        "match_type",
        F.get("a_idxs", F.lit(0)).alias("min_a"),
        F.get("b_idxs", F.lit(0)).alias("min_b"),
    )


@query(
        f"{FIX}{COMP} select component_id, list(row_idx order by cast(row_idx as varchar)) filter (source = 'A') as a_idxs, "
        f"list(row_idx order by cast(row_idx as varchar)) filter (source = 'B') as b_idxs from members join comp using (label) "
        f"group by component_id".replace("list(", "array_to_string(list(").replace("as a_idxs", ", ',') as a_idxs").replace("as b_idxs", ", ',') as b_idxs")
)
def component_members_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = matching.component_table(Chain(spark, sf_dir).matched().members, compat=True)
    return df.select("component_id", *[F.when(F.size(c) > 0, F.array_join(c, ",")).alias(c) for c in ("a_idxs", "b_idxs")])


@query(
        f"{FIX}{COMP} select match_type, count(*) as components, cast(sum(n_a) as bigint) as rows_a, cast(sum(n_b) as bigint) as rows_b "
        f"from comp group by match_type"
)
def match_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Chain(spark, sf_dir).matched().components.groupBy("match_type").agg(
        F.count(F.lit(1)).alias("components"),
        F.sum("n_a").cast("long").alias("rows_a"),
        F.sum("n_b").cast("long").alias("rows_b"),
    )


@query(
        f"{FIX}{METRICS} select component_id, round(max_iou, 6) as max_iou, round(mean_iou, 6) as mean_iou, round(max_overlap_a, 6) as "
        f"max_overlap_a, round(max_overlap_b, 6) as max_overlap_b from comp left join mets using (label)"
)
def component_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Chain(spark, sf_dir).matched()
    return matching.component_metrics(c.components, c.members, c.strong_).select(
        "component_id",
        *_r("max_iou", "mean_iou", "max_overlap_a", "max_overlap_b"),
    )


@query(
        f"{FIX}{ADDRESS} select 'A' as source, row_idx, address_a_norm as address, house_a as house from house_a union all "
        f"select 'B', row_idx, '', house_b from house_b"
)
def address_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = matching.address_features(*buildings(spark, sf_dir))
    return a.select(F.lit("A").alias("source"), "row_idx", F.col("address_a_norm").alias("address"), F.col("house_a").alias("house")).unionByName(
        b.select(F.lit("B").alias("source"), "row_idx", F.col("street_b").alias("address"), F.col("house_b").alias("house"))
    )


@query(f"{FIX}{REVIEW} select component_id, ok as address_match_strong, ok as address_match_weak, conflict as address_conflict from review")
def address_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Chain(spark, sf_dir).matched().reviewed().select("component_id", "address_match_strong", "address_match_weak", "address_conflict")


@query(f"{FIX}{REVIEW} select component_id, match_type, needs_review from review")
def component_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Chain(spark, sf_dir).matched().reviewed().select("component_id", "match_type", "needs_review")


@query(
        f"{FIX}{COMP}, box as (select label, 'A' as source, x0, y0, x0+w as x1, y0+h as y1 from members join bld_a using (row_idx) "
        f"where source = 'A' union all select label, 'B', x0, y0, x0+w, y0+h from members join bld_b using (row_idx) "
        f"where source = 'B') select component_id, min(x0) as minx, min(y0) as miny, max(x1) as maxx, max(y1) as maxy from comp "
        f"join box using (label) where source = case when n_b > 0 then 'B' else 'A' end group by component_id"
)
def component_geometry_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Chain(spark, sf_dir).matched()
    df = matching.component_geometry(c.components, c.members, with_wkt(c.a), with_wkt(c.b))
    return df.select("component_id", *[v.alias(k) for k, v in geometry.box(geometry.parse_wkt(F.col("geom_wkt"))).items()])


# ---------------------------------------------------------------- cleaning
_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


@query(
        f"with d as (select distinct {_KEYS} from lineitem), n as (select *, row_number() over (partition by l_orderkey, l_linenumber "
        f"order by l_partkey, l_suppkey, l_quantity, l_extendedprice) as k from d) select {_KEYS} from n where k = 1"
)
def dedupe_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _KEYS.split(", ")
    df = table(spark, sf_dir, "lineitem").select(*names).withColumn("row_idx", F.struct(*names[2:]))
    return tables.drop_duplicates(df, names[:2]).select(*names)


@query(f"{FIX} select row_idx, {', '.join(f'{c} is null as {c}_is_nan, {_bad(c)} as {c}_phys_bad' for c in cleaning.B_COLUMNS)} from bld_b")
def physical_flags_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = cleaning.physical_flags(buildings(spark, sf_dir)[1], cleaning.B_COLUMNS)
    return df.select("row_idx", *[f"{c}_{x}" for c in cleaning.B_COLUMNS for x in ("is_nan", "phys_bad")])


@query(
        f"{FIX} select row_idx, {', '.join(f'{c} is null as {c}_is_nan, {_bad(c)} as {c}_phys_bad' for c in cleaning.A_COLUMNS)}, "
        f"coalesce(gkh_floor_count_min > gkh_floor_count_max, false) as gkh_min_gt_max from bld_a"
)
def physical_flags_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = cleaning.physical_flags(buildings(spark, sf_dir)[0], cleaning.A_COLUMNS)
    return df.select("row_idx", *[f"{c}_{x}" for c in cleaning.A_COLUMNS for x in ("is_nan", "phys_bad")], "gkh_min_gt_max")


@query(
        "with f as (select quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from events) "
        "select event_id, round(q1, 6) as value_q1, round(q3, 6) as value_q3, round(q3 - q1, 6) as value_iqr, coalesce(value < q1 - "
        "1.5*(q3 - q1) or value > q3 + 1.5*(q3 - q1), false) as value_iqr_bad from events, f"
)
def iqr_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.with_iqr_flags(table(spark, sf_dir, "events"), ["value"]).select(
        "event_id",
        *_r("value_q1", "value_q3", "value_iqr"),
        "value_iqr_bad",
    )


@query(
        f"{FLAGGED}, c as (select *, case when not height_p and not height_i then height end as clean from fl), "
        f"m as (select avg(clean) as mean, stddev_samp(clean) as std from c) "
        f"select row_idx, round(clean, 6) as height_clean_for_lisa, round(mean, 6) as height_mean_for_lisa, round(std, 6) as "
        f"height_std_for_lisa, round((height - mean)/nullif(std, 0), 6) as height_z from c, m"
)
def height_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = statistics.with_zscore(cleaning.height_for_lisa(_lisa_stand_in(spark, sf_dir)))
    return df.select("row_idx", *_r("height_clean_for_lisa", "height_mean_for_lisa", "height_std_for_lisa", "height_z"))


@query(
        f"{FLAGGED} select row_idx, height_p or height_i as height_needs_review, height_p or height_i or lisa as needs_review, case "
        f"when height_p then 'physical_bad' when height_i and lisa then 'iqr_and_lisa' when lisa then 'lisa_only' "
        f"when height_i then 'iqr_only' else 'clean' end as review_group from fl"
)
def review_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lisa_stand_in(spark, sf_dir).select("row_idx", "height_needs_review", "needs_review", "review_group")


@query(
        f"{FLAGGED} select row_idx, case when not (height_p or (height_i and lisa)) then height end as height_clean_final, case "
        f"when height_i and lisa then 'iqr_and_lisa' when height_p then 'physical_bounds' end as height_drop_reason, false as "
        f"height_domain_cap_bad from fl"
)
def height_clean_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lisa_stand_in(spark, sf_dir).select("row_idx", "height_clean_final", "height_drop_reason", "height_domain_cap_bad")


@query(
        f"{FLAGGED} select row_idx, case when not (stairs_p or stairs_i) then stairs end as stairs_clean, case when stairs_i then 'iqr' "
        f"when stairs_p then 'physical_bounds' end as stairs_drop_reason, case "
        f"when not (avg_floor_height_p or avg_floor_height_i) then avg_floor_height end as avg_floor_height_clean, case "
        f"when avg_floor_height_i then 'iqr' when avg_floor_height_p then 'physical_bounds' end as avg_floor_height_drop_reason from fl"
)
def clean_stairs_and_floor_height(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = cleaning.clean_by_flags(
        cleaning.clean_by_flags(_lisa_stand_in(spark, sf_dir), "stairs", "stairs_clean"),
        "avg_floor_height",
        "avg_floor_height_clean",
    )
    return df.select("row_idx", "stairs_clean", "stairs_drop_reason", "avg_floor_height_clean", "avg_floor_height_drop_reason")


@query(f"{FIX}{CLEAN} select row_idx, fmin as gkh_floor_count_min_clean, fmax as gkh_floor_count_max_clean, fmid as gkh_floor_mid from fa")
def clean_gkh_floors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _physically_clean(*buildings(spark, sf_dir))[0].select(
        "row_idx",
        "gkh_floor_count_min_clean",
        "gkh_floor_count_max_clean",
        "gkh_floor_mid",
    )


@query(
        f"{FIX} select row_idx, case when {_between('area_sq_m', 30, 20000)} then area_sq_m end as area_sq_m_clean, "
        f"coalesce({_between('area_sq_m', 30, 20000)} and area_sq_m < 20, false) as area_sq_m_small_flag from bld_a"
)
def clean_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _physically_clean(*buildings(spark, sf_dir))[0].select("row_idx", "area_sq_m_clean", "area_sq_m_small_flag")


@query(
    FLAGGED + f""" select unnest(['a_rows', 'a_gkh_min_phys_bad', 'a_gkh_max_phys_bad', 'a_gkh_min_gt_max', 'a_area_phys_bad',
  'a_area_small']) as counter, unnest([count(*), count(*) filter ({_bad("gkh_floor_count_min")}), count(*) filter ({_bad("gkh_floor_count_max")}),
  count(*) filter (gkh_floor_count_min > gkh_floor_count_max), count(*) filter ({_bad("area_sq_m")}), 0]) as n from bld_a
 union all select unnest(['b_rows', 'b_height_clean', 'b_stairs_clean', 'b_afh_clean', 'b_stairs_phys_bad', 'b_afh_phys_bad']), unnest([count(*),
  count(height) filter (not (height_p or (height_i and lisa))), count(stairs) filter (not (stairs_p or stairs_i)),
  count(avg_floor_height) filter (not (avg_floor_height_p or avg_floor_height_i)), count(*) filter (stairs_p), count(*) filter (avg_floor_height_p)])
  from fl"""
)
def cleaning_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = cleaning.clean_a(buildings(spark, sf_dir)[0], config.Settings()), _lisa_stand_in(spark, sf_dir)
    return cleaning.summary(
        a,
        cleaning.clean_by_flags(cleaning.clean_by_flags(b, "stairs", "stairs_clean"), "avg_floor_height", "avg_floor_height_clean"),
    )


@query(
        f"{FLAGGED} select count(*) as rows, count(height) as height_raw, count(*) filter (height_p) as height_phys_bad, count(*) "
        f"filter (height_i) as height_iqr_bad, count(*) filter (lisa) as height_lisa, count(*) filter (height_p or height_i or lisa) as "
        f"height_needs_review, count(height) filter (not (height_p or (height_i "
        f"and lisa))) as height_clean, 0::bigint as height_domain_cap from fl"
)
def height_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.height_summary(_lisa_stand_in(spark, sf_dir))


# ---------------------------------------------------------------- heights
@query(
        f"{FIX}{REVIEW}{LISTS} select component_id, coalesce(nh, 0) as heights, coalesce(ns, 0) as stairs, coalesce(nf, 0) as "
        f"floor_heights, coalesce(round(sum_h, 6), 0) as sum_height, coalesce(sum_area, 0) as sum_area, first_h as first_height, "
        f"coalesce(nmin, 0) as floor_mins, coalesce(nmax, 0) as floor_maxs, coalesce(sum_mid, 0) as sum_mid from comp left "
        f"join mb using (label) left join ma using (label)"
)
def member_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda x, y: x + y)
    n = lambda c: F.size(c).cast("long")
    df = Chain(spark, sf_dir).matched().lists()
    return df.select(
        "component_id",
        n("b_height_values").alias("heights"),
        n("b_stairs_values").alias("stairs"),
        n("b_afh_values").alias("floor_heights"),
        F.round(total("b_height_values"), 6).alias("sum_height"),
        total("b_area_values").alias("sum_area"),
        F.get("b_height_values", F.lit(0)).alias("first_height"),
        n("a_floor_min_values").alias("floor_mins"),
        n("a_floor_max_values").alias("floor_maxs"),
        total("a_floor_mid_values").alias("sum_mid"),
    )


@query(
        f"{FIX}{REVIEW}{LISTS} select component_id, round(ms, 6) as stairs_clean_component, round(mf, 6) as avg_floor_height_component, "
        f"round(mmin, 6) as a_floor_min_component, round(mmax, 6) as a_floor_max_component, round(mmid, 6) as a_floor_mid_component, "
        f"district_comp, type_comp from comp left join mb using (label) left join ma using (label)"
)
def baseline_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Chain(spark, sf_dir).matched()
    df = heights.baseline_features(c.components, c.members, *_physically_clean(c.a, c.b))
    return df.select(
        "component_id",
        *_r("stairs_clean_component", "avg_floor_height_component", "a_floor_min_component", "a_floor_max_component", "a_floor_mid_component"),
        "district_comp",
        "type_comp",
    )


@query(f"{FIX}{REVIEW}{LISTS} select component_id, round(wh, 6) as weighted_height, round(ms, 6) as mean_stairs from comp left join mb using (label)")
def weighted_height(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = Chain(spark, sf_dir).matched().lists()
    return df.select(
        "component_id",
        F.round(array_weighted_mean(F.col("b_height_values"), F.col("b_height_areas")), 6).alias("weighted_height"),
        F.round(array_mean(F.col("b_stairs_values")), 6).alias("mean_stairs"),
    )


@query(
        f"{FIX}{REVIEW}{HEIGHT} select component_id, round(height_final, 6) as height_final, height_source, confidence_score, ok_b as "
        f"b_internal_ok, agree as a_agree_with_b from sel"
)
def height_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Chain(spark, sf_dir).matched().selected().select(
        "component_id",
        *_r("height_final"),
        "height_source",
        "confidence_score",
        "b_internal_ok",
        "a_agree_with_b",
    )


COMPAT = f"""{FIX}{REVIEW}{LISTS}, lb as (select label, list(hc order by row_idx) filter (hc is not null) as hcs, list(area order by row_idx) as areas
  from members join fb using (row_idx) where source = 'B' group by label),
 hb as (select label, len(hcs) as n, hcs[1] as h1, sum(hcs[i]*areas[i])/nullif(sum(areas[i]), 0) as hw from lb, unnest(range(1, len(hcs) + 1)) t(i)
  where len(hcs) > 0 group by label, hcs),
 hc as (select r.component_id, coalesce(n, 0) as n, case when n = 1 then hb.h1 else hw end as h, ms*mf as expected,
  case when nmin > 0 and nmax > 0 then fmin*2.8e0 end as lo, case when nmin > 0 and nmax > 0 then fmax*3e0 end as hi
  from comp r left join hb using (label) left join mb using (label) left join ma using (label)),
 hd as (select *, n = 1 and abs(h - expected) <= 3e0 as ok, case when n > 0 then h >= lo and h <= hi end as agree from hc)
 select component_id, round(case when n > 0 then h else (lo + hi)/2 end, 6) as height_final,
  case when n = 1 and ok and agree is null then 'B_direct_high' when n = 1 then 'B_direct_medium' when n > 1 then 'B_weighted'
  when lo is not null and hi is not null then 'A_range_only' else 'unknown' end as height_source,
  case when n = 1 and ok and agree is null then 0.9e0 when n = 1 then 0.8e0 when n > 1 then 0.75e0 when lo is not null and hi is not null then 0.45e0 else 0e0 end as confidence_score
  from hd"""


@query(COMPAT)
def height_selection_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Chain(spark, sf_dir).matched().selected(compat=True).select("component_id", *_r("height_final"), "height_source", "confidence_score")


@query(
        f"{FIX}{REVIEW}{FLAGS} select component_id, needs_ml, needs_visual_review, height_final is not null and not needs_ml "
        f"and not needs_visual_review as ready_for_use from flg"
)
def pipeline_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Chain(spark, sf_dir).matched().selected().select("component_id", "needs_ml", "needs_visual_review", "ready_for_use")


# ---------------------------------------------------------------- neighbourhoods
_PTS_B = "pt as (select row_idx, x0 + w/2 as cx, y0 + h/2 as cy, w*h as area from bld_b)"


@query(
        f"{FIX}, {_PTS_B} select p.row_idx as id, q.row_idx as other from pt p join pt q on p.row_idx <> q.row_idx "
        f"and (p.cx-q.cx)*(p.cx-q.cx) + (p.cy-q.cy)*(p.cy-q.cy) <= 2500e0"
)
def distance_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.radius_pairs(buildings(spark, sf_dir)[1], 50.0).select("id", "other")


@query(
        f"{FIX}, {_PTS_B} select row_idx, not exists (select 1 from pt q where p.row_idx <> q.row_idx "
        f"and (p.cx-q.cx)*(p.cx-q.cx) + (p.cy-q.cy)*(p.cy-q.cy) <= 400e0) as is_island from pt p"
)
def islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.with_islands(buildings(spark, sf_dir)[1], 20.0).select("row_idx", "is_island")


def _zscored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(
        spatial.with_islands(written(statistics.with_zscore(cleaning.height_for_lisa(_lisa_stand_in(spark, sf_dir))), "scored"), 200.0),
        "islands",
    )


@query(
    f"""{FLAGGED}, c as (select *, x0 + w/2 as cx, y0 + h/2 as cy, case when not height_p and not height_i then height end as clean
  from fl), m as (select avg(clean) as mean, stddev_samp(clean) as std from c),
 y as (select row_idx, cx, cy, (height - mean)/nullif(std, 0) as hz from c, m where height is not null), ym as (select avg(hz) as mz
  from y), z as (select row_idx, cx, cy, hz - mz as z from y, ym), ss as (select sum(z*z) as ss, count(*) as n from z),
 lag as (select p.row_idx, p.z, count(q.z) as k, avg(q.z) as lag from z p left
  join z q on p.row_idx <> q.row_idx and (p.cx-q.cx)*(p.cx-q.cx) + (p.cy-q.cy)*(p.cy-q.cy) <= 40000e0 group by p.row_idx, p.z)
 select row_idx, k, round(lag, 5) as lag, round((n - 1)*z*lag/ss, 5) as lisa_i,
  case when lag is null then null when z > 0 and lag > 0 then 1 when z <= 0 and lag > 0 then 2 when z <= 0 then 3 else 4 end as lisa_quad
  from lag, ss"""
)
def lisa_local_i(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spatial.local_moran(_zscored(spark, sf_dir), 200.0)
    return df.select("row_idx", "k", F.round("lag", 5).alias("lag"), F.round("lisa_I", 5).alias("lisa_i"), "lisa_quad")


@query()
def lisa_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = cleaning.clean_b(buildings(spark, sf_dir)[1], config.Settings())
    return df.select("row_idx", "is_island", "lisa_I", "lisa_p", "lisa_quad", "lisa_flag", "review_group", "height_clean_final")


@query(
        f"{FIX}, {_PTS_B}, nb as ({RADIUS.format(t='pt', id='row_idx', d='62500e0')}) "
        f"select id as row_idx, n as neighbors_250m, s as neighbor_footprint_sum_250m from nb"
)
def radius_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spatial.neighbour_sums(buildings(spark, sf_dir)[1].withColumn("footprint_area_m2", F.col("area")), 250.0)
    return df.select("row_idx", "neighbors_250m", "neighbor_footprint_sum_250m")


@query(f"select o_orderkey, round({_rank('o_totalprice')}, 9) as rank_pct from orders")
def rank_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.with_rank_pct(
        table(spark, sf_dir, "orders"),
        {"o_totalprice": "rank_pct"},
    ).select("o_orderkey", F.round("rank_pct", 9).alias("rank_pct"))


@query(
        "select round(quantile_cont(l_extendedprice, 0.1), 6) as p10, round(quantile_cont(l_extendedprice, 0.5), "
        "6) as p50, round(quantile_cont(l_extendedprice, 0.9), 6) as p90 from lineitem"
)
def exact_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.quantiles(
        table(spark, sf_dir, "lineitem"),
        "l_extendedprice",
        [0.1, 0.5, 0.9],
    ).toDF("p10", "p50", "p90").select(*_r("p10", "p50", "p90"))


# ---------------------------------------------------------------- risk
@query(
        f"{FIX}{REVIEW}{POINTS}{DENSE} select component_id, neighbors_250m, round(coverage_ratio_250m, 9) as coverage_ratio_250m, "
        f"dense_by_neighbors, dense_by_coverage, dense_by_neighbors or dense_by_coverage as dense_area, round(dense_score, 9) as "
        f"dense_score from dns"
)
def dense_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = risk.dense_development(Chain(spark, sf_dir).matched().points())
    return df.select(
        "component_id",
        "neighbors_250m",
        F.round("coverage_ratio_250m", 9).alias("coverage_ratio_250m"),
        "dense_by_neighbors",
        "dense_by_coverage",
        "dense_area",
        F.round("dense_score", 9).alias("dense_score"),
    )


@query(
        f"{FIX}{REVIEW}{POINTS}{ECO} select component_id, round(height_score, 9) as height_score, round(footprint_score, 9) as "
        f"footprint_score, mr as match_risk_score, round(complexity, 9) as component_complexity_score, round(score, 6) as "
        f"eco_risk_score, eco_risk_level from eco"
)
def eco_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = Chain(spark, sf_dir).matched().layer()
    return df.select(
        "component_id",
        *[F.round(c, 9).alias(c) for c in ("height_score", "footprint_score", "component_complexity_score")],
        "match_risk_score",
        *_r("eco_risk_score"),
        "eco_risk_level",
    )


# ---------------------------------------------------------------- learning
_SIDES = "4*pi()*w*h/((2*(w+h))*(2*(w+h)) + 1e-6)"


@query(
        f"{FIX} select row_idx, w*h as area, 2*(w+h) as perimeter, round({_SIDES}, 9) as compactness, w as bbox_width, h as "
        f"bbox_height, round(w/(h + 1e-6), 9) as elongation, round(x0 + w/2, 6) as cx, round(y0 + h/2, 6) as cy from bld_b"
)
def shape_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_wkt(buildings(spark, sf_dir)[1]).select("row_idx", geometry.parse_wkt(F.col("geom_wkt")).alias("s"))
    s = F.col("s")
    df = learning.shape_features(
        df.select(
            "row_idx",
            geometry.area(s).alias("area"),
            geometry.perimeter(s).alias("perimeter"),
            *[v.alias(k) for k, v in {**geometry.box(s), **geometry.centroid(s)}.items()],
        )
    )
    return df.select(
        "row_idx",
        "area",
        "perimeter",
        F.round("compactness", 9).alias("compactness"),
        "bbox_width",
        "bbox_height",
        F.round("elongation", 9).alias("elongation"),
        *_r("cx", "cy"),
    )


@query(
    f"{FIX} select row_idx, concat(cast(floor((x0 + w/2)/2000) as bigint), '_', cast(floor((y0 + h/2)/2000) as bigint)) as spatial_group from bld_b"
)
def spatial_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learning.spatial_groups(buildings(spark, sf_dir)[1]).select("row_idx", "spatial_group")


@query(
        f"{FIX}, pt as (select row_idx, x0 + w/2 as cx, y0 + h/2 as cy, height from bld_b), tr as (select * from pt "
        f"where height is not null), d as (select p.row_idx, t.row_idx as o, t.height, sqrt((p.cx-t.cx)*(p.cx-t.cx) + "
        f"(p.cy-t.cy)*(p.cy-t.cy)) as d from pt p, tr t), r as (select *, row_number() over (partition by row_idx order by d, o) as k "
        f"from d) select row_idx, round(avg(height), 6) as knn_height_mean, round(avg(d), 6) as knn_dist_mean from r where k <= 5 "
        f"group by row_idx"
)
def knn_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = buildings(spark, sf_dir)[1]
    return learning.knn_features(b, b.where("height is not null"), 5, 100.0, "height").select("row_idx", *_r("knn_height_mean", "knn_dist_mean"))


@query(f"""{FIX}, grp as (select concat(cast(floor((x0 + w/2)/200) as bigint), '_', cast(floor((y0 + h/2)/200) as bigint)) as spatial_group, count(*) as size from bld_b group by 1),
 ord as (select *, row_number() over (order by size desc, spatial_group) as i from grp),
 deal as (select 0::bigint as i, ''::varchar as spatial_group, 0::bigint as size, 0::bigint as fold, list_resize([]::bigint[], least(5, count(*)), 0) as loads from ord
  union all select o.i, o.spatial_group, o.size, list_position(loads, list_min(loads)) - 1,
  list_concat(list_concat(loads[:list_position(loads, list_min(loads)) - 1], [list_min(loads) + o.size]), loads[list_position(loads, list_min(loads)) + 1:])
  from deal d join ord o on o.i = d.i + 1)
 select spatial_group, size, fold::int as fold from deal where i > 0""")
def spatial_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learning.folds(learning.spatial_groups(buildings(spark, sf_dir)[1], 200.0), 5)


def _to_learn(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = Chain(spark, sf_dir).matched().points()
    return df.withColumns(
        {
            "area": F.col("footprint_area_m2"),
            "perimeter": 2 * (F.col("w") + F.col("h")),
            "minx": F.col("cx") - F.col("w") / 2,
            "maxx": F.col("cx") + F.col("w") / 2,
            "miny": F.col("cy") - F.col("h") / 2,
            "maxy": F.col("cy") + F.col("h") / 2,
        }
    ).drop("height_final_full")


@query()
def ml_cv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = learning.shape_features(_to_learn(spark, sf_dir)).where("height_final > 0")
    return learning.spatial_cv(train, config.Settings(group_cell=400.0))


@query()
def ml_fill_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, _ = learning.fill_heights(_to_learn(spark, sf_dir), config.Settings())
    return df.select("component_id", "height_final", "height_ml", "ml_model_name", "height_final_full", "height_source_full")


@query(
        f"{FIX}{REVIEW}{FLAGS} select component_id, case when height_final > 0 then height_final end as height_final, cast(n_a as "
        f"bigint) as n_a, cast(n_b as bigint) as n_b, round(max_iou, 6) as max_iou, match_type from flg"
)
def clean_for_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = Chain(spark, sf_dir).matched().selected().withColumn("row_idx", F.col("component_id"))
    df = learning.clean_for_model(df, ["n_a", "n_b", "max_iou", "match_type"])
    return df.select(
        F.col("row_idx").alias("component_id"),
        "height_final",
        F.col("n_a").cast("long").alias("n_a"),
        F.col("n_b").cast("long").alias("n_b"),
        *_r("max_iou"),
        "match_type",
    )


@query("""with e as (select l_extendedprice::double as y, l_extendedprice - l_quantity*900::double as e from lineitem)
 select round(avg(abs(e)), 4) as mae, round(sqrt(avg(e*e)), 4) as rmse, round(1 - sum(e*e)/(var_pop(y)*count(*)), 6) as r2, count(*) as n from e""")
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 900).alias("prediction"))
    return learning.metrics(df).select(
        F.round("MAE", 4).alias("mae"),
        F.round("RMSE", 4).alias("rmse"),
        F.round("R2", 6).alias("r2"),
        F.lit(df.count()).cast("long").alias("n"),
    )


# ---------------------------------------------------------------- geometry
# Shapes of every kind at (x, y), s wide: what is wrong with each and what its repair leaves are known.
_SHAPES = {  # kind: (text, is_valid, reason, type, area as it is, wrong orientation, area after repair)
    0: ("'POLYGON ((x0 y0, x1 y0, x1 y1, x0 y1, x0 y0))'", "true", "'Valid Geometry'", "'Polygon'", "s*s", "false", "s*s"),
    1: ("'POLYGON ((x0 y0, x1 y1, x1 y0, x0 y1, x0 y0))'", "false", "'Self-intersection'", "'Polygon'", "0", "false", "s*s/2"),
    2: (
        "'POLYGON ((x0 y0, x0 y1, x1 y1, x1 y0, x0 y0), (xa ya, xa yb, xb yb, xb ya, xa ya))'",
        "true",
        "'Valid Geometry'",
        "'Polygon'",
        "s*s - s*s/16",
        "true",
        "s*s - s*s/16",
    ),
    3: ("'POLYGON ((x0 y0, x1 y0, x1 y1, x0 y1))'", "false", "'Ring is not closed'", "'Polygon'", "null", "null", "s*s"),
    4: ("'POLYGON EMPTY'", "true", "'Valid Geometry'", "'Polygon'", "0", "false", "0"),
    5: ("null", "false", "null", "null", "null", "false", "null"),
    6: (
        "'MULTIPOLYGON (((x0 y0, x1 y0, x1 y1, x0 y0)), ((x0 y0, x1 y1, x0 y1, x0 y0)))'",
        "false",
        "'Self-intersection'",
        "'MultiPolygon'",
        "s*s",
        "false",
        "s*s",
    ),
    7: (
            "'GEOMETRYCOLLECTION (POINT (x0 y0), LINESTRING (x0 y0, x1 y1), POLYGON ((x0 y0, x1 y0, x1 y1, x0 y1, x0 y0)), "
            "MULTIPOLYGON (((xa ya, xb ya, xb yb, xa ya))))'",
        "true",
        "'Valid Geometry'",
        "'GeometryCollection'",
        "s*s + s*s/32",
        "false",
        "s*s",
    ),
    8: ("'LINESTRING (x0 y0, x1 y1, x1 y0)'", "true", "'Valid Geometry'", "'LineString'", "0", "false", "null"),
    9: (
        "'GEOMETRYCOLLECTION (POINT (x1 y1), MULTIPOLYGON (((x0 y0, xa y0, xa ya, x0 y0)), ((xb yb, x1 yb, x1 y1, xb yb))))'",
        "true",
        "'Valid Geometry'",
        "'GeometryCollection'",
        "s*s/32 + s*s/8",
        "false",
        "s*s/32 + s*s/8",
    ),
}
_CORNERS = {"x0": "x", "y0": "y", "x1": "x + s", "y1": "y + s", "xa": "x + s/4", "ya": "y + s/4", "xb": "x + s/2", "yb": "y + s/2"}


def _with_corners(text_: str) -> str:
    for k, v in _CORNERS.items():
        text_ = f"replace({text_}, '{k}', cast(cast({v} as bigint) as varchar(20)))"
    return text_


def _of_kind(i: int) -> str:
    return "case kind " + " ".join(f"when {k} then {v[i]}" for k, v in _SHAPES.items()) + " end"


BROKEN = f"""broken as (select *, {_with_corners(_of_kind(0))} as geometry from
 (select cast(p_partkey as bigint) as row_idx, p_partkey % 10 as kind, 1000e0 + p_partkey*40 as x, 2000e0 + (p_partkey % 31)*40 as y,
  4e0*(1 + p_size % 5) as s from part) p)"""


def _broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        f"with {BROKEN.replace('from part', 'from {part}')} select row_idx, kind, s, geometry from broken",
        part=table(spark, sf_dir, "part"),
    )


@query(f"""with {BROKEN} select row_idx, kind = 5 as is_missing, kind = 4 as is_empty, {_of_kind(1)} as is_valid, {_of_kind(2)} as valid_reason,
  {_of_kind(3)} as geom_type, kind <> 3 and {_of_kind(4)} <= 1e-9 and kind <> 4 as bad_area,
 coalesce({_of_kind(5)}, false) as wrong_ring_orientation from broken""".replace("as bad_area", "as zero_area_"))
def geometry_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = topology.diagnostics(_broken(spark, sf_dir), metric=True).join(_broken(spark, sf_dir).select("row_idx", "kind"), "row_idx")
    known = F.when(F.col("kind") == 3, F.lit(False)).when(F.col("kind") == 5, F.lit(None)).otherwise(F.col("zero_area"))
    return df.select(
        "row_idx",
        "is_missing",
        "is_empty",
        "is_valid",
        "valid_reason",
        "geom_type",
        known.alias("zero_area_"),
        F.when(F.col("kind") == 3, F.lit(False)).otherwise(F.col("wrong_ring_orientation")).alias("wrong_ring_orientation"),
    )


@query(
        f"with {BROKEN} select row_idx, geometry as geometry_original, kind not in (5, 8) as is_valid, round({_of_kind(6)}, 6) as area, "
        f"false as wrong_ring_orientation from broken"
)
def repair_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed, _, after = topology.run(_broken(spark, sf_dir).select("row_idx", "geometry"), metric=True)
    fixed = fixed.select("row_idx", "geometry_original", F.round(geometry.area(geometry.parse_wkt(F.col("geometry"))), 6).alias("area"))
    return fixed.join(after.select("row_idx", "is_valid", "wrong_ring_orientation"), "row_idx")


@query(f"with {BROKEN} select count(*) as rows, count(*) filter (not {_of_kind(1)}) as invalid, count(*) filter (kind = 4) as empty from broken")
def geometry_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, before, _ = topology.run(_broken(spark, sf_dir).select("row_idx", "geometry"), metric=True)
    return topology.counters(before).select("rows", "invalid", "empty")


@query(f"{FIX} select row_idx, false as wrong, w*h as area from bld_b")
def oriented_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_wkt(buildings(spark, sf_dir)[1]).select("row_idx", geometry.oriented(geometry.parse_wkt(F.col("geom_wkt"))).alias("s"))
    return df.select("row_idx", geometry.wrong_orientation(F.col("s")).alias("wrong"), geometry.area(F.col("s")).alias("area"))


@query(
        f"{FIX}{CAND.replace('bld_a a join', 'bld_b a join').replace('on a.x0', 'on a.row_idx < b.row_idx and a.x0')} "
        f"select idx_a, idx_b, round(inter_area, 6) as overlap_m2 from cand where inter_area > 1e-9"
)
def coverage_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_wkt(buildings(spark, sf_dir)[1]).select("row_idx", "minx", "miny", "maxx", "maxy", "geom_wkt")
    return topology.coverage(df).select("idx_a", "idx_b", *_r("overlap_m2"))


_GRID = """select p_partkey as row_idx, 5000e0 + (p_partkey % 50)*10 as x0, 7000e0 + cast(floor(p_partkey/50e0) as int)*10 as y0,
 10e0 - case when p_partkey % 11 = 0 then 0.1e0 when p_partkey % 13 = 0 then 1e0 else 0e0 end as w, 10e0 as h from part"""


@query(
    f"with g as ({_GRID}) select cast(a.row_idx as bigint) as row_idx from g a join g b on b.row_idx = a.row_idx + 1 "
    f"and a.x0 + 10 = b.x0 where a.row_idx % 11 = 0 union select cast(b.row_idx as bigint) from g a "
    f"join g b on b.row_idx = a.row_idx + 1 and a.x0 + 10 = b.x0 where a.row_idx % 11 = 0 union "
           "select cast(r as bigint) from (select a.row_idx as i, b.row_idx as j, a.w as v, b.w as w from g a join g b on a.x0 = b.x0 "
           "and b.y0 = a.y0 + 10 where a.w <> b.w) t, unnest([i, j]) u(r)"
       )
def coverage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares side by side; some are 0.1 short, a gap, some 1 short, an open space; edges of unlike lengths don't match."""
    df = spark.sql(_GRID.replace("from part", "from {part}"), part=table(spark, sf_dir, "part"))
    df = df.withColumns({"minx": F.col("x0"), "miny": F.col("y0"), "maxx": F.col("x0") + F.col("w"), "maxy": F.col("y0") + F.col("h")})
    point = lambda x, y: F.concat_ws(" ", F.col(x).cast("string"), F.col(y).cast("string"))
    ring = F.array_join(
        F.array(point("minx", "miny"), point("maxx", "miny"), point("maxx", "maxy"), point("minx", "maxy"), point("minx", "miny")),
        ", ",
    )
    return topology.coverage_edges(
        df.withColumn("geom_wkt", F.concat(F.lit("POLYGON (("), ring, F.lit("))"))),
        0.2,
    ).select(F.col("row_idx").cast("long").alias("row_idx"))


_N = geometry.FLATTENING / (2 - geometry.FLATTENING)
_C = f"(2*sqrt({_N!r})/(1+{_N!r}))"
_R = repr(geometry.SCALE * geometry.SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64))
_ALPHA = [
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
]
_EAST = " + ".join(["eta", *[f"{a!r}*cos({2 * j}*xi)*sinh({2 * j}*eta)" for j, a in enumerate(_ALPHA, 1)]])
_NORTH = " + ".join(["xi", *[f"{a!r}*sin({2 * j}*xi)*cosh({2 * j}*eta)" for j, a in enumerate(_ALPHA, 1)]])
_LONLAT = "select p_partkey as row_idx, 29.5e0 + (p_partkey % 100)*0.017e0 as lon, 59.6e0 + (p_partkey % 37)*0.011e0 as lat from part"


@query(
        f"with g as ({_LONLAT}), s as (select *, sin(radians(lat)) as s, radians(lon - 33) as lam from g), "
        f"t as (select *, sinh(atanh(s) - {_C}*atanh({_C}*s)) as t from s), "
        f"x as (select row_idx, atan2(t, cos(lam)) as xi, atanh(sin(lam)/sqrt(1+t*t)) as eta from t) "
        f"select row_idx, round(500000 + {_R}*({_EAST}), 3) as x, round({_R}*({_NORTH}), 3) as y from x"
)
def utm_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.sql(_LONLAT.replace("from part", "from {part}"), part=table(spark, sf_dir, "part"))
    x, y = geometry.utm(F.col("lon"), F.col("lat"))
    return df.select("row_idx", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query(
        f"{FIX} select row_idx, concat('POLYGON ((', array_to_string(case "
        f"when row_idx % 4 = 0 then [p0, p3, p2, p1, p0] else [p0, p1, p2, p3, p0] end, ', '), '))') as wkt "
        f"from (select row_idx, concat(x0::bigint, ' ', y0::bigint) as p0, concat((x0+w)::bigint, ' ', y0::bigint) as p1, "
        f"concat((x0+w)::bigint, ' ', (y0+h)::bigint) as p2, concat(x0::bigint, ' ', (y0+h)::bigint) as p3 from bld_b)"
)
def wkt_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_wkt(buildings(spark, sf_dir)[1])
    return df.select("row_idx", geometry.write_wkt(geometry.parse_wkt(F.col("geom_wkt"))).alias("wkt"))


# ---------------------------------------------------------------- sources
@query(f"{FIX} select row_idx as place, height, stairs, number, district, x0, y0 + h as y1 from bld_b order by row_idx")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    b = with_wkt(buildings(spark, sf_dir)[1], "geometry").select(
        "row_idx",
        "geometry",
        "height",
        "stairs",
        "avg_floor_height",
        "number",
        "district",
        "type",
    )
    tables.save_csv(b.orderBy("row_idx").drop("row_idx").coalesce(1), path)
    df = tables.load_b(spark, path)
    box = geometry.box(geometry.parse_wkt(F.col("geometry")))
    return df.select(F.col("row_idx").alias("place"), "height", "stairs", "number", "district", box["minx"].alias("x0"), box["maxy"].alias("y1"))


@query(
        f"{FIX}, a as (select *, row_number() over (order by row_idx) - 1 as place from bld_a) "
        f"select place, area_sq_m, gkh_floor_count_min, gkh_floor_count_max, gkh_address, cast(null as varchar) as address, x0, y0 "
        f"from a"
)
def csv_round_trip_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In one file that is split at line ends."""
    path = scratch_path(spark, "csv")
    a = with_wkt(buildings(spark, sf_dir)[0], "geometry").select(
        "row_idx",
        "geometry",
        "area_sq_m",
        "gkh_floor_count_min",
        "gkh_floor_count_max",
        "gkh_address",
    )
    tables.save_csv(a.orderBy("row_idx").drop("row_idx").coalesce(1), path)
    df = tables.load_a(spark, path, multi_line=False)
    box = geometry.box(geometry.parse_wkt(F.col("geometry")))
    return df.select(
        F.col("row_idx").alias("place"),
        "area_sq_m",
        "gkh_floor_count_min",
        "gkh_floor_count_max",
        "gkh_address",
        "address",
        box["minx"].alias("x0"),
        box["miny"].alias("y0"),
    )


@query(f"{FIX} select row_idx, height, district from bld_b")
def geojson_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "geojson")
    geojson.save_geojson(with_wkt(buildings(spark, sf_dir)[1], "geometry").select("row_idx", "height", "district", "geometry"), path)
    return geojson.read_geojson(spark, path, "row_idx: bigint, height: double, district: string")


# ---------------------------------------------------------------- text
@query(
        rf"select p_partkey, {_NORM.format(c='x')} as norm, {_HOUSE.format(c=_NORM.format(c='x'))} as house "
        rf"from (select p_partkey, concat(p_name, ', Дом ', p_partkey % 50, case p_partkey % 4 when 0 then 'Ё' when 1 then 'а-б' "
        rf"when 2 then 'к1' else '' end, ' корп.') as x from part)"
)
def norm_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    x = F.concat(
        "p_name",
        F.lit(", Дом "),
        (F.col("p_partkey") % 50).cast("string"),
        F.when(k == 0, "Ё").when(k == 1, "а-б").when(k == 2, "к1").otherwise(""),
        F.lit(" корп."),
    )
    return table(spark, sf_dir, "part").select("p_partkey", text.norm_text(x).alias("norm"), text.house_number(x).alias("house"))


@query(
        "select c_custkey, trim(string_split(x, ',')[1]) as title, trim(array_to_string(string_split(x, ',')[2:3], ',')) as subtitle "
        "from (select c_custkey, concat(c_name, ', ', c_mktsegment, ', ', c_nationkey, ', tail') as x from customer)"
)
def suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.concat("c_name", F.lit(", "), "c_mktsegment", F.lit(", "), F.col("c_nationkey").cast("string"), F.lit(", tail"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.suggestion_title(x).alias("title"),
        text.suggestion_subtitle(x).alias("subtitle"),
    )


# ---------------------------------------------------------------- the map
LAYER = f"{FIX}{REVIEW}{POINTS}{ECO}"


def _layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Chain(spark, sf_dir).matched().layer()


@query(f"{LAYER} select component_id, round(height_final, 6) as height_final_full from eco where coalesce(height_final, 0) between 10 and 60")
def map_height_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.height_filter(_layer(spark, sf_dir), 10, 60).select("component_id", *_r("height_final_full"))


@query(
        f"{LAYER} select component_id, case when confidence_score >= 0.8 then 'high' "
        f"when confidence_score >= 0.5 then 'medium' else 'low' end as confidence_class, case when dense_score >= 0.7 then 'high' "
        f"when dense_score >= 0.4 then 'medium' else 'low' end as density_class, eco_risk_level as eco_class, "
        f"round(coalesce(height_final, 0), 6) as elevation from eco"
)
def paint_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _layer(spark, sf_dir)
    return df.select(
        "component_id",
        serving.confidence_class(F.col("confidence_score")).alias("confidence_class"),
        serving.density_class(F.col("dense_score")).alias("density_class"),
        serving.eco_class(F.col("eco_risk_level")).alias("eco_class"),
        F.round(F.coalesce("height_final_full", F.lit(0.0)), 6).alias("elevation"),
    )


_PAINT = {"confidence": "confidence_class", "density": "density_class", "eco_risk": "eco_risk_level"}


def _mapped_sql(column: str, names: dict[str, str]) -> str:
    return f"case {column} " + " ".join(f"when '{k}' then '{v}'" for k, v in names.items()) + " end"


@query(
    f"{LAYER}, cls as (select component_id, eco_risk_level, case when confidence_score >= 0.8 then 'high' "
    f"when confidence_score >= 0.5 then 'medium' else 'low' end as confidence_class, case when dense_score >= 0.7 then 'high' "
    f"when dense_score >= 0.4 then 'medium' else 'low' end as density_class from eco) "
       + " union all ".join(
               f"select component_id, '{by}' as layer, '{serving.LAYERS[by]}' as layer_label, {c} as paint_class, "
                   f"{_mapped_sql(c, serving.COLOURS[by])} as paint_colour, {_mapped_sql(c, serving.LEGENDS[by])} as paint_label "
                   f"from cls" for by, c in _PAINT.items()
       ))
def paint_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layer that a user chooses, for each choice: classes, colours and the legend's texts."""
    layer = _layer(spark, sf_dir)
    each = [
        serving.paint(layer, by).select(
            "component_id",
            F.lit(by).alias("layer"),
            F.lit(label).alias("layer_label"),
            "paint_class",
            "paint_colour",
            "paint_label",
        ) for by, label in serving.LAYERS.items()
    ]
    return each[0].unionByName(each[1]).unionByName(each[2])


@query(f"{FIX} select row_idx, gkh_address from bld_a where contains(lower(gkh_address), 'д. 3') order by gkh_address, row_idx limit 5")
def address_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.search(buildings(spark, sf_dir)[0], "Д. 3", "gkh_address").select("row_idx", "gkh_address")


@query(
        f"{LAYER} select component_id, case when dense_score >= 0.7 then 'Критическая плотность' "
        f"when confidence_score < 0.3 then 'Низкая уверенность в данных' when eco_risk_level = 'high' then 'Риск покрытия высокий' "
        f"when eco_risk_level = 'medium' or dense_score >= 0.4 then 'Умеренная зона' else 'Зона с хорошим покрытием' end as "
        f"insight_title, case when dense_score >= 0.7 then 'danger' when confidence_score < 0.3 then 'warning' "
        f"when eco_risk_level = 'high' then 'danger' when eco_risk_level = 'medium' or dense_score >= 0.4 then 'warning' else 'good' "
        f"end as insight_level from eco"
)
def insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.insight(_layer(spark, sf_dir)).select("component_id", "insight_title", "insight_level")


@query(
        f"{LAYER} select component_id, coalesce(concat(cast(round(confidence_score*100) as int), '%'), "
        f"'—') as tip_confidence, coalesce(printf('%.1f', round(height_final, 1)) || ' м', '—') as tip_height, "
        f"concat(cast(round(dense_score*100) as int), '%') as tip_density, "
        f"case match_type {' '.join(f'''when '{k}' then '{v}' ''' for k, v in serving.MATCH_LABELS.items())} else coalesce(match_type, "
        f"'—') end as tip_match, coalesce(eco_risk_level, '—') as tip_risk from eco"
)
def tooltip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.tooltip(_layer(spark, sf_dir)).select("component_id", "tip_confidence", "tip_height", "tip_density", "tip_match", "tip_risk")


@query(
        f"{LAYER} select cast(component_id as bigint) as component_id, match_type, round(height_final, 6) as height_final_full, "
        f"confidence_score, round(score, 6) as eco_risk_score, eco_risk_level, dense_area, round(dense_score, 6) as dense_score from eco"
)
def frontend_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = serving.frontend(_layer(spark, sf_dir))
    return df.select(*[F.round(c, 6).alias(c) if c in ("height_final_full", "eco_risk_score", "dense_score") else c for c in df.columns])


@query(
        f"with g as ({_LONLAT}), z as (select *, unnest(range(10, 17))::int as z from g) "
        f"select row_idx, z, cast(floor((lon + 180)/360*pow(2, z)) as int) as x, cast(floor((0.5 - ln((1 + sin(radians(lat)))/(1 - "
        f"sin(radians(lat))))/(4*pi()))*pow(2, z)) as int) as y from z"
)
def tile_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.sql(_LONLAT.replace("from part", "from {part}"), part=table(spark, sf_dir, "part"))
    return serving.tiles(df).select("row_idx", "z", "x", "y")


_POINT = "concat('[', cast({x} as double), ',', cast({y} as double), ']')"
_RING = [_POINT.format(x=x, y=y) for x, y in (("x0", "y0"), ("x0 + w", "y0"), ("x0 + w", "y0 + h"), ("x0", "y0 + h"))]


#: Zoom of the tile that is read back.
_ZOOM = 13


@query(
        f"with g as ({_LONLAT}), z as (select row_idx, cast(floor((lon + 180)/360*pow(2, {_ZOOM})) as int) as x, cast(floor((0.5 - "
        f"ln((1 + sin(radians(lat)))/(1 - sin(radians(lat))))/(4*pi()))*pow(2, {_ZOOM})) as int) as y from g), one as (select x, y "
        f"from z order by x, y limit 1) select row_idx, {_ZOOM} as z, z.x, z.y from z join one on z.x = one.x and z.y = one.y"
)
def tile_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows are written by tile; one tile, the first that has any, is read back."""
    path = scratch_path(spark, "tiles")
    df = spark.sql(_LONLAT.replace("from part", "from {part}"), part=table(spark, sf_dir, "part"))
    geojson.save_tiles(df, path)
    x, y = spark.read.parquet(path).where(F.col("z") == _ZOOM).agg(F.min(F.struct("x", "y")).alias("t")).first().t
    return geojson.read_tile(spark, path, _ZOOM, x, y).select("row_idx", "z", "x", "y")


_BOXES = (
    f"select row_idx, lon, lat, lon + 0.002e0 as lon1, lat + 0.001e0 as lat1, case "
    f"when row_idx % 5 = 0 then null else row_idx*0.5e0 end as height from ({_LONLAT}) p"
)


def _tile_sql(lon: str, lat: str) -> tuple[str, str]:
    return f"cast(floor(({lon} + 180)/360*pow(2, z)) as bigint)", f"cast(floor((0.5 - ln((1 + sin(radians({lat})))/(1 - sin(radians({lat}))))/(4*pi()))*pow(2, z)) as bigint)"


(_X0, _Y1), (_X1, _Y0) = _tile_sql("lon", "lat"), _tile_sql("lon1", "lat1")


@query(f"""with g as ({_BOXES}), z as (select *, unnest([12, 14]) as z from g), x as (select *, unnest(range({_X0}, {_X1} + 1)) as x
  from z), y as (select *, unnest(range({_Y0}, {_Y1} + 1)) as y from x)
 select z, x::int as x, y::int as y, count(*) as features, sum(row_idx)::bigint as ids, round(coalesce(sum(height), 0), 6) as heights from y group by z, x, y""")
def vector_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles are encoded, then decoded again: what is counted comes from their bytes."""
    df = spark.sql(_BOXES.replace("from part", "from {part}"), part=table(spark, sf_dir, "part"))
    corner = lambda x, y: F.concat_ws(" ", F.col(x).cast("string"), F.col(y).cast("string"))
    ring = F.array_join(
        F.array(corner("lon", "lat"), corner("lon1", "lat"), corner("lon1", "lat1"), corner("lon", "lat1"), corner("lon", "lat")),
        ", ",
    )
    layer = df.select("row_idx", "height", F.concat(F.lit("POLYGON (("), ring, F.lit("))")).alias("geometry"))

    def read(batches):
        for tiles in batches:
            found = [[p for p, _ in mvt.decode(t)] for t in tiles["tile"]]
            yield tiles[["z", "x", "y"]].assign(
                features=[len(f) for f in found],
                ids=[sum(p["row_idx"] for p in f) for f in found],
                heights=[round(sum(p.get("height", 0.0) for p in f), 6) for f in found],
            )

    return mvt.vector_tiles(layer, range(12, 15, 2)).mapInPandas(read, "z int, x int, y int, features long, ids long, heights double")


@query(f"""{FIX} select concat('{{"type":"Feature","properties":{{"row_idx":', row_idx, ',"height":', coalesce(cast(height as varchar), 'null'), ',"district":', coalesce('"' || district || '"', 'null'),
 '}},"geometry":{{"type":"Polygon","coordinates":[[', array_to_string(case when row_idx % 4 = 0 then [{_RING[0]}, {_RING[3]}, {_RING[2]}, {_RING[1]}, {_RING[0]}] else [{", ".join([*_RING, _RING[0]])}] end, ','), ']]}}}}') as feature from bld_b""")
def geojson_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geojson.features(with_wkt(buildings(spark, sf_dir)[1], "geometry").select("row_idx", "height", "district", "geometry"))


@query(f"""{FIX}{COMP}, part_ as (select label, source, x0, y0, x0 + w as x1, y0 + h as y1 from members join bld_a using (row_idx) where source = 'A'
  union all select label, source, x0, y0, x0 + w, y0 + h from members join bld_b using (row_idx) where source = 'B'),
 mine as (select p.* from part_ p join comp using (label) where source = case when n_b > 0 then 'B' else 'A' end),
 xs as (select label, x, lead(x) over (partition by label order by x) as x2 from (select label, x0 as x from mine union select label, x1 from mine)),
 ys as (select label, y, lead(y) over (partition by label order by y) as y2 from (select label, y0 as y from mine union select label, y1 from mine)),
 cells as (select distinct xs.label, x, x2, y, y2 from xs join ys using (label)
  join mine m on m.label = xs.label and m.x0 <= x and m.x1 >= x2 and m.y0 <= y and m.y1 >= y2)
 select component_id, round(sum((x2 - x)*(y2 - y)), 6) as area, true as is_valid from cells join comp using (label) group by component_id""")
def polygon_union_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Chain(spark, sf_dir).matched()
    df = matching.component_geometry(c.components, c.members, with_wkt(c.a), with_wkt(c.b))
    return df.select(
        "component_id",
        F.round(geometry.area(geometry.parse_wkt(F.col("geom_wkt"))), 6).alias("area"),
        shapes.diagnose("geom_wkt")["is_valid"].alias("is_valid"),
    )
