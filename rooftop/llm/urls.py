"""URL filter: rules by host and path, and host reputation by empirical Bayes from labelled pages."""

from __future__ import annotations

import glob
import os
import zipfile
from functools import cache
from typing import NamedTuple

import pyspark
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftop.llm import common

#: (verdict, host, path): a rule holds for its host and all subdomains, for paths that start with its path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: The public suffix list that Spark's own HTTP client brings along: jar and entry.
SUFFIX_JAR, SUFFIX_FILE = "httpclient-4*.jar", "mozilla/public-suffix-list.txt"
#: A host is blocked when the lower bound (Z standard deviations) of its rate of bad pages is above LIMIT.
Z, LIMIT = 1.645, 0.5
#: Bounds of the intraclass correlation that the priors' strengths come from.
RHO_MIN, RHO_MAX = 0.0001, 0.5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for how, of, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(of + start)).otherwise(rule), F.when(fits, F.lit(how)).otherwise(verdict)
    return rule, verdict


class Suffixes(NamedTuple):
    """Rules of a public suffix list: suffixes as they are, those below which any label is one, and exceptions."""

    plain: tuple[str, ...]
    wild: tuple[str, ...]
    not_: tuple[str, ...]


def _in_ascii(rule: str) -> str:
    try:
        return rule.encode("idna").decode()
    except UnicodeError:
        return rule


@cache
def public_suffixes(path: str | None = None) -> Suffixes:
    """The rules of a list at path (Mozilla's format), by default of the one in Spark's jars; names in both spellings."""
    if path is not None:
        with open(path, encoding="utf-8") as f:
            content = f.read()
    else:
        homes = [os.environ.get("SPARK_HOME", ""), os.path.dirname(pyspark.__file__)]
        jars = [jar for home in homes if home for jar in sorted(glob.glob(f"{home}/jars/{SUFFIX_JAR}"))]
        if not jars:
            raise ValueError("no public suffix list in Spark's jars: give the path of one")
        with zipfile.ZipFile(jars[0]) as z:
            content = z.read(SUFFIX_FILE).decode()
    lines = {line.split()[0] for line in content.splitlines() if line.strip() and not line.startswith("//")}
    both = lambda start: tuple(sorted({x for r in lines if r.startswith(start) for x in (r[len(start) :], _in_ascii(r[len(start) :]))}))
    plain = tuple(sorted({x for r in lines if r[0] not in "!*" for x in (r, _in_ascii(r))}))
    return Suffixes(plain, both("*."), both("!"))


def _quoted(rules: tuple[str, ...]) -> str:
    return ", ".join("'" + r.replace("'", "''") + "'" for r in rules) or "''"


def _by_labels(rules: tuple[str, ...]) -> dict[int, tuple[str, ...]]:
    return {n: tuple(r for r in rules if r.count(".") + 1 == n) for n in sorted({r.count(".") + 1 for r in rules})}


def with_domain(hosts: DataFrame, suffixes: Suffixes) -> DataFrame:
    """Adds domain and suffix to hosts (host), its user and port put aside; an IPv4 address is both itself.

    The longest rule counts, an exception before all; without a rule the last label is the suffix. A name that is a
    suffix is its own domain. Rules are literal sets, hashed by the optimizer: no join.
    """
    name = F.regexp_replace(F.regexp_replace("host", "^.*@", ""), ":[0-9]*$", "")
    hosts = hosts.withColumn("__name", name).withColumn("__parts", F.split("__name", "[.]")).withColumn("__m", F.size("__parts"))
    plain, wild, not_ = (_by_labels(r) for r in suffixes)
    last = lambda n: F.array_join(F.slice("__parts", F.greatest(F.col("__m") - n + 1, F.lit(1)), n), ".")
    most = max([1, *plain, *wild, *not_])
    hosts = hosts.withColumns({f"__t{n}": F.when(F.col("__m") >= n, last(n)) for n in range(1, most + 1)})
    long = [F.when(F.expr(f"__t{n} in ({_quoted(r)})"), F.lit(n)) for n, r in plain.items()]
    long += [F.when(F.expr(f"__t{n} in ({_quoted(r)})") & (F.col("__m") > n), F.lit(n + 1)) for n, r in wild.items()]
    except_ = [F.when(F.expr(f"__t{n} in ({_quoted(r)})"), F.lit(n - 1)) for n, r in not_.items()]
    hosts = hosts.withColumn("__n", F.coalesce(*except_, F.greatest(F.lit(1), *long)))
    address = F.col("__name").rlike(r"^[0-9]+([.][0-9]+){3}$")
    tail = lambda n: F.array_join(F.slice("__parts", F.greatest(F.col("__m") - n + 1, F.lit(1)), F.greatest(n, F.lit(1))), ".")
    hosts = hosts.withColumns(
        {
            "domain": F.when(address, F.col("__name")).otherwise(tail(F.col("__n") + 1)),
            "suffix": F.when(address, F.col("__name")).otherwise(tail(F.col("__n"))),
        }
    )
    return hosts.drop("__name", "__parts", "__m", "__n", *[f"__t{n}" for n in range(1, most + 1)])


def _rho(children: DataFrame, k: str, n: str, p: str) -> float:
    """Moment estimate of the intraclass correlation of children around their parent's rate p."""
    k, n, p = F.col(k).cast("double"), F.col(n).cast("double"), F.col(p)
    got = children.agg(
        F.sum((k - n * p) * (k - n * p)).alias("s"),
        F.sum(n * p * (1 - p)).alias("b"),
        F.sum(n * (n - 1) * p * (1 - p)).alias("w"),
    ).first()
    raw = (got.s - got.b) / got.w if got.w else 0.0
    return min(max(raw, RHO_MIN), RHO_MAX)


def host_reputation(pages: DataFrame, labels: DataFrame, suffixes: Suffixes | None = None, label_key: str = "doc_id") -> DataFrame:
    """host, pages, labelled, bad, bound: the lower posterior bound of each host's rate of bad pages.

    labels.label_key names the page that a label is of: a page's outcome is the label whose key equals its page_id.
    A labelled page is bad with quality 0 or toxic 1; of several labels of one page a bad one decides. Rates shrink
  from host to registered domain to suffix to all
    pages through beta-binomial priors, whose strengths are moment estimates over the data. A parent's rate is that of its
    other children.
    """
    outcome = (
        labels.where("quality is not null or toxic is not null")
        .select(
            F.col(label_key).alias("page_id"),
            (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int").alias("bad"),
        )
        .groupBy("page_id").agg(F.max("bad").alias("bad"))
    )
    hosts = pages.join(outcome, "page_id", "left").groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count("bad").alias("n"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("k"),
    )
    hosts = common.written(with_domain(hosts, suffixes or public_suffixes()), "hosts")
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("dn"), F.sum("k").alias("dk"))
    tops = hosts.groupBy("suffix").agg(F.sum("n").alias("sn"), F.sum("k").alias("sk"))
    every = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    p0 = (every.k + 1.0) / (every.n + 2.0)
    # A parent's rate leaves the child's own pages out, so that they count once.
    m = 1 / _rho(tops.withColumn("p", F.lit(p0)), "sk", "sn", "p") - 1
    parent = (F.col("sk") - F.col("dk") + m * p0) / (F.col("sn") - F.col("dn") + m)
    domains = common.written(domains.join(tops, "suffix").withColumn("ps", parent), "domains")
    m = 1 / _rho(domains, "dk", "dn", "ps") - 1
    parent = (F.col("dk") - F.col("k") + m * F.col("ps")) / (F.col("dn") - F.col("n") + m)
    hosts = common.written(hosts.join(domains, ["suffix", "domain"]).withColumn("pd", parent), "rated")
    m = 1 / _rho(hosts, "k", "n", "pd") - 1
    a, b = F.col("k") + m * F.col("pd"), F.col("n") - F.col("k") + m * (1 - F.col("pd"))
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return hosts.select("host", "pages", F.col("n").alias("labelled"), F.col("k").alias("bad"), (a / (a + b) - Z * sd).alias("bound"))


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: list[tuple[str, str, str]] = RULES,
    limit: float = LIMIT,
    suffixes: Suffixes | None = None,
    label_key: str = "doc_id",
) -> DataFrame:
    """page_id, host, path, rule, verdict of every page.

    A null url or one without :// has an empty host and path and is judged like any other host. A page without a
    rule is blocked when its host's bound is above limit. Repeated pages are judged each, and each counts as a page
    with its label; a null page_id has no label; other columns are ignored; an empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    facts = host_reputation(pages, labels, suffixes, label_key)
    total = int(facts.agg(F.coalesce(F.sum("pages"), F.lit(0))).first()[0])
    blocked = common.written(facts.where(F.col("bound") > limit).select("host", "pages", F.lit("block").alias("learned")), "blocked")
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    out = common.hot_left_join(pages, blocked, ["host"], "pages", total)
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.col("learned"), F.lit("allow")).alias("verdict"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(common.table(spark, sf_dir, "pages"), common.table(spark, sf_dir, "labels"))


_FITS = "(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')"
_CASES = [(_FITS.format(h=h, p=p), f"'{h}{p}'", f"'{v}'") for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))]
_RULES_SQL = " union all ".join(
    f"select unnest([{_quoted(r)}]) as rule, '{k}' as kind" for k, r in zip(Suffixes._fields, public_suffixes(), strict=True)
)
OP3_SQL = rf"""
with u as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
p as (select page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') as host, regexp_extract(coalesce(rest, ''),
  '^[^/?#]*([^?#]*)', 1) as path from u),
o as (select doc_id, max(case when coalesce(quality = 0, false) or coalesce(toxic = 1, false) then 1 else 0 end) as bad from labels
  where quality is not null or toxic is not null group by doc_id),
c as (select host, count(bad)::double as n, coalesce(sum(bad), 0)::double as k from p left join o on doc_id = page_id group by host),
s as (select *, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') as parts from c),
rules as ({_RULES_SQL}),
tails as (select host, len(parts) as m, unnest(range(1, len(parts) + 1)) as l, parts from s),
found as (select host, coalesce(max(case when kind = 'not_' then l - 1 end),
  max(case when kind = 'plain' then l when kind = 'wild' and m > l then l + 1 end), 1) as l
 from tails left join rules on array_to_string(parts[m - l + 1:], '.') = rule group by host),
w as (select host, n, k, array_to_string(parts, '.') as name, array_to_string(parts[greatest(len(parts) - l, 1):], '.') as domain,
  array_to_string(parts[greatest(len(parts) - greatest(l, 1) + 1, 1):], '.') as suffix from s join found using (host)),
h as (select host, n, k, case when name ~ '^[0-9]+([.][0-9]+){{3}}$' then name else domain end as domain,
  case when name ~ '^[0-9]+([.][0-9]+){{3}}$' then name else suffix end as suffix from w),
t as (select suffix, sum(n) as n, sum(k) as k from h group by suffix),
d as (select suffix, domain, sum(n) as n, sum(k) as k from h group by suffix, domain),
a as (select (coalesce(sum(k), 0) + 1) / (coalesce(sum(n), 0) + 2) as p from h),
rt as (select least(greatest(coalesce((sum((k - n * p) * (k - n * p)) - sum(n * p * (1 - p))) / nullif(sum(n * (n - 1) * p * (1 - p)), 0), 0),
  {RHO_MIN}), {RHO_MAX}) as rho from t, a),
dp as (select d.*, (t.k - d.k + (1 / rho - 1) * p) / (t.n - d.n + 1 / rho - 1) as parent from d join t using (suffix), a, rt),
rd as (select least(greatest(coalesce((sum((k - n * parent) * (k - n * parent)) - sum(n * parent * (1 - parent))) / nullif(sum(n * (n - 1) * parent * (1 - parent)), 0), 0), {RHO_MIN}),
  {RHO_MAX}) as rho from dp),
hp as (select h.*, (dp.k - h.k + (1 / rho - 1) * parent) / (dp.n - h.n + 1 / rho - 1) as p from h join dp using (suffix, domain), rd),
rh as (select least(greatest(coalesce((sum((k - n * p) * (k - n * p)) - sum(n * p * (1 - p))) / nullif(sum(n * (n - 1) * p * (1 - p)), 0), 0),
  {RHO_MIN}), {RHO_MAX}) as rho from hp),
ab as (select host, k + (1 / rho - 1) * p as a, n - k + (1 / rho - 1) * (1 - p) as b from hp, rh),
v as (select host, a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) as bound from ab)
select page_id, host, path,
 case {" ".join(f"when {f} then {r}" for f, r, _ in _CASES)} end as rule,
 case {" ".join(f"when {f} then {x}" for f, _, x in _CASES)} when bound > {LIMIT} then 'block' else 'allow' end as verdict
from p join v using (host)
"""
