"""URL filter: listed rules first, else empirical-Bayes host reputation.

Labelled page outcomes (good or bad) are counted per host. Bad rates are shrunk through
beta-binomial priors: the suffix towards the rate of the corpus, the registered domain
towards its suffix, the host towards its domain. How strongly, is fitted at each level by
the method of moments from the spread of the rates. A page is blocked if the lower bound of its
host's bad rate, mean minus ``z`` standard deviations, is above ``bar``.

A NULL url, or one without ``://``, has an empty host and path; its host is treated like
any other name. Pages without a label inform nothing but are judged: a host without labels
has the rate of its domain, a domain without any that of its suffix, and so on. Without
labels every page that no rule blocks is allowed. Repeated rows count once each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import small_join
from ..session import materialize
from .common import UPPER, pick
from .registry import query

# The rules of the query, verdict by host and path.
RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}
# Suffixes of two labels under which names are registered; every other suffix has one label.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in")
# Bounds of a prior's strength in pages; the upper one stands for equal rates.
LEAST_PRIOR, MOST_PRIOR = 2.0, 1000.0


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path)."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, UPPER.lower()), path


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, else NULL. ``rules`` is a short list."""
    fits = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, slash, start = rule.partition("/")
        fit = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        fits = F.when(fit, F.lit(rule)).otherwise(fits)
    return fits


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host name; ports are dropped."""
    labels = F.split(F.regexp_replace(host, r":\d*$", ""), r"\.")
    two = F.array_join(F.slice(labels, -2, 2), ".")
    n = F.when(two.isin(*TWO_LABEL_SUFFIXES), 2).otherwise(1)
    n_labels = F.size(labels)

    def last(k):
        k = F.least(k, n_labels)
        return F.array_join(F.slice(labels, n_labels - k + 1, k), ".")

    return last(n + 1), last(n)


def _strength(groups: DataFrame, mean: str) -> Column:
    """Prior strength by moments: how many pages the parent's rate is worth.

    With rates p of n pages around means m, the spread beyond chance
    s = (sum n (p - m)^2 - sum m (1 - m)) / sum (n - 1) m (1 - m) equals 1 / (strength + 1).
    """
    m, n, p = F.col(mean), F.col("n"), F.col("bad") / F.col("n")
    var = m * (1 - m)
    s = (F.sum(n * (p - m) * (p - m)) - F.sum(var)) / F.nullif(F.sum((n - 1) * var), F.lit(0.0))
    fitted = F.when(s <= 1 / (MOST_PRIOR + 1), MOST_PRIOR).otherwise(1 / s - 1)
    return F.least(F.lit(MOST_PRIOR), F.greatest(F.lit(LEAST_PRIOR), F.coalesce(fitted, F.lit(MOST_PRIOR))))


def reputation(outcomes: DataFrame) -> DataFrame:
    """Per host: pages, bad pages, and the posterior's two parameters.

    ``outcomes`` has host, n and bad, one row per host: the levels above are sums of it.
    """
    domain, suffix = domain_and_suffix(F.col("host"))
    hosts = outcomes.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = materialize(domains, "url-domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = materialize(suffixes, "url-suffixes")
    whole = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    # A uniform prior keeps the rate of the whole off 0 and 1.
    rate = ((whole["bad"] or 0) + 1) / ((whole["n"] or 0) + 2)
    suffixes = _shrink(suffixes.withColumn("parent", F.lit(rate)))
    suffix_rate = suffixes.select("suffix", (F.col("a") / (F.col("a") + F.col("b"))).alias("parent"))
    domains = _shrink(small_join(domains, suffix_rate, "suffix"))
    domain_rate = domains.select("domain", (F.col("a") / (F.col("a") + F.col("b"))).alias("parent"))
    return _shrink(small_join(hosts, domain_rate, "domain"))


def _shrink(groups: DataFrame) -> DataFrame:
    """Add the posterior's parameters a and b: the group's pages beside the parent's rate."""
    groups = materialize(groups, "url-level")
    strength = groups.where("n > 0").agg(_strength(groups, "parent").alias("k")).first()["k"]
    return groups.withColumn("a", F.col("bad") + strength * F.col("parent")).withColumn(
        "b", F.col("n") - F.col("bad") + strength * (1 - F.col("parent"))
    )


def lower_bound(a: Column, b: Column, z: float) -> Column:
    mean = a / (a + b)
    return mean - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: dict[str, str],
    z: float = 1.645,
    bar: float = 0.5,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """Verdict of every page; ``outcomes`` has host, n (labelled pages) and bad."""
    host, path = split_url(F.col("url"))
    rows = pick(pages, page_id=id_column, url=url_column)
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    none = F.lit(0).cast("long")
    hosts = outcomes.select("host", "n", "bad").union(
        rows.select("host", none.alias("n"), none.alias("bad")).distinct()
    )
    hosts = hosts.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    known = reputation(materialize(hosts, "url-hosts")).select(
        "host",
        F.col("n").alias("host_labels"),
        (F.col("a") / (F.col("a") + F.col("b"))).alias("bad_rate"),
        lower_bound(F.col("a"), F.col("b"), z).alias("bad_bound"),
    )
    # Pages of one host may be a large share: the few hosts are broadcast if they fit.
    rows = small_join(rows, materialize(known, "url-bounds"), "host", hot_from=rows)
    rule = rule_of(F.col("host"), F.col("path"), rules)
    listed = F.element_at(F.create_map(*[F.lit(x) for kv in rules.items() for x in kv]), F.col("rule"))
    by_host = F.when(F.col("bad_bound") > bar, "block").otherwise("allow")
    return rows.withColumn("rule", rule).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.when(F.col("rule").isNotNull(), listed).otherwise(by_host).alias("verdict"),
        "host_labels",
        "bad_rate",
        "bad_bound",
    )


def labelled_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcomes per host: a page shows the document whose number ends its path.

    ``labels`` has doc_id and quality, 0 for bad. Pages without such a number, or whose
    document has no label, are left out.
    """
    host, path = split_url(F.col("url"))
    shown = pick(pages, url="url").select(
        host.alias("host"),
        F.regexp_extract(path, r"/([0-9]{1,18})(?:\.html)?/?$", 1).alias("number"),
    )
    shown = shown.where("number != ''").select("host", F.col("number").cast("long").alias("doc_id"))
    graded = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    # A document may have several labels; it is bad if any says so.
    graded = graded.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    per_page = shown.groupBy("host", "doc_id").agg(F.count(F.lit(1)).alias("k"))
    return (
        per_page.join(graded, "doc_id")
        .groupBy("host")
        .agg(
            F.sum("k").alias("n"),
            F.sum(F.when(F.col("quality") == 0, F.col("k")).otherwise(0)).alias("bad"),
        )
    )


def _level_sql(name: str, groups: str, parent: str) -> str:
    """One level of the shrinkage: its strength, and the parameters a and b."""
    return f"""
{name}_p as (select *, {parent} as parent from {groups}),
{name}_k as (
  select least(1000, greatest(2, coalesce(
    case when s <= 1.0 / 1001 then 1000 else 1 / s - 1 end, 1000))) as k
  from (
    select (sum(n * (bad / n - parent) * (bad / n - parent)) - sum(parent * (1 - parent)))
      / nullif(sum((n - 1) * parent * (1 - parent)), 0) as s
    from {name}_p where n > 0
  )
),
{name} as (select *, bad + k * parent as a, n - bad + k * (1 - parent) as b from {name}_p, {name}_k)"""


@query(
    "op3_url_filter",
    sql=rf"""
with rest as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages
),
hosts as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from rest),
p as (
  select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path
  from hosts
),
graded as (select doc_id, min(quality) as quality from labels where quality is not null group by doc_id),
outcomes as (
  select host, count(*) as n, count(*) filter (quality = 0) as bad
  from (select host, regexp_extract(path, '/([0-9]{{1,18}})(?:\.html)?/?$', 1) as number from p) x
  join graded on number <> '' and try_cast(number as bigint) = doc_id
  group by host
),
labels_of as (
  select host, string_split(regexp_replace(host, ':\d*$', ''), '.') as l,
    coalesce(n, 0)::double as n, coalesce(bad, 0)::double as bad
  from (select distinct host from p) left join outcomes using (host)
),
named as (
  select host, n, bad, array_to_string(l[greatest(1, len(l) - m) : len(l)], '.') as domain,
    array_to_string(l[greatest(1, len(l) - m + 1) : len(l)], '.') as suffix
  from (
    select *, case when array_to_string(l[greatest(1, len(l) - 1) : len(l)], '.')
      in ({', '.join(f"'{x}'" for x in TWO_LABEL_SUFFIXES)}) then 2 else 1 end as m
    from labels_of
  )
),
domains as (select domain, suffix, sum(n) as n, sum(bad) as bad from named group by domain, suffix),
suffixes as (select suffix, sum(n) as n, sum(bad) as bad from domains group by suffix),
{_level_sql("s", "suffixes", "(select (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) from suffixes)")},
dm as (select domains.*, s.a / (s.a + s.b) as up from domains join s using (suffix)),
{_level_sql("d", "dm", "up")},
hm as (select named.*, d.a / (d.a + d.b) as up from named join d using (domain)),
{_level_sql("h", "hm", "up")},
judged as (
  select page_id, p.host, path, cast(n as bigint) as host_labels, a / (a + b) as bad_rate,
    a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) as bad_bound,
    case when (p.host = 'example.org' or p.host like '%.example.org') and path like '/en/1%' then 'example.org/en/1'
      when (p.host = 'example.org' or p.host like '%.example.org') and path like '/es/%' then 'example.org/es/'
      when (p.host = 'com' or p.host like '%.com') and path like '/fr/%' then 'com/fr/'
      when (p.host = 'com' or p.host like '%.com') and path like '/de/%' then 'com/de/'
      when (p.host = 'org' or p.host like '%.org') and path like '/%' then 'org/' end as rule
  from p join h using (host)
)
select page_id, host, path, rule,
  case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
    when bad_bound > 0.5 then 'block' else 'allow' end as verdict,
  host_labels, round(bad_rate, 6) as bad_rate, round(bad_bound, 6) as bad_bound
from judged
""",
)
def op3_url_filter(load) -> DataFrame:
    """Every page; outcomes from the quality labels of the documents that pages show."""
    pages = load("pages")
    outcomes = materialize(labelled_outcomes(pages, load("labels")), "url-outcomes")
    return judge(pages, outcomes, RULES).withColumns(
        {c: F.round(c, 6) for c in ("bad_rate", "bad_bound")}
    )
