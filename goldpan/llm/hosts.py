"""Operator 5, URL filters by empirical-Bayes reputation of hosts.

Labelled page outcomes (bad or not) are counted for suffixes, registered domains and
hosts. Each level shrinks towards the one above: its rate has a beta prior whose mean is
the level above's posterior mean and whose strength is estimated from how much rates
differ at that level beyond chance. A url is blocked when a lower bound of the posterior
rate of its host is above a threshold: few bad pages on a new host prove little, unless
its domain or suffix has a record. Hosts without a labelled page take their domain's
posterior, and so on upwards. Written rules go first; the longest that fits decides.

Everything is DataFrame functions; the driver sees one row of sums for each level.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no
rule and takes the overall posterior; a port or a user's name belongs to the host but not to
its domain, and a numeric address is a domain and suffix of its own; pages without a label (or with null labels) don't
count as outcomes, of several labels for a page the worst counts; repeated pages are all
judged and all counted; without any label the overall rate is 0 and all is allowed; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.5
DEVIATIONS = 1.645
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1000.0
SUFFIXES = ("ac.uk", "co.jp", "co.uk", "com.au", "com.br", "gov.uk", "org.uk")


@dataclass(frozen=True)
class UrlRule:
    action: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        same = (host == self.host) | host.endswith("." + self.host)
        return same & path.startswith(self.path)


RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    address = F.coalesce(F.col(url), F.lit(""))
    start = F.instr(address, "://")
    rest = F.when(start > 0, F.substring(address, start + 3, F.length(address))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    behind = F.substring(rest, F.length(host) + 1, F.length(rest))
    return pages.withColumns(
        {"host": F.translate(host, _UPPER, _LOWER), "path": F.regexp_extract(behind, "^[^?#]*", 0)}
    )


def _listed(suffixes: tuple[str, ...]) -> str:
    return "".join(s.replace(".", "[.]").replace("*", "[^.]+") + "|" for s in suffixes)


def suffix_pattern(suffixes: tuple[str, ...] = SUFFIXES) -> str:
    return f"(^|[.])({_listed(suffixes)}[^.]*)$"


def domain_pattern(suffixes: tuple[str, ...] = SUFFIXES) -> str:
    return f"([^.]+[.])?({_listed(suffixes)}[^.]*)$"


# a host may hold a user's name and a port, or be a number in place of a name
_NOT_NAME = "^.*@|:[0-9]*$"
_ADDRESS = r"^([0-9]+[.]){3}[0-9]+$|^\["


def _with_levels(df: DataFrame, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    # a match begins as far to the left as it can, so the longest listed suffix counts
    name = F.regexp_replace("host", _NOT_NAME, "")
    listed = F.regexp_extract(name, suffix_pattern(suffixes), 2)
    domain = F.regexp_extract(name, domain_pattern(suffixes), 0)
    number = name.rlike(_ADDRESS)
    return df.withColumns(
        {
            "suffix": F.when(number, name).otherwise(listed),
            "domain": F.when(number, name).otherwise(domain),
        }
    )


def _strength(level: DataFrame) -> float:
    """The beta prior's strength at a level (columns ``n, bad``), by moments."""
    n, bad = F.col("n").cast("double"), F.col("bad").cast("double")
    row = level.agg(
        F.count("*").alias("groups"),
        F.sum(n).alias("n"),
        F.sum(bad).alias("bad"),
        F.sum(bad * bad / n).alias("square"),
        F.sum(n * n).alias("sizes"),
    ).first()
    if not row.groups or row.groups < 2 or not 0 < row.bad < row.n:
        return MAX_STRENGTH
    mean = row.bad / row.n
    spread = row.square / row.n - mean * mean
    chance = mean * (1 - mean) * row.groups / row.n
    between = (spread - chance) / (1 - row.sizes / (row.n * row.n))
    if between <= 0:
        return MAX_STRENGTH
    return min(MAX_STRENGTH, max(MIN_STRENGTH, mean * (1 - mean) / between - 1))


def reputations(
    outcomes: DataFrame, suffixes: tuple[str, ...] = SUFFIXES
) -> tuple[list[DataFrame], float]:
    """Posterior rates of suffixes, domains and hosts, and the overall rate.

    ``outcomes`` has ``host, n, bad``, one row for each host with a labelled page. Tables
    have the level's key, ``rate`` (posterior mean) and ``weight`` (its beta's ``a + b``).
    """
    hosts = _with_levels(outcomes, suffixes)
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    ends = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = ends.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = total.bad / total.n if total.n else 0.0

    def shrunk(level: DataFrame, key: str, strength: float) -> DataFrame:
        weight = F.lit(strength) + F.col("n")
        rate = (F.col("bad") + strength * F.col("above")) / weight
        return level.select(key, rate.alias(f"{key}_rate"), weight.alias(f"{key}_weight"))

    by_suffix = shrunk(ends.withColumn("above", F.lit(overall)), "suffix", _strength(ends))
    above = domains.join(by_suffix, "suffix").withColumn("above", F.col("suffix_rate"))
    by_domain = shrunk(above, "domain", _strength(domains))
    above = hosts.join(by_domain, "domain").withColumn("above", F.col("domain_rate"))
    by_host = shrunk(above, "host", _strength(hosts))
    return [by_suffix, by_domain, by_host], overall


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``host, n, bad``: a labelled page is bad if its quality is 0 or it is toxic."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    known = labels.filter("quality is not null or toxic is not null")
    known = known.groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max(F.coalesce(bad, F.lit(False)).cast("long")).alias("bad")
    )
    joined = pages.join(known, "page_id")
    return joined.groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: tuple[UrlRule, ...] = RULES,
    threshold: float = THRESHOLD,
    deviations: float = DEVIATIONS,
    suffixes: tuple[str, ...] = SUFFIXES,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` and the posterior's ``rate`` and ``bound``.

    ``suffixes`` are those of several labels, ``*`` standing for any one label.
    """
    pages = with_host_and_path(pages.select("page_id", "url"))
    outcomes = page_outcomes(pages, labels)
    (by_suffix, by_domain, by_host), overall = reputations(outcomes, suffixes)
    # levels are joined to the distinct hosts; pages meet one table, by host only
    known = _with_levels(pages.select("host").distinct(), suffixes).join(by_host, "host", "left")
    known = known.join(by_domain, "domain", "left").join(by_suffix, "suffix", "left")
    rate = F.coalesce("host_rate", "domain_rate", "suffix_rate", F.lit(overall))
    weight = F.coalesce("host_weight", "domain_weight", "suffix_weight", F.lit(MAX_STRENGTH))
    bound = rate - deviations * F.sqrt(rate * (1 - rate) / (weight + 1))
    known = known.select("host", rate.alias("rate"), bound.alias("bound"))
    judged = pages.join(known, "host", "left")
    rule, action = F.when(F.lit(False), ""), F.when(F.lit(False), "")
    for each in sorted(rules, key=lambda r: -len(str(r))):
        fits = each.fits(F.col("host"), F.col("path"))
        rule, action = rule.when(fits, str(each)), action.when(fits, each.action)
    method = F.when(F.col("bound") > threshold, "block").otherwise("allow")
    return judged.select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(action, method).alias("verdict"),
        "rate",
        "bound",
    )


# --- the same in SQL ------------------------------------------------------------


def oracle() -> str:
    """``page_id, host, path, rule, verdict, rate, bound`` of all pages, in DuckDB's SQL."""
    cases = sorted(RULES, key=lambda r: -len(str(r)))
    fits = [
        f"(host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}')"
        for r in cases
    ]
    rule = " ".join(f"when {f} then '{r}'" for r, f in zip(cases, fits))
    action = " ".join(f"when {f} then '{r.action}'" for r, f in zip(cases, fits))

    def strength(level: str) -> str:
        return f"""
        {level}_sums as (
          select count(*) as k, sum(n) as n, sum(bad) as bad,
                 sum(cast(bad as double) * bad / n) as square,
                 sum(cast(n as double) * n) as sizes, sum(bad) / sum(n) as mean
          from {level}s),
        {level}_between as (
          select k, n, bad, mean,
                 (square / n - mean * mean - mean * (1 - mean) * k / n)
                 / nullif(1 - sizes / (n * n), 0) as between_
          from {level}_sums),
        {level}_strength as (
          select case when k < 2 or bad <= 0 or bad >= n or between_ is null or between_ <= 0
                      then {MAX_STRENGTH}
                      else least({MAX_STRENGTH},
                                 greatest({MIN_STRENGTH}, mean * (1 - mean) / between_ - 1))
                 end as s from {level}_between)"""

    return f"""
    with cut as (
      select page_id, case when instr(coalesce(url, ''), '://') > 0
                           then substr(url, instr(url, '://') + 3) else '' end as rest
      from pages),
    located as (
      select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') as host,
             regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1),
                            '^[^?#]*') as path
      from cut),
    named as (select *, regexp_replace(host, '{_NOT_NAME}', '', 'g') as name from located),
    leveled as (
      select *, case when regexp_matches(name, '{_ADDRESS}') then name
                     else regexp_extract(name, '{suffix_pattern()}', 2) end as suffix,
             case when regexp_matches(name, '{_ADDRESS}') then name
                  else regexp_extract(name, '{domain_pattern()}') end as domain
      from named),
    known as (
      select doc_id as page_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as bad
      from labels where quality is not null or toxic is not null group by doc_id),
    hosts as (
      select host, domain, suffix, count(*) as n, sum(bad) as bad
      from leveled join known using (page_id) group by all),
    domains as (
      select domain, suffix, sum(n) as n, sum(bad) as bad from hosts group by all),
    suffixs as (select suffix, sum(n) as n, sum(bad) as bad from domains group by all),
    overall as (select coalesce(sum(bad) / sum(n), 0) as rate from suffixs),
    {strength("suffix")}, {strength("domain")}, {strength("host")},
    by_suffix as (
      select suffix, (bad + s * rate) / (s + n) as rate, s + n as weight
      from suffixs, overall, suffix_strength),
    by_domain as (
      select domain, (d.bad + s * b.rate) / (s + d.n) as rate, s + d.n as weight
      from domains d join by_suffix b using (suffix), domain_strength),
    by_host as (
      select host, (h.bad + s * b.rate) / (s + h.n) as rate, s + h.n as weight
      from hosts h join by_domain b using (domain), host_strength),
    judged as (
      select page_id, host, path, coalesce(h.rate, d.rate, x.rate, o.rate) as rate,
             coalesce(h.weight, d.weight, x.weight, {MAX_STRENGTH}) as weight
      from leveled left join by_host h using (host) left join by_domain d using (domain)
           left join by_suffix x using (suffix), overall o),
    bounded as (
      select *, rate - {DEVIATIONS} * sqrt(rate * (1 - rate) / (weight + 1)) as bound from judged)
    select page_id, host, path, case {rule} end as rule,
           coalesce(case {action} end,
                    case when bound > {THRESHOLD} then 'block' else 'allow' end) as verdict,
           round(rate, 6) as rate, round(bound, 6) as bound
    from bounded
    """
