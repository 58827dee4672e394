"""URL filters: fixed rules first, empirical-Bayes host reputation for the rest.

Labelled page outcomes (bad or not) are summed per host, per registered domain and per
suffix. Each level's rate is a beta-binomial posterior whose prior is centred on the level
above it: the suffix is shrunk to the overall rate, the domain to its suffix, the host to
its domain. A page is blocked when even the lower bound of its host's bad rate is above a
limit, so hosts with few labels are judged like their domain.

Only DataFrame expressions; sums are partial before they are shuffled, and the joins are on
hosts, where a hot host's rows are split by the adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A host with a path prefix, as in ``example.net/en/``; fits the host and its subdomains."""

    pattern: str
    verdict: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


@dataclass(frozen=True)
class Reputation:
    """Strength of the priors in pseudo-pages, width of the bound in deviations, and the limit."""

    strength: float = 8.0
    deviations: float = 1.0
    limit: float = 0.2


RULES = (Rule("net/", "block"), Rule("example.net/en/", "allow"), Rule("example.com/de/", "block"), Rule("org/fr/", "allow"))


def after_scheme(url: Column) -> Column:
    place = F.instr(url, "://")
    return F.when(place > 0, F.substr(url, place + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def registered_domain(host: Column) -> Column:
    """The last two labels of a host, without a port."""
    return F.substring_index(F.substring_index(host, ":", 1), ".", -2)


def suffix(host: Column) -> Column:
    return F.substring_index(F.substring_index(host, ":", 1), ".", -1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> tuple[Column, Column]:
    """Pattern and verdict of the longest rule that fits, both null when none does."""
    pattern, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        pattern = F.when(fits, F.lit(rule.pattern)).otherwise(pattern)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return pattern, verdict


def _posterior(bad: Column, seen: Column, prior: Column, strength: float) -> Column:
    return (bad + prior * F.lit(strength)) / (seen + F.lit(strength))


def host_reputation(counts: DataFrame, settings: Reputation = Reputation()) -> DataFrame:
    """Per host: posterior rate of bad pages and its lower bound.

    ``counts`` has one row per host with its labelled pages (seen) and the bad ones (bad);
    a host without labels takes its domain's rate. Without any label every rate is 0, so
    nothing is blocked but by rule. An empty table gives an empty one.
    """
    hosts = counts.select(
        "host",
        *(F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in ("bad", "seen")),
        registered_domain(F.col("host")).alias("domain"),
        suffix(F.col("host")).alias("suffix"),
    )
    sums = [F.sum("bad").alias("bad"), F.sum("seen").alias("seen")]
    k, bad, seen = settings.strength, F.col("bad"), F.col("seen")
    overall = hosts.agg(*sums).select(F.when(seen > 0, _posterior(bad, seen, F.lit(0.5), 1.0)).otherwise(0.0)).scalar()
    suffixes = hosts.groupBy("suffix").agg(*sums)
    suffixes = suffixes.select("suffix", _posterior(bad, seen, overall, k).alias("suffix_rate"))
    domains = hosts.groupBy("domain", "suffix").agg(*sums).join(suffixes, "suffix")
    domains = domains.select("domain", _posterior(bad, seen, F.col("suffix_rate"), k).alias("domain_rate"))
    rated = hosts.join(domains, "domain").withColumn("rate", _posterior(bad, seen, F.col("domain_rate"), k))
    spread = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (seen + F.lit(k + 1.0)))
    return rated.select("host", "rate", (F.col("rate") - F.lit(settings.deviations) * spread).alias("lower_bound"))


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule] = RULES,
    settings: Reputation = Reputation(),
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """Per page: id, host, path, rule, verdict, rate and lower bound of its host.

    ``outcomes`` has the page key and ``bad`` (1, 0, or null for not labelled); a page
    labelled more than once counts every label. A null url or one without ``://`` has an
    empty host and path and is judged with all other such pages; repeated pages are judged
    row by row, and a null key has no labels.
    """
    split = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    labels = outcomes.groupBy(key).agg(F.sum("bad").alias("bad"), F.count("bad").alias("seen"))
    counts = split.join(labels, key, "left").groupBy("host").agg(F.sum("bad").alias("bad"), F.sum("seen").alias("seen"))
    pattern, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("lower_bound") > settings.limit, F.lit("block")).otherwise(F.lit("allow"))
    return split.join(host_reputation(counts, settings), "host").select(
        key, "host", "path", pattern.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "rate", "lower_bound"
    )
