"""URL filters: rules first, then an empirical-Bayes reputation of hosts.

A page's outcome is bad if a rule blocks it, else good: a rule that names one path of a host says
nothing against the others. Counts by host, registered domain and suffix are shrunk from the top down. At each level a beta prior has the mean of the
level above and a strength that fits the spread of its groups (method of moments); its posterior
mean is handed on. Other pages are blocked when the lower bound of their host's posterior is above
a half, else allowed. A host with few pages stands mostly by its domain, suffix or the whole.

A null url, or one without "://", has an empty host and path. A rule fits its host and the hosts
below, and paths that begin with its own; the longest fitting rule wins, of equally long ones a
block. Rows are judged one by one, whatever repeats; an empty table gives an empty result. Columns
other than page_id and url are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustmill.llm.tables import fold_ascii, measured_broadcast, saved


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)
#: Suffixes of two labels, so that the registered domain below them has three.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in")
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0
DEVIATIONS = 1.645  # of the posterior below its mean: the lower 5 per cent
LIMIT = 0.5

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return fold_ascii(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Name of the rule that decides, or null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.verdict == "block")):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(rule.name)).otherwise(out)
    return out


def suffix_of(host: Column) -> Column:
    last = F.substring_index(host, ".", -1)
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*LONG_SUFFIXES), two).otherwise(last)


def domain_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*LONG_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def _strength(groups: DataFrame, mean: float) -> float:
    """Strength of the beta prior that gives the spread seen between ``groups (n, bad)``."""
    share = F.col("bad") / F.col("n")
    s = groups.filter("n > 0").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
        F.count("*").alias("groups"),
        F.sum(F.col("n") * (share - mean) * (share - mean)).alias("spread"),
    ).first()
    if not s["n"]:
        return LEAST_STRENGTH
    n, chance = float(s["n"]), mean * (1 - mean)
    weight = n - float(s["squares"]) / n
    between = (s["spread"] - (s["groups"] - 1) * chance) / weight if weight > 0 else 0.0
    if between <= 0:
        return MOST_STRENGTH
    return min(MOST_STRENGTH, max(LEAST_STRENGTH, chance / between - 1))


def host_reputations(pages: DataFrame) -> DataFrame:
    """``host, bound``: lower bound of the share of bad pages, for every host of ``pages``.

    ``pages`` has ``host`` and ``bad`` (true, false, or null where no outcome is known).
    """
    hosts = saved(
        pages.groupBy("host").agg(F.count("bad").alias("n"), F.count(F.when(F.col("bad"), 1)).alias("bad"))
    ).select("host", domain_of(F.col("host")).alias("domain"), "n", "bad")
    domains = saved(hosts.groupBy("domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.first("host").alias("host")))
    domains = domains.select("domain", "n", "bad", suffix_of(F.col("host")).alias("suffix"))
    suffixes = saved(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    whole = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = (1 + (whole["bad"] or 0)) / (2 + (whole["n"] or 0))
    at_suffix, at_domain, at_host = (_strength(groups, mean) for groups in (suffixes, domains, hosts))
    top = suffixes.select(
        "suffix", ((F.col("bad") + at_suffix * mean) / (F.col("n") + at_suffix)).alias("above")
    )
    middle = domains.join(measured_broadcast(top), "suffix").select(
        "domain", ((F.col("bad") + at_domain * F.col("above")) / (F.col("n") + at_domain)).alias("above")
    )
    good = F.col("n") - F.col("bad") + at_host * (1 - F.col("above"))
    bad = F.col("bad") + at_host * F.col("above")
    size = good + bad
    share = bad / size
    bound = share - DEVIATIONS * F.sqrt(share * (1 - share) / (size + 1))
    return hosts.join(middle, "domain").select("host", bound.alias("bound"))


def judged_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``page_id, url, host, path, rule, verdict, bad_bound`` of every row."""
    url = F.col("url").cast("string")
    parts = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    parts = parts.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.lit(None).cast("string")
    for rule in rules:
        verdict = F.when(F.col("rule") == rule.name, F.lit(rule.verdict)).otherwise(verdict)
    parts = parts.withColumn("by_rule", verdict)
    hosts = saved(host_reputations(parts.select("host", F.col("by_rule").eqNullSafe("block").alias("bad"))))
    found = F.when(F.col("bound") > LIMIT, "block").otherwise("allow")
    return parts.join(measured_broadcast(hosts), "host", "left").select(
        "page_id",
        "url",
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", found).alias("verdict"),
        F.round("bound", 6).alias("bad_bound"),
    )


def allowed_pages(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows of the judged table that are not blocked."""
    return judged_urls(pages, rules).filter("verdict = 'allow'")
