"""URL filter: rules first, then the reputation of the host (empirical Bayes).

A rule is an action, a host and a path. It fits its host and all subdomains if the url's path
starts with the rule's; of the rules that fit the longest wins (host and path together).

Pages without a rule follow their host's share of good outcomes among labelled pages, shrunk
through beta-binomial priors: the share of a suffix towards that of all pages, of a registered
domain towards its suffix, of a host towards its domain. How strongly a level pulls follows from
how much its members differ (analysis of variance). A page is blocked if the upper bound of its
host's posterior share is below ``least_good``: hosts that are known to be bad go, and hosts of
which little is known stay. Without labels nothing is known.

Only DataFrame functions are used. Outcomes are counted for each host before anything is joined,
so a host with a third of all pages is one row a task; its pages meet one row.

Null urls, or without ``://``, have an empty host and path, and count as a host of that name.
Repeated pages are judged alike. Result columns replace columns of the same name.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm._common import without


class Rule(NamedTuple):
    action: str
    host: str
    path: str


#: Suffixes of more than one label under which names are registered.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "co.jp", "co.nz", "com.br", "co.in", "co.za")
LEAST_GOOD, DEVIATIONS = 0.5, 1.645
#: Correlation of outcomes within a host, domain or suffix: smallest and largest that is believed, and that taken when it can't be told.
CORRELATION = (0.001, 0.5, 0.1)
RESULTS = ("host", "path", "rule", "verdict")
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str) -> Column:
    return F.when(F.instr(url, "://") > 0, F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), CAPITALS, SMALL)).otherwise("")


def path_of(url: str) -> Column:
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def _rest(url: str) -> Column:
    return F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")


def suffix_of(host: Column) -> Column:
    last = F.regexp_extract(host, r"([^.]*)$", 1)
    return reduce(lambda out, s: F.when(host.endswith("." + s), F.lit(s)).otherwise(out), LONG_SUFFIXES, last)


def domain_of(host: Column, suffix: Column) -> Column:
    """The label before the suffix, with it; a host that is a suffix stands for itself."""
    before = F.substring(host, F.lit(1), F.length(host) - F.length(suffix) - 1)
    return F.when(host == suffix, host).otherwise(F.concat(F.regexp_extract(before, r"([^.]*)$", 1), F.lit("."), suffix))


def rule_of(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and action of the longest rule that fits, else null. ``rules`` is configuration: a list in the code."""
    text = action = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host + r.path), r.host + r.path)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text, action = F.when(fits, F.lit(rule.host + rule.path)).otherwise(text), F.when(fits, F.lit(rule.action)).otherwise(action)
    return text, action


def pull(counts: DataFrame) -> float:
    """Strength of the prior for units with n outcomes of which g are good: how many outcomes it is worth."""
    low, high, unknown = CORRELATION
    s = counts.where("n > 0").agg(
        F.count("*").alias("units"), F.sum("n").alias("n"), F.sum("g").alias("g"), F.sum(F.expr("n * n")).alias("nn"),
        F.sum(F.expr("cast(g as double) * g / n")).alias("gg")).first()  # one row
    if s["units"] < 2 or s["n"] <= s["units"]:
        return 1 / unknown - 1
    share = s["g"] / s["n"]
    between = (s["gg"] - s["n"] * share * share) / (s["units"] - 1)
    inside = (s["g"] - s["gg"]) / (s["n"] - s["units"])
    size = (s["n"] - s["nn"] / s["n"]) / (s["units"] - 1)
    spread = between + (size - 1) * inside
    correlation = (between - inside) / spread if spread > 0 else low
    return 1 / min(high, max(low, correlation)) - 1


def reputation(outcomes: DataFrame, deviations: float = DEVIATIONS) -> DataFrame:
    """(host, share, upper) of every host in (host, n, g): its posterior share of good outcomes, and a bound."""
    hosts = outcomes.withColumn("suffix", suffix_of(F.col("host")))
    hosts = hosts.withColumn("domain", domain_of(F.col("host"), F.col("suffix")))
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("g").alias("g")).first()  # one row
    share = total["g"] / total["n"] if total["n"] else 0.5

    def shrunk(prior, strength: float) -> Column:
        return (F.col("g") + strength * prior) / (F.col("n") + strength)

    suffixes = suffixes.select(F.col("suffix").alias("_suffix"), shrunk(F.lit(share), pull(suffixes)).alias("of_suffix"))
    by_domain = pull(domains)
    domains = domains.join(suffixes, F.col("suffix") == F.col("_suffix")).select(F.col("domain").alias("_domain"), shrunk(F.col("of_suffix"), by_domain).alias("of_domain"))
    by_host = pull(hosts)
    hosts = hosts.join(domains, F.col("domain") == F.col("_domain")).select("host", "n", shrunk(F.col("of_domain"), by_host).alias("share"))
    return hosts.select("host", "share", (F.col("share") + deviations * F.sqrt(F.col("share") * (1 - F.col("share")) / (F.col("n") + by_host + 1))).alias("upper"))


def judge(pages: DataFrame, rules: list[Rule], outcomes: DataFrame, url: str = "url", least_good: float = LEAST_GOOD) -> DataFrame:
    """All columns, and: host, path, rule (text or null), verdict (allow or block).

    ``outcomes``: (url, good) of labelled pages, good 0 or 1.
    """
    judged = without(pages, [c for c in RESULTS if c != url]).withColumns({"host": host_of(url), "path": path_of(url)})
    known = outcomes.select(host_of("url").alias("host"), F.col("good").cast("long").alias("g")).where("g is not null")
    counted = known.groupBy("host").agg(F.count("*").alias("n"), F.sum("g").alias("g"))
    every = judged.select("host").distinct().join(counted, "host", "left").select("host", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("g", F.lit(0)).alias("g"))
    scores = reputation(every).select(F.col("host").alias("_host"), "upper")
    rule, action = rule_of(rules, F.col("host"), F.col("path"))
    method = F.when(F.col("upper") < least_good, "block").otherwise("allow")
    joined = judged.join(scores, F.col("host") == F.col("_host"), "left")
    return joined.withColumns({"rule": rule, "verdict": F.coalesce(action, method)}).drop("_host", "upper")
