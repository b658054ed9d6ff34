"""URL filter: explicit host/path rules first, an empirical-Bayes host reputation for the rest.

Labelled page outcomes (bad or not) are counted by host. A beta-binomial prior is handed down
global -> suffix -> registered domain -> host: each level's posterior mean is the mean of the next
level's prior, and the prior's strength comes from that level's own over-dispersion (method of
moments). A page without a rule is blocked if the lower posterior bound of its host's bad rate is
above ``threshold``, so a host with little evidence is not blocked.

Scale: pages are aggregated to hosts with map-side combine, hosts to domains, domains to suffixes;
each level is written once, so the joins back are plain joins of two scans, which adaptive
execution may broadcast by measured size or split where a key is hot. Nothing per host is collected;
three single-row sums reach the driver.

Edge cases: a null url, or one without ``://``, has empty host and path and is judged as host ''.
Null page ids take part but carry no outcomes. Repeated page rows are judged each, and count each.
An empty table gives an empty result; without any label the prior mean is 0.5 and nothing is blocked.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import ascii_lower, stash

# Second-level labels that act as public suffixes under a country code.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def parse_url(url: Column) -> tuple[Column, Column]:
    """(host, path) by plain splitting; A-Z of the host lower-cased."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, pattern, i), F.lit(""))
    return ascii_lower(part(1)), part(2)


def match_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule text, its verdict) of the longest fitting rule, else nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = F.when(fits, F.lit(r.text)).otherwise(text), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def domain_parts(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host; addresses and single labels are their own domain."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    second = "|".join(SECOND_LEVEL)
    suffix = F.when(bare.rlike(r"^[0-9.]+$"), F.lit("(address)")).otherwise(
        F.regexp_extract(bare, rf"((?:(?<=\.)(?:{second})\.[a-z]{{2}})|[^.]*)$", 1)
    )
    domain = F.when(bare.rlike(r"^[0-9.]+$"), bare).otherwise(
        F.regexp_extract(bare, rf"([^.]*\.(?:{second})\.[a-z]{{2}}|[^.]*\.[^.]*|[^.]*)$", 1)
    )
    return domain, suffix


def _strength(groups: DataFrame) -> float:
    """Prior strength of one level from groups (n, y, m): E[(y-nm)^2 / (nm(1-m))] = 1 + (n-1) rho."""
    stat = F.pow(F.col("y") - F.col("n") * F.col("m"), 2) / (F.col("n") * F.col("m") * (1 - F.col("m")))
    row = groups.filter("n > 0").agg(F.sum(stat - 1).alias("s"), F.sum(F.col("n") - 1).alias("d")).first()
    rho = row["s"] / row["d"] if row["s"] is not None and row["d"] else 0.5
    return 1 / min(max(rho, 0.001), 0.5) - 1


def host_reputation(hosts: DataFrame, z: float = 1.645) -> DataFrame:
    """hosts (host, n, y) -> host, n, y, prior_mean, mean, lower, upper."""
    domain, suffix = domain_parts(F.col("host"))
    hosts = stash(hosts.select("host", "n", "y", domain.alias("domain"), suffix.alias("suffix")), "hosts")
    domains = stash(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("y").alias("y")), "domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    whole = suffixes.agg(F.sum("n").alias("n"), F.sum("y").alias("y")).first()
    mu = ((whole["y"] or 0) + 0.5) / ((whole["n"] or 0) + 1.0)

    def posterior(df: DataFrame, name: str, strength: float) -> DataFrame:
        return df.withColumn(name, (F.col("y") + strength * F.col("m")) / (F.col("n") + strength))

    suffixes = stash(suffixes.withColumn("m", F.lit(mu)), "suffixes")
    suffixes = posterior(suffixes, "up", _strength(suffixes)).select("suffix", F.col("up").alias("m"))
    domains = stash(domains.join(suffixes, "suffix"), "domain-priors")
    domains = posterior(domains, "up", _strength(domains)).select("domain", "suffix", F.col("up").alias("m"))
    hosts = stash(hosts.join(domains, ["domain", "suffix"]), "host-priors")
    strength = _strength(hosts)
    a, b = F.col("y") + strength * F.col("m"), F.col("n") - F.col("y") + strength * (1 - F.col("m"))
    mean = a / (a + b)
    sd = F.sqrt(mean * (1 - mean) / (a + b + 1))
    return hosts.select(
        "host", "n", "y", F.col("m").alias("prior_mean"), mean.alias("mean"),
        F.greatest(F.lit(0.0), mean - z * sd).alias("lower"), F.least(F.lit(1.0), mean + z * sd).alias("upper"),
    )


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: list[Rule], threshold: float = 0.5, z: float = 1.645
) -> DataFrame:
    """pages (page_id, url), outcomes (page_id, bad 0/1 or null) -> page_id, host, path, rule, verdict, and the host's bounds."""
    host, path = parse_url(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    by_page = outcomes.filter("page_id is not null and bad is not null").groupBy("page_id").agg(
        F.count("*").alias("n"), F.sum("bad").alias("y")
    )
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    hosts = parsed.join(by_page, "page_id", "left").groupBy("host").agg(zero("n").alias("n"), zero("y").alias("y"))
    bounds = stash(host_reputation(hosts, z).select("host", "mean", "lower", "upper"), "host-bounds")
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    judged = parsed.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("told"))
    own = F.when(F.col("lower") > threshold, F.lit("block")).otherwise(F.lit("allow"))
    return judged.join(bounds, "host").select(
        "page_id", "host", "path", "rule", F.coalesce("told", own).alias("verdict"), "mean", "lower", "upper"
    )
