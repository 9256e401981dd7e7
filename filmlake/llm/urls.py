"""URL verdicts from rules and, beyond them, from the reputation of hosts.

Reputation. Pages that a rule judges are the labelled ones, with outcome 1 if it blocks them and 0 if it
allows them; other pages say nothing of their host. A host's rate is
shrunk to that of its registered domain, the domain's to that of its suffix, and that to
the rate of all labelled pages; a host without any has the rate of the levels above. Each level's prior is a beta distribution whose strength comes from
the data: the spread of the rates beyond what chance gives (method of moments). A page
without a rule is blocked when the lower bound of its host's posterior exceeds a limit. A host
of few labelled pages goes by its domain and suffix, as far as the labelled pages show these to be alike.

NULL urls and urls without ``://`` have an empty host and path and are judged like a host
of their own. Repeated pages count each; ties cannot occur, since rules differ in length
where two fit the same url. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmlake.llm.steps import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"

# Second labels that make a suffix of two, before a country's label
SECOND_LABELS = ("ac", "co", "com", "edu", "gov", "net", "org")

# a page is blocked if the rate of its host lies above LIMIT, by Z standard deviations
LIMIT = 0.5
Z = 1.645
STRENGTHS = (1.0, 1000.0)


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


def host_of(url: str) -> Column:
    host = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), URL, 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), URL, 2)


def longest_rule(rules: Sequence[Rule], host: str, path: str, value: str) -> Column:
    """``text`` or ``verdict`` of the longest rule that fits; NULL if none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda rule: len(rule.text)):
        fits = (F.col(host) == rule.host) | F.col(host).endswith("." + rule.host)
        fits &= F.col(path).startswith(rule.path)
        out = F.when(fits, F.lit(getattr(rule, value))).otherwise(out)
    return out


def named_host(host: str) -> Column:
    """The host without user and port."""
    return F.regexp_replace(F.regexp_replace(host, r"(?s)^.*@", ""), r":[0-9]*$", "")


def domain_and_suffix(name: str) -> dict[str, Column]:
    """Registered domain and suffix of a host; an address in numbers is its own domain."""
    labels = F.split(name, r"\.")
    two = (
        (F.size(labels) > 2)
        & (F.length(F.element_at(labels, -1)) == 2)
        & F.try_element_at(labels, F.lit(-2)).isin(*SECOND_LABELS)
    )
    number = F.col(name).rlike(r"^[0-9.]+$")
    return {
        "suffix": F.when(number, "").when(two, F.substring_index(name, ".", -2)).otherwise(F.substring_index(name, ".", -1)),
        "domain": F.when(number, F.col(name)).when(two, F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2)),
    }


def _strength(level: DataFrame) -> float:
    """Strength of the beta prior ``mean`` from the spread of ``bad / n`` around it."""
    mean, rate = F.col("mean"), F.try_divide("bad", "n")
    row = level.agg(
        F.sum(F.col("n") * (rate - mean) * (rate - mean)).alias("seen"),
        F.sum(F.col("n") * mean * (1 - mean)).alias("chance"),
        F.sum("n").alias("n"),
        F.count_if(F.col("n") > 0).alias("k"),
    ).first()
    low, high = STRENGTHS
    if not row.n or not row.chance:
        return high
    excess = row.n * row.seen / row.chance - row.k
    return high if excess <= 0 else min(high, max(low, (row.n - row.k) / excess - 1))


def _shrunk(level: DataFrame, strength: float) -> Column:
    return (F.col("bad") + strength * F.col("mean")) / (F.col("n") + F.lit(strength))


def reputations(hosts: DataFrame) -> DataFrame:
    """``host`` and ``bound`` for a table of ``host``, ``n`` labelled pages and ``bad`` ones among them."""
    scratch = Scratch(hosts.sparkSession, "urls")
    hosts = scratch.keep(hosts.withColumn("name", named_host("host")).withColumns(domain_and_suffix("name")), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = ((total.bad or 0) + 0.5) / ((total.n or 0) + 1.0)
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    suffixes = hosts.groupBy("suffix").agg(*sums).withColumn("mean", F.lit(overall))
    means = suffixes.select("suffix", _shrunk(suffixes, _strength(suffixes)).alias("mean"))
    domains = scratch.keep(hosts.groupBy("suffix", "domain").agg(*sums).join(means, "suffix"), "domains")
    means = domains.select("suffix", "domain", _shrunk(domains, _strength(domains)).alias("mean"))
    known = scratch.keep(hosts.join(means, ["suffix", "domain"]), "known")
    strength = _strength(known)
    bad = F.col("bad") + strength * F.col("mean")
    good = F.col("n") - F.col("bad") + strength * (1 - F.col("mean"))
    mean, size = bad / (bad + good), bad + good
    return scratch.keep(known.select("host", (mean - Z * F.sqrt(mean * (1 - mean) / (size + 1))).alias("bound")), "bounds")


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every row of ``pages``."""
    seen = pages.select(F.col(key).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    seen = seen.select(
        "*",
        longest_rule(rules, "host", "path", "text").alias("rule"),
        longest_rule(rules, "host", "path", "verdict").alias("ruled"),
    )
    hosts = seen.groupBy("host").agg(
        F.count("ruled").alias("n"), F.count_if(F.col("ruled") == "block").alias("bad")
    )
    own = F.when(F.col("bound") > LIMIT, "block").otherwise("allow")
    return seen.join(reputations(hosts), "host").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict")
    )


ORACLE = r"""
WITH seen AS (
    SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages
), ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM seen
), counted AS (
    SELECT host, count(rule) AS n, count(*) FILTER (rule IN ('net/', 'example.com/de/')) AS bad,
        regexp_replace(regexp_replace(host, '(?s)^.*@', ''), ':[0-9]*$', '') AS name
    FROM ruled GROUP BY host
), labelled AS (
    SELECT *, string_split(name, '.') AS labels, regexp_matches(name, '^[0-9.]+$') AS number FROM counted
), sized AS (
    SELECT *, CASE WHEN len(labels) > 2 AND length(labels[-1]) = 2
        AND labels[-2] IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org') THEN 2 ELSE 1 END AS w
    FROM labelled
), hosts AS (
    SELECT host, n, bad, CASE WHEN number THEN '' ELSE array_to_string(labels[-w:], '.') END AS suffix,
        CASE WHEN number THEN name ELSE array_to_string(labels[-(w + 1):], '.') END AS domain
    FROM sized
), overall AS (SELECT (sum(bad) + 0.5) / (sum(n) + 1.0) AS mean FROM hosts),
suffixes AS (
    SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(mean) AS mean FROM hosts, overall GROUP BY suffix
), s1 AS (
    SELECT sum(n) * sum(n * (bad / nullif(n, 0) - mean) ** 2) / sum(n * mean * (1 - mean)) - count(*) FILTER (n > 0) AS e, sum(n) - count(*) FILTER (n > 0) AS d FROM suffixes
), m1 AS (SELECT CASE WHEN e <= 0 THEN 1000.0 ELSE least(1000.0, greatest(1.0, d / e - 1)) END AS m FROM s1),
domains AS (
    SELECT h.suffix, h.domain, sum(h.n) AS n, sum(h.bad) AS bad, any_value((s.bad + m * s.mean) / (s.n + m)) AS mean
    FROM hosts h JOIN suffixes s USING (suffix), m1 GROUP BY h.suffix, h.domain
), s2 AS (
    SELECT sum(n) * sum(n * (bad / nullif(n, 0) - mean) ** 2) / sum(n * mean * (1 - mean)) - count(*) FILTER (n > 0) AS e, sum(n) - count(*) FILTER (n > 0) AS d FROM domains
), m2 AS (SELECT CASE WHEN e <= 0 THEN 1000.0 ELSE least(1000.0, greatest(1.0, d / e - 1)) END AS m FROM s2),
known AS (
    SELECT h.host, h.n, h.bad, (d.bad + m * d.mean) / (d.n + m) AS mean
    FROM hosts h JOIN domains d USING (suffix, domain), m2
), s3 AS (
    SELECT sum(n) * sum(n * (bad / nullif(n, 0) - mean) ** 2) / sum(n * mean * (1 - mean)) - count(*) FILTER (n > 0) AS e, sum(n) - count(*) FILTER (n > 0) AS d FROM known
), m3 AS (SELECT CASE WHEN e <= 0 THEN 1000.0 ELSE least(1000.0, greatest(1.0, d / e - 1)) END AS m FROM s3),
posterior AS (SELECT host, (bad + m * mean) / (n + m) AS p, n + m AS size FROM known, m3)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow' WHEN p - 1.645 * sqrt(p * (1 - p) / (size + 1)) > 0.5 THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled JOIN posterior USING (host)
"""
