"""URL rules and empirical-Bayes host reputation.

A rule decides the pages that it fits. For the others, labelled page outcomes (bad
or not) are shrunk through beta-binomial priors: the whole table informs suffixes,
a suffix its registered domains, a domain its hosts. The strength of each prior is
estimated by moments from the spread between groups (three numbers, the only thing
that reaches the driver). A page is blocked when the lower posterior bound of its
host's bad rate reaches the threshold, so hosts with little evidence pass.

Pages are counted by host with map-side aggregation before anything is shuffled;
a host with a third of all pages is then one row. The verdict goes back to the pages
by a sort-merge join whose hot partitions adaptive execution splits. All of it is
DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuelattice.llm.common import materialise

#: Suffixes of more than one label that count as such unless the caller names others (``suffixes``).
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp", "or.jp", "com.br", "com.cn", "com.mx", "co.in", "co.za", "co.kr", "com.tr", "com.ar")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PLACE = r"(?s)\A.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The query's rules.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PLACE, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PLACE, 2), F.lit(""))


def site_of(host: Column) -> Column:
    """The host that reputation is about: without user, port and trailing dots."""
    bare = F.regexp_replace(F.regexp_replace(host, r"\A.*@", ""), r":[0-9]*\z", "")
    return F.regexp_replace(bare, r"\.+\z", "")


#: Hosts that have no domain: addresses.
ADDRESS = r"\A([0-9]{1,3}\.){3}[0-9]{1,3}\z|:"


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as a struct; null if none does. The rules are a short list by contract."""
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        found = F.when(fits, F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def strength(groups: DataFrame, least: float = 0.5, most: float = 1000.0) -> float:
    """Prior observations of a beta-binomial whose groups have ``n`` outcomes, ``bad`` of them bad (method of moments)."""
    sums = groups.where("n > 0").agg(
        F.count("*").alias("g"), F.sum("n").alias("n"), F.sum("bad").alias("k"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("kk")
    ).first()
    if not sums["n"] or sums["g"] < 2:
        return most
    p, free = sums["k"] / sums["n"], sums["g"] - 1
    spread = p * (1 - p)
    room = sums["n"] - sums["nn"] / sums["n"] - free
    if spread <= 0 or room <= 0:
        return most
    rho = (sums["kk"] - sums["n"] * p * p - spread * free) / (spread * room)
    return most if rho <= 0 else min(most, max(least, (1 - rho) / rho))


def reputation(outcomes: DataFrame, z: float = 1.645, suffixes_: tuple[str, ...] = LONG_SUFFIXES) -> DataFrame:
    """host, n, bad, mean, lower from rows (host, bad): bad is 1, 0 or null (no label).

    The registered domain of a host is its last two labels, or three where the last two are
    one of ``suffixes_``; an address is its own domain, below the empty suffix.
    """
    dots = F.split("host", r"\.")
    tail = F.concat_ws(".", F.slice(dots, F.greatest(F.size(dots) - 1, F.lit(1)), 2))
    labels = F.when(tail.isin(*suffixes_), 3).otherwise(2)
    address = F.rlike(F.col("host"), F.lit(ADDRESS))
    domain = F.when(address, F.col("host")).otherwise(F.concat_ws(".", F.slice(dots, F.greatest(F.size(dots) - labels + 1, F.lit(1)), labels)))
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
    hosts = materialise(hosts.withColumn("domain", domain).withColumn("suffix", F.when(address, "").otherwise(F.regexp_replace("domain", r"\A[^.]*\.", ""))), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = total["bad"] / total["n"] if total["n"] else 0.0
    by_suffix, by_domain, by_host = (strength(x) for x in (suffixes, domains, hosts))
    shrunk = lambda prior, m: (F.col("bad") + F.lit(m) * prior) / (F.col("n") + F.lit(m))
    suffix_mean = suffixes.select("suffix", shrunk(F.lit(overall), by_suffix).alias("suffix_mean"))
    domain_mean = domains.join(suffix_mean, "suffix").select("domain", shrunk(F.col("suffix_mean"), by_domain).alias("domain_mean"))
    a = F.col("bad") + F.lit(by_host) * F.col("domain_mean")
    b = F.col("n") - F.col("bad") + F.lit(by_host) * (1 - F.col("domain_mean"))
    mean = a / (a + b)
    return hosts.join(domain_mean, "domain").select("host", "n", "bad", mean.alias("mean"), (mean - z * F.sqrt(mean * (1 - mean) / (a + b + 1))).alias("lower"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, labels: DataFrame | None = None, threshold: float = 0.5, z: float = 1.645, suffixes: tuple[str, ...] = LONG_SUFFIXES) -> DataFrame:
    """page_id, host, path, rule, verdict of every row.

    ``labels`` (page_id, bad) gives outcomes; without it, the pages that a rule
    decides are the labelled ones (blocked: bad). A null url or one without ``://``
    has an empty host and path; such pages are a host of their own. Repeated rows
    are judged and counted each; an empty table gives an empty result; only page_id
    and url are read. Hosts that differ in user, port or trailing dots share a reputation;
    ``suffixes`` names the suffixes of two labels under which domains are registered (a whole
    public list may be given).
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("site", site_of(F.col("host"))).withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    if labels is None:
        outcomes = rows.select(F.col("site").alias("host"), F.when(F.col("found").isNotNull(), (F.col("found.verdict") == "block").cast("int")).alias("bad"))
    else:
        outcomes = rows.join(labels.select(F.col("page_id").alias("label_id"), "bad"), F.col("page_id") == F.col("label_id"), "left").select(F.col("site").alias("host"), "bad")
    known = reputation(outcomes, z, suffixes).select(F.col("host").alias("known_site"), "lower")
    method = F.when(F.col("lower") >= threshold, "block").otherwise("allow")
    return rows.join(known, F.col("site") == F.col("known_site"), "left").select("page_id", "host", "path", F.col("found.text").alias("rule"), F.coalesce(F.col("found.verdict"), method).alias("verdict"))
