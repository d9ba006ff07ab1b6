"""URL rules, and host reputation by empirical Bayes where no rule fits.

Outcomes of labelled pages are counted per host, registered domain and public
suffix. Every level is a beta-binomial whose prior mean is the posterior mean
one level up and whose strength comes from the spread between the groups of
that level (moments). A host is blocked when the lower credible bound of its
bad share lies over a limit, so a few bad pages of a small host are not enough.

Everything after the first count works on one row per host. Only DataFrame
functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.llm.frames import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LIMIT = 0.5
Z = 1.645
# Suffixes of two labels; every other suffix is the last label.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "co.nz", "com.br")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*long_suffixes), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> Column:
    """Suffix and one label more."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*long_suffixes), F.substring_index(host, ".", -3)).otherwise(two)


@dataclass(frozen=True)
class UrlRule:
    """A rule as written: a host, then a path that begins with ``/``."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def longest_rule(rules: Sequence[UrlRule], host: Column, path: Column) -> Column:
    """Text and verdict of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        found = F.when(r.fits(host, path), F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def _strength(groups: DataFrame, least: float = 1.0, most: float = 1e4) -> float:
    """Prior strength from the spread of the groups' shares (moments of the beta-binomial)."""
    n, x = F.col("n").cast("double"), F.col("x").cast("double")
    s = groups.filter("n > 0").agg(
        F.count(F.lit(1)).alias("g"),
        F.sum(n).alias("n"),
        F.sum(x).alias("x"),
        F.sum(n * n).alias("nn"),
        F.sum(x * x / n).alias("xx"),
    ).first()
    if not s["n"] or s["g"] < 2 or not 0 < s["x"] < s["n"]:
        return most if s["g"] else least
    m = s["x"] / s["n"]
    spread = (s["xx"] - s["x"] * m) / (m * (1 - m))
    room = s["n"] - s["nn"] / s["n"] - (s["g"] - 1)
    rho = (spread - (s["g"] - 1)) / room if room > 0 else 0.0
    return most if rho <= 1 / (most + 1) else max(least, 1 / rho - 1)


def reputations(outcomes: DataFrame, hosts: DataFrame, z: float = Z) -> DataFrame:
    """n, x (bad) and the lower bound of the bad share, for every host in ``hosts``.

    ``outcomes`` has a row per labelled page: host and bad (0 or 1, nulls are
    left out). Hosts without an outcome have their domain's expectation. With
    no outcome at all the bound is that of a share of one half and strength 1.
    """
    seen = outcomes.filter("bad is not null").groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").cast("long").alias("x"))
    every = (
        hosts.select("host").distinct().join(seen, "host", "full")
        .select("host", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("x", F.lit(0)).alias("x"))
        .withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    )

    def grouped(*by: str) -> DataFrame:
        return every.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("x").alias("x"))

    domains, suffixes = grouped("domain", "suffix"), grouped("suffix")
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("x").alias("x")).first()
    mean = ((total["x"] or 0) + 0.5) / ((total["n"] or 0) + 1.0)
    ks, kd, kh = _strength(suffixes), _strength(domains), _strength(every)
    by_suffix = suffixes.select("suffix", ((F.col("x") + mean * ks) / (F.col("n") + ks)).alias("ps"))
    by_domain = domains.join(by_suffix, "suffix").select("domain", ((F.col("x") + F.col("ps") * kd) / (F.col("n") + kd)).alias("pd"))
    a = F.col("x") + F.col("pd") * kh
    b = F.col("n") - F.col("x") + (1 - F.col("pd")) * kh
    share = a / (a + b)
    return every.join(by_domain, "domain").select(
        "host", "n", "x", (share - z * F.sqrt(share * (1 - share) / (a + b + 1))).alias("bound")
    )


def judged(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[UrlRule],
    *,
    page_id: str = "page_id",
    url: str = "url",
    limit: float = LIMIT,
    z: float = Z,
) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's labelled and bad pages, for every row.

    A rule's verdict goes first; else ``block`` where the host's lower bound
    lies over ``limit``. Urls that are null or have no ``://`` have an empty
    host, which has a reputation like any other. Repeated rows and null ids
    stay; an empty table gives no rows; other columns are not read.
    """
    parts = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    # Written, so that the join below has two plain sides and a hot host can be split.
    known = materialise(reputations(outcomes, parts, z), "hosts")
    hit = parts.withColumn("hit", longest_rule(rules, F.col("host"), F.col("path")))
    by_host = F.when(F.col("bound") > limit, "block").otherwise("allow")
    return hit.join(known, "host", "left").select(
        "page_id",
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", by_host).alias("verdict"),
        F.col("n").alias("n_labelled"),
        F.col("x").alias("n_bad"),
    )
