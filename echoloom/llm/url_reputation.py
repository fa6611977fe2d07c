"""URL filter: rules first, then empirical-Bayes host reputation.

Labelled page outcomes (bad or not) are counted by host.  A host's rate of bad pages has a
beta-binomial prior around its registered domain's, that one around its suffix's, and that one
around the whole table's.  The strength of a prior is fitted by moments from how much the rates
below it differ.  A page is blocked if the lower bound of its host's posterior is above a limit, so
that a few bad pages on an unknown host do not block it.  Hosts without outcomes fall back on the
prior of the level above.

Only DataFrame expressions.  Hosts are counted once and stored; the levels are fitted on the counts.
Pages meet their host's bound by a join on the host; hosts with HOT_PAGES or more, of which a table has
at most its rows divided by HOT_PAGES, are broadcast instead, so that no host's pages go to one task.
Rules (a host, a path prefix, a verdict) come as a short list and are applied as one array expression,
so that they need no join.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echoloom.llm.common import stored

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: A host is blocked if its rate of bad pages is above LIMIT at the one-sided bound of Z deviations.
LIMIT, Z = 0.5, 1.6448536269514722
#: Bounds of a prior's strength, in pages.
WEAKEST, STRONGEST = 1.0, 200.0


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parse_rule(verdict: str, text: str) -> Rule:
    host, slash, path = text.partition("/")
    return Rule(verdict, host.translate(str.maketrans(CAPITALS, SMALL)), slash + path)


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1), CAPITALS, SMALL)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as a struct (size, rule, verdict); null if none fits."""
    if not rules:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    listed = F.array(*[
        F.struct(F.lit(len(r.text)).alias("size"), F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"), F.lit(r.host).alias("host"), F.lit(r.path).alias("path"))
        for r in rules
    ])
    fits = F.filter(listed, lambda r: ((host == r["host"]) | host.endswith(F.concat(F.lit("."), r["host"]))) & path.startswith(r["path"]))
    return F.array_max(F.transform(fits, lambda r: F.struct(r["size"].alias("size"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))


#: Second labels under which the registries of countries let names be registered.
SECOND_LABELS = ("ac", "co", "com", "edu", "go", "gob", "gouv", "gov", "gv", "ltd", "me", "mil", "ne", "net", "nom", "or", "org", "plc", "sch")
#: The last label of a country has two letters.
_SUFFIX = r"(?:(?:" + "|".join(SECOND_LABELS) + r")\.[a-z]{2}|[^.]+)"
DOMAIN = rf"([^.]+\.)?{_SUFFIX}$"
SUFFIX = rf"(?:^|\.)({_SUFFIX})$"
#: Hosts of so many pages are broadcast.
HOT_PAGES = 1 << 20


def bare(host: Column) -> Column:
    """The host without user, port and closing dots, for the levels above it."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"(:[0-9]*)?\.*$", "")


def _numeric(host: Column) -> Column:
    return host.rlike(r"^[0-9.]+$|^\[")


def domain_of(host: Column) -> Column:
    """The registered domain: the public suffix and one label more; an address is its own."""
    return F.when(_numeric(bare(host)), bare(host)).otherwise(F.regexp_extract(bare(host), DOMAIN, 0))


def suffix_of(domain: Column) -> Column:
    return F.when(_numeric(domain), F.lit("")).otherwise(F.regexp_extract(domain, SUFFIX, 1))


def _strength(rows: DataFrame, rate: str) -> Column:
    """The prior strength by moments: n, bad of children against their parent's rate."""
    # E[(bad - n m)^2] = n m (1 - m) (1 + (n - 1) rho); rho = 1 / (strength + 1).
    n, bad, m = F.col("n"), F.col("bad"), F.col(rate)
    plain = n * m * (1 - m)
    rho = F.try_divide(F.sum((bad - n * m) * (bad - n * m)) - F.sum(plain), F.sum(plain * (n - 1)))
    strength = F.when(rho.isNull() | (rho <= 0), F.lit(STRONGEST)).otherwise(F.try_divide(F.lit(1.0), rho) - 1)
    return F.least(F.greatest(strength, F.lit(WEAKEST)), F.lit(STRONGEST))


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """(host, n, bad) counts to (host, prior, mean, bound): posterior mean and lower bound.

    Each level's posterior mean is the next one's prior.  Without any outcome the rate is one half.
    """
    count = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    hosts = outcomes.withColumn("domain", domain_of(F.col("host")))
    domains = stored(hosts.groupBy("domain").agg(*count).withColumn("suffix", suffix_of(F.col("domain"))))
    suffixes = stored(domains.groupBy("suffix").agg(*count))
    whole = suffixes.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0)) + 1.0)).alias("m")).first()["m"]

    def shrunk(level: DataFrame, named: str) -> DataFrame:
        """(n, bad, m) to the posterior mean; the strength of the level is one number."""
        k = level.agg(_strength(level, "m").alias("k")).first()["k"]
        mean = (F.col("bad") + F.lit(k) * F.col("m")) / (F.col("n") + F.lit(k))
        return level.withColumns({named: mean, "k": F.lit(k)})

    suffix = shrunk(suffixes.withColumn("m", F.lit(whole)), "mean").select("suffix", F.col("mean").alias("m"))
    domain = stored(shrunk(domains.join(suffix, "suffix"), "mean").select("domain", F.col("mean").alias("m")))
    host = shrunk(hosts.join(domain, "domain"), "mean")
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("k") + 1))
    return host.select("host", F.col("m").alias("prior"), "mean", (F.col("mean") - Z * spread).alias("bound"))


def count_outcomes(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(host, pages, n, bad) of all `pages` (host, item): how many, how many labelled, how many bad.

    Of an item's repeated outcomes (item, bad) the worst counts.  Pages that show the same item, and
    repeated rows, each count.
    """
    labelled = outcomes.where("item is not null and bad is not null").groupBy("item").agg(F.max("bad").alias("bad"))
    items = pages.groupBy("host", "item").agg(F.count("*").alias("n"))
    joined = items.join(labelled, "item", "left")
    return joined.groupBy("host").agg(
        F.sum("n").alias("pages"), F.sum(F.when(F.col("bad").isNotNull(), F.col("n")).otherwise(0)).alias("n"), F.sum(F.when(F.col("bad") == 1, F.col("n")).otherwise(0)).alias("bad")
    )


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], item: Column) -> DataFrame:
    """(page_id, host, path, rule, verdict, bound) for every row of (page_id, url).

    `item` gives the labelled item that a page shows, as an expression on `path`.  A null url, or one
    without "://", has an empty host and path; the empty host is judged like any other.  Repeated rows
    each get a row; an empty table has none; other columns are not looked at.
    """
    seen = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).withColumn("item", item)
    counts = stored(count_outcomes(seen, outcomes))
    known = stored(host_reputation(counts).select("host", "bound").join(counts.select("host", "pages"), "host"))
    hot = F.broadcast(known.where(F.col("pages") >= HOT_PAGES).select("host", "bound"))  # at most rows / HOT_PAGES
    cold = known.where(F.col("pages") < HOT_PAGES).select("host", "bound")
    ruled = seen.withColumn("fit", longest_rule(rules, F.col("host"), F.col("path")))
    judged = ruled.join(hot, "host").unionByName(ruled.join(hot, "host", "left_anti").join(cold, "host", "left"))
    by_host = F.when(F.col("bound") > LIMIT, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce(F.col("fit.verdict"), by_host).alias("verdict"), "bound")
