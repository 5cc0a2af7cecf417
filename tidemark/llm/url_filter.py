"""URL filter by rules and empirical-Bayes host reputation, in DataFrame functions only.

Labelled page outcomes (bad or not) are counted per host, without user name and port. Rates are shrunk down a chain of beta-binomial priors: suffix
(last label) towards the whole corpus, registered domain towards its suffix, host towards its domain. The strength of each
level's prior is fitted by moments from the spread of that level's rates. A page is blocked if the lower bound of its host's
posterior bad rate is above a limit; hosts without a label use their domain's, suffix's or the corpus's posterior.

Nulls and ties: a null url, or one without "://", has an empty host and path, fits no rule and is judged by the corpus
rate; labels with a null outcome or id are ignored; repeated label rows count each; repeated pages stay. Empty label tables
allow every page that no rule blocks. Other columns pass through; those named like the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise, packed, unpacked

#: Fixed values: (verdict, host, path).
RULES = (
    ("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"), ("block", "org", "/es/"),
)
#: Domains are registered under the last label, or under two: one of these before a country's two letters.
SECOND_LEVEL = "ac|co|com|edu|gob|gouv|gov|ltd|mil|ne|net|nom|or|org|sch"
TWO_LABELS = rf"(?:^|\.)(?:{SECOND_LEVEL})\.[a-z]{{2}}$"
Z, MAX_BAD = 1.645, 0.25
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def bare_host(host: Column) -> Column:
    """The host that a reputation belongs to: without user name and port."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")


def suffix_of(host: Column) -> Column:
    return F.when(F.rlike(host, F.lit(TWO_LABELS)), F.substring_index(host, ".", -2)).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    return F.when(F.rlike(host, F.lit(TWO_LABELS)), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. rules is a short list held by the driver."""
    rule = verdict = F.lit(None).cast("string")
    for action, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # a longer one is put in front
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, action).otherwise(verdict)
    return rule, verdict


def _strength(groups: DataFrame, p: float) -> float:
    """A prior's strength, fitted by moments from the spread of the groups' rates around p."""
    n, bad = F.col("n"), F.col("bad")
    sums = groups.agg(F.sum(bad * bad / n), F.sum(bad), F.sum(n), F.sum(n * n), F.count(F.lit(1))).first()
    if not sums[4]:
        return 1000.0
    bb, b, t, nn, k = sums
    within = p * (1 - p)
    spread = within * (t - nn / t - (k - 1))
    rho = (bb - 2 * p * b + p * p * t - within * (k - 1)) / spread if spread else 0.0
    return 1 / min(max(rho, 1 / 1001), 0.5) - 1


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """outcomes: host, bad (0/1). Posterior beta parameters per level: level, key, alpha, beta.

    Level 0 is the corpus, 1 suffixes, 2 domains, 3 hosts. One row per key: few beside the pages, joined by key. The driver
    sees one row of sums for each level.
    """
    n, bad = F.sum("n").alias("n"), F.sum("bad").alias("bad")
    counts = outcomes.where(F.col("bad").isNotNull()).groupBy(bare_host(F.col("host")).alias("host"))
    counts = counts.agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("bad").cast("double").alias("bad"))
    hosts = materialise(counts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))), "hosts")
    domains = materialise(hosts.groupBy("domain", "suffix").agg(n, bad), "domains")
    suffixes = materialise(domains.groupBy("suffix").agg(n, bad), "suffixes")
    total = suffixes.agg(F.coalesce(n, F.lit(0.0)), F.coalesce(bad, F.lit(0.0))).first()
    p0 = (total[1] + 1) / (total[0] + 2)
    m1, m2, m3 = (_strength(groups, p0) for groups in (suffixes, domains, hosts))

    def posterior(groups: DataFrame, key: str, strength: float, rate: Column) -> DataFrame:
        alpha, beta = F.lit(strength) * rate + F.col("bad"), F.lit(strength) * (1 - rate) + F.col("n") - F.col("bad")
        return groups.select(F.col(key).alias("key"), alpha.alias("alpha"), beta.alias("beta"))

    def below(upper: DataFrame, name: str) -> DataFrame:
        return upper.select(F.col("key").alias(name), (F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias("rate"))

    s = posterior(suffixes, "suffix", m1, F.lit(p0))
    d = posterior(domains.join(below(s, "suffix"), "suffix"), "domain", m2, F.col("rate"))
    h = posterior(hosts.join(below(d, "domain"), "domain"), "host", m3, F.col("rate"))
    beliefs = {"alpha": float(total[1] + 1), "beta": float(total[0] - total[1] + 1)}
    corpus = suffixes.sparkSession.range(1).select(F.lit("").alias("key"), *[F.lit(x).alias(n) for n, x in beliefs.items()])
    levels = [x.select(F.lit(level).alias("level"), "key", "alpha", "beta") for level, x in enumerate((corpus, s, d, h))]
    out = materialise(levels[0].union(levels[1]).union(levels[2]).union(levels[3]), "reputation")
    discard(hosts, domains, suffixes)
    return out


def judge_urls(pages: DataFrame, outcomes: DataFrame, url_col: str = "url", rules=RULES, z: float = Z, max_bad: float = MAX_BAD) -> DataFrame:
    """pages with host, path, rule, verdict and bad_bound, the lower bound of the host's posterior bad rate.

    outcomes: host, bad. Levels are joined from host to suffix; a hot host is one row on the small side, and the join is
    plain, so Spark may split its pages over tasks.
    """
    rep = host_reputation(outcomes)
    corpus = rep.where("level = 0").first()
    out = packed(pages, host=host_of(F.col(url_col)), path=path_of(F.col(url_col)))
    bare = bare_host(F.col("host"))
    for level, key in ((1, suffix_of(bare)), (2, domain_of(bare)), (3, bare)):
        side = rep.where(F.col("level") == level).select(F.col("key").alias("known"), F.struct("alpha", "beta").alias(f"p{level}"))
        out = out.withColumn("key", key).join(side, F.col("key") == F.col("known"), "left").drop("key", "known")
    p0 = F.struct(F.lit(corpus["alpha"]).alias("alpha"), F.lit(corpus["beta"]).alias("beta"))
    out = out.withColumn("p", F.coalesce("p3", "p2", "p1", p0))
    a, b = F.col("p.alpha"), F.col("p.beta")
    bound = a / (a + b) - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    rule, of_rule = rule_columns(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(of_rule, F.when(bound > max_bad, "block").otherwise("allow"))
    return unpacked(out, pages.columns, host=F.col("host"), path=F.col("path"), rule=rule, verdict=verdict, bad_bound=bound)
