"""URL filter: host rules, and an empirical-Bayes reputation for hosts no rule fits.

Labelled page outcomes are summed by host, registered domain and suffix.  Each
level's rate is shrunk towards the level above by a beta-binomial prior whose
strength comes from the data, and a host is blocked when the lower bound of
its posterior rate of bad pages exceeds a threshold.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlode.llm.common import fits, spread_join
from textlode.sources.store import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Suffixes under which names are registered, where it is not the last label; a parameter, for the full list of public suffixes.
SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "me.uk", "net.uk", "com.au", "net.au", "org.au", "edu.au", "gov.au",
    "co.jp", "ne.jp", "or.jp", "ac.jp", "go.jp", "com.br", "org.br", "gov.br", "co.nz", "org.nz", "govt.nz", "co.za", "org.za",
    "co.in", "org.in", "gov.in", "com.cn", "org.cn", "gov.cn", "com.mx", "com.ar", "com.tr", "co.kr", "com.tw", "com.sg", "com.hk",
    "github.io", "gitlab.io", "pages.dev", "netlify.app", "vercel.app", "herokuapp.com", "web.app", "firebaseapp.com",
    "blogspot.com", "wordpress.com", "azurewebsites.net", "cloudfront.net", "s3.amazonaws.com",
)

# Bounds of a prior's strength, counted in pages.
WEAKEST, STRONGEST = 1.0, 10_000.0

RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


def _rest(url: Column) -> Column:
    """What follows the first `://`; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def name_of(host: Column) -> Column:
    """The host's name alone: without user, port and final dot."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    return F.regexp_replace(bare, r"\.$", "")


def _address(name: Column) -> Column:
    """Whether a name is an IP address, which has no parts."""
    return F.rlike(name, F.lit(r"^[0-9]+(\.[0-9]+){3}$|^\[|:"))


def _level(name: Column, suffixes: tuple[str, ...], more: int) -> Column:
    """The longest listed suffix of a name, or its last label, and `more` labels before."""
    found = F.substring_index(name, ".", -1 - more)
    for labels in sorted({s.count(".") + 1 for s in suffixes}):
        own = [s for s in suffixes if s.count(".") + 1 == labels]
        found = F.when(F.substring_index(name, ".", -labels).isin(own), F.substring_index(name, ".", -labels - more)).otherwise(found)
    return F.when(_address(name), name).otherwise(found)


def suffix_of(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    return _level(name_of(host), suffixes, 0)


def domain_of(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """The registered domain: the suffix and one label more; an address is its own."""
    return _level(name_of(host), suffixes, 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (host or a parent of it, start of the path), and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = text.partition("/")
        hit = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(hit, text).otherwise(rule), F.when(hit, says).otherwise(verdict)
    return rule, verdict


def _strength(children: DataFrame) -> float:
    """Prior strength of one level by the method of moments, from (n, bad) of its children.

    The spread of the children's rates beyond what chance gives is the prior's variance.
    """
    x = children.filter("n > 0").select("n", (F.col("bad") / F.col("n")).alias("rate"))
    s = x.agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.count("*").alias("k"),
        F.sum(F.col("n") * F.col("rate")).alias("m"),
        F.sum(F.col("n") * F.col("rate") * F.col("rate")).alias("mm"),
    ).first()
    if not s.n or s.k < 2:
        return STRONGEST
    mean = s.m / s.n
    chance = mean * (1 - mean)
    between = (s.mm / s.n - mean * mean - chance * (s.k - 1) / s.n) / max(1e-9, 1 - s.nn / s.n**2)
    return min(STRONGEST, max(WEAKEST, chance / between - 1)) if between > 1e-12 else STRONGEST


def host_reputation(pages: DataFrame, outcomes: DataFrame, z: float = 1.645, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """`(host, n, bad, mean, lower, upper)` for every host of `pages(page_id, host)`.

    `outcomes(page_id, bad)` holds 0 or 1 per labelled page; null ids and null
    outcomes say nothing, several outcomes of a page count each.  A host
    without labelled pages has its prior as posterior.  The posterior bound is
    mean ± z standard deviations of the beta posterior.
    """
    per_page = (
        outcomes.filter(F.col("page_id").isNotNull() & F.col("bad").isNotNull())
        .groupBy("page_id")
        .agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    )
    labelled = (
        pages.filter(F.col("page_id").isNotNull())
        .groupBy("page_id", "host")
        .agg(F.count("*").alias("copies"))
        .join(per_page, "page_id")
        .groupBy("host")
        .agg(F.sum(F.col("copies") * F.col("n")).alias("n"), F.sum(F.col("copies") * F.col("bad")).alias("bad"))
    )
    hosts = settle(
        pages.groupBy("host")
        .agg(F.count("*").alias("pages"))
        .join(labelled, "host", "left")
        .select(
            "host",
            domain_of(F.col("host"), suffixes).alias("domain"),
            suffix_of(F.col("host"), suffixes).alias("suffix"),
            F.coalesce("n", F.lit(0)).alias("n"),
            F.coalesce("bad", F.lit(0)).alias("bad"),
        )
    )
    counts = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = hosts.groupBy("suffix", "domain").agg(*counts)
    suffixes = domains.groupBy("suffix").agg(*counts)
    whole = suffixes.agg(*counts).first()
    base = ((whole.bad or 0) + 1.0) / ((whole.n or 0) + 2.0)
    by_suffix, by_domain, by_host = map(_strength, (suffixes, domains, hosts))

    def shrunk(prior: Column, strength: float) -> Column:
        return (F.col("bad") + prior * F.lit(strength)) / (F.col("n") + F.lit(strength))

    suffix_rate = suffixes.select("suffix", shrunk(F.lit(base), by_suffix).alias("suffix_rate"))
    domain_rate = domains.join(suffix_rate, "suffix").select(
        "domain", shrunk(F.col("suffix_rate"), by_domain).alias("domain_rate")
    )
    prior = F.col("domain_rate")
    a = F.col("bad") + prior * F.lit(by_host)
    b = F.col("n") - F.col("bad") + (F.lit(1.0) - prior) * F.lit(by_host)
    mean = a / (a + b)
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return hosts.join(domain_rate, "domain").select(
        "host",
        "n",
        "bad",
        mean.alias("mean"),
        F.greatest(F.lit(0.0), mean - F.lit(z) * deviation).alias("lower"),
        F.least(F.lit(1.0), mean + F.lit(z) * deviation).alias("upper"),
    )


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules=RULES,
    threshold: float = 0.5,
    z: float = 1.645,
    id_col: str = "page_id",
    url_col: str = "url",
    suffixes: tuple[str, ...] = SUFFIXES,
) -> DataFrame:
    """`(page_id, host, path, rule, verdict)`, one row per row of `pages`.

    Verdict: that of the longest fitting rule; else `block` when the lower
    bound of the host's posterior rate of bad pages exceeds `threshold`, else
    `allow`.  Null urls and urls without `://` have an empty host and path and
    share the reputation of the empty host.  `suffixes` are those under which names are registered; user, port and final dot
    belong to no level, and an address is its own domain and suffix.
    """
    parts = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        host_of(F.col(url_col)).alias("host"),
        path_of(F.col(url_col)).alias("path"),
    )
    reputation = host_reputation(parts, outcomes, z, suffixes)
    blocked = settle(reputation.filter(F.col("lower") > threshold).select("host", F.lit(True).alias("blocked")))
    small = fits(blocked, F.octet_length("host"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("blocked"), "block").otherwise("allow")
    return spread_join(parts, blocked, "host", "left", small).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(says, own).alias("verdict")
    )


def label_outcomes(labels: DataFrame) -> DataFrame:
    """`(page_id, bad)`: a labelled page is bad when it is toxic or of low quality."""
    bad = F.coalesce(F.col("toxic") == 1, F.lit(False)) | F.coalesce(F.col("quality") == 0, F.lit(False))
    return labels.select(F.col("doc_id").cast("long").alias("page_id"), bad.cast("int").alias("bad"))
