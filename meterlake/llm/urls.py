"""URL filter: rules first, then an empirical-Bayes reputation of the host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Suffixes of two labels under which names are registered.
SECOND_LEVEL = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "com.cn", "gov.uk", "net.au", "org.au", "org.uk")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule whose host equals or ends the host at a dot, and whose path starts the path; else null.

    Rules are ``host/path`` strings, a short list given by the caller.
    """
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, rule).otherwise(out)
    return out


def suffix_and_domain(host: Column) -> tuple[Column, Column]:
    """Suffix and registered domain, as far as the host has labels."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    k = F.when(F.array_join(F.slice(labels, F.greatest(n - 1, F.lit(1)), F.lit(2)), ".").isin(*SECOND_LEVEL), 2).otherwise(1)
    last = lambda m: F.array_join(F.slice(labels, F.greatest(n - m + 1, F.lit(1)), m), ".")
    return last(k), last(k + 1)


def by_longest_suffix(hosts: DataFrame, suffixes: DataFrame) -> DataFrame:
    """hosts with ``suffix``, the longest row of ``suffixes`` (column suffix) that the host ends with at a dot, and ``domain``, one label more.

    Without such a row the last label is the suffix; a host that is a suffix
    itself is its own domain. Rows stand as they are: no wildcards.
    """
    labels, n = F.split("host", r"\."), F.size(F.split("host", r"\."))
    tail = lambda m: F.array_join(F.slice(labels, F.greatest(n - m + 1, F.lit(1)), m), ".")
    listed = suffixes.select(F.lower("suffix").alias("_tail")).where("_tail <> ''").distinct()
    tails = hosts.select("host", F.explode(F.sequence(F.lit(1), n)).alias("_m"), labels.alias("_labels"))
    tails = tails.withColumn("_tail", F.array_join(F.slice("_labels", F.size("_labels") - F.col("_m") + 1, F.col("_m")), "."))
    # A host's row is unique, so are its tails.
    best = tails.join(listed, "_tail").groupBy("host").agg(F.max("_m").alias("_m"))
    k = F.coalesce("_m", F.lit(1))
    return hosts.join(best, "host", "left").withColumns({"suffix": tail(k), "domain": tail(k + 1)}).drop("_m")


def strength(groups: DataFrame) -> float:
    """Prior strength of one level (n outcomes, k bad, a row per group): beta-binomial by the method of moments.

    The overdispersion is that of the groups' shares around the level's mean;
    the strength is between 1 (groups differ fully) and 1000 (no difference).
    """
    g, n, k, n2, kn = groups.where("n > 0").agg(
        F.count("*"), F.sum("n"), F.sum("k"), F.sum(F.col("n").cast("double") ** 2), F.sum(F.col("k").cast("double") ** 2 / F.col("n"))
    ).first()
    if not g or g < 2 or k in (0, n):
        return 1000.0
    mean = k / n
    spread = (kn - k * mean) / (mean * (1 - mean))
    rest = n - n2 / n - (g - 1)
    rho = (spread - (g - 1)) / rest if rest > 0 else 0.0
    return min(max(1 / rho - 1, 1.0), 1000.0) if rho > 0 else 1000.0


def reputation(hosts: DataFrame, z: float = 1.645, suffixes: DataFrame | None = None) -> DataFrame:
    """hosts (host, n outcomes, k bad ones) with ``mean`` and ``low``, the posterior's mean and lower bound for a bad page.

    A host's Beta prior has the posterior mean of its registered domain, that
    one's the mean of its suffix, that one's the mean of all outcomes; a host
    without outcomes thus stands as its domain does. ``suffixes`` is a table of
    those that names are registered under (column suffix); without it they are
    single labels and the few in SECOND_LEVEL.
    """
    if suffixes is None:
        suffix, domain = suffix_and_domain(F.col("host"))
        hosts = hosts.select("host", "n", "k", domain.alias("domain"), suffix.alias("suffix"))
    else:
        hosts = by_longest_suffix(hosts.select("host", "n", "k"), suffixes)
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    n, k = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("k"), F.lit(0))).first()
    m_suffix, m_domain, m_host = strength(suffixes), strength(domains), strength(hosts)
    shrunk = lambda prior, m: (F.col("k") + F.lit(m) * prior) / (F.col("n") + F.lit(m))
    suffixes = suffixes.select("suffix", shrunk(F.lit((k + 1) / (n + 2)), m_suffix).alias("of_suffix"))
    domains = domains.join(suffixes, "suffix").select("domain", shrunk(F.col("of_suffix"), m_domain).alias("of_domain"))
    a, b = F.col("k") + F.lit(m_host) * F.col("of_domain"), F.col("n") - F.col("k") + F.lit(m_host) * (1 - F.col("of_domain"))
    mean = a / (a + b)
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return hosts.join(domains, "domain").select("host", "n", "k", mean.alias("mean"), (mean - z * sd).alias("low"))


def judge(
    pages: DataFrame,
    rules: dict[str, str],
    outcomes: DataFrame | None = None,
    limit: float = 0.5,
    z: float = 1.645,
    id_col: str = "page_id",
    url_col: str = "url",
    suffixes: DataFrame | None = None,
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict.

    A fitting rule decides. Other pages are blocked when the lower posterior
    bound of their host's share of bad pages reaches ``limit``. Outcomes are
    rows (id, bad 0/1) for some pages, ids unique; without them the pages
    that a rule decides are the labelled ones (block is bad). ``suffixes``: see
    ``reputation``.

    Null urls and urls without ``://`` have an empty host and path, fit no
    rule and are allowed. Repeated rows each get their row and count each as
    an outcome. With no outcome at all nothing is blocked but by rule.
    """
    url = F.col(url_col)
    judged = pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    judged = judged.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    verdict = F.lit(None).cast("string")
    for rule, says in rules.items():
        verdict = F.when(F.col("rule") == rule, says).otherwise(verdict)
    judged = judged.withColumn("verdict", verdict)
    if outcomes is None:
        bad = F.when(F.col("verdict") == "block", 1).when(F.col("verdict") == "allow", 0)
        labelled = judged.select("host", bad.alias("bad"))
    else:
        labelled = judged.join(outcomes.select(F.col(id_col), F.col("bad").cast("int").alias("bad")), id_col, "left").select("host", "bad")
    hosts = labelled.where("host <> ''").groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
    blocked = reputation(hosts, z, suffixes).where(F.col("low") >= limit).select(F.col("host").alias("_host"), F.lit("block").alias("_says"))
    # A host's row is unique; AQE splits the rows of a hot host.
    out = judged.join(blocked, judged["host"] == blocked["_host"], "left")
    return out.select(id_col, "host", "path", "rule", F.coalesce("verdict", "_says", F.lit("allow")).alias("verdict"))
