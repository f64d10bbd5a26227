"""URL filter by empirical-Bayes host reputation, beside fixed rules.

A rule names a host and the beginning of a path and decides the pages of that host and its subdomains; of several the
longest decides. Pages that a rule decides are the labelled outcomes, unless the caller names others. Outcomes are
counted per host, registered domain and suffix. Each level has a beta-binomial prior whose strength comes from the
spread of the shares on that level (moments) and whose mean is the posterior mean of the node above, so a host with few
outcomes is judged by its domain, a domain with few by its suffix. A host is blocked where the lower posterior bound of
its share of bad pages is above the tolerance; all its pages without a rule then are.

The suffix is the last label of a host, or the last two below a country code with a generic second level; the registered
domain has one label more. Numeric addresses have no suffix and are domains of their own. User, port and a closing dot
are not looked at for that.

Defined results: a url that is null or without ``://`` has an empty host and path, which no rule fits and which shares
one node; repeated rows and ids each get their result; without outcomes every share is one half and nothing is blocked.
An empty table gives no rows. Other columns are not looked at, and are carried along by ``allowed`` whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscore.llm.common import ascii_lower, free_names, join_groups
from txnscore.workspace import written

ALLOW, BLOCK = "allow", "block"

#: Verdict, host and beginning of the path. Fixed values.
RULES: tuple[tuple[str, str, str], ...] = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)

#: Second levels under country codes that are no registered domains. Fixed values.
GENERIC = ("ac", "co", "com", "edu", "gov", "net", "org")


@dataclass(frozen=True)
class Settings:
    """How far below the posterior mean the bound lies, in deviations, and the share of bad pages that is borne.

    The strength of a prior, in pages, stays between ``least`` and ``most``.
    """

    deviations: float = 1.645
    tolerance: float = 0.5
    least: int = 1
    most: int = 1000


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))), F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The deciding rule and its verdict, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, at, beginning in sorted(rules, key=lambda entry: len(entry[1] + entry[2])):
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(beginning)
        rule = F.when(fits, F.lit(at + beginning)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", ""), "[.]$", "")
    numeric = bare.rlike("^[0-9.]*$") | bare.startswith("[")
    last = rf"((?:(?:{'|'.join(GENERIC)})[.][a-z][a-z]|[^.]*))$"
    suffix = F.when(numeric, F.lit("")).otherwise(F.regexp_extract(bare, rf"(?:^|[.]){last}", 1))
    domain = F.when(numeric, bare).otherwise(F.regexp_extract(bare, rf"(?:[^.]*[.])?{last}", 0))
    return domain, suffix


def prior_strength(nodes: DataFrame, settings: Settings) -> int:
    """The strength, in whole pages, of the prior that the nodes (``n`` outcomes, ``bad`` of them) share."""
    row = (
        nodes.where("n > 0")
        .agg(
            F.count("*").alias("nodes"),
            F.sum("n").cast("double").alias("n"),
            F.sum("bad").cast("double").alias("bad"),
            F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"),
            F.sum(F.col("bad").cast("double") * F.col("bad") / F.col("n")).alias("between"),
        )
        .first()
    )
    if not row["nodes"] or not 0 < row["bad"] < row["n"]:
        return settings.most
    share = row["bad"] / row["n"]
    spread = (row["between"] - row["bad"] * share) / (share * (1 - share)) - (row["nodes"] - 1)
    room = row["n"] - row["squares"] / row["n"] - (row["nodes"] - 1)
    if spread <= 0 or room <= 0:
        return settings.most
    return int(min(max(room / spread - 1, settings.least), settings.most) + 0.5)


def _posterior(bad: Column, n: Column, prior: Column, strength: int) -> Column:
    return (bad + F.lit(strength) * prior) / (n + F.lit(strength))


def host_verdicts(hosts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``host``, ``pages`` and ``verdict`` from rows (``host``, ``pages``, ``n``, ``bad``), one per host."""
    domain, suffix = domain_and_suffix(F.col("host"))
    hosts = written(hosts.withColumns({"domain": domain, "suffix": suffix}), "hosts")
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = written(hosts.groupBy("domain", "suffix").agg(F.count("*").alias("hosts"), *sums), "domains")
    suffixes = written(domains.groupBy("suffix").agg(F.count("*").alias("domains"), *sums), "suffixes")
    strength = {name: prior_strength(nodes, settings) for name, nodes in
                (("host", hosts), ("domain", domains), ("suffix", suffixes))}
    total = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    root = F.lit((total[1] + 0.5) / (total[0] + 1))
    share = _posterior(F.col("bad"), F.col("n"), root, strength["suffix"])
    above = suffixes.select("suffix", "domains", share.alias("prior"))
    # A domain stands under one suffix, so the pair is as good a key as the domain.
    domains = join_groups(domains, above, "suffix", "domains")
    share = _posterior(F.col("bad"), F.col("n"), F.col("prior"), strength["domain"])
    above = written(domains.select("domain", "hosts", share.alias("prior")), "domain-priors")
    judged = join_groups(hosts.drop("suffix"), above, "domain", "hosts")
    a = F.col("bad") + F.lit(strength["host"]) * F.col("prior")
    b = F.col("n") - F.col("bad") + F.lit(strength["host"]) * (F.lit(1.0) - F.col("prior"))
    low = a / (a + b) - F.lit(settings.deviations) * F.sqrt(a * b / (a + b + 1)) / (a + b)
    return judged.select(
        "host", "pages", F.when(low > settings.tolerance, F.lit(BLOCK)).otherwise(F.lit(ALLOW)).alias("verdict")
    )


def judged(
    pages: DataFrame,
    url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    settings: Settings = Settings(),
    bad: Column | None = None,
) -> tuple[DataFrame, dict[str, str]]:
    """The rows with host, path, rule and verdict, and the names of these columns, none of which the input has.

    ``bad`` tells labelled pages: true for a bad one, false for a good one, null for one without a label.
    """
    names = free_names(pages.columns, "host", "path", "rule", "verdict", "decided", "pages", "bad")
    host, path = host_and_path(F.col(url_col))
    parsed = pages.withColumns({names["host"]: host, names["path"]: path})
    rule, decided = rule_of(F.col(names["host"]), F.col(names["path"]), rules)
    parsed = parsed.withColumns({names["rule"]: rule, names["decided"]: decided})
    outcome = F.col(names["decided"]) == BLOCK if bad is None else bad
    parsed = written(parsed.withColumn(names["bad"], outcome), "pages")
    hosts = parsed.groupBy(F.col(names["host"]).alias("host")).agg(
        F.count("*").alias("pages"), F.count(names["bad"]).alias("n"), F.count_if(F.col(names["bad"])).alias("bad")
    )
    verdicts = written(host_verdicts(hosts, settings), "host-verdicts").toDF(
        names["host"], names["pages"], names["verdict"]
    )
    joined = join_groups(parsed, verdicts, names["host"], names["pages"])
    verdict = F.coalesce(F.col(names["decided"]), F.col(names["verdict"]))
    return joined.withColumn(names["verdict"], verdict), names


def allowed(pages: DataFrame, url_col: str = "url", **kinds) -> DataFrame:
    """The rows that rules and reputation let pass, with the columns of the input."""
    rows, names = judged(pages, url_col, **kinds)
    return rows.where(F.col(names["verdict"]) == ALLOW).select(*pages.columns)


def op11_url_filter(spark: SparkSession, pages: DataFrame) -> DataFrame:
    rows, names = judged(pages.select("page_id", "url"))
    return rows.select("page_id", *[F.col(names[name]).alias(name) for name in ("host", "path", "rule", "verdict")])
