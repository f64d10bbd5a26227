"""URL filter: parts of urls, rules, levels of reputation, hot hosts, odd tables."""

import math

import pytest
from pyspark.sql import functions as F

from txnscore.llm import common, reputation

URLS = [
    ("http://Example.ORG/en/2", "example.org", "/en/2", "org/", "allow"),
    ("http://a.example.org/en/17?x#y", "a.example.org", "/en/17", "example.org/en/1", "block"),
    ("https://example.org/es/", "example.org", "/es/", "example.org/es/", "block"),
    ("https://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("https://example.org", "example.org", "", None, None),
    ("https://example.org?q=/es/", "example.org", "", None, None),
    ("https://org/", "org", "/", "org/", "allow"),
    ("x://shop.com/de/1://z", "shop.com", "/de/1://z", "com/de/", "block"),
    ("ftp://shop.com/FR/", "shop.com", "/FR/", None, None),
    ("://ÄB.com#frag", "Äb.com", "", None, None),
    ("no url", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
]


def test_parts_and_rules(spark):
    rows = spark.createDataFrame([(k, row[0]) for k, row in enumerate(URLS)], "page_id long, url string")
    found = {row["page_id"]: row for row in reputation.op11_url_filter(spark, rows).collect()}
    for k, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (found[k]["host"], found[k]["path"], found[k]["rule"]) == (host, path, rule)
        assert found[k]["verdict"] == (verdict or found[k]["verdict"])
        assert found[k]["verdict"] in ("allow", "block")


@pytest.mark.parametrize(
    ("host", "domain", "suffix"),
    [
        ("a.b.co.uk", "b.co.uk", "co.uk"),
        ("x.org", "x.org", "org"),
        ("org", "org", "org"),
        ("10.2.3.4:80", "10.2.3.4", ""),
        ("user@h.x.com:80", "x.com", "com"),
        ("a.b.de.", "b.de", "de"),
        ("", "", ""),
        ("[::1]:80", "[::1]", ""),
    ],
)
def test_domains(spark, host, domain, suffix):
    row = spark.range(1).select(*reputation.domain_and_suffix(F.lit(host))).first()
    assert tuple(row) == (domain, suffix)


def _strength(nodes, settings):
    nodes = [(n, bad) for n, bad in nodes if n]
    n, bad = sum(n for n, _ in nodes), sum(bad for _, bad in nodes)
    if not 0 < bad < n:
        return settings.most
    share = bad / n
    spread = sum(m * (b / m - share) ** 2 for m, b in nodes) / (share * (1 - share)) - (len(nodes) - 1)
    room = n - sum(m * m for m, _ in nodes) / n - (len(nodes) - 1)
    if spread <= 0 or room <= 0:
        return settings.most
    return math.floor(min(max(room / spread - 1, settings.least), settings.most) + 0.5)


def test_reputation_equals_plain_computation(spark):
    """Hosts of two domains; their labels are given, and a host without labels follows its domain."""
    counts = {"a.bad.net": (40, 38), "b.bad.net": (30, 29), "new.bad.net": (0, 0), "a.good.net": (50, 2), "x.good.net": (0, 0)}
    rows = [(host, int(k < bad) if k < n else None) for host, (n, bad) in counts.items() for k in range(n + 3)]
    pages = spark.createDataFrame([(k, f"http://{host}/p", bad) for k, (host, bad) in enumerate(rows)], "page_id long, url string, label int")
    judged, names = reputation.judged(pages, bad=F.col("label") == 1)
    found = {row[names["host"]]: row[names["verdict"]] for row in judged.collect()}
    settings = reputation.Settings()
    domains = {d: tuple(sum(v[i] for h, v in counts.items() if h.endswith(d)) for i in (0, 1)) for d in ("bad.net", "good.net")}
    total = tuple(map(sum, zip(*domains.values(), strict=True)))
    by_host, by_domain, by_suffix = (_strength(nodes, settings) for nodes in (counts.values(), domains.values(), [total]))
    root = (total[1] + 0.5) / (total[0] + 1)
    suffix = (total[1] + by_suffix * root) / (total[0] + by_suffix)
    for host, (n, bad) in counts.items():
        dn, dbad = domains[host.split(".", 1)[1]]
        prior = (dbad + by_domain * suffix) / (dn + by_domain)
        a, b = bad + by_host * prior, n - bad + by_host * (1 - prior)
        low = a / (a + b) - settings.deviations * math.sqrt(a * b / (a + b + 1)) / (a + b)
        assert found[host] == ("block" if low > settings.tolerance else "allow")
    assert found["new.bad.net"] == found["a.bad.net"] == "block" and found["x.good.net"] == "allow"


def test_allowed_keeps_columns_with_clashing_names(spark):
    rows = [(1, "http://a.com/de/", "h", "p", "r", "v", True, 1, 2), (1, "http://a.com/fr/", "h", "p", "r", "v", True, 1, 2)]
    pages = spark.createDataFrame(
        rows * 2, "page_id long, url string, host string, PATH string, rule string, verdict string, is_hot boolean, pages int, n int"
    )
    kept = reputation.allowed(pages)
    assert kept.columns == pages.columns
    assert [tuple(row) for row in kept.collect()] == [rows[1]] * 2


def test_empty_table_and_no_outcomes(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert reputation.op11_url_filter(spark, none).collect() == []
    unlabelled = spark.createDataFrame([(None, None), (None, None), (2, "http://x.net/a")], none.schema)
    assert [row["verdict"] for row in reputation.op11_url_filter(spark, unlabelled).collect()] == ["allow"] * 3


def test_groups_are_joined_hot_or_not(spark):
    """One key has half of the rows; null is a key; keys rarer than the hot share go through the shuffle."""
    keys = ["hot"] * 3000 + [None] * 10 + [f"k{k}" for k in range(3000)]
    rows = spark.createDataFrame([(k, name) for k, name in enumerate(keys)], "id long, name string")
    groups = rows.groupBy("name").agg(F.count("*").alias("size")).withColumn("value", F.concat(F.lit("of "), F.coalesce("name", F.lit("null"))))
    joined = common.join_groups(rows, groups, "name", "size")
    assert joined.columns == ["id", "name", "value"]
    found = {row["id"]: row["value"] for row in joined.collect()}
    assert found == {k: f"of {name or 'null'}" for k, name in enumerate(keys)}
