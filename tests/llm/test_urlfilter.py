import random

from pyspark.sql import functions as F

from wardloom.llm import urlfilter
from wardloom.llm.queries import URL_RULES


def test_cascade_is_exact_over_its_universe(spark):
    rng = random.Random(5)
    universe = [f"host{i}.example" for i in range(20_000)]
    for count in (0, 1, 700, 15_000):
        listed = set(rng.sample(universe, count))
        keys = spark.createDataFrame([(k,) for k in [*universe, None, universe[0]]], "key string")
        given = spark.createDataFrame([(k,) for k in [*listed, None, *list(listed)[:3]]], "key string")
        cascade = urlfilter.build_cascade(given, keys)
        found = {r.key for r in keys.where(cascade.holds(F.col("key"))).collect()}
        assert found == listed
        if count == 700:
            assert 2 <= len(cascade.levels) and sum(level.bits for level in cascade.levels) < 16 * count


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")


def test_rules_hosts_and_paths(spark):
    urls = [
        None, "", "no scheme", "http://Example.ORG/es/1", "https://a.example.org/en/12?x#y", "x://example.org", "http://b.com/fr/?q", "http://b.com/de/",
        "http://notexample.org/es/", "ftp://com/de/x", "http://bad.net/p", "http://BAD.net#f", "a://b://c/d", "http://ÀÉ.com/de/", "http://x.org?/es/", "http:///de/",
        "http://good.net/" + "y" * 100_000,
    ]
    listed = spark.createDataFrame([("bad.net",), (None,)], "key string")
    table = pages(spark, urls + urls[:3])
    for bits in (1 << 29, 0):  # without room for the filter the list is joined
        found = sorted(urlfilter.filter_urls(table, URL_RULES, listed, most_bits=bits).collect(), key=lambda r: r.row.page_id)
        assert len(found) == len(urls) + 3
        short = [(r.host, r.path[:20], r.rule, r.verdict) for r in found[: len(urls)]]
        assert short == [
            ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("example.org", "/es/1", "example.org/es/", "block"),
            ("a.example.org", "/en/12", "example.org/en/1", "block"), ("example.org", "", None, "allow"), ("b.com", "/fr/", "com/fr/", "allow"),
            ("b.com", "/de/", "com/de/", "block"), ("notexample.org", "/es/", "org/", "allow"), ("com", "/de/x", "com/de/", "block"),
            ("bad.net", "/p", None, "block"), ("bad.net", "", None, "block"), ("b:", "//c/d", None, "allow"), ("ÀÉ.com", "/de/", "com/de/", "block"),
            ("x.org", "", None, "allow"), ("", "/de/", None, "allow"), ("good.net", "/" + "y" * 19, None, "allow"),
        ]


def test_empty_table(spark):
    listed = spark.createDataFrame([], "key string")
    assert urlfilter.filter_urls(pages(spark, []), URL_RULES, listed).collect() == []
