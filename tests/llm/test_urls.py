"""Templates judged by their labelled pages only."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from flowlens.llm import common, urls


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def verdicts(spark, addresses, rules, **options):
    pages = spark.createDataFrame(list(enumerate(addresses)), "page_id long, url string")
    rows = urls.judge(pages, rules, **options).collect()
    return {row.page_id: row for row in rows}


def test_a_template_of_labelled_bad_pages_is_rejected_at_the_default(spark):
    spam = [f"http://h.net/spam/{i}/x" for i in range(400)]
    news = [f"http://h.net/news/{i}" for i in range(40)]
    listed = [urls.UrlRule("block", "h.net", f"/spam/{i}/") for i in range(390)]
    found = verdicts(spark, spam + news, listed)
    assert all(found[i].verdict == "block" and found[i].rule is None for i in range(390, 400))
    assert all(found[400 + i].verdict == "allow" and found[400 + i].support == 0 for i in range(40))


def test_good_labels_and_thin_support_keep_a_template(spark):
    mixed = [f"http://h.net/shop/{i}" for i in range(100)]
    thin = [f"http://h.net/rare/{i}" for i in range(12)]
    listed = [urls.UrlRule("block" if i % 2 else "allow", "h.net", f"/shop/{i}") for i in range(80, 100)]
    listed += [urls.UrlRule("block", "h.net", f"/rare/{i}") for i in range(9, 12)]
    found = verdicts(spark, mixed + thin, listed)
    assert all(found[i].verdict == "allow" for i in range(80))
    assert all(found[100 + i].verdict == "allow" for i in range(9))


def test_deep_segments_tell_good_from_bad(spark):
    """The fifth segment decides; the four above are the same."""
    base = "http://h.org/a/b/c/d"
    addresses = [f"{base}/{kind}/{i}" for kind in ("ads", "docs") for i in range(60)]
    listed = [urls.UrlRule("block", "h.org", f"/a/b/c/d/ads/{i}") for i in range(10, 60)]
    listed += [urls.UrlRule("allow", "h.org", f"/a/b/c/d/docs/{i}") for i in range(10, 60)]
    found = verdicts(spark, addresses, listed)
    for i in range(10):
        # Prefix rules of numbers fit longer numbers too, so only ids without a rule are asked.
        if found[i].rule is None:
            assert found[i].verdict == "block" and found[60 + i].verdict == "allow"
    assert sum(found[i].rule is None for i in range(10)) >= 9


def test_hashes_and_numbers_are_one_template(spark):
    draw = random.Random(2)
    names = [f"{draw.getrandbits(64):016x}" for _ in range(60)]
    found = verdicts(
        spark, [f"http://h.io/p/{name}" for name in names], [urls.UrlRule("block", "h.io", f"/p/{n}") for n in names[:50]]
    )
    assert len({row.template for row in found.values()}) == 1
    assert all(row.verdict == "block" for row in found.values())


def test_repeated_rows_long_paths_and_no_rules(spark):
    long = "http://h.net/" + "/".join(["seg"] * 3000)
    addresses = [long, long, None, "", "http://h.net", "x://H.NET/a//b?c"]
    found = verdicts(spark, addresses, [])
    assert [found[i].verdict for i in range(6)] == ["allow"] * 6 and found[5].host == "h.net"
    listed = [urls.UrlRule("block", "h.net", "/seg/")]
    found = verdicts(spark, addresses, listed)
    assert [found[i].verdict for i in range(6)] == ["block", "block", "allow", "allow", "allow", "allow"]
    pages = spark.createDataFrame([(1, long)], "page_id long, url string").withColumn("support", F.lit("clash"))
    assert urls.judge(pages.limit(0), listed).count() == 0 and urls.judge(pages, listed).count() == 1
