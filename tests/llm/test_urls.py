import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lectern.llm import urls
from lectern.llm.queries import URL_RULES


def apriori(transactions, min_rows, min_confidence):
    """Rules to the label by counting every combination."""
    whole, bad = Counter(), Counter()
    for items, is_bad in transactions:
        for n in range(1, len(items) + 1):
            for part in itertools.combinations(sorted(items), n):
                whole[part] += 1
                bad[part] += is_bad
    rules = {p: bad[p] / whole[p] for p in whole if bad[p] >= min_rows and bad[p] / whole[p] >= min_confidence}
    return {p: c for p, c in rules.items() if not any(q != p and set(q) < set(p) and d >= c for q, d in rules.items())}


@pytest.fixture(scope="module")
def labelled(spark):
    rows = []
    for i in range(400):
        host = ["casino", "news", "blog", "shop"][i % 4]
        path = ["en", "fr"][i // 4 % 2]
        bad = (host == "casino" and i % 20 != 0) or (host == "shop" and path == "fr")
        rows.append((i, f"http://{host}.example.org/{path}/{i}", bad if i % 50 else None))
    return spark.createDataFrame(rows, "page_id long, url string, bad boolean")


def test_rules_against_counting(labelled):
    got = {tuple(r.antecedent): r.confidence for r in urls.mine(labelled, min_rows=20, min_confidence=0.7).collect()}
    rows = labelled.filter("bad is not null").select(urls.tokens(F.col("url")).alias("t"), "bad").collect()
    want = apriori([(r.t, r.bad) for r in rows], 20, 0.7)
    assert got == pytest.approx(want) and ("host:casino",) in got and ("host:shop", "path:fr") in got


def test_matches_against_all_rules(labelled):
    rules = urls.mine(labelled, min_rows=20, min_confidence=0.7)
    listed = [(set(r.antecedent), r.confidence) for r in rules.collect()]
    judged = {r.page_id: r for r in urls.judge(labelled, [], rules).collect()}
    for r in labelled.select("page_id", urls.tokens(F.col("url")).alias("t")).collect():
        sure = [c for a, c in listed if a <= set(r.t)]
        assert judged[r.page_id].verdict == ("block" if sure else "allow")
        assert judged[r.page_id].confidence == (max(sure) if sure else None)


def test_given_rules(spark, labelled):
    cases = {
        "http://A.Example.COM/en/1": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "http://www.example.com/en/?q": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://x.www.example.com/en/": ("x.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://badexample.com/en/1": ("badexample.com", "/en/1", "com/", "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "x://h.net/es/#f": ("h.net", "/es/", "net/es/", "block"),
        "http://h.net/es": ("h.net", "/es", None, "allow"),
        "http://h.org?x=/fr/": ("h.org", "", None, "allow"),
        "a://b://c.com/": ("b:", "//c.com/", None, "allow"),
        "h.net/fr/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    rows = [(i, u, "x", "y") for i, u in enumerate(cases)] * 2
    given = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    no_rules = urls.mine(labelled.limit(0))
    got = urls.judge(given, URL_RULES, no_rules).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == list(cases.values())[r.page_id]
    assert urls.judge(given.limit(0), URL_RULES, no_rules).count() == 0
