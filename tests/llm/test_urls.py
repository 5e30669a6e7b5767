import numpy as np
import pytest

from tests.llm.helpers import clashing
from veil.llm import hosttrust

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def table(spark, rows):
    return clashing(spark.createDataFrame(rows, "page_id bigint, url string, html string"))


def judged(spark, rows, rules=RULES):
    return {r.page_id: r for r in hosttrust.judge_pages(table(spark, rows), rules).collect()}


def test_hosts_paths_and_rules(spark):
    urls = [None, "", "no scheme", "https://WWW.Example.NET/en/1?x=/de/#f", "http://a.net", "http://a.net?q", "x://example.com/de/", "x://notexample.com/de/", "://b.org/fr/x#y", "http://É.Org/fr", "http://example.net#a/b", "ftp://u@h:8/p"]
    got = judged(spark, [(k, u, None) for k, u in enumerate(urls)])
    assert [(got[k].host, got[k].path, got[k].rule, got[k].verdict) for k in range(len(urls))] == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("www.example.net", "/en/1", "example.net/en/", "allow"),
        ("a.net", "", None, "allow"), ("a.net", "", None, "allow"),
        ("example.com", "/de/", "example.com/de/", "block"), ("notexample.com", "/de/", None, "allow"),
        ("b.org", "/fr/x", "org/fr/", "allow"), ("É.org", "/fr", None, "allow"),
        ("example.net", "", None, "allow"), ("u@h:8", "/p", None, "allow")]


def test_distrust_flows_back_and_trust_forward(spark):
    link = lambda *hosts: " ".join(f'<a HREF = "https://{h}/x">' for h in hosts) + '<a href="/own">'
    rows = [
        (1, "http://spam.net/a", link("spam.net")), (2, "http://farm.com/a", link("spam.net", "SPAM.net")), (3, "http://fan.com/", link("farm.com")),
        (4, "http://good.org/fr/a", link("friend.com", "torn.com")), (5, "http://friend.com/", None), (6, "http://torn.com/", link("friend.com")),
    ]
    got = judged(spark, rows)
    assert {k: r.verdict for k, r in got.items()} == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow"}
    assert got[2].distrust == pytest.approx(0.85) and got[3].distrust == pytest.approx(0.85**2)
    assert got[6].trust == pytest.approx(0.425) and got[5].trust == pytest.approx(0.425 + 0.85 * 0.425)


def test_propagation_is_the_power_iteration(spark):
    rng = np.random.default_rng(5)
    n = 12
    links = [(i, j) for i in range(n) for j in range(n) if i != j and rng.random() < 0.25]
    out, into = np.zeros(n), np.zeros(n)
    for i, j in links:
        out[i] += 1
        into[j] += 1
    trust, distrust = rng.random(n), rng.random(n)
    t, d = trust.copy(), distrust.copy()
    for _ in range(hosttrust.ROUNDS):
        t2, d2 = trust.copy(), distrust.copy()
        for i, j in links:
            t2[j] += 0.85 * t[i] / out[i]
            d2[i] += 0.85 * d[j] / into[j]
        t, d = t2, d2
    seeds = spark.createDataFrame([(f"h{k}", float(trust[k]), float(distrust[k])) for k in range(n)], "host string, trust double, distrust double")
    edges = spark.createDataFrame([(f"h{i}", f"h{j}", float(1 / out[i]), float(1 / into[j])) for i, j in links], "src string, dst string, forward double, backward double")
    got = {r.host: (r.trust, r.distrust) for r in hosttrust.propagate(seeds, edges).collect()}
    for k in range(n):
        assert got[f"h{k}"] == pytest.approx((t[k], d[k]))


def test_empty_table_and_repeats(spark):
    assert hosttrust.judge_pages(table(spark, []), RULES).count() == 0
    rows = [(1, "http://a.net/", "<p>"), (1, "http://a.net/", "<p>"), (None, "http://a.net/", "<p>")]
    assert [r.verdict for r in hosttrust.judge_pages(table(spark, rows), RULES).collect()] == ["block"] * 3


def test_sql_of_the_oracle_agrees_on_links(spark):
    import duckdb

    rows = [(k, f"http://h{k % 9}.{'net' if k % 9 < 2 else 'com'}/{'de' if k % 4 else 'x'}/", f'<a href="http://h{k * 7 % 9}.{"net" if k * 7 % 9 < 2 else "com"}/">') for k in range(80)] + [(99, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").toPandas()
    con = duckdb.connect()
    con.register("pages", pages)
    want = {r[0]: r[1:] for r in con.sql(hosttrust.oracle_sql(RULES)).fetchall()}
    got = {k: (r.host, r.path, r.rule, r.verdict) for k, r in judged(spark, rows).items()}
    assert got == want and {v[3] for v in got.values()} == {"allow", "block"}
