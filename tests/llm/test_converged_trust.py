"""Trust and distrust against masses that were iterated in fractions until they stand."""

from fractions import Fraction

import pytest

from tidemark.llm import url_filters
from tidemark.llm.url_filters import DAMPING, UNIT

CHAIN = [("s", "a"), ("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", "f"), ("f", "g")]
CYCLE = [("s", "t"), ("t", "s")]


def converged(seeds, edges):
    """host: mass as a share of UNIT, after so many steps that the rest is nothing."""
    ways = {a: sum(x == a for x, _ in edges) for a, _ in edges}
    kept = Fraction(100 - DAMPING, 100)
    mass = {h: float(kept) for h in seeds}
    for _ in range(400):
        new = {h: float(kept) for h in seeds}
        for a, b in edges:
            if a in mass:
                new[b] = new.get(b, 0) + mass[a] * DAMPING / 100 / ways[a]
        mass = new
    return mass


@pytest.mark.parametrize("edges", [CHAIN, CYCLE], ids=["chain", "cycle"])
def test_spread_as_converged(spark, edges):
    links = spark.createDataFrame([(a, b, sum(x == a for x, _ in edges)) for a, b in edges], "source string, target string, ways long")
    seeds = spark.createDataFrame([("s",)], "host string")
    found = {r.host: float(r.mass) / UNIT for r in url_filters._spread(seeds, links).collect()}
    assert found == pytest.approx(converged(["s"], edges), abs=1e-5)


def test_long_chain_and_links_without_scheme(spark):
    good, bad = "g.example.net", "b.net"
    chain = [f"h{i}.example" for i in range(7)]
    link = lambda host: f'<a href="//{host}/x">'
    # Distrust runs backwards from bad along the chain; h0 is six links away.
    rows = [(f"https://{good}/en/1", ""), (f"https://{bad}/1", "")]
    rows += [(f"https://{a}/1", link(b)) for a, b in zip(chain, chain[1:] + [bad])]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    found = {r.host: r for r in url_filters.judge_urls(pages).collect()}
    expected = converged([bad], [(b, a) for a, b in zip(chain, chain[1:] + [bad])])
    for host in chain:
        assert found[host].verdict == "block"
        assert found[host].distrust == pytest.approx(expected[host], abs=1e-5)
    assert found[good].verdict == "allow" and found[good].trust == (100 - DAMPING) / 100


def test_masses_beyond_long_do_not_wrap(spark):
    rows = spark.range(1).selectExpr("20000000000000000000BD AS mass", "1L AS ways", "3L AS three")
    found = rows.select(url_filters._share(rows.mass, rows.ways).alias("all"), url_filters._share(rows.mass, rows.three).alias("third")).first()
    assert found.all == 2 * 10**19 * DAMPING // 100 and found.third == 2 * 10**19 * DAMPING // 300


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "no host", "<a href='http://a.b/'>"), (3, "http:///x", None), (None, "http://A.org/fr/1", None), (4, "http://c.d", "")]
    pages = spark.createDataFrame(rows + rows[-1:], "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS mass", "3 AS rule")
    found = sorted(((r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in url_filters.judge_urls(pages).collect()))
    assert found == [
        (0, "a.org", "/fr/1", "org/fr/", "allow"), (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "/x", None, "allow"),
        (4, "c.d", "", None, "allow"), (4, "c.d", "", None, "allow"),
    ]
