import random

import pytest

from checks.compare import compare, connect
from cellframe.llm import urls

GIVEN = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
    ("a.b", "", "block"), ("b", "/x/y", "allow"), ("a.b", "/x", "allow"), ("A.b", "/x/yz/q", "block"), ("b", "/x/y/z/", "block"),
    ("c", "/x", "allow"), ("c", "/x", "block"), ("", "", "block"), (None, "/", "block"), ("d", None, "block"), ("d", "/", "maybe"),
    ("e", "x/", "block"), ("e/f", "/", "block"), ("e", "/a?b", "block"), ("a.b", "/x/y z", "block"),
]


def plain(url, given):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    best = None
    for h, p, v in given if url is not None else []:
        if h is None or p is None or v not in ("allow", "block"):
            continue
        h = h.lower()
        if (host == h or host.endswith(f".{h}")) and path.startswith(p):
            best = max(best or (-1,), (len(h) + len(p), len(h), v, h + p))
    return host, path, best and best[3], best[2] if best else "allow"


def made_urls():
    rng = random.Random(7)
    hosts = "net org b a.b A.B x.a.b ab.b c x.c c.x d e e. . .net example.net www.Example.NET exampleXnet example.com".split()
    paths = ["", "/", "/x", "/x/", "/x/y", "/x/y/", "/x/yz/q1", "/x/y/z/", "/en", "/en/", "/de/1.html", "/fr/é", "//", "/x//y", "/x/y z", "/X"]
    ends = ["", "?q=/en/", "#/de/", "?", "/?x://y"]
    out = [f"{rng.choice(['http', 'https', '', 'x'])}://{h}{p}{rng.choice(ends)}" for h in hosts for p in paths]
    out += [None, None, "", "://", "no scheme/en/", "http:/one.net/", "a://b://net/", "http://", "http://net", "http://u@net:80/", "http://net/\n/x"]
    out += ["http://" + "a." * 5000 + "net/" + "x/" * 5000, "http://" + "y" * 20000 + ".a.b/x" + "/" * 3000, *out[:40]]
    return out


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_verdicts_against_every_rule_for_every_url(spark, threshold):
    given = made_urls()
    table = spark.createDataFrame([(i % 90, u, "extra") for i, u in enumerate(given)], "page_id int, link string, url string").repartition(4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)  # small rules are broadcast, others shuffled
    try:
        out = urls.judge(table, urls.rules(spark, GIVEN), url="link")
        assert out.columns == ["page_id", "link", "url", "host", "path", "rule", "verdict"]
        got = sorted((tuple(r) for r in out.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == sorted(((i % 90, u, "extra", *plain(u, GIVEN)) for i, u in enumerate(given)), key=repr)


def test_many_rules_of_one_head_and_prefixes_that_collide(spark, monkeypatch):
    monkeypatch.setattr(urls, "PREFIX", 1)  # sixteen values: most joined pairs are of other expressions
    given = [("h.net", f"/dir/{'ab'[i % 2]}{i:03d}", "block" if i % 3 else "allow") for i in range(300)]
    links = [f"http://{'w.' * (i % 3)}h.net/dir/{'ab'[i % 2]}{i:03d}{'' if i % 2 else 'tail'}" for i in range(400)]
    table = spark.createDataFrame([(u,) for u in links], "url string")
    got = sorted(tuple(r) for r in urls.judge(table, urls.rules(spark, given)).select("url", "rule", "verdict").collect() if r["rule"])
    assert got == sorted((u, *plain(u, given)[2:]) for u in links if plain(u, given)[2])


def test_empty_tables_and_clashing_names(spark):
    empty = spark.createDataFrame([], "url string")
    one = spark.createDataFrame([("http://net/",)], "url string")
    assert urls.judge(empty, urls.rules(spark, GIVEN)).collect() == []
    assert [tuple(r) for r in urls.judge(one, urls.rules(spark, []), otherwise="block").collect()] == [("http://net/", "net", "/", None, "block")]
    with pytest.raises(ValueError):
        urls.judge(one.selectExpr("url", "1 AS Host"), urls.rules(spark, GIVEN))


def test_query_matches_sql(spark, sf_small):
    assert compare(spark, connect(sf_small), sf_small, urls.op12_url_filters, urls.SQL)[0] == "ok"


def test_no_python_on_the_executors(spark, sf_small):
    plan = urls.op12_url_filters(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
