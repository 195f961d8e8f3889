"""URL filter: parsing, rules, propagation against plain iteration, odd rows."""

import re

import pytest

from riskframe.llm import urls
from riskframe.llm.queries import QUERIES, URL_RULES


def plain_address(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def plain_rule(host, path, rules=URL_RULES):
    fits = []
    for verdict, rule in rules:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme/x", "http://A.Example.NET/en/x?q#f", "https://net", "x://net/", "x://a.net?/en/", "x://badnet/", "http://a://b/c", "http:///p", "q://É.Org/fr/é", "q://org/fr", "z://x.example.com/de/1#a", "z://example.com/DE/1", "://h\n.org/fr/\n", "z://example.net/en"]


def test_addresses_and_rules(spark):
    df = spark.createDataFrame([(i, u, None, "h", 1.0) for i, u in enumerate(URLS)], "page_id long, url string, html string, host string, trust double")
    for r in urls.Filter(URL_RULES).judge(df).collect():
        want = plain_address(URLS[r.page_id])
        assert (r.host, r.path) == want
        rule, verdict = plain_rule(*want)
        assert r.rule == rule and r.verdict in ([verdict] if rule else ["allow", "block"])


def plain_ranks(nodes, seeds, edges, damping, rounds):
    """Personalised PageRank; edges {(a, b): n}; what has no way on goes back to the seeds."""
    total, rank = sum(seeds.values()), {h: seeds.get(h, 0.0) for h in nodes}
    out = {}
    for (a, _), n in edges.items():
        out[a] = out.get(a, 0.0) + n
    for _ in range(rounds):
        got = dict.fromkeys(nodes, 0.0)
        for (a, b), n in edges.items():
            got[b] += rank[a] * n / out[a]
        left = (total - sum(got.values())) / total if total else 0
        rank = {h: (1 - damping) * seeds.get(h, 0.0) + damping * (got[h] + left * seeds.get(h, 0.0)) for h in nodes}
    return rank


def test_propagation_by_plain_iteration(spark):
    edges = {("a", "b"): 2.0, ("a", "c"): 1.0, ("b", "c"): 1.0, ("c", "a"): 3.0, ("d", "c"): 1.0, ("e", "d"): 4.0, ("b", "x"): 1.0}
    seeds = [("a", 3.0, 0.0), ("c", 1.0, 2.0), ("d", 0.0, 5.0), ("z", 0.0, 1.0)]
    f = urls.Filter((), precision=1e-3)
    got = {
        r.host: (r.trust, r.distrust)
        for r in f.propagate(
            spark.createDataFrame(seeds, "host string, allowed double, blocked double"),
            spark.createDataFrame([(a, b, n) for (a, b), n in edges.items()], "src string, dst string, n double"),
        ).collect()
    }
    nodes = {h for e in edges for h in e} | {s[0] for s in seeds}
    trust = plain_ranks(nodes, {h: t for h, t, _ in seeds}, edges, f.damping, 400)
    distrust = plain_ranks(nodes, {h: d for h, _, d in seeds}, {(b, a): n for (a, b), n in edges.items()}, f.damping, 400)
    for h in nodes - {"z"} | {"z"}:
        assert got[h] == (pytest.approx(trust[h], abs=1e-3), pytest.approx(distrust[h], abs=1e-3))


def chain(n, pages):
    """A blocked host of so many pages, behind it hosts of one page that each link to the one before."""
    rows = [(i, f"http://bad.net/{i}", "") for i in range(pages)]
    name = lambda i: f"h{i}.com" if i else "bad.net"
    return rows + [(pages + i, f"http://{name(i)}/", f"<a href='//{name(i - 1)}/'>") for i in range(1, n + 1)]


def test_distrust_reaches_hosts_behind_a_long_chain(spark):
    import duckdb

    rows, f = chain(20, 50), urls.Filter(URL_RULES)
    want = plain_ranks(
        {"bad.net"} | {f"h{i}.com" for i in range(1, 21)}, {"bad.net": 50.0},
        {("bad.net" if i == 1 else f"h{i - 1}.com", f"h{i}.com"): 1.0 for i in range(1, 21)}, f.damping, 400,
    )
    got = {r.host: r for r in f.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for host, rank in want.items():
        assert got[host].distrust == pytest.approx(rank, abs=2e-6)
    blocked = {h for h, r in got.items() if r.verdict == "block"}
    assert blocked == {h for h, rank in want.items() if h == "bad.net" or rank / (rank + 0.5) >= 0.5}
    assert "h14.com" in blocked and "h20.com" not in blocked
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    verdicts = dict(con.execute(f"SELECT host, verdict FROM ({urls.equivalent_sql(f)})").fetchall())
    assert verdicts == {h: r.verdict for h, r in got.items()}


def test_links_of_a_hub_in_pieces(spark, monkeypatch):
    rows = [(i, f"http://h{i}.com/", "<a href='//bad.net/'>") for i in range(40)] + [(99, "http://bad.net/", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole = sorted(urls.Filter(URL_RULES).judge(df).collect())
    monkeypatch.setattr(urls, "HUB_LINKS", 7)
    assert sorted(urls.Filter(URL_RULES).judge(df).collect()) == whole


def test_hosts_that_link_to_the_blocked_are_blocked(spark):
    spam = [(i, f"http://bad.net/{i}", "") for i in range(6)]
    farm = [(10, "http://farm.com/", '<a HREF="//BAD.net/x">'), (11, "http://farm.com/2", "<a href='http://bad.net/'>")]
    clean = [(20, "http://fine.com/", '<a href="/bad.net">'), (21, "http://x.org/fr/1", '<a href="http://fine.com/">')]
    df = spark.createDataFrame(spam + farm + clean, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urls.Filter(URL_RULES).judge(df).collect()}
    assert {k for k, v in got.items() if v == "block"} == set(range(6)) | {10, 11}


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.Filter(URL_RULES).judge(df).count() == 0


def test_query(spark, sf_dir):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()}
    rows = QUERIES["op5_url_filter"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        host, path = plain_address(pages[r.page_id])
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block")
        assert verdict is None or r.verdict == verdict


def test_sql_agrees_where_hosts_link(spark):
    import duckdb

    hosts = ["a.net", "b.com", "c.org", "d.example.com", "e.example.net", "f.io"]
    rows = []
    for i in range(60):
        h, to = hosts[i * i % 6], [hosts[(i * k) % 6] for k in (1, 3, 5)][: i % 4]
        links = "".join(f"<a HREF='//{x.upper() if i % 2 else x}/{i}'>" for x in to)
        rows.append((i, f"http://{h}/{('en', 'de', 'fr')[i % 3]}/{i}", links or None))
    rows += [(100, None, "x"), (101, "", None), (102, "no", "<a href=http://f.io>")]
    f = urls.Filter(URL_RULES, precision=1e-3)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    want = sorted(con.execute(urls.equivalent_sql(f)).fetchall())
    got = sorted(tuple(r) for r in f.judge(df).collect())
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5:] == pytest.approx(b[5:], abs=2e-6)
