import os
import sys

sys.path.insert(0, os.path.dirname(__file__))

from tidewater.llm import url_filter as u  # noqa: E402
from tidewater.llm._components import components  # noqa: E402


def _run(spark, rows, redirects=None, **how):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    log = spark.createDataFrame(redirects, "from_url string, to_url string") if redirects else None
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in u.filter_urls(df, redirects=log, **how).collect()}


def test_hosts_paths_and_longest_rule(spark):
    urls = {1: "http://A.Example.NET/en/x?q", 2: "https://example.net", 3: "http://x.net/", 4: "http://notexample.com/de/", 5: "ftp://de.example.com/de/#f",
            6: "http://org/fr/?", 7: "no scheme", 8: None, 9: "x://h#f://z/", 10: "http://É.NET/a", 11: "http://net", 12: ""}
    got = _run(spark, [(k, v, None, "clash") for k, v in urls.items()])
    assert got == {
        1: ("a.example.net", "/en/x", "example.net/en/", "allow"), 2: ("example.net", "", None, "allow"), 3: ("x.net", "/", "net/", "block"),
        4: ("notexample.com", "/de/", None, "allow"), 5: ("de.example.com", "/de/", "example.com/de/", "block"), 6: ("org", "/fr/", "org/fr/", "allow"),
        7: ("", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("h", "", None, "allow"), 10: ("É.net", "/a", "net/", "block"),
        11: ("net", "", None, "allow"), 12: ("", "", None, "allow")}


def test_aliases_carry_blocks_and_allow_goes_first(spark):
    link = lambda t: f"<html><head><link href='{t}' rel=\"canonical\"></head>"
    rows = [(1, "http://a.com/1", link("http://bad.net/1")), (2, "http://b.com/2#x", link("http://A.com/1")),
            (3, "http://c.com/3", "<META content=\"0; URL=http://bad.net/3?a=1&amp;b=2\" HTTP-EQUIV='refresh'>"),
            (4, "http://d.com/4", link("http://bad.net/4")), (5, "http://x.org/fr/4", link("http://d.com/4")),
            (6, "http://e.com/6", link("/other")), (7, "http://e.com/other", None), (8, "http://f.com/8", "<link rel=icon href=http://bad.net/1>"),
            (9, "http://g.com/9", ""), (2, "http://b.com/2", None)]
    got = _run(spark, [(*r, "") for r in rows], redirects=[("http://g.com/9", "http://h.com/"), ("http://h.com/", "http://bad.net/1"), (None, "x")])
    assert {k: v[3] for k, v in got.items()} == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "allow", 9: "block"}
    assert all(v[2] is None for k, v in got.items() if k != 5)


def test_empty_and_one_hot_target(spark):
    assert _run(spark, []) == {}
    rows = [(k, f"http://s{k}.com/", "<link rel=canonical href=http://hub.net/>", "") for k in range(400)]
    assert {v[3] for v in _run(spark, rows).values()} == {"block"}


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(6, 60)] + [(200, 200), (None, 3), (300, 301), (301, 300), (300, 301)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(map(tuple, components(df, "t").collect()))
    assert got == {**{k: 100 for k in range(100, 161)}, **{k: 5 for k in range(5, 60)}, 300: 300, 301: 300}


def test_main_path_has_no_python(spark):
    df = spark.createDataFrame([(1, "http://a.net/", "")], "page_id long, url string, html string")
    plan = u.filter_urls(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_relative_targets_all_tags_and_base(spark):
    at = "http://Host.com/a/b/page.html?x=1#f"
    refresh = lambda t: f"<meta http-equiv='refresh' content='0; url={t}'>"
    want = {"next.html": "http://host.com/a/b/next.html", "../x": "http://host.com/a/x", "?id=2": "http://host.com/a/b/page.html?id=2", "./y/./z?q=../k": "http://host.com/a/b/y/z?q=../k",
            "../../../../up/..": "http://host.com/", "/r/../s?u=http://t.com/": "http://host.com/s?u=http://t.com/", "//o.com/p": "http://o.com/p", "https://Q.com/a": "https://q.com/a",
            "..": "http://host.com/a/", "a:b": None, "mailto:x@y.z": None, "#top": "http://host.com/a/b/page.html?x=1", "n//m": "http://host.com/a/b/n//m"}
    rows = [(k, at, refresh(t)) for k, t in enumerate(want)]
    rows += [(50, "http://h.com", "<link rel='canonical' href='k.html'>"), (51, at, "<base href='../c/'><LINK HREF=d REL='nofollow CANONICAL'/><link rel=canonical href=\"e\"><link rel='canonical-x' href=f>")]
    rows += [(52, at, refresh("g") + refresh("h") + "<link data-rel=canonical href=no>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for k, t in enumerate(want):
        assert [r.b for r in u.page_links(df.where(f"page_id = {k}")).collect()] == [want[t]] * (want[t] is not None), t
    links = lambda k: sorted(r.b for r in u.page_links(df.where(f"page_id = {k}")).collect())
    assert links(50) == ["http://h.com/k.html"]
    assert links(51) == ["http://host.com/a/c/d", "http://host.com/a/c/e"]
    assert links(52) == ["http://host.com/a/b/g", "http://host.com/a/b/h"]
    got = _run(spark, [(1, "http://x.com/bad/a", refresh("../c/t"), ""), (2, "http://x.com/c/t", None, "")], rules=[("x.com", "/bad/", "block")])
    assert {k: v[3] for k, v in got.items()} == {1: "block", 2: "block"}
