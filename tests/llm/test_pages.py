"""WARC archives and URL verdicts."""

import hashlib

import pytest
from pyspark.sql import functions as F

from hearthside.llm.queries import RULES
from hearthside.llm.url_filter import host_edges, host_of, judge, path_of, propagate
from hearthside.llm.warc import read_archive, write_archive

PAGES = [
    (1, "http://a.example.com/x", "<p>one</p>"), (2, None, None), (3, "no scheme", ""), (4, "http://b.example.com", "<p>one</p>"),
    (5, "http://c.org/ü\r\nEvil: header", "é" * 70_000), (None, "http://late", "<p>one</p>"), (0, "http://x", "<p>one</p>"), (0, "http://y", "own"),
]


def test_archive_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, payload string").repartition(3)
    manifest = write_archive(pages, str(tmp_path / "warc"), roll_bytes=300, shards=2).collect()
    names = sorted(p.name for p in (tmp_path / "warc").glob("*.warc.gz"))
    assert [m["final"].rsplit("/", 1)[1] for m in sorted(manifest, key=lambda m: m["final"])] == names and len(names) > 2
    for m in manifest:
        assert hashlib.sha256(open(m["final"], "rb").read()).hexdigest() == m["sha256"]
    assert sum(m["records"] for m in manifest) == len(PAGES) and (tmp_path / "warc" / "manifest.json").exists()
    got = {(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["verified"]) for r in read_archive(spark, str(tmp_path / "warc")).collect()}
    assert got == {
        (1, "revisit", 0, 10, True), (2, "response", None, 0, True), (3, "revisit", 2, 0, True), (4, "revisit", 0, 10, True),
        (5, "response", None, 140_000, True), (None, "revisit", 0, 10, True), (0, "response", None, 10, True), (0, "response", None, 3, True),
    }


def test_small_payloads_can_stay_responses(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    write_archive(pages, str(tmp_path / "w"), revisit_from=11)
    assert {r["record_type"] for r in read_archive(spark, str(tmp_path / "w")).collect()} == {"response"}
    assert write_archive(pages.limit(0), str(tmp_path / "none")).collect() == []


@pytest.mark.parametrize(
    "url,host,path",
    [
        ("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x"), (None, "", ""), ("nothing", "", ""), ("x://h?/a", "h", ""),
        ("http://ÄB.org/fr/", "Äb.org", "/fr/"), ("a://b://c/d", "b:", "//c/d"), ("http://\nh/p\nq", "\nh", "/p\nq"),
    ],
)
def test_address(spark, url, host, path):
    row = spark.createDataFrame([(url,)], "url string").select(host_of(F.col("url")), path_of(F.col("url"))).first()
    assert tuple(row) == (host, path)


def brute_verdict(url):
    head, sep, rest = (url or "").partition("://")
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)]) if sep else 0
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]) if sep else ""
    path = rest[cut:] if sep else ""
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [r for r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return host, path, max(fits, key=len) if fits else None


def test_rules_over_a_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    urls = {r["page_id"]: r["url"] for r in pages.collect()}
    for r in judge(pages, RULES).collect():
        host, path, rule = brute_verdict(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (RULES[rule] if rule else r["verdict"]) and r["verdict"] in ("allow", "block")


def test_distrust_flows_back_along_links(spark):
    link = lambda h: f'<a class="x" href="https://{h}/p">t</a>'
    rows = [(1, "http://bad.net/", ""), (2, "http://farm.biz/a", link("bad.net") * 2), (3, "http://fine.biz/", link("ok.org") + link("farm.biz")),
            (4, "http://ok.org/fr/1", link("GOOD.biz")), (5, "http://good.biz/", "<a href='/local'>"), (6, "http://far.biz/", link("farm.biz")), (None, None, None)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host_score string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in judge(pages, RULES).collect()}
    assert got == {1: ("net/", "block"), 2: (None, "block"), 3: (None, got[3][1]), 4: ("org/fr/", "allow"), 5: (None, "allow"), 6: (None, "block"), None: (None, "allow")}
    assert judge(pages.limit(0), RULES).collect() == []


def test_propagation_against_plain_iteration(spark):
    edges = [("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("d", "c")]
    seeds = {"a": (1.0, 0.0), "b": (0.0, 0.0), "c": (0.0, 1.0), "d": (0.0, 0.0)}
    t, d = {h: s[0] for h, s in seeds.items()}, {h: s[1] for h, s in seeds.items()}
    for _ in range(7):
        t, d = (
            {h: 0.15 * seeds[h][0] + 0.85 * sum(t[u] / sum(x == u for x, _ in edges) for u, v in edges if v == h) for h in seeds},
            {h: 0.15 * seeds[h][1] + 0.85 * sum(d[v] / sum(y == v for _, y in edges) for u, v in edges if u == h) for h in seeds},
        )
    frame = spark.createDataFrame([(h, *s) for h, s in seeds.items()], "host string, trust double, distrust double")
    got = propagate(frame, spark.createDataFrame(edges, "source string, target string"), rounds=7, keep_every=3)
    for r in got.collect():
        assert abs(r["trust"] - t[r["host"]]) < 1e-9 and abs(r["distrust"] - d[r["host"]]) < 1e-9


def test_parent_hosts_are_neighbours(spark):
    pages = spark.createDataFrame([("a.b.org", ""), ("b.org", None), ("c.org", "")], "host string, html string")
    assert {tuple(r) for r in host_edges(pages).collect()} == {("a.b.org", "b.org"), ("b.org", "a.b.org")}
    # two hosts of a domain without pages of its own meet there
    pages = spark.createDataFrame([("m.x.co.uk", ""), ("w.x.co.uk", '<a href="http://a.z.org/">')], "host string, html string")
    found = {tuple(r) for r in host_edges(pages).collect()}
    assert {("m.x.co.uk", "x.co.uk"), ("x.co.uk", "w.x.co.uk"), ("w.x.co.uk", "a.z.org"), ("a.z.org", "z.org")} <= found
    assert not any("uk" in e or "org" in e for e in found)


def test_distrust_reaches_hosts_of_a_domain(spark):
    rows = [(1, "http://a.net/"), (2, "http://b.shop.biz/"), (3, "http://c.shop.biz/"), (4, "http://else.biz/")]
    html = {2: "<a href='http://a.net/'>x</a>"}
    pages = spark.createDataFrame([(i, u, html.get(i)) for i, u in rows], "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in judge(pages, RULES, threshold=0.01).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow"}


@pytest.mark.parametrize("damage", ["missing", "unlisted", "longer", "changed", "manifest"])
def test_damaged_archives_are_errors(spark, tmp_path, damage):
    folder = tmp_path / "w"
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>" * 50) for i in range(40)], "page_id long, url string, html string")
    write_archive(pages, str(folder), roll_bytes=1500, shards=3)
    assert read_archive(spark, str(folder)).count() == 40
    files = sorted(folder.glob("*.warc.gz"))
    if damage == "missing":
        files[0].rename(tmp_path / "gone")
    elif damage == "unlisted":
        (folder / "part-999.warc.gz").write_bytes(files[0].read_bytes())
    elif damage == "longer":
        files[0].write_bytes(files[0].read_bytes() * 2)
    elif damage == "changed":
        files[0].write_bytes(bytes([files[0].read_bytes()[0]]) + files[0].read_bytes()[1:-1] + b"x")
    else:
        (folder / "manifest.json").rename(tmp_path / "gone")
    for crc in folder.glob(".*.crc"):
        crc.rename(tmp_path / f"crc{crc.name}")
    with pytest.raises(Exception, match="differ|manifest|PATH_NOT_FOUND"):
        read_archive(spark, str(folder)).collect()


def test_empty_archive(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    write_archive(pages, str(tmp_path / "w"))
    assert read_archive(spark, str(tmp_path / "w")).collect() == []
