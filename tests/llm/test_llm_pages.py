"""Operators on pages."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import random
from collections import Counter, defaultdict
from itertools import groupby
from xml.etree import ElementTree

import duckdb
import pytest
from pyspark.sql import functions as F
from reelstat.llm import queries, site_tree, url_filter, warc

SCHEMA = "page_id long, url string, html string, host string, keys string, text string"


@pytest.fixture(scope="module")
def pages(spark):
    urls = [None, "", "no scheme/x", "http://", "HTTP://WWW.Example.COM/en/1?q#f", "http://a.example.com/en/x", "http://net/es/", "s://x.net/fr/1"]
    urls += ["http://x.net", "http://x.net?/fr/", "https://xnet/fr/", "http://example.com/en/", "http://deep.www.example.com/en/ü", "http://é.org/a b"]
    rows = [(i, u, None if i == 1 else "" if i == 2 else f"<p>page {i % 5} é</p>", "h", "k", "t") for i, u in enumerate(urls)]
    return spark.createDataFrame([*rows, rows[4], (None, urls[5], None, None, None, None)], SCHEMA)


def test_url_rules_equal_their_sql(spark, pages):
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    got = sorted(map(tuple, url_filter.judged(pages, rules).collect()), key=repr)
    con = duckdb.connect()
    con.register("pages", pages.select("page_id", "url").toPandas().astype({"page_id": "Int64"}))
    assert got == sorted(con.sql(queries.ORACLES["op5_url_filters"]).fetchall(), key=repr)
    assert url_filter.judged(pages.limit(0), rules).collect() == []
    assert {r.verdict for r in url_filter.judged(pages, rules.limit(0)).collect()} == {"allow"}


def test_cascade_is_exact_on_its_universe(spark):
    rng = random.Random(2)
    keys = [f"k{i}" for i in range(20_000)]
    listed = set(rng.sample(keys, 3_000))
    frame = lambda names: spark.createDataFrame([(k,) for k in names], "key string")
    levels = url_filter.cascade(frame(sorted(listed)), frame(keys))
    assert len(levels) > 1
    batch = spark.createDataFrame([(k, [k + "\n"]) for k in keys], "row string, keys array<string>")
    sent = spark.sparkContext.broadcast(url_filter.cascade(frame([k + "\n" for k in sorted(listed)]), frame([k + "\n" for k in keys])))
    out = batch.mapInArrow(url_filter._first_listed(sent), "row string, found string")
    assert {r.row for r in out.where("found is not null").collect()} == listed


def test_joined_rules_answer_alike(spark, pages, monkeypatch):
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    pages = pages.unionByName(pages.where("page_id > 3")).withColumn("_rest", F.lit(1))
    long = F.concat(F.lit("http://a.example.com/en/"), F.repeat(F.lit("x/"), 100_000))
    pages = pages.unionByName(pages.limit(1).withColumn("url", long))
    want = sorted(map(tuple, url_filter.judged(pages, rules).collect()), key=repr)
    assert len(want) == pages.count()
    monkeypatch.setattr(url_filter, "MAX_BYTES", 0)
    assert sorted(map(tuple, url_filter.judged(pages, rules).collect()), key=repr) == want


def test_levels_shrink_whatever_the_universe():
    """A level errs on fewer keys than it encodes, so that bits follow the list: 1,000 rules in a corpus of 10 ** 12 keys."""
    n, others, total = 1_000, 10**12, 0
    while n:
        n_bits, hashes = url_filter._size(n, others)
        wrong = others * (1 - (1 - 1 / n_bits) ** (hashes * n)) ** hashes
        assert wrong <= n / 4
        total, n, others = total + n_bits // 8, int(wrong), n
    assert total < 100_000


PAGE = (
    "<html><head><title>T</title><style>p>a{}</style></head><body><header>Site</header><nav><ul><li><a href='/x'>X</a></ul></nav>"
    '<div class="ad big">Buy</div><article><header><h1>Head &amp; more</h1></header><p><b>One<br>two<p>Three&nbsp;four&#33; <i>in</i>line'
    '<div id="comments"><p>Nice post</div><form>Name</form><script>"</p>"</script></article><aside>Side</aside><footer>&copy; F</footer>'
)


def test_blocks_of_the_article():
    assert [text for _, text, _ in site_tree.blocks(PAGE)] == ["Head & more", "One two", "Three four! inline"]
    assert site_tree.blocks("") == [] and site_tree.blocks("<") == [("", "<", False)]
    assert [b[1] for b in site_tree.blocks("<p>a<li>b<table><tr><td>c<td>d</table><!-- x")] == ["a", "b", "c", "d"]
    assert [b[1] for b in site_tree.blocks("<script>never closed")] == []


def test_names_of_wrappers_are_no_noise():
    texts = lambda page: [text for _, text, _ in site_tree.blocks(page)]
    for name in ("content with-sidebar", "no-sidebar", "has-comments", "search-results", "widget"):
        assert texts(f'<div class="{name}"><nav>N</nav><article><p>Text</p></article></div><p>x') == ["Text"], name
    assert texts('<div id="social-history"><p>Long own text</p></div>') == ["Long own text"]
    assert texts('<div class="widget"><p>Most of the text</p></div><p>Less') == ["Most of the text", "Less"]
    assert texts('<div class="page-footer">F</div><p>Own text <span class="ad">Buy</span> on</p>') == ["Own text on"]
    page = '<article><p>Short</p></article><div id="comments"><article><p>A comment that is longer</p></article></div>'
    assert texts(page) == ["Short"]


def test_what_all_pages_of_a_host_share_is_cut(spark):
    html = "<body><div><p>Subscribe now</p><p>Own text {0}</p></div></body>"
    rows = [(i, "http://h.org/" + str(i), html.format(i)) for i in range(12)]
    rows += [(50 + i, "http://h.org/copy", html.format(3)) for i in range(40)]  # copies are no template
    rows += [(100, "http://one.org/", html.format("x")), (101, None, None), (None, "http://one.org/", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.page_id: (r.text, r.n_chars) for r in site_tree.extract(pages).collect()}
    assert out[5] == ("Own text 5", 10) and out[70] == ("Own text 3", 10)
    assert out[100] == ("Subscribe now Own text x", 24)
    assert out[101] == out[None] == ("", 0)
    assert site_tree.extract(pages.limit(0)).collect() == []


def test_the_share_of_pages_decides_at_every_size(spark):
    """A sentence on 40 % of the pages stays whatever their number, copies are told by their blocks, articles stay whole."""
    html = "<body><script>{0}</script><div><p>Menu</p>{1}<p>Own {2}</p></div></body>"
    rows = []
    for host, m in (("small.org", 20), ("large.org", 400)):
        for i in range(m):
            rows.append((len(rows), f"http://{host}/{i}", html.format(i, "<p>Shared</p>" if i % 5 < 2 else "", i)))
    rows += [(1000 + i, "http://small.org/copy", html.format(1000 + i, "", 3)) for i in range(200)]
    rows += [(2000 + i, "http://a.org/", f"<article><p>Same text</p><p>Own {i}</p></article>") for i in range(10)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.page_id: r.text for r in site_tree.extract(pages).collect()}
    assert out[0] == out[20] == "Shared Own 0" and out[2] == "Own 2"
    assert out[1003] == "Own 3" and out[2001] == "Same text Own 1"


def test_branches_of_low_presentation_and_content_are_cut(spark):
    """Boxes of unknown names: links whose text differs, a fixed notice that wraps, and an article told by its content only."""
    html = (
        "<body><div class='x1'><ul>{links}</ul></div><div class='x2'><p>Buy <b>now</b></p><p>or never</p></div>"
        "<div class='x3'><h1>Title {i}</h1><p>Own text of page {i} with <a href='/'>a link {i}</a></p>{more}</div></body>"
    )
    rows = []
    for i in range(40):
        links = "".join(f"<li><a href='/{n}'>Related {i} {n}</a>" for n in range(1 + i % 4))
        rows.append((i, f"http://h.org/{i}", html.format(i=i, links=links, more="<p>And more</p>" * (i % 2))))
    rows += [(100 + i, f"http://few.org/{i}", html.format(i=i, links="<li><a>R</a>", more="")) for i in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.page_id: r.text for r in site_tree.extract(pages).collect()}
    assert out[4] == "Title 4 Own text of page 4 with a link 4"
    assert out[5] == "Title 5 Own text of page 5 with a link 5 And more"
    assert out[101] == "R Buy now or never Title 1 Own text of page 1 with a link 1"  # three pages tell too little


def plainly(pages: list[tuple[int, str]], low: float = site_tree.LOW) -> dict[int, str]:
    """The texts of the pages (id, well-formed html) of one host, from whole trees and lists of all that stands at a place."""
    trees = {page_id: ElementTree.fromstring(html) for page_id, html in pages}
    met, texts = defaultdict(list), {}
    for page_id, tree in trees.items():
        styles, own, blocks = defaultdict(list), defaultdict(list), []

        def walk(e, place, tags):
            at, tags = (*place, ".".join([e.tag, *sorted(e.get("class", "").split())])), (*tags, e.tag)
            styles[at].append(tuple(tag for tag, _ in groupby(x.tag for x in e)))
            pieces, linked = [e.text or ""], not (e.text or "").strip()

            def close():
                nonlocal pieces, linked
                if "".join(pieces).strip():
                    blocks.append((at, tags, " ".join("".join(pieces).split())))
                    if not linked:
                        own[at].append(blocks[-1][2])
                pieces, linked = [], True

            for child in e:
                if child.tag in site_tree.BLOCK:
                    close()
                    walk(child, at, tags)
                else:
                    pieces.append(child.text or "")
                    linked &= child.tag == "a" or not (child.text or "").strip()
                pieces.append(child.tail or "")
                linked &= not (child.tail or "").strip()
            close()

        walk(tree, (), ())
        texts[page_id] = (set(styles), blocks)
        for at in styles:
            met[at].append((tuple(k for k, _ in groupby(styles[at])), tuple(own[at])))

    def importance(values):
        counts = [*Counter(values).values(), 1]
        return 1 - math.exp(-sum(-n / sum(counts) * math.log(n / sum(counts)) for n in counts))

    low_at = {at for at, seen in met.items() if max(importance([s for s, _ in seen]), importance([c for _, c in seen])) < low}
    shared = Counter(x for _, blocks in texts.values() for x in {(tags, text) for _, tags, text in blocks})
    out = {}
    for page_id, (places, blocks) in texts.items():
        cut = {at for at in places if all(below in low_at for below in places if below[: len(at)] == at)}
        kept = [t for at, tags, t in blocks if at not in cut and not 1 - (shared[tags, t] - 1) / len(texts) < low]
        out[page_id] = " ".join(kept)
    return out


def test_extraction_equals_brute_force(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for host in range(6):
        own = []
        for i in range(rng.choice([1, 4, 9, 30])):
            boxes = [f"<div class='k'>{''.join(f'<a>Link {rng.random()}</a>' for _ in range(rng.randrange(1, 4)))}</div>"]
            boxes.append(f"<div class='b a'><p>Fixed</p><p>{rng.choice(['One', 'One', 'One', 'Two'])}</p></div>")
            boxes.append(f"<div><p>Text {rng.random()} <b>bold</b></p>{'<p>Shared</p>' * rng.randrange(2)}tail <a>x</a></div>")
            boxes.append("<section><div><p>Deep <i>fixed</i></p></div></section>" * (rng.random() < 0.9))
            own.append((len(rows), f"<html>{''.join(boxes)}</html>"))
            rows.append((len(rows), f"http://{host}/", own[-1][1]))
        want |= plainly(own)
    pages = spark.createDataFrame([*rows, rows[0]], "page_id long, url string, html string")  # a repeated row counts once
    out = site_tree.extract(pages).collect()
    assert len(out) == len(rows) + 1 and {r.page_id: r.text for r in out} == want
    assert any("Fixed" not in t for t in want.values()) and any("Fixed" in t for t in want.values())


def test_extraction_of_odd_input(spark):
    long = "<p>" + "word <b>bold</b> " * 50_000 + "</p>" + "<div>" * 3000 + "deep"
    rows = [(1, "http://h/", long, 1, "c", "n"), (1, "http://h/", long, 1, "c", "n"), (None, None, None, None, None, None), (2, "", "", 0, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host int, copy string, noise string")
    out = sorted((r.page_id or 0, r.n_chars) for r in site_tree.extract(pages).collect())
    assert out == [(0, 0), (1, 50_000 * 10 - 1 + 5), (1, 50_000 * 10 - 1 + 5), (2, 0)]


def test_archives_round_trip(spark, pages):
    out = warc.round_trip(pages).collect()
    assert len(out) == pages.count()
    html = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    largest: dict[bytes, int] = {}
    for page_id, payload in html.items():
        largest[payload] = max(largest.get(payload, -1), -1 if page_id is None else page_id)
    for r in out:
        payload = html[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
        target = largest[payload]
        assert (r.record_type, r.refers_to) == (("response", None) if r.page_id == target else ("revisit", target))
    assert warc.round_trip(pages.limit(0)).collect() == []


@pytest.mark.parametrize("version", [1, 2])
def test_archive_headers_by_version(version):
    block = warc.VERSION_LINES[version]
    head = b"filedesc://x 0.0.0.0 20240101000000 text/plain " + (b"200 - - 0 x " if version == 2 else b"") + b"%d\n" % len(block)
    record = warc.arc_record("http://x/a b", 7, b"pay\nload\r\n\r\n", version, 9)
    (found,) = warc.parse_arc(warc.inflated(gzip.compress(head + block) + gzip.compress(b"\n" + record + b"\n")))
    assert found[0] == "http://x/a%20b" and warc._split_http(found[3])[1:] == (b"pay\nload\r\n\r\n", 7)


def test_small_payloads_are_all_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "v", "ab"), (3, "w", "abc"), (4, "x", "abc")], "page_id long, url string, html string")
    warc.write_arc(pages, str(tmp_path / "arc"))
    warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"), least_bytes=3)
    out = {r.page_id: r.refers_to for r in warc.read_warc(spark, str(tmp_path / "warc")).collect()}
    assert out == {1: None, 2: None, 3: 4, 4: None}
