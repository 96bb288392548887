"""Bit-sliced search, URL filter, extraction and archives."""

from __future__ import annotations

import base64
import hashlib
import html
import itertools
import math
import random
from collections import Counter
from html.parser import HTMLParser

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lapidar.llm import bitsliced, html_extract, url_filter, warc
from lapidar.session import scratch_dir


def brute(rows, k=5):
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None
          and all(x is not None and math.isfinite(x) for x in v)]
    d = max((len(v) for _, v in ok), default=0)
    ok = [(i, v + [0] * (d - len(v))) for i, v in ok]
    out, queries = [], {}
    for i, v in ok:
        if i % 50 == 0:
            queries[i] = min(queries.get(i, v), v)
    for q, v in queries.items():
        hits = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in ok if i != q)[:k]
        out += [(q, r, i, -s if -(2**63) <= -s < 2**63 else None, str(-s)) for r, (s, i) in enumerate(hits, 1)]
    return sorted(out, key=str)


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(0, 0.2, 9).astype(np.float32).tolist()) for i in range(400)]
    rows += [(500 + i, rows[0][1]) for i in range(200)]  # ties: one very common vector
    rows += [(50, rows[3][1]), (7, rows[7][1]), (900, None), (950, [None] + [0.1] * 8), (951, [float("nan")] * 9), (952, [float("inf")] * 9),
             (1000, [0.5]), (1050, []), (1100, [1e30] * 9), (None, [0.1] * 9), (1150, [-3.0] * 9), (1151, [3e38, -3e38] + [7.0] * 7),
             (1152, [600_000.0, 1.0]), (1153, [-(2.0**60), 2.0**55]), (1200, [1e-30, -1e-30, 2.0**40])]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, score int, lane int")
    found = bitsliced.top_k(frame.repartition(3), F.pmod("vec_id", F.lit(50)) == 0, block_rows=70)
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_large_components_keep_their_rows(spark):
    rows = [(50, [1.0, 2.0]), (1, [600_000.0, 1.0]), (2, [1.0, 1.0])]
    found = bitsliced.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") == 50)
    assert [tuple(r)[:4] for r in sorted(found.collect(), key=lambda r: r["rank"])] == [(50, 1, 1, 256 * 256 * 600_002), (50, 2, 2, 196_608)]


def test_keys_sort_like_whole_numbers():
    rng = random.Random(2)
    numbers = [0, 1, -1, 2**63, -(2**63), 15, 16, -15, -16] + [rng.randrange(-(2**rng.randrange(1, 900)), 2 ** rng.randrange(1, 900)) for _ in range(500)]
    assert sorted(numbers) == sorted(numbers, key=bitsliced.sort_key)


def test_top_k_with_few_or_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    every = F.lit(True)
    assert bitsliced.top_k(spark.createDataFrame([], schema), every).count() == 0
    assert bitsliced.top_k(spark.createDataFrame([(1, [1.0])], schema), every).count() == 0
    two = bitsliced.top_k(spark.createDataFrame([(1, [1.0]), (2, [-1.0])], schema), every)
    assert sorted(tuple(r)[:4] for r in two.collect()) == [(1, 1, 2, -65536), (2, 1, 1, -65536)]


URLS = [
    ("http://A.Example.NET/en/1?x", "a.example.net", "/en/1", "example.net/en/"), ("https://example.net/de/", "example.net", "/de/", "net/"),
    ("http://net", "net", "", None), ("http://x.org/fr/a#b", "x.org", "/fr/a", "org/fr/"), ("http://forg/fr/", "forg", "/fr/", None),
    ("mailto:x", "", "", None), (None, "", "", None), ("", "", "", None), ("ftp://example.com/de/x://y/", "example.com", "/de/x://y/", "example.com/de/"),
    ("http://É.net/é", "É.net", "/é", "net/"), ("a://b\nc.org/fr/", "b\nc.org", "/fr/", "org/fr/"), ("http://x?://y.net/", "x", "", None),
]


def test_hosts_paths_and_rules(spark):
    rows = [(i, u, "h", "r", 0.5) for i, (u, *_) in enumerate(URLS)] + [(3, URLS[3][0], "h", "r", 0.5), (None, None, "h", "r", 0.5)]
    found = url_filter.url_verdicts(spark, spark.createDataFrame(rows, "page_id long, url string, host string, says string, score double"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in found.collect()}
    assert got == {i: tuple(x[1:]) for i, x in enumerate(URLS)} | {None: ("", "", None)}
    assert found.count() == len(rows)
    assert {r["verdict"] for r in found.where("rule IN ('net/', 'example.com/de/')").collect()} == {"block"}


def test_url_model_matches_brute_force(spark):
    rng = random.Random(2)
    good, bad = [f"http://good{rng.randrange(99)}.org/fr/{i}" for i in range(60)], [f"http://spam-{rng.randrange(99)}.net/{i}" for i in range(60)]
    free = ["http://good7.com/a", "http://spam-7.com/", "https://x"]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(good + bad + free)], "page_id long, url string")
    found = {r["url"]: r for r in url_filter.url_verdicts(spark, frame).collect()}

    def codes(u):
        folded = [c if c in url_filter.ALPHABET[1:-1] else "0" if c in "0123456789" else "~" for c in u.lower()]
        return [0, 0, *(url_filter.ALPHABET.index(c) for c in folded), 0]

    runs = lambda u: list(zip(*(codes(u)[i:] for i in range(3))))

    def model(urls):
        seen = [r for u in set(urls) if int(hashlib.md5(u.encode()).hexdigest()[:8], 16) % 5 for r in runs(u)]

        def p(context, c, n):
            hits = [r for r in seen if r[2 - n : 2] == context]
            low = 1 / url_filter.N if n < 0 else p(context[1:], c, n - 1) if n else 1 / url_filter.N
            kinds = len({r[2] for r in hits})
            return (sum(r[2] == c for r in hits) + kinds * low) / (len(hits) + kinds) if hits else low

        return lambda r: p(r[:2], r[2], 2)

    a, b = model(good), model(bad)
    for u in free:
        expected = np.mean([math.log(a(r)) - math.log(b(r)) for r in runs(u)])
        assert found[u]["score"] == pytest.approx(expected, abs=2e-6)
    assert (found[free[0]]["verdict"], found[free[1]]["verdict"]) == ("allow", "block")


def test_urls_without_rules_or_rows(spark):
    schema = "page_id long, url string"
    assert url_filter.url_verdicts(spark, spark.createDataFrame([], schema)).count() == 0
    rows = url_filter.url_verdicts(spark, spark.createDataFrame([(1, "http://a.com/")], schema)).collect()
    assert [(r["score"], r["verdict"]) for r in rows] == [(0.0, "allow")]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
<header class=site><a href=/>Home</a></header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav><div id="cookie-notice">We use cookies</div>
<div class="ad">Buy <b>now</b>!</div><article><header><h1>A &amp; B &lt;p&gt;</h1></header><p>First   para&nbsp;graph
goes on.<br>Same block.<p>Second <b>bold</b> one<!-- <p>hidden --></p><p>x</p><aside>Related: <a>link</a></aside>
<form><label>Name</label><input><textarea>typed</textarea></form><div hidden>secret</div></article>
<section id="comments"><p>Reader says a fairly long thing about the article here.</p></section><aside class=sidebar>Side</aside>
<footer>&copy; 2020 <p>All rights reserved</p></footer></body></html>"""


def test_page_text():
    assert html_extract.main_text(PAGE) == "A & B <p>\nFirst para graph goes on. Same block.\nSecond bold one\nx"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("<article><p>cut off &amp mid", "cut off & mid"), ("<article><p>a < b and c > d</p></article>", "a < b and c > d"),
        ("<ARTICLE><P CLASS='x>y'>Quoted</P></ARTICLE>", "Quoted"), ("<article><script>x</SCRIPT><p>After</p>", "After"),
        ("<article><p>&#x41;&#66;&eacute;</p><![CDATA[x]]></article>", "ABé"), ("<main><div><p>In main</p></div></main><footer>f</footer>", "In main"),
        ("<article><p>İ<script>1</ScRiPt>2</p></article>", "İ2"), ("<article></div></p><p>stray ends</p>", "stray ends"),
    ],
)
def test_small_pages(page, text):
    assert html_extract.main_text(page) == text


LONG = " ".join(["Some words of a paragraph, long enough"] * 7)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<body><div><h1>T</h1><p>{LONG}</p><p>Ok.</p></div></body>", f"T\n{LONG}\nOk."),
        (f"<article><p title=it's>{LONG}</p><p>And more</p></article>", f"{LONG}\nAnd more"),
        (f"<article><p data-w=5\">{LONG}</p></article>", LONG),
        (f"<article><div data-class='ads'><p>{LONG}</p></div></article>", LONG),
        (f"<article><h2 id='share-prices-fall'>Share</h2><p id=share-prices>{LONG}</p></article>", f"Share\n{LONG}"),
        (f"<div class='layout has-sidebar'><article><p>{LONG}</p></article></div>", LONG),
        (f"<div class='page-header'><main><p>{LONG}</p></main></div>", LONG),
        (f"<body><div class='comments-open post'><h1>T</h1><p>{LONG}</p></div><div class=comments><p>{LONG[:90]}</p></div></body>", f"T\n{LONG}"),
        (f"<body><div class=header><h1>T</h1><p>{LONG}</p></div><div class=footer>f</div></body>", f"T\n{LONG}"),
        (f"<article><select><option>A<p>{LONG}</p></article>", f"A\n{LONG}"),
        (f"<article><select><option>A</select><p>{LONG}</p></article>", LONG),
        *((f"<article><{tag}><p>{LONG}</p></article>", LONG) for tag in ("video", "audio", "object", "canvas", "svg")),
        (f"<article><svg><text>no</text></svg><p>{LONG}</p></article>", LONG),
        ("<article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p></article>", "So x=2 holds"),
        ("<article><div class=ads><p>buy</p></div><p>Text</p><div id=sidebar>s</div></article>", "Text"),
        (
            f"<body><ul><li><a href=/>Home</a><li><a href=/b>About</a></ul><div><h1>Head</h1><p>{LONG}</p><ul><li>one</li><li>two</li></ul>"
            f"<section><h2>Sub</h2><p>{LONG}</p></section></div><div>© 2020 Corp</div></body>",
            f"Head\n{LONG}\none\ntwo\nSub\n{LONG}",
        ),
    ],
)
def test_pages_with_odd_marks_keep_their_text(page, text):
    assert html_extract.main_text(page) == text


class Visible(HTMLParser):
    """Another reading of a well-formed page: the words outside of what is never text."""

    def __init__(self):
        super().__init__()
        self.out, self.skip, self.words = [], 0, Counter()

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "head", "title")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "head", "title")

    def handle_data(self, data):
        if not self.skip:
            self.words.update(data.split())


def test_blocks_hold_what_another_parser_reads():
    pages_ = duckdb.sql("SELECT html FROM '/root/testdata/sf0.001/pages.parquet' WHERE html IS NOT NULL").fetchall()
    for (page,) in pages_:
        other = Visible()
        other.feed(page)
        other.close()
        blocks = html_extract.blocks_of(page)
        assert Counter(w for b in blocks for w in b.text.split()).keys() <= other.words.keys()
        kept = html_extract.main_text(page).split("\n")
        article = page[page.find("<article") : page.find("</article>")] or page
        for line in kept:
            assert all(w in html.unescape(article) for w in line.split())


def test_the_side_of_each_block_has_the_least_cost():
    rng = random.Random(7)
    for _ in range(25):
        parts = [rng.choice([f"<p>{LONG[: rng.randrange(1, 200)]}</p>", "<div class=ads>x y</div>", "<a href=q>link text</a>", "<h2>Head</h2>"]) for _ in range(6)]
        blocks = html_extract.blocks_of("<body><div>" + "".join(parts[:4]) + "</div>" + "".join(parts[4:]))
        side = html_extract.content_of(blocks)

        def cost(chosen):
            total = sum(abs(html_extract.evidence_of(b)) for b, c in zip(blocks, chosen, strict=True) if (html_extract.evidence_of(b) > 0) != c)
            total += html_extract.NEIGHBOURS * sum(a != b for a, b in itertools.pairwise(chosen))
            for k in {b.container for b in blocks}:
                inside = [c for b, c in zip(blocks, chosen, strict=True) if b.container == k]
                total += html_extract.SAME_CONTAINER * min(inside.count(True), inside.count(False))
            return total

        assert cost(side) == pytest.approx(min(map(cost, itertools.product([False, True], repeat=len(blocks)))))


def test_deep_pages_take_time_in_proportion():
    page = "".join(f"<div class=c{i}>t{i}" for i in range(30_000))
    assert len(html_extract.blocks_of(page)) == 30_000


def test_long_page_is_whole():
    paragraphs = [f"Paragraph {i} with some words." for i in range(5000)]
    page = "<nav>x</nav><article>" + "".join(f"<p>{p}" for p in paragraphs) + "</article><div class=ads>" * 2000
    assert html_extract.main_text(page).split("\n") == paragraphs


def test_min_cut_is_minimal():
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randrange(1, 8)
        terminal = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.6]

        def cost(side):
            cut = sum(t for t, s in zip(terminal, side, strict=True) if t > 0 and not s) - sum(t for t, s in zip(terminal, side, strict=True) if t < 0 and s)
            return cut + sum(c for a, b, c in edges if side[a] != side[b])

        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert cost(html_extract.min_cut(terminal, edges)) == pytest.approx(best)


def test_extracted_rows(spark):
    rows = [(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (None, None, None, None)]
    found = html_extract.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert [(r["page_id"], r["n_chars"], len(r["text"])) for r in found][2] == (None, 0, 0)
    assert found[0] == found[1] and found[0]["n_chars"] == len(html_extract.main_text(PAGE))
    assert html_extract.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


HTML = [
    (3, "http://a.b/x", "same"), (2, "http://a.b/y#f", "same"), (9, "http://a.b/y", "same"), (4, None, None), (5, "no scheme", ""),
    (6, "http://c.a.b/?q\r\nz", "body\r\n\r\nWARC/1.1\r\n\r\n"), (7, "http://É.b/", "é" * 100_000), (8, "http://a.b/y", "other\n"), (8, "http://a.b/y", "other\n"),
    (None, "http://a.b/y", "lone"), (None, "http://a.b/y", "same"),
]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "d", 1) for r in rows], "page_id long, url string, html string, digest string, bytes int")


def expected_records():
    groups = {}
    for i, _, h in HTML:
        groups.setdefault(h or "", []).append(i)
    out = []
    for i, _, h in HTML:
        raw, ids = (h or "").encode(), [x for x in groups[h or ""] if x is not None]
        first = min(ids) if ids else None
        again = len(groups[h or ""]) > 1 and first is not None and i != first
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((i, len(raw), digest, "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_archives_round_trip(spark):
    rows = warc.archived(spark, pages(spark, HTML)).collect()
    found = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows]
    assert sorted(found, key=str) == expected_records()
    payloads = {r["page_id"]: bytes(r["payload"]) for r in rows if r["record_type"] == "response" and r["page_id"] in (6, 7)}
    assert payloads == {6: HTML[5][2].encode(), 7: HTML[6][2].encode()}


SPACED = ["http://a/b ", "http://b/b\t", " http://c/b", "\x0bhttp://d/?q\x0c", "http://e ", "http://f/?q ", " ", "\r\n \n"]
TRIMMED = ["http://a/b", "http://b/b", "http://e", "", "\t \x0b\x0c", None]


@pytest.mark.parametrize("urls", [SPACED, SPACED + TRIMMED])
def test_white_space_at_the_ends_of_urls_loses_no_page(spark, urls):
    rows = warc.archived(spark, pages(spark, [(i, u, f"text {i}") for i, u in enumerate(urls)])).collect()
    found = {r["page_id"]: (r["url"], bytes(r["payload"])) for r in rows}
    whole = [u and u.replace("\r", "%0D").replace("\n", "%0A") for u in urls]
    assert len(rows) == len(urls) and found == {i: (u, b"text %d" % i) for i, u in enumerate(whole)}


def test_index_finds_all_captures_across_blocks_and_parts(spark):
    many = [(i, f"http://host{i % 7}.org/p", f"text {i}") for i in range(120)]
    folder = scratch_dir(spark, "warc-test")
    warc.write_archives(pages(spark, many), folder, per_file=11)
    index = warc.build_index(warc.captures(spark, folder), per_part=25, lines_per_block=4)
    assert index.count() >= 30 and index.select("part").distinct().count() >= 4
    keys = spark.createDataFrame([("org,host3)/p",), ("org,host99)/p",), ("zzz",), ("",)], "key string")
    rows = warc.read_records(warc.lookup(index, keys), 3).collect()
    assert sorted(r["page_id"] for r in rows) == [i for i in range(120) if i % 7 == 3]


def test_small_payloads_are_all_responses_and_no_pages(spark):
    folder = scratch_dir(spark, "warc-test")
    warc.write_archives(pages(spark, [(1, "http://a/", "ab"), (2, "http://a/", "ab")]), folder, least_bytes=3)
    text = "".join(r["value"] for r in spark.read.text(folder, wholetext=True).collect())
    assert text.count("WARC-Type: response") == 2 and "revisit" not in text
    assert warc.archived(spark, pages(spark, [])).count() == 0


def test_keys(spark):
    cases = [("http://WWW.Example.org/a?b#c", "org,example,www)/a?b"), ("x", "x"), (None, "-")]
    rows = spark.createDataFrame([(u,) for u, _ in cases], "url string").select(warc.key_of(F.col("url"))).collect()
    assert [r[0] for r in rows] == [k for _, k in cases]
