"""Main text of pages, fill-in-middle and periodic runs, each against a plain version."""

import hashlib
import html
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import catalog, containers, middle, periods

SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Main text


def plain_article(markup):
    """What stands between <article> and </article>, where paragraphs and headings are the only blocks."""
    inner = re.search(r"<article>(.*?)</article>", markup, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
    return "\n".join(t for t in (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks) if t)


def test_pages_against_plain(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = catalog.QUERIES["op11_html_extraction"](spark, SMALL).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, plain_article(pages[r.page_id].html), len(r.text))
        assert r.host_path == "html body article"


FURNITURE = [
    '<nav><a href="/a">All the news of this long day</a> <a href="/b">About this place</a></nav>',
    '<div class="site-header"><a href="/">A site of many words, whose name is long</a></div>',
    '<header><h1>The site</h1><p>Its motto is a sentence of some length, as here.</p></header>',
    '<div id="cookie-notice"><p>We keep cookies to make this site better, please accept them all.</p></div>',
    '<aside class="sidebar"><p>Other things you could read about, if you wanted to.</p></aside>',
    '<form action="/s"><p>Your address, so that we may write to you:</p><input name="q"><button>Send</button></form>',
    '<section class="comments"><article><p>I liked this very much and read it twice, thank you.</p></article></section>',
    '<div class="ad-300"><p>Buy now, only today, and only here, at half the price!</p></div>',
    "<script>var x = '<p>not text</p>';</script><style>p > a { color: red }</style><!-- <p>nor this</p> -->",
    '<footer><p>&copy; 2020 by whoever wrote all of this, all rights reserved.</p></footer>',
    '<div style="display: none"><p>Nobody sees this sentence, so it is not text.</p></div>',
    "<noscript><p>Please turn on what you turned off to see this page.</p></noscript>",
]
SHELLS = ["<article{}>{}</article>", "<main{}>{}</main>", '<div class="post-{n} has-sidebar"{}>{}</div>', "<div{}>{}</div>", "<section{}>{}</section>"]


def made_page(rng, shell, n):
    """A page and its article, which stands in a shell between pieces of furniture; ids and ads differ from page to page."""
    def words(k):
        return " ".join(rng.choice(["stone", "river", "café", "漢字", "x<y", "a & b", "light", "under", "“quoted”", "the", "of"]) for _ in range(k))

    blocks = [words(rng.randrange(2, 6))] + [words(rng.randrange(8, 40)) + "." for _ in range(rng.randrange(2, 8))]
    escaped = [b.replace("&", rng.choice(["&amp;", "&#38;", "&AMP"]) if "& " in b else "&amp;").replace("<", "&lt;") for b in blocks]
    parts = [f"<h1>{escaped[0]}</h1>"]
    for b in escaped[1:]:
        first, rest = b.split(" ", 1)
        parts.append(rng.choice([
            f"<p>{b}</p>", f"<p><b>{first}</b>\n\t{rest}", f"<ul><li>{b}</ul>", f'<div><em>{first}</em>&nbsp;{rest}</div>', f"<table><tr><td>{b}</table>",
            f'<p>{first} <a href="#{n}">{rest}</a> </p>' if len(rest) < 60 else f"<P CLASS=x>{b}", f"<blockquote>{b}</blockquote>",
            f"<p>{b}</p>" + rng.choice(['<div class="share">Share this with all the friends you have</div>', "<aside>Beside it</aside>"])]))
    before, after = rng.sample(FURNITURE, 4), rng.sample(FURNITURE, 4)
    body = shell.replace("{n}", str(n)).format(f' data-n="{n}"', "\n".join(parts))
    page = f"<!DOCTYPE html><html><head><title>{escaped[0]}</title></head><body>{''.join(before)}{body}{''.join(after)}"
    return page + rng.choice(["", "</body></html>"]), "\n".join(" ".join(b.split()) for b in blocks)


def test_made_pages(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for host, shell in enumerate(SHELLS):
        for n in range(40):
            page, want[len(rows)] = made_page(rng, shell, n)
            rows.append((len(rows), f"http://H{host}.example/{n}" if n % 10 else None, page))
    found = {r.page_id: r for r in containers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {i: found[i].text for i in want} == want
    assert sum(r.host_path is not None for r in found.values()) == 36 * len(SHELLS)


def test_consensus_outvotes_a_page(spark):
    """A page whose own best container is wrong is read by the path its host agrees on."""
    prose = "<p>" + "Some words of an article that is long enough to be one. " * 5 + "</p>"
    good = "<body><div class='x{}'><h2>Head</h2>" + prose + "</div><div class='y'><p>Short words beside it.</p></div></body>"
    odd = "<body><div class='x7'><p>Short article here.</p></div><div class='y'>" + prose + "</div></body>"
    rows = [(i, "http://a.b/c", good.format(i)) for i in range(9)] + [(9, "http://a.b/d", odd), (10, "http://lone.b/", odd)]
    found = {r.page_id: r for r in containers.extract(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert found[9].text == "Short article here." and found[9].host_path == "html body div.x#"
    assert found[10].text.startswith("Some words") and all(found[i].text.startswith("Head\nSome") for i in range(9))


def test_light_hosts_are_read_alike(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(n, f"http://h{n % 7}.x/", made_page(rng, SHELLS[n % 5], n)[0]) for n in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    first = sorted(containers.extract(pages).collect())
    monkeypatch.setattr(containers, "HEAVY", 0.01)
    assert sorted(containers.extract(pages).collect()) == first


@pytest.mark.parametrize("markup, text", [
    (None, ""), ("", ""), ("plain", "plain"), ("a < b & c", "a < b & c"), ("<p>x<!-- no end", "x"), ("<p>one<p", "one"), ("</div></p>x<li>y", "x\ny"),
    ("<div>" * 3000 + "deep", "deep"), ("<p>a&nbsp;\n b<br>c</p>", "a b c"), ("<b><p>one</b> two</p>", "one two"), ("<td>x<td>y", "x\ny"),
    ("<p title='>'>q</p>", "q"), ("<SCRIPT>1</SCRIPT>z", "z"), ("&#0;&am &copy", "�&am ©"), ("<nav>only a menu</nav>", ""), ("<title>t</title>", ""),
    ("<p>" + "long " * 100000 + "</p>", ("long " * 100000).strip()),
])
def test_odd_markup(markup, text):
    page = containers.Page(markup or "")
    assert page.text_of([page.best()]) == text


def test_odd_pages(spark):
    schema = "page_id long, url string, html string, text string, host string, path string, paths int"
    rows = [(1, None, None, "t", "h", "p", 1), (None, "http://a/", "<p>x</p>", "t", None, "p", 1), (2, "http://a/", "", "t", "h", "p", 1)] * 2
    pages = spark.createDataFrame(rows, schema)
    got = containers.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars", "host_path"] and got.count() == 6
    assert {(r.page_id, r.text, r.n_chars) for r in got.collect()} == {(1, "", 0), (None, "x", 1), (2, "", 0)}
    assert containers.extract(pages.limit(0)).count() == 0


# Fill-in-middle (the SQL twin runs with the others)


def plain_middle(doc_id, text, signs=("<P>", "<S>", "<M>"), seed=1):
    draw = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(draw[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in signs) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, s, m = signs
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}"
    return n, "psm", a, b - a, f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}"


def test_middle(spark, odd, none):
    texts = ["<", "S>", "<P", "<P>", "a<M>", "\\$1", "$0", "x\r\n\x85y", "🎉" * 1023, "e" * 1024, "\n" * 2049, "é" * 700001]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(texts, 100)), "doc_id long, text string"))
    docs = docs.union(spark.createDataFrame([(1000 + i, f"text {i} <" * (i % 9)) for i in range(200)], "doc_id long, text string"))
    for signs in (middle.SIGNS, ("$1", "\\E[", "(?")):
        rows = middle.fill_in_middle(docs, signs=signs).withColumn("back", middle.restore(F.col("output"), F.col("form"), signs)).collect()
        got = sorted((str(r.doc_id), *map(str, r[1:6])) for r in rows)
        assert got == sorted((str(r.doc_id), *map(str, plain_middle(r.doc_id, r.text or "", signs))) for r in docs.collect())
        assert sorted(r.back for r in rows) == sorted(r.text or "" for r in docs.collect())
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    clash = odd.withColumn("n", F.lit(1)).withColumn("form", F.lit("x")).withColumn("draw", F.lit("d"))
    assert middle.fill_in_middle(clash).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert middle.fill_in_middle(clash).count() == odd.count() and middle.fill_in_middle(none).count() == 0


# Periodic runs


def plain_runs(words):
    """All runs, by trying every lag at every word."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    drop = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join("%d,%d,%d\n" % r for r in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_runs_against_plain(spark, small, odd):
    ids = [r.doc_id for r in small.collect() if r.text and len(r.text) < 6000]
    docs = small.select("doc_id", "text").filter(F.col("doc_id").isin(ids)).union(odd.select("doc_id", "text").filter("length(text) < 9000 or text is null"))
    rows = [tuple(r) for r in periods.collapse_runs(docs, repeated_tails=True).drop("n_words", "n_dropped").collect()]
    assert sorted(map(str, rows)) == sorted(str(plain_row(r.doc_id, r.text)) for r in docs.collect())
    assert sum(r[1] > 0 for r in rows) > 10


def test_runs_of_random_words():
    rng = random.Random(3)
    texts = []
    for _ in range(800):
        kinds = rng.choice([1, 2, 3, 5, 20])
        words = [rng.randrange(kinds) for _ in range(rng.randrange(0, 100))]
        while rng.random() < 0.7:
            unit = [rng.randrange(kinds) for _ in range(rng.randrange(1, 14))]
            at = rng.randrange(len(words) + 1)
            words[at:at] = (unit * 9)[: rng.randrange(1, 9 * len(unit))]
        texts.append(words)
    # All texts are one slice: runs end at the edges of their texts.
    of = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    start, length, period = periods.runs_of(np.array([w + 5 for t in texts for w in t], np.uint64), of)
    begin = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = [(int(of[s]), int(s - begin[of[s]]), int(m), int(q)) for s, m, q in zip(start, length, period)]
    assert found == [(i, *r) for i, t in enumerate(texts) for r in plain_runs(t)]


def test_long_runs():
    def found(words):
        return [tuple(map(int, r)) for r in zip(*periods.runs_of(np.array(words, np.uint64), np.zeros(len(words), np.int64)))]

    assert found([i % 3 for i in range(300000)]) == [(0, 300000, 3)]
    unit = list(range(50000))
    assert found([70000] + unit * 4 + [1]) == [(1, 200000, 50000)]
    assert found(unit * 4 + unit[:-1]) == [(0, 249999, 50000)] and found(unit * 3 + unit[:-1]) == []
    # Words in the order of Thue and Morse never repeat three times; sums of powers modulo 2^64 would not tell.
    assert found([bin(i).count("1") % 2 for i in range(1 << 16)]) == []


def test_runs_operator(spark, odd, none):
    docs = spark.createDataFrame([(1, "a b a b a b a b c", "x"), (2, "z " * 5, "y"), (3, " z" * 6, "y"), (4, None, None)], "doc_id int, text string, runs string")
    rows = {r.doc_id: r for r in periods.collapse_runs(docs, with_text=True).collect()}
    assert [tuple(x) for x in rows[1].runs] == [(0, 8, 2)] and rows[1].collapsed == "a b c" and rows[1].exponent_milli == 4000
    assert rows[2].runs == [] and rows[2].collapsed == "z z z z z" and rows[2].start is None
    assert rows[3].collapsed == "z" and rows[3].n_dropped == 5 and (rows[4].n_words, rows[4].collapsed) == (0, "")
    assert periods.collapse_runs(odd).count() == odd.count() and periods.collapse_runs(none).count() == 0
