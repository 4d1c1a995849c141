import html
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from llm import cases
from pricebasket.llm import html_text as H

PAGES = "page_id long, url string, html string"


def pages(spark, data):
    return spark.createDataFrame(data, PAGES)


def brute(data, run=H.RUN):
    """(page_id, url, text, n_chars, n_covered) with a dictionary of every run of every host."""
    read = {r: H.blocks(r[2]) for r in set(data)}
    holders = defaultdict(set)
    streams = {}
    for r, found in read.items():
        streams[r] = [w for kind, t in found if kind != "main" for w in t.split(" ")]
        content = tuple(t for _, t in found)
        for i in range(len(streams[r]) - run + 1):
            holders[H.host_of(r[1]), tuple(streams[r][i:i + run])].add(content)
    out = []
    for r in data:
        words = streams[r]
        hit = [False] * len(words)
        for i in range(len(words) - run + 1):
            if len(holders[H.host_of(r[1]), tuple(words[i:i + run])]) > 1:
                hit[i:i + run] = [True] * run
        text, at = [], 0
        for kind, t in read[r]:
            if kind == "main":
                text += t.split(" ")
                continue
            n = len(t.split(" "))
            if kind == "open":
                text += [w for w, gone in zip(words[at:at + n], hit[at:at + n], strict=True) if not gone]
            at += n
        s = " ".join(text)
        out.append((r[0], r[1], s, len(s), sum(hit)))
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2]))


def site(seed=1, n=60):
    """Pages of three hosts, one of them hot, without any element that says what is what."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    furniture = {h: [" ".join(rng.choices(words, k=rng.randint(9, 30))) for _ in range(3)] for h in "abc"}
    out = []
    for i in range(n):
        h = rng.choice("aaaab c".replace(" ", ""))
        own = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(rng.randint(0, 4))]
        parts = [rng.choice(furniture[h]), *own, rng.choice(furniture[h]), f"page {i}"]
        out.append((i, f"http://{h}.example.org/{i}", "<html><body>" + "".join(f"<div>{p}</div>" for p in parts)))
    return out


HARD = [(900, None, None), (901, "http://a.example.org/x", ""), (902, "", "no markup at all &amp; a &lt;b&gt;"),
        (None, "http://b.example.org", "<p>one<p>two <i>th</i>ree<br>four"), (903, "notaurl", "<div" * 300 + "x<y < z"),
        (904, "http://c.example.org/long", "<main>" + "<p>long text &eacute; &#233;</p>" * 5000), (905, "http://C.example.org:80/", "<!-- <p>no</p>"),
        (906, "http://c.example.org/q", '<p title="a > b\' c">yes</p><p x="unclosed>no</p>')]


@pytest.mark.parametrize("chunk", [40, H.CHUNK_TOKENS])
def test_matches_brute_force(spark, chunk):
    data = [*site(), *HARD]
    data += [data[3], data[3], (77, *data[5][1:])]  # repeated rows, and a copy of a page under another id
    got = H.extract(cases.clashing(pages(spark, data)), chunk_tokens=chunk)
    assert got.columns == ["page_id", "url", "text", "n_chars", "n_covered"]
    assert in_order(got.collect()) == in_order(brute(data))


def test_furniture_goes_and_unique_runs_stay(spark):
    top, foot = "home news sport weather culture travel about us help", "all rights reserved by the paper of record of 1900"
    data = [(i, f"http://x.org/{i}", f"<body><div>{top}</div><p>story{i} only{i} here{i}</p><div>{foot}</div></body>") for i in range(4)]
    data.append((9, "http://y.org/1", data[0][2]))  # the only page of its host: nothing repeats
    got = {r["page_id"]: r for r in H.extract(pages(spark, data)).collect()}
    assert [got[i]["text"] for i in range(4)] == [f"story{i} only{i} here{i}" for i in range(4)]
    assert got[0]["n_covered"] == 19 and got[9]["n_covered"] == 0
    assert got[9]["text"] == f"{top} story0 only0 here0 {foot}"


def test_copies_of_a_page_are_one_page(spark):
    page = "<div>a b c d e f g h i j k</div>"
    data = [(i, "http://x.org/", page) for i in range(5)] + [(7, "http://x.org/other", page)]
    assert {r["text"] for r in H.extract(pages(spark, data)).collect()} == {"a b c d e f g h i j k"}


def test_shared_passages_of_articles_stay(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    data = [(i, f"http://x.org/{i}", f"<article><h1>T{i}</h1><p>{passage}</p></article>") for i in range(6)]
    assert {r["text"] for r in H.extract(pages(spark, data)).collect()} == {f"T{i} {passage}" for i in range(6)}


def test_the_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    data = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    got = H.op11_html_text(spark, sf).collect()
    assert in_order(got) == in_order(brute(data))
    # the pages hold one article each: its text is what is wanted
    for r, (_, _, page) in zip(sorted(got, key=lambda r: r["page_id"]), sorted(data), strict=True):
        article = re.sub(r"</?b>", "", re.search(r"<article>(.*)</article>", page, re.DOTALL)[1])
        assert r["text"] == " ".join(html.unescape(re.sub("<[^>]*>", " ", article)).split())
    assert sum(r["n_covered"] for r in got) > 0


def test_empty_table(spark):
    assert H.extract(pages(spark, [])).collect() == []


@pytest.mark.parametrize(("page", "text"), [
    ("<body><header><h1>Site</h1></header><article><header><h1>T</h1></header><p>x</p><footer>by me</footer></article>", "T x"),
    ("<article><p>a</p><aside>b</aside><div class='share-bar'>c</div><section id=comments><article>d</article></section><p>e</article>", "a e"),
    ("<article>x<form>f<input>g</form>y<p class='ad'>z<p>w</article>", "x y w"),
    ("<main>a<div hidden>b</div><div style='display: none'>c</div>d</main>", "a d"),
    ("<title>t</title><p>a<script>if (a</b>) x('</p>')</script>b<style>p{}</style>", "ab"),
    ("<head><title>t</title><p>a", "a"), ("<article>a<b>b</b>c <i>d</i>\n\t e&nbsp;f</article>", "abc d e f"),
    ("<div role=navigation>n</div><div class='post-header'>h</div><p>a", "a"),
    ("<article><div class='post-header'>h</div><p>&lt;b&gt; &copy; &#x41;&amp;amp;</p></article>", "h <b> © A&amp;"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a b c d"), ("a < b <3 <", "a < b <3 <"), ("a<![CDATA[x]]>b", "ab"),
    ("<nav><ul><li>n</nav><p>a", "a"), ("<article>a</div></article>b", "a b"), ("<body class='no-sidebar'><p>a", "a")])
def test_what_is_text(page, text):
    assert H.without_covered(H.blocks(page), None)[0] == text


def test_suffix_ranks_are_those_of_sorted_suffixes():
    rng = random.Random(3)
    tokens = [" ".join(rng.choices("abc", k=rng.randint(1, 30))) for _ in range(12)]
    s = H.Streams(["h"] * 6 + ["g"] * 6, list(range(12)), tokens)
    for run in (1, 2, 5, 8):
        rank = s.suffix_ranks(run)
        suffixes = [tuple(s.tokens[i:min(i + run, s.ends[s.page[i]])].tolist()) for i in range(len(s.tokens))]
        assert (np.unique(rank, return_inverse=True)[1].tolist()
                == [sorted(set(suffixes)).index(x) for x in suffixes])
