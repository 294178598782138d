"""Main text of pages: built pages whose article is known, odd markup, and simple tree
matching against a search over all matchings."""

import html as H
import random
import re
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import markup, queries, wrappers

SCHEMA = "page_id bigint, url string, html string, text string, kind string"


def texts(page):
    return [t for _, t in markup.parse(page)[1]]


@pytest.mark.parametrize(
    "page, want",
    [
        ("", []),
        ("plain &amp; simple", ["plain & simple"]),
        ("<p>a<p>b<br>c</p>d", ["a", "b c", "d"]),
        ("<p><b>a.<br><p>b</b> c", ["a.", "b c"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]),
        ("x<!-- <p>no</p> -->y<!-- open", ["xy"]),
        ("<script>var a='</p><p>';</script>a<style>p{}</style>b<script>open", ["ab"]),
        ("a <i title='x > y'>b</i> <a href=it's>c</a> d's", ["a b c d's"]),
        ("1 < 2 &lt; 3 &copy &notit; &#8364;&#x41;", ["1 < 2 < 3 © ¬it; €A"]),
        ("<P CLASS=x>A</P\n><DIV>b\n\t c", ["A", "b c"]),
        ("</p></div>a</article>b", ["ab"]),
        ("a<p", ["a"]),
        ("<?php x ?>a<![CDATA[b]]>c", ["ac"]),
        ('<p title="open>a</p>b', ["a", "b"]),
    ],
)
def test_markup(page, want):
    assert texts(page) == want


def test_deep_and_long_pages():
    assert texts("<div>" * 5000 + "a<p>b") == ["a", "b"]
    root, blocks = markup.parse("<article>" + "<h2>t</h2><p>x</p><div><p>y</p></div>" * 3000)
    markup.fold(root)
    assert len(blocks) == 9000 and len(markup.number(root)) < 4 * 3002
    root, blocks = markup.parse("<div>" + "<div><p>y</p></div>" * 3000)
    markup.fold(root)
    assert len(markup.number(root)) == 4 and {n.final().number for n, _ in blocks} == {3}


def tree(rng, depth):
    node = markup.Node(rng.choice("ab"))
    for _ in range(rng.randrange(4) if depth else 0):
        child = tree(rng, depth - 1)
        child.parent = node
        node.children.append(child)
    return node


def largest(a, b):
    """Nodes of the largest matching, by trying all."""
    if a.label != b.label:
        return 0

    @lru_cache(None)
    def rest(i, j):
        if i == len(a.children) or j == len(b.children):
            return 0
        both = largest(a.children[i], b.children[j])
        return max(rest(i + 1, j), rest(i, j + 1), both + rest(i + 1, j + 1) if both else 0)

    return 1 + rest(0, 0)


@given(st.integers(0, 10**6))
@settings(max_examples=200, deadline=None)
def test_simple_tree_matching(seed):
    rng = random.Random(seed)
    a, b = tree(rng, 3), tree(rng, 3)
    b.label = a.label
    assert markup.size(a, b) == largest(a, b)
    again = markup.unpacked(markup.packed(a))
    assert markup.packed(again) == markup.packed(a)
    both = 1 + sum(markup.size(a.children[i], b.children[j]) for i, j in markup.align(a.children, b.children))
    if len(a.children) != len(b.children):
        assert both == largest(a, b)
    whole = markup.unpacked(markup.packed(a))
    markup.merge(whole, b)
    assert markup.size(whole, a) == len(markup.number(a))


def site(n, seed=1, same=()):
    """Pages of one layout, with their articles."""
    rng = random.Random(seed)
    words = [a + b for a in "bcdf" for b in ("ara", "olo", "unu")]
    say = lambda k: " ".join(rng.choice(words) for _ in range(k)) + "."
    out = []
    for k in range(n):
        blocks = [say(4)] + [say(rng.randrange(5, 60)) for _ in range(rng.randrange(1, 9))] + list(same)
        article = f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{b} &amp; more" if i % 2 else f"<p>{b} &amp; more</p>" for i, b in enumerate(blocks[1:]))
        out.append(([blocks[0], *(f"{b} & more" for b in blocks[1:])], article, say))
    return out


def semantic(article, say):
    return (
        f"<html><head><title>{say(3)}</title></head><body><header><h2>My site</h2></header><nav><ul><li>{say(1)}<li>{say(1)}</ul></nav>"
        f"<div class='cookie-notice'>{say(6)}</div><main><article class=post-{len(article)}>{article}"
        f"<div class='share buttons'>{say(2)}</div></article><section id=comments><article class=comment><p>{say(400)}</p></article>"
        f"</section><form><p>{say(3)}</p></form></main><aside>{say(30)}</aside><footer>&copy; {say(5)}</footer></body></html>"
    )


def nested(article, say):
    """Comments and related pages are articles too, the wrapper's class mentions a sidebar."""
    return (
        f"<body class='has-sidebar'><div class='content-sidebar-wrap'><div id=main-content><article><header><h1 hidden-x>"
        f"{article.partition('<h1>')[2]}<section class=comments><h2>{say(2)}</h2><article><p>{say(300)}</article><article>"
        f"<p>{say(300)}</article></section></article></div><div class='related-posts'><article><p>{say(200)}</article></div>"
        f"<div class=sidebar-right><p>{say(50)}</div></div><div id=cookie-consent role=dialog><p>{say(9)}</div></body>"
    )


def bare(article, say):
    """No word says what anything is: constants and the region decide."""
    return (
        f"<body><div><div>Welcome to this place, all of you out there</div><div><p>Read more of it</p><p>Write to us</p></div></div>"
        f"<div class=x><div class=y>{article}<p>You have read a text of ours</p></div><div class=z>All rights are ours</div></div>"
        f"<div class=w><p>{say(3)}</p></div></body>"
    )


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return df, wrappers.extract_main_text(df)


@pytest.mark.parametrize("layout", [semantic, nested, bare])
def test_articles_of_a_site(spark, layout, monkeypatch):
    monkeypatch.setattr(wrappers, "FAN", 2)
    pages = site(40)
    rows = [(k, f"https://Site.example/{k}", layout(a, say), "clash", "k") for k, (_, a, say) in enumerate(pages)]
    rows += [(100 + k, f"http://u@other{k}.example:80/", semantic(a, say), None, None) for k, (_, a, say) in enumerate(site(5, 2))]
    df, found = run(spark, rows)
    assert sorted(found.columns) == ["kind", "page_id", "text", "url"]
    got = {r.page_id: r.text for r in found.collect()}
    for k, (blocks, _, _) in enumerate(pages):
        assert got[k] == "\n\n".join(blocks)
    for k, (blocks, _, _) in enumerate(site(5, 2)):  # hosts of one page
        assert got[100 + k] == "\n\n".join(blocks)


def test_copies_and_shared_passages_stay(spark):
    """Pages that share an article, or most of it, are no template."""
    (blocks, article, say), *_ = site(1, 3)
    rows = [(k, "//copies.example", semantic(article, say), "", "") for k in range(6)]
    near = [article + f"<p>{say(4)}</p>" for _ in range(6)]
    rows += [(10 + k, "//near.example", semantic(a, say), "", "") for k, a in enumerate(near)]
    got = {r.page_id: r.text for r in run(spark, rows)[1].collect()}
    assert all(got[k] == "\n\n".join(blocks) for k in range(6))
    assert all(got[10 + k].startswith("\n\n".join(blocks)) and len(got[10 + k]) > len(got[0]) for k in range(6))


def test_odd_rows(spark):
    rows = [
        (1, None, None, None, None),
        (2, "no url", "", "x", "y"),
        (None, "https://a.example/1", "<p>one</p>", None, None),
        (3, "https://a.example/1", "<p>one</p>", None, None),
        (3, "https://a.example/1", "<p>one</p>", None, None),
        (4, "", "<script>x</script><!-- -->", None, None),
        (5, "https://b.example", "<div>" * 3000 + "deep", None, None),
        (6, "https://c.example", "<p>" + "long " * 100_000 + "</p>" + "<p>t</p>" * 2000, None, None),
    ]
    got = sorted(((r.page_id or 0), r.text) for r in run(spark, rows)[1].collect())
    assert [t for _, t in got[:7]] == ["one", "", "", "one", "one", "", "deep"]
    assert got[7][1] == ("long " * 100_000).strip() + "\n\nt" * 2000
    assert run(spark, [])[1].count() == 0


def test_query_equals_the_articles(spark):
    folder = "/root/testdata/sf0.001"
    got = {r.page_id: r for r in queries.op13_html_extraction(spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(pages) == len(got)
    for r in pages:
        article = re.search("<article>(.*)</article>", r.html, re.S)[1]
        parts = [" ".join(re.sub("<[^>]*>", " ", x).split()) for x in re.split("</?(?:p|h1)>", article)]
        want = "\n\n".join(H.unescape(p) for p in parts if p)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


def test_hot_host_is_spread(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "SALTS", 3)
    rows = [(k, "//hot.example", semantic(a, say), "", "") for k, (_, a, say) in enumerate(site(30, 4))]
    rows += [(100 + k, f"//cold{k}.example", semantic(a, say), "", "") for k, (_, a, say) in enumerate(site(10, 5))]
    got = {r.page_id: r.text for r in run(spark, rows)[1].collect()}
    for k, (blocks, _, _) in enumerate(site(30, 4)):
        assert got[k] == "\n\n".join(blocks)
