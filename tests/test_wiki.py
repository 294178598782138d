"""Wiki markup: written-out cases, and balanced markup against a recursive restatement."""

import time

import pytest
from hypothesis import given
from hypothesis import strategies as st

from corpusmill.functions.wiki import strip_wiki

CASES = [
    (None, None),
    ("", ""),
    ("a {{x|{{y}}|z}} b {| t {| u |} v |} c", "a  b  c"),
    ("{{a|{{b|{{c}}}}}} h", "h"),
    ("[[A|b]] [[c]] [[a|b|c]] a | b", "b c c a | b"),
    ("[[File:x.jpg|thumb|see [[d|e]] {{q|}} f]]g[[ image:y]] [[Category:Z]]", "g"),
    ("[[a|[[b|c]] d]] [[{{x}}|t]]", "c d t"),
    ("{{open [[x]] y", "{{open x y"),
    ("}} z ]] |} w", "}} z ]] |} w"),
    ("[[a {{b]] c}} d", "a {{b c}} d"),
    ("{|\n|-\n| {{x|}} |}\nq", "q"),
    ("<!-- c {{ --> d <ref name=a>n {{x}}</ref>e<ref name=b/> f <!-- open", "d e f <!-- open"),
    ("<nowiki>{{x}} [[y]]</nowiki> <nowiki/>z", "{{x}} [[y]] z"),
    ("== H ==\n=== K ===\n'''b''' ''i'' [http://a.b c d] <br/> <b>x</b>", "H\nK\nb i c d  x"),
]


@pytest.mark.parametrize("raw, want", CASES)
def test_cases(raw, want):
    assert strip_wiki(raw) == want


plain = st.text("ab c.", max_size=6)
node = st.recursive(
    st.tuples(st.just("t"), plain),
    lambda inner: st.tuples(st.sampled_from(["{{", "{|", "[["]), st.lists(st.lists(inner, max_size=3), min_size=1, max_size=3)),
    max_leaves=25,
)


def written(n):
    if n[0] == "t":
        return n[1]
    return n[0] + "|".join(" " + "".join(map(written, part)) for part in n[1]) + " " + {"{{": "}}", "{|": "|}", "[[": "]]"}[n[0]]


def shown(n):
    if n[0] != "[[":
        return n[1] if n[0] == "t" else ""
    return " " + "".join(map(shown, n[1][-1])) + " "


@given(st.lists(node, max_size=5))
def test_balanced_markup(nodes):
    assert strip_wiki("x" + "".join(map(written, nodes)) + "x") == "x" + "".join(map(shown, nodes)) + "x"


@pytest.mark.parametrize("part", ["{{", "[[", "<!--", "<ref ", "}}", "{{a}}", "[[a|", "=", "'", "[", "[http://a ", "<", "== a ", "|"])
def test_linear(part):
    start = time.process_time()
    strip_wiki(part * 100_000 + ("]]" * 100_000 if part == "[[a|" else ""))
    assert time.process_time() - start < 3
