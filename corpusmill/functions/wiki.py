"""Wiki markup to text: one linear scan with a stack of what is open.

Templates ``{{ }}``, tables ``{| |}`` and links ``[[ ]]`` nest in each other to any depth, which
no regular expression follows.  The scan keeps the output so far and, for every opening mark,
the length of the output there: a closing mark cuts the output back to its opening (templates,
tables, links to files and categories) or to the last pipe inside (other links).  A mark that
is never closed stays text, as does a closing mark with nothing open.  Comments, references
and ``nowiki`` are taken out by the same scan.
"""

from __future__ import annotations

import re

# --- fixed values: marks of the wiki syntax --------------------------------------------
OPENING = {"{{": "}}", "{|": "|}", "[[": "]]"}
#: Links to these name spaces show no text.
SILENT_LINKS = ("file:", "image:", "media:", "category:")
# ----------------------------------------------------------------------------------------

_MARK = re.compile(
    r"<!--|<ref\b[^<>]*/>|<ref\b[^<>]*>|</ref\s*>|<nowiki\s*/>|<nowiki>|\{\{|\}\}|\{\||\|\}(?!\})|\[\[|\]\]|\|", re.I
)
_END = {"<!--": "-->", "<nowiki>": "</nowiki>"}
_LINK = re.compile(r"\[https?://[^\s\]]+ ([^\]\[]*)\]")
_EMPHASIS = re.compile(r"'{2,}")
_HEADING = re.compile(r"^=+[ \t]*(.*?)[ \t]*=+[ \t]*$", re.M)
_TAG = re.compile(r"<[^<>]+>")


def _closed(text: str, end: str, found: int, known: dict[str, int]) -> int:
    """First place of ``end`` from ``found`` on (-1: none), looked for once per stretch."""
    at = known.get(end, 0)
    if at >= 0 and at < found:
        at = known[end] = text.find(end, found)
    return at


def _flat(pieces: list) -> list[str]:
    out, stack = [], [iter(pieces)]
    while stack:
        for piece in stack[-1]:
            if isinstance(piece, list):
                stack.append(iter(piece))
                break
            out.append(piece)
        else:
            stack.pop()
    return out


def strip_wiki(text: str | None) -> str | None:
    """The text without markup; ``None`` stays ``None``."""
    if text is None:
        return None
    out: list = []  # pieces, lists of pieces; an index into it is a place in the output
    stack: list[list] = []  # closing mark, place of the opening one, place after the last pipe
    waiting = dict.fromkeys([*OPENING.values(), "</ref>"], 0)  # how many are open
    known: dict[str, int] = {}
    at = 0
    while (mark := _MARK.search(text, at)) is not None:
        out.append(text[at : mark.start()])
        at, kind = mark.end(), mark[0].lower()
        if kind in _END:
            end = _closed(text, _END[kind], at, known)
            if end < 0:
                out.append(mark[0])
                continue
            if kind == "<nowiki>":
                out.append(text[at:end])
            at = end + len(_END[kind])
        elif kind in OPENING or kind.startswith("<ref") and not kind.endswith("/>"):
            close = OPENING.get(kind, "</ref>")
            stack.append([close, len(out), None])
            waiting[close] += 1
            out.append(mark[0])
        elif kind == "|":
            if stack and stack[-1][0] == "]]":
                stack[-1][2] = len(out) + 1
            out.append("|")
        elif kind in waiting or kind.startswith("</ref"):
            close = kind if kind in waiting else "</ref>"
            if not waiting[close]:
                out.append(mark[0])
                continue
            while True:  # what was opened inside and not closed goes with it or stays text
                closing, first, pipe = stack.pop()
                waiting[closing] -= 1
                if closing == close:
                    break
            if close == "]]":
                shown = out[first + 1 if pipe is None else pipe :]
                target = out[first + 1]
                del out[first:]
                if not isinstance(target, str) or not target.lstrip(" :").lower().startswith(SILENT_LINKS):
                    out.append(shown)  # one piece, so that closing a link costs what stands directly in it
            else:
                del out[first:]
        # a reference or nowiki without content leaves nothing
    out.append(text[at:])
    plain = "".join(_flat(out))
    plain = _LINK.sub(r"\1", plain)
    plain = _EMPHASIS.sub("", plain)
    plain = _HEADING.sub(r"\1", plain)
    return _TAG.sub("", plain).strip()
