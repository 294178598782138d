"""Tool-call traces by the batch: RESULT lines after CALL lines, and the audit of stored ones.

The calls of a batch of texts are found as places in its bytes; the calculator's arguments of
all of them are evaluated together (``calculator.evaluate_column``), then the texts between
calls and the results are pieces that Arrow copies once.  The scratchpad is a state of its
text: every call shows the last notes of that text.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from corpusmill.functions.calculator import evaluate_column, string_bytes, string_column

# --- fixed values (must equal the reference's rules) --------------------------------
# A tool call line: CALL <name>: "<argument>"  (name: letters, digits, _ and -).
CALL_HEAD = re.compile(r"CALL\s+([a-zA-Z0-9_\-]+):\s*")
CALL_MARK = "CALL"
RESULT_PREFIX = "RESULT: "
RESULT_MARK = "RESULT:"
SCRATCHPAD_LINES = 8
DEFAULT_NOTE_LABEL = "note"
UNKNOWN_TOOL = "ERROR:UNKNOWN_TOOL"
CALCULATOR, SCRATCHPAD = "calculator", "scratchpad"
# -------------------------------------------------------------------------------------


def note_of(argument: str) -> str:
    """``label: content``; without content the argument is the content of a plain note."""
    label, _, content = argument.partition(":")
    if not content:
        label, content = DEFAULT_NOTE_LABEL, label
    return f"{label.strip()}: {content.strip()}"


#: What ``str.strip`` takes away, and ``str.splitlines`` cuts at.
SPACES = "".join(chr(k) for k in range(0x3001) if chr(k).isspace())
OTHER_BREAKS = r"\r\n|[\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
_BREAK, _BLANK, _QUOTE, _COLON = b'\n ":'
#: Bytes that may be a space or a part of one.
_EDGE = np.array([k >= 128 or chr(k).isspace() for k in range(256)])
_BETWEEN = np.frombuffer(b": ", np.uint8)
_UNKNOWN = np.frombuffer(UNKNOWN_TOOL.encode(), np.uint8)
_MARK = f"\n{RESULT_PREFIX}".encode()
#: What is before the content of a note: a line break, or the label of a plain note too.
_BARE_FIXED = [b"\n", f"\n{DEFAULT_NOTE_LABEL}: ".encode()]
_BARE = [len(x) for x in _BARE_FIXED]
#: Texts of more bytes are handled in halves; places in them are 32 bits wide.
BYTES_AT_ONCE = 1 << 26


def _flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Elements of a list column without nulls, and where each list begins."""
    bounds = lists.offsets.to_numpy().astype(np.int64)
    return lists.values.slice(bounds[0], bounds[-1] - bounds[0]), bounds - bounds[0]


def _joined(pool: pa.Array, pieces: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Per text its pieces of the pool, a line each."""
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pool.take(pa.array(pieces)))
    return pc.binary_join(lists, pa.scalar("\n", pa.large_string()))


def _windows(buffer: np.ndarray) -> np.ndarray:
    """The twelve bytes from every place on."""
    return np.ndarray(len(buffer) + 1, "V12", np.concatenate([buffer, np.zeros(12, np.uint8)]), strides=(1,))


def _views(source: int, buffer: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Arrow's views of pieces of a buffer, which is the source of that number: a size, then the
    bytes of a short piece, or the source and the place of a longer one."""
    views = np.empty((len(size), 4), np.int32)
    views[:, 0], views[:, 1], views[:, 2], views[:, 3] = size, 0, source, begin
    views = views.view([("size", "<i4"), ("short", "V12")]).ravel()
    short = np.flatnonzero(size <= 12)
    if len(short):
        views["short"][short] = _windows(buffer)[begin[short]]
    return views.view("V16")


def _short_views(values: Sequence[bytes]) -> np.ndarray:
    """Views of values of up to twelve bytes."""
    return np.concatenate([_views(0, np.frombuffer(x, np.uint8), np.zeros(1, np.int64), np.array([len(x)])) for x in values])


_BARE_VIEWS = _short_views(_BARE_FIXED)
_MARK_VIEW = _short_views([_MARK])
_UNKNOWN_VIEW = _views(1, _UNKNOWN, np.zeros(1, np.int64), np.array([len(_UNKNOWN)]))


def _copied(views: np.ndarray, *sources: np.ndarray) -> np.ndarray:
    """The bytes of pieces, one after another."""
    buffers = [None, *(pa.py_buffer(np.ascontiguousarray(x)) for x in (views, *sources))]
    out = pa.Array.from_buffers(pa.binary_view(), views.size, buffers).cast(pa.large_binary())
    return string_bytes(out)[0]


def _ends(size: np.ndarray) -> np.ndarray:
    """Where pieces of these sizes begin, one after another, and the end."""
    return np.concatenate([[0], np.cumsum(size, dtype=np.int64)])


def _ranges(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """Ranges of bytes as strings."""
    return string_column(_copied(_views(0, data, begin, end - begin), data), _ends(end - begin))


def _sizes(strings: pa.Array) -> np.ndarray:
    return pc.binary_length(strings).to_numpy(zero_copy_only=False)


def _trimmed(data: np.ndarray, begin: np.ndarray, end: np.ndarray, left: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Ranges without the spaces around (``left`` false: after) them.  A byte that is no space
    and not of a longer character ends the search; what else there is, Arrow trims."""
    begin, end = begin.copy(), end.copy()
    if left:  # mostly one blank
        at = np.flatnonzero(begin < end)
        begin[at] += data[begin[at]] == _BLANK
    at = np.flatnonzero(begin < end)
    last = _EDGE[data[end[at] - 1]]
    at = at[last | _EDGE[data[begin[at]]] if left else last]
    if len(at):
        text = _ranges(data, begin[at], end[at])
        if left:
            text = pc.utf8_ltrim(text, SPACES)
            begin[at] = end[at] - _sizes(text)
        end[at] = begin[at] + _sizes(pc.utf8_rtrim(text, SPACES))
    return begin, end


def _calls(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the lines that are calls: end, the tool (0 another, 1 the calculator, 2 the scratchpad),
    where the argument begins and ends, and the first colon in it (else its end); and how many
    calls there are up to the end of each text.

    Line breaks, quotes and colons are found in one pass.  A call's first two are the colon and
    the quote that end its head; the last byte that is no space is the quote after the argument."""
    marks = np.flatnonzero((data == _BREAK) | (data == _QUOTE) | (data == _COLON))
    kinds = np.append(data[marks], [0, 0, 0])
    marks = np.append(marks, [len(data)] * 3)
    # lines after a break, then texts that begin after none; their first mark and the break after them
    breaks = np.flatnonzero(kinds == _BREAK)
    begin, first, until = marks[breaks] + 1, breaks + 1, np.append(marks[breaks[1:]], len(data))[: len(breaks)]
    starts = np.unique(bounds[:-1])
    starts = starts[(starts < len(data)) & ((starts == 0) | (data[starts - 1] != _BREAK))]
    full = _is_call(data, begin, until, kinds, first)
    begin, first, until = begin[full], first[full], until[full]
    if len(starts):
        at = np.searchsorted(marks, starts)
        line_end = np.append(marks[breaks], len(data))[np.searchsorted(breaks, at)]
        full = _is_call(data, starts, line_end, kinds, at)
        if len(full):
            begin, first, until = (np.concatenate([x, y[full]]) for x, y in ((begin, starts), (first, at), (until, line_end)))
            order = np.argsort(begin, kind="stable")
            begin, first, until = begin[order], first[order], until[order]
    # the last line of a text may have no break
    end = np.minimum(until, np.repeat(bounds[1:], np.diff(np.searchsorted(begin, bounds))))
    last = _trimmed(data, begin, end, left=False)[1] - 1
    quote = marks[first + 1]
    full = np.flatnonzero((data[last] == _QUOTE) & (quote < last))
    begin, end, first, quote, last = begin[full], end[full], first[full], quote[full], last[full]
    heads = _ranges(data, begin, quote).dictionary_encode()
    tools = []
    for h in heads.dictionary.to_pylist():
        call = CALL_HEAD.fullmatch(h)
        tools.append(-1 if call is None else {CALCULATOR: 1, SCRATCHPAD: 2}.get(call[1].lower(), 0))
    tool = np.array(tools, np.int64)[heads.indices.to_numpy(zero_copy_only=False)]
    calls = np.flatnonzero(tool >= 0)
    end, first, quote, last = end[calls], first[calls], quote[calls], last[calls]
    colon = np.where(kinds[first + 2] == _COLON, np.minimum(marks[first + 2], last), last)
    inner = np.flatnonzero((kinds[first + 2] == _QUOTE) & (marks[first + 2] < last))
    if len(inner):  # a quote before the first colon
        colons = np.append(marks[kinds == _COLON], len(data))
        colon[inner] = np.minimum(colons[np.searchsorted(colons, quote[inner])], last[inner])
    return end, tool[calls], quote + 1, last, colon, np.searchsorted(end, bounds[1:], side="right")


def _is_call(data: np.ndarray, begin: np.ndarray, end: np.ndarray, kinds: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Lines that begin as a call does and whose first marks are a colon and a quote."""
    on = np.flatnonzero((kinds[first] == _COLON) & (kinds[first + 1] == _QUOTE))
    on = on[end[on] - begin[on] >= len(CALL_MARK)]
    for k, c in enumerate(CALL_MARK.encode()):
        on = on[data[begin[on] + k] == c]
    return on


def _notes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, colon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``note_of`` for ranges of bytes: the notes, a line break before each, and where they begin."""
    named = colon + 1 < end
    label, label_end = _trimmed(data, begin, colon)
    content, content_end = _trimmed(data, np.where(named, colon + 1, end), end)
    # a label, a colon, a blank and the content are copied at once
    whole = named & (label_end == colon) & (content == colon + 2) & (content < content_end)
    whole &= data[np.minimum(colon + 1, len(data) - 1)] == _BLANK
    size = np.where(named, _BARE[0], _BARE[1]) + np.where(whole, content_end, label_end) - label
    views = [_BARE_VIEWS[(~named).astype(np.int64)], _views(0, data, label, np.where(whole, content_end, label_end) - label)]
    halves = named & ~whole
    if halves.any():
        between, content_size = np.where(halves, 2, 0), np.where(halves, content_end - content, 0)
        views += [_views(1, _BETWEEN, np.zeros_like(content), between), _views(0, data, content, content_size)]
        size += between + content_size
    return _copied(np.stack(views, 1), data, _BETWEEN), _ends(size)


def inject(texts: pa.Array) -> pa.Array:
    """Every text with a RESULT line after each CALL line.  Lines end at ``\\n`` only, a final
    line break is not kept, null stays null.

    A text is copied from call to call; its scratchpad's notes lie one after another, so that
    what a call shows is one piece of them."""
    texts = texts.cast(pa.large_string())
    if texts.nbytes > BYTES_AT_ONCE and len(texts) > 1:
        half = len(texts) // 2
        return pa.concat_arrays([inject(texts[:half]), inject(texts[half:])])
    data, bounds = string_bytes(pc.fill_null(texts, ""))
    if not len(data):
        return texts
    end, kind, argument, argument_end, colon, calls_to = _calls(data, bounds)
    text_of = np.repeat(np.arange(len(texts)), np.diff(calls_to, prepend=0))
    sums, pads = np.flatnonzero(kind == 1), np.flatnonzero(kind == 2)
    answers, answer = evaluate_column(_ranges(data, argument[sums], argument_end[sums]))
    answers, answer_bounds = string_bytes(answers)
    notes, note_bounds = _notes(data, argument[pads], argument_end[pads], colon[pads])
    # a call shows as many notes of its text as there are, up to the limit
    number = np.arange(len(pads))
    pads_before = _ends(kind == 2)[np.append(0, calls_to)]
    shown = np.maximum(pads_before[text_of[pads]], number - SCRATCHPAD_LINES + 1)
    begin = np.maximum(np.append(0, end[:-1])[: len(kind)], bounds[text_of])
    until = bounds[1:].copy()
    filled = np.flatnonzero(bounds[:-1] < until)
    until[filled] -= data[until[filled] - 1] == _BREAK
    rest = bounds[:-1].copy()
    some = np.flatnonzero(np.diff(calls_to, prepend=0))
    rest[some] = end[calls_to[some] - 1]
    # three pieces a call: the text up to it, the mark, the result; then what is left of the text
    at, last = 3 * np.arange(len(kind)) + text_of, 3 * calls_to + np.arange(len(texts))
    views, size = np.empty(3 * len(kind) + len(texts), "V16"), np.full(len(kind), len(UNKNOWN_TOOL))
    views[at], views[at + 1], views[at + 2] = _views(0, data, begin, end - begin), _MARK_VIEW, _UNKNOWN_VIEW
    views[last] = _views(0, data, rest, until - rest)
    size[sums] = answer_bounds[answer + 1] - answer_bounds[answer]
    views[at[sums] + 2] = _views(2, answers, answer_bounds[answer], size[sums])
    size[pads] = note_bounds[number + 1] - note_bounds[shown] - 1
    views[at[pads] + 2] = _views(3, notes, note_bounds[shown] + 1, size[pads])
    sizes = _ends(end - begin + len(_MARK) + size)[calls_to] + np.cumsum(until - rest)
    out = string_column(_copied(views, data, _UNKNOWN, answers, notes), np.append(0, sizes))
    return pc.if_else(texts.is_valid(), out, pa.scalar(None, pa.large_string())) if texts.null_count else out


def inject_texts(texts: Sequence[str | None]) -> list[str | None]:
    """``inject`` for a list."""
    return inject(pa.array(texts, pa.large_string())).to_pylist()


def _lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``str.splitlines`` of texts without nulls, a last empty line included."""
    other = pc.match_substring_regex(texts, OTHER_BREAKS)
    if pc.any(other).as_py():
        texts = pc.replace_with_mask(texts, other, pc.replace_substring_regex(texts.filter(other), OTHER_BREAKS, "\n"))
    return _flat(pc.split_pattern(texts, "\n"))


def _values(lines: pa.Array, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Values of the RESULT lines, where each text's begin, and the numbers of those lines."""
    bare = pc.utf8_ltrim(lines, SPACES)
    at = np.flatnonzero(pc.starts_with(bare, RESULT_MARK).to_numpy(zero_copy_only=False))
    values = pc.replace_substring(bare.take(pa.array(at)), RESULT_MARK, "", max_replacements=1)
    return pc.utf8_trim(values, SPACES), np.searchsorted(at, bounds), at


def audit(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Per text the values of its RESULT lines, and those that a fresh injection gives."""
    texts = texts.cast(pa.large_string())
    lines, bounds = _lines(pc.fill_null(texts, ""))
    values, begin, at = _values(lines, bounds)
    keep = np.ones(len(lines), bool)
    keep[at] = False
    kept = np.concatenate([[0], np.cumsum(keep)])[bounds]
    again = inject(_joined(lines, np.flatnonzero(keep), kept))
    expected, expected_begin, _ = _values(*_lines(again))
    gone = texts.is_null().to_numpy(zero_copy_only=False)
    return tuple(
        pa.ListArray.from_arrays(pa.array(b, pa.int32()), v.cast(pa.string()), mask=pa.array(gone))
        for v, b in ((values, begin), (expected, expected_begin))
    )


def audit_texts(texts: Sequence[str | None]) -> tuple[list[list[str] | None], list[list[str] | None]]:
    """``audit`` for lists."""
    return tuple(x.to_pylist() for x in audit(pa.array(texts, pa.large_string())))
