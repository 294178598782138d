"""SQL fragments for the DuckDB oracle (RE2 regex dialect, ``'g'`` flag, ``$`` = end).

These restate the same rules as ``corpusmill.functions`` in plain SQL so that every
registered query has an independent check.
"""

from __future__ import annotations

CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
PY_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^{PY_SPACE}+|{PY_SPACE}+$', '', 'g')"


def clean(e: str, collapse: bool = True) -> str:
    t = f"replace({e}, chr(13), chr(10))"
    t = f"regexp_replace({t}, '{CONTROL}', ' ', 'g')"
    if collapse:
        t = rf"regexp_replace({t}, '[ \t\f\x0b]+', ' ', 'g')"
        t = rf"regexp_replace({t}, '\n{{3,}}', chr(10) || chr(10), 'g')"
        t = rf"regexp_replace({t}, ' *\n *', chr(10), 'g')"
    return strip(t)


def normalize(e: str, min_length: int = 10, collapse: bool = True) -> str:
    c = clean(e, collapse)
    return f"(CASE WHEN length({c}) >= {max(min_length, 1)} THEN {c} END)"


def dirty(e: str) -> str:
    """The same dirt as ``corpusmill.plans.catalog.dirty`` (CR/LF, tabs, controls, NBSP...)."""
    t = f"replace({e}, ' ', ' ' || chr(9) || ' ')"
    t = f"replace({t}, '.', '.' || chr(1) || chr(11))"
    t = f"replace({t}, chr(10), chr(10) || ' ' || chr(10) || ' ' || chr(10))"
    return (
        f"(chr(13) || chr(10) || ' ' || {t} || chr(13) || chr(10) || chr(10) || chr(10) || chr(160) || chr(12288))"
    )


def sample_id(uri: str, idx: str, text: str) -> str:
    return f"sha1({uri} || CAST({idx} AS VARCHAR) || substring({text}, 1, 200))"


def shard_name(e: str) -> str:
    return f"printf('part-%05d.jsonl', {e})"


def unit_hash(e: str) -> str:
    return f"(CAST(('0x' || substring(sha1({e}), 1, 8)) AS UBIGINT) / 4294967296.0)"
