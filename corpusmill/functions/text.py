"""Text cleaning as native Column expressions (no UDF).

All functions return ``Column`` objects, so they stay inside whole-stage codegen and
compose with any DataFrame.  Regexes are written for Java's engine: ``\\x0b`` instead
of ``\\v`` (Java's ``\\v`` also matches ``\\n``) and ``\\z`` for end of input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's rules) --------------------------------
# Control characters replaced by a space: U+0000-U+0008, U+000B, U+000C, U+000E-U+001F, U+007F.
CONTROL_CLASS = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
# Horizontal blanks collapsed to one space: space, tab, form feed, vertical tab.
BLANK_RUN = r"[ \t\f\x0b]+"
# Python str.strip()/str.isspace() whitespace: U+0009-U+000D, U+001C-U+0020, U+0085, U+00A0,
# U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
PY_SPACE_CLASS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
PY_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
DEFAULT_MIN_LENGTH = 10
CODE_MIN_LENGTH = 5
# Source-file extensions accepted from code archives (compared lower-cased).
CODE_EXTENSIONS = (".py", ".java", ".js", ".go", ".php", ".rb")
# Field precedence for code records and math records.
CODE_FIELDS = ("code", "func_code", "original_string", "content")
# -------------------------------------------------------------------------------------


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col: Column | str) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends.  A scan from each
    end (a regex that is anchored at the end restarts in every inner run of blanks)."""
    return F.btrim(_c(col), F.lit(PY_SPACES))


def clean_text(col: Column | str, collapse_whitespace: bool = True) -> Column:
    """Steps 1-4 of normalisation, in the reference's order, without the length rule."""
    t = F.replace(_c(col), F.lit("\r"), F.lit("\n"))
    t = F.regexp_replace(t, CONTROL_CLASS, " ")
    if collapse_whitespace:
        t = F.regexp_replace(t, BLANK_RUN, " ")
        t = F.regexp_replace(t, r"\n{3,}", "\n\n")
        t = F.regexp_replace(t, r" *\n *", "\n")
    return py_strip(t)


def normalize_text(
    col: Column | str, min_length: int = DEFAULT_MIN_LENGTH, collapse_whitespace: bool = True
) -> Column:
    """Cleaned text, or null when the result is empty or shorter than ``min_length``
    code points.  Null input gives null."""
    t = clean_text(col, collapse_whitespace)
    return F.when(F.length(t) >= F.lit(max(int(min_length), 1)), t)


def with_normalized(
    df: DataFrame,
    src: Column | str,
    out_col: str,
    min_length: int = DEFAULT_MIN_LENGTH,
    collapse_whitespace: bool = True,
) -> DataFrame:
    """Normalise ``src`` into ``out_col`` and drop rejected rows.

    The drop is an ``explode`` of a zero-or-one element array rather than a filter: a
    filter on the derived column would be pushed below the projection by the
    optimiser and evaluate the whole regex chain a second time."""
    norm = normalize_text(src, min_length, collapse_whitespace)
    keep = [F.col(c) for c in df.columns if c != out_col]
    return df.select(*keep, F.explode(F.array_compact(F.array(norm))).alias(out_col))


def normalize_code(col: Column | str, min_length: int = CODE_MIN_LENGTH) -> Column:
    """Code keeps its layout: control characters replaced, whitespace not collapsed."""
    return normalize_text(col, min_length=min_length, collapse_whitespace=False)


def is_valid_text(col: Column | str) -> Column:
    """Load-time validity: a non-null, non-empty string."""
    c = _c(col)
    return c.isNotNull() & (c != F.lit(""))


def first_truthy(*cols: Column | str) -> Column:
    """First value that is neither null nor the empty string."""
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols])


def qa_text(question: Column | str, answer: Column | str) -> Column:
    """Question with an optional answer block: ``q`` or ``q\\n\\nAnswer: a``."""
    q = F.coalesce(_c(question), F.lit(""))
    a = _c(answer)
    has_answer = a.isNotNull() & (a != F.lit(""))
    return F.when(has_answer, F.concat(q, F.lit("\n\nAnswer: "), a)).otherwise(q)


def problem_text(body: Column | str, question: Column | str) -> Column:
    """Word-problem template ``body\\n\\nQ: question\\nA:`` (answer deliberately left out)."""
    return F.concat(
        F.coalesce(_c(body), F.lit("")), F.lit("\n\nQ: "), F.coalesce(_c(question), F.lit("")), F.lit("\nA:")
    )


def basename(col: Column | str) -> Column:
    return F.regexp_extract(_c(col), r"([^/]*)$", 1)


def file_extension(col: Column | str) -> Column:
    """``os.path.splitext`` extension of the last path component (leading dots ignored)."""
    return F.regexp_extract(basename(col), r"^\.*[^.].*(\.[^.]*)$", 1)


def is_code_file(col: Column | str) -> Column:
    """Non-directory member whose lower-cased extension is a known source extension."""
    c = _c(col)
    return (~c.endswith("/")) & F.lower(file_extension(c)).isin(*CODE_EXTENSIONS)


def lines_of(col: Column | str) -> Column:
    """Split on ``\\n`` only, as a line iterator does: a final newline opens no extra line."""
    c = _c(col)
    return F.when(c == F.lit(""), F.array().cast("array<string>")).otherwise(
        F.split(F.regexp_replace(c, r"\n\z", ""), "\n", -1)
    )
