"""Deterministic identifiers as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values --------------------------------------------------------------------
ID_SNIPPET_CHARS = 200  # code points of text that enter the sample id
REMOTE_PREFIX = "gs://"
AUTO_ID_PREFIX = "auto_"
# -------------------------------------------------------------------------------------


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def sha1_hex(col: Column | str) -> Column:
    """sha1 hex digest of the UTF-8 bytes of a string."""
    return F.sha1(_c(col).cast("binary"))


def text_hash(col: Column | str) -> Column:
    """Dedup key: sha1 of the normalised text."""
    return sha1_hex(col)


def sample_id(source_uri: Column | str, index: Column | str, text: Column | str) -> Column:
    """sha1(uri || decimal(index) || first 200 code points of text)."""
    return sha1_hex(
        F.concat(_c(source_uri), _c(index).cast("bigint").cast("string"), F.substring(_c(text), 1, ID_SNIPPET_CHARS))
    )


def fallback_sample_id(
    existing: Column | str, path: Column | str, sha: Column | str, text: Column | str
) -> Column:
    """Keep a non-empty id, else ``auto_`` + sha1("path:sha:first 200 of text")."""
    e = _c(existing)
    auto = F.concat(
        F.lit(AUTO_ID_PREFIX),
        sha1_hex(
            F.concat_ws(
                ":",
                F.coalesce(_c(path), F.lit("")),
                F.coalesce(_c(sha), F.lit("")),
                F.substring(_c(text), 1, ID_SNIPPET_CHARS),
            )
        ),
    )
    return F.when(F.coalesce(e, F.lit("")) == F.lit(""), auto).otherwise(e)


def cache_name(path: Column | str, extension: str) -> Column:
    """Local name of a remote artifact: md5 of its URI plus the extension; a path that is not
    remote is its own name."""
    p = _c(path)
    return F.when(p.startswith(REMOTE_PREFIX), F.concat(F.md5(p.cast("binary")), F.lit(extension))).otherwise(p)


def is_auto_id(col: Column | str) -> Column:
    return _c(col).startswith(AUTO_ID_PREFIX)


def unit_hash(col: Column | str) -> Column:
    """Uniform number in [0, 1): first 8 hex digits of sha1 / 2^32."""
    return F.conv(F.substring(sha1_hex(col), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
