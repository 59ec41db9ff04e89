"""Text helpers: blanks, translations, fingerprints (FN-9, FN-20..22)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: the fingerprint joins its fields with a bar and spells null as None.
HASH_SEPARATOR = "|"
HASH_NULL = "None"
PREFERRED_LANGUAGE = "it"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def blank_to_null(col) -> Column:
    """``nullif(x, '')``."""
    return F.nullif(_c(col), F.lit(""))


def has_text(col) -> Column:
    """Not null and not blank; never null itself (FIL-9)."""
    return F.coalesce(_c(col), F.lit("")) != F.lit("")


def text_to_double(col) -> Column:
    """Blank-tolerant text -> double (FN-11)."""
    return blank_to_null(col).cast("double")


def pick_translation(translations, language: str = PREFERRED_LANGUAGE) -> Column:
    """First translation in ``language``, else the first one, else null (FN-21, G-15)."""
    arr = _c(translations)
    preferred = F.get(F.filter(arr, lambda t: t["language"] == F.lit(language)), 0)
    return F.coalesce(preferred["text"], F.get(arr, 0)["text"])


def content_hash(*cols) -> Column:
    """SHA-256 hex of the fields' text joined by '|', null spelled 'None' (FN-20, G-16)."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(HASH_NULL)) for c in cols]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)
