"""Text-to-value coercions.

All of them are NULL-on-garbage: ANSI ``CAST`` raises on bad text, so every
parse goes through ``try_cast`` / ``try_to_timestamp``.  NaN never survives a
parse (Spark orders NaN above all numbers and ``avg`` would return NaN), it is
mapped to NULL so that "skip missing" aggregates behave like the reference.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's int()/float() accept "_" between digits ("1_000"); Spark does not.
_DIGIT_UNDERSCORE = r"(?<=[0-9])_(?=[0-9])"
_INT_TEXT = r"^[+-]?[0-9]+$"
# What Python float() reads: decimal / exponent notation or inf / nan words.
# Spark's cast alone also takes Java suffixes such as '5d' or '1f'.
_FLOAT_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_FLOAT_WORDS = r"^[+-]?(?i)(inf|infinity|nan)$"


# What Python's str.strip() takes off: Unicode white space and the four separators 0x1C-0x1F.
_EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Text without white space at both ends (``F.trim`` takes off blanks only)."""
    return F.regexp_replace(_col(c).cast("string"), _EDGES, "")


def _nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def python_float(c) -> Column:
    """Text -> double the way Python ``float()`` reads it (trim, ``1e5``,
    ``inf``, ``1_000``); NaN and garbage -> NULL."""
    s = F.regexp_replace(strip(c), _DIGIT_UNDERSCORE, "")
    ok = s.rlike(_FLOAT_TEXT) | s.rlike(_FLOAT_WORDS)
    return _nan_to_null(F.when(ok, s.try_cast("double")))


def to_number(c) -> Column:
    """C4: plain numeric coercion (pandas ``to_numeric(errors='coerce')``)."""
    return python_float(c)


def try_num(c) -> Column:
    """The mini engine's per-value ``try_num`` for string cells.

    A value with a ``.`` is parsed as a float, anything else must be an
    integer literal; other text is not a number (NULL here, the caller keeps
    the text for string comparison).  So ``'1e5'`` is *not* numeric while
    ``'1e5.0'`` and ``'1_000'`` are.
    """
    raw = _col(c).cast("string")
    s = F.regexp_replace(strip(raw), _DIGIT_UNDERSCORE, "")
    as_float = _nan_to_null(F.when(s.rlike(_FLOAT_TEXT) | s.rlike(_FLOAT_WORDS),
                                   s.try_cast("double")))
    as_int = F.when(s.rlike(_INT_TEXT), s.try_cast("double"))
    return F.when(raw.contains("."), as_float).otherwise(as_int)


def accounting_number(c, unit: float | None = None) -> Column:
    """``1,234`` -> 1234, ``(567)`` -> -567, blanks/garbage -> NULL.

    ``unit`` divides the parsed value (C16, e.g. 1e8)."""
    s = F.translate(_col(c).cast("string"), ",)", "")
    v = python_float(F.translate(s, "(", "-"))
    return v / F.lit(float(unit)) if unit else v


def to_date_safe(c, fmt: str | None = None) -> Column:
    """Text -> date, NULL when unparseable."""
    col = _col(c)
    if fmt is None:
        return F.to_date(F.try_to_timestamp(col.cast("string")))
    return F.to_date(F.try_to_timestamp(col.cast("string"), F.lit(fmt)))


def multi_format_timestamp(c, fmts=("M/d/yyyy h:mm:ss a", "yyyy-MM-dd HH:mm:ss")) -> Column:
    """First format that parses wins."""
    col = _col(c).cast("string")
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(f)) for f in fmts])


def yes_no_flag(c) -> Column:
    """Yes -> 1, No -> 0, anything else NULL."""
    col = _col(c)
    return F.when(col == "Yes", F.lit(1)).when(col == "No", F.lit(0))


def zero_pad(c, width: int = 6) -> Column:
    """Left-pad codes with zeros, never shorten them; NULL/blank stay NULL
    (a blank would otherwise become ``000000``)."""
    s = strip(c)
    return F.when(s != "", F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s))
