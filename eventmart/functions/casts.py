"""Column builders for text -> typed values.

Two families exist on purpose, because the batch load and the stream read the
same text under different rules:

* batch_*  - database-style casts: surrounding blanks are fine, anything else
  that is not the type is an error. An error is NULL here while the text is not
  NULL; the caller turns that pair into a reject reason.
* stream_* - lenient casts: empty, 'None' and unreadable text become NULL.

Only built-in expressions are used, and only try_cast, so a malformed value can
never stop a job (ANSI mode is on by default).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# \z and not $: in Java regular expressions $ also matches before a final newline.
UUID_LOWER = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"
UUID_ANY_CASE = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\z"
DIGITS = r"^[0-9]+\z"
# Casting alone would also read 'now', '12:00' and '2024' as timestamps.
ISO_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(.*\S)?)?\z"
INFINITE = r"(?i)^\s*[+-]?(inf|infinity)\s*\z"
NOT_FINITE = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*\z"
# Plain texts, which skip the slow path through wide decimals.
SHORT_INT = r"^[+-]?[0-9]{1,9}\z"
SHORT_MONEY = r"^[+-]?[0-9]{1,8}(\.[0-9]{1,2})?\z"
WHITESPACE = " \t\n\r\f\x0b"
WIDE = "decimal(38,18)"
WIDE_LIMIT = 1e20
# ----------------------------------------------------------------------------


def is_uuid(c: Column) -> Column:
    """Strict lower-case UUID test of the batch load (no trimming)."""
    return c.rlike(UUID_LOWER)


def is_digits(c: Column) -> Column:
    return c.rlike(DIGITS)


def strip(c: Column) -> Column:
    """Trim every kind of white space; Spark's trim() removes blanks only."""
    return F.btrim(c, F.lit(WHITESPACE))


# --- batch ------------------------------------------------------------------


def batch_int(c: Column) -> Column:
    """' 12 ' -> 12; '12.0' and '' -> NULL."""
    return c.try_cast("int")


def batch_smallint(c: Column) -> Column:
    return c.try_cast("smallint")


def batch_rounded_smallint(c: Column) -> Column:
    """Numeric text to SMALLINT, halves away from zero: '1.5' -> 2, '-2.5' -> -3."""
    return F.round(c.try_cast(WIDE), 0).try_cast("smallint")


def batch_money(c: Column) -> Column:
    """NUMERIC(10,2), halves away from zero; overflow -> NULL."""
    return c.try_cast("decimal(10,2)")


def batch_negative(c: Column) -> Column:
    """Sign of the *unrounded* number: '-0.004' is negative."""
    return F.when(batch_money(c).isNotNull(), c.try_cast("double") < 0)


def batch_timestamp(c: Column) -> Column:
    """ISO text to an instant; an offset in the text is honoured."""
    t = strip(c)
    return F.when(t.rlike(ISO_SHAPE), t.try_cast("timestamp"))


def batch_name(c: Column) -> Column:
    """Lookup key of a dimension name: blanks trimmed, lower case."""
    return F.lower(F.trim(c))


# --- stream -----------------------------------------------------------------


def stream_text(c: Column) -> Column:
    """All white space stripped, lower case, empty -> NULL."""
    return F.nullif(F.lower(strip(c)), F.lit(""))


def stream_uuid(c: Column) -> Column:
    """UUID in any letter case, stored in lower case; anything else -> NULL."""
    s = strip(c)
    return F.when(s.rlike(UUID_ANY_CASE), F.lower(s))


def stream_number(c: Column) -> Column:
    """The number a text holds, or NULL ('None', '', words, nan and inf)."""
    return c.try_cast(WIDE)


def stream_int(c: Column, default: int | None = None, to: str = "int") -> Column:
    """Number text truncated towards zero: '3.9' -> 3, '-3.9' -> -3."""
    out = F.when(c.rlike(SHORT_INT), c.try_cast(to)).otherwise(stream_number(c).try_cast(to))
    return out if default is None else F.coalesce(out, F.lit(default).cast(to))


def stream_money(c: Column, default: float | None = None) -> Column:
    """Two decimals, rounded the way a binary float is: '2.675' -> 2.67, '0.125' -> 0.12.

    The float nearest to a decimal half lies a little above or below it, and that
    decides; only halves a float holds exactly (eighths) go to the even neighbour.
    Texts with two decimals or fewer take none of this.
    """
    exact = c.try_cast("decimal(28,18)")
    plain = exact.try_cast("decimal(10,2)")  # halves away from zero
    half = F.round(exact, 3)
    is_half = (c.try_cast("double") == half.cast("double")) & (F.abs(half) * 1000 % 10 == 5)
    side = float_side_of_half(F.abs(half).cast("double"))
    below = (F.abs(half) - F.lit("0.005").cast("decimal(4,3)")).try_cast("decimal(10,2)")
    odd_below = F.pmod((below * 100).cast("long"), F.lit(2)) == 1
    down = (side < 0) | ((side == 0) & ~odd_below)
    rounded = F.when(is_half & down, (below * F.signum(half).cast("int")).try_cast("decimal(10,2)"))
    out = F.when(c.rlike(SHORT_MONEY), c.try_cast("decimal(10,2)")).otherwise(F.coalesce(rounded, plain))
    return out if default is None else F.coalesce(out, F.lit(str(default)).cast("decimal(10,2)"))


def float_side_of_half(d: Column) -> Column:
    """Negative, zero or positive: where the float ``d`` lies against the exact half it stands for.

    ``d * 200`` is compared with the odd number it should be. The product is taken in
    two parts of 26 bits each, so that neither is rounded.
    """
    scaled = d * F.lit(134217729.0)  # 2 ** 27 + 1
    high = scaled - (scaled - d)
    low = d - high
    return (high * 200.0 - F.round(d * 200.0)) + low * 200.0


def stream_out_of_range(c: Column, typed: Column, whole: bool = False) -> Column:
    """True where the text is a number that the column type cannot hold.

    'nan' is no number to a ``whole`` column, which is NULL then, and 'inf' is one it can't hold.
    """
    as_double = c.try_cast("double")
    number = (
        stream_number(c).isNotNull()
        | c.rlike(INFINITE if whole else NOT_FINITE)
        | (~F.isnan(as_double) & (F.abs(as_double) >= F.lit(WIDE_LIMIT)))  # nan is the largest double
    )
    return typed.isNull() & F.coalesce(number, F.lit(False))


def stream_timestamp(c: Column) -> Column:
    """ISO text read as UTC wall-clock time; an offset in the text is discarded."""
    return F.when(c.rlike(ISO_SHAPE), c.try_cast("timestamp_ntz")).cast("timestamp")
