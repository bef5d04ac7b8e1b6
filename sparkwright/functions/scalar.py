"""Scalar column functions (H1-H26): all built-in expressions, no Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values --------------------------------------------------------------
# Days per month used for whole-month tenancy lengths (365.2425 / 12).
DAYS_PER_MONTH = 30.436875
# Python's str.split() whitespace set, as a regex class (Java and RE2 syntax).
PY_WHITESPACE = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                 r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def java_split(s, sep_regex: str) -> Column:
    """Split like JVM ``String.split(regex)``: trailing empty strings dropped,
    an empty input gives one empty string, a leading separator gives a
    leading empty string (H1/H2). Spark's ``split`` keeps trailing empties,
    so strip the trailing separator run first.
    """
    s = _c(s)
    stripped = F.regexp_replace(s, f"(?:{sep_regex})+\\z", "")
    return (F.when(s.isNull(), F.lit(None))
            .when(s == "", F.array(F.lit("")))
            .when(stripped == "", F.array().cast("array<string>"))
            .otherwise(F.split(stripped, sep_regex)))


def java_split_fast(line: Column, parts: Column, sep_regex: str) -> Column:
    """``java_split`` for the two separator shapes the word counts use, given
    ``parts = split(line, sep)`` computed once, without a second regex pass:

    * a single space: trailing spaces are exactly the trailing separators
      (``rtrim``), middle empties are kept;
    * a run pattern ending in '+' (e.g. ``\\W+``): empty parts can only be
      first or last, so drop one trailing empty, and a line of separators
      only has no words.
    """
    if sep_regex == " ":
        stripped = F.rtrim(line)
        return (F.when(line == "", F.array(F.lit("")))
                .when(stripped == "", F.array().cast("array<string>"))
                .otherwise(F.split(stripped, " ")))
    if not sep_regex.endswith("+"):
        return java_split(line, sep_regex)
    n = F.size(parts)
    dropped = F.when((n > 1) & (F.element_at(parts, -1) == ""), F.slice(parts, 1, n - 1)).otherwise(parts)
    return (F.when(line == "", F.array(F.lit("")))
            .when((F.size(dropped) == 1) & (F.element_at(dropped, 1) == ""), F.array().cast("array<string>"))
            .otherwise(dropped))


def text_lines(text) -> Column:
    """Lines of a text as a line reader sees them: lines end at '\\n', '\\r\\n'
    or '\\r'; one final terminator does not start another line; an empty text
    has no lines. Texts without '\\r' take the plain '\\n' split."""
    t = _c(text)
    nl = F.split(F.regexp_replace(t, "\n\\z", ""), "\n")
    cr = F.split(F.regexp_replace(t, "(?:\r\n|\r|\n)\\z", ""), "\r\n|\r|\n")
    return (F.when(t == "", F.array().cast("array<string>"))
            .when(F.instr(t, "\r") > 0, cr).otherwise(nl))


def py_split(text) -> Column:
    """Python ``str.split()``: runs of whitespace, no empty tokens."""
    t = F.regexp_replace(_c(text), f"^{PY_WHITESPACE}+|{PY_WHITESPACE}+\\z", "")
    return F.when(t == "", F.array().cast("array<string>")).otherwise(
        F.split(t, f"{PY_WHITESPACE}+"))


def tenths_c_to_f(v) -> Column:
    """Tenths of a degree Celsius to Fahrenheit."""
    return _c(v) * 0.1 * 9 / 5 + 32


def round_half_even(v, scale: int = 0) -> Column:
    """Banker's rounding (R ``round``, numpy ``round``).

    Scale 0 uses ``rint`` (half to even on the double itself, codegen-friendly);
    other scales use ``bround`` (decimal rounding).
    """
    return F.rint(_c(v)) if scale == 0 else F.bround(_c(v), scale)


def round_half_away(v, scale: int = 0) -> Column:
    """Round to ``scale`` decimals, half away from zero, on the binary value:
    round(x * 10^scale) / 10^scale, the rounding SQL engines apply to DOUBLE.

    ``F.round(x, d)`` rounds the shortest decimal form instead, so a double
    just below a tie (1178.7349999...) whose form reads 1178.735 goes up there
    and down here. Rounding at scale 0 sees the exact double, so the two
    agree once the value is scaled.
    """
    f = float(10 ** scale)
    return F.round(_c(v) * f, 0) / f


def months_between_whole(start, end) -> Column:
    """Elapsed days / 30.436875, rounded half-even: whole months.

    ``timestamp_diff`` works on wall-clock (NTZ) and zoned timestamps alike,
    without a session time-zone conversion."""
    micros = F.timestamp_diff("MICROSECOND", _c(start), _c(end))
    return F.rint(micros / 1e6 / 86400.0 / DAYS_PER_MONTH)


def epoch_micros(ts, dtype=None) -> Column:
    """Microseconds since 1970-01-01 for a timestamp column.

    TIMESTAMP_NTZ is read as UTC wall-clock time (no session time-zone shift),
    TIMESTAMP is an instant, and a numeric column is taken as epoch seconds
    (as journals store them)."""
    from pyspark.sql import types as T
    c = _c(ts)
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.NumericType):
        return (c.cast("double") * 1e6).cast("bigint")
    return F.unix_micros(c.cast("timestamp"))


def epoch_seconds(ts, dtype=None) -> Column:
    """Seconds since the epoch as DOUBLE (microsecond precision)."""
    return epoch_micros(ts, dtype) / 1e6


def greatest_strict(x, floor) -> Column:
    """max(x, floor) that stays null when x is null (H20); ``greatest`` skips nulls."""
    x = _c(x)
    return F.when(x.isNotNull(), F.greatest(x, F.lit(floor)))


def int_date(v) -> Column:
    """Integer yyyymmdd to DATE."""
    return F.to_date(_c(v).cast("string"), "yyyyMMdd")


def clean_names(df):
    """Lower-case all column names, spaces to underscores."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def select_by_type(df, types) -> list[str]:
    """Names of columns whose simple type is in ``types``."""
    want = set(types)
    return [f.name for f in df.schema.fields if f.dataType.simpleString() in want
            or type(f.dataType).__name__ in want]


def recode_bool(c) -> Column:
    """Boolean to 0/1."""
    return _c(c).cast("int")


def not_equal_null_safe(a, b) -> Column:
    """a <> b where null counts as different from any value."""
    return ~_c(a).eqNullSafe(_c(b))


def exclude_where(df, cond: Column):
    """Remove rows where cond is true; null keeps the row."""
    return df.filter(~F.coalesce(cond, F.lit(False)))
