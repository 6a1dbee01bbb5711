"""Column-name sanitising and the text helpers used by reference lookups."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: characters parquet rejects in names; each run of them becomes one "_".
NAME_JUNK = re.compile(r"[\,\s;\n\t\={}()]+")


def sanitize_name(name: str) -> str:
    return NAME_JUNK.sub("_", name)


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename every column (schema-only, no data pass). Two names that collide after
    cleaning are rejected here instead of failing later in the parquet writer."""
    cleaned = [sanitize_name(c) for c in df.columns]
    clashes = sorted(n for n, k in Counter(cleaned).items() if k > 1)
    if clashes:
        raise ValueError(f"column names collide after sanitising: {clashes}")
    return df.toDF(*cleaned)


def as_text(c: Column, data_type: T.DataType | None = None) -> Column:
    """Python-style ``str()`` of a value: null becomes "None", booleans "True"/"False",
    floating point as Python's ``repr`` and timestamps with six fraction digits."""
    if isinstance(data_type, T.BooleanType):
        text = F.when(c, F.lit("True")).otherwise(F.lit("False"))
    elif isinstance(data_type, (T.DoubleType, T.FloatType)):
        text = python_float_text(c)
    elif isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        text = python_timestamp_text(c)
    else:
        text = c.cast("string")
    return F.when(c.isNull(), F.lit("None")).otherwise(text)


def python_float_text(c: Column) -> Column:
    """``str(float)``: the shortest significant digits that read back as the same double (15,
    16 or 17 correctly rounded digits, trailing zeros dropped), written positionally for
    decimal exponents -4..15 and otherwise as ``1.5e+16`` / ``1e-05``. A float column is
    widened first, as Python does."""
    v = c.cast("double")
    # From 2**53 to 2**63 a double is a whole number: round its exact value, because there
    # the JVM's own 17th digit is not always the closest one.
    whole_band = (F.abs(v) >= float(2**53)) & (F.abs(v) < float(2**63))
    exact = F.abs(v).cast("long").cast("decimal(20,0)")
    size = F.length(exact.cast("string"))  # 16..19 digits in the band

    def exact_text(width: int) -> Column:
        rounded = F.lit(None).cast("string")
        for n in (16, 17, 18, 19):
            rounded = F.when(size == n, F.round(exact, width - n).cast("string")).otherwise(rounded)
        return F.concat(
            F.when(v < 0, F.lit("-")).otherwise(F.lit("")), rounded.substr(1, 1), F.lit("."),
            rounded.substr(F.lit(2), F.lit(width - 1)), F.lit("e+"), (F.length(rounded) - 1).cast("string"),
        )

    def written(width: int) -> Column:
        return F.when(whole_band, exact_text(width)).otherwise(F.format_string(f"%.{width - 1}e", v))

    def exactly(width: int) -> Column:
        """The text of this width if it reads back as the same double."""
        return _with(written(width), lambda text: F.when(text.cast("double") == v, text))

    slow = _with(F.coalesce(exactly(15), exactly(16), written(17)), lambda sci: _python_form(sci))
    # Most values need none of this: between 1e-3 and 1e7 the JVM writes positionally, too, and a
    # text of at most 15 digits that it wrote is the shortest one (no two of them are one double).
    plain = v.cast("string")
    return (
        F.when((F.abs(v) >= 1e-3) & (F.abs(v) < 1e7) & (F.length(plain) <= 16), plain)
        .when(F.isnan(v), F.lit("nan"))
        .when(v == float("inf"), F.lit("inf"))
        .when(v == float("-inf"), F.lit("-inf"))
        .when(v == 0, F.when(v.cast("string").startswith("-"), F.lit("-0.0")).otherwise(F.lit("0.0")))
        .otherwise(slow)
    )


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _python_form(sci: Column) -> Column:
    """Python's spelling of the digits in ``d.ddde+xx``."""
    return _with(F.substring_index(sci, "e", 1), lambda mant: _with(
        F.regexp_replace(F.regexp_replace(mant, r"[-.]", ""), "0+$", ""),
        lambda digits: _spelled(mant, digits, F.substring_index(sci, "e", -1).cast("int"))))


def _spelled(mant: Column, digits: Column, exp: Column) -> Column:
    sign = F.when(mant.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    # Significant digits, first one non-zero: "1.50" -> "15", "1.0" -> "1".
    n = F.length(digits)
    whole = F.concat(
        F.rpad(digits, F.greatest(n, exp + 1), "0").substr(F.lit(1), exp + 1),
        F.lit("."),
        F.when(n > exp + 1, digits.substr(exp + 2, n)).otherwise(F.lit("0")),
    )
    fraction = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
    scientific = F.concat(
        digits.substr(1, 1),
        F.when(n > 1, F.concat(F.lit("."), digits.substr(F.lit(2), n))).otherwise(F.lit("")),
        F.lit("e"),
        F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
        F.when(F.abs(exp) < 10, F.lit("0")).otherwise(F.lit("")),  # lpad would cut "308"
        F.abs(exp).cast("string"),
    )
    return (
        F.when((exp >= 0) & (exp < 16), F.concat(sign, whole))
        .when((exp < 0) & (exp >= -4), F.concat(sign, fraction))
        .otherwise(F.concat(sign, scientific))
    )


def python_timestamp_text(c: Column) -> Column:
    """``str(datetime)``: seconds always, microseconds as six digits only when non-zero."""
    base = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    micros = F.date_format(c, "SSSSSS")
    return F.when(micros == "000000", base).otherwise(F.concat(base, F.lit("."), micros))


def strip_whitespace(c: Column) -> Column:
    """Remove leading and trailing whitespace of every kind (``trim`` only removes spaces)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def pad_left(c: Column, length: int, pad: str) -> Column:
    """Strip, then left-pad to ``length``; longer values are kept whole (``lpad`` would cut them)."""
    if len(pad) != 1:
        raise ValueError("pad must be exactly one character")
    s = strip_whitespace(c)
    return F.when(F.length(s) >= length, s).otherwise(F.lpad(s, length, pad))
