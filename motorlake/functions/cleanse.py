"""Column-level cleansing rules: standardisation, safe casts, validation, masking."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exact import col_

# The VIN alphabet excludes I, O and Q; a VIN has 17 characters.
VIN_LENGTH = 17
VIN_PATTERN = r"^[A-HJ-NPR-Z0-9]{17}$"
# Fixed value: a digit is starred when four digits follow it directly.
PHONE_MASK_PATTERN = r"\d(?=\d{4})"


def code(c) -> Column:
    """Codes and categories: UPPER(TRIM(x))."""
    return F.upper(F.trim(col_(c)))


def title(c) -> Column:
    """Names: INITCAP(TRIM(x)) (words split on spaces only)."""
    return F.initcap(F.trim(col_(c)))


def normalise(df: DataFrame, upper: Iterable[str] = (), titles: Iterable[str] = ()) -> DataFrame:
    cols = {c: code(c) for c in upper}
    cols.update({c: title(c) for c in titles})
    return df.withColumns(cols) if cols else df


def safe_cast(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """TRY_CAST each column; malformed text becomes NULL instead of an error."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def safe_date(c) -> Column:
    """Date parse that yields NULL for malformed text (ANSI-safe)."""
    return F.try_to_date(col_(c))


def safe_dates(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.withColumns({c: safe_date(c) for c in cols})


def require(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df.filter(cond) if cond is not None else df


def valid_vin(c) -> Column:
    """17 characters from the VIN alphabet.

    The explicit length test stays: Java's ``$`` also matches before a
    trailing newline.
    """
    c = col_(c)
    return (F.length(c) == VIN_LENGTH) & (F.regexp_extract(c, VIN_PATTERN, 0) != "")


def vin_length_ok(c) -> Column:
    return F.length(col_(c)) == VIN_LENGTH


def defaults(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def null_outside(c, lo, hi) -> Column:
    c = col_(c)
    return F.when(c.between(lo, hi), c)


def flag(c, value: str) -> Column:
    """1 when the column equals ``value`` else 0 (NULL counts as 0)."""
    return F.when(col_(c) == value, F.lit(1)).otherwise(F.lit(0))


def hash_pii(c) -> Column:
    """SHA-256 hex of the whole value; NULL stays NULL."""
    return F.sha2(col_(c), 256)


def mask_phone(c) -> Column:
    """Star every digit that has four digits directly after it."""
    return F.regexp_replace(col_(c), PHONE_MASK_PATTERN, "*")


def mask_last4(c) -> Column:
    """Strict variant: star every digit that has four more digits anywhere after it,
    so separators do not shield a digit (``+91-98765-43210`` -> ``+**-*****-*3210``)."""
    return F.regexp_replace(col_(c), r"\d(?=(?:\D*\d){4})", "*")


def quarter_label(d) -> Column:
    """'yyyyQq'; an empty string for a NULL date (concat_ws skips NULLs)."""
    d = col_(d)
    return F.concat_ws("Q", F.year(d).cast("string"), F.quarter(d).cast("string"))


def month_label(d) -> Column:
    return F.date_format(col_(d), "yyyy-MM")


def calendar_from_label(label: str, prefix: str) -> dict[str, Column]:
    """Year, month and 'yyyyQq' derived from a 'yyyy-MM' label (NULL label -> NULLs and '')."""
    lab = F.col(label)
    year = F.substring(lab, 1, 4).cast("int")
    month = F.substring(lab, 6, 2).cast("int")
    quarter = F.call_function("div", month + 2, F.lit(3))
    return {f"{prefix}_year": year, f"{prefix}_month": month,
            f"{prefix}_quarter": F.concat_ws("Q", year.cast("string"), quarter.cast("string"))}


def calendar(df: DataFrame, date_col: str, prefix: str) -> DataFrame:
    """Year, month, 'yyyy-MM' and 'yyyyQq' columns from a DATE."""
    d = F.col(date_col)
    return df.withColumns({
        f"{prefix}_year": F.year(d),
        f"{prefix}_month": F.month(d),
        f"{prefix}_month_label": month_label(d),
        f"{prefix}_quarter": quarter_label(d),
    })
