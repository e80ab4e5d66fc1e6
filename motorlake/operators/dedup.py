"""Deduplication on a business key with a deterministic survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exact import from_cents


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = (), by: Sequence[str] = (),
                money: Sequence[str] = (), days: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``: the smallest by ``order`` (ASC, NULLS FIRST), ties broken by
    every remaining column, so the survivor never depends on partitioning.

    Planned as an aggregate, ``min(struct(order..., rest...))``: partial
    aggregation collapses duplicates before the shuffle, so a hot key costs one
    row per map task, not one task holding all its rows.

    ``by``: some of ``keys``. The rows are dealt by these once, as they are, and stay so: a join on ``by``
    that follows moves them no second time. All rows of one value of ``by`` then meet in one task, so it is for
    columns whose values repeat a bounded number of times. ``money`` and ``days``: see ``dealt``.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    best = F.min(ranked(rest, order)).alias("__best")
    df = dealt(df, by, money, days) if by else df
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("__best")[c].alias(c) for c in rest])


def dealt(df: DataFrame, by: Sequence[str], money: Sequence[str] = (), days: Sequence[str] = ()) -> DataFrame:
    """The rows dealt by ``by``. Texts of ``money`` and ``days`` travel as numbers of cents and as dates, which is
    shorter, where the number or date written out is that very text; any other text travels as it is.
    """
    short = {c: F.round(F.col(c).try_cast("double") * 100).try_cast("long") for c in money if c in df.columns and c not in by}
    written = {c: from_cents(n).cast("string") for c, n in short.items()}
    for c in [c for c in days if c in df.columns and c not in by]:
        short[c] = F.col(c).try_cast("date")
        written[c] = short[c].cast("string")
    moved = df.select(*[c for c in df.columns if c not in short],
                      *[F.when(written[c] == F.col(c), short[c]).alias(f"__short_{c}") for c in short],
                      *[F.when(F.coalesce(written[c] != F.col(c), F.lit(True)), F.col(c)).alias(c) for c in short]).repartition(*by)
    back = {c: (from_cents(f"__short_{c}") if c in money else F.col(f"__short_{c}")).cast("string") for c in short}
    return moved.select(*[F.coalesce(c, back[c]).alias(c) if c in short else c for c in df.columns])


def ranked(rest: Sequence[str], order: Sequence[Column | str] = ()) -> Column:
    """The struct whose least value is the survivor: ``order``, then the remaining columns. A column that
    ``order`` names stands in the struct once, at its place there."""
    named = {o for o in order if isinstance(o, str) and o in rest}
    fields = []
    for i, o in enumerate(order):
        c = F.col(o) if isinstance(o, str) else o
        fields.append(c if isinstance(o, str) and o in named else c.alias(f"__o{i}"))
    return F.struct(*fields, *[F.col(c) for c in rest if c not in named])


def dedup_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The reference's ``dropDuplicates``: arbitrary survivor (kept for parity checks)."""
    return df.dropDuplicates(list(keys))
