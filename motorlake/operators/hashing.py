"""Row hash over tracked attributes (change detection for SCD2 and change feeds)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator between hashed fields and the text that stands for NULL
# in the null-safe variant.
HASH_SEPARATOR = "||"
NULL_SENTINEL = "\u2400"


def row_hash(cols: Sequence[str | Column], null_safe: bool = False) -> Column:
    """SHA-256 hex of the tracked values joined by ``||``.

    Default (as the reference): ``concat_ws`` skips NULLs, so (NULL, 'a') and
    ('a', NULL) hash alike.  ``null_safe=True`` writes a sentinel for NULL.
    """
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    if null_safe:
        parts = [F.coalesce(p, F.lit(NULL_SENTINEL)) for p in parts]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)
