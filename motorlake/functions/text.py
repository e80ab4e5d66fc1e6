"""PII rules applied to free text: find e-mail addresses and phone numbers, replace
them in place and count them per document.  Whole texts are processed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns and replacement tokens (ASCII classes only, so every
# regex engine agrees on what matches).
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_PATTERN = r"(?:\+|\b)[0-9]{2,3}[- ][0-9]{5}[- ][0-9]([0-9]{4})\b|\b[0-9]{6}([0-9]{4})\b"
PHONE_MASK = "******"          # before the last four digits


def scrub(text: Column, emails: Column) -> Column:
    """The text with each of its e-mails hashed and each phone number masked but for its last four digits.

    The text is cut at its e-mails (``emails``: all of them in order) and put together again with their
    hashes between the pieces, so an address that is part of another one, or comes twice, never touches
    the other's place."""
    pieces = F.split(text, EMAIL_PATTERN, -1)
    after = F.transform(emails, lambda e, i: F.concat(F.sha2(e, 256), F.get(pieces, i + 1)))
    hashed = F.concat(F.get(pieces, F.lit(0)), F.array_join(after, ""))
    return F.regexp_replace(hashed, PHONE_PATTERN, PHONE_MASK + "$1$2")


def scrub_text(df: DataFrame, col: str = "text", key: str = "doc_id") -> DataFrame:
    """Per document: e-mail and phone counts, the hashes of the e-mails found and the scrubbed text.

    E-mails are looked for once; phones are counted where no e-mail stands."""
    found = df.select(key, F.col(col).alias("_t"), F.regexp_extract_all(F.col(col), F.lit(EMAIL_PATTERN), 0).alias("_e"))
    phones = F.regexp_count(F.regexp_replace("_t", EMAIL_PATTERN, ""), F.lit(PHONE_PATTERN))
    return found.select(
        key,
        F.size("_e").cast("long").alias("n_emails"),
        phones.cast("long").alias("n_phones"),
        F.array_join(F.transform("_e", lambda e: F.sha2(e, 256)), ",").alias("email_hashes"),
        scrub(F.col("_t"), F.col("_e")).alias("scrubbed_text"),
    )
