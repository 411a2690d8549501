"""Text clean-up, code mapping, hashing and masking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# What is hidden of an address, and what is shown instead.
MAILBOX, MAILBOX_MASK = ".+@", "****@"


def strip(column: Column) -> Column:
    """Text without blanks, tabs and line ends at either side."""
    return F.btrim(column, F.lit(" \t\n\r\f\x0b"))


def title_case(column: Column) -> Column:
    """Trimmed text with a capital after every non-letter: ``o'neil foo-bar`` → ``O'Neil Foo-Bar``."""
    runs = F.regexp_extract_all(F.lower(strip(column)), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")


def map_code(column: Column, codes: Mapping[str, str]) -> Column:
    """Code looked up trimmed and upper-cased; an unknown code is kept exactly as it came."""
    table = F.create_map(*[F.lit(part) for pair in codes.items() for part in pair])
    return F.coalesce(F.try_element_at(table, F.upper(strip(column))), column)


def row_hash(columns: Sequence[Column]) -> Column:
    """MD5 of the columns' text joined by ``|``, a NULL counting as empty text."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))


def mask_mailbox(column: Column) -> Column:
    """Hides everything up to the last ``@``; text without one is unchanged."""
    return F.regexp_replace(column, MAILBOX, MAILBOX_MASK)


def starts_with_match(column: Column, pattern: str) -> Column:
    """True where ``pattern`` matches from the first character on."""
    return column.cast("string").rlike(f"^(?:{pattern})")
