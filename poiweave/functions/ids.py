"""Identifier recipes: SHA-1 over parts, each closed by a separator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digest(separator: str, parts: tuple[Column, ...]) -> Column:
    return F.sha1(F.concat(*[x for p in parts for x in (F.coalesce(p.cast("string"), F.lit("")), F.lit(separator))]))


def sha1_id(*parts: Column) -> Column:
    return _digest("\x1f", parts)


def hash_id(*parts: Column) -> Column:
    """The older recipe, closed by ``|``."""
    return _digest("|", parts)


def review_id(place_id: Column, scraped_at: Column, text: Column) -> Column:
    return sha1_id(place_id, scraped_at, F.substring(text, 1, 512))


def rental_review_id(given: Column, listing: Column, date: Column, reviewer: Column, text: Column) -> Column:
    """The given id, or one made from the review."""
    made = sha1_id(F.lit("airbnb"), listing, date, reviewer, F.substring(text, 1, 256))
    return F.coalesce(F.nullif(F.trim(given), F.lit("")), made)


def prefixed(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix + ":"), c.cast("string"))
