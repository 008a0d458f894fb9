"""Review exports and links of reviews to places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poiweave.functions import fuzzy, ids, text
from poiweave.operators import spatial
from poiweave.schemas import require_columns
from poiweave.session import ship_package


def last_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row of greatest ``order`` per key; null keys go."""
    columns = [c for c in df.columns if c != key]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("p__row")).select(key, "p__row.*")


def guard_review_city(places: DataFrame, cities: DataFrame) -> DataFrame:
    """Places whose city, recomputed from their coordinates, is the stated one; without coordinates the stated one stays."""
    again = spatial.assign_city(places.withColumnRenamed("city_slug", "p__hint"), cities, "place_id")
    keep = F.when(F.col("lat").isNull() | F.col("lon").isNull(), True).otherwise(F.col("city_slug") == F.col("p__hint"))
    return again.where(keep).withColumn("city_slug", F.col("p__hint")).drop("p__hint")


def export_place_reviews(reviews: DataFrame, places: DataFrame, source: str) -> DataFrame:
    """Reviews of known places: review_id, source, place_id, rating, text, scraped_at, city_slug. Blank texts stay."""
    body = text.unix_lines(F.col("text"))
    out = reviews.join(places.select("place_id", "city_slug"), "place_id")
    return out.select(
        ids.review_id(F.col("place_id"), F.col("scraped_at"), body).alias("review_id"), F.lit(source).alias("source"), "place_id", F.col("rating").try_cast("double").alias("rating"), body.alias("text"), F.col("scraped_at").cast("string").alias("scraped_at"), "city_slug"
    )


def distinct_texts(rows: DataFrame, key: list[str], column: str, k: int = 2, limit: float = 90.0) -> DataFrame:
    """Per key at most ``k`` texts (``idx``, the column): the longest, then each time the longest whose token-set ratio to all taken so far is
    below ``limit``; ties by text. Every round is an aggregate and a join, so the texts of one key never meet in one task."""
    ship_package(rows.sparkSession)
    left, out = rows.where(F.length(column) > 0).select(*key, column), None
    for idx in range(k):
        best = left.groupBy(*key).agg(F.min_by(column, F.struct((-F.length(column)).alias("n"), F.col(column).alias("t"))).alias("p__best"))
        taken = best.select(*key, F.lit(idx).alias("idx"), F.col("p__best").alias(column))
        out = taken if out is None else out.unionAll(taken)
        left = left.join(best, key).where(fuzzy.token_set_ratio(column, "p__best") < limit).drop("p__best")
    return out


def guide_reviews(places: DataFrame) -> DataFrame:
    """Pseudo-reviews of guide places: the description, else name and address; per place the two most distinct texts."""
    described = F.col("desc") if "desc" in places.columns else F.lit(None).cast("string")
    body = F.coalesce(F.substring(text.clean_wiki_text(described), 1, 1200), text.fallback_text(F.col("name"), F.col("address")))
    listed = places.where("source = 'wikivoyage'").select("place_id", "city_slug", text.clean_wiki_text(body).alias("text")).where("trim(text) <> ''")
    out = distinct_texts(listed, ["place_id", "city_slug"], "text")
    return out.select(ids.sha1_id(F.col("place_id"), F.col("text")).alias("review_id"), F.lit("wikivoyage").alias("source"), "place_id", F.lit(None).cast("double").alias("rating"), "text", F.lit(None).cast("string").alias("scraped_at"), "city_slug")


def rag_reviews(reviews: DataFrame, places: DataFrame, cities: DataFrame, source: str, guard: bool = True) -> DataFrame:
    """Older export: left join, city from coordinates (guarded on request) else from the city name, blank texts go."""
    joined = reviews.where("trim(text) <> ''").join(places, "place_id", "left")
    with_row = joined.withColumn("p__row", F.monotonically_increasing_id())
    placed = spatial.assign_city(with_row, cities, "p__row")
    if guard:
        placed = spatial.geometry_guard(placed, cities)
    named = cities.select(F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("n"), "slug", "pos").groupBy(F.lower("n").alias("p__name")).agg(F.min_by("slug", "pos").alias("p__slug"))
    out = placed.join(spatial.small(named), F.lower("city") == F.col("p__name"), "left")
    slug = F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.col("city_slug")).otherwise(F.col("p__slug"))
    return out.select(ids.hash_id(F.col("place_id"), F.col("scraped_at"), F.substring("text", 1, 120)).alias("id"), F.lit(source).alias("source"), "place_id", slug.alias("city_slug"), "rating", "text", "scraped_at", "lat", "lon", F.col("name").alias("place_name"), "address")


def export_rental_reviews(reviews: DataFrame, listing_city: DataFrame) -> DataFrame:
    """Rental reviews of known listings, ids prefixed; ids canonicalised on both sides."""
    listing = text.canonical_id(F.col("listing_id"))
    body = text.unix_lines(F.col("text"))
    r = reviews.withColumn("listing_id", listing)
    rid = ids.rental_review_id(F.col("review_id").cast("string"), F.col("listing_id"), F.col("date"), F.col("reviewer_id").cast("string"), body)
    out = r.withColumn("review_id", ids.prefixed("airbnb", rid)).withColumn("text", body)
    return out.join(listing_city.select(text.canonical_id(F.col("listing_id")).alias("listing_id"), "city_slug").distinct(), "listing_id").select("review_id", F.lit("airbnb").alias("source"), "listing_id", "text", "date", "reviewer_id", "reviewer_name", "city_slug")


def reviews_near_places(reviews: DataFrame, near: DataFrame) -> DataFrame:
    """(review_id, place_id, city_slug) through the listing's nearest place."""
    once = near.groupBy("listing_id").agg(F.min_by(F.struct("place_id", "city_slug"), "place_id").alias("n"))
    return reviews.join(once, "listing_id").select("review_id", "n.place_id", "n.city_slug")


def stage_rental_reviews(raw: DataFrame, listings: DataFrame) -> DataFrame:
    """review_id, listing_id, date, text, reviewer_id, reviewer_name, city_slug of raw rental reviews whose listing is known."""
    require_columns(raw, ["listing_id", "id", "date", "reviewer_id", "reviewer_name", "comments"], "rental reviews")
    own = listings.groupBy("listing_id").agg(F.min("city_slug").alias("city_slug"))
    out = raw.select(F.col("id").cast("string").alias("review_id"), text.canonical_id(F.col("listing_id").cast("string")).alias("listing_id"), "date", F.col("comments").alias("text"), F.col("reviewer_id").cast("string").alias("reviewer_id"), "reviewer_name")
    return out.join(own, "listing_id").select("review_id", "listing_id", "date", "text", "reviewer_id", "reviewer_name", "city_slug")


def place_index(rows: DataFrame, order: str) -> DataFrame:
    """place_id and city_slug of places, under any of their usual column names; rows without either go, of repeated ids the last counts."""
    names = {c.lower(): c for c in rows.columns}
    pick = lambda *options: next((F.col(names[o]) for o in options if o in names), None)
    place, city = pick("place_id", "id", "source_place_id"), pick("city_slug", "city", "slug")
    if place is None or city is None:
        raise ValueError("places lack an id or a city column")
    known = rows.select(text.null_if_blank(place.cast("string")).alias("place_id"), text.null_if_blank(city.cast("string")).alias("city_slug"), F.col(order).alias("p__order"))
    return last_per_key(known.where("city_slug is not null"), "place_id", "p__order").drop("p__order")


def orphans(reviews: DataFrame, listings: DataFrame) -> DataFrame:
    """Reviews whose listing is unknown."""
    return reviews.join(listings.select("listing_id").distinct(), "listing_id", "left_anti")
