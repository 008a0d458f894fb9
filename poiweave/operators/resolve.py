"""Entity resolution: candidates by grid, acceptance rules, components, canonical ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiweave.functions import fuzzy, text
from poiweave.operators import spatial
from poiweave.operators.components import connected_components
from poiweave.session import ship_package
from poiweave.storage import materialise

#: Fixed value: the largest distance that any rule accepts.
LARGEST_M = 130.0
#: Known rows of one city are dealt to blocks of about this many, which the rows without coordinates all meet.
BLOCK_ROWS = 2_000


def candidate_pairs(places: DataFrame, metres: float = LARGEST_M) -> DataFrame:
    """Unordered pairs within ``metres`` in one city, the earlier ``ord`` first, never of one (source, place_id)."""
    pairs = spatial.near_pairs(places, places, metres).where("l.ord < r.ord")
    return pairs.where("l.source <> r.source or l.place_id <> r.place_id").select(
        F.col("l.place_id").alias("a"), F.col("r.place_id").alias("b"), F.col("l.ord").alias("ord_a"), F.col("r.ord").alias("ord_b"), F.col("l.source").alias("src_a"),
        F.col("r.source").alias("src_b"), F.col("l.name").alias("name_a"), F.col("r.name").alias("name_b"), "meters", F.col("l.city_slug").alias("city_slug"),
    )


def accepted(same_source: Column, m: Column, s: Column, cj: Column, substr: Column, kind: Column, areal: Column) -> Column:
    """The acceptance rule over distance, similarity, content overlap and type words. The thresholds are fixed values."""
    cross = (
        ((m <= 65) & ((s >= 0.34) | substr | (cj >= 0.55)))
        | ((m <= 95) & ((s >= 0.46) | (cj >= 0.50) | (kind & (cj >= 0.40))))
        | ((m <= F.when(areal, 130).otherwise(120)) & kind & ((cj >= 0.50) | (s >= 0.52)))
    )
    same = ((m <= 25) & ((s >= 0.62) | substr | (cj >= 0.65))) | ((m <= 40) & (s >= 0.72) & (cj >= 0.50))
    return F.when(same_source, same).otherwise(cross)


def score_pairs(pairs: DataFrame, fuzzy_score: bool = True, ascii_names: bool = False, hopeful: bool = False) -> DataFrame:
    """Add name_sim, cj, substr, kind, areal. Similarities are computed once per distinct pair of names; with ``hopeful``, only
    for pairs that the acceptance rule would take at the highest similarity, and the others go."""
    form = text.match_name_ascii if ascii_names else text.match_name
    names = pairs.select("name_a", "name_b").distinct().withColumn("na", form(F.col("name_a"))).withColumn("nb", form(F.col("name_b")))
    names = names.withColumn("ta", text.content_tokens(F.col("na"))).withColumn("tb", text.content_tokens(F.col("nb")))
    a, b = F.col("ta"), F.col("tb")
    names = names.withColumn("cj", fuzzy.jaccard(a, b)).withColumn("substr", fuzzy.has_substring(a, b)).withColumn("kind", fuzzy.type_overlap(a, b)).withColumn("areal", fuzzy.is_areal(a) | fuzzy.is_areal(b))
    known = names.select(F.col("name_a").alias("p__a"), F.col("name_b").alias("p__b"), "na", "nb", "cj", "substr", "kind", "areal")
    same_names = F.col("name_a").eqNullSafe(F.col("p__a")) & F.col("name_b").eqNullSafe(F.col("p__b"))
    out = pairs.join(known, same_names).drop("p__a", "p__b")
    if not fuzzy_score:
        return out.withColumn("name_sim", F.col("cj")).drop("na", "nb")
    if hopeful:
        out = out.where(accepted(F.col("src_a") == F.col("src_b"), F.col("meters"), F.lit(1.0), *[F.col(c) for c in ("cj", "substr", "kind", "areal")]))
    ship_package(pairs.sparkSession)
    scored = out.select(F.col("na").alias("p__a"), F.col("nb").alias("p__b")).distinct().withColumn("name_sim", fuzzy.match_similarity("p__a", "p__b"))
    return out.join(scored, (F.col("na") == F.col("p__a")) & (F.col("nb") == F.col("p__b"))).drop("p__a", "p__b", "na", "nb")


def place_links(places: DataFrame, fuzzy_score: bool = True, ascii_names: bool = False) -> DataFrame:
    """Accepted links (a, b, src_a, src_b, name_sim, meters, city_slug), a the earlier row."""
    scored = score_pairs(candidate_pairs(places), fuzzy_score, ascii_names, hopeful=True)
    ok = accepted(F.col("src_a") == F.col("src_b"), *[F.col(c) for c in ("meters", "name_sim", "cj", "substr", "kind", "areal")])
    return scored.where(ok).select("a", "b", "ord_a", "ord_b", "src_a", "src_b", "name_sim", "meters", "city_slug")


def components_of(places: DataFrame, links: DataFrame) -> DataFrame:
    """``places`` with ``component``: the least ord of the place's component."""
    parts = connected_components(materialise(links.select("ord_a", "ord_b"), "links"), "ord_a", "ord_b")
    return places.join(parts.withColumnRenamed("id", "p__id"), F.col("ord") == F.col("p__id"), "left").withColumn("component", F.coalesce("component", "ord")).drop("p__id")


def canonical_places(places: DataFrame, links: DataFrame) -> DataFrame:
    """``places`` with component, best_name (longest, ties to the first row) and place_canonical_id."""
    grouped = materialise(components_of(places, links), "grouped")
    best = grouped.groupBy("component").agg(F.max_by("name", F.struct(F.length("name").alias("n"), (-F.col("ord")).alias("o"))).alias("best_name"))
    slug = text.name_slug(F.col("best_name"))
    named = best.withColumn("slug", F.nullif(slug, F.lit("")))
    return grouped.join(named, "component").withColumn("place_canonical_id", F.concat("slug", F.lit("::"), "city_slug")).drop("slug")


def canonical_map(canonical: DataFrame) -> DataFrame:
    return canonical.select(F.col("place_id").alias("source_place_id"), F.col("place_canonical_id").alias("canonical_id"), F.col("best_name").alias("canonical_name"), "city_slug")


def may_be_similar(a: Column, b: Column, threshold: float) -> Column:
    """False only where no name similarity of two normalised names can reach the threshold: they share no word, and the shorter, with or
    without its repeated words, is too short for it."""
    words = lambda x: F.array_distinct(F.split(x, " "))
    near = lambda m, n: 2.0 * F.least(m, n) >= threshold * (m + n)
    once = lambda x: F.length(F.array_join(words(x), " "))
    return F.arrays_overlap(words(a), words(b)) | near(F.length(a), F.length(b)) | near(once(a), once(b))


def enrich_coordinates(rows: DataFrame, known: list[DataFrame], threshold: float = 0.86) -> DataFrame:
    """Rows without coordinates take lat, lon, type and address from the most similar name of their city hint.

    Sources in ``known`` are tried in order; ties go to the earlier ``ord``. A city's known rows are dealt to blocks, so that no city
    has to be one task. Of rows of one city and name the earliest stands for all, and each asked name is answered once a city; only pairs of names that
    can reach the threshold go through Python, each once.
    """
    ship_package(rows.sparkSession)
    out = rows
    for source in known:
        missing = out.where("(lat is null or lon is null) and city_hint is not null").select(F.col("place_id").alias("p__id"), F.lower("city_hint").alias("p__city"), text.normalize_name(F.col("name")).alias("p__name"))
        have = source.where("lat is not null and lon is not null").select(F.lower("city_hint").alias("p__city"), text.normalize_name(F.col("name")).alias("p__known"), "ord", F.struct("lat", "lon", "type", "address").alias("p__got"))
        have = have.groupBy("p__city", "p__known").agg(F.min_by(F.struct("p__got", "ord"), "ord").alias("p__first")).select("p__city", "p__known", "p__first.*")
        blocks = have.groupBy("p__city").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("p__blocks"))
        dealt = have.join(blocks, "p__city").withColumn("p__block", F.pmod(F.xxhash64("ord", "p__known"), "p__blocks").cast("int")).drop("p__blocks")
        asked = missing.select("p__city", "p__name").distinct().join(blocks, "p__city").withColumn("p__block", F.explode(F.sequence(F.lit(0), F.col("p__blocks") - 1))).drop("p__blocks")
        pairs = asked.join(dealt, ["p__city", "p__block"]).where(may_be_similar(F.col("p__name"), F.col("p__known"), threshold))
        names = pairs.select(F.col("p__name").alias("p__a"), F.col("p__known").alias("p__b")).distinct().withColumn("s", fuzzy.name_similarity("p__a", "p__b")).where(F.col("s") >= threshold)
        pairs = pairs.join(names, (F.col("p__name") == F.col("p__a")) & (F.col("p__known") == F.col("p__b")))
        found = pairs.groupBy("p__city", "p__name").agg(F.max_by("p__got", F.struct("s", (-F.col("ord")).alias("o"))).alias("p__best"), F.max("s").alias("s"))
        best = missing.join(found, ["p__city", "p__name"]).groupBy("p__id").agg(F.max_by("p__best", "s").alias("p__best"))
        joined = out.join(best, F.col("place_id") == F.col("p__id"), "left")
        take = lambda c: F.when(F.col("p__best").isNotNull(), F.col(f"p__best.{c}")).otherwise(F.col(c)).alias(c)
        out = joined.select(*[take(c) if c in ("lat", "lon", "type", "address") else F.col(c) for c in out.columns])
    return out


def unify_sources(parts: list[DataFrame]) -> DataFrame:
    """All sources by name; rows without coordinates or name go. Without a source: ValueError."""
    if not parts:
        raise ValueError("no place source")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.na.drop(subset=["lat", "lon", "name"])


def stage_places(raw: DataFrame, cities: DataFrame) -> DataFrame:
    """Coordinates coerced, city assigned, guarded by its bbox and by 80 km, slug made safe."""
    p = raw.withColumn("lat", F.col("lat").try_cast("double")).withColumn("lon", F.col("lon").try_cast("double")).na.drop(subset=["lat", "lon"])
    p = spatial.geometry_guard(spatial.assign_city(p, cities, "place_id"), cities).where("city_slug is not null")
    p = spatial.too_far(p, cities).where(~F.col("too_far")).drop("too_far")
    return p.withColumn("city_slug", text.slug_path(F.col("city_slug")))


def risky_pairs(places: DataFrame, links: DataFrame, metres: float = 120.0, ascii_names: bool = True) -> DataFrame:
    """Unlinked pairs within 120 m by class: borderline (100 m or more, cross source), risky (cross source, similarity
    at most .30), suspicious (same source, .50 or more). A pair may be in two classes."""
    pairs = candidate_pairs(places, metres)
    linked = links.select("ord_a", "ord_b")
    scored = score_pairs(pairs.join(linked, ["ord_a", "ord_b"], "left_anti"), fuzzy_score=not ascii_names, ascii_names=ascii_names)
    cross = F.col("src_a") != F.col("src_b")
    kinds = F.array(
        F.when(cross & (F.col("meters") >= 100), F.lit("borderline")), F.when(cross & (F.col("name_sim") <= 0.30), F.lit("risky")), F.when(~cross & (F.col("name_sim") >= 0.50), F.lit("suspicious"))
    )
    return scored.withColumn("class", F.explode(F.array_compact(kinds))).select("class", "a", "b", "src_a", "src_b", "name_a", "name_b", "name_sim", "meters", "city_slug", "cj", "substr", "kind", "areal")


def weak_far(risky: DataFrame, metres: float = 50.0) -> DataFrame:
    """Suspicious pairs of one source that are 50 m or more apart."""
    return risky.where((F.col("class") == "suspicious") & (F.col("meters") >= metres))


def low_similarity(risky: DataFrame, most: float = 0.25) -> DataFrame:
    """Suspicious pairs with a similarity below .25: none, since suspicious ones have .50 or more; the report stays for its readers."""
    return risky.where((F.col("class") == "suspicious") & (F.col("name_sim") < most))


def promotions(risky: DataFrame) -> DataFrame:
    """Borderline and risky pairs that the acceptance rule would take, distinct."""
    ok = accepted(F.col("src_a") == F.col("src_b"), *[F.col(c) for c in ("meters", "name_sim", "cj", "substr", "kind", "areal")])
    return risky.where("class in ('borderline', 'risky')").where(ok).drop("class").distinct()
