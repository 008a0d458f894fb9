"""Registered queries of the engine's own operators on the driver's tables, with their DuckDB SQL.

The place data is an adaptation of the star schema; the fixture text below runs in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from poiweave.functions import geo, ids, text
from poiweave.functions.text import AREAL_WORDS, GENERIC_WORDS, STOP_WORDS
from poiweave.operators import diagnostics, graph, listings, resolve, reviews, spatial
from poiweave.sources import wikidump
from poiweave.storage import materialise

FIXTURES = {
    "fx_city": """select 'region-' || r_regionkey as slug, r_name as name, r_regionkey as pos,
  cast(40 + r_regionkey * 2 as double) as min_lat, cast(10 + r_regionkey * 2 as double) as min_lon,
  cast(40 + r_regionkey * 2 as double) + cast(0.018 as double) as max_lat, cast(10 + r_regionkey * 2 as double) + cast(0.028 as double) as max_lon,
  cast(40 + r_regionkey * 2 as double) + cast(0.01 as double) as c_lat, cast(10 + r_regionkey * 2 as double) + cast(0.015 as double) as c_lon, cast(1 as double) as radius_km
from {region}""",
    "fx_place": """select 'p:' || p_partkey as place_id, p_partkey as ord, case p_size % 3 when 0 then 'yelp' when 1 then 'reddit' else 'wikivoyage' end as source,
  replace(replace(p_name, 'plate', 'tower'), 'anvil', 'square') as name, p_type as type, p_brand as address, 'region-' || (p_partkey % 5) as city_slug,
  cast(40 + (p_partkey % 5) * 2 as double) + ((p_partkey * p_partkey * 31 + p_partkey * 17) % 997) * cast(0.00002 as double) as lat,
  cast(10 + (p_partkey % 5) * 2 as double) + ((p_partkey * p_partkey * 53 + p_partkey * 29) % 1009) * cast(0.00003 as double) as lon
from {part}""",
    "fx_listing": """select 'L' || c_custkey as listing_id, c_custkey as ord, c_name as name, c_nationkey as host_id,
  '$' || cast(cast(floor(abs(c_acctbal)) as bigint) as string) || '.50' as price_raw, c_mktsegment as room_type, 'region-' || (c_custkey % 5) as city_slug,
  cast(40 + (c_custkey % 5) * 2 as double) + ((c_custkey * c_custkey * 37 + c_custkey * 11) % 997) * cast(0.00002 as double) as lat,
  cast(10 + (c_custkey % 5) * 2 as double) + ((c_custkey * c_custkey * 59 + c_custkey * 7) % 1009) * cast(0.00003 as double) as lon
from {customer}""",
    "fx_place_review": """select case l_suppkey % 3 when 0 then 'yelp' when 1 then 'reddit' else 'wikivoyage' end as source, 'p:' || l_partkey as place_id,
  1 + (l_orderkey + l_linenumber) % 5 as rating, case when l_linenumber % 7 = 0 then ' ' else l_returnflag || l_linestatus || ' ' || l_orderkey end as text,
  cast(cast(l_shipdate as date) as string) as scraped_at, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as review_id
from {lineitem}""",
    "fx_listing_review": """select o_orderkey as review_id, 'L' || (o_custkey + case when o_orderkey % 11 = 0 then 10000000 else 0 end) as listing_id,
  cast(cast(o_orderdate as date) as string) as date, o_orderpriority as text, o_custkey as reviewer_id
from {orders}""",
}
_TABLES = {"fx_city": "region", "fx_place": "part", "fx_listing": "customer", "fx_place_review": "lineitem", "fx_listing_review": "orders"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base = _TABLES[name]
    return spark.sql(FIXTURES[name], **{base: table(spark, sf_dir, base)})


def with_fixtures(*names: str) -> str:
    return "with recursive " + ", ".join(f"{n} as ({FIXTURES[n].format(**{_TABLES[n]: _TABLES[n]})})" for n in names)


def cities(spark: SparkSession, sf_dir: str, polygons: bool = False) -> DataFrame:
    """Fixture cities in the form of the operators; with polygons, a triangle below the box's diagonal."""
    c = fixture(spark, sf_dir, "fx_city")
    corner = lambda a, b: F.struct(F.col(a).alias("lat"), F.col(b).alias("lon"))
    triangle = F.array(corner("min_lat", "min_lon"), corner("max_lat", "min_lon"), corner("max_lat", "max_lon"))
    return c.select(
        "slug", "name", F.lit(None).cast("string").alias("country"), F.array("name").alias("aliases"), F.col("c_lat").alias("lat"), F.col("c_lon").alias("lon"), "radius_km", F.array("min_lat", "min_lon", "max_lat", "max_lon").alias("bbox"),
        (triangle if polygons else F.lit(None).cast("array<struct<lat:double,lon:double>>")).alias("polygon"), F.col("pos").cast("int").alias("pos"),
    )


# ---------------------------------------------------------------- SQL of both engines' shared steps

_HAV = "2 * 6371000.0 * asin(sqrt(least(pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2), 1.0)))"
_FLAT = "sqrt(pow(({a}.lat - {b}.lat) * 111320.0, 2) + pow(({a}.lon - {b}.lon) * 40075000.0 * cos(radians(({a}.lat + {b}.lat) / 2)) / 360.0, 2))"
_NEAR = "sqrt(pow((l.lat - p.lat) * 111320.0, 2) + pow((l.lon - p.lon) * 40075000.0 * cos(radians(l.lat)) / 360.0, 2))"


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_TOKENS = f"""
tok as (select place_id, ord, source, name, city_slug, lat, lon, list_distinct(list_filter(list_transform(
    list_filter(string_split(trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')), ' '), lambda t: length(t) >= 3),
    lambda t: case when ends_with(t, 'ies') and length(t) > 4 then t[:-4] || 'y' when ends_with(t, 'es') and length(t) > 3 then t[:-3] when ends_with(t, 's') and length(t) > 3 then t[:-2] else t end),
    lambda t: not list_contains({_list(STOP_WORDS)}, t))) as ts from fx_place)"""
_TOKENS = _TOKENS.replace("t[:-4]", "left(t, length(t) - 3)").replace("t[:-3]", "left(t, length(t) - 2)").replace("t[:-2]", "left(t, length(t) - 1)")
_PAIRS = f"""
near as (select a.place_id as a, b.place_id as b, a.ord as ord_a, b.ord as ord_b, a.source as src_a, b.source as src_b, a.city_slug, {_FLAT.format(a="a", b="b")} as m, a.ts as ta, b.ts as tb,
    array_to_string(list_sort(a.ts), ' ') as ja, array_to_string(list_sort(b.ts), ' ') as jb from tok a join tok b on a.city_slug = b.city_slug and a.ord < b.ord
    where abs(a.lat - b.lat) < 0.002 and {_FLAT.format(a="a", b="b")} <= 130),
scored as (select *, case when len(ta) > 0 and len(tb) > 0 then len(list_intersect(ta, tb))::double / (len(ta) + len(tb) - len(list_intersect(ta, tb))) else 0 end as cj,
    least(length(ja), length(jb)) >= 3 and (case when length(ja) <= length(jb) then contains(jb, ja) else contains(ja, jb) end) as substr,
    list_has_any(list_intersect(ta, {_list(GENERIC_WORDS)}), tb) as kind, list_has_any(ta, {_list(AREAL_WORDS)}) or list_has_any(tb, {_list(AREAL_WORDS)}) as areal from near),
links as (select * from scored where case when src_a <> src_b then
      (m <= 65 and (cj >= 0.34 or substr or cj >= 0.55)) or (m <= 95 and (cj >= 0.46 or cj >= 0.50 or (kind and cj >= 0.40))) or (m <= (case when areal then 130 else 120 end) and kind and (cj >= 0.50 or cj >= 0.52))
    else (m <= 25 and (cj >= 0.62 or substr or cj >= 0.65)) or (m <= 40 and cj >= 0.72 and cj >= 0.50) end)"""
_PARTS = """
edge as (select ord_a as x, ord_b as y from links union all select ord_b, ord_a from links),
reach(x, r) as (select ord, ord from fx_place union select e.y, t.r from reach t join edge e on e.x = t.x),
part_of as (select x as ord, min(r) as component from reach group by x),
best as (select component, arg_max(name, length(name) * 100000000 - p.ord) as best_name from fx_place p join part_of c on c.ord = p.ord group by component),
canon as (select p.*, c.component, b.best_name, nullif(left(regexp_replace(regexp_replace(lower(trim(b.best_name)), '\\s+', '-', 'g'), '[^a-z0-9\\-:_.,]', '', 'g'), 120), '') || '::' || p.city_slug as place_canonical_id
  from fx_place p join part_of c on c.ord = p.ord join best b on b.component = c.component)"""
_ER = with_fixtures("fx_place") + "," + _TOKENS + "," + _PAIRS


def _token_links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    places = fixture(spark, sf_dir, "fx_place")
    return places, resolve.place_links(places, fuzzy_score=False, ascii_names=True)


_RESOLVED: dict[tuple, DataFrame] = {}


def _canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The resolved places of a folder, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RESOLVED:
        _RESOLVED[key] = materialise(resolve.canonical_places(*_token_links(spark, sf_dir)), "canonical")
    return _RESOLVED[key]


def _near(spark: SparkSession, sf_dir: str, metres: float = 60.0) -> DataFrame:
    return listings.near_places(fixture(spark, sf_dir, "fx_listing"), fixture(spark, sf_dir, "fx_place"), metres)


_NEAR_SQL = f"""near_p as (select listing_id, arg_min(place_id, m * 1000000000 + pord) as place_id, min(m) as meters, city_slug from (
  select l.listing_id, l.city_slug, p.place_id, p.ord as pord, {_NEAR} as m from fx_listing l join fx_place p on p.city_slug = l.city_slug and abs(l.lat - p.lat) < 0.0007) where m <= 60 group by listing_id, city_slug)"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


# ---------------------------------------------------------------- regions and distances


@query(with_fixtures("fx_city", "fx_place") + f""", hit as (select place_id, slug, pos, case when p.lat between min_lat and max_lat and p.lon between min_lon and max_lon then 2 when {_HAV.format(a="p.lat", b="p.lon", c="c_lat", d="c_lon")} <= radius_km * 1000 then 3 end as tier,
  {_HAV.format(a="p.lat", b="p.lon", c="c_lat", d="c_lon")} as m from fx_place p, fx_city)
select p.place_id, (select slug from hit h where h.place_id = p.place_id and tier is not null order by tier, case when tier = 3 then m else 0 end, pos limit 1) as city_slug from fx_place p""")
def assign_city_bbox(spark, sf_dir):
    """First bbox, else the nearest centre within its radius."""
    return spatial.assign_city(fixture(spark, sf_dir, "fx_place").drop("city_slug"), cities(spark, sf_dir), "place_id").select("place_id", "city_slug")


@query(with_fixtures("fx_city", "fx_place") + """, corner as (select slug, pos, unnest([1, 2, 3]) as k, min_lat, min_lon, max_lat, max_lon from fx_city),
pt as (select slug, pos, k, case k when 1 then min_lat else max_lat end as y, case k when 3 then max_lon else min_lon end as x from corner),
side as (select a.slug, a.pos, a.y as yi, a.x as xi, b.y as yj, b.x as xj from pt a join pt b on a.slug = b.slug and b.k = case a.k when 1 then 3 else a.k - 1 end),
inside as (select p.place_id, s.slug, s.pos from fx_place p, side s where ((xi > p.lon) <> (xj > p.lon)) and p.lat < (yj - yi) * (p.lon - xi) / ((xj - xi) + 1e-12) + yi group by 1, 2, 3 having count(*) % 2 = 1)
select p.place_id, arg_min(i.slug, i.pos) as polygon_slug from fx_place p join inside i on i.place_id = p.place_id group by p.place_id""")
def assign_city_polygon(spark, sf_dir):
    """Places inside a city's polygon."""
    c = cities(spark, sf_dir, polygons=True).withColumn("bbox", F.lit(None).cast("array<double>")).withColumn("radius_km", F.lit(-1.0))
    out = spatial.assign_city(fixture(spark, sf_dir, "fx_place").drop("city_slug"), c, "place_id")
    return out.where("city_slug is not null").select("place_id", F.col("city_slug").alias("polygon_slug"))


@query(with_fixtures("fx_city", "fx_place") + " select p.place_id, p.city_slug from fx_place p join fx_city c on c.slug = p.city_slug where p.lat between min_lat and max_lat and p.lon between min_lon and max_lon")
def geometry_guard_drop(spark, sf_dir):
    """Places inside the bbox of the city they name."""
    return spatial.geometry_guard(fixture(spark, sf_dir, "fx_place"), cities(spark, sf_dir)).where("city_slug is not null").select("place_id", "city_slug")


@query(with_fixtures("fx_city", "fx_place") + """ select p.place_id, p.city_slug from fx_place p join fx_city c on c.slug = p.city_slug
where p.lat between min_lat - 0.1 / 111.32 and max_lat + 0.1 / 111.32 and p.lon between min_lon - 0.1 / (111.32 * greatest(0.01, abs(cos(radians(p.lat))))) and max_lon + 0.1 / (111.32 * greatest(0.01, abs(cos(radians(p.lat)))))""")
def bbox_buffer_filter(spark, sf_dir):
    """Places inside their city's bbox grown by 100 m."""
    return spatial.in_city_box(fixture(spark, sf_dir, "fx_place"), cities(spark, sf_dir), 0.1).select("place_id", "city_slug")


@query(with_fixtures("fx_city", "fx_place") + f""" select place_id, round({_HAV.format(a="p.lat", b="p.lon", c="c_lat", d="c_lon")}, 3) as meters, {_HAV.format(a="p.lat", b="p.lon", c="c_lat", d="c_lon")} > 1000 as too_far from fx_place p join fx_city c on c.slug = p.city_slug""")
def haversine_city_center(spark, sf_dir):
    """Distance to the city's centre, and whether it exceeds one kilometre."""
    c = cities(spark, sf_dir)
    far = spatial.too_far(fixture(spark, sf_dir, "fx_place"), c, 1.0).join(spatial.small(c.select("slug", F.col("lat").alias("y"), F.col("lon").alias("x"))), F.col("city_slug") == F.col("slug"))
    return far.select("place_id", F.round(geo.haversine_m(F.col("lat"), F.col("lon"), F.col("y"), F.col("x")), 3).alias("meters"), "too_far")


@query(with_fixtures("fx_place") + f""" select a.place_id as a, b.place_id as b, round({_FLAT.format(a="a", b="b")}, 3) as meters from fx_place a join fx_place b on a.city_slug = b.city_slug and a.ord < b.ord where abs(a.lat - b.lat) < 0.003 and {_FLAT.format(a="a", b="b")} <= 250""")
def spatial_candidate_pairs(spark, sf_dir):
    """All pairs of one city within 250 m."""
    return resolve.candidate_pairs(fixture(spark, sf_dir, "fx_place"), 250.0).select("a", "b", F.round("meters", 3).alias("meters"))


@query(with_fixtures("fx_listing", "fx_place") + ", " + _NEAR_SQL + " select listing_id, place_id, round(meters, 3) as meters, city_slug from near_p")
def nearest_place(spark, sf_dir):
    """The nearest place of each listing within 60 m."""
    return _near(spark, sf_dir).select("listing_id", "place_id", F.round("meters", 3).alias("meters"), "city_slug")


# ---------------------------------------------------------------- entity resolution


@query(_ER + " select a, b, src_a, src_b, round(cj, 6) as name_sim, round(m, 3) as meters, city_slug from links")
def er_links_tokens(spark, sf_dir):
    """Accepted links with content overlap as the similarity."""
    return _token_links(spark, sf_dir)[1].select("a", "b", "src_a", "src_b", F.round("name_sim", 6).alias("name_sim"), F.round("meters", 3).alias("meters"), "city_slug")


@query()
def er_links_full(spark, sf_dir):
    """Accepted links with the fuzzy similarity (tested against brute force)."""
    return resolve.place_links(fixture(spark, sf_dir, "fx_place"))


@query(_ER + "," + _PARTS + " select place_id, component from canon")
def er_components(spark, sf_dir):
    """Component of every place: the least row of what links reach."""
    return resolve.components_of(*_token_links(spark, sf_dir)).select("place_id", "component")


@query(_ER + "," + _PARTS + " select place_id as source_place_id, place_canonical_id as canonical_id, best_name as canonical_name, city_slug from canon")
def place_canonical_map(spark, sf_dir):
    """Canonical id and longest name of every place."""
    return resolve.canonical_map(_canonical(spark, sf_dir))


@query(_ER + "," + _PARTS + " select place_canonical_id as canonical_id, city_slug, arg_min(name, ord) as name, arg_min(best_name, ord) as best_name from canon group by 1, 2")
def canonical_name_first(spark, sf_dir):
    """Canonical nodes named by their first row."""
    return graph.canonical_nodes(_canonical(spark, sf_dir))


@query(_ER + "," + _PARTS + """ select place_canonical_id as canonical_id, city_slug,
  round(coalesce(avg(lat) filter (source = 'yelp'), avg(lat) filter (source = 'wikivoyage'), avg(lat) filter (source = 'reddit'), avg(lat)), 8) as lat,
  round(coalesce(avg(lon) filter (source = 'yelp'), avg(lon) filter (source = 'wikivoyage'), avg(lon) filter (source = 'reddit'), avg(lon)), 8) as lon from canon group by 1, 2""")
def canonical_coords_priority(spark, sf_dir):
    """Mean coordinates of the first source that has any."""
    c = graph.canonical_coordinates(_canonical(spark, sf_dir))
    return c.select("canonical_id", "city_slug", F.round("lat", 8).alias("lat"), F.round("lon", 8).alias("lon"))


@query(_ER + "," + _PARTS + " select city_slug, sum(c)::bigint as places, count(*) as clusters, sum((c = 1)::int)::bigint as singletons from (select city_slug, place_canonical_id, count(*) as c from canon group by 1, 2) group by 1")
def cluster_stats(spark, sf_dir):
    """Clusters and singletons per city."""
    return diagnostics.cluster_stats(_canonical(spark, sf_dir))


@query(_ER + """, rest as (select s.* from scored s anti join links l on l.ord_a = s.ord_a and l.ord_b = s.ord_b where s.m <= 120)
select 'borderline' as class, a, b, round(cj, 6) as name_sim, round(m, 3) as meters from rest where src_a <> src_b and m >= 100
union all select 'risky', a, b, round(cj, 6), round(m, 3) from rest where src_a <> src_b and cj <= 0.30
union all select 'suspicious', a, b, round(cj, 6), round(m, 3) from rest where src_a = src_b and cj >= 0.50""")
def spotcheck_classes(spark, sf_dir):
    """Unlinked pairs within 120 m by class."""
    places, links = _token_links(spark, sf_dir)
    return resolve.risky_pairs(places, links).select("class", "a", "b", F.round("name_sim", 6).alias("name_sim"), F.round("meters", 3).alias("meters"))


# ---------------------------------------------------------------- reviews and listings

_ID = "sha1({0} || chr(31) || {1} || chr(31) || {2} || chr(31))"


@query(with_fixtures("fx_place_review", "fx_place") + f""" select {_ID.format("r.place_id", "scraped_at", "left(text, 512)")} as review_id, 'yelp' as source, r.place_id, rating::double as rating, text, scraped_at, city_slug from fx_place_review r join fx_place p on p.place_id = r.place_id where r.source = 'yelp'""")
def place_reviews_export(spark, sf_dir):
    """Reviews of known places with made ids."""
    r = fixture(spark, sf_dir, "fx_place_review").where("source = 'yelp'").select("place_id", "rating", "text", "scraped_at")
    return reviews.export_place_reviews(r, fixture(spark, sf_dir, "fx_place"), "yelp")


@query(with_fixtures("fx_listing_review", "fx_listing") + " select 'airbnb:' || review_id as review_id, 'airbnb' as source, r.listing_id, text, date, reviewer_id, 'n' || reviewer_id as reviewer_name, city_slug from fx_listing_review r join fx_listing l on l.listing_id = r.listing_id")
def rental_reviews_export(spark, sf_dir):
    """Rental reviews of known listings."""
    r = fixture(spark, sf_dir, "fx_listing_review").withColumn("reviewer_name", F.concat(F.lit("n"), "reviewer_id"))
    return reviews.export_rental_reviews(r, fixture(spark, sf_dir, "fx_listing").select("listing_id", "city_slug"))


@query(with_fixtures("fx_listing_review", "fx_listing") + " select review_id, r.listing_id from fx_listing_review r anti join fx_listing l on l.listing_id = r.listing_id")
def orphan_reviews(spark, sf_dir):
    """Rental reviews whose listing is unknown."""
    return reviews.orphans(fixture(spark, sf_dir, "fx_listing_review"), fixture(spark, sf_dir, "fx_listing")).select("review_id", "listing_id")


@query(with_fixtures("fx_listing", "fx_place", "fx_listing_review") + ", " + _NEAR_SQL + " select r.review_id, n.place_id, n.city_slug from fx_listing_review r join near_p n on n.listing_id = r.listing_id")
def review_near_place(spark, sf_dir):
    """Rental reviews by their listing's nearest place."""
    return reviews.reviews_near_places(fixture(spark, sf_dir, "fx_listing_review"), _near(spark, sf_dir))


@query(with_fixtures("fx_listing") + " select listing_id, try_cast(regexp_extract(replace(price_raw, ',', ''), '[0-9]+(\\.[0-9]+)?') as double) as price, regexp_replace(trim(listing_id || '.0'), '\\.0+$', '') as clean_id from fx_listing")
def listing_price_and_id(spark, sf_dir):
    """Prices and ids as staging reads them."""
    l = fixture(spark, sf_dir, "fx_listing")
    return l.select("listing_id", text.parse_price(F.col("price_raw")).alias("price"), text.canonical_id(F.concat("listing_id", F.lit(".0"))).alias("clean_id"))


@query(with_fixtures("fx_listing") + " select host_id, count(*) as n_listings, host_id % 4 = 0 as is_superhost from fx_listing group by host_id")
def superhost_parse(spark, sf_dir):
    """Hosts and the spellings of yes."""
    spelled = F.element_at(F.array(*[F.lit(x) for x in ("t", "False", "f", "")]), (F.col("host_id") % 4 + 1).cast("int"))
    h = fixture(spark, sf_dir, "fx_listing").groupBy("host_id").agg(F.count("*").alias("n_listings")).withColumn("s", spelled)
    return h.select("host_id", "n_listings", listings.superhost("s").alias("is_superhost"))


# ---------------------------------------------------------------- graph


_VAR = _ER.replace("with recursive ", with_fixtures("fx_listing", "fx_place_review") + ", ", 1) + "," + _PARTS


@query(_VAR + " select distinct place_canonical_id as canonical_id, review_id from fx_place_review r join canon c on c.place_id = r.place_id")
def lift_reviews(spark, sf_dir):
    """Distinct canonical place and review."""
    return graph.lift_reviews(fixture(spark, sf_dir, "fx_place_review"), _canonical(spark, sf_dir))


_POP = _VAR + ", " + _NEAR_SQL + """, nodes as (select place_canonical_id as id, city_slug, arg_min(name, ord) as name from canon group by 1, 2),
ln as (select place_canonical_id as id, count(distinct listing_id) as n from near_p n join canon c on c.place_id = n.place_id group by 1),
rc as (select place_canonical_id as id, count(distinct review_id) as n from fx_place_review r join canon c on c.place_id = r.place_id where r.source in ('yelp', 'reddit') and trim(text) <> '' group by 1),
j as (select nodes.*, coalesce(ln.n, 0) as ln, coalesce(rc.n, 0) as rc from nodes left join ln on ln.id = nodes.id left join rc on rc.id = nodes.id),
z as (select *, coalesce((ln - avg(ln) over w) / nullif(stddev_samp(ln) over w, 0), 0) as z_ln, coalesce((rc - avg(rc) over w) / nullif(stddev_samp(rc) over w, 0), 0) as z_rc from j window w as (partition by city_slug)),
pop as (select *, 0.6 * z_ln + 0.4 * z_rc as pz from z)"""


@query(_POP + """ select id as canonical_id, city_slug, ln as listings_nearby, rc as reviews_count, round(z_ln, 6) as z_ln, round(z_rc, 6) as z_rc, round(pz, 6) as popularity_z,
  case when pz >= 1 then 'high' when pz >= 0 then 'medium' else 'low' end as popularity_flag from pop""")
def popularity_blended(spark, sf_dir):
    """Listings nearby and reviews as z-scores per city, blended and flagged."""
    c = _canonical(spark, sf_dir)
    p = graph.popularity(graph.canonical_nodes(c), _near(spark, sf_dir), c, fixture(spark, sf_dir, "fx_place_review"))
    r = lambda x: F.round(x, 6).alias(x)
    return p.select("canonical_id", "city_slug", "listings_nearby", "reviews_count", r("z_ln"), r("z_rc"), r("popularity_z"), "popularity_flag")


@query(_POP + """, spoken as (select distinct place_canonical_id as id, review_id, r.source, text from fx_place_review r join canon c on c.place_id = r.place_id where trim(text) <> ''),
w as (select id, string_agg(left(text, 600), '|' order by review_id, text) as wv from (select *, row_number() over (partition by id order by review_id, text) as k from spoken where source = 'wikivoyage') where k <= 2 group by id),
q as (select id, string_agg(source || ':' || left(text, 220), '|' order by review_id, text) as quotes from (select *, row_number() over (partition by id order by review_id, text) as k from spoken where source <> 'wikivoyage') where k <= 4 group by id)
select pop.id as canonical_id, name, coalesce(wv, '') as wv, coalesce(quotes, '') as quotes, round(pz, 6) as popularity_z from pop left join w on w.id = pop.id left join q on q.id = pop.id""")
def poi_cards(spark, sf_dir):
    """Cards with two guide texts and four quotes."""
    c = _canonical(spark, sf_dir)
    r = fixture(spark, sf_dir, "fx_place_review")
    cards = graph.poi_cards(graph.popularity(graph.canonical_nodes(c), _near(spark, sf_dir), c, r), r, c)
    quotes = F.array_join(F.transform("quotes", lambda q: F.concat(q["source"], F.lit(":"), q["txt"])), "|")
    return cards.select("canonical_id", "name", F.coalesce(F.array_join("wv", "|"), F.lit("")).alias("wv"), F.coalesce(quotes, F.lit("")).alias("quotes"), F.round("popularity_z", 6).alias("popularity_z"))


@query(with_fixtures("fx_place", "fx_listing", "fx_place_review", "fx_listing_review", "fx_city") + " select 'cities' as item, count(*) as n from fx_city union all select 'places', count(*) from fx_place union all select 'listings', count(*) from fx_listing union all select 'place_reviews', count(*) from fx_place_review union all select 'listing_reviews', count(*) from fx_listing_review")
def sanity_counts(spark, sf_dir):
    """Rows of every node table."""
    f = lambda n: fixture(spark, sf_dir, n)
    return graph.counts(cities=f("fx_city"), places=f("fx_place"), listings=f("fx_listing"), place_reviews=f("fx_place_review"), listing_reviews=f("fx_listing_review"))


@query(with_fixtures("fx_listing") + " select city_slug, count(*) as n from fx_listing group by 1 order by n desc, city_slug limit 10")
def top_cities_listings(spark, sf_dir):
    """The ten cities with most listings."""
    return diagnostics.value_counts(fixture(spark, sf_dir, "fx_listing"), "city_slug", 10)


@query("select 'L' || o_custkey as listing_id, arg_max(o_orderpriority, o_orderkey) filter (o_orderkey % 3 = 0) as priority, arg_max(o_orderkey, o_orderkey) as last_order from orders group by 1")
def upsert_last_non_null(spark, sf_dir):
    """The last non-null value of each column in input order."""
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("L"), "o_custkey").alias("listing_id"), F.col("o_orderkey").alias("ord"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("priority"), F.col("o_orderkey").alias("last_order"))
    return graph.upsert(o, "listing_id", "ord")


@query(with_fixtures("fx_city") + " select slug, min_lat, min_lon, max_lat, max_lon from fx_city")
def bbox_swap_repair(spark, sf_dir):
    """Swapped bounds are put right."""
    c = fixture(spark, sf_dir, "fx_city")
    odd = F.col("pos") % 2 == 1
    swap = lambda a, b: F.when(odd, F.col(b)).otherwise(F.col(a))
    rows = c.select("slug", "name", swap("min_lat", "max_lat").alias("bbox_min_lat"), swap("min_lon", "max_lon").alias("bbox_min_lon"), swap("max_lat", "min_lat").alias("bbox_max_lat"), swap("max_lon", "min_lon").alias("bbox_max_lon"))
    return graph.cities_nodes(rows).drop("name")


@query("select slug, array_to_string(list_sort(list_distinct([name] || coalesce(more, []))), '|') as aliases from (select 'region-' || r_regionkey as slug, r_name as name, (select list(n_name) from nation where n_regionkey = r_regionkey) as more from region)")
def alias_config_merge(spark, sf_dir):
    """City aliases with those of a second table."""
    more = table(spark, sf_dir, "nation").select(F.concat(F.lit("region-"), "n_regionkey").alias("slug"), F.col("n_name").alias("alias"))
    return diagnostics.merge_aliases(cities(spark, sf_dir), more).select("slug", F.array_join(F.array_sort("aliases"), "|").alias("aliases"))


@query(with_fixtures("fx_city", "fx_place") + f""" select slug, type as title, count(*) as n from fx_place p join fx_city c on {_HAV.format(a="p.lat", b="p.lon", c="c_lat", d="c_lon")} <= 1200 where p.ord % 4 <> 0 group by 1, 2 having count(*) >= 8""")
def alias_suggestions(spark, sf_dir):
    """Frequent hints of unassigned rows near a centre."""
    p = fixture(spark, sf_dir, "fx_place").withColumn("city_hint", F.col("type"))
    return diagnostics.alias_suggestions(p, p.where("ord % 4 = 0"), cities(spark, sf_dir), near_km=1.2)


# ---------------------------------------------------------------- notebook analytics


@query(with_fixtures("fx_place_review", "fx_place") + " select city_slug, count(rating) as n_ratings, round(avg(rating), 6) as mean_rating from fx_place_review r join fx_place p on p.place_id = r.place_id group by 1 order by n_ratings desc, city_slug limit 15")
def rating_summary_top15(spark, sf_dir):
    """Cities with most ratings."""
    r = fixture(spark, sf_dir, "fx_place_review").join(fixture(spark, sf_dir, "fx_place").select("place_id", "city_slug"), "place_id")
    return diagnostics.rating_summary(r).withColumn("mean_rating", F.round("mean_rating", 6))


@query(with_fixtures("fx_place", "fx_city") + " select city_slug, coalesce(c.name, city_slug) as city_name, n from (select city_slug, count(*) as n from fx_place group by 1) left join fx_city c on c.slug = city_slug")
def places_per_city(spark, sf_dir):
    """Places per city with its name."""
    n = diagnostics.value_counts(fixture(spark, sf_dir, "fx_place"), "city_slug", 15)
    return n.join(spatial.small(fixture(spark, sf_dir, "fx_city").select("slug", "name")), F.col("city_slug") == F.col("slug"), "left").select("city_slug", F.coalesce("name", "city_slug").alias("city_name"), "n")


@query("select least(floor((l_quantity - lo) / ((hi - lo) / 10)), 9)::int as bin, count(*) as n from lineitem, (select min(l_quantity) as lo, max(l_quantity) as hi from lineitem) group by 1")
def rating_histogram(spark, sf_dir):
    """Ten equal-width bins."""
    return diagnostics.histogram(table(spark, sf_dir, "lineitem"), "l_quantity")


@query("""select term, count(*) as n from (select unnest(list_filter(list_transform(regexp_split_to_array(lower(text), '\\s+'), lambda w: trim(w, '.,!?:"''()[]{}-')), lambda w: w <> '' and not regexp_full_match(w, '[0-9]+'))) as term from conversations)
where term not in ('the', 'and', 'of') group by 1 order by n desc, term limit 20""")
def review_terms_top20(spark, sf_dir):
    """The most frequent terms of conversation texts."""
    return diagnostics.frequent_terms(table(spark, sf_dir, "conversations"), ["the", "and", "of"])


@query("select doc_id, nullif(left(regexp_replace(regexp_replace(lower(trim(coalesce(source, ''))), '\\s+', '-', 'g'), '[^a-z0-9\\-:_.,]', '', 'g'), 120), '') as slug, sha1(doc_id || chr(31) || source || chr(31)) as id, sha1(doc_id || '|' || source || '|') as old_id, length(regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g')) as n_text from documents")
def text_and_ids(spark, sf_dir):
    """Slugs, both id recipes and normalised line ends over documents."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.nullif(text.name_slug(F.col("source")), F.lit("")).alias("slug"), ids.sha1_id(F.col("doc_id"), F.col("source")).alias("id"), ids.hash_id(F.col("doc_id"), F.col("source")).alias("old_id"), F.length(text.unix_lines(F.col("text"))).cast("long").alias("n_text"))


@query()
def distinct_snippets(spark, sf_dir):
    """The two most distinct texts of every conversation (tested against brute force: SQL has no token-set ratio)."""
    return reviews.distinct_texts(table(spark, sf_dir, "conversations"), ["conv_id"], "text")


@query(with_fixtures("fx_listing", "fx_place") + f""" select city_slug, count(*) as n from fx_listing l where exists (select 1 from fx_place p where p.city_slug = l.city_slug and {_NEAR} <= 300) group by 1""")
def listings_near_any_place(spark, sf_dir):
    """Listings per city that have a place within 300 m."""
    return spatial.having_near(fixture(spark, sf_dir, "fx_listing"), fixture(spark, sf_dir, "fx_place"), 300.0).groupBy("city_slug").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- further operators


@query(with_fixtures("fx_city", "fx_place") + f""", hit as (select place_id, slug, {_HAV.format(a="p.lat", b="p.lon", c="c_lat", d="c_lon")} as m, pos from fx_place p, fx_city)
select p.place_id, (select slug from hit h where h.place_id = p.place_id and m <= 1000 order by m, pos limit 1) as city_slug from fx_place p""")
def assign_city_radius(spark, sf_dir):
    """The nearest centre within its radius, for cities without box and polygon."""
    c = cities(spark, sf_dir).withColumn("bbox", F.lit(None).cast("array<double>"))
    return spatial.assign_city(fixture(spark, sf_dir, "fx_place").drop("city_slug"), c, "place_id").select("place_id", "city_slug")


@query(with_fixtures("fx_place_review", "fx_place") + " select r.review_id, r.place_id, r.source from fx_place_review r semi join (select place_id from fx_place where ord % 3 <> 0) p on p.place_id = r.place_id where trim(r.text) <> ''")
def reviews_valid_semi(spark, sf_dir):
    """Reviews with a text whose place is known."""
    known = fixture(spark, sf_dir, "fx_place").where("ord % 3 <> 0")
    return graph.valid_reviews(fixture(spark, sf_dir, "fx_place_review"), known).select("review_id", "place_id", "source")


@query(with_fixtures("fx_place_review", "fx_place") + f""" select {_ID.format("r.place_id", "scraped_at", "left(text, 512)")} as review_id, r.source, r.place_id, rating::double as rating, text, scraped_at, city_slug from fx_place_review r join fx_place p on p.place_id = r.place_id where r.source in ('yelp', 'reddit')
union all select sha1(place_id || chr(31) || t || chr(31)), 'wikivoyage', place_id, null, t, null, city_slug from (select place_id, city_slug, name || ' – ' || address as t from fx_place where source = 'wikivoyage')""")
def reviews_union_sources(spark, sf_dir):
    """Reviews of all three sources in one table; guide places speak by their name and address."""
    r, places = fixture(spark, sf_dir, "fx_place_review"), fixture(spark, sf_dir, "fx_place")
    parts = [reviews.export_place_reviews(r.where(F.col("source") == k).select("place_id", "rating", "text", "scraped_at"), places, k) for k in ("yelp", "reddit")]
    return parts[0].unionByName(parts[1]).unionByName(reviews.guide_reviews(places))


@query("select conv_id, k as rank, text from (select conv_id, text, row_number() over (partition by conv_id order by length(text) desc, text) as k from (select distinct conv_id, text from conversations)) where k <= 2")
def topk_longest_snippets(spark, sf_dir):
    """The two longest texts of every conversation."""
    w = Window.partitionBy("conv_id").orderBy(F.desc(F.length("text")), "text")
    d = table(spark, sf_dir, "conversations").select("conv_id", "text").distinct()
    return d.withColumn("rank", F.row_number().over(w)).where("rank <= 2").select("conv_id", "rank", "text")


@query("select c_nationkey::varchar as host_id, arg_min(c_name, c_custkey) as host_name, case arg_min(c_custkey, c_custkey) % 3 when 0 then 't' else 'f' end as host_is_superhost from customer group by 1")
def host_first_distinct(spark, sf_dir):
    """One row per host, the first."""
    raw = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.col("c_nationkey").cast("string"), F.lit(".0")).alias("host_id"), F.col("c_name").alias("host_name"), F.when(F.col("c_custkey") % 3 == 0, "t").otherwise("f").alias("host_is_superhost"))
    return listings.hosts(raw).select("host_id", "host_name", "host_is_superhost")


_TITLE = "case p_partkey % 5 when 0 then p_name || '/Old Town' when 1 then p_name || ' (town)' when 2 then p_name || ' district' when 3 then upper(p_name) || '-region' else '  ' || p_name || ' ' end"


@query(f"""with t as (select p_partkey, trim(lower({_TITLE})) as t from part),
o as (select p_partkey, [t, trim(string_split(t, '/')[1]), trim(regexp_replace(t, '\\s*\\([^)]*\\)\\s*$', '')), trim(regexp_replace(t, '\\b(district|province|region|prefecture|county)$', ''))] as xs from t)
select p_partkey, array_to_string(list_sort(list_distinct(list_filter(xs, lambda x: x <> ''))), '|') as candidates from o""")
def title_candidates(spark, sf_dir):
    """Keys under which a guide title may be known."""
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.array_sort(text.title_candidates(F.expr(_TITLE))), "|").alias("candidates"))


_PAGE = """'Intro [[x]] {{' || case p_size % 4 when 0 then 'see' when 1 then ' Eat ' when 2 then 'unknown' else 'sleep' end || '|name=' || case when p_partkey % 10 = 0 then '' else p_name end || ' | lat=' || cast(40 + p_partkey % 45 as integer) || '.5N|long=-' || cast(p_partkey % 180 as integer)
  || '.25|' || case when p_partkey % 4 = 0 then 'addr=' || p_brand else 'directions=near ' || p_type end || '|content= The ' || p_name || ' itself }} {{do|name=Nowhere}} {{marker|title=M' || p_partkey || '|lat=1|lon=2}} text'"""


@query(f"""with pages as (select p_partkey, 'Page ' || p_partkey as title, {_PAGE} as t, lower(trim(regexp_extract({_PAGE}, '\\{{\\{{([^|]*)\\|', 1))) as kind from part)
select title, kind as type, trim(regexp_extract(t, 'name=([^|]*?) \\|', 1)) as name, regexp_extract(t, 'lat=([0-9.]+)', 1)::double as lat, regexp_extract(t, 'long=(-[0-9.]+)', 1)::double as lon, regexp_extract(t, '(?:addr|directions)=([^|]*)', 1) as address, trim(regexp_extract(t, 'content=([^}}]*)', 1)) as "desc"
  from pages where kind <> 'unknown' and regexp_extract(t, 'name=([^|]*?) \\|', 1) <> ''
union all select title, 'marker', 'M' || p_partkey, 1.0, 2.0, '', '' from pages""")
def wikitext_listings(spark, sf_dir):
    """Places listed in wiki markup: name, coordinates, address and text of listing templates that have them."""
    pages = table(spark, sf_dir, "part").select(F.concat(F.lit("Page "), "p_partkey").alias("title"), F.expr(_PAGE).alias("wikitext"))
    return wikidump.listings_of(pages).select(F.col("city_hint").alias("title"), "type", "name", "lat", "lon", F.coalesce("address", F.lit("")).alias("address"), F.coalesce("desc", F.lit("")).alias("desc"))


@query("""select page_id, href, count(*) as n from (select page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as href from pages) group by 1, 2""")
def html_links_extract(spark, sf_dir):
    """Targets of the links of every page, with their number."""
    links = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).alias("href"))
    return links.groupBy("page_id", "href").agg(F.count("*").alias("n"))


@query(_POP + """ select id as canonical_id, city_slug, ln as listings_nearby, round(z_ln, 6) as z_ln, case when round(z_ln, 9) >= 1 then 'high' when round(z_ln, 9) >= 0 then 'medium' else 'low' end as listings_flag from pop""")
def popularity_listings_z(spark, sf_dir):
    """Listings nearby as z-scores per city, flagged."""
    c = _canonical(spark, sf_dir)
    p = graph.popularity(graph.canonical_nodes(c), _near(spark, sf_dir), c, fixture(spark, sf_dir, "fx_place_review"))
    return p.select("canonical_id", "city_slug", "listings_nearby", F.round("z_ln", 6).alias("z_ln"), "listings_flag")


@query(_ER + """, rest as (select s.* from scored s anti join links l on l.ord_a = s.ord_a and l.ord_b = s.ord_b where s.m <= 120 and s.src_a = s.src_b and s.cj >= 0.50)
select 'weak_far' as report, a, b, round(cj, 6) as name_sim, round(m, 3) as meters from rest where m >= 50 union all select 'low_sim', a, b, round(cj, 6), round(m, 3) from rest where cj < 0.25""")
def spotcheck_weak_far(spark, sf_dir):
    """Suspicious pairs of one source: far apart, and (none) hardly similar."""
    risky = resolve.risky_pairs(*_token_links(spark, sf_dir))
    parts = [f(risky).select(F.lit(k).alias("report"), "a", "b", F.round("name_sim", 6).alias("name_sim"), F.round("meters", 3).alias("meters")) for k, f in (("weak_far", resolve.weak_far), ("low_sim", resolve.low_similarity))]
    return parts[0].unionAll(parts[1])


_PLACED = _VAR.replace("with recursive ", with_fixtures("fx_listing_review") + ", ", 1) + f""", pos as (select place_canonical_id as id, city_slug, coalesce(avg(lat) filter (source = 'yelp'), avg(lat) filter (source = 'wikivoyage'), avg(lat) filter (source = 'reddit')) as lat,
  coalesce(avg(lon) filter (source = 'yelp'), avg(lon) filter (source = 'wikivoyage'), avg(lon) filter (source = 'reddit')) as lon from canon where place_canonical_id is not null group by 1, 2),
hop as (select l.listing_id, p.id, {_HAV.format(a="l.lat", b="l.lon", c="p.lat", d="p.lon").replace("6371000.0", "6378140.0")} as m from fx_listing l join pos p on p.city_slug = l.city_slug where abs(l.lat - p.lat) < 0.0005)"""


@query(_PLACED + " select r.review_id, (select id from hop h where h.listing_id = r.listing_id and m <= 40 order by m, id limit 1) as canonical_id from fx_listing_review r where exists (select 1 from hop h where h.listing_id = r.listing_id and m <= 40)")
def listing_nearest_canonical(spark, sf_dir):
    """Rental reviews by the canonical place nearest to their listing, within 40 m."""
    return graph.reviews_by_radius(fixture(spark, sf_dir, "fx_listing_review"), fixture(spark, sf_dir, "fx_listing"), graph.canonical_coordinates(_canonical(spark, sf_dir)), 40.0)


@query(_PLACED + ", " + _NEAR_SQL.replace("<= 60", "<= 30") + """, via as (select n.listing_id, c.place_canonical_id as id, n.meters from near_p n join canon c on c.place_id = n.place_id where n.listing_id <> 'L7'),
s1 as (select r.review_id, v.id from fx_listing_review r join via v on v.listing_id = r.listing_id where v.meters <= 10),
s2 as (select r.review_id, (select id from hop h where h.listing_id = r.listing_id and m <= 8 order by m, id limit 1) as id from fx_listing_review r where r.review_id not in (select review_id from s1)),
s3 as (select r.review_id, v.id from fx_listing_review r join via v on v.listing_id = r.listing_id where v.meters <= 20 and r.review_id not in (select review_id from s1) and r.review_id not in (select review_id from s2 where id is not null)),
s4 as (select r.review_id, (select id from hop h where h.listing_id = r.listing_id and m <= 25 order by m, id limit 1) as id from fx_listing_review r where r.review_id not in (select review_id from s1 union all select review_id from s2 where id is not null union all select review_id from s3))
select review_id, id as canonical_id from s1 union all select * from s2 where id is not null union all select * from s3 union all select * from s4 where id is not null""")
def rental_reviews_linked(spark, sf_dir):
    """Rental reviews by near place, else by nearest canonical place, then the rest with wider limits."""
    c, l = _canonical(spark, sf_dir), fixture(spark, sf_dir, "fx_listing")
    near = _near(spark, sf_dir, 30.0).where("listing_id <> 'L7'")
    return graph.link_rental_reviews(fixture(spark, sf_dir, "fx_listing_review"), l, near, c, graph.canonical_coordinates(c), (10.0, 8.0, 20.0, 25.0))


@query(with_fixtures("fx_place", "fx_listing", "fx_city") + """, n as (select 'nodes' as kind, 'cities' as item, count(*) as n from fx_city union all select 'nodes', 'places', count(*) from fx_place union all select 'nodes', 'listings', count(*) from fx_listing
  union all select 'edges', 'in_city', count(*) from (select distinct place_id, city_slug from fx_place) union all select 'edges', 'hosts', count(*) from (select distinct host_id, listing_id from fx_listing))
select * from n union all select 'all', 'total', sum(n)::bigint from n""")
def node_edge_summary(spark, sf_dir):
    """Nodes and edges by kind, with a total."""
    f = lambda n: fixture(spark, sf_dir, n)
    return graph.summary({"nodes": {"cities": f("fx_city"), "places": f("fx_place"), "listings": f("fx_listing")}, "edges": {"in_city": graph.edges(f("fx_place"), "place_id", "city_slug"), "hosts": graph.edges(f("fx_listing"), "host_id", "listing_id")}})


@query("select event_type, (props->>'$.k')::int as k, count(*) as n, '{\"k\":' || (props->>'$.k') || '}' as json from events group by 2, 1, 4")
def events_props_json(spark, sf_dir):
    """Properties read from JSON and written as JSON."""
    e = table(spark, sf_dir, "events").withColumn("p", F.from_json("props", "k int"))
    return e.groupBy("event_type", F.col("p.k").alias("k"), F.to_json("p").alias("json")).agg(F.count("*").alias("n")).select("event_type", "k", "n", "json")


@query(with_fixtures("fx_listing") + " select cast(n_nationkey as varchar) as host_id, n_name as name, n_nationkey % 2 = 0 as is_superhost, n_nationkey as listings_count from nation where n_nationkey < 20 union all select distinct cast(host_id as varchar), '-', false, -1 from fx_listing where host_id >= 20")
def host_nodes(spark, sf_dir):
    """Hosts, and stubs for those that only listings name."""
    n = table(spark, sf_dir, "nation").where("n_nationkey < 20")
    key = F.col("n_nationkey").cast("string")
    hosts = n.select(key.alias("host_id"), F.col("n_name").alias("host_name"), F.when(F.col("n_nationkey") % 2 == 0, "True").otherwise("f").alias("host_is_superhost"), key.alias("host_listings_count"), F.lit("").alias("host_total_listings_count"))
    l = fixture(spark, sf_dir, "fx_listing").withColumn("host_id", F.col("host_id").cast("string"))
    return graph.host_nodes(hosts, l).select("host_id", F.coalesce("name", F.lit("-")).alias("name"), F.coalesce("is_superhost", F.lit(False)).alias("is_superhost"), F.coalesce("listings_count", F.lit(-1)).alias("listings_count"))


@query(with_fixtures("fx_place") + " select source, city_slug, count(*) as n, count(*) filter (ord % 4 = 0) as dropped from fx_place group by 1, 2")
def dropped_rows(spark, sf_dir):
    """Rows and dropped rows by source and city."""
    p = fixture(spark, sf_dir, "fx_place")
    return diagnostics.dropped(p, p.where("ord % 4 <> 0"), "place_id", "source", "city_slug")


@query()
def fuzzy_best_match(spark, sf_dir):
    """Places without coordinates take those of the most similar name of their city (tested against brute force: SQL has no such similarity)."""
    p = fixture(spark, sf_dir, "fx_place").withColumn("city_hint", F.col("city_slug"))
    none = F.lit(None).cast("double")
    missing = p.where("source = 'reddit'").withColumns({"lat": none, "lon": none, "name": F.concat("name", F.when(F.col("ord") % 2 == 0, F.lit("s")).otherwise(F.lit(" hall")))})
    return resolve.enrich_coordinates(missing, [p.where("source = 'yelp'"), p.where("source = 'wikivoyage'")]).select("place_id", "lat", "lon", "type", "address")


@query(with_fixtures("fx_city", "fx_place") + """, s as (select distinct city_slug from fx_place order by 1 limit 3)
select s.city_slug, count(p.place_id) as guide_rows, coalesce(sum((p.lat between min_lat and max_lat and p.lon between min_lon and max_lon)::int), 0)::bigint as confirmed from s left join fx_place p on p.city_slug = s.city_slug and p.source = 'wikivoyage' left join fx_city c on c.slug = s.city_slug group by 1""")
def assignment_probe(spark, sf_dir):
    """Guide rows of the first cities, and those that lie in their city."""
    c = cities(spark, sf_dir).withColumn("radius_km", F.lit(-1.0))
    return diagnostics.assignment_probe(fixture(spark, sf_dir, "fx_place"), c, 3)


@query("select p_partkey, trim(regexp_replace(lower(p_name || ' / ' || p_type), '[^a-z0-9]+', '-', 'g'), '-') as slug from part")
def plain_slugs(spark, sf_dir):
    """Slugs without accents and marks."""
    return table(spark, sf_dir, "part").select("p_partkey", text.plain_slug(F.concat("p_name", F.lit(" / "), "p_type")).alias("slug"))


@query(with_fixtures("fx_place_review", "fx_place", "fx_city") + """ select sha1(r.place_id || '|' || scraped_at || '|' || left(text, 120) || '|') as id, 'yelp' as source, r.place_id, coalesce(c.slug, '-') as city_slug, rating::double as rating, text, scraped_at, coalesce(p.lat, 0) as lat, coalesce(p.lon, 0) as lon, coalesce(p.name, '-') as place_name, coalesce(address, '-') as address
from fx_place_review r left join (select * from fx_place where ord % 7 <> 0) p on p.place_id = r.place_id left join fx_city c on p.lat between min_lat and max_lat and p.lon between min_lon and max_lon where r.source = 'yelp' and trim(text) <> ''""")
def rag_reviews_export(spark, sf_dir):
    """The older export: reviews with a text, of known places or not, by the city in whose box the place lies."""
    r = fixture(spark, sf_dir, "fx_place_review").where("source = 'yelp'").select("place_id", F.col("rating").cast("double").alias("rating"), "text", "scraped_at")
    p = fixture(spark, sf_dir, "fx_place").where("ord % 7 <> 0").select("place_id", "name", "address", "lat", "lon", F.col("type").alias("city"))
    out = reviews.rag_reviews(r, p, cities(spark, sf_dir), "yelp")
    return out.na.fill("-", ["city_slug", "place_name", "address"]).na.fill(0.0, ["lat", "lon"])
