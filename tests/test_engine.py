"""Operators without SQL against brute force, goldens of text functions, readers' fallbacks and the command line."""

import csv
import itertools
import json
import math
import re
import sqlite3

import pytest
from pyspark.sql import functions as F

from poiweave import cli
from poiweave.functions import fuzzy, text
from poiweave.operators import resolve, reviews, spatial
from poiweave.plans import catalog
from poiweave.sources import files, wikidump
from tests.conftest import DATA


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def ratio(a, b):
    return 200 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_sort(a, b):
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a, b):
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, d1, d2 = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not d1 or not d2):
        return 100.0
    left, right = (f"{both} {d}".strip() for d in (d1, d2))
    distance = len(d1) + len(d2) - 2 * lcs(d1, d2)
    options = [100 - 100 * distance / (len(left) + len(right))]
    if both:
        options += [100 - 100 * (len(s) - len(both)) / (len(both) + len(s)) for s in (left, right)]
    return max(options)


def partial(a, b):
    """The best ratio of the shorter against windows of the longer, up to its length and cut at the ends."""
    if not a or not b:
        return 0.0
    windows = lambda s, n: {s[max(0, k) : k + n] for k in range(1 - n, len(s))}
    one = lambda s, t: max(ratio(s, w) for w in windows(t, len(s)))
    return max(one(a, b), one(b, a)) if len(a) == len(b) else one(*sorted((a, b), key=len))


def tokens(name):
    out = []
    for t in re.sub(r"[^a-z0-9]+", " ", name.lower()).split():
        if len(t) >= 3:
            t = t[:-3] + "y" if t.endswith("ies") and len(t) > 4 else t[:-2] if t.endswith("es") and len(t) > 3 else t[:-1] if t.endswith("s") and len(t) > 3 else t
            if t not in text.STOP_WORDS:
                out.append(t)
    return set(out)


def test_full_links_match_brute_force(spark):
    """Every pair of places, with similarities by dynamic programming and the rule spelt out."""
    places = [r.asDict() for r in catalog.fixture(spark, DATA, "fx_place").collect()]
    want = {}
    for a, b in itertools.combinations(sorted(places, key=lambda p: p["ord"]), 2):
        if a["city_slug"] != b["city_slug"]:
            continue
        m = math.hypot((a["lat"] - b["lat"]) * 111_320, (a["lon"] - b["lon"]) * 40_075_000 * math.cos(math.radians((a["lat"] + b["lat"]) / 2)) / 360)
        if m > 130:
            continue
        x, y = (re.sub(r"[^a-z0-9]+", " ", p["name"].lower()).strip() for p in (a, b))
        s, ta, tb = max(token_set(x, y), token_sort(x, y), partial(x, y)) / 100, tokens(x), tokens(y)
        cj = len(ta & tb) / len(ta | tb) if ta and tb else 0.0
        short, long = sorted((" ".join(sorted(t)) for t in (ta, tb)), key=len)
        inside, kind = len(short) >= 3 and short in long, bool(ta & tb & set(text.GENERIC_WORDS))
        far = 130 if (ta | tb) & set(text.AREAL_WORDS) else 120
        if a["source"] != b["source"]:
            ok = (m <= 65 and (s >= 0.34 or inside or cj >= 0.55)) or (m <= 95 and (s >= 0.46 or cj >= 0.5 or (kind and cj >= 0.4))) or (m <= far and kind and (cj >= 0.5 or s >= 0.52))
        else:
            ok = (m <= 25 and (s >= 0.62 or inside or cj >= 0.65)) or (m <= 40 and s >= 0.72 and cj >= 0.5)
        if ok:
            want[a["place_id"], b["place_id"]] = s
    got = {(r.a, r.b): r.name_sim for r in catalog.QUERIES["er_links_full"](spark, DATA).collect()}
    assert got == pytest.approx(want, abs=1e-9) and len(want) > 5


def test_best_match_is_brute_force(spark):
    places = [r.asDict() for r in catalog.fixture(spark, DATA, "fx_place").collect()]
    similarity = lambda a, b: max(token_set(a, b), ratio(a, b), token_sort(a, b)) / 100
    want = {}
    for p in (p for p in places if p["source"] == "reddit"):
        name, found = p["name"] + ("s" if p["ord"] % 2 == 0 else " hall"), (None, None)
        for source in ("yelp", "wikivoyage"):
            scored = [(-similarity(name, k["name"]), k["ord"], (k["lat"], k["lon"])) for k in places if k["source"] == source and k["city_slug"] == p["city_slug"]]
            if scored and found[0] is None and -min(scored)[0] >= 0.86:
                found = min(scored)[2]
        want[p["place_id"]] = found
    got = {r.place_id: (r.lat, r.lon) for r in catalog.QUERIES["fuzzy_best_match"](spark, DATA).collect()}
    assert got == want and {x is None for x, _ in want.values()} == {True, False}


def test_best_match_in_blocks(spark, monkeypatch):
    want = sorted(catalog.QUERIES["fuzzy_best_match"](spark, DATA).collect())
    monkeypatch.setattr(resolve, "BLOCK_ROWS", 3)
    assert sorted(catalog.QUERIES["fuzzy_best_match"](spark, DATA).collect()) == want


def test_pairs_that_are_skipped_cannot_match(spark):
    names = ["centrale", "central", "a b a b a b", "b a", "old town hall", "oldtownhall", "x", "xy", "town town town", "stadt", "a", ""]
    pairs = [(a, b) for a in names for b in names]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", resolve.may_be_similar(F.col("a"), F.col("b"), 0.86).alias("may")).collect()
    assert all(r.may or not r.a or not r.b or fuzzy.name_score(r.a, r.b) < 0.86 for r in rows) and not all(r.may for r in rows)


def test_distinct_texts(spark):
    rows = [(c, t) for c, ts in {1: ["the old town hall", "old town hall the", "market square", "market", ""], 2: ["a b c", "a b d", "x y z"], 3: ["same", "same"], 4: ["bb aa", "aa bb", "cc dd"]}.items() for t in ts]
    want = {}
    for c in {c for c, _ in rows}:
        kept = []
        for t in sorted((t for k, t in rows if k == c and t), key=lambda t: (-len(t), t)):
            if len(kept) < 2 and all(token_set(t, o) < 90 for o in kept):
                kept.append(t)
        want |= {(c, i): t for i, t in enumerate(kept)}
    df = spark.createDataFrame([*rows, (5, None)], "key int, text string")
    assert {(r.key, r.idx): r.text for r in reviews.distinct_texts(df, ["key"], "text").collect()} == want
    listed = df.where("text is not null").groupBy("key").agg(F.collect_list("text").alias("t")).select("key", fuzzy.top_distinct("t").alias("t")).collect()
    assert {(r.key, i): t for r in listed for i, t in enumerate(r.t)} == want


def test_snippets_query(spark):
    own = {}
    for r in spark.read.parquet(f"{DATA}/conversations.parquet").collect():
        own.setdefault(r.conv_id, []).append(r.text)
    some = sorted(own)[:12]
    want = {}
    for c in some:
        kept = []
        for t in sorted((t for t in own[c] if t), key=lambda t: (-len(t), t)):
            if len(kept) < 2 and all(token_set(t, o) < 90 for o in kept):
                kept.append(t)
        want |= {(c, i): t for i, t in enumerate(kept)}
    got = catalog.QUERIES["distinct_snippets"](spark, DATA).where(F.col("conv_id").isin(some)).collect()
    assert {(r.conv_id, r.idx): r.text for r in got} == want


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_text_goldens(spark):
    titles = {"Lake district": ["lake district", "lake"], "Lake-district": ["lake-district", "lake-"], "Lakedistrict": ["lakedistrict"], "County": ["county"], "A (b) (c)": ["a (b) (c)", "a (b)"], "": [], "É / x": ["e / x", "e"]}
    got = one(spark, *[text.title_candidates(F.lit(t)) for t in titles])
    assert list(got) == list(titles.values())
    wiki = {"[[]] {{}} x": "[[]] {{}} x", "[[|x]]": "|x", "[[a|]]": "a|", "[[a|b]] [[c]] {{d|e}}f": "b c f", "{{a}}  \n b": "b"}
    assert list(one(spark, *[text.clean_wiki_text(F.lit(t)) for t in wiki])) == list(wiki.values())
    r = one(spark, text.title_case(F.lit("new-york_city")), text.slug_path(F.lit("a/b\\c")), text.fallback_text(F.lit(None).cast("string"), F.lit("Str 1")), text.street_tokens(F.lit("Haupt Str. 5")))
    assert tuple(r) == ("New York City", "a-b-c", "Str 1", ["haupt", "strasse"])


def test_wiki_templates():
    page = "{{see|name=A {{x|y}}|lat=1}} {{ Eat |Name = B | name=C|=d}} {{{do|a=b}}} {{buy}} {{drink|x=1} {{sleep|a={b|c=[[d|e]]}}"
    assert wikidump.templates("{{see|name=A {{x|y}}|lat=1}}")[0] == ("see", {"name": "A {{x"})
    assert wikidump.templates("{{see|name=A {{x|y}}|lat=1|a=[[b|c]]}}", nested=True) == [("see", {"name": "A {{x|y}}", "lat": "1", "a": "[[b|c]]"})]
    assert wikidump.templates("{{do|a=1|a=2}}{{Other|a=1}}{{|a=1}}{{eat|x}}") == [("do", {"a": "2"}), ("eat", {})]
    # the same as a pattern over the whole page
    for p in (page, "{{see|a=b}}{{do|c=d}}", "{{a|{{see|x=1}}", "{{see|x=1}", "}}{{see|}}", "{{{{see|x=1}}}}", "{{see|x\n=1\n}}"):
        want = [(m[1].strip().lower(), m[2]) for m in re.finditer(r"\{\{([^{}|]+)\|([^}]*)\}\}", p) if m[1].strip().lower() in wikidump.TEMPLATES]
        assert [k for k, _ in wikidump.templates(p)] == [k for k, _ in want], p
        assert list(wikidump.templates(p)) == [(k, {f.split("=", 1)[0].strip().lower(): f.split("=", 1)[1].strip() for f in b.split("|") if "=" in f}) for k, b in want]


def test_wiki_names_and_compressed_dump(spark, tmp_path):
    import bz2

    page = "<mediawiki><page><title>T</title><ns>0</ns><revision><text>{{see|lat=1|long=2}} {{do|title=X|lat=1|lon=2.123455}} {{eat|name= |alt=Y|lat=3|long=4}}</text></revision></page></mediawiki>"
    (tmp_path / "w.xml.bz2").write_bytes(bz2.compress(page.encode()))
    assert {r.name: r.place_id for r in wikidump.load_guide(spark, str(tmp_path / "w.xml.bz2")).collect()} == {"X": "wv:t:x:1.00000,2.12345", "Y": "wv:t:y:3.00000,4.00000"}


def test_rows_that_share_a_key_are_placed_apart(spark):
    c = catalog.cities(spark, DATA)
    points = spark.createDataFrame([("p", 40.005, 10.005), ("p", 42.005, 12.005), ("p", None, 1.0)], "place_id string, lat double, lon double")
    assert sorted((r.lat or 0, r.city_slug) for r in spatial.assign_city(points, c, "place_id").collect()) == [(0, None), (40.005, "region-0"), (42.005, "region-1")]


def test_readers(spark, tmp_path):
    (tmp_path / "d.csv").write_bytes(b'id,comment\r\n1,"x" ,\r\n2,"two\nlines, ""q"""\n3,plain\n')
    rows = files.read_dirty_csv(spark, str(tmp_path / "d.csv"), "id string, comment string").collect()
    assert [(r.id, r.comment) for r in rows][1:3] == [("2", 'two\nlines, "q"'), ("3", "plain")] and rows[0].id == "1"
    assert files.read_or_empty(spark, str(tmp_path / "none.csv"), "a string, b double").count() == 0
    got = files.read_or_empty(spark, str(tmp_path / "d.csv"), "id string, other double")
    assert got.columns == ["id", "other"] and got.where("other is not null").count() == 0
    for slug in ("x", "city_slug=y"):
        (tmp_path / "cities" / slug).mkdir(parents=True)
    (tmp_path / "cities/x/data.csv").write_text("place_id,lat\np1,1.5\n")
    spark.createDataFrame([("p2", 2.5)], "place_id string, lat double").coalesce(1).write.parquet(str(tmp_path / "p"))
    part = next((tmp_path / "p").glob("*.parquet"))
    part.rename(tmp_path / "cities/city_slug=y/data.parquet")
    got = files.read_city_folders(spark, str(tmp_path / "cities"), "place_id string, lat double, city_slug string, name string").collect()
    assert sorted(tuple(r) for r in got) == [("p1", 1.5, "x", None), ("p2", 2.5, "y", None)]
    (tmp_path / "c.json").write_text(json.dumps({"cities": [], "defaults": {"radius_km": "9"}}))
    assert files.read_settings(spark, str(tmp_path / "c.json")) == ({"radius_km": "9"}, {})
    index = spark.createDataFrame([("1", "a", 1), ("1", "b", 2), (None, "c", 3), ("2", " ", 4)], "ID string, City string, ord int")
    assert [tuple(r) for r in reviews.place_index(index, "ord").collect()] == [("1", "b")]
    with pytest.raises(ValueError):
        reviews.place_index(index.drop("City"), "ord")


def test_alias_titles(spark):
    from poiweave.operators import diagnostics

    rows = spark.createDataFrame([("a", "x", 9), ("a", "y", 12), ("b", "z", 8), ("a", "w", 9)], "slug string, title string, n long")
    assert {r.slug: r.titles for r in diagnostics.alias_titles(rows).collect()} == {"a": ["y", "w", "x"], "b": ["z"]}


def test_geocoder_with_cache():
    from poiweave.sources import geocode

    asked = []

    def find(query):
        asked.append(query)
        return {"bbox": [1.0, 2.0, 3.0, 4.0], "center": {"lat": 2.0, "lon": 3.0}} if query == "Wien" else None

    config = {"cities": [{"name": "Vienna", "aliases": ["Wien"], "country": "Austria"}, {"slug": "full", "center": {"lat": 1, "lon": 1}, "bbox": [0, 0, 1, 1]}, {"name": "VIENNA", "center": {"lat": 9, "lon": 9}, "bbox": [1]}, {"name": "Nowhere"}]}
    cache = {}
    assert geocode.fill(config, find, cache) == 2 and list(cache) == ["vienna"]
    assert asked == ["Vienna, Austria", "Wien, Austria", "Vienna", "Wien", "Nowhere", "Nowhere, Europe"]
    assert config["cities"][0]["bbox"] == config["cities"][2]["bbox"] == [1.0, 2.0, 3.0, 4.0] and config["cities"][2]["center"] == {"lat": 9, "lon": 9} and "bbox" not in config["cities"][3]
    assert geocode.fill(config, find, cache, overwrite=True) == 2 and config["cities"][2]["center"]["lat"] == 2.0
    assert geocode.from_answer([{"boundingbox": ["1", "3", "2", "4"], "lat": "2", "lon": "3"}]) == cache["vienna"] and geocode.from_answer([]) is None


def read(folder):
    out = []
    for p in sorted(folder.glob("part*")):
        out += list(csv.DictReader(p.open()))
    return out


def test_command_line(spark, tmp_path, monkeypatch):
    """All commands over a small world: one city, three sources, rentals with reviews."""
    monkeypatch.setattr(cli, "session", lambda: spark)
    (tmp_path / "c.json").write_text(json.dumps({"cities": [{"slug": "wien", "name": "Wien", "center": {"lat": 48.2, "lon": 16.3}, "bbox": [48.0, 16.0, 48.4, 16.6]}]}))
    with sqlite3.connect(tmp_path / "p.db") as db:
        db.execute("create table yelp_businesses(business_id, business_name, business_alias, business_address, city, latitude, longitude)")
        db.executemany("insert into yelp_businesses values (?,?,?,?,?,?,?)", [("1", "Cafe Central", "c", "A 1", "Wien", 48.2, 16.3), ("2", "Far away", "f", "B", "Wien", 10.0, 10.0)])
        db.execute("create table reddit_pois(canonical, name, city, confidence, latitude, longitude)")
        db.executemany("insert into reddit_pois values (?,?,?,?,?,?)", [("cc", "Café Central", "wien", 1, None, None), ("zz", "Elsewhere", "wien", 1, None, None)])
        db.execute("create table yelp_business_reviews(business_id, rating, review_text, scraped_at)")
        db.executemany("insert into yelp_business_reviews values (?,?,?,?)", [("1", 4, "good\r\ncoffee", "2024-01-01"), ("9", 1, "unknown place", "2024-01-01")])
        db.execute("create table reddit_poi_reviews(poi, rating, review_text, scraped_at)")
        db.execute("insert into reddit_poi_reviews values ('cc', null, 'nice', '2024-02-02')")
    (tmp_path / "w.xml").write_text("<mediawiki><page><title>Wien</title><ns>0</ns><revision><text>{{eat|name=Cafe Central|lat=48.2001|long=16.3|content=A [[cafe|coffee house]]}}</text></revision></page></mediawiki>")
    db, out = str(tmp_path / "p.db"), tmp_path / "out"
    cli.main(["places", "--config", str(tmp_path / "c.json"), "--out-dir", str(out), "--places-db", db, "--mentions-db", db, "--wiki-xml", str(tmp_path / "w.xml"), "--reviews-db", db])
    places = read(out / "places")
    assert {p["place_id"] for p in places} == {"yelp:1", "reddit:cc", "wv:wien:cafe-central:48.20010,16.30000"} and {p["place_canonical_id"] for p in places} == {"cafe-central::wien"} or {p["place_canonical_id"] for p in places} == {"caf-central::wien"}
    assert len(read(out / "place_links")) == 3 and len(read(out / "place_canonical_map")) == 3 and len(read(out / "places_raw_csv")) == 4
    assert {r["source"]: (r["n"], r["dropped"]) for r in read(out / "dropped")} == {"yelp": ("2", "1"), "reddit": ("1", "0"), "wikivoyage": ("1", "0")} and (out / "alias_suggestions").is_dir()
    told = spark.read.json(str(out / "place_reviews/*")).collect()
    assert sorted(r.source for r in told) == ["reddit", "wikivoyage", "yelp"]

    (tmp_path / "rentals").mkdir()
    (tmp_path / "rentals/a_listings.csv").write_text('id,name,latitude,longitude,host_id,price,host_name,host_is_superhost\n11.0,Flat,48.2002,16.3001,7.0,"$1,200.00",Ann,t\n12,Far,1.0,1.0,8,$1,Bob,f\n')
    (tmp_path / "rentals/a_reviews.csv").write_text('listing_id,id,date,reviewer_id,reviewer_name,comments\n11,100,2024-01-01,5,Cy,"two\nlines"\n99,101,2024-01-01,5,Cy,lost\n')
    rent = tmp_path / "rent"
    cli.main(["rentals", "--config", str(tmp_path / "c.json"), "--rentals-dir", str(tmp_path / "rentals"), "--out-dir", str(rent), "--places", str(out / "places_raw")])
    assert [r["listing_id"] for r in read(rent / "listings")] == ["11"] and len(read(rent / "reviews")) == 1 and len(read(rent / "listing_city")) == 1
    assert [(r["review_id"], r["city_slug"]) for r in read(rent / "review_near_place")] == [("airbnb:100", "wien")]

    graph = tmp_path / "graph"
    cli.main(["graph", "--config", str(tmp_path / "c.json"), "--exports", str(out), "--rentals", str(rent), "--out-dir", str(graph)])
    summary = {(r["kind"], r["item"]): int(r["n"]) for r in read(graph / "summary")}
    assert summary["nodes", "canonical_places"] == 1 and summary["edges", "variant_of"] == 3 and summary["edges", "lifted"] == 3 and summary["edges", "lifted_rentals"] == 1 and summary["all", "total"] == sum(n for k, n in summary.items() if k[0] != "all")
    cards = spark.read.json(str(graph / "poi_cards")).collect()
    assert len(cards) == 1 and cards[0].wv and len(cards[0].quotes) == 2

    spot = tmp_path / "spot"
    cli.main(["spotcheck", "--places", str(out / "places_raw"), "--links", str(out / "none"), "--out-dir", str(spot), "--city", "WIEN", "--ignored"])
    assert len(read(spot / "promote_suggested")) >= 0 and {p.name for p in spot.iterdir()} >= {"cross_borderline", "cross_riskiest", "same_weak_far", "same_low_sim", "promote_suggested", "sources"}


def test_written_tables_make_few_files(spark):
    """A table has its data files only: every other file starts a process that holds the JVM's memory for a moment."""
    import os

    from poiweave.storage import discard, materialise

    table = materialise(spark.range(100).repartition(3), "few")
    (folder,) = {f.rsplit("/", 1)[0].removeprefix("file:").replace("//", "") for f in table.inputFiles()}
    assert table.count() == 100 and all(name.startswith("part-") for name in os.listdir(folder)) and len(os.listdir(folder)) == 3
    discard(table)
    assert not os.path.exists(folder)


def test_the_driver_gives_memory_back(spark, monkeypatch):
    """What the driver no longer needs leaves its heap when a table is written, but not at every one."""
    from poiweave import storage

    runtime, calls = spark._jvm.java.lang.Runtime.getRuntime(), []
    waste = [spark.sparkContext._gateway.new_array(spark._jvm.long, 6_000_000) for _ in range(4)]
    before = runtime.totalMemory() - runtime.freeMemory()
    for array in waste:
        spark.sparkContext._gateway.detach(array)
    del waste, array
    monkeypatch.setitem(storage._given, "at", float("-inf"))
    real = storage.give_back
    monkeypatch.setattr(storage, "give_back", lambda s: calls.append(1) or real(s))
    storage.materialise(spark.range(3), "one")
    assert runtime.totalMemory() - runtime.freeMemory() < before - 150_000_000
    storage.materialise(spark.range(3), "two")
    assert len(calls) == 1


def test_nearest_counts_order_as_nanometres(spark):
    """As its SQL: a place that is nearer by less than its number of nanometres does not win."""
    at = lambda metres: 40.0 + metres / 111_320.0
    left = spark.createDataFrame([("L", 40.0, 10.0, "c")], "listing_id string, lat double, lon double, city_slug string")
    right = spark.createDataFrame([("first", 1, at(5.0), 10.0, "c"), ("later", 100_000, at(4.99999), 10.0, "c")], "place_id string, ord long, lat double, lon double, city_slug string")
    (row,) = spatial.nearest_within(left, right, 60.0, "listing_id", "place_id", "ord").collect()
    assert row.place_id == "first" and row.meters == pytest.approx(4.99999, abs=1e-7)


def _operators(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_grid_joins_are_neither_broadcast_nor_sorted_for_the_best(spark):
    near, any_near = catalog.QUERIES["nearest_place"](spark, DATA), catalog.QUERIES["listings_near_any_place"](spark, DATA)
    pairs = catalog.QUERIES["spatial_candidate_pairs"](spark, DATA)
    assert all("SortMergeJoin" in _operators(x) for x in (near, any_near, pairs)) and "BroadcastNestedLoopJoin" not in _operators(any_near)
    assert "LeftSemi" in _operators(any_near) and "BroadcastHashJoin" not in _operators(pairs)
    assert "min_by" in _operators(near) and "SortAggregate(key=[listing_id" not in _operators(near)


def test_a_name_is_answered_once_a_city(spark):
    """Ten rows of a name against ten of another are one pair."""
    schema = "place_id string, ord long, name string, city_hint string, lat double, lon double, type string, address string"
    asked = spark.createDataFrame([(f"m{k}", k, "old town hall", "c", None, None, None, None) for k in range(10)], schema)
    known = spark.createDataFrame([(f"k{k}", 20 - k, "town hall old", "C", float(k), 1.0, "t", "a") for k in range(10)], schema)
    out = resolve.enrich_coordinates(asked, [known])
    assert {r.lat for r in out.collect()} == {9.0} and "min_by" in _operators(out)
