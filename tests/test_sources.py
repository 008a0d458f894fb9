import json
import sqlite3

import pytest

from poiweave.operators import listings, resolve, spatial
from poiweave.sources import files, sqlite, wikidump

WIKI = """<mediawiki xmlns="http://x/"><page><title>Paris</title><ns>0</ns><revision><text>{{see|name=Louvre|lat=48.86|long=2.33|content=Museum}} {{unknown|a=b}}</text></revision></page>
<page><title>Wien</title><ns>0</ns><revision><text>{{eat|alt=Chez X|lat=48.2N|lon=16.3}}</text></revision></page>
<page><title>Talk</title><ns>1</ns><revision><text>{{see|name=No|lat=1|long=1}}</text></revision></page>
<page><title>Gone</title><ns>0</ns><redirect title="Paris"/><revision><text>{{see|name=No|lat=1|long=1}}</text></revision></page></mediawiki>"""


def test_wiki(spark, tmp_path):
    (tmp_path / "w.xml").write_text(WIKI)
    rows = {r.name: r for r in wikidump.load_guide(spark, str(tmp_path / "w.xml")).collect()}
    assert set(rows) == {"Louvre", "Chez X"} and rows["Louvre"].place_id == "wv:paris:louvre:48.86000,2.33000" and rows["Louvre"].desc == "Museum"
    assert wikidump.templates("{{see|name=A {{x|y}}|lat=1}}", nested=True) == [("see", {"name": "A {{x|y}}", "lat": "1"})]


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "p.db")
    with sqlite3.connect(path) as db:
        db.execute("create table yelp_businesses(business_id, business_name, business_alias, business_address, city, latitude, longitude)")
        db.executemany("insert into yelp_businesses values (?,?,?,?,?,?,?)", [("1", "Cafe Central", "c", "A 1", "Wien", 48.2, 16.3), ("2", "No place", "n", "B", "Wien", None, 16.3)])
        db.execute("create table reddit_pois(canonical, name, city, confidence, latitude, longitude)")
        db.executemany("insert into reddit_pois values (?,?,?,?,?,?)", [("cc", "Café Central", "wien", 1, None, None), ("zz", "Elsewhere", "wien", 1, None, None)])
    have = sqlite.load_businesses(spark, path)
    assert [r.place_id for r in have.collect()] == ["yelp:1"]
    from pyspark.sql import functions as F

    rich = {r.place_id: r for r in resolve.enrich_coordinates(sqlite.load_mentions(spark, path), [have.withColumn("ord", F.lit(1))]).collect()}
    assert rich["reddit:cc"].lat == 48.2 and rich["reddit:cc"].type == "restaurant" and rich["reddit:zz"].lat is None
    part = sqlite.read_sqlite(spark, path, "canonical string, name string", table="reddit_pois", partitions=2)
    assert part.count() == 2


def test_config_and_regions(spark, tmp_path):
    config = {"cities": [{"slug": "a", "name": "A", "center": {"lat": 10, "lon": 10}, "bbox": [9.9, 9.9, 10.1, 10.1]}, {"slug": "b", "name": "B", "aliases": ["Bee"], "bbox": {"min_lat": 9.9, "min_lon": 9.9, "max_lat": 10.2, "max_lon": 10.2}, "polygon": [[9.9, 9.9], [9.9, 10.0], [10.0, 10.0]]}, {"slug": "c", "name": "C", "center": {"lat": 20, "lon": 20}}]}
    (tmp_path / "c.json").write_text(json.dumps(config, indent=2))
    cities = files.read_cities(spark, str(tmp_path / "c.json"))
    points = spark.createDataFrame([("in_polygon", 9.92, 9.99), ("first_box", 10.05, 9.95), ("second_box", 10.15, 10.15), ("radius", 20.1, 20.0), ("none", 40.0, 40.0), ("null", None, 1.0)], "place_id string, lat double, lon double")
    got = {r.place_id: r.city_slug for r in spatial.assign_city(points, cities, "place_id").collect()}
    assert got == {"in_polygon": "b", "first_box": "a", "second_box": "b", "radius": "c", "none": None, "null": None}
    hinted = spark.createDataFrame([("1", "bee (x)"), ("2", None)], "place_id string, hint string")
    assert {r.place_id: r.city_slug for r in spatial.city_from_hint(hinted, cities, "place_id", "hint").collect()} == {"1": "b", "2": None}
    (tmp_path / "bad.json").write_text("{}")
    with pytest.raises(ValueError):
        files.read_cities(spark, str(tmp_path / "bad.json"))


def test_csv_and_listings(spark, tmp_path):
    (tmp_path / "x_listings.csv").write_text('id,name,latitude,longitude,host_id,price\n123.0,"A\nB",10.0,10.0,7.0,"$1,234.50"\n')
    raw = files.read_csv(spark, files.glob_once(spark, str(tmp_path), "*_listings.csv", "x_*.csv"))
    assert raw.count() == 1
    (tmp_path / "d.csv").write_text('id,comment\n1,"x" ,\n')
    (tmp_path / "c.json").write_text(json.dumps({"cities": [{"slug": "a", "name": "A", "center": {"lat": 10, "lon": 10}}]}))
    row = listings.stage_listings(raw, files.read_cities(spark, str(tmp_path / "c.json"))).first()
    assert (row.listing_id, row.host_id, row.price, row.city_slug) == ("123", "7", 1234.5, "a")
    files.write_csv(raw.limit(0), str(tmp_path / "empty"), single=True)
    assert any("id,name" in p.read_text() for p in (tmp_path / "empty").glob("part*"))


def test_stream(spark, tmp_path):
    from poiweave.streaming import ingest

    (tmp_path / "in").mkdir()
    line = {"review_id": "1", "source": "yelp", "place_id": "p", "rating": 4.0, "text": "ok", "scraped_at": "2024-01-01"}
    (tmp_path / "in/a.json").write_text("\n".join(json.dumps(x) for x in (line, line, {**line, "review_id": "2", "place_id": "q"})) + "\nbroken")
    places = spark.createDataFrame([("p", "a")], "place_id string, city_slug string")
    ingest.write_stream(ingest.review_stream(spark, str(tmp_path / "in"), places), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 1 and [(r.city_slug, r.n, r.mean_rating) for r in ingest.daily_counts(out).collect()] == [("a", 1, 4.0)]


def test_unique_keys(spark):
    from poiweave.schemas import assert_unique

    df = spark.createDataFrame([(1, 2), (1, 3)], "a int, b int")
    assert assert_unique(df, "a", "b") is df
    with pytest.raises(ValueError):
        assert_unique(df, "a")


def test_a_written_table_leaves_no_shuffle_files(spark):
    """With many partitions a plan's shuffle files take more disk than its rows; they go when its table is written."""
    import time
    from pathlib import Path

    from pyspark.sql import functions as F

    from poiweave.storage import discard, materialise

    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {str(p) for d in blocks.localDirs() for p in Path(d.getPath()).rglob("shuffle_*")}
    before, counted = files(), spark.range(0, 1000, 1, 20).groupBy((F.col("id") % 10).alias("k")).count()
    table = materialise(counted.join(counted.withColumnRenamed("count", "c"), "k"), "cleaned")
    for _ in range(40):
        if not (left := files() - before):
            break
        time.sleep(0.25)
    assert not left and table.count() == 10
    discard(table)
