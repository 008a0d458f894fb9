import math

import pytest
from pyspark.sql import functions as F

from poiweave.functions import fuzzy, geo, ids, text


@pytest.mark.parametrize(
    "a, b, want",
    [
        ("powder tower", "explore powder tower", (75, 75, 100, 100)), ("powder tower", "powder gate", (78.2609, 52.1739, 78.2609, 84.2105)),
        ("cafe central", "central cafe", (58.3333, 100, 100, 73.6842)), ("old town hall", "town hall tower", (64.2857, 78.5714, 81.8182, 81.8182)),
        # equal lengths: both directions are tried, the window "red a" of the first gives 71.4286
        ("red anvil", "red plate", (55.5556, 55.5556, 55.5556, 71.4286)), ("new anvil", "old anvil", (66.6667, 66.6667, 71.4286, 80)), ("ab", "abc", (80, 80, 80, 100)),
    ],
)
def test_similarities(a, b, want):
    got = [f(a, b) for f in (fuzzy.ratio_of, fuzzy.token_sort_of, fuzzy.token_set_of, fuzzy.partial_of)]
    assert got == pytest.approx(want, abs=1e-3)
    assert [f(b, a) for f in (fuzzy.ratio_of, fuzzy.token_sort_of, fuzzy.token_set_of)] == pytest.approx(want[:3], abs=1e-3)


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_text(spark):
    r = one(
        spark, text.match_name(F.lit("Großmarkt")), text.normalize_name(F.lit("Großmarkt")), text.normalize_name(F.lit("Haupt-Str. 5")), text.normalize_name(F.lit("Stephans-Pl. 3")), text.name_slug(F.lit("Café  Central!")),
        text.canonical_id(F.lit(" 123.0 ")), text.canonical_id(F.lit("")), text.parse_price(F.lit("$1,234.50")), text.first_number(F.lit("48.2°N")), text.first_number(F.lit(".5")), text.clean_wiki_text(F.lit("[[A|B]] and [[C]] {{x|y}}  z")),
    )
    assert tuple(r) == ("gro markt", "gromarkt", "haupt strasse 5", "stephans platz 3", "caf-central", "123", None, 1234.5, 48.2, 5.0, "B and C z")
    r = one(spark, *[text.title_candidates(F.lit(t)) for t in ("Paris/1st arrondissement", "Porto (Portugal)", "Rome/Trevi")])
    assert r[0] == ["paris/1st arrondissement", "paris"] and r[1] == ["porto (portugal)", "porto"] and r[2] == ["rome/trevi", "rome"]


def test_ids_and_distance(spark):
    r = one(spark, ids.sha1_id(F.lit("yelp:1"), F.lit("2024-01-01"), F.lit("hi")), ids.sha1_id(F.lit("wv:x"), F.lit("t")), ids.hash_id(F.lit("1"), F.lit("2024"), F.lit("hi")), geo.haversine_m(F.lit(48.2), F.lit(16.3), F.lit(48.3), F.lit(16.4)))
    assert r[:3] == ("7193a5ea3e7a5d7918bff9d1196a8e9342a5d9a7", "5e21839a0280a83e2c3ac7c4b325303e6a1ec999", "f08520571b5d198e8e7a2ec846549c84354b237d")
    assert math.isclose(r[3], 13359.124, abs_tol=1e-3)


def test_registered_in_sql(spark):
    from poiweave.functions import register

    register(spark)
    r = spark.sql("select haversine_m(48.2d, 16.3d, 48.3d, 16.4d), content_jaccard(array('a'), array('a', 'b')), token_set_ratio('a b', 'b a')").first()
    assert r[0] == pytest.approx(13359.124, abs=1e-3) and r[1] == 0.5 and r[2] == 100.0
