"""MediaWiki dumps: pages by Spark's XML reader, listing templates by a brace-matching parser."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from poiweave.functions import text
from poiweave.session import ship_package

#: Templates that list a place, and the fields that may hold a property, the first that is filled counts.
TEMPLATES = ["see", "do", "eat", "drink", "sleep", "buy", "listing", "marker"]
NAME_FIELDS = ["name", "alt", "title"]
LATITUDE_FIELDS, LONGITUDE_FIELDS = ["lat"], ["long", "lon"]
ADDRESS_FIELDS = ["address", "addr", "street", "directions"]
TEXT_FIELDS = ["content", "description", "desc", "summary", "alt"]
_KIND = ArrayType(StructType([StructField("template", StringType()), StructField("fields", MapType(StringType(), StringType()))]))


def _split(body: str, nested: bool) -> list[str]:
    """A template's body at its bars; with ``nested``, not at those inside inner braces or links."""
    if not nested:
        return body.split("|")
    parts, depth, at = [], 0, 0
    for m in re.finditer(r"\{\{|\[\[|\}\}|\]\]|\|", body):
        depth += {"{{": 1, "[[": 1, "}}": -1, "]]": -1, "|": 0}[m[0]]
        if m[0] == "|" and depth == 0:
            parts.append(body[at : m.start()])
            at = m.end()
    return [*parts, body[at:]]


def _bodies(wikitext: str, nested: bool) -> Iterator[str]:
    """What stands between the braces of templates: at any depth, or up to the first closing brace after a name and a bar."""
    if nested:
        opened: list[int] = []
        for m in re.finditer(r"\{\{|\}\}", wikitext):
            if m[0] == "{{":
                opened.append(m.end())
            elif opened:
                yield wikitext[opened.pop() : m.start()]
        return
    at = wikitext.find("{{")
    while at >= 0:
        bar, close = wikitext.find("|", at), wikitext.find("}", at)
        name = wikitext[at + 2 : bar]
        if 0 <= bar < close and name and "{" not in name and wikitext.startswith("}}", close):
            yield wikitext[at + 2 : close]
            at = wikitext.find("{{", close + 2)
        else:
            at = wikitext.find("{{", at + 1)


def templates(wikitext: str, nested: bool = False) -> list[tuple[str, dict[str, str]]]:
    """(template, fields) of the listing templates of a page; of repeated fields the last counts."""
    out = []
    for body in _bodies(wikitext, nested):
        name, *fields = _split(body, nested)
        if (kind := name.strip().lower()) in TEMPLATES:
            out.append((kind, {k.strip().lower(): v.strip() for k, sign, v in (f.partition("=") for f in fields) if sign}))
    return out


def _parser(nested: bool):
    @F.pandas_udf(_KIND)
    def parse(pages: pd.Series) -> pd.Series:
        return pages.map(lambda t: [{"template": k, "fields": f} for k, f in templates(t or "", nested)])

    return parse


@F.pandas_udf(StringType())
def _place_id(title: pd.Series, name: pd.Series, lat: pd.Series, lon: pd.Series) -> pd.Series:
    # the two numbers are rounded as Python does, half-even on the exact binary value
    return pd.Series([f"wv:{t}:{n}:{a:.5f},{o:.5f}" for t, n, a, o in zip(title, name, lat, lon)], dtype="object")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """title, ns, wikitext of article pages (.xml or .bz2): no redirects, no other name space, no empty text."""
    schema = "title string, ns string, redirect struct<_title:string>, revision struct<text:string>"
    pages = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    return pages.where("(ns is null or ns = '0') and redirect is null and trim(revision.text) <> ''").select("title", "ns", F.col("revision.text").alias("wikitext"))


def listings_of(pages: DataFrame, nested: bool = False) -> DataFrame:
    """Places listed in pages (title, wikitext): place_id, source, name, lat, lon, type, address, city_hint, desc. Rows without name or
    coordinates go; a template without a name of its own has none."""
    ship_package(pages.sparkSession)
    found = pages.select("title", F.explode(_parser(nested)("wikitext")).alias("t"))
    field = lambda names: F.coalesce(*[text.null_if_blank(F.col("t.fields")[n]) for n in names])
    rows = found.select(
        "title", field(NAME_FIELDS).alias("name"), text.first_number(field(LATITUDE_FIELDS)).alias("lat"), text.first_number(field(LONGITUDE_FIELDS)).alias("lon"), F.col("t.template").alias("type"),
        field(ADDRESS_FIELDS).alias("address"), F.col("title").alias("city_hint"), field(TEXT_FIELDS).alias("desc"),
    ).na.drop(subset=["lat", "lon", "name"])
    pid = _place_id(text.name_slug(F.col("title")), text.name_slug(F.col("name")), "lat", "lon")
    return rows.select(pid.alias("place_id"), F.lit("wikivoyage").alias("source"), "name", "lat", "lon", "type", "address", "city_hint", "desc")


def load_guide(spark: SparkSession, path: str, nested: bool = False) -> DataFrame:
    """Places listed in the guide pages of a dump."""
    return listings_of(read_pages(spark, path), nested)
