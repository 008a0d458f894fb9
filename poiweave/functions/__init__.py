"""Scalar functions, and their registration under SQL names."""

from __future__ import annotations

from pyspark.sql import SparkSession

from poiweave.functions import fuzzy, text


def register(spark: SparkSession) -> None:
    """Make the Python-backed functions callable from SQL; the rest as SQL functions with an expression body."""
    for name, f in {
        "ascii_fold": text.ascii_fold, "strip_marks": text.strip_marks, "fuzz_ratio": fuzzy.ratio, "token_sort_ratio": fuzzy.token_sort_ratio,
        "token_set_ratio": fuzzy.token_set_ratio, "partial_ratio": fuzzy.partial_ratio, "match_similarity": fuzzy.match_similarity, "name_similarity": fuzzy.name_similarity, "top_distinct": fuzzy.top_distinct,
    }.items():
        spark.udf.register(name, f)
    spark.sql(
        "create or replace temporary function haversine_m(a double, b double, c double, d double) returns double return "
        "2 * 6371000.0d * asin(sqrt(least(pow(sin(radians(c - a) / 2), 2) + cos(radians(a)) * cos(radians(c)) * pow(sin(radians(d - b) / 2), 2), 1.0d)))"
    )
    spark.sql(
        "create or replace temporary function content_jaccard(a array<string>, b array<string>) returns double return "
        "case when size(a) > 0 and size(b) > 0 then size(array_intersect(a, b)) / size(array_union(a, b)) else 0.0d end"
    )
