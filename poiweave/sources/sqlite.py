"""A Python data source for SQLite tables, and the two place loaders that use it.

``spark.read.format("sqlite").option("path", file).option("query", sql)`` reads a query in one task;
``option("table", name)`` with ``option("partitions", n)`` and perhaps ``option("where", condition)`` reads rowid ranges in
parallel, as the loaders do. The file must be readable on every executor.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from poiweave.functions import ids
from poiweave.session import ship_package


class _Range(InputPartition):
    def __init__(self, low: int | None, high: int | None):
        super().__init__((low, high))
        self.low, self.high = low, high


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.options = schema, options

    def partitions(self) -> list[_Range]:
        table, n = self.options.get("table"), int(self.options.get("partitions", 1))
        if not table or n <= 1:
            return [_Range(None, None)]
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as db:
            low, high = db.execute(f'select min(rowid), max(rowid) from "{table}"').fetchone()
        if low is None:
            return [_Range(None, None)]
        step = (high - low) // n + 1
        return [_Range(low + k * step, low + (k + 1) * step) for k in range(n) if low + k * step <= high]

    def read(self, part: _Range) -> Iterator[tuple]:
        kinds = [f.dataType.typeName() for f in self.schema.fields]
        cast = {"string": str, "double": float, "long": int, "integer": int}
        names = ", ".join(f'"{f.name}"' for f in self.schema.fields)
        sql = self.options.get("query") or f'select {names} from "{self.options["table"]}" where ({self.options.get("where") or "1 = 1"})'
        if part.low is not None:
            sql += f" and rowid >= {part.low} and rowid < {part.high}"
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as db:
            for row in db.execute(sql):
                yield tuple(None if v is None else cast[k](v) for v, k in zip(row, kinds))


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        raise ValueError("give a schema: SQLite columns have no fixed type")

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(schema, dict(self.options))


#: Tasks that read a table.
PARTITIONS = 16


def read_sqlite(spark: SparkSession, path: str, schema: str, query: str | None = None, table: str | None = None, partitions: int = PARTITIONS, where: str = "") -> DataFrame:
    ship_package(spark)
    spark.dataSource.register(SqliteSource)
    reader = spark.read.format("sqlite").schema(schema).option("path", path)
    return (reader.option("query", query) if query else reader.option("table", table).option("partitions", partitions).option("where", where)).load()


def load_businesses(spark: SparkSession, path: str) -> DataFrame:
    """Restaurants with name and coordinates."""
    columns = "business_id string, business_name string, latitude double, longitude double, business_address string, city string"
    rows = read_sqlite(spark, path, columns, table="yelp_businesses", where="latitude is not null and longitude is not null and business_name is not null")
    return rows.select(
        ids.prefixed("yelp", F.col("business_id")).alias("place_id"), F.lit("yelp").alias("source"), F.col("business_name").alias("name"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), F.lit("restaurant").alias("type"),
        F.col("business_address").alias("address"), F.col("city").alias("city_hint"),
    )


def load_mentions(spark: SparkSession, path: str) -> DataFrame:
    """Places named in discussions; coordinates may be missing."""
    rows = read_sqlite(spark, path, "canonical string, name string, latitude double, longitude double, city string", table="reddit_pois")
    none = F.lit(None).cast("string")
    return rows.select(
        ids.prefixed("reddit", F.col("canonical")).alias("place_id"), F.lit("reddit").alias("source"), "name", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), none.alias("type"), none.alias("address"), F.col("city").alias("city_hint")
    )


def load_reviews(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """place_id, rating, text, scraped_at of ``yelp`` or ``reddit`` reviews."""
    table, key = {"yelp": ("yelp_business_reviews", "business_id"), "reddit": ("reddit_poi_reviews", "poi")}[kind]
    rows = read_sqlite(spark, path, f"{key} string, rating string, review_text string, scraped_at string", table=table)
    return rows.select(ids.prefixed(kind, F.col(key)).alias("place_id"), F.col("rating").try_cast("double").alias("rating"), F.col("review_text").alias("text"), "scraped_at")
