"""Mixing sources to target weights by Poisson replication.

The mean repetition rate of a source is its target weight times all rows over its own rows. A
hash-seeded uniform per document is pushed through the inverse Poisson distribution with that mean;
the document is exploded by the count, and the copies are dealt to partitions and sorted by a random
key, which shuffles them globally. The same seed gives the same copies whatever the partitioning.

Results in odd cases: a null source is a source of its own; a source with target weight 0 gives no
rows; sources absent from the targets keep rate 0; repeated rows draw the same count; an empty table
gives no rows; null ids, null, empty and very long texts are copied as they are; columns of a caller that are called
like those made here stay, and the made ones get underscores at their ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiweave.llm.columns import unused
from poiweave.storage import materialise

#: Bytes of cumulative probabilities up to which they are broadcast to the documents; beyond it the join shuffles (AQE splits hot sources).
BROADCAST_BYTES = 8 << 20
SEED = 20240607


def _uniform(seed: int, *columns: str) -> Column:
    """A uniform in [0, 1) with 53 bits, from a hash of the columns."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11).cast("double") / F.lit(float(1 << 53))


def _log_probability(k: Column, rate: Column) -> Column:
    """Log of the Poisson probability of ``k``. Around the mode its terms stay small: exp(-rate) is 0 in doubles for rates over 745."""
    x = k.cast("double")
    # what ln k! has over k ln k - k + ln(2 pi k) / 2: exact for small k, else its series
    exact = F.log(F.factorial(F.least(k, F.lit(20)))) - (x * F.log(x) - x + 0.5 * F.log(2 * F.pi() * x))
    series = 1 / (12 * x) - 1 / (360 * F.pow(x, 3)) + 1 / (1260 * F.pow(x, 5))
    rest = F.when(k <= 20, exact).otherwise(series)
    return F.when(k == 0, -rate).otherwise(x - rate - x * F.log1p((x - rate) / rate) - 0.5 * F.log(2 * F.pi() * x) - rest)


def source_rates(docs: DataFrame, targets: dict | None = None, power: float = 0.5, source_col: str = "source") -> DataFrame:
    """Per source (``p__source``): ``rows``, ``rate`` (mean repetitions), ``low`` and ``cdf``, the cumulative Poisson probabilities of the
    counts from ``low`` up to where the tail is below 2**-53. ``low`` is 0 for small rates; below it there is less than 2**-53.
    Without targets, a weight is rows ** power.
    """
    counts = materialise(docs.groupBy(F.col(source_col).alias("p__source")).agg(F.count("*").alias("rows")), "sources")
    if targets is None:
        weighted = counts.withColumn("weight", F.pow(F.col("rows").cast("double"), F.lit(power)))
    else:
        pairs = [x for s, w in targets.items() for x in (F.lit(s), F.lit(float(w)))]
        weighted = counts.withColumn("weight", F.coalesce(F.element_at(F.create_map(*pairs), F.col("p__source")), F.lit(0.0)) if pairs else F.lit(0.0))
    total = weighted.agg(F.sum("rows"), F.sum("weight")).first()
    rows, weights = total[0] or 0, total[1] or 1.0
    rate = F.col("rate")
    spread = F.ceil(12 * F.sqrt(rate)) + 30
    rated = weighted.withColumn("rate", F.col("weight") / F.lit(weights) * F.lit(float(rows)) / F.col("rows")).withColumn("low", F.greatest(F.lit(0), F.floor(rate) - spread).cast("int"))
    each = rated.withColumn("k", F.explode(F.sequence("low", F.when(rate > 0, F.floor(rate) + spread).otherwise(F.lit(0)).cast("int"))))
    each = each.withColumn("p", F.when(rate > 0, F.exp(_log_probability(F.col("k"), rate))).otherwise(F.lit(1.0)))
    # a source has some 24 * sqrt(rate) + 60 counts
    listed = each.groupBy("p__source", "rows", "rate", "low").agg(F.array_sort(F.collect_list(F.struct("k", "p"))).alias("each"))
    summed = listed.withColumn("p__sums", F.expr(_SUMS))
    return materialise(summed.select("p__source", "rows", "rate", "low", F.expr("transform(p__sums, x -> x / element_at(p__sums, -1))").alias("cdf")), "rates")


#: Running sums in blocks of 256, so that their time grows little faster than their number.
_SUMS = """
aggregate(sequence(0, size(each) - 1, 256), cast(array() as array<array<double>>), (done, a) -> concat(done, array(
    aggregate(slice(each, a + 1, 256), cast(array() as array<double>), (s, x) -> concat(s, array(coalesce(try_element_at(s, -1), try_element_at(try_element_at(done, -1), -1), 0D) + x.p)))
)), done -> flatten(done))
"""


def poisson_mix(docs: DataFrame, targets: dict | None = None, power: float = 0.5, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Copies of the rows of ``docs`` with ``p__copy`` (0, 1, ...), ``p__rate`` and ``p__key``, globally shuffled."""
    copy, rate, key, source, low, cdf, n = unused(docs, "p__copy", "p__rate", "p__key", "p__source", "p__low", "p__cdf", "p__n")
    rates = source_rates(docs, targets, power, source_col)
    size = rates.agg(F.sum(F.size("cdf") * 8 + 64)).first()[0] or 0
    rates = rates.select(F.col("p__source").alias(source), F.col("rate").alias(rate), F.col("low").alias(low), F.col("cdf").alias(cdf))
    drawn = docs.join(F.broadcast(rates) if size <= BROADCAST_BYTES else rates, F.col(source_col).eqNullSafe(F.col(source)))
    # the place that the uniform takes among the sorted probabilities is the number of those below it
    u = _uniform(seed, id_col)
    drawn = drawn.withColumn(n, F.col(low) + F.array_position(F.sort_array(F.array_append(cdf, u)), u).cast("int") - 1)
    copies = drawn.withColumn(copy, F.explode(F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1))))
    copies = copies.withColumn(key, F.xxhash64(F.lit(seed + 1), id_col, copy))
    return copies.select(*docs.columns, copy, rate, key).repartition(key).sortWithinPartitions(key)


def op8_query(spark, sf_dir: str) -> DataFrame:
    """Every copy: document, source, copy number, its source's rate, shuffle key, digest of the text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return poisson_mix(docs).select(
        "doc_id", "source", F.col("p__copy").alias("copy"), F.col("p__rate").alias("rate"), F.col("p__key").alias("shuffle_key"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents repeated to the target weights, in global random order."""
    return poisson_mix(docs).select(*docs.columns)
