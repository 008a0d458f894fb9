"""Quality classifier by importance resampling.

Word unigrams and bigrams are hashed into BUCKETS; one generative model is fitted to target text (a
bounded, documented sample of labelled good rows that are not toxic), one to all raw text. A document's importance weight is the
ratio of its probabilities under the two models: its log is the sum of the log ratios of its n-grams. Keys of log weight plus
Gumbel noise (seeded by the id) are ranked and the k largest kept, which samples k documents without replacement in proportion to
their weights. ``per_gram`` takes the mean of the log ratios over ``temperature`` instead, so that length does not decide.

k is the share of good rows that are not toxic among all labelled ones times the number of documents. The k-th key is
found exactly by narrowing a histogram of 64-bit keys, so nothing is sorted or collected.

Results in odd cases: null and empty texts have no n-grams and a log ratio of EMPTY (last); null ids draw the noise of a null; very long
texts count as a whole; repeated ids draw equal noise, and rows that tie with the k-th key are all kept, so that ``kept`` may exceed
k by their number; without labels everything is kept; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiweave.llm import arrays as A
from poiweave.storage import materialise

BUCKETS = 65_536
#: Labelled target rows that fit the target model: those of least id hash, at most.
TARGET_ROWS = 50_000
#: Spread of the Gumbel noise in units of log ratio per n-gram, for ``per_gram``.
TEMPERATURE = 0.02
SMOOTHING = 1.0
#: Log weight of a text without n-grams, below that of any other.
EMPTY = -1e9
#: Keys are compared as whole multiples of 2**-KEY_BITS.
KEY_BITS = 24
SEED = 11
_GOOD = "coalesce(quality = 1 and coalesce(toxic, 0) = 0, false)"


def _grams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all unigrams and bigrams, and the row of each."""
    words, starts = A.word_hashes(raw, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(starts))
    same = row[1:] == row[:-1]
    pairs = A.mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])[same] if len(words) > 1 else words[:0]
    grams = np.concatenate([words, pairs]) % np.uint64(BUCKETS)
    return grams.astype(np.int64), np.concatenate([row, row[1:][same]]) if len(words) > 1 else row


def _counter(targets: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), dtype=np.int64)
        for batch in batches:
            raw, offsets = A.strings(batch.column(1))
            ids = batch.column(0).cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
            good = np.isin(ids, targets)
            for i, j in A.chunks(offsets):
                grams, row = _grams(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                counts[0] += np.bincount(grams, minlength=BUCKETS)
                counts[1] += np.bincount(grams[good[i:j][row]], minlength=BUCKETS)
        some = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[0][some]), pa.array(counts[1][some])], ["bucket", "raw", "target"])

    return run


def _scorer(ratio: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = A.strings(batch.column(1))
            total, number = np.zeros(batch.num_rows), np.zeros(batch.num_rows, dtype=np.int64)
            for i, j in A.chunks(offsets):
                grams, row = _grams(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                total[i:j] = np.bincount(row, weights=ratio[grams], minlength=j - i)
                number[i:j] = np.bincount(row, minlength=j - i)
            weight = np.where(number > 0, total, EMPTY)
            mean = np.where(number > 0, total / np.maximum(number, 1), EMPTY)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(number), pa.array(weight), pa.array(mean)], ["doc_id", "n_grams", "log_ratio", "mean_ratio"])

    return run


def gumbel(seed: int, *columns: str) -> Column:
    """Standard Gumbel noise from a hash of the columns."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(u))


def kth_largest(keys: DataFrame, column: str, k: int, bits: int = 12) -> int | None:
    """The k-th largest value of a long column, by counting prefixes: 2**bits rows to the driver a round."""
    known, fixed = 0, 0
    # shift to unsigned order: the top bit flips
    value = F.col(column).bitwiseXOR(F.lit(-(1 << 63)))
    while fixed < 64:
        step = min(bits, 64 - fixed)
        here = keys if not fixed else keys.where(F.shiftrightunsigned(value, 64 - fixed) == F.lit(known))
        prefix = F.shiftrightunsigned(value, 64 - fixed - step) if fixed + step < 64 else value
        counts = here.groupBy(prefix.bitwiseAND(F.lit((1 << step) - 1)).alias("p")).count().collect()
        for p, n in sorted(((r[0], r[1]) for r in counts), reverse=True):
            if k <= n:
                known, fixed = known << step | p, fixed + step
                break
            k -= n
        else:
            return None
    return known - (1 << 63)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_rows: int = TARGET_ROWS) -> np.ndarray | None:
    """Log ratio of target to raw model for every bucket; None without target rows."""
    good = labels.where(_GOOD).where("doc_id is not null").select("doc_id")
    ids = [r[0] for r in good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_rows).collect()]
    if not ids:
        return None
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = read.mapInArrow(_counter(np.array(sorted(ids), dtype=np.int64)), "bucket int, raw long, target long")
    counts = np.zeros((2, BUCKETS))
    for bucket, raw, target in parts.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect():  # BUCKETS rows at most
        counts[:, bucket] = raw, target
    smooth = counts + SMOOTHING
    return np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float | None = None, per_gram: bool = False, temperature: float = TEMPERATURE) -> DataFrame:
    """doc_id, n_grams, log_ratio, mean_ratio, key, kept: one row for each row of ``docs``."""
    A.prepare(docs.sparkSession)
    ratio = fit(docs, labels, id_col, text_col)
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = read.mapInArrow(_scorer(ratio if ratio is not None else np.zeros(BUCKETS)), "doc_id long, n_grams long, log_ratio double, mean_ratio double")
    weight = F.col("mean_ratio") / F.lit(temperature) if per_gram else F.col("log_ratio")
    scored = scored.withColumn("key", weight + gumbel(SEED, "doc_id"))
    # keys as longs of the same order: fixed point
    scored = materialise(scored.withColumn("p__key", F.round(F.col("key") * F.lit(float(1 << KEY_BITS))).cast("long")), "scores")
    if share is None:
        row = labels.agg(F.avg(F.expr(f"cast({_GOOD} as double)"))).first()
        share = row[0] if row[0] is not None else 1.0
    n = scored.count()
    k = math.ceil(share * n) if ratio is not None else n
    least = kth_largest(scored, "p__key", k) if 0 < k < n else None
    kept = F.lit(k > 0) if least is None else F.col("p__key") >= F.lit(least)
    return scored.withColumn("kept", kept).drop("p__key")


def op1_query(spark, sf_dir: str) -> DataFrame:
    """Importance of every document and whether it is sampled."""
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
