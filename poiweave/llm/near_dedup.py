"""MinHash near-duplicate detection with odd sketches.

1. One pass turns each text into its set of word shingles (64-bit hashes) and keeps, per document,
   the set's size, a 128-bit digest, banded MinHash keys and an odd sketch: the MinHash samples folded
   into a parity bitmap, so the XOR of two bitmaps counts the samples that differ.
2. Documents with equal sets form a class; its smallest id stands for it from here on.
3. In every band bucket, members are compared with the bucket's centre only, never with each other.
   Sizes and the sketches' XOR population count drop candidates that are far below the threshold; the
   rest is confirmed on full shingle sets. Components join what is confirmed.
4. Buckets that still hold more than one component get further rounds with other centres, and at the
   end every member outside a bucket's largest component is compared with all members of other
   components, in blocks. That last comparison uses finer sketches, made for these members only, so that pairs a little below the
   threshold are not built. A pair at the threshold is missed where the bands or a sketch fail it, each with a chance below MISS.

Only ids, digests and sketches of candidates move; full sets are recomputed from the texts of
documents in a surviving pair. To confirm, the set of a pair's more frequent side is sent once for each block of its partners, and
blocks are dealt by both, so a text with very many candidates is spread over tasks. Rows with one doc_id are one document.

Results in odd cases: null or empty texts, and texts without words, have an empty set and link with
nothing; a text with fewer words than a shingle is one shingle; a very long text is one set like any other; a null id gets a null
component and is kept; repeated rows are one document; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poiweave.llm import arrays as A
from poiweave.llm.columns import unused
from poiweave.operators.components import connected_components
from poiweave.storage import discard, materialise

SAMPLES = 120
#: Bits of an odd sketch (a multiple of 64) and the chance of a false drop allowed by a sketch or by the bands.
SKETCH_BITS = 512
MISS = 1e-6
#: Samples and bits of the finer odd sketches that the last round makes for members of open buckets only.
FINE_SAMPLES, FINE_BITS = 2_048, 4_096
#: Ids up to this many (eight bytes each) are broadcast to the scan that recomputes full sets; beyond it the join shuffles.
BROADCAST_IDS = 1_000_000
STAR_ROUNDS = 3
#: To confirm, a block has as many pairs of one text, and as many shingles; in the last round, as many members of a bucket.
BLOCK_PAIRS, BLOCK_SHINGLES, BLOCK_MEMBERS = 64, 1 << 20, 4_096


def bands_for(threshold_pct: int, samples: int = SAMPLES) -> tuple[int, int]:
    """(bands, rows): the most rows a band whose chance to miss a pair at the threshold is below MISS."""
    for rows in range(8, 1, -1):
        bands = samples // rows
        if (1 - (threshold_pct / 100) ** rows) ** bands < MISS:
            return bands, rows
    return samples, 1


def sketch_limit(threshold_pct: int, samples: int = SAMPLES, bits: int = SKETCH_BITS) -> int:
    """The largest XOR population count a pair at the threshold may show, but with chance MISS.

    Of ``samples`` MinHash values a binomial number differs; each differing one flips two random bits.
    """
    rng = np.random.default_rng(7)
    differ = rng.binomial(samples, 1 - threshold_pct / 100, 200_000).astype(float) * 2
    mean = bits / 2 * (1 - np.exp(-2 * differ / bits))
    # normal tail beyond the simulated spread: five deviations cover MISS on one side
    return int(np.ceil(mean.mean() + 5.2 * np.hypot(mean.std(), np.sqrt(bits) / 2 * np.sqrt(1 - np.exp(-4 * differ.mean() / bits)))))


def shingle_sets(words: np.ndarray, rows: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    rolled = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
    factors = A.constants(width, 5) | np.uint64(1)
    for k in range(width):
        rolled += words[k : len(words) - width + 1 + k] * factors[k] if len(rolled) else rolled
    rolled = A.mix(rolled)
    for i in range(len(rows) - 1):
        a, b = int(rows[i]), int(rows[i + 1])
        if b - a >= width:
            yield np.unique(rolled[a : b - width + 1])
        elif b > a:
            yield A.mix((words[a:b] * factors[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def _signer(width: int, bands: int, rows: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = bands * rows
        times, plus = (A.constants(n, 11) | np.uint64(1))[:, None], A.constants(n, 13)[:, None]
        band_seed = A.constants(bands, 19)
        row_factor = A.constants(rows, 23) | np.uint64(1)
        place_seed = A.constants(n, 29)
        for batch in batches:
            raw, offsets = A.strings(batch.column(1))
            out = {"n": [], "s1": [], "s2": [], "bands": [], "sketch": []}
            for i, j in A.chunks(offsets):
                words, starts = A.word_hashes(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                for s in shingle_sets(words, starts, width):
                    out["n"].append(len(s))
                    if not len(s):
                        out["s1"].append(0), out["s2"].append(0), out["bands"].append([]), out["sketch"].append([])
                        continue
                    out["s1"].append(int(s.sum(dtype=np.uint64).astype(np.int64)))
                    out["s2"].append(int(A.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
                    least = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
                    for k in range(0, len(s), 512):
                        np.minimum(least, (s[None, k : k + 512] * times + plus).min(axis=1), out=least)
                    key = A.mix((least.reshape(bands, rows) * row_factor).sum(axis=1, dtype=np.uint64) + band_seed)
                    out["bands"].append(key.view(np.int64))
                    place = A.mix(least ^ place_seed) % np.uint64(bits)
                    odd = (np.bincount(place.astype(np.int64), minlength=bits) & 1).astype(np.uint8)
                    out["sketch"].append(np.packbits(odd).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(out["n"], pa.int64()), pa.array(out["s1"], pa.int64()), pa.array(out["s2"], pa.int64()),
                 pa.array(out["bands"], pa.list_(pa.int64())), pa.array(out["sketch"], pa.list_(pa.int64()))],
                ["id", "n", "s1", "s2", "bands", "sketch"],
            )

    return run


def _setter(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = A.strings(batch.column(1))
            for i, j in A.chunks(offsets):
                words, starts = A.word_hashes(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                sets = [s.view(np.int64) for s in shingle_sets(words, starts, width)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j].cast(pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"])

    return run


def _fine_signer(width: int, samples: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times, plus = (A.constants(samples, 31) | np.uint64(1))[:, None], A.constants(samples, 37)[:, None]
        place_seed = A.constants(samples, 41)
        for batch in batches:
            raw, offsets = A.strings(batch.column(1))
            out = []
            for i, j in A.chunks(offsets):
                words, starts = A.word_hashes(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                for s in shingle_sets(words, starts, width):
                    least = np.full(samples, np.iinfo(np.uint64).max, dtype=np.uint64)
                    for k in range(0, len(s), 64):
                        np.minimum(least, (s[None, k : k + 64] * times + plus).min(axis=1), out=least)
                    place = A.mix(least ^ place_seed) % np.uint64(bits)
                    out.append(np.packbits((np.bincount(place.astype(np.int64), minlength=bits) & 1).astype(np.uint8)).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(out, pa.list_(pa.int64()))], ["rep", "fine"])

    return run


def _matcher(pct: int):
    """Rows (a, part, b, shingles) in order, the set of ``a`` first, with a null b: the pairs whose sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, own = None, []
        for batch in batches:
            lists = batch.column(3)
            at, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            out = []
            for i, (a, part, b) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(3)))):
                if block != (a, part):
                    block, own = (a, part), []
                these = values[at[i] : at[i + 1]]
                if b is None:
                    own.append(these.copy())
                    continue
                for mine in own if len(these) else ():
                    if not len(mine):
                        continue
                    place = np.minimum(np.searchsorted(mine, these), len(mine) - 1)
                    common = int((mine[place] == these).sum())
                    if 100 * common >= pct * (len(mine) + len(these) - common):
                        out.append((a, b))
                        break
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


class _Links:
    """Confirms candidate pairs of class representatives."""

    def __init__(self, texts: DataFrame, classes: DataFrame, width: int, pct: int):
        self.texts, self.classes, self.width, self.pct = texts, classes, width, pct
        self.limit = sketch_limit(pct)

    def near(self, a: str, b: str):
        """Sizes and sketches of both sides allow the threshold."""
        flips = " + ".join(f"bit_count({a}.sketch[{k}] ^ {b}.sketch[{k}])" for k in range(SKETCH_BITS // 64))
        return F.expr(f"100 * least({a}.n, {b}.n) >= {self.pct} * greatest({a}.n, {b}.n) and {flips} <= {self.limit}")

    def fine(self, members: DataFrame) -> DataFrame:
        """(rep, fine): the finer sketches of some classes."""
        ids = materialise(members.select(F.col("rep").alias("id")).distinct(), "open")
        wanted = self.texts.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")
        return materialise(wanted.mapInArrow(_fine_signer(self.width, FINE_SAMPLES, FINE_BITS), "rep long, fine array<long>"), "fine").dropDuplicates(["rep"])

    def near_fine(self, a: str, b: str):
        flips = " + ".join(f"bit_count({a}.fine[{k}] ^ {b}.fine[{k}])" for k in range(FINE_BITS // 64))
        return F.expr(f"{flips} <= {sketch_limit(self.pct, FINE_SAMPLES, FINE_BITS)}")

    def sift(self, pairs: DataFrame) -> DataFrame:
        """Candidates (a, b) that the sketches let pass."""
        info = self.classes.select("rep", F.struct("n", "sketch").alias("i"))
        both = pairs.join(info.select(F.col("rep").alias("b"), F.col("i").alias("x")), "b").join(info.select(F.col("rep").alias("a"), F.col("i").alias("y")), "a")
        return both.where(self.near("x", "y")).select("a", "b")

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """Of sifted pairs, a table of those whose full sets reach the threshold."""
        pairs = materialise(pairs, "pairs")
        met = pairs.select(F.col("a").alias("id")).unionAll(pairs.select("b")).groupBy("id").agg(F.count("*").alias("c"))
        parts = F.ceil(F.greatest(F.col("c") / BLOCK_PAIRS, F.col("c") * F.col("n") / BLOCK_SHINGLES)).cast("int")
        degrees = materialise(met.join(self.classes.select(F.col("rep").alias("id"), "n"), "id").select("id", F.struct("c", "id").alias("w"), parts.alias("parts")), "degrees")
        n = degrees.count()
        if not n:
            return pairs
        ids = degrees.select("id")
        wanted = self.texts.join(F.broadcast(ids) if n <= BROADCAST_IDS else ids, "id", "left_semi")
        sets = materialise(wanted.mapInArrow(_setter(self.width), "id long, shingles array<long>"), "sets")
        side = lambda x: degrees.select(F.col("id").alias(x), F.struct("w", "parts").alias(f"of_{x}"))
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        turned = F.col("of_a.w") < F.col("of_b.w")  # the side with more pairs comes first
        both = both.select(F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"), F.when(turned, F.col("of_b.parts")).otherwise(F.col("of_a.parts")).alias("parts"))
        dealt = both.select("a", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"), "b")
        partners = dealt.join(sets, F.col("b") == F.col("id")).select("a", "part", "b", "shingles")
        first = dealt.select("a", "part").distinct().join(sets, F.col("a") == F.col("id")).select("a", "part", F.lit(None).cast("long").alias("b"), "shingles")
        rows = partners.unionAll(first).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
        links = materialise(rows.mapInArrow(_matcher(self.pct), "a long, b long").distinct(), "links")
        discard(sets), discard(pairs), discard(degrees)
        return links


def _with_component(members: DataFrame, parts: DataFrame) -> DataFrame:
    return members.join(parts.withColumnRenamed("id", "rep"), "rep", "left").withColumn("part", F.coalesce("component", "rep")).drop("component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold_pct: int = 80) -> DataFrame:
    """Return doc_id, n_shingles, component_id (smallest id reachable), kept: one row per row of ``docs``.

    Two documents are linked where 100 * |A & B| >= threshold_pct * |A | B| over their shingle sets.
    """
    spark = docs.sparkSession
    A.prepare(spark)
    bands, rows = bands_for(threshold_pct)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = materialise(texts.mapInArrow(_signer(width, bands, rows, SKETCH_BITS), "id long, n long, s1 long, s2 long, bands array<long>, sketch array<long>"), "signed")
    classes = materialise(signed.where("n > 0 and id is not null").groupBy("s1", "s2", "n", "bands", "sketch").agg(F.min("id").alias("rep")), "classes")
    spread = classes.select("rep", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1")
    met = materialise(spread.join(shared, "bucket"), "met")
    # how often a class meets others: the original of many copies meets the most, and makes the best centre
    fame = met.groupBy("rep").agg(F.sum("c").alias("fame"))
    famed = met.join(fame, "rep")
    centre = famed.groupBy("bucket").agg(F.max_by("rep", F.struct("fame", (-F.col("rep")).alias("o"))).alias("centre"))
    multi = materialise(famed.join(centre, "bucket").select("bucket", "rep", "fame", "centre"), "buckets")
    discard(met)
    links_of = _Links(texts, classes, width, threshold_pct)
    pair = lambda x, y: [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]
    tried = multi.where("rep <> centre").select(*pair("rep", "centre")).distinct()
    links = links_of.confirm(links_of.sift(tried))
    parts = materialise(connected_components(links), "parts")
    for k in range(1, STAR_ROUNDS + 1):
        members = _with_component(multi, parts)
        open_ = members.groupBy("bucket").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q").select("bucket")
        members = members.join(open_, "bucket").drop("centre")
        sizes = members.groupBy("bucket", "part").agg(F.count("*").alias("c"))
        main = sizes.groupBy("bucket").agg(F.max_by("part", F.struct("c", "part")).alias("main"), F.ceil(F.sum("c") / BLOCK_MEMBERS).cast("int").alias("blocks"))
        if k < STAR_ROUNDS:
            # other centres: the smallest id, then the most met outside the largest component; own components need no look
            if k == 1:
                hub = members.groupBy("bucket").agg(F.min(F.struct("rep", "part")).alias("h"))
            else:
                hub = members.join(main.drop("blocks"), "bucket").where("part <> main").groupBy("bucket").agg(F.max_by(F.struct("rep", "part"), F.struct("fame", "rep")).alias("h"))
            pairs = members.join(hub, "bucket").where("part <> h.part").select(*pair("rep", "h.rep"))
            pairs = links_of.sift(pairs.distinct().join(tried, ["a", "b"], "left_anti"))
        else:
            members = materialise(members, "members")
            if members.isEmpty():
                break
            info = classes.join(links_of.fine(members), "rep").select("rep", F.struct("n", "sketch", "bands", "fine").alias("i"))
            held = members.join(info, "rep").join(main, "bucket")
            # the members of a bucket go to blocks; those outside its largest component meet every block
            block = F.pmod(F.xxhash64("rep"), "blocks").cast("int")
            rest = held.where("part <> main").select("bucket", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.struct("rep", "part", "main", "i").alias("x"))
            full = held.select("bucket", block.alias("block"), F.struct("rep", "part", "i").alias("y"))
            # a pair counts in the first bucket that it shares
            first = F.expr("get(x.i.bands, cast(array_position(zip_with(x.i.bands, y.i.bands, (p, q) -> p = q), true) as int) - 1) = bucket")
            pairs = rest.join(full, ["bucket", "block"]).where("x.part <> y.part and (y.part = x.main or x.rep < y.rep)").where(links_of.near("x.i", "y.i") & links_of.near_fine("x.i", "y.i") & first)
            pairs = pairs.select(*pair("x.rep", "y.rep")).distinct().join(tried, ["a", "b"], "left_anti")
        more = links_of.confirm(pairs)
        if more.isEmpty():
            if k < STAR_ROUNDS:
                continue
            break
        links = materialise(links.unionAll(more), "links")
        parts = materialise(connected_components(links), "parts")
    group = _with_component(classes.select("s1", "s2", "rep"), parts).select(F.col("s1").alias("t1"), F.col("s2").alias("t2"), "part")
    named = signed.select("id", "n", "s1", "s2").join(group, (F.col("s1") == F.col("t1")) & (F.col("s2") == F.col("t2")) & (F.col("n") > 0), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("part", "id"))
    return named.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def op2_query(spark, sf_dir: str) -> DataFrame:
    """Three-word shingles, links at 85 per cent."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=3, threshold_pct=85)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near copies (five-word shingles, 80 per cent), the smallest id stays."""
    (own,) = unused(docs, "p__id")
    dropped = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias(own)).distinct()
    # few rows or many: the planner picks the join by the size of the table just written
    return docs.join(materialise(dropped, "dropped"), F.col("doc_id") == F.col(own), "left_anti")


OP2_SQL = r"""
with w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents
), s as (
  select distinct doc_id, unnest(case when len(ws) >= 3 then list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
    when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as g from w
), n as (select doc_id, count(*) as n from s group by doc_id),
p as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2
), l as (
  select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)
), e as (select a, b from l union all select b, a from l),
r as (
  with recursive t(doc_id, r) as (select doc_id, doc_id from documents union select e.b, t.r from t join e on e.a = t.doc_id) select doc_id, min(r) as r from t group by doc_id
)
select d.doc_id, coalesce(n.n, 0) as n_shingles, r.r as component_id, d.doc_id = r.r as kept from documents d join r on r.doc_id = d.doc_id left join n on n.doc_id = d.doc_id
"""
