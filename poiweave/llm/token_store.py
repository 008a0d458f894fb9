"""Token-id store: a shared zstandard dictionary, one frame per document, offset index per shard.

The dictionary is trained on the serialized id arrays of a bounded sample of documents (by id hash; only
compression depends on it). Every document's ids (little-endian unsigned 16- or 32-bit) become one
frame of their own, so a short document can be read alone. Frames are dealt by ranges of doc_id and
sorted, and written as shards: rows of a Parquet table ``shards`` in the store's folder with ``data`` (frames end to
end), ``offsets`` (one more than documents), ``doc_ids``, ``before`` (ids of the part's earlier shards), ``width`` and
``dictionary`` (its SHA-256). The dictionary itself lies beside them in the table ``dictionary``, so any process can
open the folder. A reader checks the hash before it decompresses; ``read_document`` slices one frame.

A text's ids are those of its white-space separated parts end to end (the tokenizer drops white space
and never merges across it). Array operations lower-case texts as the tokenizer does, cut marks off the ends of words, where it
cuts too, find the distinct parts of some texts and put their ids together; each worker keeps the ids of parts in a bounded cache.

Results in odd cases: null and empty texts hold the end id alone; very long texts are one frame, in a shard of their own if
need be; a null doc_id sorts first; rows that repeat an id are ordered by their frames; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poiweave.llm import arrays as A
from poiweave.storage import discard, drop_at_exit, materialise, new_path

END_ID = 1
DICTIONARY_BYTES = 65_536
#: Documents that train the dictionary, about, and the most bytes of text that they may bring (more are read in slices of the id hash).
SAMPLE_DOCUMENTS, SAMPLE_BYTES = 1_000, 16 << 20
#: The most entries and bytes of a worker's cache; beyond either it starts anew with the parts at hand.
CACHE, CACHE_BYTES = 1_200_000, 20 << 20
#: Bytes of texts whose parts are looked up together.
SLICE_BYTES = 2 << 20
#: A shard closes at this many bytes or documents.
SHARD_BYTES, SHARD_DOCUMENTS = 8 << 20, 8_192
LEVEL = 3
#: Parts to encode are sent together: words between blanks, others with this special token between them.
_FENCE = "<|startoftext|>"
_WORD_END = "</w>"
_CASE = np.arange(256, dtype=np.uint8)
_CASE[65:91] += 32


def _simplified(raw: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z and the capitals of U+00C0 to U+00DE in lower case."""
    out = _CASE[raw]
    two = np.flatnonzero(raw[:-1] == 0xC3) + 1
    two = two[(raw[two] <= 0x9E) & (raw[two] != 0x97)]
    out[two] += 32
    return out


class Encoder:
    """Ids of texts as little-endian bytes of ``width``; parts are cached."""

    def __init__(self, path: str, width: int, end_id: int = END_ID):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind, self.end = np.dtype("<u2" if width == 2 else "<u4"), end_id
        self.cache: dict[bytes, bytes] = {}
        self.size = 0
        self.fence = self.tokenizer.token_to_id(_FENCE)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(_WORD_END)]] = True

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, self.kind) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _keep(self, keys: list[bytes], ids: np.ndarray, starts: list[int], stops: list[int]) -> None:
        data, size = ids.tobytes(), self.kind.itemsize
        self.cache.update(zip(keys, [data[a * size : b * size] for a, b in zip(starts, stops)]))

    def _learn(self, keys: list[bytes]) -> None:
        """Put the ids of parts into the cache. A word of letters is at least one piece for the tokenizer, and each piece has
        one id that ends it; so ids of many words are told apart, if there are as many ends as words."""
        parts = [k.decode() for k in keys]
        words, fenced, alone = [], [], []
        by_ends = bool(self.ends.any())
        for pair in zip(keys, parts):
            (words if by_ends and pair[1].isalpha() else alone if self.fence is None or "<|" in pair[1] else fenced).append(pair)
        groups = [words[i : i + 256] for i in range(0, len(words), 256)]
        for group, ids in zip(groups, self._encoded([" ".join([part for _, part in g]) for g in groups])):
            stops = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(stops) == len(group):
                self._keep([k for k, _ in group], ids, [0, *stops], stops)
            else:  # a letter that the tokenizer takes apart
                alone += group
        groups = [fenced[i : i + 256] for i in range(0, len(fenced), 256)]
        for group, ids in zip(groups, self._encoded([_FENCE.join(part for _, part in g) for g in groups])):
            at = np.flatnonzero(ids == self.fence)
            if len(at) != len(group) - 1:
                raise ValueError("a part holds the fence")
            self._keep([k for k, _ in group], ids, [0, *(at + 1).tolist()], [*at.tolist(), len(ids)])
        for (key, _), ids in zip(alone, self._encoded([part for _, part in alone])):
            self.cache[key] = ids.tobytes()

    def encode(self, column: pa.Array) -> list[bytes]:
        """The ids of the texts of a column."""
        raw, offsets = A.strings(column)
        starts, ends, rows = A.word_bounds(raw, offsets)
        if len(starts) and b"<|" not in raw.tobytes():  # else perhaps a special token, which has one spelling
            raw = _simplified(raw)
            starts, ends, first = A.without_marks(raw, starts, ends)
            rows = np.append(first, len(starts))[rows]
        first, place, _ = A.distinct(A.hashes_of(raw, starts, ends, lower=False))
        data = raw.tobytes()
        keys = [data[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        ids = list(map(self.cache.get, keys))
        if ids.count(None):
            new = [k for k, x in zip(keys, ids) if x is None]
            if len(self.cache) + len(new) > CACHE or self.size + sum(map(len, new)) > CACHE_BYTES:
                self.cache, self.size, new = {}, 0, keys
            self.size += sum(map(len, new))
            self._learn(new)
            ids = list(map(self.cache.__getitem__, keys))
        flat, done = A.gather(ids, self.kind, place)
        stop = done[rows[1:]] + np.arange(1, len(offsets))
        out, inner = np.full(stop[-1] if len(stop) else 0, self.end, self.kind), np.ones(stop[-1] if len(stop) else 0, bool)
        inner[stop - 1] = False
        out[inner] = flat
        return [out[a:b].tobytes() for a, b in zip([0, *stop.tolist()], stop.tolist())]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        return self.encode(pa.array(texts, pa.string()))


@lru_cache(maxsize=1)
def _shared_encoder(path: str, width: int) -> Encoder:
    """One encoder for all tasks of a worker process, so that its cache lasts."""
    return Encoder(path, width)


def id_width(path: str) -> int:
    """2 where every id fits 16 bits, else 4."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 65_536 else 4


def train_dictionary(docs: DataFrame, path: str, width: int, id_col: str = "doc_id", text_col: str = "text") -> bytes:
    """A zstandard dictionary from about SAMPLE_DOCUMENTS documents; a plain one where there are too few."""
    import zstandard

    rows, size = docs.agg(F.count("*"), F.sum(F.octet_length(text_col))).first()
    share = min(SAMPLE_DOCUMENTS / max(1, rows), SAMPLE_BYTES / max(1, size or 0))
    limit = min((1 << 63) - 1, int(share * (1 << 63)))
    taken, samples = 0, []
    for row in docs.where(F.abs(F.xxhash64(F.col(id_col))) <= F.lit(limit)).select(text_col).limit(2 * SAMPLE_DOCUMENTS).toLocalIterator():
        samples += _shared_encoder(path, width)([row[0]])
        taken += len(samples[-1])
        if taken > SAMPLE_BYTES:  # one long text may bring more than its share
            break
    samples.sort()
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:DICTIONARY_BYTES].ljust(64, b"\x01")


def _dictionary(data: bytes):
    import zstandard

    trained = data[:4] == b"\x37\xa4\x30\xec"
    return zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)


def _encoder(path: str, width: int, dictionary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encode, pack = _shared_encoder(path, width).encode, zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary), write_content_size=True, write_dict_id=True).compress
        for whole in batches:
            for batch in A.slices(whole, 1, SLICE_BYTES):
                ids = encode(batch.column(1))
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([len(x) // width for x in ids], pa.int64()), pa.array(map(pack, ids), pa.binary())], ["doc_id", "n_tokens", "frame"])

    return run


_SHARD = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("width", pa.int32()), ("dictionary", pa.string()), ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("data", pa.binary())])


def _sharder(width: int, digest: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        ids, frames, tokens, size = [], [], 0, 0

        def shard() -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype(np.int64)
            return pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "before": before, "n_tokens": tokens, "width": width, "dictionary": digest, "doc_ids": ids, "offsets": offsets, "data": b"".join(frames)}], schema=_SHARD)

        for batch in batches:
            for doc_id, n, frame in zip(*(c.to_pylist() for c in batch.columns)):
                ids.append(doc_id), frames.append(frame)
                tokens, size = tokens + n, size + len(frame)
                if size >= SHARD_BYTES or len(ids) >= SHARD_DOCUMENTS:
                    yield shard()
                    ids, frames, tokens, size, seq, before = [], [], 0, 0, seq + 1, before + tokens
        if ids:
            yield shard()

    return run


def write_store(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> str:
    """Write all documents into a folder (default: a new one in the shared folder) and return it."""
    spark = docs.sparkSession
    A.prepare(spark)
    if own := folder is None:
        folder = new_path(spark, "token-store")
    width = id_width(path)
    dictionary = train_dictionary(docs, path, width, id_col, text_col)
    digest = hashlib.sha256(dictionary).hexdigest()
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    frames = materialise(read.mapInArrow(_encoder(path, width, dictionary), "doc_id long, n_tokens long, frame binary"), "frames")
    ordered = frames.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "frame")
    shards = ordered.mapInArrow(_sharder(width, digest), "part int, seq int, before long, n_tokens long, width int, dictionary string, doc_ids array<long>, offsets array<long>, data binary")
    shards.write.mode("overwrite").parquet(f"{folder}/shards")
    spark.createDataFrame([(digest, bytearray(dictionary))], "dictionary string, data binary").coalesce(1).write.mode("overwrite").parquet(f"{folder}/dictionary")
    if own:
        drop_at_exit(spark, folder)
    discard(frames)
    return folder


def open_store(spark: SparkSession, folder: str) -> tuple[DataFrame, bytes]:
    """The table of shards and the dictionary of a store."""
    return spark.read.parquet(f"{folder}/shards"), bytes(spark.read.parquet(f"{folder}/dictionary").first()["data"])


def _opened(dictionary: bytes, digest: str):
    import zstandard

    if hashlib.sha256(dictionary).hexdigest() != digest:
        raise ValueError("the shard was written with another dictionary")
    return zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress


def read_document(shard, at: int, dictionary: bytes) -> np.ndarray:
    """The ids of one document of a shard row, without touching its neighbours."""
    a, b = shard["offsets"][at], shard["offsets"][at + 1]
    return np.frombuffer(_opened(dictionary, shard["dictionary"])(shard["data"][a:b]), "<u2" if shard["width"] == 2 else "<u4")


#: Parts up to this many have their starts broadcast (16 bytes each); beyond it the join shuffles.
BROADCAST_PARTS = 100_000


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the shards."""
    shards, dictionary = open_store(spark, folder)
    # one number for each task that wrote shards, however many shards it wrote
    sizes = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    starts = [0, *accumulate(r["n"] for r in sizes)]
    index = spark.createDataFrame([(r["part"], at) for r, at in zip(sizes, starts)], "p__part int, p__start long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                unpack, kind = _opened(dictionary, shard["dictionary"]), "<u2" if shard["width"] == 2 else "<u4"
                data, offsets, at = shard["data"], shard["offsets"], shard["start"]
                starts, sizes, sums = [], [], []
                for a, b in zip(offsets, offsets[1:]):
                    ids = np.frombuffer(unpack(data[a:b]), kind)
                    starts.append(at), sizes.append(len(ids)), sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    at += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(shard["doc_ids"], pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    placed = shards.join(F.broadcast(index) if len(sizes) <= BROADCAST_PARTS else index, F.col("part") == F.col("p__part"))
    return placed.select((F.col("p__start") + F.col("before")).alias("start"), "width", "dictionary", "doc_ids", "offsets", "data").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op10_query(spark, sf_dir: str) -> DataFrame:
    """Write every document's ids, read them back."""
    import public_tokenizers

    return read_store(spark, write_store(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json")))
