"""Byte-level BPE encoding and decoding with Spark higher-order functions.

``fold_words`` encodes a word in the JVM: its bytes are the first pieces, and an ``aggregate`` folds merges over
them, each time the leftmost adjacent pair of least rank, looked up in a literal table over pairs of ids (Spark searches a map
linearly). ``decode`` looks every id up in a literal array of binary pieces and concatenates them.

Words repeat, so distinct words are folded, not tokens. One pass counts the words of the corpus; those that
occur more than once, the most frequent first (at most DICTIONARY of them and DICTIONARY_BYTES, bounds on memory, not on rows),
are folded once and sent to the workers as a compressed dictionary. The pass over the documents splits each text, replaces
dictionary words by their ids, and hands the other distinct words of that document to the same fold. Every word of
every text is encoded; the dictionary only decides where. Words of over LONG_WORD characters are
merged by a heap in the worker, with the same result.

Array operations cut texts at white space and before marks at the ends of words, where the pattern cuts too; distinct pieces are then
split by the pattern itself. Texts with other white space or with characters above 255, and other patterns, are split as a whole.

Results in odd cases: null and empty texts have no tokens, and the digests of empty input; repeated
rows get equal results; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.ipc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiweave.llm import arrays as A
from poiweave.storage import discard, materialise

#: Distinct words sent to the workers, at most, and bytes of their text; they take about 130 bytes each in a worker.
DICTIONARY, DICTIONARY_BYTES = 1_500_000, 24 << 20
#: In the fold: no merge, and the id of the pieces at the ends. No token has either number.
_NONE, _EDGE = 65_535, 65_534
#: Bytes of texts whose pieces are looked up together.
SLICE_BYTES = 2_000_000
#: Words of more characters (blobs without a break) are merged by a heap in the worker: a fold over
#: arrays takes time with the square of the length.
LONG_WORD = 400


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank of a tiktoken rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def _pair_table(path: str) -> list[int]:
    """The rank map by pairs of ids. At a stands where the row of a begins, and b places on the merge of (a, b): a * 2**17 plus its rank, which is
    also the id it makes. Rows lie between each other (row displacement), so a place may hold another row's merge: only its own has that a.
    """
    ranks, entries = load_ranks(path), {}
    if max(ranks.values()) >= _EDGE:
        raise ValueError("ranks above 65533 do not fit the table")
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            a, b = ranks.get(token[:k]), ranks.get(token[k:])
            if a is not None and b is not None:
                entries.setdefault(a, {})[b] = rank
    wide = _NONE + 1  # places of a row, and of the starts
    table, begin = np.full(wide + 4 * wide, _NONE << 17), np.full(wide, wide)
    free, low = np.ones(len(table), bool), wide
    free[:wide] = False
    for a, row in sorted(entries.items(), key=lambda x: -len(x[1])):
        places = np.fromiter(row, np.int64, len(row))
        least, places = places.min(), places - places.min()
        low += int(np.argmax(free[low:]))  # nothing is free before
        at = max(low, wide + least)
        while True:  # where all its places are free
            if at + 2 * wide > len(table):
                table, free = np.append(table, np.full(len(table), _NONE << 17)), np.append(free, np.ones(len(free), bool))
            fits = np.logical_and.reduce([free[at + x : at + x + 4096] for x in places.tolist()])
            if fits.any():
                break
            at += 4096
        at += int(np.argmax(fits))
        begin[a], free[at + places] = at - least, False
        table[at + places] = np.fromiter(row.values(), np.int64, len(row)) + (a << 17)
    table[:wide] = begin
    return table[: begin.max() + wide].tolist()


def rank_map(path: str) -> Column:
    """The table of the literal rank map; constant folding turns the JSON text into a literal once."""
    return F.from_json(F.lit(json.dumps(_pair_table(path), separators=(",", ":"))), "array<bigint>")


@lru_cache(maxsize=2)
def _piece_text(path: str) -> str:
    """The bytes of every id as a JSON list of base64 texts."""
    ranks = load_ranks(path)
    pieces = [""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = base64.b64encode(token).decode()
    return json.dumps(pieces, separators=(",", ":"))


def piece_array(path: str) -> Column:
    """The literal pieces, folded to a constant once. Their bytes are kept as strings, not all valid by themselves, so that they can be joined."""
    return F.from_json(F.lit(_piece_text(path)), "array<binary>").cast("array<string>")


def _let(value: Column, body) -> Column:
    """Bind ``value`` once for ``body``: what an aggregate over nothing starts with and ends by."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda bound, _: bound, body)


def fold_words(words: Column, path: str) -> Column:
    """The ids of each of an array of non-empty words of less than 16,383 bytes.

    The state is an array with a place for each byte and one at either end. A piece stands where it starts, as one number: rank of the merge
    with the next piece, start, length, id. So the least number is the leftmost merge of least rank, and the next piece is found by the
    length. The places a piece covers hold it too, without a merge, so the piece before is found in the place before. Nothing moves:
    a merge is one ``transform``, since slices and new arrays take most of the time.
    """
    ranks = load_ranks(path)
    single = F.from_json(F.lit(json.dumps([ranks[bytes([i])] for i in range(256)])), "array<bigint>")
    field = (1 << 14) - 1
    no_merge = 1 << 17 << 44
    first, last = no_merge | field << 30 | _EDGE, no_merge | _EDGE  # their starts are not where they stand

    def rank(t: Column, a: Column, b: Column) -> Column:  # 2**17 if the pair makes no token
        return F.least(t[t[a] + b].bitwiseXOR(F.shiftleft(a, 17)), F.lit(1 << 17))

    def id_of(y: Column) -> Column:
        return y.bitwiseAND(F.lit(65535))

    def start_of(y: Column) -> Column:
        return F.shiftright(y, 30).bitwiseAND(F.lit(field)).cast("int")

    def length_of(y: Column) -> Column:
        return F.shiftright(y, 16).bitwiseAND(F.lit(field)).cast("int")

    def merge(t: Column, ids: Column) -> Column:
        def step(state: Column, _: Column) -> Column:
            def put(least: Column, at: Column, end: Column, left: Column, left_at: Column) -> Column:  # end: the place after both
                new = F.shiftright(least, 44)
                made = least.bitwiseAND(F.lit(field << 30)).bitwiseOR(F.shiftleft(end - at, 16).cast("long")).bitwiseOR(new)
                here = made.bitwiseOR(F.shiftleft(rank(t, new, id_of(state[end])), 44))
                before = left.bitwiseAND(F.lit((1 << 44) - 1)).bitwiseOR(F.shiftleft(rank(t, id_of(left), new), 44))
                kept = lambda y, i: F.when(i < at, F.when(i == left_at, before).otherwise(y)).when(i >= end, y)
                return F.transform(state, lambda y, i: kept(y, i).when(i == at, here).otherwise(made.bitwiseOR(F.lit(no_merge))))

            def found(least: Column) -> Column:
                upto = lambda at: _let(at + length_of(least), lambda second: second + length_of(state[second]))
                merged = lambda at: _let(upto(at), lambda end: _let(state[at - 1], lambda left: _let(start_of(left), lambda x: put(least, at, end, left, x))))
                return F.when(least < no_merge, _let(start_of(least), merged)).otherwise(state)

            return _let(F.array_min(state), found)

        piece = lambda a, i: F.shiftleft(rank(t, a, F.coalesce(F.get(ids, i + 1), F.lit(_EDGE))), 44) + (i + 1).cast("long") * (1 << 30) + 65536 + a
        start = F.flatten(F.array(F.array(F.lit(first)), F.transform(ids, piece), F.array(F.lit(last))))
        done = F.aggregate(F.sequence(F.lit(2), F.size(ids)), start, step)
        return F.transform(F.filter(done, lambda y, i: start_of(y) == i), lambda y: id_of(y).cast("int"))

    def word(t: Column, s: Column, w: Column) -> Column:
        octets = F.split(F.decode(F.encode(w, "UTF-8"), "ISO-8859-1"), "")
        return _let(F.transform(octets, lambda c: F.get(s, F.ascii(c))), lambda ids: F.when(F.size(ids) > 1, merge(t, ids)).otherwise(ids.cast("array<int>")))

    return _let(rank_map(path), lambda t: _let(single, lambda s: F.transform(words, lambda w: word(t, s, w))))


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one long word: the leftmost pair of least rank merges first, by a heap over a linked list."""
    import heapq

    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, before, after, alive = [i + 1 for i in range(n)], list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
    heap: list[tuple[int, int, int, int]] = []

    def push(i: int) -> None:
        j = after[i]
        if j < n:
            rank = ranks.get(word[i : end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[i], end[j]))

    for i in range(n):
        push(i)
    while heap:
        _, i, middle, stop = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or end[i] != middle or j >= n or end[j] != stop:
            continue
        alive[j], end[i], after[i] = False, stop, after[j]
        if after[j] < n:
            before[after[j]] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def decode(ids: Column, path: str) -> Column:
    """The bytes of an array of ids: binary pieces, concatenated."""
    return _let(piece_array(path), lambda pieces: F.array_join(F.transform(ids, lambda x: F.get(pieces, x)), "")).cast("binary")


def latin_pattern(pattern: str) -> str | None:
    """The pattern for texts of characters below 256, with its classes written out, for the faster ``re``; None if it has other escapes."""
    import regex

    def members(escape: str) -> str:
        return "".join(f"\\x{c:02x}" for c in range(256) if regex.match(escape, chr(c)))

    out, inside, at = "", False, 0
    while at < len(pattern):
        escape = regex.match(r"\\p\{[LN]\}|\\[sS]", pattern[at:])
        if escape:
            own = members(escape[0])
            out += own if inside else f"[{own}]"
            at += escape.end()
            continue
        if pattern[at] == "\\":
            return None
        inside = pattern[at] != "]" if pattern[at] in "[]" else inside
        out, at = out + pattern[at], at + 1
    return out


def _splitter(pattern: str, latin: str | None):
    """A function that gives the matches of the pattern in a text."""
    import regex

    find = regex.compile(pattern).findall
    simple = re.compile(latin).findall if latin else find
    return lambda text: (simple if _latin(text) else find)(text)


#: The pattern whose cuts at white space and marks are known.
PLAIN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: Bytes that are no part of an ASCII letter or of a letter of U+00C0 to U+00FF.
_NO_LETTER = np.ones(256, bool)
_NO_LETTER[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), 0xC3]] = False


def _no_second(raw: np.ndarray) -> np.ndarray:
    """The second bytes of U+00D7 and U+00F7, the two signs among those letters."""
    out = np.zeros(len(raw), bool)
    out[1:] = (raw[:-1] == 0xC3) & ((raw[1:] == 0x97) | (raw[1:] == 0xB7))
    return out


def _odd_rows(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows with characters above 255, or with white space that is not among U+0009 to U+000D and U+0020."""
    odd = (raw >= 0xC4) | ((raw >= 0x1C) & (raw <= 0x1F))
    if len(raw) > 1:
        odd[:-1] |= (raw[:-1] == 0xC2) & ((raw[1:] == 0x85) | (raw[1:] == 0xA0))
    seen = np.concatenate([[0], np.cumsum(odd)])
    return np.flatnonzero(seen[offsets[1:]] > seen[offsets[:-1]])


def _ranges(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the pieces of plain rows, in order. Of white space before a word, the last character goes with the word if it is a
    blank and alone if not, and what precedes it is a piece; white space at the end of a row is one piece."""
    starts, ends, rows = A.word_bounds(raw, offsets)
    some = rows[:-1] < rows[1:]
    before, tail = np.concatenate([[0], ends[:-1]])[: len(starts)], offsets[:-1].copy()
    before[rows[:-1][some]] = offsets[:-1][some]
    tail[some] = ends[rows[1:][some] - 1]
    gap = starts - before
    lead = (gap > 0) & (raw[np.maximum(starts, 1) - 1] == 0x20) if len(starts) else np.zeros(0, bool)
    head, alone, rest = gap > 1, (gap > 0) & ~lead, tail < offsets[1:]
    one, two, first = A.without_marks(raw, starts, ends)
    one[first] -= lead
    a = np.concatenate([one, before[head], starts[alone] - 1, tail[rest]])
    b = np.concatenate([two, starts[head] - 1, starts[alone], offsets[1:][rest]])
    order = np.argsort(a, kind="stable")
    return a[order], b[order]


def _piece_ranges(column: pa.Array, split, plain: bool) -> tuple[np.ndarray, ...]:
    """Distinct pieces of a column's texts (an array of bytes, where each starts and ends in it, their hashes, which are in order), which of them
    are letters only, how often each occurs, the place of every piece among them, and the first piece of each row."""
    raw, offsets = A.strings(column)
    odd = _odd_rows(raw, offsets) if plain else np.arange(len(offsets) - 1)
    if plain:
        starts, ends = _ranges(raw, offsets)
        rows = np.searchsorted(starts, offsets)
    else:
        starts = ends = np.zeros(0, np.int64)
        rows = np.zeros(len(offsets), np.int64)
    if len(odd):  # their pieces are the pattern's matches, whose bytes follow the others
        texts, more, at, upto = column.take(pa.array(odd)).to_pylist(), [], len(raw), 0
        a, b, sizes = [], [], np.diff(rows)
        for row, text in zip(odd.tolist(), texts):
            found = [t.encode() for t in split(text or "")]
            size = np.cumsum([0, *map(len, found)]) + at
            a += [starts[upto : rows[row]], size[:-1]]
            b += [ends[upto : rows[row]], size[1:]]
            sizes[row], upto, at = len(found), rows[row + 1], int(size[-1])
            more += found
        starts, ends = np.concatenate([*a, starts[upto:]]), np.concatenate([*b, ends[upto:]])
        rows = np.concatenate([[0], np.cumsum(sizes)])
        raw = np.concatenate([raw, np.frombuffer(b"".join(more), np.uint8)])
    hashes = A.hashes_of(raw, starts, ends, lower=False)
    first, place, counts = A.distinct(hashes)
    a, b = starts[first], ends[first]
    marks = np.concatenate([[0], np.cumsum(_NO_LETTER[raw] | _no_second(raw))])
    bare = a + (raw[a] == 0x20) if len(a) else a
    return raw, a, b, hashes[first], (marks[b] == marks[bare]) & (bare < b), counts, place, rows


def _pieces(column: pa.Array, split, plain: bool) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same with the pieces as a list."""
    raw, a, b, _, *rest = _piece_ranges(column, split, plain)
    data = raw.tobytes()
    return [data[x:y] for x, y in zip(a.tolist(), b.tolist())], *rest


def _same(raw: np.ndarray, starts: np.ndarray, others: np.ndarray, other_starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether ranges of two arrays hold the same bytes."""
    out = np.ones(len(sizes), bool)
    for k in range(0, len(sizes), 1 << 16):
        part = slice(k, k + (1 << 16))
        one, begin = A.ranges(raw, starts[part], sizes[part])
        other = np.flatnonzero(one != A.ranges(others, other_starts[part], sizes[part])[0])
        out[k + np.searchsorted(begin, other, side="right") - 1] = False
    return out


def _added_up(some: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Hashes, sizes, counts, a flag and bytes of words, of which equal ones (the same bytes, not only the same hash) become one with all their counts."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.uint8)
    hashes, sizes, counts, flags, raw = (np.concatenate(x) for x in zip(none, *some))
    order, starts = np.argsort(hashes, kind="stable"), np.cumsum(sizes) - sizes
    one, two = order[:-1], order[1:]
    like = np.flatnonzero((hashes[one] == hashes[two]) & (sizes[one] == sizes[two]))
    new = np.ones(len(order), bool)
    new[like[_same(raw, starts[one[like]], raw, starts[two[like]], sizes[one[like]])] + 1] = False
    first = order[new]
    if not len(first):
        return none
    text = np.concatenate([A.ranges(raw, starts[x], sizes[x])[0] for x in np.array_split(first, len(first) // 65536 + 1)])
    return hashes[first], sizes[first], np.add.reduceat(counts[order], np.flatnonzero(new)), flags[first], text


#: The dictionary of this worker.
_KEPT: dict = {}


def _forget() -> None:
    """Drop the dictionary of an earlier run."""
    if _KEPT:
        _KEPT.clear()
        A.trim()


#: Distinct pieces that a task counts before it hands their words on.
COUNTED = 450_000


def word_counts(docs: DataFrame, pattern: str, text_col: str = "text") -> DataFrame:
    """(word, n) of every distinct match of the pattern in the corpus."""
    latin = latin_pattern(pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget()
        split = _splitter(pattern, latin)
        some: list[tuple[np.ndarray, ...]] = []  # hashes, sizes, counts, whether letters only, and bytes of pieces, which are split into words at the end
        added = 0

        def rows() -> Iterator[pa.RecordBatch]:
            _, sizes, counts, letters, raw = _added_up(some)
            ends, data = np.cumsum(sizes), raw.tobytes()
            pieces, seen = [data[x:y] for x, y in zip((ends - sizes).tolist(), ends.tolist())], {}
            for piece, whole_word, n in zip(pieces, letters.tolist(), counts.tolist()):
                for word in [piece] if whole_word else map(str.encode, split(piece.decode())):
                    seen[word] = seen.get(word, 0) + n
            some.clear()
            words = list(seen)
            for a in range(0, len(words), 1 << 16):
                part = words[a : a + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()).cast(pa.string()), pa.array(map(seen.__getitem__, part), pa.int64())], ["word", "n"])

        for whole in batches:
            for batch in A.slices(whole, 0, SLICE_BYTES):
                raw, a, b, hashes, letters, counts, _, _ = _piece_ranges(batch.column(0), split, pattern == PLAIN)
                some.append((hashes, b - a, counts, letters, A.ranges(raw, a, b - a)[0]))
                added += len(a)
                if added > COUNTED:
                    some[:], added = [_added_up(some)], 0
                    if len(some[0][0]) > COUNTED:
                        yield from rows()
        yield from rows()
        A.trim()

    # a task's words are distinct: nothing to add up before they are dealt
    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word string, n long").repartition("word")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def dictionary(docs: DataFrame, path: str, pattern: str, text_col: str = "text", limit: int = DICTIONARY, limit_bytes: int = DICTIONARY_BYTES) -> list[bytes]:
    """Ids of the most frequent words, as compressed Arrow streams of (word, ids): all words whose count is in a class (an eighth of a
    power of two) as high as keeps within ``limit`` and ``limit_bytes``. The driver only passes them on.
    """
    counts = materialise(word_counts(docs, pattern, text_col).where(f"n > 1 and length(word) <= {LONG_WORD}").withColumn("class", F.floor(F.log2("n") * 8).cast("int")), "words")
    words, size, least = 0, 0, None
    for row in counts.groupBy("class").agg(F.count("*"), F.sum(F.octet_length("word"))).orderBy(F.desc("class")).collect():  # 512 rows at most
        words, size = words + row[1], size + row[2]
        if words > limit or size > limit_bytes:
            break
        least = row[0]
    wanted = counts.where(F.col("class") >= least) if least is not None else counts.limit(0)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if rows:
            table, out = pa.Table.from_batches(rows).sort_by("word"), pa.BufferOutputStream()
            table = table.set_column(1, "ids", table.column(1).cast(pa.list_(pa.uint16())))
            with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(table, max_chunksize=1 << 16)
            yield pa.RecordBatch.from_arrays([pa.array([out.getvalue().to_pybytes()], pa.binary())], ["blob"])

    folded = wanted.select("word", fold_words(F.array("word"), path)[0].alias("ids"))
    blobs = [bytes(r[0]) for r in folded.mapInArrow(pack, "blob binary").collect()]
    discard(counts)
    return blobs


class _Words:
    """The words of a dictionary in arrays: no object for each, and words are looked up by the thousand."""

    def __init__(self, batches: Iterator[pa.RecordBatch]) -> None:
        raws, sizes, hashes, ids, n_ids = ([np.zeros(0, kind)] for kind in (np.uint8, np.int32, np.uint64, np.uint16, np.int32))
        for batch in batches:  # some at a time, copied, so that no batch stays
            raw, offsets = A.strings(batch.column(0))
            raws.append(raw.copy())
            sizes.append(np.diff(offsets).astype(np.int32))
            hashes.append(A.hashes_of(raw, offsets[:-1], offsets[1:], lower=False))
            lists = batch.column(1)
            ids.append(lists.flatten().to_numpy(zero_copy_only=False).copy())
            n_ids.append(np.diff(lists.offsets.to_numpy()))
        self.raw, size, self.hashes, self.ids, number = map(np.concatenate, (raws, sizes, hashes, ids, n_ids))
        order = np.argsort(self.hashes)
        place = lambda x: (np.cumsum(x) - x).astype(np.int32)[order]
        self.hashes, self.starts, self.sizes, self.first_id, self.n_ids = self.hashes[order], place(size), size[order], place(number), number[order]

    def find(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each word (a range of bytes with its hash), and whether it is there: the same bytes, not only the same hash."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        here = np.zeros(len(at), bool)
        if len(self.hashes):
            here = (self.hashes[at] == hashes) & (self.sizes[at] == ends - starts)
            here[here] = _same(raw, starts[here], self.raw, self.starts[at[here]], self.sizes[at[here]])
        return at, here

    def ids_of(self, at: np.ndarray) -> np.ndarray:
        """The ids of the words at these places, end to end."""
        return A.ranges(self.ids, self.first_id[at], self.n_ids[at])[0]


def _known(blobs: list[bytes]) -> _Words:
    """The dictionary of these streams, once per worker process; a broadcast's value is one object there."""
    if _KEPT.get("of") is not blobs:
        _KEPT.clear()
        _KEPT.update({"is": _Words(batch for blob in blobs for whole in pa.ipc.open_stream(blob) for batch in A.slices(whole, 0, SLICE_BYTES)), "of": blobs})
        A.trim()
    return _KEPT["is"]


def _encoded(known: _Words, words: list[bytes], ranks: dict[bytes, int], fresh: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The ids of words end to end and how many each has; words to fold, whose one id is _NONE, get a number in ``fresh``: which they are, and these numbers."""
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    starts, raw = np.concatenate([[0], ends[:-1]])[: len(ends)], np.frombuffer(b"".join(words), np.uint8)
    at, here = known.find(raw, starts, ends, A.hashes_of(raw, starts, ends, lower=False))
    size, cold, code, more = np.ones(len(words), np.int64), ~here, [], []
    size[here] = known.n_ids[at[here]]
    for k in np.flatnonzero(cold).tolist():
        word = words[k]
        if len(word) > LONG_WORD and len(word.decode()) > LONG_WORD:
            more.append(np.array(merge_long(word, ranks), np.uint16))
            size[k], cold[k] = len(more[-1]), False
        else:
            code.append(fresh.setdefault(word, len(fresh)))
    ids = np.full(size.sum(), _NONE, np.uint16)
    ids[np.repeat(here, size)] = known.ids_of(at[here])
    ids[np.repeat(~here & ~cold, size)] = np.concatenate([np.zeros(0, np.uint16), *more])
    return ids, size, cold, np.array(code, np.int64)


def _latin(text: str) -> bool:
    """All characters are below 256."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _parted(ids: np.ndarray, stops: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Lists, for each row, of the lists of ids between those that are _NONE; and the row of each of these. ``stops``: where rows end."""
    at = np.flatnonzero(ids == _NONE)
    row = np.searchsorted(stops, at, side="right")
    ends = np.concatenate([at - np.arange(len(at)), stops - np.searchsorted(at, stops)])
    order = np.argsort(np.concatenate([2 * at + 1, 2 * stops]), kind="stable")
    flat = ids[ids != _NONE].astype(np.int32)
    inner = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends[order]]), pa.int32()), pa.Array.from_buffers(pa.int32(), len(flat), [None, pa.py_buffer(flat)]))
    number = np.bincount(row, minlength=len(stops)) + 1
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(number)]), pa.int32()), inner), row


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of every text, as an array."""
    spark = docs.sparkSession
    A.prepare(spark)
    A.at_most(spark, "spark.sql.maxPlanStringLength", 100_000)  # the literal tables are long, and plan texts are kept
    blobs = spark.sparkContext.broadcast(dictionary(docs, path, pattern, text_col))
    ranks = spark.sparkContext.broadcast(load_ranks(path))
    latin = latin_pattern(pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, split = _known(blobs.value), _splitter(pattern, latin)
        for whole in batches:
            for batch in A.slices(whole, 1, SLICE_BYTES):
                raw, a, b, hashes, letters, _, place, rows = _piece_ranges(batch.column(1), split, pattern == PLAIN)
                at, here = known.find(raw, a, b, hashes)
                fresh: dict[bytes, int] = {}  # words to fold; in the ids, _NONE stands for each
                other, words = np.flatnonzero(~here), []
                number = np.zeros(len(other) + 1, np.int64)  # words of pieces that are no words of the dictionary
                for k, (x, y, whole_word) in enumerate(zip(a[other].tolist(), b[other].tolist(), letters[other].tolist())):
                    piece = raw[x:y].tobytes()
                    words += [piece] if whole_word else [w.encode() for w in split(piece.decode())]
                    number[k + 1] = len(words)
                own, size, cold, code = _encoded(known, words, ranks.value, fresh)
                done, colds = (np.concatenate([[0], np.cumsum(x)])[number] for x in (size, cold))
                ids = known.ids_of(at[here])
                begin, sizes, first_cold, n_cold = (np.zeros(len(a), np.int64) for _ in range(4))
                sizes[here], sizes[other], n_cold[other], first_cold[other] = known.n_ids[at[here]], np.diff(done), np.diff(colds), colds[:-1]
                begin[here], begin[other] = np.cumsum(sizes[here]) - sizes[here], len(ids) + done[:-1]
                numbers, ends = A.ranges(np.concatenate([ids, own]), begin[place], sizes[place])
                parts, row = _parted(numbers, ends[rows[1:]])
                folds: list[dict[int, int]] = [{} for _ in range(batch.num_rows)]
                places: list[list[int]] = [[] for _ in range(batch.num_rows)]
                cold_at = place[n_cold[place] > 0]
                for r, c in zip(row.tolist(), A.ranges(code, first_cold[cold_at], n_cold[cold_at])[0].tolist()):
                    places[r].append(folds[r].setdefault(c, len(folds[r])))
                spelt = [w.decode() for w in fresh]
                columns = [batch.column(0), parts, pa.array([[spelt[c] for c in x] for x in folds], pa.list_(pa.string())), pa.array(places, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "parts", "cold", "places"])
        A.trim()

    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    split = read.mapInArrow(run, f"doc_id {read.schema['doc_id'].dataType.simpleString()}, parts array<array<int>>, cold array<string>, places array<int>")
    none = F.array().cast("array<int>")

    def joined(folded: Column) -> Column:
        return F.flatten(F.zip_with("parts", "places", lambda ids, i: F.concat(ids, F.coalesce(F.get(folded, i), none))))

    return split.select("doc_id", F.when(F.size("cold") == 0, F.get("parts", F.lit(0))).otherwise(_let(fold_words(F.col("cold"), path), joined)).alias("ids"))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and n_bytes, the length of the decoded bytes."""
    ids = encode(docs, path, pattern)
    out = ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), decode(F.col("ids"), path).alias("p__bytes"))
    return out.select("doc_id", "n_tokens", "ids_sha256", F.sha2("p__bytes", 256).alias("decoded_sha256"), F.octet_length("p__bytes").cast("long").alias("n_bytes"))


def op5_query(spark, sf_dir: str) -> DataFrame:
    """Encode and decode every document with the 50k rank file."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: token counts and digests of every document."""
    import public_tokenizers

    return digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
