"""Language-model scoring with sharded Elias-Fano n-gram tries.

Interpolated absolute discounting over words and ends of texts:
``p(w|h) = q(w|h) + (1 - sum of q(.|h)) * p(w|h')``, where h' is h without its first word, q is ``(c(hw) - D) / c(h)`` quantised to
eight bits of log10, rounded down, and ``p1(w) = (c(w) + 1) / (N + V + 1)``; an unseen h gives p(w|h'). Contexts have up to
``order`` - 1 words (2 or 3); one begin stands before each text. What rounding takes goes to the shorter context, so that the
probabilities of a context add up to one and no score is above 0.

The corpus never meets in one place. A task turns its documents into blocks of about BLOCK_TOKENS; a
block sends each shard its distinct n-grams, once, with their training counts. A shard (by hash of the
n-gram's first word; frequent first words are salted by the second, frequent pairs by the third) adds the counts, builds a trie whose
levels are words, pairs and triples, maps these
from a file of its own task (a lost task builds it again), and answers every block by context-relative successor search: one byte per
n-gram. Blocks then add up their texts' scores. All that moves is distinct and compressed (a follower is two bytes for one of
the FREQUENT words of the corpus, eight for others), and
what a task holds is bounded by a block or a shard; the number of shards follows the number of tokens.

A rare successor is known to its shard by 48 bits of its hash: a context with k distinct successors expects k * k / 2**49 pairs of them
that count as one (0.002 for a million).

Results in odd cases: null and empty texts are one end token; a null id trains like the text ''; equal
texts get equal scores; a very long text is a block of its own; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import tempfile
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiweave.llm import arrays as A
from poiweave.llm.elias_fano import NgramTrie, TrieLevel, restore
from poiweave.storage import discard, materialise

BLOCK_TOKENS = 2 << 20
#: Tokens of the corpus for each shard, about; and shards for each shuffle partition, at least, so that small inputs use all tasks.
SHARD_TOKENS, SHARDS_PER_PARTITION = 1 << 20, 2
#: A word or pair with at least this share of a task's tokens is a candidate for salting; SALTS parts each.
#: At most 1 / HOT_SHARE words or pairs can have that share of all tokens.
HOT_SHARE, SALTS = 0.002, 32
#: So many words at most, each with this share of the tokens at least, are written as two bytes. Only the size of messages depends on it.
FREQUENT, FREQUENT_SHARE = 65_535, 2.0**-20
HELD_OUT_MODULUS, HELD_OUT = 7, 2
_END, _BEGIN = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)
_FINGER = np.uint64((1 << 48) - 1)


def held_out(id_col: str) -> Column:
    """crc32 of the id as text, modulo 7, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")), F.lit(0)) % HELD_OUT_MODULUS == HELD_OUT


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end closing each row, and the first token of each row (one more closes)."""
    raw, offsets = A.strings(column)
    parts = [A.word_hashes(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in A.chunks(offsets)]
    words = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint64)
    sizes = np.concatenate([np.diff(p[1]) for p in parts]) if parts else np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    out = np.empty(starts[-1], np.uint64)
    ends = starts[1:] - 1
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner], out[ends] = words, _END
    return out, starts


def _pair_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return A.mix(before * np.uint64(0x9E3779B97F4A7C15) + word)


def _before(token: np.ndarray, starts: np.ndarray, begin) -> np.ndarray:
    """The token before each one; the begin before the first of each row."""
    out = np.empty(len(token), token.dtype)
    out[1:] = token[:-1]
    out[starts[:-1]] = begin
    return out


class _Tally:
    """Counts of hashes, without those of a small share of all."""

    def __init__(self, share: float):
        self.share, self.total = share, 0
        self.words, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, hashes: np.ndarray) -> None:
        got, n = np.unique(hashes, return_counts=True)
        self.total += len(hashes)
        words, back = np.unique(np.concatenate([self.words, got]), return_inverse=True)
        counts = np.bincount(back, weights=np.concatenate([self.counts, n])).astype(np.int64)
        keep = counts >= max(1, self.total * self.share / 8)  # once rare stays cheap: only balance and sizes depend on this list
        self.words, self.counts = words[keep], counts[keep]

    def most(self) -> tuple[np.ndarray, np.ndarray]:
        keep = self.counts >= max(2, self.total * self.share / 2)
        return self.words[keep], self.counts[keep]


#: Rows of the counter: a task's number of tokens, its frequent words, its frequent pairs.
_ALL, _WORD, _PAIR = 0, 1, 2


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, word, n): each task's number of tokens and its frequent words and pairs."""
    words, pairs = _Tally(FREQUENT_SHARE), _Tally(HOT_SHARE)
    for batch in batches:
        for part in A.slices(batch, 0, 1 << 20):
            token, starts = _tokens(part.column(0))
            words.add(token)
            pairs.add(_pair_hash(_before(token, starts, _BEGIN), token))
    for kind, (found, n) in ((_ALL, (np.zeros(1, np.uint64), np.array([words.total]))), (_WORD, words.most()), (_PAIR, pairs.most())):
        for a in range(0, len(found), 1 << 16):
            part = slice(a, a + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found[part]), kind, np.int32)), pa.array(found[part].view(np.int64)), pa.array(n[part].astype(np.int64))], ["kind", "word", "n"])


def _squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays, byte plane by byte plane, compressed."""
    import zstandard

    head = np.array([len(arrays), *(x for a in arrays for x in (a.itemsize, len(a)))], np.int64).tobytes()
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() for a in arrays]
    return zstandard.compress(head + b"".join(planes), 3)


def _expand(blob: bytes) -> list[np.ndarray]:
    import zstandard

    data = zstandard.decompress(blob)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    head, at, out = np.frombuffer(data, np.int64, 2 * n, 8), 8 + 16 * n, []
    for size, length in head.reshape(-1, 2):
        plane = np.frombuffer(data, np.uint8, size * length, at).reshape(size, length)
        out.append(np.ascontiguousarray(plane.T).view(f"<u{size}").ravel() if length else np.zeros(0, f"<u{size}"))
        at += size * length
    return out


def _once(values: np.ndarray) -> np.ndarray:
    """The distinct values in order; ``values`` are sorted in place. NumPy's own way goes through a set of hashes, several times slower here."""
    values.sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def _dealt(main: np.ndarray, item: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Things in order of (shard, number), their shards and whether it is their main one; ``item`` are also known to ``shard``."""
    key = _once(np.concatenate([main.astype(np.int64) * len(main) + np.arange(len(main)), shard.astype(np.int64) * len(main) + item]))
    at, of = (key % len(main)).astype(np.int32), (key // len(main)).astype(np.int32)
    return at, of, main[at] == of


def _distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, back = np.unique(key, return_inverse=True)
    return found, back.astype(np.int32)


class _Block:
    """Tokens of some documents as numbers into ``words`` (0 is the begin), their distinct pairs and triples, and how these are dealt."""

    def __init__(self, words: np.ndarray, token: np.ndarray, starts: np.ndarray, shards: int, hot: np.ndarray, hot_pairs: np.ndarray, order: int):
        self.words, self.token, self.starts = words, token, starts
        key = _before(token, starts, 0).astype(np.int64)
        key *= len(words)
        key += token
        pairs, self.pair_of = _distinct(key)
        self.context, self.follower = (pairs // len(words)).astype(np.int32), (pairs % len(words)).astype(np.int32)
        del key, pairs
        # a triple is the pair that ends before a token, and the token; the first token of a text has none
        self.later = np.zeros(0, np.int64)
        if order > 2:
            inner = np.ones(len(token), bool)
            inner[starts[:-1]] = False
            self.later = np.flatnonzero(inner)
        key = self.pair_of[self.later - 1].astype(np.int64)
        key *= len(words)
        key += token[self.later]
        triples, self.triple_of = _distinct(key)
        parent, last = (triples // len(words)).astype(np.int32), (triples % len(words)).astype(np.int32)
        del key, triples
        is_hot = np.isin(words, hot)
        mixed = lambda w, s: (A.mix(w + s.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(shards)).astype(np.int32)
        salt = ((words & _FINGER) >> np.uint64(17)).astype(np.int64) % SALTS
        salts = lambda n: np.tile(np.arange(SALTS), n)
        # every word is a node of its shard; hot nodes are known to all their salts
        hot_nodes = np.repeat(np.flatnonzero(is_hot), SALTS)
        self.node, self.node_shard, self.main = _dealt(mixed(words, np.zeros(len(words), np.int64)), hot_nodes, mixed(words[hot_nodes], salts(int(is_hot.sum()))))
        # a pair goes with its first word, hot ones are known to all salts of that
        pair_shard = mixed(words[self.context], np.where(is_hot[self.context], salt[self.follower], 0))
        hot_pair = is_hot[self.context] & np.isin(_pair_hash(words[self.context], words[self.follower]), hot_pairs) if order > 2 and len(hot_pairs) else np.zeros(len(pair_shard), bool)
        often = np.repeat(np.flatnonzero(hot_pair), SALTS)
        self.pair, self.pair_shard, self.pair_main = _dealt(pair_shard, often, mixed(words[self.context[often]], salts(int(hot_pair.sum()))))
        # a triple goes with its pair
        triple_shard = pair_shard[parent]
        spread = np.flatnonzero(hot_pair[parent])
        triple_shard[spread] = mixed(words[self.context[parent[spread]]], salt[last[spread]])
        self.triple = np.argsort(triple_shard.astype(np.uint16) if shards <= 1 << 16 else triple_shard, kind="stable").astype(np.int32)
        self.triple_shard, self.parent, self.last = triple_shard[self.triple], parent[self.triple], last[self.triple]

    def parts(self) -> Iterator[tuple[int, slice, slice, slice]]:
        """(shard, its nodes, its pairs, its triples)."""
        some = _once(self.node_shard.copy())
        ends = [(np.searchsorted(x, some), np.searchsorted(x, some, side="right")) for x in (self.node_shard, self.pair_shard, self.triple_shard)]
        for k, s in enumerate(some):
            yield int(s), *(slice(a[k], b[k]) for a, b in ends)


#: What a message, an answer and a closing count are called in the column ``kind``, besides the block itself.
_MAIL, _OWN, _ANSWER, _TOTAL = 0, 1, 2, 3


def _codes(words: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The place from 1 of words in the sorted list of frequent ones; 0 for others."""
    if not len(frequent):
        return np.zeros(len(words), np.uint16)
    at = np.minimum(np.searchsorted(frequent, words), len(frequent) - 1)
    return np.where(frequent[at] == words, at + 1, 0).astype(np.uint16)


def _words_of(code: np.ndarray, rare: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Words from their codes; those without one come from ``rare``, in order."""
    out, known = np.empty(len(code), np.uint64), code > 0
    out[known], out[~known] = frequent[code[known].astype(np.int64) - 1], rare
    return out


def _keeper(block_id: int, shards: int) -> int:
    """The shard that a block's own tokens pass through. By hash: the numbers of first blocks are all multiples of 1 << 24, and as many shards
    as a power of two would leave them all to shard 0."""
    return int(A.mix(np.array([block_id], np.uint64))[0] % np.uint64(shards))


def _sender(shards: int, hot: np.ndarray, hot_pairs: np.ndarray, frequent: np.ndarray, order: int):
    """Documents to messages: (dest, block, kind, blob). Mail goes to shards; a block's own tokens pass through one of them."""

    def messages(block_id: int, ids: list, held: list, token: list, starts: list) -> Iterator[pa.RecordBatch]:
        hashes, sizes, held = np.concatenate(token), np.concatenate(starts), np.array(held, bool)
        token.clear()
        first = np.concatenate([[0], np.cumsum(sizes)])
        words, number, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        del hashes
        rank = np.argsort(-counts, kind="stable")  # frequent words get small numbers
        place = np.empty(len(rank), np.int32)
        place[rank] = np.arange(1, len(rank) + 1)
        words, number = np.concatenate([[_BEGIN], words[rank]]), place[number]
        block = _Block(words, number, first, shards, hot, hot_pairs, order)
        train = np.repeat(~held, sizes)
        pair_count = np.bincount(block.pair_of[train], minlength=len(block.context)).astype("<u4")
        triple_count = np.bincount(block.triple_of[train[block.later]], minlength=len(block.triple)).astype("<u4")
        word_count = np.bincount(number[train], minlength=len(words)).astype("<u4")
        word_count[0] = (~held).sum()  # as a context, the begin stands before every text
        code, finger = _codes(words, frequent), words & _FINGER

        def followers(word: np.ndarray) -> tuple[np.ndarray, ...]:
            rare = finger[word[code[word] == 0]]
            return code[word], (rare & np.uint64(0xFFFFFFFF)).astype("<u4"), (rare >> np.uint64(32)).astype("<u2")

        under = lambda these, inside: np.bincount(np.searchsorted(these, inside), minlength=len(these)).astype("<u4")
        size, dest, blobs = 0, [], []

        def batch() -> pa.RecordBatch:
            n = len(dest)
            kinds = [_OWN if k < 0 else _MAIL for k in dest]
            out = [pa.array([_keeper(block_id, shards) if k < 0 else k for k in dest], pa.int32()), pa.array([block_id] * n, pa.int64()), pa.array(kinds, pa.int32()), pa.array(blobs, pa.binary())]
            return pa.RecordBatch.from_arrays(out, ["dest", "block", "kind", "blob"])

        own = _squeeze(np.array([-1 if i is None else i for i in ids], np.int64).view(np.uint64), np.array([i is None for i in ids], "u1"), held.astype("u1"), sizes.astype("<u4"), code, words[code == 0], number.astype("<u4"))
        dest.append(-1), blobs.append(own)
        yield batch()
        dest, blobs = [], []
        for shard, nodes, pairs, triples in block.parts():
            node, pair = block.node[nodes], block.pair[pairs]
            blobs.append(_squeeze(
                code[node], words[node[code[node] == 0]], block.main[nodes].astype("u1"), word_count[node], under(node, block.context[pair]),
                *followers(block.follower[pair]), block.pair_main[pairs].astype("u1"), pair_count[pair], under(pair, block.parent[triples]),
                *followers(block.last[triples]), triple_count[block.triple[triples]],
            ))
            dest.append(shard)
            size += len(blobs[-1])
            if len(dest) == 256 or size > 4 << 20:
                yield batch()
                size, dest, blobs = 0, [], []
        if dest:
            yield batch()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, k, size = TaskContext.get().partitionId() << 24, 0, 0
        ids, held, token, starts = [], [], [], []
        for batch in batches:
            for part in A.slices(batch, 1, 1 << 20):
                words, first = _tokens(part.column(1))
                ids += part.column(0).to_pylist()
                held += part.column(2).to_pylist()
                token.append(words), starts.append(np.diff(first))
                size += len(words)
                if size >= BLOCK_TOKENS:
                    yield from messages(base + k, ids, held, token, starts)
                    ids, held, token, starts, size, k = [], [], [], [], 0, k + 1
                    A.trim()
        if ids:
            yield from messages(base + k, ids, held, token, starts)
            A.trim()

    return run


def _rows(table: pa.Table) -> Iterator[tuple]:
    """The rows of a table; the last column as buffers that are not copied."""
    for batch in table.to_batches():
        yield from zip(*(c.to_pylist() for c in batch.columns[:-1]), (x.as_buffer() for x in batch.columns[-1]))


def _key(context: np.ndarray, width: int, word: np.ndarray) -> np.ndarray:
    return context.astype(np.uint64) * np.uint64(width) + word.astype(np.uint64)


def _summed(back: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(back, weights=counts, minlength=n).astype(np.int64)


def _answer(table: pa.Table, frequent: np.ndarray) -> pa.Table:
    """A shard: add counts, build the trie, answer every block. The last row has the shard's training tokens and distinct words."""
    mail, out, dest = [], [], None
    for dest, block, kind, blob in _rows(table.select(["dest", "block", "kind", "blob"])):
        if kind == _OWN:
            out.append((block, _OWN, dest, blob.to_pybytes(), None, None))
        else:
            mail.append((block, deque(_expand(blob))))  # each array goes as soon as it is joined to the others
    if mail:
        blocks = [(block, len(m[0]), len(m[5]), len(m[11])) for block, m in mail]
        code, word, main, word_count, pairs_of, code2, low2, high2, main2, count2, triples_of, code3, low3, high3, count3 = (np.concatenate([m.popleft() for _, m in mail]) for _ in range(15))
        mail.clear()
        nodes, node_of = np.unique(_words_of(code, word, frequent), return_inverse=True)
        totals = _summed(node_of, word_count, len(nodes))
        own = _summed(node_of, np.where(main > 0, word_count, 0), len(nodes))
        own[nodes == _BEGIN] = 0
        # frequent followers have their codes as numbers, rare ones come behind
        wide = lambda low, high: low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)
        rare, rare_of = np.unique(np.concatenate([wide(low2, high2), wide(low3, high3)]), return_inverse=True)
        width = FREQUENT + 1 + len(rare)

        def numbers(code: np.ndarray, of: np.ndarray) -> np.ndarray:
            number = code.astype(np.int32)
            number[code == 0] = FREQUENT + 1 + of
            return number

        two, three = numbers(code2, rare_of[: len(low2)]), numbers(code3, rare_of[len(low2) :])
        del rare, rare_of, code, word, main, word_count, low2, high2, low3, high3, code2, code3
        pair_key, pair_of = _distinct(_key(np.repeat(node_of, pairs_of), width, two))
        pair_total = _summed(pair_of, count2, len(pair_key))
        pair_main = np.zeros(len(pair_key), bool)
        pair_main[pair_of] = main2 > 0
        del two, count2, main2
        triple_key, triple_of = _distinct(_key(np.repeat(pair_of, triples_of), width, three))
        triple_total = _summed(triple_of, count3, len(triple_key))
        del three, count3
        # contexts of the third level are the seen pairs, in order
        seen, asked = pair_total > 0, triple_total > 0
        place = np.cumsum(seen) - 1
        split = lambda key: ((key // np.uint64(width)).astype(np.int64), (key % np.uint64(width)).astype(np.int64))
        parent, last = split(triple_key)
        with tempfile.TemporaryDirectory() as folder:
            second = TrieLevel.build(totals, width, pair_key[seen], pair_total[seen], pair_main[seen])
            third = TrieLevel.build(pair_total[seen], width, _key(place[parent[asked]], width, last[asked]), triple_total[asked])
            NgramTrie([second, third]).save(f"{folder}/trie")
            del second, third, triple_key, triple_total, place, asked, seen
            second, third = NgramTrie.load(f"{folder}/trie").levels
            # each n-gram that blocks ask for is searched once
            at = second.find(*split(pair_key))
            below = third.find(np.maximum(at, 0)[parent], last)
            below[at[parent] < 0] = -1
            given = lambda values, at: np.where(at >= 0, values[np.maximum(at, 0)], 0).astype(values.dtype) if len(values) else np.zeros(len(at), values.dtype)
            codes2, spent2, codes3 = given(second.codes, at), given(third.spent, at), given(third.codes, below)
            spent1 = np.array(second.spent)
            del second, third, at, below, parent, last, pair_key
        a = b = c = 0
        for block, n, pairs, triples in blocks:
            node, pair, triple = node_of[a : a + n], pair_of[b : b + pairs], triple_of[c : c + triples]
            out.append((block, _ANSWER, dest, _squeeze(totals[node].astype("<u8"), spent1[node].view("<u4"), codes2[pair], spent2[pair].view("<u4"), codes3[triple]), None, None))
            a, b, c = a + n, b + pairs, c + triples
        out.append((-1, _TOTAL, dest, b"", int(own.sum()), int((own > 0).sum())))
    columns = list(zip(*out)) or [[]] * 6
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    answer = pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["block", "kind", "shard", "blob", "tokens", "distinct"])
    A.trim()
    return answer


def _finisher(shards: int, hot: np.ndarray, hot_pairs: np.ndarray, frequent: np.ndarray, order: int, tokens: int, distinct: int):
    def run(table: pa.Table) -> pa.Table:
        answers = {}
        for kind, shard, blob in _rows(table.select(["kind", "shard", "blob"])):
            if kind == _OWN:
                own = _expand(blob)
            else:
                answers[shard] = blob
        ids, no_id, held, sizes, code, rare, number = own
        words = _words_of(code, rare, frequent)
        starts = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
        number = number.astype(np.int32)
        block = _Block(words, number, starts, shards, hot, hot_pairs, order)
        unigram, spent1 = np.zeros(len(words), np.int64), np.zeros(len(words))
        seen2, spent2, seen3 = np.zeros(len(block.context)), np.zeros(len(block.context)), np.zeros(len(block.triple))
        for shard, nodes, pairs, triples in block.parts():
            total, used1, codes2, used2, codes3 = _expand(answers.pop(shard))
            node, main = block.node[nodes], block.main[nodes]
            unigram[node[main]] = total[main]
            spent1[node] += used1.view("<f4")  # a node or pair is in a shard once
            pair, main = block.pair[pairs], block.pair_main[pairs]
            seen2[pair[main]] = restore(codes2[main])
            spent2[pair] += used2.view("<f4")
            seen3[block.triple[triples]] = restore(codes3)
        unigram[0] = 0
        one = (unigram + 1) / (tokens + distinct + 1)
        add = lambda x: np.add.reduceat(x, starts[:-1])
        n_known = add((unigram > 0)[number].astype(np.int64))
        base = add(np.log10(one)[number])
        p = (seen2 + (1 - spent1)[block.context] * one[block.follower])[block.pair_of]
        p[block.later] *= (1 - spent2)[block.pair_of[block.later - 1]]
        p[block.later] += seen3[block.triple_of]
        scores = pa.table({
            "doc_id": pa.array(ids.view(np.int64), pa.int64(), mask=no_id.astype(bool)), "held_out": pa.array(held.astype(bool)), "n_tokens": pa.array(sizes.astype(np.int64)),
            "n_known": pa.array(n_known), "train_tokens": pa.array(np.full(len(ids), tokens, np.int64)), "base_score": pa.array(base), "score": pa.array(add(np.log10(p, out=p))),
        })
        del block, own, answers, p
        A.trim()
        return scores

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row for each row of ``docs``.

    ``order``: 2 for pairs, 3 for pairs and triples.
    """
    if order not in (2, 3):
        raise ValueError("order is 2 or 3")
    spark = docs.sparkSession
    A.prepare(spark)
    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(_counter, "kind int, word long, n long").groupBy("kind", "word").agg(F.sum("n").alias("n"))
    often = materialise(counted, "frequent")  # at most 2 / FREQUENT_SHARE words of a task
    total = often.where(F.col("kind") == _ALL).agg(F.sum("n")).first()[0] or 0
    shares = F.when(F.col("kind") == _WORD, FREQUENT_SHARE).when(F.col("kind") == _PAIR, HOT_SHARE)
    found = often.where(F.col("n") >= total * shares).toArrow()  # few reach the share: 1 / FREQUENT_SHARE at most, of the words
    discard(often)
    kind, word, n = (found.column(k).to_numpy() for k in range(3))
    word, of_hot = word.view(np.uint64), n >= total * HOT_SHARE
    hot, hot_pairs = np.append(word[(kind == _WORD) & of_hot], _BEGIN), word[kind == _PAIR]
    words = kind == _WORD
    frequent = np.sort(word[words][np.lexsort((word[words], -n[words]))][:FREQUENT])
    shards = max(SHARDS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_TOKENS))
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), held_out(id_col).alias("held"))
    mail = read.mapInArrow(_sender(shards, hot, hot_pairs, frequent, order), "dest int, block long, kind int, blob binary")
    answers = materialise(mail.groupBy("dest").applyInArrow(lambda table: _answer(table, frequent), "block long, kind int, shard int, blob binary, tokens long, distinct long"), "lm-answers")
    sums = answers.agg(F.sum("tokens"), F.sum("distinct")).first()
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return answers.where(F.col("kind").isin(_OWN, _ANSWER)).groupBy("block").applyInArrow(_finisher(shards, hot, hot_pairs, frequent, order, sums[0] or 0, sums[1] or 0), schema)


def op4_query(spark, sf_dir: str) -> DataFrame:
    """Score of every document under the model, of words, pairs and triples, of those that are not held out."""
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), order=3)
