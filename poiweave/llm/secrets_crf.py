"""Secret scans: fixed patterns plus a linear-chain conditional random field over tokens.

Tokens are runs of ``[A-Za-z0-9+/_.=-]``. Every token of a text, short ones, words and numbers as well,
is tagged begin, inside or outside of a secret from its shape, its neighbouring tokens and marks, the key
word before it and features of the whole file; Viterbi finds the best chain of the whole text. Scores of
shapes are kept by token and the rest is array work. A token that is outside in every best chain, as
``decode`` shows from the scores alone, splits the chain there; the result is that of one long chain.
The driver fits the weights on generated, labelled token sequences (``training_set``: bounded by its
parameter) by gradient ascent on the exact log-likelihood; they are a few hundred numbers and travel with
the task.

Base spans stay as they are; a span of the field that overlaps none of them is added with kind ``crf``.
Spans are in code points of the whole match, end exclusive.

Results in odd cases: null and empty texts have no spans; a null id keeps its row; a very long text is one chain like any other; repeated rows get equal results; an empty
table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poiweave.llm import arrays as A

#: Fixed patterns and least lengths of the base spans.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "crf")

TRAINING_SEQUENCES = 1600
#: Tokens whose shape scores a worker keeps, and their characters; beyond either it starts anew.
KEPT_TOKENS, KEPT_CHARS = 1 << 17, 1 << 24
_TOKEN = re.compile(r"([A-Za-z0-9+/_.=-]+)")
#: What the word before a value promises: 1 a key, 2 a password, 3 a phrase of several words.
_KEY_WORD = re.compile(r"secret|token|key|auth|cred|sign", re.IGNORECASE)
_PASS_WORD = re.compile(r"(?:^|[_.-])(?:pwd|pw|pass|passwd|password|passcode|bearer)(?:$|[_.=-])|password|passwd", re.IGNORECASE)
_PHRASE_WORD = re.compile(r"passphrase|pass[_-]phrase|mnemonic|^phrase=?$", re.IGNORECASE)
_ANY_WORD = re.compile(r"pass|pw|secret|token|key|auth|cred|sign|bearer|mnemonic|phrase", re.IGNORECASE)
_CONSONANTS = re.compile(r"[cC]+")
_TURN = re.compile(r"[cv][CV]")
_TAGS = ("O", "B", "I")
_STEP = {("O", "O"), ("O", "B"), ("B", "O"), ("B", "B"), ("B", "I"), ("I", "O"), ("I", "B"), ("I", "I")}
#: What a shape keeps of each character: lower and upper case consonants and vowels, digits, marks.
_KIND = str.maketrans({c: k for k, cs in {"c": "bcdfghjklmnpqrstvwxz", "v": "aeiouy", "C": "BCDFGHJKLMNPQRSTVWXZ", "V": "AEIOUY", "0": "0123456789", "b": "+=", "-": "-_"}.items() for c in cs})
_CLASSES = (("a", "cv"), ("A", "CV"), ("0", "0"), ("b", "b/"), ("-", "-"), (".", "."))
_CHANGE = re.compile(r"(?<=0)[^0]|(?<=[^0])0")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and non-overlapping per kind."""
    out = []
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "apikey", "api_key")):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


#: c * log2(c) of small counts.
_COUNT_BITS = [0.0, *(c * math.log2(c) for c in range(1, 256))]


def _entropy(token: str) -> int:
    """Twice the entropy of the characters in bits, rounded."""
    n, counts = len(token), map(token.count, set(token))
    bits = sum(map(_COUNT_BITS.__getitem__, counts)) if n < 256 else sum(c * math.log2(c) for c in counts)
    return round((math.log2(n) - bits / n) * 2)


def key_kind(token: str) -> int:
    """0 none, 1 key, 2 password, 3 phrase."""
    if not _ANY_WORD.search(token):
        return 0
    return 3 if _PHRASE_WORD.search(token) else 2 if _PASS_WORD.search(token) else 1 if _KEY_WORD.search(token) else 0


#: Least characters of the length features.
_LENGTHS = (2, 4, 6, 8, 12, 16, 20, 24, 32, 48, 64)


def form(kind: str) -> list[str]:
    """Features of one token that need no more than the kinds of its characters."""
    n, digits = len(kind), kind.count("0")
    changes = len(_CHANGE.findall(kind)) if digits else 0
    classes = "".join([k for k, own in _CLASSES if any(c in kind for c in own)])
    return [
        "bias", f"classes={classes}", f"length={bisect_right(_LENGTHS, n)}", f"digits={round(digits / n * 5)}", f"changes={round(changes / n * 8)}", f"dots={min(kind.count('.'), 3)}", f"slashes={min(kind.count('/'), 3)}",
        f"upper_only={'a' not in classes}", f"turns={min(len(_TURN.findall(kind)), 4)}", f"consonants={min(max(map(len, _CONSONANTS.findall(kind)), default=0), 7)}",
    ]


def spelling(token: str) -> tuple[int, int, str, int]:
    """Codes of the features that need the characters: entropy, hexadecimal, given value, key kind."""
    given = ""
    if "=" in token:
        name, _, value = token.partition("=")
        given = f"{key_kind(name)}{min(len(value), 8) // 4}" if value else ""
    return _entropy(token), len(token) >= 8 and not token.strip("0123456789abcdefABCDEF"), given, key_kind(token)


#: Names of the features of ``spelling``.
_SPELLING = ("entropy", "hex", "given", "key")


def shape(token: str) -> list[str]:
    """Features of one token by itself."""
    return form(token.translate(_KIND)) + [f"{k}={v}" for k, v in zip(_SPELLING, spelling(token))]


#: Kinds of the marks between two tokens, as the token after and the token before see them.
_MARKS = ("space", "line", "colon", "colon quote", "quote", "at", "bracket", "hash", "other")


@lru_cache(maxsize=1 << 16)
def _marks(gap: str) -> int:
    """Kind for the token after, 16 x kind for the token before, 256 for a colon on the line, 512 if it ends a value."""
    line, first, last = "\n" in gap or not gap, gap[:1], gap[-1:]
    quoted = last != "" and last in "\"'`"
    if line:
        before = "line"
    elif ":" in gap:
        before = "colon quote" if quoted else "colon"
    else:
        before = "quote" if quoted else "space" if not gap.strip() else {"@": "at", "(": "bracket", "#": "hash"}.get(last, "other")
    after = "colon" if first == ":" else "quote" if first and first in "\"'`" else "line" if line else "space" if not gap.strip() else {"@": "at", ")": "bracket"}.get(first, "other")
    ends = line or any(c in gap for c in ";,)!?&<>") or (first != "" and first in "\"'`")
    return _MARKS.index(before) + 16 * _MARKS.index(after) + 256 * (":" in gap and not line) + 512 * ends


def contexts(gaps: list[str], kinds: np.ndarray, tails: np.ndarray) -> dict[str, np.ndarray]:
    """Codes of the features that depend on neighbours, for every token. ``gaps`` has one more entry than there are tokens.

    ``kinds`` are key kinds of the tokens; ``tails`` are 1 for a last ``=``, 2 for a last ``.``, 3 for the word bearer.
    """
    n = len(kinds)
    marks = np.fromiter(map(_marks, gaps), np.int64, n + 1)
    at = np.arange(n)
    #: A key word that a colon or equals sign follows, and the places where its value must have ended.
    anchor = (kinds > 0) & ((marks[1:] & 256 > 0) | (tails == 1) | (tails == 3))
    ends = marks[:-1] & 512 > 0
    ends[1:] |= tails[:-1] == 2
    follows = np.zeros(n, bool)
    follows[1:] = anchor[:-1] & (marks[1:-1] & 15 != _MARKS.index("line"))
    ends &= ~follows
    last = np.full(n, -1)
    last[1:] = np.maximum.accumulate(np.where(anchor, at, -1))[:-1]
    since = np.minimum(at - last, 15)
    valid = (last >= 0) & (np.maximum.accumulate(np.where(ends, at, -1)) <= last)
    near = np.zeros(n, np.int64)
    for back in (3, 2, 1):
        near[back:] = np.where(kinds[:-back] > 0, kinds[:-back], near[back:])
    return {"before": marks[:-1] & 15, "after": marks[1:] >> 4 & 15, "since": np.where(valid, kinds[last] * 16 + since, 0), "near": near}


#: Codes of each neighbour feature.
_CODES = {"before": len(_MARKS), "after": len(_MARKS), "since": 64, "near": 4}


def tail(token: str) -> int:
    return 1 if token[-1] == "=" else 2 if token[-1] == "." else 3 if token.lower() == "bearer" else 0


def features(pieces: list[str], file: tuple[str, ...]) -> list[list[str]]:
    """Features of every token of a text split into gap, token, gap, ..., gap."""
    tokens, gaps = pieces[1::2], pieces[::2]
    if not tokens:
        return []
    codes = contexts(gaps, np.array(list(map(key_kind, tokens))), np.array(list(map(tail, tokens))))
    own = [f"file:{x}" for x in file]
    return [shape(t) + [f"{k}={codes[k][i]}" for k in _CODES] + own for i, t in enumerate(tokens)]


def file_features(text: str) -> tuple[str, ...]:
    """What the whole text says: code marks, key words, its size."""
    marks = text.count("{") + text.count(";") + text.count("=")
    return (f"code={marks * 200 > len(text)}", f"keys={'key' in text or 'token' in text}", f"size={min(len(text) // 2000, 3)}")


def _generated(rng: random.Random) -> tuple[list[list[str]], list[str]]:
    """One labelled sequence: the features of the tokens of a made-up piece of text and their tags."""
    low, up, num = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    pick = lambda chars, a, b: "".join(rng.choice(chars) for _ in range(rng.randint(a, b)))
    part = lambda: rng.choice(["", "", "s", "st", "tr", "b", "d", "f", "g", "k", "l", "m", "n", "p", "r", "t", "v", "w", "sch", "ch"]) + rng.choice(["a", "e", "i", "o", "u", "ei", "ou", "y"]) + rng.choice(["", "", "n", "r", "s", "l", "t", "nd", "ng", "rst", "ck"])
    stem = lambda: "".join(part() for _ in range(rng.choice([1, 1, 2, 2, 3, 4, 5])))
    cased = lambda w: rng.choices([w, w.capitalize(), w.upper()], [14, 5, 1])[0]
    word = lambda: cased(rng.choice([stem(), stem(), rng.choice("the of and to in is die der und les des et los que por a I x key token sign secret pass password design monkey signal author passage".split())]))
    leet = lambda: stem().capitalize().translate(str.maketrans("oai", "041")) + pick(num, 1, 3) + pick(low, 1, 4)
    mixed = lambda a, b: (lambda t: rng.choice(low) + rng.choice(num) + rng.choice(up) + t)(pick(low + up + num, a - 3, b - 3))
    letters = lambda a, b: rng.choice(low) + rng.choice(up) + pick(low + up, a - 2, b - 2)
    long = [
        lambda: pick("0123456789abcdef", 24, 64), lambda: pick(low + up + num + "+/", 28, 64) + rng.choice(["", "=", "=="]), lambda: rng.choice(["ghp_", "sk-", "xoxb-", "glpat-", "AIza"]) + pick(low + up + num + "-_", 24, 40),
        lambda: "AKIA" + pick(up + num, 16, 16), lambda: ".".join(pick(low + up + num + "-_", 20, 40) for _ in range(3)), lambda: pick(low + up + num, 20, 40), lambda: letters(20, 48),
    ]
    short = [lambda: mixed(8, 11), lambda: mixed(12, 19), lambda: letters(8, 19), lambda: pick("0123456789abcdef", 8, 20), lambda: pick(up + num, 8, 16), lambda: pick(up, 10, 20), lambda: leet() + leet()]
    simple = [lambda: leet(), lambda: leet(), lambda: stem() + stem(), lambda: mixed(6, 11), lambda: letters(6, 11), lambda: pick(low, 8, 14)]
    plain = [
        lambda: pick(num, 1, 7), lambda: pick(num, 12, 19), lambda: f"{rng.randint(1970, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}T{rng.randint(10, 23)}", lambda: f"{stem()}.{stem()}{rng.randint(1, 99)}.{stem()}.example", lambda: f"{stem()}/{stem()}/{rng.randint(1, 9999)}/{stem()}",
        lambda: f"{stem()}-{stem()}-{rng.randint(1, 999)}-{stem()}", lambda: "-".join(pick(num, 3, 4) for _ in range(rng.randint(2, 4))), lambda: f"{rng.randint(0, 255)}.{rng.randint(0, 255)}.{rng.randint(100, 255)}.{rng.randint(100, 255)}", lambda: f"{stem()}{stem()}{rng.randint(0, 9)}{stem()}", lambda: f"{stem()}_{stem()}_{rng.randint(1, 20)}.{rng.choice(['py', 'txt', 'html'])}",
        lambda: "=" * rng.randint(2, 20) + pick(num, 0, 3) + "-" * rng.randint(2, 20), lambda: stem() + stem() + pick(num, 1, 2), lambda: stem().upper() + "." + stem() + pick(num, 2, 2), lambda: f"{pick(num, 1, 8)}.{pick(num, 1, 12)}", lambda: f"{stem()}={stem()}{pick(num, 0, 3)}", lambda: f"{stem()}_{stem()}", lambda: f"{stem()}-{stem()}",
        lambda: rng.choice(low) * rng.randint(3, 90), lambda: "".join(stem() for _ in range(5)), lambda: rng.choice(["...", "--", "-", "=", "/", "."]), lambda: f"{stem()}{stem().capitalize()}{stem().capitalize()}", lambda: f"//{stem()}.{stem()}.example/{stem()}/{rng.randint(1, 999)}", lambda: pick(up, 2, 5) + pick(num, 0, 4),
    ]
    pieces, tags = [""], []

    def put(token: str, tag: str = "O", gap: str = " ") -> None:
        pieces.extend([token, gap])
        tags.append(tag)

    def prose(most: int) -> None:
        for _ in range(rng.randint(0, most)):
            put(word() + rng.choice(["", "", "", "", "", "."]), gap=rng.choice([" ", " ", " ", " ", " ", ", ", "\n", ": ", " (", ") ", "' ", ' "', "@"]))

    keys = ["key", "api", "auth_key", "token", "Token", "secret", "credential", "access_key", "signing_key", "KEY", "client_secret"]
    passes = ["pwd", "PWD", "pw", "pass", "passwd", "db_pass", "password", "Password", "passcode", "DB_PWD", "login_pwd"]
    sure = [": ", ": ", ":", ': "', ": '"]
    for _ in range(rng.randint(1, 2)):
        prose(4)
        kind = rng.random()
        end = rng.choice([" ", " ", "\n", "\n", ", ", '"', "' ", ")"])
        if kind < 0.16:  # long, whatever comes before
            if rng.random() < 0.6:
                put(rng.choice([*keys, "Bearer", word(), word()]), gap=rng.choice([*sure, " "]))
            put(rng.choice(long)(), "B", end)
            if rng.random() < 0.15:
                pieces[-1] = rng.choice(["\n", " "])
                put(pick(low + up + num + "+/", 20, 40), "I", end)
        elif kind < 0.28:  # short, after a key word
            put(rng.choice([*keys[:1], *keys[2:]]), gap=rng.choice(sure))
            put(rng.choice(short)(), "B", end)
        elif kind < 0.36:
            put(rng.choice(["Bearer", "bearer"]), gap=" ")
            put(rng.choice(short)(), "B", end)
        elif kind < 0.48:
            put(rng.choice(passes) + (eq := rng.choice(["", "", "="])), gap=rng.choice(["", '"']) or " " if eq else rng.choice(sure))
            put(rng.choice(simple)(), "B", end)
        elif kind < 0.53:
            put(f"{rng.choice(passes)}={rng.choice([*simple, *short])()}", "B", end)
        elif kind < 0.56:
            put(f"{rng.choice(keys)}={rng.choice(short)()}", "B", end)
        elif kind < 0.66:  # several words
            put(rng.choice(["passphrase", "Passphrase", "pass_phrase", "phrase", "mnemonic", "wallet_mnemonic"]), gap=rng.choice(sure))
            for k in range(n := rng.randint(3, 12)):
                put(stem(), "I" if k else "B", " " if k < n - 1 else '" ' if '"' in pieces[-3] else rng.choice(["\n", "\n", ", "]))
        elif kind < 0.76:  # key words that promise nothing
            put(rng.choice([*keys, *passes, "passphrase", "bearer", "author", "sign", "design", "signal", "monkey"]), gap=" ")
            put(rng.choice(["is", "of", "reset", "must", "was", "and", "for", "that", stem()]))
        elif kind < 0.84:
            put(rng.choice([*keys, "author", "sign", "Signed", "signal", "design", "keyword"]), gap=rng.choice([": ", ": ", ' "']))
            put(rng.choice([stem(), word(), pick(num, 1, 4)]), gap=rng.choice([" ", "\n", ", "]))
        elif kind < 0.88:
            put(rng.choice(["https", "http"]), gap=":")
            put(rng.choice(plain[-2:-1])())
        else:
            put(rng.choice(plain)(), gap=rng.choice([" ", " ", "\n", ")", "@", ", "]))
            put(rng.choice(plain)(), gap=rng.choice([" ", " ", "\n"]))
    prose(5)
    file = (f"code={rng.random() < 0.4}", f"keys={rng.random() < 0.5}", f"size={rng.randint(0, 3)}")
    return features(pieces, file), tags


def training_set(n: int = TRAINING_SEQUENCES, seed: int = 3) -> list[tuple[list[list[str]], list[str]]]:
    """n labelled sequences from a fixed generator."""
    rng = random.Random(seed)
    return [_generated(rng) for _ in range(n)]


def _scores(seen: list[list[str]], weights: dict) -> list[dict[str, float]]:
    return [{t: sum(weights.get((t, f), 0.0) for f in x) if t != "O" else 0.0 for t in _TAGS} for x in seen]


def _log_sum(xs: list[float]) -> float:
    top = max(xs)
    return top + math.log(sum(math.exp(x - top) for x in xs))


def fit(data: list, rounds: int = 6, rate: float = 0.15, decay: float = 1e-4) -> dict:
    """Weights of (tag, feature) and (tag, tag) by stochastic ascent; outside has score 0."""
    weights: dict = {}
    rng = random.Random(5)
    data = list(data)
    for r in range(rounds):
        rng.shuffle(data)
        step = rate / (1 + r)
        for seen, tags in data:
            scores, n = _scores(seen, weights), len(tags)
            move = {(p, t): weights.get((p, t), 0.0) for p, t in _STEP}
            ahead = [{t: scores[0][t] + move.get(("O", t), -1e9) for t in _TAGS}]
            for i in range(1, n):
                ahead.append({t: scores[i][t] + _log_sum([ahead[-1][p] + move.get((p, t), -1e9) for p in _TAGS]) for t in _TAGS})
            back = [{t: move[(t, "O")] for t in _TAGS}]
            for i in range(n - 1, 0, -1):
                back.append({p: _log_sum([move.get((p, t), -1e9) + scores[i][t] + back[-1][t] for t in _TAGS]) for p in _TAGS})
            back.reverse()
            total = _log_sum([ahead[-1][t] + back[-1][t] for t in _TAGS])
            slope: dict = {}
            for i in range(n):
                for t in ("B", "I"):
                    g = (tags[i] == t) - math.exp(ahead[i][t] + back[i][t] - total)
                    for f in seen[i]:
                        slope[(t, f)] = slope.get((t, f), 0.0) + g
            path = ["O", *tags, "O"]
            for p, t in zip(path, path[1:]):
                slope[(p, t)] = slope.get((p, t), 0.0) + 1
            for p, t in _STEP:
                first = math.exp((move[(p, t)] if p == "O" else -1e9) + scores[0][t] + back[0][t] - total)
                last = math.exp(ahead[-1][p] + move[(p, t)] - total) if t == "O" else 0.0
                inner = sum(math.exp(ahead[i - 1][p] + move[(p, t)] + scores[i][t] + back[i][t] - total) for i in range(1, n))
                slope[(p, t)] = slope.get((p, t), 0.0) - first - last - inner
            for k, g in slope.items():
                weights[k] = weights.get(k, 0.0) * (1 - step * decay) + step * g
    return weights


@lru_cache(maxsize=1)
def model() -> dict:
    """The fitted weights; a few seconds, once per process."""
    return fit(training_set())


def _best(scores: list[dict[str, float]], weights: dict) -> list[str]:
    """The best tags of a sequence of scores, outside on both sides."""
    best, links = {t: scores[0][t] + (weights.get(("O", t), 0.0) if ("O", t) in _STEP else -1e9) for t in _TAGS}, []
    for s in scores[1:]:
        link = {t: max((p for p in _TAGS if (p, t) in _STEP), key=lambda p: best[p] + weights.get((p, t), 0.0)) for t in _TAGS}
        best = {t: best[link[t]] + weights.get((link[t], t), 0.0) + s[t] for t in _TAGS}
        links.append(link)
    tag = max(_TAGS, key=lambda t: best[t] + weights.get((t, "O"), 0.0))
    out = [tag]
    for link in reversed(links):
        out.append(tag := link[tag])
    return out[::-1]


def viterbi(seen: list[list[str]], weights: dict) -> list[str]:
    """The best tags of the tokens of a text."""
    return _best(_scores(seen, weights), weights)


class _Field:
    """Weights as arrays, and the shape scores of tokens met before."""

    def __init__(self, weights: dict):
        self.weights = weights
        self.context = {k: np.array([[weights.get((t, f"{k}={c}"), 0.0) for c in range(n)] for t in "BI"]) for k, n in _CODES.items()}
        self.pairs = {f: (weights.get(("B", f), 0.0), weights.get(("I", f), 0.0)) for t, f in weights if f not in _TAGS}
        # over a chain of outside tokens: what opening a span gains, going on with begin or inside, and closing it
        step = {k: weights.get(k, 0.0) - weights.get(("O", "O"), 0.0) for k in _STEP}
        self.open, self.on, self.close = step["O", "B"], (max(step["B", "B"], step["I", "B"]), max(step["B", "I"], step["I", "I"])), max(step["B", "O"], step["I", "O"])
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.chars = 0
        self.known = np.zeros((1 << 12, 4))
        self.forms: dict[str, tuple[float, float]] = {}
        self.spelt: dict[tuple, tuple[float, float]] = {}

    def _sum(self, seen: list[str]) -> tuple[float, float]:
        scores = [self.pairs.get(f, (0.0, 0.0)) for f in seen]
        return sum([b for b, _ in scores]), sum([i for _, i in scores])

    def rows(self, tokens: list[str]) -> np.ndarray:
        """Shape scores (begin, inside), key kind and tail of tokens."""
        if len(self.ids) > KEPT_TOKENS or self.chars > KEPT_CHARS:
            self.clear()
        ids, forms, spelt = self.ids, self.forms, self.spelt
        fresh = []
        for t in set(tokens).difference(ids):
            kind, codes = t.translate(_KIND), spelling(t)
            if (a := forms.get(kind)) is None:
                a = forms[kind] = self._sum(form(kind))
            if (b := spelt.get(codes)) is None:
                b = spelt[codes] = self._sum([f"{k}={v}" for k, v in zip(_SPELLING, codes)])
            ids[t] = len(ids)
            self.chars += len(t)
            fresh.append((a[0] + b[0], a[1] + b[1], codes[3], tail(t)))
        if fresh:
            while len(ids) > len(self.known):
                self.known = np.concatenate([self.known, np.zeros_like(self.known)])
            self.known[len(ids) - len(fresh) : len(ids)] = fresh
        return self.known[np.fromiter(map(ids.__getitem__, tokens), np.int64, len(tokens))]

    def decode(self, pieces: list[str], file: tuple[str, ...]) -> list[tuple[int, str]]:
        """(place, tag) of every token that is not outside on the best chain."""
        rows = self.rows(pieces[1::2])
        codes = contexts(pieces[::2], rows[:, 2].astype(np.int64), rows[:, 3])
        own = [sum(self.weights.get((t, f"file:{x}"), 0.0) for x in file) for t in "BI"]
        begin, inside = (rows[:, k] + own[k] + sum(self.context[f][k][codes[f]] for f in _CODES) for k in (0, 1))
        # A run of tagged tokens can always be made outside as a whole, so on a best chain each such run gains at least
        # nothing. A token is outside on every best chain if the most that any run through it can gain is below zero.
        on = np.cumsum(np.maximum(begin + self.on[0], inside + self.on[1]))
        most = np.maximum.accumulate(begin + self.open - on) + np.maximum.accumulate(on[::-1])[::-1] + self.close
        left = np.flatnonzero(most > -1e-6)
        out = []
        for run in np.split(left, np.flatnonzero(np.diff(left) > 1) + 1) if len(left) else []:
            scores = [{"O": 0.0, "B": b, "I": i} for b, i in zip(begin[run].tolist(), inside[run].tolist())]
            out += [(i, t) for i, t in zip(run.tolist(), _best(scores, self.weights)) if t != "O"]
        return out


_FIELDS: dict = {}


def _field(weights: dict) -> _Field:
    """The arrays of these weights, kept for the latest; each task brings its own copy of equal weights."""
    if _FIELDS.get("of") is not weights:
        if _FIELDS.get("of") != weights:
            _FIELDS["is"] = _Field(weights)
        _FIELDS["of"] = weights
    return _FIELDS["is"]


def crf_spans(text: str, weights: dict) -> list[tuple[int, int, str]]:
    """(start, end, ``crf``) of begin-inside chains."""
    pieces = _TOKEN.split(text)
    if len(pieces) < 3:
        return []
    tagged = _field(weights).decode(pieces, file_features(text))
    if not tagged:
        return []
    ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
    out: list[tuple[int, int, str]] = []
    for i, t in tagged:
        start, end = int(ends[2 * i]), int(ends[2 * i + 1])
        if t == "B":
            out.append((start, end, "crf"))
        else:
            out[-1] = (out[-1][0], end, "crf")
    return out


def find_secrets(text: str | None, weights: dict) -> list[tuple[int, int, str]]:
    """All spans of a text by start, then kind."""
    text = text or ""
    base = base_spans(text)
    more = [s for s in crf_spans(text, weights) if not any(s[0] < e and b < s[1] for b, e, _ in base)]
    return sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2])))


def redact(text: str | None, weights: dict, mark: str = "[SECRET]") -> str | None:
    """The text with every span replaced; overlapping spans become one mark. Null stays null."""
    if not text:
        return text
    parts, at = [], 0
    for start, end, _ in find_secrets(text, weights):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join(parts) + text[at:]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return doc_id, n_assign, n_access, n_hex, n_crf, base_sha256, spans: one row for each row of ``docs``."""
    A.prepare(docs.sparkSession)
    weights = model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                spans = find_secrets(text, weights)
                join = lambda xs: ",".join(f"{k}:{a}:{b}" for a, b, k in xs)
                base = join([s for s in spans if s[2] != "crf"])
                rows.append((*(sum(s[2] == k for s in spans) for k in KINDS), hashlib.sha256(base.encode()).hexdigest(), join(spans)))
            columns = list(zip(*rows)) or [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["doc_id", "n_assign", "n_access", "n_hex", "n_crf", "base_sha256", "spans"])

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return read.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_crf long, base_sha256 string, spans string")


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with secrets replaced in the text column; all else unchanged."""
    A.prepare(docs.sparkSession)
    weights = model()
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            clean = pa.array([redact(t, weights) for t in column.to_pylist()], column.type)
            yield pa.RecordBatch.from_arrays([clean if k == at else c for k, c in enumerate(batch.columns)], schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def op6_query(spark, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: secrets are replaced by a mark. ``n_chars`` follows the new text."""
    out = redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
