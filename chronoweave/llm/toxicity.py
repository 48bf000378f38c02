"""Toxicity scores after noisy-channel deobfuscation.

The channel turns a clean word into what stands in the text: letters become digits or symbols
(``1d10t``), stand apart (``i d i o t``, ``i.d.i.o.t``) or repeat (``idiooot``). Each suspicious
stretch of a text is a lattice of characters; Viterbi decoding under a character language model
of the whole corpus picks the likeliest original. Restored and plain words are then scored by a
list of word and stem features learned from labels.
"""
from __future__ import annotations

import heapq
import re
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import utf8

# ---- character language model -------------------------------------------------------------

#: Characters of the model: word edge, a to z, anything else.
SYMBOLS = 28
#: A 4-gram model has at most SYMBOLS**4 = 614,656 counts, whatever the corpus holds.
ORDER = 4
_EDGE, _OTHER = 0, 27


@lru_cache(maxsize=4096)
def symbol(c: str) -> int:
    """Number of a character: letters without their accents, the rest is one symbol."""
    b = unicodedata.normalize("NFKD", c)[:1]
    return ord(b) - 96 if "a" <= b <= "z" else _OTHER


def grams(word: str) -> list[int]:
    """Codes of the 4-grams of a word between edges."""
    code, out = 0, []
    for s in [*map(symbol, word), _EDGE]:
        code = (code * SYMBOLS + s) % SYMBOLS ** ORDER
        out.append(code)
    return out


_WORD = re.compile(r"[^\W\d_]+")


def gram_counts(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """Counts of all 4-grams of the words of all texts: ``code``, ``n``. Each batch counts its
    distinct words first and sends at most SYMBOLS**ORDER sums."""
    def count(batches):
        from collections import Counter
        total = np.zeros(SYMBOLS ** ORDER, np.int64)
        for b in batches:
            words: Counter = Counter()
            for t in b.column(0):
                words.update(_WORD.findall(t.as_py().decode("utf-8", "replace").lower()))
                if len(words) > 200_000:
                    _add(total, words)
                    words.clear()
            _add(total, words)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["code", "n"])

    return (docs.select(utf8(text).alias("t")).mapInArrow(count, "code int, n long")
            .groupBy("code").agg(F.sum("n").alias("n")))


_FOLD = np.full(0x250, _OTHER, np.int64)
for _c in range(0x250):
    _FOLD[_c] = symbol(chr(_c).lower()[:1])


def _add(total: np.ndarray, words) -> None:
    """Add the 4-grams of counted words to ``total``, all words at once."""
    if not words:
        return
    flat = np.frombuffer("\0".join(words).encode("utf-32-le") + b"\0\0\0\0", "<u4").astype(np.int64)
    s = np.where(flat < len(_FOLD), _FOLD[np.minimum(flat, len(_FOLD) - 1)], _OTHER)
    end = flat == 0
    s[end] = _EDGE
    n = np.repeat(np.fromiter(words.values(), np.int64, len(words)), np.diff(np.flatnonzero(np.concatenate(([True], end)))))
    start = np.flatnonzero(np.concatenate(([True], end[:-1])))
    age = np.arange(len(s)) - np.repeat(start, np.diff(np.append(start, len(s))))
    code = s.copy()
    for k in range(1, ORDER):  # symbols before the word's start are edges (0)
        prev = np.zeros_like(s)
        prev[k:] = s[:-k]
        code += np.where(age >= k, prev, 0) * SYMBOLS ** k
    total += np.bincount(code, weights=n, minlength=len(total)).astype(np.int64)


class CharModel:
    """Interpolated character 4-gram model; ``cost[code]`` is -log P(last | three before)."""

    def __init__(self, counts: np.ndarray):
        c = counts.astype(np.float64).reshape((SYMBOLS,) * ORDER)
        p = np.full(SYMBOLS, 1 / SYMBOLS)
        for k in range(ORDER - 1, -1, -1):  # from unigrams up
            n = c.sum(axis=tuple(range(k))) if k else c
            seen = (n > 0).sum(axis=-1, keepdims=True)
            total = n.sum(axis=-1, keepdims=True)
            # Witten-Bell: weight of the shorter context grows with the kinds seen
            p = (n + np.maximum(seen, 1) * p) / (total + np.maximum(seen, 1))
        self.cost = array("f", (-np.log(p)).reshape(-1).astype(np.float32).tobytes())  # 2.5 MB

    def word_cost(self, word: str) -> float:
        return sum(self.cost[g] for g in grams(word))


# ---- channel ------------------------------------------------------------------------------

# What a digit or symbol can stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "€": "e", "+": "t", "(": "c", "£": "l", "¡": "i"}
#: Costs (negative logarithms) of the channel's steps.
SUBSTITUTE, DROP, APART, SPLIT = 1.0, 3.0, 0.3, 2.0
_JOINERS = set(" .-_*~'`·,/\\")

_SPACED = re.compile(r"(?<![^\W_])(?:[^\W_]|[@$!|€+£¡])(?:[ .\-_*~]{1,2}(?:[^\W_]|[@$!|€+£¡])(?![^\W_@$|€+£¡])){2,}", re.UNICODE)
_NOISY = re.compile(r"[0-9@$!|€+£¡]|([^\W\d_])\1\1|[^\W\d_][.\-_*~'`·/\\][^\W\d_]", re.UNICODE)
_TRIPLE = re.compile(r"(.)\1\1")
_DECOR = re.compile(r"^[^\w@$]+|([^\w])\1{2,}$|[^\w@$!+]+$", re.UNICODE)


def lattice(stretch: str) -> list[list[tuple[str, float]]]:
    """Per position, the characters it can stand for (``""``: nothing) with their costs. A run of
    one letter stands for one or two of it; a joiner for nothing or a word edge."""
    out: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(stretch):
        c = stretch[i]
        j = i
        while j < len(stretch) and stretch[j] == c:
            j += 1
        run = j - i
        if c.isalpha():
            out.append([(c, 0.0 if run == 1 else 0.3 * (run > 2))])
            if run > 1:
                out.append([(c, 0.0 if run == 2 else 0.7), ("", 2 * DROP if run == 2 else 0.3)])
        elif c in _JOINERS:
            out.append([("", APART), (" ", SPLIT)])
        else:
            for _ in range(min(run, 2)):
                out.append([*((x, SUBSTITUTE) for x in LEET.get(c, "")), ("", DROP)])
        i = j
    return out


def decode(stretch: str, model: CharModel) -> str:
    """The likeliest original of a stretch: words separated by single spaces.

    Viterbi over the lattice; a state is the last three symbols. Paths to equal states keep the
    cheapest; a path is a chain of (path before, characters), so long stretches cost no copies.
    Accented letters keep their accents; the model sees them without.
    """
    cost, mod = model.cost, SYMBOLS ** (ORDER - 1)
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for arcs in [*lattice(stretch.lower()), [(" ", 0.0)]]:
        after: dict[int, tuple[float, tuple | None]] = {}
        for ctx, (c0, path) in states.items():
            for ch, extra in arcs:
                if ch == "":
                    key, c1, add = ctx, c0 + extra, ""
                elif ch == " ":
                    if ctx == 0:  # no empty words
                        key, c1, add = 0, c0 + extra, ""
                    else:
                        key, c1, add = 0, c0 + extra + cost[ctx * SYMBOLS + _EDGE], " "
                else:
                    code = ctx * SYMBOLS + symbol(ch)
                    key, c1, add = code % mod, c0 + extra + cost[code], ch
                if key not in after or c1 < after[key][0]:
                    after[key] = (c1, (path, add) if add else path)
        states = after
    path, out = states[0][1], []  # the closing edge leads every path here
    while path:
        path, add = path
        out.append(add)
    return "".join(reversed(out)).strip()


class Restorer:
    """Words of a text, with suspicious stretches restored. Results by token are remembered up to
    ``limit`` tokens."""

    def __init__(self, model: CharModel, limit: int = 150_000):
        self.model, self.limit = model, limit
        self.memo: dict[str, tuple[str, ...]] = {}

    def _restore(self, stretch: str) -> str:
        return decode(stretch, self.model)

    def token(self, token: str) -> tuple[str, ...]:
        got = self.memo.get(token)
        if got is None:
            if len(self.memo) > self.limit:
                self.memo.clear()
            got = self.memo[token] = self.fresh(token)
        return got

    def fresh(self, token: str) -> tuple[str, ...]:
        """Words of a token, plain and restored."""
        words = _WORD.findall(token)
        if not token.isalpha() or _TRIPLE.search(token):  # else nothing is noisy
            core = _DECOR.sub("", _DECOR.sub("", token))
            if _NOISY.search(core) and any(c.isalpha() for c in core):
                words += [w for w in _WORD.findall(self._restore(core)) if w not in words]
        return tuple(words)

    def spaced(self, low: str):
        """Words of each restored stretch of letters that stand apart."""
        for m in _SPACED.finditer(low):
            yield _WORD.findall(self._restore(m[0]))

    def words(self, text: str) -> set[str]:
        low = text.lower()
        out: set[str] = set()
        for token in set(low.split()):
            out.update(self.token(token))
        for words in self.spaced(low):
            out.update(words)
        return out

    def text(self, text: str) -> str:
        """The text with every suspicious stretch replaced by its restored form."""
        low = _SPACED.sub(lambda m: self._restore(m[0]), text.lower())

        def one(m):
            core = _DECOR.sub("", _DECOR.sub("", m[0]))
            if _NOISY.search(core) and any(c.isalpha() for c in core):
                return m[0].replace(core, self._restore(core))
            return m[0]
        return re.sub(r"\S+", one, low)


# ---- features and scores ------------------------------------------------------------------

STEMS = (4, 5, 6, 7, 8)


@lru_cache(maxsize=30_000)
def features(word: str) -> tuple[str, ...]:
    """The word and its beginnings of 4 to 8 letters, where these are not the word."""
    return (word, *(word[:k] + "*" for k in STEMS if len(word) > k))


class Scorer:
    """Score of a text from the features that it holds: 1 - (1 - base) * prod(1 - p)."""

    def __init__(self, base: float, chance: dict[str, float]):
        self.base, self.chance = base, chance
        self.memo: dict[str, tuple[str, ...]] = {}

    def hits(self, words: set[str]) -> set[str]:
        out: set[str] = set()
        memo, chance = self.memo, self.chance
        if len(memo) > 200_000:
            memo.clear()
        for w in words:
            got = memo.get(w)
            if got is None:
                got = memo[w] = tuple(f for f in features(w) if f in chance)
            if got:
                out.update(got)
        return out

    def score(self, words: set[str]) -> float:
        return self.of_hits(self.hits(words))

    def of_hits(self, held: set[str]) -> float:
        rest = 1 - self.base
        for p in sorted(self.chance[f] for f in held):
            rest *= 1 - p
        return min(1.0, max(0.0, 1 - rest))


class TokenHits(dict):
    """Features that a token's words hold, remembered by token: most hold none. What is remembered
    has at most ``limit`` characters."""

    def __init__(self, restore: "Restorer", scorer: Scorer, limit: int = 2_000_000):
        super().__init__()
        self.restore, self.scorer, self.limit, self.size = restore, scorer, limit, 0
        #: How the words begin that can hold a feature: a word, or a stem of ``STEMS[0]`` letters or more.
        self.heads = {f[:STEMS[0]].removesuffix("*") for f in scorer.chance}

    def of(self, words) -> tuple[str, ...]:
        chance, heads, k = self.scorer.chance, self.heads, STEMS[0]
        return tuple({f for w in words if w[:k] in heads for f in features(w) if f in chance})

    def __missing__(self, token: str) -> tuple[str, ...]:
        self.size += len(token) + 1
        got = self[token] = self.of((token,) if token.isalpha() and not _TRIPLE.search(token) and token.isascii() else self.restore.fresh(token))
        return got

    def score(self, text: str) -> float:
        """As ``scorer.score(restore.words(text))``."""
        if self.size > self.limit:
            self.clear()
            self.size = 0
        low = text.lower()
        held = set().union(*set(map(self.__getitem__, set(low.split()))))
        for stretch in self.restore.spaced(low):
            held.update(self.of(stretch))
        return self.scorer.of_hits(held)


def choose(rows: list[tuple[int, list[int]]], names: list[str], *, least: int = 3, purity: float = 0.9) -> tuple[float, dict[str, float]]:
    """Features that explain the toxic rows, most telling first (many toxic rows, and hardly any other): each must be right in ``purity``
    of the rows that no chosen feature covers yet, and cover ``least`` toxic ones of them. A word
    that only accompanies a chosen one explains nothing more and is left out. Returns the share
    of toxic rows among the uncovered, and each feature's smoothed share among all its rows."""
    y = np.array([r[0] for r in rows], np.int64)
    holders: list[list[int]] = [[] for _ in names]
    for i, (_, fs) in enumerate(rows):
        for f in fs:
            holders[f].append(i)
    at = [np.array(h, np.int64) for h in holders]
    open_ = np.ones(len(y), bool)
    chosen: dict[str, float] = {}

    def gain(f: int) -> float:
        left = at[f][open_[at[f]]]
        t = int(y[left].sum())
        if t < least or t < purity * len(left):
            return 0.0
        # at equal counts the longest stem and, before it, the whole word win: they say no more than was seen
        return t * ((t + 0.5) / (len(left) + 1.0)) ** 8 + (1e-5 * len(names[f]) if names[f].endswith("*") else 1e-3)

    heap = [(-g, f) for f in range(len(names)) if (g := gain(f))]
    heapq.heapify(heap)
    while heap:
        _, f = heapq.heappop(heap)
        g = gain(f)
        if not g:
            continue
        if heap and g < -heap[0][0]:  # others have become better since
            heapq.heappush(heap, (-g, f))
            continue
        t, n = int(y[at[f]].sum()), len(at[f])
        chosen[names[f]] = (t + 0.5) / (n + 1.0)
        open_[at[f]] = False
    base = (float(y[open_].sum()) + 0.5) / (int(open_.sum()) + 10.0)
    return base, chosen


def in_sample(key: Column, share: float) -> Column:
    """Rows whose key hashes into the first ``share`` of all hashes."""
    return F.pmod(F.xxhash64(key, F.lit("fit")), F.lit(1_000_000)) < int(share * 1_000_000)


def held_out(key: Column) -> Column:
    """The fold that is never learned from: crc32 of the key as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, model: CharModel | Broadcast, *, key: str = "doc_id", text: str = "text",
        label: str = "toxic", fit_rows: int = 24_000) -> Scorer:
    """Learn a scorer from at most about ``fit_rows`` labelled rows (a hash of the key chooses
    them; all, if there are fewer) outside the held-out fold.

    Counting features is a Spark aggregation over those rows; the telling features, each held by
    three toxic sampled rows or more, and which rows hold them, are what the driver gets.
    """
    usable = (labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(key)))
              .groupBy(F.col(key).cast("long").alias("k")).agg(F.max(label).cast("int").alias("y")))
    n = usable.count()
    sample = usable.where(in_sample(F.col("k"), min(1.0, fit_rows / max(1, n))))
    # about fit_rows pairs of two numbers at most, whatever the tables hold: texts stay where they are
    rows = (docs.select(F.col(key).cast("long").alias("k"), utf8(text).alias("t")).join(F.broadcast(sample), "k")
            .select("y", "t"))
    # SYMBOLS**ORDER numbers
    cost = model if isinstance(model, Broadcast) else docs.sparkSession.sparkContext.broadcast(model)

    def each(batches):
        restore = Restorer(cost.value)
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1)):
                words = restore.words(t.as_py().decode("utf-8", "replace"))
                yield y, {f for w in words for f in features(w)}

    def count(batches):
        toxic: dict[str, int] = {}
        clean: dict[str, int] = {}

        def out():
            names = list(toxic.keys() | clean.keys())
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([toxic.get(f, 0) for f in names], pa.int64()),
                 pa.array([clean.get(f, 0) for f in names], pa.int64())], names=["f", "t", "c"])
        for y, fs in each(batches):
            into = toxic if y else clean
            for f in fs:
                into[f] = into.get(f, 0) + 1
            if len(toxic) + len(clean) > 250_000:
                yield out()
                toxic.clear()
                clean.clear()
        yield out()

    counted = rows.mapInArrow(count, "f string, t long, c long").groupBy("f").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    telling = (counted.where("t >= 3 AND t >= 0.9 * (t + c)").orderBy(F.desc(F.expr("t * (t + 0.5) / (t + c + 1.0)")), "f")
               .select("f").collect())
    names = [r["f"] for r in telling]
    at = {f: i for i, f in enumerate(names)}
    index = docs.sparkSession.sparkContext.broadcast(at)  # features of fit_rows rows at most

    def mark(batches):
        look = index.value
        ys, fs = [], []
        for y, got in each(batches):
            ys.append(y)
            fs.append(sorted(look[f] for f in got if f in look))
        yield pa.RecordBatch.from_arrays([pa.array(ys, pa.int32()), pa.array(fs, pa.list_(pa.int32()))], names=["y", "f"])

    marked = [(r["y"], r["f"]) for r in rows.mapInArrow(mark, "y int, f array<int>").where("y = 1 OR size(f) > 0").collect()]
    quiet = max(0, sample.count() - len(marked))
    base, chance = choose(marked + [(0, [])] * quiet, names)
    index.destroy()
    return Scorer(base, chance)


def char_model(docs: DataFrame, *, text: str = "text") -> CharModel:
    """The model of all texts; the driver gets at most SYMBOLS**ORDER counts."""
    total = np.zeros(SYMBOLS ** ORDER, np.int64)
    got = gram_counts(docs, text=text).toArrow()
    total[got.column("code").to_numpy()] = got.column("n").to_numpy()
    return CharModel(total)


def toxicity(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text",
             threshold: float = 0.5, **params) -> DataFrame:
    """Score every text: all columns of ``docs`` plus held_out, score (0 to 1), predicted.

    The character model counts all texts; the scorer learns from labelled rows outside the
    held-out fold (see :func:`fit`). A score depends on the text only. Null and empty texts
    score the base rate of texts without a telling word. Null keys are scored like others and
    never learned from; their held_out follows the empty key. Repeated rows get equal scores.
    Without usable labels every score is the same low base. Empty table: no rows.
    """
    sc = docs.sparkSession.sparkContext
    model = sc.broadcast(char_model(docs, text=text))
    scorer = sc.broadcast(fit(docs, labels, model, key=key, text=text, **params))

    def score(batches):
        s = TokenHits(Restorer(model.value, limit=0), scorer.value)
        for b in batches:
            t = [s.score(x.as_py().decode("utf-8", "replace")) for x in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(t, pa.float64())], names=[*b.schema.names[:-1], "__score"])

    own = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    base = docs.select(*[F.col(f"`{c}`") for c in own], utf8(text).alias("__bytes"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields[:-1]), "__score double"])
    return base.mapInArrow(score, schema).select(
        *[F.col(f"`{c}`") for c in own], held_out(F.col(key)).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= threshold).cast("int").alias("predicted"))

