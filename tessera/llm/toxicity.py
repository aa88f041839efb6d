"""Toxicity by noisy-channel restoration.

Channel: a written token comes from an intended one by letters written as
look-alike signs, letters repeated, and letters spread out by spaces or marks.
The possible sources of a suspicious token are a lattice: each run of a
character has its possible readings with their channel probabilities. Viterbi
decoding under a character trigram model, whose counts come from all documents,
picks the reading; a word boundary is a symbol of the model, so spread-out
letters may come out as several words. Neighbouring short tokens (up to ``SHORT``
letters, digits or look-alike signs, or single ones with marks between them; with
any marks and white space around) are one lattice, where each boundary may
drop. A boundary between two parts whose last and first two letters are fixed is
decided by those four alone, so a run is cut there if the boundary stays: the
rest decodes as it would in the whole run. Other tokens are read as they stand.

The classifier is fitted on restored words. For each hashed feature (the word
with repeats collapsed, its first four, five and six letters) it counts toxic and
clean training documents, near copies once (one document per smallest 5-word
shingle hash), at most ``MAX_TRAIN`` labelled rows (those with the smallest hash
of doc_id, if there are more). A word's evidence is its toxic share, each
feature's counts smoothed by the share of the next shorter one, so that a
known word overrules the prefix it shares with others. A document's inputs are
its strongest evidence and the sum of its likely words' evidence. A logistic
regression turns them into a score in (0, 1); its training rows use
leave-one-out counts (of at most ``MAX_FIT`` of them). doc_id, lang and source
are never inputs; labels of held-out rows (crc32(doc_id) mod 5 = 0) are not read.

What is broadcast has a fixed bound: the 64**3 model, at most 2**22 feature
counts, at most MAX_TRAIN labels.

Defined cases: null or empty text scores as a text without evidence; rows
that repeat a doc_id are scored one by one; null doc_ids and null labels are not
trained on; without labels of both classes the score is the share of toxic
labels, or 0 without labels."""

from __future__ import annotations

import math
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm import words
from tessera.llm.common import written

MAX_TRAIN = 200_000
MAX_FIT = 20_000         # training rows (those with the smallest hash of doc_id) that weigh the two inputs
BUCKETS = 1 << 22
FOLDS = 5
SMOOTH = 4.0             # weight of the next shorter feature's share, in documents
LIKELY = 0.5
CACHE_TOKENS = 150_000   # per Python worker; emptied when full, so only speed depends on it
FLUSH_FEATURES = 250_000  # counts that a task sends on at once
THRESHOLD = 0.5
SHORT = 3                # letters or signs of a token that may be a part of a broken word

#: Signs that stand for letters.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
KEEP = math.log(0.5)
DROP_MARK = math.log(0.5)
COLLAPSE_TWO = math.log(0.1)
COLLAPSE = math.log(0.45)
LONG_RUN = math.log(0.1)

_EDGE = ".,;:!?\"'()[]{}<>%*&#~`-–—…«»¡¿"
_PLAIN = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"(.)\1*", re.S)
_TWICE = re.compile(r"(.)\1")
_LONG = re.compile(r"(.)\1\1")
_TRAIL = ".,;:!?"
_SIGNS = "".join(map(re.escape, LOOKALIKES))
_LONE = {c for c in LOOKALIKES if not c.isdigit()}
_SPACED = re.compile(rf"(?:[^\W_]|[{_SIGNS}])(?:(?:[^\w\s]|_)+(?:[^\W_]|[{_SIGNS}]))+")
_AROUND = re.compile(rf"^(?:(?![{_SIGNS}])[\W_])+|(?:(?![{_SIGNS}])[\W_])+$")

# symbols of the character model: 0 boundary, 1-26 a-z, 27.. other Latin letters, 62 digits, 63 any other letter
_LATIN = "ßàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœ"
OTHER, DIGIT = 63, 62
_SYMBOL = np.zeros(0x250, np.uint8)
for _c in range(0x250):
    _s = chr(_c).lower()
    if _s.isdigit():
        _SYMBOL[_c] = DIGIT
    elif len(_s) == 1 and "a" <= _s <= "z":
        _SYMBOL[_c] = ord(_s) - 96
    elif _s in _LATIN:
        _SYMBOL[_c] = 27 + _LATIN.index(_s)
    elif _s.isalpha():
        _SYMBOL[_c] = OTHER


def symbol(c: str) -> int:
    n = ord(c)
    return int(_SYMBOL[n]) if n < 0x250 else OTHER if c.isalpha() else 0


def trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts of symbol trigrams (64**3), with runs of boundaries as one."""
    points = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    s = np.where(points < 0x250, _SYMBOL[np.minimum(points, 0x24F)], np.where(points >= 0x2000, np.where(points < 0x3000, 0, OTHER), OTHER)).astype(np.int32)
    s = s[np.concatenate([[True], (s[1:] != 0) | (s[:-1] != 0)])]
    return np.bincount(s[:-2] * 4096 + s[1:-1] * 64 + s[2:], minlength=64 ** 3) if len(s) > 2 else np.zeros(64 ** 3, np.int64)


@words.tidy
def _counted(batches):
    total = np.zeros(64 ** 3, np.int64)
    for batch in batches:
        texts = words.text_array(batch.column("text"))
        _, offsets = words.raw(texts)
        for i, j in words.blocks(offsets):
            total += trigram_counts(texts.slice(i, j - i).to_pylist())
    at = np.flatnonzero(total)
    yield pa.record_batch([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["trigram", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """log P(c | a, b) over symbols, from all documents (64 x 64 x 64)."""
    rows = docs.select("text").mapInArrow(_counted, "trigram int, n long").groupBy("trigram").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(64 ** 3)
    for r in rows:
        n[r["trigram"]] = r["n"]
    three = n.reshape(64, 64, 64)
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + 0.5) / (one.sum() + 32)
    p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
    return np.log((three + 5 * p2) / (three.sum(2, keepdims=True) + 5)).astype(np.float32)


@lru_cache(maxsize=1 << 14)
def _run_readings(run: str) -> list[tuple[str, float, tuple[int, ...]]]:
    """The readings of a run of one character (three stand for any more), each
    with its log probability and its symbols."""
    c, n = run[0], len(run)
    if c.isalpha():
        out = ([(c, 0.0)] if n == 1 else [(c * 2, 0.0), (c, COLLAPSE_TWO)] if n == 2
               else [(c, COLLAPSE), (c * 2, COLLAPSE), (c * min(n, 3), LONG_RUN)])
    elif c in LOOKALIKES:
        letters = LOOKALIKES[c]
        p = math.log(0.5 / len(letters))
        out = [(c * min(n, 3) if c.isdigit() else " ", KEEP)] + [(x, p) for x in letters]
        out += [(x * 2, p + COLLAPSE_TWO) for x in letters] if n > 1 else []
    else:
        out = [("", DROP_MARK), (" ", DROP_MARK)]
    return [(text, p, tuple(map(symbol, text))) for text, p in out]


def readings(token: str) -> list[list[tuple[str, float]]]:
    """The lattice of a token: for each run of a character its readings."""
    return [[(text, p) for text, p, _ in _run_readings(m.group()[:3])] for m in _RUN.finditer(token)]


_END = [(" ", 0.0, (0,))]


def restore(token: str, model: np.ndarray) -> str:
    """The likeliest source of a token, by Viterbi over its lattice with the
    model's last two symbols (64 * first + second) as state."""
    flat = model.ravel().data
    states = {0: 0.0}
    back: list = []
    for options in [*(_run_readings(m.group()[:3]) for m in _RUN.finditer(token)), _END]:
        new: dict = {}
        come: dict = {}
        for at, score in states.items():
            for text, p, symbols in options:
                to, s = at, score + p
                for z in symbols:
                    if z == 0 and to & 63 == 0:
                        continue
                    three = to << 6 | z
                    s += flat[three]
                    to = three & 4095
                if to not in new or s > new[to]:
                    new[to] = s
                    come[to] = at, text
        back.append(come)
        states = new
    at = max(states, key=lambda k: (states[k], k))
    parts = []
    for come in reversed(back):
        at, text = come[at]
        parts.append(text)
    return "".join(reversed(parts)).strip()


def suspicious(token: str) -> bool:
    """Whether a lower-case token needs the channel."""
    return not token.isalpha() or _LONG.search(token) is not None


def sources(token: str, model: np.ndarray) -> list[str]:
    """The words a token restores to, with repeated letters as one."""
    core = token.strip(_EDGE)
    if not suspicious(core):
        found = [core]
    elif any(c.isalpha() for c in core):
        found = _PLAIN.findall(restore(core, model)) + _PLAIN.findall(core.strip("$@"))
    else:
        return []
    return [w for w in (_RUN.sub(r"\1", w) if _TWICE.search(w) else w for w in found) if len(w) > 2]


def head(word: str) -> str:
    """The longest prefix of a word that is a feature (empty, if it is too short)."""
    return word[:min(6, len(word) - 1)] if len(word) > 4 else ""


_W = zlib.crc32(b"w")


def prefix_features(prefix: str) -> tuple[int, ...]:
    """Hashed features of a head, from four letters on."""
    return tuple(zlib.crc32(b"p" + prefix[:n].encode()) % BUCKETS for n in range(4, len(prefix) + 1))


def word_feature(word: str) -> int:
    return zlib.crc32(word.encode(), _W) % BUCKETS


class _Cache(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) > CACHE_TOKENS:
            self.clear()
        value = self[key] = self.make(key)
        return value


def _part(token: str):
    """(core, last two letters, first two letters) of a lower-case token that may
    be a part of a broken word; the letters are None where their reading is open.
    An empty core is a separator; None is a token that ends a run."""
    core = token if token.isalpha() else _AROUND.sub("", token[1:-1] if token[0] == "(" and token[-1] == ")" else token)
    if len(core) > SHORT and not (not core.isalpha() and _SPACED.fullmatch(core)):
        return None
    fixed = 1 < len(core) <= SHORT and core.isalpha() and not _TWICE.search(core)
    return core, core[-2:] if fixed else None, core[:2] if fixed else None


def joins(letters: str, model: np.ndarray) -> bool:
    """Whether the boundary between two parts drops, by the two letters before
    it and the two after it."""
    a, b, c, d = map(symbol, letters)
    return float(model[a, b, c]) + float(model[b, c, d]) >= float(model[a, b, 0]) + float(model[b, 0, c]) + float(model[0, c, d])


def tokens(text: str, parts=None, dropped=None) -> set[str]:
    """Distinct lower-case tokens of a text, and its runs of short tokens, with a
    space at each boundary. ``parts`` and ``dropped`` keep what ``_part`` and
    ``joins`` say; without them no run is cut."""
    ws = text.lower().split()
    distinct = set(ws)
    found = {w.rstrip(_TRAIL) for w in distinct}
    part = _part if parts is None else parts.__getitem__
    # a longer word of letters alone is no part
    short = {w: p for w in distinct if (len(w) <= SHORT or not w.isalpha()) and (p := part(w)) is not None}
    if not short:
        return found
    run, tail = [], None

    def end_run():
        found.add(" ".join(run))
        letters = [c for c in run if c not in _LONE]
        if 1 < len(letters) < len(run):                   # the signs may be separators
            found.add(" ".join(letters))

    for p in map(short.get, ws):
        if p is None:
            if run:
                if len(run) > 1:
                    end_run()
                run.clear()
            continue
        core, end, start = p
        if not core:
            continue
        if run and dropped is not None and tail is not None and start is not None and not dropped[tail + start]:
            if len(run) > 1:
                end_run()
            run.clear()
        run.append(core)
        tail = end
    if len(run) > 1:
        end_run()
    return found


def _reader(model: np.ndarray):
    """``tokens`` with the cuts that the model decides."""
    parts, dropped = _Cache(_part), _Cache(lambda letters: joins(letters, model))
    return lambda text: tokens(text, parts, dropped)


def _shingled(batches):
    for batch in batches:
        low = []
        for _, _, h, first in words.rows_words(words.text_array(batch.column("text")), words.ALNUM):
            g, begin = words.grams(h, first, 5)
            for r in range(len(first) - 1):
                part = g[begin[r]:begin[r + 1]]
                if not len(part):
                    part = words.mix(np.array([int(h[first[r]:first[r + 1]].sum()) if first[r + 1] > first[r] else 0], np.uint64))
                low.append(int(part.min().view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("__key"), batch.column("toxic"), pa.array(low, pa.int64())], ["__key", "toxic", "low"])


def _evidence(shared):
    def run(batches):
        model = shared.value
        heads = _Cache(prefix_features)
        known = _Cache(lambda t: [f for w in sources(t, model) for f in (*heads[head(w)], word_feature(w))])
        read = _reader(model)
        n = np.zeros((2, BUCKETS), np.int32)
        for batch in batches:
            for text, y in zip(words.text_array(batch.column("text")).to_pylist(), batch.column("toxic").to_pylist()):
                here = set().union(*map(known.__getitem__, read(text)))
                n[y, np.fromiter(here, np.int32, len(here))] += 1
        seen = np.flatnonzero(n.any(0)).astype(np.int32)
        for i in range(0, len(seen), FLUSH_FEATURES):
            part = seen[i:i + FLUSH_FEATURES]
            yield pa.record_batch([pa.array(part), pa.array(n[1, part], pa.int64()), pa.array(n[0, part], pa.int64())], ["feature", "toxic", "clean"])
    return words.tidy(run)


def share(chain, base: float, less: int | None = None) -> float:
    """The toxic share of a word from the (toxic, clean) counts of its
    features, short to long."""
    p = base
    for t, c in chain:
        if less is not None:
            t, c = max(t - (less == 1), 0), max(c - (less == 0), 0)
        p = (t + SMOOTH * p) / (t + c + SMOOTH)
    return p


def _inputs(text: str, read, known: _Cache, base: float) -> tuple[float, float]:
    """(strongest evidence, log of 1 + the evidence of likely words) of a text."""
    shares = list(map(known.__getitem__, read(text)))
    total = 0.0
    for p in shares:
        if p >= LIKELY:
            total += p
    return max(base, max(shares, default=0.0)), math.log1p(total)


def _lookup(model, counts, base: float, less: int | None = None) -> _Cache:
    """The largest share of a token's words. What a head gives is kept for all
    its words. ``less`` is a training row's own label, whose counts are taken out."""
    toxic, clean = (memoryview(np.ascontiguousarray(c)) for c in counts)
    heads = _Cache(lambda h: share([(toxic[f], clean[f]) for f in prefix_features(h)], base, less))
    twice, crc, last = _TWICE.search, zlib.crc32, BUCKETS - 1

    def best(token):
        w = token
        if not w.isalpha():
            w = w.strip(_EDGE)
            if not w.isalpha():
                return of_sources(token)
        if twice(w):
            if _LONG.search(w):
                return of_sources(token)
            w = _RUN.sub(r"\1", w)
        # most tokens are one plain word
        n = len(w)
        if n < 3:
            return 0.0
        f, p = crc(w.encode(), _W) & last, heads[w[:6 if n > 6 else n - 1] if n > 4 else ""]
        t, c = toxic[f], clean[f]
        return (t + SMOOTH * p) / (t + c + SMOOTH) if less is None else share([(t, c)], p, less)

    def of_sources(token):
        found = [(word_feature(w), heads[head(w)]) for w in sources(token, model)]
        return max((share([(toxic[f], clean[f])], p, less) for f, p in found), default=0.0)
    return _Cache(best)


def _training_inputs(shared):
    def run(batches):
        model, counts, base = shared.value
        known, read = [_lookup(model, counts, base, y) for y in (0, 1)], _reader(model)
        for batch in batches:
            y = batch.column("toxic").to_pylist()
            x = [_inputs(t, read, known[v], base) for t, v in zip(words.text_array(batch.column("text")).to_pylist(), y)]
            yield pa.record_batch([pa.array([a for a, _ in x], pa.float64()), pa.array([b for _, b in x], pa.float64()), pa.array(y, pa.int32())],
                                  ["best", "total", "toxic"])
    return words.tidy(run)


def _scored(shared):
    def run(batches):
        model, counts, base, weights = shared.value
        known, read = _lookup(model, counts, base), _reader(model)
        for batch in batches:
            score = [logistic(weights, _inputs(t, read, known, base)) for t in words.text_array(batch.column("__text")).to_pylist()]
            out = batch.drop_columns(["__text"])
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(score, pa.float64())], [*out.schema.names, "__score"])
    return words.tidy(run)


def logistic(weights, x) -> float:
    z = weights[0] + sum(w * v for w, v in zip(weights[1:], x))
    return 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> list[float]:
    """Weights of a ridge logistic regression, by Newton steps."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)), a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w.tolist()


def held_out(id_col="doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % FOLDS == 0


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN):
    """(character model, feature counts, share of toxic labels, weights)."""
    spark = docs.sparkSession
    words.small_batches(spark)
    shared = spark.sparkContext.broadcast
    model = character_model(docs)
    rows = (labels.select(F.col("doc_id").cast("long").alias("__key"), F.col("toxic").cast("int").alias("toxic"))
            .filter("__key IS NOT NULL AND toxic IN (0, 1)").filter(~held_out("__key"))
            .groupBy("__key").agg(F.max("toxic").alias("toxic"))
            .orderBy(F.xxhash64("__key"), "__key").limit(max_train))
    train = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                    .join(F.broadcast(rows), F.col("doc_id") == F.col("__key")).select("__key", "text", "toxic"), "labelled")
    one = (train.mapInArrow(_shingled, "__key long, toxic int, low long").groupBy("low", "toxic").agg(F.min("__key").alias("__key")).select("__key"))
    counts = (train.join(F.broadcast(one.distinct()), "__key").select("text", "toxic")
              .mapInArrow(_evidence(shared(model)), "feature int, toxic long, clean long")
              .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
              .filter("toxic + clean >= 2").selectExpr("feature", "CAST(toxic AS INT) AS toxic", "CAST(clean AS INT) AS clean").toPandas())
    pair = np.zeros((2, BUCKETS), np.int32)
    pair[0, counts["feature"]], pair[1, counts["feature"]] = counts["toxic"], counts["clean"]
    known = train.agg(F.avg("toxic")).first()[0]
    base = min(max(known if known is not None else 0.0, 1e-9), 1 - 1e-9)
    few = rows.orderBy(F.xxhash64("__key"), "__key").limit(MAX_FIT).select("__key")
    few = train.join(F.broadcast(few), "__key")                # at most MAX_FIT keys; the texts do not move
    del counts
    sent = shared((model, pair, base))
    rows = few.select("text", "toxic").mapInArrow(_training_inputs(sent), "best double, total double, toxic int").toPandas()
    sent.unpersist()
    rows = rows.sort_values(["best", "total", "toxic"])       # sums in one order, whatever order the tasks end in
    x, y = rows[["best", "total"]].to_numpy(float), rows["toxic"].to_numpy(float)
    if len(y) == 0 or y.min() == y.max():
        return model, pair, base, [math.log(base / (1 - base)), 0.0, 0.0]
    return model, pair, base, fit_logistic(x, y)


def with_score(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``docs`` with a column ``__score``."""
    fitted = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, max_train))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + ["__score double"])
    return docs.withColumn("__text", F.col("text")).mapInArrow(_scored(fitted), schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``."""
    return with_score(docs, labels).filter(F.col("__score") < threshold).drop("__score")
