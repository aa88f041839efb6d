"""Periodic runs of words, by an online sparse diagonal dynamic program.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and a length of at least max(MIN_WORDS, 3 q) that no
neighbouring word extends at period q. Reading a text from left to right, each
word's earlier occurrences at lag d advance the match length of the diagonal d:
m matches in a row are a stretch of m + d words with period d. A diagonal that
stops matching is emitted at once where it is long enough, else forgotten.

What keeps the program sparse, without changing any run:

* every run's diagonal has at least max(MIN_WORDS - d, 2 d) >= GRAM matches, so
  an occurrence counts from the moment its last GRAM words match. Words whose
  GRAM-gram occurs once in the text (nearly all of most texts) are never visited.
* a diagonal is opened where its match begins: among the earlier occurrences with
  another word before the gram. From there a comparison of two words a step
  carries it on.
* inside of a run of period q, a diagonal at a multiple of q that begins with the run
  ends with it and covers the same stretch, so it is not opened.
* of diagonals that end together and began together, the smallest lag is the
  period: by Fine and Wilf the others are its multiples.

Memory is a few arrays of one text. Nothing shuffles: a lost task reads its rows
again.

Words: runs of [^\\x20\\x09-\\x0D], as they stand (no lower-casing), compared
exactly. Defined cases: null and empty texts have no words, no runs and the
collapsed text ''; rows that repeat a key are rows of their own; a column of ``docs``
that has the name of a result column is replaced; an empty table gives an empty one."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from tessera.llm.words import BLOCK_BYTES, mix

MIN_WORDS = 24      # of a run
MIN_PERIODS = 3     # of a run
FEW = 8             # up to so many diagonals or occurrences a step, plain Python is faster than NumPy
GRAM = 16           # least max(MIN_WORDS - d, 2 d) over all d

RUNS_TYPE = ArrayType(StructType().add("start", LongType()).add("length", LongType()).add("period", LongType()))
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def numbered(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_Numbers().__getitem__, found), np.int64, len(found))


def _grams(ids: np.ndarray) -> np.ndarray:
    """A hash of the GRAM words from each position on, by doubling."""
    h, width = mix(ids.astype(np.uint64) + np.uint64(1)), 1
    while width < GRAM:
        h = mix(h[:-width] * np.uint64(0x9E3779B97F4A7C15) + h[width:])
        width *= 2
    return h


def _repeated(grams: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Positions whose gram stands elsewhere too, and a number for each gram."""
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    number = np.empty(len(grams), np.int64)
    number[order] = np.cumsum(fresh)
    alone = fresh & np.concatenate([fresh[1:], [True]])
    return np.sort(order[~alone]).tolist(), number


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a text's numbered words, by start
    and period."""
    n = len(ids)
    if n < MIN_WORDS:
        return []
    places, number = _repeated(_grams(ids))
    if not places:
        return []
    found: dict[tuple[int, int], int] = {}

    def emit(lags, begun, end):
        """Diagonals whose words begun..end - 1 match."""
        for d, b in zip(lags.tolist(), begun.tolist()):
            if end - b >= _least(d):
                key = (b - d, end)
                found[key] = min(d, found.get(key, d))

    none = np.zeros(0, np.int64)
    lags, begun, few = none, none, []           # the active diagonals; as pairs, unless they are many
    seen: dict[int, dict[int, list[int]]] = {}  # gram: word before it: positions
    windows = np.lib.stride_tricks.sliding_window_view(ids, GRAM)
    word, last, longest = ids.tolist(), -2, n // MIN_PERIODS
    for t in places:
        i = t + GRAM - 1                        # the word that is read
        if len(lags):
            if t != last + 1:
                emit(lags, begun, last + GRAM)
                lags, begun, few = none, none, []
            elif few and any(word[i - d] != word[i] for d, _ in few) or len(lags) > FEW:
                alive = ids[i - lags] == ids[i]
                if not alive.all():
                    emit(lags[~alive], begun[~alive], i)
                    lags, begun, few = _active(lags[alive], begun[alive])
        before = word[t - 1] if t else -1
        groups = seen.setdefault(int(number[t]), {})
        opening = [u for other, us in groups.items() if other != before for u in us]
        if opening:
            # the runs that the word is in, by what is known so far
            runs = [(q, b - q) for q, b in few or zip(lags.tolist(), begun.tolist()) if i + 1 - b >= _least(q)]
            if len(opening) <= FEW:
                opening = [u for u in opening if t - u <= longest
                           and not any((t - u) % q == 0 and t - u > q and u >= start for q, start in runs)]
            u = np.array(opening, np.int64)
            u = u[t - u <= longest]
            for q, start in runs if len(u) else ():
                u = u[((t - u) % q != 0) | (t - u <= q) | (u < start)]
            if len(u):
                u = u[(windows[u] == windows[t]).all(axis=1)]
                lags, begun, few = _active(np.concatenate([lags, t - u]), np.concatenate([begun, np.full(len(u), t)]))
        groups.setdefault(before, []).append(t)
        last = t
    emit(lags, begun, last + GRAM)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def _least(lag: int) -> int:
    """Matches that a diagonal needs for a run."""
    return max(MIN_WORDS - lag, (MIN_PERIODS - 1) * lag)


def _active(lags: np.ndarray, begun: np.ndarray):
    return lags, begun, list(zip(lags.tolist(), begun.tolist())) if len(lags) <= FEW else []


def collapsed(found: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside of all runs and of each run's first period, joined by a space."""
    if not runs:
        return b" ".join(found)
    keep = np.ones(len(found), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([found[k] for k in np.flatnonzero(keep).tolist()])


def collapse(docs: DataFrame, text: str = "text", runs_col: str = "__runs", text_col: str = "__collapsed",
             arrange: Callable[[object, int], np.ndarray | None] | None = None, key: str = "doc_id") -> DataFrame:
    """``docs`` with each text's runs (by start, then period) and the text with
    every run cut to its first period.

    ``arrange(key, n)`` may name, for a text of n words, the words to read in
    their place (positions in the text); None reads them as they stand."""
    rest = [c for c in docs.columns if c not in (runs_col, text_col)]
    docs = docs.select(*(F.col(f"`{c}`") for c in rest))
    schema = StructType(list(docs.schema.fields)).add(runs_col, RUNS_TYPE).add(text_col, StringType())
    at, at_key = rest.index(text), rest.index(key) if arrange else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at).cast(pa.large_binary())
            begin, size, runs, texts = 0, 0, [], []
            for k in range(batch.num_rows):
                found = (column[k].as_py() or b"").split()     # at \x20 and \x09-\x0D
                order = arrange(batch.column(at_key)[k].as_py(), len(found)) if arrange else None
                if order is not None:
                    found = [found[j] for j in order.tolist()]
                runs.append(find_runs(numbered(found)) if len(found) >= MIN_WORDS else [])
                texts.append(collapsed(found, runs[-1]))
                size += len(texts[-1])
                if size > BLOCK_BYTES or k == batch.num_rows - 1:
                    made = pa.array([[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in runs], _RUNS)
                    part = batch.slice(begin, k + 1 - begin)
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, made, pa.array(texts, pa.binary()).cast(pa.string())], [*rest, runs_col, text_col])
                    begin, size, runs, texts = k + 1, 0, [], []

    return docs.mapInArrow(read, schema)


def best_run(runs: str = "__runs"):
    """The run with the greatest exact length / period of an array by (start,
    period): ties go to the earlier one. Null without runs."""
    first = F.get(runs, F.lit(0))
    return F.reduce(runs, first, lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def periodic_tail(doc_id, n: int) -> np.ndarray | None:
    """Fixed rule: of a tenth of all documents, chosen by the crc32 of the decimal id,
    the words from place a on repeat p words. None for all others, and without an id."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order
