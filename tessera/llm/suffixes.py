"""Benchmark decontamination with suffix arrays over the training text.

Each block of documents (a shard) is one suffix array over its words: word
ranks are packed three at a time and sorted, three times over, so suffixes are
ordered by their first 18 words. Every suffix of every benchmark item is then
looked up by binary search (vectorised over all of them); its range of the
array gives all places of its first ``window`` words, and each left-maximal
place is extended word by word to the longest verbatim match. Items go to the
tasks in blocks of a bounded size; several blocks are several passes.

Words: A-Z lower-cased, runs of [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]. A window is
``window`` consecutive words of an item, or the whole item if it has fewer (but
not none). Defined cases: null text has no words; wordless items occur nowhere;
items that repeat an item_id are one item with the windows of all; a null item_id takes part in hits
but is not listed; every row of ``docs`` gives one result row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tessera.llm import words

WINDOW = 10
ITEM_BYTES = 16 << 20    # of benchmark text shipped to the tasks at once
_LIMIT = 1 << 21         # packed ranks are 21 bits wide

_HIT = ("struct<n_words:long,intervals:array<struct<start:long,n_words:long>>,items:array<long>,"
        "matches:array<struct<item_id:long,item_start:long,start:long,n_words:long>>>")


def item_words(items: list[tuple[int | None, str | None]], window: int = WINDOW):
    """(item ids, word hashes, first word of each, suffix starts, window lengths)."""
    array = pa.array([t for _, t in items], pa.string())
    parts = list(words.rows_words(words.text_array(array), words.ALNUM))
    h = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0, np.uint64)
    sizes = np.concatenate([np.diff(p[3]) for p in parts]) if parts else np.zeros(0, np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    starts, lengths, owner = [], [], []
    for r, n in enumerate(sizes):
        m = min(int(n), window)
        for s in range(max(int(n) - m + 1, 0) if n else 0):
            starts.append(first[r] + s)
            lengths.append(m)
            owner.append(r)
    return ([i for i, _ in items], h, first, np.array(starts, np.int64), np.array(lengths, np.int64), np.array(owner, np.int64))


class Shard:
    """The suffix array of a block of documents, in order by at least their first ``depth`` words; a sentinel ends each document."""

    def __init__(self, h: np.ndarray, first: np.ndarray, depth: int = WINDOW):
        n = np.diff(first)
        ends = np.cumsum(n + 1) - 1
        size = len(h) + len(n)
        real = np.ones(size, bool)
        real[ends] = False
        self.vocabulary, inverse = np.unique(h, return_inverse=True)
        self.rank = np.zeros(size, np.int64)      # 0: the sentinel
        self.rank[real] = inverse + 1
        self.real, self.first, self.doc = real, np.concatenate([[0], ends + 1]), np.repeat(np.arange(len(n)), n + 1)
        order, key = self.rank, None
        for step in (1, 3):
            _, order = np.unique(self._pack(order, step), return_inverse=True)
            order = order + 1
        ordered = 9
        while 2 * ordered < depth:
            _, order = np.unique((order << 32) | self._at(order, ordered), return_inverse=True)
            order, ordered = order + 1, 2 * ordered
        key = (order.astype(np.uint64) << np.uint64(32)) | self._at(order, ordered).astype(np.uint64)
        self.array = np.argsort(key, kind="stable")

    @staticmethod
    def _at(x: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros_like(x)
        if by < len(x):
            out[:-by] = x[by:]
        return out

    def _pack(self, x: np.ndarray, step: int) -> np.ndarray:
        if len(x) < _LIMIT:
            return (x << 42) | (self._at(x, step) << 21) | self._at(x, 2 * step)
        _, two = np.unique((x << 32) | self._at(x, step), return_inverse=True)   # a row of over two million words
        return ((two + 1) << 32) | self._at(x, 2 * step)

    def find(self, query: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of the suffix array that starts with each row of
        ``query`` (word ranks, -1 past its length)."""
        out = []
        for after in (False, True):
            lo = np.zeros(len(query), np.int64)
            hi = np.full(len(query), len(self.array), np.int64)
            while (live := lo < hi).any():
                mid = (lo + hi) // 2
                at = self.array[np.minimum(mid, len(self.array) - 1)]
                less = np.zeros(len(query), bool)      # the suffix at mid sorts before the query
                undecided = np.ones(len(query), bool)
                for j in range(query.shape[1]):
                    w = self.rank[np.minimum(at + j, len(self.rank) - 1)]
                    w = np.where(at + j < len(self.rank), w, 0)
                    use = undecided & (j < lengths)
                    less |= use & (w < query[:, j])
                    undecided &= ~(use & (w != query[:, j]))
                if after:
                    less |= undecided
                lo = np.where(live & less, mid + 1, lo)
                hi = np.where(live & ~less, mid, hi)
            out.append(lo)
        return out[0], out[1]


def search(h: np.ndarray, first: np.ndarray, items) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All places of the items' windows in a block of documents: (row, word
    in the row, item, word in the item, window length), unsorted."""
    _, ih, ifirst, starts, lengths, owner = items
    shard = Shard(h, first, int(lengths.max(initial=1)))
    none = np.zeros(0, np.int64)
    if not len(shard.vocabulary) or not len(starts):
        return none, none, none, none, none
    at = np.minimum(np.searchsorted(shard.vocabulary, ih), len(shard.vocabulary) - 1)
    known = np.where(shard.vocabulary[at] == ih, at + 1, -1)
    width = int(lengths.max())
    query = np.full((len(starts), width), -1, np.int64)
    for j in range(width):
        use = j < lengths
        query[use, j] = known[starts[use] + j]
    possible = ~((query < 0) & (np.arange(width) < lengths[:, None])).any(axis=1)
    query, starts, lengths, owner = query[possible], starts[possible], lengths[possible], owner[possible]
    if not len(starts):
        return none, none, none, none, none
    lo, hi = shard.find(query, lengths)
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    place = shard.array[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    row = shard.doc[place]
    return row, place - shard.first[row], owner[which], starts[which] - ifirst[owner[which]], lengths[which]


def longest(h, first, items, row, word, item, inside, length):
    """Left-maximal places, each extended to its longest verbatim match."""
    _, ih, ifirst, *_ = items
    p, q = first[row] + word, ifirst[item] + inside
    before = (word > 0) & (inside > 0)
    before[before] = h[p[before] - 1] == ih[q[before] - 1]
    p, q, row, item, word, inside, length = (x[~before] for x in (p, q, row, item, word, inside, length))
    n = length.copy()
    live = np.ones(len(n), bool)
    while live.any():
        live &= (p + n < first[row + 1]) & (q + n < ifirst[item + 1])
        live[live] = h[(p + n)[live]] == ih[(q + n)[live]]
        n += live
    return row, item, inside, word, n


def _searcher(shared, with_matches: bool):
    def run(batches):
        items = shared.value
        ids = np.array([-1 if i is None else i for i in items[0]], np.int64)
        listed = np.array([i is not None for i in items[0]], bool)
        for batch in batches:
            text = words.text_array(batch.column("__text"))
            n_words, intervals, found, matches = [], [], [], []
            for i, j, h, first in words.rows_words(text, words.ALNUM):
                row, word, item, inside, length = search(h, first, items)
                per = [[[], set(), []] for _ in range(j - i)]
                if len(row):
                    slot = first + np.arange(len(first))          # one free slot after each row
                    begin, at = np.zeros(len(h) + len(first) + 1, np.int64), slot[row] + word
                    np.add.at(begin, at, 1)
                    np.add.at(begin, at + length, -1)
                    edges = np.diff((np.cumsum(begin) > 0).astype(np.int8), prepend=np.int8(0))
                    s, e = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
                    owner = np.searchsorted(slot, s, side="right") - 1
                    for r, a, b in zip(owner.tolist(), (s - slot[owner]).tolist(), (e - s).tolist()):
                        per[r][0].append({"start": a, "n_words": b})
                    both = np.unique(row * len(ids) + item)
                    for r, t in zip((both // len(ids)).tolist(), (both % len(ids)).tolist()):
                        if listed[t]:
                            per[r][1].add(int(ids[t]))
                    if with_matches:
                        for r, t, q, p, n in zip(*(x.tolist() for x in longest(h, first, items, row, word, item, inside, length))):
                            per[r][2].append({"item_id": int(ids[t]) if listed[t] else None, "item_start": q, "start": p, "n_words": n})
                n_words += np.diff(first).tolist()
                intervals += [x[0] for x in per]
                found += [sorted(x[1]) for x in per]
                matches += [x[2] for x in per]
            out = batch.drop_columns(["__text"])
            span = pa.list_(pa.struct([("start", pa.int64()), ("n_words", pa.int64())]))
            match = pa.list_(pa.struct([(c, pa.int64()) for c in ("item_id", "item_start", "start", "n_words")]))
            hits = pa.StructArray.from_arrays(
                [pa.array(n_words, pa.int64()), pa.array(intervals, span), pa.array(found, pa.list_(pa.int64())), pa.array(matches, match)],
                ["n_words", "intervals", "items", "matches"])
            yield pa.RecordBatch.from_arrays([*out.columns, hits], [*out.schema.names, "__hit"])
    return run


def _item_blocks(items: DataFrame, most: int):
    """Lists of (item_id, text) of at most ``most`` bytes of text together,
    read one partition at a time."""
    block, size = [], 0
    for r in items.select("item_id", "text").toLocalIterator():
        n = len(r["text"] or "")
        if block and size + n > most:
            yield block
            block, size = [], 0
        block.append((r["item_id"], r["text"]))
        size += n
    if block:
        yield block


def with_hits(docs: DataFrame, items: DataFrame, text_col: str = "text", window: int = WINDOW, with_matches: bool = True,
              item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``docs`` with a column ``__hit``: word count, hit intervals (words),
    item ids, and the longest matches with their places. Several blocks of
    items add their intervals, items and matches row by row, without a shuffle."""
    spark = docs.sparkSession
    words.small_batches(spark)
    out = None
    for block in _item_blocks(items, item_bytes):
        shared = spark.sparkContext.broadcast(item_words(block, window))
        frame = (docs if out is None else out.withColumnRenamed("__hit", "__old")).withColumn("__text", F.col(text_col))
        schema = T.StructType(frame.drop("__text").schema.fields + T._parse_datatype_string(f"__hit {_HIT}").fields)
        new = frame.mapInArrow(_searcher(shared, with_matches), schema)
        if out is not None:
            new = new.withColumn("__hit", F.struct(
                F.col("__hit.n_words").alias("n_words"),
                F.concat("__old.intervals", "__hit.intervals").alias("intervals"),
                F.array_sort(F.array_union("__old.items", "__hit.items")).alias("items"),
                F.concat("__old.matches", "__hit.matches").alias("matches"))).drop("__old")
        out = new
    if out is None:
        return with_hits(docs, spark.createDataFrame([(None, "")], "item_id long, text string"), text_col, window)
    return out


def hit_words(hit: str = "__hit"):
    """Words inside any interval (those of several blocks of items may overlap)."""
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("end"))

    def add(acc, x):
        end = x["start"] + x["n_words"]
        return F.struct((acc["total"] + F.greatest(F.lit(0), end - F.greatest(x["start"], acc["end"]))).alias("total"),
                        F.greatest(acc["end"], end).alias("end"))
    return F.aggregate(F.array_sort(f"{hit}.intervals"), start, add, lambda acc: acc["total"])


def longest_match(hit: str = "__hit"):
    """The longest verbatim match as (less: - words, start, item_id), ties by place, then item; null without one."""
    return F.array_min(F.transform(f"{hit}.matches", lambda m: F.struct((-m["n_words"]).alias("less"), m["start"].alias("start"), m["item_id"].alias("item_id"))))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window of ``items`` occurs."""
    return with_hits(docs, items, window=window, with_matches=False).filter(F.size("__hit.intervals") == 0).drop("__hit")
