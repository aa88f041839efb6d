"""Sampled SentencePiece segmentations without replacement (Gumbel top-k).

A text's lattice has an edge for every vocabulary piece that stands at a
place; a character outside the vocabulary is a chain of its byte pieces. An
edge weighs log(1 / (rank + RANK_SHIFT)) up to a constant, a Zipf law over the
vocabulary's own order (its scores are ranks, not probabilities). No piece
crosses from a non-space to a space or holds a line end, so the lattice is a
chain of small ones, one a chunk (spaces and the word after them), each built
once and kept.

Backward sums give every edge's probability among those that leave its node.
The search keeps a queue of regions: all segmentations that leave a known path
P at one of its steps [a, b). A region's key is its largest perturbed log
probability, a Gumbel at the region's log mass truncated at its parent's key, so
keys are exact bounds and the best region always holds the next sample. It is
popped; the step it leaves P at, the edge it takes and its continuation are
drawn by probability; and what is left splits into four regions. The result is
the top k of Gumbel-perturbed segmentations: distinct, in order, without
replacement. A sample's inclusion score is log(1 - exp(-exp(log p - kappa)))
with kappa the key after the k-th.

All draws are hashes of (row key, sample, place), so a document's samples do not
depend on the batch. Continuations are drawn for a whole block of documents at
once.

Defined cases: null and empty texts have one empty segmentation; a text with
fewer than k segmentations gives all it has (inclusion 0, certain); a null key
counts as 0; rows that repeat a key and text get the same samples; U+2581
decodes as a space, so a text that holds it does not round-trip."""

from __future__ import annotations

import heapq
import math
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm import words

K = 4
RANK_SHIFT = 2.7
CACHE_NODES = 1_200_000      # per Python worker; emptied when full, so only speed depends on it
ADD_CHARS = 1 << 17          # of new chunks built at once (or one chunk): what it takes in memory follows it
_CHUNK = re.compile(r" *[^ \n]+|\n| +")
_SPACE = "▁"

_HASH_BASE = 0x9E3779B97F4A7C15
_SPREAD = 0xBF58476D1CE4E5B9
_SLOT_BITS = 18

_models: dict = {}


def _doubled(old: np.ndarray) -> np.ndarray:
    """Twice the room; what is not used takes no memory yet."""
    new = np.zeros(2 * len(old), old.dtype)
    new[:len(old)] = old
    return new


class Lattices:
    """Lattices of chunks over one vocabulary. Node numbers are global (a chunk
    of n characters has n + 1 nodes); the edges of a node are consecutive, with
    cumulative probabilities that end at 1."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        self.bytes = [0] * 256
        self.pieces: dict[str, tuple[int, float]] = {}
        self.text: list[bytes] = [b""] * self.size
        for i in range(self.size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.text[i] = bytes([int(piece[1:-1], 16)])
            elif not sp.is_control(i) and not sp.is_unknown(i) and not sp.is_unused(i):
                self.pieces[piece] = (i, -math.log(-sp.get_score(i) + RANK_SHIFT))
                self.text[i] = piece.replace(_SPACE, " ").encode()
        self.byte_weight = -math.log(len(self.pieces) + RANK_SHIFT)
        # hashes of all prefixes of pieces, with the piece that each one is, if any
        prefixes = {p[:j] for p in self.pieces for j in range(1, len(p) + 1)}
        known = {self._hash(p) * _SPREAD & (2**64 - 1): self.pieces.get(p, (-1, 0.0)) for p in prefixes}
        known.setdefault(2**64 - 1, (-1, 0.0))        # a search ends there at the latest
        self.prefix = np.array(sorted(known), np.uint64)
        self.prefix_piece = np.array([known[h][0] for h in self.prefix.tolist()], np.int32)
        self.prefix_weight = np.array([known[h][1] for h in self.prefix.tolist()])
        # the first hash of each slot of the highest bits
        slots = np.arange(1 << _SLOT_BITS, dtype=np.uint64) << np.uint64(64 - _SLOT_BITS)
        self.slot = np.searchsorted(self.prefix, slots)
        self.longest = max(map(len, self.pieces))
        self.first = np.zeros(1 << 16, np.int64)      # of each node, its first edge
        self.cumulative = np.zeros(1 << 17, np.float32)
        self.log_q = np.zeros(1 << 17)
        self.piece = np.zeros(1 << 17, np.int32)
        self.length = np.zeros(1 << 17, np.int8)      # in characters; negative: the chunk ends there
        self.clear()

    @staticmethod
    def _hash(s: str) -> int:
        h = 0
        for c in s:
            h = (h * _HASH_BASE + ord(c) + 1) & (2**64 - 1)
        return h

    def clear(self) -> None:
        self.root: dict[str, int] = {}
        self.spelled: dict[int, tuple] = {}           # pieces from self.size on: characters as byte pieces
        self.spelling: dict[int, int] = {}
        self.used_nodes = self.used_edges = 0         # the arrays keep their room

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The place of each hash among the prefixes, or of the next larger one."""
        at = self.slot[(h >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)]
        later = np.flatnonzero(self.prefix[at] < h)
        while len(later):
            at[later] += 1
            later = later[self.prefix[at[later]] < h[later]]
        return at

    def _spell(self, point: int) -> int:
        """The piece that stands for a character outside the vocabulary."""
        if point not in self.spelling:
            code = chr(point).encode()
            if len(code) == 1:
                self.spelling[point] = self.bytes[code[0]]
            else:
                self.spelling[point] = self.size + len(self.spelled)
                self.spelled[self.spelling[point]] = tuple(self.bytes[c] for c in code)
        return self.spelling[point]

    def add(self, chunks: list[str]) -> None:
        """Build the lattices of new chunks, all at once."""
        lengths = np.array([len(c) for c in chunks], np.int64)
        points = np.frombuffer("".join(chunks).replace(" ", _SPACE).encode("utf-32-le"), np.uint32)
        ends = np.cumsum(lengths)
        chunk = np.repeat(np.arange(len(chunks)), lengths)
        left = ends[chunk] - np.arange(len(points))            # characters to the chunk's end
        h = np.zeros(len(points), np.uint64)
        live = np.arange(len(points))
        single = np.zeros(len(points), bool)
        start, length, piece, weight = [], [], [], []
        for n in range(1, self.longest + 1):
            live = live[left[live] >= n]
            if not len(live):
                break
            h[live] = h[live] * np.uint64(_HASH_BASE) + points[live + n - 1].astype(np.uint64) + np.uint64(1)
            spread = h[live] * np.uint64(_SPREAD)
            at = self._find(spread)
            known = self.prefix[at] == spread
            live, at = live[known], at[known]
            is_piece = self.prefix_piece[at] >= 0
            start.append(live[is_piece])
            length.append(np.full(len(start[-1]), n, np.int64))
            piece.append(self.prefix_piece[at[is_piece]])
            weight.append(self.prefix_weight[at[is_piece]])
            if n == 1:
                single[start[-1]] = True
        odd = np.flatnonzero(~single)
        start.append(odd)
        length.append(np.ones(len(odd), np.int64))
        piece.append(np.array([self._spell(int(c)) for c in points[odd]], np.int32))
        size = np.where(points[odd] < 0x80, 1, np.where(points[odd] < 0x800, 2, np.where(points[odd] < 0x10000, 3, 4)))
        weight.append(size * self.byte_weight)
        start, length, piece, weight = (np.concatenate(x) for x in (start, length, piece, weight))
        # edges by node, then length
        order = np.argsort(start, kind="stable")
        start, length, piece, weight = start[order], length[order], piece[order], weight[order]
        node, to = start + chunk[start], start + length + chunk[start]
        counts = np.bincount(start, minlength=len(points))       # every character has an edge
        heads = np.cumsum(counts) - counts
        # backward sums, by distance from the chunk's end
        most = int(lengths.max(initial=0))
        by_left = np.argsort(left.astype(np.uint16) if most < 1 << 16 else left, kind="stable")
        counts_by, node_by = counts[by_left], by_left + chunk[by_left]
        begin = np.concatenate([[0], np.cumsum(counts_by)])
        order = np.repeat(heads[by_left] - begin[:-1], counts_by) + np.arange(len(start))
        steps = np.searchsorted(left[by_left], np.arange(1, most + 2))
        beta = np.zeros(len(points) + len(chunks))
        for i, j in zip(steps[:-1].tolist(), steps[1:].tolist()):
            these = order[begin[i]:begin[j]]
            terms = weight[these] + beta[to[these]]
            own = begin[i:j] - begin[i]
            top = np.maximum.reduceat(terms, own)
            beta[node_by[i:j]] = top + np.log(np.add.reduceat(np.exp(terms - np.repeat(top, counts_by[i:j])), own))
        log_q = np.minimum(weight + beta[to] - beta[node], 0.0)
        tails = heads + counts - 1
        log_q[heads[heads == tails]] = 0.0
        total = np.cumsum(np.exp(log_q))
        within = total - np.repeat(np.concatenate([[0.0], total[tails[:-1]]]), counts)
        within = np.minimum(within, 1.0)
        within[tails] = 1.0
        a, b = self.used_nodes, self.used_edges
        nodes = len(points) + len(chunks)
        while a + nodes > len(self.first):
            self.first = _doubled(self.first)
        while b + len(start) > len(self.piece):
            for name in ("cumulative", "log_q", "piece", "length"):
                setattr(self, name, _doubled(getattr(self, name)))
        # a chunk's last node has no edges: it shares the next one's first
        edges = np.bincount(node, minlength=nodes)
        self.first[a:a + nodes] = b + np.cumsum(edges) - edges
        e = b + len(start)
        self.cumulative[b:e], self.log_q[b:e], self.piece[b:e] = within, log_q, piece
        self.length[b:e] = np.where(length == left[start], -length, length)
        self.used_nodes, self.used_edges = a + nodes, e
        self.root.update(zip(chunks, (a + ends - lengths + np.arange(len(chunks))).tolist()))

    def roots(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Root nodes of all chunks of the texts, and each text's first chunk."""
        if self.used_nodes > CACHE_NODES:
            self.clear()
        split = [_CHUNK.findall(" " + t) if t else [] for t in texts]
        flat = list(chain.from_iterable(split))
        some, size = [], 0
        for chunk in set(flat).difference(self.root):
            if some and size + len(chunk) > ADD_CHARS:
                self.add(some)
                some, size = [], 0
            some.append(chunk)
            size += len(chunk)
        if some:
            self.add(some)
        first = np.concatenate([[0], np.cumsum([len(c) for c in split])]).astype(np.int64)
        return np.fromiter(map(self.root.__getitem__, flat), np.int64, len(flat)), first

    def draw(self, node: np.ndarray, seed: np.ndarray) -> np.ndarray:
        """One edge from each node, by probability."""
        u = (words.mix(seed) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
        edge = self.first[node]
        later = np.flatnonzero(self.cumulative[edge] <= u)
        while len(later):
            edge[later] += 1
            later = later[self.cumulative[edge[later]] <= u[later]]
        return edge

    def paths(self, root: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A drawn path (edges) through each chunk, and each chunk's first step."""
        steps, node, who = [], root, np.arange(len(root), dtype=np.int32)
        count = np.zeros(len(root), np.int64)
        while len(who):
            edge = self.draw(node, seed[who] + np.uint64(len(steps)))
            steps.append((who, edge))
            by = self.length[edge]
            go = by > 0
            count[who[~go]] = len(steps)
            node, who = node[go] + by[go], who[go]
        first = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(first[-1], np.int64)
        for n, (w, e) in enumerate(steps):
            out[first[w] + n] = e
        return out, first

    def node_of(self, edge: int) -> int:
        """The node that an edge leaves."""
        return int(np.searchsorted(self.first[:self.used_nodes], edge, side="right")) - 1

    def leaving(self, node: int) -> range:
        """The edges of a node."""
        return range(int(self.first[node]), int(self.first[node + 1]) if node + 1 < self.used_nodes else self.used_edges)

    def ids(self, edges: np.ndarray) -> np.ndarray:
        """The piece ids of a path."""
        out = self.piece[edges]
        if self.spelled and (out >= self.size).any():
            out = np.array([x for p in out.tolist() for x in self.spelled.get(p, (p,))], np.int32)
        return out.astype(np.uint16)

    def decode(self, ids) -> str:
        """The text of ids (without the space before the first word)."""
        data = b"".join(map(self.text.__getitem__, ids)).decode("utf-8", "replace")
        return data[1:] if data.startswith(" ") else data


def lattices(path: str) -> Lattices:
    if path not in _models:
        _models[path] = Lattices(path)
    return _models[path]


def _uniform(seed: int, n: int) -> float:
    """Draw n of a seed, inside (0, 1)."""
    x = (seed + 0x9E3779B97F4A7C15 * (n + 1)) & (2**64 - 1)
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & (2**64 - 1)
    return ((x ^ x >> 31) >> 11) * 2.0 ** -53 + 2.0 ** -54


def _log1mexp(x: float) -> float:
    """log(1 - exp(x)) for x <= 0."""
    if x >= 0:
        return -math.inf
    return math.log(-math.expm1(x)) if x > -0.693 else math.log1p(-math.exp(x))


def truncated_gumbel(at: float, below: float, u: float) -> float:
    """A Gumbel at location ``at`` given that it is at most ``below``."""
    free = at - math.log(-math.log(u))
    a, b = -below, -free
    top = max(a, b)
    return -(top + math.log(math.exp(a - top) + math.exp(b - top)))


def search(lat: Lattices, root: np.ndarray, drawn: list, k: int, seed: int):
    """The top k samples of one text.

    ``drawn[r]`` is (edges, first step of each chunk) of continuation r, one
    for each sample. Gives [(edges, log p, key)] and the key after them."""
    if not len(root):
        return [(np.zeros(0, np.int64), 0.0, -math.log(-math.log(_uniform(seed, 0))))], -math.inf
    draws = iter(range(1, 1 << 62))
    steps, chunk_of = drawn[0]
    score = np.concatenate([[0.0], np.cumsum(lat.log_q[steps])])
    key = -math.log(-math.log(_uniform(seed, 0)))
    done = [(steps, float(score[-1]), key)]
    paths = [(steps, score, chunk_of)]
    queue: list = []

    def push(path, a, b, without, parent):
        score = paths[path][1]
        if without is None:
            mass = score[a] + _log1mexp(float(score[b] - score[a])) if b > a else -math.inf
        else:
            rest = 1.0 - sum(math.exp(lat.log_q[x]) for x in without)
            n = lat.leaving(lat.node_of(without[0]))
            mass = score[a] + math.log(rest) if len(n) > len(without) and rest > 1e-12 else -math.inf
        if mass > -math.inf:
            g = truncated_gumbel(float(mass), parent, _uniform(seed, next(draws)))
            heapq.heappush(queue, (-g, len(paths), next(draws), path, a, b, without))
    push(0, 0, len(steps), None, key)
    while queue and len(done) < k:
        g, _, _, path, a, b, without = heapq.heappop(queue)
        key = -g
        steps, score, chunk_of = paths[path]
        if without is None:
            u = _uniform(seed, next(draws))
            line = score[a] + math.log1p(-u * -math.expm1(float(score[b] - score[a])))
            t = int(np.searchsorted(-score[a + 1:b + 1], -line, side="left")) + a
            t = min(t, b - 1)
            while t > a and lat.log_q[steps[t]] == 0.0:       # a certain step is never left
                t -= 1
            taken = (int(steps[t]),)
        else:
            t, taken = a, without
        node = lat.node_of(taken[0])
        choices = [e for e in lat.leaving(node) if e not in taken]
        weights = [math.exp(lat.log_q[e]) for e in choices]
        pick, u = choices[-1], _uniform(seed, next(draws)) * sum(weights)
        for e, w in zip(choices, weights):
            u -= w
            if u < 0:
                pick = e
                break
        # the rest of the chunk, then the continuation of this sample
        inner = [pick]
        while lat.length[inner[-1]] > 0:
            node += int(lat.length[inner[-1]])
            inner.append(int(lat.draw(np.array([node]), np.array([(seed ^ 0x5EED) + next(draws) & (2**64 - 1)], np.uint64))[0]))
        c = int(np.searchsorted(chunk_of, t, side="right")) - 1
        more, starts = drawn[len(done)]
        new = np.concatenate([steps[:t], inner, more[starts[c + 1]:]]).astype(np.int64)
        new_score = np.concatenate([score[:t + 1], score[t] + np.cumsum(lat.log_q[new[t:]])])
        new_chunks = np.concatenate([chunk_of[:c + 1], t + len(inner) + starts[c + 1:] - starts[c + 1]])
        done.append((new, float(new_score[-1]), key))
        paths.append((new, new_score, new_chunks))
        if without is None:
            push(path, a, t, None, key)
            push(path, t + 1, b, None, key)
        push(path, t, t + 1, (*taken, pick), key)
        push(len(paths) - 1, t + 1, len(new), None, key)
    return done, -queue[0][0] if queue else -math.inf


def inclusion(log_p: float, kappa: float) -> float:
    """log(1 - exp(-exp(log_p - kappa)))."""
    if kappa == -math.inf:
        return 0.0
    x = log_p - kappa
    if x < -30:
        return x
    return math.log(-math.expm1(-math.exp(min(x, 700.0))))


def segment(lat: Lattices, texts: list[str], keys: list, k: int = K):
    """For each text: its samples [(ids, log p, key, inclusion)]."""
    root, first = lat.roots(texts)
    seeds = words.mix(np.array([0 if i is None else i & (2**64 - 1) for i in keys], np.uint64) + np.uint64(0xA57A))
    n = np.diff(first)
    place = np.arange(len(root)) - np.repeat(first[:-1], n)
    per_chunk = np.repeat(seeds, n) + words.mix(place.astype(np.uint64))
    drawn = [lat.paths(root, words.mix(per_chunk + np.uint64(r + 1))) for r in range(k)]
    out = []
    for t in range(len(texts)):
        a, b = first[t], first[t + 1]
        own = [(e[f[a]:f[b]], f[a:b + 1] - f[a]) for e, f in drawn]
        done, kappa = search(lat, root[a:b], own, k, int(seeds[t]))
        out.append([(lat.ids(e), p, g, inclusion(p, kappa)) for e, p, g in done])
    return out


def _sampled(model: str, k: int):
    @words.tidy
    def run(batches):
        lat = lattices(model)
        for batch in batches:
            texts = words.text_array(batch.column("text"))
            _, offsets = words.raw(texts)
            for i, j in words.blocks(offsets, 1 << 20):
                keys, these = batch.column("doc_id").slice(i, j - i).to_pylist(), texts.slice(i, j - i).to_pylist()
                rows = []
                for key, text, samples in zip(keys, these, segment(lat, these, keys, k)):
                    rows += [(key, r, len(ids), p, g, inc, ids.astype("<u2").tobytes(), lat.decode(ids.tolist()) == text)
                             for r, (ids, p, g, inc) in enumerate(samples)]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.binary(), pa.bool_()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                      ["doc_id", "sample", "n_pieces", "log_prob", "perturbed", "log_inclusion", "ids", "round_trip"])
    return run


def sampled(docs: DataFrame, model: str | None = None, k: int = K) -> DataFrame:
    """Up to k rows for each row of (doc_id, text): the sample's number from 0,
    pieces, log probability, perturbed log probability, log inclusion score,
    ids (unsigned 16-bit little endian) and whether they decode to the text."""
    spark = docs.sparkSession
    words.small_batches(spark)
    if model is None:
        import public_tokenizers
        model = public_tokenizers.path("piece_bpe_32k.model")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_sampled(model, k), "doc_id long, sample int, n_pieces long, log_prob double, perturbed double, "
                           "log_inclusion double, ids binary, round_trip boolean")
