"""Near-duplicate vectors by navigable small-world graphs per shard.

Exact copies become one row with a weight. Each class (equal label, equal vector length) is
dealt by hash to shards of bounded size, and a task builds a hierarchical navigable
small-world graph over each shard. Every vector of the class then queries every shard
of its class; the links that are found are verified by cosine in double precision and
the components of all links are the near-duplicate groups.

What a node is: a vector within RADIUS (half the link angle) of a node that its
insertion search meets becomes a member of that node, with its angle; all others
become nodes. So a thousand near copies are a few nodes, and the members of one node
are all linked with each other (their angles add up to less than the link angle). A
query looks for the nodes that may have a linked member. Of a node's members, sorted by angle,
the triangle inequality settles most without a look: those with angle <= link angle -
query angle are linked, those with angle < query angle - link angle are not, and only
the rest are compared one by one. Links are counted, not listed; from a node's members one
edge between nodes leaves the task.

Beams: a query descends the layers, walks the lowest one with a beam, and expands every
node in reach until no neighbour is in reach. In each block of queries an audit sample is compared with
all nodes of the shard; while fewer than RECALL of the nodes in reach are found, the
beam doubles and the block is searched again (a beam as wide as the graph is a plain
comparison with all nodes). Only audited recall bounds what may be lost: a node out of a query's sight.

Vectorised over a block's queries with NumPy. Moved: each vector to its shard once, then each
block of vectors to each shard of its class ("every shard": the square of a class, by the
shard size, which grows with the class up to MOST_ROWS).

Defined cases: null labels, null, empty and zero vectors and vectors with null or
non-finite components link with nothing and are their own component; rows that repeat an id or
a vector are vectors of their own; a null id counts as a vector and names no component;
an empty table gives an empty result; other columns are not read, whatever their names."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, StructType

from tessera.llm.common import components, written
from tessera.llm.words import mix

COSINE = 0.93               # of a link
LEAST_ROWS, MOST_ROWS = 4096, 65536     # of a shard
SHARDS = 64                 # wanted per class, between those sizes
WIDTH = 16                  # neighbours chosen for a node a layer; lists hold up to 4 times as many
BEAM, BUILD_BEAM = 32, 48
BATCH = 256                 # vectors inserted together
BLOCK = 1024                # queries searched together
AUDIT = 32                  # of them compared with all nodes
RECALL = 0.99
MARGIN = 1e-7               # of angles, above their rounding
BITS = 1 << 25              # of a search's marks


def unit(raw: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; no component is too large for it."""
    x = raw.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def packed(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpacked(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob), allow_pickle=False) as x:
        return {k: x[k] for k in x.files}


class Graph:
    """Nodes 0..count - 1 with a vector each, and neighbour lists a layer."""

    def __init__(self, capacity: int, d: int):
        self.v = np.zeros((capacity, d), np.float32)
        self.layers: list[np.ndarray] = []
        self.count, self.entry = 0, -1

    def beam(self, layer: int, q: np.ndarray, start: np.ndarray, width: int, reach: np.ndarray | None = None):
        """The ``width`` nearest nodes that a beam from ``start`` meets: (ids, cosines), best
        first, -1 where there are fewer. With ``reach``, instead all pairs
        (query, node) that it meets with a cosine of at least reach[node]."""
        b, lists = len(q), self.layers[layer]
        seen = np.zeros((b, self.count), bool)
        opened = np.zeros((b, self.count), bool) if reach is not None else None
        ids = np.full((b, width), -1, np.int32)
        near = np.full((b, width), -2, np.float32)
        done = np.ones((b, width), bool)
        every = np.arange(b)
        ids[:, 0], near[:, 0], done[:, 0] = start, np.einsum("ij,ij->i", self.v[start], q), False
        seen[every, start] = True
        met = []

        def meet(rows, nodes, cosines):
            if reach is not None:
                hit = cosines >= reach[nodes]
                met.append((rows[hit], nodes[hit]))

        meet(every, ids[:, 0], near[:, 0])
        while True:
            rows = np.flatnonzero(~done.all(axis=1))
            if not len(rows):
                break
            k = (~done[rows]).argmax(axis=1)            # the best one that is not expanded
            node = ids[rows, k]
            done[rows, k] = True
            if opened is not None:
                opened[rows, node] = True
            following = lists[node]
            fresh = (following >= 0) & ~seen[rows[:, None], np.maximum(following, 0)]
            r, w = np.nonzero(fresh)
            nodes = following[r, w]
            seen[rows[r], nodes] = True
            cosines = np.einsum("ij,ij->i", self.v[nodes], q[rows[r]])
            meet(rows[r], nodes, cosines)
            added = np.full(following.shape, -2, np.float32)
            added[r, w] = cosines
            all_near = np.concatenate([near[rows], added], axis=1)
            best = np.argsort(-all_near, axis=1, kind="stable")[:, :width]
            take = lambda x: np.take_along_axis(x, best, axis=1)
            near[rows] = take(all_near)
            ids[rows] = take(np.concatenate([ids[rows], np.where(fresh, following, -1)], axis=1))
            done[rows] = take(np.concatenate([done[rows], ~fresh], axis=1))
        if reach is None:
            return ids, near
        # from every node in reach on, whether or not the beam had room for it
        edge = tuple(np.concatenate(x) for x in zip(*met))
        while len(edge[0]):
            shut = ~opened[edge]
            edge = edge[0][shut], edge[1][shut]
            opened[edge] = True
            begin, ahead = len(met), 4096
            for k in range(0, len(edge[0]), ahead):
                rows, following = edge[0][k:k + ahead], lists[edge[1][k:k + ahead]]
                r, w = np.nonzero((following >= 0) & ~seen[rows[:, None], np.maximum(following, 0)])
                pairs = np.unique(rows[r].astype(np.int64) * self.count + following[r, w])
                r, nodes = pairs // self.count, pairs % self.count
                seen[r, nodes] = True
                meet(r, nodes, np.einsum("ij,ij->i", self.v[nodes], q[r]))
            edge = tuple(np.concatenate(x) for x in zip(*met[begin:])) if len(met) > begin else (every[:0], every[:0])
        return tuple(np.concatenate(x) for x in zip(*met))

    def descend(self, q: np.ndarray, to: int) -> np.ndarray:
        """A start for each query in layer ``to``."""
        start = np.full(len(q), self.entry, np.int64)
        for layer in range(len(self.layers) - 1, to, -1):
            start = self.beam(layer, q, start, 1)[0][:, 0]
        return start

    def spread(self, near: np.ndarray, nodes: np.ndarray, most: int) -> np.ndarray:
        """Neighbours of a node among candidates, best first: those nearer to it than to any chosen one;
        then, where room is left, the nearest others."""
        among = self.v[nodes] @ self.v[nodes].T
        chosen, other, blocked = [], [], np.full(len(nodes), -2, np.float32)
        for k in range(len(nodes)):
            if len(chosen) == most:
                break
            if near[k] > blocked[k]:
                chosen.append(k)
                np.maximum(blocked, among[k], out=blocked)
            else:
                other.append(k)
        return nodes[np.array((chosen + other)[:most], np.int64)]

    def connect(self, layer: int, node: int, near: np.ndarray, nodes: np.ndarray) -> None:
        lists, size = self.layers[layer], WIDTH * (2 if layer == 0 else 1)
        order = np.argsort(-near, kind="stable")
        chosen = self.spread(near[order], nodes[order], WIDTH)
        lists[node, :len(chosen)] = chosen
        for other in chosen.tolist():
            row = lists[other]
            free = int(np.count_nonzero(row >= 0))
            if free < len(row):
                row[free] = node
                continue
            whole = np.append(row, node)
            cosines = self.v[whole] @ self.v[other]
            order = np.argsort(-cosines, kind="stable")
            row[:] = -1
            kept = self.spread(cosines[order], whole[order], size)
            row[:len(kept)] = kept

    def insert(self, vectors: np.ndarray, levels: np.ndarray, candidates: list) -> None:
        """Add nodes; ``candidates`` has, a layer, what the search for them met: (ids, cosines)."""
        first, n = self.count, len(vectors)
        self.v[first:first + n] = vectors
        self.count += n
        own = vectors @ vectors.T
        top = len(self.layers) - 1
        while len(self.layers) <= levels.max():
            self.layers.append(np.full((len(self.v), 2 * WIDTH * (1 if self.layers else 2)), -1, np.int32))
        for layer in range(len(self.layers)):
            members = np.flatnonzero(levels >= layer)
            for j, k in enumerate(members.tolist()):
                before = members[:j]
                near, nodes = own[k, before], first + before
                if layer <= top:
                    ids, cosines = candidates[layer][0][k], candidates[layer][1][k]
                    near, nodes = np.concatenate([near, cosines[ids >= 0]]), np.concatenate([nodes, ids[ids >= 0]])
                if len(nodes) > BUILD_BEAM:
                    best = np.argpartition(-near, BUILD_BEAM)[:BUILD_BEAM]
                    near, nodes = near[best], nodes[best]
                if len(nodes):
                    self.connect(layer, first + k, near, nodes)
        if levels.max() > top:
            self.entry = first + int(levels.argmax())


def build(rid: np.ndarray, x: np.ndarray, radius: float) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    """A graph over unit vectors: (graph, row of each node, node of each row, angle of each row to it)."""
    n = len(x)
    graph, small = Graph(n, x.shape[1]), x.astype(np.float32)
    node_row, node, angle = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.zeros(n)
    hashed = mix(rid.astype(np.uint64) + np.uint64(1))
    level = np.floor(-np.log((hashed >> np.uint64(11)).astype(np.float64) / 2.0 ** 53 + 2.0 ** -54) / np.log(WIDTH)).astype(np.int64)
    order = np.argsort(hashed, kind="stable")
    for b in range(0, n, BATCH):
        rows = order[b:b + BATCH]
        q = small[rows]
        candidates = []
        if graph.count:
            at = np.full(len(q), graph.entry, np.int64)
            for layer in range(len(graph.layers) - 1, -1, -1):
                wide = layer == 0 or bool((level[rows] >= layer).any())
                ids, near = graph.beam(layer, q, at, BUILD_BEAM if wide else 1)
                candidates.insert(0, (ids, near))
                at = ids[:, 0].astype(np.int64)
            angle[rows] = _angle(x[rows], x[node_row[at]])
            node[rows] = np.where(angle[rows] <= radius, at, -1)
        # among themselves: a vector joins an earlier new node, or is one
        own = x[rows] @ x[rows].T
        fresh: list[int] = []
        for k in np.flatnonzero(node[rows] < 0).tolist():
            if fresh:
                j = int(own[k, fresh].argmax())
                a = float(_angle(x[rows[k]][None], x[rows[fresh[j]]][None])[0])
                if a <= radius:
                    node[rows[k]], angle[rows[k]] = graph.count + j, a
                    continue
            node[rows[k]], angle[rows[k]] = graph.count + len(fresh), 0.0
            fresh.append(k)
        if fresh:
            new = np.array(fresh)
            node_row[graph.count:graph.count + len(new)] = rows[new]
            graph.insert(q[new], level[rows[new]], [(i[new], s[new]) for i, s in candidates])
    return graph, node_row[:graph.count], node, angle


def _angle(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(np.einsum("ij,ij->i", a, b), -1, 1))


class Shard:
    """A shard's graph with the members of its nodes, ready for queries."""

    def __init__(self, blob: bytes, cosine: float):
        s = unpacked(blob)
        self.theta, self.cosine = float(np.arccos(cosine)), cosine
        self.x, self.weight, self.rid = unit(s["raw"]), s["weight"], s["rid"]
        self.node_row, node = s["node_row"], s["node"]
        order = np.lexsort((s["angle"], node))
        self.members, self.member_key = order, node[order] * 8.0 + s["angle"][order]
        self.begin = np.searchsorted(node[order], np.arange(len(self.node_row) + 1))
        self.total = np.concatenate([[0], np.cumsum(self.weight[order])])
        radius = np.zeros(len(self.node_row))
        np.maximum.at(radius, node, s["angle"])
        self.reach = (np.cos(np.minimum(self.theta + radius + MARGIN, np.pi)) - 2e-6).astype(np.float32)
        self.graph = Graph(0, self.x.shape[1])
        self.graph.v, self.graph.count, self.graph.entry = self.x[self.node_row].astype(np.float32), len(self.node_row), int(s["entry"])
        self.graph.layers = [s[f"layer{k}"] for k in range(int(s["layers"]))]
        self.width = BEAM

    def nodes_in_reach(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (query, node) whose node may have a linked member, as far as audits ask for."""
        audit = np.unique(np.linspace(0, len(q) - 1, min(AUDIT, len(q))).astype(np.int64))
        wanted = (q[audit] @ self.graph.v.T) >= self.reach
        while self.width < self.graph.count:
            found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            block = max(1, BITS // (2 * self.graph.count))
            for k in range(0, len(q), block):
                part = q[k:k + block]
                rows, nodes = self.graph.beam(0, part, self.graph.descend(part, 0), self.width, self.reach)
                found[0].append(rows + k), found[1].append(nodes)
            rows, nodes = (np.concatenate(x).astype(np.int64) for x in found)
            got = np.zeros((len(audit), self.graph.count), bool)
            place = np.searchsorted(audit, rows)
            hit = audit[np.minimum(place, len(audit) - 1)] == rows
            got[place[hit], nodes[hit]] = True
            if np.count_nonzero(got & wanted) >= RECALL * np.count_nonzero(wanted):
                return rows, nodes
            self.width *= 2
        step = max(1, (1 << 22) // self.graph.count)
        pairs = [np.nonzero(q[k:k + step] @ self.graph.v.T >= self.reach) for k in range(0, len(q), step)]
        return (np.concatenate([p[0] + k * step for k, p in enumerate(pairs)]), np.concatenate([p[1] for p in pairs]))

    def links(self, x: np.ndarray, own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Linked weight of each query (itself included, in its own shard), and the pairs (query, node) with a link.
        ``own``: the queries' nodes, where they are of this shard."""
        rows, nodes = self.nodes_in_reach(x.astype(np.float32))
        pairs = rows * self.graph.count + nodes
        if own is not None:     # whatever the search has met
            pairs = np.concatenate([pairs, np.arange(len(x)) * self.graph.count + own])
        pairs = np.unique(pairs)
        rows, nodes = pairs // self.graph.count, pairs % self.graph.count
        angle = np.concatenate([_angle(x[rows[k:k + 65536]], self.x[self.node_row[nodes[k:k + 65536]]]) for k in range(0, len(rows), 65536)] or [np.zeros(0)])
        begin, end = self.begin[nodes], self.begin[nodes + 1]
        sure = np.clip(np.searchsorted(self.member_key, nodes * 8.0 + (self.theta - angle - MARGIN), side="right"), begin, end)
        least = np.clip(np.searchsorted(self.member_key, nodes * 8.0 + np.maximum(angle - self.theta - MARGIN, 0)), begin, end)
        weight = self.total[sure] - self.total[begin]
        linked = sure > begin
        open_from = np.maximum(sure, least)
        size = end - open_from
        total = np.concatenate([[0], np.cumsum(size)])
        k = 0
        while k < len(size):    # members that angles don't settle, about 65,536 at a time
            j = max(k + 1, int(np.searchsorted(total, total[k] + 65536, side="right")) - 1)
            pair = np.repeat(np.arange(k, j), size[k:j])
            if len(pair):
                place = open_from[pair] + np.arange(len(pair)) - (total[pair] - total[k])
                at = self.members[place]
                hit = np.einsum("ij,ij->i", x[rows[pair]], self.x[at]) >= self.cosine
                np.add.at(weight, pair[hit], self.weight[at[hit]])
                linked[pair[hit]] = True
            k = j
        found = np.zeros(len(x), np.int64)
        np.add.at(found, rows, weight)
        return found, rows[linked], nodes[linked]


def _built(cosine: float, kinds: pa.Schema):
    radius = float(np.arccos(cosine)) / 2 - 10 * MARGIN

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        rid, weight = group["rid"].to_numpy(), group["weight"].to_numpy()
        d, n = group["d"][0].as_py(), group.num_rows
        raw = group["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, d)
        order = np.argsort(rid)         # the order in which rows arrive decides nothing
        rid, weight, raw = rid[order], weight[order], raw[order]
        graph, node_row, node, angle = build(rid, unit(raw), radius)
        layers = {f"layer{k}": x[:graph.count] for k, x in enumerate(graph.layers)}
        blobs = [(0, packed(raw=raw, weight=weight, rid=rid, node_row=node_row, node=node, angle=angle, entry=np.int64(graph.entry),
                            layers=np.int64(len(layers)), **layers))]
        for k in range(0, n, BLOCK):
            part = slice(k, k + BLOCK)
            blobs.append((1, packed(raw=raw[part], rid=rid[part], weight=weight[part], node=node[part], leader=rid[node_row[node[part]]])))
        same = {c: pa.array([group[c][0].as_py()] * len(blobs), kinds.field(c).type) for c in ("label", "d", "shard", "shards")}
        return pa.table({**same, "kind": pa.array([k for k, _ in blobs], pa.int32()),
                         "blob": pa.array([b for _, b in blobs], pa.binary())})

    return run


_FOUND = "rid long, links long, leader long, a long, b long"


def _searched(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, leaders = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                blob = batch.column("blob")[k].as_py()
                if batch.column("kind")[k].as_py() == 0:
                    shard = Shard(blob, cosine)
                    leaders = shard.rid[shard.node_row]
                    continue
                q = unpacked(blob)
                home = batch.column("home")[k].as_py()
                links, rows, nodes = shard.links(unit(q["raw"]), q["node"] if home else None)
                if home:
                    links = links - q["weight"]
                none = pa.nulls(len(links), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(q["rid"]), pa.array(links), pa.array(q["leader"]), none, none],
                                                 ["rid", "links", "leader", "a", "b"])
                edges = np.unique(np.stack([q["leader"][rows], leaders[nodes]], axis=1), axis=0)
                edges = edges[edges[:, 0] != edges[:, 1]]
                none = pa.nulls(len(edges), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, none, pa.array(edges[:, 0]), pa.array(edges[:, 1])],
                                                 ["rid", "links", "leader", "a", "b"])

    return run


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE,
                    least_rows: int = LEAST_ROWS, most_rows: int = MOST_ROWS) -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    rows = df.select(F.col(id_col).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    good = rows.filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda v: v != 0))
    # copies become one row; written before the row numbers are used
    copies = written(good.groupBy("label", "vector").agg(F.count("*").alias("weight"), F.min("id").alias("least"))
                     .select("*", F.size("vector").alias("d"), F.monotonically_increasing_id().alias("rid")), "copies")
    per_shard = F.least(F.lit(most_rows), F.greatest(F.lit(least_rows), F.ceil(F.col("n") / SHARDS)))
    classes = written(copies.groupBy("label", "d").agg(F.count("*").alias("n"))
                      .select("label", "d", F.ceil(F.col("n") / per_shard).cast("int").alias("shards")), "classes")
    total = int(classes.agg(F.sum("shards")).first()[0] or 0)
    tasks = max(1, min(4 * total, 20_000))
    dealt = copies.join(classes, ["label", "d"]).select(
        "label", "d", F.pmod(F.xxhash64("rid"), F.col("shards")).cast("int").alias("shard"), "shards", "rid", "weight", "vector")
    schema = dealt.select("label", "d", "shard", "shards").schema
    made = StructType(list(schema.fields)).add("kind", IntegerType()).add("blob", BinaryType())
    blobs = written(dealt.repartition(tasks, "label", "d", "shard").groupBy("label", "d", "shard")
                    .applyInArrow(_built(cosine, to_arrow_schema(schema)), made), "graphs")
    # every block of a class meets every shard of it, behind the shard's graph
    graphs = blobs.filter("kind = 0").select("label", "d", F.col("shard").alias("at"), "kind", F.lit(True).alias("home"), "blob")
    blocks = (blobs.filter("kind = 1").withColumn("at", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
              .select("label", "d", "at", "kind", (F.col("at") == F.col("shard")).alias("home"), "blob"))
    found = written(graphs.unionByName(blocks).repartition(tasks, "label", "d", "at").sortWithinPartitions("label", "d", "at", "kind")
                    .select("kind", "home", "blob").mapInArrow(_searched(cosine), _FOUND), "found")
    counted = found.filter("rid IS NOT NULL").groupBy("rid").agg(F.sum("links").alias("links"), F.max("leader").alias("leader"))
    roots = components(found.filter("a IS NOT NULL").select("a", "b"), "vector-components")
    placed = written(copies.select("rid", "label", "vector", "weight", "least").join(counted, "rid")
                     .join(roots, F.col("leader") == F.col("node"), "left")
                     .select("label", "vector", "weight", "least", "links", F.coalesce("component", "leader").alias("root")), "placed")
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = placed.join(least, "root").select(F.col("label").alias("__label"), F.col("vector").alias("__vector"),
                                               (F.col("links") + F.col("weight") - 1).alias("n_links"), "component_id")
    alone = F.col("__label").isNull()
    out = rows.join(groups, (F.col("label") == F.col("__label")) & (F.col("vector") == F.col("__vector")), "left")
    component = F.when(alone, F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.cast("long").alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
