"""Near duplicates of embeddings by navigable small-world graphs, one per shard.

Vectors of a label are dealt to shards of a bounded size. Each shard gets a hierarchical
graph: a vector's level is drawn from a hash of its id, links are chosen by the rule that a
neighbour must be closer to the vector than to any neighbour already chosen, and vectors are
put in by batches whose members also see each other. Every vector is then a query to every
shard of its label.

Each shard's graph is built once and stored as a row. An audit on building compares ``AUDITED`` of the shard's vectors
with the whole shard and asks for ``RECALL`` of their ``NEAREST`` nearest neighbours, which every vector has; it fixes
the first beam. Only where the widest beam fails is the shard scanned by its queries. A query's beam is
widened until its worst entry is below the threshold, so nothing above it is cut off; queries that
fill the widest beam are compared with the whole shard instead. All links are verified with the
cosine in double precision. Queries are streamed past a graph in blocks of ``BLOCK``, each with a copy of the stored
graph, so copies stay a fixed share of the queries' own rows.

Equal vectors are one node; its copies are counted, not paired. A task sends the number of
links of each query and a spanning forest of what it linked, at most one edge per vector, and
the components of these edges are the components of all links. A link counts for both its
ends, whichever of them found it: both look for it, each in the shard of the other.

Vectors that are null or zero, or hold null or non-finite numbers, and rows without a label
link with nothing. Rows without an id are left out of the smallest id unless all lack one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.scratch import materialize
from .common import small_batches
from .components import components

THRESHOLD = 0.93
#: Vectors of a shard, and queries that share a copy of its graph, at most about so many.
SHARD, BLOCK = 40_000, 400_000
#: Links of a vector on the ground level (half of it above), and the beam while building.
LINKS, BUILD_BEAM = 24, 48
#: Least and widest beam of a search, vectors that an audit compares with the shard, their nearest neighbours that
#: count, and the share of these that a beam has to find.
BEAM, WIDEST, AUDITED, NEAREST, RECALL = 32, 256, 128, 10, 0.9
#: Room for rounding between single and double precision.
SLACK = 1e-4
_BATCH = 256


def _top(sims: np.ndarray, ids: np.ndarray, done: np.ndarray, width: int) -> tuple:
    order = np.argsort(-sims, axis=1, kind="stable")[:, :width]
    return tuple(np.take_along_axis(a, order, 1) for a in (sims, ids, done))


class Graph:
    """A hierarchical navigable small-world graph over unit vectors."""

    def __init__(self, vectors: np.ndarray, levels: np.ndarray):
        self.vectors = vectors
        order = np.argsort(-levels, kind="stable")
        self.order, self.levels = order, levels
        self.layers: list[np.ndarray] = []
        top = int(levels.max(initial=0))
        for level in range(top, -1, -1):
            width = LINKS if level == 0 else LINKS // 2
            self.layers.insert(0, np.full((len(vectors), width), -1, np.int32))
            self._fill(level, order[levels[order] >= level])

    @classmethod
    def stored(cls, vectors: np.ndarray, layers: list[np.ndarray], entry: int) -> Graph:
        """A graph that was built before; it can be searched."""
        graph = cls.__new__(cls)
        graph.vectors, graph.layers, graph.order = vectors, layers, np.array([entry])
        return graph

    def _fill(self, level: int, members: np.ndarray) -> None:
        """Link the members of one level by batches; upper levels lead to the entry."""
        links = self.layers[0]
        above = self.layers[1:]
        for begin in range(0, len(members), _BATCH):
            batch = members[begin : begin + _BATCH]
            q = self.vectors[batch]
            same = q @ q.T
            np.fill_diagonal(same, -2)
            keep = min(BUILD_BEAM, len(batch))
            near = np.argsort(-same, axis=1)[:, :keep]
            sims, ids = np.take_along_axis(same, near, 1), batch[near]
            if begin:
                entry = self._descend(q, above, members[0])
                found, found_ids = self._search(links, q, entry, BUILD_BEAM)
                sims, ids = np.hstack([found, sims]), np.hstack([found_ids, ids])
            order = np.argsort(-sims, axis=1, kind="stable")[:, :BUILD_BEAM]
            sims, ids = np.take_along_axis(sims, order, 1), np.take_along_axis(ids, order, 1)
            links[batch] = self._chosen(sims, ids, links.shape[1])
            self._link_back(links, batch)

    def _chosen(self, sims: np.ndarray, ids: np.ndarray, width: int) -> np.ndarray:
        """Of candidates by falling similarity, those nearer to the vector than to one chosen
        before; free places go to the nearest of the others."""
        n, k = ids.shape
        vectors = self.vectors[np.maximum(ids, 0)]
        between = np.einsum("nid,njd->nij", vectors, vectors)
        taken = np.zeros((n, k), bool)
        valid = (ids >= 0) & (sims > -1.5)
        for i in range(k):
            closest = np.where(taken, between[:, i, :], -2).max(axis=1)
            taken[:, i] = valid[:, i] & (closest < sims[:, i]) & (taken.sum(axis=1) < width)
        rank = np.where(taken, 0, np.where(valid, 1, 2)) * k + np.arange(k)
        order = np.argsort(rank, axis=1)[:, :width]
        out = np.full((n, width), -1, np.int32)
        picked = np.where(np.take_along_axis(valid, order, 1), np.take_along_axis(ids, order, 1), -1)
        out[:, : picked.shape[1]] = picked
        return out

    def _link_back(self, links: np.ndarray, batch: np.ndarray) -> None:
        width = links.shape[1]
        to = links[batch].ravel()
        origin = np.repeat(batch, width)[to >= 0]
        to = to[to >= 0]
        order = np.argsort(to, kind="stable")
        to, origin = to[order], origin[order]
        nodes, starts = np.unique(to, return_index=True)
        counts = np.diff(np.append(starts, len(to)))
        most = int(counts.max(initial=0))
        for begin in range(0, len(nodes), _BATCH):
            part = slice(begin, begin + _BATCH)
            own, size = nodes[part], counts[part]
            offered = np.full((len(own), most), -1, np.int64)
            spread = np.arange(most)[None, :] < size[:, None]
            offered[spread] = origin[(starts[part][:, None] + np.arange(most))[spread]]
            ids = np.hstack([links[own], offered])
            ids = self._unique(ids)
            sims = np.einsum("nkd,nd->nk", self.vectors[np.maximum(ids, 0)], self.vectors[own])
            sims[ids < 0] = -2
            order = np.argsort(-sims, axis=1, kind="stable")[:, :BUILD_BEAM]
            sims, ids = np.take_along_axis(sims, order, 1), np.take_along_axis(ids, order, 1)
            links[own] = self._chosen(sims, ids, width)

    @staticmethod
    def _unique(ids: np.ndarray) -> np.ndarray:
        """Repeated ids of a row become -1."""
        order = np.argsort(ids, axis=1, kind="stable")
        ranked = np.take_along_axis(ids, order, 1)
        again = np.zeros(ids.shape, bool)
        again[:, 1:] = ranked[:, 1:] == ranked[:, :-1]
        back = np.zeros(ids.shape, bool)
        np.put_along_axis(back, order, again, 1)
        return np.where(back, -1, ids)

    def _descend(self, q: np.ndarray, layers: list[np.ndarray], entry: int) -> np.ndarray:
        """Walk down the upper layers to the nearest vector of each."""
        at = np.full(len(q), self.order[0] if layers else entry)
        for layer in reversed(layers):
            best = np.einsum("nd,nd->n", q, self.vectors[at])
            moving = np.arange(len(q))
            while len(moving):
                ids = layer[at[moving]]
                sims = np.einsum("nkd,nd->nk", self.vectors[np.maximum(ids, 0)], q[moving])
                sims[ids < 0] = -2
                pick = sims.argmax(axis=1)
                value = sims[np.arange(len(moving)), pick]
                better = value > best[moving]
                moving, ids, pick, value = moving[better], ids[better], pick[better], value[better]
                at[moving], best[moving] = ids[np.arange(len(moving)), pick], value
        return at

    def _search(self, links: np.ndarray, q: np.ndarray, entry: np.ndarray, beam: int) -> tuple:
        """The beam of every query on one layer: similarities and ids, best first."""
        n = len(q)
        ids = np.full((n, beam), -1, np.int64)
        sims = np.full((n, beam), -2, np.float32)
        done = np.ones((n, beam), bool)
        ids[:, 0], done[:, 0] = entry, False
        sims[:, 0] = np.einsum("nd,nd->n", q, self.vectors[entry])
        seen = np.zeros((n, len(self.vectors)), bool)
        seen[np.arange(n), entry] = True
        active = np.arange(n)
        while len(active):
            open_ = ~done[active]
            some = open_.any(axis=1)
            active, open_ = active[some], open_[some]
            if not len(active):
                break
            # the two best that were not opened yet
            first = np.argsort(~open_, axis=1, kind="stable")[:, :2]
            usable = np.take_along_axis(open_, first, 1)
            done[active[:, None], first] |= usable
            opened = np.where(usable, ids[active[:, None], first], -1)
            new = np.where(opened[:, :, None] >= 0, links[np.maximum(opened, 0)], -1).reshape(len(active), -1)
            known = seen[active[:, None], np.maximum(new, 0)]
            new = self._unique(np.where(known, -1, new))
            fresh = new >= 0
            rows, columns = np.nonzero(fresh)
            seen[active[rows], new[rows, columns]] = True
            close = np.full(new.shape, -2, np.float32)
            close[rows, columns] = np.einsum("kd,kd->k", self.vectors[new[rows, columns]], q[active[rows]])
            merged = _top(
                np.hstack([sims[active], close]),
                np.hstack([ids[active], new]),
                np.hstack([done[active], ~fresh]),
                beam,
            )
            sims[active], ids[active], done[active] = merged
        return sims, ids

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        entry = self._descend(q, self.layers[1:], int(self.order[0]))
        return self._search(self.layers[0], q, entry, beam)


def levels_of(ids: np.ndarray) -> np.ndarray:
    """A level from a hash of each id: each level has about a sixteenth of the one below."""
    mixed = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    share = ((mixed >> np.uint64(11)).astype(np.float64) + 1) / 2**53
    return np.minimum(6, np.floor(-np.log(share) / np.log(16))).astype(np.int64)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings it near one: its squares are neither zero nor
    infinite then, and no bit is lost."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -exponent)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in single precision, for finding; links are verified in double."""
    vectors = scaled(vectors)
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def _verified(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Row by row whether the cosine in double precision reaches the threshold."""
    a, b = scaled(a), scaled(b)
    dots = np.einsum("nd,nd->n", a, b)
    return dots / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1)) >= threshold


def _scan(graph: Graph, q: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """As ``_pairs``, by comparison with the whole shard."""
    return np.nonzero(q @ graph.vectors.T >= least)


def _pairs(graph: Graph, q: np.ndarray, beam: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query rows and shard rows at or above ``least``, and which query rows were compared with
    the whole shard; the beam grows where it was too short."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    rows = np.arange(len(q))
    while len(rows) and beam <= WIDEST:
        sims, ids = graph.search(q[rows], beam)
        ended = (sims[:, -1] < least) | (beam >= len(graph.vectors))
        r, c = np.nonzero((sims >= least) & ended[:, None])
        found.append((rows[r], ids[r, c]))
        rows, beam = rows[~ended], beam * 4
    for begin in range(0, len(rows), _BATCH):
        part = rows[begin : begin + _BATCH]
        r, c = _scan(graph, q[part], least)
        found.append((part[r], c))
    r, c = (np.concatenate(x) for x in zip(*found)) if found else (rows, rows)
    return r, c, rows


def recall(graph: Graph, rows: np.ndarray, beam: int) -> float:
    """The mean share of their ``NEAREST`` nearest neighbours that vectors of the graph find by a beam."""
    shares = []
    wanted = min(NEAREST, len(graph.vectors) - 1)
    for begin in range(0, len(rows), _BATCH):
        part = rows[begin : begin + _BATCH]
        q, every = graph.vectors[part], np.arange(len(part))
        all_ = q @ graph.vectors.T
        all_[every, part] = -2
        least = np.partition(all_, -wanted, axis=1)[:, -wanted]
        sims, ids = graph.search(q, beam)
        near = (sims >= least[:, None] - 1e-6) & (ids >= 0) & (ids != part[:, None])
        shares.append(np.minimum(near.sum(axis=1), wanted) / wanted)
    return float(np.concatenate(shares).mean())


def chosen_beam(graph: Graph) -> int:
    """The least beam that passes the audit; 0 if none does and the shard has to be scanned."""
    n = len(graph.vectors)
    if n == 1:
        return BEAM
    rows = np.sort(np.random.default_rng(n).permutation(n)[:AUDITED])
    beam = BEAM
    while beam <= WIDEST:
        if recall(graph, rows, beam) >= RECALL:
            return beam
        beam *= 2
    return 0


def block_links(graph: Graph, raw: np.ndarray, queries: np.ndarray, threshold: float, beam: int) -> Iterator[tuple]:
    """Verified links by batches: query rows and shard rows, a query and itself among them; ``beam`` as
    the audit has chosen it."""
    q = unit(queries)
    least = threshold - SLACK
    for begin in range(0, len(q), _BATCH):
        part = q[begin : begin + _BATCH]
        r, c = _pairs(graph, part, beam, least)[:2] if beam else _scan(graph, part, least)
        sure = _verified(queries[begin + r], raw[c], threshold) if len(r) else np.zeros(0, bool)
        yield begin + r[sure], c[sure]


class Forest:
    """Union of numbered things as they appear."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, i: int) -> int:
        parent = self.parent
        parent.setdefault(i, i)
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart so far."""
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1)


_GRAPH = "nodes binary, copies binary, raw binary, layers array<binary>, entry long, beam long"


def _built(key: tuple, shard: pa.Table) -> pa.Table:
    """The graph of a shard as one row."""
    shard = shard.sort_by("node").combine_chunks()
    nodes = np.asarray(shard["node"])
    raw = _matrix(shard["vector"].chunk(0))
    graph = Graph(unit(raw), levels_of(nodes))
    return pa.table(
        {
            "field": pa.array([key[0].as_py()], pa.int64()),
            "shard": pa.array([key[1].as_py()], pa.int64()),
            "nodes": pa.array([nodes.tobytes()], pa.binary()),
            "copies": pa.array([np.asarray(shard["copies"]).tobytes()], pa.binary()),
            "raw": pa.array([raw.tobytes()], pa.binary()),
            "layers": pa.array([[layer.tobytes() for layer in graph.layers]], pa.list_(pa.binary())),
            "entry": pa.array([int(graph.order[0])], pa.int64()),
            "beam": pa.array([chosen_beam(graph)], pa.int64()),
        }
    )


class Shard:
    """A shard read back, and what its queries have linked so far."""

    def __init__(self, row: dict):
        self.nodes, self.copies = (np.frombuffer(row[c], np.int64) for c in ("nodes", "copies"))
        self.raw = np.frombuffer(row["raw"], np.float64).reshape(len(self.nodes), -1)
        layers = [
            np.frombuffer(layer, np.int32).reshape(len(self.nodes), -1) for layer in row["layers"]
        ]
        self.graph = Graph.stored(unit(self.raw), layers, row["entry"])
        self.beam, self.forest = row["beam"], Forest()

    def answer(self, own: np.ndarray, queries: np.ndarray, threshold: float) -> pa.RecordBatch:
        """Number of links of each query, and edges that join something new to this shard's forest."""
        counts, edges = np.zeros(len(own), np.int64), []
        for r, c in block_links(self.graph, self.raw, queries, threshold, self.beam):
            other = own[r] != self.nodes[c]
            r, c = r[other], c[other]
            counts += np.bincount(r, self.copies[c], minlength=len(own)).astype(np.int64)
            edges += [
                (a, b) for a, b in zip(own[r].tolist(), self.nodes[c].tolist()) if self.forest.join(a, b)
            ]
        linked = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([own[linked], np.array([a for a, _ in edges], np.int64)])),
                pa.array(np.concatenate([counts[linked], np.zeros(len(edges), np.int64)])),
                pa.array([*[None] * len(linked), *[b for _, b in edges]], pa.int64()),
            ],
            ["node", "links", "other"],
        )


def _answered(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard = None, None
        for batch in batches:
            places = list(zip(*(batch.column(c).to_pylist() for c in ("field", "shard", "block"))))
            is_graph = np.asarray(batch.column("beam").is_valid())
            begin = 0
            while begin < batch.num_rows:
                if is_graph[begin]:
                    at, shard = places[begin], Shard(batch.slice(begin, 1).to_pylist()[0])
                    begin += 1
                    continue
                end = begin
                while end < batch.num_rows and not is_graph[end] and places[end] == places[begin]:
                    end += 1
                if places[begin] == at:
                    part = batch.slice(begin, end - begin)
                    yield shard.answer(np.asarray(part.column("node")), _matrix(part.column("vector")), threshold)
                begin = end

    return run


def vector_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``embeddings``."""
    numbers = F.col("embedding").cast("array<double>")
    rows = materialize(
        embeddings.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("string").alias("label"),
            numbers.alias("vector"),
        ).select("*", F.xxhash64("vec_id", "label", "vector").alias("row_hash")),
        "vectors",
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    able = (
        F.col("label").isNotNull()
        & F.coalesce(finite, F.lit(False))
        & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False))
    )
    usable = rows.where(able)
    # a node is a text of numbers under a label and a dimension; its id is a hash of all that
    node = F.xxhash64("label", F.transform("vector", lambda x: x + F.lit(0.0)))
    classes = materialize(
        usable.groupBy(
            node.alias("node"), "label", F.size("vector").alias("size"), F.transform("vector", lambda x: x + F.lit(0.0)).alias("vector")
        ).agg(F.count("*").alias("copies"), F.min("vec_id").alias("least_id")),
        "vector_classes",
    )
    sizes = classes.groupBy("label", "size").agg(F.count("*").alias("n"))
    planned = sizes.select(
        F.col("label").alias("l"),
        F.col("size").alias("s"),
        F.ceil(F.col("n") / SHARD).alias("shards"),
        F.ceil(F.col("n") / BLOCK).alias("blocks"),
    )
    dealt = materialize(
        classes.join(planned, (F.col("label") == F.col("l")) & (F.col("size") == F.col("s"))).select(
            "node",
            "copies",
            "vector",
            F.xxhash64("label", "size").alias("field"),
            "shards",
            "blocks",
            F.pmod("node", F.col("shards")).alias("shard"),
            F.pmod(F.shiftrightunsigned("node", 20), F.col("blocks")).alias("block"),
        ),
        "vector_shards",
    )
    shards = dealt.select("field", "shard", "node", "copies", "vector").groupBy("field", "shard")
    graphs = materialize(shards.applyInArrow(_built, f"field long, shard long, {_GRAPH}"), "vector_graphs")
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    asked = dealt.select("field", F.explode(upto("shards")).alias("shard"), "block", "node", "vector")
    blocks = dealt.select("field", "shards", "blocks").distinct()
    blocks = blocks.select("field", "blocks", F.explode(upto("shards")).alias("shard"))
    blocks = blocks.select("field", "shard", F.explode(upto("blocks")).alias("block"))
    # a graph comes before the queries to it
    both = graphs.join(blocks, ["field", "shard"]).unionByName(asked, allowMissingColumns=True)
    n = max(1, int(embeddings.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    streamed = both.repartition(n, "field", "shard", "block").sortWithinPartitions(
        "field", "shard", "block", F.asc_nulls_last("beam")
    )
    found = materialize(
        small_batches(streamed).mapInArrow(_answered(threshold), "node long, links long, other long"), "vector_links"
    )
    linked = components(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    linked = materialize(linked, "vector_roots")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    placed = materialize(
        classes.select("node", "copies", "least_id")
        .join(links, "node", "left")
        .join(linked, "node", "left")
        .select(
            "node",
            "least_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "node").alias("root"),
        ),
        "vector_nodes",
    )
    least = materialize(placed.groupBy("root").agg(F.min("least_id").alias("component_id")), "vector_components")
    named = materialize(placed.join(least, "root").select("node", "n_links", "component_id"), "vector_named")
    answered = rows.select("vec_id", F.when(able, node).alias("own")).join(
        named, F.col("own") == F.col("node"), "left"
    )
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return answered.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
