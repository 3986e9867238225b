"""Centroid clustering of vectors (Lloyd's rounds) in whole numbers, with heaps of expiring bounds.

A vector's gap is the distance to its second nearest centroid less that to its own. While the
centroids have moved by less than the gap in all, the vector can't have changed its cluster. Every
block of vectors keeps a heap for each cluster, ordered by the gap plus the drift the cluster had
accumulated when the vector was put in. A round adds the moves to the drifts, pops what is
at or below its cluster's drift, rescans just those vectors exactly, and pushes them
again; a heap whose top holds is not even opened. Gaps are made smaller by more than rounding can
matter, so that results are those of a full scan.

Blocks with their heaps are rows of a stored table that each round reads and writes anew, without
a shuffle. A task sums the changes of its clusters; the driver gets clusters x components sums.

Vectors count that have ``size`` components, none null or not finite; each component x becomes
floor(256 x). Any other row has no result, nor has an empty table. Repeated rows and rows of one id
are vectors of their own; the first centroids of one hash are ordered by their components, and a null id is hashed
as the empty text. Of equally near centroids the smaller number counts. Distances and sums beyond 64 bits are null.
Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.scratch import hadoop_path, materialize, write_scratch

SIZE = 64
CLUSTERS = 40
ROUNDS = 5
SEED = "2"
SCALE = 256
#: Gaps are made smaller by this share of all that went into them.
MARGIN = 1e-9
#: Largest components for which squared distances are exact as doubles and as 64-bit integers.
EXACT_DOUBLE, EXACT_LONG = 1 << 22, 1 << 26

_BLOCK = (
    "ids array<long>, kind string, data binary, cluster binary, sizes binary, keys binary, rows binary,"
    " change array<struct<cluster: int, n: long, sums: array<string>>>"
)
_NAMES = ["ids", "kind", "data", "cluster", "sizes", "keys", "rows", "change"]
_CHANGE = pa.list_(
    pa.struct([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.string()))])
)
_TYPES = [pa.list_(pa.int64()), pa.string(), *[pa.binary()] * 5, _CHANGE]


def usable(vectors: DataFrame, size: int = SIZE) -> DataFrame:
    """``(vec_id, embedding)`` of the vectors that count, components as doubles."""
    whole = F.expr(
        "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
    )
    doubles = F.col("embedding").cast("array<double>").alias("embedding")
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), doubles)
        .where((F.size("embedding") == size) & whole)
    )


def _packed(numbers: np.ndarray) -> tuple[str, bytes]:
    """A matrix of whole doubles in the smallest kind of integers that holds it, else as text."""
    most = np.abs(numbers).max(initial=0)
    for kind in "hiq":
        if most < 2.0 ** (8 * np.dtype(kind).itemsize - 1):
            return kind, numbers.astype(kind).tobytes()
    return "text", b",".join(b"%d" % int(x) for x in numbers.ravel())


def _unpacked(kind: str, data: bytes, size: int) -> np.ndarray:
    if kind == "text":
        return np.array([int(x) for x in data.split(b",")], object).reshape(-1, size)
    return np.frombuffer(data, kind).reshape(-1, size)


def blocks(able: DataFrame, size: int = SIZE) -> DataFrame:
    """The vectors as rows of many, with every cluster -1 and no heaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
            kind, data = _packed(np.floor(flat.reshape(-1, size) * SCALE))
            none = np.full(batch.num_rows, -1, np.int32).tobytes()
            row = [batch.column("vec_id").to_pylist(), kind, data, none, None, None, None, []]
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _TYPES)], _NAMES)

    return able.mapInArrow(run, _BLOCK)


def first_centroids(able: DataFrame, clusters: int, seed: str) -> list[list[int]]:
    """The vectors with the smallest hashes of seed and id, at most ``clusters`` of them."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = able.withColumn("hash", hashed).orderBy("hash", "embedding").limit(clusters).collect()
    return [[int(np.floor(x * SCALE)) for x in row["embedding"]] for row in rows]


class Centres:
    """Centroids in whole numbers and exact squared distances to them."""

    def __init__(self, rows: list[list[int]]):
        self.most = max((abs(x) for row in rows for x in row), default=0)
        self.exact = np.array(rows, object)
        self._as: dict = {}

    def _of(self, kind: type) -> tuple[np.ndarray, np.ndarray]:
        if kind not in self._as:
            rows = self.exact.astype(kind)
            self._as[kind] = rows, (rows * rows).sum(axis=1)
        return self._as[kind]

    def _kind(self, vectors: np.ndarray) -> type:
        if vectors.dtype == object:
            return object
        most = max(self.most, int(vectors.max(initial=0)), -int(vectors.min(initial=0)))
        return np.float64 if most <= EXACT_DOUBLE else np.int64 if most <= EXACT_LONG else object

    def squares(self, vectors: np.ndarray) -> np.ndarray:
        """Squared distances of all vectors to all centroids."""
        kind = self._kind(vectors)
        rows, norms = self._of(kind)
        vectors = vectors.astype(kind)
        return (vectors * vectors).sum(axis=1)[:, None] - 2 * (vectors @ rows.T) + norms

    def own(self, vectors: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        """Squared distances of all vectors to the centroids of their clusters."""
        kind = self._kind(vectors)
        apart = vectors.astype(kind) - self._of(kind)[0][cluster]
        return (apart * apart).sum(axis=1)

    def scan(self, vectors: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid and heap key of every vector."""
        squares = self.squares(vectors)
        every = np.arange(len(vectors))
        best = squares.argmin(axis=1)
        nearest = np.sqrt(squares[every, best].astype(np.float64))
        squares = squares.astype(np.float64)
        squares[every, best] = np.inf
        second = np.sqrt(squares.min(axis=1))
        held = drift[best]
        with np.errstate(invalid="ignore"):
            keys = second - nearest + held - MARGIN * (1 + second + nearest + held)
        keys[np.isinf(second)] = np.inf
        return best, keys


def _sorted_heaps(best: np.ndarray, keys: np.ndarray, clusters: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, keys and rows of the heaps of a block scanned as a whole; a sorted list is a heap."""
    order = np.lexsort((keys, best))
    return np.bincount(best, minlength=clusters), keys[order], order.astype(np.int32)


def _renewed(
    vectors: np.ndarray, cluster: np.ndarray, heaps: tuple, centres: Centres, drift: np.ndarray
) -> tuple[np.ndarray, np.ndarray, tuple]:
    """Pop what has expired, rescan it and push it again: the popped rows, their clusters, the heaps."""
    sizes, keys, rows = heaps
    ends = np.cumsum(sizes)
    opened: dict[int, list[tuple[float, int]]] = {}

    def open_(c: int) -> list[tuple[float, int]]:
        if c not in opened:
            part = slice(ends[c] - sizes[c], ends[c])
            opened[c] = list(zip(keys[part].tolist(), rows[part].tolist()))
        return opened[c]

    popped = []
    for c in np.flatnonzero(sizes):
        if keys[ends[c] - sizes[c]] <= drift[c]:
            heap = open_(c)
            while heap and heap[0][0] <= drift[c]:
                popped.append(heapq.heappop(heap)[1])
    at = np.array(popped, np.int64)
    if not popped:
        return at, at, heaps
    best, fresh = centres.scan(vectors[at], drift)
    for row, c, key in zip(popped, best.tolist(), fresh.tolist()):
        heapq.heappush(open_(c), (key, row))
    parts = []
    for c in range(len(sizes)):
        if c in opened:
            held = opened[c]
            parts.append((np.array([k for k, _ in held], np.float64), np.array([r for _, r in held], np.int32)))
        else:
            part = slice(ends[c] - sizes[c], ends[c])
            parts.append((keys[part], rows[part]))
    sizes = np.array([len(k) for k, _ in parts], np.int64)
    return at, best, (sizes, np.concatenate([k for k, _ in parts]), np.concatenate([r for _, r in parts]))


def assigned(stored: DataFrame, centroids: list[list[int]], drift: np.ndarray) -> DataFrame:
    """The blocks after one assignment, and a row per task with how its clusters' sums changed."""
    size, clusters = len(centroids[0]), len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = Centres(centroids)
        counts = [0] * clusters
        sums = np.zeros((clusters, size), object)

        def add(vectors: np.ndarray, which: np.ndarray, sign: int) -> None:
            for c in np.unique(which):
                part = vectors[which == c]
                counts[c] += sign * len(part)
                exact = part if part.dtype == object else part.astype(np.int64)
                if part.dtype == np.int64:  # sums of these may pass 64 bits
                    exact = part.astype(object)
                sums[c] += sign * exact.sum(axis=0).astype(object)

        for batch in batches:
            for row in batch.to_pylist():
                vectors = _unpacked(row["kind"], row["data"], size)
                before = np.frombuffer(row["cluster"], np.int32)
                if row["keys"] is None:
                    at, (best, keys) = np.arange(len(vectors)), centres.scan(vectors, drift)
                    heaps = _sorted_heaps(best, keys, clusters)
                else:
                    heaps = (
                        np.frombuffer(row["sizes"], np.int64),
                        np.frombuffer(row["keys"], np.float64),
                        np.frombuffer(row["rows"], np.int32),
                    )
                    at, best, heaps = _renewed(vectors, before, heaps, centres, drift)
                cluster = before.copy()
                cluster[at] = best
                moved = at[before[at] != best]
                there = moved[before[moved] >= 0]
                add(vectors[there], before[there], -1)
                add(vectors[moved], cluster[moved], 1)
                out = [row["ids"], row["kind"], row["data"], cluster.tobytes(), *(h.tobytes() for h in heaps), []]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(out, _TYPES)], _NAMES)
        change = [
            {"cluster": c, "n": counts[c], "sums": [str(x) for x in sums[c]]}
            for c in range(clusters)
            if counts[c] or any(sums[c])
        ]
        if change:
            row = [None] * 7 + [change]
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _TYPES)], _NAMES)

    return stored.mapInArrow(run, _BLOCK)


def _changes(table: DataFrame) -> list:
    """Changes of counts and sums over all tasks: at most clusters x components rows."""
    each = table.where("ids is null").select(F.explode("change").alias("c"))
    parts = each.select("c.cluster", "c.n", F.posexplode("c.sums").alias("at", "value"))
    return (
        parts.groupBy("cluster", "at")
        .agg(F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
        .collect()
    )


def _drifted(drift: np.ndarray, before: list[list[int]], after: list[list[int]]) -> np.ndarray:
    """The drifts once every centroid has moved: its own move and the farthest move of any other."""
    moves = np.array([sum((x - y) ** 2 for x, y in zip(a, b)) ** 0.5 for a, b in zip(before, after)], np.float64)
    farthest = np.array([max([0.0, *moves[:c], *moves[c + 1 :]]) for c in range(len(moves))])
    return drift + (moves + farthest) * (1 + MARGIN)


def _placed(table: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``(vec_id, cluster, distance)`` of every vector of the blocks."""
    size = len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = Centres(centroids)
        for batch in batches:
            for row in batch.to_pylist():
                vectors = _unpacked(row["kind"], row["data"], size)
                cluster = np.frombuffer(row["cluster"], np.int32)
                squares = centres.own(vectors, cluster)
                if squares.dtype == object:
                    squares = [x if x < 1 << 63 else None for x in squares]
                else:
                    squares = squares.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(cluster), pa.array(squares, pa.int64())],
                    ["vec_id", "cluster", "distance"],
                )

    whole = table.where("ids is not null").select("ids", "kind", "data", "cluster")
    return whole.mapInArrow(run, "vec_id long, cluster int, distance long")


def clustered(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE, seed: str = SEED
) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every vector.

    With fewer vectors than ``clusters``, each is a centroid of its own.
    """
    spark = vectors.sparkSession
    able = usable(vectors, size)
    centroids = first_centroids(able, clusters, seed)
    if not centroids:
        none = "cast(null as int) cluster, 0L distance, 0L cluster_inertia, 0L inertia, '' centroid_sha256"
        return able.selectExpr("vec_id", *none.split(", ")).limit(0)
    path = write_scratch(blocks(able, size), "centroid_blocks")
    counts = [0] * len(centroids)
    sums = [[0] * size for _ in centroids]
    drift = np.zeros(len(centroids))
    for turn in range(rounds + 1):
        whole = _read(spark, path).where("ids is not null")
        fresh = write_scratch(assigned(whole, centroids, drift), "centroid_blocks")
        old, fs = hadoop_path(spark, path)
        fs.delete(old, True)
        path = fresh
        if turn == rounds:
            break
        for row in _changes(_read(spark, path)):
            c = row["cluster"]
            sums[c][row["at"]] += int(row["value"])
            if row["at"] == 0:
                counts[c] += row["n"]
        after = [[x // n for x in s] if n else c for s, n, c in zip(sums, counts, centroids)]
        drift = _drifted(drift, centroids, after)
        centroids = after
    placed = materialize(_placed(_read(spark, path), centroids), "centroid_rows")
    old, fs = hadoop_path(spark, path)
    fs.delete(old, True)
    digests = [
        (c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids)
    ]
    names = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    per = placed.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    whole = placed.agg(F.try_sum("distance").alias("inertia"))
    told = per.join(F.broadcast(names), "cluster").join(F.broadcast(whole))  # a row per cluster and one row
    return placed.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _read(spark, path: str) -> DataFrame:
    return spark.read.schema(_BLOCK).parquet(path)
