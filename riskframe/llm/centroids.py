"""Centroid clustering in integers, with heap-ordered bounds.

Vectors are packed into chunks, written once and bucketed by chunk. Beside them a small table holds the
state of every chunk: for each cluster a binary heap of its vectors, keyed by the gap between the
distance to the second nearest and to the own centroid. When centroids move, a cluster's offset
grows by its own drift and the largest drift of another; a gap above the offset proves that the
own centroid is still strictly the nearest. A round therefore pops only the vectors whose gap has
expired, compares these with all centroids exactly, and pushes them with a fresh gap. Chunks return
what their moved vectors add to and take from the sums of the clusters; the driver sees those sums
(clusters x components) and the centroids, nothing that grows with the table.

Vectors and state meet by their common bucketing, so no round shuffles vectors or writes them again.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.session import materialise, scratch_path, shuffle_width

#: Integers stay below this size; beyond it squared distances would leave the 64 bits of a long.
LARGEST = 1 << 27
#: Products and sums of 64 integers up to this size are exact in doubles.
EXACT_IN_DOUBLES = 1 << 23

CHUNKS = "chunk long, ids array<long>, x binary"
STATE = "chunk long, keys binary, rows binary, sizes binary, moved_n array<long>, moved_sum array<long>"


def integers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component; NULL for missing vectors and any missing or non-finite component.

    A component so large that squared distances could leave a long raises an error.
    """
    doubles = vector.cast("array<double>")
    good = F.forall(doubles, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    large = F.raise_error(F.lit(f"a component is {LARGEST} or more after scaling"))
    whole = F.transform(
        doubles, lambda c: F.when(F.abs(c) * scale < LARGEST, F.floor(c * scale)).otherwise(large.cast("bigint"))
    )
    return F.when(F.coalesce(good, F.lit(False)), whole)


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows, as int64."""
    largest = max((int(np.abs(a).max()) for a in (x, y) if a.size), default=0)
    if largest <= EXACT_IN_DOUBLES and x.shape[1] <= 64:
        return (x.astype(np.float64) @ y.T.astype(np.float64)).astype(np.int64)
    return x.astype(np.int64) @ y.T.astype(np.int64)


def squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    x, centres = x.astype(np.int64), centres.astype(np.int64)
    return (x * x).sum(1)[:, None] - 2 * products(x, centres) + (centres * centres).sum(1)


def nearest_two(x: np.ndarray, centres: np.ndarray):
    """(nearest centroid, its squared distance, that of the second); ties go to the smaller number."""
    d = squared_distances(x, centres)
    every = np.arange(len(x))
    best = d.argmin(1)
    own = d[every, best]
    if len(centres) == 1:
        return best, own, np.full(len(x), np.inf)
    d[every, best] = np.iinfo(np.int64).max
    return best, own, d.min(1).astype(np.float64)


def gap(own: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Distance to the second nearest less that to the nearest, lowered beyond any rounding."""
    root = np.sqrt(second)
    lowered = np.where(np.isfinite(root), root - 1e-9 * (1 + root), np.inf)
    return lowered - np.sqrt(own.astype(np.float64))


class Heaps:
    """The heaps of one chunk, a list of (key, row) per cluster."""

    def __init__(self, heaps: list[list]):
        self.heaps = heaps

    @classmethod
    def start(cls, x: np.ndarray, centres: np.ndarray) -> Heaps:
        best, own, second = nearest_two(x, centres)
        heaps = [[] for _ in centres]
        for c, entry in zip(best.tolist(), zip(gap(own, second).tolist(), range(len(x)))):
            heaps[c].append(entry)
        for heap in heaps:
            heapq.heapify(heap)
        return cls(heaps)

    @classmethod
    def unpack(cls, keys: bytes, rows: bytes, sizes: bytes) -> Heaps:
        entries = list(zip(np.frombuffer(keys).tolist(), np.frombuffer(rows, np.int32).tolist()))
        ends = np.cumsum(np.frombuffer(sizes, np.int64)).tolist()
        return cls([entries[lo:hi] for lo, hi in zip([0, *ends], ends)])

    def pack(self) -> tuple[bytes, bytes, bytes]:
        entries = [e for heap in self.heaps for e in heap]
        keys, rows = np.array([e[0] for e in entries], np.float64), np.array([e[1] for e in entries], np.int32)
        return keys.tobytes(), rows.tobytes(), np.array([len(h) for h in self.heaps], np.int64).tobytes()

    def expired(self, offsets: np.ndarray):
        """Pops the rows whose gap no longer covers the drift: (rows, the clusters they were in)."""
        rows, old = [], []
        for c, (heap, offset) in enumerate(zip(self.heaps, offsets.tolist())):
            while heap and heap[0][0] <= offset:
                rows.append(heapq.heappop(heap)[1])
                old.append(c)
        return np.array(rows, np.int64), np.array(old, np.int64)

    def advance(self, x: np.ndarray, centres: np.ndarray, offsets: np.ndarray):
        """Rescans what expired: (rows, old cluster, new cluster)."""
        rows, old = self.expired(offsets)
        if not len(rows):
            return rows, old, old
        best, own, second = nearest_two(x[rows], centres)
        for c, key, row in zip(best.tolist(), (gap(own, second) + offsets[best]).tolist(), rows.tolist()):
            heapq.heappush(self.heaps[c], (key, row))
        return rows, old, best

    def clusters(self, n: int) -> np.ndarray:
        out = np.zeros(n, np.int64)
        for c, heap in enumerate(self.heaps):
            out[[row for _, row in heap]] = c
        return out


def _chunked(batches, dims: int, rows: int):
    """Rows (id, x) -> chunks of at most ``rows`` vectors."""
    at = TaskContext.get().partitionId() << 33
    for batch in batches:
        ids, x = batch.column(0), batch.column(1)
        flat = x.flatten().to_numpy().astype(np.int32).reshape(-1, dims)
        for lo in range(0, len(flat), rows):
            part = flat[lo : lo + rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([at]), pa.array([ids.slice(lo, rows).to_pylist()], pa.list_(pa.int64())), pa.array([part.tobytes()])],
                ["chunk", "ids", "x"],
            )
            at += 1


def _matrix(data: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(data, np.int32).reshape(-1, dims)


def _state_row(chunk: int, heaps: Heaps, n: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
    keys, rows, sizes = heaps.pack()
    longs = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array([chunk]), pa.array([keys]), pa.array([rows]), pa.array([sizes]), pa.array([n.tolist()], longs), pa.array([total.ravel().tolist()], longs)],
        ["chunk", "keys", "rows", "sizes", "moved_n", "moved_sum"],
    )


def _added(rows_x: np.ndarray, cluster: np.ndarray, k: int):
    total = np.zeros((k, rows_x.shape[1]), np.int64)
    np.add.at(total, cluster, rows_x.astype(np.int64))
    return np.bincount(cluster, minlength=k).astype(np.int64), total


def _start(batches, centres: np.ndarray):
    for batch in batches:
        for row in batch.to_pylist():
            x = _matrix(row["x"], centres.shape[1])
            heaps = Heaps.start(x, centres)
            yield _state_row(row["chunk"], heaps, *_added(x, heaps.clusters(len(x)), len(centres)))


def _advance(batches, centres: np.ndarray, offsets: np.ndarray):
    for batch in batches:
        for row in batch.to_pylist():
            x, heaps = _matrix(row["x"], centres.shape[1]), Heaps.unpack(row["keys"], row["rows"], row["sizes"])
            rows, old, new = heaps.advance(x, centres, offsets)
            went, took = _added(x[rows], new, len(centres)), _added(x[rows], old, len(centres))
            yield _state_row(row["chunk"], heaps, went[0] - took[0], went[1] - took[1])


def _assigned(batches, centres: np.ndarray, offsets: np.ndarray):
    for batch in batches:
        for row in batch.to_pylist():
            x, heaps = _matrix(row["x"], centres.shape[1]), Heaps.unpack(row["keys"], row["rows"], row["sizes"])
            heaps.advance(x, centres, offsets)
            cluster = heaps.clusters(len(x))
            difference = x.astype(np.int64) - centres[cluster]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(cluster.astype(np.int32)), pa.array((difference * difference).sum(1))],
                ["vec_id", "cluster", "distance"],
            )


@dataclass(frozen=True)
class HeapClustering:
    """``k`` centroids of ``dims`` components, moved in ``rounds``; ``chunk``: vectors a heap set covers at most."""

    k: int = 40
    rounds: int = 5
    dims: int = 64
    scale: int = 256
    seed: int = 2
    chunk: int = 8_192

    def vectors(self, table: DataFrame, key: str, vector: str) -> DataFrame:
        """(id, x): the rows that take part, as integers."""
        usual = table.where(F.size(vector) == self.dims)
        return usual.select(F.col(key).cast("bigint").alias("id"), integers(F.col(vector), self.scale).alias("x")).where("x is not null")

    def starts(self, vectors: DataFrame) -> np.ndarray:
        """The vectors whose hashed ids are the smallest; equal hashes by components."""
        hashed = vectors.where("id is not null").withColumn("h", F.sha2(F.concat(F.lit(f"{self.seed}:"), F.col("id").cast("string")), 256))
        first = hashed.orderBy("h", "x").limit(self.k).select("x").collect()
        return np.array([r.x for r in first], np.int64).reshape(-1, self.dims)

    def cluster(self, table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
        """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that takes part.

        Vectors that are missing, of another length or with a missing or non-finite component take no
        part. Vectors without id are clustered but never start as a centroid; repeated rows are vectors
        of their own. Fewer than ``k`` vectors with ids give as many centroids; without any, and for an
        empty table, the result is empty. Further columns are ignored.
        """
        spark = table.sparkSession
        vectors = self.vectors(table, key, vector)
        centres = self.starts(vectors)
        if not len(centres):
            nothing = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
            return spark.createDataFrame([], nothing)
        dims, rows, k = self.dims, self.chunk, len(centres)
        with _Bucketed(spark) as store:
            chunks = store.write(vectors.mapInArrow(lambda bs: _chunked(bs, dims, rows), CHUNKS).repartition(store.buckets, "chunk"))
            state = store.write(chunks.mapInArrow(lambda bs, c=centres: _start(bs, c), STATE))
            n, total, offsets = [0] * k, [[0] * dims for _ in range(k)], np.zeros(k)
            for at in range(self.rounds):
                self._add(state, n, total)
                moved = np.array([[s // m for s in t] if m else c for m, t, c in zip(n, total, centres.tolist())], np.int64)
                offsets = offsets + self._drift(centres, moved)
                centres = moved
                if at < self.rounds - 1:
                    both = chunks.select("chunk", "x").join(state.select("chunk", "keys", "rows", "sizes"), "chunk")
                    state = store.write(both.mapInArrow(lambda bs, c=centres, o=offsets: _advance(bs, c, o), STATE))
            both = chunks.join(state.select("chunk", "keys", "rows", "sizes"), "chunk")
            found = materialise(
                both.mapInArrow(lambda bs: _assigned(bs, centres, offsets), "vec_id long, cluster int, distance long"), "assigned"
            )
        return self._summed(found, centres)

    def _add(self, state: DataFrame, n: list, total: list) -> None:
        """Adds what moved in a round to the counts and sums of the clusters (k and k x dims numbers)."""
        for column, put in (("moved_n", self._put_n(n)), ("moved_sum", self._put_sum(total))):
            each = state.select(F.posexplode(column).alias("i", "v")).where("v <> 0")
            for r in each.groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect():
                put(r.i, int(r.v))

    def _put_n(self, n: list):
        def put(i, v):
            n[i] += v

        return put

    def _put_sum(self, total: list):
        def put(i, v):
            total[i // self.dims][i % self.dims] += v

        return put

    def _drift(self, old: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Per cluster: how far its centroid moved, plus the furthest move of another; raised beyond any rounding."""
        d = np.sqrt(((new - old).astype(np.float64) ** 2).sum(1)) * (1 + 1e-9)
        order = np.argsort(-d, kind="stable")
        most = np.full(len(d), d[order[0]])
        most[order[0]] = d[order[1]] if len(d) > 1 else 0.0
        return d + most

    def _summed(self, found: DataFrame, centres: np.ndarray) -> DataFrame:
        spark = found.sparkSession
        sums = {r.cluster: r.d for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
        inertia = sum(sums.values())
        digest = lambda c: hashlib.sha256(",".join(map(str, centres[c].tolist())).encode()).hexdigest()
        rows = [(c, d, inertia, digest(c)) for c, d in sums.items()]  # at most k rows
        each = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
        return found.join(F.broadcast(each), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


class _Bucketed:
    """Tables in the shared scratch folder, bucketed alike by chunk; the catalog forgets them at the end."""

    def __init__(self, spark):
        self.spark, self.names, self.buckets = spark, [], shuffle_width(spark)

    def write(self, df: DataFrame) -> DataFrame:
        name = f"riskframe_{uuid.uuid4().hex}"
        path = scratch_path(self.spark, "chunks")
        df.write.bucketBy(self.buckets, "chunk").option("path", path).format("parquet").saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def equivalent_sql(c: HeapClustering) -> str:
    """The same clustering without bounds: every vector against every centroid in every round."""
    steps = []
    for at in range(c.rounds + 1):
        steps.append(f"""
a{at} AS (
  SELECT vec_id, x, unnest(min(m)) FROM (
    SELECT v.vec_id, v.x, struct_pack(
      distance := CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT),
      cluster := c.cluster) AS m
    FROM v CROSS JOIN c{at} c) GROUP BY vec_id, x)""")
        if at < c.rounds:
            steps.append(f"""
c{at + 1} AS (
  SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{at} c LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM (
      SELECT cluster, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n
      FROM a{at} CROSS JOIN range(1, {c.dims + 1}) r(i) GROUP BY cluster, i) GROUP BY cluster) m
  ON c.cluster = m.cluster)""")
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda e: CAST(floor({c.scale} * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {c.dims} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS cluster, x
  FROM (SELECT sha256('{c.seed}:' || vec_id) AS h, x FROM v ORDER BY h LIMIT {c.k})),
{",".join(steps)},
sums AS (SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM a{c.rounds} GROUP BY cluster)
SELECT a.vec_id, a.cluster, a.distance, s.cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(f.x, ',')) AS centroid_sha256
FROM a{c.rounds} a JOIN sums s ON a.cluster = s.cluster JOIN c{c.rounds} f ON a.cluster = f.cluster"""
