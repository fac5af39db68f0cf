"""Exact centroid clustering over zone maps along a space-filling curve.

Vectors become integers and are sorted along a Hilbert curve, so neighbours in the order are near each
other in all dimensions. Runs of them are stored as blocks with the least and the greatest value of
each dimension, a box. A round reads the blocks once: the distances of a centroid to the nearest and
to the farthest corner of the box bound those of all its vectors, so a centroid whose nearest corner
is farther than another's farthest is none of theirs; and one that is farther than the likeliest
centroid, wherever in the box a vector lies, is none either. What is left are the block's candidates,
and only with them vectors are compared, exactly and a block at a time.

Every task adds up its vectors by cluster; sums are of any size and go through the shuffle in limbs of
32 bits, one row per cluster, dimension and limb. The driver holds the centroids, nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import small_batches, stored

CLUSTERS, ROUNDS, SCALE, DIMENSIONS = 8, 10, 1024, 64
SEED = "3:"
BLOCK = 128  # vectors of a block
CURVE_BITS = 4  # bits of each dimension that place a vector on the curve
CURVE_REACH = 0.5  # values beyond it share the outermost cells
# Below it, squared distances of integers are exact in doubles whatever the order of the sums.
EXACT = 1 << 22
LIMB = 32


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of cells along the Hilbert curve, as one row of bits, highest first.

    The curve's own steps (a turn and a flip for every bit of every dimension, then the Gray code)
    are done for all rows at once.
    """
    x = cells.astype(np.uint32).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = np.uint32(q - 1)
        for i in range(n):
            high = (x[i] & q) != 0
            turned = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, turned)
            x[i] ^= turned
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flips = np.zeros(x.shape[1], np.uint32)
    q = 1 << (bits - 1)
    while q > 1:
        flips ^= np.where((x[-1] & q) != 0, np.uint32(q - 1), np.uint32(0))
        q >>= 1
    x ^= flips
    planes = (x[None, :, :] >> np.arange(bits - 1, -1, -1, dtype=np.uint32)[:, None, None]) & 1
    return planes.reshape(bits * n, -1).T.astype(np.uint8)


def integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(vectors * float(scale))


def usable(vector: Column, dimensions: int, scale: int) -> Column:
    """Vectors of the right length, all of whose components are known and finite, scaled too."""
    limit = F.lit(float(np.finfo(float).max) / scale)
    return (F.size(vector) == dimensions) & F.forall(
        vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) <= limit))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), dimensions)


def zone_blocks(vectors: DataFrame, dimensions: int, scale: int, block: int = BLOCK) -> DataFrame:
    """(ids, vectors, low, high): runs along the curve with their boxes.

    ``vectors`` has the columns ``_id``, ``_vector`` and ``_row``, a number that tells copies apart:
    copies of one vector may be any share of the rows and spread over as many ranges.
    """
    kind = vectors.schema["_id"].dataType.simpleString()
    numbers = f"array<{kind}>"

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = 1 << CURVE_BITS
        for batch in batches:
            rows = integers(_matrix(batch.column("_vector"), dimensions), scale)
            cells = np.floor((rows / (scale * CURVE_REACH) + 1) * (side / 2))
            bits = hilbert_keys(np.clip(cells, 0, side - 1), CURVE_BITS)
            keys = np.packbits(bits, axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k.tobytes() for k in keys], pa.binary()), *batch.columns],
                ["_place", *batch.schema.names])

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def cut(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            whole = pa.concat_batches(held) if held else None
            start = 0
            while size >= least and size:
                part = whole.slice(start, block)
                rows = integers(_matrix(part.column("_vector"), dimensions), scale)
                ids = pa.ListArray.from_arrays([0, len(rows)], part.column("_id"))
                yield pa.RecordBatch.from_arrays(
                    [ids, *[pa.array([a], pa.list_(pa.float64()))
                            for a in (rows.ravel(), rows.min(0), rows.max(0))]],
                    ["ids", "vectors", "low", "high"])
                start, size = start + len(rows), size - len(rows)
            held = [whole.slice(start)] if size else []

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            yield from cut(block)
        yield from cut(1)

    along = vectors.mapInArrow(placed, f"_place binary, _id {kind}, _vector array<double>, _row bigint")
    ranged = along.repartitionByRange("_place", "_row").sortWithinPartitions("_place", "_row")
    doubles = "array<double>"
    return ranged.mapInArrow(
        blocked, f"ids {numbers}, vectors {doubles}, low {doubles}, high {doubles}")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that a vector inside the box can be nearest to, ties included.

    With doubles the bounds are widened by more than their rounding errors.
    """
    nearest = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    farthest = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    near, far = (nearest * nearest).sum(1), (farthest * farthest).sum(1)
    slack = 0 if centroids.dtype == object else 1 + float(far.max()) * 1e-12
    kept = np.flatnonzero((near <= far.min() + slack).astype(bool))
    best = kept[int(np.argmin(far[kept]))]
    # d(x, best) - d(x, c) is linear in x, so its greatest value over the box is at a corner.
    towards = 2 * (centroids[kept] - centroids[best])
    corner = np.where((towards > 0).astype(bool), high, low)
    squares = (centroids * centroids).sum(1)
    behind = (corner * towards).sum(1) + squares[best] - squares[kept]
    return kept[(behind >= -slack).astype(bool)]


def nearest(rows: np.ndarray, centroids: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest of the chosen centroids, the smaller one of equals, and its distance."""
    distances = np.empty((len(rows), len(chosen)), rows.dtype)
    for j, c in enumerate(chosen):
        off = rows - centroids[c]
        distances[:, j] = (off * off).sum(1)
    best = np.argmin(distances, axis=1)  # the first of equals
    return chosen[best], distances[np.arange(len(rows)), best]


def _exact(a: np.ndarray) -> np.ndarray:
    """Whole numbers in doubles as Python's integers."""
    return np.array([int(v) for v in a.ravel()], object).reshape(a.shape)


@dataclass
class Assigned:
    ids: pa.Array
    rows: np.ndarray
    cluster: np.ndarray
    distance: np.ndarray


def _assigned(batch: pa.RecordBatch, centroids: list[list[int]]) -> Iterator[Assigned]:
    """The vectors of each block with their clusters; numbers too large for doubles are Python's."""
    whole = np.array(centroids, object)
    near_zero = all(abs(v) < EXACT for c in centroids for v in c)
    for i in range(batch.num_rows):
        low, high, flat = (batch.column(c)[i].values.to_numpy() for c in ("low", "high", "vectors"))
        rows, points = flat.reshape(-1, len(low)), whole
        if near_zero and np.abs(low).max() < EXACT and np.abs(high).max() < EXACT:
            points = whole.astype(float)
        else:
            rows, low, high = _exact(rows), _exact(low), _exact(high)
        chosen = candidates(low, high, points)
        yield Assigned(batch.column("ids")[i].values, rows, *nearest(rows, points, chosen))


def _limbs(number: int) -> Iterator[tuple[int, int]]:
    """A whole number in limbs, lowest first; the last one carries the sign."""
    place = 0
    while not -(1 << (LIMB - 1)) <= number < 1 << (LIMB - 1):
        yield place, number & ((1 << LIMB) - 1)
        number >>= LIMB
        place += 1
    yield place, number


@dataclass
class Totals:
    """Exact sums by cluster; entry 0 is the count, 1 the distances, the others the dimensions."""

    sums: dict[int, list[int]] = field(default_factory=dict)

    def add(self, found: Assigned) -> None:
        for c in np.unique(found.cluster).tolist():
            mine = found.cluster == c
            new = [int(mine.sum()), sum(map(int, found.distance[mine].tolist())),
                   *map(int, found.rows[mine].sum(0).tolist())]
            old = self.sums.get(c)
            self.sums[c] = new if old is None else [a + b for a, b in zip(old, new)]

    def batch(self) -> pa.RecordBatch:
        rows = [(c, entry, place, limb) for c, sums in self.sums.items()
                for entry, total in enumerate(sums) for place, limb in _limbs(total)]
        return pa.RecordBatch.from_pylist(
            [dict(zip(_TOTALS.names, r)) for r in rows], schema=_TOTALS)


_TOTALS = pa.schema([("cluster", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()),
                     ("part", pa.int64())])


def totals(blocks: DataFrame, centroids: list[list[int]]) -> dict[int, list[int]]:
    """Count, summed distance and summed components of each cluster that has vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Totals()
        for batch in batches:
            for found in _assigned(batch, centroids):
                own.add(found)
        yield own.batch()

    parts = blocks.mapInArrow(run, "cluster int, entry int, place int, part bigint")
    sums: dict[int, dict[int, int]] = {}
    for r in parts.groupBy("cluster", "entry", "place").agg(F.sum("part").alias("part")).collect():
        entries = sums.setdefault(r.cluster, {})
        entries[r.entry] = entries.get(r.entry, 0) + (r.part << (LIMB * r.place))
    return {c: [e[i] for i in range(len(e))] for c, e in sums.items()}


def first_centroids(vectors: DataFrame, k: int, scale: int, seed: str) -> list[list[int]]:
    """The vectors whose ids have the smallest hashes; a null id is hashed as an empty one."""
    text = F.coalesce(F.col("_id").cast("string"), F.lit(""))
    rows = vectors.select(F.sha2(F.concat(F.lit(seed), text), 256).alias("_hash"), "_vector").orderBy(
        "_hash", "_vector").limit(k).collect()
    return [_exact(integers(np.array(r._vector), scale)).tolist() for r in rows]


@dataclass
class Clustering:
    """Final centroids, and the totals of the last assignment to them."""

    blocks: DataFrame
    centroids: list[list[int]]
    totals: dict[int, list[int]]


def fit(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE,
        dimensions: int = DIMENSIONS, id_col: str = "vec_id", vector: str = "embedding",
        seed: str = SEED, block: int = BLOCK) -> Clustering:
    """Lloyd's rounds in integers: means are rounded down, empty clusters keep their centroid.

    Vectors of another length, or with a null or non-finite component (``scale`` times it included),
    take no part. Rows that share an id, or have none, are vectors of their own. With fewer vectors
    than ``k`` there are as many centroids as vectors.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    values = F.col(vector).cast("array<double>")
    kept = vectors.select(F.col(id_col).alias("_id"), values.alias("_vector")).filter(
        usable(F.col("_vector"), dimensions, scale)).withColumn(
        "_row", F.monotonically_increasing_id())
    blocks = stored(zone_blocks(kept, dimensions, scale, block), "zone-blocks")
    centroids = first_centroids(kept, k, scale, seed)
    for _ in range(rounds):
        found = totals(blocks, centroids)
        centroids = [[v // found[c][0] for v in found[c][2:]] if c in found else old
                     for c, old in enumerate(centroids)]
    return Clustering(blocks, centroids, totals(blocks, centroids))


def assignments(model: Clustering, id_col: str = "vec_id") -> DataFrame:
    """(id, cluster, distance, centroid_sha256, cluster_inertia, inertia) of each vector.

    What does not fit 64 bits is null; the cluster is right all the same.
    """
    kind = model.blocks.schema["ids"].dataType.elementType.simpleString()
    centroids, fits = model.centroids, range(-(1 << 63), 1 << 63)
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    spread = [model.totals[c][1] if c in model.totals else 0 for c in range(len(centroids))]
    whole = sum(spread)
    of_cluster, of_all = [s if s in fits else None for s in spread], whole if whole in fits else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in _assigned(batch, centroids):
                cluster = found.cluster.tolist()
                distance = [d if d in fits else None for d in map(int, found.distance.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [found.ids, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64()),
                     pa.array([of_cluster[c] for c in cluster], pa.int64()),
                     pa.array([of_all] * len(cluster), pa.int64()),
                     pa.array([hashes[c] for c in cluster], pa.string())],
                    ["_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return model.blocks.mapInArrow(
        run, f"_id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
        "centroid_sha256 string").withColumnRenamed("_id", id_col)
