"""Exact top-k inner products by a three-phase uniform threshold.

Vectors are cut by dimension into ``LISTS`` lists; a list knows its part of every score. Phase one
takes each list's own best k entries per query and resolves their whole scores: the k-th best is a
safe cutoff, as at least k entries reach it. Phase two hands each list its even share of the
cutoff: an entry that reaches the cutoff reaches the share in some list, so every list sends the
entries that do, and none is missed. Phase three resolves the whole scores of what was sent.

Lists are worked through in blocks of rows against blocks of queries. Entries are (query, vector)
pairs that pass the share; no block sends all its pairs.

The search is among distinct vectors, for k + 1 of them per distinct query vector: copies of a
vector have one score and would reach every cutoff together. A vector stands for the k + 1 smallest
of its ids, more can't be among any query's best; a query leaves itself out of its vector's answer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored

LISTS = 2
ROW_BLOCK, QUERY_BLOCK = 2048, 512
LARGEST = 2.0 ** 53  # scaled components below it are doubles and whole
BROADCAST_BYTES = 4 << 20  # queries' vectors up to so many are broadcast
_SLACK = 2.0 ** -40  # rounding of a part, as a share of its absolute products, is far smaller
_ENTRY = "query_id bigint, vec_id bigint, part double"


def _usable(v: Column, scale: int) -> Column:
    return F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < LARGEST))


def _top(df: DataFrame, k: int, order: Column, *keys: str) -> DataFrame:
    """At most k rows per key; Spark cuts in the map tasks already."""
    at = Window.partitionBy(*keys).orderBy(order.desc(), "vec_id")
    return df.withColumn("rank", F.row_number().over(at)).filter(F.col("rank") <= k)


def _blocked(vectors: DataFrame, count: int, size: int, bounds: list[int],
             number: str) -> DataFrame:
    """(number, list, ids, values, shares): vectors in blocks of about ``size`` rows by hash."""
    def build(table: pa.Table) -> pa.Table:
        width = bounds[-1]
        full = np.zeros((table.num_rows, width))
        for i, v in enumerate(table.column("values").to_pylist()):
            full[i, :len(v)] = v
        n = len(bounds) - 1
        share = table.column("cutoff").to_numpy().astype(np.float64)
        return pa.table({
            number: pa.array([table.column(number)[0].as_py()] * n, pa.int64()),
            "list": pa.array(range(n), pa.int32()),
            "ids": pa.array([table.column("vec_id").to_numpy().tobytes()] * n, pa.binary()),
            "values": pa.array([np.ascontiguousarray(full[:, a:b]).tobytes()
                                for a, b in zip(bounds, bounds[1:])], pa.binary()),
            "shares": pa.array([share.tobytes()] * n, pa.binary()),
        })

    blocks = max(1, math.ceil(count / size))
    return vectors.withColumn(number, F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).groupBy(
        number).applyInArrow(
            build, f"{number} bigint, list int, ids binary, values binary, shares binary")


def _tiles(rows: DataFrame, queries: DataFrame, blocks: int) -> DataFrame:
    """Every block of queries beside every block of rows, list by list."""
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))
    asked = queries.select(F.explode(every).alias("block"), "list", F.col("ids").alias("qids"),
                           F.col("values").alias("qvalues"), F.col("shares").alias("qshares"))
    return rows.drop("shares").hint("merge").join(asked, ["block", "list"]).select(
        "list", "ids", "values", "qids", "qvalues", "qshares")


def _entries(tiles: DataFrame, choose) -> DataFrame:
    """(query_id, vec_id, part, list): of each tile the entries that ``choose`` picks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for which, ids, values, qids, qvalues, shares in zip(
                    *[c.to_pylist() for c in batch.columns]):
                ids, qids = np.frombuffer(ids, np.int64), np.frombuffer(qids, np.int64)
                a = np.frombuffer(qvalues).reshape(len(qids), -1)
                b = np.frombuffer(values).reshape(len(ids), -1)
                parts = a @ b.T
                q, v = choose(parts, a, b, np.frombuffer(shares))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qids[q]), pa.array(ids[v]), pa.array(parts[q, v]),
                     pa.array(np.full(len(q), which, np.int32))],
                    ["query_id", "vec_id", "part", "list"])

    return tiles.mapInArrow(run, f"{_ENTRY}, list int")


def _best(k: int):
    def choose(parts, a, b, shares):
        n = min(k, parts.shape[1])
        v = np.argpartition(-parts, n - 1, axis=1)[:, :n]
        return np.repeat(np.arange(len(parts)), n), v.ravel()
    return choose


def _reaching(lists: int, exact: bool):
    def choose(parts, a, b, shares):
        most = parts if exact else parts + _SLACK * (np.abs(a) @ np.abs(b).T)
        return np.nonzero(most * lists >= shares[:, None])
    return choose


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256,
          id_col: str = "vec_id", values: str = "embedding", lists: int = LISTS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best other vectors, ties to smaller ids.

    A component is floor(scale * x); the score is the integer inner product. Rows without an id and
    vectors that are null or hold null, non-finite or too large components (2^53 and more when
    scaled) take no part. Rows that share an id are one vector, the largest. Shorter vectors count
    as if zeros followed. With fewer others than k all are returned; an empty table gives an empty
    result. ``is_query`` is a condition on the id. Scores beyond 64 bits are ranked exactly and null
    in the result.
    """
    source = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"),
                            F.col(values).cast("array<double>").alias("_v"))
    whole = F.transform("_v", lambda x: F.floor(x * scale))
    rows = stored(source.filter(F.col("vec_id").isNotNull() & F.col("_v").isNotNull())
                  .filter(_usable(F.col("_v"), scale)).select("vec_id", whole.alias("values"))
                  .groupBy("vec_id").agg(F.max("values").alias("values")), "vectors")
    same = Window.partitionBy("values").orderBy("vec_id")
    members = stored(rows.withColumn("_n", F.row_number().over(same)).filter(F.col("_n") <= k + 1)
                     .withColumn("point", F.first("vec_id").over(same)), "members")
    points = members.filter("_n = 1").select("vec_id", "values")
    named = points.withColumnRenamed("vec_id", "point")
    askers = stored(rows.filter(is_query).withColumnRenamed("vec_id", "query_id")
                    .join(named.hint("merge"), "values").select("query_id", "point"), "queries")
    asked = points.join(askers.select(F.col("point").alias("vec_id")), "vec_id", "left_semi")
    largest = F.max(F.greatest(F.abs(F.array_max("values")), F.abs(F.array_min("values"))))
    count, width, most = points.select(F.count("*"), F.max(F.size("values")), largest).first()
    queries = askers.select("point").distinct().count()
    # Doubles hold sums of products exactly up to 2^53.
    exact = (most or 0) ** 2 * max(width or 1, 1) < LARGEST
    bounds = [(width or 0) * i // lists for i in range(lists + 1)]
    blocks = max(1, math.ceil(count / ROW_BLOCK))
    placed = stored(_blocked(points.withColumn("cutoff", F.lit(0)), count, ROW_BLOCK, bounds,
                             "block"), "row-blocks")

    def tiles(cutoffs: Column | None, of: DataFrame) -> DataFrame:
        ruled = of.withColumn("cutoff", F.lit(0) if cutoffs is None else cutoffs)
        return _tiles(placed, _blocked(ruled, queries, QUERY_BLOCK, bounds, "group"), blocks)

    def resolved(pairs: DataFrame) -> DataFrame:
        """Whole scores of (query_id, vec_id)."""
        kind = "bigint" if exact else "decimal(38,0)"
        q = asked.select(F.col("vec_id").alias("query_id"), F.col("values").alias("_q"))
        if queries * (width or 0) * 8 <= BROADCAST_BYTES:  # pairs move without a vector
            both = pairs.join(points.hint("merge"), "vec_id").join(F.broadcast(q), "query_id")
        else:
            both = pairs.join(q.hint("merge"), "query_id").join(points.hint("merge"), "vec_id")
        products = F.zip_with("_q", "values", lambda a, b: F.coalesce(
            a.cast(kind) * b.cast(kind), F.lit(0)).cast(kind))
        return both.select("query_id", "vec_id", F.aggregate(
            products, F.lit(0).cast(kind), lambda s, x: (s + x).cast(kind)).alias("score"))

    local = _entries(tiles(None, asked), _best(k + 1))
    gathered = _top(local, k + 1, F.col("part"), "query_id", "list").select(
        "query_id", "vec_id").distinct()
    known = _top(resolved(gathered), k + 1, F.col("score"), "query_id")
    cutoff = F.col("score").cast("double")
    lower = cutoff if exact else cutoff - F.abs(cutoff) * _SLACK
    cutoffs = known.filter(F.col("rank") == k + 1).select(
        F.col("query_id").alias("vec_id"), lower.alias("_cutoff"))
    # Without k + 1 vectors there is nothing to cut.
    ruled = asked.join(cutoffs, "vec_id", "left")
    sent = _entries(tiles(F.coalesce("_cutoff", F.lit(float("-inf"))), ruled),
                    _reaching(lists, exact))
    found = _top(resolved(sent.select("query_id", "vec_id").distinct()), k + 1, F.col("score"),
                 "query_id").select(F.col("query_id").alias("asker"),
                                    F.col("vec_id").alias("point"), "score")
    of_vector = _top(found.join(members.select("point", "vec_id").hint("merge"), "point"), k + 1,
                     F.col("score"), "asker").select(F.col("asker").alias("point"), "vec_id", "score")
    answers = askers.join(of_vector, "point").filter("query_id <> vec_id")
    return _top(answers, k, F.col("score"), "query_id").select(
        "query_id", "rank", "vec_id", F.expr("try_cast(score AS BIGINT)").alias("score"))
