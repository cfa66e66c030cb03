"""Exact nearest neighbours by inner product as a join of blocks.

Vectors are held in blocks. A task meets one block of queries with one shard of the
candidates, tile by tile: products of the int8 codes give every inner product within an
error that is bounded per pair of vectors, so most pairs are ruled out by the bound; those
that may be among the nearest are computed again in double precision, and a heap per query
merges the tiles. The shards' results of a query are merged in the same way.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeline.llm.common import quoted

NEAREST = 20
SHARDS = 8
SHARD_BYTES = 32 << 20
QUERY_BYTES = 4 << 20
TILE = 2048


def _valid(vector: Column) -> Column:
    """No null, NaN or infinite component, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def codes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, their scale, the norm of what they stand for and that of the error."""
    scale = np.abs(vectors).max(axis=1) / 127.0
    scale[scale == 0] = 1.0  # the scale of a subnormal vector may vanish
    code = np.clip(np.rint(vectors / scale[:, None]), -127, 127).astype(np.int8)
    stands = code * scale[:, None]
    return code, scale, np.linalg.norm(stands, axis=1), np.linalg.norm(vectors - stands, axis=1)


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row by row, summed in the order of the components."""
    total = np.zeros(len(left))
    for d in range(left.shape[1]):
        total += left[:, d] * right[:, d]
    return total


def nearest_in_shard(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best ``k`` candidates of each query, with exact scores, ties to smaller ids."""
    if not len(queries) or not len(candidates):
        kinds = {"query_id": "int64", "row": "int64", "ids": object, "scores": object}
        return pd.DataFrame({name: pd.Series(dtype=kind) for name, kind in kinds.items()})
    q_ids, c_ids = queries["vec_id"].to_numpy(), candidates["vec_id"].to_numpy()
    q, c = (np.stack(x["vector"].to_numpy()).astype(np.float64) for x in (queries, candidates))
    rows = candidates["row"].to_numpy()
    q_code, q_scale, q_norm, q_error = codes(q)
    best = [(np.zeros(0, dtype=np.int64), np.zeros(0)) for _ in q_ids]
    least = np.full(len(q_ids), -np.inf)
    q_float = q_code.astype(np.float32)
    # Sums of int8 products are exact in float32 up to this many components.
    exact = np.float32 if q.shape[1] <= (1 << 24) // (127 * 127) else np.float64
    for at in range(0, len(c_ids), TILE):
        part = slice(at, at + TILE)
        c_code, c_scale, c_norm, c_error = codes(c[part])
        tile = (q_float.astype(exact) @ c_code.astype(exact).T).astype(np.float64)
        tile *= q_scale[:, None] * c_scale[None, :]
        # |q.c - tile| <= |q^||e_c| + |e_q||c^| + |e_q||e_c|, and a little for rounding.
        bound = np.outer(q_norm, c_error) + np.outer(q_error, c_norm + c_error)
        bound += 1e-9 * np.outer(q_norm + q_error, c_norm + c_error)
        bound[q_ids[:, None] == c_ids[None, part]] = -np.inf
        upper = tile + bound
        lower = np.where(np.isneginf(bound), -np.inf, tile - bound)
        if lower.shape[1] > k:
            kth = -np.partition(-lower, k - 1, axis=1)[:, k - 1]
            least = np.maximum(least, kth)
        which_q, which_c = np.nonzero((upper >= least[:, None]) & ~np.isneginf(bound))
        scores = inner_products(q[which_q], c[part][which_c])
        edges = np.searchsorted(which_q, np.arange(len(q_ids) + 1))
        for i in np.flatnonzero(np.diff(edges)):
            found = slice(edges[i], edges[i + 1])
            ids = np.concatenate([best[i][0], which_c[found] + at])
            all_scores = np.concatenate([best[i][1], scores[found]])
            order = np.lexsort((rows[ids], c_ids[ids], -all_scores))[:k]
            best[i] = ids[order], all_scores[order]
            if len(order) == k:
                least[i] = max(least[i], all_scores[order[-1]])
    return pd.DataFrame(
        {
            "query_id": q_ids,
            "row": queries["row"].to_numpy(),
            "ids": [c_ids[ids] for ids, _ in best],
            "scores": [scores for _, scores in best],
        }
    )


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int = NEAREST,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest others of each query row.

    Nearest is the largest inner product in double precision; ties go to the smaller id, and
    ranks count from 1. Rows whose id is null, or whose vector is null, empty, zero or holds a
    null or non-finite component take no part. Vectors meet only those of their own length. No
    row with the query's own id is its neighbour; an id given twice with one vector counts
    once, with two vectors twice. Fewer candidates give fewer rows, an empty table none.
    Other columns, whatever their names, are not looked at.

    Candidates are dealt into shards of bounded bytes and queries into blocks of bounded bytes;
    a shard is sent once to each block. Every pair is met, as the search is exact.
    """
    vector = quoted(vector_col).cast("array<double>")
    rows = df.filter(quoted(id_col).isNotNull() & _valid(vector))
    rows = rows.select(
        quoted(id_col).cast("long").alias("vec_id"),
        vector.alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
        F.size(vector).alias("dims"),
    ).withColumn("row", F.xxhash64("vec_id", "vector"))
    size = F.col("dims") * 8
    totals = rows.agg(F.sum(size).alias("all"), F.sum(F.when(F.col("is_query"), size)).alias("queries")).first()
    shards = max(SHARDS, math.ceil((totals["all"] or 0) / SHARD_BYTES))
    blocks = max(1, math.ceil((totals["queries"] or 0) / QUERY_BYTES))

    # Copies of a row are the same row; they are dealt evenly before they are made one.
    rows = rows.dropDuplicates(["vec_id", "row"])
    place = F.xxhash64("vec_id", "row", F.lit("place"))
    queries = (
        rows.filter("is_query")
        .withColumn("block", F.pmod(place, F.lit(blocks)).cast("int"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    )
    candidates = rows.withColumn("shard", F.pmod(place, F.lit(shards)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    columns = ["block", "shard", "dims", "vec_id", "row", "vector"]
    keys = ["block", "shard", "dims"]

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return nearest_in_shard(left, right, k)

    partial = (
        queries.select(*columns)
        .groupBy(*keys)
        .cogroup(candidates.select(*columns).groupBy(*keys))
        .applyInPandas(meet, "query_id bigint, row bigint, ids array<bigint>, scores array<double>")
    )
    entry = F.expr("transform(arrays_zip(ids, scores), x -> struct(-x.scores AS s, x.ids AS i))")
    merged = partial.groupBy("query_id", "row").agg(F.flatten(F.collect_list(entry)).alias("found"))
    top = merged.select("query_id", F.posexplode(F.slice(F.array_sort("found"), 1, k)).alias("at", "x"))
    return top.select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("x.i").alias("vec_id"),
        # 0.0 - x, unlike -x, leaves no negative zero
        (F.lit(0.0) - F.col("x.s")).alias("score"),
    )
