"""Exact top-k search by term-at-a-time accumulation.

A component is a term, a vector's value there its weight. Candidates are dealt into blocks,
queries too, and every block of queries meets every block of candidates once. In a meeting
the candidates are an inverted index; the postings of each term of a query, times its weight
in the query, are added into a dense array of scores, from which the k best are selected by
partition. The best of all blocks are merged per query.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtide.llm.common import ship, spread, written

BLOCK_ROWS = 65_536
QUERY_ROWS = 4_096


def weights(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, w): floor(scale * x) of each component. Rows with a null id, a null vector or a
    null or non-finite component are left out."""
    sound = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return vectors.where(sound).where(finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("w"),
    )


def postings(rows: list[list[int]]) -> list[tuple]:
    """Per term: the rows that hold it (a full slice where all do) and their weights."""
    size = max((len(r) for r in rows), default=0)
    if all(len(r) == size for r in rows):
        matrix = np.array(rows, "int64").reshape(len(rows), size)
    else:
        matrix = np.zeros((len(rows), size), "int64")
        for i, r in enumerate(rows):
            matrix[i, : len(r)] = r
    index = []
    for column in np.ascontiguousarray(matrix.T):
        at = np.flatnonzero(column)
        index.append((slice(None), column) if len(at) == len(column) else (at, column[at]))
    return index


def best_in_block(index: list[tuple], ids: np.ndarray, query: list[int], own: int, k: int):
    """The k best of a block for one query, ties to smaller ids; rows with the query's own id are out."""
    scores = np.zeros(len(ids), "int64")
    for term, weight in enumerate(query[: len(index)]):
        if weight:
            rows, values = index[term]
            scores[rows] += weight * values
    others = np.flatnonzero(ids != own)
    if len(others) > k:
        kept = scores[others]
        bound = np.partition(kept, len(kept) - k)[len(kept) - k]
        others = others[kept >= bound]
    order = np.lexsort((ids[others], -scores[others]))[:k]
    return ids[others[order]], scores[others[order]]


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024) -> DataFrame:
    """For each row of ``queries`` the k rows of ``vectors`` (both vec_id, embedding) with the
    highest integer inner product: query_id, rank (from 1), vec_id, score; ties to smaller vec_id.

    Vectors that are null or hold null or non-finite components take no part; shorter vectors
    count as ending in zeros. A query's own rows are those with its id. Repeated rows are
    candidates each; a query that repeats is asked once. Fewer candidates give fewer rows.
    """
    ship(vectors.sparkSession)
    rows = written(weights(vectors, scale), "weights")
    asked = written(weights(queries, scale).distinct().withColumn("q", F.xxhash64("w")), "asked")
    n_blocks = max(spread(vectors.sparkSession), math.ceil(rows.count() / BLOCK_ROWS))
    n_query_blocks = max(1, math.ceil(asked.count() / QUERY_ROWS))
    left = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "w"), F.lit(n_blocks))).withColumn(
        "query_block", F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1)))
    )
    right = asked.withColumn("query_block", F.pmod(F.xxhash64("vec_id"), F.lit(n_query_blocks)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long")))
    )
    left = left.withColumn("block", F.col("block").cast("long"))

    def meet(candidates: pa.Table, wanted: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "q": [], "vec_id": [], "score": []}
        if candidates.num_rows and wanted.num_rows:
            ids = candidates["vec_id"].to_numpy()
            index = postings(candidates["w"].to_pylist())
            for query, q, w in zip(wanted["vec_id"].to_pylist(), wanted["q"].to_pylist(), wanted["w"].to_pylist(), strict=True):
                found, scores = best_in_block(index, ids, w, query, k)
                out["query_id"] += [query] * len(found)
                out["q"] += [q] * len(found)
                out["vec_id"] += found.tolist()
                out["score"] += scores.tolist()
        return pa.table({name: pa.array(v, pa.int64()) for name, v in out.items()})

    met = left.groupBy("query_block", "block").cogroup(right.groupBy("query_block", "block"))
    best = met.applyInArrow(meet, "query_id long, q long, vec_id long, score long")
    order = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
