"""Exact top-k search by inner product: vectors by descending length, SVD-rotated partial sums, residual bounds.

Components become floor(scale * x). Queries and candidates are cut into blocks by a hash of their ids; a task gets one
block of each and works through the candidates in order of descending length. After the first run of candidates each
query has a k-th best score. A later run is skipped for a query whose length times the run's greatest can't reach it;
otherwise the leading rotated dimensions are multiplied, and Cauchy-Schwarz bounds the rest by the product of the
residual lengths. Only pairs whose bound reaches the k-th best get the full product, in whole numbers. A task
returns k rows per query at most, and a window over those gives the result.

The rotation is fitted on about `FIT_ROWS` vectors chosen by id hash; it changes what is pruned, never the result.

Defined cases: vectors that are null or hold null or non-finite components, and rows with a null id, take no part;
missing components of shorter vectors count as 0; every row with another id than the query's is a candidate, and the
rows of a repeated query id share one ranking; fewer candidates than k give fewer rows; ties go to the smaller id; scores beyond 63 bits raise; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridwarden.llm.common import stored, table

K = 20
SCALE = 64
QUERY_BLOCK, CANDIDATE_BLOCK, RUN = 4096, 8192, 512
FIT_ROWS = 20_000
#: Whole numbers up to here are exact as doubles.
EXACT = 2.0**53


def scaled(vectors: DataFrame, scale: int = SCALE, k: int = K) -> DataFrame:
    """(vec_id, ints) of the vectors that take part; of equal rows, k are as good as all."""
    usable = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    ints = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    taking_part = vectors.where(F.col("vec_id").isNotNull() & F.coalesce(usable, F.lit(False)))
    counted = taking_part.select("vec_id", ints.alias("ints")).groupBy("vec_id", "ints").count()
    copies = F.sequence(F.lit(1), F.least(F.col("count"), F.lit(k)).cast("int"))
    return counted.select("vec_id", "ints", F.explode(copies)).select("vec_id", "ints")


def rotation_of(vectors: DataFrame, rows: int, dimensions: int) -> np.ndarray:
    """Right singular vectors of a bounded sample, the strongest first."""
    share = max(1, rows // FIT_ROWS)
    sample = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(share)) == 0).select("ints").limit(2 * FIT_ROWS).collect()
    held = np.zeros((len(sample), dimensions))
    for place, row in enumerate(sample):
        held[place, : len(row.ints)] = row.ints
    _, axes = np.linalg.eigh(held.T @ held)
    return axes[:, ::-1]


def matrix(lists: list[list[int]], dimensions: int) -> np.ndarray:
    out = np.zeros((len(lists), dimensions), np.int64)
    for row, values in enumerate(lists):
        out[row, : len(values)] = values
    return out


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of all rows with all rows, exact."""
    lengths = [np.sqrt((m.astype(np.float64) ** 2).sum(axis=1).max(initial=0)) for m in (left, right)]
    if lengths[0] * lengths[1] < EXACT / 4:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    if lengths[0] * lengths[1] >= 2.0**62:
        raise OverflowError("scores beyond 63 bits")
    return left @ right.T


def best_of(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best triples of each query, ordered by query, score and id."""
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    first = np.searchsorted(query, query)
    keep = np.arange(len(query)) - first < k
    return query[keep], ids[keep], scores[keep]


def search(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, axes: np.ndarray, k: int):
    """(query index, candidate id, score) of each query's k best candidates."""
    lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    order = np.lexsort((ids, -lengths))
    vectors, ids, lengths = vectors[order], ids[order], lengths[order]
    head = max(1, axes.shape[0] // 4)
    turned, turned_q = vectors @ axes, queries @ axes
    rest = np.sqrt((turned[:, head:] ** 2).sum(axis=1))
    rest_q = np.sqrt((turned_q[:, head:] ** 2).sum(axis=1))
    own = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    at_least = np.full(len(queries), -np.inf)
    query = np.empty(0, np.int64)
    found, scores = np.empty(0, ids.dtype), np.empty(0, np.int64)
    for at in range(0, len(vectors), RUN):
        run = slice(at, at + RUN)
        slack = 1e-9 * (1 + own * lengths[at])  # rounding of the rotated sums
        open_queries = np.flatnonzero(own * lengths[at] + slack >= at_least)
        if not len(open_queries):
            break
        if at == 0:
            full = products(queries, vectors[run])
            same = query_ids[:, None] == ids[None, run]
            ranked = np.where(same, np.iinfo(np.int64).min, full)
            if ranked.shape[1] > k:
                kth = np.partition(ranked, -k, axis=1)[:, -k]
                new_q, new_c = np.nonzero((ranked >= kth[:, None]) & ~same)
            else:
                new_q, new_c = np.nonzero(~same)
            new_scores = full[new_q, new_c]
        else:
            bound = turned_q[open_queries, :head] @ turned[run, :head].T
            bound += np.multiply.outer(rest_q[open_queries], rest[run])
            bound += slack[open_queries, None]
            new_q, new_c = np.nonzero(bound >= at_least[open_queries, None])
            if not len(new_q):
                continue
            if len(new_q) * 8 > bound.size:  # dense enough for one matrix product
                new_scores = products(queries[open_queries], vectors[run])[new_q, new_c]
                new_q = open_queries[new_q]
            else:
                new_q = open_queries[new_q]
                products(queries[new_q[:1]], vectors[at : at + 1])  # the lengths' check
                new_scores = np.einsum("ij,ij->i", queries[new_q], vectors[at + new_c])
            kept = (new_scores >= at_least[new_q]) & (query_ids[new_q] != ids[at + new_c])
            new_q, new_c, new_scores = new_q[kept], new_c[kept], new_scores[kept]
        query, found, scores = best_of(
            np.concatenate([query, new_q]), np.concatenate([found, ids[at + new_c]]), np.concatenate([scores, new_scores]), k
        )
        begins = np.searchsorted(query, np.arange(len(queries) + 1))
        complete = np.flatnonzero(np.diff(begins) == k)
        at_least[complete] = scores[begins[complete] + k - 1]
    return query, found, scores


def top_k(vectors: DataFrame, is_query: str, k: int = K, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the greatest inner product for each row that `is_query` holds for."""
    held = stored(scaled(vectors, scale, k), "vectors")
    facts = held.agg(F.count("*"), F.count(F.when(F.expr(is_query), 1)), F.max(F.size("ints"))).first()
    rows, n_queries, dimensions = facts[0], facts[1], max(facts[2] or 1, 1)
    axes = rotation_of(held, rows, dimensions)
    query_blocks, blocks = max(1, math.ceil(n_queries / QUERY_BLOCK)), max(1, math.ceil(rows / CANDIDATE_BLOCK))
    hashed = F.xxhash64("vec_id", "ints")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    of_query = held.where(is_query).select(
        F.pmod(hashed, F.lit(query_blocks)).cast("int").alias("i"), every(blocks).alias("j"), F.lit(0).alias("kind"), "vec_id", "ints"
    )
    of_rows = held.select(
        every(query_blocks).alias("i"), F.pmod(hashed, F.lit(blocks)).cast("int").alias("j"), F.lit(1).alias("kind"), "vec_id", "ints"
    )
    tasks = of_query.unionByName(of_rows).repartition("i", "j").sortWithinPartitions("i", "j", "kind")

    def searched(rows: list[tuple]) -> pa.RecordBatch | None:
        queries, others = [r for r in rows if r[2] == 0], [r for r in rows if r[2] == 1]
        if not queries or not others:
            return None
        query_ids = np.array([r[3] for r in queries], np.int64)
        in_query, ids, scores = search(
            matrix([r[4] for r in queries], dimensions), query_ids,
            matrix([r[4] for r in others], dimensions), np.array([r[3] for r in others], np.int64), axes, k,
        )
        return pa.RecordBatch.from_arrays(
            [pa.array(query_ids[in_query]), pa.array(ids), pa.array(scores)], ["query_id", "vec_id", "score"]
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, gathered = None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                if row[:2] != task:
                    if gathered and (out := searched(gathered)):
                        yield out
                    task, gathered = row[:2], []
                gathered.append(row)
        if gathered and (out := searched(gathered)):
            yield out

    found = tasks.mapInArrow(work, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id % 20 = 0")


ORACLE = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as e from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
)
select query_id, rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from scored
) where rank <= 20
"""
