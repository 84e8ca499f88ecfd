"""Operator 4: exact top-k search by inner product, branch and bound over dimension blocks.

Vectors are held in *chunks* of bounded size in vertical layout (one row of
numbers per dimension). For a block of queries a chunk is scanned dimension
block by dimension block: partial inner products are accumulated for the
candidates that survive, and after each block a candidate is dropped when its
partial product plus the largest product its remaining dimensions can still
give (Cauchy-Schwarz on the remaining mass of query and candidate) is below
the k-th best score known for the query. Survivors are compacted, so later
blocks touch fewer and fewer columns.

Plan: candidates are hashed on their id into chunks (never by value, so a hot
vector cannot fill one chunk), queries likewise into blocks of as many rows;
every block meets every chunk, the one sanctioned "query set against all rows,
in blocks"; each meeting returns its k best per query and a grouped window
merges them. The counts of both follow the row counts, so both sides of a
task's memory are bounded by about ``chunk_rows``; ``QUERY_ROWS`` of a block are scanned together.

Edge cases: vectors that are null or hold null or non-finite components take
no part; vectors of different lengths are compared over the longer one's
dimensions with zeros for the missing ones; an empty table gives no rows;
duplicate ids are separate rows: two queries of one id have a list each, and a
query skips every row of its own id. Scores are exact: products that could
leave 64 bits are summed as Python integers, and a best score beyond 64 bits
stops the job. Further columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written

#: Candidates per chunk (and queries per block), and queries scanned together (bounds of a task's memory).
CHUNK_ROWS, QUERY_ROWS = 32_768, 256
#: Dimensions accumulated between two pruning steps.
DIM_BLOCK = 16

_RESULT = "row long, query_id long, vec_id long, score long"


def quantised(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of every component, as double arithmetic; null if any component is unusable.
    A component that leaves 64 bits stops the job."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf"))))
    fits = F.forall(vector, lambda x: F.abs(x.cast("double") * F.lit(scale)) < F.lit(2.0**63))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("long"))
    whole = F.when(fits, whole).otherwise(F.raise_error(F.lit("a component is too large for 64 bits")))
    return F.when(vector.isNotNull() & F.coalesce(ok, F.lit(False)), whole)


def _vertical(vectors: pd.Series, dims: int) -> np.ndarray:
    """dims x rows matrix of integers; shorter vectors are padded with zeros."""
    out = np.zeros((dims, len(vectors)), dtype=np.int64)
    for j, v in enumerate(vectors):
        out[: len(v), j] = v
    return out


def _exact_kind(columns: np.ndarray, q: np.ndarray) -> type:
    """float64 where every partial sum is an integer below 2**53 (so exact), int64 below 2**63, else Python's integers."""
    largest = [max(abs(int(m.max())), abs(int(m.min()))) if m.size else 0 for m in (columns, q)]
    bound = largest[0] * largest[1] * max(1, len(columns))
    return np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object


def _remaining_mass(m: np.ndarray, edges: list[int]) -> list[np.ndarray]:
    """For each block edge, the Euclidean norm of every column from that dimension on."""
    squares = m.astype(np.float64) ** 2
    return [np.sqrt(squares[e:].sum(axis=0)) for e in edges]


def _scan(chunk: np.ndarray, ids: np.ndarray, mass: list[np.ndarray], edges: list[int],
          query: np.ndarray, query_mass: list[float], query_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best columns of the chunk for one query (ties to smaller ids)."""
    alive = np.flatnonzero(ids != query_id)
    part = np.zeros(len(alive), dtype=chunk.dtype)
    for b, begin in enumerate(edges[:-1]):
        end = edges[b + 1]
        part = part + query[begin:end] @ chunk[begin:end].take(alive, axis=1)
        if len(alive) <= k or end == edges[-1]:
            continue
        rest = mass[b + 1][alive] * query_mass[b + 1]
        # the k-th best guaranteed score so far; the slack covers the rounding of the float bounds
        near = part.astype(np.float64)
        floor = np.partition(near - rest, len(part) - k)[len(part) - k]
        keep = near + rest + (1.0 + 1e-9 * (np.abs(near) + rest + abs(floor))) >= floor
        alive, part = alive[keep], part[keep]
    order = np.lexsort((ids[alive], -part))[:k]
    return ids[alive][order], part[order]


def _search(k: int):
    def search(key, queries: pd.DataFrame, chunk: pd.DataFrame) -> pd.DataFrame:
        out = {"row": [], "query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(chunk):
            dims = max(max(map(len, queries["q"])), max(map(len, chunk["q"])))
            edges = [*range(0, dims, DIM_BLOCK), dims] if dims else [0, 0]
            ids = chunk["vec_id"].to_numpy()
            columns = _vertical(chunk["q"], dims)
            mass = _remaining_mass(columns, edges)
            for at in range(0, len(queries), QUERY_ROWS):
                block = queries.iloc[at : at + QUERY_ROWS]
                q = _vertical(block["q"], dims)
                q_mass = _remaining_mass(q, edges)
                kind = _exact_kind(columns, q)
                vertical, q = columns.astype(kind, copy=False), q.astype(kind, copy=False)
                for j, (row, qid) in enumerate(zip(block["row"].to_numpy(), block["vec_id"].to_numpy())):
                    found, scores = _scan(vertical, ids, mass, edges, q[:, j], [m[j] for m in q_mass], qid, k)
                    if kind is object and any(abs(x) >> 63 for x in scores):
                        raise OverflowError(f"a score of query {qid} is beyond 64 bits")
                    out["row"].append(np.full(len(found), row))
                    out["query_id"].append(np.full(len(found), qid))
                    out["vec_id"].append(found)
                    out["score"].append(scores.astype(np.int64))
        return pd.DataFrame({c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in out.items()})
    return search


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The ``k`` largest integer inner products of every query.

    Both frames: ``vec_id`` long, ``q`` array<long> (null: takes no part).
    Returns query_id, rank, vec_id, score; a list for every row of ``queries``.
    """
    candidates = candidates.where(F.col("q").isNotNull() & F.col("vec_id").isNotNull()).select("vec_id", "q")
    queries = queries.where(F.col("q").isNotNull() & F.col("vec_id").isNotNull()).select("vec_id", "q")
    # rows of one id are told apart by a number that is written down, so it stays the same in every task
    queries = written(queries.withColumn("row", F.monotonically_increasing_id()), "topk-queries")
    chunks = max(1, -(-candidates.count() // chunk_rows))
    chunked = candidates.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int"))
    parts = max(1, -(-queries.count() // chunk_rows))
    blocked = queries.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int"))
    # every block of queries meets every chunk once
    spread = blocked.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    met = chunked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    found = spread.groupBy("part", "chunk").cogroup(met.groupBy("part", "chunk")).applyInPandas(_search(k), _RESULT)
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.asc("vec_id"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op4_exact_top_k(spark, sf_dir: str) -> DataFrame:
    """Every fiftieth vector against all others, 5 best by quantised inner product."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", quantised(F.col("embedding")).alias("q"))
    return top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors, k=5)


ORACLE_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (
  SELECT a.row, a.vec_id AS query_id, b.vec_id,
         CAST(list_sum([COALESCE(p[1], 0) * COALESCE(p[2], 0) FOR p IN list_zip(a.q, b.q)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, COALESCE(score, 0) AS score FROM r WHERE rank <= 5
"""
