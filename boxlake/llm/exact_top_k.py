"""Exact top-k by integer inner product, with candidates ruled out through a table of distances to pivots.

|q - x| is at least |d(q, p) - d(x, p)| for every pivot p, and the inner product is half of |q|^2 + |x|^2 - |q - x|^2: the
largest of the differences over many pivots bounds a candidate's score from above.

1. Candidates are placed with the nearest of the first pivots, in blocks of bounded size. Of each block the least and the largest distance
   to every pivot are kept.
2. Every query meets one block of its own pivot first. Its k-th best score there is what all others have to reach.
3. A query goes on to the blocks whose bound, from their ranges of distances, reaches that score. In a block the candidates
   with the best bounds are evaluated first, and then all those whose own bound reaches the k-th best score by then: bounds
   of all others are below it, so the search has stopped exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxlake.llm.common import ending, packed, rows_of, stored
from boxlake.llm.vectors import matrix, sampled, vector_rows

#: Pivots are picked from a sample of so many vectors; nothing but speed depends on them.
PIVOTS, PIVOT_SAMPLE = 24, 2000
#: Rows of a block of candidates, on average, and of the queries that meet it in one task.
CANDIDATES, QUERIES = 4096, 4096
SCALE = 64
_SLICE = 256  # queries that are bounded together


def pick_pivots(x: np.ndarray, count: int) -> np.ndarray:
    """Rows of ``x`` far from each other: each next one is farthest from those picked before."""
    if not len(x):
        return x
    picked = [0]
    nearest = np.linalg.norm(x - x[0], axis=1)
    while len(picked) < min(count, len(x)):
        picked.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, np.linalg.norm(x - x[picked[-1]], axis=1))
    return x[picked]


def _integers(held: list[bytes]) -> np.ndarray:
    return np.floor(SCALE * matrix(held))


def _pivot_table(rows: DataFrame, pivots: np.ndarray, cells: int) -> DataFrame:
    """vec_id, dim, vec, the distances (far) of its integer form to the pivots of its length, and the number (cell) of the
    nearest of the first ``cells``."""
    arrow = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("vec", pa.binary()), ("far", pa.binary()), ("cell", pa.int32())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for vec_id, dim, vec in rows_of(batches):
            same = pivots if pivots.shape[1] == dim else np.zeros((0, dim))
            far = np.linalg.norm(same - _integers([vec]), axis=1)
            yield vec_id, dim, vec, far.tobytes(), int(far[:cells].argmin()) if len(far) else -1

    return rows.mapInArrow(lambda b: packed(measure(b), arrow), "vec_id long, dim int, vec binary, far binary, cell int")


def _above(value: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``value``, with what rounding may have taken off; ``size`` is the sum of squares behind it."""
    return value + 1e-9 * (np.abs(value) + size) + 1e-6


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit integers; in doubles where every partial sum is exact in them."""
    most = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[-1]
    return (q @ x.T).astype(np.int64) if most < 2**53 else q.astype(np.int64) @ x.astype(np.int64).T


def best_in_block(
    q: np.ndarray, q_ids: np.ndarray, q_far: np.ndarray, floor: np.ndarray, x: np.ndarray, ids: np.ndarray, far: np.ndarray, k: int
) -> tuple[list[tuple[int, int, int]], int]:
    """(query, candidate, score) of the k best candidates of each query with a score of ``floor`` at least; pairs evaluated."""
    found, evaluated = [], 0
    square = (x * x).sum(1)
    for at in range(0, len(q), _SLICE):
        some, own = q[at : at + _SLICE], q_ids[at : at + _SLICE]
        low = np.zeros((len(some), len(x)))
        for pivot in range(far.shape[1]):
            np.maximum(low, np.abs(q_far[at : at + _SLICE, pivot, None] - far[None, :, pivot]), out=low)
        size = square[None, :] + (some * some).sum(1)[:, None]
        bound = _above((size - low * low) / 2, size)
        bound[np.isnan(bound)] = np.inf  # squares beyond the range of doubles rule nothing out
        bound[own[:, None] == ids[None, :]] = -np.inf
        need = floor[at : at + _SLICE].astype(np.float64)
        need = np.where(np.abs(need) < 2**53, need, np.nextafter(need, -np.inf))
        first = np.argpartition(-bound, min(2 * k, len(x)) - 1, axis=1)[:, : 2 * k]
        for i in range(len(some)):
            tried = first[i][bound[i, first[i]] >= need[i]]
            scores = _scores(some[i], x[tried])
            if len(tried) >= k:
                reached = float(np.partition(scores, len(scores) - k)[len(scores) - k])
                need[i] = max(need[i], reached if abs(reached) < 2**53 else np.nextafter(reached, -np.inf))
            evaluated += len(tried)
        open_ones = bound >= need[:, None]
        count = open_ones.sum(1)
        if count.sum() * 4 > open_ones.size:  # one product for all is quicker than many for a few
            whole = _scores(some, x)
            evaluated += open_ones.size
        else:
            whole = None
            evaluated += int(count.sum())
        for i in np.flatnonzero(count).tolist():
            left = np.flatnonzero(open_ones[i])
            scores = whole[i, left] if whole is not None else _scores(some[i], x[left])
            left, scores = left[scores >= need[i]], scores[scores >= need[i]]
            keep = np.lexsort((ids[left], -scores))[:k]
            found += zip([int(own[i])] * len(keep), ids[left[keep]].tolist(), scores[keep].tolist(), strict=True)
    return found, evaluated


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _meet(asking: DataFrame, placed: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id and score of what ``asking`` (vec_id, dim, vec, far, part, floor, block) finds in the blocks of ``placed``.

    Queries of a block go in parts, each with a copy of the block.
    """
    parts = asking.select("block", "part").distinct().toDF("asked_block", "asked_part")
    given = placed.join(parts, F.col("block") == F.col("asked_block")).select("block", F.col("asked_part").alias("part"), "vec_id", "vec", "far")

    def meet(asked: pa.Table, block: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if asked.num_rows and block.num_rows:
            x, q = _integers(block["vec"].to_pylist()), _integers(asked["vec"].to_pylist())
            far, q_far = matrix(block["far"].to_pylist()), matrix(asked["far"].to_pylist())
            found, _ = best_in_block(q, asked["vec_id"].to_numpy(), q_far, asked["floor"].to_numpy(), x, block["vec_id"].to_numpy(), far, k)
        table = pa.table([pa.array(c, pa.int64()) for c in (zip(*found, strict=True) if found else ([], [], []))], schema=_FOUND)
        return pa.Table.from_batches(ending(table.to_batches()), _FOUND)

    left = asking.select("block", "part", "vec_id", "vec", "far", "floor").groupBy("block", "part")
    return left.cogroup(given.groupBy("block", "part")).applyInArrow(meet, "query_id long, vec_id long, score long")


def _ranges(placed: DataFrame) -> DataFrame:
    """block, dim, and of its vectors the least and largest distance to each pivot and the largest square (bound, as bytes)."""

    def summed(rows: pa.Table) -> pa.Table:
        far, x = matrix(rows["far"].to_pylist()), _integers(rows["vec"].to_pylist())
        bound = np.concatenate([far.min(0), far.max(0), [(x * x).sum(1).max()]]).astype("<f8").tobytes()
        return pa.table({"block": rows["block"][:1], "dim": rows["dim"][:1], "bound": pa.array([bound], pa.binary())})

    return placed.select("block", "dim", "far", "vec").groupBy("block").applyInArrow(summed, "block long, dim int, bound binary")


def _blocks_to_ask(queries: DataFrame, ranges: DataFrame, most_bytes: int) -> DataFrame:
    """``queries`` (with floor and first, the block they have met) once for every other block whose bound reaches their floor."""
    blocks = {}
    total = ranges.agg(F.sum(F.length("bound") + 24)).first()[0] or 0
    if total > most_bytes:
        # too many blocks for every task: the floor is tested in the blocks alone
        listed = ranges.groupBy("dim").agg(F.collect_list("block").alias("blocks"))
        return queries.join(listed, "dim").withColumn("block", F.explode("blocks")).drop("blocks").filter("block <> first")
    for r in ranges.collect():
        blocks.setdefault(r["dim"], []).append((r["block"], np.frombuffer(r["bound"], "<f8")))
    tables = {dim: (np.array([b for b, _ in of]), np.stack([v for _, v in of])) for dim, of in blocks.items()}
    sent = queries.sparkSession.sparkContext.broadcast(tables)
    arrow = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("others", pa.list_(pa.int64()))])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for vec_id, dim, vec, far, floor, first in rows_of(batches):
            numbers, bounds = sent.value[dim]
            q_far, q, pivots = np.frombuffer(far, "<f8"), _integers([vec])[0], (bounds.shape[1] - 1) // 2
            low = np.maximum(np.maximum(bounds[:, :pivots] - q_far, q_far - bounds[:, pivots : 2 * pivots]), 0).max(1, initial=0)
            size = bounds[:, -1] + q @ q
            reached = _above((size - low * low) / 2, size) >= floor
            yield vec_id, dim, numbers[reached & (numbers != first)]

    chosen = queries.select("vec_id", "dim", "vec", "far", "floor", "first").mapInArrow(lambda b: packed(choose(b), arrow), "vec_id long, dim int, others array<long>")
    return queries.join(chosen, ["vec_id", "dim"]).withColumn("block", F.explode("others")).drop("others")


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, pivots: int = PIVOTS, most_bytes: int = 32 << 20) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best candidates for each row where ``is_query`` holds.

    ``vectors`` has vec_id and embedding; other columns are ignored, and ``is_query`` may use vec_id only. The score is the
    inner product of floor(64 * component), as a 64-bit integer; ties go to the smaller vec_id. A query is no candidate of
    its own; nor are rows that repeat its vec_id. Vectors that are null, empty or hold a null or non-finite component take
    no part; a query and a candidate of different lengths are not compared. Fewer than k candidates give fewer rows, an empty
    table none. Repeated rows are candidates each; a repeated query is answered once. ``most_bytes`` bounds what is
    broadcast about blocks.
    """
    rows = stored(vector_rows(vectors), "pivot-vectors")
    dims = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if dims is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    chosen = sampled(rows.filter(F.col("dim") == dims["dim"]), PIVOT_SAMPLE, "pivots").select("vec").collect()
    cells = max(1, -(-rows.count() // CANDIDATES))
    table = stored(_pivot_table(rows, pick_pivots(_integers([r["vec"] for r in chosen]), pivots), cells), "pivot-table")
    sizes = table.groupBy("dim", "cell").agg(F.ceil(F.count("*") / CANDIDATES).cast("int").alias("pieces"))  # a row a length and pivot
    cell = F.broadcast(sizes)
    block = F.xxhash64("dim", "cell", F.pmod(F.xxhash64("vec_id", "vec"), F.col("pieces"))).alias("block")
    placed = stored(table.join(cell, ["dim", "cell"]).select("vec_id", "dim", "vec", "far", block), "pivot-blocks")

    queries = table.filter(is_query).dropDuplicates(["vec_id", "dim"])
    part = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-queries.count() // QUERIES)))).alias("part")
    first = F.xxhash64("dim", "cell", F.pmod(F.xxhash64("vec_id", "vec"), F.col("pieces")))
    nothing = F.lit(-(2**63)).cast("long")
    asking = queries.join(cell, ["dim", "cell"]).select("vec_id", "dim", "vec", "far", part, nothing.alias("floor"), first.alias("block"))
    near = stored(_meet(stored(asking, "pivot-queries"), placed, k), "pivot-first")
    kth = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    floors = near.withColumn("n", F.row_number().over(kth)).filter(F.col("n") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("reached"))
    known = asking.join(floors, "vec_id", "left").select("vec_id", "dim", "vec", "far", "part", F.coalesce("reached", "floor").alias("floor"), F.col("block").alias("first"))
    later = _blocks_to_ask(stored(known, "pivot-floors"), stored(_ranges(placed), "pivot-ranges"), most_bytes)
    met = near.union(_meet(later, placed, k))
    ranked = met.withColumn("rank", F.row_number().over(kth)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
