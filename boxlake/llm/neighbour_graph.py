"""Approximate nearest neighbours on a graph built by NN-descent.

Equal vectors are one node. A first graph comes from bounded blocks of nodes on the same sides of random hyperplanes.
Then, round by round, the neighbours of a node, in both directions, are joined with their vectors and compared with each
other: a neighbour of a neighbour is often a nearer neighbour. Pairs that were compared before are left out, and only the
best proposals leave a task. Rounds end when hardly any neighbour changes. A query walks the graph greedily: all open nodes of its
beam are joined with their neighbours, unseen ones with their vectors, and the beam keeps the nearest, until none is open.
The whole beam is then measured in doubles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxlake.llm.common import grouped, packed, rows_of, stored
from boxlake.llm.vectors import matrix, sampled, vector_rows

#: Neighbours of a node, and reverse neighbours used with them; nodes that a query's beam holds.
NEIGHBOURS, REVERSE, BEAM = 24, 24, 160
#: NN-descent ends after a round that changed at most this share of all neighbours, and after so many rounds at the latest.
SETTLED, ROUNDS = 0.01, 30
#: First graph: so many sets of blocks, of about so many nodes each.
SETS, BLOCK = 4, 512
_SAMPLE = 4096
_GRAPH = "id long, near binary, far binary, fresh binary, changed int"
_GRAPH_ARROW = pa.schema([("id", pa.int64()), ("near", pa.binary()), ("far", pa.binary()), ("fresh", pa.binary()), ("changed", pa.int32())])
_OFFERS = "id long, near binary, far binary"
_OFFERS_ARROW = pa.schema([("id", pa.int64()), ("near", pa.binary()), ("far", pa.binary())])


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances, good enough to build and walk a graph: of centred vectors, so that those far from the origin keep
    their digits."""
    centre = y.mean(0)
    x, y = x - centre, y - centre
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T), 0)).astype(np.float32)


class _Offers:
    """Proposed neighbours gathered in a task; the best of each node leave it."""

    def __init__(self, keep: int, most: int = 2_000_000):
        self.keep, self.most, self.size, self.parts = keep, most, 0, []

    def add(self, target: np.ndarray, other: np.ndarray, far: np.ndarray) -> None:
        self.parts.append((target, other, far))
        self.size += len(target)

    def full(self) -> bool:
        return self.size >= self.most

    def flush(self) -> Iterator[tuple]:
        if self.size:
            target, other, far = (np.concatenate(c) for c in zip(*self.parts, strict=True))
            order = np.lexsort((other, far, target))
            target, other, far = target[order], other[order], far[order]
            cuts = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
            for a, b in zip(cuts, np.append(cuts[1:], len(target)), strict=True):
                near, first = np.unique(other[a:b], return_index=True)
                best = np.sort(first)[: self.keep] + a
                yield int(target[a]), other[best].tobytes(), far[best].tobytes()
        self.parts, self.size = [], 0


def _nodes(rows: DataFrame) -> DataFrame:
    """id (smallest vec_id), dim and vec of every distinct vector."""
    return rows.groupBy("vec").agg(F.min("vec_id").alias("id"), F.first("dim").alias("dim")).select("id", "dim", "vec")


def _members(rows: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """id and vec_id of the ``most`` smallest vec_ids of every node: no answer needs more of equal vectors."""
    joined = rows.join(nodes.select("id", "vec"), "vec").select("id", "vec_id")
    place = F.row_number().over(Window.partitionBy("id").orderBy("vec_id"))
    return joined.withColumn("place", place).filter(F.col("place") <= most).select("id", "vec_id")


def _first_graph(nodes: DataFrame, count: int, centre: np.ndarray, keep: int, seed: int) -> DataFrame:
    """Offers from blocks: nodes on the same sides of random hyperplanes, dealt out where too many are."""
    bits = max(0, int(np.ceil(np.log2(max(1, count / BLOCK)))))
    chance = np.random.default_rng(seed)
    planes = chance.standard_normal((SETS, bits, len(centre)))
    arrow = pa.schema([("id", pa.int64()), ("vec", pa.binary()), ("block", pa.int64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for node, vec in rows_of(batches):
            x = np.frombuffer(vec, "<f8") - centre
            for s in range(SETS):
                side = 0
                for up in (planes[s] @ x > 0).tolist():
                    side = 2 * side + up
                yield node, vec, s << 40 | side

    placed = stored(nodes.select("id", "vec").mapInArrow(lambda b: packed(place(b), arrow), "id long, vec binary, block long"), "graph-blocks")
    sizes = placed.groupBy("block").agg(F.ceil(F.count("*") / (2 * BLOCK)).alias("parts"))
    dealt = placed.join(sizes, "block").withColumn("part", F.pmod(F.xxhash64("id", "block"), F.col("parts")))
    dealt = dealt.select("block", "part", "id", "vec").repartition("block", "part").sortWithinPartitions("block", "part")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        offers = _Offers(keep)
        for _, rows in grouped(rows_of(batches), 2):
            ids, x = np.array([r[2] for r in rows]), matrix([r[3] for r in rows])
            for begin in range(0, len(ids), 512):
                d = _distances(x[begin : begin + 512], x)
                d[np.arange(len(d)), begin + np.arange(len(d))] = np.inf
                most = min(keep, len(ids) - 1)
                if most:
                    best = np.argpartition(d, most - 1, 1)[:, :most]
                    offers.add(np.repeat(ids[begin : begin + 512], most), ids[best].ravel(), np.take_along_axis(d, best, 1).ravel())
            if offers.full():
                yield from offers.flush()
        yield from offers.flush()

    return dealt.mapInArrow(lambda b: packed(compare(b), _OFFERS_ARROW), _OFFERS)


def _merged(graph: DataFrame | None, offers: DataFrame, keep: int) -> DataFrame:
    """The graph with offers taken in; neighbours that were not there before are marked fresh, and counted as changed."""
    both = offers.select(*[c.split()[0] for c in _OFFERS.split(", ")], F.lit(None).cast("binary").alias("fresh"), F.lit(None).cast("int").alias("changed"))
    both = both if graph is None else graph.union(both)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (node,), rows in grouped(rows_of(batches), 1):
            near = np.concatenate([np.frombuffer(r[1], np.int64) for r in rows])
            far = np.concatenate([np.frombuffer(r[2], np.float32) for r in rows])
            fresh = np.concatenate([np.frombuffer(r[3], np.bool_) if r[3] is not None else np.ones(len(r[1]) // 8, np.bool_) for r in rows])
            order = np.lexsort((fresh, near, far))  # of equal pairs the one seen before stays
            _, first = np.unique(near[order], return_index=True)
            best = order[np.sort(first)[:keep]]
            before = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(r[1], np.int64) for r in rows if r[3] is not None]])
            yield node, near[best].tobytes(), far[best].tobytes(), fresh[best].tobytes(), int((~np.isin(near[best], before)).sum())

    dealt = both.repartition("id").sortWithinPartitions("id")
    return dealt.mapInArrow(lambda b: packed(merge(b), _GRAPH_ARROW), _GRAPH)


def _edges(graph: DataFrame) -> DataFrame:
    """src, dst, fresh and reach (distance of src's farthest neighbour) of every edge."""
    arrow = pa.schema([("src", pa.int64()), ("dst", pa.int64()), ("fresh", pa.bool_()), ("reach", pa.float32())])

    def open_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [np.frombuffer(v, np.int64) for v in batch["near"].to_pylist()]
            size = [len(n) for n in near]
            reach = [np.frombuffer(v, np.float32)[-1] for v in batch["far"].to_pylist()]
            fresh = np.frombuffer(b"".join(batch["fresh"].to_pylist()), np.bool_)
            columns = [np.repeat(batch["id"].to_numpy(), size), np.concatenate(near) if near else np.zeros(0, np.int64), fresh, np.repeat(np.array(reach, np.float32), size)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return graph.filter("length(near) > 0").mapInArrow(open_rows, "src long, dst long, fresh boolean, reach float")


def _both_ways(graph: DataFrame, most_reverse: int) -> DataFrame:
    """src, dst, fresh: edges and a bounded choice of reverse edges of every node."""
    edges = _edges(graph)
    place = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("fresh"), F.xxhash64("src", "dst")))
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "fresh").withColumn("place", place).filter(F.col("place") <= most_reverse)
    return edges.select("src", "dst", "fresh").union(back.drop("place"))


def _descent(graph: DataFrame, nodes: DataFrame, keep: int, reverse: int) -> DataFrame:
    """Offers from comparing the neighbours of every node with each other, if one of the two is fresh there."""
    reach = _edges(graph).groupBy("src").agg(F.max("reach").alias("reach")).withColumnRenamed("src", "dst")
    known = nodes.select(F.col("id").alias("dst"), "vec").join(reach, "dst", "left")
    joined = _both_ways(graph, reverse).groupBy("src", "dst").agg(F.max("fresh").alias("fresh")).join(known, "dst")
    dealt = joined.select("src", "dst", "fresh", "reach", "vec").repartition("src").sortWithinPartitions("src")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        offers = _Offers(keep)
        for _, rows in grouped(rows_of(batches), 1):
            ids, fresh = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
            reach = np.array([np.inf if r[3] is None else r[3] for r in rows], np.float32)
            if not fresh.any() or len(ids) < 2:
                continue
            x = matrix([r[4] for r in rows])
            d = _distances(x, x)
            d[~(fresh[:, None] | fresh[None])] = np.inf
            np.fill_diagonal(d, np.inf)
            i, j = np.nonzero(d < reach[:, None])
            offers.add(ids[i], ids[j], d[i, j])
            if offers.full():
                yield from offers.flush()
        yield from offers.flush()

    return dealt.mapInArrow(lambda b: packed(compare(b), _OFFERS_ARROW), _OFFERS)


def build_graph(nodes: DataFrame, neighbours: int = NEIGHBOURS, reverse: int = REVERSE, rounds: int = ROUNDS, seed: int = 11) -> DataFrame:
    """id, near (neighbour ids), far (squared distances), fresh and changed of every node that has a neighbour.

    ``nodes`` (id, dim, vec) are distinct vectors of one length, already stored. Each round is written to the shared folder;
    there are at most ``rounds``, fewer if the neighbours settle.
    """
    count = nodes.count()
    some = matrix([r["vec"] for r in sampled(nodes.withColumnRenamed("id", "vec_id"), _SAMPLE, "centre").collect()])
    graph = stored(_merged(None, _first_graph(nodes, count, some.mean(0), neighbours, seed), neighbours), "graph")
    for _ in range(rounds):
        graph = stored(_merged(graph, _descent(graph, nodes, neighbours, reverse), neighbours), "graph")
        changed = graph.agg(F.sum("changed") / F.sum(F.length("near") / 8)).first()[0]
        if (changed or 0) <= SETTLED:
            break
    return graph


_BEAM = "query long, qvec binary, ids binary, far binary, open binary"
_BEAM_ARROW = pa.schema([("query", pa.int64()), ("qvec", pa.binary()), ("ids", pa.binary()), ("far", pa.binary()), ("open", pa.binary())])


def _walk(graph: DataFrame, nodes: DataFrame, starts: DataFrame, beam: int, most_steps: int = 50) -> DataFrame:
    """query, ids and far of the beam of every query (query, qvec) that is itself a node of the graph."""
    links = stored(_both_ways(graph, REVERSE).groupBy("src").agg(F.array_distinct(F.flatten(F.collect_list(F.array("dst")))).alias("near")), "graph-links")
    known = nodes.select(F.col("id").alias("cand"), "vec")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (query,), rows in grouped(rows_of(batches), 1):
            state = next((r for r in rows if r[1] is not None), None)
            met = [r for r in rows if r[1] is None]
            ids, far = np.frombuffer(state[2], np.int64), np.frombuffer(state[3], np.float32)
            held = np.zeros(len(ids), np.bool_)  # what was open has been opened in this step
            if met:
                x = matrix([r[6] for r in met])
                d = _distances(np.frombuffer(state[1], "<f8")[None], x)[0]
                ids, far = np.concatenate([ids, [r[5] for r in met]]), np.concatenate([far, d])
                held = np.concatenate([held, np.ones(len(met), np.bool_)])
            best = np.lexsort((ids, far))[:beam]
            yield query, state[1], ids[best].tobytes(), far[best].tobytes(), held[best].tobytes()

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for query, ids, held in rows_of(batches):
            for node in np.frombuffer(ids, np.int64)[np.frombuffer(held, np.bool_)].tolist():
                yield query, node

    pair = pa.schema([("query", pa.int64()), ("src", pa.int64())])
    one = np.ones(1, np.bool_).tobytes()
    state = starts.select("query", "qvec", F.expr("cast(null as binary)").alias("ids"), F.lit(np.zeros(1, np.float32).tobytes()).alias("far"), F.lit(one).alias("open"))
    first = pa.schema([*_BEAM_ARROW])

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for query, qvec, _, far, held in rows_of(batches):
            yield query, qvec, np.array([query], np.int64).tobytes(), far, held

    state = stored(state.mapInArrow(lambda b: packed(begin(b), first), _BEAM), "walk")
    seen = state.select("query", F.col("query").alias("cand"))
    for _ in range(most_steps):
        frontier = state.select("query", "ids", "open").mapInArrow(lambda b: packed(opened(b), pair), "query long, src long")
        met = frontier.join(links, "src").select("query", F.explode("near").alias("cand")).distinct()
        new = stored(met.join(seen, ["query", "cand"], "left_anti"), "walk-seen")
        if new.isEmpty():
            break
        seen = seen.union(new)
        arrived = new.join(known, "cand").select("query", *[F.lit(None).cast("binary").alias(c) for c in ("qvec", "ids", "far", "open")], "cand", "vec")
        both = state.select("*", F.lit(None).cast("long").alias("cand"), F.lit(None).cast("binary").alias("vec")).union(arrived)
        dealt = both.repartition("query").sortWithinPartitions("query")
        state = stored(dealt.mapInArrow(lambda b: packed(merge(b), _BEAM_ARROW), _BEAM), "walk")
    return state


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, neighbours: int = NEIGHBOURS, rounds: int = ROUNDS, beam: int = BEAM) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (Euclidean distance) of the nearest found for rows where ``is_query`` holds.

    ``vectors`` has vec_id and embedding; other columns are ignored, and ``is_query`` may use vec_id only. Distances are
    computed in doubles on the original vectors; ties go to the smaller vec_id. A query is no candidate of its own. Null,
    empty and zero vectors and those with a null or non-finite component take no part. Vectors of other lengths than the most
    frequent one have a graph each. Equal vectors are found together, whatever their number. Fewer than k candidates give
    fewer rows, an empty table none. A repeated vec_id counts once for each of its vectors.
    """
    rows = stored(vector_rows(vectors, zeros=False).distinct(), "graph-vectors")
    spark, schema = vectors.sparkSession, "query_id long, rank int, vec_id long, score double"
    answers = [
        _nearest(rows.filter(F.col("dim") == r["dim"]), is_query, k, neighbours, rounds, beam)
        for r in rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").collect()
    ]
    out = spark.createDataFrame([], schema)
    for a in answers:
        out = out.union(a)
    return out


def _nearest(rows: DataFrame, is_query: Column, k: int, neighbours: int, rounds: int, beam: int) -> DataFrame:
    nodes = stored(_nodes(rows), "graph-nodes")
    graph = build_graph(nodes, neighbours, rounds=rounds)
    members = stored(_members(rows, nodes, k + 1), "graph-members")
    asked = rows.filter(is_query).join(nodes.select("id", "vec"), "vec").select(F.col("vec_id").alias("query_id"), F.col("id").alias("query"), F.col("vec").alias("qvec"))
    asked = stored(asked, "graph-queries")
    state = _walk(graph, nodes, asked.select("query", "qvec").distinct(), max(beam, 2 * k))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for query, ids in rows_of(batches):
            for node in np.frombuffer(ids, np.int64).tolist():
                yield query, node

    pair = pa.schema([("query", pa.int64()), ("id", pa.int64())])
    found = state.select("query", "ids").mapInArrow(lambda b: packed(best(b), pair), "query long, id long")
    measured = found.join(nodes.select("id", "vec"), "id").join(state.select("query", "qvec"), "query")
    scored = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for query, node, vec, qvec in rows_of(batches):
            gap = np.frombuffer(vec, "<f8") - np.frombuffer(qvec, "<f8")
            yield query, node, float(np.sqrt((gap * gap).sum()))

    scores = measured.select("query", "id", "vec", "qvec").mapInArrow(lambda b: packed(measure(b), scored), "query long, id long, score double")
    spread = asked.select("query_id", "query").join(scores.join(members, "id"), "query").filter("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return spread.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
