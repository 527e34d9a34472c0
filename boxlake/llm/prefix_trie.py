"""A trie of the prefixes that conversations share, built from sorted shards below a skeleton of splitters.

1. A turn is a digest of its role and text and the text's length; a conversation's path is its digests one after another. Texts
   are left behind there.
2. Paths are dealt out by ranges between splitters, taken from a sample. The trie of the splitters' paths, the skeleton, is
   broadcast: a node lies in several shards only if it is a prefix of a splitter, so only skeleton nodes do.
3. Every shard is read once in the order of paths. Nodes outside the skeleton are finished there, as soon as the next path
   leaves them; a shard holds the open nodes and, below each, the finished children that wait for its smallest member. Of a
   skeleton node a shard gives partial sums.
4. Partial sums are added up for each skeleton node and carried up the skeleton, whose size the driver has bounded itself.
   Members that end at one skeleton node come as pieces in ascending order and are hashed as they are read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import packed, rows_of, stored

WIDTH = 16  # bytes of a digest
#: Bytes of paths that one task reads, about; shards dealt to one task; sampled rows for each shard.
TASK_BYTES, SHARDS, SAMPLED = 64 << 20, 4, 20
#: Bytes of paths in the sample, about, and in the skeleton, at most.
SAMPLE_BYTES, SKELETON_BYTES = 64 << 20, 16 << 20
#: Bytes of a piece of member ids.
PIECE = 1 << 16


def opening_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its hundred."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 6).cast("int")


def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id and turns, an array of (turn, digest, chars), of all conversations (conv_id, turn, role, text).

    Turns are in the order of ``turn``, null first; rows of one turn are in the order of their digests. A null role or text is
    empty. Rows without a conv_id are in no conversation. The digests of one conversation, 24 bytes a turn, are one row.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest")
    given = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest, F.length(text).alias("chars"))
    return given.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "chars"))).alias("turns"))


def with_shared_openings(lists: DataFrame, opening: Column, most: int = 5) -> DataFrame:
    """``lists`` with the first ``opening`` (``most`` at most) turns taken from the conversation that begins its hundred."""
    bases = lists.filter("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("first"))
    joined = lists.withColumn("base", F.col("conv_id") - F.col("conv_id") % 100).withColumn("h", opening).join(bases, "base", "left")
    taken = F.when(F.col("first").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("first", F.lit(1), F.col("h")))
    return joined.select("conv_id", F.concat(taken, F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))).alias("turns"))


class Skeleton:
    """The trie of the splitters' paths. Node 0 is the root; parents come before their children."""

    def __init__(self, splitters: list[tuple[bytes, int]], chars: list[list[int]]):
        self.splitters = splitters
        self.below: list[dict[bytes, int]] = [{}]
        self.parent, self.depth, self.chars = [-1], [0], [0]
        for (path, _), sizes in zip(splitters, chars, strict=True):
            at = 0
            for turn, size in enumerate(sizes):
                digest = path[turn * WIDTH : (turn + 1) * WIDTH]
                if digest not in self.below[at]:
                    self.below[at][digest] = len(self.below)
                    self.parent.append(at)
                    self.depth.append(turn + 1)
                    self.chars.append(size)
                    self.below.append({})
                at = self.below[at][digest]

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))


def skeleton(paths: DataFrame, tasks: int) -> Skeleton:
    """Splitters that cut the rows of ``paths`` (conv_id, path, chars) into shards of about equal bytes, and their trie."""
    weight = F.length("path") + 32
    rows, total = paths.agg(F.count("*"), F.sum(weight)).first()
    wanted = tasks * SHARDS
    share = min(1.0, SAMPLED * wanted / max(1, rows), SAMPLE_BYTES / max(1, total or 0))
    sample = paths.filter(F.pmod(F.xxhash64("conv_id"), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else paths
    drawn = sorted((bytes(r["path"]), r["conv_id"], r["chars"]) for r in sample.collect())
    step, held, cut = sum(len(p) + 32 for p, _, _ in drawn) / wanted, 0, []
    for row in drawn:
        if held >= (len(cut) + 1) * step:
            cut.append(row)
        held += len(row[0]) + 32
    while sum(len(p) for p, _, _ in cut) > SKELETON_BYTES:
        cut = cut[1::2]  # fewer, larger shards
    return Skeleton([(p, c) for p, c, _ in cut], [s for _, _, s in cut])


def _common(a: bytes, b: bytes) -> int:
    """Turns at the start that two paths share."""
    most, at = min(len(a), len(b)), 0
    while at < most and a[at : at + WIDTH] == b[at : at + WIDTH]:
        at += WIDTH
    return at // WIDTH


class _Open:
    """A node that may still get members."""

    __slots__ = ("depth", "chars", "n", "least", "kids", "leaves", "saved", "ends", "waiting")

    def __init__(self, depth: int, chars: int):
        self.depth, self.chars, self.n, self.least = depth, chars, 0, None
        self.kids = self.leaves = self.saved = 0
        self.ends, self.waiting = None, []

    def add(self, n: int, least: int) -> None:
        self.n += n
        self.least = least if self.least is None else min(self.least, least)


_NOTHING = hashlib.sha256().hexdigest()
_SCHEMA = pa.schema([
    ("skeleton", pa.int64()), ("shard", pa.int64()), ("piece", pa.int64()), ("ids", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
])
_COLUMNS = "skeleton long, shard long, piece long, ids binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _finish(shard: int, rows: Iterator[tuple], trie: Skeleton) -> Iterator[tuple]:
    """Rows of _SCHEMA for the sorted (conv_id, path, chars) of a shard: nodes (with depth), partial sums, pieces of ids."""
    stack: list[_Open] = []  # open nodes below the skeleton, one path
    line = [0]  # the skeleton nodes above them
    parts: dict[int, _Open] = {0: _Open(0, 0)}
    pieces: dict[int, list] = {}  # skeleton node: number of the next piece, ids in it, their bytes
    last = b""

    def close() -> Iterator[tuple]:
        node = stack.pop()
        leaves, saved = node.leaves if node.kids else 1, node.saved + (node.n - 1) * node.chars
        for depth, least, *rest in node.waiting:
            yield None, None, None, None, depth, least, node.least, *rest
        done = (node.depth, node.least, node.n, node.kids, leaves, saved, node.ends.hexdigest() if node.ends else _NOTHING)
        above = stack[-1] if stack else parts[line[-1]]
        if stack:
            above.waiting.append(done)
        else:
            yield line[-1], None, None, None, node.depth, node.least, None, *done[2:]
        above.add(node.n, node.least)
        above.kids, above.leaves, above.saved = above.kids + 1, above.leaves + leaves, above.saved + saved

    def piece(node: int) -> tuple:
        number, ids, _ = pieces[node]
        pieces[node] = [number + 1, [], 0]
        return node, shard, number, ",".join(ids).encode(), *[None] * 8

    for conv_id, path, chars in rows:
        shared = _common(last, path)
        while stack and stack[-1].depth > shared:
            yield from close()
        del line[shared + 1 :]
        for depth in range(len(line) + len(stack), len(path) // WIDTH + 1):
            below = None if stack else trie.below[line[-1]].get(path[(depth - 1) * WIDTH : depth * WIDTH])
            if below is None:
                stack.append(_Open(depth, chars[depth - 1]))
            else:
                line.append(below)
                parts.setdefault(below, _Open(depth, 0))
        last = path
        (stack[-1] if stack else parts[line[-1]]).add(1, conv_id)
        text = str(conv_id)
        if stack:
            if stack[-1].ends is None:
                stack[-1].ends = hashlib.sha256(text.encode())
            else:
                stack[-1].ends.update(f",{text}".encode())
        else:
            held = pieces.setdefault(line[-1], [0, [], 0])
            held[1].append(text)
            held[2] += len(text) + 1
            if held[2] >= PIECE:
                yield piece(line[-1])
    while stack:
        yield from close()
    for node in pieces:
        if pieces[node][1]:
            yield piece(node)
    for node, part in parts.items():
        yield node, None, None, None, None, part.least, None, part.n, part.kids, part.leaves, part.saved, None


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The digest of all ids of each skeleton node, from its pieces in order, which pass one by one."""
    node, digest = None, None
    for skeleton_node, _, _, ids in rows_of(batches):
        if skeleton_node != node:
            if digest:
                yield node, digest.hexdigest()
            node, digest = skeleton_node, hashlib.sha256(ids)
        else:
            digest.update(b"," + ids)
    if digest:
        yield node, digest.hexdigest()


def _totals(trie: Skeleton, partial: dict[int, tuple]) -> list[tuple]:
    """(skeleton, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens) of every skeleton node."""
    size = len(trie.below)
    least, n, kids, leaves, saved = ([partial[i][k] for i in range(size)] for k in range(5))
    for i in reversed(range(size)):
        kids[i] += len(trie.below[i])
        leaves[i] = leaves[i] if kids[i] else 1
        saved[i] += (n[i] - 1) * trie.chars[i]
        if i:
            up = trie.parent[i]
            least[up] = min(x for x in (least[up], least[i]) if x is not None)
            n[up], leaves[up], saved[up] = n[up] + n[i], leaves[up] + leaves[i], saved[up] + saved[i]
    return [(i, trie.depth[i], least[i], least[trie.parent[i]] if i else None, n[i], kids[i], leaves[i], saved[i]) for i in range(size)]


def prefix_trie(lists: DataFrame, tasks: int | None = None) -> DataFrame:
    """A row for each distinct prefix of the turns of ``lists`` (conv_id, turns with digest and chars), the empty one included.

    Columns: conv_id (smallest member), depth, parent_conv_id (the parent's conv_id; null at the root), n_convs (members),
    n_children, n_leaves (childless nodes in the subtree), saved_tokens (summed over the subtree: members but one, times
    the characters of the last text) and ends_sha256 (of the ids, ascending and comma-joined, of members that end there).
    Members are conversations that start with the prefix; one without turns is a member of the root alone. Each conv_id should
    stand once. Very long conversations give a node a turn. Without conversations there is no row.
    """
    spark = lists.sparkSession
    path = F.unhex(F.array_join(F.col("turns.digest"), "")).alias("path")
    paths = stored(lists.select("conv_id", path, F.col("turns.chars").alias("chars")), "trie-paths")
    if tasks is None:
        size = paths.agg(F.sum(F.length("path") + 32)).first()[0] or 0
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))
    trie = skeleton(paths, tasks)
    sent = spark.sparkContext.broadcast(trie)
    dealt_to = pa.schema([("shard", pa.int64()), ("conv_id", pa.int64()), ("path", pa.binary()), ("chars", pa.list_(pa.int32()))])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv_id, path, chars in rows_of(batches):
            yield sent.value.shard(path, conv_id), conv_id, path, chars

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        shard, rows, ahead = None, rows_of(batches), None
        ahead = next(rows, None)
        while ahead is not None:
            shard = ahead[0]

            def own() -> Iterator[tuple]:
                nonlocal ahead
                while ahead is not None and ahead[0] == shard:
                    yield ahead[1:]
                    ahead = next(rows, None)

            yield from _finish(shard, own(), sent.value)

    dealt = paths.mapInArrow(lambda b: packed(deal(b), dealt_to), "shard long, conv_id long, path binary, chars array<int>")
    dealt = dealt.repartition(tasks, "shard").sortWithinPartitions("shard", "path", "conv_id")
    found = stored(dealt.mapInArrow(lambda b: packed(finish(b), _SCHEMA), _COLUMNS), "trie-nodes")

    partial = found.filter("depth is null and ids is null").groupBy("skeleton").agg(F.min("conv_id"), *[F.sum(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    sums = {r[0]: tuple(r)[1:] for r in partial.collect()}  # a row for each node of the skeleton, which is here already
    totals = spark.createDataFrame(_totals(trie, sums) if sums else [], "skeleton long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long")
    pieces = found.filter("ids is not null").select("skeleton", "shard", "piece", "ids").repartition("skeleton").sortWithinPartitions("skeleton", "shard", "piece")
    ends = pieces.mapInArrow(lambda b: packed(_ends(b), pa.schema([("skeleton", pa.int64()), ("ends_sha256", pa.string())])), "skeleton long, ends_sha256 string")
    above = totals.join(ends, "skeleton", "left").fillna(_NOTHING, "ends_sha256")

    names = F.broadcast(totals.select("skeleton", F.col("conv_id").alias("above")))  # as large as the skeleton
    below = found.filter("depth is not null").join(names, "skeleton", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return below.select(*out).union(above.select(*out))
