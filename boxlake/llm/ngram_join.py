"""Exact Jaccard join on sets of word n-grams through a token-group matrix.

1. Every text becomes a set of shingle hashes, seen only inside a task. Equal sets are one class. A sketch of fixed
   size counts shingles over all texts; it orders them from rare to frequent.
2. Classes are partitioned into groups of similar texts: of its MinHash keys each class takes the one that most share, and
   the classes of a key are a group. Members are compared with the leaders of bounded chunks, then the chunks' leaders in
   chunks of their own, until a group has one chunk or its leaders get no fewer; groups of copies are connected by then.
3. The matrix holds, for every group, the tokens in its members' prefixes. A prefix is the rarest tokens of a set, so many
   that two sets over the threshold must share one. How many of a set's prefix tokens a group holds bounds the overlap with
   any member; where the bound can reach the threshold, the set is a query to the group. In a group that is not connected
   yet, so is every member outside its largest component, to its own group.
4. Queries meet the members of their groups in chunks. A chunk's token union bounds the overlap again; only chunks that pass
   are opened, and members over the threshold link their components to the query's.

Steps 3 and 4 leave no pair of components out, so the result is exact whatever step 2 has found. A large family of copies
is one group: its common tokens stand once in the matrix, and a connected family is not compared again. Frequent tokens
come last in every set and so are rarely in a prefix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import broadcast_within, grouped, packed, rows_of, stored
from boxlake.llm.components import connected_components
from boxlake.llm.shingles import mix, shingle_sets

#: The sketch has 2 to the SKETCH_BITS counters, dealt out in 2 to the SLICE_BITS slices.
SKETCH_BITS, SLICE_BITS = 22, 6
#: Grouping keys of each set, and MinHashes in each key.
KEYS, ROWS = 4, 2
#: Members of a chunk, on average; bytes of ids and their roles that are broadcast at most.
CHUNK, MOST_BYTES = 256, 64 << 20
_SMALL = 256  # texts that are hashed together


@dataclass(frozen=True)
class Rule:
    """Shingles of ``n`` words; a link needs 100 * intersection >= percent * union."""

    n: int = 4
    percent: int = 85

    def needed(self, size):
        """Tokens that a set of this size shares with any set it is linked to, at least."""
        return -(-self.percent * size // 100)

    def overlap(self, a, b):
        """Tokens that linked sets of these sizes share, at least."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def linked(self, shared, a, b):
        return 100 * shared >= self.percent * (a + b - shared)


def _sets(rows: Iterator[tuple], n: int, at: int) -> Iterator[tuple[list[tuple], np.ndarray, np.ndarray]]:
    """Rows in small lots with their shingle sets; ``at`` is the text's place in a row."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[at] or "")
        if len(held) == _SMALL or size > 1 << 20:
            yield held, *shingle_sets([r[at] for r in held], n)
            held, size = [], 0
    if held:
        yield held, *shingle_sets([r[at] for r in held], n)


_SIGNATURES = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("keys", pa.list_(pa.int64())), ("slice", pa.int32()), ("counts", pa.binary())])


def _signatures(n: int):
    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        for rows, gram, at in _sets(rows_of(batches), n, 1):
            tokens = gram.view(np.uint64)
            if len(tokens):
                np.add.at(sketch, tokens >> np.uint64(64 - SKETCH_BITS), np.uint32(1))
            full = np.flatnonzero(np.diff(at))
            starts = at[full]
            sums = {}
            if len(full):
                f1 = np.add.reduceat(mix(tokens + np.uint64(1)), starts).view(np.int64)
                f2 = np.bitwise_xor.reduceat(mix(tokens ^ np.uint64(0x5851F42D4C957F2D)), starts).view(np.int64)
                least = [np.minimum.reduceat(mix(tokens ^ mix(np.array([h + 1], np.uint64))), starts) for h in range(KEYS * ROWS)]
                keys = [mix(sum(least[k * ROWS + r] * np.uint64(2 * r + 3) for r in range(ROWS)) + np.uint64(k)).view(np.int64) for k in range(KEYS)]
                sums = {i: (a, b, list(k)) for i, a, b, *k in zip(full.tolist(), f1.tolist(), f2.tolist(), *(k.tolist() for k in keys), strict=True)}
            sizes = np.diff(at).tolist()
            for i, row in enumerate(rows):
                yield row[0], sizes[i], *sums.get(i, (None, None, None)), None, None
        press = zstandard.ZstdCompressor(level=1)
        for i, part in enumerate(np.split(sketch, 1 << SLICE_BITS)):
            if part.any():
                yield None, None, None, None, None, i, press.compress(np.ascontiguousarray(part.view(np.uint8).reshape(-1, 4).T).tobytes())

    return lambda batches: packed(signatures(batches), _SIGNATURES)


def _opened(counts: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(counts), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _ranks(written: DataFrame) -> np.ndarray:
    """A byte for each counter, larger where tokens are more frequent. Its size is fixed, and so is what is collected."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in grouped(rows_of(batches), 1):
            total = np.zeros(1 << (SKETCH_BITS - SLICE_BITS), np.uint64)
            for _, counts in rows:
                total += _opened(counts)
            level = np.minimum(255, np.log2(total + 1.0) * 6).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([level.tobytes()], pa.binary())], names=["slice", "levels"])

    slices = written.filter("slice is not null").select("slice", "counts").repartition(1 << SLICE_BITS, "slice").sortWithinPartitions("slice")
    ranks = np.zeros((1 << SLICE_BITS, 1 << (SKETCH_BITS - SLICE_BITS)), np.uint8)
    for row in slices.mapInArrow(add, "slice int, levels binary").collect():
        ranks[row["slice"]] = np.frombuffer(row["levels"], np.uint8)
    return ranks.ravel()


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _with_sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """``wanted`` rows (doc_id, roles array of structs) with the set of their text as bytes, one row for each role."""
    texts = docs.join(broadcast_within(wanted, MOST_BYTES), "doc_id").select("doc_id", "text", "roles")
    inner = wanted.schema["roles"].dataType.elementType
    arrow = pa.schema([("doc_id", pa.int64()), ("set", pa.binary()), *[(f.name, pa.int64()) for f in inner]])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for rows, gram, at in _sets(rows_of(batches), n, 1):
            for i, (doc_id, _, roles) in enumerate(rows):
                held = gram[at[i] : at[i + 1]].tobytes()
                for role in roles:
                    yield doc_id, held, *role.values()

    schema = "doc_id long, set binary, " + ", ".join(f"{f.name} long" for f in inner)
    return texts.mapInArrow(lambda b: packed(sets(b), arrow), schema)


def _group_chunks(rule: Rule):
    """Links of each member to a leader of its chunk; leaders (with sets) where their key has more chunks."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (key, _), rows in grouped(((k, c, d, s, m) for d, s, k, c, m in rows_of(batches)), 2):
            leaders: list[tuple[int, np.ndarray]] = []
            for _, _, doc_id, held, _ in sorted(rows, key=lambda r: r[2]):
                mine = np.frombuffer(held, np.int64)
                for leader, theirs in leaders:
                    small, large = sorted((len(mine), len(theirs)))
                    if 100 * small >= rule.percent * large and rule.linked(_shared(mine, theirs), len(mine), len(theirs)):
                        yield leader, doc_id, None, None
                        break
                else:
                    leaders.append((doc_id, mine))
            if rows[0][4] > 1:
                for leader, held in leaders:
                    yield leader, None, key, held.tobytes()

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("set", pa.binary())])
    return lambda batches: packed(link(batches), schema)


def _chunked(members: DataFrame) -> DataFrame:
    """``members`` (doc_id, key) of keys that several have, with the number of members, of chunks, and a chunk."""
    sizes = members.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    sizes = sizes.withColumn("chunks", F.ceil(F.col("members") / CHUNK).cast("long"))
    return members.join(sizes, "key").withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.col("chunks")))


def _groups(classes: DataFrame) -> DataFrame:
    """doc_id, key, members, chunks and chunk of every class that shares its most shared key."""
    keyed = classes.select("doc_id", F.explode("keys").alias("key")).distinct()
    shared = _chunked(keyed).groupBy("doc_id").agg(F.max(F.struct("members", "key")).alias("most"))
    return _chunked(shared.select("doc_id", F.col("most.key").alias("key")))


def _similar_links(docs: DataFrame, groups: DataFrame, rule: Rule) -> DataFrame:
    """Links a, b inside groups: to a leader of the chunk, then to leaders of chunks of leaders, while a key's get half as many."""
    roles = groups.select("doc_id", F.array(F.struct("key", "chunk", "chunks")).alias("roles"))
    dealt = _with_sets(docs, stored(roles, "join-keys"), rule.n).select("doc_id", "set", "key", "chunk", "chunks")
    sizes, links = groups.select("key", "members").distinct(), None
    while True:
        placed = dealt.repartition("key", "chunk").sortWithinPartitions("key", "chunk")
        found = stored(placed.mapInArrow(_group_chunks(rule), "a long, b long, key long, set binary"), "join-groups")
        here = found.filter("b is not null").select("a", "b")
        links = here if links is None else links.union(here)
        leaders = found.filter("key is not null").select(F.col("a").alias("doc_id"), "set", "key")
        fewer = leaders.groupBy("key").agg(F.count("*").alias("n")).join(sizes, "key").filter("2 * n <= members")
        sizes = stored(fewer.select("key", F.col("n").alias("members")), "join-sizes")
        if sizes.isEmpty():
            return links
        leaders = leaders.join(sizes.select("key"), "key", "left_semi")
        dealt = _chunked(leaders.select("doc_id", "key")).join(leaders, ["doc_id", "key"]).select("doc_id", "set", "key", "chunk", "chunks")


def _connected_groups(docs: DataFrame, groups: DataFrame, found: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """``found`` with more links inside groups, and the components that they make.

    What members outside the largest component cost later is their number times the group's chunks. Where that is more
    than a few times the group, its members are dealt into chunks anew, as long as that brings down their number.
    """
    salt, seen = 0, None
    while True:
        components = connected_components(found, "join-components")
        named = groups.join(components.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("comp", F.coalesce("component", "doc_id"))
        shares = named.groupBy("key", "comp").agg(F.count("*").alias("n"), F.first("members").alias("members"), F.first("chunks").alias("chunks"))
        strays = shares.groupBy("key").agg((F.first("members") - F.max("n")).alias("strays"), F.first("members").alias("members"), F.first("chunks").alias("chunks"))
        often = stored(strays.filter("chunks > 1 and strays * chunks > 4 * members").select("key", "strays"), "join-strays")
        total = often.agg(F.sum("strays")).first()[0]
        if not total or (seen and 4 * total > 3 * seen):
            return found, components
        seen, salt = total, salt + 1
        place = F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.col("chunks"))
        roles = groups.join(often.select("key"), "key", "left_semi").select("doc_id", F.array(F.struct("key", place.alias("chunk"), F.lit(1).cast("long").alias("chunks"))).alias("roles"))
        dealt = _with_sets(docs, stored(roles, "join-keys"), rule.n).select("doc_id", "set", "key", "chunk", "chunks")
        dealt = dealt.repartition("key", "chunk").sortWithinPartitions("key", "chunk")
        more = dealt.mapInArrow(_group_chunks(rule), "a long, b long, key long, set binary").filter("b is not null").select("a", "b")
        found = found.union(stored(more, "join-links"))


def _prefixes(docs: DataFrame, ranks: np.ndarray, rule: Rule) -> DataFrame:
    """doc_id, n and the rarest tokens of every set."""
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    shift = np.uint64(64 - SKETCH_BITS)
    arrow = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("prefix", pa.list_(pa.int64()))])

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for rows, gram, at in _sets(rows_of(batches), rule.n, 1):
            sizes = np.diff(at)
            owner = np.repeat(np.arange(len(rows)), sizes)
            order = np.lexsort((gram, sent.value[gram.view(np.uint64) >> shift], owner))
            ranked, keep = gram[order], sizes - rule.needed(sizes) + 1
            for i, (doc_id, _) in enumerate(rows):
                if sizes[i]:
                    yield doc_id, int(sizes[i]), ranked[at[i] : at[i] + keep[i]]

    return docs.mapInArrow(lambda b: packed(prefixes(b), arrow), "doc_id long, n long, prefix array<long>")


def _open_groups(rule: Rule):
    """Links of queries to the components that have members over the threshold in a chunk whose union allows it."""

    def open_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for _, rows in grouped(((g, c, q, d, s, k) for d, s, g, c, q, k in rows_of(batches)), 2):
            members = [(d, np.frombuffer(s, np.int64), k) for _, _, q, d, s, k in rows if not q]
            if not members or len(members) == len(rows):
                continue
            sizes, component = np.array([len(s) for _, s, _ in members]), np.array([k for _, _, k in members])
            tokens = np.concatenate([s for _, s, _ in members])
            union, starts = np.unique(tokens), np.concatenate([[0], np.cumsum(sizes)[:-1]])
            for _, _, query, doc_id, held, own in rows:
                mine = np.frombuffer(held, np.int64)
                if not query or _shared(mine, union) < rule.needed(len(mine)):
                    continue
                at = np.searchsorted(mine, tokens)
                at[at == len(mine)] = 0
                shared = np.add.reduceat((mine[at] == tokens).astype(np.int64), starts)
                over = np.flatnonzero(rule.linked(shared, len(mine), sizes) & (component != own))
                for m in over[np.unique(component[over], return_index=True)[1]]:
                    yield doc_id, members[m][0]

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    return lambda batches: packed(open_groups(batches), schema)


def _queries(docs: DataFrame, named: DataFrame, ranks: np.ndarray, rule: Rule) -> DataFrame:
    """doc_id, comp, and the other groups (g, chunks) in which the matrix allows a link."""
    prefixes = _prefixes(docs, ranks, rule).join(named.hint("merge"), "doc_id")  # one text of each class
    # One array and no null checks on one side only, so that both sides of the join below share one exchange.
    whole = lambda name: F.coalesce(name, F.lit(0))
    cells = prefixes.select(F.explode("prefix").alias("token"), F.array("doc_id", "n", "g", "members").alias("cell"))
    cells = stored(cells, "join-cells").repartition("token")
    doc_id, n, g, members = (F.col("cell")[i].alias(c) for i, c in enumerate(("doc_id", "n", "g", "members")))
    q = cells.select("token", doc_id, n, g, members).alias("q")
    matrix = cells.select("token", n, g, members).groupBy("token", "g").agg(F.first("members").alias("members"), F.min("n").alias("low"), F.max("n").alias("high"))
    r = matrix.alias("r")
    met = q.join(
        r,
        (F.col("q.token") == F.col("r.token"))
        & (F.struct("q.members", "q.g") < F.struct("r.members", "r.g"))  # the smaller group asks the larger one
        & (rule.percent * whole("q.n") <= 100 * whole("r.high")) & (rule.percent * whole("r.low") <= 100 * whole("q.n")),
    )
    asked = met.groupBy("q.doc_id", "q.n", "r.g").agg(
        F.first("r.members").alias("members"), F.count("*").alias("held"), F.min("r.low").alias("low"), F.max("r.high").alias("high"),
    )
    # Common tokens that are not in both prefixes are fewer than the larger set needs. The least that must be in both is
    # reached at the smallest or largest size that a linked member can have, or, by rounding, one below.
    need = lambda m: f"(ceil({rule.percent} * (n + {m}) / {100 + rule.percent}) - ceil({rule.percent} * greatest(n, {m}) / 100) + 1)"
    low, high = f"greatest(low, ceil({rule.percent} * n / 100))", f"least(high, floor(100 * n / {rule.percent}))"
    allowed = asked.filter(f"held >= least({need(low)}, {need(high)}) - 1")
    allowed = allowed.join(named.select("doc_id", "comp"), "doc_id").join(named.select("g", "whole").distinct(), "g")
    open_ones = allowed.filter("whole is null or whole <> comp")  # else connected already
    return open_ones.select("doc_id", "comp", "g", F.ceil(F.col("members") / CHUNK).cast("long").alias("chunks"))


def _named(classes: DataFrame, groups: DataFrame, components: DataFrame) -> DataFrame:
    """Every class with its group (g, members, chunks, chunk) and component, the group's largest component, and its only one if so."""
    named = (
        classes.select("doc_id").distinct().join(groups, "doc_id", "left").join(components.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", F.coalesce("key", "doc_id").alias("g"), F.coalesce("members", F.lit(1)).alias("members"),
                F.coalesce("chunks", F.lit(1)).alias("chunks"), F.coalesce("chunk", F.lit(0)).alias("chunk"), F.coalesce("component", "doc_id").alias("comp"))
    )
    shares = named.groupBy("g", "comp").agg(F.count("*").alias("n")).groupBy("g").agg(F.max(F.struct("n", "comp"))["comp"].alias("largest"), F.count("*").alias("comps"))
    return stored(named.join(shares.select("g", "largest", F.when(F.col("comps") == 1, F.col("largest")).alias("whole")), "g"), "join-named")


def _links_between(docs: DataFrame, classes: DataFrame, groups: DataFrame, found: DataFrame, components: DataFrame, ranks: np.ndarray, rule: Rule) -> DataFrame:
    """Links a, b between classes of different components, at least one for every two that are linked.

    Where those who ask would meet many chunks each, they meet one at first, as long as that leaves clearly fewer to ask.
    """
    named = _named(classes, groups, components)
    asked = stored(_queries(docs, named, ranks, rule).select("doc_id", "g"), "join-asked")
    salt, seen, links = 0, None, None
    while True:
        own, theirs = named.select("doc_id", "comp"), named.select("g", "chunks", "whole").distinct()
        elsewhere = asked.join(own, "doc_id").join(theirs, "g").filter("whole is null or whole <> comp")
        strays = named.filter("whole is null and comp <> largest")
        asking = stored(elsewhere.select("doc_id", "g", "chunks", "comp").union(strays.select("doc_id", "g", "chunks", "comp")), "join-asking")
        count, cost = asking.agg(F.count("*"), F.sum("chunks")).first()
        last = not count or cost <= 8 * count or (seen is not None and 4 * cost > 3 * seen)
        salt, seen = salt + 1, cost
        one = F.array(F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.col("chunks")))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1) if last else one).alias("chunk")
        queries = asking.select("doc_id", "g", every, F.lit(1).cast("long").alias("query"), "comp")
        members = named.join(asking.select("g").distinct(), "g").select("doc_id", "g", "chunk", F.lit(0).cast("long").alias("query"), "comp")
        roles = members.unionByName(queries).groupBy("doc_id").agg(F.collect_list(F.struct("g", "chunk", "query", "comp")).alias("roles"))
        sets = _with_sets(docs, stored(roles, "join-roles"), rule.n).select("doc_id", "set", "g", "chunk", "query", "comp")
        opened = stored(sets.repartition("g", "chunk").sortWithinPartitions("g", "chunk").mapInArrow(_open_groups(rule), "a long, b long"), "join-between")
        links = opened if links is None else links.union(opened)
        if last:
            return links
        named = _named(classes, groups, connected_components(found.union(links), "join-components"))


def jaccard_components(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every row of ``docs``.

    Only doc_id and text are read, whatever other columns there are. A text without words, or null, has an empty set and is
    linked with nothing. Rows of one doc_id are one document: they are linked with each other, and each has its own
    n_shingles. Rows whose doc_id is null are linked with nothing and have a null component_id. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    written = stored(docs.mapInArrow(_signatures(rule.n), "doc_id long, n long, f1 long, f2 long, keys array<long>, slice int, counts binary"), "join-signatures")
    signed = written.filter("slice is null").drop("slice", "counts")
    known = docs.filter("doc_id is not null")

    full = signed.filter("doc_id is not null and n > 0")
    # Equal sets are one class, named by its smallest doc_id; rows of one doc_id with different sets link their classes.
    classes = stored(full.groupBy("f1", "f2").agg(F.min(F.struct("doc_id", "keys")).alias("least")).select("f1", "f2", "least.doc_id", "least.keys"), "join-classes")
    copies = full.join(classes.select("f1", "f2", F.col("doc_id").alias("class")), ["f1", "f2"]).select("doc_id", "class")
    copies = stored(copies.distinct(), "join-copies")

    groups = stored(_groups(classes), "join-groups")
    found = stored(_similar_links(known, groups, rule), "join-links")
    same = copies.filter("doc_id <> class").select(F.col("class").alias("a"), F.col("doc_id").alias("b"))
    found, components = _connected_groups(known, groups, found, rule)
    between = _links_between(known, classes, groups, found, components, _ranks(written), rule)
    reached = connected_components(found.union(between).union(same), "join-components")
    named = signed.select("doc_id", F.col("n").alias("n_shingles")).join(reached.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return named.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def keep_first_of_groups(docs: DataFrame, rule: Rule = Rule(5, 80)) -> DataFrame:
    """One row of ``docs`` for each component, that of its smallest doc_id, all columns as they are.

    Repeated rows of one doc_id become one; of different rows with that doc_id, any one stays. Rows without words or
    without a doc_id are in no group and stay.
    """
    found = jaccard_components(docs, rule)
    gone = stored(found.filter("component_id <> doc_id").select("doc_id").distinct(), "join-gone")
    known = docs.join(broadcast_within(gone, MOST_BYTES), docs["doc_id"] == gone["doc_id"], "left_anti")
    repeated = stored(found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "join-repeated")
    if repeated.isEmpty():
        return known
    return known.filter("doc_id is not null").dropDuplicates(["doc_id"]).union(known.filter("doc_id is null"))
