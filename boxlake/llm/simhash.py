"""SimHash fingerprints, and their near-equality join through deletion variants of a few segments.

Fingerprints that differ in at most ``most`` bits, cut into ``most // 2 + 1`` segments, have a segment in which they differ in
at most one bit. So each distinct fingerprint is indexed once for each of its 64 bits, by the bit's segment with that bit
left out: two segments that differ in at most one bit agree in such a variant. An equality join on the variants meets every
pair that can link, and the whole fingerprints verify it.

Rows of one variant are dealt into chunks. A chunk is searched whole, breadth first, and gives a star for each part that it
connects, never all its pairs. Variants with one chunk are then done. In variants with several, members of any component
but the most frequent one are asked against every chunk; the members of that one need no more than to answer. So no link
between two components is missed, however large a family of copies is, and a connected family is not compared again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import broadcast_if_small, packed, rows_of, stored
from boxlake.llm.components import connected_components
from boxlake.llm.shingles import folded_pieces

BITS, SEED = 64, 42
#: Members of a chunk, about; rows of frequent variants (24 bytes each) that are broadcast at most.
CHUNK, MOST_FREQUENT = 1024, 200_000


def fingerprint(text: bytes | None, n: int = 4) -> int:
    """The SimHash of a text's ``n``-word shingles, repeats included: a bit is 1 if over half of the shingles' XXH64 have it.

    Words are runs of anything but space and \\x09-\\x0D, A-Z lower-cased, joined by one space. Fewer than ``n`` words are
    one shingle; no words, or null, give 0. A very long text is read in pieces.
    """
    ones, total, tail = np.zeros(BITS, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for piece in folded_pieces(text or b""):
        words = tail + piece.split()
        if len(words) >= n:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])
            grams = [digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist(), strict=True)]
            hashes = np.array(grams, "<u8").view(np.uint8).reshape(-1, 8)
            for at in range(0, len(hashes), 1 << 14):
                ones += np.unpackbits(hashes[at : at + (1 << 14)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(grams)
        tail = words[max(0, len(words) - n + 1) :]
    if not total:
        return digest(b" ".join(tail), SEED) if tail else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, n: int = 4) -> DataFrame:
    """doc_id and fingerprint (its 64 bits as a long) of every row of ``docs``."""
    arrow = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, text in rows_of(batches):
            bits = fingerprint(text, n)
            yield doc_id, bits - (1 << BITS) if bits >> (BITS - 1) else bits

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return given.mapInArrow(lambda batches: packed(read(batches), arrow), "doc_id long, fingerprint long")


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def segment_masks(most: int) -> list[int]:
    """The bits of each segment, as equal in size as can be."""
    pieces = np.array_split(np.arange(BITS), most // 2 + 1)
    return [sum(1 << int(b) for b in piece) for piece in pieces]


def variant_masks(most: int) -> list[int]:
    """For each bit, the bits of its segment without it."""
    masks = segment_masks(most)
    return [next(m for m in masks if m >> b & 1) & ~(1 << b) for b in range(BITS)]


def _variants(prints: DataFrame, most: int) -> DataFrame:
    """``prints`` (node, bits) once for each bit: hole (the bit left out) and rest (what its segment has besides)."""
    masks = F.array(*[F.lit(_signed(m)).cast("long") for m in variant_masks(most)])
    held = prints.select("node", "bits", F.posexplode(masks).alias("hole", "mask"))
    return held.select("node", "bits", F.col("hole").cast("byte").alias("hole"), F.col("bits").bitwiseAND(F.col("mask")).alias("rest"))


def _frequent(prints: DataFrame, most: int) -> DataFrame:
    """hole, rest and chunks of variants that may have more than CHUNK members.

    A variant's members are those of two values of its segment, so values are counted: three rows a fingerprint, not 64.
    """
    masks = segment_masks(most)
    segment = F.array(*[F.lit(_signed(m)).cast("long") for m in masks])
    values = prints.select("bits", F.posexplode(segment).alias("segment", "mask")).select("segment", F.col("bits").bitwiseAND(F.col("mask")).alias("value"))
    often = values.groupBy("segment", "value").count().filter(F.col("count") > CHUNK // 2)
    holes = F.array(*[F.array(*[F.struct(F.lit(b).cast("byte").alias("hole"), F.lit(_signed(v)).cast("long").alias("mask")) for b, v in enumerate(variant_masks(most)) if m >> b & 1]) for m in masks])
    each = often.select("value", "count", F.explode(F.element_at(holes, F.col("segment") + 1)).alias("of")).select(F.col("of.hole").alias("hole"), F.col("value").bitwiseAND(F.col("of.mask")).alias("rest"), "count")
    return each.groupBy("hole", "rest").agg((F.ceil(F.sum("count") / CHUNK) + 1).cast("int").alias("chunks"))


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Whole groups of sorted rows, many at a time: the groups' bounds, and all columns; groups agree in the first ``keys`` columns."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held = now if held is None else [np.concatenate([a, b]) for a, b in zip(held, now, strict=True)]
        fresh = np.zeros(len(held[0]), bool)
        fresh[0] = True
        for column in held[:keys]:
            fresh[1:] |= column[1:] != column[:-1]
        at = np.flatnonzero(fresh)
        if len(at) > 1:
            yield at, [c[: at[-1]] for c in held]
            held = [c[at[-1] :] for c in held]
    if held is not None:
        yield np.array([0, len(held[0])]), held


def _near(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    return np.bitwise_count(a[:, None] ^ b[None, :]) <= most


def _stars(node: np.ndarray, bits: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (a, b): every part that links connect, as a star around one of its nodes."""
    while len(node) > 1:
        seed, front, node, bits = node[0], bits[:1], node[1:], bits[1:]
        while len(front) and len(node):
            near, front = _near(front[:256], bits, most).any(axis=0), front[256:]
            if near.any():
                yield np.full(near.sum(), seed), node[near]
                front = np.concatenate([front, bits[near]])
                node, bits = node[~near], bits[~near]


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _links(found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(side), pa.int64()) for side in zip(*found, strict=True)], schema=_LINKS)


def _inside(most: int):
    """Links inside groups (hole, rest, chunk) of rows (hole, rest, chunk, node, bits)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, (_, _, _, node, bits) in _runs(batches, 3):
            size, bits = np.diff(at), bits.view(np.uint64)
            two = at[:-1][size == 2]
            two = two[np.bitwise_count(bits[two] ^ bits[two + 1]) <= most]
            found = [(node[two], node[two + 1])]
            for g in np.flatnonzero(size > 2):
                found += _stars(node[at[g] : at[g + 1]], bits[at[g] : at[g + 1]], most)
            yield from _links(found)

    return search


def _across(most: int):
    """Links of asking rows to members of other components in groups of rows (hole, rest, chunk, node, bits, comp, asks)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, (_, _, _, node, bits, comp, asks) in _runs(batches, 3):
            found, bits = [], bits.view(np.uint64)
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                asking = np.flatnonzero(asks[a:b]) + a
                told = np.flatnonzero(~asks[a:b]) + a
                for some in np.array_split(asking, -(-len(asking) // 256)) if len(asking) and len(told) else ():
                    q, m = np.nonzero(_near(bits[some], bits[told], most) & (comp[some][:, None] != comp[told][None, :]))
                    _, first = np.unique(np.stack([comp[some][q], comp[told][m]]), axis=1, return_index=True)
                    found.append((node[some][q[first]], node[told][m[first]]))
            yield from _links(found)

    return search


def near_links(prints: DataFrame, most: int = 4) -> DataFrame:
    """node and component (smallest node it reaches) of the rows of ``prints`` (node, bits; longs) that link with others.

    ``bits`` should be distinct and both columns without nulls; ``prints`` should be stored. Links of equal nodes are no matter.
    """
    frequent = stored(_frequent(prints, most), "simhash-frequent")
    variants = _variants(prints, most).join(broadcast_if_small(frequent, MOST_FREQUENT), ["hole", "rest"], "left")
    place = F.pmod(F.xxhash64("hole", "bits"), F.coalesce("chunks", F.lit(1))).cast("int").alias("chunk")
    key = ["hole", "rest", "chunk"]
    dealt = variants.select("hole", "rest", place, "node", "bits").repartition(*key).sortWithinPartitions(*key)
    inside = stored(dealt.mapInArrow(_inside(most), "a long, b long"), "simhash-links")
    components = connected_components(inside, "simhash-components")
    if frequent.isEmpty():
        return components

    found = components.withColumnRenamed("component", "comp")
    members = _variants(prints, most).join(broadcast_if_small(frequent, MOST_FREQUENT), ["hole", "rest"]).select("*", place)
    members = members.join(found, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    members = stored(members, "simhash-members")
    shares = members.groupBy("hole", "rest", "comp").agg(F.count("*").alias("n")).groupBy("hole", "rest")
    largest = shares.agg(F.max(F.struct("n", "comp")).alias("most"), F.count("*").alias("comps")).filter("comps > 1").select("hole", "rest", F.col("most.comp").alias("largest"))
    largest = stored(largest, "simhash-largest")
    open_ones = members.join(broadcast_if_small(largest, MOST_FREQUENT), ["hole", "rest"])
    asked = open_ones.filter("comp <> largest").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    columns = [*key, "node", "bits", "comp"]
    both = open_ones.select(*columns, F.lit(False).alias("asks")).union(asked.select(*columns, F.lit(True).alias("asks")))
    across = both.repartition(*key).sortWithinPartitions(*key).mapInArrow(_across(most), "a long, b long")
    return connected_components(inside.union(stored(across, "simhash-across")), "simhash-components")


def near_components(docs: DataFrame, n: int = 4, most: int = 4) -> DataFrame:
    """doc_id, fingerprint (long) and component_id (smallest doc_id reachable by links) of every row of ``docs``.

    Rows link when their fingerprints differ in at most ``most`` bits; texts without words have fingerprint 0 and link like any
    other. Only doc_id and text are read, whatever other columns there are. Rows of one doc_id are one document: what each of
    them links with is connected. Rows whose doc_id is null are linked with nothing and have a null component_id. An empty
    table gives no rows.
    """
    signed = stored(fingerprints(docs, n), "simhash-prints")
    known = signed.filter("doc_id is not null")
    prints = stored(known.groupBy("fingerprint").agg(F.min("doc_id").alias("node")).select("node", F.col("fingerprint").alias("bits")), "simhash-distinct")
    near = near_links(prints, most)
    # A doc_id with several fingerprints connects their components; nodes are doc_ids, so the links are theirs.
    several = known.groupBy("doc_id").agg(F.min("fingerprint").alias("low"), F.max("fingerprint").alias("high")).filter("low <> high").select("doc_id")
    several = stored(several, "simhash-several")
    if not several.isEmpty():
        own = known.join(several, "doc_id").join(prints.withColumnRenamed("bits", "fingerprint"), "fingerprint").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
        near = connected_components(near.select(F.col("component").alias("a"), F.col("node").alias("b")).union(own), "simhash-components")
    named = prints.join(near, "node", "left").select(F.col("bits").alias("fingerprint"), F.coalesce("component", "node").alias("component_id"))
    linked = known.join(stored(named, "simhash-named"), "fingerprint", "left").select("doc_id", "fingerprint", "component_id")
    return linked.union(signed.filter("doc_id is null").select("doc_id", "fingerprint", F.lit(None).cast("long").alias("component_id")))
