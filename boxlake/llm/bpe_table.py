"""BPE encoding and decoding through a table of distinct words.

Each block of documents (up to about five million words) is split once and kept as numbers into the block's own list of
words, frequent words first. Those lists, cut into buckets by a word's hash and sorted, are the only words that move:
every bucket holds each of its words once, encodes it once, and answers each block's list with ids by position. Blocks and answers
meet in a cogroup on the block; ids become pieces through the id-to-piece table, whose size is the vocabulary's.

Nothing grows with a frequent word or a large source: a word occurs once in a block's list, and documents are
spread by block. Blocks are written to the shared folder before they are read by two sides, so that a lost
executor cannot number them anew.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from boxlake.llm import word_bpe
from boxlake.llm.common import packed, rows_of, stored

BLOCK_WORDS = 5_000_000
#: Texts, and about so many words, whose numbers are kept in one row.
ROW_TEXTS, ROW_WORDS = 256, 100_000

_BLOCKS = "block long, bucket int, doc_ids array<long>, lengths binary, words binary, codes binary"
_BLOCKS_ARROW = pa.schema([
    ("block", pa.int64()), ("bucket", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
    ("lengths", pa.binary()), ("words", pa.binary()), ("codes", pa.binary()),
])
_ANSWERS_ARROW = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("lengths", pa.binary()), ("ids", pa.binary())])
_RESULT = "doc_id long, ids array<int>, decoded string"
_RESULT_ARROW = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def _press(numbers: np.ndarray) -> bytes:
    """int32 numbers, byte planes apart, compressed."""
    planes = np.ascontiguousarray(numbers, "<i4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _open(pressed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(pressed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def _split(content: str, buckets: int, block_words: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        words_of = word_bpe.tokenizer(content).words
        block, codes, size, held = TaskContext.get().partitionId() << 32, word_bpe.Codes(), 0, []
        for doc_id, text in rows_of(batches):
            numbers = codes.array(words_of(text))
            held.append((doc_id, numbers))
            size += len(numbers)
            if size >= block_words:
                yield from closed(block, codes, held)
                block, codes, size, held = block + 1, word_bpe.Codes(), 0, []
        if held:
            yield from closed(block, codes, held)

    def closed(block: int, codes: dict[str, int], held: list[tuple]) -> Iterator[tuple]:
        words = list(codes)
        counts = np.bincount(np.concatenate([n for _, n in held]), minlength=len(words))
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(words), np.int32)
        rank[order] = np.arange(len(words))
        of = [zlib.crc32(w.encode()) % buckets for w in words]
        dealt = sorted(range(len(words)), key=lambda i: (of[i], words[i]))
        yield block, -1, [], b"", _press(rank[dealt]), _press(np.zeros(0, np.int32))
        some: list[tuple] = []
        for i, row in enumerate(held):
            some.append(row)
            if i + 1 == len(held) or len(some) == ROW_TEXTS or sum(len(n) for _, n in some) >= ROW_WORDS:
                lengths = np.fromiter((len(n) for _, n in some), np.int32, len(some))
                yield block, -1, [d for d, _ in some], lengths.tobytes(), None, _press(rank[np.concatenate([n for _, n in some])])
                some = []
        for bucket, mine in groupby(dealt, key=of.__getitem__):
            text = "\n".join([words[i] for i in mine]).encode()
            yield block, bucket, None, None, zstandard.ZstdCompressor(level=9).compress(text), None

    return lambda batches: packed(blocks(batches), _BLOCKS_ARROW)


def _encode(content: str):
    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        tokens, known = word_bpe.tokenizer(content), {}
        for bucket, block, pressed in rows_of(batches):
            words = zstandard.ZstdDecompressor().decompress(pressed).decode().split("\n")
            new = [w for w in words if w not in known]
            known.update(zip(new, (np.array(i, np.int32).tobytes() for i in tokens.ids(new)), strict=True))
            ids = [known[w] for w in words]
            lengths = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
            yield block, bucket, _press(lengths), _press(np.frombuffer(b"".join(ids), np.int32))

    return lambda batches: packed(answers(batches), _ANSWERS_ARROW)


def _join(content: str):
    def joined(documents: pa.Table, answers: pa.Table) -> pa.Table:
        pieces = word_bpe.tokenizer(content).pieces
        empty = [np.zeros(0, np.int32)]
        answers = answers.sort_by("bucket")
        ranks = np.concatenate([_open(v) for v in documents["words"].to_pylist() if v is not None] or empty)
        lengths = np.concatenate([_open(v) for v in answers["lengths"].to_pylist()] or empty)
        flat = np.concatenate([_open(v) for v in answers["ids"].to_pylist()] or empty)
        if len(ranks) != len(lengths):
            raise RuntimeError("a block and the answers to its lists of words do not belong together")
        order = np.argsort(ranks)
        flat = word_bpe.gather(np.concatenate([[0], np.cumsum(lengths)]), flat, order)
        starts = np.concatenate([[0], np.cumsum(lengths[order])])
        texts = [" ".join([pieces[i] for i in flat[a:b].tolist()]) for a, b in zip(starts[:-1], starts[1:], strict=True)]

        def results() -> Iterator[tuple]:
            for doc_ids, sizes, pressed in zip(*(documents[c].to_pylist() for c in ("doc_ids", "lengths", "codes")), strict=True):
                numbers, at = _open(pressed), 0
                for doc_id, size in zip(doc_ids, np.frombuffer(sizes, np.int32).tolist(), strict=True):
                    mine = numbers[at : at + size]
                    at += size
                    yield doc_id, word_bpe.gather(starts, flat, mine), " ".join([texts[i] for i in mine.tolist()])

        return pa.Table.from_batches(packed(results(), _RESULT_ARROW), _RESULT_ARROW)

    return joined


def encode_and_decode(docs: DataFrame, tokenizer_path: str | None = None, buckets: int | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, ids array<int> and decoded text of every row of ``docs`` (doc_id, text; other columns are ignored).

    A null text counts as empty and gives no ids and an empty decoded text. Rows may repeat and doc_id may be
    null: there is one result for each row. No row gives no row. ``buckets`` should grow with the number of
    distinct words; by default it is the number of shuffle partitions.
    """
    spark = docs.sparkSession
    content = word_bpe.spec(tokenizer_path)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    blocks = stored(given.mapInArrow(_split(content, buckets, block_words), _BLOCKS), "bpe-blocks")
    lists = blocks.filter("bucket >= 0")
    answers = (
        lists.select("bucket", "block", "words").repartition(buckets, "bucket")
        .mapInArrow(_encode(content), "block long, bucket int, lengths binary, ids binary")
    )
    documents = blocks.filter("bucket < 0").select("block", "doc_ids", "lengths", "words", "codes")
    return documents.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_join(content), _RESULT)
