"""Token ids as a binary dataset under a static range asymmetric numeral system (rANS).

Layout of a dataset folder:

  frequencies/  Parquet (token, frequency): the one table that all blocks share. Frequencies are
                the counts of all tokens of the corpus scaled to 2^bits; their number is bounded
                by the vocabulary.
  blocks/       Parquet (shard, block, start, first_doc_id, n_docs, n_tokens, data): ascending
                shards hold ascending doc_ids, blocks of a shard follow each other. `start`
                counts the ids of the shard before the block; `data` is a block.

Block, little-endian: magic `SRA1`, then as unsigned 32-bit numbers: bits, lanes, steps between
checkpoints, documents, tokens, checkpoints, words, bytes of the document table; the document
table (zlib: doc_ids as 64-bit numbers, a byte each telling if there is one, ids of each as
32-bit numbers); the checkpoints (32-bit place among the words, then a 64-bit state per lane);
the words (32-bit); crc32 of all before it.

Token i of a block is in lane i mod lanes, step i div lanes. All lanes of a step are coded at
once; a state stays below 2^63 by moving 32 bits to the words. A decoder can start at any
checkpoint, so blocks and the parts of a block are decoded independently. At the end every
state must be back at its first value and every word used.

Documents are dealt to shards by quantiles of doc_id and sorted within; a block ends after the
document that fills it. Defined results: a null text is the empty text (its only id is the end
id); repeated rows are written again; rows without doc_id come first; an empty table gives an
empty dataset; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.text import small_batches
from siltstone.llm.tokens import encoder
from siltstone.session import materialize

MAGIC = b"SRA1"
#: Lanes of a block, tokens after which a block ends, steps between checkpoints.
LANES, BLOCK_TOKENS, CHECKPOINT_STEPS = 1024, 1 << 19, 96
#: Lowest state of a lane.
LOW = 1 << 31
#: Documents whose tokens are counted at a time.
COUNT_TOGETHER = 500
#: Documents of a shard, about.
SHARD_DOCUMENTS = 20_000

HEAD = struct.Struct("<4s8I")
BLOCKS = "shard int, block int, start long, first_doc_id long, n_docs int, n_tokens long, data binary"


class BrokenBlock(ValueError):
    """A block whose checksum, states or words do not come out."""


class Table:
    """Tokens, scaled frequencies and the slots of a frequency table."""

    def __init__(self, tokens: np.ndarray, frequencies: np.ndarray):
        self.tokens = tokens.astype(np.int64)
        self.frequency = frequencies.astype(np.uint64)
        self.below = np.cumsum(self.frequency) - self.frequency
        total = int(self.frequency.sum())
        self.bits = total.bit_length() - 1
        if total != 1 << self.bits:
            raise ValueError("frequencies must add up to a power of two")
        self.slots = np.repeat(np.arange(len(tokens)), frequencies.astype(np.int64))


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies of at least 1 that add up to a power of two, close to `counts`."""
    bits = max(12, min(24, len(counts).bit_length() + 4))
    total = 1 << bits
    exact = counts * (total / counts.sum())
    out = np.maximum(1, exact.astype(np.int64))
    order = np.argsort(-out, kind="stable")
    over = int(out.sum()) - total
    at = 0
    while over > 0:  # the ones that were raised to 1 are taken from the most frequent
        take = min(over, max(0, int(out[order[at]]) // 2))
        out[order[at]] -= take
        over -= take
        at += 1
    out[order[0]] -= over
    return out


def encode_block(table: Table, ids: np.ndarray, docs: list[tuple[int | None, int]]) -> bytes:
    """One block: `ids` of all its documents, `docs` their (doc_id, number of ids)."""
    symbols = np.searchsorted(table.tokens, ids)
    n, shift = len(symbols), np.uint64(table.bits)
    states = np.full(LANES, LOW, dtype=np.uint64)
    ceiling = np.uint64((LOW >> table.bits) << 32)
    word_bits, low_word = np.uint64(32), np.uint64(0xFFFFFFFF)
    steps = -(-n // LANES)
    words: list[np.ndarray] = []
    saved: list[tuple[int, np.ndarray]] = []
    for step in range(steps - 1, -1, -1):
        s = symbols[step * LANES: (step + 1) * LANES]
        f, x = table.frequency[s], states[: len(s)]
        full = x >= ceiling * f
        words.append((x[full] & low_word).astype("<u4"))
        x[full] >>= word_bits
        high = x // f
        states[: len(s)] = (high << shift) + (x - high * f) + table.below[s]
        if step % CHECKPOINT_STEPS == 0:
            saved.append((step, states.copy()))
    words.reverse()
    before = np.cumsum([0] + [len(w) for w in words])
    marks = b"".join(
        struct.pack("<I", before[step]) + x.astype("<u8").tobytes() for step, x in reversed(saved)
    )
    names = zlib.compress(
        np.array([d or 0 for d, _ in docs], "<i8").tobytes()
        + bytes(d is not None for d, _ in docs)
        + np.array([k for _, k in docs], "<u4").tobytes()
    )
    body = HEAD.pack(
        MAGIC, table.bits, LANES, CHECKPOINT_STEPS, len(docs), n, len(saved), before[-1], len(names)
    ) + names + marks + b"".join(w.tobytes() for w in words)
    return body + struct.pack("<I", zlib.crc32(body))


def decode_block(
    table: Table, data: bytes | memoryview, checkpoint: int | None = None
) -> tuple[np.ndarray, list[tuple[int | None, int]]]:
    """The ids and documents of a block, or only the ids from one checkpoint to the next."""
    if zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
        raise BrokenBlock("the checksum differs")
    magic, bits, lanes, gap, n_docs, n, n_marks, n_words, n_names = HEAD.unpack_from(data)
    if magic != MAGIC or bits != table.bits:
        raise BrokenBlock("not a block of this table")
    at = HEAD.size
    names = zlib.decompress(data[at: at + n_names])
    ids = np.frombuffer(names, "<i8", n_docs)
    known = names[8 * n_docs: 9 * n_docs]
    sizes = np.frombuffer(names, "<u4", n_docs, 9 * n_docs)
    docs = [(int(d) if k else None, int(m)) for d, k, m in zip(ids, known, sizes)]
    at += n_names
    mark = 4 + 8 * lanes
    words = np.frombuffer(data, "<u4", n_words, at + mark * n_marks).astype(np.uint64)
    first = checkpoint or 0
    if not n:
        return np.zeros(0, "<u4"), docs
    place = struct.unpack_from("<I", data, at + mark * first)[0]
    states = np.frombuffer(data, "<u8", lanes, at + mark * first + 4).astype(np.uint64)
    start, stop = first * gap, -(-n // lanes)
    if checkpoint is not None:
        stop = min(stop, start + gap)
    mask, shift, word_bits = np.uint64((1 << bits) - 1), np.uint64(bits), np.uint64(32)
    low, out = np.uint64(LOW), []
    for step in range(start, stop):
        x = states[: min(lanes, n - step * lanes)]
        slot = x & mask
        s = table.slots[slot.astype(np.int64)]
        x[:] = table.frequency[s] * (x >> shift) + slot - table.below[s]
        empty = np.flatnonzero(x < low)
        x[empty] = (x[empty] << word_bits) | words[place: place + len(empty)]
        place += len(empty)
        out.append(s)
    if checkpoint is None and (place != n_words or (states != low).any()):
        raise BrokenBlock("states or words are left over")
    return table.tokens[np.concatenate(out)].astype("<u4"), docs


def write_tokens(documents: DataFrame, folder: str, path: str, end_id: int) -> None:
    """Encodes whole texts into a dataset folder. Each text is tokenized once; its ids are kept
    compressed in the shared folder until the counts of all tokens are known."""
    small_batches(documents.sparkSession)
    bounds = shard_bounds(documents)
    kept = materialize(
        documents.select("doc_id", "text").mapInArrow(
            _tokenizing(path, end_id, bounds), "shard int, doc_id long, ids binary, counts binary"
        ),
        "ids",
    )
    # As many rows as the vocabulary has tokens, at most.
    counted = (
        kept.select("counts").filter("counts IS NOT NULL")
        .mapInArrow(_unpacked_counts, "token long, n long")
        .groupBy("token").agg(F.sum("n").alias("n")).orderBy("token").collect()
    )
    spark = documents.sparkSession
    tokens = np.array([r.token for r in counted], dtype=np.int64)
    frequencies = scaled(np.array([r.n for r in counted])) if counted else np.zeros(0, np.int64)
    pairs = list(zip(tokens.tolist(), frequencies.tolist()))
    spark.createDataFrame(pairs, "token long, frequency long").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{folder}/frequencies")

    def encode_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(tokens, frequencies) if len(tokens) else None
        loosen = zstandard.ZstdDecompressor()
        shard, block, start, size = None, 0, 0, 0
        docs: list[tuple[int | None, int]] = []
        held: list[np.ndarray] = []

        def row() -> pa.RecordBatch:
            data = encode_block(table, np.concatenate(held), docs)
            values = [shard, block, start, docs[0][0], len(docs), size, data]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, types)],
                ["shard", "block", "start", "first_doc_id", "n_docs", "n_tokens", "data"],
            )

        for batch in batches:
            for now, doc_id, packed in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if docs and (now != shard or size >= BLOCK_TOKENS):
                    yield row()
                    docs, held, size, block, start = [], [], 0, block + 1, start + size
                if now != shard:
                    shard, block, start = now, 0, 0
                ids = np.frombuffer(loosen.decompress(packed[1:]), f"<u{packed[0]}")
                docs.append((doc_id, len(ids)))
                held.append(ids)
                size += len(ids)
        if docs:
            yield row()

    (
        kept.select("shard", "doc_id", "ids")
        .repartition(len(bounds) + 1, "shard")
        .sortWithinPartitions("shard", "doc_id")
        .mapInArrow(encode_shards, BLOCKS)
        .write.mode("overwrite").parquet(f"{folder}/blocks")
    )


def _packed_ids(ids: np.ndarray, squeeze: zstandard.ZstdCompressor) -> bytes:
    """Ids of 16 bits where they fit, of 32 otherwise, behind a byte that tells which."""
    small = not len(ids) or ids.max() < 1 << 16
    return bytes([2 if small else 4]) + squeeze.compress(ids.astype("<u2" if small else "<u4").tobytes())


def _tokenizing(
    path: str, end_id: int, bounds: np.ndarray
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Shard and packed ids of each row; the first row of a batch also has the counts of all its
    tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path).encode, np.array([end_id], "<u4").tobytes()
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            if not len(batch):
                continue
            doc_ids = batch.column("doc_id").cast(pa.int64())
            known = doc_ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            packed, held, counts = [], [], np.zeros(0, np.int64)
            for text in batch.column("text").to_pylist():
                ids = np.frombuffer(encode(text) + end, "<u4")
                packed.append(_packed_ids(ids, squeeze))
                held.append(ids)
                if len(held) == COUNT_TOGETHER:
                    counts, held = _added(counts, held), []
            counts = _added(counts, held)
            seen = np.flatnonzero(counts)
            first = squeeze.compress(np.stack([seen, counts[seen]]).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.searchsorted(bounds, known, side="left"), pa.int32()),
                    doc_ids,
                    pa.array(packed, pa.binary()),
                    pa.array([first] + [None] * (len(batch) - 1), pa.binary()),
                ],
                ["shard", "doc_id", "ids", "counts"],
            )

    return run


def _added(counts: np.ndarray, held: list[np.ndarray]) -> np.ndarray:
    if not held:
        return counts
    more = np.bincount(np.concatenate(held), minlength=len(counts))
    more[: len(counts)] += counts
    return more


def _unpacked_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    loosen = zstandard.ZstdDecompressor()
    for batch in batches:
        for packed in batch.column("counts").to_pylist():
            seen, n = np.frombuffer(loosen.decompress(packed), "<i8").reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n)], ["token", "n"])


def shard_bounds(documents: DataFrame) -> np.ndarray:
    """Largest doc_id of each shard but the last, from a scan of doc_id alone. Their number
    follows the number of documents, SHARD_DOCUMENTS in each."""
    n = documents.count()
    shards = -(-n // SHARD_DOCUMENTS)
    if shards < 2:
        return np.zeros(0, np.int64)
    shares = [i / shards for i in range(1, shards)]
    found = documents.agg(F.percentile_approx("doc_id", shares, 100 * shards).alias("b")).first()
    return np.unique(np.array(found.b or [], dtype=np.int64))


def read_table(spark: SparkSession, folder: str) -> Table | None:
    """The shared table: a row for each token of the vocabulary at most."""
    rows = spark.read.parquet(f"{folder}/frequencies").orderBy("token").collect()
    if not rows:
        return None
    return Table(np.array([r.token for r in rows]), np.array([r.frequency for r in rows]))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 from a dataset."""
    table = read_table(spark, folder)
    blocks = spark.read.parquet(f"{folder}/blocks")
    # A row per shard; `data` is not read for it.
    sizes = sorted(blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect())
    before, total = {}, 0
    for shard, n in sizes:
        before[shard] = total
        total += n
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, start, data = (batch.column(c) for c in ("shard", "start", "data"))
            for s, at, block in zip(shard.to_pylist(), start.to_pylist(), data):
                ids, docs = decode_block(table, memoryview(block.as_buffer()))
                sizes = np.array([k for _, k in docs], dtype=np.int64)
                ends = np.cumsum(sizes)
                view = memoryview(ids.tobytes())
                crc = [zlib.crc32(view[4 * (e - k): 4 * e]) for e, k in zip(ends, sizes)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([d for d, _ in docs], pa.int64()),
                        pa.array(before[s] + at + ends - sizes),
                        pa.array(sizes),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return blocks.select("shard", "start", "data").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
