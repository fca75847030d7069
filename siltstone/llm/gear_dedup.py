"""Removal of repeated passages by content-defined chunks.

A gear rolling hash over the last WINDOW bytes decides where a text may be cut: at the start of a
word when the hash falls into one in ONE_IN values (and after MOST_WORDS words at the latest). A cut depends on the bytes right before
it alone, so text that is inserted or removed elsewhere does not move it, and two texts that
share a passage share its chunks, but for the first few words.

A chunk counts together with the one before it: a digest of two neighbours. The first place of a
digest, in order of doc_id, keeps its text. At every other place both chunks are repeats, and a run of repeated chunks of
LEAST_WORDS words or more is cut out. Shorter repeats (phrases, licence lines) stay.

A task brings its own chunks into order first and hands on one place per digest, so a passage that a third of all
documents has reaches the shuffle as one row per task chunk.

Defined results: a null text stays null and has no chunks; rows equal in doc_id and text are one
document; order is by doc_id, then text hash, rows without doc_id last; all other columns are
carried along; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.text import free_name

#: Bytes that the rolling hash looks back on, words to a cut on average, most words of a chunk,
#: and words from which a repeated run is cut out.
WINDOW, ONE_IN, MOST_WORDS, LEAST_WORDS = 16, 4, 32, 20
#: Digests that a task brings into order at a time.
CHUNK = 700_000
NO_ID = np.iinfo(np.int64).max

GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)
BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Rolling hash at each byte: the sum of the last WINDOW gears, each shifted by its age.
    Doubling the window four times gives what the usual loop over bytes gives."""
    h, width = GEAR[data], 1
    while width < WINDOW:
        older = np.zeros_like(h)
        older[width:] = h[:-width] << np.uint32(width)
        h, width = h + older, 2 * width
    return h


def chunks(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the chunks of a text in bytes, and the number of words in each."""
    b = np.frombuffer(data, np.uint8)
    if not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    blank = BLANK[b]
    words = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
    if not len(words):
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    # The hash of the bytes before a word decides whether it starts a chunk.
    hashed = gear_hashes(b)[np.maximum(words - 1, 0)]
    cut = (hashed >> np.uint32(16)) % np.uint32(ONE_IN) == 0
    cut[0] = True
    number = np.arange(len(words))
    last = np.maximum.accumulate(np.where(cut, number, 0))
    cut |= (number - last) % MOST_WORDS == 0
    first = np.flatnonzero(cut)
    starts = words[first].astype(np.int64)
    starts[0] = 0
    return starts, np.diff(np.r_[first, len(words)])


def pair_digests(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Digest of each chunk with the one before it, for the second chunk on."""
    ends = np.r_[starts[1:], len(data)]
    # White space at the edges does not count: a passage may end a line here and not there.
    own = np.array([
        xxhash.xxh3_64_intdigest(data[s:e].strip()) for s, e in zip(starts.tolist(), ends.tolist())
    ], dtype=np.uint64)
    mix = own[:-1] * np.uint64(0x9E3779B97F4A7C15)
    return ((mix ^ (mix >> np.uint64(29))) + own[1:]).view(np.int64)


def text_hash(data: bytes) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(data)).view(np.int64))


REPEATS = "doc_id long, text_hash long, place int"


def repeated_places(documents: DataFrame) -> DataFrame:
    """doc_id, text_hash, place: every pair of chunks that stands somewhere before as well;
    `place` is the number of its second chunk."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        owners: list[tuple[int, int, int]] = []
        total = 0

        def flush() -> pa.RecordBatch:
            digest = np.concatenate(held)
            counts = [k for *_, k in owners]
            doc = np.repeat(np.array([d for d, *_ in owners], np.int64), counts)
            text = np.repeat(np.array([t for _, t, _ in owners], np.int64), counts)
            place = np.concatenate([np.arange(1, k + 1, dtype=np.int32) for k in counts])
            order = np.lexsort((place, text, doc, digest))
            digest, doc, text, place = digest[order], doc[order], text[order], place[order]
            repeat = np.r_[False, digest[1:] == digest[:-1]]
            # The same place twice is a repeated row.
            twice = repeat & np.r_[False, (doc[1:] == doc[:-1]) & (text[1:] == text[:-1]) & (place[1:] == place[:-1])]
            keep = ~twice
            deal = np.where(repeat, text + place, digest)
            return pa.RecordBatch.from_arrays(
                [pa.array(x[keep]) for x in (deal, repeat, digest, doc, text, place)],
                ["deal", "repeat", "digest", "doc_id", "text_hash", "place"],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                data = (text or "").encode()
                found = pair_digests(data, chunks(data)[0])
                if len(found):
                    held.append(found)
                    owners.append((NO_ID if doc_id is None else doc_id, text_hash(data), len(found)))
                    total += len(found)
                if total >= CHUNK:
                    yield flush()
                    held, owners, total = [], [], 0
        if held:
            yield flush()

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, first = None, ()
        for batch in batches:
            repeat, digest, doc, text, place = (
                batch.column(c).to_numpy(zero_copy_only=False)
                for c in ("repeat", "digest", "doc_id", "text_hash", "place")
            )
            # Rows that are repeats within their task come first in a partition, sorted apart.
            found = repeat.copy()
            own = np.flatnonzero(~repeat)
            if len(own):
                d, where = digest[own], (doc[own], text[own], place[own])
                new = np.r_[last is None or d[0] != last, d[1:] != d[:-1]]
                leader = np.maximum.accumulate(np.where(new, np.arange(len(d)), -1))
                # A row that equals the first place of its digest is a repeated row.
                same = np.ones(len(d), dtype=bool)
                for k, x in enumerate(where):
                    same &= x == np.where(leader >= 0, x[np.maximum(leader, 0)], first[k] if first else 0)
                found[own] = ~new & ~same
                if leader[-1] >= 0:
                    first = tuple(x[leader[-1]] for x in where)
                last = d[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[found]) for x in (doc, text, place)], ["doc_id", "text_hash", "place"]
            )

    return (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(
            local,
            "deal long, repeat boolean, digest long, doc_id long, text_hash long, place int",
        )
        .repartition("deal")
        .sortWithinPartitions("repeat", "digest", "doc_id", "text_hash", "place")
        .select("repeat", "digest", "doc_id", "text_hash", "place")
        .mapInArrow(across, REPEATS)
    )


def repeated_spans(data: bytes, places: list[int] | None) -> list[tuple[int, int]]:
    """Byte ranges of the runs of repeated chunks that are long enough."""
    if not places:
        return []
    starts, words = chunks(data)
    at = np.array(sorted(places))
    repeated = np.zeros(len(starts) + 2, dtype=bool)
    repeated[at + 1] = True  # shifted by one, so that both ends are False
    repeated[at] = True
    edges = np.flatnonzero(repeated[1:] != repeated[:-1])
    ends = np.r_[starts, len(data)]
    before = np.r_[0, np.cumsum(words)]
    return [
        (int(ends[a]), int(ends[b]))
        for a, b in zip(edges[::2], edges[1::2]) if before[b] - before[a] >= LEAST_WORDS
    ]


def without(data: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without the spans, which begin and end at words."""
    at, kept = 0, []
    for start, stop in spans:
        kept.append(data[at:start])
        at = stop
    return b"".join([*kept, data[at:]]).decode().strip() if spans else data.decode()


def remove_repeats(documents: DataFrame) -> DataFrame:
    """All columns of `documents`, `text` without repeated passages, and the columns
    `removed_spans` (byte ranges of the old text) and `removed_bytes`."""
    columns = documents.columns
    doc, digest, at = (free_name(documents, n) for n in ("_doc", "_hash", "_places"))
    lists = (
        repeated_places(documents)
        .groupBy("doc_id", "text_hash").agg(F.collect_list("place").alias(at))
        .withColumnRenamed("doc_id", doc).withColumnRenamed("text_hash", digest)
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            data = [None if t is None else t.encode() for t in texts]
            arrays = [
                pa.array([None if d is None else zlib.compress(d, 1) for d in data], pa.binary())
                if c == "text" else batch.column(c) for c in columns
            ]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array([text_hash(d or b"") for d in data], pa.int64())],
                [*columns, digest],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for packed, places in zip(
                batch.column("text").to_pylist(), batch.column(at).to_pylist()
            ):
                data = None if packed is None else zlib.decompress(packed)
                found = repeated_spans(data, places) if data else []
                spans.append(found)
                texts.append(None if data is None else without(data, found))
            kinds = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in columns]
                + [
                    pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], kinds),
                    pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
                ],
                [*columns, "removed_spans", "removed_bytes"],
            )

    fields = {f.name: f.dataType.simpleString() for f in documents.schema.fields}
    packed = documents.mapInArrow(
        hashed,
        ", ".join(f"`{c}` {'binary' if c == 'text' else k}" for c, k in fields.items())
        + f", `{digest}` long",
    ).withColumn(doc, F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))))
    joined = packed.join(lists.hint("merge"), [doc, digest], "left").select(*columns, at)
    return joined.mapInArrow(
        cut,
        ", ".join(f"`{c}` {k}" for c, k in fields.items())
        + ", removed_spans array<struct<start:bigint,stop:bigint>>, removed_bytes long",
    )
