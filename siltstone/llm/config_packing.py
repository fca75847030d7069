"""Best-fit packing of token pieces by a configuration linear program.

What matters about a piece is its length, so the problem is a histogram: how many pieces there
are of each length up to the capacity. A configuration is a multiset of lengths that fit into
one sequence; the linear program chooses how often to use each so that all lengths are covered
by as few sequences as possible. It is solved by multiplicative weights: a length that lags
behind gains weight, and a knapsack dynamic program over the capacity finds the configuration
of greatest weight. Multiplicities are rounded down, and the pieces left over are packed best-fit, the
longest first, each time with the fill that wastes least.

The histogram, the configurations and what is sent to the tasks depend on the capacity alone,
never on the number of pieces. Pieces of one length are numbered within salted groups (one
length may hold most pieces), and number r of a length takes the r-th place for that length.

Defined results: a null text is the empty text (its only id is the end id); rows are packed one
by one, also repeated ones and ones without doc_id; an empty table gives no rows; columns other
than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.tokens import encoder
from siltstone.session import materialize

#: Groups into which the pieces of one length are split for numbering.
SALTS = 64
#: Steps of the multiplicative weights, how strongly coverage lowers a weight, and how much more
#: a token counts in the longest pieces than in the shortest, which are kept for the gaps.
STEPS, RATE, TILT = 600, 30.0, 0.2

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


def cut_pieces(documents: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """A row per piece: where it starts in its document, its length and the crc32 of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path).encode, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            ids_of = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids_of, batch.column("text").to_pylist()):
                ids = memoryview(encode(text) + end)
                n = len(ids) // 4
                start, stop = 0, (n - 1) % capacity + 1
                for piece in range(-(-n // capacity)):
                    crc = zlib.crc32(ids[4 * start: 4 * stop])
                    for column, x in zip(columns, (doc_id, piece, start, stop - start, crc)):
                        column.append(x)
                    start, stop = stop, stop + capacity
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                )],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, PIECES)


def best_fills(value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: for each room up to `capacity` the greatest total value of lengths
    that fit, and the last length taken (0: none). `value[0]` is not used."""
    best = np.zeros(capacity + 1)
    last = np.zeros(capacity + 1, dtype=np.int64)
    lengths = np.flatnonzero(value[1:] > 0) + 1
    worth = value[lengths]
    for room in range(1, capacity + 1):
        k = np.searchsorted(lengths, room, side="right")
        best[room] = best[room - 1]
        if k:
            gain = worth[:k] + best[room - lengths[:k]]
            i = int(gain.argmax())
            if gain[i] > best[room]:
                best[room], last[room] = gain[i], lengths[i]
    return best, last


def taken(last: np.ndarray, room: int) -> list[int]:
    """The lengths of the best fill of `room`."""
    out = []
    while room > 0:
        if last[room]:
            out.append(int(last[room]))
            room -= int(last[room])
        else:
            room -= 1
    return out


def configurations(counts: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Lengths of a sequence and how many sequences look so; together exactly `counts`."""
    left = counts.astype(np.int64).copy()
    out: list[tuple[list[int], int]] = []
    if left[capacity]:
        out.append(([capacity], int(left[capacity])))
        left[capacity] = 0
    for config, share in _fractional(left, capacity):
        lengths, need = np.unique(config, return_counts=True)
        times = int(min(share, (left[lengths] // need).min()))
        if times > 0:
            left[lengths] -= times * need
            out.append((config, times))
    return out + _best_fit(left, capacity)


def _fractional(counts: np.ndarray, capacity: int) -> list[tuple[list[int], float]]:
    """Multiplicative weights for the covering program, most used configurations first."""
    lengths = np.flatnonzero(counts)
    if not len(lengths):
        return []
    amount = counts[lengths].astype(float)
    step = float((lengths * amount).sum()) / capacity / STEPS
    if step < 0.02:
        return []  # a few sequences: nothing is left of the shares after rounding
    covered = np.zeros(len(lengths))
    place = {int(x): i for i, x in enumerate(lengths)}
    chosen: dict[tuple[int, ...], float] = {}
    for _ in range(STEPS):
        value = np.zeros(capacity + 1)
        worth = lengths * (1 + TILT * lengths / capacity)
        value[lengths] = worth * np.exp(-RATE * (covered - covered.mean()))
        config = tuple(sorted(taken(best_fills(value, capacity)[1], capacity), reverse=True))
        where, need = np.unique([place[x] for x in config], return_counts=True)
        share = min(step, float((amount[where] / need).min()))
        chosen[config] = chosen.get(config, 0.0) + share
        covered[where] += need * share / amount[where]
    return sorted(((list(c), x) for c, x in chosen.items()), key=lambda cx: (-cx[1], cx[0]))


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Packs what rounding left: the longest piece first, then the fill that wastes least."""
    out, last, known = [], np.zeros(0), np.zeros(0, dtype=bool)
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        if not np.array_equal(known, left > 0):
            known = left > 0
            # A token in a long piece counts a little more: short ones stay for the gaps.
            value = np.where(known, np.arange(capacity + 1) * (1 + 1e-6 * np.arange(capacity + 1)), 0)
            last = best_fills(value, capacity)[1]
        config, room, spare = [longest], capacity - longest, left.copy()
        spare[longest] -= 1
        for length in taken(last, room):
            if spare[length] > 0:
                config.append(length)
                spare[length] -= 1
                room -= length
        while room > 0 and (fits := np.flatnonzero(spare[: room + 1])).size:
            config.append(int(fits[-1]))
            spare[fits[-1]] -= 1
            room -= int(fits[-1])
        lengths, need = np.unique(config, return_counts=True)
        times = int((left[lengths] // need).min())
        left[lengths] -= times * need
        out.append((sorted(config, reverse=True), times))
    return out


def places(configs: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """For each length the runs of its places: the number of the first, its sequence, its offset."""
    rows, reached, sequence = [], {}, 0
    for config, times in configs:
        offset = 0
        for length in config:
            first = reached.get(length, 0)
            rows.append((length, first, sequence, offset))
            reached[length] = first + times
            offset += length
        sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return {"key": (table[:, 0] << 44) + table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds sequence_id and offset (gapless from 0) to pieces of `PIECES`, each 1 to `capacity`
    long. Pieces are written once, so numbering and packing see the same rows."""
    salted = materialize(
        pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)).cast("int")),
        "pieces",
    )
    # At most capacity x SALTS rows, whatever the number of pieces.
    sizes = sorted(salted.groupBy("length", "salt").count().collect())
    counts, before = np.zeros(capacity + 1, dtype=np.int64), {}
    for length, salt, n in sizes:
        before[length * SALTS + salt] = int(counts[length])
        counts[length] += n
    table = places(configurations(counts, capacity))
    firsts = np.zeros((capacity + 1) * SALTS, dtype=np.int64)
    firsts[list(before)] = list(before.values())
    numbered = salted.withColumn(
        "number",
        F.row_number().over(
            Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
        ),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, salt, number = (
                batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                for c in ("length", "salt", "number")
            )
            rank = firsts[length * SALTS + salt] + number - 1
            run_at = np.searchsorted(table["key"], (length << 44) + rank, side="right") - 1
            sequence = table["sequence"][run_at] + rank - (table["key"][run_at] & ((1 << 44) - 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
                + [pa.array(sequence), pa.array(table["offset"][run_at])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return numbered.mapInArrow(run, PACKED)


def pack_documents(
    documents: DataFrame, path: str, capacity: int = 1024, end_id: int = 2
) -> DataFrame:
    """Tokenizes, cuts and packs whole documents."""
    return pack(cut_pieces(documents, path, capacity, end_id), capacity)
