"""Size-aware heavy-light similarity join on sets of word shingles.

Two sets link when their Jaccard similarity is at least 9/10. Exact copies are one vertex (a hash
of the set), so the join is over distinct sets.

Light sets, up to a size boundary, enumerate fixed-size subsets. Linked sets A and B share the
subset A and B have in common, which is A without at most a tenth of its shingles; so each light
set signs with all its subsets of size n, n - 1, ... down to nine tenths. Sets just above the
boundary sign in the same way, as they can link with light ones.

Heavy sets go into inverted lists, which are scanned. A list of a single shingle would be as long as
the shingle is common. But linked sets differ in at most D = n / 9 shingles (n: size of the
smaller), so if shingles are dealt by hash to D + 1 blocks, some block is the same in both: lists
are kept per block content, about eight shingles. A block of at most one shingle would make a
long list; it is joined with the block after it, once as it is and once without each of its
shingles, which misses no link (if each agreeing block is that small, some of them is followed
by a block with at most one difference). Sets of different sizes meet because a set is listed
under the size bands of all smaller partners.

The boundary is the one of least cost over the histogram of sizes: rows written for subsets
against rows for lists, each with the price of checking what they bring together.

Parity sketches rule pairs out before sets are fetched: bits, each the parity of the shingles
that hash to it. Bits that differ are at most as many as shingles that differ, so a pair with
more of them than linked sets can differ in does not link. Each set has one of 512 bits, and a
fine one of at least as many bits as shingles, a 64th of the set; of two fine sketches the longer
is folded to the length of the shorter. What is left are nearly all links, and the sets of these
alone are hashed once more and moved.

No list gives all its pairs. Within a task, and then over all tasks, a list gives one pair per
member: with its first member, the hub. Pairs are checked exactly, links give components. A
subset list is complete once every member is paired with its smallest set over all tasks: if A and
B link, then in the list of what they have in common the smallest set, which has that too and is
no larger, links to both. An inverted list whose members then still lie in several components is worked on further, member by member as
new hub, until every pair of its members is either in one component or was checked. So nothing is
lost, and a group of thousands of near copies costs a pair each instead of a square. Near copies that do
not link are paired with each other, though in one list or few of the many that they share.

Defined results: null and blank texts have the empty set and stand alone; rows with equal sets
link, whatever their doc_ids; rows without doc_id link like others but are never the
component's name (null if all are such); repeated rows give repeated rows; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations, islice
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.bit_filter import bitmap, passing
from siltstone.llm.components import components
from siltstone.session import materialize

@dataclass(frozen=True)
class Rule:
    """Words of a shingle, and the least similarity of linked sets in percent."""

    words: int
    percent: int


#: The rule of op2_jaccard_join. The bounds in the text above are those of its nine tenths.
RULE = Rule(3, 90)
#: A size boundary to choose from, and rows that the check of a listed pair is worth.
BOUNDARIES, CHECK_COST = (9, 19, 29), 8
#: Ratio of the size bands of heavy sets.
BAND = 1.5
#: Shingles (subsets, of light sets) of the sets that a task lists at a time.
CHUNK = 250_000
#: New hubs of a list in the first round of further work, and pairs of a list that a later one may look at.
FIRST_HUBS, ROUND_PAIRS = 8, 50_000_000
#: Lists of a set that its rows carry, to tell what it meets in a lesser list as well.
FIRST_LISTS = 16
#: Pairs up to which sets are fetched without a look at the fine sketches, which costs more steps than it saves.
FEW_PAIRS = 4000

MIX = np.uint64(0x9E3779B97F4A7C15)
FOLD = np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread out."""
    x = (x ^ (x >> np.uint64(30))) * FOLD
    return x ^ (x >> np.uint64(29))


class _WordHashes(dict):
    """Word -> its hash as little-endian bytes."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > 150_000:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word).to_bytes(8, "little")
        return found


WORD_HASHES = _WordHashes()


def shingle_set(text: str | None, words_each: int = RULE.words) -> np.ndarray:
    """Sorted distinct hashes of the shingles: runs of words, or all words if there are fewer."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.frombuffer(b"".join(map(WORD_HASHES.__getitem__, words)), dtype="<u8")
    if len(h) < words_each:
        return mixed(np.array([xxhash.xxh3_64_intdigest(h.tobytes())], dtype=np.uint64))
    out = h[: len(h) - words_each + 1].copy()
    for i in range(1, words_each):
        out = mixed(out * MIX + h[i: len(h) - words_each + 1 + i])
    return np.unique(out)


def linked(shared: int, n_a: int, n_b: int, rule: Rule = RULE) -> bool:
    return 100 * shared >= rule.percent * (n_a + n_b - shared)


def largest_partner(n: int, rule: Rule = RULE) -> int:
    return n * 100 // rule.percent


def band_of(n: int) -> int:
    """Number of the size band of n; band k covers sizes from band_start(k)."""
    k = 0
    while band_start(k + 1) <= n:
        k += 1
    return k


def band_start(k: int) -> int:
    return int(np.ceil(8 * BAND**k)) if k else 0


@lru_cache(maxsize=50_000)
def bands(n: int, rule: Rule = RULE) -> range:
    """Bands under which a set of n shingles is listed: its own and those of smaller partners."""
    return range(band_of(-(-rule.percent * n // 100)), band_of(n) + 1)


def blocks_of(band: int, rule: Rule = RULE) -> int:
    """Blocks for pairs whose smaller set is in the band: one more than they can differ."""
    return (band_start(band + 1) - 1) * (100 - rule.percent) // rule.percent + 1


def left_out(n: int, rule: Rule = RULE) -> int:
    """Shingles of a set of n that a linked set can lack, at most."""
    return n * (100 - rule.percent) // 100


def subsets_cost(n: int, rule: Rule = RULE) -> int:
    return sum(comb(n, j) for j in range(left_out(n, rule) + 1))


def lists_cost(n: int, rule: Rule = RULE) -> float:
    return (1 + CHECK_COST) * sum(blocks_of(k, rule) for k in bands(n, rule))


def best_boundary(sizes: dict[int, int], rule: Rule = RULE) -> int:
    """The boundary of least cost; `sizes` counts the sets of each size up to the largest
    boundary's partners (all others cost the same under each)."""
    top = largest_partner(max(BOUNDARIES), rule)

    def cost(x: int) -> float:
        return sum(
            times * (
                subsets_cost(n, rule) * (n <= largest_partner(x, rule)) + lists_cost(n, rule) * (n > x)
            )
            for n, times in sizes.items() if n <= top
        )

    return min(BOUNDARIES, key=lambda x: (cost(x), x))


def digest(parts: np.ndarray, tag: int) -> int:
    return xxhash.xxh3_64_intdigest(parts.tobytes(), seed=tag)


def _sealed(sums: np.ndarray, tag: np.ndarray | np.uint64) -> np.ndarray:
    """Signatures of parts of sets, each given by the sum of its shingles' hashes."""
    return mixed(mixed(sums * MIX + tag) * MIX)


def _subset_signatures(x: np.ndarray, rule: Rule) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Signatures, and rows of x they belong to, of sets of the same size (a row each)."""
    n = x.shape[1]
    hashes = mixed(x * MIX)
    totals = hashes.sum(axis=1, dtype=np.uint64)
    for j in range(left_out(n, rule) + 1):
        out = combinations(range(n), j)
        while picked := list(islice(out, 10_000)):
            at = np.array(picked, dtype=np.int64).reshape(len(picked), j)
            step = max(1, 100_000 // (len(picked) * max(1, j)))
            for i in range(0, len(x), step):
                left = totals[i: i + step, None] - hashes[i: i + step][:, at].sum(axis=2, dtype=np.uint64)
                rows = np.repeat(np.arange(i, i + len(left)), len(picked))
                yield _sealed(left.ravel(), MIX) & ~np.uint64(1), rows


def _block_signatures(sets: list[np.ndarray], band: int, rule: Rule) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Signatures of the blocks of sets under a band, and the numbers of their sets."""
    m, many = blocks_of(band, rule), len(sets)
    s = np.concatenate(sets)
    row = np.repeat(np.arange(many), [len(x) for x in sets])
    block = mixed(s ^ np.uint64(band + 1))
    cell = row * m + (block % np.uint64(m)).astype(np.int64)
    order = np.argsort(cell, kind="stable")
    hashes = mixed(block[order] * MIX)
    counts = np.bincount(cell, minlength=many * m)
    ends = np.r_[0, np.cumsum(counts)]
    upto = np.r_[np.uint64(0), np.cumsum(hashes, dtype=np.uint64)]
    sums = upto[ends[1:]] - upto[ends[:-1]]
    number = np.arange(many * m)
    tag = mixed((np.uint64(band << 32) + (number % m).astype(np.uint64)) * MIX)
    large = counts > 1
    yield _sealed(sums[large], tag[large]) | np.uint64(1), number[large] // m
    small = np.flatnonzero(~large)
    after = small // m * m + (small % m + 1) % m
    both, tag = sums[small] + sums[after], ~tag[small]
    yield _sealed(both, tag) | np.uint64(1), small // m
    times = counts[after]
    entry = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(ends[after], times)
    yield _sealed(np.repeat(both, times) - hashes[entry], np.repeat(tag, times)) | np.uint64(1), np.repeat(small // m, times)


def signatures_of(
    sets: list[np.ndarray], boundary: int, rule: Rule = RULE
) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of sets, and the number of the set of each. The last bit tells subsets (0) from lists (1).

    A part of a set is named by the sum of its shingles' hashes, so that a part less one shingle is a
    difference; sums of all sets of a band are taken together."""
    by_size, by_band = defaultdict(list), defaultdict(list)
    for i, s in enumerate(sets):
        if len(s) <= largest_partner(boundary, rule):
            by_size[len(s)].append(i)
        if len(s) > boundary:
            for band in bands(len(s), rule):
                by_band[band].append(i)
    sigs, rows = [], []

    def add(found: Iterator[tuple[np.ndarray, np.ndarray]], at: list[int]) -> None:
        for sig, row in found:
            sigs.append(sig)
            rows.append(np.array(at)[row])

    for n, at in by_size.items():
        add(_subset_signatures(np.array([sets[i] for i in at]).reshape(len(at), n), rule), at)
    for band, at in by_band.items():
        add(_block_signatures([sets[i] for i in at], band, rule), at)
    none = np.zeros(0, np.int64)
    return np.concatenate([none.view(np.uint64), *sigs]), np.concatenate([none, *rows])


def signatures(s: np.ndarray, boundary: int, rule: Rule = RULE) -> list[int]:
    """Signatures of one set."""
    return signatures_of([s], boundary, rule)[0].tolist()


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def vertex_of(s: np.ndarray) -> int:
    return int(np.uint64(digest(s, 7)).view(np.int64)) if len(s) else 0


#: Bits of the parity sketch (column parity, an array of 64-bit numbers).
PARITY_BITS = 512
#: Bits of the sketch that larger sets have besides (column wide), for the pairs of open lists.
WIDE_BITS = 2048


def parities(s: np.ndarray, bits: int = 256) -> np.ndarray:
    """Parity sketch of a set as 64-bit numbers."""
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).view("<i8")


def fine_sketch(s: np.ndarray) -> bytes:
    """Parity sketch of a power of two of bits, no fewer than shingles."""
    bits = PARITY_BITS
    while bits < len(s):
        bits *= 2
    return parities(s, bits).tobytes()


def fine_apart(a: np.ndarray, b: np.ndarray) -> int:
    """Bits in which two fine sketches (64-bit numbers) differ at the length of the shorter."""
    if len(a) > len(b):
        a, b = b, a
    folded = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    return int(np.bitwise_count(folded ^ a).sum())


def apart(a: str, b: str) -> Column:
    """Bits in which the parity sketches of two sets differ."""
    return sum(
        F.bit_count(F.get(f"{a}parity", i).bitwiseXOR(F.get(f"{b}parity", i))) for i in range(PARITY_BITS // 64)
    )


def apart_wide(a: str, b: str) -> Column:
    """Bits in which the wide sketches of two sets differ; null if one has none. A short expression, as
    few pairs come to it."""
    bits = F.zip_with(f"{a}wide", f"{b}wide", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda total, x: total + x)


def may_link(a: str, b: str, rule: Rule = RULE) -> Column:
    """Whether two sets, given by the prefixes of their columns, can link by size and sketch:
    linked sets differ in (1 - t) / (1 + t) of their sizes' sum at most, t being the similarity."""
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    sizes = 100 * F.least(n, m) >= rule.percent * F.greatest(n, m)
    return sizes & ((100 + rule.percent) * apart(a, b) <= (100 - rule.percent) * (n + m))


def may_link_wide(a: str, b: str, rule: Rule = RULE) -> Column:
    """may_link by the wide sketches as well, if both sets have one."""
    most = (100 - rule.percent) * (F.col(f"{a}n") + F.col(f"{b}n"))
    wide = (100 + rule.percent) * apart_wide(a, b) <= most
    return may_link(a, b, rule) & F.coalesce(wide, F.lit(True))


def summaries(documents: DataFrame, rule: Rule = RULE) -> DataFrame:
    """doc_id, row_key (a hash of doc_id and text), n_shingles, vertex and sketches of every row; an
    empty set is no vertex. Sets of more than PARITY_BITS shingles have a wide sketch as well."""
    numbers = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, rule.words) for t in batch.column("text").to_pylist()]
            wide = [parities(s, WIDE_BITS) if len(s) > PARITY_BITS else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    batch.column("row_key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([vertex_of(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([fine_sketch(s) for s in sets], pa.binary()),
                    pa.array([parities(s, PARITY_BITS) for s in sets], numbers),
                    pa.array(wide, numbers),
                ],
                ["doc_id", "row_key", "n_shingles", "vertex", "fine", "parity", "wide"],
            )

    return documents.select("doc_id", "text", row_key().alias("row_key")).mapInArrow(
        run,
        "doc_id long, row_key long, n_shingles long, vertex long, fine binary, "
        "parity array<long>, wide array<long>",
    )


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def _distinct_sets(
    batches: Iterator[pa.RecordBatch], rule: Rule
) -> Iterator[tuple[int, np.ndarray]]:
    """Vertex and set of each distinct set of a task (copies far apart may come again)."""
    seen: set[int] = set()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            s = shingle_set(text, rule.words)
            if not len(s) or (v := vertex_of(s)) in seen:
                continue
            if len(seen) > 200_000:
                seen.clear()
            seen.add(v)
            yield v, s


def _postings(
    batches: Iterator[pa.RecordBatch], boundary: int, rule: Rule
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Signatures, vertices and sizes of a task, for sets of about CHUNK shingles at a time."""
    for vertices, sets in _chunks(_distinct_sets(batches, rule), boundary, rule):
        sig, row = signatures_of(sets, boundary, rule)
        sizes = np.array([len(s) for s in sets], dtype=np.int32)
        yield signed(sig), np.array(vertices, dtype=np.int64)[row], sizes[row]


def _chunks(
    found: Iterator[tuple[int, np.ndarray]], boundary: int, rule: Rule
) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Vertices and sets, as many at a time as have about CHUNK shingles or subsets."""
    vertices, sets, held = [], [], 0
    for v, s in found:
        vertices.append(v)
        sets.append(s)
        held += subsets_cost(len(s), rule) if len(s) <= largest_partner(boundary, rule) else len(s)
        if held >= CHUNK:
            yield vertices, sets
            vertices, sets, held = [], [], 0
    if sets:
        yield vertices, sets


PAIRS = "vertex long, hub long, sig long, across boolean"


def hub_pairs(documents: DataFrame, boundary: int, rule: Rule = RULE) -> DataFrame:
    """vertex, hub, sig, across: for each list, every member but the hub with a hub. A task pairs its
    own members first and hands on one member per list, so even a list that holds a third of all
    sets reaches the shuffle as one row per chunk. `across`: the hub of a chunk with that of all."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sig, vertex, n in _postings(batches, boundary, rule):
            order = np.lexsort((vertex, n, sig))
            sig, vertex, n = sig[order], vertex[order], n[order]
            first = np.r_[True, sig[1:] != sig[:-1]]
            hub = vertex[np.maximum.accumulate(np.where(first, np.arange(len(sig)), 0))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(~first), pa.array(np.where(first, 0, hub)), pa.array(sig),
                    pa.array(vertex), pa.array(n),
                ],
                ["paired", "hub", "sig", "vertex", "n"],
            )

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_sig, last_hub = None, 0
        for batch in batches:
            paired, sig, vertex, hub = (
                batch.column(c).to_numpy(zero_copy_only=False)
                for c in ("paired", "sig", "vertex", "hub")
            )
            hub = hub.copy()
            free = np.flatnonzero(~paired)
            if len(free):
                s = sig[free]
                first = np.r_[last_sig is None or s[0] != last_sig, s[1:] != s[:-1]]
                start = np.maximum.accumulate(np.where(first, np.arange(len(s)), -1))
                hub[free] = np.where(start >= 0, vertex[free][np.maximum(start, 0)], last_hub)
                last_sig, last_hub = s[-1], hub[free[-1]]
            keep = hub != vertex
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(vertex[keep]), pa.array(hub[keep]), pa.array(sig[keep]),
                    pa.array(~paired[keep]),
                ],
                ["vertex", "hub", "sig", "across"],
            )

    # What most rows have in common stands together, which is what the shuffle compresses.
    return (
        documents.select("text")
        .mapInArrow(local, "paired boolean, hub long, sig long, vertex long, n int")
        .repartition(F.when(F.col("paired"), F.col("vertex")).otherwise(F.col("sig")))
        .sortWithinPartitions("paired", "sig", "n", "vertex")
        .mapInArrow(across, PAIRS)
    )


def to_smallest(pairs: DataFrame) -> DataFrame:
    """vertex, hub, sig: in lists of subsets, members that their chunk paired with its own smallest
    set are paired with the smallest set of all instead."""
    subsets = pairs.filter("(sig & 1) = 0")
    smallest = subsets.filter("across").select(
        "sig", F.col("vertex").alias("hub"), F.col("hub").alias("smallest")
    ).distinct()
    moved = (
        subsets.filter("NOT across").join(smallest.hint("merge"), ["sig", "hub"], "left")
        .select("vertex", F.coalesce("smallest", "hub").alias("hub"), "sig")
    )
    rest = pairs.filter("(sig & 1) = 1 OR across").select("vertex", "hub", "sig")
    return rest.union(moved.filter("vertex <> hub"))


def chosen_texts(
    documents: DataFrame, docs: DataFrame, vertices: DataFrame, rule: Rule
) -> tuple[DataFrame, Callable[[pa.RecordBatch], Iterator[np.ndarray]]]:
    """Rows to hash once more for the given vertices, and what gives their sets in a task. One row of
    each vertex is chosen: a filter of fixed size over the row keys lets it pass, and few others."""
    chosen = (
        docs.select("vertex", "row_key").join(vertices.hint("merge"), "vertex", "left_semi")
        .groupBy("vertex").agg(F.min("row_key").alias("row_key"))
    )
    rows = documents.sparkSession.sparkContext.broadcast(bitmap(chosen, "row_key"))

    def sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        key, text = batch.column("row_key").to_numpy().view(np.uint64), batch.column("text")
        for i in np.flatnonzero(passing(rows.value, key)).tolist():
            s = shingle_set(text[i].as_py(), rule.words)
            if len(s):
                yield s

    return documents.select("text", row_key().alias("row_key")), sets


def sets_of(
    documents: DataFrame, docs: DataFrame, vertices: DataFrame, rule: Rule = RULE
) -> DataFrame:
    """vertex, shingles (64-bit numbers) of the given vertices."""
    texts, sets = chosen_texts(documents, docs, vertices, rule)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, held = [], 0
            for s in sets(batch):
                found.append((vertex_of(s), s.tobytes()))
                held += len(s)
                if held > CHUNK:
                    yield made(found)
                    found, held = [], 0
            yield made(found)

    def made(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([v for v, _ in found], pa.int64()), pa.array([s for _, s in found], pa.binary())],
            ["vertex", "shingles"],
        )

    hashed = texts.mapInArrow(run, "vertex long, shingles binary")
    return hashed.join(vertices.hint("merge"), "vertex", "left_semi").dropDuplicates(["vertex"])


def members_of(
    documents: DataFrame, docs: DataFrame, pairs: DataFrame, sigs: DataFrame, boundary: int, rule: Rule = RULE
) -> DataFrame:
    """sig, vertex: all members of the given lists, each of which is an end of a pair."""
    texts, sets = chosen_texts(documents, docs, ends_of(pairs), rule)
    lists = documents.sparkSession.sparkContext.broadcast(bitmap(sigs, "sig"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_task = ((vertex_of(s), s) for batch in batches for s in sets(batch))
        for vertices, some in _chunks(of_task, boundary, rule):
            sig, row = signatures_of(some, boundary, rule)
            listed = passing(lists.value, sig)
            vertex = np.array(vertices, dtype=np.int64)[row[listed]]
            yield pa.RecordBatch.from_arrays([pa.array(signed(sig[listed])), pa.array(vertex)], ["sig", "vertex"])

    found = texts.mapInArrow(run, "sig long, vertex long")
    return found.join(sigs.hint("merge"), "sig", "left_semi").distinct()


def sketches_of(docs: DataFrame, members: DataFrame) -> DataFrame:
    """vertex, n and sketches of the sets in the given lists."""
    known = docs.filter("vertex IS NOT NULL").select("vertex", F.col("n_shingles").alias("n"), "parity", "wide")
    chosen = members.select("vertex").distinct()
    return known.join(chosen.hint("merge"), "vertex", "left_semi").dropDuplicates(["vertex"])


def possible(pairs: DataFrame, docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """The pairs (vertex, hub) that size and sketch do not rule out, and how far their sketches are apart."""
    known = docs.filter("vertex IS NOT NULL").select(
        "vertex", F.col("n_shingles").alias("n"), "parity"
    ).dropDuplicates(["vertex"])
    one = known.select("vertex", *(F.col(c).alias(f"a_{c}") for c in ("n", "parity")))
    two = known.select(F.col("vertex").alias("hub"), *(F.col(c).alias(f"b_{c}") for c in ("n", "parity")))
    both = pairs.join(one, "vertex").join(two, "hub")
    return both.filter(may_link("a_", "b_", rule)).select("vertex", "hub", apart("a_", "b_").alias("apart"))


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select("vertex").union(pairs.select(F.col("hub").alias("vertex"))).distinct()


def near(pairs: DataFrame, docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """The pairs (vertex, hub) that fine sketches do not rule out."""
    ends = pairs.sparkSession.sparkContext.broadcast(bitmap(ends_of(pairs), "vertex"))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passing(ends.value, batch.column("vertex").to_numpy().view(np.uint64))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("x_n", "y_n"))
            differ = np.array([
                fine_apart(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64))
                for x, y in zip(batch.column("x"), batch.column("y"))
            ], dtype=np.int64)
            good = pa.array((100 + rule.percent) * differ <= (100 - rule.percent) * (n + m))
            yield batch.select(["vertex", "hub"]).filter(good)

    known = (
        docs.filter("vertex IS NOT NULL").select("vertex", "n_shingles", "fine")
        .mapInArrow(held, "vertex long, n_shingles long, fine binary").dropDuplicates(["vertex"])
    )
    one = known.select("vertex", F.col("n_shingles").alias("x_n"), F.col("fine").alias("x"))
    two = known.select(
        F.col("vertex").alias("hub"), F.col("n_shingles").alias("y_n"), F.col("fine").alias("y")
    )
    return pairs.join(one, "vertex").join(two, "hub").mapInArrow(run, "vertex long, hub long")


def checked(
    pairs: DataFrame, documents: DataFrame, docs: DataFrame, rule: Rule = RULE
) -> DataFrame | None:
    """Edges a, b: the pairs (vertex, hub) that link, by the sizes of their intersections; None if
    there are none."""
    left = materialize(pairs, "pairs")
    count = left.count()
    if count > FEW_PAIRS:
        left = materialize(near(left, docs, rule), "near-pairs")
        count = left.count()
    if not count:
        return None
    sets = materialize(sets_of(documents, docs, ends_of(left), rule), "candidates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("x"), batch.column("y")):
                one, two = (np.frombuffer(s.as_buffer(), np.uint64) for s in (a, b))
                small, large = sorted((len(one), len(two)))
                good = 100 * small >= rule.percent * large
                if good:
                    both = np.sort(np.concatenate([one, two]), kind="stable")
                    good = linked(int((both[1:] == both[:-1]).sum()), small, large, rule)
                keep.append(good)
            found = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [found.column("vertex"), found.column("hub")], ["a", "b"]
            )

    one = sets.select("vertex", F.col("shingles").alias("x"))
    two = sets.select(F.col("vertex").alias("hub"), F.col("shingles").alias("y"))
    found = materialize(
        left.join(one, "vertex").join(two, "hub").mapInArrow(run, "a long, b long"), "links"
    )
    return None if found.isEmpty() else found


def unresolved(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Lists of three members or more (two pairs) of which a pair lies in two components. Lists
    of subsets are complete after one star, see to_smallest()."""
    named = _with_root(_with_root(pairs.filter("(sig & 1) = 1"), roots, "vertex"), roots, "hub")
    return (
        named.groupBy("sig")
        .agg(F.count("*").alias("n"), F.max(F.expr("vertex_root <> hub_root")).alias("open"))
        .filter("n > 1 AND open").select("sig")
    )


def _with_root(rows: DataFrame, roots: DataFrame, column: str) -> DataFrame:
    named = roots.select(F.col("vertex").alias(column), F.col("root").alias("_root"))
    return rows.join(named, column, "left").withColumn(
        f"{column}_root", F.coalesce("_root", column)
    ).drop("_root")


def next_pairs(
    members: DataFrame, known: DataFrame, done: DataFrame, roots: DataFrame, most: int, rule: Rule = RULE
) -> tuple[DataFrame, DataFrame]:
    """New hubs (sig, vertex) and their pairs with the members of other components. Hubs come
    from outside the largest component of their list, `most` of a list and as many as keep a round
    small. The first round takes few: what links joins then, and is not paired over and over. Two hubs
    of a list are paired once: a member before the hub is a hub as well, or was one, if it could be.
    `known` has the sketches, which reach the rows only where these meet."""
    named = _with_root(members, roots, "vertex").withColumnRenamed("vertex_root", "root")
    parts = named.groupBy("sig", "root").agg(F.count("*").alias("size"))
    lists = parts.groupBy("sig").agg(
        F.sum("size").alias("members"), F.count("*").alias("parts"),
        F.max(F.struct("size", "root")).alias("largest"),
    ).filter("parts > 1").selectExpr("sig", "members", "largest.root AS largest")
    # Written, as is what rows carry to a meeting: of one query of all this, the driver would plan the
    # whole anew after each of its many stages.
    open_rows = materialize(named.join(lists, "sig"), "open-rows")
    rank = F.row_number().over(Window.partitionBy("sig").orderBy("vertex"))
    hubs = materialize(
        open_rows.filter("root <> largest").join(done, ["sig", "vertex"], "left_anti")
        .withColumn("rank", rank)
        .filter(F.col("rank") <= F.greatest(F.lit(1), F.least(F.lit(most), F.lit(ROUND_PAIRS) / F.col("members"))))
        .select(F.col("sig").alias("hub_sig"), F.col("vertex").alias("hub"), F.col("root").alias("hub_root")),
        "hubs",
    )
    pairs = meetings(open_rows, hubs, known, rule).distinct()
    return hubs.select(F.col("hub_sig").alias("sig"), F.col("hub").alias("vertex")), pairs


def first_lists(rows: DataFrame, sig: str, vertex: str) -> DataFrame:
    """vertex, firsts: the least FIRST_LISTS lists of each."""
    least = F.slice(F.sort_array(F.collect_list(sig)), 1, FIRST_LISTS)
    return rows.groupBy(vertex).agg(least.alias("firsts"))


def carried(known: DataFrame, rows: DataFrame, sig: str, vertex: str, prefix: str) -> DataFrame:
    """What the rows of a set carry to a meeting: size, sketches and first lists, under a prefix."""
    both = known.join(first_lists(rows, sig, vertex).withColumnRenamed(vertex, "vertex"), "vertex")
    own = (F.col(c).alias(f"{prefix}{c}") for c in ("n", "parity", "wide", "firsts"))
    return materialize(both.select(F.col("vertex").alias(vertex), *own), "carried")


def meetings(open_rows: DataFrame, hubs: DataFrame, known: DataFrame, rule: Rule = RULE) -> DataFrame:
    """vertex, hub: members and hubs of a list that may link. Near copies share most of their lists, and a
    pair is not made in each: a list leaves it to a lesser one that is among the first lists of the
    member and among the first of which the hub is a hub. There it is made, or was in a round before,
    or is left to a still lesser one; the least list that a pair meets in leaves it to none."""
    one = carried(known, open_rows, "sig", "vertex", "a_")
    two = carried(known, hubs, "hub_sig", "hub", "b_")
    # The hub's columns meet those of the members in the join's own condition, so that pairs
    # which cannot link are not made.
    rows, others = open_rows.join(one, "vertex"), hubs.join(two, "hub")
    earlier = F.array_min(F.array_intersect("a_firsts", "b_firsts")) < rows.sig
    meets = (
        (rows.sig == others.hub_sig) & (rows.root != others.hub_root)
        & ((rows.vertex > others.hub) | (rows.root == rows.largest)) & may_link_wide("a_", "b_", rule)
        & ~F.coalesce(earlier, F.lit(False))
    )
    return rows.join(others, meets).select("vertex", "hub")


def joined_roots(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """Components after further edges: only the components that these connect are joined."""
    ends = _with_root(_with_root(edges, roots, "a"), roots, "b")
    ends = ends.select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
    moved = materialize(components(ends, edges.count()), "moved-roots")
    alone = moved.join(roots, "vertex", "left_anti").select("vertex", F.col("vertex").alias("root"))
    to = moved.select(F.col("vertex").alias("root"), F.col("root").alias("to"))
    return roots.union(alone).join(to, "root", "left").select(
        "vertex", F.coalesce("to", "root").alias("root")
    )


def grouped(documents: DataFrame, rule: Rule = RULE) -> DataFrame:
    """doc_id, row_key, n_shingles, vertex of every row and `root`, the same number for all rows
    of a component (null for empty sets, which stand alone)."""
    docs = materialize(summaries(documents, rule), "sets")
    top = largest_partner(max(BOUNDARIES), rule)
    sizes = docs.filter(F.col("n_shingles").between(1, top)).groupBy("n_shingles").count().collect()
    boundary = best_boundary({r.n_shingles: r["count"] for r in sizes}, rule)
    pairs = materialize(to_smallest(materialize(hub_pairs(documents, boundary, rule), "stars")), "pairs")
    # A set is checked against its nearest hub first; that joins most, and others are checked only where
    # they still lie in two components.
    may = materialize(possible(pairs.select("vertex", "hub").distinct(), docs, rule), "possible")
    nearest = may.groupBy("vertex").agg(F.min(F.struct("apart", "hub")).alias("best")).select(
        "vertex", F.col("best.hub").alias("hub")
    )
    found = checked(nearest, documents, docs, rule)
    if found is None:
        found = pairs.select(F.col("vertex").alias("a"), F.col("hub").alias("b")).limit(0)
    roots = materialize(components(found), "roots")
    rest = _with_root(_with_root(may, roots, "vertex"), roots, "hub").filter("vertex_root <> hub_root")
    found = checked(rest.select("vertex", "hub"), documents, docs, rule)
    if found is not None:
        roots = materialize(joined_roots(roots, found), "roots")
    open_lists = materialize(unresolved(pairs, roots), "open-lists")
    if not open_lists.isEmpty():
        members = materialize(members_of(documents, docs, pairs, open_lists, boundary, rule), "members")
        known = materialize(sketches_of(docs, members), "member-sketches")
        longest = members.groupBy("sig").count().agg(F.max("count")).first()[0]
        done, most = members.select("sig", "vertex").limit(0), min(FIRST_HUBS, longest)
        while True:
            hubs, more = next_pairs(members, known, done, roots, most, rule)
            if hubs.isEmpty():
                break
            found = checked(more, documents, docs, rule)
            if found is not None:
                roots = materialize(joined_roots(roots, found), "roots")
            if most == longest and longest * longest <= ROUND_PAIRS:
                break  # every member was a hub
            done, most = materialize(done.union(hubs), "hubs-done"), longest
    return docs.join(roots, "vertex", "left").select(
        "doc_id", "row_key", "n_shingles", "vertex", F.coalesce("root", "vertex").alias("root")
    )


def link_components(documents: DataFrame, rule: Rule = RULE) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    named = grouped(documents, rule)
    least = named.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
    return named.join(least, "root", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("vertex").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
    )
