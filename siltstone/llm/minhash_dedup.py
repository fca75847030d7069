"""Near-duplicate detection with bottom-k sketches from one hash function.

The sketch of a set of word shingles is its K smallest hashes; up to K shingles it is the set itself.
Inverted lists of retained values bring documents together: each value that two different sets
retain has a list. A set does not stand in the lists of all its values but in those of its rarest:
if two sets link, few retained values of one can be absent from the other's sketch, so among one
more than that many of the rarest values of both there is a common one. For sets that are not cut
that number is exact; for cut ones it is the expected number and six standard deviations, beyond which
a link is lost with a chance of about one in 10^9. Values that no other set retains come first in this
order and make no list, so a document that differs from all others in many places is in none.

Pairs come from the lists in two steps. First each member is paired with the list's hub, the
member with the fewest values of its own: that is the original of a group of edited copies, and joins
most of them. Then members of one list that still lie in different components are paired, if their
places in the order, their sizes and two parity sketches (256 and 2048 bits, each the parity of the
shingles that hash to it; the short one says nothing of sets of more than about 800) allow a link. Groups that hang together therefore give a pair per member and list,
not a square.

A pair is judged by the sketch of its union, the smallest hashes of both: the share of them that both
sets have estimates the similarity, and pairs clearly below the threshold go. The others are
checked on their full sets. Links give components.

Defined results: null and blank texts have the empty set and stand alone, with their own doc_id as
component; a text of fewer words than a shingle is one shingle. Rows of equal sets link, whatever
their doc_ids. Rows without doc_id link like others but never name a component (null if none of its
rows has a doc_id; kept, then). Repeated rows give repeated rows with equal results. Very long
texts are taken whole. Other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.bit_filter import bitmap, passing
from siltstone.llm.components import components
from siltstone.llm.jaccard_join import parities, shingle_set
from siltstone.session import materialize

#: Hashes of a sketch, words of a shingle, least similarity in percent.
K, WORDS, PERCENT = 256, 5, 85
#: Standard deviations between the expected number of missing values and the allowed one.
DEVIATIONS = 6
#: Distinct sets that a task remembers, so that copies in it give one sketch.
REMEMBERED = 200_000
PARITY = [f"parity{i}" for i in range(4)]
#: The sketch of open lists, of which the other is the fold.
WIDE_BITS = 2048
WIDE = [f"wide{i}" for i in range(WIDE_BITS // 64)]


def vertex_of(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).view(np.int64))


def sketches(documents: DataFrame, k: int = K) -> DataFrame:
    """doc_id, text_key, n, vertex, parities and sketch of every row. A row whose set came before in
    the same task has a null sketch, one without words a null vertex."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            n, vertex, parity, sketch = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingle_set(text, WORDS)
                v = vertex_of(s) if len(s) else None
                fresh = v is not None and v not in seen
                if fresh:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(v)
                n.append(len(s))
                vertex.append(v)
                parity.append(parities(s, WIDE_BITS) if fresh else np.zeros(len(WIDE), np.int64))
                sketch.append(s[:k].view(np.int64) if fresh else None)
            wide = np.array(parity, dtype=np.int64).reshape(-1, len(WIDE))
            bits = np.bitwise_xor.reduce(wide.reshape(-1, len(WIDE) // len(PARITY), len(PARITY)), axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()), batch.column("text_key"),
                    pa.array(n, pa.int64()), pa.array(vertex, pa.int64()),
                    *(pa.array(np.ascontiguousarray(c)) for c in (*bits.T, *wide.T)),
                    pa.array(sketch, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_key", "n", "vertex", *PARITY, *WIDE, "sketch"],
            )

    return documents.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(
        run,
        "doc_id long, text_key long, n long, vertex long, "
        + "".join(f"{c} long, " for c in (*PARITY, *WIDE)) + "sketch array<long>",
    )


def shared_values(sets: DataFrame) -> DataFrame:
    """value, df of the values that two different sets retain."""
    return (
        sets.filter("sketch IS NOT NULL").select("vertex", F.explode("sketch").alias("value"))
        .groupBy("value").agg(F.count("*").alias("df"), F.min("vertex").alias("a"), F.max("vertex").alias("b"))
        .filter("a <> b").select("value", "df")
    )


def missing(n: Column, m: Column, retained: Column, k: int, percent: int) -> Column:
    """Most values of a set of n, of which it retains some, that a linked set of m does not retain."""
    exact = n - F.ceil(percent * (n + m) / (100 + percent))
    share = 1 - percent / (100 + percent) * (1 + F.least(n, m) / F.greatest(n, m))
    expected = retained * share
    return F.when((n <= k) & (m <= k), exact).otherwise(
        F.least(retained, F.ceil(expected + DEVIATIONS * F.sqrt(expected)) + 1)
    )


def postings(sets: DataFrame, shared: DataFrame, k: int, percent: int) -> DataFrame:
    """value, vertex, n, retained, own (values that no other set retains), place (in the order of
    rareness, from 1) and parities: the lists."""
    context = sets.sparkSession.sparkContext
    bits = context.broadcast(bitmap(shared, "value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketch = batch.column("sketch")
            value = sketch.flatten().to_numpy()
            lengths = np.diff(sketch.offsets.to_numpy())
            keep = passing(bits.value, value.view(np.uint64))
            row = np.repeat(np.arange(len(lengths)), lengths)[keep]
            take = pa.array(row)
            rest = ["vertex", "n", *PARITY]
            yield pa.RecordBatch.from_arrays(
                [pa.array(value[keep]), *(batch.column(c).take(take) for c in rest)], ["value", *rest]
            )

    rows = sets.filter("sketch IS NOT NULL").select("vertex", "n", *PARITY, "sketch").mapInArrow(
        run, "value long, vertex long, n long, " + ", ".join(f"{c} long" for c in PARITY)
    )
    n, retained = F.col("n"), F.least("n", F.lit(k))
    smallest = F.ceil(n * percent / 100)
    largest = F.floor(n * 100 / percent)
    most = F.greatest(
        missing(n, smallest, F.col("retained"), k, percent),
        missing(n, n, F.col("retained"), k, percent),
        missing(n, largest, F.col("retained"), k, percent),
    )
    by_set = (
        rows.join(shared.hint("merge"), "value")
        .groupBy("vertex", "n", *PARITY)
        .agg(F.sort_array(F.collect_set(F.struct("df", "value"))).alias("listed"))
        .withColumn("retained", retained)
        .withColumn("own", F.col("retained") - F.size("listed"))
        .withColumn("most", most)
    )
    return (
        by_set.select(
            "vertex", "n", "retained", "own", "most", *PARITY, F.posexplode("listed").alias("at", "entry")
        )
        .withColumn("place", F.col("own") + F.col("at") + 1)
        .filter("place <= most + 1")
        .select("entry.value", "vertex", "n", "retained", "own", "place", *PARITY)
    )


def may_link(a: str, b: str, percent: int, bits: list[str] = PARITY) -> Column:
    """Whether sizes and parity sketches of two sets allow a link."""
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    apart = sum(F.bit_count(F.col(f"{a}{c}").bitwiseXOR(F.col(f"{b}{c}"))) for c in bits)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (
        (100 + percent) * apart <= (100 - percent) * (n + m)
    )


def star_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """vertex, other: the members of each list with its hub."""
    columns = ["own", "vertex", "n", *PARITY]
    hubs = lists.groupBy("value").agg(F.min(F.struct(*columns)).alias("hub")).select(
        "value", F.col("hub.vertex").alias("other"), *(F.col(f"hub.{c}").alias(f"b_{c}") for c in ("n", *PARITY))
    )
    members = lists.select("value", "vertex", *(F.col(c).alias(f"a_{c}") for c in ("n", *PARITY)))
    meets = (
        (members.value == hubs.value) & (members.vertex != hubs.other) & may_link("a_", "b_", percent)
    )
    return _ordered(members.join(hubs.hint("merge"), meets))


def open_pairs(
    lists: DataFrame, roots: DataFrame, k: int, percent: int, sets: DataFrame | None = None
) -> DataFrame:
    """vertex, other: members of a list that lie in different components and may link, by the wide
    parity sketches if `sets` gives them, which members of open lists alone carry."""
    named = lists.join(roots, "vertex", "left").withColumn("root", F.coalesce("root", "vertex"))
    named = materialize(named, "named-lists")
    several = named.groupBy("value").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b")
    rows = named.join(several.select("value").hint("merge"), "value", "left_semi")
    bits = PARITY
    if sets is not None:
        known = sets.filter("sketch IS NOT NULL").select("vertex", *WIDE).dropDuplicates(["vertex"])
        rows, bits = rows.join(known, "vertex"), [*PARITY, *WIDE]
    rows = materialize(rows, "open-lists")
    own = ["root", "n", "retained", "place", *bits]
    one = rows.select(F.col("value").alias("value_a"), "vertex", *(F.col(c).alias(f"a_{c}") for c in own))
    two = rows.select("value", F.col("vertex").alias("other"), *(F.col(c).alias(f"b_{c}") for c in own))
    early = (
        F.col("a_place") <= missing(F.col("a_n"), F.col("b_n"), F.col("a_retained"), k, percent) + 1
    ) & (
        F.col("b_place") <= missing(F.col("b_n"), F.col("a_n"), F.col("b_retained"), k, percent) + 1
    )
    meets = (one.value_a == two.value) & (F.col("a_root") < F.col("b_root")) & early & may_link("a_", "b_", percent)
    if sets is not None:
        meets = meets & may_link("a_", "b_", percent, WIDE)
    return _ordered(one.join(two.hint("merge"), meets))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.least("vertex", "other").alias("vertex"), F.greatest("vertex", "other").alias("other")
    ).distinct()


def full_sets(documents: DataFrame, sets: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """vertex, shingles (sorted 64-bit numbers) of the sets that stand in lists: from the sketches where
    they are the sets, else from the texts, of which a filter lets the right ones pass."""
    context = sets.sparkSession.sparkContext
    listed = context.broadcast(bitmap(members, "vertex"))
    large = sets.filter(F.col("n") > k).select("vertex", "text_key").join(
        members.hint("merge"), "vertex", "left_semi"
    )
    texts = context.broadcast(bitmap(large, "text_key"))

    def rows(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([v for v, _ in found], pa.int64()), pa.array([s for _, s in found], pa.binary())],
            ["vertex", "shingles"],
        )

    def from_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vertex = batch.column("vertex").to_numpy()
            keep = np.flatnonzero(passing(listed.value, vertex.view(np.uint64)))
            sketch = batch.column("sketch")
            yield rows([(int(vertex[i]), sketch[i].values.to_numpy().tobytes()) for i in keep.tolist()])

    def from_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            key = batch.column("text_key").to_numpy()
            found, held = [], 0
            for i in np.flatnonzero(passing(texts.value, key.view(np.uint64))).tolist():
                if int(key[i]) in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(int(key[i]))
                s = shingle_set(batch.column("text")[i].as_py(), WORDS)
                if len(s) > k:
                    found.append((vertex_of(s), s.tobytes()))
                    held += len(s)
                if held > 2_000_000:
                    yield rows(found)
                    found, held = [], 0
            yield rows(found)

    small = sets.filter(F.col("sketch").isNotNull() & (F.col("n") <= k)).select("vertex", "sketch")
    texts_of = documents.filter("text IS NOT NULL").select("text", F.xxhash64("text").alias("text_key"))
    kind = "vertex long, shingles binary"
    both = small.mapInArrow(from_sketch, kind).union(texts_of.mapInArrow(from_text, kind))
    return both.dropDuplicates(["vertex"])


def union_estimate(a: np.ndarray, b: np.ndarray, k: int) -> tuple[float, int]:
    """Similarity of two sets by the k smallest hashes of their union, and how many those are."""
    both = np.sort(np.concatenate([a[:k], b[:k]]), kind="stable")
    same = np.flatnonzero(both[1:] == both[:-1])
    distinct = np.delete(both, same + 1)[:k]
    if not len(distinct):
        return 0.0, 0
    return np.searchsorted(both[same], distinct[-1], side="right") / len(distinct), len(distinct)


def links(a: np.ndarray, b: np.ndarray, k: int = K, percent: int = PERCENT) -> bool:
    """Whether two sets link: by the union sketch if that rules it out, else on the full sets."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    share = percent / 100
    found, seen = union_estimate(a, b, k)
    if large > k and found < share - DEVIATIONS * (share * (1 - share) / seen) ** 0.5:
        return False
    both = np.sort(np.concatenate([a, b]), kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (small + large - common)


def verified(pairs: DataFrame, shingles: DataFrame, k: int, percent: int) -> DataFrame:
    """Edges a, b: the pairs (vertex, other) that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                links(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), k, percent)
                for x, y in zip(batch.column("x"), batch.column("y"))
            ]
            found = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([found.column("vertex"), found.column("other")], ["a", "b"])

    one = shingles.select("vertex", F.col("shingles").alias("x"))
    two = shingles.select(F.col("vertex").alias("other"), F.col("shingles").alias("y"))
    return pairs.join(one, "vertex").join(two, "other").mapInArrow(run, "a long, b long")


def grouped(documents: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """doc_id, n, vertex and root (the same for all rows of a component; null for empty sets)."""
    sets = materialize(sketches(documents, k), "sketches")
    shared = materialize(shared_values(sets), "shared-values")
    lists = materialize(postings(sets, shared, k, percent), "lists")
    members = materialize(lists.select("vertex").distinct(), "members")
    shingles = materialize(full_sets(documents, sets, members, k), "full-sets")
    stars = materialize(verified(star_pairs(lists, percent), shingles, k, percent), "links")
    roots = materialize(components(stars), "roots")
    rest = materialize(
        verified(open_pairs(lists, roots, k, percent, sets), shingles, k, percent), "links"
    )
    if not rest.isEmpty():
        roots = materialize(components(stars.union(rest)), "roots")
    return sets.join(roots, "vertex", "left").select(
        "doc_id", "n", "vertex", F.coalesce("root", "vertex").alias("root")
    )


def deduplicate(documents: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    named = grouped(documents, k, percent)
    least = named.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
    component = F.when(F.col("vertex").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return named.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
