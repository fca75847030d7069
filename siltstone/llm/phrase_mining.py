"""Phrase mining with mergeable Misra-Gries summaries.

Pass one finds which n-grams may be frequent. A task counts the n-grams of a few megabytes of text at a
time; such a count is a summary without error. N-grams are dealt by hash to partitions, and each
partition merges its summaries into one of bounded capacity: when there are more counters than the
capacity, the count of the largest one beyond it is taken from all, and those at nothing go. With a
capacity above mass / threshold what is taken in all stays below the threshold, so an n-gram that
occurs as often as the threshold keeps a counter. The capacity comes from the expected mass of a
partition; where a very common n-gram adds to that it grows along, and nothing is taken that would
bring the error to the threshold. Words and word pairs come first; three words are looked at only where both
their pairs may be frequent.

Pass two counts exactly, by text, the n-grams that a filter of fixed size lets pass: all
survivors, and some others, which their exact count then rules out.

Defined results: null and empty texts hold no words; a null language is `und`; repeated rows count
again; a language without frequent phrases has no rows, and an empty table gives none. Very long texts
are counted in parts that share two words, so memory is bounded and no phrase is lost or counted twice.
Ties of score and count are in the order of the phrases' bytes. Columns other than lang and text are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.bit_filter import bitmap, passing
from siltstone.session import materialize

#: Occurrences of a frequent phrase; rows of a language; scale of the score.
THRESHOLD, TOP, SCALE = 10, 2000, 1_000_000
#: A phrase goes if a longer one holds it in so many percent of its occurrences.
COVERED = 50
#: Bytes of text that a task counts at a time.
PART = 4 << 20
#: N-grams that a hash partition is meant to see, and characters of text that bring two of them.
MASS, CHARS = 1 << 23, 6
#: Times that a lookup table is repeated, so that a common word meets in as many places.
SALTS = 8

#: Capitals become small letters, marks that end a piece become full stops.
ENDS = b".,;:!?\n\x0b\x0c\r"
TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + ENDS, b"abcdefghijklmnopqrstuvwxyz " + b"." * len(ENDS)
)
STOP = b"."
MIX, FOLD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def tokens_of(data: bytes) -> list[bytes]:
    """Words, and a full stop between pieces, of bytes that TABLE has changed."""
    return data.replace(STOP, b" . ").split()


def parts_of(data: bytes, size: int) -> Iterator[bytes]:
    """Bytes cut after a blank or full stop, `size` at a time unless a word is longer."""
    start = 0
    while len(data) - start > size:
        end = start + size
        cut = max(data.rfind(b" ", start, end), data.rfind(STOP, start, end)) + 1
        if cut <= start:
            later = [at for at in (data.find(b" ", end), data.find(STOP, end)) if at >= 0]
            cut = min(later) + 1 if later else len(data)
        yield data[start:cut]
        start = cut
    yield data[start:]


def chunks(
    batches: Iterator[pa.RecordBatch], size: int
) -> Iterator[tuple[str, list[bytes], int]]:
    """Language, tokens, and the first token that is new (those before it are context) of texts put
    together to about `size` bytes."""
    held: dict[str, list[bytes]] = {}
    total = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            if not text:
                continue
            data = text.encode().translate(TABLE)
            if len(data) > size:
                last: list[bytes] = []
                for part in parts_of(data, size):
                    tokens = last + tokens_of(part)
                    yield lang, tokens, len(last)
                    last = tokens[-2:]
                continue
            if total + len(data) > size:
                for name, texts in held.items():
                    yield name, tokens_of(STOP.join(texts)), 0
                held, total = {}, 0
            held.setdefault(lang, []).append(data)
            total += len(data) + 1
    for name, texts in held.items():
        yield name, tokens_of(STOP.join(texts)), 0


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Grams:
    """N-grams of a list of tokens: numbers of its words, codes of n-grams, and which are new."""

    def __init__(self, lang: str, tokens: list[bytes], fresh: int):
        numbers = _Numbers({STOP: 0})
        self.ids = np.array([*map(numbers.__getitem__, tokens)], dtype=np.int64)
        self.words = [*numbers]
        seed = xxhash.xxh3_64_intdigest(lang.encode())
        hashes = np.array(
            [xxhash.xxh3_64_intdigest(w, seed=seed) for w in self.words], dtype=np.uint64
        )[self.ids]
        one = self.ids > 0
        two = one[:-1] & one[1:]
        self.is_gram = {1: one, 2: two, 3: two[:-1] & two[1:]}
        for n, mask in self.is_gram.items():
            mask[: max(0, fresh - n + 1)] = False
        self.code = {1: _mixed(hashes), 2: _mixed(hashes[:-1] * MIX + hashes[1:])}
        self.code[3] = _mixed(self.code[2][:-1] * MIX + hashes[2:])

    def unique(self, n: int, keep: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """Texts and counts of the n-grams at `keep`."""
        at = np.flatnonzero(keep)
        key, width = self.ids[at], len(self.words)
        for i in range(1, n):
            # A chunk of PART bytes has fewer than 2**20 different words: three numbers fit 63 bits.
            key = key * width + self.ids[at + i]
        _, first, counts = np.unique(key, return_index=True, return_counts=True)
        columns = [[self.words[x] for x in self.ids[at[first] + i].tolist()] for i in range(n)]
        return [b" ".join(row) for row in zip(*columns)], counts


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * FOLD
    return x ^ (x >> np.uint64(29))


class Summary:
    """Misra-Gries counters of a hash partition. `capacity` is what its mass was expected to ask for."""

    def __init__(self, capacity: int, threshold: int = THRESHOLD):
        self.least, self.threshold = capacity, threshold
        self.codes, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.rows = self.mass = self.error = 0

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((codes, counts))
        self.rows += len(codes)
        self.mass += int(counts.sum())
        if self.rows > max(1 << 16, len(self.codes)):
            self.merge()

    def merge(self) -> None:
        codes = np.concatenate([self.codes, *(c for c, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(n for _, n in self.waiting)])
        self.waiting, self.rows = [], 0
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else order
        self.codes = codes[starts]
        self.counts = np.add.reduceat(counts[order], starts) if len(starts) else counts
        over = len(self.codes) - max(self.least, self.mass // self.threshold + 1)
        if over > 0:
            taken = int(np.partition(self.counts, over - 1)[over - 1])
            if self.error + taken < self.threshold:
                self.error += taken
                stays = self.counts > taken
                self.codes, self.counts = self.codes[stays], self.counts[stays] - taken

    def survivors(self) -> np.ndarray:
        """Codes that may have the threshold."""
        self.merge()
        return self.codes[self.counts + self.error >= self.threshold]


def texts_of(documents: DataFrame) -> DataFrame:
    return documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")


def survivors(
    texts: DataFrame, cells: int, keep: Callable[[Grams], dict[int, np.ndarray]],
    threshold: int = THRESHOLD, part: int = PART, mass: int = MASS,
) -> DataFrame:
    """code of every n-gram among those that `keep` points out which may have the threshold."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, part):
            grams = Grams(*chunk)
            found = [grams.code[n][mask] for n, mask in keep(grams).items()]
            codes, counts = np.unique(np.concatenate(found), return_counts=True)
            cell = (codes >> np.uint64(32)) % np.uint64(cells)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell.astype(np.int32)), pa.array(codes.view(np.int64)), pa.array(counts)],
                ["cell", "code", "times"],
            )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # There are as many partitions as cells, so a task has one cell or a few.
        summaries: dict[int, Summary] = {}
        for batch in batches:
            cell, code, times = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "code", "times")
            )
            for one in np.unique(cell).tolist():
                if one not in summaries:
                    summaries[one] = Summary(2 * mass // threshold, threshold)
                rows = cell == one
                summaries[one].add(code[rows], times[rows])
        for summary in summaries.values():
            yield pa.RecordBatch.from_arrays([pa.array(summary.survivors())], ["code"])

    return (
        texts.mapInArrow(local, "cell int, code long, times long")
        .repartition(cells, "cell").mapInArrow(merged, "code long")
    )


def counted(
    texts: DataFrame, keep: Callable[[Grams], dict[int, np.ndarray]], part: int = PART
) -> DataFrame:
    """lang, size, phrase, a: exact counts of the n-grams that `keep` points out; size 0 has the words
    of each language."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, tokens, fresh in chunks(batches, part):
            grams = Grams(lang, tokens, fresh)
            sizes, phrases, times = [0], [b""], [int(grams.is_gram[1].sum())]
            for n, mask in keep(grams).items():
                found, counts = grams.unique(n, mask)
                sizes += [n] * len(found)
                phrases += found
                times += counts.tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(sizes), pa.string()), pa.array(sizes, pa.int32()),
                    pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(times, pa.int64()),
                ],
                ["lang", "size", "phrase", "times"],
            )

    rows = texts.mapInArrow(local, "lang string, size int, phrase string, times long")
    return rows.groupBy("lang", "size", "phrase").agg(F.sum("times").alias("a"))


def frequent(
    documents: DataFrame, threshold: int = THRESHOLD, part: int = PART, mass: int = MASS
) -> DataFrame:
    """lang, size, phrase, a of all phrases of one to three words with the threshold, and of size 0."""
    texts = texts_of(documents)
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    partitions = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = max(2 * partitions, 2 * chars // (CHARS * mass))
    context = documents.sparkSession.sparkContext

    first = materialize(
        survivors(texts, cells, lambda g: {n: g.is_gram[n] for n in (1, 2)}, threshold, part, mass),
        "survivors",
    )
    small = context.broadcast(bitmap(first, "code"))

    def pairs_pass(g: Grams) -> np.ndarray:
        return g.is_gram[2] & passing(small.value, g.code[2])

    def triples(g: Grams) -> np.ndarray:
        # Whether a pair may be frequent does not depend on where the new tokens begin.
        pair = passing(small.value, g.code[2])
        return g.is_gram[3] & pair[:-1] & pair[1:]

    second = materialize(
        survivors(texts, cells, lambda g: {3: triples(g)}, threshold, part, mass), "survivors"
    )
    large = context.broadcast(bitmap(second, "code"))

    def kept(g: Grams) -> dict[int, np.ndarray]:
        return {
            1: g.is_gram[1] & passing(small.value, g.code[1]),
            2: pairs_pass(g),
            3: triples(g) & passing(large.value, g.code[3]),
        }

    exact = counted(texts, kept, part)
    return materialize(exact.filter((F.col("a") >= threshold) | (F.col("size") == 0)), "phrases")


def with_count(rows: DataFrame, key: Column, counts: DataFrame, name: str) -> DataFrame:
    """Adds the count of the phrase `key`. The table of counts is repeated, so that a phrase in very
    many rows meets them in several places."""
    salts = F.array(*(F.lit(i) for i in range(SALTS)))
    table = counts.select(
        "lang", F.col("phrase").alias("_key"), F.col("a").alias(name), F.explode(salts).alias("_salt")
    )
    dealt = rows.withColumn("_key", key).withColumn(
        "_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    )
    return dealt.join(table, ["lang", "_key", "_salt"]).drop("_key", "_salt")


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)), in whole numbers of up to 38 digits."""
    wide = [x.cast("decimal(18,0)") for x in (a, left, right)]
    top = (wide[0] * wide[0]) * F.lit(SCALE).cast("decimal(7,0)")
    return F.call_function("div", top, wide[1] * wide[2])


def cut_scores(counts: DataFrame) -> DataFrame:
    """lang, size, phrase, a, l, r, score of phrases of two and three words, by their worst cut."""
    words, pairs, triples = (counts.filter(F.col("size") == n).drop("size") for n in (1, 2, 3))
    phrase = F.col("phrase")

    def part(n: int) -> Column:
        return F.substring_index(phrase, " ", n)

    two = with_count(with_count(pairs, part(1), words, "l"), part(-1), words, "r")
    two = two.withColumn("size", F.lit(2)).withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
    three = with_count(with_count(triples, part(1), words, "l1"), part(-2), pairs, "r1")
    three = with_count(with_count(three, part(2), pairs, "l2"), part(-1), words, "r2")
    for n in ("1", "2"):
        three = three.withColumn(f"s{n}", score(F.col("a"), F.col(f"l{n}"), F.col(f"r{n}")))
    first = F.col("s1") <= F.col("s2")
    three = three.withColumn("size", F.lit(3)).select(
        "lang", "phrase", "a", "size",
        *(F.when(first, F.col(f"{c}1")).otherwise(F.col(f"{c}2")).alias(name)
          for c, name in (("l", "l"), ("r", "r"), ("s", "score"))),
    )
    columns = ["lang", "size", "phrase", "a", "l", "r", "score"]
    return two.select(*columns).union(three.select(*columns))


def uncovered(scored: DataFrame, counts: DataFrame) -> DataFrame:
    """Phrases that no longer one holds in COVERED percent of their occurrences or more."""
    phrase = F.col("phrase")
    inner = F.explode(F.array(F.substring_index(phrase, " ", 2), F.substring_index(phrase, " ", -2)))
    longer = (
        counts.filter("size = 3").select("lang", inner.alias("phrase"), "a")
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    )
    return scored.join(longer, ["lang", "phrase"], "left").filter(
        F.coalesce(100 * F.col("longer") < COVERED * F.col("a"), F.lit(True))
    ).drop("longer")


def mine_phrases(
    documents: DataFrame, threshold: int = THRESHOLD, top: int = TOP, part: int = PART, mass: int = MASS
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language."""
    counts = frequent(documents, threshold, part, mass)
    words = counts.filter("size = 0").select("lang", F.col("a").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = (
        uncovered(cut_scores(counts), counts)
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    )
    return best.join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
