"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is good or bad. Its features are counts of kinds of characters, of words
and of repetition, those of the line before and of the line after it, and whether it is at an
end. The chain adds how likely labels follow each other. The marginals of forward-backward give
each line a probability of being good; their mean, weighted by the lines' lengths, is the
document's share of good text, which a logistic curve turns into the score.

Only documents are labelled. Lines of good documents are good. Lines of bad documents start as
bad; those that the model takes for good with certainty are then set free and it is fitted anew,
so that a clean line in a bad document does no harm.

The field is fitted on at most SAMPLE_ROWS labelled documents that are not held out, chosen by a
hash of doc_id; everything else reads all rows. Defined results: a null or blank text scores
0.0; without labels of both kinds all texts with words score 1.0; repeated labels count once,
at their greatest value, null ones not at all; every row of documents gets its own result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.text import held_out

#: Most labelled documents that the field is fitted on.
SAMPLE_ROWS = 3000
EPOCHS, RATE, DECAY, REFITS = 120, 0.08, 1e-4, 2
#: Score from which a document is predicted good, as the contract sets it.
CUT = 0.3
#: Probability of being good from which a line of a bad document is set free.
CERTAIN = 0.9

SCORED = "doc_id long, held_out boolean, score double, predicted int"

#: Kinds of bytes: 0 small letters, 1 capitals, 2 digits, 3 blanks, 4 marks that end or join
#: clauses, 5 exclamation and question marks, 6 symbols, 7 bytes of characters beyond ASCII.
KINDS = 8
KIND = np.full(256, 6, dtype=np.int64)
KIND[[ord(c) for c in "abcdefghijklmnopqrstuvwxyz"]] = 0
KIND[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 1
KIND[[ord(c) for c in "0123456789"]] = 2
KIND[[ord(c) for c in " \t\n\r\x0b\x0c"]] = 3
KIND[[ord(c) for c in ".,;:'\"()-"]] = 4
KIND[[ord(c) for c in "!?"]] = 5
KIND[128:] = 7
OWN = KINDS + 7
FEATURES = 3 * OWN + 3


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features (lines x FEATURES) and lengths of the lines that have words."""
    rows, lengths, seen = [], [], set()
    for line in (text or "").split("\n"):
        words = line.split()
        if not words:
            continue
        data = line.encode()
        n, k = len(data), len(words)
        kinds = np.bincount(KIND[np.frombuffer(data, np.uint8)], minlength=KINDS) / n
        capitals = sum(map(str.isupper, words)) / k
        again = sum(map(str.__eq__, words, words[1:])) / k
        rows.append((
            *kinds, capitals, again, len(set(words)) / k, float(line in seen),
            np.log1p(n) / 5, np.log1p(k) / 4, n / k / 10,
        ))
        lengths.append(n)
        seen.add(line)
    if not rows:
        return np.zeros((0, FEATURES)), np.zeros(0)
    own = np.array(rows)
    x = np.zeros((len(own), FEATURES))
    x[:, :OWN] = own
    x[1:, OWN: 2 * OWN] = own[:-1]
    x[:-1, 2 * OWN: 3 * OWN] = own[1:]
    x[0, -3], x[-1, -2], x[:, -1] = 1, 1, 1
    return x, np.array(lengths, dtype=float)


class LineField:
    """Weights of the field. Label 1 is good; `follow[i, j]` scores j after i."""

    def __init__(self, size: int = FEATURES):
        self.weights = np.zeros(size)
        self.follow = np.zeros((2, 2))
        self.curve = (6.0, -3.0)
        self.trivial = False

    def marginals(self, x: np.ndarray) -> np.ndarray:
        """Probability of each line of one document of being good."""
        return _forward_backward([x @ self.weights], self.follow)[0][0][:, 1]

    def share(self, x: np.ndarray, lengths: np.ndarray) -> float:
        """Length-weighted mean of the marginals."""
        return float(self.marginals(x) @ lengths / lengths.sum())

    def score(self, text: str | None) -> float:
        x, lengths = line_features(text)
        if not len(x):
            return 0.0
        if self.trivial:
            return 1.0
        a, b = self.curve
        return float(1 / (1 + np.exp(-(a * self.share(x, lengths) + b))))


def _forward_backward(
    emissions: list[np.ndarray], follow: np.ndarray
) -> tuple[list[np.ndarray], np.ndarray]:
    """Marginals of the lines of several documents, and expected counts of label pairs.
    Documents are sorted by length, so that one step takes all that are long enough."""
    sizes = np.array([len(e) for e in emissions])
    order = np.argsort(-sizes, kind="stable")
    longest, n = int(sizes.max()), len(emissions)
    potential = np.ones((longest, n, 2))
    for column, d in enumerate(order):
        potential[: sizes[d], column, 1] = np.exp(np.clip(emissions[d], -30, 30))
    active = [int((sizes > t).sum()) for t in range(longest)]
    step = np.exp(follow)
    forward = np.zeros((longest, n, 2))
    backward = np.ones((longest, n, 2))
    forward[0] = potential[0]
    forward[0] /= forward[0].sum(axis=1, keepdims=True)
    for t in range(1, longest):
        k = active[t]
        f = (forward[t - 1, :k] @ step) * potential[t, :k]
        forward[t, :k] = f / f.sum(axis=1, keepdims=True)
    pairs = np.zeros((2, 2))
    for t in range(longest - 1, 0, -1):
        k = active[t]
        ahead = potential[t, :k] * backward[t, :k]
        b = ahead @ step.T
        backward[t - 1, :k] = b / b.sum(axis=1, keepdims=True)
        both = forward[t - 1, :k, :, None] * step * ahead[:, None, :]
        pairs += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    found = forward * backward
    found /= np.maximum(found.sum(axis=2, keepdims=True), 1e-300)
    out: list[np.ndarray] = [np.zeros(0)] * n
    for column, d in enumerate(order):
        out[d] = found[: sizes[d], column]
    return out, pairs


def _fit_field(field: LineField, xs: list[np.ndarray], labels: list[np.ndarray]) -> None:
    """Adam on the conditional likelihood of the line labels."""
    every, known = np.concatenate(xs), np.concatenate(labels)
    ends = np.cumsum([len(x) for x in xs])[:-1]
    seen = np.zeros((2, 2))
    for y in labels:
        np.add.at(seen, (y[:-1], y[1:]), 1)
    n = len(every)
    state = np.zeros((2, FEATURES + 4))
    for epoch in range(1, EPOCHS + 1):
        emissions = np.split(every @ field.weights, ends)
        found, pairs = _forward_backward(emissions, field.follow)
        good = np.concatenate(found)[:, 1]
        gradient = np.concatenate([
            every.T @ (known - good) / n - DECAY * field.weights,
            ((seen - pairs) / n - DECAY * field.follow).ravel(),
        ])
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.99 * state[1] + 0.01 * gradient**2
        move = RATE * (state[0] / (1 - 0.9**epoch)) / (np.sqrt(state[1] / (1 - 0.99**epoch)) + 1e-8)
        field.weights += move[:FEATURES]
        field.follow += move[FEATURES:].reshape(2, 2)


def fit(xs: list[np.ndarray], lengths: list[np.ndarray], quality: np.ndarray) -> LineField:
    """A field from documents with lines, and their labels (1 good, 0 bad)."""
    field = LineField()
    if not len(quality) or quality.min() == quality.max():
        field.trivial = True
        return field
    labels = [np.full(len(x), q, dtype=np.int64) for x, q in zip(xs, quality)]
    for _ in range(REFITS):
        _fit_field(field, xs, labels)
        for i in np.flatnonzero(quality == 0):
            free = field.marginals(xs[i]) > CERTAIN
            if not free.all():
                labels[i] = free.astype(np.int64)
    shares = np.array([field.share(x, n) for x, n in zip(xs, lengths)])
    field.curve = _logistic(shares, quality)
    return field


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by damped Newton steps."""
    a, b = 6.0, -3.0
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        gradient = design.T @ (y - p) - 1e-2 * np.array([a, 0.0])
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        move = np.linalg.solve(hessian, gradient)
        move *= min(1.0, 5.0 / max(1e-12, np.abs(move).max()))
        a, b = a + move[0], b + move[1]
    return max(float(a), 0.1), float(b)


def training_sample(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """quality and features of at most SAMPLE_ROWS labelled documents that are not held out.
    The labels are chosen first, so only a bounded table meets the texts."""
    chosen = (
        labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [line_features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("quality").cast(pa.int32()),
                    pa.array([x.astype("<f4").tobytes() for x, _ in found], pa.binary()),
                    pa.array([n.astype("<f8").tobytes() for _, n in found], pa.binary()),
                ],
                ["doc_id", "quality", "x", "lengths"],
            )

    return (
        documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .mapInArrow(run, "doc_id long, quality int, x binary, lengths binary")
    )


def learned(documents: DataFrame, labels: DataFrame) -> LineField:
    rows = sorted(training_sample(documents, labels).collect(), key=lambda r: (r.doc_id, r.x))
    rows = [r for r in rows if r.x]
    xs = [np.frombuffer(r.x, "<f4").reshape(-1, FEATURES).astype(float) for r in rows]
    lengths = [np.frombuffer(r.lengths, "<f8") for r in rows]
    return fit(xs, lengths, np.array([r.quality for r in rows]))


def with_scores(
    documents: DataFrame, field: LineField, keep: list[str], score: str = "_score"
) -> DataFrame:
    """The columns `keep` of every row and its score, under a name of its own. Each text goes to Python
    once, whether it is kept or not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [field.score(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(scores, pa.float64())], [*keep, score]
            )

    rows = documents.select(*dict.fromkeys([*keep, "text"]))
    kind = T.StructType([*(rows.schema[c] for c in keep), T.StructField(score, T.DoubleType())])
    return rows.mapInArrow(run, kind)


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, scored from its text alone."""
    scored = with_scores(documents, learned(documents, labels), ["doc_id"])
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= CUT).cast("int").alias("predicted"),
    )
