"""Language identification as a mixture: which languages, in what proportions, gave a text?

Each language is a multinomial over hashed byte trigrams, counted over all training documents.
A document's trigrams are taken as drawn from a mixture of languages; expectation-maximisation
finds the proportions. Which languages belong to the mixture is decided by penalised likelihood:
the least of them is left out for as long as that costs less log-likelihood than a language
is allowed to cost. The language of greatest proportion is the prediction, its proportion the score.

Defined results: `und` and 0.0 for a null text, one without letters, or when no language could be
learned; ties go to the language that comes first in order; every row gets its own result, also
repeated ones; columns other than doc_id, text and lang are ignored. Very long texts count whole, in memory
in proportion to them; an empty table gives no rows, and texts in a language that was not learned go to
the learned one that explains them best.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.text import held_out

BUCKETS = 1 << 14
#: Counted for each trigram besides what was seen.
SMOOTHING = 0.5
#: Log-likelihood that a language costs, times the logarithm of the number of trigrams; half of
#: it would be the Bayesian criterion, but trigrams overlap threefold.
PENALTY = 1.5
ROUNDS, CLOSE, FAINT = 40, 1e-4, 1e-3
UNKNOWN = "und"
PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"

#: Numerals such as ² or ½ are no letters.
LETTER = regex.compile(r"\p{L}").search
#: Bytes outside words count as spaces: ASCII that is not a letter.
PLAIN = np.arange(256, dtype=np.uint32)
PLAIN[[b for b in range(128) if not chr(b).isalpha()]] = 32


def trigrams(text: str) -> np.ndarray:
    """Counts of the hashed trigrams of a text, a number for each bucket."""
    b = PLAIN[np.frombuffer(f" {text.lower()} ".encode(), dtype=np.uint8)]
    codes = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    # Runs of blanks say nothing.
    codes = codes[codes != (32 << 16 | 32 << 8 | 32)]
    hashed = (codes * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    return np.bincount(hashed, minlength=BUCKETS)


def count_trigrams(training: DataFrame) -> DataFrame:
    """lang, bucket, n over all training documents; languages x BUCKETS rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS, dtype=np.int64))
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                counts[lang] += trigrams(text)
        for lang, n in counts.items():
            seen = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(seen)), pa.array(seen, pa.int32()), pa.array(n[seen])],
                ["lang", "bucket", "n"],
            )

    return (
        training.select("lang", "text")
        .filter("lang IS NOT NULL AND text IS NOT NULL")
        .mapInArrow(run, "lang string, bucket int, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )


class Languages:
    """Names in order and the probability of each bucket in each language."""

    def __init__(self, names: list[str], counts: np.ndarray):
        smooth = counts + SMOOTHING
        self.names = names
        self.probability = np.ascontiguousarray((smooth / smooth.sum(axis=1, keepdims=True)).T)

    @classmethod
    def learned(cls, training: DataFrame) -> Languages:
        rows = count_trigrams(training).toPandas()
        names = sorted(rows["lang"].unique())
        counts = np.zeros((len(names), BUCKETS))
        counts[np.searchsorted(names, rows["lang"]) if names else [], rows["bucket"]] = rows["n"]
        return cls(names, counts)

    def mixture(self, text: str | None) -> list[tuple[str, float]]:
        """Languages of a text and their proportions; empty if nothing can be said."""
        if not self.names or not text or not LETTER(text):
            return []
        counts = trigrams(text)
        seen = np.flatnonzero(counts)
        n, p = counts[seen].astype(float), self.probability[seen]
        total = n.sum()
        allowed = PENALTY * np.log(max(total, 2.0))
        kept = np.arange(len(self.names))
        weights, fit = _proportions(n, p, np.full(len(kept), 1.0 / len(kept)))
        strong = weights > FAINT
        kept, weights = kept[strong], weights[strong] / weights[strong].sum()
        while len(kept) > 1:
            rest = np.delete(np.arange(len(kept)), weights.argmin())
            fewer, less = _proportions(n, p[:, kept[rest]], weights[rest] / weights[rest].sum())
            if fit - less >= allowed:
                break
            kept, weights, fit = kept[rest], fewer, less
        order = np.lexsort((kept, -weights))
        return [(self.names[kept[i]], float(weights[i])) for i in order]


def _proportions(n: np.ndarray, p: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, float]:
    """Expectation-maximisation: proportions and log-likelihood."""
    weights, total = start, n.sum()
    if len(weights) == 1:
        return np.ones(1), float(n @ np.log(p[:, 0]))
    for _ in range(ROUNDS):
        share = n / (p @ weights)
        after = weights * (share @ p) / total
        done = np.abs(after - weights).max() < CLOSE
        weights = after
        if done:
            break
    return weights, float(n @ np.log(p @ weights))


def predict(documents: DataFrame, languages: Languages) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, from its text alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = [
                (languages.mixture(text) or [(UNKNOWN, 0.0)])[0]
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    batch.column("held_out"),
                    pa.array([b[0] for b in best], pa.string()),
                    pa.array([min(1.0, b[1]) for b in best], pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = documents.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(run, PREDICTED)


def with_main_language(
    documents: DataFrame, languages: Languages, least_share: float
) -> DataFrame:
    """Rows, all columns kept, whose text has a known language of at least that share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [languages.mixture(text) for text in batch.column("text").to_pylist()]
            yield batch.filter(pa.array([bool(f) and f[0][1] >= least_share for f in found]))

    return documents.mapInArrow(run, documents.schema)


def identify_documents(documents: DataFrame) -> DataFrame:
    """Learns from the rows that are not held out and predicts all rows."""
    return predict(documents, Languages.learned(documents.filter(~held_out(F.col("doc_id")))))
