"""Op 12 against plain counting, and its summaries against their guarantee."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import bit_filter, phrase_mining
from siltstone.llm.phrase_mining import Summary, chunks, mine_phrases
from tests.llm.helpers import documents, no_documents, odd_documents, sample_documents


def brute(rows, threshold=10, top=2000):
    """lang, rank, phrase, a, l, r, n, score by counting everything."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        small = (text or "").encode().lower().decode()
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", small):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                f[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= threshold}
        longer = Counter()
        for p, a in candidates.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    longer[part] = max(longer[part], a)
        scored = []
        for p, a in candidates.items():
            s, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            if 100 * longer[p] < 50 * a or not longer[p]:
                scored.append((-s, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def rows_of(df):
    return [(r.text, r.lang) for r in df.select("text", "lang").collect()]


def ours(df, **options):
    return sorted(tuple(r) for r in mine_phrases(df, **options).collect())


def test_sample_equals_plain_counting(spark):
    docs = sample_documents(spark)
    assert ours(docs) == brute(rows_of(docs))


def test_small_parts_and_partitions_change_nothing(spark):
    docs = sample_documents(spark).repartition(5)
    # Parts of 2,000 bytes cut most texts; a mass of 500 prunes summaries again and again.
    assert ours(docs, part=2_000, mass=500, threshold=4, top=300) == brute(rows_of(docs), 4, 300)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    assert ours(docs, threshold=2) == brute(rows_of(docs), 2)
    assert ours(no_documents(spark)) == []
    clashing = docs.selectExpr("*", "1 AS a", "2 AS n", "'x' AS phrase", "3 AS code", "4 AS cell", "5 AS rank")
    assert ours(clashing, threshold=2) == brute(rows_of(docs), 2)


def test_ties_marks_and_null_language(spark):
    rng = random.Random(3)
    words = ["a", "B", "b", "ä", "Ä", "c.d", "e;f", "g\th", " ", "\x0b", "zz"]
    rows = [
        (i, " ".join(rng.choice(words) for _ in range(40)), rng.choice([None, "und", "en"]), None)
        for i in range(60)
    ]
    docs = documents(spark, rows)
    assert ours(docs, threshold=3) == brute(rows_of(docs), 3)


@settings(deadline=None, max_examples=100)
@given(st.lists(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 6)), max_size=60), max_size=8),
       st.integers(1, 12), st.integers(2, 30))
def test_a_frequent_code_survives_every_merge(streams, threshold, capacity):
    truth, summary = Counter(), Summary(capacity, threshold)
    for part in streams:
        local = Counter()
        for code, times in part:
            local[code] += times
        truth += local
        summary.add(np.array([*local], dtype=np.int64), np.array([*local.values()], dtype=np.int64))
        summary.merge()
    found = set(summary.survivors().tolist())
    assert {c for c, n in truth.items() if n >= threshold} <= found
    assert summary.error < threshold
    if summary.mass <= capacity * threshold:
        assert len(summary.codes) <= capacity + 1


def test_long_texts_are_cut_without_loss():
    import pyarrow as pa

    text = "Aa bb. cc dd\tee " * 50 + "x" * 500 + " y z"
    batch = pa.RecordBatch.from_pydict({"lang": ["en"], "text": [text]})
    whole = [t for _, t, _ in chunks([batch], 1 << 20)]
    cut = [t[fresh:] for _, t, fresh in chunks([batch], 64)]
    assert len(cut) > 5 and sum(cut, []) == whole[0]


def test_filter_lets_all_members_pass(spark):
    codes = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5000)
    bits = bit_filter.bitmap(spark.createDataFrame([(int(c),) for c in codes], "code long"), "code")
    assert bit_filter.passing(bits, codes.view(np.uint64)).all()
    others = np.random.default_rng(2).integers(0, 1 << 63, 5000).view(np.uint64)
    assert bit_filter.passing(bits, others).mean() < 0.01


def test_filter_of_few_codes_is_small_and_made_by_few_jobs(spark):
    codes = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 3000)
    table, context = spark.createDataFrame([(int(c),) for c in codes], "code long"), spark.sparkContext
    changed = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    context.setJobGroup("filter", "filter")
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        bits = bit_filter.bitmap(table, "code")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(context.statusTracker().getJobIdsForGroup("filter")) < 5
    assert len(bits) < 1 << 20 and bit_filter.passing(bits, codes.view(np.uint64)).all()
    others = np.random.default_rng(4).integers(-(2**63), 2**63 - 1, 100_000).view(np.uint64)
    assert bit_filter.passing(bits, others).mean() < 0.002
