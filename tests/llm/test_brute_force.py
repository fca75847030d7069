"""Ops 3 and 7 against versions in plain loops."""

import math
import re
from collections import Counter, defaultdict

import pytest

from siltstone.llm import gear_dedup, language_mixture
from tests.llm.helpers import held_out, odd_documents, sample_documents


def buckets(text):
    b = f" {text.lower()} ".encode()
    b = bytes(x if x >= 128 or chr(x).isalpha() else 32 for x in b)
    out = Counter()
    for i in range(len(b) - 2):
        if b[i:i + 3] != b"   ":
            code = b[i] << 16 | b[i + 1] << 8 | b[i + 2]
            out[(code * 2654435761 % 2**32) >> (33 - language_mixture.BUCKETS.bit_length())] += 1
    return out


def proportions(n, p, weights):
    if len(weights) == 1:
        return [1.0], sum(k * math.log(p[t][0]) for t, k in n.items())
    total = sum(n.values())
    for _ in range(language_mixture.ROUNDS):
        gained = [0.0] * len(weights)
        for t, k in n.items():
            fit = sum(w * x for w, x in zip(weights, p[t]))
            for i, x in enumerate(p[t]):
                gained[i] += k / fit * x
        after = [w * g / total for w, g in zip(weights, gained)]
        near = max(abs(a - w) for a, w in zip(after, weights)) < language_mixture.CLOSE
        weights = after
        if near:
            break
    return weights, sum(k * math.log(sum(w * x for w, x in zip(weights, p[t]))) for t, k in n.items())


def best(text, names, probability):
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0
    n = buckets(text)
    allowed = language_mixture.PENALTY * math.log(max(sum(n.values()), 2))
    kept = list(range(len(names)))

    def fitted(of, start):
        scale = sum(start)
        return proportions(n, {t: [probability[i][t] for i in of] for t in n}, [s / scale for s in start])

    weights, fit = fitted(kept, [1.0] * len(kept))
    strong = [(k, w) for k, w in zip(kept, weights) if w > language_mixture.FAINT]
    kept, weights = [k for k, _ in strong], [w / sum(w for _, w in strong) for _, w in strong]
    while len(kept) > 1:
        out = weights.index(min(weights))
        rest = [i for i in range(len(kept)) if i != out]
        fewer, less = fitted([kept[i] for i in rest], [weights[i] for i in rest])
        if fit - less >= allowed:
            break
        kept, weights, fit = [kept[i] for i in rest], fewer, less
    first = max(range(len(kept)), key=lambda i: (weights[i], -kept[i]))
    return names[kept[first]], weights[first]


def test_languages_equal_plain_expectation_maximisation(spark):
    docs = sample_documents(spark)
    rows, counts = docs.collect(), defaultdict(Counter)
    for r in rows:
        if not held_out(r.doc_id) and r.lang is not None and r.text is not None:
            counts[r.lang] += buckets(r.text)
    names, size = sorted(counts), language_mixture.BUCKETS
    totals = [sum(counts[x].values()) + language_mixture.SMOOTHING * size for x in names]
    probability = [
        [(counts[x][t] + language_mixture.SMOOTHING) / total for t in range(size)]
        for x, total in zip(names, totals)
    ]
    found = {r.doc_id: r for r in language_mixture.identify_documents(docs).collect()}
    chosen = [r for r in rows if len(r.text) < 4000]
    assert len(chosen) > 100 and len(found) == len(rows)
    for r in chosen:
        lang, share = best(r.text, names, probability)
        assert found[r.doc_id].lang_pred == lang
        assert found[r.doc_id].score == pytest.approx(min(1.0, share), abs=1e-6)


def cut_places(data):
    """Starts of chunks and their words, by a gear hash summed up byte by byte."""
    words = [m.start() for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
    starts, since = [], 0
    for k, w in enumerate(words):
        at, h = max(w - 1, 0), 0
        for age in range(gear_dedup.WINDOW):
            if at - age >= 0:
                h += int(gear_dedup.GEAR[data[at - age]]) << age
        if k == 0 or (h % 2**32 >> 16) % gear_dedup.ONE_IN == 0:
            starts.append(k)
            since = k
        elif (k - since) % gear_dedup.MOST_WORDS == 0:
            starts.append(k)
    counts = [b - a for a, b in zip(starts, [*starts[1:], len(words)])]
    return [0, *(words[k] for k in starts[1:])], counts


def without_repeats(rows):
    documents = sorted(
        {(d, t) for d, t in rows if t is not None and re.search(r"[^\x20\x09-\x0D]", t)},
        key=lambda r: (r[0] is None, r[0] or 0, gear_dedup.text_hash(r[1].encode())),
    )
    first, texts = {}, {}
    for d, t in documents:
        data = t.encode()
        starts, counts = cut_places(data)
        own = [data[a:b].strip() for a, b in zip(starts, [*starts[1:], len(data)])]
        repeated = [False] * len(own)
        for i, pair in enumerate(zip(own, own[1:])):
            if first.setdefault(pair, (d, t, i)) != (d, t, i):
                repeated[i] = repeated[i + 1] = True
        kept, at, i = [], 0, 0
        ends = [*starts, len(data)]
        while i < len(own):
            j = i
            while j < len(own) and repeated[j]:
                j += 1
            if sum(counts[i:j]) >= gear_dedup.LEAST_WORDS:
                kept.append(data[at:ends[i]])
                at = ends[j]
            i = max(j, i + 1)
        texts[d, t] = b"".join([*kept, data[at:]]).decode().strip() if kept else t
    return sorted(((d, texts.get((d, t), t)) for d, t in rows), key=repr)


@pytest.mark.parametrize("chunk", [200, gear_dedup.CHUNK])
def test_repeats_equal_plain_loops(spark, monkeypatch, chunk):
    monkeypatch.setattr(gear_dedup, "CHUNK", chunk)
    for table in (sample_documents(spark).repartition(5), odd_documents(spark)):
        rows = [(r.doc_id, r.text if r.text is None else r.text[:20_000]) for r in table.select("doc_id", "text").collect()]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        found = [(r.doc_id, r.text) for r in gear_dedup.remove_repeats(docs).collect()]
        assert sorted(found, key=repr) == without_repeats(rows)
