"""Ops 2, 6, 7 and 9 against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import bottom_k, gear_dedup, jaccard_join, ngram_ratio, text
from siltstone.llm.components import components
from tests.llm.helpers import (
    WORD, documents, no_documents, odd_documents, sample_documents, sample_labels, texts_of,
)


def shingles(value, size, fold=True):
    words = WORD.findall(value or "")
    if fold:
        words = [w.encode().lower().decode() for w in words]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def brute_components(rows, n=3, percent=90):
    """Components by checking all pairs of distinct sets."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [
        (d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))
    ]


def edited_copies(seed=5):
    """Chains and groups of near copies of all sizes, around the border of 0.9."""
    rng = np.random.default_rng(seed)
    rows, number = [], 100
    for size in (3, 9, 11, 12, 14, 19, 20, 21, 22, 24, 30, 45, 60, 90, 150):
        for _ in range(3):
            words = [f"w{x}" for x in rng.integers(0, 5000, size + 2)]
            for _ in range(7):
                rows.append((number, " ".join(words)))
                number += 1
                words = list(words)
                kind = rng.integers(0, 4)
                if kind == 0:
                    words[-1] = f"v{rng.integers(0, 99)}"
                elif kind == 1:
                    words.append(f"u{rng.integers(0, 99)}")
                elif kind == 2 and len(words) > 3:
                    words = words[1:]
                else:
                    words[rng.integers(0, len(words))] = f"z{rng.integers(0, 99)}"
    return rows


def test_join_finds_every_link(spark):
    for rows in (edited_copies(), [(d, t) for d, t in texts_of(odd_documents(spark)) if d != 9]):
        docs = documents(spark, [(d, t, None, None) for d, t in rows])
        found = sorted(map(tuple, jaccard_join.link_components(docs).collect()), key=repr)
        assert found == sorted(brute_components(rows), key=repr)
    assert jaccard_join.link_components(no_documents(spark)).count() == 0


def test_join_of_the_sample(spark):
    docs = sample_documents(spark)
    found = sorted(map(tuple, jaccard_join.link_components(docs).collect()))
    assert found == sorted(brute_components(texts_of(docs)))
    assert len({r[2] for r in found}) < len(found)


@pytest.mark.parametrize("boundary", jaccard_join.BOUNDARIES)
def test_linked_sets_share_a_signature(boundary):
    rng = np.random.default_rng(boundary)
    for n in [*range(1, 45), 60, 120, 200]:
        for _ in range(12):
            s = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
            lose, gain = rng.integers(0, n // 9 + 2, 2)
            kept = s[np.sort(rng.permutation(len(s))[lose:])]
            other = np.unique(np.concatenate([kept, rng.integers(0, 1 << 62, gain).astype(np.uint64)]))
            if not len(other):
                continue
            shared = len(np.intersect1d(s, other))
            if jaccard_join.linked(shared, len(s), len(other)):
                one, two = (set(jaccard_join.signatures(x, boundary)) for x in (s, other))
                assert one & two, (n, len(other), shared)


@pytest.mark.parametrize("boundary", jaccard_join.BOUNDARIES[:2])
def test_sets_linked_by_another_rule_share_a_signature(boundary):
    rule, rng = jaccard_join.Rule(5, 80), np.random.default_rng(boundary)
    for n in [*range(1, 24), 30, 60, 120]:
        for _ in range(6):
            s = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
            lose, gain = rng.integers(0, n // 8 + 2, 2)
            kept = s[np.sort(rng.permutation(len(s))[lose:])]
            other = np.unique(np.concatenate([kept, rng.integers(0, 1 << 62, gain).astype(np.uint64)]))
            shared = len(np.intersect1d(s, other))
            if len(other) and max(len(s), len(other)) < 30 or boundary == 9 and len(other):
                if jaccard_join.linked(shared, len(s), len(other), rule):
                    one, two = (set(jaccard_join.signatures(x, boundary, rule)) for x in (s, other))
                    assert one & two, (n, len(other), shared)


def test_join_by_another_rule(spark):
    """Copies with 15 % more words and copies with a few words edited, of 20 to 200 words."""
    rng, rows = np.random.default_rng(8), []
    for size in (8, 14, 20, 40, 100, 200):
        base = [f"w{x}" for x in rng.integers(0, 9000, size)]
        longer = base + [f"u{x}" for x in rng.integers(0, 9000, size * 15 // 100)]
        edited = [f"z{size}" if i % 50 == 9 else w for i, w in enumerate(base)]
        for d, words in enumerate((base, longer, edited, base[::-1])):
            rows.append((10 * size + d, " ".join(words)))
    docs = documents(spark, [(d, t, None, None) for d, t in rows])
    found = sorted(map(tuple, jaccard_join.link_components(docs, jaccard_join.Rule(5, 80)).collect()))
    sets = [shingles(t, 5) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    least = {g: min(d for (d, _), x in zip(rows, group) if x == g) for g in group}
    assert found == sorted((d, len(s), least[g]) for (d, _), s, g in zip(rows, sets, group))
    assert len(least) < len({c for *_, c in brute_components(rows)})


def test_large_lists_are_worked_off(spark, monkeypatch):
    """Lists with several components: chunks of a few postings, one new hub at a time."""
    monkeypatch.setattr(jaccard_join, "CHUNK", 50)
    monkeypatch.setattr(jaccard_join, "ROUND_PAIRS", 1)
    rows = edited_copies(9)[100:220]
    docs = documents(spark, [(d, t, None, None) for d, t in rows])
    found = sorted(map(tuple, jaccard_join.link_components(docs).collect()))
    assert found == sorted(brute_components(rows))


def test_unlinked_near_copies_take_few_rounds(spark, monkeypatch):
    """Copies that share most blocks with each other and link with few, in two tasks."""
    rng, rounds, found = np.random.default_rng(4), [], jaccard_join.next_pairs
    monkeypatch.setattr(jaccard_join, "next_pairs", lambda *a: rounds.append(1) or found(*a))
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(edited(rng, words, 8))) for i in range(120)]
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows]).repartition(2)
    result = sorted(map(tuple, jaccard_join.link_components(docs).collect()))
    assert result == sorted(brute_components(rows))
    assert len(rounds) == 2  # a few hubs, then all


def test_unlinked_long_texts_of_open_lists_are_not_paired(spark, monkeypatch):
    """Long texts that share a passage lie in the same lists; of their pairs those that link are left."""
    rng, made, found = np.random.default_rng(6), [], jaccard_join.next_pairs

    def counted(*a):
        hubs, pairs = found(*a)
        made.append(pairs.count())
        return hubs, pairs

    monkeypatch.setattr(jaccard_join, "next_pairs", counted)
    passage, rows = [f"p{i}" for i in range(700)], []
    for i in range(0, 60, 2):
        own = passage + [f"o{i}x{j}" for j in range(1000)]
        rows += [(i, " ".join(own)), (i + 1, " ".join(edited(rng, own, 30)))]
    docs = documents(spark, [(d, t, "en", "a") for d, t in rows]).repartition(2)
    result = sorted(map(tuple, jaccard_join.link_components(docs, jaccard_join.Rule(5, 80)).collect()))
    assert [c for *_, c in result] == [i // 2 * 2 for i in range(60)]
    assert made and sum(made) < 30


def test_near_copies_are_paired_in_few_of_their_lists(spark, monkeypatch):
    """Copies that do not link, of which the sketch of 512 bits tells little, share many lists."""
    rng, made, found = np.random.default_rng(3), [], jaccard_join.meetings

    def counted(*a):
        both = found(*a)
        made.append([tuple(r) for r in both.collect()])
        return both

    monkeypatch.setattr(jaccard_join, "meetings", counted)
    words = [f"w{i}" for i in range(490)]
    rows = [(i, " ".join(edited(rng, words, 7))) for i in range(40)]
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows]).repartition(2)
    results, times, pairs = [], [], []
    for lists in (jaccard_join.FIRST_LISTS, 0):  # without first lists a pair is made in each list
        monkeypatch.setattr(jaccard_join, "FIRST_LISTS", lists)
        made.clear()
        results.append(sorted(map(tuple, jaccard_join.link_components(docs, jaccard_join.Rule(5, 80)).collect())))
        times.append(sum(map(len, made)))
        pairs.append({frozenset(p) for p in sum(made, [])})
    assert results[0] == results[1] == sorted(brute_components(rows, 5, 80))
    assert pairs[0] == pairs[1] and len(pairs[0]) > 300
    assert times[0] < 5 * len(pairs[0]) and times[1] > 10 * len(pairs[0])


def test_plan_of_a_rounds_pairs_is_small(spark, monkeypatch, capsys):
    """The driver plans a query anew after each of its stages; a round's pairs were its largest by far."""
    rng, plans, found = np.random.default_rng(4), [], jaccard_join.next_pairs

    def explained(*a):
        hubs, pairs = found(*a)
        capsys.readouterr()
        pairs.explain()
        plans.append(capsys.readouterr().out)
        return hubs, pairs

    monkeypatch.setattr(jaccard_join, "next_pairs", explained)
    words = [f"w{i}" for i in range(600)]
    rows = [(i, " ".join(edited(rng, words, 20))) for i in range(30)]
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows]).repartition(2)
    result = sorted(map(tuple, jaccard_join.link_components(docs).collect()))
    assert result == sorted(brute_components(rows))
    assert plans and all("Join" in p for p in plans)
    assert max(p.count("Exchange") for p in plans) <= 12
    assert max(map(len, plans)) < 20_000


def edited(rng, words, times):
    words = list(words)
    for at in rng.integers(0, len(words), times):
        words[at] = f"e{rng.integers(1 << 40)}"
    return words


@pytest.mark.parametrize("boundary", jaccard_join.BOUNDARIES[:2])
def test_signatures_of_many_sets_are_those_of_each(boundary):
    rng = np.random.default_rng(boundary)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 9, 10, 11, 11, 24, 40, 41, 300)]
    sig, row = jaccard_join.signatures_of(sets, boundary)
    for i, s in enumerate(sets):
        assert sorted(sig[row == i].tolist()) == sorted(jaccard_join.signatures(s, boundary))
    assert [len(x) for x in jaccard_join.signatures_of([], boundary)] == [0, 0]


@pytest.mark.parametrize("chunk", [1, jaccard_join.CHUNK])
def test_short_near_copies_meet_across_tasks(spark, monkeypatch, chunk):
    """Two texts longer by a word each and the text they contain, in different tasks: the longer
    ones do not link, and their task knows no smaller set."""
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    rows, parts = [], []
    for size in range(11, 20):
        base = [f"w{size}x{i}" for i in range(size)]
        for d, more, part in ((1, ["left"], 0), (2, ["right"], 0), (3, [], 1), (4, ["far"], 2), (5, ["away"], 2)):
            rows.append((100 * size + d, " ".join(base + more)))
            parts.append(part)
    dealt = [[r for r, p in zip(rows, parts) if p == part] for part in range(3)]
    docs = spark.createDataFrame(
        spark.sparkContext.parallelize(dealt, 3).flatMap(lambda part: part), "doc_id long, text string"
    )
    assert docs.rdd.getNumPartitions() == 3
    found = sorted(map(tuple, jaccard_join.link_components(docs).collect()))
    assert found == sorted(brute_components(rows))
    assert len({r[2] for r in found}) == 9


def test_boundary_is_the_cheapest():
    assert jaccard_join.best_boundary({15: 100, 30: 1}) == 19
    assert jaccard_join.best_boundary({25: 100, 26: 100}) == 9


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = dict(map(tuple, components(df).collect()))
    assert all(found[i] == 0 for i in range(41)) and all(found[i] == 100 for i in range(100, 130))
    assert components(df.limit(0)).count() == 0


def test_a_task_connects_its_own_edges(spark, monkeypatch):
    from siltstone.llm import components as module

    written, write = [], module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, label: written.append(label) or write(df, label))
    df = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long").coalesce(1)
    assert {r.root for r in components(df).collect()} == {0}
    assert len(written) <= 3
    monkeypatch.setattr(module, "VERTICES", 7)
    assert {r.root for r in components(df.repartition(3)).collect()} == {0}


def test_few_edges_are_connected_in_one_step(spark, monkeypatch):
    from siltstone.llm import components as module

    written, write = [], module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, label: written.append(label) or write(df, label))
    df = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long").repartition(20)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = components(df)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert {r.root for r in found.collect()} == {0}
    assert written == ["forest"]


def test_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(bottom_k, "RANGE_DOCUMENTS", 40)
    docs = sample_documents(spark)
    rows = sorted(texts_of(docs), reverse=True)
    found = {r.doc_id: r for r in bottom_k.fingerprint_documents(docs).collect()}
    assert len(found) == len(rows)
    by_text = {}
    for i, (d, t) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        r = found[d]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        a, b, c = ({tuple(x) for x in shingles(v.lower(), 5, False)} for v in (t, edited, following))
        small = len(a | b) <= bottom_k.K
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        assert abs(r.near_edited - like(a, b)) < (1e-9 if small else 0.15)
        assert abs(r.near_next - like(a, c)) < 0.15


def test_fingerprints_of_odd_rows(spark):
    rows = bottom_k.fingerprint_documents(odd_documents(spark)).collect()
    assert len(rows) == 10
    first = {r.doc_id: r for r in rows}
    assert first[1].fingerprint == "" and first[2].n_chars == 0
    assert first[5].fingerprint == first[6].fingerprint != ""
    assert first[3].near_next == 1.0  # both have no words
    alone = documents(spark, [(7, "a b c d e f g", None, None)])
    assert bottom_k.fingerprint_documents(alone).first().near_next == 1.0
    assert bottom_k.fingerprint_documents(no_documents(spark)).count() == 0


def test_sketches_merge_and_estimate(spark):
    left = [f"w{i} w{i + 1} w{i + 2} w{i + 3} w{i + 4}" for i in range(0, 3000, 5)]
    whole = documents(spark, [(1, " ".join(left), None, None), (2, " ".join(left[:300]), None, None)])
    rows = {r.doc_id: r.sketch for r in bottom_k.with_sketch(whole, 64).collect()}
    both = spark.createDataFrame([(rows[1], rows[2])], "a array<long>, b array<long>")
    from pyspark.sql import functions as F
    a, b = F.col("a"), F.col("b")
    got = both.select(
        bottom_k.merged(a, b, 64).alias("m"), bottom_k.distinct_shingles(a, 64).alias("n"),
        bottom_k.containment(b, a, 64).alias("in_a"),
        bottom_k.from_text(bottom_k.as_text(a)).alias("again"),
    ).first()
    assert got.m == sorted(set(rows[1]) | set(rows[2]))[:64] and got.again == rows[1]
    assert abs(got.n - 2996) / 2996 < 0.4 and got.in_a > 0.7


@given(st.lists(st.integers(-50, 50), unique=True, max_size=40), st.lists(st.integers(-60, 60), max_size=20))
@settings(max_examples=8, deadline=None)
def test_range_number(spark, bounds, keys):
    from pyspark.sql import functions as F
    bounds = sorted(bounds)
    df = spark.createDataFrame([(k,) for k in [*keys, 0]], "k long")
    for row in df.select("k", text.range_number(F.col("k"), bounds).alias("n")).collect():
        assert row.n == sum(b < row.k for b in bounds)


def brute_base(t):
    words = WORD.findall(t or "")
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 8))
    n, repeat = len(words), len(covered)
    symbols = len(re.findall(r"[#*$%&|<>]", t or ""))
    failed = n < 20 or 100 * repeat > 30 * n
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeat, failed


def test_quality_rules(spark):
    labels = sample_labels(spark)
    for docs in (odd_documents(spark), sample_documents(spark)):
        rows = ngram_ratio.judge_documents(docs, labels).collect()
        found = sorted((r.doc_id, *tuple(r)[1:7]) for r in rows if r.doc_id is not None)
        assert found == sorted((d, *brute_base(t)) for d, t in texts_of(docs) if d is not None)
        assert all(r.kept == (not r.base_failed and r.score >= ngram_ratio.THRESHOLD) for r in rows)
    quality = {r.doc_id: r.quality for r in labels.collect()}
    good = [r.kept for r in rows if quality.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r.kept for r in rows if quality.get(r.doc_id) == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.35
    assert ngram_ratio.judge_documents(no_documents(spark), labels).count() == 0
    alike = ngram_ratio.judge_documents(odd_documents(spark), labels.limit(0)).collect()
    assert len(alike) == 10


def test_ratio_equals_brute_force(spark):
    from pyspark.sql import functions as F
    rows = [(1, "a b a c", None, None), (2, "a b", None, None), (3, "x y z", None, None)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(2, 1), (2, 1), (None, 1), (3, 0)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in ngram_ratio.judge_documents(docs, labels).collect()}
    grams = docs.select("doc_id", ngram_ratio.ngram_buckets(
        ngram_ratio.hashed(text.words_of(F.col("text")))).alias("g")).collect()
    every = Counter(b for r in grams for b in r.g)
    target = Counter(b for r in grams if r.doc_id == 2 for b in r.g)
    size = ngram_ratio.BUCKETS
    for r in grams:
        logs = [
            np.log((target[b] + 1) / (sum(target.values()) + size))
            - np.log((every[b] + 1) / (sum(every.values()) + size)) for b in r.g
        ]
        assert got[r.doc_id] == pytest.approx(np.mean(logs), abs=1e-5)


def passage(seed, n=70):
    rng = np.random.default_rng(seed)
    return " ".join(f"word{x}" for x in rng.integers(0, 10**6, n))


def test_repeated_passages_go_and_the_rest_stays(spark):
    shared = passage(1)
    rows = [(i, f"{passage(100 + i, 40)}\n{shared} {passage(200 + i, 30 + i)}", None, None) for i in range(12)]
    rows += [(50, passage(7), None, None), (51, "All rights reserved. Some licence.", None, None)]
    rows += [(52, "All rights reserved. Some licence.", None, None), (53, rows[0][1], None, None)]
    rows += [rows[0], (None, shared, None, None)]
    docs = documents(spark, rows)
    found = gear_dedup.remove_repeats(docs).collect()
    assert len(found) == len(rows) and found[0].asDict().keys() > {"vertex", "removed_spans"}
    for r in found:
        old = next(t for d, t, *_ in rows if d == r.doc_id)
        if r.doc_id in (0, 50, 51, 52):
            assert r.text == old and r.removed_bytes == 0
        elif r.doc_id == 53:
            assert len(r.text) < 200
        elif r.doc_id is None:
            assert len(r.text) < 150
        else:
            assert passage(100 + r.doc_id, 40)[:200] in r.text and r.text.endswith(old[-120:])
            left = sum(w in r.text for w in shared.split())
            assert left < 35
            data = old.encode()
            spans = [(s.start, s.stop) for s in r.removed_spans]
            assert gear_dedup.without(data, spans) == r.text


def test_dedup_of_odd_rows(spark):
    rows = gear_dedup.remove_repeats(odd_documents(spark)).collect()
    old = odd_documents(spark).collect()
    short = {(r.doc_id, r.text) for r in rows if r.doc_id != 9}
    assert short == {(r.doc_id, r.text) for r in old if r.doc_id != 9}
    assert len(rows) == len(old)
    assert gear_dedup.remove_repeats(no_documents(spark)).count() == 0


@given(st.text("ab c\n", max_size=300), st.text("ab c\n", max_size=40))
@settings(max_examples=150, deadline=None)
def test_chunks_are_the_text_and_resist_shifts(body, front):
    data = body.encode()
    starts, words = gear_dedup.chunks(data)
    ends = [*starts[1:].tolist(), len(data)]
    assert b"".join(data[s:e] for s, e in zip(starts.tolist(), ends)) == data
    assert words.sum() == len(data.split())
    rolled = gear_dedup.gear_hashes(np.frombuffer(data, np.uint8)) if data else []
    for i in range(len(data)):
        plain = 0
        for b in data[max(0, i - gear_dedup.WINDOW + 1): i + 1]:
            plain = (plain * 2 + int(gear_dedup.GEAR[b])) % (1 << 32)
        assert plain == int(rolled[i])


def test_cuts_come_back_after_an_insertion():
    body = passage(3, 400).encode()
    one = {body[s:] for s in gear_dedup.chunks(body)[0].tolist()}
    moved = b"some new words " + body
    two = {moved[s:] for s in gear_dedup.chunks(moved)[0].tolist()}
    assert len(one & two) > 0.9 * len(one)
