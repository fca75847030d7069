"""Op 11 against all pairs."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import minhash_dedup
from siltstone.llm.minhash_dedup import deduplicate, links, union_estimate
from siltstone.llm.jaccard_join import shingle_set
from tests.llm.helpers import documents, no_documents, odd_documents, sample_documents, texts_of


def brute(rows, percent=85):
    """doc_id, n_shingles, component_id, kept by checking all pairs of distinct sets."""
    sets = [shingle_set(t, 5) for _, t in rows]
    one = {s.tobytes(): s for s in sets if len(s)}
    names = [*one]
    parent = {v: v for v in names}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(names):
        for b in names[:i]:
            x, y = one[a], one[b]
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                continue
            common = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * common >= percent * (len(x) + len(y) - common):
                parent[find(a)] = find(b)
    least = {}
    for (d, _), s in zip(rows, sets):
        if len(s) and d is not None:
            root = find(s.tobytes())
            least[root] = min(d, least.get(root, d))
    out = []
    for (d, _), s in zip(rows, sets):
        component = least.get(find(s.tobytes())) if len(s) else d
        out.append((d, len(s), component, d == component))
    return sorted(out, key=repr)


def ours(df, **options):
    return sorted((tuple(r) for r in deduplicate(df, **options).collect()), key=repr)


def edited(rng, words, times):
    words = list(words)
    for at in rng.integers(0, len(words), times):
        words[at] = f"e{rng.integers(1 << 40)}"
    return words


def groups(seed):
    """Originals of all lengths with copies of zero to nine edits, and texts around one passage."""
    rng, rows = np.random.default_rng(seed), []
    passage = [f"p{i}" for i in range(60)]
    for length in (1, 3, 4, 5, 6, 8, 12, 30, 60, 150, 230, 300, 400, 900):
        base = [f"w{x}" for x in rng.integers(0, 3000, length)]
        for times in (0, 0, 1, 1, 2, 2, 3, 4, 6, 9):
            rows.append(edited(rng, base, times))
        rows.append(passage + base)
        rows.append(base[: length * 9 // 10])
    return [(i, " ".join(words)) for i, words in enumerate(rows)]


@pytest.mark.parametrize("k", [16, 256])
def test_groups_equal_all_pairs(spark, k):
    rows = groups(1)
    df = documents(spark, [(i, t, "en", "a") for i, t in rows]).repartition(6)
    # A sketch of 16 hashes cuts most sets; the allowed number of missing ones still covers them.
    assert ours(df, k=k) == brute(rows)


def test_sample_equals_all_pairs(spark):
    docs = sample_documents(spark)
    assert ours(docs) == brute(texts_of(docs))


def test_odd_rows(spark):
    assert ours(odd_documents(spark)) == brute(texts_of(odd_documents(spark)))
    assert ours(no_documents(spark)) == []
    clashing = odd_documents(spark).selectExpr("*", "1 AS n", "2 AS value", "3 AS root", "4 AS text_key", "5 AS sketch")
    assert ours(clashing) == brute(texts_of(clashing))


@pytest.mark.parametrize("size", [100, 400])
def test_near_copies_that_do_not_link_give_few_pairs(spark, size):
    rng = np.random.default_rng(7)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(edited(rng, base, 9)), "en", "a") for i in range(size)]
    df = documents(spark, rows)
    sets = minhash_dedup.sketches(df).cache()
    lists = minhash_dedup.postings(sets, minhash_dedup.shared_values(sets), 256, 85).cache()
    stars = minhash_dedup.star_pairs(lists, 85).count()
    roots = spark.createDataFrame([], "vertex long, root long")
    assert stars + minhash_dedup.open_pairs(lists, roots, 256, 85).count() < size


def test_long_near_copies_that_do_not_link_give_few_pairs(spark):
    """Sets of 1500, of which 256 bits rule out none."""
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(1500)]
    df = documents(spark, [(i, " ".join(edited(rng, base, 36)), "en", "a") for i in range(60)])
    sets = minhash_dedup.sketches(df).cache()
    lists = minhash_dedup.postings(sets, minhash_dedup.shared_values(sets), 256, 85).cache()
    roots = spark.createDataFrame([], "vertex long, root long")
    assert minhash_dedup.open_pairs(lists, roots, 256, 85).count() > 600
    assert minhash_dedup.open_pairs(lists, roots, 256, 85, sets).count() == 0


@settings(deadline=None, max_examples=60)
@given(st.integers(1, 600), st.integers(0, 200), st.integers(0, 200), st.integers(0, 99))
def test_sketch_never_rules_out_a_link(common, left, right, seed):
    rng = np.random.default_rng(seed)
    pool = np.unique(rng.integers(0, 1 << 63, common + left + right + 50).astype(np.uint64))
    rng.shuffle(pool)
    a = np.sort(pool[: common + left])
    b = np.sort(np.concatenate([pool[:common], pool[common + left: common + left + right]]))
    true = 100 * common >= 85 * (common + left + right)
    assert links(a, b) == true
    estimate, seen = union_estimate(a, b, 10_000)
    assert seen == common + left + right and abs(estimate - common / seen) < 1e-12
