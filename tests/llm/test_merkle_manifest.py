"""Op 13 against a plain tree."""

import hashlib
import zlib

import pytest

from siltstone.llm import merkle_manifest
from tests.llm.helpers import documents, no_documents, odd_documents, sample_documents

TABLE = "doc_id long, source string, lang string, n_chars int, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The top of a tree, and for each leaf its siblings as (before, after), lowest level first."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, above_owners = [], []
        for start in range(0, len(nodes), 8):
            run = nodes[start:start + 8]
            for at in range(len(run)):
                for i in owners[start + at]:
                    paths[i].append(("".join(run[:at]), "".join(run[at + 1:])))
            above.append(digest("".join(run)))
            above_owners.append([i for part in owners[start:start + 8] for i in part])
        nodes, owners = above, above_owners
    return nodes[0], paths


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row.lang, []).append((row, leaf(row, row.text)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops, inner = [], []
    for name in names:
        groups[name].sort(key=lambda x: (x[0].doc_id is not None, x[0].doc_id or 0, x[1]))
        top, paths = tree([h for _, h in groups[name]])
        tops.append(top)
        inner.append(paths)
    root, outer = tree(tops)
    out = []
    for name, top, paths, rest in zip(names, tops, inner, outer):
        for (row, h), path in zip(groups[name], paths):
            node = h
            if row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0:
                small = row.text and row.text.encode().lower().decode()
                node = leaf(row, small)
            for before, after in path + rest:
                node = digest(before + node + after)
            proof = digest("".join(a + b for a, b in path + rest))
            out.append((row.doc_id, h, top, root, proof, node, node == root))
    return sorted(out, key=repr)


def ours(df, levels):
    return sorted((tuple(r) for r in merkle_manifest.verify_documents(df, levels).collect()), key=repr)


@pytest.mark.parametrize("rows, levels", [(1, 1), (7, 3), (9, 1), (64, 3), (65, 1), (600, 3)])
def test_every_size_of_tree(spark, rows, levels):
    table = spark.createDataFrame(
        [(i * 7919 % 10_007, None if i % 5 == 0 else f"s{i}", "en", i, f"Text {i}") for i in range(rows)],
        TABLE,
    )
    assert ours(table, levels) == brute(table.collect())


def test_many_groups_of_uneven_size(spark):
    langs = [None, "", "-", "=", "é", "zz", *(f"l{i}" for i in range(60))]
    table = spark.createDataFrame(
        [(i, "s", langs[(i * i) % len(langs)] if i % 3 else "en", None, "A" * (i % 4)) for i in range(300)],
        TABLE,
    ).repartition(5)
    assert ours(table, 1) == brute(table.collect())


def test_odd_rows_and_clashing_columns(spark):
    table = odd_documents(spark).selectExpr("*", "length(text) AS n_chars", "1 AS key", "'p' AS path",
                                            "2 AS pos", "3 AS total", "'n' AS node")
    assert ours(table, 3) == brute(table.collect())
    assert ours(no_documents(spark).selectExpr("*", "1 AS n_chars"), 3) == []


def test_repeated_rows_and_a_doc_id_that_many_share(spark):
    rows = [(1, f"T{i % 3}", "en", "a") for i in range(90)] + [(None, "x", None, None)] * 20
    table = documents(spark, rows).selectExpr("*", "cast(null AS int) AS n_chars")
    assert ours(table, 1) == brute(table.collect())


def test_sample_verifies_exactly_what_was_left_alone(spark):
    table = sample_documents(spark)
    found = {r.doc_id: r for r in merkle_manifest.verify_documents(table).collect()}
    assert len(found) == table.count()
    for row in table.collect():
        tampered = zlib.crc32(str(row.doc_id).encode()) % 3 == 0 and any(
            "A" <= c <= "Z" for c in row.text
        )
        assert found[row.doc_id].verified == (not tampered)
