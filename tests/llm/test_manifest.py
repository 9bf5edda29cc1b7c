"""The Merkle manifest against a plain tree over all rows."""

import hashlib
import random
import zlib

import duckdb
import pytest

from stockledger.llm import manifest
from stockledger.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, rank int, tree string, n int, id string"


def h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf_of(*values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(digests):
    """All levels of a tree, leaves first."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded root of the tampered leaf) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0], leaf_of(*r), r))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {k: climb([x[2] for x in sorted(v, key=lambda x: x[:3] if x[0] else (False, 0, x[2]))]) for k, v in groups.items()}
    top = climb([trees[k][-1][0] for k in names])
    found = []
    for at, k in enumerate(names):
        members = sorted(groups[k], key=lambda x: x[:3] if x[0] else (False, 0, x[2]))
        for rank, (_, i, leaf, r) in enumerate(members):
            changed = i is not None and zlib.crc32(str(i).encode()) % 7 == 0 and r[3] is not None
            proof, mine = "", leaf_of(r[0], r[1], r[2], r[3] + 1, r[4]) if changed else leaf
            for levels, place in ((trees[k], rank), (top, at)):
                for row in levels[:-1]:
                    other = place ^ 1
                    sibling = row[other] if other < len(row) else ""
                    proof += sibling
                    mine = h(sibling + mine if other < place else mine + sibling)
                    place >>= 1
            found.append((i, leaf, trees[k][-1][0], top[-1][0], h(proof), mine))
    return found


def table(spark, folder, rows):
    clash = ("x", 1, "0", 2, "y")
    spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3], *clash) for r in rows], SCHEMA).write.parquet(f"{folder}/documents.parquet")


def rows_of(n_by_lang, rng):
    rows = []
    for lang, n in n_by_lang.items():
        rows += [(rng.randrange(10**9), f"src{rng.randrange(3)}", lang, rng.randrange(5000), "".join(rng.choice("ab é\n") for _ in range(rng.randrange(60)))) for _ in range(n)]
    return rows


EDGES = [
    (None, None, None, None, None), (None, None, None, None, None), (None, "s", "en", 3, "abc"), (7, None, "en", None, ""), (7, None, "en", None, ""), (7, "s", "en", 5, "x" * 300_000),
    (-3, "s", "", 0, None), (9, "s", "é", 2**63 - 1, "t"), (4, "s", "zz", 1, "alone"),
]


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 2}, {None: 3, "de": 65, "en": 64, "fr": 130}, {f"l{i}": 1 + i % 3 for i in range(70)}, {"en": 4_200, "de": 1}, {"en": 500}])
def test_query_equals_plain_tree(spark, tmp_path, sizes):
    rows = rows_of(sizes, random.Random(str(sizes)))
    if None in sizes:
        rows += EDGES
    table(spark, tmp_path, rows)
    got = QUERIES["op11_merkle_manifest"](spark, str(tmp_path)).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(plain(rows), key=str)
    assert all(r.verified == (r.folded_root == r.root) for r in got)
    assert any(r.verified for r in got)


def test_tampering_is_found_and_only_that(spark, sf):
    docs = duckdb.sql(f"select doc_id, n_chars from '{sf}/documents.parquet'").fetchall()
    got = {r.doc_id: r.verified for r in QUERIES["op11_merkle_manifest"](spark, sf).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 7 != 0 or n is None for i, n in docs} and not all(got.values())


def test_proofs_of_some_rows_and_of_none(spark):
    docs = spark.createDataFrame([(i, "s", "en" if i % 3 else None, 4, f"text {i}") for i in range(300)], "doc_id long, source string, lang string, n_chars long, text string")
    made = manifest.build(docs)
    asked = spark.createDataFrame([(5,), (6,), (6,), (299,), (1_000,), (None,)], "id long")
    some = manifest.checked(manifest.prove(made, asked), made.root).collect()
    everything = {r.id: r for r in manifest.checked(manifest.prove(made), made.root).collect()}
    assert sorted(r.id for r in some) == [5, 6, 299] and all(r == everything[r.id] and r.verified for r in some)
    # A record names what it holds, so like records are one; the parts of a path are reversed once.
    assert all(manifest.folded(r.leaf, r.siblings) == made.root for r in some)
    empty = manifest.build(docs.limit(0))
    assert empty.root is None and manifest.prove(empty).count() == 0
    assert manifest.prove(made, asked.limit(0)).count() == 0
