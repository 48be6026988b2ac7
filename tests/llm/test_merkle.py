import hashlib
import random
import zlib

import pytest

from checks.compare import compare, connect
from cellframe.llm import merkle

NAMES = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(digests):
    """(last digest, for each leaf its siblings as (side, digest or None))."""
    ways, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for way, k in zip(ways, at):
            other = k ^ 1
            way.append(("-", None) if other >= len(digests) else ("L" if other < k else "R", digests[other]))
        digests = [H(*digests[i:i + 2]) for i in range(0, len(digests), 2)]
        at = [k // 2 for k in at]
    return digests[0], ways


def expected(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    subroots, made = [], []
    for name in names:
        own = sorted(trees[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subroot, ways = climb([leaf(r) for r in own])
        subroots.append(subroot)
        made.append((own, ways))
    if not names:
        return []
    root, tops = climb(subroots)
    out = []
    for subroot, (own, ways), top in zip(subroots, made, tops):
        for r, way in zip(own, ways):
            start = r
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                start = (*r[:3], r[3] + 1, r[4])
            folded = leaf(start)
            for side, other in way + top:
                folded = H(other, folded) if side == "L" else H(folded, other or "")
            out.append((r[0], leaf(r), subroot, root, H(*(x for _, x in way + top if x)), folded, folded == root))
    return sorted(out, key=repr)


def some_rows(n, rng):
    langs = ["en"] * 6 + ["de", None, "é", "z", ""]
    return [(rng.choice([i, i, None, 3]), rng.choice(["s", None]), rng.choice(langs), rng.choice([i, None, 2**63 - 1]), rng.choice([f"text é {i}", "", None]))
            for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 500])
def test_manifest_by_hand(spark, n, monkeypatch):
    rows = some_rows(n, random.Random(n))
    rows += rows[: n // 4]
    table = spark.createDataFrame([(*r, "x") for r in rows], NAMES + ", idx string").repartition(3)
    got = sorted((tuple(r) for r in merkle.document_manifest(table).collect()), key=repr)
    assert got == expected(rows)


def test_blocks_smaller_than_trees(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 2)  # several passes, ancestors repeated for many blocks
    monkeypatch.setattr(merkle, "_levels", lambda base, make=merkle._levels: make(base, 2))
    rows = [(i, "s", "en" if i % 9 else f"l{i}", i, f"t{i}") for i in range(300)]
    table = spark.createDataFrame(rows, NAMES)
    assert sorted((tuple(r) for r in merkle.document_manifest(table).collect()), key=repr) == expected(rows)


def test_very_long_text_and_one_null_row(spark):
    rows = [(1, None, None, None, None), (7, "s", "en", 1, "word " * 400_000)]
    assert sorted((tuple(r) for r in merkle.document_manifest(spark.createDataFrame(rows, NAMES)).collect()), key=repr) == expected(rows)


def test_own_columns_and_clashes(spark):
    leaves = spark.createDataFrame([("a", 2, "p"), ("a", 1, "q"), ("b", 5, "r")], "tree string, at int, name string")
    leaves = leaves.withColumn("digest", merkle.leaf_digest(leaves["name"]))
    made = {r["name"]: r for r in merkle.manifest(leaves, ["at"]).collect()}
    assert [(made[n]["tree"], made[n]["idx"], made[n]["sides"]) for n in "pqr"] == [("a", 1, "LR"), ("a", 0, "RR"), ("b", 0, "L")]
    assert len({bytes(r["root"]) for r in made.values()}) == 1
    with pytest.raises(ValueError):
        merkle.manifest(leaves.withColumnRenamed("name", "Proof"), ["at"])


def test_empty_table(spark):
    assert merkle.document_manifest(spark.createDataFrame([], NAMES)).collect() == []


def test_query_matches_sql(spark, sf_small):
    assert compare(spark, connect(sf_small), sf_small, merkle.op11_merkle_manifest, merkle.SQL)[0] == "ok"
