"""Merkle manifest of a table, with inclusion proofs by pointer jumping.

Every row is a leaf, the SHA-256 of its columns with their lengths. The leaves of a tree (one for each language) stand in order; every
two consecutive nodes become their hash, a last single one becomes the hash of itself, until one is left, the subroot. The subroots
are the leaves of one more tree, whose last node is the root.

* **Places.** ``place`` numbers rows by a range partition that is written before it is counted: rows within a part, plus the
  sizes of the parts before. No tree is sorted in one task, and a hot tree spans many parts.
* **Nodes.** ``_levels`` hashes aligned blocks of 2^12 nodes, twelve levels at a time; n leaves take log(n) / 12 passes, and a pass
  has a 4096th of the rows of the one before. Each node but the last keeps a segment of one level: the side of its sibling, the
  sibling's digest, and its parent's digest.
* **Proofs.** ``proofs`` joins the nodes with themselves: in round k a node with a segment of 2^k levels takes on the segment of the
  ancestor at whose foot its own ends. Only nodes on levels that 2^(k+1) divides are needed afterwards, so every round moves little
  more than the leaves. A node high in a tree is the ancestor of very many; it is repeated for each block of 2^12 leaves below it, and
  joined by block, so no key has more than 4096 rows on the left and the copies are a 4096th of the leaves.

Each round is a written table, so a lost executor costs one round.
"""

from __future__ import annotations

import hashlib
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellframe.llm import common
from cellframe.llm.registry import query
from cellframe.session import discard, store

#: Levels that a pass hashes at a time: blocks of 2^12 nodes.
BLOCK = 12

#: What a leaf's digest covers, in this order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A value as a leaf has it: ``-`` for a null, or else its length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def place(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (tree, ...) with ``idx``, their places 0, 1, ... in their tree by ``order`` (nulls first), and the tree's ``size``.

    Rows that are equal in ``order`` may stand in any order. The result is a written table.
    """
    dealt = rows.withColumn("_salt", F.rand(7)).repartitionByRange("tree", *order, "_salt")  # equal rows can be cut apart
    cut = store(dealt.sortWithinPartitions("tree", *order).withColumn("_at", F.monotonically_increasing_id()).drop("_salt"))
    part = F.shiftright("_at", 33)  # what is written keeps its part and its place there
    sizes = cut.groupBy("tree", part.alias("part")).agg(F.count("*").alias("n"), F.min("_at").alias("first"))
    ahead = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col("tree").alias("_tree"), F.col("part").alias("_part"), (F.coalesce(F.sum("n").over(ahead), F.lit(0)) - F.col("first")).alias("_shift"),
        F.sum("n").over(Window.partitionBy("tree")).alias("size"),
    )
    joined = cut.join(sizes, (part == F.col("_part")) & (F.col("tree") == F.col("_tree")))
    placed = store(joined.withColumn("idx", F.col("_at") + F.col("_shift")).select(*rows.columns, "idx", "size"))
    discard(cut)
    return placed


_NODES = "tree string, level int, idx bigint, size bigint, side string, sibling binary, top binary, digest binary"


def _levels(base: int, levels: int = BLOCK):
    """Hashes blocks of (tree, idx, size, digest) of the level ``base``: nodes with segments, and the block's last node."""

    def run(block: pa.Table) -> pa.Table:
        tree, size = block.column("tree")[0].as_py(), block.column("size")[0].as_py()
        at = sorted(zip(block.column("idx").to_pylist(), block.column("digest").to_pylist()))
        first, digests = at[0][0], [d for _, d in at]
        out: list[tuple] = []
        level = base
        while level < base + levels and size > 2**level:
            texts = [d.hex().encode() for d in digests]
            parents = [hashlib.sha256(b"".join(texts[i:i + 2])).digest() for i in range(0, len(texts), 2)]
            for i, d in enumerate(digests):
                k = i ^ 1
                side = "-" if k >= len(digests) else "L" if k < i else "R"
                out.append((tree, level, first + i, size, side, b"" if side == "-" else digests[k], parents[i // 2], None))
            level, first, digests = level + 1, first // 2, parents
        out.append((tree, level, first, size, None, None, None, digests[0]))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _ARROW)], _NAMES)

    return run


_NAMES = [f.split()[0] for f in _NODES.split(", ")]
_ARROW = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary()]


def nodes(leaves: DataFrame) -> tuple[list[DataFrame], int]:
    """Tables (tree, level, idx, size, sides, proof, top) of all nodes below a root, and the number of levels of the tallest tree.

    ``leaves`` has tree, idx, size and digest; a tree of one leaf has no such node. A node's segment goes one level up: ``sides`` says
    where its sibling stands (L, R, or - for none), ``proof`` is the sibling's digest, ``top`` the parent's.
    """
    largest = leaves.agg(F.max("size")).first()[0] or 1
    height = (largest - 1).bit_length()
    level = leaves.filter("size > 1").select("tree", "idx", "size", "digest")
    passes = []
    for base in range(0, height, BLOCK):
        done = store(level.groupBy("tree", F.shiftright("idx", BLOCK)).applyInArrow(_levels(base), _NODES))
        passes.append(done)
        goes_on = F.col("side").isNull() & (F.col("size") > 2 ** (base + BLOCK))
        level = done.filter(goes_on).select("tree", "idx", "size", "digest")
    return passes, height


def proofs(leaves: DataFrame) -> DataFrame:
    """(tree, idx, sides, proof, top) of the leaves (tree, idx, size, digest) of trees with more than one: the whole way up.

    Starts with all nodes and segments of one level; each round doubles the length of all segments that have not arrived. The result is
    a written table.
    """
    passes, height = nodes(leaves)
    names = "tree", "level", "idx", "size", F.col("side").alias("sides"), F.col("sibling").alias("proof"), "top"
    none = leaves.limit(0).selectExpr("tree", "0 AS level", "idx", "size", "'' AS side", "digest AS sibling", "digest AS top")
    state = none.select(*names)
    for p in passes:
        state = state.unionByName(p.filter("side IS NOT NULL").select(*names))
    stored, reach = None, 1
    while reach < height:
        left = state.filter(F.col("level") % (2 * reach) == 0)
        left = left.withColumn("block", F.shiftright(F.expr("shiftleft(idx, level)"), BLOCK))
        right = state.filter(F.col("level") % (2 * reach) == reach)
        leaf = lambda idx: F.least(F.call_function("shiftleft", idx, F.col("level")), F.col("size")) - 1
        first, last = F.shiftright(F.expr("shiftleft(idx, level)"), BLOCK), F.shiftright(leaf(F.col("idx") + 1), BLOCK)
        right = right.select(
            F.col("tree").alias("r_tree"), (F.col("level") - reach).alias("r_level"), F.col("idx").alias("r_idx"),
            F.col("sides").alias("r_sides"), F.col("proof").alias("r_proof"), F.col("top").alias("r_top"),
            F.explode(F.sequence(first, last)).alias("r_block"),
        )
        up = (F.col("tree") == F.col("r_tree")) & (F.col("block") == F.col("r_block")) & (F.col("level") == F.col("r_level"))
        joined = left.join(right, up & (F.shiftright("idx", reach) == F.col("r_idx")), "left")
        longer = store(joined.select(
            "tree", "level", "idx", "size", F.concat("sides", F.coalesce("r_sides", F.lit(""))).alias("sides"),
            F.concat("proof", F.coalesce("r_proof", F.lit(b""))).alias("proof"), F.coalesce("r_top", "top").alias("top"),
        ))
        discard(stored)
        state = stored = longer
        reach *= 2
    whole = store(state.filter("level = 0").select("tree", "idx", "sides", "proof", "top"))
    for table in (stored, *passes):
        discard(table)
    return whole


def fold(digest: Column, sides: Column, proof: Column) -> Column:
    """The last digest of a tree from a leaf's and its proof. All are binary; ``sides`` has a sign for each level."""
    # after each level: how many siblings are used, and the digest
    start = F.struct(F.lit(0).alias("used"), F.lower(F.hex(digest)).alias("h"))

    def step(acc: Column, i: Column) -> Column:
        side = F.substr(sides, i, F.lit(1))
        sibling = F.lower(F.hex(F.substr(proof, acc["used"] * 32 + 1, F.lit(32))))
        both = F.when(side == "L", F.concat(sibling, acc["h"])).when(side == "R", F.concat(acc["h"], sibling)).otherwise(acc["h"])
        return F.struct((acc["used"] + (side != "-").cast("int")).alias("used"), F.sha2(both, 256).alias("h"))

    folded = F.aggregate(F.sequence(F.lit(1), F.length(sides)), start, step)["h"]
    return F.unhex(F.when(F.length(sides) > 0, folded).otherwise(F.lower(F.hex(digest))))


def manifest(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` (tree, digest, ...) with subroot, root, sides and proof, as binary digests.

    Within a tree leaves stand by ``order`` and then by digest (nulls first); trees by their names, byte by byte, a null first. Every row
    is a leaf, repeated rows too (equal ones have the same digest, each its own place and proof). A table without rows has none.
    """
    taken = {"idx", "size", "subroot", "root", "sides", "proof"} & {c.lower() for c in leaves.columns}
    if taken:
        raise ValueError(f"columns exist already: {sorted(taken)}")
    named = leaves.withColumn("tree", F.coalesce(F.concat(F.lit("="), "tree"), F.lit("")))  # '' sorts before all names
    placed = place(named, [*order, "digest"])
    segments = proofs(placed.select("tree", "idx", "size", "digest"))
    below = segments.select(F.col("tree").alias("b_tree"), F.col("idx").alias("b_idx"), F.col("sides").alias("b_sides"), "proof", "top")
    with_proof = placed.join(below, (F.col("tree") == F.col("b_tree")) & (F.col("idx") == F.col("b_idx")), "left")
    with_proof = store(with_proof.select(
        *placed.columns, F.coalesce("top", "digest").alias("subroot"), F.coalesce("b_sides", F.lit("")).alias("sides"),
        F.coalesce("proof", F.lit(b"")).alias("proof"),
    ))
    discard(segments)
    discard(placed)

    subroots = with_proof.filter("idx = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("subroot").alias("digest"), "size")
    subroots = place(subroots.withColumnRenamed("size", "leaves"), ["name"])
    above = proofs(subroots.select("tree", "idx", "size", "digest"))
    above = above.select(F.col("idx").alias("a_idx"), F.col("sides").alias("a_sides"), F.col("proof").alias("a_proof"), F.col("top").alias("a_top"))
    blocks = F.explode(F.sequence(F.lit(0), F.shiftright(F.col("leaves") - 1, BLOCK))).alias("a_block")
    tops = subroots.join(above, F.col("idx") == F.col("a_idx"), "left").select(
        F.col("name").alias("a_tree"), F.coalesce("a_top", "digest").alias("root"), F.coalesce("a_sides", F.lit("")).alias("a_sides"),
        F.coalesce("a_proof", F.lit(b"")).alias("a_proof"), blocks,
    )  # a language's last step up, once for each block of its leaves
    done = with_proof.join(tops, (F.col("tree") == F.col("a_tree")) & (F.shiftright("idx", BLOCK) == F.col("a_block")))
    tree = F.when(F.col("tree") != "", F.substr("tree", F.lit(2))).alias("tree")
    return done.select(
        *(tree if c == "tree" else c for c in leaves.columns), "idx", "subroot", "root",
        F.concat("sides", "a_sides").alias("sides"), F.concat("proof", "a_proof").alias("proof"),
    )


def hex_of(column: str) -> Column:
    return F.lower(F.hex(column))


def document_manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of ``docs``, a tree for each ``lang``.

    Leaves cover ``COLUMNS``; others are ignored. To try the proofs, rows whose decimal doc_id has a crc32 that 7 divides are checked with
    one added to n_chars (a null stays null, a null doc_id is never changed). A null doc_id stands first in its tree.
    """
    given = [F.col(c) for c in COLUMNS]
    changed = [F.col(c).cast("decimal(20,0)") + 1 if c == "n_chars" else F.col(c) for c in COLUMNS]
    chosen = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    leaves = docs.select(
        F.col("lang").alias("tree"), F.col("doc_id").cast("bigint").alias("doc_id"), leaf_digest(*given).alias("digest"),
        F.when(chosen, leaf_digest(*changed)).alias("tampered"),
    )
    made = manifest(leaves, ["doc_id"])
    folded = made.withColumn("folded", fold(F.coalesce("tampered", "digest"), F.col("sides"), F.col("proof")))
    return folded.select(
        "doc_id", hex_of("digest").alias("leaf"), hex_of("subroot").alias("subroot"), hex_of("root").alias("root"),
        F.sha2(hex_of("proof"), 256).alias("proof_sha256"), hex_of("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )


def _sql_field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR)::VARCHAR || ':' || ({value})::VARCHAR, '-')"


_SQL_FIELDS = " || ".join(map(_sql_field, COLUMNS))
_SQL_CHANGED = " || ".join(_sql_field("n_chars::HUGEINT + 1" if c == "n_chars" else c) for c in COLUMNS)
SQL = f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
leaves AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({_SQL_FIELDS}) AS leaf, sha256({_SQL_CHANGED}) AS changed,
  xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 7 = 0 AS chosen FROM documents, crc),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves),
low(tree, level, idx, digest, n) AS (
  SELECT tree, 0, idx, leaf, count(*) OVER (PARTITION BY tree) FROM placed
  UNION ALL
  SELECT *, count(*) OVER (PARTITION BY tree) FROM (
    SELECT tree, level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM low WHERE n > 1 GROUP BY tree, level, idx // 2)),
subroots AS (SELECT tree, digest AS subroot, level AS height, row_number() OVER (ORDER BY tree) - 1 AS place FROM low WHERE n = 1),
high(level, idx, digest, n) AS (
  SELECT 0, place, subroot, count(*) OVER () FROM subroots
  UNION ALL
  SELECT *, count(*) OVER () FROM (
    SELECT level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM high WHERE n > 1 GROUP BY level, idx // 2)),
root AS (SELECT digest AS root, level AS height FROM high WHERE n = 1),
ways AS (
  SELECT p.tree, p.idx, l AS step, p.idx >> l AS own, p.tree AS wood, l AS level FROM
    (SELECT tree, idx, unnest(range(height)) AS l FROM placed JOIN subroots USING (tree)) p
  UNION ALL
  SELECT p.tree, p.idx, p.h + l, p.place >> l, '/', l FROM
    (SELECT tree, idx, s.height AS h, place, unnest(range(root.height)) AS l FROM placed JOIN subroots s USING (tree), root) p),
every AS (SELECT tree, level, idx, digest FROM low UNION ALL SELECT '/', level, idx, digest FROM high),
steps AS (SELECT w.tree, w.idx, step, own, e.idx AS other, coalesce(digest, '') AS sibling FROM ways w
  LEFT JOIN every e ON e.tree = wood AND e.level = w.level AND e.idx = xor(own, 1)),
proofs AS (SELECT tree, idx, string_agg(sibling, '' ORDER BY step) AS proof, count(*) AS steps FROM steps GROUP BY 1, 2),
folded(tree, idx, step, digest) AS (
  SELECT tree, idx, 0, CASE WHEN chosen AND changed IS NOT NULL THEN changed ELSE leaf END FROM
    (SELECT placed.* REPLACE (CASE WHEN n_chars IS NOT NULL THEN changed END AS changed) FROM placed JOIN documents USING (doc_id))
  UNION ALL
  SELECT f.tree, f.idx, f.step + 1, sha256(CASE WHEN other < own THEN sibling || digest ELSE digest || sibling END)
  FROM folded f JOIN steps s ON s.tree = f.tree AND s.idx = f.idx AND s.step = f.step)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, f.digest AS folded_root, f.digest = root AS verified
FROM placed p JOIN subroots USING (tree) LEFT JOIN proofs q ON q.tree = p.tree AND q.idx = p.idx, root, folded f
WHERE f.tree = p.tree AND f.idx = p.idx AND f.step = coalesce(q.steps, 0)"""


@query("op11_merkle_manifest", SQL)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_manifest(common.documents(spark, sf_dir, *COLUMNS))
