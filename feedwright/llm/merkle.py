"""Merkle manifest of a table, kept in blocks of van Emde Boas layout.

Every row is a leaf: the hash of its fields, each with its length. The leaves of
a tree (one per language) are ranked, and runs of 2^9 of them form a block: the
whole subtree above them, in one binary. A block of L levels of nodes lies as its
top half of the levels, then the subtrees below it from left to right, each laid
out likewise; ``address`` computes the place of a node from its depth and number
by this recursion alone, for building as for fetching siblings. The roots of the
blocks are the leaves of the next level of blocks, until a tree has one root. The
roots of the trees, in order of their names, form one tree more.

Two neighbouring nodes become the hash of both; a node without neighbour becomes
the hash of itself alone. Digests enter hashes as lower-case hex. A proof lists
for each level the sibling and its side, or that there is none.

Nulls are leaves like others: a field that is null counts as ``-``, a null
language is a tree of its own and the first one, and null ids come first. Rows
with one id are ordered by their leaf, and equal rows are leaves as often as they
occur. Empty and long texts are hashed whole. An empty table has no root and
gives no rows. Columns that are not named as fields are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import Batches, lean, small_batches, stored
from feedwright.llm.ranks import ranked

#: A block spans 2^HEIGHT leaves.
HEIGHT = 9
DIGEST = 32
#: What a proof holds for each level: a mark, then the sibling's digest (zeros where there is none).
LEFT, RIGHT, ALONE = 0, 1, 2
STEP = 1 + DIGEST

FIELDS = {"doc_id": "bigint", "source": "string", "lang": "string", "n_chars": "bigint", "text": "string"}


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 over the fields, each as ``byte length:value`` or ``-`` for null."""
    parts = [F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in fields]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def document_leaf(changed: dict[str, Column] | None = None) -> Column:
    """The leaf of a row of ``documents``, with fields exchanged if wanted."""
    values = {name: F.col(name).cast(kind) for name, kind in FIELDS.items()} | (changed or {})
    return leaf_digest([v.cast("string") for v in values.values()])


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places in the layout of nodes ``index`` of one depth, in a full tree of ``levels`` levels."""
    if levels == 1:
        return np.zeros(len(index), np.int64)
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    below, size = depth - top, (1 << (levels - top)) - 1
    inside = address(levels - top, below, index & ((1 << below) - 1))
    return (1 << top) - 1 + (index >> below) * size + inside


def hash_nodes(nodes: list[bytes]) -> bytes:
    return hashlib.sha256("".join(n.hex() for n in nodes).encode()).digest()


def widths(n: int, height: int) -> list[int]:
    """How many nodes each depth holds, the root's depth first, above ``n`` leaves."""
    out = [n]
    for _ in range(height):
        out.append(-(-out[-1] // 2))
    return out[::-1]


def laid_out(leaves: np.ndarray, height: int) -> np.ndarray:
    """The block above the leaves (n digests): an array of digests in layout order; absent nodes are zeros."""
    levels = height + 1
    block = np.zeros(((1 << levels) - 1, DIGEST), np.uint8)
    width = widths(len(leaves), height)
    block[address(levels, height, np.arange(len(leaves)))] = leaves
    for depth in range(height - 1, -1, -1):
        children = block[address(levels, depth + 1, np.arange(width[depth + 1]))].tobytes()
        pairs = (children[i : i + 2 * DIGEST] for i in range(0, len(children), 2 * DIGEST))
        found = [hash_nodes([p[:DIGEST], p[DIGEST:]] if len(p) > DIGEST else [p]) for p in pairs]
        block[address(levels, depth, np.arange(width[depth]))] = np.frombuffer(b"".join(found), np.uint8).reshape(-1, DIGEST)
    return block


def sibling_steps(block: np.ndarray, n: int, height: int) -> np.ndarray:
    """The steps of each leaf's proof up to the block's root: n by height by STEP bytes."""
    steps = np.zeros((n, height, STEP), np.uint8)
    width = widths(n, height)
    for step, depth in enumerate(range(height, 0, -1)):
        own = np.arange(n) >> step
        other = own ^ 1
        there = other < width[depth]
        steps[:, step, 0] = np.where(there, np.where(other < own, LEFT, RIGHT), ALONE)
        steps[there, step, 1:] = block[address(height + 1, depth, other[there])]
    return steps


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and the steps of its proof lead to."""
    for at in range(0, len(path), STEP):
        other = path[at + 1 : at + STEP]
        side = path[at]
        leaf = hash_nodes([leaf] if side == ALONE else [other, leaf] if side == LEFT else [leaf, other])
    return leaf


def siblings(path: bytes) -> list[bytes]:
    """The digests that a proof holds, from the leaf up."""
    return [path[at + 1 : at + STEP] for at in range(0, len(path), STEP) if path[at] != ALONE]


@dataclass
class Forest:
    """Block tables of one set of trees, leaves' level first; each holds tree, block, total, height, digests, payload."""

    levels: list[DataFrame]
    span: int

    def tops(self, level: DataFrame) -> DataFrame:
        """Blocks that hold a tree's root."""
        return level.where(F.col("total") <= self.span)

    def roots(self) -> DataFrame:
        """tree and root of every tree."""
        found = [self.tops(t).select("tree", F.substring("digests", 1, DIGEST).alias("root")) for t in self.levels]
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return out


def blocks(nodes: DataFrame, height: int) -> DataFrame:
    """The blocks above ranked nodes (tree, rank, total, digest, payload)."""
    span = 1 << height
    keyed = nodes.withColumn("block", F.shiftright("rank", height))
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
    schema = f"tree {kinds['tree']}, block bigint, total bigint, n int, height int, digests binary, payload array<{kinds['payload']}>"

    def build(group: pa.Table) -> pa.Table:
        group = group.take(pa.array(np.argsort(group.column("rank").to_numpy(), kind="stable")))
        n, total = group.num_rows, group.column("total")[0].as_py()
        own = height if total > span else max(0, (n - 1).bit_length())
        raw = np.frombuffer(b"".join(group.column("digest").to_pylist()), np.uint8).reshape(-1, DIGEST)
        payload = group.column("payload").combine_chunks()
        return pa.table(
            {
                "tree": group.column("tree").slice(0, 1),
                "block": group.column("block").slice(0, 1),
                "total": group.column("total").slice(0, 1),
                "n": pa.array([n], pa.int32()),
                "height": pa.array([own], pa.int32()),
                "digests": pa.array([laid_out(raw, own).tobytes()], pa.binary()),
                "payload": pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), payload),
            }
        )

    return keyed.groupBy("tree", "block").applyInArrow(build, schema)


def forest(nodes: DataFrame, purpose: str, height: int = HEIGHT) -> Forest:
    """All levels of blocks above ranked nodes; each level is 2^height times smaller than the one below."""
    span = 1 << height
    levels: list[DataFrame] = []
    while True:
        level = stored(blocks(nodes, height), f"{purpose}-{len(levels)}")
        levels.append(level)
        if not level.where(F.col("total") > span).limit(1).count():
            return Forest(levels, span)
        nodes = level.where(F.col("total") > span).select(
            "tree",
            F.col("block").alias("rank"),
            F.ceil(F.col("total") / span).cast("bigint").alias("total"),
            F.substring("digests", 1, DIGEST).alias("digest"),
            F.lit(0).alias("payload"),
        )


def expanded(
    level: DataFrame, paths: DataFrame, span: int, then: Batches | None = None, result: str | None = None
) -> DataFrame:
    """Every node below the blocks of a level: tree, rank, digest, payload, its whole path and its tree's root.

    ``then`` works on these rows in the same worker and gives rows of ``result``.
    """
    kinds = {f.name: f.dataType for f in level.schema}
    payload = kinds["payload"].elementType.simpleString()
    schema = f"tree {kinds['tree'].simpleString()}, rank bigint, digest binary, payload {payload}, path binary, top binary"
    ours = paths.select(F.col("tree").alias("of"), F.col("block").alias("at"), "path", "top")
    met = level.join(ours, (F.col("block") == F.col("at")) & F.col("tree").eqNullSafe(F.col("of"))).drop("of", "at")

    def open_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["tree", "rank", "digest", "payload", "path", "top"]
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                n, height = row.column("n")[0].as_py(), row.column("height")[0].as_py()
                block = np.frombuffer(row.column("digests")[0].as_py(), np.uint8).reshape(-1, DIGEST)
                above, top = row.column("path")[0].as_py(), row.column("top")[0].as_py()
                steps = sibling_steps(block, n, height)
                leaves = block[address(height + 1, height, np.arange(n))]
                where = pa.array(np.zeros(n, np.int64))
                columns = [
                    row.column("tree").take(where),
                    pa.array(row.column("block")[0].as_py() * span + np.arange(n)),
                    pa.array([x.tobytes() for x in leaves], pa.binary()),
                    row.column("payload").flatten(),
                    pa.array([s.tobytes() + above for s in steps], pa.binary()),
                    pa.array([top] * n, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    if then:
        return met.mapInArrow(lean(lambda batches: then(open_blocks(batches))), result)
    return met.mapInArrow(lean(open_blocks), schema)


def proofs(found: Forest, base: DataFrame, then: Batches | None = None, result: str | None = None) -> DataFrame:
    """Every leaf of a forest with its path; ``base`` (tree, path, top) goes on from each tree's root.

    ``then`` is applied to the leaves as in ``expanded``. Paths are handed down level by level, so a block's own steps are looked up once for all leaves below it.
    """
    above = None
    for level in reversed(found.levels):
        last = level is found.levels[0]
        tops = found.tops(level).select("tree", "block")
        ours = base.select(F.col("tree").alias("of"), "path", "top")
        paths = tops.join(ours, F.col("tree").eqNullSafe(F.col("of"))).select("tree", "block", "path", "top")
        if above is not None:
            paths = paths.unionByName(above.select("tree", F.col("rank").alias("block"), "path", "top"))
        above = expanded(level, paths, found.span, then if last else None, result)
    return above


@dataclass
class Manifest:
    """The blocks of all trees, the tree over their roots, and its root (None for an empty table)."""

    trees: Forest
    crown: Forest
    root: bytes | None

    def proofs(self, then: Batches | None = None, result: str | None = None) -> DataFrame:
        """Every leaf: tree, rank, digest, payload, path up to the manifest's root, and top, its tree's root."""
        spark = self.crown.levels[0].sparkSession
        small_batches(spark)
        nothing = spark.createDataFrame([(0, b"", self.root)], "tree int, path binary, top binary")
        crown = proofs(self.crown, nothing).select(F.col("payload").alias("tree"), "path", F.col("digest").alias("top"))
        return proofs(self.trees, stored(crown, "merkle-tops"), then, result)


def manifest(leaves: DataFrame, order: list[Column], height: int = HEIGHT) -> Manifest:
    """The manifest of rows (tree, digest, payload and what ``order`` reads), ranked by ``order`` within each tree."""
    # Written first, as a sort by range reads its input twice and texts should be hashed once.
    leaves = stored(leaves, "merkle-hashed")
    nodes = ranked(leaves, "tree", [*order, F.col("digest").asc()], "merkle-leaves")
    trees = forest(nodes.select("tree", "rank", "total", "digest", "payload"), "merkle-block", height)
    # The crown's only tree is 0; its leaves are the trees' roots, their names the payload.
    tops = trees.roots().select(F.lit(0).alias("tree"), F.col("root").alias("digest"), F.col("tree").alias("payload"))
    tops = ranked(tops, "tree", [F.col("payload").asc_nulls_first()], "merkle-crown-leaves")
    crown = forest(tops.select("tree", "rank", "total", "digest", "payload"), "merkle-crown", height)
    top = crown.roots().first()
    return Manifest(trees, crown, bytes(top["root"]) if top else None)


def document_manifest(docs: DataFrame, claim: Column | None = None, height: int = HEIGHT) -> Manifest:
    """The manifest of ``documents``: a tree per language, leaves by doc_id.

    The payload of a leaf holds its doc_id and ``claim``, a leaf that someone
    holds against the manifest (by default the row's own).
    """
    small_batches(docs.sparkSession)
    own = document_leaf()
    leaves = docs.select(
        F.col("lang").cast("string").alias("tree"),
        F.col("doc_id").cast("bigint").alias("id"),
        own.alias("digest"),
        F.struct(F.col("doc_id").cast("bigint").alias("id"), (own if claim is None else claim).alias("claim")).alias("payload"),
    )
    return manifest(leaves, [F.col("id").asc_nulls_first()], height)


def verified(made: Manifest) -> DataFrame:
    """doc_id and leaf of each row of a document manifest, the hash of its siblings, and whether its claim folds to the root."""
    root = made.root
    schema = "doc_id bigint, leaf binary, subroot binary, proof_sha256 binary, folded binary, verified boolean"

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = b.column("path").to_pylist()
            claims = b.column("payload").field(1).to_pylist()
            held = [hash_nodes(siblings(p)) for p in paths]
            folded = [fold(c, p) for c, p in zip(claims, paths)]
            good = [f == root for f in folded]
            columns = [b.column("payload").field(0), b.column("digest"), b.column("top")]
            columns += [pa.array(held, pa.binary()), pa.array(folded, pa.binary()), pa.array(good, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "leaf", "subroot", "proof_sha256", "folded", "verified"])

    return made.proofs(check, schema)
