"""Prefix trie of conversations as tables, with a minimal-perfect-hash node table per shard.

A conversation is its turns in order; every distinct sequence of first turns is
a node, found by the digest of that sequence: a polynomial of its turns' hashes
in two 64-bit lanes. As the polynomial of a whole follows from those of its
parts, turns are sorted by range over all tasks, each task rolls over its own
rows, and a small table of constants per conversation and task joins the parts.
So one conversation may hold any share of the rows. The table of distinct nodes
is verified: all conversations at a node must agree on the last turn's digest
and on the parent; otherwise everything is rolled again under another seed.

A node is named by its smallest conversation and its depth, hence the nodes of
one name form a path. Paths are cut every ``SPAN`` turns into pieces. Totals of
pieces move up the tree of pieces by pointer doubling, and then shards of pieces
finish alone: a minimal perfect hash gives each node of the shard a slot that
holds its digest, counts are scattered into flat arrays, and the slots' parents
are accumulated from the deepest turn up.

With a ``family``, conversations begin with turns of their family's first one
(the conversation with the family's number): the first ``share`` of these, then
their own turns after as many.

Turns are ordered by number, null first; equal numbers by the digest of role and
text. Null role or text counts as empty. Rows without conversation are left out.
Repeated rows are turns like others. An empty table has no nodes, not even a
root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import lean, mixed, small_batches, stored
from feedwright.llm.exact import perfect_hash, slots_of
from feedwright.llm.ranks import join_unique, sorted_parts

#: Turns of a path that one piece holds, and nodes that one shard is meant to hold.
SPAN = 64
SHARD_NODES = 50_000
#: Conversation numbers that are joined to one text before they are hashed on.
CHUNK = 10_000
#: Turns that a family can hand on at most; its first turns travel in one row.
MAX_SHARE = 3

_FACTORS = [0x9E3779B97F4A7C15, 0xD1342543DE82EF95]
_MASK = (1 << 64) - 1
_INVERSE = [pow(r, -1, 1 << 64) for r in _FACTORS]

KEY = ["a", "b", "depth"]
NODE = "a bigint, b bigint, depth bigint, pa bigint, pb bigint, conv bigint, words bigint, print bigint"


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv, turn, digest of role and text, and the text's words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.size(words).cast("bigint").alias("words"),
    )


def lanes(digests: list[bytes], seed: int) -> list[np.ndarray]:
    """Two 64-bit hashes of each turn's digest."""
    words = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 4)
    salt = np.uint64((seed * 0x2545F4914F6CDD1D + 1) & _MASK)
    return [mixed(words[:, 0] ^ mixed(words[:, 2] + salt)), mixed(words[:, 1] ^ mixed(words[:, 3] + salt))]


def powers(factor: int, exponents: np.ndarray) -> np.ndarray:
    """``factor`` to each exponent, modulo 2^64."""
    out = np.ones(len(exponents), np.uint64)
    left = exponents.astype(np.int64)
    while (left > 0).any():
        out = np.where(left & 1, out * np.uint64(factor), out)
        factor = factor * factor & _MASK
        left = left >> 1
    return out


def rolled(turns: DataFrame, seed: int) -> DataFrame:
    """Turns sorted over all tasks, each with the polynomial of its conversation's turns in the task so far."""

    def roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = [np.uint64(0), np.uint64(0)]
        for b in batches:
            if not b.num_rows:
                continue
            at = b.column("at").to_numpy()
            begun = np.maximum.accumulate(np.where(at == 0, np.arange(len(at)), -1))
            sums = []
            for i, x in enumerate(lanes(b.column("digest").to_pylist(), seed)):
                run = np.cumsum(x * powers(_FACTORS[i], at), dtype=np.uint64)
                ahead = np.concatenate([np.zeros(1, np.uint64), run])[begun]
                run = np.where(begun >= 0, run - ahead, run + carried[i])
                carried[i] = run[-1]
                sums.append(pa.array(run.view(np.int64)))
            names = ["conv", "digest", "words", "part", "at"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), *sums], [*names, "qa", "qb"])

    kinds = "conv bigint, digest binary, words bigint, part int, at bigint, qa bigint, qb bigint"
    return sorted_parts(turns, "conv", [F.col("turn").asc_nulls_first(), F.col("digest").asc()], roll, kinds)


def _signed(x: int) -> int:
    x &= _MASK
    return x - (1 << 64) if x >> 63 else x


def _family_plan(entries: list[dict], number: int | None, seed: int) -> Iterator[dict]:
    """What each conversation of a family needs in each task: constants, the shared turns and its end."""
    convs: dict[int, list[dict]] = {}
    for e in sorted(entries, key=lambda e: (e["conv"], e["part"])):
        convs.setdefault(e["conv"], []).append(e)

    def first_turns(parts: list[dict]) -> list[dict]:
        found = [t for p in parts for t in sorted(p["heads"], key=lambda t: t["at"])]
        return found[:MAX_SHARE]

    def polynomials(turns: list[dict]) -> list[list[int]]:
        """Of no turn, the first one, the first two and so on, per lane."""
        own = [[0], [0]]
        for i, x in enumerate(lanes([t["digest"] for t in turns], seed)):
            for n, v in enumerate(x.tolist()):
                own[i].append((own[i][-1] + v * pow(_FACTORS[i], n, 1 << 64)) & _MASK)
        return own

    given = first_turns(convs.get(number, [])) if number is not None else []
    given_sums = polynomials(given)
    for conv, parts in convs.items():
        skipped, total = parts[0]["share"], sum(p["n"] for p in parts)
        taken = min(skipped, len(given))
        own_sums = polynomials(first_turns(parts))
        gone = min(skipped, total)
        shared = []
        for n in range(taken):
            sums = [_signed(s[k]) for k in (n + 1, n) for s in given_sums]
            shared.append({"a": sums[0], "b": sums[1], "depth": n + 1, "pa": sums[2], "pb": sums[3]} | given[n])
        ahead, before, ends = 0, [0, 0], [0, 0]
        rows = []
        for p in parts:
            row = {"conv": conv, "part": p["part"], "shift": ahead - skipped + taken + 1, "skip": skipped - ahead}
            for i, name in enumerate("ab"):
                back = pow(_INVERSE[i], skipped - taken, 1 << 64)
                row[f"w{name}"] = _signed(back * pow(_FACTORS[i], ahead, 1 << 64))
                row[f"u{name}"] = _signed(given_sums[i][taken] + back * (before[i] - own_sums[i][gone]))
                before[i] = (before[i] + pow(_FACTORS[i], ahead, 1 << 64) * (p[f"q{name}"] & _MASK)) & _MASK
                ends[i] = _signed(given_sums[i][taken] + back * (before[i] - own_sums[i][gone]))
            ahead += p["n"]
            rows.append(row | {"shared": [], "end": None})
        rows[0]["shared"] = shared
        rows[0]["end"] = {"a": ends[0], "b": ends[1], "depth": taken + total - gone}
        yield from rows


_TURN = "digest binary, words bigint, at bigint"
_PLAN = (
    "conv bigint, part int, shift bigint, skip bigint, wa bigint, ua bigint, wb bigint, ub bigint, "
    f"shared array<struct<a: bigint, b: bigint, depth: bigint, pa: bigint, pb: bigint, {_TURN.replace(' ', ': ').replace(',:', ',')}>>, "
    "end struct<a: bigint, b: bigint, depth: bigint>"
)


def plan(rows: DataFrame, family: Column, share: Column, seed: int) -> DataFrame:
    """Per conversation and task the constants that turn rolled sums into prefix digests."""
    head = F.when(F.col("at") < MAX_SHARE, F.struct("digest", "words", "at"))
    last = F.max(F.struct("at", "qa", "qb"))
    parts = rows.groupBy("conv", "part").agg(last.alias("last"), F.collect_list(head).alias("heads"))
    entry = F.struct(
        "conv",
        "part",
        (F.col("last.at") + 1).alias("n"),
        F.col("last.qa").alias("qa"),
        F.col("last.qb").alias("qb"),
        share.cast("int").alias("share"),
        "heads",
    )
    # As many entries as a family has conversations, times the tasks that hold a part of one.
    families = parts.groupBy(family.alias("family")).agg(F.collect_list(entry).alias("entries"))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for b in batches:
            for at in range(0, b.num_rows, 256):
                made = [r for f in b.slice(at, 256).to_pylist() for r in _family_plan(f["entries"], f["family"], seed)]
                schema = schema or plan_schema()
                yield pa.RecordBatch.from_pylist(made, schema)

    return families.mapInArrow(lean(spell), _PLAN)


def plan_schema() -> pa.Schema:
    number = pa.int64()
    keys = [(n, number) for n in ("a", "b", "depth")]
    turn = [("pa", number), ("pb", number), ("digest", pa.binary()), ("words", number), ("at", number)]
    names = ("shift", "skip", "wa", "ua", "wb", "ub")
    return pa.schema(
        [("conv", number), ("part", pa.int32()), *[(n, number) for n in names]]
        + [("shared", pa.list_(pa.struct(keys + turn))), ("end", pa.struct(keys))]
    )


def prefixes(rows: DataFrame, constants: DataFrame, seed: int) -> DataFrame:
    """One row per conversation and depth: the node, its parent, and a print of the last turn and the parent."""
    met = rows.join(constants.drop("shared", "end"), ["conv", "part"]).where("at >= skip")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = {n: b.column(n).to_numpy().view(np.uint64) for n in ("qa", "qb", "wa", "wb", "ua", "ub")}
            depth = b.column("at").to_numpy() + b.column("shift").to_numpy()
            own, above = [], []
            for i, x in enumerate(lanes(b.column("digest").to_pylist(), seed)):
                name = "ab"[i]
                sums = col[f"u{name}"] + col[f"w{name}"] * col[f"q{name}"]
                own.append(sums)
                above.append(sums - x * powers(_FACTORS[i], depth - 1))
            columns = [pa.array(c.view(np.int64)) for c in own] + [pa.array(depth)]
            columns += [pa.array(c.view(np.int64)) for c in above]
            columns += [b.column("conv"), b.column("words"), b.column("digest")]
            yield pa.RecordBatch.from_arrays(columns, [*KEY, "pa", "pb", "conv", "words", "digest"])

    names = [*KEY, "pa", "pb", "conv", "words", "digest"]
    own = met.mapInArrow(lean(spell), NODE.replace("print bigint", "digest binary"))
    given = constants.select("conv", F.explode("shared").alias("s")).select("s.*", "conv").select(*names)
    both = own.unionByName(given)
    return both.withColumn("print", F.xxhash64("digest", "pa", "pb")).drop("digest")


def distinct_nodes(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """The distinct prefixes, the root among them; ``low`` and ``high`` differ where two prefixes share a digest."""
    found = rows.groupBy(*KEY).agg(
        F.min("pa").alias("pa"),
        F.min("pb").alias("pb"),
        F.min("conv").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"),
        F.min("print").alias("low"),
        F.max("print").alias("high"),
    )
    zero = F.lit(0).cast("bigint")
    root = ends.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(
        *[zero.alias(n) for n in (*KEY, "pa", "pb")], "conv_id", "n_convs", *[zero.alias(n) for n in ("words", "low", "high")]
    )
    return found.unionByName(root)


def ends_digests(ends: DataFrame) -> DataFrame:
    """For each node where conversations end: the SHA-256 of their numbers in order, joined by commas.

    Numbers are sorted over all tasks and joined in chunks; then one task hashes a node's chunks as they pass by.
    """
    keyed = ends.select(F.concat_ws(":", *KEY).alias("node"), "conv")

    def join_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["node", "first", "numbers"]
        for b in batches:
            node, conv = b.column("node").to_pylist(), b.column("conv").to_pylist()
            starts = [i for i in range(len(node)) if not i or node[i] != node[i - 1]] + [len(node)]
            made = []
            for s, e in zip(starts, starts[1:]):
                made += [(node[i], conv[i], ",".join(map(str, conv[i : min(e, i + CHUNK)]))) for i in range(s, e, CHUNK)]
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*made)], names)

    schema = "node string, first bigint, numbers string"
    chunks = sorted_parts(keyed, "node", [F.col("conv").asc()], join_chunks, schema)

    def hash_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["node", "ends_sha256"]
        node, state = None, hashlib.sha256()
        for b in batches:
            made = []
            for n, numbers in zip(b.column("node").to_pylist(), b.column("numbers").to_pylist()):
                if n != node:
                    if node is not None:
                        made.append((node, state.hexdigest()))
                    node, state = n, hashlib.sha256(numbers.encode())
                else:
                    state.update(b"," + numbers.encode())
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*made)], names)
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], names)

    in_order = chunks.repartition("node").sortWithinPartitions("node", "first")
    found = in_order.mapInArrow(lean(hash_on), "node string, ends_sha256 string")
    parts = F.split("node", ":")
    return found.select(*[parts[i].cast("bigint").alias(n) for i, n in enumerate(KEY)], "ends_sha256")


def piece_totals(nodes: DataFrame) -> DataFrame:
    """Per piece (conv_id, band): where it hangs, and the leaves and tokens of all that hangs below its top."""
    pieces = nodes.groupBy("conv_id", "band").agg(
        F.sum("leaf").alias("leaves"),
        F.sum("saved").alias("saved"),
        F.min("depth").alias("top"),
        F.min(F.struct("depth", "parent_conv_id")).alias("first"),
    )
    up = F.col("first.parent_conv_id")
    band = F.when(up.isNotNull(), F.floor((F.col("top") - 1) / SPAN).cast("bigint"))
    pieces = pieces.select("conv_id", "band", "leaves", "saved", "top", up.alias("hangs_on"), up.alias("up"), band.alias("up_band"))
    pieces = stored(pieces, "trie-pieces")
    # After round k a piece has the totals of all pieces less than 2^k steps below it.
    while pieces.where("up is not null").limit(1).count():
        below = pieces.where("up is not null").groupBy("up", "up_band")
        below = below.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        below = stored(below.select(F.col("up").alias("conv_id"), F.col("up_band").alias("band"), "more_leaves", "more_saved"), "trie-below")
        target = pieces.select(F.col("conv_id").alias("up"), F.col("band").alias("up_band"), F.col("up").alias("next"), F.col("up_band").alias("next_band"))
        moving = pieces.where("up is not null")
        moved = join_unique(moving, target, ["up", "up_band"], "trie-jumps")
        moved = moved.drop("up", "up_band").withColumnsRenamed({"next": "up", "next_band": "up_band"})
        all_pieces = stored(moved.unionByName(pieces.where("up is null")), "trie-moved")
        pieces = all_pieces.join(below, ["conv_id", "band"], "left").select(
            "conv_id",
            "band",
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            "top",
            "hangs_on",
            "up",
            "up_band",
        )
        pieces = stored(pieces, "trie-pieces")
    return pieces


def node_bytes(group: pa.Table, names: tuple[str, str], depth: np.ndarray) -> np.ndarray:
    """The digests of nodes as 32 bytes each: both lanes, the depth, and zeros."""
    out = np.zeros((group.num_rows, 4), np.int64)
    out[:, 0], out[:, 1], out[:, 2] = *(group.column(n).to_numpy() for n in names), depth
    return out.view(np.uint8).reshape(-1)


def accumulate(group: pa.Table) -> pa.Table:
    """Totals of the nodes of one shard: (conv_id, depth), n_leaves and saved_tokens."""
    n = group.num_rows
    depth = group.column("depth").to_numpy()
    own = node_bytes(group, ("a", "b"), depth)
    seeds, slot = perfect_hash(own)
    held = np.empty((n, 32), np.uint8)
    held[slot] = own.reshape(-1, 32)
    # A parent counts where its slot holds its digest, within the same piece.
    wanted = node_bytes(group, ("pa", "pb"), depth - 1)
    above = slots_of(wanted, seeds, n)
    inside = (held[above] == wanted.reshape(-1, 32)).all(axis=1) & (depth % SPAN > 0)
    conv = np.empty(n, np.int64)
    conv[slot] = group.column("conv_id").to_numpy()
    inside &= conv[above] == group.column("conv_id").to_numpy()
    parent, level = np.full(n, -1, np.int64), np.empty(n, np.int64)
    parent[slot[inside]] = above[inside]
    level[slot] = depth % SPAN
    counts = np.zeros((2, n), np.int64)
    for i, name in enumerate(("leaves", "tokens")):
        counts[i, slot] = group.column(name).to_numpy()
    order = np.argsort(level, kind="stable")
    starts = np.searchsorted(level[order], np.arange(SPAN + 1))
    for d in range(SPAN - 1, 0, -1):
        here = order[starts[d] : starts[d + 1]]
        here = here[parent[here] >= 0]
        for c in counts:
            np.add.at(c, parent[here], c[here])
    return pa.table(
        {
            "conv_id": group.column("conv_id"),
            "depth": group.column("depth"),
            "n_leaves": pa.array(counts[0, slot]),
            "saved_tokens": pa.array(counts[1, slot]),
        }
    )


def trie(conversations: DataFrame, family: Column | None = None, share: Column | None = None) -> DataFrame:
    """One row per node: digest (a, b), depth, conv_id, parent_conv_id, counts and totals, and ends_sha256.

    ``family`` and ``share`` are expressions over ``conv``; without them each conversation stands as it is.
    """
    small_batches(conversations.sparkSession)
    turns = stored(turn_rows(conversations), "trie-turns")
    family, share = (F.col("conv") if family is None else family), (F.lit(0) if share is None else share)
    seed = 0
    while True:
        rows = stored(rolled(turns, seed), "trie-rolled")
        constants = stored(plan(rows, family, share, seed), "trie-plan")
        ends = constants.where("end is not null").select("end.*", "conv")
        nodes = stored(distinct_nodes(prefixes(rows, constants, seed), ends), "trie-nodes")
        if not nodes.where("low <> high").limit(1).count():
            break
        seed += 1
    kids = nodes.where("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b"), (F.col("depth") - 1).alias("depth"))
    kids = stored(kids.agg(F.count(F.lit(1)).alias("n_children")), "trie-children")
    named = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("depth").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    below = nodes.where("depth > 0").withColumn("above", F.col("depth") - 1)
    linked = join_unique(below, named, ["pa", "pb", "above"], "trie-parents").drop("above")
    root = nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    linked = stored(linked.unionByName(root), "trie-linked").join(kids, KEY, "left")
    linked = linked.select(
        *KEY,
        "pa",
        "pb",
        "conv_id",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        F.floor(F.col("depth") / SPAN).cast("bigint").alias("band"),
    )
    linked = stored(linked, "trie-linked")
    pieces = piece_totals(linked).where("hangs_on is not null")
    hung = pieces.groupBy(F.col("hangs_on").alias("conv_id"), (F.col("top") - 1).alias("depth"))
    hung = stored(hung.agg(F.sum("leaves").alias("hung_leaves"), F.sum("saved").alias("hung_saved")), "trie-hung")
    shards = -(-max(1, linked.count()) // SHARD_NODES)
    filled = linked.join(hung, ["conv_id", "depth"], "left").select(
        "conv_id",
        *KEY,
        "pa",
        "pb",
        (F.col("leaf") + F.coalesce("hung_leaves", F.lit(0))).alias("leaves"),
        (F.col("saved") + F.coalesce("hung_saved", F.lit(0))).alias("tokens"),
        F.pmod(F.xxhash64("conv_id", "band"), F.lit(shards)).alias("shard"),
    )
    totals = filled.groupBy("shard").applyInArrow(accumulate, "conv_id bigint, depth bigint, n_leaves bigint, saved_tokens bigint")
    out = linked.drop("pa", "pb", "leaf", "saved", "band").join(totals, ["conv_id", "depth"])
    out = out.join(stored(ends_digests(ends), "trie-ends"), KEY, "left")
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())))


def report(conversations: DataFrame) -> DataFrame:
    """The nodes of conversations rebuilt by families of 20, sharing crc32 modulo 4 turns."""
    found = trie(
        conversations,
        family=F.col("conv") - F.col("conv") % 20,
        share=F.crc32(F.col("conv").cast("string")) % 4,
    )
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"
    return found.select(*names.split())
