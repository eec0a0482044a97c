"""Near-duplicates by min-max hashing.

A document's set holds its distinct five-word shingles (A-Z lower-cased; with
fewer words the whole sequence is the only one). Under each permutation both
the smallest and the largest hash are kept, so 144 evaluations give 288 signature
values; 48 bands of six values all miss a pair at similarity 0.75 with
probability 8e-5, and one at 0.8 with probability 5e-7. Documents with equal sets form a class at once.

Inside a bucket no pairs are listed. Its members are first compared with one
pivot, pairs are confirmed on full shingle sets, and links join components.
Buckets that still hold several components are finished across components: a
bucket up to a block's size as a whole, larger ones in blocks of documents with
the same lowest pivot, pair of blocks by pair of blocks, so no link between
components is passed over. Components grow by alternating star
joins over tables.

Null and wordless texts have an empty set and link with nothing, and so do rows
without an id (their component_id is null). Rows that repeat a ``doc_id`` are one
document that links wherever one of its texts does; ``representatives`` tells
them apart by their texts. Texts of any length are read whole, an empty table
gives no rows, and columns other than ``doc_id`` and ``text`` are not read,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import (
    ASCII_LOWER,
    Words,
    doc_columns,
    mixed,
    slices,
    stored,
    stored_narrow,
    utf8_texts,
    whole_rows,
)
from feedwright.llm.exact import with_digest
from feedwright.llm.ranks import ranked

SHINGLE = 5
PERMUTATIONS = 144
ROWS = 6
#: Links hold from 100 * shared >= PERCENT * united.
PERCENT = 75
#: Shingles of the members that are compared with a pivot in one group; a member longer than that is a group of its own.
GROUP = 200_000
#: Documents and shingles of one block.
BLOCK = 192
BLOCK_SHINGLES = 100_000
#: Distinct shingles that a comparison of two blocks holds at a time.
COLUMNS = 16_384

_RANDOM = np.random.default_rng(75)
_XOR = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, np.uint64)
_FACTOR = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all documents in one array, and where each begins."""
    words = Words([p.translate(ASCII_LOWER) for p in parts])
    every = words.shingles(SHINGLE)
    out, sizes = [], []
    for s, e in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if e - s >= SHINGLE:
            own = np.sort(every[s : e - SHINGLE + 1])
            if len(own) > 1:
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif e > s:
            own = np.zeros(1, np.uint64)
            for h in words.hashes[s:e]:
                own = mixed(own + h)
            own += np.uint64(e - s)
        else:
            own = np.zeros(0, np.uint64)
        out.append(own)
        sizes.append(len(own))
    flat = np.concatenate(out) if out else np.zeros(0, np.uint64)
    return flat, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def signatures(flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Min and max of each permutation for every non-empty set: two arrays, sets by permutations."""
    low = np.empty((len(starts) - 1, PERMUTATIONS), np.uint64)
    high = np.empty_like(low)
    for p in range(PERMUTATIONS):
        x = (flat ^ _XOR[p]) * _FACTOR[p]
        x ^= x >> np.uint64(32)
        low[:, p] = np.minimum.reduceat(x, starts[:-1])
        high[:, p] = np.maximum.reduceat(x, starts[:-1])
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """One 64-bit key per set and band; half of the bands hold minima, half maxima."""
    both = np.concatenate([low, high], axis=1).reshape(len(low), -1, ROWS)
    keys = np.zeros(both.shape[:2], np.uint64)
    for r in range(ROWS):
        keys = mixed(keys * np.uint64(31) + both[:, :, r])
    return mixed(keys + np.arange(keys.shape[1], dtype=np.uint64)[None, :])


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, two 64-bit sums over the set, and the band keys (empty sets: none)."""
    schema = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, limit=1_000_000):
                flat, starts = shingle_sets(utf8_texts(b))
                sizes = np.diff(starts)
                full = np.flatnonzero(sizes)
                sums = [np.zeros(len(sizes), np.uint64) for _ in range(2)]
                bands: list[list[int]] = [[] for _ in sizes]
                if len(full):
                    at = starts[np.concatenate([full, [len(sizes)]])]
                    for own, salt in zip(sums, (1, 2)):
                        own[full] = np.add.reduceat(mixed(flat + np.uint64(salt)), at[:-1])
                    keys = band_keys(*signatures(flat, at)).view(np.int64).tolist()
                    for d, own_keys in zip(full.tolist(), keys):
                        bands[d] = own_keys
                columns = [b.column("doc_id"), pa.array(sizes)]
                columns += [pa.array(s.view(np.int64)) for s in sums] + [pa.array(bands, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_a", "set_b", "bands"])

    return doc_columns(docs).mapInArrow(run, schema)


def confirmed(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """The pairs (a, b, n: shingles of b) that link on full sets; texts come from ``candidates`` (doc, text).

    Pairs are grouped by ``a`` and dealt to groups of bounded size, each with its own copy of ``a``.
    """
    pairs = stored(pairs, "pairs")
    groups = pairs.groupBy("a").agg(F.ceil(F.sum("n") / GROUP).cast("int").alias("parts"))
    groups = stored_narrow(groups, "pivots")
    dealt = pairs.join(groups, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.col("b").alias("doc")
    )
    pivots = groups.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    wanted = dealt.unionByName(pivots.withColumn("doc", F.col("a")))
    with_text = wanted.join(candidates, "doc")

    def link(group: pa.Table) -> pa.Table:
        ids = group.column("doc").to_numpy()
        a = group.column("a")[0].as_py()
        flat, starts = shingle_sets([t or b"" for t in group.column("text").cast(pa.binary()).to_pylist()])
        sizes = np.diff(starts)
        linked = np.zeros(len(ids), bool)
        for i in np.flatnonzero(ids == a):
            own = flat[starts[i] : starts[i + 1]]
            if len(own):
                at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
                shared = np.diff(np.concatenate([[0], np.cumsum(own[at] == flat)])[starts])
                linked |= (shared > 0) & (100 * shared >= PERCENT * (sizes + len(own) - shared))
        found = np.unique(ids[linked & (ids != a)])
        return pa.table({"a": pa.array(np.full(len(found), a, np.int64)), "b": pa.array(found.astype(np.int64))})

    return with_text.groupBy("a", "part").applyInArrow(link, "a bigint, b bigint")


def are_stars(edges: DataFrame) -> bool:
    """Whether every id has one smaller neighbour or only larger ones."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("child"), F.lit(0).alias("centre")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("child"), F.lit(1).alias("centre"))
    )
    seen = ends.groupBy("id").agg(F.sum("child").alias("child"), F.max("centre").alias("centre"))
    return not seen.where("child > 1 or child > 0 and centre > 0").limit(1).count()


def components(links: DataFrame) -> DataFrame:
    """doc, label: the smallest id that links reach, for every id in a link (links are stored).

    Each round sends every id's smallest neighbour to its larger neighbours
    (large star) and then to all smaller ones (small star), until all edges form
    stars. Minima are written before they are joined, so hot ids can be split.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    while not are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = stored_narrow(least, "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v"), "large")
        top = stored_narrow(large.groupBy("u").agg(F.min("v").alias("m")), "top")
        small = large.join(top, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = small.unionByName(top.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = stored_narrow(new, "edges")
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("doc"), F.col("v").alias("label")).unionByName(
        roots.select(F.col("v").alias("doc"), F.col("v").alias("label"))
    )


def near_size(a: str, b: str):
    """Sizes that allow a link: the smaller set holds enough of the larger."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def near_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of each row."""
    rows = stored(signed(docs), "signed")
    sets = rows.where("n_shingles > 0 and doc_id is not null")
    classes = stored_narrow(
        sets.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("doc"), F.max("doc_id").alias("last")), "classes"
    )
    members = (
        sets.join(classes.select("set_a", "set_b", "doc"), ["set_a", "set_b"])
        .where("doc_id = doc")
        .select("doc", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    )
    # Aggregates are stored before they are joined: a join of two plain shuffles lets Spark split hot keys.
    shared = members.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    shared = stored_narrow(shared.select("key"), "shared-keys")
    buckets = stored(members.join(shared, "key").dropDuplicates(["key", "doc"]), "buckets")
    wanted = buckets.select("doc").distinct()
    candidates = stored(
        doc_columns(docs).withColumnRenamed("doc_id", "doc").join(wanted, "doc").select("doc", "text"), "candidates"
    )
    same = sets.join(classes.where("doc < last"), ["set_a", "set_b"]).where("doc_id <> doc")
    links = same.select(F.col("doc").alias("a"), F.col("doc_id").alias("b"))
    copies = links.distinct()
    pivots = stored_narrow(buckets.groupBy("key").agg(F.min(F.struct("doc", "n")).alias("p")), "bucket-pivots")
    pairs = buckets.join(pivots, "key").where("doc <> p.doc").where(near_size("n", "p.n"))
    pairs = pairs.select(F.col("p.doc").alias("a"), F.col("doc").alias("b"), "n").distinct()
    links = stored(confirmed(pairs, candidates).unionByName(copies), "links")
    labels = stored(components(links), "labels")
    more = stored(across_components(buckets, labels, candidates), "more")
    if more.limit(1).count():
        labels = stored(components(star_links(labels).unionByName(more)), "labels")
    found = labels.select(F.col("doc").alias("id"), "label")
    out = rows.join(found, F.col("doc_id") == F.col("id"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id"))


def star_links(labels: DataFrame) -> DataFrame:
    return labels.where("doc <> label").select(F.col("label").alias("a"), F.col("doc").alias("b"))


def across_components(buckets: DataFrame, labels: DataFrame, candidates: DataFrame) -> DataFrame:
    """Links (a, b) between different components that share a bucket.

    A bucket of at most ``BLOCK`` documents and ``BLOCK_SHINGLES`` shingles is
    compared as a whole. The documents of larger buckets are dealt to blocks of
    about that size, and pairs of blocks are compared.
    """
    rows = buckets.join(labels, "doc", "left").withColumn("label", F.coalesce("label", "doc"))
    several = rows.groupBy("key").agg(
        F.min("label").alias("x"),
        F.max("label").alias("y"),
        F.min("doc").alias("lead"),
        F.count(F.lit(1)).alias("size"),
        F.sum("n").alias("shingles"),
        F.bit_xor(F.xxhash64("doc")).alias("same"),
    )
    fits = (F.col("size") <= BLOCK) & (F.col("shingles") <= BLOCK_SHINGLES)
    # Buckets with the same members need one comparison.
    several = several.where("x < y").dropDuplicates(["lead", "size", "same"])
    several = stored_narrow(several.select("key", "lead", fits.alias("fits")), "several")
    rows = stored(rows.join(several, "key"), "open")
    small = rows.where("fits").select(
        F.col("key").alias("block"), F.col("key").alias("other"), F.lit(0).alias("side"), "doc", "label"
    )
    rows = rows.where("not fits")
    lead = stored_narrow(rows.groupBy("doc", "label").agg(F.min("lead").alias("lead"), F.max("n").alias("n")), "leads")
    parts = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)
    sizes = lead.groupBy("lead").agg(F.ceil(parts).cast("int").alias("parts"))
    blocks = lead.join(sizes, "lead").select(
        "doc", "label", F.xxhash64("lead", F.pmod(F.xxhash64("doc"), F.col("parts"))).alias("block")
    )
    blocks = stored(blocks, "blocks")
    met = rows.join(blocks.select("doc", "block"), "doc").groupBy("key", "block")
    met = stored_narrow(met.agg(F.min("label").alias("x"), F.max("label").alias("y")), "met")
    other = met.select("key", F.col("block").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"))
    pairs = met.join(other, "key").where("block <= other and (x < y or ox < oy or x <> ox)")
    pairs = stored_narrow(pairs.select("block", "other").distinct(), "block-pairs")
    sides = pairs.select("block", "other", F.lit(0).alias("side"), F.col("block").alias("own")).unionByName(
        pairs.where("block <> other").select("block", "other", F.lit(1).alias("side"), F.col("other").alias("own"))
    )
    own = blocks.withColumnRenamed("block", "own")
    large = sides.join(own, "own").select("block", "other", "side", "doc", "label")
    members = small.unionByName(large).join(candidates, "doc")

    def compare(group: pa.Table) -> pa.Table:
        side, ids = group.column("side").to_numpy(), group.column("doc").to_numpy()
        label = group.column("label").to_numpy()
        flat, starts = shingle_sets([t or b"" for t in group.column("text").cast(pa.binary()).to_pylist()])
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1) if (side == 1).any() else left
        shared = shared_counts(flat, starts, left, right)
        sizes = np.diff(starts)
        united = sizes[left][:, None] + sizes[right][None, :] - shared
        linked = (shared > 0) & (100 * shared >= PERCENT * united) & (label[left][:, None] != label[right][None, :])
        i, j = np.nonzero(linked)
        return pa.table({"a": pa.array(ids[left[i]]), "b": pa.array(ids[right[j]])})

    return members.groupBy("block", "other").applyInArrow(compare, "a bigint, b bigint")


def shared_counts(flat: np.ndarray, starts: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many shingles each left set shares with each right set, by products of 0/1 matrices."""
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    # Sets are distinct inside, so a shingle met once is in one set only and shared with none.
    number = np.cumsum(count > 1) - 1
    common = count[column] > 1
    column, row = number[column[common]], row[common]
    out = np.zeros((len(left), len(right)), np.int64)
    for first in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
        here = (column >= first) & (column < first + COLUMNS)
        held = np.zeros((len(starts) - 1, COLUMNS), np.float32)
        held[row[here], column[here] - first] = 1
        out += (held[left] @ held[right].T).astype(np.int64)
    return out


def _kept(found: DataFrame) -> DataFrame:
    return found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("number"))


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: the first document of each component, and every row without an id.

    Where ids repeat, rows are judged by id and text: unrelated texts under one
    id both stay. The first is the one with the smallest id, of equal ids the
    one with the smallest digest of its text; of equal rows one stays.
    """
    ids = docs.select(F.col("doc_id").cast("bigint").alias("id")).where("id is not null")
    if not ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        kept = stored(_kept(near_components(docs)), "kept")
        rows = whole_rows(docs)
        stays = rows.join(kept, F.col("id") == F.col("number"), "left_semi")
        return stays.unionByName(rows.where("id is null")).select("row.*")
    rows = with_digest(docs)
    pairs = rows.where("id is not null").select("id", "digest").distinct().withColumn("all", F.lit(0))
    order = [F.col("id").asc(), F.col("digest").asc()]
    numbers = stored(ranked(stored(pairs, "pairs"), "all", order, "numbers").select("id", "digest", F.col("rank").alias("number")), "numbers")
    numbered = rows.join(numbers, ["id", "digest"])
    texts = numbered.select(F.col("number").alias("doc_id"), F.col("row.text").cast("string").alias("text"))
    kept = stored(_kept(near_components(stored(texts.dropDuplicates(["doc_id"]), "texts"))), "kept")
    stays = numbered.join(kept, "number").dropDuplicates(["number"])
    return stays.select("row").unionByName(rows.where("id is null").select("row")).select("row.*")
