"""Exact de-duplication through a minimal perfect hash over historical digests.

The digests of a history are dealt to buckets of bounded size. Each bucket gets
a minimal perfect hash by hash-and-displace: its digests fall into small groups,
and each group carries the first seed that sends its members to free slots. A
slot holds the full digest, the locator of the winning row (the largest
``doc_id``) and how many rows share the text. A lookup computes one slot and
compares all 32 bytes found there, so a digest outside the history is never
taken for a member.

Texts are equal when they are identical after lower-casing A-Z; null counts as
the empty text. Rows that repeat a ``doc_id`` and its text count as rows of
their group and share its verdict; a null ``doc_id`` loses against any other.
Texts of any length are hashed whole, an empty table gives no rows, and other
columns are not read; ``winners`` carries them unchanged, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import ASCII_LOWER, doc_columns, id_key, slices, stored, utf8_texts, whole_rows

#: Digests expected in one bucket of the index, and in one group of its hash.
BUCKET_DIGESTS = 1_000
GROUP_DIGESTS = 4

INDEX = "bucket int, seeds array<int>, digests binary, winners array<bigint>, sizes array<bigint>"


def text_digest(text: bytes) -> bytes:
    return hashlib.sha256(text.translate(ASCII_LOWER)).digest()


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the SHA-256 of the normalised whole text, one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole):
                found = pa.array([text_digest(t) for t in utf8_texts(b)], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), found], ["doc_id", "digest"])

    return doc_columns(docs).mapInArrow(run, "doc_id bigint, digest binary")


def groups(keyed: DataFrame) -> DataFrame:
    """One row per digest: its winner and its number of rows, combined before the shuffle."""
    return keyed.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("size"))


def _words(digest_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit words of each 32-byte digest: one picks the group, one the slot."""
    words = digest_bytes.reshape(-1, 32)[:, :16].copy().view(np.uint64)
    return words[:, 0], words[:, 1]


def _slots(word: np.ndarray, seed: np.ndarray | int, n: int) -> np.ndarray:
    x = word ^ (np.asarray(seed, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return (x % np.uint64(n)).astype(np.int64)


def perfect_hash(digest_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds by group and the slot of each of the given distinct digests."""
    first, second = _words(digest_bytes)
    n = len(first)
    group = (first % np.uint64(max(1, n // GROUP_DIGESTS))).astype(np.int64)
    seeds = np.zeros(max(1, n // GROUP_DIGESTS), np.int32)
    taken, placed = np.zeros(n, bool), np.empty(n, np.int64)
    order = np.argsort(group, kind="stable")
    starts = np.searchsorted(group[order], np.arange(len(seeds) + 1))
    for g in np.argsort(-(starts[1:] - starts[:-1]), kind="stable"):
        members = order[starts[g] : starts[g + 1]]
        if not len(members):
            break
        seed = 0
        while True:
            tries = np.arange(seed, seed + 64)[:, None]
            at = _slots(second[members][None, :], tries, n)
            free = ~taken[at].any(axis=1)
            if len(members) > 1:
                ordered = np.sort(at, axis=1)
                free &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if free.any():
                hit = int(np.argmax(free))
                seeds[g], placed[members], taken[at[hit]] = seed + hit, at[hit], True
                break
            seed += 64
    return seeds, placed


def slots_of(digest_bytes: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    first, second = _words(digest_bytes)
    return _slots(second, seeds[(first % np.uint64(len(seeds))).astype(np.int64)], n)


def bucket_of(n_buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(n_buckets)).cast("int")


def build_index(history: DataFrame, n_buckets: int) -> DataFrame:
    """The index of ``history`` (digest, winner, size; digests distinct): one row per bucket."""

    def build(table: pa.Table) -> pa.Table:
        raw = np.frombuffer(b"".join(table.column("digest").to_pylist()), np.uint8)
        seeds, placed = perfect_hash(raw)
        back = np.empty(len(placed), np.int64)
        back[placed] = np.arange(len(placed))
        in_slots = table.take(pa.array(back))
        return pa.table(
            {
                "bucket": in_slots.column("bucket").slice(0, 1),
                "seeds": pa.array([seeds.tolist()], pa.list_(pa.int32())),
                "digests": pa.array([b"".join(in_slots.column("digest").to_pylist())], pa.binary()),
                "winners": pa.array([in_slots.column("winner").to_pylist()], pa.list_(pa.int64())),
                "sizes": pa.array([in_slots.column("size").to_pylist()], pa.list_(pa.int64())),
            }
        )

    dealt = history.withColumn("bucket", bucket_of(n_buckets))
    return dealt.groupBy("bucket").applyInArrow(build, INDEX)


def look_up(index: DataFrame, asked: DataFrame, n_buckets: int) -> DataFrame:
    """``asked`` (distinct digests) with ``known``, and the winner and size its slot holds.

    The digests asked of one bucket meet its index in one row; their number is
    bounded like the bucket's own, as digests are distinct and dealt by hash.
    """
    schema = "digest binary, known boolean, winner bigint, size bigint"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                wanted, held = row["asked"], row["digests"] or b""
                n = len(held) // 32
                slots = [0] * len(wanted)
                if n:
                    asked_bytes = np.frombuffer(b"".join(wanted), np.uint8)
                    slots = slots_of(asked_bytes, np.array(row["seeds"]), n).tolist()
                known = [bool(n) and held[32 * s : 32 * s + 32] == d for s, d in zip(slots, wanted)]
                winners = [row["winners"][s] if k else None for s, k in zip(slots, known)]
                sizes = [row["sizes"][s] if k else None for s, k in zip(slots, known)]
                columns = [pa.array(wanted, pa.binary()), pa.array(known, pa.bool_())]
                columns += [pa.array(winners, pa.int64()), pa.array(sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["digest", "known", "winner", "size"])

    keys = asked.groupBy(bucket_of(n_buckets).alias("bucket")).agg(F.collect_list("digest").alias("asked"))
    return keys.join(index, "bucket", "left").mapInArrow(find, schema)


def against_history(incoming: DataFrame, history: DataFrame) -> DataFrame:
    """Judge keyed rows against a keyed history; both hold ``doc_id`` and ``digest``.

    Returns per row of ``incoming``: doc_id, digest, known (its text is in the
    history), winner and size: the history's for known texts, else those of the
    group that the new rows form among themselves.
    """
    past = stored(groups(history), "history")
    n_buckets = -(-max(1, past.count()) // BUCKET_DIGESTS)
    index = stored(build_index(past, n_buckets), "index")
    asked = past if incoming is history else groups(incoming)
    found = look_up(index, asked, n_buckets)
    if incoming is history:
        verdicts = found
    else:
        fresh = asked.select("digest", F.col("winner").alias("own"), F.col("size").alias("own_size"))
        verdicts = fresh.join(found, "digest").select(
            "digest",
            "known",
            F.when(F.col("known"), F.col("winner")).otherwise(F.col("own")).alias("winner"),
            F.when(F.col("known"), F.col("size")).otherwise(F.col("own_size")).alias("size"),
        )
    return incoming.join(stored(verdicts, "verdicts"), "digest").select(
        "doc_id", "digest", "known", "winner", "size"
    )


def judged(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` judged against the whole of ``docs`` as its history."""
    keyed = stored(digests(docs), "digests")
    return against_history(keyed, keyed)


def with_digest(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` as the struct ``row``, with its ``id`` and its text's ``digest``."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole):
                found = pa.array([text_digest(t) for t in utf8_texts(b)], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column("row"), b.column("id"), found], ["row", "id", "digest"])

    rows = whole_rows(docs).withColumn("text", F.col("row.text").cast("string"))
    return rows.mapInArrow(keyed, rows.drop("text").schema.add("digest", "binary"))


def winners(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns; one row of each group of equal texts."""
    keep = judged(docs).where(F.col("doc_id").eqNullSafe(F.col("winner")))
    keep = keep.groupBy("digest", id_key("doc_id").alias("key")).agg(F.count(F.lit(1)).alias("copies"))
    keep = stored(keep, "kept")
    kept = with_digest(docs).withColumn("key", id_key("id")).join(keep, ["digest", "key"])
    if keep.where("copies > 1").limit(1).count():
        kept = kept.dropDuplicates(["digest"])
    return kept.select("row.*")
