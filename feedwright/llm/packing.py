"""Best-fit packing of token sequences by sums of squares.

Documents become token ids and an end id 0. A document longer than a sequence
is cut into full pieces and a rest; full pieces are sequences of their own. The
rests are packed by the sum-of-squares rule: N(g) counts the open bins whose
residual gap is g, and a rest goes where the sum of N(g)^2 over all gaps
becomes smallest, either into an open bin or into a new one; ties prefer the
smaller gap left. Rests come longest first.

Rests are dealt at random to shards of bounded size, and each shard packs
alone. The bins a shard could not fill are then packed as blocks with those of
other shards, over at most ``ROUNDS`` further rounds with fewer shards.

Null text counts as empty: its only id is the end id. Repeated rows are packed
as often as they occur, rows without an id like others, and texts of any length
whole. An empty table gives no pieces, and columns other than ``doc_id`` and
``text`` are not read, whatever their names.
"""

from __future__ import annotations

import sys
import types
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import Words, doc_columns, slices, stored, texts

SEQUENCE = 2048
END_ID = 0
#: Rests or blocks that one shard packs, and rounds of packing blocks again.
SHARD_PIECES = 3_000
ROUNDS = 4
#: Distinct chunks whose ids a worker remembers before it starts anew.
MEMORY = 500_000


def latin(text: str) -> bool:
    """Only Latin-1: such text is composed already and lower-cases letter by letter."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies spell Latin-1 letters: each byte of their UTF-8 as one character."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spelled = {b: chr(b) for b in plain}
    spelled |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in spelled)}
    return {c: "".join(spelled[b] for b in chr(c).encode()) for c in range(256)}


class ChunkTokenizer:
    """Token ids of texts, from remembered ids of the chunks between spaces and line ends.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its chunks in order. Chunks are found and hashed as arrays; one
    seen before costs a look into an open-addressed table. A new chunk of Latin
    letters, perhaps with one mark behind, needs only the ids of its word and
    mark; any other, such as one that holds an added token, goes through the
    whole tokenizer. Chunks are looked up in
    runs, and the table is emptied before a run that could fill more than half
    of it, so texts may hold any number of distinct chunks.
    """

    MARKS = ".,;:!?"
    SLOT_BITS = 21
    #: Chunks that go through the whole tokenizer at a time.
    BATCH = 10_000

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.added = [t.content.lower() for t in self.model.get_added_tokens_decoder().values()]
        self.words = self.model.model
        self.spell = byte_letters()
        self.marks = {m: self.model.encode(m, add_special_tokens=False).ids for m in self.MARKS} | {"": []}
        self.forget()

    def forget(self) -> None:
        self.slots = np.full(1 << self.SLOT_BITS, -1, np.int32)
        self.keys = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def lowered(self, text: str) -> str:
        """Text that is lower-cased where this changes no id: added tokens such as <|endoftext|> match by case."""
        low = text.lower()
        return low if latin(text) and not any(t in low for t in self.added) else text

    def chunk(self, text: str) -> list[int] | None:
        """Ids of a chunk of Latin letters and at most one mark; None for any other."""
        word, mark = (text[:-1], text[-1]) if text[-1] in self.MARKS else (text, "")
        if not word.isalpha() or not latin(word):
            return None
        word = word.lower()
        found = self.words.tokenize(word if word.isascii() else word.translate(self.spell))
        return [t.id for t in found] + self.marks[mark]

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        return ((keys >> np.uint64(64 - self.SLOT_BITS)).astype(np.int64) + probe) & ((1 << self.SLOT_BITS) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each chunk, -1 for chunks not seen before."""
        out = np.full(len(keys), -1, np.int64)
        left, probe = np.arange(len(keys)), 0
        while len(left) and len(self.keys):
            at = self.slots[self._slot(keys[left], probe)]
            hit = (at >= 0) & (self.keys[at] == keys[left])
            out[left[hit]] = at[hit]
            left = left[(at >= 0) & ~hit]
            probe += 1
        return out

    def learn(self, keys: np.ndarray, new: list[str]) -> None:
        found = [self.chunk(c) for c in new]
        others = [i for i, f in enumerate(found) if f is None]
        for at in range(0, len(others), self.BATCH):
            part = others[at : at + self.BATCH]
            for i, e in zip(part, self.model.encode_batch([new[i] for i in part], add_special_tokens=False)):
                found[i] = e.ids
        count = np.fromiter(map(len, found), np.int64, len(found))
        numbers = np.arange(len(self.keys), len(self.keys) + len(keys))
        self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.uint32, int(count.sum()))])
        self.keys = np.concatenate([self.keys, keys])
        probe = 0
        while len(numbers):
            at = self._slot(self.keys[numbers], probe)
            free = self.slots[at] < 0
            self.slots[at[free]] = numbers[free]
            numbers = numbers[self.slots[at] != numbers]
            probe += 1

    def run_ids(self, chunks: Words, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each chunk of a run has, and the ids of all in order."""
        keys = chunks.hashes[start:stop]
        at = self.find(keys)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new, where = np.unique(keys[missing], return_index=True)
            where = missing[where] + start
            begin, end = chunks.begin[where].tolist(), chunks.end[where].tolist()
            self.learn(new, [chunks.raw[s:e].decode() for s, e in zip(begin, end)])
            at[missing] = self.find(keys[missing])
        count = self.count[at]
        before = np.cumsum(count) - count
        return count, self.ids[np.repeat(self.first[at] - before, count) + np.arange(int(count.sum()))]

    def encode(self, docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each document's followed by the end id, and where documents begin and end."""
        parts = [self.lowered(t).encode() for t in docs]
        chunks = Words(parts, (0x20, 0x0A))
        half = 1 << (self.SLOT_BITS - 1)
        run = half // 2
        counts, flats = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for start in range(0, len(chunks.hashes), run):
            if len(self.keys) > min(MEMORY, half - run):
                self.forget()
            count, flat = self.run_ids(chunks, start, min(start + run, len(chunks.hashes)))
            counts.append(count)
            flats.append(flat)
        tokens = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        flat = np.concatenate(flats)
        per_doc = np.diff(tokens[chunks.first])
        total = int(tokens[-1])
        order = np.arange(total)
        out = np.full(total + len(docs), END_ID, np.uint32)
        out[order + np.repeat(np.arange(len(docs)), per_doc)] = flat
        return out, np.concatenate([[0], np.cumsum(per_doc + 1)])


def worker_tokenizer(path: str) -> ChunkTokenizer:
    """The tokenizer that this Python worker keeps over its tasks, with the chunks it remembers."""
    held = sys.modules.setdefault("_kept_tokenizers", types.ModuleType("_kept_tokenizers")).__dict__
    if path not in held:
        held[path] = ChunkTokenizer(path)
    return held[path]


def pieces(docs: DataFrame, tokenizer: str, with_ids: bool = False, sequence: int = SEQUENCE) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, a random salt, and the ids if wanted."""
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, salt bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_tokenizer(tokenizer)
        row = 0
        for whole in batches:
            for b in slices(whole, limit=500_000):
                ids, bounds = model.encode(texts(b))
                raw = memoryview(ids.tobytes())
                doc_ids = b.column("doc_id").to_pylist()
                out: list[tuple] = []
                for d, (start, end) in zip(doc_ids, zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    for n, at in enumerate(range(start, end, sequence)):
                        stop = min(end, at + sequence)
                        crc = zlib.crc32(raw[4 * at : 4 * stop])
                        row += 1
                        salt = (crc * 2654435761 + row * 40503 + stop) % (1 << 31)
                        own = (d, n, at - start, stop - at, crc, salt)
                        out.append((*own, ids[at:stop]) if with_ids else own)
                kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.list_(pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "salt", "ids"]
                columns = [pa.array(list(c), k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    return doc_columns(docs).mapInArrow(run, schema + (", ids array<bigint>" if with_ids else ""))


def sum_of_squares(lengths: np.ndarray, sequence: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset in it of each item, longest first."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins = np.zeros(sequence + 1, np.int64)
    by_gap: list[list[int]] = [[] for _ in range(sequence + 1)]
    gap_of: list[int] = []
    gaps = np.arange(sequence + 1)
    for i in order:
        size = int(lengths[i])
        # A gap g that shrinks to g - size changes the sum by 2 (N(g - size) - N(g)) + 2;
        # a filled bin counts no more, and a new bin only adds.
        change = np.where(open_bins[size:] > 0, 2 * (open_bins[: sequence + 1 - size] - open_bins[size:]) + 2, 1 << 60)
        change[0] = 1 - 2 * open_bins[size] if open_bins[size] else 1 << 60
        best = int(np.argmin(change))
        fresh = 2 * open_bins[sequence - size] + 1 if size < sequence else 0
        if change[best] <= fresh:
            gap = int(gaps[best + size])
            b = by_gap[gap].pop()
            open_bins[gap] -= 1
        else:
            b, gap = len(gap_of), sequence
            gap_of.append(gap)
        bins[i], offsets[i] = b, sequence - gap
        gap_of[b] = gap - size
        if gap > size:
            by_gap[gap - size].append(b)
            open_bins[gap - size] += 1
    return bins, offsets


def _pack_round(items: DataFrame, shards: int, sequence: int) -> DataFrame:
    """item, length -> item, bin (unique over shards), offset, fill of the bin."""

    def pack(group: pa.Table) -> pa.Table:
        lengths = group.column("length").to_numpy()
        bins, offsets = sum_of_squares(lengths, sequence)
        fill = np.bincount(bins, lengths).astype(np.int64)
        shard = group.column("shard").to_numpy()
        columns = {"item": group.column("item"), "bin": bins * shards + shard, "offset": offsets, "fill": fill[bins]}
        return pa.table(columns)

    dealt = items.select("item", "length", F.pmod("salt", F.lit(shards)).alias("shard"))
    return dealt.groupBy("shard").applyInArrow(pack, "item bigint, bin bigint, offset bigint, fill bigint")


def place(cut: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """Give each piece (length, salt; stored) its ``sequence_id`` and ``offset``."""
    numbered = stored(cut.withColumn("item", F.monotonically_increasing_id()), "pieces")
    rests = numbered.where(F.col("length") < sequence)
    n = rests.count()
    shards = -(-max(1, n) // SHARD_PIECES)
    placed = stored(_pack_round(rests, shards, sequence), "bins")
    blocks = placed.groupBy("bin").agg(F.max("fill").alias("fill"))
    # Where each bin of the first round ends up: a bin of a later round and the offset there.
    moved = blocks.select("bin", F.col("bin").alias("sequence_id"), F.lit(0).cast("bigint").alias("base"), "fill")
    moved = stored(moved, "blocks")
    for level in range(1, ROUNDS + 1):
        loose = moved.where(F.col("fill") < sequence).groupBy("sequence_id").agg(F.max("fill").alias("length"))
        n = loose.count()
        if shards == 1 or n < 2:
            break
        shards = -(-n // SHARD_PIECES)
        salt = F.abs(F.xxhash64("sequence_id", F.lit(level)))
        again = _pack_round(loose.select(F.col("sequence_id").alias("item"), "length", salt.alias("salt")), shards, sequence)
        again = again.select(
            F.col("item").alias("sequence_id"),
            # The bins of each round are numbered in a range of their own.
            (F.col("bin") + (level << 50)).alias("next_id"),
            F.col("offset").alias("shift"),
            F.col("fill").alias("next_fill"),
        )
        moved = stored(
            moved.join(again, "sequence_id", "left").select(
                "bin",
                F.coalesce("next_id", "sequence_id").alias("sequence_id"),
                (F.col("base") + F.coalesce("shift", F.lit(0))).alias("base"),
                F.coalesce("next_fill", "fill").alias("fill"),
            ),
            "blocks",
        )
    placed = placed.join(moved.select("bin", "sequence_id", "base"), "bin").select(
        "item", "sequence_id", (F.col("offset") + F.col("base")).alias("offset")
    )
    full = numbered.where(F.col("length") >= sequence).select(
        "item", (-F.col("item") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    return numbered.join(placed.unionByName(full), "item").drop("item", "salt")


def pack(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    return place(pieces(docs, tokenizer, sequence=sequence), sequence)


def packed_ids(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE) -> DataFrame:
    """The sequences themselves: sequence_id and its ids, pieces in order of their offsets."""
    placed = place(pieces(docs, tokenizer, True, sequence), sequence)
    parts = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
