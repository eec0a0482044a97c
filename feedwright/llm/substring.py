"""Repeated passages by seed and extend.

Words are runs outside space, tab and line breaks, unchanged. Every run of 10
words is a possible seed; of the 41 seeds inside a window of 50 words the one
with the smallest hash (the leftmost of equals) is the window's anchor. The
windows of one anchor lie side by side and form a stretch, the anchor extended
both ways as far as it stays the smallest. Equal windows have equal anchors, so
joining documents on anchors loses no repeat.

Stretches with equal content repeat as a whole: all but the smallest document
lose them. Where an anchor stands in stretches of different content, the first
document of each content is compared window by window with the other contents.
Removed windows that touch or overlap merge into maximal repeats.

A word is removed if it lies in a window whose word sequence also starts in a
document with a smaller doc_id. Null has no words. Rows without an id neither
remove nor lose words. Rows that repeat a ``doc_id`` belong to one document.
Texts of any length are read whole, an empty table gives no rows, and columns
other than ``doc_id`` and ``text`` are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import Words, doc_columns, slices, stored, utf8_texts

WINDOW = 50
SEED = 10
#: Bits that hold a seed's place when seeds are compared; the hash has the rest.
PLACE_BITS = 28


def window_anchors(seeds: np.ndarray) -> np.ndarray:
    """For each window start, the place of the smallest of its seeds, the leftmost of equals."""
    width = WINDOW - SEED + 1
    bits = np.uint64(PLACE_BITS)
    least = (seeds >> bits << bits) | np.arange(len(seeds), dtype=np.uint64)
    have = 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[: max(0, len(least) - step)], least[step:])
        have += step
    return (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)


def digest_pair(data: bytes) -> tuple[int, int]:
    raw = xxhash.xxh3_128_digest(data)
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def normal(text: bytes) -> bytes:
    """The words joined by one space."""
    return b" ".join(text.split())


def document_stretches(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, sha of the normal text, and the stretches with anchor and content of each row."""
    schema = (
        "doc_id bigint, n_words bigint, sha string, "
        "stretches array<struct<start:int,n:int,anchor:bigint,a:bigint,b:bigint>>"
    )
    kind = pa.list_(
        pa.struct([("start", pa.int32()), ("n", pa.int32()), *[(c, pa.int64()) for c in ("anchor", "a", "b")]])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, limit=1_000_000):
                parts = utf8_texts(b)
                words = Words(parts)
                counts = np.diff(words.first)
                seeds = words.shingles(SEED)
                place = window_anchors(seeds)
                windows = np.maximum(0, counts - WINDOW + 1)
                starts = np.repeat(words.first[:-1] - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
                owner = np.repeat(np.arange(len(parts)), windows)
                at = place[starts] if len(starts) else starts
                fresh = np.ones(len(at), bool)
                fresh[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
                first = np.flatnonzero(fresh)
                length = np.diff(np.concatenate([first, [len(at)]]))
                hashed = memoryview(words.hashes.tobytes())
                out: list[list[tuple]] = [[] for _ in parts]
                anchors = seeds[at[first]].view(np.int64).tolist() if len(first) else []
                begin = words.first[:-1].tolist()
                for d, s, n, anchor in zip(owner[first].tolist(), starts[first].tolist(), length.tolist(), anchors):
                    content = digest_pair(hashed[8 * s : 8 * (s + n - 1 + WINDOW)])
                    out[d].append({"start": s - begin[d], "n": n, "anchor": anchor, "a": content[0], "b": content[1]})
                shas = [hashlib.sha256(normal(p)).hexdigest() for p in parts]
                columns = [b.column("doc_id"), pa.array(counts), pa.array(shas), pa.array(out, kind)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "sha", "stretches"])

    return doc_columns(docs).mapInArrow(run, schema)


def _marks(rows: DataFrame) -> DataFrame:
    """Stretches to remove (copied) or to compare by window, as one list per document text."""
    flat = rows.where("doc_id is not null").select("doc_id", "sha", F.inline("stretches"))
    shared = flat.groupBy("anchor").agg(
        F.min("doc_id").alias("low"),
        F.max("doc_id").alias("high"),
        ((F.min("a") == F.max("a")) & (F.min("b") == F.max("b"))).alias("single"),
    )
    # Aggregates are stored before they are joined: a join of two plain shuffles lets Spark split hot anchors.
    shared = stored(shared.where("low < high").select("anchor", "single"), "shared-anchors")
    repeated = stored(flat.join(shared, "anchor"), "repeated")
    contents = stored(repeated.groupBy("anchor", "a", "b").agg(F.min("doc_id").alias("owner")), "contents")
    judged = repeated.join(contents, ["anchor", "a", "b"]).where("doc_id > owner or not single")
    own = F.struct("start", "n", (F.col("doc_id") > F.col("owner")).alias("copied"))
    return judged.groupBy("doc_id", "sha").agg(F.collect_list(own).alias("marks"))


def _window_repeats(marked: DataFrame) -> DataFrame:
    """Windows of the compared stretches that a smaller document also holds, as one list per text."""
    schema = "doc_id bigint, sha string, start int, a bigint, b bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, limit=1_000_000):
                words = Words(utf8_texts(batch))
                hashed = memoryview(words.hashes.tobytes())
                ids, shas = batch.column("doc_id").to_pylist(), batch.column("sha").to_pylist()
                out: list[tuple] = []
                for d, marks in enumerate(batch.column("marks").to_pylist()):
                    for m in marks:
                        for start in range(m["start"], m["start"] + m["n"]) if not m["copied"] else ():
                            at = int(words.first[d]) + start
                            out.append((ids[d], shas[d], start, *digest_pair(hashed[8 * at : 8 * (at + WINDOW)])))
                kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
                columns = [pa.array(list(c), k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "sha", "start", "a", "b"])

    open_rows = marked.where(F.exists("marks", lambda m: ~m["copied"]))
    windows = stored(open_rows.mapInArrow(run, schema), "windows")
    owners = windows.groupBy("a", "b").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("high"))
    owners = stored(owners.where("owner < high").drop("high"), "owners")
    lost = windows.join(owners, ["a", "b"]).where("doc_id > owner")
    return lost.groupBy("doc_id", "sha").agg(F.collect_list("start").alias("starts"))


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, sha (of the words joined by one space), and for rows that lose words:
    ``spans`` (start and end of the maximal repeats, in words), ``n_removed`` and the ``kept`` text.
    """
    rows = stored(document_stretches(docs), "stretches")
    marks = _marks(rows)
    with_text = doc_columns(docs).join(marks, "doc_id")
    schema = "doc_id bigint, sha string, text string, marks array<struct<start:int,n:int,copied:boolean>>"

    def own_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shas = [hashlib.sha256(normal(t)).hexdigest() for t in utf8_texts(b)]
            keep = pa.array([s == o for s, o in zip(shas, b.column("sha").to_pylist())], pa.bool_())
            yield b.filter(keep)

    with_text = with_text.select("doc_id", "sha", "text", "marks").mapInArrow(own_marks, schema)
    marked = stored(with_text, "marked")
    found = marked.join(_window_repeats(marked), ["doc_id", "sha"], "left").select(
        "doc_id", "sha", "text", "marks", "starts"
    )
    out = "doc_id bigint, sha string, spans array<struct<start:int,end:int>>, n_removed bigint, kept string"

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for b in batches:
            spans, removed, kept = [], [], []
            lists = zip(utf8_texts(b), b.column("marks").to_pylist(), b.column("starts").to_pylist())
            for text, marks, starts in lists:
                words = text.split()
                gone = np.zeros(len(words) + 1, np.int64)
                for s, n in [*((m["start"], m["n"]) for m in marks if m["copied"]), *((s, 1) for s in starts or ())]:
                    gone[s] += 1
                    gone[s + n - 1 + WINDOW] -= 1
                covered = np.cumsum(gone)[:-1] > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
                spans.append([{"start": s, "end": e} for s, e in zip(edges[::2].tolist(), edges[1::2].tolist())])
                removed.append(int(covered.sum()))
                kept.append(b" ".join(w for w, c in zip(words, covered.tolist()) if not c).decode())
            columns = [b.column("doc_id"), b.column("sha"), pa.array(spans, kind)]
            columns += [pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "sha", "spans", "n_removed", "kept"])

    cut = found.mapInArrow(remove, out).where("n_removed > 0").dropDuplicates(["doc_id", "sha"])
    return rows.select("doc_id", "n_words", "sha").join(cut, ["doc_id", "sha"], "left")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of each row."""
    found = repeats(docs)
    return found.select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce(F.sha2("kept", 256), F.col("sha")).alias("kept_sha256"),
    )
