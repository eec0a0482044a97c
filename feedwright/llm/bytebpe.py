"""Byte-level BPE: token ids of whole texts by a local rank file, and their bytes again.

The tiktoken library splits a text by a pattern and merges the bytes of each
match by rank. Its pattern matcher gives up on white space runs of about a
million characters, and a long text should not be held several times over, so a
text above ``LONG`` characters is cut first where every match ends anyway: before
a space or line end that follows an ASCII letter or digit. No match reaches
across such a place, and no look-ahead does either. What has no such place for
long (white space, scripts without spaces, base64) is matched one by one, and
each match is merged whole by a second encoding that does not split at all.

Null text counts as empty: no ids, no bytes. Rows that repeat a ``doc_id`` are
encoded one by one; an id may be null; an empty table gives no rows; columns
other than ``doc_id`` and ``text`` are not read, whatever their names. No text
is an end-of-text or other special token: their spellings are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import doc_columns, lean, slices, small_batches, texts

#: Characters that are encoded in one call; longer texts are cut.
LONG = 100_000
#: Ids that are turned into bytes in one call.
DECODE_RUN = 1_000_000

_SAFE = regex.compile(r"(?<=[A-Za-z0-9])(?=[ \n])")


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


class ByteBpe:
    """Encoder and decoder over one rank file and one pattern."""

    def __init__(self, path: str, pattern: str) -> None:
        import tiktoken

        ranks = read_ranks(path)
        self.split = tiktoken.Encoding("split", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # The same merges over a whole match, however long it is.
        self.whole = tiktoken.Encoding("whole", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        # \s of the library's matcher is White_Space, which leaves out the separators 1C to 1F.
        spelled = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.match = regex.compile(spelled)

    def parts(self, text: str) -> Iterator[tuple[int, int]]:
        """Where to cut a text so that no match is cut: parts of about ``LONG`` characters."""
        start = 0
        while len(text) - start > LONG:
            cut = _SAFE.search(text, start + LONG)
            stop = cut.start() if cut else len(text)
            yield start, stop
            start = stop
        if start < len(text):
            yield start, len(text)

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, unsigned 32-bit."""
        if len(text) <= LONG:
            return self.split.encode_to_numpy(text, disallowed_special=())
        found = [np.zeros(0, np.uint32)]
        for start, stop in self.parts(text):
            # A part twice as long has no safe place for long: its matches are merged one by one.
            if stop - start <= 2 * LONG:
                found.append(self.split.encode_to_numpy(text[start:stop], disallowed_special=()))
                continue
            run: list[int] = []
            for m in self.match.finditer(text, start, stop):
                run += self.whole.encode_ordinary(m.group())
                if len(run) > DECODE_RUN:
                    found.append(np.array(run, np.uint32))
                    run = []
            found.append(np.array(run, np.uint32))
        return np.concatenate(found)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ids; they need not form whole characters."""
        runs = (ids[i : i + DECODE_RUN].tolist() for i in range(0, len(ids), DECODE_RUN))
        return b"".join(self.split.decode_bytes(r) for r in runs)


@cache
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """One encoder per worker and file: it is built once and holds nothing of the texts."""
    return ByteBpe(path, pattern)


def _columns(model: ByteBpe, b: pa.RecordBatch, with_bytes: bool) -> pa.RecordBatch:
    ids = [model.encode(t) for t in texts(b)]
    columns = {"doc_id": b.column("doc_id"), "n_tokens": pa.array([len(i) for i in ids], pa.int64())}
    columns["ids"] = pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())
    if with_bytes:
        columns["bytes"] = pa.array([model.decode(i) for i in ids], pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def encoded(docs: DataFrame, vocabulary: str, pattern: str, with_bytes: bool = False) -> DataFrame:
    """doc_id, n_tokens and ids of each row; ids are little-endian unsigned 32-bit integers in one binary.

    ``with_bytes`` adds what the ids spell, as ``decoded`` does, in the same worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_bpe(vocabulary, pattern)
        for whole in batches:
            for b in slices(whole):
                yield _columns(model, b, with_bytes)

    schema = "doc_id bigint, n_tokens bigint, ids binary" + (", bytes binary" if with_bytes else "")
    return doc_columns(docs).mapInArrow(lean(run), schema)


def decoded(ids: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """The rows of ``encoded`` with ``bytes``, what their ids spell; null ids give no bytes."""
    small_batches(ids.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_bpe(vocabulary, pattern)
        for whole in batches:
            for b in slices(whole, "ids"):
                raw = [model.decode(np.frombuffer(i or b"", "<u4")) for i in b.column("ids").to_pylist()]
                kept = [b.column(n) for n in ("doc_id", "n_tokens", "ids")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(raw, pa.binary())], ["doc_id", "n_tokens", "ids", "bytes"])

    rows = ids.select("doc_id", "n_tokens", "ids")
    return rows.mapInArrow(lean(run), "doc_id bigint, n_tokens bigint, ids binary, bytes binary")


def digests(spelled: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded bytes."""
    return spelled.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
