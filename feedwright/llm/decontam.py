"""Benchmark decontamination with a generalised suffix automaton.

Items are lower-cased (A-Z) and cut into words; words are runs of digits,
letters and characters beyond ASCII. One suffix automaton holds all items of a
block, over word numbers. A document's words stream through it: the state and
the length of the longest match that ends at each word are tracked, and a word
outside every item resets both. Where the match reaches the window (10 words),
the window's words are hit, and the state of that length names the items it
lies in. An item of fewer words is one window: it is found when it is a suffix
of the current match, by the marked states on the suffix links.

Items with null or wordless text match nothing. Items without an id hit words
but are not listed; rows that repeat an item count once. Benchmarks are cut into
blocks of bounded size, each block streams past all documents, and longer items
overlap from block part to block part, so no window is lost. Null documents
have no words, texts of any length are streamed whole, and rows that repeat an
id are judged one by one. An empty table gives no rows, an empty benchmark hits
nothing, and other columns are not read; ``clean`` carries them unchanged,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import doc_columns, slices, stored, utf8_texts, whole_rows

WINDOW = 10
#: Words of benchmark text in one automaton.
BLOCK_WORDS = 200_000
#: A document with more than this share of its words hit is dropped by ``clean``.
MAX_COVERAGE = 0.8

#: Word bytes keep their place (A-Z lower-cased); every other byte becomes a space.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Automaton:
    """Suffix automaton of many word sequences, with the items that each window lies in."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        sequences = []
        for name, words in items:
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            last = 0
            for n in numbers:
                last = self._extend(last, n)
            sequences.append((name, numbers))
        self.shortest = min([window, *(len(n) for _, n in sequences if n)])
        for name, numbers in sequences:
            state, matched = 0, 0
            for n in numbers:
                state, matched = self.next[state][n], matched + 1
                if matched >= window:
                    state = self._suffix(state, window)
                    self.items.setdefault(state, set()).update([name] if name is not None else [])
            if 0 < len(numbers) < window:
                own = self.short.setdefault(state, {}).setdefault(len(numbers), set())
                own.update([name] if name is not None else [])
        # The nearest state on the suffix links, itself included, that ends a short item.
        self.marked = [-1] * len(self.next)
        for s in sorted(range(len(self.next)), key=self.length.__getitem__):
            up = self.link[s]
            self.marked[s] = s if s in self.short else self.marked[up] if up >= 0 else -1

    def _extend(self, last: int, n: int) -> int:
        known = self.next[last].get(n)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, n, known)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and n not in self.next[p]:
            self.next[p][n] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][n]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, n, q)
        return new

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, n: int, q: int) -> int:
        """A state of its own for the shorter strings of ``q``."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(n) == q:
            self.next[p][n] = clone
            p = self.link[p]
        return clone

    def _suffix(self, state: int, length: int) -> int:
        """The state of the suffix with so many words."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def hits(self, numbers: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans of words, merged and in order, and the items found, for a run of known words."""
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        following, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        for i, n in enumerate(numbers):
            to = following[state].get(n)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = following[state].get(n)
            if to is None:
                continue
            state, matched = to, matched + 1
            reach = 0
            if matched >= window:
                reach = window
                found |= self.items.get(self._suffix(state, window), set())
            s = self.marked[state]
            while s >= 0:
                for n_words, names in self.short[s].items():
                    if n_words <= matched:
                        reach = max(reach, n_words)
                        found |= names
                s = self.marked[link[s]] if link[s] >= 0 else -1
            if reach:
                start = i + 1 - reach
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        return spans, found

    def find(self, words: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set[str]]]:
        """``hits`` of each document, over its runs of known words that are long enough."""
        flat = [w for own in words for w in own]
        numbers = np.fromiter(map(self.vocabulary.get, flat, _always_unknown()), np.int64, len(flat))
        ends = np.cumsum([len(own) for own in words])
        out: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in words]
        known = numbers >= 0
        starts_here = np.zeros(len(flat), bool)
        starts_here[(ends - [len(own) for own in words])[ends > ends - [len(own) for own in words]]] = True
        first = known & (starts_here | ~np.concatenate([[False], known[:-1]])) if len(flat) else known
        begin = np.flatnonzero(first)
        stop = known & np.concatenate([starts_here[1:] | ~known[1:], [True]]) if len(flat) else known
        end = np.flatnonzero(stop) + 1
        enough = end - begin >= self.shortest if len(begin) else np.zeros(0, bool)
        for s, e in zip(begin[enough].tolist(), end[enough].tolist()):
            spans, found = self.hits(numbers[s:e].tolist())
            if spans:
                d = int(np.searchsorted(ends, s, side="right"))
                shift = s - (int(ends[d - 1]) if d else 0)
                out[d][0].extend((a + shift, b + shift) for a, b in spans)
                out[d][1].update(found)
        return out


def _always_unknown() -> Iterator[int]:
    while True:
        yield -1


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS, window: int = WINDOW) -> Iterator[list]:
    """Items in lists of at most ``block_words`` words (or one part of a long item) each.

    Only one block is held at a time. A part of a long item starts ``window - 1``
    words before the last one ended.
    """
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    block: list[tuple[str | None, list[bytes]]] = []
    size = 0
    for row in rows.where("text is not null").distinct().toLocalIterator():
        words = words_of(row["text"].encode())
        for at in range(0, max(1, len(words) - window + 1), max(1, block_words - window + 1)):
            part = words[at : at + block_words]
            if size and size + len(part) > block_words:
                yield block
                block, size = [], 0
            if part:
                block.append((row["item_id"], part))
                size += len(part)
    if block:
        yield block


HITS = "n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>"


def _stream(rows: DataFrame, automaton: Automaton) -> DataFrame:
    """Adds one block's hits to the columns ``n_words``, ``spans`` and ``items``."""
    state = {k: v for k, v in automaton.__dict__.items()}
    shared = rows.sparkSession.sparkContext.broadcast(state)
    others = [c for c in rows.columns if c not in ("n_words", "spans", "items")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Automaton.__new__(Automaton)
        held.__dict__.update(shared.value)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for whole in batches:
            for b in slices(whole):
                words = [words_of(t) for t in utf8_texts(b)]
                spans_before, items_before = b.column("spans").to_pylist(), b.column("items").to_pylist()
                spans, items = [], []
                for (s, names), old, named in zip(held.find(words), spans_before, items_before):
                    s = merged([*s, *((x["start"], x["end"]) for x in old)])
                    spans.append([{"start": a, "end": e} for a, e in s])
                    items.append(sorted(names.union(named)))
                columns = [b.column(c) for c in others]
                columns += [pa.array([len(w) for w in words], pa.int64()), pa.array(spans, kind)]
                columns += [pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, [*others, "n_words", "spans", "items"])

    return rows.mapInArrow(run, rows.schema)


def find_hits(rows: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``rows`` (with a ``text``) and their n_words, hit spans of words, and sorted item ids."""
    rows = rows.select(
        "*",
        F.lit(0).cast("bigint").alias("n_words"),
        F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    out, n = None, 0
    for block in blocks(benchmark, block_words):
        # Each further block starts from the stored hits of those before it.
        out = _stream(rows if out is None else stored(out, "hits"), Automaton(block))
        n += 1
    return out if n else _stream(rows, Automaton([]))


def contamination(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of each row."""
    hits = find_hits(doc_columns(docs), benchmark, block_words)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    spaced = text.translate(WORD_BYTES)
    where, at = [], 0
    for w in spaced.split():
        at = spaced.index(w, at)
        where.append((at, at + len(w)))
        at += len(w)
    out, done = [], 0
    for first, last in spans:
        out.append(text[done : where[first][0]])
        done = where[last - 1][1]
    return b"".join(out) + text[done:]


def clean(docs: DataFrame, benchmark: DataFrame, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """``docs`` without hit spans; documents hit beyond ``max_coverage`` are dropped.

    Untouched documents keep every column as it was. In a cut document the
    column ``n_chars``, where there is one, counts the text that is left.
    """
    rows = whole_rows(docs).drop("id").withColumn("text", F.col("row.text").cast("string"))
    found = find_hits(rows, benchmark)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    found = found.where(hit <= F.lit(max_coverage) * F.col("n_words")).select("row", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left = [
                without_spans(t or b"", [(s["start"], s["end"]) for s in own]).decode() if own else None
                for t, own in zip(utf8_texts(b), b.column("spans").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(left, pa.string())], ["row", "left"])

    cut = found.mapInArrow(run, found.select("row").schema.add("left", "string"))
    changed = {"text": F.col("left")} | ({"n_chars": F.length("left")} if "n_chars" in docs.columns else {})
    columns = []
    for c in docs.columns:
        own = F.col("row").getField(c)
        new = F.when(F.col("left").isNotNull(), changed[c]).otherwise(own) if c in changed else own
        columns.append(new.cast(docs.schema[c].dataType).alias(c))
    return cut.select(*columns)
