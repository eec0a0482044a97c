"""Language identification by language-bitmask n-gram filters.

Learning counts the letter trigrams of a bounded sample of labelled texts per
language: pieces of texts, equal texts taken once, drawn by hash at the rate
that gives the sample, so one long text is drawn in parts and copies weigh no more. A language contains a trigram when the trigram's rate in it is at
least ``MIN_RATE`` and at least ``MIN_SHARE`` of its highest rate in any
language, so stray foreign passages teach nothing. All languages share one
bit-sliced Bloom filter: every slot holds one bit per language, and the
bitwise AND of a trigram's slots returns all languages containing it at once.

A document's trigrams are counted per language bit. The filter's rate of false
positives is known per language (its share of set slots to the power of the
number of slots read), so each popcount is corrected before the largest wins.

Null texts and texts without a letter are ``und`` with score 0. Ties go to the
language that sorts first. Whole texts of any length count. Repeated rows and
null ids are judged row by row, an empty table gives no rows and teaches no
language, and columns other than ``doc_id``, ``text`` and, to learn, ``lang`` are
not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import doc_columns, slices, stored, text_crc, texts, whole_rows

UNDETERMINED = "und"
#: Characters learned per language: pieces of distinct texts are drawn by hash at the rate that gives so many.
SAMPLE_CHARS = 3_000_000
#: Characters of a piece.
PIECE_CHARS = 10_000
MIN_RATE = 1e-5
MIN_SHARE = 0.2
SLOTS = 1 << 18
READS = 3
#: Below this share of contained trigrams a document is in no learned language.
REJECT_BELOW = 0.35

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


_TABLES: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """Which code points are letters; made once per process."""
    if "letters" not in _TABLES:
        _TABLES["letters"] = np.array([chr(i).isalpha() for i in range(0x110000)])
    return _TABLES["letters"]


def trigrams(docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the trigrams around each letter, in order, and where each document's begin.

    Text is lower-cased; what is no letter counts as one space at a word's edge.
    """
    low = [t.lower() for t in docs]
    codes = np.frombuffer((" " + " ".join(low) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    ends = np.cumsum([len(t) + 1 for t in low])
    starts = np.concatenate([[0], np.cumsum(letter)[ends]])
    codes = np.where(letter, codes, 32).astype(np.uint64)
    at = np.flatnonzero(letter)
    grams = codes[at - 1] * _MIX[0] ^ (codes[at] * _MIX[1] + (codes[at + 1] * _MIX[2]))
    grams ^= grams >> np.uint64(32)
    grams *= _MIX[0]
    return grams ^ (grams >> np.uint64(29)), starts


def slot(grams: np.ndarray, i: int) -> np.ndarray:
    """The ``i``-th slot that a trigram reads: 18 bits of its hash."""
    return ((grams >> np.uint64(18 * i)) & np.uint64(SLOTS - 1)).astype(np.int64)


@dataclass
class LanguageFilter:
    """Languages in sorted order and the bit-sliced filter, one 64-bit word per 64 languages."""

    languages: list[str]
    bits: np.ndarray

    @classmethod
    def of(cls, languages: list[str], grams: np.ndarray, language: np.ndarray) -> LanguageFilter:
        bits = np.zeros((max(1, -(-len(languages) // 64)), SLOTS), np.uint64)
        for i in range(READS):
            at = slot(grams, i)
            for word in range(len(bits)):
                own = language // 64 == word
                flags = np.uint64(1) << (language[own] % 64).astype(np.uint64)
                np.bitwise_or.at(bits[word], at[own], flags)
        return cls(languages, bits)

    def false_positives(self) -> np.ndarray:
        set_slots = [
            ((self.bits[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(self.languages))
        ]
        return np.array(set_slots) ** READS

    def predict(self, docs: list[str]) -> tuple[list[str], list[float]]:
        """The language of each text and the corrected share of its trigrams there."""
        grams, starts = trigrams(docs)
        total = np.diff(starts).astype(float)
        counts = np.zeros((len(self.languages), len(docs)))
        for word, slots in enumerate(self.bits):
            found = slots[slot(grams, 0)]
            for i in range(1, READS):
                found &= slots[slot(grams, i)]
            for i in range(64 * word, min(64 * word + 64, len(self.languages))):
                bit = ((found >> np.uint64(i % 64)) & np.uint64(1)).astype(np.int64)
                counts[i] = np.diff(np.concatenate([[0], np.cumsum(bit)])[starts])
        wrong = self.false_positives()[:, None]
        corrected = np.maximum(0.0, (counts - total * wrong) / np.maximum(1e-9, 1 - wrong))
        best = corrected.argmax(axis=0) if self.languages else np.zeros(len(docs), int)
        names, scores = [], []
        for d, n in enumerate(total):
            if not n or not self.languages:
                names.append(UNDETERMINED)
                scores.append(0.0)
            else:
                names.append(self.languages[best[d]])
                scores.append(float(min(1.0, corrected[best[d], d] / n)))
        return names, scores


def held_out(name: str = "doc_id") -> Column:
    """Documents kept from learning: crc32 of the id as text, modulo 4, is 2."""
    return F.pmod(text_crc(name), F.lit(4)) == 2


def sample(known: DataFrame, sample_chars: int = SAMPLE_CHARS) -> tuple[list[str], DataFrame]:
    """All languages of ``known`` (lang, text), and lang and text of the pieces to learn from."""
    # One-element arrays are exploded so that a text is hashed once, not for each of its pieces.
    facts = F.struct(F.xxhash64("text").alias("hash"), F.length("text").alias("n"))
    rows = known.select("lang", "text", F.explode(F.array(facts)).alias("f")).select("lang", "text", "f.hash", "f.n")
    once = known.groupBy("lang", F.xxhash64("text").alias("hash")).agg(F.max(F.length("text")).alias("n"))
    sizes = {r["lang"]: r["n"] for r in once.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not sizes:
        return [], known
    rate = F.create_map(*[F.lit(x) for k in sorted(sizes) for x in (k, min(1.0, sample_chars / max(1, sizes[k])))])
    size = F.lit(PIECE_CHARS)
    last = F.greatest(F.ceil(F.col("n") / size), F.lit(1)).cast("int") - 1
    drawn = F.filter(
        F.sequence(F.lit(0), last),
        lambda i: F.pmod(F.xxhash64("hash", i), F.lit(1 << 30)) / float(1 << 30) < rate[F.col("lang")],
    )
    cut = F.transform(drawn, lambda i: F.struct(i.alias("piece"), F.substring(F.col("text"), i * size + 1, size).alias("text")))
    parts = rows.select("lang", "hash", F.explode(cut).alias("p")).select("lang", "hash", "p.piece", "p.text")
    return sorted(sizes), parts.distinct().select("lang", "text")


def learn(docs: DataFrame, sample_chars: int = SAMPLE_CHARS) -> LanguageFilter:
    """Learn from text and non-null ``lang`` of documents that are not held out.

    What reaches the driver is bounded: at most 1 / MIN_RATE trigrams a language.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )
    languages, drawn = sample(known, sample_chars)
    if not languages:
        return LanguageFilter([], np.zeros((1, SLOTS), np.uint64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole):
                lang = np.array(b.column("lang").to_pylist())
                grams, starts = trigrams(texts(b))
                owner = np.repeat(np.arange(len(lang)), np.diff(starts))
                for name in sorted(set(lang)):
                    own, n = np.unique(grams[(lang == name)[owner]], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(own), pa.string()), pa.array(own.view(np.int64)), pa.array(n)],
                        ["lang", "gram", "n"],
                    )

    counted = drawn.mapInArrow(count, "lang string, gram bigint, n bigint")
    counted = stored(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "trigrams")
    totals = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return LanguageFilter(languages, np.zeros((-(-len(languages) // 64), SLOTS), np.uint64))
    total = F.create_map(*[F.lit(x) for k in sorted(totals) for x in (k, totals[k])])
    rated = counted.select("lang", "gram", (F.col("n") / total[F.col("lang")]).alias("rate"))
    top = rated.groupBy("gram").agg(
        F.max("rate").alias("top"), F.collect_list(F.struct("lang", "rate")).alias("all")
    )
    contained = (
        top.select("gram", "top", F.explode("all").alias("own"))
        .where((F.col("own.rate") >= MIN_RATE) & (F.col("own.rate") >= MIN_SHARE * F.col("top")))
        .select("gram", F.col("own.lang").alias("lang"))
        .toPandas()
    )
    index = {k: i for i, k in enumerate(languages)}
    language = contained["lang"].map(index).to_numpy(np.int64, na_value=0)
    return LanguageFilter.of(languages, contained["gram"].to_numpy(np.int64).view(np.uint64), language)


def predict(docs: DataFrame, learned: LanguageFilter) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row."""
    shared = docs.sparkSession.sparkContext.broadcast((learned.languages, learned.bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = LanguageFilter(*shared.value)
        for whole in batches:
            for b in slices(whole):
                names, scores = known.predict(texts(b))
                kept = [b.column("doc_id"), b.column("held_out"), pa.array(names, pa.string()), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(kept, ["doc_id", "held_out", "lang_pred", "score"])

    asked = doc_columns(docs).withColumn("held_out", held_out())
    return asked.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def in_learned_language(docs: DataFrame, learned: LanguageFilter, below: float = REJECT_BELOW) -> DataFrame:
    """The rows whose text is in a learned language, all columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast((learned.languages, learned.bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = LanguageFilter(*shared.value)
        for whole in batches:
            for b in slices(whole):
                names, scores = known.predict(texts(b))
                keep = [n != UNDETERMINED and s >= below for n, s in zip(names, scores)]
                yield pa.RecordBatch.from_arrays([b.column("row")], ["row"]).filter(pa.array(keep, pa.bool_()))

    rows = whole_rows(docs).drop("id").withColumn("text", F.col("row.text").cast("string"))
    return rows.mapInArrow(run, rows.drop("text").schema).select("row.*")
