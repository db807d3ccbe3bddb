"""Operator 1: language identification with bit-sliced n-gram Bloom filters.

One Bloom filter per language, all sliced into one table: entry i holds a bit
per language, so the AND of an n-gram's entries is the set of languages that
contain it.  A text's score for a language is the number of its n-grams whose
set has that language, corrected for the hits that the filter's fill gives by
chance; the largest share decides.

An n-gram belongs to a language when it occurs ``min_count`` times in its
sample and at least ``min_share`` times as often as in the language that uses
it most, so a few mislabelled texts do not spread a language's n-grams.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mix64, save, seeds

ORDER = 4
ENTRIES = 1 << 20
HASHES = 2
PER_LANGUAGE = 2000
WORD_BITS = 62
_NO_LETTER = re.compile(r"[\W\d_]+")
_FACTORS = seeds(ORDER, 41) | np.uint64(1)
_PIECE = 1 << 20
COUNT_AT = 1 << 20


def grams(text: str) -> np.ndarray:
    """64-bit hashes of all n-grams of the text's letters (lower case, anything
    else one space); empty when it has no letter."""
    letters = _NO_LETTER.sub(" ", text.lower()).strip()
    if not any(map(str.isalpha, letters)):          # other number signs, as in "²³ ½", are no letters
        return np.zeros(0, dtype=np.uint64)
    c = np.frombuffer(f" {letters}  ".encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    n = c.size - ORDER + 1
    with np.errstate(over="ignore"):
        h = c[:n] * _FACTORS[0]
        for k in range(1, ORDER):
            h += c[k:k + n] * _FACTORS[k]
    return mix64(h)


def entries(h: np.ndarray) -> list[np.ndarray]:
    """The entries of each n-gram in the sliced table."""
    return [((h >> np.uint64(21 * k)) & np.uint64(ENTRIES - 1)).astype(np.int64) for k in range(HASHES)]


@dataclass
class LanguageFilters:
    """``languages`` in code point order; ``slices[w][i]``: bits of languages
    62 w .. 62 w + 61 at entry i."""
    languages: list[str]
    slices: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self):
        set_bits = [np.count_nonzero(self.slices[k // WORD_BITS] >> (k % WORD_BITS) & 1)
                    for k in range(len(self.languages))]
        self.chance = (np.array(set_bits) / ENTRIES) ** HASHES

    def counts(self, h: np.ndarray) -> np.ndarray:
        """Per language: n-grams of ``h`` whose language set has it."""
        at, out = entries(h), []
        for w, table in enumerate(self.slices):
            both = table[at[0]]
            for a in at[1:]:
                both = both & table[a]
            width = min(WORD_BITS, len(self.languages) - w * WORD_BITS)
            if width <= 8:
                seen = np.bincount(both, minlength=1 << width)
                bits = np.arange(seen.size)
                out += [int(seen[bits >> k & 1 == 1].sum()) for k in range(width)]
            else:
                out += [int((both >> k & 1).sum()) for k in range(width)]
        return np.array(out, dtype=np.float64)

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language or 'und', share of n-grams that are the language's)."""
        if not text:
            return "und", 0.0
        total, hits = 0, np.zeros(len(self.languages))
        for at in range(0, len(text), _PIECE):
            h = grams(text[at:at + _PIECE])
            total += h.size
            if h.size and self.languages:
                hits += self.counts(h)
        if not total or not self.languages:
            return "und", 0.0
        real = (hits - total * self.chance) / np.maximum(1e-9, 1 - self.chance)
        best = int(real.argmax())
        return self.languages[best], float(min(1.0, max(0.0, real[best] / total)))


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4 (null id: no)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = PER_LANGUAGE, min_count: int = 3, min_share: float = 0.25) -> LanguageFilters:
    """Learn from rows that are not held out and have a language and an id.

    ``per_language`` bounds the sample (rows with the smallest hash of their
    id); the table that comes back has at most ``ENTRIES`` entries.
    """
    labelled = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    pick = Window.partitionBy("lang").orderBy("h", "id")
    sample = (labelled.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"),
                              F.xxhash64(F.lit(3), F.col(id_col)).alias("h"))
              .withColumn("k", F.row_number().over(pick)).where(F.col("k") <= per_language)
              .select("id", "lang").distinct())
    texts = (labelled.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
             .where(F.col("text").isNotNull())
             .join(F.broadcast(sample), ["id", "lang"], "left_semi").select("lang", "text"))

    def count(batches):
        def counted(lang, parts):
            gram, n = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * gram.size), pa.array(gram.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])

        for b in batches:
            by_lang: dict[str, list[np.ndarray]] = {}
            size: dict[str, int] = {}
            for lang, text in zip(b.column(0), b.column(1)):
                lang, found = lang.as_py(), grams(text.as_py())
                by_lang.setdefault(lang, []).append(found)
                size[lang] = size.get(lang, 0) + found.size
                if size[lang] >= COUNT_AT:           # sums are added up later: no batch's n-grams are held at once
                    yield counted(lang, by_lang.pop(lang))
                    del size[lang]
            for lang, parts in by_lang.items():
                yield counted(lang, parts)

    counted = texts.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counted = save(counted, "lang-grams")
    totals = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    slices = [np.zeros(ENTRIES, dtype=np.int64) for _ in range(-(-len(languages) // WORD_BITS))]
    if languages:
        known = docs.sparkSession.createDataFrame(
            [(lang, k, float(totals[lang])) for k, lang in enumerate(languages)], "lang string, no int, total double")
        rated = counted.join(F.broadcast(known), "lang").withColumn("rate", F.col("n") / F.col("total"))
        top = rated.groupBy("gram").agg(F.max("rate").alias("top"))
        own = (rated.join(top, "gram").where((F.col("n") >= min_count) & (F.col("rate") >= min_share * F.col("top")))
               .select("gram", "no"))

        def place(batches):
            for b in batches:
                h = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                no = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
                for at in entries(h):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(at), pa.array((no // WORD_BITS).astype(np.int32)), pa.array(1 << (no % WORD_BITS))],
                        ["entry", "word", "bits"])

        filled = (own.mapInArrow(place, "entry long, word int, bits long")
                  .groupBy("entry", "word").agg(F.bit_or("bits").alias("bits")).toPandas())
        for w, part in filled.groupby("word"):
            slices[w][part["entry"].to_numpy()] = part["bits"].to_numpy()
    return LanguageFilters(languages, slices)


def identify(docs: DataFrame, model: LanguageFilters, id_col: str = "doc_id", text_col: str = "text",
             keep: tuple[str, ...] = ()) -> DataFrame:
    """Row per input row: id, held_out, lang_pred, score (and the ``keep`` columns).

    The prediction uses the text alone.  Null texts and texts without a letter
    are 'und' with score 0, as is everything when nothing was learned; equal
    scores go to the first language by code point.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for some in texts:
            found = [shared.value.predict(t.as_py()) for t in some]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["lang_pred", "score"])

    # only the text goes to the Python worker and only the prediction comes back; the rows wait in the JVM
    plain = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), predict(F.col(text_col)).alias("found"),
                        *[F.col(c).alias(f"keep_{c}") for c in keep])
    return plain.select(F.col(id_col), "held_out", "found.lang_pred", "found.score",
                        *[F.col(f"keep_{c}").alias(c) for c in keep])
