"""From raw documents to a tokenised training mix.

``STAGES`` are applied in order; each is written as Parquet and read again as
the next one's documents.  All but the last return the columns of ``documents``.

1. language ID: documents without a letter, or of which less than
   ``LEAST_SCORE`` of the n-grams belong to any learned language, go.
2. line dedup: repeated runs of two lines or more are removed from the texts; a document
   of which nothing but white space is left goes.
3. MinHash near-dedup (five-word shingles, similarity 0.8): one document of
   each group stays.
4. mixing: sources are taken to their target weights; a document appears once
   for each pass that takes words of it, cut where the pass ends.  Rows are
   written in the order of the mix: by the first slot of their pass.
5. BPE: token ids, and digests of the ids and of the decoded text.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadcast.llm.bpe import tokenize
from roadcast.llm.common import load, row_key, save
from roadcast.llm.language import fit, identify
from roadcast.llm.line_chunks import line_dedup
from roadcast.llm.minhash import near_duplicates
from roadcast.llm.mixing import mix

LEAST_SCORE = 0.2
CORE = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = "word_bpe_49k.json"
ORACLE_SQL = None       # language scores, components and the schedule are beyond SQL; see tests/llm/test_pipeline.py


def _stage(f):
    """Other columns of documents go through under neutral names, so none can
    clash with what the operators add."""
    @functools.wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        plain = [c if c in CORE else f"extra_{i}" for i, c in enumerate(docs.columns)]
        return f(spark, docs.toDF(*plain), sf_dir).toDF(*docs.columns)
    return run_stage


@_stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = identify(docs, fit(docs), keep=tuple(c for c in docs.columns if c != "doc_id"))
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


@_stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    cleaned = line_dedup(docs, keep=others, runs=True)
    return (cleaned.where((F.col("n_chunks") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
            .withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns))


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    stay = near_duplicates(docs).where("stays").select("k1", "k2").distinct()
    one = Window.partitionBy("k1", "k2").orderBy("source", "lang")
    return (docs.select("*", *row_key("doc_id", "text")).join(stay, ["k1", "k2"])
            .withColumn("copy", F.row_number().over(one)).where("copy = 1").select(*docs.columns))


def _first_words(text: str, n: str) -> Column:
    """The text up to the end of its n-th word, by Spark's own functions: no text
    goes through a Python worker.  White space stays as it is: it is only looked
    at in a copy of equal length with spaces alone."""
    parts = F.split(F.translate(text, "\t\n\x0b\x0c\r", " " * 5), " ", -1)
    words = F.filter(F.transform(parts, lambda p, i: F.when(p != "", i)), lambda i: i.isNotNull())
    last = F.get(words, F.least(F.col(n), F.size(words)) - 1)
    return F.substring(F.col(text), F.lit(1), F.length(F.array_join(F.slice(parts, F.lit(1), last.cast("int") + 1), " ")))


@_stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # near-dedup left one row per key, so the mix's rows join back one to one
    keyed = docs.select("*", *row_key("doc_id", "text"))
    taken = save(mix(keyed, keep=("k1", "k2")).where("taken > 0").select("k1", "k2", "size", "first", "second", "places"), "mix-taken")
    early, late = (F.get(F.filter("places", lambda p: (p["turn"] == 0) == F.lit(x)), F.lit(0)) for x in (True, False))
    passes = F.filter(F.array(*[F.struct(F.col(w).alias("words"), p["at"].alias("at"), p["from"].alias("from"))
                                for w, p in (("first", early), ("second", late))]), lambda p: p["words"] > 0)
    taken = taken.select("k1", "k2", "size", passes.alias("passes"))
    rows = keyed.join(taken, ["k1", "k2"]).withColumn("mix", F.explode("passes"))
    cut = F.when(F.col("mix.words") < F.col("size"), _first_words("text", "mix.words")).otherwise(F.col("text"))
    rows = rows.select(*[cut.alias(c) if c == "text" else F.col(c) for c in docs.columns], "mix")     # cut before rows move
    order = ("mix.at", "mix.from", "source")       # late slots of several sources share a place
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("mix")
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokenize(docs, public_tokenizers.path(TOKENIZER), with_ids=True)


STAGES = [("language_id", language_id), ("line_dedup", lines), ("near_dedup", near_dedup), ("mixing", mixture), ("bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
