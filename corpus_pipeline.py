"""A corpus pipeline of five stages: quality rules, language ID, near-duplicates, mixing, tokenising.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's input. All but the last return the columns of documents, under whatever names those have: a stage
works beside the packed row, so no column of its own can clash with one of the input.

Edge cases: documents with a null or empty text fail the base rules and go at the first stage; a null lang, source or id keeps
a document in (a null source mixes as "unknown"; null ids stay last in their group of near-duplicates); repeated rows leave the third
stage once; ties between ids go to the smaller hash of the text; very long texts are worked on whole; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailframe.llm import langid, mixing, quality, sentencepiece, simhash
from tailframe.llm import queries as settings
from tailframe.llm.common import scratch, table, write
from tailframe.storage import new_dir, remove


def _packed(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"), *columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep; null and empty texts go, repeated rows stay."""
    rules = quality.learn_decision_list(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.keeps(docs["text"], rules))


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that is recognised without doubt; those without a letter go, repeated rows stay.

    If nothing can be learned (no row has a lang), no language is known and nothing stays.
    """
    model = langid.train(docs.where(~settings.held_out()))
    return langid.identify(_packed(docs, "text"), model, keep_text=False).where(F.col("lang_pred") != langid.UNKNOWN).where(~F.col("ambiguous")).select("_row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by four fifths or more of all their 5-word shingles in common.

    SimHash fingerprints and their pigeonhole blocks link first, each link checked by its shingles; an exact join finds what fingerprints can't.
    """
    return simhash.one_of_each(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of four fifths of all tokens, by target weights, each document at most once."""
    levels = {n: F.col(f"_{n}") if n != "domain" else c for n, c in settings.mix_levels().items()}
    packed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"), "doc_id", "text", "source", F.col("lang").alias("_lang"), F.col("source").alias("_source"))
    return mixing.select_mixture(packed, levels, settings.MIX_WEIGHTS, max_epochs=1).select("_row.*")


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str, model_path: str = f"{settings.TOKENIZERS}/piece_bpe_32k.model") -> DataFrame:
    """doc_id, lang, source, ids, n_tokens and whether decoding gives the text back."""
    return sentencepiece.encode_and_verify(docs.select("doc_id", "lang", "source", "text"), sentencepiece.load_model(docs, model_path))


STAGES = [
    ("quality rules", keep_good),
    ("language ID", keep_known_language),
    ("SimHash near-dedup", keep_one_of_each),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", tokenise),
]

#: Learned rules and models can't be said in SQL; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in a row. What a stage stages for itself, and its input, are removed once its output is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_dir(spark, name.split(" ")[0].lower())
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            write(out, path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
