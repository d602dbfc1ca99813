"""From raw documents to token ids: five stages, each of which works on all that the one before kept.

Each stage function takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next stage's docs. All but the last return the columns of documents, and other columns where there are any. Null texts go
in the first stage; rows without an id are kept by the stages that tell documents apart by it; repeated rows that the join
keeps stay repeated; an empty table stays empty. A stage's written table goes when the next one is whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veridata.llm import decontaminate, lang_id, ngram_join, piece_codec, pii
from veridata.llm._common import drop_folder, load, shared_folder
from veridata.llm.queries import tokenizer_path


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language identification: texts of no learnt language go (noise, unknown languages, no letters, null)."""
    return lang_id.keep_identified(docs)


def join_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of near copies the smallest doc_id stays."""
    return ngram_join.keep_one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a test item go."""
    return decontaminate.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; every document stays."""
    return pii.redact_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and digests of them and of what they decode to."""
    return piece_codec.encode_report(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("language ID", identify),
    ("n-gram Jaccard join", join_near),
    ("benchmark decontamination", decontaminated),
    ("PII", without_pii),
    ("SentencePiece", encode),
]

#: Language ID by cross-parsing and the piece encoding can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the session's shared folder and read again."""
    docs, before = load(spark, sf_dir, "documents"), None
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            folder = shared_folder(spark, f"stage{i}")
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
            if before:
                drop_folder(spark, before)
            before = folder
    return docs
