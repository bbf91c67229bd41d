"""A training corpus from documents: each stage is one of the operators and works on all that the one before has kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from threadloom.llm import common, decontam, mixing, simhash, tokens, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; learnt from the labelled rows that are still there and not held out.

    Null and empty texts score as the bias says and stay where that is below one half; without labels every score is one
    half and every document goes, so a corpus without labels is an error of its own making. Repeated rows score alike."""
    scored = toxicity.toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), keep_text=True)
    return scored.where("predicted = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the smallest doc_id, null ids last; repeated rows are one.

    Fingerprints are of five-word shingles. RADIUS bits are the most that three segments can find, so copies of a
    similarity of 0.8 are found in part only (README gives the share); what is linked is nearly always above it. Null and
    empty texts are one group."""
    return simhash.one_of_each_group(docs, words=5, k=RADIUS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go; null and empty texts hold none, an empty benchmark takes none."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice. Documents without words are taken at their place
    in their source's queue; a null source is a source."""
    return mixing.mixed_documents(docs, mixing.mix(docs))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of token ids, read back: doc_id, start, n_tokens, ids_crc32; a null text is its end id alone."""
    return tokens.tokenised(docs, public_tokenizers.path("word_bpe_49k.json"))


#: Bits in which fingerprints of near copies may differ; 5 takes the same three segments as 4.
RADIUS = 5

STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token ids", write_tokens),
]

#: A learnt score and XXH64 fingerprints have no SQL; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = common.stage(stage(spark, before, sf_dir), name.replace(" ", "-"))
        if i:
            common.unstage(before)  # nothing reads the last stage's input any more
        before = docs
    return docs
