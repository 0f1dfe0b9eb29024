"""From raw documents to a token file: toxicity, SimHash near-duplicates,
benchmark decontamination, source mixing, bit-packed token output.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes each result as Parquet in the shared folder and reads it
back, so a lost executor costs at most the stage that was running.  All stages
but the last return the columns of documents; an empty input passes through.
Texts count whole at any length, null and extra columns are carried along, and
repeated rows are judged each by the same rule; what a stage does with them stands
at the stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyfare.llm import decontam, mixing, packing, simhash, toxicity
from skyfare.llm.common import Workspace, read
from skyfare.llm.queries import word_bpe


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the toxicity threshold.  Null and empty texts score the
    classifier's intercept; repeated rows stay or go together; a score equal to the threshold goes."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"), Workspace(spark, "toxicity"))


def dedupe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: the smallest id, nulls last, then the lowest
    hash of the text; of rows that repeat both, one.  Null and empty texts are one group."""
    return simhash.drop_near_duplicates(docs, Workspace(spark, "simhash"),
                                        simhash.SimHash(words=4, max_distance=4))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified benchmark overlap.  Null and empty texts stay, so does
    everything if the benchmark is empty; repeated rows stay or go together."""
    return decontam.remove_contaminated(docs, read(spark, sf_dir, "benchmark"),
                                        Workspace(spark, "decontaminate"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the token budget of their source.  A null language or source is a node
    of its own, a null text has no tokens, a null id is ordered by its text; rows that repeat an
    id stand or fall together."""
    return mixing.mix_documents(docs, Workspace(spark, "mix"), mixing.Mix(max_epochs=1))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token file in ascending id order, nulls first, repeated ids by the hash of
    their text.  A null or empty text is the end id alone."""
    path = Workspace(spark, "tokens").path("file")
    packing.write_tokens(docs, path, packing.Packing(word_bpe()))
    return packing.document_digests(spark, path)


STAGES = [("toxicity", clean), ("near_duplicates", dedupe), ("decontamination", decontaminate),
          ("mixing", mix), ("token_output", tokens)]

#: Trained weights, fingerprints and tokens have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = ws.table(stage(spark, docs, sf_dir), f"{i}_{name}")
    return docs
