"""The corpus pipeline: stages over documents, each written as Parquet and reread as the next one's input.

quality_rules drops documents that fail a rule; exact_dedup and simhash_near_dedup keep one document of each group (the
latter by three-word shingles and at most two different bits); mixing draws documents by source weight (a document can be
drawn more than once); packing deals them to windows. All but the last return the columns of documents.

Each stage is to be written and reread before the next one is called, as ``run`` does: a stage deletes the tables that the
one before it has written beside its result.

Null texts count as empty and null ids lose against ids in every stage; what else a stage does with nulls, repeats and
long texts is its operator's docstring. No documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordermart.llm.exact import exact_dedup
from ordermart.llm.frames import Scratch
from ordermart.llm.mixing import mixed
from ordermart.llm.packing import pack
from ordermart.llm.rules import quality_rules
from ordermart.llm.simhash import simhash_dedup

# What the last stage has written beside its result, by application.
_beside: dict[str, Scratch] = {}


def _stage(name: str, apply):
    """A stage whose scratch tables go when the next one starts: by then its result has been written and reread."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        if app in _beside:
            _beside.pop(app).clear()
        _beside[app] = Scratch(spark)
        return apply(docs, _beside[app])

    return name, run_stage


STAGES = [
    _stage("quality_rules", lambda docs, scratch: quality_rules(docs)),
    _stage("exact_dedup", lambda docs, scratch: exact_dedup(docs, scratch=scratch)),
    _stage("simhash_near_dedup", lambda docs, scratch: simhash_dedup(docs, scratch=scratch)),
    _stage("mixing", lambda docs, scratch: mixed(docs, scratch=scratch)),
    _stage("packing", lambda docs, scratch: pack(docs)),
]
# Fingerprints and token ids are beyond SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.write(docs, name)
    return docs
