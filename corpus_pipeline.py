"""From raw documents to packed token sequences.

1. quality: a factorisation machine scores every document; those under a half go.
2. near_duplicates: of each component of texts with a similarity of 0.8 or more over
   five-word shingles one document stays.
3. decontaminate: documents into which a benchmark item leaks go.
4. pack: the rest as token sequences.

In every stage null texts count as empty ones, null ids are ids like others, repeated rows
are judged each (the second one lets one of them stay), texts of any length are read whole,
and an empty table gives an empty one.  The first three return the columns they were given,
whatever their names.
"""

from __future__ import annotations

from tristrata.llm import decontaminate, near, packing, quality
from tristrata.llm.storage import stored


def filter_quality(spark, docs, sf_dir):
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark, docs, sf_dir):
    return near.one_of_each(docs)


def drop_leaks(spark, docs, sf_dir):
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark, docs, sf_dir):
    return packing.packed_sequences(docs)


STAGES = [
    ("quality", filter_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_leaks),
    ("pack", pack_sequences),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``, each written before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
