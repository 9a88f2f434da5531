"""Corpus pipeline: language ID, exact dedup, SimHash near-dedup, secret masking, packing.

Each stage takes all documents that the one before it kept, and is written as Parquet in the
shared folder and read again, so the loss of an executor repeats one stage at most.
"""

from __future__ import annotations

from riskloom.llm import exact_dedup, language, packing, secrets, simhash
from riskloom.llm.common import table
from riskloom.session import durable

STAGES = [
    ("language ID", language.stage),
    ("exact dedup", exact_dedup.stage),
    ("SimHash near-dedup", simhash.stage),
    ("secret scan", secrets.stage),
    ("best-fit packing", packing.stage),
]


def run(spark, sf_dir):
    """The packed pieces of the documents that all stages keep."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


# Learned models and the packing can't be written in SQL; the tests compare with brute force.
ORACLE_SQL = None
