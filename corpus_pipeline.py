"""From raw documents to packed training sequences: five stages, each written and read again."""

from pyspark.sql import functions as F

from forkline.llm import hyperminhash, packing, pii, quality, substring
from forkline.llm.common import table, written
from forkline.llm.queries import tokenizer

#: The packing has no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def quality_rules(spark, docs, sf_dir):
    """Failing lines go, then documents that fail the base rule or lost too much."""
    return quality.clean(docs)


def near_dedup(spark, docs, sf_dir):
    """One document of each group stays: the one with the smallest doc_id."""
    return hyperminhash.keep_one(docs)


def substring_dedup(spark, docs, sf_dir):
    """Words of passages that occur again go; untouched documents keep their text as it is."""
    return substring.clean(docs)


def redact_pii(spark, docs, sf_dir):
    """Personal data give way to their kind in angle brackets."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def pack(spark, docs, sf_dir):
    """Token sequences of at most 1024."""
    return packing.pack(docs, tokenizer())


STAGES = [("quality rules", quality_rules), ("near dedup", near_dedup), ("substring dedup", substring_dedup),
          ("pii", redact_pii), ("packing", pack)]


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
