"""The corpus pipeline: documents in, the mix of a training corpus out.

Toxic documents go; of each group of near copies the one with the smallest id
stays; documents contaminated by the benchmark go; what is left is mixed to the
target weights of its sources. Every stage reads the table the one before has
written.
"""

from pagewell.llm import decontamination, jaccard, mixing, toxicity
from pagewell.llm.common import written


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxic_stage(spark, docs, sf_dir):
    """The documents that the trees do not reject. Labels of documents that are not given are not used."""
    return toxicity.drop_toxic(docs, _table(spark, sf_dir, "labels"))


def near_copy_stage(spark, docs, sf_dir):
    """One document of each group of near copies."""
    return jaccard.keep_one_of_each(docs)


def decontamination_stage(spark, docs, sf_dir):
    """The documents that are not contaminated by the benchmark."""
    return decontamination.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mixing_stage(spark, docs, sf_dir):
    """The documents of the mix, and ``mix_words``: how many words of each it takes."""
    return mixing.draw_mix(docs)


STAGES = [
    ("toxicity", toxic_stage),
    ("ngram_jaccard_join", near_copy_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("weighted_fair_mixing", mixing_stage),
]

# The first stage is a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each is written as Parquet and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
