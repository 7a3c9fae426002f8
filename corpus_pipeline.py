"""The corpus pipeline: five stages, each one of the training-data operators.

``run(spark, sf_dir)`` applies them to ``documents``. What a stage returns is
written as Parquet to the shared folder and read again as the next one's
documents, so a lost executor repeats tasks of one stage only. All stages but
the last return the columns of ``documents``; the last returns packed rows of
token ids.
"""

from __future__ import annotations

from blotter.llm import decontaminate, mixing, packing, simhash, toxicity
from blotter.llm.common import saved, table


def drop_toxic(spark, docs, sf_dir):
    """Documents that are more likely than not toxic go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark, docs, sf_dir):
    """Of the documents that SimHash links, the one with the smallest id stays."""
    return simhash.first_of_each(docs)


def drop_benchmark(spark, docs, sf_dir):
    """Spans that occur in a test item go, and documents that are mostly such
    spans."""
    return decontaminate.cleaned(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark, docs, sf_dir):
    """Each document as often as its source's target asks for."""
    return mixing.repeated(docs)


def pack_tokens(spark, docs, sf_dir):
    """Packed rows of token ids, with segment lengths and positions."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("source_mixing", mix_sources),
    ("token_packing", pack_tokens),
]

#: A trained classifier, a suffix automaton and a tokenizer: no SQL. The tests
#: hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
