"""Corpus pipeline: four stages, each one of the corpus operators.

``run`` applies them to ``documents`` in turn; every stage's result is
written as Parquet under the checkpoint folder and read again as the next
stage's documents. All but the last return the columns of documents. A stage
begins by dropping what the pipeline's stages staged before it (and nothing
else), so their results must have been written by then; ``run`` also drops a
stage's result when the next one is written, and keeps the last.

Defined cases, for every stage: a null or empty text is not toxic by itself
(it gets the score of no features), fails the base rules (fewer than ten
words), would stay as no one's duplicate and gives one piece with the end id;
rows with null or repeated ids are judged row by row, and unlike texts under
one id are different documents; ties and repeated rows are settled as the
operators' docstrings say; very long texts are judged whole; an empty table
gives an empty result; further columns are kept, whatever their names, until
packing returns its own.
"""

from __future__ import annotations

import public_tokenizers

from scorewatch.llm.common import table
from scorewatch.llm.jaccard import keep_one
from scorewatch.llm.packing import pack_documents
from scorewatch.llm.quality import keep_good
from scorewatch.llm.toxicity import drop_toxic
from scorewatch.plans.staging import Scope, stage

_STAGE_TABLES = Scope()


def toxicity(spark, docs, sf_dir):
    """Drop documents that the classifier calls toxic."""
    with _STAGE_TABLES.begin(spark):
        return drop_toxic(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def quality_rules(spark, docs, sf_dir):
    """Drop documents that fail the base rules or lie outside their language's perplexity band."""
    with _STAGE_TABLES.begin(spark):
        return keep_good(docs)


def near_duplicates(spark, docs, sf_dir):
    """Keep one document of each group linked by five-word shingles at Jaccard similarity 0.8 or more."""
    with _STAGE_TABLES.begin(spark):
        return keep_one(docs, width=5, num=80, den=100)


def packing(spark, docs, sf_dir):
    """Pack the remaining documents' tokens into windows of 2048."""
    with _STAGE_TABLES.begin(spark):
        return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [("toxicity", toxicity), ("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("packing", packing)]

#: No SQL: a trained classifier, a language model and a tokeniser decide.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows for the documents of ``sf_dir``."""
    docs, held = table(spark, sf_dir, "documents"), Scope()
    for name, step in STAGES:
        result, now = step(spark, docs, sf_dir), Scope()
        with now.begin(spark):
            docs = stage(result, f"pipeline-{name}")
        held.drop(spark)                # the result before this one
        held = now
    return docs
