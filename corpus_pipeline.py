"""The corpus pipeline: five stages in order, each over all that its predecessor kept.

Every stage takes any columns beside those it works on and returns them as they are, whatever their names; an empty
table gives an empty one.  What a stage does with null, empty and repeated rows is said with it.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``.  ``run`` writes nothing itself: a caller that wants restart points
writes each stage's result and reads it again as the next one's ``docs``.
"""

from __future__ import annotations

from edcohort.llm.common import freeze, read_table
from edcohort.llm.decontaminate import remove_documents
from edcohort.llm.jaccard_join import keep_one_per_component
from edcohort.llm.line_dedup import dedup_lines
from edcohort.llm.packing import pack
from edcohort.llm.quality import keep_good


def quality_rules(spark, docs, sf_dir):
    """Documents that fail the base rules or diverge from their language's references go.

    A null or empty text has no words and fails.  A null or unseen language has no reference: only the base rules judge.
    Repeated rows stay or go together; rows of one id with different texts are judged each on its own."""
    return keep_good(docs)


def line_dedup(spark, docs, sf_dir):
    """Lines on five sites or more stay in one document only; no document is dropped.

    Null texts stay null; a text may become empty.  A null source is no site, but its lines can go.  Repeated rows are one
    document and lose the same lines; of ties for the first place the smallest (id, text hash, line) wins."""
    return dedup_lines(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near copies stays: the one with the smallest (id, text hash), a null id last.

    Texts without words, null ones too, are near to nothing and stay, repeated ones as well as others; of repeated rows with
    words one stays."""
    return keep_one_per_component(docs)


def decontamination(spark, docs, sf_dir):
    """Documents with at least 5 % of their words in benchmark windows go.

    Null and empty texts have no hits and stay; items without words, or with a null text, have no windows; repeated rows
    stay or go together."""
    return remove_documents(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark, docs, sf_dir):
    """Bins of 2048 words without two documents of one source or cluster.

    A text without words, null or empty, has one row with no tokens and bin -1.  Null sources conflict with nothing; repeated rows are
    packed each on its own, in different bins.  The columns are those of ``pack``."""
    return pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: The quality stage and the packing are not expressible in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The bins of all documents that the stages kept.  Each stage's result is frozen in the shared
    checkpoint folder, so that no stage runs twice."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
