"""Documents to packed training sequences, a stage at a time; each stage is written and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but the last return the
columns of documents. Null texts count as empty (the first stage rejects them), columns beyond those of documents are
left out, repeated rows are judged one by one until near-duplicates are reduced to one, and no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.llm import common, line_dedup, mixing, packing, quality_rules, simhash, tokens

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
CARRY = ("lang", "source", "n_chars")


def keep_good(spark, docs, sf_dir):
    """Quality rules: documents that a base rule or the likelihood ratio rejects go, null and empty texts among them."""
    labels = common.table(spark, sf_dir, "labels")
    return quality_rules.kept_documents(docs, labels, CARRY).select(*DOCUMENT)


def drop_repeated_lines(spark, docs, sf_dir):
    """Line dedup: lines that many documents share stay in one; n_chars follows the text. Documents stay, if empty."""
    rows = line_dedup.line_dedup(docs, carry=("lang", "source"))
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT)


def drop_near_duplicates(spark, docs, sf_dir):
    """SimHash: of each component of near-duplicates the document with the smallest id stays (null only where all are);
    of rows that repeat it one, and empty texts are near-duplicates of each other."""
    return simhash.one_of_each(docs, CARRY).select(*DOCUMENT)


def mix(spark, docs, sf_dir):
    """Mixing: every document as many times as its rate says. Empty texts have a rate too; repeated rows are rounded one by
    one."""
    return mixing.remix(docs, common.table(spark, sf_dir, "labels"), CARRY).select(*DOCUMENT)


def pack(spark, docs, sf_dir):
    """Packing: the pieces of all documents in their sequences. An empty text is its end id; repeated rows and ids are
    documents of their own; a text longer than a sequence runs on through others."""
    return packing.retrieval_packing(docs, tokens.public(packing.TOKENIZER))


STAGES = [
    ("quality rules", keep_good),
    ("line dedup", drop_repeated_lines),
    ("near-duplicates", drop_near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]

#: Learned weights, fingerprints and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
