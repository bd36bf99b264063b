"""A training corpus in stages, each an operator of ``terraledger.llm``.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)``
and returns what its stage keeps.  All but the last return the columns of
``documents``; the last returns where each piece of each document is packed.

Defined cases, of every stage: repeated rows are judged alike, and the columns of
the documents stay as they are, also where they are called like those that a
stage works with; texts of any length are read whole; a score of exactly 0.5
counts as toxic, or as good; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraledger.llm import minhash, packing, quality, toxicity
from terraledger.llm.common import held_out
from terraledger.sources.lineage import drop_written, written
from terraledger.sources.tables import table


def _judged(docs: DataFrame, score, model, keeps: int) -> DataFrame:
    """The rows of ``docs`` that ``score`` gives the class ``keeps``, with their own columns whatever these are called."""
    taken = {c.lower() for c in docs.columns}
    aside = {}
    for c in docs.columns:
        if c.lower() in ("score", "predicted"):
            name = f"_own_{c}"
            while name.lower() in taken:
                name = f"_{name}"
            taken.add(name.lower())
            aside[c] = name
    kept = score(docs.withColumnsRenamed(aside), model).where(F.col("predicted") == keeps)
    return kept.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose toxicity score is at least 0.5; a null or empty text is scored as one without words."""
    model = toxicity.fit_on(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out(F.col("_id"), 5, 0))
    return _judged(docs, toxicity.score, model, 0)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose quality score is under 0.5; a null or empty text is scored as one without passages."""
    model = quality.fit_on(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out(F.col("_id"), 3, 1))
    return _judged(docs, quality.score, model, 1)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class stays, decided by id and text together; a row whose text is null stays."""
    return minhash.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lays the documents into bins."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("near_dedup", drop_near_copies), ("packing", pack)]

#: Models are trained in the stages, so SQL cannot express the rows; a test holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each but the last is written, since the next ones read its rows several times."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
        if before is not None:
            drop_written(before)  # the next table holds all that is left of it
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
