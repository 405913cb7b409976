"""A training corpus from `documents`, in five stages, each written and read again.

toxicity (rejected documents go), line dedup by source (boilerplate lines go), SimHash near-dedup
(one document of each group stays), benchmark decontamination (documents that hold a window of the
benchmark go), and mixing sources to target weights (rows repeat as often as they are taken).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm import decontaminate, lines, mixing, simhash, toxicity
from tillhouse.llm.common import ROW, keep, scratch, ship
from tillhouse.llm.queries import table
from tillhouse.session import discard


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below its threshold; it learns from `docs` that are labelled.

    Null and empty texts are scored like others; repeated rows stay or go together; without documents or
    labels nothing is rejected.
    """
    ship(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are boilerplate of their source; n_chars follows the text.

    A group of near copies (as the next stage finds them) counts as one document of a source here, so that
    copies do not make their own text boilerplate and the next stage can keep one whole. A null text stays
    null, an empty one empty; repeated rows are changed alike; null sources are one source.
    """
    ship(spark)
    row = F.xxhash64(F.struct(*[docs[f"`{c}`"] for c in docs.columns]))
    near = simhash.near_duplicates(docs, mark=row)
    classes = near.groupBy(F.col("mark").alias("row")).agg(F.min("root").alias("class"))
    found = lines.drop_boilerplate(docs, F.col("source"), F.col("text"), row=row, classes=classes)
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col(f"{ROW}.n_chars"))}
    return found.select(*[changed.get(c, F.col(f"{ROW}.`{c}`")).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id, null ids last.

    Of rows with that id the one of smallest digest stays, and of equal rows one. Null and empty texts are
    copies of each other.
    """
    ship(spark)
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs; null and empty texts hold none, repeated rows stay or go together."""
    ship(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken, numbered in `copy`; null and empty texts may be taken, repeated rows each on their own."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# The classifier and XXH64 have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage over what the others kept; each one's scratch tables go when it is written, and its
    input when the next one is, so that there is always a whole stage to go on from."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with scratch() as made:
            docs = keep(stage(spark, docs, sf_dir), name)
        discard(*before, *[t for t in made if t is not docs])
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
