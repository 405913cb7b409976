"""Mixing sources to target weights by systematic sampling. DataFrame functions only.

Within a source the documents stand in an order, each with its expected number of copies. The
expectations are added up along the order, one random offset is added, and a document is emitted
once for every whole number its stretch crosses. So a source gives its expected number of copies
up to one, and since the order goes by size, its words come near the target as well.

The sums along a source are taken in three steps, so that a source of any size is spread: each
source is cut by size class and digest into cells, and a cell by further digest bits into parts.
Cells are placed one after another, parts inside their cell, and documents are numbered inside
their part, of which a size class of a source has `CELLS` * `PARTS`. Expectations are whole numbers of 1 / `ONE` copies:
sums are exact and do not depend on the order in which they are made.

Defined results: a null text has size 0. Null sources form one source, after all others. A source
that is not weighted gets nothing. Documents of size 0 can be emitted too. Equal rows may swap
places, which changes no value. Empty tables give empty results. Columns of the input keep their
names in `mix`; the operator's own columns are added beside a struct, so none can clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.common import ROW, keep, packed
from tillhouse.operators.joins import splittable_join

WORD = r"[^\x20\x09-\x0D]+"
MAX_REPEAT = 3
SEED = 7
# A copy in fixed point, exact for sums of up to 2**39 copies in a source.
SHIFT = 24
ONE = 1 << SHIFT
# Cells of a size class and parts of a cell.
CELLS, PARTS = 64, 64
# Size classes an octave: sizes within a class differ by an eighth at most.
CLASSES = 8


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _digest(*values: Column) -> Column:
    """The first 31 bits of an MD5, a number that other engines can compute too."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *values)), 1, 8), 16, 10).cast("long").bitwiseAND((1 << 31) - 1)


def _key(source: Column) -> Column:
    """A source as text that is never null, so that joins and windows share one partitioning."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(""))


def sized(docs: DataFrame) -> DataFrame:
    """The rows of `docs` inside `ROW`, with doc_id, source, its never null `key`, size and what orders them."""
    row = packed(docs)
    size = word_count(F.col(f"{ROW}.text"))
    # Of id and text, so that rows without an id, or with one and the same, are spread too.
    digest = _digest(F.coalesce(F.col(f"{ROW}.doc_id").cast("string"), F.lit("")), F.coalesce(F.col(f"{ROW}.text"), F.lit("")))
    return row.select(
        ROW,
        F.col(f"{ROW}.doc_id").alias("doc_id"),
        F.col(f"{ROW}.source").alias("source"),
        size.alias("size"),
    ).withColumns(
        # None is ever null, and Spark can see that: a join on them adds no test that takes the texts apart again.
        {
            "key": _key(F.col("source")),
            "class": F.coalesce(F.when(F.col("size") >= 1, F.floor(F.log2(F.col("size").cast("double")) * CLASSES).cast("int")), F.lit(-1)),
            "cell": F.coalesce(F.pmod(digest, F.lit(CELLS)).cast("int"), F.lit(0)),
            "part": F.coalesce(F.pmod(F.floor(digest / CELLS), F.lit(PARTS)).cast("int"), F.lit(0)),
        }
    )


def rotating_weights(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, source_size, weight): sources by code point, null last, weigh `weights` in turn.

    `sizes` has one row per source. It is what a person would write down by hand, and numbered in one task.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = reduce(lambda c, i: F.when(F.pmod(place, F.lit(len(weights))) == i, weights[i]).otherwise(c), range(len(weights)), F.lit(weights[0]))
    return sizes.select("source", "source_size", turn.cast("long").alias("weight"))


def targets(weighted: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """`weighted` with `target`: shares of all sizes by weight, none above `max_repeat` times its source.

    What exceeds a cap is shared again by weight until nothing does. That ends where each source has
    the smaller of its cap and weight * level, so sources are capped in the order of cap / weight:
    one is capped if the level that all before it leave is above that. One row per source.
    """
    cap = F.col("source_size") * max_repeat
    order = Window.orderBy((cap / F.col("weight")).asc(), F.col("source").asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    leveled = weighted.withColumns({"cap": cap, "level": level})
    capped = F.col("cap") <= F.col("weight") * F.col("level")
    # The level of the first source that is not capped holds for all after it.
    reached = F.min(F.when(~capped, F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)["level"]
    return (
        leveled.withColumns({"capped": capped, "reached": reached})
        .select(
            "source", "source_size", "weight",
            F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("reached")).alias("target"),
        )
    )


def copies(rows: DataFrame, cells: DataFrame, planned: DataFrame, seed: int = SEED) -> DataFrame:
    """`rows` of `sized` with source_size, target and `copies`, the times the mix takes each.

    `cells` and `planned` come from `plan_mix`. The expectation of a document is target / source
    size copies.
    """
    expected = F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * ONE)).otherwise(0).cast("long")
    offset = F.pmod(_digest(F.lit(str(seed)), F.coalesce(F.col("source"), F.lit("\x00"))), F.lit(ONE))
    rates = planned.select(
        _key(F.col("source")).alias("key"), "source_size", "target", expected.alias("expected"), offset.alias("offset")
    )

    def before(within: list[str], order: list[str]) -> Column:
        along = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(along), F.lit(0))

    cell, part = ["key", "class", "cell"], ["key", "class", "cell", "part"]
    whole = cells.groupBy(*cell).agg(F.sum("n").alias("n"))
    whole = whole.select(*cell, before(["key"], ["class", "cell"]).alias("to_cell")).join(rates, "key")
    placed = cells.select(*part, before(cell, ["part"]).alias("to_part"))
    starts = splittable_join(placed, whole, cell).withColumn("before", F.col("to_cell") + F.col("to_part")).drop("to_cell", "to_part")
    # Window and join are dealt by the same columns, so whole rows travel once.
    inside = Window.partitionBy(*part).orderBy("size", "doc_id", F.xxhash64(ROW))
    met = rows.withColumn("rank", F.row_number().over(inside)).join(starts, part)
    end = (F.col("before") + F.col("rank")) * F.col("expected") + F.col("offset")
    crossed = F.shiftright(end, SHIFT) - F.shiftright(end - F.col("expected"), SHIFT)
    return met.select(
        *rows.columns, "source_size", "target", crossed.alias("copies")
    )


def plan_mix(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = MAX_REPEAT) -> tuple[DataFrame, DataFrame]:
    """(cells with their rows and words, targets per source) of the `sized` rows, under weights that the sources take in turn.

    One pass over the rows sums them by cell, a hot source into many; all else follows from the sums.
    """
    cells = keep(
        rows.groupBy("source", "key", "class", "cell", "part").agg(F.count("*").alias("n"), F.sum("size").alias("words")), "mix-cells"
    )
    sizes = cells.groupBy("source").agg(F.sum("words").alias("source_size"))
    return cells, keep(targets(rotating_weights(sizes, weights), max_repeat), "mix-targets")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = MAX_REPEAT, seed: int = SEED) -> DataFrame:
    """The mix itself: `docs` with each row repeated as often as it is taken, numbered in `copy`."""
    rows = sized(docs)
    taken = copies(rows, *plan_mix(rows, weights, max_repeat), seed).where("copies > 0")
    name = "copy"
    while name in docs.columns:
        name = f"_{name}"
    return taken.select(ROW, F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("n")).select(
        *[F.col(f"{ROW}.`{c}`").alias(c) for c in docs.columns], F.col("n").alias(name)
    )


def allotment(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = MAX_REPEAT, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) of every row of `docs`."""
    rows = sized(docs.select("doc_id", "source", "text"))
    # Texts are read once, for their size and a digest, and do not travel.
    slim = keep(rows.withColumn(ROW, F.struct(F.xxhash64(f"{ROW}.text").alias("digest"))), "mix-sizes")
    return copies(slim, *plan_mix(slim, weights, max_repeat), seed).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )
