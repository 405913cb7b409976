"""Quarantine: split a raw table into typed clean rows and a reject log."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillhouse.operators import dedupe
from tillhouse.operators.joins import splittable_join
from tillhouse.operators.rules import CONTENT_FIRST, REFERENCE, Entity
from tillhouse.session import discard, stored

REASON, UNFIT = "reason", "unfit"

# Bits of the map of repeated keys; it is broadcast as words of 64, at most 2^20 of them.
_BITS = 1 << 26


def pack_row(columns: list[str]) -> Column:
    """The row as a JSON object; NULL fields are left out."""
    return F.to_json(F.struct(*columns))


def flag(raw: DataFrame, entity: Entity, as_of: Column, strict: bool = False) -> DataFrame:
    """The raw rows with the reason of the first rule they break, and whether there is one."""
    reasoned = raw.select(*entity.columns).withColumn(REASON, entity.reason(as_of, strict))
    return reasoned.withColumn(UNFIT, F.col(REASON).isNotNull())


def _mode(entity: Entity, mode: str | None) -> str:
    mode = mode or entity.default_mode
    if mode not in (REFERENCE, CONTENT_FIRST):
        raise ValueError(f"unknown mode {mode}")
    if mode == REFERENCE and not entity.rank_by:
        raise ValueError(f"{entity.name} has no rank column; use {CONTENT_FIRST}")
    return mode


def _rivals(flagged: DataFrame, entity: Entity, mode: str) -> tuple[DataFrame, list[str]]:
    """The rows that compete for a key, and the columns that rank them.

    Rows without a key are always rejected, so they stay out of the shuffle. In `content_first`
    mode a fit row always beats an unfit one, so unfit rows stay out as well.
    """
    if mode == CONTENT_FIRST:
        return flagged.filter(~F.col(UNFIT)), entity.total_order()
    return flagged.filter(F.col(entity.key).isNotNull()), entity.total_order() + [REASON]


class Staged:
    """The two outputs of `stage`.

    Keys that occur once need no ranking: their rows pass through, past a join with the repeated
    keys. Those are stored first, in a stage of its own that shuffles keys alone, so the planner knows
    their size: when they are few Spark broadcasts them, and no fit row is shuffled; when they are many,
    the join is a plain one whose hot keys can be split. The rows of repeated keys are stored too, and
    only they are ranked; landed rows have the first of each key stored as well, for both outputs, and
    meet the repeated keys once, and only where a map of their hashes says so.

    `land` writes all rows once with their verdicts, and everything else then reads those files: raw is
    scanned and its rules are asked once. The verdict is a column, not a folder, since rows going to several
    folders would be sorted by each task that writes them. Without `land` the plans read raw, and ask the rules in
    each of them.
    """

    def __init__(self, raw: DataFrame, entity: Entity, as_of: Column, mode: str, strict: bool):
        self.entity, self.as_of, self.mode = entity, as_of, mode
        self._flagged = flag(raw, entity, as_of, strict)
        self._nulls_last = entity.ranked_columns()
        self._scratch: list[DataFrame] = []
        self._landed = False

    def _stored(self, df: DataFrame, purpose: str) -> DataFrame:
        self._scratch.append(stored(df, f"{self.entity.name}-{purpose}"))
        return self._scratch[-1]

    def land(self) -> dict[str, int]:
        """Write the rows with their verdicts; the number of rows by reason, counted on the way.

        The rows that are fit are those of no reason, under the name "fit".
        """
        seen = Observation()
        reasons = {rule.reason: F.count_if(F.col(REASON) == rule.reason) for rule in self.entity.rules}
        counts = [n.alias(name) for name, n in {**reasons, "fit": F.count_if(~F.col(UNFIT))}.items()]
        self._flagged = self._stored(self._flagged.observe(seen, *counts), "verdicts")
        self._landed = True
        return {name: n for name, n in seen.get.items() if n}

    def discard(self) -> None:
        """Remove what was stored on the way; neither output can be read afterwards."""
        discard(*self._scratch)
        self._scratch.clear()

    @cached_property
    def _competing(self) -> tuple[DataFrame, list[str]]:
        return _rivals(self._flagged, self.entity, self.mode)

    @cached_property
    def _repeated(self) -> DataFrame:
        """Keys of more than one rival."""
        counts = self._competing[0].groupBy(self.entity.key).agg(F.count(F.lit(1)).alias("_n"))
        return self._stored(counts.filter("_n > 1").select(self.entity.key), "repeated-keys")

    @cached_property
    def _sorted_out(self) -> tuple[DataFrame, DataFrame]:
        """The landed rivals whose key is clearly not repeated, and the others: (key, rank columns, `_again`).

        The hashes of the repeated keys set bits in a map of bounded size, which is broadcast. Rows whose bit is
        not set stay where they are. The others, those of repeated keys and a few more, meet the keys in one join.
        """
        key, (rivals, order) = self.entity.key, self._competing
        spot = F.pmod(F.xxhash64(key), F.lit(_BITS))
        bits = self._repeated.select(spot.alias("_spot")).groupBy(F.expr("_spot div 64").alias("_word")).agg(
            F.bit_or(F.expr("shiftleft(1L, CAST(_spot % 64 AS INT))")).alias("_bits")
        )
        rows = rivals.select(key, *order).withColumn("_spot", spot).withColumn("_word", F.expr("_spot div 64"))
        is_near = F.expr("coalesce(getbit(_bits, CAST(_spot % 64 AS INT)) = 1, false)")
        told = rows.join(F.broadcast(bits), "_word", "left").withColumn("_near", is_near)
        near = told.filter("_near").select(key, *order)
        met = splittable_join(near, self._repeated.withColumn("_again", F.lit(True)), key, "left")
        return told.filter("NOT _near").select(key, *order), self._stored(met, "near-repeated")

    @cached_property
    def _contested(self) -> DataFrame:
        """The rivals of repeated keys."""
        if self._landed:
            return self._sorted_out[1].filter("_again").drop("_again")
        met = splittable_join(self._competing[0], self._repeated, self.entity.key, "left_semi")
        return self._stored(met, "contested")

    @cached_property
    def _single(self) -> DataFrame:
        """The rivals whose key occurs once."""
        key, (rivals, order) = self.entity.key, self._competing
        if self._landed:
            clear, met = self._sorted_out
            return clear.unionByName(met.filter("_again IS NULL").drop("_again"))
        return splittable_join(rivals, self._repeated, key, "left_anti").select(key, *order)

    @cached_property
    def _first(self) -> DataFrame:
        """The first row of each repeated key."""
        first = dedupe.first_rows(self._contested, self.entity.key, self._competing[1], self._nulls_last)
        return self._stored(first, "first") if self._landed else first

    @cached_property
    def clean(self) -> DataFrame:
        """Typed rows, one per key."""
        key, order = self.entity.key, self._competing[1]
        kept = self._single.unionByName(dedupe.unpack(self._first, key, order))
        if self.mode == REFERENCE:
            kept = kept.filter(F.col(REASON).isNull())
        return kept.select(*self.entity.typed())

    @cached_property
    def errors(self) -> DataFrame:
        """Rejected rows as (JSON, reason, time); a rule's reason wins over duplication."""
        entity = self.entity
        fit = self._contested
        if self.mode == REFERENCE:
            fit = fit.filter(F.col(REASON).isNull())
        lost = dedupe.other_rows(fit, self._first, entity.key, self._competing[1], self._nulls_last)
        unfit = self._flagged.filter(F.col(UNFIT))
        rejected = unfit.select(*entity.columns, REASON).unionByName(
            lost.select(*entity.columns, F.lit(entity.duplicate_reason).alias(REASON))
        )
        return rejected.select(
            pack_row(entity.columns).alias("row_data"), REASON, self.as_of.alias("logged_at")
        )


def stage(
    raw: DataFrame, entity: Entity, as_of: Column, mode: str | None = None, strict: bool = False
) -> Staged:
    """Clean rows and rejected rows of a raw table; asking for either stores the repeated keys and their rows.

    `reference` mode ranks unfit rows too, so an unfit row that sorts first takes its key away;
    `content_first` keeps a fit row whenever the key has one.
    """
    return Staged(raw, entity, as_of, _mode(entity, mode), strict)


def landed(
    raw: DataFrame, entity: Entity, as_of: Column, mode: str | None = None, strict: bool = False
) -> Staged:
    """As `stage`, with the rows written at once: raw is scanned and its rules are asked one single time."""
    staged = stage(raw, entity, as_of, mode, strict)
    staged.land()
    return staged


def quality_counts(
    raw: DataFrame, entity: Entity, as_of: Column, mode: str | None = None, strict: bool = False
) -> DataFrame:
    """(reason, n): what `stage` would keep (`clean`) and reject, without building the rows.

    In `content_first` mode only keys and counters are shuffled; in `reference` mode the first row
    of each key is too, since its reason decides.
    """
    mode = _mode(entity, mode)
    flagged = flag(raw, entity, as_of, strict)
    # No filter tells fit rows from unfit ones: it would be moved below everything and ask all rules anew.
    is_fit = F.col(REASON).isNull()
    if mode == CONTENT_FIRST:
        per_key = flagged.groupBy(REASON, F.when(is_fit, F.col(entity.key)).alias("_key")).agg(
            F.count(F.lit(1)).alias("_n")
        )
        totals = per_key.groupBy(REASON).agg(
            F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_keys")
        )
        unfit = F.array(F.struct(REASON, F.col("_n").alias("n")))
        return totals.select(F.inline(F.when(is_fit, _kept_and_lost(entity)).otherwise(unfit))).filter("n > 0")
    rivals, order = _rivals(flagged, entity, mode)
    per_key = rivals.groupBy(entity.key).agg(
        F.min(dedupe.ordering(order, entity.ranked_columns()))[REASON].isNull().alias("_kept"),
        F.count_if(is_fit).alias("_n"),
    )
    fit = per_key.agg(F.sum("_n").alias("_n"), F.count_if("_kept").alias("_keys"))
    names = [rule.reason for rule in entity.rules]
    seen = flagged.agg(*[F.count_if(F.col(REASON) == name).alias(name) for name in names])
    unfit = seen.select(
        F.inline(F.array(*[F.struct(F.lit(name).alias(REASON), F.col(name).alias("n")) for name in names]))
    )
    return unfit.unionByName(fit.select(F.inline(_kept_and_lost(entity)))).filter("n > 0")


def _kept_and_lost(entity: Entity) -> Column:
    """Rows for `quality_counts` from the number of fit rows, `_n`, and of keys that are kept, `_keys`."""
    return F.array(
        F.struct(F.lit("clean").alias(REASON), F.col("_keys").alias("n")),
        F.struct(F.lit(entity.duplicate_reason).alias(REASON), (F.col("_n") - F.col("_keys")).alias("n")),
    )


def rejected_fields(errors: DataFrame, fields: dict[str, str]) -> DataFrame:
    """The reason of each rejected row and the typed `fields` (column to SQL type) of the row.

    The JSON is parsed once, into a VARIANT without the fields that were NULL. A field that is not there or
    does not have the type is NULL.
    """
    row = errors.select(REASON, F.parse_json("row_data").alias("_row"))
    return row.select(REASON, *[F.try_variant_get("_row", f"$.{name}", kind).alias(name) for name, kind in fields.items()])


def reason_counts(errors: DataFrame) -> DataFrame:
    """Rejected rows per reason, most frequent first."""
    return (
        errors.groupBy(REASON)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.col("cnt").desc(), REASON)
    )
