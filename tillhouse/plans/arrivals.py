"""Increments by arrival: only files that landed since the last run are read, and the warehouse follows.

Raw rows land in folders of their own, and a log names the folders that were consumed, by whom. A run reads
the others, appends what they hold to staging, and publishes rows, log and watermark by one manifest entry:
a run that dies has done nothing, and no folder is read twice. The warehouse is a consumer of staging in the
same way: it resolves the items whose order, customer or product has arrived, and rewrites the months they
fall in. All other months keep their files.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions import casts
from tillhouse.operators.keys import lacking_keys, new_keys, numbered_by
from tillhouse.operators.rules import ENTITY
from tillhouse.plans.dims import calendar, current, date_spine_between, places
from tillhouse.plans.fact import build_fact_sales
from tillhouse.plans.incremental import ORDERS_TABLE, admit, admit_orders, set_watermark
from tillhouse.schema import DW, RAW, SCHEMAS, STAGING, columns_of
from tillhouse.session import discard, stored
from tillhouse.sources.layers import ConflictError, Layers, Versions, Written
from tillhouse.sources.raw import seed_watermarks
from tillhouse.sources.sinks import clustered, fact_month

LOG = (STAGING, "load_arrivals")
STAGED, WAREHOUSE = "staging", "warehouse"


@dataclass(frozen=True)
class Arrivals:
    """The folders of a table that a consumer has not read, and their rows."""

    layer: str
    name: str
    folders: tuple[str, ...]
    rows: DataFrame | None

    def files(self, spark, consumer: str, as_of: Column) -> DataFrame:
        """Log rows: the files behind the rows, from the columns that file sources give, without reading any other."""
        if self.rows is None:
            return spark.createDataFrame([], SCHEMAS[STAGING]["load_arrivals"])
        meta = F.col("_metadata")
        found = self.rows.groupBy(
            meta["file_path"].alias("file"), meta["file_size"].alias("bytes"),
            meta["file_modification_time"].cast("timestamp_ntz").alias("landed_at"),
        ).agg(F.count(F.lit(1)).alias("n_rows"))
        folder = F.regexp_extract("file", f"/{self.name}/version=([^/]+)/", 1)
        return found.select(
            F.lit(consumer).alias("consumer"), F.lit(self.name).alias("table_name"), folder.alias("folder"),
            "file", "bytes", "n_rows", "landed_at", as_of.alias("loaded_at"),
        )


def land(layers: Layers, entity: str, rows: DataFrame) -> str:
    """Add raw rows as an arrival; the folder that holds them."""
    written = layers.write(RAW, f"{entity}_raw", rows, layers.versions(), append=True)
    layers.publish([written])
    return written.folders[0]


def consumed(layers: Layers, known: Versions, consumer: str, name: str) -> set[str]:
    """The folders of a table that were read; the log holds a row for each of their files."""
    if LOG not in known:
        return set()
    log = layers.folder_frame(*LOG, known[LOG].folders)
    mine = log.filter((F.col("consumer") == consumer) & (F.col("table_name") == name))
    return {r.folder for r in mine.select("folder").distinct().collect()}


def unread(layers: Layers, known: Versions, consumer: str | None, layer: str, name: str) -> Arrivals:
    """What a consumer has not read of a table; without a consumer, all of it."""
    if (layer, name) not in known:
        return Arrivals(layer, name, (), None)
    done = consumed(layers, known, consumer, name) if consumer else set()
    fresh = tuple(f for f in known[layer, name].folders if f.split("/")[0] not in done)
    return Arrivals(layer, name, fresh, layers.folder_frame(layer, name, fresh) if fresh else None)


def mark_consumed(layers: Layers, known: Versions, consumer: str, found: list[Arrivals], as_of: Column) -> Written:
    """Log rows for all files of `found`, written but not visible yet."""
    rows = [a.files(layers.spark, consumer, as_of) for a in found]
    log = rows[0]
    for more in rows[1:]:
        log = log.unionByName(more)
    return layers.write(*LOG, log.coalesce(1), known, append=True)


def increment(layers: Layers, as_of: datetime | str, entities: tuple[str, ...] = ("orders", "order_items", "payments")) -> dict[str, int]:
    """Append what has arrived to staging; the number of files read by entity.

    Every row of an arrival goes to the clean table or to the reject log, however late it is. A row is a
    duplicate if its key is loaded already or if it loses within the arrival. The orders' watermark moves
    to `as_of`. A run that another one overtakes starts again with what is left.
    """
    at = casts.moment(as_of)
    while True:
        known = layers.versions()
        if (STAGING, "load_watermarks") not in known:
            try:
                layers.replace(STAGING, "load_watermarks", seed_watermarks(layers.spark))
            except ConflictError:
                pass
            continue
        found = {e: unread(layers, known, STAGED, RAW, f"{e}_raw") for e in entities}
        written: list[Written] = []
        for entity, arrived in found.items():
            if arrived.rows is None:
                continue
            clean, errors = f"{entity}_clean", f"{entity}_errors"
            loaded = layers.folder_frame(STAGING, clean, known[STAGING, clean].folders) if (STAGING, clean) in known else None
            if loaded is None:
                loaded = layers.spark.createDataFrame([], SCHEMAS[STAGING][clean])
            admitted = admit_orders(arrived.rows, loaded, at) if entity == "orders" else admit(arrived.rows, loaded, at, ENTITY[entity])
            written.append(layers.write(STAGING, clean, admitted.clean, known, append=True))
            written.append(layers.write(STAGING, errors, admitted.errors, known, append=True))
        if not written:
            return {}
        marks = layers.folder_frame(STAGING, "load_watermarks", known[STAGING, "load_watermarks"].folders)
        written.append(mark_consumed(layers, known, STAGED, list(found.values()), at))
        # Replacing the control table is what makes two runs from one base collide.
        written.append(layers.write(STAGING, "load_watermarks", set_watermark(marks, at, ORDERS_TABLE), known))
        try:
            layers.publish(written)
        except ConflictError:
            continue
        return {e: len(a.rows.inputFiles()) for e, a in found.items() if a.rows is not None}


def _new_rows(layers: Layers, known: Versions, name: str, fresh: DataFrame, keys: list[str], sk: str) -> tuple[DataFrame, list[Written]]:
    """A dimension with the rows of `fresh` whose keys it lacks, and what was written for that."""
    book = f"key_{name[4:]}"
    registry = layers.folder_frame(DW, book, known[DW, book].folders)
    added = layers.write(DW, book, new_keys(fresh, keys, sk, registry), known, append=True)
    dim = layers.folder_frame(DW, name, known[DW, name].folders)
    lacking = lacking_keys(fresh, dim, keys)
    rows = numbered_by(lacking, keys, sk, added.frame).select(*columns_of(DW, name))
    written = layers.write(DW, name, rows, known, append=True)
    return written.frame, [added, written]


def refresh_warehouse(layers: Layers, as_of: datetime | str) -> list[int]:
    """Let the fact follow staging; the months that were rewritten.

    Items that have arrived, and those that waited for their order, customer or product, are resolved. New
    places and products get the next numbers. Months without new rows keep their files as they are.
    """
    at = casts.moment(as_of)
    known = layers.versions()
    items = unread(layers, known, WAREHOUSE, STAGING, "order_items_clean")
    orders_new = unread(layers, known, WAREHOUSE, STAGING, "orders_clean")
    products_new = unread(layers, known, WAREHOUSE, STAGING, "products_clean")

    def whole(layer: str, name: str) -> DataFrame:
        return layers.folder_frame(layer, name, known[layer, name].folders)

    orders, fact = whole(STAGING, "orders_clean"), whole(DW, "fact_sales")
    if (DW, "fact_pending") in known:
        waiting = whole(DW, "fact_pending")
    else:
        # The first refresh after a full load: what its joins left out.
        done = consumed(layers, known, WAREHOUSE, "order_items_clean")
        old = tuple(f for f in known[STAGING, "order_items_clean"].folders if f in done)
        loaded = layers.folder_frame(STAGING, "order_items_clean", old) if old else whole(STAGING, "order_items_clean").limit(0)
        waiting = loaded.join(fact.select("order_item_id"), "order_item_id", "left_anti")
    # Read three times below: for the orders it names, for the fact, and for what goes on waiting.
    candidates = stored(waiting if items.rows is None else waiting.unionByName(items.rows), "fact-candidates")

    written: list[Written] = []
    location, product = whole(DW, "dim_location"), whole(DW, "dim_product")
    if orders_new.rows is not None:
        location, more = _new_rows(layers, known, "dim_location", places(orders_new.rows), ["city", "state"], "location_sk")
        written += more
        written += _longer_calendar(layers, known, orders_new.rows)
    if products_new.rows is not None:
        product, more = _new_rows(layers, known, "dim_product", products_new.rows, ["product_code"], "product_sk")
        written += more
    headers = orders.join(candidates.select("order_id").distinct(), "order_id", "left_semi")
    resolved = build_fact_sales(candidates, headers, current(whole(DW, "dim_customer")), product, location)
    arrived = stored(resolved.withColumn("year_month", fact_month()), "fact-arrived")
    months = [r.year_month for r in arrived.select("year_month").distinct().orderBy("year_month").collect()]

    pending = candidates.join(arrived.select("order_item_id"), "order_item_id", "left_anti")
    written.append(layers.write(DW, "fact_pending", pending, known))
    if months:
        kept, replaced = [], []
        for folder in layers.partitions(DW, "fact_sales", known[DW, "fact_sales"].folders):
            month = int(folder.rpartition("year_month=")[2])
            (replaced if month in months else kept).append(folder)
        rows = arrived
        if replaced:
            rows = layers.folder_frame(DW, "fact_sales", tuple(replaced)).select(*rows.columns).unionByName(rows)
        written.append(
            layers.write(DW, "fact_sales", clustered(rows.drop("year_month"), "year_month"), known, partition_by=["year_month"], kept=tuple(kept))
        )
    written.append(mark_consumed(layers, known, WAREHOUSE, [items, orders_new, products_new], at))
    layers.publish(written)
    discard(arrived, candidates)
    return months


def _longer_calendar(layers: Layers, known: Versions, orders: DataFrame) -> list[Written]:
    """The calendar with the days before and after it that the new orders need."""
    days = layers.folder_frame(DW, "dim_date", known[DW, "dim_date"].folders)
    day = F.col("order_date").cast("date")
    new = orders.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    old = days.agg(F.min("full_date").alias("first"), F.max("full_date").alias("last")).first()
    if new.first is None or old.first is not None and old.first <= new.first and new.last <= old.last:
        return []
    first = new.first if old.first is None else min(old.first, new.first)
    last = new.last if old.last is None else max(old.last, new.last)
    return [layers.write(DW, "dim_date", calendar(date_spine_between(layers.spark, first, last)), known)]
