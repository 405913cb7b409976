"""Raw to staging to warehouse, as published tables. Loading twice gives the same tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillhouse.functions import casts
from tillhouse.operators.keys import assign_sk, new_keys, next_sk, numbered_by
from tillhouse.operators.profiling import require_unique
from tillhouse.operators.rules import ENTITY
from tillhouse.operators.staging import stage
from tillhouse.plans.arrivals import STAGED, WAREHOUSE, mark_consumed, unread
from tillhouse.plans.dims import (
    Dims,
    calendar,
    current,
    date_spine_of,
    first_versions,
    places,
)
from tillhouse.plans.fact import build_fact_sales
from tillhouse.plans.incremental import incremental_orders
from tillhouse.plans.scd2 import past, scd2_parts
from tillhouse.schema import DW, ENTITIES, RAW, SCHEMAS, STAGING, columns_of
from tillhouse.session import discard, stored
from tillhouse.sources.layers import ConflictError, Layers, Written, closed_folders
from tillhouse.sources.raw import seed_watermarks
from tillhouse.sources.sinks import RANGE, clustered


def _side_by_side(jobs: list[Callable[[], list[Written]]]) -> list[Written]:
    """Submit independent loads together, so that small tables do not leave executors idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [written for done in pool.map(lambda job: job(), jobs) for written in done]


def load_raw(layers: Layers, raws: Mapping[str, DataFrame], partitions: int | None = None) -> None:
    """Keep the extracts as raw tables."""
    known = layers.versions()

    def job(entity: str) -> Callable[[], list[Written]]:
        name = f"{entity}_raw"
        rows = raws[entity].repartition(partitions) if partitions else raws[entity]
        return lambda: [layers.write(RAW, name, rows, known)]

    layers.publish(_side_by_side([job(entity) for entity in raws]))


def open_raw(layers: Layers) -> dict[str, DataFrame]:
    return dict(zip(ENTITIES, layers.tables(*[(RAW, f"{e}_raw") for e in ENTITIES])))


def load_staging(
    layers: Layers, raws: Mapping[str, DataFrame] | None, as_of: Column, mode: str | None = None
) -> None:
    """Replace the clean and error tables of all entities, published together with their counts.

    Without `raws` the landed raw tables are read, and their folders are noted as consumed.

    Each raw table is scanned once: its rows land apart by verdict, and both tables are made from there.
    `load_counts` holds what was counted while the rows passed; no table is read for it again.
    """
    known = layers.versions()
    landed = raws is None
    if landed:
        raws = {e: unread(layers, known, None, RAW, f"{e}_raw").rows for e in ENTITIES if (RAW, f"{e}_raw") in known}
    counts: list[tuple[str, str, int]] = []

    def job(entity: str) -> Callable[[], list[Written]]:
        spec = ENTITY[entity]
        staged = stage(raws[entity], spec, as_of, mode)

        def load() -> list[Written]:
            reasons = staged.land()
            clean, errors = Observation(), Observation()
            n = F.count(F.lit(1)).alias("n")
            done = [
                layers.write(STAGING, f"{entity}_clean", staged.clean.observe(clean, n), known),
                layers.write(STAGING, f"{entity}_errors", staged.errors.observe(errors, n), known),
            ]
            staged.discard()
            reasons.pop("fit", None)
            kept, rejected = clean.get["n"], errors.get["n"]
            found = {"clean": kept, **reasons, spec.duplicate_reason: rejected - sum(reasons.values())}
            counts.extend((entity, reason, count) for reason, count in found.items() if count)
            return done

        return load

    written = _side_by_side([job(entity) for entity in raws])
    fresh = layers.spark.createDataFrame(counts, SCHEMAS[STAGING]["load_counts"])
    if (STAGING, "load_counts") in known:
        others = layers.table(STAGING, "load_counts").filter(~F.col("entity").isin(*raws))
        fresh = fresh.unionByName(others)
    written.append(layers.write(STAGING, "load_counts", fresh.coalesce(1), known))
    if landed:
        rest = [unread(layers, known, STAGED, RAW, f"{e}_raw") for e in ENTITIES]
        written.append(mark_consumed(layers, known, STAGED, rest, as_of))
    layers.publish(written)


def load_warehouse(layers: Layers, fact_by: str = "date_sk", as_of: Column | None = None) -> None:
    """Dimensions, then the fact from the dimensions as written, published together.

    Generated keys come from a registry for each dimension, to which new keys are appended: a key keeps its
    number over all loads.
    """
    known = layers.versions()
    items, orders, customers, products = [
        layers.folder_frame(STAGING, f"{e}_clean", known[STAGING, f"{e}_clean"].folders)
        for e in ("order_items", "orders", "customers", "products")
    ]

    def stored_rows(name: str) -> DataFrame | None:
        return layers.folder_frame(DW, name, known[DW, name].folders) if (DW, name) in known else None

    def dimension(name: str, df: DataFrame, keys: list[str], sk: str | None = None) -> Callable[[], list[Written]]:
        def load() -> list[Written]:
            book = f"key_{name[4:]}"
            registry = stored_rows(book) if sk else None
            if registry is not None:
                # Versions of customers may hold numbers that the registry does not know.
                used = registry.select(sk).unionByName(stored_rows(name).select(sk)) if (DW, name) in known else registry
                added = layers.write(DW, book, new_keys(df, keys, sk, registry, next_sk(used, sk)), known, append=True)
                df_numbered = numbered_by(df, keys, sk, added.frame)
                done = [layers.write(DW, name, df_numbered.select(*columns_of(DW, name)), known), added]
            else:
                first = assign_sk(df, keys, sk).select(*columns_of(DW, name)) if sk else df
                done = [layers.write(DW, name, first, known)]
                if sk:
                    done.append(layers.write(DW, book, done[0].frame.select(*keys, sk), known, append=True))
            rows = current(done[0].frame) if name == "dim_customer" else done[0].frame
            # A repeated dimension key would multiply revenue without any error.
            require_unique(rows, keys, name)
            return done

        return load

    done = _side_by_side(
        [
            dimension("dim_date", calendar(date_spine_of(orders, "order_date")), ["date_sk"]),
            dimension("dim_product", products, ["product_code"], "product_sk"),
            dimension("dim_location", places(orders), ["city", "state"], "location_sk"),
            dimension("dim_customer", first_versions(customers), ["customer_code"], "customer_sk"),
        ]
    )
    by_name = {written.name: written.frame for written in done}
    product, location, customer = (by_name[f"dim_{n}"] for n in ("product", "location", "customer"))
    fact = build_fact_sales(items, orders, customer, product, location)
    if fact_by == RANGE:
        fact = stored(fact, "fact")
    done.append(
        layers.write(DW, "fact_sales", clustered(fact, fact_by), known, partition_by=["year_month"])
    )
    if fact_by == RANGE:
        discard(fact)
    if (DW, "fact_pending") in known:
        # Refreshes are in use: what they go on from belongs to this load now.
        waiting = items.join(done[-1].frame.select("order_item_id"), "order_item_id", "left_anti")
        done.append(layers.write(DW, "fact_pending", waiting, known))
    read = [unread(layers, known, WAREHOUSE, STAGING, f"{e}_clean") for e in ("orders", "order_items", "products")]
    at = F.lit(None).cast("timestamp_ntz") if as_of is None else as_of
    done.append(mark_consumed(layers, known, WAREHOUSE, read, at))
    layers.publish(done)


def full_load(
    layers: Layers,
    raws: Mapping[str, DataFrame] | None,
    as_of: datetime | str,
    mode: str | None = None,
    fact_by: str = "date_sk",
) -> None:
    """Raw tables to published staging and warehouse tables; `raws` as in `load_staging`, `fact_by` as in `clustered`."""
    load_staging(layers, raws, casts.moment(as_of), mode)
    load_warehouse(layers, fact_by, casts.moment(as_of))


def refresh_customers(
    layers: Layers, source: DataFrame, as_of: datetime | str, mode: str = "reference"
) -> DataFrame:
    """Apply a staged customer refresh to the published dimension.

    Closed versions live in folders that stay as they are: a refresh writes the current versions
    anew and adds a folder with those it closes.
    """
    name = (DW, "dim_customer")
    known = layers.versions()
    seen = known[name]
    done = set(closed_folders(seen))
    rows = layers.folder_frame(*name, tuple(f for f in seen.folders if f not in done))
    versions = layers.folder_frame(*name, seen.folders)
    book = (DW, "key_customer")
    registry = layers.folder_frame(*book, known[book].folders) if book in known else None
    used = versions if registry is None else versions.select("customer_sk").unionByName(registry.select("customer_sk"))
    first = next_sk(used, "customer_sk")
    closed, open_ = scd2_parts(rows, source, casts.moment(as_of), mode, first)
    written = layers.write_split(*name, past(rows).unionByName(closed), open_, known)
    done = [written]
    if registry is not None:
        # A customer first seen here keeps this number over later full loads.
        fresh = written.frame.select("customer_code", "customer_sk").join(registry, "customer_code", "left_anti")
        firsts = fresh.groupBy("customer_code").agg(F.min("customer_sk").alias("customer_sk"))
        done.append(layers.write(*book, firsts, known, append=True))
    layers.publish(done)
    return written.frame


def increment(
    layers: Layers, raw_orders: DataFrame, as_of: datetime | str, validate: bool = True
) -> DataFrame:
    """Append the new orders, and with `validate` their rejects, and move the watermark; returns the orders.

    All are published by one manifest entry, so a run that dies has done nothing, and the next
    one starts from the old watermark. A run that another increment overtakes finds the watermark
    moved, and starts again from there. A reject that is logged already is not logged again.
    """
    if (STAGING, "load_watermarks") not in layers.versions():
        try:
            layers.replace(STAGING, "load_watermarks", seed_watermarks(layers.spark))
        except ConflictError:
            pass  # another run has seeded them
    while True:
        known = layers.versions()
        marks, loaded = layers.tables((STAGING, "load_watermarks"), (STAGING, "orders_clean"))
        done = incremental_orders(raw_orders, loaded, marks, casts.moment(as_of), validate)
        written = [
            layers.write(STAGING, "orders_clean", done.added, known, append=True),
            layers.write(STAGING, "load_watermarks", done.watermarks, known),
        ]
        if validate:
            errors = done.errors
            if (STAGING, "orders_errors") in known:
                logged = layers.table(STAGING, "orders_errors").select("row_data", "reason")
                errors = errors.join(logged, ["row_data", "reason"], "left_anti").select(*errors.columns)
            written.append(layers.write(STAGING, "orders_errors", errors, known, append=True))
        try:
            layers.publish(written)
        except ConflictError:
            continue
        return layers.table(STAGING, "orders_clean")


def open_dims(layers: Layers) -> Dims:
    names = ("dim_date", "dim_product", "dim_location", "dim_customer")
    return Dims(*layers.tables(*[(DW, name) for name in names]))


def open_fact(layers: Layers, year: int | None = None) -> DataFrame:
    """The fact table; a year skips the other months' folders."""
    fact = layers.table(DW, "fact_sales")
    if year is not None:
        fact = fact.filter(F.col("year_month").between(year * 100 + 1, year * 100 + 12))
    return fact
