"""Every query of the library over the benchmark tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions import casts, masking, text
from tillhouse.functions import predicates as p
from tillhouse.operators import inject, paging, profiling, reconcile, staging
from tillhouse.operators.mutate import delete_where, update_where
from tillhouse.operators.rules import CONTENT_FIRST, ENTITY, REFERENCE
from tillhouse.plans import analytics, arrivals, dims, fact, full_load, incremental, raw_sales, scd2
from tillhouse.schema import DW, ENTITIES, SCHEMAS, STAGING
from tillhouse.session import shared_dir, stored
from tillhouse.sources import raw as sources
from tillhouse.sources import sinks, testdata
from tillhouse.sources.layers import Layers
from tillhouse.streaming import orders as stream

Query = Callable[[SparkSession, str], DataFrame]

SEED = 23
FILTER_CATEGORY, FILTER_YEAR = "ECONOMY", 1997
HISTORY_CODE = "C0000011"
SIM_ORDER = "ARRIVAL-1"
RELOAD_CITY = "NATION_5"


class Shop:
    """The warehouse over one set of benchmark tables; every attribute is a lazy frame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.as_of: Column = casts.moment(testdata.AS_OF)

    @cached_property
    def raw(self) -> testdata.RawTables:
        return testdata.RawTables(self.spark, self.sf_dir)

    @cache
    def staged(self, entity: str, mode: str | None = None) -> staging.Staged:
        return staging.landed(self.raw[entity], ENTITY[entity], self.as_of, mode)

    def clean(self, entity: str) -> DataFrame:
        return self.staged(entity).clean

    @cached_property
    def dims(self) -> dims.Dims:
        return dims.Dims(
            dims.build_dim_date(self.spark, testdata.CALENDAR_START, testdata.CALENDAR_DAYS),
            dims.build_dim_product(self.clean("products")),
            dims.build_dim_location(self.clean("orders")),
            dims.build_dim_customer(self.clean("customers")),
        )

    @cached_property
    def fact(self) -> DataFrame:
        return fact.build_fact_sales(
            self.clean("order_items"), self.clean("orders"),
            self.dims.customer, self.dims.product, self.dims.location,
        )

    @cached_property
    def filtered(self) -> DataFrame:
        return analytics.apply_filters(self.fact, self.dims, FILTER_CATEGORY, FILTER_YEAR)

    @cached_property
    def refresh(self) -> DataFrame:
        return testdata.refreshed_customers(self.clean("customers"))

    def customers_after(self, mode: str) -> DataFrame:
        return scd2.scd2_apply(self.dims.customer, self.refresh, self.as_of, mode)

    @cached_property
    def watermarks(self) -> DataFrame:
        """The seeded control table, with orders moved on to the benchmark's watermark."""
        seeded = sources.seed_watermarks(self.spark)
        return incremental.set_watermark(seeded, casts.moment(testdata.WATERMARK))

    def increment(self, validate: bool = False) -> incremental.Increment:
        """The orders up to the watermark were loaded before; the rest of the raw table is new."""
        return incremental.incremental_orders(
            self.raw["orders"], self.loaded_before, self.watermarks, self.as_of, validate
        )

    @cached_property
    def loaded_before(self) -> DataFrame:
        at = casts.moment(testdata.WATERMARK)
        return self.clean("orders").filter(F.col("order_date") <= at)

    @cached_property
    def injected(self) -> dict[str, DataFrame]:
        return {
            name: stored(
                inject.inject(
                    inject.as_text(self.staged(name, CONTENT_FIRST).clean), name, ENTITY[name].key,
                    self.as_of, SEED,
                ),
                f"{name}-injected",
            )
            for name in ENTITIES
        }


def plain(df: DataFrame) -> DataFrame:
    """Amounts as DOUBLE, whole numbers as BIGINT, days as text: alike in any engine."""
    wide = {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "date": "string"}
    return df.select(
        *[
            F.col(name).cast("double").alias(name)
            if kind.startswith("decimal")
            else F.col(name).cast(wide[kind]).alias(name)
            if kind in wide
            else F.col(name)
            for name, kind in df.dtypes
        ]
    )


_REGISTRY: dict[str, Query] = {}


def _query(build: Callable[[Shop], DataFrame], name: str | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(Shop(spark, sf_dir)))

    _REGISTRY[name or build.__name__] = run
    return build


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# Raw tables ---------------------------------------------------------------------------------


@_query
def q_raw_monthly_revenue(s: Shop) -> DataFrame:
    return raw_sales.monthly_revenue(s.raw["orders"], s.raw["order_items"])


@_query
def q_raw_top_cities(s: Shop) -> DataFrame:
    return raw_sales.top_cities(s.raw["orders"], s.raw["order_items"])


@_query
def q_raw_top_products(s: Shop) -> DataFrame:
    return raw_sales.top_products(s.raw["order_items"], s.raw["products"])


@_query
def q_raw_clv(s: Shop) -> DataFrame:
    return raw_sales.customer_lifetime_value(s.raw["customers"], s.raw["orders"], s.raw["order_items"])


@_query
def raw_counts(s: Shop) -> DataFrame:
    return profiling.layer_counts(s.raw)


@_query
def raw_columns(s: Shop) -> DataFrame:
    return profiling.union_all(
        [
            profiling.describe(df).select(F.lit(name).alias("table_name"), "*")
            for name, df in s.raw.items()
        ]
    )


@_query
def raw_preview(s: Shop) -> DataFrame:
    return sources.preview(s.raw["customers"], ["customer_code", "email"])


@_query
def issue_counts(s: Shop) -> DataFrame:
    return profiling.issue_counts(s.raw, s.as_of)


@_query
def duplicate_keys(s: Shop) -> DataFrame:
    return profiling.duplicate_keys(s.raw["customers"], "customer_code")


@_query
def duplicate_stats(s: Shop) -> DataFrame:
    return profiling.union_all(
        [
            profiling.duplicate_stats(s.raw[e], ENTITY[e].key).select(F.lit(e).alias("entity"), "*")
            for e in ("payments", "orders", "order_items")
        ]
    )


@_query
def type_mismatches(s: Shop) -> DataFrame:
    found = profiling.type_mismatches(s.raw["products"], "product_code", "unit_price")
    return sources.preview(found, ["product_code", "unit_price"], 20)


@_query
def type_mismatches_all(s: Shop) -> DataFrame:
    return profiling.type_mismatches(s.raw["order_items"], "order_item_id", "unit_price")


@_query
def profile_raw(s: Shop) -> DataFrame:
    return profiling.profile_raw(s.raw, {e: ENTITY[e].key for e in ENTITIES}, s.as_of)


@_query
def q_top_customer_cities_filtered(s: Shop) -> DataFrame:
    return analytics.top_customer_cities(s.filtered, s.dims)


# Staging ------------------------------------------------------------------------------------


def _staging_queries(entity: str) -> None:
    spec = ENTITY[entity]
    _query(lambda s: s.staged(entity).clean, f"stage_{entity}_clean")
    _query(lambda s: s.staged(entity).errors, f"stage_{entity}_errors")
    _query(
        lambda s: staging.quality_counts(s.raw[entity], spec, s.as_of), f"stage_{entity}_reasons"
    )


for _entity in ENTITIES:
    _staging_queries(_entity)


@_query
def stage_products_content_first(s: Shop) -> DataFrame:
    return s.staged("products", CONTENT_FIRST).clean


@_query
def stage_products_content_first_errors(s: Shop) -> DataFrame:
    return s.staged("products", CONTENT_FIRST).errors


@_query
def stage_customers_content_first(s: Shop) -> DataFrame:
    return s.staged("customers", CONTENT_FIRST).clean


def _spoiled_verdicts(s: Shop, strict: bool) -> DataFrame:
    return profiling.union_all(
        [
            staging.quality_counts(testdata.spoiled(s.raw[e], e), ENTITY[e], s.as_of, strict=strict).select(
                F.lit(e).alias("entity"), "*"
            )
            for e in ENTITIES
        ]
    )


@_query
def spoiled_reasons(s: Shop) -> DataFrame:
    """Verdicts where keys are missing and numbers unreadable."""
    return _spoiled_verdicts(s, strict=False)


@_query
def spoiled_strict_reasons(s: Shop) -> DataFrame:
    """The same where quantities and amounts must be numbers as well."""
    return _spoiled_verdicts(s, strict=True)


@_query
def spoiled_order_items_clean(s: Shop) -> DataFrame:
    """The order items that are kept under the strict rules."""
    spoiled = testdata.spoiled(s.raw["order_items"], "order_items")
    return staging.landed(spoiled, ENTITY["order_items"], s.as_of, strict=True).clean


@_query
def reason_counts(s: Shop) -> DataFrame:
    """Breakdowns of the three reject logs that the validation report lists."""
    return profiling.union_all(
        [
            staging.reason_counts(s.staged(e).errors).select(F.lit(e).alias("entity"), "*")
            for e in ("payments", "order_items", "orders")
        ]
    )


@_query
def staging_counts(s: Shop) -> DataFrame:
    return reconcile.staging_counts(s.raw, s.as_of)


# Functions ----------------------------------------------------------------------------------


@_query
def mask_policies(s: Shop) -> DataFrame:
    email, phone = F.col("email"), F.col("phone")
    return s.raw["customers"].select(
        "customer_code", "email", "phone",
        *[mask(email).alias(f"email_{name}") for name, mask in masking.EMAIL_MASKS.items()],
        *[mask(phone).alias(f"phone_{name}") for name, mask in masking.PHONE_MASKS.items()],
    )


@_query
def typed_values(s: Shop) -> DataFrame:
    """Each cast over whole raw columns that hold good and bad text."""
    item = s.raw["order_items"]
    return item.select(
        "order_item_id", "line_amount",
        casts.to_money(F.col("unit_price")).alias("money"),
        casts.to_number(F.col("quantity")).cast("double").alias("number"),
        F.coalesce(casts.to_whole(F.col("line_amount")), F.lit(0)).alias("whole"),
        p.type_mismatch("unit_price").alias("mismatch"),
        F.coalesce(p.negative("quantity"), F.lit(False)).alias("is_negative"),
        p.blank("quantity").alias("is_blank"),
        p.is_orphan("order_id").alias("is_orphan"),
    )


@_query
def typed_dates(s: Shop) -> DataFrame:
    at = casts.to_timestamp(F.col("order_date"))
    return s.raw["orders"].select(
        "order_id", "order_date",
        at.alias("at"),
        F.coalesce(casts.date_key(at), F.lit(0)).alias("date_sk"),
        casts.month_start(at).alias("month"),
        casts.iso_text(at).alias("iso"),
        F.coalesce(p.future("order_date", s.as_of), F.lit(False)).alias("is_future"),
    )


@_query
def money_labels(s: Shop) -> DataFrame:
    spend = analytics.customer_spend(s.fact, s.dims)
    return spend.select(
        "customer_code",
        text.inr_label(F.col("spend")).alias("label"),
        text.inr_label(F.col("spend"), decimals=0, gap="").alias("short_label"),
    )


@_query
def business_keys(s: Shop) -> DataFrame:
    return s.raw.base["customer"].select(
        "c_custkey",
        text.business_key("C", 7, F.col("c_custkey")).alias("customer_code"),
        text.business_key("P", 6, F.col("c_custkey")).alias("product_code"),
        text.business_key("OI", 9, F.col("c_custkey")).alias("order_item_id"),
    )


# Warehouse ----------------------------------------------------------------------------------


@_query
def dim_date(s: Shop) -> DataFrame:
    """The calendar over the span of the clean orders."""
    return dims.calendar(dims.date_spine_of(s.clean("orders"), "order_date"))


@_query
def dim_product(s: Shop) -> DataFrame:
    return s.dims.product


@_query
def dim_location(s: Shop) -> DataFrame:
    return s.dims.location


@_query
def dim_customer(s: Shop) -> DataFrame:
    return s.dims.customer


@_query
def fact_sales(s: Shop) -> DataFrame:
    return s.fact


@_query
def fact_rejects(s: Shop) -> DataFrame:
    return fact.fact_rejects(s.clean("order_items"), s.clean("orders"), s.dims.customer, s.dims.product)


@_query
def fact_by_month(s: Shop) -> DataFrame:
    """Rows per fact partition."""
    return sinks.clustered(s.fact).groupBy("year_month").agg(F.count(F.lit(1)).alias("n"))


@_query
def star(s: Shop) -> DataFrame:
    return fact.star(s.fact, s.dims).select(
        "order_item_id", "year", "month_name", "category", "location_city", "customer_code",
        "customer_city", "email_masked", "line_amount",
    )


# Reports ------------------------------------------------------------------------------------


@_query
def q_monthly_revenue(s: Shop) -> DataFrame:
    return analytics.monthly_revenue(s.fact, s.dims)


@_query
def q_category_revenue(s: Shop) -> DataFrame:
    return analytics.category_revenue(s.fact, s.dims)


@_query
def q_top_customer_cities(s: Shop) -> DataFrame:
    return analytics.top_customer_cities(s.fact, s.dims)


@_query
def q_top_order_cities(s: Shop) -> DataFrame:
    return analytics.top_order_cities(s.fact, s.dims)


@_query
def q_top_cities_display(s: Shop) -> DataFrame:
    return analytics.display_order(analytics.top_customer_cities(s.fact, s.dims))


@_query
def q_spend_segments(s: Shop) -> DataFrame:
    return analytics.segment_counts(analytics.spend_segments(s.fact, s.dims))


@_query
def q_customer_segments(s: Shop) -> DataFrame:
    return analytics.spend_segments(s.fact, s.dims)


@_query
def q_line_amount_histogram(s: Shop) -> DataFrame:
    return analytics.line_amount_histogram(s.fact, 30)


@_query
def q_line_amount_histogram_40(s: Shop) -> DataFrame:
    return analytics.line_amount_histogram(s.fact, 40)


@_query
def q_kpis(s: Shop) -> DataFrame:
    return analytics.kpis(s.fact, s.dims)


@_query
def q_kpis_filtered(s: Shop) -> DataFrame:
    return analytics.kpis(s.filtered, s.dims)


@_query
def q_monthly_revenue_filtered(s: Shop) -> DataFrame:
    return analytics.monthly_revenue(s.filtered, s.dims)


@_query
def q_category_revenue_filtered(s: Shop) -> DataFrame:
    return analytics.category_revenue(analytics.apply_filters(s.fact, s.dims, year=FILTER_YEAR), s.dims)


@_query
def q_top_order_cities_filtered(s: Shop) -> DataFrame:
    return analytics.top_order_cities(analytics.apply_filters(s.fact, s.dims, FILTER_CATEGORY), s.dims)


@_query
def q_spend_segments_filtered(s: Shop) -> DataFrame:
    return analytics.segment_counts(analytics.spend_segments(s.filtered, s.dims))


@_query
def q_line_amount_histogram_filtered(s: Shop) -> DataFrame:
    return analytics.line_amount_histogram(s.filtered, 30)


@_query
def filter_choices(s: Shop) -> DataFrame:
    return analytics.filter_choices(s.fact, s.dims)


# History ------------------------------------------------------------------------------------


@_query
def customers_refresh(s: Shop) -> DataFrame:
    return s.refresh


@_query
def scd2_apply(s: Shop) -> DataFrame:
    return s.customers_after(scd2.REFERENCE)


@_query
def scd2_null_safe(s: Shop) -> DataFrame:
    return s.customers_after(scd2.NULL_SAFE)


@_query
def scd2_twice(s: Shop) -> DataFrame:
    """A second run on an unchanged source changes nothing."""
    once = s.customers_after(scd2.REFERENCE)
    return scd2.scd2_apply(once, s.refresh, s.as_of, scd2.REFERENCE)


@_query
def scd2_history(s: Shop) -> DataFrame:
    """One customer moves: the staged city is updated, and both versions are listed."""
    moved = update_where(
        s.clean("customers"), F.col("customer_code") == HISTORY_CODE, {"city": F.lit("Porto")}
    )
    return scd2.history(scd2.scd2_apply(s.dims.customer, moved, s.as_of), HISTORY_CODE)


@_query
def scd2_published(s: Shop) -> DataFrame:
    """The published dimension after two refreshes from one source, of which the second changes nothing."""
    layers = Layers(s.spark, shared_dir(s.spark, "customers-refresh"))
    layers.replace(DW, "dim_customer", s.dims.customer)
    staged = layers.replace(STAGING, "refresh", s.refresh)
    full_load.refresh_customers(layers, staged, testdata.AS_OF)
    full_load.refresh_customers(layers, staged, testdata.AS_OF)
    return layers.table(DW, "dim_customer")


def _after_refresh(s: Shop) -> dims.Dims:
    return dims.Dims(s.dims.date, s.dims.product, s.dims.location, s.customers_after(scd2.REFERENCE))


@_query
def q_top_customer_cities_after_refresh(s: Shop) -> DataFrame:
    """Old sales keep their old customer version, which the report leaves out."""
    return analytics.top_customer_cities(s.fact, _after_refresh(s))


@_query
def q_customer_spend_all_versions(s: Shop) -> DataFrame:
    """With all versions joined, no sale loses its customer."""
    return analytics.customer_spend(s.fact, _after_refresh(s), current_only=False)


# Increments ---------------------------------------------------------------------------------


@_query
def incremental_orders(s: Shop) -> DataFrame:
    return s.increment().added


@_query
def incremental_orders_validated(s: Shop) -> DataFrame:
    return s.increment(validate=True).orders_clean


@_query
def watermarks_after(s: Shop) -> DataFrame:
    """The moved control table beside the newest order loaded so far."""
    done = s.increment()
    newest = done.orders_clean.agg(F.max("order_date").alias("at")).scalar()
    return done.watermarks.withColumn("newest_order", newest)


@_query
def increment_delta(s: Shop) -> DataFrame:
    return incremental.increment_delta(s.loaded_before, s.increment().orders_clean)


def _simulated(s: Shop) -> DataFrame:
    """Raw orders with one order that arrives just before the run."""
    arrival = s.spark.createDataFrame(
        [(SIM_ORDER, HISTORY_CODE, testdata.AS_OF, "BOOKED", "Lisbon", "Estremadura")],
        s.raw["orders"].schema,
    )
    return s.raw["orders"].unionByName(arrival)


@_query
def simulated_increment(s: Shop) -> DataFrame:
    """Orders of the last ten minutes are pulled after the arrival of a new one."""
    ten_minutes_ago = s.as_of - F.expr("INTERVAL 10 MINUTES")
    marks = incremental.set_watermark(sources.seed_watermarks(s.spark), ten_minutes_ago)
    return incremental.incremental_orders(_simulated(s), s.clean("orders"), marks, s.as_of).added


@_query
def simulated_reset(s: Shop) -> DataFrame:
    """Taking the simulated order out again leaves the raw orders as they were."""
    return delete_where(_simulated(s), F.col("order_id") == SIM_ORDER)


# Planted defects ----------------------------------------------------------------------------


@_query
def inject_profile(s: Shop) -> DataFrame:
    return inject.planted(s.injected)


@_query
def inject_reasons(s: Shop) -> DataFrame:
    return profiling.union_all(
        [
            staging.quality_counts(df, ENTITY[name], s.as_of, CONTENT_FIRST).select(
                F.lit(name).alias("entity"), "*"
            )
            for name, df in s.injected.items()
        ]
    )


@_query
def reconcile_planted(s: Shop) -> DataFrame:
    """The profile document is written, read back, and compared with what staging detects."""
    path = shared_dir(s.spark, "profile")
    inject.profile_of(s.injected, SEED).coalesce(1).write.json(path)
    detected = reconcile.staging_counts(s.injected, s.as_of, CONTENT_FIRST)
    return reconcile.reconcile(sources.read_profile(s.spark, path), detected)


# Files --------------------------------------------------------------------------------------


@_query
def csv_round_trip(s: Shop) -> DataFrame:
    """Raw customers written as CSV and read back by position."""
    path = shared_dir(s.spark, "customers")
    sinks.write_raw(s.raw["customers"], path)
    return sources.rename_positional(sources.read_positional(s.spark, f"{path}/csv"), "customers")


@_query
def csv_by_name(s: Shop) -> DataFrame:
    """Shuffled raw order items written as CSV and read back with the raw schema."""
    path = shared_dir(s.spark, "order-items")
    sinks.write_raw(inject.shuffle(s.raw["order_items"], SEED), path)
    return sources.read_raw(s.spark, f"{path}/csv", "order_items")


def _customer_pages(s: Shop) -> paging.Pages:
    return paging.build_pages(s.dims.customer, ["customer_code"], shared_dir(s.spark, "pages"))


@_query
def paged_export(s: Shop) -> DataFrame:
    """The second page of the customer dimension."""
    return _customer_pages(s).page(limit=350, offset=350)


@_query
def all_pages(s: Shop) -> DataFrame:
    """Every customer with the page it is exported on."""
    return _customer_pages(s).numbered(350).select("page", "customer_sk", "customer_code")


@_query
def dimension_csv(s: Shop) -> DataFrame:
    """The customer dimension exported as CSV and read back with its types."""
    path = shared_dir(s.spark, "dimension")
    sinks.export_csv(s.dims.customer, path)
    return s.spark.read.schema(SCHEMAS[DW]["dim_customer"]).csv(path, header=True, quote='"', escape='"')


def _torn(s: Shop) -> str:
    """Raw orders as lines of text, some with a field too many and some with one too few."""
    path = shared_dir(s.spark, "torn")
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in s.raw["orders"].columns])
    turn = F.substring("order_id", 2, 99).cast("int") % 50
    torn = F.when(turn == 7, F.concat(line, F.lit(",extra"))).when(turn == 9, F.regexp_replace(line, ",[^,]*$", "")).otherwise(line)
    lines = s.raw["orders"].select(torn.alias("value"))
    lines.write.text(path)
    return path


@_query
def csv_malformed(s: Shop) -> DataFrame:
    """Lines with too many or too few fields go to the reject log as they are; the others are read."""
    rows, malformed = sources.read_checked(s.spark, _torn(s), "orders", header=False)
    rejects = sources.malformed_rejects(malformed, s.as_of)
    read = rows.select(F.to_json(F.struct(*rows.columns)).alias("row_data"), F.lit("read").alias("reason"))
    return read.unionByName(rejects.select("row_data", "reason"))


@_query
def rejected_fields(s: Shop) -> DataFrame:
    """Typed fields of the rejected order items, out of the reject log."""
    fields = {"order_item_id": "string", "product_code": "string", "quantity": "bigint", "unit_price": "decimal(18,2)"}
    return staging.rejected_fields(s.staged("order_items").errors, fields)


@_query
def fact_clustered(s: Shop) -> DataFrame:
    """The days of each month's files where the fact is clustered by ranges; files that overlap are counted."""
    layers = Layers(s.spark, shared_dir(s.spark, "clustered"))
    full_load.full_load(layers, s.raw, testdata.AS_OF, fact_by=sinks.RANGE)
    return sinks.month_spans(sinks.file_spans(full_load.open_fact(layers))).drop("files")


def _published(s: Shop) -> Layers:
    layers = Layers(s.spark, shared_dir(s.spark, "warehouse"))
    full_load.full_load(layers, s.raw, testdata.AS_OF, fact_by="year_month")
    return layers


@_query
def fact_published(s: Shop) -> DataFrame:
    """The fact as a full load publishes it, without its partition column."""
    return full_load.open_fact(_published(s)).drop("year_month")


@_query
def q_monthly_revenue_published(s: Shop) -> DataFrame:
    """The monthly report on published tables."""
    layers = _published(s)
    return analytics.monthly_revenue(full_load.open_fact(layers), full_load.open_dims(layers))


@_query
def full_load_counts(s: Shop) -> DataFrame:
    """Row counts of every table that a full load publishes."""
    layers = _published(s)
    names = [(STAGING, f"{e}_{kind}") for e in ENTITIES for kind in ("clean", "errors")]
    names += [(DW, n) for n in ("dim_customer", "dim_product", "dim_location", "dim_date", "fact_sales")]
    return profiling.layer_counts(dict(zip([name for _, name in names], layers.tables(*names))))


def _after_arrival(s: Shop) -> Layers:
    """A warehouse over the orders up to the watermark, and what it becomes when the others arrive."""
    layers = Layers(s.spark, shared_dir(s.spark, "arrivals"))
    at = casts.to_timestamp(F.col("order_date"))
    early = F.coalesce(at <= casts.moment(testdata.WATERMARK), F.lit(False))
    for entity, rows in s.raw.items():
        arrivals.land(layers, entity, rows.filter(early) if entity == "orders" else rows)
    full_load.full_load(layers, None, testdata.WATERMARK, fact_by="year_month")
    arrivals.land(layers, "orders", s.raw["orders"].filter(~early))
    arrivals.increment(layers, testdata.AS_OF)
    arrivals.refresh_warehouse(layers, testdata.AS_OF)
    return layers


@_query
def orders_after_arrival(s: Shop) -> DataFrame:
    """The published clean orders after two arrivals, of which the second is read alone."""
    return _after_arrival(s).table(STAGING, "orders_clean")


@_query
def fact_after_increment(s: Shop) -> DataFrame:
    """The fact after an increment: only the months of new sales are written anew."""
    return full_load.open_fact(_after_arrival(s)).drop("year_month")


@_query
def arrival_files(s: Shop) -> DataFrame:
    """What the log of consumed files says was read, by consumer and table."""
    log = _after_arrival(s).table(STAGING, "load_arrivals")
    return log.groupBy("consumer", "table_name").agg(
        F.count_distinct("folder").alias("folders"), F.sum("n_rows").alias("n_rows")
    )


@_query
def customers_after_reload(s: Shop) -> DataFrame:
    """Customers loaded, refreshed, and loaded again with some new: a code keeps the number it had first."""
    layers = Layers(s.spark, shared_dir(s.spark, "reload"))
    staged = {e: s.clean(e) for e in ("orders", "order_items", "products")}
    for name, rows in staged.items():
        layers.replace(STAGING, f"{name}_clean", rows)
    layers.replace(STAGING, "customers_clean", s.clean("customers"))
    full_load.load_warehouse(layers, fact_by="year_month")
    full_load.refresh_customers(layers, s.refresh, testdata.AS_OF)
    added = s.clean("customers").withColumn("customer_code", F.concat(F.lit("A"), F.substring("customer_code", 2, 99)))
    layers.replace(STAGING, "customers_clean", s.clean("customers").unionByName(added.filter(F.col("city") == RELOAD_CITY)))
    full_load.load_warehouse(layers, fact_by="year_month")
    return layers.table(DW, "dim_customer").select("customer_sk", "customer_code")


@_query
def load_counts(s: Shop) -> DataFrame:
    """Clean rows and rejects by entity, as a full load counted them while it wrote."""
    return reconcile.loaded_counts(_published(s).table(STAGING, "load_counts"))


@_query
def load_reasons(s: Shop) -> DataFrame:
    """Rows by verdict, as a full load counted them while it wrote."""
    return _published(s).table(STAGING, "load_counts")


def _streamed(s: Shop, batches: int = 4) -> str:
    """The raw orders as arriving files, loaded in several batches; the folder of the result.

    There are as many files as the session has shuffle partitions. Rows of one key arrive in one file, since of
    rows in different batches the first to arrive stays, and of those in one batch the first in rank.
    """
    path, raw = shared_dir(s.spark, "arrivals"), s.raw["orders"]
    files = max(batches, int(s.spark.conf.get("spark.sql.shuffle.partitions")))
    spread = F.when(F.col("order_id").isNull(), F.xxhash64(*raw.columns))
    raw.repartition(files, "order_id", spread).write.parquet(path)
    out = shared_dir(s.spark, "stream")
    stream.stream_orders(s.spark, path, out, f"{out}/checkpoint", s.as_of, -(-files // batches))
    return out


@_query
def stream_orders(s: Shop) -> DataFrame:
    """The order rules and keyed deduplication as a stream over arriving raw orders."""
    return stream.loaded_orders(s.spark, _streamed(s))


@_query
def stream_order_errors(s: Shop) -> DataFrame:
    """What the stream rejects, with the reasons."""
    return stream.rejected_orders(s.spark, _streamed(s))


def _published_increment(s: Shop) -> Layers:
    """Staging loaded with the orders up to the watermark, and the increment after it, published."""
    layers = Layers(s.spark, shared_dir(s.spark, "increment"))
    raw = s.raw["orders"]
    at = casts.to_timestamp(F.col("order_date"))
    full_load.load_staging(layers, {"orders": raw.filter(at <= casts.moment(testdata.WATERMARK))}, s.as_of)
    marks = incremental.set_watermark(sources.seed_watermarks(s.spark), casts.moment(testdata.WATERMARK))
    layers.replace(STAGING, "load_watermarks", marks)
    full_load.increment(layers, raw, testdata.AS_OF)
    return layers


@_query
def increment_published(s: Shop) -> DataFrame:
    """The clean orders after a load and an increment, read back from the published table."""
    return _published_increment(s).table(STAGING, "orders_clean")


@_query
def increment_errors(s: Shop) -> DataFrame:
    """Rejects of a load and an increment by reason, without those dated after the run."""
    return staging.reason_counts(_published_increment(s).table(STAGING, "orders_errors"))
