"""DuckDB SQL for each registered query, written on its own from the rules, not from the plans."""

from __future__ import annotations

from tillhouse.schema import ENTITIES, RAW_COLUMNS
from tillhouse.sources import testdata as t

AS_OF = f"TIMESTAMP '{t.AS_OF}'"
WATERMARK = f"TIMESTAMP '{t.WATERMARK}'"
CATEGORY, YEAR = "ECONOMY", 1997
HISTORY_CODE = "C0000011"
RELOAD_CITY = "NATION_5"
SEED = 23

KEY = {
    "customers": "customer_code",
    "products": "product_code",
    "orders": "order_id",
    "order_items": "order_item_id",
    "payments": "payment_id",
}
MONEY = "TRY_CAST({} AS DECIMAL(18,2))"
STAMP = "TRY_CAST({} AS TIMESTAMP)"


def _money(c: str) -> str:
    return MONEY.format(c)


def _stamp(c: str) -> str:
    return STAMP.format(c)


def _empty(c: str) -> str:
    return f"length(trim(coalesce({c},''))) = 0"


# Unfit rows: condition and reason, first hit counts.
CHECKS = {
    "customers": [
        ("customer_code IS NULL", "missing_customer_code"),
        (_empty("city"), "missing_city"),
        (_empty("email"), "missing_email"),
        ("NOT regexp_matches(phone,'[0-9]')", "phone_type_mismatch"),
        (_empty("full_name"), "missing_name"),
        (f"{_stamp('updated_at')} IS NULL", "invalid_date_format"),
        (f"{_stamp('updated_at')} > {AS_OF}", "future_updated_at"),
    ],
    "products": [
        ("product_code IS NULL", "missing_product_code"),
        (_empty("product_name"), "missing_name"),
        (_empty("category"), "missing_category"),
        (f"{_money('unit_price')} IS NULL", "price_type_mismatch"),
        (f"{_money('unit_price')} < 0", "negative_price"),
    ],
    "orders": [
        ("order_id IS NULL", "missing_order_id"),
        ("customer_code = '__ORPHAN__'", "orphan_customer"),
        (_empty("order_state"), "missing_order_state"),
        (f"{_stamp('order_date')} IS NULL", "invalid_date_format"),
        (f"{_stamp('order_date')} > {AS_OF}", "future_order_date"),
    ],
    "order_items": [
        ("order_item_id IS NULL", "missing_order_item_id"),
        ("order_id = '__ORPHAN__'", "orphan_order"),
        ("product_code = '__ORPHAN__'", "orphan_product"),
        ("quantity IS NULL", "missing_quantity"),
        ("TRY_CAST(quantity AS DOUBLE) < 0", "negative_quantity"),
        (f"{_money('unit_price')} IS NULL", "price_type_mismatch"),
        (f"{_money('unit_price')} < 0", "negative_unit_price"),
        ("line_amount IS NULL", "missing_line_amount"),
        ("TRY_CAST(line_amount AS DOUBLE) < 0", "negative_line_amount"),
    ],
    "payments": [
        ("payment_id IS NULL", "missing_payment_id"),
        ("order_id = '__ORPHAN__'", "orphan_order"),
        (_empty("payment_method"), "missing_payment_method"),
        (f"{_money('payment_amount')} IS NULL", "amount_type_mismatch"),
        (f"{_money('payment_amount')} < 0", "negative_payment_amount"),
        (f"{_stamp('payment_date')} IS NULL", "invalid_date_format"),
        (f"{_stamp('payment_date')} > {AS_OF}", "future_payment_date"),
    ],
}

# Order of the rows of a key: these with NULLs last, then the other columns with NULLs first.
TIES = {
    "customers": ["updated_at", "email"],
    "products": ["product_name", "category", "unit_price"],
    "orders": ["order_date", "customer_code", "status", "order_city"],
    "order_items": ["product_code", "order_id", "quantity", "unit_price", "line_amount"],
    "payments": ["payment_date", "order_id", "payment_amount", "payment_method"],
}
UNFIT_ROWS_COMPETE = {"customers", "products"}

TYPES = {
    "created_at": "TIMESTAMP",
    "updated_at": "TIMESTAMP",
    "order_date": "TIMESTAMP",
    "payment_date": "TIMESTAMP",
    "is_active": "BOOLEAN",
    "unit_price": "DECIMAL(18,2)",
    "line_amount": "DECIMAL(18,2)",
    "payment_amount": "DECIMAL(18,2)",
    "quantity": "BIGINT",
}


STRICT = {
    "order_items": {
        "negative_quantity": ("TRY_CAST(quantity AS DOUBLE) IS NULL", "quantity_type_mismatch"),
        "negative_line_amount": ("TRY_CAST(line_amount AS DOUBLE) IS NULL", "amount_type_mismatch"),
    }
}


def _raw(entity: str) -> str:
    base, lookups = t.INPUTS[entity]
    joins = "".join(f" JOIN {o} ON {left}={right}" for o, left, right in lookups)
    cells = ", ".join(f"{t.EXPRESSIONS[entity][c]} AS {c}" for c in RAW_COLUMNS[entity])
    return f"{entity}_raw AS (SELECT {cells} FROM {base}{joins})"


def _flagged(entity: str, compete: bool, strict: bool = False) -> str:
    # A strict check stands behind the sign check of its column.
    more = STRICT.get(entity, {}) if strict else {}
    checks = [c for check in CHECKS[entity] for c in (check, more.get(check[1])) if c]
    hits = ", ".join(f"CASE WHEN {test} THEN '{why}' END" for test, why in checks)
    rest = [c for c in RAW_COLUMNS[entity] if c not in TIES[entity] and c != KEY[entity]]
    order = [f"{c} ASC NULLS LAST" for c in TIES[entity]] + [f"{c} ASC NULLS FIRST" for c in rest]
    if not compete:
        order.insert(0, "(reason IS NOT NULL)")
    return (
        f"{entity}_flagged AS (SELECT *, row_number() OVER (PARTITION BY {KEY[entity]} "
        f"ORDER BY {', '.join(order)}) AS place FROM "
        f"(SELECT *, coalesce({hits}) AS reason FROM {entity}_raw))"
    )


def _typed(c: str) -> str:
    return f"TRY_CAST({c} AS {TYPES[c]}) AS {c}" if c in TYPES else c


def _clean(entity: str) -> str:
    cells = ", ".join(_typed(c) for c in RAW_COLUMNS[entity])
    return f"{entity}_clean AS (SELECT {cells} FROM {entity}_flagged WHERE reason IS NULL AND place=1)"


def _staging(entity: str, compete: bool | None = None) -> list[str]:
    compete = entity in UNFIT_ROWS_COMPETE if compete is None else compete
    return [_raw(entity), _flagged(entity, compete), _clean(entity)]


def _spoiled(entity: str, strict: bool) -> list[str]:
    cells = ", ".join(f"{t.SPOILED[entity].get(c, c)} AS {c}" for c in RAW_COLUMNS[entity])
    first = _raw(entity).replace(f"{entity}_raw AS", f"{entity}_extract AS", 1)
    return [
        first,
        f"{entity}_raw AS (SELECT {cells} FROM {entity}_extract)",
        _flagged(entity, entity in UNFIT_ROWS_COMPETE, strict),
    ]


def _bucket(key: str) -> str:
    return f"substr(md5({key}),1,3)"


EMAIL = "regexp_replace({0}email, '^(.)([^@]*)(@.*)$', '\\1***\\3')"
PHONE = "repeat('*', greatest(length({0}phone)-4,0)) || right({0}phone,4)"

DIM_CUSTOMER = [
    *_staging("customers"),
    f"""dim_customer AS (SELECT row_number() OVER (ORDER BY {_bucket('customer_code')}, customer_code) AS customer_sk,
  customer_code, full_name, {EMAIL.format('')} AS email_masked, {PHONE.format('')} AS phone_masked, gender, city, state,
  is_active, created_at AS eff_start_date, CAST(NULL AS TIMESTAMP) AS eff_end_date, TRUE AS is_current FROM customers_clean)""",
]
DIM_PRODUCT = [
    *_staging("products"),
    f"""dim_product AS (SELECT row_number() OVER (ORDER BY {_bucket('product_code')}, product_code) AS product_sk,
  product_code, product_name, category, unit_price, is_active FROM products_clean)""",
]
DIM_LOCATION = [
    f"""dim_location AS (SELECT row_number() OVER (ORDER BY {_bucket("city||'|'||state")}, city, state) AS location_sk, city, state
  FROM (SELECT DISTINCT order_city AS city, order_state AS state FROM orders_clean WHERE order_city IS NOT NULL))""",
]
DAY_COLUMNS = """CAST(strftime(d,'%Y%m%d') AS BIGINT) AS date_sk, CAST(d AS DATE)::STRING AS full_date, year(d) AS year,
  quarter(d) AS quarter, month(d) AS month, strftime(d,'%b') AS month_name, day(d) AS day,
  strftime(d,'%a') AS day_of_week, isodow(d) IN (6,7) AS is_weekend"""
DIM_DATE = [
    f"""dim_date AS (SELECT {DAY_COLUMNS} FROM (SELECT DATE '{t.CALENDAR_START}' + CAST(i AS INTEGER) AS d
  FROM range({t.CALENDAR_DAYS}) r(i)))"""
]
FACT = [
    *DIM_CUSTOMER,
    *DIM_PRODUCT,
    *_staging("orders"),
    *_staging("order_items"),
    *DIM_LOCATION,
    """fact_sales AS (SELECT i.order_item_id, i.order_id, c.customer_sk, p.product_sk, l.location_sk,
  CAST(strftime(o.order_date,'%Y%m%d') AS BIGINT) AS date_sk, i.quantity, i.unit_price, i.line_amount, o.status AS order_status
  FROM order_items_clean i JOIN orders_clean o USING (order_id) JOIN dim_customer c USING (customer_code)
  JOIN dim_product p USING (product_code)
  LEFT JOIN dim_location l ON l.city=o.order_city AND l.state=o.order_state)""",
]
STAR = [
    *FACT,
    *DIM_DATE,
    """sales AS (SELECT f.*, d.year, d.month, d.month_name, p.category, l.city AS location_city, c.customer_code,
  c.city AS customer_city, c.email_masked FROM fact_sales f LEFT JOIN dim_date d USING (date_sk)
  LEFT JOIN dim_product p USING (product_sk) LEFT JOIN dim_location l USING (location_sk)
  LEFT JOIN dim_customer c USING (customer_sk))""",
]


def _scd2(safe: bool) -> list[str]:
    def differs(old: str, new: str) -> str:
        return f"{old} IS DISTINCT FROM {new}" if safe else f"coalesce({old} <> {new}, FALSE)"

    known = ", ".join(f"{text} AS {name}" for name, text in t.REFRESH.items())
    arrived = ", ".join(
        f"'N'||substr(customer_code,2) AS {n}" if n == "customer_code" else n for n in t.REFRESH
    )
    change = " OR ".join(
        [differs("d.city", "r.city"), differs("d.email_masked", "r.email_masked"), differs("d.phone_masked", "r.phone_masked")]
    )
    return [
        *DIM_CUSTOMER,
        f"refreshed AS (SELECT {known} FROM customers_clean UNION ALL "
        f"SELECT {arrived} FROM customers_clean WHERE {t.ARRIVALS})",
        f"masked AS (SELECT customer_code, full_name, {EMAIL.format('')} AS email_masked, {PHONE.format('')} AS phone_masked, "
        "gender, city, state, is_active FROM refreshed)",
        f"expired AS (SELECT customer_code FROM dim_customer d JOIN masked r USING (customer_code) WHERE {change})",
        f"""dim_after AS (SELECT customer_sk, customer_code, full_name, email_masked, phone_masked, gender, city, state, is_active,
  eff_start_date, CASE WHEN customer_code IN (FROM expired) THEN {AS_OF} END AS eff_end_date,
  customer_code NOT IN (FROM expired) AS is_current FROM dim_customer
  UNION ALL SELECT (SELECT max(customer_sk) FROM dim_customer) + row_number() OVER (ORDER BY {_bucket('customer_code')}, customer_code),
  customer_code, full_name, email_masked, phone_masked, gender, city, state, is_active, {AS_OF}, CAST(NULL AS TIMESTAMP), TRUE
  FROM masked WHERE customer_code IN (FROM expired) OR customer_code NOT IN (SELECT customer_code FROM dim_customer))""",
    ]


def _with(ctes: list[str], body: str) -> str:
    return f"WITH {', '.join(dict.fromkeys(ctes))} {body}"


def _doubles(entity: str) -> str:
    return ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" if TYPES.get(c, "").startswith("DECIMAL") else c
        for c in RAW_COLUMNS[entity]
    )


def _json(entity: str) -> str:
    cells = ", ".join(f"""'"{c}":"' || {c} || '"'""" for c in RAW_COLUMNS[entity])
    return f"'{{' || concat_ws(',', {cells}) || '}}'"


def _errors(entity: str) -> str:
    return (
        f"SELECT {_json(entity)} AS row_data, coalesce(reason,'duplicate_{KEY[entity]}') AS reason, {AS_OF} AS logged_at "
        f"FROM {entity}_flagged WHERE reason IS NOT NULL OR place>1"
    )


def _verdict(entity: str) -> str:
    return f"coalesce(reason, CASE WHEN place=1 THEN 'clean' ELSE 'duplicate_{KEY[entity]}' END)"


RAW_SALES = [_raw("orders"), _raw("order_items"), _raw("products"), _raw("customers")]
SOLD = f"CAST(sum({_money('line_amount')}) AS DOUBLE)"
DIM_CUSTOMER_COLUMNS = (
    "customer_sk, customer_code, full_name, email_masked, phone_masked, gender, city, state, is_active, "
    "eff_start_date, eff_end_date, is_current"
)
REVENUE = "CAST(sum(line_amount) AS DOUBLE) AS revenue"
IN_SCOPE = f"category='{CATEGORY}' AND year={YEAR}"
INR = """CASE WHEN {0}>=1e7 THEN '₹'||format('{{:,.{1}f}}',{0}/1e7)||'{2}Cr' WHEN {0}>=1e5 THEN '₹'||format('{{:,.{1}f}}',{0}/1e5)||'{2}L'
  ELSE '₹'||format('{{:,.0f}}',{0}) END"""


def _kpis(where: str) -> str:
    return f"""SELECT total_revenue, total_orders, avg_order_value, unique_customers,
  {INR.format('total_revenue', 1, ' ')} AS revenue_text, {INR.format('avg_order_value', 1, ' ')} AS avg_order_text,
  format('{{:,}}', total_orders) AS orders_text
  FROM (SELECT *, CASE WHEN total_orders>0 THEN total_revenue/total_orders ELSE 0.0 END AS avg_order_value FROM (
  SELECT coalesce(CAST(sum(line_amount) AS DOUBLE),0.0) AS total_revenue, count(DISTINCT order_id) AS total_orders,
  count(DISTINCT customer_code) AS unique_customers FROM sales WHERE {where}))"""


def _segments(where: str) -> list[str]:
    return [
        *STAR,
        f"""spend AS (SELECT customer_code, sum(line_amount) AS spend FROM sales
  WHERE customer_code IS NOT NULL AND {where} GROUP BY ALL)""",
        "cuts AS (SELECT quantile_cont(CAST(spend AS DOUBLE), [1/3, 2/3]) AS q FROM spend)",
        """segmented AS (SELECT customer_code, CAST(spend AS DOUBLE) AS spend,
  CASE WHEN spend<=q[1] THEN 'Low' WHEN spend<=q[2] THEN 'Medium' ELSE 'High' END AS segment FROM spend, cuts)""",
    ]


SEGMENT_COUNTS = """SELECT segment, count(*) AS customers, round(count(*)::DOUBLE*100/sum(count(*)) OVER (),1) AS share_pct
  FROM segmented GROUP BY segment"""


def _histogram(bins: int, where: str) -> str:
    return _with(
        STAR
        + [
            f"v AS (SELECT CAST(line_amount AS DOUBLE) AS v FROM sales WHERE line_amount IS NOT NULL AND {where})",
            "lim AS (SELECT min(v) AS lo, max(v) AS hi FROM v)",
            f"""edges AS (SELECT i AS bin, lo + i*((hi-lo)/{bins}.0::DOUBLE) AS bin_start,
  CASE WHEN i={bins - 1} THEN hi ELSE lo + (i+1)*((hi-lo)/{bins}.0::DOUBLE) END AS bin_end FROM range({bins}) r(i), lim)""",
        ],
        f"""SELECT bin, bin_start, bin_end, count(v) AS n,
  CAST(CAST(round_even(bin_start,0) AS BIGINT) AS STRING)||'–'||CAST(CAST(round_even(bin_end,0) AS BIGINT) AS STRING) AS bin_label
  FROM edges LEFT JOIN v ON v>=bin_start AND (v<bin_end OR (bin={bins - 1} AND v<=bin_end)) GROUP BY ALL""",
    )


# Planted defects: an order-dependent draw from a digest of the key.
def _draw(key: str, salt: str, sides: int) -> str:
    return f"(CAST('0x'||substr(md5({key}||'|{SEED}|{salt}'),1,8) AS BIGINT) % {sides})"


KINDS = {
    "customers": ["missing", "future_date", "duplicate_key", "type_mismatch"],
    "products": ["missing", "negative", "duplicate_key", "type_mismatch"],
    "orders": ["orphan", "future_date", "duplicate_key", "missing"],
    "order_items": ["orphan_product", "orphan_order", "negative", "type_mismatch", "duplicate_key"],
    "payments": ["orphan_order", "negative", "type_mismatch", "duplicate_key", "missing"],
}
REASON_OF = {
    "customers": {"missing": "missing_city", "future_date": "future_updated_at", "type_mismatch": "phone_type_mismatch"},
    "products": {"missing": "missing_name", "negative": "negative_price", "type_mismatch": "price_type_mismatch"},
    "orders": {"orphan": "orphan_customer", "future_date": "future_order_date", "missing": "missing_order_state"},
    "order_items": {
        "orphan_product": "orphan_product", "orphan_order": "orphan_order", "negative": "negative_quantity",
        "type_mismatch": "price_type_mismatch",
    },
    "payments": {
        "orphan_order": "orphan_order", "negative": "negative_payment_amount", "type_mismatch": "amount_type_mismatch",
        "missing": "missing_payment_method",
    },
}


def _planted() -> list[str]:
    ctes, parts = [], []
    for e in ENTITIES:
        ctes += _staging(e, compete=False)
        kinds = "[" + ",".join(f"'{k}'" for k in KINDS[e]) + "]"
        parts.append(f"SELECT '{e}' AS entity, 'clean' AS defect FROM {e}_clean")
        parts.append(
            f"SELECT '{e}', {kinds}[1+{_draw(KEY[e], 'kind', len(KINDS[e]))}] FROM {e}_clean "
            f"WHERE {_draw(KEY[e], 'pick', 1000)} < 140"
        )
    return [*ctes, f"planted AS ({' UNION ALL '.join(parts)})"]


def _reason_case() -> str:
    arms = " ".join(
        f"WHEN entity='{e}' AND defect='{d}' THEN '{r}'" for e, m in REASON_OF.items() for d, r in m.items()
    )
    dups = " ".join(f"WHEN entity='{e}' AND defect='duplicate_key' THEN 'duplicate_{KEY[e]}'" for e in ENTITIES)
    return f"CASE WHEN defect='clean' THEN 'clean' {arms} {dups} END"


def _per_entity(template: str, entities: list[str] = ENTITIES) -> str:
    return " UNION ALL ".join(template.format(e=e, key=KEY[e], verdict=_verdict(e)) for e in entities)


def _pulled(raw: str, after: str) -> str:
    at = _stamp("order_date")
    return (
        f"SELECT order_id, customer_code, {at} AS order_date, status, order_city, order_state FROM {raw} "
        f"WHERE customer_code <> '__ORPHAN__' AND {at} > {after} AND {at} <= {AS_OF}"
    )


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # Raw tables
    sold = "JOIN order_items_raw i USING (order_id) WHERE customer_code<>'__ORPHAN__' AND product_code<>'__ORPHAN__'"
    sql["q_raw_monthly_revenue"] = _with(
        RAW_SALES,
        f"SELECT CAST(date_trunc('month', {_stamp('order_date')}) AS DATE)::STRING AS month, {SOLD} AS revenue FROM orders_raw {sold} GROUP BY 1",
    )
    sql["q_raw_top_cities"] = _with(
        RAW_SALES,
        f"""SELECT order_city, {SOLD} AS revenue FROM orders_raw {sold} AND order_city IS NOT NULL GROUP BY 1
  ORDER BY sum({_money('line_amount')}) DESC NULLS FIRST, order_city LIMIT 10""",
    )
    sql["q_raw_top_products"] = _with(
        RAW_SALES,
        f"""SELECT product_name, {SOLD} AS revenue FROM order_items_raw JOIN products_raw USING (product_code)
  WHERE product_code<>'__ORPHAN__' GROUP BY 1 ORDER BY sum({_money('line_amount')}) DESC NULLS FIRST, product_name NULLS LAST LIMIT 10""",
    )
    sql["q_raw_clv"] = _with(
        RAW_SALES,
        f"""SELECT customer_code, full_name, {SOLD} AS lifetime_value FROM customers_raw JOIN orders_raw o USING (customer_code)
  {sold} GROUP BY 1,2 ORDER BY sum({_money('line_amount')}) DESC NULLS FIRST, customer_code, full_name LIMIT 20""",
    )
    all_raw = [_raw(e) for e in ENTITIES]
    sql["raw_counts"] = _with(all_raw, _per_entity("SELECT '{e}' AS table_name, count(*) AS n FROM {e}_raw"))
    sql["raw_columns"] = _with(
        all_raw,
        " UNION ALL ".join(
            f"SELECT '{e}' AS table_name, {i + 1}::BIGINT AS position, '{c}' AS col_name, 'string' AS data_type, "
            f"count(*) AS n_rows, count({c}) AS n_present FROM {e}_raw"
            for e in ENTITIES
            for i, c in enumerate(RAW_COLUMNS[e])
        ),
    )
    sql["raw_preview"] = _with(
        [_raw("customers")], "SELECT * FROM customers_raw ORDER BY customer_code NULLS LAST, email NULLS LAST LIMIT 10"
    )
    sql["issue_counts"] = _with(
        all_raw,
        f"""SELECT 'orphan_orders' AS issue, count(*) AS n FROM orders_raw WHERE customer_code='__ORPHAN__'
  UNION ALL SELECT 'orphan_items', count(*) FROM order_items_raw WHERE product_code='__ORPHAN__'
  UNION ALL SELECT 'negative_quantities', count(*) FROM order_items_raw WHERE TRY_CAST(quantity AS DOUBLE)<0
  UNION ALL SELECT 'orphan_payments', count(*) FROM payments_raw WHERE order_id='__ORPHAN__'
  UNION ALL SELECT 'customers_updated_after_today', count(*) FROM customers_raw WHERE {_stamp('updated_at')} > {AS_OF}""",
    )
    sql["duplicate_keys"] = _with(
        [_raw("customers")],
        """SELECT customer_code, count(*) AS duplicate_count FROM customers_raw GROUP BY 1 HAVING count(*)>1
  ORDER BY 2 DESC, 1 NULLS LAST LIMIT 20""",
    )
    sql["duplicate_stats"] = _with(
        all_raw,
        _per_entity(
            "SELECT '{e}' AS entity, count(*) AS duplicated_keys, CAST(sum(n-1) AS BIGINT) AS extra_rows FROM "
            "(SELECT count(*) AS n FROM {e}_raw GROUP BY {key} HAVING count(*)>1)",
            ["payments", "orders", "order_items"],
        ),
    )
    sql["type_mismatches"] = _with(
        [_raw("products")],
        f"""SELECT product_code, unit_price FROM products_raw WHERE unit_price IS NOT NULL AND {_money('unit_price')} IS NULL
  ORDER BY 1,2 LIMIT 20""",
    )
    sql["type_mismatches_all"] = _with(
        [_raw("order_items")],
        f"SELECT order_item_id, unit_price FROM order_items_raw WHERE unit_price IS NOT NULL AND {_money('unit_price')} IS NULL",
    )

    issues = sql["issue_counts"].split("SELECT 'orphan_orders' AS issue", 1)[1]
    sql["profile_raw"] = _with(
        all_raw,
        f"""SELECT 'orphan_orders' AS metric{issues}
  UNION ALL SELECT 'price_type_mismatches', count(*) FROM products_raw WHERE unit_price IS NOT NULL AND {_money('unit_price')} IS NULL
  UNION ALL {_per_entity("SELECT 'rows_{e}', count(*) FROM {e}_raw")}
  UNION ALL {_per_entity("SELECT 'duplicate_keys_{e}', count(*) FROM (SELECT 1 FROM {e}_raw GROUP BY {key} HAVING count(*)>1)")}""",
    )

    # Staging
    for e in ENTITIES:
        sql[f"stage_{e}_clean"] = _with(_staging(e), f"SELECT {_doubles(e)} FROM {e}_clean")
        sql[f"stage_{e}_errors"] = _with(_staging(e), _errors(e))
        sql[f"stage_{e}_reasons"] = _with(
            _staging(e), f"SELECT {_verdict(e)} AS reason, count(*) AS n FROM {e}_flagged GROUP BY 1"
        )
    verdicts = _per_entity("SELECT '{e}' AS entity, {verdict} AS reason, count(*) AS n FROM {e}_flagged GROUP BY ALL")
    for name, strict in (("spoiled_reasons", False), ("spoiled_strict_reasons", True)):
        sql[name] = _with([c for e in ENTITIES for c in _spoiled(e, strict)], verdicts)
    sql["spoiled_order_items_clean"] = _with(
        [*_spoiled("order_items", True), _clean("order_items")], f"SELECT {_doubles('order_items')} FROM order_items_clean"
    )
    for e in ("products", "customers"):
        sql[f"stage_{e}_content_first"] = _with(_staging(e, compete=False), f"SELECT {_doubles(e)} FROM {e}_clean")
    sql["stage_products_content_first_errors"] = _with(_staging("products", compete=False), _errors("products"))
    every = [c for e in ENTITIES for c in _staging(e)]
    sql["reason_counts"] = _with(
        every,
        _per_entity(
            "SELECT '{e}' AS entity, {verdict} AS reason, count(*) AS cnt FROM {e}_flagged "
            "WHERE reason IS NOT NULL OR place>1 GROUP BY ALL",
            ["payments", "order_items", "orders"],
        ),
    )
    sql["staging_counts"] = _with(
        every,
        _per_entity(
            "SELECT '{e}' AS entity, count(*) FILTER (reason IS NULL AND place=1) AS clean, "
            "count(*) FILTER (reason IS NOT NULL OR place>1) AS errors FROM {e}_flagged"
        ),
    )

    # Functions
    sql["mask_policies"] = _with(
        [_raw("customers")],
        f"""SELECT customer_code, email, phone, {EMAIL.format('')} AS email_first_char,
  CASE WHEN strpos(email,'@')=0 THEN email WHEN strpos(email,'@')<=3 THEN repeat('*',strpos(email,'@')-1)||substr(email,strpos(email,'@'))
  ELSE email[1]||repeat('*',strpos(email,'@')-3)||substr(email,strpos(email,'@')-1) END AS email_keep_length,
  {PHONE.format('')} AS phone_last_four,
  CASE WHEN length(regexp_replace(phone,'[^0-9]','','g'))<4 THEN repeat('*',length(phone)) ELSE {PHONE.format('')} END AS phone_by_digits
  FROM customers_raw""",
    )
    sql["typed_values"] = _with(
        [_raw("order_items")],
        f"""SELECT order_item_id, line_amount, CAST({_money('unit_price')} AS DOUBLE) AS money, TRY_CAST(quantity AS DOUBLE) AS number,
  coalesce(CAST(round({_money('line_amount')},0) AS BIGINT),0) AS whole, unit_price IS NOT NULL AND {_money('unit_price')} IS NULL AS mismatch,
  coalesce(TRY_CAST(quantity AS DOUBLE)<0,FALSE) AS is_negative, {_empty('quantity')} AS is_blank, order_id='__ORPHAN__' AS is_orphan FROM order_items_raw""",
    )
    sql["typed_dates"] = _with(
        [_raw("orders")],
        f"""SELECT order_id, order_date, d AS at, coalesce(CAST(strftime(d,'%Y%m%d') AS BIGINT),0) AS date_sk, CAST(date_trunc('month',d) AS DATE)::STRING AS month,
  strftime(d,'%Y-%m-%d %H:%M:%S') AS iso, coalesce(d>{AS_OF},FALSE) AS is_future FROM (SELECT *, {_stamp('order_date')} AS d FROM orders_raw)""",
    )
    sql["money_labels"] = _with(
        _segments("TRUE"),
        f"""SELECT customer_code, {INR.format('spend', 1, ' ')} AS label, {INR.format('spend', 0, '')} AS short_label FROM segmented""",
    )
    sql["business_keys"] = """SELECT c_custkey, 'C'||lpad(CAST(c_custkey AS STRING),7,'0') AS customer_code,
  'P'||lpad(CAST(c_custkey AS STRING),6,'0') AS product_code, 'OI'||lpad(CAST(c_custkey AS STRING),9,'0') AS order_item_id FROM customer"""

    # Warehouse
    sql["dim_date"] = _with(
        _staging("orders"),
        f"""SELECT {DAY_COLUMNS} FROM (SELECT unnest(generate_series(CAST(min(order_date) AS DATE), CAST(max(order_date) AS DATE),
  INTERVAL 1 DAY)) AS d FROM orders_clean)""",
    )
    sql["dim_product"] = _with(
        DIM_PRODUCT,
        "SELECT product_sk, product_code, product_name, category, CAST(unit_price AS DOUBLE) AS unit_price, is_active FROM dim_product",
    )
    sql["dim_location"] = _with(_staging("orders") + DIM_LOCATION, "SELECT * FROM dim_location")
    sql["dim_customer"] = _with(DIM_CUSTOMER, "SELECT * FROM dim_customer")
    sql["fact_sales"] = _with(
        FACT,
        """SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, CAST(line_amount AS DOUBLE) AS line_amount) FROM fact_sales""",
    )
    sql["fact_rejects"] = _with(
        FACT,
        """SELECT * FROM (SELECT order_item_id, order_id, product_code, CASE
  WHEN order_id NOT IN (SELECT order_id FROM orders_clean) THEN 'order'
  WHEN order_id IN (SELECT order_id FROM orders_clean WHERE customer_code NOT IN (SELECT customer_code FROM dim_customer)) THEN 'customer'
  WHEN product_code NOT IN (SELECT product_code FROM dim_product) THEN 'product' END AS missing_parent FROM order_items_clean)
  WHERE missing_parent IS NOT NULL""",
    )
    sql["fact_by_month"] = _with(FACT, "SELECT date_sk//100 AS year_month, count(*) AS n FROM fact_sales GROUP BY 1")
    sql["star"] = _with(
        STAR,
        """SELECT order_item_id, year, month_name, category, location_city, customer_code, customer_city, email_masked,
  CAST(line_amount AS DOUBLE) AS line_amount FROM sales""",
    )

    # Reports
    def monthly(where: str) -> str:
        return _with(
            STAR,
            f"""SELECT year, month, CAST(year AS STRING)||'-'||lpad(CAST(month AS STRING),2,'0') AS label, {REVENUE}
  FROM sales WHERE year IS NOT NULL AND {where} GROUP BY ALL""",
        )

    def by(column: str, where: str, name: str, k: int | None = 10) -> str:
        top = f"ORDER BY sum(line_amount) DESC NULLS FIRST, {column} LIMIT {k}" if k else ""
        return f"SELECT {column} AS {name}, {REVENUE} FROM sales WHERE {column} IS NOT NULL AND {where} GROUP BY {column} {top}"

    sql["q_monthly_revenue"] = monthly("TRUE")
    sql["q_monthly_revenue_filtered"] = monthly(IN_SCOPE)
    sql["q_category_revenue"] = _with(STAR, by("category", "TRUE", "category", None))
    sql["q_category_revenue_filtered"] = _with(STAR, by("category", f"year={YEAR}", "category", None))
    sql["q_top_customer_cities"] = _with(STAR, by("customer_city", "TRUE", "city"))
    sql["q_top_order_cities"] = _with(STAR, by("location_city", "TRUE", "city"))
    sql["q_top_customer_cities_filtered"] = _with(STAR, by("customer_city", IN_SCOPE, "city"))
    sql["q_top_order_cities_filtered"] = _with(STAR, by("location_city", f"category='{CATEGORY}'", "city"))
    sql["q_top_cities_display"] = _with(
        [*STAR, f"top AS ({by('customer_city', 'TRUE', 'city')})"],
        f"SELECT city, revenue, {INR.format('revenue', 0, '')} AS revenue_text FROM top",
    )
    sql["q_spend_segments"] = _with(_segments("TRUE"), SEGMENT_COUNTS)
    sql["q_spend_segments_filtered"] = _with(_segments(IN_SCOPE), SEGMENT_COUNTS)
    sql["q_customer_segments"] = _with(_segments("TRUE"), "SELECT * FROM segmented")
    sql["q_line_amount_histogram"] = _histogram(30, "TRUE")
    sql["q_line_amount_histogram_40"] = _histogram(40, "TRUE")
    sql["q_line_amount_histogram_filtered"] = _histogram(30, IN_SCOPE)
    sql["q_kpis"] = _with(STAR, _kpis("TRUE"))
    sql["q_kpis_filtered"] = _with(STAR, _kpis(IN_SCOPE))
    sql["filter_choices"] = _with(
        STAR,
        """SELECT DISTINCT 'category' AS "filter", category AS choice FROM sales WHERE category IS NOT NULL
  UNION ALL SELECT DISTINCT 'year', CAST(year AS STRING) FROM sales WHERE year IS NOT NULL""",
    )

    # History
    sql["customers_refresh"] = _with(_scd2(False), "SELECT * FROM refreshed")
    sql["scd2_apply"] = _with(_scd2(False), "SELECT * FROM dim_after")
    sql["scd2_twice"] = sql["scd2_apply"]
    sql["scd2_published"] = sql["scd2_apply"]
    sql["scd2_null_safe"] = _with(_scd2(True), "SELECT * FROM dim_after")
    sql["scd2_history"] = _with(
        DIM_CUSTOMER,
        f"""SELECT customer_code, city, eff_start_date, CASE WHEN city<>'Porto' THEN {AS_OF} END AS eff_end_date, city='Porto' AS is_current
  FROM dim_customer WHERE customer_code='{HISTORY_CODE}'
  UNION ALL SELECT customer_code, 'Porto', {AS_OF}, CAST(NULL AS TIMESTAMP), TRUE FROM dim_customer
  WHERE customer_code='{HISTORY_CODE}' AND city<>'Porto'""",
    )
    sql["q_top_customer_cities_after_refresh"] = _with(
        FACT + _scd2(False),
        f"""SELECT city, {REVENUE} FROM fact_sales JOIN dim_after USING (customer_sk) WHERE is_current AND city IS NOT NULL GROUP BY 1
  ORDER BY sum(line_amount) DESC NULLS FIRST, city LIMIT 10""",
    )
    sql["q_customer_spend_all_versions"] = _with(
        FACT + _scd2(False),
        "SELECT customer_code, CAST(sum(line_amount) AS DOUBLE) AS spend FROM fact_sales JOIN dim_after USING (customer_sk) GROUP BY 1",
    )

    # Increments
    orders = _staging("orders")
    before = f"loaded AS (SELECT * FROM orders_clean WHERE order_date <= {WATERMARK})"
    sql["incremental_orders"] = _with(orders, _pulled("orders_raw", WATERMARK))
    sql["incremental_orders_validated"] = _with(orders, f"SELECT * FROM orders_clean WHERE order_date <= {AS_OF}")
    sql["watermarks_after"] = _with(
        orders + [before],
        f"""SELECT table_name, last_loaded_at, (SELECT max(order_date) FROM (SELECT order_date FROM loaded
  UNION ALL SELECT order_date FROM ({_pulled('orders_raw', WATERMARK)}))) AS newest_order
  FROM (VALUES ('ORDERS', {AS_OF}), ('PAYMENTS', TIMESTAMP '1900-01-01'), ('CUSTOMERS', TIMESTAMP '1900-01-01')) w(table_name, last_loaded_at)""",
    )
    sql["increment_delta"] = _with(
        orders + [before],
        f"""SELECT b AS orders_before, b+a AS orders_after, a AS added FROM (SELECT (SELECT count(*) FROM loaded) AS b,
  (SELECT count(*) FROM ({_pulled('orders_raw', WATERMARK)})) AS a)""",
    )
    sql["simulated_increment"] = _with(
        orders
        + [
            f"""arrived AS (SELECT * FROM orders_raw UNION ALL SELECT 'ARRIVAL-1','{HISTORY_CODE}','{t.AS_OF}','BOOKED','Lisbon','Estremadura')"""
        ],
        _pulled("arrived", f"({AS_OF} - INTERVAL 10 MINUTE)"),
    )
    sql["simulated_reset"] = _with(orders, "SELECT * FROM orders_raw")

    # Planted defects
    sql["inject_profile"] = _with(_planted(), "SELECT entity, defect, count(*) AS n FROM planted GROUP BY ALL")
    sql["inject_reasons"] = _with(
        _planted(), f"SELECT entity, {_reason_case()} AS reason, count(*) AS n FROM planted GROUP BY ALL"
    )
    sql["reconcile_planted"] = _with(
        _planted(),
        """SELECT entity, bad AS planted, total, bad AS detected, 0::BIGINT AS gap, 'match' AS result FROM
  (SELECT entity, count(*) FILTER (defect<>'clean') AS bad, count(*) AS total FROM planted GROUP BY 1)""",
    )

    # Files
    sql["csv_round_trip"] = _with([_raw("customers")], "SELECT * FROM customers_raw")
    sql["csv_by_name"] = _with([_raw("order_items")], "SELECT * FROM order_items_raw")
    sql["paged_export"] = _with(DIM_CUSTOMER, "SELECT * FROM dim_customer ORDER BY customer_code LIMIT 350 OFFSET 350")
    sql["all_pages"] = _with(
        DIM_CUSTOMER, "SELECT (row_number() OVER (ORDER BY customer_code)-1)//350 AS page, customer_sk, customer_code FROM dim_customer"
    )
    sql["dimension_csv"] = _with(DIM_CUSTOMER, "SELECT * FROM dim_customer")
    line = "||','||".join(f"coalesce({c},'')" for c in RAW_COLUMNS["orders"])
    turn = "coalesce(CAST(substr(order_id,2) AS INTEGER) % 50, 0)"
    sql["csv_malformed"] = _with(
        [_raw("orders")],
        f"""SELECT CASE {turn} WHEN 7 THEN '{{"line":"'||{line}||',extra"}}' WHEN 9 THEN '{{"line":"'||regexp_replace({line}, ',[^,]*$', '')||'"}}'
  ELSE {_json('orders')} END AS row_data, CASE WHEN {turn} IN (7, 9) THEN 'malformed_row' ELSE 'read' END AS reason FROM orders_raw""",
    )
    sql["rejected_fields"] = _with(
        _staging("order_items"),
        f"""SELECT {_verdict('order_items')} AS reason, order_item_id, product_code, TRY_CAST(quantity AS BIGINT) AS quantity,
  CAST({_money('unit_price')} AS DOUBLE) AS unit_price FROM order_items_flagged WHERE reason IS NOT NULL OR place>1""",
    )
    sql["fact_clustered"] = _with(
        FACT,
        """SELECT date_sk//100 AS year_month, count(*) AS n, min(date_sk) AS first_day, max(date_sk) AS last_day, 0::BIGINT AS overlaps
  FROM fact_sales GROUP BY 1""",
    )
    counts = [f"SELECT '{e}_clean' AS name, count(*) AS n FROM {e}_clean" for e in ENTITIES]
    counts += [f"SELECT '{e}_errors', count(*) FROM {e}_flagged WHERE reason IS NOT NULL OR place>1" for e in ENTITIES]
    counts += [f"SELECT '{d}', count(*) FROM {d}" for d in ("dim_customer", "dim_product", "dim_location", "fact_sales")]
    counts.append(
        "SELECT 'dim_date', date_diff('day', min(CAST(order_date AS DATE)), max(CAST(order_date AS DATE)))+1 FROM orders_clean"
    )
    sql["full_load_counts"] = _with(
        FACT + _staging("payments"), f"SELECT name AS table_name, n FROM ({' UNION ALL '.join(counts)})"
    )
    sql["fact_published"] = sql["fact_sales"]
    sql["q_monthly_revenue_published"] = sql["q_monthly_revenue"]
    sql["stream_orders"] = _with(orders, "SELECT * FROM orders_clean")
    sql["stream_order_errors"] = _with(orders, _errors("orders"))
    sql["increment_published"] = sql["incremental_orders_validated"]
    # Places get numbers when they are first seen.
    after = [
        f"""early AS (SELECT DISTINCT order_city AS city, order_state AS state FROM orders_clean
  WHERE order_city IS NOT NULL AND order_date <= {WATERMARK})""",
        f"""dim_location AS (SELECT row_number() OVER (ORDER BY {_bucket("city||'|'||state")}, city, state) AS location_sk, city, state FROM early
  UNION ALL SELECT (SELECT count(*) FROM early) + row_number() OVER (ORDER BY {_bucket("city||'|'||state")}, city, state), city, state
  FROM (SELECT order_city AS city, order_state AS state FROM orders_clean WHERE order_city IS NOT NULL EXCEPT SELECT * FROM early))""",
    ]
    sql["fact_after_increment"] = _with(
        [c for cte in FACT for c in (after if cte in DIM_LOCATION else [cte])],
        "SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, CAST(line_amount AS DOUBLE) AS line_amount) FROM fact_sales",
    )
    sql["orders_after_arrival"] = sql["stream_orders"]
    read = [f"SELECT 'staging' AS consumer, '{e}_raw' AS table_name, {1 + (e == 'orders')} AS folders, count(*) AS n_rows FROM {e}_raw" for e in ENTITIES]
    read += [
        f"SELECT 'warehouse', '{e}_clean', {1 + (e == 'orders')}, count(*) FROM {e}_clean" for e in ("orders", "order_items", "products")
    ]
    sql["arrival_files"] = _with(
        FACT + [_raw("payments")], f"SELECT consumer, table_name, CAST(folders AS BIGINT) AS folders, n_rows FROM ({' UNION ALL '.join(read)})"
    )
    sql["customers_after_reload"] = _with(
        _scd2(False),
        f"""SELECT customer_sk, customer_code FROM dim_customer
  UNION ALL SELECT (SELECT max(customer_sk) FROM dim_after) + row_number() OVER (ORDER BY {_bucket('code')}, code), code
  FROM (SELECT 'A'||substr(customer_code,2) AS code FROM customers_clean WHERE city='{RELOAD_CITY}')""",
    )
    sql["load_counts"] = sql["staging_counts"]
    sql["load_reasons"] = _with(
        [c for e in ENTITIES for c in _staging(e)],
        _per_entity("SELECT '{e}' AS entity, {verdict} AS reason, count(*) AS n FROM {e}_flagged GROUP BY ALL"),
    )
    # Orders dated after the run wait for a later one, whatever else is wrong with them.
    sql["increment_errors"] = _with(
        orders,
        f"""SELECT coalesce(reason, 'duplicate_order_id') AS reason, count(*) AS cnt FROM orders_flagged
  WHERE (reason IS NOT NULL OR place>1) AND coalesce(TRY_CAST(order_date AS TIMESTAMP) <= {AS_OF}, TRUE) GROUP BY 1 ORDER BY 2 DESC, 1""",
    )
    return sql
