"""What makes a raw row unfit, per entity. Rules are data; `staging` applies them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillhouse.functions import casts
from tillhouse.functions import predicates as p
from tillhouse.schema import RAW_COLUMNS

Test = Callable[[Column], Column]

REFERENCE, CONTENT_FIRST = "reference", "content_first"


@dataclass(frozen=True)
class Rule:
    """`test` takes the run's point in time and says whether the row is unfit."""

    reason: str
    test: Test
    strict: bool = False


@dataclass(frozen=True)
class Entity:
    """One source table.

    `rank_by` orders the rows of a key in `reference` mode (bad rows compete as well);
    `tie_order` comes next and makes the choice repeatable.
    """

    name: str
    key: str
    rules: tuple[Rule, ...]
    tie_order: tuple[str, ...]
    rank_by: str | None = None
    casts: dict[str, Callable[[Column], Column]] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return RAW_COLUMNS[self.name]

    @property
    def duplicate_reason(self) -> str:
        return f"duplicate_{self.key}"

    @property
    def default_mode(self) -> str:
        return REFERENCE if self.rank_by else CONTENT_FIRST

    def ranked_columns(self) -> list[str]:
        """Rank column and listed ties; NULLs go last in these."""
        return ([self.rank_by] if self.rank_by else []) + list(self.tie_order)

    def total_order(self) -> list[str]:
        """Ranked columns, then every other column: only identical rows stay tied."""
        head = self.ranked_columns()
        return head + [c for c in self.columns if c not in head and c != self.key]

    def reason(self, as_of: Column, strict: bool = False) -> Column:
        """The first rule that holds, or NULL for a fit row."""
        chain = F
        for rule in self.rules:
            if strict or not rule.strict:
                chain = chain.when(rule.test(as_of), F.lit(rule.reason))
        return chain.otherwise(F.lit(None).cast("string"))

    def typed(self) -> list[Column]:
        return [
            (self.casts[c](F.col(c)) if c in self.casts else F.col(c)).alias(c)
            for c in self.columns
        ]


def _fixed(test: Column | Callable[[], Column]) -> Test:
    return lambda _as_of: test()


def _rule(reason: str, predicate: Callable[[str], Column], column: str, strict: bool = False) -> Rule:
    return Rule(reason, _fixed(lambda: predicate(column)), strict)


def _in_future(reason: str, column: str) -> Rule:
    return Rule(reason, lambda as_of: p.future(column, as_of))


def _not_number(name: str) -> Column:
    return p.type_mismatch(name, "decimal(38,10)")


# The reasons, and the order in which the rules are asked.
CUSTOMERS = Entity(
    "customers",
    key="customer_code",
    rank_by="updated_at",
    tie_order=("email",),
    rules=(
        _rule("missing_customer_code", p.missing, "customer_code"),
        _rule("missing_city", p.blank, "city"),
        _rule("missing_email", p.blank, "email"),
        _rule("phone_type_mismatch", p.no_digit, "phone"),
        _rule("missing_name", p.blank, "full_name"),
        _rule("invalid_date_format", p.not_a_date, "updated_at"),
        _in_future("future_updated_at", "updated_at"),
    ),
    casts={
        "created_at": casts.to_timestamp,
        "updated_at": casts.to_timestamp,
        "is_active": casts.to_boolean,
    },
)

PRODUCTS = Entity(
    "products",
    key="product_code",
    rank_by="product_name",
    tie_order=("category", "unit_price"),
    rules=(
        _rule("missing_product_code", p.missing, "product_code"),
        _rule("missing_name", p.blank, "product_name"),
        _rule("missing_category", p.blank, "category"),
        _rule("price_type_mismatch", p.not_money, "unit_price"),
        _rule("negative_price", p.negative_money, "unit_price"),
    ),
    casts={"unit_price": casts.to_money, "is_active": casts.to_boolean},
)

ORDERS = Entity(
    "orders",
    key="order_id",
    tie_order=("order_date", "customer_code", "status", "order_city"),
    rules=(
        _rule("missing_order_id", p.missing, "order_id"),
        _rule("orphan_customer", p.is_orphan, "customer_code"),
        _rule("missing_order_state", p.blank, "order_state"),
        _rule("invalid_date_format", p.not_a_date, "order_date"),
        _in_future("future_order_date", "order_date"),
    ),
    casts={"order_date": casts.to_timestamp},
)

ORDER_ITEMS = Entity(
    "order_items",
    key="order_item_id",
    tie_order=("product_code", "order_id", "quantity", "unit_price", "line_amount"),
    rules=(
        _rule("missing_order_item_id", p.missing, "order_item_id"),
        _rule("orphan_order", p.is_orphan, "order_id"),
        _rule("orphan_product", p.is_orphan, "product_code"),
        _rule("missing_quantity", p.missing, "quantity"),
        _rule("negative_quantity", p.negative, "quantity"),
        _rule("quantity_type_mismatch", _not_number, "quantity", strict=True),
        _rule("price_type_mismatch", p.not_money, "unit_price"),
        _rule("negative_unit_price", p.negative_money, "unit_price"),
        _rule("missing_line_amount", p.missing, "line_amount"),
        _rule("negative_line_amount", p.negative, "line_amount"),
        _rule("amount_type_mismatch", _not_number, "line_amount", strict=True),
    ),
    casts={
        "quantity": casts.to_whole,
        "unit_price": casts.to_money,
        "line_amount": casts.to_money,
    },
)

PAYMENTS = Entity(
    "payments",
    key="payment_id",
    tie_order=("payment_date", "order_id", "payment_amount", "payment_method"),
    rules=(
        _rule("missing_payment_id", p.missing, "payment_id"),
        _rule("orphan_order", p.is_orphan, "order_id"),
        _rule("missing_payment_method", p.blank, "payment_method"),
        _rule("amount_type_mismatch", p.not_money, "payment_amount"),
        _rule("negative_payment_amount", p.negative_money, "payment_amount"),
        _rule("invalid_date_format", p.not_a_date, "payment_date"),
        _in_future("future_payment_date", "payment_date"),
    ),
    casts={"payment_amount": casts.to_money, "payment_date": casts.to_timestamp},
)

ENTITY = {e.name: e for e in (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS, PAYMENTS)}
