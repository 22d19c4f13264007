"""Declarative description of collections and the tables they feed.

A new collection or target is added by writing another ``CollectionSpec``; no
function has to be edited and no Python runs per row.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Target:
    """One table fed by a collection.

    ``reads`` names the document fields it needs. ``columns`` maps a target column to a SQL expression over ``key`` (the
    document's id under that name) and the spec's document fields. ``inserted_at`` names the column that
    keeps the first-seen time, ``changed_at`` the one holding the last change.
    """

    database: str
    table: str
    key: str
    reads: tuple[str, ...]
    columns: tuple[tuple[str, str], ...]
    changed_at: str
    inserted_at: str | None = None


@dataclass(frozen=True)
class CollectionSpec:
    """Rules of one source collection; ``fields`` are (name, SQL type) pairs read from the document."""

    name: str
    required: tuple[str, ...] = ()
    known: tuple[str, ...] = ()
    fields: tuple[tuple[str, str], ...] = ()
    targets: tuple[Target, ...] = ()

    def __post_init__(self) -> None:
        if len({target.key for target in self.targets}) > 1:
            raise ValueError(f"the targets of {self.name} must name their key alike")

    @property
    def key(self) -> str:
        return self.targets[0].key if self.targets else "doc_id"


ORDERS_FLAT = Target(
    database="analytics",
    table="orders_flat",
    key="order_id",
    reads=("customer_id", "status", "city", "total"),
    columns=(
        ("customer_id", "customer_id"),
        ("status", "status"),
        ("city", "city"),
        ("total", "total"),
    ),
    inserted_at="created_at",
    changed_at="updated_at",
)

TRANSACTIONS = Target(
    database="finance",
    table="transactions",
    key="order_id",
    reads=("status", "total"),
    columns=(
        ("txn_id", "concat('txn-', order_id)"),
        ("amount", "total"),
        ("status", "status"),
    ),
    changed_at="recorded_at",
)

# Documented for the source pipeline but never created there; kept as JSON text
# of the whole array per order and unfolded on read (operators.items).
LINE_ITEMS = Target(
    database="analytics",
    table="line_items",
    key="order_id",
    reads=("items",),
    columns=(("items", "items"),),
    changed_at="recorded_at",
)

# Required and known fields per collection.
ORDERS = CollectionSpec(
    name="orders",
    required=("customer_id", "status"),
    known=("_id", "customer_id", "status", "city", "total", "items"),
    fields=(
        ("customer_id", "string"),
        ("status", "string"),
        ("city", "string"),
        ("total", "double"),
        ("items", "string"),
    ),
    targets=(ORDERS_FLAT, TRANSACTIONS),
)
PRODUCTS = CollectionSpec(
    name="products",
    required=("sku", "price"),
    known=("_id", "sku", "name", "price", "qty_on_hand"),
)

SPECS = (ORDERS, PRODUCTS)


def fields_read(*targets: Target) -> list[str]:
    """Document fields that any of the targets needs."""
    return list(dict.fromkeys(name for target in targets for name in target.reads))
