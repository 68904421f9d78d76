"""Star profile: five flat dimensions and a fact that keeps every staging row."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions import (
    broken_rules,
    loose_double,
    loose_int,
    money,
    unusable,
    us_date,
)
from salesmart.operators import BROADCAST_ROWS, attach_key, dense_id, ranked_id, representative
from salesmart.workspace import Workspace


@dataclass(frozen=True)
class Dimension:
    """A dimension as data: its columns, where they come from, and what identifies a row."""

    id: str
    keys: tuple[str, ...]
    #: column -> staging column
    columns: dict[str, str]
    #: column -> parser, for the columns that are not plain text
    parsers: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    #: the rows of a key are many, its keys few, see `representative`
    few_keys: bool = True

    def parse(self, name: str) -> Column:
        source = F.col(self.columns[name])
        return (self.parsers[name](source) if name in self.parsers else source).alias(name)


# Columns and natural keys of the dimensions.
DIMENSIONS = {
    "customer_dim": Dimension(
        id="customer_id",
        keys=("email",),
        columns={
            "first_name": "customer_first_name",
            "last_name": "customer_last_name",
            "age": "customer_age",
            "email": "customer_email",
            "country": "customer_country",
            "postal_code": "customer_postal_code",
            "pet_type": "customer_pet_type",
            "pet_name": "customer_pet_name",
            "pet_breed": "customer_pet_breed",
            "pet_category": "pet_category",
        },
        parsers={"age": loose_int},
        few_keys=False,
    ),
    "seller_dim": Dimension(
        id="seller_id",
        keys=("email",),
        columns={
            "first_name": "seller_first_name",
            "last_name": "seller_last_name",
            "email": "seller_email",
            "country": "seller_country",
            "postal_code": "seller_postal_code",
        },
    ),
    "product_dim": Dimension(
        id="product_id",
        keys=("name", "category", "brand"),
        columns={
            "name": "product_name",
            "category": "product_category",
            "price": "product_price",
            "quantity": "product_quantity",
            "weight": "product_weight",
            "color": "product_color",
            "size": "product_size",
            "brand": "product_brand",
            "material": "product_material",
            "description": "product_description",
            "rating": "product_rating",
            "reviews": "product_reviews",
            "release_date": "product_release_date",
            "expiry_date": "product_expiry_date",
        },
        parsers={
            "price": loose_double, "quantity": loose_int, "weight": loose_double,
            "rating": loose_double, "reviews": loose_int,
        },
    ),
    "store_dim": Dimension(
        id="store_id",
        keys=("name", "city"),
        columns={
            "name": "store_name",
            "location": "store_location",
            "city": "store_city",
            "state": "store_state",
            "country": "store_country",
            "phone": "store_phone",
            "email": "store_email",
        },
    ),
    "supplier_dim": Dimension(
        id="supplier_id",
        keys=("name", "email"),
        columns={
            "name": "supplier_name",
            "contact": "supplier_contact",
            "email": "supplier_email",
            "phone": "supplier_phone",
            "address": "supplier_address",
            "city": "supplier_city",
            "country": "supplier_country",
        },
    ),
}

# Measures of the fact as column -> (staging column, parser).
MEASURES = {
    "sale_date": ("sale_date", us_date),
    "quantity": ("sale_quantity", loose_int),
    "total_price": ("sale_total_price", money),
}

# Dimensions that tend to be small come first: their broadcast joins shorten the rows before
# the larger ones, which may have to shuffle them.
JOIN_ORDER = ["store_dim", "seller_dim", "supplier_dim", "product_dim", "customer_dim"]


def picked(staging: DataFrame, name: str, workspace: Workspace | None = None) -> DataFrame:
    """One row per natural key; NULL is a key too. With a workspace to work in, they are
    picked faster."""
    spec = DIMENSIONS[name]
    rows = staging.select(F.col("id").alias("_id"), *[spec.parse(column) for column in spec.columns])
    space = {"few_keys" if spec.few_keys else "many_keys": workspace.child(f"few_keys/{name}")} if workspace else {}
    return representative(rows, spec.keys, list(spec.columns), first_by="_id", **space)


def dimension(picked_rows: DataFrame, name: str, by_key: Workspace | None = None) -> DataFrame:
    """The stored `picked` rows with a dense id: the rank by md5 of the key or, given a workspace to
    work in, by the key itself."""
    spec = DIMENSIONS[name]
    if by_key:
        return ranked_id(picked_rows, spec.keys, spec.id, by_key.child(name))
    return dense_id(picked_rows, spec.keys, spec.id)


def link(rows: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Left-join the five ids to rows that still hold the natural keys under staging names."""
    for name in JOIN_ORDER:
        spec = DIMENSIONS[name]
        on = {spec.columns[key]: key for key in spec.keys}
        rows = attach_key(rows, dims[name], on, spec.id, "left", spec.id, BROADCAST_ROWS)
    return rows


def natural_keys() -> list[str]:
    """Staging columns the fact is linked by."""
    return [spec.columns[key] for spec in DIMENSIONS.values() for key in spec.keys]


def linked(
    staging: DataFrame, dims: Mapping[str, DataFrame], kept: Sequence[str] = ("id",)
) -> DataFrame:
    """Every staging row with its measures and five ids; an unknown or NULL key gives a NULL id.

    Stored, it gives the fact and its rejects without another join: beside the fact's columns it
    has the ``broken`` rules of the row's values and the ``kept`` columns as ``_<name>``.
    """
    parsers = dict(MEASURES.values())
    rules = {source: parser(F.col(source)) for source, parser in parsers.items()}
    for spec in DIMENSIONS.values():
        rules |= {spec.columns[column]: spec.parse(column) for column in spec.parsers}
    rows = staging.select(
        *[F.col(name).alias(f"_{name}") for name in kept],
        *[parser(F.col(source)).alias(column) for column, (source, parser) in MEASURES.items()],
        broken_rules({f"bad_{s}": unusable(v, s) for s, v in rules.items()}).alias("broken"),
        *natural_keys(),
    )
    ids = [spec.id for spec in DIMENSIONS.values()]
    return link(rows, dims).select(*[f"_{name}" for name in kept], *ids, *MEASURES, "broken")


def linked_fact(linked: DataFrame) -> DataFrame:
    """The fact, one row per row of the stored `linked` rows."""
    return linked.select(*[spec.id for spec in DIMENSIONS.values()], *MEASURES)


def sales_fact(staging: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """One row per staging row; an unknown or NULL natural key gives a NULL id."""
    return linked_fact(linked(staging, dims, kept=()))


def dimensions(
    staging: DataFrame, workspace: Workspace, target: Workspace | None = None, by_key: bool = False
) -> dict[str, DataFrame]:
    """The five dimensions, stored in ``target``. ``staging`` is scanned once per table. Ids are ranks
    by md5 of the natural key or, if ``by_key``, by the key itself."""
    rows = workspace.child("picked").store_all(DIMENSIONS, lambda name: picked(staging, name, workspace))
    ranked = workspace.child("ranked") if by_key else None
    return (target or workspace).store_all(
        DIMENSIONS, lambda name: dimension(rows[name], name, ranked)
    )


def build(
    staging: DataFrame,
    workspace: Workspace,
    target: Workspace | None = None,
    dims: Mapping[str, DataFrame] | None = None,
    linked: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All six tables, stored in ``target``, by default the workspace. ``dims`` and ``linked`` are
    the stored results of `dimensions` and `linked`, if there are any already."""
    tables = dict(dims or dimensions(staging, workspace, target))
    fact = sales_fact(staging, tables) if linked is None else linked_fact(linked)
    tables["sales_fact"] = (target or workspace).store("sales_fact", fact)
    return tables
