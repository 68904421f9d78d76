"""Snowflake profile: six lookup dimensions, five entity dimensions and a strict fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions import (
    broken_rules,
    guarded_decimal,
    guarded_int,
    or_empty,
    unusable,
    us_date,
)
from salesmart.operators import BROADCAST_ROWS, attach_key, dense_id, position_id, ranked_id, representative
from salesmart.schemas import SNOWFLAKE_TABLES
from salesmart.workspace import Workspace


@dataclass(frozen=True)
class Outrigger:
    """Distinct tuples of ``columns`` (column -> staging column), missing values as ''."""

    id: str
    columns: dict[str, str]


@dataclass(frozen=True)
class Entity:
    """One representative row per natural key, pointing at outriggers."""

    #: natural key, as staging columns
    keys: tuple[str, ...]
    #: staging columns that are kept, in the order that breaks ties between rows of a key
    columns: tuple[str, ...]
    #: those of ``columns`` in which NULL becomes ''
    empty: tuple[str, ...]
    #: own column -> staging column
    output: dict[str, str]
    #: foreign key -> outrigger
    outriggers: dict[str, str]
    #: leave rows with a NULL key out
    known_only: bool = True
    #: the rows of a key are many, its keys few, see `representative`
    few_keys: bool = True


# Columns of the outriggers.
OUTRIGGERS = {
    "dim_address_customer": Outrigger(
        "address_id", {"country": "customer_country", "postal_code": "customer_postal_code"}
    ),
    "dim_pet_info": Outrigger(
        "pet_id",
        {
            "type": "customer_pet_type",
            "name": "customer_pet_name",
            "breed": "customer_pet_breed",
            "category": "pet_category",
        },
    ),
    "dim_address_seller": Outrigger(
        "address_id", {"country": "seller_country", "postal_code": "seller_postal_code"}
    ),
    "dim_address_store": Outrigger(
        "address_id", {"city": "store_city", "state": "store_state", "country": "store_country"}
    ),
    "dim_address_supplier": Outrigger(
        "address_id",
        {
            "address_line": "supplier_address",
            "city": "supplier_city",
            "country": "supplier_country",
        },
    ),
    "dim_category_product": Outrigger("category_id", {"name": "product_category"}),
}

# Natural keys and columns of the entities.
ENTITIES = {
    "dim_customer": Entity(
        keys=("customer_email",),
        columns=(
            "customer_first_name", "customer_last_name", "customer_age", "customer_email",
            "customer_country", "customer_postal_code",
            "customer_pet_type", "customer_pet_name", "customer_pet_breed", "pet_category",
        ),
        empty=(
            "customer_country", "customer_postal_code",
            "customer_pet_type", "customer_pet_name", "customer_pet_breed", "pet_category",
        ),
        output={
            "first_name": "customer_first_name",
            "last_name": "customer_last_name",
            "age": "customer_age",
            "email": "customer_email",
        },
        outriggers={"address_id": "dim_address_customer", "pet_id": "dim_pet_info"},
        few_keys=False,
    ),
    "dim_seller": Entity(
        keys=("seller_email",),
        columns=(
            "seller_first_name", "seller_last_name", "seller_email",
            "seller_country", "seller_postal_code",
        ),
        empty=("seller_country", "seller_postal_code"),
        output={
            "first_name": "seller_first_name",
            "last_name": "seller_last_name",
            "email": "seller_email",
        },
        outriggers={"address_id": "dim_address_seller"},
    ),
    "dim_product": Entity(
        keys=("product_name", "product_category", "product_brand"),
        columns=(
            "product_name", "product_category", "product_brand",
            "product_price", "product_quantity", "product_weight",
            "product_color", "product_size", "product_material", "product_description",
            "product_rating", "product_reviews", "product_release_date", "product_expiry_date",
        ),
        empty=(
            "product_category", "product_brand",
            "product_color", "product_size", "product_material", "product_description",
        ),
        output={
            "name": "product_name",
            "price": "product_price",
            "quantity": "product_quantity",
            "brand": "product_brand",
            "weight": "product_weight",
            "color": "product_color",
            "size": "product_size",
            "material": "product_material",
            "description": "product_description",
            "rating": "product_rating",
            "reviews_count": "product_reviews",
            "released_on": "product_release_date",
            "expires_on": "product_expiry_date",
        },
        outriggers={"category_id": "dim_category_product"},
        known_only=False,
    ),
    "dim_store": Entity(
        keys=("store_name", "store_city", "store_country"),
        columns=(
            "store_name", "store_location", "store_phone", "store_email",
            "store_city", "store_state", "store_country",
        ),
        empty=("store_location", "store_city", "store_state", "store_country"),
        output={
            "name": "store_name",
            "location_detail": "store_location",
            "phone": "store_phone",
            "email": "store_email",
        },
        outriggers={"address_id": "dim_address_store"},
        known_only=False,
    ),
    "dim_supplier": Entity(
        keys=("supplier_email",),
        columns=(
            "supplier_name", "supplier_contact", "supplier_email", "supplier_phone",
            "supplier_address", "supplier_city", "supplier_country",
        ),
        empty=("supplier_address", "supplier_city", "supplier_country"),
        output={
            "name": "supplier_name",
            "contact": "supplier_contact",
            "email": "supplier_email",
            "phone": "supplier_phone",
        },
        outriggers={"address_id": "dim_address_supplier"},
    ),
}

# The staging columns by which a sale finds its dimensions. The store is found by
# name and full address, so a sale in another state than the store's own finds none. Small
# dimensions and the store, which loses the most rows, come first, so that the joins with
# larger ones see fewer and shorter rows.
FACT_LINKS = {
    "dim_store": ("store_name", "store_city", "store_state", "store_country"),
    "dim_seller": ("seller_email",),
    "dim_supplier": ("supplier_email",),
    "dim_product": ("product_name", "product_category", "product_brand"),
    "dim_customer": ("customer_email",),
}

# Measures of the fact as column -> staging column.
MEASURES = {
    "sale_date": "sale_date",
    "quantity": "sale_quantity",
    "total_price": "sale_total_price",
}


def within_limit(text: Column, sql_type: str) -> Column:
    """The text; it raises where it is longer than a varchar type allows."""
    limit = int(sql_type[len("varchar("):-1])
    error = F.raise_error(F.lit(f"a value is longer than {sql_type}"))
    return F.when(F.length(text) > limit, error).otherwise(text)


def parsed(table: str, column: str, source: str, strict: bool = False) -> Column:
    """Staging text as the type that ``table`` declares for ``column``."""
    sql_type = dict(SNOWFLAKE_TABLES[table])[column]
    text = F.col(source)
    if sql_type == "int":
        text = guarded_int(text, strict)
    elif sql_type == "date":
        text = us_date(text, strict)
    elif sql_type.startswith("decimal"):
        precision, scale = sql_type[len("decimal("):-1].split(",")
        text = guarded_decimal(text, int(precision), int(scale), strict)
    elif sql_type.startswith("varchar") and strict:
        text = within_limit(text, sql_type)
    return text.alias(column)


def picked(staging: DataFrame, name: str, workspace: Workspace | None = None) -> DataFrame:
    """The rows of an outrigger or entity, still as staging text and without an id. With a
    workspace to work in, those of an entity are picked faster."""
    if name in OUTRIGGERS:
        columns = OUTRIGGERS[name].columns.items()
        tuples = [or_empty(F.col(source)).alias(column) for column, source in columns]
        return staging.select(*tuples).distinct()
    spec = ENTITIES[name]
    rows = staging.select(
        F.col("id").alias("_id"),
        *[
            or_empty(F.col(column)).alias(column) if column in spec.empty else F.col(column)
            for column in spec.columns
        ],
    )
    if spec.known_only:
        for key in spec.keys:
            rows = rows.where(F.col(key).isNotNull())
    space = {"few_keys" if spec.few_keys else "many_keys": workspace.child(f"few_keys/{name}")} if workspace else {}
    return representative(rows, spec.keys, spec.columns, first_by="_id", **space)


def numbered(picked_rows: DataFrame, name: str, by_key: Workspace | None = None) -> DataFrame:
    """The stored `picked` rows with a dense id; an outrigger is complete with that. The id is the
    rank by md5 of the key or, given a workspace to work in, by the key itself."""
    def with_id(keys: Sequence[str], column: str) -> DataFrame:
        if by_key:
            return ranked_id(picked_rows, keys, column, by_key.child(name))
        return dense_id(picked_rows, keys, column)

    if name in OUTRIGGERS:
        spec = OUTRIGGERS[name]
        return with_id(list(spec.columns), spec.id).select(spec.id, *spec.columns)
    return with_id(ENTITIES[name].keys, "id")


def checked_outrigger(rows: DataFrame, name: str) -> DataFrame:
    """The `numbered` rows of an outrigger; text beyond its declared length raises."""
    return rows.select(*[
        parsed(name, column, column, strict=True) if column in OUTRIGGERS[name].columns else column
        for column in rows.columns
    ])


def entity(
    keys: Mapping[str, DataFrame], name: str, strict: bool = False
) -> DataFrame:
    """The `numbered` rows of an entity with typed values and foreign keys."""
    spec = ENTITIES[name]
    linked = keys[name]
    for foreign, table in spec.outriggers.items():
        on = {source: column for column, source in OUTRIGGERS[table].columns.items()}
        linked = attach_key(linked, keys[table], on, OUTRIGGERS[table].id, "inner", foreign)
    values = [parsed(name, column, source, strict) for column, source in spec.output.items()]
    return linked.select("id", *values, *spec.outriggers)


def link_columns() -> list[Column]:
    """The staging columns the fact is linked by, with '' where the entity has it."""
    return [
        or_empty(F.col(name)).alias(name) if name in ENTITIES[table].empty else F.col(name)
        for table, names in FACT_LINKS.items()
        for name in names
    ]


def foreign_key(table: str) -> str:
    return table.removeprefix("dim_") + "_id"


def link(rows: DataFrame, keys: Mapping[str, DataFrame], how: str) -> DataFrame:
    """Join the five ids to rows that still hold the `link_columns`.

    The `numbered` rows still hold the natural keys, and being stored tables they have a known
    size; a join of an entity with its outriggers would be planned as if it were huge.
    """
    for table, names in FACT_LINKS.items():
        on = {name: name for name in names}
        rows = attach_key(
            rows, keys[table], on, "id", how, foreign_key(table), BROADCAST_ROWS
        )
    return rows


def fact_rows(staging: DataFrame, keys: Mapping[str, DataFrame], strict: bool = False) -> DataFrame:
    """The fact without its own id; a row that lacks any of the five dimensions is dropped."""
    measures = [parsed("fact_sales", column, source, strict) for column, source in MEASURES.items()]
    rows = staging.select(*measures, *link_columns())
    ids = [column for column, _ in SNOWFLAKE_TABLES["fact_sales"] if column.endswith("_id")]
    return link(rows, keys, "inner").select(*MEASURES, *ids)


def linked(
    staging: DataFrame, keys: Mapping[str, DataFrame], kept: Sequence[str] = ("id",)
) -> DataFrame:
    """Every staging row with its five ids, NULL where a dimension is missing.

    Stored, it gives the fact and its rejects without another join: it has the measures as text,
    the ``broken`` rules of the row's values, and the ``kept`` columns as ``_<name>``.
    """
    values = {("fact_sales", column): source for column, source in MEASURES.items()}
    for name, spec in ENTITIES.items():
        values |= {(name, column): source for column, source in spec.output.items()}
    rules = {
        f"bad_{source}": unusable(parsed(table, column, source), source)
        for (table, column), source in values.items()
        if not dict(SNOWFLAKE_TABLES[table])[column].startswith(("varchar", "string"))
    }
    own = [f"_{name}" for name in kept]
    rows = staging.select(
        *[F.col(name).alias(f"_{name}") for name in kept], *MEASURES.values(),
        broken_rules(rules).alias("broken"), *link_columns(),
    )
    ids = [foreign_key(table) for table in FACT_LINKS]
    return link(rows, keys, "left").select(*own, *MEASURES.values(), *ids, "broken")


def store_linked(
    workspace: Workspace, staging: DataFrame, keys: Mapping[str, DataFrame],
    kept: Sequence[str] = ("id",),
) -> DataFrame:
    """The `linked` rows, stored apart by whether they are ``complete``, that is in the fact.

    So a row's place in its file is its place in the fact, and the fact's ids are known before the
    fact is written: it is written once.
    """
    rows = linked(staging, keys, kept)
    ids = [foreign_key(table) for table in FACT_LINKS]
    complete = reduce(and_, [F.col(name).isNotNull() for name in ids])
    return workspace.store("linked", rows.withColumn("complete", complete), partition_by=["complete"])


def linked_fact(linked: DataFrame, strict: bool = False) -> DataFrame:
    """The fact, with its ids, out of the rows of `store_linked`."""
    columns = [column for column, _ in SNOWFLAKE_TABLES["fact_sales"]]
    measures = {name: parsed("fact_sales", name, source, strict) for name, source in MEASURES.items()}
    rows = position_id(linked.where("complete"), "id")
    return rows.select("id", *measures.values(), *[c for c in columns if c.endswith("_id")])


def number(
    staging: DataFrame, workspace: Workspace, by_key: bool = False
) -> dict[str, DataFrame]:
    """The stored `numbered` rows of all outriggers and entities."""
    names = [*ENTITIES, *OUTRIGGERS]
    rows = workspace.child("picked").store_all(names, lambda name: picked(staging, name, workspace))
    ranked = workspace.child("ranked") if by_key else None
    return workspace.child("numbered").store_all(
        names, lambda name: numbered(rows[name], name, ranked)
    )


def build(
    staging: DataFrame,
    workspace: Workspace,
    strict: bool = False,
    keys: Mapping[str, DataFrame] | None = None,
    linked: DataFrame | None = None,
    target: Workspace | None = None,
) -> dict[str, DataFrame]:
    """All twelve tables, stored in the workspace. ``staging`` is scanned once per table.

    ``strict=True`` raises on a value that has the right shape but does not fit its type, on
    a date that does not exist, and so on; by default such a value is NULL, and text beyond its
    declared length stays and is left to the audit. ``keys`` and ``linked`` are the stored results
    of `number` and `store_linked`, if there are any already. With a ``target`` the tables are
    stored there; only the lookups, which later joins read, are in the workspace too.
    """
    keys = keys or number(staging, workspace)
    if strict:
        tables = (target or workspace.child("checked")).store_all(
            OUTRIGGERS, lambda name: checked_outrigger(keys[name], name)
        )
    elif target:
        tables = target.store_all(OUTRIGGERS, lambda name: keys[name])
    else:
        tables = {name: keys[name] for name in OUTRIGGERS}
    tables |= (target or workspace).store_all(ENTITIES, lambda name: entity(keys, name, strict))
    if linked is None:
        linked = store_linked(workspace, staging, keys, kept=())
    tables["fact_sales"] = (target or workspace).store("fact_sales", linked_fact(linked, strict))
    return tables
