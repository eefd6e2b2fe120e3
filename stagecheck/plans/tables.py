"""The ten retail tables: columns, keys, references, hash columns, cleaning steps and routing."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame

from stagecheck.operators import cleaning
from stagecheck.spec import Column, ForeignKey, TableSpec

# Fixed value: stands for a time that is not known.
UNKNOWN_TIME = "1900-01-01 00:00:00"


def _int(name: str, required: bool = True) -> Column:
    return Column(name, "int", required)


def _text(name: str, length: int, required: bool = True) -> Column:
    return Column(name, "string", required, length)


def _money(name: str) -> Column:
    return Column(name, "decimal(10,2)")


def _time(name: str) -> Column:
    return Column(name, "timestamp")


def _flag(name: str) -> Column:
    return Column(name, "boolean")


def _spec(
    name: str, columns: list[Column], references: dict[str, str] | None = None, unhashed: tuple[str, ...] = (),
    **more,
) -> TableSpec:
    return TableSpec(
        name=name,
        columns=tuple(columns),
        foreign_keys=tuple(ForeignKey(column, parent) for column, parent in (references or {}).items()),
        hash_columns=tuple(c.name for c in columns if c.name not in unhashed),
        **more,
    )


def fan_out_categories(df: DataFrame) -> DataFrame:
    """Secondary categories of a product, one row each, with ids of their own."""
    return cleaning.explode_list(
        df, "pre_id", "pre_id_category_secondary", key_name="pre_id_prod", item_name="pre_id_cat", id_name="pre_id",
    )


_category_steps = (
    partial(cleaning.parse_and_shift, columns=["pre_created_at", "pre_modified_at"], hours=8),
    partial(cleaning.null_to_default, defaults={"pre_created_at": UNKNOWN_TIME, "pre_modified_at": UNKNOWN_TIME}),
    partial(cleaning.blank_to_default, defaults={"pre_modified_by": "1"}),
)
_product_steps = (partial(cleaning.blank_to_default, defaults={"pre_id_category_parent_minor": "0"}),)

_ALL = (
    _spec("CUSTOMER_DETAILS", [
        _int("id"), _text("first_name", 64), _text("last_name", 128, False), _text("email", 128),
        _text("password", 128), Column("dob", "date"), _text("telephone", 16, False),
        _text("member_card_sn", 16, False), _money("points"), _time("created_at"), _time("modified_at"),
    ]),
    _spec("CUSTOMER_PURCHASE_INSTANCE", [
        _int("id"), _int("id_cust"), _money("points_gained"), _money("points_used"), _time("created_at"),
    ], {"id_cust": "CUSTOMER_DETAILS"}),
    _spec("STAFF_DETAILS", [
        _int("id"), _text("first_name", 64), _text("last_name", 128, False), _text("email", 128),
        _text("password", 128), _text("telephone", 16), _time("created_at"), _time("modified_at"),
    ]),
    _spec("PRODUCT_BRAND", [
        _int("id"), _text("name", 64), _flag("active"), _time("created_at"), _time("modified_at"), _int("modified_by"),
    ], {"modified_by": "STAFF_DETAILS"}),
    _spec("PRODUCT_CATEGORY", [
        _int("id"), _text("name", 64), _text("image_url", 256, False), _flag("active"), _time("created_at"),
        _time("modified_at"), _int("modified_by"),
    ], {"modified_by": "STAFF_DETAILS"}, unhashed=("created_at", "modified_at", "modified_by"),
        steps=_category_steps),
    _spec("PRODUCT_COUNTRY", [_int("id"), _text("name", 64)]),
    _spec("PRODUCT_DETAILS", [
        _int("id"), _int("id_brand"), _int("id_country"), _int("id_category_primary"),
        _int("id_category_parent_major"), _int("id_category_parent_minor", False), _text("name", 128),
        _money("price"), _text("display_unit", 32), _text("description", 5120, False),
        _text("key_information", 5120, False), *[_int(f"rating_{stars}") for stars in range(1, 6)],
        _text("image_url", 256, False), _flag("active"), _time("created_at"), _time("modified_at"),
        _int("modified_by"),
    ], {
        "id_brand": "PRODUCT_BRAND", "id_country": "PRODUCT_COUNTRY", "id_category_primary": "PRODUCT_CATEGORY",
        "id_category_parent_major": "PRODUCT_CATEGORY", "id_category_parent_minor": "PRODUCT_CATEGORY",
        "modified_by": "STAFF_DETAILS",
    }, unhashed=("price", "id_category_parent_minor"), steps=_product_steps),
    TableSpec(
        "PRODUCT_SECONDARY_CATEGORY", (_int("id"), _int("id_prod"), _int("id_cat")),
        foreign_keys=(ForeignKey("id_prod", "PRODUCT_DETAILS"),), steps=(fan_out_categories,),
        file_columns=("id", "id_category_secondary"), carries_file_hash=False, excluded=True,
        own_numbers="pre_id",
    ),
    _spec("CUSTOMER_PURCHASE_INSTANCE_ITEMS", [
        _int("id"), _int("id_inst"), _int("id_prod"), _int("quantity"), _money("price"),
    ], {"id_inst": "CUSTOMER_PURCHASE_INSTANCE", "id_prod": "PRODUCT_DETAILS"}, unhashed=("price",)),
    _spec("CUSTOMER_CART_ITEMS", [_int("id"), _int("id_cust"), _int("id_prod"), _int("quantity")],
          {"id_cust": "CUSTOMER_DETAILS", "id_prod": "PRODUCT_DETAILS"}),
)

SPECS: dict[str, TableSpec] = {spec.name: spec for spec in _ALL}

# A file feeds the table it is named after; the product file feeds one more.
ROUTING: dict[str, tuple[str, ...]] = {
    **{name: (name,) for name in SPECS},
    "PRODUCT_DETAILS": ("PRODUCT_DETAILS", "PRODUCT_SECONDARY_CATEGORY"),
    "PRODUCT_SECONDARY_CATEGORY": (),
}


def spec_for(table: str) -> TableSpec:
    if table not in SPECS:
        raise ValueError(f"table {table!r} is not declared; known: {sorted(SPECS)}")
    return SPECS[table]
