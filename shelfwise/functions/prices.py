"""Variant and price expressions for the two platforms (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.schemas import WOO_VARIANT


def amount(text: Column) -> Column:
    """Text to double; null and blank give null, anything unreadable gives null too."""
    return F.nullif(text, F.lit("")).try_cast("double")


def unreadable(text: Column) -> Column:
    """True for a text that is present but no number."""
    return (text != "") & text.try_cast("double").isNull() & text.isNotNull()


def _filled(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


# --- Shopify -------------------------------------------------------------------------


def shopify_variants(raw: Column) -> Column:
    """Normalise an array of raw variants; a missing array counts as empty."""

    def normalise(v: Column) -> Column:
        return F.struct(
            F.coalesce(v["id"], F.lit("")).alias("variant_id"),
            F.coalesce(v["title"], F.lit("")).alias("title"),
            F.coalesce(v["sku"], F.lit("")).alias("sku"),
            F.coalesce(amount(v["price"]), F.lit(0.0)).alias("price"),
            amount(v["compare_at_price"]).alias("compare_at_price"),
            F.coalesce(
                amount(v["inventory_quantity"]).try_cast("int"), F.lit(0)
            ).alias("inventory_quantity"),
            F.coalesce(v["available"], F.lit(False)).alias("available"),
        )

    return F.transform(F.coalesce(raw, F.array()), normalise)


def shopify_price(variants: Column) -> tuple[Column, Column]:
    """(price, promotional price) from normalised variants.

    The lowest compare-at price is the list price when it lies above the lowest price;
    the lowest price is then the promotion.
    """
    current = F.coalesce(F.array_min(variants["price"]), F.lit(0.0))
    compare = F.array_min(variants["compare_at_price"])
    reduced = F.coalesce(compare > current, F.lit(False))
    return F.when(reduced, compare).otherwise(current), F.when(reduced, current)


def shopify_in_stock(variants: Column) -> Column:
    return F.array_contains(variants["available"], F.lit(True))


def shopify_bad_amount(raw: Column) -> Column:
    """True if any raw variant holds an amount that is no number."""
    return F.exists(
        F.coalesce(raw, F.array()),
        lambda v: unreadable(v["price"])
        | unreadable(v["compare_at_price"])
        | unreadable(v["inventory_quantity"]),
    )


# --- WooCommerce ---------------------------------------------------------------------


def woo_mixed_variants(raw: Column) -> Column:
    """Variations of a product text whose list holds more than objects.

    Such a list does not fit the schema and parses to null; its entries are read one by
    one here and those that are no objects (bare ids) are skipped.
    """
    entries = F.from_json(raw, "variations array<string>")["variations"]
    objects = F.filter(entries, lambda text: text.startswith("{"))
    return F.transform(objects, lambda text: F.from_json(text, WOO_VARIANT))


def _woo_variant_amounts(v: Column, unit: Column) -> tuple[Column, Column]:
    """(price, regular price, null where there is none)."""
    price = F.coalesce(
        amount(F.coalesce(_filled(v["price"]), v["prices"]["price"])) / unit, F.lit(0.0)
    )
    regular = (
        amount(F.coalesce(_filled(v["regular_price"]), v["prices"]["regular_price"])) / unit
    )
    return price, regular


def woo_variants(raw: Column, minor_unit_digits: int = 2) -> Column:
    """Normalise parsed variations, none if missing; amounts are in minor units.

    Amounts are read in a pass of their own: nothing inside a lambda is evaluated only
    once, and each is used several times.
    """
    unit = F.lit(float(10**minor_unit_digits))

    def read(v: Column) -> Column:
        price, regular = _woo_variant_amounts(v, unit)
        return F.struct(v.alias("v"), price.alias("price"), regular.alias("regular"))

    def normalise(found: Column) -> Column:
        v, price = found["v"], found["price"]
        regular = F.coalesce(found["regular"], price)
        return F.struct(
            F.coalesce(v["id"], F.lit("")).alias("variant_id"),
            F.coalesce(v["name"], F.lit("")).alias("title"),
            F.coalesce(v["sku"], F.lit("")).alias("sku"),
            price.alias("price"),
            F.when(regular > price, regular).alias("compare_at_price"),
            F.lit(None).cast("int").alias("inventory_quantity"),
            F.coalesce(v["is_in_stock"], F.lit(True)).alias("available"),
        )

    parsed = F.coalesce(raw, F.array().cast(T.ArrayType(WOO_VARIANT)))
    return F.transform(F.transform(parsed, read), normalise)


def woo_price(product: Column, minor_unit_digits: int = 2) -> tuple[Column, Column]:
    """(price, promotional price) of a parsed product.

    The nested block wins over the flat fields; the regular price wins over the price;
    a sale counts only when it lies above zero and below the price.
    """
    unit = F.lit(float(10**minor_unit_digits))

    def pick(field: str) -> Column:
        return amount(
            F.coalesce(_filled(product["prices"][field]), product[field])
        ) / unit

    price = F.coalesce(pick("regular_price"), pick("price"), F.lit(0.0))
    sale = pick("sale_price")
    return price, F.when((sale > 0) & (sale < price), sale)


def woo_bad_amount(product: Column) -> Column:
    """True if an amount the price rules read is present but no number."""
    bad = F.lit(False)
    for field in ("price", "regular_price", "sale_price"):
        bad = bad | unreadable(
            F.coalesce(_filled(product["prices"][field]), product[field])
        )
    return bad


def stock_status(in_stock: Column) -> Column:
    return F.when(in_stock, "in_stock").otherwise("out_of_stock")
