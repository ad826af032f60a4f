"""Sold quantity in base units: unit mapping, two-path factors, conversion."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergelane.functions.text import strip_leading_zeros
from mergelane.operators.lookups import lookup, pick_one, priority_lookup


def unit_map(
    units: DataFrame, texts: DataFrame, partner: str = "wholesaler_name", language: str = "EN"
) -> DataFrame:
    """One row per (partner, uom): the converted unit and its internal unit id.

    `units` has uom, converted_uom and the partner column; `texts` has converted_uom, language and
    muom_unit_id. Units without a text in `language` stay, with a null id.
    """
    text = pick_one(texts.filter(F.col("language") == language), ["converted_uom"], [F.col("muom_unit_id")])
    with_id = lookup(units, text, ["converted_uom"], ["muom_unit_id"])
    order = [F.asc_nulls_last("muom_unit_id"), F.asc_nulls_last("converted_uom")]
    return pick_one(with_id, [partner, "uom"], order).select(partner, "uom", "converted_uom", "muom_unit_id")


def converted(amount: Column, numerator: Column, denominator: Column) -> Column:
    """amount * numerator / denominator as a double; null when the denominator is 0 or missing."""
    return F.try_divide(
        amount.cast("double") * numerator.cast("double"), F.nullif(denominator.cast("double"), F.lit(0.0))
    )


class FactorTables(NamedTuple):
    """Factors with one row per EAN and one per article and unit, as `factor_tables` makes them."""

    by_ean: DataFrame
    by_article: DataFrame


def factor_tables(factors: DataFrame, tie_break: Sequence[str] = ()) -> FactorTables:
    """The first factor row by material, unit, EAN, `tie_break` per EAN, and per article and unit."""
    cols = ["muom_denominator_qty", "muom_numerator_qty"]
    order = [
        F.asc_nulls_last(c)
        for c in (
            "muom_material_id", "muom_unit_id", "muom_eanupc_id", "muom_numerator_qty",
            "muom_denominator_qty", *tie_break,
        )
    ]
    base = factors.withColumns({
        "__material": strip_leading_zeros("muom_material_id"),
        "__ean": strip_leading_zeros("muom_eanupc_id"),
    })
    by_ean = pick_one(base, ["__ean"], order)
    by_article = pick_one(base, ["__material", "muom_unit_id"], order)
    return FactorTables(
        by_ean.select("__ean", F.col("__material").alias("__ean_material"), *cols), by_article.select("__material", "muom_unit_id", *cols)
    )


def convert_quantity(
    sales: DataFrame,
    factors: DataFrame | FactorTables,
    units: DataFrame,
    article: str,
    unit: str = "UOM",
    ean: str = "EAN",
    amount: str = "total_amount",
    partner: str = "wholesaler_name",
    out: str = "KgL",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Sales with factors and the converted amount `out`; one output row per sales row.

    `units` is a `unit_map`. `factors` has muom_material_id, muom_unit_id, muom_eanupc_id,
    muom_numerator_qty and muom_denominator_qty. Factors come from the row of the EAN if there is
    one, else from the row of article and unit, each factor falling back on its own. Where the EAN
    row names a material, it replaces `article`. Ids are compared without leading zeros; when several
    factor rows share a key, the first by material, unit, EAN, `tie_break` counts. Where many tables of sales are converted,
    `factors` can be `factor_tables`, made once.
    """
    cols = ["muom_denominator_qty", "muom_numerator_qty"]
    by_ean, by_article = factors if isinstance(factors, FactorTables) else factor_tables(factors, tie_break)
    with_unit = lookup(sales, units, [partner, (unit, "uom")], ["converted_uom", "muom_unit_id"])
    with_factors = priority_lookup(
        with_unit,
        [
            (by_ean, [(strip_leading_zeros(ean), "__ean")]),
            (by_article.withColumn("__ean_material", F.lit(None).cast("string")),
             [(strip_leading_zeros(article), "__material"), ("muom_unit_id", "muom_unit_id")]),
        ],
        [*cols, "__ean_material"],
    )
    return with_factors.withColumns({
        article: F.coalesce(F.col("__ean_material"), F.col(article)),
        out: converted(F.col(amount), F.col("muom_numerator_qty"), F.col("muom_denominator_qty")),
    }).drop("__ean_material")
