"""From mapped partner files to the sales fact: union, cleaning, enrichment."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergelane.functions import dates, text
from mergelane.operators.lookups import pick_one_lookup, zero_key_join
from mergelane.operators.quantity import FactorTables, convert_quantity, factor_tables, unit_map
from mergelane.session import DENSE, discard, materialize, materialize_parts


def clean_sales(df: DataFrame, strict_parity: bool = False) -> DataFrame:
    """Cleaned golden rows: date, country, VAT, EAN and ids in their normal form. No shuffle."""
    coded = dates.parse_date_or_path(df, "date", strict_parity).withColumn(
        "customer_country", text.normalize_country("customer_country")
    )
    return text.normalize_vat_column(coded, "vat_number", "customer_country").withColumns({
        "customer_postal_code": text.strip_float_suffix("customer_postal_code"),
        "product_number": text.strip_float_suffix("product_number"),
        "customer_number": text.strip_float_suffix("customer_number"),
        "EAN": text.normalize_ean("EAN"),
    })


# The columns of a sale that the fact keeps.
SALE_COLUMNS = (
    "customer_number", "product_number", "article_name", "EAN", "total_amount", "wholesaler_name",
    "date", "full_file_path", "UOM", "wholesaler_id",
)


# Sales that are looked up at a time, and portions at most: each of them reads all of the sales and records.
PORTION_SALES = 5_000_000
MOST_PORTIONS = 8


def enrich_sales(
    sales: DataFrame,
    accounts: DataFrame,
    material_records: DataFrame,
    units: DataFrame,
    unit_texts: DataFrame,
    factors: DataFrame,
    record_order: Sequence[Column] | None = None,
    article: str = "cumi_customermaterialnumber_id",
) -> DataFrame:
    """The sales fact: CRM customer, material record, unit and quantity in kg or l for every sale.

    All five dimensions are reduced to one row per key before they are joined, so the fact keeps its
    row count and is never windowed. `record_order` ranks material records that share a key (by
    material id if unset). `article` is the id that the article path of the conversion uses.

    Every lookup shuffles the sales it is given. So more sales than PORTION_SALES are dealt by their product number to portions,
    which are looked up and written one after the other: the shuffle files of one go before the next one's come. Sales and
    dimensions are written to the shared folder before. Jobs run while it is planned.
    """
    needed = ["cumi_material_id", "cumi_customermaterialnumber_id"]
    if record_order is None:
        record_order = [F.asc_nulls_last(c) for c in needed]
        material_records = material_records.select(*needed, "cumi_customernumber_id")
    sales = materialize(sales.select(*SALE_COLUMNS), "sales", DENSE)
    portions = min(math.ceil(sales.count() / PORTION_SALES), MOST_PORTIONS)
    unit = materialize(unit_map(units, unit_texts), "units")
    made = factor_tables(factors)
    if portions <= 1:
        return _enriched(sales, accounts, material_records, unit, made, record_order, article)

    records, made = materialize(material_records, "records", DENSE), FactorTables(*[materialize(d, "factors") for d in made])
    product, held = text.strip_leading_zeros("product_number"), text.strip_leading_zeros("cumi_customermaterialnumber_id")
    # Sales without a product number find no record, so they are dealt out by all their columns.
    number = F.coalesce(product, F.xxhash64(*SALE_COLUMNS).cast("string"))
    at = lambda key, i: F.pmod(F.xxhash64(key), F.lit(portions)) == i
    parts = (
        _enriched(sales.filter(at(number, i)), accounts, records.filter(at(held, i)), unit, made, record_order, article)
        for i in range(portions)
    )
    fact = materialize_parts(parts, "sales-fact", DENSE)
    for table in (sales, records, unit, *made):
        discard(table)
    return fact


def _enriched(
    sales: DataFrame,
    accounts: DataFrame,
    records: DataFrame,
    units: DataFrame,
    factors: FactorTables,
    record_order: Sequence[Column],
    article: str,
) -> DataFrame:
    fact = zero_key_join(
        sales, accounts, [("wholesaler_id", "c4cu_account_id")], ["c4cu_customer_id"],
        order=[F.asc_nulls_last("c4cu_customer_id")],
    )
    stripped = text.strip_leading_zeros
    fact = pick_one_lookup(
        fact, records,
        [(stripped("product_number"), stripped("cumi_customermaterialnumber_id")),
         (stripped("c4cu_customer_id"), stripped("cumi_customernumber_id"))],
        ["cumi_material_id", "cumi_customermaterialnumber_id"], record_order,
    )
    fact = convert_quantity(fact, factors, units, article)
    # What follows from the sale's own columns comes last, so that no lookup shuffles it.
    more = {"dimdateid": dates.date_key("date"), "sharepoint_file_name": text.file_name("full_file_path")}
    found = [c for c in fact.columns if c not in SALE_COLUMNS]
    return fact.withColumns(more).select(*SALE_COLUMNS, *more, *found)
