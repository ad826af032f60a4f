"""Serving views: renamed columns, derived keys, one row per key."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergelane.functions.text import composite_key, strip_leading_zeros
from mergelane.operators.ranking import latest_per_key


def padded_id(col: Column | str, width: int = 10) -> Column:
    """Id padded with zeros; longer ids are cut to `width`."""
    return F.lpad(F.col(col).cast("string") if isinstance(col, str) else col.cast("string"), width, "0")


def renamed(df: DataFrame, names: Mapping[str, Column | str]) -> DataFrame:
    """One projection: {output name: source column or expression}."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in names.items()])


# The column names reports use.
_CUSTOMER = {
    "Id at Wholesaler": "customer_number",
    "Customer Address": "customer_address",
    "Customer City": "customer_city",
    "Customer Postal Code": "customer_postal_code",
    "Customer Country": "customer_country",
    "Customer Name": "customer_name",
    "Wholesaler Name": "wholesaler_name",
    "Vat Number": "vat_number",
    "C4s Account Id": "",
    "Wholesaler Id": "wholesaler_id",
    "Place Id": "place_id",
    "Occurrence": "customer_number_Occurrence",
}
_SALE = {
    "Id at Wholesaler": "customer_number",
    "Article Name": "article_name",
    "Ean": "EAN",
    "Amount Sale UoM": "total_amount",
    "Wholesaler Name": "wholesaler_name",
    "Date": "date",
    "Full File Path": "full_file_path",
    "Serivce Render Date": "dimdateid",
    "Sharepoint File Name": "sharepoint_file_name",
    "Cumi Material Id": "cumi_material_id",
    "Cumi Customermaterialnumber Id": "cumi_customermaterialnumber_id",
    "VDM Uom": "converted_uom",
    "Wholesaler UOM": "UOM",
    "Muom Denominator qty": "muom_denominator_qty",
    "Muom Nominator qty": "muom_numerator_qty",
    "Sellout Kgl Qty": "KgL",
    "Wholesaler Id": "wholesaler_id",
}
_MATERIAL = {
    "Material Group": "mtrl_materialgroup6_desc",
    "Material Type": "mtrl_materialtype_desc",
    "Business Line": "mtrl_businessline_desc",
    "Material": "mtrl_material_desc",
    "Product Family": "mtrl_productfamily_desc",
    "ABC classification Id": "mtrl_businessline_id",
}


def _customer_columns(account: str) -> dict[str, Column | str]:
    key = {"Id at Wholesaler + Wholesaler Id": composite_key("customer_number", "wholesaler_id")}
    return {**_CUSTOMER, "C4s Account Id": padded_id(account), **key}


def customers_view(linked: DataFrame) -> DataFrame:
    """One row per customer number, the one with the largest account; the rank stays as ``rn``."""
    order = [F.desc_nulls_last("C4S_account_id"), F.asc_nulls_last("wholesaler_id"), F.asc_nulls_last("unique_id")]
    top = latest_per_key(linked, ["customer_number"], order, rank="rn")
    return renamed(top, {**_customer_columns("C4S_account_id"), "rn": "rn"})


def customers_with_duplicates_view(linked: DataFrame) -> DataFrame:
    """One row per cluster and padded account, the one with the largest customer number."""
    keys = ["dim_sellout_cust_id", padded_id("direct_c4S_account_id")]
    order = [F.desc("customer_number"), F.asc_nulls_last("wholesaler_id"), F.asc_nulls_last("unique_id")]
    top = latest_per_key(linked, keys, order)
    return renamed(top, {**_customer_columns("direct_c4S_account_id"), "dim_sellout_cust_id": "dim_sellout_cust_id"})


def labelled_dimension(df: DataFrame, id_col: str, text: str, more: Mapping[str, str], noun: str) -> DataFrame:
    """A dimension with its id, the id without leading zeros, and a label "id text"."""
    trimmed = strip_leading_zeros(id_col)
    return renamed(df, {
        f"{noun} Id": id_col,
        f"{noun} Id Trimmed": trimmed,
        f"Key + {noun}": composite_key(trimmed, F.lit(" "), text),
        **more,
    })


def materials_view(materials: DataFrame) -> DataFrame:
    return labelled_dimension(materials, "mtrl_material_id", "mtrl_material_desc", _MATERIAL, "Material")


def sales_view(fact: DataFrame) -> DataFrame:
    """The sales fact under report names, with a composite customer key."""
    key = {"Id at Wholesaler + Wholesaler Id": composite_key("customer_number", "wholesaler_id")}
    return renamed(fact, {**_SALE, **key})
