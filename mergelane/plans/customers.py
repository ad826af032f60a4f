"""From cleaned sales to customer identities: entities, enrichment, matching, accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergelane.functions import text
from mergelane.operators.clusters import cluster_occurrence, fill_in_cluster, first_rule_wins, unify_ids
from mergelane.operators.enrichment import address_payload
from mergelane.operators.lookups import join_all, lookup
from mergelane.operators.mapping import conform
from mergelane.operators.matching import Ids, Rule, apply_matching, rule_from_dict, winning_pairs
from mergelane.operators.ranking import distinct_entities
from mergelane.session import materialize, settle, stored

# What describes a customer.
ENTITY_COLUMNS = (
    "customer_number", "customer_address", "customer_city", "customer_postal_code", "customer_country",
    "customer_name", "owner_name", "wholesaler_name", "vat_number", "wholesaler_id",
)


def customer_entities(sales: DataFrame, api_name: str = "addressvalidation", key_mode: str = "sha2") -> DataFrame:
    """Distinct customers with an entity key ``unique_id`` and the address payload."""
    entities = distinct_entities(sales, ENTITY_COLUMNS, fallback={"customer_name": "owner_name"})
    keyed = entities.withColumn("unique_id", text.entity_key(ENTITY_COLUMNS, key_mode))
    return address_payload(
        keyed, "customer_country", ["customer_name", "customer_address"], "customer_city",
        "customer_postal_code", api_name,
    )


# Account columns that are trimmed, blank ones to null.
ACCOUNT_COLUMNS = (
    "c4cu_account_id", "c4cu_account_desc", "c4cu_country_id", "c4cu_country_desc", "c4cu_streetaddress_id",
    "c4cu_housenumber_id", "c4cu_city_id", "c4cu_postalcode_id", "c4cu_vatregistration_id",
    "c4cu_taxnumber4_id",
)


def prepare_accounts(accounts: DataFrame, country: str, api_name: str = "addressvalidation") -> DataFrame:
    """CRM accounts of one country, blanks to null, with address lines and payload."""
    rows = accounts.filter(F.col("c4cu_country_desc") == country).select(*ACCOUNT_COLUMNS)
    rows = text.blank_columns_to_null(rows, ACCOUNT_COLUMNS)
    street = text.address_line("c4cu_streetaddress_id", "c4cu_housenumber_id")
    rows = rows.withColumns({
        "addressLines": text.address_line(
            "c4cu_account_desc", "c4cu_streetaddress_id", "c4cu_housenumber_id", "c4cu_city_id",
            "c4cu_postalcode_id",
        ),
        "c4cu_street_house_number": street,
    })
    return address_payload(
        rows, "c4cu_country_id", ["addressLines"], "c4cu_city_id", "c4cu_postalcode_id", api_name
    )


def _column(source: str, target: str | None = None, **more: object) -> dict:
    return {"source_column": source, "target_column": target or source, **more}


def _rule(kind: str, result: str, *columns: dict, loose: bool = True, **more: object) -> Rule:
    """A rule by way of its dictionary form; `loose` ignores case and outer blanks in all columns."""
    return rule_from_dict({
        "match_type": kind, "result_column": result, "columns": columns, "trim": loose, "case_insensitive": loose, **more,
    })


def _half(source: str, target: str | None = None) -> dict:
    return _column(source, target, match="fuzzy", weight=0.5)


# The rules among customers, from customers to accounts, and to business partner relationships.
INTERNAL_RULES = (
    _rule("exact", "int_customer_number_match", _column("customer_number")),
    _rule("exact", "int_vat_number_match", _column("vat_number")),
    _rule("exact", "int_place_id_match", _column("place_id")),
    _rule(
        "levenstein", "int_levenstein_name_address",
        _half("customer_name"), _half("customer_address"), _column("customer_postal_code"),
        min_score=0.75, score_column="levenstein_score", comparison_details_column="match_details",
    ),
)
EXTERNAL_RULES = (
    _rule("exact", "ext_Tax_Number_4_match", _column("vat_number", "c4cu_vatregistration_id")),
    _rule("exact", "ext_vat_number_match", _column("vat_number", "c4cu_taxnumber4_id")),
    _rule("exact", "ext_place_id_match", _column("place_id"), loose=False),
    _rule(
        "levenstein", "ext_levenstein_name_address",
        _half("customer_name", "c4cu_account_desc"), _half("customer_address", "c4cu_street_house_number"),
        _column("customer_postal_code", "c4cu_postalcode_id"),
        min_score=0.7, score_column="ext_levenstein_score", comparison_details_column="ext_match_details",
    ),
)
RELATIONSHIP_RULE = _rule(
    "exact", "ext_BPR_match",
    _column("customer_number", "c4cu_numberatwholesaler_id"), _column("wholesaler_id", "c4cu_businesspartner2_id"),
)

# Order of trust among the external results.
ACCOUNT_PRIORITY = (
    "ext_BPR_match", "ext_Tax_Number_4_match", "ext_vat_number_match", "ext_place_id_match",
    "ext_levenstein_name_address",
)


def match_internal(customers: DataFrame, max_iterations: int | None = None) -> DataFrame:
    """Customers matched among themselves and clustered: one result per rule, ``dim_sellout_cust_id``.

    The result is a table in the shared folder; what is written there on the way goes as soon as nothing reads it any more.
    """

    def clustered() -> DataFrame:
        own = stored(customers, "customers")
        matched = apply_matching(own, own, INTERNAL_RULES, Ids("unique_id", "unique_id"), staged=True)
        return unify_ids(matched, [r.result for r in INTERNAL_RULES], "unique_id", "dim_sellout_cust_id", max_iterations)

    return settle(clustered, "clustered")


def clean_relationships(relationships: DataFrame) -> DataFrame:
    """Business partner relationships with their ids stripped of leading zeros."""
    ids = ("c4cu_businesspartner_id", "c4cu_businesspartner2_id", "c4cu_numberatwholesaler_id")
    return relationships.withColumns({c: text.strip_leading_zeros(c) for c in ids})


def link_accounts(customers: DataFrame, accounts: DataFrame, relationships: DataFrame) -> DataFrame:
    """Customers with the accounts they match, a row per (customer, account of its winning rule).

    ``rule`` and ``score`` say how, ``direct_c4S_account_id`` is the row's own account,
    ``C4S_account_id`` the smallest one in the cluster, ``customer_number_Occurrence`` the number of
    distinct accounts in the cluster.

    Only the winning rule's pairs are formed (see `winning_pairs`). Customers, accounts, matches and linked customers are
    written to the shared folder on the way.
    """

    def linked() -> DataFrame:
        own, targets = stored(customers, "customers"), materialize(accounts, "accounts")
        to_accounts, to_partners = Ids("unique_id", "c4cu_account_id"), Ids("unique_id", "c4cu_businesspartner_id")
        known = {RELATIONSHIP_RULE.result: (RELATIONSHIP_RULE, relationships, to_partners)}
        known |= {rule.result: (rule, targets, to_accounts) for rule in EXTERNAL_RULES}
        pairs = winning_pairs(own, [known[result] for result in ACCOUNT_PRIORITY])
        won = pairs.select("source_id", "rule", F.col("target_id").alias("direct_c4S_account_id"), "score").distinct()
        won = materialize(won, "won")
        return join_all(own, won, [("unique_id", "source_id")], ["rule", "direct_c4S_account_id", "score"])

    return _with_cluster_accounts(settle(linked, "linked"))


def match_external(customers: DataFrame, accounts: DataFrame, relationships: DataFrame) -> DataFrame:
    """The wide form of `link_accounts`: every result column of every rule, a row per combination."""

    def linked() -> DataFrame:
        own, targets = stored(customers, "customers"), materialize(accounts, "accounts")
        partners = apply_matching(
            own, relationships, [RELATIONSHIP_RULE], Ids("unique_id", "c4cu_businesspartner_id"), "multiple"
        ).select(F.col("unique_id").alias("__sid"), "ext_BPR_match")
        # The rule that finds few goes first, so that customers are not shuffled with all their accounts.
        known = join_all(own, partners, [("unique_id", "__sid")], ["ext_BPR_match"])
        to_accounts = Ids("unique_id", "c4cu_account_id")
        joined = apply_matching(own, targets, EXTERNAL_RULES, to_accounts, "multiple", staged=True, onto=known)
        joined = joined.select(*[c for c in joined.columns if c != "ext_BPR_match"], "ext_BPR_match")
        return joined.withColumn("direct_c4S_account_id", first_rule_wins(ACCOUNT_PRIORITY))

    return _with_cluster_accounts(settle(linked, "linked"))


def _with_cluster_accounts(linked: DataFrame) -> DataFrame:
    """The table `linked` with the smallest account of the cluster and their number: found from these columns, then met once."""
    cluster, direct, account, number = "dim_sellout_cust_id", "direct_c4S_account_id", "C4S_account_id", "customer_number_Occurrence"
    filled = fill_in_cluster(linked.select(cluster, direct).distinct(), cluster, direct, account)
    counted = cluster_occurrence(filled, cluster, account, direct, number)
    values = materialize(counted.select(cluster, account, number).distinct(), "cluster-accounts")
    return lookup(linked, values, [cluster], [account, number], null_safe=True)


# The tables of matched customers. Results are text; keys are the text keys of `customer_entities`.
INTERNAL_TABLE = (
    ", ".join(f"{c} string" for c in ENTITY_COLUMNS)
    + ", unique_id string NOT NULL, payload struct<address: struct<regionCode: string, addressLines: array<string>, "
    "locality: string, postalCode: string>>, api_url string, payload_string string, api_name string, run_id long, "
    "browser_url string, place_id string, int_customer_number_match string, int_vat_number_match string, "
    "int_place_id_match string, int_levenstein_name_address string, levenstein_score double, match_details string, "
    "dim_sellout_cust_id string"
)
EXTERNAL_TABLE = (
    INTERNAL_TABLE
    + ", ext_BPR_match string, ext_Tax_Number_4_match string, ext_vat_number_match string, ext_place_id_match string, "
    "ext_levenstein_name_address string, ext_levenstein_score double, ext_match_details string, "
    "direct_c4S_account_id string, C4S_account_id string, customer_number_Occurrence int"
)


def internal_table(matched: DataFrame) -> DataFrame:
    """The result of `match_internal` in the columns and types of its table; a row without a key fails the job."""
    return conform(matched, INTERNAL_TABLE)


def external_table(matched: DataFrame) -> DataFrame:
    """The result of `match_external` in the columns and types of its table; a row without a key fails the job."""
    return conform(matched, EXTERNAL_TABLE)
