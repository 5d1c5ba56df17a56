"""Bulk column rules and the two company-table cleaners."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspike.functions import scalar as S
from marlspike.operators.ids import assign_ids
from marlspike.operators.relate import enrich

# --- Fixed values: text columns that are blank-filled ---
CUSTOMER_TEXT = [
    "company_status", "company_type", "industry", "registered_capital", "registered_time",
    "employe_scale", "contributed_capital", "icp_audit_time_format", "vc_step", "status_codes",
]
CUSTOMER_RAW = [
    "company_name", "score", "company_status", "company_type", "industry", "registered_capital",
    "registered_time", "employe_scale", "contributed_capital", "vc_step", "label",
]
MARKET_TEXT = [
    "company_status", "company_type", "industry", "registered_capital", "registered_time",
    "employe_scale", "contributed_capital",
]
# --- End of fixed values ---


def apply_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Replace or add many columns in one projection."""
    return df.withColumns(dict(rules))


def clean_customers(raw: DataFrame, audits: DataFrame, websites: DataFrame) -> DataFrame:
    """Customer table: both enrichments, typed score, blank-filled text and an
    id by falling company name."""
    joined = enrich(
        raw.select(*CUSTOMER_RAW),
        (audits, "company_name", ["icp_audit_time_format"]),
        (websites, "company_name", ["status_codes"]),
    )
    rules = {c: S.blank_to(c, "") for c in CUSTOMER_TEXT}
    rules["score"] = S.clean_int(S.blank_to("score", "0"))
    return assign_ids(apply_rules(joined, rules), "company_name", desc=True)


def clean_market(raw: DataFrame, source_prefix: str = "") -> DataFrame:
    """Marketplace table. source_prefix is the prefix that source columns of
    the marketplace carry (medal_of_trading, chengxintong, sumSales,
    business_model, authentication_information)."""

    def source(name: str) -> str:
        return f"{source_prefix}{name}"

    grade = source("authentication_information")
    rules = {c: S.blank_to(c, "") for c in [*MARKET_TEXT, source("business_model")]}
    rules["score"] = S.clean_int(S.blank_to("score", "0"))
    rules["label"] = S.remap(f"`{grade}`", {0: 3})
    rules[source("sumSales")] = S.blank_to(f"`{source('sumSales')}`", "0")
    for name in ("medal_of_trading", "chengxintong"):
        filled = S.blank_to(F.col(f"`{source(name)}`").cast("string"), "0")
        rules[source(name)] = S.safe_cast(S.safe_cast(filled, "double"), "int")  # decimals are cut off
    cleaned = apply_rules(raw, rules).drop(grade)
    return assign_ids(cleaned, "company_name", desc=True)
