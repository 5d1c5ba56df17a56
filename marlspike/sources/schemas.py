"""Declared schemas of the tables that jobs exchange."""

from pyspark.sql import types as T


_KINDS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
}


def _struct(**fields: str) -> T.StructType:
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in fields.items()])


# --- Fixed values: column names of the exchanged tables, in consumed order ---

CUSTOMER_COMPANY = _struct(
    company_name="string",
    score="int",
    status="string",
    company_type="string",
    industry="string",
    registered_capital="string",
    registered_time="string",
    employe_scale="string",
    contributed_capital="string",
    vc_step="string",
    label="int",
    icp_audit_time_format="string",
    status_codes="string",
    id="bigint",
    text_label="int",
)

MARKET_COMPANY = _struct(
    company_name="string",
    status="string",
    score="int",
    company_type="string",
    industry="string",
    registered_capital="string",
    registered_time="string",
    employe_scale="string",
    contributed_capital="string",
    province="string",
    city="string",
    chengxintong="int",
    medal_of_trading="int",
    business_model="string",
    sumSales="string",
    phone_supply_level="string",
    id="bigint",
    label="int",
    introduce_label="string",
)

STAR_RATING = _struct(companyId="int", tagId="int", label="int")
STAR_COMPANY = _struct(companyId="int", score="int", age="int", number="int")
STAR_TAG = _struct(tagId="int", tag="string", field="string")

PREDICTION = _struct(user_id="bigint", item_id="bigint", prediction="int", probability="double")
