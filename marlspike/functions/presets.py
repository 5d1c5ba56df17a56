"""Value tables of the company domain, and encoders built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marlspike.functions import scalar as S

# --- Fixed values: they must equal the published codes for right results ---

MONEY_PATTERN = r"\d+\.?\d+"
MONEY_PATTERN_REPAIRED = r"\d+(?:\.\d+)?"
MONEY_EDGES = [1, 5, 20, 50, 100, 500, 2000, 10000]
MONEY_CODES = [1, 2, 4, 5, 6, 7, 8, 9, 10]

MEMBER_YEAR_EDGES = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 14, 17]
MEMBER_YEAR_CODES = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]

SALES_EDGES = [
    1_000, 5_000, 10_000, 50_000, 100_000, 1_000_000,
    5_000_000, 10_000_000, 100_000_000, 1_000_000_000,
]
SALES_CODES = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]

REGISTERED_EDGES = [2000, 2005, 2010, 2012, 2014, 2016, 2018, 2020]
REGISTERED_CODES = [1, 2, 3, 4, 5, 6, 7, 8, 9]

AUDIT_EDGES = [2015, 2016, 2017, 2018, 2019, 2020]
AUDIT_CODES = [1, 2, 3, 4, 5, 6, 7]
AUDIT_EDGES_AS_NUMBER = [2015, 2016, 2017, 2018]
AUDIT_CODES_AS_NUMBER = [1, 2, 3, 4, 7]

SUPPLY_LEVELS = {
    "10万-20万": 1,
    "20万-50万": 2,
    "50万-120万": 3,
    "120万-300万": 4,
    "300万-800万": 5,
    "0-500": 6,
    "500-5000": 7,
    "5000-2万": 8,
    "2万-5万": 9,
    "5万-10万": 10,
    "800万-2000万": 11,
    "2000万-5000万": 12,
    "5000万-1.5亿": 13,
    "1.5亿-5亿": 14,
    "5亿以上": 15,
}

COMPANY_STATUSES = {
    "在业": 1,
    "小微企业": 2,
    "迁出": 3,
    "开业": 4,
    "注销": 5,
    "存续": 6,
    "解散": 7,
    "已告解散": 8,
    "仍注册": 9,
}

COMPANY_TYPES = {
    "联营企业": 1,
    "普通合伙": 2,
    "国有企业": 3,
    "有限责任公司": 4,
    "外商投资企业": 5,
    "有限合伙": 6,
    "股份有限公司": 7,
    "个人独资企业": 8,
    "个体工商户": 9,
    "私营企业": 10,
    "集体所有制": 11,
}

EMPLOYEE_SCALES = {
    "0-49人": 1,
    "50-99人": 2,
    "500-999人": 3,
    "100-499人": 4,
    "1000-4999人": 5,
    "5000-9999人": 6,
}

BUSINESS_MODELS = {
    "生产厂家": 1,
    "经销批发": 2,
    "招商代理": 3,
    "商业服务": 4,
}

TAG_FIELDS = ["保健", "服务", "IT"]

# --- End of fixed values ---


def money_level(c: Column | str, pattern: str = MONEY_PATTERN) -> Column:
    """Level 1..10 of the first amount in a text, 0 without one.

    The default pattern needs two digits, so "5万" has no amount and "1,000万"
    counts as 000; MONEY_PATTERN_REPAIRED reads single digits. Level 3 does
    not occur, and units are not read.
    """
    amount = S.truncate_int(S.extract_number(c, pattern))
    return S.bucketize(amount, MONEY_EDGES, MONEY_CODES, closed="right", default=0)


def member_years(c: Column | str) -> Column:
    return S.bucketize(S._col(c), MEMBER_YEAR_EDGES, MEMBER_YEAR_CODES, default=None)


def sales_level(c: Column | str) -> Column:
    """Level of an amount in a text; decimals are cut off, any size is coded."""
    amount = S.safe_cast(c, "double")
    whole = F.signum(amount) * F.floor(F.abs(amount))
    return S.bucketize(whole, SALES_EDGES, SALES_CODES, default=None)


def medal(c: Column | str) -> Column:
    return S.keep_between(c, 1, 5)


def supply_level(c: Column | str) -> Column:
    return S.encode_dict(c, SUPPLY_LEVELS)


def company_status(c: Column | str) -> Column:
    return S.encode_dict(c, COMPANY_STATUSES)


def company_type(c: Column | str) -> Column:
    return S.encode_dict(c, COMPANY_TYPES)


def employee_scale(c: Column | str) -> Column:
    return S.encode_dict(c, EMPLOYEE_SCALES)


def business_model(c: Column | str) -> Column:
    return S.encode_dict(c, BUSINESS_MODELS)


def registered_time(c: Column | str, key: str = "year") -> Column:
    """Registration period. key="yyyymmdd" compares the whole date number with
    the year edges, which puts every real date in the last period."""
    return S.date_bucket(c, REGISTERED_EDGES, REGISTERED_CODES, key)


def audit_time(c: Column | str, key: str = "year") -> Column:
    """Audit period; with key="yyyymmdd" codes 5 and 6 do not occur."""
    if key == "year":
        return S.date_bucket(c, AUDIT_EDGES, AUDIT_CODES, key)
    return S.date_bucket(c, AUDIT_EDGES_AS_NUMBER, AUDIT_CODES_AS_NUMBER, key)


def sites_ok(c: Column | str) -> Column:
    return S.count_code(c, "ok")


def sites_failed(c: Column | str) -> Column:
    return S.count_code(c, "failed")
