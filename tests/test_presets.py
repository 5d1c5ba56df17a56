"""Code tables: every edge and its neighbours, blanks, wide blanks, junk."""

import pytest
from pyspark.sql import functions as F

from marlspike.functions import presets as P
from marlspike.functions import scalar as S


def codes(spark, encoder, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r["c"] for r in df.select("i", encoder("v").alias("c")).orderBy("i").collect()]


MONEY = {
    "500万元": 7, "20万": 4, "5万": 0, "1,000万": 1, "10": 4, "0.5": 1, "1.9": 1, "05": 2, "21": 5,
    "50": 5, "51": 6, "100": 6, "101": 7, "500": 7, "501": 8, "2000": 8, "2001": 9, "10000": 9,
    "10001": 10, "99999999999999999999": 10, "": 0, "　": 0, None: 0, "none": 0,
}


def test_money(spark):
    assert codes(spark, P.money_level, list(MONEY)) == list(MONEY.values())


def test_money_repaired(spark):
    def repaired(c):
        return P.money_level(c, P.MONEY_PATTERN_REPAIRED)

    assert codes(spark, repaired, ["5万", "1,000万", "12.5", None]) == [2, 1, 4, 0]


def test_member_years(spark):
    given = [-1, 0, 1, 5, 9, 10, 13, 14, 16, 17, 40, None]
    assert codes(spark, P.member_years, given, "int") == [0, 0, 1, 5, 9, 10, 10, 11, 11, 12, 12, None]


def test_sales(spark):
    edges = [1000, 5000, 10000, 50000, 100000, 10**6, 5 * 10**6, 10**7, 10**8, 10**9]
    given = [str(e + d) for e in edges for d in (-1, 0)]
    expected = [c for i in range(1, 11) for c in (i, i + 1)]
    assert codes(spark, P.sales_level, [*given, "0", "x", None]) == [*expected, 1, None, None]


def test_medal(spark):
    assert codes(spark, P.medal, [0, 1, 5, 6, -1, None], "int") == [0, 1, 5, 0, 0, None]


@pytest.mark.parametrize(
    "encoder, table",
    [
        (P.supply_level, P.SUPPLY_LEVELS),
        (P.company_status, P.COMPANY_STATUSES),
        (P.company_type, P.COMPANY_TYPES),
        (P.employee_scale, P.EMPLOYEE_SCALES),
        (P.business_model, P.BUSINESS_MODELS),
    ],
)
def test_dictionaries(spark, encoder, table):
    found = codes(spark, encoder, [*table, "?", "", "　", None])
    assert found == [*range(1, len(table) + 1), 0, 0, 0, 0]


def test_registered(spark):
    years = [1999, 2000, 2004, 2005, 2009, 2010, 2012, 2014, 2016, 2018, 2019, 2020, 2024]
    texts = [f"{y}-05-04 00:00" for y in years]
    assert codes(spark, P.registered_time, texts) == [1, 2, 2, 3, 3, 4, 5, 6, 7, 8, 8, 9, 9]
    assert codes(spark, P.registered_time, ["", None, "n/a", "2016/05/04"]) == [0, 0, 0, 0]

    def number(c):
        return P.registered_time(c, "yyyymmdd")

    assert codes(spark, number, ["1999-05-04", "2016-05-04", "0000-05-04"]) == [9, 9, 1]


def test_audit(spark):
    years = [2014, 2015, 2016, 2017, 2018, 2019, 2020, 2021]
    assert codes(spark, P.audit_time, [f"{y}-06-01" for y in years]) == [1, 2, 3, 4, 5, 6, 7, 7]

    def number(c):
        return P.audit_time(c, "yyyymmdd")

    assert codes(spark, number, ["2014-06-01", "2018-07-01", "n/a"]) == [7, 7, 0]


def test_sites(spark):
    given = ["5-0", "5-3", "9-4", "9-5", "9-9", "3-5", "7", "", None, "a-b", "3--1"]
    assert codes(spark, P.sites_ok, given) == [1, 4, 5, 6, 6, 6, 0, 0, 0, 0, 0]
    assert codes(spark, P.sites_failed, given) == [6, 3, 6, 5, 1, 7, 0, 0, 0, 0, 0]


def test_blank(spark):
    given = [None, "", "  ", "　", "\t\n", " a ", "0"]
    assert codes(spark, lambda c: S.blank_to(c, "0"), given) == ["0", "0", "0", "0", "0", " a ", "0"]


def test_clean_int(spark):
    given = [None, "88", "\\&quot;77", "n/a", ""]
    assert codes(spark, S.clean_int, given) == [0, 88, 77, 0, 0]


def test_bucketize_rejects_bad_edges():
    with pytest.raises(ValueError):
        S.bucketize("v", [2, 1], [0, 1, 2])
    with pytest.raises(ValueError):
        S.bucketize("v", [1, 2], [0, 1])


def test_remap_and_vocabulary(spark):
    assert codes(spark, lambda c: S.remap(c, {0: 3}), [0, 1, 2, None], "int") == [3, 1, 2, None]
    assert codes(spark, lambda c: S.vocab_index(c, P.TAG_FIELDS), ["保健", "IT", "x", None]) == [1, 3, 0, 0]


def test_merge_and_lines(spark):
    df = spark.createDataFrame([("i", "a", None)], "x string, y string, z string")
    row = df.select(
        S.merge_text(["x", "y", "z"]).alias("joined"),
        S.merge_text(["x", "y", "z"], keep_blanks=False).alias("folded"),
        S.format_label_line(F.lit(2), F.lit("a b")).alias("line"),
        S.format_label_line(F.lit(2), F.lit("")).alias("none"),
        S.strip_newlines(F.lit("a\r\nb\nc")).alias("flat"),
    ).first()
    assert tuple(row) == ("i,a,", "a,i,", "__label__2 a b", "", "abc")
