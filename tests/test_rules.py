"""Identifier normalisation and rule outcomes on invented rows, one for each path."""

import pytest
from pyspark.sql import functions as F

from lakeshift.operators.rules import (
    SSN_RULES,
    apply_checks,
    get_invalid,
    get_valid,
    normalize_identifier,
    rule_names,
    to_exceptions,
)
from lakeshift.schemas import CUSTOMER

SEED = [
    ("P10", "Noor", "321-54-9876", 120.5),
    ("P11", "Ilse", None, 7.25),
    ("P12", "Teo", "32-154-9876", 33.0),
    ("P13", "Mara", "934-71-4321", 410.0),
    ("P14", None, "321549876", 64.0),
    ("X01", "x", "abc", 1.0),
    ("X02", "x", "  ", 1.0),
    ("X03", "x", "---", 1.0),
    ("X04", "x", "\t", 1.0),
    ("X05", "x", "666-12-3456", 1.0),
    ("X06", "x", "123-00-1234", 1.0),
    ("X07", "x", "912-93-1234", 1.0),
    ("X08", "x", " 123 45 6789 ", 1.0),
]
EXPECTED = {
    # id: (ssn_norm, errors, warnings)
    "P10": ("321549876", None, None),
    "P11": (None, "SSN_MISSING", None),
    "P12": ("321549876", None, None),
    "P13": ("934714321", "SSN_INVALID_STRUCTURE", "ITIN_SUPPLIED_INSTEAD_OF_SSN"),
    "P14": ("321549876", None, None),
    "X01": (None, "SSN_MISSING", None),
    "X02": (None, "SSN_MISSING", None),
    "X03": ("", "SSN_INVALID_STRUCTURE", None),
    "X04": ("", "SSN_INVALID_STRUCTURE", None),
    "X05": ("666123456", "SSN_INVALID_STRUCTURE", None),
    "X06": ("123001234", "SSN_INVALID_STRUCTURE", None),
    "X07": ("912931234", "SSN_INVALID_STRUCTURE", None),
    "X08": ("123456789", None, None),
}


@pytest.fixture()
def checked(spark):
    df = spark.createDataFrame(SEED, CUSTOMER)
    return apply_checks(normalize_identifier(df), SSN_RULES)


def test_seed_outcomes(checked):
    got = {
        r.customer_id: (r.ssn_norm, r.e, r.w)
        for r in checked.select("customer_id", "ssn_norm", rule_names("_errors").alias("e"), rule_names("_warnings").alias("w")).collect()
    }
    assert got == EXPECTED


def test_valid_invalid_split(checked):
    valid = {r.customer_id for r in get_valid(checked).collect()}
    invalid = {r.customer_id for r in get_invalid(checked).collect()}
    assert valid == {"P10", "P12", "P14", "X08"}
    assert valid | invalid == set(EXPECTED)
    assert not valid & invalid  # no warn-only rows in this pack (every ITIN fails the structure rule)
    assert "_errors" not in get_valid(checked).columns


def test_warn_only_rows_land_in_both(spark):
    rules = [
        {"name": "NEG", "criticality": "warn", "check": {"function": "sql_expression", "arguments": {"expression": "x >= 0"}}},
        {"name": "NUL", "criticality": "error", "check": {"function": "is_not_null", "arguments": {"column": "x"}}},
    ]
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    checked = apply_checks(df, rules)
    assert sorted(r.x for r in get_valid(checked).collect() if r.x is not None) == [-1, 1]
    inv = get_invalid(checked).collect()
    assert sorted((r.x is None, r._errors is None, r._warnings is None) for r in inv) == [(False, True, False), (True, False, True)]
    # NULL predicate passes sql_expression: x=NULL has no warning
    r = [r for r in inv if r.x is None][0]
    assert r._warnings is None


def test_result_struct_and_exceptions(checked):
    exc = to_exceptions(get_invalid(checked))
    row = exc.filter(F.col("customer_id") == "P13").first()
    assert row.review_status == "PENDING" and row.exception_ts is not None
    err = row._errors[0]
    assert err.name == "SSN_INVALID_STRUCTURE" and err.function == "sql_expression"
    assert err.user_metadata["rule_type"] == "format_validation"


def test_unknown_check_function_rejected(spark):
    with pytest.raises(ValueError):
        apply_checks(spark.range(1), [{"name": "x", "check": {"function": "nope", "arguments": {}}}])


def test_rule_text_reaches_spark_as_written(spark):
    rule = {"name": "r", "criticality": "error", "check": {"function": "sql_expression", "arguments": {"expression": "x = 'a  b' -- two blanks\n OR x IS NULL"}}}
    df = spark.createDataFrame([("a  b",), ("a b",), (None,)], "x string")
    assert [r.x for r in get_valid(apply_checks(df, [rule])).collect()] == ["a  b", None]
