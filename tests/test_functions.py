import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stallbook import RetailConfig
from stallbook.functions import dates, numbers, rules, text

CFG = RetailConfig()


def values(df, col="out"):
    return [r[col] for r in df.select(col).collect()]


@pytest.mark.parametrize(
    "raw, name",
    [
        (" Item Net Amount (Rs.) ", "item_net_amount_rs"),
        ("Company Name", "company_name"),
        ("A/B  C", "ab__c"),
    ],
)
def test_normalise_name(raw, name):
    assert text.normalise_name(raw) == name


def test_text_helpers(frame):
    df = frame("c string", {"c": " \t A b \n"}, {"c": "6109.0"}, {"c": "610900"}, {"c": None})
    assert values(df.select(text.strip(F.col("c")).alias("out"))) == ["A b", "6109.0", "610900", None]
    assert values(df.select(text.upper_trim(F.col("c")).alias("out")))[0] == "A B"
    assert values(df.select(text.fill_text(F.col("c")).alias("out")))[3] == ""
    codes = values(df.select(text.strip_dot_zero(F.col("c")).alias("out")))
    assert codes[1:] == ["6109", "610900", None]


def test_contains_ignores_case_and_null(frame):
    df = frame("c string", {"c": "x SUB total"}, {"c": "Sales (VOID)"}, {"c": None})
    assert values(df.select(text.contains_ci(F.col("c"), "Sub Total").alias("out"))) == [
        True,
        False,
        False,
    ]
    assert values(df.select(text.contains_ci(F.col("c"), "(Void)").alias("out")))[1] is True


def test_num_or_zero(frame):
    df = frame("c string", {"c": " 12.5"}, {"c": "abc"}, {"c": None}, {"c": ""}, {"c": "nan"})
    assert values(df.select(numbers.num_or_zero(F.col("c")).alias("out"))) == [12.5, 0, 0, 0, 0]


def test_rounding_rules(frame):
    df = frame("c double", {"c": 0.125}, {"c": 0.375}, {"c": 2.675}, {"c": None})
    assert values(df.select(numbers.round_half_even(F.col("c"), 2).alias("out"))) == [
        0.12,
        0.38,
        2.68,
        None,
    ]
    assert values(df.select(F.round("c", 2).alias("out")))[0] == 0.13


def test_safe_ratio_and_greatest0(frame):
    df = frame(
        "a bigint, b bigint",
        {"a": 7, "b": 2},
        {"a": 7, "b": 0},
        {"a": None, "b": 2},
        {"a": -3, "b": 1},
    )
    ratio = numbers.safe_ratio(F.col("a"), F.col("b"), 100, 1)
    assert values(df.select(ratio.alias("out"))) == [350.0, None, None, -300.0]
    assert values(df.select(numbers.greatest0(F.col("a")).alias("out"))) == [7, 7, None, 0]


def test_exact_sum_does_not_depend_on_order(spark):
    df = spark.range(20_000).select((F.col("id") * 0.1 + 0.00001).alias("x"))
    expected = sum(i * 10_000 + 1 for i in range(20_000)) / 100_000
    for parts in (1, 7):
        out = df.repartition(parts).agg(numbers.exact_sum(F.col("x")).alias("s")).first().s
        assert float(out) == expected
    signed = df.select((F.lit(0.0) - F.col("x")).alias("x"))
    assert float(signed.agg(numbers.exact_sum(F.col("x")).alias("s")).first().s) == -expected


def test_exact_sum_beyond_one_long(spark):
    df = spark.range(200).select(F.lit(9.0e10).alias("x"))
    assert float(df.agg(numbers.exact_sum(F.col("x")).alias("s")).first().s) == 200 * 9.0e10


def test_exact_sum_of_large_small_and_negative_parts(frame):
    values_ = [1.0e15, -3.0e12 - 0.5, 0.12345, -0.00001, 0.5 + 2.0**-20, -2.0e13, 7.25]
    df = frame("x double", *[{"x": v} for v in values_])
    exact = sum(Decimal(v).quantize(Decimal("1e-13")) for v in values_[4:])
    exact += sum(Decimal(str(v)) for v in values_[:4])
    assert df.agg(numbers.exact_sum(F.col("x")).alias("s")).first().s == exact


def test_exact_sum_has_few_decimal_steps(spark):
    """One step more is an object more for every group."""
    df = spark.range(1).agg(numbers.exact_sum(F.col("id")).alias("s"))
    assert df.schema["s"].dataType.simpleString() == "decimal(36,13)"
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.count("as decimal(36,13))") <= 2


def test_exact_sum_of_nothing_is_null(frame):
    df = frame("x double", {"x": None})
    row = df.agg(numbers.exact_sum(F.col("x")).alias("s"), numbers.mean(F.col("x")).alias("m")).first()
    assert row.s is None and row.m is None


def test_day_first_dates(frame):
    expected = dt.date(2026, 2, 5)
    texts = ["05-02-2026 10:15:00", "5/2/2026", "2026-02-05", "xx", None]
    df = frame("c string", *[{"c": t} for t in texts])
    assert values(df.select(dates.parse_date(F.col("c")).alias("out"))) == [
        expected, expected, expected, None, None,
    ]


def test_month_first_is_a_parameter(frame):
    df = frame("c string", {"c": "02/05/2026"})
    out = df.select(dates.parse_date(F.col("c"), dates.MONTH_FIRST).alias("out"))
    assert values(out) == [dt.date(2026, 2, 5)]


def test_strict_date_fails_the_job(frame):
    good = frame("c string", {"c": "05-02-2026"}, {"c": None})
    strict = dates.parse_date(F.col("c"), strict=True).alias("out")
    assert values(good.select(strict)) == [dt.date(2026, 2, 5), None]
    with pytest.raises(Exception, match="not a date"):
        frame("c string", {"c": "xx"}).select(strict).collect()


def test_calendar_of_a_week_that_crosses_the_year(frame):
    df = frame("d date", {"d": dt.date(2024, 12, 30)})
    row = dates.calendar(df, "d", label_format="MMM yyyy").first()
    assert (row.year, row.month, row.week, row.quarter) == (2024, 12, 1, 4)
    assert (row.month_name, row.dow) == ("Dec 2024", "Monday")
    assert values(df.select(dates.iso_year(F.col("d")).alias("out"))) == [2025]


def test_month_diff_counts_boundaries(frame):
    df = frame(
        "a string, b string",
        {"a": "2026-02-01", "b": "2026-01-31"},
        {"a": "2026-01-31", "b": "2026-01-01"},
        {"a": "2026-01-01", "b": "2024-12-31"},
    )
    out = dates.month_diff(F.col("a").cast("date"), F.col("b").cast("date"))
    assert values(df.select(out.alias("out"))) == [1, 0, 13]


def check(frame, schema, cases, rule):
    """All cases of a rule in one job: (arguments, expected) pairs."""
    names = [c.split()[0] for c in schema.split(",")]
    df = frame(schema, *[dict(zip(names, args)) for args, _ in cases])
    assert values(df.select(rule(*[F.col(n) for n in names]).alias("out"))) == [
        expected for _, expected in cases
    ]


def test_movement_status(frame):
    cases = [
        ((10, 0, 10), "Stagnant"),
        ((10, 10, 0), "Fully sold"),
        ((10, 4, 6), "Partially sold"),
        ((10, -1, 11), "Stagnant"),
        ((0, 0, 5), "Other"),
        ((5, 7, -2), "Other"),
        ((None, 0, 5), "Other"),
    ]
    check(frame, "i double, o double, c double", cases, rules.movement_status)


def test_sell_through_tier(frame):
    cases = [
        ((80, 1, 1, 1), "Fast mover"),
        ((79.99, 1, 1, 1), "Medium mover"),
        ((40, 1, 1, 1), "Medium mover"),
        ((39.99, 1, 1, 1), "Slow mover"),
        ((0.01, 1, 1, 1), "Slow mover"),
        ((None, 0, 0, 5), "Other"),
        ((0, 10, 0, 10), "No movement"),
    ]
    check(
        frame,
        "p double, i double, o double, c double",
        cases,
        lambda *cols: rules.sell_through_tier(CFG, *cols),
    )


def test_units_per_day_tier(frame):
    cases = [
        ((1.0,), "Fast mover"), ((0.9999,), "Medium mover"), ((0.1,), "Medium mover"),
        ((0.09,), "Slow mover"), ((0,), "No sales"), ((None,), "No sales"),
    ]
    check(frame, "u double", cases, lambda u: rules.units_per_day_tier(CFG, u))


def test_stock_value_bucket(frame):
    cases = [
        ((100000,), "High value"), ((99999,), "Medium value"), ((10000,), "Medium value"),
        ((9999,), "Low value"), ((None,), "Low value"),
    ]
    check(frame, "v double", cases, lambda v: rules.stock_value_bucket(CFG, v))


def test_strategic_quadrant(frame):
    cases = [
        ((30, 50), "Star — buy more"),
        ((30, 49.99), "Margin trap — slow seller"),
        ((29.99, 50), "Volume driver — low margin"),
        ((29.99, 49.99), "Dog — review or drop"),
        ((None, 50), "Insufficient data"),
        ((30, None), "Insufficient data"),
    ]
    check(
        frame, "m double, s double", cases, lambda m, s: rules.strategic_quadrant(CFG, m, s)
    )


def test_discount_risk(frame):
    cases = [
        ((20.01,), "High discount risk"), ((20,), "Moderate discount"),
        ((10.01,), "Moderate discount"), ((10,), "Healthy pricing"), ((None,), "Healthy pricing"),
    ]
    check(frame, "p double", cases, lambda p: rules.discount_risk(CFG, p))


def test_expense_category(frame):
    cases = [
        (("Payment", "FREIGHT"), "Freight"),
        (("Payment", "RENT"), "Other Expense"),
        (("Receipt", "GIFT VOUCHER"), "Gift Voucher"),
        (("Receipt", "X"), ""),
        (("Sales", "SALARY EXP"), "Salary"),
    ]
    check(frame, "v string, p string", cases, lambda v, p: rules.expense_category(CFG, v, p))


def test_branch_rules(frame):
    df = frame("b string", {"b": "HO"}, {"b": "A"}, {"b": "A-old"}, {"b": None})
    kinds = values(df.select(rules.branch_type(F.col("b"), CFG).alias("out")))
    assert kinds == ["Head Office", "Active Branch", "Inactive", "Inactive"]
    names = values(df.select(rules.canonical_branch(F.col("b"), CFG).alias("out")))
    assert names == ["HO", "A", "A", None]


def test_ratio_never_yields_infinity(frame):
    df = frame("a double, b double", {"a": 1.0, "b": 0.0})
    out = values(df.select(numbers.safe_ratio(F.col("a"), F.col("b")).alias("out")))[0]
    assert out is None or not math.isinf(out)


def test_layouts_are_found_for_each_file(spark):
    from stallbook.operators import layouts

    cells = {
        "day": ["03/04/2026", "25/04/2026 10:15", "04/04/2026", " ", None, "x"],
        "month": ["03/04/2026", "04/25/2026"],
        "open": ["03-04-2026", "05-06-2026"],
        "iso": ["2026-04-03", "2026-12-31 23:59:59"],
        "none": ["soon"],
    }
    rows = [(f, c) for f, cs in cells.items() for c in cs] + [(None, "01/02/2026")]
    df = spark.createDataFrame(rows, "file string, day string")
    found = {r.file: (r.layout and r.layout[:8], r.cells, r.read, r.dropped, r.ambiguous) for r in layouts.find_layouts(df, "file", "day").collect()}
    assert found == {
        "day": ("d/M/yyyy", 4, 3, 1, 1), "month": ("M/d/yyyy", 2, 2, 0, 1),
        "open": ("d-M-yyyy", 2, 2, 0, 2), "iso": ("yyyy-M-d", 2, 2, 0, 0), "none": (None, 1, 0, 1, 0),
        None: ("d/M/yyyy", 1, 1, 0, 1),
    }
    read = layouts.parse_found(df, "file", "day").where("file = 'month'").collect()
    assert sorted(str(r.day) for r in read) == ["2026-03-04", "2026-04-25"]
    assert layouts.parse_found(df, "file", "day").count() == len(rows)
    assert layouts.find_layouts(df.where("false"), "file", "day").count() == 0
