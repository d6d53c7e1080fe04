"""Marts on the golden rows and on random sales, against the row-by-row definition."""

import random
from collections import defaultdict
from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import Window, functions as F

from helpers import (
    customers_of,
    dimensions_of,
    golden_sales,
    rows_of,
    sales_of,
    sorted_rows,
    staff_of,
)
from tallyhouse.functions.calendar import month_label, month_start, month_start_from_text
from tallyhouse.functions.money import incentive, unit_price
from tallyhouse.functions.text import full_name
from tallyhouse.operators import enrich, marts, quality

MARCH, APRIL = date(2023, 3, 1), date(2023, 4, 1)


def test_customer_mart_golden(spark):
    assert rows_of(marts.customer_mart(golden_sales(spark), *dimensions_of(spark))) == sorted_rows(
        [
            (1, "Ann A", "X", "91", MARCH, Decimal("140.50")),
            (1, "Ann A", "X", "91", APRIL, Decimal("4.50")),
            (2, None, "Y", "92", MARCH, Decimal("100.00")),
            (3, "Cy C", "Z", "93", MARCH, Decimal("33.35")),
        ]
    )


def test_sales_team_mart_golden(spark):
    found = marts.sales_team_mart(golden_sales(spark), *dimensions_of(spark))
    assert rows_of(found) == sorted_rows(
        [
            (121, 1, "P One", MARCH, Decimal("100.00"), Decimal("1.00")),
            (121, 2, "P Two", MARCH, Decimal("100.00"), Decimal("1.00")),
            (121, 3, "P Three", MARCH, Decimal("40.00"), Decimal("0.00")),
            (121, 1, "P One", APRIL, Decimal("4.50"), Decimal("0.05")),
            (122, 4, "P Four", MARCH, Decimal("33.35"), Decimal("0.33")),
            (124, 10, "P Ten", MARCH, Decimal("0.50"), Decimal("0.01")),
        ]
    )


def test_top_performer_keeps_ties(spark):
    totals = marts.named_salesperson_total(golden_sales(spark), *dimensions_of(spark))
    top = marts.top_performer(totals).where("store_id = 121 and sales_month = '2023-03-01'")
    assert rows_of(top, "sales_person_id") == [(1,), (2,)]


def _random_sales(count, seed):
    """A third of the sales fall to one seller and one customer."""
    draw = random.Random(seed)
    rows = []
    for _ in range(count):
        hot = draw.random() < 1 / 3
        rows.append(
            (
                1 if hot else draw.choice([1, 2, 3, 3, 50, None]),
                121 if hot else draw.choice([121, 122, 123, 124, 999, None]),
                draw.choice([date(2023, 3, d) for d in (1, 9, 31)] + [date(2023, 4, 2), None]),
                1 if hot else draw.choice([1, 2, 3, 4, 10, 77, None]),
                draw.choice(["0.50", "10.00", "10.01", "33.35", "0.00"]),
            )
        )
    return rows


def _expected_team(rows):
    names = {1: "P One", 2: "P Two", 3: "P Three", 4: "P Four", 10: "P Ten"}
    totals = defaultdict(Decimal)
    for customer, store, day, seller, total in rows:
        if customer in (1, 2, 3) and store in range(121, 125) and seller in names:
            totals[store, seller, day and day.replace(day=1)] += Decimal(total)
    found = []
    for (store, seller, month), total in totals.items():
        best = max(t for (s, _, m), t in totals.items() if (s, m) == (store, month))
        paid = total * Decimal("0.01") if total == best else Decimal(0)
        cents = paid.quantize(Decimal("0.01"), ROUND_HALF_UP)
        found.append((store, seller, names[seller], month, total, cents))
    return found


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_marts_equal_the_row_by_row_definition(spark, seed):
    rows = _random_sales(400, seed)
    sales = sales_of(spark, rows)
    team = marts.sales_team_mart(sales, *dimensions_of(spark))
    assert rows_of(team) == sorted_rows(_expected_team(rows))

    enriched = enrich.enrich(sales, *dimensions_of(spark))
    month = month_start(F.col("sales_date")).alias("month")
    whole = Window.partitionBy("customer_id", month)
    windowed = enriched.select(
        "customer_id", month, F.sum("total_cost").over(whole).alias("total_sales")
    ).distinct()
    spent = marts.customer_mart(sales, *dimensions_of(spark))
    assert rows_of(spent, "customer_id", "sales_date_month", "total_sales") == rows_of(windowed)
    total = enriched.agg(F.sum("total_cost")).first()[0]
    assert spent.agg(F.sum("total_sales")).first()[0] == total
    assert team.agg(F.sum("total_sales")).first()[0] == total


def test_trend_marks_a_decline(spark):
    rows = [
        (1, 121, date(2023, 1, 5), 1, "10.00"),
        (1, 121, date(2023, 2, 5), 1, "7.00"),
        (1, 121, date(2023, 4, 5), 1, "8.00"),
    ]
    trend = marts.customer_spend_trend(marts.customer_month_total(sales_of(spark, rows)))
    assert rows_of(trend, "sales_date_month", "previous_total", "change", "declining") == [
        (date(2023, 1, 1), None, None, False),
        (date(2023, 2, 1), Decimal("10.00"), Decimal("-3.00"), True),
        (date(2023, 4, 1), Decimal("7.00"), Decimal("1.00"), False),
    ]


def test_joins_drop_or_report_unknown_keys(spark):
    sales, (customers, stores, staff) = golden_sales(spark), dimensions_of(spark)
    assert enrich.join_customer(sales, customers).count() == 8
    assert enrich.join_store(sales, stores).count() == 8
    assert enrich.join_salesperson(sales, staff).count() == 9
    enriched = enrich.enrich(sales, customers, stores, staff)
    assert enriched.count() == 7 == enrich.known_sales(sales, customers, stores, staff).count()
    lost = enrich.orphan_sales(sales, customers, "customer_id", "customer_id")
    assert rows_of(lost, "customer_id") == [(99,)]
    lost = enrich.orphan_sales(sales, stores, "id", "store_id")
    assert rows_of(lost, "store_id", "total_cost") == [(None, Decimal("7.00"))]
    months = rows_of(enrich.sales_rows(enriched), "sales_month")
    assert set(months) == {("2023-03",), ("2023-04",)}
    assert enrich.customer_rows(enriched).columns[-2:] == ["sales_date", "total_cost"]


def test_product_names_may_repeat(spark):
    products = spark.createDataFrame(
        [(5, "sugar", 1), (2, "sugar", 2), (3, "maida", 3)], "id long, name string, current_price int"
    )
    joined = enrich.join_product(golden_sales(spark), products)
    assert joined.count() == 9
    assert set(rows_of(joined, "product_id", "current_price")) == {(2, 2)}


def test_repeated_dimension_keys_stop_a_load(spark):
    twice = customers_of(spark).union(customers_of(spark).where("customer_id = 2"))
    assert rows_of(quality.repeated_keys(twice, "customer_id")) == [(2, 2)]
    with pytest.raises(ValueError, match="customer_id 2 occurs 2 times"):
        quality.require_unique(twice, "customer_id")
    quality.require_unique(staff_of(spark), "id")


def test_money_is_rounded_half_up(spark):
    amounts = spark.createDataFrame(
        [(Decimal("4.50"), 4), (Decimal("104.50"), 8), (Decimal("0.05"), 2), (Decimal("1.00"), 0)],
        "total decimal(18,2), pieces int",
    )
    paid = amounts.select(
        incentive(F.col("total"), F.lit(True)), unit_price(F.col("total"), F.col("pieces"))
    )
    assert [tuple(r) for r in paid.collect()] == [
        (Decimal("0.05"), Decimal("1.13")),
        (Decimal("1.05"), Decimal("13.06")),
        (Decimal("0.00"), Decimal("0.03")),
        (Decimal("0.01"), None),
    ]


def test_month_forms_agree(spark):
    days = spark.createDataFrame([(date(2024, 2, 29),), (date(2023, 12, 31),), (None,)], "d date")
    d = F.col("d")
    forms = days.select(month_start(d), month_start_from_text(d), month_label(d))
    assert [tuple(r) for r in forms.collect()] == [
        (date(2024, 2, 1), date(2024, 2, 1), "2024-02"),
        (date(2023, 12, 1), date(2023, 12, 1), "2023-12"),
        (None, None, None),
    ]


def test_full_name_needs_both_parts(spark):
    names = spark.createDataFrame([("a", "b"), ("a", None), (None, "b")], "f string, l string")
    found = names.select(full_name(F.col("f"), F.col("l"))).collect()
    assert [r[0] for r in found] == ["a b", None, None]
