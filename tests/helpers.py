"""Small data for the tests, and comparisons."""

from datetime import date
from decimal import Decimal


from tallyhouse.schemas import CUSTOMER, FACT, LONG, MONEY, SALES_TEAM, STORE, table

HEADER = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"

# The golden sales: customer, store, date, seller, total.
GOLDEN_SALES = [
    (1, 121, date(2023, 3, 3), 1, "100.00"),
    (2, 121, date(2023, 3, 31), 2, "100.00"),
    (1, 121, date(2023, 3, 5), 3, "40.00"),
    (1, 121, date(2023, 4, 1), 1, "4.50"),
    (3, 122, date(2023, 3, 10), 4, "33.35"),
    (3, 122, date(2023, 3, 11), 4, "0.00"),
    (99, 121, date(2023, 3, 3), 3, "500.00"),
    (1, None, date(2023, 3, 3), 1, "7.00"),
    (1, 124, date(2023, 3, 3), 10, "0.50"),
]


def sales_of(spark, rows):
    full = [
        (customer, store, "sugar", day, seller, Decimal(total), 1, Decimal(total), None)
        for customer, store, day, seller, total in rows
    ]
    return spark.createDataFrame(full, FACT)


def golden_sales(spark):
    return sales_of(spark, GOLDEN_SALES)


def customers_of(spark):
    people = [(1, "Ann", "A", "X", "91"), (2, "Bo", None, "Y", "92"), (3, "Cy", "C", "Z", "93")]
    rows = [(i, f, l, a, None, phone, None) for i, f, l, a, phone in people]
    return spark.createDataFrame(rows, CUSTOMER)


def stores_of(spark):
    rows = [(i, None, None, f"manager {i}", None, None) for i in range(121, 125)]
    return spark.createDataFrame(rows, STORE)


def staff_of(spark):
    names = {1: "One", 2: "Two", 3: "Three", 4: "Four", 10: "Ten"}
    rows = [(i, "P", last, 10, "N", None, None, None) for i, last in names.items()]
    return spark.createDataFrame(rows, SALES_TEAM)


def dimensions_of(spark):
    return customers_of(spark), stores_of(spark), staff_of(spark)


def rows_of(df, *columns):
    """Rows as a sorted list of tuples, NULL first."""
    chosen = df.select(*columns) if columns else df
    found = [tuple(row) for row in chosen.collect()]
    return sorted(found, key=lambda row: [(value is not None, str(value)) for value in row])


def sorted_rows(rows):
    return sorted(rows, key=lambda row: [(value is not None, str(value)) for value in row])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def explained(df):
    """The formatted plan, in which filters are not cut short."""
    helper = df.sparkSession._jvm.PythonSQLUtils
    return helper.explainString(df._jdf.queryExecution(), "formatted")


GROUP_VALUE = table(g=LONG, id=LONG, v=MONEY)
