"""The monthly load: accepted sales to row-level datasets and marts, by the months that changed."""

from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.operators.enrich import (
    KNOWN,
    customer_rows,
    dropped_sales,
    join_customer,
    join_product,
    join_salesperson,
    join_store,
    sales_rows,
    with_known_keys,
)
from tallyhouse.operators.marts import customer_mart, sales_team_mart
from tallyhouse.scratch import delete, keep, recorded
from tallyhouse.sinks import jdbc, months, parquet
from tallyhouse.sinks.months import Version, Written, months_of, within
from tallyhouse.sources.dimensions import Dimensions
from tallyhouse.sources.jdbc import Database
from tallyhouse.streaming.ingest import ACCEPTED, accepted_sales, landed_rows, next_batch, taken_back
from tallyhouse.streaming.refresh import changed_keys

# The names of the mart tables in the database.
CUSTOMER_MART_TABLE = "customers_data_mart"
SALES_TEAM_MART_TABLE = "sales_team_data_mart"

#: The datasets of a version and the column that holds their month.
DATASETS = {
    "dropped_sales": "sales_month",
    "customer_rows": "sales_month",
    "customer_mart": "sales_date_month",
    "sales_rows": "sales_month",
    "sales_team_mart": "sales_month",
}
KEYS = ["customer_id", "store_id", "sales_person_id"]
PRODUCT_COLUMNS = ["product_name", "product_id", "current_price"]

#: Per dimension its key, the sale's column with that key, and what the datasets hold of it.
_HELD = {
    "customers": (
        "customer_id",
        "customer_id",
        ["customer_id", "first_name", "last_name", "address", "pincode", "phone_number"],
    ),
    "stores": ("id", "store_id", ["id", "store_manager_name"]),
    "staff": (
        "id",
        "sales_person_id",
        ["id", "first_name", "last_name", "manager_id", "is_manager", "address", "pincode"],
    ),
    "products": ("name", "product_name", ["name", "id", "current_price"]),
}
_WHOLE = "whole"


def monthly_load(
    spark: SparkSession,
    store: str,
    out: str,
    dimensions: Dimensions,
    database: Database | None = None,
) -> int:
    """Publishes customer rows, sales rows, both marts and a report as one version; returns its epoch.

    Only months that something changed in are read and written: those of the sales landed since the last
    version, of sales taken back since then, and of sales whose dimension rows are other ones now. All
    datasets become visible together, by one file, after the last of them is written.

    The sales are read once: their keys are checked into a narrow kept table, from which the report
    of dropped sales counts what a dimension lacks, and to which each row dataset joins only the
    columns it holds. Marts are totalled from what was published. This goes by slices of months, so that no
    more than one slice's shuffles and kept rows lie beside what is published. Products, if the dimensions have
    them, are joined to the sales rows. With a ``database`` its two mart tables are replaced, so a
    rerun leaves no row twice.
    """
    dimensions.require_unique_keys()
    source = source_of(spark, store, dimensions)  # before the sales are read: never says too much
    version = months.newest(spark, out)
    epoch = parquet.new_epoch(version.epoch if version else None)
    with recorded() as scratch:
        touched, changed = _to_load(spark, store, out, dimensions, version)
        written = _written(spark, store, out, dimensions, epoch, touched)
        if changed:
            written |= _dimensions_written(out, dimensions, epoch)
        months.commit(spark, out, written, epoch, source)
    delete(spark, scratch)
    if database:
        fill(spark, out, epoch, database)
    return epoch


def published(spark: SparkSession, out: str, dataset: str) -> DataFrame:
    """A dataset of the newest version."""
    return months.read(spark, out, dataset)


def catch_up(
    spark: SparkSession,
    store: str,
    out: str,
    dimensions: Dimensions,
    database: Database | None = None,
) -> int:
    """What of ``monthly_load`` is still to do; returns the epoch of the newest version.

    A version is current if it was made from all finished batches and from the dimension rows as
    they are; the database is, if both of its tables were filled from that version.
    """
    version = months.newest(spark, out)
    if version is None or version.source != source_of(spark, store, dimensions):
        return monthly_load(spark, store, out, dimensions, database)
    if database and parquet.newest(spark, f"{out}/{_filled(database)}") != version.epoch:
        fill(spark, out, version.epoch, database)
    return version.epoch


def source_of(spark: SparkSession, store: str, dimensions: Dimensions) -> str:
    """What a version made now holds: the batches before the next one, and the dimension rows."""
    return f"{next_batch(spark, store)} {dimensions.digest()}"


def fill(spark: SparkSession, out: str, epoch: int, database: Database) -> None:
    """Replaces both mart tables, and notes in the manifest that both are done."""
    for name, table in ("customer_mart", CUSTOMER_MART_TABLE), ("sales_team_mart", SALES_TEAM_MART_TABLE):
        jdbc.replace(published(spark, out, name), database, table)
    parquet.commit(spark, out, [_filled(database)], epoch)


def _filled(database: Database) -> str:
    """The manifest's name for the tables of one database; its address may hold a password."""
    return f"database-{sha256(database.url.encode()).hexdigest()[:16]}"


def _to_load(
    spark: SparkSession, store: str, out: str, dimensions: Dimensions, version: Version | None
) -> tuple[list[str | None], bool]:
    """The months to write, and whether the dimension rows are other ones than the version's."""
    if version is None:
        return months_of(accepted_sales(spark, store), "sales_month"), True
    batches, _, digest = version.source.partition(" ")
    new = list(range(int(batches), next_batch(spark, store)))
    landed = landed_rows(spark, store, new).where(F.col("outcome") == ACCEPTED).select("sales_month")
    found = set(months_of(landed.unionByName(taken_back(spark, store, new).select("sales_month")), "sales_month"))
    changed = digest != dimensions.digest()
    if changed:
        found.update(_months_of_changes(spark, store, out, dimensions, version))
    return sorted(found, key=lambda m: (m is None, m or "")), changed


def _months_of_changes(
    spark: SparkSession, store: str, out: str, dimensions: Dimensions, version: Version
) -> list[str | None]:
    """Months with a sale whose customer, store, seller or product has another row than before."""
    had_products = "dimension_products" in version.months and bool(version.months["dimension_products"])
    if had_products != (dimensions.products is not None):
        return months_of(accepted_sales(spark, store), "sales_month")
    marked, marks = accepted_sales(spark, store), []
    for name, (key, column, columns) in _HELD.items():
        table = getattr(dimensions, name)
        if table is None:
            continue
        old = months.read(spark, out, f"dimension_{name}", version=version).select(*columns)
        new = table.select(*columns)
        keys = changed_keys(old, new, key).select(F.col(key).alias(column), F.lit(True).alias(f"_{name}"))
        marked = marked.join(keep(keys, f"changed-{name}"), column, "left")
        marks.append(F.col(f"_{name}"))
    return months_of(marked.where(F.coalesce(*marks, F.lit(False))), "sales_month")


def _dimensions_written(out: str, dimensions: Dimensions, epoch: int) -> dict[str, Written]:
    """The dimension rows of a version, so that the next one can tell which have changed."""
    written = {}
    for name, (_, _, columns) in _HELD.items():
        table = getattr(dimensions, name)
        if table is not None:
            rows = table.select(*columns, F.lit(_WHOLE).alias("part"))
            dataset = f"dimension_{name}"
            written[dataset] = months.write(rows, out, dataset, "part", epoch, [_WHOLE])
    return written


def _written(
    spark: SparkSession,
    store: str,
    out: str,
    dimensions: Dimensions,
    epoch: int,
    touched: list[str | None],
) -> dict[str, Written]:
    customers, stores, staff = dimensions.customers, dimensions.stores, dimensions.staff
    products = dimensions.products
    named = [] if products is None else ["product_name"]
    accepted = accepted_sales(spark, store).where(within("sales_month", touched))
    accepted = accepted.select(*KEYS, "sales_date", "total_cost", "sales_month", *named)
    first_days = [None if m is None else f"{m}-01" for m in touched]
    labels = dict.fromkeys(DATASETS, touched) | {"customer_mart": first_days, "sales_team_mart": first_days}
    written: dict[str, Written] = {}

    def write(name: str, rows: DataFrame, sort_by: list[str] | None = None) -> DataFrame:
        written[name] = months.write(rows, out, name, DATASETS[name], epoch, labels[name], sort_by)
        return spark.read.schema(rows.schema).parquet(f"{out}/{name}/{parquet.VERSION}={epoch}")

    for some in months.slices(accepted, "sales_month", touched):
        of_slice = within("sales_month", some)
        with recorded() as scratch:
            sales = with_known_keys(accepted.where(of_slice), customers, stores, staff)
            checked = keep(sales, "checked-sales")
            known = checked.where(" AND ".join(KNOWN)).drop(*KNOWN)

            write("dropped_sales", dropped_sales(checked, ["sales_month"]))
            bought = customer_rows(join_customer(known, customers), ["sales_month"])
            bought = write("customer_rows", bought, ["customer_id"]).where(of_slice)
            write("customer_mart", customer_mart(bought, customers), ["customer_id"])

            rows = join_salesperson(join_store(known.drop("sales_month"), stores), staff)
            if products is None:
                rows = sales_rows(rows)
            else:
                rows = sales_rows(join_product(rows, products), PRODUCT_COLUMNS)
            sold = write("sales_rows", rows, ["store_id"]).where(of_slice)
            sold = sales_team_mart(sold.drop("sales_month"), None, stores, staff)
            write("sales_team_mart", sold)
        delete(spark, scratch)
    return written
