"""Column contracts of the sales files, the dimensions and the marts."""

from pyspark.sql import types as T

# Fixed values throughout this module: the names of the columns of files, dimensions and marts.

# The columns every sales file has to carry, in their order.
CONTRACT = [
    "customer_id",
    "store_id",
    "product_name",
    "sales_date",
    "sales_person_id",
    "price",
    "quantity",
    "total_cost",
]
OVERFLOW = "additional_columns"

MONEY = T.DecimalType(18, 2)
PRICE = T.DecimalType(10, 2)
TOTAL = T.DecimalType(28, 2)

LONG, INT, TEXT, DATE, TIME = (
    T.LongType(),
    T.IntegerType(),
    T.StringType(),
    T.DateType(),
    T.TimestampType(),
)
NAMES = T.ArrayType(TEXT)


def table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])



# Keys are 64-bit: a 32-bit customer key runs out long before 100 TB of sales.
CONTRACT_TYPES = {
    "customer_id": LONG,
    "store_id": LONG,
    "product_name": TEXT,
    "sales_date": DATE,
    "sales_person_id": LONG,
    "price": MONEY,
    "quantity": INT,
    "total_cost": MONEY,
}

FACT = table(**CONTRACT_TYPES, additional_columns=TEXT)
FACT_COLUMNS = FACT.names

CUSTOMER = table(
    customer_id=LONG,
    first_name=TEXT,
    last_name=TEXT,
    address=TEXT,
    pincode=TEXT,
    phone_number=TEXT,
    customer_joining_date=DATE,
)
STORE = table(
    id=LONG,
    address=TEXT,
    store_pincode=TEXT,
    store_manager_name=TEXT,
    store_opening_date=DATE,
    reviews=TEXT,
)
PRODUCT = table(
    id=LONG,
    name=TEXT,
    current_price=PRICE,
    old_price=PRICE,
    created_date=TIME,
    updated_date=TIME,
    expiry_date=DATE,
)
SALES_TEAM = table(
    id=LONG,
    first_name=TEXT,
    last_name=TEXT,
    manager_id=LONG,
    is_manager=TEXT,
    address=TEXT,
    pincode=TEXT,
    joining_date=DATE,
)

INVENTORY = table(path=TEXT, length=LONG, modificationTime=TIME)
FILES = table(
    path=TEXT,
    file_name=TEXT,
    length=LONG,
    modificationTime=TIME,
    columns=NAMES,
    missing=NAMES,
    extra=NAMES,
    accepted=T.BooleanType(),
    reason=TEXT,
    header=TEXT,
    replaces=LONG,
    load_batch=LONG,
)
FILE_STATE = table(path=TEXT, load_batch=LONG, modificationTime=TIME, length=LONG, counts_from=LONG)
WITHDRAWN = table(path=TEXT, load_batch=LONG)
FINISHED = table(at=TIME, load_batch=LONG)
LEDGER = table(file_name=TEXT, file_location=TEXT, status=TEXT, at=TIME, load_batch=LONG)
FIELD_ERRORS = T.ArrayType(table(column=TEXT, value=TEXT, expected=TEXT))
ROWS = table(
    **CONTRACT_TYPES, additional_columns=TEXT, path=TEXT, file_name=TEXT, errors=FIELD_ERRORS, raw_line=TEXT
)
LANDED = table(
    **CONTRACT_TYPES,
    additional_columns=TEXT,
    path=TEXT,
    file_name=TEXT,
    reason=TEXT,
    errors=FIELD_ERRORS,
    raw_line=TEXT,
    load_batch=LONG,
    outcome=TEXT,
    sales_month=TEXT,
)
SUMS = table(
    customer_id=LONG,
    store_id=LONG,
    sales_person_id=LONG,
    total_cost=TOTAL,
    n_sales=LONG,
    sales_month=TEXT,
)

# The columns of the two row datasets, in their order.
CUSTOMER_ROW_COLUMNS = [
    "customer_id",
    "first_name",
    "last_name",
    "address",
    "pincode",
    "phone_number",
    "sales_date",
    "total_cost",
]
SALES_ROW_COLUMNS = [
    "store_id",
    "sales_person_id",
    "sales_person_first_name",
    "sales_person_last_name",
    "store_manager_name",
    "manager_id",
    "is_manager",
    "sales_person_address",
    "sales_person_pincode",
    "sales_date",
    "total_cost",
]

CUSTOMER_MART = table(
    customer_id=LONG,
    full_name=TEXT,
    address=TEXT,
    phone_number=TEXT,
    sales_date_month=DATE,
    total_sales=TOTAL,
)
SALES_TEAM_MART = table(
    store_id=LONG,
    sales_person_id=LONG,
    full_name=TEXT,
    sales_month=DATE,
    total_sales=TOTAL,
    incentive=TOTAL,
)
