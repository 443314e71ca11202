"""Names, table schemas and fixed values of the retail data model."""

from pyspark.sql import types as T

# The columns a raw invoice-line file must have.
RAW_COLUMNS = (
    "Invoice",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "Price",
    "Customer ID",
    "Country",
)

# A line without one of these is not usable.
CRITICAL_COLUMNS = ("Invoice", "StockCode", "InvoiceDate", "Price", "Quantity")

# What stands in for missing text and for a missing customer.
UNKNOWN_TEXT = "Unknown"
GUEST_CUSTOMER = 0

# Cancelled invoices, and the smallest price of a sale.
CANCELLED_PREFIX = "C"
MINIMUM_PRICE = 0.01

# The region group of each named country; all others are "Other".
REGION_GROUPS = {
    "Europe": (
        "United Kingdom", "Germany", "France", "Spain", "Netherlands", "Belgium",
        "Switzerland", "Portugal", "Italy", "Norway", "Denmark", "Finland", "Sweden",
        "Austria", "Greece", "Cyprus", "Malta", "Poland", "Czech Republic",
        "Lithuania", "Iceland",
    ),
    "Americas": ("USA", "Canada", "Brazil"),
    "Asia": ("Japan", "China", "Singapore", "Hong Kong", "India", "Bahrain"),
}
OTHER_REGION = "Other"

#: Holds any bigint quantity times a price of ten integer digits.
MONEY = T.DecimalType(31, 2)
MONEY_TOTAL = T.DecimalType(38, 2)


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


DIM_CUSTOMER = _schema(customer_id=T.LongType(), country=T.StringType())
DIM_PRODUCT = _schema(stock_code=T.StringType(), description=T.StringType())
DIM_DATE = _schema(
    date_id=T.LongType(),
    full_date=T.TimestampNTZType(),
    year=T.IntegerType(),
    month=T.IntegerType(),
    day=T.IntegerType(),
    hour=T.IntegerType(),
    weekday=T.IntegerType(),
    is_weekend=T.BooleanType(),
)
DIM_REGION = _schema(
    region_id=T.LongType(), country=T.StringType(), region_group=T.StringType()
)
FACT_SALES = _schema(
    sale_id=T.LongType(),
    invoice=T.StringType(),
    customer_id=T.LongType(),
    stock_code=T.StringType(),
    date_id=T.LongType(),
    region_id=T.LongType(),
    quantity=T.LongType(),
    price=T.DoubleType(),
    revenue=MONEY,
)

STAR_SCHEMAS = {
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    "dim_date": DIM_DATE,
    "dim_region": DIM_REGION,
    "fact_sales": FACT_SALES,
}

# Keys, references and text widths of the star schema.
UNIQUE_KEYS = (
    ("primary_key", "dim_customer", "customer_id"),
    ("primary_key", "dim_product", "stock_code"),
    ("primary_key", "dim_date", "date_id"),
    ("primary_key", "dim_region", "region_id"),
    ("unique", "dim_region", "country"),
    ("primary_key", "fact_sales", "sale_id"),
)
FOREIGN_KEYS = (
    ("customer_id", "dim_customer"),
    ("stock_code", "dim_product"),
    ("date_id", "dim_date"),
    ("region_id", "dim_region"),
)
TEXT_WIDTHS = {
    "dim_customer": {"country": 100},
    "dim_product": {"stock_code": 50},
    "dim_region": {"country": 100, "region_group": 100},
    "fact_sales": {"invoice": 20, "stock_code": 50},
}
