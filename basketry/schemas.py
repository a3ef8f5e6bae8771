"""Typed schemas of the six raw inputs (no inference anywhere).

Identifiers are 64-bit: at the target scale order and user ids exceed the
32-bit range the original files happen to fit in.
"""

from pyspark.sql import types as T

AUDIT_FIELDS = [
    T.StructField("_loaded_at", T.TimestampType(), True),
    T.StructField("_source_file", T.StringType(), True),
]

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("order_number", T.IntegerType(), True),
    T.StructField("order_dow", T.IntegerType(), True),
    T.StructField("order_hour_of_day", T.IntegerType(), True),
    T.StructField("days_since_prior_order", T.DoubleType(), True),
])

ORDER_PRODUCTS = T.StructType([
    T.StructField("order_id", T.LongType(), True),
    T.StructField("product_id", T.LongType(), True),
    T.StructField("add_to_cart_order", T.IntegerType(), True),
    T.StructField("reordered", T.IntegerType(), True),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType(), True),
    T.StructField("product_name", T.StringType(), True),
    T.StructField("aisle_id", T.LongType(), True),
    T.StructField("department_id", T.LongType(), True),
])

AISLES = T.StructType([
    T.StructField("aisle_id", T.LongType(), True),
    T.StructField("aisle", T.StringType(), True),
])

DEPARTMENTS = T.StructType([
    T.StructField("department_id", T.LongType(), True),
    T.StructField("department", T.StringType(), True),
])

# Raw table name → (file name in a landing folder, schema). the
# six input files of the grocery dataset.
RAW_FILES = {
    "orders": ("orders.csv", ORDERS),
    "order_products_prior": ("order_products__prior.csv", ORDER_PRODUCTS),
    "order_products_train": ("order_products__train.csv", ORDER_PRODUCTS),
    "products": ("products.csv", PRODUCTS),
    "aisles": ("aisles.csv", AISLES),
    "departments": ("departments.csv", DEPARTMENTS),
}

RAW_TABLES = list(RAW_FILES)


def with_audit(schema: T.StructType) -> T.StructType:
    """A raw schema followed by the audit columns."""
    return T.StructType(list(schema.fields) + AUDIT_FIELDS)
