"""Declared schemas. Nothing in the library relies on inferred types."""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from hearthside import vocab

_RAW_DOUBLES = {"price_numeric", "price_per_sqm", "area_numeric", "latitude", "longitude"}

RAW = StructType(
    [StructField(c, DoubleType() if c in _RAW_DOUBLES else StringType()) for c in vocab.RECORD_ORDER]
)

_EXTRACTED_TYPES = {
    "down_payment_egp": DoubleType(),
    "installment_years": IntegerType(),
    "monthly_installment_egp": DoubleType(),
    "floor_number": IntegerType(),
}

EXTRACTED = StructType(
    [
        StructField(c, BooleanType() if c.startswith("has_") else _EXTRACTED_TYPES.get(c, StringType()))
        for c in vocab.EXTRACTED_FEATURES
    ]
)

ENRICHED = StructType(RAW.fields + [f for f in EXTRACTED.fields if f.name not in RAW.fieldNames()])

_REQUEST_DOUBLES = ["bedrooms", "bathrooms", "area_numeric", "latitude", "longitude"]
_REQUEST_STRINGS = [
    "property_type", "city", "governorate", "finish_type", "seller_name", "view_type", "compound_name",
]
_REQUEST_TAIL = ["seller_type", "furnished", "ownership", "payment_option", "completion_status"]

REQUEST_REQUIRED = StructType(
    [StructField(c, DoubleType()) for c in _REQUEST_DOUBLES]
    + [StructField(c, StringType()) for c in _REQUEST_STRINGS]
    + [StructField("delivery_date", DoubleType())]
    + [StructField(c, StringType()) for c in _REQUEST_TAIL]
)

REQUEST = StructType(
    REQUEST_REQUIRED.fields + [StructField(c, BooleanType()) for c in vocab.AMENITY_FLAGS]
)

PROCESSED = StructType(
    [
        StructField(c, StringType() if c in vocab.CATEGORICALS else DoubleType())
        for c in vocab.MODEL_COLUMNS
    ]
    + [StructField("price_numeric", DoubleType())]
)

INGEST_STATE = StructType(
    [
        StructField("completed_tasks", StringType()),
        StructField("current_task", StringType()),
        StructField("current_task_page", IntegerType()),
        StructField("total_records", IntegerType()),
    ]
)
