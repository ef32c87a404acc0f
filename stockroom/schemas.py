"""Declared table shapes, enum domains and message texts.

Fixed values: the enum members, the urgency ladder labels and the error texts below must
equal the reference service's values for results to match; they are listed here as plain
text, in natural order, in one place.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values (domain enums) -------------------------------------------------------
EVENT_TYPES = ["PURCHASE", "SALE", "DAMAGE", "ADJUSTMENT", "RETURN", "WASTE"]
INFLOW_TYPES = ["PURCHASE", "RETURN"]  # quantity kept positive
OUTFLOW_TYPES = ["SALE", "DAMAGE", "WASTE"]  # positive input negated; guarded against oversell
PO_STATUSES = ["DRAFT", "SUBMITTED", "RECEIVED"]
URGENCY_LEVELS = ["STOCKOUT", "URGENT", "LOW", "OK", "NO_FORECAST"]

# ---- fixed values (message texts) ------------------------------------------------------
MSG_ZERO_QUANTITY = "Quantity cannot be zero"
MSG_MUST_BE_POSITIVE = " quantity must be positive"
MSG_UNSUPPORTED_TYPE = "Unsupported event type"
MSG_INSUFFICIENT = "Insufficient inventory"
MSG_SKU_NOT_FOUND = "Product with SKU '{sku}' not found"
MSG_PRODUCT_NOT_FOUND = "Product {product_id} not found"
MSG_SUPPLIER_NOT_FOUND = "Supplier {supplier_id} not found"
MSG_PO_NOT_FOUND = "Purchase order {po_id} not found"
MSG_PO_LINE_NOT_FOUND = "Purchase order line {line_id} not found"
MSG_PO_STATE = "Cannot {action} purchase order {po_id} in status {status}"
MSG_DUPLICATE_SKU = "Product with this SKU already exists: "
MSG_SELF_RECIPE = "A product cannot be an ingredient of itself"
# Field validation messages of the row model (first failing field, in field order).
MSG_FIELD_SKU = "sku: String should have at least 1 character"
MSG_FIELD_SKU_LONG = "sku: String should have at most 100 characters"
MSG_FIELD_TYPE = "event_type: Input should be 'PURCHASE', 'SALE', 'DAMAGE', 'ADJUSTMENT', 'RETURN' or 'WASTE'"
MSG_FIELD_QTY_INT = "quantity: Input should be a valid integer, unable to parse string as an integer"
MSG_FIELD_QTY_ZERO = "quantity: Value error, Quantity cannot be zero"
MSG_FIELD_EVENT_ID = "event_id: String should have at least 1 character"
MSG_FIELD_EVENT_ID_LONG = "event_id: String should have at most 100 characters"
MSG_FIELD_TEXT_SHORT = "{field}: String should have at least 1 character"
MSG_FIELD_TEXT_LONG = "{field}: String should have at most {most} characters"
MSG_FIELD_MISSING_STR = "{field}: Input should be a valid string"
MSG_FIELD_QTY_MISSING = "quantity: Input should be a finite number"

# ---- fixed values (limits) ---------------------------------------------------------------
MAX_TEXT_LEN = 100  # sku / event_id / external_id
MAX_SOURCE_LEN = 50
MIN_TRAINING_DAYS = 14
PAGE_DEFAULT, PAGE_MAX = 50, 500
DASHBOARD_PAGE = 20
NO_DEMAND_DAYS = 999
SAFETY_FRACTION = 0.20
HORIZON_DAYS = 7

# ---- table shapes --------------------------------------------------------------------------
EVENT_LOG = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("organization_id", T.IntegerType()),
    ]
)
EVENT_LOG_COLUMNS = [f.name for f in EVENT_LOG.fields]

# Lake file before tenancy was added (schema drift case): no organization_id.
LEGACY_EVENT_LOG = T.StructType([f for f in EVENT_LOG.fields if f.name != "organization_id"])

INGEST_ROW = T.StructType(
    [
        T.StructField("sku", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("quantity", T.StringType()),
        T.StructField("event_id", T.StringType()),
    ]
)
INGEST_COLUMNS = [f.name for f in INGEST_ROW.fields]

WEBHOOK_ITEM = T.StructType(
    [
        T.StructField("sku", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("quantity", T.StringType()),
        T.StructField("external_id", T.StringType()),
    ]
)
WEBHOOK_PAYLOAD = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("events", T.ArrayType(WEBHOOK_ITEM)),
    ]
)

FEATURES = T.StructType(
    [
        T.StructField("organization_id", T.IntegerType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("date", T.StringType()),
        T.StructField("units_sold", T.LongType()),
        T.StructField("units_purchased", T.LongType()),
        T.StructField("net_delta", T.LongType()),
        T.StructField("rolling_avg_7d", T.DoubleType()),
    ]
)
