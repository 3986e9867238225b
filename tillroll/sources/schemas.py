"""Table schemas; ids and counters are widened to BIGINT."""

from __future__ import annotations

from pyspark.sql import types as T

RAW = T.StructType(
    [
        T.StructField("invoice", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("invoice_date", T.TimestampNTZType()),
        T.StructField("price", T.DecimalType(10, 3)),
        T.StructField("customer_id", T.LongType()),
        T.StructField("country", T.StringType()),
    ]
)

# Column headers of the retail workbook, in the order of RAW.
WORKBOOK_HEADERS = (
    "Invoice",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "Price",
    "Customer ID",
    "Country",
)

SALES = T.StructType(
    [
        T.StructField("invoice_id", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("invoice_date", T.TimestampNTZType()),
        T.StructField("unit_price", T.DecimalType(10, 3)),
        T.StructField("customer_id", T.LongType()),
        T.StructField("country", T.StringType()),
        T.StructField("line_amount", T.DecimalType(12, 2)),
    ]
)

CUSTOMER_RFM = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("recency", T.IntegerType()),
        T.StructField("frequency", T.LongType()),
        T.StructField("monetary", T.DecimalType(18, 2)),
        T.StructField("r_score", T.IntegerType()),
        T.StructField("f_score", T.IntegerType()),
        T.StructField("m_score", T.IntegerType()),
        T.StructField("rfm_segment", T.StringType()),
    ]
)
