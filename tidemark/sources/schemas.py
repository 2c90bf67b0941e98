"""The column layouts of the incoming feeds.

Dates stay text in the raw layer and are parsed during validation.  File sources
ignore NOT NULL, so missing keys are caught by rules, not here.
"""

CUSTOMERS = (
    "customer_id STRING, first_name STRING, last_name STRING, email STRING, phone STRING, "
    "city STRING, country STRING, region STRING, segment STRING, signup_date STRING"
)
RETURNS = (
    "return_id STRING, order_id STRING, customer_id STRING, product_id STRING, "
    "return_date STRING, reason_code STRING, refund_amount DOUBLE"
)
ORDER_EVENT = (
    "order_id STRING, customer_id STRING, product_id STRING, quantity INT, "
    "unit_price DOUBLE, order_ts STRING"
)
PRODUCTS = (
    "product_id STRING, product_name STRING, category STRING, unit_price DOUBLE, supplier_id STRING"
)
REGIONS = "region_code STRING, region_name STRING, country STRING, timezone STRING"
REGION_ROWS = "region_id STRING, country STRING, region_name STRING, country_code STRING"
CATEGORIES = (
    "category STRING, sub_category STRING, display_name STRING, is_seasonal STRING, margin_band STRING"
)

RETURN_REASONS = (
    "damaged", "wrong_size", "wrong_item", "changed_mind", "not_as_described", "arrived_late",
)
RETURN_STATUSES = ("pending", "approved", "rejected")
ORDER_STATUSES = ("placed", "confirmed")
CUSTOMER_SEGMENTS = ("standard", "premium", "vip")
