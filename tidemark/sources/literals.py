"""Reference rows that are part of the program."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources import schemas

# The product catalogue (id, name, category, price, supplier).
PRODUCTS = [
    ("P00001", "Wireless Headphones Pro", "electronics", 89.99, "SUP001"),
    ("P00002", "USB-C Charging Cable 2m", "electronics", 12.99, "SUP001"),
    ("P00003", "Bluetooth Speaker Mini", "electronics", 49.99, "SUP001"),
    ("P00004", "Laptop Stand Aluminium", "electronics", 34.99, "SUP002"),
    ("P00005", "Mechanical Keyboard TKL", "electronics", 129.99, "SUP002"),
    ("P00006", "Running Shoes Lite", "sports", 79.99, "SUP003"),
    ("P00007", "Yoga Mat Premium 6mm", "sports", 29.99, "SUP003"),
    ("P00008", "Water Bottle 1L Steel", "sports", 24.99, "SUP003"),
    ("P00009", "Men T-Shirt Cotton", "clothing", 19.99, "SUP004"),
    ("P00010", "Women Hoodie Fleece", "clothing", 44.99, "SUP004"),
    ("P00011", "Denim Jeans Slim Fit", "clothing", 59.99, "SUP004"),
    ("P00012", "Face Moisturiser SPF50", "beauty", 18.99, "SUP005"),
    ("P00013", "Shampoo Argan Oil 300ml", "beauty", 12.99, "SUP005"),
    ("P00014", "Electric Toothbrush S2", "beauty", 39.99, "SUP005"),
    ("P00015", "Coffee Mug Ceramic 350ml", "home", 14.99, "SUP006"),
    ("P00016", "Scented Candle Lavender", "home", 11.99, "SUP006"),
    ("P00017", "Cutting Board Bamboo", "home", 22.99, "SUP006"),
    ("P00018", "Python for Data Science", "books", 39.99, "SUP007"),
    ("P00019", "The Lean Startup", "books", 16.99, "SUP007"),
    ("P00020", "Atomic Habits", "books", 14.99, "SUP007"),
    ("P00021", "Organic Granola 500g", "food", 8.99, "SUP008"),
    ("P00022", "Dark Chocolate 85% 100g", "food", 4.99, "SUP008"),
    ("P00023", "Green Tea Matcha 100g", "food", 12.99, "SUP008"),
    ("P00024", "Noise-Cancelling Earbuds", "electronics", 99.99, "SUP001"),
    ("P00025", "Smart Watch Basic", "electronics", 149.99, "SUP002"),
]

# Delivery regions (id, country, name, country code).
REGIONS = [
    ("nl-north", "Netherlands", "North", "NL"),
    ("nl-south", "Netherlands", "South", "NL"),
    ("nl-east", "Netherlands", "East", "NL"),
    ("nl-west", "Netherlands", "West", "NL"),
    ("nl-central", "Netherlands", "Central", "NL"),
    ("be-flanders", "Belgium", "Flanders", "BE"),
    ("be-wallonia", "Belgium", "Wallonia", "BE"),
    ("de-north", "Germany", "North", "DE"),
    ("de-south", "Germany", "South", "DE"),
]


def inline_products(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRODUCTS, schemas.PRODUCTS)


def inline_regions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGIONS, schemas.REGION_ROWS)
