"""The two ready-made cleaning configurations and the column-name candidates."""

from __future__ import annotations

from ledgerloom.config import CleaningConfig

# ---------------------------------------------------------------------------
# Field names, formats, city and category lists, payment labels
# and column candidates that input files rely on.
# ---------------------------------------------------------------------------

CANONICAL_CITIES = ["Bengaluru", "Mumbai", "Delhi", "Hyderabad", "Chennai", "Kolkata", "Pune", "Jaipur"]
CITY_MAPPINGS = {"Bangalore": "Bengaluru", "Bombay": "Mumbai", "New Delhi": "Delhi"}
CITY_CUTOFF = 0.87

CATEGORY_MAPPINGS = {
    "electronic": "electronics",
    "electronics": "electronics",
    "electronics & accessories": "electronics",
    "electronic accessories": "electronics",
}

PAYMENT_MAPPINGS = {
    "GooglePay": "UPI",
    "PhonePe": "UPI",
    "CREDIT_CARD": "Credit Card",
    "CC": "Credit Card",
    "COD": "Cash on Delivery",
    "C.O.D": "Cash on Delivery",
}

TRANSACTION_DATE_FORMATS = ["%d/%m/%Y", "%d-%m-%y", "%Y-%m-%d"]

TRANSACTIONS = CleaningConfig.from_dict({
    "dates": {"fields": ["order_date"], "input_formats": TRANSACTION_DATE_FORMATS, "invalid_to_null": True},
    "price": {"fields": ["original_price_inr"], "coerce_invalid_to_null": True},
    "ratings": {"column": "customer_rating"},
    "categorical": {"fields": ["category"], "mappings": {"category": CATEGORY_MAPPINGS}},
    "geo": {
        "city_field": "customer_city",
        "canonical_cities": CANONICAL_CITIES,
        "city_mappings": CITY_MAPPINGS,
        "fuzzy_threshold": CITY_CUTOFF,
    },
    "booleans": {"fields": ["is_prime_member", "is_prime_eligible", "is_festival_sale"]},
    "delivery": {"column": "delivery_days"},
    "dedup": {"key_fields": ["customer_id", "product_id", "order_date", "original_price_inr"]},
    "outliers": {"column": "original_price_inr"},
    "payment": {"column": "payment_method", "extra_mappings": PAYMENT_MAPPINGS},
})

CATALOG = CleaningConfig.from_dict({
    "missing": {"include": [
        "base_price_2015", "weight_kg", "rating", "category", "subcategory",
        "brand", "model", "is_prime_eligible", "launch_year",
    ]},
    "dates": {"input_formats": []},
    "price": {"fields": ["base_price_2015"]},
    "categorical": {"fields": ["category", "subcategory", "brand", "model"]},
    "geo": {"fuzzy_threshold": CITY_CUTOFF},
})

# logical field -> accepted column names, first present wins
LOADER_COLUMNS = {
    "order_date": ["order_date", "date"],
    "revenue": ["revenue", "total_amount", "original_price_inr", "amount", "total"],
    "quantity": ["quantity", "qty", "units"],
    "unit_price": ["unit_price", "price", "base_price_2015"],
    "order_id": ["order_id", "transaction_id"],
    "customer_id": ["customer_id", "cust_id", "user_id"],
    "product_id": ["product_id", "sku"],
    "category": ["category", "Category"],
    "brand": ["brand", "Brand"],
    "payment_method": ["payment_method", "payment"],
    "city": ["city", "customer_city"],
    "state": ["state", "customer_state"],
    "is_prime_member": ["is_prime_member", "prime"],
    "delivery_days": ["delivery_days"],
    "customer_rating": ["customer_rating", "rating"],
    "discount_pct": ["discount_pct", "discount"],
    "is_returned": ["is_returned", "returned"],
}

EXPLORE_COLUMNS = {
    "order_date": ["order_date", "date", "orderDate", "Order Date", "order_dt"],
    "revenue": ["total_amount", "original_price_inr", "revenue", "amount", "total", "grand_total"],
    "quantity": ["quantity", "qty", "units"],
    "customer_id": ["customer_id", "cust_id", "user_id"],
    "category": ["category", "Category"],
    "payment_method": ["payment_method", "payment", "paymentType"],
    "city": ["customer_city", "city"],
    "state": ["state", "customer_state"],
    "is_prime_member": ["is_prime_member", "prime", "isPrime"],
    "customer_rating": ["customer_rating", "rating", "ratings"],
    "delivery_days": ["delivery_days", "deliveryDays"],
    "brand": ["brand", "Brand"],
    "unit_price": ["unit_price"],
}

CATALOG_COLUMNS = [
    "product_id", "product_name", "brand", "category", "subcategory",
    "launch_year", "base_price_2015", "weight_kg",
]

EXPLORE_DATE_FORMATS = ["%Y-%m-%d", "%d/%m/%Y", "%d-%m-%y", "%d-%m-%Y", "%m/%d/%Y"]
