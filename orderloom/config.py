"""Tables, keys and thresholds of the order model. Plain data, no behaviour."""

from __future__ import annotations

from dataclasses import dataclass

# Raw columns and the names staging gives them, per source.
CUSTOMERS = {
    "customer_id": "customer_id",
    "customer_unique_id": "customer_unique_id",
    "customer_zip_code_prefix": "zip_code",
    "customer_city": "city",
    "customer_state": "state",
}
ORDERS = {
    "order_id": "order_id",
    "customer_id": "customer_id",
    "order_status": "order_status",
    "order_purchase_timestamp": "purchased_at",
    "order_approved_at": "approved_at",
    "order_delivered_carrier_date": "delivered_carrier_at",
    "order_delivered_customer_date": "delivered_customer_at",
    "order_estimated_delivery_date": "estimated_delivery_at",
}
ORDER_ITEMS = {
    "order_id": "order_id",
    "order_item_id": "order_item_id",
    "product_id": "product_id",
    "seller_id": "seller_id",
    "shipping_limit_date": "shipping_limit_at",
    "price": "price",
    "freight_value": "freight",
}
ORDER_PAYMENTS = {
    "order_id": "order_id",
    "payment_sequential": "payment_sequential",
    "payment_type": "payment_type",
    "payment_installments": "payment_installments",
    "payment_value": "payment_value",
}
ORDER_REVIEWS = {
    "review_id": "review_id",
    "order_id": "order_id",
    "review_score": "review_score",
    "review_comment_title": "review_comment_title",
    "review_comment_message": "review_comment_message",
    "review_creation_date": "created_at",
    "review_answer_timestamp": "answered_at",
}
PRODUCTS = {
    "product_id": "product_id",
    "product_category_name": "category_name",
    "product_name_lenght": "name_length",
    "product_description_lenght": "description_length",
    "product_photos_qty": "photos_qty",
    "product_weight_g": "weight_g",
    "product_length_cm": "length_cm",
    "product_height_cm": "height_cm",
    "product_width_cm": "width_cm",
}
SELLERS = {
    "seller_id": "seller_id",
    "seller_zip_code_prefix": "zip_code_prefix",
    "seller_city": "city",
    "seller_state": "state",
}
GEOLOCATION = {
    "geolocation_zip_code_prefix": "zip_code_prefix",
    "geolocation_lat": "latitude",
    "geolocation_lng": "longitude",
    "geolocation_city": "city",
    "geolocation_state": "state",
}
CATEGORY_TRANSLATION = {
    "product_category_name": "category_name",
    "product_category_name_english": "category_name_english",
}

# Payment types that get a column of their own.
PAYMENT_COLUMNS = {
    "credit_card": "credit_card_amount",
    "boleto": "boleto_amount",
    "voucher": "voucher_amount",
    "debit_card": "debit_card_amount",
}

# Staged lineage; the batch id stays in raw.
STAGED_LINEAGE = {"_ingested_at": "_ingested_at", "_source_file": "_source_file"}


@dataclass(frozen=True)
class Source:
    """A raw table: its file name less the data set's prefix, key and columns."""

    file: str
    key: str
    columns: dict[str, str]
    prefixed: bool = True

    def table(self, prefix: str) -> str:
        return f"{prefix}{self.file}" if self.prefixed else self.file


SOURCES = {
    "customers": Source("customers_dataset", "customer_id", CUSTOMERS),
    "orders": Source("orders_dataset", "order_id", ORDERS),
    "order_items": Source("order_items_dataset", "order_id", ORDER_ITEMS),
    "order_payments": Source("order_payments_dataset", "order_id", ORDER_PAYMENTS),
    "order_reviews": Source("order_reviews_dataset", "review_id", ORDER_REVIEWS),
    "products": Source("products_dataset", "product_id", PRODUCTS),
    "sellers": Source("sellers_dataset", "seller_id", SELLERS),
    "geolocation": Source("geolocation_dataset", "geolocation_zip_code_prefix", GEOLOCATION),
    "category_translation": Source("product_category_name_translation",
                                   "product_category_name", CATEGORY_TRANSLATION,
                                   prefixed=False),
}

# Age of the newest load at which a source warns, then fails.
FRESHNESS_WARN_HOURS = 24
FRESHNESS_ERROR_HOURS = 48
