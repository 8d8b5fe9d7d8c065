"""Raw column types and the typed, constrained model tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

STRING, INT, DOUBLE = T.StringType(), T.IntegerType(), T.DoubleType()
TIMESTAMP, BOOLEAN = T.TimestampNTZType(), T.BooleanType()

# Raw columns that are not text. Every other raw column is text.
RAW_TYPES: dict[str, dict[str, T.DataType]] = {
    "orders": {
        "order_purchase_timestamp": TIMESTAMP,
        "order_approved_at": TIMESTAMP,
        "order_delivered_carrier_date": TIMESTAMP,
        "order_delivered_customer_date": TIMESTAMP,
        "order_estimated_delivery_date": TIMESTAMP,
    },
    "order_items": {
        "order_item_id": INT,
        "shipping_limit_date": TIMESTAMP,
        "price": DOUBLE,
        "freight_value": DOUBLE,
    },
    "customers": {"customer_zip_code_prefix": INT},
    "sellers": {"seller_zip_code_prefix": INT},
    "products": {
        "product_name_lenght": INT,
        "product_description_lenght": INT,
        "product_photos_qty": INT,
        "product_weight_g": DOUBLE,
        "product_length_cm": DOUBLE,
        "product_height_cm": DOUBLE,
        "product_width_cm": DOUBLE,
    },
    "translation": {},
    "geolocation": {
        "geolocation_zip_code_prefix": INT,
        "geolocation_lat": DOUBLE,
        "geolocation_lng": DOUBLE,
    },
    "reviews": {
        "review_score": INT,
        "review_creation_date": TIMESTAMP,
        "review_answer_timestamp": TIMESTAMP,
    },
    "payments": {
        "payment_sequential": INT,
        "payment_installments": INT,
        "payment_value": DOUBLE,
    },
}


# Texts that stand for "no value" in a raw CSV cell.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Only reviews carry free text with line breaks; every other table is read line by line.
MULTI_LINE = {"reviews"}


@dataclass(frozen=True)
class Table:
    """Columns of a model table with the rules its rows must keep."""

    columns: dict[str, T.DataType]
    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    references: dict[str, str] = field(default_factory=dict)
    ranges: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)

    def schema(self, key_type: T.DataType = STRING) -> T.StructType:
        """Spark schema; identifiers are text unless another key type is given."""
        must = set(self.key) | set(self.required)
        return T.StructType(
            [
                T.StructField(name, key_type if kind is None else kind, name not in must)
                for name, kind in self.columns.items()
            ]
        )


ID = None  # an identifier column: takes the model's key type

# The model's tables, columns, keys, references and ranges.
MODEL: dict[str, Table] = {
    "customers": Table(
        columns={
            "customer_id": ID,
            "customer_unique_id": STRING,
            "customer_zip_code_prefix": INT,
            "customer_city": STRING,
            "customer_state": STRING,
        },
        key=("customer_id",),
        required=(
            "customer_unique_id",
            "customer_zip_code_prefix",
            "customer_city",
            "customer_state",
        ),
    ),
    "sellers": Table(
        columns={
            "seller_id": ID,
            "seller_zip_code_prefix": INT,
            "seller_city": STRING,
            "seller_state": STRING,
        },
        key=("seller_id",),
        required=("seller_zip_code_prefix", "seller_city", "seller_state"),
    ),
    "products": Table(
        columns={"product_id": ID, "product_category": STRING},
        key=("product_id",),
    ),
    "geolocation": Table(
        columns={
            "geolocation_zip_code_prefix": INT,
            "geolocation_lat": DOUBLE,
            "geolocation_lng": DOUBLE,
        },
        key=("geolocation_zip_code_prefix",),
        required=("geolocation_lat", "geolocation_lng"),
    ),
    "orders": Table(
        columns={
            "order_id": ID,
            "customer_id": ID,
            "order_status": STRING,
            "order_purchase_timestamp": TIMESTAMP,
            "order_approved_at": TIMESTAMP,
            "order_delivered_carrier_date": TIMESTAMP,
            "order_delivered_customer_date": TIMESTAMP,
            "order_estimated_delivery_date": TIMESTAMP,
            "delay_days": INT,
            "is_late": BOOLEAN,
            "approval_hours": DOUBLE,
            "preparation_hours": DOUBLE,
            "transit_hours": DOUBLE,
            "carrier_before_approved": BOOLEAN,
            "delivered_before_carrier": BOOLEAN,
        },
        key=("order_id",),
        required=(
            "customer_id",
            "order_status",
            "order_purchase_timestamp",
            "order_estimated_delivery_date",
        ),
        references={"customer_id": "customers"},
        ranges={
            "approval_hours": (0, None),
            "preparation_hours": (0, None),
            "transit_hours": (0, None),
        },
    ),
    "reviews": Table(
        columns={"order_id": ID, "review_score": INT},
        key=("order_id",),
        required=("review_score",),
        references={"order_id": "orders"},
        ranges={"review_score": (1, 5)},
    ),
    "order_items": Table(
        columns={
            "order_id": ID,
            "order_item_id": INT,
            "product_id": ID,
            "seller_id": ID,
            "shipping_limit_date": TIMESTAMP,
            "price": DOUBLE,
            "freight_value": DOUBLE,
            "missed_shipping_deadline": BOOLEAN,
            "distance_km": DOUBLE,
        },
        key=("order_id", "order_item_id"),
        required=(
            "product_id",
            "seller_id",
            "shipping_limit_date",
            "price",
            "freight_value",
        ),
        references={"order_id": "orders", "product_id": "products", "seller_id": "sellers"},
    ),
}

# Code, name and region of the Brazilian states.
BRAZIL_STATES = [
    ("AC", "Acre", "North"),
    ("AL", "Alagoas", "Northeast"),
    ("AM", "Amazonas", "North"),
    ("AP", "Amapa", "North"),
    ("BA", "Bahia", "Northeast"),
    ("CE", "Ceara", "Northeast"),
    ("DF", "Distrito Federal", "Central-West"),
    ("ES", "Espirito Santo", "Southeast"),
    ("GO", "Goias", "Central-West"),
    ("MA", "Maranhao", "Northeast"),
    ("MG", "Minas Gerais", "Southeast"),
    ("MS", "Mato Grosso do Sul", "Central-West"),
    ("MT", "Mato Grosso", "Central-West"),
    ("PA", "Para", "North"),
    ("PB", "Paraiba", "Northeast"),
    ("PE", "Pernambuco", "Northeast"),
    ("PI", "Piaui", "Northeast"),
    ("PR", "Parana", "South"),
    ("RJ", "Rio de Janeiro", "Southeast"),
    ("RN", "Rio Grande do Norte", "Northeast"),
    ("RO", "Rondonia", "North"),
    ("RR", "Roraima", "North"),
    ("RS", "Rio Grande do Sul", "South"),
    ("SC", "Santa Catarina", "South"),
    ("SE", "Sergipe", "Northeast"),
    ("SP", "Sao Paulo", "Southeast"),
    ("TO", "Tocantins", "North"),
]
