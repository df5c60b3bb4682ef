"""The customer table, its checks and the default settings."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Column names, their order and their expected types.
KEY = "CUST_ID"
LABEL = "CLUSTER"
NOISE = -1
EXPECTED_TYPES = {
    "CUST_ID": "object",
    "BALANCE": "float64",
    "BALANCE_FREQUENCY": "float64",
    "PURCHASES": "float64",
    "ONEOFF_PURCHASES": "float64",
    "INSTALLMENTS_PURCHASES": "float64",
    "CASH_ADVANCE": "float64",
    "PURCHASES_FREQUENCY": "float64",
    "ONEOFF_PURCHASES_FREQUENCY": "float64",
    "PURCHASES_INSTALLMENTS_FREQUENCY": "float64",
    "CASH_ADVANCE_FREQUENCY": "float64",
    "CASH_ADVANCE_TRX": "int64",
    "PURCHASES_TRX": "int64",
    "CREDIT_LIMIT": "float64",
    "PAYMENTS": "float64",
    "MINIMUM_PAYMENTS": "float64",
    "PRC_FULL_PAYMENT": "float64",
    "TENURE": "int64",
}
DROP_COLUMNS = [KEY]
FEATURES = [name for name in EXPECTED_TYPES if name not in DROP_COLUMNS]

_SPARK_TYPES = {"object": T.StringType(), "float64": T.DoubleType(), "int64": T.LongType()}


def customer_schema(expected: dict[str, str] = EXPECTED_TYPES) -> T.StructType:
    return T.StructType([T.StructField(name, _SPARK_TYPES[kind]) for name, kind in expected.items()])


def features_of(columns: list[str], features: list[str] = FEATURES) -> list[str]:
    """Features present in ``columns``, in canonical order."""
    present = [name for name in features if name in columns]
    if not present:
        raise ValueError("no feature column found in the input")
    return present


@dataclass(frozen=True)
class TrainConfig:
    k: int = 3
    seed: int = 42
    max_iter: int = 300
    tol: float = 1e-4
    eps: float = 0.5
    min_samples: int = 5
    max_k: int = 10
    null_threshold: float = 50.0
    # "exact" is quadratic in distinct rows, "squared" linear; they are different numbers.
    silhouette: str = "exact"
    # The model that is published: "KMeans" or "DBSCAN".
    serve: str = "KMeans"
    # Number columns that are clustered on as they are, filled but not scaled.
    extra: list[str] = field(default_factory=list)
    features: list[str] = field(default_factory=lambda: list(FEATURES))
    key: str = KEY
