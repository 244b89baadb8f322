"""Column contracts: the ordered list of columns a wide fact table must have."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

KINDS = ("string", "integer", "float")


@dataclass(frozen=True)
class ColumnSpec:
    """One column: its kind, its checks, its role and whether it has a code table."""

    name: str
    kind: str = "string"
    not_null: bool = False
    unique: bool = False
    role: str = "dimension"
    dictionary: bool = False

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"column {self.name}: unknown type {self.kind!r}, expected one of {KINDS}")


@dataclass(frozen=True)
class Contract:
    """Ordered column specs of one table.

    ``amount_type`` is the type of ``float`` columns: exact ``decimal(18,2)``
    by default, ``float`` to reproduce 32-bit storage of amounts.
    ``null_policy`` is ``"zero"`` (a missing value becomes 0 or the empty
    string) or ``"keep"`` (a missing value stays NULL).
    """

    columns: tuple[ColumnSpec, ...]
    amount_type: str = "decimal(18,2)"
    null_policy: str = "zero"

    def __post_init__(self):
        if self.null_policy not in ("zero", "keep"):
            raise ValueError(f"unknown null policy {self.null_policy!r}")
        names = self.names
        if len(set(names)) != len(names):
            raise ValueError("column names in a contract must differ")
        if len(self.unique_columns) > 1:
            raise ValueError("at most one unique column is supported")

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def not_null_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.not_null]

    @property
    def unique_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.unique]

    @property
    def dictionary_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.dictionary]

    def spark_type(self, spec: ColumnSpec) -> str:
        return {"string": "string", "integer": "int", "float": self.amount_type}[spec.kind]

    @property
    def schema(self) -> T.StructType:
        """Typed schema of accepted rows."""
        return T.StructType.fromDDL(", ".join(f"`{c.name}` {self.spark_type(c)}" for c in self.columns))

    @property
    def text_schema(self) -> T.StructType:
        """Schema of the same columns as raw text."""
        return T.StructType([T.StructField(n, T.StringType()) for n in self.names])


# The wide sales table, in column order.
SALES = Contract(
    (
        ColumnSpec("sales_id", not_null=True, unique=True, role="fact"),
        ColumnSpec("sales_date", not_null=True, role="fact"),
        ColumnSpec("total_amount", kind="float", not_null=True, role="fact"),
        ColumnSpec("customer_id", not_null=True),
        ColumnSpec("first_name"),
        ColumnSpec("last_name"),
        ColumnSpec("email"),
        ColumnSpec("residential_location", dictionary=True),
        ColumnSpec("customer_segment", dictionary=True),
        ColumnSpec("product_id", not_null=True, dictionary=True),
        ColumnSpec("product_name", dictionary=True),
        ColumnSpec("category", dictionary=True),
        ColumnSpec("brand", dictionary=True),
        ColumnSpec("origin_location", dictionary=True),
        ColumnSpec("store_id", not_null=True, dictionary=True),
        ColumnSpec("store_name", dictionary=True),
        ColumnSpec("store_type", dictionary=True),
        ColumnSpec("store_location", dictionary=True),
        ColumnSpec("salesperson_id", not_null=True, dictionary=True),
        ColumnSpec("salesperson_name", dictionary=True),
        ColumnSpec("salesperson_role", dictionary=True),
        ColumnSpec("campaign_id", not_null=True, dictionary=True),
        ColumnSpec("campaign_name", dictionary=True),
        ColumnSpec("campaign_budget", kind="integer"),
        ColumnSpec("store_manager_id", dictionary=True),
        ColumnSpec("store_manager_name", dictionary=True),
        ColumnSpec("store_manager_role", dictionary=True),
        ColumnSpec("campaign_start_date"),
        ColumnSpec("campaign_start_year", kind="integer"),
        ColumnSpec("campaign_start_month", kind="integer"),
        ColumnSpec("campaign_start_day", kind="integer"),
        ColumnSpec("campaign_start_weekday", kind="integer"),
        ColumnSpec("campaign_start_quarter", kind="integer"),
        ColumnSpec("campaign_end_date"),
        ColumnSpec("campaign_end_year", kind="integer"),
        ColumnSpec("campaign_end_month", kind="integer"),
        ColumnSpec("campaign_end_day", kind="integer"),
        ColumnSpec("campaign_end_weekday", kind="integer"),
        ColumnSpec("campaign_end_quarter", kind="integer"),
    )
)

# Dimensions and measure of the default cube.
CUBE_DIMENSIONS = (
    "category",
    "brand",
    "customer_segment",
    "store_type",
    "salesperson_role",
    "campaign_name",
)
CUBE_MEASURE = "total_amount"
