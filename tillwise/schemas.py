"""Declared tables of the star schema and the column lists of the raw feeds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TEXT, _DATE, _FLAG, _WHOLE = T.VarcharType, T.DateType(), T.BooleanType(), T.IntegerType()
_MONEY = T.DecimalType(10, 2)

# The declared column names, types and keys of the four tables.
_DECLARED = {
    "customers": ("customer_id", {
        "customer_id": _TEXT(10),
        "full_name": _TEXT(100),
        "email": _TEXT(100),
        "phone": _TEXT(30),
        "region": _TEXT(50),
        "postcode": _TEXT(10),
        "signup_date": _DATE,
        "loyalty_member": _FLAG,
        "age_group": _TEXT(10),
    }),
    "products": ("product_id", {
        "product_id": _TEXT(8),
        "product_name": _TEXT(100),
        "category": _TEXT(50),
        "description": _TEXT(200),
        "sell_price": _MONEY,
        "cost_price": _MONEY,
        "supplier": _TEXT(100),
        "in_stock": _FLAG,
        "launch_date": _DATE,
    }),
    "stores": ("store_id", {
        "store_id": _TEXT(6),
        "store_name": _TEXT(100),
        "region": _TEXT(50),
        "postcode": _TEXT(10),
        "store_size_sqft": _WHOLE,
        "num_staff": _WHOLE,
        "manager_name": _TEXT(100),
        "opening_date": _DATE,
        "is_flagship": _FLAG,
    }),
    "transactions": ("transaction_id", {
        "transaction_id": _TEXT(10),
        "transaction_date": _DATE,
        "customer_id": _TEXT(10),
        "product_id": _TEXT(8),
        "store_id": _TEXT(6),
        "quantity": _WHOLE,
        "unit_price": _MONEY,
        "discount_pct": T.DecimalType(5, 2),
        "total_value": _MONEY,
        "payment_method": _TEXT(20),
        "channel": _TEXT(10),
    }),
}

# Column order of the derived customer table.
CUSTOMER_RFM_COLUMNS = [
    "customer_id", "recency", "frequency", "monetary", "r_score", "f_score", "m_score",
    "rfm_score", "segment", "full_name", "region", "age_group", "loyalty_member",
]


@dataclass(frozen=True)
class Table:
    """One declared table: its key, its typed columns and the limits its columns were declared with."""

    name: str
    key: str
    declared: T.StructType

    @property
    def columns(self) -> list[str]:
        return self.declared.names

    @property
    def lengths(self) -> dict[str, int]:
        return {f.name: f.dataType.length for f in self.declared if isinstance(f.dataType, T.VarcharType)}

    @property
    def decimals(self) -> dict[str, T.DecimalType]:
        return {f.name: f.dataType for f in self.declared if isinstance(f.dataType, T.DecimalType)}

    @property
    def stored(self) -> T.StructType:
        """The schema as Spark holds it: VARCHAR(n) is a string whose length is checked on load."""
        return T.StructType([
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.VarcharType) else f.dataType)
            for f in self.declared
        ])

    @property
    def raw(self) -> T.StructType:
        """The feed as it arrives: every column text, because inferred types hide the defects."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    def ddl(self, location: str, partitioned_by: str | None = None, database: str = "") -> str:
        quoted = location.replace("\\", "\\\\").replace("'", "\\'")
        columns = [f"{f.name} {f.dataType.simpleString().upper()}" for f in self.declared]
        partition = ""
        if partitioned_by:
            columns.append(f"{partitioned_by} STRING")
            partition = f" PARTITIONED BY ({partitioned_by})"
        return (
            f"CREATE TABLE IF NOT EXISTS {database}{self.name} ({', '.join(columns)}) "
            f"USING parquet{partition} LOCATION '{quoted}'"
        )


STAR = {
    name: Table(name, key, T.StructType([T.StructField(c, t) for c, t in columns.items()]))
    for name, (key, columns) in _DECLARED.items()
}

# Foreign keys of the fact table: column -> dimension that owns it.
FOREIGN_KEYS = {"customer_id": "customers", "product_id": "products", "store_id": "stores"}
