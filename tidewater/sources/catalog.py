"""The source mapping ``t``: ERP table name -> DataFrame.

Builders never open files themselves; they read ``t["transactions"]`` and so
on. A ``Sources`` is made either from real tables (``from_tables`` /
``from_parquet``: one Parquet path or catalog table per ERP name, S1/S2) or,
for the driver's test data, from the stand-ins of ``standins.py``
(``from_testdata``).

Broadcast policy. Only code lists (``CODE_LISTS``: enumerations that people
maintain, bounded by their definition) carry a broadcast hint. Every other join
is left to Catalyst's size estimate and AQE; no plan depends on a counted size
and no Spark job runs while a plan is built.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tidewater.functions.expr import snapshot_start_value
from tidewater.sources.inputs import checked
from tidewater.sources.standins import BASES, STANDINS

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

#: The ERP tables that the builders read.
ERP_TABLES = (
    "transactions", "transaction_lines", "sb_receipts", "sb_inventory", "carrier_shipping_data",
    "carrier_shipments", "entity", "employees", "vendors", "companies", "vendor_subsidiary_map",
    "address_book", "contacts", "contact_types", "message", "items_cv", "uom", "brand", "product_group",
    "merchandise_division", "locations", "departments", "subsidiaries", "currencies", "payment_terms",
    "vendor_types", "dim_dates", "season", "year1", "po_types", "edi_document_type_status",
    "acknowledgment_item_statuses", "acknowledgment_types", "integrationstatuses",
    "ready_for_860_transmit", "purchase_order_change_status", "allocation_channel", "po_category",
    "finance_status", "operations_status", "edi_856_asn", "edi_856_asn_line",
)

#: Enumerations: one row per value of a list field that people maintain.
CODE_LISTS = frozenset({
    "season", "year1", "po_types", "edi_document_type_status", "acknowledgment_item_statuses",
    "acknowledgment_types", "integrationstatuses", "ready_for_860_transmit",
    "purchase_order_change_status", "allocation_channel", "po_category", "finance_status",
    "operations_status", "uom", "currencies", "payment_terms", "vendor_types",
})


class Sources(Mapping):
    """Lazy mapping of ERP source names to DataFrames."""

    def __init__(self, spark: SparkSession, factories: Mapping[str, object]):
        self.spark = spark
        self._factories = dict(factories)
        self._frames: dict[str, DataFrame] = {}

    # Mapping protocol
    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            make = self._factories[name]
            self._frames[name] = make() if callable(make) else make
        return self._frames[name]

    def __iter__(self):
        return iter(self._factories)

    def __len__(self) -> int:
        return len(self._factories)

    def is_small(self, name: str) -> bool:
        """True when ``name`` is a code list, bounded by its definition."""
        return name in CODE_LISTS

    # Constructors
    @classmethod
    def from_tables(cls, spark: SparkSession, frames: Mapping[str, DataFrame]) -> "Sources":
        return cls(spark, frames)

    @classmethod
    def from_parquet(cls, spark: SparkSession, paths: Mapping[str, str]) -> "Sources":
        """One Parquet path (or folder) per ERP table name."""
        return cls(spark, {n: (lambda n=n, p=p: checked(spark.read.parquet(p), n)) for n, p in paths.items()})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str, names: Iterable[str] = ERP_TABLES) -> "Sources":
        """Catalog tables ``database.name`` (S1) or ``catalog.database.name``."""
        return cls(spark, {n: (lambda n=n: checked(spark.table(f"{database}.{n}"), n)) for n in names})

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, as_of: datetime,
                      names: Iterable[str] | None = None) -> "Sources":
        """ERP stand-ins derived from the driver's tables under ``sf_dir``."""
        bases: dict[str, DataFrame] = {}

        def base(b: str) -> DataFrame:
            if b not in bases:
                bases[b] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{b}.parquet")
            return bases[b]

        def factory(name: str):
            def make() -> DataFrame:
                sql, used = standin_sql(name, as_of, placeholders=True)
                df = spark.sql(sql, **{b: base(b) for b in used})
                # The given tables hold local times; the ERP's are instants (UTC).
                return df.select(*[F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, TimestampNTZType) else F.col(f.name)
                                   for f in df.schema.fields])
            return make

        wanted = STANDINS.keys() if names is None else names
        return cls(spark, {n: factory(n) for n in wanted})


def materialize(t: "Sources", base: str, names: Iterable[str] | None = None) -> "Sources":
    """Write each table of ``t`` as Parquet under ``base`` and return the
    mapping that reads them back (what an ERP replica looks like: stored
    tables, so filters and column pruning reach the scan)."""
    paths = {}
    for name in (names or list(t)):
        path = f"{base.rstrip('/')}/{name}"
        t[name].write.mode("overwrite").parquet(path)
        paths[name] = path
    return Sources.from_parquet(t.spark, paths)


def standin_sql(name: str, as_of: datetime, placeholders: bool = False) -> tuple[str, tuple[str, ...]]:
    """SQL text of one stand-in, with the snapshot days filled in.

    With ``placeholders`` the base table names become ``{name}`` fields for
    ``spark.sql(text, **frames)``; without, they stay plain names (DuckDB).
    """
    yday = snapshot_start_value(as_of)
    today = yday + timedelta(hours=24)
    sql = STANDINS[name].replace("{yday}", f"{yday:%Y-%m-%d %H:%M:%S}").replace(
        "{today}", f"{today:%Y-%m-%d %H:%M:%S}")
    used = BASES[name]
    if placeholders:
        for b in used:
            sql = re.sub(rf"\bFROM {b}\b", f"FROM {{{b}}}", sql)
    return sql, used
