"""Bench: run the table builders over the driver's tables and time them.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

The ERP tables are first derived from the driver's tables and written once
as Parquet under the session's shared folder (``stage_inputs_sec``, reported
apart): in production they are stored replica tables, so the builders are
timed reading Parquet, with filters and column pruning at the scan. Each
builder's full result is then computed (``write.format("noop")``: every row
is produced, nothing is collected), in a cold and a warm pass. Prints one
JSON line; ``value`` is the warm total.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewater.plans import asn, compliance  # noqa: E402
from tidewater.plans.pipelines import po_document_from_stage, vendor_document_from_stage  # noqa: E402
from tidewater.plans.queries import AS_OF  # noqa: E402
from tidewater.session import local_session  # noqa: E402
from tidewater.sources.catalog import Sources, materialize  # noqa: E402
from tidewater.sources.publish import publish_bucketed, scratch_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

BUILDERS = {
    "j01_asn_details": lambda t: asn.asn_details(t, AS_OF),
    "j02_asn_summary": lambda t: asn.asn_summary(t, AS_OF),
    "j03_carrier_shipment_info": lambda t: asn.carrier_shipment_info(t, AS_OF),
    "j04_contact_details": lambda t: asn.contact_details(t),
    "j05_edi_po_vendor_fields": lambda t: asn.edi_po_vendor_fields(t, AS_OF),
    "j06_vendor_contacts": lambda t: asn.vendor_contacts(t),
    "j07_purchase_orders_all": lambda t: compliance.purchase_orders_all(t, AS_OF),
    "j08_po_lines_nested": lambda t: compliance.po_lines_nested(t, AS_OF),
    "j09_carrier_shipments_nested": lambda t: compliance.carrier_shipments_nested(t),
    "j10_vendor_contacts_stage": lambda t: compliance.vendor_contacts_stage(t),
    "j11_contact_details_stage": lambda t: compliance.contact_details_stage(t),
    "j12_purchase_order_nested": lambda t: compliance.po_document(t, AS_OF),
    "j13_edi_856_asn": lambda t: compliance.edi_856_asn(t),
    "j14_edi_856_asn_line": lambda t: compliance.edi_856_asn_line(t),
    "j15_vendor_contacts_nested": lambda t: compliance.vendor_document(t),
}


def staged_documents(spark, t) -> dict[str, float]:
    """The route that a pipeline run takes: J07-J11 written as bucketed stage
    tables, then J12 and J15 from them without a shuffle (seconds of each step)."""
    base, run, out, tables = scratch_path(spark, "bench-stage"), uuid.uuid4().hex[:8], {}, {}
    steps = {
        "purchase_orders_all": (compliance.purchase_orders_all(t, AS_OF), "po_number"),
        "po_lines_nested": (compliance.po_lines_nested(t, AS_OF), "po_number"),
        "carrier_shipment_chr_nested": (compliance.carrier_shipments_nested(t), "carrier_shipping_data"),
        "vendor_contacts_stage": (compliance.vendor_contacts_stage(t), "internal_vendor_id"),
        "contact_details_stage": (compliance.contact_details_stage(t), "company_id"),
    }
    for name, (df, key) in steps.items():
        t0 = time.perf_counter()
        tables[name] = publish_bucketed(df, f"{base}/{name}", f"bench_{name}_{run}", key)
        out[f"stage_{name}"] = round(time.perf_counter() - t0, 3)
    for name, df in (("j12_from_stage", po_document_from_stage(spark, tables, AS_OF)), ("j15_from_stage", vendor_document_from_stage(spark, tables))):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        out[name] = round(time.perf_counter() - t0, 3)
    for table in tables.values():
        spark.sql(f"DROP TABLE {table}")
    return out


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) * 2, app="tidewater-bench")
    t0 = time.perf_counter()
    t = materialize(Sources.from_testdata(spark, SF_DIR, AS_OF), scratch_path(spark, "bench-inputs"))
    stage_inputs = round(time.perf_counter() - t0, 3)
    # Two passes over all builders: the first (cold: JIT, class loading) is
    # reported as ``cold_queries``; the second (warm JVM, as on a long-running
    # cluster) gives the headline numbers.
    passes = []
    for _ in range(2):
        times = {}
        for name, build in BUILDERS.items():
            t0 = time.perf_counter()
            build(t).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        passes.append(times)
    cold, times = passes
    staged = staged_documents(spark, t)
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({
        "metric": "total_builder_seconds_warm",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "staged_documents": staged,
        "cold_total_sec": round(sum(cold.values()), 3),
        "cold_queries": cold,
        "stage_inputs_sec": stage_inputs,
        "sf": float(m.group(1)) if m else None,
        "cpus": int(CPUS),
    }))


if __name__ == "__main__":
    main()
