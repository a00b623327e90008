"""Registered queries: each builder run over the driver's tables, with nested
outputs flattened to scalar columns so they can be checked against SQL.

Every query reads the whole stand-in tables of ``sf_dir`` (no sampling, no
id subsets). ``AS_OF`` pins the run time inside the data's date range.
Values are normalised the same way on both sides (see ``normalise`` and
``oracle.sql``): timestamps and dates as text, doubles rounded to 4
places, integers as BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import expr as E
from tidewater.functions.expr import c
from tidewater.operators.slices import append_in_turn, stored_in_turn
from tidewater.plans import asn, compliance
from tidewater.sources.catalog import Sources

# Fixed run time of every registered query (UTC).
AS_OF = datetime(2001, 3, 15, 12, 0, 0)

NULL_MARK = "∅"  # stands for NULL inside joined text lists


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources.from_testdata(spark, sf_dir, AS_OF)


def kind_of(dtype: T.DataType) -> str:
    if isinstance(dtype, T.TimestampType) or isinstance(dtype, T.TimestampNTZType):
        return "t"
    if isinstance(dtype, T.DateType):
        return "D"
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "d"
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return "i"
    if isinstance(dtype, T.BooleanType):
        return "b"
    if isinstance(dtype, T.StringType):
        return "s"
    raise TypeError(f"not a flat type: {dtype}")


def normalise(df: DataFrame) -> DataFrame:
    return df.select(*normalised(df.schema.fields))


def normalised(fields: list[T.StructField]) -> list[Column]:
    """Timestamps/dates as text, doubles rounded to 4 places, integers as BIGINT."""
    out = []
    for f in fields:
        k, col = kind_of(f.dataType), F.col(f"`{f.name}`")
        if k == "t":
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif k == "D":
            col = F.date_format(col, "yyyy-MM-dd")
        elif k == "d":
            # floor(x * 1e4 + 0.5) / 1e4: plain IEEE steps, so both engines give
            # the same bits (their round() functions break ties differently).
            col = F.floor(col.cast("double") * 10000 + 0.5) / 10000
        elif k == "i":
            col = col.cast("bigint")
        out.append(col.alias(f.name))
    return out


def joined(arr: Column, field: Callable[[Column], Column]) -> Column:
    """Sorted '|'-joined text of one field over an array of structs (NULL -> mark)."""
    return F.array_join(F.array_sort(F.transform(arr, lambda x: F.coalesce(field(x).cast("string"),
                                                                           F.lit(NULL_MARK)))), "|")


# ----------------------------------------------------------------------- queries

def q_open_in_transit_lines(spark, sf_dir):
    return asn.asn_details(sources(spark, sf_dir), AS_OF)


def q_division_problem_summary(spark, sf_dir):
    return asn.asn_summary(sources(spark, sf_dir), AS_OF)


def q_carrier_rows_dedupe(spark, sf_dir):
    return asn.carrier_shipment_info(sources(spark, sf_dir), AS_OF)


def q_recent_rows(spark, sf_dir):
    """Carrier headers created within 30 days before the run time."""
    t = sources(spark, sf_dir)
    return t["carrier_shipping_data"].where(c("date_created") >= E.recent_since(AS_OF)).select(
        "carrier_shipping_data_id", "carrier_shipping_data_name", "date_created", "is_inactive")


def q_contact_categories(spark, sf_dir):
    df = asn.contact_details(sources(spark, sf_dir))
    return df.withColumn("n_category", F.size("category")).withColumn(
        "category", F.array_join("category", "|"))


def q_role_lookups(spark, sf_dir):
    """One code list under six roles (vendor EDI document flags)."""
    t = sources(spark, sf_dir)
    v = t["vendors"]
    from tidewater.operators import ops
    for out, fk in asn.EDI_ROLES:
        v = ops.lookup(v, t["edi_document_type_status"], c(fk), "list_id", {out: "list_item_name"},
                       small=t.is_small("edi_document_type_status"))
    return v.select("vendor_id", *[o for o, _ in asn.EDI_ROLES])


def q_currency_fanout_dedupe(spark, sf_dir, **how):
    return asn.edi_po_vendor_fields(sources(spark, sf_dir), AS_OF, **how)


def _vendor_flat(df: DataFrame, stage: bool) -> DataFrame:
    general = [x for x in df.columns if not x.endswith("_tab")]
    fin = [c("financials_tab.balance").alias("fin_balance"),
           c("financials_tab.unbilled_orders").alias("fin_unbilled_orders"),
           c("financials_tab.currency").alias("fin_currency")]
    if stage:
        fin += [c("financials_tab.accounting_clerk_name").alias("fin_clerk_name")]
    return df.select(
        *general,
        F.size("address_tab").alias("n_address"),
        joined(c("address_tab"), lambda x: F.concat_ws(":", x["label"], x["address"], x["is_inactive"]))
        .alias("address_labels"),
        *[c(f"purchasing_tab.{x}").alias(f"pur_{x}") for x in [
            "edi", "edi_855_activation_date", "edi_850", "edi_860", "edi_855", "edi_856", "edi_810", "edi_846",
            "edi_capable", "creditlimit", "vendor_credit_limit_date", "currency"]],
        *fin,
        F.size("relationships_tab").alias("n_relationships"),
        joined(c("relationships_tab"), lambda x: x["contact_id"]).alias("relationship_ids"),
        joined(c("relationships_tab"), lambda x: x["category"]).alias("relationship_categories"),
        F.size("communications_tab").alias("n_communications"),
        joined(c("communications_tab"), lambda x: x["primary_recipient"]).alias("recipients"),
        F.size("approvals_tab").alias("n_approvals"),
        joined(c("approvals_tab"), lambda x: F.concat_ws(":", x["created_by"], x["finance_status"],
                                                         x["operations_status"])).alias("approvals"),
        F.size("subsidiaries_tab").alias("n_subsidiaries"),
        joined(c("subsidiaries_tab"), lambda x: F.concat_ws(
            ":", x["subsidiary"], x["primary"].cast("string"), x["subsidiary_id"].cast("string"))).alias("subsidiaries"),
    )


def q_vendor_tabs(spark, sf_dir):
    return _vendor_flat(asn.vendor_contacts(sources(spark, sf_dir)), stage=False)


def q_po_header_rollup(spark, sf_dir):
    return compliance.purchase_orders_all(sources(spark, sf_dir), AS_OF)


def q_po_line_measures(spark, sf_dir):
    """J08 lines: the nested array exploded back to one row per line group."""
    slices = compliance.po_lines_in_slices(sources(spark, sf_dir), AS_OF)
    return stored_in_turn(spark, "line-measures", (df.select("po_number", F.explode("po_lines").alias("l")).select("po_number", "l.*") for df in slices))


def q_po_lines_nested_flat(spark, sf_dir):
    slices = compliance.po_lines_in_slices(sources(spark, sf_dir), AS_OF)
    return stored_in_turn(spark, "lines-flat", (df.select(
        "po_number", F.size("po_lines").alias("n_lines"), "total_on_order_quantity",
        "total_on_order_cost", "expected_arrival_date", "total_amount_lines") for df in slices))


def q_carrier_nested_flat(spark, sf_dir):
    df = compliance.carrier_shipments_nested(sources(spark, sf_dir))
    e = df.select("carrier_shipping_data", "po_number", "vendor", "custom_po_number",
                  F.size("shipment_details").alias("n_shipments"), F.explode("shipment_details").alias("s"))
    return e.select("carrier_shipping_data", "po_number", "vendor", "custom_po_number", "n_shipments",
                    "s.shipment_id", "s.pallet_count", "s.declared_value", "s.shipping_cost", "s.inactive",
                    "s.tracking.*", "s.invoice.*", "s.shipment_dates.*")


def q_vendor_tabs_live(spark, sf_dir):
    return _vendor_flat(compliance.vendor_contacts_stage(sources(spark, sf_dir)), stage=True)


def q_contact_categories_active(spark, sf_dir):
    df = compliance.contact_details_stage(sources(spark, sf_dir))
    return df.withColumn("n_category", F.size("category")).withColumn("category", F.array_join("category", "|"))


def q_po_document_flat(spark, sf_dir):
    return _po_documents(spark, sf_dir, "document-flat", _po_document_flat)


def _po_documents(spark, sf_dir, name: str, shown: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """J12 in slices of the PO numbers, of which ``shown`` is stored."""
    return stored_in_turn(spark, name, map(shown, compliance.po_documents_in_slices(sources(spark, sf_dir), AS_OF)))


def _po_document_flat(df: DataFrame) -> DataFrame:
    p = "purchase_oder"
    return df.select(
        "expected_arrival_date", "po_number",
        *[c(f"{p}.{x}").alias(x) for x in ["po_title", "po_type", "buyer_name", "po_status", "cost_center",
                                           "location", "location_code", "sent_to_chr", "po_first_transmission"]],
        *[c(f"{p}.po_dates.{x}").alias(x) for x in ["po_edit_date", "po_edit_fiscal_week_number", "days_past_due",
                                                   "po_original_ship_date", "po_original_cancel_date"]],
        c(f"{p}.po_vendor.po_vendor").alias("po_vendor"), c(f"{p}.po_season.season_code").alias("season_code"),
        c(f"{p}.acknowledgment.acknowledgment_type").alias("acknowledgment_type"),
        *[c(f"{p}.po_amounts.{x}").alias(x) for x in ["line_count", "total_quantity", "remaining_open_quantity",
                                                     "received_amount"]],
        F.size(f"{p}.po_lines").alias("n_lines"),
        "totals.*",
        c("carrier_shipment_chr.carrier_shipping_data").alias("carrier_shipping_data"),
        F.size("carrier_shipment_chr.shipment_details").alias("n_shipments"),
        "updated_date",
    )


def q_edi_header_extract(spark, sf_dir):
    return compliance.edi_856_asn(sources(spark, sf_dir))


def q_edi_line_extract(spark, sf_dir):
    return compliance.edi_856_asn_line(sources(spark, sf_dir))


def q_vendor_document_flat(spark, sf_dir):
    return _vendor_document_flat(compliance.vendor_document(sources(spark, sf_dir)))


def _vendor_document_flat(df: DataFrame) -> DataFrame:
    return df.select(
        "name", "internal_vendor_id", "status", "custom_vendor_externalid",
        c("email_phone_address.email").alias("email"), c("email_phone_address.address").alias("address"),
        F.size("address_tab").alias("n_address"), F.size("subsidiaries_tab").alias("n_subsidiaries"),
        F.size("contacts").alias("n_contacts"),
        joined(c("contacts"), lambda x: x["contact_id"]).alias("contact_ids"),
        joined(c("contacts"), lambda x: F.concat_ws(":", x["contact_name"], x["address_tab"],
                                                    F.array_join(x["category"], ","))).alias("contact_text"),
    )


def _tab_rows(df: DataFrame, tab: str, outer: bool) -> DataFrame:
    """One row per element of a vendor tab, all its fields; documents that repeat
    a vendor (one per map row) hold the same tab, which counts once."""
    tabs = df.groupBy("name", "internal_vendor_id").agg(F.first(tab).alias("tab"))
    rows = tabs.select("name", "internal_vendor_id", (F.explode_outer if outer else F.explode)("tab").alias("e"))
    return rows.select("name", "internal_vendor_id", "e.*")


TABS = {"vendor_addresses": "address_tab", "vendor_relationships": "relationships_tab", "vendor_communications": "communications_tab",
        "vendor_approvals": "approvals_tab", "vendor_subsidiaries": "subsidiaries_tab"}


def _tab_query(tab: str, stage: bool):
    def query(spark, sf_dir):
        t = sources(spark, sf_dir)
        return _tab_rows(compliance.vendor_contacts_stage(t), tab, False) if stage else _tab_rows(asn.vendor_contacts(t), tab, True)
    return query


def q_po_document_fields(spark, sf_dir):
    """Every flat field of the document."""
    return _po_documents(spark, sf_dir, "document-fields", _po_document_fields)


def _po_document_fields(df: DataFrame) -> DataFrame:
    flat = [x.name for x in df.schema["purchase_oder"].dataType if not isinstance(x.dataType, (T.StructType, T.ArrayType))]
    return df.select("expected_arrival_date", "po_number", *[c(f"purchase_oder.{x}").alias(x) for x in flat],
                     "purchase_oder.po_dates.*", "purchase_oder.po_vendor.*", "purchase_oder.po_season.*", "purchase_oder.acknowledgment.*",
                     "purchase_oder.po_amounts.*", "totals.*", "carrier_shipment_chr.carrier_shipping_data", "created_date")


def q_po_document_lines(spark, sf_dir):
    return _po_documents(spark, sf_dir, "document-lines", lambda df: df.select(
        "po_number", F.explode("purchase_oder.po_lines").alias("l")).select("po_number", "l.*"))


def q_po_document_shipments(spark, sf_dir):
    df = compliance.po_document(sources(spark, sf_dir), AS_OF)
    rows = df.select("po_number", F.explode("carrier_shipment_chr.shipment_details").alias("s"))
    return rows.select("po_number", "s.shipment_id", "s.pallet_count", "s.declared_value", "s.shipping_cost", "s.inactive",
                       "s.tracking.*", "s.invoice.*", "s.shipment_dates.*")


def q_vendor_document_contacts(spark, sf_dir):
    df = compliance.vendor_document(sources(spark, sf_dir))
    rows = df.select("internal_vendor_id", F.explode("contacts").alias("k")).select("internal_vendor_id", "k.*")
    return rows.withColumn("category", F.array_join("category", "|"))


def q_vendor_document_addresses(spark, sf_dir):
    df = compliance.vendor_document(sources(spark, sf_dir))
    purchasing = [x.name for x in df.schema["purchasing_tab"].dataType]
    return df.select("name", "companyname", "vendor_id", "internal_vendor_id", "type", "vendor_category", "terms", "incoterm", "comments", "email_phone_address.*",
                     *[c(f"purchasing_tab.{x}").alias(f"pur_{x}") for x in purchasing],
                     c("financials_tab.balance").alias("fin_balance"), c("financials_tab.unbilled_orders").alias("fin_unbilled_orders"),
                     c("financials_tab.currency").alias("fin_currency"), c("financials_tab.accounting_clerk_name").alias("fin_clerk_name"))


def q_text_price_clean(spark, sf_dir):
    """Line price text as a number and as a cleaned rate text."""
    t = sources(spark, sf_dir)
    return t["transaction_lines"].select(
        "transaction_id", "transaction_line_id", "item_unit_price",
        E.text_price(c("item_unit_price")).alias("price"), E.rate_text(c("item_unit_price")).alias("rate"))


def q_zone_yesterday(spark, sf_dir):
    """Inventory SKUs of the snapshot taken at the start of yesterday (Denver)."""
    t = sources(spark, sf_dir)
    return (t["sb_inventory"].where(c("snapshot_day") == E.snapshot_start(AS_OF))
            .groupBy("sku").agg(F.count(F.lit(1)).alias("n_rows")))


def q_publish_round_trip(spark, sf_dir):
    """K1-K3: the PO document written partitioned by arrival date and clustered
    by PO number under the shared folder, then read back."""
    from tidewater.sources.publish import publish, scratch_path
    unlaid = scratch_path(spark, "unlaid")
    df = append_in_turn(spark, unlaid, compliance.po_documents_in_slices(sources(spark, sf_dir), AS_OF))
    path = publish(df, scratch_path(spark, "po_document"), partition_by="expected_arrival_date",
                   cluster_by="po_number", stored=unlaid)
    back = spark.read.parquet(path)
    return back.select("po_number", "expected_arrival_date", F.size("purchase_oder.po_lines").alias("n_lines"))


def _placed(name: str, df: DataFrame, *columns: str) -> DataFrame:
    from tidewater.operators.spread import with_place
    from tidewater.plans.pipelines import ORDER
    return with_place(df, ORDER[name]).select(*columns, "place")


def q_open_lines_in_order(spark, sf_dir):
    """J01 rows with their place in the order of PO numbers."""
    return _placed("asn_details", asn.asn_details(sources(spark, sf_dir), AS_OF), "po_number", "line_id")


def q_problem_summary_in_order(spark, sf_dir):
    """J02 rows with their place in the order of divisions."""
    return _placed("asn_summary", asn.asn_summary(sources(spark, sf_dir), AS_OF), "merchandise_division", "assigned_to")


def q_carrier_rows_in_order(spark, sf_dir):
    """R2: J03 rows with their place in the order of the second column, the vendor."""
    return _placed("carrier_shipment_info_chr", asn.carrier_shipment_info(sources(spark, sf_dir), AS_OF), "po_number", "vendor", "shipment_id")


def q_vendor_fields_in_order(spark, sf_dir):
    """J05 rows with their place by cancel date upward, then EDI 855 label downward."""
    return _placed("edi_chr_po_vendor_fields", asn.edi_po_vendor_fields(sources(spark, sf_dir), AS_OF), "tranid", "original_cancel_date", "edi_855")


def q_replaced_table(spark, sf_dir):
    """K1: J01 published for a run a month before, then replaced; what readers see
    now. One version is left."""
    from tidewater.sources import tables
    from tidewater.sources.publish import publish, scratch_path
    t, path = sources(spark, sf_dir), scratch_path(spark, "replaced")
    for as_of in (AS_OF - timedelta(days=30), AS_OF):
        publish(asn.asn_details(t, as_of), path, cluster_by="po_number")
    n = len(tables.versions(spark, path))
    return tables.read_table(spark, path).select("po_number", "line_id", "qty_in_transit", "transit_window_end", F.lit(n).alias("n_versions"))


def _staged(spark, sf_dir, name: str) -> DataFrame:
    """Pipeline B run from stored stages; the current version of a final table."""
    from tidewater.plans.pipelines import run_pipeline_b
    from tidewater.sources import tables
    from tidewater.sources.publish import scratch_path, stage_path
    base = scratch_path(spark, "staged")
    run_pipeline_b(spark, sources(spark, sf_dir), AS_OF, base, keep_stage=False)
    return tables.read_table(spark, stage_path(base, "final", name))


def q_staged_po_documents(spark, sf_dir):
    """J12 by way of the staged J07, J08 and J09, flattened."""
    return _po_document_flat(_staged(spark, sf_dir, "purchase_order_nested"))


def q_staged_vendor_documents(spark, sf_dir):
    """J15 by way of the staged J10 and J11, flattened."""
    return _vendor_document_flat(_staged(spark, sf_dir, "vendor_contacts_nested"))


def q_catalog_lines(spark, sf_dir):
    """J14 over tables read from the catalog, two- and three-part names."""
    import uuid

    from tidewater.sources.publish import scratch_path
    t, base, db = sources(spark, sf_dir), scratch_path(spark, "catalog"), f"tidewater_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{base}'")
    names = ("edi_856_asn_line", "po_types", "merchandise_division")
    for name in names:
        t[name].write.option("path", f"{base}/{name}").saveAsTable(f"{db}.{name}")
    two, three = (Sources.from_catalog(spark, prefix, names) for prefix in (db, f"spark_catalog.{db}"))
    both = [compliance.edi_856_asn_line(x).withColumn("name_parts", F.lit(parts)) for parts, x in ((2, two), (3, three))]
    return both[0].unionByName(both[1])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "open_in_transit_lines": q_open_in_transit_lines,
    "division_problem_summary": q_division_problem_summary,
    "carrier_rows_dedupe": q_carrier_rows_dedupe,
    "recent_rows": q_recent_rows,
    "contact_categories": q_contact_categories,
    "role_lookups": q_role_lookups,
    "currency_fanout_dedupe": q_currency_fanout_dedupe,
    "vendor_tabs": q_vendor_tabs,
    "po_header_rollup": q_po_header_rollup,
    "po_line_measures": q_po_line_measures,
    "po_lines_nested_flat": q_po_lines_nested_flat,
    "carrier_nested_flat": q_carrier_nested_flat,
    "vendor_tabs_live": q_vendor_tabs_live,
    "contact_categories_active": q_contact_categories_active,
    "po_document_flat": q_po_document_flat,
    "edi_header_extract": q_edi_header_extract,
    "edi_line_extract": q_edi_line_extract,
    "vendor_document_flat": q_vendor_document_flat,
    "text_price_clean": q_text_price_clean,
    "zone_yesterday": q_zone_yesterday,
    "publish_round_trip": q_publish_round_trip,
    "open_lines_in_order": q_open_lines_in_order,
    "problem_summary_in_order": q_problem_summary_in_order,
    "vendor_fields_in_order": q_vendor_fields_in_order,
    "carrier_rows_in_order": q_carrier_rows_in_order,
    "replaced_table": q_replaced_table,
    "staged_po_documents": q_staged_po_documents,
    "staged_vendor_documents": q_staged_vendor_documents,
    "catalog_lines": q_catalog_lines,
    **{name: _tab_query(tab, False) for name, tab in TABS.items()},
    **{f"{name}_live": _tab_query(tab, True) for name, tab in TABS.items()},
    "po_document_fields": q_po_document_fields,
    "po_document_lines": q_po_document_lines,
    "po_document_shipments": q_po_document_shipments,
    "vendor_document_contacts": q_vendor_document_contacts,
    "vendor_document_addresses": q_vendor_document_addresses,
}


#: Queries with many more rows than what they are joined from: normalised before that join.
NORMALISED_EARLY = {"currency_fanout_dedupe"}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered query, normalised for comparison."""
    from tidewater.session import configure
    configure(spark)
    if name in NORMALISED_EARLY:
        return QUERIES[name](spark, sf_dir, shown=normalised)
    return normalise(QUERIES[name](spark, sf_dir))
