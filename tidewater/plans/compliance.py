"""Pipeline B: staged PO, line, carrier, vendor and contact tables, the two
nested documents and the EDI 856 extracts (J07-J15).

Pipeline B filters soft-deleted rows (``_fivetran_deleted = False``) of the
driving table and, through WHERE clauses, of many joined tables; those joins
are written as inner joins to the live rows (F9), which is what they mean.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import expr as E
from tidewater.functions.expr import c, live
from tidewater.operators import ops
from tidewater.operators.slices import SLICES, Sliced, slice_of
from tidewater.plans import asn

PURCHASE_ORDER = "Purchase Order"


def _live_pos(t) -> DataFrame:
    return (t["transactions"].where(c("tranid").isNotNull())
            .where(c("transaction_type") == PURCHASE_ORDER).where(live()))


# ----------------------------------------------------------------------- J07

PO_KEYS = [  # PO columns among the GROUP BY keys; the two po_ names are output labels (A13)
    "tranid", "po_batch_name", "transaction_extid", "external_id", "memo", "status", "cancel_date",
    "trandate", "ship_date", "original_cancel_date", "days_to_edit", "due_date", "down_payment",
    "po_fixed_payment_date", "po_is_finalized", "entity_id", "n_860_last_execution_timestamp",
    "n_850_last_execution_timestamp", "discount_amount", "reserved_amount", "shipping_amount",
    "amount_change", "amount_unbilled", "total__amount", "total_amount_billed", "total_principal",
    "total_qv_", "total_approved", "refunded_amount", "first_transmission", "transmitted_po",
    "competing_bids", "reason_for_purchase", "acknowledgment_date", "acknowledgment_terms",
    "acknowledgment_scheduled_date", "acknowledgment_memo", "transaction_purpose", "sent_to_chr",
]
#: What tells J07's rows apart before they are grouped: they are at (PO, department) grain.
GROUP_ID = ("transaction_id", "department_id")
LABEL_KEYS = [
    "buyer", "po_vendor", "po_type", "season_code", "season_year", "po_terms", "po_allocation_channel",
    "merchandise_division", "location", "location_code", "integration_status", "po_category",
    "purchase_order_change_status", "ready_for_860_transmit", "acknowledgment_type", "cost_center",
    "po_edit_fiscal_week_number", "__edit_ts",
]


def purchase_orders_all(t, as_of: datetime) -> DataFrame:
    """One row per PO and distinct dimension values (68 columns).

    The lines are pre-aggregated per (PO, department) before any join: the
    reference sums line measures per group, every group key other than the
    department name is a PO-level value, and COUNT/SUM are distributive, so
    summing the partial sums gives the same numbers (dimension fan-outs
    multiply a partial row exactly as they would multiply each line). This
    keeps the largest table out of the 18 joins and makes a PO with very
    many lines one small row per department before the shuffle.

    The calendar is joined twice: the fiscal week of the edit day (X6, an
    equi join on two expressions; the calendar is a code list), and the row
    of yesterday (X7, a left join whose condition reads only the calendar:
    it multiplies every PO row by the number of calendar rows for that day,
    done here with a scalar count and ``explode``, no cross join).
    """
    po = _live_pos(t)
    lines = (t["transaction_lines"].where(live()).where(c("transaction_line_id") >= 1))
    received = F.coalesce(c("quantity_received_in_shipment").cast("double"), F.lit(0.0)) * F.coalesce(
        E.text_price(c("item_unit_price")), F.lit(0.0))
    part = ops.preaggregate(lines, ["transaction_id", "department_id"], {
        "__n": F.count(c("transaction_line_id")),
        "__qty": F.sum(c("item_count")),
        "__open": F.sum(c("item_count") - c("quantity_received_in_shipment")),
        "__recv": F.sum(received),
    }).withColumnRenamed("transaction_id", "__ltid")
    df = po.join(part, po["transaction_id"] == part["__ltid"], "inner").drop("__ltid")

    emp = t["employees"]
    df = ops.lookup(df, emp, c("sales_rep_id"), "employee_id", {"buyer": "full_name"}, how="inner", live_only=True)
    ent = t["entity"]
    df = ops.lookup(df, ent, E.as_key(df, "entity_id"), E.as_key(ent, "entity_id"), {"po_vendor": "name"},
                    how="inner", live_only=True)
    for dim, fk, out in [("po_types", "po_type_id", "po_type"), ("season", "season_code_id", "season_code"),
                         ("year1", "season_year_id", "season_year")]:
        df = ops.lookup(df, t[dim], E.as_key(df, fk), E.as_key(t[dim], "list_id"), {out: "list_item_name"},
                        small=t.is_small(dim))
    pt = t["payment_terms"]
    df = ops.lookup(df, pt, E.as_key(df, "payment_terms_id"), E.as_key(pt, "payment_terms_id"),
                    {"po_terms": "name"}, small=t.is_small("payment_terms"))
    # Fiscal week of the edit day; matches only a calendar row at midnight.
    # cast(coalesce(days_to_edit, 0) as int64) rounds half away from zero (2.5 -> 3).
    days = F.round(F.coalesce(c("days_to_edit").cast("double"), F.lit(0.0))).cast("bigint")
    df = df.withColumn("__edit_ts", E.minus_days(c("ship_date"), days))
    cal = t["dim_dates"]
    df = ops.lookup(df, cal, c("__edit_ts"), E.utc_midnight(c("calendar_date")),
                    {"po_edit_fiscal_week_number": "REALIGNED_FISCAL_WEEK_NO"}, small=t.is_small("dim_dates"))
    # Calendar row(s) of yesterday; only their number matters.
    n_yday = cal.where(E.utc_day(c("calendar_date")) == F.date_sub(E.as_of_date(as_of), 1)).agg(F.count(F.lit(1)))
    df = ops.repeat_rows(df, n_yday.scalar())
    for dim, fk, out in [("allocation_channel", "allocation_channel_id", "po_allocation_channel"),
                         ("integrationstatuses", "integration_status_id", "integration_status"),
                         ("po_category", "po_category_id", "po_category"),
                         ("ready_for_860_transmit", "ready_for_860_transmit_id", "ready_for_860_transmit"),
                         ("purchase_order_change_status", "purchase_order_change_statu_id",
                          "purchase_order_change_status"),
                         ("acknowledgment_types", "acknowledgment_type_id", "acknowledgment_type")]:
        df = ops.lookup(df, t[dim], c(fk), "list_id", {out: "list_item_name"}, small=t.is_small(dim))
    md = t["merchandise_division"]
    df = ops.lookup(df, md, E.as_key(df, "merchandise_division_id"), E.as_key(md, "merchandise_division_id"),
                    {"merchandise_division": "merchandise_division_name"}, small=t.is_small("merchandise_division"),
                    spread_by=GROUP_ID)
    df = ops.lookup(df, t["locations"], c("location_id"), "location_id",
                    {"location": "full_name", "location_code_l": "location_code"}, small=t.is_small("locations"),
                    spread_by=GROUP_ID)
    df = df.drop("location_code").withColumnRenamed("location_code_l", "location_code")
    df = ops.lookup(df, t["departments"], c("department_id"), "department_id", {"cost_center": "full_name"},
                    small=t.is_small("departments"), spread_by=GROUP_ID)

    # The group keys are the formatted payment day and the decoded flag.
    # Whether the status keeps its dates is a fact of the order's status, found once a row.
    df = df.withColumns({"__dated": E.is_dated(c("status")), "po_fixed_payment_date": E.fmt_day(c("fixed_payment_date")),
                         "po_is_finalized": E.true_false_blank(c("is_finalized"))})
    # One shuffle on the PO number serves both the wide GROUP BY and the
    # DISTINCT (the number is among the keys of each); the rows here are
    # already at (PO, department) grain, so no map-side combine is lost.
    g = df.repartition("tranid").groupBy(*PO_KEYS, *LABEL_KEYS, "__dated").agg(
        F.sum("__n").alias("line_count"), F.sum("__qty").alias("total_quantity"),
        F.sum("__open").alias("remaining_open_quantity"), F.sum("__recv").alias("received_amount"))
    return g.select(
        c("tranid").alias("po_number"), c("po_batch_name").alias("po_title"), c("po_type"),
        c("transaction_extid"), c("external_id"), c("buyer"), c("status").alias("po_status"), c("po_vendor"),
        c("po_terms"), E.fmt_day(c("cancel_date")).alias("po_cancel_date"),
        E.fmt_day(c("trandate")).alias("po_created_date"), E.fmt_day(c("ship_date")).alias("po_ship_date"),
        E.fmt_day(E.dated_day(c("__dated"), c("ship_date"))).alias("po_original_ship_date"),
        E.fmt_day(E.dated_day(c("__dated"), c("original_cancel_date"))).alias("po_original_cancel_date"),
        c("due_date").alias("po_due_date"), F.lit("-1").alias("po_email_sent"),
        E.true_false_blank(c("first_transmission")).alias("po_first_transmission"),
        c("po_fixed_payment_date"), c("po_is_finalized"), F.lit("NS").alias("record_source_system"),
        E.fmt_day(c("__edit_ts")).alias("po_edit_date"), c("po_edit_fiscal_week_number"), c("days_to_edit"),
        c("po_allocation_channel"), c("entity_id").alias("vendor_id"), E.fmt_day(c("trandate")).alias("po_date"),
        c("merchandise_division"), c("season_code"), c("season_year"),
        E.fmt_ts(c("n_860_last_execution_timestamp")).alias("n_860_last_execution_timestamp"),
        E.fmt_ts(c("n_850_last_execution_timestamp")).alias("n_850_last_execution_timestamp"),
        c("discount_amount"), c("down_payment"), c("reserved_amount"), c("shipping_amount"), c("amount_change"),
        c("amount_unbilled"), c("total__amount"), c("total_amount_billed"), c("total_principal"), c("total_qv_"),
        c("total_approved"), c("refunded_amount"), c("po_category"), c("location"), c("memo"), c("po_batch_name"),
        c("line_count"), c("total_quantity"), c("remaining_open_quantity"),
        E.days_past_due(as_of, c("due_date")).alias("days_past_due"), c("due_date"), c("received_amount"),
        E.true_false_blank(c("transmitted_po")).alias("transmitted_po"), c("cost_center"), c("location_code"),
        c("integration_status"), c("competing_bids"), c("reason_for_purchase"), c("purchase_order_change_status"),
        c("ready_for_860_transmit"), E.fmt_day(c("acknowledgment_date")).alias("acknowledgment_date"),
        c("acknowledgment_terms"),
        E.fmt_day(c("acknowledgment_scheduled_date")).alias("acknowledgment_scheduled_date"),
        c("acknowledgment_memo"), c("acknowledgment_type"), c("transaction_purpose"),
        E.t_yes_no(c("sent_to_chr")).alias("sent_to_chr"),
    ).distinct()


# ----------------------------------------------------------------------- J08

LINE_FIELDS = [
    "item_extid", "vendor_sku", "item_description", "po_item_description", "expected_arrival_eta_line",
    "closed", "item_count", "original_transmitted_qty", "quantity_received_in_shipment", "number_billed",
    "unit_of_measure", "conversion_rate", "item_unit_price", "rate", "purchase_price", "discount_amount",
    "amount", "product_group_name", "upc_code", "brand_name", "options", "line_created_date",
    "quantity_available", "acknowledgment_item_status", "transaction_line_id", "inventory_owned_flag",
    "transaction_expected_arrival_date", "acknowledgment_rate", "acknowledgment_scheduled_date",
    "acknowledgment_scheduled_quantity", "acknowledgment_memo", "n_2nd_acknowledgment_item_status",
    "n_2nd_acknowledgment_scheduled_date", "n_2nd_acknowledgment_schedul_quantity", "asn_record",
    "asn_quantity_shipped", "asn_shipment_date", "asn_estimated_delivery_date", "demand_amount", "demand_cogs",
    "demand_quantity", "estimated_cost", "full_price", "shipping_amount", "amount_custom", "amount_foreign",
    "amount_pending", "original_cogs", "po__rate", "quantity_allocated", "quantity_custom",
    "quantity_difference", "quantity_on_order", "rate_custom", "quantity_in_transaction_unit",
    "in_transit_window", "transit_window_end", "qty_in_transit", "on_order_quantity", "on_order_cost",
]

RAW_LINE_KEYS = [  # raw line columns among the 53 GROUP BY keys
    "vendor_sku", "memo", "expected_arrival_eta_line", "period_closed", "item_count", "original_transmitted_qty",
    "quantity_received_in_shipment", "number_billed", "item_unit_price", "purchase_price", "discount_amount",
    "amount", "line_created_date", "quantity_available", "transaction_line_id", "acknowledgment_rate",
    "acknowledgment_scheduled_date", "acknowledgment_scheduled_quan", "acknowledgment_memo",
    "n_2nd_acknowledgment_scheduled", "n_2nd_acknowledgment_schedul_0", "asn_record", "asn_quantity_shipped",
    "asn_shipment_date", "asn_estimated_delivery_date", "demand_amount", "demand_cogs", "demand_quantity",
    "estimated_cost", "full_price", "shipping_amount", "amount_custom", "amount_foreign", "amount_pending",
    "original_cogs", "po__rate", "quantity_allocated", "quantity_custom", "quantity_difference",
    "quantity_on_order", "rate_custom",
]
DIM_LINE_KEYS = ["item_extid", "salesdescription", "uom_name", "conversion_rate", "product_group_name", "upc_code",
                 "brand_name", "axis_1_option_header_id", "ack_status", "n2_ack_status", "inv_sku"]


def po_line_groups(t, as_of: datetime) -> DataFrame:
    """J08 stage 1: one row per PO line group (the 53 raw GROUP BY keys) with
    its 60 output fields and the per-group terms of the PO totals.

    A line is wide, so it is shuffled twice only: by its own keys, where it meets
    all that the joins find for it, and by the PO number, where it is grouped,
    J08 nests it and J12 joins it. The joins themselves are made for the distinct
    keys of the lines (transaction, item, line), which are narrow: the PO (of which
    only number and id are kept), the item, joined to the inventory flag at item
    level first, and the receipts. Keys that repeat in a joined table multiply the
    keys as they would the lines. Inner lookups of few rows come before all that.

    Receipts are summed by their 4 keys before the join on 3 (A8): two record
    sources give two rows per line, which the group step folds again, so
    ``on_order_quantity`` counts the line quantity once per source while the PO
    total counts it once (G6).
    """
    lines = _live_lines(t)
    return _line_groups(t, _with_found(lines, _found_for_lines(t, lines, as_of)), as_of)


def _live_lines(t) -> DataFrame:
    lines = t["transaction_lines"].where(live()).where(c("transaction_line_id") >= 1).where(c("transaction_id").isNotNull())
    br = t["brand"]
    lines = ops.lookup(lines, br, E.as_key(lines, "brand_id"), E.as_key(br, "brand_id"), {"brand_name": "brand_name"},
                       how="inner", live_only=True, small=t.is_small("brand"))
    return ops.lookup(lines, t["product_group"], c("product_group_id"), "product_group_id",
                      {"product_group_name": "product_group_name"}, how="inner", live_only=True,
                      small=t.is_small("product_group"))


LINE_KEYS = ["transaction_id", "item_id", "transaction_line_id"]


def _found_for_lines(t, lines: DataFrame, as_of: datetime) -> DataFrame:
    """The distinct keys of the lines with all that J08's joins find for them."""
    po = _live_pos(t).select(c("tranid").alias("po_number"), c("transaction_id").alias("__ptid"))
    items = t["items_cv"]
    snap = t["sb_inventory"].where(c("snapshot_day") == E.snapshot_start(as_of))
    items = ops.lookup(items, snap.select("sku").distinct(), c("item_extid"), "sku", {"inv_sku": "sku"})
    keys = po.join(lines.select(*LINE_KEYS).distinct(), c("__ptid") == c("transaction_id"), "inner").drop("__ptid")
    item_fields = {x: x for x in ("item_extid", "salesdescription", "upc_code", "axis_1_option_header_id", "inv_sku")}
    keys = ops.lookup(keys, items, E.as_key(keys, "item_id"), E.as_key(t["items_cv"], "item_id"), item_fields, spread_by=asn.LINE_ID)
    # Receipts (A8, X13). The reference sums receipts by 4 keys and left-joins
    # them on 3, so a line meets one row per record source (or one NULL row).
    # Over those rows, (qty - recv) sums to n * qty - sum(recv). So the receipts
    # are summed by 4 keys (with map-side combine) and folded to one row per 3
    # keys before they meet the lines: a left join that never fans out.
    # Receipt rows with a NULL key match no line and are dropped first.
    key = ["po_number", "received_sku", "po_purchase_order_item_id"]
    rec = t["sb_receipts"].where(c(key[0]).isNotNull() & c(key[1]).isNotNull() & c(key[2]).isNotNull())
    rec = ops.preaggregate(rec, [*key, "RECORD_SOURCE"], {"__recv": F.sum("received_quantity")})
    rec = ops.preaggregate(rec, key, {
        "__n_r": F.count(F.lit(1)), "__s_r0": F.sum(F.coalesce(c("__recv"), F.lit(0.0))), "__s_rn": F.sum("__recv")})
    return ops.lookup(keys, rec, [c("po_number"), c("item_extid"), c("transaction_line_id")], key,
                      {x: x for x in ("__n_r", "__s_r0", "__s_rn")})


def _with_found(lines: DataFrame, found: DataFrame) -> DataFrame:
    found = found.withColumnsRenamed({x: f"__of_{x}" for x in LINE_KEYS})
    same = [lines[x].eqNullSafe(found[f"__of_{x}"]) for x in LINE_KEYS]
    return lines.join(found, same, "inner").drop(*[f"__of_{x}" for x in LINE_KEYS])


def _line_groups(t, lines: DataFrame, as_of: datetime) -> DataFrame:
    df = lines.repartition("po_number")
    uom = t["uom"]
    df = ops.lookup(df, uom, E.as_key(df, "unit_of_measure_id"), E.as_key(uom, "uom_id"),
                    {"uom_name": "name", "conversion_rate": "conversion_rate"}, small=t.is_small("uom"))
    for fk, out in [("acknowledgment_item_status_id", "ack_status"), ("n_2nd_acknowledgment_item_s_id", "n2_ack_status")]:
        df = ops.lookup(df, t["acknowledgment_item_statuses"], c(fk), "list_id", {out: "list_item_name"},
                        small=t.is_small("acknowledgment_item_statuses"))

    qty = F.coalesce(c("item_count"), F.lit(0.0))
    price = F.coalesce(F.replace(c("item_unit_price"), F.lit("%"), F.lit("")), F.lit("0")).cast("double")
    open_rows = F.when(c("__n_r") > 0, c("__n_r") * qty - c("__s_r0")).otherwise(qty)
    # The line-group step reuses the partitioning on the PO number.
    g = df.groupBy("po_number", *DIM_LINE_KEYS, *RAW_LINE_KEYS).agg(
        F.sum(open_rows).alias("on_order_quantity"),
        F.sum(open_rows * price).alias("on_order_cost"),
        F.sum(c("__s_rn")).alias("__recv_sum"),
    )
    window_end = E.transit_window_end(c("asn_estimated_delivery_date"), c("asn_shipment_date"))
    inside = E.in_window(as_of, window_end)
    recv_per_unit = c("quantity_received_in_shipment") / c("conversion_rate")
    open_qty = qty - F.coalesce(c("__recv_sum"), F.lit(0.0))
    return g.select(
        "po_number",
        c("item_extid"), c("vendor_sku"), c("salesdescription").alias("item_description"),
        c("memo").alias("po_item_description"),
        F.coalesce(E.utc_day(c("expected_arrival_eta_line")), F.lit(E.DEFAULT_DAY).cast("date"))
        .alias("expected_arrival_eta_line"),
        c("period_closed").alias("closed"), c("item_count"), c("original_transmitted_qty"),
        c("quantity_received_in_shipment"), c("number_billed"), c("uom_name").alias("unit_of_measure"),
        c("conversion_rate"), c("item_unit_price"), E.rate_text(c("item_unit_price")).alias("rate"),
        c("purchase_price"), c("discount_amount"), c("amount"), c("product_group_name"), c("upc_code"),
        c("brand_name"), c("axis_1_option_header_id").alias("options"), c("line_created_date"),
        c("quantity_available"), c("ack_status").alias("acknowledgment_item_status"), c("transaction_line_id"),
        E.flag(c("inv_sku").isNotNull()).alias("inventory_owned_flag"),
        E.as_of_ts(as_of).alias("transaction_expected_arrival_date"), c("acknowledgment_rate"),
        E.fmt_day(c("acknowledgment_scheduled_date")).alias("acknowledgment_scheduled_date"),
        c("acknowledgment_scheduled_quan").alias("acknowledgment_scheduled_quantity"), c("acknowledgment_memo"),
        c("n2_ack_status").alias("n_2nd_acknowledgment_item_status"),
        c("n_2nd_acknowledgment_scheduled").alias("n_2nd_acknowledgment_scheduled_date"),
        c("n_2nd_acknowledgment_schedul_0").alias("n_2nd_acknowledgment_schedul_quantity"), c("asn_record"),
        c("asn_quantity_shipped"), E.fmt_day(c("asn_shipment_date")).alias("asn_shipment_date"),
        E.fmt_day(c("asn_estimated_delivery_date")).alias("asn_estimated_delivery_date"),
        *[c(x) for x in ["demand_amount", "demand_cogs", "demand_quantity", "estimated_cost", "full_price",
                         "shipping_amount", "amount_custom", "amount_foreign", "amount_pending", "original_cogs",
                         "po__rate", "quantity_allocated", "quantity_custom", "quantity_difference",
                         "quantity_on_order", "rate_custom"]],
        F.coalesce(c("item_count") / c("conversion_rate"), F.lit(0.0)).alias("quantity_in_transaction_unit"),
        F.when(inside, "Yes").otherwise("No").alias("in_transit_window"),
        F.when(inside, E.fmt_day(window_end)).alias("transit_window_end"),
        F.when(recv_per_unit < F.coalesce(c("asn_quantity_shipped"), F.lit(0.0)),
               F.when(inside, c("asn_quantity_shipped") - recv_per_unit)).alias("qty_in_transit"),
        c("on_order_quantity"), c("on_order_cost"),
        open_qty.alias("__total_qty_term"), (open_qty * price).alias("__total_cost_term"),
        F.coalesce(c("amount"), F.lit(0.0)).alias("__amount_term"),
    )


def po_lines_nested(t, as_of: datetime) -> DataFrame:
    """One row per PO number with its line array (60 fields) and totals.

    The reference computes the totals as windows over the line groups of a
    PO and then takes ``max(max(...)) over (partition by po_number)`` while
    grouping by po_number (W2-W4). A window total is the same for every group
    of the PO, so it is exactly the sum over the PO's groups: computed here
    in the same aggregation that builds the array, without a window.

    The line groups are partitioned on the PO number already, so nothing is
    shuffled here: an order's array has to be in one row of one task anyway.
    """
    return _nested_lines(po_line_groups(t, as_of))


def po_lines_in_slices(t, as_of: datetime) -> Iterator[DataFrame]:
    """J08 in turn for each slice of the PO numbers, as jobs of their own: a line's two
    wide shuffles are never on disk as a whole. What the joins find is stored first;
    then the lines, slice by slice of their transactions, meet it and are stored
    by slices of the PO number, which are grouped and nested one by one. A slice
    is deleted once its consumer asks for the next. Run it inside ``freed``."""
    lines = _live_lines(t)
    found = Sliced(t.spark, "line-keys").add(_found_for_lines(t, lines, as_of), "transaction_id")
    met = Sliced(t.spark, "lines-met")
    try:
        for i in range(SLICES):
            met.add(_with_found(lines.where(slice_of("transaction_id") == i), found.of(i)), "po_number")
            found.remove(i)
        for i in range(SLICES):
            yield _nested_lines(_line_groups(t, met.of(i), as_of))
            met.remove(i)
    finally:
        found.remove()
        met.remove()


def _nested_lines(g: DataFrame) -> DataFrame:
    nested = ops.nest(g, ["po_number"], [c(x) for x in LINE_FIELDS], "po_lines", extra=[
        F.max("expected_arrival_eta_line").alias("expected_arrival_date"), F.sum("__total_qty_term").alias("total_on_order_quantity"),
        F.sum("__total_cost_term").alias("total_on_order_cost"), F.sum("__amount_term").alias("__total_amount")])
    return nested.select("po_number", "po_lines", "total_on_order_quantity", "total_on_order_cost",
                         "expected_arrival_date", F.round("__total_amount", 2).alias("total_amount_lines"))


# ----------------------------------------------------------------------- J09

CARRIER_KEYS = ["tranid", "vendor", "po_shipping_status", "date_created", "s_last_modified", "nc_inactive",
                "last_updated", "shipment_id", "s_status", "delivery_date", "tracking_number",
                "carrier_tracking_link_url", "original_delivery_eta", "pick_up_date", "location_0",
                "pallet_count", "declared_value", "shipping_cost", "invoice_number", "invoiced"]


def carrier_rows(t) -> DataFrame:
    """J09 stage 1: distinct carrier rows of live POs (the 20 GROUP BY keys).

    Live location and live line rows are required (their WHERE filters) but
    no column of theirs is used and the dedupe hides their fan-out, so they
    are semi joins against distinct keys.
    """
    po = t["transactions"].where(c("transaction_type") == PURCHASE_ORDER).where(live())
    po = ops.keys_present(po, t["locations"].where(live()), c("location_id"), "location_id")
    lines = t["transaction_lines"].where(live())
    lk = lines.select(E.as_key(lines, "transaction_id").alias("__tid"))
    po = ops.keys_present(po, lk, E.as_key(po, "transaction_id"), "__tid")
    nc = t["carrier_shipping_data"].where(c("is_inactive") == "F")
    # The vendor is looked up while the rows are narrow and one a PO.
    ent = t["entity"]
    po = po.select("tranid", E.as_key(po, "entity_id").alias("__entity"))
    po = ops.lookup(po, ent, c("__entity"), E.as_key(ent, "entity_id"), {"vendor": "name"}, how="inner", live_only=True)
    df = ops.lookup(po, nc, c("tranid"), "carrier_shipping_data_name", {
        "nc_id": "carrier_shipping_data_id", "po_shipping_status": "po_shipping_status",
        "date_created": "date_created", "nc_inactive": "is_inactive"}, how="inner")
    df = ops.lookup(df, t["carrier_shipments"], c("nc_id"), "carrier_shipping_data_id", {
        "s_last_modified": "last_modified_date", "s_status": "status",
        **{k: k for k in ["last_updated", "shipment_id", "delivery_date", "tracking_number",
                          "carrier_tracking_link_url", "original_delivery_eta", "pick_up_date", "location_0",
                          "pallet_count", "declared_value", "shipping_cost", "invoice_number", "invoiced"]}})
    # One shuffle on the PO number serves the DISTINCT, the nest and J12's join.
    return df.select(*CARRIER_KEYS).repartition("tranid").distinct()


def carrier_shipments_nested(t, as_of: datetime | None = None) -> DataFrame:
    """One row per (PO number, vendor) with the array of its shipments."""
    rows = carrier_rows(t)
    shipment = [
        c("shipment_id"), c("pallet_count"), c("declared_value"), c("shipping_cost"),
        E.t_yes_no(c("nc_inactive")).alias("inactive"),
        F.struct(c("tracking_number"), c("carrier_tracking_link_url"), c("location_0").alias("location"),
                 c("po_shipping_status"), c("s_status").alias("status")).alias("tracking"),
        F.struct(c("invoice_number"), E.t_yes_no(c("invoiced")).alias("invoiced")).alias("invoice"),
        F.struct(E.fmt_ts(c("date_created")).alias("date_created"),
                 E.fmt_ts(c("s_last_modified")).alias("last_modified"),
                 E.fmt_ts(c("last_updated")).alias("last_updated"),
                 E.fmt_day(c("delivery_date")).alias("delivery_date"),
                 E.fmt_day(c("original_delivery_eta")).alias("original_delivery_eta"),
                 E.fmt_day(c("pick_up_date")).alias("pick_up_date")).alias("shipment_dates"),
    ]
    out = ops.nest(rows, ["tranid", "vendor"], shipment, "shipment_details")
    return out.select(
        c("tranid").alias("carrier_shipping_data"), c("tranid").alias("po_number"), c("vendor"),
        F.concat(F.lit("Purchase Order #"), F.lit(" "), c("tranid")).alias("custom_po_number"),
        c("shipment_details"))


# ----------------------------------------------------------------------- J10

def vendor_contacts_stage(t, as_of: datetime | None = None) -> DataFrame:
    """As J06 with live-row filters in every part (27 columns).

    The filters on the children null-reject, so a vendor without (live)
    children gets a NULL tab here, where J06 gives a one-element array of
    NULL fields.
    """
    return asn.vendor_documents(t, live_rows=True)


# ----------------------------------------------------------------------- J11

STAGE_CONTACT_FIELDS = [x if x not in ("company", "address1") else
                        {"company": "company_name", "address1": "address_tab"}[x] for x in asn.CONTACT_FIELDS]


def contact_details_stage(t, as_of: datetime | None = None) -> DataFrame:
    """Live, active contacts with a company; as J04 but grouped on first
    and last name apart, ``company`` -> ``company_name``, ``address1`` ->
    ``address_tab`` (30 columns)."""
    contacts = (t["contacts"].where(live()).where(c("company_id").isNotNull()).where(c("isinactive") == "No"))
    g = asn.contact_groups(t, contacts, [
        c("contact_id"), c("full_name"), c("name"), c("salutation"), c("firstname"), c("lastname"), c("company_id"),
        c("company"), c("title"), c("comments"), c("is_private"), c("email"), c("altemail"), c("phone"),
        c("officephone"), c("mobilephone"), c("homephone"), c("fax"), c("address"), c("subsidiary"), c("sub_name"),
        c("last_sales_activity"), c("supervisor"), c("supervisorphone"), c("assistand"), c("assistantphone"),
        c("isinactive"),
    ])
    return g.select(
        c("contact_id"), c("full_name"), c("name").alias("contact"), c("salutation").alias("salutation_MR_MS"),
        F.concat(c("firstname"), F.lit(" "), c("lastname")).alias("name"), c("company_id"),
        c("company").alias("company_name"), c("title").alias("job_title"), c("comments"),
        c("is_private").alias("private"), c("category"), c("email"), c("altemail"), c("phone").alias("mainphone"),
        c("officephone"), c("mobilephone"), c("homephone"), c("fax"), c("address"),
        c("subsidiary").alias("subsidiary_id"), c("sub_name").alias("subsidiary"), c("last_sales_activity"),
        c("supervisor"), c("supervisorphone"), c("assistand"), c("assistantphone"),
        c("ab_ship").alias("is_default_ship_address"), c("ab_bill").alias("is_default_bill_address"),
        c("ab_address").alias("address_tab"), c("isinactive"),
    )


# ----------------------------------------------------------------------- J12

def purchase_order_nested(po_all: DataFrame, po_lines: DataFrame, carrier: DataFrame,
                          as_of: datetime) -> DataFrame:
    """The PO document: J07 with its J08 lines and J09 carrier rows (7 columns).

    Both joins are left joins on the PO number: a PO absent from J08 gets
    NULL lines and a NULL partition date; a PO with two J09 rows (two
    vendors) gives two documents, as in the reference.
    """
    ln = po_lines.withColumnRenamed("po_number", "__ln_po")
    df = po_all.join(ln, po_all["po_number"] == ln["__ln_po"], "left")
    cr = carrier.select(c("carrier_shipping_data").alias("__cr_po"),
                        c("carrier_shipping_data").alias("cr_data"), c("shipment_details"))
    df = df.join(cr, df["po_number"] == cr["__cr_po"], "left")
    return df.select(
        c("expected_arrival_date"), c("po_number"),
        F.struct(
            c("po_title"), c("po_type"), c("transaction_extid"), c("external_id"), c("memo"),
            c("buyer").alias("buyer_name"), c("po_status"), c("po_terms"), c("down_payment"), c("po_email_sent"),
            c("po_is_finalized"), c("po_allocation_channel"), c("merchandise_division"), c("location_code"),
            c("integration_status"), c("po_first_transmission"), c("ready_for_860_transmit"),
            c("record_source_system"), c("po_category"), c("location"), c("po_batch_name"),
            c("purchase_order_change_status"), c("reason_for_purchase"), c("competing_bids"), c("cost_center"),
            c("transmitted_po"), c("sent_to_chr"),
            F.struct(*[c(x) for x in [
                "po_created_date", "po_date", "po_cancel_date", "po_ship_date", "po_original_ship_date",
                "po_original_cancel_date", "po_due_date", "po_fixed_payment_date", "po_edit_date", "days_to_edit",
                "po_edit_fiscal_week_number", "n_860_last_execution_timestamp", "n_850_last_execution_timestamp",
                "days_past_due", "transaction_purpose"]]).alias("po_dates"),
            F.struct(c("vendor_id").alias("po_vendor_id"), c("po_vendor")).alias("po_vendor"),
            F.struct(c("season_code"), c("season_year")).alias("po_season"),
            F.struct(c("acknowledgment_date"), c("acknowledgment_terms"), c("acknowledgment_scheduled_date"),
                     c("acknowledgment_memo"), c("acknowledgment_type")).alias("acknowledgment"),
            F.struct(*[c(x) for x in [
                "line_count", "total_quantity", "remaining_open_quantity", "received_amount", "discount_amount",
                "reserved_amount", "shipping_amount", "amount_change", "amount_unbilled", "refunded_amount"]]
            ).alias("po_amounts"),
            c("po_lines"),
        ).alias("purchase_oder"),
        F.struct(c("total_on_order_cost"), c("total_on_order_quantity"), c("total__amount").alias("ni_submitted_total"),
                 c("total_amount_lines"), c("total_amount_billed"), c("total_principal"), c("total_qv_"),
                 c("total_approved")).alias("totals"),
        F.struct(c("cr_data").alias("carrier_shipping_data"), c("shipment_details")).alias("carrier_shipment_chr"),
        E.as_of_ts(as_of).alias("created_date"),
        F.lit(None).cast("timestamp").alias("updated_date"),
    )


# ----------------------------------------------------------------------- J13/J14

ASN_COLUMNS = [
    "edi_856_asn_id", "asn_vendor_id", "bill_of_lading_number", "carrier_alpha_code", "carrier_equipment_number",
    "carrier_pro_number", "carrier_routing", "carrier_trans_method_code", "date_created", "edi_856_asn_extid",
    "edi_856_asn_file", "edi_856_asn_name", "equipment_description_code", "estimated_delivery_date",
    "fob_pay_code", "is_inactive", "lading_quantity", "last_modified_date", "packing_material", "packing_medium",
    "parent_id", "ship_from_address", "ship_from_address_1", "ship_from_address_2", "ship_from_address_3",
    "ship_from_address_4", "ship_from_address_name", "ship_from_city", "ship_from_country",
    "ship_from_postal_code", "ship_from_state", "ship_to_address", "ship_to_address_1", "ship_to_address_2",
    "ship_to_address_3", "ship_to_address_4", "ship_to_address_name", "ship_to_city", "ship_to_country",
    "ship_to_postal_code", "ship_to_state", "shipment_date", "shipment_id", "shipment_notice_date",
    "shipment_notice_time", "status_code", "total_line_item_number", "tset_purpose_code", "vendor_idname_id",
    "weight", "weight_qualifier", "weight_uom",
]
_ASN_SECONDS = {"date_created", "last_modified_date"}
_ASN_DAYS = {"estimated_delivery_date", "shipment_date", "shipment_notice_date"}


def edi_856_asn(t, as_of: datetime | None = None) -> DataFrame:
    """Live EDI 856 headers, dates formatted, ``is_inactive`` decoded (52 columns)."""
    df = t["edi_856_asn"].where(live())
    out = []
    for x in ASN_COLUMNS:
        if x in _ASN_SECONDS:
            out.append(E.fmt_ts(c(x)).alias(x))
        elif x in _ASN_DAYS:
            out.append(E.fmt_day(c(x)).alias(x))
        elif x == "is_inactive":
            out.append(E.not_f(c(x)).alias(x))
        else:
            out.append(c(x))
    return df.select(*out)


def edi_856_asn_line(t, as_of: datetime | None = None) -> DataFrame:
    """Live EDI 856 lines with a live PO type and division (35 columns)."""
    df = t["edi_856_asn_line"].where(live())
    pt, md = t["po_types"], t["merchandise_division"]
    df = ops.lookup(df, pt, E.as_key(df, "po_type_id"), E.as_key(pt, "list_id"), {"po_type": "list_item_name"},
                    how="inner", live_only=True, small=t.is_small("po_types"))
    df = ops.lookup(df, md, E.as_key(df, "po_md_id"), E.as_key(md, "merchandise_division_id"),
                    {"merchandise_division_name": "merchandise_division_name"}, how="inner", live_only=True,
                    small=t.is_small("merchandise_division"))
    return df.select(
        "edi_856_asn_line_id", "asn_vendor_id", "carrier_package_id", E.fmt_ts(c("date_created")).alias("date_created"),
        "edi_856_asn_id", "edi_856_asn_line_extid",
        E.fmt_day(c("estimated_delivery_date")).alias("estimated_delivery_date"),
        E.not_f(c("is_inactive")).alias("is_inactive"), E.fmt_ts(c("last_modified_date")).alias("last_modified_date"),
        "line_number", "line_ship_quantity", "mpn", "order_qty_uom", "pack_level_type", "pack_value", "pack_weight",
        "pack_weight_uom", "packing_material", "packing_medium", "parent_id", "po_md_id", "merchandise_division_name",
        "po_type_id", "po_type", "product_description",
        E.fmt_day(c("purchase_order_date")).alias("purchase_order_date"), "purchase_order_id",
        c("purchase_order_id_0").alias("po_number"), c("quantity_ordered").alias("po_internal_id"), "ship_qty_uom",
        E.fmt_day(c("shipment_date")).alias("shipment_date"), "shipping_serial_id", "sku", "upc",
        "vendor_part_number",
    )


# ----------------------------------------------------------------------- J15

CONTACT_ARRAY_FIELDS = [
    "contact_id", "full_name", "contact", "salutation_MR_MS", "contact_name", "company_id", "company_name",
    "job_title", "comments", "private", "category", "email", "altemail", "mainphone", "officephone",
    "mobilephone", "homephone", "fax", "address", "subsidiary_id", "subsidiary", "last_sales_activity",
    "supervisor", "supervisorphone", "assistand", "assistantphone", "is_default_ship_address",
    "is_default_bill_address", "address_tab", "isinactive",
]


def vendor_contacts_nested(vendors_stage: DataFrame, contacts_stage: DataFrame) -> DataFrame:
    """The vendor document: J10 with the array of its J11 contacts (20 columns)."""
    ct = contacts_stage.where(c("company_id").isNotNull()).where(c("isinactive") == "No")
    ct = ct.withColumn("contact_name", c("name"))
    nested = ops.nest(ct, [c("company_id").alias("__company")], [c(x) for x in CONTACT_ARRAY_FIELDS], "contacts")
    v = vendors_stage
    df = v.join(nested, v["internal_vendor_id"] == nested["__company"], "left")
    return df.select(
        "name", "companyname", "status", "vendor_id", "internal_vendor_id", "custom_vendor_externalid", "type",
        "vendor_category", "terms", "incoterm", "comments",
        F.struct("email", "email_address_for_payment_not", "accounting_email", "phone", "altphone", "fax",
                 "web_address", "address").alias("email_phone_address"),
        "address_tab", "purchasing_tab", "financials_tab", "relationships_tab", "communications_tab",
        "approvals_tab", "subsidiaries_tab", "contacts",
    )


# ----------------------------------------------------------------------- run order

def po_document(t, as_of: datetime) -> DataFrame:
    """L2: J07, J08, J09 -> J12 (passed as DataFrames; see ``publish`` to stage them)."""
    return purchase_order_nested(purchase_orders_all(t, as_of), po_lines_nested(t, as_of),
                                 carrier_shipments_nested(t), as_of)


def po_documents_in_slices(t, as_of: datetime) -> Iterator[DataFrame]:
    """``po_document`` in turn for each slice of the PO numbers (see ``po_lines_in_slices``);
    J07 and J09 are stored by the same slices. Run it inside ``freed``."""
    orders = Sliced(t.spark, "purchase-orders")
    carriers = Sliced(t.spark, "carrier-shipments")
    try:
        orders.add(purchase_orders_all(t, as_of), "po_number")
        carriers.add(carrier_shipments_nested(t), "carrier_shipping_data")
        for i, lines in enumerate(po_lines_in_slices(t, as_of)):
            yield purchase_order_nested(orders.of(i), lines, carriers.of(i), as_of)
    finally:
        orders.remove()
        carriers.remove()


def vendor_document(t, as_of: datetime | None = None) -> DataFrame:
    """L3: J10, J11 -> J15."""
    return vendor_contacts_nested(vendor_contacts_stage(t), contact_details_stage(t))
