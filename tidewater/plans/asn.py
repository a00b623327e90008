"""Pipeline A: open in-transit lines, division summary, carrier rows,
contacts, EDI PO/vendor fields and the vendor document (J01-J06).

Each builder is ``(t, as_of) -> DataFrame`` over the source mapping ``t``
(see ``tidewater.sources.catalog``). Joins the reference writes as LEFT but
filters on afterwards (null-rejecting WHERE) are written as the inner joins
they are, so Catalyst can push them down to the scans; only code lists,
bounded by their definition (``t.is_small``), carry a broadcast hint.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import expr as E
from tidewater.functions.expr import c
from tidewater.operators import ops, spread

PURCHASE_ORDER = "Purchase Order"
#: What tells rows apart where a NULL foreign key deals them out (``ops.lookup``).
LINE_ID, MESSAGE_ID = ("transaction_id", "transaction_line_id"), ("company_id", "date_0", "subject", "recipient_id", "author_id")


def _po_lines_in_transit(t, as_of: datetime, shipped_over: str) -> DataFrame:
    """Shared core of J01/J02: PO lines with an open ASN inside the window.

    ``shipped_over`` is the line column the shipped quantity must exceed:
    ``quantity_received_in_shipment`` (J01) or ``item_count`` (J02).
    """
    po = t["transactions"].where(c("transaction_type") == PURCHASE_ORDER)
    lines = t["transaction_lines"]
    lines = (
        lines.where(c("transaction_line_id") > 0)
        .where(c("asn_quantity_shipped") > c(shipped_over))
        .where(c("asn_record").isNotNull())
        .withColumn("transit_window_end",
                    E.transit_window_end(c("asn_estimated_delivery_date"), c("asn_shipment_date")))
        .where(E.in_window(as_of, c("transit_window_end")))
        .withColumn("__lk", E.as_key(lines, "transaction_id"))
        .drop("transaction_id")
    )
    lines = ops.prefix_clashes(lines, po.columns, "ln_")
    # PO type label <> 'Non-Inventory' (second po_types join, null-rejecting).
    po = ops.lookup(po, t["po_types"], E.as_key(po, "po_type_id"), E.as_key(t["po_types"], "list_id"),
                    how="inner", where=c("list_item_name") != "Non-Inventory",
                    small=t.is_small("po_types"))
    # The window-filtered lines are the selective side: join them to the POs
    # first (AQE can broadcast them, leaving the PO table unshuffled), so only
    # POs with open lines meet the vendor lookup below.
    po = po.withColumn("__pk", E.as_key(po, "transaction_id"))
    df = po.join(lines, po["__pk"] == lines["__lk"], "inner").drop("__pk", "__lk")
    # Vendor (entity) whose EDI-856 flag reads 'Yes' (null-rejecting on both).
    ent = t["entity"]
    edi_yes = ops.lookup(ent, t["edi_document_type_status"], E.as_key(ent, "edi_856_id"),
                         E.as_key(t["edi_document_type_status"], "list_id"), how="inner",
                         where=c("list_item_name") == "Yes",
                         small=t.is_small("edi_document_type_status"))
    return ops.lookup(df, edi_yes, E.as_key(df, "entity_id"), E.as_key(ent, "entity_id"),
                      {"vendor": "name"}, how="inner")


def asn_details(t, as_of: datetime) -> DataFrame:
    """Open in-transit PO lines of EDI vendors, one row per line (35 columns).

    The reference ends with ``ORDER BY po_number``; a stored table keeps no
    order, so the order is applied by ``publish(sort_within=...)`` instead of
    a global sort here.
    """
    df = _po_lines_in_transit(t, as_of, "quantity_received_in_shipment")
    for dim, fk, label, out in [
        ("season", "season_code_id", "list_item_name", "season_code"),
        ("year1", "season_year_id", "list_item_name", "season_year"),
        ("po_types", "po_type_id", "list_item_name", "po_type"),
        ("merchandise_division", "merchandise_division_id", "merchandise_division_name",
         "merchandise_division"),
    ]:
        key = "list_id" if dim != "merchandise_division" else "merchandise_division_id"
        df = ops.lookup(df, t[dim], E.as_key(df, fk), E.as_key(t[dim], key), {out: label},
                        small=t.is_small(dim), spread_by=LINE_ID)
    df = ops.lookup(df, t["brand"], E.as_key(df, "brand_id"), E.as_key(t["brand"], "brand_id"),
                    {"brand": "brand_name"}, small=t.is_small("brand"), spread_by=LINE_ID)
    emp = t["employees"]
    df = ops.lookup(df, emp, E.as_key(df, "sales_rep_id"), E.as_key(emp, "employee_id"),
                    {"buyer": "full_name"}, spread_by=LINE_ID)
    items = t["items_cv"]
    items = ops.lookup(items, t["uom"], E.as_key(items, "uom_id"), E.as_key(t["uom"], "uom_id"),
                       {"units": "name"}, small=t.is_small("uom"))
    df = ops.lookup(df, items, E.as_key(df, "item_id"), E.as_key(t["items_cv"], "item_id"),
                    {"sku": "item_extid", "upc": "upc_code", "units": "units"}, spread_by=LINE_ID)
    return df.select(
        c("vendor"), c("brand"), c("trandate").alias("po_date"), c("ship_date"), c("cancel_date"),
        c("tranid").alias("po_number"), c("merchandise_division"), c("po_type"), c("season_code"),
        c("season_year"), c("buyer"), c("transaction_line_id").alias("line_id"), c("sku"),
        c("vendor_sku"), c("upc"), c("ln_memo").alias("memo"), c("expected_arrival_eta_line"),
        c("item_count").alias("quantity_in_transaction_unit"), c("original_transmitted_qty"),
        c("quantity_received_in_shipment").alias("quantity_fulfilled_received"),
        c("number_billed").alias("quantity_billed"),
        (c("asn_quantity_shipped") - c("quantity_received_in_shipment")).alias("qty_in_transit"),
        c("units"), c("item_unit_price").alias("rate"), c("ln_discount_amount").alias("discount_amount"),
        c("purchase_price"),
        c("amount"), c("asn_record"), c("asn_quantity_shipped"), c("asn_shipment_date"),
        c("asn_estimated_delivery_date"), c("n_860_last_execution_timestamp").alias("n_860_sent"),
        c("status"), E.yes_no_window(as_of, c("transit_window_end")).alias("in_transit_window"),
        c("transit_window_end"),
    )


def asn_summary(t, as_of: datetime) -> DataFrame:
    """Problem lines per (division, assignee), with division-wide distinct
    PO and vendor counts (5 columns).

    ``count(distinct) over (partition by division)`` is not allowed in Spark
    (W1). Both levels are computed from one fine aggregate keyed by
    (division, assignee id, assignee, PO, vendor): its shuffle is shared by
    the two roll-ups (exchange reuse), the key is spread by PO, and the
    division level, at most one row per division name, is joined back with a
    null-safe key.
    """
    df = _po_lines_in_transit(t, as_of, "item_count")
    # Joined but unused in the reference; kept, since a repeated key would
    # change count(*).
    for dim, fk in [("season", "season_code_id"), ("year1", "season_year_id"), ("po_types", "po_type_id")]:
        df = ops.lookup(df, t[dim], E.as_key(df, fk), E.as_key(t[dim], "list_id"), small=t.is_small(dim))
    df = ops.lookup(df, t["brand"], E.as_key(df, "brand_id"), E.as_key(t["brand"], "brand_id"),
                    small=t.is_small("brand"), spread_by=LINE_ID)
    items = t["items_cv"]
    items = ops.lookup(items, t["uom"], E.as_key(items, "uom_id"), E.as_key(t["uom"], "uom_id"),
                       small=t.is_small("uom"))
    df = ops.lookup(df, items, E.as_key(df, "item_id"), E.as_key(t["items_cv"], "item_id"), spread_by=LINE_ID)
    merch = t["merchandise_division"]
    df = ops.lookup(df, merch, E.as_key(df, "merchandise_division_id"),
                    E.as_key(merch, "merchandise_division_id"),
                    {"merchandise_division": "merchandise_division_name", "assigned_to_id": "assigned_to_id"},
                    small=t.is_small("merchandise_division"), spread_by=LINE_ID)
    df = ops.lookup(df, t["employees"], c("assigned_to_id"), "employee_id", {"assigned_to": "full_name"}, spread_by=LINE_ID)
    fine = (df.groupBy("merchandise_division", "assigned_to_id", "assigned_to",
                       c("tranid").alias("po_number"), "vendor")
            .agg(F.count(F.lit(1)).alias("n")))
    per_assignee = fine.groupBy("merchandise_division", "assigned_to_id", "assigned_to").agg(
        F.sum("n").alias("count_problems_lines"))
    # ``n`` is summed here too, so that both roll-ups read the same aggregate
    # and its shuffle is planned once (exchange reuse).
    per_division = ops.distinct_count_by(
        fine, "merchandise_division", {"count_vendors": "vendor", "count_orders": "po_number"}, F.sum("n").alias("__n")
    ).withColumnRenamed("merchandise_division", "__div").where("__n > 0")
    out = per_assignee.join(per_division, per_assignee["merchandise_division"].eqNullSafe(per_division["__div"]))
    return out.select(
        "merchandise_division",
        F.col("count_vendors").cast("bigint").alias("count_vendors"),
        F.col("count_orders").cast("bigint").alias("count_orders"),
        "assigned_to",
        F.col("count_problems_lines").cast("bigint").alias("count_problems_lines"),
    )


def _carrier_headers(t, as_of: datetime, recent_only: bool) -> DataFrame:
    """PO header joined to its carrier header (name = PO number), ``is_inactive = 'F'``."""
    nc = t["carrier_shipping_data"].where(c("is_inactive") == "F")
    if recent_only:
        nc = nc.where(c("po_shipping_status") != "CREATED").where(c("date_created") >= E.recent_since(as_of))
    return nc


def carrier_shipment_info(t, as_of: datetime) -> DataFrame:
    """Distinct carrier shipment rows of POs made in the last 30 days (23 columns).

    ``locations`` and ``transaction_lines`` are left-joined and unused in the
    reference; the 23-column dedupe hides their fan-out, so they are left out.
    """
    po = t["transactions"].where(c("transaction_type") == PURCHASE_ORDER)
    nc = _carrier_headers(t, as_of, recent_only=True)
    ncs = t["carrier_shipments"].where(c("status") != "Pending")
    df = ops.lookup(po, nc, c("tranid"), "carrier_shipping_data_name", {
        "nc_id": "carrier_shipping_data_id", "po_shipping_status": "po_shipping_status",
        "date_created": "date_created", "last_modified": "last_modified_date", "nc_inactive": "is_inactive",
    }, how="inner")
    df = ops.lookup(df, ncs, c("nc_id"), "carrier_shipping_data_id", {
        "ship_status": "status",
        **{k: k for k in ["last_updated", "shipment_id", "delivery_date", "tracking_number",
                       "carrier_tracking_link_url", "original_delivery_eta", "pick_up_date",
                       "location_0", "pallet_count", "declared_value", "shipping_cost",
                       "invoice_number", "invoiced"]},
    }, how="inner")
    ent = t["entity"]
    df = ops.lookup(df, ent, E.as_key(df, "entity_id"), E.as_key(ent, "entity_id"), {"vendor": "name"},
                    spread_by=("transaction_id", "shipment_id"))
    return df.select(
        c("tranid").alias("name"), c("vendor"),
        F.concat(F.lit("Purchase Order #"), F.lit(" "), c("tranid")).alias("po_number"),
        c("po_shipping_status"), c("date_created"), c("last_modified"),
        E.t_yes_no(c("nc_inactive")).alias("inactive"), c("tranid").alias("carrier_shipping_data"),
        c("last_updated"), c("shipment_id"), c("ship_status").alias("status"), c("delivery_date"),
        c("tracking_number"),
        c("carrier_tracking_link_url"), c("tracking_number").alias("tracking_number_html"),
        c("original_delivery_eta"), c("pick_up_date"), c("location_0").alias("location"),
        c("pallet_count"), c("declared_value"), c("shipping_cost"), c("invoice_number"),
        E.t_yes_no(c("invoiced")).alias("invoiced"),
    ).distinct()


CONTACT_FIELDS = [
    "contact_id", "full_name", "contact", "salutation_MR_MS", "name", "company_id", "company",
    "job_title", "comments", "private", "category", "email", "altemail", "mainphone", "officephone",
    "mobilephone", "homephone", "fax", "address", "subsidiary_id", "subsidiary",
    "last_sales_activity", "supervisor", "supervisorphone", "assistand", "assistantphone",
    "is_default_ship_address", "is_default_bill_address", "address1", "isinactive",
]


def contact_groups(t, contacts: DataFrame, keys: list) -> DataFrame:
    """Contacts by their ``keys`` (which hold the contact id), each with one of its
    addresses and the sorted ``category`` array of its types.

    The reference left-joins the raw address and type rows to the contact and groups
    the product. Here neither child's rows meet the other's:

    * contacts, after their one-to-one lookups, are grouped first, with their count;
    * addresses are reduced to distinct values with their count, and are the left
      side of their join, so a contact with very many of them is split over tasks;
      contacts without any follow from an anti join on distinct ids;
    * types are nested by themselves, one array a contact, which meets the contacts
      before they are grouped: nothing above the address join asks for its
      partitioning, so adaptive execution is free to split it.

    The product's row count is the product of the counts, so each type stands
    ``contacts x addresses`` times in its array (G10). A contact without types has ``['']``.
    """
    types = ops.nest(t["contact_types"].where(c("contact_id").isNotNull()), [c("contact_id").alias("__typed")],
                     [F.coalesce(c("name"), F.lit("")).alias("name")], "__types")
    df = contacts.join(types, contacts["contact_id"] == types["__typed"], "left").drop("__typed")
    df = ops.lookup(df, t["subsidiaries"], c("subsidiary"), "subsidiary_id", {"sub_name": "name"},
                    small=t.is_small("subsidiaries"), spread_by=("contact_id",))
    df = ops.lookup(df, t["companies"], c("company_id"), "company_id", {"company": "companyname"}, spread_by=("contact_id",))
    df = ops.lookup(df, t["entity"], c("supervisior_id"), "entity_id", {"supervisor": "name"}, spread_by=("contact_id",))
    df = ops.lookup(df, t["entity"], c("assistant_id"), "entity_id", {"assistand": "name"}, spread_by=("contact_id",))
    # The rows are dealt before they are grouped: a task that reads many contacts would
    # sort them all for its part of the aggregate. Two keys, so that the address join
    # below still has a shuffle of its own.
    base = df.repartition("contact_id", "full_name").groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.first("__types").alias("__types"))
    addresses = t["address_book"].where(c("entity_id").isNotNull()).groupBy(
        c("entity_id").alias("__addressed"), c("is_default_ship_address").alias("ab_ship"),
        c("is_default_bill_address").alias("ab_bill"), c("address").alias("ab_address")).agg(F.count(F.lit(1)).alias("__m"))
    found = addresses.join(base, addresses["__addressed"] == base["contact_id"], "inner").drop("__addressed")
    ids = t["address_book"].select(c("entity_id").alias("__addressed")).distinct()
    lone = base.join(ids, base["contact_id"] == ids["__addressed"], "left_anti").select(
        *[F.lit(None).cast(found.schema[x].dataType).alias(x) for x in ("ab_ship", "ab_bill", "ab_address")], F.lit(1).cast("bigint").alias("__m"), "*")
    rows = found.unionByName(lone)
    names = F.coalesce(F.transform("__types", lambda x: x["name"]), F.array(F.lit("")))
    times = (c("__n") * c("__m")).cast("int")
    return rows.withColumn("category", F.flatten(F.transform(names, lambda x: F.array_repeat(x, times)))).drop("__n", "__m", "__types")


def contact_details(t, as_of: datetime | None = None) -> DataFrame:
    """One row per contact and address values, with the contact-type array (30 columns).

    No filter at all. Two equal address rows fall in one group and double its
    categories (G10), as in the reference; a contact without types gets
    ``['']``.
    """
    out = contact_groups(t, t["contacts"], [
        c("contact_id"), c("full_name"), c("name").alias("contact"), c("salutation").alias("salutation_MR_MS"),
        F.concat(c("firstname"), F.lit(" "), c("lastname")).alias("name"), c("company_id"), c("company"),
        c("title").alias("job_title"), c("comments"), c("is_private").alias("private"), c("email"),
        c("altemail"), c("phone").alias("mainphone"), c("officephone"), c("mobilephone"), c("homephone"),
        c("fax"), c("address"), c("subsidiary").alias("subsidiary_id"), c("sub_name").alias("subsidiary"),
        c("last_sales_activity"), c("supervisor"), c("supervisorphone"), c("assistand"), c("assistantphone"),
        c("isinactive"),
    ])
    out = out.withColumnsRenamed({"ab_ship": "is_default_ship_address", "ab_bill": "is_default_bill_address", "ab_address": "address1"})
    return out.select(*CONTACT_FIELDS)


EDI_ROLES = [("edi_810", "edi_810_id"), ("edi_846", "edi_846_id"), ("edi_850", "edi_850_id"),
             ("edi_855", "edi_855_id"), ("edi_856", "edi_856_id"), ("edi_860", "edi_860_id")]


def edi_po_vendor_fields(t, as_of: datetime, tile: int = spread.TILE, shown: Callable[[list], list] | None = None) -> DataFrame:
    """Distinct EDI fields of recent POs x EDI vendors of the same currency (36 columns).

    The vendor join is on currency alone (G1), a many-to-many fan-out under a
    dedupe. Each side is reduced to its distinct rows with the set of their
    currencies; a pair of rows is joined on the least currency that both sets
    hold, so pairs are distinct by construction and nothing is shuffled or
    deduplicated above the join. There are few currencies, so the join is a grid:
    ``tile`` distinct order rows and vendor rows a cell.

    There are many more pairs than rows. ``shown`` (fields to columns) is how a caller
    wants to see the values: each side's distinct rows are put so before they meet.
    """
    po = (t["transactions"].where(c("transaction_type") == PURCHASE_ORDER)
          .where(c("n_850_last_execution_timestamp") >= E.recent_since(as_of)))
    lines = t["transaction_lines"]
    po = po.withColumn("__pk", E.as_key(po, "transaction_id"))
    ln = lines.select(
        E.as_key(lines, "transaction_id").alias("__lk"), "acknowledgment_item_status_id",
        "acknowledgment_rate", c("acknowledgment_scheduled_date").alias("acknowledgment_scheduled_date1"),
        "acknowledgment_scheduled_quan", "n_2nd_acknowledgment_item_s_id", "n_2nd_acknowledgment_scheduled",
        "n_2nd_acknowledgment_schedul_0", "asn_record", "asn_quantity_shipped", "asn_shipment_date",
        "asn_estimated_delivery_date")
    # Only lines of the recent POs can survive: reduce the line table with a
    # semi join on the recent POs' distinct keys before the left join, so the
    # lines shuffled (or, with a small key set, filtered map-side after AQE
    # broadcasts it) are those of the 30-day window, not all lines.
    ln = ops.keys_present(ln, po.select("__pk"), c("__lk"), "__pk")
    df = po.join(ln, po["__pk"] == ln["__lk"], "left")
    # Item status; the acknowledgment type is looked up with the matched
    # item-status id (G2), and the 860 flag with the matched integration id.
    df = ops.lookup(df, t["acknowledgment_item_statuses"], c("acknowledgment_item_status_id"), "list_id",
                    {"acknowledgment_item_status": "list_item_name", "__status_id": "list_id"},
                    small=t.is_small("acknowledgment_item_statuses"))
    df = ops.lookup(df, t["acknowledgment_types"], c("__status_id"), "list_id",
                    {"__atyp": "list_item_name"}, small=t.is_small("acknowledgment_types"))
    df = ops.lookup(df, t["integrationstatuses"], c("integration_status_id"), "list_id",
                    {"integration_status_label": "list_item_name", "__ist_id": "list_id"},
                    small=t.is_small("integrationstatuses"))
    df = ops.lookup(df, t["ready_for_860_transmit"], c("__ist_id"), "list_id",
                    {"__rf": "list_item_name"}, small=t.is_small("ready_for_860_transmit"))
    po_side = df.select(
        c("currency_id").alias("__cur"),
        c("tranid"), E.utc_day(c("original_ship_date")).alias("original_ship_date"),
        E.utc_day(c("original_cancel_date")).alias("original_cancel_date"),
        c("tranid").alias("Carrier_Shipping_Data"), E.t_yes_no(c("sent_to_chr")).alias("sent_to_chr"),
        E.fmt_day(c("n_860_last_execution_timestamp")).alias("n_860_last_execution_timestamp"),
        c("location_code").cast("bigint").alias("location_code"),
        c("integration_status_label").alias("integration_status_id"),
        c("__rf").alias("ready_for_860_transmit_id"),
        E.fmt_day(c("n_850_last_execution_timestamp")).alias("n_850_last_execution_timestamp"),
        E.fmt_day(c("acknowledgment_date")).alias("acknowledgment_date"), c("acknowledgment_terms"),
        c("acknowledgment_scheduled_date"), c("acknowledgment_memo"), c("__atyp").alias("acknowledgment_type_id"),
        c("acknowledgment_item_status"), c("acknowledgment_rate"), c("acknowledgment_scheduled_date1"),
        c("acknowledgment_scheduled_quan"), c("acknowledgment_memo").alias("acknowledgment_memo1"),
        c("n_2nd_acknowledgment_item_s_id").alias("n2nd_Acknowledgment_Item_Status"),
        c("n_2nd_acknowledgment_scheduled").alias("n_2nd_acknowledgment_scheduled_date"),
        c("n_2nd_acknowledgment_schedul_0").alias("n_2nd_acknowledgment_scheduled_quantity"),
        c("asn_record"), c("asn_quantity_shipped"), c("asn_shipment_date"), c("asn_estimated_delivery_date"),
    )
    vend = t["vendors"].where(c("edi") == "T")
    edi = t["edi_document_type_status"]
    for out, fk in EDI_ROLES:
        vend = ops.lookup(vend, edi, c(fk), "list_id", {out: "list_item_name"},
                          small=t.is_small("edi_document_type_status"))
    vend_side = vend.select(
        c("currency_id").alias("__vcur"), E.t_yes_no(c("edi")).alias("edi"),
        *[c(o) for o, _ in EDI_ROLES[:4]],
        E.fmt_day(c("edi_855_activation_date")).alias("edi_855_activation_date"),
        c("edi_856"), c("edi_860"), E.t_yes_no(c("edi_capable")).alias("edi_capable"),
    )
    left, right = _with_currencies(po_side, "__cur", "__pset", shown), _with_currencies(vend_side, "__vcur", "__vset", shown)
    # A currency's orders and vendors meet in a grid of tiles: as many tasks as there is work.
    met = spread.grid_join(left, right, "__cur", "__vcur", tile)
    # Where a side has one currency, the pair meets once anyway, and no sets are compared.
    least = (F.size("__pset") == 1) | (F.size("__vset") == 1) | (c("__cur") == F.array_min(F.array_intersect("__pset", "__vset")))
    return met.where(least).drop("__cur", "__vcur", "__pset", "__vset")


def _with_currencies(side: DataFrame, currency: str, out: str, shown: Callable[[list], list] | None = None) -> DataFrame:
    """Distinct rows of one side with the set of their currencies, one row per currency."""
    values = [x for x in side.columns if x != currency]
    rows = side.where(c(currency).isNotNull()).groupBy(*values).agg(F.collect_set(currency).alias(out))
    if shown:
        rows = rows.select(*shown(rows.schema.fields[:-1]), out)
    return rows.withColumn(currency, F.explode(out))


# ------------------------------------------------------------------- J06 and J10

def vendor_contacts(t, as_of: datetime | None = None) -> DataFrame:
    """One row per vendor x subsidiary-map row, with 7 tabs (25 columns).

    A vendor without children gets a one-element array of NULL fields (an
    unmatched left join inside ARRAY_AGG). ``financials`` is not aggregated, so
    the grain is vendor x map row (G3).
    """
    return vendor_documents(t, live_rows=False)


def vendor_documents(t, live_rows: bool) -> DataFrame:
    """The vendor documents of J06, or with live rows only those of J10.

    The vendor table is read once and widened by its one-to-one lookups. Each
    child table is the left side of its own lookups and is nested on the vendor
    id by itself; vendors then meet one row per child tab. So a vendor that
    holds most children is spread over tasks until the nest, which has to hold
    its array. Vendor ids are unique.

    J10's filters on joined tables null-reject: a tab is NULL where its lookups
    or children have no live row (``ok`` flags), where J06 has NULL fields.
    """
    how = "inner" if live_rows else "left"
    v = t["vendors"].where(c("companyname").isNotNull())
    v = v.where(E.live()) if live_rows else v
    emp = t["employees"]
    v = ops.lookup(v, emp, E.as_key(v, "created_by_ven_id"), E.as_key(emp, "employee_id"), {"t_creator": "full_name"},
                   how=how, live_only=live_rows, spread_by=("vendor_id",))
    one = {"live_only": live_rows, "spread_by": ("vendor_id",)}
    ok = F.lit(True)
    for dim, fk, key, fields in [
        ("vendor_types", c("vendor_type_id"), "vendor_type_id", {"vendor_category": "name"}),
        ("payment_terms", c("payment_terms_id"), "payment_terms_id", {"terms": "name"}),
        *[("edi_document_type_status", c(fk), "list_id", {f"t_{out}": "list_item_name"}) for out, fk in EDI_ROLES],
    ]:
        v = ops.lookup(v, t[dim], fk, key, fields, small=t.is_small(dim))
    v = ops.lookup(v, t["currencies"], c("currency_id"), "currency_id", {"currency": "name", "ok_currency": ok},
                   small=t.is_small("currencies"), **one)
    v = ops.lookup(v, t["subsidiaries"], c("subsidiary"), "subsidiary_id", {
        "s_name": "name", "s_inactive": "isinactive", "s_tax": "state_tax_number", "ok_subsidiary": ok}, **one)
    for dim in ("finance_status", "operations_status"):
        v = ops.lookup(v, t[dim], E.as_key(v, f"{dim}_ven_id"), E.as_key(t[dim], "list_id"),
                       {f"t_{dim}": "list_item_name", f"ok_{dim}": ok}, small=t.is_small(dim), **one)
    if live_rows:
        v = ops.lookup(v, emp, c("accounting_clerk_id"), "employee_id", {"t_clerk_email": "email", "t_clerk": "full_name"}, spread_by=("vendor_id",))

    maps = t["vendor_subsidiary_map"]
    maps = maps.where(E.live()) if live_rows else maps
    children = [_address_tab(t, live_rows), _relationships_tab(t, live_rows), _communications_tab(t, live_rows),
                ops.nest(maps, [c("vendor_id").alias("__vendor")], [c(x) for x in MAP_FIELDS], "map_tab")]
    for child in children:
        tab = child.columns[-1]
        v = v.join(child, v["vendor_id"] == child["__vendor"], "left").drop("__vendor")
        if not live_rows:
            v = v.withColumn(tab, F.coalesce(tab, F.array(_null_struct(child.schema[tab].dataType.elementType))))

    # Financials: one document per map row (J10: of vendors with a live currency).
    v = v.withColumn("f", F.explode_outer(F.when(c("ok_currency"), c("map_tab")) if live_rows else c("map_tab")))
    abs_of = lambda x: F.abs(x)
    clerk = [c("accounting_clerk_id"), c("t_clerk_email").alias("accounting_clerk_email"),
             c("t_clerk").alias("accounting_clerk_name")] if live_rows else []
    financials = F.struct(abs_of(c("f.balance")).alias("balance"), abs_of(c("f.unbilled_orders")).alias("unbilled_orders"), c("currency"), *clerk)
    flag, day, second = ((E.true_false_blank, E.fmt_day, E.fmt_ts) if live_rows else (lambda x: x,) * 3)
    purchasing = F.struct(
        flag(c("edi")).alias("edi"), day(c("edi_855_activation_date")).alias("edi_855_activation_date"),
        *[c(f"t_{x}").alias(x) for x in ("edi_850", "edi_860", "edi_855", "edi_856", "edi_810", "edi_846")],
        c("edi_capable"), c("creditlimit"), day(c("vendor_credit_limit_date")).alias("vendor_credit_limit_date"), c("currency"))
    approvals = F.array(F.struct(
        second(c("date_created")).alias("date_created"), c("t_creator").alias("created_by"),
        c("t_finance_status").alias("finance_status"), c("t_operations_status").alias("operations_status")))
    # ``ven_sub`` is joined on the primary subsidiary's id, so it repeats it.
    subsidiaries = F.sort_array(F.transform("map_tab", lambda m: F.struct(
        c("s_name").alias("primary_subsidiary"), c("s_name").alias("subsidiary"),
        E.flag(m["subsidiary_id"] == c("subsidiary")).alias("primary"), c("s_inactive").alias("isinactive"),
        abs_of(m["balance"]).alias("balance"), abs_of(m["balance_base"]).alias("balance_base"),
        abs_of(m["unbilled_orders"]).alias("unbilled_orders"), abs_of(m["unbilled_orders_base"]).alias("unbilled_orders_base"),
        m["credit_limit"].alias("credit_limit"), m["subsidiary_id"].alias("subsidiary_id"), c("currency").alias("currency"),
        c("s_tax").alias("tax_code"))))
    if live_rows:
        financials = F.when(c("ok_currency") & c("f").isNotNull(), financials)
        purchasing = F.when(c("ok_currency"), purchasing)
        approvals = F.when(c("ok_finance_status") & c("ok_operations_status"), approvals)
        subsidiaries = F.when(c("ok_currency") & c("ok_subsidiary"), subsidiaries)
    externalid, inactive = ([c("custom_vendor_externalid")], [c("isinactive")]) if live_rows else ([], [])
    return v.select(
        c("name"), c("companyname"), E.active_status(c("isinactive")).alias("status"),
        c("name").alias("vendor_id"), c("vendor_id").alias("internal_vendor_id"), *externalid,
        E.company_type(c("is_person")).alias("type"), c("vendor_category"), c("terms"), c("incoterm"),
        c("comments"), c("email"), c("email_address_for_payment_not"), c("accounting_email"), c("phone"),
        c("altphone"), c("fax"), c("url").alias("web_address"), c("billaddress").alias("address"), *inactive,
        c("address_tab"), purchasing.alias("purchasing_tab"), financials.alias("financials_tab"), c("relationships_tab"),
        c("communications_tab"), approvals.alias("approvals_tab"), subsidiaries.alias("subsidiaries_tab"),
    )


MAP_FIELDS = ["subsidiary_id", "balance", "balance_base", "unbilled_orders", "unbilled_orders_base", "credit_limit"]


def _null_struct(fields) -> F.Column:
    return F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def _address_tab(t, live_rows: bool) -> DataFrame:
    rows = t["address_book"].where(E.live()) if live_rows else t["address_book"]
    return ops.nest(rows, [c("entity_id").alias("__vendor")], [
        c("is_default_bill_address"), c("is_default_ship_address"), c("name").alias("label"), c("address"),
        c("is_inactive")], "address_tab")


def _relationships_tab(t, live_rows: bool) -> DataFrame:
    rows = t["contacts"].where(E.live()) if live_rows else t["contacts"]
    rows = ops.lookup(rows, t["contact_types"], c("contact_id"), "contact_id", {"t_type": "name"},
                      how="inner" if live_rows else "left", live_only=live_rows, spread_by=("company_id", "name", "email"))
    return ops.nest(rows, [c("company_id").alias("__vendor")], [
        c("name").alias("contact_name"), c("t_type").alias("category"), c("title").alias("job_title"), c("email"),
        c("phone"), c("contact_id")], "relationships_tab")


def _communications_tab(t, live_rows: bool) -> DataFrame:
    """Authors are employees in J06 and parties in J10; recipients are employees."""
    rows = t["message"].where(E.live()) if live_rows else t["message"]
    people, key = (t["entity"], "entity_id") if live_rows else (t["employees"], "employee_id")
    how = "inner" if live_rows else "left"
    rows = ops.lookup(rows, people, c("author_id"), key, {"t_author": "full_name"}, how=how, live_only=live_rows,
                      spread_by=MESSAGE_ID)
    rows = ops.lookup(rows, t["employees"], c("recipient_id"), "employee_id", {"t_recipient": "full_name"}, how=how,
                      live_only=live_rows, spread_by=MESSAGE_ID)
    body = [] if live_rows else [c("message")]
    # A vendor's messages are sorted run by run: their dates alone may all be equal.
    return ops.nest_runs(rows.withColumnRenamed("company_id", "__vendor"), ["__vendor"], [
        c("date_0").alias("date"), c("author_id"), c("t_author").alias("author"), c("recipient_id"),
        F.coalesce(c("t_recipient"), c("to_0")).alias("primary_recipient"), c("subject"), c("to_0"), c("from_0"),
        c("message_type_id"), *body], "communications_tab", by=6)
