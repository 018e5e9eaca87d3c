"""Declared schemas of the landing feed and the silver tables, and the quality rules on facts."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------------------------
# Field names and types of the landing feed. Money is DOUBLE throughout.
ADDRESS_FIELDS = ("street", "city", "state", "postal_code", "country")


def struct_ddl(fields: dict[str, str]) -> str:
    return "STRUCT<" + ", ".join(f"{name}: {kind}" for name, kind in fields.items()) + ">"


_ADDRESS = struct_ddl({name: "STRING" for name in ADDRESS_FIELDS})

_LINES = "ARRAY<" + struct_ddl({
    "line_id": "STRING", "product_id": "STRING", "ordered_qty_packs": "INT",
    "confirmed_qty_packs": "INT", "unit_price": "DOUBLE", "line_amount": "DOUBLE",
    "backorder_flag": "BOOLEAN"}) + ">"

LANDING_ENTITIES = {
    "manufacturers": {
        "manufacturer_id": "STRING", "manufacturer_name": "STRING", "country": "STRING",
        "gmp_certified": "BOOLEAN", "created_at": "STRING"},
    "products": {
        "product_id": "STRING", "manufacturer_id": "STRING", "product_name": "STRING",
        "molecule": "STRING", "therapeutic_area": "STRING", "dosage_form": "STRING",
        "strength": "STRING", "pack_size": "INT", "cold_chain_required": "BOOLEAN",
        "list_price": "DOUBLE"},
    "distribution_centers": {
        "dc_id": "STRING", "dc_name": "STRING", "region": "STRING", "address": _ADDRESS,
        "temperature_zones": "ARRAY<STRING>"},
    "customers": {
        "customer_id": "STRING", "customer_name": "STRING", "customer_type": "STRING",
        "region": "STRING", "credit_limit": "DOUBLE", "is_340b_eligible": "BOOLEAN",
        "address": _ADDRESS},
    "sales_orders": {
        "order_id": "STRING", "order_date": "STRING", "dc_id": "STRING", "customer_id": "STRING",
        "order_status": "STRING", "payment_terms": "STRING", "incoterm": "STRING",
        "currency": "STRING", "order_total_amount": "DOUBLE", "lines": _LINES},
    "inventory_snapshots": {
        "snapshot_id": "STRING", "snapshot_ts": "STRING", "dc_id": "STRING",
        "product_id": "STRING", "on_hand_packs": "INT", "reserved_packs": "INT",
        "in_transit_packs": "INT"},
    "shipments": {
        "shipment_id": "STRING", "order_id": "STRING", "dc_id": "STRING", "customer_id": "STRING",
        "ship_date": "STRING", "delivery_date": "STRING", "shipment_status": "STRING",
        "carrier_name": "STRING", "tracking_number": "STRING"},
    "returns": {
        "return_id": "STRING", "original_order_id": "STRING", "customer_id": "STRING",
        "product_id": "STRING", "return_date": "STRING", "reason_code": "STRING",
        "returned_qty_packs": "INT", "credit_amount": "DOUBLE"},
}
# ---------------------------------------------------------------------------------------------



@dataclass(frozen=True)
class Table:
    """Declared columns of a stored table, in order."""

    columns: dict[str, str]

    @property
    def names(self) -> list[str]:
        return list(self.columns)

    @property
    def ddl(self) -> str:
        return ", ".join(f"{name} {kind}" for name, kind in self.columns.items())


_INGEST = {"_ingested_at": "TIMESTAMP", "_ingest_date": "DATE", "_source_file": "STRING"}
_LINEAGE = {"bronze_record_key": "STRING", **_INGEST}
LINEAGE = tuple(_LINEAGE)

# Where a record stood among those that arrived at one moment: file, document in it, row in that.
ARRIVAL = ("_file_time", "_source_file", "_document", "_position")


def payload_ddl(*entities: str) -> str:
    """DDL type of a document's payload holding the given entity arrays (all by default)."""
    names = entities or tuple(LANDING_ENTITIES)
    return struct_ddl({n: f"ARRAY<{struct_ddl(LANDING_ENTITIES[n])}>" for n in names})


def document_ddl(*entities: str) -> str:
    """Schema of a landing document, with and without the ``{key, value}`` envelope."""
    names = entities or tuple(LANDING_ENTITIES)
    flat = ", ".join(f"{n} ARRAY<{struct_ddl(LANDING_ENTITIES[n])}>" for n in names)
    return f"key STRING, value {payload_ddl(*names)}, {flat}"


BRONZE = Table({"key": "STRING", "value": payload_ddl(), **_INGEST, "_file_time": "TIMESTAMP",
                "_document": "INT", "_rescued_data": "STRING"})

# Column names, types and order of the order staging table and the silver facts.
ORDERS_RAW = Table({
    "order_id": "STRING", "order_date": "TIMESTAMP", "dc_id": "STRING", "customer_id": "STRING",
    "order_status": "STRING", "payment_terms": "STRING", "incoterm": "STRING",
    "currency": "STRING", "order_total_amount": "DOUBLE", "lines": _LINES,
    **_LINEAGE})

FACTS = {
    "fct_sales_orders": Table({
        "order_id": "STRING", "order_date": "TIMESTAMP", "date_key": "INT", "dc_id": "STRING",
        "customer_id": "STRING", "order_status": "STRING", "payment_terms": "STRING",
        "incoterm": "STRING", "currency": "STRING", "order_total_amount": "DOUBLE", **_LINEAGE}),
    "fct_sales_order_lines": Table({
        "order_id": "STRING", "line_id": "STRING", "date_key": "INT", "product_id": "STRING",
        "ordered_qty_packs": "INT", "confirmed_qty_packs": "INT", "unit_price": "DOUBLE",
        "line_amount": "DOUBLE", "backorder_flag": "BOOLEAN", **_LINEAGE}),
    "fct_inventory_snapshots": Table({
        "snapshot_id": "STRING", "snapshot_ts": "TIMESTAMP", "date_key": "INT", "dc_id": "STRING",
        "product_id": "STRING", "on_hand_packs": "INT", "reserved_packs": "INT",
        "in_transit_packs": "INT", **_LINEAGE}),
    "fct_shipments": Table({
        "shipment_id": "STRING", "order_id": "STRING", "dc_id": "STRING", "customer_id": "STRING",
        "ship_date": "TIMESTAMP", "ship_date_key": "INT", "delivery_date": "TIMESTAMP",
        "shipment_status": "STRING", "carrier_name": "STRING", "tracking_number": "STRING",
        **_LINEAGE}),
    "fct_returns": Table({
        "return_id": "STRING", "original_order_id": "STRING", "customer_id": "STRING",
        "product_id": "STRING", "return_date": "TIMESTAMP", "date_key": "INT",
        "reason_code": "STRING", "returned_qty_packs": "INT", "credit_amount": "DOUBLE",
        **_LINEAGE}),
}

# Names and predicates of the expectations. Order lines accept an empty line_id.
FACT_RULES = {
    "fct_sales_orders": {"valid_order_id_not_null": "order_id IS NOT NULL",
                         "valid_order_id_not_empty": "order_id <> ''"},
    "fct_sales_order_lines": {"valid_order_id_not_null": "order_id IS NOT NULL",
                              "valid_line_id_not_null": "line_id IS NOT NULL"},
    "fct_inventory_snapshots": {"valid_snapshot_id_not_null": "snapshot_id IS NOT NULL",
                                "valid_snapshot_id_not_empty": "snapshot_id <> ''"},
    "fct_shipments": {"valid_shipment_id_not_null": "shipment_id IS NOT NULL",
                      "valid_shipment_id_not_empty": "shipment_id <> ''"},
    "fct_returns": {"valid_return_id_not_null": "return_id IS NOT NULL",
                    "valid_return_id_not_empty": "return_id <> ''"},
}

FACT_KEYS = {
    "fct_sales_orders": ("order_id",),
    "fct_sales_order_lines": ("order_id", "line_id"),
    "fct_inventory_snapshots": ("snapshot_id",),
    "fct_shipments": ("shipment_id",),
    "fct_returns": ("return_id",),
}


@dataclass(frozen=True)
class Dimension:
    """How one landing entity becomes a type-2 dimension."""

    entity: str
    history: str
    key: str
    columns: tuple[str, ...]
    required: tuple[str, ...] = ()
    trimmed: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()

    @property
    def current(self) -> str:
        return self.history.removesuffix("_hist") + "_current"


_ADDRESS_COLUMNS = tuple(f"address_{name}" for name in ADDRESS_FIELDS)

# Table names, keys and column order of the dimensions.
DIMENSIONS = {
    "customers": Dimension(
        "customers", "dim_customers_hist", "customer_id",
        ("customer_id", "customer_name", "customer_type", "region", "credit_limit",
         "is_340b_eligible", *_ADDRESS_COLUMNS),
        required=("customer_id",), trimmed=("customer_id", "customer_name")),
    "products": Dimension(
        "products", "dim_products", "product_id",
        ("product_id", "manufacturer_id", "product_name", "molecule", "therapeutic_area",
         "dosage_form", "strength", "pack_size", "cold_chain_required", "list_price"),
        required=("product_id", "manufacturer_id"),
        trimmed=("product_id", "manufacturer_id", "product_name")),
    "manufacturers": Dimension(
        "manufacturers", "dim_manufacturers", "manufacturer_id",
        ("manufacturer_id", "manufacturer_name", "country", "gmp_certified", "created_at"),
        required=("manufacturer_id",), trimmed=("manufacturer_id", "manufacturer_name"),
        timestamps=("created_at",)),
    "distribution_centers": Dimension(
        "distribution_centers", "dim_distribution_centers", "dc_id",
        ("dc_id", "dc_name", "region", *_ADDRESS_COLUMNS, "temperature_zones"),
        required=("dc_id",), trimmed=("dc_id", "dc_name")),
}


@dataclass(frozen=True)
class Fact:
    """How one landing entity becomes a silver fact."""

    table: str
    entity: str
    key: str
    timestamps: tuple[str, ...]
    date_keys: dict[str, str] = field(default_factory=dict)


FLAT_FACTS = {
    "fct_inventory_snapshots": Fact("fct_inventory_snapshots", "inventory_snapshots", "snapshot_id",
                                    ("snapshot_ts",), {"date_key": "snapshot_ts"}),
    "fct_shipments": Fact("fct_shipments", "shipments", "shipment_id",
                          ("ship_date", "delivery_date"), {"ship_date_key": "ship_date"}),
    "fct_returns": Fact("fct_returns", "returns", "return_id",
                        ("return_date",), {"date_key": "return_date"}),
}
