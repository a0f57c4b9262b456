"""Raw tables to typed bronze tables."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyscan.constants import FILING_QUARTERS
from levyscan.functions.scalars import mark_to_flag, parse_date
from levyscan.operators.projection import fill_vendor_gaps, require_keys, with_audit_timestamp


@dataclass
class Layer:
    """The seven inputs of the wide order table."""

    purchase_orders: DataFrame
    vendors: DataFrame
    vendor_invoices: DataFrame
    hsn_rate_schedule: DataFrame
    cbic_blacklist: DataFrame
    historical_po_values: DataFrame
    ground_truth: DataFrame


def bronze_purchase_orders(orders: DataFrame, as_of: str | None = None) -> DataFrame:
    day = F.col("po_date")
    dated = require_keys(orders, "po_id", "vendor_id").withColumn("po_date", parse_date(day))
    parts = dated.withColumns({"year": F.year(day), "month": F.month(day)})
    return with_audit_timestamp(parts, "ingestion_timestamp", as_of)


def marks_to_flags(vendors: DataFrame) -> DataFrame:
    """Tick marks to numbers; a column that is numeric already stays as it is."""
    kinds = dict(vendors.dtypes)
    columns = [c for c in ["composition_flag", *FILING_QUARTERS] if kinds[c] == "string"]
    return vendors.withColumns({c: mark_to_flag(F.col(c)) for c in columns})


def bronze_vendors(vendors: DataFrame, as_of: str | None = None) -> DataFrame:
    return fill_vendor_gaps(with_audit_timestamp(marks_to_flags(vendors), "ingestion_timestamp", as_of))


def build_bronze(raw: Layer, as_of: str | None = None) -> Layer:
    return Layer(
        purchase_orders=bronze_purchase_orders(raw.purchase_orders, as_of),
        vendors=bronze_vendors(raw.vendors, as_of),
        vendor_invoices=raw.vendor_invoices,
        hsn_rate_schedule=raw.hsn_rate_schedule,
        cbic_blacklist=raw.cbic_blacklist,
        historical_po_values=raw.historical_po_values,
        ground_truth=raw.ground_truth,
    )
