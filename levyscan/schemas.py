"""Declared schemas: raw CSV headers, their standard names and types, and derived tables."""

from pyspark.sql.types import StringType, StructField, StructType

# Raw header -> (standard name, type). The order is the physical column order of the file.
VENDOR_FIELDS = [
    ("Vendor ID", "vendor_id", "string"),
    ("GSTIN", "gstin", "string"),
    ("Trade Name", "trade_name", "string"),
    ("Legal Name", "legal_name", "string"),
    ("Billing State", "billing_state", "string"),
    ("Reg Date", "registration_date", "string"),
    ("Status", "status", "string"),
    ("Composition?", "composition_flag", "string"),
    ("Q1", "filing_history_q1", "string"),
    ("Q2", "filing_history_q2", "string"),
    ("Q3", "filing_history_q3", "string"),
    ("Q4", "filing_history_q4", "string"),
    ("Q5", "filing_history_q5", "string"),
    ("Q6", "filing_history_q6", "string"),
    ("Director PAN 1", "director_pan_1", "string"),
    ("Director PAN 2", "director_pan_2", "string"),
]

ORDER_FIELDS = [
    ("PO ID", "po_id", "string"),
    ("PO Date", "po_date", "string"),
    ("Vendor ID", "vendor_id", "string"),
    ("Buyer GSTIN", "buyer_gstin", "string"),
    ("Buyer State", "buyer_state", "string"),
    ("HSN Code", "hsn_code", "string"),
    ("Product", "product_desc", "string"),
    ("Qty", "quantity", "int"),
    ("Unit", "unit", "string"),
    ("Base Amt (₹)", "base_amount", "double"),
    ("CGST%", "cgst_rate", "double"),
    ("SGST%", "sgst_rate", "double"),
    ("IGST%", "igst_rate", "double"),
    ("CGST Amt", "cgst_amt", "double"),
    ("SGST Amt", "sgst_amt", "double"),
    ("IGST Amt", "igst_amt", "double"),
    ("Cess", "cess_amt", "double"),
    ("Total Inv (₹)", "total_amount", "double"),
    ("EWB No.", "ewb_number", "string"),
    ("EWB Date", "ewb_generated_date", "string"),
    ("Place of Supply", "place_of_supply", "string"),
    ("Delivery State", "delivery_state", "string"),
    ("Billing Name", "invoice_billing_name", "string"),
    ("Trade Name", "po_vendor_name", "string"),
]

RATE_FIELDS = [
    ("HSN Code", "hsn_code", "string"),
    ("Product Description", "description", "string"),
    ("GST Rate %", "gst_rate", "double"),
    ("Cess?", "cess_applicable", "string"),
    ("Effective From", "effective_from", "string"),
]

INVOICE_FIELDS = [
    ("PO ID", "po_id", "string"),
    ("Inv Date", "invoice_date", "string"),
    ("Invoice No.", "invoice_number", "string"),
    ("GSTR2B ITC (₹)", "gstr2b_itc_available", "double"),
    ("ITC Claimed (₹)", "itc_claimed_by_buyer", "double"),
]

BLACKLIST_FIELDS = [
    ("Blacklisted GSTIN", "gstin", "string"),
    ("Blacklist Date", "blacklist_date", "string"),
    ("Reason", "reason", "string"),
    ("Case Reference", "case_reference", "string"),
]

HISTORY_FIELDS = [
    ("Vendor ID", "vendor_id", "string"),
    ("Year-Month", "year_month", "string"),
    ("Total PO Value", "total_po_value", "double"),
    ("PO Count", "po_count", "bigint"),
]

LABEL_FIELDS = [
    ("PO ID", "po_id", "string"),
    ("Anomaly Code", "anomaly_code", "string"),
    ("Is Anomalous", "is_anomalous", "int"),
    ("Severity", "severity", "string"),
]

#: The seven inputs by name.
INPUT_FIELDS = {
    "purchase_orders": ORDER_FIELDS,
    "vendors": VENDOR_FIELDS,
    "vendor_invoices": INVOICE_FIELDS,
    "hsn_rate_schedule": RATE_FIELDS,
    "cbic_blacklist": BLACKLIST_FIELDS,
    "historical_po_values": HISTORY_FIELDS,
    "ground_truth": LABEL_FIELDS,
}

# The numeric columns that the wide order table relies on.
ORDER_NUMBERS = {name: kind for _, name, kind in ORDER_FIELDS if kind != "string"}


def raw_schema(fields: list[tuple[str, str, str]]) -> StructType:
    """All-text schema under the raw headers, as a CSV file carries it."""
    return StructType([StructField(header, StringType()) for header, _, _ in fields])
