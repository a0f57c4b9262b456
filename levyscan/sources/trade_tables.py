"""The seven procurement inputs, derived from a star schema of trade tables.

One purchase order is one order; its vendor and product come from its lines (the lowest
supplier and part key). Gaps, marks, date styles and faults follow from key arithmetic, so
that every rule meets both outcomes and the result is the same on every run.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyscan.functions.scalars import exact_sum, state_name


SCHEMAS = {
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


def read(spark: SparkSession, base: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{base}/{table}.parquet")


def _two_style_date(key: str, day: str) -> str:
    """Even keys dd/MM/yyyy, odd keys ISO."""
    return f"if({key} % 2 = 0, date_format({day}, 'dd/MM/yyyy'), cast({day} as string))"


def _padded(prefix: str, number: str, width: int) -> str:
    return f"concat('{prefix}', lpad({number}, greatest({width}, length({number})), '0'))"


def _gstin(nation: str, key: str) -> str:
    return (
        f"concat(lpad({nation} + 1, 2, '0'), 'ABCDE', lpad({key} % 10000, 4, '0'), 'F1', "
        f"if({key} % 17 = 0, 'X', 'Z'), {key} % 10)"
    )


def _with_state(df: DataFrame, nation: str) -> DataFrame:
    return df.withColumn("state", state_name(F.expr(f"lpad({nation} + 1, 2, '0')")))


def vendors(spark: SparkSession, base: str) -> DataFrame:
    def quarter(q: int) -> str:
        gap = "when s_suppkey % 31 = 0 then null " if q == 0 else ""
        return f"case {gap}when (s_suppkey + {3 * q}) % 5 < 3 then '✓' else '✗' end as filing_history_q{q + 1}"

    registered = "date_add(date '2012-01-01', cast((s_suppkey * 37) % 4000 as int))"
    return _with_state(read(spark, base, "supplier"), "s_nationkey").selectExpr(
        f"{_padded('V', 's_suppkey + 1', 5)} as vendor_id",
        f"{_gstin('s_nationkey', 's_suppkey')} as gstin",
        "s_name as trade_name",
        "concat('Legal ', s_name) as legal_name",
        "state as billing_state",
        f"{_two_style_date('s_suppkey', registered)} as registration_date",
        "if(s_suppkey % 20 = 7, 'Cancelled', 'Active') as status",
        "if(s_suppkey % 12 = 0, 'Yes', 'No') as composition_flag",
        *[quarter(q) for q in range(6)],
        "if(s_suppkey % 23 <> 0, concat('PANAA', lpad(s_suppkey % 90, 4, '0'), 'A'), null) as director_pan_1",
        "if(s_suppkey % 3 <> 0, concat('PANBB', lpad(s_suppkey % 70, 4, '0'), 'B'), null) as director_pan_2",
    )


def rates(spark: SparkSession, base: str) -> DataFrame:
    return (
        read(spark, base, "part")
        .select(F.col("p_type").alias("hsn_code"))
        .distinct()
        .selectExpr(
            "hsn_code",
            "concat(hsn_code, ' goods') as description",
            """case hsn_code when 'ECONOMY' then 5.0D when 'STANDARD' then 12.0D
               when 'PROMO' then 18.0D when 'SMALL' then 18.0D else 28.0D end as gst_rate""",
            "'No' as cess_applicable",
            "'2017-07-01' as effective_from",
        )
    )


def _lines_per_order(spark: SparkSession, base: str) -> DataFrame:
    """The supplier (s) and part (p) that stand for an order (k)."""
    lines = read(spark, base, "lineitem").groupBy(F.col("l_orderkey").alias("k"))
    return lines.agg(F.min("l_suppkey").alias("s"), F.min("l_partkey").alias("p"))


def _order_base(spark: SparkSession, base: str) -> DataFrame:
    """Orders with their buyer, product and supplier. All are left joins to unique keys, so
    adaptive execution may split the order side where a buyer or supplier is hot."""
    orders = read(spark, base, "orders").selectExpr(
        "o_orderkey as k", "o_custkey as c", "o_totalprice as price", "to_date(o_orderdate) as day"
    )
    buyers = read(spark, base, "customer").selectExpr("c_custkey as c", "c_nationkey as nation")
    kinds = read(spark, base, "part").selectExpr("p_partkey as p", "p_type", "p_name")
    names = read(spark, base, "supplier").selectExpr("s_suppkey as s", "s_name")
    return (
        orders.join(_lines_per_order(spark, base), "k", "left")
        .join(buyers, "c", "left")
        .join(kinds, "p", "left")
        .join(names, "s", "left")
    )


def purchase_orders(spark: SparkSession, base: str) -> DataFrame:
    half_rate = """case when p_type = 'ECONOMY' then 2.5D when p_type = 'STANDARD' then 6.0D
                   when p_type in ('PROMO', 'SMALL') then 9.0D when p_type is not null then 14.0D end"""
    rated = _with_state(_order_base(spark, base), "nation").selectExpr(
        "*",
        f"{half_rate} + if(k % 97 = 0, 5.0D, 0.0D) as cgst_rate",
        f"{half_rate} as sgst_rate",
        "if(k % 113 = 0, 18.0D, 0.0D) as igst_rate",
    )
    return rated.selectExpr(
        f"{_padded('PO', 'k + 1', 7)} as po_id",
        "date_format(day, 'dd/MM/yyyy') as po_date",
        f"if(s is not null, {_padded('V', 's + 1', 5)}, null) as vendor_id",
        f"{_gstin('nation', 'c')} as buyer_gstin",
        "if(k % 19 = 0, 'Karnataka', state) as buyer_state",
        "p_type as hsn_code",
        "p_name as product_desc",
        "cast(k % 50 + 1 as int) as quantity",
        "'NOS' as unit",
        "price as base_amount",
        "cgst_rate",
        "sgst_rate",
        "igst_rate",
        "price * cgst_rate / 100.0D as cgst_amt",
        "price * sgst_rate / 100.0D as sgst_amt",
        "price * igst_rate / 100.0D as igst_amt",
        "0.0D as cess_amt",
        "price * 1.18D as total_amount",
        "if(k % 11 <> 0, concat('EWB', k), null) as ewb_number",
        f"{_two_style_date('k', 'date_add(day, 1)')} as ewb_generated_date",
        "state as place_of_supply",
        "state as delivery_state",
        """case when k % 29 = 0 then null when k % 13 = 0 then 'XYZ TRADING COMPANY' when k % 17 = 5 then upper(s_name)
           when k % 19 = 7 then concat(s_name, ' Pvt Ltd') else s_name end as invoice_billing_name""",
        "s_name as po_vendor_name",
    )


def vendor_invoices(spark: SparkSession, base: str) -> DataFrame:
    """Nominally one per order: some orders have none, some have a differing second copy."""
    day = "date_add(to_date(o_orderdate), cast((7 * o_orderkey) % 45 as int))"
    return (
        read(spark, base, "orders")
        .filter("o_orderkey % 101 <> 0")
        .selectExpr("*", "explode(sequence(0, if(o_orderkey % 150 = 7, 1, 0))) as copy")
        .selectExpr(
            f"{_padded('PO', 'o_orderkey + 1', 7)} as po_id",
            f"{_two_style_date('o_orderkey', day)} as invoice_date",
            f"if(o_orderkey % 40 = 1, 'INVDUP', {_padded('INV', 'o_orderkey + 1', 8)}) as invoice_number",
            "o_totalprice * 0.18D as gstr2b_itc_available",
            "o_totalprice * if(o_orderkey % 200 = 0, 0.27D, 0.18D) * (copy + 1) as itc_claimed_by_buyer",
        )
    )


def blacklist(spark: SparkSession, base: str) -> DataFrame:
    """Some registrations are listed twice."""
    return (
        read(spark, base, "supplier")
        .filter("(s_suppkey + 1) % 20 = 4")
        .selectExpr("*", "explode(sequence(0, if((s_suppkey + 1) % 40 = 4, 1, 0))) as copy")
        .selectExpr(
            f"{_gstin('s_nationkey', 's_suppkey')} as gstin",
            "date_add(date '2023-04-01', copy) as blacklist_date",
            "'Fake GST Registration' as reason",
            "concat('CBIC-', s_suppkey) as case_reference",
        )
    )


def ground_truth(spark: SparkSession, base: str) -> DataFrame:
    return (
        read(spark, base, "orders")
        .filter("o_orderkey % 37 <> 0")
        .selectExpr(
            f"{_padded('PO', 'o_orderkey + 1', 7)} as po_id",
            """case o_orderkey % 50 when 0 then 'GST-001' when 1 then 'TAX-001' when 2 then 'FRD-006'
               else 'CLEAN' end as anomaly_code""",
        )
        .selectExpr(
            "po_id",
            "anomaly_code",
            "if(anomaly_code = 'CLEAN', 0, 1) as is_anomalous",
            "if(anomaly_code = 'CLEAN', 'Low', 'High') as severity",
        )
    )


def spend_history(spark: SparkSession, base: str) -> DataFrame:
    """Mean order value and order count per vendor and month, as older systems delivered it.
    Vendors whose key divides by nine have none."""
    orders = read(spark, base, "orders").selectExpr(
        "o_orderkey as k", "date_format(o_orderdate, 'yyyy-MM') as year_month", "o_totalprice * 1.18D as amount"
    )
    return (
        orders.join(_lines_per_order(spark, base).select("k", "s"), "k")
        .filter("s % 9 <> 0")
        .groupBy("s", "year_month")
        .agg((exact_sum(F.col("amount")) / F.count("*")).alias("total_po_value"), F.count("*").alias("po_count"))
        .selectExpr(f"{_padded('V', 's + 1', 5)} as vendor_id", "year_month", "total_po_value", "po_count")
    )
