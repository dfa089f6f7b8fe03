"""Order packets: the given order tables seen as capture trees.

One packet per order with the layers geninfo, order, note (always empty) and
line. The line layer arrives as one piece per line item, so an order with any
number of items is never gathered into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.numbering import number_small
from ..operators.trees import node_type
from ..session import portioned, portions_of

LEAF, BRANCH, LAYER = node_type(0), node_type(1), node_type(2)
SHIFT = 8  # positions reserved per line item
GENINFO, ORDER, NOTE, LINE = 0, 1, 2, 3

# Fixed dictionary of the order packets: short name, type tag, display base.
FIELDS = [
    ("num", "FT_UINT32", "BASE_DEC"), ("len", "FT_UINT32", "BASE_DEC"),
    ("timestamp", "FT_ABSOLUTE_TIME", "BASE_NONE"),
    ("order.key", "FT_UINT32", "BASE_DEC"), ("order.status", "FT_STRING", "BASE_NONE"),
    ("order.total", "FT_DOUBLE", "BASE_NONE"), ("order.date", "FT_ABSOLUTE_TIME", "BASE_NONE"),
    ("customer.key", "FT_UINT32", "BASE_DEC"), ("customer.name", "FT_STRING", "BASE_NONE"),
    ("customer.segment", "FT_STRING", "BASE_NONE"), ("line.part", "FT_UINT32", "BASE_DEC"),
    ("line.item", "FT_UINT8", "BASE_DEC"), ("line.quantity", "FT_DOUBLE", "BASE_NONE"),
    ("line.price", "FT_DOUBLE", "BASE_NONE"), ("line.open", "FT_BOOLEAN", "BASE_NONE"),
    ("line.size", "FT_UINT16", "BASE_HEX"), ("line.discount", "FT_DOUBLE", "BASE_NONE"),
]
LABELS = [  # field, kind, lo, hi, label, false_label
    ("line.item", "V", 1, 1, "first", None), ("line.item", "R", 2, 4, "middle", None),
    ("line.item", "R", 3, 7, "late", None), ("line.open", "T", None, None, "open", "closed"),
]
PREFIX_RULES = [("prefix", "order", "Priority", "order.priority")]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def capture_time(c: Column) -> Column:
    return F.concat(F.date_format(c, "MMM d, yyyy HH:mm:ss.SSSSSS"), F.lit("000"))


def source_path(order_date: Column) -> Column:
    return F.concat(F.lit("/captures/"), F.year(order_date).cast("string"), F.lit(".xml"))


def leaf(kind, name: str | None, show: Column, fields: int = 0) -> Column:
    """Leaf node of the given struct type."""
    parts = {"_name": F.lit(name), "_show": show}
    values = [parts.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.fields]
    return F.struct(*values)


def branch(kind, name: str | None, show: Column | None, children: Column) -> Column:
    parts = {"_name": F.lit(name), "_show": F.lit(None) if show is None else show}
    values = [(children if f.name == "field" else parts.get(f.name, F.lit(None)).cast(f.dataType)).alias(f.name)
              for f in kind.fields]
    return F.struct(*values)


def no_children(kind) -> Column:
    return F.array().cast(kind["field"].dataType)


def header_layers(orders: DataFrame) -> Column:
    """geninfo, order, note and line layers of an order row joined to its customer."""
    text = lambda c: F.col(c).cast("string")
    kid = lambda name, show: leaf(BRANCH, name, show)
    geninfo = F.array(kid("num", text("o_orderkey")), kid("timestamp", capture_time(F.col("o_orderdate"))),
                      kid("len", F.floor("o_totalprice").cast("bigint").cast("string")))
    customer = branch(BRANCH, "order.customer", None, F.array(
        leaf(LEAF, "customer.key", text("o_custkey")), leaf(LEAF, "customer.name", F.col("c_name")),
        leaf(LEAF, "customer.segment", F.col("c_mktsegment"))))
    order = F.array(kid("order.key", text("o_orderkey")), kid("order.status", F.col("o_orderstatus")),
                    kid("order.total", text("o_totalprice")), kid("order.date", capture_time(F.col("o_orderdate"))),
                    kid(None, F.concat(F.lit("Priority: "), "o_orderpriority")), customer)
    layer = lambda name, kids: branch(LAYER, name, None, kids)
    return F.array(layer("geninfo", geninfo), layer("order", order), layer("note", no_children(LAYER)),
                   layer("line", no_children(LAYER)))


def line_layer() -> Column:
    """Slice of the line layer made by one line item."""
    text = lambda c: F.col(c).cast("string")
    kid = lambda name, show: leaf(BRANCH, name, show)
    size = F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(F.col("l_quantity").cast("bigint"))), 4, "0"))
    item = branch(BRANCH, "line.item", text("l_linenumber"), F.array(
        leaf(LEAF, "line.quantity", text("l_quantity")), leaf(LEAF, "line.price", text("l_extendedprice")),
        leaf(LEAF, "line.open", F.when(F.col("l_linestatus") == "O", F.lit("1")).otherwise(F.lit("0"))),
        leaf(LEAF, "line.size", size)))
    group = branch(BRANCH, None, None, F.array(leaf(LEAF, "line.discount", text("l_discount"))))
    always = F.array(kid("line.part", text("l_partkey")), item, kid(None, F.col("l_returnflag")))
    fields = F.when(F.col("l_discount") > 0.05, F.concat(always, F.array(group))).otherwise(always)
    return branch(LAYER, "line", None, fields)


LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]


def order_pieces(spark: SparkSession, sf_dir: str, together: bool = False) -> DataFrame:
    """Pieces of all order packets (contract in ``operators.trees``).

    With ``together`` both parts are dealt out by order in the same number of portions, so their union is as well: rows of a packet
    are told apart where its pieces are, without a shuffle.
    """
    portions = portions_of(read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")) if together else None
    return header_pieces(spark, sf_dir, portions).unionByName(line_pieces(spark, sf_dir, portions))


def header_pieces(spark: SparkSession, sf_dir: str, portions: int | None = None) -> DataFrame:
    orders, customer = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    joined = portioned(orders.join(customer.select("c_custkey", "c_name", "c_mktsegment"),
                                   orders.o_custkey == F.col("c_custkey"), "left"), "o_orderkey", like=orders, portions=portions)
    return joined.select(*_carried(), F.posexplode(header_layers(joined)).alias("proto_idx", "proto")).select(
        "src", "packet_no", "number", "ts", "gen_idx", "proto_idx", F.lit(None).cast("bigint").alias("shift"), "proto")


def line_pieces(spark: SparkSession, sf_dir: str, portions: int | None = None) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    ranked = number_small(lines.withColumn("_parts", F.floor(F.col("l_partkey") / 256)), "_rank", ["l_orderkey"],
                          ["l_linenumber", "_parts"], LINE_ORDER, portions)
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return ranked.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *_carried(), F.lit(LINE).alias("proto_idx"), ((F.col("_rank") - 1) * SHIFT).alias("shift"),
        line_layer().alias("proto"))


def _carried() -> list[Column]:
    # Only one column is the order key itself: with two of them a union does not know how its parts are dealt out.
    number = F.when(F.col("o_orderkey").isNotNull(), F.col("o_orderkey"))
    return [source_path(F.col("o_orderdate")).alias("src"), F.col("o_orderkey").alias("packet_no"),
            number.alias("number"), F.col("o_orderdate").cast("timestamp_ntz").alias("ts"),
            F.lit(GENINFO).alias("gen_idx")]


def fields(spark: SparkSession) -> DataFrame:
    from ..functions.values import class_of_tag

    return inline_relation(spark, FIELDS, ["short_name", "tag", "base"]).select(
        "short_name", class_of_tag(F.col("tag")).alias("cls"), "base")


def labels(spark: SparkSession) -> DataFrame:
    rows = [(*row, i) for i, row in enumerate(LABELS)]
    return inline_relation(spark, rows, ["field", "kind", "lo", "hi", "label", "false_label", "ordinal"]).select(
        "field", "kind", F.col("lo").cast("bigint"), F.col("hi").cast("bigint"), "label",
        F.col("false_label").cast("string"), F.col("ordinal").cast("bigint"))


def inline_relation(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """Literal relation: Catalyst knows its exact size, so it joins by broadcast only while small."""
    from .rules import literal_rows

    return literal_rows(spark, rows, names)
