"""Tree explode: nested trees to a flat node table.

A packet may arrive whole or in pieces (``pieces`` contract below); nothing is
gathered per packet. All levels run in one narrow stage: each step explodes
the children of the rows made by the step before and lets finished rows pass,
carrying the context downwards, so there is no self-join and no re-read.

pieces: src string, packet_no bigint, number bigint, ts timestamp_ntz,
        gen_idx int (layer that carries the lineage, null if none),
        proto_idx int, shift bigint (null: whole layer; else: a slice of the
        layer's fields whose positions start at ``shift``), proto struct NODE
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import naming as N
from ..session import stage
from .rename import RenameRules, rename_nodes

CARRIED = ["src", "packet_no", "number", "ts", "gen_idx"]
ATTRIBUTES = ["_name", "_showname", "_show", "_value", "_size", "_pos", "_hide"]
OWN_TEXT = ["type", "name", "show", "showname", "value", "size", "pos", "hide", "local", "table", "reject"]
ANY = "xs_any"  # the reader's column for any other element
LEVELS = 10  # levels that are exploded in one stage
XML_OPTIONS = {"wildcardColName": ANY, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "ignoreSurroundingSpaces": "false"}
LEAF_NAMELESS, BRANCH_NAMELESS, BRANCH_NAMED = 0, 1, 2


def node_type(depth: int, residual: bool = False) -> T.StructType:
    """NODE struct with ``depth`` field levels; with ``residual`` the last one shows whether elements lie below it."""
    fields = [T.StructField(a, T.StringType()) for a in ATTRIBUTES]
    if depth > 0:
        fields.append(T.StructField("field", T.ArrayType(node_type(depth - 1, residual))))
    elif residual:
        fields.append(T.StructField(ANY, T.ArrayType(T.StringType())))
    return T.StructType(fields)


def pieces_of(packets: DataFrame) -> DataFrame:
    """Whole packets (``proto array<NODE>``) to one piece per layer."""
    return packets.select(
        *CARRIED, F.posexplode("proto").alias("proto_idx", "proto")
    ).select(*CARRIED, "proto_idx", F.lit(None).cast("bigint").alias("shift"), "proto")


def _attribute(schema: T.StructType, holder: str, name: str) -> Column:
    return F.col(f"{holder}.{name}") if name in schema.names else F.lit(None).cast("string")


def _bad_number(c: Column) -> Column:
    return c.isNotNull() & c.try_cast("int").isNull()


def _bad(schema: T.StructType, get) -> Column:
    checks = [_bad_number(get(a)) for a in ("_size", "_pos") if a in schema.names]
    out = F.lit(False)
    for check in checks:
        out = out | check
    return out


def _children(schema: T.StructType, node: Column) -> tuple[Column | None, T.StructType | None]:
    """Child array of ``node`` and its element type."""
    if "field" not in schema.names:
        return None, None
    return node["field"], schema["field"].dataType.elementType


def deeper_than_read(node: Column, schema: T.StructType) -> Column:
    """Does a tree go on below the levels that the read schema names?"""
    kids, element = _children(schema, node)
    if kids is None:
        return F.coalesce(F.size(node[ANY]) > 0, F.lit(False)) if ANY in schema.names else F.lit(False)
    return F.coalesce(F.exists(kids, lambda x: deeper_than_read(x, element)), F.lit(False))


def levels_of(node: Column, schema: T.StructType) -> Column:
    """Number of field levels that a tree has below ``node``, of those that its schema names."""
    kids, element = _children(schema, node)
    if kids is None:
        return F.lit(0)
    return F.when(F.size(kids) > 0, F.array_max(F.transform(kids, lambda x: levels_of(x, element))) + 1).otherwise(F.lit(0))


def explode_nodes(pieces: DataFrame | list[DataFrame], rules: RenameRules | None = None, within: str | None = None) -> DataFrame:
    """One row per node of every tree, renamed and named; ``pieces`` may be several frames of different depth.

    With ``within`` nodes of other tables than that one (escaped name) and those below its rows are left behind at their level;
    the column ``inside`` tells those of the last level apart.

    Rejected nodes come back as rows with ``reject`` set and without subtree. Up to LEVELS levels are exploded
    in one narrow stage. Deeper trees go on from there: the nodes made so far are written, and only the children of the last
    level are exploded further. So every node is written once and carried through at most LEVELS levels, however deep
    its tree.
    """
    frames = [pieces] if isinstance(pieces, DataFrame) else pieces
    out = [part for frame in frames for part in _explode(frame, rules, within)]
    return reduce(DataFrame.unionByName, out)


def _explode(pieces: DataFrame, rules: RenameRules | None, within: str | None) -> list[DataFrame]:
    schema = pieces.schema["proto"].dataType
    text = F.lit(None).cast("string")
    df = pieces.select(
        *CARRIED, F.col("proto_idx").cast("bigint").alias("proto_idx"), "shift",
        F.lit(True).alias("fresh"), F.col("proto").alias("k"),
        F.array(F.col("proto_idx").cast("bigint")).alias("path"),
        text.alias("p_name"), text.alias("p_local"), text.alias("prefix"),
        F.array().cast("array<string>").alias("anc"),
        F.array().cast("array<bigint>").alias("p_order"),
        F.col("proto._name").alias("protocol"),
        *[text.alias(c) for c in OWN_TEXT],
        F.lit(None).cast("boolean").alias("branch"),
        F.array().cast("array<bigint>").alias("order_path"),
        F.lit(within is None).alias("inside"),
    )
    done, level = [], 0
    while True:
        df, schema = _finish_level(df, schema, level, rules, within)
        if schema is not None and level % LEVELS == LEVELS - 1:
            df = stage(df, f"nodes-{level}")
            done.append(df)
            df = _descend(df.where(F.size("kids") > 0), level, keep=False)
        elif schema is not None:
            df = _descend(df, level)
        else:
            break
        level += 1
    dropped = ["kids", "fresh", "shift", "p_order", *(["inside"] if within is None else [])]
    return [part.drop(*dropped) for part in [*done, df]]


def _survivors(kids: Column, schema: T.StructType) -> Column:
    """Number of children that are no rejects. Most name no size or position at all: they are not looked at one by one."""
    looked_at = [F.array_min(kids[a]).isNotNull() for a in ("_size", "_pos") if a in schema.names]
    if not looked_at:
        return F.size(kids)
    return F.when(reduce(Column.__or__, looked_at), F.size(F.filter(kids, lambda x: ~_bad(schema, lambda a: x[a])))).otherwise(F.size(kids))


def _finish_level(df: DataFrame, schema: T.StructType, level: int, rules: RenameRules | None, within: str | None):
    """Rename and name the rows made last, and expose their children as ``kids``."""
    kids, child_schema = _children(schema, F.col("k"))
    fresh = F.col("fresh")
    if kids is None:
        survivors = F.lit(0)
    else:
        survivors = F.coalesce(_survivors(kids, child_schema), F.lit(0))
    bad = _bad(schema, lambda a: F.col("k")[a])
    df = df.select(
        "*",
        *[F.when(fresh, _attribute(schema, "k", f"_{a}")).alias(f"n_{a}")
          for a in ("name", "show", "showname", "value")],
        F.when(fresh, F.when(bad, F.lit("bad size or position"))).alias("n_reject"),
        F.when(fresh, (survivors > 0) | F.lit(level == 0)).alias("n_branch"),
        *([] if kids is None else [F.when(fresh & ~bad, kids).alias("kids")]),
    )
    if rules is not None:
        df = rename_nodes(df, rules, level == 0)
    new = lambda own, value: F.when(fresh, value).otherwise(F.col(own)).alias(own)
    nameless = N.is_blank(F.col("n_name"))
    local = F.when(nameless, N.group_name(F.col("p_local"))).otherwise(N.normalise(F.col("n_name")))
    own_class = (F.when(F.col("n_branch"), F.when(nameless, F.lit(BRANCH_NAMELESS)).otherwise(F.lit(BRANCH_NAMED)))
                 .otherwise(F.lit(LEAF_NAMELESS)))
    position = F.col("path")[F.size("path") - 1]
    order_path = (F.array(position) if level == 0
                  else F.concat(F.col("p_order"), F.array(own_class.cast("bigint"), position)))
    keep = [c for c in df.columns if not c.startswith("n_") and c not in OWN_TEXT
            and c not in ("branch", "order_path", "k")]
    df = df.select(
        *keep,
        new("type", F.lit("proto" if level == 0 else "field")),
        *[new(a, F.col(f"n_{a}")) for a in ("name", "show", "showname", "value")],
        *[new(a, _attribute(schema, "k", f"_{a}")) for a in ("size", "pos", "hide")],
        new("reject", F.col("n_reject")),
        new("branch", F.col("n_branch")),
        new("local", local),
        new("order_path", order_path),
        F.col("table"),
    )
    leaf_table = F.concat(F.try_element_at("anc", F.lit(-1)), F.lit("._value")) if level else F.lit(None).cast("string")
    nameless_leaf = F.when(N.is_blank(F.col("name")), leaf_table)
    # Nodes of the last level have no children, so none of them is a branch.
    named = (nameless_leaf if child_schema is None and level
             else F.when(F.col("branch"), N.combine(F.col("prefix"), F.col("local"))).otherwise(nameless_leaf))
    df = df.withColumn("table", F.when(F.col("fresh"), named).otherwise(F.col("table")))
    if within is not None:
        df = df.withColumn("inside", F.col("inside") | (F.col("fresh") & F.coalesce(N.escape_normal(F.col("table")) == within, F.lit(False))))
    return df, child_schema


def _descend(df: DataFrame, level: int, keep: bool = True) -> DataFrame:
    """Explode children next to their parent row, or without it; children inherit the parent's context."""
    kid_type = df.schema["kids"].dataType
    self_entry = F.array(F.lit(None).cast(kid_type.elementType))
    entries = F.concat(self_entry, F.coalesce(F.col("kids"), F.array().cast(kid_type)))
    # A parent outside of the wanted table goes no further without children.
    entries = F.when(F.col("inside") | (F.size("kids") > 0), entries)
    carried = [c for c in df.columns if c not in ("kids", "fresh")]
    df = df.select(*carried, F.posexplode(entries).alias("at", "k"))
    if not keep:
        df = df.where(F.col("at") > 0)
    elif level == 0:
        # A slice of a layer contributes fields only; the layer itself is in another piece.
        df = df.where((F.col("at") > 0) | F.col("shift").isNull())
    is_kid = F.col("at") > 0
    position = F.col("at") - 1 + (F.coalesce(F.col("shift"), F.lit(0)) if level == 0 else F.lit(0))
    down = lambda name, value: F.when(is_kid, value).otherwise(F.col(name)).alias(name)
    moved = {
        "path": F.concat(F.col("path"), F.array(position.cast("bigint"))),
        "p_name": F.col("name"), "p_local": F.col("local"),
        "prefix": F.when(N.is_blank(F.col("prefix")), F.col("table")).otherwise(F.col("prefix")),
        "anc": F.concat(F.col("anc"), F.array(F.col("table"))),
        "p_order": F.col("order_path"),
    }
    return df.select(
        *[down(c, moved[c]) if c in moved else F.col(c) for c in carried],
        is_kid.alias("fresh"), "k",
    )
