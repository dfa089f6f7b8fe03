"""Typed nodes to relational rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import naming as N, render as X, values as V
from .filters import FilterRules, keep_column, keep_table
from .numbering import number_small, previous_small
from .trees import BRANCH_NAMED, CARRIED

ROW_KEY = ["src", "packet_no", "path"]
SLICE = 4096  # sibling positions per numbering slice
LAST = 9223372036854775807
LONE_BINARY = -1  # ``sub`` of a binary that is dropped unless its column has more values


def row_cells(nodes: DataFrame, filters: FilterRules | None = None, keep_binary: bool = False, layers_only: bool = False) -> DataFrame:
    """Cells of every output row, plus one empty cell per ancestor row kept alive by them.

    A row exists when something below it has content, so each contributing node
    also marks its ancestor rows; the marks collapse map-side when rows are
    assembled. Denied tables and denied columns stop here, before the shuffle.
    With ``layers_only`` just the marks of layer rows.
    """
    nameless = N.is_blank(F.col("name"))
    field = F.col("type") == "field"
    own_row = F.col("branch") | nameless
    leaf_value = field & ~F.col("branch") & nameless
    column = F.when(own_row, F.lit("_value")).otherwise(F.col("local"))
    label_column = F.when(own_row, F.lit("_string")).otherwise(F.concat(column, F.lit("_string")))
    position = F.when(own_row, F.lit(LAST)).otherwise(F.element_at("path", -1))
    chain = F.when(own_row, F.concat(F.col("anc"), F.array(F.col("table")))).otherwise(F.col("anc"))
    depth = F.when(own_row, F.size("anc") + 1).otherwise(F.size("anc"))
    has_content = F.col("reject").isNull() & field & (F.col("text").isNotNull() | leaf_value)
    if "inside" in nodes.columns:
        has_content = has_content & F.col("inside")
    nodes = nodes.select(
        *CARRIED, has_content.alias("content"), "path", "order_path", chain.alias("tables"), depth.alias("n"), column.alias("c"),
        label_column.alias("lc"), position.alias("position"), "kind", "text", "label",
    )
    # One entry per row that a node touches: 0 for its label, its depth for its value, less for marks of the rows above.
    # Content is tested inside the generator: as a filter it would be pushed into
    # the typing projection and evaluate it twice.
    entries = F.array(F.lit(1)) if layers_only else F.sequence(F.when(F.col("label").isNotNull(), 0).otherwise(1), F.col("n"))
    label, value = F.col("e") == 0, F.col("e") == F.col("n")
    cells = nodes.select(
        *CARRIED, "path", "order_path", "tables", "n", "c", "lc", "position", "kind", "text", "label",
        F.explode(F.when(F.col("content"), entries)).alias("e"),
    ).select(
        *CARRIED, "path", "order_path", "tables", F.when(label, F.col("n")).otherwise(F.col("e")).alias("m"),
        F.when(label | value, F.col("position")).alias("position"),
        F.when(label, 1).when(value, 0).alias("sub"), F.when(label, F.col("lc")).when(value, F.col("c")).alias("column"),
        F.when(label, V.TEXT).when(value, F.col("kind")).alias("kind"),
        F.when(label, F.col("label")).when(value, F.col("text")).alias("text"),
    ).select(
        *CARRIED, F.slice("path", F.lit(1), F.col("m")).alias("path"),
        F.slice("order_path", F.lit(1), F.col("m") * 2 - 1).alias("order_path"),
        F.slice("tables", F.lit(1), F.col("m")).alias("tables"),
        N.escape_normal(F.get("tables", F.col("m") - 1)).alias("table"),
        "position", "sub", "column", N.escape_normal(F.col("column")).alias("esc"), "kind", "text",
    )
    if filters is not None:
        cells = cells.where(keep_table(filters, F.col("table")))
    dropped = ~keep_column(filters, F.col("table"), F.col("esc")) | F.col("text").isNull()
    cells = cells.withColumn("esc", F.when(~F.coalesce(dropped, F.lit(False)), F.col("esc")))
    if keep_binary:
        return cells
    # Whether a binary is alone in its column shows when the row is assembled.
    return cells.withColumn("sub", F.when(F.col("kind") == V.BYTES, F.lit(LONE_BINARY)).otherwise(F.col("sub")))


def assemble_rows(cells: DataFrame) -> DataFrame:
    """Group the cells of each row: the only shuffle of the shredding itself."""
    cell = F.when(F.col("esc").isNotNull(), F.struct("position", "sub", "column", "esc", "kind", "text"))
    # Packets first: where keys are sorted, most are told apart by their number alone.
    return cells.groupBy("packet_no", "src", "path").agg(
        *[F.first(c).alias(c) for c in ("number", "ts", "gen_idx", "order_path", "tables", "table")],
        F.sort_array(F.collect_list(cell)).alias("cells"),
    )


def add_source_path(rows: DataFrame, filters: FilterRules | None = None) -> DataFrame:
    """``file`` cell on capture-information rows."""
    cell = F.struct(F.lit(LAST).alias("position"), F.lit(2).alias("sub"), F.lit("file").alias("column"),
                    F.lit("file").alias("esc"), F.lit(V.TEXT).alias("kind"), F.col("src").alias("text"))
    on_it = (F.size("path") == 1) & (F.col("table") == "geninfo") & keep_column(
        filters, F.col("table"), F.lit("file"))
    return rows.withColumn("cells", F.when(on_it, F.concat("cells", F.array(cell))).otherwise(F.col("cells")))


def row_class(order_path: Column) -> Column:
    """0 nameless leaf, 1 nameless branch, 2 named branch; layers count as named."""
    return F.when(F.size(order_path) > 1, F.get(order_path, F.size(order_path) - 2)).otherwise(F.lit(BRANCH_NAMED))


def number_siblings(rows: DataFrame) -> DataFrame:
    """``_index`` of nameless rows among their surviving nameless siblings."""
    spot = F.element_at("path", -1)
    nameless = row_class(F.col("order_path")) < BRANCH_NAMED
    keyed = rows.where(nameless).withColumns({
        "_parent": F.slice("path", F.lit(1), F.size("path") - 1), "_class": row_class(F.col("order_path")),
        "_slice": F.floor(spot / SLICE), "_spot": spot})
    numbered = number_small(keyed, "_nth", ["src", "packet_no", "_parent", "_class"], ["_slice"], ["_spot"])
    index = F.struct(F.lit(LAST).alias("position"), F.lit(3).alias("sub"), F.lit("_index").alias("column"),
                     F.lit("_index").alias("esc"), F.lit(V.INT32).alias("kind"),
                     (F.col("_nth") - 1).cast("string").alias("text"))
    numbered = numbered.withColumn("cells", F.concat("cells", F.array(index))).drop("_parent", "_class", "_slice", "_spot", "_nth")
    return rows.where(~nameless).unionByName(numbered)


def picked(cells: Column, column: str | Column) -> Column:
    """Values of one escaped column as cells; of names that escape alike the later one wins."""
    hits = F.filter(cells, lambda x: x["esc"] == column)
    # The winner is found once and handed to the filter: inside it, it would be found again for every value.
    both = F.transform(F.array(hits), lambda h: F.struct(
        h.alias("hits"), F.try_element_at(F.array_distinct(F.transform(h, lambda y: y["column"])), F.lit(-1)).alias("winner")))
    return F.get(F.transform(both, lambda b: F.filter(b["hits"], lambda x: x["column"] == b["winner"])), F.lit(0))


def stored(hits: Column) -> Column:
    """One value as it is, repeated values as one text (B10, F16): struct(kind, text).

    Of binaries only a lone one is dropped (E13); repeated ones are a text like any other.
    """
    def value(h: Column) -> Column:
        lone = F.get(h, F.lit(0))
        many = F.size(h) > 1
        one = F.when(lone["sub"] != LONE_BINARY, lone)
        return F.struct(
            F.when(many, F.lit(V.ARRAY)).otherwise(one["kind"]).alias("kind"),
            F.when(many, X.multi_text(F.transform(h, lambda x: x["text"]))).otherwise(one["text"]).alias("text"),
        )

    # The values are picked once and handed over: each use of them would pick them again.
    return F.get(F.transform(F.array(hits), value), F.lit(0))


def resolve_columns(rows: DataFrame) -> DataFrame:
    """``cols``: every stored column of the row as struct(column, kind, text)."""
    names = F.array_distinct(F.transform("cells", lambda x: x["esc"]))
    def one(c: Column) -> Column:
        value = F.transform(F.array(stored(picked(F.col("cells"), c))), lambda v: F.struct(c.alias("column"), v["kind"].alias("kind"), v["text"].alias("text")))
        return F.get(value, F.lit(0))
    return rows.withColumn("cols", F.filter(F.transform(names, one), lambda x: x["kind"].isNotNull())).drop("cells")


def row_id(src: Column, packet_no: Column, path: Column) -> Column:
    """Stable text key of a row."""
    return F.concat_ws("/", src, packet_no.cast("string"), F.array_join(path.cast("array<string>"), "."))


def tree_parent(rows: DataFrame, filters: FilterRules | None = None) -> DataFrame:
    """Nearest kept ancestor inside the layer: ``up`` (its path length) or null."""
    above = F.size("path") - 1
    if filters is None or not filters.tables:
        up = F.when(above > 0, above)
    else:
        kept = F.filter(F.when(above > 0, F.sequence(F.lit(1), above)),
                        lambda m: keep_table(filters, N.escape_normal(F.get(F.col("tables"), m - 1))))
        up = F.when(F.size(kept) > 0, F.element_at(kept, -1))
    return rows.withColumn("up", up)


def layer_chain(layers: DataFrame, filters: FilterRules | None = None) -> DataFrame:
    """For every non-empty layer the nearest kept, non-empty layer before it.

    ``layers``: src, packet_no, at, table, one row per non-empty layer, denied ones
    included, because rows inside a denied layer hang below the layer before it.
    """
    kept = F.when(keep_table(filters, F.col("table")), F.struct("at", "table"))
    sliced = layers.withColumns({"_slice": F.floor(F.col("at") / SLICE), "_kept": kept})
    linked = previous_small(sliced, "_before", ["src", "packet_no"], "_slice", "at", "_kept")
    return linked.select(F.col("src").alias("_src"), F.col("packet_no").alias("_packet"), F.col("at").alias("_layer"),
                         F.col("_before.at").alias("_at"), F.col("_before.table").alias("_table"))


def attach_parents(rows: DataFrame, chain: DataFrame | None, filters: FilterRules | None = None) -> DataFrame:
    """``parent_path`` and ``parent_table`` of every row, over denied rows and empty layers."""
    rows = tree_parent(rows, filters)
    in_tree = F.slice("path", F.lit(1), F.col("up"))
    in_tree_table = N.escape_normal(F.get("tables", F.col("up") - 1))
    if chain is None:
        return rows.withColumns({"parent_path": in_tree, "parent_table": in_tree_table}).drop("up")
    linked = rows.join(chain, (F.col("src") == F.col("_src")) & (F.col("packet_no") == F.col("_packet"))
                       & (F.get("path", F.lit(0)) == F.col("_layer")) & F.col("up").isNull(), "left")
    return linked.withColumns({
        "parent_path": F.coalesce(in_tree, F.when(F.col("_at").isNotNull(), F.array("_at"))),
        "parent_table": F.coalesce(in_tree_table, F.col("_table")),
    }).drop("up", "_src", "_packet", "_layer", "_at", "_table")


def lineage(rows: DataFrame) -> DataFrame:
    """Lineage holds for every row below the capture-information row, not for that row."""
    at = F.get("path", F.lit(0))
    below = (at > F.col("gen_idx")) | ((at == F.col("gen_idx")) & (F.size("path") > 1))
    return rows.withColumns({"number": F.when(below, F.col("number")), "ts": F.when(below, F.col("ts")),
                             "file": F.when(below, F.col("src"))})


def _with_values(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the stored value of each column as ``_c0``, ``_c1``, ..."""
    resolved = "cols" in rows.columns

    def value(name: str) -> Column:
        if resolved:
            return F.get(F.filter("cols", lambda x: x["column"] == name), F.lit(0))
        return stored(picked(F.col("cells"), name))

    return rows.withColumns({f"_c{i}": value(name) for i, name in enumerate(columns)})


def cut_values(rows: DataFrame, table: str, columns: dict[str, str], profile: str = "text") -> DataFrame:
    """table, _id, column, truncated characters of the values that ``wide_table`` cuts with ``limit``."""
    cuts = [F.when(X.is_clipped(F.col(f"_c{i}")["kind"], F.col(f"_c{i}")["text"]), F.struct(
                F.lit(name).alias("column"),
                (F.length(F.col(f"_c{i}")["text"]) - F.length(X.clip(F.col(f"_c{i}")["kind"], F.col(f"_c{i}")["text"]))).alias("truncated")))
            for i, (name, kind) in enumerate(columns.items()) if X.PROFILES[profile][kind] == "string"]
    none = F.array().cast("array<struct<column:string,truncated:int>>")
    found = _with_values(rows, columns).select(
        _key(rows, "path", "dense_id").alias("_id"), F.explode(F.array_compact(F.array(*cuts)) if cuts else none).alias("cut"))
    return found.select(F.lit(table).alias("table"), "_id", "cut.column", "cut.truncated")


def _key(rows: DataFrame, path: str, dense: str) -> Column:
    return F.col(dense) if dense in rows.columns else row_id(F.col("src"), F.col("packet_no"), F.col(path))


def wide_table(rows: DataFrame, columns: dict[str, str], parents: list[str] | None = None,
               profile: str = "text", limit: bool = False) -> DataFrame:
    """Rows of one table as typed columns (F14, F18, F19); needs ``attach_parents`` for parent keys.

    ``columns``: escaped column -> stored kind, as inferred or as given. Texts are whole, or with ``limit`` cut at the
    limits of the profiles; ``cut_values`` tells which.
    """
    rows = _with_values(lineage(rows), columns)
    typed = []
    for i, (name, kind) in enumerate(columns.items()):
        v = F.col(f"_c{i}")
        text = X.clip(v["kind"], v["text"]) if limit and X.PROFILES[profile][kind] == "string" else v["text"]
        typed.append(X.to_type(text, kind, profile).alias(name))
    key = _key(rows, "path", "dense_id")
    parent = _key(rows, "parent_path", "dense_parent") if "parent_path" in rows.columns else None
    return rows.select(
        key.alias("_id"),
        (F.when(F.col("file").isNotNull(), F.col("file_id")).alias("_sourcefileid") if "file_id" in rows.columns
         else F.col("file").alias("_sourcefile")), F.col("number").alias("_number"),
        (F.col("ts") if profile == "text" else V.time_text(F.col("ts"))).alias("_timestamp"),
        *[F.when(F.col("parent_table") == p, parent).alias(f"parent_{p}") for p in parents or []],
        *typed,
    )
