"""The shredding job as one object: pieces to nodes, cells, rows and tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, functions as F

from ..operators import shred as S
from ..operators.filters import FilterRules
from ..operators.rename import RenameRules
from ..operators.trees import explode_nodes
from ..operators.typing import Labels, label_values, prepare_labels, type_nodes
from ..session import stage


@dataclass
class Shredder:
    pieces: DataFrame | list[DataFrame]
    fields: DataFrame | None = None
    labels: DataFrame | Labels | None = None
    rules: RenameRules | None = None
    filters: FilterRules | None = None
    capture_tz: str = "UTC"
    keep_binary: bool = False
    totals: dict[str, int] = field(default_factory=dict)
    _memo: dict = field(default_factory=dict)

    def nodes(self, table: str | None = None) -> DataFrame:
        """All nodes, named, typed and labelled; rejected ones carry ``reject``.

        For one ``table`` its nodes and those below its rows are marked ``inside``; most others are left out before typing and labels.
        """
        if "nodes" in self._memo:
            return self._memo["nodes"]
        if isinstance(self.labels, DataFrame):
            self.labels = prepare_labels(self.labels)
        nodes = explode_nodes(self.pieces, self.rules, table)
        nodes = label_values(type_nodes(nodes, self.fields, self.capture_tz), self.labels)
        if table is None:
            self._memo["nodes"] = nodes
        return nodes

    def staged(self) -> "Shredder":
        """Keep typed nodes in the staging folder: for runs that write many tables from one scan.

        What the run read is counted on the way into ``totals`` (H2): nodes, rejected ones, and nodes with a value of their own.
        """
        seen, alive = Observation("nodes"), F.col("reject").isNull()
        counted = self.nodes().observe(seen, F.count_if(alive).alias("nodes"), F.count_if(~alive).alias("rejected nodes"),
                                       F.count_if(alive & F.col("text").isNotNull()).alias("values"))
        self._memo["nodes"] = stage(counted, "nodes")
        self.totals |= {k: v or 0 for k, v in seen.get.items()}
        return self

    def cells(self, table: str | None = None) -> DataFrame:
        return S.row_cells(self.nodes(table), self.filters, self.keep_binary)

    def rows(self, table: str | None = None) -> DataFrame:
        """Output rows of all tables, or of one; denied tables are gone, ``cells`` hold the values."""
        cells = self.cells(table)
        if table is not None:
            cells = cells.where(F.col("table") == table)
        rows = S.assemble_rows(cells)
        if table in (None, "geninfo"):
            rows = S.add_source_path(rows, self.filters)
        if table is None or table.endswith(("_value", "_group")):
            # Numbering reads its input twice; the trees below are exploded once.
            rows = S.number_siblings(stage(rows, "assembled"))
        return rows

    def layers(self) -> DataFrame:
        """Layer chain: the nearest kept layer before every non-empty layer."""
        marks = S.row_cells(self.nodes(), None, keep_binary=True, layers_only=True)
        layers = marks.select("src", "packet_no", F.get("path", F.lit(0)).alias("at"), "table").distinct()
        return S.layer_chain(stage(layers, "layers"), self.filters)

    def table(self, name: str, columns: dict[str, str], parents: list[str] | None = None,
              chain: bool = True, profile: str = "text", limit: bool = False) -> DataFrame:
        """One output table with the given columns. ``chain=False`` skips the layer chain
        when every parent of the table is known to lie in the same layer."""
        rows = self.rows(name)
        if parents:
            rows = S.attach_parents(rows, self.layers() if chain else None, self.filters)
        return S.wide_table(rows, columns, parents, profile, limit)
