"""Newick text <-> node table, many trees at a time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.functions.names import file_stem

NODE_SCHEMA = (
    "tree_id string, node_id int, parent_id int, name string, dist double, support double, "
    "is_leaf boolean, features map<string,string>"
)

# What the dialects 0-9 and 100 hold, as (leaf name, leaf length, inner label,
# inner length); "support" labels are numbers. Dialects 0 and 1 accept missing parts.
DIALECTS = {
    0: ("name", "dist", "support", "dist"),
    1: ("name", "dist", "name", "dist"),
    2: ("name", "dist", "support", "dist"),
    3: ("name", "dist", "name", "dist"),
    4: ("name", "dist", None, None),
    5: ("name", "dist", None, "dist"),
    6: ("name", None, None, "dist"),
    7: ("name", "dist", "name", None),
    8: ("name", None, "name", None),
    9: ("name", None, None, None),
    100: (None, None, None, None),
}
FLEXIBLE = (0, 1)
ILLEGAL = r"[:;(),\[\]\t\n\r=]"
DEFAULT_DIST = 1.0
DEFAULT_SUPPORT = 1.0
FRAME_NODES = 1 << 14  # nodes of a frame of rows; a tree is never cut, so the last one may reach beyond


def read_newick(spark: SparkSession, glob: str, dialect: int = 0) -> DataFrame:
    """One tree per file; the tree id is the file name without its suffix."""
    files = spark.read.text(glob, wholetext=True).select(
        file_stem(F.col("_metadata.file_path")).alias("tree_id"), F.col("value").alias("newick")
    )
    return parse_newick(files, dialect)


def parse_newick(trees: DataFrame, dialect: int = 0) -> DataFrame:
    """(tree_id, newick) -> node table; malformed text is an error.

    Missing lengths and supports take the defaults of the format (a root has length 0).
    """
    parts = DIALECTS[dialect]
    strict = dialect not in FLEXIBLE
    default_dist, default_support, frame_nodes = DEFAULT_DIST, DEFAULT_SUPPORT, FRAME_NODES

    def nodes_of(tree_id: str, text: str) -> list[tuple]:
        import re

        tokens = re.findall(r"\[[^\]]*\]|[(),;]|[^(),;\[\]]+", re.sub(r"[\n\r\t]", "", text.strip()))
        if tokens.count("(") != tokens.count(")"):
            raise ValueError(f"tree {tree_id}: parentheses do not match")
        if not tokens or tokens[-1] != ";":
            raise ValueError(f"tree {tree_id}: no final semicolon")
        rows: list[list] = []  # parent, text, features, is_leaf
        open_nodes: list[int] = []
        current = None  # node that label, length and features belong to
        for token in tokens[:-1]:
            if token == "(":
                rows.append([open_nodes[-1] if open_nodes else None, "", {}, False])
                open_nodes.append(len(rows) - 1)
                current = None
            elif token in ",)":
                if current is None:  # an unnamed leaf
                    rows.append([open_nodes[-1], "", {}, True])
                current = open_nodes.pop() if token == ")" else None
            elif token.startswith("["):
                if current is None:
                    rows.append([open_nodes[-1] if open_nodes else None, "", {}, True])
                    current = len(rows) - 1
                if token.startswith("[&&NHX:"):
                    pairs = (item.partition("=") for item in token[7:-1].split(":"))
                    rows[current][2].update({key: value for key, _, value in pairs})
            elif token.strip():
                if current is None:
                    rows.append([open_nodes[-1] if open_nodes else None, "", {}, True])
                    current = len(rows) - 1
                rows[current][1] += token.strip()
        out = []
        for i, (parent, label, features, leaf) in enumerate(rows):
            kind, length_kind = parts[:2] if leaf else parts[2:]
            head, colon, tail = label.partition(":")
            missing = parent is not None and ((kind and not head) or (length_kind and not colon))
            surplus = (head and not kind) or (colon and not length_kind)
            if strict and (missing or surplus):
                raise ValueError(f"tree {tree_id}: node {i} {label!r} does not fit dialect {dialect}")
            dist = float(tail) if colon else (0.0 if parent is None else default_dist)
            name = head if kind == "name" else ""
            support = float(head) if kind == "support" and head else default_support
            out.append((tree_id, i, parent, name, dist, support, leaf, features))
        return out

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["tree_id", "node_id", "parent_id", "name", "dist", "support", "is_leaf", "features"]

        def frame(rows: list[tuple]) -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=columns)
            out["parent_id"] = out["parent_id"].astype("Int32")
            return out

        for batch in batches:
            rows = []
            for tree_id, text in zip(batch["tree_id"], batch["newick"]):
                rows += nodes_of(tree_id, text)
                if len(rows) >= frame_nodes:
                    yield frame(rows)
                    rows = []
            yield frame(rows)

    return trees.select("tree_id", "newick").mapInPandas(parse, NODE_SCHEMA)


def write_newick(nodes: DataFrame, dialect: int = 5) -> DataFrame:
    """Node table -> (tree_id, newick); characters the format reserves become "_".

    A tree is one text record, so its nodes meet in one group. The root gets no label.
    """
    parts = DIALECTS[dialect]
    illegal = ILLEGAL

    def label(kind: str | None, length_kind: str | None, row) -> str:
        import re

        head = ""
        if kind == "name":
            head = re.sub(illegal, "_", row.name_ or "")
        elif kind == "support":
            head = f"{row.support:f}"
        return head + (f":{row.dist:.15g}" if length_kind else "")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node_id").rename(columns={"name": "name_"})
        text: dict[int, list[str]] = {int(i): [] for i in pdf["node_id"]}
        root = ""
        for row in reversed(list(pdf.itertuples())):  # children come before their parent
            below = text[row.node_id]
            is_root = pd.isna(row.parent_id)
            if row.is_leaf:
                own = label(*parts[:2], row)
            else:
                own = "(" + ",".join(reversed(below)) + ")" + ("" if is_root else label(*parts[2:], row))
            if is_root:
                root = own + ";"
            else:
                text[int(row.parent_id)].append(own)
        return pd.DataFrame({"tree_id": [pdf["tree_id"].iloc[0]], "newick": [root]})

    columns = ["tree_id", "node_id", "parent_id", "name", "dist", "support", "is_leaf"]
    return nodes.select(*columns).groupBy("tree_id").applyInPandas(build, "tree_id string, newick string")
