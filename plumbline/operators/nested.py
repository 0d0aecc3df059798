"""Deeply nested records to related flat tables, by interval labels.

A depth-first traversal gives every node of a JSON document a pre-order and a post-order number. A
node lies below another exactly when its pre number is larger and its post number smaller, so
children find their parents, at any depth, by interval containment and not by paths or ids.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NODE = "array<struct<src:string,kind:string,pre:int,post:int,depth:int,pos:int,url:string,fields:string>>"

#: Generalised path of an object ([] stands for any list position) and the kind of row it becomes.
DECISION_KINDS = {
    "datasheets": "datasheet",
    "sources": "source",
    "facts": "fact",
    "conflicts": "conflict",
    "conclusion_evidence": "conclusion",
    "classification_evidence_quotes": "classification",
    "facts/evidence_quotes": "quote",
}
EVIDENCE_KINDS = {"": "evidence"}
WRAPPED_EVIDENCE_KINDS = {"results": "evidence"}
KIND_NAMES = [*DECISION_KINDS.values(), "evidence"]


def _no_constant(_: str) -> None:
    raise ValueError("NaN and Infinity are no JSON")


def read_json(text: object) -> object:
    """The value of a JSON text; a string that itself holds JSON counts as its content. None if unreadable."""
    try:
        while isinstance(text, str):
            text = json.loads(text, parse_constant=_no_constant)
        return text
    except (ValueError, RecursionError):
        return None


def label_nodes(root: object, kinds: dict[str, str], src: str, with_fields: bool) -> list[tuple]:
    """(src, kind, pre, post, depth, pos, url, fields) of the objects whose path is in ``kinds``.

    Every node, list and scalar is numbered; only objects of a wanted kind are returned. A lone
    object where a list is expected has position 0. Null and scalar list elements keep their
    position but are no objects. ``fields`` is the JSON of the scalars and scalar lists of an object.
    """
    out: list[list] = []
    pre = post = 0
    stack: list[tuple] = [(root, "", 0, 0, False, None)]
    while stack:
        node, path, depth, pos, leaving, row = stack.pop()
        if leaving:
            if row is not None:
                row[3] = post
            post += 1
            continue
        row = None
        children: list[tuple] = []
        if isinstance(node, str) and path in kinds and node[:1] in "[{":
            inner = read_json(node)
            node = inner if inner is not None else node
        if isinstance(node, dict):
            if path in kinds:
                url = node.get("url")
                flat = None
                if with_fields:
                    flat = {k: v for k, v in node.items() if not isinstance(v, dict) and not (isinstance(v, list) and any(isinstance(x, (dict, list)) for x in v))}
                    flat = json.dumps(flat, ensure_ascii=False)
                row = [src, kinds[path], pre, 0, depth, pos, url if isinstance(url, str) else None, flat]
                out.append(row)
            base = path + "/" if path else ""
            children = [(v, base + k, depth + 1, 0, False, None) for k, v in node.items()]
        elif isinstance(node, list):
            # a list inside a list is no list of objects of that kind
            inside = [(v, path + "[]" if isinstance(v, list) else path, depth + 1, i, False, None) for i, v in enumerate(node)]
            children = inside
        pre += 1
        stack.append((None, path, depth, pos, True, row))
        stack.extend(reversed(children))
    return [tuple(r) for r in out]


def document_nodes(decision: object, evidence: object, with_fields: bool) -> list[tuple]:
    d, e = read_json(decision), read_json(evidence)
    rows = label_nodes(d, DECISION_KINDS, "decision", with_fields) if isinstance(d, dict) else []
    if isinstance(e, (dict, list)):
        wrapped = isinstance(e, dict) and "results" in e
        rows += label_nodes(e, WRAPPED_EVIDENCE_KINDS if wrapped else EVIDENCE_KINDS, "evidence", with_fields)
    return rows


_NODE_TYPES = [("src", pa.string()), ("kind", pa.string()), ("pre", pa.int32()), ("post", pa.int32()), ("depth", pa.int32()), ("pos", pa.int32()), ("url", pa.string()), ("fields", pa.string())]


def _nodes_udf(with_fields: bool):
    @F.arrow_udf(NODE)
    def nodes(decision: pa.Array, evidence: pa.Array) -> pa.Array:
        rows = [document_nodes(d, e, with_fields) for d, e in zip(decision.to_pylist(), evidence.to_pylist())]
        flat = [r for document in rows for r in document]
        columns = [pa.array([r[i] for r in flat], kind) for i, (_, kind) in enumerate(_NODE_TYPES)]
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), pa.StructArray.from_arrays(columns, [n for n, _ in _NODE_TYPES]))

    return nodes


def nested_rows(completions: DataFrame, with_fields: bool = False) -> DataFrame:
    """One row per nested object of each completion, linked to its parent and to the document it cites.

    Columns: product_id, child_kind, parent_pos, child_pos, doc_pos, url, pre, post and, if asked for,
    ``fields`` (JSON). Whole-row repeats count once; of several completions of a product the one with
    the latest ``completed_at`` counts, at ties the greater text. Null, empty, truncated or otherwise
    unreadable text has no objects. Rows without product_id cannot be linked and are left out.
    ``parent_pos`` comes from the fact whose interval contains the quote's; ``doc_pos`` is the first
    evidence document with exactly the url, else -1. One exchange brings a product's documents together
    (after the latest were taken before it), a second one its node rows: a product is one document after
    the collapse, so no group grows with the table.
    """
    one = (
        completions.select("product_id", "completed_at", "decision_json", "evidence_json")
        .where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(F.max(F.struct("completed_at", "decision_json", "evidence_json")).alias("_c"))
    )
    node = one.select("product_id", F.explode(_nodes_udf(with_fields)("_c.decision_json", "_c.evidence_json")).alias("n")).select("product_id", "n.*")
    # the UDF forgets how its input was partitioned: one exchange of node rows, without their documents, serves both links
    node = node.repartition("product_id")
    above = Window.partitionBy("product_id", "src").orderBy("pre").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same_url = Window.partitionBy("product_id", "url")
    fact = F.last(F.when(F.col("kind") == "fact", F.struct("pre", "post", "pos")), ignorenulls=True).over(above)
    inside = (F.col("_f.pre") < F.col("pre")) & (F.col("_f.post") > F.col("post"))
    first_doc = F.min(F.when(F.col("kind") == "evidence", F.col("pos"))).over(same_url)
    cites = F.col("url").isNotNull() & ~F.col("kind").isin("fact", "conflict", "evidence")
    return (
        node.withColumn("_f", fact)
        .withColumn("_d", first_doc)
        .select(
            "product_id",
            F.col("kind").alias("child_kind"),
            F.when((F.col("kind") == "quote") & inside, F.col("_f.pos")).otherwise(-1).cast("int").alias("parent_pos"),
            F.col("pos").cast("int").alias("child_pos"),
            F.when(cites, F.coalesce("_d", F.lit(-1))).otherwise(-1).cast("int").alias("doc_pos"),
            "url",
            "pre",
            "post",
            *(["fields"] if with_fields else []),
        )
    )


#: Typed columns of each flat table, read from the ``fields`` of its objects.
TABLE_FIELDS = {
    "datasheet": "url string, title string, source_type string, is_primary boolean",
    "source": "url string, title string, source_type string",
    "fact": "name string, value string, unit string, category string, confidence double, evidence_urls array<string>",
    "quote": "url string, quote string, model_quote string",
    "conflict": "field string, values array<string>, source_urls array<string>",
    "conclusion": "url string, quote string, model_quote string",
    "classification": "url string, quote string, model_quote string",
    "evidence": "url string, sha256 string",
}


def _typed(rows: DataFrame, kind: str) -> DataFrame:
    return rows.select("product_id", "parent_pos", "child_pos", "doc_pos", F.from_json("fields", TABLE_FIELDS[kind]).alias("_v")).select("product_id", "parent_pos", "child_pos", "doc_pos", "_v.*")


def flat_table(completions: DataFrame, kind: str) -> DataFrame:
    """The flat table of one kind: product_id, parent_pos, child_pos, doc_pos and its typed fields."""
    return _typed(nested_rows(completions, with_fields=True).where(F.col("child_kind") == kind), kind)


def write_flat_tables(completions: DataFrame, folder: str) -> dict[str, DataFrame]:
    """All flat tables from one traversal: node rows are written to ``folder`` by kind, each table reads its part of them."""
    nested_rows(completions, with_fields=True).write.mode("overwrite").partitionBy("child_kind").parquet(folder)
    rows = completions.sparkSession.read.schema("product_id string, parent_pos int, child_pos int, doc_pos int, fields string, child_kind string").parquet(folder)
    return {kind: _typed(rows.where(F.col("child_kind") == kind), kind) for kind in TABLE_FIELDS}
