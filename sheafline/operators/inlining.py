"""Deeply nested records into flat, linked relations (shared inlining).

The work has three steps:

1. ``schema_graph`` reads every record once and gathers the edges of the schema graph: parent element, child element,
   the kinds of value seen and whether the child repeats. Only distinct edges leave a task.
2. ``relations_of`` decides which elements become relations: the root, every repeated element, every object reached
   from more than one parent (shared) and every object that can contain itself (recursive). All other descendants
   are inlined as columns named by their path below the relation.
3. ``shred`` walks each record again and emits one row per relation node with its own id, the id of the parent node,
   its 0-based position and the lineage of ancestors, so no join is needed to follow a link upwards.

A built-in ``from_json`` needs one type per field; exporters here write the same field as a list, as one bare object or
as a string that encodes the list, and elements may recurse, hence the Arrow-batched walk.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

ROOT = "record"
NODE_SCHEMA = (
    "record_key STRING, relation STRING, node_id STRING, parent_relation STRING, parent_node STRING, pos INT, "
    "lineage ARRAY<STRUCT<relation: STRING, key: STRING, pos: INT>>, attrs MAP<STRING, STRING>"
)


@dataclass(frozen=True)
class Naming:
    """How differing exporters' names meet: ``aliases`` renames elements, ``transparent`` lists wrapper objects whose
    members belong to the wrapper's parent, ``member`` names the child of an element that is written as a bare list
    inside a list, ``keys`` names the attribute that identifies a node of a relation for its descendants."""

    aliases: dict[str, str] = field(default_factory=dict)
    transparent: frozenset[str] = frozenset()
    member: dict[str, str] = field(default_factory=dict)
    keys: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Edge:
    parent: str
    child: str
    repeated: bool
    objects: bool
    scalars: bool


def _members(name: str, value: object, naming: Naming) -> Iterator[tuple[str, object]]:
    """(element, value) of the children of an object, or of a list standing where an object is expected."""
    if isinstance(value, list):
        yield naming.member.get(name, "item"), value
        return
    for key, v in value.items():
        if key in naming.transparent and isinstance(v, dict):
            yield from _members(key, v, naming)
        else:
            yield naming.aliases.get(key, key), v


def _decoded(value: object) -> object:
    """A string that encodes a JSON list or object, decoded; anything else unchanged."""
    if isinstance(value, str) and value[:1] in "[{":
        try:
            return json.loads(value)
        except (ValueError, RecursionError):
            return value
    return value


def _read(payload: object) -> tuple[dict | None, str | None]:
    """(the record, None), or (None, why it can't be read)."""
    if not isinstance(payload, str) or not payload.strip():
        return None, "empty"
    try:
        value = json.loads(payload)
    except ValueError:
        return None, "not JSON"
    except RecursionError:
        return None, "nested too deep"
    if isinstance(value, (dict, list)):
        return (value if isinstance(value, dict) else {ROOT: value}), None
    return None, "no object"


def _parsed(payload: object) -> dict | None:
    return _read(payload)[0]


def _edges(name: str, value: object, naming: Naming, found: dict) -> None:
    stack = [(name, value)]
    while stack:
        name, value = stack.pop()
        for child, v in _members(name, value, naming):
            v = _decoded(v)
            seen = found.setdefault((name, child), [False, False, False])
            parts = v if isinstance(v, list) else [v]
            seen[0] |= isinstance(v, list)
            for part in parts:
                if isinstance(part, (dict, list)):
                    seen[1] = True
                    stack.append((child, part))
                elif part is not None:
                    seen[2] = True


def schema_graph(df: DataFrame, payload: str, naming: Naming = Naming(), max_edges: int = 10_000) -> list[Edge]:
    """The distinct edges of the schema graph of all payloads.

    What reaches the driver is one row per distinct edge, never per record; a collection with more than ``max_edges``
    element pairs uses data as names, which is reported instead of growing without bound. Null, empty and unreadable
    payloads add no edges; an empty table gives an empty graph.
    """

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict = {}
        for batch in batches:
            for text in batch[payload]:
                if (value := _parsed(text)) is not None:
                    _edges(ROOT, value, naming, found)
        yield pd.DataFrame([(*k, *v) for k, v in found.items()], columns=["parent", "child", "repeated", "objects", "scalars"])

    rows = (
        df.select(F.col(payload))
        .mapInPandas(find, "parent STRING, child STRING, repeated BOOLEAN, objects BOOLEAN, scalars BOOLEAN")
        .groupBy("parent", "child")
        .agg(*(F.bool_or(c).alias(c) for c in ("repeated", "objects", "scalars")))
        .limit(max_edges + 1)
        .collect()
    )
    if len(rows) > max_edges:
        raise ValueError(f"more than {max_edges} distinct parent/child element pairs")
    return sorted((Edge(*r) for r in rows), key=lambda e: (e.parent, e.child))


def relations_of(edges: list[Edge]) -> set[str]:
    """The elements that get a relation of their own: root, repeated objects, shared objects, recursive objects."""
    below: dict[str, set[str]] = {}
    parents: dict[str, set[str]] = {}
    out = {ROOT}
    for e in edges:
        if e.objects:
            below.setdefault(e.parent, set()).add(e.child)
            parents.setdefault(e.child, set()).add(e.parent)
            if e.repeated:
                out.add(e.child)
    out |= {child for child, p in parents.items() if len(p) > 1}
    for start in below:
        seen, stack = set(), list(below[start])
        while stack:
            x = stack.pop()
            if x not in seen:
                seen.add(x)
                stack += below.get(x, ())
        if start in seen:
            out.add(start)
    return out


def _text(v: object) -> str | None:
    return None if v is None else v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)


def _nodes(key: str, value: dict, edges: dict[tuple[str, str], Edge], relations: set[str], naming: Naming) -> Iterator[tuple]:
    stack = [(ROOT, value, key, None, None, 0, [])]
    while stack:
        relation, value, node, parent, above, pos, lineage = stack.pop()
        attrs: dict[str, str | None] = {}
        inner = [("", relation, value)]
        children = []
        while inner:
            path, name, v = inner.pop()
            if not isinstance(v, (dict, list)):
                attrs["value"] = _text(v)
                continue
            for child, x in _members(name, v, naming):
                edge = edges.get((name, child))
                if edge is None or not edge.objects:
                    attrs.setdefault(path + child, _text(_decoded(x) if edge and edge.repeated else x))
                    continue
                x = _decoded(x)
                if child in relations:
                    many = x if isinstance(x, list) and edge.repeated else [] if x is None else [x]
                    children += [(child, y, i) for i, y in enumerate(many)]
                elif isinstance(x, dict):
                    inner.append((f"{path}{child}.", child, x))
                else:
                    attrs.setdefault(path + child, _text(x))
        own = attrs.get(naming.keys.get(relation, ""))
        here = [*lineage, (relation, own if own is not None else node, pos)]
        yield key, relation, node, parent, above, pos, lineage, attrs
        for child, y, i in reversed(children):
            stack.append((child, y, f"{node}/{child}[{i}]", relation, node, i, here))


def shred(
    df: DataFrame, key: str | Column, payload: str, edges: list[Edge], naming: Naming = Naming(), only: set[str] | None = None
) -> DataFrame:
    """One row per node of every relation (``NODE_SCHEMA``), all relations in one pass; ``only`` names the relations
    whose rows leave the task, the others are still walked for their descendants.

    A field that is a list anywhere in the collection is read as a list everywhere: a bare object counts as a list of
    one, a string that encodes a list is decoded, null or a missing field is an empty list. Payloads that are null,
    empty or unreadable give no rows; ``rejected`` names them. A null element of a list keeps its position and gets a node with only ``value``
    null. Rows of ``df`` repeating a key are shredded each; use ``latest_payloads`` first where they are redeliveries.
    """
    by, relations = {(e.parent, e.child): e for e in edges}, relations_of(edges)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["record_key", "relation", "node_id", "parent_relation", "parent_node", "pos", "lineage", "attrs"]
        for batch in batches:
            rows: list[tuple] = []
            for k, text in zip(batch["k"], batch["p"]):
                if (value := _parsed(text)) is not None:
                    rows += [
                        (*r[:6], [dict(zip(("relation", "key", "pos"), x)) for x in r[6]], r[7])
                        for r in _nodes(k, value, by, relations, naming)
                        if only is None or r[1] in only
                    ]
                if len(rows) >= 20_000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            yield pd.DataFrame(rows, columns=columns)

    key = F.col(key) if isinstance(key, str) else key
    return df.select(key.cast("string").alias("k"), F.col(payload).alias("p")).mapInPandas(walk, NODE_SCHEMA)


def rejected(df: DataFrame, key: str, payload: str, every: bool = False) -> DataFrame:
    """key, reason of every row whose payload gives no nodes: empty, not JSON, no object, or nested too deep (some thousands of
    levels, which would also make every node's lineage that long). With ``every`` all rows, those that are read with null."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            why = [_read(p)[1] for p in batch["_p"]]
            yield pd.DataFrame({key: batch[key], "reason": why}).loc[[every or w is not None for w in why]]

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, F.col(payload).alias("_p")).mapInPandas(check, f"{key} {kind}, reason STRING")


def latest_payloads(df: DataFrame, key: str, payload: str, at: str) -> DataFrame:
    """One row per key: the payload that arrived last (ties: the greatest). Rows without a key stay apart by payload."""
    return (
        df.groupBy(F.col(key).alias("key"), F.when(F.col(key).isNull(), F.xxhash64(payload)).alias("apart"))
        .agg(F.max_by(payload, F.struct(F.col(at), F.col(payload))).alias("payload"))
        .select("key", "payload")
    )


def relation(nodes: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """One relation as a flat table: ids, position and the named attributes as string columns (null where absent).
    Attributes whose name clashes with an id column get the prefix ``attr_``."""
    ids = ["record_key", "node_id", "parent_relation", "parent_node", "pos"]
    return nodes.where(F.col("relation") == name).select(
        *ids, *(F.col("attrs")[c].alias(f"attr_{c}" if c in ids else c) for c in columns)
    )


#: Names that the exporter versions of ``raw_records`` use.
RAW_RECORDS = Naming(
    aliases={"items": "text_items"},
    transparent=frozenset({"result"}),
    member={"rows": "cells"},
    keys={"sections": "section_id", "tables": "table_id"},
)


def raw_record_nodes(records: DataFrame, only: set[str] | None = None) -> DataFrame:
    """Every node of ``raw_records``: relations record, sections, text_items, tables, rows and cells."""
    latest = latest_payloads(records, "record_id", "payload", "received_at")
    edges = schema_graph(records, "payload", RAW_RECORDS)
    return shred(latest, "key", "payload", edges, RAW_RECORDS, only)


def raw_record_relations(records: DataFrame) -> DataFrame:
    """record_id, relation, node_id, parent_relation, parent_node, pos, attrs (as JSON) of every node of every relation."""
    return raw_record_nodes(records).select(
        F.col("record_key").cast("bigint").alias("record_id"), "relation", "node_id", "parent_relation", "parent_node", "pos", F.to_json("attrs").alias("attrs")
    )


def raw_record_readings(records: DataFrame) -> DataFrame:
    """record_id, reason of every record: why its latest payload can't be read, null where it can."""
    latest = latest_payloads(records, "record_id", "payload", "received_at")
    return rejected(latest, "key", "payload", every=True).select(F.col("key").alias("record_id"), "reason")


def found(records: DataFrame) -> DataFrame:
    """Text items of sections, their table rows and the rows of the payloads' own tables, each with its parent."""
    at = lambda i, what: F.element_at("lineage", i)[what]
    item = (F.col("relation") == "text_items") & (F.col("parent_relation") == "sections")
    item_row = (F.col("relation") == "rows") & (F.col("parent_relation") == "text_items") & (F.size("lineage") >= 3)
    table_row = (F.col("relation") == "rows") & (F.col("parent_relation") == "tables")
    return (
        raw_record_nodes(records, {"text_items", "rows"})
        .where(item | item_row | table_row)
        .select(
            F.col("record_key").cast("bigint").alias("record_id"),
            F.when(item_row, F.try_element_at("lineage", F.lit(-2))["key"]).otherwise(at(-1, "key")).alias("parent_id"),
            F.when(item, F.col("pos")).when(item_row, at(-1, "pos")).otherwise(-1).cast("int").alias("item_no"),
            F.when(item, -1).otherwise(F.col("pos")).cast("int").alias("row_no"),
        )
    )
