import json

from sheafline.operators import inlining as I

NAMING = I.Naming(aliases={"parts": "items"}, transparent=frozenset({"wrap"}), member={"rows": "cells"}, keys={"items": "id"})


def frame(spark, payloads):
    return spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "id bigint, payload string")


def test_relations_shared_repeated_recursive(spark):
    p = [json.dumps({"a": {"x": {"v": 1}}, "b": {"x": {"v": 2}}, "list": [{"n": 1}], "tree": {"tree": {"tree": None}}})]
    got = I.relations_of(I.schema_graph(frame(spark, p), "payload"))
    assert got == {"record", "x", "list", "tree"}


def test_variants_of_a_list_meet(spark):
    payloads = [
        json.dumps({"items": [{"id": "a", "rows": [["1", "2"], {"cells": ["3"]}]}, {"id": "b"}]}),
        json.dumps({"wrap": {"parts": {"id": "c"}}}),
        json.dumps({"items": json.dumps([{"id": "d"}, None])}),
        json.dumps({"items": None}),
        '{"items": [{"id": "cut',
        "",
        None,
        "[1, 2]",
    ]
    df = frame(spark, payloads)
    edges = I.schema_graph(df, "payload", NAMING)
    nodes = I.shred(df, "id", "payload", edges, NAMING)
    items = {(r.record_key, r.pos, r.id) for r in I.relation(nodes, "items", ["id"]).collect()}
    assert items == {("0", 0, "a"), ("0", 1, "b"), ("1", 0, "c"), ("2", 0, "d"), ("2", 1, None)}
    rows = {(r.record_key, r.pos, r.lineage[-1].key) for r in nodes.where("relation = 'rows'").collect()}
    assert rows == {("0", 0, "a"), ("0", 1, "a")}
    ids = [r.node_id for r in nodes.collect()]
    assert len(ids) == len(set(ids))
    parents = {r.node_id for r in nodes.collect()} | {None}
    assert all(r.parent_node in parents for r in nodes.collect())


def test_empty_and_deep(spark):
    df = frame(spark, [])
    assert I.schema_graph(df, "payload") == []
    assert I.shred(df, "id", "payload", []).count() == 0
    deep = "1"
    for _ in range(60):
        deep = json.dumps({"n": json.loads(deep)})
    d = frame(spark, [deep])
    nodes = I.shred(d, "id", "payload", I.schema_graph(d, "payload"))
    assert nodes.count() == 61  # n holds itself: every level is a node, below the record


def test_latest_payload_wins_and_null_keys_stay_apart(spark):
    df = spark.createDataFrame(
        [(1, "old", 1, "x"), (1, "new", 2, "x"), (1, "new", 2, "x"), (None, "p", 1, "x"), (None, "q", 1, "x")], "key bigint, payload string, at int, apart string"
    )
    got = sorted(map(tuple, I.latest_payloads(df, "key", "payload", "at").collect()), key=str)
    assert got == [(1, "new"), (None, "p"), (None, "q")]


def test_clashing_attribute_names(spark):
    df = frame(spark, [json.dumps({"items": [{"pos": 7, "node_id": "x"}]})])
    nodes = I.shred(df, "id", "payload", I.schema_graph(df, "payload"))
    row = I.relation(nodes, "items", ["pos", "node_id"]).first()
    assert (row.pos, row.attr_pos, row.attr_node_id) == (0, "7", "x")


def test_unreadable_payloads_are_named(spark):
    deep = '{"n": ' * 200_000 + "1" + "}" * 200_000
    df = frame(spark, [deep, None, " ", "{", "7", "{}", "[]"])
    got = {r.id: r.reason for r in I.rejected(df, "id", "payload").collect()}
    assert got == {0: "nested too deep", 1: "empty", 2: "empty", 3: "not JSON", 4: "no object"}
    assert {r.record_key for r in I.shred(df, "id", "payload", I.schema_graph(df, "payload")).collect()} == {"5", "6"}


def test_relations_give_the_record_back(spark):
    record = {"title": "t", "sections": [{"name": "a", "parts": [{"v": "1"}, {"v": "2", "parts": [{"v": "3"}]}]}, {"name": "b", "place": {"page": "4", "box": {"x": "5"}}}], "meta": {"by": "z"}}
    df = frame(spark, [json.dumps(record)])
    nodes = [r.asDict() for r in I.shred(df, "id", "payload", I.schema_graph(df, "payload")).collect()]

    def build(node):
        out = {}
        for path, value in node["attrs"].items():
            at = out
            *above, last = path.split(".")
            for a in above:
                at = at.setdefault(a, {})
            at[last] = value
        for child in sorted((n for n in nodes if n["parent_node"] == node["node_id"]), key=lambda n: n["pos"]):
            out.setdefault(child["relation"], []).append(build(child))
        return out

    assert build(next(n for n in nodes if n["parent_node"] is None)) == record
