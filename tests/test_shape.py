from pyspark.sql import functions as F

from snapmetrics.operators.shape import explode_child, flatten, parse_json_field, rename_map, root_select, union_all


def test_flatten_nested_paths_and_null_parent(spark):
    df = spark.createDataFrame(
        [(1, ("s", 5, ("o",)), [1, 2]), (2, None, [])],
        "block int, subgraph struct<id:string, n:int, owner:struct<id:string>>, xs array<int>",
    )
    flat = flatten(df)
    assert flat.columns == ["block", "subgraph_id", "subgraph_n", "subgraph_owner_id", "xs"]
    rows = sorted(flat.collect())
    assert rows[0].subgraph_owner_id == "o" and rows[0].xs == [1, 2]
    assert rows[1].subgraph_id is None and rows[1].subgraph_owner_id is None


def test_explode_child_keeps_empty_and_null_lists_x7(spark):
    df = spark.createDataFrame(
        [("a", [("v1",), ("v2",)]), ("b", []), ("c", None)], "id string, versions array<struct<id:string>>"
    )
    got = sorted((r.id, r.versions_id) for r in explode_child(df, "versions").collect())
    assert got == [("a", "v1"), ("a", "v2"), ("b", None), ("c", None)]


def test_rename_map_ignores_missing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rename_map(df, {"a": "x", "zz": "y"}).columns == ["x", "b"]


def test_union_by_name_fills_missing_x8(spark):
    a = spark.createDataFrame([(1, "p")], "block int, x string")
    b = spark.createDataFrame([(2, 3)], "block int, y int")
    got = sorted(tuple(r) for r in union_all([a, b]).select("block", "x", "y").collect())
    assert got == [(1, "p", None), (2, None, 3)]


def test_root_select_and_json_field(spark):
    df = spark.createDataFrame([(1, ("1", "10"))], "block int, graphNetwork struct<id:string, v:string>")
    assert root_select(df, "graphNetwork").columns == ["block", "id", "v"]
    j = spark.createDataFrame([('{"k": 42}',), ('{"q": 1}',)], "props string")
    assert [r.k for r in j.select(parse_json_field("props", "k").alias("k")).collect()] == [42, None]
