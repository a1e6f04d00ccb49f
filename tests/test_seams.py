"""Providers, stage tables and the pattern language."""

import pytest
from pyspark.sql import functions as F

from convograph import providers as P
from convograph.operators.store import Graph, limited_properties
from convograph.plans import patterns
from convograph.sources import stages


def test_registry_and_strategies(spark):
    assert P.registry.names("llm") == ["echo"]
    d = spark.createDataFrame([("a",), ("a",), (None,)], "p string")
    rows = P.complete(d, "p", P.registry.create("llm", "echo")).collect()
    assert [r.answer is None for r in rows] == [False, False, True] and rows[0].answer == rows[1].answer
    assert len(P.embed(d, "p", lambda t: [[float(len(x))] for x in t]).collect()) == 3
    v = d.where("p = 'a'").select(P.registry.create("embedding", "digest", dimension=20)(F.col("p")).alias("v")).first().v
    assert len(v) == 20 and abs(sum(x * x for x in v) - 1) < 1e-9
    with pytest.raises(ValueError):
        P.registry.create("llm", "none")
    with pytest.raises(ValueError):
        P.strategy("none")
    a, b = spark.createDataFrame([("X", 1)], "name string, v int"), spark.createDataFrame([("x", 2), ("y", 3)], "name string, v int")
    assert sorted(tuple(r) for r in P.strategy("dual")(a, b).collect()) == [("X", 1), ("y", 3)]
    assert not P.flag(spark, "none") and P.flag(spark, "none", True)


def test_stage_tables(spark, tmp_path):
    d = spark.createDataFrame([(1, "a"), (2, "b")], "item int, v string")
    stages.save(d.where("item = 1"), str(tmp_path), "one")
    one = stages.load(spark, str(tmp_path), "one")
    assert stages.damaged(one).count() == 0
    assert stages.damaged(one.withColumn("v", F.lit("z"))).count() == 1
    assert [r.item for r in stages.pending(d, one, "item").collect()] == [2]
    assert {"extraction_mode", "segment_index", "version"} <= set(stages.upgraded(one).columns)
    assert stages.retained(one, 1, "2100-01-01").count() == 0
    p = spark.createDataFrame([("e", "a", 1), ("e", "b", 2), ("f", "done", 3)], "item string, stage string, at int")
    assert [(r.item, r.stage) for r in stages.latest(p, "item", "stage", "at", "done").collect()] == [("e", "b")]


def test_patterns(spark):
    nodes = spark.createDataFrame([("1", "Person", "Ann", {"age": "3"}), ("2", "City", "Oslo", {})], "id string, type string, name string, props map<string,string>")
    edges = spark.createDataFrame([("1", "2", "LIVES_IN", 1.0), ("2", "1", "HAS", 1.0)], "src string, dst string, type string, weight double")
    g = Graph(nodes, edges)
    assert patterns.match(g, "MATCH (p:Person {age: $a}) RETURN p", {"a": 3}).first().id == "1"
    assert [r.dst for r in patterns.match(g, "MATCH (a:Person)-[r:LIVES_IN]->(b:City) RETURN a, b").collect()] == ["2"]
    with pytest.raises(ValueError):
        patterns.match(g, "CREATE (n)")
    got = patterns.generic("MATCH (e:Entity {name: $n})-[:MENTIONS]-(s:Segment) RETURN e.entity_type", ("Entity", "Segment"), {"entity_type": "type"})
    assert got == "MATCH (e:Node {_type: 'Entity', name: $n})-[:RELATIONSHIP {_type: 'MENTIONS'}]-(s:Node {_type: 'Segment'}) RETURN e.type"
    assert g.find(patterns.compiled("exists", "City", text="osl")).first()[0]
    m = {f"k{i:02d}": "v" for i in range(60)} | {"name": "n"}
    kept = spark.createDataFrame([(m,)], "p map<string,string>").select(limited_properties(F.col("p")).alias("p")).first().p
    assert len(kept) == 50 and "name" in kept and "k48" in kept and "k49" not in kept


def test_prompts_settings_and_observations(spark, tmp_path):
    p = P.Prompts()
    p.register("a", "x {b} y", "1.0")
    p.register("a", "z {b}", "1.2")
    rows = spark.createDataFrame([("{c}",), (None,)], "b string").select(p.build("a", b=F.col("b")).alias("t"), p.build("a", "1.0", b=F.col("b")).alias("u")).collect()
    assert [tuple(r) for r in rows] == [("z {c}", "x {c} y"), ("z ", "x  y")] and p.versions("a") == ["1.0", "1.2"]
    with pytest.raises(ValueError, match="needs b"):
        p.build("a")
    with pytest.raises(ValueError, match="no prompt"):
        p.build("a", "2.0", b=F.lit(1))
    with pytest.raises(ValueError, match="pooling"):
        P.embed(spark.range(1), "id", list, pooling="sum")
    f = tmp_path / "s.json"
    f.write_text('{"a": 2}')
    assert P.settings(str(f), {"a": 1, "b": 3}) == {"a": 2, "b": 3}
    with pytest.raises(ValueError, match="unknown settings: a"):
        P.settings(str(f), {"b": 3})
    with pytest.raises(FileNotFoundError):
        P.settings(str(tmp_path / "none"))

    d, seen = P.observed(spark.range(7), "step")
    assert len(d.collect()) == 7 and seen.get["rows"] == 7


def test_export_of_stages(spark, tmp_path):
    for name in ("one", "two"):
        stages.save(spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "item int, kind string"), f"{tmp_path}/from", name)
    stages.export(spark, f"{tmp_path}/from", ["one", "two"], spark.createDataFrame([(2,), (2,)], "item int"), "item", f"{tmp_path}/to")
    two = stages.load(spark, f"{tmp_path}/to", "two")
    assert two.count() == 2 and stages.damaged(two).count() == 0
    assert {(r.type, r.rows) for r in stages.types_over_time(stages.load(spark, f"{tmp_path}/from", "one"), "kind").collect()} == {("a", 1), ("b", 2)}


def test_command_line(spark, tmp_path, capsys):
    from convograph.__main__ import main

    assert main(["list"]) == 0 and "entity_mentions" in capsys.readouterr().out.split()
    assert main(["run", "none", "x", "y"]) == 1
    assert main(["run", "label_counts", "/root/testdata/sf0.001", str(tmp_path / "out")]) == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0
    assert main(["check", str(tmp_path / "none.json")]) == 1


def test_settings_of_yaml(tmp_path):
    pytest.importorskip("yaml")
    f = tmp_path / "s.YAML"
    f.write_text("a: 2\nc: [x, 1]\n")
    assert P.settings(str(f), {"a": 1, "b": 3, "c": None}) == {"a": 2, "b": 3, "c": ["x", 1]}
    with pytest.raises(ValueError, match="unknown settings: c"):
        P.settings(str(f), {"a": 1})
    f.write_text("")
    assert P.settings(str(f), {"a": 1}) == {"a": 1}
    f.write_text("- 1")
    with pytest.raises(ValueError, match="names and values"):
        P.settings(str(f))
