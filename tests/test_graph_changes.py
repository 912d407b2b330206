import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import (ForeignKey, Many, Node, One, TableSpec, apply_changes, fill_self_reference, flatten_graph,
                      merge_graph)
from tidemark.operators import ancestry, cascade_delete_tree, table_groups, topological_order, tree
from tidemark.sources import stage
from tidemark.operators.changeset import publish_order
from tidemark.operators.graph import graph_stats
from tidemark.plans import QUERIES

# Voyages of a ship, with the legs they call at; a leg may name the pilot taken aboard. One voyage has neither ship nor legs,
# two share a ship, two legs of one share a pilot.
NEST = """title string, ship struct<call_sign: string>,
 legs array<struct<harbour: string, hours: int, pilot: struct<licence: string>>>, place int"""
VOYAGES = [
    ("idle", None, [], 1),
    ("west", ("LM2",), [("Tiree", 14, ("p-12",))], 2),
    ("ring", ("LM2",), [("Oban", 31, None), ("Mallaig", 9, ("p-40",)), ("Coll", 3, ("p-40",))], 3),
]


def generated(name, **relations):
    return Node(TableSpec(name, key=("id",), identity="id"), **relations)


SHIP, PILOT = generated("ship", match_on=("call_sign",)), generated("pilot", match_on=("licence",))
LEG = generated("leg", one=(One("pilot", PILOT, "pilot_id"),))
VOYAGE = generated("voyage", one=(One("ship", SHIP, "ship_id"),), many=(Many("legs", LEG, "voyage_id"),))


@pytest.fixture
def empty(spark):
    return {
        "ship": spark.createDataFrame([], "id bigint, call_sign string"),
        "pilot": spark.createDataFrame([], "id bigint, licence string"),
        "leg": spark.createDataFrame([], "id bigint, voyage_id bigint, pilot_id bigint, harbour string, hours int"),
        "voyage": spark.createDataFrame([], "id bigint, ship_id bigint, title string"),
    }


def test_an_uneven_graph(spark, empty):
    results = merge_graph(spark.createDataFrame(VOYAGES, NEST), VOYAGE, empty, ordinal="place")
    assert list(results) == ["ship", "voyage", "pilot", "leg"]
    assert {n: r.stats.first()["inserted"] for n, r in results.items()} == {"ship": 1, "voyage": 3, "pilot": 2, "leg": 4}
    assert graph_stats(results).first().asDict() == {"inserted": 10, "updated": 0, "deleted": 0}
    assert rows(results["voyage"].result, "id", "title", "ship_id") == [(1, "idle", None), (2, "west", 1), (3, "ring", 1)]
    aboard = results["leg"].result.join(results["pilot"].result.withColumnRenamed("id", "pid"), F.col("pilot_id") == F.col("pid"), "left")
    assert rows(aboard, "voyage_id", "harbour", "licence") == [(2, "Tiree", "p-12"), (3, "Coll", "p-40"), (3, "Mallaig", "p-40"), (3, "Oban", None)]


def test_empty_arrays_and_missing_references(spark, empty):
    nested = spark.createDataFrame([("a", None, [], 1), ("b", ("x",), None, 2), ("c", None, [("s", 1, None)], 3)], NEST)
    results = merge_graph(nested, VOYAGE, empty, ordinal="place")
    assert rows(results["voyage"].result, "title", "ship_id") == [("a", None), ("b", 1), ("c", None)]
    assert rows(results["leg"].result, "voyage_id", "pilot_id") == [(3, None)]


@pytest.mark.parametrize("ordinal, places", [("at", [1.2, 1.7, 1.7]), ("at", ["x", "x", "x"]), (None, [0, 0, 0])])
def test_ordinals_of_any_kind_keep_children_apart(spark, empty, ordinal, places):
    kind = {float: "double", str: "string", int: "int"}[type(places[0])]
    nested = spark.createDataFrame(
        [(t, None, [(f"{t}{n}", n, None) for n in range(2)], p) for t, p in zip("abc", places)], NEST.replace("place int", f"at {kind}"))
    results = merge_graph(nested.drop("at") if ordinal is None else nested, VOYAGE, empty, ordinal=ordinal)
    voyages = results["voyage"].result.withColumnRenamed("id", "vid")
    found = results["leg"].result.join(voyages, F.col("voyage_id") == F.col("vid"))
    assert rows(found, "title", "harbour") == [(t, f"{t}{n}") for t in "abc" for n in range(2)]
    assert voyages.select("vid").distinct().count() == 3


def test_every_column_of_a_key_is_handed_down(spark):
    berth = Node(TableSpec("berth", key=("berth_no",)))
    pier = Node(TableSpec("pier", key=("town", "pier_no")), many=(Many("berths", berth, ("in_town", "on_pier")),))
    nested = spark.createDataFrame([("Oban", 1, [(10,), (11,)]), ("Oban", 2, [(12,)])], "town string, pier_no int, berths array<struct<berth_no: int>>")
    targets = {"pier": spark.createDataFrame([], "town string, pier_no int"),
               "berth": spark.createDataFrame([], "berth_no int, in_town string, on_pier int")}
    assert rows(merge_graph(nested, pier, targets)["berth"].result) == [(10, "Oban", 1), (11, "Oban", 1), (12, "Oban", 2)]
    with pytest.raises(ValueError, match="2 columns, not 1"):
        flatten_graph(nested, Node(pier.spec, many=(Many("berths", berth, "on_pier"),)))


def test_rows_without_a_natural_key_stay_apart(spark):
    agent = Node(TableSpec("agent", key=("id",), identity="id"), match_on=("name",))
    cargo = Node(TableSpec("cargo", key=("code",)), one=(One("agent", agent, "agent_id"),))
    nested = spark.createDataFrame([("c1", (None,), 1), ("c2", (None,), 2), ("c3", ("Ann",), 3), ("c4", ("Ann",), 4)], "code string, agent struct<name: string>, place int")
    targets = {"agent": spark.createDataFrame([], "id bigint, name string"), "cargo": spark.createDataFrame([], "code string, agent_id bigint")}
    results = merge_graph(nested, cargo, targets, ordinal="place")
    held = dict(results["cargo"].result.select("code", "agent_id").collect())
    assert results["agent"].result.count() == 3 and len({held["c1"], held["c2"], held["c3"]}) == 3 and held["c3"] == held["c4"]


def test_children_of_parents_that_are_there(spark):
    crate = Node(TableSpec("crate", key=("code",)))
    hold = Node(TableSpec("hold", key=("id",), identity="id"), match_on=("label",), many=(Many("crates", crate, "hold_id"),))
    nested = spark.createDataFrame([("aft", [("k1",)], 1), ("bow", [("k2",)], 2)], "label string, crates array<struct<code: string>>, place int")
    targets = {"hold": spark.createDataFrame([(7, "aft")], "id bigint, label string"), "crate": spark.createDataFrame([], "code string, hold_id bigint")}
    results = merge_graph(nested, hold, targets, "insert_absent", ordinal="place")
    assert rows(results["crate"].result) == [("k1", 7), ("k2", 8)] and rows(results["hold"].result) == [(7, "aft"), (8, "bow")]


def test_an_update_hands_natural_keys_down(spark):
    tide = Node(TableSpec("tide", key=("tide_no",)))
    gauge = Node(TableSpec("gauge", key=("gauge_no",)), many=(Many("tides", tide, "gauge_no"),))
    read = spark.createDataFrame(  # not in the table's order
        [(44, "inner", [(902, 3.5), (903, 0.4)]), (21, "outer", [(801, 2.25)])], "gauge_no int, site string, tides array<struct<tide_no: int, height: double>>")
    targets = {"gauge": spark.createDataFrame([(21, "outer"), (44, "old wall"), (45, "buoy")], "gauge_no int, site string"),
               "tide": spark.createDataFrame([(801, 21, 2.25), (902, 44, 9.0), (903, 45, 0.4)], "tide_no int, gauge_no int, height double")}
    results = merge_graph(read, gauge, targets, "update")
    assert rows(results["gauge"].result) == [(21, "outer"), (44, "inner"), (45, "buoy")]
    assert rows(results["tide"].result) == [(801, 21, 2.25), (902, 44, 3.5), (903, 44, 0.4)]
    assert graph_stats(results).first() == (0, 3, 0)
    assert rows(flatten_graph(read, gauge)["tide"].rows, "tide_no", "gauge_no") == [(801, 21), (902, 44), (903, 44)]


def test_a_table_that_refers_to_itself(spark):
    inner = Node(TableSpec("region", key=("id",), identity="id"), match_on=("name",))
    outer = Node(inner.spec, match_on=("name",), one=(One("within", inner, "within_id"),))
    nested = spark.createDataFrame([("strait", ("sea",), 1), ("sea", None, 2), ("narrows", ("strait",), 3)],
                                   "name string, within struct<name: string>, place int")
    target = {"region": spark.createDataFrame([(5, "sea", None)], "id bigint, name string, within_id bigint")}
    result = merge_graph(nested, outer, target, ordinal="place", exclude_on_update=["within_id"])["region"].result
    found = {r["name"]: r for r in result.collect()}
    assert len(found) == 3 and found["sea"]["id"] == 5
    assert found["strait"]["within_id"] == 5 and found["narrows"]["within_id"] == found["strait"]["id"]


def test_second_pass_over_a_table(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "a"), (3, "c", "zz")], "id int, name string, parent string")
    assert rows(fill_self_reference(df, "id", ["name"], ["parent"], "parent_id"), "id", "parent_id") == [
        (1, None), (2, 1), (3, None)]


def test_graphs_are_not_deleted(spark, empty):
    with pytest.raises(ValueError, match="not 'delete'"):
        merge_graph(spark.createDataFrame(VOYAGES, NEST), VOYAGE, empty, "delete")


# --- change sets ----------------------------------------------------------------------


def test_topological_order():
    keys = [ForeignKey("line", "o", "orders"), ForeignKey("orders", "c", "customer"), ForeignKey("customer", "p", "customer")]
    assert topological_order(["line", "orders", "customer"], keys) == ["customer", "orders", "line"]
    circle = [ForeignKey("a", "x", "b"), ForeignKey("b", "x", "c"), ForeignKey("c", "x", "a"), ForeignKey("c", "y", "d"), ForeignKey("e", "y", "b")]
    assert table_groups(["e", "a", "b", "c", "d"], circle) == [["d"], ["a", "b", "c"], ["e"]]
    assert topological_order(["e", "a", "b", "c", "d"], circle) == ["d", "a", "b", "c", "e"]


def test_a_circle_of_tables(spark):
    """A club names its captain, a member the club and a mentor among the members; a prize, outside the circle, its winner."""
    targets = {"club": spark.createDataFrame([(7, "old", 3)], "id bigint, name string, captain bigint"),
               "member": spark.createDataFrame([(3, "Ida", 7, None)], "id bigint, name string, club bigint, mentor bigint"),
               "prize": spark.createDataFrame([], "title string, winner bigint")}
    changes = {
        "prize": spark.createDataFrame([("cup", 20, "I"), ("none", None, "I")], "title string, who int, op string"),
        "club": spark.createDataFrame([(None, "new", 20, 1, None, "I"), (None, "empty", None, 2, None, "I"), (7, "older", None, 3, 3, "U")],
                                      "id bigint, name string, lead int, place int, captain bigint, op string"),
        "member": spark.createDataFrame([(None, "Una", 1, None, 20, None, "I"), (None, "Bo", 1, 20, 21, None, "I"), (None, "Cy", None, 21, 22, 7, "I"), (3, None, None, None, None, None, "D")],
                                        "id bigint, name string, of int, by int, place int, club bigint, op string"),
    }
    specs = {n: TableSpec(n, key=("id",), identity="id") for n in ("club", "member")} | {"prize": TableSpec("prize", key=("title",))}
    keys = [ForeignKey("club", "captain", "member", "lead"), ForeignKey("member", "club", "club", "of"), ForeignKey("member", "mentor", "member", "by"), ForeignKey("prize", "winner", "member", "who")]
    done = apply_changes(targets, changes, specs, keys, ordinal={"club": "place", "member": "place"})
    assert list(done) == ["club", "member", "prize"]
    assert rows(done["club"].result) == [(7, "older", 3), (8, "new", 4), (9, "empty", None)]
    assert rows(done["member"].result) == [(4, "Una", 8, None), (5, "Bo", 8, 4), (6, "Cy", 7, 5)]
    assert rows(done["prize"].result) == [("cup", 4), ("none", None)]


def _below(parent, marks):
    """Keys of marked rows and all rows below them, by walking up from each."""
    out = set()
    for k in parent:
        seen, at = set(), k
        while at in parent and at not in seen:
            seen.add(at)
            if at in marks:
                out.add(k)
                break
            at = parent[at]
    return out


@pytest.mark.parametrize("seed", range(3))
def test_trees_of_any_depth(spark, seed):
    random.seed(seed)
    parent = {i: random.choice([i - 1, i - 1, random.randrange(i), None, 9999]) if i else None for i in range(300)}
    parent |= {1000 + i: 999 + i if i else None for i in range(130)}  # one chain
    marks = set(random.sample(sorted(parent), 8)) | {1064}
    df = spark.createDataFrame([(k, p, f"r{k}") for k, p in parent.items()] + [(None, 1100, "loose"), (None, 1001, "stays")], "id int, up int, name string").repartition(3)
    gone = spark.createDataFrame([(m,) for m in marks] + [(None,), (5555,)], "id int")
    left = cascade_delete_tree(df, "id", "up", gone)
    below = _below(parent, marks)
    assert rows(left, "id", "name") == sorted([(k, f"r{k}") for k in parent if k not in below]) + ([] if 1001 in below else [(None, "stays")])

    def walk(k):
        n = 0
        while parent.get(k) in parent:
            k, n = parent[k], n + 1
        return k, n

    found = {r["id"]: (r["root"], r["depth"]) for r in ancestry(df, "id", "up").collect()}
    assert found == {k: walk(k) for k in parent}


def test_rounds_grow_with_the_logarithm_of_the_depth(spark, monkeypatch):
    written = []
    monkeypatch.setattr(tree, "stage", lambda df, label: (written.append(label), stage(df, label))[1])
    chain = spark.range(1000).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("up"))
    assert ancestry(chain, "id", "up").agg(F.max("depth")).first()[0] == 999 and len(written) <= 12


def test_circles_of_rows(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 3), (5, None), (6, 5), (7, 7), (8, 7)], "id int, up int")
    with pytest.raises(ValueError, match="circle"):
        ancestry(df, "id", "up")
    assert {r["id"]: (r["root"], r["depth"]) for r in ancestry(df, "id", "up", circles=True).collect()} == {
        1: (None, None), 2: (None, None), 3: (None, None), 4: (None, None), 5: (5, 0), 6: (5, 1), 7: (None, None), 8: (None, None)}
    gone = spark.createDataFrame([(2,), (6,)], "id int")
    assert rows(cascade_delete_tree(df, "id", "up", gone), "id") == [(5,), (7,), (8,)]
    assert cascade_delete_tree(df.limit(0), "id", "up", gone).count() == 0
    with pytest.raises(PySparkException, match="more than one"):
        ancestry(df.union(df), "id", "up", circles=True).collect()


def test_missing_names_are_not_gathered(spark):
    df = spark.createDataFrame([(i, None if i % 3 else f"n{i}", f"n{i - i % 5}") for i in range(60)], "id int, name string, of string")
    filled = fill_self_reference(df, "id", ["name"], ["of"], "parent")
    named = {f"n{i}": i for i in range(60) if i % 3 == 0}
    assert {r["id"]: r["parent"] for r in filled.collect()} == {i: named.get(f"n{i - i % 5}") for i in range(60)}
    plan = filled._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("isnotnull(name")  # below the numbering


def test_two_rounds_of_changes(spark):
    spec = {"buoy": TableSpec("buoy", key=("id",), identity="id")}
    laid = spark.range(300).select(F.lit(None).cast("bigint").alias("id"), F.format_string("laid-%03d", "id").alias("mark"), F.lit("I").alias("op"), "id")
    laid = laid.toDF("id", "mark", "op", "seq")
    step = apply_changes({"buoy": spark.createDataFrame([(40, "first")], "id bigint, mark string")}, {"buoy": laid}, spec, ordinal={"buoy": "seq"})["buoy"].staged()
    assert step.stats.first() == (300, 0, 0) and step.result.agg(F.min("id"), F.max("id")).first() == (40, 340)
    moved = step.result.filter("id % 50 = 0").select("id", F.upper("mark").alias("mark"), F.lit("U").alias("op"), F.col("id").alias("seq"))
    lost = spark.createDataFrame([(40, None, "D", 0), (7, None, "D", 0), (8, "nobody", "U", 0)], "id bigint, mark string, op string, seq bigint")
    more = laid.filter("seq < 25").withColumn("mark", F.concat(F.lit("more-"), "mark"))
    step = apply_changes({"buoy": step.result}, {"buoy": more.union(moved).union(lost)}, spec, ordinal={"buoy": "seq"})["buoy"].staged()
    assert step.stats.first() == (25, 6, 1)
    assert step.result.filter("mark LIKE 'LAID-%'").count() == 6 and step.result.agg(F.max("id"), F.count_distinct("id")).first() == (365, 325)


@pytest.mark.parametrize("op, id_, message", [("u", 1, "neither I, U nor D but u"), (None, 1, "neither I, U nor D but NULL"), ("I", 1, "already has a row to be inserted")])
def test_change_rows_that_cannot_be_applied_fail(spark, op, id_, message):
    spec = {"buoy": TableSpec("buoy", key=("id",))}
    target = {"buoy": spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, mark string")}
    change = {"buoy": spark.createDataFrame([(id_, "x", op)], "id bigint, mark string, op string")}
    for look in (lambda r: r.result.count(), lambda r: r.stats.collect(), lambda r: r.changes.collect()):
        with pytest.raises(PySparkException, match=message):
            look(apply_changes(target, change, spec)["buoy"])


def test_an_ordinal_that_repeats_names_no_parent(spark):
    specs = {"hold": TableSpec("hold", key=("id",), identity="id"), "crate": TableSpec("crate", key=("code",))}
    targets = {"hold": spark.createDataFrame([], "id bigint, label string"), "crate": spark.createDataFrame([], "code string, hold_id bigint")}
    changes = {"hold": spark.createDataFrame([(None, "a", 1, "I"), (None, "b", 1, "I")], "id bigint, label string, place int, op string"),
               "crate": spark.createDataFrame([("k", 1, "I")], "code string, of int, op string")}
    with pytest.raises(PySparkException, match="more than one source row"):
        apply_changes(targets, changes, specs, [ForeignKey("crate", "hold_id", "hold", "of")], ordinal={"hold": "place"})["crate"].result.collect()


def test_generated_parent_keys_reach_the_children(spark):
    specs = {"parent": TableSpec("parent", key=("id",), identity="id"), "child": TableSpec("child", key=("code",))}
    targets = {"parent": spark.createDataFrame([(10, "old")], "id bigint, label string"),
               "child": spark.createDataFrame([("x", 10)], "code string, parent_id bigint")}
    changes = {
        "child": spark.createDataFrame([("a", 2, None, "I"), ("b", 1, None, "I"), ("c", None, 10, "I"), ("x", 2, None, "U")],
                                       "code string, parent_place int, parent_id bigint, op string"),
        "parent": spark.createDataFrame([(None, "first", 1, "I"), (None, "second", 2, "I")],
                                        "id bigint, label string, place int, op string"),
    }
    results = apply_changes(targets, changes, specs, [ForeignKey("child", "parent_id", "parent", "parent_place")],
                            ordinal={"parent": "place"})
    assert list(results) == ["parent", "child"]
    assert publish_order(results, deletions=True) == ["child", "parent"]
    assert rows(results["child"].result, "code", "parent_id") == [("a", 12), ("b", 11), ("c", 10), ("x", 12)]


def test_keys_that_compress_well_are_not_broadcast(spark, empty):
    """The driver holds what is broadcast; a file of consecutive numbers is a small part of its rows."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        lines = F.array(F.struct(F.col("id").alias("n")))
        nested = spark.range(60_000).select((-F.col("id")).alias("place"), lines.alias("lines"))
        line = Node(TableSpec("line", key=("sheet_id", "n")))
        sheet = Node(TableSpec("sheet", key=("id",), identity="id"), many=(Many("lines", line, "sheet_id"),))
        targets = {"sheet": spark.createDataFrame([], "id bigint, place bigint"), "line": spark.createDataFrame([], "sheet_id bigint, n bigint")}
        found = merge_graph(nested, sheet, targets, "upsert", ordinal="place")["line"].result
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
        assert found.filter(F.col("n") + F.col("sheet_id") == 60_000).count() == 60_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_children_of_few_parents_are_not_broadcast(spark):
    """An exploded array is a hundred times what its file is; it must not reach the driver because the parents are few."""
    what = F.transform(F.sequence(F.lit(1), F.lit(100)), lambda n: F.struct(n.alias("n")))
    nested = spark.range(2_000).select((-F.col("id")).alias("place"), what.alias("lines"))
    line = Node(TableSpec("line", key=("sheet_id", "n")))
    sheet = Node(TableSpec("sheet", key=("id",), identity="id"), many=(Many("lines", line, "sheet_id"),))
    targets = {"sheet": spark.createDataFrame([], "id bigint, place bigint"), "line": spark.createDataFrame([], "sheet_id bigint, n int")}
    for ordinal in ("place", None):
        found = merge_graph(nested, sheet, targets, "upsert", ordinal=ordinal)["line"].result
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 200_000 and found.select("sheet_id").distinct().count() == 2_000


@pytest.mark.parametrize("name", ["graph_without_ordinal", "graph_repeated_ordinal"])
def test_due_dates_are_found_without_a_broadcast(spark, name):
    assert "Broadcast" not in QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


def test_keys_of_change_rows_are_not_broadcast(spark):
    """They are stored consecutive numbers as well."""
    talks = spark.range(3_000).select(F.lit(None).cast("bigint").alias("id"), F.col("id").alias("place"), F.lit("I").alias("op"))
    turns = spark.range(9_000).select((F.col("id") % 3_000).alias("talk"), F.col("id").alias("turn"), F.lit("I").alias("op"))
    targets = {"talk": spark.createDataFrame([], "id bigint"), "turn": spark.createDataFrame([], "talk_id bigint, turn bigint")}
    specs = {"talk": TableSpec("talk", key=("id",), identity="id"), "turn": TableSpec("turn", key=("talk_id", "turn"))}
    found = apply_changes(targets, {"talk": talks, "turn": turns}, specs, [ForeignKey("turn", "talk_id", "talk", reference="talk")],
                          ordinal={"talk": "place"})["turn"].result
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.filter(F.col("turn") % 3_000 + 1 == F.col("talk_id")).count() == 9_000
