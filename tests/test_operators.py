import json
import time

import pytest
from pyspark.sql import functions as F

from loomspar import errors
from loomspar.engine import Engine, Options
from loomspar.functions import fuzzy
from loomspar.operators import binding, bulk, hierarchy, lookups, validation
from loomspar.operators.cells import cells, system_field
from loomspar.sources import readers, sink
from loomspar.sources.catalog import Catalog, PagesSource
from loomspar.sources.manifests import ManifestStore
from loomspar.streaming.progress import ExpiringCache, track


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def records(spark, *items):
    return readers.read_records(spark, data=list(items))


FIELDS = "project string, issue_type string, pos int, field_id string, name string, type string, items string"


def test_cells_keep_order(spark):
    got = cells(spark.createDataFrame([(1, '{"b": 1, "a": "x", "Is_sue Type": {"name": " T "}}'), (2, "[1]"), (3, '{"a":1,"a":2}')], "row_index bigint, raw string"))
    assert [(r.pos, r.key, r.norm_key, r.kind) for r in got.orderBy("row_index", "pos").collect()] == [(0, "b", "b", "number"), (1, "a", "a", "string"), (2, "Is_sue Type", "issuetype", "object"), (0, "a", "a", "number"), (1, "a", "a", "number")]
    assert rows(system_field(got, "issuetype"), "key", "extracted") == [("Is_sue Type", "T")]


def test_validation_rules(spark):
    dim = spark.createDataFrame(
        [("P", "Task", "Summary", "string", True, None), ("P", "Task", "Prio", "priority", False, [("1", "High")]), ("P", "Task", "Tags", "array", False, [("1", "a"), ("2", "b")])],
        "project_key string, issue_type string, name string, type string, required boolean, allowed array<struct<id:string,name:string>>",
    )
    recs = records(
        spark, {"Project": "p", "Type": "task", "summary": "s", "Prio": "HIGH", "Tags": ["a", "1"]}, {"Project": "P", "Issue Type": "Task", "Prio": {"name": "low"}, "Tags": ["z"], "Odd": 1}, {"Summary": "x"}, {"Project": "Q", "Type": "Task"}, {"Project": "P", "Type": "Epic"}, {"Project": "P", "Type": "Task", "Summary": 5},
    )
    got = rows(validation.validate(recs, dim), "row_index", "severity", "code", "field")
    assert got == sorted(
        [
            (1, "error", "REQUIRED_FIELD_MISSING", "Summary"), (1, "error", "INVALID_ENUM_VALUE", "Prio"), (1, "error", "INVALID_ENUM_VALUE", "Tags"), (1, "warning", "UNKNOWN_FIELD", "Odd"),
            (2, "error", "REQUIRED_FIELD_MISSING", "Project"), (2, "error", "REQUIRED_FIELD_MISSING", "Issue Type"), (3, "error", "INVALID_PROJECT", "Project"), (4, "error", "INVALID_ISSUE_TYPE", "Issue Type"), (5, "error", "INVALID_TYPE", "Summary"),
        ],
        key=str,
    )
    whole = rows(validation.validate(recs, dim, "whole").where("row_index = 0"), "code", "field")
    assert whole == [("INVALID_ENUM_VALUE", "Tags")]


def test_resolve_unique(spark):
    dim = spark.createDataFrame([("1", "PROJ_MS7_2025"), ("2", "Code - Automation"), ("3", "P1 - Critical"), ("4", "Twin"), ("5", "twin"), ("6", "Alpha one"), ("7", "Alpha onf"), ("8", None)], "id string, name string").withColumn("all", F.lit(1))
    values = ["MS7 2025", "code automation", "critcal", "TWIN", "alpha onx", "nothing like it", None, " 3 "]
    cells_ = spark.createDataFrame(list(enumerate(values)), "cell_id int, value string").withColumn("all", F.lit(1))
    got = {r.cell_id: (r.status, r.id) for r in lookups.resolve_unique(cells_, dim, ["all"]).collect()}
    assert got == {0: ("ok", "1"), 1: ("ok", "2"), 2: ("ok", "3"), 3: ("ambiguous", None), 4: ("ambiguous", None), 5: ("not_found", None), 6: ("not_found", None), 7: ("ok", "3")}
    first = {r.cell_id: r.id for r in lookups.resolve_unique(cells_, dim, ["all"], policy="first").collect()}
    assert first[3] == "4" and first[4] in ("6", "7")


def test_blocking_loses_no_match(spark):
    from loomspar.functions.fuzzy import Options as FuzzyOptions
    from loomspar.functions.fuzzy import item_score

    names = ["red ring", "blue bolt", "large steel gear", "small cog", "a very long name of a part that goes on and on", "gear"]
    asked = ["redring", "bleu bolt", "large stel gear", "smal cog", "very long nome of a part that goes on", "geer", "ge", "stee", "x"]
    dim = spark.createDataFrame([(str(i), n) for i, n in enumerate(names)], "id string, name string").withColumn("all", F.lit(1))
    values = spark.createDataFrame([(a,) for a in asked], "wanted string").withColumn("all", F.lit(1))
    got = {(r.wanted, r.id) for r in lookups.scored(values, dim, ["all"], [], FuzzyOptions()).collect()}
    assert got == {(a, str(i)) for a in asked for i, n in enumerate(names) if item_score(a, [n]) is not None}
    names += ["abc", "stool", "x"]
    asked += ["axc", "steel", "a"]
    dim = spark.createDataFrame([(str(i), n) for i, n in enumerate(names)], "id string, name string").withColumn("all", F.lit(1))
    values = spark.createDataFrame([(a,) for a in asked], "wanted string").withColumn("all", F.lit(1))
    for o in (FuzzyOptions(threshold=0.4, least_run=1), FuzzyOptions(threshold=0.35), FuzzyOptions(threshold=0.8, ignore_place=False, least_run=1)):
        got = {(r.wanted, r.id) for r in lookups.scored(values, dim, ["all"], [], o).collect()}
        assert got == {(a, str(i)) for a in asked for i, n in enumerate(names) if item_score(a, [n], o) is not None}


def test_levels_and_cycles(spark):
    edges = [(0, "a", None), (1, "b", " a"), (2, "c", "b"), (3, None, "c"), (4, "x", "y"), (5, "y", "x"), (6, "z", "x"), (7, "w", "gone")]
    df = spark.createDataFrame(edges, "row_index bigint, uid string, parent string")
    got = {r.row_index: (r.level, r.in_cycle) for r in hierarchy.levels(df).collect()}
    assert got == {0: (0, False), 1: (1, False), 2: (2, False), 3: (3, False), 4: (0, True), 5: (0, True), 6: (0, True), 7: (0, False)}
    assert rows(hierarchy.cycle_members(df), "row_index") == [(4,), (5,)]


def test_deep_chain(spark):
    n = 300
    df = spark.createDataFrame([(i, str(i), str(i - 1) if i else None) for i in range(n)], "row_index bigint, uid string, parent string")
    assert rows(hierarchy.levels(df).where("level <> row_index"), "row_index") == []


def test_interior_failure_shifts_nothing(spark):
    sent = spark.createDataFrame([(0, i, 10 + i) for i in range(4)], "batch bigint, position bigint, row_index bigint")
    failed = spark.createDataFrame([(0, 1, "bad")], "batch bigint, position bigint, error string")
    created = spark.createDataFrame([(0, i, f"K{i}") for i in range(3)], "batch bigint, k bigint, key string")
    assert rows(bulk.normalise_response(sent, failed, created), "row_index", "key", "error") == [(10, "K0", None), (11, None, "bad"), (12, "K1", None), (13, "K2", None)]


MERGES = [
    ({1: "a", 2: None, 3: "c"}, {2: "B", 9: "z"}, [3, 1, 3, None, 7]), ({}, {1: "x"}, []), ({5: "q"}, {}, [5]), (None, {1: "x"}, [1]), ({1: "x"}, None, [1]), ({1: "x"}, {2: "y"}, None), ({-1: "m", 10: "k"}, {10: None}, [10]),
]


def test_maps_merge_by_key(spark):
    df = spark.createDataFrame(MERGES, "old map<bigint,string>, new map<bigint,string>, failed array<bigint>")
    none = F.lit(None).cast("array<bigint>")
    new = bulk.updated(F.col("old"), F.col("failed"), F.col("old"), F.col("new"), F.col("failed"), F.col("new"), none, none)
    got = [(r.created, r.errors) for r in df.select(new["created"].alias("created"), new["errors"].alias("errors")).collect()]
    both = lambda a, b: None if a is None or b is None else {**a, **b}
    assert got == [(both(o, n), both(o and {k: v for k, v in o.items() if k in (f or [])} if o is not None else None, n)) for o, n, f in MERGES]


def test_large_maps_merge_in_line_with_their_size(spark):
    """Looking up each of 200,000 keys in the other map would compare 2 * 10^10 pairs."""
    n = 200_000
    maps = spark.range(1).selectExpr(f"sequence(0L, {n - 1}L) AS k").selectExpr("map_from_arrays(k, transform(k, x -> 'a')) AS old", "map_from_arrays(transform(k, x -> x * 2), transform(k, x -> 'b')) AS new", "transform(k, x -> x * 2 + 1) AS failed")
    none = F.lit(None).cast("array<bigint>")
    new = bulk.updated(F.col("old"), F.col("failed"), F.col("old"), F.col("new"), F.col("failed"), F.col("new"), none, none)
    began = time.monotonic()
    got = maps.select(F.size(new["created"]).alias("c"), F.size(new["errors"]).alias("e"), F.element_at(new["created"], F.lit(2).cast("bigint")).alias("two"), F.element_at(new["errors"], F.lit(3).cast("bigint")).alias("three")).first()
    assert tuple(got) == (n + n // 2, n + n // 2, "b", "a") and time.monotonic() - began < 30


USERS = [(0, "asmith", "Anna Smith", "anna.smith@x.org", True), (1, "bsmith", "Bert Smith", "bert.smith@x.org", None), (2, "csmith", "Carl Smith", None, True), (3, "dsmith", None, "dora@x.org", False), (4, "nn", "Anna Smith", "other@x.org", True)]
USER = "pos bigint, username string, display string, email string, active boolean"


def _tiered(value, policy):
    """match_users() by trying each user, without the approximate tier."""
    w = (value or "").replace("\u00a0", " ").replace("\u200b", "").replace("\ufeff", "").strip().lower()
    if not w:
        return None
    mail = w.count("@") == 1 and "." in w.split("@")[1]
    hits = []
    for pos, u, d, m, on in LONG_USERS:
        u, d, m = ((x or "").lower() for x in (u, d, m))
        tier = (1 if m == w else 2 if u == w else None) if mail else 2 if u == w else 3 if u.startswith(w) else 4 if w in d else None
        if tier and on is not False:
            hits.append((tier, pos))
    best = sorted(p for t, p in hits if t == min(hits)[0]) if hits else []
    if not best:
        return ("not_found", None, None)
    return ("ambiguous", None, None) if len(best) > 1 and policy == "error" else ("ok", best[0], (1.0, 0.95, 0.7, 0.5)[min(hits)[0] - 1])


LONG_USERS = [
    *USERS, (5, "a", "\u00c9lan \u4e2d\u6587\u540d", "a@b.c", True), (6, "long" * 30, "x" * 70 + "tail", "m" * 70 + "@x.org", True), (7, "long" * 30 + "er", "x" * 71, "m" * 71 + "@x.org", True), (8, "", "aaa aaa", "", True),
    (9, "smith", "SMITH", "smith", None),
]


@pytest.mark.parametrize("policy", ["first", "error"])
def test_user_tiers_by_keys_equal_every_pair(spark, policy):
    users = spark.createDataFrame(LONG_USERS, USER)
    values = ["smith", "Smi", "a", "an", "asm", "asmith", "nna smith", "h", "th", "\u00e9l", "\u4e2d\u6587", "\u6587", "a@b.c", "dora@x.org", "smith@x.org", "aa", "aaa", "aaaa", "x" * 64, "x" * 71, "x" * 72, "x" * 60 + "tail", "x" * 60 + "tale", "\ufeff \u200b", " \u00a0", None, ""]
    values += ["long" * 16, "long" * 20, "long" * 20 + "x", "long" * 30, "m" * 70 + "@x.org", "m" * 69 + "@x.org", "m" * 71 + "@x.org", "x" * 65 + "\u00a0"]
    cells = spark.createDataFrame(list(enumerate(values)), "cell_id bigint, value string")
    got = {r.cell_id: tuple(r)[1:] for r in lookups.match_users(cells, users, policy, fuzzy=None).collect()}
    assert got == {i: want for i, v in enumerate(values) if (want := _tiered(v, policy))}


def test_user_tiers_broadcast_only_what_has_a_bound(spark):
    """Spark's estimates know nothing of exploded rows: a side of users or values that is broadcast fills the driver."""
    users = spark.createDataFrame(USERS, USER)
    cells = spark.createDataFrame([(0, "smith")], "cell_id bigint, value string")
    for policy in ("first", "error"):
        plan = lookups.match_users(cells, users, policy, fuzzy=None)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastExchange") == 1 and "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_users_of_like_names_are_not_paired_with_like_values(spark):
    """Names and values that begin alike meet by whole values, not by their first letters: 3,000 of each make no 9 million pairs."""
    users = spark.range(3000).selectExpr("id AS pos", "'u' || id AS username", "'Customer#' || lpad(id, 9, '0') AS display", "CAST(null AS string) AS email", "true AS active")
    values = spark.range(3000).selectExpr("id AS w", "'#' || lpad(id, 9, '0') AS value").selectExpr("value AS w", "false AS mail")
    keys = lookups._user_keys(values, users)
    assert keys.where("tier = 4").count() == 3000 == keys.join(values, F.col("k") == F.col("w")).count()


def test_mistyped_users_match_approximately(spark):
    users = spark.createDataFrame(USERS, USER)
    values = ["anna.smiht@x.org", "Bret Smith", "crl smith", "csmiht", "dora@x.ogr", "unlike", "anna smith", "smit", None, " "]
    cells = spark.createDataFrame(list(enumerate(values)), "cell_id bigint, value string")
    got = {p: {r.cell_id: tuple(r)[1:] for r in lookups.match_users(cells, users, p).collect()} for p in ("first", "error", "score")}
    for i, v in enumerate(values[:6]):
        live = [(fuzzy.item_score(v, [d, m, u]), pos) for pos, u, d, m, on in USERS if on is not False]
        hits = sorted(x for x in live if x[0] is not None)
        assert got["first"][i] == (("ok", hits[0][1], 0.4) if hits else ("not_found", None, None))
        assert got["error"][i] == (("ok", hits[0][1], 0.4) if len(hits) == 1 else ("ambiguous" if hits else "not_found", None, None))
    assert got["first"][0][1] == 0 and got["first"][1][1] == 1 and got["first"][3][1] == 2 and got["first"][5][0] == "not_found"
    assert got["first"][6] == ("ok", 0, 0.5) and got["error"][6][0] == "ambiguous" and got["score"][6] == ("ok", 0, 0.5)
    assert got["score"][0][:2] == ("ok", 0) and got["score"][5] == ("not_found", None, None) and set(got["first"]) == set(got["score"]) == set(range(8))
    assert {r.status for r in lookups.match_users(cells, users, fuzzy=None).where("cell_id < 6").collect()} == {"not_found"}
    with pytest.raises(ValueError):
        lookups.match_users(cells, users, "best")


def test_engine_scores_users(spark):
    users = spark.createDataFrame([(0, "xsmith", "Smithson Smith Smyth", "a@b.c", True), (1, "smith.j", "Smith", "smith@b.c", True)], USER)
    cells = spark.createDataFrame([(0, "mith")], "cell_id bigint, value string")
    ask = lambda policy: Engine(spark, Catalog(spark, tables={"user": users}), options=Options(ambiguity=policy)).users(cells).first().user_pos
    assert ask("first") == 0 and ask("score") == 1


def test_bind_and_convert(spark):
    fields = spark.createDataFrame(
        [("P", "Task", 0, "summary", "Summary", "string", None), ("P", "Task", 1, "duedate", "Due Date", "date", None), ("P", "Task", 2, "labels", "Labels", "array", "string"), ("P", "Task", 3, "customfield_1", "Story Points", "number", None), ("P", "Task", 4, "prio", "Priority", "priority", None), ("P", "Task", 5, "timetracking", "Time Tracking", "timetracking", None)],
        FIELDS,
    )
    recs = records(spark, {"Project": "p", "Issue Type": "Task", "summary": " s ", "due_date": 45744, "Label": "a, b", "customfield_1": "x", "Priority": "hgih", "Original Estimate": "2 hours", "Nope": 1, "SUMMARY": "last"})
    bound = binding.bind(recs, fields)
    by = {r.key: (r.field_id, r.by) for r in bound.collect()}
    assert by["SUMMARY"] == ("summary", "name") and by["due_date"] == ("duedate", "name") and by["Label"] == ("labels", "name") and by["customfield_1"] == ("customfield_1", "id") and "Nope" not in by and "summary" not in by
    options = spark.createDataFrame([("prio", "1", "High"), ("prio", "2", "Low")], "field_id string, id string, name string")
    out = binding.payloads(binding.resolve_values(binding.Converters().apply(bound), options)).first()
    body = json.loads(out.payload)
    assert body["summary"] == "last" and body["duedate"] == "2025-03-28" and body["labels"] == ["a", "b"] and body["timetracking"] == {"originalEstimate": "2h"}
    assert "customfield_1: not a valid number" in out.errors


def test_array_items_and_directories_are_converted(spark):
    kinds = {"comp": ("array", "component"), "nums": ("array", "number"), "texts": ("array", "string"), "odd": ("array", "weird"), "who": ("user", None), "team": ("array", "user"), "sp": ("sprint", None), "cas": ("option-with-child", None)}
    fields = spark.createDataFrame([("P", "Task", i, k, k, *v) for i, (k, v) in enumerate(kinds.items())], FIELDS)
    head = {"Project": "P", "Issue Type": "tasc"}
    recs = records(
        spark,
        {**head, "comp": ["api", {"id": "9"}, "Db"], "nums": ["1", 2], "texts": "a, b", "who": "crl smith", "team": "asmith, bsmith", "sp": "sprint one", "cas": "Up -> Left"},
        {**head, "comp": "api, nope, never", "nums": ["1", "x"], "odd": ["a"], "who": "unlike", "team": [], "sp": 1.5, "cas": {"parent": "Up", "child": "No"}},
        {**head, "comp": [], "texts": ["a", 1, None], "who": {"name": "bsmith"}, "sp": "17", "cas": "Left"},
    )
    tables = {
        "field": fields, "option": spark.createDataFrame([("comp", "1", "API"), ("comp", "2", "DB"), ("project", "7", "P")], "field_id string, id string, name string"), "user": spark.createDataFrame(USERS, USER),
        "cascade": spark.createDataFrame([("cas", "u", "Up", "l", "Left"), ("else", "v", "Up", "m", "Left")], "field_id string, parent_id string, parent string, child_id string, child string"),
        "issue_type": spark.createDataFrame([("P", "3", "Task", False), ("Q", "4", "Task", False)], "project_key string, id string, name string, subtask boolean"),
        "board": spark.createDataFrame([(1, 0, "P", "scrum"), (2, 1, "Q", "scrum")], "board_id bigint, pos bigint, project_key string, type string"),
        "sprint": spark.createDataFrame([(5, "Sprint One", "future", 1), (6, "Sprint One", "active", 2)], "sprint_id bigint, name string, state string, board_id bigint"),
    }
    # The record's type names no field of its own, so that the fields of "tasc" are the schema's.
    tables["field"] = fields.withColumn("issue_type", F.lit("tasc"))
    got = {r.row_index: (json.loads(r.payload), r.errors.split("; ") if r.errors else []) for r in Engine(spark, Catalog(spark, tables=tables)).payloads(recs).collect()}
    base = {"project": {"id": "7"}, "issuetype": {"id": "3", "name": "Task", "subtask": False}}
    assert got[0] == ({**base, "comp": [{"id": "1"}, {"id": "9"}, {"id": "2"}], "nums": [1, 2], "texts": ["a", "b"], "who": {"name": "csmith"}, "team": [{"name": "asmith"}, {"name": "bsmith"}], "sp": 5, "cas": {"id": "u", "child": {"id": "l"}}}, [])
    assert got[1][1] == ["cas: not_found", "comp: item 1: not_found", "nums: item 1: not a valid number", "odd: no converter for type weird", "sp: not a valid sprint", "who: not_found"]
    assert got[1][0]["comp"] == [{"id": "1"}, "nope", "never"] and got[1][0]["team"] == [] and got[1][0]["nums"] == ["1", "x"]
    assert got[2] == ({**base, "comp": [], "texts": ["a", "1", ""], "who": {"name": "bsmith"}, "sp": 17, "cas": {"id": "u", "child": {"id": "l"}}}, [])


def test_engine_writes_levels_and_retries(spark, tmp_path):
    fields = spark.createDataFrame([("P", "Task", 0, "summary", "Summary", "string", None), ("P", "Task", 1, "parent", "Parent", "any", None)], FIELDS)
    engine = Engine(spark, Catalog(spark, tables={"field": fields}), ManifestStore(spark, str(tmp_path / "m")), Options())
    recs = records(spark, {"uid": "a", "Project": "P", "Type": "Task", "Summary": "top"}, {"uid": "b", "Project": "P", "Type": "Task", "Summary": "fail", "Parent": "a"}, {"uid": "c", "Project": "P", "Type": "Task", "Summary": "ok", "Parent": "a"})
    seen = []

    def writer(batch):
        seen.extend(p for _, p in batch)
        return sink.numbered("R")(batch)

    manifest, results = engine.create(recs, sink.numbered("R"))
    assert manifest["succeeded"] == [0, 2] and manifest["failed"] == [1]
    assert rows(results, "row_index", "key") == [(0, "R-0"), (1, None), (2, "R-2")]
    fixed = recs.withColumn("raw", F.replace("raw", F.lit("fail"), F.lit("fine")))
    again, _ = engine.create(fixed, sink.numbered("N"), retry=manifest["id"])
    assert again["uid_map"] == {"a": "R-0", "c": "R-2", "b": "N-1"} and again["succeeded"] == [0, 1, 2] and again["failed"] == [] and again["created"]["1"] == "N-1"
    with pytest.raises(errors.EngineError):
        engine.create(recs, writer, retry="bulk-none")


def test_manifest_expiry(spark, tmp_path):
    store = ManifestStore(spark, str(tmp_path / "x"))
    assert store.get("a") is None
    store.update("a", {"succeeded": [1], "failed": [2], "errors": {2: "e"}}, now=0)
    assert store.update("a", {"succeeded": [2], "failed": []}, now=1)["errors"] == {}
    assert store.get("a", now=5)["succeeded"] == [1, 2] and store.get("a", now=90_000_000) is None


def test_pages_source(spark, tmp_path):
    for i in range(2):
        (tmp_path / f"page{i}.json").write_text(json.dumps({"values": [{"id": i}, {"id": i + 10}]}))
    spark.dataSource.register(PagesSource)
    df = spark.read.format("recorded_pages").option("folder", str(tmp_path)).load()
    assert set(rows(df, "page", "item")) == {(0, '{"id": 0}'), (0, '{"id": 10}'), (1, '{"id": 1}'), (1, '{"id": 11}')}


def test_progress_stream(spark, tmp_path):
    spark.createDataFrame([("j", 0, 1), ("j", 1000, 2), ("j", 200_000, 2), ("k", 5, 9)], "job string, at bigint, count bigint").write.parquet(str(tmp_path / "in"))
    polls = spark.readStream.schema("job string, at bigint, count bigint").parquet(str(tmp_path / "in"))
    q = track(polls, total=9).writeStream.outputMode("update").format("memory").queryName("progress").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    last = {r.job: (r.best, r.stuck, r.complete) for r in spark.table("progress").orderBy("at").collect()}
    assert last == {"j": (2, True, False), "k": (9, False, True)}


def test_cache():
    now = [0.0]
    c = ExpiringCache(clock=lambda: now[0])
    c.set(("lookup", "P"), 1, 10)
    assert c.get(("lookup", "P")) == (1, False)
    now[0] = 11
    assert c.get(("lookup", "P")) == (1, True) and c.get(("lookup", "P"), stale=False) is None
    assert c.refresh_once(("lookup", "P"), lambda: 2, 10) == 2
    now[0] = 60
    assert c.get(("lookup", "P")) is None
    c.set(("a",), 1, 1)
    assert c.invalidate(lambda k: k[0] == "a") == [("a",)]


def test_catalog(spark):
    project = spark.createDataFrame([(0, "AA", "Alpha", "software"), (1, "BB", "Beta", "business"), (2, "AB", "Alphabet", "software")], "pos int, key string, name string, project_type_key string")
    sprint = spark.createDataFrame([(1, "S1", "active", 10), (1, "S1b", "active", 11), (2, "S2", "closed", 10)], "sprint_id bigint, name string, state string, board_id bigint")
    board = spark.createDataFrame([(0, 10, "AA", "scrum"), (1, 11, "AA", "scrum")], "pos int, board_id bigint, project_key string, type string")
    c = Catalog(spark, tables={"project": project, "sprint": sprint, "board": board})
    assert [r.key for r in c.projects(type_key="software", offset=1).collect()] == ["AB"]
    assert [r.key for r in c.projects("alpha").collect()] == ["AA", "AB"]
    assert rows(c.sprints("AA"), "sprint_id", "name") == [(1, "S1b")]
    with pytest.raises(errors.EngineError):
        c.project("ZZ")
    assert c.invalidate("project") == ["project"] and c.invalidate("none") == []


def test_input_kinds(spark):
    assert readers.input_kind([{}]) == "bulk" and readers.input_kind({"Project": "P"}) == "single" and readers.input_kind({"from": "x.csv"}) == "bulk"
    assert readers.normal_input({"issues": [{"fields": {"a": 1}}]}) == [{"a": 1}]
    with pytest.raises(errors.EngineError):
        readers.input_kind({"a": 1})


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Project,Summary\nP,x\nQ,\n")
    (tmp_path / "b.yml").write_text("Project: P\n---\n- Project: R\n")
    (tmp_path / "c.txt").write_text("?")
    got = readers.read_records(spark, path=str(tmp_path)).orderBy("source", "row_index").collect()
    assert [json.loads(r.raw) if r.raw else None for r in got] == [{"Project": "P", "Summary": "x"}, {"Project": "Q", "Summary": None}, {"Project": "P"}, {"Project": "R"}, None]
    assert got[-1].error.startswith(errors.INPUT_PARSE)


def test_search_text():
    assert bulk.search_text({"summary": 'a "b"'}, {"status": ["x", "y"]}, since="2024-01-01", order_by="key") == 'summary ~ "a \\"b\\"" AND status IN ("x", "y") AND created >= "2024-01-01" ORDER BY key'
    assert bulk.search_text(raw="a = 1 OR b = 2", since="2024-01-01") == '(a = 1 OR b = 2) AND created >= "2024-01-01"'


def test_lookups_under_nfkc(spark):
    dim = spark.createDataFrame([("a", 1, "High"), ("a", 2, "Ｌｏｗ ﬁx")], "p string, id int, name string")
    cells = spark.createDataFrame([(1, "Ｈｉｇｈ", "a"), (2, "low fix", "a"), (3, " LOW\u200b ﬁX ", "a"), (4, None, "a")], "cell_id int, value string, p string")
    got = {r.cell_id: (r.status, r.id) for r in lookups.resolve_unique(cells, dim, ["p"], fuzzy=None).collect()}
    assert got == {1: ("ok", 1), 2: ("ok", 2), 3: ("ok", 2), 4: ("not_found", None)}


def test_parents_by_key_and_summary(spark):
    from loomspar.operators import entities as E

    issues = spark.createDataFrame([("P", "P-1", "Build the new engine", 1), ("P", "P-2", "new engine", 2), ("P", "P-3", "Other", 3), ("Q", "Q-1", "new engine", 4), ("P", "P-5", "Twin", 5), ("P", "P-6", "twin", 6)], "project string, key string, summary string, pos int")
    cells = spark.createDataFrame([(1, "p-3", "P"), (2, "P-99", "P"), (3, "New Engine", "P"), (4, "nothing like it", "P"), (5, "TWIN", "P"), (6, None, "P")], "cell_id int, value string, project string")
    found = E.searched_parents(cells, issues)
    assert {(r.cell_id, r.key) for r in found.collect()} == {(3, "P-1"), (3, "P-2"), (5, "P-5"), (5, "P-6")}
    got = {r.cell_id: (r.status, r.key) for r in E.resolve_parents(cells, issues, found).collect()}
    assert got == {1: ("ok", "P-3"), 2: ("not_found", None), 3: ("ok", "P-2"), 4: ("not_found", None), 5: ("ambiguous", None), 6: ("not_found", None)}
    told = spark.createDataFrame([(3, 10, 7, "new engine", 1), (3, 11, 8, "engine", 2)], "cell_id int, project_id int, number int, summary string, pos int")
    projects = spark.createDataFrame([(10, "P")], "id int, key string")
    assert {r.key for r in E.suggested_parents(told, projects).collect()} == {"P-7", "???-8"}


def test_shapes(spark):
    from loomspar.functions import scalars as S

    rows = [('{"id": "3"}', True, False), ('{"id": 3}', False, False), ('{"id": "3", "name": "x"}', False, False), ('{"errorMessages": ["no"]}', False, True), ('{"errors": {}}', False, True), ("[1]", False, False), ("x", False, False), (None, False, False)]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, t string")
    got = [(r.a, r.b) for r in df.select("i", S.is_id_only("t").alias("a"), S.is_error_response("t").alias("b")).orderBy("i").collect()]
    assert got == [(a, b) for _, a, b in rows]
    one = spark.sql("SELECT array('a', 'b') AS l, CAST(NULL AS array<string>) AS n, TIMESTAMP'2024-03-01 07:05:59' AS t")
    assert tuple(one.select(S.has_marker("l", F.lit("b")), S.has_marker("n", F.lit("b")), S.search_date("t")).first()) == (True, False, "2024-03-01 07:05")


def test_user_payloads(spark):
    users = spark.createDataFrame([(1, "u1", "acc1"), (2, "u2", "acc2")], "pos int, username string, account_id string")
    found = spark.createDataFrame([(7, 2), (8, None)], "cell_id int, user_pos int")
    for deployment, want in (("server", '{"name":"u2"}'), ("cloud", '{"accountId":"acc2"}')):
        assert {r.cell_id: r.payload for r in lookups.user_payload(found, users, deployment).collect()} == {7: want, 8: None}
