"""Nested results, pages, sliding windows, sessions, differences and plans on small cases."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lakeaudit.functions import jsonsize
from lakeaudit.operators import compare, filters, joins, layout, model, nested, paging, profile, sliding, workload
from lakeaudit.plans import documents as plans
from lakeaudit.streaming import monitor

PAYLOAD = {
    "database": "TEST_DB",
    "summary": {"total": 3, "high": 1},
    "queries": [{"query_id": 10, "ms": 100.5, "text": "SELECT 1"}, {"query_id": 11, "ms": 200.0, "text": "SELECT 2"}],
}
SCHEMA = "database string, summary struct<total:long,high:long>, queries array<struct<query_id:long,ms:double,text:string>>"


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]


@pytest.fixture(scope="module")
def payload(spark):
    return spark.createDataFrame([PAYLOAD], SCHEMA)


def test_projection_of_nested_fields(payload):
    out = rows_of(nested.field_projection(payload, "database,summary.total,queries.query_id,queries.ms"))[0]
    assert out == {"database": "TEST_DB", "summary": {"total": 3}, "queries": [{"query_id": 10, "ms": 100.5}, {"query_id": 11, "ms": 200.0}]}


def test_projection_prefix_missing_and_empty(payload):
    assert rows_of(nested.field_projection(payload, "summary.total, summary"))[0] == {"summary": {"total": 3, "high": 1}}
    assert rows_of(nested.field_projection(payload, "database.x, nothing")) == rows_of(payload)
    assert rows_of(nested.field_projection(payload, "")) == rows_of(payload)


def test_projection_drops_empty_items_and_keeps_blocks(spark):
    df = spark.createDataFrame(
        [({"page": 1}, [{"id": None, "name": "A"}, {"id": 2, "name": "B"}])],
        "pagination struct<page:int>, items array<struct<id:int,name:string>>",
    )
    assert rows_of(nested.field_projection(df, "items.id"))[0] == {"items": [{"id": 2}], "pagination": {"page": 1}}


def test_json_size_equals_json_text(spark):
    values = [
        {"a": 'q"\\\n\t\x01é', "b": None, "c": [1, 22, None], "d": {"x": True, "y": False}, "m": {"k": "v", "l": None}},
        {"a": "", "b": 1.5, "c": [], "d": None, "m": {}},
        {"a": None, "b": 2.0, "c": None, "d": {"x": None, "y": True}, "m": None},
    ]
    df = spark.createDataFrame(values, "a string, b double, c array<int>, d struct<x:boolean,y:boolean>, m map<string,string>")
    sizes = [r[0] for r in df.select(jsonsize.row_chars(df)).collect()]
    assert sizes == [len(json.dumps(v, ensure_ascii=False)) for v in values]


def budget_rule(value, budget):
    """What a budget does to one document, on plain lists."""
    size = lambda v: max(1, len(json.dumps(v, ensure_ascii=False)) // 4)
    cut = lambda v, n: [cut(x, n) for x in v[:n]] if isinstance(v, list) else {k: cut(x, n) for k, x in v.items()} if isinstance(v, dict) else v
    if size(value) <= budget:
        return value, None
    for n in (50, 25, 10, 5, 3, 1):
        if size(cut(value, n)) <= budget:
            return cut(value, n), n
    return None, 0


@pytest.mark.parametrize("budget", [10, 60, 120, 400, 5000])
def test_budget_ladder(spark, budget):
    docs = [
        {"database": "D", "summary": {"n": i}, "items": [{"id": j, "tags": ["t"] * j, "text": "X" * 30} for j in range(i)]}
        for i in (0, 1, 2, 4, 9, 20, 60)
    ]
    schema = "database string, summary struct<n:long>, items array<struct<id:long,tags:array<string>,text:string>>"
    out = rows_of(nested.token_budget(spark.createDataFrame(docs, schema), budget))
    for doc, got in zip(docs, out):
        want, step = budget_rule(doc, budget)
        if step == 0:
            assert got["database"] == "D" and got["items"] is None and got["original_summary"] == doc["summary"]
        else:
            assert got["items"] == want["items"]
        assert (got["_truncation"] or {}).get("list_max_items") == step


def test_budget_none_keeps_rows(payload):
    assert rows_of(nested.token_budget(payload, None)) == rows_of(payload) == rows_of(nested.token_budget(payload, 0))


def test_page_of_every_list(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5], {"b": ["x"]}, None)], "a array<int>, s struct<b:array<string>>, n array<int>")
    row = rows_of(nested.page_lists(df, 2, 2))[0]
    assert row["a"] == [3, 4] and row["s"] == {"b": ["x"]} and row["n"] is None
    assert row["_pagination"]["lists"] == {
        "root.a": {"page": 2, "page_size": 2, "total_items": 5, "total_pages": 3},
        "root.s.b": {"page": 1, "page_size": 2, "total_items": 1, "total_pages": 1},
    }


@pytest.mark.parametrize("page, size, expected", [(1, 10, (1, 10)), (0, 0, (1, 10)), ("x", None, (1, 10)), (3, 999, (3, 200)), (-1, -5, (1, 10))])
def test_normalised_pages(page, size, expected):
    assert paging.normalise(page, size) == expected


def test_numbered_rows_and_deep_pages(spark):
    keys = random.Random(5).sample(range(10**6), 3000)
    df = spark.createDataFrame([(k % 7 or None, k) for k in keys], "g int, k long")
    want = sorted(((k % 7 or None, k) for k in keys), key=lambda x: (x[0] or 0, x[1]))
    got = {(r["g"], r["k"]): r["row_no"] for r in paging.number_rows(df, ["g", "k"], buckets=13).collect()}
    assert got == {key: i for i, key in enumerate(want, 1)}
    page = paging.offset_page(df, ["g", "k"], 40, 25, 100_000)
    assert [(r["g"], r["k"]) for r in page.collect()] == want[975:1000]
    assert paging.offset_page(df.where("k < 0"), ["g", "k"], 1, 10, 10).count() == 0
    assert paging.row_cap(df, 0).count() == 0
    ties = paging.number_rows(spark.createDataFrame([(None,)] * 5 + [(1,)] * 4, "v int"), ["v"])
    assert sorted(r["row_no"] for r in ties.collect()) == list(range(1, 10))


def test_page_sizes_have_a_limit_of_the_callers_choice(spark):
    assert paging.normalise(1, 999, 5000) == (1, 999)
    page = paging.result_page(spark.range(1000), 2, 400, ["id"], most=400)
    assert [r["id"] for r in page.collect()] == list(range(400, 800)) and page.first()["page_size"] == 400


def test_means_of_very_small_and_large_values(spark):
    from lakeaudit.functions.numbers import mean

    df = spark.createDataFrame([("s", 0.00001), ("s", 0.00002), ("l", 1e12), ("l", 3e12), ("n", None)], "g string, v double")
    assert {r["g"]: r["m"] for r in df.groupBy("g").agg(mean(F.col("v")).alias("m")).collect()} == {"s": 0.000015, "l": 2e12, "n": None}


def test_sliding_counts_and_running_sums(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("aaab"), rng.randrange(-5000, 5000)) for i in range(800)]
    df = spark.createDataFrame(rows, "i long, c string, t long").withColumn("ts", F.timestamp_seconds("t"))
    got = {r["i"]: r["requests"] for r in sliding.sliding_counts(df, "c", "ts", 60).collect()}
    assert got == {i: sum(c2 == c and t - 60 <= t2 <= t for _, c2, t2 in rows) for i, c, t in rows}
    sums = {r["i"]: r["s"] for r in sliding.running_sum(df, "c", "i", "t", "s", chunk=37).collect()}
    assert sums == {i: sum(t2 for j, c2, t2 in rows if c2 == c and j <= i) for i, c, _ in rows}


def test_sessions_across_slices(spark):
    rng = random.Random(2)
    rows = sorted({(rng.choice("aab"), rng.randrange(0, 4000)) for _ in range(700)})
    df = spark.createDataFrame(rows, "u string, t long").withColumn("ts", F.timestamp_seconds("t"))
    got = monitor.sessions(df, "u", "ts", 10, slice_seconds=50)
    want = []
    for u in "ab":
        for t in [t for c, t in rows if c == u]:
            if want and want[-1][0] == u and t - want[-1][2] < 10:
                want[-1][2] = t
                want[-1][3] += 1
            else:
                want.append([u, t, t, 1])
    micros = lambda c: (F.unix_micros(F.col(c).cast("timestamp")) / 1_000_000).cast("long")
    out = got.select("u", micros("session_start"), micros("session_end") - 10, "events").collect()
    assert sorted(map(list, out)) == sorted(want)


def test_late_rows(spark):
    df = spark.createDataFrame([(0, 100), (1, 50), (2, 99), (3, 200), (4, 189), (5, 190)], "i long, t long")
    row = monitor.late_rows(df.withColumn("ts", F.timestamp_seconds("t")), "i", "ts", 10, ranges=3).first()
    assert (row["rows"], row["late_rows"]) == (6, 2)


def test_keyed_diff(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (5, "x"), (5, "x")], "k int, v string")
    right = spark.createDataFrame([(1, "a"), (2, None), (3, "d"), (4, "e"), (5, "x")], "k int, v string")
    got = {r["k"]: r["status"] for r in compare.keyed_diff(left, right, ["k"], ["v"]).collect()}
    assert got == {1: "same", 2: "same", 3: "changed", 4: "only_right", 5: "duplicate"}


def test_joins_keep_missing_keys(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    right = spark.createDataFrame([(1,), (1,), (None,)], "b int")
    assert sorted(r["f"] for r in joins.missing_flag(left, right, "a", "b", "f").collect()) == [0, 1, 1]
    assert {r["a"] for r in joins.not_in_set(left, right, "a", "b").collect()} == {2, None}


def test_keys_and_relationships(spark):
    tables = {
        "p": spark.createDataFrame([(i, f"n{i}") for i in range(50)], "p_key long, p_name string"),
        "c": spark.createDataFrame([(i % 50, i // 2) for i in range(200)], "c_p_key long, c_half long").withColumnRenamed("c_p_key", "c_key"),
    }
    keys = {(r["table_name"], r["key_columns"]) for r in model.find_keys(tables, [("c", ("c_key", "c_half"))]).collect()}
    assert keys == {("p", "p_key"), ("p", "p_name"), ("c", "c_key,c_half")}
    rel = {(r["parent_column"], r["referenced_column"]): r for r in model.relationships(tables).collect()}
    assert set(rel) == {("c_key", "p_key")} and rel["c_key", "p_key"]["same_name"] and rel["c_key", "p_key"]["parent_coverage"] == 1.0
    part = {(r["parent_column"], r["referenced_column"]): r["coverage"] for r in model.relationships(tables, min_coverage=0.4).collect()}
    assert part[("c_half", "p_key")] == 0.5


def test_issue_counts_are_zero_filled(spark):
    issues = spark.createDataFrame([("identifiers", "t")], "category string, entity string")
    assert {r["category"]: r["issues"] for r in model.issue_counts(issues).collect()} == {
        "entities": 0, "attributes": 0, "relationships": 0, "identifiers": 1, "normalization": 0,
    }


def test_ddl_of_empty_and_odd_columns(spark):
    df = spark.createDataFrame([], "a long, b string, c decimal(10,2), d date, e boolean, `x]y` int")
    ddl = profile.inferred_ddl(profile.profile(df, "t")).first()["ddl"]
    assert ddl.split("\n")[1:-1] == [
        "    [a] BIGINT NOT NULL,", "    [b] VARCHAR(MAX) NOT NULL,", "    [c] DECIMAL(10, 2) NOT NULL,",
        "    [d] DATE NOT NULL,", "    [e] BIT NOT NULL,", "    [x]]y] INT NOT NULL",
    ]


def test_fragmentation_limits(spark):
    rows = spark.createDataFrame([("dbo", "i", 50.0, 10), ("dbo", "j", 50.0, 200), ("s", None, 90.0, 300)],
                                 "schema_name string, index_name string, avg_fragmentation_in_percent double, page_count long")
    assert [r["index_name"] for r in filters.fragmented(rows).collect()] == ["j"]
    assert layout.top_fragmented(rows.withColumn("table_name", F.lit("t")), 0).count() == 1


def test_unknown_metric_ranks_by_cpu(spark):
    log = spark.createDataFrame([("a", 1.0, 9.0, 1), ("b", 2.0, 1.0, 1)], "query_id string, cpu_ms double, duration_ms double, logical_reads long")
    log = log.withColumn("ts", F.current_timestamp())
    assert [r["query_id"] for r in workload.top_queries(log, "nonsense").collect()] == ["b", "a"]


def test_plan_nodes_and_stubs(spark):
    xml = (
        '<ShowPlanXML xmlns="urn:x"><RelOp PhysicalOp="Join" LogicalOp="Inner" EstimatedTotalSubtreeCost="0.6">'
        "<Predicate><X>a = b and something much longer than that</X></Predicate>"
        '<RelOp PhysicalOp="Scan" EstimatedTotalSubtreeCost="0.2"><Object Schema="[dbo]" Table="[t]"/>'
        '<RunTimeCountersPerThread ActualElapsedms="5" ActualRows="7"/></RelOp>'
        '<RelOp PhysicalOp="Seek" EstimatedTotalSubtreeCost="oops"/></RelOp></ShowPlanXML>'
    )
    df = spark.createDataFrame([(1, xml), (2, None), (3, "text"), (4, "<a><b></a>"), (5, "<a/>")], "plan_id long, plan_xml string")
    rows = sorted(rows_of(plans.cost_bands(plans.plan_nodes(df))), key=lambda r: (r["plan_id"], r["node_id"] or 0))
    assert [(r["node_id"], r["parent_id"], r["physical_op"], r["band"]) for r in rows[:3]] == [
        (1, None, "Join", "red"), (2, 1, "Scan", "amber"), (3, 1, "Seek", "none"),
    ]
    assert rows[0]["object_name"] == "dbo.t" and rows[0]["predicate"] == "a = b and something much longer than that" and rows[1]["actual_rows"] == "7"
    assert [r["status"] for r in rows[3:]] == ["no plan", "no plan", "unreadable", "empty"]


def test_documents_hold_whole_orders(spark, tmp_path):
    from lakeaudit import fixtures as fx
    from lakeaudit.sources.tables import Lake

    lines = [(1, i % 5, "A") for i in range(300)] + [(2, 7, "R")]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(1, "high"), (2, "low"), (3, "none")]
    spark.createDataFrame(orders, "o_orderkey long, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    docs = rows_of(fx.order_documents(Lake(spark, str(tmp_path))))
    assert {d["orderkey"]: len(d["lines"]) for d in docs} == {1: 300, 2: 1, 3: 0}


def test_projection_reads_only_the_named_nested_fields(spark, tmp_path, payload):
    payload.write.parquet(f"{tmp_path}/docs")
    narrow = nested.field_projection(spark.read.parquet(f"{tmp_path}/docs"), "summary.total,queries.query_id")
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema:"):]
    assert "query_id" in schema and "total" in schema
    assert not any(name in schema for name in ("text", "ms:", "high", "database"))


def test_hot_client_sessions_and_pages_stay_exact(spark):
    """A third of all rows on one key, through the operators that cut keys into slices."""
    df = spark.range(6000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97).alias("u"),
        F.timestamp_seconds(F.col("id") * 7).alias("ts"),
    )
    assert monitor.sessions(df, "u", "ts", 22, slice_seconds=3600).agg(F.sum("events")).first()[0] == 6000
    hot = sliding.sliding_counts(df, "u", "ts", 210).where("u = 0 AND id > 100 AND id % 97 <> 0")
    assert {r["requests"] for r in hot.select("requests").distinct().collect()} <= {11, 12}


def test_keys_with_odd_names_types_and_no_candidates(spark):
    import datetime
    import decimal

    rows = [(i, f"k{i}", datetime.date(2024, 1, 1 + i), decimal.Decimal(i), 1.5 * i, i % 2) for i in range(9)]
    parent = spark.createDataFrame(rows, "`order id` int, `it's` string, d date, `a``b` decimal(10,2), f double, half int")
    child = spark.createDataFrame([("k1", datetime.date(2024, 1, 3)), ("k1", None), ("k5", datetime.date(2024, 1, 3))], "name string, day date")
    keys = {r["key_columns"] for r in model.find_keys({"p": parent}, [("p", ("order id", "half"))]).collect()}
    assert keys == {"order id", "it's", "d", "a`b", "order id,half"}
    found = {(r["parent_column"], r["referenced_column"], r["child_values"], r["coverage"]) for r in model.relationships({"p": parent, "c": child}).collect()}
    assert found == {("name", "it's", 2, 1.0), ("day", "d", 1, 1.0)}
    only = {"f": parent.select("f")}
    assert model.find_keys(only).collect() == [] and model.relationships(only).collect() == []
    nulls = spark.createDataFrame([(None, 1), (1, None)], "a int, b int")
    checked = model.check_keys({"n": nulls}, [("n", ("a", "b")), ("n", ("a",))]).collect()
    assert [(r["distinct_count"], r["null_rows"], r["is_key"]) for r in sorted(checked, key=lambda r: r["key_columns"])] == [(2, 1, False), (2, 2, False)]


def test_pair_plans_do_not_grow_with_pairs(spark):
    def size(columns: int) -> int:
        df = spark.range(3).select(*[F.col("id").alias(f"c{i}") for i in range(columns)])
        plan = model.relationships({"a": df, "b": df}, model.find_keys({"a": df, "b": df}))._jdf.queryExecution().optimizedPlan()
        return plan.toString().count("\n")

    assert size(12) == size(4)


def test_previous_pages_over_gaps(spark):
    pages = spark.createDataFrame([(0, 1, 5), (5, 2, 9), (40, 3, 4), (41, 1, 1)], "page long, rows long, max_v int")
    got = {r["page"]: r["prev_max_v"] for r in layout.with_previous_page(pages, ["v"]).collect()}
    assert got == {0: None, 5: 5, 40: 9, 41: 4}


def test_inventory_shows_empty_tables_and_files(spark, tmp_path):
    from lakeaudit.sources import inventory
    from lakeaudit.sources.tables import Lake

    spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/full.parquet")
    spark.range(0).coalesce(1).write.parquet(f"{tmp_path}/empty.parquet")
    rows = {r["table_name"]: r for r in inventory.lake_inventory(Lake(spark, str(tmp_path)), ["full", "empty"]).collect()}
    assert (rows["full"]["files"], rows["full"]["row_count"]) == (1, 5) and rows["full"]["bytes"] > 0 and rows["full"]["modified"] is not None
    assert rows["empty"]["row_count"] == 0 and rows["empty"]["files"] >= 1


def test_texts_do_not_turn_hashes_into_sorts(spark, lake):
    from lakeaudit.operators import compare, lineage
    from lakeaudit.suite import QUERIES

    orders = lake.table("orders")
    plans = [
        compare.keyed_diff(orders, orders, ["o_orderkey"], ["o_orderstatus", "o_totalprice"]), QUERIES["left_join_default"](spark, lake.root),
        lineage.ordered_distinct(spark.createDataFrame([(1, 1, "a", "b")], "stmt_id long, position int, schema_name string, table_name string")),
        QUERIES["usage_metrics"](spark, lake.root),
    ]
    for df in plans:
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_equal_digests_need_equal_places(spark):
    from lakeaudit.operators import compare

    left = spark.createDataFrame([(1, None, "x"), (2, "x", None), (3, "a", "b")], "k int, a string, b string")
    right = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, "a", "b")], "k int, a string, b string")
    assert {r["k"]: r["status"] for r in compare.keyed_diff(left, right, ["k"], ["a", "b"]).collect()} == {1: "changed", 2: "same", 3: "same"}
