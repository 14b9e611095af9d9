"""Reads, filters, joins, aggregates, pages and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeaudit import fixtures as fx
from lakeaudit import session
from lakeaudit.functions import formats, numbers
from lakeaudit.functions.numbers import half_up_sql as hu
from lakeaudit.operators import aggregates, compare, filters, joins, paging, sliding, workload
from lakeaudit.sources import inventory
from lakeaudit.sources import tables as src
from lakeaudit.suite.registry import query

COUNTED = src.TABLES


@query("param_query", """
    WITH capped AS (
      SELECT o_orderkey, o_custkey, o_totalprice FROM orders
      WHERE o_orderstatus = 'F' AND o_totalprice >= 1000.0),
    n AS (SELECT count(*) AS total FROM capped),
    p AS (SELECT total, greatest(1, CAST(ceil(total / 25.0) AS BIGINT)) AS pages FROM n)
    SELECT c.o_orderkey, c.o_custkey, c.o_totalprice, least(2, pages) AS page,
           CAST(25 AS BIGINT) AS page_size, total AS total_items, pages AS total_pages
    FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn FROM capped) c, p
    WHERE rn > (least(2, pages) - 1) * 25 AND rn <= least(2, pages) * 25
""")
def param_query(lake):
    sql = """SELECT o_orderkey, o_custkey, o_totalprice FROM {orders}
             WHERE o_orderstatus = ? AND o_totalprice >= ? ORDER BY o_orderkey"""
    return src.run_query(
        lake.spark, sql, '["F", 1000.0]', {"orders": lake.table("orders")},
        page=2, page_size=25, order_by=["o_orderkey"],
        guarded=src.ReadGuard(scope="*.orders", audit_path=session.work_path(lake.spark, "reads")),
    )


@query("param_query_named", """
    SELECT l_returnflag, count(*) AS line_count FROM lineitem
    WHERE l_quantity >= 10 AND l_linestatus = 'O' GROUP BY l_returnflag ORDER BY l_returnflag
""")
def param_query_named(lake):
    sql = """SELECT l_returnflag, count(*) AS line_count FROM {lineitem}
             WHERE l_quantity >= :least AND l_linestatus = :status GROUP BY l_returnflag ORDER BY l_returnflag"""
    return src.param_query(lake.spark, sql, '{"least": 10, "status": "O"}', {"lineitem": lake.table("lineitem")})


@query("row_cap", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_suppkey, l_linenumber LIMIT 500
""")
def row_cap(lake):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    rows = lake.table("lineitem").select(*keys, "l_extendedprice")
    return paging.row_cap(rows.orderBy(F.col("l_extendedprice").desc(), *keys), src.PREVIEW_ROWS)


def _sides(lake):
    both = fx.sources(lake)
    side = lambda n: both.where(F.col("instance") == n).drop("instance")
    return side(1), side(2)


SOURCES = fx.duck(fx.SOURCES, "orders")


@query("multi_source_union", f"""
    SELECT instance, o_orderkey, o_custkey, o_totalprice FROM ({SOURCES}) s
""")
def multi_source_union(lake):
    one, two = _sides(lake)
    return src.union_sources({1: one, 2: two})


DIFF = f"""
    WITH s AS ({SOURCES}),
    a AS (SELECT * FROM s WHERE instance = 1), b AS (SELECT * FROM s WHERE instance = 2),
    d AS (
      SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
        CASE WHEN b.o_orderkey IS NULL THEN 'only_left' WHEN a.o_orderkey IS NULL THEN 'only_right'
             WHEN a.o_custkey IS NOT DISTINCT FROM b.o_custkey
              AND a.o_totalprice IS NOT DISTINCT FROM b.o_totalprice THEN 'same' ELSE 'changed' END AS status,
        CASE WHEN a.o_orderkey IS NULL THEN 0 ELSE 1 END AS left_rows,
        CASE WHEN b.o_orderkey IS NULL THEN 0 ELSE 1 END AS right_rows
      FROM a FULL OUTER JOIN b ON a.o_orderkey = b.o_orderkey)
"""


@query("source_reconcile", DIFF + " SELECT * FROM d")
def source_reconcile(lake):
    return compare.keyed_diff(*_sides(lake), ["o_orderkey"], ["o_custkey", "o_totalprice"])


@query("source_reconcile_summary", DIFF + " SELECT status, count(*) AS keys FROM d GROUP BY status")
def source_reconcile_summary(lake):
    return compare.diff_summary(source_reconcile(lake))


@query("source_changes", DIFF + " SELECT * FROM d WHERE status <> 'same'")
def source_changes(lake):
    """The keys whose rows differ, found through the digest tree."""
    return compare.tree_diff(*_sides(lake), ["o_orderkey"], ["o_custkey", "o_totalprice"])


# Two sources that differ in a few orders only.
FEW = """
    WITH a AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 4999 <> 3),
    b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3001 = 7 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders),
    d AS (
      SELECT CASE WHEN a.o_orderkey IS NULL THEN 'only_right'
          WHEN a.o_custkey IS NOT DISTINCT FROM b.o_custkey AND a.o_totalprice IS NOT DISTINCT FROM b.o_totalprice THEN 'same' ELSE 'changed' END AS status
      FROM a FULL OUTER JOIN b ON a.o_orderkey = b.o_orderkey)
"""


@query("source_changes_summary", FEW + "SELECT status, count(*) AS keys FROM d GROUP BY status")
def source_changes_summary(lake):
    orders = lake.table("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    raised = F.when(F.col("o_orderkey") % 3001 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    one, two = orders.where(F.col("o_orderkey") % 4999 != 3), orders.withColumn("o_totalprice", raised)
    return compare.tree_summary(one, two, ["o_orderkey"], ["o_custkey", "o_totalprice"])


SNAPSHOTS = f"""
    WITH cur AS (SELECT o_orderkey, o_custkey,
                   CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
                 FROM orders),
    base AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 10 <> 4)
"""


def _drift_sql(base: str, cur: str) -> str:
    return SNAPSHOTS + f""",
    c AS (SELECT count(*) FILTER (WHERE b.o_orderkey IS NULL) AS inserts,
        count(*) FILTER (WHERE b.o_orderkey = n.o_orderkey AND (b.o_custkey IS DISTINCT FROM n.o_custkey
           OR b.o_totalprice IS DISTINCT FROM n.o_totalprice)) AS updates,
        count(*) FILTER (WHERE n.o_orderkey IS NULL) AS deletes,
        count(*) FILTER (WHERE b.o_orderkey = n.o_orderkey AND b.o_custkey IS NOT DISTINCT FROM n.o_custkey
           AND b.o_totalprice IS NOT DISTINCT FROM n.o_totalprice) AS unchanged,
        count(b.o_orderkey) AS base_rows, count(n.o_orderkey) AS current_rows
      FROM {base} b FULL OUTER JOIN {cur} n ON b.o_orderkey = n.o_orderkey)
    SELECT *, inserts + updates + deletes AS modification_counter,
      {hu('(inserts + updates + deletes) / base_rows', 4)} AS change_ratio,
      (inserts + updates + deletes) / base_rows > 0.2 AS stale FROM c
"""


def _snapshots(lake):
    orders = lake.table("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    raised = F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return orders.where(F.col("o_orderkey") % 10 != 4), orders.withColumn("o_totalprice", raised)


@query("stats_staleness", _drift_sql("base", "cur"))
def stats_staleness(lake):
    base, current = _snapshots(lake)
    return compare.snapshot_drift(base, current, ["o_orderkey"], ["o_custkey", "o_totalprice"])


@query("stats_staleness_deletes", _drift_sql("cur", "base"))
def stats_staleness_deletes(lake):
    base, current = _snapshots(lake)
    return compare.snapshot_drift(current, base, ["o_orderkey"], ["o_custkey", "o_totalprice"])


@query("iso_records", """
    SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
      CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END AS ts,
      left(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), 23) AS ts_millis
    FROM events
""")
def iso_records(lake):
    return formats.iso_records(lake.table("events").withColumn("ts_millis", formats.millis_text(F.col("ts"))))


@query("iso_records_orders", """
    SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') ||
      CASE WHEN epoch_us(o_orderdate) % 1000000 = 0 THEN '' ELSE strftime(o_orderdate, '.%f') END AS o_orderdate
    FROM orders
""")
def iso_records_orders(lake):
    return formats.iso_records(lake.table("orders").select("o_orderkey", "o_totalprice", "o_orderdate"))


@query("like_filter", """
    SELECT p_partkey, p_name, p_brand, p_type FROM part
    WHERE p_type ILIKE '%a%' AND lower(p_brand) = lower('BRAND#12') AND regexp_matches(p_name, '(?is)^[p-z].*[a-g]$')
""")
def like_filter(lake):
    part = lake.table("part").select("p_partkey", "p_name", "p_brand", "p_type")
    return filters.where_given(
        part, {"p_brand": "BRAND#12", "p_type": None}, {"p_type": "%A%", "p_name": "[p-z]%[a-g]"}
    )


@query("in_list_filter", """
    SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'FN' WHEN 'P' THEN 'P' END AS type_code
    FROM orders WHERE o_orderstatus IN ('F', 'P')
""")
def in_list_filter(lake):
    kinds = F.create_map(F.lit("F"), F.lit("Function"), F.lit("P"), F.lit("Procedure"))
    rows = lake.table("orders").where(F.col("o_orderstatus").isin("F", "P"))
    return rows.select(
        "o_orderkey", "o_orderstatus", filters.type_code(kinds[F.col("o_orderstatus")]).alias("type_code")
    )


@query("multiway_join", """
    SELECT r_name, n_name, count(*) AS line_count, CAST(sum(CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(38,12))) AS DECIMAL(28,4)) AS price
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY r_name, n_name
""")
def multiway_join(lake):
    t = lake.table
    chain = joins.chain_join(t("lineitem"), [
        (t("orders"), F.col("l_orderkey") == F.col("o_orderkey")),
        (t("customer"), F.col("o_custkey") == F.col("c_custkey")),
        (t("nation"), F.col("c_nationkey") == F.col("n_nationkey")),
        (t("region"), F.col("n_regionkey") == F.col("r_regionkey")),
    ])
    price = F.sum(numbers.money(F.col("l_extendedprice"))).cast("decimal(28,4)").alias("price")
    return chain.groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("line_count"), price)


@query("composite_key_join", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, pair_quantity FROM lineitem
    JOIN (SELECT l_partkey AS p, l_suppkey AS s, sum(l_quantity) AS pair_quantity FROM lineitem GROUP BY 1, 2)
      ON l_partkey = p AND l_suppkey = s
""")
def composite_key_join(lake):
    lines = lake.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    return joins.group_share(lines, ["l_partkey", "l_suppkey"], "l_quantity", "pair_quantity")


@query("left_join_default", """
    SELECT c_custkey, c_name, coalesce(order_count, 0) AS order_count, coalesce(spent, 0) AS spent,
           coalesce(last_status, '') AS last_status
    FROM customer LEFT JOIN (
      SELECT o_custkey, count(*) AS order_count, CAST(sum(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38,12))) AS DECIMAL(28,4)) AS spent,
             arg_max(o_orderstatus, o_orderkey) AS last_status
      FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey
""")
def left_join_default(lake):
    per_customer = lake.table("orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(numbers.money(F.col("o_totalprice"))).cast("decimal(28,4)").alias("spent"),
        # The letter's code: a text among the aggregates would be sorted instead of hashed.
        F.max_by(F.ascii("o_orderstatus"), F.col("o_orderkey")).alias("last_code"),
    ).withColumn("last_status", F.char("last_code")).drop("last_code")
    customers = lake.table("customer").select("c_custkey", "c_name")
    joined = joins.left_with_defaults(
        customers, per_customer, F.col("c_custkey") == F.col("o_custkey"),
        {"order_count": 0, "spent": 0, "last_status": ""},
    )
    return joined.drop("o_custkey")


@query("left_null_flag", """
    SELECT c_custkey, c_mktsegment,
           CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') THEN 0 ELSE 1 END AS without_orders
    FROM customer
""")
def left_null_flag(lake):
    customers = lake.table("customer").select("c_custkey", "c_mktsegment")
    urgent = lake.table("orders").where(F.col("o_orderpriority") == "1-URGENT")
    return joins.missing_flag(customers, urgent, "c_custkey", "o_custkey", "without_orders")


@query("outer_apply", """
    SELECT n_nationkey, n_name, c_custkey, c_acctbal FROM nation LEFT JOIN LATERAL (
      SELECT c_custkey, c_acctbal FROM customer WHERE c_nationkey = n_nationkey
      ORDER BY c_acctbal DESC, c_custkey LIMIT 1) ON true
""")
def outer_apply(lake):
    return joins.outer_apply_best(
        lake.table("nation").select("n_nationkey", "n_name"), lake.table("customer"), "n_nationkey", "c_nationkey",
        [F.col("c_acctbal"), -F.col("c_custkey")], ["c_custkey", "c_acctbal"],
    )


@query("cross_apply", """
    SELECT n_nationkey, n_name, customers FROM nation,
      LATERAL (SELECT count(*) AS customers FROM customer WHERE c_nationkey = n_nationkey HAVING count(*) > 0)
""")
def cross_apply(lake):
    return joins.cross_apply_counts(
        lake.table("nation").select("n_nationkey", "n_name"), lake.table("customer"),
        "n_nationkey", "c_nationkey", "customers",
    )


@query("anti_join", """
    SELECT doc_id, lang, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def anti_join(lake):
    documents = lake.table("documents").select("doc_id", "lang", "source")
    return joins.not_in_set(documents, lake.table("labels"), "doc_id", "doc_id")


@query("group_sum_arith", """
    WITH p AS (SELECT l_returnflag, l_linestatus, CAST(floor(l_quantity) AS BIGINT) AS total,
                      greatest(CAST(floor(l_quantity) AS BIGINT) - l_linenumber, 0) AS used FROM lineitem)
    SELECT l_returnflag, l_linestatus, count(*) AS row_count, CAST(sum(total) * 8 AS BIGINT) AS total_kb,
           CAST(sum(used) * 8 AS BIGINT) AS used_kb, CAST((sum(total) - sum(used)) * 8 AS BIGINT) AS unused_kb
    FROM p GROUP BY l_returnflag, l_linestatus
""")
def group_sum_arith(lake):
    total = F.floor("l_quantity")
    used = F.greatest(total - F.col("l_linenumber"), F.lit(0))
    return aggregates.space_by_group(lake.table("lineitem"), ["l_returnflag", "l_linestatus"], total, used)


@query("decimal_size_agg", """
    SELECT l_returnflag, l_linestatus,
           CAST(CAST(sum(CAST(floor(l_quantity) AS BIGINT)) * 8 AS DECIMAL(30,0)) / 1024 AS DECIMAL(18,4)) AS size_mb
    FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def decimal_size_agg(lake):
    sizes = aggregates.size_by_group(lake.table("lineitem"), ["l_returnflag", "l_linestatus"], F.floor("l_quantity"))
    return sizes.orderBy(F.col("size_mb").desc(), "l_returnflag", "l_linestatus")


@query("conditional_counts", """
    SELECT count(*) FILTER (WHERE o_orderstatus = 'O') AS active, count(*) FILTER (WHERE o_orderstatus = 'F') AS idle,
           count(*) AS total FROM orders
""")
def conditional_counts(lake):
    status = F.col("o_orderstatus")
    return aggregates.conditional_counts(lake.table("orders"), {"active": status == "O", "idle": status == "F"})


@query("object_counts", "SELECT " + ", ".join(f"(SELECT count(*) FROM {t}) AS {t}_rows" for t in COUNTED))
def object_counts(lake):
    return aggregates.table_counts(inventory.file_rows(lake, COUNTED), COUNTED)


@query("filtered_count", """
    SELECT count(*) FILTER (WHERE event_type IN ('click', 'view', 'purchase')) AS listed_types,
           count(*) FILTER (WHERE event_type = 'error') AS errors,
           count(*) FILTER (WHERE user_id > 50) AS later_users,
           (SELECT count(*) FROM conversations WHERE role = 'user') AS user_turns FROM events
""")
def filtered_count(lake):
    kind = F.col("event_type")
    events = aggregates.conditional_counts(
        lake.table("events"),
        {"listed_types": kind.isin("click", "view", "purchase"), "errors": kind == "error",
         "later_users": F.col("user_id") > 50},
        total=None,
    )
    turns = aggregates.conditional_counts(lake.table("conversations"), {"user_turns": F.col("role") == "user"}, None)
    return events.join(F.broadcast(turns))  # one row each


@query("sliding_request_count", """
    SELECT event_id, user_id, ts, count(*) OVER (PARTITION BY user_id ORDER BY ts
      RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS requests FROM events
""")
def sliding_request_count(lake):
    events = lake.table("events").select("event_id", "user_id", "ts")
    return sliding.sliding_counts(events, "user_id", "ts", 86_400)


@query("offset_page", """
    WITH n AS (SELECT least(count(*), 300) AS total FROM part),
    p AS (SELECT total, greatest(1, CAST(ceil(total / 40.0) AS BIGINT)) AS pages FROM n)
    SELECT p_partkey, p_name, pages AS page, CAST(40 AS BIGINT) AS page_size,
           CAST(total AS BIGINT) AS total_items, pages AS total_pages
    FROM (SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_name, p_partkey) AS rn FROM part), p
    WHERE rn > (pages - 1) * 40 AND rn <= least(pages * 40, total)
""")
def offset_page(lake):
    part = lake.table("part").select("p_partkey", "p_name")
    return paging.offset_page(part, ["p_name", "p_partkey"], page=999, page_size=40, limit=300)


@query("page_info", """
    WITH n AS (SELECT count(*) AS total FROM customer),
    p AS (SELECT total, greatest(1, CAST(ceil(total / 200.0) AS BIGINT)) AS pages FROM n)
    SELECT least(7, pages) AS page, CAST(200 AS BIGINT) AS page_size, total AS total_items, pages AS total_pages FROM p
""")
def page_info(lake):
    return paging.page_info(lake.table("customer"), 7, 1000)


@query("page_numbers", """
    SELECT c_custkey, c_acctbal, row_no, CAST((row_no - 1) // 10 + 1 AS BIGINT) AS page FROM (
      SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS row_no FROM customer)
""")
def page_numbers(lake):
    customers = lake.table("customer").select("c_custkey", "c_acctbal")
    return paging.assign_pages(customers, ["c_acctbal", "c_custkey"], "bad size")


@query("top_sessions", """
    SELECT c_custkey, o_orderkey AS request_id, CASE WHEN o_orderkey IS NULL THEN 0 ELSE 1 END AS has_request,
           coalesce(o_totalprice, 0.0) AS elapsed, coalesce(o_shippriority, c_acctbal, 0.0) AS cpu,
           coalesce(o_orderstatus, '') AS command
    FROM customer LEFT JOIN (SELECT *, CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 0.5 END AS o_shippriority
                             FROM orders) ON c_custkey = o_custkey
    ORDER BY CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END, elapsed DESC, cpu DESC, c_custkey, o_orderkey LIMIT 15
""")
def top_sessions(lake):
    sessions = lake.table("customer").select("c_custkey", F.col("c_acctbal").alias("session_cpu"))
    requests = lake.table("orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderkey").alias("request_id"),
        F.col("o_totalprice").alias("elapsed"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") * 0.5).alias("cpu"),
        F.col("o_orderstatus").alias("command"),
    )
    return workload.top_sessions(sessions, requests, "c_custkey")


@query("set_difference", """
    SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def set_difference(lake):
    urgent = lake.table("orders").where(F.col("o_orderpriority") == "1-URGENT")
    return joins.set_minus(lake.table("customer").select("c_custkey"), urgent.select("o_custkey"))
