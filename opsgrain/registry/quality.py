"""Data-quality checks, table lifecycle, predicates and patterns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions.dialect import compare, datediff_boundary, full_match, like_plain, whole_number
from ..operators import quality as q
from ..plans import qa
from ..sources import tables as src
from ..sources import versions
from .base import MESSAGING, frames, register, view, with_views, work_folder

# -- checks ----------------------------------------------------------------------------------


@register(
    "dq_report",
    """
SELECT 'rows' AS check_name, count(*) AS value FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
UNION ALL SELECT 'distinct_keys', count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
UNION ALL SELECT 'duplicate_rows', count(*) FROM (SELECT count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1
UNION ALL SELECT 'orders_without_lines', count(DISTINCT o_orderkey) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'lines_without_order', count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'null_or_missing', count(*) FROM lineitem WHERE l_shipdate IS NULL OR l_returnflag IS NULL
UNION ALL SELECT 'distinct_flags', count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem WHERE l_quantity > 10)
UNION ALL SELECT 'bad_flags', count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')""",
)
def dq_report(spark, sf_dir):
    """Row checks in one pass over the lines, key checks in another."""
    t = src.load(spark, sf_dir, "lineitem", "orders")
    flags = {"distinct_flags": (["l_returnflag", "l_linestatus"], F.col("l_quantity") > 10)}
    checks = {"null_or_missing": q.any_null("l_shipdate", "l_returnflag"), "bad_flags": q.not_accepted("l_returnflag", ["A", "N"])}
    by_row = q.as_rows(q.row_report(t["lineitem"], checks, flags))
    keys = q.key_report(t["lineitem"], ["l_orderkey", "l_linenumber"], t["orders"], "o_orderkey")
    return by_row.union(q.as_rows(keys, {"without_child": "orders_without_lines", "without_parent": "lines_without_order"}))


@register(
    "dq_while_writing",
    """
SELECT 'rows' AS check_name, count(*) AS value FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
UNION ALL SELECT 'distinct_keys', count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
UNION ALL SELECT 'duplicate_rows', count(*) FROM (SELECT count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1
UNION ALL SELECT 'null_or_missing', count(*) FROM lineitem WHERE l_shipdate IS NULL OR l_returnflag IS NULL
UNION ALL SELECT 'distinct_flags', count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem WHERE l_quantity > 10)
UNION ALL SELECT 'bad_flags', count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')""",
)
def dq_while_writing(spark, sf_dir):
    """The checks of a fact counted by the query that writes it."""
    lines = src.load(spark, sf_dir, "lineitem")["lineitem"]
    checks = {"null_or_missing": q.any_null("l_shipdate", "l_returnflag"), "bad_flags": q.not_accepted("l_returnflag", ["A", "N"])}
    flags = {"distinct_flags": (["l_returnflag", "l_linestatus"], F.col("l_quantity") > 10)}
    watch = q.Watch(lines, checks, keys=["l_orderkey", "l_linenumber"], distinct=flags)
    versions.publish(watch.rows, f"{work_folder(spark, 'watched')}/production")
    return watch.report(spark)


@register(
    "key_checks",
    """
SELECT 'rows' AS check_name, count(*) AS value FROM orders WHERE o_custkey IS NOT NULL
UNION ALL SELECT 'distinct_keys', count(DISTINCT o_custkey) FROM orders
UNION ALL SELECT 'left', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT 'right', count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'nulls', count(*) FROM orders WHERE o_orderstatus IS NULL OR o_orderpriority IS NULL
UNION ALL SELECT 'statuses', count(DISTINCT o_orderstatus) FROM orders WHERE o_totalprice > 1000
UNION ALL SELECT 'outside', count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F')""",
)
def key_checks(spark, sf_dir):
    """The single checks, each on its own."""
    t = src.load(spark, sf_dir, "orders", "customer")
    orders, total = t["orders"], F.count(F.lit(1)).cast("bigint").alias("value")
    unique = q.key_uniqueness(orders, ["o_custkey"])
    out = q.as_rows(unique, {"row_count": "rows"})
    stray = q.orphans(t["customer"].select(F.col("c_custkey").alias("k")), orders.select(F.col("o_custkey").alias("k")), "k")
    out = out.union(stray.select(F.col("side").alias("check_name"), F.col("orphans").cast("bigint").alias("value")))

    def named(df, name):
        return df.select(F.lit(name).alias("check_name"), "value")

    out = out.union(named(q.null_rows(orders, "o_orderstatus", "o_orderpriority").agg(total), "nulls"))
    out = out.union(named(q.distinct_values(orders, ["o_orderstatus"], F.col("o_totalprice") > 1000).agg(total), "statuses"))
    bad = q.accepted_values(orders, "o_orderstatus", ["O", "F"]).agg(F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint").alias("value"))
    return out.union(named(bad, "outside"))


@register(
    "duplicate_rows",
    """
WITH d AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS key_count FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, key_count FROM d WHERE key_count > 1""",
)
def duplicate_rows(spark, sf_dir):
    items = src.load(spark, sf_dir, "lineitem")["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return q.duplicates(items, ["l_orderkey", "l_linenumber"])


@register(
    "reconcile_sources",
    """
WITH a AS (SELECT o_orderkey, o_totalprice, o_custkey % 7 AS kind FROM orders WHERE o_orderstatus <> 'P'),
b AS (SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_custkey % 7 AS kind FROM orders WHERE o_orderpriority <> '5-LOW')
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'only_a' WHEN a.o_orderkey IS NULL THEN 'only_b' ELSE 'both' END AS found_in,
  a.kind AS kind_a, b.kind AS kind_b, a.kind - b.kind AS kind_diff, a.o_totalprice AS o_totalprice_a, b.o_totalprice AS o_totalprice_b,
  round(a.o_totalprice - b.o_totalprice, 4) AS o_totalprice_diff FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey""",
)
def reconcile_sources(spark, sf_dir):
    orders = src.load(spark, sf_dir, "orders")["orders"].withColumn("kind", F.col("o_custkey") % 7)
    a = orders.filter("o_orderstatus <> 'P'")
    b = src.update_where(
        orders.filter("o_orderpriority <> '5-LOW'"), F.col("o_totalprice") > 200000, {"o_totalprice": F.col("o_totalprice") + 1}
    )
    out = q.reconcile(a, b, ["o_orderkey"], ["o_totalprice", "kind"])
    return out.withColumn("o_totalprice_diff", F.round("o_totalprice_diff", 4))


@register(
    "grand_total_check",
    """
WITH g AS (SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1),
d AS (SELECT CAST(sum(n) AS double) AS n, CAST(sum(customers) AS double) AS customers FROM g), t AS (SELECT CAST(count(*) AS double) AS n, CAST(count(DISTINCT o_custkey) AS double) AS customers FROM orders)
SELECT 'n' AS measure, d.n AS detail_sum, t.n AS total, d.n = t.n AS matches FROM d, t
UNION ALL SELECT 'customers', d.customers, t.customers, d.customers = t.customers FROM d, t""",
)
def grand_total_check(spark, sf_dir):
    orders = src.load(spark, sf_dir, "orders")["orders"]
    measures = [F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("customers")]
    return q.grand_total_check(orders.groupBy("o_orderstatus").agg(*measures), orders.agg(*measures), ["n", "customers"])


LEGACY = view(
    "events",
    lambda d: [
        "event_id as touch_id", "cast(floor(event_id / 3) as bigint) as case_id", "ts as touch_start_time", "ts as touch_assignment_time",
        f"{d.plus('ts', f'{d.k} * 30')} as touch_end_time", f"case when {d.k} % 4 = 0 then null else {d.k} end as handle_time_seconds",
        f"{d.k} * 30 + {d.k} % 2 as touch_lifetime_seconds", "event_type as queue_name",
        "case when event_type = 'view' then null else event_type end as communication_channel",
    ],
)
NEWER = view(
    "events",
    lambda d: [
        "event_id + 7 as touch_id", "cast(floor(event_id / 5) as bigint) as case_id", "ts as touch_start_time", f"{d.plus('ts', '60')} as touch_end_time",
        f"{d.k} as handle_time", "event_type as queue_name", f"case when {d.k} % 9 = 0 then null else 'Chat' end as channel",
    ],
)


@register(
    "touch_reconciliation",
    with_views(
        """
SELECT m.case_id, m.touch_id, strftime(m.touch_start_time, '%Y-%m-%d %H:%M:%S') AS touch_start_time, k.n AS unified_touches, k.h AS unified_handle_time
FROM m JOIN (SELECT case_id, count(DISTINCT touch_id) AS n, CAST(sum(handle_time) AS bigint) AS h FROM u GROUP BY 1) k ON m.case_id = k.case_id
WHERE m.handle_time_seconds IS NULL AND m.touch_start_time >= TIMESTAMP '2023-01-01'""",
        m=LEGACY, u=NEWER,
    ),
)
def touch_reconciliation(spark, sf_dir):
    return qa.missing_handle_time(frames(spark, sf_dir, messaging_touches=LEGACY, unified_touches=NEWER))


@register(
    "touch_reconciliation_total",
    with_views(
        """
SELECT count(DISTINCT m.case_id) AS total_cases, count(DISTINCT u.touch_id) AS total_touches, round(sum(u.handle_time / 3600), 6) AS total_handle_hours
FROM m JOIN u ON m.case_id = u.case_id WHERE m.handle_time_seconds IS NULL AND m.touch_start_time >= TIMESTAMP '2023-01-01'""",
        m=LEGACY, u=NEWER,
    ),
)
def touch_reconciliation_total(spark, sf_dir):
    out = qa.missing_handle_summary(frames(spark, sf_dir, messaging_touches=LEGACY, unified_touches=NEWER))
    return out.withColumn("total_handle_hours", F.round("total_handle_hours", 6))


@register(
    "touch_lifetime_check",
    with_views(
        """SELECT touch_id, date_diff('second', touch_assignment_time, touch_end_time) AS computed, touch_lifetime_seconds,
  date_diff('second', touch_assignment_time, touch_end_time) - touch_lifetime_seconds AS difference FROM m""",
        m=LEGACY,
    ),
)
def touch_lifetime_check(spark, sf_dir):
    return qa.lifetime_check(LEGACY.spark(spark, sf_dir)).select("touch_id", "computed", "touch_lifetime_seconds", "difference")


@register(
    "touch_sources_stacked",
    with_views(
        """
SELECT db, count(*) AS n, CAST(sum(handle_time) AS bigint) AS handle_time, count(DISTINCT queue_name) AS queues FROM (
  SELECT handle_time_seconds AS handle_time, queue_name, 'legacy' AS db FROM m UNION ALL SELECT handle_time, queue_name, 'unified' FROM u) GROUP BY 1
UNION ALL SELECT 'without_channel', count(DISTINCT touch_id), NULL, NULL FROM u WHERE channel IS NULL
UNION ALL SELECT 'channels', count(*), NULL, NULL FROM (SELECT DISTINCT communication_channel FROM m WHERE touch_start_time >= TIMESTAMP '2022-01-01')""",
        m=LEGACY, u=NEWER,
    ),
)
def touch_sources_stacked(spark, sf_dir):
    t = frames(spark, sf_dir, messaging_touches=LEGACY, unified_touches=NEWER)
    both = qa.both_sources(t).groupBy("db").agg(
        F.count(F.lit(1)).alias("n"), F.sum("handle_time").alias("handle_time"), F.count_distinct("queue_name").alias("queues")
    )

    def single(df, name):
        none = F.lit(None).cast("bigint")
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("db"), "n", none.alias("handle_time"), none.alias("queues"))

    return both.union(single(qa.touches_without_channel(t["unified_touches"]), "without_channel")).union(
        single(qa.channels_in_use(t["messaging_touches"]), "channels")
    )


# -- lifecycle ---------------------------------------------------------------------------------


@register(
    "trailing_reload",
    """
WITH fresh AS (SELECT CASE WHEN extract(hour FROM ts) = 3 THEN NULL ELSE date_trunc('hour', ts) END AS h, event_type, count(*) AS n FROM events GROUP BY 1, 2),
old AS (SELECT h, event_type, n - 1 AS n FROM fresh)
SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS ts, event_type, n FROM (
  SELECT * FROM old WHERE h IS NULL OR CAST(h AS date) < DATE '2024-01-20' - INTERVAL 7 DAY
  UNION ALL SELECT * FROM fresh WHERE CAST(h AS date) >= DATE '2024-01-20' - INTERVAL 7 DAY)""",
)
def trailing_reload(spark, sf_dir):
    from ..functions.dialect import trunc

    events = src.load(spark, sf_dir, "events")["events"]
    hour = F.when(F.hour("ts") != 3, trunc("hour", "ts"))  # rows without a time stay in the table
    fresh = events.groupBy(hour.alias("ts"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    old = fresh.withColumn("n", F.col("n") - 1)
    return src.trailing_reload(old, fresh, "ts", date(2024, 1, 20))


@register(
    "reload_partitions",
    """
SELECT strftime(CAST(ts AS date), '%Y-%m-%d') AS ds, count(*) * CASE WHEN CAST(ts AS date) >= DATE '2024-01-13' THEN 1 ELSE 10 END AS n FROM events GROUP BY CAST(ts AS date)""",
)
def reload_partitions(spark, sf_dir):
    """The reload as a file table: the whole history is written, then only the trailing days again."""
    events = src.load(spark, sf_dir, "events")["events"]
    daily = events.groupBy(F.col("ts").cast("date").cast("timestamp_ntz").alias("ts")).agg(F.count(F.lit(1)).alias("n"))
    root = work_folder(spark, "reload")
    path = f"{root}/staging"
    src.write(daily.withColumn("n", F.col("n") * 10).withColumn("ds", F.col("ts").cast("date")), path, "overwrite", ["ds"])
    versions.publish(spark.read.parquet(path), f"{root}/production", ["ds"])
    src.reload_partitions(daily, path, "ts", date(2024, 1, 20))
    trailing = spark.read.parquet(path).filter(F.col("ds") >= F.lit("2024-01-13").cast("date"))
    versions.reload_published(trailing, f"{root}/production", "ts", date(2024, 1, 20))
    return versions.published(spark, f"{root}/production").select("ds", "n")


@register(
    "conformed_fact",
    """SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ts, o_orderpriority AS queue_id, CAST(CAST(floor(o_totalprice / 8 + 0.5) AS bigint) AS varchar) AS minutes FROM orders""",
)
def conformed_fact(spark, sf_dir):
    from pyspark.sql.types import DecimalType

    contract = src.schema(("ts", "timestamp_ntz", "day"), ("queue_id", "string", "queue"), ("minutes", DecimalType(38, 0), "minutes"))
    orders = src.load(spark, sf_dir, "orders")["orders"]
    fact = src.conform(orders.select("o_orderdate", "o_orderpriority", F.col("o_totalprice") / 8), contract, positional=True)
    return fact.withColumn("minutes", F.col("minutes").cast("string"))


@register(
    "update_rename_add",
    """
SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'big' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority AS priority, CAST(NULL AS varchar) AS note,
  CASE WHEN o_totalprice > 250000 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey FROM orders""",
)
def update_rename_add(spark, sf_dir):
    orders = src.load(spark, sf_dir, "orders")["orders"]
    out = src.update_where(orders, F.col("o_totalprice") > 250000, {"o_orderstatus": F.lit("big"), "o_custkey": F.col("o_custkey") + 1})
    out = src.add_column(src.rename(out, "o_orderpriority", "priority"), "note")
    return out.select("o_orderkey", "o_orderstatus", "priority", "note", "o_custkey")


@register(
    "rolling_ordinal",
    """
WITH r AS (SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)
SELECT o_orderkey, rn, CASE WHEN rn < 10 THEN 'new@example.com' END AS name FROM r WHERE rn < 100""",
)
def rolling_ordinal(spark, sf_dir):
    """First rows of a global order: numbered after the top rows are known, so no global sort."""
    from pyspark.sql import Window

    orders = src.load(spark, sf_dir, "orders")["orders"]
    top = orders.select("o_orderkey").orderBy("o_orderkey").limit(99)
    out = top.withColumn("rn", F.row_number().over(Window.orderBy("o_orderkey")))
    return out.withColumn("name", F.when(F.col("rn") < 10, "new@example.com"))


@register(
    "keyed_lookup",
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey IN (3, 14, 159) AND CAST(o_orderdate AS date) >= DATE '1996-05-05'",
)
def keyed_lookup(spark, sf_dir):
    orders = src.load(spark, sf_dir, "orders")["orders"]
    return src.lookup(src.since(orders, "o_orderdate", "1996-05-05"), "o_custkey", [3, 14, 159, None]).select("o_orderkey", "o_custkey", "o_orderstatus")


@register(
    "tenant_source",
    "SELECT s_nationkey AS nation, count(*) AS n FROM supplier GROUP BY 1",
)
def tenant_source(spark, sf_dir):
    t = src.load(spark, sf_dir, "customer", "supplier")
    shapes = {"inside": t["customer"].select(F.col("c_nationkey").alias("nation")), "outside": t["supplier"].select(F.col("s_nationkey").alias("nation"))}
    chosen = src.resolve_source(shapes, {"vendor": "outside"}, "vendor", "inside")
    return chosen.groupBy("nation").agg(F.count(F.lit(1)).alias("n"))


# -- predicates, patterns, dialect ------------------------------------------------------------------


@register(
    "pattern_validation",
    """
SELECT count(*) AS docs, count_if(regexp_full_match(text, '[0-9]{3}-[0-9]{2}-[0-9]{4}'))::bigint AS whole_ssn, count_if(regexp_matches(text, '[0-9]{3}-[0-9]{2}-[0-9]{4}'))::bigint AS has_ssn,
  count_if(text LIKE '%a!_b%' ESCAPE '!')::bigint AS literal_underscore, count_if(text ILIKE '%a_b%')::bigint AS wildcard_underscore,
  count_if(regexp_full_match(lang, 'e.+|f.'))::bigint AS lang_match, count_if(text NOT ILIKE '%the%')::bigint AS without_the,
  count_if(source IN ('src1', 'src2', NULL))::bigint AS listed FROM documents""",
)
def pattern_validation(spark, sf_dir):
    docs = src.load(spark, sf_dir, "documents")["documents"]
    ssn = q.FORMATS["ssn"]
    return docs.agg(
        F.count(F.lit(1)).alias("docs"),
        F.count_if(full_match("text", ssn)).alias("whole_ssn"),
        F.count_if(F.col("text").rlike(ssn)).alias("has_ssn"),
        F.count_if(like_plain("text", "%a!_b%", escape="!")).alias("literal_underscore"),
        F.count_if(like_plain("text", "%a_b%", ignore_case=True)).alias("wildcard_underscore"),
        F.count_if(full_match("lang", "e.+|f.")).alias("lang_match"),
        F.count_if(~like_plain("text", "%the%", ignore_case=True)).alias("without_the"),
        F.count_if(F.col("source").isin("src1", "src2", None)).alias("listed"),
    )


@register(
    "pattern_truth_rows",
    """
SELECT doc_id, lang, source, regexp_full_match(lang, 'e.+|f.') AS two_forms, regexp_full_match(lang, 'e') AS part_only, regexp_full_match(lang, '..') AS any_two FROM documents""",
)
def pattern_truth_rows(spark, sf_dir):
    docs = src.load(spark, sf_dir, "documents")["documents"].select("doc_id", "lang", "source")
    return qa.pattern_truth_table(docs, "lang", {"two_forms": "e.+|f.", "part_only": "e", "any_two": ".."})


@register(
    "wildcard_truth_rows",
    """
SELECT page_id, url, url ILIKE '%UTM_source%' AS wildcard, url ILIKE '%utm!_source%' ESCAPE '!' AS escaped, url ILIKE '%page!_2%' ESCAPE '!' AS other, url ILIKE '%page_2%' AS any_sign FROM pages""",
)
def wildcard_truth_rows(spark, sf_dir):
    pages = src.load(spark, sf_dir, "pages")["pages"].select("page_id", "url")
    tests = {"wildcard": ("%UTM_source%", None), "escaped": ("%utm!_source%", "!"), "other": ("%page!_2%", "!"), "any_sign": ("%page_2%", None)}
    return qa.wildcard_truth_table(pages, "url", tests)


@register(
    "table_preview",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 100",
)
def table_preview(spark, sf_dir):
    """The first rows of an ordered report: each task keeps the first ones only."""
    orders = src.load(spark, sf_dir, "orders")["orders"].select("o_orderkey", "o_custkey", "o_totalprice")
    return src.preview(src.ordered_output(orders, ("o_totalprice", "desc", "last"), ("o_orderkey", "asc", "first")), 100)


_DESCRIBED = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}


@register(
    "table_description",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{kind}' AS data_type, count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values FROM orders"
        for c, kind in _DESCRIBED.items()
    ),
)
def table_description(spark, sf_dir):
    return src.profile(src.load(spark, sf_dir, "orders")["orders"])


@register(
    "ordered_report",
    """
WITH r AS (SELECT l_returnflag, CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_linestatus END AS status, count(*) AS n, sum(l_quantity) AS qty FROM lineitem GROUP BY ALL)
SELECT *, row_number() OVER (ORDER BY status DESC NULLS LAST, n ASC NULLS FIRST, l_returnflag) AS place FROM r""",
)
def ordered_report(spark, sf_dir):
    """A report in a stated order with stated places of NULL; the place is that of the output."""
    items = src.load(spark, sf_dir, "lineitem")["lineitem"]
    status = F.when(F.col("l_linestatus") != "F", F.col("l_linestatus")).alias("status")
    report = items.groupBy("l_returnflag", status).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))
    order = (("status", "desc", "last"), ("n", "asc", "first"), ("l_returnflag", "asc", "first"))
    return src.ordered_output(report, *order, place="place")


@register(
    "version_compare",
    """
SELECT op, CAST(count_if(CASE op WHEN '<' THEN v < 25 WHEN '<=' THEN v <= 25 WHEN '=' THEN v = 25 WHEN '>' THEN v > 25 ELSE v >= 25 END) AS bigint) AS as_number,
  CAST(count_if(CASE op WHEN '<' THEN t < '25' WHEN '<=' THEN t <= '25' WHEN '=' THEN t = '25' WHEN '>' THEN t > '25' ELSE t >= '25' END) AS bigint) AS as_text
FROM (SELECT p_size AS v, CAST(p_size AS varchar) AS t, unnest(['<', '<=', '=', '>', '>=']) AS op FROM part) GROUP BY 1""",
)
def version_compare(spark, sf_dir):
    sizes = src.load(spark, sf_dir, "part")["part"].select(F.col("p_size").cast("string").alias("v"))
    counts = sizes.agg(
        *[F.count_if(compare("v", op, "25", numeric_version=True)).alias(f"n{i}") for i, op in enumerate(("<", "<=", "=", ">", ">="))],
        *[F.count_if(compare("v", op, "25")).alias(f"t{i}") for i, op in enumerate(("<", "<=", "=", ">", ">="))],
    )
    ops = F.array(
        *[
            F.struct(F.lit(op).alias("op"), F.col(f"n{i}").alias("as_number"), F.col(f"t{i}").alias("as_text"))
            for i, op in enumerate(("<", "<=", "=", ">", ">="))
        ]
    )
    return counts.select(F.explode(ops).alias("r")).select("r.*")


@register(
    "boundary_differences",
    """
SELECT o_orderkey, date_diff('day', o_orderdate, l_shipdate) AS days, date_diff('day', date_trunc('week', o_orderdate), date_trunc('week', l_shipdate)) // 7 AS weeks, date_diff('month', o_orderdate, l_shipdate) AS months,
  date_diff('quarter', o_orderdate, l_shipdate) AS quarters, date_diff('year', o_orderdate, l_shipdate) AS years
FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS l_shipdate FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""",
)
def boundary_differences(spark, sf_dir):
    t = src.load(spark, sf_dir, "orders", "lineitem")
    last = t["lineitem"].groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("l_shipdate"))
    rows = t["orders"].join(last, "o_orderkey")
    return rows.select(
        "o_orderkey",
        *[datediff_boundary(u, "o_orderdate", "l_shipdate").alias(f"{u}s") for u in ("day", "week", "month", "quarter", "year")],
    )


@register(
    "time_functions",
    with_views(
        """
SELECT touch_id, date_diff('second', touch_start_time, touch_assignment_time) AS secs, date_diff('minute', touch_start_time, touch_assignment_time) AS mins,
  date_diff('hour', touch_start_time, touch_assignment_time) AS hrs, strftime(time_bucket(INTERVAL 30 MINUTE, touch_assignment_time), '%Y-%m-%d %H:%M:%S') AS slice,
  strftime((touch_start_time AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS utc, strftime(date_trunc('week', touch_start_time), '%Y-%m-%d') AS week,
  CAST(floor(handle_time_seconds / 60 + 0.5) AS bigint) AS whole_minutes FROM m""",
        m=MESSAGING,
    ),
)
def time_functions(spark, sf_dir):
    from ..functions.dialect import PACIFIC, UTC, convert_tz, time_slice, trunc_date

    m = MESSAGING.spark(spark, sf_dir)
    span = ("touch_start_time", "touch_assignment_time")
    return m.select(
        "touch_id", datediff_boundary("second", *span).alias("secs"), datediff_boundary("minute", *span).alias("mins"),
        datediff_boundary("hour", *span).alias("hrs"), time_slice("touch_assignment_time", 30).alias("slice"),
        convert_tz("touch_start_time", PACIFIC, UTC).alias("utc"), trunc_date("week", "touch_start_time").alias("week"),
        whole_number(F.col("handle_time_seconds") / 60).cast("bigint").alias("whole_minutes"),
    )
