"""Driver queries: every operator on the driver's tables, with its SQL twin (survey 7.6).

The tables share nothing with registries and endpoints, so each query builds its operator's input from
columns of a table, by the same expressions on both sides. All queries read whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registrylake.functions import classify as C
from registrylake.functions import jsonhash as J
from registrylake.functions import text as X
from registrylake.operators import chains, exclusions, latest, merging, pacing, state
from registrylake.operators.rangetable import RangeTable
from registrylake.operators.shared import scratch
from registrylake.plans import quality
from registrylake.sources import runlog

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def us(c: str | Column) -> Column:
    return F.unix_micros(F.col(c) if isinstance(c, str) else c)


# -- latest rows -------------------------------------------------------------------------------------
LATEST = "SELECT user_id, event_id, event_type, epoch_us(ts) AS ts_us FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events {where}) WHERE rn = 1"


@query(LATEST.format(where=""))
def latest_per_key(spark, sf):
    rows = events(spark, sf).select("user_id", "event_id", "event_type", "ts")
    return latest.latest_per_key(rows, ["user_id"], "ts", "event_id").select("user_id", "event_id", "event_type", us("ts").alias("ts_us"))


@query(LATEST.format(where="WHERE event_type <> 'view'"))
def latest_with_evidence(spark, sf):
    rows = events(spark, sf).select("user_id", "event_id", "event_type", "ts")
    return latest.latest_with_evidence(rows, ["user_id"], "ts", "event_id", F.col("event_type") != "view").select("user_id", "event_id", "event_type", us("ts").alias("ts_us"))


def runs(spark, sf) -> DataFrame:
    day = F.date_trunc("day", "ts")
    days = events(spark, sf).select(day.alias("started_at")).distinct()
    done = F.when(F.dayofmonth("started_at") % 5 != 0, F.col("started_at") + F.expr("INTERVAL 30 HOURS"))
    return days.select(F.date_format("started_at", "yyyyMMdd").alias("run_id"), "started_at", done.alias("finished_at"))


def purchases(spark, sf) -> DataFrame:
    return events(spark, sf).filter("event_type = 'purchase' AND value > 20")


RUNS = """WITH runs AS (SELECT strftime(d, '%Y%m%d') AS run_id, d AS started_at, CASE WHEN day(d) % 5 <> 0 THEN d + INTERVAL 30 HOURS END AS finished_at FROM (SELECT DISTINCT date_trunc('day', ts) AS d FROM events)),
hit AS (SELECT * FROM runs r WHERE finished_at IS NOT NULL AND EXISTS (SELECT 1 FROM events e WHERE event_type = 'purchase' AND value > 20 AND e.ts BETWEEN r.started_at AND r.finished_at)),
newest AS (SELECT * FROM hit ORDER BY started_at DESC, run_id LIMIT 1) """


@query(RUNS + "SELECT run_id, epoch_us(started_at) AS started_us, epoch_us(finished_at) AS finished_us FROM hit")
def runs_with_rows(spark, sf):
    return latest.runs_with_rows(runs(spark, sf), purchases(spark, sf), "ts").select("run_id", us("started_at").alias("started_us"), us("finished_at").alias("finished_us"))


@query(RUNS + "SELECT run_id, epoch_us(started_at) AS started_us, epoch_us(finished_at) AS finished_us FROM newest")
def latest_run_with_rows(spark, sf):
    return latest.latest_run_with_rows(runs(spark, sf), purchases(spark, sf), "ts").select("run_id", us("started_at").alias("started_us"), us("finished_at").alias("finished_us"))


@query(RUNS + "SELECT e.event_id, n.run_id FROM events e, newest n WHERE e.ts BETWEEN n.started_at AND n.finished_at")
def rows_in_latest_run(spark, sf):
    run = latest.latest_run_with_rows(runs(spark, sf), purchases(spark, sf), "ts")
    return latest.rows_in_run(events(spark, sf), run, "ts").select("event_id", "run_id")


@query(r"""WITH v AS (SELECT p_brand, p_partkey, CASE WHEN p_partkey % 11 = 0 THEN 'beta' ELSE 'v' || p_size % 3 || '.' || p_partkey % 7 || '.' || p_partkey % 5 || '-rc' END AS version, p_size > 45 AND p_brand < 'Brand#3' AS flag FROM part),
s AS (SELECT *, coalesce(try_cast(nullif(regexp_extract(version, '^v?(\d+)\.(\d+)\.(\d+)', 1), '') AS BIGINT), 0) AS a, coalesce(try_cast(nullif(regexp_extract(version, '^v?(\d+)\.(\d+)\.(\d+)', 2), '') AS BIGINT), 0) AS b, coalesce(try_cast(nullif(regexp_extract(version, '^v?(\d+)\.(\d+)\.(\d+)', 3), '') AS BIGINT), 0) AS c FROM v)
SELECT p_brand, p_partkey, version FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY flag DESC, a DESC, b DESC, c DESC, p_partkey) AS rn FROM s) WHERE rn = 1""")
def argmax_semver(spark, sf):
    k = F.col("p_partkey")
    version = F.when(k % 11 == 0, "beta").otherwise(F.concat(F.lit("v"), F.col("p_size") % 3, F.lit("."), k % 7, F.lit("."), k % 5, F.lit("-rc")))
    rows = table(spark, sf, "part").select("p_brand", "p_partkey", version.alias("version"), ((F.col("p_size") > 45) & (F.col("p_brand") < "Brand#3")).alias("flag"))
    return latest.argmax_semver(rows, "p_brand", "version", "flag", "p_partkey").select("p_brand", "p_partkey", "version")


@query("SELECT event_type, epoch_us(max(ts)) AS newest_us FROM events GROUP BY event_type")
def watermark(spark, sf):
    return latest.watermark(events(spark, sf), ["event_type"], "ts").select("event_type", us("newest").alias("newest_us"))


# -- joins and merges --------------------------------------------------------------------------------
@query("SELECT lang, count(*) AS n_docs, count(quality) AS measured, count(*) - count(quality) AS unmeasured, CAST(sum(quality) AS BIGINT) AS good FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang")
def left_join_unmeasured(spark, sf):
    rows = merging.left_measures(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"), F.count("quality").alias("measured"), F.count_if(F.col("quality").isNull()).alias("unmeasured"), F.sum("quality").alias("good"))


@query("SELECT c_custkey, p AS last_price FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS p FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey")
def last_wins_join(spark, sf):
    last = merging.last_wins(table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_totalprice").alias("last_price")), "c_custkey", "o_orderkey")
    return merging.left_measures(table(spark, sf, "customer").select("c_custkey"), last, "c_custkey")


@query("""SELECT sha256(text) AS text_hash, arg_min(lang, doc_id) AS lang, arg_min(source, doc_id) AS source, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM documents GROUP BY text""")
def first_wins_merge(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("text_hash"), "lang", "source", F.col("source").alias("seen"))
    return merging.first_wins(rows, "text_hash", "doc_id", ["lang", "source"], "seen").select("text_hash", "lang", "source", F.array_join("seen_set", ",").alias("sources"))


@query("SELECT source, count(*) AS fetched, arg_max(n_chars, doc_id) AS upstream_total, arg_max(n_chars, doc_id) > 2000 AS truncated FROM documents GROUP BY source")
def coverage_by_query(spark, sf):
    return merging.coverage_by_query(table(spark, sf, "documents").select("source", "doc_id", "n_chars"), "source", "n_chars", "doc_id", 2000)


@query("SELECT 'a' AS side, event_id FROM events WHERE value < 30 UNION ALL SELECT 'b', event_id FROM events WHERE value > 10")
def bag_union(spark, sf):
    e = table(spark, sf, "events")
    return merging.bag_union(e.filter("value < 30").select(F.lit("a").alias("side"), "event_id"), e.filter("value > 10").select(F.lit("b").alias("side"), "event_id"))


@query("WITH k AS (SELECT doc_id FROM documents ORDER BY n_chars DESC, doc_id LIMIT 400) SELECT 'kept' AS what, doc_id AS n FROM k UNION ALL SELECT 'dropped', greatest(count(*) - 400, 0) FROM documents")
def capped_with_remainder(spark, sf):
    kept, left = merging.capped(table(spark, sf, "documents").select("doc_id", "n_chars"), [F.desc("n_chars"), "doc_id"], 400)
    return kept.select(F.lit("kept").alias("what"), F.col("doc_id").alias("n")).unionByName(left.select(F.lit("dropped").alias("what"), F.col("dropped").alias("n")))


@query("SELECT c_name, CAST(floor((row_number() OVER (ORDER BY c_name) - 1) / 128) AS BIGINT) AS batch FROM (SELECT DISTINCT c_name FROM customer)")
def lookup_batches(spark, sf):
    return merging.lookup_batches(table(spark, sf, "customer").select("c_name"), "c_name")


# -- state -------------------------------------------------------------------------------------------
@query("""SELECT o_orderkey, sha256('{"status":"' || o_orderstatus || '","priority":"' || o_orderpriority || '"}') AS definition_hash, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'new' ELSE 'changed' END AS change
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' OR (o_orderpriority = '1-URGENT' AND o_orderstatus <> 'O')""")
def snapshot_on_change(spark, sf):
    o = table(spark, sf, "orders")
    made = lambda status: F.sha2(F.to_json(F.struct(status.alias("status"), F.col("o_orderpriority").alias("priority"))), 256)
    before = F.when(F.col("o_orderpriority") == "1-URGENT", "O").otherwise(F.col("o_orderstatus"))
    stored = o.filter("o_orderdate < '1998-01-01'").select("o_orderkey", made(before).alias("definition_hash"))
    return state.changed(stored, o.select("o_orderkey", made(F.col("o_orderstatus")).alias("definition_hash")), ["o_orderkey"], ["definition_hash"])


@query("""SELECT c_custkey, 'changed' AS change FROM customer WHERE c_acctbal < 0 AND c_mktsegment <> 'NONE' OR c_acctbal > 9000 OR c_nationkey = 3""")
def snapshot_on_any_of_three(spark, sf):
    c = table(spark, sf, "customer").withColumns({"definition_hash": F.sha2("c_name", 256), "status_hash": F.sha2("c_mktsegment", 256), "status_message_hash": F.sha2(F.col("c_nationkey").cast("string"), 256)})
    old = c.withColumns({"status_hash": F.when(F.col("c_acctbal") < 0, F.sha2(F.lit("NONE"), 256)).otherwise(F.col("status_hash")), "status_message_hash": F.when(F.col("c_acctbal") <= 9000, F.col("status_message_hash")), "definition_hash": F.when(F.col("c_nationkey") == 3, F.lit("")).otherwise(F.col("definition_hash"))})
    hashes = ["definition_hash", "status_hash", "status_message_hash"]
    return state.changed(old.select("c_custkey", *hashes), c.select("c_custkey", *hashes), ["c_custkey"], hashes).select("c_custkey", "change")


@query("SELECT CASE WHEN event_type = 'purchase' THEN 'bought' ELSE 'looked' END AS run, event_id, user_id, value FROM events")
def committed_append(spark, sf):
    """K2, K4, K6: two runs are appended, one is repeated with other rows, and one is a dry run; only the first two count."""
    rows = table(spark, sf, "events").select("event_id", "user_id", "value")
    kind = table(spark, sf, "events").select("event_type", "event_id", "user_id", "value")
    path = scratch(spark, "events-log")
    runlog.append_run(kind.filter("event_type = 'purchase'"), path, "bought", rows.columns)
    runlog.append_run(kind.filter("event_type <> 'purchase'"), path, "looked", rows.columns)
    runlog.append_run(rows, path, "bought")
    runlog.append_run(rows, path, "tried", dry_run=True)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    each = [runlog.committed(spark, path, schema, r["run"]).select(F.lit(r["run"]).alias("run"), *rows.columns) for r in runlog.runs(spark, path)]
    return merging.bag_union(*each)


ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double"


@query("""WITH m AS (SELECT max(o_orderkey) AS top FROM orders),
incoming AS (SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders, m WHERE 100 * o_orderkey > 98 * top UNION ALL SELECT o_orderkey + top + 1, 'N', o_totalprice FROM orders, m WHERE 100 * o_orderkey <= top)
SELECT coalesce(o.o_orderkey, i.o_orderkey) AS o_orderkey, o.o_custkey, CASE WHEN i.o_orderkey IS NULL THEN o.o_orderstatus ELSE i.o_orderstatus END AS o_orderstatus, CASE WHEN i.o_orderkey IS NULL THEN CAST(o.o_totalprice AS DOUBLE) ELSE CAST(i.o_totalprice AS DOUBLE) END AS o_totalprice
FROM orders o FULL JOIN incoming i ON o.o_orderkey = i.o_orderkey""")
def upsert_ranges(spark, sf):
    """K1, J3 on files of key ranges: all orders are stored, then the last ones change and new ones come; other files stay as they are."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice"))
    top = rows.agg(F.max("o_orderkey")).first()[0] or 0
    price = F.col("o_totalprice")
    later = rows.filter(100 * F.col("o_orderkey") > 98 * top).select("o_orderkey", F.lit("X").alias("o_orderstatus"), (price + 1).alias("o_totalprice"))
    more = rows.filter(100 * F.col("o_orderkey") <= top).select((F.col("o_orderkey") + top + 1).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), price)
    stored = RangeTable(spark, scratch(spark, "orders"), ORDERS, ["o_orderkey"], rows_per_file=10_000)
    stored.upsert(rows)
    stored.upsert(later.unionByName(more), ["o_orderstatus", "o_totalprice"])
    return stored.read()


@query("""WITH m AS (SELECT max(o_orderkey) AS top FROM orders) SELECT 'new' AS what, count(*) AS n FROM orders, m WHERE 100 * o_orderkey <= top UNION ALL SELECT 'changed', count(*) FROM orders, m WHERE 100 * o_orderkey > 98 * top""")
def run_counters(spark, sf):
    """What an upsert counted while it wrote."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    top = rows.agg(F.max("o_orderkey")).first()[0] or 0
    stored = RangeTable(spark, scratch(spark, "orders"), "o_orderkey long, o_orderstatus string", ["o_orderkey"], rows_per_file=10_000)
    stored.upsert(rows)
    told = stored.upsert(rows.filter(100 * F.col("o_orderkey") > 98 * top).unionByName(rows.filter(100 * F.col("o_orderkey") <= top).withColumn("o_orderkey", F.col("o_orderkey") + top + 1)))
    return spark.createDataFrame([(k, told[k]) for k in ("new", "changed")], "what string, n long")


@query("SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_name END AS c_name, CASE WHEN c_acctbal < 5000 THEN 'X' || c_mktsegment ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer")
def upsert_merge(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    incoming = c.filter("c_acctbal < 5000").select("c_custkey", F.concat(F.lit("X"), "c_mktsegment").alias("c_mktsegment"))
    return state.upsert(c.filter("c_acctbal >= 0"), incoming, ["c_custkey"], ["c_mktsegment"])


HALVES = "SELECT user_id, arg_max(event_type, ts) AS s FROM events WHERE ts {op} TIMESTAMP '2024-01-16' GROUP BY user_id"


@query(f"SELECT n.user_id, o.s AS from_state, n.s AS to_state FROM ({HALVES.format(op='>=')}) n JOIN ({HALVES.format(op='<')}) o USING (user_id) WHERE n.s <> o.s")
def state_transitions(spark, sf):
    e = events(spark, sf).select("user_id", "event_id", "ts", F.col("event_type").alias("state"))
    last = lambda rows: latest.latest_per_key(rows, ["user_id"], "ts", "event_id").select("user_id", "state")
    return state.transitions(last(e.filter("ts < '2024-01-16'")), last(e.filter("ts >= '2024-01-16'")), ["user_id"], "state").select("user_id", "from_state", "to_state")


@query("SELECT event_id, p AS from_state, event_type AS to_state FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) WHERE p <> event_type")
def transition_history(spark, sf):
    rows = events(spark, sf).select("user_id", "event_id", "ts", F.col("event_type").alias("state"))
    return state.transition_history(rows, ["user_id"], "ts", "event_id", "state").select("event_id", "from_state", "to_state")


@query("SELECT event_id FROM events e LEFT JOIN (SELECT event_type, max(ts) AS m FROM events WHERE ts < TIMESTAMP '2024-01-16' AND event_type <> 'error' GROUP BY event_type) w USING (event_type) WHERE m IS NULL OR ts >= m")
def incremental_watermark(spark, sf):
    e = events(spark, sf)
    marks = latest.watermark(e.filter("ts < '2024-01-16' AND event_type <> 'error'"), ["event_type"], "ts")
    return state.newer_than(e, marks, ["event_type"], "ts").select("event_id")


@query("SELECT vec_id, i - 1 AS pos, CAST(embedding[i] AS DOUBLE) AS item, sha256('vec' || chr(31) || vec_id) AS capture_id FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)")
def explode_children(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("capture_id", state.capture_id(F.lit("vec"), F.col("vec_id").cast("string")))
    kids = state.children(e, "embedding")
    return kids.join(e.select("capture_id", "vec_id"), "capture_id").select("vec_id", F.col("pos").cast("long").alias("pos"), F.col("item").cast("double").alias("item"), "capture_id")


# -- aggregates and exclusions -----------------------------------------------------------------------
@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def status_histogram(spark, sf):
    return exclusions.histogram(table(spark, sf, "events"), "event_type")


def matched(spark, sf) -> DataFrame:
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    rule = lambda scope, pattern, applies: [F.lit(scope).alias("scope"), pattern.alias("pattern"), F.lit(applies).alias("applies_to")]
    rules = (
        c.filter("c_acctbal < -900").select(*rule("endpoint", F.col("c_custkey").cast("string"), "discover"))
        .unionByName(n.filter("n_regionkey = 2").select(*rule("host", F.upper("n_name"), "all")))
        .unionByName(spark.range(1).select(*rule("server", F.lit("BUILDING"), "no such method")))
        .unionByName(spark.range(1).select(*rule("server", F.lit("MACHINERY"), "tools")))
        .unionByName(spark.range(1).select(*rule("galaxy", F.lit("AUTOMOBILE"), "all")))
    ).withColumns({"revoked_at": F.lit(None).cast("timestamp"), "effective_at": F.lit("2024-01-01").cast("timestamp")})
    # A rule is in force from its time on, to the instant; one in the future or revoked is not.
    times = {"host 3": ("2024-05-01", "2024-01-01"), "host 4": (None, "2024-06-02"), "host 0": (None, "2024-06-01")}
    for key, (revoked, since) in times.items():
        more = n.filter(f"n_regionkey = {key[-1]}").select(*rule("host", F.upper("n_name"), "discover"), F.lit(revoked).cast("timestamp").alias("revoked_at"), F.lit(since).cast("timestamp").alias("effective_at"))
        rules = rules.unionByName(more)
    now = F.lit("2024-06-01").cast("timestamp")
    targets = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.lower("n_name").alias("host"), "c_mktsegment")
    return exclusions.with_match(targets, exclusions.active_rules(rules, now), "discover", {"endpoint": "c_custkey", "host": "host", "server": "c_mktsegment"})


MATCHED = """WITH m AS (SELECT c_custkey, CASE WHEN c_acctbal < -900 THEN 'endpoint' WHEN n_regionkey IN (0, 2) THEN 'host' WHEN c_mktsegment = 'BUILDING' THEN 'server' END AS scope,
 CASE WHEN c_acctbal < -900 THEN CAST(c_custkey AS VARCHAR) WHEN n_regionkey IN (0, 2) THEN lower(n_name) WHEN c_mktsegment = 'BUILDING' THEN 'BUILDING' END AS pattern FROM customer JOIN nation ON c_nationkey = n_nationkey) """


@query(MATCHED + "SELECT c_custkey, scope, pattern, 'excluded by operator request: ' || scope || ' ' || pattern AS note FROM m")
def exclusion_match(spark, sf):
    return matched(spark, sf).select("c_custkey", "match.scope", "match.pattern", exclusions.exclusion_note(F.col("match")).alias("note"))


@query(MATCHED + "SELECT count(*) FILTER (scope IS NOT NULL) AS excluded, count(*) FILTER (scope IS NULL) AS dialable, count(*) AS corpus FROM m")
def coverage_partition(spark, sf):
    return matched(spark, sf).agg(F.count_if(F.col("match").isNotNull()).alias("excluded"), F.count_if(F.col("match").isNull()).alias("dialable"), F.count(F.lit(1)).alias("corpus"))


@query("SELECT event_type, (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(ts))) / 3.6e9 AS age_hours, (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(ts))) / 3.6e9 > 48 AS stale FROM events GROUP BY event_type")
def freshness(spark, sf):
    age = X.age_hours(F.col("newest"), F.lit("2024-02-01").cast("timestamp"))
    return latest.watermark(events(spark, sf), ["event_type"], "ts").select("event_type", age.alias("age_hours"), (age > quality.STALE_HOURS).alias("stale"))


# -- scalar functions --------------------------------------------------------------------------------
@query("""WITH u AS (SELECT user_id, 10 * count(*) FILTER (event_type = 'view') AS installs, 10 * nullif(count(*) FILTER (event_type = 'purchase'), 0) AS req, count(*) FILTER (event_type = 'signup') > 8 AS exe FROM events GROUP BY user_id),
b AS (SELECT *, CASE WHEN NOT exe THEN 'no-executables' WHEN installs >= 100 AND req IS NOT NULL THEN 'on-request-ratio' ELSE 'unmatched-default' END AS basis FROM u)
SELECT user_id, CASE WHEN basis = 'on-request-ratio' AND req / installs >= 0.5 THEN 'tool' ELSE 'library' END AS artifact_type, basis AS classification_basis FROM b""")
def ratio_classify(spark, sf):
    n = lambda kind: F.count_if(F.col("event_type") == kind)
    users = table(spark, sf, "events").groupBy("user_id").agg((10 * n("view")).alias("installs"), (10 * F.nullif(n("purchase"), F.lit(0))).alias("req"), (n("signup") > 8).alias("exe"))
    return users.select("user_id", X.artifact_type(F.col("exe"), F.col("installs"), F.col("req")).alias("t")).select("user_id", "t.*")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'disabled' WHEN o_orderpriority = '1-URGENT' THEN 'deprecated' ELSE 'active' END AS status FROM orders")
def status_precedence(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.artifact_status(F.col("o_orderstatus") == "F", F.col("o_orderpriority") == "1-URGENT").alias("status"))


#: Ways to write a host, by page_id: (what goes between scheme and path in Spark's SQL and DuckDB's alike, the hostname of the URL standard).
HOST_FORMS = [
    ("'//' || h || '/'", "h"),
    ("'//USER:pw@' || upper(h) || ':8080?q'", "h"),
    ("'//%' || CASE WHEN h < 'f' THEN '61' ELSE '7A' END || '.' || h || '#f'", "CASE WHEN h < 'f' THEN 'a' ELSE 'z' END || '.' || h"),
    ("'//' || (16777216 + page_id) || '/'", "'1.' || (page_id // 65536) || '.' || (page_id // 256 % 256) || '.' || page_id % 256"),
    ("'//0x7f.' || (page_id % 65536)", "'127.0.' || (page_id % 65536 // 256) || '.' || page_id % 256"),
    ("'//010.0.0.' || page_id % 256 || '.'", "'8.0.0.' || page_id % 256"),
    ("'//1.2.3.' || (256 + page_id)", "NULL"),
    ("'//' || h || '<x/'", "NULL"),
    ("'//[1:0:0:0:0:0:0:' || (page_id % 10) || ']/'", "CASE WHEN page_id % 10 = 0 THEN '[1::]' ELSE '[1::' || (page_id % 10) || ']' END"),
    ("'//[::ffff:1.2.3.' || page_id % 256 || ']'", "NULL"),
    ("'//b\u00fccher.' || h", "'xn--bcher-kva.' || h"),
    ("'\\\\' || h || ':99999/'", "NULL"),
    ("h || '/x'", "h"),
]
HOST_SQL = "SELECT page_id, CASE page_id % 13 " + " ".join(f"WHEN {i} THEN {want}" for i, (_, want) in enumerate(HOST_FORMS)) + " END AS host FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://([a-z.-]+)/', 1) AS h FROM pages)"


@query(HOST_SQL.replace("WHEN 9 THEN NULL", "WHEN 9 THEN '[::ffff:102:' || printf('%x', 768 + page_id % 256) || ']'"))
def url_hosts(spark, sf):
    """hostnames of URLs in all the forms that the standard knows; the twin knows the host that each was made from."""
    made = F.expr("CASE page_id % 13 " + " ".join(f"WHEN {i} THEN {form}" for i, (form, _) in enumerate(HOST_FORMS)) + " END")
    rows = table(spark, sf, "pages").withColumn("h", F.regexp_extract("url", "^[a-z]+://([a-z.-]+)/", 1))
    return rows.select("page_id", X.host(F.concat(F.lit("HTTP:"), made)).alias("host"))


@query(r"SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#@]*@)?([^/:?#]+)', 2)) AS host FROM pages")
def host_extract(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.host(F.col("url")).alias("host"))


@query(r"""WITH h AS (SELECT page_id, regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host FROM pages) SELECT page_id, CASE WHEN host LIKE '%.example.com' THEN 'ngrok.io' WHEN host LIKE '%.example.net' THEN 'trycloudflare.com' END AS suffix FROM h""")
def tunnel_suffix(spark, sf):
    """hosts of two tunnel services, upper case and with an escaped dot, and others."""
    url = F.replace(F.replace("url", F.lit(".example.com"), F.lit("%2ENGROK.io")), F.lit(".example.net"), F.lit(".TryCloudflare.com"))
    return table(spark, sf, "pages").select("page_id", X.tunnel_suffix(X.host(url)).alias("suffix"))


@query(r"""SELECT page_id, len(v) AS n, array_to_string(list_sort(v), '|') AS event_values FROM (SELECT page_id, list_distinct(regexp_extract_all(replace(html, 'href=', 'value: '), 'value:\s*["''`]([^"''`\n]{1,80})["''`]', 1)) AS v FROM pages)""")
def regex_extract_all(spark, sf):
    v = X.event_values(F.replace("html", F.lit("href="), F.lit("value: ")))
    return table(spark, sf, "pages").select("page_id", F.size(v).cast("long").alias("n"), F.array_join(F.array_sort(v), "|").alias("event_values"))


@query(r"SELECT regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host, CASE WHEN bool_or(contains(url, 'ref=')) THEN 'instant' WHEN bool_or(contains(url, '#top')) THEN 'poll' ELSE 'unclassified' END AS mode FROM pages GROUP BY 1")
def mode_classify(spark, sf):
    return table(spark, sf, "pages").groupBy(X.host(F.col("url")).alias("host")).agg(merging.mode_of_any(F.col("url").contains("ref="), F.col("url").contains("#top")).alias("mode"))


@query("SELECT event_id, CASE event_type WHEN 'click' THEN 'instant' WHEN 'view' THEN 'poll' ELSE 'unclassified' END AS mode FROM events")
def trigger_mode(spark, sf):
    text = F.when(F.col("event_type") == "click", "  webhooks : [\n polling: true").when(F.col("event_type") == "view", "polling:  true").when(F.col("event_type") == "error", "polling: false")
    return table(spark, sf, "events").select("event_id", X.trigger_mode(text).alias("mode"))


@query("SELECT doc_id, CAST(ceil(strlen(text) / 4) AS BIGINT) AS tokens FROM documents")
def token_estimate(spark, sf):
    return table(spark, sf, "documents").select("doc_id", J.token_estimate(F.col("text")).alias("tokens"))


@query("""SELECT event_id, event_id % 3 <> 0 AS same, sha256('{"7":null,"event_type":"' || event_type || '","k":[1,100],"user_id":' || user_id || '}') AS hash FROM events""")
def canonical_hash_equal(spark, sf):
    a = F.format_string('{"user_id": %d, "k": [1.0, 1e2], "event_type": "%s", "7": null}', "user_id", "event_type")
    b = F.format_string('{"7": null, "event_type": "%s", "user_id": %d, "k": [1, %s]}', "event_type", "user_id", F.when(F.col("event_id") % 3 == 0, "100.5").otherwise("1E+2"))
    return table(spark, sf, "events").select("event_id", J.hash_canonical(a).alias("hash"), (J.hash_canonical(a) == J.hash_canonical(b)).alias("same"))


@query("SELECT event_id, nullif(substring(concat_ws('; ', CASE WHEN value > 20 THEN 'high ' || event_type END, CASE WHEN user_id < 50 THEN props END), 1, 400), '') AS note FROM events")
def note_assembly(spark, sf):
    return table(spark, sf, "events").select("event_id", C.assembled_note(F.when(F.col("value") > 20, F.concat(F.lit("high "), "event_type")), F.when(F.col("user_id") < 50, F.col("props"))).alias("note"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 0.0 WHEN 'F' THEN floor(o_totalprice) END AS n FROM orders")
def parse_count(spark, sf):
    raw = F.when(F.col("o_orderstatus") == "P", "  ").when(F.col("o_orderstatus") == "F", F.format_number(F.floor("o_totalprice"), 0)).otherwise("12 n/a")
    return table(spark, sf, "orders").select("o_orderkey", X.parsed_count(raw).alias("n"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') || '|' || o_orderpriority END AS versions FROM orders")
def versions_from_text(spark, sf):
    message = F.when(F.col("o_orderstatus") == "P", "Unsupported version 2024").otherwise(F.concat(F.lit("Bad (Supported versions: "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" ; "), "o_orderpriority", F.lit(". ,) more")))
    return table(spark, sf, "orders").select("o_orderkey", F.array_join(C.rejection_versions(message), "|").alias("versions"))


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN user_id * 1000 WHEN 'view' THEN CAST(trunc((epoch_us(date_trunc('second', ts)) + 3600000000 - epoch_us(ts)) / 1000) AS BIGINT) WHEN 'error' THEN 0 END AS wait_ms FROM events""")
def retry_after(spark, sf):
    date = lambda shift: F.concat(F.date_format(F.col("ts") + F.expr(f"INTERVAL {shift} HOURS"), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    raw = F.when(F.col("event_type") == "click", F.col("user_id").cast("string")).when(F.col("event_type") == "view", date(1)).when(F.col("event_type") == "error", date(-1)).otherwise("1.5")
    return events(spark, sf).select("event_id", C.retry_after_ms(raw, F.col("ts")).alias("wait_ms"))


@query("SELECT event_id, CASE event_type WHEN 'click' THEN 'timeout' WHEN 'view' THEN 'dns_failure' WHEN 'error' THEN 'connection_refused' WHEN 'signup' THEN 'tls_error' ELSE 'other' END AS cls, CASE event_type WHEN 'click' THEN 'timeout' WHEN 'view' THEN 'dns_failure' WHEN 'signup' THEN 'tls_error' ELSE 'other' END AS head_cls, CASE WHEN user_id = 7 THEN 'rate_limited' WHEN user_id > 50 THEN 'http_error' ELSE 'ok' END AS status_cls FROM events")
def exception_classify(spark, sf):
    kind = F.col("event_type")
    name, code = F.when(kind == "click", "AbortError").otherwise("TypeError"), F.when(kind == "view", "EAI_AGAIN").when(kind == "error", "ECONNRESET")
    message = F.when(kind == "signup", "self signed Certificate").otherwise("odd")
    status = F.when(F.col("user_id") == 7, 429).when(F.col("user_id") > 50, 503).otherwise(204)
    return table(spark, sf, "events").select("event_id", C.exception_class(name, code, message).alias("cls"), C.exception_class(name, code, message, True).alias("head_cls"), C.status_class(status).alias("status_cls"))


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN 'session_required' WHEN 'view' THEN 'ok' WHEN 'error' THEN 'unsupported' WHEN 'signup' THEN 'error' ELSE 'ok' END AS status,
CASE event_type WHEN 'click' THEN '2024-01-01|x' WHEN 'view' THEN 'v' || user_id WHEN 'purchase' THEN '' END AS versions, CASE event_type WHEN 'click' THEN 'rejection' WHEN 'view' THEN 'advertised' END AS source FROM events""")
def discover_outcome(spark, sf):
    kind = F.col("event_type")
    body = (
        F.when(kind == "click", '{"error": "Bad Session-ID; supported version: 2024-01-01, x."}')
        .when(kind == "view", F.format_string('event: m\ndata: {"par\ndata: {"result": {"versions": [], "protocolVersion": "v%d"}}\n', "user_id"))
        .when(kind == "error", '{"error": {"code": -32601, "message": "nope"}}').when(kind == "signup", '{"jsonrpc": "2.0"}').otherwise('{"result": null}')
    )
    ctype = F.when(kind == "view", "Text/Event-Stream; charset=utf-8").otherwise("application/json")
    out = table(spark, sf, "events").select("event_id", C.discover_outcome(F.when(kind == "click", 400).otherwise(200), body, ctype).alias("o"))
    return out.select("event_id", "o.status", F.when(F.col("o.versions").isNotNull(), F.array_join("o.versions", "|")).alias("versions"), "o.source")


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN 'session_required' WHEN 'view' THEN 'ok' WHEN 'error' THEN 'unsupported' WHEN 'signup' THEN 'unsupported' ELSE 'error' END AS status FROM events""")
def listing_outcome(spark, sf):
    kind = F.col("event_type")
    gone = '{"error": {"code": -32601, "message": "session required"}}'
    body = F.when(kind == "click", '{"error": {"code": -32601, "message": "session required"}}').when(kind == "view", '{"result": {"tools": []}}').when(kind.isin("error"), gone).when(kind == "signup", "{}").otherwise('{"result": {}}')
    status = F.when(kind == "click", 404).when(kind == "signup", 501).otherwise(200)
    return table(spark, sf, "events").select("event_id", C.listing_outcome(status, body, "tools").alias("status"))


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN 200 WHEN 'view' THEN 302 WHEN 'error' THEN 404 ELSE 304 END AS http_status, CASE event_type WHEN 'error' THEN 'http_error' ELSE 'ok' END AS error_class,
CASE event_type WHEN 'click' THEN 'u1' WHEN 'view' THEN 'u3' END AS redirect_target, CASE event_type WHEN 'view' THEN 'redirect budget (2) exhausted' END AS note FROM events""")
def reach_outcome(spark, sf):
    kind = F.col("event_type")
    hop = lambda s, to=None: F.struct(F.lit(s).alias("http_status"), F.lit(to).cast("string").alias("location"))
    hops = F.when(kind == "click", F.array(hop(301, "u1"), hop(200))).when(kind == "view", F.array(hop(302, "u1"), hop(302, "u2"), hop(302, "u3"), hop(200))).when(kind == "error", F.array(hop(404, "x"))).otherwise(F.array(hop(304), hop(200)))
    return table(spark, sf, "events").select("event_id", C.reach_outcome(hops).alias("o")).select("event_id", "o.*")


@query("SELECT event_id, CASE event_type WHEN 'click' THEN 'template_placeholder' WHEN 'view' THEN 'scheme' WHEN 'error' THEN 'invalid_url' END AS reason, CASE event_type WHEN 'signup' THEN true WHEN 'error' THEN false END AS tls FROM events")
def not_attempted(spark, sf):
    kind = F.col("event_type")
    url = F.when(kind == "click", "https://{host}/x").when(kind == "view", "ftp://h/x").when(kind == "error", "no url").when(kind == "signup", "HTTPS://h/x").otherwise("http://h/x")
    cls = F.when(kind == "error", "tls_error").otherwise("ok")
    return table(spark, sf, "events").select("event_id", C.not_attempted_reason(url).alias("reason"), C.tls_valid(url, cls, kind.isin("signup", "purchase")).alias("tls"))


@query("SELECT event_id, CASE event_type WHEN 'view' THEN 'scheme' WHEN 'error' THEN 'invalid_url' END AS reason FROM events")
def listing_not_attempted(spark, sf):
    """The listing collectors' predicate, which lets placeholders through."""
    kind = F.col("event_type")
    url = F.when(kind == "click", "https://{host}/x").when(kind == "view", "mailto:a@b").when(kind == "error", "http://1.2.3.456/").when(kind == "signup", " HTTPS://h/x").otherwise("http://h/x")
    return table(spark, sf, "events").select("event_id", C.not_attempted_reason(url, templates=False).alias("reason"))


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_name DESC, c_custkey LIMIT 100")
def smoke_slice(spark, sf):
    """The first rows of the corpus by name; the limit is the feature."""
    from registrylake.plans.pipelines import smoke_slice as first

    return first(table(spark, sf, "customer").select("c_custkey", "c_name"), [F.desc("c_name"), "c_custkey"], 100)[0]


GRANTS = """WITH g AS (SELECT o_orderpriority AS role, CASE WHEN o_custkey % 2 = 0 THEN 'items' ELSE 'transitions' END AS relation, o_orderkey % 9 AS place, CASE o_orderkey % 3 WHEN 0 THEN 'INSERT' WHEN 1 THEN 'SELECT' ELSE 'UPDATE' END AS privilege FROM orders WHERE o_totalprice > 300000)"""


@query(GRANTS + """, mine AS (SELECT * FROM g WHERE role = '1-URGENT'), c AS (SELECT unnest(['title', 'state', 'author', 'labels', 'created_at', 'updated_at', 'url', 'fetched_at']) AS name, unnest(range(8)) AS place)
SELECT name AS fact, EXISTS (SELECT 1 FROM mine WHERE relation = 'items' AND privilege = 'UPDATE' AND mine.place IN (c.place, 8)) AS held FROM c
UNION ALL SELECT 'items_insert', EXISTS (SELECT 1 FROM mine WHERE relation = 'items' AND privilege = 'INSERT' AND place = 8)
UNION ALL SELECT 'items_select', EXISTS (SELECT 1 FROM mine WHERE relation = 'items' AND privilege = 'SELECT' AND place = 8)
UNION ALL SELECT 'transitions_insert', EXISTS (SELECT 1 FROM mine WHERE relation = 'transitions' AND privilege = 'INSERT' AND place = 8)""")
def access_facts(spark, sf):
    """What a role may do, from a table of grants: the dear orders, each of which grants one privilege on a relation or one of its columns."""
    k, columns = F.col("o_orderkey"), F.array(*map(F.lit, quality.UPDATE_COLUMNS))
    privilege = F.when(k % 3 == 0, "INSERT").when(k % 3 == 1, "SELECT").otherwise("UPDATE")
    grants = table(spark, sf, "orders").filter("o_totalprice > 300000").select(F.col("o_orderpriority").alias("role"), F.when(F.col("o_custkey") % 2 == 0, "items").otherwise("transitions").alias("relation"), F.get(columns, (k % 9).cast("int")).alias("column"), privilege.alias("privilege"))
    facts = quality.access_facts(grants, "1-URGENT")
    flat = list(facts.pop("items_update_cols").items()) + list(facts.items())
    return spark.createDataFrame(flat, "fact string, held boolean")


@query("""SELECT event_id, CASE WHEN user_id % 10 = 3 THEN NULL WHEN strlen(repeat(props || 'é', CAST(user_id AS INT))) <= 400 THEN repeat(props || 'é', CAST(user_id AS INT)) ELSE '{"_omitted":"result exceeded MAX_RAW_BYTES","bytes":' || strlen(repeat(props || 'é', CAST(user_id AS INT))) || ',"cap":400}' END AS raw FROM events""")
def bounded_raw(spark, sf):
    """a text repeated as often as a user's number; its size follows from its unit, so that texts beyond the cap, whose sizes grow with the numbers, are not made."""
    unit, times, there = F.concat("props", F.lit("é")), F.col("user_id").cast("int"), F.col("user_id") % 10 != 3
    size = F.when(there, F.octet_length(unit).cast("long") * F.greatest(times, F.lit(0)))
    return table(spark, sf, "events").select("event_id", C.bounded_raw(F.when(there, F.repeat(unit, times)), 400, size).alias("raw"))


@query("SELECT event_id, CASE event_type WHEN 'click' THEN 'server=' || user_id || ',www-authenticate=' || repeat('x', 256) WHEN 'view' THEN NULL ELSE 'server=s' END AS headers FROM events")
def allowed_headers(spark, sf):
    kind = F.col("event_type")
    h = F.when(kind == "click", F.create_map(F.lit("Server"), F.col("user_id").cast("string"), F.lit("WWW-Authenticate"), F.repeat(F.lit("x"), F.lit(300)), F.lit("x-other"), F.lit("1"))).when(kind == "view", F.create_map(F.lit("date"), F.lit("now"))).otherwise(F.create_map(F.lit("server"), F.lit("s")))
    pairs = F.array_sort(F.transform(F.map_entries(C.allowed_headers(h)), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return table(spark, sf, "events").select("event_id", F.array_join(pairs, ",").alias("headers"))


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE props END AS body FROM events")
def envelope_parse(spark, sf):
    stream = F.concat(F.lit("event: message\r\ndata: {broken\r\ndata: null\r\ndata: "), "props", F.lit('\r\ndata: {"later": 1}\r\n\r\n'))
    body = F.when(F.col("event_type") == "error", F.lit("data: [DONE]")).otherwise(stream)
    return table(spark, sf, "events").select("event_id", C.envelope(body, F.lit("text/event-stream")).alias("body"))


@query("""SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') || ' X9' AS title FROM part""")
def title_of_slug(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.title_of_slug(F.concat(F.replace("p_name", F.lit(" "), F.lit("_-")), F.lit("-x9"))).alias("title"))


@query("""WITH p AS (SELECT o_orderkey, o_orderkey % 9 AS i, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'one' WHEN 2 THEN 'x|y' END AS v, o_orderkey % 70 AS n FROM orders)
SELECT o_orderkey, coalesce(v, CASE WHEN o_orderkey % 4 = 3 THEN array_to_string(list_transform(range(0, least(64, n + 1)), lambda k: 'v' || k), '|') ELSE 'last' END) AS versions,
 CASE WHEN v IS NULL AND o_orderkey % 4 = 0 THEN '_meta.protocolVersion' ELSE ['supportedVersions', 'protocolVersions', 'protocol_versions', 'supportedProtocolVersions', 'supported_protocol_versions', 'versions', '_meta.protocolVersions', 'protocolVersion', '_meta.protocolVersion'][i + 1] END AS via, o_orderkey % 4 = 3 AND n >= 64 AS capped FROM p""")
def version_paths(spark, sf):
    """each of the nine places, in order; numbers and empty lists fall through; at most 64."""
    k = F.col("o_orderkey")
    many = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), k % 70), lambda i: F.concat(F.lit('"v'), i, F.lit('"'))), ",")
    value = F.when(k % 4 == 0, F.lit('[7, null]')).when(k % 4 == 1, F.lit('"one"')).when(k % 4 == 2, F.lit('["x", 5, {"z": 1}, "y"]')).otherwise(F.concat(F.lit("["), many, F.lit("]")))
    plain = [p for p in C.VERSION_PATHS if "." not in p]
    places = F.array(*map(F.lit, C.VERSION_PATHS))
    at = F.element_at(places, (k % 9 + 1).cast("int"))
    inner = F.concat(F.lit('"'), F.element_at(F.split(at, "[.]"), -1), F.lit('": '), value)
    last = F.when((k % 9 != 8) | (k % 4 == 0), F.lit('"protocolVersion": "last"'))
    meta = F.concat(F.lit('"_meta": {'), F.concat_ws(", ", F.when(at.startswith("_meta") & ((k % 9 != 8) | (k % 4 != 0)), inner), last), F.lit("}"))
    body = F.concat(F.lit('{"result": {'), F.concat_ws(", ", meta, F.when(at.isin(plain), inner)), F.lit("}}"))
    return table(spark, sf, "orders").select("o_orderkey", C.advertised_versions(body).alias("a")).select("o_orderkey", F.array_join("a.versions", "|").alias("versions"), "a.via", "a.capped")


# -- folds -------------------------------------------------------------------------------------------
@query("""SELECT user_id, CAST(list_reduce(list_prepend(CAST(150 AS DOUBLE), o), lambda g, x: CASE WHEN x = 1 THEN least(60000, greatest(150, g) * 4) ELSE greatest(150, floor(g * CAST(0.8 AS DOUBLE) + 0.5)) END) AS BIGINT) AS gap_ms, n_429, n AS n_requests
FROM (SELECT user_id, list(CASE WHEN event_type = 'error' THEN CAST(1 AS DOUBLE) ELSE 0 END ORDER BY ts, event_id) AS o, count(*) FILTER (event_type = 'error') AS n_429, count(*) AS n FROM events GROUP BY user_id)""")
def gap_fold(spark, sf):
    rows = events(spark, sf).withColumn("outcome", F.when(F.col("event_type") == "error", "429").otherwise("ok"))
    return pacing.gap_fold(rows, "user_id", ["ts", "event_id"], "outcome")


@query("""SELECT user_id, CAST(e.g AS BIGINT) AS gap_ms, CAST(e.x AS BIGINT) AS next_ms, n_429 FROM (
SELECT user_id, n_429, list_reduce(o, lambda s, r: CASE
 WHEN r.k = 1 THEN {'k': 0, 't': 0::DOUBLE, 'w': 0::DOUBLE, 'g': least(60000, greatest(150, s.g) * 4), 'x': greatest(s.x, r.t + s.g, r.t + CASE WHEN r.w < 0 THEN least(60000, greatest(150, s.g) * 4) ELSE least(r.w, 300000) END)}
 ELSE {'k': 0, 't': 0::DOUBLE, 'w': 0::DOUBLE, 'g': greatest(150, floor(s.g * CAST(0.8 AS DOUBLE) + 0.5)), 'x': greatest(s.x, r.t + s.g)} END, {'k': 0, 't': 0::DOUBLE, 'w': 0::DOUBLE, 'g': 150::DOUBLE, 'x': 0::DOUBLE}) AS e
FROM (SELECT user_id, count(*) FILTER (event_type = 'error') AS n_429, list({'k': CASE WHEN event_type = 'error' THEN 1 ELSE 0 END, 't': CAST(epoch_us(ts) // 1000 AS DOUBLE), 'w': CAST(CASE WHEN event_id % 3 = 0 THEN -1 ELSE event_id * 37 % 400000 END AS DOUBLE), 'g': 0::DOUBLE, 'x': 0::DOUBLE} ORDER BY ts, event_id) AS o FROM events GROUP BY user_id))""")
def host_next_time(spark, sf):
    """Gap and next time of each host; every third 429 names no retry time."""
    retry = F.when(F.col("event_id") % 3 != 0, F.col("event_id") * 37 % 400_000)
    rows = events(spark, sf).withColumns({"outcome": F.when(F.col("event_type") == "error", "429").otherwise("ok"), "retry_ms": retry})
    return pacing.next_times(rows, "user_id", ["ts", "event_id"], "outcome", "retry_ms").select("user_id", "gap_ms", "next_ms", "n_429")


@query("""WITH a AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS k FROM events)
SELECT event_id, max(t - k * 20000000) OVER (PARTITION BY user_id ORDER BY k) + k * 20000000 AS start_ms FROM a""")
def host_slots(spark, sf):
    return pacing.slots(events(spark, sf), "user_id", "ts", 20_000_000).select("event_id", "start_ms")


@query("""WITH p AS (SELECT conv_id, row_number() OVER w AS page_no, CASE WHEN turn > 0 AND role = 'system' THEN '' WHEN length(text) > 700 THEN 'same' ELSE text END AS nc, length(text) AS n FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
f AS (SELECT * FROM p WHERE page_no <= 4), m AS (SELECT *, lag(nc) OVER (PARTITION BY conv_id ORDER BY page_no) AS prev FROM f),
r AS (SELECT *, CASE WHEN nc = '' THEN 'complete' WHEN nc = prev THEN 'repeated_cursor' END AS reason FROM m),
e AS (SELECT conv_id, coalesce(min(page_no) FILTER (reason IS NOT NULL), max(page_no)) AS page_count, max(page_no) AS pages FROM r GROUP BY conv_id)
SELECT e.conv_id, 'ok' AS status, coalesce(x.reason, CASE WHEN pages = 4 THEN 'page_cap' ELSE 'unfinished' END) AS reason, page_count, (SELECT CAST(sum(n) AS BIGINT) FROM f WHERE f.conv_id = e.conv_id AND f.page_no <= page_count) AS item_count,
coalesce(x.reason, CASE WHEN pages = 4 THEN 'page_cap' ELSE 'unfinished' END) IN ('repeated_cursor', 'page_cap') AS truncated FROM e JOIN r x ON x.conv_id = e.conv_id AND x.page_no = page_count""")
def cursor_chain(spark, sf):
    cursor = F.when((F.col("turn") > 0) & (F.col("role") == "system"), "").when(F.length("text") > 700, "same").otherwise(F.col("text"))
    pages = table(spark, sf, "conversations").select("conv_id", (F.col("turn") + 1).alias("page_no"), F.lit("ok").alias("status"), cursor.alias("next_cursor"), F.length("text").cast("long").alias("n_items"), F.lit(None).cast("string").alias("exception"))
    return chains.fold_chains(pages, ["conv_id"], 4).select("conv_id", "status", "reason", F.col("page_count").cast("long").alias("page_count"), "item_count", "truncated")


# -- JSON schemas ------------------------------------------------------------------------------------
def schemas(spark, sf) -> DataFrame:
    text = F.format_string('{"type": "object", "required": ["size", "%s"], "properties": {"%s": {"type": "string", "title": "t"}, "size": {"type": ["null", "integer"], "enum": [%d, 2]}}}', "p_type", "p_type", "p_size")
    return table(spark, sf, "part").select("p_partkey", "p_type", "p_size", text.alias("s"))


_SHAPE = """'{"properties":{"' || p_type || '":{' || {title} || '"type":"string"},"size":{"enum":[' || CASE WHEN CAST(p_size AS VARCHAR) <= '2' THEN p_size || ',2' ELSE '2,' || p_size END || '],"type":["null","integer"]}},"required":["' || p_type || '","size"],"type":"object"}'"""


@query("SELECT p_partkey, sha256(" + _SHAPE.replace("{title}", "'\"title\":\"t\",'") + ") AS h FROM part")
def schema_hash(spark, sf):
    return schemas(spark, sf).select("p_partkey", J.schema_hash(F.col("s")).alias("h"))


@query("SELECT p_partkey, sha256(" + _SHAPE.replace("{title}", "''") + ") AS h FROM part")
def contract_hash(spark, sf):
    return schemas(spark, sf).select("p_partkey", J.contract_hash(F.col("s")).alias("h"))


@query("SELECT p_partkey, p_type || ':string:true,size:integer|null:true' AS params FROM part")
def param_set(spark, sf):
    shown = F.array_join(F.transform(J.param_set(F.col("s")), lambda p: F.concat_ws(":", p["name"], p["type"], p["required"].cast("string"))), ",")
    return schemas(spark, sf).select("p_partkey", shown.alias("params"))


@query("""SELECT p_partkey, sha256('{' || array_to_string(list_filter([CASE WHEN p_size % 5 > 0 THEN '"version":' || CASE WHEN p_size % 7 = 0 THEN 'null' ELSE '"' || p_brand || '"' END END, CASE WHEN p_size % 2 = 0 THEN '"packages":[{"b":' || p_size || ',"a":0.5}]' END, CASE WHEN p_size % 3 = 0 THEN '"remotes":[]' END], lambda x: x IS NOT NULL), ',') || '}') AS h FROM part""")
def stable_hash(spark, sf):
    n = F.col("p_size")
    version = F.when(n % 5 > 0, F.concat(F.lit('"version": '), F.when(n % 7 == 0, F.lit("null")).otherwise(F.concat(F.lit('"'), "p_brand", F.lit('"')))))
    parts = [F.when(n % 3 == 0, F.lit('"remotes": []')), F.lit('"other": {"version": 1}'), version, F.when(n % 2 == 0, F.concat(F.lit('"packages": [{"b": '), n, F.lit('.0, "a": 5e-1}]')))]
    return table(spark, sf, "part").select("p_partkey", J.stable_hash(F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))).alias("h"))


@query("""WITH c AS (SELECT conv_id, turn, role, length(text) > 500 AS req, CASE WHEN contains(text, chr(10)) THEN 'string' ELSE 'number' END AS kind FROM conversations),
b AS (SELECT conv_id, role, turn, req, kind FROM c WHERE turn < 4), a AS (SELECT conv_id, role, turn - 4 AS turn, req, kind FROM c WHERE turn >= 4),
t AS (SELECT DISTINCT conv_id, role FROM b), u AS (SELECT DISTINCT conv_id, role FROM a)
SELECT CAST(conv_id AS VARCHAR) AS endpoint_url, role AS tool_name, CAST(NULL AS VARCHAR) AS name, 'tool_removed' AS change FROM t ANTI JOIN u USING (conv_id, role)
UNION ALL SELECT CAST(a.conv_id AS VARCHAR), a.role, CAST(a.turn AS VARCHAR), CASE WHEN a.req AND NOT coalesce(b.req, false) THEN 'required_added' ELSE 'type_changed' END
FROM a SEMI JOIN t USING (conv_id, role) LEFT JOIN b ON a.conv_id = b.conv_id AND a.role = b.role AND a.turn = b.turn WHERE (a.req AND NOT coalesce(b.req, false)) OR (b.req IS NOT NULL AND a.kind <> b.kind)""")
def breaking_changes(spark, sf):
    entry = F.struct((F.col("turn") % 4).cast("string").alias("name"), F.when(F.col("text").contains("\n"), "string").otherwise("number").alias("type"), (F.length("text") > 500).alias("required"))
    c = table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("endpoint_url"), F.col("role").alias("tool_name"), "turn", entry.alias("p"))
    held = lambda rows: rows.groupBy("endpoint_url", "tool_name").agg(F.collect_list("p").alias("param_set"))
    return state.breaking_changes(held(c.filter("turn < 4")), held(c.filter("turn >= 4")))


@query("""WITH r AS (SELECT l_suppkey AS e, date_trunc('month', l_shipdate) AS ts, l_linenumber AS t, min(l_orderkey) AS k FROM lineitem GROUP BY 1, 2, 3),
p AS (SELECT *, k % 3 AS ty, k % 5 = 0 AS rq, k % 7 = 0 AS second, k % 2 = 0 AS rq2 FROM r),
c AS (SELECT e, ts, lag(ts) OVER (PARTITION BY e ORDER BY ts) AS prev FROM (SELECT DISTINCT e, ts FROM r)),
s AS (SELECT p.*, lag(p.ts) OVER w AS bat, lag(ty) OVER w AS bty, lag(rq) OVER w AS brq, lag(second) OVER w AS bsecond, lag(rq2) OVER w AS brq2, c.prev FROM p JOIN c ON p.e = c.e AND p.ts = c.ts WINDOW w AS (PARTITION BY p.e, t ORDER BY p.ts)),
x AS (
 SELECT e, t, ts, NULL AS name, 'tool_returned' AS change FROM s WHERE bat < prev
 UNION ALL SELECT e, t, ts, 'a', CASE WHEN rq AND NOT brq THEN 'required_added' WHEN ty <> bty THEN 'type_changed' END FROM s WHERE bat IS NOT NULL
 UNION ALL SELECT e, t, ts, 'b', CASE WHEN rq2 AND NOT coalesce(bsecond AND brq2, false) THEN 'required_added' END FROM s WHERE bat IS NOT NULL AND second
 UNION ALL SELECT p.e, p.t, c.ts, NULL, 'tool_removed' FROM p JOIN c ON p.e = c.e AND p.ts = c.prev WHERE NOT EXISTS (SELECT 1 FROM p q WHERE q.e = p.e AND q.t = p.t AND q.ts = c.ts))
SELECT CAST(e AS VARCHAR) AS endpoint_url, CAST(t AS VARCHAR) AS tool_name, strftime(ts, '%Y-%m') AS captured, name, change FROM x WHERE change IS NOT NULL""")
def breaking_history(spark, sf):
    """A supplier's months are captures, its line numbers tools; one parameter changes its type and need, a second one comes and goes."""
    at = F.date_trunc("month", "l_shipdate")
    rows = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("endpoint_url"), at.alias("captured_at"), F.col("l_linenumber").cast("string").alias("tool_name")).agg(F.min("l_orderkey").alias("k"))
    k = F.col("k")
    one = lambda name, kind, need: F.struct(F.lit(name).alias("name"), kind.cast("string").alias("type"), need.alias("required"))
    a, b = one("a", k % 3, k % 5 == 0), one("b", F.lit("x"), k % 2 == 0)
    held = rows.withColumn("param_set", F.when(k % 7 == 0, F.array(a, b)).otherwise(F.array(a)))
    return state.breaking_history(held).select("endpoint_url", "tool_name", F.date_format("captured_at", "yyyy-MM").alias("captured"), "name", "change")


@query("SELECT page_id, replace(url, '?', '{') AS url FROM pages WHERE contains(url, '?')")
def placeholder_refusal(spark, sf):
    """The rows for which ``refuse_placeholders`` would stop a run; those without one go through it."""
    rows = table(spark, sf, "pages").select("page_id", F.replace("url", F.lit("?"), F.lit("{")).alias("url"))
    held = exclusions.placeholders(rows, "url")
    fine = exclusions.refuse_placeholders(rows.join(held.select("page_id"), "page_id", "left_anti"), "url")
    return held.unionByName(fine.filter(F.col("url").contains("{")))


@query("""SELECT page_id, CASE WHEN contains(url, '#') THEN 'other' WHEN contains(url, '?') THEN 'ok' ELSE 'http_error' END AS error_class, CASE WHEN contains(url, '#') THEN NULL WHEN contains(url, '?') THEN 200 ELSE 404 END AS http_status,
CASE WHEN contains(url, '?') AND NOT contains(url, '#') THEN 'https://moved/' END AS redirect_target, CASE WHEN contains(url, '#') THEN 'EPIPE broken' END AS note FROM pages""")
def reach_rows(spark, sf):
    from registrylake.plans.pipelines import reach_rows as rows_of

    p = table(spark, sf, "pages").select("page_id", "url")
    hop = lambda s, to=None: F.struct(F.lit(s).alias("http_status"), F.lit(to).cast("string").alias("location"))
    broken = F.col("url").contains("#")
    responses = p.select(
        F.col("url").alias("endpoint_url"), F.lit("HEAD").alias("probe_method"), F.when(~broken, F.when(F.col("url").contains("?"), F.array(hop(301, "https://moved/"), hop(200))).otherwise(F.array(hop(404)))).alias("hops"), F.lit(None).cast("map<string,string>").alias("headers"), F.lit(None).cast("string").alias("content_type"),
        F.lit(None).cast("string").alias("exc_name"), F.when(broken, F.lit("EPIPE")).alias("exc_code"), F.when(broken, F.lit("broken")).alias("exc_message"), F.lit(1).cast("long").alias("elapsed_ms"),
    )
    out = rows_of(p.select(F.col("page_id").cast("string").alias("name"), F.col("url").alias("endpoint_url")), responses.dropDuplicates(["endpoint_url"]), "run")
    return out.select(F.col("name").cast("long").alias("page_id"), "error_class", "http_status", "redirect_target", "note")
