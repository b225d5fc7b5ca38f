"""Driver queries of the pipelines: recorded JSON bodies made from the driver's tables, and SQL twins on the same columns.

Each query has a ``SELECT`` that derives plain columns from one table and runs in Spark and in DuckDB alike. Spark builds the
JSON that a registry, a catalogue or an endpoint would have sent from these columns and runs the pipeline on it; the twin
computes the pipeline's rows from the columns. All queries read whole tables.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrylake.functions import classify as C
from registrylake.functions import jsonhash as J
from registrylake.functions import text as X
from registrylake.operators import chains, exclusions, merging, pacing
from registrylake.operators.shared import written_once
from registrylake.plans import pipelines as P
from registrylake.plans.queries import QUERIES, SQL, query, table  # noqa: F401  the entry reads both here
from registrylake.sources import pages as S


def derived(spark, sf, sql: str, name: str) -> DataFrame:
    """The columns of ``sql``, whose ``@name`` stands for the table."""
    view = f"__rl_{name}"
    table(spark, sf, name).createOrReplaceTempView(view)
    return spark.sql(sql.replace(f"@{name}", view))


def twin(sql: str) -> str:
    return re.sub(r"FROM @(\w+)", r"FROM \1", sql)


def run_at() -> Column:
    return F.lit("2024-03-01").cast("timestamp")


def quoted(c: str) -> Column:
    return F.concat(F.lit('"'), F.col(c), F.lit('"'))


def member(name: str, value: Column) -> Column:
    """A member of a JSON object, nothing for NULL."""
    return F.coalesce(F.concat(F.lit(f',"{name}":'), value.cast("string")), F.lit(""))


#: Keys of one body: recorded pages have a fixed size, so there are more of them when a table grows.
SPAN = 20_000


def joined(rows: DataFrame, by: list, order: str, item: Column, head: str, tail: str, span: int | None = SPAN) -> DataFrame:
    """Bodies for each value of ``by``: ``item`` texts in order of ``order`` between ``head`` and ``tail``, one body (``body_no``) for each ``span`` of the order's numbers."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct(order, item.alias("i")))), lambda x: x["i"])
    number = (F.floor(F.col(order) / span) if span else F.lit(0)).cast("int").alias("body_no")
    return rows.groupBy(*by, number).agg(F.concat(F.lit(head), F.array_join(listed, ","), F.lit(tail)).alias("body"))


# -- registry ----------------------------------------------------------------------------------------
REG = """SELECT p_partkey AS k, p_partkey % 40 AS page_no, CASE WHEN p_partkey % 37 = 0 THEN '' ELSE p_brand || '/' || (p_size % 10) END AS name,
 'v' || (p_size % 3) || '.' || (p_partkey % 7) || '.' || (p_partkey % 5) AS version, p_size % 3 AS a, p_partkey % 7 AS b, p_partkey % 5 AS c, p_type AS description,
 p_size > 45 AS latest, p_size = 44 AS odd, CASE p_partkey % 4 WHEN 0 THEN 'active' WHEN 1 THEN 'deleted' WHEN 3 THEN 'deprecated' END AS status,
 CASE WHEN p_partkey % 4 = 3 THEN 'gone ' || p_size END AS message, CASE WHEN p_size % 2 = 0 THEN '[{"url":"https://H' || p_size || '.Example/x","type":"sse"}]' END AS remotes FROM @part"""
BEST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY latest DESC, a DESC, b DESC, c DESC, page_no, k) AS rn FROM reg WHERE name <> '' {more}) WHERE rn = 1"
HASHES = """sha256('{"version":"' || version || '"' || coalesce(',"remotes":' || remotes, '') || '}') AS definition_hash, sha256(coalesce('"' || status || '"', 'null')) AS status_hash, sha256(coalesce('"' || message || '"', 'null')) AS status_message_hash"""


def registry_pages(rows: DataFrame) -> DataFrame:
    server = F.concat(F.lit('{"name":'), quoted("name"), member("version", quoted("version")), member("description", quoted("description")), member("remotes", F.col("remotes")), F.lit("}"))
    flag = F.when(F.col("odd"), F.lit('"true"')).otherwise(F.col("latest").cast("string"))
    meta = F.concat(F.lit('{"reg.example/official":{"isLatest":'), flag, member("status", quoted("status")), member("statusMessage", quoted("message")), F.lit("}}"))
    item = F.concat(F.lit('{"server":'), server, F.lit(',"_meta":'), meta, F.lit("}"))
    return joined(rows, ["page_no"], "k", item, '{"servers":[', '],"metadata":{"nextCursor":null}}').withColumn("page_no", (F.col("page_no") * 1_000_000 + F.col("body_no")).cast("int"))


@query(f"WITH reg AS ({twin(REG)}) SELECT name, description, version, status, remotes, {HASHES} FROM ({BEST.format(more='')})")
def registry_rows(spark, sf):
    rows = P.registry_rows(registry_pages(derived(spark, sf, REG, "part")), run_at())
    return rows.select("name", "description", "version", "status", "remotes", "definition_hash", "status_hash", "status_message_hash")


@query(f"""WITH reg AS ({twin(REG)}), old AS ({BEST.format(more='AND k % 3 <> 0')}), new AS ({BEST.format(more='AND k % 5 <> 0')}),
two AS (SELECT coalesce(n.name, o.name) AS name, CASE WHEN n.name IS NULL THEN o.version ELSE n.version END AS version, CASE WHEN n.name IS NULL THEN NULL WHEN o.name IS NULL THEN 'new'
 WHEN n.version || coalesce(n.remotes, '') <> o.version || coalesce(o.remotes, '') OR n.status IS DISTINCT FROM o.status OR n.message IS DISTINCT FROM o.message THEN 'changed' END AS change FROM new n FULL JOIN old o ON n.name = o.name)
SELECT 'state' AS what, name, version AS value FROM two UNION ALL SELECT 'snapshot', name, change FROM two WHERE change IS NOT NULL""")
def registry_run(spark, sf):
    rows = derived(spark, sf, REG, "part")
    stored = P.registry_rows(registry_pages(rows.filter("k % 3 <> 0")), run_at())
    state_, snapshots = P.registry_run(stored, registry_pages(rows.filter("k % 5 <> 0")), run_at())
    return state_.select(F.lit("state").alias("what"), "name", F.col("version").alias("value")).unionByName(snapshots.select(F.lit("snapshot").alias("what"), "name", F.col("change").alias("value")))


LIVE = """SELECT c_custkey AS k, c_name AS name, CASE c_custkey % 5 WHEN 0 THEN 'deleted' WHEN 1 THEN NULL ELSE 'active' END AS status,
 CASE c_custkey % 7 WHEN 0 THEN '[]' WHEN 1 THEN NULL WHEN 2 THEN '{"url":"x"}' ELSE '[{"url":"https://u:p@Host-' || c_nationkey || '.Example:8080/a?b"},{"url":""},{"u":1},{"url":5},null,{"url":"nohost ' || c_name || ' and a long tail behind it"}]' END AS remotes FROM @customer"""


@query(f"""WITH l AS ({twin(LIVE)}), n AS (SELECT name, c_nationkey AS n FROM l JOIN customer ON c_custkey = k WHERE status = 'active' AND k % 7 > 2)
SELECT name, 'https://u:p@Host-' || n || '.Example:8080/a?b' AS endpoint_url, 'host-' || n || '.example' AS host FROM n
UNION ALL SELECT name, 'nohost ' || name || ' and a long tail behind it', '__unparseable__' || substring('nohost ' || name || ' and a long tail behind it', 1, 40) FROM n""")
def live_endpoints(spark, sf):
    return P.live_endpoints(derived(spark, sf, LIVE, "customer"))


@query(f"""WITH l AS ({twin(LIVE)}) SELECT count(*) AS servers, count(*) FILTER (status = 'deleted' AND k % 7 > 2) AS deleted_with_remotes FROM l""")
def deleted_with_remotes(spark, sf):
    """A5, F40."""
    rows = derived(spark, sf, LIVE, "customer")
    return merging.count_pair(rows, (F.col("status") == "deleted") & (F.json_array_length("remotes") > 0)).select(F.col("total").alias("servers"), F.col("marked").alias("deleted_with_remotes"))


# -- artifacts ---------------------------------------------------------------------------------------
FORM = """SELECT p_partkey AS k, 'f' || p_partkey AS name, CASE WHEN p_size % 4 = 0 THEN 'tap/f' || p_partkey END AS full_name, p_brand AS license, p_size % 5 = 0 AS deprecated, p_size % 7 = 0 AS disabled,
 CASE p_size % 3 WHEN 0 THEN '  ' WHEN 1 THEN 'Note' END AS caveats, p_type AS descr, '1.' || p_size AS version, p_size % 3 <> 0 AS exe, 'z' || p_size AS z, 40 * p_size AS n,
 CASE WHEN p_partkey % 6 <> 0 THEN 4 * p_size * (p_size % 10) END AS req, p_partkey % 10 AS kind, p_partkey % 11 = 0 AS twice FROM @part"""
FORM_COUNTS = f"""WITH f AS ({twin(FORM)}), g AS (SELECT *, CASE WHEN twice THEN 7.0 WHEN kind = 0 THEN NULL WHEN kind = 1 THEN 0.0 WHEN kind = 2 THEN NULL ELSE n END AS installs FROM f),
b AS (SELECT *, CASE WHEN NOT exe THEN 'no-executables' WHEN installs >= 100 AND req IS NOT NULL THEN 'on-request-ratio' ELSE 'unmatched-default' END AS basis FROM g),
t AS (SELECT *, CASE WHEN basis = 'on-request-ratio' AND req / installs >= 0.5 THEN 'tool' ELSE 'library' END AS kind_ FROM b),
rows AS (SELECT name AS external_id, version, CASE WHEN disabled THEN 'disabled' WHEN deprecated THEN 'deprecated' ELSE 'active' END AS status, kind_ AS artifact_type, CAST(installs AS DOUBLE) AS install_30d, CAST(req AS DOUBLE) AS on_request_30d,
 sha256('{{"artifact_type":"' || kind_ || '","classification_basis":"' || basis || '","dependencies":["B","a","b' || n || '"],"deprecated":' || CAST(deprecated AS VARCHAR) || ',"disabled":' || CAST(disabled AS VARCHAR) ||
 ',"executables":' || CASE WHEN exe THEN '["a","' || z || '"]' ELSE '[]' END || ',"full_name":"' || coalesce(full_name, name) || '","has_caveats":' || CAST(coalesce(caveats = 'Note', false) AS VARCHAR) || ',"license":"' || license || '","name":"' || name || '","tap":null}}') AS definition_hash FROM t) """


def formulae(spark, sf):
    f = derived(spark, sf, FORM, "part")
    deps = F.concat(F.lit('["b'), F.col("n"), F.lit('","a","B"]'))
    exe = F.when(F.col("exe"), F.concat(F.lit('["'), F.col("z"), F.lit('","a"]'))).otherwise("[]")
    flag = lambda c: F.when(F.col(c), "true")  # noqa: E731  absent means false
    body = F.concat(F.lit('{"name":'), quoted("name"), member("full_name", quoted("full_name")), member("license", quoted("license")), member("deprecated", flag("deprecated")), member("disabled", flag("disabled")), member("dependencies", deps), member("executables", exe), member("caveats", quoted("caveats")), member("desc", quoted("descr")), F.lit(',"versions":{"stable":'), quoted("version"), F.lit("}}"))
    count = F.when(F.col("kind") == 1, F.lit('" "')).when(F.col("kind") == 2, F.lit('"n/a"')).when(F.col("kind") == 3, F.col("n").cast("string")).otherwise(F.concat(F.lit('"'), F.format_number("n", 0), F.lit('"')))
    entry = lambda c: F.concat(F.lit('{"formula":'), quoted("name"), F.lit(',"count":'), c, F.lit("}"))
    head = '{"start_date":"2024-01-01","end_date":"2024-01-30","items":['
    installs = joined(f.filter("kind <> 0").select((F.col("k") * 2).alias("k"), "name", count.alias("c")).unionByName(f.filter("twice").select((F.col("k") * 2 + 1).alias("k"), "name", F.lit("7").alias("c"))), [], "k", entry(F.col("c")), head, "]}")
    on_request = joined(f.filter("req IS NOT NULL"), [], "k", entry(F.concat(F.lit('"'), F.format_number("req", 0), F.lit('"'))), head, "]}")
    return P.formula_rows(f.select(body.alias("body")), installs, on_request, run_at())


@query(FORM_COUNTS + "SELECT * FROM rows")
def formula_rows(spark, sf):
    metric = lambda c: F.get_json_object("metrics", f"$.{c}").cast("double")
    return formulae(spark, sf).select("external_id", "version", "status", F.get_json_object("manifest", "$.artifact_type").alias("artifact_type"), metric("install_30d").alias("install_30d"), metric("install_on_request_30d").alias("on_request_30d"), "definition_hash")


@query(FORM_COUNTS + "SELECT count(install_30d) AS measured, count(*) - count(install_30d) AS unmeasured FROM rows")
def measured_counts(spark, sf):
    """A15."""
    return merging.measured(formulae(spark, sf), F.get_json_object("metrics", "$.install_30d"))


@query(FORM_COUNTS + """, old AS (SELECT external_id, CASE WHEN install_30d IS NULL THEN 'x' ELSE definition_hash END AS h, status FROM rows WHERE status <> 'deprecated')
SELECT 'state' AS what, external_id, status AS value FROM rows UNION ALL
SELECT 'snapshot', r.external_id, CASE WHEN o.external_id IS NULL THEN 'new' ELSE 'changed' END FROM rows r LEFT JOIN old o ON r.external_id = o.external_id WHERE o.h IS DISTINCT FROM r.definition_hash""")
def artifact_run(spark, sf):
    """The run's rows are written once: five branches read them."""
    rows = written_once(formulae(spark, sf), "artifacts")
    old = rows.filter("status <> 'deprecated'").withColumn("definition_hash", F.when(F.get_json_object("metrics", "$.install_30d").isNull(), "x").otherwise(F.col("definition_hash")))
    state_, snapshots = P.artifact_run(old, rows)
    named = rows.select(P.state.capture_id("kind", "source", "external_id").alias("artifact_id"), "external_id")
    return state_.select(F.lit("state").alias("what"), "external_id", F.col("status").alias("value")).unionByName(snapshots.join(named, "artifact_id").select(F.lit("snapshot").alias("what"), "external_id", F.col("change").alias("value")))


PACK = """SELECT p_partkey AS k, p_partkey % 3 AS keyword_no, p_partkey % 4 AS page_no, CASE p_partkey % 3 WHEN 0 THEN 'sdk' WHEN 1 THEN 'client' ELSE 'api-client' END AS keyword, p_partkey % 500 AS m,
 CASE WHEN p_partkey % 2 = 0 THEN '@s' || (p_partkey % 500) || '/p' ELSE 'p' || (p_partkey % 500) END AS name, CASE p_partkey % 500 % 5 WHEN 0 THEN 'unscoped' WHEN 1 THEN 'given' END AS scope,
 '1.' || p_size AS version, p_brand AS license, CASE WHEN p_size % 2 = 0 THEN 'u' || p_size END AS username, CASE WHEN p_size % 3 = 0 THEN '["k2","k1"]' END AS keywords, p_partkey % 53 = 0 AS nameless FROM @part"""


@query(f"""WITH p AS ({twin(PACK)}), q AS (SELECT * FROM p WHERE NOT nameless), one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY keyword_no, page_no, k) AS rn FROM q) WHERE rn = 1),
kw AS (SELECT name, '["' || array_to_string(list_sort(list(DISTINCT keyword)), '","') || '"]' AS matched FROM q GROUP BY name),
s AS (SELECT *, CASE WHEN scope = 'given' THEN 'given' WHEN k % 2 = 0 THEN 's' || m END AS sc FROM one JOIN kw USING (name))
SELECT name AS external_id, coalesce(username, CASE WHEN k % 2 = 0 THEN 's' || m END) AS publisher, version, CASE WHEN m % 3 = 0 THEN CAST(10 * m AS BIGINT) END AS weekly_downloads,
 sha256('{{"deprecated":null,"keywords":' || coalesce(keywords, '[]') || ',"license":"' || license || '","matched_queries":' || matched || ',"name":"' || name || '","repository":null,"scope":' || coalesce('"' || sc || '"', 'null') || '}}') AS definition_hash FROM s""")
def package_rows(spark, sf):
    p = derived(spark, sf, PACK, "part")
    fields = F.concat(member("version", quoted("version")), member("license", quoted("license")), member("scope", quoted("scope")), member("keywords", F.col("keywords")), member("publisher", F.concat(F.lit('{"username":'), quoted("username"), F.lit("}"))))
    package = F.concat(F.lit('{"package":{"x":1'), F.when(F.col("nameless"), "").otherwise(member("name", quoted("name"))), fields, F.lit("}}"))
    pages = joined(p, ["keyword", "keyword_no", "page_no"], "k", package, '{"objects":[', '],"total":7}').withColumn("page_no", F.col("page_no") * 10_000 + F.col("body_no"))
    figures = p.filter("m % 3 < 2").select("name", "m").distinct()
    figure = F.concat(quoted("name"), F.when(F.col("m") % 3 == 0, F.concat(F.lit(':{"downloads":'), 10 * F.col("m"), F.lit(',"start":"s","end":"e"}'))).otherwise(":null"))
    rows = P.package_rows(pages, joined(figures, [], "name", figure, "{", "}", None), run_at())
    return rows.select("external_id", "publisher", "version", F.get_json_object("metrics", "$.weekly_downloads").cast("long").alias("weekly_downloads"), "definition_hash")


# -- webhook providers -------------------------------------------------------------------------------
APPS = """SELECT p_partkey AS k, CASE p_partkey % 97 WHEN 0 THEN 'http' WHEN 1 THEN 'schedule' ELSE 'brand_' || substring(p_brand, 7) || '-app' || (p_size % 40) END AS app,
 CASE p_partkey % 7 WHEN 0 THEN 'sources/new-' || (p_size % 4) || '-instant/x.mjs' WHEN 1 THEN 'sources/common/events.mjs' WHEN 2 THEN 'common/events.mjs' WHEN 3 THEN 'sources/poll-' || (p_size % 3) || '/a.mjs'
 WHEN 4 THEN 'sources/s/common-webhook.mjs' WHEN 5 THEN 'README.md' ELSE 'sources/file' END AS rest FROM @part"""


@query(f"""WITH a AS ({twin(APPS)}), d AS (SELECT *, nullif(nullif(regexp_extract(rest, '^sources/([^/]+)/', 1), ''), 'common') AS dir FROM a),
g AS (SELECT app, list_sort(list(DISTINCT dir) FILTER (dir IS NOT NULL)) AS dirs, bool_or(rest = 'sources/s/common-webhook.mjs') AS hook, arg_max(rest, k) FILTER (ends_with(rest, 'common/events.mjs')) AS events FROM d GROUP BY app)
SELECT app AS external_id, CASE WHEN app LIKE 'brand%' THEN 'Brand ' || replace(substring(app, 7), '-app', ' App') ELSE upper(app[1]) || app[2:] END AS name, CASE WHEN hook OR len(list_filter(dirs, lambda x: contains(x, 'instant'))) > 0 THEN 'instant' ELSE 'poll' END AS mode,
 CASE app WHEN 'http' THEN 'protocol' WHEN 'schedule' THEN 'platform_internal' ELSE 'vendor' END AS provider_type, hook AS has_common_webhook, array_to_string(dirs, ',') AS sources,
 CASE WHEN events IS NULL OR (app LIKE '%7' AND events = 'common/events.mjs') THEN NULL WHEN events = 'common/events.mjs' THEN 'a,b' ELSE 'only' END AS event_types FROM g WHERE len(dirs) > 0""")
def app_rows(spark, sf):
    a = derived(spark, sf, APPS, "part")
    path = F.concat("app", F.lit("/"), "rest")
    entry = F.concat(F.lit('{"type":"blob","path":"'), path, F.lit('"}'))
    trees = joined(a, [], "k", entry, '{"truncated":false,"tree":[{"type":"tree","path":"t/sources/u/v"},{"type":"blob","path":"TOP"},', "]}")
    text = F.when(F.col("rest") == "sources/common/events.mjs", "value: 'only'").when(F.col("app").endswith("7"), "nothing here").otherwise("value: 'a', value: \"b\", value:`a`, value: ''")
    texts = a.filter(F.col("rest").endswith("common/events.mjs")).select(F.concat(F.lit("components/"), path).alias("path"), text.alias("text")).distinct()
    rows = P.app_rows(trees, texts)
    return rows.select("external_id", "name", "mode", "provider_type", "has_common_webhook", F.array_join("sources.key", ",").alias("sources"), F.array_join("event_types", ",").alias("event_types"))


NODES = """SELECT p_partkey AS k, CASE WHEN p_partkey % 41 = 0 THEN 'Redis' WHEN p_partkey % 2 = 0 THEN 'Node' || (p_size % 20) ELSE 'node' || (p_size % 20) END AS dir, CASE p_partkey % 5 WHEN 0 THEN 'webhooks: [' WHEN 1 THEN 'polling: true' WHEN 2 THEN 'none' END AS text, p_partkey % 9 = 0 AS other FROM @part"""


@query(f"""WITH n AS ({twin(NODES)}), f AS (SELECT *, dir || '/' || k || 'Trigger.node.ts' AS path, CASE WHEN k % 5 = 0 THEN 'instant' WHEN k % 5 = 1 THEN 'poll' ELSE 'unclassified' END AS mode FROM n WHERE NOT other)
SELECT lower(dir) AS external_id, min(dir) AS name, CASE WHEN bool_or(mode = 'instant') THEN 'instant' WHEN bool_or(mode = 'poll') THEN 'poll' ELSE 'unclassified' END AS mode, CASE WHEN lower(dir) = 'redis' THEN 'protocol' ELSE 'vendor' END AS provider_type,
 string_agg(path || '=' || mode, ',' ORDER BY lower(path)) AS trigger_files, CAST(count(DISTINCT dir) - 1 AS BIGINT) AS collisions FROM f GROUP BY lower(dir)""")
def node_rows(spark, sf):
    n = derived(spark, sf, NODES, "part")
    path = F.concat("dir", F.lit("/"), "k", F.when(F.col("other"), ".node.ts").otherwise("Trigger.node.ts"))
    trees = joined(n, [], "k", F.concat(F.lit('{"type":"blob","path":"'), path, F.lit('"}')), '{"tree":[', "]}")
    rows = P.node_rows(trees, n.filter("text IS NOT NULL").select(path.alias("path"), "text"))
    files = F.array_join(F.transform("trigger_files", lambda f: F.concat_ws("=", f["path"], f["mode"])), ",")
    return rows.select("external_id", "name", "mode", "provider_type", files.alias("trigger_files"), "collisions")


# -- governance --------------------------------------------------------------------------------------
GOV = """SELECT o_orderkey AS k, o_orderkey % 30 AS page_no, 'r' || (o_custkey % 3) AS repo, CASE WHEN o_orderkey % 30 % 4 = 0 THEN 'discussion' ELSE 'issue' END AS type, CASE WHEN o_orderkey % 19 = 0 THEN '"' || o_orderkey || '"' WHEN o_orderkey % 23 = 0 THEN 'null' ELSE CAST(o_orderkey AS {text}) END AS number,
 CASE WHEN o_orderkey % 17 = 0 THEN '' WHEN o_orderkey % 13 = 0 THEN repeat(o_orderpriority, 100) ELSE o_orderpriority END AS title, CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' END AS state, CASE WHEN o_orderkey % 3 = 0 THEN 'u' || o_custkey END AS author,
 o_orderkey % 7 = 0 AS pr, o_orderkey % 11 = 0 AS undated, o_orderkey % 25 AS labels, CAST(o_orderdate AS {text}) AS at FROM @orders"""
GOV_SPARK, GOV_DUCK = GOV.format(text="STRING"), twin(GOV.format(text="VARCHAR"))
GOV_ROWS = f"WITH g AS ({GOV_DUCK}), kept AS (SELECT * FROM g WHERE NOT (pr AND type = 'issue') AND NOT undated AND title <> '' AND k % 19 <> 0 AND k % 23 <> 0), rows AS (SELECT *, 'https://h/' || k AS url FROM kept) "


def governance_pages(rows: DataFrame) -> DataFrame:
    labels = F.concat(F.lit('["first",{"name":"second"},{"name":""},{},""'), F.repeat(F.lit(',"more"'), F.col("labels").cast("int")), F.lit("]"))
    body = F.concat(F.lit('{"number":'), "number", member("title", quoted("title")), member("state", quoted("state")), member("user", F.concat(F.lit('{"login":'), quoted("author"), F.lit("}"))), member("labels", labels), F.lit(',"created_at":"c"'), F.when(F.col("undated"), "").otherwise(F.lit(',"updated_at":"u"')), F.lit(',"html_url":"https://h/'), "k", F.lit('"'), F.when(F.col("pr"), F.lit(',"pull_request":null')).otherwise(""), F.lit("}"))
    return joined(rows, ["repo", "type", "page_no"], "k", body, "[", "]")


@query(GOV_ROWS + """SELECT repo, type, k AS number, substring(title, 1, 500) AS title, coalesce(state, 'open') AS state, author, 'first,second' || repeat(',more', least(CAST(labels AS INT), 18)) AS labels, url FROM rows""")
def governance_rows(spark, sf):
    rows = P.governance_rows(governance_pages(derived(spark, sf, GOV_SPARK, "orders")))
    return rows.select("repo", "type", "number", "title", "state", "author", F.array_join("labels", ",").alias("labels"), "url")


@query(GOV_ROWS + """SELECT 'moved' AS what, repo, type, k AS number, 'closed' AS from_state, coalesce(state, 'open') AS to_state FROM rows WHERE k % 2 = 0 AND state IS DISTINCT FROM 'closed'
UNION ALL SELECT 'state', repo, type, k, NULL, CASE WHEN k % 5 = 0 AND k % 2 = 0 THEN 'closed' ELSE coalesce(state, 'open') END FROM rows WHERE k % 5 <> 0 OR k % 2 = 0""")
def governance_run(spark, sf):
    rows = derived(spark, sf, GOV_SPARK, "orders")
    stored = P.governance_rows(governance_pages(rows.filter("k % 2 = 0").withColumn("state", F.lit("closed")))).withColumn("fetched_at", run_at())
    state_, moved = P.governance_run(stored, governance_pages(rows.filter("k % 5 <> 0")), run_at())
    _, every = P.governance_run(stored, governance_pages(rows), run_at())
    state_ = state_.select(F.lit("state").alias("what"), "repo", "type", "number", F.lit(None).cast("string").alias("from_state"), F.col("state").alias("to_state"))
    return every.select(F.lit("moved").alias("what"), "repo", "type", "number", "from_state", "to_state").unionByName(state_)


# -- recorded responses ------------------------------------------------------------------------------
DISC = """SELECT c_custkey AS k, c_name AS name, 'host' || c_nationkey || '.example' AS host, CASE c_custkey % 29 WHEN 0 THEN 'https://{h}/' || c_custkey WHEN 1 THEN 'ftp://h/' || c_custkey ELSE 'https://host' || c_nationkey || '.example/' || c_custkey END AS endpoint_url,
 c_custkey % 31 AS r, c_nationkey = 3 AS h3, c_custkey % 43 = 0 AS mine, c_mktsegment AS seg, c_nationkey AS n FROM @customer"""
DISC_ROWS = f"""WITH d AS ({twin(DISC)}), e AS (SELECT *, CASE WHEN mine THEN 'endpoint ' || endpoint_url WHEN h3 THEN 'host ' || host WHEN k = 5 THEN 'server ' || name END AS hit, k % 29 < 2 AS refused FROM d),
f AS (SELECT *, hit IS NULL AND NOT refused AS dialled FROM e), g AS (SELECT * FROM f WHERE NOT dialled OR r <> 30) """


def discover_input(spark, sf):
    d = derived(spark, sf, DISC, "customer")
    r = F.col("r")
    version = F.concat(F.lit("2024-01-"), F.lpad(F.col("n").cast("string"), 2, "0"))
    body = (
        F.when(r < 5, F.concat(F.lit('{"result":{"supportedVersions":["'), version, F.lit('",7,"x"]}}'))).when(r < 8, F.lit('{"result":{"versions":[],"_meta":{"protocolVersion":"meta"}}}')).when(r < 10, F.lit('{"result":null}'))
        .when(r < 13, F.lit('{"error":{"code":-32601,"message":"nope"}}')).when(r < 15, F.lit('{"error":"Mcp-Session-Id missing"}')).when(r < 17, F.concat(F.lit('{"message":"Bad (supported versions: '), version, F.lit('; old.)"}'))).when(r < 19, F.lit("<html>")).when(r < 20, F.lit('{"jsonrpc":"2.0"}')).otherwise(F.lit("{}"))
    )
    status = F.when((r >= 15) & (r < 17), 400).when(r == 20, 405).when(r == 21, 404).when(r == 22, 429).when(r < 24, 200)
    thrown = r.between(24, 29)
    responses = d.filter("r <> 30").select("endpoint_url", status.alias("http_status"), F.lit("application/json").alias("content_type"), F.when(~thrown, body).alias("body"), F.when(r == 24, "TimeoutError").when(thrown, "TypeError").alias("exc_name"), F.when(r == 25, "ENOTFOUND").when(r == 26, "UND_ERR_SOCKET").when(r == 27, "ERR_TLS_X").when(r == 28, "EODD").alias("exc_code"), F.when(r == 29, "bad certificate").when(thrown, "m").alias("exc_message"), F.when(thrown, "fetch").alias("exc_stage"), F.lit(3).cast("long").alias("elapsed_ms"))
    rule = lambda rows, scope, pattern, applies, revoked=None, since="2024-01-01": rows.select(F.lit(scope).alias("scope"), pattern.alias("pattern"), F.lit(applies).alias("applies_to"), F.lit(revoked).cast("timestamp").alias("revoked_at"), F.lit(since).cast("timestamp").alias("effective_at"))
    one = spark.range(1)
    rules = rule(d.filter("mine"), "endpoint", F.col("endpoint_url"), "discover").unionByName(rule(one, "host", F.lit("HOST3.Example"), "anything")).unionByName(rule(d.filter("k = 5"), "server", F.col("name"), "all"))
    rules = rules.unionByName(rule(one, "host", F.lit("host4.example"), "all", "2024-02-01")).unionByName(rule(one, "host", F.lit("host5.example"), "all", None, "2024-04-01")).unionByName(rule(one, "host", F.lit("host6.example"), "tools")).unionByName(rule(one, "planet", F.lit("host7.example"), "all"))
    return d, responses, exclusions.active_rules(rules, run_at())


@query(DISC_ROWS + """SELECT name, endpoint_url, CASE WHEN hit IS NOT NULL THEN NULL WHEN k % 29 = 0 THEN 'template_placeholder' WHEN k % 29 = 1 THEN 'other' WHEN r = 24 THEN 'timeout' WHEN r = 25 THEN 'dns_failure' WHEN r = 26 THEN 'connection_refused' WHEN r IN (27, 29) THEN 'tls_error' WHEN r = 28 THEN 'other'
 WHEN r = 22 THEN 'rate_limited' WHEN r BETWEEN 15 AND 16 OR r BETWEEN 20 AND 21 THEN 'http_error' ELSE 'ok' END AS error_class,
 CASE WHEN NOT dialled THEN 'not_attempted' WHEN r < 10 THEN 'ok' WHEN r < 13 THEN 'unsupported' WHEN r < 15 THEN 'session_required' WHEN r = 20 THEN 'unsupported' ELSE 'error' END AS discover_status,
 CASE WHEN NOT dialled THEN NULL WHEN r < 5 THEN '2024-01-' || lpad(CAST(n AS VARCHAR), 2, '0') || '|x' WHEN r < 8 THEN 'meta' WHEN r < 10 THEN '' WHEN r BETWEEN 15 AND 16 THEN '2024-01-' || lpad(CAST(n AS VARCHAR), 2, '0') || '|old' END AS versions,
 CASE WHEN NOT dialled THEN NULL WHEN r < 8 THEN 'advertised' WHEN r BETWEEN 15 AND 16 THEN 'rejection' END AS version_source, CASE WHEN dialled THEN 'POST' END AS probe_method,
 CASE WHEN hit IS NOT NULL THEN 'excluded by operator request: ' || hit || CASE WHEN k % 29 = 0 THEN '; not attempted: template_placeholder' WHEN k % 29 = 1 THEN '; not attempted: scheme' ELSE '' END WHEN k % 29 = 0 THEN 'not attempted: template_placeholder' WHEN k % 29 = 1 THEN 'not attempted: scheme' WHEN r = 28 THEN 'EODD m' WHEN r = 22 THEN '429' END AS note FROM g""")
def discover_rows(spark, sf):
    endpoints, responses, rules = discover_input(spark, sf)
    rows = P.discover_rows(endpoints.select("name", "endpoint_url", "host"), responses, rules, "run")
    listed = F.when(F.col("protocol_versions").isNotNull(), F.array_join("protocol_versions", "|"))
    return rows.select("name", "endpoint_url", "error_class", "discover_status", listed.alias("versions"), "version_source", "probe_method", "note")


@query("""WITH e AS (SELECT event_id AS server_id, 'https://u' || user_id || '.example/x' AS endpoint_url, CASE event_type WHEN 'view' THEN 'ok' WHEN 'click' THEN 'ok' WHEN 'error' THEN 'error' WHEN 'signup' THEN 'unsupported' END AS s, ts FROM events),
runs AS (SELECT d, d + INTERVAL 36 HOURS AS z FROM (SELECT DISTINCT date_trunc('day', ts) AS d FROM events) WHERE day(d) % 4 <> 0), newest AS (SELECT * FROM runs WHERE EXISTS (SELECT 1 FROM e WHERE s IS NOT NULL AND ts BETWEEN d AND z) ORDER BY d DESC LIMIT 1),
l AS (SELECT * FROM (SELECT e.*, row_number() OVER (PARTITION BY endpoint_url ORDER BY ts DESC, server_id) AS rn FROM e, newest WHERE s IS NOT NULL AND ts BETWEEN d AND z) WHERE rn = 1)
SELECT 'target' AS what, endpoint_url AS key, server_id AS n FROM l WHERE s = 'ok' UNION ALL SELECT 'left out', s, count(*) FROM l WHERE s <> 'ok' GROUP BY s""")
def listing_targets(spark, sf):
    kind = F.col("event_type")
    e = table(spark, sf, "events").select(F.col("event_id").alias("server_id"), F.concat(F.lit("https://u"), "user_id", F.lit(".example/x")).alias("endpoint_url"), F.when(kind.isin("view", "click"), "ok").when(kind == "error", "error").when(kind == "signup", "unsupported").alias("discover_status"), F.col("ts").cast("timestamp").alias("probed_at"))
    day = F.date_trunc("day", "probed_at")
    runs = e.select(day.alias("started_at")).distinct().select(F.date_format("started_at", "yyyyMMdd").alias("run_id"), "started_at", F.when(F.dayofmonth("started_at") % 4 != 0, F.col("started_at") + F.expr("INTERVAL 36 HOURS")).alias("finished_at"))
    targets, others = P.listing_targets(runs, e)
    return targets.select(F.lit("target").alias("what"), F.col("endpoint_url").alias("key"), F.col("server_id").alias("n")).unionByName(others.select(F.lit("left out").alias("what"), F.col("discover_status").alias("key"), "n"))


# -- listings ----------------------------------------------------------------------------------------
#: kind of chain by conversation; its page ``page_no`` carries two items (one with odd fields).
CHAIN = "SELECT conv_id AS c, turn + 1 AS page_no, conv_id % 8 AS kind, length(text) AS n, turn AS t FROM @conversations"
CHAIN_PAGES = f"""WITH p AS ({twin(CHAIN)}), q AS (SELECT *, CASE WHEN kind = 0 AND page_no = 2 THEN 'thrown' WHEN kind = 1 AND page_no = 1 THEN 'thrown' WHEN kind = 2 AND page_no = 2 THEN 'busy' WHEN kind = 3 AND page_no = 2 THEN 'none' WHEN kind = 5 AND page_no = 3 THEN 'missing' WHEN kind = 7 AND page_no = 1 THEN 'session' ELSE 'ok' END AS s,
 CASE WHEN kind = 4 THEN 'again' WHEN kind = 6 AND page_no = 2 THEN '' ELSE 'c' || page_no END AS nc FROM p WHERE page_no <= 4), r AS (SELECT *, CASE WHEN s = 'thrown' THEN 'exception' WHEN s <> 'ok' THEN 'failed' WHEN nc = '' THEN 'complete' WHEN page_no > 1 AND kind = 4 THEN 'repeated_cursor' END AS reason, max(page_no) OVER (PARTITION BY c) AS last FROM q),
ends AS (SELECT c, min(page_no) FILTER (reason IS NOT NULL) AS at, max(last) AS last FROM r GROUP BY c),
x AS (SELECT e.c, e.last, coalesce(e.at, e.last) AS stop, coalesce(r.reason, CASE WHEN e.last = 4 THEN 'page_cap' ELSE 'unfinished' END) AS reason, r.s FROM ends e LEFT JOIN r ON r.c = e.c AND r.page_no = e.at),
parents AS (SELECT c, CASE WHEN reason = 'exception' AND stop > 1 THEN 'ok' WHEN reason = 'exception' THEN 'error' WHEN reason = 'failed' THEN CASE s WHEN 'missing' THEN 'unsupported' WHEN 'session' THEN 'session_required' ELSE 'error' END ELSE 'ok' END AS status, reason, CASE WHEN reason = 'exception' THEN stop - 1 ELSE stop END AS page_count, stop FROM x) """


def chain_pages(spark, sf, key: str, items: Column) -> DataFrame:
    p = derived(spark, sf, CHAIN, "conversations")
    kind, page = F.col("kind"), F.col("page_no")
    at = lambda k, n: (kind == k) & (page == n)
    cursor = F.when(kind == 4, ',"nextCursor":"again"').when(at(6, 2), "").otherwise(F.concat(F.lit(',"nextCursor":"c'), page, F.lit('"')))
    more = F.concat(F.when(page == 2, F.concat(F.lit(',"ttl":'), "n")).otherwise(""), F.when(page == 1, F.lit(f',"capabilities":{{"{key}":{{"listChanged":true}}}}')).otherwise(""))
    fine = F.concat(F.lit(f'{{"result":{{"{key}":['), items, F.lit("]"), cursor, more, F.lit("}}"))
    body = F.when(at(3, 2), '{"result":{}}').when(at(5, 3), '{"error":{"code":-32601,"message":"no such method"}}').when(at(7, 1), '{"error":{"message":"Session required: call initialize first"}}').otherwise(fine)
    stream = kind == 6
    status = F.when(at(2, 2), 429).when(at(7, 1), 400).otherwise(200)
    thrown = at(0, 2) | at(1, 1)
    return p.select(F.lit("run").alias("run_id"), F.col("c").cast("string").alias("endpoint_url"), run_at().alias("captured_at"), page.cast("int").alias("page_no"), F.when(~thrown, status).alias("http_status"), F.when(stream, "text/event-stream").otherwise("application/json").alias("content_type"), F.when(thrown, F.lit(None)).when(stream, F.concat(F.lit("event: message\ndata: "), body, F.lit("\n\n"))).otherwise(body).alias("body"), F.when(thrown, "AbortError").alias("exc_name"))


def told(parents: DataFrame) -> DataFrame:
    return parents.select(F.col("endpoint_url").cast("long").alias("c"), "status", "reason", F.col("page_count").cast("long").alias("page_count"), "item_count", "truncated", "items_lost", "cache_ttl_ms", "list_changed")


CAPTURES = CHAIN_PAGES + """SELECT c, status, reason, page_count, CASE WHEN status = 'ok' THEN 2 * CASE WHEN reason IN ('exception', 'failed') THEN stop - 1 ELSE stop END END AS item_count,
 reason IN ('repeated_cursor', 'page_cap') OR (reason = 'exception' AND stop > 1) AS truncated, CASE WHEN reason = 'exception' THEN 2 * (stop - 1) ELSE 0 END AS items_lost, (SELECT CAST(max(n) AS DOUBLE) FROM q WHERE q.c = parents.c AND page_no = 2 AND page_no <= page_count AND s = 'ok') AS cache_ttl_ms, (SELECT bool_or(true) FROM q WHERE q.c = parents.c AND page_no = 1 AND page_no <= page_count AND s = 'ok') AS list_changed FROM parents"""
ITEMS = CHAIN_PAGES + "{select} FROM parents JOIN q USING (c), (SELECT unnest([0, 1]) AS pos) WHERE status = 'ok' AND reason <> 'exception' AND page_no <= stop"


def items_of(spark, sf, spec: P.ListSpec, items: Column) -> tuple[DataFrame, DataFrame]:
    parents, rows = P.captures(spec, chain_pages(spark, sf, spec.result_key, items), 4)
    return parents, rows.join(parents.select("capture_id", F.col("endpoint_url").cast("long").alias("c")), "capture_id")


def two(first: list, second: list) -> Column:
    """Two JSON items from texts and column names (in a tuple)."""
    piece = lambda x: F.col(x[0]).cast("string") if isinstance(x, tuple) else F.lit(x)
    return F.concat(*map(piece, first), F.lit(","), *map(piece, second))


@query(CAPTURES)
def captures(spark, sf):
    parents, _ = items_of(spark, sf, P.RESOURCES, two(['{"uri":"r:', ("n",), '"}'], ['{"name":5}']))
    return told(parents)


@query(ITEMS.replace("{select}", """SELECT c, CAST(page_no AS INT) AS page_no, CAST(pos AS INT) AS pos, CASE pos WHEN 0 THEN 'r:' || n ELSE '' END AS uri, CASE pos WHEN 0 THEN 'name ' || page_no END AS name, CASE pos WHEN 0 THEN 'text/plain' END AS mime_type,
 CAST(ceil(CASE pos WHEN 0 THEN 51 + length(CAST(n AS VARCHAR)) + length(CAST(page_no AS VARCHAR)) ELSE 10 END / 4) AS BIGINT) AS token_estimate"""))
def resource_items(spark, sf):
    _, rows = items_of(spark, sf, P.RESOURCES, two(['{"uri":"r:', ("n",), '","name":"name ', ("page_no",), '","mimeType":"text/plain"}'], ['{"name":5}']))
    return rows.select("c", "page_no", "pos", "uri", "name", "mime_type", F.col("token_estimate").cast("long").alias("token_estimate"))


@query(ITEMS.replace("{select}", """SELECT c, CAST(page_no AS INT) AS page_no, CAST(pos AS INT) AS pos, CASE pos WHEN 0 THEN 'p' || n ELSE '' END AS name, CASE WHEN pos = 0 THEN 'T' END AS title, CASE pos WHEN 0 THEN 3 END AS argument_count, CASE pos WHEN 0 THEN 1 END AS required_count"""))
def prompt_items(spark, sf):
    _, rows = items_of(spark, sf, P.PROMPTS, two(['{"name":"p', ("n",), '","title":"T","arguments":[{"name":"a","required":true},{"name":"b","required":"true"},{"name":"c"}]}'], ['{"arguments":"none","title":null}']))
    return rows.select("c", "page_no", "pos", "name", "title", "argument_count", "required_count")


@query(ITEMS.replace("{select}", """SELECT c, CAST(page_no AS INT) AS page_no, CAST(pos AS INT) AS pos, CASE pos WHEN 0 THEN 't' || n END AS tool_name, CASE pos WHEN 0 THEN sha256('{"properties":{"q' || page_no || '":{"description":"d","type":["string","null"]}},"required":["a","q' || page_no || '"],"type":"object"}') END AS schema_hash,
 CASE pos WHEN 0 THEN sha256('{"properties":{"q' || page_no || '":{"type":["string","null"]}},"required":["a","q' || page_no || '"],"type":"object"}') END AS contract_hash, CASE pos WHEN 0 THEN 'q' || page_no || ':null|string:true' END AS params, 1 - CAST(pos AS INT) AS param_count, 2 - 2 * CAST(pos AS INT) AS required_count, CASE pos WHEN 0 THEN 4 END AS max_depth, pos = 0 AS type_union, false AS has_ref"""))
def tool_items(spark, sf):
    schema = ['{"name":"t', ("n",), '","inputSchema":{"type":"object","required":["q', ("page_no",), '","a"],"properties":{"q', ("page_no",), '":{"type":["string","null"],"description":"d"}}}}']
    _, rows = items_of(spark, sf, P.TOOLS, two(schema, ['{"name":7,"inputSchema":"none"}']))
    shown = F.when(F.col("param_set").isNotNull(), F.array_join(F.transform("param_set", lambda p: F.concat_ws(":", p["name"], p["type"], p["required"].cast("string"))), ","))
    return rows.select("c", "page_no", "pos", "tool_name", "schema_hash", "contract_hash", shown.alias("params"), "param_count", "required_count", "max_depth", F.coalesce("type_union", F.lit(False)).alias("type_union"), F.coalesce("has_ref", F.lit(False)).alias("has_ref"))


# -- smaller operators -------------------------------------------------------------------------------
SCHEMA = """SELECT p_partkey AS k, p_size % 2 = 0 AS u, p_size % 3 = 0 AS o, p_size % 5 = 0 AS r, p_size % 7 = 0 AS d, p_size % 11 = 0 AS deep FROM @part"""


def odd_schemas(spark, sf) -> DataFrame:
    s = derived(spark, sf, SCHEMA, "part")
    part = lambda c, yes, no: F.when(F.col(c), F.lit(yes)).otherwise(F.lit(no))
    inner = F.concat(F.lit('{"type":'), part("u", '["string","null"]', '["string"]'), part("o", ',"anyOf":[{"type":"a"},{"type":"b"}]', ',"anyOf":[{"type":"a"},{"type":"b","x":1}]'), part("r", ',"$ref":"#/x"', ""), part("d", ',"definitions":{}', ""), F.lit("}"))
    return s.withColumn("s", F.concat(F.lit('{"properties":{"p":'), F.when(F.col("deep"), F.concat(F.lit('{"items":[[{"a":'), inner, F.lit("}]]}"))).otherwise(inner), F.lit('},"required":["p",5'), F.when(F.col("u"), F.lit(',"q"')).otherwise(""), F.lit("]}")))


@query(f"WITH s AS ({twin(SCHEMA)}) SELECT k, u AS type_union, o AS union_via_composition, r AS has_ref, d AS has_defs, CASE WHEN u THEN 2 ELSE 1 END AS required, 1 AS n, CASE WHEN deep THEN 9 ELSE 5 END AS depth FROM s")
def schema_features(spark, sf):
    """F8, F9, F10 on schemas that differ in every flag."""
    s = odd_schemas(spark, sf)
    return s.select("k", J.false_drift(F.col("s")).alias("f"), J.required_count(F.col("s")).alias("required"), J.param_count(F.col("s")).alias("n"), J.max_depth(F.col("s")).alias("depth")).select("k", "f.*", "required", "n", "depth")


@query(f"WITH s AS ({twin(SCHEMA)}) SELECT count(*) AS total, count(*) FILTER (u) AS type_union, count(*) FILTER (o) AS union_via_composition, count(*) FILTER (r) AS has_ref, count(*) FILTER (d) AS has_defs FROM s")
def false_drift_tally(spark, sf):
    """A10."""
    return J.false_drift_tally(odd_schemas(spark, sf), F.col("s"))


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 0 WHEN 1 THEN CAST(ceil(o_orderkey * 0.5 * 1000) AS BIGINT) WHEN 2 THEN 2000 WHEN 4 THEN 1 END AS wait_ms FROM orders""")
def page_retry_after(spark, sf):
    """F31b."""
    k = F.col("o_orderkey")
    raw = F.when(k % 6 == 0, "  ").when(k % 6 == 1, F.concat((k * 0.5).cast("decimal(20,1)").cast("string"))).when(k % 6 == 2, "2e0").when(k % 6 == 3, "-1").when(k % 6 == 4, ".0001").otherwise("Wed, 01 Jan")
    return table(spark, sf, "orders").select("o_orderkey", C.page_retry_after_ms(raw).alias("wait_ms"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'given' WHEN c_custkey % 4 <> 3 THEN 's' || c_nationkey END AS scope, CASE c_mktsegment WHEN 'BUILDING' THEN 'platform_internal' WHEN 'MACHINERY' THEN 'protocol' ELSE 'vendor' END AS provider_type, c_custkey % 3 = 2 AS has_caveats FROM customer""")
def names_and_kinds(spark, sf):
    """F39, F18, F17."""
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    name = F.when(k % 4 == 3, "plain").otherwise(F.concat(F.lit("@s"), "c_nationkey", F.lit("/x")))
    scope = X.scope_of(name, F.when(k % 4 == 0, "given").when(k % 4 == 1, "unscoped").when(k % 4 == 2, ""))
    kind = X.provider_type(F.initcap("c_mktsegment"), ["building"], ["machinery"])
    return c.select("c_custkey", scope.alias("scope"), kind.alias("provider_type"), X.has_caveats(F.when(k % 3 == 0, " \t").when(k % 3 == 2, " x ")).alias("has_caveats"))


@query("SELECT event_id, CASE WHEN user_id >= 40 THEN repeat('a', 40) ELSE repeat('a', CAST(user_id AS INT)) || repeat('é', CAST((40 - user_id) // 2 AS INT)) END AS body FROM events")
def bounded_body(spark, sf):
    """Characters of two bytes, which the cut meets at their end or in their middle."""
    body = F.concat(F.repeat(F.lit("a"), F.col("user_id").cast("int")), F.repeat(F.lit("é"), F.lit(50)))
    return table(spark, sf, "events").select("event_id", S.bounded_body(body, 40).alias("body"))


@query("SELECT event_id, CASE event_type WHEN 'view' THEN props WHEN 'click' THEN '[1]' WHEN 'signup' THEN props END AS body FROM events")
def envelope_json(spark, sf):
    """Whole JSON bodies, and streams whose content type has parameters and capitals."""
    kind = F.col("event_type")
    body = F.when(kind == "view", F.col("props")).when(kind == "click", "[1]").when(kind == "signup", F.concat(F.lit("data: \ndata: null\ndata:"), "props")).when(kind == "error", "<html>")
    return table(spark, sf, "events").select("event_id", C.envelope(body, F.when(kind == "signup", "Text/Event-Stream; charset=x").when(kind == "click", "application/json")).alias("body"))


@query("SELECT n_regionkey, '{' || string_agg('\"' || n_name || '\":' || n_nationkey, ',' ORDER BY n_name) || '}' AS object FROM nation GROUP BY n_regionkey")
def object_of(spark, sf):
    """A7."""
    return merging.object_of(table(spark, sf, "nation"), ["n_regionkey"], "n_name", "n_nationkey")


@query("SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 300")
def fourth_page(spark, sf):
    """T3."""
    return merging.paged(table(spark, sf, "orders"), [F.desc("o_totalprice"), "o_orderkey"], 100, 3).select("o_orderkey")


@query("SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'P') AS marked FROM orders")
def count_pair(spark, sf):
    """A6."""
    return merging.count_pair(table(spark, sf, "orders"), F.col("o_orderstatus") == "P")


@query("""WITH w AS (SELECT p_brand, p_partkey, chr(CAST(CASE p_partkey % 4 WHEN 0 THEN 128512 WHEN 1 THEN 65281 WHEN 2 THEN 97 ELSE 228 END AS INT)) || p_partkey AS t, CASE p_partkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 0 ELSE 1 END AS rank FROM part)
SELECT p_brand, string_agg(t, ',' ORDER BY rank, CAST(p_partkey AS VARCHAR)) AS texts FROM w GROUP BY p_brand""")
def utf16_order(spark, sf):
    """T4: a character beyond the basic plane comes before one from U+E000 on."""
    lead = F.array(*[F.lit(x) for x in ("\U0001f600", "！", "a", "ä")])
    rows = table(spark, sf, "part").select("p_brand", F.concat(F.element_at(lead, (F.col("p_partkey") % 4 + 1).cast("int")), "p_partkey").alias("t"))
    return rows.groupBy("p_brand").agg(F.array_join(merging.utf16_sorted(F.collect_list("t")), ",").alias("texts"))


@query("SELECT p_size, string_agg(t, ',' ORDER BY lower(t), t DESC) AS paths FROM (SELECT DISTINCT p_size, CASE WHEN p_partkey % 2 = 0 THEN upper(substring(p_name, 1, 1)) || substring(p_name, 2) ELSE p_name END AS t FROM (SELECT p_size, p_partkey, replace(p_name, ' ', '') AS p_name FROM part)) GROUP BY p_size")
def locale_order(spark, sf):
    """T5: letters before case, lower case first."""
    name = F.replace("p_name", F.lit(" "), F.lit(""))
    rows = table(spark, sf, "part").select("p_size", F.when(F.col("p_partkey") % 2 == 0, F.concat(F.upper(F.substring(name, 1, 1)), F.substring(name, 2, 99))).otherwise(name).alias("t")).distinct()
    return rows.groupBy("p_size").agg(F.array_join(merging.locale_sorted(F.collect_list("t")), ",").alias("paths"))


@query("""WITH h AS (SELECT 'u' || user_id AS host, n_429, n_requests, CAST(list_reduce(list_prepend(CAST(150 AS DOUBLE), o), lambda g, x: CASE WHEN x = 1 THEN least(60000, greatest(150, g) * 4) ELSE greatest(150, floor(g * CAST(0.8 AS DOUBLE) + 0.5)) END) AS BIGINT) AS gap_ms
 FROM (SELECT user_id, list(CASE WHEN event_type = 'error' THEN CAST(1 AS DOUBLE) ELSE 0 END ORDER BY ts, event_id) AS o, count(*) FILTER (event_type = 'error') AS n_429, count(*) AS n_requests FROM events GROUP BY user_id))
SELECT 'total' AS what, NULL AS host, count(*) AS hosts, count(*) FILTER (gap_ms > 150) AS backed_off, CAST(sum(n_429) AS BIGINT) AS n, CAST(max(gap_ms) AS BIGINT) AS gap FROM h
UNION ALL SELECT * FROM (SELECT 'busiest', host, NULL, NULL, n_requests, CAST(gap_ms AS BIGINT) FROM h ORDER BY n_requests DESC, host LIMIT 3)""")
def sweep_statistics(spark, sf):
    """Over the gaps that the fold of all outcomes gives."""
    rows = table(spark, sf, "events").select(F.concat(F.lit("u"), "user_id").alias("host"), F.col("ts").cast("timestamp").alias("ts"), "event_id", F.when(F.col("event_type") == "error", "429").otherwise("ok").alias("outcome"))
    h = pacing.gap_fold(rows, "host", ["ts", "event_id"], "outcome")
    total, busiest = pacing.sweep_statistics(h, "host")
    no = F.lit(None).cast("long")
    return total.select(F.lit("total").alias("what"), F.lit(None).cast("string").alias("host"), "hosts", "backed_off", F.col("n_429").alias("n"), F.col("max_gap_ms").alias("gap")).unionByName(busiest.select(F.lit("busiest").alias("what"), "host", no.alias("hosts"), no.alias("backed_off"), F.col("n_requests").alias("n"), F.col("gap_ms").alias("gap")))


@query("""SELECT conv_id, arg_max(length(text), turn) FILTER (role <> 'user') AS last_reply FROM conversations GROUP BY conv_id""")
def last_given(spark, sf):
    """the value of the last page that gave one."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.when(F.col("role") != "user", F.length("text").cast("long")).alias("last_reply"))
    return chains.last_given(c, ["conv_id"], "last_reply", "turn")


@query("""SELECT c_custkey, CASE WHEN c_custkey // 100 % 5 = 0 OR c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN '{"n":' || c_custkey || '}' END AS value FROM customer""")
def lookup_results(spark, sf):
    """A failed batch leaves its members unmeasured, and so does a null or absent entry."""
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("name"), F.floor(F.col("c_custkey") / 100).alias("batch"))
    entry = F.concat(F.lit('"'), "name", F.when(F.col("c_custkey") % 3 == 1, F.concat(F.lit('":{"n":'), "name", F.lit("}"))).otherwise('":null'))
    bodies = joined(c.filter("c_custkey % 3 <> 2"), ["batch"], "c_custkey", entry, "{", "}", None).withColumn("body", F.when(F.col("batch") % 5 != 0, F.col("body")))
    return merging.lookup_results(c.select("name", "batch"), "name", bodies).select(F.col("name").cast("long").alias("c_custkey"), "value")
