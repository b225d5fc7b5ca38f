"""Pipelines from recorded pages to current-state rows.

A pipeline takes tables of recorded texts and the run's time and id as parameters (F44); nothing reads a clock, so a rerun
gives the same rows. Nested JSON stays text until a field is needed: that keeps NULL, absent and empty apart and
keeps the source's key order for the legacy hash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from registrylake.functions import classify as C
from registrylake.functions import jsonhash as J
from registrylake.functions import text as X
from registrylake.operators import chains, exclusions, latest, merging, state

# Platform-internal and protocol directories of the two webhook sources.
NODE_INTERNAL = ["errortrigger", "executeworkflow", "manualtrigger", "n8ntrigger", "workflowtrigger", "simulate", "e2etest", "schedule", "localfiletrigger", "ssetrigger", "form"]
NODE_PROTOCOL = ["postgres", "redis", "kafka", "mqtt", "amqp", "rabbitmq", "rssfeedread"]
APP_INTERNAL = ["schedule"]
APP_PROTOCOL = ["amqp", "email", "http", "imap", "mongodb", "mysql", "postgresql", "rss", "sftp"]


def json_array(text: Column, path: str) -> Column:
    """The elements of a JSON array as texts, in order."""
    return F.from_json(F.get_json_object(text, path), "array<string>")


def kind_of(text: Column, path: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_variant_get(F.try_parse_json(text), path, "variant")), F.lit("ABSENT"))


def string_field(text: Column, path: str) -> Column:
    return F.when(kind_of(text, path) == "STRING", F.get_json_object(text, path))


def sorted_strings(text: Column, path: str) -> Column:
    return merging.utf16_sorted(F.coalesce(json_array(text, path), F.array().cast("array<string>")))


# -- registry ----------------------------------------------------------------------------------------
def registry_items(pages: DataFrame) -> DataFrame:
    """One row for each listed server, numbered by page and place; ``pages``: page_no, body."""
    items = pages.select("page_no", F.posexplode(json_array(F.col("body"), "$.servers")).alias("pos", "item"))
    meta = F.from_json(F.get_json_object("item", "$._meta"), "map<string,string>")
    official = F.get(F.map_values(F.map_filter(meta, lambda k, _: k.endswith("/official"))), 0)
    return items.select(
        (F.col("page_no").cast("long") * 1_000_000 + F.col("pos")).alias("ordinal"), "item", F.get_json_object("item", "$.server").alias("server"), official.alias("meta"),
        F.get_json_object("item", "$.server.name").alias("name"), F.get_json_object("item", "$.server.version").alias("version"),
        (F.coalesce(kind_of(official, "$.isLatest") == "BOOLEAN", F.lit(False)) & (F.get_json_object(official, "$.isLatest") == "true")).alias("is_latest"),
    )


def registry_rows(pages: DataFrame, run_at: Column) -> DataFrame:
    """The newest version of each named server, with its three hashes."""
    best = latest.argmax_semver(registry_items(pages), "name", "version", "is_latest", "ordinal")
    quoted = lambda path: F.when(kind_of(F.col("meta"), path) != "ABSENT", F.to_json(F.try_variant_get(F.try_parse_json("meta"), path, "variant")))
    null = F.sha2(F.lit("null"), 256)
    return best.select(
        "name", F.get_json_object("server", "$.description").alias("description"), "version", F.get_json_object("meta", "$.status").alias("status"),
        F.get_json_object("server", "$.packages").alias("packages"), F.get_json_object("server", "$.remotes").alias("remotes"), F.col("item").alias("raw"), F.lit("registry").alias("source"),
        J.stable_hash(F.col("server")).alias("definition_hash"), F.coalesce(J.hash_canonical(quoted("$.status")), null).alias("status_hash"),
        F.coalesce(J.hash_canonical(quoted("$.statusMessage")), null).alias("status_message_hash"), run_at.alias("last_seen"),
    )


SERVER_HASHES = ["definition_hash", "status_hash", "status_message_hash"]


def registry_run(stored: DataFrame, pages: DataFrame, run_at: Column, counts: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """(next state, snapshots to append); both read the stored version, which is never overwritten.

    ``counts`` (A17) is told by the write of the snapshots: ``new`` and ``changed`` servers.
    """
    rows = registry_rows(pages, run_at)
    update = [c for c in rows.columns if c != "name"]
    return state.upsert(stored, rows, ["name"], update), state.counted(state.changed(stored, rows, ["name"], SERVER_HASHES), counts)


def live_endpoints(servers: DataFrame) -> DataFrame:
    """Endpoints of servers that are not deleted (NULL status is left out too), with their hosts."""
    live = servers.filter((F.col("status") != "deleted") & (F.json_array_length("remotes") > 0))
    each = live.select("name", F.explode(json_array(F.col("remotes"), "$")).alias("remote")).withColumn("endpoint_url", string_field(F.col("remote"), "$.url"))
    host = X.host(F.col("endpoint_url"))
    return each.filter(F.col("endpoint_url") != "").select("name", "endpoint_url", F.when(host.isNotNull(), host).otherwise(F.concat(F.lit("__unparseable__"), F.substring("endpoint_url", 1, 40))).alias("host"))


# -- artifacts ---------------------------------------------------------------------------------------
def part_no(bodies: DataFrame) -> Column:
    """The number of a body among the parts of a document; a document that is whole has none."""
    return (F.col("body_no") if "body_no" in bodies.columns else F.lit(0)).cast("long")


def analytics(document: DataFrame, name: str) -> DataFrame:
    """Counts of an analytics document (body; in parts if it has a ``body_no``); the last duplicate wins."""
    items = document.select(part_no(document).alias("part"), F.posexplode(json_array(F.col("body"), "$.items")).alias("pos", "item"))
    rows = items.select(F.get_json_object("item", "$.formula").alias("name"), (F.col("part") * 10**9 + F.col("pos")).alias("pos"), X.parsed_count(F.get_json_object("item", "$.count")).alias(name)).filter(F.col("name").isNotNull())
    return merging.last_wins(rows, "name", "pos")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` dealt by ``key`` to all shuffle partitions: few bytes a row, much work a row. Spark sizes its own exchanges by bytes and would leave that work to one task."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def formula_rows(formulae: DataFrame, installs: DataFrame, on_request: DataFrame, run_at: Column) -> DataFrame:
    """Artifact rows of formulae (body: one formula a row). The manifest is hashed, the metrics are not."""
    f = F.col("body")
    rows = spread(formulae.select(F.get_json_object(f, "$.name").alias("name"), "body"), "name")
    rows = merging.left_measures(merging.left_measures(rows, analytics(installs, "install_30d"), "name"), analytics(on_request, "install_on_request_30d"), "name")
    flag = lambda path: F.coalesce(F.get_json_object(f, path) == "true", F.lit(False))
    # What is used more than once has a column of its own: an expression would be computed at every use.
    rows = rows.withColumn("_executables", sorted_strings(f, "$.executables"))
    rows = rows.withColumn("_type", X.artifact_type(F.size("_executables") > 0, F.col("install_30d"), F.col("install_on_request_30d")))
    manifest = F.struct(
        F.col("name"), F.coalesce(F.get_json_object(f, "$.full_name"), F.col("name")).alias("full_name"), F.get_json_object(f, "$.tap").alias("tap"), F.get_json_object(f, "$.license").alias("license"),
        flag("$.deprecated").alias("deprecated"), flag("$.disabled").alias("disabled"), sorted_strings(f, "$.dependencies").alias("dependencies"),
        X.has_caveats(F.get_json_object(f, "$.caveats")).alias("has_caveats"), F.col("_executables").alias("executables"), F.col("_type.artifact_type"), F.col("_type.classification_basis"),
    )
    rows = rows.withColumn("_manifest", F.to_json(manifest, {"ignoreNullFields": "false"}))
    window = installs.select(F.get_json_object("body", "$.start_date"), F.get_json_object("body", "$.end_date")).first() or (None, None)  # one document
    metrics = F.to_json(F.struct("install_30d", "install_on_request_30d", F.lit(window[0]).cast("string").alias("window_start"), F.lit(window[1]).cast("string").alias("window_end")), {"ignoreNullFields": "false"})
    return rows.select(
        F.lit("homebrew_formula").alias("kind"), F.lit("homebrew").alias("source"), F.col("name").alias("external_id"), "name", F.lit(None).cast("string").alias("publisher"),
        F.get_json_object(f, "$.versions.stable").alias("version"), F.get_json_object(f, "$.desc").alias("description"), F.get_json_object(f, "$.homepage").alias("homepage_url"),
        F.col("_manifest").alias("manifest"), metrics.alias("metrics"), J.hash_canonical(F.col("_manifest")).alias("definition_hash"), X.artifact_status(flag("$.disabled"), flag("$.deprecated")).alias("status"), run_at.alias("last_seen"),
    )


def package_rows(pages: DataFrame, downloads: DataFrame, run_at: Column) -> DataFrame:
    """Artifact rows of packages found by several keywords.

    ``pages``: keyword, keyword_no, page_no, body; ``downloads``: body, a map of names to figures or null.
    """
    found = pages.select("keyword", (F.col("keyword_no").cast("long") * 10**12 + F.col("page_no").cast("long") * 10**6).alias("base"), F.posexplode(json_array(F.col("body"), "$.objects")).alias("pos", "o"))
    p = F.get_json_object("o", "$.package")
    rows = found.select((F.col("base") + F.col("pos")).alias("ordinal"), "keyword", p.alias("package"), F.get_json_object("o", "$.package.name").alias("name")).filter(F.col("name").isNotNull())
    merged = merging.first_wins(rows, "name", "ordinal", ["package"], "keyword")
    figures = downloads.select(F.explode(F.from_json("body", "map<string,string>")).alias("name", "dl")).filter(F.col("dl").isNotNull())
    both = merging.left_measures(merged, figures.groupBy("name").agg(F.first("dl").alias("dl")), "name")
    g = lambda path: F.get_json_object("package", path)
    scope = X.scope_of(F.col("name"), g("$.scope"))
    manifest = F.struct("name", scope.alias("scope"), g("$.license").alias("license"), F.coalesce(json_array(F.col("package"), "$.keywords"), F.array().cast("array<string>")).alias("keywords"), F.lit(None).cast("boolean").alias("deprecated"), g("$.links.repository").alias("repository"), F.col("keyword_set").alias("matched_queries"))
    metrics = F.struct(F.get_json_object("dl", "$.downloads").try_cast("long").alias("weekly_downloads"), F.get_json_object("dl", "$.start").alias("window_start"), F.get_json_object("dl", "$.end").alias("window_end"))
    both = both.withColumn("_manifest", F.to_json(manifest, {"ignoreNullFields": "false"}))
    publisher = F.coalesce(g("$.publisher.username"), F.nullif(F.regexp_extract("name", r"^@([^/]+)/", 1), F.lit("")))
    return both.select(
        F.lit("npm_package").alias("kind"), F.lit("npm").alias("source"), F.col("name").alias("external_id"), "name", publisher.alias("publisher"), g("$.version").alias("version"), g("$.description").alias("description"),
        F.coalesce(g("$.links.homepage"), g("$.links.npm")).alias("homepage_url"), F.col("_manifest").alias("manifest"), F.to_json(metrics, {"ignoreNullFields": "false"}).alias("metrics"), J.hash_canonical(F.col("_manifest")).alias("definition_hash"), F.lit("active").alias("status"), run_at.alias("last_seen"),
    )


def refuse_truncated(trees: DataFrame) -> DataFrame:
    """A truncated tree is refused where it is read; ``trees``: body."""
    whole = merging.refused(trees, F.get_json_object("body", "$.truncated") == "true", "a tree listing is truncated")
    entries = whole.select(part_no(trees).alias("part"), F.posexplode(json_array(F.col("body"), "$.tree")).alias("pos", "e"))
    return entries.select((F.col("part") * 10**9 + F.col("pos")).alias("pos"), F.get_json_object("e", "$.path").alias("path"), F.get_json_object("e", "$.type").alias("type")).filter("type = 'blob'")


def app_rows(trees: DataFrame, texts: DataFrame) -> DataFrame:
    """Apps that ship a source other than ``common``; ``texts``: path, text."""
    files = refuse_truncated(trees).filter(F.col("path").contains("/"))
    rest = F.expr("substring(path, instr(path, '/') + 1)")
    one = files.select("pos", F.expr("substring(path, 1, instr(path, '/') - 1)").alias("app"), rest.alias("rest")).withColumn("dir", X.source_dir(F.col("rest")))
    grouped = one.groupBy("app").agg(
        F.array_sort(F.collect_set("dir")).alias("dirs"), F.bool_or(F.col("rest").rlike(r"(^|/)common-webhook\.mjs$")).alias("has_common_webhook"),
        F.max_by("rest", F.when(F.col("rest").isin("common/events.mjs", "sources/common/events.mjs"), F.col("pos"))).alias("events_path"),
    ).filter(F.size("dirs") > 0)
    sources = F.transform("dirs", lambda d: F.struct(d.alias("key"), X.source_mode(d).alias("mode")))
    instant = F.col("has_common_webhook") | F.exists("dirs", lambda d: d.contains("instant"))
    events = texts.select(F.col("path").alias("_path"), X.event_values(F.col("text")).alias("event_types")).filter(F.size("event_types") > 0)
    both = grouped.join(events, F.concat(F.lit("components/"), "app", F.lit("/"), "events_path") == F.col("_path"), "left")
    return both.select(F.lit("app").alias("source"), F.col("app").alias("external_id"), X.title_of_slug(F.col("app")).alias("name"), F.when(instant, "instant").otherwise("poll").alias("mode"), X.provider_type(F.col("app"), APP_INTERNAL, APP_PROTOCOL).alias("provider_type"), "has_common_webhook", sources.alias("sources"), "event_types")


def by_path(files: Column) -> Column:
    """T5: structs (path, mode) by the root collation of their paths; equal ones by their bytes."""
    keyed = F.transform(files, lambda f: F.struct(F.collate(f["path"], "UNICODE").alias("k"), f.alias("f")))
    return F.transform(F.array_sort(keyed), lambda e: e["f"])


def node_rows(trees: DataFrame, texts: DataFrame) -> DataFrame:
    """Node directories with a trigger file; directories that differ in case only are one, and counted."""
    files = refuse_truncated(trees).filter(F.col("path").rlike(r"Trigger\.node\.ts$"))
    read = files.join(texts, "path", "left").select("path", F.split_part("path", F.lit("/"), F.lit(1)).alias("name"), X.trigger_mode(F.col("text")).alias("mode"))
    grouped = read.groupBy(F.lower("name").alias("external_id")).agg(
        F.min("name").alias("name"), F.count_distinct("name").alias("n_directories"), merging.mode_of_any(F.col("mode") == "instant", F.col("mode") == "poll").alias("mode"),
        by_path(F.collect_set(F.struct("path", "mode"))).alias("trigger_files"),
    )
    return grouped.select(F.lit("node").alias("source"), "external_id", "name", "mode", X.provider_type(F.col("external_id"), NODE_INTERNAL, NODE_PROTOCOL).alias("provider_type"), "trigger_files", (F.col("n_directories") - 1).alias("collisions"))


ARTIFACT_KEY = ["kind", "source", "external_id"]


def artifact_run(stored: DataFrame, rows: DataFrame, counts: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """(next state, snapshots to append); ``counts`` (A17) is told by the write of the snapshots."""
    update = [c for c in rows.columns if c not in ARTIFACT_KEY]
    snapshots = state.changed(stored, rows, ARTIFACT_KEY, ["definition_hash"]).select(state.capture_id(*map(F.col, ARTIFACT_KEY)).alias("artifact_id"), F.col("last_seen").alias("captured_at"), "definition_hash", "manifest", "change")
    return state.upsert(stored, rows, ARTIFACT_KEY, update), state.counted(snapshots, counts)


# -- governance --------------------------------------------------------------------------------------
def governance_rows(pages: DataFrame) -> DataFrame:
    """Issues and discussions as rows; ``pages``: repo, type, body (a JSON array). Pull requests go by the key alone."""
    items = pages.select("repo", "type", F.explode(F.from_json("body", "array<string>")).alias("i"))
    items = items.filter((F.col("type") != "issue") | ~F.array_contains(F.json_object_keys("i"), "pull_request"))
    g = lambda path: F.get_json_object("i", path)
    label = lambda x: F.coalesce(F.when(x.startswith("{"), F.get_json_object(x, "$.name")).otherwise(x), F.lit(""))
    labels = F.slice(F.filter(F.transform(F.coalesce(json_array(F.col("i"), "$.labels"), F.array().cast("array<string>")), label), lambda x: x != ""), 1, 20)
    kept = items.filter(kind_of(F.col("i"), "$.number").isin("BIGINT", "DOUBLE") | kind_of(F.col("i"), "$.number").startswith("DECIMAL"))
    for path in ("$.title", "$.created_at", "$.updated_at", "$.html_url"):
        kept = kept.filter(F.coalesce(g(path), F.lit("")) != "")
    return kept.select("repo", "type", g("$.number").cast("long").alias("number"), F.substring(g("$.title"), 1, 500).alias("title"), F.coalesce(g("$.state"), F.lit("open")).alias("state"), g("$.user.login").alias("author"), labels.alias("labels"), g("$.created_at").alias("created_at"), g("$.updated_at").alias("updated_at"), g("$.html_url").alias("url"))


GOVERNANCE_KEY = ["repo", "type", "number"]


def governance_run(stored: DataFrame, pages: DataFrame, run_at: Column) -> tuple[DataFrame, DataFrame]:
    """K9, X11: (next state, transitions); transitions come from the stored version."""
    rows = governance_rows(pages).withColumn("fetched_at", run_at)
    update = [c for c in rows.columns if c not in GOVERNANCE_KEY]
    moved = state.transitions(stored, rows, GOVERNANCE_KEY, "state").select(*GOVERNANCE_KEY, "from_state", "to_state", "title", F.col("fetched_at").alias("observed_at"))
    return state.upsert(stored, rows, GOVERNANCE_KEY, update), moved


# -- recorded responses ------------------------------------------------------------------------------
def discover_rows(endpoints: DataFrame, responses: DataFrame, rules: DataFrame, run_id: str) -> DataFrame:
    """Exactly one row for each endpoint that is dialled or excluded, with a closed status.

    ``responses``: endpoint_url, http_status, content_type, body, exc_name, exc_code, exc_message, exc_stage, elapsed_ms of the last attempt.
    """
    matched = exclusions.with_match(endpoints, rules, "discover", {"endpoint": "endpoint_url", "host": "host", "server": "name"})
    both = matched.join(responses, "endpoint_url", "left")
    reason = C.not_attempted_reason(F.col("endpoint_url"))
    out = C.discover_outcome(F.col("http_status"), F.col("body"), F.col("content_type"))
    thrown = F.col("exc_stage").isNotNull()
    answered = ~thrown & (F.col("http_status") != 429)
    cls = F.when(F.col("match").isNotNull(), F.lit(None)).when(reason == "template_placeholder", "template_placeholder").when(reason.isNotNull(), "other").when(thrown, C.exception_class(F.col("exc_name"), F.col("exc_code"), F.col("exc_message"))).otherwise(C.status_class(F.col("http_status")))
    status = F.when(F.col("match").isNotNull() | reason.isNotNull(), "not_attempted").when(answered, out["status"]).otherwise("error")
    dialled = F.col("match").isNull() & reason.isNull()
    note = C.assembled_note(exclusions.exclusion_note(F.col("match")), F.when(reason.isNotNull(), F.concat(F.lit("not attempted: "), reason)), F.when(dialled & thrown & (cls == "other"), F.substring(C.raw_error(F.col("exc_code"), F.col("exc_message")), 1, 200)), F.when(dialled & (F.col("http_status") == 429), F.lit("429")))
    kept = both.filter(~dialled | thrown | F.col("http_status").isNotNull())
    return kept.select(F.lit(run_id).alias("scan_run_id"), "name", "endpoint_url", "http_status", F.col("elapsed_ms").alias("response_time_ms"), cls.alias("error_class"), C.tls_valid(F.col("endpoint_url"), cls, F.col("http_status").isNotNull()).alias("tls_valid"), status.alias("discover_status"), F.when(dialled & answered, out["versions"]).alias("protocol_versions"), F.when(dialled & answered, out["source"]).alias("version_source"), F.when(dialled, F.lit("POST")).alias("probe_method"), note.alias("note"))


def reach_rows(endpoints: DataFrame, responses: DataFrame, run_id: str, max_redirects: int = 2) -> DataFrame:
    """One row for each endpoint from its recorded hops.

    ``responses``: endpoint_url, probe_method, hops (array of http_status, location), headers, content_type, exc_name, exc_code,
    exc_message, elapsed_ms. A malformed redirect is a row of class other, it does not stop the sweep (R21).
    """
    both = endpoints.join(responses, "endpoint_url", "left")
    reason = C.not_attempted_reason(F.col("endpoint_url"))
    thrown = F.col("exc_name").isNotNull() | F.col("exc_code").isNotNull() | F.col("exc_message").isNotNull()
    out = C.reach_outcome(F.col("hops"), max_redirects)
    cls = F.when(reason == "template_placeholder", "template_placeholder").when(reason.isNotNull(), "other").when(thrown, C.exception_class(F.col("exc_name"), F.col("exc_code"), F.col("exc_message"), head_probe=True)).otherwise(out["error_class"])
    tunnel = X.tunnel_suffix(X.host(F.col("endpoint_url")))
    note = C.assembled_note(F.when(reason.isNotNull(), F.concat(F.lit("not attempted: "), reason)), F.when(reason.isNull() & tunnel.isNotNull(), F.concat(F.lit("tunnel host "), tunnel)), F.when(reason.isNull(), out["note"]), F.when(reason.isNull() & (cls == "other"), F.substring(C.raw_error(F.col("exc_code"), F.col("exc_message")), 1, 200)))
    kept = both.filter(reason.isNotNull() | thrown | F.col("hops").isNotNull())
    asked = reason.isNull()
    return kept.select(F.lit(run_id).alias("scan_run_id"), "name", "endpoint_url", F.when(asked, out["http_status"]).alias("http_status"), F.col("elapsed_ms").alias("response_time_ms"), cls.alias("error_class"), C.tls_valid(F.col("endpoint_url"), cls, F.col("hops").isNotNull()).alias("tls_valid"), F.when(asked, out["redirect_target"]).alias("redirect_target"), note.alias("note"), F.when(asked, F.col("probe_method")).alias("probe_method"), F.when(asked, F.substring("content_type", 1, C.HEADER_CHARS)).alias("content_type"), F.when(asked, C.allowed_headers(F.col("headers"))).alias("response_headers"))


def smoke_slice(rows: DataFrame, order: list, n: int | None) -> tuple[DataFrame, bool]:
    """The first ``n`` rows and whether the run is a smoke run; all rows without ``n``. The limit is the feature."""
    return (rows, False) if n is None else (rows.orderBy(*order).limit(n), True)


def listing_targets(runs: DataFrame, probes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Endpoints whose newest row in the newest run with evidence is ok, and a histogram of the others."""
    evidence = probes.filter(F.col("discover_status").isNotNull())
    run = latest.latest_run_with_rows(runs, evidence, "probed_at")
    newest = latest.latest_per_key(latest.rows_in_run(evidence, run, "probed_at"), ["endpoint_url"], "probed_at", "server_id")
    ok = F.col("discover_status") == "ok"
    return newest.filter(ok & X.host(F.col("endpoint_url")).isNotNull()), exclusions.histogram(newest.filter(~ok), "discover_status")


@dataclass(frozen=True)
class ListSpec:
    """What a listing collector needs to know of its kind."""

    method: str
    result_key: str
    item_row: object
    item_columns: tuple


RESOURCES = ListSpec("resources/list", "resources", chains.resource_row, ("uri", "name", "title", "description", "mime_type", "token_estimate"))
PROMPTS = ListSpec("prompts/list", "prompts", chains.prompt_row, ("name", "title", "description", "argument_count", "required_count", "token_estimate"))


def captures(spec: ListSpec, pages: DataFrame, max_pages: int = chains.MAX_PAGES) -> tuple[DataFrame, DataFrame]:
    """(captures, items) of recorded pages: run_id, endpoint_url, captured_at, page_no, http_status, content_type, body, exc_name."""
    keys = ["run_id", "endpoint_url", "captured_at"]
    env = C.envelope(F.col("body"), F.col("content_type"))
    listed = json_array(F.col("env"), f"$.result.{spec.result_key}")
    read = pages.withColumn("env", env).select(*keys, "page_no", "env", C.listing_outcome(F.col("http_status"), F.col("env"), spec.result_key).alias("status"), string_field(F.col("env"), "$.result.nextCursor").alias("next_cursor"), F.coalesce(F.size(listed), F.lit(0)).cast("long").alias("n_items"), F.col("exc_name").alias("exception"), listed.alias("items"), F.octet_length("body").alias("bytes"), F.when(kind_of(F.col("env"), "$.result.ttl").isin("BIGINT", "DOUBLE"), F.get_json_object("env", "$.result.ttl").try_cast("double")).alias("ttl"), F.when(kind_of(F.col("env"), f"$.result.capabilities.{spec.result_key}.listChanged") == "BOOLEAN", F.get_json_object("env", f"$.result.capabilities.{spec.result_key}.listChanged") == "true").alias("list_changed"))
    ends = chains.fold_chains(read, keys, max_pages)
    # Only pages that the chain read to its end say something; a failed page's body is not looked at.
    good = read.join(ends.select(*keys, "page_count"), keys).filter((F.col("page_no") <= F.col("page_count")) & (F.col("status") == "ok") & F.col("exception").isNull())
    given = chains.last_given(good, keys, "ttl", "page_no").join(chains.last_given(good, keys, "list_changed", "page_no"), keys).withColumnRenamed("ttl", "cache_ttl_ms")
    parents = ends.join(given, keys, "left").withColumn("capture_id", state.capture_id("run_id", "endpoint_url", F.col("captured_at").cast("string")))
    whole = parents.filter((F.col("status") == "ok") & (F.col("reason") != "exception")).select(*keys, "capture_id", "page_count")
    rows = read.join(whole, keys).filter(F.col("page_no") <= F.col("page_count")).select("capture_id", "page_no", F.posexplode("items").alias("pos", "item"))
    return parents, rows.select("capture_id", "page_no", "pos", spec.item_row(F.col("item")).alias("r")).select("capture_id", "page_no", "pos", *[f"r.{c}" for c in spec.item_columns])


def tool_row(item: Column) -> Column:
    """Hashes and depth are NULL without a schema, counts 0."""
    schema = F.when(kind_of(item, "$.inputSchema").startswith("OBJECT"), F.get_json_object(item, "$.inputSchema"))
    f = J.schema_facts(schema)
    return F.struct(string_field(item, "$.name").alias("tool_name"), string_field(item, "$.title").alias("tool_title"), string_field(item, "$.description").alias("description"), schema.alias("input_schema"), f["schema_hash"].alias("schema_hash"), f["contract_hash"].alias("contract_hash"), f["param_set"].alias("param_set"), F.coalesce(J.param_count(schema), F.lit(0)).alias("param_count"), F.coalesce(f["required_count"], F.lit(0)).alias("required_count"), f["max_depth"].alias("max_depth"), *[f[n].alias(n) for n in J.FLAGS.names], J.token_estimate(item).alias("token_estimate"))


TOOLS = ListSpec("tools/list", "tools", tool_row, ("tool_name", "tool_title", "description", "input_schema", "schema_hash", "contract_hash", "param_set", "param_count", "required_count", "max_depth", "type_union", "union_via_composition", "has_ref", "has_defs", "token_estimate"))
