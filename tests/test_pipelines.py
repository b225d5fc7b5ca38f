import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from registrylake.operators import exclusions, latest, merging, state
from registrylake.plans import pipelines as P
from registrylake.plans import quality as Q
from registrylake.sources import pages as S
from registrylake.streaming.upserts import VersionedTable, upsert_stream

def now():
    return F.lit("2024-05-01").cast("timestamp")


def bodies(spark, *docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "body string")


# -- formulae: three runs ----------------------------------------------------------------------------
def formula(name, **more):
    return {"name": name, "versions": {"stable": "1"}, "executables": ["b", "a"], "dependencies": None, "caveats": " ", **more}


def counts(**n):
    return {"start_date": "a", "end_date": "b", "items": [{"formula": k, "count": v} for k, v in n.items()]}


def run(spark, stored, formulae, installs, req):
    rows = P.formula_rows(bodies(spark, *formulae), bodies(spark, installs), bodies(spark, req), now())
    stored = stored if stored is not None else rows.limit(0)
    nxt, snaps = P.artifact_run(stored, rows)
    return spark.createDataFrame(nxt.collect(), nxt.schema), [r.change for r in snaps.collect()]


def test_three_runs_of_formulae(spark):
    f = [formula("x"), formula("y", deprecated=True, disabled=True), formula("z", executables=[])]
    first, s1 = run(spark, None, f, counts(x="1,000", y=""), counts(x=400))
    assert s1 == ["new"] * 3
    second, s2 = run(spark, first, f, counts(x=2000, y=7), counts(x=900))
    assert s2 == []  # metrics moved, the ratio stays below one half
    third, s3 = run(spark, second, [*f, formula("w")], counts(x=2000), counts(x=1000))
    assert sorted(s3) == ["changed", "new"]
    got = {r.name: r for r in third.collect()}
    assert json.loads(got["x"].manifest)["artifact_type"] == "tool" and json.loads(got["x"].manifest)["executables"] == ["a", "b"]
    assert got["y"].status == "disabled" and json.loads(got["y"].metrics)["install_30d"] is None and json.loads(got["z"].manifest)["has_caveats"] is False
    zero = {r.name: json.loads(r.metrics)["install_30d"] for r in first.collect()}
    assert zero == {"x": 1000, "y": 0, "z": None}  # blank is a measured zero (R14), absent is unmeasured


# -- registry ----------------------------------------------------------------------------------------
def server(name, version, latest_=None, status="active", **more):
    meta = {k: v for k, v in (("status", status), ("isLatest", latest_), ("statusMessage", more.pop("message", None))) if v is not None}
    return {"server": {"name": name, "version": version, **more}, "_meta": {"reg.example/official": meta}}


def registry(spark, *pages):
    return spark.createDataFrame([(i, json.dumps({"servers": p, "metadata": {}})) for i, p in enumerate(pages)], "page_no int, body string")


def test_registry_choice_and_snapshots(spark):
    pages = registry(
        spark,
        [server("a", "1.2.0", description="first"), server("a", "1.10.0"), server("b", "2.0.0", "true"), server("b", "1.0.0", True), server("", "1.0.0")],
        [server("a", "1.10.0", description="tie"), server("c", None, status=None), server("d", "1.0.0", remotes=[{"url": "https://D.example/x"}, {"url": ""}, {"u": 1}, {"url": "nohost"}]), server("e", "1.0.0", status="deleted", remotes=[{"url": "https://e/"}])],
    )
    rows = {r.name: r for r in P.registry_rows(pages, now()).collect()}
    assert {k: r.version for k, r in rows.items()} == {"a": "1.10.0", "b": "1.0.0", "c": None, "d": "1.0.0", "e": "1.0.0"}
    assert rows["a"].description is None and rows["c"].status is None
    empty = P.registry_rows(pages, now()).limit(0)
    state1, new = P.registry_run(empty, pages, now())
    assert new.count() == 5
    stored = spark.createDataFrame(state1.collect(), state1.schema)
    again = registry(spark, [server("a", "1.10.0"), server("b", "1.0.0", True, message="bye"), server("c", None, status="active"), server("d", "1.0.0", remotes=[{"url": "https://D.example/x"}, {"url": ""}, {"u": 1}, {"url": "nohost"}])])
    state2, changed = P.registry_run(stored, again, now())
    assert sorted(r.name for r in changed.collect()) == ["b", "c"]
    live = sorted((r.name, r.host) for r in P.live_endpoints(state2).collect())
    assert live == [("d", "__unparseable__nohost"), ("d", "d.example")]


# -- packages and webhooks ---------------------------------------------------------------------------
def test_packages_first_wins(spark):
    def found(*names):
        return json.dumps({"objects": [{"package": p} for p in names], "total": 3})

    pages = spark.createDataFrame([("sdk", 0, 0, found({"name": "@s/p", "license": "A", "keywords": ["k", "k"]}, {"name": "q", "scope": "unscoped", "publisher": {"username": "u"}})), ("client", 1, 0, found({"name": "@s/p", "license": "B"}))], "keyword string, keyword_no int, page_no int, body string")
    rows = {r.name: r for r in P.package_rows(pages, bodies(spark, {"q": {"downloads": 5, "start": "s", "end": "e"}, "@s/p": None}), now()).collect()}
    m = json.loads(rows["@s/p"].manifest)
    assert (m["license"], m["scope"], m["matched_queries"], m["deprecated"], m["keywords"]) == ("A", "s", ["client", "sdk"], None, ["k", "k"])
    assert rows["@s/p"].publisher == "s" and json.loads(rows["@s/p"].metrics)["weekly_downloads"] is None and json.loads(rows["q"].metrics)["weekly_downloads"] == 5


def tree(*paths, truncated=False):
    return {"tree": [{"path": p, "type": "blob"} for p in paths] + [{"path": "x/sources/y/", "type": "tree"}], "truncated": truncated}


def test_webhook_sources(spark):
    apps = bodies(spark, tree("my-app/sources/new-item-instant/a.mjs", "my-app/sources/common/events.mjs", "my-app/common/events.mjs", "only/sources/common/x.mjs", "slow/sources/poll-it/x.mjs", "hook/sources/s/common-webhook.mjs", "http/sources/s/x.mjs", "README"))
    texts = spark.createDataFrame([("components/my-app/common/events.mjs", "value: 'a', value: \"b\", value:`a`, value: ''")], "path string, text string")
    got = {r.external_id: r for r in P.app_rows(apps, texts).collect()}
    assert {k: (r.mode, r.provider_type) for k, r in got.items()} == {"my-app": ("instant", "vendor"), "slow": ("poll", "vendor"), "hook": ("instant", "vendor"), "http": ("poll", "protocol")}
    assert got["my-app"].name == "My App" and got["my-app"].event_types == ["a", "b"] and got["slow"].event_types is None
    nodes = bodies(spark, tree("Git/GitTrigger.node.ts", "git/OtherTrigger.node.ts", "Form/FormTrigger.node.ts", "Git/Git.node.ts"))
    texts = spark.createDataFrame([("Git/GitTrigger.node.ts", "polling: true"), ("git/OtherTrigger.node.ts", "webhooks = [")], "path string, text string")
    rows = {r.external_id: r for r in P.node_rows(nodes, texts).collect()}
    assert (rows["git"].mode, rows["git"].collisions, rows["form"].mode, rows["form"].provider_type) == ("instant", 1, "unclassified", "platform_internal")
    with pytest.raises(Exception, match="truncated"):
        P.app_rows(bodies(spark, tree("a/b", truncated=True)), texts).collect()


# -- governance --------------------------------------------------------------------------------------
def test_governance_transitions(spark):
    def page(*items):
        return spark.createDataFrame([("r", "issue", json.dumps(list(items)))], "repo string, type string, body string")

    base = {"created_at": "c", "updated_at": "u", "html_url": "h"}
    one = page({"number": 1, "title": "t" * 600, "state": "open", "labels": ["x", {"name": "y"}, {"name": ""}, {}] + ["z"] * 30, "user": None, **base}, {"number": 2, "title": "pr", "pull_request": None, **base}, {"number": 3, **base}, {"number": "4", "title": "text", **base})
    rows = P.governance_rows(one).collect()
    assert [(r.number, len(r.title), r.labels[:3], len(r.labels), r.author) for r in rows] == [(1, 500, ["x", "y", "z"], 20, None)]
    stored, moved = P.governance_run(P.governance_rows(one).withColumn("fetched_at", now()).limit(0), one, now())
    assert moved.count() == 0  # first sight
    stored = spark.createDataFrame(stored.collect(), stored.schema)
    two = page({"number": 1, "title": "t", "state": "closed", **base}, {"number": 5, "title": "new", **base})
    nxt, moved = P.governance_run(stored, two, now())
    assert [(r.number, r.from_state, r.to_state) for r in moved.collect()] == [(1, "open", "closed")] and nxt.count() == 2


# -- recorded responses ------------------------------------------------------------------------------
def test_every_endpoint_gets_one_row(spark):
    urls = ["https://a/1", "https://{x}/2", "nope", "ftp://f/3", "https://t/4", "https://r/5", "https://h/6", "https://s/7", "https://never/8"]
    ends = spark.createDataFrame([(f"srv{i}", u) for i, u in enumerate(urls)], "name string, endpoint_url string").withColumn("host", P.X.host(F.col("endpoint_url")))
    answers = [("https://a/1", 200, "application/json", '{"result":{"supportedVersions":["v"]}}', None, None, None, None), ("https://t/4", 200, None, None, "AbortError", None, None, "body"), ("https://r/5", 429, None, None, None, None, None, None), ("https://h/6", 500, None, "x", None, None, None, None), ("https://s/7", 200, None, "{}", None, None, None, None)]
    responses = spark.createDataFrame([(*a, 5) for a in answers], "endpoint_url string, http_status int, content_type string, body string, exc_name string, exc_code string, exc_message string, exc_stage string, elapsed_ms long")
    rules = spark.createDataFrame([("host", "S", "weird", None, datetime(2024, 1, 1))], "scope string, pattern string, applies_to string, revoked_at timestamp, effective_at timestamp")
    rows = {r.endpoint_url: r for r in P.discover_rows(ends, responses, exclusions.active_rules(rules, now()), "run").collect()}
    assert {u: (r.discover_status, r.error_class) for u, r in rows.items()} == {
        "https://a/1": ("ok", "ok"), "https://{x}/2": ("not_attempted", "template_placeholder"), "nope": ("not_attempted", "other"), "ftp://f/3": ("not_attempted", "other"),
        "https://t/4": ("error", "timeout"), "https://r/5": ("error", "rate_limited"), "https://h/6": ("error", "http_error"), "https://s/7": ("not_attempted", None),
    }
    assert rows["https://t/4"].http_status == 200 and rows["https://t/4"].tls_valid is True and rows["https://s/7"].probe_method is None and rows["https://a/1"].protocol_versions == ["v"]


def test_reach_rows(spark):
    ends = spark.createDataFrame([(u, u) for u in ("https://a.ngrok.io/", "http://{x}/", "https://loop/", "https://thrown/", "https://never/")], "name string, endpoint_url string")
    hops = "array<struct<http_status:int,location:string>>"
    rows = [("https://a.ngrok.io/", "HEAD", [(200, None)], {"Server": "s", "Date": "d"}, "t", None, None, None, 1), ("https://loop/", "GET", [(301, "u1"), (302, "u2"), (307, "u3"), (200, None)], None, None, None, None, None, 2), ("https://thrown/", "HEAD", None, None, None, None, "UND_ERR_BODY_TIMEOUT", "late", 3)]
    responses = spark.createDataFrame(rows, f"endpoint_url string, probe_method string, hops {hops}, headers map<string,string>, content_type string, exc_name string, exc_code string, exc_message string, elapsed_ms long")
    got = {r.endpoint_url: r for r in P.reach_rows(ends, responses, "run").collect()}
    assert {u: (r.error_class, r.http_status, r.redirect_target, r.probe_method) for u, r in got.items()} == {
        "https://a.ngrok.io/": ("ok", 200, None, "HEAD"), "http://{x}/": ("template_placeholder", None, None, None), "https://loop/": ("ok", 307, "u3", "GET"), "https://thrown/": ("other", None, None, "HEAD"),
    }
    assert got["https://a.ngrok.io/"].response_headers == {"server": "s"} and "tunnel" in got["https://a.ngrok.io/"].note and "budget" in got["https://loop/"].note and "late" in got["https://thrown/"].note
    kept, smoke = P.smoke_slice(ends, ["name"], 2)
    assert kept.count() == 2 and smoke and P.smoke_slice(ends, ["name"], None)[1] is False


def pages_of(spark, chains_):
    rows = []
    for url, pages in chains_.items():
        for i, (status, body, exc) in enumerate(pages):
            rows.append(("run", url, datetime(2024, 1, 1), i + 1, status, "application/json", None if body is None else json.dumps(body), exc))
    return spark.createDataFrame(rows, "run_id string, endpoint_url string, captured_at timestamp, page_no int, http_status int, content_type string, body string, exc_name string")


def test_listing_chains(spark):
    def page(n, cursor=None, **more):
        return (200, {"result": {"prompts": [{"name": f"p{i}"} for i in range(n)], **({"nextCursor": cursor} if cursor is not None else {}), **more}}, None)

    chains_ = {
        "complete": [page(2, "c"), page(1, "", ttl=9, capabilities={"prompts": {"listChanged": False}})],
        "repeat": [page(1, "c"), page(1, "c"), page(1, "d")],
        "cap": [page(1, f"c{i}") for i in range(25)],
        "thrown": [page(2, "c"), (None, None, "AbortError")],
        "thrown_first": [(None, None, "AbortError")],
        "failed": [page(2, "c"), (500, {}, None)],
        "limited": [page(2, "c"), (429, None, None)],
        "gone": [(200, {"error": {"code": -32601, "message": "x"}}, None)],
    }
    parents, items = P.captures(P.PROMPTS, pages_of(spark, chains_))
    got = {r.endpoint_url: (r.status, r.page_count, r.item_count, r.truncated, r.items_lost) for r in parents.collect()}
    assert got == {
        "complete": ("ok", 2, 3, False, 0), "repeat": ("ok", 2, 2, True, 0), "cap": ("ok", 20, 20, True, 0), "thrown": ("ok", 1, 2, True, 2), "thrown_first": ("error", 0, None, False, 0),
        "failed": ("error", 2, None, False, 0), "limited": ("error", 2, None, False, 0), "gone": ("unsupported", 1, None, False, 0),
    }
    per = {r.endpoint_url: r.n for r in items.join(parents, "capture_id").groupBy("endpoint_url").agg(F.count("*").alias("n")).collect()}
    assert per == {"complete": 3, "repeat": 2, "cap": 20}
    ttl = {r.endpoint_url: (r.cache_ttl_ms, r.list_changed) for r in parents.collect()}
    assert ttl["complete"] == (9.0, False) and ttl["repeat"] == (None, None)


def test_items_of_each_kind(spark):
    one = lambda spec, item: P.captures(spec, pages_of(spark, {"u": [(200, {"result": {spec.result_key: [item]}}, None)]}))[1].first()
    p = one(P.PROMPTS, {"name": "n", "arguments": [{"required": True}, {"required": "true"}, {}]})
    assert (p["name"], p.argument_count, p.required_count) == ("n", 3, 1)
    assert one(P.PROMPTS, {"name": "n"}).argument_count is None
    r = one(P.RESOURCES, {"name": 5, "mimeType": "m"})
    assert (r.uri, r["name"], r.mime_type) == ("", None, "m")
    t = one(P.TOOLS, {"name": "t", "inputSchema": {"properties": {"a": {"type": "string"}}}})
    assert t.param_count == 1 and t.max_depth == 3 and len(t.schema_hash) == 64
    bare = one(P.TOOLS, {"name": "t"})
    assert (bare.schema_hash, bare.contract_hash, bare.max_depth, bare.param_count, bare.required_count) == (None, None, None, 0, 0)


def test_listing_targets(spark):
    t = lambda h: datetime(2024, 1, 1, h)
    runs = spark.createDataFrame([("old", t(1), t(2)), ("good", t(3), t(4)), ("empty", t(6), t(7)), ("open", t(8), None)], "run_id string, started_at timestamp, finished_at timestamp")
    probes = spark.createDataFrame([("s1", "https://a/", t(3), "ok"), ("s1", "https://a/", t(4), "error"), ("s2", "https://b/", t(4), "ok"), ("s3", "https://b/", t(4), "error"), ("s4", "https://c/", t(6), None), ("s5", "noturl", t(3), "ok"), ("s6", "https://d/", t(9), "ok")], "server_id string, endpoint_url string, probed_at timestamp, discover_status string")
    targets, others = P.listing_targets(runs, probes)
    assert [(r.endpoint_url, r.server_id) for r in targets.collect()] == [("https://b/", "s2")]
    assert [tuple(r) for r in others.collect()] == [("error", 1)]


# -- operators ---------------------------------------------------------------------------------------
def test_exclusion_rules(spark):
    rules = spark.createDataFrame([("host", "EX.com", "all", None, 1), ("endpoint", "https://e/x", "tools", None, 1), ("server", "s9", "discover", None, 1), ("host", "late.com", "all", None, 9), ("host", "gone.com", "all", 2, 1), ("galaxy", "ex.com", "all", None, 1)], "scope string, pattern string, applies_to string, r int, e int")
    rules = rules.withColumns({"revoked_at": F.when(F.col("r").isNotNull(), now()), "effective_at": F.when(F.col("e") == 9, F.lit("2030-01-01")).otherwise("2020-01-01").cast("timestamp")})
    targets = spark.createDataFrame([("s1", "https://ex.com/", "ex.com"), ("s1", "https://sub.ex.com/", "sub.ex.com"), ("s1", "https://e/x", "e"), ("s1", "https://e/x/y", "e"), ("s9", "https://z/", "z"), ("s1", "https://late.com/", "late.com"), ("s1", "https://gone.com/", "gone.com")], "name string, url string, host string")
    columns = {"endpoint": "url", "host": "host", "server": "name"}
    hit = lambda m: sorted(r.url for r in exclusions.with_match(targets, exclusions.active_rules(rules, now()), m, columns).filter("match IS NOT NULL").collect())
    assert hit("discover") == ["https://ex.com/", "https://z/"] and hit("tools") == ["https://e/x", "https://ex.com/"]


def test_upsert_and_changes_are_null_safe(spark):
    stored = spark.createDataFrame([(1, "a", "keep"), (2, None, "k2")], "id int, h string, other string")
    incoming = spark.createDataFrame([(2, None), (3, "n"), (1, None)], "id int, h string")
    assert sorted(map(tuple, state.upsert(stored, incoming, ["id"], ["h"]).collect())) == [(1, None, "keep"), (2, None, "k2"), (3, "n", None)]
    assert sorted((r.id, r.change) for r in state.changed(stored, incoming, ["id"], ["h"]).collect()) == [(1, "changed"), (3, "new")]
    with pytest.raises(ValueError):
        state.upsert(stored, incoming, ["id"], ["h", "other"])
    assert state.upsert(stored, incoming.limit(0), ["id"], ["h"]).count() == 2


def test_breaking_changes(spark):
    kind = "endpoint_url string, tool_name string, param_set array<struct<name:string,type:string,required:boolean>>"
    before = spark.createDataFrame([("u", "gone", []), ("u", "t", [("a", "string", False), ("b", None, True)])], kind)
    after = spark.createDataFrame([("u", "t", [("a", "number", True), ("b", "x", True), ("c", None, True), ("d", None, False)]), ("u", "fresh", [])], kind)
    got = sorted((r.tool_name, r.name, r.change) for r in state.breaking_changes(before, after).filter("name IS NOT NULL").collect())
    assert got == [("t", "a", "required_added"), ("t", "b", "type_changed"), ("t", "c", "required_added")]
    assert state.breaking_changes(before, after).filter("change = 'tool_removed'").count() == 1


def test_batches_and_caps(spark):
    names = spark.createDataFrame([(f"n{i:04d}",) for i in range(300)], "name string").repartition(5)
    got = {r.name: r.batch for r in merging.lookup_batches(names, "name").collect()}
    assert all(got[f"n{i:04d}"] == i // 128 for i in range(300))
    kept, left = merging.capped(names, ["name"], 10)
    assert kept.count() == 10 and left.first().dropped == 290
    with pytest.raises(Exception, match="names: no rows"):
        merging.refuse_if_empty(names.filter("name > 'x'"), "names").count()
    assert merging.refuse_if_empty(names, "names").count() == 300


def test_latest_breaks_ties(spark):
    rows = spark.createDataFrame([("k", datetime(2024, 1, 1), "b"), ("k", datetime(2024, 1, 1), "a"), ("n", None, "z")], "k string, at timestamp, id string")
    assert sorted((r.k, r.id) for r in latest.latest_per_key(rows, ["k"], "at", "id").collect()) == [("k", "a"), ("n", "z")]


# -- rules, sources, streaming -----------------------------------------------------------------------
def test_quality_rules(spark):
    for age in (49.0, None):
        with pytest.raises(Q.RunFailed):
            Q.refuse_stale(age)
    Q.refuse_stale(48.0)
    with pytest.raises(Q.RunFailed):
        Q.refuse_zero_rows(0, "x")
    bad = spark.createDataFrame([("ok",), ("odd",), (None,)], "s string")
    assert Q.outside_vocabulary(bad, "s", ["ok"]).count() == 2
    done, errors = Q.isolated({"a": lambda: 1, "b": lambda: 1 / 0})
    assert done == {"a": 1} and "ZeroDivisionError" in errors["b"]
    with pytest.raises(Q.RunFailed):
        Q.isolated({"b": lambda: 1 / 0})
    full = {"items_insert": True, "items_select": True, "items_update_cols": dict.fromkeys([*Q.UPDATE_COLUMNS], True) | {"repo": False}, "transitions_insert": True}
    assert Q.write_access_problems(full) == [] and len(Q.write_access_problems({})) == 4
    for c in Q.UPDATE_COLUMNS:
        assert c in Q.write_access_problems(full | {"items_update_cols": {k: v for k, v in full["items_update_cols"].items() if k != c}})[0]
    assert Q.after_success(1, lambda: 1 / 0) is None and "ZeroDivisionError" in Q.after_success(0, lambda: 1 / 0)
    assert Q.run_record(spark, "i", "s", datetime(2024, 1, 1), datetime(2024, 1, 2), {"pages": 1, "rows": 2}).first().status == "completed: pages=1, rows=2"
    assert Q.log_record(spark, "s", datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 2), {"fetched": 3}).first().duration_ms == 2000


def test_cursor_pages(spark, tmp_path):
    chain = tmp_path / "chains" / "a"
    chain.mkdir(parents=True)
    for name, nxt in (("first", "p2"), ("p2", "p3"), ("p3", "p2")):
        (chain / f"{name}.json").write_text(json.dumps({"servers": [{"n": name}], "metadata": {"nextCursor": nxt}}))
    S.register(spark)
    rows = spark.read.format("cursor_pages").option("path", str(tmp_path / "chains")).load().collect()
    assert [(r.chain, r.page_no, json.loads(r.body)["servers"][0]["n"]) for r in rows] == [("a", 0, "first"), ("a", 1, "p2"), ("a", 2, "p3")]
    assert [S.page_wait(429, i, None) for i in (1, 2, 3, 4)] == [5.0, 15.0, 45.0, None] and S.page_wait(500, 1, None) is None and S.page_wait(429, 1, 700) == 0.7
    assert len(S.offsets()) == 40 and S.offsets()[-1] == 9750 and [S.search_wait(i) for i in (1, 2, 3, 4)] == [1.5, 3.0, 6.0, None]
    with pytest.raises(ValueError):
        S.required("", "place")
    cut = spark.createDataFrame([("aé" * 3,), ("ab",)], "b string").select(S.bounded_body(F.col("b"), 4).alias("x"), F.octet_length("b").alias("n")).collect()
    assert cut[1].x == "ab" and cut[0].x == "aéa"
    for cap in range(14):
        text = "a\u20ac\U0001f600\u00e9\ufffd"
        got = spark.createDataFrame([(text,)], "b string").select(S.bounded_body(F.col("b"), cap)).first()[0]
        assert got == text.encode()[:cap].decode("utf-8", "ignore")


def test_streaming_upsert_is_idempotent(spark, tmp_path):
    kind = "id int, v string, n long"
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], kind).coalesce(1).write.parquet(source)
    table = VersionedTable(spark, str(tmp_path / "t"), kind, ["id"])
    for _ in range(2):
        upsert_stream(spark.readStream.schema(kind).parquet(source), table, str(tmp_path / "cp"), "n").awaitTermination()
    spark.createDataFrame([(2, "d", 5), (3, "e", 1)], kind).write.mode("append").parquet(source)
    upsert_stream(spark.readStream.schema(kind).parquet(source), table, str(tmp_path / "cp"), "n").awaitTermination()
    assert sorted(map(tuple, table.read().collect())) == [(1, "b", 2), (2, "d", 5), (3, "e", 1)]
    before = table.versions()
    table.apply(table.read(), table.manifest()["epoch"], "n")
    assert table.versions() == before
