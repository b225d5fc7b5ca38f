import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from registrylake.functions import classify as C
from registrylake.functions import jsonhash as J
from registrylake.functions import text as X
from registrylake.operators import pacing


def one(spark, column, **values):
    kinds = ", ".join(f"{k} {v[0]}" for k, v in values.items())
    frame = spark.createDataFrame([tuple(v[1] for v in values.values())], kinds) if values else spark.range(1)
    return frame.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("value, shown", [(1.0, "1"), (1e2, "100"), (1e21, "1e+21"), (-0.0, "0"), (0.1, "0.1"), (1e-7, "1e-7"), (1e-6, "0.000001"), (12345678901234567890123, "1.2345678901234568e+22"), (5e-324, "5e-324"), (float("inf"), "null")])
def test_numbers_print_as_in_ecmascript(value, shown):
    assert J.js_number(value) == shown


@settings(max_examples=200, deadline=None)
@given(st.floats(allow_nan=False, allow_infinity=False))
def test_numbers_survive(value):
    assert float(J.js_number(value)) == value


def test_canonical_order_and_duplicates():
    text = '{"b":1,"10":2,"9":3,"\U0001f600":1,"￿":2,"b":4}'
    assert J.stringify(J.canonical(J.parsed(text)[1])) == '{"9":3,"10":2,"b":4,"\U0001f600":1,"￿":2}'


BASE = {"type": "object", "properties": {"a": {"type": "string"}, "b": {"type": "integer", "enum": [2, 1]}}, "required": ["a", "b"]}


def variant(change):
    copy = json.loads(json.dumps(BASE))
    change(copy)
    return copy


PAIRS = [  # change, same schema hash, same contract hash
    (lambda s: s.update(required=["b", "a"]), True, True),
    (lambda s: s["properties"]["b"].update(enum=[1, 2]), True, True),
    (lambda s: s.update(properties=dict(reversed(s["properties"].items()))), True, True),
    (lambda s: s["properties"]["a"].update(description="x"), False, True),
    (lambda s: s.update(title="x"), False, True),
    (lambda s: s["properties"]["a"].update({"x-header": "x"}), False, False),
    (lambda s: s.update(required=["a"]), False, False),
    (lambda s: s["properties"]["a"].update(type="number"), False, False),
    (lambda s: s["properties"].update(c={}), False, False),
    (lambda s: s["properties"].update(title={"type": "string"}), False, True),  # R1: a property named like an annotation
    (lambda s: s.update(prefixItems=[1, 2]), False, False),
]


@pytest.mark.parametrize("change, same_schema, same_contract", PAIRS)
def test_schema_and_contract_hashes(spark, change, same_schema, same_contract):
    rows = [(json.dumps(BASE), json.dumps(variant(change)))]
    r = spark.createDataFrame(rows, "a string, b string").select((J.schema_hash(F.col("a")) == J.schema_hash(F.col("b"))).alias("s"), (J.contract_hash(F.col("a")) == J.contract_hash(F.col("b"))).alias("c")).first()
    assert (r.s, r.c) == (same_schema, same_contract)


def test_item_order_of_prefix_items_matters():
    a, b = ({"prefixItems": x} for x in ([1, 2], [2, 1]))
    assert J.stringify(J.canonical(a, True)) != J.stringify(J.canonical(b, True))


def test_features(spark):
    text = json.dumps({"properties": {"b": {"type": ["string", "null"]}, "a": {"properties": {"x": {"$ref": "#/$defs/q"}}}, "c": {"anyOf": [{"type": "string"}, {"type": "null"}]}}, "required": ["b", 3], "$defs": {}})
    t = F.col("t")
    r = spark.createDataFrame([(text,), (None,), ("[1",)], "t string").select(J.param_set(t).alias("p"), J.param_count(t).alias("n"), J.required_count(t).alias("r"), J.max_depth(t).alias("d"), J.false_drift(t).alias("f"), J.canonical_json(t).alias("c")).collect()
    assert [tuple(p) for p in r[0].p] == [("a", None, False), ("b", "null|string", True), ("c", None, False)]
    assert (r[0].n, r[0].r, r[0].d, tuple(r[0].f)) == (3, 1, 5, (True, True, True, True))
    assert r[1].p is None and r[1].c is None and r[2].c is None


def test_null_hashes_its_four_letters(spark):
    assert one(spark, J.hash_canonical(F.lit("null"))) == hashlib.sha256(b"null").hexdigest()


@pytest.mark.parametrize("message, versions", [("Unsupported protocol version X", []), ("unrelated", []), ("Supported versions: 2024-11-05, 2025-03-26.", ["2024-11-05", "2025-03-26"]), ("bad (supported version: a; b ) more", ["a", "b"]), ("SUPPORTED VERSIONS : DRAFT-2099", ["DRAFT-2099"])])
def test_rejections(spark, message, versions):
    assert one(spark, C.rejection_versions(F.lit(message))) == versions


@pytest.mark.parametrize("http, body, ctype, status, versions, source", [
    (400, '{"error":{"code":-32000,"message":"Bad Request: Session-Id missing; supported versions: a, b"}}', "application/json", "session_required", ["a", "b"], "rejection"),
    (400, '{"error":"supported versions: 1"}', "application/json", "error", ["1"], "rejection"),
    (404, "not json", "text/html", "error", None, None), (405, "", None, "unsupported", None, None),
    (200, '{"error":{"code":-32601,"message":"x"}}', "application/json", "unsupported", None, None),
    (200, '{"error":null,"result":null}', "application/json", "ok", [], None),
    (200, '{"jsonrpc":"2.0"}', "application/json", "error", None, None),
    (200, '{"result":{"supportedVersions":[],"versions":[1,"v2"]}}', "application/json", "ok", ["v2"], "advertised"),
    (200, 'data: {"cut\ndata: {"result":{"_meta":{"protocolVersion":"p"}}}\n', "text/event-stream", "ok", ["p"], "advertised"),
    (200, "garbage", "application/json", "error", None, None),
])
def test_discover_outcomes(spark, http, body, ctype, status, versions, source):
    r = one(spark, C.discover_outcome(F.col("h"), F.col("b"), F.col("c")), h=("int", http), b=("string", body), c=("string", ctype))
    assert (r.status, r.versions, r.source) == (status, versions, source)


@pytest.mark.parametrize("http, body, status", [
    (400, '{"error":{"message":"Session required: call initialize first","code":-32601}}', "session_required"), (200, '{"error":{"message":"Session required","code":-32601}}', "unsupported"),
    (200, '{"result":{"resources":[]}}', "ok"), (200, '{"result":{"resources":{}}}', "error"), (501, None, "unsupported"), (500, "x", "error"), (429, None, "error"), (200, '{"error":{"message":"session expired"}}', "session_required"), (400, '{"error":{"message":"session id"}}', "error"),
])
def test_listing_outcomes(spark, http, body, status):
    assert one(spark, C.listing_outcome(F.col("h"), F.col("b"), "resources"), h=("int", http), b=("string", body)) == status


def test_the_two_session_rules_differ(spark):
    say = "Session required: call initialize first"
    assert one(spark, C.demands_session(F.lit(say), True)) and not one(spark, C.demands_session(F.lit(say)))
    assert one(spark, C.demands_session(F.lit("no sessionId"))) and not one(spark, C.demands_session(F.lit("no sessionId"), True))


@pytest.mark.parametrize("name, code, message, cls, head", [("AbortError", None, None, "timeout", "timeout"), ("TypeError", "UND_ERR_BODY_TIMEOUT", None, "timeout", "other"), (None, "ENOTFOUND", None, "dns_failure", "dns_failure"), (None, "EPIPE", "x", "connection_refused", "other"), (None, "CERT_HAS_EXPIRED", None, "tls_error", "tls_error"), (None, None, "SSL alert", "tls_error", "tls_error"), (None, None, None, "other", "other")])
def test_exceptions(spark, name, code, message, cls, head):
    args = {"n": ("string", name), "c": ("string", code), "m": ("string", message)}
    cols = F.col("n"), F.col("c"), F.col("m")
    assert one(spark, C.exception_class(*cols), **args) == cls and one(spark, C.exception_class(*cols, True), **args) == head


@pytest.mark.parametrize("raw, ms, page_ms", [("10", 10_000, 10_000), ("Mon, 01 Jan 2024 01:00:00 GMT", 3_600_000, None), ("Sun, 31 Dec 2023 01:00:00 GMT", 0, None), ("junk", None, None), ("1.5", None, 1500), ("", None, 0), (None, None, None), ("-1", None, None)])
def test_retry_after(spark, raw, ms, page_ms):
    now = F.lit("2024-01-01").cast("timestamp")
    assert one(spark, C.retry_after_ms(F.col("r"), now), r=("string", raw)) == ms
    assert one(spark, C.page_retry_after_ms(F.col("r")), r=("string", raw)) == page_ms


@pytest.mark.parametrize("raw, n", [("1,234", 1234.0), ("", 0.0), (" 12 ", 12.0), ("1d", None), ("0x10", None), ("junk", None), (None, None), ("1e3", 1000.0)])
def test_counts(spark, raw, n):
    assert one(spark, X.parsed_count(F.col("r")), r=("string", raw)) == n


@pytest.mark.parametrize("exe, installs, req, want", [(False, 500.0, 500.0, ("library", "no-executables")), (True, 100.0, 50.0, ("tool", "on-request-ratio")), (True, 99.0, 99.0, ("library", "unmatched-default")), (True, 100.0, 49.0, ("library", "on-request-ratio")), (True, None, 5.0, ("library", "unmatched-default")), (True, 200.0, None, ("library", "unmatched-default"))])
def test_artifact_types(spark, exe, installs, req, want):
    assert tuple(one(spark, X.artifact_type(F.col("e"), F.col("i"), F.col("q")), e=("boolean", exe), i=("double", installs), q=("double", req))) == want


@pytest.mark.parametrize("slug, title", [("foo-bar_baz qux", "Foo Bar Baz Qux"), ("aBC--9x", "ABC 9x"), ("x.y", "X.Y")])
def test_titles(spark, slug, title):
    assert one(spark, X.title_of_slug(F.lit(slug))) == title


@pytest.mark.parametrize("url, host", [("HTTPS://User@Ex_Ample.COM:80/x", "ex_ample.com"), ("http://[::1]:8/", "[::1]"), ("http://{h}.x/", "{h}.x"), ("no url", None), ("ftp://h?x", "h"), ("mailto:a@b", "")])
def test_hosts(spark, url, host):
    assert one(spark, X.host(F.lit(url))) == host


@pytest.mark.parametrize("host, suffix", [("a.ngrok.io", "ngrok.io"), ("ngrok.io", "ngrok.io"), ("xngrok.io", None), ("a.b.loca.lt", "loca.lt")])
def test_tunnels(spark, host, suffix):
    assert one(spark, X.tunnel_suffix(F.lit(host))) == suffix


def test_semver_order(spark):
    less = X.semver(F.lit("v1.9.0-rc")) < X.semver(F.lit("1.10.0"))
    assert one(spark, less) and tuple(one(spark, X.semver(F.lit("vv1.2.3")))) == (0, 0, 0)


@pytest.mark.parametrize("raw, want", [(None, 7), ("", 7), ("  ", 7), ("10", 10), ("1e3", 1000)])
def test_limits(raw, want):
    assert X.parse_limit(raw, 7) == want


@pytest.mark.parametrize("raw", ["1 0", "ten", "0", "-1", "1.5"])
def test_limits_refuse(raw):
    with pytest.raises(ValueError):
        X.parse_limit(raw, 7)


def test_fold_equals_simulator_on_one_host(spark):
    script = ["429", "429", "ok", "ok", "429", "other", "ok"]
    left = list(script)
    run = pacing.simulate([("h", i) for i in range(5)], lambda h, e, a: (left.pop(0) if left else "ok", 1, None), only_ok_decays=True)
    done = script[: len(script) - len(left)]
    assert one(spark, pacing.gap_after(F.array(*map(F.lit, done)))) == run["gaps"]["h"]
    assert one(spark, pacing.gap_after(F.array(*map(F.lit, ["429", "429", "ok", "ok", "429"])))) == 6144


def test_sweep_isolates_hosts_and_counts_what_is_left():
    slow = lambda h, e, a: ("429" if h == "bad" else "ok", 10, 2000)
    run = pacing.simulate([("bad", i) for i in range(3)] + [("good", i) for i in range(3)], slow)
    assert sorted(run["rows"])[:1][0][2] == 2 and run["n_429"] == 6 and run["gaps"]["good"] == 150
    assert all(r[2] == 1 for r in run["rows"] if r[0] == "good")
    cut = pacing.simulate([("bad", i) for i in range(50)], slow, deadline=5000)
    assert cut["undispatched"] > 0 and cut["undispatched"] + len(cut["rows"]) == 50
