"""Outcome classification of recorded responses.

Every function maps columns of a recorded response to a column of a closed vocabulary. The order of the
branches is the order of precedence. The two exception classifiers, session rules and error readers differ
on purpose and are kept apart (R2, R3, R4).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from registrylake.functions.urlhost import host

from registrylake.functions.text import trimmed

# Transport classes, and codes that point at each.
ERROR_CLASSES = ["dns_failure", "connection_refused", "timeout", "tls_error", "rate_limited", "http_error", "ok", "template_placeholder", "other"]
DISCOVER_STATUSES = ["ok", "unsupported", "error", "session_required", "not_attempted"]
CAPTURE_STATUSES = [*DISCOVER_STATUSES, "excluded"]
TIMEOUT_NAMES = ["TimeoutError", "AbortError"]
TIMEOUT_CODES = ["ETIMEDOUT", "UND_ERR_CONNECT_TIMEOUT", "UND_ERR_HEADERS_TIMEOUT"]
BODY_TIMEOUT_CODES = ["UND_ERR_BODY_TIMEOUT"]
DNS_CODES = ["ENOTFOUND", "EAI_AGAIN"]
RESET_CODES = ["ECONNRESET", "EPIPE", "UND_ERR_SOCKET"]
TLS_HINTS = ["ERR_TLS", "ERR_SSL", "UNABLE_TO_VERIFY", "CERT_", "DEPTH_ZERO_SELF_SIGNED", "SELF_SIGNED_CERT", "HOSTNAME_MISMATCH", "ERR_OSSL"]
VERSION_PATHS = ["supportedVersions", "protocolVersions", "protocol_versions", "supportedProtocolVersions", "supported_protocol_versions", "versions", "_meta.protocolVersions", "protocolVersion", "_meta.protocolVersion"]
HEADER_ALLOWLIST = ["server", "www-authenticate", "x-accel-buffering", "mcp-protocol-version", "mcp-session-id"]
METHOD_NOT_FOUND, MAX_VERSIONS, MAX_RAW_BYTES, NOTE_CHARS, HEADER_CHARS = -32601, 64, 65536, 400, 256
VERSION_LIST = r"(?i)\bsupported\s+versions?\b\s*:\s*([^)\]}\n]+)"


def raw_error(code: Column, message: Column) -> Column:
    return trimmed(F.concat(F.coalesce(code, F.lit("")), F.lit(" "), F.coalesce(message, F.lit(""))))


def exception_class(name: Column, code: Column, message: Column, head_probe: bool = False) -> Column:
    """F29; with ``head_probe`` F29b, which knows neither resets nor body timeouts."""
    code = F.coalesce(code, F.lit(""))
    timeout = F.coalesce(name.isin(TIMEOUT_NAMES), F.lit(False)) | code.isin(TIMEOUT_CODES if head_probe else TIMEOUT_CODES + BODY_TIMEOUT_CODES)
    refused = code.isin(["ECONNREFUSED"] if head_probe else ["ECONNREFUSED", *RESET_CODES])
    hinted = raw_error(code, message).rlike("(?i)certificate|tls|ssl")
    for hint in TLS_HINTS:
        hinted = hinted | code.contains(hint)
    return F.when(timeout, "timeout").when(code.isin(DNS_CODES), "dns_failure").when(refused, "connection_refused").when(hinted, "tls_error").otherwise("other")


def status_class(http_status: Column) -> Column:
    """a response that arrived."""
    return F.when(http_status == 429, "rate_limited").when(http_status >= 400, "http_error").otherwise("ok")


def retry_after_ms(raw: Column, now: Column) -> Column:
    """whole seconds or an HTTP date; NULL for anything else."""
    text = trimmed(raw)
    at = F.try_to_timestamp(F.regexp_replace(text, r"^[A-Za-z]{3}, (.*) GMT$", "$1"), F.lit("dd MMM yyyy HH:mm:ss"))
    late = F.greatest(F.lit(0).cast("long"), (F.unix_micros(at) - F.unix_micros(now)) / F.lit(1000)).cast("long")
    return F.when(text.rlike(r"^\d+$"), text.try_cast("long") * 1000).when(at.isNotNull(), late)


def page_retry_after_ms(raw: Column) -> Column:
    """The page reader's own rule: any number of seconds, also fractions, rounded up; blank is 0."""
    number = F.when(trimmed(raw) == "", F.lit(0.0)).when(trimmed(raw).rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), trimmed(raw).try_cast("double"))
    return F.when(number >= 0, F.ceil(number * 1000).cast("long"))


def tls_valid(url: Column, error_class: Column, arrived: Column) -> Column:
    """true for an https response, false for a TLS error, else unknown."""
    return F.when(error_class == "tls_error", F.lit(False)).when(arrived & F.lower(url).startswith("https:"), F.lit(True))


def not_attempted_reason(url: Column, templates: bool = True) -> Column:
    """P14, P14b (``templates``) and P14c: why no request is made, in order; NULL if one is."""
    scheme = F.lower(F.regexp_extract(url, r"^\s*([A-Za-z][A-Za-z0-9+.\-]*):", 1))
    reason = F.when(F.lit(templates) & url.rlike(r"\{[^}]*\}"), "template_placeholder")
    return reason.when(host(url).isNull(), "invalid_url").when(~scheme.isin("http", "https"), "scheme")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once; a plain reuse of a column repeats its work in every branch."""
    return F.get(F.transform(F.array(value), use), 0)


def _kind(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value), F.lit("ABSENT"))


def _part(parsed: Column, path: str) -> Column:
    return F.try_variant_get(parsed, path, "variant")


def _text(parsed: Column, path: str) -> Column:
    return let(_part(parsed, path), lambda v: F.when(_kind(v) == "STRING", F.try_variant_get(v, "$", "string")))


def _message(parsed: Column, listing: bool = False) -> Column:
    nested = _text(parsed, "$.error.message")
    return F.coalesce(nested, F.lit("")) if listing else F.coalesce(_text(parsed, "$.error"), nested, _text(parsed, "$.message"), F.lit(""))


def error_message(body: Column, listing: bool = False) -> Column:
    """a bare string error, error.message or message; F24b (``listing``): error.message alone; else empty."""
    return let(F.try_parse_json(body), lambda v: _message(v, listing))


def demands_session(message: Column, listing: bool = False) -> Column:
    """F25, and F25b for listings."""
    if listing:
        return message.rlike("(?i)session") & message.rlike("(?i)required|missing|invalid|expired|initiali")
    return message.rlike(r"(?i)session[\s_-]?id")


def rejection_versions(message: Column) -> Column:
    """versions that a rejection names, verbatim, at most 64; empty if none."""
    found = F.regexp_extract(message, VERSION_LIST, 1)
    parts = F.transform(F.split(found, "[,;]"), lambda t: trimmed(F.regexp_replace(trimmed(t), r"[.)\]}]+$", "")))
    return F.slice(F.filter(parts, lambda t: t != ""), 1, MAX_VERSIONS)


def _advertised(parsed: Column, root: str) -> Column:
    def at(path: str) -> Column:
        made = lambda v: F.struct(F.slice(v, 1, MAX_VERSIONS).alias("versions"), F.lit(path).alias("via"), (F.size(v) > MAX_VERSIONS).alias("capped"))
        strings = lambda v: F.transform(F.filter(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.schema_of_variant(x) == "STRING"), lambda x: F.try_variant_get(x, "$", "string"))
        many = lambda v: let(strings(v), lambda s: F.when(F.size(s) > 0, made(s)))
        return let(_part(parsed, f"{root}.{path}"), lambda v: F.when(_kind(v) == "STRING", made(F.array(F.try_variant_get(v, "$", "string")))).when(_kind(v).startswith("ARRAY"), many(v)))

    return F.coalesce(*map(at, VERSION_PATHS))


def advertised_versions(body: Column, root: str = "$.result") -> Column:
    """struct of the versions and the first of nine paths that holds a string or an array with strings."""
    return let(F.try_parse_json(body), lambda v: _advertised(v, root))


def envelope(body: Column, content_type: Column) -> Column:
    """The JSON of a body, or of the first ``data:`` line of an event stream that holds something; NULL if none."""
    frames = F.transform(F.filter(F.split(body, "\r?\n"), lambda x: x.startswith("data:")), lambda x: trimmed(F.substring(x, 6, 2147483647)))
    full = F.filter(frames, lambda x: F.try_parse_json(x).isNotNull() & ~x.isin("null", "false", "0", '""', "-0", "0.0"))
    stream = F.coalesce(F.lower(content_type).contains("text/event-stream"), F.lit(False))
    return F.when(stream, F.get(full, 0)).when(F.try_parse_json(body).isNotNull(), body)


def discover_outcome(http_status: Column, body: Column, content_type: Column) -> Column:
    """Struct (status, versions, source) of a response that is not 429 and whose body was read."""
    made = lambda status, versions, source: F.struct(status.alias("status"), versions.cast("array<string>").alias("versions"), source.cast("string").alias("source"))
    null = F.lit(None)

    def rejected(v: Column, message: Column) -> Column:
        code = F.try_variant_get(v, "$.error.code", "long")
        refused = F.when((message != "") & demands_session(message), "session_required").when((code == METHOD_NOT_FOUND) | ((http_status >= 400) & http_status.isin(405, 501)), "unsupported").otherwise("error")
        return let(rejection_versions(message), lambda told: made(refused, F.when(F.size(told) > 0, told), F.when(F.size(told) > 0, F.lit("rejection"))))

    def answered(env: Column, v: Column) -> Column:
        fine = let(_advertised(v, "$.result"), lambda f: made(F.lit("ok"), F.coalesce(f["versions"], F.array().cast("array<string>")), F.when(f.isNotNull(), F.lit("advertised"))))
        return F.when(F.coalesce(F.array_contains(F.json_object_keys(env), "result"), F.lit(False)), fine).otherwise(made(F.lit("error"), null, null))

    def outcome(env: Column, v: Column) -> Column:
        error = F.get_json_object(env, "$.error")
        failed = (http_status >= 400) | (error.isNotNull() & ~error.isin("", "false", "0"))
        refused = let(_message(v), lambda m: rejected(v, m))
        return F.when((http_status < 400) & env.isNull(), made(F.lit("error"), null, null)).when(failed, refused).otherwise(answered(env, v))

    return let(envelope(body, content_type), lambda env: let(F.try_parse_json(env), lambda v: outcome(env, v)))


def listing_outcome(http_status: Column, env: Column, result_key: str) -> Column:
    """status of one page of a listing; note that a 2xx puts unsupported before session_required."""

    def outcome(v: Column, message: Column) -> Column:
        session = (message != "") & demands_session(message, listing=True)
        missing = F.coalesce(F.try_variant_get(v, "$.error.code", "long") == METHOD_NOT_FOUND, F.lit(False))
        failed = F.when(session, "session_required").when(http_status.isin(405, 501) | missing, "unsupported").otherwise("error")
        listed = _kind(_part(v, f"$.result.{result_key}")).startswith("ARRAY")
        return F.when(http_status == 429, "error").when(http_status >= 400, failed).when(listed, "ok").when(missing, "unsupported").when(session, "session_required").otherwise("error")

    return let(F.try_parse_json(env), lambda v: let(_message(v, listing=True), lambda m: outcome(v, m)))


def reach_outcome(hops: Column, max_redirects: int = 2) -> Column:
    """Struct of the outcome of a chain of hops (http_status, location); the first hop that ends it decides."""
    redirect = lambda h: (h["http_status"] >= 300) & (h["http_status"] < 400) & (F.coalesce(h["location"], F.lit("")) != "")
    numbered = F.transform(F.slice(hops, 1, max_redirects + 1), lambda h, i: F.struct(h["http_status"].alias("http_status"), h["location"].alias("location"), redirect(h).alias("redirect"), i.alias("hop")))
    ending = F.filter(numbered, lambda h: ~h["redirect"] | (h["hop"] == max_redirects))
    last = F.get(ending, 0)
    targets = F.filter(F.transform(numbered, lambda h: F.when(h["redirect"] & (h["hop"] <= last["hop"]), h["location"])), lambda x: x.isNotNull())
    note = F.when(last["redirect"], F.lit(f"redirect budget ({max_redirects}) exhausted"))
    return F.struct(last["http_status"].alias("http_status"), F.when(last["redirect"], F.lit("ok")).otherwise(status_class(last["http_status"])).alias("error_class"), F.get(targets, F.size(targets) - 1).alias("redirect_target"), note.alias("note"))


def assembled_note(*fragments: Column) -> Column:
    """fragments that are there, joined, at most 400 characters; NULL for none."""
    return F.nullif(F.substring(F.concat_ws("; ", *fragments), 1, NOTE_CHARS), F.lit(""))


def bounded_raw(text: Column, cap: int = MAX_RAW_BYTES, size: Column | None = None) -> Column:
    """the text up to ``cap`` bytes, beyond it a marker that says what was left out.

    ``size`` is the text's bytes where they are known without it, NULL where there is no text; a text beyond the cap is then never made.
    """
    size = F.octet_length(text) if size is None else size
    marker = F.to_json(F.struct(F.lit("result exceeded MAX_RAW_BYTES").alias("_omitted"), size.alias("bytes"), F.lit(cap).alias("cap")))
    return F.when(size <= cap, text).when(size.isNotNull(), marker)


def allowed_headers(headers: Column) -> Column:
    """Five headers, their values cut at 256 characters; NULL when none is there."""
    low = F.transform_keys(headers, lambda k, _: F.lower(k))
    kept = F.transform_values(F.map_filter(low, lambda k, v: k.isin(HEADER_ALLOWLIST) & v.isNotNull()), lambda _, v: F.substring(v, 1, HEADER_CHARS))
    return F.when(F.size(kept) > 0, kept)
