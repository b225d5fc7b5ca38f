"""Scalar functions of records: versions, counts, kinds, names, modes, event types, ages."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from registrylake.functions.urlhost import host  # noqa: F401  F34, beside the other text functions

INSTALL_FLOOR, TOOL_RATIO, EVENT_CAP = 100, 0.5, 100


#: White space and line ends as ECMAScript trims them.
WHITE = "\t\n\x0b\x0c\r \xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE))


def semver(version: Column) -> Column:
    """(major, minor, patch) of an anchored prefix, one leading v allowed, else zeros; structs compare as versions do."""
    part = lambda i: F.coalesce(F.regexp_extract(version, r"^v?(\d+)\.(\d+)\.(\d+)", i).try_cast("long"), F.lit(0).cast("long"))
    return F.struct(part(1).alias("major"), part(2).alias("minor"), part(3).alias("patch"))


def parsed_count(raw: Column) -> Column:
    """a number, or text with thousands separators; blank text is 0 (R14), junk is NULL."""
    text = trimmed(F.replace(raw.cast("string"), F.lit(","), F.lit("")))
    return F.when(text == "", F.lit(0.0)).when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))


def artifact_type(has_executables: Column, installs: Column, on_request: Column) -> Column:
    """struct (artifact_type, classification_basis)."""
    basis = F.when(~F.coalesce(has_executables, F.lit(False)), "no-executables").when(F.coalesce((installs >= INSTALL_FLOOR) & on_request.isNotNull(), F.lit(False)), "on-request-ratio").otherwise("unmatched-default")
    tool = (basis == "on-request-ratio") & (on_request / F.nullif(installs, F.lit(0)) >= TOOL_RATIO)
    return F.struct(F.when(F.coalesce(tool, F.lit(False)), "tool").otherwise("library").alias("artifact_type"), basis.alias("classification_basis"))


def artifact_status(disabled: Column, deprecated: Column) -> Column:
    """F16: disabled before deprecated before active."""
    return F.when(F.coalesce(disabled, F.lit(False)), "disabled").when(F.coalesce(deprecated, F.lit(False)), "deprecated").otherwise("active")


def has_caveats(caveats: Column) -> Column:
    """F17."""
    return F.coalesce(trimmed(caveats) != "", F.lit(False))


def provider_type(segment: Column, internal: list, protocol: list) -> Column:
    """membership of the lower-cased segment in two sets, which the caller gives for its source."""
    key = F.lower(segment)
    return F.when(key.isin(internal), "platform_internal").when(key.isin(protocol), "protocol").otherwise("vendor")


def title_of_slug(slug: Column) -> Column:
    """dashes and underscores to spaces; a letter that follows no word character in upper case, the rest untouched."""
    words = F.split(F.regexp_replace(slug, "[_-]+", " "), r"(?<=\W)(?=\w)|(?<=\w)(?=\W)")
    first = lambda w: F.when(w.rlike(r"^[a-z]"), F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 2147483647))).otherwise(w)
    return F.array_join(F.transform(words, first), "")


def source_dir(path: Column) -> Column:
    """directory below ``sources``; NULL for others and for ``common``."""
    found = F.regexp_extract(path, r"^sources/([^/]+)/", 1)
    return F.when(~found.isin("", "common"), found)


def source_mode(key: Column) -> Column:
    """F21 of one source directory."""
    return F.when(key.contains("instant"), "instant").otherwise("poll")


def trigger_mode(text: Column) -> Column:
    """what a trigger file says; unreadable ones say nothing."""
    return F.when(text.rlike(r"webhooks\s*[:=]\s*\["), "instant").when(text.rlike(r"polling:\s*true"), "poll").otherwise("unclassified")


def event_values(text: Column) -> Column:
    """quoted literals of ``value:``, distinct, the first hundred."""
    found = F.regexp_extract_all(text, F.lit(r"""value:\s*["'`]([^"'`\n]{1,80})["'`]"""), F.lit(1))
    return F.slice(F.array_distinct(found), 1, EVENT_CAP)


def scope_of(name: Column, scope: Column) -> Column:
    """the scope unless ``unscoped``, else the name's own prefix; NULL if neither."""
    return F.coalesce(F.when(~scope.isin("unscoped", ""), scope), F.nullif(F.regexp_extract(name, r"^@([^/]+)/", 1), F.lit("")))


def age_hours(newest: Column, now: Column) -> Column:
    """hours since the newest row; without one, since the epoch."""
    return (F.unix_micros(now) - F.coalesce(F.unix_micros(newest), F.lit(0))) / F.lit(3.6e9)


# Suffixes of tunnel hosts.
TUNNEL_SUFFIXES = ["trycloudflare.com", "ngrok.io", "ngrok-free.app", "ngrok.app", "ngrok.dev", "loca.lt", "serveo.net", "localhost.run"]


def tunnel_suffix(host_: Column, suffixes: list | None = None) -> Column:
    """the first suffix that the host equals or ends with behind a dot."""
    return F.coalesce(*[F.when((host_ == s) | host_.endswith(f".{s}"), s) for s in suffixes or TUNNEL_SUFFIXES])


def parse_limit(raw: str | None, fallback: int | None) -> int | None:
    """Unset or blank gives the fallback, a positive whole number (also ``1e3``) itself, anything else is refused."""
    if raw is None or not raw.strip():
        return fallback
    text = raw.strip()
    if not re.fullmatch(r"[+]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", text) or float(text) != int(float(text)) or float(text) < 1:
        raise ValueError(f"not a positive whole number: {raw!r}")
    return int(float(text))
