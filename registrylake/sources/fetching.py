"""Fetch rules around an injected ``fetch``.

``fetch(url, headers) -> Response``; nothing here opens a connection, so that a test, a recorded table or a live client can stand
behind it. Waiting goes through ``sleep``, which is injected too. These run in one task for one chain or one
search; results are written as page tables, which the pipelines read as DataFrames.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import quote, urlencode

from pyspark.sql import DataFrame, SparkSession

from registrylake.sources.pages import page_wait, search_wait


@dataclass
class Response:
    """What a fetch gives; headers in lower case."""

    status: int
    body: str | None = None
    headers: dict = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return 200 <= self.status < 300

    def json(self):
        return json.loads(self.body)


Fetch = Callable[[str, dict], Response]


class FetchFailed(RuntimeError):
    """A fetch that had to succeed did not."""


def rows(spark: SparkSession, text: str, **params) -> DataFrame:
    """A query with named parameters, which are bound and never pasted into the text."""
    return spark.sql(text, args=params)


def get_json(fetch: Fetch, url: str, token: str | None = None, counter: list | None = None):
    """JSON of ``url``, with a bearer token if there is one; any status but a success raises. ``counter`` counts calls."""
    if counter is not None:
        counter.append(url)
    got = fetch(url, {"accept": "application/json", **({"authorization": f"Bearer {token}"} if token else {})})
    if not got.ok:
        raise FetchFailed(f"{url}: {got.status}")
    return got.json()


def json_or_none(fetch: Fetch, url: str):
    """NULL for any failure: status, body or exception."""
    try:
        got = fetch(url, {})
        return got.json() if got.ok else None
    except Exception:  # noqa: BLE001  unmeasured, whatever the reason
        return None


def page_with_retry(fetch: Fetch, url: str, retry_after_ms: Callable[[str | None], int | None], sleep: Callable[[float], None]) -> Response:
    """The same page again on 429 and only then, at most three times; the fourth 429 is returned."""
    attempt = 1
    while True:
        got = fetch(url, {})
        wait = page_wait(got.status, attempt, retry_after_ms(got.headers.get("retry-after")))
        if wait is None:
            return got
        sleep(wait)
        attempt += 1


def cursor_pages(fetch_page: Callable[[str], Response], base: str, params: dict, sleep: Callable[[float], None], pause: float = 0.25) -> Iterator[dict]:
    """S3: pages of a cursor chain, ``pause`` seconds apart, until one names no next cursor or one that was met before."""
    cursor, met = None, set()
    while True:
        got = fetch_page(f"{base}?{urlencode({**params, **({'cursor': cursor} if cursor else {})})}")
        if not got.ok:
            raise FetchFailed(f"{base}: {got.status}")
        page = got.json()
        yield page
        cursor = (page.get("metadata") or {}).get("nextCursor")
        if not cursor or cursor in met:
            return
        met.add(cursor)
        sleep(pause)


def search(fetch: Fetch, base: str, keyword: str, sleep: Callable[[float], None], window: int = 10_000, size: int = 250, attempts: int = 4) -> Iterator[dict]:
    """Pages of an offset search that end within the window; a short page is the last. Each page has ``attempts`` tries."""
    for offset in range(0, window - size + 1, size):
        url = f"{base}?text=keywords:{quote(keyword)}&size={size}&from={offset}"
        attempt = 1
        while True:
            got = fetch(url, {})
            if got.ok:
                break
            wait = search_wait(attempt, attempts)
            if wait is None:
                raise FetchFailed(f"{url}: {got.status}")
            sleep(wait)
            attempt += 1
        page = got.json()
        yield page
        if len(page.get("objects") or []) < size:
            return


def tree_of(get: Callable[[str], dict], base: str, ref: str, path: str) -> list:
    """The entries below ``path``: one tree after another down the segments, then the whole subtree; a truncated one is refused."""
    sha = ref
    for segment in filter(None, path.split("/")):
        entries = get(f"{base}/git/trees/{sha}").get("tree") or []
        sha = next((e["sha"] for e in entries if e.get("path") == segment and e.get("type") == "tree"), None)
        if sha is None:
            raise FetchFailed(f"{path}: no {segment}")
    whole = get(f"{base}/git/trees/{sha}?recursive=1")
    if whole.get("truncated"):
        raise FetchFailed(f"{path}: the listing is truncated")
    return whole.get("tree") or []


def in_order(items: list, work: Callable, workers: int = 6) -> list:
    """``work`` of every item, at most ``workers`` at a time, results in the order of the items; the first failure is raised."""
    if not items:
        return []
    with ThreadPoolExecutor(max_workers=min(workers, len(items))) as pool:
        return list(pool.map(work, items))


def chunks(items: list, size: int) -> Iterator[list]:
    """``items`` in lists of ``size``."""
    if size < 1:
        raise ValueError("a chunk holds at least one item")
    for at in range(0, len(items), size):
        yield items[at : at + size]


def error_text(error: BaseException) -> str:
    """name, message and what is known of an error, as JSON."""
    known = {k: getattr(error, k) for k in ("code", "errno", "status") if getattr(error, k, None) is not None}
    return json.dumps({"name": type(error).__name__, "message": str(error), **known}, sort_keys=True, default=str)
