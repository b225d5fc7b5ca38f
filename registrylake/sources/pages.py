"""Sources: recorded page files, a paged Python data source, retry schedules."""

from __future__ import annotations

import json
import operator
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

PAGE = "chain string, page_no int, body string"
ITEM = "chain string, page_no int, pos int, updated_at string, item string"
RECORDED = "run_id string, server_id string, endpoint_url string, attempt int, page_no int, method string, http_status int, content_type string, headers map<string,string>, body string, elapsed_ms long, exc_name string, exc_code string, exc_message string, exc_stage string"
PAGE_WAITS = [5.0, 15.0, 45.0]


def required(path: str | None, name: str) -> str:
    """An unset place of a store is refused."""
    if not path:
        raise ValueError(f"{name} is not set")
    return path


def page_wait(status: int, attempt: int, retry_after_ms: int | None) -> float | None:
    """Seconds before the same page is asked again; NULL gives up. Only 429 is retried, at most three times."""
    if status != 429 or attempt > len(PAGE_WAITS):
        return None
    return retry_after_ms / 1000 if retry_after_ms is not None else PAGE_WAITS[attempt - 1]


def search_wait(attempt: int, attempts: int = 4) -> float | None:
    """Backoff of the offset search, 1.5 s doubled each time."""
    return 1.5 * 2 ** (attempt - 1) if attempt < attempts else None


def offsets(window: int = 10_000, size: int = 250) -> list:
    """Offsets whose pages end within the window."""
    return list(range(0, window - size + 1, size))


def recorded(spark: SparkSession, path: str) -> DataFrame:
    """Recorded responses with their schema; never inferred, since a column may be all NULL on a day."""
    return spark.read.schema(RECORDED).json(required(path, "the path of recorded responses"))


def last_attempt(rows: DataFrame) -> DataFrame:
    """The last attempt of each endpoint's page."""
    keys = ["run_id", "endpoint_url", "page_no"]
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "attempt").alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def bounded_body(body, cap: int):
    """The first ``cap`` bytes; a character that the cut splits is dropped. A character has at most four bytes."""
    cut = lambda n: F.try_validate_utf8(F.substring(body.cast("binary"), 1, max(n, 0)).cast("string"))
    return F.when(F.octet_length(body) <= cap, body).otherwise(F.coalesce(*[cut(cap - i) for i in range(4)]))


def _store(path: str):
    """The file system and the path in it: of a store that driver and executors share, or of the local machine."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


class _Chain(InputPartition):
    def __init__(self, name: str, start: int = 0, end: int = 0):
        self.name, self.start, self.end = name, start, end


class _Pages:
    """Folders of page files, one for each chain: ``<chain>/<cursor>.json``, from ``first.json`` on."""

    def __init__(self, options: dict):
        self.path, self.limit = options["path"], int(options["maxPages"]) if options.get("maxPages") else None
        self.since, self.chains = options.get("updatedSince"), None

    @property
    def folder(self) -> str:
        return _store(self.path)[1].rstrip("/")

    @property
    def files(self):
        return _store(self.path)[0]

    def names(self) -> list[str]:
        from pyarrow import fs

        found = self.files.get_file_info(fs.FileSelector(self.folder, allow_not_found=True))
        return sorted(i.base_name for i in found if i.type == fs.FileType.Directory and (self.chains is None or i.base_name in self.chains))

    def has(self, chain: str, cursor: str) -> bool:
        from pyarrow import fs

        return self.files.get_file_info(f"{self.folder}/{chain}/{cursor}.json").type == fs.FileType.File

    def page(self, chain: str, cursor: str) -> dict:
        with self.files.open_input_stream(f"{self.folder}/{chain}/{cursor}.json") as f:
            return json.loads(f.read().decode("utf-8"))

    def follow(self, chain: str):
        """The pages of one chain with their numbers: a page names the next one's cursor; a cursor seen before ends it.

        There is no limit unless ``maxPages`` asks for one; a chain that it cuts says so in its last page (``truncated``).
        """
        cursor, seen, number = "first", set(), 0
        while cursor and cursor not in seen:
            seen.add(cursor)
            page = self.page(chain, cursor)
            following = (page.get("metadata") or {}).get("nextCursor")
            last = self.limit is not None and number + 1 >= self.limit
            if last and following:
                page["truncated"] = True
            yield number, page
            number += 1
            cursor = None if last else following


class _Reader(_Pages, DataSourceReader):
    def partitions(self):
        return [_Chain(n) for n in self.names()]

    def read(self, partition):
        if partition is None:  # a folder without chains
            return
        for number, page in self.follow(partition.name):
            if self.since:
                page["servers"] = [s for s in page.get("servers", []) if str(s.get("updatedAt", "")) >= self.since]
            yield partition.name, number, json.dumps(page, ensure_ascii=False)


def items_of(chain: str, number: int, page: dict):
    """The rows of a page: one for each listed server."""
    for pos, item in enumerate(page.get("servers") or []):
        at = item.get("updatedAt") if isinstance(item, dict) else None
        yield chain, number, pos, at if isinstance(at, str) else None, json.dumps(item, ensure_ascii=False)


class _ItemReader(_Pages, DataSourceReader):
    """Rows of servers; what is asked of ``chain`` cuts the chains that are opened, what is asked of ``updated_at`` the rows that leave a page."""

    def __init__(self, options: dict):
        super().__init__(options)
        self.tests: list = []

    def pushFilters(self, filters):
        for f in filters:
            column, value = getattr(f, "attribute", (None,))[0], getattr(f, "value", None)
            if column == "chain" and isinstance(f, (EqualTo, In)):
                asked = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.chains = asked if self.chains is None else self.chains & asked
            elif column == "updated_at" and isinstance(value, str) and type(f) in _TESTS:
                self.tests.append((_TESTS[type(f)], value))
            else:
                yield f

    def partitions(self):
        return [_Chain(n) for n in self.names()]

    def read(self, partition):
        if partition is None:  # a folder without chains
            return
        for number, page in self.follow(partition.name):
            for row in items_of(partition.name, number, page):
                # As in SQL, a comparison with a missing time holds for none; texts compare by their UTF-8 bytes.
                if all(row[3] is not None and test(row[3].encode(), value.encode()) for test, value in self.tests) and (not self.since or (row[3] or "") >= self.since):
                    yield row


_TESTS = {EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le}


class _ItemStream(_Pages, DataSourceStreamReader):
    """X11: new pages of every chain as micro-batches. An offset is a number of steps; in a step each chain goes on by up to ``pagesPerStep`` pages.

    How far a chain had come after a step is a small file in the folder ``progress``, which tasks write before Spark commits the step.
    A step that is run again begins where the step before it ended, so it reads the same pages; a restart goes on from the newest step.
    A chain waits at a cursor whose page is not there yet.
    """

    def __init__(self, options: dict):
        super().__init__(options)
        self.progress, self.per_step = options["progress"], int(options.get("pagesPerStep", 10))

    def _steps(self, chain: str) -> list[int]:
        from pyarrow import fs

        files, root = _store(self.progress)
        found = files.get_file_info(fs.FileSelector(f"{root}/{chain}", allow_not_found=True))
        return sorted(int(i.base_name[:-5]) for i in found if i.base_name.endswith(".json"))

    def _state(self, chain: str, step: int | None) -> dict:
        """Where a chain stands after the newest step up to ``step``: the next cursor (null at its end), the next number, cursors seen."""
        known = [s for s in self._steps(chain) if step is None or s <= step]
        if not known:
            return {"cursor": "first", "number": 0, "seen": []}
        files, root = _store(self.progress)
        with files.open_input_stream(f"{root}/{chain}/{known[-1]}.json") as f:
            return json.loads(f.read().decode())

    def _keep(self, chain: str, step: int, state: dict) -> None:
        files, root = _store(self.progress)
        files.create_dir(f"{root}/{chain}", recursive=True)
        made = f"{root}/{chain}/.{uuid.uuid4().hex}"
        with files.open_output_stream(made) as out:
            out.write(json.dumps(state).encode())
        files.move(made, f"{root}/{chain}/{step}.json")

    def initialOffset(self):
        return {"step": 0}

    def latestOffset(self):
        done = max((s for n in self.names() for s in self._steps(n)[-1:]), default=0)
        waiting = any((state := self._state(n, None))["cursor"] and self.has(n, state["cursor"]) for n in self.names())
        return {"step": done + 1 if waiting else done}

    def partitions(self, start, end):
        return [_Chain(n, start["step"], end["step"]) for n in self.names()]

    def read(self, partition):
        state, chain = self._state(partition.name, partition.start), partition.name
        cursor, number, seen, rows = state["cursor"], state["number"], list(state["seen"]), 0
        while cursor and rows < self.per_step * (partition.end - partition.start) and self.has(chain, cursor):
            page = self.page(chain, cursor)
            yield from items_of(chain, number, page)
            seen.append(cursor)
            following = (page.get("metadata") or {}).get("nextCursor")
            cursor, number, rows = following if following not in seen else None, number + 1, rows + 1
        if rows:
            self._keep(chain, partition.end, {"cursor": cursor, "number": number, "seen": seen})
            files, root = _store(self.progress)
            for old in self._steps(chain):
                if old < partition.start and old != max(s for s in self._steps(chain) if s <= partition.start):
                    files.delete_file(f"{root}/{chain}/{old}.json")  # no restart goes back beyond the step before this one


class CursorPages(DataSource):
    """S3: ``spark.read.format("cursor_pages")``: one partition for each chain of page files; a chain itself is sequential."""

    @classmethod
    def name(cls):
        return "cursor_pages"

    def schema(self):
        return PAGE

    def reader(self, schema):
        return _Reader(self.options)


class CursorItems(DataSource):
    """S3, X11: ``format("cursor_items")``, to read and to stream: one row for each listed server.

    Reading pushes ``chain`` and ``updated_at`` down if ``spark.sql.python.filterPushdown.enabled`` is set. Spark 4.1.2 keeps what
    was pushed with the loaded DataFrame, also for a later query of it that pushes nothing: load anew for each query, as ``items`` does.
    """

    @classmethod
    def name(cls):
        return "cursor_items"

    def schema(self):
        return ITEM

    def reader(self, schema):
        return _ItemReader(self.options)

    def streamReader(self, schema):
        return _ItemStream(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CursorPages)
    spark.dataSource.register(CursorItems)


def items(spark: SparkSession, path: str, *conditions) -> DataFrame:
    """The servers of all chains that fulfil ``conditions``; those on ``chain`` and ``updated_at`` are tested where pages are read."""
    register(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    rows = spark.read.format("cursor_items").option("path", path).load()
    for c in conditions:
        rows = rows.filter(c)
    return rows
