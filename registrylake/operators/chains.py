"""Cursor chains (survey ids X9, F47, P6-P8): pages of one capture folded in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_PAGES = 20


def chain_end(pages: Column, max_pages: int = MAX_PAGES) -> Column:
    """Where a chain of pages (page_no, status, cursor_in, next_cursor, n_items, exception) ends and how.

    ``pages`` is an array in page order. The first page that fails, has no next cursor or repeats its
    cursor ends the chain; so does ``max_pages``. A built-in fold: the array of one capture is bounded
    by the cap, and no Python runs.
    """
    first = F.slice(pages, 1, max_pages)
    previous = lambda i: F.get(first, i - 1)["next_cursor"]

    def reason(p: Column, i: Column) -> Column:
        repeated = (i > 0) & (p["next_cursor"] == previous(i))
        return (
            F.when(p["exception"].isNotNull(), "exception").when(p["status"] != "ok", "failed").when(F.coalesce(p["next_cursor"], F.lit("")) == "", "complete").when(repeated, "repeated_cursor")
        )

    marked = F.transform(first, lambda p, i: F.struct(i.cast("int").alias("at"), reason(p, i).alias("reason"), p.alias("page")))
    stop = F.get(F.filter(marked, lambda m: m["reason"].isNotNull()), 0)
    open_ = F.size(pages) > max_pages
    at = F.coalesce(stop["at"], F.size(first) - 1)
    reason_ = F.coalesce(stop["reason"], F.when(open_ | (F.size(first) == max_pages), "page_cap").otherwise("unfinished"))
    good = F.filter(F.slice(first, 1, at + 1), lambda p: p["exception"].isNull() & (p["status"] == "ok"))
    items = F.aggregate(good, F.lit(0).cast("long"), lambda n, p: n + p["n_items"])
    partial = (reason_ == "exception") & (at > 0)
    status = F.when(partial, "ok").when(reason_ == "exception", "error").when(reason_ == "failed", stop["page"]["status"]).otherwise("ok")
    lost = F.when(partial, items).otherwise(F.lit(0).cast("long"))
    return F.struct(
        status.alias("status"), reason_.alias("reason"), F.when(reason_ == "exception", at).otherwise(at + 1).cast("int").alias("page_count"),
        F.when(status == "ok", items).alias("item_count"), (partial | reason_.isin("repeated_cursor", "page_cap")).alias("truncated"), lost.alias("items_lost"),
    )


def fold_chains(pages: DataFrame, keys: list[str], max_pages: int = MAX_PAGES) -> DataFrame:
    """One row for each chain. An exception after the first page keeps the count and loses the items (R5); a failure discards all.

    Pages beyond the cap are dropped before they are gathered, but for one, which tells that the cursor was still open.
    """
    fields = ["page_no", "status", "next_cursor", "n_items", "exception"]
    some = pages.filter(F.col("page_no") <= max_pages)
    held = some.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("_pages"))
    return held.withColumn("_end", chain_end(F.col("_pages"), max_pages)).select(*keys, "_end.*")


def last_given(pages: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """the value of the last page that gave one."""
    return pages.groupBy(*keys).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias(value))


def prompt_row(item: Column) -> Column:
    """Counts are NULL without an arguments array, else its size and the strictly required ones."""
    array = F.try_variant_get(F.try_parse_json(item), "$.arguments", "array<variant>")
    is_array = F.coalesce(F.schema_of_variant(F.try_variant_get(F.try_parse_json(item), "$.arguments", "variant")).startswith("ARRAY"), F.lit(False))
    need = F.filter(array, lambda a: F.coalesce(F.schema_of_variant(F.try_variant_get(a, "$.required", "variant")) == "BOOLEAN", F.lit(False)) & F.coalesce(F.try_variant_get(a, "$.required", "boolean"), F.lit(False)))
    text = lambda k: F.when(F.schema_of_variant(F.try_variant_get(F.try_parse_json(item), f"$.{k}", "variant")) == "STRING", F.get_json_object(item, f"$.{k}"))
    return F.struct(F.coalesce(text("name"), F.lit("")).alias("name"), text("title").alias("title"), text("description").alias("description"), F.when(is_array, F.size(array)).alias("argument_count"), F.when(is_array, F.size(need)).alias("required_count"), F.ceil(F.octet_length(item) / 4).alias("token_estimate"))


def resource_row(item: Column) -> Column:
    """A missing uri is '', other fields that are no text are NULL."""
    text = lambda k: F.when(F.schema_of_variant(F.try_variant_get(F.try_parse_json(item), f"$.{k}", "variant")) == "STRING", F.get_json_object(item, f"$.{k}"))
    return F.struct(F.coalesce(text("uri"), F.lit("")).alias("uri"), text("name").alias("name"), text("title").alias("title"), text("description").alias("description"), text("mimeType").alias("mime_type"), F.ceil(F.octet_length(item) / 4).alias("token_estimate"))
