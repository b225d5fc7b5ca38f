"""Current-state tables, snapshots and transitions.

Stored tables are Parquet versions: a merge reads one version and writes the next, so that a plan
never reads what it overwrites.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from registrylake.operators import ordered
from registrylake.operators.shared import written_once


def upsert(stored: DataFrame, incoming: DataFrame, keys: list[str], update: list[str]) -> DataFrame:
    """K1: ``update`` columns take the incoming value (also NULL), other columns keep the stored one; new keys are added.

    ``incoming`` must have one row a key and the columns ``keys + update``; a missing one is an error.
    """
    missing = set(keys + update) - set(incoming.columns)
    if missing:
        raise ValueError(f"incoming rows lack {sorted(missing)}")
    new = incoming.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_n_{c}") for c in update], F.lit(True).alias("_in"))
    same = [stored[k].eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    both = stored.withColumn("_st", F.lit(True)).join(new, same, "full_outer")
    out = []
    for c in stored.columns:
        if c in keys:
            out.append(F.when(F.col("_st").isNull(), F.col(f"_k_{c}")).otherwise(F.col(c)).alias(c))
        elif c in update:
            out.append(F.when(F.col("_in"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return both.select(*out)


def append(stored_path: str, rows: DataFrame, columns: list[str]) -> None:
    """K2: appends the rows' columns in order; a missing column is an error."""
    rows.select(*columns).write.mode("append").parquet(stored_path)


def write_version(rows: DataFrame, folder: str, version: int) -> str:
    """The next version of a stored table; returns its path."""
    path = f"{folder}/v={version:08d}"
    rows.write.mode("errorifexists").parquet(path)
    return path


def capture_id(*parts):
    """K3: deterministic id of a parent row, so that children need no returned ids."""
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def children(captures: DataFrame, items: str, id_column: str = "capture_id") -> DataFrame:
    """K3: one row for each element of ``items``, with its parent's id and place."""
    return captures.select(id_column, F.posexplode(items).alias("pos", "item"))


def changed(stored: DataFrame, incoming: DataFrame, keys: list[str], hashes: list[str]) -> DataFrame:
    """Incoming rows that are new or differ in any of ``hashes``, null-safe, with ``change`` saying which."""
    old = stored.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(h).alias(f"_o_{h}") for h in hashes], F.lit(True).alias("_st"))
    both = incoming.join(old, [incoming[k].eqNullSafe(F.col(f"_k_{k}")) for k in keys], "left")
    differs = F.lit(False)
    for h in hashes:
        differs = differs | ~F.col(h).eqNullSafe(F.col(f"_o_{h}"))
    kind = F.when(F.col("_st").isNull(), "new").when(differs, "changed")
    return both.withColumn("change", kind).filter(F.col("change").isNotNull()).select(*incoming.columns, "change")


def counted(rows: DataFrame, counts: Observation | None) -> DataFrame:
    """Rows of ``changed`` as they are; the job that writes them tells ``counts`` how many are new and how many changed."""
    if counts is None:
        return rows
    return rows.observe(counts, F.count_if(F.col("change") == "new").alias("new"), F.count_if(F.col("change") == "changed").alias("changed"))


def transitions(stored: DataFrame, incoming: DataFrame, keys: list[str], state: str) -> DataFrame:
    """Known rows whose state differs; a first sight or a NULL on either side is no transition."""
    old = stored.select(*keys, F.col(state).alias("from_state"))
    return incoming.withColumnRenamed(state, "to_state").join(old, keys).filter(F.col("from_state") != F.col("to_state"))


def transition_history(rows: DataFrame, keys: list[str], at: str, tiebreak: str, state: str, parts: int | None = None) -> DataFrame:
    """W4 over a full history: each row whose state differs from the one before it; a hot key's history is cut into ranges."""
    told = ordered.carried(rows, keys, [at, tiebreak], F.col(state), "from_state", parts)
    return told.filter(F.col("from_state") != F.col(state)).withColumnRenamed(state, "to_state")


def breaking_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Tools that went, parameters that became required, parameters whose type changed.

    Both: endpoint_url, tool_name, param_set. Extension: the rule is described, not implemented, by the original.
    """
    keys = ["endpoint_url", "tool_name"]
    flat = lambda d, p: d.select(*keys, F.explode("param_set").alias("x")).select(*keys, F.col("x.name").alias("name"), F.col("x.type").alias(f"{p}_type"), F.col("x.required").alias(f"{p}_required"))
    gone = before.join(after, keys, "left_anti").select(*keys, F.lit(None).cast("string").alias("name"), F.lit("tool_removed").alias("change"))
    kept = after.join(before, keys, "left_semi")
    both = flat(kept, "new").join(flat(before, "old"), [*keys, "name"], "left")
    kind = F.when(F.col("new_required") & ~F.coalesce(F.col("old_required"), F.lit(False)), "required_added").when(F.col("old_required").isNotNull() & ~F.col("new_type").eqNullSafe(F.col("old_type")), "type_changed")
    return gone.unionByName(both.withColumn("change", kind).filter(F.col("change").isNotNull()).select(*keys, "name", "change"))


def breaking_history(captures: DataFrame, parts: int | None = None) -> DataFrame:
    """W5 over all captures (endpoint_url, captured_at, tool_name, param_set): what broke, and at which capture.

    Each capture of an endpoint is compared with the one before it: ``tool_removed`` (also when a tool that came back goes again),
    ``required_added`` and ``type_changed`` as in ``breaking_changes``, and ``tool_returned``, which breaks nothing and is
    compared with the tool as it was last seen. A capture lists each tool once; of rows that repeat any one counts. One without tools has a row
    with a null ``tool_name``. A hot endpoint's history is cut into ranges of whole captures. Rows are dealt to ranges once and to windows once;
    what a range must see of its neighbours comes in as rows beside its own.
    """
    rows = captures.dropDuplicates(["endpoint_url", "captured_at", "tool_name"]).select("endpoint_url", "captured_at", "tool_name", "param_set")
    cut = ordered.ranged(written_once(rows, "captures"), ["endpoint_url", "captured_at"], parts).withColumn("__rl_real", F.lit(True))
    w, here = W.partitionBy("endpoint_url", ordered.RANGE), W.partitionBy("endpoint_url", ordered.RANGE, "captured_at")
    all_ = cut.unionByName(_neighbours(cut).withColumn("__rl_real", F.lit(False)))
    # As many tasks as Spark is told: sized by bytes alone they would be few, and their sorts would spill.
    all_ = all_.repartition(int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions")), "endpoint_url", ordered.RANGE)
    # The captures around a row's own: rows of one capture follow each other, so its first row sees the one before and its last row the one after.
    near = all_.withColumns({"__rl_lag": F.lag("captured_at").over(w.orderBy("captured_at")), "__rl_lead": F.lead("captured_at").over(w.orderBy("captured_at"))})
    other = lambda c: F.max(F.when(~F.col(c).eqNullSafe(F.col("captured_at")), F.col(c))).over(here)
    near = near.withColumns({"prev_at": other("__rl_lag"), "next_at": other("__rl_lead")}).drop("__rl_lag", "__rl_lead")
    own = W.partitionBy("endpoint_url", ordered.RANGE, "tool_name").orderBy("captured_at")
    seen = near.withColumns({"before": F.lag(F.struct(F.col("captured_at").alias("at"), F.col("param_set").alias("p"))).over(own), "after": F.lead("captured_at").over(own)})
    seen = seen.filter(F.col("__rl_real") & F.col("tool_name").isNotNull() & F.col("captured_at").isNotNull())
    old = F.map_from_entries(F.transform("before.p", lambda p: F.struct(p["name"], F.struct(p["type"].alias("type"), p["required"].alias("required")))))
    told = seen.select("endpoint_url", "tool_name", "captured_at", "prev_at", "next_at", "before", "after", "param_set", F.when(F.col("before").isNotNull(), old).alias("old"))
    # Without an old parameter both its fields are null.
    was = lambda p: F.try_element_at("old", p["name"])
    kind = lambda p: F.when(p["required"] & ~F.coalesce(was(p)["required"], F.lit(False)), "required_added").when(was(p).isNotNull() & ~p["type"].eqNullSafe(was(p)["type"]), "type_changed")
    change = lambda at, name, what: F.struct(F.col(at).alias("captured_at"), name.cast("string").alias("name"), what.alias("change"))
    none = F.lit(None).cast("string")
    params = F.transform(F.when(F.col("before").isNotNull(), F.col("param_set")), lambda p: change("captured_at", p["name"], kind(p)))
    back = change("captured_at", none, F.when(F.col("before.at") < F.col("prev_at"), "tool_returned"))
    # A tool of one capture that the next one lacks is removed there.
    gone = change("next_at", none, F.when(F.col("next_at").isNotNull() & ~F.col("after").eqNullSafe(F.col("next_at")), "tool_removed"))
    listed = f"array<struct<captured_at: {rows.schema['captured_at'].dataType.simpleString()}, name: string, change: string>>"
    changes = F.filter(F.concat(F.array(back, gone).cast(listed), F.coalesce(params.cast(listed), F.array().cast(listed))), lambda c: c["change"].isNotNull())
    return told.select("endpoint_url", "tool_name", F.explode(changes).alias("c")).select("endpoint_url", "tool_name", "c.captured_at", "c.name", "c.change")


def _neighbours(cut: DataFrame) -> DataFrame:
    """What a range must see of others of its endpoint: the captures around it, and its tools as they were last seen before and are first seen after.

    Only endpoints that are cut take part; a boundary cuts one, so they are at most as many as there are ranges.
    """
    key, tool = ["endpoint_url", ordered.RANGE], ["endpoint_url", "tool_name", ordered.RANGE]
    ends = cut.groupBy(*key).agg(F.min("captured_at").alias("first"), F.max("captured_at").alias("last"))
    along = lambda keys: W.partitionBy(*keys).orderBy(ordered.RANGE)
    e = along(["endpoint_url"])
    ends = ends.withColumns({"prev": F.lag("last").over(e), "next": F.lead("first").over(e), "n": F.count(F.lit(1)).over(W.partitionBy("endpoint_url"))}).filter("n > 1")
    marks = ends.select(*key, F.explode(F.array("prev", "next")).alias("captured_at")).filter(F.col("captured_at").isNotNull())
    marks = marks.select(*key, "captured_at", F.lit(None).cast("string").alias("tool_name"), F.lit(None).cast(cut.schema["param_set"].dataType).alias("param_set"))
    split = ends.select(F.col("endpoint_url").alias("__rl_e"), F.col(ordered.RANGE).alias("__rl_r"))
    held = cut.filter(F.col("tool_name").isNotNull()).join(F.broadcast(split), F.col("endpoint_url").eqNullSafe(F.col("__rl_e")) & (F.col(ordered.RANGE) == F.col("__rl_r")), "left_semi")
    seen = F.struct("captured_at", "param_set")
    sides = held.groupBy(*tool).agg(F.min_by(seen, F.struct("captured_at")).alias("first"), F.max_by(seen, F.struct("captured_at")).alias("last"))
    t = along(["endpoint_url", "tool_name"])
    sides = sides.withColumns({"prev": F.lag("last").over(t), "next": F.lead("first").over(t)})
    tools = sides.select(*tool, F.explode(F.array("prev", "next")).alias("s")).filter(F.col("s").isNotNull())
    return marks.unionByName(tools.select(*tool, "s.captured_at", "s.param_set"))


def newer_than(rows: DataFrame, marks: DataFrame, keys: list[str], at: str) -> DataFrame:
    """X11: rows at or after their key's watermark; all rows of a key without one. Re-reading is harmless before ``upsert``."""
    return rows.join(marks, keys, "left").filter(F.col("newest").isNull() | (F.col(at) >= F.col("newest"))).drop("newest")
