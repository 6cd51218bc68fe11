"""Filters, joins and set operations over items, rollouts and results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def item_key(item_id: Column, position: Column) -> Column:
    """``id:<id>``, or ``index:<0-based row>`` where the id is missing."""
    return F.when(item_id.isNotNull(), F.concat(F.lit("id:"), item_id.cast("string"))).otherwise(F.concat(F.lit("index:"), position.cast("string")))


def one_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order`` (descending columns make it the last one); the order must be total.

    A hot key isn't sorted: the least ordering tuple of a key is an aggregate with map-side combine.
    """
    place = [f"_place_{i}" for i in range(len(order))]
    marked = rows.withColumn("_row", F.struct(*rows.columns)).withColumns(dict(zip(place, order)))
    best = marked.groupBy(*(F.col(k).alias(f"_key_{k}") for k in keys)).agg(F.min_by("_row", F.struct(*place)).alias("_row"))
    return best.select("_row.*")


def last_per_key(rows: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Last-wins: the row with the greatest ``by``."""
    return rows.groupBy(*keys).agg(F.max(F.struct(*by, *(c for c in rows.columns if c not in keys + by))).alias("_row")).select(*keys, "_row.*")


def first_per_key(rows: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """First-wins: the row with the least ``by``."""
    return rows.groupBy(*keys).agg(F.min(F.struct(*by, *(c for c in rows.columns if c not in keys + by))).alias("_row")).select(*keys, "_row.*")


def python_slice(rows: DataFrame, text: str, position: str, total: int | None = None) -> DataFrame:
    """Rows of a slice ``a:b:c`` or of a single index, negatives counted from the end.

    ``position`` is a 0-based column. Only negative bounds and steps need the number of rows, an aggregate. The rows of a negative
    step are the same set; who wants them backwards sorts by position.
    """
    parts = [int(p) if p.strip() else None for p in text.split(":")]
    if len(parts) == 1:
        parts = [parts[0], None if parts[0] == -1 else parts[0] + 1, None]
    start, stop, step = (parts + [None] * 3)[:3]
    step = 1 if step is None else step
    if step == 0:
        raise ValueError("the step of a slice must not be zero")
    if total is None and (step < 0 or any(x is not None and x < 0 for x in (start, stop))):
        total = rows.count()
    if total is None:
        low, high = start or 0, stop
    else:
        low, high, step = slice(start, stop, step).indices(total)
    if step < 0:  # the same places from the lowest on
        n = len(range(low, high, step))
        low, high, step = low + (n - 1) * step, low + 1, -step
    kept = rows.where(F.col(position) >= low)
    kept = kept if high is None else kept.where(F.col(position) < high)
    return kept if step == 1 else kept.where((F.col(position) - low) % step == 0)


def pending(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items without a finished row (left anti)."""
    return items.join(done.select(key), key, "left_anti")


def with_progress(items: DataFrame, progress: DataFrame, key: str, score: str) -> DataFrame:
    """Items with their score; a null score marks items that have none."""
    return items.join(progress.select(key, score), key, "left")


def gain_verdicts(with_tool: DataFrame, no_tool: DataFrame, *, least_gain: float, most_no_tool: float | None = None, least_with_tool: float | None = None) -> DataFrame:
    """Verdict of each row of ``with_tool`` (``item_id, with_tool, tool_calls, has_trace``) against ``no_tool`` scores.

    The first rule that fails names the verdict; rows with a null id are left out. Scores are compared as doubles.
    """
    joined = with_tool.where("item_id is not null").join(no_tool.select("item_id", "no_tool"), "item_id", "left")
    gain = F.col("with_tool") - F.col("no_tool")
    verdict = F.when(F.col("with_tool").isNull(), "invalid_with_tool").when(F.col("no_tool").isNull(), "missing_no_tool")
    if most_no_tool is not None:
        verdict = verdict.when(F.col("no_tool") > most_no_tool, "above_most_no_tool")
    if least_with_tool is not None:
        verdict = verdict.when(F.col("with_tool") < least_with_tool, "below_least_with_tool")
    verdict = verdict.when(gain < least_gain, "below_gain").when(~F.coalesce("has_trace", F.lit(False)), "missing_trace").otherwise("keep")
    return joined.withColumns({"gain": gain, "verdict": verdict})


def intersected(gain: DataFrame, correct: DataFrame) -> DataFrame:
    """Gain rows whose id is also correct, with the method; each side has one row per id already."""
    return gain.join(correct.select("item_id", F.col("method").alias("correctness_method")), "item_id")


def by_key_or_unambiguous_id(results: DataFrame, reference: DataFrame, columns: list[str]) -> DataFrame:
    """Reference columns by ``task_key``, else by ``item_id`` where only one reference row has it."""
    by_key = reference.select("task_key", *(F.col(c).alias(f"_key_{c}") for c in columns))
    alone = reference.groupBy("item_id").agg(F.count("*").alias("_n"), *(F.max(c).alias(f"_id_{c}") for c in columns)).where("_n = 1 and item_id is not null").drop("_n")
    hit = results.join(by_key, "task_key", "left").join(alone, "item_id", "left")
    matched = F.when(F.coalesce(*(F.col(f"_key_{c}") for c in columns)).isNotNull(), "task_key").when(F.coalesce(*(F.col(f"_id_{c}") for c in columns)).isNotNull(), "item_id")
    return hit.withColumn("matched_by", matched).select(*results.columns, "matched_by", *(F.coalesce(f"_key_{c}", f"_id_{c}").alias(c) for c in columns))


def rejected(stages: list[tuple[str, str, Column]]) -> tuple[Column, Column]:
    """Stage and reason of the first rule that holds; null where all pass."""
    stage, reason = F.lit(None).cast("string"), F.lit(None).cast("string")
    for s, r, holds in reversed(stages):
        stage, reason = F.when(holds, s).otherwise(stage), F.when(holds, r).otherwise(reason)
    return stage, reason


def rejection_rollup(rows: DataFrame) -> DataFrame:
    """Counts by stage and reason with totals (null stage: all; null reason: the stage)."""
    return rows.where("stage is not null").rollup("stage", "reason").agg(F.count("*").alias("n"))


def ranked(rows: DataFrame, group: list[str], order: list[Column], name: str = "place") -> DataFrame:
    """Row number inside a group, for groups that are bounded by what they describe (samples of a task, calls of a turn)."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def completed(results: DataFrame, error: str = "error") -> DataFrame:
    """Results without an error: only these count as done when a run goes on."""
    return results.where(F.coalesce(F.col(error), F.lit("")) == "")


def intersection_summary(gain: DataFrame, correct: DataFrame, key: str = "item_id") -> DataFrame:
    """One row: ``rows, unique_ids, kept, dropped`` of an intersection of two indexes by id."""
    hit = gain.join(correct.select(key).distinct().withColumn("_hit", F.lit(1)), key, "left")
    return hit.agg(F.count("*").alias("rows"), F.count_distinct(key).alias("unique_ids"), F.count_distinct(F.when(F.col("_hit") == 1, F.col(key))).alias("kept")).withColumn("dropped", F.col("unique_ids") - F.col("kept"))


def at_position(rows: DataFrame, source: DataFrame, key: str, position: str, values: str) -> DataFrame:
    """Rows with the element at ``position`` (0-based) of the array ``values`` of their source; a position out of range is an error."""
    joined = rows.join(source.select(key, values), key, "left")
    inside = (F.col(position) >= 0) & (F.col(position) < F.size(values))
    found = F.when(inside, F.try_element_at(values, (F.col(position) + 1).cast("int"))).otherwise(F.raise_error(F.concat(F.lit("no element "), F.col(position).cast("string"), F.lit(" for "), F.col(key))))
    return joined.select(*rows.columns, found.alias("source_value"))


def checked_conditions(wanted: list[str], known: list[str]) -> list[str]:
    """The conditions asked for, if they are known and none is named twice."""
    if len(set(wanted)) != len(wanted) or not set(wanted) <= set(known):
        raise ValueError(f"conditions must be distinct ones of {sorted(known)}")
    return wanted


def by_count(rows: DataFrame, keys: list[str], count: str = "n") -> DataFrame:
    """Groups with the largest count first, ties by name."""
    return rows.orderBy(F.desc(count), *keys)


def device_pairs(reference: DataFrame, made: DataFrame, task: str, device: str, value: str) -> DataFrame:
    """Reference and made values of the devices that both have: ``task, device, reference, made``."""
    return reference.select(task, device, F.col(value).alias("reference")).join(made.select(task, device, F.col(value).alias("made")), [task, device])


def device_mean(pairs: DataFrame, task: str, device: str, score: Column) -> DataFrame:
    """Mean score over a task's devices, to four places, and their number."""
    return pairs.groupBy(task).agg(F.round(F.avg(score), 4).alias("viewport_mean"), F.count_distinct(device).alias("devices"))


def device_references(images: Column, resolved: Column, devices: tuple[str, ...] = ("desktop", "tablet", "mobile")) -> Column:
    """Map from device to resolved path, of the images whose name without ending is a device."""
    zipped = F.filter(F.arrays_zip(images.alias("i"), resolved.alias("r")), lambda z: F.regexp_extract(z["i"], r"([^/]*?)(?:\.[^./]*)?$", 1).isin(*devices))
    return F.map_from_entries(F.transform(zipped, lambda z: F.struct(F.regexp_extract(z["i"], r"([^/]*?)(?:\.[^./]*)?$", 1), z["r"])))
