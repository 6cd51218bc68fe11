"""Aggregates over rollouts, votes, results and paired conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.operators.ordered import running_counts


def avg_at_k(rollouts: DataFrame, key: str = "item_key", corrects: str = "corrects") -> DataFrame:
    """Mean of the 0/1 rollouts of each item to four places, their number and sum; null or empty arrays give no row."""
    long = rollouts.select(key, F.explode(corrects).alias("correct"))
    return long.groupBy(key).agg(F.count("correct").alias("k"), F.round(F.avg("correct"), 4).alias("avg_k"), F.sum("correct").cast("long").alias("correct_count"))


def sample_scores(results: DataFrame, key: str = "task_key") -> DataFrame:
    """Of each task's samples: number, mean score to four places, first error by sample index, token sum."""
    long = results.select(key, F.explode("samples").alias("s")).where("s is not null")
    return long.groupBy(key).agg(
        F.count("*").alias("n_samples"),
        F.round(F.avg("s.score"), 4).alias("score_avg"),
        F.min(F.when(F.coalesce(F.col("s.error"), F.lit("")) != "", F.struct(F.col("s.sample_index").alias("i"), F.col("s.error").alias("error")))).getField("error").alias("first_error"),
        F.sum(F.coalesce("s.usage_total.total_tokens", F.lit(0))).cast("long").alias("total_tokens"),
    )


def run_aggregate(results: DataFrame, by: list[str], continuous_source: Column) -> DataFrame:
    """Totals of a run. A run with a continuous source, or with a score above one, counts scores from 50 on as correct."""
    score = F.coalesce("score", F.lit(0.0))
    error = F.coalesce(F.col("error"), F.lit(""))
    grouped = results.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.max(F.coalesce(continuous_source, F.lit(False)) | (score > 1)).alias("continuous"),
        F.count_if(score == 1).alias("_ones"),
        F.count_if(score >= 50).alias("_high"),
        F.avg(score).alias("_mean"),
        F.count_if(error != "").alias("errors"),
        F.count_if(error.contains("Timeout")).alias("timeouts"),
        F.sum(F.coalesce("usage_total.total_tokens", F.lit(0))).cast("long").alias("total_tokens"),
        F.round(F.avg(F.coalesce("n_tool_calls", F.lit(0))), 2).alias("avg_tool_calls"),
        F.max(F.coalesce("avg_k", F.lit(1))).alias("avg_k"),
        F.round(F.avg(F.coalesce("score_avg", score)), 4).alias("accuracy_avg_k"),
    )
    correct = F.when(F.col("continuous"), F.col("_high")).otherwise(F.col("_ones"))
    return grouped.withColumns({"correct": correct, "accuracy": F.round(correct / F.col("total"), 4), "avg_score": F.when(F.col("continuous"), F.round("_mean", 2))}).drop("_ones", "_high", "_mean")


def majority(votes: Column) -> Column:
    """True if more votes are yes than no; ties and unreadable (null) votes don't help."""
    return F.size(F.filter(votes, lambda v: v == 1)) > F.size(F.filter(votes, lambda v: v == 0))


def upper_median(values: Column) -> Column:
    """Element n div 2 of the sorted non-null values; null if there are none."""
    valid = F.array_sort(F.filter(values, lambda v: v.isNotNull()))
    return F.when(F.size(valid) > 0, F.element_at(valid, (F.floor(F.size(valid) / 2) + 1).cast("int")))


def snapped(value: Column, grid: tuple[float, ...] = (0.0, 0.25, 0.5, 0.75, 1.0)) -> Column:
    """Nearest grid value; of two equally near ones the lower."""
    near = F.array_min(F.array(*(F.struct(F.abs(value - F.lit(g)).alias("d"), F.lit(g).alias("g")) for g in grid)))
    return F.when(value.isNotNull(), near["g"])


def component_mean(scores: Column) -> Column:
    """Mean of the snapped non-null scores; null if there are none."""
    valid = F.transform(F.filter(scores, lambda v: v.isNotNull()), lambda v: snapped(v))
    return F.when(F.size(valid) > 0, F.aggregate(valid, F.lit(0.0), lambda a, x: a + x) / F.size(valid))


def micro_macro(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Means by group, over all rows (micro) and over the groups' means (macro)."""
    groups = rows.where(F.col(value).isNotNull()).groupBy(group).agg(F.count("*").alias("n"), F.sum(value).alias("_sum"))
    per = groups.select(F.lit("group").alias("level"), F.col(group).alias("name"), "n", F.round(F.col("_sum") / F.col("n"), 6).alias("mean"))
    both = groups.agg(F.sum("n").alias("n"), F.sum("_sum").alias("s"), F.avg(F.col("_sum") / F.col("n")).alias("m"))
    micro = both.select(F.lit("micro").alias("level"), F.lit(None).cast("string").alias("name"), "n", F.round(F.col("s") / F.col("n"), 6).alias("mean"))
    macro = both.select(F.lit("macro").alias("level"), F.lit(None).cast("string").alias("name"), "n", F.round("m", 6).alias("mean"))
    return per.unionByName(micro).unionByName(macro)


def percentiles(rows: DataFrame, group: str, value: str, at: dict[str, float]) -> DataFrame:
    """Exact percentiles with linear interpolation, by name; null values don't count, a group without values has no row.

    Values are counted, the counts summed up in order over ranges, and only the two values around each position are kept:
    a group's values are never in one task.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("_n"))
    upto = running_counts(counts, group, [F.col(value)], {"_upto": F.col("_n")})
    total = counts.groupBy(F.col(group).alias("_of")).agg(F.sum("_n").alias("_all"))
    placed = upto.join(total, F.col(group).eqNullSafe(F.col("_of")))
    picked = []
    for name, q in at.items():
        position = (F.col("_all") - 1) * F.lit(q)
        for side, place in (("low", F.floor(position)), ("high", F.ceil(position))):
            holds = (F.col("_upto") > place) & (F.col("_upto") - F.col("_n") <= place)
            picked.append(F.max(F.when(holds, F.col(value))).alias(f"_{side}_{name}"))
    found = placed.groupBy(group).agg(F.max("_all").alias("_all"), *picked)
    weight = lambda q: (F.col("_all") - 1) * F.lit(q) - F.floor((F.col("_all") - 1) * F.lit(q))
    return found.select(group, *((F.col(f"_low_{n}") * (1 - weight(q)) + F.col(f"_high_{n}") * weight(q)).alias(n) for n, q in at.items()))


def _poisson_table(mean: Column) -> Column:
    """Cumulated probabilities of a Poisson law, from 0 on, as far as doubles tell them apart."""
    most = F.ceil(mean + 10 * F.sqrt(mean) + 12).cast("int")
    first = F.exp(-mean)
    start = F.struct(F.array(first).alias("table"), first.alias("p"))
    step = lambda acc, k: F.struct(F.array_append(acc["table"], F.element_at(acc["table"], -1) + acc["p"] * mean / k).alias("table"), (acc["p"] * mean / k).alias("p"))
    return F.aggregate(F.sequence(F.lit(1), most), start, step)["table"]


def _resampled_means(rows: DataFrame, group: list[str], value: str, samples: int, seed: int) -> DataFrame:
    """``group, _sample, _mean, _all``: means of resamples of each group with its size.

    A group is reduced to its distinct values with their counts. A value that stands n times gets a Poisson(n) weight: by
    inversion of a hash of (seed, sample, value, group) up to n = 64, beyond by a rounded normal. The random size W of such a
    resample is taken out by scaling its deviation with sqrt(W / n), so the variance is that of drawing n of n. The work grows
    with distinct values times samples, and nothing is drawn on the driver.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").cast("double").alias("_n"))
    total = counts.groupBy(*(F.col(g).alias(f"_of_{g}") for g in group)).agg(F.sum("_n").alias("_all"), (F.sum(F.col("_n") * F.col(value)) / F.sum("_n")).alias("_mu"))
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    known = counts.join(F.broadcast(total), same) if not group else counts.join(total, same)  # without groups the total is one row
    drawn = known.withColumn("_table", F.when(F.col("_n") <= 64, _poisson_table(F.col("_n")))).withColumn("_sample", F.explode(F.sequence(F.lit(1), F.lit(samples))))
    unit = lambda k: (F.pmod(F.xxhash64(F.lit(seed), F.lit(k), F.col("_sample"), F.col(value), *group), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    drawn = drawn.withColumns({"_u": unit(1), "_v": unit(2)})
    normal = F.sqrt(-2 * F.log("_u")) * F.cos(6.283185307179586 * F.col("_v"))
    few = F.size(F.filter("_table", lambda c: c < F.col("_u")))
    weight = F.when(F.col("_n") <= 64, few.cast("double")).otherwise(F.greatest(F.lit(0.0), F.round(F.col("_n") + F.sqrt("_n") * normal)))
    sums = drawn.withColumn("_w", weight).groupBy(*group, "_sample").agg(F.sum(F.col("_w") * F.col(value)).alias("_s"), F.sum("_w").alias("_w"), F.max("_all").alias("_all"), F.max("_mu").alias("_mu"))
    off = F.coalesce(F.try_divide("_s", "_w") - F.col("_mu"), F.lit(0.0)) * F.sqrt(F.col("_w") / F.col("_all"))
    return sums.select(*group, "_sample", (F.col("_mu") + off).alias("_mean"), "_all")


def bootstrap_ci(rows: DataFrame, group: list[str], value: str, samples: int = 10_000, seed: int = 20260722) -> DataFrame:
    """95 % interval of the mean by resampling, per group (no group: over all rows); it agrees with drawing n of n in distribution."""
    means = _resampled_means(rows, group, value, samples, seed)
    return means.groupBy(*group).agg(F.round(F.percentile("_mean", F.lit(0.025)), 6).alias("low"), F.round(F.percentile("_mean", F.lit(0.975)), 6).alias("high"))


def stratified_bootstrap(rows: DataFrame, stratum: str, value: str, samples: int = 10_000, seed: int = 20260722) -> DataFrame:
    """Micro and macro intervals, resampling inside each stratum."""
    per = _resampled_means(rows, [stratum], value, samples, seed)
    each = per.groupBy("_sample").agg((F.sum(F.col("_mean") * F.col("_all")) / F.sum("_all")).alias("micro"), F.avg("_mean").alias("macro"))
    ends = lambda c: F.array(F.round(F.percentile(c, F.lit(0.025)), 6), F.round(F.percentile(c, F.lit(0.975)), 6))
    wide = each.agg(ends("micro").alias("micro"), ends("macro").alias("macro"))
    return wide.select(F.explode(F.array(F.struct(F.lit("micro").alias("level"), F.col("micro").alias("ci")), F.struct(F.lit("macro").alias("level"), F.col("macro").alias("ci")))).alias("r")).select("r.level", F.col("r.ci")[0].alias("low"), F.col("r.ci")[1].alias("high"))


def accuracy(rows: DataFrame, by: list[str], correct: Column, missing: Column | None = None, missing_is_wrong: bool = True) -> DataFrame:
    """``n_correct, total, n_missing, accuracy`` of each group; rows without a trace count as wrong or are left out."""
    gone = F.coalesce(missing, F.lit(False)) if missing is not None else F.lit(False)
    right = F.coalesce(correct, F.lit(False)) & ~gone
    total = F.count("*") if missing_is_wrong else F.count_if(~gone)
    grouped = rows.groupBy(*by).agg(F.count_if(right).alias("n_correct"), total.alias("total"), F.count_if(gone).alias("n_missing"))
    return grouped.withColumn("accuracy", F.round(F.coalesce(F.try_divide("n_correct", "total"), F.lit(0.0)), 4))


def html_summary(rows: DataFrame, by: list[str], passed: Column, score: Column, threshold: float = 80.0) -> DataFrame:
    """Of pages with a rule verdict and perhaps a score: total, passed by rule, judged, correct (passed and score from the threshold on), mean score."""
    right = F.coalesce(passed & (score >= threshold), F.lit(False))
    return rows.groupBy(*by).agg(F.count("*").alias("total"), F.count_if(passed).alias("rule_passed"), F.count(score).alias("judged"), F.count_if(right).alias("correct"), F.round(F.coalesce(F.avg(score), F.lit(0.0)), 4).alias("avg_score"))


def shared_metrics(metrics: Column) -> Column:
    """Names of the metrics that every row has (an aggregate over arrays of names), in order."""
    each = F.collect_list(F.array_distinct(metrics))
    return F.array_sort(F.aggregate(each, F.element_at(each, 1), lambda a, x: F.array_intersect(a, x)))
