"""Queries by name, each with the SQL that states the same result where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracelake.functions import answers as A
from tracelake.functions import audit as AU
from tracelake.functions import geometry as G
from tracelake.functions import web as H
from tracelake.operators import convert as C
from tracelake.operators import flatten
from tracelake.operators import selection as S
from tracelake.operators import stats as K
from tracelake.operators import traces as R
from tracelake.operators.ordered import running_counts
from tracelake.session import written
from tracelake.streaming import progress as P

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _once(spark: SparkSession, folder: str, name: str, columns: list[str]) -> DataFrame:
    return _t(spark, folder, name).select(*columns).distinct()


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return R.events(_t(spark, folder, "session_events"))


# Events once, with a clean role: the SQL counterpart of traces.events.
_EV = "ev as (select distinct on (event_id) *, lower(trim(role, ' ')) as r from session_events where event_id is not null)"
_CALLS = _EV + """, js as (select session_key, event_id, case when json_valid(tool_calls) then json(tool_calls) end as j from ev where r = 'assistant' and tool_calls is not null),
arr as (select session_key, event_id, case when json_type(j) = 'OBJECT' then json_array(j) else j end as a from js where json_type(j) in ('OBJECT', 'ARRAY')),
calls as (select session_key, event_id, i as call_no, json_extract_string(a, '$[' || i || '].id') as call_id, coalesce(json_extract_string(a, '$[' || i || '].function.name'), json_extract_string(a, '$[' || i || '].name')) as tool, coalesce(json_extract_string(a, '$[' || i || '].function.arguments'), json_extract_string(a, '$[' || i || '].arguments')) as arguments
 from (select session_key, event_id, a, unnest(range(json_array_length(a)::bigint)) as i from arr))"""
_ROLL = "r as (select distinct item_key, item_id, source_dataset, avg_k, corrects, predictions, skipped_reason from rollouts where item_key is not null)"
_RES = "t as (select distinct on (task_key) * from task_results where task_key is not null)"


_SAMPLES = f"{_RES}, s as (select task_key, i as sample_no, samples[i + 1] as s from (select task_key, samples, unnest(range(len(samples))) as i from t where samples is not null)), u as (select task_key, sample_no, j as turn_no, s.turns[j + 1] as u from (select *, unnest(range(len(s.turns))) as j from s where s is not null and s.turns is not null))"


# --- rollouts and selection


@query(f"with {_ROLL} select item_key, count(c) as k, round(avg(c), 4) as avg_k, sum(c)::bigint as correct_count from (select item_key, unnest(corrects) as c from r) group by item_key")
def avg_at_k(spark, folder):
    return K.avg_at_k(_once(spark, folder, "rollouts", ["item_key", "corrects"]).where("item_key is not null"))


@query(f"with {_RES}, s as (select task_key, unnest(samples) as s from t) select task_key, count(*) as n_samples, round(avg(s.score), 4) as score_avg, min_by(s.error, s.sample_index) filter (where coalesce(s.error, '') <> '') as first_error, sum(coalesce(s.usage_total.total_tokens, 0))::bigint as total_tokens from s where s is not null group by task_key")
def score_avg(spark, folder):
    return K.sample_scores(_t(spark, folder, "task_results").where("task_key is not null").select("task_key", "samples").dropDuplicates(["task_key"]))


@query(f"with {_ROLL} select source_dataset, coalesce(round(avg(avg_k), 6), 0) as mean_avg_k, count(*) as n_items, count(*) filter (where skipped_reason is not null) as n_skipped from r group by source_dataset")
def mean_avg_at_k(spark, folder):
    rows = _once(spark, folder, "rollouts", ["item_key", "item_id", "source_dataset", "avg_k", "corrects", "predictions", "skipped_reason"]).where("item_key is not null")
    return rows.groupBy("source_dataset").agg(F.coalesce(F.round(F.avg("avg_k"), 6), F.lit(0.0)).alias("mean_avg_k"), F.count("*").alias("n_items"), F.count("skipped_reason").alias("n_skipped"))


def _items(spark, folder):
    return _once(spark, folder, "items", ["item_index", "item_id", "source_dataset", "query", "answer"]).withColumn("item_key", S.item_key(F.col("item_id"), F.col("item_index") - 1))


def _progress(spark, folder):
    return S.last_per_key(_once(spark, folder, "rollouts", ["item_key", "finished_at", "avg_k"]).where("item_key is not null"), ["item_key"], ["finished_at"])


_ITEMS = "i as (select distinct item_index, item_id, source_dataset, query, answer, case when item_id is not null then 'id:' || item_id else 'index:' || (item_index - 1) end as item_key from items)"
_PROG = "p as (select item_key, finished_at, avg_k from (select *, row_number() over (partition by item_key order by finished_at desc nulls last, avg_k desc nulls last) as n from (select distinct item_key, finished_at, avg_k from rollouts where item_key is not null)) where n = 1)"


@query(f"with {_ITEMS}, {_PROG} select i.item_index, i.item_id, i.source_dataset, p.avg_k as avg_k_notool from i join p using (item_key) where p.avg_k < 0.4")
def difficulty_threshold(spark, folder):
    joined = S.with_progress(_items(spark, folder), _progress(spark, folder), "item_key", "avg_k")
    return joined.where(F.col("avg_k") < 0.4).select("item_index", "item_id", "source_dataset", F.col("avg_k").alias("avg_k_notool"))


@query(f"with {_ITEMS}, {_PROG} select i.item_index, i.item_id, p.avg_k, case when p.avg_k is null then 'no_progress' when p.avg_k between 0.25 and 0.75 then 'kept' else 'out_of_range' end as status from i left join p using (item_key)")
def difficulty_range(spark, folder):
    status = F.when(F.col("avg_k").isNull(), "no_progress").when(F.col("avg_k").between(0.25, 0.75), "kept").otherwise("out_of_range")
    return S.with_progress(_items(spark, folder), _progress(spark, folder), "item_key", "avg_k").select("item_index", "item_id", "avg_k", status.alias("status"))


@query(f"with {_ITEMS} select i.item_index, i.item_key from i where not exists (select 1 from rollouts r where r.item_key = i.item_key)")
def resume_pending(spark, folder):
    return S.pending(_items(spark, folder), _t(spark, folder, "rollouts"), "item_key").select("item_index", "item_key")


_GAIN = f"""{_PROG}, {_RES}, w as (select item_id, max(score_avg) as with_tool, max(n_tool_calls)::bigint as tool_calls, bool_or(len(samples) > 0) as has_trace, min(source_dataset) as source_dataset from t group by item_id),
n as (select substr(item_key, 4) as item_id, avg_k as no_tool from p where item_key like 'id:%' and avg_k is not null),
v as (select w.*, n.no_tool, w.with_tool - n.no_tool as gain, case when w.with_tool is null then 'invalid_with_tool' when n.no_tool is null then 'missing_no_tool' when n.no_tool > 0.75 then 'above_most_no_tool' when w.with_tool < 0.25 then 'below_least_with_tool' when w.with_tool - n.no_tool < 0.1 then 'below_gain' when not coalesce(w.has_trace, false) then 'missing_trace' else 'keep' end as verdict from w left join n using (item_id) where w.item_id is not null)"""


def _verdicts(spark, folder):
    # of the samples only one leaf is read, enough for their number
    results = _t(spark, folder, "task_results").where("task_key is not null").select("task_key", "item_id", "source_dataset", "score_avg", "n_tool_calls", F.size("samples.sample_index").alias("n_samples")).dropDuplicates(["task_key"])
    with_tool = results.groupBy("item_id").agg(F.max("score_avg").alias("with_tool"), F.max("n_tool_calls").cast("long").alias("tool_calls"), F.max(F.col("n_samples") > 0).alias("has_trace"), F.min("source_dataset").alias("source_dataset"))
    no_tool = _progress(spark, folder).where("item_key like 'id:%' and avg_k is not null").select(F.expr("substring(item_key, 4)").alias("item_id"), F.col("avg_k").alias("no_tool"))
    return S.gain_verdicts(with_tool, no_tool, least_gain=0.1, most_no_tool=0.75, least_with_tool=0.25)


@query(f"with {_GAIN} select item_id, round(with_tool, 4) as avg_at_k_with_tool, round(no_tool, 4) as avg_at_k_no_tool, tool_calls from v where verdict = 'keep'")
def tool_gain_selected(spark, folder):
    return _verdicts(spark, folder).where("verdict = 'keep'").select("item_id", F.round("with_tool", 4).alias("avg_at_k_with_tool"), F.round("no_tool", 4).alias("avg_at_k_no_tool"), "tool_calls")


@query(f"with {_GAIN} select source_dataset, verdict, count(*) as n, round(avg(round(gain, 6)), 4) as mean_gain from v group by source_dataset, verdict")
def tool_gain_funnel(spark, folder):
    return _verdicts(spark, folder).groupBy("source_dataset", "verdict").agg(F.count("*").alias("n"), F.round(F.avg(F.round("gain", 6)), 4).alias("mean_gain"))


_METHODS = f"{_ROLL}, m as (select item_id, min(method) as method from (select distinct item_id, unnest(methods) as method from rollouts where item_id is not null) where method <> 'none' group by item_id)"


def _methods(spark, folder):
    rows = _once(spark, folder, "rollouts", ["item_id", "methods"]).where("item_id is not null").select("item_id", F.explode("methods").alias("method"))
    return rows.where("method <> 'none'").groupBy("item_id").agg(F.min("method").alias("method"))


@query(f"with {_GAIN}, m as (select item_id, min(method) as method from (select distinct item_id, unnest(methods) as method from rollouts where item_id is not null) where method <> 'none' group by item_id) select v.item_id, round(v.gain, 6) as gain, m.method as correctness_method from v join m using (item_id) where v.verdict = 'keep'")
def correct_and_gain(spark, folder):
    kept = _verdicts(spark, folder).where("verdict = 'keep'").select("item_id", F.round("gain", 6).alias("gain"))
    return S.intersected(kept, _methods(spark, folder))


@query("select event_id, session_key, item_id from session_events where item_id in (select item_id from rollouts where kept)")
def index_intersection(spark, folder):
    kept = _t(spark, folder, "rollouts").where("kept").select("item_id")
    return _t(spark, folder, "session_events").select("event_id", "session_key", "item_id").join(kept, "item_id", "left_semi").select("event_id", "session_key", "item_id")


@query(f"with {_RES}, b as (select distinct source_dataset || '_' || item_id as task_key, item_id, answer from items where item_id is not null and source_dataset is not null and answer is not null), b1 as (select task_key, max(answer) as answer, max(item_id) as item_id from b group by task_key), u as (select item_id, max(answer) as answer from b1 group by item_id having count(*) = 1) select t.task_key, t.item_id, case when b1.answer is not null then 'task_key' when u.answer is not null then 'item_id' end as matched_by, coalesce(b1.answer, u.answer) as answer from t left join b1 on b1.task_key = t.task_key left join u on u.item_id = t.item_id")
def prioritized_key_join(spark, folder):
    reference = _t(spark, folder, "items").where("item_id is not null and source_dataset is not null and answer is not null").groupBy(F.concat_ws("_", "source_dataset", "item_id").alias("task_key")).agg(F.max("answer").alias("answer"), F.max("item_id").alias("item_id"))
    results = _t(spark, folder, "task_results").where("task_key is not null").select("task_key", "item_id").dropDuplicates(["task_key"])
    return S.by_key_or_unambiguous_id(results, reference, ["answer"])


@query("select session_key, max_by(event_id, received_at::varchar || lpad(event_id::varchar, 20, '0')) as event_id from session_events where session_key is not null group by session_key")
def dedupe_last_wins(spark, folder):
    rows = _t(spark, folder, "session_events").where("session_key is not null and received_at is not null").select("session_key", "received_at", "event_id")
    return S.last_per_key(rows, ["session_key"], ["received_at", "event_id"]).select("session_key", "event_id")


@query("select session_key, min_by(event_id, received_at::varchar || lpad(event_id::varchar, 20, '0')) as event_id from session_events where session_key is not null group by session_key")
def dedupe_first_wins(spark, folder):
    rows = _t(spark, folder, "session_events").where("session_key is not null and received_at is not null").select("session_key", "received_at", "event_id")
    return S.first_per_key(rows, ["session_key"], ["received_at", "event_id"]).select("session_key", "event_id")


@query("select o_orderkey, o_custkey from orders where o_orderkey >= (select count(*) from orders) / 2 - 0 and (o_orderkey - (select count(*) from orders) // 2) % 3 = 0 and o_orderkey < (select count(*) from orders) - 5")
def slice_rows(spark, folder):
    rows = _t(spark, folder, "orders").select("o_orderkey", "o_custkey")
    n = rows.count()
    return S.python_slice(rows, f"{n // 2}:-5:3", "o_orderkey", n)


@query("select distinct item_index, item_id from items where item_index <= 100")
def first_n(spark, folder):
    return _t(spark, folder, "items").where("item_index <= 100").select("item_index", "item_id").distinct()


@query("select distinct item_index, item_id from items where try_cast(item_id as bigint) >= 1000")
def start_id(spark, folder):
    return _t(spark, folder, "items").where(F.col("item_id").rlike(r"^\d{1,18}$") & (F.col("item_id").try_cast("bigint") >= 1000)).select("item_index", "item_id").distinct()


# --- aggregates over results


@query(f"""with {_RES}, a as (select coalesce(source_dataset, 'none') as source_dataset, count(*) as total, bool_or(coalesce(score, 0) > 1 or source_dataset = 'pagecraft') as continuous, count(*) filter (where coalesce(score, 0) = 1) as ones, count(*) filter (where coalesce(score, 0) >= 50) as high, avg(coalesce(score, 0)) as mean, count(*) filter (where coalesce(error, '') <> '') as errors, count(*) filter (where contains(coalesce(error, ''), 'Timeout')) as timeouts, sum(coalesce(usage_total.total_tokens, 0))::bigint as total_tokens, round(avg(coalesce(n_tool_calls, 0)), 2) as avg_tool_calls, max(coalesce(avg_k, 1)) as avg_k, round(avg(coalesce(score_avg, score, 0)), 4) as accuracy_avg_k from t group by 1)
select source_dataset, total, continuous, errors, timeouts, total_tokens, avg_tool_calls, avg_k, accuracy_avg_k, case when continuous then high else ones end as correct, round(case when continuous then high else ones end / total, 4) as accuracy, case when continuous then round(mean, 2) end as avg_score from a""")
def run_aggregate(spark, folder):
    # columns before the de-duplication: samples aren't read
    columns = ["task_key", "source_dataset", "score", "error", "usage_total", "n_tool_calls", "avg_k", "score_avg"]
    rows = _t(spark, folder, "task_results").where("task_key is not null").select(*columns).dropDuplicates(["task_key"]).withColumn("source_dataset", F.coalesce("source_dataset", F.lit("none")))
    return K.run_aggregate(rows, ["source_dataset"], F.col("source_dataset") == "pagecraft")


@query(f"with {_RES}, x as (select source_dataset, score, case when pred is null then score when pred = gt then 1.0 else 0.0 end as new_score from t) select source_dataset, count(*) as n, count(*) filter (where score <> new_score) as flips from x group by source_dataset")
def rejudge_flips(spark, folder):
    rows = _t(spark, folder, "task_results").where("task_key is not null").dropDuplicates(["task_key"])
    new = rows.where("pred is not null").select("task_key", F.when(F.col("pred") == F.col("gt"), 1.0).otherwise(0.0).alias("score"))
    judged = AU.rejudged(rows.select("task_key", "source_dataset", "score"), new, "task_key", ["score"])
    return judged.groupBy("source_dataset").agg(F.count("*").alias("n"), F.count_if(F.col("score_prev") != F.col("score")).alias("flips"))


@query(f"with {_RES} select source_dataset, count(*) filter (where coalesce(score, 0) = 1 and samples is not null) as n_correct, count(*) as total, count(*) filter (where samples is null) as n_missing, round(count(*) filter (where coalesce(score, 0) = 1 and samples is not null) / count(*), 4) as accuracy from t group by source_dataset")
def accuracy_summary(spark, folder):
    # of the samples one leaf tells whether there is a trace
    rows = _t(spark, folder, "task_results").where("task_key is not null").select("task_key", "source_dataset", "score", F.col("samples.sample_index").isNull().alias("gone")).dropDuplicates(["task_key"])
    return K.accuracy(rows, ["source_dataset"], F.coalesce("score", F.lit(0.0)) == 1, F.col("gone"))


@query(f"with {_RES} select source_dataset, count(*) as total, count(*) filter (where contains(pred, '<')) as rule_passed, count(score) as judged, count(*) filter (where contains(pred, '<') and score * 100 >= 80) as correct, round(coalesce(avg(score * 100), 0), 4) as avg_score from t group by source_dataset")
def html_summary(spark, folder):
    rows = _t(spark, folder, "task_results").where("task_key is not null").select("task_key", "source_dataset", "pred", "score").dropDuplicates(["task_key"])
    return K.html_summary(rows, ["source_dataset"], F.col("pred").contains("<"), F.col("score") * 100)


@query(f"with {_RES} select coalesce(source_dataset, '') as source_dataset, item_id, task_key, row_number() over (order by coalesce(source_dataset, ''), item_id nulls first, task_key) as place from t")
def sorted_results(spark, folder):
    rows = _t(spark, folder, "task_results").where("task_key is not null").select(F.coalesce("source_dataset", F.lit("")).alias("source_dataset"), "item_id", "task_key").dropDuplicates(["task_key"])
    # places over ranges: no task sorts everything
    return running_counts(rows.withColumn("_all", F.lit(1)), "_all", [F.col("source_dataset"), F.col("item_id"), F.col("task_key")], {"place": F.lit(1)}).select("source_dataset", "item_id", "task_key", "place")


@query(f"with {_ROLL} select item_key, len(list_filter(corrects, lambda x: x = 1)) > len(list_filter(corrects, lambda x: x = 0)) as verdict from r where corrects is not null")
def majority_vote(spark, folder):
    return _once(spark, folder, "rollouts", ["item_key", "corrects"]).where("item_key is not null and corrects is not null").select("item_key", K.majority(F.col("corrects")).alias("verdict"))


@query(f"with {_RES}, x as (select task_key, list_sort(list_filter(list_transform(samples, lambda s: s.score), lambda v: v is not null)) as v from t where samples is not null) select task_key, case when len(v) > 0 then v[len(v) // 2 + 1] end as median_score from x")
def median_vote(spark, folder):
    rows = _t(spark, folder, "task_results").where("task_key is not null").select("task_key", F.col("samples.score").alias("scores")).where("scores is not null").dropDuplicates(["task_key"])
    return rows.select("task_key", K.upper_median(F.col("scores")).alias("median_score"))


@query("with x as (select l_orderkey, l_discount * 10 as s from lineitem), y as (select l_orderkey, case when s <= 0.125 then 0.0 when s <= 0.375 then 0.25 when s <= 0.625 then 0.5 when s <= 0.875 then 0.75 else 1.0 end::double as g from x) select l_orderkey, round(avg(g), 6) as component_mean from y group by l_orderkey")
def component_mean(spark, folder):
    rows = _t(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.col("l_discount") * 10).alias("scores"))
    return rows.select("l_orderkey", F.round(K.component_mean(F.col("scores")), 6).alias("component_mean"))


@query("with r as (select l_orderkey, l_returnflag as device, max(l_quantity) as q from lineitem where l_linestatus = 'F' group by 1, 2), m as (select l_orderkey, l_returnflag as device, max(l_extendedprice) as q from lineitem where l_discount > 0.03 group by 1, 2) select l_orderkey, round(avg(m.q - r.q), 4) as viewport_mean, count(distinct device) as devices from r join m using (l_orderkey, device) group by l_orderkey")
def viewport_mean(spark, folder):
    rows = _t(spark, folder, "lineitem").withColumn("device", F.col("l_returnflag"))
    side = lambda kept, value: rows.where(kept).groupBy("l_orderkey", "device").agg(F.max(value).alias("q"))
    pairs = S.device_pairs(side("l_linestatus = 'F'", "l_quantity"), side("l_discount > 0.03", "l_extendedprice"), "l_orderkey", "device", "q")
    return S.device_mean(pairs, "l_orderkey", "device", F.col("made") - F.col("reference"))


@query(f"with {_RES}, s as (select task_key, unnest(samples) as s from t) select task_key, s.sample_index as sample_index, round(avg(s.score) over (partition by task_key order by s.sample_index rows unbounded preceding), 6) as running_avg from s where s is not null")
def running_avg(spark, folder):
    rows = _t(spark, folder, "task_results").where("task_key is not null").select("task_key", "samples").dropDuplicates(["task_key"]).select("task_key", F.explode("samples").alias("s")).where("s is not null")
    w = Window.partitionBy("task_key").orderBy("s.sample_index").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("task_key", F.col("s.sample_index").alias("sample_index"), F.round(F.avg("s.score").over(w), 6).alias("running_avg"))


@query(f"with {_ROLL} select item_key, i as rollout, (o + i) % 3 as first_condition from (select item_key, o, unnest(range(len(corrects))) as i from (select item_key, corrects, length(item_key) as o from r where corrects is not null))")
def condition_order(spark, folder):
    rows = _once(spark, folder, "rollouts", ["item_key", "corrects"]).where("item_key is not null and corrects is not null")
    return rows.select("item_key", F.char_length("item_key").alias("o"), F.posexplode("corrects").alias("rollout", "c")).select("item_key", F.col("rollout").cast("long").alias("rollout"), F.pmod(F.col("o") + F.col("rollout"), F.lit(3)).cast("long").alias("first_condition"))


@query(f"with {_ROLL}, g as (select source_dataset, count(*) as n, sum(avg_k) as s from r where avg_k is not null group by source_dataset) select 'group' as level, source_dataset as name, n::bigint as n, round(s / n, 6) as mean from g union all select 'micro', null, sum(n)::bigint, round(sum(s) / sum(n), 6) from g union all select 'macro', null, sum(n)::bigint, round(avg(s / n), 6) from g")
def micro_macro(spark, folder):
    rows = _once(spark, folder, "rollouts", ["item_key", "item_id", "source_dataset", "avg_k", "corrects", "predictions", "skipped_reason"]).where("item_key is not null")
    return K.micro_macro(rows, "source_dataset", "avg_k")


@query(f"with {_GAIN} select source_dataset, count(*) as n, round(avg(round(gain, 6)), 4) as mean_delta, round(avg((gain > 0)::int), 6) as positive, round(avg((gain < 0)::int), 6) as negative, round(avg((gain = 0)::int), 6) as tie from v where gain is not null group by source_dataset")
def paired_delta(spark, folder):
    gain = F.col("gain")
    share = lambda x: F.round(F.avg(x.cast("int")), 6)
    return _verdicts(spark, folder).where(gain.isNotNull()).groupBy("source_dataset").agg(F.count("*").alias("n"), F.round(F.avg(F.round(gain, 6)), 4).alias("mean_delta"), share(gain > 0).alias("positive"), share(gain < 0).alias("negative"), share(gain == 0).alias("tie"))


@query("select l_returnflag, round(quantile_cont(l_extendedprice::double, 0.025), 4) as low, round(quantile_cont(l_extendedprice::double, 0.975), 4) as high from lineitem group by l_returnflag")
def percentile_ci(spark, folder):
    found = K.percentiles(_t(spark, folder, "lineitem"), "l_returnflag", "l_extendedprice", {"low": 0.025, "high": 0.975})
    return found.select("l_returnflag", F.round("low", 4).alias("low"), F.round("high", 4).alias("high"))


@query()
def bootstrap_ci(spark, folder):
    return K.bootstrap_ci(_t(spark, folder, "rollouts").dropDuplicates(["item_key"]), ["source_dataset"], "avg_k")


@query()
def stratified_bootstrap(spark, folder):
    return K.stratified_bootstrap(_t(spark, folder, "rollouts").dropDuplicates(["item_key"]), "source_dataset", "avg_k")


@query("select source_dataset, count(*) as n, count(*) filter (where answer is null or trim(answer, ' ') = '') as no_answer, count(*) filter (where query is null or trim(query, ' ') = '') as no_query, count(*) filter (where images is null or len(images) = 0) as no_media from (select distinct on (item_index) * from items) group by source_dataset")
def missing_fields(spark, folder):
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    rows = _t(spark, folder, "items").dropDuplicates(["item_index"])
    return rows.groupBy("source_dataset").agg(F.count("*").alias("n"), F.count_if(blank("answer")).alias("no_answer"), F.count_if(blank("query")).alias("no_query"), F.count_if(F.coalesce(F.size("images") <= 0, F.lit(True))).alias("no_media"))


@query(f"with {_ITEMS} select count(*) as rows, count(distinct item_id) as unique_ids, count(distinct item_id) filter (where item_id in (select item_id from rollouts where kept)) as kept, count(distinct item_id) - count(distinct item_id) filter (where item_id in (select item_id from rollouts where kept)) as dropped from i")
def intersection_summary(spark, folder):
    return S.intersection_summary(_items(spark, folder), _t(spark, folder, "rollouts").where("kept").select("item_id"))


@query(f"with {_RES} select task_key from t where coalesce(error, '') = ''")
def completed_tasks(spark, folder):
    return S.completed(_t(spark, folder, "task_results").where("task_key is not null").select("task_key", "error").dropDuplicates(["task_key"])).select("task_key")


# --- traces


@query(f"with {_EV} select session_key, count(*) as n_messages, count(*) filter (where r = 'user') as n_user, count(*) filter (where r = 'assistant') as n_assistant, count(*) filter (where r = 'tool') as n_tool from ev group by session_key")
def role_counts(spark, folder):
    return _events(spark, folder).groupBy("session_key").agg(F.count("*").alias("n_messages"), *(F.count_if(F.col("role") == r).alias(f"n_{r}") for r in ("user", "assistant", "tool")))


@query(f"with {_CALLS} select session_key, count(*) as n_calls, count(distinct tool) as n_tools from calls group by session_key")
def tool_call_count(spark, folder):
    return R.calls(_events(spark, folder)).groupBy("session_key").agg(F.count("*").alias("n_calls"), F.count_distinct("tool").alias("n_tools"))


@query(f"with {_CALLS}, c as (select * from calls where tool is not null), g as (select tool, count(*) as n_calls, count(distinct session_key) as n_samples from c group by tool) select tool, n_calls, round(n_calls / (select count(*) from c), 6) as share, n_samples, round(n_samples / (select count(distinct session_key) from c), 6) as coverage, round(n_calls / n_samples, 6) as calls_a_sample from g")
def tool_distribution(spark, folder):
    return R.tool_distribution(R.calls(_events(spark, folder)))


@query(f"with {_CALLS} select tool, count(*) as n_calls from calls where tool is not null group by tool order by n_calls desc, tool limit 8")
def top_tools(spark, folder):
    return R.calls(_events(spark, folder)).where("tool is not null").groupBy("tool").agg(F.count("*").alias("n_calls")).orderBy(F.desc("n_calls"), "tool").limit(8)


@query(f"with {_EV}, f as (select session_key, max(event_id) filter (where r = 'user') as k from ev group by session_key) select ev.session_key, ev.event_id, ev.r as role from ev join f using (session_key) where f.k is null or ev.event_id >= f.k")
def last_user_slice(spark, folder):
    return R.last_user_slice(_events(spark, folder)).select("session_key", "event_id", "role")


@query(f"with {_EV} select session_key, max_by(content, event_id) as content from ev where r = 'assistant' and coalesce(content, '') <> '' and session_key is not null group by session_key")
def last_assistant(spark, folder):
    return R.last_matching(_events(spark, folder).where("session_key is not null"), (F.col("role") == "assistant") & (F.coalesce("content", F.lit("")) != ""), "content")


@query(f"with {_CALLS} select session_key, max_by(json_extract_string(case when json_valid(arguments) then arguments end, '$.actions[0].type'), (event_id, call_no)) as action from calls where tool = 'computer_use' and session_key is not null and json_extract_string(case when json_valid(arguments) then arguments end, '$.actions[0].type') is not null group by session_key")
def last_matching(spark, folder):
    made = R.calls(_events(spark, folder)).withColumn("at", F.struct("event_id", "call_no"))
    made = made.withColumn("action", F.get_json_object("arguments", "$.actions[0].type"))
    return R.last_matching(made.where("session_key is not null"), (F.col("tool") == "computer_use") & F.col("action").isNotNull(), "action", "at")


@query(f"with {_EV}, b as (select session_key, event_id, r, row_number() over (partition by session_key order by event_id desc) as n from ev where session_key is not null), w as (select * from b where n <= 10), f as (select session_key, min(event_id) filter (where r = 'user') as k from w group by session_key) select w.session_key, w.event_id, w.r as role from w join f using (session_key) where f.k is null or w.event_id >= f.k")
def history_window(spark, folder):
    return R.history_window(_events(spark, folder).where("session_key is not null"), 10)


@query(f"with {_EV} select session_key, event_id, row_number() over (partition by session_key order by event_id) as observation_no, case when length(content) > 4000 then substr(content, 1, 4000) || chr(10) || '... [truncated ' || (length(content) - 4000) || ' chars]' else content end as observation from ev where r = 'tool' and coalesce(content, '') <> '' and session_key is not null")
def observation_numbering(spark, folder):
    rows = _events(spark, folder).where("role = 'tool' and coalesce(content, '') <> '' and session_key is not null")
    return R.numbered(rows.select("session_key", "event_id", "content")).select("session_key", "event_id", "observation_no", R.truncated_text(F.col("content"), 4000).alias("observation"))


@query(f"with {_CALLS}, l as (select session_key, call_id, max_by(tool, event_id * 1000 + call_no) as tool, max(event_id) as call_event_id from calls where call_id is not null group by session_key, call_id) select ev.session_key, ev.tool_call_id as call_id, ev.event_id as result_id, l.call_event_id, l.tool from ev left join l on l.session_key = ev.session_key and l.call_id = ev.tool_call_id where ev.r = 'tool'")
def call_result_join(spark, folder):
    rows = _events(spark, folder)
    return R.call_results(rows, R.calls(rows)).select("session_key", "call_id", "result_id", "call_event_id", "tool")


@query(f"with {_CALLS}, s as (select session_key, count(*) as n, min(tool) as tool from calls group by session_key) select session_key, n as n_calls, case when n = 1 and tool in ('read_file', 'sample_color', 'write_file', 'list_dir', 'edit_file') then 'single_' || tool when n > 12 then 'too_many_calls' end as reason from s")
def call_quality(spark, folder):
    counts = R.calls(_events(spark, folder)).groupBy("session_key").agg(F.count("*").alias("n_calls"), F.min("tool").alias("tool"))
    single = (F.col("n_calls") == 1) & F.col("tool").isin(*R.LOW_VALUE_TOOLS)
    return counts.select("session_key", "n_calls", F.when(single, F.concat(F.lit("single_"), F.col("tool"))).when(F.col("n_calls") > 12, "too_many_calls").alias("reason"))


@query(f"with {_CALLS}, s as (select session_key, count(*) as n, min(tool) as tool from calls group by session_key) select session_key, 'single_' || tool as reason from s where n = 1 and tool in ('read_file', 'sample_color', 'write_file', 'list_dir', 'edit_file')")
def single_low_value(spark, folder):
    counts = R.calls(_events(spark, folder)).groupBy("session_key").agg(F.count("*").alias("n"), F.min("tool").alias("tool"))
    return counts.where((F.col("n") == 1) & F.col("tool").isin(*R.LOW_VALUE_TOOLS)).select("session_key", F.concat(F.lit("single_"), "tool").alias("reason"))


@query(f"with {_CALLS} select session_key, count(*) as n_calls from calls group by session_key having count(*) > 12")
def too_many_calls(spark, folder):
    return R.calls(_events(spark, folder)).groupBy("session_key").agg(F.count("*").alias("n_calls")).where("n_calls > 12")


@query(f"with {_CALLS} select session_key, max(event_id) filter (where tool = 'computer_use') is not null as has_tool, coalesce(max(event_id) filter (where tool = 'computer_use') = max(event_id), false) as is_last from calls group by session_key")
def terminator_last(spark, folder):
    return R.terminator_last(R.calls(_events(spark, folder)))


@query(f"with {_CALLS}, p as (select session_key, unnest(regexp_extract_all(content, 'Saved to: (\\S+)', 1)) as path from ev where r = 'tool' union all select session_key, json_extract_string(case when json_valid(arguments) then arguments end, '$.path') from calls where tool = 'write_file') select session_key, path, count(*) as n from p where regexp_matches(lower(path), '\\.(png|jpg|jpeg|gif|bmp|webp)$') group by session_key, path")
def written_images(spark, folder):
    rows = _events(spark, folder)
    return R.written_images(rows, R.calls(rows))


_OBS = f"""{_CALLS}, l as (select session_key, call_id, max_by(tool, event_id * 1000 + call_no) as tool, max_by(coalesce(arguments, '{{}}'), event_id * 1000 + call_no) as arguments from calls where call_id is not null group by session_key, call_id),
o as (select ev.session_key, ev.event_id, coalesce(l.tool, 'unknown_tool') as tool, ev.content from ev left join l on l.session_key = ev.session_key and l.call_id = ev.tool_call_id where ev.r = 'tool' and ev.session_key is not null and regexp_replace(coalesce(ev.content, ''), '\\s', '', 'g') <> '')"""


@query(f"with {_OBS} select session_key, event_id, row_number() over (partition by session_key order by event_id) as observation_no, tool, length(content)::int as n_chars from o where tool <> 'list_dir'")
def session_observations(spark, folder):
    rows = _events(spark, folder).where("session_key is not null")
    told = R.observations(rows, R.calls(rows), without=("list_dir",))
    return told.select("session_key", "event_id", "observation_no", "tool", F.char_length("response").alias("n_chars"))


@query(f"with {_OBS}, a as (select session_key, max(item_id) as item_id from sessions where session_key is not null group by session_key), i as (select item_id, max(trim(answer, ' ')) as answer from items where item_id is not null group by item_id) select o.session_key, count(*) as n_responses, sum(length(o.content))::bigint as text_chars, coalesce(bool_or(length(i.answer) >= 3 and contains(o.content, i.answer)), false) as has_answer, count(*) filter (where o.tool in ('computer_use', 'write_file')) as n_channel from o left join a using (session_key) left join i using (item_id) group by o.session_key")
def prefix_audit(spark, folder):
    rows = _events(spark, folder).where("session_key is not null")
    answers = _t(spark, folder, "items").where("item_id is not null").groupBy("item_id").agg(F.max(F.trim("answer")).alias("reference"))
    known = _t(spark, folder, "sessions").where("session_key is not null").groupBy("session_key").agg(F.max("item_id").alias("item_id")).join(answers, "item_id", "left")
    return R.prefix_audit(R.observations(rows, R.calls(rows)), known).select("session_key", "n_responses", "text_chars", "has_answer", "n_channel")


@query(f"with {_SAMPLES} select task_key, sample_no::int as sample_no, u.step as step, k::int as call_no, r.name as tool, r.error as error from (select task_key, sample_no, u, k, u.tool_results[k + 1] as r from (select *, unnest(range(len(u.tool_results))) as k from u where u is not null and u.tool_results is not null)) where r is not null and r.name is not null")
def turn_observations(spark, folder):
    rows = _t(spark, folder, "task_results").where("task_key is not null").select("task_key", "samples").dropDuplicates(["task_key"])
    return R.turn_observations(rows).select("task_key", "sample_no", "step", "call_no", "tool", "error")


@query()
def session_verdicts(spark, folder):
    rows = _events(spark, folder).where("session_key is not null")
    items = _t(spark, folder, "items").where("item_id is not null").groupBy("item_id").agg(F.max("answer").alias("reference"))
    known = _t(spark, folder, "sessions").where("session_key is not null").groupBy("session_key").agg(F.max("item_id").alias("item_id")).join(items, "item_id")
    facts = A.with_method(written(R.session_facts(rows, R.calls(rows), known), "session-facts"), "answer", "reference", 0.02)
    right = F.col("method") != "none"
    stage, reason = S.rejected(R.session_rules(right | F.col("has_tool")))
    return facts.select("session_key", stage.alias("stage"), reason.alias("reason"))


_QUALITY = f"""{_CALLS}, c as (select session_key, count(*) as n, min(tool) as tool from calls group by session_key), m as (select session_key, bool_or(r = 'assistant' and coalesce(content, '') <> '') as answered from ev group by session_key),
q as (select m.session_key, case when not m.answered then 'correctness' when c.n is null then 'correctness' when c.n = 1 and c.tool in ('read_file', 'sample_color', 'write_file', 'list_dir', 'edit_file') then 'quality' when c.n > 12 then 'quality' end as stage, case when not m.answered then 'no_response' when c.n is null then 'no_tool_calls' when c.n = 1 and c.tool in ('read_file', 'sample_color', 'write_file', 'list_dir', 'edit_file') then 'single_low_value' when c.n > 12 then 'too_many_calls' end as reason from m left join c on c.session_key = m.session_key)"""


def _rejections(spark, folder):
    rows = _events(spark, folder)
    counts = R.calls(rows).groupBy("session_key").agg(F.count("*").alias("n"), F.min("tool").alias("tool"))
    each = rows.groupBy("session_key").agg(F.max((F.col("role") == "assistant") & (F.coalesce("content", F.lit("")) != "")).alias("answered")).join(counts, "session_key", "left")
    low = (F.col("n") == 1) & F.col("tool").isin(*R.LOW_VALUE_TOOLS)
    stage, reason = S.rejected([("correctness", "no_response", ~F.coalesce("answered", F.lit(False))), ("correctness", "no_tool_calls", F.col("n").isNull()), ("quality", "single_low_value", low), ("quality", "too_many_calls", F.col("n") > 12)])
    return each.select("session_key", stage.alias("stage"), reason.alias("reason"))


@query(f"with {_QUALITY} select stage, reason, count(*) as n from q where stage is not null group by rollup(stage, reason)")
def rejection_rollup(spark, folder):
    return S.rejection_rollup(_rejections(spark, folder))


@query(f"with {_EV}, p as (select session_key, unnest(regexp_extract_all(content, '(?i)saved to: (\\S+)', 1)) as path from ev where r = 'tool') select session_key, path, count(*) as n from p where regexp_matches(lower(path), '\\.(png|jpg|jpeg|gif|bmp|webp)$') group by session_key, path having count(*) > 1")
def duplicate_paths(spark, folder):
    paths = _events(spark, folder).where("role = 'tool'").select("session_key", F.explode(R.saved_paths(F.col("content"))).alias("path"))
    return paths.groupBy("session_key", "path").agg(F.count("*").alias("n")).where("n > 1")


@query(f"with {_EV}, x as (select session_key, regexp_replace(coalesce(content, '') || chr(10) || (case when r = 'assistant' then coalesce(tool_calls, '') else '' end), '/mnt/data\\b|/tmp\\b', 'X', 'g') as c from ev), p as (select session_key, regexp_replace(coalesce(media_dir, ''), '/mnt/data\\b|/tmp\\b', 'X', 'g') as c from sessions), u as (select * from x union all select * from p) select session_key, bool_or(regexp_matches(c, '(^|[^A-Za-z0-9_.-])/(mnt|home|root|Users|opt|srv|var|etc|usr)/[^\\s\"\'\'<>]+')) as hit from u group by session_key")
def host_path_hits(spark, folder):
    media = _t(spark, folder, "sessions").select("session_key", F.coalesce("media_dir", F.lit("")).alias("system_prompt"))
    rows = _events(spark, folder)
    every = rows.select("session_key").unionByName(media.select("session_key")).distinct()
    hit = R.host_path_sessions(rows, media).withColumn("hit", F.lit(True))
    return every.join(hit, every["session_key"].eqNullSafe(hit["session_key"]), "left").select(every["session_key"], F.coalesce("hit", F.lit(False)).alias("hit"))


@query("with f as (select distinct item_index, unnest(images) as image from items), s as (select distinct unnest(images) as image from sft_samples) select f.item_index, f.image from f where f.image is not null and not exists (select 1 from s where s.image = f.image)")
def missing_media(spark, folder):
    wanted = _t(spark, folder, "items").select("item_index", F.explode("images").alias("image")).where("image is not null").distinct()
    there = _t(spark, folder, "sft_samples").select(F.explode("images").alias("image")).distinct()
    return wanted.join(there, "image", "left_anti").select("item_index", "image")


@query("select doc_id from documents where " + " or ".join(f"contains(lower(text), '{p}')" for p in R.RETRYABLE))
def retryable_errors(spark, folder):
    hit = F.lit(False)
    for p in R.RETRYABLE:
        hit = hit | F.contains(F.lower("text"), F.lit(p))
    return _t(spark, folder, "documents").where(hit).select("doc_id")


@query(f"with {_CALLS}, c as (select session_key, event_id, call_no, json_extract_string(case when json_valid(arguments) then arguments end, '$.command') as command from calls where tool = 'exec') select session_key, event_id, call_no::bigint as call_no, case when command is null then null when not regexp_matches(lower(trim(command, ' ')), '--limit [1-4]') then 'not_allowed' when contains(command, '/mnt/data/m') then 'outside' else 'ok' end as verdict from (select session_key, event_id, call_no, replace(command, '/mnt/data/m', '/srv/mnt/data/m') as command from c)")
def command_guard(spark, folder):
    made = R.calls(_events(spark, folder)).where("tool = 'exec'")
    # some of the paths are moved out of the working directory, so that each verdict occurs
    command = F.replace(F.try_variant_get(F.try_parse_json("arguments"), "$.command", "string"), F.lit("/mnt/data/m"), F.lit("/srv/mnt/data/m"))
    return made.select("session_key", "event_id", F.col("call_no").cast("long").alias("call_no"), AU.command_verdict(command, ["--limit [1-4]"], "/mnt/data").alias("verdict"))


@query(f"with {_EV} select event_id from ev where r in ('user', 'assistant') and contains(lower(concat_ws(' ', r, content, tool_calls)), 'legend')")
def event_search(spark, folder):
    text = F.lower(F.concat_ws(" ", "role", "content", "tool_calls"))
    return _events(spark, folder).where(F.col("role").isin("user", "assistant") & text.contains("legend")).select("event_id")


@query("select doc_id, regexp_matches(u, '(?i)^https?://[^/?#\\s]+') as valid from (select doc_id, (case doc_id % 4 when 0 then 'http://' when 1 then 'HTTPS://' when 2 then 'ftp://' else 'https:///' end) || run_id as u from documents where run_id is not null)")
def url_validity(spark, folder):
    scheme = F.element_at(F.array(*map(F.lit, ("http://", "HTTPS://", "ftp://", "https:///"))), (F.col("doc_id") % 4 + 1).cast("int"))
    return _t(spark, folder, "documents").where("run_id is not null").select("doc_id", AU.valid_url(F.concat(scheme, "run_id")).alias("valid"))


@query("select 'supplier' as origin, s_suppkey as id, s_name as name, s_nationkey as nation from supplier union all select 'customer', c_custkey, c_name, c_nationkey from customer")
def union_inputs(spark, folder):
    a = _t(spark, folder, "supplier").select(F.lit("supplier").alias("origin"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    b = _t(spark, folder, "customer").select(F.lit("customer").alias("origin"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    return a.unionByName(b, allowMissingColumns=True)


# --- text

#: Numbers as the engine's pattern finds them: a letter takes the sign or digit behind it, what begins with a letter is none.
_NUMBERS = "list_transform(list_filter(regexp_extract_all(text, '[a-zA-Z][-+0-9]?|[-+]?[0-9]+(?:\\.[0-9]+)?(?:[eE][-+]?[0-9]+)?%?'), lambda s: not regexp_matches(s, '^[a-zA-Z]')), lambda s: try_cast(replace(s, '%', '') as double))"


@query("select doc_id, len(regexp_extract_all(text, '\\*\\*(.+?)\\*\\*', 1)) as n_bold, list_extract(regexp_extract_all(text, '\\*\\*(.+?)\\*\\*', 1), 1) as first_bold from documents where text is not null")
def bold_extract(spark, folder):
    found = A.bold(F.col("text"))
    return _t(spark, folder, "documents").where("text is not null").select("doc_id", F.size(found).cast("long").alias("n_bold"), F.try_element_at(found, F.lit(1)).alias("first_bold"))


@query(f"with {_RES} select task_key, regexp_replace(pred, '(?s)<think>.*?</think>|<tool_call>.*?</tool_call>', '', 'g') as answer from t where pred is not null")
def think_strip(spark, folder):
    rows = _t(spark, folder, "task_results").where("task_key is not null and pred is not null").select("task_key", "pred").dropDuplicates(["task_key"])
    return rows.select("task_key", A.without_blocks(F.col("pred")).alias("answer"))


@query(f"with {_RES}, w as (select task_key, regexp_extract_all(upper(judge_raw), '\\b(YES|NO)\\b', 1) as v from t where judge_raw is not null) select task_key, case when len(v) > 0 then v[len(v)] = 'YES' end as verdict from w")
def yes_no_parse(spark, folder):
    rows = _t(spark, folder, "task_results").where("task_key is not null and judge_raw is not null").select("task_key", "judge_raw").dropDuplicates(["task_key"])
    return rows.select("task_key", A.last_yes_no(F.col("judge_raw")).alias("verdict"))


@query(f"with x as (select doc_id, {_NUMBERS} as v from documents where text is not null) select doc_id, len(v) as n_numbers, list_extract(v, 1) as first_number from x")
def number_extract(spark, folder):
    rows = _t(spark, folder, "documents").where("text is not null").select("doc_id", A.numbers(F.col("text")).alias("v"))
    return rows.select("doc_id", F.size("v").cast("long").alias("n_numbers"), F.try_element_at("v", F.lit(1)).alias("first_number"))


@query(f"with x as (select doc_id, {_NUMBERS} as l from documents where text is not null), y as (select doc_id, unnest(l) as v, generate_subscripts(l, 1) as i from x) select doc_id, v as nearest from y where v is not null qualify row_number() over (partition by doc_id order by abs(v - 500), i) = 1")
def nearest_number(spark, folder):
    # a document's numbers stay in its row: no shuffle
    near = A.nearest(A.numbers(F.col("text")), F.lit(500.0))
    return _t(spark, folder, "documents").where("text is not null").select("doc_id", near.alias("nearest")).where("nearest is not null")


@query("select p_partkey, p_size, abs(p_size - 25) / 25.0 <= 0.2 as close from part")
def numeric_close(spark, folder):
    return _t(spark, folder, "part").select("p_partkey", "p_size", A.numeric_close(F.col("p_size").cast("double"), F.lit(25.0), 0.2).alias("close"))


@query(r"with n as (select distinct item_index, lower(trim(answer, ' ')) as a from items where answer is not null), f as (select *, case when regexp_full_match(a, '[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?%*') then try_cast(replace(a, '%', '') as double) end as v from n) select item_index, case when v is null then a when v = floor(v) and not contains(a, 'e') then v::bigint::varchar else v::varchar end as normalized from f")
def normalize_answer(spark, folder):
    return _t(spark, folder, "items").where("answer is not null").select("item_index", "answer").distinct().select("item_index", A.normalized_answer(F.col("answer")).alias("normalized"))


@query(f"select doc_id, array_to_string(regexp_extract_all(text, '(?i)[^.。\n]*(?:{A.SIGNAL_PATTERN})[^.。\n]*'), ' ') as told from documents where text is not null")
def answer_sentences(spark, folder):
    return _t(spark, folder, "documents").where("text is not null").select("doc_id", A.answer_sentences(F.col("text")).alias("told"))


@query("with d as (select text, doc_id, lower(case doc_id % 3 when 0 then '2' when 1 then 'no' else '4' end) as q from documents where text is not null) select doc_id, regexp_matches(text, '(?i)(?:answer|result|total|difference|gap|value|count|sum)\\s*(?:is|=|:)\\s*\\**\\s*' || q || '(?:[^\\pL\\pN_]|$)') or regexp_matches(text, '(?i)=\\s*\\**\\s*' || q || '(?:\\s*$|\\s+[^\\s%)\\]]|[^\\pL\\pN_\\s%)\\]])') or regexp_matches(text, '(?i)\\*\\*' || q || '\\*\\*') or regexp_matches(text, '(?i)\\\\{1,2}boxed\\{\\s*' || q || '\\s*\\}') as in_context from d")
def answer_context(spark, folder):
    q = F.element_at(F.array(F.lit("2"), F.lit("no"), F.lit("4")), (F.col("doc_id") % 3 + 1).cast("int"))
    return _t(spark, folder, "documents").where("text is not null").select("doc_id", A.has_answer_context(F.col("text"), q).alias("in_context"))


@query("select doc_id, regexp_replace(text, '\\[(?:Image file paths — use these in scripts|File paths — read these using tools such as read_file)\\]\\n(?:- [^\\n]*\\n)+\\n', '', 'g') as text from (select doc_id, case when doc_id % 2 = 0 then '[Image file paths — use these in scripts]' || chr(10) || '- /mnt/data/' || doc_id || '.png' || chr(10) || chr(10) || text else text end as text from documents where text is not null)")
def hint_strip(spark, folder):
    hint = F.concat(F.lit("[Image file paths — use these in scripts]\n- /mnt/data/"), F.col("doc_id").cast("string"), F.lit(".png\n\n"))
    told = F.when(F.col("doc_id") % 2 == 0, F.concat(hint, "text")).otherwise(F.col("text"))
    return _t(spark, folder, "documents").where("text is not null").select("doc_id", C.without_hint(told).alias("text"))


@query("select doc_id, nullif(regexp_extract(text, '^\\s*(\\d{1,9})\\s*[xX,]\\s*(\\d{1,9})\\s*$', 1), '')::int as width, nullif(regexp_extract(text, '^\\s*(\\d{1,9})\\s*[xX,]\\s*(\\d{1,9})\\s*$', 2), '')::int as height from (select item_index as doc_id, coalesce(case item_index % 3 when 0 then width || 'x' || height when 1 then ' ' || width || ' , ' || height else answer end, '') as text from (select distinct on (item_index) * from items))")
def viewport_parse(spark, folder):
    size = F.when(F.col("item_index") % 3 == 0, F.concat(F.col("width").cast("string"), F.lit("x"), F.col("height").cast("string"))).when(F.col("item_index") % 3 == 1, F.concat(F.lit(" "), F.col("width").cast("string"), F.lit(" , "), F.col("height").cast("string"))).otherwise(F.col("answer"))
    view = H.viewport(F.coalesce(size, F.lit("")))
    return _t(spark, folder, "items").dropDuplicates(["item_index"]).select(F.col("item_index").alias("doc_id"), view["width"].alias("width"), view["height"].alias("height"))


@query("select doc_id, case when length(text) > 400 then substr(text, 1, 400) || chr(10) || '... [truncated ' || (length(text) - 400) || ' chars]' else text end as short from documents where text is not null")
def truncate_text(spark, folder):
    return _t(spark, folder, "documents").where("text is not null").select("doc_id", R.truncated_text(F.col("text"), 400).alias("short"))


@query("select doc_id, trim(regexp_replace(run_id || '/' || coalesce(session_key, ''), '[<>:\"/\\\\|?*]', '_', 'g'), E' \\t\\n') as safe, coalesce(nullif(regexp_replace(regexp_replace(coalesce(nullif(source, ''), 'dataset'), '[^A-Za-z0-9_.-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'dataset') || '_' || doc_id as task_key from documents where run_id is not null")
def sanitize_key(spark, folder):
    name = F.concat("run_id", F.lit("/"), F.coalesce("session_key", F.lit("")))
    return _t(spark, folder, "documents").where("run_id is not null").select("doc_id", C.safe_name(name).alias("safe"), C.task_key(F.col("source"), F.col("doc_id").cast("string")).alias("task_key"))


@query("select doc_id, sha256(text) as digest, substr(sha1(text), 1, 9) as short_digest from documents where text is not null")
def content_hash(spark, folder):
    return _t(spark, folder, "documents").where("text is not null").select("doc_id", F.sha2("text", 256).alias("digest"), C.short_digest(F.col("text")).alias("short_digest"))


@query(f"with {_EV}, s as (select session_key, max(media_dir) as media_dir from sessions where session_key is not null group by session_key) select event_id, case when s.media_dir <> '' then replace(replace(content, '/mnt/data', s.media_dir), s.media_dir, '/mnt/data') else content end as text, case when s.media_dir <> '' then replace(content, '/mnt/data', s.media_dir) else content end as host_text from ev left join s using (session_key) where content is not null")
def path_rewrite(spark, folder):
    roots = _t(spark, folder, "sessions").where("session_key is not null").groupBy("session_key").agg(F.max("media_dir").alias("media_dir"))
    rows = _events(spark, folder).where("content is not null").select("event_id", "session_key", "content").join(roots, "session_key", "left")
    host = C.host_paths(F.col("content"), F.col("media_dir"))
    return rows.select("event_id", C.virtual_paths(host, F.col("media_dir")).alias("text"), host.alias("host_text"))


@query()
def check_match(spark, folder):
    items = _t(spark, folder, "items").where("item_id is not null and answer is not null").groupBy("item_id").agg(F.max("answer").alias("answer"))
    rows = _t(spark, folder, "task_results").where("task_key is not null").select("task_key", "item_id", "pred").dropDuplicates(["task_key"]).join(items, "item_id")
    return A.with_method(rows, "pred", "answer", 0.02).select("task_key", "method")


@query()
def boxed_extract(spark, folder):
    rows = _t(spark, folder, "task_results").where("task_key is not null and pred is not null").select("task_key", "pred").dropDuplicates(["task_key"])
    return rows.select("task_key", F.explode(A.boxed("pred")).alias("boxed"))


@query(f"with {_RES}, g as (select item_id, max(answer) as answer from items where item_id is not null group by item_id) select t.task_key, length(trim(g.answer, ' ')) >= 3 and contains(t.pred, trim(g.answer, ' ')) as literal from t join g using (item_id) where t.pred is not null and g.answer is not null")
def literal_overlap(spark, folder):
    items = _t(spark, folder, "items").where("item_id is not null").groupBy("item_id").agg(F.max("answer").alias("answer")).where("answer is not null")
    rows = _t(spark, folder, "task_results").where("task_key is not null and pred is not null").select("task_key", "item_id", "pred").dropDuplicates(["task_key"]).join(items, "item_id")
    return rows.select("task_key", ((F.char_length(F.trim("answer")) >= 3) & F.contains("pred", F.trim("answer"))).alias("literal"))


_WORD = H.WORD.replace("'", "''")
_STOP = ", ".join(f"'{w}'" for w in H.BOILERPLATE)


@query(f"with {_RES}, x as (select task_key, list_distinct(list_filter(list_transform(regexp_extract_all(pred, '{_WORD}'), lambda w: lower(w)), lambda w: length(w) >= 3 and w not in ({_STOP}))) as p, list_distinct(list_filter(list_transform(regexp_extract_all(gt, '{_WORD}'), lambda w: lower(w)), lambda w: length(w) >= 3 and w not in ({_STOP}))) as g from t where pred is not null and gt is not null) select task_key, case when len(g) = 0 then 1.0 else round(len(list_intersect(p, g)) / len(g), 6) end as recall from x")
def token_recall(spark, folder):
    rows = _t(spark, folder, "task_results").where("task_key is not null and pred is not null and gt is not null").select("task_key", "pred", "gt").dropDuplicates(["task_key"])
    return rows.select("task_key", F.round(H.set_recall(H.text_tokens(F.col("pred")), H.text_tokens(F.col("gt"))), 6).alias("recall"))


@query()
def html_stats(spark, folder):
    # `source` may be wrong or missing: a page is what looks like one, besides what is called one
    pages = _t(spark, folder, "documents").where("text is not null").where((F.col("source") == "page_dump") | H.looks_like_html(F.col("text")))
    rows = pages.select("doc_id", H.html_stats("text").alias("s"))
    return rows.select("doc_id", "s.total_tags", F.map_keys("s.tags").alias("tags"), F.char_length("s.text").alias("text_chars"), "s.has_css")


@query()
def html_rule_check(spark, folder):
    rows = _t(spark, folder, "task_results").where("task_key is not null and pred is not null").select("task_key", "pred", "gt").dropDuplicates(["task_key"]).withColumn("page", H.extracted(F.col("pred")))
    pages = rows.where(H.looks_like_html(F.col("page")))
    stats = pages.withColumns({"p": H.html_stats("page"), "g": H.html_stats("gt")})
    return stats.select("task_key", H.rule_check(F.col("page"), F.col("p"), F.col("g")).alias("c")).select("task_key", "c.*")


@query("select doc_id, regexp_matches(text, '(?is)<\\s*(?:!doctype\\s+html|html|head|body|main|section|div)\\b') as is_html from documents where text is not null")
def looks_like_html(spark, folder):
    return _t(spark, folder, "documents").where("text is not null").select("doc_id", H.looks_like_html(F.col("text")).alias("is_html"))


@query("with a as (select doc_id, regexp_replace(text, '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<[^>]+>', ' ', 'g') as t from documents where text is not null) select doc_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', \'\'\'\'), '&nbsp;', ' '), '&amp;', '&'), '[ \\t\\r\\n]+', ' ', 'g'), ' ') as plain from a")
def html_to_text(spark, folder):
    return _t(spark, folder, "documents").where("text is not null").select("doc_id", H.plain_text(F.col("text")).alias("plain"))


@query()
def html_extract(spark, folder):
    rows = _t(spark, folder, "task_results").where("task_key is not null and pred is not null").select("task_key", "pred").dropDuplicates(["task_key"])
    return rows.select("task_key", H.extracted(F.col("pred")).alias("by_priority"), H.extracted_by_position(F.col("pred")).alias("by_position"), H.extracted_by_fence(F.col("pred")).alias("by_fence"))


_TAGS = "list_transform(regexp_extract_all({0}, '<([a-zA-Z][a-zA-Z0-9]*)', 1), lambda x: lower(x))"


@query(f"with {_RES}, x as (select task_key, {_TAGS.format('pred')} as a, {_TAGS.format('gt')} as b from t where pred is not null and gt is not null), k as (select task_key, a, b, unnest(list_distinct(list_concat(a, b))) as tag from x), c as (select task_key, len(list_filter(a, lambda y: y = tag)) as n, len(list_filter(b, lambda y: y = tag)) as m from k) select x.task_key, coalesce((select round(sum(least(n, m)) / sum(greatest(n, m)), 6) from c where c.task_key = x.task_key), 1.0) as jaccard from x")
def bag_jaccard(spark, folder):
    rows = _t(spark, folder, "task_results").where("task_key is not null and pred is not null and gt is not null").select("task_key", "pred", "gt").dropDuplicates(["task_key"])
    tags = lambda c: H.bag(F.transform(F.regexp_extract_all(c, F.lit("<([a-zA-Z][a-zA-Z0-9]*)"), 1), F.lower))
    return rows.select("task_key", F.round(H.bag_jaccard(tags("pred"), tags("gt")), 6).alias("jaccard"))


@query(f"with {_CALLS}, u as (select session_key, event_id, call_no, case when json_valid(arguments) then json(arguments) end as j from calls where tool = 'computer_use'), a as (select *, json_extract(j, '$.actions') as l from u) select session_key, event_id, call_no::bigint as call_no, json_extract_string(l, '$[0].type') as action, json_extract(l, '$[0].coordinate[0]')::double as x, json_extract(l, '$[0].coordinate[1]')::double as y from a")
def json_args(spark, folder):
    made = R.calls(_events(spark, folder)).where("tool = 'computer_use'")
    first = made.withColumn("p", G.call_coordinate(F.col("arguments"), "$.actions[0].coordinate"))
    return first.select("session_key", "event_id", F.col("call_no").cast("long").alias("call_no"), F.try_variant_get(F.try_parse_json("arguments"), "$.actions[0].type", "string").alias("action"), "p.x", "p.y")


@query("select sample_id, json_array_length(tools)::int as n_tools, json_extract_string(tools, '$[0].function.name') as first_tool from (select distinct on (sample_id) sample_id, case when json_valid(tools) then tools end as tools from sft_samples where sample_id is not null)")
def json_array_text(spark, folder):
    fenced = F.concat(F.lit("Tools:\n```json\n"), F.col("tools"), F.lit("\n```"))
    rows = _t(spark, folder, "sft_samples").where("sample_id is not null").dropDuplicates(["sample_id"]).select("sample_id", AU.json_array_in(fenced).alias("v"))
    return rows.select("sample_id", F.when(F.col("v").isNotNull(), F.size("v")).alias("n_tools"), F.try_variant_get(F.try_element_at("v", F.lit(1)), "$.function.name", "string").alias("first_tool"))


@query("select item_index, x1 <= x2 and y1 <= y2 as ordered, 500 / 1000.0 * width between least(x1, x2) and greatest(x1, x2) and 500 / 1000.0 * height between least(y1, y2) and greatest(y1, y2) as hit from (select item_index, width, height, v[1] as x1, v[2] as y1, v[3] as x2, v[4] as y2 from (select distinct item_index, width, height, try_cast(answer as double[]) as v from items where regexp_matches(answer, '^\\s*\\[') and width > 0 and height > 0) where len(v) = 4)")
def point_in_bbox(spark, folder):
    rows = _t(spark, folder, "items").where(F.col("answer").rlike(r"^\s*\[") & (F.col("width") > 0) & (F.col("height") > 0)).select("item_index", "width", "height", G.bbox_of(F.col("answer")).alias("b")).where("b is not null").distinct()
    b = F.col("b")
    p = F.struct((F.lit(500.0) / 1000.0 * F.col("width")).alias("x"), (F.lit(500.0) / 1000.0 * F.col("height")).alias("y"))
    ordered = (b["x1"] <= b["x2"]) & (b["y1"] <= b["y2"])
    return rows.select("item_index", ordered.alias("ordered"), G.point_in_box(p, G.box(b["x1"], b["y1"], b["x2"], b["y2"])).alias("hit"))


@query("select vec_id, round(case when a between 0 and 1 and b between 0 and 1 then a else a / 1000.0 end, 9) as x, round(case when a between 0 and 1 and b between 0 and 1 then b else b / 1000.0 end, 9) as y from (select vec_id, embedding[1]::double as a, embedding[2]::double as b from embeddings)")
def coord_normalize(spark, folder):
    rows = _t(spark, folder, "embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("a"), F.col("embedding")[1].cast("double").alias("b"))
    p = G.unit_prediction(F.col("a"), F.col("b"))
    return rows.select("vec_id", F.round(p["x"], 9).alias("x"), F.round(p["y"], 9).alias("y"))


@query("select vec_id, abs(a - c) <= 0.1 and abs(b - d) <= 0.1 as close from (select vec_id, embedding[1]::double as a, embedding[2]::double as b, embedding[3]::double as c, embedding[4]::double as d from embeddings)")
def point_close(spark, folder):
    e = [F.col("embedding")[i].cast("double") for i in range(4)]
    a, b = (F.struct(e[i].alias("x"), e[i + 1].alias("y")) for i in (0, 2))
    return _t(spark, folder, "embeddings").select("vec_id", G.point_close(a, b, 0.1).alias("close"))


@query("with r as (select vec_id, list_transform(embedding, lambda v: round(v::double, 1) + 0.0) as v from embeddings), p as (select vec_id, unnest(v) as x, generate_subscripts(v, 1) as i from r), f as (select vec_id, x, min(i) as i from p group by vec_id, x) select vec_id, list(x order by i)::varchar as kept from f group by vec_id")
def ordered_dedupe(spark, folder):
    kept = F.array_distinct(F.transform("embedding", lambda v: F.round(v.cast("double"), 1)))
    return _t(spark, folder, "embeddings").select("vec_id", F.concat(F.lit("["), F.array_join(kept.cast("array<string>"), ", "), F.lit("]")).alias("kept"))


_CLICK = "p as (select task_key, t.pred, i.b, i.w, i.h, try_cast(regexp_extract(t.pred, '(-?[0-9]+(?:\\.[0-9]+)?)', 1) as double) as x, t.n_tool_calls::double * 10 as y from t join (select item_id, max(case when regexp_matches(answer, '^\\s*\\[') then answer end) as b, max(width)::double as w, max(height)::double as h from items where item_id is not null group by item_id) i using (item_id))"


@query(f"with {_RES}, {_CLICK}, q as (select task_key, w, h, x, y, try_cast(b as double[]) as v from p), z as (select *, len(v) = 4 as ok, x / 1000.0 * w as px, y / 1000.0 * h as py from q) select task_key, coalesce(ok and px between least(v[1], v[3]) and greatest(v[1], v[3]) and py between least(v[2], v[4]) and greatest(v[2], v[4]) and w > 0 and h > 0, false)::int as score, case when ok and px is not null and y is not null then 'tool_calls' end as source, case when ok and y is not null then round(px, 2) end as px from z")
def grounding_score(spark, folder):
    items = _t(spark, folder, "items").where("item_id is not null").groupBy("item_id").agg(F.max(F.when(F.col("answer").rlike(r"^\s*\["), F.col("answer"))).alias("b"), F.max("width").cast("double").alias("w"), F.max("height").cast("double").alias("h"))
    rows = _t(spark, folder, "task_results").where("task_key is not null").select("task_key", "item_id", "pred", "n_tool_calls").dropDuplicates(["task_key"]).join(items, "item_id")
    x, y = F.nullif(F.regexp_extract("pred", r"(-?[0-9]+(?:\.[0-9]+)?)", 1), F.lit("")).try_cast("double"), F.col("n_tool_calls").cast("double") * 10
    click = G.click_point(F.when(x.isNotNull() & y.isNotNull(), F.struct(x.alias("x"), y.alias("y"))), F.lit(""))
    told = rows.select("task_key", G.grounding_score(click, G.bbox_of(F.col("b")), F.col("w"), F.col("h")).alias("s"))
    return told.select("task_key", "s.score", F.when(F.col("s.px").isNotNull(), F.col("s.source")).alias("source"), "s.px")


@query("with s as (select distinct item_index, width::double as w, height::double as h from items where width > 0 and height > 0), r as (select *, greatest(28, round_even(h / 28, 0) * 28) as hb, greatest(28, round_even(w / 28, 0) * 28) as wb, sqrt(h * w / (16384 * 784)::double) as sh, sqrt((4 * 784)::double / (h * w)) as gr from s) select item_index, (case when hb * wb > 16384 * 784 then floor(h / sh / 28) * 28 when hb * wb < 4 * 784 then ceil(h * gr / 28) * 28 else hb end)::bigint as height, (case when hb * wb > 16384 * 784 then floor(w / sh / 28) * 28 when hb * wb < 4 * 784 then ceil(w * gr / 28) * 28 else wb end)::bigint as width from r")
def smart_resize(spark, folder):
    rows = _t(spark, folder, "items").where("width > 0 and height > 0").select("item_index", "width", "height").distinct()
    r = G.smart_resize(F.col("height").cast("double"), F.col("width").cast("double"))
    return rows.select("item_index", r["height"].alias("height"), r["width"].alias("width"))


@query(f"with {_RES}, a as (select task_key, regexp_extract_all(pred, '(?is)<answer>(.*?)</answer>', 1) as l, pred from t where pred is not null), s as (select task_key, case when len(l) > 0 then l[len(l)] else pred end as scope from a), f as (select task_key, list_concat([(1, regexp_extract_all(scope, '(?i)pyautogui\\.\\w+\\(\\s*x\\s*=\\s*(-?\\d+(?:\\.\\d+)?)\\s*,\\s*y\\s*=\\s*(-?\\d+(?:\\.\\d+)?)', 1), regexp_extract_all(scope, '(?i)pyautogui\\.\\w+\\(\\s*x\\s*=\\s*(-?\\d+(?:\\.\\d+)?)\\s*,\\s*y\\s*=\\s*(-?\\d+(?:\\.\\d+)?)', 2))], [(2, regexp_extract_all(scope, '(?i)x\\s*=\\s*(-?\\d+(?:\\.\\d+)?)\\s*,\\s*y\\s*=\\s*(-?\\d+(?:\\.\\d+)?)', 1), regexp_extract_all(scope, '(?i)x\\s*=\\s*(-?\\d+(?:\\.\\d+)?)\\s*,\\s*y\\s*=\\s*(-?\\d+(?:\\.\\d+)?)', 2))], [(3, regexp_extract_all(scope, '[\\(\\[]\\s*(-?\\d+(?:\\.\\d+)?)\\s*,\\s*(-?\\d+(?:\\.\\d+)?)\\s*[\\)\\]]', 1), regexp_extract_all(scope, '[\\(\\[]\\s*(-?\\d+(?:\\.\\d+)?)\\s*,\\s*(-?\\d+(?:\\.\\d+)?)\\s*[\\)\\]]', 2))]) as c from s), g as (select task_key, list_filter(c, lambda z: len(z[2]) > 0)[1] as z from f) select task_key, z[2][len(z[2])]::double as x, z[3][len(z[3])]::double as y from g where z is not null")
def click_extract(spark, folder):
    rows = _t(spark, folder, "task_results").where("task_key is not null and pred is not null").select("task_key", "pred").dropDuplicates(["task_key"])
    return rows.select("task_key", G.last_click(F.col("pred")).alias("p")).where("p is not null").select("task_key", "p.x", "p.y")


@query()
def coordinate_match(spark, folder):
    items = _t(spark, folder, "items").where("item_id is not null and answer is not null").groupBy("item_id").agg(F.max(F.struct("answer", "width", "height")).alias("i"))
    rows = _t(spark, folder, "task_results").where("task_key is not null and pred is not null").select("task_key", "item_id", "pred").dropDuplicates(["task_key"]).join(items, "item_id")
    parsed = rows.select("task_key", F.col("i.width").alias("w"), F.col("i.height").alias("h"), G.reference_box("i.answer").alias("b"), G.points_in("pred").alias("points")).where("b is not null")
    a, z = (G.unit_reference(F.col("b")[i], F.col("b")[i + 1], F.col("w"), F.col("h")) for i in (0, 2))
    held = G.box(a["x"], a["y"], z["x"], z["y"])
    return parsed.select("task_key", F.exists("points", lambda p: G.point_in_box(G.unit_prediction(p[0], p[1]), held)).alias("hit"))


@query("select doc_id, length(case when length(text) > 4000 then substr(text, 1, 4000) || chr(10) || '... [truncated ' || (length(text) - 4000) || ' chars]' else text end) as n, regexp_replace(run_id || '/' || coalesce(session_key, ''), '[<>:\"/\\\\|?*]', '_', 'g') as safe, replace(text, '/mnt/data', '/work') = text as no_path, sha256(text) as digest from documents where text is not null and run_id is not null")
def text_plumbing(spark, folder):
    t = F.col("text")
    name = F.concat("run_id", F.lit("/"), F.coalesce("session_key", F.lit("")))
    return _t(spark, folder, "documents").where("text is not null and run_id is not null").select("doc_id", F.char_length(R.truncated_text(t, 4000)).cast("long").alias("n"), C.safe_name(name).alias("safe"), (F.replace(t, F.lit("/mnt/data"), F.lit("/work")) == t).alias("no_path"), F.sha2(t, 256).alias("digest"))


@query("""with recursive d as (select doc_id, text as t, -1 as chunk_no, '' as chunk from documents where text is not null and text <> ''), c as (select * from d union all
select doc_id, regexp_replace(substr(t, n + 1), '^\\s+', ''), chunk_no + 1, substr(t, 1, n) from (select *, case when length(t) <= 2000 then length(t) when strpos(r, chr(10)) between 1 and 1999 then 2000 - strpos(r, chr(10)) when strpos(r, ' ') between 1 and 1999 then 2000 - strpos(r, ' ') else 2000 end as n from (select *, reverse(substr(t, 1, 2000)) as r from c where t <> '')))
select doc_id, chunk_no, chunk from c where chunk_no >= 0""")
def chunk_text(spark, folder):
    return _t(spark, folder, "documents").where("text is not null").select("doc_id", F.posexplode(R.chunked(F.col("text"))).alias("chunk_no", "chunk"))


@query("select distinct item_index, trim(coalesce(case when trim(query, E' \\t\\n') <> '' then query end, case when trim(answer, E' \\t\\n') <> '' then answer end, ''), E' \\t\\n') as first_text from items")
def coalesce_text(spark, folder):
    rows = _t(spark, folder, "items").select("item_index", "query", "answer").distinct()
    field = lambda c: F.nullif(A.stripped(F.col(c)), F.lit(""))
    return rows.select("item_index", F.coalesce(field("query"), field("answer"), F.lit("")).alias("first_text"))


@query("select item_index, regexp_matches(coalesce(answer, ''), '^\\s*\\[\\s*-?[0-9.]+(\\s*,\\s*-?[0-9.]+){3}\\s*\\]\\s*$') and width is not null and height is not null as grounding from (select distinct item_index, answer, width, height from items)")
def grounding_items(spark, folder):
    rows = _t(spark, folder, "items").select("item_index", "answer", "width", "height").distinct()
    four = F.coalesce("answer", F.lit("")).rlike(r"^\s*\[\s*-?[0-9.]+(\s*,\s*-?[0-9.]+){3}\s*\]\s*$")
    return rows.select("item_index", (four & F.col("width").isNotNull() & F.col("height").isNotNull()).alias("grounding"))


@query("select distinct item_index, trim(split_part(system_prompt, chr(10) || chr(10) || '---' || chr(10) || chr(10), 1), E' \\t\\n') as prompt from (select row_number() over (order by session_key) as item_index, p as system_prompt from (select session_key, max(system_prompt) as p from sessions where session_key is not null and not starts_with(system_prompt, '[') group by session_key))")
def prompt_clean(spark, folder):
    rows = _t(spark, folder, "sessions").where("session_key is not null and not startswith(system_prompt, '[')").groupBy("session_key").agg(F.max("system_prompt").alias("p"))
    return rows.withColumn("item_index", F.row_number().over(Window.orderBy("session_key")).cast("long")).select("item_index", F.rtrim(C.prompt_text(F.col("p"))).alias("prompt"))


@query(f"with {_RES}, b as (select task_key, list_filter(list_transform(regexp_extract_all(pred, '(?is)```(?:html)?\\s*(.*?)```', 1), lambda x: trim(x, E' \\t\\n\\r')), lambda x: contains(x, '<') and contains(x, '>')) as l from t where pred is not null), u as (select task_key, unnest(l) as block, generate_subscripts(l, 1) as i from b) select task_key, block from u qualify row_number() over (partition by task_key order by length(block) desc, i) = 1")
def longest_block(spark, folder):
    return _t(spark, folder, "task_results").where("task_key is not null and pred is not null").select("task_key", "pred").dropDuplicates(["task_key"]).select("task_key", H.longest_fenced(F.col("pred")).alias("block")).where("block is not null")


@query(f"with {_RES}, n as (select task_key, regexp_extract(judge_raw, '(?:^|[^0-9])(100(?:\\.0+)?|[1-9]?[0-9](?:\\.[0-9]+)?)(?:[^0-9]|$)', 1) as s from t where judge_raw is not null) select task_key, try_cast(nullif(s, '') as double) as score from n")
def score_parse(spark, folder):
    rows = _t(spark, folder, "task_results").where("task_key is not null and judge_raw is not null").select("task_key", "judge_raw").dropDuplicates(["task_key"])
    return rows.select("task_key", H.score_in(F.col("judge_raw")).alias("score"))


# --- conversion and reshape


@query()
def sft_messages(spark, folder):
    prompts = _t(spark, folder, "sessions").where("session_key is not null").groupBy("session_key").agg(F.max("system_prompt").alias("p")).select("session_key", C.prompt_text(F.col("p")).alias("prompt"))
    return C.sft_messages(R.last_user_slice(_events(spark, folder).where("session_key is not null")), prompts)


_BLOCKS = """case when regexp_matches(content, '^\\s*\\[\\s*\\{') and json_valid(content) then cast(content as json[]) end"""
_BLOCK_TEXT = """case when len(list_filter(l, lambda x: json_extract_string(x, '$.type') is not null)) > 0 then array_to_string(list_transform(list_filter(l, lambda x: json_extract_string(x, '$.type') = 'text' and json_extract_string(x, '$.text') is not null), lambda x: json_extract_string(x, '$.text')), chr(10)) else content end"""


@query(f"""with {_EV}, f as (select session_key, max(event_id) filter (where r = 'user') as k from ev group by session_key), b as (select ev.session_key, event_id, r, content, tool_calls, {_BLOCKS} as l from ev join f using (session_key) where session_key is not null and (f.k is null or event_id >= f.k)),
t as (select *, {_BLOCK_TEXT} as body, coalesce(len(list_filter(l, lambda x: coalesce(json_extract_string(x, '$.image'), json_extract_string(x, '$.image_url.url')) is not null)), 0) as n_images, coalesce(try_cast(regexp_extract(content, '(?i)^\\[image viewed \\* (\\d+)\\]', 1) as int), 0) as n_viewed from b),
m as (select session_key, event_id, 0 as part, 'user' as role, repeat('<image>', n_images::bigint) || coalesce(body, '') as content from t where r = 'user' union all select session_key, event_id, 0, 'tool_response', repeat('<image>', n_viewed::bigint) || coalesce(content, '') from t where r = 'tool' union all select session_key, event_id, 0, 'assistant', body from t where r = 'assistant' and coalesce(content, '') <> '' union all select session_key, event_id, 1, 'tool_call', tool_calls from t where r = 'assistant' and coalesce(tool_calls, '') not in ('', '[]', 'null'))
select session_key, (row_number() over (partition by session_key order by event_id, part) - 1)::int as place, role, content from m""")
def sft_turns(spark, folder):
    samples = C.sft_messages(R.last_user_slice(_events(spark, folder).where("session_key is not null")))
    return samples.select("session_key", F.posexplode("messages").alias("place", "m")).select("session_key", "place", "m.role", "m.content")


@query("with s as (select distinct on (sample_id) sample_id, messages from sft_samples where sample_id is not null), m as (select sample_id, unnest(messages) as m from s) select m.role as role, count(*) as n, count(distinct sample_id) as n_samples, sum(coalesce(length(m.content), 0))::bigint as n_chars from m where m is not null group by 1")
def sft_roles(spark, folder):
    rows = _t(spark, folder, "sft_samples").where("sample_id is not null").select("sample_id", "messages").dropDuplicates(["sample_id"]).select("sample_id", F.explode("messages").alias("m")).where("m is not null")
    return rows.groupBy(F.col("m.role").alias("role")).agg(F.count("*").alias("n"), F.count_distinct("sample_id").alias("n_samples"), F.sum(F.coalesce(F.char_length("m.content"), F.lit(0))).cast("long").alias("n_chars"))


@query(f"with {_CALLS}, f as (select session_key, tool, min(event_id * 1000 + call_no) as first_at from calls where tool is not null group by session_key, tool), l as (select session_key, list(tool order by first_at) as t from f where tool not in ('read_file', 'exec') group by session_key), a as (select distinct session_key from f) select a.session_key, array_to_string(list_concat(['read_file', 'exec'], coalesce(l.t, [])), ',') as tools from a left join l on l.session_key = a.session_key where a.session_key is not null")
def tool_list_resolve(spark, folder):
    rows = C.used_tools(R.calls(_events(spark, folder).where("session_key is not null")), ["read_file", "exec"])
    return rows.select("session_key", F.array_join("tools", ",").alias("tools"))


@query(f"with {_EV} select session_key, count(*) as n_responses, count(*) filter (where regexp_matches(content, '(?i)^\\[image viewed')) as n_images, sum(length(content))::bigint as text_chars from ev where r = 'tool' and content is not null group by session_key")
def prefix_stats(spark, folder):
    rows = _events(spark, folder).where("role = 'tool' and content is not null")
    return rows.groupBy("session_key").agg(F.count("*").alias("n_responses"), F.count_if(F.col("content").rlike(r"(?i)^\[image viewed")).alias("n_images"), F.sum(F.char_length("content")).alias("text_chars"))


@query("select s.session_key, i.answer from (select session_key, max(item_id) as item_id from sessions where session_key is not null group by session_key) s left join (select item_id, max_by(answer, item_index) as answer from items where item_id is not null group by item_id) i using (item_id)")
def session_reference_join(spark, folder):
    sessions = _t(spark, folder, "sessions").where("session_key is not null").groupBy("session_key").agg(F.max("item_id").alias("item_id"))
    items = _t(spark, folder, "items").where("item_id is not null").groupBy("item_id").agg(F.max_by("answer", "item_index").alias("answer"))
    return sessions.join(items, "item_id", "left").select("session_key", "answer")


@query("with q as (select vec_id, embedding[1] as a, embedding[2] as b, embedding[3] as c from embeddings), g as (select floor(a * 8)::int as r, floor(b * 8)::int as g, floor(c * 8)::int as b, count(*) as n from q group by 1, 2, 3) select r, g, b, n, round(n / (select count(*) from q), 6) as share from g order by n desc, r, g, b limit 10")
def top_colours(spark, folder):
    e = F.col("embedding")
    rows = _t(spark, folder, "embeddings").select(*(F.floor(e[i] * F.lit(8).cast("float")).cast("int").alias(c) for i, c in enumerate("rgb")))
    counts = rows.groupBy("r", "g", "b").agg(F.count("*").alias("n"))
    total = rows.agg(F.count("*").alias("_all"))
    return counts.crossJoin(F.broadcast(total)).select("r", "g", "b", "n", F.round(F.col("n") / F.col("_all"), 6).alias("share")).orderBy(F.desc("n"), "r", "g", "b").limit(10)


# --- streams


@query("select time_bucket(interval '1 hour', ts) as window_start, time_bucket(interval '1 hour', ts) + interval '1 hour' as window_end, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2, 3")
def event_windows(spark, folder):
    return P.tumbling(_t(spark, folder, "events"), "ts", "1 hour", ["event_type"], "value")


@query("with w as (select *, unnest([time_bucket(interval '15 minutes', ts), time_bucket(interval '15 minutes', ts) - interval '15 minutes', time_bucket(interval '15 minutes', ts) - interval '30 minutes', time_bucket(interval '15 minutes', ts) - interval '45 minutes']) as window_start from events) select window_start, window_start + interval '1 hour' as window_end, event_type, count(*) as n, round(sum(value), 4) as total from w group by 1, 2, 3")
def sliding_windows(spark, folder):
    return P.tumbling(_t(spark, folder, "events"), "ts", "1 hour", ["event_type"], "value", "15 minutes")


@query("with g as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval '30 minutes' then 0 else 1 end as fresh from events), s as (select user_id, ts, sum(fresh) over (partition by user_id order by ts rows unbounded preceding) as k from g) select min(ts) as session_start, max(ts) + interval '30 minutes' as session_end, user_id, count(*) as n from s group by user_id, k")
def activity_sessions(spark, folder):
    return P.sessions_of(_t(spark, folder, "events"), "ts", "30 minutes", ["user_id"])


@query("select event_type, count(*) as n, round(sum(value), 4) as total from events group by event_type")
def progress_stream(spark, folder):
    """A stream over all rows there are, read in one available-now run, then aggregated: equal to the batch."""
    rows = P.drained(spark, P.read_table(spark, folder, "events").select("event_id", "event_type", "value"), "events")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


# --- nested records


@query()
def p4_found(spark, folder):
    return flatten.p4_nodes(spark, folder).select("root_table", "root_id", "node_path")


@query()
def p4_links(spark, folder):
    return flatten.p4_nodes(spark, folder)


@query(f"with {_CALLS} select c.event_id::varchar as root_id, 'tool_calls[' || c.call_no || ']' as node_path, c.call_no::bigint as place, c.call_id, c.tool, c.arguments from (select event_id, i as call_no, json_extract_string(a, '$[' || i || '].id') as call_id, coalesce(json_extract_string(a, '$[' || i || '].function.name'), json_extract_string(a, '$[' || i || '].name')) as tool, coalesce(json_extract_string(a, '$[' || i || '].function.arguments'), json_extract_string(a, '$[' || i || '].arguments')) as arguments from (select event_id, a, unnest(range(json_array_length(a)::bigint)) as i from (select event_id, case when json_type(j) = 'OBJECT' then json_array(j) else j end as a from (select event_id, case when json_valid(tool_calls) then json(tool_calls) end as j from ev where tool_calls is not null) where json_type(j) in ('OBJECT', 'ARRAY'))) where json_type(a, '$[' || i || ']') = 'OBJECT') c")
def p4_calls(spark, folder):
    # of the arguments the text, in which an object's blanks don't count
    return flatten.call_table(_t(spark, folder, "session_events"), "event_id").select("root_id", "node_path", "place", "call_id", "tool", "arguments")


@query("with s as (select distinct sample_id, messages from sft_samples where sample_id is not null), m as (select sample_id, i as place, messages[i + 1] as m from (select sample_id, messages, unnest(range(len(messages))) as i from s)) select distinct sample_id::varchar as root_id, 'messages[' || place || ']' as node_path, place::bigint as place, m.role as role, m.content as content from m where m is not null")
def p4_messages(spark, folder):
    rows = flatten.child_table(_t(spark, folder, "sft_samples"), "sample_id", "messages")
    return rows.select("root_id", "node_path", "place", F.col("item_role").alias("role"), F.col("item_content").alias("content"))


@query(f"with {_SAMPLES} select task_key as root_id, 'samples[' || sample_no || ']' as node_path, sample_no::bigint as place, s.sample_index as sample_index, s.pred as pred, s.score as score, s.error as error, s.stopped_reason as stopped_reason from s where s is not null")
def p4_samples(spark, folder):
    rows = flatten.child_table(_t(spark, folder, "task_results"), "task_key", "samples")
    return rows.select("root_id", "node_path", "place", *(F.col(f"item_{c}").alias(c) for c in ("sample_index", "pred", "score", "error", "stopped_reason")))


@query(f"with {_SAMPLES} select task_key as root_id, 'samples[' || sample_no || '].turns[' || turn_no || ']' as node_path, 'samples[' || sample_no || ']' as parent_path, turn_no::bigint as turn_no, u.step as step, u.finish_reason as finish_reason from u where u is not null")
def p4_turns(spark, folder):
    rows = flatten.child_table(_t(spark, folder, "task_results"), "task_key", "samples.turns")
    return rows.select("root_id", "node_path", "parent_path", F.col("place").alias("turn_no"), F.col("item_step").alias("step"), F.col("item_finish_reason").alias("finish_reason"))


@query(f"with {_SAMPLES}, r as (select task_key, sample_no, turn_no, k as place, u.tool_results[k + 1] as r from (select *, unnest(range(len(u.tool_results))) as k from u where u is not null and u.tool_results is not null)) select task_key as root_id, 'samples[' || sample_no || '].turns[' || turn_no || '].tool_results[' || place || ']' as node_path, 'samples[' || sample_no || '].turns[' || turn_no || ']' as parent_path, place::bigint as place, r.tool_call_id as tool_call_id, r.name as name, r.args as args, r.error as error from r where r is not null")
def p4_tool_results(spark, folder):
    rows = flatten.child_table(_t(spark, folder, "task_results"), "task_key", "samples.turns.tool_results")
    return rows.select("root_id", "node_path", "parent_path", "place", *(F.col(f"item_{c}").alias(c) for c in ("tool_call_id", "name", "args", "error")))
