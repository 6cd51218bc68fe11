"""Operators on message rows of sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions.text import instant
from tracelake.operators.ordered import running_counts

#: Tools whose single use tells nothing (fixed values).
LOW_VALUE_TOOLS = ("read_file", "sample_color", "write_file", "list_dir", "edit_file")
#: Parts of messages that mark an error worth a retry (fixed values).
RETRYABLE = ("error calling llm:", "error code: 400", "error code: 429", "error code: 500", "rate limit", "too many requests", "timeout", "timed out", "service unavailable", "temporarily unavailable", "connection error", "server error", "overloaded", "稍后再试", "业务错误", "超时")
#: How code saves an image (fixed value).
SAVES_IMAGE = r"""(?i)\.(?:savefig|save|imwrite)\s*\(\s*(?:f?['"])([^'"]+\.(?:png|jpg|jpeg|gif|bmp|webp))['"]"""
#: Absolute paths of a host; the virtual roots /mnt/data and /tmp aren't among them (fixed value).
HOST_PATH = r"(?<![A-Za-z0-9_.-])/(?!mnt/data(?:/|\b)|tmp(?:/|\b))(?:mnt|home|root|Users|opt|srv|var|etc|usr)/[^\s\"'<>]+"


def events(raw: DataFrame) -> DataFrame:
    """Message rows, each event once, with a clean role and ``at`` (microseconds)."""
    role = F.lower(F.trim("role"))
    return raw.where("event_id is not null").dropDuplicates(["event_id"]).withColumns({"role": role, "at": instant(F.col("timestamp_iso"))})


def last_user_slice(rows: DataFrame, order: str = "event_id") -> DataFrame:
    """Rows from the last user message of their session on; all rows of a session without one."""
    last = rows.groupBy("session_key").agg(F.max(F.when(F.col("role") == "user", F.col(order))).alias("_from"))
    return rows.join(last, "session_key").where(F.col("_from").isNull() | (F.col(order) >= F.col("_from"))).drop("_from")


def last_matching(rows: DataFrame, holds: Column, value: str, order: str = "event_id") -> DataFrame:
    """Of each session the value of the last row for which ``holds`` is true."""
    return rows.where(holds).groupBy("session_key").agg(F.max(F.struct(order, value)).getField(value).alias(value))


def calls(rows: DataFrame) -> DataFrame:
    """One row per call of an assistant: ``session_key, event_id, call_no, call_id, tool, arguments``.

    Arguments may be an object or JSON text, a bare object is one call, unreadable ``tool_calls`` have none.
    """
    parsed = F.try_parse_json(F.when(F.col("tool_calls").rlike(r"[\]}]\s*$"), F.col("tool_calls")))
    array = F.coalesce(F.try_variant_get(parsed, "$", "array<variant>"), F.when(F.schema_of_variant(parsed).startswith("OBJECT"), F.array(parsed)))
    each = rows.where("role = 'assistant' and tool_calls is not null").select("session_key", "event_id", F.posexplode(array).alias("call_no", "call"))
    name = F.coalesce(F.try_variant_get("call", "$.function.name", "string"), F.try_variant_get("call", "$.name", "string"))
    arguments = F.coalesce(F.try_variant_get("call", "$.function.arguments", "string"), F.try_variant_get("call", "$.arguments", "string"))
    return each.select("session_key", "event_id", "call_no", F.try_variant_get("call", "$.id", "string").alias("call_id"), name.alias("tool"), arguments.alias("arguments"))


def call_results(rows: DataFrame, made: DataFrame) -> DataFrame:
    """Tool messages with the call they answer, by session and call id; of calls with one id the last wins."""
    last = made.where("call_id is not null").groupBy("session_key", "call_id").agg(F.max(F.struct("event_id", "call_no", "tool", "arguments")).alias("c"))
    tools = rows.where("role = 'tool'").select("session_key", F.col("tool_call_id").alias("call_id"), F.col("event_id").alias("result_id"), "content")
    return tools.join(last, ["session_key", "call_id"], "left").select("session_key", "call_id", "result_id", "content", F.col("c.event_id").alias("call_event_id"), F.col("c.tool").alias("tool"), F.col("c.arguments").alias("arguments"))


def tool_distribution(made: DataFrame, sample: str = "session_key") -> DataFrame:
    """Of each tool: calls, share of all calls, samples, share of the samples with calls, calls a sample."""
    counts = made.where("tool is not null").groupBy("tool").agg(F.count("*").alias("n_calls"), F.count_distinct(sample).alias("n_samples"))
    totals = made.where("tool is not null").agg(F.count("*").alias("_calls"), F.count_distinct(sample).alias("_samples"))
    joined = counts.crossJoin(F.broadcast(totals))  # one row of totals
    return joined.select("tool", "n_calls", F.round(F.col("n_calls") / F.col("_calls"), 6).alias("share"), "n_samples", F.round(F.col("n_samples") / F.col("_samples"), 6).alias("coverage"), F.round(F.col("n_calls") / F.col("n_samples"), 6).alias("calls_a_sample"))


def history_window(rows: DataFrame, n: int, order: str = "event_id", parts: int = 64, consolidated: DataFrame | None = None) -> DataFrame:
    """The last ``n`` messages of each session, without those before the first user message among them; all of them if there is none.

    ``consolidated`` (``session_key, last_consolidated``) leaves out the first messages of a session, as many as are told. The
    last ``n`` are taken in each of ``parts`` parts of a session first, so no task sorts a whole session.
    """
    slim = rows.select("session_key", order, "role")
    if consolidated is not None:
        placed = running_counts(slim, "session_key", [F.col(order)], {"_place": F.lit(1)})
        slim = placed.join(consolidated.select("session_key", "last_consolidated"), "session_key", "left").where(F.col("_place") > F.coalesce("last_consolidated", F.lit(0))).select("session_key", order, "role")
    slim = slim.withColumn("_part", F.pmod(F.xxhash64(order), F.lit(parts)))
    last = lambda x, keys: x.withColumn("_back", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))).where(F.col("_back") <= n).drop("_back")
    ranked = last(last(slim, ["session_key", "_part"]).drop("_part"), ["session_key"])
    first = ranked.groupBy("session_key").agg(F.min(F.when(F.col("role") == "user", F.col(order))).alias("_first"))
    return ranked.join(first, "session_key").where(F.col("_first").isNull() | (F.col(order) >= F.col("_first"))).select("session_key", order, "role")


def numbered(rows: DataFrame, order: str = "event_id", name: str = "observation_no") -> DataFrame:
    """Rows numbered from 1 in their session's order, a large session in many tasks."""
    return running_counts(rows, "session_key", [F.col(order)], {name: F.lit(1)})


def saved_paths(text: Column) -> Column:
    """Image paths in "saved to: path" notes, in any case."""
    return F.filter(F.regexp_extract_all(text, F.lit(r"(?i)saved to: (\S+)"), 1), lambda p: F.lower(p).rlike(r"\.(png|jpg|jpeg|gif|bmp|webp)$"))


def truncated_text(text: Column, most: int) -> Column:
    """At most ``most`` characters and a note of how many are left out; all of it if ``most`` isn't positive."""
    if most <= 0:
        return text
    note = F.concat(F.lit("\n... [truncated "), (F.char_length(text) - most).cast("string"), F.lit(" chars]"))
    return F.when(F.char_length(text) > most, F.concat(F.substring(text, 1, most), note)).otherwise(text)


def chunked(text: Column, most: int = 2000) -> Column:
    """Pieces of at most ``most`` characters that end at a line break, else a blank, else anywhere; none for null.

    A pattern whose alternatives are those three ends, each as late as it can be, matches piece by piece; blanks that
    begin a piece are passed over.
    """
    any_ = r"[\s\S]"
    ends = (rf"{any_}{{1,{most}}}\z", rf"{any_}{{1,{most - 1}}}(?=\n)", rf"{any_}{{1,{most - 1}}}(?= )", rf"{any_}{{1,{most}}}")
    return F.coalesce(F.regexp_extract_all(text, F.lit(rf"(?U)(?:\A|\s*+)((?>{'|'.join(ends)}))"), 1), F.array().cast("array<string>"))


def terminator_last(made: DataFrame, tool: str = "computer_use") -> DataFrame:
    """``session_key, has_tool, is_last`` of sessions with calls: whether the tool was called, and in the last message that makes calls."""
    per = made.groupBy("session_key").agg(F.max("event_id").alias("_end"), F.max(F.when(F.col("tool") == tool, F.col("event_id"))).alias("_own"))
    return per.select("session_key", F.col("_own").isNotNull().alias("has_tool"), F.coalesce(F.col("_own") == F.col("_end"), F.lit(False)).alias("is_last"))


def written_images(rows: DataFrame, made: DataFrame) -> DataFrame:
    """``session_key, path, n``: how often each image path is saved, by notes of tools, by written files and by code in files and commands."""
    image = r"(?i)\.(png|jpg|jpeg|gif|bmp|webp)$"
    notes = rows.where("role = 'tool'").select("session_key", F.explode(F.filter(F.regexp_extract_all("content", F.lit(r"Saved to: (\S+)"), 1), lambda p: p.rlike(image))).alias("path"))
    field = lambda name: F.coalesce(F.try_variant_get(F.try_parse_json("arguments"), f"$.{name}", "string"), F.lit(""))
    saves = lambda text: F.regexp_extract_all(text, F.lit(SAVES_IMAGE), 1)
    own = F.when(field("path").rlike(image), F.array(field("path"))).otherwise(F.array().cast("array<string>"))
    found = F.when(F.col("tool") == "write_file", F.concat(own, saves(field("content")))).when(F.col("tool") == "exec", saves(field("command")))
    calls_ = made.where("tool in ('write_file', 'exec')").select("session_key", F.explode(found).alias("path"))
    return notes.unionByName(calls_).groupBy("session_key", "path").agg(F.count("*").alias("n"))


def host_path_sessions(rows: DataFrame, prompts: DataFrame | None = None) -> DataFrame:
    """``session_key`` of sessions that name a host path in a prompt (``session_key, system_prompt``), message or call."""
    hit = F.coalesce(F.col("content").rlike(HOST_PATH), F.lit(False)) | ((F.col("role") == "assistant") & F.coalesce(F.col("tool_calls").rlike(HOST_PATH), F.lit(False)))
    found = rows.where(hit).select("session_key")
    if prompts is not None:
        found = found.unionByName(prompts.where(F.col("system_prompt").rlike(HOST_PATH)).select("session_key"))
    return found.distinct()


def session_facts(rows: DataFrame, made: DataFrame, reference: DataFrame, terminator: str = "computer_use") -> DataFrame:
    """What the first checks of a session ask for, one row a session.

    ``answer`` (the last text of an assistant), ``n_calls``, ``only_tool``, ``other_tools`` (calls besides the terminator), ``has_tool``
    and ``point`` of the last terminator call, ``has_reference`` and ``reference`` (``session_key, reference``), ``overwrites``, ``host_path``.
    """
    from tracelake.functions.geometry import call_coordinate

    answers = rows.groupBy("session_key").agg(F.max(F.when((F.col("role") == "assistant") & (F.coalesce("content", F.lit("")) != ""), F.struct("event_id", "content"))).getField("content").alias("answer"))
    point = F.coalesce(call_coordinate(F.col("arguments")), call_coordinate(F.col("arguments"), "$.actions[0].coordinate"))
    called = made.groupBy("session_key").agg(
        F.count("*").alias("n_calls"),
        F.min("tool").alias("only_tool"),
        F.count_if(F.coalesce(F.col("tool") != terminator, F.lit(True))).alias("other_tools"),
        F.max(F.when(F.col("tool") == terminator, F.struct("event_id", "call_no", point.alias("p")))).alias("_last"),
    )
    overwrites = written_images(rows, made).groupBy("session_key").agg(F.max(F.col("n") > 1).alias("overwrites"))
    hosts = host_path_sessions(rows).withColumn("host_path", F.lit(True))
    known = reference.select("session_key", "reference", F.lit(True).alias("has_reference"))
    joined = answers.join(called, "session_key", "left").join(overwrites, "session_key", "left").join(hosts, "session_key", "left").join(known, "session_key", "left")
    return joined.select(
        "session_key", "answer", "reference", F.coalesce("has_reference", F.lit(False)).alias("has_reference"), F.coalesce("n_calls", F.lit(0)).alias("n_calls"), "only_tool",
        F.coalesce("other_tools", F.lit(0)).alias("other_tools"), F.col("_last").isNotNull().alias("has_tool"), F.col("_last.p").alias("point"), F.coalesce("overwrites", F.lit(False)).alias("overwrites"), F.coalesce("host_path", F.lit(False)).alias("host_path"),
    )


def session_rules(is_right: Column, most_calls: int = 12) -> list[tuple[str, str, Column]]:
    """Rules over :func:`session_facts` in their order, for :func:`tracelake.operators.selection.rejected`."""
    c = F.col
    single = (c("n_calls") == 1) & c("only_tool").isin(*LOW_VALUE_TOOLS)
    return [
        ("stage1", "computer_use_no_coordinate", c("has_tool") & c("point").isNull()),
        ("stage1", "no_response", ~c("has_tool") & c("answer").isNull()),
        ("stage1", "no_ref_answer", ~c("has_reference")),
        ("stage1", "no_tool_calls", c("other_tools") == 0),
        ("stage1", "empty_ref_answer", F.coalesce("reference", F.lit("")) == ""),
        ("stage1", "answer_wrong", ~F.coalesce(is_right, F.lit(False))),
        *(("stage2", f"single_{t}", single & (c("only_tool") == t)) for t in LOW_VALUE_TOOLS),
        ("stage2", "too_many_rounds", c("n_calls") > most_calls),
        ("stage2", "image_overwrite", c("overwrites")),
        ("stage2", "host_path_hit", c("host_path")),
    ]


def observations(rows: DataFrame, made: DataFrame, most: int = 4000, without: tuple[str, ...] = ()) -> DataFrame:
    """What a session's tools told: ``session_key, event_id, observation_no, tool, call, response, images``; empty responses are left out.

    ``call`` is the tool's name with its arguments, ``unknown_tool`` where no call is found; ``without`` leaves out tools.
    """
    from tracelake.functions.audit import image_references
    from tracelake.functions.text import block_text

    told = call_results(rows, made).withColumns({"response": block_text(F.col("content")), "tool": F.coalesce("tool", F.lit("unknown_tool"))}).withColumnRenamed("result_id", "event_id")
    kept = told.where(F.regexp_replace(F.coalesce("response", F.lit("")), r"\s", "") != "").where(~F.col("tool").isin(*without) if without else F.lit(True))
    slim = kept.select("session_key", "event_id", "tool", F.concat("tool", F.lit("("), F.coalesce("arguments", F.lit("{}")), F.lit(")")).alias("call"), truncated_text(F.col("response"), most).alias("response"), image_references(F.col("response")).alias("images"))
    return numbered(slim)


def observation_blocks(told: DataFrame) -> DataFrame:
    """``session_key, event_id, block``: each observation as a part of a prompt, headed by its number and call."""
    return told.select("session_key", "event_id", F.concat(F.lit("[tool_call #"), F.col("observation_no").cast("string"), F.lit("] "), F.col("call"), F.lit("\n[tool_response #"), F.col("observation_no").cast("string"), F.lit("]\n"), F.col("response")).alias("block"))


def turn_observations(results: DataFrame, key: str = "task_key", most: int = 10_000) -> DataFrame:
    """Tool results in the turns of samples: ``key, sample_no, step, call_no, tool, args, error``; calls without a name are left out."""
    samples = results.where(F.col(key).isNotNull()).select(key, F.posexplode("samples").alias("sample_no", "s")).where("s is not null")
    turns = samples.select(key, "sample_no", F.explode("s.turns").alias("t")).where("t is not null")
    calls_ = turns.select(key, "sample_no", F.col("t.step").alias("step"), F.posexplode("t.tool_results").alias("call_no", "r")).where("r is not null and r.name is not null")
    return calls_.select(key, "sample_no", "step", "call_no", F.col("r.name").alias("tool"), truncated_text(F.coalesce("r.args", F.lit("{}")), most).alias("args"), "r.error")


def prefix_audit(told: DataFrame, reference: DataFrame, channels: tuple[str, ...] = ("computer_use", "write_file")) -> DataFrame:
    """Of each session's observations: number, images, characters, counts by tool, whether the answer stands in them, calls of answer channels."""
    joined = told.join(reference.select("session_key", F.regexp_replace(F.trim("reference"), r"\s+", " ").alias("_r")), "session_key", "left")
    literal = (F.char_length("_r") >= 3) & F.contains(F.regexp_replace("response", r"\s+", " "), F.col("_r"))
    totals = joined.groupBy("session_key").agg(F.count("*").alias("n_responses"), F.sum(F.size("images")).alias("n_images"), F.sum(F.char_length("response")).alias("text_chars"), F.max(F.coalesce(literal, F.lit(False))).alias("has_answer"), F.count_if(F.col("tool").isin(*channels)).alias("n_channel"))
    by = told.groupBy("session_key", "tool").agg(F.count("*").alias("n"))
    # the tools of a session are bounded by the tools there are
    return totals.join(by.groupBy("session_key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("tool", "n")))).alias("tool_counts")), "session_key")
