"""Conversion of traces to training samples and observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.functions.text import block_text


def images_of(content: Column) -> Column:
    """Images in the typed blocks of a message; empty for plain text."""
    blocks = F.try_variant_get(F.when(content.rlike(r"^\s*\[\s*\{"), F.try_parse_json(content)), "$", "array<variant>")
    found = F.transform(blocks, lambda x: F.coalesce(F.try_variant_get(x, "$.image", "string"), F.try_variant_get(x, "$.image_url.url", "string")))
    return F.coalesce(F.filter(found, lambda x: x.isNotNull()), F.array().cast("array<string>"))


def user_text(content: Column) -> Column:
    """The user's text behind one image token for each of its images."""
    return F.concat(F.repeat(F.lit("<image>"), F.size(images_of(content))), F.coalesce(block_text(content), F.lit("")))


def viewed_token(content: Column) -> Column:
    """Image tokens of a tool response that shows images: ``[image viewed * n]``."""
    n = F.coalesce(F.regexp_extract(content, r"(?i)^\[image viewed \* (\d+)\]", 1).try_cast("int"), F.lit(0))
    return F.concat(F.repeat(F.lit("<image>"), n), F.coalesce(content, F.lit("")))


def sft_messages(rows: DataFrame, system: DataFrame | None = None) -> DataFrame:
    """Messages of each session for training: ``session_key, messages`` with roles user, assistant, tool_call, tool_response.

    An assistant row gives its text, if any, and one tool_call message with its calls; the order is by event id. A session
    is one training sample, so its array is bounded by what a sample may hold.
    """
    kind = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    text = F.when(F.coalesce(F.col("content"), F.lit("")) != "", F.array(kind("assistant", block_text(F.col("content")))))
    call = F.when(F.coalesce(F.col("tool_calls"), F.lit("")).isin("", "[]", "null") == False, F.array(kind("tool_call", F.col("tool_calls"))))  # noqa: E712
    none = F.array().cast("array<struct<role: string, content: string>>")
    parts = F.when(F.col("role") == "user", F.array(kind("user", user_text(F.col("content"))))).when(F.col("role") == "tool", F.array(kind("tool_response", viewed_token(F.col("content"))))).when(F.col("role") == "assistant", F.concat(F.coalesce(text, none), F.coalesce(call, none))).otherwise(none)
    each = rows.select("session_key", "event_id", F.posexplode(parts).alias("part", "message"))
    samples = each.groupBy("session_key").agg(F.array_sort(F.collect_list(F.struct("event_id", "part", "message"))).alias("m"))
    messages = F.transform("m", lambda x: x["message"])
    if system is None:
        return samples.select("session_key", messages.alias("messages"))
    head = F.when(F.col("prompt") != "", F.array(kind("system", F.col("prompt"))))
    return samples.join(system, "session_key", "left").select("session_key", F.concat(F.coalesce(head, none), messages).alias("messages"))


def prompt_text(prompt: Column) -> Column:
    """System prompt of plain text or of JSON text blocks, up to the first task separator, without blanks at the end."""
    text = F.coalesce(block_text(prompt), F.lit(""))
    return F.regexp_replace(F.substring_index(text, "\n\n---\n\n", 1), r"\s+$", "")


def without_hint(text: Column) -> Column:
    """Without the injected block of file paths."""
    return F.regexp_replace(text, r"\[(?:Image file paths — use these in scripts|File paths — read these using tools such as read_file)\]\n(?:- [^\n]*\n)+\n", "")


def used_tools(made: DataFrame, base: list[str]) -> DataFrame:
    """Tool list of each session: base tools, then used ones in order of first use."""
    first = made.where("tool is not null").groupBy("session_key", "tool").agg(F.min(F.struct("event_id", "call_no")).alias("at"))
    listed = first.groupBy("session_key").agg(F.array_sort(F.collect_list(F.struct("at", "tool"))).alias("t"))
    return listed.select("session_key", F.array_union(F.array(*map(F.lit, base)), F.transform("t", lambda x: x["tool"])).alias("tools"))


def virtual_paths(text: Column, root: Column) -> Column:
    """A host root replaced by the virtual one."""
    return F.when(root.isNotNull() & (root != ""), F.replace(text, root, F.lit("/mnt/data"))).otherwise(text)


def safe_name(text: Column) -> Column:
    """Characters that file names can't hold become underscores; no blanks at the ends."""
    return F.regexp_replace(F.regexp_replace(text, r'[<>:"/\\|?*]', "_"), r"^\s+|\s+$", "")


def task_key(source: Column, item: Column) -> Column:
    """Cleaned source and item id; a missing or empty source is "dataset"."""
    clean = F.regexp_replace(F.regexp_replace(F.coalesce(F.nullif(source, F.lit("")), F.lit("dataset")), r"[^A-Za-z0-9_.-]+", "_"), r"^_+|_+$", "")
    return F.concat(F.coalesce(F.nullif(clean, F.lit("")), F.lit("dataset")), F.lit("_"), item.cast("string"))


def host_paths(text: Column, root: Column) -> Column:
    """The virtual root replaced by that of a host."""
    return F.when(root.isNotNull() & (root != ""), F.replace(text, F.lit("/mnt/data"), root)).otherwise(text)


def short_digest(text: Column, most: int = 9) -> Column:
    """The first characters of the SHA-1, as long ids are shortened."""
    return F.substring(F.sha1(text), 1, most)


def assistant_text(reasoning: Column, content: Column) -> Column:
    """An assistant's text behind its thinking, if there is any."""
    think = F.when(F.coalesce(reasoning, F.lit("")) != "", F.concat(F.lit("<think>"), reasoning, F.lit("</think>")))
    return F.concat(F.coalesce(think, F.lit("")), F.coalesce(content, F.lit("")))


def response_text(content: Column, images: Column, behind: bool = False) -> Column:
    """A tool's text with one image token for each of its images, ahead of it or behind."""
    tokens = F.repeat(F.lit("<image>"), F.coalesce(F.size(images), F.lit(0)))
    text = F.coalesce(block_text(content), F.lit(""))
    return F.concat(text, tokens) if behind else F.concat(tokens, text)


def tools_json(tools: DataFrame, schemas: DataFrame) -> DataFrame:
    """``session_key, tools_json``: schemas (``tool, schema`` as JSON text) of each session's tools, in their order; unknown tools are left out."""
    each = tools.select("session_key", F.posexplode("tools").alias("place", "tool"))
    known = each.join(schemas.select("tool", "schema"), "tool").groupBy("session_key").agg(F.array_sort(F.collect_list(F.struct("place", "schema"))).alias("s"))
    return known.select("session_key", F.concat(F.lit("["), F.array_join(F.transform("s", lambda x: x["schema"]), ", "), F.lit("]")).alias("tools_json"))


def chosen_tools(wanted: list[str] | None, used: Column, pool: list[str]) -> Column:
    """Names of a sample's tools: an override that is known, all of the pool (``["all"]``), none (``[]``), else the used ones in the pool."""
    known = F.array(*map(F.lit, pool)) if pool else F.array().cast("array<string>")
    if wanted is None:
        return F.array_intersect(used, known)
    return known if wanted == ["all"] else F.array_intersect(F.array(*map(F.lit, wanted)), known) if wanted else F.array().cast("array<string>")
