"""Column functions on texts and times that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blanks, controls, format characters and fillers: what a reader doesn't see.
UNSEEN = r"[\s\p{Z}\p{C}\x{034F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180E}\x{2800}\x{3164}\x{FE00}-\x{FE0F}\x{FFA0}]"


def instant(text: Column) -> Column:
    """Microseconds since the epoch of an ISO time; a text without offset is UTC, an unreadable one is null."""
    t = F.upper(F.regexp_replace(text, r"^\s+|\s+$", ""))
    t = F.regexp_replace(F.regexp_replace(t, r"(:\d{2}),(\d)", "$1.$2"), r"(\.\d{6})\d+", "$1")
    t = F.regexp_replace(F.regexp_replace(t, r"(:\d{2}(?:\.\d+)?)\s*([+-]\d{2})(\d{2})?$", "$1$2:$3"), r"([+-]\d{2}):$", "$1:00")
    t = F.when(t.rlike(r"\d:\d{2}.*(Z|[+-]\d{2}:\d{2})$"), t).otherwise(F.concat(t, F.lit("Z")))
    t = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}Z$"), F.concat(F.substring(t, 1, 10), F.lit("T00:00:00Z"))).otherwise(t)
    return F.unix_micros(F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{1,2}:\d{2}"), t).try_cast("timestamp"))


def without_thinking(text: Column) -> Column:
    """The text without thinking blocks; one that isn't closed reaches to the end."""
    return F.regexp_replace(text, r"(?is)<(think(?:ing)?)\b[^>]*>.*?(?:</\1\s*>|\z)", "")


def visible(text: Column) -> Column:
    """Whether anything is left that a reader sees; false for null."""
    return F.coalesce(F.length(F.regexp_replace(without_thinking(text), UNSEEN, "")) > 0, F.lit(False))


def block_text(content: Column) -> Column:
    """The text of a message: of a JSON array of typed blocks the joined text blocks, else the content itself."""
    blocks = F.try_variant_get(F.when(content.rlike(r"^\s*\[\s*\{"), F.try_parse_json(content)), "$", "array<variant>")
    kinds = F.transform(blocks, lambda x: F.try_variant_get(x, "$.type", "string"))
    texts = F.filter(F.transform(blocks, lambda x: F.when(F.try_variant_get(x, "$.type", "string") == "text", F.try_variant_get(x, "$.text", "string"))), lambda x: x.isNotNull())
    return F.when(F.exists(kinds, lambda x: x.isNotNull()), F.array_join(texts, "\n")).otherwise(content)


def read_calls(tool_calls: Column) -> Column:
    """Ids of the calls in readable ``tool_calls`` (null ids stay); a bare object is one call; null if there are none.

    JSON text of JSON text is read through.
    """
    read = F.try_parse_json(F.when(tool_calls.rlike(r'[\]}"]\s*$'), tool_calls))
    inner = F.try_parse_json(F.when(tool_calls.rlike(r'^\s*"'), F.try_variant_get(read, "$", "string")))
    read = F.coalesce(inner, read)
    array = F.try_variant_get(read, "$", "array<variant>")
    one = F.when(F.schema_of_variant(read).startswith("OBJECT"), F.array(read))
    ids = F.transform(F.coalesce(array, one), lambda x: F.try_variant_get(x, "$.id", "string"))
    return F.when(F.size(ids) > 0, ids)
