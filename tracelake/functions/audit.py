"""Checks on commands, code, tool arguments and run settings."""

from __future__ import annotations

import json
import os
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Shell commands that destroy, code that reaches outside a cell, and absolute paths in a command (fixed patterns).
DANGEROUS = (r"\brm\s+-[rf]{1,2}\b", r"\bdel\s+/[fq]\b", r"\brmdir\s+/s\b", r"(?:^|[;&|]\s*)format\b", r"\b(mkfs|diskpart)\b", r"\bdd\s+if=", r">\s*/dev/sd", r"\b(shutdown|reboot|poweroff)\b", r":\(\)\s*\{.*\};\s*:")
UNSAFE_CODE = (r"\bsubprocess\.", r"\bsocket\.", r"\bos\.(remove|unlink|rmdir|system|popen|kill|rename|renames)\b", r"\bshutil\.(rmtree|move)\b", r"\b__import__\(\s*['\"](subprocess|socket)['\"]")
WINDOWS_PATH, POSIX_PATH = r"[A-Za-z]:\\[^\s\"'|><;]+", r"(?:^|[\s|>])(/[^\s\"'>]+)"


def command_verdict(command: Column, allowed: list[str] | None = None, cwd: str | None = None) -> Column:
    """dangerous, not_allowed, traversal, outside or ok: the first that fits. With ``cwd``, absolute paths must lie below it."""
    low = F.lower(F.trim(command))
    verdict = F.when(low.rlike("|".join(DANGEROUS)), "dangerous")
    if allowed:
        verdict = verdict.when(~low.rlike("|".join(allowed)), "not_allowed")
    if cwd:
        verdict = verdict.when(command.contains("../") | command.contains("..\\"), "traversal")
        paths = F.concat(F.regexp_extract_all(command, F.lit(WINDOWS_PATH), 0), F.regexp_extract_all(command, F.lit(POSIX_PATH), 1))
        verdict = verdict.when(F.exists(paths, lambda p: (p != cwd) & ~p.startswith(cwd.rstrip("/") + "/")), "outside")
    return verdict.when(command.isNotNull(), "ok")


def unsafe_code(code: Column) -> Column:
    return code.rlike("(?i)" + "|".join(UNSAFE_CODE))


def valid_url(text: Column) -> Column:
    """An http or https address with a host."""
    return F.coalesce(text.rlike(r"(?i)^https?://[^/?#\s]+"), F.lit(False))


def without_base64(text: Column, mark: str = "<base64>") -> Column:
    """Bodies of base64 data URLs replaced by a mark."""
    return F.regexp_replace(text, r"(data:[\w.+-]+/[\w.+-]+;base64,)[A-Za-z0-9+/=]+", f"$1{mark}")


def image_references(text: Column) -> Column:
    """Image paths or names in a tool response that shows images, each once; none without the mark."""
    names = F.array_distinct(F.regexp_extract_all(text, F.lit(r"((?:/[\w.-]+)*/?[\w.-]+\.(?i:png|jpg|jpeg|gif|bmp|webp))"), 1))
    return F.when(text.rlike(r"(?i)\[image viewed \* \d+\]"), names).otherwise(F.array().cast("array<string>"))


def code_blocks(text: Column, language: str = "python") -> Column:
    """Bodies of closed code blocks of a language."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)```{re.escape(language)}[^\n]*\n(.*?)```"), 1)


def closed_tags(text: Column, names: tuple[str, ...] = ("code", "tool_call", "answer")) -> Column:
    """The text with an end tag for each of the tags that is opened more often than closed."""
    for name in names:
        count = lambda tag: F.size(F.split(text, tag))
        text = F.when(count(f"<{name}>") > count(f"</{name}>"), F.concat(text, F.lit(f"</{name}>"))).otherwise(text)
    return text


def last_code(text: Column) -> Column:
    """Source in the last ``<code>`` block: of its last closed fence, else all of it without fence lines; null without a block."""
    inner = F.trim(F.try_element_at(F.regexp_extract_all(text, F.lit(r"(?is)<code>(.*?)</code>"), 1), F.lit(-1)))
    fenced = F.try_element_at(F.regexp_extract_all(inner, F.lit(r"(?s)```[a-zA-Z]*\s*\n(.*?)```"), 1), F.lit(-1))
    bare = F.regexp_replace(F.regexp_replace(inner, r"\A\s*```[a-zA-Z]*\s*\n?", ""), r"\n?```\s*\z", "")
    return F.nullif(F.regexp_replace(F.coalesce(fenced, bare), r"\A\s+|\s+\z", ""), F.lit(""))


def saved_result(content: Column, most: int = 10_000) -> Column:
    """A tool result as it is kept: at most ``most`` characters with a note, bodies of data URLs as a mark."""
    slim = without_base64(content, "...")
    return F.when(F.char_length(slim) > most, F.concat(F.substring(slim, 1, most), F.lit("\n... (truncated)"))).otherwise(slim)


def json_array_in(text: Column) -> Column:
    """JSON array in model output: in a fence if there is one, from the first [ to the last ]; null if unreadable."""
    fenced = F.regexp_extract(text, r"(?is)```(?:json)?\s*(.*?)```", 1)
    body = F.when(fenced != "", fenced).otherwise(text)
    return F.try_variant_get(F.try_parse_json(F.nullif(F.regexp_extract(body, r"(?s)(\[.*\])", 1), F.lit(""))), "$", "array<variant>")


_PLAIN = {"string": str, "integer": int, "number": (int, float), "array": list, "object": dict, "boolean": bool}
#: Of each schema keyword what a value must hold, and the kinds of values that it speaks of.
_RULES = {
    "enum": (object, lambda v, wanted: v in wanted),
    "minimum": ((int, float), lambda v, least: v >= least),
    "maximum": ((int, float), lambda v, most: v <= most),
    "minLength": (str, lambda v, least: len(v) >= least),
    "maxLength": (str, lambda v, most: len(v) <= most),
}


def _is(value: object, kind: str | None) -> bool:
    return kind not in _PLAIN or isinstance(value, _PLAIN[kind]) and (kind == "boolean" or not isinstance(value, bool))


def _misfits(value: object, schema: dict) -> list[str]:
    """Where a value doesn't fit a JSON schema, as ``path: keyword value``, in the order of the paths."""
    out, todo = [], [("$", value, schema)]
    while todo:
        at, v, s = todo.pop()
        if not _is(v, s.get("type")):
            out.append(f"{at}: type {s['type']}")
            continue
        out += [f"{at}: {word} {s[word]}" for word, (kinds, holds) in _RULES.items() if word in s and isinstance(v, kinds) and not isinstance(v, bool) and not holds(v, s[word])]
        if isinstance(v, dict):
            out += [f"{at}: required {k}" for k in s.get("required", ()) if k not in v]
            todo += [(f"{at}.{k}", v[k], inner) for k, inner in s.get("properties", {}).items() if k in v]
        if isinstance(v, list) and s.get("items"):
            todo += [(f"{at}[{i}]", x, s["items"]) for i, x in enumerate(v)]
    return sorted(out)


#: Words that stand for a boolean (fixed values).
_BOOLEAN_WORDS = {"true": True, "1": True, "yes": True, "false": False, "0": False, "no": False}
_FROM_TEXT = {"integer": int, "number": float, "boolean": lambda t: _BOOLEAN_WORDS[t.lower()]}


def cast(value: object, schema: dict) -> object:
    """A value with texts read as the numbers and booleans that the schema asks for, and values written as texts; what can't be read stays."""
    kind = schema.get("type")
    if isinstance(value, dict):
        value = {k: cast(v, schema.get("properties", {}).get(k, {})) for k, v in value.items()}
    elif isinstance(value, list):
        value = [cast(v, schema.get("items") or {}) for v in value]
    if kind == "string" and value is not None:
        return str(value)
    if isinstance(value, str) and kind in _FROM_TEXT:
        try:
            return _FROM_TEXT[kind](value)
        except (ValueError, KeyError):
            pass
    return value


def argument_problems(schemas: dict[str, dict], casting: bool = False):
    """A column function of (tool, arguments as JSON text): the list of problems, empty where they fit the tool's schema.

    With ``casting`` texts are read as numbers and booleans first.
    """

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(tools: pd.Series, arguments: pd.Series) -> pd.Series:
        def one(tool: str | None, text: str | None) -> list[str]:
            if tool not in schemas:
                return [f"unknown tool {tool}"]
            try:
                read = json.loads(text or "{}")
            except ValueError:
                return ["arguments aren't JSON"]
            schema = {**schemas[tool], "type": "object"}
            return _misfits(cast(read, schema) if casting else read, schema)

        return pd.Series([one(t, a) for t, a in zip(tools, arguments)])

    return run


def expanded(config: object) -> object:
    """Settings with ``${NAME}`` replaced by the environment; a missing name is an error."""
    if isinstance(config, dict):
        return {k: expanded(v) for k, v in config.items()}
    if isinstance(config, list):
        return [expanded(v) for v in config]
    if not isinstance(config, str):
        return config

    def value(m: re.Match) -> str:
        if m.group(1) not in os.environ:
            raise KeyError(f"environment variable {m.group(1)} is not set")
        return os.environ[m.group(1)]

    return re.sub(r"\$\{(\w+)\}", value, config)


def redacted(config: object, secret: tuple[str, ...] = ("key", "token", "secret", "password")) -> object:
    """Settings with secrets replaced by a placeholder."""
    if isinstance(config, dict):
        return {k: "<redacted>" if isinstance(v, str) and any(s in k.lower() for s in secret) else redacted(v, secret) for k, v in config.items()}
    return [redacted(v, secret) for v in config] if isinstance(config, list) else config


def differing(saved: dict, now: dict, ignored: tuple[str, ...] = ()) -> list[str]:
    """Settings in which a resumed run differs from the saved one."""
    return sorted(k for k in {*saved, *now} if k not in ignored and saved.get(k) != now.get(k))


def rejudged(results: DataFrame, scores: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Results with new values of columns, the old ones kept as ``<column>_prev``; rows without new values stay as they are."""
    new = scores.select(key, *(F.col(c).alias(f"_new_{c}") for c in columns), F.lit(True).alias("_hit"))
    joined = results.join(new, key, "left")
    for c in columns:
        joined = joined.withColumns({f"{c}_prev": F.when(F.col("_hit"), F.col(c)), c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c))})
    return joined.drop("_hit", *(f"_new_{c}" for c in columns))
