"""Rule-based answer matching as column expressions.

Number grammar: an optional sign, digits with optional fraction and exponent, no letter before. Float grammar follows Python:
underscores between digits, ``inf`` and ``nan`` count, a trailing ``d`` or ``f`` doesn't.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Answers that need a context to count (fixed values).
TRIVIAL = ("0", "1", "2", "3", "4", "5", "yes", "no", "true", "false")
#: Words that mark a sentence with the answer (fixed values).
SIGNAL_PATTERN = r"answer|result|therefore|thus|so the|= \*\*|approximately|is about|final|overall|in summary|conclusion|the gap|the difference"
#: A number, and where a reference counts as an answer: ``{}`` stands for it (fixed patterns).
NUMBER = r"(?<![a-zA-Z])[-+]?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?%?"
ANSWER_FORMS = (r"(?:answer|result|total|difference|gap|value|count|sum)\s*(?:is|=|:)\s*\**\s*{}\b", r"=\s*\**\s*{}\b(?!\s*[%)\]])", r"\*\*{}\*\*", r"\\\\?boxed\{\s*{}\s*\}")
_FLOAT = r"(?i)^[+-]?(?:(?:\d+(?:_\d+)*)(?:\.(?:\d+(?:_\d+)*)?)?|\.\d+(?:_\d+)*)(?:e[+-]?\d+(?:_\d+)*)?$"


def stripped(text: Column) -> Column:
    """Without white space at both ends, as Python strips it."""
    return F.regexp_replace(text, r"(?U)^[\s\x{1C}-\x{1F}]+|[\s\x{1C}-\x{1F}]+$", "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, inside of lambdas as well, where equal parts aren't found."""
    return F.transform(F.array(value), body)[0]


def try_float(text: Column) -> Column:
    """Double of the text without trailing percent signs; null where it isn't a number."""
    special = {r"^[+]?(inf|infinity)$": "inf", r"^-(inf|infinity)$": "-inf", r"^[+-]?nan$": "nan"}

    def read(t: Column) -> Column:
        named = F.lower(t)
        told = F.when(t.rlike(_FLOAT), F.regexp_replace(t, "_", "").try_cast("double"))
        for pattern, value in special.items():
            told = told.when(named.rlike(pattern), F.lit(float(value)))
        return told

    return let(stripped(F.regexp_replace(stripped(text), r"%+$", "")), read)


def normalized_answer(text: Column) -> Column:
    """Lower case without blanks at the ends; a whole number without exponent loses its fraction and percent sign.

    Other numbers are written as doubles; infinite ones and texts stay as they are.
    """

    def written(t: Column, v: Column) -> Column:
        whole = (v == F.floor(v)) & ~t.contains("e") & (F.abs(v) < 1e15)
        plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"[%_+\s]", ""), r"^(-?)0*(?=\d*\.)", "$1"), r"0+$", "")
        plain = F.regexp_replace(plain, r"^(-?)\.", "$10.")  # as Python writes it, without an exponent
        return F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), t).when(whole, v.cast("long").cast("string")).when(t.contains("e") | (F.abs(v) >= 1e15) | (F.abs(v) < 1e-4), v.cast("string")).otherwise(plain)

    return let(F.lower(stripped(text)), lambda t: let(try_float(t), lambda v: written(t, v)))


def numeric_close(value: Column, reference: Column, tolerance: Column | float) -> Column:
    """Relative difference within the tolerance; never for references near zero."""
    tolerance = tolerance if isinstance(tolerance, Column) else F.lit(float(tolerance))
    return F.coalesce((F.abs(reference) > 1e-9) & (F.abs(value - reference) / F.abs(reference) <= tolerance), F.lit(False))


def bold(text: Column) -> Column:
    """Texts between double asterisks, not over line breaks."""
    return F.regexp_extract_all(text, F.lit(r"\*\*(.+?)\*\*"), 1)


def numbers(text: Column) -> Column:
    """All numbers of a text, percent signs dropped."""
    found = F.regexp_extract_all(text, F.lit(NUMBER), 0)
    return F.transform(found, lambda x: F.regexp_replace(x, "%", "").try_cast("double"))


def answer_sentences(text: Column) -> Column:
    """Sentences with a signal word, joined by blanks; empty if there is none."""
    pattern = rf"(?i)[^.。\n]*(?:{SIGNAL_PATTERN})[^.。\n]*"
    return F.array_join(F.regexp_extract_all(text, F.lit(pattern), 0), " ")


def quoted(text: Column) -> Column:
    """The text with regex metacharacters escaped."""
    return F.regexp_replace(text, r"([\\.^$|?*+()\[\]{}\-])", r"\\$1")


def has_answer_context(text: Column, reference: Column) -> Column:
    """The reference stands where an answer is given: behind a word for it, an equals sign, in bold or boxed."""
    q, hit = quoted(reference), F.lit(False)
    for form in ANSWER_FORMS:
        ahead, behind = form.split("{}")
        hit = hit | F.regexp_like(text, F.concat(F.lit(f"(?iU){ahead}"), q, F.lit(behind)))
    return hit


def nearest(values: Column, to: Column) -> Column:
    """The value nearest to ``to``, of equally near ones the first; null values don't count."""
    near = F.filter(F.transform(values, lambda x, i: F.struct(F.abs(x - to).alias("d"), i.alias("i"), x.alias("x"))), lambda s: s["x"].isNotNull())
    return F.array_min(near)["x"]


@F.pandas_udf(T.ArrayType(T.StringType()))
def boxed(texts: pd.Series) -> pd.Series:
    """Contents of ``\\boxed{...}`` with balanced braces, which no regex can find; null for null."""

    def found(t: str | None) -> list[str] | None:
        if t is None:
            return None
        out, at = [], 0
        while (at := t.find("boxed", at)) >= 0:
            at += 5
            if t[at - 6 : at - 5] != "\\":
                continue
            start = at
            while start < len(t) and t[start].isspace():
                start += 1
            if t[start : start + 1] != "{":
                continue
            depth, k = 0, start
            while k < len(t):
                depth += (t[k] == "{") - (t[k] == "}")
                if not depth:
                    out.append(t[start + 1 : k].strip())
                    break
                k += 1
        return out

    return texts.map(found)


def with_method(rows: DataFrame, response: str, reference: str, tolerance: float = 0.0, name: str = "method") -> DataFrame:
    """Adds how the response gives the reference answer, ``none`` if it doesn't: the first of boxed, bold, literal and numeric forms.

    The parts that several forms ask for are columns of projections of their own, so each is computed once. Nulls give null.
    """
    c = lambda n: F.col(f"_{n}")
    text, ref = F.col(response), F.col(reference)
    parts = rows.withColumns({"_boxes": boxed(response), "_bolds": bold(text), "_told": answer_sentences(text), "_lower": F.lower(text), "_ref": F.lower(stripped(ref)), "_norm": normalized_answer(ref), "_value": try_float(ref)})
    zero = F.coalesce(F.abs(c("value")) <= 1e-9, F.lit(False))
    parts = parts.withColumns(
        {
            "_zero": zero,
            "_near": F.lit(tolerance > 0) & c("value").isNotNull() & ~zero,
            "_box_texts": F.transform("_boxes", normalized_answer),
            "_box_values": F.transform("_boxes", try_float),
            "_bold_texts": F.transform("_bolds", normalized_answer),
            "_bold_values": F.transform("_bolds", try_float),
            "_inside": F.flatten(F.transform("_bolds", numbers)),
            "_chosen": numbers(F.when(c("told") != "", c("told")).otherwise(text)),
            "_trivial": c("ref").isin(*TRIVIAL),
            "_any_trivial": c("ref").isin(*TRIVIAL) | c("norm").isin(*TRIVIAL),
        }
    )
    parts = parts.withColumn("_closest", nearest(c("chosen"), c("value")))
    near, bound = c("near"), F.lit(tolerance)
    has_zero = lambda xs: F.exists(xs, lambda x: F.coalesce(x == 0.0, F.lit(False)))
    close = lambda xs: F.exists(xs, lambda x: numeric_close(x, c("value"), bound))
    # a pattern is made of the word only where the text has it at all
    word = lambda x: F.contains(c("lower"), x) & F.regexp_like(c("lower"), F.concat(F.lit(r"(?U)(?<!\w)"), quoted(x), F.lit(r"(?!\w)")))
    told = c("told") != ""
    ending = F.when(told, F.lit("")).otherwise(F.lit("_fallback"))
    method = F.when(text.isNull() | ref.isNull(), F.lit(None).cast("string")).otherwise(
        F.when(F.array_contains("_box_texts", c("norm")), "boxed")
        .when(c("zero") & has_zero(c("box_values")), "boxed_zero")
        .when(near & close(c("box_values")), "boxed_approx")
        .when(F.array_contains("_bold_texts", c("norm")), "bold")
        .when(c("zero") & (has_zero(c("bold_values")) | has_zero(c("inside"))), "bold_zero")
        .when(near & (close(c("bold_values")) | close(c("inside"))), "bold_approx")
        .when(c("trivial") & has_answer_context(text, c("ref")), "literal_contextual")
        .when(~c("trivial") & word(c("ref")), "literal")
        .when((c("norm") != c("ref")) & ~c("norm").isin(*TRIVIAL) & word(c("norm")), "literal_norm")
        .when(c("zero") & ~c("any_trivial") & has_zero(c("chosen")), F.concat(F.lit("numeric_zero"), ending))
        .when(near & ~c("any_trivial") & numeric_close(c("closest"), c("value"), F.when(told, bound).otherwise(bound * 0.5)), F.concat(F.lit("numeric_approx"), ending))
        .otherwise("none")
    )
    return parts.withColumn(name, method).select(*rows.columns, name)


def yes_no(text: Column) -> Column:
    """True or false by the first word, else by a lone YES or NO in the last line that isn't blank; null if neither."""
    t = stripped(text)
    head = F.upper(F.element_at(F.split(t, r"[\s.,:;!?]+", 2), 1))
    last = F.regexp_extract(t, r"([^\n]*)$", 1)
    yes, no = last.rlike(r"(?i)\byes\b"), last.rlike(r"(?i)\bno\b")
    return F.when(head == "YES", True).when(head == "NO", False).when(yes & ~no, True).when(no & ~yes, False)


def last_yes_no(text: Column) -> Column:
    """The last lone YES or NO as a boolean."""
    return F.try_element_at(F.regexp_extract_all(F.upper(text), F.lit(r"\b(YES|NO)\b"), 1), F.lit(-1)) == "YES"


def without_blocks(text: Column) -> Column:
    """Without closed thinking and tool-call blocks."""
    return F.regexp_replace(text, r"(?s)<think>.*?</think>|<tool_call>.*?</tool_call>", "")
