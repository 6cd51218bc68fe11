"""Broken prompt and response pairs.

Of each response the first defect that fits: empty, copied question, refusal, wrong language, truncated. Refusals are told by
a likelihood ratio of character n-grams (:mod:`tracelake.llm.refusals`); languages are
compared by naive-Bayes posteriors of prompt and response on character n-grams; the end of a response is judged by the
likelihood of an end of text after its last tokens (:mod:`tracelake.llm.endings`). Closed thinking blocks aren't part of
a response.
"""

from __future__ import annotations

import difflib
import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm.endings import judged, tails, version_of, versions
from tracelake.llm import refusals
from tracelake.llm.language import LABELLED, Model, fitted, prose
from tracelake.llm.refusals import Ratio
from tracelake.session import written

#: Letters that prose must have to tell its language, and the prior of an answer in the language asked for.
LETTERS, PRIOR = 8, 0.9

_MARKUP = re.compile(r"(?s)<!--.*?-->|<[/!?a-zA-Z][^<>]*>|```[\w+-]*|\\(?:boxed|text|mathrm|mathbf|textbf)\b|\\[a-zA-Z]+\s*\{\s*\}")
_WORDS = re.compile(r"[一-鿿]|[^\W_一-鿿]+")

#: Words for languages and for answering, in the languages of the data (fixed values).
LANGUAGE_NAMES = {
    "en": r"english|englisch|anglais|inglés|英语|英文",
    "de": r"german|deutsch|allemand|alemán|德语|德文",
    "fr": r"french|französisch|français|francés|法语|法文",
    "es": r"spanish|spanisch|espagnol|español|castellano|西班牙语|西班牙文",
    "zh": r"chinese|mandarin|chinesisch|chinois|chino|中文|汉语|普通话",
}
_ASKED = re.compile(
    r"(?i)(?:answer|reply|respond|response|write|antwort\w*|schreib\w*|répon\w+|écri\w+|respond\w*|respuesta|contest\w*|escrib\w*|回答|答复|回复|作答)[^.?!。？！\n]{0,40}?(?:\b(?:in|auf|en|em)\s+|用|以)?(" + "|".join(f"(?P<{k}>{v})" for k, v in LANGUAGE_NAMES.items()) + r")|(?:用|以|请用)(?:(?P<zh2>中文|汉语)|(?P<en2>英语|英文)|(?P<de2>德语|德文)|(?P<fr2>法语|法文)|(?P<es2>西班牙语|西班牙文))[^。？！\n]{0,6}(?:回答|答复|回复|作答)"
)

def is_empty(answer: str | None) -> bool:
    """Nothing but blanks, invisible characters, punctuation, empty markup; null as well."""
    if answer is None:
        return True
    text = html.unescape(_MARKUP.sub(" ", answer))
    return not any(unicodedata.category(c)[0] in "LN" or unicodedata.category(c) == "So" for c in text if c not in "​ㅤᅠᅟﾠ⠀�")


def is_copied(query: str, answer: str) -> bool:
    """The query and nothing more, once or again; a lead-in, a lost word or mark doesn't matter."""
    q, a = _WORDS.findall(query.casefold()), _WORDS.findall(answer.casefold())
    if not q or len(a) < 0.7 * len(q) or len(set(q) & set(a)) < 0.7 * len(set(q)):
        return False
    times = max(1, round(len(a) / len(q)))
    matched, lead, tail = _repeats(q, a) if times > 1 else _matched(q, a)
    added = len(a) - matched - lead - tail
    lost = len(q) * times - matched
    return matched > 0 and tail == 0 and added <= max(1, times - 1) and lost <= max(3, 0.2 * len(q)) * times and lead <= 8 and not any(w.isdigit() for w in a[:lead])


def _matched(q: list[str], a: list[str]) -> tuple[int, int, int]:
    """Words of ``a`` that are those of ``q``, and how many stand ahead of the first and behind the last of them."""
    blocks = [b for b in difflib.SequenceMatcher(None, a, q, autojunk=False).get_matching_blocks() if b.size]
    return (sum(b.size for b in blocks), blocks[0].a, len(a) - blocks[-1].a - blocks[-1].size) if blocks else (0, 0, len(a))


def _repeats(q: list[str], a: list[str]) -> tuple[int, int, int]:
    """As :func:`_matched` for ``q`` said again and again, one time after the other."""
    matched, lead, at = 0, 0, 0
    while at < len(a):
        piece = a[at : at + len(q) + (1 if at else 9)]
        if not at:  # the second time doesn't belong to the first
            lead = next((i for i in range(9) if piece[i : i + 2] == q[:2]), 0)
            piece = piece[: lead + len(q) + 1]
        found, _, behind = _matched(q, piece)
        if not found:
            break
        matched, at = matched + found, at + len(piece) - behind
    return matched, lead, len(a) - at


def asked_language(query: str) -> str | None:
    """The language that the query asks to be answered in."""
    last = None
    for m in _ASKED.finditer(query):
        last = next(k[:2] for k, v in m.groupdict().items() if v)
    return last


def wrong_language(model: Model, query: str, answer: str) -> bool:
    """The prose fits another language clearly better than the one asked for, or else the query's."""
    if len(model.languages) < 2:
        return False
    if (opened := re.search(r"(?i)<think(?:ing)?\b[^>]*>", answer)) is not None:  # an open block isn't the answer
        answer = answer[: opened.start()]
    if query.strip():
        answer = answer.replace(query.strip(), " ")
    text = prose(answer)
    letters = sum(c.isalpha() for c in text) + 3 * len(re.findall(r"[一-鿿]", text))
    if letters < LETTERS:
        return False
    wanted = asked_language(query)
    if wanted is None:
        own = prose(query)
        if sum(c.isalpha() for c in own) + 3 * len(re.findall(r"[一-鿿]", own)) < LETTERS:
            return False
        posterior = model.posterior(own)
        if posterior.max() < 0.66:
            return False
        wanted = model.languages[int(posterior.argmax())]
    if wanted not in model.languages:
        return False
    posterior = model.posterior(text, wanted, PRIOR)
    return bool(posterior[model.languages.index(wanted)] < posterior.max())


def _first_defects(model: Model, ratio: Ratio, queries: list[str | None], answers: list[str | None]) -> list[str | None]:
    """Of each pair the first defect but truncation."""
    found: list[str | None] = []
    for q, a in zip(queries, answers):
        found.append("empty" if is_empty(a) else "copied_question" if q is not None and q.strip() and is_copied(q, a) else None)
    left = [i for i, f in enumerate(found) if f is None]
    for i, declined in zip(left, ratio.declining([answers[i] for i in left])):
        if declined:
            found[i] = "refusal"
        elif queries[i] is not None and wrong_language(model, queries[i], answers[i]):
            found[i] = "wrong_language"
    return found


def defects(pairs: DataFrame, labelled: DataFrame, bound: int = LABELLED) -> DataFrame:
    """Defective pairs of ``source_table, record_id, sample_index, query, answer``: the keys and ``defect``.

    ``labelled`` has ``text`` and ``lang`` for the language model. A null answer is empty; without a query there is
    neither a copy nor a wrong language. Keys must tell pairs apart. An empty table gives an empty result.
    """
    keys = ["source_table", "record_id", "sample_index"]
    closed = F.regexp_replace("answer", r"(?is)<(think(?:ing)?)\b[^>]*>.*?</\1\s*>", "")
    rows = pairs.select(*keys, "query", closed.alias("answer"))
    sent = pairs.sparkSession.sparkContext.broadcast((fitted(labelled, labelled=bound), refusals.fitted(labelled.select("text"), rows.select("answer"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = _first_defects(*sent.value, b.column(3).to_pylist(), b.column(4).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], b.column(4), pa.array(found, pa.string())], [*keys, "answer", "defect"])

    # few bytes, much work a row: partitions by the cores, not by the size
    spread = rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)
    told = written(spread.mapInArrow(run, "source_table string, record_id string, sample_index int, answer string, defect string"), "pairs")
    sound = told.where("defect is null")
    texts = written(versions(sound, "answer"), "answers")
    stopped = judged(texts, written(tails(texts), "tails")).where("cut").select("version")
    cut = sound.select(*keys, version_of("answer")).join(stopped, "version").select(*keys, F.lit("truncated").alias("defect"))
    return told.where("defect is not null").select(*keys, "defect").unionByName(cut)


def stated_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Responses of the two tables with their items' queries, each record once."""
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    queries = read("items").where("item_id is not null").groupBy("item_id").agg(F.max("query").alias("query"))
    once = read("rollouts").where("item_key is not null").groupBy("item_key").agg(F.max(F.struct("predictions", "item_id")).alias("row"))
    many = once.select(F.lit("rollouts").alias("source_table"), F.col("item_key").alias("record_id"), "row.item_id", F.posexplode("row.predictions").alias("sample_index", "answer"))
    results = read("task_results").where("task_key is not null").groupBy("task_key").agg(F.max(F.struct("pred", "item_id")).alias("row"))
    one = results.select(F.lit("task_results").alias("source_table"), F.col("task_key").alias("record_id"), "row.item_id", F.lit(0).alias("sample_index"), F.col("row.pred").alias("answer"))
    return many.unionByName(one).join(queries, "item_id", "left").select("source_table", "record_id", "sample_index", "query", "answer")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return defects(stated_pairs(spark, folder), spark.read.parquet(f"{folder}/documents.parquet").select("text", "lang"))


def p1_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Defective responses by table and type."""
    return p1_found(spark, folder).groupBy("source_table", "defect").count().withColumnRenamed("count", "n_answers")
