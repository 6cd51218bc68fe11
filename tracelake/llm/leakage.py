"""Passages of evaluation items inside a corpus.

Each shard of the corpus becomes an FM-index over words: a suffix array gives the Burrows-Wheeler transform, a wavelet
matrix answers rank, every ``SAMPLE``-th suffix position is kept. The test phrases, all runs of ``MIN_WORDS`` words of the
items, are searched backward through the ranks, all at once; hits are located by walking to the next kept position and
neighbouring hits are merged to spans.

A word that no item uses can't be part of a hit, so a shard's sequence holds only its runs of at least ``MIN_WORDS``
words of the items' vocabulary, with a separator between runs. This leaves out nothing that could be found.

The items are a stated query set against all documents; they are sent in blocks of at most ``BLOCK_WORDS`` words.
"""

from __future__ import annotations

import difflib
import html
import re
import sys
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.session import written

MIN_WORDS, SAMPLE, SHARD, BLOCK_WORDS = 12, 32, 1 << 21, 2_000_000

_INVISIBLE = re.compile("[" + "".join(re.escape(chr(c)) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cf" or chr(c) in "͏᠋᠌᠍᠏" or 0xFE00 <= c <= 0xFE0F) + "]")
_ESCAPED = re.compile(r"\\+(?:r\\+n|[nrtvf]|u000[9aAbBcCdD]|x0[9aAbBcCdD]|u2028|u2029|u0085)")
_COMMENT = re.compile(r"(?s)<!--.*?-->")
_INLINE = re.compile(r"(?i)</?(?:a|abbr|b|bdi|bdo|big|cite|code|del|dfn|em|font|i|ins|kbd|mark|q|s|samp|small|span|strike|strong|sub|sup|tt|u|var|wbr)(?:\s[^<>]*)?/?>")
_TAG = re.compile(r"</?[a-zA-Z!?][^<>]*>")
_LINK = re.compile(r"\]\([^()\s]*(?:\s+\"[^\"]*\")?\)")
_WORD = re.compile(r"[^\W_]+")
_ASCII = {i: chr(i).lower() if chr(i).isalnum() else " " for i in range(128)}


def words(text: str) -> list[str]:
    """Words of a text: runs of letters or digits, without case, width, markup, entities, invisible characters, escaped breaks."""
    for _ in range(2):
        if "&" in text and ";" in text:
            text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", _INLINE.sub("", _COMMENT.sub("", text)))
    if "](" in text:
        text = _LINK.sub("]", text)
    if "\\" in text:
        text = _ESCAPED.sub(" ", text)
    if text.isascii():
        return text.translate(_ASCII).split()
    return _WORD.findall(unicodedata.normalize("NFKC", _INVISIBLE.sub("", text)).casefold())


#: A character reference (a fixed pattern of the language).
_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)")


class _Traced:
    """A text under replacement, with the places that each character comes from."""

    def __init__(self, text: str):
        self.text, self.begin, self.end = text, np.arange(len(text)), np.arange(1, len(text) + 1)

    def put(self, spans: Iterable[tuple[int, int, str]]) -> None:
        """Replace stretches, in order; a new character comes from its whole stretch."""
        parts, begins, ends, last = [], [], [], 0
        for a, b, new in spans:
            parts += [self.text[last:a], new]
            begins += [self.begin[last:a], np.full(len(new), self.begin[a])]
            ends += [self.end[last:a], np.full(len(new), self.end[b - 1])]
            last = b
        if parts:
            self.text = "".join(parts) + self.text[last:]
            self.begin, self.end = np.concatenate([*begins, self.begin[last:]]), np.concatenate([*ends, self.end[last:]])

    def sub(self, pattern: re.Pattern, new: Callable[[str], str]) -> None:
        self.put((m.start(), m.end(), new(m.group())) for m in pattern.finditer(self.text))


def _clusters(text: str) -> Iterator[tuple[int, int, str]]:
    """Characters with the marks that combine with them, in their folded form."""
    at = 0
    while at < len(text):
        stop = at + 1
        while stop < len(text) and unicodedata.combining(text[stop]):
            stop += 1
        yield at, stop, unicodedata.normalize("NFKC", text[at:stop]).casefold()
        at = stop


def word_places(text: str) -> list[tuple[int, int]]:
    """Where each of the :func:`words` stands in the text: its first character and the one behind its last."""
    t = _Traced(text)
    for _ in range(2):
        if "&" in t.text and ";" in t.text:
            t.sub(_REFERENCE, html.unescape)
    if "<" in t.text:
        for pattern, new in ((_COMMENT, ""), (_INLINE, ""), (_TAG, " ")):
            t.sub(pattern, lambda _, new=new: new)
    if "](" in t.text:
        t.sub(_LINK, lambda _: "]")
    if "\\" in t.text:
        t.sub(_ESCAPED, lambda _: " ")
    if not t.text.isascii():
        t.sub(_INVISIBLE, lambda _: "")
        t.put(_clusters(t.text))
    found = list(_WORD.finditer(t.text))
    spans = [(int(t.begin[m.start()]), int(t.end[m.end() - 1])) for m in found]
    expect, own = words(text), [m.group().lower() for m in found]
    if own != expect:  # characters that fold together over several: the words that agree keep their places, others lie between
        out: list[tuple[int, int]] = []
        for tag, a, b, c, d in difflib.SequenceMatcher(None, own, expect, autojunk=False).get_opcodes():
            around = (spans[a][0] if a < len(spans) else len(text), spans[b - 1][1] if b > a else spans[a][0] if a < len(spans) else len(text))
            out += spans[a:b] if tag == "equal" else [around] * (d - c)
        return out
    return spans


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling."""
    n = len(text)
    rank, width = text.astype(np.int64), 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: max(0, n - width)] = rank[width:] + 1
        key = rank * (int(rank.max(initial=0)) + n + 2) + ahead
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.cumsum(np.concatenate([[0], (sorted_key[1:] != sorted_key[:-1]).astype(np.int64)])) if n else order
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        width *= 2
        if not n or fresh[-1] == n - 1 or width > 2 * n:
            return order


class FmIndex:
    """FM-index of a sequence of small integers."""

    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        text = np.concatenate([text + 1, [0]])  # with a last symbol that is the least and stands once
        order = suffix_array(text)
        bwt = text[order - 1]
        self.n = len(text)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=int(text.max()) + 1))])
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        self.depth = max(1, int(text.max()).bit_length())
        now = bwt
        for level in range(self.depth - 1, -1, -1):
            bits = ((now >> level) & 1).astype(bool)
            packed = np.zeros(-(-self.n // 64) * 8 + 8, np.uint8)
            raw = np.packbits(bits, bitorder="little")
            packed[: len(raw)] = raw
            blocks = packed.view(np.uint64)
            self.levels.append((blocks, np.concatenate([[0], np.cumsum(np.bitwise_count(blocks), dtype=np.int64)]), int(self.n - bits.sum())))
            now = np.concatenate([now[~bits], now[bits]])
        self.bwt, self.sample = bwt, sample
        self.kept = order % sample == 0
        self.kept_before = np.cumsum(self.kept) - 1
        self.places = order[self.kept]

    @staticmethod
    def _ones(blocks: np.ndarray, total: np.ndarray, at: np.ndarray) -> np.ndarray:
        block, bit = at >> 6, (at & 63).astype(np.uint64)
        return total[block] + np.bitwise_count(blocks[block] & ((np.uint64(1) << bit) - np.uint64(1)))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the transform before ``at``."""
        low = np.zeros_like(at)
        for k, (blocks, total, zeros) in enumerate(self.levels):
            one = ((symbol >> (self.depth - 1 - k)) & 1).astype(bool)
            a, b = self._ones(blocks, total, at), self._ones(blocks, total, low)
            at, low = np.where(one, zeros + a, at - a), np.where(one, zeros + b, low - b)
        return at - low

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row range of each phrase (one a row), by backward search."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        phrases = phrases + 1
        alive = np.flatnonzero((phrases < len(self.before) - 1).all(axis=1))
        for k in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, k]
            low[alive] = self.before[symbol] + self.rank(symbol, low[alive])
            high[alive] = self.before[symbol] + self.rank(symbol, high[alive])
            alive = alive[high[alive] > low[alive]]
        found = np.zeros(len(phrases), bool)
        found[alive] = True
        return np.where(found, low, 0), np.where(found, high, 0)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of rows: steps back until a kept suffix."""
        place, steps, left = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64), np.arange(len(rows))
        rows = rows.copy()
        while len(left):
            kept = self.kept[rows[left]]
            done = left[kept]
            place[done] = self.places[self.kept_before[rows[done]]] + steps[done]
            left = left[~kept]
            symbol = self.bwt[rows[left]]
            rows[left] = self.before[symbol] + self.rank(symbol, rows[left])
            steps[left] += 1
        return place


def _phrases(items: list[tuple[object, list[str]]], least: int) -> tuple[dict[str, int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Vocabulary (from 1), distinct phrases, and for each phrase the items and offsets it stands at (as ranges)."""
    vocabulary: dict[str, int] = {}
    ids = [np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in ws], np.int64) for _, ws in items]
    grams = [np.lib.stride_tricks.sliding_window_view(x, least) for x in ids]
    owner = np.repeat(np.arange(len(items)), [len(g) for g in grams])
    offset = np.concatenate([np.arange(len(g)) for g in grams])
    distinct, inverse = np.unique(np.concatenate(grams), axis=0, return_inverse=True)
    order = np.argsort(inverse.ravel(), kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(inverse.ravel(), minlength=len(distinct)))])
    return vocabulary, distinct, first, owner[order], offset[order]


def _search_block(documents: DataFrame, key: str, text: str, items: list[tuple[object, list[str]]], item_type: str, least: int) -> DataFrame:
    sent = documents.sparkSession.sparkContext.broadcast((_phrases(items, least), [k for k, _ in items]))
    key_type = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (vocabulary, distinct, first, owner, offset), names = sent.value
        get = vocabulary.get
        parts: list[np.ndarray] = []
        docs: list[object] = []
        lengths: list[int] = []
        starts: list[int] = []
        schema: list[pa.DataType] = []

        def shard() -> pa.RecordBatch:
            out: list[tuple] = []
            if parts:
                sequence = np.concatenate([x for p in parts for x in (p, [0])])
                begin = np.concatenate([[0], np.cumsum(np.array(lengths) + 1)])
                index = FmIndex(sequence)
                low, high = index.search(distinct)
                n = high - low
                rows = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                place, phrase = index.locate(rows), np.repeat(np.arange(len(n)), n)
                many = first[phrase + 1] - first[phrase]
                at = np.repeat(first[phrase], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                place = np.repeat(place, many)
                run_of = np.searchsorted(begin, place, "right") - 1
                word = np.array(starts)[run_of] + place - begin[run_of]
                order = np.lexsort((place, place - offset[at], owner[at]))
                o, p, f, w, r = owner[at][order], place[order], offset[at][order], word[order], run_of[order]
                cut = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (p[1:] - f[1:] != p[:-1] - f[:-1]) | (p[1:] != p[:-1] + 1)])) if len(o) else np.empty(0, np.int64)
                stop = np.concatenate([cut[1:], [len(o)]])
                out = [(names[o[c]], docs[r[c]], int(w[c]), int(f[c]), int(e - c + least - 1)) for c, e in zip(cut, stop)]
            parts.clear(), docs.clear(), lengths.clear(), starts.clear()
            cols = list(zip(*out)) or [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(cols[0], _arrow(item_type)), pa.array(cols[1], schema[0]), *(pa.array(c, pa.int64()) for c in cols[2:])], ["item_id", "doc_id", "doc_word", "item_word", "n_words"])

        size = 0
        for batch in batches:
            schema[:] = [batch.schema.field(0).type]
            for doc, content in zip(batch.column(0), batch.column(1)):
                if not content.is_valid:
                    continue
                ids = [get(w, 0) for w in words(content.as_py())]
                if len(ids) < least:
                    continue
                ids = np.array(ids, np.int64)
                edge = np.flatnonzero(np.diff(np.concatenate([[0], ids != 0, [0]])))
                for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                    if b - a >= least:
                        parts.append(ids[a:b])
                        docs.append(doc.as_py())
                        lengths.append(b - a)
                        starts.append(a)
                        size += b - a + 1
                if size >= SHARD:
                    yield shard()
                    size = 0
        if schema:
            yield shard()

    return documents.select(key, text).mapInArrow(run, f"item_id {item_type}, doc_id {key_type}, doc_word long, item_word long, n_words long")


def _arrow(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[name]


def leaked_spans(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", query: str = "query", least: int = MIN_WORDS) -> DataFrame:
    """Spans of at least ``least`` words that a document shares with an item: places by word in either, length in words.

    Items with null or shorter queries have no phrase; null and empty texts hold none. Rows with a null key on either
    side are left out, repeated rows repeat nothing, further columns are ignored whatever their names. Every item that
    fits a passage is reported. Empty tables give an empty result.
    """
    documents, items = documents.where(F.col(key).isNotNull()), items.where(F.col(item_key).isNotNull() & F.col(query).isNotNull())
    item_type = items.schema[item_key].dataType.simpleString()
    size = items.agg(F.sum(F.octet_length(query))).first()[0] or 0
    blocks = max(1, -(-size // (4 * BLOCK_WORDS)))
    found = []
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64(item_key), F.lit(blocks)) == k).select(item_key, query).distinct().collect()
        if block := [(i, ws) for i, ws in ((r[0], words(r[1])) for r in rows) if len(ws) >= least]:
            found.append(_search_block(documents, key, text, block, item_type, least))
    if not found:
        key_type = documents.schema[key].dataType.simpleString()
        return documents.sparkSession.createDataFrame([], f"item_id {item_type}, doc_id {key_type}, doc_word long, item_word long, n_words long")
    every = found[0]
    for x in found[1:]:
        every = every.unionByName(x)
    return every.distinct()


def removal_spans(documents: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """What has to be cut out of each document: ``doc_id, start_char, end_char, n_words``, the spans of all items merged.

    ``found`` are :func:`leaked_spans`; places are characters of the text as it stands, with its markup. Spans that overlap
    or follow one another are one. Keys must tell the documents apart; of repeated rows one counts.
    """
    # the places of a document are bounded by its words
    runs = found.groupBy("doc_id", "doc_word").agg(F.max("n_words").alias("n")).groupBy("doc_id").agg(F.collect_list(F.struct(F.col("doc_word").alias("a"), (F.col("doc_word") + F.col("n")).alias("b"))).alias("runs"))
    rows = documents.where(F.col(key).isNotNull()).select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(runs, "doc_id").dropDuplicates(["doc_id"])
    key_type = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple[int, int, int, int]] = []
            for i, (content, spans) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                at = word_places(content)
                merged: list[list[int]] = []
                for s in sorted((s["a"], s["b"]) for s in spans):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                out += [(i, at[x][0], at[y - 1][1], y - x) for x, y in merged]
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(cols[0], pa.int64())), *(pa.array(c, pa.int64()) for c in cols[1:])], ["doc_id", "start_char", "end_char", "n_words"])

    return rows.select("doc_id", "text", "runs").mapInArrow(run, f"doc_id {key_type}, start_char long, end_char long, n_words long")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    found = leaked_spans(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/heldout_items.parquet"))
    return found.select("item_id", "doc_id").distinct()


def p6_spans(spark: SparkSession, folder: str) -> DataFrame:
    return leaked_spans(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/heldout_items.parquet"))


def p6_removals(spark: SparkSession, folder: str) -> DataFrame:
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    found = written(leaked_spans(documents, spark.read.parquet(f"{folder}/heldout_items.parquet")), "leaked")
    return removal_spans(documents, found)
