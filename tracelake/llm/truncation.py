"""Texts cut off by field limits.

Near-copies come first: a copy that was cut holds the beginning of its source, so texts are compared by the word shingles
(SHINGLE words) of their beginnings. Every text is signed by min-hash bands over its first 1, 2, 4, ... shingles, the longest
such beginning before its last word; a longer text is signed over the same beginnings, wherever the end of another text (the
words before its last one, and what it has of that and of the marks behind it) stands in it. Texts that agree in a band and in
this place are verified (SIMILAR or more of the shorter one's shingles stand in the longer one) and aligned by their words; the
copy whose alignment ends early, inside a sentence of the longer one, is flagged, however its own end looks. Records that
this doesn't flag are scored by closing-word terminality (:mod:`tracelake.llm.endings`).

What matters of a holder besides its similarity is how it goes on, of which there are few kinds: of the holders of a place and
a kind only the longest is compared first; a text that passes but isn't similar to it meets all of them. Copies of a text are
one version and are compared once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm.endings import COMPLETE, body_of, judged, structure, tails, version_of, versions
from tracelake.llm.sketch import MAX_BITS, chooser, in_map
from tracelake.session import written

SHINGLE, SIMILAR, BANDS = 5, 0.8, 3
#: How a text goes on behind a place: not in its line, inside a word or number, with a mark that ends a sentence, with a small
#: letter behind blanks, with something else behind blanks, with another mark.
OVER, WITHIN, STOPPED, SMALL, LARGE, MARKED = range(6)
_CJK = "一-鿿぀-ヿ가-힯"
_WORD = re.compile(rf"[^\W\d_{_CJK}]+|\d+|[{_CJK}]")
_STOP = re.compile(r"[.?!。？！][\"'”’»)\]}*]*\Z")
#: A number or letter that heads an item of a list.
_ITEM = re.compile(r"(?:^|\n)[ \t>*-]*\w{1,3}\.\Z")
_SALTS = np.random.default_rng(7).integers(1, 2**63, BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.array([pow(_BASE, k, 1 << 64) for k in range(SHINGLE)], np.uint64)
_LETTER, _DIGIT, _SIGN = 1, 2, 3
_SEGMENT = 1 << 20


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _kinds() -> np.ndarray:
    """Kind of each character: part of a word of letters, of a number, a word by itself, or none; bit 3 marks small letters."""
    if not hasattr(_kinds, "made"):
        table = np.zeros(0x110000, np.uint8)
        for i in range(0x30000):
            c = chr(i)
            if _WORD.match(c):
                table[i] = _DIGIT if c.isdecimal() else _SIGN if re.match(rf"[{_CJK}]", c) else _LETTER
            table[i] |= 8 * c.islower()
        _kinds.made = table
    return _kinds.made


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not hasattr(_powers, "made") or len(_powers.made[0]) < n:
        n = max(n, 2 * _SEGMENT)
        _powers.made = np.cumprod(np.full(n, _BASE, np.uint64)), np.cumprod(np.full(n, pow(_BASE, -1, 1 << 64), np.uint64))
    return _powers.made


class Shingled:
    """Texts of at least SHINGLE words, read as one array of characters.

    ``rows`` numbers them; over the windows of SHINGLE words of all of them, one text after the other, ``shingles`` and ``anchors`` (a
    window without its last word) are hashes, and ``last`` and ``stop`` tell where the last word begins and where the next one does
    (or the text ends). ``begins`` and ``windows`` tell the texts apart, ``ends`` is the end of each.
    """

    def __init__(self, texts: list[str]):
        self.codes = codes = np.frombuffer(("\0".join(texts) + "\0\0").encode("utf-32-le", "surrogatepass"), np.uint32)
        found = _kinds()[codes]
        kind = found & 7
        self.kind, self.small = kind, found >= 8
        power, inverse = _powers(len(codes))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(codes.astype(np.uint64) + np.uint64(7)) * power[: len(codes)])])
        self.inverse = inverse
        before = np.concatenate([[0], kind[:-1]])
        starts = np.flatnonzero((kind != 0) & ((kind != before) | (kind == _SIGN)))
        after = np.concatenate([kind[1:], [0]])
        stops = np.flatnonzero((kind != 0) & ((kind != after) | (kind == _SIGN))) + 1
        lengths = np.array([len(t) for t in texts], np.int64)
        text_ends = np.cumsum(lengths + 1) - 1
        first = np.searchsorted(starts, np.concatenate([[0], text_ends[:-1] + 1]) if len(texts) else [])
        size = np.diff(np.append(first, len(starts)))
        self.rows = np.flatnonzero(size >= SHINGLE)
        self.ends = text_ends[self.rows]
        self.windows = size[self.rows] - SHINGLE + 1
        self.begins = np.cumsum(self.windows) - self.windows
        words = self.hashes(starts, stops)
        of = np.repeat(np.arange(len(self.rows)), self.windows)
        head = first[self.rows][of] + np.arange(len(of)) - self.begins[of]  # first word of each window
        self.anchors = sum((words[head + k] * _POWERS[k] for k in range(SHINGLE - 1)), np.zeros(len(head), np.uint64))
        self.shingles = self.anchors + words[head + SHINGLE - 1] * _POWERS[SHINGLE - 1] if len(head) else self.anchors
        self.last = starts[head + SHINGLE - 1] if len(head) else head
        self.stop = np.minimum(np.append(starts, len(codes))[head + SHINGLE], self.ends[of]) if len(head) else head
        self.of = of

    def hashes(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Hashes of the stretches between the places."""
        return _mixed((self.sums[stops] - self.sums[starts]) * self.inverse[starts])

    def heads(self, picks: list[tuple[int, np.ndarray]]) -> list[np.ndarray]:
        """For each (level, texts) the bands of the first ``2 ** level`` shingles of these texts, a row a band; level -1 is no shingle."""
        out = [np.full((BANDS, len(of)), level + 1, np.uint64) for level, of in picks]
        edges = [np.stack([self.begins[of], self.begins[of] + (1 << max(level, 0))], axis=1).ravel() for level, of in picks]
        for k, salt in enumerate(_SALTS):
            h = np.append(_mixed(self.shingles * salt), np.uint64(0))
            for (level, of), at, found in zip(picks, edges, out):
                if level >= 0 and len(of):
                    found[k] ^= np.minimum.reduceat(h, at)[::2]
                found[k] = _mixed(found[k] + np.uint64(k))
        return out

    def goes_on(self, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How the texts, that end at ``end``, go on at the places."""
        if not hasattr(self, "full"):
            blank = (self.codes == 32) | (self.codes == 9) | (self.codes == 13)
            place = np.where(blank, len(self.codes) - 1, np.arange(len(self.codes)))
            self.full = np.minimum.accumulate(place[::-1])[::-1]  # the next place that isn't blank
            self.mark = np.isin(self.codes, np.frombuffer(".?!。？！".encode("utf-32-le"), np.uint32))
        q = self.full[at]
        now, then = self.kind[at] != 0, self.kind[np.minimum(at + 1, len(self.codes) - 1)] != 0
        inside = now & (self.full[at - 1] < at) & (self.codes[at - 1] != 10)  # nothing stands between
        over = (q >= end) | (self.codes[q] == 10)
        return np.select([over, inside | (self.mark[at] & then), self.mark[at], (q > at) & self.small[q], (q > at) | now], [OVER, WITHIN, STOPPED, SMALL, LARGE], MARKED)


def _segments(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Texts of a batch in parts of about _SEGMENT characters, with the number of the first."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= _SEGMENT:
            yield at, texts[at : i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def _level(shingles: np.ndarray) -> np.ndarray:
    """Number of the longest beginning that so many shingles hold."""
    return np.where(shingles >= 1, np.log2(np.maximum(shingles, 1)).astype(np.int64), -1)


def _joint(bands: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Keys of bands and places."""
    return _mixed(bands ^ (places * np.uint64(_BASE))).view(np.int64)


def _stop_of(text: str) -> int:
    """How a text ends: without a mark (0), with one that ends a sentence (1), a point (2), a point behind the number of an item (3), a closing mark (4)."""
    if not _STOP.search(text[-40:]):
        return 4 if text[-1] in ">`]}" else 0
    return 1 if text[-1] != "." else 3 if _ITEM.search(text[-40:]) else 2


def _passes(stop: Column, complete: Column, kind: Column) -> Column:
    """Whether an end that stands in a text which goes on so is a cut."""
    pointed = (kind == WITHIN) | (kind == SMALL) | ((stop == 3) & (kind == LARGE))
    return (kind != OVER) & F.when(stop == 1, False).when(stop.isin(2, 3), pointed).otherwise((kind != STOPPED) & ~(complete & (stop == 4)))


def endings_of(texts: DataFrame) -> DataFrame:
    """How each of the texts (``version, text``) of at least SHINGLE words ends: ``version, size, stop, anchor, place, joint``.

    ``anchor`` are the SHINGLE - 1 words before the last, ``place`` these and what follows, ``joint`` a key for each band.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [body_of(t) for t in b.column(1).to_pylist()]
            for first, part in _segments(own):
                read = Shingled(part)
                at = read.begins + read.windows - 1
                place = _mixed(read.anchors[at] ^ read.hashes(read.last[at], read.ends))
                level = _level(read.windows - 1)
                joint = np.zeros((BANDS, len(at)), np.int64)
                picks = [(int(x), np.flatnonzero(level == x)) for x in np.unique(level)]
                for (_, of), found in zip(picks, read.heads(picks)):
                    joint[:, of] = _joint(found, place[of])
                rows = read.rows.tolist()
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * BANDS), pa.array(joint.T.ravel()))
                cols = [b.column(0).take(pa.array(read.rows + first)), pa.array([len(part[i]) for i in rows], pa.int32()), pa.array([_stop_of(part[i]) for i in rows], pa.int32()), pa.array(read.anchors[at].view(np.int64)), pa.array(place.view(np.int64)), lists]
                yield pa.RecordBatch.from_arrays(cols, ["version", "size", "stop", "anchor", "place", "joint"])

    return texts.select("version", "text").mapInArrow(run, "version binary, size int, stop int, anchor long, place long, joint array<long>")


def holders(texts: DataFrame, maps: tuple[bytes | None, bytes | None, bytes | None], every: bool = False) -> DataFrame:
    """``joint, kind, size, version`` for each place in each text where a text of one of its bands may end, by how it goes on.

    Maps of the anchors, places and joint keys asked for choose the rows, or a column ``sites`` with the anchors. Of the texts of
    a batch that agree in ``joint`` and ``kind`` the longest stands for all, but with ``every``.
    """
    columns = ["version", "text"] + ["sites"] * ("sites" in texts.columns)
    sent = texts.sparkSession.sparkContext.broadcast(maps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, places, joints = sent.value
        for b in batches:
            own = [body_of(t) for t in b.column(1).to_pylist()]
            wanted = None
            if len(columns) > 2:
                rows = np.repeat(np.arange(len(b), dtype=np.uint64), pc.list_value_length(b.column(2)).to_numpy(zero_copy_only=False))
                wanted = _joint(rows, pc.list_flatten(b.column(2)).to_numpy(zero_copy_only=False).view(np.uint64))
            found: list[np.ndarray] = []
            for first, part in _segments(own):
                read = Shingled(part)
                chosen = in_map(anchors, read.anchors.view(np.int64)) if wanted is None else np.isin(_joint((read.rows[read.of] + first).astype(np.uint64), read.anchors), wanted)
                at = np.flatnonzero(chosen)
                long = read.stop[at] - read.last[at]  # as many ends are there
                at = np.repeat(at, long)
                stop = read.last[at] + 1 + np.arange(len(at)) - np.repeat(np.cumsum(long) - long, long)
                place = _mixed(read.anchors[at] ^ read.hashes(read.last[at], stop))
                of = read.of[at]
                keep = np.flatnonzero(in_map(places, place.view(np.int64)))
                kind = read.goes_on(stop[keep], read.ends[of[keep]])
                keep, kind = keep[kind != OVER], kind[kind != OVER]
                at, place, of = at[keep], place[keep], of[keep]
                before = at - read.begins[of]
                near = np.stack([_level((before * SIMILAR).astype(np.int64)), _level((before / SIMILAR).astype(np.int64)), _level(before)])
                near = np.where((1 << np.maximum(near, 0)) <= read.windows[of], near, near[0])
                held = [(int(x), np.flatnonzero((near == x).any(axis=0))) for x in np.unique(near)]
                picks = [(x, np.unique(of[k])) for x, k in held]
                for (_, texts_), (_, k), bands in zip(picks, held, read.heads(picks)):
                    column = np.searchsorted(texts_, of[k])
                    for band in bands:
                        joint = _joint(band[column], place[k])
                        hit = np.flatnonzero(in_map(joints, joint))
                        row = read.rows[of[k[hit]]] + first
                        found.append(np.stack([joint[hit], kind[k[hit]].astype(np.int64), row]))
            if not found:
                continue
            joint, kind, row = np.concatenate(found, axis=1)
            size = np.array([len(t) for t in own], np.int32)[row]
            order = np.lexsort((row, -size, kind, joint))
            joint, kind, row, size = joint[order], kind[order], row[order], size[order]
            fresh = np.ones(len(row), bool)
            fresh[1:] = (joint[1:] != joint[:-1]) | (kind[1:] != kind[:-1]) | (every & (row[1:] != row[:-1]))
            yield pa.RecordBatch.from_arrays([pa.array(joint[fresh]), pa.array(kind[fresh].astype(np.int32)), pa.array(size[fresh]), b.column(0).take(pa.array(row[fresh]))], ["joint", "kind", "size", "version"])

    return texts.select(*columns).mapInArrow(run, "joint long, kind int, size int, version binary")


def ends_early(short: str, long: str) -> bool:
    """Whether ``short`` is a near-copy of the beginning of ``long`` that stops inside one of its sentences."""
    short, long = body_of(short), body_of(long)
    words, places = [m.span() for m in _WORD.finditer(short)], [m.span() for m in _WORD.finditer(long)]
    if len(words) < SHINGLE:
        return False
    mine, others = [short[x:y] for x, y in words], [long[x:y] for x, y in places]
    grams = lambda ws: {tuple(ws[k : k + SHINGLE]) for k in range(len(ws) - SHINGLE + 1)}
    own = grams(mine[:-1])  # the last word may be a part of one
    if len(own & grams(others)) < SIMILAR * len(own):
        return False
    anchor, tail, k = mine[-SHINGLE:-1], short[words[-1][0] :], len(mine) - SHINGLE
    stop, complete = _stop_of(short), structure(short)[0] == COMPLETE
    for i in range(max(0, int(k * SIMILAR) - 1), min(len(others) - SHINGLE, int(k / SIMILAR) + 1) + 1):
        if others[i : i + SHINGLE - 1] == anchor and long.startswith(tail, at := places[i + SHINGLE - 1][0]) and _cuts(stop, complete, long, at + len(tail)):
            return True
    return False


def _cuts(stop: int, complete: bool, long: str, at: int) -> bool:
    """As :func:`_passes`, of one text."""
    rest = long[at:].lstrip(" \t\r")
    if rest[:1] in ("", "\n") or stop == 1:
        return False
    blank, word = len(rest) < len(long) - at, bool(_WORD.match(rest))
    within = not blank and (word and not long[at - 1].isspace() or rest[0] in ".?!。？！" and bool(_WORD.match(rest[1:2])))
    if stop in (2, 3):
        return within or not blank and word or blank and (rest[0].islower() or stop == 3)
    return (within or blank or rest[0] not in ".?!。？！") and not (complete and stop == 4)


def cut_copies(texts: DataFrame, states: DataFrame) -> DataFrame:
    """``version`` of the texts (``version, text``, each once) that are cut-off near-copies of another one.

    ``states`` has their ``version`` and ``state``, and perhaps ``cut``: what is known as cut already is compared with the longest
    holders only, as no other one changes that.
    """
    ending = written(endings_of(texts).join(states.select("version", (F.col("state") == COMPLETE).alias("complete")), "version"), "endings")
    asked = ending.select("version", "stop", "complete", "anchor", "place", F.explode("joint").alias("joint"))
    held = _held(texts, asked).groupBy("joint", "kind").agg(F.max(F.struct("size", "version")).alias("top")).select("joint", "kind", F.col("top.size").alias("most"), F.col("top.version").alias("other"))
    held = _sent_if_small(written(held, "held"))
    first = written(_candidates(asked, held).groupBy("version").agg(F.max(F.struct("most", "other")).alias("top")).select("version", "top.other"), "pairs")
    settled = written(_verified(first, texts), "settled")
    # what the longest holder doesn't settle meets every holder
    left = first.join(settled, "version", "left_anti").select("version")
    if "cut" in states.columns:
        left = left.join(states.where("cut").select("version"), "version", "left_anti")
    left = written(asked.join(_sent_if_small(written(left, "left")), "version", "left_semi"), "unsettled")
    if left.isEmpty():
        return settled
    others = _candidates(left, _held(texts, left, True).withColumnsRenamed({"size": "most", "version": "other"})).select("version", "other").distinct()
    more = _verified(written(others.join(first, ["version", "other"], "left_anti"), "others"), texts)
    return settled.unionByName(more).distinct()


def _sent_if_small(rows: DataFrame, most: int = 500_000) -> DataFrame:
    """A written table of some short columns, to be sent if it has at most ``most`` rows (some 20 MB); a larger one is shuffled."""
    return F.broadcast(rows) if rows.count() <= most else rows


def _held(texts: DataFrame, asked: DataFrame, every: bool = False) -> DataFrame:
    """The holders of the places that are asked for.

    Where the maps of the places would be too large to send, the texts that hold the last words of another one are found
    first, by a join of all such words, and only those are read again, with their places at hand.
    """
    maps = [chooser(asked.select(x), MAX_BITS) for x in ("anchor", "place", "joint")]
    if None not in maps:
        return holders(texts, tuple(maps), every)
    sites = _sites(texts).join(asked.select("anchor").distinct(), "anchor", "left_semi").groupBy("version").agg(F.collect_set("anchor").alias("sites"))
    return holders(texts.join(sites, "version"), tuple(maps), every).join(asked.select("joint").distinct(), "joint", "left_semi")


def _sites(texts: DataFrame) -> DataFrame:
    """``version, anchor``: every run of SHINGLE - 1 words before another one in each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, part in _segments([body_of(t) for t in b.column(1).to_pylist()]):
                read = Shingled(part)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(read.rows[read.of] + first)), pa.array(read.anchors.view(np.int64))], ["version", "anchor"])

    return texts.select("version", "text").mapInArrow(run, "version binary, anchor long")


def _candidates(asked: DataFrame, held: DataFrame) -> DataFrame:
    """``version, most, other``: ends that stand in a text which goes on in their sentence."""
    return asked.join(held, "joint").where(F.col("version") != F.col("other")).where(_passes(F.col("stop"), F.col("complete"), F.col("kind"))).select("version", "most", "other").distinct()


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``version`` of the pairs (written) whose text ends early in that of ``other``."""
    told = written(pairs.select(F.explode(F.array("version", "other")).alias("version")).distinct(), "told")
    sided = written(texts.select("version", "text").join(_sent_if_small(told), "version", "left_semi"), "sided")
    both = pairs.join(sided.select("version", F.col("text").alias("short")), "version").join(sided.select(F.col("version").alias("other"), F.col("text").alias("long")), "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [ends_early(x, y) for x, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield b.select(["version"]).filter(pa.array(keep, pa.bool_()))

    return both.select("version", "short", "long").mapInArrow(run, "version binary").distinct()


def truncated(records: DataFrame) -> DataFrame:
    """Of records (``source_table, record_id, text``) those cut off: with ``by`` (copy, structure, ending).

    Null texts give no row, repeated rows one. Equal texts are one version, compared once, whatever their end looks like.
    Further columns are ignored. An empty table gives no row.
    """
    rows = records.where(F.col("text").isNotNull())
    texts = written(versions(rows, "text"), "texts")
    told = written(judged(texts, written(tails(texts), "tails")).select("version", "state", "cut"), "judged")
    copies = cut_copies(texts, told).withColumn("copy", F.lit(True))
    by = F.when(F.col("copy"), "copy").when(F.col("state") == 1, "structure").otherwise("ending")
    found = written(told.join(copies, "version", "left").where("cut or copy").select("version", by.alias("by")), "found")
    return rows.select("source_table", "record_id", version_of("text")).join(_sent_if_small(found), "version").groupBy("source_table", "record_id").agg(F.min("by").alias("by"))


def records(spark: SparkSession, folder: str) -> DataFrame:
    """The texts of the two tables as delivered: ``source_table, record_id, source_dataset, text``."""
    events = spark.read.parquet(f"{folder}/session_events.parquet").select(F.lit("session_events").alias("source_table"), F.col("event_id").cast("string").alias("record_id"), "source_dataset", F.col("content").alias("text"))
    results = spark.read.parquet(f"{folder}/task_results.parquet").select(F.lit("task_results").alias("source_table"), F.col("task_key").alias("record_id"), "source_dataset", F.col("pred").alias("text"))
    return events.unionByName(results).where("record_id is not null")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return truncated(records(spark, folder)).select("source_table", "record_id")


def p3_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Texts, cut texts and their share, for each table and source."""
    rows = records(spark, folder)
    each = rows.where("text is not null").select("source_table", "record_id", "source_dataset").distinct()
    told = each.join(truncated(rows).withColumn("hit", F.lit(1)), ["source_table", "record_id"], "left")
    counts = told.groupBy("source_table", "source_dataset").agg(F.count("*").alias("n_texts"), F.count("hit").alias("n_cut"))
    return counts.withColumn("cut_share", F.round(F.col("n_cut") / F.col("n_texts"), 6))
