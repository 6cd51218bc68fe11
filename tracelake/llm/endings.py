"""Whether a text ends where its author stopped.

What can be read off one text, an open thinking block, code fence, bracket, tag or JSON text, or a note that the rest was
left out, decides alone. A text that ends without a closing mark is scored by the corpus: how often its last tokens are
followed by an end of text or line (closing-word terminality, with shorter contexts where a longer one is rare), and how
often a word ends after its last letters, and how often it is whole there and not the part of a longer word behind the same token
(so a part at which many texts were cut is no word). The counts cover every token of every distinct text, without the end that is
judged; to keep them small only contexts in which some open text ends are counted, chosen by a map of those contexts that
grows with their number (:func:`tracelake.llm.sketch.chooser`).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm.sketch import chooser, in_map

ORDERS, LETTERS = 4, 4
#: Occurrences a context needs to be trusted, and the shares below which an end is no end.
ENOUGH, LEAST_END, LEAST_WORD_END = 30, 0.05, 0.02
COMPLETE, CUT, OPEN = 0, 1, 2

#: Forms of notes that stand for text left out (fixed values).
NOTE = re.compile(
    r"[\[(<{]\s*(?:\.{3}|…)?\s*(?:\+\s*\d[\d,.]*\s*(?:more\s*)?(?:chars?|characters?|bytes?|tokens?|words?|lines?|Zeichen|caracteres|caractères|字符?)?|\d[\d,.]*\s*(?:more\s+)?(?:chars?|characters?|bytes?|tokens?|words?|lines?)\s*(?:more|omitted|truncated|left|removed|cut)?"
    r"|(?:[\w ]{0,24}\s)?(?:truncated|truncation|omitted|snipped|snip|clipped|cut off|gekürzt|abgeschnitten|tronqué|truncado|截断)(?:[ :,][\w :,./]{0,40})?)\s*[\])>}]",
    re.I,
)
_DOTS = re.compile(r"\s*(?:…|\.{3,})\s*\Z")
_THINK_OPEN, _THINK_CLOSE = re.compile(r"<think(?:ing)?\b[^>]*>", re.I), re.compile(r"</think(?:ing)?\s*>", re.I)
_TAG = re.compile(r"<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*?)(/?)>")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr p li dt dd option tr td th thead tbody tfoot".split())
_TOKEN = re.compile(r"[^\W\d_一-鿿぀-ヿ가-힯]+|\d+(?:[.,:/x-]\d+)*%?|[一-鿿぀-ヿ가-힯]|[^\w\s]|_|\n")
_PATH = re.compile(r"(?:^|[\s(\"'])(?:\w+:/)?[\w.~-]*[/\\][^\s\"'<>]*\.\w{1,5}\Z")
_NUMBERS = re.compile(r"[\s\d.,;:+%/x-]*\Z")
_ENDS = tuple(".?!。？！")
_CLOSERS = "\"'”’»)]}*_`）】」』> \t\n"
_MASK = (1 << 64) - 1


def _balanced_json(text: str) -> bool:
    try:
        json.loads(text)
    except ValueError:
        return False
    except RecursionError:
        return True
    return True


def body_of(text: str) -> str:
    """The text without blanks around it and without notes at its end that the rest was left out."""
    body = text.rstrip()
    while body:
        if body[-1] == "�":
            body = body.rstrip("�").rstrip()
            continue
        if body[-1] not in ")]>}" or (at := max(body.rfind(c) for c in "[(<{")) < 0 or not NOTE.fullmatch(body, at):
            break
        body = body[:at].rstrip()
        body = body[: -1 if body.endswith("…") else -3 if body.endswith("...") else len(body)].rstrip()
    return body.strip()


def structure(text: str) -> tuple[int, str]:
    """COMPLETE, CUT or OPEN, and what is left of the text without notes."""
    body = body_of(text)
    noted = len(body) != len(text.strip())
    if not any(c.isalnum() for c in body):
        return (CUT if noted and body else COMPLETE), body
    if noted:
        return CUT, body
    if "<" in body and len(_THINK_OPEN.findall(body)) > len(_THINK_CLOSE.findall(body)):
        return CUT, body
    if (fences := body.count("```")) % 2:
        return CUT, body
    head = body.lstrip("﻿ \t\n")
    if head[0] in "{[" and re.match(r"[{\[]\s*[\"{\[\]}\d-]", head) and not (head[0] == "[" and re.match(r"\[\d\d?:", head)):
        if _balanced_json(body):
            return COMPLETE, body
        if re.match(r"[{\[]\s*[\"{\[]", head) or "]" not in head:
            return CUT, body
    if not fences:
        bold = body.count("**")
        if bold % 2 and re.search(r"\*\*[^\s*]", body):
            return CUT, body
    if (boxed := body.rfind("\\boxed{")) >= 0:
        level = 0
        for c in body[boxed + 6 :]:
            level += (c == "{") - (c == "}")
            if not level:
                break
        if level:
            return CUT, body
    if (opened := body.rfind("<")) > body.rfind(">") and re.match(r"<[/!a-zA-Z]", body[opened:]):
        return CUT, body
    if head[0] == "<" or fences:
        seen: list[str] = []
        for close, name, _, own in _TAG.findall(body):
            name = name.lower()
            if name in _VOID or own:
                continue
            if not close:
                seen.append(name)
            elif name in seen:
                while seen.pop() != name:
                    pass
        if seen and head[0] == "<":
            return CUT, body
        if not seen and (body.endswith(">") or body.endswith("```")):
            return COMPLETE, body
    if fences and body.endswith("```"):
        return COMPLETE, body
    last = body.rstrip(_CLOSERS)
    if last.endswith(_ENDS) and not (body.endswith(("...", "…")) and _DOTS.search(body)):
        return COMPLETE, body
    if _NUMBERS.match(body.rpartition("\n")[2]) or not re.search(r"\s", body) and len(_TOKEN.findall(body)) == 1:
        return COMPLETE, body  # a line of numbers, a bare word
    if _PATH.search(body):
        return COMPLETE, body
    return OPEN, _DOTS.sub("", body) if body.endswith(("...", "…")) else body


def _class(word: str) -> int:
    """Hash of the class of a token: number, name or the word itself."""
    if word[0].isdigit():
        return xxhash.xxh3_64_intdigest("9%" if word[-1] == "%" else "9")
    return xxhash.xxh3_64_intdigest("N" if word[0].isupper() and len(word) > 3 else word.lower())


_START = xxhash.xxh3_64_intdigest("\x02start")
_NEWLINE = xxhash.xxh3_64_intdigest("\n")


class _Classes(dict):
    """Number of each token; ``hashes`` has the class of each number, ``times`` how often it was met."""

    def __init__(self) -> None:
        self.hashes: list[int] = [_START]
        self.times = np.zeros(1, np.int64)
        self.groups: dict[int, int] = {_START: 0}  # number of each class
        self.group: list[int] = [0]
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self.hashes)
        self.hashes.append(h := _class(word))
        self.group.append(self.groups.setdefault(h, len(self.groups)))
        return n

    def follow(self, before: np.ndarray, numbers: np.ndarray) -> None:
        """Count each token behind the class of the one before it."""
        self.pairs.append(np.unique(np.array(self.group, np.int64)[before] << 32 | numbers, return_counts=True))

    def followed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Classes before, tokens and how often they were met."""
        if not self.pairs:
            return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        key, of = np.unique(np.concatenate([k for k, _ in self.pairs]), return_inverse=True)
        n = np.bincount(of, weights=np.concatenate([n for _, n in self.pairs])).astype(np.int64)
        return np.array(list(self.groups), np.uint64)[key >> 32], key & 0xFFFFFFFF, n

    def add(self, numbers: np.ndarray) -> None:
        met = np.bincount(numbers, minlength=len(self.hashes))
        met[: len(self.times)] += self.times
        self.times = met


_WEIGHTS = np.array([(0x9E3779B97F4A7C15 * (2 * k + 3) ** 5) & _MASK | 1 for k in range(ORDERS)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _contexts(hashes: np.ndarray) -> list[np.ndarray]:
    """Keys of the contexts of 1, 2, ... tokens that end at each token; tokens run on over text starts."""
    keys, total = [], np.zeros(len(hashes), np.uint64)
    for k in range(ORDERS):
        shifted = np.zeros(len(hashes), np.uint64)
        shifted[k:] = hashes[: len(hashes) - k]
        total = total + shifted * _WEIGHTS[k]
        keys.append(_mixed(total + np.uint64(k + 1)))
    return keys


def _letter_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each letter of each word the keys of the last 2, 3, ... letters up to it, a mark before the word included.

    Gives a column for each number of letters (0 where the word is shorter), whether the letter ends its word, and the
    row of each word's last letter.
    """
    codes = np.frombuffer(("\x01" + "\x01".join(words) + "\x01").encode("utf-32-le"), np.uint32).astype(np.uint64)
    mark = codes == 1
    begins = np.maximum.accumulate(np.where(mark, np.arange(len(codes)), 0))
    place = np.arange(len(codes)) - begins  # letters since the mark
    mixed = _mixed(codes + np.uint64(7))
    keys = np.zeros((LETTERS - 1, len(codes)), np.uint64)
    total = np.zeros(len(codes), np.uint64)
    for k in range(LETTERS):
        shifted = np.zeros(len(codes), np.uint64)
        shifted[k:] = mixed[: len(codes) - k]
        total = total + shifted * _WEIGHTS[k]
        if k:
            keys[k - 1] = np.where(place >= k, _mixed(total + np.uint64(100 + k)) | np.uint64(1), 0)
    letter = ~mark
    ends = np.append(mark[1:], True)[letter]
    return keys[:, letter], ends, np.flatnonzero(ends)


def _part_keys(words: list[str], before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each letter of each word the key of the word up to it behind the token before the word; whether it ends the word, and whose it is."""
    codes = np.frombuffer(("\x01".join(words) + "\x01").encode("utf-32-le"), np.uint32).astype(np.uint64)
    mark = codes == 1
    of = np.cumsum(mark) - mark
    length = np.bincount(of[~mark], minlength=len(words))
    place = np.arange(mark.sum() and len(codes)) - np.repeat(np.cumsum(length + 1) - length - 1, length + 1)
    powers = np.cumprod(np.full(int(length.max(initial=0)) + 1, 0x9E3779B97F4A7C15, np.uint64))
    sums = np.cumsum(np.where(mark, np.uint64(0), _mixed(codes + np.uint64(11)) * powers[place]))
    begin = np.concatenate([[np.uint64(0)], sums[np.flatnonzero(mark)[:-1]]])
    keys = _mixed((sums - begin[of]) ^ (before[of] * _WEIGHTS[1]) + np.uint64(777)) | np.uint64(1)
    letter = ~mark
    return keys[letter], np.append(mark[1:], True)[letter], of[letter]


def _lettered(word: str) -> bool:
    return bool(word) and word[0].isalpha() and not "一" <= word[0] <= "鿿"


def _last_tokens(body: str) -> tuple[list[str], bool]:
    """At least the last ORDERS tokens, if there are as many, and whether they are all of the text's."""
    near = 200
    while near < len(body):
        found = _TOKEN.findall(body, len(body) - near)[1:]  # the first one may be a part
        if len(found) >= ORDERS:
            return found, False
        near *= 4
    return _TOKEN.findall(body), True


def tail_keys(bodies: list[str]) -> np.ndarray:
    """Keys of the contexts at the end of each text: tokens from one to ORDERS, then letters, then the last word as a part of one
    behind the token before it; 0 where there is none."""
    last = np.zeros((len(bodies), ORDERS), np.uint64)
    size = np.zeros(len(bodies), np.int64)
    out = np.zeros((len(bodies), ORDERS + LETTERS), np.uint64)
    words, rows, before = [], [], []
    for i, body in enumerate(bodies):
        found, begun = _last_tokens(body)
        hashes = [_class(w) for w in found[-ORDERS:]]
        if begun and len(hashes) < ORDERS:
            hashes.insert(0, _START)
        size[i] = len(hashes)
        last[i, ORDERS - len(hashes) :] = hashes
        word = found[-1] if found else ""
        if _lettered(word) and body.endswith(word):
            words.append(word)
            rows.append(i)
            before.append(hashes[-2] if len(hashes) > 1 else _START)
    if words:
        keys, _, ends = _letter_keys(words)
        out[rows, ORDERS : ORDERS + LETTERS - 1] = keys[:, ends].T
        out[rows, -1] = _part_keys(words, np.array(before, np.uint64))[0][ends]
    for k, keys in enumerate(_contexts(last.ravel())):
        out[:, k] = np.where(size > k, keys[ORDERS - 1 :: ORDERS], 0)
    return np.where(out != 0, out - np.uint64(1 << 63), 0).view(np.int64)


def version_of(text: str) -> Column:
    """Name of a text that copies share; blanks around it don't matter."""
    return F.unhex(F.md5(F.trim(F.col(text), F.lit(" \t\r\n")))).alias("version")


def versions(texts: DataFrame, text: str) -> DataFrame:
    """The distinct texts: ``version, text``. Null texts have none."""
    trimmed = F.trim(F.col(text), F.lit(" \t\r\n")).alias("text")
    return texts.where(F.col(text).isNotNull()).select(trimmed).distinct().select(version_of("text"), "text")


def tails(texts: DataFrame) -> DataFrame:
    """``version, state, ends`` (the contexts of their end) and ``dotted`` of texts (``version, text``); only open ones have ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [structure(t) for t in b.column(1).to_pylist()]
            state = np.array([s for s, _ in found], np.int32)
            ends = tail_keys([body for s, body in found if s == OPEN])
            offsets = np.concatenate([[0], np.cumsum(state == OPEN) * ends.shape[1]]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ends.ravel()), mask=pa.array(state != OPEN))
            dotted = [s == OPEN and bool(_DOTS.search(t)) for (s, _), t in zip(found, b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(state), lists, pa.array(dotted, pa.bool_())], ["version", "state", "ends", "dotted"])

    return texts.select("version", "text").mapInArrow(run, "version binary, state int, ends array<long>, dotted boolean")


def context_counts(texts: DataFrame, text: str, wanted: bytes | None) -> DataFrame:
    """``context, n, n_end`` over all texts, of the contexts in the bit map; without a map, of all."""
    sent = texts.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _Classes()
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def take(keys: np.ndarray, ends: np.ndarray, times: np.ndarray) -> None:
            keys = keys - np.uint64(1 << 63)  # as the signed form of tail_keys
            keep = in_map(sent.value, keys.view(np.int64))
            held.append((keys[keep], ends[keep], times[keep]))

        def take_letters() -> None:
            lettered = [w for w in classes if _lettered(w)]
            for i in range(0, len(lettered), 50_000):
                words = lettered[i : i + 50_000]
                times = classes.times[[classes[w] for w in words]]
                keys, stops, _ = _letter_keys(words)
                times = times[np.cumsum(stops) - stops]
                for own in keys:
                    take(own[own != 0], stops[own != 0], times[own != 0])
            names = list(classes)
            before, tokens, times = classes.followed()
            for i in range(0, len(tokens), 50_000):
                words = [names[k - 1] for k in tokens[i : i + 50_000]]
                rows = [k for k, w in enumerate(words) if _lettered(w)]
                if rows:
                    keys, stops, of = _part_keys([words[k] for k in rows], before[i : i + 50_000][rows])
                    take(keys, stops, times[i : i + 50_000][rows][of])

        def told() -> pa.RecordBatch:
            keys = np.concatenate([k for k, _, _ in held]) if held else np.empty(0, np.uint64)
            ends = np.concatenate([e for _, e, _ in held]) if held else np.empty(0, bool)
            times = np.concatenate([n for _, _, n in held]) if held else np.empty(0, np.int64)
            held.clear()
            distinct, of = np.unique(keys, return_inverse=True)
            sums = [np.bincount(of, weights=w, minlength=len(distinct)).astype(np.int64) for w in (times, times * ends)]
            return pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), *(pa.array(x) for x in sums)], ["context", "n", "n_end"])

        for b in batches:
            numbers: list[int] = []
            lasts: list[int] = []
            last_hashes: list[int] = []
            last_words: list[str] = []
            for t in b.column(0).to_pylist():
                if found := _TOKEN.findall(body_of(t)):
                    numbers.append(0)
                    numbers.extend([classes[w] for w in found[:-1]])
                    lasts.append(len(numbers))
                    numbers.append(0)
                    last_words.append(found[-1])
                    last_hashes.append(_class(found[-1]))  # a last word may be cut: it tells nothing of words
            if numbers:
                row = np.array(numbers, np.int32)
                classes.add(row)
                row = np.array(classes.hashes, np.uint64)[row]
                row[lasts] = last_hashes
                inside = np.ones(len(row), bool)  # the last word is one of its own, it isn't a part of a longer one
                inside[lasts] = False
                inside[np.concatenate([[0], np.array(lasts[:-1], np.int64) + 1])] = False
                at = np.flatnonzero(inside)
                told_ = np.array(numbers, np.int64)
                classes.follow(told_[at - 1], told_[at])
                ended = [(found_, k) for found_, k in zip(last_words, lasts) if _lettered(found_)]
                if ended:
                    keys, stops, _ = _part_keys([w for w, _ in ended], row[[k - 1 for _, k in ended]])
                    take(keys[stops], stops[stops], np.ones(len(ended), np.int64))
                end = np.zeros(len(row), bool)
                end[lasts] = True
                end[:-1] |= row[1:] == np.uint64(_NEWLINE)
                begins = np.concatenate([[0], np.array(lasts[:-1], np.int64) + 1])
                place = np.arange(len(row)) - np.repeat(begins, np.diff(np.append(begins, len(row))))
                for k, keys in enumerate(_contexts(row)):
                    inside = place >= k
                    if k == 0:
                        inside = inside & (place > 0)
                    take(keys[inside], end[inside], np.ones(inside.sum(), np.int64))
            if len(classes) > 500_000:
                take_letters()
                classes = _Classes()
            if sum(len(k) for k, _, _ in held) > 4_000_000:
                yield told()
        take_letters()
        yield told()

    rows = texts.where(F.col(text).isNotNull()).select(text).mapInArrow(run, "context long, n long, n_end long")
    return rows.groupBy("context").agg(F.sum("n").alias("n"), F.sum("n_end").alias("n_end"))


def _share(found: Column) -> Column:
    """Share of ends in the longest context with enough occurrences; null without any."""
    best = F.array_max(F.filter(found, lambda x: x["n"] >= ENOUGH))
    return best["n_end"] / best["n"]


def judged(texts: DataFrame, ends: DataFrame) -> DataFrame:
    """``version, state``, of open texts ``p_end`` and ``p_word_end``, and ``cut``, of distinct texts (``version, text``) and their tails.

    Texts without a letter or digit are complete. An empty table gives no row.
    """
    asked = ends.where("ends is not null").select("version", "dotted", F.posexplode("ends").alias("place", "context")).where("context <> 0")
    # every text is counted once: copies of a text vouch for its end no more than the text itself
    counts = context_counts(texts, "text", chooser(asked.select("context")))
    of_tokens, of_parts = F.col("place") < ORDERS, F.col("place") == ORDERS + LETTERS - 1
    # the end that is judged doesn't count; behind dots it isn't counted as one
    own = (of_tokens | of_parts).cast("long")
    others = F.col("n") - own, F.col("n_end") - F.when(of_tokens & F.col("dotted"), 0).otherwise(own)
    kind = F.when(of_tokens, "tokens").when(of_parts, "parts").otherwise("letters")
    seen = asked.join(counts, "context").select("version", kind.alias("kind"), F.struct("place", others[0].alias("n"), others[1].alias("n_end")).alias("found"))
    told = seen.groupBy("version").agg(*(F.collect_list(F.when(F.col("kind") == k, F.col("found"))).alias(k) for k in ("tokens", "letters", "parts")))
    told = told.select("version", _share(F.col("tokens")).alias("p_end"), _share(F.col("letters")).alias("p_word_end"), _share(F.col("parts")).alias("p_whole"))
    end, word_end, whole = F.coalesce("p_end", F.lit(0.0)), F.coalesce("p_word_end", F.lit(1.0)), F.coalesce("p_whole", F.lit(1.0))
    cut = (F.col("state") == CUT) | ((F.col("state") == OPEN) & ((end < LEAST_END) | (word_end < LEAST_WORD_END) | (whole < LEAST_END) | ((end < 2 * LEAST_END) & (word_end < 0.15))))
    return ends.select("version", "state").join(told, "version", "left").withColumn("cut", cut)
