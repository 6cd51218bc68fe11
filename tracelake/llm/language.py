"""Language of a text by naive Bayes on character n-grams.

The model counts all labelled rows; n-grams of one to three characters go to ``BUCKETS`` counters. Against the smoothing the
counts of a language weigh as much as ``LABELLED`` rows at most, so that one with many rows has no other law of rare n-grams. Names, numbers, code, markup and quotations are taken out before fitting and judging.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELLED, BUCKETS, GRAMS, LEAST = 4000, 1 << 15, 3, 20
#: Three-letter codes of languages with a two-letter one (fixed values); other labels stay as they are.
CODES = {"eng": "en", "deu": "de", "ger": "de", "fra": "fr", "fre": "fr", "spa": "es", "zho": "zh", "chi": "zh", "cmn": "zh", "ita": "it", "por": "pt", "nld": "nl", "dut": "nl", "rus": "ru", "jpn": "ja", "kor": "ko"}

_CODE = re.compile(r"(?s)```.*?(?:```|\Z)|`[^`\n]*`|<!--.*?-->|<(script|style)\b.*?(?:</\1\s*>|\Z)|<[/!a-zA-Z][^<>]*>|\\boxed\{[^{}]*\}?|\$[^$\n]+\$")
_QUOTED = re.compile(r"\"[^\"]*(?:\"|\Z)|“[^”]*(?:”|\Z)|„[^“”]*(?:[“”]|\Z)|«[^»]*(?:»|\Z)|「[^」]*(?:」|\Z)|『[^』]*(?:』|\Z)|‘[^’]*’|(?<!\w)'[^'\n]+'(?!\w)")
_PATHS = re.compile(r"(?<!\w)(?:(?<!\S)[^\s/\\@]*+[/\\@]\S*|\w[^\W_]*+_\w+|https?:\S+)")
_NAMES = re.compile(r"(?=[A-ZÀ-Þ])(?<![.!?。！？:\n>*\-#(] )(?<!^)(?<![\n\"“「(])\b[A-ZÀ-Þ][^\W\d_一-鿿]*")
_PIECES = re.compile(r"(?=\s)(?:(?<=[.!?。！？;；:])\s+|\n+)")
#: Two words in small letters, or a character that is a word.
_SPOKEN = re.compile(r"(?<!\w)[^\W\d_A-Z一-鿿]\w*+(?s:.)*?(?<!\w)[^\W\d_A-Z一-鿿]|[一-鿿]")
_OTHER = re.compile(r"[\W\d_]+")


def prose(text: str, quotes: bool = True) -> str:
    """What of a text counts for its language, in lower case, words apart by one blank."""
    text = _PATHS.sub(" ", _CODE.sub(" ", text))
    if quotes:
        text = _QUOTED.sub(" ", text)
    # a piece that is only names and values isn't prose
    pieces = [x for x in _PIECES.split(text) if _SPOKEN.search(x)]
    return _OTHER.sub(" ", _NAMES.sub(" ", "\n".join(pieces)).lower()).strip()


def _grams(text: str) -> np.ndarray:
    codes = np.frombuffer(f" {text} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    out, total = [], np.zeros(len(codes), np.uint64)
    for k in range(GRAMS):
        total = (total[: len(codes) - k] * np.uint64(0x100000001B3)) ^ codes[k:] if k else codes.copy()
        mixed = (total + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
        out.append((mixed >> np.uint64(49)).astype(np.int64))
    return np.concatenate(out)


def _counted(texts: list[str]) -> np.ndarray:
    """How often each bucket occurs in the :func:`_grams` of all texts."""
    codes = np.frombuffer("\0".join(f" {t} " for t in texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    inside, total, out = codes != 0, codes, np.zeros(BUCKETS, np.int64)
    for k in range(GRAMS):
        if k:
            total = (total[:-1] * np.uint64(0x100000001B3)) ^ codes[k:]
            inside = inside[:-1] & (codes[k:] != 0)
        out += np.bincount((((total + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int64)[inside], minlength=BUCKETS)
    return out


#: Counters of partitions, in parts of PART, so that a task that adds them up holds few of each.
PART, COUNTERS = 1 << 12, "name string, part int, counts binary"
_COUNTERS = pa.schema([("name", pa.string()), ("part", pa.int32()), ("counts", pa.binary())])


def counters(named: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Arrays of counts by name, in rows for :func:`summed`; their length is a multiple of PART or below it."""
    rows = [(n, k, x[k * PART : (k + 1) * PART].astype(np.int64).tobytes()) for n, x in named.items() for k in range(-(-len(x) // PART))]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_COUNTERS)], schema=_COUNTERS)


def summed(partials: DataFrame) -> dict[str, np.ndarray]:
    """The sums of the arrays of all partitions, of fixed size, for the driver."""

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x.as_buffer(), np.int64) for x in table.column("counts")], axis=0)
        return pa.Table.from_pylist([{"name": key[0].as_py(), "part": key[1].as_py(), "counts": total.tobytes()}], _COUNTERS)

    found: dict[str, dict[int, np.ndarray]] = {}
    for r in partials.groupBy("name", "part").applyInArrow(add, COUNTERS).collect():
        found.setdefault(r["name"], {})[r["part"]] = np.frombuffer(r["counts"], np.int64)
    return {n: np.concatenate([parts[k] for k in sorted(parts)]) for n, parts in found.items()}


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # by bucket, then language

    def scores(self, text: str) -> np.ndarray:
        """Log likelihood of the prose in each language."""
        return self.logs[_grams(text)].sum(axis=0)

    def posterior(self, text: str, expected: str | None = None, prior: float = 0.9) -> np.ndarray:
        """Probabilities of the languages. With ``expected`` that one has the prior and the others share the rest, else all are alike.

        Each character counts in GRAMS n-grams, so the likelihood is taken to the power 1 / GRAMS.
        """
        logs = self.scores(text) / GRAMS
        if expected is not None and len(self.languages) > 1:
            logs = logs + np.log([prior if x == expected else (1 - prior) / (len(self.languages) - 1) for x in self.languages])
        odds = np.exp(logs - logs.max())
        return odds / odds.sum()


def fitted(rows: DataFrame, text: str = "text", lang: str = "lang", labelled: int = LABELLED) -> Model:
    """Model from all rows with a language label; ``labelled`` bounds what the counts of a language weigh, in rows.

    Of a label only the language counts (``zh-CN``, ``deu``, in any case). A language of less than LEAST rows is left out.
    Without labels the model is empty.
    """
    code = F.regexp_extract(F.lower(F.col(lang)), r"^\s*([a-z]{2,3})(?:[-_][a-z0-9_-]+)?\s*$", 1)
    known = F.create_map(*(F.lit(x) for kv in CODES.items() for x in kv))
    named = rows.where(F.col(text).isNotNull()).select(F.coalesce(known[code], code).alias("lang"), F.col(text).alias("text")).where("lang not in ('', 'und', 'mul', 'mis', 'zxx')")
    counts = {r["lang"]: r["count"] for r in named.groupBy("lang").count().where(F.col("count") >= LEAST).collect()}
    wanted = {k: min(1.0, labelled / n) for k, n in counts.items()}
    if not wanted:
        return Model([], np.zeros((BUCKETS, 0)))
    chosen = named.where(F.col("lang").isin(list(wanted)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            texts: dict[str, list[str]] = {}
            for l, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                texts.setdefault(l, []).append(prose(t, False))
            for l, own in texts.items():
                sums[l] = sums.get(l, 0) + _counted(own)
        yield counters(sums)

    found = summed(chosen.mapInArrow(run, COUNTERS))
    languages = sorted(found)
    matrix = np.stack([found[x] * wanted[x] for x in languages], axis=1) + 0.5
    return Model(languages, np.log(matrix / matrix.sum(axis=0)))
