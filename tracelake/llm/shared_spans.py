"""Long exact spans shared between records.

A span of at least ``MIN_CHARS`` characters is at least as many bytes, so windows are taken on the UTF-8 bytes of
the Arrow buffers: of every ``SPREAD`` neighbouring ``CORE``-byte windows the one with the smallest hash is chosen
(``CORE + SPREAD - 1 = MIN_CHARS``), hence two texts that share a span choose a common window inside it.

Pass 1 adds the chosen windows of each partition to a count-min sketch, as wide as the bytes of the texts ask for; the
partition sketches are merged in a tree. The merged counters only overestimate, so pass 2 loses nothing when it re-scans the
texts and keeps only windows whose counters all reach two. Those are grouped exactly and verified on the bytes around them.
A sketch of more than ``2 ** MAX_BITS`` cells a row isn't sent: then its cells are the window hashes themselves and stay a
distributed table, counted by an aggregate, and the windows meet those that are repeated by a join on the hash.

Copies of a whole text are one entity and are expanded only in the result. A window that more than ``FAN`` different
surroundings share isn't compared pairwise: each row is replaced by the hashes of all its ``MIN_CHARS``-character windows
around the core, rolled over the characters, and rows that agree in one of them are cases by definition, so the work follows
the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm.sketch import SCHEMA, Partial, marked, marks
from tracelake.session import written

MIN_CHARS, CORE = 300, 100
SPREAD = MIN_CHARS - CORE + 1
FAN = 64
#: Rows that are compared in one call, about.
LOT = 4096
CELLS_PER_WINDOW, MAX_BITS = 8, 28
_SEGMENT = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 21) - 1)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random odd value of each byte; powers of the base and of its inverse, for one segment."""
    if not hasattr(_tables, "made"):
        n = 2 * _SEGMENT + MIN_CHARS
        values = np.random.default_rng(20260105).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        power = np.cumprod(np.full(n, _BASE, np.uint64))
        inverse = np.cumprod(np.full(n, pow(_BASE, -1, 2**64), np.uint64))
        _tables.made = values, power, inverse
    return _tables.made


def _chosen(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the chosen windows in ``data``, which holds several texts that end at ``ends``."""
    n = len(data)
    if n < MIN_CHARS:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    values, power, inverse = _tables()
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(values[data] * power[:n], out=total[1:])
    h = total[CORE:] - total[:-CORE]
    h *= inverse[: n - CORE + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    m = len(h)
    padded = np.full(-(-m // SPREAD) * SPREAD, np.uint64(2**64 - 1))
    padded[:m] = (h & ~_PLACE) | np.arange(m, dtype=np.uint64)
    rows = padded.reshape(-1, SPREAD)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: m - SPREAD + 1], ahead[SPREAD - 1 : m])
    starts = np.concatenate([[0], ends[:-1]])
    fits = np.zeros(len(least) + 1, np.int8)
    long = ends - starts >= MIN_CHARS
    fits[starts[long]] += 1
    np.subtract.at(fits, ends[long] - MIN_CHARS + 1, 1)
    at = (least[np.cumsum(fits[:-1], dtype=np.int8) > 0] & _PLACE).astype(np.int64)
    at = at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at
    return at, h[at]


def _windows(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For stretches of the Arrow buffer: its start, the first text in it, the texts' ends, places and hashes."""
    offsets = np.frombuffer(column.buffers()[1], np.int32 if pa.types.is_string(column.type) else np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    if buffer is None or not len(column):
        return
    data, i = np.frombuffer(buffer, np.uint8), 0
    while i < len(column):
        j = max(int(np.searchsorted(offsets, offsets[i] + _SEGMENT, "right")) - 1, i + 1)
        a, b = int(offsets[i]), int(offsets[j])
        if b - a <= 2 * _SEGMENT:
            yield a, i, offsets[i + 1 : j + 1].astype(np.int64) - a, *_chosen(data[a:b], offsets[i + 1 : j + 1].astype(np.int64) - a)
        else:  # one very long text: overlapping stretches hold every window of windows
            for s in range(a, b - MIN_CHARS + 1, _SEGMENT):
                e = min(b, s + _SEGMENT + MIN_CHARS - 1)
                yield s, i, np.array([e - s]), *_chosen(data[s:e], np.array([e - s]))
        i = j


def _rows_of(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the two rows; chosen windows have small hashes, so the second row takes bits that are mixed again."""
    mixed = (h ^ (h >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return (h & np.uint64((1 << bits) - 1)).astype(np.int64), (mixed >> np.uint64(64 - bits)).astype(np.int64)


def repeated_cells(texts: DataFrame, text: str, most: int = 0) -> tuple[int, list[bytes]] | None:
    """Width of the merged sketch and, of each of its two rows, a bit for every counter that reached two.

    The width has CELLS_PER_WINDOW cells for each window that the texts' bytes let expect; None if that is more than
    ``2 ** most`` (MAX_BITS), which is too much to send.
    """
    size = texts.agg(F.sum(F.octet_length(text))).first()[0] or 0
    bits = max(16, int(np.ceil(np.log2(max(1.0, size * 2 / SPREAD * CELLS_PER_WINDOW)))))
    if bits > (most or MAX_BITS):
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partial = Partial(bits)
        for batch in batches:
            for _, _, ends, at, h in _windows(batch.column(0)):
                owner = np.searchsorted(ends, at, "right")
                once = np.unique(np.stack([h, owner.astype(np.uint64)]), axis=1)[0] if len(h) else h
                for row, cells in enumerate(_rows_of(once, bits)):
                    partial.add(row, cells)
            yield from partial.batches(False)
        yield from partial.batches()

    # a task reads about 16 MB of text at least
    return bits, marks(texts.select(text).mapInArrow(run, SCHEMA), max(1, size >> 24), 2, bits, 2)


def _repeated_windows(texts: DataFrame, text: str) -> DataFrame:
    """``entity, places``: of each text the windows (``at, hash``) that stand in another row as well, without a sketch to send."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            offsets = _text_offsets(column)
            for base, row, ends, at, h in _windows(column):
                owner = np.searchsorted(ends, at, "right") + row
                _, once = np.unique(np.stack([h, owner.astype(np.uint64)]), axis=1, return_index=True) if len(h) else (h, np.empty(0, np.int64))
                first = np.zeros(len(h), bool)
                first[once] = True  # a text counts once for each of its windows
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column(1).take(pa.array(owner)), pa.array(at + base - offsets[owner]), pa.array(first.astype(np.int32))], ["hash", "entity", "at", "first"])

    slim = written(texts.select(text, entity_of(text)).mapInArrow(run, "hash long, entity binary, at long, first int"), "all-windows")
    repeated = slim.groupBy("hash").agg(F.sum("first").alias("n")).where("n > 1").select("hash")
    # the places of a text are bounded by its length
    return slim.join(repeated, "hash", "left_semi").groupBy("entity").agg(F.collect_set(F.struct("at", "hash")).alias("places"))


def entity_of(text: str) -> Column:
    """Name of a whole text."""
    return F.unhex(F.md5(text)).alias("entity")


def _char_start(data: np.ndarray) -> np.ndarray:
    return (data & 0xC0) != 0x80


def _text_offsets(column: pa.Array) -> np.ndarray:
    wide = not pa.types.is_string(column.type)
    return np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def candidates(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Windows that may stand in more than one text: hash, key, entity (hash of the whole text), place and surroundings.

    ``at`` is the byte place of the core in its text, ``char_at`` the number of characters that begin before it;
    ``around`` are the bytes near the core, ``before`` of them ahead of it.
    """
    spark = texts.sparkSession
    sketch = repeated_cells(texts, text)
    rows = texts.select(key, text, entity_of(text)) if sketch else texts.select(key, text, entity_of(text)).join(_repeated_windows(texts, text), "entity").select(key, text, "entity", "places")
    sent = spark.sparkContext.broadcast(sketch)
    key_type = texts.schema[key].dataType.simpleString()

    def chosen(batch: pa.RecordBatch, offsets: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Row, byte place in the buffer and hash of each window."""
        if sent.value is None:
            for r, places in enumerate(batch.column(3).to_pylist()):
                yield from ((r, int(offsets[r]) + p["at"], p["hash"]) for p in places)
            return
        bits, repeated = sent.value
        for base, row, ends, at, h in _windows(batch.column(1)):
            a, b = _rows_of(h, bits)
            hit = marked(repeated[0], a) & marked(repeated[1], b)
            yield from zip((np.searchsorted(ends, at[hit], "right") + row).tolist(), (at[hit] + base).tolist(), h[hit].view(np.int64).tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.empty(0, np.uint8)
            offsets = _text_offsets(column)
            out: dict[str, list] = {k: [] for k in ("hash", "row", "at", "char_at", "before", "around")}
            starts: dict[int, np.ndarray | None] = {}
            for r, p, x in chosen(batch, offsets):
                lo, hi = int(offsets[r]), int(offsets[r + 1])
                if r not in starts:
                    whole = data[lo:hi]
                    starts[r] = None if whole.max() < 128 else np.cumsum(_char_start(whole))
                reach = MIN_CHARS - CORE if starts[r] is None else 4 * MIN_CHARS - CORE
                s = max(lo, p - reach)
                out["hash"].append(x)
                out["row"].append(r)
                out["at"].append(p - lo)
                out["char_at"].append(p - lo if starts[r] is None else int(starts[r][p - lo - 1]) if p > lo else 0)
                out["before"].append(p - s)
                out["around"].append(data[s : min(hi, p + CORE + reach)].tobytes())
            row = pa.array(out["row"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["hash"], pa.int64()), batch.column(0).take(row), batch.column(2).take(row), pa.array(out["at"], pa.int64()), pa.array(out["char_at"], pa.int64()), pa.array(out["before"], pa.int32()), pa.array(out["around"], pa.binary())],
                ["hash", "key", "entity", "at", "char_at", "before", "around"],
            )

    return rows.mapInArrow(run, f"hash long, key {key_type}, entity binary, at long, char_at long, before int, around binary")


def _whole_chars(data: np.ndarray) -> tuple[int, int, int]:
    """Bytes to leave out ahead and behind so that only whole characters stay, and their number."""
    starts = np.flatnonzero(_char_start(data))
    if not len(starts):
        return len(data), 0, 0
    last, lead = int(starts[-1]), int(data[starts[-1]])
    need = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
    return (int(starts[0]), 0, len(starts)) if last + need <= len(data) else (int(starts[0]), len(data) - last, len(starts) - 1)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = a[:n] != b[:n]
    return int(differ.argmax()) if differ.any() else n


_SPAN = "entity_a binary, entity_b binary, start_a long, start_b long, chars long"


def _compare(table: pa.Table) -> pa.Table:
    """Compare the rows of each window pairwise (at most FAN of them)."""
    held: list[tuple] = []
    out: list[tuple] = []

    def settle() -> None:
        for i, (_, ea, ca, ba, xa) in enumerate(held):
            for _, eb, cb, bb, xb in held[:i]:
                if ea == eb or not np.array_equal(xa[ba : ba + CORE], xb[bb : bb + CORE]):
                    continue
                left = _common(xa[:ba][::-1], xb[:bb][::-1])
                right = _common(xa[ba + CORE :], xb[bb + CORE :])
                cut, _, n = _whole_chars(xa[ba - left : ba + CORE + right])
                if n >= MIN_CHARS:
                    back = left - cut
                    sa = ca - int(_char_start(xa[ba - back : ba]).sum())
                    sb = cb - int(_char_start(xb[bb - back : bb]).sum())
                    out.append((ea, eb, sa, sb, n) if ea < eb else (eb, ea, sb, sa, n))

    table = table.sort_by("hash")
    for h, e, c, b, x in zip(*(table.column(k).to_pylist() for k in ("hash", "entity", "char_at", "before", "around"))):
        if held and held[0][0] != h:
            settle()
            held.clear()
        held.append((h, e, c, b, np.frombuffer(x, np.uint8)))
    settle()
    cols = list(zip(*out)) or [[]] * 5
    return pa.table([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.binary()), *(pa.array(c, pa.int64()) for c in cols[2:])], ["entity_a", "entity_b", "start_a", "start_b", "chars"])


def _all_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each row all windows of MIN_CHARS characters around its core: hash, place and the character before (-1: no window before).

    The characters of a batch's rows are one array; two polynomials over mixed characters roll over it.
    """
    for batch in batches:
        bodies, first = [], []
        for c, b, x in zip(*(batch.column(k).to_pylist() for k in ("char_at", "before", "around"))):
            data = np.frombuffer(x, np.uint8)
            skip, tail, _ = _whole_chars(data)
            bodies.append(x[skip : len(x) - tail].decode())
            first.append(c - int(_char_start(data[skip:b]).sum()))
        codes = np.frombuffer("".join(bodies).encode("utf-32-le"), np.uint32).astype(np.uint64)
        length = np.array([len(x) for x in bodies], np.int64)
        begin = np.cumsum(length) - length
        n = np.maximum(length - MIN_CHARS + 1, 0)
        row = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        at = begin[row] + place
        hashes = []
        for base, salt in ((_BASE, 0x2545F4914F6CDD1D), (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)):
            mixed = (codes + np.uint64(3)) * np.uint64(salt)
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
            power = np.cumprod(np.full(len(codes) + 1, base, np.uint64))
            inverse = np.cumprod(np.full(len(codes) + 1, pow(base, -1, 1 << 64), np.uint64))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((mixed ^ (mixed >> np.uint64(29))) * power[: len(codes)])])
            hashes.append((sums[at + MIN_CHARS] - sums[at]) * inverse[at])
        window = pa.Array.from_buffers(pa.binary(16), len(at), [None, pa.py_buffer(np.ascontiguousarray(np.stack(hashes, axis=1)))]).cast(pa.binary())
        prior = np.where(place > 0, codes[np.maximum(at - 1, 0)].astype(np.int64), -1) if len(at) else at
        yield pa.RecordBatch.from_arrays([window, batch.column("entity").take(pa.array(row)), pa.array(np.array(first, np.int64)[row] + place if len(row) else row), pa.array(prior.astype(np.int32))], ["window", "entity", "start", "prior"])


def all_pairs(members: DataFrame, group: list[str], key: str, block: int = 512) -> DataFrame:
    """Pairs (``a`` < ``b``) of the distinct keys of each group, for results that are defined as pairs.

    A group of n keys is cut into n / block parts, so that no task holds more than block * n of its pairs. A column
    ``prior`` leaves out pairs that agree in it, unless it is null.
    """
    prior = [F.col("prior").alias("prior_a")] if "prior" in members.columns else []
    sized = members.join(members.groupBy(*group).agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("_parts")), group)
    left = sized.select(*group, F.col(key).alias("a"), F.pmod(F.xxhash64(key), F.col("_parts")).cast("int").alias("_part"), *prior)
    right = sized.select(*group, F.col(key).alias("b"), F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"), *(x.alias("prior_b") for x in [F.col("prior")] if prior))
    # the key's hash names its part, so a pair meets exactly once
    return left.join(right, [*group, "_part"]).where(F.col("a") < F.col("b")).where("not (prior_a <=> prior_b) or prior_a is null" if prior else "true").select(*group, "a", "b")


@dataclass
class SharedSpans:
    """``pieces``: spans found pairwise (``entity_a`` < ``entity_b``, character places, length around one window);
    ``windows``: of windows with too many rows to compare, each place of every MIN_CHARS-character window that several entities share;
    ``members``: the keys of each entity, an entity being all records with the same text."""

    pieces: DataFrame
    windows: DataFrame
    members: DataFrame

    def links(self) -> DataFrame:
        """Distinct pairs of entities; of a run of shared windows only its first makes pairs."""
        # where a pair agrees in all characters before a window, it shares the windows one place ahead as well; at the leftmost that it shares it can't agree
        own = F.array_sort(F.collect_set("prior"))
        held = self.windows.groupBy("window", "entity").agg(F.when(F.min("prior") >= 0, F.array_join(own.cast("array<string>"), " ")).alias("prior"))
        first = held.groupBy("window").agg(F.min("prior").alias("low"), F.max("prior").alias("high"), F.count_if(F.col("prior").isNull()).alias("open")).where("low <> high or open > 0").select("window")
        hot = all_pairs(held.join(first, "window"), ["window"], "entity")
        return self.pieces.select("entity_a", "entity_b").unionByName(hot.select(F.col("a").alias("entity_a"), F.col("b").alias("entity_b"))).distinct()


    def link_counts(self) -> DataFrame:
        """``entity, n_links``: the number of different texts that each shares a span with, without listing the pairs of a hot group.

        The entities of a hot window are a group; windows with the same entities are one. All of its largest group are partners of
        an entity; only its pieces and its smaller groups are expanded, and partners that are in the largest group don't count again.
        """
        mixed = F.xxhash64("entity")
        own = self.windows.select("window", "entity").distinct()
        sized = own.groupBy("window").agg(F.count("*").alias("size"), F.sum(F.pmod(mixed, F.lit(1 << 40))).alias("a"), F.bit_xor(mixed).alias("b"))
        groups = sized.groupBy("size", "a", "b").agg(F.min("window").alias("window")).select("window", "size")
        held = written(own.join(groups, "window"), "span-groups")
        base = held.groupBy("entity").agg(F.max(F.struct("size", "window")).alias("top")).select("entity", F.col("top.window").alias("base"), (F.col("top.size") - 1).alias("n_base"))
        rest = held.join(base, "entity").where("window <> base").select("window", F.col("entity").alias("x"))
        others = rest.join(held.select("window", F.col("entity").alias("y")), "window").where("x <> y").select("x", "y")
        ends = self.pieces.select("entity_a", "entity_b").distinct()
        others = others.unionByName(ends.toDF("x", "y")).unionByName(ends.toDF("y", "x")).distinct()
        inside = held.select(F.col("window").alias("base"), F.col("entity").alias("y"))
        fresh = others.join(base.select(F.col("entity").alias("x"), "base"), "x", "left").join(inside, ["base", "y"], "left_anti")
        more = fresh.groupBy(F.col("x").alias("entity")).agg(F.count("*").alias("n_more"))
        zero = F.lit(0).cast("long")
        return base.select("entity", "n_base").join(more, "entity", "full").select("entity", (F.coalesce("n_base", zero) + F.coalesce("n_more", zero)).alias("n_links"))


def shared_spans(texts: DataFrame, key: str = "doc_id", text: str = "text") -> SharedSpans:
    """Spans of at least MIN_CHARS characters that stand in more than one different text.

    Null, empty and short texts have no window. Rows with a null key are left out, repeated rows change nothing,
    further columns are ignored whatever their names. An empty table gives empty results.
    """
    rows = written(candidates(texts.where(F.col(key).isNotNull() & (F.octet_length(text) >= MIN_CHARS)), key, text), "span-windows")
    members = rows.select("entity", "key").distinct()
    once = rows.groupBy("hash", "entity", "at").agg(F.first("char_at").alias("char_at"), F.first("before").alias("before"), F.first("around").alias("around"))
    fan = once.groupBy("hash").agg(F.count("*").alias("fan"), F.min("entity").alias("least"), F.max("entity").alias("most")).where("least < most").select("hash", "fan")
    once = once.join(fan, "hash").drop("at")
    # groups, as a repartition by the key of a join can be left out, and the join then be split or read in parts
    lot = F.pmod(F.xxhash64("hash"), F.lit(rows.count() // LOT + 1))
    pieces = once.where(F.col("fan") <= FAN).drop("fan").groupBy(lot.alias("lot")).applyInArrow(_compare, _SPAN)
    many = once.where(F.col("fan") > FAN).drop("fan").mapInArrow(_all_windows, "window binary, entity binary, start long, prior int")
    many = many.distinct()
    shared = many.groupBy("window").agg(F.min("entity").alias("least"), F.max("entity").alias("most")).where("least < most").select("window")
    return SharedSpans(pieces, many.join(shared, "window"), members)


def shared_pairs(texts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every pair of keys whose texts share a span: ``doc_a`` < ``doc_b``; copies of a text are pairs as well."""
    found = shared_spans(texts, key, text)
    names = found.members
    across = found.links().join(names.select(F.col("entity").alias("entity_a"), F.col("key").alias("x")), "entity_a").join(names.select(F.col("entity").alias("entity_b"), F.col("key").alias("y")), "entity_b")
    same = all_pairs(names, ["entity"], "key").select(F.col("a").alias("doc_a"), F.col("b").alias("doc_b"))
    return across.where("x <> y").select(F.least("x", "y").alias("doc_a"), F.greatest("x", "y").alias("doc_b")).unionByName(same).distinct()


def _union_length(spans: Column) -> Column:
    """Characters covered by an array of (start, stop)."""
    zero = F.struct(F.lit(0).cast("long").alias("covered"), F.lit(-1).cast("long").alias("stop"))

    def step(acc: Column, x: Column) -> Column:
        return F.struct((acc["covered"] + F.greatest(F.lit(0).cast("long"), x["stop"] - F.greatest(x["start"], acc["stop"]))).alias("covered"), F.greatest(acc["stop"], x["stop"]).alias("stop"))

    return F.aggregate(F.array_sort(spans), zero, step)["covered"]


def shared_shares(texts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each record with a shared span: its class of equal texts, links, shared characters and their share.

    ``n_links`` counts the different texts it shares a span with; a text with copies is shared as a whole.
    """
    found = shared_spans(texts, key, text)
    members = found.members
    ends = found.pieces.select(F.explode(F.array(*(F.struct(F.col(f"entity_{x}").alias("entity"), F.col(f"start_{x}").alias("start"), (F.col(f"start_{x}") + F.col("chars")).alias("stop")) for x in "ab"))).alias("s")).select("s.*")
    ends = ends.unionByName(found.windows.select("entity", "start", (F.col("start") + MIN_CHARS).alias("stop")))
    # a place of a text counts once however many partners share it, so the array is bounded by the text's length
    per = ends.groupBy("entity", "start").agg(F.max("stop").alias("stop")).groupBy("entity").agg(_union_length(F.collect_list(F.struct("start", "stop"))).alias("covered"))
    links = found.link_counts()
    copies = members.groupBy("entity").agg(F.count("*").alias("copies"), F.min("key").alias("class_id"))
    told = members.join(copies, "entity").join(per, "entity", "left").join(links, "entity", "left").where("covered is not null or copies > 1")
    size = texts.select(F.col(key).alias("key"), F.char_length(text).cast("long").alias("n_chars")).where("key is not null").groupBy("key").agg(F.max("n_chars").alias("n_chars"))
    shared = F.when(F.col("copies") > 1, F.col("n_chars")).otherwise(F.col("covered"))
    return told.join(size, "key").select(F.col("key").alias("doc_id"), "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "copies", shared.alias("shared_chars"), F.round(shared / F.col("n_chars"), 6).alias("shared_share"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return shared_pairs(spark.read.parquet(f"{folder}/documents.parquet"))


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    return shared_shares(spark.read.parquet(f"{folder}/documents.parquet"))
