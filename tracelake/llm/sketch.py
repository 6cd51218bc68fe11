"""Counters over hashed cells: partial sketches of partitions, merged in a tree, read as bit marks.

A sketch has ``rows`` rows of ``2 ** bits`` counters that stop at 2. A partition sends only the cells it has, cut into chunks
of CHUNK cells, so what it sends follows its rows and not the width; merged chunks become dense when they fill up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK, FAN, FLUSH = 1 << 16, 32, 4_000_000
#: A map of keys has at least CELLS bits a key; one of more than ``2 ** MAX_BITS`` bits (32 MB) isn't sent.
CELLS, MAX_BITS = 16, 28
SCHEMA = "part long, cells binary"
_ARROW = pa.schema([("part", pa.int64()), ("cells", pa.binary())])


def _packed(place: np.ndarray, count: np.ndarray) -> bytes:
    """A chunk by its non-zero places, or all counters where that is shorter."""
    if 3 * len(place) < CHUNK // 4:
        return b"s" + place.astype(np.uint16).tobytes() + count.astype(np.uint8).tobytes()
    dense = np.zeros(CHUNK, np.uint8)
    dense[place] = count
    return b"d" + (dense[0::4] | dense[1::4] << 2 | dense[2::4] << 4 | dense[3::4] << 6).tobytes()


def _dense(cells: bytes) -> np.ndarray:
    out = np.zeros(CHUNK, np.uint8)
    if cells[:1] == b"s":
        n = (len(cells) - 1) // 3
        out[np.frombuffer(cells, np.uint16, n, 1)] = np.frombuffer(cells, np.uint8, n, 1 + 2 * n)
    else:
        four = np.frombuffer(cells, np.uint8, offset=1)
        for k in range(4):
            out[k::4] = four >> (2 * k) & 3
    return out


class Partial:
    """Collects the cells of one partition; ``row`` tells the rows of the sketch apart."""

    def __init__(self, bits: int):
        self.per_row = max(1, (1 << bits) // CHUNK)
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, row: int, cells: np.ndarray) -> None:
        """Count each cell once for each time it is given."""
        self.held.append(cells.astype(np.int64) + row * self.per_row * CHUNK)
        self.size += len(cells)

    def batches(self, last: bool = True) -> Iterator[pa.RecordBatch]:
        """What is held, if it is much or the last."""
        if not self.size or not (last or self.size > FLUSH):
            return
        cell, n = np.unique(np.concatenate(self.held), return_counts=True)
        self.held, self.size = [], 0
        part, place, n = cell // CHUNK, cell % CHUNK, np.minimum(n, 2)
        cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        stop = np.append(cut[1:], len(part))
        for k in range(0, len(cut), 4096):
            edges = list(zip(cut[k : k + 4096].tolist(), stop[k : k + 4096].tolist()))
            yield pa.RecordBatch.from_arrays([pa.array(part[cut[k : k + 4096]]), pa.array([_packed(place[a:b], n[a:b]) for a, b in edges], pa.binary())], schema=_ARROW)


def _add(key: tuple, table: pa.Table) -> pa.Table:
    total = np.zeros(CHUNK, np.uint8)
    for x in table.column("cells"):
        total = np.minimum(total + _dense(x.as_py()), 2)
    place = np.flatnonzero(total)
    return pa.table({"part": [key[0].as_py()], "cells": [_packed(place, total[place])]}, schema=_ARROW)


def marks(partials: DataFrame, partitions: int, rows: int, bits: int, least: int) -> list[bytes]:
    """For each row of the merged sketch a bit for every counter that reached ``least``: of fixed size, for the driver."""
    fan = partitions
    while fan > FAN:  # a tree: a task sees about FAN chunks of one place; the way is by content, so that a task run again agrees
        fan = -(-fan // FAN)
        partials = partials.withColumn("way", F.pmod(F.xxhash64("cells"), F.lit(fan))).groupBy("part", "way").applyInArrow(_add, SCHEMA)
    merged = partials.groupBy("part").applyInArrow(_add, SCHEMA)

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([np.packbits(_dense(x) >= least).tobytes() for x in b.column(1).to_pylist()], pa.binary())], schema=_ARROW)

    per_row = max(1, (1 << bits) // CHUNK)
    found = [np.zeros(per_row * CHUNK // 8, np.uint8) for _ in range(rows)]
    for part, cells in merged.mapInArrow(reached, SCHEMA).toLocalIterator():
        row, place = divmod(part, per_row)
        found[row][place * CHUNK // 8 : (place + 1) * CHUNK // 8] = np.frombuffer(cells, np.uint8)
    return [x.tobytes() for x in found]


def marked(bits: bytes, cells: np.ndarray) -> np.ndarray:
    """Which cells have their bit."""
    packed = np.frombuffer(bits, np.uint8)
    return (packed[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8) & 1).astype(bool)


def chooser(keys: DataFrame, most: int = MAX_BITS) -> bytes | None:
    """Map of the long keys in the first column, as wide as their number asks for; a chance hit lets few keys too many through.

    None if it would be too large to send: then nothing is filtered where rows are made, and a join has to choose.
    """
    name = keys.columns[0]
    n = keys.agg(F.approx_count_distinct(name, 0.02)).first()[0]
    bits = max(16, (max(1, n) * CELLS - 1).bit_length())
    if bits > most:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partial = Partial(bits)
        for b in batches:
            partial.add(0, _cells(b.column(0).to_numpy(zero_copy_only=False), bits))
            yield from partial.batches(False)
        yield from partial.batches()

    # tasks are about as many as partitions of a shuffle, or one for a million keys
    tasks = max(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), n >> 20)
    return marks(keys.mapInArrow(run, SCHEMA), tasks, 1, bits, 1)[0]


def _cells(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys.astype(np.int64).view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def in_map(bits: bytes | None, keys: np.ndarray) -> np.ndarray:
    """Which keys the map has; without a map, all."""
    return np.ones(len(keys), bool) if bits is None else marked(bits, _cells(keys, len(bits).bit_length() + 2))
