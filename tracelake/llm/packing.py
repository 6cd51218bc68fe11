"""Filling containers of fixed capacity with texts, sized in tokens of a public tokenizer.

Bulk-synchronous best-fit. Sizes are whole numbers up to the capacity, so documents and gaps, range-sorted, are runs of
equal values: a run of documents is one entry of the size histogram, a run of gaps a list of container intervals. Each
superstep takes the largest run of unplaced documents and sweeps to its successor, the smallest gap not below it; of more
documents than gaps the rank decides who gets one; the gaps are updated, and the sweep repeats until the run is placed or
no gap fits, when it opens containers. The runs are at most as many as the capacity has values, whatever the number of
documents, so the sweeps cost no shuffle; what grows with the documents, ranking them inside their run and looking up
their container, is distributed. The result is that of best-fit decreasing on single documents.
"""

from __future__ import annotations

import base64
import bisect
import sys
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.session import written

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published splitting pattern of that vocabulary (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BUCKET = 200_000


def _encoding(path: str):
    """The tokenizer, once a worker."""
    held = sys.modules[__name__].__dict__.setdefault("_held", {})
    if path not in held:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        held[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return held[path]


def token_sizes(texts: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``key``, ``version`` (hash of the text) and ``n_tokens`` of every distinct row with a text."""
    key_type = texts.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(vocabulary).encode_ordinary
        for b in batches:
            column = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([xxhash.xxh3_64_intdigest(t) - 2**63 for t in column], pa.int64()), pa.array([len(encode(t)) for t in column], pa.int64())], ["key", "version", "n_tokens"])

    rows = texts.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, text).mapInArrow(run, f"key {key_type}, version long, n_tokens long")
    return rows.groupBy("key", "version").agg(F.first("n_tokens").alias("n_tokens"))


def best_fit(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Steps (size, first rank, first container, documents a container) and the number of containers.

    A document of rank r in its size goes by the last step of its size that begins at or before r,
    to the container ``first + (r - first rank) // documents a container``.
    """
    gaps: dict[int, deque[tuple[int, int]]] = defaultdict(deque)  # free space: intervals of containers
    free: list[int] = []  # values that have a gap, ascending
    steps: list[tuple[int, int, int, int]] = []
    containers = 0

    def put(value: int, first: int, n: int) -> None:
        if value > 0 and n:
            if not gaps[value]:
                bisect.insort(free, value)
            gaps[value].append((first, n))

    for size in sorted((s for s in counts if s > 0), reverse=True):
        rank, left = 0, counts[size]
        while left:
            k = bisect.bisect_left(free, size)
            if k == len(free):  # no gap fits: open containers, as full as the run allows
                per = min(capacity // size, left)
                n = left // per
                steps.append((size, rank, containers, per))
                put(capacity - per * size, containers, n)
                containers += n
                rank, left = rank + n * per, left - n * per
                continue
            value = free[k]
            first, n = gaps[value].popleft()
            take = min(n, left)
            if take < n:
                gaps[value].appendleft((first + take, n - take))
            if not gaps[value]:
                free.pop(k)
            steps.append((size, rank, first, 1))
            put(value - size, first, take)
            rank, left = rank + take, left - take
    if counts.get(0):
        steps.append((0, 0, 0, counts[0]))
        containers = max(containers, 1)
    return steps, containers


def _looked_up(rows: DataFrame, plans: dict[int, list[tuple[int, int, int, int]]]) -> DataFrame:
    """``container_id`` of rows with ``capacity``, ``rest`` and ``rank``.

    A plan has a step for each size and gap that meet, at most some for each token of the capacity, whatever the number of documents.
    """
    spark = rows.sparkSession
    packed = {c: tuple(np.array(x, np.int64).reshape(-1, 4)[np.lexsort((np.array(x)[:, 1], np.array(x)[:, 0]))].T) for c, x in plans.items() if x}
    sent = spark.sparkContext.broadcast(packed)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            capacity, rest, rank = (b.column(names.index(k)).to_numpy(zero_copy_only=False) for k in ("capacity", "rest", "rank"))
            container = np.zeros(len(rank), np.int64)
            for c, (size, begin, first, per) in sent.value.items():
                at = np.flatnonzero(capacity == c)
                edge = np.searchsorted(size, np.arange(c + 2))
                low, high = edge[rest[at]], edge[rest[at] + 1]
                while (open_ := high - low > 1).any():  # bisection, all rows at once
                    mid = (low + high) // 2
                    up = open_ & (begin[np.minimum(mid, len(begin) - 1)] <= rank[at])
                    low, high = np.where(up, mid, low), np.where(open_ & ~up, mid, high)
                container[at] = first[low] + (rank[at] - begin[low]) // per[low]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(container)], [*names, "container_id"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("container_id", T.LongType())]))


def packed(texts: DataFrame, capacities: list[int], key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Pieces of all texts, for each capacity: ``capacity_tokens, container_id, doc_id, piece_no, start_token, n_tokens``.

    A text within the capacity is one piece. A longer one fills containers of its own and its rest is packed like a text.
    A null text has no piece, an empty one is a piece of no tokens in container 0. Rows with a null key are left out,
    repeated rows count once, two texts under one key are both packed. Further columns are ignored whatever their names.
    An empty table, or no capacity, gives an empty result; a capacity below 1 is an error.
    """
    if any(c is None or c < 1 for c in capacities):
        raise ValueError("a capacity must be at least one token")
    spark = texts.sparkSession
    key_type = texts.schema[key].dataType.simpleString()
    capacities = sorted(set(capacities))
    if not capacities:
        return spark.createDataFrame([], f"capacity_tokens int, container_id long, doc_id {key_type}, piece_no long, start_token long, n_tokens long")
    sizes = written(token_sizes(texts, key, text, vocabulary), "token-sizes")
    items = sizes.withColumn("capacity", F.explode(F.array(*map(F.lit, capacities)))).withColumn("full", F.expr("n_tokens div capacity")).withColumn("rest", F.expr("n_tokens % capacity"))
    buckets = max(1, -(-sizes.count() // _BUCKET))
    items = items.withColumn("bucket", F.pmod(F.xxhash64("key", "version"), F.lit(buckets)).cast("int"))
    rests = items.where("rest > 0 or full = 0")

    histogram = defaultdict(dict)  # at most capacity + 1 entries of each capacity
    for c, s, n in rests.groupBy("capacity", "rest").count().toLocalIterator():
        histogram[c][s] = n
    plans, shared = {}, {}
    for c in capacities:
        plans[c], shared[c] = best_fit(histogram[c], c)

    # rank inside a run: offset of the bucket, then the place in the bucket
    before = Window.partitionBy("capacity", "rest").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rests.groupBy("capacity", "rest", "bucket").count().withColumn("offset", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    place = Window.partitionBy("capacity", "rest", "bucket").orderBy("key", "version")
    ranked = rests.withColumn("place", F.row_number().over(place) - 1).join(offsets, ["capacity", "rest", "bucket"]).withColumn("rank", (F.col("offset") + F.col("place")).cast("long"))
    small = _looked_up(ranked.select("capacity", "rest", "rank", "key", "full"), {c: p for c, p in plans.items() if p})
    small = small.select(F.col("capacity").alias("capacity_tokens"), "container_id", F.col("key").alias("doc_id"), F.col("full").alias("piece_no"), (F.col("full") * F.col("capacity")).alias("start_token"), F.col("rest").alias("n_tokens"))

    full = items.where("full > 0")
    before = Window.partitionBy("capacity").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = full.groupBy("capacity", "bucket").agg(F.sum("full").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    place = Window.partitionBy("capacity", "bucket").orderBy("key", "version").rowsBetween(Window.unboundedPreceding, -1)
    first = F.element_at(F.create_map(*(F.lit(x) for c in capacities for x in (c, shared[c]))), F.col("capacity"))
    full = full.withColumn("place", F.coalesce(F.sum("full").over(place), F.lit(0))).join(offsets, ["capacity", "bucket"]).withColumn("first", first + F.col("offset") + F.col("place"))
    full = full.select("capacity", "first", "key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1)).alias("piece_no"))
    full = full.select(F.col("capacity").alias("capacity_tokens"), (F.col("first") + F.col("piece_no")).cast("long").alias("container_id"), F.col("key").alias("doc_id"), "piece_no", (F.col("piece_no") * F.col("capacity")).alias("start_token"), F.col("capacity").cast("long").alias("n_tokens"))
    return small.unionByName(full)


def _limits(spark: SparkSession, folder: str) -> list[int]:
    return [r[0] for r in spark.read.parquet(f"{folder}/pack_limits.parquet").select("capacity_tokens").distinct().collect()]


def p5_packed(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces and their containers, for each capacity of ``pack_limits``."""
    return packed(spark.read.parquet(f"{folder}/documents.parquet"), _limits(spark, folder))


def p5_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Containers, tokens, unused share and the least possible number of containers, for each capacity."""
    pieces = p5_packed(spark, folder)
    of = pieces.groupBy("capacity_tokens", "container_id").agg(F.sum("n_tokens").alias("used"))
    told = of.groupBy("capacity_tokens").agg(F.count("*").alias("n_containers"), F.sum("used").alias("n_tokens"), F.max("used").alias("most_used"))
    return told.withColumn("unused_share", F.round(1 - F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")), 6)).withColumn("least_containers", F.ceil(F.col("n_tokens") / F.col("capacity_tokens")))
