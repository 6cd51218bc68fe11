"""Deeply nested records as flat tables with parent links.

Arrow lists are flattened on their buffers: the child values are the flattened list, the parent of each child comes from
the list's offsets, and keys are handed down by a vectorised take. JSON texts inside the records are brought to the same
form without reading rows one by one: the bytes of all texts of a batch are scanned at once for quotes, brackets and
commas; running sums give strings and depth; sorting brackets by depth pairs them, which gives the list offsets and parent
indexes of every array in every text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE, BACKSLASH, COMMA, COLON = 34, 92, 44, 58
OPEN_OBJECT, CLOSE_OBJECT, OPEN_ARRAY, CLOSE_ARRAY = 123, 125, 91, 93
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 13]] = True
_MARK = np.zeros(256, np.uint8)  # kinds of tokens
_MARK[[OPEN_OBJECT, CLOSE_OBJECT, OPEN_ARRAY, CLOSE_ARRAY, COMMA, COLON]] = [1, 2, 3, 4, 5, 6]
STRING, SCALAR = 7, 8
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdefABCDEF")] = True
_ESCAPES = np.zeros(256, bool)
_ESCAPES[list(b'"\\/bfnrtu')] = True
_MAY_BE_JSON = np.zeros(256, bool)
_MAY_BE_JSON[list(b'[{ \\')] = True


@dataclass
class Tokens:
    """JSON tokens of a batch of texts, in order; only those of readable texts."""

    data: np.ndarray
    kind: np.ndarray  # 1 { 2 } 3 [ 4 ] 5 , 6 : 7 string 8 other value
    at: np.ndarray  # first byte
    end: np.ndarray  # byte after the last
    text: np.ndarray  # index of the text
    parent: np.ndarray  # token of the bracket around it, -1 at the top
    close: np.ndarray  # byte after the bracket that closes it, 0 for other tokens
    readable: np.ndarray  # by text


def _offsets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array without nulls."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def tokens(texts: pa.Array) -> Tokens:
    """Scan all texts at once; a text that isn't JSON as a whole is marked unreadable and gives no tokens."""
    data, offsets = _offsets(texts)
    n = len(texts)
    bad = np.zeros(n + 1, bool)

    def owner(places: np.ndarray) -> np.ndarray:
        return np.searchsorted(offsets, places, "right") - 1

    # a quote is escaped behind an odd run of backslashes
    slashes = np.flatnonzero(data == BACKSLASH)
    if len(slashes):
        begin = np.concatenate([[True], (np.diff(slashes) > 1) | (owner(slashes)[1:] != owner(slashes)[:-1])])
        run = np.cumsum(begin) - 1
        place = np.arange(len(slashes)) - np.flatnonzero(begin)[run]
        escaping = slashes[place % 2 == 0]  # these take the next byte with them
        cut = escaping + 1 == offsets[owner(escaping) + 1]
        bad[owner(escaping[cut])] = True
        escaping = escaping[~cut]
    else:
        escaping = slashes
    quotes = np.flatnonzero(data == QUOTE)
    quotes = quotes[~np.isin(quotes, escaping + 1)] if len(escaping) else quotes
    of = owner(quotes)
    count = np.bincount(of, minlength=n)
    bad[:n] |= count % 2 == 1
    quotes = quotes[~bad[of]]
    opens, closes = quotes[::2], quotes[1::2]
    step = np.zeros(len(data) + 1, np.int8)
    step[opens] += 1
    step[closes + 1] -= 1
    inside = np.cumsum(step[:-1], dtype=np.int8).astype(bool)  # with both quotes

    def spoil(places: np.ndarray) -> None:
        bad[owner(places)] = True

    spoil(np.flatnonzero(inside & (data < 32)))
    if len(escaping):
        spoil(escaping[~inside[escaping]])
        within = escaping[inside[escaping]]
        spoil(within[~_ESCAPES[data[np.minimum(within + 1, len(data) - 1)]]])
        unicode = within[data[np.minimum(within + 1, len(data) - 1)] == 117]
        for k in range(2, 6):
            spoil(unicode[~(_HEX[data[np.minimum(unicode + k, len(data) - 1)]] & inside[np.minimum(unicode + k, len(data) - 1)])])
    mark = np.where(inside, 0, _MARK[data])
    plain = ~inside & (mark == 0) & ~_SPACE[data]
    first = plain.copy()
    first[1:] &= ~plain[:-1]
    starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[starts] = plain[starts]
    last = plain.copy()
    last[:-1] &= ~plain[1:]
    ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[ends] = plain[ends]
    marks, begins, stops = np.flatnonzero(mark), np.flatnonzero(first), np.flatnonzero(last)
    at = np.concatenate([marks, opens, begins])
    kind = np.concatenate([mark[marks], np.full(len(opens), STRING, np.uint8), np.full(len(begins), SCALAR, np.uint8)])
    end = np.concatenate([marks + 1, closes + 1, stops + 1])
    order = np.argsort(at, kind="stable")
    at, kind, end = at[order], kind[order], end[order]
    text = owner(at)

    # scalars: each distinct one is looked at once
    scalars = np.flatnonzero(kind == SCALAR)
    if len(scalars):
        words = pa.array([data[a:b].tobytes() for a, b in zip(at[scalars], end[scalars])], pa.binary()).dictionary_encode()
        sound = np.array([_is_scalar(w) for w in words.dictionary.to_pylist()], bool)
        bad[text[scalars[~sound[words.indices.to_numpy()]]]] = True

    keep = ~bad[text]
    at, kind, end, text = at[keep], kind[keep], end[keep], text[keep]
    # depth: brackets of a text must balance, never below zero, closing what was opened
    change = np.where((kind == 1) | (kind == 3), 1, np.where((kind == 2) | (kind == 4), -1, 0))
    depth = np.cumsum(change)
    first_of = np.searchsorted(text, np.arange(n))
    base = np.concatenate([[0], depth])[np.minimum(first_of, len(depth))]
    depth = depth - base[text]
    low = np.zeros(n, bool)
    low[text[depth < 0]] = True
    last_of = np.searchsorted(text, np.arange(n), "right") - 1
    some = last_of >= first_of
    low[some] |= depth[last_of[some]] != 0
    bad[:n] |= low | ~some
    keep = ~bad[text]
    at, kind, end, text, depth, change = (x[keep] for x in (at, kind, end, text, depth, change))
    level = depth + (change < 0)  # both brackets of a pair have one level
    brackets = np.flatnonzero(change)
    order = brackets[np.lexsort((brackets, level[brackets]))]
    lefts, rights = order[::2], order[1::2]
    wrong = kind[rights] != kind[lefts] + 1
    bad[text[lefts[wrong]]] = True
    # the parent of a token is the last bracket opened one level up
    parent = np.full(len(kind), -1, np.int64)
    inner = np.where(change != 0, level - 1, depth)  # level of the bracket around it
    stride = len(kind) + 1
    around = np.flatnonzero(inner > 0)
    key = np.sort(level[lefts] * stride + lefts)
    if len(around):
        parent[around] = key[np.searchsorted(key, inner[around] * stride + around) - 1] % stride
    close = np.zeros(len(kind), np.int64)
    close[lefts] = end[rights]
    _grammar(kind, text, parent, bad)
    keep = ~bad[text]
    renumber = np.cumsum(keep) - 1
    parent = np.where(parent >= 0, renumber[parent], -1)[keep]
    return Tokens(data, kind[keep], at[keep], end[keep], text[keep], parent, close[keep], ~bad[:n])


def _is_scalar(word: bytes) -> bool:
    if word in (b"true", b"false", b"null"):
        return True
    try:
        return isinstance(json.loads(word), (int, float)) and word[:1] in b"-0123456789" and word != b"-Infinity"
    except ValueError:
        return False


def _grammar(kind: np.ndarray, text: np.ndarray, parent: np.ndarray, bad: np.ndarray) -> None:
    """Marks texts whose tokens don't follow one another as JSON does."""
    if not len(kind):
        return
    edge = text[1:] != text[:-1]
    before = np.concatenate([[0], np.where(edge, 0, kind[:-1])])  # 0: begin of the text
    in_object = np.where(parent >= 0, kind[np.maximum(parent, 0)] == 1, False)
    top = parent < 0
    value = (kind == 1) | (kind == 3) | (kind >= STRING)
    key_place = in_object & ((before == 1) | (before == 5))
    fine = np.zeros(len(kind), bool)
    fine |= value & top & (before == 0)
    fine |= value & ~top & ~in_object & ((before == 3) | (before == 5))
    fine |= (kind == STRING) & key_place
    fine |= value & in_object & (before == 6)
    after_value = (before == 2) | (before == 4) | (before >= STRING)
    # a colon stands behind a key, a comma or an object's end behind its value
    was_key = np.concatenate([[False], key_place[:-1] & (kind[:-1] == STRING)])
    fine |= (kind == 6) & in_object & was_key
    fine |= (kind == 5) & ~top & after_value & ~(in_object & was_key)
    fine |= (kind == 4) & (after_value | (before == 3))
    fine |= (kind == 2) & ((before == 1) | (after_value & ~was_key))
    bad[text[~fine]] = True


@dataclass
class Level:
    """Values being flattened: index of their root row, their path and the path of the nearest element above (null at the top).

    Of elements that are told ``value`` is the JSON text, if they come from one.
    """

    root: np.ndarray
    path: pa.Array
    above: pa.Array
    value: pa.Array | None = None

    def take(self, rows: np.ndarray) -> Level:
        at = pa.array(rows, pa.int64())
        return Level(self.root[rows], self.path.take(at), self.above.take(at))


def _join(*parts: pa.Array | str) -> pa.Array:
    return pc.binary_join_element_wise(*parts, "")


def _strings(t: Tokens, rows: np.ndarray) -> pa.Array:
    """Values of string tokens: one reading of one array of all of them."""
    if not len(rows):
        return pa.array([], pa.string())
    read = json.loads(b"[" + b",".join([t.data[a:b].tobytes() for a, b in zip(t.at[rows], t.end[rows])]) + b"]")
    try:
        return pa.array(read, pa.string())
    except (UnicodeError, pa.ArrowInvalid):  # half of a surrogate pair
        return pa.array([x.encode("utf-8", "replace").decode() for x in read], pa.string())


#: What an object at the top of a text is: no element, element 0 below the path, or the element that the path names.
NONE, FIRST, SELF = 0, 1, 2


def json_nodes(texts: pa.Array, where: Level, top_is: np.ndarray, values_: bool = False) -> Iterator[Level]:
    """Objects that are array elements in JSON texts (without nulls), with root and path.

    Strings that are JSON themselves are read through under the same path; what isn't readable is a leaf.
    """
    while len(texts):
        t = tokens(texts)
        # brackets, and values that are strings and may be JSON
        inside = np.minimum(t.at + 1, max(0, len(t.data) - 1))
        value = np.ones(len(t.kind), bool)
        value[:-1] = t.kind[1:] != 6
        children = np.flatnonzero((t.kind == 1) | (t.kind == 3) | ((t.kind == STRING) & value & _MAY_BE_JSON[t.data[inside]]))
        arrays = t.parent[children]
        around = t.kind[np.maximum(arrays, 0)]
        in_array, in_object, top = (arrays >= 0) & (around == 3), (arrays >= 0) & (around == 1), arrays < 0
        # the place in an array is the number of commas before it in the same array
        commas = np.flatnonzero(t.kind == 5)
        stride = len(t.kind) + 1
        keyed = np.sort(t.parent[commas] * stride + commas)
        place = np.searchsorted(keyed, arrays * stride + children) - np.searchsorted(keyed, arrays * stride)
        own = np.full(len(children), "", object)
        own[in_array] = _join("[", pa.array(place[in_array]).cast(pa.string()), "]").to_numpy(zero_copy_only=False)
        own[in_object] = _join(".", _strings(t, children[in_object] - 2)).to_numpy(zero_copy_only=False)
        of = t.text[children]
        is_object = t.kind[children] == 1
        own[top & is_object & (top_is[of] == FIRST)] = "[0]"
        # paths, a level of brackets after the other
        index = np.full(stride, -1, np.int64)
        index[children] = np.arange(len(children))
        holder = np.where(top, -1, index[np.maximum(arrays, 0)])
        path, above = np.full(len(children), "", object), np.full(len(children), None, object)
        path[top] = where.path.take(pa.array(of[top])).to_numpy(zero_copy_only=False) + own[top]
        above[top] = where.above.take(pa.array(of[top])).to_numpy(zero_copy_only=False)
        element = is_object & (in_array | (top & (top_is[of] != NONE)))
        ready, left = top.copy(), np.flatnonzero(~top)
        while len(left):
            now = left[ready[holder[left]]]
            path[now] = path[holder[now]] + own[now]
            above[now] = np.where(element[holder[now]], path[holder[now]], above[holder[now]])
            ready[now] = True
            left = left[~ready[left]]
        root = where.root[of]
        body = [t.data[a:b].tobytes() for a, b in zip(t.at[children[element]], t.close[children[element]])] if values_ else None
        yield Level(root[element], pa.array(path[element], pa.string()), pa.array(above[element], pa.string()), None if body is None else pa.array(body, pa.binary()).cast(pa.string()))
        inner = np.flatnonzero(t.kind[children] == STRING)
        values = _strings(t, children[inner])
        likely = _likely(values)
        picked = inner[likely]
        texts = values.take(pa.array(np.flatnonzero(likely)))
        top_is = np.where(in_array[picked], SELF, np.where(top[picked], top_is[of[picked]], NONE))
        # a text that is an element by itself has the element above it, another one the element that it stands in
        where = Level(root[picked], pa.array(path[picked], pa.string()), pa.array(above[picked], pa.string()))


def _likely(texts: pa.Array) -> np.ndarray:
    """Whether a text may be JSON with something in it."""
    seen = pc.utf8_trim(texts, " \t\r\n")
    return pc.fill_null(pc.match_substring_regex(seen, r'^[\[{"](?s:.*)[\]}"]$'), False).to_numpy(zero_copy_only=False).astype(bool)


def _readable(texts: pa.Array, where: Level, top_is: int = NONE, values_: bool = False) -> Iterator[Level]:
    """Array-element objects in the texts that may be JSON."""
    rows = np.flatnonzero(_likely(texts))
    if len(rows):
        yield from json_nodes(texts.take(pa.array(rows)), where.take(rows), np.full(len(rows), top_is), values_)


def _children(values: pa.Array, where: Level) -> tuple[pa.Array, np.ndarray, Level]:
    """Elements of a list column by its offsets: their values, places and where they are, keys handed down by a take."""
    wide = pa.types.is_large_list(values.type)
    offsets = np.frombuffer(values.buffers()[1], np.int64 if wide else np.int32)[values.offset : values.offset + len(values) + 1]
    parents = pc.list_parent_indices(values)
    child = pc.list_flatten(values)
    of = parents.to_numpy(zero_copy_only=False)
    lengths = np.where(values.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets.astype(np.int64)), 0)
    place = np.arange(len(child)) - (np.cumsum(lengths) - lengths)[of] if len(child) else np.empty(0, np.int64)
    path = _join(where.path.take(parents), "[", pa.array(place, pa.int64()).cast(pa.string()), "]")
    return child, place, Level(where.root[of], path, where.above.take(parents))


def nested_nodes(values: pa.Array, where: Level, top_is: int = NONE) -> Iterator[Level]:
    """Array-element objects of an Arrow column of any nesting, by list offsets and parent indexes."""
    kind = values.type
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        child, _, below = _children(values, where)
        if pa.types.is_struct(child.type):
            there = np.flatnonzero(child.is_valid().to_numpy(zero_copy_only=False))
            yield below.take(there)
            below = Level(below.root, below.path, below.path)
        yield from nested_nodes(child, below, SELF)
    elif pa.types.is_struct(kind):
        there = np.flatnonzero(values.is_valid().to_numpy(zero_copy_only=False))
        some, own = values.take(pa.array(there)), where.take(there)
        for k, field in enumerate(kind):
            yield from nested_nodes(pc.struct_field(some, k), Level(own.root, _join(own.path, "." + field.name), own.above))
    elif pa.types.is_string(kind) or pa.types.is_large_string(kind):
        yield from _readable(values, where, top_is)


def _start(column: str, n: int) -> Level:
    return Level(np.arange(n), pa.array([column] * n, pa.string()), pa.nulls(n, pa.string()))


def _place(path: pa.Array) -> pa.Array:
    """The place that a path ends with."""
    return pc.struct_field(pc.extract_regex(path, r"\[(?P<n>\d+)\]$"), "n").cast(pa.int64())


_NODES = ["root_id", "node_path", "parent_path", "place"]


def nodes(table: DataFrame, key: str, column: str, json_text: bool = False, values: bool = False) -> DataFrame:
    """One row per object that is an array element in ``column``, at any depth: ``root_id, node_path, parent_path, place``.

    With ``json_text`` the column is JSON text itself, in which a bare object counts as element 0; ``values`` adds the object's
    JSON text as ``value``. A path starts with the column's name; ``parent_path`` names the nearest element above it, null at
    the top; ``place`` is the one in its array. Rows with a null key or value give none, unreadable texts are leaves, repeated
    rows count once, further columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, held = batch.column(0), batch.column(1)
            start = _start(column, len(keys))
            for level in _readable(held, start, FIRST, values) if json_text else nested_nodes(held, start):
                if len(level.root):
                    cols = [keys.take(pa.array(level.root)).cast(pa.string()), level.path.cast(pa.string()), level.above.cast(pa.string()), _place(level.path)]
                    yield pa.RecordBatch.from_arrays(cols + [level.value] * values, _NODES + ["value"] * values)

    if values and not json_text:
        raise ValueError("values are those of JSON texts; child_table gives the fields of nested columns")
    rows = table.where(F.col(key).isNotNull() & F.col(column).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(column).alias("value"))
    return rows.mapInArrow(run, "root_id string, node_path string, parent_path string, place long" + ", value string" * values).distinct()


def node_paths(table: DataFrame, key: str, column: str, json_text: bool = False) -> DataFrame:
    """``root_id, node_path`` of :func:`nodes`."""
    return nodes(table, key, column, json_text).select("root_id", "node_path")


def child_table(table: DataFrame, key: str, path: str) -> DataFrame:
    """Elements of a nested array as a flat table: ``root_id, node_path, parent_path, place``, then their plain fields as ``item_<name>``.

    ``path`` names the arrays from the outermost, such as ``samples.turns``. Null and empty arrays, null structs and null
    elements give no row; repeated rows count once.
    """
    names = path.split(".")
    kind = table.schema[names[0]].dataType
    for name in names[1:]:
        kind = kind.elementType[name].dataType
    fields = [f for f in kind.elementType.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, held = batch.column(0), batch.column(1)
            where = _start(names[0], len(keys))
            for k, name in enumerate(names):
                if k:
                    held, where = pc.struct_field(held, name), Level(where.root, _join(where.path, "." + name), where.path)
                held, place, where = _children(held, where)
                there = np.flatnonzero(held.is_valid().to_numpy(zero_copy_only=False))
                held, place, where = held.take(pa.array(there)), place[there], where.take(there)
            cols = [keys.take(pa.array(where.root)).cast(pa.string()), where.path.cast(pa.string()), where.above.cast(pa.string()), pa.array(place, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols + [pc.struct_field(held, f.name) for f in fields], _NODES + [f"item_{f.name}" for f in fields])

    rows = table.where(F.col(key).isNotNull() & F.col(names[0]).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(names[0]).alias("value"))
    schema = T.StructType([T.StructField(n, T.LongType() if n == "place" else T.StringType()) for n in _NODES] + [T.StructField(f"item_{f.name}", f.dataType) for f in fields])
    return rows.mapInArrow(run, schema).distinct()


def call_table(table: DataFrame, key: str, column: str = "tool_calls") -> DataFrame:
    """Calls in JSON texts as a flat table: ``root_id, node_path, parent_path, place, call_id, tool, arguments``.

    Rows are the elements of the outermost array; name and arguments may stand in ``function`` or beside it.
    """
    every = nodes(table, key, column, True, True).where("parent_path is null")
    text = lambda *paths: F.coalesce(*(F.get_json_object("value", p) for p in paths))
    return every.select(*_NODES, text("$.id").alias("call_id"), text("$.function.name", "$.name").alias("tool"), text("$.function.arguments", "$.arguments").alias("arguments"))


def p4_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the three nested fields, one row each."""
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    parts = [("session_events", nodes(read("session_events"), "event_id", "tool_calls", True)), ("task_results", nodes(read("task_results"), "task_key", "samples")), ("sft_samples", nodes(read("sft_samples"), "sample_id", "messages"))]
    every = [rows.select(F.lit(name).alias("root_table"), *_NODES) for name, rows in parts]
    return every[0].unionByName(every[1]).unionByName(every[2])
