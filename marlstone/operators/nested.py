"""Nested JSON texts as flat tables with parent-child links, from Arrow buffers without parsing rows.

A batch's texts are one byte buffer. Quotes, brackets and separators are found in the whole buffer at once; levels,
parents and positions of all tokens follow from cumulative sums and sorted searches over their offsets; keys are
propagated to the emitted nodes by one take. The grammar is checked by the same arrays (each token against the token
before it and its container), so broken texts give nothing.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.stages import stage

#: Bytes of text that are indexed at once.
CHUNK = 4 << 20
_SCALAR = r"^(?:-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null)$"
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdefABCDEF")] = True
_ESCAPES = np.zeros(256, bool)
_ESCAPES[list(b'"\\/bfnrtu')] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"{}[],:")] = True
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\r\n")] = True


def _slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    size = ends - starts
    off = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(off[-1]) - np.repeat(off[:-1], size) + np.repeat(starts, size)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data[at].tobytes())])


def _decoded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, escaped: np.ndarray) -> pa.Array:
    """Text of string tokens (bounds without quotes); only distinct strings with escapes are decoded one by one."""
    raw = _slices(data, starts, ends).cast(pa.large_string())
    if not escaped.any():
        return raw
    odd = raw.filter(pa.array(escaped)).dictionary_encode()
    plain = [json.loads(f'"{s}"').encode("utf-16", "surrogatepass").decode("utf-16", "replace") for s in odd.dictionary.to_pylist()]
    return pc.replace_with_mask(raw, pa.array(escaped), pa.array(plain, pa.large_string()).take(odd.indices))


def index_texts(texts: pa.Array) -> dict[str, np.ndarray | pa.Array]:
    """Nodes of all valid JSON texts: row, node, parent (-1 at the top), level, kind, name, nth, path, value; ``text`` is kept.

    Rows whose text is null or no valid JSON have no node. node counts a text's values from 0 in order; kind is
    object, array, string, number, boolean or null; value is the decoded string or the scalar as written.
    Repeated names of an object give a node each.
    """
    lf, none = pa.scalar(b"\n", pa.large_binary()), pa.scalar(b"", pa.large_binary())
    lines = pc.fill_null(pc.binary_join_element_wise(texts.cast(pa.large_binary()), lf, none), lf)
    off = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
    data = np.frombuffer(lines.buffers()[2], np.uint8)[off[0] : off[-1]] if off[-1] > off[0] else np.zeros(0, np.uint8)
    off, n_rows = off - off[0], len(lines)
    bad = np.zeros(n_rows, bool)
    at = np.arange(len(data))
    row_of = lambda p: np.searchsorted(off, p, side="right") - 1
    slash = data == 92
    before = np.maximum.accumulate(np.where(slash, -1, at)) if len(at) else at  # last byte that is no backslash
    run = np.concatenate([[0], (at - before)[:-1]]) if len(at) else at  # backslashes just before
    quote = np.flatnonzero((data == 34) & (run % 2 == 0))
    per_row = np.searchsorted(quote, off)
    bad |= np.diff(per_row) % 2 == 1
    nth = np.arange(len(quote)) - per_row[row_of(quote)] if len(quote) else quote
    opens, closes = quote[nth % 2 == 0], quote[nth % 2 == 1]
    if len(opens) != len(closes):  # broken rows lose their last quote
        lone = bad[row_of(opens)] & (np.append(row_of(opens)[1:], -1) != row_of(opens))
        opens = opens[~lone]
    delta = np.zeros(len(data) + 1, np.int32)
    delta[opens] += 1
    delta[closes + 1] -= 1
    within = np.cumsum(delta[:-1]) > 0
    bad[row_of(np.flatnonzero(within & (data < 32)))] = True
    esc = np.flatnonzero(slash & (run % 2 == 0))
    follow = np.minimum(esc + 1, len(data) - 1)
    wrong = ~_ESCAPES[data[follow]]
    u = esc[data[follow] == 117]
    for j in range(2, 6):
        bad[row_of(u[~_HEX[data[np.minimum(u + j, len(data) - 1)]]])] = True
    bad[row_of(esc[wrong])] = True
    mark = np.flatnonzero(_MARK[data] & ~within)
    other = ~within & ~_MARK[data] & ~_SPACE[data]
    edge = np.diff(np.concatenate([[0], other.astype(np.int8), [0]]))
    s_from, s_to = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    good = pc.match_substring_regex(_slices(data, s_from, s_to), _SCALAR).to_numpy(zero_copy_only=False).astype(bool)
    bad[row_of(s_from[~good])] = True
    start = np.concatenate([mark, opens, s_from])
    kind = np.concatenate([data[mark], np.full(len(opens), 115, np.uint8), np.full(len(s_from), 118, np.uint8)])
    end = np.concatenate([mark + 1, closes, s_to])
    order = np.argsort(start, kind="stable")
    start, kind, end = start[order], kind[order], end[order]
    row = row_of(start) if len(start) else start
    # rows found broken so far are dropped, which keeps the levels of the others sound
    keep = ~bad[row] if len(row) else np.zeros(0, bool)
    start, kind, end, row = start[keep], kind[keep], end[keep], row[keep]
    n = len(start)
    up, down = (kind == 123) | (kind == 91), (kind == 125) | (kind == 93)
    change = up.astype(np.int64) - down
    after = np.cumsum(change)
    first = np.concatenate([[True], row[1:] != row[:-1]]) if n else np.zeros(0, bool)
    base = np.maximum.accumulate(np.where(first, np.arange(n), 0)) if n else np.zeros(0, np.int64)
    after = after - (after - change)[base]
    level = np.where(up, after - 1, after)
    last = np.concatenate([first[1:], [True]]) if n else first
    bad[row[level < 0]] = True
    bad[row[last & (after != 0)]] = True
    have = np.zeros(n_rows, bool)
    have[row] = True
    bad |= ~have
    keep = ~bad[row]
    start, kind, end, row, level, up, down, first = (x[keep] for x in (start, kind, end, row, level, up, down, first))
    n = len(start)
    idx = np.arange(n)
    # the open bracket of each token's container: the last one, one level up
    o = np.flatnonzero(up)
    by = level[o] * (n + 1) + o
    o = o[np.argsort(by, kind="stable")]
    by = np.sort(by)
    parent = np.full(n, -1)
    inner = level > 0
    parent[inner] = o[np.searchsorted(by, (level[inner] - 1) * (n + 1) + idx[inner]) - 1] if inner.any() else parent[inner]
    mate = np.full(n, -1)
    mate[down] = o[np.searchsorted(by, level[down] * (n + 1) + idx[down]) - 1] if down.any() else mate[down]
    inside = np.where(parent >= 0, kind[np.maximum(parent, 0)] if n else 0, 0)  # kind of the container, 0 at the top
    prev = np.concatenate([[0], kind[:-1]]) if n else kind
    prev = np.where(first, 0, prev)
    is_key = (kind == 115) & (inside == 123) & ((prev == 123) | (prev == 44))
    prev_key = np.concatenate([[False], is_key[:-1]]) & ~first if n else is_key
    value = up | (kind == 118) | ((kind == 115) & ~is_key)
    prev_value = np.isin(prev, [125, 93, 118]) | ((prev == 115) & ~prev_key)
    fits = np.select(
        [is_key, value & (inside == 0), value & (inside == 91), value & (inside == 123), kind == 44, kind == 58, down],
        [
            np.ones(n, bool),
            first,
            (prev == 91) | (prev == 44),
            prev == 58,
            (inside != 0) & prev_value,
            (inside == 123) & prev_key,
            (kind - kind[np.maximum(mate, 0)] == 2) & (prev_value | (prev == kind[np.maximum(mate, 0)])) if n else down,
        ],
        False,
    )
    bad[row[~fits]] = True
    sound = ~bad[row]
    # an element's position: the commas of its array before it
    comma = kind == 44
    group = np.argsort(parent, kind="stable")
    seen = np.cumsum(comma[group])
    p_sorted = parent[group]
    starts = np.concatenate([[True], p_sorted[1:] != p_sorted[:-1]]) if n else first
    seen = seen - (seen - comma[group])[np.maximum.accumulate(np.where(starts, np.arange(n), 0))] if n else seen
    place = np.empty(n, np.int64)
    place[group] = seen
    node_tok = np.flatnonzero(value & sound)
    node_of = np.full(n + 1, -1)
    node_of[node_tok] = np.arange(len(node_tok))
    t_row, t_level, t_kind = row[node_tok], level[node_tok], kind[node_tok]
    t_parent = node_of[parent[node_tok]] if n else parent[node_tok]
    in_object = inside[node_tok] == 123
    in_array = inside[node_tok] == 91
    escapes = np.searchsorted(esc, end) > np.searchsorted(esc, start)
    key_tok = np.maximum(node_tok - 2, 0)[in_object]
    names = _decoded(data, start[key_tok] + 1, end[key_tok], escapes[key_tok])
    slot = np.full(len(node_tok), -1)
    slot[in_object] = np.arange(in_object.sum())
    name = names.take(pa.array(slot, mask=~in_object))
    nth_ = pa.array(place[node_tok], pa.int64(), mask=~in_array)
    step = pc.coalesce(pc.binary_join_element_wise(pa.scalar(".", pa.large_string()), name, pa.scalar("", pa.large_string())), pc.binary_join_element_wise(pa.scalar("[", pa.large_string()), nth_.cast(pa.large_string()), pa.scalar("]", pa.large_string()), pa.scalar("", pa.large_string())))
    # paths level by level, each from its parents' by a take
    paths: list[pa.Array] = []
    where: list[np.ndarray] = []
    spot = np.zeros(len(node_tok), np.int64)
    by_level = np.argsort(t_level, kind="stable")
    bounds = np.searchsorted(t_level[by_level], np.arange(t_level.max() + 2 if len(t_level) else 1))
    for d in range(len(bounds) - 1):
        mine = by_level[bounds[d] : bounds[d + 1]]
        spot[mine] = np.arange(len(mine))
        above = paths[-1].take(pa.array(spot[t_parent[mine]])) if d else pa.array(["$"] * len(mine), pa.large_string())
        paths.append(pc.binary_join_element_wise(above, step.take(pa.array(mine)), pa.scalar("", pa.large_string())) if d else above)
        where.append(mine)
    back = np.empty(len(node_tok), np.int64)
    back[np.concatenate(where) if where else np.zeros(0, np.int64)] = np.arange(len(node_tok))
    path = pa.concat_arrays(paths).take(pa.array(back)) if paths else pa.array([], pa.large_string())
    is_str, is_sca = t_kind == 115, t_kind == 118
    strings = _decoded(data, start[node_tok[is_str]] + 1, end[node_tok[is_str]], escapes[node_tok[is_str]])
    scalars = _slices(data, start[node_tok[is_sca]], end[node_tok[is_sca]]).cast(pa.large_string())
    both = pa.concat_arrays([strings, scalars])
    slot = np.full(len(node_tok), -1)
    slot[is_str], slot[is_sca] = np.arange(is_str.sum()), is_str.sum() + np.arange(is_sca.sum())
    text = both.take(pa.array(slot, mask=slot < 0))
    head = data[start[node_tok]]
    names_of = np.select([t_kind == 123, t_kind == 91, is_str, head == 110, (head == 116) | (head == 102)], ["object", "array", "string", "null", "boolean"], "number")
    row_first = np.searchsorted(t_row, t_row)
    return {
        "row": t_row, "node": np.arange(len(node_tok)) - row_first, "parent": np.where(t_parent >= 0, t_parent - row_first, -1), "level": t_level,
        "kind": pa.array(names_of.astype(object), pa.string()), "name": name, "nth": nth_, "path": path, "value": text,
    }


def _nodes_of(texts: pa.Array) -> dict:
    """index_texts, where a text that is a JSON string of a valid array or object counts as that."""
    got = index_texts(texts)
    alone = (got["level"] == 0) & pc.equal(got["kind"], "string").to_numpy(zero_copy_only=False)
    rows = got["row"][alone]
    inner = index_texts(got["value"].filter(pa.array(alone)).cast(pa.large_string()))
    held = pa.array(["array", "object"], pa.string())
    scalar = lambda nodes: nodes["row"][(nodes["level"] == 0) & ~pc.is_in(nodes["kind"], held).to_numpy(zero_copy_only=False)]
    top, deep = ~np.isin(got["row"], scalar(got)), ~np.isin(inner["row"], scalar(inner))
    inner["row"] = rows[inner["row"]] if len(inner["row"]) else inner["row"]
    out = {}
    for k in got:
        pick = lambda x, m: x.filter(pa.array(m)) if isinstance(x, pa.Array) else pa.array(x[m])
        a, b = pick(got[k], top), pick(inner[k], deep)
        out[k] = pa.concat_arrays([a, b.cast(a.type)])
    return out


def nested_nodes(records: DataFrame, keys: list[str], fields: dict[str, Column]) -> DataFrame:
    """One row per value in the JSON texts of ``fields`` (attr to column): keys, attr, node, parent, level, kind, name, nth, path, value.

    A text counts if it is a valid JSON array or object, or a JSON string that holds one; other texts, nulls, blanks
    and broken or cut-off JSON give no rows. parent is the node of the containing array or object (null at the top), so
    the rows of a record and attr form a tree; (keys, attr, node) is unique where keys are. A lone surrogate becomes U+FFFD.
    """
    pairs = F.array(*[F.struct(F.lit(a).alias("attr"), c.cast("string").alias("text")) for a, c in fields.items()])
    rows = records.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.explode(pairs).alias("_p")).select(*[f"_k{i}" for i in range(len(keys))], "_p.attr", "_p.text")
    rows = rows.filter(F.col("text").rlike(r'^[ \t\r\n]*[\[{"]'))
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = pc.fill_null(pc.binary_length(b.column(n + 1)), 0).to_numpy(zero_copy_only=False)
            part = np.cumsum(size) // CHUNK
            for lo in np.unique(part, return_index=True)[1].tolist() if len(part) else []:
                hi = int(np.searchsorted(part, part[lo], side="right"))
                piece = b.slice(lo, hi - lo)
                got = _nodes_of(piece.column(n + 1))
                take = pc.cast(got["row"], pa.int64())
                cols = [piece.column(i).take(take) for i in range(n + 1)]
                parent = pc.if_else(pc.less(got["parent"], 0), None, got["parent"])
                cols += [c.cast(t) for c, t in ((got["node"], pa.int32()), (parent, pa.int32()), (got["level"], pa.int32()), (got["kind"], pa.string()), (got["name"], pa.string()), (got["nth"], pa.int32()), (got["path"], pa.string()), (got["value"], pa.string()))]
                yield pa.RecordBatch.from_arrays(cols, [*b.schema.names[: n + 1], "node", "parent", "level", "kind", "name", "nth", "path", "value"])

    out = T.StructType([*rows.schema.fields[: n + 1], *T.StructType.fromDDL("node int, parent int, level int, kind string, name string, nth int, path string, value string").fields])
    return rows.mapInArrow(run, out).select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], "attr", "node", "parent", "level", "kind", "name", "nth", "path", "value")


def nested_tables(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(containers, leaves) of nested_nodes: arrays and objects, and the values in them, each with the node of its container.

    The nodes are staged, so texts are indexed once for both tables.
    """
    held, once = F.col("kind").isin("object", "array"), stage(nodes)
    return once.filter(held).drop("value"), once.filter(~held)


def child_table(nodes: DataFrame, keys: list[str], array: str | None, members: dict[str, str]) -> DataFrame:
    """One row for each object in the arrays named ``array`` (None: in any array): keys, attr, node, parent, place and its ``members``, cast to their types.

    parent is the node of the array, place the element's position in it. A member that an object lacks, or whose value
    doesn't fit its type, is null; of a repeated member the last one counts. Nested members have tables of their own.
    """
    ids = [*keys, "attr"]
    own = (F.col("kind") == "object") & F.col("nth").isNotNull()
    leaf = F.col("name").isin(*members) & ~F.col("kind").isin("object", "array", "null")
    rows = nodes.filter(own | leaf).withColumn("_o", F.when(own, F.col("node")).otherwise(F.col("parent")))
    last = [F.max_by("value", F.when(leaf & (F.col("name") == m), F.col("node"))).try_cast(t).alias(m) for m, t in members.items()]
    flat = rows.groupBy(*ids, F.col("_o").alias("node")).agg(F.max(F.when(own, F.col("parent"))).alias("parent"), F.max(F.when(own, F.col("nth"))).alias("place"), *last).filter("place is not null")
    if array is None:
        return flat
    named = nodes.filter((F.col("kind") == "array") & (F.col("name") == array)).select(*ids, F.col("node").alias("parent"))
    return flat.join(named, [*ids, "parent"], "left_semi").select(*flat.columns)
