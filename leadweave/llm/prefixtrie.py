"""Prefix trie of conversations, from padded matrices of turn ids.

A turn's id is 12 bytes of the SHA-256 of its role and text, and the length of its text; a conversation is its path, the
bytes of its turn ids in order. Equal paths collapse first. Distinct paths are dealt to shards by ranges and handled in
blocks of sorted rows: a padded matrix of turn ids is put in order by `lexsort`, column changes OR-accumulated from the left
mark where the node of each depth starts, and `reduceat` sums members, children, leaves and saved bytes depth by depth.
Nodes between the first and the last row of a block are whole. Those on the paths of these two rows may go on in other
blocks: their parts, two rows a block, are put together in path order with a stack, and give their children their parents.

Bounds: a block has at most `CELLS` cells (a longer single path is a block of its own); the step that recombines reads two
rows a block and holds one path; a conversation's turn ids, 16 bytes a turn, are one row, gathered from partial lists.
Member ids of a path are joined in ranges of the id and hashed as a stream, so a path of any number of members is no group in memory.

Defined cases: turns are ordered by `turn`, null first, turns of equal number by the turn id; null roles and texts are empty;
rows with a null conversation id belong to no conversation and are left out; an empty table has no node; repeated rows are
repeated turns; texts of any length are hashed whole; other columns, whatever their names, are not read. Different turns
are taken for equal if 96 bits of their digest and their lengths agree, which chance does not bring about.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadweave.session import cut

CELLS = 1 << 19  # cells of a block's matrix
RANGE_ROWS, LEAST_RANGES, MOST_RANGES = 65_536, 16, 10_000
ID_BYTES = 16
NO_MEMBERS = hashlib.sha256(b"").hexdigest()
TOP = np.iinfo(np.int64).max

BLOCK_ROWS = pa.schema([
    ("block", pa.int64()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("parent_side", pa.int32()), ("parent_depth", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()),
    # parts of the nodes on the path of the block's first (side 0) or last row (side 1), from depth `skip` on
    ("side", pa.int32()), ("path", pa.binary()), ("skip", pa.int64()), ("p_convs", pa.list_(pa.int64())), ("p_least", pa.list_(pa.int64())),
    ("p_children", pa.list_(pa.int64())), ("p_leaves", pa.list_(pa.int64())), ("p_saved", pa.list_(pa.int64())), ("p_ends", pa.list_(pa.string()))])
BLOCK_DDL = ("block long, conv_id long, depth long, parent_conv_id long, parent_side int, parent_depth long, n_convs long, n_children long, n_leaves long, "
             "saved_tokens long, ends string, side int, path binary, skip long, p_convs array<long>, p_least array<long>, p_children array<long>, "
             "p_leaves array<long>, p_saved array<long>, p_ends array<string>")
JOINED_DDL = ("number long, parent_number long, conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, "
              "block long, side int, numbers array<long>")


def turn_id(role: Column, text: Column) -> Column:
    """Id of a turn, as 32 hexadecimal digits: 12 bytes of digest, 4 of text length."""
    role, text = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(F.substring(digest, 1, 24), F.lpad(F.hex(F.octet_length(text).cast("bigint")), 8, "0"))


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turn ids of each conversation in order."""
    turns = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", turn_id(F.col("role"), F.col("text")).alias("id"))
    listed = turns.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id"))).alias("t"))
    return listed.select("conv_id", F.col("t.id").alias("turns"))


def as_path(turns: Column) -> Column:
    return F.unhex(F.array_join(turns, ""))


def rebuilt(lists: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """(conv_id, path): each conversation behind the opening turns of the first of its group of `group` ids.

    The opening has as many turns as the crc32 of the id says, modulo `most`; they replace as many turns of its own.
    """
    head = lists.filter(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("first"), F.slice("turns", 1, most - 1).alias("opening"))
    told = lists.withColumns({"first": F.col("conv_id") - F.col("conv_id") % group, "h": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")})
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    opening = F.slice(F.coalesce("opening", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    return told.join(head, "first", "left").select("conv_id", as_path(F.concat(opening, rest)).alias("path"))


def _ranges(rows: int, each: int = RANGE_ROWS) -> int:
    return int(min(MOST_RANGES, max(LEAST_RANGES, rows // each)))


def distinct_paths(members: DataFrame) -> DataFrame:
    """(path, n, least, ends): each path with its number of members, their least id and the digest of their ids in order."""
    dealt = members.repartitionByRange(_ranges(members.count()), "conv_id").withColumn("_range", F.spark_partition_id())
    parts = dealt.groupBy("path", "_range").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"),
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def digest(batches):
        path = done = None
        for batch in batches:
            out = []
            for now, n, least, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if now == path:
                    state[0] += n
                    done.update(b"," + ids.encode())
                    continue
                if path is not None:
                    out.append((path, *state, done.hexdigest()))
                path, state, done = now, [n, least], hashlib.sha256(ids.encode())
            yield as_batch(out)
        if path is not None:
            yield as_batch([(path, *state, done.hexdigest())])

    def as_batch(rows):
        columns = list(zip(*rows)) if rows else [[]] * 4
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["path", "n", "least", "ends"])

    rows = parts.select("path", "n", "least", "ids").repartition("path").sortWithinPartitions("path", "least")
    return rows.mapInArrow(digest, "path binary, n long, least long, ends string")


def block_nodes(path: pa.Array, n: np.ndarray, least: np.ndarray, ends: np.ndarray):
    """(nodes, parts) of a block of distinct paths.

    nodes: columns of the whole nodes; parts: for the first and the last row (row number, first depth, columns by depth).
    """
    raw = [np.frombuffer(p, ">u8").reshape(-1, 2) for p in path.to_pylist()]
    lens = np.array([len(r) for r in raw])
    rows, width = len(lens), int(lens.max())
    hi, lo = np.zeros((rows, width), np.uint64), np.zeros((rows, width), np.uint64)
    if width:
        flat = np.concatenate(raw)
        at = np.repeat(np.arange(rows), lens), np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
        hi[at], lo[at] = flat[:, 0], flat[:, 1]
    order = np.lexsort([lens, *(m[:, j] for j in reversed(range(width)) for m in (lo, hi))])
    hi, lo, lens, n, least, ends = hi[order], lo[order], lens[order], n[order], least[order], ends[order]
    inside = np.arange(width) < lens[:, None]
    change = np.ones((rows, width), bool)
    change[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]) | (inside[1:] != inside[:-1])
    change = np.logical_or.accumulate(change, axis=1)
    leaf = np.zeros(rows, np.int64)  # rows whose last node is whole and has no child
    if rows > 2:
        leaf[1:-1] = change[np.arange(2, rows), lens[1:-1] - 1]
    saved, opens = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    nodes = {c: [] for c in ("conv_id", "depth", "parent_conv_id", "parent_side", "parent_depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends")}
    parts = [[], []]
    for j in reversed(range(width)):
        starts = np.flatnonzero(change[:, j])
        real = lens[starts] > j
        members, first = np.add.reduceat(n, starts), np.minimum.reduceat(least, starts)
        children, leaves, below = np.add.reduceat(opens, starts), np.add.reduceat(leaf, starts), np.add.reduceat(saved, starts)
        ended = np.where(lens[starts] == j + 1, ends[starts], None)
        if lens[0] > j:
            parts[0].append((members[0], first[0], children[0], leaves[0], below[0], ended[0]))
            real[0] = False
        if lens[-1] > j:
            if len(starts) > 1:
                parts[1].append((members[-1], first[-1], children[-1], leaves[-1], below[-1], ended[-1]))
            real[-1] = False
        whole = starts[real]
        own = (members[real] - 1) * (lo[whole, j] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        if j:
            above = np.flatnonzero(change[:, j - 1])
            parent = np.searchsorted(above, whole, side="right") - 1
            side = np.where((parent == 0) & (lens[0] >= j), 0, np.where((parent == len(above) - 1) & (lens[-1] >= j), 1, -1))
            parent_least = np.minimum.reduceat(least, above)[parent]
        else:
            side, parent_least = np.zeros(len(whole), np.int64), np.zeros(len(whole), np.int64)
        for name, values in (("conv_id", first[real]), ("depth", np.full(len(whole), j + 1)), ("parent_conv_id", parent_least), ("parent_side", side),
                             ("parent_depth", np.full(len(whole), j)), ("n_convs", members[real]), ("n_children", children[real]),
                             ("n_leaves", leaves[real]), ("saved_tokens", below[real] + own), ("ends", ended[real])):
            nodes[name].append(values)
        opens[:] = 0
        opens[whole] = 1
        saved[whole] += own
    parts[0].append((n.sum(), least.min(), opens.sum(), leaf.sum(), saved.sum(), ends[0] if lens[0] == 0 else None))
    nodes = {c: np.concatenate(v) if v else np.zeros(0, object if c == "ends" else np.int64) for c, v in nodes.items()}
    return nodes, [(order[0], 0, parts[0][::-1]), (order[-1], int(lens[-1]) + 1 - len(parts[1]), parts[1][::-1])]


def _blocks(batches, cells: int):
    """The sorted rows of a shard in blocks of at most `cells` cells."""
    kept, rows, widest = [], 0, 0
    for batch in batches:
        widths = np.diff(np.frombuffer(batch.column(0).buffers()[1], np.int32)[batch.column(0).offset:][: batch.num_rows + 1]) // ID_BYTES + 1
        at = 0
        while at < batch.num_rows:
            reach = np.maximum(np.maximum.accumulate(widths[at:]), widest)
            over = np.flatnonzero(reach * (rows + 1 + np.arange(len(reach))) > cells)
            take = int(over[0]) if len(over) else len(reach)
            if not take and not rows:
                take = 1
            if take:
                kept.append(batch.slice(at, take))
                rows, widest, at = rows + take, int(reach[take - 1]), at + take
            if len(over):
                yield pa.Table.from_batches(kept).combine_chunks()
                kept, rows, widest = [], 0, 0
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks()


def shard_nodes(batches, cells: int = CELLS):
    """Rows of `BLOCK_ROWS` for the sorted paths (path, n, least, ends) of a shard."""
    shard, number = TaskContext.get().partitionId() << 32, 0
    for table in _blocks(batches, cells):
        path = table["path"].combine_chunks()
        nodes, parts = block_nodes(path, np.asarray(table["n"]), np.asarray(table["least"]), np.array(table["ends"].to_pylist(), object))
        block, number = shard + number, number + 1
        size = len(nodes["depth"])
        known = {c: pa.array(v, BLOCK_ROWS.field(c).type) for c, v in nodes.items() if c not in ("parent_conv_id", "parent_side")}
        outer = nodes["parent_side"] >= 0
        known |= {"block": pa.array(np.full(size, block)), "parent_conv_id": pa.array(nodes["parent_conv_id"].astype(np.int64), pa.int64(), mask=outer),
                  "parent_side": pa.array(nodes["parent_side"].astype(np.int32), pa.int32(), mask=~outer)}
        yield _filled(known, size)
        for side, (row, skip, columns) in enumerate(parts):
            if columns:
                given = {"block": [block], "side": [side], "path": [path[int(row)].as_py()], "skip": [skip]}
                for name, values in zip(("p_convs", "p_least", "p_children", "p_leaves", "p_saved", "p_ends"), zip(*columns)):
                    given[name] = [[v if v is None or isinstance(v, str) else int(v) for v in values]]
                yield _filled({c: pa.array(v, BLOCK_ROWS.field(c).type) for c, v in given.items()}, 1)


def _filled(known: dict, size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([known.get(f.name, pa.nulls(size, f.type)) for f in BLOCK_ROWS], schema=BLOCK_ROWS)


def recombine(batches):
    """Whole nodes, numbered, from the parts of all blocks in path order, and the node numbers on each block's two paths."""
    # A node: number, convs, least, children, leaves, saved, ends, bytes of its text, leaves and saved bytes of edge nodes.
    # Leaves and saved bytes of whole nodes are in the parts of every node above them; only those of edge nodes are handed up.
    stack, before, number, out = [], b"", 0, []

    def close(depth: int):
        while len(stack) > depth:
            k, convs, least, children, leaves, saved, ends, size, edge_leaves, edge_saved = stack.pop()
            edge_leaves, edge_saved = edge_leaves if children else 1, edge_saved + (convs - 1) * size
            if stack:
                stack[-1][3] += 1
                stack[-1][8] += edge_leaves
                stack[-1][9] += edge_saved
            out.append((k, stack[-1][0] if stack else None, least, len(stack), convs, children, leaves + edge_leaves, saved + edge_saved, ends, None, None, None))

    for batch in batches:
        for row in range(batch.num_rows):
            block, side, path, skip, *columns = (c[row].as_py() for c in batch.columns)
            same = np.frombuffer(path[: min(len(path), len(before))], np.uint8) != np.frombuffer(before[: min(len(path), len(before))], np.uint8)
            common = int(np.argmax(same)) if same.any() else len(same)
            close(common // ID_BYTES + 1)
            for depth in range(len(stack), len(path) // ID_BYTES + 1):
                size = int.from_bytes(path[depth * ID_BYTES - 4 : depth * ID_BYTES], "big") if depth else 0
                stack.append([number, 0, TOP, 0, 0, 0, None, size, 0, 0])
                number += 1
            for node, (convs, least, children, leaves, saved, ends) in zip(stack[skip:], zip(*columns)):
                node[1:7] = [node[1] + convs, min(node[2], least), node[3] + children, node[4] + leaves, node[5] + saved, node[6] or ends]
            before = path
            out.append((None,) * 9 + (block, side, [node[0] for node in stack]))
            if len(out) >= 1000:
                yield _joined(out)
                out.clear()
    close(0)
    yield _joined(out)


def _joined(rows) -> pa.RecordBatch:
    names = ["number", "parent_number", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "block", "side", "numbers"]
    kinds = [pa.int64()] * 8 + [pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 12, kinds)], names)


def trie(members: DataFrame, cells: int = CELLS) -> DataFrame:
    """The nodes of the trie of (conv_id, path): one row a distinct path prefix."""
    members = cut(members, "trie-members")
    paths = cut(distinct_paths(members), "trie-paths")
    total = paths.agg(F.sum(F.length("path") / ID_BYTES + 1)).first()[0] or 0
    dealt = paths.repartitionByRange(_ranges(int(total), 4 * CELLS), "path").sortWithinPartitions("path")
    found = cut(dealt.mapInArrow(lambda batches: shard_nodes(batches, cells), BLOCK_DDL), "trie-blocks")
    edges = found.filter("path IS NOT NULL").select("block", "side", "path", "skip", "p_convs", "p_least", "p_children", "p_leaves", "p_saved", "p_ends")
    joined = cut(edges.repartition(1).sortWithinPartitions("path").mapInArrow(recombine, JOINED_DDL), "trie-edges")  # two rows a block
    values = ["n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    names = joined.filter("number IS NOT NULL").select(F.col("number").alias("parent_number"), F.col("conv_id").alias("above"))
    outer = joined.filter("number IS NOT NULL").join(names, "parent_number", "left").select("conv_id", "depth", F.col("above").alias("parent_conv_id"), *values)
    on_edge = joined.filter("numbers IS NOT NULL").select("block", F.col("side").alias("parent_side"), F.posexplode("numbers").alias("parent_depth", "parent_number"))
    on_edge = on_edge.join(names, "parent_number").select("block", "parent_side", F.col("parent_depth").cast("bigint").alias("parent_depth"), "above")
    inner = found.filter("depth IS NOT NULL")
    inner = inner.join(on_edge, ["block", "parent_side", "parent_depth"], "left").select("conv_id", "depth", F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), *values)
    return outer.unionByName(inner).withColumn("ends", F.coalesce("ends", F.lit(NO_MEMBERS))).withColumnRenamed("ends", "ends_sha256")


def conversation_trie(conversations: DataFrame, cells: int = CELLS) -> DataFrame:
    """The trie of conversations rebuilt behind their group's opening."""
    return trie(rebuilt(cut(turn_lists(conversations), "trie-turns")), cells)
