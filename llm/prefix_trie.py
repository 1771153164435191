"""Trie of conversations that begin alike, as balanced parentheses in shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import pick, staged, width
from llm.periodic_runs import crc32_sql

HEADS = 9  # a conversation takes over fewer turns than this
FAMILY = 5  # conversations that share a head
TURN = 16  # bytes that stand for a turn
BLOCK = 64  # parentheses of a block
NOTHING = hashlib.sha256(b"").hexdigest()


class Trie:
    """The trie of sorted rows of turns, as balanced parentheses.

    ``flat`` holds the turns of all rows, one after the other, as pairs of numbers, ``size``
    the turns of each row. A row that another one continues stands before it, equal rows
    stand side by side. Node 0 is the root; nodes are numbered as their parentheses open.
    """

    def __init__(self, flat: np.ndarray, size: np.ndarray):
        rows = len(size)
        start = np.cumsum(size) - size
        shared = np.zeros(rows, np.int64)  # turns that a row shares with the one before
        if rows > 1:
            both = np.minimum(size[1:], size[:-1])
            first = np.cumsum(both) - both
            step = np.arange(both.sum()) - np.repeat(first, both)
            one, two = np.repeat(start[1:], both) + step, np.repeat(start[:-1], both) + step
            other = np.flatnonzero((flat[one] != flat[two]).any(1))
            pair = np.repeat(np.arange(rows - 1), both)[other]
            shared[1:] = both
            at, i = np.unique(pair, return_index=True)
            shared[1 + at] = step[other[i]]
        self.shared, self.size, self.start = shared, size, start
        opened = size - shared
        closed = np.r_[0, size[:-1] - shared[1:]]
        # The root, then for each row what closes and what opens; at last all that is open.
        turns = np.stack([closed, opened], 1).reshape(-1)
        turns = np.r_[0, 1, turns, (size[-1] if rows else 0) + 1]
        self.open = np.repeat(np.arange(len(turns)) % 2 == 1, turns)
        row_of = np.repeat(np.r_[0, 0, np.repeat(np.arange(rows), 2), rows], turns)
        self.excess = np.cumsum(np.where(self.open, 1, -1))
        self.at = np.flatnonzero(self.open)
        self.depth = self.excess[self.at] - 1
        self.nodes = len(self.at)
        self.first = row_of[self.at]  # the first row of each node's subtree
        self.ends = np.cumsum(opened)  # the node where each row ends
        close = self.find_close(self.at)
        self.last = row_of[close]  # one more than the last row: what closes stands before the next one
        rank = np.cumsum(self.open)
        self.below = rank[close]  # one more than the last node of the subtree
        self.leaf = ~self.open[self.at + 1]  # a pair that closes at once
        self.turn = self.start[self.first] + self.depth - 1  # place in ``flat`` of the last turn

    def find_close(self, place: np.ndarray) -> np.ndarray:
        """Where the parentheses that open at ``place`` close.

        That is the first later place with a lower excess. A tree of the least excess of
        blocks, pairs of blocks, and so on finds its block: up to the first later part that
        goes low enough, then down in it; the block itself is read through.
        """
        n = len(self.excess)
        blocks = -(-n // BLOCK)
        padded = np.full(blocks * BLOCK, -1)
        padded[:n] = self.excess
        by_block = padded.reshape(blocks, BLOCK)
        wanted = self.excess[place] - 1
        found = np.full(len(place), -1)

        def read(who: np.ndarray, block: np.ndarray, after: np.ndarray) -> None:
            for step in range(0, len(who), 1 << 14):  # bounded memory
                w, b = who[step : step + (1 << 14)], block[step : step + (1 << 14)]
                low = by_block[b] <= wanted[w][:, None]
                low &= np.arange(BLOCK) > after[step : step + (1 << 14)][:, None]
                there = low.any(1)
                found[w[there]] = b[there] * BLOCK + low[there].argmax(1)

        read(np.arange(len(place)), place // BLOCK, place % BLOCK)
        levels = [by_block.min(1)]
        while len(levels[-1]) > 1:
            level = levels[-1]
            level = np.r_[level, np.iinfo(np.int64).max] if len(level) % 2 else level
            levels.append(level.reshape(-1, 2).min(1))
        open_ones = np.flatnonzero(found < 0)
        part, height = place[open_ones] // BLOCK, np.zeros(len(open_ones), np.int64)
        rising = np.ones(len(open_ones), bool)
        for h in range(len(levels)):  # up: to the right sibling, if it goes low enough
            here = rising & (part % 2 == 0) & (part + 1 < len(levels[h]))
            low = np.zeros(len(part), bool)
            low[here] = levels[h][part[here] + 1] <= wanted[open_ones[here]]
            part = np.where(low, part + 1, np.where(rising, part // 2, part))
            height = np.where(low, h, height)
            rising &= ~low
        for h in range(len(levels) - 1, 0, -1):  # down: to the left half, if it does
            here = np.flatnonzero(height == h)
            left = 2 * part[here]
            part[here] = np.where(levels[h - 1][left] <= wanted[open_ones[here]], left, left + 1)
            height[here] = h - 1
        read(open_ones, part, np.full(len(open_ones), -1))
        return found

    def parents(self) -> np.ndarray:
        """The node above each: the last one before it that is one less deep."""
        order = np.argsort(self.depth, kind="stable")
        key = self.depth[order] * self.nodes + order
        return order[np.searchsorted(key, (self.depth - 1) * self.nodes + np.arange(self.nodes)) - 1]

    def under(self, value: np.ndarray) -> np.ndarray:
        """The sum of ``value`` over each node's subtree, from one cumulative array."""
        total = np.r_[0, np.cumsum(value)]
        return total[self.below] - total[np.arange(self.nodes)]

    def least(self, value: np.ndarray) -> np.ndarray:
        """The least ``value`` of the rows in each node's subtree, by a table of power-of-two spans."""
        out = np.zeros(self.nodes, np.int64)
        span, table = self.last - self.first, value
        for h in range(int(span.max()).bit_length()):
            here = np.flatnonzero(span >> h == 1)
            out[here] = np.minimum(table[self.first[here]], table[self.last[here] - (1 << h)])
            table = np.minimum(table[: -(1 << h)], table[1 << h :]) if len(table) > 1 << h else table
        return out

    def path(self, row: int) -> np.ndarray:
        """The nodes from the root to the end of the first or the last row."""
        if row == 0:
            return np.arange(self.size[0] + 1)
        deepest = np.zeros(int(self.depth.max()) + 1, np.int64)
        deepest[self.depth] = np.arange(self.nodes)  # the last one of each depth stays
        return deepest[: self.size[row] + 1]


class Shard(NamedTuple):
    """Conversations sorted by their turns, then by id; turns as hashes and sizes, row after row."""

    conv_id: np.ndarray
    turns: np.ndarray
    size: np.ndarray
    n_bytes: np.ndarray


def read(table: pa.Table) -> Shard:
    sizes = table["sizes"].combine_chunks()
    return Shard(
        table["conv_id"].to_numpy(),
        turns_of(table["path"].to_pylist()),
        np.diff(sizes.offsets.to_numpy()).astype(np.int64),
        sizes.flatten().to_numpy(),
    )


def turns_of(paths: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(paths), "<u8").reshape(-1, 2)


PARTS = (
    "kind string, shard int, name binary, conv_id long, depth long, parent_conv_id long, parent binary,"
    " n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ids string,"
    " path binary, least array<long>, convs array<long>, children array<long>, leaves array<long>,"
    " saved array<long>, n_bytes array<long>"
)
KINDS = {
    "string": pa.string(),
    "int": pa.int32(),
    "long": pa.int64(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
}


def batch_of(schema: str, n: int, **columns) -> pa.RecordBatch:
    """``n`` rows of ``schema``; columns that aren't given are null."""
    fields = [part.split() for part in schema.split(",")]
    arrays = [
        pa.array(columns[name], KINDS[kind]) if name in columns else pa.nulls(n, KINDS[kind])
        for name, kind in fields
    ]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def build(shard: Shard, number: int) -> Iterator[pa.RecordBatch]:
    """The parts of one shard.

    ``node``: the finished nodes. ``spine``: the paths of the first and the last row, whose
    nodes other shards may share, with what the shard alone knows of them: members, the least
    one, and children, leaves and savings without those on the spines. ``ends``: the rows that
    end at such a node.
    """
    trie = Trie(shard.turns, shard.size)
    least, parent = trie.least(shard.conv_id), trie.parents()
    convs = trie.last - trie.first
    n_bytes = np.r_[0, shard.n_bytes[trie.turn[1:]]].astype(np.int64)
    paths = [trie.path(0), trie.path(len(shard.size) - 1)]
    spine = np.zeros(trie.nodes, bool)
    spine[np.concatenate(paths)] = True
    children = np.bincount(parent[1:][~spine[1:]], minlength=trie.nodes)
    leaves = trie.under(trie.leaf & ~spine)
    saved = trie.under(np.where(spine, 0, (convs - 1) * n_bytes))

    names: dict[int, bytes] = {}
    for row, path in zip((0, len(shard.size) - 1), paths):
        start, chain = trie.start[row], hashlib.sha256()
        names[0] = chain.digest()[:TURN]
        for depth, node in enumerate(path[1:].tolist()):
            chain.update(shard.turns[start + depth].tobytes())
            names[node] = chain.copy().digest()[:TURN]

    ended, first = np.unique(trie.ends, return_index=True)
    ids = [",".join(map(str, part.tolist())) for part in np.split(shard.conv_id, first[1:])]
    hashes = np.full(trie.nodes, NOTHING, object)
    shared = []
    for node, text in zip(ended.tolist(), ids):
        if spine[node]:
            shared.append((names[node], text))
        else:
            hashes[node] = hashlib.sha256(text.encode()).hexdigest()
    yield batch_of(
        PARTS, len(shared), kind=["ends"] * len(shared), shard=[number] * len(shared),
        name=[n for n, _ in shared], ids=[t for _, t in shared],
    )

    known: set[int] = set()
    for row, path in zip((0, len(shard.size) - 1), paths):
        new = np.array([node not in known for node in path.tolist()])
        if not new.any():
            continue
        known.update(path.tolist())
        start = trie.start[row]
        yield batch_of(
            PARTS, 1, kind=["spine"], shard=[number],
            path=[shard.turns[start : start + shard.size[row]].tobytes()],
            least=[np.where(new, least[path], np.iinfo(np.int64).max)],
            n_bytes=[n_bytes[path]],
            **{c: [np.where(new, v[path], 0)] for c, v in (("convs", convs), ("children", children), ("leaves", leaves), ("saved", saved))},
        )

    for at in range(0, trie.nodes, 1 << 16):
        node = np.arange(at, min(at + (1 << 16), trie.nodes))
        node = node[~spine[node]]
        above = parent[node]
        below_spine = spine[above]
        yield batch_of(
            PARTS, len(node), kind=["node"] * len(node), conv_id=least[node], depth=trie.depth[node],
            parent_conv_id=pa.array(least[above], mask=below_spine),
            parent=[names[a] if s else None for a, s in zip(above.tolist(), below_spine.tolist())],
            n_convs=convs[node], n_children=children[node], n_leaves=leaves[node],
            saved_tokens=saved[node], ends_sha256=hashes[node].tolist(),
        )


MERGED = (
    "name binary, conv_id long, depth long, parent_conv_id long,"
    " n_convs long, n_children long, n_leaves long, saved_tokens long"
)


def merge(table: pa.Table) -> pa.RecordBatch:
    """The nodes on the spines of all shards, from the trie of the spines themselves."""
    table = table.take(pa.array(sorted(range(table.num_rows), key=table["path"].to_pylist().__getitem__)))
    turns = turns_of(table["path"].to_pylist())
    size = np.array([len(p) // TURN for p in table["path"].to_pylist()], np.int64)
    trie = Trie(turns, size)
    least = np.full(trie.nodes, np.iinfo(np.int64).max)
    n_bytes, convs, children, leaves, saved = (np.zeros(trie.nodes, np.int64) for _ in range(5))
    at, names = np.zeros(int(size.max()) + 1, np.int64), [hashlib.sha256()]
    chain = [hashlib.sha256()]
    for row in range(len(size)):
        shared, n = int(trie.shared[row]), int(size[row])
        at[shared + 1 : n + 1] = np.arange(trie.ends[row] - (n - shared), trie.ends[row]) + 1
        del chain[shared + 1 :]
        for depth in range(shared, n):
            chain.append(chain[depth].copy())
            chain[-1].update(turns[trie.start[row] + depth].tobytes())
            names.append(chain[-1])
        path, part = at[: n + 1], {c: table[c][row].values.to_numpy() for c in ("least", "n_bytes", "convs", "children", "leaves", "saved")}
        least[path] = np.minimum(least[path], part["least"])
        n_bytes[path] = part["n_bytes"]
        for total, c in ((convs, "convs"), (children, "children"), (leaves, "leaves"), (saved, "saved")):
            total[path] += part[c]
    parent = trie.parents()
    children += np.bincount(parent[1:], minlength=trie.nodes)
    leaves += trie.under(children == 0)
    saved += trie.under((convs - 1) * n_bytes)
    above = pa.array(least[parent], mask=np.arange(trie.nodes) == 0)
    return batch_of(
        MERGED, trie.nodes, name=[h.digest()[:TURN] for h in names], conv_id=least, depth=trie.depth,
        parent_conv_id=above, n_convs=convs, n_children=children, n_leaves=leaves, saved_tokens=saved,
    )


def sequences(conversations: DataFrame, rebuilt: bool) -> DataFrame:
    """``conv_id, path, sizes``: each conversation's turns as joined hashes and UTF-8 bytes.

    A turn is hashed before it is shuffled. Conversations of one family are in one
    task, so that each finds the family's first one without a join.
    """
    rows = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    hashed = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = rows.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(hashed, 1, 2 * TURN)).alias("hash"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    own = (
        turns.withColumn("family", family)
        .repartition("family")
        .groupBy("family", "conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("turn", "hash", "bytes"))).alias("own"))
    )
    if rebuilt:
        eldest = F.max(F.when(F.col("conv_id") == F.col("family"), F.slice("own", 1, HEADS)))
        own = own.withColumn("head", eldest.over(Window.partitionBy("family")))
        h = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
        head = F.when(F.col("head").isNull(), F.slice("own", 1, 0)).otherwise(F.slice("head", F.lit(1), h))
        own = own.withColumn("own", F.concat(head, F.slice("own", h + 1, F.size("own"))))
    hexed = F.array_join(F.transform("own", lambda t: F.hex(t["hash"])), "")
    return own.select(
        "conv_id", F.unhex(hexed).alias("path"), F.transform("own", lambda t: t["bytes"]).alias("sizes")
    )


def prefix_trie(conversations: DataFrame, rebuilt: bool = False) -> DataFrame:
    """A row for each node of the trie of ``conversations``: what of them is the same from the start.

    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``;
    ``rebuilt`` first gives each conversation the first turns of its family's first one.
    Turns go by ``turn``, nulls first, ties by hash; a null role or text is empty; turns are
    equal if 128 bits of a hash of role and text are. Rows without ``conv_id`` belong to no
    conversation; repeated rows are turns of their own; an empty table has no node, not even a
    root. A turn of any length is a hash and a number; the turns of one conversation, 24
    bytes each, are in one row.

    Conversations are sorted by their turns and cut into ranges, equal ones by id, so
    that no group is too large for a shard. A shard writes its trie as balanced parentheses.
    Nodes that reach over a shard's ends lie on the paths of its first or last row. These
    spines, two paths a shard, are merged by a trie of their own in one small task; the ids
    of conversations that end there are hashed shard by shard.
    """
    rows = sequences(conversations, rebuilt)
    n = width(conversations.sparkSession)
    ranged = rows.repartitionByRange(n, "path", "conv_id").sortWithinPartitions("path", "conv_id")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if found:
            yield from build(read(pa.Table.from_batches(found)), TaskContext.get().partitionId())

    def spines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if found:
            yield merge(pa.Table.from_batches(found))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sha = None, None
        for batch in batches:
            for name, ids in zip(batch["name"].to_pylist(), batch["ids"].to_pylist()):
                if name != at:
                    if sha:
                        yield batch_of(ENDS, 1, _name=[at], ends_sha256=[sha.hexdigest()])
                    at, sha = name, hashlib.sha256(ids.encode())
                else:
                    sha.update(f",{ids}".encode())
        if sha:
            yield batch_of(ENDS, 1, _name=[at], ends_sha256=[sha.hexdigest()])

    parts = staged(ranged.mapInArrow(shards, PARTS), "trie-parts")
    spine = parts.filter("kind = 'spine'").select("path", "least", "convs", "children", "leaves", "saved", "n_bytes")
    spine = staged(spine.repartition(1).mapInArrow(spines, MERGED), "trie-spines")
    ends = parts.filter("kind = 'ends'").select("name", "shard", "ids")
    ends = ends.repartition("name").sortWithinPartitions("name", "shard").mapInArrow(joined, ENDS)
    above = spine.select(F.col("name").alias("_name"), F.col("conv_id").alias("_above"))
    nodes = parts.filter("kind = 'node'").join(above, F.col("parent") == F.col("_name"), "left")
    nodes = nodes.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above")).select(*COLUMNS)
    shared = spine.join(ends, F.col("name") == F.col("_name"), "left")
    shared = shared.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))).select(*COLUMNS)
    return nodes.unionByName(shared)


ENDS = "_name binary, ends_sha256 string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), rebuilt=True)


ORACLE = f"""
    WITH originals AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i,
               md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m,
               strlen(coalesce(text, '')) AS b
        FROM conversations WHERE conv_id IS NOT NULL
    ), ids AS (
        SELECT DISTINCT conv_id AS c, {crc32_sql("CAST(conv_id AS VARCHAR)")} % {HEADS} AS h FROM originals
    ), rebuilt AS (
        SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, i) AS d, m, b FROM (
            SELECT c, 0 AS own, i, m, b FROM ids JOIN originals ON conv_id = c - c % {FAMILY} AND i <= h
            UNION ALL SELECT c, 1, i, m, b FROM ids JOIN originals ON conv_id = c AND i > h)
    ), members AS (
        SELECT c, d, string_agg(m, '') OVER (PARTITION BY c ORDER BY d) AS path, b FROM rebuilt
        UNION ALL SELECT c, 0, '', 0 FROM ids
    ), whole AS (
        SELECT *, max(d) OVER (PARTITION BY c) AS most FROM members
    ), nodes AS (
        SELECT d, path, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(b) AS own,
               coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = most), '') AS ends
        FROM whole GROUP BY d, path
    ), children AS (
        SELECT d - 1 AS d, left(path, {32} * (d - 1)) AS path, count(*) AS n_children
        FROM nodes WHERE d > 0 GROUP BY ALL
    ), counted AS (
        SELECT *, coalesce(n_children, 0) AS n FROM nodes LEFT JOIN children USING (d, path)
    ), above AS (
        SELECT k AS d, left(path, {32} * k) AS path, sum(own) AS saved, count(*) FILTER (WHERE n = 0) AS leaves
        FROM (SELECT *, unnest(range(d + 1)) AS k FROM counted) GROUP BY ALL
    )
    SELECT x.conv_id, x.d AS depth, p.conv_id AS parent_conv_id, x.n_convs, x.n AS n_children,
           leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256
    FROM counted x JOIN above USING (d, path)
         LEFT JOIN nodes p ON p.d = x.d - 1 AND p.path = left(x.path, {32} * (x.d - 1)) AND x.d > 0
"""
