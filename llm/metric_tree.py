"""Exact largest inner products by best-first search of an M-tree."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import pick, staged, width

PIVOTS = 256  # top routing objects at most: a bounded sample that only steers locality
SUBTREE = 2048  # entries of a subtree, one row of the index
FANOUT = 256  # children of a node above the subtrees
PAGE = 64  # entries of a leaf page, about
TOGETHER = 16  # subtrees whose queries meet a node in one task
NONE = np.iinfo(np.int64).min  # in place of the k-th score, where fewer were found

LEAF = (
    "node long, root binary, radius double, uids binary, vec_ids binary, asks binary, vectors binary, "
    "bounds binary, to_page binary, routing binary, radii binary, to_root binary"
)
INNER = "node long, root binary, radius double, children binary, roots binary, radii binary, to_root binary"
FOUND = "quid long, score long, vec_id long, uid long"
ASKED = "home long, uids binary, floors binary, vectors binary, found binary"
PACKET = "node long, block long, home long, uids binary, floors binary, vectors binary, far binary"


def whole_vectors(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``uid, vec_id, v``: ``floor(256 * x)`` of each component, unusable rows left out."""
    named = pick(rows, vec_id=id_column, e=vector).filter(F.col("vec_id").isNotNull())
    finite = F.forall(
        "e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    usable = named.filter(F.col("e").isNotNull()).filter(F.coalesce(finite, F.lit(False)))
    return usable.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("e", lambda x: F.floor(x.cast("double") * 256).cast("long")).alias("v"),
    )


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of a matrix, shorter ones filled with zeros."""
    lengths = np.diff(np.asarray(column.offsets))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


class Space:
    """Inner products as distances: a last coordinate lifts all entries to one norm.

    ``|q - x'|**2 = |q|**2 + top - 2 q x`` for a query with 0 there, so the nearest entry
    has the largest product, and the triangle inequality holds.
    """

    def __init__(self, width: int, top: float, most: float):
        self.width, self.top = width, top
        self.exact = width * most * most < 2**53  # products of doubles are then exact
        self.fits = width * most * most < 2**62
        self.slack = 1e-6 + 1e-7 * np.sqrt(2 * top)  # of distances, which are rounded

    def lifted(self, v: np.ndarray) -> np.ndarray:
        x = v.astype(np.float64)
        rest = np.sqrt(np.maximum(self.top - (x * x).sum(1), 0))
        return np.column_stack([x, rest])

    def asking(self, v: np.ndarray) -> np.ndarray:
        return np.column_stack([v.astype(np.float64), np.zeros(len(v))])

    def products(self, v: np.ndarray, q: np.ndarray) -> np.ndarray:
        if self.exact:
            return (v.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
        if self.fits:
            return v @ q
        wide = [sum(map(int.__mul__, row, q.tolist())) for row in v.tolist()]
        return np.array([max(-(2**63) + 1, min(2**63 - 1, p)) for p in wide], np.int64)

    def reach(self, norm, floor):
        """How far entries with the score ``floor`` are from a query of this squared norm."""
        square = norm + self.top - 2.0 * np.asarray(floor, np.float64)
        far = np.sqrt(np.maximum(square, 0)) * (1 + 1e-9) + self.slack
        return np.where(np.asarray(floor) <= -(2**63) + 1, np.inf, far)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def away(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - point) ** 2).sum(1))


class Subtree:
    """A root and its leaf pages, with covering radii and distances to the parents."""

    def __init__(self, space: Space, vec_ids: np.ndarray, uids: np.ndarray, v: np.ndarray, asks=None):
        x = space.lifted(v)
        routing = x[::PAGE]
        d = distances(x, routing)
        near = d.argmin(1)
        order = np.lexsort((d[np.arange(len(x)), near], near))
        x, near = x[order], near[order]
        self.vec_ids, self.uids, self.v = vec_ids[order], uids[order], v[order]
        self.asks = np.zeros(len(x), bool) if asks is None else asks[order]
        # A routing object with many entries has several pages.
        first = np.flatnonzero(np.r_[True, near[1:] != near[:-1]])
        place = np.arange(len(x)) - np.repeat(first, np.diff(np.r_[first, len(x)]))
        starts = np.flatnonzero(place % (2 * PAGE) == 0)
        self.bounds = np.r_[starts, len(x)]
        self.to_page = away(x, routing[near])
        self.routing = routing[near[starts]]
        self.radii = np.maximum.reduceat(self.to_page, starts)
        self.root = x.mean(0)
        self.to_root = away(self.routing, self.root)
        self.radius = float(away(x, self.root).max())

    ARRAYS = {
        "root": "<f8", "uids": "<i8", "vec_ids": "<i8", "asks": "?", "vectors": "<i8", "bounds": "<i8",
        "to_page": "<f8", "routing": "<f8", "radii": "<f8", "to_root": "<f8",
    }

    def row(self, node: int) -> dict:
        parts = {c: self.v if c == "vectors" else getattr(self, c) for c in self.ARRAYS}
        blobs = {c: np.ascontiguousarray(a, self.ARRAYS[c]).tobytes() for c, a in parts.items()}
        return {"node": node, "radius": self.radius, **blobs}

    @classmethod
    def stored(cls, space: Space, row: dict) -> Subtree:
        tree = cls.__new__(cls)
        for c, kind in cls.ARRAYS.items():
            setattr(tree, c, np.frombuffer(row[c], kind))
        tree.radius = row["radius"]
        tree.v = tree.vectors.reshape(len(tree.uids), space.width)
        tree.routing = tree.routing.reshape(len(tree.radii), space.width + 1)
        return tree


def search(
    trees: list[Subtree], space: Space, q: np.ndarray, uid: int, k: int, floor: int = NONE
) -> list[tuple]:
    """The ``k`` best ``(score, -vec_id, uid)`` of the subtrees from ``floor`` up, nearest nodes first.

    A node is left out if its covering ball, or already the distances stored for it and
    its parent, lie beyond the k-th entry so far; ties are followed.
    """
    lifted = np.r_[q.astype(np.float64), 0.0]
    norm = float(lifted @ lifted)
    best: list[tuple] = []

    def least_score() -> int:
        return max(floor, best[0][0]) if len(best) == k else floor

    heap = []
    for i, tree in enumerate(trees):
        d = float(np.sqrt(((lifted - tree.root) ** 2).sum()))
        heap.append((max(d - tree.radius, 0.0), i, -1, d))
    heapq.heapify(heap)
    while heap:
        bound, i, page, d = heapq.heappop(heap)
        limit, tree = float(space.reach(norm, least_score())), trees[i]
        if bound > limit:
            break
        if page < 0:
            # Stored distances to the root first: no computation for pages they exclude.
            live = np.flatnonzero(np.abs(d - tree.to_root) - tree.radii <= limit)
            for p, f in zip(live.tolist(), away(tree.routing[live], lifted).tolist()):
                least = max(f - float(tree.radii[p]), 0.0)
                if least <= limit:
                    heapq.heappush(heap, (least, i, p, f))
            continue
        a, b = tree.bounds[page], tree.bounds[page + 1]
        live = a + np.flatnonzero(np.abs(d - tree.to_page[a:b]) <= limit)
        scores = space.products(tree.v[live], q)
        keep = scores >= least_score()
        live, scores = live[keep], scores[keep]
        for s, v, u in zip(scores.tolist(), tree.vec_ids[live].tolist(), tree.uids[live].tolist()):
            if u == uid:
                continue
            if len(best) < k:
                heapq.heappush(best, (s, -v, u))
            elif (s, -v) > best[0][:2]:
                heapq.heapreplace(best, (s, -v, u))
    return best


def neighbours(rows: DataFrame, near, names: list[str], parts: int, kinds: str) -> DataFrame:
    """``rows`` in ranges of their nearest pivot and the distance from it; ``near`` finds both."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivot, distance, columns = near(batch)
            found = [pa.array(pivot, pa.int32()), pa.array(distance, pa.float64()), *columns]
            yield pa.RecordBatch.from_arrays(found, ["pivot", "distance", *names])

    assigned = rows.mapInArrow(assign, f"pivot int, distance double, {kinds}")
    order = ["pivot", "distance", names[0]]
    return assigned.repartitionByRange(parts, *order).sortWithinPartitions(*order)


def cut(rows: DataFrame, size: int, node, schema: str, name: str) -> DataFrame:
    """Runs of ``size`` rows as nodes, a row each, stored with their place: partition and number."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = None, TaskContext.get().partitionId() << 32
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            while held.num_rows >= size:
                yield record(node(held.slice(0, size), at), fields)
                held, at = held.slice(size), at + 1
        if held is not None and held.num_rows:
            yield record(node(held, at), fields)

    fields = arrow(schema)
    return staged(rows.mapInArrow(runs, schema), name)


KINDS = {"long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}


def arrow(schema: str) -> pa.Schema:
    return pa.schema([(c.split()[0], KINDS[c.split()[1]]) for c in schema.split(", ")])


def record(row: dict, fields: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([row], schema=fields)


def build(rows: DataFrame, space: Space, pivots: np.ndarray, n: int) -> DataFrame:
    """The lowest nodes of the index: subtrees of neighbours, a row each, with their pages.

    Every vector goes to its nearest pivot; range partitions by pivot, distance and row
    are cut into runs, so any number of vectors near one pivot are several subtrees.
    """
    lifted = space.lifted(pivots)

    def near(batch: pa.RecordBatch) -> tuple:
        v = matrix(batch["v"], space.width)
        d = distances(space.lifted(v), lifted)
        blobs = pa.array([r.tobytes() for r in v], pa.binary())
        at = d.argmin(1)
        return at, d[np.arange(len(v)), at], [batch["uid"], batch["vec_id"], batch["asks"], blobs]

    def node(rows: pa.Table, at: int) -> dict:
        uids, ids = (rows[c].to_numpy().astype("<i8") for c in ("uid", "vec_id"))
        v = np.frombuffer(b"".join(rows["v"].to_pylist()), np.int64).reshape(len(ids), space.width)
        return Subtree(space, ids, uids, v, rows["asks"].to_numpy().astype(bool)).row(at)

    kinds = "uid long, vec_id long, asks boolean, v binary"
    parts = max(1, min(width(rows.sparkSession), n // (4 * SUBTREE)))
    ranged = neighbours(rows, near, ["uid", "vec_id", "asks", "v"], parts, kinds)
    return cut(ranged, SUBTREE, node, LEAF, "m-tree")


def above(nodes: DataFrame, space: Space, n: int) -> DataFrame:
    """The next level: nodes of at most ``FANOUT`` neighbours among the ``n`` of ``nodes``.

    A node holds its children's roots and covering radii and their distances to its own root.
    """
    balls = nodes.select("node", "root", "radius")
    some = balls.orderBy(F.xxhash64("node"), "node").limit(max(1, min(PIVOTS, n // FANOUT)))
    pivots = np.stack([np.frombuffer(r["root"], "<f8") for r in some.collect()])

    def near(batch: pa.RecordBatch) -> tuple:
        x = np.stack([np.frombuffer(b, "<f8") for b in batch["root"].to_pylist()])
        d = distances(x, pivots)
        at = d.argmin(1)
        return at, d[np.arange(len(x)), at], [batch["node"], batch["root"], batch["radius"]]

    def node(rows: pa.Table, at: int) -> dict:
        x = np.stack([np.frombuffer(b, "<f8") for b in rows["root"].to_pylist()])
        radii, root = rows["radius"].to_numpy(), x.mean(0)
        to_root = away(x, root)
        blobs = {"children": rows["node"].to_numpy().astype("<i8"), "roots": x, "radii": radii, "to_root": to_root}
        blobs = {c: np.ascontiguousarray(a).tobytes() for c, a in blobs.items()}
        return {"node": at, "root": root.tobytes(), "radius": float((to_root + radii).max()), **blobs}

    parts = max(1, min(width(nodes.sparkSession), n // (4 * FANOUT)))
    ranged = neighbours(balls, near, ["node", "root", "radius"], parts, "node long, root binary, radius double")
    return cut(ranged, FANOUT, node, INNER, "m-tree-level")


class Packet:
    """Queries of one subtree on their way down: ids, k-th scores, vectors, distances to the node."""

    def __init__(self, space: Space, row: dict):
        self.space, self.home = space, row["home"]
        self.uids, self.floors = (np.frombuffer(row[c], "<i8") for c in ("uids", "floors"))
        self.v = np.frombuffer(row["vectors"], "<i8").reshape(len(self.uids), space.width)
        self.far = np.frombuffer(row["far"], "<f8") if row.get("far") is not None else None
        self.x = space.asking(self.v)
        self.reach = space.reach((self.x**2).sum(1), self.floors)

    def onwards(self, block: int, children, roots, radii, to_root=None, lowest: bool = True) -> list[dict]:
        """Packets for the children whose balls hold entries of the k-th score or above.

        Distances stored for child and parent decide first, without a computation. The
        subtree the queries come from has been searched and is left out.
        """
        out = []
        for j, child in enumerate(children.tolist()):
            if lowest and child == self.home:
                continue
            if to_root is None:
                live = np.arange(len(self.uids))
            else:
                live = np.flatnonzero(np.abs(self.far - to_root[j]) - radii[j] <= self.reach)
            far = away(self.x[live], roots[j])
            meet = far - radii[j] <= self.reach[live]
            live, far = live[meet], far[meet]
            if len(live):
                parts = {"uids": self.uids, "floors": self.floors, "vectors": self.v}
                blobs = {c: a[live].tobytes() for c, a in parts.items()}
                out.append({"node": child, "block": block, "home": self.home, "far": far.tobytes(), **blobs})
        return out


def found_rows(quids: list[int], found: list[list[tuple]]) -> dict:
    flat = [(u, s, -v, c) for u, best in zip(quids, found) for s, v, c in best]
    columns = list(zip(*flat)) or [[]] * 4
    return {c.split()[0]: pa.array(x, pa.int64()) for c, x in zip(FOUND.split(", "), columns)}


def at_home(tree: DataFrame, space: Space, k: int) -> DataFrame:
    """The queries of each subtree, searched in it: what they found, and the k-th score as a bound."""
    fields = arrow(ASKED)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                sub = Subtree.stored(space, row)
                asking = np.flatnonzero(sub.asks)
                if not len(asking):
                    continue
                found = [search([sub], space, sub.v[a], -1, k) for a in asking]
                floors = [best[0][0] if len(best) == k else NONE for best in found]
                table = found_rows(sub.uids[asking].tolist(), found)
                columns = np.stack([c.to_numpy() for c in table.values()])
                yield record(
                    {
                        "home": row["node"],
                        "uids": sub.uids[asking].tobytes(),
                        "floors": np.array(floors, "<i8").tobytes(),
                        "vectors": sub.v[asking].tobytes(),
                        "found": columns.astype("<i8").tobytes(),
                    },
                    fields,
                )

    return staged(tree.mapInArrow(ask, ASKED), "m-tree-home")


def meeting(nodes: DataFrame, packets: DataFrame, meet, schema: str) -> DataFrame:
    """Each node with the packets for it, a block of queries a task; other nodes stay unread."""
    pairs = packets.select(F.col("node").alias("node"), F.col("block").alias("block")).distinct()
    sides = nodes.join(pairs, "node").groupBy("node", "block"), packets.groupBy("node", "block")
    return sides[0].cogroup(sides[1]).applyInArrow(meet, schema)


def through(space: Space, lowest: bool):
    """The step from the nodes of a level to those of their children that the queries must see."""
    fields = arrow(PACKET)

    def inner(nodes: pa.Table, packets: pa.Table) -> pa.Table:
        out = []
        for row in nodes.to_pylist():
            ids = np.frombuffer(row["children"], "<i8")
            x = np.frombuffer(row["roots"], "<f8").reshape(len(ids), space.width + 1)
            stored = [np.frombuffer(row[c], "<f8") for c in ("radii", "to_root")]
            for packet in packets.to_pylist():
                out += Packet(space, packet).onwards(packet["block"], ids, x, *stored, lowest)
        return pa.Table.from_pylist(out, schema=fields)

    return inner


def descend(tree: DataFrame, space: Space, asked: DataFrame, k: int) -> DataFrame:
    """What the queries find outside their own subtrees.

    Levels are added until at most ``FANOUT`` nodes are on top; their balls go with the tasks.
    From there queries go down to every node whose ball meets their bound, and to no other.
    """
    levels = [tree]
    places = F.expr("count(DISTINCT shiftright(node, 32))")
    n, parts = tree.agg(F.count("node"), places).first()
    merged, size = max(1, TOGETHER * parts // max(n, 1)), n
    while size > FANOUT:
        levels.append(above(levels[-1], space, size))
        size = levels[-1].count()
    top = levels[-1].select("node", "root", "radius").collect()
    children = np.array([r["node"] for r in top], np.int64)
    roots = np.array([np.frombuffer(r["root"], "<f8") for r in top]).reshape(len(top), space.width + 1)
    radii, direct = np.array([r["radius"] for r in top]), len(levels) == 1
    fields = arrow(PACKET)

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                home = row["home"]
                block = ((home >> 32) // merged << 32) | ((home & 0xFFFFFFFF) // TOGETHER)
                found = Packet(space, row).onwards(block, children, roots, radii, lowest=direct)
                for packet in found:
                    yield record(packet, fields)

    asking = asked.select("home", "uids", "floors", "vectors")
    packets = staged(asking.mapInArrow(start, PACKET), "m-tree-down")
    for depth in range(len(levels) - 1, 0, -1):
        packets = staged(meeting(levels[depth], packets, through(space, depth == 1), PACKET), "m-tree-down")

    def leaf(nodes: pa.Table, packets: pa.Table) -> pa.Table:
        quids, found = [], []
        for row in nodes.to_pylist():
            sub = Subtree.stored(space, row)
            for packet in (Packet(space, p) for p in packets.to_pylist()):
                quids += packet.uids.tolist()
                found += [
                    search([sub], space, q, -1, k, f) for q, f in zip(packet.v, packet.floors.tolist())
                ]
        return pa.table(found_rows(quids, found))

    return meeting(tree, packets, leaf, FOUND)


def top_products(rows: DataFrame, is_query, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest products of each query.

    ``rows`` is ``uid, vec_id, v``; ``is_query`` a condition on it, NULL counts as no.
    Each different vector that is asked for is searched once, first in its own subtree; the
    k-th score there is the bound for the way down from the top, which leads to the
    nodes that can hold more only. Of equal vectors the ``k + 1`` smallest ids are
    enough for every query, so a vector with any number of copies is few entries.

    Rows that share a ``vec_id`` are queries and candidates of their own; equal scores go by
    ``vec_id``, then by row; vectors of different lengths are compared as if filled with zeros;
    fewer than ``k`` candidates give fewer rows, an empty table none. Scores beyond a long are
    its limits. Vectors of any length are taken, a subtree of 2048 of them in one task.
    """
    rows = staged(rows.select("uid", "vec_id", "v"), "vectors")
    queries = rows.filter(F.coalesce(is_query, F.lit(False)))
    first = Window.partitionBy("v").orderBy("vec_id", "uid")
    few = rows.withColumn("copy", F.row_number().over(first)).filter(F.col("copy") <= k + 1)
    asked = queries.select("v").distinct().withColumn("asks", F.lit(True))
    wanted = F.coalesce(F.col("asks") & (F.col("copy") == 1), F.lit(False)).alias("asks")
    entries = staged(few.join(asked, "v", "left").select("uid", "vec_id", wanted, "v"), "entries")

    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    largest = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    n, wide, top, most = entries.agg(
        F.count("uid"), F.max(F.size("v")), F.max(square), F.max(largest)
    ).first()
    space = Space(wide or 0, top or 0.0, most or 0.0)
    pivots = entries.orderBy(F.xxhash64("uid"), "uid").limit(max(1, min(PIVOTS, n // SUBTREE)))
    pivots = [r["v"] for r in pivots.select("v").collect()]
    at = np.zeros((max(len(pivots), 1), space.width), np.int64)
    for row, v in zip(at, pivots):
        row[: len(v)] = v
    tree = build(entries, space, np.unique(at, axis=0), n)
    home = at_home(tree, space, k + 1)

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in batch["found"].to_pylist():
                columns = np.frombuffer(found, "<i8").reshape(4, -1)
                names = [c.split()[0] for c in FOUND.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    found = home.select("found").mapInArrow(unpacked, FOUND).union(descend(tree, space, home, k + 1))
    best = Window.partitionBy("quid").orderBy(F.desc("score"), "vec_id", "uid")
    ranked = found.withColumn("at", F.row_number().over(best)).filter(F.col("at") <= k + 1)
    answer = F.struct("at", "score", "vec_id", "uid")
    answers = ranked.groupBy("quid").agg(F.array_sort(F.collect_list(answer)).alias("answers"))
    # Each query takes its vector's answers, but for itself.
    answered = entries.filter("asks").select(F.col("uid").alias("quid"), "v").join(answers, "quid")
    each = queries.join(answered.select("v", "answers"), "v").select(
        F.col("vec_id").alias("query_id"),
        F.expr(f"slice(filter(answers, a -> a.uid <> uid), 1, {int(k)})").alias("answers"),
    )
    return each.select("query_id", F.posexplode("answers").alias("rank", "a")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), "a.vec_id", "a.score"
    )


def op8_metric_tree(spark, sf_dir: str) -> DataFrame:
    rows = whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_products(rows, F.col("vec_id") % 50 == 0)


ORACLE = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
        SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
               CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
    r AS (
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
                              AS INTEGER) AS rank, vec_id, score
        FROM s)
    SELECT * FROM r WHERE rank <= 5
"""
