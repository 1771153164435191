"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import pick, prefix_sums, staged

WORDS = 5  # of a shingle
LEAST = 0.8  # weighted Jaccard similarity of near duplicates
BANDS, ROWS = 16, 4
HASHES = BANDS * ROWS
TABLE = 1 << 18  # counters of the hashed document frequencies
SLICES = 64  # of the counters, summed apart
DAMPING = 0.25
DRAWS = 1 << 13  # rows of random numbers that shingles share
ROUGH = 0.6  # estimate that a pair needs to be verified; misses 1 in 7,800 at LEAST, the bands 1 in 4,600
BLOCK = 2048  # rows of a block of bucket members
FORESTS = 4  # of each tile, without a common edge, whose pairs are verified before all others
CHUNK = 1 << 20  # bytes of text that meet those of another chunk in one task
LIGHT = 512  # bytes that a text counts at least
PAIRS = 1 << 14  # of a list

_random = np.random.default_rng(6)
_gamma_r = _random.gamma(2, 1, (DRAWS, HASHES)).astype(np.float32)
_log_c = np.log(_random.gamma(2, 1, (DRAWS, HASHES))).astype(np.float32)
_beta = _random.uniform(0, 1, (DRAWS, HASHES)).astype(np.float32)
_powers = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15 | 1, np.uint64))
_factors = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words of ``text``, in lower case, parted by ASCII white space."""
    b = np.frombuffer(text.lower().encode(), np.uint8)
    letter = ~((b == 32) | ((b >= 9) & (b <= 13)))
    edge = np.diff(letter.view(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    at = np.flatnonzero(letter)
    place = at - np.repeat(starts, lengths)
    # Beyond the table of powers, the turn is a further factor.
    turn = (place >> 12).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    value = (b[at].astype(np.uint64) + np.uint64(1)) * _powers[place & 4095] * turn
    first = np.r_[0, np.cumsum(lengths)[:-1]]
    return mixed(np.add.reduceat(value, first) + lengths.astype(np.uint64))


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the different shingles of ``text`` and how often each occurs.

    A text of fewer than ``WORDS`` words is one shingle, a text without words has none.
    """
    w = word_hashes(text)
    if not len(w):
        return w, np.zeros(0, np.int64)
    n = max(len(w) - WORDS + 1, 1)
    total = np.zeros(n, np.uint64)
    for i in range(min(WORDS, len(w))):
        total += w[i : i + n] * _factors[i]
    return np.unique(mixed(total), return_counts=True)


class Weights:
    """TF-IDF: occurrences times an IDF damped to between 1 and 1 + ``DAMPING``.

    Document frequencies are counted for all shingles of all documents, in ``TABLE``
    counters by hash: a shingle's frequency is at most overstated by the rare ones that
    share its counter. The IDF is damped because in a group of thousands of near copies
    the shared passages are frequent and every copy's own edits rare; undamped, edits
    would weigh up to ten times as much and part true copies.
    """

    def __init__(self, frequencies: np.ndarray, documents: int):
        most = np.log(documents + 2.0)
        rare = 1 - np.log(np.clip(frequencies, 0, documents) + 1.0) / most
        self.idf = (1 + DAMPING * rare).astype(np.float32)

    def of(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.idf[hashes >> np.uint64(64 - TABLE.bit_length() + 1)] * counts.astype(np.float32)


def signature(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``HASHES`` improved consistent weighted samples (shingle, quantised weight), hashed.

    The random numbers of a shingle are a row of fixed tables chosen by its hash; among
    shingles of equal value the smallest hash wins, in every document alike.
    """
    least = np.full(HASHES, np.inf, np.float32)
    taken = np.zeros(HASHES, np.uint64)
    for at in range(0, len(hashes), 1 << 14):
        h = hashes[at : at + (1 << 14)]
        row = (h & np.uint64(DRAWS - 1)).astype(np.int64)
        log_w = np.log(weights[at : at + (1 << 14)])[:, None]
        r, beta = _gamma_r[row], _beta[row]
        t = np.floor(log_w / r + beta)
        log_a = _log_c[row] - r * (t - beta + 1)
        win = log_a.argmin(0)
        column = np.arange(HASHES)
        better = log_a[win, column] < least
        step = t[win, column].astype(np.int64).astype(np.uint64)
        least = np.where(better, log_a[win, column], least)
        taken = np.where(better, mixed(h[win] + step * np.uint64(0x9E3779B97F4A7C15)), taken)
    return taken


def similarity(a: tuple, b: tuple, weights: Weights) -> float:
    """Weighted Jaccard similarity of two texts' shingles."""
    (ha, ca), (hb, cb) = a, b
    wa, wb = weights.of(ha, ca).astype(float), weights.of(hb, cb).astype(float)
    _, i, j = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    shared = np.minimum(wa[i], wb[j]).sum()
    union = wa.sum() + wb.sum() - shared
    return shared / union if union else 0.0


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """The hashed counters, a table of fixed size, and the number of documents."""
    shift = np.uint64(64 - TABLE.bit_length() + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, n = np.zeros(TABLE, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                hashes = shingles(text.as_py())[0]
                n += 1
                np.add.at(counters, (hashes >> shift).astype(np.int64), 1)
        parts = counters.astype("<u4").reshape(SLICES, -1)
        yield from summed(range(SLICES), parts, [n] + [0] * (SLICES - 1))

    def summed(names, parts, n) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(names), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary()), pa.array(n, pa.int64())],
            ["slice", "counts", "n"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        n: dict[int, int] = {}
        for batch in batches:  # one at a time, however many tasks have counted
            for name, part, more in zip(*(batch[c].to_pylist() for c in ("slice", "counts", "n"))):
                part = np.frombuffer(part, np.dtype("<u4" if len(part) == 4 * TABLE // SLICES else "<i8"))
                totals[name] = totals.get(name, 0) + part.astype(np.int64)
                n[name] = n.get(name, 0) + more
        if totals:
            yield from summed(totals, [t.astype("<i8") for t in totals.values()], list(n.values()))

    schema = "slice int, counts binary, n long"
    partial = docs.select("text").mapInArrow(count, schema)
    rows = partial.repartition("slice").mapInArrow(add, schema).collect()
    table = np.zeros((SLICES, TABLE // SLICES), np.int64)
    for r in rows:
        table[r["slice"]] = np.frombuffer(r["counts"], "<i8")
    return table.reshape(-1), sum(r["n"] for r in rows)


def signed(docs: DataFrame, weights) -> DataFrame:
    """``doc_id, sha, keys, sketch``: the band keys and a byte of each sample."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in batches:
            keys, sketches = [], []
            for text in batch["text"]:
                hashes, counts = shingles(text.as_py())
                if len(hashes):
                    s = signature(hashes, w.of(hashes, counts))
                    rows = s.reshape(BANDS, ROWS)
                    keys.append(mixed((rows * _factors[:ROWS]).sum(1, dtype=np.uint64)).view(np.int64).tolist())
                    sketches.append((s & np.uint64(255)).astype(np.uint8).tobytes())
                else:
                    keys.append([])
                    sketches.append(b"")
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["sha"], pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                ["doc_id", "sha", "keys", "sketch"],
            )

    return docs.mapInArrow(sign, "doc_id long, sha string, keys array<long>, sketch binary")


def central(members: DataFrame) -> DataFrame:
    """``band, key, pivot``: of each bucket the node that agrees most with the majority.

    Near copies stray from their original in different places, so the majority value of
    each sample is the original's. Buckets lie sorted in range partitions; a hot one is
    several parts, each of at most ``BLOCK`` rows, whose best nodes are compared after.
    """

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(table: pa.Table) -> pa.RecordBatch:
            band, key = table["band"].to_numpy(), table["key"].to_numpy()
            node = table["node"].to_numpy()
            sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, HASHES)
            starts = np.flatnonzero(np.r_[True, (band[1:] != band[:-1]) | (key[1:] != key[:-1])])
            out = []
            for a, b in zip(starts, np.r_[starts[1:], len(node)]):
                s = sketch[a:b]
                if b - a > 2:
                    votes = np.zeros((HASHES, 256), np.int32)
                    np.add.at(votes, (np.arange(HASHES), s), 1)
                    agree = (s == votes.argmax(1).astype(np.uint8)).sum(1)
                    i = int(np.lexsort((node[a:b], -agree))[0])
                    out.append((band[a], key[a], int(agree[i]), node[a + i]))
                else:
                    out.append((band[a], key[a], HASHES, node[a]))
            columns = [pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.int64(), pa.int32(), pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, ["band", "key", "agree", "node"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            for at in range(0, table.num_rows, BLOCK):
                yield of(table.slice(at, BLOCK))

    ranged = members.repartitionByRange("band", "key", "node").sortWithinPartitions("band", "key", "node")
    parts = ranged.mapInArrow(best, "band int, key long, agree int, node long")
    return parts.groupBy("band", "key").agg(F.max_by("node", F.struct("agree", -F.col("node"))).alias("pivot"))


def verified(pairs: DataFrame, texts: DataFrame, weights) -> DataFrame:
    """The ``pairs`` ``a, b`` of nodes whose whole texts are similar enough."""

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        w = weights.value
        cache: dict[str, tuple] = {}

        def of(text: str) -> tuple:
            if text not in cache:
                if len(cache) > 64:
                    cache.clear()
                cache[text] = shingles(text)
            return cache[text]

        return pd.Series([similarity(of(x), of(y), w) >= LEAST for x, y in zip(a, b)], dtype=bool)

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("_b"))
    return pairs.join(left, "a").join(right, "b").filter(alike("_a", "_b")).select("a", "b")


def components(edges: DataFrame, name: str) -> DataFrame:
    """``node, class``: connected components by smallest label, with pointer jumping."""
    both = staged(edges.union(edges.select("b", "a")).toDF("node", "other").distinct(), f"{name}-edges")
    labels = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("class"))
    labels = staged(labels, f"{name}-labels")
    while True:
        around = labels.select(F.col("node").alias("other"), F.col("class").alias("near"))
        near = both.join(around, "other").groupBy("node").agg(F.min("near").alias("near"))
        lower = labels.join(near, "node").select(
            "node", F.least("class", "near").alias("class"), F.col("class").alias("was")
        )
        far = labels.select(F.col("node").alias("class"), F.col("class").alias("far"))
        jumped = lower.join(far, "class", "left").select(
            "node", F.least("class", F.coalesce("far", "class")).alias("class"), "was"
        )
        labels = staged(jumped, f"{name}-labels")
        if labels.filter(F.col("class") != F.col("was")).isEmpty():
            return labels.select("node", "class")
        labels = labels.select("node", "class")


def agreeing(sketch: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many samples each row of ``sketch`` shares with each of ``other``."""
    if len(sketch) * len(other) <= 2304:
        return (sketch[:, None, :] == other[None, :, :]).sum(2, dtype=np.uint8)
    out = np.zeros((len(sketch), len(other)), np.uint8)
    for mine, others in zip(np.ascontiguousarray(sketch.T), np.ascontiguousarray(other.T)):
        out += mine[:, None] == others[None, :]
    return out


def forest(score: np.ndarray, label: np.ndarray, other: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Best edges that join the classes of rows; ``score`` is 0 where none may be.

    Every class takes its best edge to another, and so on, until no class has one left.
    ``label`` are the classes of the rows, ``other`` those of the columns, if they differ.
    """
    n = len(label)
    _, part = np.unique(np.r_[label, label if other is None else other], return_inverse=True)
    edges = []
    while True:
        open_score = np.where(part[:n, None] == part[None, n:], 0, score)
        best = np.r_[n + open_score.argmax(1), open_score.argmax(0)]
        value = np.r_[open_score.max(1), open_score.max(0)]
        order = np.lexsort((value, part))
        last = order[np.r_[part[order][1:] != part[order][:-1], True]]  # the best row of a class
        last = last[value[last] > 0]
        if not len(last):
            return edges
        for i in last.tolist():
            j = int(best[i])
            if part[i] != part[j]:
                edges.append((i, j - n) if i < n else (j, i - n))
                part[part == part[i]] = part[j]


def tiles(members: DataFrame) -> DataFrame:
    """``members`` dealt out to tiles ``left, right``: every pair of blocks of a bucket.

    Rows sorted by bucket and class are cut into blocks of ``BLOCK`` rows, so a tile has at
    most ``2 * BLOCK`` rows, and any two rows of a bucket meet in one tile, whatever the
    size of their classes. Tiles within one class of a bucket are left out.
    """
    placed = prefix_sums(members, ["band", "key", "class", "node"], "_place", None, "bucket-members")
    placed = staged(placed.withColumn("block", F.expr(f"_place div {BLOCK}")).drop("_place"), "blocks")
    spans = placed.groupBy("band", "key", "block").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    spans = staged(spans, "block-spans")
    left, right = (spans.toDF("band", "key", *names) for names in (("left", "low", "high"), ("right", "_low", "_high")))
    met = left.join(right, ["band", "key"]).filter("left <= right AND least(low, _low) < greatest(high, _high)")
    sides = F.explode(F.array_distinct(F.array("left", "right"))).alias("block")
    return placed.join(met.select("band", "key", "left", "right", sides), ["band", "key", "block"])


def candidates(table: pa.Table) -> Iterator[tuple]:
    """For each bucket of a tile: its rows, their labels and the estimates of open pairs.

    Estimates are a matrix over the tile's two sides, 0 for pairs below ``ROUGH``, of one
    class, or tested; a tile of one block has it on both sides, and each pair once.
    """
    table = table.sort_by([(c, "ascending") for c in ("band", "key", "class", "node")])
    band, key, label, node = (table[c].to_numpy() for c in ("band", "key", "class", "node"))
    first = (table["block"].to_numpy() == table["left"].to_numpy())
    one_block = table["left"][0].as_py() == table["right"][0].as_py()
    tested = table["tested"].to_pylist()
    sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, HASHES)
    rough = int(np.ceil(ROUGH * HASHES))
    starts = np.flatnonzero(np.r_[True, (band[1:] != band[:-1]) | (key[1:] != key[:-1])])
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(node)]):
        if label[a] == label[b - 1]:
            continue
        i = np.arange(a, b) if one_block else a + np.flatnonzero(first[a:b])
        j = i if one_block else a + np.flatnonzero(~first[a:b])
        score = agreeing(sketch[i], sketch[j])
        score[score < rough] = 0
        score[label[i][:, None] == label[j][None, :]] = 0
        for mine, others, at in ((i, j, score), (j, i, score.T)):
            order = np.argsort(node[others])
            owner = np.repeat(np.arange(len(mine)), [len(tested[m] or ()) for m in mine])
            met = np.array([n for m in mine for n in tested[m] or ()], np.int64)
            place = np.searchsorted(node[others], met, sorter=order)
            hit = np.flatnonzero(place < len(others))
            hit = hit[node[others][order[place[hit]]] == met[hit]]
            at[owner[hit], order[place[hit]]] = 0
        yield i, j, node, label, np.triu(score) if one_block else score, table


def across(members: DataFrame) -> DataFrame:
    """Candidate pairs between classes: in each tile of a bucket forests of the best estimates.

    A forest joins all classes that any estimate joins, so its pairs are at most as many as
    the tile's rows; several forests without a common edge make up for estimates whose
    pair turns out less similar. ``members`` is ``band, key, class, node, sketch, tested``;
    the last lists nodes that a node was tested with.
    """

    def compare(table: pa.Table) -> pa.Table:
        pairs = set()
        for i, j, node, label, score, _ in candidates(table):
            for _ in range(FORESTS):
                edges = forest(score, label[i], label[j])
                for m, n in edges:
                    pairs.add((int(node[i[m]]), int(node[j[n]])))
                    score[m, n] = 0
                if not edges:
                    break
        left, right = zip(*sorted(pairs)) if pairs else ([], [])
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return tiles(members).groupBy("left", "right").applyInArrow(compare, "a long, b long").distinct()


def remaining(members: DataFrame) -> DataFrame:
    """All candidate pairs between classes: ``one, two, a, b``, lists for two chunks of nodes.

    ``members`` has columns ``chunk`` and ``keys`` more than for ``across``. Nothing is capped;
    a pair is listed in the first band that it shares, and a list has at most ``PAIRS`` pairs.
    """

    def compare(table: pa.Table) -> pa.Table:
        found = []
        for i, j, node, _, score, ordered in candidates(table):
            chunk, band = ordered["chunk"].to_numpy(), ordered["band"][int(i[0])].as_py()
            keys = ordered["keys"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
            x, y = np.nonzero(score)
            a, b = i[x], j[y]
            for earlier in range(band):
                new = keys[a, earlier] != keys[b, earlier]
                a, b = a[new], b[new]
            swap = (chunk[a] > chunk[b]) | ((chunk[a] == chunk[b]) & (node[a] > node[b]))
            a, b = np.where(swap, b, a), np.where(swap, a, b)
            found.append(np.stack([chunk[a], chunk[b], node[a], node[b]]))
        one, two, a, b = np.concatenate([np.zeros((4, 0), np.int64), *found], 1)
        order = np.lexsort((two, one))
        one, two, a, b = one[order], two[order], a[order], b[order]
        new = np.flatnonzero(np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])][: len(one)])
        ends = np.r_[new[1:], len(one)] if len(new) else new
        new = np.concatenate([np.zeros(0, np.int64), *(np.arange(s, e, PAIRS) for s, e in zip(new, ends))])
        ends = pa.array(np.r_[new, len(one)].astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int64())) for x in (a, b)]
        return pa.table({"one": pa.array(one[new]), "two": pa.array(two[new]), "a": lists[0], "b": lists[1]})

    schema = "one long, two long, a array<long>, b array<long>"
    return tiles(members).groupBy("left", "right").applyInArrow(compare, schema)


class Judge:
    """Verifies pairs of nodes ``node, class, text`` and joins their classes."""

    def __init__(self, nodes: list[tuple], weights: Weights):
        nodes = sorted(nodes)
        self.weights = weights
        self.name = np.array([n for n, _, _ in nodes], np.int64)
        self.part = np.unique([c for _, c, _ in nodes], return_inverse=True)[1]
        self.sets = [shingles(text) for _, _, text in nodes]
        self.ends = np.cumsum([0] + [len(h) for h, _ in self.sets])
        hashes = np.concatenate([h for h, _ in self.sets])
        self.weight = weights.of(hashes, np.concatenate([c for _, c in self.sets])).astype(float)
        distinct, self.place = np.unique(hashes, return_inverse=True)
        self.total = np.array([self.weight[s:e].sum() for s, e in zip(self.ends, self.ends[1:])])
        self.mine = np.zeros(len(distinct))

    def links(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """Those of the pairs that are similar enough and join classes.

        Each is verified, unless those before have joined its classes.
        """
        part, total, weight, ends, mine, found = self.part, self.total, self.weight, self.ends, self.mine, []
        pairs = np.unique(np.stack([np.searchsorted(self.name, a), np.searchsorted(self.name, b)]), axis=1)
        # The shared weight is at most the lesser total.
        ratio = total[pairs].min(0) / total[pairs].max(0)
        pairs = pairs[:, ratio >= LEAST - 1e-9]
        for i, at in zip(*np.unique(pairs[0], return_index=True)):
            others = pairs[1, at : np.searchsorted(pairs[0], i, "right")]
            own = slice(ends[i], ends[i + 1])
            mine[self.place[own]] = weight[own]
            step = 1
            while len(others := others[part[others] != part[i]]):
                now, others = others[:step], others[step:]
                step *= 2
                size = ends[now + 1] - ends[now]
                first = np.cumsum(size) - size
                flat = np.repeat(ends[now] - first, size) + np.arange(size.sum())
                shared = np.add.reduceat(np.minimum(weight[flat], mine[self.place[flat]]), first)
                alike = shared / (total[i] + total[now] - shared)
                for j, value in zip(now.tolist(), alike.tolist()):
                    if abs(value - LEAST) < 1e-9:  # sums in another order
                        value = similarity(self.sets[i], self.sets[j], self.weights)
                    if value >= LEAST and part[i] != part[j]:
                        found.append((int(self.name[i]), int(self.name[j])))
                        part[part == part[j]] = part[i]
            mine[self.place[own]] = 0
        return found


def settled(pairs: DataFrame, homes: DataFrame, texts: DataFrame, weights) -> DataFrame:
    """``a, b``: links among all ``pairs`` of ``remaining``, as far as they join classes.

    Texts come once for two chunks, not once a pair; ``homes`` is ``node, class, chunk``.
    Where two chunks have as many pairs as a chunk may have nodes, all their texts come,
    else only those of the pairs: either way at most about two texts a pair. The texts of two
    chunks are held, their pairs pass by.
    """
    sizes = pairs.groupBy("one", "two").agg(F.sum(F.size("a")).alias("n"))
    most = CHUNK // LIGHT
    sides = F.explode(F.array_distinct(F.array("one", "two"))).alias("chunk")
    all_of = sizes.filter(F.col("n") >= most).select("one", "two", sides).join(homes, "chunk")
    few = pairs.join(sizes.filter(F.col("n") < most), ["one", "two"])
    few = few.select("one", "two", F.explode(F.array_union("a", "b")).alias("node")).distinct().join(homes, "node")
    asked = all_of.select("one", "two", "node", "class").union(few.select("one", "two", "node", "class"))
    read = asked.join(texts, "node")
    lists = pairs.select("one", "two", *(F.lit(None).cast(t).alias(c) for c, t in (("node", "long"), ("class", "long"), ("text", "string"))), "a", "b")
    none = F.lit(None).cast("array<long>")
    rows = read.select("one", "two", "node", "class", "text", none.alias("a"), none.alias("b")).union(lists)
    rows = rows.repartition("one", "two").sortWithinPartitions("one", "two", F.col("node").isNull())

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, nodes, judge = None, [], None
        for batch in batches:
            links = []
            for one, two, node, label, text, left, right in zip(*batch.columns):
                if at != (one.as_py(), two.as_py()):
                    at, nodes, judge = (one.as_py(), two.as_py()), [], None
                if node.is_valid:
                    nodes.append((node.as_py(), label.as_py(), text.as_py()))
                else:
                    judge = judge or Judge(nodes, weights.value)
                    links += judge.links(left.values.to_numpy(), right.values.to_numpy())
            left, right = zip(*links) if links else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return rows.mapInArrow(verify, "a long, b long")


def chunked(members: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, class, chunk``: nodes that share their largest bucket lie in the same chunks.

    A chunk has ``CHUNK`` bytes of text, or one text more; a text counts as ``LIGHT`` bytes at least.
    """
    sizes = members.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"))
    bucket = F.max_by(F.struct("band", "key"), F.struct("n", "band", "key")).alias("home")
    homes = members.join(sizes, ["band", "key"]).groupBy("node", "class").agg(bucket)
    homes = homes.select("home.band", "home.key", "class", "node")
    weighed = texts.select("node", F.greatest(F.octet_length("text"), F.lit(LIGHT)).alias("bytes"))
    placed = prefix_sums(homes.join(weighed, "node"), ["band", "key", "class", "node"], "_place", "bytes", "homes")
    return placed.select("node", "class", F.expr(f"_place div {CHUNK}").alias("chunk"))


def between(members: DataFrame) -> DataFrame:
    """The ``members`` of buckets with several classes."""
    spread = members.groupBy("band", "key").agg(F.min("class").alias("_low"), F.max("class").alias("_high"))
    return members.join(spread.filter("_low < _high").select("band", "key"), ["band", "key"])


def near_classes(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, kept, sha`` for each row of ``docs``.

    ``class_id`` is the smallest id among documents linked by similarity, ``kept`` marks
    that document. Equal texts are one node. Nodes that share a band with others are
    verified on whole texts: first with the central node of their buckets; then
    along forests of the best estimates between the classes of each bucket; at last every
    pair of a bucket whose classes are still apart and whose estimate is ``ROUGH`` or more.
    No bucket is too large, and no pair is left out for its number. Texts without words are alike only if equal; a null
    text is empty; null ids are smaller than others only where no other is there; rows
    that repeat an id are documents of their own; an empty table gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    rows = pick(docs, doc_id="doc_id", text="text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    frequencies, n = document_frequencies(rows)
    weights = spark.sparkContext.broadcast(Weights(frequencies, n))  # of fixed size
    with_sha = rows.withColumn("sha", F.sha2("text", 256))
    sigs = staged(signed(with_sha.select("doc_id", "sha", "text"), weights), "signatures")
    nodes = sigs.groupBy("sha").agg(
        F.min("doc_id").alias("least"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")
    )
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    banded = nodes.select("node", F.posexplode("keys").alias("band", "key"))
    shared = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    met = staged(banded.join(shared, ["band", "key"]), "met")
    asked = met.select("node").distinct()
    chosen = nodes.join(asked, "node")
    members = staged(met.join(chosen.select("node", "sketch"), "node"), "members")
    wanted = staged(chosen.select("node", F.col("sha").alias("_sha"), F.col("least").alias("_least")), "wanted")
    # One row of each wanted text; repeated rows give the same text.
    same = (F.col("sha") == F.col("_sha")) & F.col("doc_id").eqNullSafe(F.col("_least"))
    texts = staged(with_sha.join(wanted, same).select("node", "text").dropDuplicates(["node"]), "texts")

    pivots = met.join(central(members), ["band", "key"]).filter("node <> pivot")
    often = pivots.groupBy("node", "pivot").agg(F.count(F.lit(1)).alias("n"))
    first = often.groupBy("node").agg(F.max_by("pivot", F.struct("n", -F.col("pivot"))).alias("pivot"))
    pairs = staged(first.toDF("a", "b"), "central-pairs")
    links = staged(verified(pairs, texts, weights), "links")
    own = F.coalesce("class", "node").alias("class")
    # Kept with the node that looked for a partner, not with a partner of many.
    tested = pairs.groupBy(F.col("a").alias("node")).agg(F.collect_set("b").alias("tested"))

    def labelled(classes: DataFrame) -> DataFrame:
        rows = members.join(classes, "node", "left").join(tested, "node", "left")
        return staged(between(rows.select("band", "key", own, "node", "sketch", "tested")), "labelled")

    pairs = staged(across(labelled(components(links, "central"))), "pairs")
    links = staged(links.union(verified(pairs, texts, weights)), "more-links")
    # What is still in different classes is verified pair by pair.
    apart = labelled(components(links, "forests"))
    homes = staged(chunked(apart, texts), "homes")
    known = homes.select("node", "chunk").join(nodes.select("node", "keys"), "node")
    rest = staged(remaining(apart.join(known, "node")), "remaining")
    last = staged(settled(rest, homes, texts, weights), "last-links")
    classes = components(links.union(last), "all")

    named = nodes.select("sha", "node", "least").join(classes, "node", "left").select("sha", own, "least")
    ids = named.groupBy("class").agg(F.min("least").alias("class_id"))
    ids = named.join(ids, "class").select("sha", "class_id")
    return sigs.select("doc_id", "sha").join(ids, "sha").select(
        "doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"), "sha"
    )


def op6_weighted_minhash(spark, sf_dir: str) -> DataFrame:
    classes = near_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return classes.select("doc_id", "class_id", "kept")
