"""Order MinHash: fingerprints of texts that follow their edit distance."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import SAMPLED, bucket_of, pick, width

K = 8  # code points of a k-mer; a power of two
TUPLE = 2  # k-mers of an entry
ENTRIES = 64
STEP = 2048  # k-mers ranked at once

_random = np.random.default_rng(12)
_turns = _random.integers(0, 1 << 32, ENTRIES, np.uint32)[:, None]
_factors = _random.integers(0, 1 << 31, ENTRIES, np.uint32)[:, None] * np.uint32(2) + np.uint32(1)
_odd = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def kmers(points: np.ndarray) -> np.ndarray:
    """A hash of each ``K`` code points in a row; a shorter text is one k-mer, an empty has none."""
    value = mixed(points.astype(np.uint64) + _odd)
    if 0 < len(points) < K:
        return mixed((value * (2 * np.arange(len(points), dtype=np.uint64) + np.uint64(1))).sum(keepdims=True))
    size = 1
    while size < K and len(value):
        value = mixed(value[:-size] * _odd + value[size:])
        size *= 2
    return value


def numbered(hashes: np.ndarray) -> np.ndarray:
    """A 32-bit hash of each k-mer and of how many equal ones stand before it."""
    n = len(hashes)
    bits = np.uint64(max(n.bit_length(), 1))
    at = np.arange(n, dtype=np.uint64)
    by_hash = np.sort((hashes >> bits << bits) | at)
    group, place = by_hash >> bits, (by_hash & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    same = np.r_[False, group[1:] == group[:-1]]
    occurrence = np.zeros(n, np.uint64)
    if same.any():
        rank = np.arange(n)
        occurrence[place] = rank - np.maximum.accumulate(np.where(same, 0, rank))
    return (mixed(hashes + occurrence * _odd) >> np.uint64(32)).astype(np.uint32)


def least(ranked: np.ndarray, first: int) -> np.ndarray:
    """For each entry the ``TUPLE`` least ranks, with their places, ``first`` being the first's.

    Rank and place are one number, so ties go to the earlier k-mer. What is missing is
    the largest number.
    """
    top = np.full((ENTRIES, TUPLE), np.iinfo(np.uint64).max)
    rows = np.arange(ENTRIES)
    for at in range(0, len(ranked), STEP):
        rank = (ranked[None, at : at + STEP] ^ _turns) * _factors
        found = [top]
        for _ in range(min(TUPLE, rank.shape[1])):
            i = rank.argmin(1)
            key = rank[rows, i].astype(np.uint64) << np.uint64(32) | (i + at + first).astype(np.uint64)
            found.append(key[:, None])
            rank[rows, i] = np.iinfo(np.uint32).max
        top = np.sort(np.concatenate(found, 1), 1)[:, :TUPLE]
    return top


def entries(top: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Each entry's k-mers in the order of the text, hashed to 32 bits."""
    chosen = top != np.iinfo(np.uint64).max
    place = np.sort(np.where(chosen, top & np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFF)), 1).astype(np.int64)
    value = np.zeros(ENTRIES, np.uint64)
    for column in place.T:
        there = column < len(hashes)
        kmer = hashes[np.minimum(column, max(len(hashes) - 1, 0))] if len(hashes) else np.zeros(ENTRIES, np.uint64)
        value = mixed(value * _odd + np.where(there, kmer, np.uint64(0)) + there.astype(np.uint64))
    return (value >> np.uint64(32)).astype(np.uint32)


class Fingerprint:
    """The sketch of a text: for each of ``ENTRIES`` hash functions, the ``TUPLE`` k-mers of least rank.

    A k-mer is ranked together with the number of equal ones before it, so that repeats
    count; the chosen ones keep their order in the text. Two texts share an entry if they
    share its k-mers and their order, which edits and moved passages both undo.
    """

    def __init__(self, text: str, kept: int = 0, head: np.ndarray | None = None):
        """``kept``: code points at the start whose k-mers are ranked apart, as ``head``.

        A text that begins with the same ones can be given that ``head``.
        """
        hashes = kmers(np.frombuffer(text.encode("utf-32-le"), np.uint32))
        ranked, shared = numbered(hashes), max(kept - K + 1, 0)
        self.head = least(ranked[:shared], 0) if head is None else head
        top = np.sort(np.concatenate([self.head, least(ranked[shared:], shared)], 1), 1)[:, :TUPLE]
        self.entries = entries(top, hashes)

    def likeness(self, other: Fingerprint) -> float:
        """The share of equal entries."""
        return float((self.entries == other.entries).mean())

    def __str__(self) -> str:
        return self.entries.astype(">u4").tobytes().hex()


def likeness(one: Column | str, other: Column | str) -> Column:
    """``Fingerprint.likeness`` of two fingerprints as they are written, from 0 to 1."""
    one, other = (F.col(x) if isinstance(x, str) else x for x in (one, other))
    at = F.sequence(F.lit(1), F.lit(8 * ENTRIES - 7), F.lit(8))
    equal = F.filter(at, lambda i: F.substr(one, i, F.lit(8)) == F.substr(other, i, F.lit(8)))
    return F.size(equal) / F.lit(float(ENTRIES))


def known(docs: DataFrame) -> DataFrame:
    return pick(docs, doc_id="doc_id", text="text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, fingerprint`` for each row of ``docs``.

    A null text is empty. An empty text has entries without k-mers, a text of fewer than
    ``K`` code points is one k-mer; equal texts have equal fingerprints. Texts are read whole,
    in steps, so that long ones take some eighty bytes a code point. Repeated rows and ids
    give repeated results; an empty table gives no rows.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            columns = [
                batch["doc_id"],
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([str(Fingerprint(t)) for t in texts], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "fingerprint"])

    return known(docs).mapInArrow(sketch, "doc_id long, n_chars long, fingerprint string")


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` in sorted ranges ``_bucket``; each ends with the next one's first row.

    That row has ``_next`` set and comes last; the last range's is the first row of all.
    Ranges go by id and hash of the text, so only rows that repeat both must stay together.
    The texts are shuffled once; a row for each range is broadcast.
    """
    n = width(docs.sparkSession)
    rows = known(docs).withColumn("_tie", F.xxhash64("text"))
    keys = ["doc_id", "_tie"]
    share = min(1.0, SAMPLED * n / max(docs.count(), 1))
    sample = sorted(
        rows.select(*keys).sample(share, seed=17).collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1])
    )
    at = sorted({len(sample) * i // n for i in range(1, n)}) if sample else []
    cuts = list(dict.fromkeys(tuple(sample[i]) for i in at))
    placed = rows.withColumn("_bucket", bucket_of(cuts, keys, rows))
    firsts = placed.groupBy("_bucket").agg(F.min(F.struct(*keys)).alias("_first"))
    every, order = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), Window.orderBy("_bucket")
    firsts = firsts.select(
        F.col("_bucket").alias("_of"),
        F.col("_first.doc_id").alias("_id"),
        F.col("_first._tie").alias("_hash"),
        F.coalesce(F.lag("_bucket").over(order), F.max("_bucket").over(every)).alias("_before"),
    )
    is_first = (F.col("_bucket") == F.col("_of")) & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_tie") == F.col("_hash"))
    own = F.array(F.struct(F.col("_bucket").alias("bucket"), F.lit(False).alias("next")))
    both = F.concat(own, F.array(F.struct(F.col("_before").alias("bucket"), F.lit(True).alias("next"))))
    dealt = placed.join(F.broadcast(firsts), is_first, "left").withColumn(
        "_to", F.explode(F.when(F.col("_before").isNull(), own).otherwise(both))
    )
    return (
        dealt.select(*keys, "text", F.col("_to.bucket").alias("_bucket"), F.col("_to.next").alias("_next"))
        .repartitionById(n, F.col("_bucket"))
        .sortWithinPartitions("_bucket", "_next", *keys)
    )


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)


def edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of what they become when their last quarter is replaced.

    The last quarter of a text, in whole code points, gives way to as many, or all, of the
    first code points of the next document by id; the last is followed by the first, a
    single one by itself. Ids: nulls first; rows that repeat an id go by a hash of the text.
    ``near_edited`` and ``near_next`` are the likeness of a text's fingerprint to those of the
    edited text and of the next document. Otherwise as ``fingerprints``.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for the next one
        names = [part.split()[0] for part in RESULT.split(",")]
        kinds = [pa.int64()] * 2 + [pa.string()] * 3 + [pa.float64()] * 2
        for batch in batches:
            out = []
            for doc_id, text, bucket, ends in zip(*(batch[c] for c in ("doc_id", "text", "_bucket", "_next"))):
                text, bucket = text.as_py(), bucket.as_py()
                kept = len(text) - len(text) // 4
                follows = held is not None and held[0] == bucket
                if ends.as_py() and not follows:
                    continue  # the rows that repeat the first one
                own = Fingerprint(text, 0 if ends.as_py() else kept)
                if follows:
                    _, before, old, print_, stays = held
                    new = old[:stays] + text[: len(old) - stays]
                    other = Fingerprint(new, stays, print_.head)
                    sha = hashlib.sha256(new.encode()).hexdigest()
                    near = (print_.likeness(other), print_.likeness(own))
                    out.append((before, len(old), sha, str(print_), str(other), *near))
                held = None if ends.as_py() else (bucket, doc_id.as_py(), text, own, kept)
            columns = zip(*out) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return with_next(docs).mapInArrow(compare, RESULT)


def op12_order_minhash(spark, sf_dir: str) -> DataFrame:
    return edited(spark.read.parquet(f"{sf_dir}/documents.parquet"))
