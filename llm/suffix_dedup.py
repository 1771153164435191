"""Repeated byte strings removed by a sampled suffix sort in range partitions."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import pick, staged, width

LENGTH = 50  # bytes of a string that counts as repeated
TOKEN = 16  # leading bytes of a sampled suffix: two words of 8
SPAN = LENGTH - TOKEN + 1  # suffixes in a string, of which one is sampled
SIDE = (LENGTH - TOKEN) // 2
PIECE = 1 << 18  # bytes hashed at a time
FLUSH = 6 << 20  # bytes whose suffixes a task gathers before it deals them out
BUCKET = 8 << 20  # bytes of text whose suffixes, or whose documents, meet in a task
ROWS = 2500  # documents that a task compresses at a time
SAMPLED = 2000  # suffixes of a task that the splitters are chosen from, at most
NULL = np.iinfo(np.int64).min  # stands for a null id: smaller than all others

_base = np.uint64(0x9E3779B97F4A7C15)
_base2 = np.uint64(0xD1342543DE82EF95)

# A part of a document: ``count`` strings from ``start`` on. ``open``: not decided yet, and
# ``sample`` is where its sampled suffix starts, from ``start``.
ENTRY = np.dtype(
    [("doc", "<i8"), ("crc", "<u4"), ("start", "<u4"), ("count", "u1"), ("sample", "u1"), ("open", "u1")]
)
# A sampled suffix; ``of`` is its document's place in the blob's table of documents, ``before``
# and ``after`` a byte of a hash of the SIDE bytes next to its token, one of which each string of
# its segment holds.
SUFFIX = np.dtype(
    [("lead", "<u8"), ("tail", "<u8"), ("low", "<u4"), ("high", "<u2"), ("of", "<u4"), ("start", "<u4")]
    + [(name, "u1") for name in ("count", "sample", "before", "after")]
)
DOC = np.dtype([("doc", "<i8"), ("crc", "<u4")])
# ``sample``: where the sampled suffix starts, from ``start``; ``strip``: which of STRIPS.
STRIP = np.dtype([("of", "<u4"), ("start", "<u4"), ("count", "u1"), ("sample", "u1"), ("strip", "u1")])
# Strings are told apart by how many bytes of them stand before the sampled suffix. Each
# strip (from, below) of that number has bytes that all its strings hold, its key.
STRIPS = ((0, 4), (4, 9), (9, 17), (17, SPAN))

ROUTED = "bucket int, blob binary"


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def packed(rows: np.ndarray) -> bytes:
    """A structured array, column by column, compressed."""
    columns = b"".join(np.ascontiguousarray(rows[name]).tobytes() for name in rows.dtype.names)
    return zstandard.ZstdCompressor(level=1).compress(columns)


def unpacked(blob: bytes, kind: np.dtype) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(blob)
    out, at = np.empty(len(data) // kind.itemsize, kind), 0
    for name in kind.names:
        size = len(out) * kind[name].itemsize
        out[name] = np.frombuffer(data, kind[name], len(out), at)
        at += size
    return out


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    one = np.ones(1, np.uint64)
    return (
        np.r_[one, np.cumprod(np.full(n, base, np.uint64))],
        np.r_[one, np.cumprod(np.full(n, inverse, np.uint64))],
    )


class Hasher:
    """Hashes of byte ranges of a buffer, from prefix sums."""

    tables: dict[int, tuple] = {}

    def __init__(self, b: np.ndarray, base: np.uint64):
        table = self.tables.get(int(base))
        if table is None or len(table[0]) <= len(b):
            table = self.tables[int(base)] = powers(base, max(len(b), PIECE + 256))
        self.inverse = table[1]
        self.sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * table[0][: len(b)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start])


def words(b: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place as a number, so that numbers sort as bytes do."""
    x = b.astype(np.uint64)
    for step in (1, 2, 4):
        x = (x[:-step] << np.uint64(8 * step)) | x[step:]
    return x


def sampled_suffixes(b: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, ...]:
    """``lead, tail, segment, place, start, count, before, after`` for texts joined in ``b``.

    ``docs`` holds where each text ends. Of the suffixes that start in a string of
    ``LENGTH`` bytes (and leave a token in it) the one whose token has the least hash is
    sampled: by content, so equal strings sample equal suffixes at equal places. The
    strings that sample one suffix are neighbours; the bytes they cover are its segment.
    """
    n = len(b) - LENGTH + 1
    empty = np.zeros(0, np.int64)
    if n <= 0:
        return (empty,) * 8
    word = words(b)
    lead, tail = word[: len(word) - 8], word[8:]
    value = mixed(lead * _base ^ tail)
    place = np.arange(len(value), dtype=np.int32)
    step, have = 1, 1
    while have < SPAN:  # least of the SPAN values from each place on, leftmost of equals
        step = min(have, SPAN - have)
        right = value[step:] < value[:-step]
        value = np.where(right, value[step:], value[:-step])
        place = np.where(right, place[step:], place[:-step])
        have += step
    place = place[:n]
    begins = np.r_[0, docs[:-1]]
    fits = np.zeros(n + 1, np.int64)
    long = docs - begins >= LENGTH
    np.add.at(fits, begins[long], 1)
    np.add.at(fits, docs[long] - LENGTH + 1, -1)
    at = np.flatnonzero(np.cumsum(fits)[:n])
    if not len(at):
        return (empty,) * 8
    found = place[at]
    first = np.flatnonzero(np.r_[True, (found[1:] != found[:-1]) | (at[1:] != at[:-1] + 1)])
    start, count = at[first], np.diff(np.r_[first, len(at)])
    a = found[first]
    hasher = Hasher(b, _base)
    segment = hasher.of(start, start + count + LENGTH - 1)
    # Where no string of the segment holds a side, its hash is never looked at.
    before = hasher.of(np.maximum(a - SIDE, 0), a)
    after = hasher.of(a + TOKEN, np.minimum(a + TOKEN + SIDE, len(b)))
    return lead[a], tail[a], segment, a, start, count, before, after


def pieces(texts: Iterator[tuple]) -> Iterator[tuple]:
    """Texts joined to buffers of about ``PIECE`` bytes: ``b, ends, doc, crc, shift``.

    A longer text is parted, its parts overlapping so that no string is lost.
    """
    parts, ends, docs, crcs, shifts, size = [], [], [], [], [], 0

    def joined():
        return (
            np.frombuffer(b"".join(parts), np.uint8),
            np.array(ends, np.int64),
            np.array(docs, np.int64),
            np.array(crcs, np.uint32),
            np.array(shifts, np.int64),
        )

    for doc, raw in texts:
        crc = zlib.crc32(raw)
        for at in range(0, max(len(raw) - LENGTH + 1, 1), PIECE):
            part = raw[at : at + PIECE + LENGTH - 1]
            if parts and size + len(part) > PIECE + LENGTH:
                yield joined()
                parts, ends, docs, crcs, shifts, size = [], [], [], [], [], 0
            size += len(part)
            parts.append(part)
            ends.append(size)
            docs.append(doc)
            crcs.append(crc)
            shifts.append(at)
    if parts:
        yield joined()


def sealed(*arrays: np.ndarray | bytes) -> bytes:
    """Several packed arrays or texts in one blob."""
    parts = [packed(a) if isinstance(a, np.ndarray) else zstandard.ZstdCompressor(level=3).compress(a) for a in arrays]
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def opened(blob: bytes, *kinds: np.dtype | None) -> list:
    out, at = [], 0
    for kind in kinds:
        size = int.from_bytes(blob[at : at + 8], "little")
        part = blob[at + 8 : at + 8 + size]
        out.append(zstandard.ZstdDecompressor().decompress(part) if kind is None else unpacked(part, kind))
        at += 8 + size
    return out


def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            yield NULL if doc is None else doc, text.as_buffer().to_pybytes() if text.is_valid else b""


def suffixes(texts: Iterator[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sampled suffixes, and the documents that they name by place."""
    for b, ends, doc, crc, shift in pieces(texts):
        lead, tail, segment, place, start, count, before, after = sampled_suffixes(b, ends)
        of = np.searchsorted(ends, start, "right")
        out, table = np.empty(len(start), SUFFIX), np.empty(len(doc), DOC)
        begin = np.r_[0, ends[:-1]]
        out["lead"], out["tail"], out["count"] = lead, tail, count
        out["before"], out["after"] = before.astype(np.uint8), after.astype(np.uint8)
        segment = segment.astype(np.uint64)
        out["low"], out["high"] = segment & np.uint64(0xFFFFFFFF), segment >> np.uint64(48)
        out["of"], out["start"], out["sample"] = of, start - begin[of] + shift[of], place - start
        table["doc"], table["crc"] = doc, crc
        yield out, table


def batch_of(names: list[str], rows: list[tuple], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def routed(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return batch_of(["bucket", "blob"], rows, [pa.int32(), pa.binary()])


def home(docs: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket in which a document's text and all that is found about it meet."""
    return (mixed(docs.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def parted(rows: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for a, b in zip(edges, np.r_[edges[1:], len(order)]):
        yield int(bucket[order[a]]), rows[order[a:b]]


def by_document(entries: np.ndarray) -> np.ndarray:
    return entries[np.lexsort((entries["start"], entries["crc"], entries["doc"]))]


def gathered(b: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The parts of ``b``, one after another."""
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return b[np.repeat(start, size) + inside]


def strip_keys(b: np.ndarray, begin: np.ndarray, strips: np.ndarray) -> np.ndarray:
    """Hashes of the bytes that all strings of a strip hold; a piece at a time."""
    low, high = np.array(STRIPS).T[:, strips["strip"]]
    at = begin + strips["sample"]
    start, end = at - low, at + TOKEN + SPAN - high
    out = np.empty(len(strips), np.uint64)
    for i in range(0, len(strips), 8192):
        part = slice(i, i + 8192)
        size = end[part] - start[part]
        first = np.cumsum(size) - size
        out[part] = Hasher(gathered(b, start[part], size), _base).of(first, first + size)
    return out


def sent_home(entries: np.ndarray, buckets: int) -> list[tuple[int, bytes]]:
    return [
        (bucket, packed(by_document(part)))
        for bucket, part in parted(entries, home(entries["doc"], buckets))
    ]


def range_of(lead: np.ndarray, tail: np.ndarray, doc: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """How many of the sorted ``cuts`` are not above (lead, tail, document)."""
    low = np.searchsorted(cuts["lead"], lead, "left")
    high = np.searchsorted(cuts["lead"], lead, "right")
    out = low.copy()
    at = np.flatnonzero(low < high)  # the few that share their lead with a cut
    for j in np.unique(np.concatenate([np.arange(a, b) for a, b in set(zip(low[at].tolist(), high[at].tolist()))])) if len(at) else []:
        rows = at[(low[at] <= j) & (j < high[at])]
        cut = cuts[j]
        above = (tail[rows] > cut["tail"]) | ((tail[rows] == cut["tail"]) & (doc[rows] >= cut["doc"]))
        out[rows] += above
    return out


def multikey_order(*keys: np.ndarray) -> np.ndarray:
    """Sorting order by several keys: by the first, then only what is still tied by the next."""
    order = np.argsort(keys[0], kind="stable")
    tie = np.zeros(len(order), np.int64)  # rows of one number are tied
    first = keys[0][order]
    for key in keys[1:]:
        tie = np.cumsum(np.r_[False, (first[1:] != first[:-1]) | (tie[1:] != tie[:-1])]).astype(np.int64)[: len(order)]
        again = np.r_[tie[1:] == tie[:-1], False]
        again[1:] |= again[:-1]
        open_rows = np.flatnonzero(again)
        if not len(open_rows):
            break
        value = key[order[open_rows]]
        order[open_rows] = order[open_rows][np.lexsort((value, tie[open_rows]))]
        first = key[order]
    return order


CUT = np.dtype([("lead", "<u8"), ("tail", "<u8"), ("doc", "<i8")])


def splitters(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Sampled suffixes that part all into ranges, and the number of ranges.

    The sample is about 20 documents a range; it steers the balance only.
    """
    n = rows.count()
    least = width(rows.sparkSession)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, raw in texts_of(batches):
            lead, tail, *_ = sampled_suffixes(np.frombuffer(raw, np.uint8), np.array([len(raw)]))
            pick = np.flatnonzero(mixed(lead.astype(np.uint64) ^ np.uint64(doc & 0xFFFF)) % np.uint64(16) == 0)[:SAMPLED]
            cut = np.empty(len(pick), CUT)
            cut["lead"], cut["tail"], cut["doc"] = lead[pick], tail[pick], doc
            yield routed([(min(len(raw), 2**31 - 1), cut.tobytes())])

    share = min(1.0, 20 * max(least, 50) / max(n, 1))
    found = rows.sample(share, seed=5).mapInArrow(sample, ROUTED).collect()
    size = n * sum(r["bucket"] for r in found) / max(len(found), 1)
    ranges = max(least, int(size / BUCKET))
    cuts = np.sort(np.concatenate([np.zeros(0, CUT)] + [np.frombuffer(r["blob"], CUT) for r in found]), order=["lead", "tail", "doc"])
    cuts = np.unique(cuts[[len(cuts) * i // ranges for i in range(1, ranges)]]) if len(cuts) else cuts
    return cuts, ranges


def dealt_suffixes(rows: DataFrame, cuts: np.ndarray) -> DataFrame:
    """The sampled suffixes of all texts, in blobs by range."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tables, size, docs = [], [], 0, 0

        def flushed() -> pa.RecordBatch | None:
            rows, table = np.concatenate(held), np.concatenate(tables)
            ranges = range_of(rows["lead"], rows["tail"], table["doc"][rows["of"]], cuts)
            out = []
            for bucket, part in parted(rows, ranges):
                part = part[multikey_order(part["lead"], part["tail"])]
                used, of = np.unique(part["of"], return_inverse=True)
                part["of"] = of
                out.append((bucket, sealed(part, table[used])))
            return routed(out)

        for part, table in suffixes(texts_of(batches)):
            part["of"] += docs
            docs += len(table)
            held.append(part)
            tables.append(table)
            size += PIECE
            if size >= FLUSH and sum(map(len, held)):
                yield flushed()
                held, tables, size, docs = [], [], 0, 0
        if sum(map(len, held)):
            yield flushed()

    return rows.mapInArrow(deal, ROUTED)


def sorted_suffixes(dealt: DataFrame, ranges: int) -> DataFrame:
    """What the sorted neighbours of each range decide, sent to the documents' buckets.

    Suffixes with one token are neighbours. A segment that a smaller document has, too, is
    repeated as a whole. If another segment of the token has the same bytes on one side,
    their strings may be the same in part: the segment's first documents stay open. The
    first and last token of a range may go on across the boundary; there they stay open in
    any case, and their strings are compared across ranges afterwards.
    """

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tables, docs = [], [], 0
        for batch in batches:
            for blob in batch["blob"]:
                part, table = opened(blob.as_py(), SUFFIX, DOC)
                part["of"] += docs
                docs += len(table)
                held.append(part)
                tables.append(table)
        if not held:
            return
        rows, table = np.concatenate(held), np.concatenate(tables)
        held.clear()
        segment = rows["low"] | (rows["high"].astype(np.uint64) << np.uint64(32))
        doc = table["doc"][rows["of"]]
        order = multikey_order(rows["lead"], rows["tail"], segment, doc)
        rows, segment, doc = rows[order], segment[order], doc[order]
        new_token = np.r_[True, (rows["lead"][1:] != rows["lead"][:-1]) | (rows["tail"][1:] != rows["tail"][:-1])]
        new_segment = new_token | np.r_[True, segment[1:] != segment[:-1]]
        token, at = np.cumsum(new_token) - 1, np.cumsum(new_segment) - 1
        first = np.flatnonzero(new_segment)
        repeated = doc > doc[first][at]
        several = np.flatnonzero(np.bincount(token[first])[token[first]] > 1)  # segments
        offset = rows["sample"][first].astype(np.int64)  # of the token in the first string
        shared = np.zeros(len(first), bool)
        for side, holds in (("before", offset >= SIDE), ("after", offset - rows["count"][first] < SIDE)):
            some = several[holds[several]]
            key = token[first[some]] * 256 + rows[side][first[some]]
            _, of, met = np.unique(key, return_inverse=True, return_counts=True)
            shared[some] |= met[of] > 1
        edge = (token == 0) | (token == token[-1])
        keep = np.flatnonzero(repeated | shared[at] | edge)
        entries = np.empty(len(keep), ENTRY)
        for name in ("start", "count", "sample"):
            entries[name] = rows[name][keep]
        entries["doc"], entries["crc"] = doc[keep], table["crc"][rows["of"][keep]]
        entries["open"] = ~repeated[keep]
        yield routed(sent_home(entries, ranges))

    return dealt.repartitionById(ranges, F.col("bucket")).mapInArrow(sort, ROUTED)


def text_blobs(rows: DataFrame, buckets: int) -> DataFrame:
    """All texts, compressed, by the documents' buckets."""

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            texts = list(texts_of([part]))
            docs = np.empty(len(texts), DOC)
            docs["doc"] = [d for d, _ in texts]
            docs["crc"] = [zlib.crc32(raw) for _, raw in texts]
            out = []
            for bucket, at in parted(np.arange(len(texts)), home(docs["doc"], buckets)):
                sizes = np.array([len(texts[i][1]) for i in at], [("size", "<u8")])
                out.append((bucket, sealed(docs[at], sizes, b"".join(texts[i][1] for i in at))))
            yield routed(out)

    return rows.mapInArrow(squeeze, ROUTED)


def documents_in(blobs: pa.Table) -> Iterator[tuple[int, int, bytes]]:
    for blob in blobs["blob"]:
        docs, sizes, text = opened(blob.as_py(), DOC, np.dtype([("size", "<u8")]), None)
        at = 0
        for (doc, crc), (size,) in zip(docs.tolist(), sizes.tolist()):
            yield doc, crc, text[at : at + size]
            at += size


def entries_in(blobs: pa.Table) -> dict[tuple[int, int], np.ndarray]:
    """Entries by document and checksum."""
    parts = [unpacked(b.as_py(), ENTRY) for b in blobs["blob"]]
    rows = by_document(np.concatenate([np.zeros(0, ENTRY), *parts]))
    edges = np.flatnonzero(np.r_[True, (rows["doc"][1:] != rows["doc"][:-1]) | (rows["crc"][1:] != rows["crc"][:-1])]) if len(rows) else []
    return {
        (int(rows["doc"][a]), int(rows["crc"][a])): rows[a:b] for a, b in zip(edges, [*edges[1:], len(rows)])
    }


def open_strips(texts: DataFrame, entries: DataFrame, ranges: int) -> DataFrame:
    """The strings of open segments, strip by strip, sent to ranges of the strips' keys.

    Equal strips of the documents in a bucket are decided there; only the first document
    goes on. So what many documents share meets but once from each bucket. Rows for a
    document's bucket have a negative ``bucket``: they pass through to the end.
    """

    def cut(key: tuple, blobs: pa.Table, found: pa.Table) -> pa.Table:
        by_doc, out, seen = entries_in(found), [], {}
        spans, table, sources = [], [], []
        for doc, crc, raw in documents_in(blobs):
            rows = by_doc.get((doc, crc))
            if rows is None or (doc, crc) in seen:
                continue
            seen[doc, crc] = True
            rows = rows[rows["open"] == 1]
            if len(rows):
                spans.append(rows)
                sources.append(raw)
                table.append((doc, crc))
        if not table:
            return routed([(0, b"")])[:0]
        table = np.array(table, DOC)
        rows, of = np.concatenate(spans), np.repeat(np.arange(len(spans)), list(map(len, spans)))
        kept, payloads = [], []
        for at in range(0, len(rows), 8192):
            part, owner = rows[at : at + 8192], of[at : at + 8192]
            start, count, sample = (part[c].astype(np.int64) for c in ("start", "count", "sample"))
            ends = (start + count + LENGTH - 1).tolist()
            b = np.frombuffer(b"".join(sources[o][s:e] for o, s, e in zip(owner.tolist(), start.tolist(), ends)), np.uint8)
            begin = np.r_[0, np.cumsum(count + LENGTH - 1)[:-1]]
            hasher, a = Hasher(b, _base), begin + sample
            for n, (low, high) in enumerate(STRIPS):
                first = np.maximum(begin, a - high + 1)
                last = np.minimum(begin + count - 1, a - low)
                i = np.flatnonzero(first <= last)
                strip = np.empty(len(i), STRIP)
                strip["of"], strip["start"] = owner[i], start[i] + first[i] - begin[i]
                strip["count"], strip["sample"], strip["strip"] = last[i] - first[i] + 1, a[i] - first[i], n
                key = hasher.of(a[i] - low, a[i] + TOKEN + SPAN - high)
                kept.append((strip, key, hasher.of(first[i], last[i] + LENGTH)))
                payloads.append(gathered(b, first[i], last[i] + LENGTH - first[i]))
        strip, key, whole = (np.concatenate(x) for x in zip(*kept))
        payload, size = np.concatenate(payloads), strip["count"].astype(np.int64) + LENGTH - 1
        kept, payloads, begin = [], [], np.cumsum(size) - size
        doc = table["doc"][strip["of"]]
        order = multikey_order(key, whole, doc)
        k, w, d = key[order], whole[order], doc[order]
        new = np.r_[True, (k[1:] != k[:-1]) | (w[1:] != w[:-1])]
        least = d[np.flatnonzero(new)][np.cumsum(new) - 1]
        out = [(-1 - b, blob) for b, blob in sent_home(as_entries(strip[order[d > least]], table), ranges)]
        going = order[d == least]
        for bucket, i in parted(going, (key[going] % np.uint64(ranges)).astype(np.int64)):
            i.sort()
            used, place = np.unique(strip["of"][i], return_inverse=True)
            part = strip[i]
            part["of"] = place
            out.append((bucket, sealed(part, table[used], gathered(payload, begin[i], size[i]).tobytes())))
        return pa.Table.from_batches([routed(out)])

    both = texts.groupBy("bucket").cogroup(entries.groupBy("bucket"))
    return both.applyInArrow(cut, ROUTED)


def as_entries(strips: np.ndarray, table: np.ndarray) -> np.ndarray:
    out = np.zeros(len(strips), ENTRY)
    out["doc"], out["crc"] = table["doc"][strips["of"]], table["crc"][strips["of"]]
    out["start"], out["count"] = strips["start"], strips["count"]
    return out


def compared_strings(strips: DataFrame, ranges: int) -> DataFrame:
    """Strings sorted byte by byte in each range of keys; those with a smaller document."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tables, texts, docs = [], [], [], 0
        for batch in batches:
            passed = []
            for bucket, blob in zip(batch["bucket"].to_pylist(), batch["blob"].to_pylist()):
                if bucket < 0:
                    passed.append((-1 - bucket, blob))
                    continue
                part, table, text = opened(blob, STRIP, DOC, None)
                part["of"] += docs
                docs += len(table)
                held.append(part)
                tables.append(table)
                texts.append(text)
            if passed:
                yield routed(passed)
        if not held:
            return
        rows, table, b = np.concatenate(held), np.concatenate(tables), np.frombuffer(b"".join(texts), np.uint8)
        begin = np.r_[0, np.cumsum(rows["count"].astype(np.int64) + LENGTH - 1)[:-1]]
        # Only keys of several strips can hold equal strings.
        _, key, met = np.unique(strip_keys(b, begin, rows), return_inverse=True, return_counts=True)
        some = np.flatnonzero(met[key] > 1)
        if not len(some):
            return
        strip, inside, keys = [], [], []
        for i in range(0, len(some), 8192):  # the words of a piece of the texts at a time
            part = some[i : i + 8192]
            count = rows["count"][part].astype(np.int64)
            size = count + LENGTH - 1
            word = words(gathered(b, begin[part], size))
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            at = np.repeat(np.cumsum(size) - size, count) + place
            strip.append(np.repeat(part, count))
            inside.append(place)
            keys.append([word[at + shift] for shift in (0, 8, 16, 24, 32, 40, LENGTH - 8)])
        strip, inside = np.concatenate(strip), np.concatenate(inside)
        keys, doc = [np.concatenate(k) for k in zip(*keys)], table["doc"][rows["of"][strip]]
        order = multikey_order(*keys, doc)
        new = np.zeros(len(order), bool)
        new[0] = True
        for k in keys:
            k = k[order]
            new[1:] |= k[1:] != k[:-1]
        d = doc[order]
        least = d[np.flatnonzero(new)][np.cumsum(new) - 1]
        again = order[d > least]
        found = np.zeros(len(again), ENTRY)
        owner = rows[strip[again]]
        found["doc"], found["crc"] = table["doc"][owner["of"]], table["crc"][owner["of"]]
        found["start"], found["count"] = owner["start"] + inside[again], 1
        if len(found):
            yield routed(sent_home(found, ranges))

    to = F.when(F.col("bucket") >= 0, F.col("bucket")).otherwise(-1 - F.col("bucket"))
    return strips.repartitionById(ranges, to).mapInArrow(compare, ROUTED)


def removed_repeats(docs: DataFrame, kept: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for each row of ``docs``.

    Every byte covered by a string of ``LENGTH`` bytes that also starts in a document
    with a smaller id is removed; strings do not cross documents and are judged on the
    input. ``kept=True`` adds ``kept_bytes``. Null text is empty, a null id smaller than
    all others, rows of one id do not count against each other, and an empty table gives
    no rows.
    """
    rows = pick(docs, doc_id="doc_id", text="text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("text")
    )
    cuts, ranges = splitters(rows)
    entries = staged(sorted_suffixes(dealt_suffixes(rows, cuts), ranges), "sorted-suffixes")
    texts = text_blobs(rows, ranges)  # one shuffle, met twice in one plan
    found = compared_strings(open_strips(texts, entries, ranges), ranges)

    def remove(key: tuple, blobs: pa.Table, found: pa.Table) -> pa.Table:
        by_doc, out = entries_in(found), []
        for doc, crc, raw in documents_in(blobs):
            rows = by_doc.get((doc, crc))
            left, spans = raw, 0
            if rows is not None:
                rows = rows[rows["open"] == 0]
            if rows is not None and len(rows):
                start = rows["start"].astype(np.int64)
                step = np.zeros(len(raw) + 1, np.int64)
                np.add.at(step, start, 1)
                np.add.at(step, start + rows["count"] + LENGTH - 1, -1)
                gone = np.cumsum(step)[:-1] > 0
                spans = int((np.diff(gone.view(np.int8), prepend=0) == 1).sum())
                left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            row = (None if doc == NULL else doc, len(raw), len(raw) - len(left), spans, hashlib.sha256(left).hexdigest())
            out.append(row + ((left,) if kept else ()))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()][: 1 + kept]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"][: 5 + kept]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, list(zip(*out)) or [[]] * 6, kinds)})

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    both = texts.groupBy("bucket").cogroup(entries.union(found).groupBy("bucket"))
    return both.applyInArrow(remove, schema + ", kept_bytes binary" * kept)


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return removed_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = """
    WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
    s AS (SELECT doc_id, p, substr(x, 2 * p + 1, 100) AS w
          FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 49)) AS p FROM h)),
    least AS (SELECT w, min(doc_id) AS first FROM s GROUP BY w HAVING min(doc_id) <> max(doc_id)),
    d AS (SELECT doc_id, p FROM s JOIN least USING (w) WHERE doc_id > first),
    r AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS new FROM d),
    g AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM r),
    runs AS (SELECT doc_id, g, min(p) AS a, max(p) + 50 AS b FROM g GROUP BY doc_id, g),
    gaps AS (SELECT doc_id, a, b, lag(b) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM runs),
    cut AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
                   string_agg(substr(x, 2 * coalesce(before, 0) + 1, 2 * (a - coalesce(before, 0))), '' ORDER BY a) AS kept
            FROM gaps JOIN h USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, len(x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(CASE WHEN n_spans IS NULL THEN x ELSE kept || substr(x, 2 * last + 1) END)) AS kept_sha256
    FROM h LEFT JOIN cut USING (doc_id)
"""
