"""Documents packed into token sequences by linear grouping, then best fit."""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import pick, prefix_sums, staged

CAPACITY = 4096
END = 1  # id that closes a document
SMALL = CAPACITY // 8  # pieces up to this length are left to best fit
GROUPS = 128  # of large pieces; bounds what the driver optimises
DEALT = 30_000  # pieces and open sequences in a task of the best fit
CACHED = 1_000_000  # words whose ids a worker remembers
AT_ONCE = 10_000  # words that go to the tokenizer together
JOINED = 100  # words in one of its texts
TEXT = 1 << 23  # bytes of text whose words are numbered at once


def binary(ends: np.ndarray, ids: np.ndarray) -> pa.Array:
    """Ids as little-endian bytes, parted after the given numbers of ids."""
    offsets = np.concatenate([[0], 4 * ends.astype(np.int64)])
    held = [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u4"))]
    return pa.Array.from_buffers(pa.large_binary(), len(ends), held)


class Words:
    """Ids of words between white space, as little-endian bytes, by the real tokenizer.

    The tokenizer drops white space, and neither its normaliser nor its patterns look
    across it, so words are encoded apart and remembered. It lower-cases letters, and
    parts them from full stops and commas, so both is done before, and a word has fewer forms.
    Words of plain letters and marks share a text: the tokenizer parts them into runs, and
    the last id of a run is one of those that end a word.
    """

    # The tokenizer's runs, and the words that have no other letters and marks than these.
    RUN = "'s|'t|'re|'ve|'m|'ll|'d|[a-zÀ-ÖØ-öø-ÿ]+|[0-9]|[^a-z0-9À-ÖØ-öø-ÿ]+"
    PLAIN = "^[!-@\\[-~À-ÖØ-öø-ÿ]*$"
    # What Python takes for white space and the tokenizer doesn't, and the tokenizer's own marks.
    WHOLE = "[\x1c-\x1f]|<\\|"
    # A letter, but not the one whose lower case ends in a mark; stops; the end of the word.
    STOPS = r"([^\PL\x{130}])([.,]+)(\s|$)"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known, self.codes = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def encoded(self, texts: list[str], each: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts, of ``each`` words, one after the other, and where each ends."""
        found, step = [np.empty(0, "<u4")], AT_ONCE // each
        for at in range(0, len(texts), step):
            batch = self.tokenizer.encode_batch_fast(texts[at : at + step], add_special_tokens=False)
            found += [np.array(f.ids, "<u4") for f in batch]
        return np.concatenate(found), np.cumsum([len(f) for f in found[1:]], dtype=np.int64)

    def apart(self, words: pa.Array) -> pa.Array:
        ids, ends = self.encoded(words.to_pylist())
        return binary(ends, ids)

    def together(self, words: pa.Array) -> pa.Array:
        """The ids of plain words, ``JOINED`` of them in a text."""
        listed = words.to_pylist()
        joined = [" ".join(listed[i : i + JOINED]) for i in range(0, len(listed), JOINED)]
        ids, _ = self.encoded(joined, JOINED)
        runs = np.cumsum(pc.count_substring_regex(words, self.RUN).to_numpy(), dtype=np.int64)
        closed = np.concatenate([[0], np.flatnonzero(self.closing[ids]) + 1])
        if len(closed) - 1 != (runs[-1] if len(runs) else 0):  # a tokenizer with other runs
            return self.apart(words)
        return binary(closed[runs], ids)

    def of(self, words: pa.Array) -> pa.Array:
        """The ids of each of the different words; new ones go to the tokenizer together."""
        words = words.cast(pa.large_string())
        # Known words are looked up among the few of now: a table of all known ones would be large.
        among = pc.fill_null(pc.index_in(self.known, value_set=words), -1).to_numpy()
        at, met = np.full(len(words), -1), np.flatnonzero(among >= 0)
        at[among[met]] = met
        place = np.flatnonzero(at < 0)
        plain = pc.match_substring_regex(words.take(pa.array(place)), self.PLAIN).to_numpy(zero_copy_only=False)
        place = np.concatenate([place[plain], place[~plain]])
        at[place] = len(self.known) + np.arange(len(place))
        new, n = words.take(pa.array(place)), int(plain.sum())
        ids = pa.concat_arrays([self.together(new.slice(0, n)), self.apart(new.slice(n))])
        found = pa.concat_arrays([self.codes, ids]).take(pa.array(at))
        if len(self.known) + len(new) > CACHED:  # only what is in use stays
            known, codes = words, found
        else:
            known, codes = pa.concat_arrays([self.known, new]), pa.concat_arrays([self.codes, ids])
        short = pc.less_equal(pc.utf8_length(known), 64)
        if not pc.all(short).as_py():
            known, codes = known.filter(short), codes.filter(short)
        self.known, self.codes = known, codes
        return found

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each closed by ``END``, one after the other, and where each ends.

        The words of all texts are numbered by Arrow; only different ones are looked up, and
        the ids are gathered by number.
        """
        whole = pc.match_substring_regex(texts, self.WHOLE)
        lower = pc.ascii_lower(pc.if_else(whole, "", texts))
        lists = pc.utf8_split_whitespace(pc.replace_substring_regex(lower, self.STOPS, r"\1 \2\3"))
        after = lists.offsets.to_numpy().astype(np.int64)
        after -= after[0]
        coded = pc.dictionary_encode(lists.flatten())
        words = len(coded.dictionary)
        number = np.insert(coded.indices.to_numpy(), after[1:], words)  # each text's end
        rows = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        number[after[rows] + rows] = words + 1 + np.arange(len(rows))  # the row's only word
        end = binary(np.array([1]), np.array([END]))
        codes = [self.of(coded.dictionary), end, self.apart(texts.take(pa.array(rows)))]
        gathered = pa.concat_arrays(codes).take(pa.array(number))
        _, offsets, held = gathered.buffers()
        ends = np.frombuffer(offsets, np.int64)[after[1:] + np.arange(1, len(texts) + 1)] // 4
        return np.frombuffer(held, "<u4", ends[-1] if len(ends) else 0), ends


@functools.cache
def words_of(tokenizer: str) -> Words:
    """A worker's words, kept for its later tasks."""
    return Words(tokenizer)


def parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``TEXT`` bytes, or of one row."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32 if pa.types.is_string(texts.type) else np.int64)
    after = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(after, after[first] + TEXT, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, last
        first = last


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: the ids of each row, cut if too long."""

    def of(words: Words, texts: pa.Array, first: int) -> list[tuple]:
        ids, ends = words.ids(texts)
        held, start, out = memoryview(ids).cast("B"), 0, []
        for row, end in enumerate(ends.tolist(), first):
            for piece, at in enumerate(range(start, end, capacity)):
                length = min(capacity, end - at)
                out.append((row, piece, at - start, length, zlib.crc32(held[4 * at : 4 * (at + length)])))
            start = end
        return out

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(tokenizer)
        for batch in batches:
            out = []
            for first, last in parts(batch["text"]):
                out += of(words, batch["text"].slice(first, last - first), first)
                # Else what Arrow has freed stays with the worker, also in all later stages.
                pa.default_memory_pool().release_unused()
            row, piece, *rest = np.array(out, np.int64).reshape(-1, 5).T
            columns = [batch["doc_id"].take(pa.array(row)), pa.array(piece, pa.int32())]
            del batch  # before the next one is read
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(r) for r in rest], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )
        pa.default_memory_pool().release_unused()

    rows = pick(docs, doc_id="doc_id", text="text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Fillings ``{class: pieces}`` and how many sequences use each, until none is left.

    Each holds a piece of the largest size left and the fullest rest, found by a subset
    sum over all sizes (sets of sums as bits of one number), and is used as often as its
    pieces last, so there are about as many fillings as sizes, whatever the counts.
    """
    left, chosen = list(counts), []
    order = sorted(range(len(sizes)), key=lambda c: sizes[c])
    while True:
        live = [c for c in order if left[c]]
        if not live:
            return chosen
        top = live[-1]
        room = capacity - sizes[top]
        fits = [c for c in live if sizes[c] <= room]
        full = (1 << (room + 1)) - 1
        sums = [1]
        for c in fits:
            now = sums[-1]
            for j in range(1, min(left[c] - (c == top), room // sizes[c]) + 1):
                now |= sums[-1] << (j * sizes[c])
            sums.append(now & full)
        at, use = sums[-1].bit_length() - 1, {top: 1}
        for i in range(len(fits) - 1, -1, -1):
            c, j = fits[i], 0
            most = min(left[c] - (c == top), at // sizes[c])
            for n in range(most, -1, -1):  # as many large pieces as the sum allows
                if sums[i] >> (at - n * sizes[c]) & 1:
                    j = n
                    break
            if j:
                use[c] = use.get(c, 0) + j
                at -= j * sizes[c]
        times = min(left[c] // n for c, n in use.items())
        for c, n in use.items():
            left[c] -= n * times
        chosen.append((use, times))


def plan(histogram: dict[int, int], capacity: int, small: int) -> tuple[list[tuple[int, int, int]], int, int]:
    """Where pieces go by their place in the order of falling length.

    Returns runs ``(first place, pieces a sequence, first sequence)``, the number of
    sequences and the number of pieces placed. Whole pieces fill a sequence each. The
    other large ones are parted into groups of equal cardinality, their lengths rounded
    up to the group's largest, and the few sizes left are arranged in configurations.
    """
    whole = histogram.get(capacity, 0)
    large = sum(n for length, n in histogram.items() if small < length < capacity)
    runs = [(0, 1, 0)] if whole else []
    each = -(-large // GROUPS) or 1
    firsts, place = [], 0
    for length in sorted((x for x in histogram if small < x < capacity), reverse=True):
        place += histogram[length]
        while len(firsts) * each < place:
            firsts.append(length)
    counts = [min(each, large - i * each) for i in range(len(firsts))]
    taken, sequence = [whole + i * each for i in range(len(firsts))], whole
    for use, times in configurations(firsts, counts, capacity):
        for c, n in use.items():
            runs.append((taken[c], n, sequence))
            taken[c] += n * times
        sequence += times
    return sorted(runs), sequence, whole + large


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    small: int = SMALL,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for each piece.

    A null text is empty, its document the closing id alone; repeated rows are packed
    each; an empty table gives no rows. The driver sees only the histogram of lengths (at
    most ``capacity`` rows) and plans by classes; a piece finds its sequence by its exact
    place in the order of lengths. Small pieces and the open sequences are then dealt out
    evenly and packed by best fit, longest first, in tasks of about ``DEALT`` rows, each of
    which leaves one sequence partly filled at most.
    """
    tokenizer = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    cut = staged(pieces(docs, tokenizer, capacity), "pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    runs, sequences, placed = plan(histogram, capacity, small)
    ranked = prefix_sums(
        cut.withColumn("_falling", -F.col("length")),
        ["_falling", "doc_id", "piece", "ids_crc32"],
        "_place",
        None,
        "by-length",
    ).drop("_falling")
    first, each, start = (np.array(x, np.int64) for x in zip(*(runs or [(0, 1, 0)])))

    @F.pandas_udf("long")
    def sequence(place: pd.Series) -> pd.Series:
        at = np.searchsorted(first, place.to_numpy(), "right") - 1
        return pd.Series(start[at] + (place.to_numpy() - first[at]) // each[at])

    large = staged(
        ranked.filter(F.col("_place") < placed).withColumn("sequence_id", sequence("_place")), "large"
    )
    left = ranked.filter(F.col("_place") >= placed)
    open_ones = (
        large.groupBy("sequence_id")
        .agg((F.lit(capacity) - F.sum("length")).alias("length"))
        .filter(F.col("length") > 0)
    )
    tasks = max(1, (sum(histogram.values()) - placed + sequences) // DEALT)
    dealt = left.withColumn("sequence_id", F.lit(None).cast("long")).unionByName(
        open_ones, allowMissingColumns=True
    )
    dealt = dealt.withColumn(
        "_task", F.coalesce(F.col("sequence_id"), F.col("_place")) % F.lit(tasks).cast("long")
    )

    def best_fit(key: tuple, rows: pa.Table) -> pa.Table:
        is_open = pc.is_valid(rows["sequence_id"])
        opened = rows.filter(is_open).sort_by([("sequence_id", "descending")])
        small_ones = rows.filter(pc.invert(is_open)).sort_by("_place")
        by_room: dict[int, list[int]] = {}
        rooms = 0  # bit r: a sequence with r places left
        for name, room in zip(opened["sequence_id"].to_pylist(), opened["length"].to_pylist()):
            by_room.setdefault(room, []).append(name)
            rooms |= 1 << room
        fresh, out = sequences + key[0].as_py(), []
        for length in small_ones["length"].to_pylist():
            above = rooms >> length
            if above:
                room = length + (above & -above).bit_length() - 1
                name = by_room[room].pop()
                if not by_room[room]:
                    rooms &= ~(1 << room)
            else:
                room, name, fresh = capacity, fresh, fresh + tasks
            out.append(name)
            if room > length:
                by_room.setdefault(room - length, []).append(name)
                rooms |= 1 << (room - length)
        return small_ones.select(names[:-1]).append_column("sequence_id", pa.array(out, pa.int64()))

    names = large.columns
    fitted = dealt.groupBy("_task").applyInArrow(best_fit, large.schema)
    inside = (
        Window.partitionBy("sequence_id").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum("length").over(inside), F.lit(0).cast("long"))
    return (
        large.unionByName(fitted)
        .withColumn("offset", offset)
        .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    )


def op5_grouped_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
