"""Periodic runs of words, by a dictionary of basic factors."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import pick

LEAST = 6  # words of a run
TIMES = 4  # periods of a run


def word_numbers(words: list[bytes]) -> np.ndarray:
    """A number for each word, the same for equal ones."""
    found = pc.dictionary_encode(pa.array(words, pa.large_binary()))
    return found.indices.to_numpy().astype(np.int64)


def runs(word: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows ``start, length, period`` of all runs of ``word``, by start, then period.

    The dictionary of basic factors names, for each length that is a power of two, the
    factors of that length: two have one name if their halves have. Of a factor that
    occurs twice within twice its length, the next occurrence proposes the distance as a
    period. Where this happens at places in a row, the proposals are one progression,
    which extends to its last occurrence's end. A distance above half the factor's length
    is its smallest period there, and the progression can't be extended further, as the
    place before or after would be one of it. A lesser distance is proposed again, by the
    shorter factors, so each run is kept once, from its own length. Only names that recur
    go on to the next length, so texts without repeats end after few steps. Memory is some
    hundred bytes a word.
    """
    n, found = len(word), []
    place, name, length = np.arange(n), word, 1
    while len(place) and (length // 2 + 1) * times <= n:
        order = np.argsort(name, kind="stable")  # places of a name in rising order
        at, ranked = place[order], name[order]
        same = ranked[1:] == ranked[:-1]
        gap = at[1:] - at[:-1]
        proposed = same & (gap <= length) & (2 * gap > length)
        first, period = at[:-1][proposed], gap[proposed]
        if len(first):
            order = np.lexsort((first, period))
            first, period = first[order], period[order]
            new = np.flatnonzero(np.r_[True, (first[1:] != first[:-1] + 1) | (period[1:] != period[:-1])])
            last = np.r_[new[1:], len(first)] - 1
            start, period = first[new], period[new]
            size = first[last] + period + length - start
            kept = size >= np.maximum(least, times * period)
            found.append(np.stack([start[kept], size[kept], period[kept]], 1))
        # A factor of twice the length is a pair of names, both of which recur.
        again = np.r_[False, same] | np.r_[same, False]
        names = np.full(n, -1)
        names[at[again]] = np.cumsum(np.r_[True, ~same])[again]
        place = np.flatnonzero((names[: max(n - length, 0)] >= 0) & (names[length:] >= 0))
        name = names[place] * (n + 1) + names[place + length]
        length *= 2
    rows = np.concatenate([np.zeros((0, 3), np.int64), *found])
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def collapsed(n: int, found: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay: all but those behind the first period of a run."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, found[:, 0] + found[:, 2], 1)
    np.add.at(edges, found[:, 0] + found[:, 1], -1)
    return np.cumsum(edges)[:n] == 0


def planted(n: int, doc_id: int | None) -> np.ndarray | None:
    """Numbers of the words that a document's are rebuilt from; None if it stays as it is."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


RESULT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long,"
    " runs_sha256 string, collapsed_sha256 string, n_words long"
)


def periodic_runs(docs: DataFrame, rebuilt: bool = False) -> DataFrame:
    """The runs of each row of ``docs``: their number, the longest, hashes, ``n_words``.

    Words are parted by ASCII white space. ``rebuilt`` plants repeats in a tenth of the
    documents by their id, as ``planted`` says. A null text is empty; empty texts and texts
    without words have no run, the hash of nothing, and nulls for the longest run. Of runs of equal
    length the first, then that of the smaller period is the longest. Rows are judged each
    for itself, so repeated rows and ids give repeated results; a null id is passed on and
    plants nothing. Very long texts are read whole. An empty table gives no rows.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                words = text.as_buffer().to_pybytes().split()
                number = word_numbers(words)
                if rebuilt and (source := planted(len(words), doc_id)) is not None:
                    words, number = [words[i] for i in source.tolist()], number[source]
                found = runs(number)
                longest = (None,) * 4
                if len(found):
                    start, length, period = found[np.lexsort((found[:, 2], found[:, 0], -found[:, 1]))[0]].tolist()
                    longest = (start, length, period, 1000 * length // period)
                    words = [words[i] for i in np.flatnonzero(collapsed(len(words), found)).tolist()]
                listed = "".join(f"{s},{size},{p}\n" for s, size, p in found.tolist())
                hashes = (hashlib.sha256(x).hexdigest() for x in (listed.encode(), b" ".join(words)))
                out.append((doc_id, len(found), *longest, *hashes, len(number)))
            kinds = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.int64()]
            names = [part.split()[0] for part in RESULT.split(",")]
            columns = zip(*out) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    rows = pick(docs, doc_id="doc_id", text="text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.mapInArrow(judge, RESULT)


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    return periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), rebuilt=True)


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string, bit by bit."""
    shift = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"list_reduce([xor(a, b)] || range(8), lambda x, y: {shift})"
    codes = f"list_transform(range(1, length({text}) + 1), lambda k: CAST(ascii(substr({text}, k, 1)) AS BIGINT))"
    return f"xor(list_reduce([CAST(4294967295 AS BIGINT)] || {codes}, lambda a, b: {byte}), 4294967295)"


ORACLE = f"""
    WITH originals AS (
        SELECT doc_id, {crc32_sql("CAST(doc_id AS VARCHAR)")} AS h,
               regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS o
        FROM documents
    ), planted AS (
        SELECT *, (h // 10) % n AS a, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) AS p
        FROM (SELECT *, len(o) AS n FROM originals) WHERE n > 0
    ), words AS (
        SELECT doc_id, n, i,
               o[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS w
        FROM (SELECT *, unnest(range(n)) AS i FROM planted)
    ), equal AS (
        SELECT x.doc_id, y.i - x.i AS q, x.i
        FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.w = y.w
             AND y.i > x.i AND y.i - x.i <= x.n // {TIMES}
    ), stretches AS (
        SELECT doc_id, q, min(i) AS s, count(*) + q AS size
        FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM equal)
        GROUP BY doc_id, q, part HAVING count(*) + q >= greatest({LEAST}, {TIMES} * q)
    ), found AS (
        SELECT * FROM stretches x WHERE NOT EXISTS (
            SELECT 1 FROM stretches y WHERE y.doc_id = x.doc_id AND y.q < x.q
            AND y.s <= x.s AND y.s + y.size >= x.s + x.size)
    ), listed AS (
        SELECT doc_id, count(*) AS n_runs,
               string_agg(s || ',' || size || ',' || q || chr(10), '' ORDER BY s, q) AS list
        FROM found GROUP BY doc_id
    ), longest AS (
        SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY size DESC, s, q) = 1
    ), dropped AS (
        SELECT DISTINCT doc_id, unnest(range(s + q, s + size)) AS i FROM found
    ), kept AS (
        SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text
        FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
    )
    SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, size AS length, q AS period,
           1000 * size // q AS exponent_milli, sha256(coalesce(list, '')) AS runs_sha256,
           sha256(coalesce(kept.text, '')) AS collapsed_sha256, len(o) AS n_words
    FROM originals d LEFT JOIN listed USING (doc_id) LEFT JOIN longest USING (doc_id)
         LEFT JOIN kept USING (doc_id)
"""
