"""Language identification by averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import pick

BITS = 14  # of a subword's hash
WIDTH = 16  # of an embedding
SAMPLED = 768  # different labelled documents of each language, at most, a third of them for calibration
EPOCHS = 30
RATE = 20.0
RARE = 1e-6  # share that every subword has at least
REJECTED = 0.001  # share of the known languages' documents that calibration gives up
SLACK = 5.0  # over the root of the rows aside: of the way from their median to that share, which the floor lies lower
PIECE = 1 << 20  # characters of a text that are hashed at a time
UNKNOWN = "und"

# Letters stay, in lower case; bytes of other scripts stay; all else parts words.
LETTERS = np.full(256, 32, np.uint8)
LETTERS[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
LETTERS[128:] = np.arange(128, 256)


class Model(NamedTuple):
    languages: list[str]
    table: np.ndarray  # subword -> logits (the embeddings times the softmax layer) and commonness
    bias: np.ndarray
    heat: float  # temperature of the calibrated probabilities
    floor: float  # texts of a lower commonness are rejected


def subwords(text: str) -> Iterator[np.ndarray]:
    """Hashes of all 2- to 4-byte grams of the words of ``text``, edges included."""
    for at in range(0, max(len(text), 1), PIECE):
        raw = np.frombuffer((" " + text[at : at + PIECE].lower() + " ").encode(), np.uint8)
        b = LETTERS[raw]
        space = b == 32
        keep = ~space
        keep[1:] |= ~space[:-1]
        b, space = b[keep].astype(np.uint32), space[keep]
        whole = np.ones(max(len(b) - 1, 0), bool)
        h = b
        for n in (2, 3, 4):
            if len(b) < n:
                break
            h = h[: len(b) - n + 1] * np.uint32(0x01000193) + b[n - 1 :]
            if n > 2:  # no space inside
                whole = whole[: len(b) - n + 1] & ~space[n - 2 : len(b) - 1]
            yield ((h[whole[: len(h)]] ^ np.uint32(n * 0x3C6EF372)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


def logits(texts: pd.Series, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Mean logits and mean commonness over the subwords of each text."""
    out = np.zeros((len(texts), len(model.languages) + 1))
    for i, text in enumerate(texts):
        n = 0
        for part in subwords(text):
            # Counts first: a long text has few different subwords.
            counts = np.bincount(part, minlength=1 << BITS) if len(part) > 1 << BITS else None
            out[i] += model.table[part].sum(0) if counts is None else counts @ model.table
            n += len(part)
        out[i] /= max(n, 1)
    return out[:, :-1] + model.bias, out[:, -1]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def dense(rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Subword shares of a few documents, given as places and values."""
    x = np.zeros((len(rows), 1 << BITS), np.float32)
    for i, (at, share) in enumerate(rows):
        x[i, at] = share
    return x


def fit(shares: list[tuple], y: np.ndarray, languages: list[str], seed: int = 7) -> Model:
    """A model of subword ``shares`` with classes ``y``, by stochastic gradient descent.

    A third of each language's rows is kept aside for calibration: the temperature with the least log
    loss, and the floor. A probability can't tell an unknown language, as the known ones
    share all of it. What can is how common a text's subwords are: a subword's commonness is
    the logarithm of its share in the language that has most of it, so a text of two known
    languages is as common as one of either. The floor is the mean commonness that only
    ``REJECTED`` of the rows aside fall short of, and the lower the fewer they are.
    Without rows aside nothing is rejected.
    """
    random, k = np.random.default_rng(seed), len(languages)
    order = random.permutation(len(y))
    place = np.zeros(len(y), int)  # of a row among its language's
    for c in range(k):
        place[order[y[order] == c]] = np.arange(np.sum(y == c))
    aside, own = order[place[order] % 3 == 2], order[place[order] % 3 != 2]
    emb = random.uniform(-1 / WIDTH, 1 / WIDTH, (1 << BITS, WIDTH)).astype(np.float32)
    out, bias = np.zeros((WIDTH, k), np.float32), np.zeros(k, np.float32)
    steps = 0
    for _ in range(EPOCHS):
        random.shuffle(own)
        for at in range(0, len(own), 32):
            rows = own[at : at + 32]
            rate = RATE * (1 - steps / (EPOCHS * (len(own) // 32 + 1)))
            x = dense([shares[i] for i in rows])
            hidden = x @ emb
            wrong = softmax(hidden @ out + bias)
            wrong[np.arange(len(rows)), y[rows]] -= 1
            wrong = (wrong / len(rows)).astype(np.float32)
            emb -= rate * (x.T @ (wrong @ out.T))
            out -= rate * (hidden.T @ wrong)
            bias -= 0.1 * wrong.sum(0)
            steps += 1
    table = emb @ out
    common = np.zeros((k, 1 << BITS))
    for i in own:
        common[y[i], shares[i][0]] += shares[i][1]
    common = np.log((common / np.maximum(common.sum(1, keepdims=True), RARE)).max(0) + RARE)
    z = np.array([share @ table[at] for at, share in (shares[i] for i in aside)]).reshape(-1, k) + bias
    heats = np.geomspace(0.05, 20, 60)
    loss = [-np.log(softmax(z / t)[np.arange(len(z)), y[aside]] + 1e-12).mean() if len(z) else 0 for t in heats]
    heat = float(heats[int(np.argmin(loss))]) if len(z) else 1.0
    floor = -np.inf
    if len(aside):
        low, middle = np.quantile([share @ common[at] for at, share in (shares[i] for i in aside)], [REJECTED, 0.5])
        floor = float(low - SLACK / np.sqrt(len(aside)) * (middle - low))
    table = np.column_stack([table, common]).astype(np.float32)
    return Model(languages, table, bias, heat, floor)


def held_out() -> Column:
    """Whether a document is never learned from; a null id counts as no text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame) -> Model:
    """A model of the labelled documents (``doc_id, text, lang``) that are not held out.

    It is fitted on a bounded sample: of each language at most ``SAMPLED`` different
    documents, by the order of a hash of id and text, and always the least, so no language
    is lost. Rows that repeat both count once; one document alone teaches little. Executors hash their whole texts; what
    reaches the driver are at most ``2**BITS`` counts a document.
    """
    own = pick(docs, doc_id="doc_id", text="text", lang="lang")
    own = own.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    own = own.select("lang", "text", F.xxhash64("doc_id", "text").alias("name"))
    place = F.pmod(F.col("name"), F.lit(1 << 40))
    sizes = own.groupBy("lang").agg(F.approx_count_distinct("name").alias("n"), F.min(place).alias("least")).collect()
    if not sizes:
        return Model([], np.zeros((1 << BITS, 1), np.float32), np.zeros(0), 1.0, 0.0)
    # Half as many again, since numbers are estimates. One row for each language, as in the model.
    ends = [(r["lang"], max(r["least"], int(min(1.0, 1.5 * SAMPLED / r["n"]) * (1 << 40)))) for r in sizes]
    ends = docs.sparkSession.createDataFrame(ends, "lang string, end long")
    chosen = own.withColumn("place", place).join(F.broadcast(ends), "lang").filter("place <= end")

    def counted(batches):
        met = set()  # copies of a document are hashed once a task
        for batch in batches:
            rows = []
            for lang, place, name, text in zip(batch["lang"], batch["place"], batch["name"], batch["text"]):
                if (lang, name) in met:
                    continue
                met.add((lang, name))
                counts = np.zeros(1 << BITS, np.int64)
                for part in subwords(text):
                    counts += np.bincount(part, minlength=1 << BITS)
                at = np.flatnonzero(counts)
                value = (counts[at] / max(counts.sum(), 1)).astype(np.float32)
                rows.append((lang, place, name, at.astype(np.uint16).tobytes(), value.tobytes()))
            yield pd.DataFrame(rows, columns=["lang", "place", "name", "at", "share"])

    sample = chosen.select("lang", "place", "name", "text").mapInPandas(
        counted, "lang string, place long, name long, at binary, share binary"
    )
    rows = sample.dropDuplicates(["lang", "name"]).collect()
    taken: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["place"], r["name"])):
        if len(taken.setdefault(r["lang"], [])) < SAMPLED:
            taken[r["lang"]].append(r)
    languages = sorted(taken)
    y = np.repeat(np.arange(len(languages)), [len(taken[lang]) for lang in languages])
    shares = [
        (np.frombuffer(r["at"], np.uint16), np.frombuffer(r["share"], np.float32))
        for lang in languages
        for r in taken[lang]
    ]
    return fit(shares, y, languages)


def predicted(text: Column, model: Model) -> Column:
    """Struct ``lang, score, rejected`` of a whole text; null or letterless text is ``und``."""

    @F.pandas_udf("lang string, score double, rejected boolean")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            z, common = logits(texts, model)
            best = z.argmax(1)
            yield pd.DataFrame(
                {
                    "lang": np.array(model.languages, object)[best],
                    "score": softmax(z / model.heat).max(1),
                    "rejected": common < model.floor,
                }
            )

    unknown = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    if not model.languages:
        return unknown
    # Python sees every row; what has no letter is decided here.
    guess = F.struct(classify(F.coalesce(text, F.lit(""))).alias("guess"))["guess"]
    known = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    return F.when(known, guess).otherwise(unknown)


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for each row of ``docs``.

    Null labels teach nothing; without any label all is ``und``. ``und`` has score 0 and
    is rejected. An empty table gives no rows; repeated rows are judged each. A text of any
    length counts whole, hashed a piece at a time; of equal logits the first language wins.
    """
    rows = pick(docs, doc_id="doc_id", text="text", lang="lang").withColumn(
        "doc_id", F.col("doc_id").cast("long")
    )
    model = train(rows)
    judged = rows.select("doc_id", held_out().alias("held_out"), predicted(F.col("text"), model).alias("p"))
    return judged.select(
        "doc_id",
        "held_out",
        F.col("p.lang").alias("lang_pred"),
        F.col("p.score").alias("score"),
        F.col("p.rejected").alias("rejected"),
    )


def known_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose language the model does not reject.

    Null and letterless texts go, each of repeated rows is judged alike; further columns,
    also of clashing names, stay. Without any label no row is left.
    """
    model = train(docs)
    names = docs.columns
    plain = docs.toDF(*(f"_c{i}" for i in range(len(names))))
    text = F.col(f"_c{names.index('text')}")
    return plain.filter(~predicted(text, model)["rejected"]).toDF(*names)


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
