"""Secrets found through a trigram inverted index."""

from __future__ import annotations

import re
from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import pick, staged


class Rule(NamedTuple):
    kind: str
    pattern: str  # what Java's and Python's regular expressions read alike
    group: int = 0
    least: int = 1  # characters of the group; shorter matches are dropped


BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # A run is matched from its start, so this finds the runs of [0-9a-f]+ that are long enough.
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
# Published forms of credentials.
ADDED = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[0-9A-Za-z_-]+", 0, 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)
MOST_FORMS = 64  # of a pattern that are spelled out; beyond, it is cut at that place

GAP = "\0"  # anything may stand here


def spelled(nodes) -> set[str]:
    """The forms of a parsed pattern, in lower case, with a ``GAP`` for what varies too much."""
    forms = {""}
    for op, value in nodes:
        name = str(op)
        if name == "LITERAL":
            more = {chr(value).lower()}
        elif name == "SUBPATTERN":
            more = spelled(value[3])
        elif name == "BRANCH":
            more = set().union(*map(spelled, value[1]))
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in value):
            more = {chr(v).lower() for _, v in value}
        elif name == "AT":
            more = {""}
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and value[0] > 0:
            more = {form + GAP for form in spelled(value[2])}
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and value[1] == 1:
            more = spelled(value[2]) | {""}
        else:
            more = {GAP}
        crossed = {a + b for a, b in product(forms, more)}
        forms = crossed if len(crossed) <= MOST_FORMS else {form + GAP for form in forms}
    return forms


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """An OR of ANDs of trigrams that each text with a match has; None if there is none."""
    clauses = {
        frozenset(part[i : i + 3] for part in form.split(GAP) for i in range(len(part) - 2))
        for form in spelled(re._parser.parse(pattern))
    }
    if frozenset() in clauses:
        return None
    return sorted((c for c in clauses if not any(o < c for o in clauses)), key=sorted)


def index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings ``trigram, doc_id`` of ``docs`` (``doc_id, text``) for the given trigrams.

    Texts are indexed in lower case, which keeps every ASCII trigram of a match. Only the
    trigrams that a query can ask for are kept, so the index is far smaller than the texts.
    """
    low = docs.select("doc_id", F.lower("text").alias("low"))
    found = F.array_compact(
        F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams))
    )
    return low.select("doc_id", found.alias("found")).select(
        "doc_id", F.explode("found").alias("trigram")
    )


def candidates(postings: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """``doc_id, kinds``: the rules whose Boolean query the postings of a document meet.

    A document is in the intersection of a clause if it has as many of its postings as the
    clause has trigrams. The clauses are a few rows, whatever the data.
    """
    terms = F.array(
        *(
            F.struct(
                F.lit(kind).alias("kind"),
                F.lit(i).alias("clause"),
                F.lit(t).alias("term"),
                F.lit(len(clause)).alias("needed"),
            )
            for kind, clauses in queries.items()
            for i, clause in enumerate(clauses)
            for t in sorted(clause)
        )
    )
    table = postings.sparkSession.range(1).select(F.inline(terms))
    met = (
        postings.join(F.broadcast(table), F.col("trigram") == F.col("term"))
        .groupBy("doc_id", "kind", "clause", "needed")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= F.col("needed"))
    )
    return met.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def spans_of(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's matches as structs ``start, rank, end, kind``, in code points.

    Spark's functions return the matches and what lies between them, but no positions:
    the lengths are added up.
    """
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    parts = F.zip_with(
        F.zip_with(
            F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(matches)),
            matches,
            lambda gap, match: F.struct(
                F.char_length(gap).alias("gap"), F.char_length(match).alias("length")
            ),
        ),
        values,
        lambda p, v: F.struct(p["gap"], p["length"], F.char_length(v).alias("value")),
    )
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")

    def add(done: Column, part: Column) -> Column:
        start = done["at"] + part["gap"]
        span = F.struct(
            start.alias("start"),
            F.lit(rank).alias("rank"),
            (start + part["length"]).alias("end"),
            F.lit(rule.kind).alias("kind"),
        )
        more = F.when(
            part["value"] >= rule.least, F.concat(done["spans"], F.array(span))
        ).otherwise(done["spans"])
        return F.struct((start + part["length"]).alias("at"), more.alias("spans"))

    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.aggregate(parts, start, add, lambda done: done["spans"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + ADDED) -> DataFrame:
    """``doc_id, spans``: all matches of ``rules`` in each row of ``docs``, by start, then rule.

    From each pattern a Boolean trigram query is derived; the index answers it by
    intersecting postings, and only candidates are searched with the pattern. Rules
    without a trigram that every match has (such as hex runs) search all texts. Null
    text is empty and has no spans; rows that repeat an id are searched each; a null id
    is an id; an empty table gives no rows. The texts are not shuffled while the
    candidates are few enough for Spark to broadcast; else they are joined by id.
    """
    rows = pick(docs, doc_id="doc_id", text="text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) is not None}
    kinds = F.array().cast("array<string>")
    if queries:
        trigrams = sorted({t for q in queries.values() for clause in q for t in clause})
        postings = staged(index(rows, trigrams), "postings")
        found = staged(candidates(postings, queries), "candidates")
        found = found.withColumnRenamed("doc_id", "_doc")
        rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
        kinds = F.coalesce(F.col("kinds"), kinds)
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    text = F.col("text")
    found = []
    for rank, rule in enumerate(rules):
        asked = (
            F.array_contains(kinds, F.lit(rule.kind))
            if rule.kind in queries
            else text.rlike(rule.pattern)
        )
        found.append(F.when(asked, spans_of(text, rule, rank)).otherwise(none))
    return rows.select("doc_id", F.array_sort(F.concat(*found)).alias("spans"))


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    scanned = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    spans = F.col("spans")

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(
                spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
            ),
            ",",
        )

    def number(rank: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")

    return scanned.select(
        "doc_id",
        *(number(i).alias(f"n_{rule.kind}") for i, rule in enumerate(BASE)),
        F.sha2(joined(F.filter(spans, lambda s: s["rank"] < len(BASE))), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )


def oracle() -> str:
    """The same by DuckDB's functions on every text, without an index."""

    def listed(rank: int, rule: Rule) -> str:
        pattern = re.sub(  # DuckDB's (?i: folds letters beyond ASCII, too
            r"\(\?i:([^)]*)\)",
            lambda m: "(?:" + re.sub("[a-z]", lambda c: f"[{c[0]}{c[0].upper()}]", m[1]) + ")",
            rule.pattern,
        ).replace("'", "''")
        return f"""
            list_filter(list_transform(range(1, 1 + len(regexp_extract_all(t, '{pattern}', 0))), lambda i: {{
                'start': list_sum(list_transform(regexp_split_to_array(t, '{pattern}')[1:i], lambda x: length(x)))
                    + coalesce(list_sum(list_transform(regexp_extract_all(t, '{pattern}', 0)[1:i-1], lambda x: length(x))), 0),
                'rank': {rank}, 'n': length(regexp_extract_all(t, '{pattern}', 0)[i]),
                'ok': length(regexp_extract_all(t, '{pattern}', {rule.group})[i]) >= {rule.least},
                'kind': '{rule.kind}'}}), lambda s: s.ok)"""

    found = ", ".join(listed(i, r) for i, r in enumerate(BASE + ADDED))
    joined = "list_transform({}, lambda s: s.kind || ':' || CAST(s.start AS BIGINT) || ':' || CAST(s.start + s.n AS BIGINT))"
    base = f"list_filter(found, lambda x: x.rank < {len(BASE)})"
    counts = ", ".join(
        f"CAST(len(list_filter(found, lambda x: x.rank = {i})) AS BIGINT) AS n_{r.kind}" for i, r in enumerate(BASE)
    )
    return f"""
        SELECT doc_id, {counts},
               sha256(coalesce(array_to_string({joined.format(base)}, ','), '')) AS base_sha256,
               coalesce(array_to_string({joined.format("found")}, ','), '') AS spans
        FROM (SELECT doc_id, list_sort(list_concat({found})) AS found
              FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))
    """


ORACLE = oracle()
