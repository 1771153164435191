"""Conversation tries, order fingerprints and periodic runs against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from edges import frame, rows, words
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from llm import order_minhash, periodic_runs, prefix_trie

# Conversations

CONVERSATIONS = StructType(
    [
        StructField("Text", StringType()),
        StructField("conv_id", LongType()),
        StructField("turn", LongType()),
        StructField("role", StringType()),
        StructField("text", StringType()),
        StructField("path", StringType()),
        StructField("shard", StringType()),
        StructField("_c1", StringType()),
    ]
)


def conversations(spark, found):
    return spark.createDataFrame([("x", *row, "p", "s", "c") for row in found], CONVERSATIONS)


def turn_key(row):
    return row[1] is not None, row[1] or 0


def brute_trie(found, rebuilt):
    own = defaultdict(list)
    for row in found:
        if row[0] is not None:
            own[row[0]].append(row)
    own = {c: [(r or "", t or "") for _, _, r, t in sorted(turns, key=turn_key)] for c, turns in own.items()}
    full = own
    if rebuilt:
        heads = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
        full = {c: own.get(c - c % 5, [])[:h] + own[c][h:] for c, h in heads.items()}
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def sums(node):
        parts = [sums(c) for c in children[node]]
        own_saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        return (sum(p[0] for p in parts) or 1 if not parts else sum(p[0] for p in parts)), own_saved + sum(p[1] for p in parts)

    out = set()
    for node, ids in members.items():
        ends = ",".join(map(str, sorted(c for c in ids if len(full[c]) == len(node))))
        leaves, saved = sums(node)
        above = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.add((min(ids), len(node), above, len(ids), len(children[node]), leaves, saved, sha))
    return out


def talk(seed, n):
    draw = random.Random(seed)
    return [
        (c, t, draw.choice(["user", "assistant", None]), draw.choice(["a", "b", "ü" * 9, "", None]))
        for c in draw.sample(range(3 * n), n)
        for t in range(draw.randint(1, 7))
    ]


ODD = [
    (1, None, "user", "before all others"),
    (1, 0, "user", "next"),
    (2, 5, None, None),
    (3, 5, "", ""),
    (3, 5, "", ""),  # a repeated row is a turn of its own
    (None, 0, "user", "of no conversation"),
    (7, 0, "user", words(20_000, 4)),
    (8, 0, "user", words(20_000, 4)),
]
HOT = [(1000 + c, t, "user", f"the same {t}") for c in range(300) for t in range(6)]
DEEP = [(9000 + c, t, "user", "on and on") for c in range(3) for t in range(500)]


@pytest.mark.parametrize("found", [ODD, talk(1, 150) + HOT, talk(2, 40), DEEP, HOT, [(4, 0, "user", "one")]])
def test_trie_equals_brute_force(spark, found):
    for rebuilt in (True, False):
        got = [tuple(r) for r in prefix_trie.prefix_trie(conversations(spark, found), rebuilt).collect()]
        want = brute_trie(found, rebuilt) if found is not DEEP else None
        if want is None:  # too deep for recursion: the figures by hand
            lengths = {9000 + c: 500 for c in range(3)}
            assert len(got) == 501 and {r[3] for r in got} == {len(lengths)} and {r[5] for r in got} == {1}
            assert max(r[6] for r in got) == 500 * 2 * len("on and on")
        else:
            assert len(got) == len(want) and set(got) == want


def test_no_conversation_has_no_node(spark):
    assert prefix_trie.prefix_trie(conversations(spark, []), True).count() == 0


def test_parentheses_close_where_a_stack_closes_them():
    draw = random.Random(5)
    for n in (1, 2, 40, 700):
        found = sorted([draw.randint(0, 2) for _ in range(draw.randint(0, 12))] for _ in range(n))
        flat = np.array([(t, t) for row in found for t in row], np.uint64).reshape(-1, 2)
        trie = prefix_trie.Trie(flat, np.array([len(row) for row in found], np.int64))
        stack, close = [], {}
        for i, opens in enumerate(trie.open.tolist()):
            if opens:
                stack.append(i)
            else:
                close[stack.pop()] = i
        assert not stack and trie.find_close(trie.at).tolist() == [close[i] for i in trie.at.tolist()]
        assert trie.nodes == 1 + len({tuple(row[:d]) for row in found for d in range(1, len(row) + 1)})


def test_shards_share_their_spines(spark):
    found = HOT + talk(9, 60)
    table = conversations(spark, found)
    parts = prefix_trie.sequences(table, False).repartitionByRange(8, "path", "conv_id")
    assert parts.groupBy(F.spark_partition_id()).count().count() > 4  # the hot group is cut
    sums = {r["depth"]: r for r in prefix_trie.prefix_trie(table).filter("conv_id = 1000 OR depth = 0").collect()}
    assert sums[6]["n_convs"] == 300


# Fingerprints


def brute_entries(text):
    points = np.array([ord(c) for c in text], np.uint32)
    hashes = order_minhash.kmers(points)
    seen, ranks = defaultdict(int), []
    for h in hashes.tolist():
        with np.errstate(over="ignore"):
            value = order_minhash.mixed(np.array([h], np.uint64) + np.uint64(seen[h]) * order_minhash._odd)
        ranks.append(int(value[0] >> np.uint64(32)))
        seen[h] += 1
    out = []
    for turn, factor in zip(order_minhash._turns.ravel().tolist(), order_minhash._factors.ravel().tolist()):
        order = sorted(range(len(ranks)), key=lambda i: (((ranks[i] ^ turn) * factor) & 0xFFFFFFFF, i))
        value = np.zeros(1, np.uint64)
        chosen = sorted(order[: order_minhash.TUPLE])
        for slot in range(order_minhash.TUPLE):
            there = slot < len(chosen)
            kmer = hashes[chosen[slot]] if there else np.uint64(0)
            value = order_minhash.mixed(value * order_minhash._odd + kmer + np.uint64(there))
        out.append(int(value[0] >> np.uint64(32)))
    return out


def print_of(text):
    return "".join(f"{x:08x}" for x in brute_entries(text))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_entries_are_the_least_kmers_in_their_order():
    for text in ["", "a", "short", "eight ch", "nine char", "abc" * 40, words(60, 2), "𝒳ü" * 30, "a" * 5000]:
        assert order_minhash.Fingerprint(text).entries.tolist() == brute_entries(text)


def test_texts_that_begin_alike_share_their_head():
    text = words(300, 3)
    for kept in (0, 5, 8, 700, len(text)):
        own = order_minhash.Fingerprint(text, kept)
        new = text[:kept] + words(9, 8)
        assert (own.entries == order_minhash.Fingerprint(text).entries).all()
        edited = order_minhash.Fingerprint(new, kept, own.head)
        assert (edited.entries == order_minhash.Fingerprint(new).entries).all()


def brute_edits(docs):
    def key(row):
        return row[0] is not None, row[0] or 0

    docs = sorted(((d, t or "") for d, t, *_ in docs), key=key)
    out = []
    for (d, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        cut = len(text) // 4
        new = text[: len(text) - cut] + after[:cut]
        one, two, three = (order_minhash.Fingerprint(t).entries for t in (text, new, after))
        names = ["".join(f"{x:08x}" for x in e.tolist()) for e in (one, two)]
        out.append((d, len(text), sha(new), *names, float((one == two).mean()), float((one == three).mean())))
    return out


def order(row):
    return tuple((x is not None, str(x)) for x in row)


def test_edited_texts_equal_brute_force(spark):
    docs = [r for r in rows() if r[0] not in (None, 12)] + [(900 + i, words(3 + i % 50, i), "", "") for i in range(200)]
    random.Random(1).shuffle(docs)
    got = [tuple(r) for r in order_minhash.edited(frame(spark, docs).repartition(5)).collect()]
    assert sorted(got, key=order) == sorted(brute_edits(docs), key=order)
    one = order_minhash.edited(frame(spark, [(5, "a single document stands next to itself", "", "")])).collect()
    assert one[0]["near_next"] == 1.0 and len(one) == 1
    assert order_minhash.edited(frame(spark, [])).count() == 0


def test_every_row_with_a_repeated_or_no_id_gets_a_fingerprint(spark):
    docs = rows() + [(None, words(20, i), None, None) for i in range(90)] + [(50, "the same", "", "")] * 40
    got = order_minhash.edited(frame(spark, docs)).collect()
    assert sorted(r["fingerprint"] for r in got) == sorted(print_of(t or "") if len(t or "") < 999 else str(order_minhash.Fingerprint(t)) for _, t, *_ in docs)


def test_likeness_follows_edits(spark):
    draw, text = random.Random(7), words(400, 11)
    letters = list(text)
    shares = []
    for edits in (0, 10, 60, 400):
        changed = letters[:]
        for i in draw.sample(range(len(changed)), edits):
            changed[i] = "#"
        shares.append(order_minhash.Fingerprint(text).likeness(order_minhash.Fingerprint("".join(changed))))
    assert shares[0] == 1 and shares == sorted(shares, reverse=True) and shares[-1] < 0.1
    half = len(text) // 2  # the same k-mers in another order
    moved = order_minhash.Fingerprint(text[half:] + text[:half])
    assert 0.3 < order_minhash.Fingerprint(text).likeness(moved) < 0.75
    prints = order_minhash.fingerprints(frame(spark, [(1, text, "", ""), (2, "".join(changed), "", "")]))
    pair = prints.agg(F.max_by("fingerprint", "doc_id").alias("a"), F.min_by("fingerprint", "doc_id").alias("b"))
    assert pair.select(order_minhash.likeness("a", "b").alias("x")).collect()[0]["x"] == shares[-1]


# Runs


def brute_runs(found):
    n, out = len(found), []
    for p in range(1, n // 4 + 1):
        i = 0
        while i < n - p:
            if found[i] != found[i + p]:
                i += 1
                continue
            j = i
            while j < n - p and found[j] == found[j + p]:
                j += 1
            size = j - i + p
            if size >= max(6, 4 * p) and not any(found[i : i + size - q] == found[i + q : i + size] for q in range(1, p)):
                out.append([i, size, p])
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    draw = random.Random(3)
    for case in range(300):
        unit = [draw.randint(0, 1 + case % 4) for _ in range(draw.randint(1, 9))]
        noise = [draw.randint(0, 2) for _ in range(draw.randint(0, 30))]
        found = noise + unit * draw.randint(1, 12) + unit[: draw.randint(0, len(unit))] + noise * draw.randint(0, 5)
        assert periodic_runs.runs(np.array(found, np.int64)).tolist() == brute_runs(found)
    assert periodic_runs.runs(np.zeros(0, np.int64)).tolist() == []
    assert periodic_runs.runs(np.zeros(5000, np.int64)).tolist() == [[0, 5000, 1]]


def by_hand_runs(doc_id, text):
    split = [w.decode() for w in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and split:
        n, g = len(split), h // 10
        a = g % n
        split = [w if i < a else split[a + (i - a) % (1 + (n - a) // (3 + g % 8))] for i, w in enumerate(split)]
    found = brute_runs(split)
    gone = {i for s, size, p in found for i in range(s + p, s + size)}
    longest = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    shown = (*longest, 1000 * longest[1] // longest[2]) if longest else (None,) * 4
    listed = "".join(f"{s},{size},{p}\n" for s, size, p in found)
    return (doc_id, len(found), *shown, sha(listed), sha(" ".join(w for i, w in enumerate(split) if i not in gone)), len(split))


def test_documents_runs_equal_brute_force(spark):
    docs = [r for r in rows() if len(r[1] or "") < 5000]
    docs += [(2000 + i, words(4 + i % 40, i), None, None) for i in range(120)]
    docs += [(5000 + i, ("la " * i + words(6, i)) * (i % 5), None, None) for i in range(40)]
    docs += [(6000, "a\x1fb a\x1fb\tc d\x0b" * 9, None, None)]
    got = [tuple(r) for r in periodic_runs.periodic_runs(frame(spark, docs), rebuilt=True).collect()]
    assert sorted(got, key=order) == sorted((by_hand_runs(d, t) for d, t, *_ in docs), key=order)
    assert sum(r[1] > 0 for r in got) > 40
    assert periodic_runs.periodic_runs(frame(spark, [])).count() == 0


def test_a_very_long_text(spark):
    unit = words(70_000, 5)
    got = periodic_runs.periodic_runs(frame(spark, [(1, f"{unit} " * 4, "", "")])).collect()[0]
    assert (got["n_runs"], got["start"], got["length"], got["period"]) == (1, 0, 280_000, 70_000)
