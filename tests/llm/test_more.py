import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from edges import frame, rows, words
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from llm import common, grouped_packing, metric_tree, warc_index, weighted_minhash

# Packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


TEXTS = [
    "It's  THE end\tof ΑΣ İstanbul's 12,345 words\x1cand \x0b more…  don't 're",
    "<|endoftext|> in a text <|startoftext|>x and é é ﬁ   line",
    "ab'S cd'LL 'tis a_b-c 𝒳𝒴 ½²Ⅷ \x1f\x85",
]


def test_words_give_the_tokenizers_own_ids(tokenizer):
    encoder = grouped_packing.Words(public_tokenizers.path("word_bpe_49k.json"))
    draw = random.Random(2)
    marks = ["a", "É", "ß", "ſ", ".", ",", "..", "'s", "'", " ", "\n", "\x0b", "\xa0", "Z", "9", "é", "Σ", "İ", "…", "日", "-", "<", "|", "½", "\u0301"]
    mixed = ["".join(draw.choices(marks, k=draw.randint(1, 30))) for _ in range(3000)]
    megabyte = ["x" * 1_000_000 + " y", "é." * 300_000, ", " * 200_000]
    texts = TEXTS + [t or "" for _, t, _, _ in rows()] + mixed + megabyte
    ids, ends = encoder.ids(pa.array(texts))
    for text, got in zip(texts, np.split(ids, ends[:-1]), strict=True):
        assert got.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
    assert encoder.ids(pa.array([], pa.string()))[0].tolist() == []
    sliced = pa.array(texts).slice(2, 9)
    assert encoder.ids(sliced)[0].tolist() == ids[ends[1] : ends[10]].tolist()


def test_words_share_texts_and_are_kept_for_later_tasks(tokenizer, monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [" ".join(f"wörd{i}x's a{'b' * (i % 90)}" for i in range(at, at + 400)) for at in (0, 300, 600)]
    texts.append("\u0417\u0434\u0440\u0430\u0432\u043e wörd1x's \xad\xd7 \xaa \xb5. caf\u00c9 cafe\u0301 A's'S ''t's 'rex")
    want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    for cached in (1_000_000, 300, 0):
        monkeypatch.setattr(grouped_packing, "CACHED", cached)
        encoder, sent = grouped_packing.Words(path), []

        class Counted:
            def encode_batch_fast(self, batch, **options):
                sent.extend(batch)
                return tokenizer.encode_batch_fast(batch, **options)

        encoder.tokenizer = Counted()
        for _ in range(2):
            for text, ids in zip(texts, want, strict=True):
                assert encoder.ids(pa.array([text]))[0].tolist() == ids
            if cached == 1_000_000:
                assert len(sent) < 80  # of some 1400 words; those of over 64 letters are not kept
                assert not any(t.startswith("wörd1x") for t in sent[1:])
    encoder.closing[:] = False  # a tokenizer that marks no ends of words
    assert encoder.ids(pa.array(texts[:1]))[0].tolist() == want[0]
    assert grouped_packing.words_of(path) is grouped_packing.words_of(path)


def test_texts_are_numbered_in_parts(monkeypatch):
    monkeypatch.setattr(grouped_packing, "TEXT", 10)
    texts = pa.array(["x", "aaaa", "bbbb", "", "c" * 40, "d", ""]).slice(1)
    assert list(grouped_packing.parts(texts)) == [(0, 3), (3, 4), (4, 6)]


def own_memory():
    with open("/proc/self/smaps_rollup") as f:
        return sum(int(line.split()[1]) for line in f if line.startswith("Pss_Anon:")) / 1024


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory can't be read here")
def test_workers_give_memory_back_after_a_task(spark, monkeypatch):
    docs, tasks = frame(spark), []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, function, schema: tasks.append(function))
    grouped_packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    draw = random.Random(4)
    known = ["".join(draw.choices("abcdefgh", k=6)) for _ in range(5000)]
    texts = [" ".join(draw.choices(known, k=1000)) for _ in range(2000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(2000)), "text": texts})
    assert sum(part.num_rows for part in tasks[0](iter([batch]))) == 2000
    held = own_memory()
    pa.default_memory_pool().release_unused()
    assert held - own_memory() < 20


def check_packed(got, docs, tokenizer, capacity):
    want = []
    for d, t, _, _ in docs:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want.append((d, piece, at, len(part), zlib.crc32(part.tobytes())))
    order = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted((tuple(r)[:5] for r in got), key=order) == sorted(want, key=order)
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), -(-sum(w[3] for w in want) // capacity)


def test_packing_keeps_every_id(spark, tokenizer):
    docs = rows() + [(500 + i, t, None, None) for i, t in enumerate(TEXTS)]
    docs += [(600 + i, words(5 + i * i % 700, i), None, None) for i in range(150)]
    for capacity, small in ((4096, 512), (256, 32)):
        got = grouped_packing.pack(frame(spark, docs), capacity=capacity, small=small).collect()
        used, least = check_packed(got, docs, tokenizer, capacity)
        assert used <= least * 1.02 + 1
    assert grouped_packing.pack(frame(spark, [])).count() == 0


def test_small_pieces_in_several_tasks(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(grouped_packing, "DEALT", 40)
    docs = [(i, words(1 + i * 7 % 60, i), None, None) for i in range(200)]
    got = grouped_packing.pack(frame(spark, docs), capacity=256, small=64).collect()
    used, least = check_packed(got, docs, tokenizer, 256)
    assert used <= least + 6


def test_configurations_use_every_piece_once():
    draw = random.Random(3)
    sizes = sorted({draw.randint(13, 99) for _ in range(20)}, reverse=True)
    counts = [draw.randint(1, 1000) for _ in sizes]
    left = list(counts)
    for use, times in grouped_packing.configurations(sizes, counts, 100):
        assert sum(sizes[c] * n for c, n in use.items()) <= 100
        for c, n in use.items():
            left[c] -= n * times
    assert not any(left)


# Near duplicates


def brute_classes(docs, weights):
    shingled = [weighted_minhash.shingles(t or "") for _, t, _, _ in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(docs)), 2):
        alike = (docs[i][1] or "") == (docs[j][1] or "")
        if alike or weighted_minhash.similarity(shingled[i], shingled[j], weights) >= 0.8:
            parent[max(find(i), find(j))] = min(find(i), find(j))
    members = defaultdict(list)
    for i in range(len(docs)):
        members[find(i)].append(i)
    out = []
    for group in members.values():
        least = min((docs[i][0] for i in group if docs[i][0] is not None), default=None)
        out += [(docs[i][0], least) for i in group]
    return out


def near_docs():
    docs = rows()
    for group in range(12):
        base = words(120, 50 + group).split()
        for copy in range(8):
            text, draw = list(base), random.Random(group * 100 + copy)
            for _ in range(copy % 4):
                text[draw.randrange(len(text))] = words(1, draw.randrange(10**6))
            docs.append((1000 + group * 10 + copy, "  ".join(text).title(), None, None))
    # Copies far from each other, near their original only.
    hub = words(200, 77).split()
    docs.append((2000, " ".join(hub), None, None))
    for copy in range(40):
        text, draw = list(hub), random.Random(copy)
        for at in draw.sample(range(0, 200, 10), 3):
            text[at] = words(1, draw.randrange(10**6))
        docs.append((2001 + copy, " ".join(text), None, None))
    return docs


def test_classes_equal_brute_force(spark):
    docs = near_docs()
    table = frame(spark, docs)
    frequencies, n = weighted_minhash.document_frequencies(
        common.pick(table, text="text").fillna("", "text")
    )
    assert n == len(docs)
    got = weighted_minhash.near_classes(table).collect()
    want = brute_classes(docs, weighted_minhash.Weights(frequencies, n))
    order = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(((r["doc_id"], r["class_id"]) for r in got), key=order) == sorted(want, key=order)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)
    assert weighted_minhash.near_classes(frame(spark, [])).count() == 0


def test_document_frequencies_are_exact_counts(spark):
    texts = [words(30, i % 3) for i in range(20)] + [None, "", "one two"]
    table = spark.createDataFrame([(t or "",) for t in texts], "text string").repartition(4)
    frequencies, _ = weighted_minhash.document_frequencies(table)
    want = np.zeros(weighted_minhash.TABLE, np.int64)
    for t in texts:
        for h in weighted_minhash.shingles(t or "")[0]:
            want[int(h) >> (64 - 18)] += 1
    assert (frequencies == want).all()


def test_samples_agree_as_often_as_texts_are_similar():
    weights = weighted_minhash.Weights(np.zeros(weighted_minhash.TABLE, np.int64), 10)
    shared, estimates, true = words(400, 1).split(), [], []
    for seed in range(12):
        a = shingle = weighted_minhash.shingles(" ".join(shared + words(100, 10 + seed).split()))
        b = weighted_minhash.shingles(" ".join(shared + words(60, 50 + seed).split() + shared[:40]))
        s, t = (weighted_minhash.signature(h, weights.of(h, c)) for h, c in (a, b))
        estimates.append((s == t).mean())
        true.append(weighted_minhash.similarity(shingle, b, weights))
    assert abs(np.mean(estimates) - np.mean(true)) < 0.05


def test_words_are_told_apart_by_white_space_only():
    h = weighted_minhash.word_hashes
    assert len(h("")) == len(h(" \n")) == 0 and len(h("a  B\tc\n")) == 3
    assert h("b A")[1] == h("a")[0] and len(set(h("aa a aaa b ba ab"))) == 6
    assert len(h("q" * 10_000 + " b")) == 2 and h("q" * 10_000)[0] != h("q" * 10_001)[0]


def test_a_bucket_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(weighted_minhash, "BLOCK", 8)
    draw = np.random.default_rng(2)
    sketch = draw.integers(0, 256, 64).astype(np.uint8)
    members = []
    for node in range(60):
        s = sketch.copy()
        s[draw.choice(64, node % 20, replace=False)] += 1
        members.append((0, 5, 100 if node < 30 else node, node, s.tobytes(), [0] if node == 31 else None))
    schema = "band int, key long, class long, node long, sketch binary, tested array<long>"
    got = {tuple(r) for r in weighted_minhash.across(spark.createDataFrame(members, schema)).collect()}
    label, parent = {m[3]: m[2] for m in members}, {m[2]: m[2] for m in members}
    sketches = {m[3]: np.frombuffer(m[4], np.uint8) for m in members}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in got:
        assert label[a] != label[b] and {a, b} != {0, 31}
        assert (sketches[a] == sketches[b]).mean() >= weighted_minhash.ROUGH
        parent[find(label[a])] = find(label[b])
    # All classes that an estimate joins are joined, over the ends of blocks, too.
    for i, j in combinations(range(60), 2):
        if label[i] != label[j] and (sketches[i] == sketches[j]).mean() >= weighted_minhash.ROUGH:
            assert find(label[i]) == find(label[j])


def test_classes_over_block_ends_meet_outside_their_shared_block(spark, monkeypatch):
    monkeypatch.setattr(weighted_minhash, "BLOCK", 8)
    draw = np.random.default_rng(3)
    # Classes 0 and 100 span blocks; only the first node and the last resemble each other.
    sketches = [draw.integers(0, 256, 64).astype(np.uint8) for _ in range(44)]
    sketches[43] = sketches[0]
    members = [(0, 5, 0 if n < 20 else 100, n, s.tobytes(), None) for n, s in enumerate(sketches)]
    schema = "band int, key long, class long, node long, sketch binary, tested array<long>"
    table = spark.createDataFrame(members, schema)
    assert {tuple(sorted(r)) for r in weighted_minhash.across(table).collect()} == {(0, 43)}


def template_docs():
    """A page of many edited copies, about 0.7 alike, in which a few pairs are 0.8 or more."""
    base, docs, groups, draw = words(300, 5).split(), [], list(range(0, 300, 20)), random.Random(9)
    for page in range(300):
        text = list(base)
        for g in draw.sample(groups, 5):
            text[g + draw.randrange(4)] = words(1, draw.randrange(10**9))
        docs.append((page, " ".join(text), None, None))
        if page % 10 == 0:
            # A near twin of this page: one more group edited.
            text[7 + 20 * (page % 15)] = words(1, draw.randrange(10**9))
            docs.append((1000 + page, " ".join(text), None, None))
    return docs


def test_every_pair_of_a_group_without_its_original(spark, monkeypatch):
    # Forests find nothing: all links must come from the pairs that remain.
    monkeypatch.setattr(weighted_minhash, "FORESTS", 0)
    docs = template_docs()
    table = frame(spark, docs)
    frequencies, n = weighted_minhash.document_frequencies(common.pick(table, text="text"))
    want = brute_classes(docs, weighted_minhash.Weights(frequencies, n))
    got = [(r["doc_id"], r["class_id"]) for r in weighted_minhash.near_classes(table).collect()]
    assert len({c for _, c in want}) > 5
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("chunk, pairs, light", [(4000, 7, 512), (1 << 20, 50, 512), (4000, 1 << 14, 4000)])
def test_pairs_are_judged_once_whatever_bands_and_chunks(spark, monkeypatch, chunk, pairs, light):
    for name, value in (("FORESTS", 0), ("BLOCK", 64), ("CHUNK", chunk), ("PAIRS", pairs), ("LIGHT", light)):
        monkeypatch.setattr(weighted_minhash, name, value)
    listed, whole = [], weighted_minhash.remaining

    def noted(members):
        out = common.staged(whole(members), "noted")
        listed.extend(out.collect())
        return out

    monkeypatch.setattr(weighted_minhash, "remaining", noted)
    docs = template_docs()[:200]
    table = frame(spark, docs)
    frequencies, n = weighted_minhash.document_frequencies(common.pick(table, text="text"))
    want = brute_classes(docs, weighted_minhash.Weights(frequencies, n))
    got = [(r["doc_id"], r["class_id"]) for r in weighted_minhash.near_classes(table).collect()]
    assert sorted(got) == sorted(want)
    met = Counter(p for r in listed for p in zip(r["a"], r["b"]))
    assert len(met) > 1000 and set(met.values()) == {1}
    assert max(len(r["a"]) for r in listed) <= pairs and all(r["one"] <= r["two"] for r in listed)


def test_forest_of_two_sides():
    score = np.array([[9, 0, 3], [8, 0, 4]], np.uint8)
    edges = set(weighted_minhash.forest(score, np.array([1, 2]), np.array([3, 4, 2])))
    assert edges == {(0, 0), (1, 0)}  # row 1 and column 2 are one class


def test_tiles_are_bounded_and_hold_every_pair_once(spark, monkeypatch):
    monkeypatch.setattr(weighted_minhash, "BLOCK", 8)
    shapes = []

    def noted(sketch, other):
        shapes.append((len(sketch), len(other)))
        return (sketch[:, None, :] == other[None, :, :]).sum(2, dtype=np.uint8)

    members = [(0, 5, n, n, bytes(64), None) for n in range(50)]
    schema = "band int, key long, class long, node long, sketch binary, tested array<long>"
    groups = defaultdict(list)
    for r in weighted_minhash.tiles(spark.createDataFrame(members, schema)).collect():
        groups[r["left"], r["right"]].append(r)
    met = Counter()
    monkeypatch.setattr(weighted_minhash, "agreeing", noted)
    for rows_ in groups.values():
        table = pa.Table.from_pylist([r.asDict() for r in rows_])
        for i, j, node, _, score, _ in weighted_minhash.candidates(table):
            met.update(tuple(sorted((int(node[i[x]]), int(node[j[y]])))) for x, y in zip(*np.nonzero(score)))
    assert max(max(s) for s in shapes) <= 8
    assert met == Counter(combinations(range(50), 2))


def test_forest_takes_the_best_edges():
    score = np.array([[0, 9, 5, 0], [9, 0, 7, 0], [5, 7, 0, 0], [0, 0, 0, 0]])
    edges = {tuple(sorted(e)) for e in weighted_minhash.forest(score, np.arange(4))}
    assert edges == {(0, 1), (1, 2)}
    assert weighted_minhash.forest(score, np.array([1, 1, 1, 4])) == []


# Largest products


VECTORS = StructType(
    [
        StructField("uid", StringType()),
        StructField("vec_id", LongType()),
        StructField("embedding", ArrayType(FloatType())),
        StructField("V", StringType()),
    ]
)


def test_products_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(metric_tree, "SUBTREE", 64)
    monkeypatch.setattr(metric_tree, "TOGETHER", 2)
    monkeypatch.setattr(metric_tree, "FANOUT", 3)
    draw = np.random.default_rng(4)
    vectors = [(i, draw.normal(0, 0.3, 8).astype(np.float32).tolist()) for i in range(700)]
    vectors += [(700 + i, [0.5] * 8) for i in range(200)] + [(950, [2.0] * 8), (1000, [])]
    unusable = [(50, None), (1050, [1.0, None]), (1100, [float("nan")] * 8), (1101, [float("inf")]), (None, [9.0] * 8)]
    table = spark.createDataFrame([("x", i, v, "y") for i, v in vectors[:50] + vectors[51:] + unusable], VECTORS)
    vectors = [(i, np.floor(256 * np.array(v + [0] * (8 - len(v)), np.float64)).astype(int)) for i, v in vectors if i != 50]
    got = defaultdict(list)
    rows = metric_tree.top_products(metric_tree.whole_vectors(table), F.col("vec_id") % 50 == 0)
    for r in sorted(rows.collect()):
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    for q, v in vectors:
        if q % 50 == 0:
            best = sorted((-int(v @ w), i) for i, w in vectors if i != q)[:5]
            assert got.pop(q) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert not got


def test_products_beyond_a_long_are_its_limits(spark):
    big = [(0, [1e16, 2.0]), (50, [-1e16, 0.5]), (1, [3e15, 1.0]), (2, [1.0, 1.0]), (3, [float(1e30), 0.0])]
    table = spark.createDataFrame([("x", i, v, "y") for i, v in big], VECTORS)
    rows = metric_tree.whole_vectors(table)
    whole = {r["vec_id"]: r["v"] for r in rows.collect()}
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in metric_tree.top_products(rows, F.col("vec_id") % 50 == 0).collect()}
    for q in (0, 50):
        scores = [(sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q]
        scores = [(max(-(2**63) + 1, min(2**63 - 1, s)), i) for s, i in scores]
        for rank, (s, i) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1])), 1):
            assert got.pop((q, rank)) == (i, s)
    assert not got


def test_queries_go_only_where_their_bound_leads(spark, monkeypatch):
    """Clusters far apart: few nodes are read, with levels above the subtrees or without."""
    monkeypatch.setattr(metric_tree, "SUBTREE", 32)
    monkeypatch.setattr(metric_tree, "TOGETHER", 1)
    draw = np.random.default_rng(6)
    centres = draw.normal(0, 1, (30, 8))
    centres *= 40 / np.linalg.norm(centres, axis=1)[:, None]
    v = np.concatenate([c + draw.normal(0, 0.05, (64, 8)) for c in centres]).astype(np.float32)
    table = spark.createDataFrame([("x", i, x.tolist(), "y") for i, x in enumerate(v)], VECTORS)
    whole = np.floor(256 * v.astype(np.float64)).astype(np.int64)
    meeting, met = metric_tree.meeting, []

    def counted(nodes, packets, meet, schema):
        met.append((packets.select("node", "block").distinct().count(), nodes.count(), packets.select("block").distinct().count()))
        return meeting(nodes, packets, meet, schema)

    monkeypatch.setattr(metric_tree, "meeting", counted)
    for fanout in (256, 4):
        met.clear()
        monkeypatch.setattr(metric_tree, "FANOUT", fanout)
        got = defaultdict(list)
        for r in metric_tree.top_products(metric_tree.whole_vectors(table), F.col("vec_id") % 50 == 0).collect():
            got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
        for q in range(0, len(v), 50):
            best = sorted((-int(s), i) for i, s in enumerate(whole @ whole[q]) if i != q)[:5]
            assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
        read, nodes, blocks = met[-1]  # the subtrees
        assert read < nodes * blocks / 4
        assert len(met) == 1 if fanout == 256 else len(met) > 2


def test_few_or_no_vectors(spark):
    empty = spark.createDataFrame([], VECTORS)
    ask = F.col("vec_id") % 50 == 0
    assert metric_tree.top_products(metric_tree.whole_vectors(empty), ask).count() == 0
    two = spark.createDataFrame([("x", 0, [1.0], "y"), ("x", 3, [-1.0], "y")], VECTORS)
    got = metric_tree.top_products(metric_tree.whole_vectors(two), ask).collect()
    assert [tuple(r) for r in got] == [(0, 1, 3, -65536)]


def test_search_leaves_nodes_out():
    draw = np.random.default_rng(5)
    centres = draw.normal(0, 400, (8, 4))
    v = np.concatenate([c + draw.normal(0, 3, (64, 4)) for c in centres]).astype(np.int64)
    space = metric_tree.Space(4, float((v**2).sum(1).max()), float(abs(v).max()))
    ids = np.arange(len(v))
    trees = [metric_tree.Subtree(space, ids[i : i + 128], ids[i : i + 128], v[i : i + 128]) for i in range(0, 512, 128)]
    seen = []
    space.products = lambda rows, q: seen.append(len(rows)) or rows @ q
    metric_tree.search(trees, space, v[3], 3, 5)
    assert sum(seen) < 256


# WARC


PAGES = "URL string, page_id long, url string, html string, payload string"


def pages():
    big, other = "<p>ä</p>" * 200, "b" * 1000
    return [
        (1, "http://e.org/a b\r\nX: y", big),
        (2, None, big),
        (9, "http://e.org/ü", big),
        (9, "http://e.org/again", big),
        (3, "u", other),
        (4, "u", other),
        (5, "u", "b" * 999),
        (6, "u", "b" * 999),
        (7, "u", None),
        (8, "u", ""),
        (None, "u", other),
        (10, "u", "a\r\n\r\nb" * 300_000),
        (11, "u", "WARC/1.1\r\n\r\n"),
    ]


def test_archives_are_read_back(spark, folder):
    table = spark.createDataFrame([("x", p, u, h, "y") for p, u, h in pages()], PAGES).repartition(3)
    index = warc_index.write_archives(table, f"{folder}/warc").cache()
    got = warc_index.read_records(index).collect()
    want = []
    for p, _, h in pages():
        b = (h or "").encode()
        kept = max(q for q, _, x in pages() if q is not None and x == h) if len(b) >= 1000 else p
        again = len(b) >= 1000 and p != kept
        want.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", kept if again else None))
    order = lambda r: tuple((x is not None, x or 0) for x in r)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=order) == sorted(want, key=order)
    payloads = {r["page_id"]: bytes(r["payload"]) for r in got if r["record_type"] == "response"}
    assert payloads[10] == ("a\r\n\r\nb" * 300_000).encode()
    one = warc_index.read_records(index.filter("page_id = 11")).collect()
    assert [bytes(r["payload"]) for r in one] == [b"WARC/1.1\r\n\r\n"]
    assert warc_index.read_records(warc_index.write_archives(table.limit(0))).count() == 0


def test_archives_are_warc_files(spark, folder):
    table = spark.createDataFrame([("x", p, u, h, "y") for p, u, h in pages()], PAGES).coalesce(1)
    index = warc_index.write_archives(table, f"{folder}/warc").orderBy("offset").collect()
    store, path = warc_index.opened(index[0]["archive"])
    data = store.open_input_file(path).read()
    records, rest = [], data
    while rest:  # gzip members, one a record
        part = zlib.decompressobj(31)
        records.append(part.decompress(rest))
        rest = part.unused_data
    assert len(records) == len(pages()) and all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records)
    at = 0
    for row, record in zip(index, records):
        assert row["offset"] == at
        at += row["length"]
        head, _, block = record.partition(b"\r\n\r\n")
        assert int(warc_index.fields(head)["content-length"]) == len(block) - 4
    assert b"X: y" not in b"".join(r.partition(b"\r\n\r\n")[0].replace(b"X:%20y", b"") for r in records)


def test_a_damaged_payload_is_an_error():
    data = warc_index.record(1, "u", b"abc", hashlib.sha1(b"abd").hexdigest())
    with pytest.raises(ValueError):
        warc_index.parsed(data)
