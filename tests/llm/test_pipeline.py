from collections import Counter, defaultdict

import corpus_pipeline
from edges import frame, rows
from test_more import brute_classes, check_packed
from test_texts import by_hand
from tokenizers import Tokenizer

from llm import language_id, source_mix, weighted_minhash

STAGES = [stage for _, stage in corpus_pipeline.STAGES]


def plain(docs):
    assert docs.columns == list(corpus_pipeline.COLUMNS)
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]


def order(row):
    return tuple((x is not None, str(x)) for x in row)


def test_rejected_documents_go(spark):
    docs = frame(spark)
    judged = {(r["doc_id"], r["rejected"]) for r in language_id.identify(docs).collect()}
    got = plain(STAGES[0](spark, docs, ""))
    known = [r for r in rows() if r[1] and any(c.isalpha() for c in r[1])]
    assert {r[0] for r in rows()} - {r[0] for r in got} <= {d for d, rejected in judged if rejected}
    assert len(got) >= len(known) - 1 and not {4, 5} & {r[0] for r in got}


def test_one_of_equal_texts_stays(spark):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    best = {}
    for row in rows():
        key = (row[1] or "").translate(lower)
        if key not in best or (row[0] is not None, row[0] or 0) > (best[key][0] is not None, best[key][0] or 0):
            best[key] = row
    got = plain(STAGES[1](spark, frame(spark), ""))
    assert sorted(got, key=order) == sorted(best.values(), key=order)


def test_one_of_each_class_stays(spark):
    docs = rows()
    table = frame(spark, docs)
    frequencies, n = weighted_minhash.document_frequencies(
        spark.createDataFrame([(t or "",) for _, t, _, _ in docs], "text string")
    )
    classes = Counter(least for _, least in brute_classes(docs, weighted_minhash.Weights(frequencies, n)))
    got = plain(STAGES[2](spark, table, ""))
    assert Counter(r[0] for r in got).keys() == classes.keys()
    assert set(got) <= set(docs)


def test_documents_are_repeated_and_cut_as_the_mix_says(spark):
    docs = rows()
    taken = defaultdict(int)
    for r in source_mix.mix(frame(spark)).collect():
        taken[r["doc_id"], r["source"]] += r["taken"]
    got = plain(STAGES[3](spark, frame(spark), ""))
    words = Counter()
    for d, t, _, s in got:
        assert any(d == x[0] and x[1] is not None and x[1].startswith(t) for x in docs)
        words[d, s] += len(t.split())
    assert +words == Counter({k: v for k, v in taken.items() if v})
    sizes = Counter()
    for _, t, _, s in docs:
        sizes[s] += len((t or "").split())
    total = Counter()
    for (_, s), n in words.items():
        total[s] += n
    assert all(abs(total[s] - target) <= 1 for s, target in by_hand(sizes).items())


def test_stages_take_empty_tables(spark):
    docs = frame(spark, [])
    for stage in STAGES:
        assert stage(spark, docs, "").count() == 0


def test_the_pipeline_packs_what_the_stages_keep(spark):
    import public_tokenizers

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for stage in STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
    kept = plain(docs)
    got = corpus_pipeline.run(spark, sf_dir).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    used, least = check_packed(got, kept, tokenizer, 4096)
    assert used <= least * 1.02 + 1 and len(kept) > 100


def test_stages_are_in_order():
    assert len(STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
