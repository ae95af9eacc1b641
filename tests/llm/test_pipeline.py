"""Each stage against what it must do with the rows it gets."""

import corpus_pipeline
import public_tokenizers
from test_neighbours import brute_components

from marquee.llm import bpe, jaccard_join, mixing, quality, registered
from marquee.llm.common import stored


def test_stages_in_turn(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, small), "test-stage")
        assert after.columns == columns
        seen[name] = (docs.toPandas(), after.toPandas())
        docs = after
    before, after = seen["toxicity"]
    insults = r"(?i)\b(?:idiot|moron|stupid|scum|trash|loser|pathetic|worthless|disgusting|clown)\b"
    assert before.text.str.contains(insults).any() and not after.text.str.contains(insults).any()
    assert len(after) > 0.8 * len(before)
    before, after = seen["quality rules"]
    good = quality.judged(spark.createDataFrame(before)).where("kept").toPandas()
    assert set(after.doc_id) == set(good.doc_id)
    before, after = seen["n-gram Jaccard join"]
    groups = brute_components(list(zip(before.doc_id, before.text)))
    assert sorted(after.doc_id) == sorted(k for k, (_, first) in groups.items() if k == first)
    before, after = seen["mixing sources"]
    assert set(after.doc_id) < set(before.doc_id)
    expected = mixing.mix(mixing.with_topic_and_tokens(spark.createDataFrame(before)), corpus_pipeline.MARGINS, corpus_pipeline.MIX_RATE, corpus_pipeline.MIX_CYCLES, corpus_pipeline.MIX_SEED)
    assert set(after.doc_id) == {r["doc_id"] for r in expected.where("sampled").collect()}
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, small).toPandas()
    assert sorted(tokens.doc_id) == sorted(after.doc_id) and tokens.decodes_to_text.all()


def test_stages_take_odd_rows_and_none(spark, odd, none, small):
    for rows in (odd, none):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, rows, small).collect()


def test_memos_of_workers_stay_small():
    jaccard_join._HASHES.clear()
    text = " ".join(f"w{k}" for k in range(120_000))
    whole = jaccard_join.shingle_set(text)
    assert len(jaccard_join._HASHES) <= 50_000
    assert len(whole) == 119_996 and jaccard_join.shingle_set(text[: text.index(" w60000")]).tolist() == sorted(
        set(whole.tolist()) - set(jaccard_join.shingle_set(text[text.index("w59996 ") :]).tolist())
    )
    ranks, pattern = bpe.read_ranks(open(public_tokenizers.path(corpus_pipeline.VOCABULARY), "rb").read()), public_tokenizers.PATTERN
    vocabulary = bpe.Vocabulary(ranks, pattern)
    ids = vocabulary.encode(text)
    assert max(len(m) for m in (vocabulary._pieces, vocabulary._pairs, vocabulary._short)) <= 50_000
    assert vocabulary.decode(ids) == text.encode() and ids[:9] == bpe.Vocabulary(ranks, pattern).encode(text[:2000])[:9]


def test_tokens_need_one_worker_a_task(spark, odd, small):
    found = corpus_pipeline.tokens(spark, odd, small)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    vocabulary = (public_tokenizers.path(corpus_pipeline.VOCABULARY), public_tokenizers.PATTERN)
    apart = bpe.decode(bpe.encode(odd, *vocabulary), *vocabulary)
    key = lambda rows: sorted((r["doc_id"] or 0, r["ids"], bytes(r["decoded"])) for r in rows.select("doc_id", "ids", "decoded").collect())
    assert key(apart) == key(bpe.encode(odd, *vocabulary, decoded=True))
    assert found.where("not decodes_to_text").count() == 0


def test_repeats_are_placed_only_where_they_could_be_enough(spark):
    """Shares of repeated words about the bound, in pairs and in runs: the same rows as with all words placed."""
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join(base + base[:k]) for k in range(0, 60, 3)] + [" ".join(base[:n] + ["a"] * k) for n in (40, 60) for k in range(0, 90, 7)]
    # Windows found twice that share no words: three words for each window that is no first one.
    texts += [" ".join(" ".join([*base[3 * i : 3 * i + 3], f"x{i}"]) for i in [*range(20), *range(k)]) for k in range(21)]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    kept = {r["doc_id"] for r in quality.passed(rows).collect()}
    assert kept == {r["doc_id"] for r in quality.judged(rows).where("kept").collect()} and 0 < len(kept) < len(texts)


def test_mixing_reads_texts_once(spark, small):
    """Topics and words are found before the cells are counted, not again when documents are drawn."""
    plan = registered.op1_mixing_sources(spark, small)._jdf.queryExecution().executedPlan().toString().lower()
    assert "scan parquet" in plan and "rlike" not in plan and "split(" not in plan
