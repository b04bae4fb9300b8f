import collections

import corpus_pipeline as C
from salesq.llm import language_id, mixing, simhash, toxicity
from salesq.llm.common import written


def test_stages_in_order_and_columns(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    labels = spark.read.parquet(f"{sf001}/labels.parquet")
    assert [n for n, _ in C.STAGES] == ["toxicity", "language", "near_duplicates", "mixing", "tokens"]
    now, ids = docs, {r.doc_id for r in docs.collect()}
    for name, stage in C.STAGES[:-1]:
        after = written(stage(spark, now, sf001), f"test-{name}")
        assert after.columns == docs.columns
        got = collections.Counter(r.doc_id for r in after.collect())
        if name == "toxicity":
            model = toxicity.train(now, labels)
            want = {r.doc_id for r in toxicity.with_score(now, model).filter(f"_score < {toxicity.CUT}").collect()}
        elif name == "language":
            want = {r.doc_id for r in language_id.identify(now).filter("not ambiguous").collect()}
        elif name == "near_duplicates":
            want = {r.component_id for r in simhash.near_duplicates(now).collect()}
        else:
            copies = {r.doc_id: r.copies for r in mixing.mix(now).collect()}
            assert got == collections.Counter({k: v for k, v in copies.items() if v})
            want = set(got)
        assert set(got) == want <= ids
        now, ids = after, want
    out = C.run(spark, sf001).collect()
    assert collections.Counter(r.doc_id for r in out) == got and all(r.round_trip for r in out)


def test_odd_rows_pass_through(spark, odd_docs, no_docs, sf001):
    now = odd_docs()
    for _, stage in C.STAGES:
        now = written(stage(spark, now, sf001), "test-odd")
    assert 2 not in {r.doc_id for r in now.collect()}
    now = no_docs
    for _, stage in C.STAGES:
        now = written(stage(spark, now, sf001), "test-none")
    assert now.count() == 0
