import re
from collections import Counter

import corpus_pipeline
from prepspark.llm.common import settle, table

SF = "/root/testdata/sf0.001"


def test_stages_on_the_smallest_tables(spark):
    docs = table(spark, SF, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "source_mix", "byte_bpe"]
    before = {r.doc_id: r for r in docs.collect()}
    results = []
    frame = docs
    for name, stage in corpus_pipeline.STAGES:
        frame = settle(stage(spark, frame, SF), f"test-{name}")
        results.append(frame)
        if name != "byte_bpe":
            assert frame.columns == docs.columns
            assert all(before[r.doc_id].text == r.text for r in frame.collect())
    ids = [[r.doc_id for r in f.select("doc_id").collect()] for f in results]
    assert set(ids[0]) == {i for i, r in before.items() if r.text and re.search(r"[^\W\d_]", r.text)}
    first = {}
    for i in sorted(ids[0]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[i].text), i)
    assert sorted(ids[1]) == sorted(first.values())
    assert set(ids[2]) <= set(ids[1]) and len(ids[2]) == len(set(ids[2]))
    copies = Counter(ids[3])
    assert set(copies) <= set(ids[2]) and max(copies.values()) <= 2
    assert Counter(ids[4]) == copies
    assert all(r.n_tokens > 0 and r.ids_sha256 and r.decoded_sha256 for r in results[4].collect())


def test_odd_and_empty_documents(spark, odd, empty):
    docs = odd.select("doc_id", "text", "lang", "source", "n", "kept")
    for frame in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            frame = settle(stage(spark, frame, SF), f"odd-{name}")
            assert name == "byte_bpe" or frame.columns == docs.columns
    assert frame.count() == 0


def test_entry_point():
    import __spark_entry__

    names = __spark_entry__.queries()
    numbers = sorted(int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n)))
    assert numbers == list(range(1, 14)) and names["pipeline"] is corpus_pipeline.run
