import hashlib
import re
from collections import defaultdict

from prepspark.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from prepspark.llm.source_mix import mix_documents, mix_sources, schedule, source_targets


def brute_groups(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return out


def test_exact_groups_of_odd_rows(odd):
    found = exact_duplicates(odd, digests=True).drop("text_mark").collect()
    expected = brute_groups([(r.doc_id, r.text) for r in odd.collect()])
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_exact_refinement_never_depends_on_the_buckets(odd):
    wide = exact_duplicates(odd, digests=True).drop("text_mark").collect()
    narrow = exact_duplicates(odd, digests=True, filter_bits=1, prefix_chars=1).drop("text_mark").collect()
    assert sorted(map(str, wide)) == sorted(map(str, narrow))
    lazy = exact_duplicates(odd).drop("text_mark").collect()
    assert sorted(map(str, lazy)) == sorted(str(r) for r in exact_duplicates(odd, digests=True).drop("text_sha256", "text_mark").collect())


def test_exact_stage_keeps_columns_and_first_rows(odd, empty):
    kept = drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 3, 4, 6, 7, 8, 9, 10, 10, 11, 12, 13]
    assert drop_exact_duplicates(empty).count() == 0 and exact_duplicates(empty, digests=True).count() == 0


def test_targets_are_the_level_fill(spark):
    sizes = [("a", 100), ("b", 10), ("c", 1000), ("d", 0), (None, 50)]
    got = {r.source: r.target for r in source_targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    weights = dict(zip(["a", "b", "c", "d", None], [3, 1, 2, 3, 1]))
    size, left, target, open_ = dict(sizes), 1.5 * 1160, {}, set(weights)
    while True:  # reshare the excess by weight until no source is above its cap
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * size[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * size[s]
            left -= target[s]
        open_ -= over
    assert all(abs(got[s] - target[s]) < 1e-6 for s in weights)


def test_schedule_is_even_and_complete(spark):
    rows = [("a", 5000, 0, 7500.0), ("b", 900, 1, 1800.0), ("c", 10_000, 2, 2500.0)]
    targets = spark.createDataFrame(rows, "source string, source_size long, place int, target double")
    slots = schedule(targets, block_words=100, run=16).orderBy("slot").collect()
    for _, size, place, target in rows:
        mine = [s for s in slots if s.place == place]
        assert sorted(s["rank"] for s in mine) == list(range(len(mine)))
        assert sum(s.words for s in mine) == target
    heavy = [s.place == 0 for s in slots]
    share = sum(heavy) / len(heavy)
    for k in range(1, len(heavy)):  # at any time the mix is near its shares
        assert abs(sum(heavy[:k]) - share * k) <= 6


def test_mix_of_odd_rows(odd, empty):
    rows = mix_sources(odd, block_words=7, rows_per_range=3).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    by = defaultdict(int)
    for r in rows:
        by[r.source] += r.taken
    assert all(abs(by[r.source] - r.target) <= 0.5 for r in rows)
    again = mix_sources(odd.repartition(5), block_words=7, rows_per_range=1000).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert mix_sources(empty).count() == 0


def test_mixed_documents_are_whole_and_repeat_as_taken(odd, empty):
    mixed = mix_documents(odd)
    assert mixed.columns == odd.columns
    texts = {r.text for r in odd.collect()}
    assert {r.text for r in mixed.collect()} <= texts and mix_documents(empty).count() == 0
