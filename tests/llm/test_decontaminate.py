import random
import re

import pytest
from pyspark.sql import functions as F

from prepspark.llm.decontaminate import build_index, contamination, indexed_documents, search, words_of

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return PATTERN.findall(lowered)


def brute(docs, items, width, slop=0):
    """(hit words, items) per document, every start of every window tried; ``slop`` words off from the rarest term."""
    often = {}
    for _, text in docs:
        for w in plain_words(text):
            often[w] = often.get(w, 0) + 1
    out = []
    for key, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for item, item_text in items:
            own = plain_words(item_text)
            n = min(width, len(own))
            for s in range(len(own) - n + 1 if own else 0):
                window = own[s : s + n]
                order = sorted(range(n), key=lambda k: (often.get(window[k], 0), k))
                for at, w in enumerate(words):
                    if w != window[order[0]]:
                        continue
                    start, spots = at - order[0], []
                    for k in order:
                        near = [p for p in range(start + k - slop, start + k + slop + 1) if 0 <= p < len(words) and words[p] == window[k]]
                        if k == order[0]:
                            near = [at]
                        if not near:
                            break
                        spots.append(near[0])
                    else:
                        hit |= set(range(min(spots), max(spots) + 1))
                        found.add("" if item is None else str(item))
        out.append((key, len(words), len(hit), sorted(found)))
    return out


def made(seed, docs=60):
    rng = random.Random(seed)
    vocabulary = ["the"] * 6 + [f"w{i}" for i in range(25)] + ["é", "Été", "日本語", "x-y", "don't"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 5, 9, 14])))) for i in range(25)]
    items += [(3, items[3][1]), (90, None), (91, " -- "), (None, "the w1 w2"), (92, items[4][1].upper())]
    rows = []
    for i in range(docs):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 2, 30, 80]))]
        for _ in range(rng.randrange(3)):
            words.insert(rng.randrange(len(words) + 1), items[rng.randrange(25)][1])
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(words)))
    rows += [(5, rows[5][1]), (200, None), (201, ""), (202, "..."), (None, items[4][1])]
    return rows, items


def frames(spark, rows, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("segment", "term", "items", "n", "at")})
    bench = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(1) for c in ("t", "doc_id", "spans")})
    return docs, bench


@pytest.mark.parametrize("block_words", [100_000, 12])
def test_equals_brute_force(spark, block_words):
    rows, items = made(1)
    docs, bench = frames(spark, rows, items)
    got = contamination(docs.repartition(3), bench, width=5, block_words=block_words).collect()
    want = brute(rows, items, 5)
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"]) for r in got) == sorted((str(k), n, h, i) for k, n, h, i in want)
    assert any(r["n_hit"] for r in got) and not all(r["n_hit"] for r in got)


def test_proximity_equals_brute_force(spark):
    rows, items = made(2, 30)
    docs, bench = frames(spark, rows, items)
    got = contamination(docs, bench, width=4, slop=1).collect()
    want = brute(rows, items, 4, slop=1)
    assert sorted((str(r["doc_id"]), r["n_hit"], r["items"]) for r in got) == sorted((str(k), h, i) for k, _, h, i in want)


def test_segments_cut_documents_only(spark):
    rows, items = made(3)
    docs, bench = frames(spark, rows, items)
    index = build_index(docs.coalesce(1), segment_words=50)
    found = indexed_documents(index)
    assert found.select("segment").distinct().count() > 10
    assert sorted((str(r["id"]), r["n_words"]) for r in found.collect()) == sorted((str(k), len(plain_words(t))) for k, t in rows)
    hits = search(index, bench, width=5).count()
    assert hits == search(build_index(docs), bench, width=5).count() == sum(1 for r in brute(rows, items, 5) if r[2])


def test_words():
    for text in ("A-b_c1 É", "\x00x\x7fy z", "", None, "日本 語、x", "[İ]"):
        assert [w.decode() for w in words_of(text)] == plain_words(text)


def test_empty_tables(spark):
    docs, bench = frames(spark, [(1, "a b c")], [(1, "a b")])
    assert contamination(docs.where("false"), bench).collect() == []
    (row,) = contamination(docs, bench.where("false")).collect()
    assert (row["n_words"], row["n_hit"], row["items"], row["spans"]) == (3, 0, [], [])


def test_hot_window_and_long_text(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(i, f"the {'the ' * (i % 50)}{passage} end") for i in range(3000)] + [(9000, "the " * 50_000 + passage)]
    items = [(i, passage) for i in range(40)] + [(99, "the " * 11)]
    docs, bench = frames(spark, rows, items)
    got = contamination(docs.repartition(4), bench)
    assert got.where("n_hit >= 12 AND size(items) >= 40").count() == len(rows)
    row = got.where("doc_id = 9000").first()
    assert row["n_hit"] == 50_012 and row["items"] == sorted([str(i) for i in range(40)] + ["99"])
