import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from prepspark.llm.winnowing import K, PIECE_CHARS, PLACE_BITS, WINDOW, fingerprint, fingerprints_with_neighbours, selections


def brute(text):
    """Chosen (hash, place) pairs by the definition."""
    pieces = re.findall(rf"[^\x20\x09-\x0D]{{1,{PIECE_CHARS}}}", text or "")
    if not pieces:
        return []
    grams = []
    for i in range(max(1, len(pieces) - K + 1)):
        h = 42
        for p in pieces[i : i + K]:
            h = xxhash.xxh64_intdigest(p.encode(), seed=h)
        grams.append(h >> PLACE_BITS + 1)
    out = []
    for i in range(max(1, len(grams) - WINDOW + 1)):
        window = grams[i : i + WINDOW]
        place = i + max(j for j, v in enumerate(window) if v == min(window))
        if (grams[place], place) not in out:
            out.append((grams[place], place))
    return out


def jaccard(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, found):
    """Compare with brute force; rows in next-document order."""
    expected = []
    for k, (key, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own = brute(text)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        expected.append(str((key, len(text), digest, round(jaccard(own, brute(edited)), 9), round(jaccard(own, brute(after)), 9))))
    got = [str((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9))) for r in found]
    assert sorted(got) == sorted(expected)


def test_random_texts_equal_brute_force(spark):
    random.seed(4)
    texts = [" ".join(random.choice(["aa", "b", "ccc", "é\U0001f600", "x" * 40]) for _ in range(random.randint(0, 60))) for _ in range(60)]
    rows = [(7 * i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for ranges in (1, 5, 200):
        check(rows, fingerprints_with_neighbours(docs, ranges=ranges).collect())
    chosen = docs.select("text", selections(fingerprint(F.col("text"))).alias("fp")).collect()
    assert all([(s.hash, s.place) for s in r.fp] == brute(r.text) for r in chosen)


def test_odd_rows(odd, empty):
    rows = sorted([(r.doc_id, r.text) for r in odd.collect()], key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    check(rows, fingerprints_with_neighbours(odd).collect())
    assert fingerprints_with_neighbours(empty).count() == 0


def test_shared_run_is_always_found(spark):
    random.seed(6)
    word = lambda: "".join(random.choice("abcdef") for _ in range(4))
    run = [word() for _ in range(WINDOW + K - 1)]
    rows = [(i, " ".join([word() for _ in range(random.randint(0, 30))] + run + [word() for _ in range(20)])) for i in range(30)]
    found = spark.createDataFrame(rows, "doc_id long, text string").select(selections(fingerprint(F.col("text"))).alias("fp")).collect()
    sets = [{s.hash for s in r.fp} for r in found]
    assert all(a & b for a in sets for b in sets)


def test_a_single_document_follows_itself(spark):
    rows = [(3, "one two three four five six")]
    check(rows, fingerprints_with_neighbours(spark.createDataFrame(rows, "doc_id long, text string")).collect())
