import random
from collections import defaultdict

import numpy as np

from prepspark.llm.components import connected_components
from prepspark.llm.minhash_dedup import drop_near_duplicates, near_duplicates, shingle_set, signature


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows):
    """{(id, text): (n, component)} by all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    names = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        names[find(i)].append(key)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in names.items()}
    return sorted(str((key, len(sets[i]), least[find(i)])) for i, (key, _) in enumerate(rows))


def family(seed=3):
    """Groups of near copies around and above the threshold, chains, and texts with a common passage."""
    random.seed(seed)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(60)]
    rows, key = [], 100
    for size in (30, 80, 200):
        for _ in range(6):
            text = [word() for _ in range(size)]
            for _ in range(6):
                rows.append((key, " ".join(text)))
                key += 1
                text = list(text)  # each copy is edited from the one before: a chain
                for _ in range(random.randint(0, max(1, size // 40))):
                    text[random.randrange(size)] = word()
    for _ in range(40):
        rows.append((key, " ".join([word() for _ in range(40)] + passage)))
        key += 1
    hub = [word() for _ in range(100)]
    for _ in range(60):
        copy = list(hub)
        copy[random.randrange(100)] = word()
        rows.append((key, " ".join(copy)))
        key += 1
    random.shuffle(rows)
    return rows


def test_components_equal_brute_force(spark):
    rows = family()
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == brute(rows)


def test_odd_rows(odd, empty):
    got = near_duplicates(odd).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == brute([(r.doc_id, r.text) for r in odd.collect()])
    kept = drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    gone = {r.doc_id for r in odd.collect()} - {r.doc_id for r in kept.collect()}
    assert gone == {r.doc_id for r in got if not r.kept and r.doc_id is not None}
    assert near_duplicates(empty).count() == 0


def test_signature_estimates_similarity():
    a, b = shingle_set(" ".join(map(str, range(1000)))), shingle_set(" ".join(map(str, range(100, 1100))))
    x, y = (np.frombuffer(signature(s, 256), "<u4") for s in (a, b))
    both = len(np.intersect1d(a, b))
    assert abs((x == y).mean() - both / (len(a) + len(b) - both)) < 0.1


def test_components_of_paths_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(50, 51), (51, 52), (52, 50), (60, 60), (70, 71), (70, 71)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long"))
    roots = {r.node: r.root for r in found.collect()}
    assert roots == {**{i: 1 for i in range(1, 41)}, **{i: 50 for i in (50, 51, 52)}, 70: 70, 71: 70}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def template(seed=5):
    """Texts that share four fifths of their words and stay apart, each with a chain of two edited copies."""
    random.seed(seed)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(6))
    shared = [word() for _ in range(200)]
    rows = []
    for _ in range(70):
        own = [word() for _ in range(50)]
        for _ in range(3):
            rows.append((len(rows), " ".join(shared + own)))
            at = random.randrange(30)
            own = own[:at] + [word() for _ in range(18)] + own[at + 18 :]
    random.shuffle(rows)
    return rows


def test_large_bucket_leaves_no_pair_out(spark):
    rows = template()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(frame).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == brute(rows)
    # With one band the bucket of the shared minima cannot be split: what meets in it is what has equal minima.
    sigs = {key: signature(shingle_set(text), 4) for key, text in rows}
    hot = max(set(sigs.values()), key=list(sigs.values()).count)
    inside = [(key, text) for key, text in rows if sigs[key] == hot]
    assert len(inside) > 64
    got = near_duplicates(spark.createDataFrame(inside, "doc_id long, text string"), bands=1).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == brute(inside)
