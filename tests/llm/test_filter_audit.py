import random
import re
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from prepspark.llm.filter_audit import COUNTS, failure_sets, interaction_audit, interactions


def fails(docs):
    least = {}
    for key, text, _ in docs:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    for key, text, _ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        yield [
            len(words) < 200,
            100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            bool(re.search("[#$%&*|]", text)),
            key is not None and key > least[text],
        ]


def brute(docs, labels):
    """Every order applied filter by filter to every document."""
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    rows = [(part or "", key, f) for (key, _, part), f in zip(docs, fails(docs))]
    out = {}
    for part in {r[0] for r in rows}:
        own, shapley = [r for r in rows if r[0] == part], [0] * 5
        for order in permutations(range(5)):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[2][f]]
                left = [r for r in left if not r[2][f]]
                shapley[f] += len(gone)
                out[part, "".join("ABCDE"[i] for i in order), step] = [
                    len(left), len(gone), sum(r[2][f] for r in own) - len(gone), sum(r[2][f] and sum(r[2]) == 1 for r in own),
                    sum(r[1] in good for r in gone), sum(r[1] in toxic for r in gone), f,
                ]
        for key, counts in out.items():
            if key[0] == part:
                counts[-1] = shapley[counts[-1]]
    return out


def made(seed):
    rng = random.Random(seed)
    texts = [None, "", " \n ", "A" * 5, "a#b"]
    for _ in range(25):
        pool = [f"w{i}" for i in range(rng.choice([20, 400]))]
        words = [rng.choice(pool) for _ in range(rng.choice([5, 199, 200, 260]))]
        if rng.random() < 0.4:
            words[0] = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" * rng.choice([1, 3])
        if rng.random() < 0.3:
            words[1] = rng.choice("#$%&*|")
        texts.append(rng.choice([" ", "\t\n"]).join(words))
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", None])) for i in range(150)]
    docs += [(None, texts[7], "en"), (7, docs[7][1], "fr"), (7, "other", "fr")]
    labels = [(rng.randrange(200), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(120)] + [(None, 1, 1)]
    return docs, labels


def frames(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns({c: F.lit("x") for c in ("id", "part", "words", "digest", "fails")})
    return d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("keeper", F.lit(1))


def test_equals_brute_force(spark):
    docs, labels = made(5)
    got = interaction_audit(failure_sets(*frames(spark, docs, labels))).collect()
    assert {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COUNTS] for r in got} == brute(docs, labels)
    assert len(got) == 600 * len({d[2] for d in docs})


def test_empty_tables(spark):
    docs, labels = made(6)
    d, l = frames(spark, docs, labels)
    assert interaction_audit(failure_sets(d.where("false"), l)).count() == 0
    assert interaction_audit(failure_sets(d, l.where("false"))).agg(F.sum("good_lost")).first()[0] == 0


def test_hot_text_and_long_text(spark):
    docs = [(i, "copied text", "en") for i in range(5000)] + [(9000, "Word " * 300_000, "en")]
    got = interaction_audit(failure_sets(*frames(spark, docs, [(1, 1, 1)]))).where("filter_order = 'ECABD'").orderBy("step").collect()
    assert [r["removed"] for r in got] == [4999, 1, 1, 0, 0] and got[0]["good_lost"] == 1


def test_tensors_of_three_filters():
    rng = np.random.default_rng(3)
    tensor = rng.integers(0, 9, (2, 3, 2, 2, 2))
    orders, found = interactions(tensor)
    assert len(orders) == 6 and found.shape == (2, 18, 7)
    assert (found[:, 2::3, 0] == tensor[:, 0, 0, 0, 0][:, None]).all()  # what passes all filters is kept by every order
