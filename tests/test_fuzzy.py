import random
from collections import Counter
from difflib import SequenceMatcher

import pytest

from prepspark.operators.fuzzy import FUZZY_RATIO, fuzzy_categories, most_edits, probes, segments


def serial(values):
    """{(source, target)} of one column by the plain loop over leaders."""
    leaders, out = [], set()
    counts = Counter(v.strip(" \t\n\r\x0b\x0c") for v in values if v is not None)
    for value, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        low = value.lower()
        hit = next((lead for lead in leaders if SequenceMatcher(None, low, lead).ratio() >= FUZZY_RATIO), None)
        if hit is None:
            leaders.append(low)
        elif hit != low:
            out.add((value, hit))
    return out


def typo(rng, word):
    chars = list(word)
    for _ in range(rng.choice([0, 1, 1, 2])):
        at = rng.randrange(len(chars) + 1)
        rng.choice([lambda: chars.insert(at, rng.choice("abcxyz ")), lambda: chars.pop(at % len(chars)) if len(chars) > 1 else None,
                    lambda: chars.__setitem__(at % len(chars), rng.choice("abcxyz"))])()
    return "".join(chars)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_serial_loop(spark, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.choice([1, 2, 4, 7, 10, 18, 30, 70, 75]))) for _ in range(60)]
    a = [typo(rng, rng.choice(words)) for _ in range(900)] + ["", " ", None, "A", "a ", "É", "é"] + words * 2
    b = [rng.choice([w.upper(), w.title(), " " + w]) for w in a if w]
    b += [None] * (len(a) - len(b))
    df = spark.createDataFrame(list(zip(a, b)), "a string, b string")
    got = {tuple(r) for r in fuzzy_categories(df.repartition(4)).collect()}
    assert got == {("a", *p) for p in serial(a)} | {("b", *p) for p in serial(b)}


def test_join_leaves_no_pair_out():
    rng = random.Random(3)
    for _ in range(4000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(14)))
        b = typo(rng, a) if a and rng.random() < 0.7 else "".join(rng.choice("ab") for _ in range(rng.randrange(14)))
        short, long = sorted((a, b), key=len)
        if SequenceMatcher(None, a, b).ratio() >= FUZZY_RATIO or not a + b:
            assert set(segments(short)) & set(probes(long)), (a, b)


def test_most_edits():
    assert [most_edits(a, b) for a, b in ((0, 0), (1, 1), (3, 4), (4, 5), (10, 10), (20, 20), (20, 27), (20, 28))] == [0, 0, 1, 1, 2, 6, 7, -1]


def test_chain_of_leaders(spark):
    """Each value is similar to the next one only: every second leads."""
    words = ["".join(chr(97 + (i + k) % 26) for i in range(20)) for k in range(0, 20, 2)]
    rows = [(w,) for k, w in enumerate(words) for _ in range(len(words) - k)]
    got = {(r["source"], r["target"]) for r in fuzzy_categories(spark.createDataFrame(rows, "w string")).collect()}
    assert got == serial([r[0] for r in rows]) and len(got) >= 4


def test_many_values_under_few_leaders(spark):
    """100,000 distinct values, far apart but for a marked tenth."""
    rng = random.Random(9)
    leaders = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(14)) for _ in range(90_000)]
    variants = [(w[:6] + "0" + w[7:], w) for w in leaders[:10_000]]
    rows = [(w,) for w in leaders for _ in range(2)] + [(v,) for v, _ in variants]
    got = {(r["source"], r["target"]) for r in fuzzy_categories(spark.createDataFrame(rows, "w string").repartition(8)).collect()}
    assert set(variants) <= got and len(got) < len(variants) + 50


def test_no_columns_and_empty(spark):
    df = spark.createDataFrame([("a", 1)], "a string, n int")
    assert fuzzy_categories(df.select("n")).count() == 0 and fuzzy_categories(df.where("false")).count() == 0
