import hashlib
import heapq
import random
import re
import zlib

from pyspark.sql import functions as F

from prepspark.llm.conversation_repair import cheapest_edits, damaged, repair_conversations

NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}
TO = {0: 2, 1: 2, 2: 3, 3: 2}


def plain_repair(rows):
    """Least (cost, edits) and its rows by uniform-cost search over (cost, edits, row, state); rows are (role, text, fault)."""
    queue, done = [(0, "", 0, 0, ())], set()
    while queue:
        cost, edits, i, q, out = heapq.heappop(queue)
        if i == len(rows) and q in (0, 3):
            return cost, edits, list(out)
        if (i, q) in done:
            continue
        done.add((i, q))
        name = {"u": "user", "a": "assistant"}[NEXT[q]]
        heapq.heappush(queue, (cost + 3, edits + "I", i, TO[q], out + (f"{name}:",)))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(queue, (cost + 4, edits + "D", i + 1, q, out))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                if role[:1] == NEXT[q]:
                    heapq.heappush(queue, (cost + extra, edits + "K", i + 1, TO[q], out + (f"{role}:{text}",)))
                if role[:1] == "s" and q == 0:
                    heapq.heappush(queue, (cost + extra, edits + "K", i + 1, 1, out + (f"{role}:{text}",)))
                heapq.heappush(queue, (cost + 3 + extra, edits + "R", i + 1, TO[q], out + (f"{name}:{text}",)))


def brute(table):
    convs = {}
    for conv, turn, role, text in table:
        own = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, rows = set(), []
        for _, role, text in own:
            last = re.search(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z", text)
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[1] not in ".!?" else ""
            seen.add((role, text))
            rows.append((role, text, fault))
        turns = {t for t, _, _ in own if t is not None}
        initials = [r[0][:1] for r in rows]
        cost, audit, done = plain_repair(rows)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[sum(r[2] == f for r in rows) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(done).encode()).hexdigest(),
        )
    return out


def frame(spark, table):
    return spark.createDataFrame(table, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit("x") for c in ("conv", "fault", "digest", "copy", "row", "absent", "audit")}
    )


def compare(spark, table):
    got = repair_conversations(damaged(frame(spark, table).repartition(3))).collect()
    want = brute(table)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) == want[r["conv"]], r


def made(seed, convs=150):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "what?", "cut off", "", " \n", None, "tail.  \t", "x. y", "日本。", "é?", "same."]
    table = []
    for c in range(convs):
        turn = rng.randrange(3)
        for _ in range(rng.choice([1, 1, 2, 3, 5, 9, 30])):
            table.append((c, rng.choice([turn, turn, turn, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice(texts)))
            turn += rng.choice([1, 1, 1, 2, 0])
    return table + [(None, 1, "user", "a."), (None, None, None, None), (None, 2, "assistant", "b.")]


def test_equals_brute_force(spark):
    compare(spark, made(11))


def test_auction_equals_search():
    rng = random.Random(2)
    for _ in range(1500):
        n = rng.randrange(9)
        initials = bytes(rng.choice([115, 117, 97, 117, 97, 0]) for _ in range(n))
        faults = bytes(rng.choice([0, 0, 0, 1, 2, 3, 3]) for _ in range(n))
        rows = [(chr(i) if i else "", "x", ("", "blank", "duplicate", "truncated")[f]) for i, f in zip(initials, faults)]
        cost, audit, _ = plain_repair(rows)
        assert cheapest_edits(initials, faults) == (cost, audit.encode())


def test_long_conversation_is_linear():
    import time

    began = time.time()
    cost, audit = cheapest_edits(b"ua" * 100_000 + b"uu" * 50_000, bytes(300_000))
    assert time.time() - began < 30 and cost == 150_000 and len(audit) == 300_000


def test_one_hot_conversation(spark):
    table = [(1, t, ("user", "assistant")[t % 2], f"text {t}.") for t in range(300)] + [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    compare(spark, table)


def test_empty_table(spark):
    assert repair_conversations(damaged(frame(spark, made(1)).where("false"))).count() == 0
