import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from shoptrail.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, digest string, first string, fault int"
BLANK = re.compile(r"[\x20\x09-\x0D]*")


def damage(rows):
    out = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv_id] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in out.items()}


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        ended = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        out.append(1 if not ended else 2 if (role, text) in seen else 3 if ended[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def every_way(rows, found):
    """The cheapest edits by trying whole sequences: all pairs (cost, audit) that lead to each state, row by row."""
    def insertions(ways):
        out = set(ways)
        for _ in range(3):
            for last, cost, audit, text in list(out):
                for role in ("user", "assistant"):
                    if fits(last, role) and audit.count("I") < 6:
                        out.add((role[0], cost + 5, audit + "I", (*text, f"{role}:")))
        return cheap(out)

    def fits(last, role):
        return role != "" and last + role[:1] in {"s", "u", "su", "ua", "au"}

    def cheap(ways):
        """Ways that end alike compare by cost, then audit; nothing that follows tells them apart."""
        best = {}
        for way in sorted(ways, key=lambda w: (w[1], w[2])):
            best.setdefault(way[0], way)
        return set(best.values())

    ways = insertions({("", 0, "", ())})
    for (_, role, text), fault in zip(rows, found):
        after = set()
        for last, cost, audit, kept in ways:
            after.add((last, cost + 2, audit + "D", kept))
            if fault in (0, 3):
                extra = 5 if fault == 3 else 0
                if fits(last, role):
                    after.add((role[:1], cost + extra, audit + "K", (*kept, f"{role}:{text}")))
                for other in ("user", "assistant"):
                    if fits(last, other):
                        after.add((other[0], cost + 1 + extra, audit + "R", (*kept, f"{other}:{text}")))
        ways = insertions(after)
    _, cost, audit, kept = min((w for w in ways if w[0] in ("", "a")), key=lambda w: (w[1], w[2]))
    return cost, audit, "\n".join(kept)


def expected(conv_id, rows):
    found = faults(rows)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, text = every_way(rows, found)
    return (conv_id, gaps, found.count(1), found.count(2), found.count(3), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def with_lost(rows):
    kept = damage(rows)
    return {c: kept.get(c, []) for c in {r[0] for r in rows}}


def made_up(seed, n):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "", " \t", "Why?", "Yes. \n", None, "é."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "umbrella"]
    rows = []
    for c in range(n):
        for turn in range(rng.randrange(9)):
            turn = rng.choice([turn, turn, turn, turn, rng.randrange(-3, 9), None])
            rows.append((c if c % 17 else None, turn, rng.choice(roles), rng.choice(texts), "d", "f", 9))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_query_matches_brute_force(spark, seed):
    rows = made_up(seed, 300)
    found = conversations.query(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted((expected(c, r) for c, r in with_lost(rows).items()), key=repr)


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in table.collect()]
    found = conversations.query(table).collect()
    assert sorted(map(tuple, found)) == sorted(expected(c, r) for c, r in with_lost(rows).items())


def test_repaired_rows_are_what_the_digest_says(spark):
    rows = spark.createDataFrame(made_up(3, 200), SCHEMA)
    harmed = conversations.damaged(rows)
    texts = defaultdict(list)
    for r in sorted(conversations.repaired(harmed).collect(), key=lambda r: (str(r["conv_id"]), r["position"])):
        assert r["edit"] in "KRI" and r["position"] == len(texts[r["conv_id"]])
        texts[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    for r in conversations.reports(harmed).collect():
        assert hashlib.sha256("\n".join(texts[r["conv_id"]]).encode()).hexdigest() == r["repaired_sha256"]
        assert re.fullmatch("(s?(ua)+)?", "".join(t[:1] for t in texts[r["conv_id"]]))


def test_lost_conversations_and_empty_tables(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = conversations.query(spark.createDataFrame([(lost, 0, "user", "Hi.", "", "", 0)], SCHEMA)).collect()
    assert [tuple(r) for r in rows] == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.query(empty).count() == 0 and conversations.repaired(conversations.damaged(empty)).count() == 0


@pytest.mark.parametrize("kind", ["good", "random", "blank", "cut off", "deleted"])
def test_open_part_stays_small(kind):
    rng = random.Random(4)
    out, most = [], 0
    repair = conversations.Repair(lambda *edit: out.append(edit[0]))
    for k in range(5000):
        role = {"good": "ua"[k % 2], "deleted": "t"}.get(kind) or rng.choice("usa")
        fault = {"blank": 1, "cut off": 3, "deleted": 2}.get(kind, rng.choice([0, 0, 0, 1, 2, 3]) if kind == "random" else 0)
        repair.row(role, "x.", fault)
        most = max(most, repair.open_edits)
    repair.end()
    assert most < 200 and sum(e != "I" for e in out) == 5000


def test_rows_of_one_wrong_speaker_stay_open_to_the_end():
    """Given to user and assistant in turn, all rows hang on whether their number turns out odd or even."""
    for n in (400, 401):
        out = []
        repair = conversations.Repair(lambda *edit: out.append(edit[0]))
        for _ in range(n):
            repair.row("system", "x.", 0)
        assert repair.open_edits >= n - 2
        assert repair.end() == (n - 1 if n % 2 else n)
        assert "".join(out) == ("K" + "R" * (n - 1) if n % 2 else "DK" + "R" * (n - 2))
