from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from bagdiff.llm import conversation_repair as cr
from bagdiff.llm import queries

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def brute(rows):
    """(faults, cost, audit, lines) of (role, text) rows: all edits tried row by row, without grammar or matrices."""
    seen, faults = set(), []
    for role, text in rows:
        left = text.rstrip(cr.WHITE)
        faults.append("b" if not left else "d" if (role, text) in seen else "-" if left[-1] in ".!?" else "t")
        seen.add((role, text))

    def put(ways, state, way):
        ways[state] = min(way, ways.get(state, way))

    def inserted(ways):
        for _ in range(4):
            for state, (cost, audit, lines) in list(ways.items()):
                for i, name in cr.ROLES.items():
                    if (state, i) in NEXT:
                        put(ways, NEXT[state, i], (cost + 3, audit + "I", (*lines, name + ":")))
        return ways

    ways = {"": (0, "", ())}
    for (role, text), fault in zip(rows, faults, strict=True):
        after = {}
        for state, (cost, audit, lines) in inserted(ways).items():
            put(after, state, (cost + 4, audit + "D", lines))
            if fault in "bd":
                continue
            more = 3 if fault == "t" else 0
            if (state, role[:1]) in NEXT:
                put(after, NEXT[state, role[:1]], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
            for i, name in cr.ROLES.items():
                if (state, i) in NEXT:
                    put(after, NEXT[state, i], (cost + more + 3, audit + "R", (*lines, f"{name}:{text}")))
        ways = after
    ways = inserted(ways)
    cost, audit, lines = min(ways[s] for s in ("", "a") if s in ways)
    return faults, cost, audit, "\n".join(lines)


def check(rows):
    """Repair (conv, turn, role, text) rows with distinct turns and compare every column with brute force."""

    def run(spark):
        fixed = cr.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
        report = {r.conv: r for r in fixed.report.collect()}
        hashes = {r.conv: r.sha256 for r in cr.digests(fixed.messages).collect()}
        convs = defaultdict(list)
        for conv, turn, role, text in rows:
            convs[conv].append((turn, " " if role is None else role, " " if text is None else text))
        assert set(report) == set(convs)
        for conv, own in convs.items():
            own.sort(key=lambda r: (r[0] is not None, r[0]))
            faults, cost, audit, text = brute([r[1:] for r in own])
            turns = {r[0] for r in own} - {None}
            initials = [r[1][:1] for r in own]
            r = report[conv]
            assert (r.cost, r.audit) == (cost, audit)
            assert (r.blank, r.duplicate, r.truncated) == tuple(faults.count(f) for f in "bdt")
            assert r.gaps == (max(turns) - min(turns) + 1 - len(turns) if turns else 0)
            assert r.illegal == sum(a + b not in cr.LEGAL for a, b in zip(initials, initials[1:], strict=False))
            assert hashes.get(conv, hashlib.sha256(b"").hexdigest()) == hashlib.sha256(text.encode()).hexdigest()

    return run


ROLES = ["system", "user", "assistant", "user", "assistant", "tool", None, "", "sage", "User"]
TEXTS = ["a.", "b.", "c", "d!", "", " \t\r\n", "e? \n", None, "f.\x85", "g\x1c", "é!"]


def random_rows(seed, convs, most, some=TEXTS):
    rnd = random.Random(seed)
    rows = []
    for conv in range(convs):
        turns = rnd.sample(range(-5, 3 * most), rnd.randrange(1, most))
        for turn in turns:
            text = rnd.choice(some) if rnd.random() < 0.5 else f"{turn}" + rnd.choice([".", ""])
            rows.append((conv, turn, rnd.choice(ROLES), text))
    rnd.shuffle(rows)
    return rows


def test_small_conversations(spark):
    check(random_rows(1, 300, 9))(spark)


def test_many_units_a_conversation(spark, monkeypatch):
    """Units of 4 rows, multiplied by twos: the same results through many levels."""
    monkeypatch.setattr(cr, "UNIT_BITS", 2)
    monkeypatch.setattr(cr, "FAN_IN_BITS", 1)
    check(random_rows(2, 6, 120))(spark)


@pytest.mark.parametrize(
    ("rows", "cost", "audit", "text"),
    [
        ([("user", "Hi."), ("assistant", "Yes.")], 0, "KK", "user:Hi.\nassistant:Yes."),
        ([("user", "Hi.")], 3, "KI", "user:Hi.\nassistant:"),
        ([("system", "Be.")], 4, "D", ""),
        ([("assistant", "Yes.")], 3, "IK", "user:\nassistant:Yes."),
        ([("user", "Hi."), ("user", "Ho.")], 3, "KR", "user:Hi.\nassistant:Ho."),
        ([("user", "Hi"), ("assistant", "Yes.")], 3, "KK", "user:Hi\nassistant:Yes."),
        ([("user", "Hi."), ("user", "Hi."), ("assistant", "Yes.")], 4, "KDK", "user:Hi.\nassistant:Yes."),
        ([("user", " "), ("system", "")], 8, "DD", ""),
        ([("tool", "x."), ("assistant", "Yes.")], 3, "RK", "user:x.\nassistant:Yes."),
        ([("system", "Be."), ("assistant", "Yes.")], 3, "KIK", "system:Be.\nuser:\nassistant:Yes."),
    ],
)
def test_by_hand(spark, rows, cost, audit, text):
    assert brute(rows)[1:] == (cost, audit, text)
    strings, seen = "", set()
    for role, said in rows:
        fault = "b" if not said.strip() else "d" if (role, said) in seen else "-" if said[-1] in ".!?" else "t"
        seen.add((role, said))
        initial = role[0] if role[0] in "sua" else "x"
        strings += cr.CODES[4 * cr.INITIALS.index(initial) + cr.FAULTS.index(fault)]
    ends = cr._times(cr.matrices([strings])[0][:1], cr._insertions())[0]
    best = None
    for state in cr.ACCEPTED:
        best = cr._better(ends[state], best) if ends[state] else best
    assert (best[0], cr._flat(best[1])) == (cost, audit)


def test_re_pair_keeps_the_texts():
    rnd = random.Random(4)
    for size in (1, 2, 3, 16):
        texts = [[rnd.randrange(size) for _ in range(rnd.randrange(1, 60))] for _ in range(40)] + [[0] * 999]
        short, rules = cr.re_pair(texts, 16)

        def spelled(x, rules=rules):
            return [x] if x < 16 else spelled(rules[x - 16][0]) + spelled(rules[x - 16][1])

        assert [[y for x in s for y in spelled(x)] for s in short] == texts
        assert sum(map(len, short)) < sum(map(len, texts))
        pairs = [p for s in short for p in zip(s, s[1:], strict=False) if p[0] != p[1]]
        assert len(pairs) == len(set(pairs))  # no pair comes twice


def test_odd_rows(spark):
    long = "word " * 100_000
    rows = [
        (None, None, None, None, "x"),
        (None, 1, "user", "a.", "x"),
        (None, 1, "user", "a.", "x"),
        (1, None, "user", "b.", None),
        (1, None, "user", "b.", None),
        (1, 5, "assistant", long, None),
        (2, None, "assistant", "only.", "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, unit string").selectExpr("*", "'own' AS conv", "1 AS place", "2 AS number")
    fixed = cr.repair(df)
    got = {r.conv: r for r in fixed.report.collect()}
    assert set(got) == {None, 1, 2}
    assert (got[None].blank, got[None].duplicate, got[None].audit, got[None].gaps) == (1, 1, "DKDI", 0)
    assert (got[1].duplicate, got[1].truncated, got[1].audit, got[1].cost, got[1].gaps) == (1, 1, "KDK", 7, 0)
    assert (got[2].audit, got[2].gaps) == ("IK", 0)
    assert {r.conv: r.n for r in fixed.messages.groupBy("conv").count().withColumnRenamed("count", "n").collect()} == {None: 4, 1: 3, 2: 2}
    empty = cr.repair(df.limit(0))
    assert empty.report.count() == 0 and cr.digests(empty.messages).count() == 0


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", f"{c} says {t}. And?") for c in range(12) for t in range(10)] + [(None, None, None, None)]
    got = defaultdict(list)
    for r in queries.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect():
        got[r.conv_id, r.turn].append((r.role, r.text))
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role or " ", text or " "
        want = {0: [], 1: [(role, "")], 2: [(role, text.replace(".", "").replace("?", ""))], 3: [(role, text)] * 2, 4: [("user", text)]}
        assert got.get((conv, turn), []) == want.get(kind, [(role, text)])
