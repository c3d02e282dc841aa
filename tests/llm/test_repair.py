"""Conversation repair against all edits of small conversations and a plain program for longer ones."""

import hashlib
import itertools
import random
import re
import zlib
from functools import cache

from tidemark.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string, alive_ string, fault string, best string"
NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
WHITE = " \t\n\x0b\x0c\r"


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        stripped = text.rstrip(WHITE)
        if not stripped:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if stripped[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def all_edits(rows):
    """The least (cost, audit, turns) over every choice of edits, with up to three insertions in a row."""
    found, faults = [], faults_of(rows)
    gaps = [list(itertools.chain.from_iterable(itertools.product(("user", "assistant"), repeat=n) for n in range(3)))] * (len(rows) + 1)
    choices = [["D"] if f in ("blank", "duplicate") else ["D", "K", "Ruser", "Rassistant"] for f in faults]
    for kept in itertools.product(*choices):
        for added in itertools.product(*gaps):
            cost, audit, turns = 0, "", []
            for i in range(len(rows) + 1):
                cost, audit, turns = cost + 2 * len(added[i]), audit + "I" * len(added[i]), turns + [(r, "") for r in added[i]]
                if i < len(rows):
                    what = kept[i]
                    audit += what[0]
                    cost += {"D": 3, "K": 0, "R": 2}[what[0]] + (what != "D" and faults[i] == "truncated")
                    if what != "D":
                        turns = turns + [(rows[i][1] if what == "K" else what[1:], rows[i][2])]
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in turns)):
                found.append((cost, audit, turns))
    return min(found)


def plain(rows):
    """The same by memoized search over (row, role before)."""
    faults = faults_of(rows)
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(i, state, inserted=0):
        options = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserted < 2:
            c, a, t = best(i, after[state], inserted + 1)
            options.append((c + 2, "I" + a, (({"u": "user", "a": "assistant"}[after[state]], ""), *t)))
        if i < len(rows):
            _, role, text = rows[i]
            c, a, t = best(i + 1, state)
            options.append((c + 3, "D" + a, t))
            if faults[i] in ("", "truncated"):
                more = faults[i] == "truncated"
                if role[:1] == after[state] or (role[:1] == "s" and state == ""):
                    c, a, t = best(i + 1, role[:1])
                    options.append((c + more, "K" + a, ((role, text), *t)))
                c, a, t = best(i + 1, after[state])
                options.append((c + more + 2, "R" + a, (({"u": "user", "a": "assistant"}[after[state]], text), *t)))
        return min(options, default=(10**9, "", ()))

    return best(0, "")


def expected(conv_id, rows, solve):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults = faults_of(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, out = solve(rows)
    whole = "\n".join(f"{r}:{t}" for r, t in out)
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (conv_id, gaps, *counts, illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest())


def made(seed, n, length):
    pick = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", " "]
    texts = ["Yes.", "No!", "cut", " ", "", "end. \n", "why?\t", "ü", "x" * 50 + ".", " "]
    return {
        c: [(pick.choice([None, *range(6)]), pick.choice(roles), pick.choice(texts)) for _ in range(pick.randint(*length))]
        for c in range(n)
    }


def frame(spark, conversations):
    rows = [(c, t, r, x, "a", "b", "c") for c, own in conversations.items() for t, r, x in own]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def got(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=repr)


def test_the_program_finds_the_least_of_all_edits():
    for rows in made(1, 60, (0, 3)).values():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        cost, audit, turns = all_edits(rows)
        assert (cost, audit, tuple(turns)) == plain(rows)


def test_reports_of_awkward_conversations(spark):
    conversations = {None: [(0, "user", "Hi."), (None, "assistant", "x")], **made(2, 300, (1, 14))}
    conversations[1000] = [(t, ("user", "assistant")[t % 2], f"{t}.") for t in range(3000)]
    want = []
    for c, rows in conversations.items():
        want.append(expected(c, rows, plain if len(rows) < 100 else lambda rows: (0, "K" * len(rows), [r[1:] for r in rows])))
    for df in (frame(spark, conversations), frame(spark, conversations).repartition(1)):
        assert got(repair.report(df)) == sorted(want, key=repr)
    assert repair.report(frame(spark, {})).count() == 0
    null = repair.report(spark.createDataFrame([(1, None, None, None)], "conv_id long, turn long, role string, text string"))
    assert got(null) == [(1, 0, 1, 0, 0, 0, 3, "D", hashlib.sha256(b"").hexdigest())]


def test_state_is_carried_across_batches(spark):
    conversations = made(3, 20, (30, 60))
    want = sorted((expected(c, rows, plain) for c, rows in conversations.items()), key=repr)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert got(repair.report(frame(spark, conversations))) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_repaired_turns_are_a_conversation(spark):
    conversations = made(4, 40, (1, 9))
    turns = {}
    for r in repair.repaired(frame(spark, conversations)).orderBy("conv_id", "place").collect():
        turns.setdefault(r.conv_id, []).append(r)
    for c, rows in conversations.items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        own = turns.get(c, [])
        assert tuple((r.role, r.text) for r in own) == plain(rows)[2]
        assert [r.place for r in own] == list(range(len(own)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in own))


def test_the_registered_query(spark, tmp_path):
    pick = random.Random(5)
    rows = [(c, t, pick.choice(["user", "assistant", None]), pick.choice(["A.", "b", None, "C! d?"])) for c in range(120) for t in range(pick.randint(1, 5))]
    rows += [(500, None, "user", "Hm."), (None, 3, "user", "So?"), (None, None, None, None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    after = {}
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        after.setdefault(c, []).extend([(t, role, text)] * {0: 0, 3: 2}.get(kind, 1))
    assert any(not own for own in after.values())
    want = sorted((expected(c, own, plain) for c, own in after.items()), key=repr)
    assert got(queries.QUERIES["op12_conversation_repair"](spark, str(tmp_path))) == want
