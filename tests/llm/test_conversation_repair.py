"""Repairs against the cheapest of all edits, found state by state with the audits themselves."""

import functools
import hashlib
import random
import re
import zlib

import pytest

from tidegate.llm import conversation_repair as repair

STATES = {"": 0, "s": 1, "u": 2, "a": 3}
LEGAL = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
EMPTY = hashlib.sha256(b"").hexdigest()


def best_edits(rows):
    """rows: (role, text, fault). The least (cost, audit) with the turns it makes."""
    @functools.cache
    def best(i, state, inserted):
        out = []
        if i == len(rows) and state in (0, 3):
            out.append((0, "", ()))
        if inserted < 2:
            for role in ("user", "assistant"):
                if (state, role[0]) in LEGAL:
                    cost, audit, turns = best(i, LEGAL[state, role[0]], inserted + 1)
                    out.append((cost + 3, "I" + audit, ((role, ""), *turns)))
        if i < len(rows):
            role, text, fault = rows[i]
            cost, audit, turns = best(i + 1, state, 0)
            out.append((cost + 4, "D" + audit, turns))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                for letter, name, price in (("K", role, 0), ("R", "user", 3), ("R", "assistant", 3)):
                    if (state, name[:1]) in LEGAL:
                        cost, audit, turns = best(i + 1, LEGAL[state, name[:1]], 0)
                        out.append((cost + price + extra, letter + audit, ((name, text), *turns)))
        return min(out, key=lambda o: o[:2], default=(10**9, "", ()))
    return best(0, 0, 0)


def expected(table):
    out, by = {}, {}
    for conv, turn, role, text in table:
        by.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        by[conv] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        if not rows:
            out[conv] = (0, 0, 0, 0, 0, 0, "", EMPTY)
            continue
        seen, faulty = set(), []
        for _, role, text in rows:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = ("blank" if not words else "duplicate" if (role, text) in seen
                     else "truncated" if words[-1] not in ".!?" else None)
            seen.add((role, text))
            faulty.append((role, text, fault))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        count = [sum(f == name for _, _, f in faulty) for name in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(faulty, faulty[1:]))
        cost, audit, made = best_edits(faulty)
        text = "\n".join(f"{r}:{t}" for r, t in made)
        out[conv] = (gaps, *count, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


ROLES = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "User"]
TEXTS = ["one.", "two!", "cut", " \t", "", None, "three? ", "four.\n", "five, six", "x" * 3000 + "."]


def table(rng, conversations, most):
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, most)):
            role = rng.choice(ROLES) if rng.random() < 0.5 else ["user", "assistant"][turn % 2]
            text = rng.choice(TEXTS) if rng.random() < 0.4 else f"text {conv} {turn}."
            rows.append((conv, rng.choice([turn, turn, turn, turn * 3]), role, text))
    return rows


def frame(spark, rows):
    """With other columns whose names the operator might use itself."""
    rows = [(*r, 7, "z", b"k", None) for r in rows]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, __row long, conv string, "
                                       "no binary, _seq int").coalesce(1)


def found(spark, rows):
    got = repair.repair_damaged(frame(spark, rows)).collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: tuple(r)[1:] for r in got}


def test_against_all_edits(spark):
    rows = table(random.Random(1), 60, 9)
    rows += [(None, 1, "user", "no id."), (None, None, "assistant", "first."), (100, None, "user", "only null turn."),
             (101, 5, None, None), (102, 1, "user", "a."), (102, 1, "user", "a."), (103, 1, "system", "s.")]
    rows += rows[:5]
    assert found(spark, rows) == expected(rows)


@pytest.mark.parametrize("passes", [1, 6])
def test_long_conversations_in_chunks(spark, monkeypatch, passes):
    """Conversations of one role or of rows that must go do not settle; chunks of their own do."""
    monkeypatch.setattr(repair, "CHUNK", 3)
    monkeypatch.setattr(repair, "PASSES", passes)
    rows = table(random.Random(2), 6, 70)
    rows += [(50, t, "user", f"user {t}.") for t in range(40)] + [(51, t, "assistant", "same.") for t in range(33)]
    rows += [(52, t, "system", f"s {t}.") for t in range(17)] + [(53, t, "user", " ") for t in range(20)]
    rows += [(54, t, ["user", "assistant"][t % 2], f"t {t}.") for t in range(64)]
    assert found(spark, rows) == expected(rows)


def test_turns_and_report(spark):
    rows = [(1, 0, "assistant", "hello."), (1, 1, "user", "hi."), (1, 2, "user", "there")]
    made = repair.repair_conversations(frame(spark, rows))
    cost, audit, turns = best_edits((("assistant", "hello.", None), ("user", "hi.", None), ("user", "there", "truncated")))
    assert [(r.role, r.text) for r in made.turns.orderBy("seq", "sub").collect()] == list(turns)
    report = made.report.collect()
    assert [(r.conv_id, r.cost, r.audit) for r in report] == [(1, cost, audit)]


def test_empty_table(spark):
    assert repair.repair_damaged(frame(spark, [(1, 1, "user", "x")]).where("false")).collect() == []


def test_machine_forgets_by_constants():
    """The costs to go of any rows are few, once their least is taken off."""
    machine, rng = repair.Machine(), random.Random(3)
    for _ in range(300):
        machine.back("".join(rng.choice(repair._KINDS) for _ in range(50)), repair._END)
    assert len(machine.costs) < 100
