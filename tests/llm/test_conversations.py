"""Conversation repair against a plain version that keeps every audit as a string."""

import hashlib
import os
import random
import re
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from conftest import SF  # noqa: E402

from gridlloyd.llm import conversations, queries  # noqa: E402
from gridlloyd.llm import turn_edits as te  # noqa: E402
from gridlloyd.session import Scratch  # noqa: E402

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
WORD = {"u": "user", "a": "assistant"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def repaired(rows):
    """(cost, audit, lines) of one conversation: the least (cost, audit) of every state, row by row."""
    def inserted(best):
        for _ in range(2):
            for state, (cost, audit, lines) in list(best.items()):
                new = NEXT[state]
                other = (cost + 3, audit + "I", [*lines, f"{WORD[new]}:"])
                best[new] = min(best.get(new, other), other)
        return best

    best = {"": (0, "", [])}
    for role, text, fault in rows:
        after = {}
        for state, (cost, audit, lines) in inserted(best).items():
            options = [(state, (cost + 4, audit + "D", lines))]
            if fault not in ("b", "d"):
                extra = 3 if fault == "t" else 0
                options.append((NEXT[state], (cost + 3 + extra, audit + "R", [*lines, f"{WORD[NEXT[state]]}:{text}"])))
                if role[:1] == "s" and state == "" or role[:1] in ("u", "a") and role[:1] == NEXT[state]:
                    options.append((role[:1], (cost + extra, audit + "K", [*lines, f"{role}:{text}"])))
            for new, entry in options:
                after[new] = min(after.get(new, entry), entry)
        best = after
    return min(v for state, v in inserted(best).items() if state in ("", "a"))


def plain(rows):
    out = {}
    groups = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in damage(rows):
        groups[conv].append((turn, role, text))
    for conv, members in groups.items():
        members.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1].encode(), m[2].encode()))
        seen, judged = set(), []
        for _, role, text in members:
            body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            judged.append((role, text, "b" if not body else "d" if (role, text) in seen else "" if body[-1] in ".!?" else "t"))
            seen.add((role, text))
        numbers = [t for t, *_ in members if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(judged, judged[1:])]
        cost, audit, lines = repaired(judged)
        out[conv] = (conv, gaps, *(sum(j[2] == f for j in judged) for f in "bdt"), sum(p not in ("su", "ua", "au") for p in pairs),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return sorted(out.values(), key=repr)


def awkward(seed=1, count=120):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", None, "", "tool", "usual", "agent", "System"]
    texts = ["Hello.", "Hello", "Why?", "Fine!\n ", "", None, " \t\n", "No end \x0b", "é.", "x" * 30_000 + ".", "a\x00b.", "...", " "]
    rows = []
    for conv in [*range(count), None, -7]:
        for turn in range(rng.randrange(9)):
            rows.append((conv, rng.choice([turn, turn, turn, turn * 3, None, turn - 1]), rng.choice(roles), rng.choice(texts)))
    rows += [(900, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(40)] + [(901, 5, "user", "Same.")] * 30
    rows += [(902, -2**63, "user", "a."), (902, 2**63 - 1, "assistant", "b.")]
    rng.shuffle(rows)
    return rows


def run(spark, rows, folder):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, at int, audit string")
    frame.repartition(3).write.parquet(f"{folder}/conversations.parquet")
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = queries.op11_conversation_repair(spark, str(folder)).select(*names).collect()
    return sorted((tuple(r) for r in found), key=repr)


def test_awkward_rows(spark, tmp_path):
    want = [(*r[:1], min(r[1], 2**63 - 1), *r[2:]) for r in plain(awkward())]
    assert run(spark, awkward(), tmp_path) == want


def test_conversations_over_many_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE_BITS", 3)
    rng = random.Random(5)
    rows = awkward(2, 10) + [(1000, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "No", f"{t}.", "?"])) for t in range(700)]
    want = [(*r[:1], min(r[1], 2**63 - 1), *r[2:]) for r in plain(rows)]
    assert run(spark, rows, tmp_path) == want


def test_no_rows(spark, tmp_path):
    assert run(spark, [], tmp_path) == []


def test_given_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = sorted((tuple(r) for r in queries.op11_conversation_repair(spark, SF).collect()), key=repr)
    assert found == plain(rows)


def test_messages_give_the_digests(spark):
    rows = [r for r in awkward(3, 30)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    repair = conversations.Repair(frame, Scratch(spark))
    lines = {}
    for m in sorted(repair.messages().collect(), key=lambda m: (m["place"], m["part"])):
        lines.setdefault(m["conv_id"], []).append(f"{m['role']}:{m['text']}")
    for conv, digest in repair.digests().collect():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == digest
    initials = {conv: "".join(x[0] for x in made) for conv, made in lines.items()}
    assert all(re.fullmatch("(s?(ua)+)?", i) for i in initials.values())


@pytest.mark.parametrize("seed", range(3))
def test_divide_and_conquer_equals_stored_strings(seed):
    rng = random.Random(seed)
    for _ in range(300):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), "x", rng.choice(["", "", "t", "b"])) for _ in range(rng.randrange(14))]
        codes = [te.code(r[0], {"": te.CLEAN, "t": te.TRUNCATED}.get(f, te.MUST_GO)) for r, _, f in rows]
        end, cost = te.best_end(te.forward(te.only(te.START), [te.ROW_STEPS[c] for c in codes]))
        audit = "".join(te.letters(codes, te.START, end)[0]) + te.TAIL[end]
        assert (cost, audit) == repaired(rows)[:2]
        cut = rng.randrange(len(codes) + 1)
        steps = [te.whole_step(codes[:cut]), te.whole_step(codes[cut:])]
        assert te.best_end(te.forward(te.only(te.START), steps)) == (end, cost)
