"""Conversation repair against brute force, and its edge cases."""

import hashlib
import itertools
import random
import zlib

import pytest

from tariffscope.llm import chat_repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def _damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def _cheapest(rows):
    """(cost, audit, repaired lines) by trying all edits, state by state; rows are (role, text, fault)."""
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def with_inserts(best):
        todo = list(best.items())
        while todo:
            state, (cost, audit, lines) = todo.pop()
            for q in legal[state]:
                if q != "s":
                    new = (cost + 2, audit + "I", [*lines, f"{names[q]}:"])
                    if q not in best or new[:2] < best[q][:2]:
                        best[q] = new
                        todo.append((q, new))
        return best

    best = with_inserts({"": (0, "", [])})
    for role, text, fault in rows:
        after = {}

        def offer(q, cost, audit, lines, after=after):
            if q not in after or (cost, audit) < after[q][:2]:
                after[q] = (cost, audit, lines)

        for state, (cost, audit, lines) in best.items():
            offer(state, cost + 3, audit + "D", lines)
            if fault in ("", "truncated"):
                extra = fault == "truncated"
                if role[:1] and role[:1] in legal[state]:
                    offer(role[:1], cost + extra, audit + "K", [*lines, f"{role}:{text}"])
                for q in legal[state]:
                    if q != "s":
                        offer(q, cost + 2 + extra, audit + "R", [*lines, f"{names[q]}:{text}"])
        best = with_inserts(after)
    return min((best[q] for q in ("", "a") if q in best), key=lambda x: x[:2])


def _brute(rows):
    out = {}
    known = _damage(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in known if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        seen, told, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, _, role, text in mine:
            end = text.rstrip(WHITE)[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            told.append((role, text, fault))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(told))
        turns = {r[1] for r in mine if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit, lines = _cheapest(told)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, digest)
    return out


def _sample(seed, n):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "User", None]
    texts = ["One.", "Two!", "cut short", "Why? ", "  \n", "", None, "é…", "end.\n\t", " "]
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 12)):
            odd = rng.random() < 0.3
            role = rng.choice(roles) if odd else ("user", "assistant")[turn % 2]
            text = rng.choice(texts) if odd else f"{conv} says {turn}."
            rows.append((conv, turn * rng.choice([1, 1, 2]) if odd else turn, role, text))
    # one row for each turn: the order of others is not the contract's
    return list({(r[0], r[1]): r for r in rows}.values())


def _found(df):
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def _run(spark, rows):
    return _found(chat_repair.repaired(chat_repair.damaged(spark.createDataFrame(rows, SCHEMA).repartition(3))))


def test_against_brute_force(spark):
    rows = _sample(1, 300) + [(None, 0, "user", "Hi."), (None, None, "assistant", "Ho."), (900, None, "user", "A?"), (901, 7, None, None)]
    assert _run(spark, rows) == _brute(rows)


@pytest.mark.parametrize("part_bytes", [24 << 20, 500])
def test_one_conversation_over_all_partitions(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(chat_repair, "PART_BYTES", part_bytes)
    rng = random.Random(2)
    rows = [(5, t, rng.choice(["user", "assistant", "assistant", "tool"]), rng.choice([f"Row {t}.", "Same.", "cut", ""])) for t in range(400)]
    rows += [(4, t, ("user", "assistant")[t % 2], f"{t}!") for t in range(6)] + [(9, 0, "system", "S.")]
    assert _run(spark, rows) == _brute(rows)


def test_long_runs_are_one_power():
    for symbols in (bytes([6] * 20_000), bytes([3, 6] * 3_000), bytes([2] * 5000 + [4] * 5000), bytes([0, 0, 3, 5, 9, 10, 7]), b""):
        cost, edits = chat_repair.repair(symbols)
        letters = "".join(edits)
        rows = [("sua?"[s // 3], "x", ("", "truncated", "blank")[s % 3]) for s in symbols]
        if len(rows) < 100:
            assert (cost, letters) == _cheapest(rows)[:2]
        price = {"K": 0, "R": 2, "D": 3, "I": 2}
        stays = sum(s % 3 == 1 for s, e in zip(symbols, edits, strict=False) if e[-1] != "D")
        assert cost == sum(price[x] for x in letters) + stays


def test_repeated_rows_ties_empty_tables_and_extra_columns(spark):
    rows = [(1, 0, "user", "Hello."), (1, 0, "user", "Hello."), (1, 1, "assistant", "Yes."), (1, 1, "user", "No."), (2, None, None, None)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", part string, at int")
    got = _found(chat_repair.repaired(chat_repair.damaged(docs)))
    assert got == _run(spark, rows[::-1]) and got[1][2] >= 1 and set(got) == {1, 2}
    assert _found(chat_repair.repaired(chat_repair.damaged(docs.limit(0)))) == {}
    empty = hashlib.sha256(b"").hexdigest()
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert _run(spark, [(dropped, 0, "user", "Gone.")]) == {dropped: (0, 0, 0, 0, 0, 0, "", empty)}


def test_very_long_text(spark):
    rows = [(1, 0, "user", "long " * 200_000), (1, 1, "assistant", " " * 300_000 + "x.")]
    assert _run(spark, rows) == _brute(rows)
