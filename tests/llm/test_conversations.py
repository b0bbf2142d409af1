"""Conversation repair against a search over all edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from bazaar.llm import conversations, queries

WHITE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = defaultdict(list)
    blank = lambda x: " " if x is None else x
    for conv, turn, role, text in rows:
        out[conv]
        kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    return out


def edits(rows, faults):
    """The cheapest, then ASCII-least, edit string and its conversation: shortest paths over (row, roles so far)."""
    import heapq

    state = lambda roles: (len(roles), roles[-1:]) if len(roles) < 2 else ("+", roles[-1:])
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, roles, made = heapq.heappop(heap)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, "\n".join(made)
        if (at, state(roles)) in seen:
            continue
        seen.add((at, state(roles)))
        ok = lambda r: re.fullmatch("s?(ua)*u?", r)
        for role in ("user", "assistant"):
            if ok(roles + role[0]):
                heapq.heappush(heap, (cost + 2, audit + "I", at, roles + role[0], (*made, f"{role}:")))
        if at < len(rows):
            _, own, text = rows[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, roles, made))
            if faults[at] not in ("blank", "duplicate"):
                extra = faults[at] == "truncated"
                if own[:1] in ("s", "u", "a") and ok(roles + own[:1]):
                    heapq.heappush(heap, (cost + extra, audit + "K", at + 1, roles + own[:1], (*made, f"{own}:{text}")))
                for role in ("user", "assistant"):
                    if ok(roles + role[0]):
                        heapq.heappush(heap, (cost + extra + 2, audit + "R", at + 1, roles + role[0], (*made, f"{role}:{text}")))


def plain(rows):
    out = []
    for conv, own in damage(rows).items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in own:
            bare = text.strip(WHITE)
            faults.append(
                "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            )
            seen.add((role, text))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        starts = [r[1][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(starts, starts[1:]))
        cost, audit, text = edits(own, faults)
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def made(seed, n):
    draw = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        for turn in range(draw.randint(0, 9)):
            rows.append((
                conv, draw.choice([turn, turn, turn, turn * 2, None, 0, -3]),
                draw.choice(["system", "user", "user", "assistant", "assistant", "tool", "sage", None, "", "User"]),
                draw.choice(["Yes.", "No!", "Why? ", "cut", "a.b", " ", "", None, "é. ", " ", "x" * 50 + ".", "Yes.\n"]),
            ))
    return rows + rows[:7]


def rows_of(spark, rows, partitions=3):
    """Through the same columns as the query, beside others of clashing names."""
    chats = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, dropped string, fault int")
    found = conversations.repaired(conversations.damaged(chats.repartition(partitions)), "dropped")
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(map(tuple, found.collect()), key=repr)


def test_odd_conversations(spark):
    rows = made(1, 400)
    assert rows_of(spark, rows) == plain(rows)


def test_table(spark, sf):
    chats = queries.table(spark, sf, "conversations")
    found = sorted(map(tuple, queries.conversation_repair(spark, sf).collect()), key=repr)
    assert found == plain([(r.conv_id, r.turn, r.role, r.text) for r in chats.collect()])


def test_giant_conversation_spills(spark, monkeypatch):
    """One conversation over many Arrow batches; the choices of its rows go to a file."""
    monkeypatch.setattr(conversations, "SPILL_BYTES", 900)
    draw = random.Random(5)
    rows = [(draw.choice([1, 1, 2]), i, draw.choice(["user", "assistant", "system"]), draw.choice([f"t{i}.", f"u{i}", " "])) for i in range(4000)]
    one = conversations.Repair()
    kept = sorted(damage(rows)[1], key=lambda r: r[0])
    faults = [conversations_fault(kept, i) for i in range(len(kept))]
    for (turn, role, text), found in zip(kept, faults, strict=True):
        one.add(turn, role, text, found)
    assert one.choices.file is not None
    whole = {r[0]: r for r in plain(rows)}
    assert (1, *one.result()) == whole[1]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        assert rows_of(spark, rows) == sorted(whole.values(), key=repr)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def conversations_fault(rows, i):
    bare = rows[i][2].strip(WHITE)
    if not bare:
        return "blank"
    if rows[i][1:] in [r[1:] for r in rows[max(0, i - 1) : i]]:
        return "duplicate"
    return None if bare[-1] in ".!?" else "truncated"


def test_all_dropped_empty_and_clash(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert rows_of(spark, [(gone, 0, "user", "Hi.")]) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    assert rows_of(spark, []) == []
    chats = spark.createDataFrame([(1, 0, "user", "Hi.", "yes")], "conv_id bigint, turn bigint, role string, text string, dropped string")
    assert conversations.repaired(chats).first().audit == "KI"


@pytest.mark.parametrize("seed", range(3))
def test_ties(seed):
    """Short conversations of few kinds of rows, where many edits cost the same."""
    draw = random.Random(seed)
    for _ in range(300):
        rows = [(i, draw.choice(["system", "user", "assistant", "tool"]), f"{i}" + draw.choice(["", "."])) for i in range(draw.randint(0, 7))]
        faults = [None if t.endswith(".") else "truncated" for _, _, t in rows]
        one = conversations.Repair()
        for row, found in zip(rows, faults, strict=True):
            one.add(*row, found)
        *_, cost, audit, digest = one.result()
        wanted = edits(rows, faults)
        assert (cost, audit, digest) == (*wanted[:2], hashlib.sha256(wanted[2].encode()).hexdigest())
