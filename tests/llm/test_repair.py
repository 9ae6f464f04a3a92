"""Conversation repair against enumeration, a full interval chart, a state-by-state search and a plain recomputation."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from listingmart.llm import repair
from listingmart.llm.common import table

SF = "/root/testdata/sf0.01"
SOUND = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, kind string, letter string, h1 string, audit string"
LETTERS = [chr(65 + i) for i in range(16)]


def _options(letter):
    """(cost, edit, role initial) of one row."""
    role, fault = divmod(ord(letter) - 65, 4)
    yield 2, "D", ""
    if fault < 2:
        yield 5 * fault, "K", "sua?"[role]
        for to in "ua":
            yield 1 + 5 * fault, "R", to


def _enumerated(letters):
    """The cheapest edits, of all: up to two rows inserted at each place."""
    gaps = [(5 * n, "I" * n, "".join(r)) for n in range(3) for r in itertools.product("ua", repeat=n)]
    found = []
    for choice in itertools.product(gaps, *[x for r in letters for x in (list(_options(r)), gaps)]):
        if SOUND.fullmatch("".join(c[2] for c in choice)):
            found.append((sum(c[0] for c in choice), "".join(c[1] for c in choice)))
    return min(found)


def _searched(letters):
    """Right to left over states, complete audits of what is left."""
    step, states = repair._STEP, range(4)
    best = {p: ((0, "") if p in (0, 3) else None) for p in states}

    def closed(best):
        for _ in range(4):
            now = {}
            for p in states:
                ahead = [best[step[p, r]] for r in "ua" if (p, r) in step]
                now[p] = min([x for x in [best[p], *((5 + a[0], "I" + a[1]) for a in ahead if a)] if x], default=None)
            best = now
        return best
    best = closed(best)
    for letter in reversed(letters):
        now = {}
        for p in states:
            found = []
            for cost, edit, role in _options(letter):
                q = p if edit == "D" else step.get((p, role))
                if q is not None and best[q]:
                    found.append((cost + best[q][0], edit + best[q][1]))
            now[p] = min(found, default=None)
        best = closed(now)
    return best[0]


def _chart(letters):
    """Every span with every division."""
    n, cell = len(letters), {}
    for i in range(n):
        cell[i, i + 1] = repair.leaf(letters[i])
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            parts = [repair.combine(cell[i, k], cell[k, i + size]) for k in range(i + 1, i + size)]
            cell[i, i + size] = {s: min(p[s] for p in parts if s in p) for s in set().union(*parts)}
    return cell[0, n] if n else repair.EMPTY


def test_all_short_conversations():
    for n in range(3):
        for letters in itertools.product(LETTERS, repeat=n):
            assert repair.best(repair.parse("".join(letters))) == _enumerated(letters) == _searched(letters)


def test_longer_conversations():
    rng = random.Random(5)
    for _ in range(3):
        letters = rng.choices(LETTERS, k=3)
        assert repair.best(repair.parse("".join(letters))) == _enumerated(letters)
    for n in (4, 7, 12, 40):
        for _ in range(25):
            letters = "".join(rng.choices(LETTERS, k=n))
            assert repair.best(repair.parse(letters)) == _searched(letters)
            if n < 13:
                assert repair.parse(letters) == _chart(letters)  # one division of a span is enough
    letters = "".join(rng.choices(LETTERS, k=3000))
    assert repair.best(repair.parse(letters)) == _searched(letters)


def _plain(rows):
    """The query's columns but the gaps, from rows in order."""
    seen, letters = set(), ""
    for role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        fault = 3 if not end else 2 if (role, text) in seen else 1 if end not in ".!?" else 0
        seen.add((role, text))
        letters += chr(65 + 4 * {"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + fault)
    cost, audit = _searched(letters)
    lines, last, at = [], "", 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else rows[at]
        at += edit != "I"
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if last == "u" else "user"
        last = role[0]
        lines.append(f"{role}:{text}")
    faults = [(ord(x) - 65) % 4 for x in letters]
    roles = ["sua?"[(ord(x) - 65) // 4] for x in letters]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(roles))
    return (faults.count(3), faults.count(2), faults.count(1), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault:
            row = (conv, turn, "user" if fault == 4 else role, "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text)
            out += [row] * (1 + (fault == 3))
    return out


def _whole(rows):
    from xxhash import xxh64_intdigest

    def signed(x):
        return x - (1 << 64) * (x >> 63)
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in _damaged(rows) if r[0] == conv),
                     key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), signed(xxh64_intdigest(r[3].encode(), seed=42))))
        turns = {r[1] for r in own} - {None}
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *_plain([r[2:] for r in own]))
    return out


HARD = ([(1, t, r, x) for t, r, x in [(0, "user", "Hi."), (1, "assistant", "Yes!"), (1, "assistant", "Yes!"), (5, "tool", "x."), (9, "user", "Why?")]]
        + [(2, None, None, None), (2, None, "user", "A."), (2, 3, "", "B."), (None, 0, "user", "Q?"), (None, None, "assistant", "no stop"),
           (3, 0, "system", ""), (4, 2, "user", " \t\n"), (5, -3, "assistant", "end.) "), (5, 7, "USER", "é."), (6, 1, "usr", "kept.")]
        + [(7, t, "user" if t % 2 else "assistant", f"long {t % 50}." + " word" * (t % 7)) for t in range(900)])


def _compare(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA).repartition(5).write.parquet(f"{path}/conversations.parquet")
    got = repair.op12_conversation_repair(spark, path)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r.conv_id: tuple(r)[1:] for r in got.collect()}


def test_hard_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", 64)  # conversation 7 takes several blocks
    assert _compare(spark, HARD, tmp_path) == _whole(HARD)


def test_empty_table(spark, tmp_path):
    assert _compare(spark, [], tmp_path) == {}


def test_query_over_the_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert {r.conv_id: tuple(r)[1:] for r in repair.op12_conversation_repair(spark, SF).collect()} == _whole(rows)


@pytest.mark.parametrize("audit, rows, lines", [
    ("IK", [("assistant", "x.")], ["user:", "assistant:x."]), ("", [], []), ("DD", [("a", "x"), ("b", "y")], []),
    ("KKRI", [("system", "s."), ("user", "u."), ("user", "v.")], ["system:s.", "user:u.", "assistant:v.", "user:"])])
def test_replay(audit, rows, lines):
    r = repair.Replay(audit)
    assert [x for role, text in rows for x in r.row(role, text)] + list(r.inserted()) == lines
