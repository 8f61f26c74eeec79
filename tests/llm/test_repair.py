import hashlib
import random
import re
import zlib

import pytest

from clickweave.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, place int, copy string, same int, audit int"


def cheapest(row, entry, exits):
    """Dynamic programming over (rows read, last role): the least (cost, edits)."""
    def with_inserts(best):
        for _ in range(3):
            for s, (c, e) in list(best.items()):
                t = cr.NEXT[s]
                best[t] = min(best.get(t, (c + 5, e + "I")), (c + 5, e + "I"))
        return best

    best = with_inserts({entry: (0, "")})
    for ch in row:
        new = {}
        for s, (c, e) in best.items():
            ways = [(s, c + 2, "D")]
            if ch.isalpha():
                extra, role = (5 if ch.isupper() else 0), "sua".find(ch.lower()) + 1
                ways.append((cr.NEXT[s], c + 1 + extra, "R"))
                if role and (role == cr.NEXT[s] or (role == 1 and s == 0)):
                    ways.append((role, c + extra, "K"))
            for t, cost, edit in ways:
                new[t] = min(new.get(t, (cost, e + edit)), (cost, e + edit))
        best = with_inserts(new)
    return min(best[x] for x in exits if x in best)


def test_search_finds_the_ascii_least_of_the_cheapest():
    r = random.Random(2)
    for _ in range(1500):
        row = "".join(r.choice("suaxSUAX1234uauauaua") for _ in range(r.randint(0, 11)))
        for entry in range(4):
            exits = (0, 3) if entry == 0 else (r.choice([2, 3]),)
            assert cr.search(row, entry, exits) == cheapest(row, entry, exits)
    long_row = "".join("ua"[i % 2] if r.random() > 0.25 else r.choice("UA12us") for i in range(400))
    assert cr.search(long_row, 0, (0, 3)) == cheapest(long_row, 0, (0, 3))


def awkward():
    r = random.Random(7)
    rows = []
    for conv in [*range(40), None]:
        for turn in range(r.randint(1, 9)):
            text = " ".join(r.choice(["ab", "cd", "ef"]) for _ in range(r.randint(1, 2))) + r.choice([".", "!", "?", "", " \n", ".\x0b"])
            rows.append((conv, turn if r.random() > 0.1 else None, ["user", "assistant"][turn % 2] if r.random() > 0.2 else
                         r.choice(["system", "tool", "", None, "ux", "Assistant"]), text if r.random() > 0.1 else r.choice([None, "", "\t"])))
    rows += [rows[0], rows[0], (50, 3, "user", "x" * 60_000 + "."), (50, 3, "assistant", "é漢🙂."), (51, None, None, None)]
    return rows


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def expected(rows, ids):
    """Plain definitions, rows of one turn by role and hash."""
    out = {}
    digest = lambda x: hashlib.sha256(f"{len(x[2])}:{x[2]}{x[3]}".encode()).digest()
    for conv in ids:
        mine = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2].encode(), digest(x)))
        seen, faults = set(), []
        for _, _, role, text in mine:
            bare = re.sub(r"[\x20\x09-\x0d]", "", text)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
        row = "".join(cr.symbol(x[2][:1], f) for x, f in zip(mine, faults, strict=True))
        cost, audit = cheapest(row, 0, (0, 3))
        fixed, state, it = [], 0, iter(mine)
        for edit in audit:
            x = ("", "", "", "") if edit == "I" else next(it)
            if edit != "D":
                state = cr.STATES.index(x[2][0]) if edit == "K" else cr.NEXT[state]
                fixed.append((x[2] if edit == "K" else ("user", "assistant")[state - 2], x[3]))
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0][0] for x in fixed))
        turns = [x[1] for x in mine if x[1] is not None]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False)), cost, audit, fixed)
    return out


@pytest.mark.parametrize("piece", [128, 1, 3])
def test_repair_against_plain_definitions(spark, piece):
    rows = awkward()
    df = spark.createDataFrame([(*x, 1, "c", 2, 3) for x in rows], SCHEMA)
    bad = cr.damage(df)
    assert sorted(map(repr, damaged(rows))) == sorted(repr(tuple(r)) for r in bad.collect())
    want = expected(damaged(rows), {x[0] for x in rows})
    got = cr.repair(bad, df, piece=piece).collect()
    assert len(got) == len(want)
    for r in got:
        *head, fixed = want[r.conv_id]
        body = "\n".join(f"{a}:{b}" for a, b in fixed)
        assert tuple(r)[1:] == (*head, hashlib.sha256(body.encode()).hexdigest())


def test_repaired_rows(spark):
    rows = damaged(awkward())
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = expected(rows, {x[0] for x in rows})
    got = {}
    for r in cr.repaired(df).orderBy("conv_id", "place").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {c: w[-1] for c, w in want.items() if w[-1]}


def test_a_conversation_in_many_pieces_and_the_empty_table(spark):
    r = random.Random(3)
    rows = [(1, i, ["user", "assistant"][i % 2], f"text {i}" + r.choice([".", ".", ".", ""])) for i in range(900)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    one = cr.repair(df, piece=1000).collect()
    assert one == cr.repair(df, piece=50).collect()
    assert (one[0].cost, one[0].audit) == expected(rows, {1})[1][5:7]
    assert cr.repair(cr.damage(df.limit(0)), df.limit(0)).collect() == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    only = spark.createDataFrame([(gone, 0, "user", "a.")], "conv_id long, turn long, role string, text string")
    assert [tuple(x) for x in cr.repair(cr.damage(only), only).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
