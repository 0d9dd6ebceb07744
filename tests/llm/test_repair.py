import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from scrubjay.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
_SOLID = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    """rows in order: (turn, role, text) -> fault of each."""
    seen, out = set(), []
    for _, role, text in rows:
        solid = _SOLID.findall(text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen
                   else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def in_order(rows):
    return sorted(((t, r or " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda v: (v[0] is not None, v[0] or 0, v[1], hashlib.sha256(v[2].encode()).hexdigest()))


def plain(rows):
    """(cost, audit, repaired) by trying every edit of every row, with up to two inserts in each gap."""
    bad = faults(rows)
    gaps = [g for k in range(3) for g in itertools.product("ua", repeat=k)]
    best = None
    for inserts in itertools.product(gaps, repeat=len(rows) + 1):
        for edits in itertools.product("DKua", repeat=len(rows)):
            cost, audit, said = 0, "", []
            for i, gap in enumerate(inserts):
                cost += 3 * len(gap)
                audit += "I" * len(gap)
                said += [(r, "") for r in gap]
                if i == len(rows):
                    break
                (_, role, text), edit, fault = rows[i], edits[i], bad[i]
                audit += edit if edit in "DK" else "R"
                cost += 4 if edit == "D" else (0 if edit == "K" else 3) + (3 if fault == "truncated" else 0)
                if edit != "D":
                    if fault in ("blank", "duplicate"):
                        break
                    said.append((role if edit == "K" else edit, text))
            else:
                continue
            if i < len(rows) or not re.fullmatch("(s?(ua)+)?", "".join(r[:1] if len(r) > 1 else r for r, _ in said)) \
                    or any(r[:1] == "" for r, _ in said):
                continue
            if best is None or (cost, audit) < best[:2]:
                name = {"u": "user", "a": "assistant"}
                best = cost, audit, "\n".join(f"{name.get(r, r)}:{x}" for r, x in said)
    return best


def stats(rows):
    bad = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[bad.count(k) for k in (
        "blank", "duplicate", "truncated")], sum(p not in ("su", "ua", "au") for p in pairs))


def results(spark, rows, parts=None, ids=None):
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.repartition(parts) if parts else df
    out = repair.repair(df, spark.createDataFrame([(i,) for i in ids], "conv_id long") if ids else None).collect()
    return {r.conv_id: tuple(r)[1:] for r in out}


def test_least_edits_equal_trying_all(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for conv in range(60):
        own = [(rng.choice([0, 1, 2, 3, None]), rng.choice(["system", "user", "user", "assistant", "assistant", "tool", None]),
                rng.choice(["Yes.", "No!", "cut off", "Yes.", "", " \n", "Why? \t", None, "é"]))
               for _ in range(rng.choice([0, 1, 2, 2]))]
        rows += [(conv, *r) for r in own]
        ordered = in_order(own)
        cost, audit, text = plain([(t, r, x) for t, r, x in ordered])
        want[conv] = (*stats(ordered), cost, audit, hashlib.sha256(text.encode()).hexdigest())
    assert results(spark, rows, ids=range(60)) == want


def dynamic(rows):
    """(cost, audit, repaired) by dynamic programming that carries whole audits and texts."""
    moves = {"0": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "b"}, "b": {"u": "u"}}
    name = {"u": "user", "a": "assistant"}

    def insert(states):
        states = dict(states)
        for _ in range(2):
            for st, (cost, audit, said) in list(states.items()):
                for r in "ua":
                    to = moves[st].get(r)
                    if to and (to not in states or (cost + 3, audit + "I") < states[to][:2]):
                        states[to] = cost + 3, audit + "I", [*said, f"{name[r]}:"]
        return states

    now = {"0": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults(rows)):
        new = {}
        for st, (cost, audit, said) in insert(now).items():
            fine = 3 if fault == "truncated" else 0
            options = [(st, cost + 4, audit + "D", said)]
            if fault not in ("blank", "duplicate"):
                options += [(moves[st].get(role[:1]), cost + fine, audit + "K", [*said, f"{role}:{text}"])]
                options += [(moves[st].get(r), cost + 3 + fine, audit + "R", [*said, f"{name[r]}:{text}"]) for r in "ua"]
            for to, *value in options:
                if to and (to not in new or tuple(value[:2]) < new[to][:2]):
                    new[to] = tuple(value)
        now = new
    cost, audit, said = min(v for st, v in insert(now).items() if st in "0b")
    return cost, audit, "\n".join(said)


def test_a_conversation_over_many_partitions(spark):
    """A third of all rows in one conversation, split over tasks, repeated texts and turns included."""
    rng = random.Random(9)
    rows = [(7, i // 2 if i % 50 else None, rng.choice(["user", "assistant", "system", "user", "assistant"]),
             rng.choice([f"Text {i % 400}.", f"cut {i}", " ", "Same!"])) for i in range(1500)]
    rows += [(100 + i // 3, i % 3, "user" if i % 2 else "assistant", f"t{i}.") for i in range(3000)]
    got = results(spark, rows, parts=9)
    assert len(got) == 1001
    for conv in (7, 100, 555):
        own = in_order([r[1:] for r in rows if r[0] == conv])
        cost, audit, text = dynamic(own)
        assert got[conv] == (*stats(own), cost, audit, hashlib.sha256(text.encode()).hexdigest())
    assert results(spark, rows, parts=2) == got


def test_pieces_chain_like_one_parse():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randint(1, 12)
        initials, bad = [rng.choice("suax") for _ in range(n)], [rng.randrange(4) for _ in range(n)]
        cut = sorted(rng.sample(range(1, n), rng.randint(0, min(3, n - 1)))) if n > 1 else []
        pieces = []
        for a, b in zip([0, *cut], [*cut, n]):
            pieces.append([{"start": s, "stop": t, "cost": c, "audit": x} for s in repair.ACTIONS
                           for t, c, x in repair.parse(initials[a:b], bad[a:b], s)])
        cost, taken, last = repair.chain(pieces)
        whole = [{"start": 0, "stop": t, "cost": c, "audit": x} for t, c, x in repair.parse(initials, bad, 0)]
        one, ways, end = repair.chain([whole])
        assert (cost, "".join(w["audit"] for w in taken) + last) == (one, ways[0]["audit"] + end)


def test_automaton_accepts_the_role_grammar():
    for n in range(7):
        for word in map("".join, itertools.product("sua", repeat=n)):
            top = 0
            for symbol in word:
                top = repair.push(top, symbol) if top is not None else None
            assert (top in repair.ACCEPT) == bool(re.fullmatch("(s?(ua)+)?", word))


def test_damage_and_odd_rows(spark):
    rows = [(i, t, "user" if t % 2 else "assistant", f"A. b! c? {i}") for i in range(40) for t in range(5)]
    got = repair.damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    import zlib
    kinds = {(i, t): zlib.crc32(f"{i}:{t}".encode()) % 20 for i, t, _, _ in rows}
    for i, t, role, text in rows:
        own = [(r.role, r.text) for r in got if (r.conv_id, r.turn) == (i, t)]
        kind = kinds[i, t]
        assert own == {0: [], 1: [(role, "")], 2: [(role, text.translate({ord(c): None for c in ".!?"}))],
                       3: [(role, text)] * 2, 4: [("user", text)]}.get(kind, [(role, text)])
    assert results(spark, []) == {}
    long = "word " * 400_000 + "."
    got = results(spark, [(None, None, None, None), (None, 1, "user", long), (None, 2, "assistant", long)], ids=[3])
    assert got[3] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[None][5:] == (4, "DKK", hashlib.sha256(f"user:{long}\nassistant:{long}".encode()).hexdigest())
    wide = spark.createDataFrame([(1, 0, "user", "Hi.", "x", 1)], SCHEMA + ", tie string, piece int")
    assert repair.repair(wide).first().audit == "KI"


@pytest.mark.parametrize("ids", [["a", "b"]])
def test_ids_of_another_type(spark, ids):
    df = spark.createDataFrame([(i, 0, "user", "Hi.") for i in ids], "conv_id string, turn int, role string, text string")
    assert {r.conv_id: r.cost for r in repair.repair(df).collect()} == {i: 3 for i in ids}
    assert repair.repair(repair.damaged(df), df.select(F.col("conv_id"))).count() == len(ids)
