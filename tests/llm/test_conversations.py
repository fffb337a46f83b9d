"""Conversation repair against an exhaustive search and a plain table of complete edit strings."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from cutline.llm import catalog, conversation_repair as repair
from tests.llm import plain

BLANK = re.compile(r"[^\x20\x09-\x0d]")
LEGAL = re.compile(r"(s?(ua)+)?")


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        marks = BLANK.findall(text)
        fault = 3 if not marks else 2 if (role, text) in seen else 1 if marks[-1] not in ".!?" else 0
        seen.add((role, text))
        out.append(fault)
    return out


def exhaustive(rows):
    """The least (cost, initials) over all edits, with up to two insertions at each place."""
    found, best = faults(rows), None
    places = [["", "I"] if n else ["", "I", "II"] for n in range(len(rows) + 1)]
    ways = []
    for (role, _), fault in zip(rows, found):
        late = 5 if fault == 1 else 0
        own = [(2, "D", "")]
        if fault < 2:
            own += [(late, "K", role[:1] or " "), (1 + late, "R", "u"), (1 + late, "R", "a")]
        ways.append(own)
    for edits in product(*ways):
        for added in product(*places):
            cost = sum(e[0] for e in edits) + 5 * sum(map(len, added))
            if best and cost > best[0]:
                continue
            for roles in product("ua", repeat=sum(map(len, added))):
                left, initials, audit = iter(roles), "", ""
                for n, inserted in enumerate(added):
                    initials += "".join(next(left) for _ in inserted)
                    audit += inserted
                    if n < len(edits):
                        initials, audit = initials + edits[n][2], audit + edits[n][1]
                if LEGAL.fullmatch(initials) and (best is None or (cost, audit) < best):
                    best = cost, audit
    return best


def tabled(rows, costs=repair.COSTS):
    """(cost, initials, repaired rows) with a whole string and all rows in every state."""
    table = {0: (0, "", ())}

    def inserted(table):
        for _ in range(4):
            for state, (cost, audit, kept) in list(table.items()):
                to = {0: 2, 1: 2, 2: 3, 3: 2}[state]
                way = (cost + costs["I"], audit + "I", (*kept, ("user" if to == 2 else "assistant", "")))
                if to not in table or way[:2] < table[to][:2]:
                    table[to] = way
        return table

    table = inserted(table)
    for (role, text), fault in zip(rows, faults(rows)):
        late, new = costs["truncated"] if fault == 1 else 0, {}
        for state, (cost, audit, kept) in table.items():
            ways = [(state, cost + costs["D"], "D", kept)]
            for initial, to in {0: [("s", 1), ("u", 2)], 1: [("u", 2)], 2: [("a", 3)], 3: [("u", 2)]}[state]:
                if fault < 2 and role[:1] == initial:
                    ways.append((to, cost + costs["K"] + late, "K", (*kept, (role, text))))
                if fault < 2 and to > 1:
                    ways.append((to, cost + costs["R"] + late, "R", (*kept, ("user" if to == 2 else "assistant", text))))
            for to, total, edit, rows_kept in ways:
                if to not in new or (total, audit + edit) < new[to][:2]:
                    new[to] = total, audit + edit, rows_kept
        table = inserted(new)
    return min(table[s] for s in (0, 3) if s in table)


def searched(rows, costs=repair.COSTS):
    search, edits, most = repair.Repair(costs), [], 0
    for (role, text), fault in zip(rows, faults(rows)):
        edits += search.add(role, text, fault)
        most = max(most, search.held)
    last, cost = search.end()
    edits += last
    return cost, "".join(e for e, _, _ in edits), tuple((r, t) for e, r, t in edits if e != "D"), most


def conversation(rng, size):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", ""]
    return [(rng.choice(roles), rng.choice(["", " \n", "Yes.", "No!", "cut", "a.", "b.", "c?", "d. ", "e"]) + rng.choice(["", str(n) + "."]))
            for n in range(size)]


def test_repair_like_an_exhaustive_search():
    rng = random.Random(2)
    for _ in range(150):
        rows = conversation(rng, rng.randrange(0, 5))
        assert searched(rows)[:2] == exhaustive(rows), rows


@pytest.mark.parametrize("costs", [repair.COSTS, {"K": 0, "R": 3, "D": 2, "I": 1, "truncated": 1}, {"K": 1, "R": 1, "D": 1, "I": 1, "truncated": 0}])
def test_repair_like_whole_strings(costs):
    rng = random.Random(3)
    for _ in range(300):
        rows = conversation(rng, rng.randrange(0, 40))
        assert searched(rows, costs)[:3] == tabled(rows, costs), rows


def test_memory_is_bounded():
    rng = random.Random(4)
    for share in (0, 0.05, 0.2):
        rows = [("system", "Be kind.")] + [
            (rng.choice(["user", "system", "tool"]) if rng.random() < share else ("user", "assistant")[n % 2],
             f"{n}{rng.choice(['.', '.', '!', ''])}") for n in range(20_000)]
        assert searched(rows)[3] < 500
    blank = [("user", "")] * 20_000
    assert searched(blank)[3] < 200


def test_no_leak_and_no_free_insertion():
    search = repair.Repair()
    for n in range(50):
        search.add("user", f"{n}.", 0)
    alive = set()
    for _, node in search.best.values():
        while node is not None:
            alive.add(id(node))
            node = node.before
    assert search.held == len(alive)
    with pytest.raises(ValueError):
        repair.Repair({**repair.COSTS, "I": 0})


def damage(rows):
    """Damaged rows by conversation in order, nulls of role and text as a space."""
    out = {}
    for conv_id, turn, role, text in rows:
        own = out.setdefault(conv_id, [])
        key = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def expected(rows):
    out = []
    for conv_id, own in damage(rows).items():
        found = faults([r[1:] for r in own])
        turns = [t for t, _, _ in own if t is not None]
        initials = [r[:1] or " " for _, r, _ in own]
        cost, audit, kept = tabled([r[1:] for r in own])
        out.append((
            conv_id, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            found.count(3), found.count(2), found.count(1),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_repair_query(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in plain.table("conversations")]
    found = catalog.all_queries()["op11_conversation_repair"](spark, plain.SF)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows)


def test_repair_odd_rows(spark, folder):
    rng = random.Random(8)
    rows = [
        (conv, rng.choice([None, -5, n, n, 10**12]), rng.choice(["user", "assistant", "system", None, "", "User"]),
         rng.choice([None, "", " \t", "Same.", "Same.", "Längst. 😀", "no end", "x. \n", "w " * 60_000 + "."]))
        for conv in [None, *range(-3, 40)] for n in range(rng.randrange(1, 9))]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "conv_id long, turn long, role string, text string, copy int, fault string")
    df.write.parquet(f"{folder}/conversations.parquet")
    found = repair.op11_conversation_repair(spark, folder)
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows)
    empty = f"{folder}/empty"
    df.limit(0).write.parquet(f"{empty}/conversations.parquet")
    assert repair.op11_conversation_repair(spark, empty).count() == 0


def test_repaired_rows_give_the_digest(spark):
    rows = repair.damaged(spark.read.parquet(f"{plain.SF}/conversations.parquet"))
    edits = repair.repaired(rows)
    own = F.array_sort(F.collect_list(F.struct("at", "edit", "role", "text")))
    grouped = edits.groupBy("conv_id").agg(own.alias("own"))
    digests = {
        r["conv_id"]: ("".join(e["edit"] for e in r["own"]),
                       plain.sha("\n".join(f"{e['role']}:{e['text']}" for e in r["own"] if e["edit"] != "D")))
        for r in grouped.collect()}
    assert digests == {r["conv_id"]: (r["audit"], r["repaired_sha256"]) for r in repair.summaries(rows).collect()}


def test_one_shuffle(spark):
    rows = repair.damaged(spark.read.parquet(f"{plain.SF}/conversations.parquet"))
    plan = repair.summaries(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
