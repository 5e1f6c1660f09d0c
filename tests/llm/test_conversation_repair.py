"""Repair of conversations against an exhaustive search, and the registered query against a brute-force version of it."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from caudal.llm import conversation_repair as cr
from caudal.llm.queries import op11_conversation_repair

SPACE = " \t\n\x0b\x0c\r"
VALID = re.compile(r"(s?(ua)+)?\Z")


def content(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def in_order(rows):
    """Rows with copies, by turn, nulls first, then by digest."""
    rows = [(t, " " if r is None else r, " " if x is None else x, n) for t, r, x, n in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, content(r[1], r[2])))
    return [r[:3] for r in rows for _ in range(r[3])]


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        last = text.rstrip(SPACE)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, lines) by a search over what has been said so far: nothing, a system row alone, or whose turn it was."""
    best = {"": (0, "", ())}

    def with_inserts(now):
        out = dict(now)
        for _ in range(3):
            for k, (cost, audit, lines) in list(out.items()):
                role = "assistant" if k == "u" else "user"
                item = (cost + 3, audit + "I", (*lines, f"{role}:"))
                if role[0] not in out or item[:2] < out[role[0]][:2]:
                    out[role[0]] = item
        return out

    for (_, role, text), fault in zip(rows, faults(rows), strict=True):
        now = {}
        for k, (cost, audit, lines) in with_inserts(best).items():
            offers = [(k, cost + 4, "D", lines)]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                for edit, name in (("K", role), ("R", "user"), ("R", "assistant")):
                    if (k, name[:1]) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                        offers.append((name[0], cost + more + 3 * (edit == "R"), edit, (*lines, f"{name}:{text}")))
            for state, spent, edit, said in offers:
                item = (spent, audit + edit, said)
                if state not in now or item[:2] < now[state][:2]:
                    now[state] = item
        best = now
    return min(v for k, v in with_inserts(best).items() if k in ("", "a"))


def every_repair(rows):
    """All audits of few rows, tried one by one, with up to two inserts in each gap."""
    found = faults(rows)
    options = []
    for (_, role, _), fault in zip(rows, found, strict=True):
        more = 3 if fault == "truncated" else 0
        mine = [("D", 4, "")]
        if fault not in ("blank", "duplicate"):
            # A row without role has no initial that fits.
            mine += [("K", more, role[:1] or "-"), ("R", 3 + more, "u"), ("R", 3 + more, "a")]
        options.append(mine)
    inserts = [("", 0, "")] + [("I" * n, 3 * n, x) for n in (1, 2) for x in map("".join, itertools.product("ua", repeat=n))]
    best = None
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        for edits in itertools.product(*options):
            steps = [x for pair in zip(gaps, [*edits, ("", 0, "")], strict=True) for x in pair]
            if VALID.match("".join(s[2] for s in steps)):
                item = (sum(s[1] for s in steps), "".join(s[0] for s in steps))
                best = item if best is None else min(best, item)
    return best


def facts(rows):
    rows = in_order(rows)
    found, turns = faults(rows), [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, lines = cheapest(rows)
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, *[found.count(f) for f in ("blank", "duplicate", "truncated")], pairs, cost, audit, digest


def run(spark, rows, parts=8):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, copies int, audit string, place string")
        decided = cr.decisions(df.repartition(3)).cache()
        lines = cr.digests(cr.repaired(df, decided)).collect()
        shown = {r["conv_id"]: r["sha256"] for r in lines}
        assert len(shown) == len(lines)
        empty = hashlib.sha256(b"").hexdigest()
        rows = decided.collect()
        assert len({r["conv_id"] for r in rows}) == len(rows)
        return {r["conv_id"]: (*r[1:], shown.get(r["conv_id"], empty)) for r in rows}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def made(rng, n, roles=("user", "assistant", "system", "tool", "", None), texts=("a.", "b!", "c", "", " ", "d? ", None, "e.")):
    return [(rng.choice([None, *range(n)]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"t{rng.random()}.", rng.choice([1, 1, 1, 2])) for _ in range(n)]


def test_search_agrees_with_trying_everything():
    rng = random.Random(1)
    for _ in range(60):
        rows = in_order([(t, r, x, 1) for t, r, x, _ in made(rng, rng.randint(0, 3))])
        assert cheapest(rows)[:2] == every_repair(rows)


def test_short_conversations(spark):
    rng = random.Random(2)
    talks = {i: made(rng, rng.randint(1, 9)) for i in range(150)}
    rows = [(i, *r) for i, talk in talks.items() for r in talk]
    assert run(spark, rows) == {i: facts(talk) for i, talk in talks.items()}


def test_a_conversation_with_most_rows_is_spread_over_tasks(spark):
    rng = random.Random(3)
    talks = {i: made(rng, n) for i, n in ((1, 3), (2, 700), (3, 4), (4, 9000))}
    rows = [(i, *r) for i, talk in talks.items() for r in talk]
    assert run(spark, rows, 12) == {i: facts(talk) for i, talk in talks.items()}


def test_odd_rows(spark):
    talks = {
        None: [(None, None, None, 1), (0, "user", "x.", 1)], 1: [(0, "user", "", 1)], 2: [(5, "user", "x." * 200_000, 1), (9, "user", "y", 1)],
        3: [(0, "user", "same.", 500)], 4: [(0, "system", "s.", 1)], 5: [(0, "tool", "x.", 1), (0, "tool", "x.", 1)], 6: [(None, "user", "a.", 1), (None, "assistant", "b.", 1)],
    }
    rows = [(i, *r) for i, talk in talks.items() for r in talk]
    assert run(spark, rows) == {i: facts(talk) for i, talk in talks.items()}
    assert run(spark, []) == {}


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_registered_query(spark, size):
    talks, all_ids = {}, set()
    for r in spark.read.parquet(f"/root/testdata/{size}/conversations.parquet").collect():
        key = f"{' ' if r['conv_id'] is None else r['conv_id']}:{' ' if r['turn'] is None else r['turn']}"
        fault = zlib.crc32(key.encode()) % 20
        all_ids.add(r["conv_id"])
        role, text = r["role"], " " if r["text"] is None else r["text"]
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            talks.setdefault(r["conv_id"], []).append((r["turn"], "user" if fault == 4 else role, text, 2 if fault == 3 else 1))
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    found = op11_conversation_repair(spark, f"/root/testdata/{size}")
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [
        ("conv_id", "bigint"), *[(c, "bigint") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", "string"), ("repaired_sha256", "string")]
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(all_ids)
    assert {r[0]: r[1:] for r in rows} == {i: facts(talks[i]) if i in talks else none for i in all_ids}


def test_lines_are_real_outputs(spark):
    df = spark.createDataFrame([(1, 0, "tool", "a."), (1, 1, "assistant", "b."), (1, 2, "user", "c.")], "conv_id long, turn long, role string, text string")
    lines = cr.repaired(df, cr.decisions(df)).orderBy("conv_id", "place").select("place", "edit", "role", "text")
    assert [tuple(r) for r in lines.collect()] == [(0, "R", "user", "a."), (1, "K", "assistant", "b."), (2, "K", "user", "c."), (3, "I", "assistant", "")]
    assert cr.repaired(df.where(F.lit(False)), cr.decisions(df.where(F.lit(False)))).count() == 0
