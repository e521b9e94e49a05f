import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from merchantry.llm import repair
from merchantry.llm.rows import table

SCHEMA = "conv_id long, turn long, role string, text string, Text int, known string, mark string"
EMPTY = hashlib.sha256(b"").hexdigest()


def damage(rows):
    out = []
    for c, t, r, x in rows:
        f = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if f == 1 else re.sub("[.!?]", "", x) if f == 2 else x
        out += [(c, t, "user" if f == 4 else r, x)] * (0 if f == 0 else 2 if f == 3 else 1)
    return out


def order(row):
    c, t, r, x = row
    return t is not None, t or 0, hashlib.sha256(f"{len(r.encode())}:{r}{len(x.encode())}:{x}".encode()).digest()


def cheapest(rows, faults):
    """Least (cost, audit) by a plain search from every place and role sequence so far; the repaired rows."""
    last = {"": "", "s": "s", "u": "u", "a": "a"}

    def allowed(state, role):
        return {"": "su", "s": "u", "u": "a", "a": "u"}[state].find(role) >= 0 and role != ""

    @lru_cache(maxsize=None)
    def best(i, state, inserts):
        found = []
        if i == len(rows):
            if state in ("", "a"):
                found.append((0, "", ()))
        else:
            role, text = rows[i][2], rows[i][3]
            extra = 3 if faults[i] == "truncated" else 0
            cost, audit, out = best(i + 1, state, 0)
            found.append((4 + cost, "D" + audit, out))
            if faults[i] not in ("blank", "duplicate"):
                if role[:1] in last and allowed(state, role[:1]):
                    cost, audit, out = best(i + 1, role[:1], 0)
                    found.append((extra + cost, "K" + audit, (f"{role}:{text}", *out)))
                for new in ("user", "assistant"):
                    if allowed(state, new[0]):
                        cost, audit, out = best(i + 1, new[0], 0)
                        found.append((3 + extra + cost, "R" + audit, (f"{new}:{text}", *out)))
        for new in ("user", "assistant"):
            if inserts < 3 and allowed(state, new[0]):
                cost, audit, out = best(i, new[0], inserts + 1)
                found.append((3 + cost, "I" + audit, (f"{new}:", *out)))
        return min(found) if found else (10**9, "", ())

    return best(0, "", 0)


def report(rows):
    rows, seen, faults, illegal = sorted(rows, key=order), set(), [], 0
    for k, (_, _, r, x) in enumerate(rows):
        end = re.findall(r"[^\x20\x09-\x0D]", x)
        faults.append("blank" if not end else "duplicate" if (r, x) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((r, x))
        illegal += k > 0 and rows[k - 1][2][:1] + r[:1] not in ("su", "ua", "au")
    turns = {t for _, t, _, _ in rows if t is not None}
    cost, audit, out = cheapest(rows, faults)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal,
            cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def expected(rows, hurt=damage):
    groups = defaultdict(list)
    for r in hurt(rows):
        groups[r[0]].append(r)
    return sorted(((c, *(report(groups[c]) if groups[c] else (0, 0, 0, 0, 0, 0, "", EMPTY))) for c in {r[0] for r in rows}), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", "m") for r in rows], SCHEMA)


AWKWARD = [
    (1, None, "user", None), (1, 0, None, "a b."), (1, 3, "tool", "c?"), (2, 0, "user", "x"), (3, 5, "system", "s."), (4, 1, "u", ""), (4, 1, "u", ""),
    (None, 1, "user", "lost."), (None, 7, "user", "lost."), (40, 1, "user", "long. " * 20_000), (41, 1, "assistant", "q!  \n"), (42, 1, "", "q."), (5, 1, "system", "a."),
    (5, 2, "system", "b."), (5, 2, "system", "b."), (6, 1, "user", "a"), (6, 1, "user", "b"), (6, 1, "assistant", "c"), (-7, -5, "user", "z."), (-7, 9, "assistant", "w."),
    (0, 0, "User", "Large."), (0, 1, "assistant", "."), (8, 1, "usual", "x."), (8, 2, "answer", "y."), (9, 1, "über", "z. "), (9, 2, "user", " "),
]


def conversation(draw, c, n):
    """Mostly in order, with faults, and stretches of other roles, whose costs never converge."""
    rows, role = [], "user"
    for t in range(n):
        if draw.random() < 0.1:
            role = draw.choice(["user", "assistant", "system", "tool"])
        rows.append((c, t + (draw.random() < 0.05), role, draw.choice(["a.", "b", "", f"own {t}.", f"own {t}.", f"own {t}", f"own {t}!"])))
        role = {"user": "assistant", "assistant": "user", "tool": "tool"}.get(role, "user")
    return rows


def test_awkward_rows(spark):
    assert found(repair.repaired_conversations(frame(spark, AWKWARD))) == expected(AWKWARD)
    assert repair.repaired_conversations(frame(spark, [])).count() == repair.repaired(frame(spark, [])).count() == 0


def test_given_table(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(repair.repaired_conversations(table(spark, sf_dir, "conversations"))) == expected(rows)


@pytest.mark.parametrize("bits", [0, 2])
def test_chunks_of_few_rows(spark, bits):
    """Chunks of one row and of four: most vectors have to be fixed."""
    draw = random.Random(bits)
    rows = [r for c in range(40) for r in conversation(draw, c, draw.choice([1, 2, 3, 9, 30, 60]))]
    rows += [(100, t, "tool", f"own {t}.") for t in range(50)] + [(101, t, "user", f"own {t}.") for t in range(50)]
    rows += [(102, t, ("user", "assistant")[t % 2], f"own {t}.") for t in range(51)]
    draw.shuffle(rows)
    assert found(repair.reports(frame(spark, rows), bits)) == expected(rows, hurt=list)


def test_passes(spark):
    """Chunks that never converge are fixed in as many passes as their number has bits; ordinary ones in a few."""
    stretch = [(1, t, "tool", f"own {t}.") for t in range(64)]
    parts = repair.chunks(repair.marked(frame(spark, stretch)), 0)
    exact, passes = repair.converged(parts)
    assert 1 <= passes <= 7
    costs = {r.chunk: (tuple(r.end), tuple(r.start)) for r in exact.collect()}
    order = sorted(costs)
    assert costs[order[-1]][0] == repair.END and all(costs[a][1] == costs[b][0] for a, b in zip(order[1:], order))


def test_repaired_rows(spark):
    """Rows that stay are the ones the hash is of, and their roles are in order."""
    rows = [r for c in range(10) for r in conversation(random.Random(c), c, 25)]
    df = frame(spark, rows)
    texts = defaultdict(list)
    for r in repair.repaired(df).filter("edit != 'D'").orderBy("conv_id", "place").collect():
        texts[r.conv_id].append(f"{r.role}:{r.text}")
    for r in repair.reports(df).collect():
        assert r.repaired_sha256 == hashlib.sha256("\n".join(texts[r.conv_id]).encode()).hexdigest()
        assert re.fullmatch("(s?(ua)+)?", "".join(t[0] for t in texts[r.conv_id]))
    edits = repair.repaired(df).groupBy("conv_id").agg(F.array_join(F.sort_array(F.collect_list(F.struct("place", "edit")))["edit"], "").alias("audit"))
    assert {tuple(r) for r in edits.collect()} == {(r.conv_id, r.audit) for r in repair.reports(df).collect()}
