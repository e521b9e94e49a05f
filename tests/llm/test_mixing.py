import hashlib
import re

import pytest

from merchantry.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shared_out(sizes, weights=(1, 2, 3), most=3):
    """Targets by handing the excess out again until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_, target = sum(sizes.values()), set(order), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] >= most * sizes[s]}
        for s in full or open_:
            target[s] = most * sizes[s] if full else share * weight[s]
        if not full:
            break
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def expected(rows):
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    sizes = {}
    for n, (_, _, s) in zip(size, rows):
        sizes[s] = sizes.get(s, 0) + n
    target = shared_out(sizes)
    out = []
    for n, (i, _, s) in zip(size, rows):
        rate = min(3.0, target[s] / sizes[s]) if sizes[s] else 0.0
        digest = hashlib.md5(f"mix:{'null' if i is None else i}".encode()).hexdigest()
        copies = int(rate) + (int(digest[:13], 16) / 2**52 < rate - int(rate))
        out.append((i, n, sizes[s], target[s], n * copies))
    return out


def check(df, rows):
    got = [tuple(r)[:5] for r in mixing.mixed_documents(df).collect()]
    want = expected(rows)
    key = lambda r: tuple(repr(x) for x in r[:2])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:3] == w[:3] and g[4] == w[4] and g[3] == pytest.approx(w[3])


def test_awkward_rows(awkward, nothing):
    from llm_rows import AWKWARD
    check(awkward, AWKWARD)
    assert mixing.mixed_documents(nothing).count() == 0


def test_limits_and_hot_source(documents):
    rows = [(k, "w " * (k % 7), "hot") for k in range(300)] + [(1000 + k, "x y", f"s{k % 5}") for k in range(60)]
    rows += [(2000 + k, "only one", "é") for k in range(3)] + [(3000, "", "empty")]
    check(documents(rows), rows)


def test_mix_emits_rows(documents):
    rows = [(k, "a b c", f"s{k % 3}") for k in range(200)]
    df = documents(rows)
    plan = {r["doc_id"]: r["copies"] for r in mixing.planned(df).select("doc_id", "copies").collect()}
    out = mixing.mix(df)
    assert out.columns == df.columns
    got = {}
    for r in out.collect():
        got[r[0]] = got.get(r[0], 0) + 1
    assert got == {i: n for i, n in plan.items() if n}
