import random

from llm_rows import AWKWARD, LONG

from merchantry.llm import near_dedup
from merchantry.llm.rows import table


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def expected(rows):
    """All pairs of documents by their whole sets."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    inside = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            inside.setdefault(x, []).append(k)
    pairs = {(a, b) for ks in inside.values() for n, a in enumerate(ks) for b in ks[n + 1 :]}
    for a, b in pairs:
        (i, s), (j, t) = sets[a], sets[b]
        if i is not None and j is not None and 100 * len(s & t) >= 75 * len(s | t):
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i), True if i is None else find(i) == i) for i, s in sets), key=repr)


def got(df):
    return sorted((tuple(r) for r in near_dedup.deduped_documents(df).collect()), key=repr)


def test_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(docs) == expected(rows)


def test_awkward_rows(awkward, nothing):
    assert got(awkward) == expected([(i, t) for i, t, _ in AWKWARD])
    assert got(nothing) == []
    assert near_dedup.drop_near_copies(awkward).columns == awkward.columns
    assert near_dedup.drop_near_copies(awkward).filter("doc_id = 6").count() == 0


def edited(words, rnd, n):
    out = list(words)
    for k in rnd.sample(range(len(out)), n):
        out[k] = f"x{rnd.random()}"
    return " ".join(out)


def test_copies_linked_by_their_original_only(documents):
    """More copies than a region holds, each like the original, many unlike each other."""
    rnd = random.Random(3)
    base = [f"w{k}" for k in range(400)]
    rows = [(k + 10, edited(base, rnd, 10), "s") for k in range(700)] + [(5, " ".join(base), "s")]
    rows += [(2000 + k, "same words in every row of this group", "s") for k in range(50)]
    rows += [(3000 + k, f"boiler plate text that many short rows begin with and then {k}", "s") for k in range(40)]
    rows += [(4000, LONG, "s"), (4001, LONG + " more", "s")]
    assert got(documents(rows)) == expected([(i, t) for i, t, _ in rows])


def test_limit_is_exact(documents):
    """Sets that share exactly 75 of 100, and one shingle less."""
    head = [f"a{k}" for k in range(79)]  # 75 shingles
    x = head + [f"b{k}" for k in range(10)]
    y = head + [f"c{k}" for k in range(15)]
    z = head + [f"d{k}" for k in range(16)]
    rows = [(1, " ".join(x), "s"), (2, " ".join(y).upper(), "s"), (3, " ".join(z), "s")]
    out = {r[0]: r[2] for r in got(documents(rows))}
    assert out == {r[0]: r[2] for r in expected([(i, t) for i, t, _ in rows])}
    assert out[2] == 1


def test_long_chain(documents):
    words = [f"v{k}" for k in range(300)]
    rows = [(k, " ".join(words[k * 4 : k * 4 + 100]), "s") for k in range(40)]
    result = got(documents(rows))
    assert result == expected([(i, t) for i, t, _ in rows]) and {r[2] for r in result} == {0}
