from llm_rows import AWKWARD

from merchantry.llm import line_dedup


def expected(rows):
    """Windows in the order of id and position; later ones cover their lines."""
    lines = {(i, t): t.split("\n") for i, t, _ in rows if t is not None}
    seen, covered = set(), {k: set() for k in lines}
    for key in sorted(lines, key=lambda k: (k[0] is not None, k[0] or 0)):
        own = lines[key]
        for at in range(len(own) - 2):
            window = tuple(own[at : at + 3])
            if not any(window):
                continue
            if window in seen:
                covered[key] |= {at, at + 1, at + 2}
            seen.add(window)
    return {k: "\n".join(x for n, x in enumerate(own) if n not in covered[k]) for k, own in lines.items()}


def check(df, rows):
    want = expected(rows)
    got = sorted(((r.doc_id, r.text) for r in line_dedup.deduped_lines(df).collect()), key=repr)
    assert got == sorted(((i, None if t is None else want[i, t]) for i, t, _ in rows), key=repr)


def test_awkward_rows(awkward, nothing):
    check(awkward, AWKWARD)
    assert line_dedup.deduped_lines(nothing).count() == 0
    assert line_dedup.drop_repeated_lines(awkward).columns == awkward.columns


def test_passages(documents):
    passage = "one\ntwo\nthree\nfour"
    rows = [(k, f"own {k}\n{passage}\nend {k}", "s") for k in range(60)]
    rows += [(100, "\n".join(["same"] * 9), "s"), (101, "same\nsame\nother\nx\ny", "s"), (102, "\n\n\n\na\n\n\n\n", "s"), (103, "\n\n\n\nb", "s")]
    rows += [(104, "two\nthree\nfour\nend 3\nnew", "s"), (105, "a|b\nc\nd", "s"), (106, "a\nb|c\nd", "s")]
    check(documents(rows), rows)


def test_counts(documents):
    out = {r.doc_id: (r.n_lines, r.n_removed) for r in line_dedup.deduped_lines(
        documents([(1, "a\nb\nc", "s"), (2, "a\nb\nc\nd", "s"), (3, None, "s")])).collect()}
    assert out == {1: (3, 0), 2: (1, 3), 3: (0, 0)}
