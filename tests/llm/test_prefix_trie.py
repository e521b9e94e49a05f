import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest

from merchantry.llm import prefix_trie
from merchantry.llm.rows import table

SCHEMA = "conv_id long, turn long, role string, text string, Text int, depth string, node string"


def expected(rows):
    """The contract, node by node."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, mine in own.items():
        base, h = c - int(math.fmod(c, 20)), zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(base, [])[:h] + mine[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
        ends[tuple(seq)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    below = {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved, leaves = (len(members[node]) - 1) * words, 0 if children[node] else 1
        for child in children[node]:
            saved, leaves = saved + below[child][0], leaves + below[child][1]
        below[node] = (saved, leaves)
    return sorted(((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), below[n][1], below[n][0],
                    hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items()), key=repr)


def found(df):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "d", "n") for r in rows], SCHEMA)


AWKWARD = [
    (0, None, "user", None), (0, 0, None, "a b"), (0, 3, "user", "c"), (1, 0, "user", "x"), (21, 5, "user", "x y  z"), (22, 1, "u", ""), (22, 1, "u", ""),
    (None, 1, "user", "lost"), (40, 1, "user", "long " * 20_000), (41, 1, "user", "q"), (42, 1, "user", "q"), (43, 1, "user", "q"), (44, 1, "user", "q"),
    (45, 1, "user", "q"), (46, 1, "user", "q"), (47, 1, "user", "q"), (60, 1, "a", "bc"), (80, 1, "ab", "c"), (-7, 1, "user", "z"), (-7, 2, "user", "w"),
]


def test_awkward_rows(spark):
    assert found(prefix_trie.conversation_trie(frame(spark, AWKWARD))) == expected(AWKWARD)
    assert prefix_trie.conversation_trie(frame(spark, [])).count() == 0


def test_given_table(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))) == expected(rows)


@pytest.mark.parametrize("part_bits", [1, 10])
def test_long_and_alike(spark, part_bits):
    """Conversations of up to 300 turns over few texts, in parts of two turns and in one; a third of them are equal."""
    draw = random.Random(part_bits)
    rows = []
    for c in range(90):
        if c % 3 == 0:
            rows += [(c, t, "user", f"same {t % 4}") for t in range(9)]
        else:
            rows += [(c, t, "user", draw.choice(["a", "a b", "c d e"])) for t in range(draw.choice([1, 2, 4, 8, 16]))]
    rows += [(1000, t, "user", f"same {t % 4}") for t in range(300)] + [(1020, t, "user", f"same {t % 4}") for t in range(301)]
    draw.shuffle(rows)
    assert found(prefix_trie.trie(frame(spark, rows), part_bits)) == expected(rows)
