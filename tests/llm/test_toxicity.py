import random
import tracemalloc
import zlib

import numpy as np
from llm_rows import AWKWARD
from pyspark.sql import types as T

from merchantry.llm import toxicity
from merchantry.llm.rows import table


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("toxic", T.IntegerType()), T.StructField("Toxic", T.StringType())])


def labels_of(spark, rows):
    return spark.createDataFrame([(i, y, "x") for i, y in rows], LABELS)


def test_awkward_rows(spark, awkward, nothing):
    for labels in (labels_of(spark, []), labels_of(spark, [(1, 0), (1, 1), (2, 1), (None, 1), (3, None), (99, 1), (7, 0)])):
        out = toxicity.scored_documents(awkward, labels).collect()
        assert sorted([r.doc_id for r in out], key=repr) == sorted([r[0] for r in AWKWARD], key=repr)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == held(r.doc_id) for r in out)
        assert toxicity.scored_documents(nothing, labels).count() == 0
        assert toxicity.accepted(awkward, labels).columns == awkward.columns


def test_held_out_accuracy(spark, documents):
    """Words of two made-up languages mark label 1; one in fifty labels is wrong."""
    rnd = random.Random(4)
    clean = [f"{a}{b}" for a in ("ba", "do", "ke", "mi", "ru") for b in ("lan", "tes", "vor", "nik", "sam", "pel")]
    rows, labels, truth = [], [], {}
    for i in range(1500):
        words = rnd.choices(clean, k=rnd.randint(5, 80))
        bad = rnd.random() < 0.25
        if bad:
            for _ in range(rnd.randint(1, 4)):
                words.insert(rnd.randrange(len(words)), rnd.choice(["grumful", "Grumfula!", "zorvex", "zorvexen,", "idiot", "1d10t"]))
        rows.append((i, " ".join(words), "s"))
        truth[i] = bad
        labels.append((i, int(bad ^ (rnd.random() < 0.02))))
    out = toxicity.scored_documents(documents(rows), labels_of(spark, labels)).collect()
    wrong = [r for r in out if r.held_out and bool(r.predicted) != truth[r.doc_id]]
    assert len(wrong) <= 0.01 * sum(r.held_out for r in out)
    kept_ids = {r[0] for r in toxicity.accepted(documents(rows), labels_of(spark, labels)).collect()}
    assert kept_ids == {r.doc_id for r in out if not r.predicted}


def test_held_out_labels_are_not_used(spark, documents):
    rows = [(i, "zorvex text here" if i % 3 == 0 else "plain text here", "s") for i in range(300)]
    labels = [(i, int(i % 3 == 0)) for i in range(300)]
    flipped = [(i, 1 - y if held(i) else y) for i, y in labels]
    a, b = ({r.doc_id: r.score for r in toxicity.scored_documents(documents(rows), labels_of(spark, x)).collect()} for x in (labels, flipped))
    assert a == b


def test_address_before_any_occurrence_of_a_hit():
    """An earlier use of the word that is not addressed, or is part of another word, does not hide a later one."""
    voters = toxicity.Voters(["w:idiot"])
    address = len(voters.entries)
    filler = "plain words of some text " * 20
    fired = voters.votes([f"the idiot is a novel {filler} you complete idiot", f"idiotic idiot {filler} so you idiot", f"you see {filler} an idiot",
                          "youth of an idiot", "you idiotic man"])
    assert [address in ids for ids in fired] == [True, True, False, False, False]


def test_all_entries_that_pass_are_mined(spark):
    """450 words of label 1 only, in sixty rows each."""
    rows = [(i, " ".join(f"zz{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(450) if i % 2 and (k + i) % 40 < 20) or "plain", "s")
            for i in range(240)]
    known = spark.createDataFrame([(i, t, i % 2) for i, t, _ in rows], "doc_id long, text string, toxic int")
    words = {w for _, t, _ in rows for w in t.split()} - {"plain"}
    assert len(words) == 450 and {f"w:{w}" for w in words} <= set(toxicity._mined(known, 120, 240))


def test_given_table(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = toxicity.scored_documents(docs, labels)
    clean = out.join(labels.filter("toxic = 0"), "doc_id").filter("predicted = 1").count()
    assert out.count() == docs.count() and clean == 0
    toxic = out.join(labels.filter("toxic = 1"), "doc_id").filter("held_out")
    assert toxic.filter("predicted = 1").count() >= 0.9 * toxic.count()


def of(table):
    return toxicity.Votes.of([np.flatnonzero(row) for row in table], table.shape[1])


def test_label_model_corrects_labels():
    """One label in five is flipped: the voters know better."""
    rnd = np.random.default_rng(5)
    y = rnd.random(4000) < 0.3
    votes = of(np.column_stack([np.where(rnd.random(4000) < 0.8, y, rnd.random(4000) < 0.1) for _ in range(8)]))
    given = np.where(rnd.random(4000) < 0.8, y, ~y)
    p = toxicity.label_model(votes, given)
    assert ((p > 0.5) == y).mean() > 0.95 > (given == y).mean() + 0.1


def test_correlations_are_those_of_all_pairs():
    """Blocks of voters and parts of their rows add up to the whole table's correlations."""
    rnd = np.random.default_rng(6)
    table = rnd.random((300, 40)) < 0.2
    table[:, 7], p = table[:, 3], rnd.random(300)
    votes = of(table)
    for weight in (p, 1 - p):
        assert np.allclose(votes.together(np.arange(5, 20), weight, 1000), (table.T * weight @ table)[5:20])
    assert np.allclose(toxicity._shares(votes, p, 100), toxicity._shares(votes, p))
    assert toxicity._shares(votes, p)[7] < 0.55


def test_linear_fit_is_the_minimum():
    rnd = np.random.default_rng(7)
    table, p = rnd.random((400, 30)) < 0.3, rnd.random(400)
    w = toxicity.linear_fit(of(table), p)
    x = np.column_stack([table, np.ones(400)])
    ridge = np.append(np.full(30, 0.5), 1e-3)
    assert np.abs(x.T @ (1 / (1 + np.exp(-x @ w)) - p) + ridge * w).max() < 1e-4


def test_twenty_thousand_voters():
    """The driver's algebra keeps to the votes: no table of rows by voters, none of voters by voters."""
    rnd = np.random.default_rng(8)
    y = rnd.random(20_000) < 0.2
    votes = toxicity.Votes.of([np.unique(np.append(rnd.integers(0, 20_000, 20), rnd.integers(0, 200, 5) if t else [])).astype(int) for t in y], 20_000)
    tracemalloc.start()
    p = toxicity.label_model(votes, y, rounds=2)
    w = toxicity.linear_fit(votes, p)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400e6 and ((votes.per_row(w[:-1]) + w[-1] > 0) == y).mean() > 0.95


def test_label_model_shares_the_weight_of_copies():
    """A wrong voter that votes ten times over does not outvote two right ones."""
    rnd = np.random.default_rng(0)
    y = rnd.random(2000) < 0.3
    right = [np.where(rnd.random(2000) < 0.9, y, rnd.random(2000) < 0.05) for _ in range(3)]
    noise = rnd.random(2000) < 0.3
    votes = of(np.column_stack(right + [noise] * 10))
    p = toxicity.label_model(votes, np.where(rnd.random(2000) < 0.9, y, ~y))
    assert ((p > 0.5) == y).mean() > 0.95
