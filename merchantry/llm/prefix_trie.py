"""The prefix tree of rebuilt conversations, from whole sequences that are collapsed first."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchantry.functions.numbering import id_by_order, running_total
from merchantry.llm.rows import WORD, kept, pick
from merchantry.llm.streams import joined_hashes, mark

# conversations that begin alike, and the most turns that one takes over from the first of them
FAMILY = 20
HEADS = 4
# turns whose hashes are chained in one row; a longer conversation has several rows
PART_BITS = 10
SALTS = 512
ROOT = b""
EMPTY = hashlib.sha256(b"").hexdigest()


def turns(df: DataFrame) -> DataFrame:
    """(conv_id, pos, mark, words): every turn's place from 0, 256 bits of role and text, and the words of its text.

    The texts stay where they are. Turns with equal numbers are in the order of their marks. Places come from one order over all
    turns, so that a conversation of any length is spread over tasks.
    """
    raw = pick(df, "conv_id", "turn", "role", "text").filter("conv_id IS NOT NULL")
    slim = raw.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).select("conv_id", "turn", F.expr(mark("role", "text")).alias("mark"), F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("words"))
    placed = id_by_order(slim, ["conv_id", "turn", "mark"], "at", 0)
    starts = placed.groupBy("conv_id").agg(F.min("at").alias("start"))
    return placed.join(starts, "conv_id").select("conv_id", (F.col("at") - F.col("start")).alias("pos"), "mark", "words")


def rebuilt(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt turns (conv_id, pos, mark, words) and per conversation its length (conv_id, depth).

    A conversation takes its first turns, up to three, from the first of its family of ``FAMILY`` ids and goes on with its own.
    """
    own = placed.groupBy("conv_id").agg(F.count("*").alias("n"))
    own = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    own = own.withColumn("h", F.when(F.col("base") == F.col("conv_id"), 0).otherwise(F.crc32(F.col("conv_id").cast("string")) % HEADS))
    first = own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plans = own.join(first, "base", "left").withColumn("lead", F.least("h", F.coalesce("base_n", F.lit(0))))
    plans = kept(plans.select("conv_id", "base", "h", "lead", (F.col("lead") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("depth")), "trie-plans")
    heads = placed.filter(F.col("pos") < HEADS - 1).select(F.col("conv_id").alias("base"), "pos", "mark", "words")
    taken = plans.filter("lead > 0").join(heads, "base").filter("pos < lead").select("conv_id", "pos", "mark", "words")
    rest = placed.join(plans, "conv_id").filter("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("lead")).alias("pos"), "mark", "words")
    return taken.unionByName(rest), plans.select("conv_id", "depth")


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each row the hash of its marks up to each place."""
    for batch in batches:
        out = []
        for marks in batch.column("marks").to_pylist():
            last, chain = b"", []
            for m in marks:
                last = hashlib.sha256(last + m).digest()
                chain.append(last)
            out.append(chain)
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), batch.column("words"), pa.array(out, pa.list_(pa.binary()))],
                                         ["conv_id", "part", "words", "chain"])


def _stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each part behind the first the node that it starts from; ``lasts`` are the chains' ends of the parts before it."""
    for batch in batches:
        rows = []
        for conv, lasts in zip(batch.column("conv_id").to_pylist(), batch.column("lasts").to_pylist()):
            node = ROOT
            for part, last in enumerate(lasts, 1):
                node = hashlib.sha256(node + last).digest()
                rows.append((conv, part, node))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*rows) if rows else ([], [], []), (pa.int64(), pa.int64(), pa.binary()))], ["conv_id", "part", "start"])


def prefixes(rows: DataFrame, part_bits: int = PART_BITS) -> DataFrame:
    """(conv_id, depth, node, parent, words): 256 bits for each prefix of each conversation, equal for equal prefixes only.

    Turns are chained in parts; the ends of the parts of a long conversation, 32 bytes for each 1024 turns, are chained
    after that.
    """
    listed = rows.groupBy("conv_id", F.shiftright("pos", part_bits).alias("part")).agg(F.sort_array(F.collect_list(F.struct("pos", "mark", "words"))).alias("t"))
    listed = listed.select("conv_id", "part", F.col("t.mark").alias("marks"), F.col("t.words").alias("words"))
    parts = kept(listed.mapInArrow(_chained, "conv_id long, part long, words array<long>, chain array<binary>"), "trie-parts")
    full = parts.filter(F.size("chain") == 1 << part_bits).select("conv_id", F.struct("part", F.element_at("chain", -1).alias("last")).alias("p"))
    lasts = full.groupBy("conv_id").agg(F.sort_array(F.collect_list("p"))["last"].alias("lasts"))
    starts = kept(lasts.mapInArrow(_stitched, "conv_id long, part long, start binary"), "trie-starts")
    whole = parts.join(starts, ["conv_id", "part"], "left").withColumn("start", F.coalesce("start", F.lit(ROOT)))
    whole = whole.withColumn("nodes", F.expr("transform(chain, c -> unhex(sha2(concat(start, c), 256)))"))
    whole = whole.withColumn("parents", F.expr("concat(array(start), slice(nodes, 1, size(nodes) - 1))"))
    each = whole.select("conv_id", "part", F.posexplode(F.arrays_zip("nodes", "parents", "words")).alias("at", "z"))
    depth = F.shiftleft("part", part_bits) + F.col("at") + 1
    return each.select("conv_id", depth.alias("depth"), F.col("z.nodes").alias("node"), F.col("z.parents").alias("parent"), F.col("z.words").alias("words"))


def sequences(ends: DataFrame) -> DataFrame:
    """(node, depth, first, weight): identical conversations as one sequence; ``first`` is their smallest id."""
    return ends.groupBy("node", "depth").agg(F.min("conv_id").alias("first"), F.count("*").alias("weight"))


def paths(found: DataFrame, whole: DataFrame) -> DataFrame:
    """(first, weight, leaf, depth, node, parent, words): the prefixes of the distinct sequences, from the root on.

    A sequence is a leaf if it is a proper prefix of no other, which an anti join tells.
    """
    named = whole.select("first", "weight", F.col("depth").alias("whole"))
    own = found.join(named, F.col("conv_id") == F.col("first")).drop("conv_id")
    roots = named.select(F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"),
                         F.lit(0).cast("long").alias("words"), "first", "weight", "whole")
    own = kept(own.unionByName(roots), "trie-sequence-prefixes")
    proper = own.filter("depth < whole").select("node").distinct()
    leaves = kept(whole.join(proper, "node", "left_anti").select("first", F.lit(True).alias("leaf")), "trie-leaves")
    return own.join(leaves, "first", "left").withColumn("leaf", F.coalesce("leaf", F.lit(False))).drop("whole")


def nodes(ways: DataFrame) -> DataFrame:
    """Per node the members, leaves and tokens that its subtree saves, from weighted prefixes.

    Each node is counted on one leaf's path, that of its smallest leaf ``rep``, where such nodes are the lower end. What a subtree
    saves is then all that the paths through its top save, less what lies above the top on its own path: running
    totals over all nodes instead of sums along each path.
    """
    ways = kept(ways, "trie-paths")
    grouped = ways.groupBy("node", "depth", "parent", "words").agg(
        F.min("first").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum(F.col("leaf").cast("long")).alias("n_leaves"),
        F.min(F.when(F.col("leaf"), F.col("first"))).alias("rep"))
    grouped = kept(grouped, "trie-nodes")
    own = (F.col("n_convs") - 1) * F.col("words")
    numbered = id_by_order(grouped, ["rep", "depth"], "at", 0)
    summed = kept(running_total(numbered, "at", own, "before"), "trie-sums")
    ranges = summed.groupBy("rep").agg(F.min("before").alias("low"), F.max(F.col("before") + own).alias("high"))
    ranges = kept(ranges, "trie-ranges")
    saved = ways.filter("leaf").join(ranges, F.col("first") == F.col("rep")).groupBy("node").agg(F.sum(F.col("high") - F.col("low")).alias("through"))
    return summed.join(ranges.select("rep", "low"), "rep").join(saved, "node").select(
        "node", "parent", "conv_id", "depth", "n_convs", "n_leaves", (F.col("through") + F.col("low") - F.col("before")).alias("saved_tokens"))


def with_parents(tree: DataFrame) -> DataFrame:
    """Adds ``parent_conv_id`` and ``n_children``; the children of one node are looked up in 512 parts."""
    tree = kept(tree, "trie-tree").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    parts = kept(tree.filter("parent IS NOT NULL").groupBy("parent", "salt").agg(F.count("*").alias("n")), "trie-children")
    counts = parts.groupBy(F.col("parent").alias("node")).agg(F.sum("n").alias("n_children"))
    above = tree.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    known = parts.join(above, "parent").select("parent", "salt", "parent_conv_id")
    return tree.join(known, ["parent", "salt"], "left").join(counts, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))


def trie(df: DataFrame, part_bits: int = PART_BITS) -> DataFrame:
    """The tree's nodes for the rows (conv_id, turn, role, text) of ``df``; ``node`` and ``parent`` are their hashes.

    Null roles and texts are empty; a null turn comes first; turns with equal numbers, also repeated rows, all count, in the
    order of a hash of role and text. Rows without a conv_id belong to no conversation; remainders of negative ids are negative. A conversation may
    have no turns left when it is rebuilt: it ends at the root. An empty table gives no node, not even a root.
    """
    built, lengths = rebuilt(kept(turns(df), "trie-turns"))
    found = kept(prefixes(built, part_bits), "trie-prefixes")
    ends = found.join(lengths, ["conv_id", "depth"]).select("conv_id", "depth", "node")
    ends = kept(ends.unionByName(lengths.filter("depth = 0").select("conv_id", "depth", F.lit(ROOT).alias("node"))), "trie-ends")
    whole = kept(sequences(ends), "trie-sequences")
    tree = with_parents(nodes(paths(found, whole)))
    lists = joined_hashes(ends, "node", "conv_id", "ends_sha256")
    return tree.join(lists, "node", "left").select(
        "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


def conversation_trie(df: DataFrame) -> DataFrame:
    """One row per node: see ``trie``."""
    return trie(df).drop("node", "parent")


TRIE_SQL = r"""
WITH marked AS (
  SELECT conv_id, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words, turn
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(mark ORDER BY turn NULLS FIRST, mark) AS t, list(words ORDER BY turn NULLS FIRST, mark) AS w,
    xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(ch)::BIGINT for ch in string_split(CAST(conv_id AS VARCHAR), '')]),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))),
      4294967295) % 4 AS h
  FROM marked GROUP BY conv_id
), built AS (
  SELECT a.conv_id, list_concat(coalesce(list_slice(b.t, 1, a.h), []), list_slice(a.t, a.h + 1, len(a.t))) AS t,
    list_concat(coalesce(list_slice(b.w, 1, a.h), []), list_slice(a.w, a.h + 1, len(a.w))) AS w
  FROM own a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20
), prefixes AS (
  SELECT conv_id, d, list_slice(t, 1, d) AS p, coalesce(w[d], 0) AS words, d = len(t) AS ends FROM (SELECT *, unnest(range(len(t) + 1)) AS d FROM built)
), nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS own,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY p, d
), children AS (
  SELECT list_slice(p, 1, d - 1) AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), sums AS (
  SELECT list_slice(p, 1, k) AS p, CAST(sum(own) AS BIGINT) AS saved, count(*) FILTER (n IS NULL) AS leaves
  FROM (SELECT nodes.*, n, unnest(range(d + 1)) AS k FROM nodes LEFT JOIN children USING (p)) GROUP BY ALL
)
SELECT nodes.conv_id, nodes.d AS depth, above.conv_id AS parent_conv_id, nodes.n_convs, coalesce(n, 0) AS n_children, leaves AS n_leaves,
  saved AS saved_tokens, nodes.ends_sha256
FROM nodes JOIN sums USING (p) LEFT JOIN children USING (p) LEFT JOIN nodes AS above ON nodes.d > 0 AND above.p = list_slice(nodes.p, 1, nodes.d - 1)
"""
