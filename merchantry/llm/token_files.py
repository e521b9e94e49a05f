"""Token ids in compressed binary files: patched frame-of-reference blocks with an index."""

from __future__ import annotations

import base64
import gc
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchantry.llm.rows import kept, pick
from merchantry.llm.tokens import Cache, byte_words, release
from merchantry.sources.store import scratch_path

MODEL = "byte_bpe_50k.json"
# the same vocabulary
RANKS = "byte_bpe_50k.tiktoken"
END = 0
BLOCK = 128
PERCENT = 90
# a file is closed at this many ids; a longer document has a file of its own
FILE_IDS = 1 << 18
# ids whose bits are spread out at a time, whole blocks
SLICE = BLOCK << 10
_LINE = re.compile(r" ?\S+")
# a space and signs of the Latin blocks, also over line ends: what follows in a text is another word to both libraries
_LATIN = re.compile(r" [!-~¡-ɏ]+(?:\n+[!-~¡-ɏ]+)*")
# a text of such signs, in words and gaps of a usual length, is one and the same to both libraries
_PLAIN = re.compile(r"[ \n]{0,16}(?:[!-~¡-ɏ]{1,256}[ \n]{1,16})*+[!-~¡-ɏ]{0,256}")
MAGIC = b"PFORIDS1"
HEAD = struct.Struct("<8sIQI")
BLOCK_HEAD = struct.Struct("<IBB")


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that whole numbers below 2^32 need."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def pack(lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """A file of documents: how many ids each has, and all ids in a row.

    Head, document lengths, block starts, blocks. A block holds 128 ids: its minimum, a bit width, the
    differences from the minimum in that width, then the places and whole differences of those that the
    width, that of the 90th percentile, can't hold.
    """
    n = -(-len(ids) // BLOCK)
    if not n:
        return HEAD.pack(MAGIC, len(lengths), 0, 0) + lengths.astype("<u8").tobytes() + np.zeros(1, "<u8").tobytes()
    parts: list[bytes] = []
    for k in range(0, len(ids), SLICE):
        parts += _packed(ids[k : k + SLICE])
    starts = np.cumsum([0, *map(len, parts)]).astype("<u8")
    return b"".join([HEAD.pack(MAGIC, len(lengths), len(ids), n), lengths.astype("<u8").tobytes(), starts.tobytes(), *parts])


def _packed(ids: np.ndarray) -> list[bytes]:
    """The blocks of some ids; a short last block is filled up with its last id."""
    n = -(-len(ids) // BLOCK)
    blocks = np.concatenate([ids, np.full(n * BLOCK - len(ids), ids[-1])]).astype(np.uint32).reshape(n, BLOCK)
    least = blocks.min(axis=1)
    above = blocks - least[:, None]
    width = _widths(np.sort(above, axis=1)[:, BLOCK * PERCENT // 100 - 1])
    large = _widths(above) > width[:, None]
    packed: list[bytes] = [b""] * n
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        bits = (above[rows][:, :, None] >> np.arange(w, dtype=np.uint32)) & 1
        for row, data in zip(rows, np.packbits(bits.astype(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")):
            packed[row] = data.tobytes()
    count, parts = large.sum(axis=1), []
    rows, places = np.nonzero(large)
    places, outliers, first = places.astype(np.uint8), above[rows, places].astype("<u4"), np.cumsum(count) - count
    for k in range(n):
        a, b = first[k], first[k] + count[k]
        parts.append(BLOCK_HEAD.pack(least[k], width[k], count[k]) + packed[k] + places[a:b].tobytes() + outliers[a:b].tobytes())
    return parts


def _unpacked(data: np.ndarray, width: int) -> np.ndarray:
    """The values of blocks, a row of bytes each: up to 25 bits lie in four bytes that follow each other."""
    if width > 25:
        bits = np.unpackbits(data, axis=1, bitorder="little").reshape(len(data), BLOCK, width)
        return bits @ (np.uint32(1) << np.arange(width, dtype=np.uint32))
    at = np.arange(BLOCK) * width
    wide = np.pad(data, ((0, 0), (0, 4)))
    four = np.zeros((len(data), BLOCK), np.uint32)
    for k in range(4):
        four |= wide[:, (at >> 3) + k].astype(np.uint32) << np.uint32(8 * k)
    return four >> (at & 7).astype(np.uint32) & np.uint32((1 << width) - 1)


class Reader:
    """A file's document lengths, and any range of its ids through the index."""

    def __init__(self, data: bytes):
        magic, documents, self.n, blocks = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        self.data, at = data, HEAD.size
        self.lengths = np.frombuffer(data, "<u8", documents, at).astype(np.int64)
        at += 8 * documents
        self.starts = np.frombuffer(data, "<u8", blocks + 1, at).astype(np.int64)
        self.blocks_at = at + 8 * (blocks + 1)

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids from ``start`` up to ``stop``; only the blocks that hold them are read."""
        stop = self.n if stop is None else stop
        if stop <= start:
            return np.empty(0, np.uint32)
        if stop - start > SLICE:
            return np.concatenate([self.ids(a, min(stop, a + SLICE)) for a in range(start, stop, SLICE)])
        first, last = start // BLOCK, (stop - 1) // BLOCK
        at = self.starts[first : last + 1] + self.blocks_at
        heads = [BLOCK_HEAD.unpack_from(self.data, a) for a in at]
        raw = np.frombuffer(self.data, np.uint8)
        out = np.empty((len(at), BLOCK), np.uint32)
        widths = np.array([w for _, w, _ in heads])
        for w in np.unique(widths):
            rows, size = np.flatnonzero(widths == w), BLOCK * int(w) // 8
            data = raw[(at[rows] + BLOCK_HEAD.size)[:, None] + np.arange(size)]
            out[rows] = _unpacked(data, int(w))
        for k, (least, w, count) in enumerate(heads):
            if count:
                places = at[k] + BLOCK_HEAD.size + BLOCK * w // 8
                out[k, raw[places : places + count]] = np.frombuffer(self.data, "<u4", count, places + count)
            out[k] += np.uint32(least)
        return out.reshape(-1)[start - first * BLOCK : stop - first * BLOCK]


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    return found, [t.content for t in found.get_added_tokens_decoder().values()]


class RankedWords:
    """Words of Latin signs under the same vocabulary as a file of ranks, many in one call."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        self.sizes[list(ranks.values())] = [len(token) for token in ranks]

    def encode(self, words: list[str]) -> list[bytes]:
        """The ids of each word; tokens never reach over the space that a word starts with, so their bytes add up to the words'."""
        text = "".join(words)
        ids = np.asarray(self.encoding.encode_ordinary(text), "<u4")
        # words end where the next one's space is
        spaces = np.flatnonzero(np.frombuffer(text.encode(), np.uint8) == 32)
        ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.append(spaces[1:], len(text.encode()))) + 1
        data, cuts = ids.tobytes(), (4 * ends).tolist()
        return [data[a:b] for a, b in zip([0, *cuts], cuts)]


@lru_cache(maxsize=1)
def _ranked(path: str) -> RankedWords:
    return RankedWords(path)


@lru_cache(maxsize=1)
def _word_cache(path: str, ranks: str | None) -> Cache:
    tokenizer, _ = _tokenizer(path)

    end = tokenizer.encode("\n", add_special_tokens=False).ids

    def fill(words: list[str]) -> list[bytes]:
        """Latin words by ranks, others without further white space as the lines of a text: the tokenizer never joins a line end to a word."""
        out: dict[str, bytes] = {}
        rest = [w for w in words if not _LATIN.fullmatch(w)] if ranks else words
        lines = [w for w in rest if _LINE.fullmatch(w)]
        for k in range(0, len(lines), 256):
            some = lines[k : k + 256]
            ids = np.array(tokenizer.encode_batch_fast(["\n".join(some)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(ids == end[0]).tolist()
            data = ids.tobytes()
            out.update((w, data[4 * a : 4 * b]) for w, a, b in zip(some, [0, *(c + 1 for c in cuts)], [*cuts, len(ids)]))
        others = [w for w in rest if w not in out]
        found = tokenizer.encode_batch_fast(others, add_special_tokens=False)
        out.update((w, np.array(f.ids, "<u4").tobytes()) for w, f in zip(others, found))
        latin = [w for w in words if w not in out]
        ranked = iter(_ranked(ranks).encode(latin) if latin else ())
        return [out[w] if w in out else next(ranked) for w in words]

    return Cache(fill)


def encoded(texts: list[str], path: str, ranks: str | None = None) -> list[np.ndarray]:
    """The ids of each text as the tokenizers library gives them, without special tokens added.

    Words are encoded once per task as long as the cache holds them. A text that spells a special token is encoded whole.
    ``ranks`` may name a file of the same vocabulary as ranks: texts in Latin signs are encoded by it, whole and several times
    as fast, and so are the Latin words of other texts.
    """
    tokenizer, special = _tokenizer(path)
    out: list = [None] * len(texts)
    cut: dict[int, list[str]] = {}
    for i, text in enumerate(texts):
        if any(s in text for s in special):
            out[i] = tokenizer.encode(text, add_special_tokens=False).ids
        elif ranks and _PLAIN.fullmatch(text):
            out[i] = _ranked(ranks).encoding.encode_ordinary(text)
        else:
            cut[i] = byte_words(text)
    for i, parts in zip(cut, _word_cache(path, ranks).of(list(cut.values()))):
        out[i] = np.frombuffer(b"".join(parts), "<u4")
    return [np.asarray(ids, np.uint32) for ids in out]


FILES = "part int, file int, before long, n_ids long, documents binary, data binary"


def write_ids(df: DataFrame, path: str, folder: str, id_column: str = "doc_id", text: str = "text", end: int = END,
              ranks: str | None = None) -> None:
    """Encode every text (null: empty), append the id ``end``, and write the ids to ``folder`` in ascending id order.

    ``folder`` is a Parquet table with a file's bytes per row, so that any store that Spark writes to
    will do and a repeated task replaces its own files only. Beside the bytes are the file's place, the
    ids before it in its part, and its documents' ids. Null ids come first, equal ids in the order of a hash of their
    texts. Ranges are split on both, so that no id is too frequent. A task holds one file.
    """
    order = ["doc_id", "mark"]
    source = pick(df, id_column, text).toDF("doc_id", "text").withColumn("mark", F.xxhash64("text"))
    source = source.withColumn("doc_id", F.col("doc_id").cast("long"))
    ranged = source.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, file, before = TaskContext.get().partitionId(), 0, 0
        keys: list = []
        held: list[np.ndarray] = []
        size = 0

        def closed() -> pa.RecordBatch:
            documents = pa.RecordBatch.from_arrays([pa.array(keys, pa.int64())], ["doc_id"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, documents.schema) as stream:
                stream.write_batch(documents)
            ids = np.concatenate(held) if held else np.empty(0, np.uint32)
            row = [part, file, before, size, sink.getvalue().to_pybytes(), pack(np.array([len(h) for h in held]), ids)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                              ["part", "file", "before", "n_ids", "documents", "data"])

        gc.disable()  # the cache holds hundreds of thousands of objects, none of them in cycles
        try:
            for batch in batches:
                all_keys = batch.column(0).to_pylist()
                for at in range(0, len(all_keys), 256):
                    texts = ["" if t is None else t for t in batch.column(1).slice(at, 256).to_pylist()]
                    for key, ids in zip(all_keys[at : at + 256], encoded(texts, path, ranks)):
                        if held and size + len(ids) + 1 > FILE_IDS:
                            yield closed()
                            file, before, keys, held, size = file + 1, before + size, [], [], 0
                        keys.append(key)
                        held.append(np.append(ids, np.uint32(end)))
                        size += len(ids) + 1
            if held:
                yield closed()
        finally:
            gc.enable()
            release()

    ranged.mapInArrow(run, FILES).write.parquet(folder)


def read_ids(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``, ``ids``."""
    files = spark.read.schema(FILES).parquet(folder)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition that wrote
    offsets = kept(parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")), "id-offsets")
    placed = files.join(offsets, "part").select((F.col("offset") + F.col("before")).alias("start"), "documents", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, documents, data in zip(*[c.to_pylist() for c in batch.columns]):
                reader = Reader(data)
                stops = np.cumsum(reader.lengths)
                starts = stops - reader.lengths
                whole = reader.ids()
                each = [whole[a:b] for a, b in zip(starts, stops)]
                keys = pa.ipc.open_stream(documents).read_all().column("doc_id").combine_chunks()
                columns = [keys, pa.array(starts + start), pa.array(reader.lengths),
                           pa.array([zlib.crc32(np.ascontiguousarray(e, "<u4")) for e in each], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if ids:
                    columns.append(pa.array([e.astype(np.int32) for e in each], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids
    return placed.mapInArrow(run, schema)


def stored_documents(df: DataFrame) -> DataFrame:
    """Every document written to files and read back from them."""
    folder = scratch_path(df.sparkSession, "token-ids")
    write_ids(df, public_tokenizers.path(MODEL), folder, ranks=public_tokenizers.path(RANKS))
    return read_ids(df.sparkSession, folder, ids=False)
