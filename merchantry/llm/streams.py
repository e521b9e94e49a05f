"""Rows of a group one behind the other, in tasks that hold one batch."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# values that are joined before their group meets in one task
PACKED = 4096


def mark(*parts: str):
    """A column expression's SQL: 256 bits of the strings, whose lengths keep them apart."""
    return "unhex(sha2(concat(" + ", ".join(f"cast(octet_length({p}) as string), ':', {p}" for p in parts) + "), 256))"


def joined_hashes(rows: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """(group, name): the hex SHA-256 of each group's whole numbers, ascending and joined by commas.

    Ranges over group and value join neighbours first, so what meets in one task of a large group are few long
    pieces; there they go through the hash one by one.
    """
    kind = rows.schema[group].dataType.simpleString()
    ranged = rows.select(group, value).repartitionByRange(group, value).sortWithinPartitions(group, value)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, values = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            cuts = [k for k in range(len(keys)) if k == 0 or keys[k] != keys[k - 1] or k % PACKED == 0] + [len(keys)]
            pieces = [",".join(map(str, values[a:b])) for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(cuts[:-1], pa.int64())), batch.column(1).take(pa.array(cuts[:-1], pa.int64())), pa.array(pieces, pa.string())],
                [group, value, "piece"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list = []
        for batch in batches:
            done = []
            for key, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if state and state[0] == key:
                    state[1].update(b"," + piece.encode())
                else:
                    done += [state] if state else []
                    state = [key, hashlib.sha256(piece.encode())]
            yield result(done, batch.schema.field(0).type)
            last = batch.schema.field(0).type
        if state:
            yield result([state], last)

    def result(done: list, key_type: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in done], key_type), pa.array([h.hexdigest() for _, h in done], pa.string())], [group, name])

    pieces = ranged.mapInArrow(packed, f"{group} {kind}, {value} bigint, piece string")
    return pieces.repartition(group).sortWithinPartitions(group, value).mapInArrow(hashed, f"{group} {kind}, {name} string")
