"""Comparing the rows of a group pair by pair in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups up to this size are compared by shifting a whole batch against itself.
SMALL = 128


def deal_blocks(rows: DataFrame, keys: Sequence[str], member: str, block: int) -> DataFrame:
    """Add ``_low``, ``_high``: the pairs of blocks a row takes part in. ``rows`` is a written table.

    A key with more than ``block`` rows is cut into blocks by a hash of ``member``, and every block
    meets every other and itself, so any two rows of a key meet exactly once (twice within a block
    never). Only keys that need cutting are in the joined table of counts.
    """
    wide = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > block).select(
        *keys, F.ceil(F.col("_n") / block).cast("int").alias("_blocks"))
    found = rows.join(wide, list(keys), "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    own = found.withColumn("_own", F.pmod(F.xxhash64(member), F.col("_blocks")).cast("int"))
    other = own.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return other.select(*rows.columns, F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high"), "_own")


def together(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows of a group next to each other in one task."""
    return rows.repartition(*group).sortWithinPartitions(*group)


def columns(batch: pa.RecordBatch, names: Sequence[str]) -> list[np.ndarray]:
    """Numpy columns; fixed-length lists and binaries become rows of a matrix."""
    out = []
    for n in names:
        c = batch.column(n)
        if pa.types.is_list(c.type):
            out.append(c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1) if len(c) else np.zeros((0, 0)))
        elif pa.types.is_binary(c.type):
            out.append(np.frombuffer(b"".join(c.to_pylist()), "<u2").reshape(len(c), -1))
        else:
            out.append(c.to_numpy(zero_copy_only=False))
    return out


def new_group(keys: list[np.ndarray]) -> np.ndarray:
    """True where a row begins a group of equal keys."""
    new = np.ones(len(keys[0]), bool)
    if len(new) > 1:
        new[1:] = np.any([x[1:] != x[:-1] for x in keys], axis=0)
    return new


def whole_groups(batches: Iterator[pa.RecordBatch], names: Sequence[str], n_keys: int) -> Iterator[list[np.ndarray]]:
    """Columns of sorted batches, cut so that no group of the first ``n_keys`` columns is parted."""
    kept: list[np.ndarray] | None = None
    for b in batches:
        if not b.num_rows:
            continue
        part = columns(b, names)
        kept = part if kept is None else [np.concatenate(x) for x in zip(kept, part, strict=True)]
        edge = np.flatnonzero(new_group(kept[:n_keys]))[-1]
        if edge:  # the last group may go on in the next batch
            yield [x[:edge] for x in kept]
            kept = [x[edge:] for x in kept]
    if kept is not None:
        yield kept


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the graph of links ``a``-``b`` that is not the smallest of its component, with that smallest one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while len(u):
        low = np.minimum(root[u], root[v])
        np.minimum.at(root, root[u], low)
        np.minimum.at(root, root[v], low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[u] != root[v]
        u, v = u[apart], v[apart]
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]
