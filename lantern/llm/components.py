"""Connected components of a table of links, by alternating large-star and small-star steps.

Each task first replaces the links it has by stars, so few of them are left where a task has many of a component's. Each
step makes one pass of joins on a node and writes the links to the shared folder, so lineage stays short and no link or
component comes to the driver: it sees a count and a checksum. Nodes are longs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lantern.llm.common import forget, written


def _toward_least(pairs: DataFrame) -> DataFrame:
    """(u, v, m): each pair with the least neighbour of u, or u if that is less."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u").withColumn("m", F.least("u", "m"))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").bitwiseAND(F.lit((1 << 31) - 1)))).first())


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v): for each node of the task's links but the least of its component there, that one."""
    links = [np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()]) for b in batches if len(b)]
    if not links:
        return
    ends = np.concatenate(links, axis=1)
    nodes, of = np.unique(ends, return_inverse=True)
    root = list(range(len(nodes)))  # nodes ascend, and a root is the least of its tree

    def top(v: int) -> int:
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    for a, b in zip(*of.reshape(2, -1).tolist(), strict=True):
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    least = np.array([top(v) for v in range(len(nodes))])
    own = np.flatnonzero(least != np.arange(len(nodes)))
    for lo in range(0, len(own), 1 << 16):
        part = own[lo : lo + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(nodes[part]), pa.array(nodes[least[part]])], ["u", "v"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """id, component (least id that links reach) of every node in a link; loops and nulls are ignored."""
    pairs = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).filter("a <> b")
    links = written(pairs.mapInArrow(_stars, "u long, v long").distinct(), "links")
    state = _state(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _toward_least(large)
        small = small.select(F.inline(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))).filter("u <> v").distinct()
        last, links = links, written(small, "links")
        forget(last)
        before, state = state, _state(links)
        if state == before:
            break
    roots = links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def forest(hit: np.ndarray, rows: np.ndarray, others: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Links that join components not yet joined, as many as it takes; label is the component of each vector so far.

    In each round every row and every column names one link out of its component, so few rounds join all.
    """
    out = []
    while True:
        left = hit & (label[rows][:, None] != label[others])
        i, j = np.flatnonzero(left.any(axis=1)), np.flatnonzero(left.any(axis=0))
        if not len(i):
            return out
        a = np.concatenate([rows[i], rows[left[:, j].argmax(axis=0)]])
        b = np.concatenate([others[left[i].argmax(axis=1)], others[j]])
        parent = np.arange(len(label)).tolist()

        def root(v: int) -> int:
            while parent[v] != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            return v

        for u, v, c, d in zip(a.tolist(), b.tolist(), label[a].tolist(), label[b].tolist(), strict=True):
            c, d = root(c), root(d)
            if c != d:
                parent[max(c, d)] = min(c, d)
                out.append((u, v))
        label[:] = np.array([root(v) for v in range(len(parent))])[label]
