"""Union-find over the edges of a partition, held to a bounded number of rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Edges that one union-find holds in memory; more are worked off in several forests.
BOUND = 1_000_000


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node of each node's component, for edges a-b among nodes 0..n-1."""
    up = list(range(n))
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        while up[x] != x:
            up[x] = x = up[up[x]]
        while up[y] != y:
            up[y] = y = up[up[y]]
        if x < y:
            up[y] = x
        elif y < x:
            up[x] = y
    out = np.array(up, dtype=np.int64)
    while (out[out] != out).any():
        out = out[out]
    return out


def forest(edges: pa.Table) -> pa.Table:
    """Star forest (node, root) of the edges (a, b); a root's own row is kept, as it shows that it is one."""
    both = pa.chunked_array(edges.column(0).chunks + edges.column(1).chunks, pa.string()).combine_chunks()
    if isinstance(both, pa.ChunkedArray):
        both = pa.concat_arrays(both.chunks) if both.num_chunks else pa.array([], pa.string())
    coded = both.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    codes = rank[coded.indices.to_numpy()]
    half = len(codes) // 2
    names = coded.dictionary.take(pa.array(order))
    return pa.table({"node": names, "root": names.take(pa.array(roots(codes[:half], codes[half:], len(order))))})


def forests(batches: Iterator[pa.RecordBatch], bound: int = BOUND) -> Iterator[pa.RecordBatch]:
    """Forests of a partition's edges (a, b). Full buffers shrink to their forest before more edges are read."""
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]).rename_columns(["node", "root"]))
        rows += batch.num_rows
        if rows >= bound:
            kept = forest(pa.concat_tables(held))
            if kept.num_rows > bound // 2:  # no room for more edges
                yield from kept.to_batches()
                held, rows = [], 0
            else:
                held, rows = [kept], kept.num_rows
    if rows:
        yield from forest(pa.concat_tables(held)).to_batches()
