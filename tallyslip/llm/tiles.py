"""What the near-duplicate operators share: rows meet in sorted runs, and a run gives a tree of bounded fan-out over what its
links join, never all pairs."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

FAN_OUT = 32


def tree(n: int, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[int, int]]:
    """Members of what the pairs connect, each with its parent in a tree of fan-out FAN_OUT."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(i.tolist(), j.tolist()):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    members: dict[int, list[int]] = {}
    for x in {*i.tolist(), *j.tolist()}:
        members.setdefault(root(x), []).append(x)
    for found in members.values():
        yield from ((found[(k - 1) // FAN_OUT], found[k]) for k in range(1, len(found)))


def thinned(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of every linked index to the smallest one that the pairs connect it with: fewer pairs, the same components."""
    label = np.arange(n)
    while len(i):
        before = label.copy()
        least = np.minimum(label[i], label[j])
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(n))
    return label[moved], moved


def whole_runs(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of rows sorted by their first column, so that no run of equal values is split between two."""
    held: list[pa.RecordBatch] = []
    for batch in stream:
        if not batch.num_rows:
            continue
        run = batch.column(0).to_numpy()
        edge = np.flatnonzero(run[1:] != run[:-1]) + 1
        if held and held[-1].column(0)[0].as_py() != run[0]:
            yield _joined(held)
            held = []
        if not len(edge):
            held.append(batch)
            continue
        yield _joined([*held, batch.slice(0, edge[-1])])
        held = [batch.slice(edge[-1])]
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
