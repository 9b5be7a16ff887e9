"""Connected groups of what one task holds, in numpy."""

from __future__ import annotations

import numpy as np


def spanning_forest(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes that share keys, directly or through others, as groups.

    Gives the smallest node of its group for every (key, node) row, and one
    edge (smallest node, node) for every other node: as many edges as nodes at
    most, however many nodes share a key.
    """
    if not len(key):
        return np.empty(0, np.int64), np.empty((0, 2), np.int64)
    names, place = np.unique(node, return_inverse=True)
    by_key = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.diff(key[by_key], prepend=~key[by_key][:1]))
    member = place[by_key]
    size = np.diff(np.append(first, len(key)))
    # Keys with one member connect nothing.
    several = np.repeat(size > 1, size)
    member, size = member[several], size[size > 1]
    first = np.cumsum(size) - size
    label = np.arange(len(names))
    while len(member):
        least = np.minimum.reduceat(label[member], first)
        before = label.copy()
        near = np.repeat(least, size)
        # Both the members and the nodes they point to take the smallest label of a shared key.
        np.minimum.at(label, before[member], near)
        np.minimum.at(label, member, near)
        label = label[label]
        if (label == before).all():
            break
    while (label != label[label]).any():
        label = label[label]
    others = np.flatnonzero(label != np.arange(len(names)))
    return names[label][place], np.stack([names[label[others]], names[others]], axis=1).astype(np.int64)
