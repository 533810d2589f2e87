"""Task-side numpy kernels of the isolation forest.

Randomness comes from hashes of (seed, tree, node), not from an RNG stream,
so a tree depends only on its sample and the same tree can be grown by any
engine.  Rules:

* the feature of node i is ``hash(seed, "feature", tree, i) mod F``;
* its split is ``min + u * (max - min)`` with ``u = hash(seed, "split", tree, i) / 2^60``;
* rows with ``x < split`` go to child 2i, the others to 2i+1;
* a node is a leaf at the depth cap, with at most one row, when the chosen
  feature is constant in the node (no retry with another feature), or when
  the split leaves the left side empty (``split <= min``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd

from ctxanomaly.functions.expressions import c_factor_py, hash_int_py, hash_unit_py
from ctxanomaly.schema import PATH_UNIT


BLOCK_ROWS = 250  # rows descended at a time: their indices stay in the CPU cache


def leaf_units(depth: int, size: int) -> int:
    """Path length of a leaf (depth + c(size)) in integer units of 1e-9."""
    return int(round((depth + c_factor_py(size)) * PATH_UNIT))


def grow_tree(
    tree_id: int, x: np.ndarray, seed: int, max_depth: int
) -> list[tuple]:
    """Grow one tree over the rows of ``x`` (n x F); return node tuples
    ``(tree_id, node_id, depth, size, is_leaf, feature, split, path_units)``."""
    n_features = x.shape[1]
    nodes: list[tuple] = []
    level = [(1, np.arange(x.shape[0]))]
    for depth in range(max_depth + 1):
        nxt = []
        for node_id, idx in level:
            size = int(idx.size)
            leaf = depth >= max_depth or size <= 1
            if not leaf:
                feature = hash_int_py(seed, "feature", tree_id, node_id) % n_features
                values = x[idx, feature]
                lo, hi = float(values.min()), float(values.max())
                split = lo + hash_unit_py(seed, "split", tree_id, node_id) * (hi - lo)
                leaf = lo == hi or split <= lo
            if leaf:
                nodes.append(
                    (tree_id, node_id, depth, size, True, None, None, leaf_units(depth, size))
                )
                continue
            nodes.append((tree_id, node_id, depth, size, False, feature, split, None))
            go_right = values >= split
            nxt.append((2 * node_id, idx[~go_right]))
            nxt.append((2 * node_id + 1, idx[go_right]))
        level = nxt
        if not level:
            break
    return nodes


def grow_trees_pdf(
    pdf: pd.DataFrame, features: list[str], seed: int, max_depth: int
) -> pd.DataFrame:
    """``applyInPandas`` body: one group = one tree's sample (bounded by max_samples)."""
    tree_id = int(pdf["tree_id"].iloc[0])
    # The tree depends on the sample as a set: row order is irrelevant.
    x = pdf[list(features)].to_numpy(dtype=np.float64, na_value=0.0)
    rows = grow_tree(tree_id, x, seed, max_depth)
    out = pd.DataFrame(
        rows,
        columns=["tree_id", "node_id", "depth", "size", "is_leaf", "feature", "split", "path_units"],
    )
    return out.astype(
        {
            "tree_id": "int32",
            "node_id": "int64",
            "depth": "int32",
            "size": "int64",
            "is_leaf": "bool",
            "feature": "Int32",
            "split": "float64",
            "path_units": "Int64",
        }
    )


class ForestArrays:
    """Compact node arrays of a forest, for vectorised descent.

    Nodes are stored in (tree, heap id) order, one slot per node, so the
    size is bounded by trees x (2 max_samples - 1) whatever the depth.  The
    two children 2i and 2i+1 of a node are adjacent in that order: the
    right child sits right after the left one.  A leaf loops onto itself:
    its split is NaN (``x >= NaN`` is false) and its child is its own slot,
    so every row takes exactly max_depth steps without a leaf mask.
    """

    def __init__(self, nodes: pd.DataFrame, num_trees: int, max_depth: int):
        self.num_trees = num_trees
        self.max_depth = max_depth
        width = 1 << (max_depth + 1)  # heap ids of one tree are < width
        t = nodes["tree_id"].to_numpy(dtype=np.int64)
        i = nodes["node_id"].to_numpy(dtype=np.int64)
        keys = t * width + i
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        leaf = nodes["is_leaf"].to_numpy(dtype=bool)[order]
        inner = ~leaf
        size = len(keys)
        self.feature = np.zeros(size, dtype=np.intp)
        self.split = np.full(size, np.nan, dtype=np.float64)
        self.child = np.arange(size, dtype=np.intp)
        self.units = np.zeros(size, dtype=np.int64)
        self.feature[inner] = nodes["feature"].to_numpy()[order][inner].astype(np.intp)
        self.split[inner] = nodes["split"].to_numpy()[order][inner].astype(np.float64)
        left_keys = (keys[inner] // width) * width + 2 * (keys[inner] % width)
        self.child[inner] = np.searchsorted(keys, left_keys)
        self.units[leaf] = nodes["path_units"].to_numpy()[order][leaf].astype(np.int64)
        roots = np.searchsorted(keys, np.arange(num_trees, dtype=np.int64) * width + 1)
        self.roots = roots.astype(np.intp)

    def path_units(self, x: np.ndarray) -> np.ndarray:
        """Sum over trees of leaf path units for each row of ``x`` (n x F)."""
        blocks = [self._block_units(x[i : i + BLOCK_ROWS]) for i in range(0, len(x), BLOCK_ROWS)]
        return np.concatenate(blocks) if blocks else np.empty(0, np.int64)

    def _block_units(self, x: np.ndarray) -> np.ndarray:
        n = len(x)
        xs = np.ascontiguousarray(x.T, dtype=np.float64).ravel()  # feature by feature
        column, row = self.feature * n, np.arange(n, dtype=np.intp)
        at = np.empty((self.num_trees, n), dtype=np.intp)
        idx = np.repeat(self.roots[:, None], n, axis=1)
        values, splits = np.empty(at.shape), np.empty(at.shape)
        go = np.empty(at.shape, dtype=bool)
        for _ in range(self.max_depth):
            np.take(column, idx, out=at, mode="clip")
            at += row
            np.take(xs, at, out=values, mode="clip")
            np.take(self.split, idx, out=splits, mode="clip")
            np.greater_equal(values, splits, out=go)
            np.take(self.child, idx, out=at, mode="clip")
            np.add(at, go, out=idx)
        return np.take(self.units, idx, mode="clip").sum(axis=0)
