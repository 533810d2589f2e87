import numpy as np
import pytest

from ctxanomaly.llm import anchors


@pytest.mark.parametrize("slice_rows", [1 << 22, 37])
def test_territories_are_the_windows_of_their_anchor(monkeypatch, slice_rows):
    monkeypatch.setattr(anchors, "_SLICE", slice_rows)
    rng = np.random.default_rng(1)
    for n, width, kinds in ((500, 9, 1 << 60), (300, 17, 3), (20, 20, 5), (5, 9, 5)):
        grams = rng.integers(0, kinds, n).astype(np.uint64) << np.uint64(30 if kinds < 10 else 0)
        at, first, last = anchors.territories(grams, width)
        got = {s: a for a, f, t in zip(at, first, last, strict=True) for s in range(f, t + 1)}
        rough = grams >> np.uint64(28)  # ties below the hash's upper bits go to the left
        assert got == {s: s + int(np.argmin(rough[s : s + width])) for s in range(n - width + 1)}


def test_gram_hashes_depend_on_the_run_only():
    rng = np.random.default_rng(2)
    units = rng.integers(0, 4, 3000).astype(np.uint8)
    for size in (1, 2, 5, 13, 64):
        h = anchors.gram_hashes(units, size, 0x9E3779B97F4A7C15)
        assert h.size == units.size - size + 1
        runs = {}
        for i, x in enumerate(h.tolist()):
            assert runs.setdefault(units[i : i + size].tobytes(), x) == x
        assert len(set(runs.values())) == len(runs)
    assert anchors.gram_hashes(units[:4], 5, 3).size == 0


def test_merged_spans():
    assert anchors.merge_spans([5, 0, 3, 9], [7, 2, 5, 9]) == [(0, 2), (3, 7), (9, 9)]
    assert anchors.merge_spans([], []) == []
