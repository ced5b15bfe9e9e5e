"""Verification of substring dedup: pairs that need not be looked at, or only once."""

import numpy as np

from rastrum.llm import substring_dedup


def test_pairs_of_one_pattern_are_looked_at_once(monkeypatch):
    rng, looked, true_runs = np.random.default_rng(4), [], substring_dedup.band_runs
    monkeypatch.setattr(substring_dedup, "_PATTERNS", {}, raising=False)
    monkeypatch.setattr(substring_dedup, "band_runs", lambda *a: looked.append(1) or true_runs(*a))
    shared = np.arange(60)
    for base in rng.integers(1 << 20, 1 << 30, 20).tolist():
        x, y = (np.r_[shared + base, np.arange(40) + base + far].astype(np.uint32) for far in (100, 200))
        assert [f[:4] for f in substring_dedup._found_in(x, y, 0, 0, 46, 0.8)] == [(0, 60, 0, 60)]
    assert len(looked) == 1


def test_pairs_without_a_full_band_are_passed_over():
    rng, kept = np.random.default_rng(5), 0
    for _ in range(150):
        xs, ys, d = [], [], rng.integers(-60, 90, 8)
        for _ in range(8):
            xs.append(rng.integers(0, rng.choice([60, 1 << 30]), rng.integers(0, 200)).astype(np.uint32))
            ys.append(np.r_[rng.integers(0, 1 << 30, rng.integers(0, 90)), xs[-1][rng.random(len(xs[-1])) > rng.choice([0, 0.15, 0.4])]].astype(np.uint32))
        ok = substring_dedup.in_bands(xs, ys, d, d + 64, 46, 0.8)
        for x, y, low, may in zip(xs, ys, d.tolist(), ok.tolist()):
            hit = [v in y[max(0, low + i) : max(0, low + i + 65)] for i, v in enumerate(x)]
            assert may == (len(y) >= 37 and any(sum(hit[i : i + 46]) >= 30 for i in range(len(x) - 45)))
            assert may or not substring_dedup.band_runs(x, y, low, low + 64, 46, 0.8)
        kept += int(ok.sum())
    assert 50 < kept < 1000


def test_pairs_that_differ_too_often_are_passed_over():
    rng, refused, found = np.random.default_rng(7), 0, 0
    for _ in range(400):
        x = rng.integers(0, 1 << 30, rng.integers(46, 260)).astype(np.uint32)
        out, i, rate = rng.integers(0, 1 << 30, rng.integers(0, 60)).tolist(), 0, rng.choice([0.0, 0.02, 0.05, 0.1])
        while i < len(x):
            if rng.random() < rate:
                out += rng.integers(0, 1 << 30, rng.integers(1, 6)).tolist()
                i += int(rng.integers(0, 6))
            else:
                out.append(int(x[i]))
                i += 1
        y, d = np.array(out, np.uint32), int(rng.integers(0, 60)) if rng.random() < 0.7 else None
        _, first, at = np.unique(np.concatenate([x, y]), return_index=True, return_inverse=True)
        may, passages = substring_dedup.may_hold(first[at], len(x), 46, 0.8), list(substring_dedup._passages_of(x, y, d, d, 46, 0.8))
        assert may or not passages
        refused, found = refused + (not may), found + bool(passages)
    assert refused > 20 and found > 200
