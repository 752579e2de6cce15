"""Very long texts in pieces, and the grade model against finite differences."""

import tracemalloc

import numpy as np
import pytest

from corpuskit.llm import language, quality, simhash

WORDS = "Über the river, la noche 12 x"


def text_of(size, seed=1):
    draw = np.random.default_rng(seed)
    words = np.array(WORDS.split() + [f"w{n}" for n in range(300)])
    out = " ".join(words[draw.integers(0, len(words), size // 4)])
    return out[:size]


def test_code_lengths_do_not_depend_on_pieces(monkeypatch):
    texts = [text_of(3000, n).encode() for n in range(4)]
    trees = language.grow(texts, [0, 0, 1, 1], ["a", "b"])
    for data in (texts[0] * 3, b"xyz", b"", bytes(range(1, 200))):
        want = trees.code_lengths([data, b"other"])
        for size in (1, 7, 1000):
            monkeypatch.setattr(language, "LONG_TEXT", size)
            assert trees.code_lengths([data, b"other"]) == pytest.approx(want)
        monkeypatch.undo()


def test_grades_do_not_depend_on_pieces(monkeypatch):
    texts = [text_of(n, n) for n in (1, 40, 900, 5000)] + ["", None, "aa aa aa b b", "no end " * 50]
    model = quality.fit(texts, [0, 1, 2, 2, 0, 0, 1, 1], steps=15)
    rows = quality.design(texts)
    want = model.tails(texts)
    for size in (8, 100):
        monkeypatch.setattr(quality, "LONG_TEXT", size)
        assert model.tails(texts) == pytest.approx(want, abs=1e-6)
        table = [dict(((int(r), int(b)), float(v)) for r, b, v in zip(*x[:3])) for x in (rows, quality.design(texts))]
        assert table[0].keys() == table[1].keys() and all(v == pytest.approx(table[1][k], rel=1e-5) for k, v in table[0].items())
        assert quality.design(texts)[3] == pytest.approx(rows[3])


def test_slopes_against_finite_differences():
    texts = [text_of(200 + 20 * n, n) for n in range(20)]
    grade = np.array([n % 3 for n in range(20)])
    data = quality.design(texts)
    draw = np.random.default_rng(0)
    params = [draw.normal(size=quality.SIZE) * 0.3, np.array([-0.4]), np.array([0.2])]
    _, slopes = quality.likelihood(params, data, grade, 1e-3)
    for which, places in ((0, [*np.unique(data[1])[:20], quality.SIZE - 1, quality.SIZE - 4, 3]), (1, [0]), (2, [0])):
        for at in places:
            ends = []
            for step in (1e-5, -1e-5):
                moved = [p.copy() for p in params]
                moved[which][at] += step
                ends.append(quality.likelihood(moved, data, grade, 1e-3)[0])
            assert slopes[which][at] == pytest.approx((ends[0] - ends[1]) / 2e-5, rel=1e-4, abs=1e-9)


def test_fit_reaches_the_best_likelihood():
    """On rows that share four numbers only, against plain gradient ascent with halving steps."""
    texts = [" ".join(["a"] * n + ["b"] * (n % 5)) for n in range(1, 21)]
    grade = [min(2, n // 7) for n in range(20)]
    model = quality.fit(texts, grade, steps=400)
    data, grades = quality.design(texts), np.array(grade)
    gaps = np.log(np.diff(model.thresholds))
    reached, _ = quality.likelihood([model.weights.astype(float), model.thresholds[:1], gaps], data, grades, 2e-4)
    params = [np.zeros(quality.SIZE), np.array([0.0]), np.array([0.0])]
    best, slopes = quality.likelihood(params, data, grades, 2e-4)
    step = 1.0
    for _ in range(1500):
        moved = [p + step * g for p, g in zip(params, slopes)]
        value, new = quality.likelihood(moved, data, grades, 2e-4)
        if value > best:
            params, best, slopes, step = moved, value, new, step * 1.2
        else:
            step /= 2
    assert reached >= best - 0.02


def peak_beside(work, *args):
    tracemalloc.start()
    work(*args)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 1e6


def test_memory_beside_a_long_text():
    text = text_of(8_000_000)
    raw = text.encode()
    trees = language.grow([raw[:3000]] * 2 + [b"other words"] * 2, [0, 0, 1, 1], ["a", "b"])
    model = quality.fit(["good text", "bad"], [1, 0], steps=2)
    assert peak_beside(trees.code_lengths, [raw]) < 200
    assert peak_beside(model.tails, [text]) < 200
    assert peak_beside(simhash.fingerprint, text) < 200
