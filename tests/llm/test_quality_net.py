"""The network of the quality classifier against a plain forward pass over all
places of the whole text, and its gradient against differences."""

import numpy as np
import pytest

from bookshift.llm import quality as q

SPAN, STEP = q.BLOCK * q.CHUNK, q.BLOCK * (q.CHUNK - 1)


def net(rng):
    return q.Net(rng.normal(0, 1, (q.WIDTH, 256, q.FILTERS)), rng.normal(0, 1, q.FILTERS), rng.normal(0, 0.1, 2 * q.FILTERS), 0.3)


def plain_score(model, text):
    """Chunk by chunk, place by place, filter by filter."""
    pooled, start = [], 0
    while True:
        best = np.full(q.FILTERS, -np.inf)
        for at in range(start, start + SPAN):
            seen = [text[at + k] if at + k < len(text) else q.PAD for k in range(q.WIDTH)]
            best = np.maximum(best, sum(model.tables[k][b] for k, b in enumerate(seen)))
        pooled.append(np.maximum(best + model.bias, 0))
        start += STEP
        if start >= len(text) - q.BLOCK:
            break
    z = np.concatenate([np.mean(pooled, axis=0), np.max(pooled, axis=0)]) @ model.out + model.shift
    return 1 / (1 + np.exp(-z))


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 448, 511, 512, 513, 516, 960, 961, 3000])
def test_score_is_the_plain_forward_pass(size, monkeypatch):
    monkeypatch.setattr(q, "SEGMENT", 2 * STEP)  # several segments within a short text
    rng = np.random.default_rng(size)
    model, text = net(rng), rng.integers(0, 256, size, dtype=np.uint8).tobytes()
    assert model.score(text) == pytest.approx(plain_score(model, text), abs=1e-9)


@pytest.mark.parametrize("size", [0, 1, 64, 65, 512, 513, 961, 5000])
def test_chunks_cover_the_whole_text(size):
    text = np.random.default_rng(1).integers(1, 256, size, dtype=np.uint8).tobytes()
    rows = q.chunks_of(text)
    for k, row in enumerate(rows):
        assert bytes(row) == text[k * STEP:k * STEP + SPAN + q.WIDTH - 1].ljust(SPAN + q.WIDTH - 1, bytes([q.PAD]))
    assert (len(rows) - 1) * STEP + SPAN >= size


def test_fitting_pools_like_scoring(monkeypatch):
    monkeypatch.setattr(q, "SLICE", 3)
    rng = np.random.default_rng(3)
    p = {"emb": rng.normal(0, 0.5, (256, q.EMBED)), "w": rng.normal(0, 0.3, (q.WIDTH, q.EMBED, q.FILTERS)),
         "b": rng.normal(0, 1, q.FILTERS), "out": rng.normal(0, 0.3, 2 * q.FILTERS), "c": np.array([0.2])}
    model = q.Net(np.einsum("be,kef->kbf", p["emb"], p["w"]), p["b"], p["out"], 0.2)
    said = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in (10, 700, 4000)]
    bags = [q.chunks_of(t) for t in said]
    labels = np.array([1.0, 0.0, 1.0])
    own = np.repeat(np.arange(3), [len(b) for b in bags])
    data = np.concatenate(bags)
    loss, g = q.loss_and_gradient(p, data, own, labels)
    scores = np.array([model.score(t) for t in said])
    assert loss == pytest.approx(-np.mean(labels * np.log(scores) + (1 - labels) * np.log(1 - scores)), abs=1e-9)
    used = np.unique(data)
    for key, at in [("c", (0,)), *(("out", (i,)) for i in range(0, 2 * q.FILTERS, 5)), *(("b", (i,)) for i in range(0, q.FILTERS, 3)),
                    *(("w", (k, 1, 2)) for k in range(q.WIDTH)), *(("emb", (int(b), 3)) for b in used[::40])]:
        step = 1e-6
        moved = []
        for sign in (1, -1):
            there = {k: x.copy() for k, x in p.items()}
            there[key][at] += sign * step
            moved.append(q.loss_and_gradient(there, data, own, labels)[0])
        assert g[key][at] == pytest.approx((moved[0] - moved[1]) / (2 * step), abs=1e-6)


def test_evidence_anywhere_in_a_long_text_is_learnt():
    """The mark of a good text stands once, anywhere in thousands of bytes."""
    rng = np.random.default_rng(4)
    noise = lambda n: rng.integers(97, 110, n, dtype=np.uint8).tobytes()
    said, labels = [], []
    for k in range(240):
        text = noise(int(rng.integers(3000, 9000)))
        at = int(rng.integers(0, len(text) - 20))
        said.append(text[:at] + b"zyxwv" * 2 + text[at:] if k % 2 else text)
        labels.append(float(k % 2))
    model = q.fit([q.chunks_of(t) for t in said[:200]], np.array(labels[:200]), epochs=20)
    right = [(model.score(t) > 0.5) == (y == 1) for t, y in zip(said[200:], labels[200:])]
    assert np.mean(right) > 0.9
