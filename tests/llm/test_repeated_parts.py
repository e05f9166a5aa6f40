"""Which parts of an anchor's contexts repeat, and what is sorted for it."""

import random

import numpy as np

from stategrid.llm import suffix_dedup
from stategrid.llm.suffix_dedup import GRAM, repeated_parts

LENGTH = 200


def _contexts(rng: random.Random, n: int) -> list[tuple[bytes, int, int]]:
    """(context, left, weight), all different, of a few anchors and sides."""
    part = lambda k: bytes(rng.choices(b"ab\0\xc3", k=k))
    grams, befores, afters = ([part(k) for _ in range(m)] for k, m in ((GRAM, 2), (120, 3), (120, 3)))
    out = {}
    for _ in range(n):
        a, z = rng.randrange(121), rng.randrange(121)
        before = part(120 - a) + rng.choice(befores)[120 - a:]
        after = rng.choice(afters)[:z] + part(120 - z)
        left, right = rng.choice([120, 120, rng.randrange(121)]), rng.choice([120, 120, rng.randrange(121)])
        context = before[120 - left:] + rng.choice(grams) + after[:right]
        out[context, left] = rng.choice([1, 1, 1, 2])
    return [(c, left, w) for (c, left), w in out.items()]


def _brute(rows):
    seen = {}
    for c, left, w in rows:
        for i in range(len(c) - LENGTH + 1):
            key = i - left, c[i:i + LENGTH]
            seen[key] = seen.get(key, 0) + w
    out = []
    for k, (c, left, _) in enumerate(rows):
        hit = [i - left for i in range(len(c) - LENGTH + 1) if seen[i - left, c[i:i + LENGTH]] > 1]
        out += [(k, hit[0], hit[-1] + LENGTH)] if hit else []
    return out


def _run(rows):
    found = repeated_parts([c for c, _, _ in rows], np.array([a for _, a, _ in rows], np.int64),
                           np.array([w for _, _, w in rows], np.int64), LENGTH)
    return [tuple(x) for x in np.stack(found, axis=1).tolist()]


def test_parts_brute_force():
    rng = random.Random(3)
    for n in (1, 2, 3, 10, 60):
        for _ in range(20):
            rows = _contexts(rng, n)
            assert _run(rows) == _brute(rows)


def test_only_what_may_repeat_is_sorted(monkeypatch):
    """Of contexts that agree in 210 of 320 bytes no more is sorted, and once; of others nothing."""
    rng = random.Random(4)
    size, sort = [], suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda s, k: size.append(len(s)) or sort(s, k))
    part = lambda k: bytes(rng.choices(b"abcdefgh", k=k))
    gram, side = part(GRAM), part(70)
    alone = [(part(120) + gram + part(120), 120, 1) for _ in range(50)]
    assert _run(alone) == [] and sum(size) == 0
    alike = [(bytes([65 + i]) * 60 + side[:60] + gram + side + bytes([65 + i]) * 50, 120, 1) for i in range(20)]
    assert _run(alike + alone) == [(i, -60, 150) for i in range(20)]
    assert sum(size) < 2 * 215
    several = [(c[:i] + bytes([66 + i]) + c[i + 1:], a, w) for i, (c, a, w) in enumerate(alike * 2)]
    assert _run(several) == _brute(several)
