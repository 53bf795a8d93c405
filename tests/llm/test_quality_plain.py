"""The quality classifier against plain follow-the-regularised-leader steps and dot products."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from shiftledger.llm import quality

MASK, MULT = (1 << 64) - 1, 0x9E3779B97F4A7C15 | 1


def mixed(h):
    h ^= h >> 33
    h = h * 0xFF51AFD7ED558CCD & MASK
    h ^= h >> 33
    h = h * 0xC4CEB9FE1A85EC53 & MASK
    return h ^ h >> 33


def hashed(raw):
    return mixed(sum((b + 1) * pow(MULT, i, 1 << 64) for i, b in enumerate(raw)) & MASK)


def shape(raw):
    out = []
    for b in raw:
        c = 48 if 48 <= b <= 57 else 65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else b
        if not out or out[-1] != c:
            out.append(c)
    return bytes(out)


def plain_features(text):
    words = (text or "").encode().split()
    w, s = [hashed(x) for x in words], [hashed(shape(x)) for x in words]
    found = [mixed(x ^ 1) for x in w] + [mixed(x ^ 2) for x in s]
    found += [0 if a == b else mixed((a * 3 + b + 3) & MASK) for a, b in zip(w, w[1:])]
    found += [mixed((a * 3 + b + 4) & MASK) for a, b in zip(s, s[1:])]
    places = Counter(x >> (64 - quality.BITS) for x in found)
    return {p: quality.SCALE * n / len(words) for p, n in places.items()}


def plain_weights(rows, alpha=0.3, beta=1.0, l1=0.005, l2=0.05):
    z, n = Counter(), Counter()

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(quality.EPOCHS):
        for text, y in rows:
            x = {p: float(np.float32(v)) for p, v in plain_features(text).items()} | {"bias": 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - y) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z}


def plain_score(weights, text):
    dot = sum(weights.get(p, 0.0) * v for p, v in plain_features(text).items())
    return 1 / (1 + math.exp(-(weights.get("bias", 0.0) + dot)))


@pytest.mark.parametrize("seed", [1, 2])
def test_scores_are_the_plain_ones(spark, seed):
    r = random.Random(seed)
    good = [f"word{i}" for i in range(30)] + ["Fine", "text.", "été"]
    bad = ["BUY", "now!!!", "$$$", "100%", "click", "click", "a-b-c"]
    texts = {i: " ".join(r.choices(good if i % 2 else good[:8] + bad, k=r.randint(1, 25))) for i in range(60)} | {60: "", 61: None, 62: " \n"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(55)], "doc_id long, quality int")
    known = [i for i in range(55) if zlib.crc32(str(i).encode()) % 3 != 1]
    known.sort(key=lambda i: (zlib.crc32(str(i).encode()), i))
    weights = plain_weights([(texts[i], i % 2) for i in known])
    got = {x.doc_id: x for x in quality.score(docs, quality.train(docs, labels, parts=1)).collect()}
    assert len(got) == len(texts)
    for i, text in texts.items():
        assert got[i].score == pytest.approx(plain_score(weights, text), abs=1e-6)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert got[i].predicted == (got[i].score >= 0.5)
