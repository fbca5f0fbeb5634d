import hashlib
import random

import pytest

from meterlake.llm import suffixes as S


def brute(rows, threshold):
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    key = lambda i: S.LAST if i is None else i
    for i, b in data:
        for p in range(len(b) - threshold + 1):
            s = b[p : p + threshold]
            first[s] = min(first.get(s, S.LAST), key(i))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - threshold + 1):
            if first[b[p : p + threshold]] < key(i):
                gone[p : p + threshold] = b"\1" * threshold
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


def run(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


@pytest.mark.parametrize("threshold,flush", [(50, 1 << 20), (50, 300), (20, 500)])
def test_equals_brute_force(docs, prose, monkeypatch, threshold, flush):
    """Copies, passages of exactly the threshold and one less, periodic texts, umlauts, negative and null ids, small flushes and busy ranks."""
    monkeypatch.setattr(S, "FLUSH", flush)
    monkeypatch.setattr(S, "BUSY", 3)
    monkeypatch.setattr(S, "BUCKET", 2000)
    monkeypatch.setattr(S, "SEGMENT", 700)
    rng = random.Random(threshold)
    exact, short = prose(5, 60)[:threshold], prose(6, 60)[: threshold - 1]
    texts = [None, "", "ab", "a" * (3 * threshold), "ab" * (2 * threshold), "é" * threshold, "xé" * threshold]
    for s in range(30):
        body = prose(100 + s, 60 + rng.randrange(300), 30)
        at = rng.randrange(len(body))
        texts.append(body[:at] + rng.choice([exact, short, exact + "!" + short, "é" * threshold]) + body[at:])
    texts += [texts[10], texts[10][5:-5], texts[11] + texts[12], texts[20], "a" * 500]
    rows = [(i - 5, t) for i, t in enumerate(texts)] + [(None, texts[9]), (2, texts[7])]
    rng.shuffle(rows)
    assert run(S.remove_repeats(docs(rows).repartition(3), threshold)) == brute(rows, threshold)


def test_repeated_rows_and_empty(docs, prose):
    assert S.remove_repeats(docs([])).collect() == []
    text = prose(1, 40)
    rows = [(1, text), (1, text), (2, text)]
    assert run(S.remove_repeats(docs(rows))) == brute(rows, 50)


def test_lengths_double_at_most():
    assert S.lengths(50) == [13, 25, 50]
    for n in range(16, 300):
        steps = [8, *S.lengths(n)]
        assert steps[-1] == n and all(a <= b <= 2 * a for a, b in zip(steps, steps[1:], strict=False))
