"""Likeness against its definition written out code point by code point, without hashes of the engine."""

import random
import time

from convmill.llm import fingerprints as fp

PRIME, BASE = 2**31 - 1, 1_046_527_193


def plain_ends(text):
    """0, then the first place at least 8 and at most 1,024 further where the polynomial of the last 8 code points is 0 modulo 32."""
    places = [e for e in range(8, len(text) + 1) if sum((ord(text[e - 8 + k]) + 1) * pow(BASE, k, PRIME) for k in range(8)) % PRIME % 32 == 0] + [len(text)]
    out = [0]
    while out[-1] < len(text):
        after = next((p for p in places if p >= out[-1] + 8), len(text))
        out.append(min(after, out[-1] + 1024))
    return out


def plain_likeness(x, y):
    if x == y:
        return 1.0
    if not x or not y:
        return 0.0
    head = 0
    while head < min(len(x), len(y)) and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    taken = [k < head or k >= len(y) - tail for k in range(len(y))]
    total, stop, now, shift = head + tail, len(x) - tail, head, 0
    ends_x, ends_y = plain_ends(x), plain_ends(y)
    spans_y = {j: y[j:e] for j, e in zip(ends_y, ends_y[1:])}
    for i, end in zip(ends_x, ends_x[1:]):
        if i < now or end > stop:
            continue
        free = [j for j, s in spans_y.items() if s == x[i:end] and not any(taken[j : j + len(s)])]
        if not free:
            continue
        j = i + shift if i + shift in free else min(free)
        left = 0
        while left < i - now and left < j and not taken[j - left - 1] and x[i - left - 1] == y[j - left - 1]:
            left += 1
        right = 0
        while i + right < stop and j + right < len(y) and not taken[j + right] and x[i + right] == y[j + right]:
            right += 1
        for k in range(j - left, j + right):
            taken[k] = True
        total, now, shift = total + left + right, i + right, j - i
    longer = max(len(x), len(y))
    return min(total, longer - 1) / longer


def test_likeness_equals_its_definition():
    rng = random.Random(7)
    words = ["alpha", "beta", "gamma", "the", "over", "ünd", "日本", "x"]
    for _ in range(120):
        x = " ".join(rng.choices(words, k=rng.randrange(0, 160)))
        y = list(x)
        for _ in range(rng.randrange(0, 6)):
            a, b, c = sorted(rng.randrange(0, len(y) + 1) for _ in range(3))
            y = y[:a] + y[b:c] + y[a:b] + rng.choices(list("abc é"), k=rng.randrange(0, 9)) + y[c:]
        y = "".join(y)
        assert fp.Fingerprint(x).likeness(fp.Fingerprint(y)) == plain_likeness(x, y)
        assert fp.Fingerprint(y).likeness(fp.Fingerprint(x)) == plain_likeness(y, x)


def test_the_place_that_goes_on_comes_first():
    rng = random.Random(2)
    a, b = ("".join(rng.choices("abcdefghij ", k=600)) for _ in range(2))
    # The passage of a stands twice in the other text, the second time followed by what follows it here, too.
    x, y = "1" + a + b + "2", "3" + a + "4" * 50 + a + b + "5"
    assert fp.Fingerprint(x).likeness(fp.Fingerprint(y)) == plain_likeness(x, y)


def test_likeness_of_many_short_passages_takes_time_in_proportion():
    rng = random.Random(4)
    passages = ["".join(rng.choices("abcdefghijklmnop ", k=90)) for _ in range(16_000)]
    took = []
    for n in (4_000, 16_000):
        x = "".join(p + str(k) for k, p in enumerate(passages[:n]))
        y = "".join(p + "#" * 7 for p in rng.sample(passages[:n], n))
        one, other = fp.Fingerprint(x), fp.Fingerprint(y)
        start = time.perf_counter()
        assert one.likeness(other) > 0.6
        took.append(time.perf_counter() - start)
    assert took[1] < 10 * took[0]
