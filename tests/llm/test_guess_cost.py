"""The guess cost against an exhaustive minimum over all cuts, and whole
quoted values."""

import functools
import math
import random

import pytest

from bookshift.llm import secrets


def piece_cost(v):
    """Cheapest way to guess a text as one piece."""
    low = v.lower()
    plain = low.translate(secrets.LEET)
    brute = lambda c: math.log10(10 if c.isdigit() else 26 if c.isalpha() else 33)
    costs = [brute(v)] if len(v) == 1 else []
    if len(v) > 1 and plain in secrets.WORDS:
        costs.append(secrets.WORDS[plain] + 0.3 * (v != low) + 0.3 * (low != plain))
    if secrets.DATE.fullmatch(v):
        costs.append(math.log10(366 * 120))
    if 3 <= len(v) <= secrets.LONGEST_RUN:
        steps = {ord(b) - ord(a) for a, b in zip(low, low[1:])}
        if steps == {0}:
            costs.append(brute(v[0]) + math.log10(len(v)))
        if steps in ({1}, {-1}):
            costs.append(math.log10(52) + math.log10(len(v)))
        at = [secrets.KEYS.get(c) for c in low]
        if all(at) and all(p != q and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1 for p, q in zip(at, at[1:])):
            moves = [(q[0] - p[0], q[1] - p[1]) for p, q in zip(at, at[1:])]
            costs.append(math.log10(47) + 0.6 * (1 + sum(a != b for a, b in zip(moves, moves[1:]))) + math.log10(len(v)))
    return min(costs, default=math.inf)


def least(value):
    @functools.lru_cache(None)
    def rest(i):
        return 0.0 if i == len(value) else min(piece_cost(value[i:j]) + rest(j) for j in range(i + 1, len(value) + 1))
    return rest(0)


def test_cost_is_the_minimum_over_all_cuts():
    rng = random.Random(6)
    bits = ["pass", "p4ss", "Admin", "test", "aaa", "zz", "1999", "12-31", "2024/1/5", "qwe", "trewq", "asdf", "789", "cba", "!", "x", "9",
            "é", "İ", "$", "19991231", "111", "the"]
    values = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 5))) for _ in range(400)]
    values += ["".join(rng.choice("ab12-") for _ in range(rng.randint(1, 12))) for _ in range(200)]
    for v in [*values, "passsssssssecrettttttttest", "aaaaaaadminnnnnnaaaaaadminnnn", "1111111111999-12-31", ""]:
        assert secrets.guess_cost(v) == pytest.approx(least(v)), v


def test_guessable_values_are_no_secrets():
    for v in (b"passsssssssecrettttttttest", b"aaaaaaadminnnnnnaaaaaadminnnn", b"1111111111999-12-31"):
        assert secrets.find(b"pwd: " + v) == []
    assert secrets.guess_cost("a" * 5000 + "qwerty" * 3000, 40.0) == 40.0


def test_quoted_values_are_whole():
    spans = lambda t: [(k, t[a:z]) for k, a, z, *_ in secrets.find(t)]
    assert spans(b"""password = "my p4$x, Zq!9 long" end""") == [("guess", b"my p4$x, Zq!9 long")]
    assert spans(b"pwd='Tr,v0x#92kQzz'") == [("guess", b"Tr,v0x#92kQzz")]
    assert spans(b'{"pin": "k\\"9,x;Q2<vL8z"}') == [("guess", b'k\\"9,x;Q2<vL8z')]
    assert spans(b'pwd: "Tr!v0x#92kQ and no end') == [("guess", b"Tr!v0x#92kQ")]
    assert spans(b"pwd: Tr!v0x#92kQ, then") == [("guess", b"Tr!v0x#92kQ")]
    assert spans(b'pwd: "changeme test" x') == []
