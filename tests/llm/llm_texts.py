"""Invented sentences."""

from __future__ import annotations

import random

WORDS = [a + b for a in ("ba", "ke", "li", "mo", "nu", "pra", "sto", "tri") for b in ("dan", "fel", "gor", "his", "jum", "kat", "len", "mir")]


def sentence(source: random.Random, n: int) -> str:
    return " ".join(source.choice(WORDS) for _ in range(n))
