"""Invented prose for the tests of this folder."""

import random


def prose(seed: int, n: int, words: int = 400) -> str:
    r = random.Random(seed)
    vocabulary = ["".join(random.Random(i).choices("abcdefghilmnoprstu", k=2 + i % 6)) for i in range(words)]
    return " ".join(r.choice(vocabulary) for _ in range(n))
