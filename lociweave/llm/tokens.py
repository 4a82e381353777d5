"""Token counts of a byte-level BPE vocabulary by rank-synchronous merging of arrays.

Texts are split at special tokens and then into pre-tokens. Pre-tokens not met
before in a slice are held together as one flat array of symbol ids with
offsets; in every round each sequence merges all places of its lowest-ranked
pair at once, until no sequence has a pair left. The surviving symbols are
counted per sequence and the counts summed per text.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession

from lociweave.llm.common import map_texts, table, unpack

VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
#: Distinct pre-tokens whose counts a Python worker keeps; at this number it forgets them and goes on.
REMEMBERED = 400_000

NONE = np.int64(1) << 60


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes as: printable ones stand for themselves, the rest follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merger:
    """Merge table of one vocabulary file, as sorted pair keys."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left, right, made = (np.array([vocab[x] for x in xs], np.int64) for xs in ([a for a, _ in merges], [b for _, b in merges], [a + b for a, b in merges]))
        key = (left << 32) | right
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order.astype(np.int64), made[order]
        self.letters = np.zeros(256, np.int64)
        for letter, b in byte_letters().items():
            self.letters[b] = vocab[letter]
        self.split = regex.compile(pattern)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        self.known: dict[str, int] = {}

    def _ranks(self, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of the pair that starts at each symbol; NONE where it ends a sequence or isn't listed."""
        rank, made = np.full(len(symbols), NONE), np.zeros(len(symbols), np.int64)
        if len(symbols) > 1:
            key = (symbols[:-1] << 32) | symbols[1:]
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            ok = (self.key[at] == key) & ~first[1:]
            rank[:-1][ok], made[:-1][ok] = self.rank[at[ok]], self.made[at[ok]]
        return rank, made

    def count(self, pieces: list[bytes]) -> list[int]:
        """Symbols that survive in each non-empty piece."""
        out = np.zeros(len(pieces), np.int64)
        sizes = np.array([len(p) for p in pieces], np.int64)
        symbols = self.letters[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        while len(symbols):
            first = np.concatenate(([True], owner[1:] != owner[:-1]))
            rank, made = self._ranks(symbols, first)
            begin = np.flatnonzero(first)
            lowest = np.minimum.reduceat(rank, begin)
            size = np.diff(np.concatenate((begin, [len(symbols)])))
            done = lowest == NONE
            out[owner[begin[done]]] = size[done]
            hit = (rank == np.repeat(lowest, size)) & (rank != NONE)
            # Of overlapping places (a pair of equal symbols in a run) every second one counts, from the left.
            place = np.arange(len(hit))
            starts_run = hit & ~np.concatenate(([False], hit[:-1]))
            run = np.maximum.accumulate(np.where(starts_run, place, 0))
            hit &= (place - run) % 2 == 0
            symbols = np.where(hit, made, symbols)
            stay = ~np.concatenate(([False], hit[:-1])) & ~np.repeat(done, size)
            symbols, owner = symbols[stay], owner[stay]
        return out.tolist()

    def tokens(self, texts: list[str]) -> list[int]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        out, parts = [], []
        for t in texts:
            plain = self.special.split(t) if self.special else [t]
            parts.append([self.split.findall(p) for p in plain])
        new = list({w for ps in parts for words in ps for w in words} - self.known.keys())
        if new:
            self.known.update(zip(new, self.count([w.encode() for w in new])))
        counted = self.known.__getitem__
        for ps in parts:
            out.append(sum(sum(map(counted, words)) for words in ps) + len(ps) - 1)
        return out


_MERGERS: dict[str, Merger] = {}


def merger(vocabulary: str) -> Merger:
    """One per Python worker; ``vocabulary`` is a file of the installed public tokenizers or a path."""
    if vocabulary not in _MERGERS:
        import public_tokenizers

        _MERGERS[vocabulary] = Merger(public_tokenizers.path(vocabulary), public_tokenizers.PATTERN)
    return _MERGERS[vocabulary]


FIELDS = "n_bytes long, n_tokens long, over_limit boolean"


def token_counts(docs: DataFrame, keep: Sequence[str], text: str = "text", vocabulary: str = VOCABULARY, limit: int = TOKEN_LIMIT) -> DataFrame:
    """Columns ``row`` (struct of ``keep``) and ``res``: bytes, tokens, whether there are more than ``limit``.

    Special strings inside a text count as one token each, none are added. A
    null or empty text has no bytes and no tokens. Rows are counted one by
    one, so repeated rows agree.
    """

    def count(texts: list[bytes]) -> dict:
        n = merger(vocabulary).tokens([t.decode() for t in texts])
        return {"n_bytes": [len(t) for t in texts], "n_tokens": n, "over_limit": [x > limit for x in n]}

    return map_texts(docs, keep, text, FIELDS, count)


def op3_rank_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpack(token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"]))


QUERIES = {"op3_rank_merge": (op3_rank_merge, None)}
