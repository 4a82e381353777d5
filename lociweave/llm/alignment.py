"""Alignment of two tokenizers by anchors at white space.

Each text is tokenised whole by both. Places where tokens of both end, and
both next tokens are marked with a space, are anchors; they cut a text into
windows of token ids on either side. A window is aligned once: what it gives
is kept under the pair of its id tuples, packed, and words seldom make new ones.

An alignment cuts the window wherever tokens of both end; the two tokens that
end there are a link. Of two linked tokens one's bytes end with the other's,
so the vocabularies alone bound the number of different links (some 600,000),
and their corpus counts fit into one array, whatever the corpus.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.llm.common import map_texts, table, unpack
from lociweave.llm.tokens import byte_letters
from lociweave.session import materialize

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
#: Distinct windows that a Python worker keeps; beyond this number it forgets them and goes on.
REMEMBERED = 200_000
#: Tokens of a window above which its alignment is made anew each time.
LONG_WINDOW = 64

SPACE = "▁"


class Ragged:
    """Rows of integers of different lengths, end to end."""

    def __init__(self, rows: list[np.ndarray]):
        self.flat, self.starts = np.concatenate(rows), np.concatenate(([0], np.cumsum([len(r) for r in rows])))


    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows end to end, and where each begins, the end of all included."""
        at, sizes = self.starts[rows], self.starts[rows + 1] - self.starts[rows]
        begins = np.concatenate(([0], np.cumsum(sizes)))
        return self.flat[np.repeat(at - begins[:-1], sizes) + np.arange(begins[-1])], begins


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Tokenizers:
    """A byte-level BPE and a sentence-piece BPE over whole texts."""

    def __init__(self, byte_bpe: str, pieces: str, pattern: str):
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding

        with open(byte_bpe, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters, vocab = byte_letters(), model["vocab"]
        made = [vocab[m.replace(" ", "") if isinstance(m, str) else "".join(m)] for m in model["merges"]]
        if made != sorted(made):
            raise ValueError("ids of this vocabulary are not in the order of its merges")
        ranks = {bytes(map(letters.__getitem__, token)): i for token, i in vocab.items()}
        # The vocabulary file in a faster library: ids serve as ranks, special strings are ordinary text.
        self.bpe = Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.pieces = SentencePieceProcessor(model_file=pieces)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]

    def texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Whether each text is what its tokens join to; ids of both sides and their ends per text, of those that are."""
        plain = [t.decode() for t in texts]
        a = [self.bpe.encode_ordinary(" " + t) for t in plain]
        b = self.pieces.encode(plain, num_threads=1)
        known = self.b_bytes.__getitem__
        # Side a only cuts the text into pieces, side b may change it.
        good = [b"".join(map(known, x)) == b" " + t for t, x in zip(texts, b)]
        flat = [[array("i", x) for x, g in zip(side, good) if g] for side in (a, b)]
        a, b = ((np.frombuffer(b"".join(x), np.int32), np.cumsum([len(y) for y in x], dtype=np.int64)) for x in flat)
        return np.array(good, bool), *a, *b


class Links:
    """All pairs of tokens of which one ends with the other, numbered by their place in a sorted array."""

    def __init__(self, a: list[bytes], b: list[bytes]):
        of_a, of_b = {}, {}
        for known, tokens in ((of_a, a), (of_b, b)):
            for i, t in enumerate(tokens):
                if t:
                    known.setdefault(t, []).append(i)
        found = [x << 32 | y for t, ids in of_a.items() for k in range(len(t)) for y in of_b.get(t[k:], ()) for x in ids]
        found += [x << 32 | y for t, ids in of_b.items() for k in range(1, len(t)) for x in of_a.get(t[k:], ()) for y in ids]
        self.keys = np.unique(np.array(found, np.int64))
        self.right = self.keys & 0xFFFFFFFF

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.keys, a.astype(np.int64) << 32 | b).astype(np.int32)


class Aligner:
    """Both tokenizers, and the windows aligned so far."""

    def __init__(self, byte_bpe: str, pieces: str):
        import public_tokenizers

        self.tokenizers = Tokenizers(public_tokenizers.path(byte_bpe), public_tokenizers.path(pieces), public_tokenizers.PATTERN)
        both = (self.tokenizers.a_bytes, self.tokenizers.b_bytes)
        self.sizes = [np.array([len(t) for t in tokens], np.int64) for tokens in both]
        self.spaced = [np.array([t.startswith(b" ") for t in tokens]) for tokens in both]
        self.links = Links(*both)
        # An id as it is written inside and at the end of a group's side.
        self.written = [b"%d%c" % (i, c) for tokens, marks in zip(both, (b",|", b",;")) for i in range(len(tokens)) for c in marks]
        self.known: dict[tuple[bytes, bytes], tuple[bytes, np.ndarray]] = {}

    def windows(self, keys: list[tuple[bytes, bytes]]) -> list[tuple[bytes, np.ndarray]]:
        """Groups as text and numbers of the links, of windows given as packed ids."""
        a, b = (np.frombuffer(b"".join(side), np.int32) for side in zip(*keys))
        ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        at_a, at_b = np.zeros(int(ends_a[-1]) + 1, bool), np.zeros(int(ends_a[-1]) + 1, bool)
        at_a[ends_a] = at_b[ends_b] = True
        last_a, last_b = at_b[ends_a], at_a[ends_b]
        numbers = self.links.numbers(a[last_a], b[last_b])
        # Tokens of a group stand together, side a first.
        through_a, through_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        place_a = np.arange(len(a)) + np.concatenate(([0], through_b[:-1]))[np.cumsum(last_a) - last_a]
        place_b = np.arange(len(b)) + through_a[np.cumsum(last_b) - last_b]
        code = np.empty(len(a) + len(b), np.int64)
        code[place_a], code[place_b] = 2 * a + last_a, 2 * (len(self.sizes[0]) + b) + last_b
        text = list(map(self.written.__getitem__, code.tolist()))
        upto_a = np.cumsum([len(x) // 4 for x, _ in keys])
        upto = [0, *(upto_a + np.cumsum([len(y) // 4 for _, y in keys])).tolist()]
        linked = [0, *np.cumsum(last_a)[upto_a - 1].tolist()]
        return [(b"".join(text[i:k])[:-1], numbers[m:n]) for i, k, m, n in zip(upto, upto[1:], linked, linked[1:])]

    def anchors(self, a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """Token places on either side of the anchors, first and last place included; ``ends`` are byte ends of texts."""
        marked = []
        for ids, size, spaced in zip((a, b), self.sizes, self.spaced):
            begins = np.cumsum(size[ids]) - size[ids]
            at = np.zeros(int(ends[-1]) + 1, bool)
            at[begins[spaced[ids]]] = True
            marked.append((begins, at))
        shared = marked[0][1] & marked[1][1]
        shared[ends] = True
        shared[0] = True
        return [np.append(np.flatnonzero(shared[begins]), len(begins)) for begins, _ in marked]

    def alike(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
        """For each window the place of one with the same ids: found by a hash, and compared."""
        key, sides = np.zeros(len(at_a) - 1, np.uint64), []
        for ids, at in ((a, at_a), (b, at_b)):
            size = np.diff(at)
            place = np.arange(len(ids)) - np.repeat(at[:-1], size)
            mixed = _mix(ids.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(32)))
            key = _mix(key + np.add.reduceat(mixed, at[:-1]))
            sides.append((ids, at, size, place))
        _, first, group = np.unique(key, return_index=True, return_inverse=True)
        like = first[group]
        same = np.ones(len(like), bool)
        for ids, at, size, place in sides:
            same &= size == size[like]
            there = np.minimum(np.repeat(at[like], size) + place, len(ids) - 1)
            same &= np.logical_and.reduceat(ids == ids[there], at[:-1])
        return np.where(same, like, np.arange(len(like)))

    def aligned(self, texts: list[bytes]) -> dict:
        out = {"n_a": [0] * len(texts), "n_b": [0] * len(texts), "groups_sha256": [""] * len(texts), "links": [()] * len(texts)}
        some = [i for i, t in enumerate(texts) if t]
        if not some:
            return out
        good, a, ends_a, b, ends_b = self.tokenizers.texts([texts[i] for i in some])
        some = [i for i, g in zip(some, good.tolist()) if g]
        if not some:
            return out
        at_a, at_b = self.anchors(a, b, np.cumsum([len(texts[i]) + 1 for i in some]))
        distinct, window = np.unique(self.alike(a, b, at_a, at_b), return_inverse=True)
        a, b = a.tobytes(), b.tobytes()
        spans = zip(*[(4 * x).tolist() for x in (at_a[distinct], at_a[distinct + 1], at_b[distinct], at_b[distinct + 1])])
        keys = [(a[i:k], b[j:m]) for i, k, j, m in spans]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        found = list(map(self.known.get, keys))
        new = [k for k, f in zip(keys, found) if f is None]
        if new:
            made = dict(zip(new, self.windows(new)))
            found = [made[k] if f is None else f for k, f in zip(keys, found)]
            self.known.update((k, f) for k, f in made.items() if len(k[0]) <= 4 * LONG_WINDOW)
        links, begins = Ragged([n for _, n in found]).take(window)
        upto = [0, *np.searchsorted(at_a, ends_a).tolist()]
        groups = list(map([g for g, _ in found].__getitem__, window.tolist()))
        for i, n_a, n_b, lo, hi in zip(some, np.diff(ends_a, prepend=0).tolist(), np.diff(ends_b, prepend=0).tolist(), upto, upto[1:]):
            out["n_a"][i], out["n_b"][i] = n_a, n_b
            out["groups_sha256"][i] = hashlib.sha256(b";".join(groups[lo:hi])).hexdigest()
            out["links"][i] = links[begins[lo] : begins[hi]]
        return out


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(byte_bpe: str, pieces: str) -> Aligner:
    """One per Python process; names of installed public tokenizers."""
    if (byte_bpe, pieces) not in _ALIGNERS:
        _ALIGNERS[byte_bpe, pieces] = Aligner(byte_bpe, pieces)
    return _ALIGNERS[byte_bpe, pieces]


def link_counts(aligned: DataFrame, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each link occurs, and whether no link of its right token occurs more often."""
    found = aligned.select(F.explode("res.links").alias("link")).groupBy("link").count().toArrow()
    count = np.zeros(len(right), np.int64)
    count[found.column("link").to_numpy()] = found.column("count").to_numpy()
    most = np.zeros(int(right.max()) + 1, np.int64)
    np.maximum.at(most, right, count)
    return count, count == most[right]


FIELDS = "n_a long, n_b long, groups_sha256 string, links array<int>"
RESULT = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def alignments(docs: DataFrame, keep: Sequence[str], text: str = "text", byte_bpe: str = BYTE_BPE, pieces: str = PIECES) -> DataFrame:
    """Columns ``row`` (struct of ``keep``) and ``res``: tokens on both sides, groups, links and what the corpus says of them.

    Side a is a byte-level BPE over a space and the text, side b a sentence
    piece model over the text. ``n_best`` counts links that are the corpus's
    most frequent of their b token, ties included; ``count_sum`` adds up the
    corpus counts of the links. A null or empty text, and one whose tokens
    don't join to it, has no tokens and an empty digest. Rows are aligned one
    by one; repeated rows agree, and each counts in the corpus.
    """
    aligned = materialize(map_texts(docs, keep, text, FIELDS, lambda t: aligner(byte_bpe, pieces).aligned(t)))
    sent = docs.sparkSession.sparkContext.broadcast(link_counts(aligned, aligner(byte_bpe, pieces).links.right))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = sent.value
        for batch in batches:
            links = batch.column("links")
            numbers, offsets = links.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(links.value_lengths().to_numpy(zero_copy_only=False))))
            sums = [np.concatenate(([0], np.cumsum(values[numbers], dtype=np.int64)))[offsets] for values in (best, count)]
            made = [batch.column("n_a"), batch.column("n_b"), *[pa.array(x, pa.int64()) for x in (np.diff(offsets), np.diff(offsets), *map(np.diff, sums))], batch.column("groups_sha256")]
            res = pa.StructArray.from_arrays(made, names=["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
            yield pa.RecordBatch.from_arrays([batch.column("row"), res], names=["row", "res"])

    kept = aligned.schema["row"].dataType.simpleString()
    return aligned.select("row", "res.*").mapInArrow(score, f"row {kept}, res struct<{RESULT.replace(' ', ':').replace(',:', ',')}>")


def op12_space_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpack(alignments(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"]))


QUERIES = {"op12_space_anchors": (op12_space_anchors, None)}
