"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

Lexicon voters are word and word-beginning lists mined from labelled rows, one
per family of features and third of the rows; pattern voters look at shouting,
exclamation marks, insults in address and similar. The label model sees only
the votes: expectation maximisation gives each voter's accuracy in both
classes, and the correlations that remain given the class shrink the say of
voters that repeat each other. Its posteriors are the labels that a logistic
regression on hashed word features is trained on, which scores every text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.llm.common import body, col, map_texts, slices, table, unpack
from lociweave.llm.decontamination import PLAIN
from lociweave.session import materialize

#: Labelled rows that voters and classifier are fitted on at most, those with the smallest hash of their id.
LABELLED_ROWS = 12_000
#: Features the lexicons and the classifier have at most.
MAX_FEATURES = 4096
THRESHOLD = 0.7
THIRDS = 3
PREFIXES = (5, 6, 7, 8)
#: A word, a beginning of a longer word, and a beginning that several words of a text share.
FAMILIES = (("words", {0}), ("beginnings", {*range(1, len(PREFIXES) + 1)}), ("shared beginnings", {*range(len(PREFIXES) + 1, 2 * len(PREFIXES) + 1)}))
#: Share of toxic texts among those with a feature, for lexicons and classifier.
LISTED_RATE, USED_RATE = 0.75, 0.5
#: Nats of evidence that a feature goes with the label: number of texts times relative entropy to the base rate.
EVIDENCE, EVIDENCE_OF_THIRD = 9.0, 5.0
REMEMBERED = 400_000

_SHOUT = re.compile(rb"\b[A-Z]{3,}\b")
PATTERNS = (
    ("shouting", lambda t, n: len(_SHOUT.findall(t)) > 0.3 * n),
    ("exclaiming", lambda t, n: t.count(b"!") > 0.2 * n),
    ("address", lambda t, n: re.search(rb"\b(you|u) (are|r|stupid|idiot|piece)\b|\bdu bist\b|\btu es\b|\beres un", t, re.IGNORECASE) is not None),
    ("swearing signs", lambda t, n: re.search(rb"[A-Za-z][*#@]{2,}[A-Za-z]?", t) is not None),
    ("repeated marks", lambda t, n: re.search(rb"[!?]{3,}", t) is not None),
)


def word_features(word: bytes) -> tuple[int, ...]:
    """Hashed features of one lowered word: itself and its beginnings; -1 where it isn't longer than the beginning."""
    text = word.decode(errors="replace")
    return (crc32(b"w:" + word), *(crc32(f"{n}:{text[:n]}".encode()) if len(text) > n else -1 for n in PREFIXES))


def text_features(words: set[bytes]) -> set[tuple[int, int]]:
    """(kind, hash) of a text's features, each once."""
    n = len(PREFIXES)
    seen = Counter((k, f) for w in words for k, f in enumerate(word_features(w)) if f >= 0)
    return set(seen) | {(k + n, f) for (k, f), times in seen.items() if k and times > 1}


def words_of(text: bytes) -> set[bytes]:
    return set(text.translate(PLAIN).split())


def signature(words: list[bytes], salt: int) -> int:
    """Minimum hash over five-word shingles: near copies share it with the chance of their similarity."""
    return min((crc32(b" ".join(words[i : i + 5]), salt) for i in range(max(1, len(words) - 4))), default=0)


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = LABELLED_ROWS) -> DataFrame:
    """Columns id, text, y of at most ``limit`` labelled rows outside the held-out third, one of each group of copies."""
    usable = labels.filter("toxic is not null and doc_id is not null").filter(~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("y"))
    chosen = usable.orderBy(F.xxhash64("_id"), "_id").limit(limit)
    texts = docs.join(F.broadcast(chosen), docs["doc_id"] == F.col("_id")).select("_id", "y", "text")

    def mark(parts: list[bytes]) -> dict:
        split = [t.translate(PLAIN).split() for t in parts]
        return {"one": [signature(w, 1) for w in split], "two": [signature(w, 2) for w in split]}

    marked = unpack(map_texts(texts, ["_id", "y", "text"], "text", "one long, two long", mark))
    once = marked.groupBy("one").agg(F.min(F.struct("_id", "y", "text", "two")).alias("s")).select("s.*")
    once = once.groupBy("two").agg(F.min(F.struct("_id", "y", "text")).alias("s")).select("s.*")
    return materialize(once.withColumn("third", F.pmod(F.xxhash64("_id"), F.lit(THIRDS)).cast("int")))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def feature_counts(sample: DataFrame) -> DataFrame:
    """Columns kind, f and counts of texts by label and third (``n0`` .. ``n5``, label-major)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            rows = [(k, f, g, n) for (k, f, g), n in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int32(), pa.int64()))], names=["kind", "f", "g", "n"])

        for batch in batches:
            for part in slices(batch, "body"):
                for text, y, third in zip(part.column("body").to_pylist(), part.column("y").to_pylist(), part.column("third").to_pylist()):
                    g = (1 if y else 0) * THIRDS + third
                    held.update([(k, f, g) for k, f in text_features(words_of(text))])
                    if len(held) > 200_000:
                        yield flush()
        yield flush()

    raw = sample.select(body("text").alias("body"), "y", "third").mapInArrow(count, "kind int, f long, g int, n long")
    return raw.groupBy("kind", "f").agg(*[F.sum(F.when(F.col("g") == g, F.col("n")).otherwise(0)).alias(f"n{g}") for g in range(2 * THIRDS)])


def evidence(hit: np.ndarray, n: np.ndarray, base: float) -> np.ndarray:
    """n times the relative entropy of the hit rate to the base rate, zero where the rate is below it."""
    rate = np.clip(hit / np.maximum(n, 1), 1e-12, 1 - 1e-12)
    kl = rate * np.log(rate / base) + (1 - rate) * np.log((1 - rate) / (1 - base))
    return np.where(rate > base, n * kl, 0.0)


class Lexicon:
    """Chosen features, and which of them each voter lists."""

    def __init__(self, counts: list, totals: np.ndarray):
        self.ids: dict[tuple[int, int], int] = {}
        self.voters: list[tuple[str, set[int]]] = []
        if not counts or not totals[THIRDS:].sum() or not totals[:THIRDS].sum():
            return
        n = np.array([r[2:] for r in counts], float)
        toxic, clean = n[:, THIRDS:], n[:, :THIRDS]
        base = totals[THIRDS:].sum() / totals.sum()
        whole = evidence(toxic.sum(1), n.sum(1), base) * (toxic.sum(1) >= USED_RATE * n.sum(1))
        order = sorted(np.flatnonzero(whole >= EVIDENCE), key=lambda i: (-whole[i], counts[i][0], counts[i][1]))[:MAX_FEATURES]
        self.ids = {(counts[i][0], counts[i][1]): j for j, i in enumerate(order)}
        for third in range(THIRDS):
            own = totals[THIRDS + third] + totals[third]
            rate = totals[THIRDS + third] / own if own else 0
            both = toxic[:, third] + clean[:, third]
            some = evidence(toxic[:, third], both, rate) * (toxic[:, third] >= LISTED_RATE * both) if 0 < rate < 1 else np.zeros(len(n))
            for name, kinds in FAMILIES:
                listed = {j for j, i in enumerate(order) if counts[i][0] in kinds and some[i] >= EVIDENCE_OF_THIRD}
                if listed:
                    self.voters.append((f"{name}, third {third}", listed))

    def finder(self):
        """A function from text to the indices of its features; remembers what it has seen of words."""
        known: dict[bytes, tuple[tuple[int, int], ...]] = {}
        n = len(PREFIXES)

        def find(text: bytes) -> set[int]:
            if len(known) > REMEMBERED:
                known.clear()
            met: list[tuple[int, int]] = []
            for w in words_of(text):
                hits = known.get(w)
                if hits is None:
                    hits = known[w] = tuple(x for x in enumerate(word_features(w)) if x in self.ids or x[0] and (x[0] + n, x[1]) in self.ids)
                if hits:
                    met += hits
            out = {self.ids[x] for x in met if x in self.ids}
            if len(met) > 1:
                shared = ((k + n, f) for (k, f), times in Counter(met).items() if k and times > 1)
                out.update(self.ids[x] for x in shared if x in self.ids)
            return out

        return find


def votes(found: set[int], text: bytes, lexicon: Lexicon) -> list[int]:
    """1 for toxic, 0 for none, in the order of the lexicons and PATTERNS."""
    n = text.count(b" ") + 1
    return [1 if listed & found else 0 for _, listed in lexicon.voters] + [1 if applies(text, n) else 0 for _, applies in PATTERNS]


def label_model(v: np.ndarray, share: float, rounds: int = 200) -> np.ndarray:
    """Posterior of the label per row of ``v``; accuracies by expectation maximisation, votes weighed by independence.

    ``share`` is the known share of the label. Ends when no posterior moves, or after ``rounds``.
    """
    # A voter's silence says something too, unless it rarely speaks at all.
    often = (v == 1).mean(0) > 0.02
    cast = np.stack([v == 1, (v == 0) & often], 2).astype(float)
    start = np.where((v * often).any(1), np.clip(v.mean(1) + 0.5, 0.5, 0.95), 0.02)
    prior = np.clip(share, 1e-3, 0.5)
    say = np.ones(v.shape[1])
    for fitted in range(2):
        p = start
        for _ in range(rounds):
            rates = [(np.einsum("i,ijk->jk", w, cast) + 0.5) / (w.sum() + 1.5) for w in (1 - p, p)]
            odds = (np.log(rates[1] / rates[0])[None] * cast).sum(2) @ say + np.log(prior / (1 - prior))
            new = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
            moved, p = np.abs(new - p).max(), new
            if moved < 1e-7:
                break
        if not fitted:
            # What still goes together given the class: voters that repeat each other share one say.
            means = np.stack([(w[:, None] * v).sum(0) / max(w.sum(), 1e-9) for w in (1 - p, p)])
            left = v - means[(p > 0.5).astype(int)]
            sd = left.std(0)
            corr = np.divide(left.T @ left / len(v), np.outer(sd, sd), out=np.zeros((len(sd), len(sd))), where=np.outer(sd, sd) > 0)
            np.fill_diagonal(corr, 1)
            say = 1 / np.abs(corr).sum(1)
    return p


def logistic(hits: list[list[int]], target: np.ndarray, width: int, steps: int = 400, rate: float = 0.5, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias on feature presence for soft labels, both classes with the same total weight."""
    row = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    feature = np.array([f for h in hits for f in h], np.int64)
    w, b = np.zeros(width), 0.0
    share = np.where(target > 0.5, 0.5 / max((target > 0.5).sum(), 1), 0.5 / max((target <= 0.5).sum(), 1))
    m, s, t = np.zeros(width + 1), np.zeros(width + 1), 0
    for t in range(1, steps + 1):
        margin = np.bincount(row, w[feature], len(hits)) + b
        error = share * (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - target)
        g = np.append(np.bincount(feature, error[row], width) + decay * w, error.sum())
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        move = rate * 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, limit: int = LABELLED_ROWS) -> tuple[Lexicon, np.ndarray, float]:
    sample = labelled_sample(docs, labels, limit)
    totals = np.zeros(2 * THIRDS)
    for y, third, n in sample.groupBy((F.col("y") > 0).cast("int"), "third").count().collect():
        totals[y * THIRDS + third] = n
    counted = feature_counts(sample)
    toxic = sum((F.col(f"n{THIRDS + i}") for i in range(THIRDS)), F.lit(0))
    # A cheap bound first: fewer texts than this can't reach the evidence.
    kept = counted.filter(toxic >= 2).orderBy((toxic / sum((F.col(f"n{g}") for g in range(2 * THIRDS)), F.lit(1))).desc(), toxic.desc(), "kind", "f").limit(16 * MAX_FEATURES)
    lexicon = Lexicon([tuple(r) for r in kept.collect()], totals)
    if not lexicon.ids:
        return lexicon, np.zeros(0), -4.0
    held = docs.sparkSession.sparkContext.broadcast(lexicon)

    def look(texts: list[bytes]) -> dict:
        find = held.value.finder()
        found = [find(t) for t in texts]
        return {"hits": [sorted(f) for f in found], "votes": [votes(f, t, held.value) for f, t in zip(found, texts)]}

    rows = unpack(map_texts(sample, ["_id"], "text", "hits array<int>, votes array<int>", look)).orderBy("_id").collect()
    posterior = label_model(np.array([r["votes"] for r in rows]), totals[THIRDS:].sum() / totals.sum())
    w, b = logistic([r["hits"] for r in rows], posterior, len(lexicon.ids))
    return lexicon, w, b


def toxicity(docs: DataFrame, labels: DataFrame, limit: int = LABELLED_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """Columns doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text).

    A null or empty text scores as one without any feature. Without labels of
    both kinds every score is the same low one. A null id isn't held out.
    Repeated rows score alike; of repeated labels the highest counts.
    """
    docs, labels = docs.select("doc_id", "text"), labels.select("doc_id", "toxic")
    lexicon, w, b = fit(docs, labels, limit)
    held = docs.sparkSession.sparkContext.broadcast((lexicon, w, b))

    state: dict = {}

    def score(texts: list[bytes]) -> dict:
        model, weights, bias = held.value
        find = state.setdefault("find", model.finder())
        out = [float(1 / (1 + np.exp(-np.clip(bias + sum(weights[f] for f in sorted(find(t))), -40, 40)))) for t in texts]
        return {"score": out, "predicted": [int(x >= threshold) for x in out]}

    scored = unpack(map_texts(docs, ["doc_id"], "text", "score double, predicted int", score))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))


QUERIES = {"op4_weak_supervision": (op4_weak_supervision, None)}
