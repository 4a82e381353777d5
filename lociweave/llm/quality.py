"""Quality rules: plain counts per text, and a hashed n-gram log-likelihood ratio.

Words and pairs of neighbouring words are hashed into a fixed number of
buckets. Two smoothed multinomials over the buckets, one of trusted documents
and one of the whole corpus, give each text a log-likelihood ratio, divided by
its number of n-grams. A text is kept if it passes the plain rules and the
ratio reaches the threshold; nothing is drawn at random.

The threshold is fitted too, as the ratio's scale depends on the number of
trusted n-grams: trusted documents get the ratio they would have if their fold
were not trusted, and a low quantile of these less a margin is the threshold.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.llm.common import body, col, map_texts, slices, table, unpack
from lociweave.session import discard, materialize

BUCKETS = 1 << 16
#: Used where fewer than LEAST_HELD_OUT trusted documents pass the plain rules: none of them lies below the quantile then.
THRESHOLD = -0.3
FOLDS = 5
QUANTILE = 0.005
MARGIN = 0.05
LEAST_HELD_OUT = 200
MIN_WORDS = 50
MAX_REPEATED = 0.5
#: Bits of the bitmap of good ids that tasks get, whatever the corpus (8 MB), and how many of them mark an id.
ID_BITS = 1 << 26
PROBES = 4
SMOOTHING = 1.0
#: N-grams per bucket that the trusted side borrows from the corpus.
BORROWED = 1.0

_SPACE = bytes([0x20, *range(0x09, 0x0E)])
_SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(b for b in range(256) if b not in _SYMBOLS)
_TRAILING = bytes(range(0x80, 0xC0))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.uint64, len(words))


def ngram_buckets(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of every word and of every pair of neighbours."""
    mix = np.uint64(0x9E3779B97F4A7C15)
    one = (h + np.uint64(1)) * mix
    two = (one[:-1] ^ (h[1:] << np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F) + h[1:] * mix
    both = np.concatenate((one, two * mix))
    return ((both >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def repeated_words(words: list[bytes], h: np.ndarray) -> int:
    """Words inside three-word windows that occur at least twice in the text."""
    if len(words) < 4:
        return 0
    a = np.uint64(0x9E3779B97F4A7C15)
    key = np.sort(((h[:-2] * a) ^ (h[1:-1] << np.uint64(31))) * a + h[2:])
    if not (key[1:] == key[:-1]).any():  # equal windows have equal keys
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    first = np.fromiter((seen[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(first)] |= first
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(_SPACE)]
    return len(lines) - len(set(lines))


def bucket_counts(docs: DataFrame, text: str, buckets: int = BUCKETS, fold: Column | None = None, folds: int = 1) -> DataFrame:
    """Columns ``fold``, ``bucket``, ``n``: n-grams of all texts, summed in each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((folds, buckets), np.int64)
        for batch in batches:
            for part in slices(batch, "body"):
                for f, x in zip(part.column("fold").to_pylist(), part.column("body").to_pylist()):
                    if words := x.split():
                        total[f] += np.bincount(ngram_buckets(word_hashes(words), buckets), minlength=buckets)
        own, some = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(some), pa.array(total[own, some])], names=["fold", "bucket", "n"])

    marked = docs.select((F.lit(0) if fold is None else fold).cast("int").alias("fold"), body(text).alias("body"))
    return marked.mapInArrow(count, "fold long, bucket long, n long").groupBy("fold", "bucket").agg(F.sum("n").alias("n"))


def _marks(h: np.ndarray, bits: int) -> list[np.ndarray]:
    """The bits of each hash, PROBES arrays of them."""
    h = h.view(np.uint64)
    first, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return [((first + np.uint64(k) * step) % np.uint64(bits)).astype(np.int64) for k in range(PROBES)]


def _marked(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    known = np.ones(len(h), bool)
    for bit in _marks(h, len(bitmap) * 64):
        known &= (bitmap[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) != 0
    return known


def id_bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of all rows of the column ``_lw_hash``; its size is fixed, so the driver may hold and send it."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = np.concatenate(_marks(batch.column("_lw_hash").to_numpy(), bits))
            yield pa.RecordBatch.from_arrays([pa.array(bit >> 6), pa.array(np.left_shift(np.uint64(1), (bit & 63).astype(np.uint64)).view(np.int64))], names=["at", "bits"])

    found = hashes.select("_lw_hash").mapInArrow(marks, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(bits >> 6, np.uint64)
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _only_marked(rows: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """Rows whose ``_lw_hash`` the bitmap knows."""
    sent = rows.sparkSession.sparkContext.broadcast(bitmap)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_marked(sent.value, batch.column("_lw_hash").to_numpy())))

    return rows.mapInArrow(known, rows.schema)


def trusted_documents(docs: DataFrame, labels: DataFrame, doc_id: str, bits: int = ID_BITS) -> DataFrame:
    """All documents labelled good.

    Only ids are shuffled, texts stay in place: a bitmap of the good ids, of a
    fixed size, rules out nearly all other documents, and those that it lets
    through are known by id and left out by a join.
    """
    good = labels.filter(F.col("quality") == 1).select(F.col("doc_id").alias("_lw_good")).filter("_lw_good is not null").distinct()
    ids = docs.select(col(doc_id).alias("_lw_id")).filter("_lw_id is not null").distinct()
    ids = materialize(ids.join(good, F.col("_lw_id") == F.col("_lw_good"), "left").select("_lw_id", F.xxhash64("_lw_id").alias("_lw_hash"), F.col("_lw_good").isNotNull().alias("_lw_good")))
    bitmap = id_bitmap(ids.filter("_lw_good"), bits)
    # Written, so that the optimizer knows that these are few.
    stray = materialize(_only_marked(ids.filter("not _lw_good").select("_lw_id", "_lw_hash"), bitmap).select("_lw_id"))
    discard(ids)
    known = _only_marked(docs.filter(col(doc_id).isNotNull()).withColumn("_lw_hash", F.xxhash64(col(doc_id))), bitmap).drop("_lw_hash")
    return known.join(stray, col(doc_id) == F.col("_lw_id"), "left_anti")


def fold_of(doc_id: str, folds: int = FOLDS) -> Column:
    return F.pmod(F.xxhash64(col(doc_id)), F.lit(folds))


def ratio_weights(trusted: DataFrame, raw: DataFrame, text: str, buckets: int = BUCKETS, fold: Column | None = None, folds: int = 0) -> np.ndarray:
    """Log ratios of the two smoothed multinomials per bucket, whatever the corpus' size.

    The first row trusts all of ``trusted``, row k + 1 all but its fold k.
    """
    both = bucket_counts(trusted, text, buckets, fold, max(folds, 1)).unionByName(bucket_counts(raw, text, buckets).withColumn("fold", F.lit(-1).cast("long")))
    counts, all_raw = np.zeros((max(folds, 1), buckets)), np.zeros(buckets)
    for f, b, n in both.collect():
        (all_raw if f < 0 else counts[f])[b] = n
    prior = (all_raw + SMOOTHING) / (all_raw.sum() + SMOOTHING * buckets)
    out = np.zeros((folds + 1, buckets))
    for k in range(folds + 1):
        good = counts.sum(axis=0) - (counts[k - 1] if k else 0)
        if good.any():
            # The trusted side borrows from the corpus where it has seen little.
            out[k] = np.log((good + BORROWED * buckets * prior) / (good.sum() + BORROWED * buckets)) - np.log(prior)
    return out


def held_out_threshold(trusted: DataFrame, text: str, fold: Column, weights: np.ndarray) -> float:
    """QUANTILE of the ratios of trusted documents that pass the plain rules, each held out with its fold, less MARGIN."""
    shared = trusted.sparkSession.sparkContext.broadcast(weights)

    def ratios(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                found = []
                for f, x in zip(part.column("fold").to_pylist(), part.column("body").to_pylist()):
                    words = x.split()
                    h = word_hashes(words)
                    if not base_failed(len(words), repeated_words(words, h)):
                        found.append(float(shared.value[f + 1][ngram_buckets(h, weights.shape[1])].mean()))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.float64())], names=["ratio"])

    held = trusted.select(fold.cast("int").alias("fold"), body(text).alias("body")).mapInArrow(ratios, "ratio double")
    n, low = held.agg(F.count("*"), F.percentile_approx("ratio", QUANTILE, 100_000)).first()
    return low - MARGIN if n >= LEAST_HELD_OUT else THRESHOLD


FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, log_ratio double, kept boolean"


def base_failed(n_words: int, repeated: int) -> bool:
    return n_words < MIN_WORDS or repeated > MAX_REPEATED * n_words


def judge(texts: list[bytes], weights: np.ndarray, threshold: float) -> dict:
    out: dict[str, list] = {f.split()[0]: [] for f in FIELDS.split(", ")}
    for x in texts:
        words = x.split()
        h = word_hashes(words)
        n, repeated = len(words), repeated_words(words, h)
        failed = base_failed(n, repeated)
        ratio = float(weights[ngram_buckets(h, len(weights))].mean()) if n else 0.0
        other = len(x) - len(x.translate(None, _SPACE + _TRAILING))
        row = (n, len(x) - other, len(x.translate(None, _NOT_SYMBOLS)), duplicate_lines(x), repeated, failed, ratio, not failed and ratio >= threshold)
        for values, v in zip(out.values(), row):
            values.append(v)
    return out


def quality(
    docs: DataFrame, labels: DataFrame, keep: Sequence[str], doc_id: str = "doc_id", text: str = "text",
    buckets: int = BUCKETS, threshold: float | None = None,
) -> DataFrame:
    """Columns ``row`` (struct of ``keep``) and ``res``: counts, verdict of the plain rules, ratio, verdict.

    Raw counts cover all of ``docs``; the trusted side is all documents that
    ``labels`` calls good. A null or empty text has no words and fails the
    plain rules. Without trusted documents the ratio is 0 and the plain rules alone decide. Repeated rows are judged alike.
    ``threshold`` is fitted from held-out trusted documents unless given.
    """
    ours = docs.select(col(doc_id).alias("_lw_doc"), col(text).alias("_lw_text"))
    trusted = materialize(trusted_documents(ours, labels, "_lw_doc"))
    fold = fold_of("_lw_doc")
    weights = ratio_weights(trusted, ours, "_lw_text", buckets, fold, FOLDS)
    least = held_out_threshold(trusted, "_lw_text", fold, weights) if threshold is None else threshold
    discard(trusted)
    held = docs.sparkSession.sparkContext.broadcast(weights[0])
    return map_texts(docs, keep, text, FIELDS, lambda texts: judge(texts, held.value, least))


def op10_quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return unpack(quality(docs, table(spark, sf_dir, "labels"), ["doc_id"]))


QUERIES = {"op10_quality_ratio": (op10_quality_ratio, None)}
