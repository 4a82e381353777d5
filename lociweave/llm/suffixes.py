"""Exact repeats of long byte strings: suffix buckets with cover-sample ranks.

Asked is, for every place of a text, whether the ``length`` bytes from there on
also start earlier. Sorting all suffixes at once would move every place with
its context, so it is done block by block over a cover sample:

* The sample has a place in every window of ``length`` bytes, at the same
  offset in equal windows. It is chosen by content (the place of the smallest
  hash of ``GRAM`` bytes in the window) rather than by a modular difference
  cover; both have the property that two equal suffixes meet sample places at
  a common offset, and this one needs a fifth of the places.
* A bucket is all sample places with the same GRAM bytes. Buckets of one place
  hold no repeats and are dropped before anything else of them moves.
* Long ties: the windows that share a sample place span one segment of the
  text. Segments are ranked beforehand by the smallest place that has their
  content; a place whose segment has an earlier rank repeats in all its windows
  without looking at a byte.
* Short ties: only the first place of each segment, in buckets of several
  segments, has its windows compared one by one.

Every comparison is a shuffle on hashes of fixed size; no bucket, however
large, meets in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.llm.common import SLICE_BYTES, body, col, slices, table
from lociweave.session import discard, materialize

LENGTH = 100
GRAM = 24
#: Bytes hashed at a time; longer texts are cut into overlapping chunks.
CHUNK_BITS = 19
CHUNK = 1 << CHUNK_BITS

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Hasher:
    """Polynomial hashes modulo 2^64 of any substring of a chunk, from running sums."""

    def __init__(self, base: np.uint64, size: int):
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        ones = lambda b: np.concatenate(([np.uint64(1)], np.full(size, b, np.uint64)))
        self.power, self.inverse = np.multiply.accumulate(ones(base)), np.multiply.accumulate(ones(inverse))
        self.letters = np.random.default_rng(int(base) % (1 << 32)).integers(1, 1 << 63, 256, dtype=np.uint64)

    def sums(self, text: np.ndarray) -> np.ndarray:
        out = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(self.letters[text] * self.power[: len(text)], out=out[1:])
        return out

    def part(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mix((sums[stop] - sums[start]) * self.inverse[start])


_HASHERS: list[Hasher] = []


def hashers() -> list[Hasher]:
    if not _HASHERS:
        _HASHERS.extend(Hasher(b, CHUNK + 1) for b in _BASES)
    return _HASHERS


def chunks(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, row and offset of each piece, its end) for runs of texts and cuts of long ones; all windows are covered once."""
    held, rows, offsets, size = [], [], [], 0

    def done():
        ends = np.cumsum([len(x) for x in held])
        return np.frombuffer(b"".join(held), np.uint8), np.array(rows), np.array(offsets), ends

    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), CHUNK - length + 1):
            piece = t[at : at + CHUNK]
            if len(piece) < length:
                continue
            if held and size + len(piece) > CHUNK:
                yield done()
                held, rows, offsets, size = [], [], [], 0
            held.append(piece)
            rows.append(i)
            offsets.append(at)
            size += len(piece)
    if held:
        yield done()


def cover(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Buckets of some texts: (row, bucket, segment, first window, last window).

    A sample place gives up to two buckets, one for the windows that reach at
    least half of the spare bytes to its left and one for the others, so that a
    bucket's windows share more bytes than the gram alone.
    """
    first = hashers()[0]
    width = length - GRAM + 1
    half = (length - GRAM) // 2
    found = []
    for text, rows, offsets, ends in chunks(texts, length):
        n = len(text)
        sums = first.sums(text)
        grams = _mix((sums[GRAM:] - sums[:-GRAM]) * first.inverse[: n - GRAM + 1])
        # The place itself breaks ties, leftmost first, and is read back from the minimum.
        low = (grams & ~np.uint64(CHUNK - 1)) | np.arange(len(grams), dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < width:
            low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
        place = (low & np.uint64(CHUNK - 1)).astype(np.int64)
        starts = np.concatenate(([0], ends[:-1]))
        piece = np.repeat(np.arange(len(ends)), ends - starts)
        window = np.flatnonzero(piece[: len(place)] == piece[length - 1 : length - 1 + len(place)])
        own, where = place[window], piece[window]
        right = own - window < half
        turn = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (where[1:] != where[:-1]) | (right[1:] != right[:-1]))))
        last = np.concatenate((turn[1:], [len(window)])) - 1
        begin, end, where, right = window[turn], window[last], where[turn], right[turn]
        common = np.where(right, own[turn], own[turn] - half)
        bucket = _mix(first.part(sums, common, common + GRAM + half) + right.astype(np.uint64) + np.uint64(1))
        segment = first.part(sums, begin, end + length) ^ (end - begin).astype(np.uint64)
        shift = offsets[where] - starts[where]
        found.append((rows[where], bucket, segment, begin + shift, end + shift))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*found))


def windows(text: bytes, runs: list[int], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(two hashes, start) of the windows in the coded runs of one text."""
    out = []
    starts = np.concatenate([np.arange(r >> RUN_BITS, (r >> RUN_BITS) + (r & MORE) + 1) for r in sorted(set(runs))])
    data = np.frombuffer(text, np.uint8)
    for at in range(0, len(data) - length + 1, CHUNK - length + 1):
        some = starts[(starts >= at) & (starts < at + CHUNK - length + 1)] - at
        if len(some):
            piece = data[at : at + CHUNK]
            out.append((*(h.part(h.sums(piece), some, some + length) for h in hashers()), some + at))
    return tuple(np.concatenate(x) for x in zip(*out))


def removal(text: bytes, runs: list[int] | None, length: int) -> tuple[int, int, str]:
    """(bytes removed, maximal removed runs, digest of the rest)."""
    if not runs:
        return 0, 0, hashlib.sha256(text).hexdigest()
    coded = np.unique(np.array(runs, np.int64))
    start = coded >> RUN_BITS
    stop = np.maximum.accumulate(start + (coded & MORE) + length)
    fresh = np.concatenate(([True], start[1:] > stop[:-1]))
    begin, end = start[fresh], stop[np.concatenate((fresh[1:], [True]))]
    rest, at = hashlib.sha256(), 0
    for a, b in zip(begin.tolist(), end.tolist()):
        rest.update(text[at:a])
        at = b
    rest.update(text[at:])
    return int((end - begin).sum()), len(begin), rest.hexdigest()


#: A run of windows is coded as start << RUN_BITS | 24 bits of the text's hash | number of further windows (8 bits).
RUN_BITS = 32
MORE = 0xFF
TAG = 0xFFFFFF00
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Inside, the shuffle files of a finished step are removed at once; its result is a written table."""
    before = spark.conf.get(CLEAN)
    spark.conf.set(CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN, before)


def tag(text: bytes) -> int:
    return crc32(text) & TAG


def later():
    """Whether (did, start of run) comes after the place in ``first``."""
    start = lambda c: F.shiftright(c, RUN_BITS)
    return (F.col("did") > F.col("first.did")) | ((F.col("did") == F.col("first.did")) & (start("run") > start("first.run")))


def with_tag(runs: DataFrame) -> DataFrame:
    return runs.withColumn("tag", F.col("run").bitwiseAND(F.lit(TAG)))


def own_tag():
    return F.crc32("body").bitwiseAND(F.lit(TAG))


def repeated_runs(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """Columns ``did``, ``tag``, ``runs``: per text with repeats, its repeated windows as coded runs. ``texts`` has did and body."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                bodies = part.column("body").to_pylist()
                row, bucket, segment, begin, end = cover(bodies, length)
                did, mark = part.column("did").to_numpy()[row], np.array([tag(t) for t in bodies], np.int64)[row]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (bucket.view(np.int64), segment.view(np.int64), did, begin << RUN_BITS | mark | (end - begin))], names=["bucket", "segment", "did", "run"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body", SLICE_BYTES // 8):
                found = [(did, tag(text), *windows(text, runs, length)) for did, text, runs in zip(*(part.column(c).to_pylist() for c in ("did", "body", "runs")))]
                sizes = [len(x[2]) for x in found]
                one, two, at = (np.concatenate([x[k] for x in found]) for k in (2, 3, 4))
                did, mark = (np.repeat(np.array([x[k] for x in found], np.int64), sizes) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (one.view(np.int64), two.view(np.int64), did, at << RUN_BITS | mark)], names=["one", "two", "did", "run"])

    with shuffles_removed(texts.sparkSession):
        all_places = texts.mapInArrow(sample, "bucket long, segment long, did long, run long")
        # Counts are written before they are joined: the join then deals both sides itself and can split a hot bucket.
        shared = materialize(all_places.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket"))
        places = materialize(all_places.join(shared.hint("shuffle_hash"), "bucket", "left_semi"))
        discard(shared)
        ranks = materialize(places.groupBy("bucket", "segment").agg(F.min(F.struct("did", "run")).alias("first")))
        long_ties = materialize(places.join(ranks, ["bucket", "segment"]).filter(later()).select("did", "run"))
        discard(places)
        mixed = materialize(ranks.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket"))
        open_runs = materialize(ranks.join(mixed.hint("shuffle_hash"), "bucket", "left_semi").select("first.*"))
        discard(ranks)
        open_runs = with_tag(open_runs).groupBy("did", "tag").agg(F.collect_list("run").alias("runs"))
        tagged = texts.withColumn("tag", own_tag())
        short = materialize(tagged.join(open_runs.hint("shuffle_hash"), ["did", "tag"]).mapInArrow(compare, "one long, two long, did long, run long"))
        seen = materialize(short.groupBy("one", "two").agg(F.count("*").alias("n"), F.min(F.struct("did", "run")).alias("first")).filter("n > 1").drop("n"))
        short_ties = materialize(short.join(seen.hint("shuffle_hash"), ["one", "two"]).filter(later()).select("did", "run"))
        discard(short)
        return materialize(with_tag(long_ties.unionByName(short_ties)).groupBy("did", "tag").agg(F.collect_list("run").alias("runs")))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Columns doc_id, n_bytes, n_removed, n_spans, kept_sha256, one row per row of ``docs``.

    A null text is empty; texts shorter than ``length`` keep all bytes. A null
    id counts as smaller than any other. Rows that share an id count as one
    document: a string repeats where it starts earlier in any of them, and rows
    that are equal get equal results. (Texts of one id are told apart by 24 bits
    of a hash.)
    """
    texts = docs.select(col(doc_id).cast("long").alias("doc_id"), F.coalesce(col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("did"), body(text).alias("body"))
    runs = repeated_runs(texts.select("did", "body"), length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                bodies = part.column("body").to_pylist()
                done = [removal(t, r, length) for t, r in zip(bodies, part.column("runs").to_pylist())]
                sizes = pa.array([len(t) for t in bodies], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), sizes, *(pa.array([d[k] for d in done], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string())))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = texts.withColumn("tag", own_tag()).join(runs.hint("shuffle_hash"), ["did", "tag"], "left").select("doc_id", "body", "runs")
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op5_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"))


QUERIES = {"op5_suffix_repeats": (op5_suffix_repeats, None)}
