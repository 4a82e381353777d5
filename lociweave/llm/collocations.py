"""Phrase collocations from count streams kept in prefix and in suffix order.

Phrases are counted level by level: a phrase of n words is counted only where
both phrases of n - 1 words in it reached the least count. Tasks learn that
from a bitmap of fixed size, which may let a phrase through that did not reach
it (its exact count is filtered afterwards) but never holds one back.

All counts are then one stream, sorted twice. In prefix order a phrase comes
right after its beginnings, so the last count of k words that went by is the
left count of its cut after k words; in suffix order the same gives the right
counts. A phrase that is one word longer sees its two parents on the way and
tells whether it subsumes them. The two streams are merged in step; no count
is looked up by a hash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lociweave.llm.common import body, col, slices, table
from lociweave.operators.joins import same_keys
from lociweave.operators.sliced import POS, SLICE, slice_rows
from lociweave.session import discard, materialize

LEAST = 30
LONGEST = 4
#: A phrase goes if a longer one has at least SUBSUMED per cent of its occurrences.
SUBSUMED = 80
TOP = 2000
SCALE = 2_000_000
MISSING = "und"

#: Bits of the bitmap of frequent phrases that tasks get, whatever the corpus (8 MB).
FILTER_BITS = 1 << 26
#: Bytes of text whose words are counted at a time, unless a single text is longer.
COUNT_BYTES = 1 << 22
#: Distinct words that a task holds before it passes their counts on.
HELD_WORDS = 1 << 19

BREAK = b"\xff"
#: A-Z lower-cased; the ends of pieces become a byte that UTF-8 lacks.
PIECES = bytes(0xFF if chr(b) in ".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(texts: list[bytes]) -> list[bytes]:
    """Words of the texts in order, with BREAK between pieces and between texts."""
    return BREAK.join(texts).translate(PIECES).replace(BREAK, b" \xff ").split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Positions:
    """Word numbers of a run of texts of one group, and hashes of the phrases that start at each place."""

    def __init__(self, group: str, texts: list[bytes]):
        self.words = words_of(texts)
        number = {w: i for i, w in enumerate(dict.fromkeys([BREAK, *self.words]))}
        self.ids = np.fromiter(map(number.__getitem__, self.words), np.int64, len(self.words))
        salt = np.uint64(xxhash.xxh64_intdigest(group.encode()))
        digests = np.frombuffer(b"".join(map(xxhash.xxh64_digest, number)), ">u8").astype(np.uint64)
        self.word_hash = _mix(digests ^ salt)[self.ids]

    def hashes(self, n: int) -> np.ndarray:
        """Of the phrase of n words that starts at each place, breaks or not."""
        h = self.word_hash
        for k in range(1, n):
            h = _mix(h[:-1] * np.uint64(3) + self.word_hash[k:])
        return h

    def whole(self, n: int) -> np.ndarray:
        """Whether the n words from each place lie in one piece."""
        inside = self.ids != 0
        ok = inside[: len(inside) - n + 1]
        for k in range(1, n):
            ok = ok & inside[k : len(inside) - n + 1 + k]
        return ok

    def counted(self, n: int, keep: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """Distinct phrases of n words that start at the places kept, and how often; by sorting word numbers."""
        at = np.flatnonzero(keep)
        key = self.ids[at]
        for k in range(1, n):
            if k > 1:
                key = np.unique(key, return_inverse=True)[1]
            key = (key << 32) | self.ids[at + k]
        _, first, count = np.unique(key, return_index=True, return_counts=True)
        return [b" ".join(self.words[i : i + n]) for i in at[first].tolist()], count


def _by_group(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    for part in slices(batch, "body", COUNT_BYTES):
        found: dict[str, list[bytes]] = {}
        for g, t in zip(part.column("grp").to_pylist(), part.column("body").to_pylist()):
            found.setdefault(g, []).append(t)
        yield from found.items()


def _rows(group: str, phrases: list[bytes | None], counts) -> pa.RecordBatch:
    text = pa.array(phrases, pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([pa.array([group] * len(phrases), pa.string()), text, pa.array(counts, pa.int64())], names=["grp", "phrase", "c"])


PARTIAL = "grp string, phrase string, c long"


def word_counts(texts: DataFrame) -> DataFrame:
    """Counts per group and word, summed; the null phrase of a group has the number of all its words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for g, c in held.items():
                yield _rows(g, [*c, None], [*c.values(), sum(c.values())])
            held.clear()

        for batch in batches:
            for g, part in _by_group(batch):
                held.setdefault(g, Counter()).update(words_of(part))
                del held[g][BREAK]
                if sum(map(len, held.values())) > HELD_WORDS:
                    yield from passed_on()
        yield from passed_on()

    return _summed(texts.mapInArrow(count, PARTIAL))


def _summed(partial: DataFrame) -> DataFrame:
    return partial.groupBy("grp", "phrase").agg(F.sum("c").alias("f"))


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(FILTER_BITS - 1)
    return h & mask, (h >> np.uint64(32)) & mask


def frequent_bitmap(frequent: DataFrame, n: int) -> np.ndarray:
    """Bitmap of the hashes of all rows of ``frequent``; its size is fixed, so the driver may hold and send it."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, phrases in _by_group(batch):
                at = Positions(g, phrases)
                h = at.hashes(n)[at.whole(n)] if len(at.ids) >= n else np.zeros(0, np.uint64)
                bit = np.concatenate(_bits(h)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(bit >> 6), pa.array(np.left_shift(np.uint64(1), (bit & 63).astype(np.uint64)).view(np.int64))], names=["at", "bits"])

    marked = frequent.select("grp", body("phrase").alias("body")).mapInArrow(marks, "at long, bits long")
    found = marked.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS >> 6, np.uint64)
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def phrase_counts(texts: DataFrame, n: int, shorter: DataFrame) -> DataFrame:
    """Counts per group and phrase of n words, of those whose parts of n - 1 words may all be in ``shorter``."""
    sent = texts.sparkSession.sparkContext.broadcast(frequent_bitmap(shorter, n - 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = sent.value
        for batch in batches:
            for g, part in _by_group(batch):
                at = Positions(g, part)
                if len(at.ids) < n:
                    continue
                known = np.ones(len(at.ids) - n + 2, bool)
                for bit in _bits(at.hashes(n - 1)):
                    known &= (bitmap[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) != 0
                phrases, counts = at.counted(n, known[:-1] & known[1:] & at.whole(n))
                if phrases:
                    yield _rows(g, phrases, counts)

    return _summed(texts.mapInArrow(count, PARTIAL))


def _passing(stream: DataFrame, words, longest: int, out: str) -> DataFrame:
    """``stream`` with columns out1, out2, ..: the last count of so many words that went by, in the order of ``words``."""
    order = [F.get(words, F.lit(k)).alias(f"v{k}") for k in range(longest)]
    sliced = slice_rows(stream.select("*", *order), ["grp"], [F.col(f"v{k}").asc_nulls_first() for k in range(longest)]).drop(*[f"v{k}" for k in range(longest)])
    sizes = range(1, longest)
    in_slice = Window.partitionBy("grp", SLICE).orderBy(POS)
    across = Window.partitionBy("grp").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    of = lambda k: F.when(F.col("n") == k, F.col("f"))
    ends = sliced.groupBy("grp", SLICE).agg(*[F.max_by("f", F.when(F.col("n") == k, F.col(POS))).alias(f"_e{k}") for k in sizes])
    carried = ends.select("grp", SLICE, *[F.last(f"_e{k}", True).over(across).alias(f"_c{k}") for k in sizes])
    local = sliced.withColumns({f"_l{k}": F.last(of(k), True).over(in_slice.rowsBetween(Window.unboundedPreceding, -1)) for k in sizes})
    joined = same_keys(local, carried, ["grp", SLICE])
    return joined.withColumns({f"{out}{k}": F.coalesce(f"_l{k}", f"_c{k}") for k in sizes}).drop(SLICE, POS, *[f"_{x}{k}" for x in "lc" for k in sizes])


def _share(part, whole, percent: int):
    """Whether ``part`` is at least so many per cent of ``whole``, exactly."""
    return F.lit(100).cast("decimal(18,0)") * part.cast("decimal(19,0)") >= F.lit(percent).cast("decimal(18,0)") * whole.cast("decimal(19,0)")


def candidates(counts: DataFrame, longest: int = LONGEST, subsumed: int = SUBSUMED) -> DataFrame:
    """Phrases of two words and more with their counts and worst cut: grp, phrase, a, l, r, score; without subsumed ones.

    ``counts`` has grp, phrase, n (words) and f, and with a phrase all its parts.
    """
    words = F.split("phrase", " ")
    ahead = _passing(counts, words, longest, "l").hint("merge")
    back = _passing(counts.select("grp", "phrase", "n", "f"), F.reverse(words), longest, "r").select("grp", "phrase", *[f"r{k}" for k in range(1, longest)])
    both = materialize(ahead.join(back, ["grp", "phrase"]).filter("n > 1"))

    cuts = []
    for k in range(1, longest):
        left = F.col(f"l{k}")
        right = F.element_at(F.array(*[F.col(f"r{m}") for m in range(1, longest)]), F.col("n") - k)
        score = F.expr(f"cast({SCALE} as decimal(18,0)) * cast(f as decimal(19,0)) div (cast(l{k} as decimal(19,0)) + cast(r_{k} as decimal(19,0)))")
        both = both.withColumn(f"r_{k}", F.when(F.col("n") > k, right))
        cuts.append(F.when(F.col("n") > k, F.struct(score.cast("long").alias("score"), F.lit(k).alias("k"), left.alias("l"), F.col(f"r_{k}").alias("r"))))
    worst = F.array_min(F.filter(F.array(*cuts), lambda c: c.isNotNull())) if longest > 2 else cuts[0]

    def gone(parent, count):
        return both.filter(F.col("n") > 2).filter(_share(F.col("f"), count, subsumed)).select("grp", parent.alias("phrase"))

    before = F.element_at(F.array(*[F.col(f"l{k}") for k in range(1, longest)]), F.col("n") - 1)
    after = F.element_at(F.array(*[F.col(f"r{k}") for k in range(1, longest)]), F.col("n") - 1)
    first = F.array_join(F.slice(words, F.lit(1), F.col("n") - 1), " ")
    last = F.array_join(F.slice(words, F.lit(2), F.col("n") - 1), " ")
    dropped = gone(first, before).unionByName(gone(last, after)).distinct()
    left = both.withColumn("w", worst).hint("merge").join(dropped, ["grp", "phrase"], "left_anti")
    return left.select("grp", "phrase", F.col("f").alias("a"), "w.l", "w.r", "w.score")


def collocations(
    docs: DataFrame, group: str = "lang", text: str = "text", longest: int = LONGEST, least: int = LEAST, subsumed: int = SUBSUMED, top: int = TOP
) -> DataFrame:
    """Columns grp, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each group.

    ``a``, ``l``, ``r`` are the counts of the phrase and of the two sides of its
    worst cut, ``n`` the words of the group. Order: score and ``a`` descending,
    then the phrase's bytes. A null group is ``und``; null, empty and wordless
    texts have no words; repeated rows count as often as they stand there. An
    empty table gives no rows, other columns are not read.
    """
    texts = docs.select(F.coalesce(col(group).cast("string"), F.lit(MISSING)).alias("grp"), body(text).alias("body"))
    words = materialize(word_counts(texts).filter((F.col("f") >= least) | F.col("phrase").isNull()))
    totals = words.filter(F.col("phrase").isNull()).select("grp", F.col("f").alias("total"))
    found = [words.filter(F.col("phrase").isNotNull())]
    for n in range(2, longest + 1):
        found.append(materialize(phrase_counts(texts, n, found[-1]).filter(F.col("f") >= least)))
    counts = found[0].withColumn("n", F.lit(1))
    for n, more in enumerate(found[1:], 2):
        counts = counts.unionByName(more.withColumn("n", F.lit(n)))
    scored = candidates(counts, longest, subsumed)
    order = Window.partitionBy("grp").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    best = materialize(scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top))
    out = materialize(best.join(totals, "grp").select("grp", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"))
    for used in (words, *found[1:], best):
        discard(used)
    return out


def op13_count_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents")).withColumnRenamed("grp", "lang")


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS MATERIALIZED (SELECT lang, row_number() OVER () AS pid, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM split GROUP BY lang),
words AS (SELECT lang, pid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM split),
ahead AS (
  SELECT lang, w, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3, lead(w, 3) OVER p AS w4
  FROM words WINDOW p AS (PARTITION BY pid ORDER BY i)),
grams AS (
  SELECT lang, 1 AS k, w AS phrase FROM ahead
  UNION ALL SELECT lang, 2, w || ' ' || w2 FROM ahead WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w || ' ' || w2 || ' ' || w3 FROM ahead WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, w || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM ahead WHERE w4 IS NOT NULL),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
cand AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, j AS cut, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a // (x.f + y.f))::BIGINT AS score
  FROM cand c, range(1, 4) t(j)
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:j], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[j + 1:], ' ')
  WHERE j < c.k),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
parts AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, a AS longer
  FROM cand, range(2, 4) s(m), range(1, 4) t(i) WHERE m < k AND i + m - 1 <= k),
gone AS (SELECT DISTINCT p.lang, p.phrase FROM parts p JOIN cand c ON c.lang = p.lang AND c.phrase = p.phrase WHERE 100 * p.longer >= 80 * c.a),
ranked AS (
  SELECT w.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM worst w ANTI JOIN gone USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

QUERIES = {"op13_count_streams": (op13_count_streams, ORACLE)}
