"""Near copies: five-word shingle sets with a Jaccard similarity of 0.8 or more, or SimHash fingerprints within a few bits.

Texts of equal words are one class, so exact copies are compared once. MinHash
bands give candidates: classes that share a band are in one bucket. Of each
bucket the member that stands in the most and largest buckets is its centre
(in a group of near copies the text that the others were made from), and every
member is compared with it whole. Two members that are both similar to the
centre are joined by it. A stray, which isn't, is compared with all other
members, except where what both share with the centre rules a link out. Every
pair of a bucket is thus joined, compared or ruled out, and comparing a group
of near copies takes about one comparison a member. Strays are compared by how
their shingles differ from the centre's: few numbers, not whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.llm import simhash
from lociweave.llm.common import LOWER_AZ, body, col, map_texts, slices
from lociweave.llm.suffixes import shuffles_removed
from lociweave.session import discard, materialize

SHINGLE_WORDS = 5
#: Copies share at least NUMERATOR / DENOMINATOR of the union of their shingles.
NUMERATOR, DENOMINATOR = 4, 5
#: At similarity 0.8 a pair shares no band in 1 - (1 - 0.8 ** 4) ** 20: 3 pairs in 100,000.
BANDS = 20
BAND_ROWS = 4
SEED = 5
#: Long integers of the bitmap that stands for a class's differing shingles where strays are compared.
MARKS = 8

_FACTORS = np.random.RandomState(SEED).randint(1, 1 << 62, BANDS * BAND_ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(words: list[bytes], width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a text of fewer words is one shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    w = min(width, len(words))
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    ends = np.cumsum([len(x) + 1 for x in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    part = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - w + 1].tolist(), ends[w - 1 :].tolist())])
    return np.unique(np.frombuffer(part, np.uint64))


def bands(shingles: np.ndarray) -> list[int]:
    """A number per band of MinHash values; none for an empty set."""
    if not len(shingles):
        return []
    low = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), 4096):
        low = np.minimum(low, (shingles[k : k + 4096, None] * _FACTORS).min(axis=0))
    data = low.tobytes()
    return [crc32(data[k : k + 8 * BAND_ROWS]) - (1 << 31) for k in range(0, len(data), 8 * BAND_ROWS)]


def keys(texts: list[bytes]) -> list[int]:
    """64 bits of the lower-cased words."""
    return [xxhash.xxh3_64_intdigest(b" ".join(t.translate(LOWER_AZ).split())) - (1 << 63) for t in texts]


def signatures(texts: list[bytes]) -> dict:
    n, found = [], []
    for t in texts:
        s = shingle_set(t.translate(LOWER_AZ).split())
        n.append(len(s))
        found.append(bands(s))
    return {"fp": simhash.signed(simhash.fingerprints(texts)), "key": keys(texts), "n": n, "bands": found}


def _fits(n: str, m: str):
    """Whether sets of these sizes can be similar enough."""
    return DENOMINATOR * F.least(n, m) >= NUMERATOR * F.greatest(n, m)


def _similar(shared, n: str, m: str):
    return DENOMINATOR * shared >= NUMERATOR * (F.col(n) + F.col(m) - shared)


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Columns key, centre, shared, differ: shingles that a class shares with its centre, and hashes of those that only one of them has.

    ``marks`` is a bitmap of the differing ones, ``lost`` how many of them share a bit with another.

    ``pairs`` has key, centre and whether the differing ones are asked for;
    ``texts`` has key and body. Both texts are read whole.
    """
    both = pairs.join(texts, "key").join(texts.withColumnsRenamed({"key": "centre", "body": "other"}), "centre")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                shared, differ, marks, lost = [], [], [], []
                for t, u, asked in zip(*(part.column(c).to_pylist() for c in ("body", "other", "asked"))):
                    a, b = (shingle_set(x.translate(LOWER_AZ).split()) for x in (t, u))
                    apart = np.setxor1d(a, b, assume_unique=True)
                    shared.append((len(a) + len(b) - len(apart)) // 2)
                    differ.append(simhash.signed(apart) if asked else None)
                    bits = np.unique(apart % np.uint64(64 * MARKS))
                    words = np.zeros(MARKS, np.uint64)
                    np.bitwise_or.at(words, bits // np.uint64(64), np.uint64(1) << bits % np.uint64(64))
                    marks.append(simhash.signed(words))
                    lost.append(len(apart) - len(bits))
                made = [pa.array(shared, pa.int64()), pa.array(differ, pa.list_(pa.int64())), pa.array(marks, pa.list_(pa.int64())), pa.array(lost, pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("centre"), *made], names=["key", "centre", "shared", "differ", "marks", "lost"])

    return both.select("key", "centre", "asked", "body", "other").mapInArrow(compare, "key long, centre long, shared long, differ array<long>, marks array<long>, lost long")


def similar_links(classes: DataFrame, texts_of) -> DataFrame:
    """Columns ``a``, ``b``: links between classes that join all candidate pairs of similar shingle sets.

    ``classes`` has key, n and bands; ``texts_of`` gives key and body of the
    classes that a table of keys names.
    """
    bucket = ["band", "h"]
    members = classes.select("key", "n", F.posexplode("bands").alias("band", "h"))
    shared = materialize(members.groupBy(bucket).agg(F.count("*").alias("size")).filter("size > 1"))
    placed = materialize(members.join(shared, bucket))
    discard(shared)
    weight = placed.groupBy("key").agg(F.sum("size").alias("weight"))
    first = F.max(F.struct("weight", "key", "n")).alias("c")
    centres = materialize(placed.join(weight, "key").groupBy(bucket).agg(first).select(*bucket, F.col("c.key").alias("centre"), F.col("c.n").alias("m")))
    around = materialize(placed.join(centres, bucket).filter("key != centre"))
    discard(placed)
    discard(centres)
    pairs = materialize(around.groupBy("key", "centre").agg((F.max("size") > 2).alias("asked")))
    texts = materialize(texts_of(pairs.select("key").unionByName(pairs.select(F.col("centre").alias("key"))).distinct()))
    star = materialize(compared(pairs, texts))
    discard(texts)
    discard(pairs)

    facts = star.select("key", "centre", "shared", "lost", *[F.col("marks")[i].alias(f"mark{i}") for i in range(MARKS)])
    known = materialize(around.join(facts, ["key", "centre"]).withColumn("near", _similar(F.col("shared"), "n", "m")).withColumn("apart", F.col("n") + F.col("m") - 2 * F.col("shared")))
    direct = known.filter("near").select(F.col("key").alias("a"), F.col("centre").alias("b")).distinct()
    stray = known.filter("not near and size > 2").select(*bucket, F.col("key").alias("other"), F.col("n").alias("o"), F.col("shared").alias("also"), F.col("apart").alias("off"), F.col("lost").alias("gone"), *[F.col(f"mark{i}").alias(f"with{i}") for i in range(MARKS)])
    member = known.filter("size > 2").select(*bucket, "key", "centre", "n", "shared", "near", "apart", "lost", *[f"mark{i}" for i in range(MARKS)])
    # Two sets share at most what each shares with the centre and what each has besides. They differ in what differs
    # from the centre in one of them only, and what differs in both has common marks, but for those that were lost.
    most = F.least("shared", "also") + F.least(F.col("n") - F.col("shared"), F.col("o") - F.col("also"))
    common = sum((F.bit_count(F.col(f"mark{i}").bitwiseAND(F.col(f"with{i}"))) for i in range(MARKS)), F.least("lost", "gone"))
    least_apart = F.col("apart") + F.col("off") - 2 * common
    possible = (F.col("near") | (F.col("key") < F.col("other"))) & (F.col("key") != F.col("other")) & _similar(most, "n", "o")
    possible = possible & _similar((F.col("n") + F.col("o") - least_apart) / 2, "n", "o")
    on = [member[c] == stray[c] for c in bucket] + [possible]
    open_pairs = member.join(stray, on).groupBy(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")).agg(
        F.min(F.struct("centre", F.when(F.col("key") < F.col("other"), F.col("n")).otherwise(F.col("o")).alias("n"), F.when(F.col("key") < F.col("other"), F.col("o")).otherwise(F.col("n")).alias("m"))).alias("c"))
    open_pairs = materialize(open_pairs.select("a", "b", "c.*"))
    sides = [star.select(F.col("key").alias(x), "centre", F.col("differ").alias(f"differ_{x}")) for x in ("a", "b")]
    apart = F.size("differ_a") + F.size("differ_b") - 2 * F.size(F.array_intersect("differ_a", "differ_b"))
    more = open_pairs.join(sides[0], ["a", "centre"]).join(sides[1], ["b", "centre"]).filter(_similar((F.col("n") + F.col("m") - apart) / 2, "n", "m")).select("a", "b")
    links = materialize(direct.unionByName(more))
    for used in (around, star, known, open_pairs):
        discard(used)
    return links


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = simhash.BITS) -> DataFrame:
    """One row of each group of near copies, all columns: that with the smallest id, a null id last; of repeated rows any one.

    Copies are joined by chains of links of either kind. Texts are told apart
    by 64 bits of their lower-cased words. Null, empty and wordless texts are
    one group. An empty table stays empty; other columns, whatever their
    names, are handed on as they are. ``docs`` is read several times and must
    give the same rows each time.
    """
    spark = docs.sparkSession
    with shuffles_removed(spark):
        made = map_texts(docs, [doc_id], text, "fp long, key long, n int, bands array<int>", signatures)
        marks = materialize(made.select(F.col("row").getField(doc_id).alias("id"), "res.*"))
        rank = F.struct(F.col("id").isNull().alias("none"), "id")
        classes = materialize(marks.groupBy("key").agg(F.min(rank).alias("first"), F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("bands").alias("bands")))
        copies = materialize(marks.groupBy("id", "key").agg(F.count("*").alias("rows")))
        discard(marks)

        def texts_of(wanted: DataFrame) -> DataFrame:
            asked = classes.join(wanted, "key", "left_semi").select("key", F.col("first.id").alias("id"))
            found = map_texts(docs.select(col(doc_id).alias("id"), body(text).alias("body")), ["id", "body"], "body", "key long", lambda t: {"key": keys(t)})
            found = found.select("row.id", "row.body", "res.key")
            here = found.join(asked.withColumnsRenamed({"key": "_key", "id": "_id"}), (F.col("key") == F.col("_key")) & F.col("id").eqNullSafe(F.col("_id")), "left_semi")
            return here.dropDuplicates(["key"]).select("key", "body")

        points = materialize(classes.groupBy("fp").agg(F.min("key").alias("head")))
        near = simhash.links(points, radius)
        for end in ("a", "b"):
            near = near.join(points.select(F.col("fp").alias(end), F.col("head").alias(f"{end}_key")), end)
        same = classes.join(points, "fp").select(F.col("key").alias("a"), F.col("head").alias("b")).filter("a != b")
        by_bits = materialize(same.unionByName(near.select(F.col("a_key").alias("a"), F.col("b_key").alias("b"))))
        by_words = similar_links(classes, texts_of)
        label = simhash.components(by_bits.unionByName(by_words)).withColumnRenamed("node", "key")
        groups = classes.join(label, "key", "left").groupBy(F.coalesce("label", "key").alias("label")).agg(F.min(F.struct("first", "key")).alias("f"))
        chosen = groups.select(F.col("f.first.id").alias("_id"), F.col("f.key").alias("_key"))
        kept = materialize(chosen.join(copies, (F.col("key") == F.col("_key")) & F.col("id").eqNullSafe(F.col("_id"))).select("_id", "_key", "rows"))
        for used in (classes, copies, points, by_bits, by_words, label):
            discard(used)
    keyed = map_texts(docs, docs.columns, text, "key long", lambda t: {"key": keys(t)})
    found = keyed.join(kept, (F.col("res.key") == F.col("_key")) & F.col("row").getField(doc_id).eqNullSafe(F.col("_id")))
    once = found.filter("rows = 1").select("row")
    repeated = found.filter("rows > 1").dropDuplicates(["_id", "_key"]).select("row")
    return once.unionByName(repeated).select("row.*")
