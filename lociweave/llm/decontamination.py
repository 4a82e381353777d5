"""Benchmark passages in documents, found by Wu-Manber multi-pattern search.

Texts are brought to a plain form (A-Z lowered, words framed by single
spaces), test strings are windows of consecutive item words in the same form.
A shift table over hashed blocks of up to eight bytes tells how far a search
position may jump; positions with shift zero select a bucket by the hash of
their last block, narrowed by the string's first eight bytes; a comparison of
all bytes confirms. The positions of a batch advance in many lanes at once, so
the tables are read by numpy instead of a loop over characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.llm.common import LOWER_AZ, col, map_texts, table, unpack
from lociweave.session import materialize

WINDOW_WORDS = 10
#: Text bytes of the items whose tables are sent to the executors at a time.
BLOCK_BYTES = 1 << 20
#: Lower byte lengths of the groups of test strings; each group has its own shift table.
LENGTH_GROUPS = (3, 8, 16, 32)
TABLE_BITS = 23
LANE_BYTES = 1024

_WORD = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
PLAIN = bytes(b if b in _WORD else 0x20 for b in LOWER_AZ)


def item_words(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


class Group:
    """Shift table and buckets of the test strings of similar length."""

    def __init__(self, strings: list[bytes], ids: list[int]):
        self.m = min(map(len, strings))
        self.block = min(8, self.m)
        self.mask = np.uint64((1 << (8 * self.block)) - 1)
        self.head_mask = np.uint64((1 << (8 * min(8, self.m))) - 1)
        joined = np.frombuffer(b"".join(s[: self.m] for s in strings), np.uint8).reshape(-1, self.m)
        far = min(255, self.m - self.block + 1)
        self.shift = np.full(1 << TABLE_BITS, far, np.uint8)
        for end in range(self.block, self.m + 1):
            blocks = np.zeros(len(strings), np.uint64)
            for k in range(self.block):
                blocks |= joined[:, end - self.block + k].astype(np.uint64) << np.uint64(8 * k)
            slot = self._slot(blocks)
            np.minimum.at(self.shift, slot, np.uint8(min(255, self.m - end)))
        heads = np.array([int.from_bytes(s[: min(8, self.m)], "little") for s in strings], np.uint64)
        key = self._key(blocks, heads)
        order = np.argsort(key, kind="stable")
        self.key, self.ids = key[order], np.array(ids, np.int64)[order]
        self.strings = [strings[i] for i in order]

    def _slot(self, blocks: np.ndarray) -> np.ndarray:
        return ((blocks * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    @staticmethod
    def _key(blocks: np.ndarray, heads: np.ndarray) -> np.ndarray:
        return (blocks * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (heads * np.uint64(0x165667B19E3779F9))

    def search(self, plain: bytes, words8: np.ndarray, n: int) -> list[tuple[int, int]]:
        """(start byte, string id) of every occurrence; ``words8[i]`` is the eight bytes from i on."""
        first = self.m - self.block  # where the last block of the window that starts at 0 begins
        last = n - self.block
        if last < first:
            return []
        at = np.arange(first, last + 1, LANE_BYTES, dtype=np.int64)
        until = np.minimum(at + LANE_BYTES, last + 1)
        found = []
        while len(at):
            step = self.shift[self._slot(words8[at] & self.mask)]
            found.append(at[step == 0])
            at = at + np.maximum(step, 1).astype(np.int64)
            on = at < until
            at, until = at[on], until[on]
        hits = np.concatenate(found)
        starts = hits - first
        key = self._key(words8[hits] & self.mask, words8[starts] & self.head_mask)
        lo, hi = np.searchsorted(self.key, key, "left"), np.searchsorted(self.key, key, "right")
        out = []
        for i in np.flatnonzero(hi > lo):
            s = int(starts[i])
            for j in range(lo[i], hi[i]):
                if plain.startswith(self.strings[j], s):
                    out.append((s, int(self.ids[j])))
        return out


class Matcher:
    """All windows of a block of items, and which items each belongs to."""

    def __init__(self, items: Sequence[tuple[str | None, bytes]], window: int = WINDOW_WORDS):
        owners: dict[bytes, set[str]] = {}
        for name, text in items:
            words = item_words(text)
            for i in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(b" " + b" ".join(words[i : i + window]) + b" ", set()).update([name] if name is not None else [])
        strings = sorted(owners)
        self.length = np.array([s.count(b" ") - 1 for s in strings], np.int64)
        self.owners = [sorted(owners[s]) for s in strings]
        bounds = [*LENGTH_GROUPS, 1 << 62]
        self.groups = []
        for low, high in zip(bounds, bounds[1:]):
            ids = [i for i, s in enumerate(strings) if low <= len(s) < high]
            if ids:
                self.groups.append(Group([strings[i] for i in ids], ids))

    def scan(self, texts: list[bytes]) -> tuple[list[int], list[list[tuple[int, int]]], list[set[str]]]:
        """Per text: number of words, disjoint word spans that are hit, names of the items found."""
        framed = np.frombuffer(b" " + b" \n ".join(t.translate(PLAIN) for t in texts) + b" \n        ", np.uint8)
        space = framed == 32
        plain8 = framed[~(space & np.concatenate(([False], space[:-1])))]
        plain8 = np.concatenate((plain8, np.zeros(8, np.uint8)))
        plain = plain8.tobytes()
        n = len(plain8) - 8
        words8 = np.ndarray((n,), "<u8", plain8, strides=(1,))
        ends = np.flatnonzero(plain8[:n] == 10)
        starts = np.flatnonzero((plain8[:n] != 32) & (plain8[:n] != 10) & (np.concatenate(([32], plain8[: n - 1])) == 32))
        upto = np.searchsorted(starts, ends)
        counts = np.diff(np.concatenate(([0], upto)))
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        names: list[set[str]] = [set() for _ in texts]
        occurrences = sorted({x for g in self.groups for x in g.search(plain, words8, n)})
        if occurrences:
            begin = np.array([s for s, _ in occurrences], np.int64)
            ids = np.array([i for _, i in occurrences], np.int64)
            doc = np.searchsorted(ends, begin)
            word = np.searchsorted(starts, begin + 1) - np.concatenate(([0], upto))[doc]
            for d, w, i in zip(doc.tolist(), word.tolist(), ids.tolist()):
                end = w + int(self.length[i])
                own = spans[d]
                if own and w <= own[-1][1]:
                    own[-1] = (own[-1][0], max(own[-1][1], end))
                else:
                    own.append((w, end))
                names[d].update(self.owners[i])
        return counts.tolist(), spans, names


FIELDS = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<struct<start:long,stop:long>>, items array<string>"


def _results(counts, spans, names) -> dict:
    items = [sorted(x) for x in names]
    hit = [sum(b - a for a, b in s) for s in spans]
    return {
        "n_words": counts, "n_hit": hit, "n_items": [len(x) for x in items],
        "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items],
        "contaminated": [h > 0 for h in hit],
        "spans": [[{"start": a, "stop": b} for a, b in s] for s in spans], "items": items,
    }


def contamination(
    docs: DataFrame, benchmark: DataFrame, keep: Sequence[str], text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Columns ``row`` (struct of ``keep``) and ``res``: word count, hit words, items found, merged word spans.

    Items are taken in blocks of about ``block_bytes`` of text, so tables and
    broadcasts stay bounded whatever the benchmark's size; each further block
    is one more pass over the documents. A null or wordless text has no words
    and no hits; a wordless item matches nothing; an item without an id hits
    words but isn't listed; repeated items count once; an empty benchmark
    finds nothing. Rows are judged one by one, so repeated rows agree.
    """
    spark = docs.sparkSession
    items = benchmark.select(col(item_id).cast("string").alias("name"), col(item_text).cast("binary").alias("body")).filter("body is not null").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    part = F.pmod(F.xxhash64("name", "body"), F.lit(blocks))
    mapped = None
    for b in range(blocks):
        rows = [(r[0], bytes(r[1])) for r in items.filter(part == b).collect()]
        held = spark.sparkContext.broadcast(Matcher(rows, window))
        if mapped is None:
            mapped = map_texts(docs, keep, text, FIELDS, lambda texts, held=held: _results(*held.value.scan(texts)))
            if blocks > 1:
                # The text rides along for the passes that follow.
                mapped = map_texts(docs.withColumn("_lw_body", col(text).cast("binary")), [*keep, "_lw_body"], text, FIELDS, lambda texts, held=held: _results(*held.value.scan(texts)))
        else:
            mapped = _further(materialize(mapped), held)
    return mapped if blocks == 1 else mapped.select(F.col("row").dropFields("_lw_body").alias("row"), "res")


def _further(mapped: DataFrame, held) -> DataFrame:
    """Add what another block of items finds."""
    packed = mapped.withColumn("body", F.coalesce(F.col("row._lw_body"), F.lit(bytearray())))
    again = map_texts(packed, ["row", "res"], "body", FIELDS, lambda texts: _results(*held.value.scan(texts)))
    old, new = F.col("row.res"), F.col("res")
    flat = again.select(
        F.col("row.row").alias("row"), old.getField("n_words").alias("n_words"),
        F.array_sort(F.concat(old.getField("spans"), new.getField("spans"))).alias("all_spans"),
        F.array_sort(F.array_union(old.getField("items"), new.getField("items"))).alias("items"),
    )
    long = lambda c: c.cast("long")
    nothing = F.expr("cast(array() as array<struct<start:long,stop:long>>)")
    merged = F.aggregate(
        "all_spans", nothing,
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (x["start"] <= F.element_at(acc, -1)["stop"]),
            F.concat(
                F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["stop"], x["stop"]).alias("stop"))),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )
    flat = flat.withColumn("spans", merged)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])
    return flat.select(
        "row",
        F.struct(
            "n_words", hit.alias("n_hit"), long(F.size("items")).alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
            (hit > 0).alias("contaminated"), "spans", "items",
        ).alias("res"),
    )


def op1_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"), ["doc_id"])
    return unpack(found, "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_AZ = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"coalesce(regexp_extract_all({_AZ}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), CAST([] AS VARCHAR[]))"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10 + 1, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
pos AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
own AS (SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM pos, (SELECT DISTINCT k FROM win) WHERE i + k - 1 <= len(w)),
hit AS (SELECT DISTINCT r, i, a.k, item_id FROM own a JOIN win USING (k, s)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM hit)) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS l FROM (SELECT DISTINCT r, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
QUERIES = {"op1_wu_manber": (op1_wu_manber, SQL)}
