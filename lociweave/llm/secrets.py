"""Secret scan: fixed patterns, and candidates judged by who else has them.

Every text is scanned once. Candidates (the fixed kinds and high-entropy
strings) go on as a hash of their value with the document as repository and
the source as owner; the hashes are counted corpus-wide by distinct
repositories and owners. A value that few owners have looks live; one that many
have is a copied example. Spans of the fixed kinds always stay; those of the
wider kinds are added where their value looks live.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.llm.common import col, map_texts, slices, table
from lociweave.session import materialize

#: Fixed kinds in the order that breaks ties, then the kinds that the corpus decides on.
KINDS = ("assign", "access", "hex", "key_block", "credential", "entropy")
BASE_KINDS = 3
MAX_OWNERS = 2
MIN_ENTROPY = 3.5
MIN_DIGITS = 4
MASK = "[SECRET]"

_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
_HINTS = (b"passw", b"secret", b"token", b"api")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{16,}")  # runs are maximal, so this is a run of any length that is long enough
_KEY_BLOCK = re.compile(rb"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----")
_CREDENTIAL = re.compile(rb"://[A-Za-z0-9._%-]+:([^\s/:@]{6,})@")
_ENTROPY = re.compile(rb"[A-Za-z0-9+/_=-]{20,}")


def entropy(value: bytes) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def candidates(text: bytes) -> list[tuple[int, int, int, bytes]]:
    """(kind, start byte, end byte, value), fixed kinds first."""
    out = []
    lower = text.lower()
    if any(h in lower for h in _HINTS):
        out += [(0, m.start(), m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(1, m.start(), m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    out += [(2, m.start(), m.end(), m[0]) for m in _HEX.finditer(text)]
    taken = [(a, b) for _, a, b, _ in out]
    wider = []
    if b"PRIVATE KEY" in text:
        wider += [(3, m.start(), m.end(), m[0]) for m in _KEY_BLOCK.finditer(text)]
    if b"://" in text:
        wider += [(4, m.start(1), m.end(1), m[1]) for m in _CREDENTIAL.finditer(text)]
    wider += [
        (5, m.start(), m.end(), m[0]) for m in _ENTROPY.finditer(text)
        if sum(m[0].count(d) for d in b"0123456789") >= MIN_DIGITS and re.search(rb"[A-Za-z]", m[0]) and entropy(m[0]) >= MIN_ENTROPY
    ]
    for x in wider:
        if not any(x[1] < b and a < x[2] for a, b in taken):
            taken.append(x[1:3])
            out.append(x)
    return out


FIELDS = "n_assign long, n_access long, n_hex long, base_sha256 string, found array<struct<start:long,kind:int,stop:long,hash:string>>"


def scan(texts: list[bytes]) -> dict:
    out: dict[str, list] = {"n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "found": []}
    for t in texts:
        spans = []
        if got := candidates(t):
            if t.isascii():
                point = None
            else:
                point = np.concatenate(([0], np.cumsum((np.frombuffer(t, np.uint8) & 0xC0) != 0x80)))
            for kind, a, b, value in got:
                a, b = (a, b) if point is None else (int(point[a]), int(point[b]))
                spans.append({"start": a, "kind": kind, "stop": b, "hash": hashlib.sha256(value).hexdigest()[:32]})
            spans.sort(key=lambda s: (s["start"], s["kind"]))
        base = [s for s in spans if s["kind"] < BASE_KINDS]
        for k, name in enumerate(("n_assign", "n_access", "n_hex")):
            out[name].append(sum(s["kind"] == k for s in base))
        out["base_sha256"].append(hashlib.sha256(",".join(f"{KINDS[s['kind']]}:{s['start']}:{s['stop']}" for s in base).encode()).hexdigest())
        out["found"].append(spans)
    return out


def ownership(candidates: DataFrame) -> DataFrame:
    """Columns ``hash``, ``owners``, ``repositories``. Every count is partly summed before its shuffle."""
    once = candidates.select("hash", "owner", "repository").distinct()
    per_owner = once.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return per_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))


def secrets(
    docs: DataFrame, keep: Sequence[str], text: str = "text", repository: str = "doc_id", owner: str = "source", max_owners: int = MAX_OWNERS,
) -> DataFrame:
    """Columns ``row`` (struct of ``keep``), the base counts and digest, and ``judged``: spans with ``live`` and ``stays``.

    A null or empty text has no spans. Null repositories and owners count as
    one each. Repeated rows of a document are one repository and get the same
    spans each. Offsets are code points.
    """
    spark = docs.sparkSession
    marked = docs.select(F.struct(*[col(c) for c in keep]).alias("kept"), col(repository).cast("string").alias("repository"), col(owner).cast("string").alias("owner"), col(text).alias("text"))
    mapped = map_texts(marked, ["kept", "repository", "owner"], "text", FIELDS, scan)
    # Written with a number per row: the numbers are joined on, and the texts are scanned once.
    rows = materialize(mapped.select(F.monotonically_increasing_id().alias("rid"), "row.*", "res.*"))
    each = rows.filter(F.size("found") > 0).select("rid", "repository", "owner", F.explode("found").alias("s")).select("rid", "repository", "owner", "s", F.col("s.hash").alias("hash"))
    live = each.join(ownership(each), "hash").select(
        "rid",
        F.struct(
            F.col("s.start").alias("start"), F.col("s.kind").alias("kind"), F.col("s.stop").alias("stop"), (F.col("owners") <= max_owners).alias("live"),
            ((F.col("s.kind") < BASE_KINDS) | (F.col("owners") <= max_owners)).alias("stays"), "owners", "repositories",
        ).alias("j"),
    )
    per_row = live.groupBy("rid").agg(F.array_sort(F.collect_list("j")).alias("judged"))
    none = F.expr("array()").cast(per_row.schema["judged"].dataType)
    fields = [F.col("kept").alias("row"), "n_assign", "n_access", "n_hex", "base_sha256"]
    with_spans = rows.filter(F.size("found") > 0).join(per_row, "rid").select(*fields, "judged")
    return rows.filter(F.size("found") == 0).select(*fields, none.alias("judged")).unionByName(with_spans)


def span_text(judged: str = "judged"):
    """``kind:start:end`` of the spans that stay, by start and kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    stays = F.filter(judged, lambda s: s["stays"])
    return F.array_join(F.transform(stays, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def op2_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), ["doc_id"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256", span_text().alias("spans"),
        F.size(F.filter("judged", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("judged", lambda s: ~s["live"])).cast("long").alias("n_copied"),
    )


def redacted(found: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The rows of ``secrets`` (kept columns) with every span that stays replaced by a mask."""
    kept = found.schema["row"].dataType
    clean = found.filter(~F.exists("judged", lambda s: s["stays"])).select("row.*")
    hit = found.filter(F.exists("judged", lambda s: s["stays"])).select(
        F.col("row").getField(text).alias("body"), "row", F.transform(F.filter("judged", lambda s: s["stays"]), lambda s: F.struct(s["start"].alias("a"), s["stop"].alias("b"))).alias("cuts")
    ).withColumn("body", F.col("body").cast("binary"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                texts = [mask(t.decode(), [(c["a"], c["b"]) for c in cuts]) for t, cuts in zip(part.column("body").to_pylist(), part.column("cuts").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(texts, pa.string())], names=["row", "masked"])

    done = hit.mapInArrow(cut, hit.select("row", F.lit("").alias("masked")).schema)
    changed = {text: F.col("masked")} | ({n_chars: F.char_length("masked").cast(kept[n_chars].dataType)} if n_chars in kept.names else {})
    return clean.unionByName(done.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in kept.names]))


def mask(text: str, cuts: list[tuple[int, int]]) -> str:
    """Overlapping cuts are one."""
    out, at = [], 0
    for a, b in sorted(cuts):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], MASK]
        at = b
    return "".join(out) + text[at:]


QUERIES = {"op2_ownership": (op2_ownership, None)}
