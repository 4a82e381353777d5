"""Licence scan: ordered signature rules, gated by keywords, nested detections resolved by priority.

A text becomes its lower-cased words with single spaces. Keywords that occur
in it decide which rules are tried at all; a rule's matches are read off as
word spans. Of two detections where one's span lies in the other's, that of
the worse priority goes; of equal ones the inner, of equal spans the later
rule. Overlaps without nesting stay. Everything is one projection over the
documents: no shuffle, and memory is that of one text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.llm.common import col, table
from lociweave.llm.license_rules import RULES_TEXT

#: Phrases that are always counted, with their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: How sure a detection of each priority is; a base phrase counts as a name.
CONFIDENCE = (1.0, 0.95, 0.9, 0.7, 0.4)
BASE_CONFIDENCE = 0.7

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

Rule = tuple[str, int, str, str]


def rules(text: str = RULES_TEXT) -> list[Rule]:
    """(label, priority, keyword, pattern) in order."""
    out = []
    for line in filter(None, text.splitlines()):
        label, priority, keyword, pattern = line.split(" ", 3)
        out.append((label, int(priority), keyword, pattern))
    return out


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def word_stream(text: Column) -> Column:
    """Words in order, a space before, between and after them."""
    plain = F.coalesce(text.cast("string"), F.lit(""))
    # Lower-casing an ASCII text changes A-Z alone, and costs far less than looking up each character.
    lowered = F.when(F.length(plain) == F.octet_length(plain), F.lower(plain)).otherwise(F.translate(plain, UPPER, LOWER))
    return F.regexp_replace(F.concat(F.lit(" "), lowered, F.lit(" ")), SEPARATORS, " ")


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


SPAN = "struct<first:int,back:int,priority:int,rule:int,label:string>"
SEEN = "struct<at:int,spans:array<struct<first:int,last:int>>>"


def _spans(words: Column, pattern: Column) -> Column:
    """Word spans (first, last exclusive) of the matches of a pattern, left to right."""
    whole = F.concat(F.lit("(?<= )(?:"), pattern, F.lit(")(?= )"))

    def step(seen: Column, x: Column) -> Column:
        first = seen.at + x.gap - 1
        span = F.struct(first.alias("first"), (first + x.inner + 1).alias("last"))
        return F.struct((seen.at + x.gap + x.inner).alias("at"), F.concat(seen.spans, F.array(span)).alias("spans")).cast(SEEN)

    none = F.struct(F.lit(0).alias("at"), F.array().alias("spans")).cast(SEEN)

    def placed(found: Column) -> Column:
        # Few rules match, so the text is searched once for each and cut up only where there is something to place.
        gaps = F.slice(F.split(words, whole, -1), F.lit(1), F.size(found))
        pairs = F.zip_with(gaps, found, lambda g, m: F.struct(spaces(g).alias("gap"), spaces(m).alias("inner")))
        return F.when(F.size(found) > 0, F.aggregate(pairs, none, step).spans).otherwise(none.spans)

    return bound(F.regexp_extract_all(words, whole, F.lit(0)), placed)


def _detections(words: Column, rule_list: Sequence[Rule]) -> Column:
    """All matches of all rules whose keyword occurs."""
    keywords = sorted({k for _, _, k, _ in rule_list})
    table = F.array(*[
        F.struct(F.lit(label).alias("label"), F.lit(p).alias("priority"), F.lit(n).alias("rule"), F.lit(k).alias("keyword"), F.lit(pattern).alias("pattern"))
        for n, (label, p, k, pattern) in enumerate(rule_list)
    ])
    # One pass over the words, not one over the text for each keyword.
    present = F.array_intersect(F.split(words, " "), F.array(*map(F.lit, keywords)))

    def of_rule(r: Column) -> Column:
        return F.transform(_spans(words, r.pattern), lambda s: F.struct(s.first.alias("first"), (-s.last).alias("back"), r.priority.alias("priority"), r.rule.alias("rule"), r.label.alias("label")))

    none = F.array().cast(f"array<{SPAN}>")
    return bound(present, lambda p: F.when(F.size(p) == 0, none).otherwise(F.flatten(F.transform(F.filter(table, lambda r: F.array_contains(p, r.keyword)), of_rule))))


def _settled(found: Column) -> Column:
    """Detections that no nested one displaces, in order; two passes that keep the furthest and the nearest end of each priority."""
    levels = len(CONFIDENCE)
    far = 2**31 - 1

    def backward(seen: Column, x: Column) -> Column:
        better = (x.priority > 1) & (F.get(seen.least, x.priority - 2) <= -x.back)
        least = F.transform(seen.least, lambda v, i: F.when(i >= x.priority - 1, F.least(v, -x.back)).otherwise(v))
        return F.struct(least.alias("least"), F.concat(seen.kept, F.when(better, F.array().cast(f"array<{SPAN}>")).otherwise(F.array(x))).alias("kept"), F.concat(seen.gone, F.when(better, F.array(x)).otherwise(F.array().cast(f"array<{SPAN}>"))).alias("gone"))

    def forward(seen: Column, x: Column) -> Column:
        inside = F.get(seen.most, x.d.priority - 1) >= -x.d.back
        most = F.transform(seen.most, lambda v, i: F.when(i >= x.d.priority - 1, F.greatest(v, -x.d.back)).otherwise(v))
        return F.struct(most.alias("most"), F.when(inside | x.gone, seen.kept).otherwise(F.concat(seen.kept, F.array(x.d))).alias("kept"))

    spans = f"array<{SPAN}>"
    start = F.struct(F.array(*[F.lit(far)] * levels).alias("least"), F.array().cast(spans).alias("kept"), F.array().cast(spans).alias("gone"))
    # From the last start back; of one start the shortest first.
    turned = F.transform(F.sort_array(F.transform(found, lambda d: F.struct((-d.first).alias("f"), (-d.back).alias("l"), d.alias("d")))), lambda s: s.d)
    split = F.aggregate(turned, start, backward)
    marked = lambda items, flag: F.transform(items, lambda d: F.struct(d.alias("d"), F.lit(flag).alias("gone")))
    every = bound(split, lambda s: F.sort_array(F.concat(marked(s.kept, False), marked(s.gone, True))))
    begin = F.struct(F.array(*[F.lit(-1)] * levels).alias("most"), F.array().cast(spans).alias("kept"))
    return F.aggregate(every, begin, forward).kept


def _base(words: Column, base: Sequence[tuple[str, str]]) -> Column:
    """Per base phrase its label, number of places, first and last place."""

    def of(phrase: str, label: str) -> Column:
        # The places are found ahead, so phrases may share words; the mark in front keeps a place at the very start.
        parts = F.split(F.concat(F.lit("|"), words), F.concat(F.lit(f"(?= {phrase} )")), -1)
        there = bound(parts, lambda p: F.struct((F.size(p) - 1).cast("long").alias("n"), spaces(p[0]).cast("long").alias("first"), (spaces(words) - spaces(F.element_at(p, -1))).cast("long").alias("last")))
        none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last"))
        return F.struct(F.lit(label).alias("label"), F.when(F.contains(words, F.lit(f" {phrase} ")), there).otherwise(none).alias("at"))

    return F.array(*[of(p, x) for p, x in base])


def licenses(docs: DataFrame, keep: Sequence[str], text: str = "text", rule_list: Sequence[Rule] | None = None, base: Sequence[tuple[str, str]] = BASE) -> DataFrame:
    """Columns ``row`` (struct of ``keep``) and ``res``: words, base places and labels, detections, all labels, score.

    ``detections`` holds label, priority, and first and last (exclusive) word
    of what is left after nested ones are resolved. ``score`` is the certainty
    of the surest one, 0 without any. A null, empty or wordless text has no
    words and no labels. Rows are scanned one by one, so repeated rows agree.
    """
    rule_list = rules() if rule_list is None else rule_list
    if any(not 1 <= p <= len(CONFIDENCE) for _, p, _, _ in rule_list):
        raise ValueError("priorities go from 1 to 5")
    row = F.struct(*[col(c) for c in keep]).alias("row")

    def res(words: Column) -> Column:
        def judged(x: Column) -> Column:
            at = F.filter(x.base, lambda b: b["at"].n > 0)
            base_labels = F.array_sort(F.array_distinct(F.transform(at, lambda b: b.label)))
            labels = F.array_sort(F.array_distinct(F.concat(base_labels, F.transform(x.kept, lambda d: d.label))))
            sure = F.transform(x.kept, lambda d: F.element_at(F.array(*map(F.lit, CONFIDENCE)), d.priority))
            floor = F.when(F.size(at) > 0, F.lit(BASE_CONFIDENCE)).otherwise(F.lit(0.0))
            return F.struct(
                (spaces(words) - 1).cast("long").alias("n_words"),
                F.aggregate(at, F.lit(0).cast("long"), lambda n, b: n + b["at"].n).alias("n_base"),
                F.array_min(F.transform(at, lambda b: b["at"].first)).alias("first_word"),
                F.array_max(F.transform(at, lambda b: b["at"].last)).alias("last_word"),
                F.array_join(base_labels, ",").alias("base_labels"),
                F.array_join(labels, ",").alias("labels"),
                F.greatest(floor, F.coalesce(F.array_max(sure), F.lit(0.0))).alias("score"),
                F.transform(x.kept, lambda d: F.struct(d.label.alias("label"), d.priority.alias("priority"), d.first.alias("first"), (-d.back).alias("last"))).alias("detections"),
            )

        return bound(F.struct(_base(words, base).alias("base"), bound(_detections(words, rule_list), _settled).alias("kept")), judged)

    return docs.select(row, bound(word_stream(col(text)), res).alias("res"))


def op11_signature_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("row.doc_id", *[F.col("res")[c].alias(c) for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")])


QUERIES = {"op11_signature_rules": (op11_signature_rules, None)}
