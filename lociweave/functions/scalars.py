"""Scalar column expressions: parsing, score formulas, name and identifier cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens read as missing, per table family.
MISSING_DE = ("na", "nan", "inf", "-inf")
MISSING_SEGMENT = ("na", "nan", "none", "null", "inf", "-inf")
MISSING_CALORIMETRY = ("", "na", "nan", "none", "null")

# Gene-name patterns left out by default (matched case-insensitively).
DEFAULT_EXCLUDE_PATTERNS = ("^MT-", "^RPL", "^RPS")

ENSEMBL_LIKE = r"^ENS[A-Z]*G[0-9]+(?:\.[0-9]+)?$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean(x) -> Column:
    """Trimmed text; blank becomes null."""
    return F.nullif(F.trim(_c(x).cast("string")), F.lit(""))


def soft_double(x, missing: Sequence[str] = MISSING_DE) -> Column:
    """Number or null: blank, missing tokens, unparseable and non-finite text are null."""
    text = clean(x)
    value = F.when(~F.lower(text).isin(*missing), text.try_cast("double"))
    return F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)


def transform_score(x, mode: str) -> Column:
    x = _c(x)
    zero = F.lit(0.0)
    choices = {
        "signed": lambda: x,
        "abs": lambda: F.abs(x),
        "positive": lambda: F.greatest(x, zero),
        "negative": lambda: F.greatest(-x, zero),
    }
    if mode not in choices:
        raise ValueError(f"unknown transform {mode!r}")
    return choices[mode]()


def significant(x, digits: int = 12) -> Column:
    """Rounded to so many significant digits: sums of the same numbers in another order become equal."""
    x = _c(x)
    unit = F.pow(F.lit(10.0), F.lit(float(digits)) - F.ceil(F.log10(F.abs(x))))
    return F.when(x == 0, x).otherwise(F.round(x * unit) / unit)


def neglog10_clamped(p, eps: float = 1e-300, cap: float = 50.0) -> Column:
    """-log10 with p clamped to [eps, 1] and eps added again; used by DE and methylation scores."""
    q = F.least(F.lit(1.0), F.greatest(F.lit(eps), _c(p)))
    return F.least(-F.log10(q + F.lit(eps)), F.lit(cap))


def neglog10_floor(p, eps: float = 1e-300, cap: float = 50.0) -> Column:
    """-log10(max(p, eps)) capped; p above 1 turns negative. Used by site and event scores."""
    return F.least(-F.log10(F.greatest(_c(p), F.lit(eps))), F.lit(cap))


def signed_by(magnitude: Column, sign_source) -> Column:
    """Magnitude with the sign of the source; a zero or null source gives null."""
    s = _c(sign_source)
    return F.when(s > 0, magnitude).when(s < 0, -magnitude)


def effect_times_p(effect, p, eps: float = 1e-300, cap: float = 50.0, clamped: bool = True) -> Column:
    return _c(effect) * (neglog10_clamped if clamped else neglog10_floor)(p, eps, cap)


def signed_log1p(x) -> Column:
    x = _c(x)
    return F.signum(x) * F.log1p(F.abs(x))


def log2_ratio(a, b, pseudocount: float = 1.0) -> Column:
    return F.log2((_c(a) + pseudocount) / (_c(b) + pseudocount))


def strip_version(x) -> Column:
    return F.split_part(_c(x), F.lit("."), F.lit(1))


def ensembl_like(x) -> Column:
    return F.coalesce(F.trim(_c(x)).rlike(ENSEMBL_LIKE), F.lit(False))


def set_name(x) -> Column:
    """Gene-set name: blanks and slashes to underscore, other odd characters dropped."""
    s = F.regexp_replace(F.trim(_c(x)), r"\s+", "_")
    s = F.regexp_replace(s, r"[/\\]", "_")
    s = F.regexp_replace(s, r"[^A-Za-z0-9_.=:-]", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("geneset"))


def path_component(x) -> Column:
    s = F.regexp_replace(F.trim(F.coalesce(_c(x), F.lit(""))), r"\s+", "_")
    s = F.regexp_replace(s, r"[^A-Za-z0-9._=-]+", "_")
    s = F.regexp_replace(s, r"^_+|_+$", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("na"))


def matches_any(columns: Sequence[str], patterns: Sequence[str]) -> Column:
    """Does any column match any pattern, ignoring case? Null columns do not match."""
    hit = F.lit(False)
    for c in columns:
        for p in patterns:
            hit = hit | F.coalesce(F.col(c).rlike(f"(?i){p}"), F.lit(False))
    return hit


def biotype_allowed(x, allowed: Sequence[str]) -> Column:
    """Missing biotypes pass."""
    b = F.lower(clean(x))
    return b.isNull() | b.isin(*[a.lower() for a in allowed])


def chrom_prefix(x, mode: str) -> Column:
    x = _c(x)
    if mode == "add_chr":
        return F.when(x.startswith("chr"), x).otherwise(F.concat(F.lit("chr"), x))
    if mode == "drop_chr":
        return F.regexp_replace(x, "^chr", "")
    return x


def boolish(x) -> Column:
    return F.lower(clean(x)).isin("1", "true", "t", "yes", "y")


def packed_tokens(x, delimiters: str = ";,|/") -> Column:
    """Split delimiter-packed text, trim the tokens and drop blanks."""
    pattern = r"\s*[" + "".join("\\" + d for d in delimiters) + r"]\s*"
    return F.array_remove(F.split(F.trim(F.coalesce(_c(x), F.lit(""))), pattern), "")


def site_key(accession, residue, position, ptm_type, site_id=None, site_group=None) -> Column:
    """accession|residue|position|type, else site id (or group) and type, else null."""
    acc, res, pos = clean(accession), clean(residue), clean(position)
    kind = _c(ptm_type)
    full = F.when(acc.isNotNull() & res.isNotNull() & pos.isNotNull(), F.concat_ws("|", acc, res, pos, kind))
    alts = [F.when(clean(a).isNotNull(), F.concat_ws("|", clean(a), kind)) for a in (site_id, site_group) if a is not None]
    return F.coalesce(full, *alts)


def tcga_arm(barcode) -> Column:
    """Sample-type digits of a TCGA barcode: 01-09 tumor, 10-19 adjacent normal, like a `_Norm` suffix."""
    b = _c(barcode)
    code = F.regexp_extract(b, r"^TCGA-[^-]+-[^-]+-(\d{2})", 1).try_cast("int")
    return F.when(b.endswith("_Norm"), F.lit("adjacent_normal")).when(code.between(1, 9), F.lit("tumor")).when(
        code.between(10, 19), F.lit("adjacent_normal")
    )


def in_light(hour, lights_on: float = 7.0, hours_light: float = 12.0) -> Column:
    return F.pmod(_c(hour) - F.lit(lights_on), F.lit(24.0)) < F.lit(hours_light)


def params_id(*columns) -> Column:
    """Stable identifier of a set of parameter columns."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def parse_time(x) -> Column:
    """Timestamp from the accepted spellings; null when none fits."""
    # Accepted timestamp formats.
    formats = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss")
    t = F.trim(_c(x))
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in formats], F.try_to_timestamp(t))


def response_sign(metric: str) -> float:
    """Orientation that makes larger mean more sensitive."""
    return -1.0 if metric in ("logfc", "auc", "ic50") else 1.0
