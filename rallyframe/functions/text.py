"""Names, slugs, whitespace, first-non-blank, stable ids."""

from __future__ import annotations

import json
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accent_tables() -> tuple[str, str, dict[str, str]]:
    """From the NFKD rules: characters with a one-letter ASCII base, then marks to drop; and those with a longer base."""
    source, target, marks, longer = [], [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        ch = chr(code)
        if unicodedata.combining(ch):
            marks.append(ch)
            continue
        full = unicodedata.normalize("NFKD", ch)
        base = "".join(c for c in full if not unicodedata.combining(c))
        if not base:
            marks.append(ch)
            continue
        if base == ch or not any(c.isascii() for c in base):
            continue
        if len(base) == 1:
            source.append(ch)
            target.append(base)
        else:
            longer[ch] = base
    return "".join(source + marks), "".join(target), longer


_FROM, _TO, _LONGER = _accent_tables()
_LONGER_JSON = json.dumps(_LONGER)


def strip_accents(c: Column) -> Column:
    """NFKD without combining marks, as far as letters, digits and signs of ASCII come out of it."""
    plain = F.translate(c, _FROM, _TO)
    table = F.from_json(F.lit(_LONGER_JSON), "map<string,string>")
    spelt = F.array_join(F.transform(F.split(plain, ""), lambda ch: F.coalesce(table[ch], ch)), "")
    has_longer = F.length(F.translate(plain, "".join(_LONGER), "")) < F.length(plain)
    return F.when(F.octet_length(c) == F.length(c), c).when(has_longer, spelt).otherwise(plain)  # ASCII texts stay as they are


def clean_ws(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"\s+", " "))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def first_nonempty(*cols: Column) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cols])


def normalize_name(c: Column, separator: str = " ") -> Column:
    """Accent-free lower case; runs of other characters become one separator."""
    base = F.lower(strip_accents(F.coalesce(c, F.lit(""))))
    spaced = F.trim(F.regexp_replace(base, "[^a-z0-9]+", " "))
    return spaced if separator == " " else F.replace(spaced, F.lit(" "), F.lit(separator))


def normalize_event_name(c: Column) -> Column:
    """Underscore form; ampersand reads as a word."""
    return normalize_name(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit(" and ")), "_")


def normalize_name_keep_apostrophe(c: Column) -> Column:
    base = F.lower(strip_accents(F.coalesce(c, F.lit(""))))
    return F.trim(F.regexp_replace(F.regexp_replace(base, "[^a-z0-9' ]+", " "), r"\s+", " "))


def slug(c: Column) -> Column:
    """ASCII slug: letters without an ASCII base vanish instead of splitting."""
    ascii_only = F.regexp_replace(strip_accents(F.lower(clean_ws(c))), r"[^\x00-\x7F]", "")
    dashed = F.regexp_replace(F.regexp_replace(ascii_only, "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.coalesce(F.nullif(dashed, F.lit("")), F.lit("unknown"))


def tokens(name: Column) -> Column:
    """Tokens of a normalised name."""
    return F.array_remove(F.split(name, " "), "")


# fixed values: two-word surname particles
PARTICLES = ("de", "del", "de la", "da", "di", "van", "von", "la", "le", "du", "dos", "das")


def name_features(name: Column) -> dict[str, Column]:
    """Blocking and scoring features of a raw name."""
    return norm_features(normalize_name(name))


def norm_features(norm: Column, words: Column | None = None) -> dict[str, Column]:
    """The same features from a name that is normalised already, and from its tokens if they are known."""
    ts = tokens(norm) if words is None else words
    n = F.size(ts)
    last = F.when(n > 0, F.element_at(ts, -1)).otherwise("")
    last_two = F.when(n > 1, F.concat_ws(" ", F.element_at(ts, F.lit(-2)), F.element_at(ts, F.lit(-1))))
    initial = F.when(n > 0, F.substring(F.element_at(ts, 1), 1, 1)).otherwise("")
    return {
        "norm": norm,
        "toks": ts,
        "last": last,
        "surname": F.when(last_two.isin(*PARTICLES), last_two).otherwise(last),
        "initial": initial,
        "compact": F.when(n == 0, "").when(n == 1, last).otherwise(
            F.concat(initial, F.lit(" "), F.array_join(F.slice(ts, F.lit(2), F.greatest(n - 1, F.lit(0))), " "))),
        "token_key": F.array_join(F.sort_array(ts), " "),
        "all_initials": F.array_join(F.transform(ts, lambda t: F.substring(t, 1, 1)), ""),
        "one_letter": F.array_join(F.filter(ts, lambda t: t.rlike("^[a-z]$")), " "),
    }


def family_name(name: Column) -> Column:
    """Last token longer than one character."""
    long_tokens = F.filter(tokens(normalize_name(name)), lambda t: F.length(t) > 1)
    return F.when(F.size(long_tokens) > 0, F.element_at(long_tokens, -1)).otherwise("")


def token_jaccard(a: Column, b: Column) -> Column:
    """Set overlap of two token arrays."""
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(
        F.size(F.array_intersect(a, b)) / union)


def sha_id(length: int, *parts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, length)


def md5_id(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *parts))
