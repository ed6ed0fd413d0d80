"""Text functions as column expressions. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataloom import ontology as o

UNIT = "\x1f"


def strip(c: Column) -> Column:
    """Without white space (Unicode's) at either end; ``trim`` only takes blanks."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def clean_text(c: Column) -> Column:
    """NUL and the scale token 12345 become blanks, white space is collapsed."""
    return squeeze(F.regexp_replace(F.regexp_replace(c, "\\x00", " "), r"\b12345\b", " "))


def strip_markup(c: Column) -> Column:
    """Without comments and tags, white space collapsed; null becomes ''."""
    return F.coalesce(squeeze(F.regexp_replace(F.regexp_replace(c, r"(?s)<!--.*?-->|<[^>]+>", " "), r"\x00", " ")), F.lit(""))


def speech_length(c: Column) -> Column:
    """Characters of speech, without a [tag] at the head of each line."""
    return F.length(strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?mdU)^\[[^\]]*\]\s*", "")))


def title_case(c: Column) -> Column:
    """Upper case for each letter that follows no letter, lower case for the others (so 3d is 3D, which initcap leaves)."""
    parted = F.regexp_replace(F.lower(c), r"(?<=[^\p{Lu}\p{Ll}\p{Lt}])(?=[\p{Lu}\p{Ll}\p{Lt}])", "\x01 ")
    return F.regexp_replace(F.initcap(parted), "\x01 ", "")


def normalize(c: Column) -> Column:
    """Punctuation of a fixed set (not | + = `) and white space, each as one blank."""
    return F.regexp_replace(c, r"""(?U)[.,;:!?@#$%^&*()\-_\[\]{}<>/\\'"~\s]""", " ")


def canonical_id(c: Column) -> Column:
    return title_case(squeeze(normalize(c)))


def relation_name(c: Column) -> Column:
    return F.replace(F.lower(strip(F.coalesce(c, F.lit("")))), F.lit(" "), F.lit("_"))


def property_key(c: Column) -> Column:
    """camelCase of the words; a text without words stays."""
    words = F.filter(F.split(strip(c), r"(?U)\s+"), lambda w: w != "")
    tail = F.transform(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2)))))
    return F.when(F.size(words) == 0, c).otherwise(F.concat(F.lower(F.element_at(words, 1)), F.array_join(tail, "")))


def parse_year(c: Column) -> Column:
    """A year from 1900 to 2100: of the ROC calendar if so marked (+1911), else the first 19xx or 20xx."""
    han = F.regexp_extract(c, rf"民國(?U)\s*([0-9{o.DIGITS_HAN}]+)\s*年", 1)
    one_kind = han.rlike(rf"^([0-9]+|[{o.DIGITS_HAN}]+)$")
    roc = F.when(one_kind, F.translate(han, o.DIGITS_HAN, "00123456789").try_cast("int") + 1911)
    plain = F.nullif(F.regexp_extract(c, r"\b((?:19|20)\d{2})\b", 1), F.lit("")).try_cast("int")
    year = F.when(han != "", roc).otherwise(plain)
    return F.when(year.between(*o.YEARS), year)


def meeting_id_parts(c: Column) -> Column:
    """struct(date, series) of <slug>-YYYYMMDD-HHMMSS..., by the earliest such date; nulls if there is none."""
    pattern = r"^(.+?)-(20\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01]))-\d{6}"
    day = F.regexp_extract(c, pattern, 2)
    date = F.when(day != "", F.concat_ws("-", F.substring(day, 1, 4), F.substring(day, 5, 2), F.substring(day, 7, 2)))
    return F.struct(date.alias("date"), F.when(day != "", F.regexp_extract(c, pattern, 1)).alias("series"))


def has_reporting_verb(c: Column) -> Column:
    return c.rlike(r"(?i)\b(" + "|".join(o.REPORTING_VERBS) + r")\b")


def is_fragment_topic(canonical: Column) -> Column:
    """A bare label such as 'Table 3' or 'Fig A'."""
    return canonical.rlike("(?i)^(" + "|".join(o.FRAGMENT_WORDS) + r")(\s+([0-9]+[A-Za-z]?|[A-Za-z]))+$")


def pair_key(a: Column, b: Column) -> Column:
    return F.sha1(F.concat(F.least(a, b), F.lit(UNIT), F.greatest(a, b)))


def participants_hash(ids: Column) -> Column:
    return F.sha1(F.array_join(F.array_sort(ids), UNIT))


def cache_key(*parts: Column | str) -> Column:
    """SHA-1 over the parts, each followed by the unit separator."""
    cols = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha1(F.concat(*(x for c in cols for x in (c, F.lit(UNIT)))))


def salvage_json(c: Column, schema: str) -> Column:
    """A struct from the outermost {...} of a model's reply, code fences removed; null if it doesn't parse."""
    body = F.regexp_extract(F.regexp_replace(c, r"```[a-zA-Z]*", ""), r"(?s)\{.*\}", 0)
    return F.when(F.coalesce(body, F.lit("")) != "", F.from_json(body, schema))
