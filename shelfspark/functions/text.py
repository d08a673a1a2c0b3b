"""Column expressions over strings, arrays and JSON variants of raw product records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Values that mean nothing (fixed values).
UNDEFINED = ("undefined", "unknown", "null", "none", "n/a", "na", "")
#: All characters that Unicode calls white space, and the separators that text tools count as such (fixed values).
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SHOUT = 0.80
DESCRIPTION_LENGTH = 600
IMAGE_BASE = "https://images.example.org/products"


def strip(x: Column) -> Column:
    """Without white space of any kind at either end; linear, however much of it lies inside."""
    return F.trim(x, F.lit(WHITE))


def present(x: Column) -> Column:
    """The stripped text, or null where it is null or blank."""
    return F.nullif(strip(x), F.lit(""))


def undefined_like(x: Column) -> Column:
    return F.coalesce(F.lower(strip(x)).isin(*UNDEFINED), F.lit(True))


def mostly_upper(x: Column, threshold: float = SHOUT) -> Column:
    """Whether that share of the letters is upper case; false without letters."""
    upper, letters = F.length(F.regexp_replace(x, r"\P{Lu}+", "")), F.length(F.regexp_replace(x, r"\P{L}+", ""))
    return (letters > 0) & (upper >= threshold * letters)


def deshout(x: Column) -> Column:
    """Stripped; in sentence case where it is mostly upper case."""
    low = F.lower(strip(x))
    return F.when(mostly_upper(x), F.concat(F.upper(F.substring(low, 1, 1)), F.substring(low, 2, 1 << 30))).otherwise(strip(x))


def gtin13(code: Column) -> Column:
    """Digits only, filled with zeros to 13; of longer codes the first 13."""
    return F.lpad(F.regexp_replace(code, "[^0-9]", ""), 13, "0")


def image_folder(code: Column) -> Column:
    return code_folder(gtin13(code))


def code_folder(c: Column) -> Column:
    """The folder of a code of 13 digits."""
    return F.concat_ws("/", F.substring(c, 1, 3), F.substring(c, 4, 3), F.substring(c, 7, 3), F.substring(c, 10, 4))


def image_resolution(sizes: Column) -> Column:
    """The best of the size keys at hand."""
    best = F.lit("full")
    for r in ("100", "200", "400"):
        best = F.when(F.array_contains(sizes, r), r).otherwise(best)
    return F.coalesce(best, F.lit("full"))


def image_url(code: Column, key: Column, rev: Column, imgid: Column, sizes: Column, raw_sizes: Column, base: str = IMAGE_BASE, folder: Column | None = None) -> Column:
    """A selected image by its revision, else the raw upload by its number; null without key, or without both."""
    head = F.concat(F.lit(base + "/"), image_folder(code) if folder is None else folder, F.lit("/"))
    selected = F.concat(head, key, F.lit("."), rev, F.lit("."), image_resolution(sizes), F.lit(".jpg"))
    raw = image_resolution(raw_sizes)
    plain = F.concat(head, imgid, F.when(raw == "full", "").otherwise(F.concat(F.lit("."), raw)), F.lit(".jpg"))
    return F.when(key.isNotNull() & present(code).isNotNull(), F.when(rev.isNotNull(), selected).otherwise(plain))


def front_key(keys: Column, prefer: str = "en", require: str | None = None) -> Column:
    """The image key to show: the required language's or none; else the preferred, any language's, or the plain one."""
    if require:
        return F.when(F.array_contains(keys, f"front_{require}"), f"front_{require}")
    other = F.get(F.filter(keys, lambda k: k.startswith("front_") & (F.length(k) == 8)), F.lit(0))
    plain = F.when(F.array_contains(keys, "front"), "front")
    return F.coalesce(F.when(F.array_contains(keys, f"front_{prefer}"), f"front_{prefer}"), other, plain)


def variant_text(v: Column) -> Column:
    """A variant if it is a string; other kinds count as absent."""
    return F.when(F.schema_of_variant(v) == "STRING", F.variant_get(v, "$", "string"))


def language_pick(candidates: list[tuple[Column, Column]], lang: Column, wanted: str) -> Column:
    """From (named, plain) pairs the first at hand, plain ones only if the record is in the wanted language; stripped."""
    return F.coalesce(*[c for named, plain in candidates for c in (present(named), F.when(lang == wanted, present(plain)))])


def language_title(named: Column, plain: Column, lang: Column, wanted: str) -> Column:
    """The wanted language's name, else the plain one if the record is in that language; de-shouted."""
    return deshout(language_pick([(named, plain)], lang, wanted))


def language_description(candidates: list[tuple[Column, Column]], lang: Column, wanted: str, most: int = DESCRIPTION_LENGTH) -> Column:
    """From (named, plain) pairs the first at hand: stripped, cut, de-shouted."""
    return deshout(F.substring(language_pick(candidates, lang, wanted), 1, most))


def describe(title: Column, text: Column) -> Column:
    """Title and text as sentences, without a double period."""
    t, d = strip(title), strip(text)
    return strip(F.concat(t, F.when(t.endswith("."), " ").otherwise(". "), d))


def clean_tags(tags: Column, prefix: str = "en:") -> Column:
    """Stripped and without prefix, blanks dropped, order and repeats kept; null if none is left."""
    kept = F.filter(F.transform(tags, strip), lambda t: t.isNotNull() & (t != ""))
    out = F.transform(kept, lambda t: F.regexp_replace(t, f"^{prefix}", ""))
    return F.when(F.size(out) > 0, out)


def general_number(x: Column) -> Column:
    """Six significant digits, no trailing zeros, an exponent from 1e6 up and under 1e-4."""
    mantissa = F.format_string("%.5e", x)
    power = F.regexp_extract(mantissa, r"e([+-]\d+)$", 1).cast("int")
    trimmed = lambda s: F.regexp_replace(F.regexp_replace(s, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    plain = x.cast("decimal(38,12)")
    fixed = F.lit("0")
    for p in range(-4, 6):
        fixed = F.when(power == p, trimmed(F.bround(plain, max(0, 5 - p)).cast("string"))).otherwise(fixed)
    scientific = F.concat(trimmed(F.regexp_extract(mantissa, r"^([^e]+)e", 1)), F.regexp_extract(mantissa, r"(e[+-]\d+)$", 1))
    return F.when(x == 0, "0").when((power < -4) | (power >= 6), scientific).otherwise(fixed)


def nutrient(x: Column, unit: Column) -> Column:
    return F.when(unit.isNotNull() & (unit != ""), F.concat(general_number(x), F.lit(" "), unit)).otherwise(general_number(x))


#: Flag, tags of the labels, and tags of the analysis that grant it (fixed values).
DIETARY = (
    ("gluten_free", ("en:gluten-free",), ()),
    ("halal", ("en:halal",), ()),
    ("kosher", ("en:kosher",), ()),
    ("lactose_free", ("en:lactose-free",), ()),
    ("organic", ("en:organic", "en:usda-organic"), ()),
    ("vegan", ("en:vegan",), ("en:vegan",)),
    ("vegetarian", ("en:vegetarian",), ("en:vegetarian",)),
)


def dietary(labels: Column, analysis: Column, rules=DIETARY) -> Column:
    """The granted flags, sorted."""
    none = F.array().cast("array<string>")
    has = lambda tags, wanted: F.arrays_overlap(F.coalesce(tags, none), F.array(*map(F.lit, wanted))) if wanted else F.lit(False)
    flags = [F.when(F.coalesce(has(labels, a), F.lit(False)) | F.coalesce(has(analysis, b), F.lit(False)), F.lit(flag)) for flag, a, b in sorted(rules)]
    # One string of the flags, which are put in order here, taken apart: lists need no pass of their own for nulls.
    joined = F.concat_ws("\n", *flags)
    return F.when(joined != "", F.split(joined, "\n")).otherwise(none)
