"""Names, counties and display texts as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes that end the part of a company name that is grouped on.
AIRPORTS = ("LAX", "SFO", "SNA", "SJC", "OAK", "SAN", "BUR", "LGB", "SMF", "ONT", "SCK", "FAT", "MRY", "SBS", "SCZ")


# White space of any script.
WHITE_SPACE = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(x: Column) -> Column:
    """Without white space of any script at both ends; plain ``trim`` takes blanks only."""
    return F.btrim(x, F.lit(WHITE_SPACE))


def _visible(x: Column) -> Column:
    """Whether a text begins with an ASCII character that is no white space; false if it is empty."""
    return (x >= "!") & (x < "\x80")


def strip_cell(x: Column) -> Column:
    """As ``strip``, for columns that are cheap to read: texts that begin and end with plain characters are not searched."""
    return F.when(_visible(x) & _visible(F.right(x, F.lit(1))), x).otherwise(strip(x))


def _entities(x: Column, nbsp: bool) -> Column:
    plain = strip(x)
    decoded = F.regexp_replace(F.regexp_replace(plain, "(?i)&rsquo;", "'"), "(?i)&amp;", "&")
    if nbsp:
        decoded = F.regexp_replace(decoded, "(?i)&nbsp;", " ")
    # most names have no entity and single blanks only, and are spared the patterns; that is seen on the text as it came, since
    # every mention of the stripped one strips it again
    fixed = F.when(x.contains("&"), decoded).otherwise(plain)
    foreign = F.octet_length(x) != F.char_length(x)
    wide = foreign | x.contains("&") | x.startswith(" ") | x.endswith(" ")
    for space in ("  ", "\t", "\n", "\x0b", "\f", "\r"):
        wide = wide | x.contains(space)
    # the short pattern finds the same white space in ASCII, and only where something changes
    single = F.when(foreign, F.regexp_replace(fixed, r"(?U)\s+", " ")).otherwise(F.regexp_replace(fixed, r" \s+|[\t-\r]\s*", " "))
    return F.when(wide, single).otherwise(x)


def fix_company(x: Column, word_boundary: bool = False) -> Column:
    """Entities, white space and one brand name in names from spreadsheets.

    The brand rule rewrites any name that contains its letters; ``word_boundary`` confines it to whole words.
    """
    brand = r"(?i)\bju+l+\b" if word_boundary else "(?i)ju+l+"
    named = F.lower(x).contains("ju") & x.rlike(brand)  # on the text as it came: entities hold no such letters
    return F.when(named, F.lit("Juul Labs, Inc.")).otherwise(_entities(x, nbsp=True))


def fix_company_pdf(x: Column) -> Column:
    """Entities and white space in names from page tables; a missing cell reads ``None``."""
    return _entities(F.coalesce(x, F.lit("None")), nbsp=False)


# Spellings of the brand that the newer of the older sheets knows.
LEGACY_BRAND = ("JUUL", "Juul", "JUUl")


def fix_company_legacy(x: Column, brand: bool = False) -> Column:
    """First and last part around a right quote; other parts are lost.  With ``brand`` other names that hold its letters become its."""
    parts = F.split(x, "&rsquo;")
    joined = F.concat(F.element_at(parts, 1), F.lit("'"), F.element_at(parts, -1))
    fixed = F.when(F.size(parts) > 1, joined)
    if brand:
        held = F.lit(False)
        for spelling in LEGACY_BRAND:
            held = held | x.contains(spelling)
        fixed = fixed.when(held, F.lit("Juul Labs, Inc."))
    return fixed.otherwise(x)


def company_group(x: Column) -> Column:
    """The name that charts group on: cut at an airport code, without a number in parentheses, one name for one big brand."""
    cut = F.element_at(F.split(strip(x), rf"(?i)\s+({'|'.join(AIRPORTS)})\s*\d*", 2), 1)
    bare = strip(F.regexp_replace(cut, r"\s+\(\d+\)\s*$", ""))
    return F.when(bare.contains("Amazon"), F.lit("Amazon")).otherwise(bare)


def county_short(x: Column) -> Column:
    """Without a final ``County`` or ``Parish``."""
    return strip(F.regexp_replace(x, r"\s*(County|Parish)\s*$", ""))


def county_label(x: Column) -> Column:
    """Without `` County`` and `` Parish`` wherever they stand."""
    return strip(F.replace(F.replace(x, F.lit(" County"), F.lit("")), F.lit(" Parish"), F.lit("")))


def escape(x: Column) -> Column:
    """Angle brackets for HTML, nothing else."""
    return F.replace(F.replace(x, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def thousands(x: Column) -> Column:
    """A whole number with thousands separators; other texts as they are."""
    text = x.cast("string")
    return F.coalesce(F.format_number(text.try_cast("bigint"), 0), text)


def signed(x: Column) -> Column:
    return F.concat(F.when(x >= 0, F.lit("+")).otherwise(F.lit("")), F.format_number(x, 0))


def plural(n: Column, word: str) -> Column:
    return F.concat(F.lit(word), F.when(n > 1, F.lit("s")).otherwise(F.lit("")))


def number_first(x: Column) -> Column:
    """The number that a text begins with, as a browser's parseFloat reads it; null if there is none."""
    return F.regexp_extract(x, r"^\s*([-+]?\d+\.?\d*)", 1).try_cast("double")
