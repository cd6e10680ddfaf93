"""Text clean-up, list clean-up and small text-to-number rules."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything a Unicode-aware split on whitespace treats as a blank.
_BLANKS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    chr(p) for p in range(0x2000, 0x200B)
)
BLANK = f"[{_BLANKS}]"
# Runs of blanks that are not one plain space already: most blanks of a text need no change.
_UNEVEN = f" {BLANK}+|[{_BLANKS.replace(' ', '')}]{BLANK}*"


def strip(c: Column) -> Column:
    """Drop leading and trailing blanks, Unicode blanks included."""
    return F.btrim(c, F.lit(_BLANKS))


def normalize_text(c: Column) -> Column:
    """Collapse runs of blanks to one space and trim."""
    return F.trim(F.regexp_replace(c, _UNEVEN, " "))


def normalize_country_code(c: Column) -> Column:
    return F.upper(strip(c))


def country_code_valid(c: Column, longest: int = 3) -> Column:
    """Two letters, or up to ``longest``; judged on the normalised code."""
    return F.coalesce(normalize_country_code(c).rlike(rf"^\p{{L}}{{2,{longest}}}$"), F.lit(False))


@lru_cache(maxsize=1)
def _other_digits() -> tuple[str, str]:
    """Decimal digits of other scripts, and their ASCII digits."""
    found = [chr(p) for p in range(0x80, 0x10000) if unicodedata.category(chr(p)) == "Nd"]
    return "".join(found), "".join(str(unicodedata.digit(d)) for d in found)


def digits_to_int(c: Column) -> Column:
    """Keep the digits and read them as a number; no digits give 0.

    A number beyond the type becomes its largest value, so that range rules still reject it.
    """
    digits = F.regexp_replace(c, r"[^\p{Nd}]", "")
    digits = F.when(digits.rlike("^[0-9]*$"), digits).otherwise(F.translate(digits, *_other_digits()))
    number = F.coalesce(digits.try_cast("int"), F.lit(2**31 - 1))
    return F.when(digits != "", number).otherwise(0)


def nonempty(c: Column) -> Column:
    return F.when(c != "", c)


def clean_list(c: Column) -> Column:
    """Trim items, drop empty ones, keep the first of equals; NULL becomes an empty array."""
    items = F.filter(F.transform(c, strip), lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(F.array_distinct(items), F.array().cast("array<string>"))


def join_nonempty(c: Column, separator: str) -> Column:
    """Join the non-empty trimmed items of an array."""
    return F.array_join(F.filter(F.transform(c, strip), lambda x: x != ""), separator)


def sdg_numbers(texts: Column) -> Column:
    """Goal numbers named in texts such as ``SDG 3`` or ``Goal 3``: 1..17, sorted, distinct."""
    numbers = F.transform(
        texts, lambda t: F.regexp_extract(t, r"(?i)(?:Goal|SDG)\s+(\d+)", 1).try_cast("int")
    )
    return F.array_sort(F.array_distinct(F.filter(numbers, lambda n: n.between(1, 17))))


def sdg_list(c: Column) -> Column:
    """Items as numbers, first of equals kept."""
    return F.array_distinct(F.transform(c, lambda x: x.try_cast("int")))


def sdg_list_valid(c: Column) -> Column:
    """True when every item reads as a number from 1 to 17 (also for NULL or empty)."""
    bad = F.exists(
        F.transform(c, lambda x: x.try_cast("int")), lambda n: n.isNull() | ~n.between(1, 17)
    )
    return ~F.coalesce(bad, F.lit(False))


def social_platform(title: Column) -> Column:
    """``Facebook profile`` -> ``facebook``; a title without the word gives NULL."""
    low = F.lower(title)
    return F.when(low.contains("profile"), nonempty(strip(F.replace(low, F.lit("profile")))))


def map_to_json(c: Column) -> Column:
    return F.to_json(c)


def json_to_map(c: Column) -> Column:
    return F.from_json(c, "map<string,string>")


# A match begins where its word begins and gives nothing back, so long words cost no more than short ones.
_EMAIL_IN_TEXT = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"


def mask_emails(c: Column, mask: str = "[email]") -> Column:
    """Replace every e-mail address inside a free text."""
    return F.regexp_replace(c, _EMAIL_IN_TEXT, mask)


def mask_identity(c: Column) -> Column:
    """One-way digest of a personal field, so equal values still join."""
    return F.sha2(c, 256)
