"""Slug building and the two slug rules (lenient stored slugs, strict platform slugs)."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from orgmetrics.functions.text import strip

# Letters without a canonical decomposition and their ASCII spelling.
_SPELLINGS = {
    # Latin
    "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th",
    "ı": "i", "ħ": "h", "ŋ": "ng", "ĸ": "k", "ŧ": "t", "ə": "@",
    # Cyrillic
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z",
    "и": "i", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r",
    "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh",
    "щ": "shch", "ы": "y", "ь": "", "э": "e", "ю": "iu", "я": "ia", "ђ": "dj", "є": "ie",
    "і": "i", "ј": "j", "љ": "lj", "њ": "nj", "ћ": "tsh", "џ": "dz", "ґ": "g",
    # Greek
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th",
    "ι": "i", "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p",
    "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps",
    "ω": "o",
    # Kazakh and neighbours in Cyrillic
    "ә": "@", "ғ": "g", "қ": "k", "ң": "n", "ө": "o", "ұ": "u", "ү": "u", "һ": "h", "ҡ": "k",
    "ҙ": "z", "ҫ": "s", "ҳ": "h", "ҷ": "j",
    # Georgian
    "ა": "a", "ბ": "b", "გ": "g", "დ": "d", "ე": "e", "ვ": "v", "ზ": "z", "თ": "t`", "ი": "i",
    "კ": "k", "ლ": "l", "მ": "m", "ნ": "n", "ო": "o", "პ": "p", "ჟ": "zh", "რ": "r", "ს": "s",
    "ტ": "t", "უ": "u", "ფ": "p`", "ქ": "k`", "ღ": "g", "ყ": "q", "შ": "sh", "ჩ": "ch`",
    "ც": "ts`", "ძ": "dz", "წ": "ts", "ჭ": "ch", "ხ": "kh", "ჯ": "j", "ჰ": "h",
    # Armenian
    "ա": "a", "բ": "b", "գ": "g", "դ": "d", "ե": "e", "զ": "z", "է": "e", "ը": "e", "թ": "t`",
    "ժ": "zh", "ի": "i", "լ": "l", "խ": "kh", "ծ": "ts", "կ": "k", "հ": "h", "ձ": "dz", "ղ": "gh",
    "ճ": "ch", "մ": "m", "յ": "y", "ն": "n", "շ": "sh", "ո": "o", "չ": "ch`", "պ": "p", "ջ": "j",
    "ռ": "rh", "ս": "s", "վ": "v", "տ": "t", "ր": "r", "ց": "ts`", "ւ": "w", "փ": "p`", "ք": "k`",
    "օ": "o", "ֆ": "f", "և": "ew",
}

_ACCENTED_RANGES = ((0x00C0, 0x0250), (0x0370, 0x0400), (0x0400, 0x0500), (0x1E00, 0x2000))


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """(from, to) for ``translate`` and the letters that need more than one output letter."""
    single = {s: t for s, t in _SPELLINGS.items() if len(t) == 1}
    multiple = {s: t for s, t in _SPELLINGS.items() if len(t) != 1}
    for low, high in _ACCENTED_RANGES:
        for point in range(low, high):
            letter = chr(point)
            base = unicodedata.normalize("NFKD", letter).lower()
            base = "".join(x for x in base if not unicodedata.combining(x))
            if len(base) == 1 and letter not in _SPELLINGS and base != letter:
                single[letter] = single.get(base, base)
    # translate() drops letters that have no counterpart: the combining marks go last.
    marks = "".join(chr(p) for p in range(0x0300, 0x0370))
    return "".join(single) + marks, "".join(single.values()), multiple


def fold_accents(c: Column) -> Column:
    """Spell lower-case Latin, Cyrillic, Greek, Georgian and Armenian letters in ASCII."""
    source, target, multiple = _fold_tables()
    folded = F.translate(c, source, target)
    for script, rest in (((0, 0x530), r"[^\x00-\x7F]"), ((0x530, 0x10FFFF), r"[\u0530-\u10FF]")):
        spelled = folded
        for letter, spelling in multiple.items():
            if script[0] <= ord(letter) < script[1]:
                spelled = F.replace(spelled, F.lit(letter), F.lit(spelling))
        folded = F.when(c.rlike(rest), spelled).otherwise(folded)
    return F.when(c.rlike(r"[^\x00-\x7F]"), folded).otherwise(c)


def slugify(c: Column) -> Column:
    """ASCII letters and digits joined by single dashes."""
    text = F.lower(fold_accents(F.lower(c)))
    thousands = F.regexp_replace(text, r"(?<=\d),(?=\d)", "")
    text = F.when(text.contains(","), thousands).otherwise(text)
    text = F.regexp_replace(text, "[^a-z0-9]+", "-")
    return F.trim(text, F.lit("-"))


def activities_slug(name: Column, prefix: str) -> Column:
    """Slug of a section on the activities platform: its name, led by the network's prefix."""
    low = F.lower(name)
    led = F.when(low.startswith(prefix), low).otherwise(F.concat(F.lit(prefix + " "), low))
    return slugify(led)


def accounts_slug(name: Column, country_code: Column, prefix: str) -> Column:
    """``cc-city-uni`` from a name of two or more words, else ``cc-name``."""
    bare = F.regexp_replace(F.lower(name), rf"^\Q{prefix}\E\s+", "")
    words = F.split(strip(bare), r"\s+")
    two_words = F.concat_ws(
        "-",
        F.lower(country_code),
        F.substring(F.try_element_at(words, F.lit(1)), 1, 4),
        F.substring(F.try_element_at(words, F.lit(2)), 1, 3),
    )
    one_word = F.concat_ws("-", F.lower(country_code), bare)
    return slugify(F.when(F.size(words) >= 2, two_words).otherwise(one_word))


def activities_slug_valid(slug: Column, prefix: str) -> Column:
    rule = slug.rlike("^[a-z0-9-]+$") & slug.startswith(prefix + "-")
    return F.coalesce(rule & (F.length(slug) > len(prefix) + 1), F.lit(False))


def accounts_slug_valid(slug: Column, country_code: Column | None = None) -> Column:
    rule = slug.rlike("^[a-z0-9-]+$") & (F.size(F.split(slug, "-")) >= 3)
    if country_code is not None:
        no_code = country_code.isNull() | (country_code == "")
        rule = rule & (no_code | slug.startswith(F.lower(country_code)))
    return F.coalesce(rule, F.lit(False))


def normalize_slug(c: Column) -> Column:
    return F.lower(strip(c))


def lenient_slug_valid(c: Column) -> Column:
    """Letters and digits of any script once ``-`` and ``_`` are taken out."""
    core = F.translate(normalize_slug(c), "-_", "")
    return F.coalesce(core.rlike(r"^[\p{L}\p{N}]+$"), F.lit(False))
