"""Letters without accents, by tables that Python's Unicode data give once and Spark's own functions apply."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable
from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hangul syllables are put together of so many leading, middle and closing letters, by arithmetic; fixed values.
SYLLABLES, LEADS, VOWELS, TAILS = 0xAC00, 19, 21, 28
FIRST_LEAD, FIRST_VOWEL, BEFORE_TAILS = 0x1100, 0x1161, 0x11A7


class Folding(NamedTuple):
    """one: characters that become another one, and what; gone: characters that go; more: characters that become several."""

    one: str
    to: str
    gone: str
    more: dict[str, str]


def folded(text: str, compatible: bool) -> str:
    """What the tables are made of: a text taken apart, without the marks that combine."""
    if compatible:
        return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")


@lru_cache
def folding(compatible: bool) -> Folding:
    one, to, gone, more = [], [], [], {}
    last = SYLLABLES + LEADS * VOWELS * TAILS
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF or SYLLABLES <= code < last:
            continue
        c = chr(code)
        if (x := folded(c, compatible)) != c:
            if len(x) == 1:
                one.append(c)
                to.append(x)
            elif x:
                more[c] = x
            else:
                gone.append(c)
    return Folding("".join(one), "".join(to), "".join(gone), more)


def char_class(chars: Iterable[str]) -> str:
    """A class of a regular expression for some characters."""
    codes = sorted(map(ord, chars))
    starts = [c for c, before in zip(codes, [-2, *codes]) if c != before + 1]
    ends = [c for c, after in zip(codes, [*codes[1:], -2]) if c + 1 != after]
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(starts, ends)) + "]"


def letter(place: Column, first: int, count: int) -> Column:
    return F.substring(F.lit("".join(chr(first + i) for i in range(count))), place + 1, F.lit(1))


def several(c: Column, more: dict[str, str]) -> Column:
    """What a character becomes that is a syllable or in a table."""
    place = F.ascii(c) - SYLLABLES
    syllable = F.concat(letter(F.call_function("div", place, F.lit(VOWELS * TAILS)).cast("int"), FIRST_LEAD, LEADS), letter(F.call_function("div", place % (VOWELS * TAILS), F.lit(TAILS)).cast("int"), FIRST_VOWEL, VOWELS))
    tail = place % TAILS
    whole = F.concat(syllable, F.when(tail > 0, letter(tail - 1, BEFORE_TAILS + 1, TAILS - 1)).otherwise(""))
    table = F.map_from_arrays(F.array(*map(F.lit, more)), F.array(*map(F.lit, more.values())))
    return F.when((place >= 0) & (place < LEADS * VOWELS * TAILS), whole).when(c.rlike(char_class(more)), table[c]).otherwise(c)


def fold(c: Column, compatible: bool = True) -> Column:
    """Letters without their accents. A text of ASCII alone stays as it is; characters that become several are looked up one by
    one, in texts that have any. Marks that combine go wherever they stand."""
    t = folding(compatible)
    single = F.translate(c, t.one + t.gone, t.to)
    rare = char_class([*t.more, *map(chr, range(SYLLABLES, SYLLABLES + LEADS * VOWELS * TAILS))])
    apart = F.array_join(F.transform(F.regexp_extract_all(single, F.lit("(?s)."), F.lit(0)), lambda x: several(x, t.more)), "")
    return F.when(~c.rlike("[^\\x00-\\x7F]"), c).when(single.rlike(rare), apart).otherwise(single)
