"""Review text as Column expressions: normalise, tokenise, find keywords."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once per row, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def _plain_letters() -> tuple[str, str]:
    """Lower-case letters of the Latin blocks that decompose to one letter and marks, and those letters."""
    accented, plain = [], []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c))
        if letter == letter.lower() and base != letter and len(base) == 1:
            accented.append(letter)
            plain.append(base)
    return "".join(accented), "".join(plain)


ACCENTED, PLAIN = _plain_letters()
MARKS = r"\p{Mn}"


def normalise(text: Column | str) -> Column:
    """Lower case without accents; combining marks are dropped as well."""
    text = F.col(text) if isinstance(text, str) else text
    low = F.lower(text)
    plain = F.regexp_replace(F.translate(low, ACCENTED, PLAIN), MARKS, "")
    # Most texts are ASCII and need no second and third pass.
    return F.when(low.rlike(r"[^\x00-\x7F]"), plain).otherwise(low)


def has_text(text: Column | str) -> Column:
    """True when the normalised text is not empty; looks at the first letters only."""
    text = F.col(text) if isinstance(text, str) else text
    return text.rlike(r"[^\p{Mn}]")


def words(text: Column | str) -> Column:
    """Runs of letters, digits and underscores of the normalised text, in order."""
    return F.split(normalise(text), r"[^\p{L}\p{N}_]+")


def is_token(word: Column, stop_words: Iterable[str] = ()) -> Column:
    """Three or more letters a-z and no stop word; 'abc1' is no token."""
    stop = sorted(set(stop_words))
    good = word.rlike("^[a-z]{3,}$")
    return good & ~word.isin(stop) if stop else good


def tokens(text: Column | str, stop_words: Iterable[str] = ()) -> Column:
    """Tokens of the text in order, repeats kept."""
    return F.filter(words(text), lambda word: is_token(word, stop_words))


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """True when any of the words occurs in the text as a substring."""
    found = F.lit(False)
    for word in words:
        found = found | text.contains(word)
    return found


def matched(text: Column, words: Iterable[str]) -> Column:
    """Array of the words that occur in the text."""
    return F.array_compact(F.array(*[F.when(text.contains(w), F.lit(w)) for w in words]))
