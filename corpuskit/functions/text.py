"""Column expressions over text.  All are stateless, so they also work on streams."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space class of Python's ``\s`` and ``str.strip``,
# spelled out because Java's ``\s`` is ASCII only.
WS = (
    r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
CHUNK_PATTERN = f"([^{WS}]+|[{WS}]+)"
WORD_PATTERN = f"[^{WS}]+"
EDGE_PATTERN = f"^[{WS}]+|[{WS}]+$"
LETTERS_PATTERN = r"^\p{L}+$"
SPACE_MARK = "▁"
WORDPIECE_PREFIX = "##"
MAX_SUBWORD = 16
THINKING_PATTERNS = (
    "(?s)<think>.*?</think>",
    "(?s)<thinking>.*?</thinking>",
    "(?s)<reasoning>.*?</reasoning>",
)


def no_strings() -> Column:
    return F.array().cast("array<string>")


def chunks(text: Column) -> Column:
    """Alternating words and white space runs; joined together they give the text back."""
    return F.regexp_extract_all(text, F.lit(CHUNK_PATTERN), F.lit(1))


def words(text: Column) -> Column:
    """Words between white space.  Splitting costs half of matching the words one by one."""
    return F.array_remove(F.split(text, f"[{WS}]+"), "")


# The same cuts inside Arrow batches: Python's own white space is the class above.
_CHUNK, _CUT = re.compile(r"\s+|\S+"), re.compile(r"\s(?=\S)")


def split_chunks(text: str) -> list[str]:
    return _CHUNK.findall(text)


def split_words(text: str) -> list[str]:
    return text.split()


def split_marked(text: str) -> list[str]:
    return [SPACE_MARK + word for word in text.split()]


def pieces(text: str, size: int) -> Iterator[str]:
    """A text cut before words, about every ``size`` characters."""
    start = 0
    while len(text) - start > size and (cut := _CUT.search(text, start + size)):
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:]


def strip(text: Column) -> Column:
    """Drop white space at both ends."""
    return F.regexp_replace(text, F.lit(EDGE_PATTERN), F.lit(""))


def letter_words(text: Column) -> Column:
    """Lowercased words made of letters only; a word with punctuation is dropped whole."""
    return F.transform(
        F.filter(words(text), lambda w: F.rlike(w, F.lit(LETTERS_PATTERN))), F.lower
    )


def characters(word: Column) -> Column:
    """Code points of a string as an array."""
    return F.when(F.length(word) > 0, F.split(word, "")).otherwise(no_strings())


def wordpiece_characters(word: Column, prefix: str = WORDPIECE_PREFIX) -> Column:
    """First character bare, the rest with the continuation prefix."""
    return F.transform(
        characters(word), lambda c, i: F.when(i == 0, c).otherwise(F.concat(F.lit(prefix), c))
    )


def substrings(word: Column, max_len: int = MAX_SUBWORD) -> Column:
    """All substrings of at most ``max_len`` characters, with repetition."""
    n = F.length(word)

    def from_start(i: Column) -> Column:
        sizes = F.sequence(F.lit(1), F.least(F.lit(max_len), n - i + 1))
        return F.transform(sizes, lambda size: F.substring(word, i, size))

    return F.when(
        n > 0, F.flatten(F.transform(F.sequence(F.lit(1), n), from_start))
    ).otherwise(no_strings())


def mark_spaces(text: Column, add_prefix: bool = True) -> Column:
    """Blank becomes the visible space mark; the text starts with one."""
    marked = F.replace(text, F.lit(" "), F.lit(SPACE_MARK))
    if not add_prefix:
        return marked
    return F.when(F.startswith(marked, F.lit(SPACE_MARK)), marked).otherwise(
        F.concat(F.lit(SPACE_MARK), marked)
    )


def unmark_spaces(text: Column) -> Column:
    """Space marks become blanks; white space at the ends goes."""
    return strip(F.replace(text, F.lit(SPACE_MARK), F.lit(" ")))


def remove_thinking(text: Column) -> Column:
    """Cut tagged reasoning blocks, then strip."""
    for pattern in THINKING_PATTERNS:
        text = F.regexp_replace(text, F.lit(pattern), F.lit(""))
    return strip(text)


def fill_template(template: str, **values: Column) -> Column:
    """Fill ``{name}`` places of a template with columns; inserted text is not scanned again."""
    parts: list[Column] = []
    rest = template
    while rest:
        places = [(rest.find("{" + name + "}"), name) for name in values]
        places = [place for place in places if place[0] >= 0]
        if not places:
            parts.append(F.lit(rest))
            break
        at, name = min(places)
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(values[name])
        rest = rest[at + len(name) + 2 :]
    return F.concat(*parts)


def truncate_chars(text: Column, max_len: int, side: str = "right") -> Column:
    """Cut to ``max_len`` characters: ``right`` keeps the head, ``left`` the tail, ``error`` raises."""
    too_long = F.length(text) > max_len
    if side == "right":
        return F.left(text, F.lit(max_len))
    if side == "left":
        return F.when(too_long, F.right(text, F.lit(max_len))).otherwise(text)
    message = F.concat(
        F.lit("text exceeds max length ("), F.length(text).cast("string"), F.lit(f" > {max_len})")
    )
    return F.when(too_long, F.raise_error(message)).otherwise(text)
