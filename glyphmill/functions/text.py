"""Column expressions over text: special-token splits, pre-tokens, byte symbols, printable bytes.

They run inside the JVM but for splits at many special tokens; none needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphmill.functions.automaton import split_at_many

# Fixed value: the published GPT-2 pre-token pattern. (?U) gives \s its Unicode meaning.
PRETOKEN_PATTERN = (
    r"(?U)'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Fixed value: the document delimiter of the training corpora.
END_OF_TEXT = "<|endoftext|>"
# Special tokens that are looked for one by one; the expression's time grows with their number.
MANY_SPECIALS = 32


def _quoted(tokens: Sequence[str]) -> str:
    if any("\\E" in t for t in tokens):
        raise ValueError(r"a special token cannot contain \E")
    longest_first = sorted(set(tokens), key=lambda t: (-len(t), t))
    return "|".join(rf"\Q{t}\E" for t in longest_first)


def special_split(text: Column, specials: Sequence[str]) -> Column:
    """Array of ordinary segments and special tokens, in order; joining it gives the text back.

    The lazy dot with a lookahead keeps the regex engine's stack flat on texts of any length. More than
    ``MANY_SPECIALS`` tokens are found by an automaton, in Arrow batches.
    """
    specials = [t for t in specials if t]
    if not specials:
        return F.when(F.length(text) > 0, F.array(text)).when(
            text.isNotNull(), F.array().cast("array<string>")
        )
    if len(set(specials)) > MANY_SPECIALS:
        return split_at_many(text, specials)
    any_special = _quoted(specials)
    return F.regexp_extract_all(
        text, F.lit(rf"(?s){any_special}|.+?(?={any_special}|\z)"), F.lit(0)
    )


def pretokens(text: Column, specials: Sequence[str] = (), keep_specials: bool = True) -> Column:
    """Array of the pre-tokens of ``text``.

    Ordinary segments are cut on their own, so whitespace before a special token ends a segment.
    A special token is one element when kept, and vanishes when dropped.
    """
    specials = [t for t in specials if t]
    pattern = F.lit(PRETOKEN_PATTERN)
    if not specials:
        return F.regexp_extract_all(text, pattern, F.lit(0))

    def cut(segment: Column) -> Column:
        kept = F.array(segment) if keep_specials else F.array().cast("array<string>")
        return F.when(segment.isin(specials), kept).otherwise(
            F.regexp_extract_all(segment, pattern, F.lit(0))
        )

    return F.flatten(F.transform(special_split(text, specials), cut))


def byte_symbols(text: Column) -> Column:
    """UTF-8 bytes of ``text`` as one delimited symbol each: ``" the"`` is ``<20><74><68><65>``.

    Upper-case hex sorts like the raw bytes, prefixes included, so ties can be broken on it.
    """
    return F.regexp_replace(F.hex(text), "(..)", "<$1>")


def symbol_array(sym: Column) -> Column:
    """Symbols of a delimited string as an array with one empty string at the end."""
    return F.split(F.replace(sym, F.lit("<"), F.lit("")), ">")


def drop_invalid_utf8(text: Column) -> Column:
    """Remove byte sequences that are not UTF-8 and keep everything else.

    ``make_valid_utf8`` marks bad bytes with U+FFFD. Real U+FFFD characters are escaped first so
    that only the marks are removed.
    """
    escape, mark = "\ue000", "\ufffd"
    safe = F.replace(text, F.lit(escape), F.lit(escape + "a"))
    safe = F.replace(safe, F.lit(mark), F.lit(escape + "b"))
    clean = F.replace(F.make_valid_utf8(safe), F.lit(mark), F.lit(""))
    clean = F.replace(clean, F.lit(escape + "b"), F.lit(mark))
    return F.when(F.is_valid_utf8(text), text).otherwise(
        F.replace(clean, F.lit(escape + "a"), F.lit(escape))
    )


# Fixed values of the printable byte map: these byte ranges stand for themselves, and the n-th
# remaining byte is shown as the character 256 + n.
_SHOWN_RANGES = ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF))
_HIDDEN_BYTES = [b for b in range(256) if not any(lo <= b <= hi for lo, hi in _SHOWN_RANGES)]
_RAW_CHARS = "".join(map(chr, _HIDDEN_BYTES))
_PRINTABLE_CHARS = "".join(chr(256 + n) for n in range(len(_HIDDEN_BYTES)))


def byte_display(token: Column) -> Column:
    """Printable form of a binary column."""
    return F.translate(F.decode(token, "ISO-8859-1"), _RAW_CHARS, _PRINTABLE_CHARS)


def byte_parse(shown: Column) -> Column:
    """Binary value of a printable form.

    ``translate`` takes a zero character as an order to delete, so the zero byte is put in apart.
    """
    raw = F.translate(shown, _PRINTABLE_CHARS[1:], _RAW_CHARS[1:])
    return F.encode(F.replace(raw, F.lit(_PRINTABLE_CHARS[0]), F.lit("\0")), "ISO-8859-1")
