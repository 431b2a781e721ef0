"""Cutting texts at many special tokens by one automaton.

A regular expression tries one token after the other at every place, which takes as long as there are tokens. The
automaton looks at each character once, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def matcher(specials: Sequence[str]):
    """Aho-Corasick automaton of the tokens."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for token in specials:
        automaton.add_word(token, len(token))
    automaton.make_automaton()
    return automaton


def split_at(text: str, automaton) -> list[str]:
    """Ordinary segments and special tokens in order: the leftmost token first, of several there the longest."""
    # The longest token that begins at each place; the automaton's own choice of long ones passes over some.
    longest: dict[int, int] = {}
    for last, size in automaton.iter(text):
        first = last + 1 - size
        longest[first] = max(size, longest.get(first, 0))
    parts, at = [], 0
    for first in sorted(longest):
        if first < at:
            continue
        if first > at:
            parts.append(text[at:first])
        at = first + longest[first]
        parts.append(text[first:at])
    if at < len(text):
        parts.append(text[at:])
    return parts


def split_at_many(text: Column, specials: Sequence[str]) -> Column:
    """Array of ordinary segments and special tokens; joining it gives the text back. NULL stays NULL."""
    tokens = sorted({t for t in specials if t})

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = matcher(tokens)
        for texts in batches:
            yield pa.array([None if t is None else split_at(t, automaton) for t in texts.to_pylist()], pa.list_(pa.string()))

    # Marked so that a plan which uses the parts twice does not cut twice.
    return F.arrow_udf(run, "array<string>").asNondeterministic()(text)
