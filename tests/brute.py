"""Plain one-step-at-a-time versions of what the library does, for small inputs."""

from __future__ import annotations

from collections import Counter

import regex

# The published pre-token pattern, for an engine with Unicode classes.
PATTERN = regex.compile(
    r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)


def pretokens(text: str, specials=()) -> list[str]:
    if not specials:
        return PATTERN.findall(text)
    longest = sorted(specials, key=len, reverse=True)
    parts = regex.split("(" + "|".join(map(regex.escape, longest)) + ")", text)
    return [t for p in parts for t in ([p] if p in specials else PATTERN.findall(p))]


def pairs_of(words) -> Counter:
    found = Counter()
    for word, cnt in words.items():
        for pair in zip(word, word[1:]):
            found[pair] += cnt
    return found


def merged(word, pair):
    out, i = [], 0
    while i < len(word):
        if tuple(word[i : i + 2]) == pair:
            out.append(pair[0] + pair[1])
            i += 2
        else:
            out.append(word[i])
            i += 1
    return tuple(out)


def merge_all(words, pair):
    after = Counter()
    for word, cnt in words.items():
        after[merged(word, pair)] += cnt
    return after


def train(words, n_merges):
    """Greedy merges of ``{tuple of symbols: count}`` with their counts."""
    result = []
    for _ in range(n_merges):
        found = pairs_of(words)
        if not found:
            break
        pair = max(found, key=lambda p: (found[p], p))
        result.append((pair, found[pair]))
        words = merge_all(words, pair)
    return result


def byte_words(texts) -> Counter:
    counted = Counter(t for text in texts for t in pretokens(text))
    return Counter({tuple(bytes([b]) for b in word.encode()): cnt for word, cnt in counted.items()})


def encode(text, vocab_ids, ranks, specials=()):
    ids = []
    for token in pretokens(text, specials):
        if token in specials:
            ids.append(vocab_ids[token.encode()])
            continue
        word = tuple(bytes([b]) for b in token.encode())
        while True:
            known = [(ranks[p], i) for i, p in enumerate(zip(word, word[1:])) if p in ranks]
            if not known:
                break
            _, i = min(known)
            word = (*word[:i], word[i] + word[i + 1], *word[i + 2 :])
        ids += [vocab_ids[s] for s in word]
    return ids
