"""Pre-tokens of the public byte-level pattern, split for many texts at once on arrays of code points.

The rules are those of ``public_tokenizers.PATTERN``: contractions, runs of letters, of numbers and of other signs, each
with the one blank before it, and white space, whose last character goes with what follows if it is a blank.
"""

from __future__ import annotations

import functools

import numpy as np

OTHER, LETTER, NUMBER, SPACE = range(4)
#: Fixed values of the pattern: contractions after an apostrophe.
SHORT, LONG = "stmd", ("re", "ve", "ll")


@functools.cache
def classes() -> np.ndarray:
    """The class of every code point, by the Unicode tables of the tokenizer library itself."""
    import tiktoken

    kinds = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        found = probe.decode_bytes(probe.encode_ordinary(every)).decode()
        kinds[points(found)] = kind
    return kinds


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def split(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The joined text, the start of each pre-token in it (and the end as a last element), pre-tokens before each text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    whole = "".join(texts)
    n = len(whole)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lengths, out=bounds[1:])
    if not n:
        return whole, np.zeros(1, np.int64), np.zeros(len(texts) + 1, np.int64)
    cp = points(whole)
    kind = classes()[cp]
    first = np.zeros(n + 1, bool)  # of a text; the end counts
    first[bounds] = True
    start = first[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # white space that something follows: its last character starts a token, which takes what follows if it is a blank
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:n])
    start[last] = True
    start[last[cp[last] == 32] + 1] = False
    quote = np.flatnonzero((cp == 39) & start)
    if len(quote):
        at = lambda k: np.where(quote + k < n, cp[np.minimum(quote + k, n - 1)], 0)
        inside = lambda k: (quote + k < n) & ~first[np.minimum(quote + k, n)]
        one, two = at(1), at(2)
        short = inside(1) & np.isin(one, [ord(c) for c in SHORT])
        long = np.zeros(len(quote), bool)
        for a, b in LONG:
            long |= (one == ord(a)) & (two == ord(b))
        long &= inside(1) & inside(2)
        size = np.where(short, 2, np.where(long, 3, 0))
        hit, size = quote[size > 0], size[size > 0]
        start[hit + 1] = False
        end = hit + size
        start[end[end < n]] = True
    starts = np.append(np.flatnonzero(start), n)
    return whole, starts, np.searchsorted(starts, bounds)
