r"""Texts cut into parts that tokenizers treat each by itself, every distinct part once.

A text is cut before each blank that follows something other than a blank and comes before something
other than white space. No token of the byte-level vocabularies goes over such a place: their
pattern lets a blank only start a match, and takes white space before a word without its last blank.
Neither does a piece of a vocabulary whose mark stands in front of pieces or in pieces of marks
alone. So a text's tokens are those of its parts, in order.

Most texts have single blanks between words; Arrow splits those and numbers the distinct words.
The others are cut by a regular expression.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space as Unicode has it, and U+001C to U+001F: before those there is no cut, which is always safe.
_WHITE = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_UNEVEN = rf" (?:{_WHITE}|\z)"
_CUT = re.compile(r"(?<! )(?= \S)")


@dataclass
class Parts:
    """``codes[first[i]:first[i + 1]]`` are the parts of text i, as numbers of ``distinct``."""

    distinct: list[str]
    codes: np.ndarray
    first: np.ndarray


def parts_of(texts: pa.Array, lead: bool = False) -> Parts:
    """The parts of each text. With ``lead`` a blank is put in front of each text that is not empty.

    Nulls and empty texts have no parts that hold anything. The distinct parts may be empty.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    uneven = pc.match_substring_regex(texts, rf"{_UNEVEN}|\A " if lead else _UNEVEN)
    odd = uneven.to_numpy(zero_copy_only=False).astype(bool)
    even = texts.filter(pa.array(~odd))
    split = pc.split_pattern(even, " ")
    words = split.flatten().dictionary_encode()
    bounds = split.offsets.to_numpy().astype(np.int64)
    codes = words.indices.to_numpy().astype(np.int64)
    distinct = [" " + w for w in words.dictionary.to_pylist()]
    if not lead and len(even):               # the first word of a text has no blank in front
        firsts = words.dictionary.take(pa.array(codes[bounds[:-1]])).dictionary_encode()
        codes[bounds[:-1]] = firsts.indices.to_numpy().astype(np.int64) + len(distinct)
        distinct += firsts.dictionary.to_pylist()
    elif lead and len(even):                 # an empty text gets no blank
        empty = pc.equal(even, "").to_numpy(zero_copy_only=False)
        codes[bounds[:-1][empty]] = len(distinct)
        distinct.append("")
    if not odd.any():
        return Parts(distinct, codes, bounds)
    known: dict[str, int] = {}
    own, sizes = [], []
    for text in texts.filter(pa.array(odd)).to_pylist():
        cut = _CUT.split(" " + text if lead else text)
        own += [known.setdefault(p, len(distinct) + len(known)) for p in cut]
        sizes.append(len(cut))
    distinct += known
    return _in_order(odd, distinct, codes, np.diff(bounds), np.array(own, np.int64), np.array(sizes))


def _in_order(odd: np.ndarray, distinct: list[str], even_codes: np.ndarray, even_sizes: np.ndarray,
              odd_codes: np.ndarray, odd_sizes: np.ndarray) -> Parts:
    """The parts of both kinds of texts in the order of the texts."""
    sizes = np.zeros(len(odd), np.int64)
    sizes[~odd], sizes[odd] = even_sizes, odd_sizes
    of_odd = np.repeat(odd, sizes)
    codes = np.empty(len(of_odd), np.int64)
    codes[~of_odd], codes[of_odd] = even_codes, odd_codes
    return Parts(distinct, codes, np.concatenate([[0], np.cumsum(sizes)]))


def lists(values: list[list[int]]) -> pa.ListArray:
    """Lists of numbers as one Arrow array."""
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    flat = np.fromiter((v for one in values for v in one), np.int32, int(sizes.sum()))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(flat))


def spread(parts: Parts, of_part: pa.LargeListArray) -> tuple[np.ndarray, np.ndarray]:
    """What each distinct part has, put together for each text; and where each text's values start."""
    sizes = np.diff(of_part.offsets.to_numpy())
    flat = of_part.take(pa.array(parts.codes)).flatten().to_numpy()
    before = np.concatenate([[0], np.cumsum(sizes[parts.codes])])
    return flat, before[parts.first]
