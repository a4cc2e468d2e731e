"""Splitting texts by the public pattern of byte-level tokenizers, fast where texts allow it."""

import re

import public_tokenizers
import regex

# Below this code the split is written with sets of characters, which `re` tests much faster than
# classes, and `re` itself is twice as fast as `regex`.
_FIRST_CODES = 0x250
_CLASSES = ((r"\p{L}", r"[^\W\d_]"), (r"\p{N}", r"\d"), (r"\s", r"\s"))


def _set(characters):
    return f"[{''.join(map(re.escape, characters))}]"


def _agreed():
    """Characters on whose classes both engines agree."""
    return [
        character
        for character in map(chr, range(_FIRST_CODES))
        if all(
            bool(regex.match(theirs, character)) == bool(re.match(ours, character))
            for theirs, ours in _CLASSES
        )
    ]


def _quick(characters):
    """The matches in a text of these characters."""
    kinds = [[c for c in characters if re.match(ours, c)] for _, ours in _CLASSES]
    letter, digit, space = map(_set, kinds)
    mark = _set([c for c in characters if not any(c in kind for kind in kinds)])
    return re.compile(
        rf"'(?:[stmd]|re|ve|ll)| ?{letter}+| ?{digit}+| ?{mark}+|{space}+(?={space}|\Z)|{space}+"
    ).findall


_known = _agreed()
# Finds characters on whose class both engines do not agree, or which come later.
_odd = re.compile(f"[^{''.join(map(re.escape, _known))}]").search
_find_quick = _quick(_known)
_find_ascii = _quick([character for character in _known if character.isascii()])
_find = regex.compile(public_tokenizers.PATTERN).findall


def split(text):
    """The matches of `public_tokenizers.PATTERN`, in order; together they are the text."""
    if _odd(text):
        return _find(text)
    return _find_ascii(text) if text.isascii() else _find_quick(text)
