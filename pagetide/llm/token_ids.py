"""Token ids of whole texts by the tokenizers library, for use inside Spark tasks."""

import json
import re
from array import array
from codecs import charmap_decode
from functools import cache, lru_cache

from pagetide.llm.words import split

END_ID = 0
KEPT_WORDS = 600_000


def _byte_characters():
    """Byte-level vocabularies write visible bytes as themselves and others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in visible]
    return {byte: 0x100 + number for number, byte in enumerate(others)}


_WRITTEN = _byte_characters()
_TABLE = "".join(chr(_WRITTEN.get(byte, byte)) for byte in range(256))


@cache
def _serialised(number):
    return number.to_bytes(4, "little")


class _Encoded(dict):
    """Serialised ids by word; a word not seen before is encoded, and old ones go when full."""

    def __init__(self, model):
        super().__init__()
        self.merge = model.tokenize

    def __missing__(self, word):
        if len(self) >= KEPT_WORDS:
            self.clear()
        written, _ = charmap_decode(word.encode(), "strict", _TABLE)
        ids = b"".join([_serialised(token.id) for token in self.merge(written)])
        self[word] = ids
        return ids


class TextEncoder:
    """Ids as little-endian unsigned 32-bit integers.

    A byte-level vocabulary never merges across the matches of its split pattern, so each distinct
    match goes through the tokenizer's model once and is remembered. Other tokenizers encode each
    text as a whole. Special tokens that a text spells out get their own ids, as in the library;
    `plain` takes them as ordinary text.
    """

    def __init__(self, path, plain=False):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = plain
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        before = settings["pre_tokenizer"] or {}
        added = settings.get("added_tokens") or []
        loose = ("single_word", "lstrip", "rstrip", "normalized")
        by_word = (
            before.get("type") == "ByteLevel"
            and before.get("use_regex")
            and not before.get("add_prefix_space")
            and tokenizer.normalizer is None
            and all(token["special"] and not any(token[k] for k in loose) for token in added)
        )
        self.vocabulary = tokenizer.get_vocab_size()
        self._whole = None if by_word else tokenizer.encode
        self._words = _Encoded(tokenizer.model)
        self._special = {} if plain else {
            token["content"]: token["id"].to_bytes(4, "little") for token in added
        }
        listed = sorted(self._special, key=len, reverse=True)
        self._cut = re.compile(f"({'|'.join(map(re.escape, listed))})").split if listed else None

    def _plain(self, text):
        return b"".join(map(self._words.__getitem__, split(text)))

    def __call__(self, text):
        if self._whole:
            return array("I", self._whole(text, add_special_tokens=False).ids).tobytes()
        if not self._cut:
            return self._plain(text)
        parts = self._cut(text)
        if len(parts) == 1:
            return self._plain(text)
        # Texts and special tokens take turns.
        return b"".join(
            self._special[part] if number % 2 else self._plain(part)
            for number, part in enumerate(parts)
        )

    def document(self, text):
        """Ids of the text, then the id that ends a document."""
        return self(text) + END_ID.to_bytes(4, "little")


@lru_cache(maxsize=2)
def encoder(path, plain=False):
    """One encoder per Python worker; workers serve many tasks."""
    return TextEncoder(path, plain)


def token_bytes(path):
    """The bytes that each id of a byte-level vocabulary stands for, by id."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    byte_of = {chr(_WRITTEN.get(byte, byte)): byte for byte in range(256)}
    return [
        bytes(byte_of[character] for character in tokenizer.id_to_token(number))
        for number in range(tokenizer.get_vocab_size())
    ]
