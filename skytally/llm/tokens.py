"""Exact, cached encoding with public tokenizer files.

A tokenizer cuts a text into units that are encoded one by one, and most units repeat, so a worker remembers
each unit's ids. Only texts made of characters for which the cut is spelled out here take this way; any
other text (rare scripts, combining marks, special-token strings) is given whole to the tokenizer itself, so
the ids are always the tokenizer's own.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Words that each half of an encoder's memory holds, about 200 bytes each.
REMEMBERED = 250_000

_plain = [chr(c) for c in range(0x250)]
_letters = re.escape("".join(c for c in _plain if unicodedata.category(c)[0] == "L"))
_numbers = re.escape("".join(c for c in _plain if unicodedata.category(c)[0] == "N"))
# white space of the plain characters; 0x1C-0x1F and 0x85 are left to the tokenizer
_blank = "\t-\r \xa0"
WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_letters}]+|[{_numbers}]|[^{_blank}{_letters}{_numbers}]+")
# Byte-level alphabet: printable bytes stand for themselves, the others for the code points from 256 on.
_shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
LETTER_OF_BYTE = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in set(_shown))}
_listed = [*map(chr, (*range(9, 14), *range(32, 127), *range(0xA0, 0x250), *range(0x2010, 0x2028)))]


def _stays(c: str) -> bool:
    """Lower case and composition leave one character of the list (many capitals' small letters lie beyond)."""
    low = c.lower()
    return low in _listed and unicodedata.normalize("NFC", c) == c and unicodedata.normalize("NFC", low) == low


PLAIN = re.compile("[" + re.escape("".join(filter(_stays, _listed))) + "]*")


class Remembered(dict):
    """What was learned when it was first asked for. A full half becomes the old one and the last old one is
    forgotten; whatever is asked for again moves back, so what is frequent stays and the size is bounded."""

    def __init__(self):
        super().__init__()
        self.old: dict[str, bytes] = {}

    def learn(self, unit: str) -> bytes:
        raise NotImplementedError

    def __missing__(self, unit: str) -> bytes:
        found = self.old.pop(unit, None)
        if found is None:
            found = self.learn(unit)
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[unit] = found
        return found


class Words(Remembered):
    """Ids of whatever stands between two blanks."""

    def __init__(self, model):
        super().__init__()
        self.tokenize = model.tokenize

    def learn(self, chunk: str) -> bytes:
        ids = []
        for word in WORDS.findall(chunk.lower()):
            # the model reads a word's bytes as the letters that stand for them
            word = word if word.isascii() else word.encode().decode("latin-1").translate(LETTER_OF_BYTE)
            ids += [t.id for t in self.tokenize(word)]
        return array("I", ids).tobytes()


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = Words(self.tokenizer.model)

    def encode(self, texts: list[str]) -> list[bytes]:
        known, out = self.known, [b""] * len(texts)
        for i, text in enumerate(texts):
            if "<|" in text or not PLAIN.fullmatch(text):
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                out[i] = array("I", ids).tobytes()
            else:
                out[i] = b"".join(map(known.__getitem__, text.split()))
        return out


_encoders: dict[str, WordEncoder] = {}


def tokenizer_path(name: str) -> str:
    """Where this machine has a tokenizer file: a path, or a name within the installed vocabularies."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(name: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file; kept between tasks."""
    if name not in _encoders:
        _encoders[name] = WordEncoder(tokenizer_path(name))
    return _encoders[name]


# ------------------------------------------------------- byte-level words

# 0x85 is white space to the tokenizer and 0x1C-0x1F aren't: both are left to it
_WHITE = "\t-\r \xa0"
BYTE_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_letters}]+| ?[{_numbers}]+| ?[^{_WHITE}{_letters}{_numbers}]+"
                        f"|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")
BYTE_PLAIN = re.compile("[\t-\r -~\xa0-\u024f\u2010-\u2027]*")
_BYTE_OF_LETTER = {chr(c): bytes([b]) for b, c in LETTER_OF_BYTE.items()} | {chr(b): bytes([b]) for b in _shown}


class Units(Remembered):
    """Ids of units. ``exact``: their tokens' bytes were the units' own so far."""

    def __init__(self, ids_of, token_bytes: list[bytes]):
        super().__init__()
        self.ids_of, self.token_bytes, self.exact = ids_of, token_bytes, True

    def learn(self, unit: str) -> bytes:
        ids = self.ids_of(unit)
        self.exact &= b"".join(self.token_bytes[i] for i in ids) == unit.encode("utf-8", "surrogatepass")
        return array("I", ids).tobytes()


def tokens_cover(ids: bytes, token_bytes: list[bytes], text: str) -> bool:
    return b"".join(token_bytes[i] for i in array("I", ids)) == text.encode("utf-8", "surrogatepass")


class ByteLevelEncoder:
    """A byte-level BPE file: every token's bytes, and texts' ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        special = {i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.token_bytes = [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab().items():
            if i not in special:
                self.token_bytes[i] = b"".join(map(_BYTE_OF_LETTER.__getitem__, token))
        model = self.tokenizer.model
        self.known = Units(lambda word: [t.id for t in model.tokenize(word.encode().decode("latin-1").translate(LETTER_OF_BYTE))],
                           self.token_bytes)

    def encode(self, text: str) -> tuple[bytes, bool]:
        """(ids, whether their tokens' bytes are the text's)."""
        plain = bool(BYTE_PLAIN.fullmatch(text))
        if plain:
            ids = b"".join(map(self.known.__getitem__, BYTE_WORDS.findall(text)))
        else:
            ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return ids, plain and self.known.exact or tokens_cover(ids, self.token_bytes, text)


# ------------------------------------------------------------------ pieces

PIECE_UNITS = re.compile("\n|\t| +[^ \n\t]*|[^ \n\t]+")
_PIECE_BYTE = re.compile("<0x([0-9A-F]{2})>")


class PieceEncoder:
    """A sentencepiece BPE file: ids of texts that bring the leading space themselves.

    No piece has a space after anything but spaces, nor a line break or tab beside another character (checked
    when loaded, else every text is encoded whole), so no merge crosses from one unit to the next.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        n = len(self.processor)
        pieces = [self.processor.id_to_piece(i) for i in range(n)]
        plain = [not (self.processor.is_control(i) or self.processor.is_unknown(i) or self.processor.is_byte(i)) for i in range(n)]
        self.token_bytes = [b""] * n
        for i, piece in enumerate(pieces):
            if self.processor.is_byte(i):
                self.token_bytes[i] = bytes.fromhex(_PIECE_BYTE.fullmatch(piece)[1])
            elif plain[i]:
                self.token_bytes[i] = piece.replace("\u2581", " ").encode()
        crossing = re.compile("[^\u2581]\u2581|.[\n\t]|[\n\t].", re.DOTALL)
        self.by_units = not any(crossing.search(p) for p, own in zip(pieces, plain, strict=True) if own)
        self.start = self.processor.encode("\n")[:-1]   # the added space alone
        self.known = Units(self._unit, self.token_bytes)

    def _unit(self, unit: str) -> list[int]:
        if unit[0] == " ":
            return self.processor.encode(unit[1:]) if len(unit) > 1 else self.start
        # a line break keeps the added space from the unit
        return self.processor.encode("\n" + unit)[len(self.start) + 1:]

    def encode(self, text: str) -> tuple[bytes, bool]:
        """(ids, whether their tokens' bytes are the text's); ``text`` starts with the space."""
        units = self.by_units and "\u2581" not in text   # that character is a space to the model
        if units:
            ids = b"".join(map(self.known.__getitem__, PIECE_UNITS.findall(text)))
        else:
            ids = array("I", self.processor.encode(text[1:])).tobytes()
        return ids, units and self.known.exact or tokens_cover(ids, self.token_bytes, text)
