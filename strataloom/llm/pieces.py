"""Exact tokenization through cached pieces.

A text is cut only where the tokenizer's own pre-tokenizer cuts whatever surrounds the place, so the ids of
a text are those of its pieces in a row. Pieces repeat, so most are looked up instead of merged anew.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array

#: Unicode White_Space, as the tokenizers' \s has it. Python's own \s holds four more control characters.
WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Letters after which the marks in STOPS always begin another pre-token.
LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
STOPS = ",.;:!?"

_BYTE_CUTS = re.compile(f"[{WS}]*[{LATIN}]+(?=[{STOPS}])|[{WS}]*[^{WS}]+|[{WS}]+")
_WORD_STOPS = re.compile(f"(?<=[{LATIN}])(?=[{STOPS}])")
_UNSAFE = re.compile("[İΣ]")  # lower case depends on more than the character, or takes several


def byte_pieces(text: str) -> list[str]:
    """Pieces for a byte-level pre-tokenizer that keeps white space at the head of the next word."""
    return _BYTE_CUTS.findall(text)


def word_pieces(text: str) -> list[str]:
    """Pieces for the lower-casing word tokenizer, which drops white space.

    Only texts already in NFC are cut and lower-cased here; others go to the library whole, and so do texts that may hold
    a special string, which the library looks for before it lower-cases.
    """
    if "<|" in text:
        return [text]
    if not text.isascii():
        if _UNSAFE.search(text) or not unicodedata.is_normalized("NFC", text):
            return [text] if text else []
    return _WORD_STOPS.sub(" ", text.lower()).split(" ")


class _Cache(dict):
    """Second tier: pieces met by this worker; emptied down to the first tier once it holds ``most``."""

    def __init__(self, encode, first: dict, most: int):
        super().__init__(first)
        self.encode, self.first, self.most, self.longest = encode, first, most, 64

    def __missing__(self, piece: str):
        value = self.encode(piece)
        if len(piece) <= self.longest:
            if len(self) >= self.most:
                self.clear()
                self.update(self.first)
            self[piece] = value
        return value


#: Pieces that are one pre-token of letters, for which the merges alone decide.
_ONE_BYTE_WORD = re.compile(f" ?[{LATIN}]+")
_ONE_WORD = re.compile("[a-zß-öø-ÿ]+")
#: The usual printable stand-ins of bytes: printable Latin-1 characters for themselves, the others from U+0100 on in order.
_KEPT = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: b if b in _KEPT else 256 + sum(x not in _KEPT for x in range(b)) for b in range(256)}


def load(path: str):
    """The library's encoder for a file: a function from text to a list of ids."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda s: model.encode(s)
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    single = (_ONE_BYTE_WORD if tok.normalizer is None else _ONE_WORD).fullmatch
    merge = tok.model.tokenize

    def encode(s: str) -> list[int]:
        if single(s):
            return [t.id for t in merge(s.encode().decode("latin-1").translate(BYTE_LETTERS))]
        return tok.encode(s, add_special_tokens=False).ids

    return encode


_WORKER: dict = {}


def ids_cache(path: str, most: int = 300_000) -> _Cache:
    """piece -> its ids as little-endian unsigned 32-bit bytes; one cache per worker process."""
    if ("ids", path) not in _WORKER:
        encode = load(path)
        _WORKER["ids", path] = _Cache(lambda s: array("I", encode(s)).tobytes(), {}, most)
    return _WORKER["ids", path]


def count_cache(path: str, table: bytes, most: int = 700_000) -> _Cache:
    """piece -> number of its ids, with the broadcast table as first tier."""
    if ("n", path) not in _WORKER or _WORKER["n", path][0] != len(table):
        encode = load(path)
        _WORKER["n", path] = len(table), _Cache(lambda s: len(encode(s)), unpack_table(table), most)
    return _WORKER["n", path][1]


def pack_table(lengths: dict[str, int]) -> bytes:
    """Compact form of a table of pre-token lengths: one byte per length, then the pre-tokens, NUL between them."""
    keep = {k: n for k, n in lengths.items() if 0 < n < 256 and "\0" not in k}
    return len(keep).to_bytes(4, "little") + bytes(keep.values()) + "\0".join(keep).encode("utf-8", "surrogatepass")


def unpack_table(table: bytes) -> dict[str, int]:
    n = int.from_bytes(table[:4], "little")
    return dict(zip(table[4 + n :].decode("utf-8", "surrogatepass").split("\0"), table[4 : 4 + n], strict=True)) if n else {}
