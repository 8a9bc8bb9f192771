"""Encoding by the tokenizers library, piece by piece, with the pieces met lately remembered.

A byte-level BPE cuts a text into pieces by a fixed pattern and merges within each. Pieces
repeat, but the library works each text out anew. Here a text whose characters all belong to
scripts with a settled Unicode table (Latin letters, general punctuation) is cut by the
pattern spelled out for them, and the library's model merges each piece once while it is
remembered. Texts with other characters go to the library whole, as do all texts of a
vocabulary with a normalizer or another pre-tokenizer, so that the ids are the library's always.
"""

from __future__ import annotations

import functools
import json
import re
import struct

import numpy as np

from gustmill.llm.bpe import _byte_symbols

#: Pieces remembered, in each of two generations.
MEMO_PIECES = 1 << 19

# Letters, numbers and white space up to U+024F; with U+2010 to U+2027 and U+2030 to
# U+205E, which hold none of these, the characters that the pattern below knows.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACES = "\\t-\\r \x85\xa0"
OTHERS = "[^\\x00-ɏ‐-‧‰-⁞]"
# Fixed value: the pre-tokenizer's pattern of the byte-level vocabularies, for those characters.
PIECES = (
    f" ?[{LETTERS}]+| ?[{NUMBERS}]+|'(?:[stmd]|re|ve|ll)| ?[^{SPACES}{LETTERS}{NUMBERS}]+"
    f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)


class _Memo(dict):
    """Ids of a piece, packed. What is not asked for while a generation fills up is forgotten.

    ``wrong`` is set by a piece that its tokens do not spell; such a piece is not remembered.
    """

    def __init__(self, model):
        super().__init__()
        self.old: dict[str, bytes] = {}
        self.wrong = False
        self.tokenize = model.tokenize
        self.symbols = dict(enumerate(_byte_symbols()))

    def __missing__(self, piece: str) -> bytes:
        packed = self.old.get(piece)
        if packed is None:
            spelled = piece.encode().decode("latin-1").translate(self.symbols)
            tokens = self.tokenize(spelled)
            packed = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
            if "".join([t.value for t in tokens]) != spelled:
                self.wrong = True
                return packed
        if len(piece) <= 64:
            if len(self) >= MEMO_PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = packed
        return packed


class PiecewiseTokenizer:
    def __init__(self, vocabulary: str, plain_specials: bool = False):
        """``vocabulary``: a tokenizers JSON file's text. With ``plain_specials`` the strings of
        special tokens inside a text are text like any other."""
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = plain_specials
        spec = json.loads(vocabulary)
        before = spec.get("pre_tokenizer") or {}
        usual = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        model = spec["model"]
        usual = usual and model["type"] == "BPE" and not spec.get("normalizer") and not model.get("ignore_merges")
        usual = usual and not (model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"))
        added = [t for t in spec.get("added_tokens") or [] if not (plain_specials and t["special"])]
        self.marks = [t["content"] for t in added]
        self.cut = re.compile(PIECES).findall if usual else None
        self.others = re.compile(OTHERS).search
        self.memo = _Memo(self.library.model)
        self.spelled: bool | None = None

    def encode_packed(self, text: str) -> bytes:
        """Ids of a whole text, without special tokens around it, as little-endian unsigned 32-bit integers.

        ``spelled`` then tells whether the pieces' tokens spell them, or is None where the library took the text whole.
        """
        if self.cut is None or self.others(text) or any(mark in text for mark in self.marks):
            self.spelled = None
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        self.memo.wrong = False
        packed = b"".join(map(self.memo.__getitem__, self.cut(text)))
        self.spelled = not self.memo.wrong
        return packed

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_packed(text), dtype="<u4")


@functools.lru_cache(maxsize=2)
def tokenizer(vocabulary: str, plain_specials: bool = False) -> PiecewiseTokenizer:
    return PiecewiseTokenizer(vocabulary, plain_specials)
