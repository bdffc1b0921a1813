"""Token ids of whole texts by a byte-level BPE of the tokenizers library, with known pieces kept.

The library splits a text into pieces and merges each by itself, so equal pieces have equal ids. Running
text repeats its pieces; here each distinct piece is merged once per worker and later ones are looked up.
Where ids ascend with the merges, as they do in vocabularies of this kind, merging by least id is merging by
first merge, which tiktoken does faster on single pieces; otherwise pieces go to the library's model. Texts with
characters outside a plain range, special strings or certain runs of white space go to the library whole.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable
from pathlib import Path

import numpy as np
import tiktoken
from tokenizers import Tokenizer

from vitalgauge.llm.kept import Kept

#: Bytes of pieces, and of words, that a worker keeps at most.
PIECE_BYTES, WORD_BYTES = 64 << 20, 256 << 20
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
_NUMBERS = "0-9²³¹¼½¾"
_SPACES = r"\t\n\r "
#: ASCII characters that libraries may or may not take as white space.
_UNSURE = "\x0b\x0c\x1c\x1d\x1e\x1f"
#: Characters whose kind (letter, number, space, other) is the same everywhere.
_PLAIN = re.compile(r"[\t\n\r -~¡-ſ‐-‧‰-⁞]*")
#: The byte-level pattern on plain characters.
_PIECES = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
    rf"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)
#: A space within a run of white space but neither at its start nor just before a word: cutting there would split a piece.
_INNER_SPACE = re.compile(r"[\t\n\r ] (?:[\t\n\r ]|$)")
_SECOND_SPACE = ("  ", "\n ", "\t ", "\r ")


def plain(text: str) -> bool:
    """Whether the kind of each character is the same everywhere, and none joins with its neighbours."""
    if text.isascii():
        return not any(c in text for c in _UNSURE)
    return _PLAIN.fullmatch(text) is not None


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else one from 256 on."""
    prints = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(prints)]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


_AS_LETTERS = byte_letters()


def in_letters(piece: str) -> str:
    if piece.isascii() and piece.isprintable():
        return piece.replace(" ", _SPACE_LETTER)
    return piece.encode().decode("latin-1").translate(_AS_LETTERS)


_SPACE_LETTER = _AS_LETTERS[ord(" ")]


class ByteBpe:
    """Encodes texts as packed ids of ``dtype``, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    ``special_as_text``: special strings inside texts are ordinary text.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        config = json.loads(Path(path).read_text())
        before = config["pre_tokenizer"] or {}
        self.by_pieces = (
            config["normalizer"] is None
            and config["model"]["type"] == "BPE"
            and (before.get("type"), before.get("add_prefix_space"), before.get("use_regex")) == ("ByteLevel", False, True)
        )
        self.special = [] if special_as_text else [t["content"] for t in config["added_tokens"]]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.merge = self._merger(config["model"])
        self.pieces = Kept(self._piece, PIECE_BYTES)
        self.words = Kept(self._word, WORD_BYTES)

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        return array(self.code, self.merge(piece)).tobytes()

    def _merger(self, model: dict) -> Callable[[str], list[int]]:
        """A function from a piece to its ids."""
        vocab, letters = model["vocab"], {c: bytes([b]) for b, c in _AS_LETTERS.items()}
        made = [vocab.get("".join(m) if isinstance(m, list) else m.replace(" ", ""), -1) for m in model["merges"]]
        by_id = made == sorted(set(made)) and set(letters) <= set(vocab) and max(vocab[c] for c in letters) < made[0]
        if not by_id:
            return lambda piece: [t.id for t in self.tokenizer.model.tokenize(in_letters(piece))]
        known = {*made, *(vocab[c] for c in letters)}
        ranks = {b"".join(map(letters.get, token)): i for token, i in vocab.items() if i in known}
        return tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece

    def _word(self, word: str) -> bytes:
        """The ids of a word after a space."""
        return self._piece(" " + word) if word.isalpha() else self._pieces(" " + word)

    def _pieces(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, _PIECES.findall(text)))

    def encode(self, text: str) -> bytes:
        if (
            not self.by_pieces
            or not plain(text)
            or any(s in text for s in self.special)
            or (any(s in text for s in _SECOND_SPACE) and _INNER_SPACE.search(text))
        ):
            return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        first, *others = text.split(" ")
        return self._pieces(first) + b"".join(map(self.words.__getitem__, others))


_encoders: dict[tuple[str, bool], ByteBpe] = {}


def encoder(path: str, special_as_text: bool = False) -> ByteBpe:
    """One encoder per worker and vocabulary, so that what it keeps serves all tasks of the worker."""
    key = (path, special_as_text)
    if key not in _encoders:
        _encoders[key] = ByteBpe(path, special_as_text)
    return _encoders[key]


def forget() -> None:
    """Drop the pieces and words this worker keeps: Spark uses it again for other stages, next to whose memory they would stay."""
    for bpe in _encoders.values():
        bpe.pieces.forget()
        bpe.words.forget()
