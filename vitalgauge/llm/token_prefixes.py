"""Exact token counts at every prefix of every text, by prefix dynamic programming over a BPE vocabulary.

A token sequence is what byte-pair encoding makes of its text exactly if each two neighbours are what it makes of their
joined text. So the encoding of a prefix ends in the one token that fits the last token of the shorter prefix before
it, and counts grow along the text: count(prefix) = count(shorter prefix) + 1. Here words end in tokens of their
own kind (end of word), so each prefix has two entries: as the start of a longer word, and as a whole word. White
space separates words, hence the tables of words simply follow each other.

The table is stored as one signed byte per character: by how much the count changes with that character. Its
running sum is the count at each prefix, which answers truncation and budget questions without encoding again:
``tokens_at`` and ``longest_within``.

Positions are characters of the text in normal form (composed and in lower case, as the vocabulary sees it, with white
space kept). For text that is composed already that is the text itself, but for rare letters whose lower
case is several characters.

Defined cases: a null text is an empty one, with no tokens and an empty table; special strings of the vocabulary count
as one token from their last character on; repeated rows count alike; an empty table gives no rows; columns other than id
and text are not read.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Iterator
from pathlib import Path

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vitalgauge.llm.byte_bpe import in_letters
from vitalgauge.llm.common import text_bytes
from vitalgauge.llm.kept import Kept

LIMIT = 2048
_END = "</w>"
#: Unicode white space.
_SPACES = frozenset("\t\n\x0b\x0c\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000") | {chr(c) for c in range(0x2000, 0x200B)}
_PARTS = regex.compile(rf"[{''.join(sorted(_SPACES))}]|[^{''.join(sorted(_SPACES))}]+")
_PIECES = regex.compile(r"'(?:[stmd]|re|ve|ll)|\p{L}+|\p{N}|[^\p{L}\p{N}]+")
#: Longest word whose prefixes are remembered for other words.
_SHARED_LETTERS = 40
#: Bytes of words, and of what white space separates, that a worker keeps at most.
WORD_BYTES, PART_BYTES = 256 << 20, 320 << 20
#: Prefixes, and neighbours, that a worker keeps at most.
PREFIXES, NEIGHBOURS = 300_000, 300_000
#: Letters around a character by which normal forms and splits show: of several combining classes, and of each kind.
_AROUND = ("a\u0345{}\u0327\u0323\u0301", "a{0}-{0}1{0}'{0} {0}")


class PrefixBpe:
    """Counts for a vocabulary whose words are letters, single digits or other signs, and end in end-of-word tokens."""

    def __init__(self, path: str):
        config = json.loads(Path(path).read_text())
        model, normal = config["model"], config["normalizer"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != _END or normal is None:
            raise ValueError(f"{path} is not a BPE vocabulary with end-of-word tokens")
        self.special = [t["content"] for t in config["added_tokens"]]
        self.ranks = {tuple(m): i for i, m in enumerate(model["merges"])}
        #: Finds all tokens in a word, each as the start of a word, as its end (empty if it can't be that) and its size.
        self.tokens = ahocorasick.Automaton()
        vocab = model["vocab"]
        for text in {t.removesuffix(_END) for t in vocab} - {""}:
            self.tokens.add_word(text, (text if text in vocab else "", text + _END if text + _END in vocab else "", len(text)))
        self.tokens.make_automaton()
        self.fits: dict[tuple[str, str], bool] = {}
        self.library = Tokenizer.from_file(path)
        self.checked: set[int] = set()
        #: Characters that this Python and the library take differently.
        self.unsure: set[str] = set()
        self.made = functools.cache(self._made)
        #: By prefix: the entries of some word that begins with it.
        self.tables: dict[str, tuple[list[str], list[int], list[int]]] = {}
        self.parts = Kept(self._part, PART_BYTES)
        self.words = Kept(self._word, WORD_BYTES)

    def _made(self, token: str) -> tuple[int, str, str] | None:
        """Rank and parts of the last merge that makes a token of its own text; rank -1 for a single letter, None if
        encoding its text gives something else."""
        word = token.endswith(_END) and len(token) > len(_END)
        symbols = list(token.removesuffix(_END) if word else token)
        if word:
            symbols[-1] += _END
        made = (-1, "", "")
        while len(symbols) > 1:
            pairs = list(zip(symbols, symbols[1:], strict=False))
            rank, left, right = min((self.ranks.get(p, len(self.ranks)), *p) for p in pairs)
            if rank == len(self.ranks):
                return None
            made, out, i = (rank, left, right), [], 0
            while i < len(symbols):
                joined = i < len(pairs) and pairs[i] == (left, right)
                out.append(left + right if joined else symbols[i])
                i += 2 if joined else 1
            symbols = out
        return made

    def _fit(self, before: str, token: str) -> bool:
        """Whether ``token`` may follow ``before`` (empty: stand first).

        It may not if some merge across the border would have come first. The merges on both sides are undone,
        the latest first (of one rank, the right one comes later), and before each the merge across the border,
        of the two symbols that touched it then, must not have had its turn.
        """
        key = (before, token)
        known = self.fits.get(key)
        if known is None:
            known = self.fits[key] = self._fits(before, token)
        return known

    def _fits(self, left: str, right: str) -> bool:
        made, ranks = self.made, self.ranks
        if made(right) is None:
            return False
        if not left:
            return True
        limit = len(ranks)
        while True:
            if ranks.get((left, right), limit) < limit:
                return False
            (in_left, _, left_end), (in_right, right_start, _) = made(left), made(right)
            if in_left < 0 and in_right < 0:
                return True
            if in_left > in_right:
                limit, left = in_left, left_end
            else:
                limit, right = in_right + 1, right_start

    def _extend(self, letters: str, last: list[str], count: list[int], whole: list[int]) -> None:
        """Add the entries of all prefixes that have none: last token and count as the start of a longer word, and count
        as a word. Tokens are met in the order of their ends."""
        known, upto, begun, word, ends_in = len(last), len(last), 0, 0, ""
        for end, (token, closing, size) in self.tokens.iter(letters):
            if end + 1 < known:
                continue
            if end + 1 > upto:
                last.append(ends_in)
                count.append(begun)
                whole.append(word)
                upto, begun, word = end + 1, 0, 0
            at = upto - size
            if token and not begun and self._fit(last[at], token):
                begun, ends_in = count[at] + 1, token
            if closing and not word and self._fit(last[at], closing):
                word = count[at] + 1
        last.append(ends_in)
        count.append(begun)
        whole.append(word)

    def counts(self, piece: str) -> list[int]:
        """Tokens of each prefix of a word, character by character."""
        letters, known, last, count, whole = in_letters(piece), 0, [""], [0], [0]
        shared = len(letters) <= _SHARED_LETTERS
        if shared:
            for known in range(len(letters), 0, -1):
                table = self.tables.get(letters[:known])
                if table is not None:
                    last, count, whole = (x[: known + 1] for x in table)
                    break
            else:
                known = 0
        if known < len(letters):
            self._extend(letters, last, count, whole)
        if shared:
            table = last, count, whole
            for upto in range(known + 1, len(letters) + 1):
                self.tables[letters[:upto]] = table
        if len(letters) == len(piece):
            return whole[1:]
        at, out = 0, []
        for character in piece:
            at += len(character.encode())
            out.append(whole[at])
        return out

    def _word(self, piece: str) -> bytes:
        if piece[0] == "'" and len(piece) > 1 and piece[1].isalpha():  # a contraction; short of it, two words
            parts = [self.counts("'")[0]] + [self.counts("'")[0] + n for n in self.counts(piece[1:-1])]
            counts = [*parts, self.counts(piece)[-1]]
        else:
            counts = self.counts(piece)
        return bytes([(n - m) & 0xFF for m, n in zip([0, *counts], counts, strict=False)])

    def _part(self, part: str) -> bytes:
        steps = []
        for found in _PARTS.findall(part):
            if found in _SPACES:
                steps.append(b"\0")
            else:
                steps.extend(map(self.words.__getitem__, _PIECES.findall(found)))
        return b"".join(steps)

    def _normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        composed = unicodedata.normalize("NFC", text)
        return composed.lower() if "Σ" not in composed else "".join(c.lower() for c in composed)

    def _has_unsure(self, text: str) -> bool:
        """Whether the library may take some character of the text for another kind or to another normal form.

        The two know different versions of Unicode. Blocks of characters are compared when they are first met.
        """
        if text.isascii():
            return False
        characters = set(text)
        for block in {ord(c) >> 8 for c in characters} - self.checked:
            self.checked.add(block)
            self.unsure.update(c for c in map(chr, range(block << 8, (block + 1) << 8)) if not self._agrees(c))
        return not characters.isdisjoint(self.unsure)

    def _agrees(self, c: str) -> bool:
        if "\ud800" <= c <= "\udfff":
            return True  # no characters, and never in a text
        if any(self._normal(x.format(c)).split() != self.library.normalizer.normalize_str(x.format(c)).split() for x in _AROUND):
            return False
        text = self._normal(_AROUND[1].format(c))
        pieces = [piece for part in _PARTS.findall(text) if part not in _SPACES for piece in _PIECES.findall(part)]
        return pieces == self._library_pieces(text)

    def _library_pieces(self, normal: str) -> list[str]:
        """The pieces of a text in normal form, by the library."""
        before = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [normal[i:j] for _, (i, j) in before if i < j]

    def _library_steps(self, text: str) -> bytes:
        """As ``_ordinary``, with normal form and pieces from the library; white space is one space there."""
        normal = self.library.normalizer.normalize_str(text)
        steps, at = [], 0
        for _, (i, j) in self.library.pre_tokenizer.pre_tokenize_str(normal):
            if i < j:
                steps += [bytes(max(i - at, 0)), self._word(normal[i:j])]
                at = j
        return b"".join([*steps, bytes(len(normal) - at)])

    def _ordinary(self, text: str) -> bytes:
        if self._has_unsure(text):
            return self._library_steps(text)
        return b"\0".join(map(self.parts.__getitem__, self._normal(text).split(" "))) if text else b""

    def steps(self, text: str) -> bytes:
        """By how much each character of the normal form changes the count."""
        for kept, most in ((self.tables, PREFIXES), (self.fits, NEIGHBOURS)):
            if len(kept) > most:
                kept.clear()
        out = []
        while found := [(at, s) for s in self.special if (at := text.find(s)) >= 0]:
            at, special = min(found)
            before, begun = self._ordinary(text[:at]), self._ordinary(text[:at] + special[:-1])
            step = 1 + _total(before) - _total(begun)
            out += [begun, np.int8(step).tobytes()]
            text = text[at + len(special) :]
        return b"".join([*out, self._ordinary(text)])


def _total(steps: bytes) -> int:
    return int(np.frombuffer(steps, np.int8).sum(dtype=np.int64))


_counters: dict[str, PrefixBpe] = {}


def counter(path: str) -> PrefixBpe:
    """One per worker and vocabulary, so that what it keeps serves all tasks of the worker."""
    if path not in _counters:
        _counters[path] = PrefixBpe(path)
    return _counters[path]


def prefix_tables(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per document: ``doc_id``, ``n_bytes`` of the text, ``n_tokens`` of the whole of it and its table ``steps``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = counter(tokenizer_path)
        for batch in batches:
            texts = text_bytes(batch, "text")
            for low in range(0, batch.num_rows, 1024):
                ids = batch.column(0).slice(low, 1024)
                some = [next(texts) for _ in range(len(ids))]
                steps = [bpe.steps(t.decode()) for t in some]
                columns = [pa.array(map(len, some), pa.int64()), pa.array(map(_total, steps), pa.int64()), pa.array(steps, pa.binary())]
                yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", "n_bytes", "n_tokens", "steps"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long, steps binary")


def tokens_at(steps: Column, characters: Column) -> Column:
    """Tokens of the first ``characters`` characters."""

    @F.pandas_udf("long")
    def at(steps: pd.Series, characters: pd.Series) -> pd.Series:
        return pd.Series([_total(s[: max(int(n), 0)]) for s, n in zip(steps, characters, strict=True)], dtype="int64")

    return at(steps, characters)


def longest_within(steps: Column, budget: Column) -> Column:
    """Characters of the longest prefix that has at most ``budget`` tokens; -1 if there is none."""

    @F.pandas_udf("long")
    def longest(steps: pd.Series, budget: pd.Series) -> pd.Series:
        out = []
        for s, most in zip(steps, budget, strict=True):
            counts = np.cumsum(np.frombuffer(b"\0" + s, np.int8), dtype=np.int64)
            fits = np.flatnonzero(counts <= most)
            out.append(int(fits[-1]) if len(fits) else -1)
        return pd.Series(out, dtype="int64")

    return longest(steps, budget)
