"""Text to token ids: split into pre-tokens, encode each distinct pre-token once, join the packed ids.

A pre-token's ids do not depend on its neighbours, so a memo from pre-token to packed ids gives what
the libraries give for whole texts. The memo is cleared when it is full, which only costs time.
"""

from __future__ import annotations

import contextlib
import itertools
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEMO_WORDS = 300_000
SLICE_ROWS = 256

# Unicode's classes L, N and White_Space among the first 256 code points: texts of these alone take
# the faster pattern.
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACES = "\\t-\\r \x85\xa0"
_ALL_SPACES = _SPACES + "\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SUFFIXES = "'s|'t|'re|'ve|'m|'ll|'d"


def splitter(byte_level: bool) -> Callable[[str], list[str]]:
    """The pre-tokens of a text.

    ``byte_level``: the public pattern of byte-level BPE, which keeps all characters. Otherwise the
    pattern of the word BPE, which drops white space and takes digits one by one. The letter branch
    stands first because it matches most often; no other branch starts with the same character.
    """

    def pattern(letter: str, number: str, space: str, other: str, solid: str) -> str:
        if byte_level:
            return f" ?{letter}+|{_SUFFIXES}| ?{number}+| ?{other}+|{space}+(?!{solid})|{space}+"
        return f"{letter}+|{_SUFFIXES}|{number}|{other}+"

    latin = re.compile(
        pattern(
            f"[{_LETTERS}]", f"[{_NUMBERS}]", f"[{_SPACES}]",
            f"[^{_SPACES}{_LETTERS}{_NUMBERS}]", f"[^{_SPACES}]",
        )
    )
    general = regex.compile(
        pattern(
            r"\p{L}", r"\p{N}", f"[{_ALL_SPACES}]",
            rf"[^{_ALL_SPACES}\p{{L}}\p{{N}}]", f"[^{_ALL_SPACES}]",
        )
    )

    def split(text: str) -> list[str]:
        return latin.findall(text) if _only_latin_1(text) else general.findall(text)

    return split


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for bytes (the usual public rule)."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordMerges:
    """Ids of one pre-token by the merges of a ``tokenizers`` BPE file, run by tiktoken's merge loop.

    A word end is written as byte 0xFF, which UTF-8 does not use; joining it to the last byte ranks
    before all merges of the file. Tests hold the result against the ``tokenizers`` library.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        byte_of, suffix = _byte_of_char(), model["end_of_word_suffix"] or ""
        self._end = b"\xff" if suffix else b""

        def raw(token: str) -> bytes:
            ended = suffix and token.endswith(suffix)
            body = token[: len(token) - len(suffix)] if ended else token
            return bytes(byte_of[c] for c in body) + (self._end if ended else b"")

        order = [bytes([b]) for b in range(256)]
        order += [bytes([b]) + self._end for b in range(255)] if suffix else []
        for merge in model["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            order.append(raw(left) + raw(right))
        ids = {}
        for token, number in model["vocab"].items():
            with contextlib.suppress(KeyError):  # special tokens are no merges
                ids[raw(token)] = number
        self._ids = np.array([ids.get(token, 0) for token in order], dtype="<u4")
        ranks = {token: rank for rank, token in enumerate(order)}
        self._merge = tiktoken.Encoding(
            "words", pat_str=".+", mergeable_ranks=ranks, special_tokens={}
        )._encode_single_piece

    def packed(self, words: Iterable[str]) -> list[bytes]:
        ranks = [self._merge(w.encode() + self._end) for w in words]
        ends = np.cumsum([0, *map(len, ranks)]) * 4
        flat = np.fromiter(itertools.chain.from_iterable(ranks), dtype=np.int64)
        data = self._ids[flat].tobytes()
        return [data[a:b] for a, b in itertools.pairwise(ends)]


def _added_tokens(path: str) -> dict[str, bytes]:
    """Packed ids of a file's added tokens. Those that strip, need word bounds or match normalised text are refused."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file)["added_tokens"]
    for t in tokens:
        if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
            raise ValueError(f"added token {t['content']!r} does not match as plain text")
    return {t["content"]: t["id"].to_bytes(4, "little") for t in tokens}


#: Marks a whole text among pre-tokens. None of those begins with it: a pre-token of several characters is of one
#: kind or begins with a space or an apostrophe.
_WHOLE = "\0a"


def _only_latin_1(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def unknown_here(text: str) -> bool:
    """Has the text code points that this Python's Unicode tables lack? The libraries' tables may be newer."""
    if text.isascii() or _only_latin_1(text):
        return False
    return any(unicodedata.category(c) == "Cn" for c in set(text))


class Encoder:
    """Packed little-endian unsigned 32-bit ids of texts, by a tokenizer file of ``tokenizers``.

    Strings of the file's added tokens in a text are ordinary text; with ``added`` they get the tokens' ids, as
    the library gives by default.
    """

    def __init__(self, path: str, byte_level: bool, added: bool = False):
        from tokenizers import Tokenizer

        self._added = _added_tokens(path) if added else {}
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self._added, key=len, reverse=True))) + ")")
        self._library = Tokenizer.from_file(path)
        self._library.encode_special_tokens = not added
        self._normalize = self._library.normalizer
        self._merges = WordMerges(path)
        self._split = splitter(byte_level)
        # No pre-token equals an added token: all are cut out before the text is split.
        self._memo: dict[str, bytes] = dict(self._added)

    def _clean(self, text: str) -> str:
        """NFC and lower case, if the file asks for them; white space never reaches a word."""
        if self._normalize is None:
            return text
        if text.isascii():
            return text.lower()
        if "\u03a3" in text:  # Python lowers a final sigma by its context, the tokenizer does not
            return self._normalize.normalize_str(text)
        return unicodedata.normalize("NFC", text).lower()

    def _words(self, text: str) -> list[str]:
        """Pre-tokens, and added tokens where they stand. A text that only the library can split is one whole."""
        if unknown_here(text):
            self._memo[_WHOLE + text] = np.array(
                self._library.encode(text, add_special_tokens=False).ids, dtype="<u4"
            ).tobytes()
            return [_WHOLE + text]
        if not any(token in text for token in self._added):
            return self._split(self._clean(text))
        words = []
        for i, part in enumerate(self._cut.split(text)):
            words += [part] if i % 2 else self._split(self._clean(part))
        return words

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        memo = self._memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
            memo.update(self._added)
        split = [self._words(t) for t in texts]
        missing = list(set().union(*split).difference(memo))
        memo.update(zip(missing, self._merges.packed(missing), strict=True))
        get = memo.__getitem__
        packed = [b"".join(map(get, words)) for words in split]
        for words in split:
            if words and words[0].startswith(_WHOLE):
                memo.pop(words[0], None)
        return packed


_ENCODERS: dict[tuple[str, bool, bool], Encoder] = {}


def encoder(path: str, byte_level: bool, added: bool = False) -> Encoder:
    """One encoder, and so one memo, per worker process."""
    key = (path, byte_level, added)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, byte_level, added)
    return _ENCODERS[key]


def id_lists(packed: list[bytes]) -> pa.ListArray:
    """Packed ids as an Arrow array of int lists, without a Python object per id."""
    offsets = np.zeros(len(packed) + 1, dtype=np.int32)
    np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(packed))])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Small pieces of the batches, so that few texts are held as Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts_of(column: pa.Array) -> list[str]:
    return [t if t is not None else "" for t in column.to_pylist()]


def token_lists(df: DataFrame, path: str, byte_level: bool, end_id: int | None, added: bool = False) -> DataFrame:
    """``doc_id`` and ``ids`` of a table with ``doc_id`` and ``text``; rows keep their order.

    A null text is an empty one. ``end_id`` closes every document. ``added``: see ``Encoder``.
    """
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, byte_level, added)
        for part in slices(batches):
            packed = [p + end for p in enc.encode(texts_of(part.column(1)))]
            yield pa.RecordBatch.from_arrays([part.column(0), id_lists(packed)], ["doc_id", "ids"])

    return df.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, ids array<int>"
    )
