"""Token ids of whole texts by a byte-level vocabulary of the tokenizers library.

Texts are cut in front of every space that a word follows, and words of plain letters,
digits and signs between those - places where the vocabulary's pre-tokenizer always cuts.
Arrow's verifying hash table numbers the different pieces of a block of texts; only those
are looked up or merged, and their ids are dealt back by position. A worker remembers the
ids of a bounded number of pieces.
"""

from __future__ import annotations

import functools
import os
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import batches, ready

VOCABULARY = "byte_bpe_50k.json"
PIECES = 500_000  # pieces that a worker remembers
LONG = 200  # longer pieces are not remembered
BLOCK = 4 << 20  # bytes of text that are cut and numbered at once
_ASCII_SPACE = np.zeros(256, dtype=bool)
_ASCII_SPACE[[*range(9, 14), *range(28, 33)]] = True
_SPACE_HEAD = np.zeros(256, dtype=bool)  # first bytes of white space beyond ASCII
_SPACE_HEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_LETTER, _DIGIT, _SIGN, _SPACE, _ODD = range(5)
_CLASS = np.full(256, _ODD, dtype=np.uint8)
_CLASS[33:127] = _SIGN
_CLASS[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = _LETTER
# Latin-1, Latin Extended-A and Cyrillic up to U+047F are letters, but for two signs below.
_CLASS[[0xC3, 0xC4, 0xC5, 0xD0, 0xD1, *range(0x80, 0xC0)]] = _LETTER
_CLASS[[*b"0123456789"]] = _DIGIT
_CLASS[_ASCII_SPACE] = _SPACE
_CLASS[0x27] = _ODD  # contractions
#: Pieces that the pre-tokenizer leaves whole, and the characters that it writes for bytes.
_ONE = re.compile(
    rb" ?(?:(?:[A-Za-z]|[\xc4\xc5\xd0\xd1][\x80-\xbf]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+"
    rb"|[0-9]+|[!-&(-/:-@\[-`{-~]+)"
)
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_WRITTEN = {b: chr(0x100 + i) for i, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}


def cuts(data: np.ndarray) -> np.ndarray:
    """Positions of the spaces in UTF-8 bytes that something other than white space follows.

    What follows is looked at by its first two bytes beyond ASCII, three for general
    punctuation: a few characters are taken for white space that are not, which only makes
    pieces longer.
    """
    at = np.flatnonzero(data[:-1] == 0x20)
    at = at[~_ASCII_SPACE[data[at + 1]]]
    odd = _SPACE_HEAD[data[at + 1]]
    if odd.any():
        some = at[odd]
        one, two, three = (data[np.minimum(some + k, len(data) - 1)] for k in (1, 2, 3))
        space = (one == 0xC2) & ((two == 0x85) | (two == 0xA0))
        space |= (one == 0xE1) & ((two == 0x9A) | (two == 0xA0))
        space |= (one == 0xE2) & (two == 0x80) & ((three < 0x90) | (three >= 0xA8))
        space |= (one == 0xE2) & (two == 0x81)
        space |= (one == 0xE3) & (two == 0x80)
        odd[odd] = space
        at = at[~odd]
    return at


def bounds(data: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where pieces of some texts' bytes start, and the end; ``firsts``: where texts start.

    Words with characters of no known class, apostrophes or white space in a row stay whole.
    """
    word = np.zeros(len(data) + 1, dtype=bool)
    word[firsts] = word[-1] = True
    if len(data):
        word[cuts(data)] = True
    words = np.flatnonzero(word)
    if len(data) < 2:
        return words
    kind = _CLASS[data]
    odd = kind == _ODD
    odd[:-1] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    space = kind == _SPACE
    odd[1:] |= space[1:] & space[:-1] & ~word[1:-1]
    number = np.cumsum(word[:-1], dtype=np.int32) - 1  # of the word that a byte belongs to
    refined = np.ones(len(words) - 1, dtype=bool)
    refined[number[odd]] = False
    change = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    # The space in front of a word belongs to what follows.
    change = change[~(word[change - 1] & (data[change - 1] == 0x20))]
    change = change[refined[number[change]]]
    word[change] = True
    return np.flatnonzero(word)


def _listed(values: pa.LargeBinaryArray) -> list[bytes]:
    """The values (no nulls) as bytes: slices of one object, without a scalar a value."""
    offsets = np.frombuffer(values.buffers()[1], np.int64, len(values) + 1, values.offset * 8)
    if not len(values):
        return []
    data = values.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes()
    at = (offsets - offsets[0]).tolist()
    return [data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Little-endian 16-bit token ids of texts, as bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("token ids need 16 bits at most")
        pre = self.tokenizer.pre_tokenizer
        if not isinstance(pre, pre_tokenizers.ByteLevel) or pre.add_prefix_space:
            raise ValueError("a byte-level vocabulary without a leading space is needed")
        self.cut = pre.pre_tokenize_str
        self.merge = self.tokenizer.model.tokenize
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [str(t.content) for t in added]
        self.pieces: dict[bytes, bytes] = {}

    def _piece(self, piece: bytes) -> bytes:
        if _ONE.fullmatch(piece):
            text = piece.decode("latin-1")
            if not text.isascii():
                text = text.translate(_WRITTEN)
            elif text[0] == " ":
                text = _WRITTEN[0x20] + text[1:]
            ids = [t.id for t in self.merge(text)]
        else:
            ids = [t.id for part, _ in self.cut(piece.decode("utf-8")) for t in self.merge(part)]
        out = struct.pack(f"<{len(ids)}H", *ids)
        if len(piece) < LONG:
            if len(self.pieces) >= PIECES:
                self.pieces.clear()
            self.pieces[piece] = out
        return out

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u2").tobytes()

    def ids(self, text: str) -> bytes:
        return self.column(pa.array([text], pa.string()))[0][0]

    def column(self, texts: pa.Array, end: bytes = b"") -> tuple[list[bytes], np.ndarray]:
        """Ids of each text (no nulls), closed by ``end``, and their number."""
        texts = texts.cast(pa.large_binary())
        rows = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64, rows + 1, texts.offset * 8)
        held = texts.buffers()[2]
        data = np.frombuffer(held, np.uint8) if held else np.zeros(0, np.uint8)
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        firsts = offsets[:-1][np.diff(offsets) > 0]
        edges = bounds(data, firsts).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(edges) - 1,
            [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))],
        )
        numbered = pieces.dictionary_encode()
        known = self.pieces.get
        found = [known(p) or self._piece(p) for p in _listed(numbered.dictionary)]
        flat = np.frombuffer(b"".join(found), "<u2")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 2
        starts = np.cumsum(sizes) - sizes
        code = numbered.indices.to_numpy()
        size = sizes[code]
        ends = np.cumsum(size)
        # Token j of a piece lies at the piece's start in ``flat`` plus j.
        total = int(ends[-1]) if len(ends) else 0
        out = flat[np.arange(total) + np.repeat(starts[code] - (ends - size), size)].tobytes()
        upto = np.concatenate(([0], ends))[np.searchsorted(edges, offsets)] * 2
        ids = [out[a:b] + end for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
        if self.special:
            marked = np.zeros(rows, dtype=bool)
            for token in self.special:
                marked |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(marked).tolist():
                ids[i] = self._whole(texts[i].as_py().decode("utf-8")) + end
        return ids, np.fromiter(map(len, ids), np.int64, rows) // 2


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def tokenized(docs: DataFrame, keep: list[str], end: int, path: str | None = None) -> DataFrame:
    """``keep`` columns, ``ids`` (16-bit little-endian, closed by ``end``) and ``n_tokens``.

    A null text counts as empty, so every row has at least the closing id.
    """
    rows, encode = encoding(docs, keep, end, path)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[: len(keep)])
    return rows.mapInArrow(encode, f"{kept}, ids binary, n_tokens bigint")


def encoding(
    docs: DataFrame, keep: list[str], end: int, path: str | None = None
) -> tuple[DataFrame, Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]]:
    """The rows and the function of :func:`tokenized`, for callers that go on in the same worker.

    A second pass in Python has workers of its own, and each would learn all words anew.
    """
    ready(docs.sparkSession)
    path = path or vocabulary_path()
    rows = docs.select(*keep, F.coalesce("text", F.lit("")).alias("_text"))
    closing = int(end).to_bytes(2, "little")

    def encode(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder_ = encoder(path)
        for block in batches(frames, BLOCK, "_text"):
            part = block.combine_chunks().to_batches()[0]
            ids, sizes = encoder_.column(part.column(len(keep)), closing)
            columns = [part.column(i) for i in range(len(keep))]
            columns += [pa.array(ids, pa.binary()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "ids", "n_tokens"])

    return rows, encode
