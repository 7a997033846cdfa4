"""Token ids of whole texts by a vocabulary file that drops white space."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tarmac.llm.kept import kept

_PIECES_PER_CALL = 200
#: Marks that are a piece of their own behind letters.
_MARKS = frozenset(".,;:!?")
#: How the vocabulary cuts lower-case ASCII text without white space into pieces.
_ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
#: Letters up to here have a lower case of one letter that does not depend on its neighbours.
_LAST_PLAIN = "\u024f"
_LARGEST = (1 << 64) - 1


def _bytes_of(characters: str) -> np.ndarray:
    held = np.zeros(256, bool)
    held[list(characters.encode())] = True
    return held


_ENDING = _bytes_of("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
_MARK = _bytes_of("".join(_MARKS))
_PARTING = _bytes_of(" \t\n")


def parted(texts: pa.Array) -> pa.Array:
    """Texts of the same ids in fewer different words: A-Z in lower case, a mark behind a letter or digit and before a blank by itself.

    Neither reaches across what the vocabulary looks at together: a mark behind
    letters or digits is a piece of its own.  A letter before a byte of another
    script keeps its case, as an accent may join it only in one case; so do all
    letters of an array that may hold special tokens.  Null becomes empty.
    """
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, ends, data = texts.buffers()
    if not len(texts) or data is None:
        return texts
    ends = np.frombuffer(ends, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].copy()
    ends = ends - ends[0]
    if len(raw) < 3:
        return texts
    at = np.flatnonzero(_MARK.take(raw[1:-1])) + 1
    at = at[_ENDING[raw[at - 1]] & _PARTING[raw[at + 1]]]
    if b"<|" not in raw.data.tobytes():
        upper = (raw[:-1] - np.uint8(ord("A")) < 26) & (raw[1:] < 128)
        raw[:-1] |= upper.view(np.uint8) << np.uint8(5)
    ends = (ends + np.searchsorted(at, ends)).astype(ends.dtype)
    array = pa.LargeStringArray if wide else pa.StringArray
    return array.from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(np.insert(raw, at, ord(" "))))


class Ids:
    """Ids of numbered things, one behind the other in one array."""

    def __init__(self, id_type: np.dtype):
        self.values = np.empty(1 << 20, id_type)
        self.starts = np.empty(1 << 18, np.uint32)
        self.lengths = np.empty(1 << 18, np.uint32)
        self.again = np.zeros(1 << 18, bool)  # asked for since it was added
        self.n = self.used = 0

    def add(self, values: np.ndarray, lengths: np.ndarray) -> None:
        while self.used + len(values) > len(self.values):
            self.values = np.concatenate([self.values, np.empty_like(self.values)])
        while self.n + len(lengths) > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.empty_like(x)]) for x in (self.starts, self.lengths))
            self.again = np.concatenate([self.again, np.zeros_like(self.again)])
        own = slice(self.n, self.n + len(lengths))
        self.values[self.used : self.used + len(values)] = values
        self.lengths[own] = lengths
        self.starts[own] = self.used + np.cumsum(lengths) - lengths
        self.used += len(values)
        self.n += len(lengths)

    def of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the things at ``places`` in turn, and where those of each end."""
        lengths = self.lengths[places].astype(np.int64)
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.starts[places].astype(np.int64) - (ends - lengths), lengths) + np.arange(total)
        return self.values[at], ends

    def only(self, places: np.ndarray) -> Ids:
        """The things at ``places``, numbered anew."""
        values, ends = self.of(places)
        kept = Ids(self.values.dtype)
        kept.add(values, np.diff(ends, prepend=0))
        return kept


def _used(names: dict[str, int], ids: Ids, most: int) -> tuple[list[str], np.ndarray]:
    """Names that have come again, and their places; none if they are more than ``most``."""
    again = ids.again.tolist()
    kept = [name for name, at in names.items() if again[at]]
    if len(kept) > most:
        kept = []
    return kept, np.array([names[name] for name in kept], np.int64)


class WholeTextEncoder:
    """Encodes texts word by word and remembers the ids of words and of their pieces.

    The vocabulary never joins characters across white space, so the ids of a
    text are those of its words in order; nor across the borders of its pieces
    (runs of letters, runs of marks, single digits), and it folds case, so the
    ids of a word are those of its pieces.  Pieces new to the encoder go to the
    tokenizers library many at a time, as one text whose word-end tokens tell
    them apart; words whose pieces take a closer look (other scripts with marks,
    odd white space, special tokens) go there by themselves.  At most
    ``max_words`` words and ``max_pieces`` pieces are remembered; then those
    that came once are forgotten, which changes the speed and never the ids.
    """

    def __init__(self, path: str, max_words: int = 400_000, max_pieces: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # what is left to do for pieces that are cut and folded already
        self.of_pieces = Tokenizer.from_file(path)
        self.of_pieces.normalizer = normalizers.Sequence([])
        self.of_pieces.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        ends = self.tokenizer.model.end_of_word_suffix
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[key for token, key in vocabulary.items() if ends and token.endswith(ends)]] = True
        self.has_ends = bool(ends)
        self.id_type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.max_words, self.max_pieces = max_words, max_pieces
        self.places: dict[str, int] = {}
        self.words = Ids(self.id_type)
        self.hashes = np.empty(1 << 18, np.uint64)
        self.pieces: dict[str, int] = {}
        self.of_piece = Ids(self.id_type)

    def _forget_words(self) -> None:
        """What has come again since it was learned stays, unless that is more than half."""
        words, at = _used(self.places, self.words, self.max_words // 2)
        self.hashes = np.append(self.hashes[at], np.empty(1 << 18, np.uint64))
        self.words = self.words.only(at)
        self.places = dict(zip(words, range(len(words))))

    def _forget_pieces(self) -> None:
        pieces, at = _used(self.pieces, self.of_piece, self.max_pieces // 2)
        self.of_piece = self.of_piece.only(at)
        self.pieces = dict(zip(pieces, range(len(pieces))))

    def _cut(self, word: str) -> list[str] | None:
        """The pieces of a word, in lower case; None if that takes a closer look."""
        if not self.has_ends or not word:
            return None
        low = word.lower()
        key = low if word.isascii() or (max(word) <= _LAST_PLAIN and len(low) == len(word)) else word
        if low.isalpha():
            return [key]
        if low[-1] in _MARKS and low[:-1].isalpha():
            return [key[:-1], key[-1]]
        if word.isascii() and word.isprintable() and "<|" not in word:
            return _ASCII_PIECES.findall(low)
        return None

    def _learn_pieces(self, pieces: list[str]) -> None:
        """Every piece stands alone between blanks, so each has one word-end token, its last."""
        folded = [piece for piece in pieces if piece.isascii() or max(piece) <= _LAST_PLAIN]
        others = [piece for piece in pieces if not (piece.isascii() or max(piece) <= _LAST_PLAIN)]
        for codec, some in ((self.of_pieces, folded), (self.tokenizer, others)):
            for at in range(0, len(some), _PIECES_PER_CALL):
                part = some[at : at + _PIECES_PER_CALL]
                (encoded,) = codec.encode_batch_fast([" ".join(part)], add_special_tokens=False)
                ids = np.array(encoded.ids, np.int64)
                ends = np.flatnonzero(self.is_end[ids])
                if len(ends) != len(part):
                    raise ValueError("a piece of letters or marks has more than one end")
                self.pieces.update(zip(part, range(self.of_piece.n, self.of_piece.n + len(part))))
                self.of_piece.add(ids, np.diff(ends, prepend=-1))

    def _unknown(self, wanted: dict[str, None]) -> list[str]:
        known = self.pieces.get
        at = np.fromiter([known(piece, -1) for piece in wanted], np.int64, len(wanted))
        self.of_piece.again[at[at >= 0]] = True
        return [piece for piece, place in zip(wanted, at.tolist()) if place < 0]

    def _learn(self, words: list[str]) -> None:
        from xxhash import xxh3_64_intdigest

        if self.has_ends:  # most words are plain letters
            cut = [[word.lower()] if word.isascii() and word.isalpha() else self._cut(word) for word in words]
        else:
            cut = [None] * len(words)
        wanted = dict.fromkeys(piece for pieces in cut if pieces is not None for piece in pieces)
        new = self._unknown(wanted)
        if self.pieces and len(self.pieces) + len(new) > self.max_pieces:
            self._forget_pieces()
            new = self._unknown(wanted)
        self._learn_pieces(new)
        for plain in (True, False):
            part = [word for word, pieces in zip(words, cut) if (pieces is not None) == plain]
            if not part:
                continue
            if plain:
                own = [pieces for pieces in cut if pieces is not None]
                places = np.array([self.pieces[piece] for pieces in own for piece in pieces], np.int64)
                ids, ends = self.of_piece.of(places)
                ends = np.append(0, ends)[np.cumsum([len(pieces) for pieces in own])]
            else:
                encoded = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
                ids = np.array([key for one in encoded for key in one.ids], np.int64)
                ends = np.cumsum([len(one.ids) for one in encoded])
            first = self.words.n
            self.words.add(ids, np.diff(ends, prepend=0))
            while self.words.n > len(self.hashes):
                self.hashes = np.concatenate([self.hashes, np.empty_like(self.hashes)])
            # a mark by itself is in every text, so it is never the smallest
            self.hashes[first : self.words.n] = [_LARGEST if word in _MARKS else xxh3_64_intdigest(word) for word in part]
            self.places.update(zip(part, range(first, self.words.n)))

    def _places(self, words: list[str]) -> np.ndarray:
        """Where the words are remembered, -1 where they are not."""
        known = self.places.get
        places = np.fromiter([known(word, -1) for word in words], np.int64, len(words))
        self.words.again[places[places >= 0]] = True
        return places

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in one array, the end of each text in it, and the smallest word hash of each.

        Words are parted at spaces, tabs and line feeds; other white space
        stays inside a word and is left to the vocabulary.  A text that is null
        or empty has no ids.
        """
        spaced = pc.fill_null(texts, "")
        for mark in ("\n", "\t"):
            spaced = pc.replace_substring(spaced, mark, " ")
        words = pc.split_pattern(spaced, " ")
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        places = self._places(distinct)
        missing = np.flatnonzero(places < 0)
        if len(missing):
            if self.places and len(self.places) + len(missing) > self.max_words:
                self._forget_words()
                places = self._places(distinct)
                missing = np.flatnonzero(places < 0)
            new = [distinct[at] for at in missing.tolist()]
            self._learn(new)
            places[missing] = [self.places[word] for word in new]
        places = places[coded.indices.to_numpy()]
        ids, ends = self.words.of(places)
        word_ends = np.cumsum(pc.list_value_length(words).to_numpy(), dtype=np.int64)
        text_ends = np.append(0, ends)[word_ends]
        # splitting gives every text one word at least, if an empty one
        least = np.minimum.reduceat(self.hashes[places], np.append(0, word_ends[:-1]))
        return ids, text_ends, least


#: Words a worker remembers where it does nothing else; some hundred bytes each.
REMEMBERED_WORDS = 700_000


def encoder(path: str, max_words: int = REMEMBERED_WORDS) -> WholeTextEncoder:
    """One encoder per Python worker, kept between tasks; its memory of pieces goes with that of words."""
    return kept((path, max_words), lambda: WholeTextEncoder(path, max_words, max_words * 6 // 7))


def slices(texts: pa.Array, size: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive ``(start, stop)`` of about ``size`` bytes of text, or one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield start, stop
        start = stop
