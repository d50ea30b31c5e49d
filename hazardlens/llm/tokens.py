"""Token ids of whole texts by a tokenizer file; each distinct word of a slice of texts is looked at once.

Texts are cut at blanks, tabs and line ends, where the tokenizers served here (white space dropped, no merge reaches
over it) begin anew. Words are then cut into the pieces that merges stay in, by the pattern of the file, and the
library's model encodes each distinct piece. Words with characters beyond U+024F or special tokens, and all texts of
a file whose rules for pieces are others, go through the whole library.

Ids of a word are kept until a bound in bytes is reached or the task ends.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex

from hazardlens.llm import words as wd
from hazardlens.llm.storage import release

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Bytes of words, pieces and ids that a task remembers.
REMEMBERED = 96 << 20
#: What an entry of the memory takes besides its characters and ids.
ENTRY = 160
#: Bytes of text that a task looks at together: the first at most, or this part of what it remembers, but not less than
#: the last. Until they are in the memory, new words, pieces and ids of a slice take many times its size.
SLICE, SHARE, LEAST = 4 << 20, 16, 1 << 16

_PROBE = ["It's a Probe, Été don't 42 ab-cd; (x) é İI ΣΣ end.\n\nNew\tline <|endoftext|> ok!", "x²ª\xa0½'S a\x0bb\x85c", ""]
#: Bytes that no word holds.
_INSIDE = np.ones(256, dtype=bool)
_INSIDE[[9, 10, 13, 32]] = False
#: The rules for pieces that this module follows itself.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_PRETOKENIZERS = ["Split", "ByteLevel"]
_open: dict[tuple, Encoder] = {}


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = [chr(256 + k) for k in range(256)]
    for b in shown:
        out[b] = chr(b)
    for k, b in enumerate(b for b in range(256) if b not in set(shown)):
        out[b] = chr(256 + k)
    return out


def strings(column: pa.Array) -> list:
    return column.to_numpy(zero_copy_only=False).tolist()


def ragged_places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of runs that begin at ``starts``, end to end."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that begin at ``starts``, end to end."""
    return flat[ragged_places(starts, lengths)]


class Memory:
    """Runs of ids by name, in one growing array."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(1024, dtype=np.int64), np.zeros(1024, dtype=np.int64)
        self.flat, self.used, self.size = np.zeros(1 << 16, dtype=np.uint32), 0, 0

    def add(self, names: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        first, count = len(self.rows), len(names)
        while len(self.starts) < first + count:
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while len(self.flat) < self.used + len(ids):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.rows.update(zip(names, range(first, first + count), strict=True))
        self.starts[first : first + count] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first : first + count] = lengths
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.size += sum(map(len, names)) + 4 * len(ids) + ENTRY * count

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these rows end to end, and how many each has."""
        lengths = self.lengths[rows]
        return ragged(self.flat, self.starts[rows], lengths), lengths


class Encoder:
    """Ids of the texts of a column."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as source:
            self.rules = json.load(source)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.special = [t["content"] for t in self.rules.get("added_tokens") or []]
        self.bytes = byte_characters()
        self.remembered = REMEMBERED
        self.cuts = self._known_rules()
        self.load()
        self.rules = None
        self.forget()
        if self.cuts:
            here = self.encode(pa.array(_PROBE))
            self.cuts = all(a.tolist() == b for a, b in zip(here, self._whole(_PROBE), strict=True))
            self.forget()

    def load(self) -> None:
        """What else is needed of the file."""

    def _known_rules(self) -> bool:
        def steps(name, inner):
            rule = self.rules.get(name) or {}
            return rule.get(inner) or [rule]

        normal, pieces = steps("normalizer", "normalizers"), steps("pre_tokenizer", "pretokenizers")
        if [n.get("type") for n in normal] != _NORMALIZERS or [p.get("type") for p in pieces] != _PRETOKENIZERS:
            return False
        if pieces[0].get("behavior") != "Removed" or not pieces[0].get("invert") or pieces[1].get("use_regex"):
            return False
        self.pieces = regex.compile("\n|" + pieces[0]["pattern"]["Regex"])
        return True

    def forget(self) -> None:
        self.words, self.parts = Memory(), Memory()

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of words that the rules above do not cover."""
        return self._whole(words)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces end to end, and how many each has."""
        model, signs, ids, lengths = self.tokenizer.model, self.bytes, [], []
        for piece in pieces:
            if not (piece.isascii() and piece.isprintable()):
                piece = "".join([signs[b] for b in piece.encode()])
            found = [t.id for t in model.tokenize(piece)]
            ids += found
            lengths.append(len(found))
        return np.array(ids, dtype=np.uint32), np.array(lengths, dtype=np.int64)

    def _learn(self, new: list[str]) -> None:
        """Put the ids of words not met before into the memory."""
        plain = pc.match_substring_regex(pa.array(new, pa.large_string()), r"\A[\x00-\x{24F}]*\z")
        simple, other = [], []
        for w, known in zip(new, strings(plain), strict=True):
            special = "<" in w and any(s in w for s in self.special)
            (simple if known and not special else other).append(w)
        if simple:
            found = self.pieces.findall("\n".join(simple).lower())
            parts = pa.array(found, pa.large_string()).dictionary_encode()
            names = strings(parts.dictionary)
            missing = [p for p in names if p not in self.parts.rows and p != "\n"]
            if missing:
                self.parts.add(missing, *self.encode_pieces(missing))
            if "\n" not in self.parts.rows:
                self.parts.add(["\n"], np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64))
            row_of = np.array([self.parts.rows[p] for p in names], dtype=np.int64)
            codes = parts.indices.to_numpy()
            ids, lengths = self.parts.take(row_of[codes])
            ends = np.append(np.flatnonzero(row_of[codes] == self.parts.rows["\n"]), len(codes))
            upto = np.concatenate([[0], np.cumsum(lengths)])[ends]
            self.words.add(simple, ids, np.diff(upto, prepend=0))
        if other:
            found = self.encode_words(other)
            ids = np.array([k for x in found for k in x], dtype=np.uint32)
            self.words.add(other, ids, np.array([len(x) for x in found], dtype=np.int64))

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text; a null text has none."""
        if not self.cuts:
            return [np.array(x, dtype=np.uint32) for x in self.encode_words([t or "" for t in column.to_pylist()])]
        data, at = wd.text_bytes(column)
        starts, ends, first = wd.find(data, at, _INSIDE)
        if not len(starts):
            return [np.zeros(0, dtype=np.uint32)] * len(column)
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        joined = np.ascontiguousarray(data[_INSIDE[data]])
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(joined))
        words = words.dictionary_encode()
        names = strings(words.dictionary)
        if self.words.size + self.parts.size > self.remembered:
            self.forget()
        new = [w for w in names if w not in self.words.rows]
        if new:
            self._learn(new)
        rows = np.array([self.words.rows[w] for w in names], dtype=np.int64)[words.indices.to_numpy()]
        ids, lengths = self.words.take(rows)
        return np.split(ids, np.concatenate([[0], np.cumsum(lengths)])[first[1:-1]])


def encoder(path: str = VOCABULARY, remembered: int = REMEMBERED, kind: type[Encoder] = Encoder) -> Encoder:
    """The encoder of a file; one per worker process, kept for its later tasks without its memory of words."""
    if (path, kind) not in _open:
        _open[path, kind] = kind(path)
    _open[path, kind].remembered = remembered
    return _open[path, kind]


def encoded(batches, path: str, remembered: int = REMEMBERED, kind: type[Encoder] = Encoder) -> Iterator[tuple]:
    """Slices of the batches of a task, each with the ids of its column ``text``; the memory ends with the task.

    Where little is remembered, slices are small as well.
    """
    found, limit = encoder(path, remembered, kind), min(SLICE, max(LEAST, remembered // SHARE))
    try:
        for batch in batches:
            for part in wd.slices(batch, limit=limit):
                yield part, found.encode(part.column("text"))
    finally:
        found.forget()
        release()
