"""BPE encoding and decoding of whole texts with contiguous rank arrays.

A piece of text that merges stay in starts as one part per byte. An array holds, part after part, the id of the part
that begins at each boundary; another one the rank of joining it with the part behind it. The arrays are scanned for
the least rank, the boundary behind it is deleted, and the ranks on both sides of the new part are looked up anew,
until no neighbours can be joined. Short pieces of like length are rows of one matrix, so a step serves all of them;
a longer piece has arrays of its own, where a heap of ranks takes the place of the scan.

Normalisation and the cutting into pieces follow the tokenizer's file (``tokens``); the merges are done here alone.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.llm import tokens
from hazardlens.llm import words as wd
from hazardlens.llm.storage import ship

#: Lengths of pieces, in bytes, that share a matrix; longer ones are merged one by one.
CLASSES = (4, 8, 12, 16, 24, 40, 64)
#: Pieces of a matrix.
ROWS = 16_384
#: The rank of parts that cannot be joined.
NONE = np.iinfo(np.int32).max


class RankEncoder(tokens.Encoder):
    """Ids by the merges of a byte-level BPE file."""

    def load(self) -> None:
        model = self.rules["model"]
        if model.get("type") != "BPE" or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("not a plain BPE file")
        if model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("unk_token"):
            raise ValueError("a BPE file of other rules")
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.inner = np.array([vocab[c] for c in self.bytes], dtype=np.int32)
        self.final = np.array([vocab[c + suffix] for c in self.bytes], dtype=np.int32)
        self.byte_of = {c: b for b, c in enumerate(self.bytes)}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([vocab[p[side]] for p in pairs], dtype=np.int64) for side in (0, 1))
        #: The id of no part.
        self.pad = max(vocab.values()) + 1
        keys = left * (self.pad + 1) + right
        # Of equal pairs the last one counts, as in a table that is filled in order.
        self.keys, place = np.unique(keys[::-1], return_index=True)
        self.ranks = (len(pairs) - 1 - place).astype(np.int32)
        self.joined = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        self.specials = {t["content"]: t["id"] for t in self.rules.get("added_tokens") or []}
        longest = sorted(map(regex.escape, self.specials), key=len, reverse=True)
        self.cut_specials = regex.compile("(" + "|".join(longest) + ")") if longest else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of joining these parts."""
        key = left.astype(np.int64) * (self.pad + 1) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge_short(self, ids: np.ndarray) -> np.ndarray:
        """Rows of parts, filled up with no parts to at least one column more than any row needs, all joined."""
        out, live, columns = np.full_like(ids, self.pad), np.arange(len(ids)), np.arange(ids.shape[1])
        ranks = np.full(ids.shape, NONE, dtype=np.int32)
        ranks[:, :-1] = self.rank(ids[:, :-1], ids[:, 1:])
        while len(live):
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(live)), at]
            more = least < NONE
            if not more.all():
                out[live[~more], : ids.shape[1]] = ids[~more]
                live, ids, ranks, at, least = live[more], ids[more], ranks[more], at[more], least[more]
                if not len(live):
                    break
            rows = np.arange(len(live))
            ids[rows, at] = self.joined[least]
            behind = columns[None, 1 : ids.shape[1]] > at[:, None]
            behind_last = behind[:, :-1]
            ids[:, 1:-1] = np.where(behind_last, ids[:, 2:], ids[:, 1:-1])
            ranks[:, 1:-1] = np.where(behind_last, ranks[:, 2:], ranks[:, 1:-1])
            ids[:, -1], ranks[:, -1] = self.pad, NONE
            ranks[rows, at] = self.rank(ids[rows, at], ids[rows, at + 1])
            inside = np.flatnonzero(at)
            before = at[inside] - 1
            ranks[inside, before] = self.rank(ids[inside, before], ids[inside, before + 1])
        return out

    def merge_long(self, ids: np.ndarray) -> np.ndarray:
        """The parts of one piece of any length, all joined."""
        part, count = ids.tolist(), len(ids)
        following, preceding = list(range(1, count + 1)), list(range(-1, count - 1))
        ranks = self.rank(ids[:-1], ids[1:]).tolist() + [NONE]
        heap = [(r, i) for i, r in enumerate(ranks) if r < NONE]
        heapq.heapify(heap)

        def refresh(i: int) -> None:
            j = following[i]
            ranks[i] = NONE
            if j < count:
                ranks[i] = int(self.rank(np.array(part[i : i + 1]), np.array(part[j : j + 1]))[0])
                if ranks[i] < NONE:
                    heapq.heappush(heap, (ranks[i], i))

        while heap:
            r, i = heapq.heappop(heap)
            if part[i] < 0 or ranks[i] != r:
                continue
            gone = following[i]
            part[i], part[gone], ranks[gone] = int(self.joined[r]), -1, NONE
            following[i] = following[gone]
            if following[i] < count:
                preceding[following[i]] = i
            refresh(i)
            if preceding[i] >= 0:
                refresh(preceding[i])
        return np.array([p for p in part if p >= 0], dtype=np.int32)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces end to end, and how many each has."""
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        parts = self.inner[data]
        full = sizes > 0
        parts[(starts + sizes - 1)[full]] = self.final[data[(starts + sizes - 1)[full]]]
        lengths, found, least = np.zeros(len(pieces), dtype=np.int64), [], 0
        for most in CLASSES:
            chosen = np.flatnonzero((sizes > least) & (sizes <= most))
            for k in range(0, len(chosen), ROWS):
                some = chosen[k : k + ROWS]
                held = np.arange(most + 1)[None, :] < sizes[some, None]
                ids = np.full(held.shape, self.pad, dtype=np.int32)
                ids[held] = tokens.ragged(parts, starts[some], sizes[some])
                ids = self.merge_short(ids)
                held = ids != self.pad
                lengths[some] = held.sum(axis=1)
                found.append((some, ids[held]))
            least = most
        for k in np.flatnonzero(sizes > least).tolist():
            ids = self.merge_long(parts[starts[k] : starts[k] + sizes[k]])
            lengths[k] = len(ids)
            found.append((np.array([k]), ids))
        begins, out = np.cumsum(lengths) - lengths, np.empty(int(lengths.sum()), dtype=np.uint32)
        for some, ids in found:
            out[tokens.ragged_places(begins[some], lengths[some])] = ids
        return out, lengths

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.merge([p.encode() for p in pieces])

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Words with special tokens or rare characters, or whole texts: the library's rules cut them into pieces."""
        normal, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        pieces, plan = [], []
        for word in words:
            parts = []
            for segment in self.cut_specials.split(word) if self.cut_specials else [word]:
                if segment in self.specials:
                    parts.append(self.specials[segment])
                elif segment:
                    segment = normal.normalize_str(segment) if normal else segment
                    found = [p for p, _ in cut.pre_tokenize_str(segment)]
                    parts.append((len(pieces), len(pieces) + len(found)))
                    pieces += [bytes(map(self.byte_of.__getitem__, p)) for p in found]
            plan.append(parts)
        ids, lengths = self.merge(pieces)
        upto = np.concatenate([[0], np.cumsum(lengths)])
        return [
            [k for p in parts for k in ([p] if isinstance(p, int) else ids[upto[p[0]] : upto[p[1]]].tolist())]
            for parts in plan
        ]


def _encode(vocabulary: str, remembered: int):
    def run(batches):
        for part, found in tokens.encoded(batches, vocabulary, remembered, RankEncoder):
            ids = pa.array([x.astype("<u4").tobytes() for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], ["doc_id", "ids"])

    return run


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = tokens.VOCABULARY,
    remembered: int = tokens.REMEMBERED,
) -> DataFrame:
    """``doc_id, ids`` per row: the ids of the whole text as little-endian unsigned 32-bit integers.

    A null or empty text has no ids (an empty ``ids``). Rows that repeat an id, or have none, are rows of their own;
    an empty table gives no rows. Other columns are not looked at. Special tokens that stand in a text become their
    own ids, as in the library. Each task remembers ids of words in ``remembered`` bytes.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(_encode(vocabulary, remembered), "doc_id long, ids binary")


def _decode(vocabulary: str):
    def run(batches):
        tokenizer = tokens.encoder(vocabulary, kind=RankEncoder).tokenizer
        # With no decoder in the file the tokens are set apart by a blank.
        plain = tokenizer.decoder is None
        size = tokenizer.get_vocab_size(with_added_tokens=True)
        shown = [tokenizer.id_to_token(k) for k in range(size)]
        signs = pa.array([t + " " if t is not None else "" for t in shown], pa.large_string())
        for batch in batches:
            for part in wd.slices(batch, "ids", 2 << 20):
                bounds = np.array([len(x or b"") // 4 for x in part.column("ids").to_pylist()], dtype=np.int64)
                ids = np.frombuffer(b"".join(x or b"" for x in part.column("ids").to_pylist()), dtype="<u4")
                known = ids < size
                ends = np.concatenate([[0], np.cumsum(known)])[np.concatenate([[0], np.cumsum(bounds)])]
                ids = ids[known]
                if plain:
                    data, at = wd.text_bytes(signs.take(pa.array(ids)))
                    at = at[ends]
                    texts = [data[a : max(a, b - 1)].tobytes().decode() for a, b in zip(at[:-1], at[1:], strict=True)]
                else:
                    texts = [
                        tokenizer.decoder.decode([shown[k] for k in ids[a:b].tolist()])
                        for a, b in zip(ends[:-1], ends[1:], strict=True)
                    ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())],
                    ["doc_id", "ids", "decoded"],
                )

    return run


def decode(encoded: DataFrame, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """``doc_id, ids, decoded`` of rows ``doc_id, ids``: the text that the ids stand for, special tokens included.

    Ids that the vocabulary does not hold are passed over. No ids, or null, give an empty text.
    """
    ship(encoded.sparkSession)
    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(_decode(vocabulary), "doc_id long, ids binary, decoded string")
