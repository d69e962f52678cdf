"""Encoding and decoding with a SentencePiece model of merge type, exactly as that library does, by backtracking.

**Encoding.** A text is normalised (a space in front, spaces as U+2581) and split where no piece can reach: in front of
each run of U+2581 and around characters that occur in no piece, which become their UTF-8 bytes' pieces. If some piece
holds U+2581 behind another character, only the latter splits. In each part, one pass of an Aho-Corasick automaton
over all pieces gives the longest piece from every position. From the left the longest piece is taken if it is compatible with the one
before it; else the next shorter piece is tried, which is a prefix of it. If none is left, the position is marked in a
bitfield as failed, the last piece is taken back, and its next shorter piece is tried; pieces that end at a failed
position are passed over, so each position fails once at most and work stays in proportion to the text. Two neighbours
are compatible if merging their characters anew, by best score and then leftmost, gives just these two pieces.

**Memory.** Parts of up to 64 characters are encoded once per worker and kept, as are checked pairs; both stores are
emptied when they are full, which changes no result.

**Decoding** joins the pieces, drops the leading space and control pieces, and reads runs of byte pieces as UTF-8, each
byte that does not fit as U+FFFD.

Defined cases: null texts count as empty, whose only id is the end id if asked for; repeated rows are encoded each; an
empty table gives an empty result; columns of the new names are replaced. Models with a normalisation table, with
user-defined pieces or with removal of spaces are refused, as the splits above would not hold.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Sequence
from itertools import chain, groupby

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lotbook.llm.text_arrays import per_text

SPACE = "▁"
LONGEST_KEPT = 64
MOST_PARTS = 1 << 19
MOST_PAIRS = 1 << 20
_LOADED: dict[str, PieceModel] = {}


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("lotbook_each_byte", _each_byte)


class PieceModel:
    """The pieces of one model file, with encoder and decoder."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.end = model.eos_id()
        self.unknown = model.unk_id()
        names = [model.id_to_piece(i) for i in range(size)]
        kinds = [
            "byte" if model.is_byte(i) else "unknown" if model.is_unknown(i) else "control" if model.is_control(i)
            else "unused" if model.is_unused(i) else "normal" for i in range(size)]
        sample = f" a  {SPACE}b ﬁ́ "
        if model.normalize(sample) != SPACE + sample.replace(" ", SPACE):
            raise ValueError(f"{path}: only models that keep texts as they are can be used")
        if "unused" in kinds:
            raise ValueError(f"{path}: models with unused pieces are not supported")
        self.ids = {names[i]: i for i in range(size) if kinds[i] == "normal"}
        self.scores = {names[i]: model.get_score(i) for i in range(size) if kinds[i] == "normal"}
        self.bytes = {int(names[i][3:5], 16): i for i in range(size) if kinds[i] == "byte"}
        self.shown = [self._shown(names[i], kinds[i]) for i in range(size)]
        self.controls = {i for i in range(size) if kinds[i] == "control"}
        self.spaced = {i for p, i in self.ids.items() if p[0] == SPACE}
        self.parts: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}
        self.names = names
        self.length = list(map(len, names))
        # Pieces that merging their own characters does not give are never used.
        self.usable = {p for p in self.ids if self.merged(p) == [p]}
        self.shorter = [self._prefix(p) if p in self.usable else -1 for p in names]
        self.automaton = ahocorasick.Automaton()
        for piece in self.usable:
            self.automaton.add_word(piece, self.ids[piece])
        self.automaton.make_automaton()
        letters = "".join(re.escape(c) for c in sorted(set("".join(self.ids)) - {SPACE}))
        inner = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.split = re.compile(
            f"[{letters}{SPACE}]+|[^{letters}{SPACE}]" if inner
            else f"{SPACE}*[{letters}]+|{SPACE}+|[^{letters}{SPACE}]").findall

    @staticmethod
    def _shown(name: str, kind: str) -> str:
        if kind == "byte":
            value = int(name[3:5], 16)
            return chr(value) if value < 128 else chr(0xDC00 + value)
        return {"control": "", "unknown": " ⁇ "}.get(kind, name.replace(SPACE, " "))

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging its characters, best score first and leftmost among equals."""
        symbols: list[str | None] = list(text)
        after, before = list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(left: int) -> None:
            if 0 <= left and after[left] < len(symbols):
                both = symbols[left] + symbols[after[left]]
                if both in self.scores:
                    heapq.heappush(heap, (-self.scores[both], left, both))

        for left in range(len(symbols) - 1):
            offer(left)
        while heap:
            _, left, both = heapq.heappop(heap)
            right = after[left]
            if symbols[left] is None or right >= len(symbols) or symbols[left] + symbols[right] != both:
                continue
            symbols[left], symbols[right] = both, None
            after[left] = after[right]
            if after[left] < len(symbols):
                before[after[left]] = left
            offer(before[left])
            offer(left)
        return [s for s in symbols if s is not None]

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the two pieces stay as they are when their characters are merged anew."""
        if len(self.pairs) >= MOST_PAIRS:
            self.pairs.clear()
        ends = [self.names[left], self.names[right]]
        found = self.pairs[left * len(self.names) + right] = self.merged("".join(ends)) == ends
        return found

    def _prefix(self, piece: str) -> int:
        """The longest shorter piece that the piece begins with, or -1."""
        for stop in range(len(piece) - 1, 0, -1):
            if piece[:stop] in self.usable:
                return self.ids[piece[:stop]]
        return -1

    def backtrack(self, part: str) -> list[int]:
        """The ids of a part, all of whose characters are pieces."""
        length, shorter, pairs, size = self.length, self.shorter, self.pairs, len(self.names)
        n = len(part)
        longest = [-1] * n
        for stop, piece in self.automaton.iter(part):  # ends ascend, so the longest piece from a place comes last
            longest[stop - length[piece] + 1] = piece
        failed = bytearray(n // 8 + 1)
        pieces: list[int] = []
        at, piece, last = 0, longest[0], -1
        while at < n:
            stop = at + length[piece]
            if not failed[stop >> 3] >> (stop & 7) & 1:
                fits = last < 0 or pairs.get(last * size + piece)
                if fits is None:
                    fits = self._compatible(last, piece)
                if fits:
                    pieces.append(piece)
                    at, last = stop, piece
                    piece = longest[at] if at < n else -1
                    continue
            piece = shorter[piece]
            while piece < 0:
                failed[at >> 3] |= 1 << (at & 7)
                last = pieces.pop()
                at -= length[last]
                piece = shorter[last]
                last = pieces[-1] if pieces else -1
        return pieces

    def _part(self, part: str) -> tuple[int, ...]:
        found = self.parts.get(part)
        if found is None:
            if part[0] in self.ids:
                found = tuple(self.backtrack(part))
            elif self.bytes:
                found = tuple(self.bytes[b] for b in part.encode())
            else:
                found = (self.unknown,)
            if len(part) <= LONGEST_KEPT:
                if len(self.parts) >= MOST_PARTS:
                    self.parts.clear()
                self.parts[part] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, without an end id."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        parts = self.split(SPACE + text.replace(" ", SPACE))
        return np.fromiter(chain.from_iterable(map(self._part, parts)), dtype=np.int32)

    def decode(self, ids: Sequence[int]) -> str:
        if self.controls.isdisjoint(ids):
            text = self._joined(ids)
        else:  # a control piece ends a run of bytes
            runs = groupby(ids, self.controls.__contains__)
            text = "".join(self._joined(list(run)) for control, run in runs if not control)
        first = next((i for i in ids if self.shown[i]), None)
        return text[1:] if first in self.spaced else text

    def _joined(self, ids: Sequence[int]) -> str:
        text = "".join(map(self.shown.__getitem__, ids))
        return text if text.isascii() else text.encode("utf-8", "surrogateescape").decode("utf-8", "lotbook_each_byte")


def model(path: str) -> PieceModel:
    """The model of a file, loaded once per worker."""
    if path not in _LOADED:
        _LOADED[path] = PieceModel(path)
    return _LOADED[path]


def encode(docs: DataFrame, path: str, text_col: str = "text", *, end: bool = True,
           keep: Sequence[str] | None = None) -> DataFrame:
    """Adds ``ids`` (array of int, with the end id if ``end``) and ``decoded``, the text those ids stand for (the
    end id stands for none).

    ``path`` names the model file on every executor. ``keep`` are the columns to keep, all if not given.
    """
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]

    def compute():
        pieces = model(path)
        tail = np.array([pieces.end] if end else [], dtype=np.int32)

        def work(texts: pa.Array) -> list[pa.Array]:
            plain = [pieces.encode(t or "") for t in texts.to_pylist()]
            decoded = pa.array([pieces.decode(i.tolist()) for i in plain], type=pa.string())
            ids = [np.append(i, tail) for i in plain]
            bounds = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = pa.array(np.concatenate(ids) if ids else tail[:0], type=pa.int32())
            return [pa.ListArray.from_arrays(pa.array(bounds), flat), decoded]

        return work

    return per_text(docs, text_col, fields, compute, docs.columns if keep is None else keep)
