"""SentencePiece merge-type encoding by backtracking, and decoding.

The encoder never builds a merge queue over the text. An Aho-Corasick automaton finds the longest
usable piece at every place in one pass. The encoder takes the longest piece, or the next shorter
one, that is compatible with the piece before it: two neighbours are compatible if merging their
joined text again gives exactly these two. Places from which no continuation exists are cleared
in a bitfield, so a long word is walked in linear time. A sequence whose neighbours are all
compatible is the one that merging by score (ties: leftmost first) gives.

A text is cut where no merge can cross: before a space mark that follows another character (no
piece holds one; checked on the model, else the cut is left out) and around characters that stand
alone in every piece, such as digits. An equal word is encoded once per task. All work is one
narrow stage; the model table (pieces and scores) travels with the function, words kept are
bounded by ``KEPT``.

Defined results: null and empty texts give the end id alone (no pieces) and decode to ''; a
repeated row is a row of its own; an empty table gives an empty table; columns of the caller are
kept, and a clashing column gives way to the operator's. Texts of any length are encoded whole.
Characters outside the vocabulary become byte pieces.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.llm.names import unused

MARK = "▁"  # fixed value: how a space is written inside pieces
KEPT = 300_000   # words (twice, with the older ones) and pairs that one task remembers
ROWS = 512       # texts whose ids are held at once, besides the batch they came in
LONGEST = 200    # words above this many characters are encoded anew each time
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # fixed values: kinds of pieces


@dataclass
class Vocabulary:
    """What encoding and decoding need of a model."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    end: int
    prefix: bool      # a space before the text
    cuts: bool        # no piece holds the mark behind another character

    def __post_init__(self):
        self.place = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == NORMAL}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces)
                      if self.kinds[i] == BYTE}

    def words(self) -> re.Pattern:
        """Words between which nothing merges: marks and joining characters, or one other."""
        joining = "".join(sorted({c for p in self.place if len(p) > 1 for c in p} - {MARK}))
        if not self.cuts:
            joining += MARK
        some = f"[{re.escape(joining)}]+"
        return re.compile(f"{MARK}*{some}|{MARK}+|[^{MARK}]" if joining else f"{MARK}+|[^{MARK}]",
                          re.DOTALL)

    def merge(self, text: str) -> tuple[list[str], int]:
        """Pieces of a short text by merging the best pair again and again, and the number of
        characters left of the seam that the last merge closed (0: there was none)."""
        parts, seam = list(text), 0
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.place.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or self.scores[found] > best):
                    best, at = self.scores[found], i
            if at < 0:
                break
            seam = len(parts[at])
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts, seam

    def usable(self) -> dict[str, int]:
        """Pieces that merging reaches, and characters that occur in pieces, with the place of
        their last seam."""
        found = {c: 0 for p in self.place for c in p}
        for piece in self.place:
            if len(piece) > 1:
                parts, seam = self.merge(piece)
                if parts == [piece]:
                    found[piece] = seam
        return dict(sorted(found.items()))


def load(path: str) -> Vocabulary:
    """Read a merge-type model with byte pieces and without text normalisation."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    rule, kind = model.normalizer_spec, model.trainer_spec
    kinds = [p.type for p in model.pieces]
    if (kind.model_type != 2 or not kind.byte_fallback or kind.treat_whitespace_as_suffix
            or rule.precompiled_charsmap or rule.remove_extra_whitespaces
            or not rule.escape_whitespaces or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}):
        raise ValueError("only merge-type models with byte pieces and plain text are supported")
    pieces = [p.piece for p in model.pieces]
    cuts = not any(a != MARK and b == MARK for p, k in zip(pieces, kinds) if k == NORMAL
                   for a, b in zip(p, p[1:]))
    return Vocabulary(pieces, [p.score for p in model.pieces], kinds, kind.eos_id,
                      rule.add_dummy_prefix, cuts)


class Encoder:
    """Encodes words; ``usable`` is the vocabulary's table of reachable pieces."""

    def __init__(self, vocabulary: Vocabulary, usable: dict[str, int]):
        self.vocabulary = vocabulary
        self.seams = usable
        self.usable = list(usable)
        self.automaton = ahocorasick.Automaton()
        place = {}
        for i, piece in enumerate(self.usable):
            place[piece] = i
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.size = [len(p) for p in self.usable]
        #: the longest usable piece that a piece begins with, besides itself; -1: none
        self.shorter = [next((place[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in place),
                             -1) for p in self.usable]
        self.ids = [self._ids(p) for p in self.usable]
        self.one = [i[0] if len(i) == 1 else None for i in self.ids]
        self.score = {p: vocabulary.scores[i] for p, i in vocabulary.place.items()}
        self.compatible = lru_cache(KEPT)(self._compatible)
        self.left, self.right = lru_cache(None)(self._left), lru_cache(None)(self._right)

    def _ids(self, piece: str) -> tuple[int, ...]:
        found = self.vocabulary.place.get(piece)
        if found is not None:
            return (found,)
        return tuple(self.vocabulary.bytes[b] for b in piece.encode())

    def _edge(self, piece: str, side: int):
        """The parts that stand at one edge of a piece while it is merged, each with the score
        of the merge that takes it in; None if some merge scores above one that it needs."""
        parts, taken = [], -math.inf
        while True:
            parts.append((piece, taken))
            seam = self.seams[piece]
            if not seam:
                return parts[::-1]
            taken = self.score[piece]
            halves = piece[:seam], piece[seam:]
            if any(len(h) > 1 and self.score[h] < taken for h in halves):
                return None
            piece = halves[side]

    def _left(self, i: int):
        return self._edge(self.usable[i], 0)

    def _right(self, i: int):
        return self._edge(self.usable[i], 1)

    def _compatible(self, a: int, b: int) -> bool:
        """Whether merging the joined text of two pieces gives the two again. Merges go by score,
        so only those at the seam are replayed: the parts beside it grow as in each piece alone,
        unless a merge across the seam comes first."""
        left, right = self.right(a), self.left(b)
        if left is None or right is None:
            left, right = self.usable[a], self.usable[b]
            return self.vocabulary.merge(left + right)[0] == [left, right]
        i = j = 0
        while True:
            (x, x_taken), (y, y_taken) = left[i], right[j]
            across = self.score.get(x + y)
            if across is not None and across > x_taken and across >= y_taken:
                return False
            if x_taken >= y_taken:
                i += 1
                if i == len(left):
                    return True
            else:
                j += 1

    def encode(self, word: str) -> tuple[int, ...]:
        """Ids of a word: the known stretches by backtracking, other characters as bytes."""
        longest = [-1] * len(word)
        size = self.size
        for end, i in self.automaton.iter(word):  # later matches of a start are longer
            longest[end - size[i] + 1] = i
        if -1 not in longest:
            taken = self._walk(longest, 0, len(word))
            single = tuple([self.one[i] for i in taken])
            return single if None not in single else tuple([k for i in taken for k in self.ids[i]])
        out: list[int] = []
        start = 0
        while start < len(word):
            if longest[start] < 0:
                out += self._ids(word[start])
                start += 1
                continue
            stop = start
            while stop < len(word) and longest[stop] >= 0:
                stop += 1
            for i in self._walk(longest, start, stop):
                out += self.ids[i]
            start = stop
        return tuple(out)

    def _walk(self, longest: list[int], start: int, stop: int) -> list[int]:
        """Compatible pieces from ``start`` to ``stop``, where every character is known; no match
        crosses ``stop``."""
        size, shorter, compatible = self.size, self.shorter, self.compatible
        # bit: the place has failed; one number for a word, bytes for a long stretch
        failed = 0 if stop - start <= LONGEST else bytearray((stop - start) // 8 + 1)
        short = isinstance(failed, int)
        taken: list[int] = []
        at, now, last = start, longest[start], -1
        while at < stop:
            while now >= 0:
                bit = at + size[now] - start
                gone = failed >> bit & 1 if short else failed[bit >> 3] >> (bit & 7) & 1
                if not gone and (last < 0 or compatible(last, now)):
                    break
                now = shorter[now]
            if now >= 0:
                taken.append(now)
                at += size[now]
                last = now
                now = longest[at] if at < stop else -1
            else:  # nothing fits here: the place has failed, shorten the piece before it
                bit = at - start
                if short:
                    failed |= 1 << bit
                else:
                    failed[bit >> 3] |= 1 << (bit & 7)
                now = taken.pop()
                at -= size[now]
                now = shorter[now]
                last = taken[-1] if taken else -1
        return taken


class Words(dict):
    """Ids of the words met so far; a new word is encoded when it is asked for. A full table
    becomes the older one, from which words that come again are taken over."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = self.older.get(word)
        if found is None:
            found = self.encoder.encode(word)
        if len(word) <= LONGEST:
            if len(self) >= KEPT:
                self.older = dict(self)
                self.clear()
            self[word] = found
        return found


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text",
           ids: str = "ids", end: bool = True) -> DataFrame:
    """The columns of ``docs`` without the text, and ``ids`` (array of ids; with the end id)."""
    usable = vocabulary.usable()
    whole = unused(docs, "_text")
    keep = [c for c in docs.columns if c not in (text, ids)]
    tail = [vocabulary.end] if end else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Words(Encoder(vocabulary, usable)).__getitem__
        cut = vocabulary.words().findall
        for batch in slices(batches):
            values, sizes = [], [0]
            for value in batch.column(whole):  # one text at a time
                value = value.as_py() or ""
                if value:
                    value = (MARK if vocabulary.prefix else "") + value.replace(" ", MARK)
                found = np.fromiter(chain(chain.from_iterable(map(of, cut(value))), tail),
                                    np.int32)
                values.append(found)
                sizes.append(sizes[-1] + len(found))
            flat = pa.array(np.concatenate(values) if values else np.zeros(0, np.int32))
            column = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], column],
                                             names=[*keep, ids])

    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias(whole))
    fields = [docs.schema[c] for c in keep]
    return source.mapInArrow(run, T.StructType(
        [*fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False))]))


class Decoder:
    """Text of ids: marks become spaces, byte pieces become characters, control ids vanish."""

    def __init__(self, vocabulary: Vocabulary):
        self.prefix = vocabulary.prefix
        self.kinds = vocabulary.kinds
        self.text = []
        for piece, kind in zip(vocabulary.pieces, vocabulary.kinds):
            if kind == BYTE:
                self.text.append(bytes([int(piece[3:5], 16)]))
            elif kind == CONTROL:
                self.text.append(b"")
            elif kind == UNKNOWN:
                self.text.append(" ⁇ ".encode())  # fixed value: how an unknown id is shown
            else:
                self.text.append(piece.replace(MARK, " ").encode())

    def decode(self, ids) -> str:
        ids = list(ids)
        while ids and self.kinds[ids[-1]] == CONTROL:
            ids.pop()
        parts = [self.text[i] for i in ids]
        try:
            out = self._lenient(ids) if b"" in parts else b"".join(parts).decode()
        except UnicodeDecodeError:
            out = self._lenient(ids)
        if self.prefix and out.startswith(" "):
            # the space before the text goes; a space that came as a byte stays
            first = next((i for i in ids if self.kinds[i] != CONTROL), None)
            if first is not None and self.kinds[first] == NORMAL:
                out = out[1:]
        return out

    def _lenient(self, ids) -> str:
        """Every byte that is no part of a character becomes one replacement character; only
        bytes side by side, without a control id between them, make up a character."""
        out, held = [], b""
        for i in [*ids, None]:
            if i is not None and self.kinds[i] == BYTE:
                held += self.text[i]
                continue
            while held:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(held[:n].decode())
                        held = held[n:]
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    held = held[1:]
            if i is not None:
                out.append(self.text[i].decode())
        return "".join(out)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids",
           text: str = "decoded") -> DataFrame:
    """The columns of ``encoded`` and the decoded text; null ids decode to ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary)
        for batch in slices(batches):
            made = [decoder.decode(v.values.to_numpy() if v.is_valid else ())
                    for v in batch.column(ids)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keep], pa.array(made, pa.large_string())],
                names=[*keep, text])

    keep = [c for c in encoded.columns if c != text]
    fields = [encoded.schema[c] for c in keep]
    return encoded.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(
        run, T.StructType([*fields, T.StructField(text, T.StringType())]))
