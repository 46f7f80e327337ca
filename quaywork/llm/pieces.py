"""SentencePiece encoding and decoding as a weighted finite-state transducer."""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain, pairwise
from math import inf

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywork.llm.common import packed, unpacked

MODEL = "/opt/tokenizers/piece_bpe_32k.model"

#: Field numbers and values of the public model format.  Fixed values.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MODEL_TYPE, UNIGRAM, BPE = 3, 1, 2
CHARSMAP, DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE = 2, 3, 4, 5
SPACE = "▁"
UNKNOWN_SURFACE = " ⁇ "
UNKNOWN_PENALTY = 10.0

#: A run of letters, a digit, or a run of anything else, with the spaces before it.
FINE = re.compile(rf"{SPACE}*(?:[^\W\d_]+|\d|(?:[^\w{SPACE}]|_)+)|{SPACE}+")
COARSE = re.compile(rf"{SPACE}*[^{SPACE}]+|{SPACE}+")
WHOLE = re.compile(r"(?s).+")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The (number, value) pairs of one message in the protocol buffer wire format."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if byte < 0x80:
                return value, at

    at = 0
    while at < len(data):
        head, at = number(at)
        kind = head & 7
        if kind == 0:
            value, at = number(at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = number(at)
            value, at = data[at : at + size], at + size
        yield head >> 3, value


class Transducer:
    """Normaliser, pieces and byte fallback compiled for composition with texts.

    A text is composed with the transducer one character at a time: an arc for
    every piece that ends there, and an arc to the bytes of a character that is
    no piece.  The shortest path in the tropical semiring is taken.

    In a unigram model an arc weighs minus the score of its piece.  In a BPE
    model the weights are on pairs: 0 if two neighbouring pieces stay apart when
    their joint text is merged, infinite if a merge crosses their border.  A
    merge across a border depends on the two pieces beside it alone, so the one
    path of finite weight is the segmentation that merging gives.

    No piece reaches across the cuts of ``FINE`` unless it holds one of the
    ``odd`` characters, and none across those of ``COARSE`` (both are verified
    when compiling), so a text is cut there, and each distinct cutting is
    composed once and remembered.
    """

    def __init__(self, model: bytes, remember: int = 200_000):
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        self.bpe, self.prefix = False, True
        for field, value in _fields(model):
            if field == PIECES:
                row = dict(_fields(value))
                self.pieces.append(row[PIECE_TEXT].decode())
                scores.append(struct.unpack("<f", row[PIECE_SCORE])[0] if PIECE_SCORE in row else 0.0)
                self.kinds.append(row.get(PIECE_TYPE, NORMAL))
            elif field == TRAINER:
                kind = dict(_fields(value)).get(MODEL_TYPE, UNIGRAM)
                if kind not in (UNIGRAM, BPE):
                    raise ValueError("only unigram and BPE models are supported")
                self.bpe = kind == BPE
            elif field == NORMALIZER:
                row = dict(_fields(value))
                self.prefix = bool(row.get(DUMMY_PREFIX, 1))
                if row.get(CHARSMAP) or row.get(REMOVE_EXTRA, 1) or not row.get(ESCAPE, 1):
                    raise ValueError("only the identity normaliser is supported")
        if USER_DEFINED in self.kinds or UNUSED in self.kinds:
            raise ValueError("user-defined and unused pieces are not supported")
        rows = list(zip(range(len(self.pieces)), self.pieces, self.kinds, strict=True))
        self.ids = {p: i for i, p, kind in rows if kind == NORMAL}
        self.scores = {p: scores[i] for p, i in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, p, kind in rows if kind == BYTE}
        self.unknown = next((i for i, _, kind in rows if kind == UNKNOWN), 0)
        self.penalty = UNKNOWN_PENALTY - min(self.scores.values(), default=0.0)
        #: The trie of the pieces: every prefix, and whether it is a piece itself.
        self.steps = {p[:n]: False for p in self.ids for n in range(1, len(p))}
        self.steps.update(dict.fromkeys(self.ids, True))
        crossing = [p for p in self.ids if FINE.match(p).end() < len(p)]
        self.odd = re.compile(f"[{re.escape(''.join({c for p in crossing for c in p if c.isalnum()}))}]") if (
            any(c.isalnum() for p in crossing for c in p)
        ) else None
        if any(COARSE.match(p).end() < len(p) for p in self.ids) or any(
            not any(c.isalnum() for c in p) for p in crossing
        ):
            self.cut = self.odd_cut = WHOLE
        else:
            self.cut, self.odd_cut = FINE, COARSE
        #: The next shorter piece that a piece begins with; a single character is always an arc.
        self.shorter = {
            p: next((p[:n] for n in range(len(p) - 1, 1, -1) if self.steps.get(p[:n])), p[0])
            for p in self.ids
            if len(p) > 1
        }
        self.apart = _Known(lambda pair: self._stay_apart(*pair), remember)
        self.parts: dict[str, tuple[str, str]] = {}
        self.wild = self._out_of_order() if self.bpe else None
        self.known = _Known(self.compose, remember)
        self.trie = self._trie()
        self.surfaces = [self._surface(i) for i in range(len(self.pieces))]

    def _trie(self) -> dict[str, tuple]:
        """The same trie by characters: each leads to (the next characters, the piece that ends here or None)."""
        leaf: dict[str, tuple] = {}
        below: dict[str, dict[str, tuple]] = {}
        for prefix in sorted(self.steps, key=len, reverse=True):
            node = below.pop(prefix, leaf), prefix if self.steps[prefix] else None
            below.setdefault(prefix[:-1], {})[prefix[-1]] = node
        return below.get("", leaf)

    def _out_of_order(self) -> re.Pattern | None:
        """What finds a piece that does not score below the parts it is made of (a trained one does)."""
        wild = [
            piece
            for piece, score in self.scores.items()
            if len(piece) > 1 and any(len(x) > 1 and self.scores.get(x, inf) <= score for x in self._halves(piece))
        ]
        return re.compile("|".join(map(re.escape, wild))) if wild else None

    def _surface(self, i: int) -> str:
        if self.kinds[i] == BYTE:
            byte = int(self.pieces[i][3:5], 16)
            return chr(byte) if byte < 0x80 else chr(0xDC00 + byte)
        if self.kinds[i] == CONTROL:
            return ""
        return UNKNOWN_SURFACE if self.kinds[i] == UNKNOWN else self.pieces[i].replace(SPACE, " ")

    def _halves(self, piece: str) -> tuple[str, str]:
        """The two parts whose merge makes a piece, remembered: the last merge within its own text."""
        found = self.parts.get(piece)
        if found is None:
            parts = list(piece)
            while len(parts) > 2:
                scored = [(-self.scores.get(x + y, -self.penalty), i) for i, (x, y) in enumerate(pairwise(parts))]
                at = min(scored)[1]
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            found = self.parts[piece] = parts[0], parts[1]
        return found

    def _merged_apart(self, left: str, right: str) -> bool:
        """The same by merging the joint text, the best pair first, until a part reaches across the border."""
        parts, border = list(left + right), len(left)
        while len(parts) > 1:
            score, at = max((self.scores.get(x + y, -inf), -i) for i, (x, y) in enumerate(pairwise(parts)))
            if score == -inf:
                break
            parts[-at : 2 - at] = [parts[-at] + parts[1 - at]]
            if border not in accumulate(map(len, parts)):
                return False
        return True

    def _stay_apart(self, left: str, right: str) -> bool:
        """Whether merging the joint text leaves the border between the two pieces.

        Pieces ``out of order`` are merged anew.  Otherwise the merges that made both pieces are undone, the last one (of the lower
        score, of equal ones the one further right) first.  At no moment may the
        two parts at the border make a piece that would have been merged before
        the merge just undone.
        """
        scores, none = self.scores, -self.penalty
        if left + right in scores:
            return False
        if self.wild is not None and self.wild.search(left + right):
            return self._merged_apart(left, right)
        while True:
            ours = scores.get(left, 0.0) if len(left) > 1 else inf
            theirs = scores.get(right, 0.0) if len(right) > 1 else inf
            if ours == theirs == inf:
                return True
            if theirs <= ours:
                right = self._halves(right)[0]
                if scores.get(left + right, none) >= theirs:
                    return False
            else:
                left = self._halves(left)[1]
                if scores.get(left + right, none) > ours:
                    return False

    def _longest(self, text: str, start: int) -> str:
        """The longest piece that begins here, at least one character."""
        below, best = self.trie, text[start]
        for character in text[start:]:
            node = below.get(character)
            if node is None:
                break
            below, piece = node
            if piece is not None:
                best = piece
        return best

    def _merged_path(self, text: str) -> list[str]:
        """The path of finite weight, sought depth first, longest arcs first.

        Every beginning of a text has one such path, so an end that was reached
        and could not be left is not tried again.
        """
        path: list[str] = []
        dead: set[int] = set()
        apart, shorter, start, size = self.apart, self.shorter, 0, len(text)
        piece: str | None = self._longest(text, 0)
        while True:
            while piece is not None:
                fits = start + len(piece) not in dead
                if fits and path:
                    fits = apart[path[-1], piece]
                if fits:
                    break
                piece = shorter.get(piece)
            if piece is None:
                dead.add(start)
                last = path.pop()
                start -= len(last)
                piece = shorter.get(last)
            else:
                path.append(piece)
                start += len(piece)
                if start == size:
                    return path
                piece = self._longest(text, start)

    def _cheapest_path(self, text: str) -> list[str]:
        cost, last = [0.0, *[float("inf")] * len(text)], ["", *[None] * len(text)]
        for start in range(len(text)):
            for end in range(start + 1, len(text) + 1):
                piece = text[start:end]
                score = self.scores.get(piece, -self.penalty if end == start + 1 else None)
                if score is not None and cost[start] - score < cost[end]:
                    cost[end], last[end] = cost[start] - score, piece
                if piece not in self.steps:
                    break
        return self._backwards(text, last)

    @staticmethod
    def _backwards(text: str, last: list[str | None]) -> list[str]:
        end, path = len(text), []
        while end:
            path.append(last[end])
            end -= len(last[end])
        return path[::-1]

    def compose(self, text: str) -> tuple[int, ...]:
        """The ids of one cutting of a normalised text."""
        out: list[int] = []
        for piece in self._merged_path(text) if self.bpe else self._cheapest_path(text):
            known = self.ids.get(piece)
            if known is not None:
                out.append(known)
            elif self.bytes:
                out.extend(self.bytes[b] for b in piece.encode())
            else:
                out.append(self.unknown)
        return tuple(out)

    def encode(self, text: str) -> array:
        ids = array("i")
        if text:
            normal = (SPACE if self.prefix else "") + text.replace(" ", SPACE)
            cut = self.odd_cut if self.odd is not None and self.odd.search(normal) else self.cut
            ids.extend(chain.from_iterable(map(self.known.__getitem__, cut.findall(normal))))
        return ids

    def decode(self, ids) -> str:
        """The text of piece ids; bytes that are no UTF-8 become U+FFFD, control pieces nothing."""
        text = "".join(map(self.surfaces.__getitem__, ids))
        try:
            text.encode()
        except UnicodeEncodeError:
            text = text.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


class _Known(dict):
    """Answers by what was asked, of a bounded number; those asked again outlive the others.

    When half of ``limit`` is reached, the answers become the older half, and
    the older half before them is dropped; an older answer asked again moves
    back.  Long texts are answered but not kept.
    """

    def __init__(self, answer, limit: int):
        super().__init__()
        self.answer, self.half, self.older = answer, max(limit // 2, 1), {}

    def __missing__(self, asked):
        found = self.older.pop(asked, None)
        if found is None:
            found = self.answer(asked)
        if len(asked) <= 40:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[asked] = found
        return found


_compiled: dict[str, Transducer] = {}


def _transducer(shared, name: str) -> Transducer:
    """One per Python worker and model."""
    if name not in _compiled:
        _compiled.clear()
        _compiled[name] = Transducer(shared.value)
    return _compiled[name]


class Tokenizer:
    """Columns that encode and decode with one model.

    The model file is read on the driver and broadcast; it is of fixed size,
    whatever the data.  ``path`` names it.
    """

    def __init__(self, spark: SparkSession, path: str = MODEL):
        with open(path, "rb") as file:
            data = file.read()
        self.shared = spark.sparkContext.broadcast(data)
        self.name = f"{path}:{len(data)}:{self.shared._jbroadcast.id()}"

    def encode(self, text: Column) -> Column:
        """Piece ids of a whole text; null and empty give none."""
        shared, name = self.shared, self.name

        @F.arrow_udf("array<int>")
        def piece_ids(texts: pa.Array) -> pa.Array:
            return _lists(_transducer(shared, name).encode(t.as_py() or "") for t in texts)

        return piece_ids(text)

    def decode(self, ids: Column) -> Column:
        """The text of piece ids; null gives an empty text."""
        shared, name = self.shared, self.name

        @F.arrow_udf("string")
        def piece_text(lists: pa.Array) -> pa.Array:
            fst = _transducer(shared, name)
            return pa.array([fst.decode(x.as_py() or ()) for x in lists], pa.string())

        return piece_text(ids)

    def checked(self, text: Column) -> Column:
        """Struct of ``ids`` and ``round_trip``: whether decoding them gives the text back."""
        shared, name = self.shared, self.name

        @F.arrow_udf("struct<ids: array<int>, round_trip: boolean>")
        def both(texts: pa.Array) -> pa.Array:
            fst, same = _transducer(shared, name), []

            def coded():
                for t in texts:
                    value = t.as_py() or ""
                    ids = fst.encode(value)
                    same.append(fst.decode(ids) == value.replace(SPACE, " "))
                    yield ids

            ids = _lists(coded())
            return pa.StructArray.from_arrays([ids, pa.array(same, pa.bool_())], ["ids", "round_trip"])

        return both(text)


def _lists(rows) -> pa.Array:
    values, ends = array("i"), array("i", [0])
    for row in rows:
        values.extend(row)
        ends.append(len(values))
    return pa.ListArray.from_arrays(
        pa.Array.from_buffers(pa.int32(), len(ends), [None, pa.py_buffer(ends)]),
        pa.Array.from_buffers(pa.int32(), len(values), [None, pa.py_buffer(values)]),
    )


def tokenize(docs: DataFrame, path: str = MODEL, text: str = "text") -> DataFrame:
    """Every document with ``ids``, ``n_pieces`` and ``round_trip``, without its text.

    Whole texts are encoded.  Null and empty texts: no ids, round trip true.
    A text that holds the space mark U+2581 decodes to plain spaces, which
    counts as a round trip.  Repeated rows: each is returned.  Columns that bear
    an added name are replaced.  Empty input: no rows.  No shuffle.
    """
    coded = packed(docs).withColumn("out", Tokenizer(docs.sparkSession, path).checked(F.col(f"row.`{text}`")))
    named = coded.select(
        "row",
        F.size("out.ids").cast("bigint").alias("n_pieces"),
        F.col("out.round_trip").alias("round_trip"),
        F.col("out.ids").alias("ids"),
    )
    return unpacked(named, ["n_pieces", "round_trip", "ids"], without=[text])
