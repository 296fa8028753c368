"""SentencePiece models as weighted finite-state transducers.

The normaliser (space mark, dummy prefix, optional removal of extra spaces) and
the pieces with byte fallback are compiled from the model file; a text composed
with them is a lattice whose arcs are the pieces that fit, and the encoding is
its shortest path in the tropical semiring.

Unigram models weight an arc by the piece's negative score.  BPE models merge
greedily, which is no sum of scores; there a state also remembers the piece that
led to it, and an arc weighs nothing if merging the two pieces' characters would
leave just these two, infinity if not.  A sequence is what the merging gives if
and only if that holds for all neighbours, so one path of finite weight is left
and it is the shortest.
"""

from __future__ import annotations

import math
import struct

import ahocorasick
import regex

MARK = "▁"
#: Stands between the parts that the automaton reads in one line; and their number, about.
SEPARATOR, LINE_PARTS = "\0", 1 << 15
#: Piece types of the model file (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes):
    """(field number, value) of a protocol-buffer message; values are ints or bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 0x7F) << shift
            if b < 0x80:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value = varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            value = data[at:at + size]
            at += size
        yield tag >> 3, value


class Spec:
    """What is needed of a model file."""

    def __init__(self, content: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        self.kind, self.byte_fallback = UNIGRAM, False
        self.dummy_prefix, self.remove_extra, self.escape = True, True, True
        for field, value in _fields(content):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0],
                                    piece.get(3, NORMAL)))
            elif field == 2:
                trainer = dict(_fields(value))
                self.kind, self.byte_fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
                if trainer.get(24, 0):
                    raise ValueError("models with the space mark as a suffix are not supported")
            elif field == 3:
                rule = dict(_fields(value))
                if rule.get(2):
                    raise ValueError("models with a character map are not supported")
                self.dummy_prefix, self.remove_extra = bool(rule.get(3, 1)), bool(rule.get(4, 1))
                self.escape = bool(rule.get(5, 1))
        if self.kind not in (UNIGRAM, BPE) or not self.escape or any(p[2] == USER_DEFINED for p in self.pieces):
            raise ValueError("only unigram and BPE models without user-defined pieces are supported")


class PieceTransducer:
    """Encoder and decoder of one model."""

    #: Units of a generation (the last two are kept), and neighbouring pieces, about.
    KEEP_UNITS, KEEP_PAIRS = 1 << 18, 1 << 19

    def __init__(self, content: bytes):
        self.spec = spec = Spec(content)
        self.ids = {p: i for i, (p, _, t) in enumerate(spec.pieces) if t in (NORMAL, UNUSED)}
        self.score = {p: s for p, s, t in spec.pieces if t in (NORMAL, UNUSED)}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(spec.pieces) if t == BYTE}
        self.unknown = next((i for i, p in enumerate(spec.pieces) if p[2] == UNKNOWN), 0)
        self.longest = max(map(len, self.ids), default=1)
        self.worst = min(self.score.values(), default=0.0) - 10.0
        # no piece goes on past a mark that follows another character: then words are encoded one by one
        self.by_word = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.units_of = regex.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.pairs: dict[str, dict[str, bool]] = {}
        self.kept = 0
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            self.automaton.add_word(p, (p, len(p)))
        self.automaton.make_automaton()
        self.characters = {p for p in self.ids if len(p) == 1}
        if any(SEPARATOR in p for p in self.ids) or self.spec.kind == BPE and not self.spec.byte_fallback:
            raise ValueError("BPE models without byte fallback, or with a zero character in a piece, are not supported")
        # no piece holds two characters side by side that are not among these: units can be cut there
        self.beside = {a + b for p in self.ids for a, b in zip(p, p[1:])}
        self.histories: dict[str, tuple] = {}
        self.out = [b"" if t == CONTROL else bytes([int(p[3:5], 16)]) if t == BYTE else
                    " ⁇ ".encode() if t == UNKNOWN else p.replace(MARK, " ").encode() for p, _, t in spec.pieces]

    # normaliser

    def normalise(self, text: str) -> str:
        if self.spec.remove_extra:
            text = regex.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return ((" " if self.spec.dummy_prefix else "") + text).replace(" ", MARK)

    # BPE arcs

    def _merge(self, symbols: list[str]):
        """Greedy merging; yields (score of the merge, first symbol, last symbol) after each step."""
        while len(symbols) > 1:
            best, at = -math.inf, -1
            for i in range(len(symbols) - 1):
                s = self.score.get(symbols[i] + symbols[i + 1])
                if s is not None and s > best:
                    best, at = s, i
            if at < 0:
                return
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            yield best, symbols[0], symbols[-1]

    def _history(self, piece: str):
        """(scores of its merges, its first and its last symbol before each and at the end), None if it isn't made."""
        if (h := self.histories.get(piece)) is None:
            symbols = list(piece)
            firsts, lasts, scores = [symbols[0]], [symbols[-1]], []
            for s, first, last in self._merge(symbols):
                scores.append(s)
                firsts.append(first)
                lasts.append(last)
            h = self.histories[piece] = (scores, firsts, lasts) if len(symbols) == 1 else (None, firsts, lasts)
        return h

    def together(self, left: str, right: str) -> bool:
        """Whether merging the characters of left + right gives these two pieces."""
        a, _, lasts = self._history(left)
        b, firsts, _ = self._history(right)
        if a is None or b is None:
            return False
        i = j = 0
        while True:
            own = a[i] if i < len(a) else -math.inf
            other = b[j] if j < len(b) else -math.inf
            across = self.score.get(lasts[i] + firsts[j], -math.inf)
            # best score first; of equals the leftmost
            if across > own and across >= other and across > -math.inf:
                return False
            if own == other == -math.inf:
                return True
            if own >= other:
                i += 1
            else:
                j += 1

    # shortest paths

    def _fits(self, before: str, piece: str) -> bool:
        return self.together(before, piece) if before else self._history(piece)[0] is not None

    def _bpe_paths(self, parts: list[str]) -> list[list[str]]:
        """The only finite path through each part; all characters must be pieces.

        The parts stand in one line that the automaton of all pieces reads once;
        it reports the arcs by the place where they end, longest first.  The
        state at a place is the piece before it, and of the arcs that end there
        just one fits the state that it comes from.
        """
        line, pairs, fits_of = SEPARATOR.join(parts), self.pairs, self._fits
        last: list[str | None] = [None] * (len(line) + 1)
        at = 0
        for part in parts:
            last[at] = ""
            at += len(part) + 1
        for end, (piece, size) in self.automaton.iter(line):
            if last[end + 1] is None:
                before = last[end + 1 - size]
                if (known := pairs.get(before)) is None:
                    known = pairs[before] = {}
                if (fits := known.get(piece)) is None:
                    fits = known[piece] = fits_of(before, piece)
                    self.kept += 1
                if fits:
                    last[end + 1] = piece
        out, start = [], 0
        for part in parts:
            path, at = [], start + len(part)
            while at > start:
                path.append(last[at])
                at -= len(last[at])
            out.append(path[::-1])
            start += len(part) + 1
        return out

    def _unigram_path(self, unit: str) -> list[str]:
        n = len(unit)
        best, last = [0.0] + [-math.inf] * n, [""] * (n + 1)
        for start in range(n):
            for end in range(start + 1, min(n, start + self.longest) + 1):
                piece = unit[start:end]
                s = self.score.get(piece, self.worst if end == start + 1 else None)
                if s is not None and best[start] + s > best[end]:
                    best[end], last[end] = best[start] + s, piece
        out, at = [], n
        while at:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]

    def _cut(self, unit: str) -> list[str]:
        """The unit cut where no piece can go across; characters that are no piece come out alone."""
        if not self.spec.byte_fallback:  # unknown characters in a row are one piece
            return [unit]
        if unit[1:].isalpha() and self.characters.issuperset(unit):
            return [unit]
        cuts = [i for i in range(1, len(unit)) if unit[i - 1:i + 1] not in self.beside]
        return [unit[a:b] for a, b in zip([0, *cuts], [*cuts, len(unit)])]

    def _ids_of(self, path: list[str]) -> bytes:
        out, unknown = [], False
        for piece in path:
            if (i := self.ids.get(piece)) is not None:
                out.append(i)
            elif self.spec.byte_fallback:
                out += [self.bytes[b] for b in piece.encode()]
            elif not unknown:  # neighbouring unknown characters are one unknown piece
                out.append(self.unknown)
            unknown = i is None
        return struct.pack(f"<{len(out)}i", *out)

    def _learn(self, units: list[str]) -> list[bytes]:
        """Ids of new units."""
        cut = [self._cut(u) for u in units]
        new = list({p for parts in cut for p in parts}.difference(self.parts))
        if self.spec.kind == UNIGRAM:
            self.parts.update((p, self._ids_of(self._unigram_path(p))) for p in new)
        else:
            whole = [p for p in new if self.characters.issuperset(p)]
            self.parts.update((p, self._ids_of([*p])) for p in new if not self.characters.issuperset(p))
            for at in range(0, len(whole), LINE_PARTS):
                some = whole[at:at + LINE_PARTS]
                self.parts.update(zip(some, map(self._ids_of, self._bpe_paths(some)), strict=True))
        get = self.parts.__getitem__
        return [get(parts[0]) if len(parts) == 1 else b"".join(map(get, parts)) for parts in cut]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian int32."""
        if len(self.memory) > self.KEEP_UNITS:
            self.memory, self.older, self.parts = {}, self.memory, {}
        if self.kept > self.KEEP_PAIRS:
            self.pairs.clear()
            self.kept = 0
        plain = self.by_word and self.spec.dummy_prefix
        found = []
        for text in texts:
            if plain and text and "  " not in text and text[0] != " " and text[-1] != " " and MARK not in text:
                found.append(text.split(" "))  # each with a mark before it
            else:
                line = self.normalise(text)
                units = self.units_of(line) if self.by_word else [line] if line else []
                # a unit with one mark before it is kept without it, any other with a space in front as a sign
                found.append([u[1:] if u[0] == MARK and MARK not in u[1:] else " " + u for u in units])
        new = set().union(*found).difference(self.memory)
        known = new.intersection(self.older)
        self.memory.update(zip(known, map(self.older.__getitem__, known), strict=True))
        if new := list(new.difference(known)):
            ids = self._learn([unit[1:] if unit[:1] == " " else MARK + unit for unit in new])
            self.memory.update(zip(new, ids, strict=True))
        get = self.memory.__getitem__
        return [b"".join(map(get, units)) for units in found]

    def decode(self, ids: list[int]) -> str:
        line = b"".join(map(self.out.__getitem__, ids)).decode(errors="replace")
        return line[1:] if self.spec.dummy_prefix and line[:1] == " " else line
