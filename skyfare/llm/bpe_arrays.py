"""Rank-synchronous byte-level BPE over ragged numpy arrays.

Many pre-tokens stand one after the other in one flat array of symbols.  Every
round finds each sequence's lowest-ranked pair, merges all its places at once
(left to right where they overlap) and drops sequences that have no pair left.
What remains of a sequence are its tokens.

All places of a pair may be merged together because a pair with a merged symbol
always ranks after the merge that made the symbol; tables where that does not
hold (two merges with one product) are merged one place at a time.
"""

from __future__ import annotations

import json

import numpy as np
import regex

#: The byte-level pre-token pattern, with white space spelt out as the Unicode property.
PRE_TOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
             r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Up to here all Unicode versions agree which characters are letters or digits.
SETTLED = regex.compile(r"[^\u0000-ɏ]")
#: Texts of other characters than these are cut by the pattern as a whole.
UNUSUAL = regex.compile(r"[^\n !-~\u00a1-\u024f]")
NONE = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = {b: chr(b) for b in printable}, 256
    for b in range(256):
        if b not in out:
            out[b], spare = chr(spare), spare + 1
    return [out[b] for b in range(256)]


class ByteBpe:
    """Token counts of a byte-level BPE tokenizer given as its JSON file's content."""

    #: Pre-tokens (and pieces between spaces) whose counts are kept, about; then the memory starts afresh.
    KEEP = 1 << 19

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = (model["type"] == "BPE" and pre.get("type") == "ByteLevel" and not pre["add_prefix_space"]
                 and pre.get("use_regex", True) and not spec["normalizer"]
                 and not any(model.get(k) for k in ("dropout", "end_of_word_suffix", "continuing_subword_prefix",
                                                    "ignore_merges", "byte_fallback")))
        if not plain or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("only plain byte-level BPE files are supported")
        vocab = model["vocab"]
        self.byte_ids = np.array([vocab[c] for c in byte_letters()], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        order = np.argsort(left << 32 | right)
        self.keys, self.rank = (left << 32 | right)[order], order.astype(np.int32)
        self.made = made
        born = np.full(max(vocab.values()) + 1, -1, np.int64)
        born[made] = np.arange(len(made))
        at = np.arange(len(made))
        self.together = bool(len(np.unique(made)) == len(made) and (born[left] < at).all() and (born[right] < at).all())
        self.find = regex.compile(PRE_TOKEN).findall
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.content, self.library = content, None
        self.memory: dict[str, int] = {}  # by pre-token
        self.spaced: dict[str, int] = {}  # by what stands between two spaces, with the space before it

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NONE)

    def merged_lengths(self, sequences: list[bytes]) -> np.ndarray:
        """Number of symbols left of each non-empty byte sequence."""
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        out = lengths.copy()
        sym = self.byte_ids[np.frombuffer(b"".join(sequences), np.uint8)]
        owner = np.repeat(np.arange(len(sequences)), lengths)
        rank = np.full(len(sym), NONE, np.int32)  # of the pair that starts here
        fresh = np.flatnonzero(owner[:-1] == owner[1:])
        while True:
            rank[fresh] = self.ranks(sym[fresh], sym[fresh + 1])
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            if not len(starts):
                return out
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(starts, append=len(sym))
            out[owner[starts]] = sizes
            alive = np.repeat(least != NONE, sizes)
            if not alive.all():
                sym, owner, rank = sym[alive], owner[alive], rank[alive]
                least, sizes = least[least != NONE], sizes[least != NONE]
            if not len(sym):
                return out
            hit = rank == np.repeat(least, sizes)
            if not self.together:
                places = np.flatnonzero(hit)
                hit[places[1:][owner[places[1:]] == owner[places[:-1]]]] = False
            else:  # of overlapping places (a pair of two equal symbols) every second one
                places = np.flatnonzero(hit)
                follows = np.diff(places, prepend=-2) == 1
                if follows.any():
                    nth = np.arange(len(places))
                    run = np.maximum.accumulate(np.where(follows, 0, nth))
                    hit[places[(nth - run) % 2 == 1]] = False
            places = np.flatnonzero(hit)
            sym[places] = self.made[rank[places]]
            keep = np.ones(len(sym), bool)
            keep[places + 1] = False
            touched = np.zeros(len(sym), bool)
            touched[places] = True
            before = places - 1  # the symbol before, or before one just swallowed
            before = np.where(keep[before], before, before - 1)
            touched[before[before >= 0]] = True
            sym, owner, rank, touched = sym[keep], owner[keep], rank[keep], touched[keep]
            last = np.append(owner[:-1] != owner[1:], True)
            rank[last] = NONE
            fresh = np.flatnonzero(touched & ~last)

    def pre_tokens(self, text: str) -> list[str]:
        if SETTLED.search(text) is None:
            return self.find(text)
        if self.library is None:  # other scripts: the library's own Unicode tables decide
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_str(self.content.decode()).pre_tokenizer
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def units(self, text: str) -> list[str] | None:
        """The text cut before each space, those spaces left out; None if that could cut a pre-token.

        With single spaces and newlines only, a pre-token never goes on past the
        character before a space, so each piece can be counted by itself.
        """
        if UNUSUAL.search(text) or any(x in text for x in ("  ", " \n", "\n ", "\n\n")):
            return None
        return text.split(" ")

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text; strings of added tokens in a text are one token each."""
        out, spaced, bare = [0] * len(texts), {}, {}
        for i, text in enumerate(texts):
            parts = [text]
            if self.special is not None and self.special.search(text):
                parts = self.special.split(text)
                out[i] = len(parts) - 1
            for part in parts:
                pieces = self.units(part)
                if pieces is None:
                    bare.setdefault(i, []).extend(self.pre_tokens(part))
                elif part:
                    bare.setdefault(i, []).extend(self.find(pieces[0]))
                    spaced.setdefault(i, []).extend(pieces[1:])
        if len(self.memory) > self.KEEP:
            self.memory.clear()
        if len(self.spaced) > self.KEEP:
            self.spaced.clear()
        fresh = list(set().union(*spaced.values()).difference(self.spaced))
        cut = [self.find(" " + piece) for piece in fresh]
        new = list(set().union(*bare.values()).union(*cut).difference(self.memory))
        if new:
            self.memory.update(zip(new, self.merged_lengths([t.encode() for t in new]).tolist(), strict=True))
        get = self.memory.__getitem__
        self.spaced.update((piece, sum(map(get, tokens))) for piece, tokens in zip(fresh, cut, strict=True))
        for i, tokens in bare.items():
            out[i] += sum(map(get, tokens))
        get = self.spaced.__getitem__
        for i, pieces in spaced.items():
            out[i] += sum(map(get, pieces))
        return out
