"""Token ids of many texts as one flat array, word by word over Arrow arrays.

For tokenizers that drop white space and encode words by themselves.  The texts
of a batch are lower-cased, cut at white space and dictionary-encoded by Arrow;
only different words reach the library, each once, and numpy gathers the ids of
all places.  Other tokenizers get whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from skyfare.llm.token_files import SIGNS, UNSETTLED, Encoder, _ends_settled

#: The complement of settled characters, as ``UNSETTLED`` of token_files, for Arrow's regular expressions.
UNSETTLED_RE2 = r"[^\x{0}-\x{12f}\x{131}-\x{24f}]"


def _strings(column: pa.Array) -> list[str]:
    """The column's strings; several times faster than its ``to_pylist``."""
    return column.to_numpy(zero_copy_only=False).tolist()


class RaggedEncoder(Encoder):
    """Ids of whole texts as (flat unsigned 32-bit ids, ends of the texts)."""

    #: Different words whose ids are kept; then the memory starts afresh.
    KEEP_WORDS = 1 << 20

    def __init__(self, content: bytes):
        super().__init__(content, 4)
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {"": 0}  # word -> its row in starts and sizes
        self.starts, self.sizes = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _keep(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Remember the ids of ``words``, which stand one after the other in ``ids``."""
        self.place.update(zip(words, range(len(self.starts), len(self.starts) + len(words))))
        self.starts = np.append(self.starts, len(self.flat) + np.cumsum(sizes) - sizes)
        self.sizes = np.append(self.sizes, sizes)
        self.flat = np.append(self.flat, ids.astype(np.uint32))

    def _letter_line(self, words: list[str]) -> None:
        """Words that are one pre-token each, encoded as one line."""
        found = self.library.encode(" ".join(words), add_special_tokens=False)
        of = np.array(found.word_ids, np.int64)
        if not len(of) or of[-1] != len(words) - 1:
            raise ValueError("a word of letters is not one pre-token")
        self._keep(words, np.array(found.ids), np.bincount(of, minlength=len(words)))

    def _sign_line(self, words: list[str]) -> None:
        """Any words without an added token: one line with an added token between them."""
        found = np.array(self.library.encode(self.between["content"].join(words), add_special_tokens=False).ids)
        cut = found == self.between["id"]
        of = np.cumsum(cut)[~cut]
        self._keep(words, found[~cut], np.bincount(of, minlength=len(words)))

    def _learn_words(self, words: list[str]) -> None:
        added = [a.decode() for a in self.added]
        line = " ".join(words)
        if any(a in line for a in added):
            odd = [w for w in words if any(a in w for a in added)]
            for w in odd:
                ids = np.frombuffer(self._texts([w])[0], np.uint32)
                self._keep([w], ids, np.array([len(ids)]))
            words = [w for w in words if w not in self.place]
        column = pa.array(words, pa.string())
        plain = pc.and_(pc.utf8_is_alpha(column), pc.invert(pc.match_substring_regex(column, UNSETTLED_RE2)))
        for kind, encode_line in ((plain, self._letter_line), (pc.invert(plain), self._sign_line)):
            own = _strings(column.filter(kind))
            for at in range(0, len(own), self.AT_ONCE):
                encode_line(own[at:at + self.AT_ONCE])

    def _words(self, column: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """(words, ends of the texts): texts cut at ASCII white space, in lower case where that can't change
        an added token or how a character and a mark after it are composed."""
        if self.to_lower:
            low = pc.ascii_lower(column)
            raw = low.cast(pa.binary() if low.type == pa.string() else pa.large_binary())
            keep = pc.or_(pc.match_substring(raw, b"\xcc"), pc.match_substring(raw, b"\xcd"))
            for a in self.lower_added:
                keep = pc.or_(keep, pc.match_substring(low, a.decode()))
            column = pc.if_else(keep, column, low)
        lists = pc.ascii_split_whitespace(column)
        return lists.flatten(), np.asarray(lists.offsets)[1:] - lists.offsets[0].as_py()

    def ragged(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends) of a column of valid UTF-8 without nulls: text i has the ids from ends[i - 1] to ends[i]."""
        if not self.by_word:
            found = [np.frombuffer(x, np.uint32) for x in self._texts(column.to_pylist())]
            return np.concatenate([np.zeros(0, np.uint32), *found]), np.cumsum([len(x) for x in found], dtype=np.int64)
        if len(self.place) > self.KEEP_WORDS:
            self._forget()
        words, ends = self._words(column)
        coded = words.dictionary_encode()
        parts = self._parts(coded.dictionary)  # for each different word its place and that of its last signs
        at = parts[np.asarray(coded.indices)].ravel()
        sizes = self.sizes[at]
        stop = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.starts[at] - stop + sizes, sizes) + np.arange(stop[-1] if len(stop) else 0)]
        return ids, np.append(0, stop)[2 * ends]

    def _parts(self, words: pa.Array) -> np.ndarray:
        """(core, signs) of each word as places; signs at the end, after a letter or digit, are a token of their own."""
        signs = SIGNS.decode()
        core = pc.utf8_rtrim(words, characters=signs)
        whole, cut = _strings(words), _strings(core)
        odd = [a.decode() for a in self.added]
        if any(a in " ".join(whole) for a in odd):  # a word with an added token is encoded as it is
            cut = [w if any(a in w for a in odd) else c for w, c in zip(whole, cut, strict=True)]
        tails = [""] * len(whole)
        for i in np.flatnonzero(np.asarray(pc.not_equal(words, core))).tolist():
            if len(cut[i]) < len(whole[i]):
                if _ends_settled(cut[i].encode()):
                    tails[i] = whole[i][len(cut[i]):]
                else:
                    cut[i] = whole[i]
        new = set(cut).union(tails).difference(self.place)
        if new:
            self._learn_words(list(new))
        get = self.place.__getitem__
        out = np.empty((len(whole), 2), np.int64)
        out[:, 0], out[:, 1] = list(map(get, cut)), list(map(get, tails))
        return out
