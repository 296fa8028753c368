"""Licence scans by a generalised suffix automaton of licence words.

The automaton holds every substring of all templates and phrases.  A text's
words are streamed through it, which gives for each place the longest template
substring that ends there (matching statistics).  A phrase stands at a place if
it is a suffix of that substring.  Maximal matches of at least ``min_match``
words are chained in template order with small gaps; a chain that covers at
least ``min_cover`` of its template is a span with the template's label.  A
whole template is a span wherever it stands, also inside a longer match: like a
phrase it is found as a suffix of the substring that ends at its last word.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z in lower case.  A null
text counts as empty: no words, no places, empty labels, score 0.  ``score`` is
the largest covered share of any phrase or template.  Repeated rows get equal
results; null ids pass through; extra columns are not read; an empty table gives
an empty result.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.llm.common import prepare, slices, text_bytes

WORD_TABLE = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_TABLE).split()


class SuffixAutomaton:
    """Generalised suffix automaton of several word-id sequences."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        state_after = []
        for sequence in sequences:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
                state_after.append(last)
        # where each state's substrings end: (sequence, number of words up to there)
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.next]
        at = 0
        for s, sequence in enumerate(sequences):
            for i in range(len(sequence)):
                state = state_after[at]
                at += 1
                while state > 0:
                    self.ends[state].append((s, i + 1))
                    state = self.link[state]

    def _copy(self, state: int, length: int) -> int:
        self.next.append(dict(self.next[state]))
        self.link.append(self.link[state])
        self.length.append(length)
        return len(self.next) - 1

    def _extend(self, last: int, word: int) -> int:
        if (q := self.next[last].get(word)) is not None:
            if self.length[q] == self.length[last] + 1:
                return q
            return self._split(last, word, q)
        new = len(self.next)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        p = last
        while p != -1 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p != -1:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return new

    def _split(self, p: int, word: int, q: int) -> int:
        clone = self._copy(q, self.length[p] + 1)
        self.link[q] = clone
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone


class Scanner:
    """Phrases and templates compiled into one automaton."""

    def __init__(self, phrases: dict[str, str], templates: list[tuple[str, str]], min_match: int, min_cover: float,
                 max_gap: int):
        self.min_match, self.min_cover, self.max_gap = min_match, min_cover, max_gap
        own = [(label, words_of(p.encode())) for p, label in phrases.items()]
        others = [(label, words_of(t.encode())) for label, t in templates]
        self.vocabulary: dict[bytes, int] = {}
        ids = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for _, words in own + others]
        self.automaton = SuffixAutomaton(ids)
        self.phrases = len(own)
        self.labels = [label for label, _ in own + others]
        self.sizes = [len(x) for x in ids]
        # phrases and templates that are suffixes of a state's substrings, with their lengths
        a = self.automaton
        self.suffix: list[list[tuple[int, int]]] = [[] for _ in a.next]
        for p in [p for p in range(len(ids)) if p < self.phrases or len(ids[p]) >= min_match]:
            state = 0
            for w in ids[p]:
                state = a.next[state][w]
            self.suffix[state].append((p, len(ids[p])))
        for state in sorted(range(1, len(a.next)), key=a.length.__getitem__):
            self.suffix[state] += self.suffix[a.link[state]]

    def scan(self, text: bytes):
        """(words, phrase places [(start, phrase)], spans [(label, start, end, covered share)], best share)."""
        words = words_of(text)
        vocabulary, step = self.vocabulary, self.automaton.next
        link, length, suffix = self.automaton.link, self.automaton.length, self.suffix
        places, matches, whole = [], [], []
        state, size, before = 0, 0, -2
        for i, w in [(i, vocabulary[w]) for i, w in enumerate(words) if w in vocabulary]:
            if i != before + 1:
                if size >= self.min_match:
                    matches.append((before + 1, size, state))
                state, size = 0, 0
            grown = size
            while state and w not in step[state]:
                state = link[state]
                size = length[state]
            if size < grown and grown >= self.min_match:
                matches.append((i, grown, old))
            if w in step[state]:
                state = step[state][w]
                size += 1
            old, before = state, i
            for p, n in suffix[state]:
                if n <= size:
                    (places if p < self.phrases else whole).append((i - n + 1, p))
        if size >= self.min_match:
            matches.append((before + 1, size, state))
        spans, best = self._chains(matches)
        spans = self._with_whole(spans, whole)
        return len(words), places, spans, max(best, 1.0 if places or whole else 0.0)

    def _with_whole(self, spans, whole):
        """``spans`` and the whole templates [(start, template)] that no span of their label covers."""
        starts: dict[str, list[int]] = {}
        ends: dict[str, list[int]] = {}  # the farthest end of the spans up to each start
        for label, start, end, _ in spans:
            starts.setdefault(label, []).append(start)
            far = ends.setdefault(label, [])
            far.append(max(end, far[-1]) if far else end)
        out = set(spans)
        for start, t in whole:
            label, end = self.labels[t], start + self.sizes[t]
            at = bisect_right(starts.get(label, ()), start)
            if not at or ends[label][at - 1] < end:
                out.add((label, start, end, 1.0))
        return sorted(out, key=lambda s: (s[1], s[2], s[0]))

    def _chains(self, matches):
        """Chain the maximal matches [(end, words, state)] of each template; gaps are at most ``max_gap`` words."""
        found: dict[int, list[list[int]]] = {}  # template: [text start, text end, template end, covered]
        spans, best = [], 0.0

        def close(t, chain):
            nonlocal best
            share = chain[3] / self.sizes[t]
            best = max(best, share)
            if share >= self.min_cover:
                spans.append((self.labels[t], chain[0], chain[1], share))

        for end, size, state in matches:
            for t, t_end in self.automaton.ends[state]:
                if t < self.phrases:
                    continue
                open_chains = found.setdefault(t, [])
                near = [c for c in open_chains if end - size - c[1] <= self.max_gap]
                for c in open_chains:
                    if end - size - c[1] > self.max_gap:
                        close(t, c)
                follows = [c for c in near if c[2] < t_end and t_end - size - c[2] <= self.max_gap and c[1] < end]
                if follows:
                    c = max(follows, key=lambda c: c[3])
                    # words that the chain already covers, in the text or in the template, count once
                    c[3] += min(size, t_end - c[2], end - c[1])
                    c[1], c[2] = end, t_end
                else:
                    near.append([end - size, end, t_end, size])
                found[t] = near
        for t, chains in found.items():
            for c in chains:
                close(t, c)
        return sorted(set(spans), key=lambda s: (s[1], s[2], s[0])), best


def license_scan(docs: DataFrame, phrases: dict[str, str], templates: list[tuple[str, str]], min_match: int = 3,
                 min_cover: float = 0.8, max_gap: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, places, spans, score) for each row of ``docs``.

    ``places``: start word and label of each phrase; ``spans``: label, first
    word, word after the last and covered share of each chain.
    """
    spark = prepare(docs)
    shared = spark.sparkContext.broadcast(Scanner(phrases, templates, min_match, min_cover, max_gap))
    place = pa.struct([("start", pa.int64()), ("label", pa.string())])
    span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64())])

    def task(batches):
        scanner = shared.value
        for batch in slices(batches):
            found = [scanner.scan(t) for t in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array([x[0] for x in found], pa.int64()),
                pa.array([[{"start": s, "label": scanner.labels[p]} for s, p in x[1]] for x in found], pa.list_(place)),
                pa.array([[dict(zip(("label", "start", "end", "share"), s, strict=True)) for s in x[2]]
                          for x in found], pa.list_(span)),
                pa.array([min(1.0, x[3]) for x in found], pa.float64())],
                names=["id", "n_words", "places", "spans", "score"])

    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(
        task, f"id {docs.schema['id'].dataType.simpleString()}, n_words long, "
              "places array<struct<start: long, label: string>>, "
              "spans array<struct<label: string, start: long, end: long, share: double>>, score double"
    ).withColumnRenamed("id", id_col)
