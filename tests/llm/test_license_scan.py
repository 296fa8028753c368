import random
import re

import pytest

from skyfare.llm.license_scan import Scanner, license_scan, words_of
from skyfare.llm.license_texts import PHRASES, TEMPLATES
from skyfare.llm.queries import op9_license_scan
from tests.llm.conftest import edge_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def test_words_of_edges():
    for _, t in edge_rows():
        assert [w.decode() for w in words_of((t or "").encode())] == brute_words(t)


@pytest.mark.parametrize("seed", range(5))
def test_phrases_and_matching_statistics(seed):
    rng = random.Random(seed)
    letters = "a b c".split()
    for _ in range(60):
        templates = [(f"t{i}", " ".join(rng.choice(letters) for _ in range(rng.randint(1, 9)))) for i in range(4)]
        phrases = {" ".join(rng.choice(letters) for _ in range(rng.randint(1, 3))): f"p{i}" for i in range(3)}
        scanner = Scanner(phrases, templates, 2, 0.8, 3)
        doc = [rng.choice(letters + ["z"]) for _ in range(30)]
        n, places, spans, best = scanner.scan(" ".join(doc).encode())
        assert n == 30 and sorted(places) == sorted(
            (i, k) for k, p in enumerate(phrases) for i in range(30) if doc[i:i + len(p.split())] == p.split())
        # the automaton holds just the substrings of all texts
        texts = [t.split() for t in [*phrases, *(x for _, x in templates)]]
        state, size = 0, 0
        a = scanner.automaton
        for i, w in enumerate(doc):
            w = scanner.vocabulary.get(w.encode())
            while state and w not in a.next[state]:
                state = a.link[state]
                size = a.length[state]
            state, size = (a.next[state][w], size + 1) if w in a.next[state] else (0, 0)
            longest = max(n for n in range(i + 2) if n == 0 or any(
                doc[i + 1 - n:i + 1] == t[j:j + n] for t in texts for j in range(len(t))))
            assert size == longest
        for _, template in templates:  # a whole template is always a span of full share
            if len(template.split()) >= 2:
                found = scanner.scan(("z z " + template + " z").encode())[2]
                assert any(s[1] <= 2 and s[2] >= 2 + len(template.split()) and s[3] == 1 for s in found)
        assert all(0 < s[3] <= 1 and 0 <= s[1] < s[2] <= 30 for s in spans) and 0 <= best <= 1


def test_edited_template():
    scanner = Scanner(PHRASES, TEMPLATES, 3, 0.8, 5)
    text = TEMPLATES[0][1].replace("without restriction", "without any restriction").replace("any person", "some person")
    _, places, spans, _ = scanner.scan(text.encode())
    assert not places and [s[0] for s in spans] == ["mit"] and spans[0][3] > 0.9
    assert scanner.scan(b"a text about the rights to use and to copy")[2] == []


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    for r in op9_license_scan(spark, "/root/testdata/sf0.01").collect():
        words = brute_words(docs[r.doc_id])
        places = [(i, label) for p, label in PHRASES.items() for i in range(len(words))
                  if words[i:i + len(p.split())] == p.split()]
        at = [i for i, _ in places]
        base = sorted({label for _, label in places})
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(words), len(places), min(at, default=None), max(at, default=None), ",".join(base))
        labels = r.labels.split(",") if r.labels else []
        assert set(base) <= set(labels) and labels == sorted(set(labels)) and 0 <= r.score <= 1


def test_edges_and_empty_table(edge_docs, no_docs):
    rows = license_scan(edge_docs, PHRASES, TEMPLATES).collect()
    assert len(rows) == len(edge_rows()) and all(r.score == 0 and not r.places for r in rows if not r.n_words)
    assert license_scan(no_docs, PHRASES, TEMPLATES).count() == 0


def labels_at(scanner, text):
    return {(s[0], s[1], s[2]) for s in scanner.scan(text.encode())[2] if s[3] == 1}


def test_nested_overlapping_and_shared_prefix_templates():
    scanner = Scanner({}, [("long", "x y z w v"), ("inner", "y z w"), ("prefix", "x y z"), ("cross", "w v u t"),
                           ("short", "z w")], 3, 0.8, 2)
    assert labels_at(scanner, "x y z w v") == {("long", 0, 5), ("inner", 1, 4), ("prefix", 0, 3)}
    assert labels_at(scanner, "q x y z w v u t") >= {("long", 1, 6), ("inner", 2, 5), ("prefix", 1, 4), ("cross", 4, 8)}
    assert ("inner", 1, 4) in labels_at(scanner, "q y z w q")


@pytest.mark.parametrize("seed", range(4))
def test_every_whole_template_is_in_a_span_of_its_label(seed):
    rng = random.Random(seed)
    for _ in range(60):
        templates = [(f"t{i}", " ".join(rng.choice("abc") for _ in range(rng.randint(2, 6)))) for i in range(5)]
        scanner = Scanner({}, templates, 2, 0.8, 3)
        doc = [rng.choice("abcz") for _ in range(40)]
        spans = scanner.scan(" ".join(doc).encode())[2]
        for label, template in templates:
            words = template.split()
            for i in range(len(doc) - len(words) + 1):
                if doc[i:i + len(words)] == words:
                    assert any(s[0] == label and s[1] <= i and s[2] >= i + len(words) for s in spans)
