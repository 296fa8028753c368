"""Linear-chain conditional random field over words, as numpy arrays.

The words of many sequences stand one after the other in one stream.  It is cut
into equal blocks that forward-backward goes through side by side: transfer
matrices of all blocks first, then the state at each block's ends, then the
marginals inside the blocks.  Where a sequence starts the chain is reset, so
sequences may begin anywhere in a block.  The transfer matrices cost the third power of
the number of labels; with more than ``BLOCK_LABELS`` of them all sequences are
gone through side by side instead, a word at a time, with the same marginals.
"""

from __future__ import annotations

import numpy as np

BLOCK = 128
FLOOR = np.float32(1e-12)
BLOCK_LABELS = 48
#: Rows of the weight table that features are hashed into, at most; and its entries, so with more labels it has fewer rows.
BUCKETS_LOG2, TABLE_LOG2 = 18, 24
#: Words times labels that training holds at once, about.
CELLS = 1 << 25
#: Affixes of these lengths, n-grams of these lengths, with a salt for each kind.
AFFIXES, NGRAMS, LEXICON_SALT = (1, 2, 3), (2, 3), 97


def buckets_log2(labels: int) -> int:
    return min(BUCKETS_LOG2, TABLE_LOG2 - max(0, labels - 1).bit_length())


def _mixed(h: np.ndarray, log2: int) -> np.ndarray:
    """Bucket of 64-bit hashes (multiplicative mixing)."""
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - log2)).astype(np.int32)


def word_features(words: list[str], lexicon: np.ndarray,
                  log2: int = BUCKETS_LOG2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, index of the word of each, whole-word hashes).

    Features of a word: prefixes and suffixes, inner n-grams, and its lexicon
    entry if its hash is in the sorted array ``lexicon``.
    """
    size = np.fromiter(map(len, words), np.int64, len(words))
    code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), size)
    ends = np.cumsum(size)
    at = np.arange(len(code)) - (ends - size)[owner]  # place in the word
    left = size[owner] - at  # characters from here to the end
    prime, grams = np.uint64(0x9E3779B97F4A7C15), {1: code + np.uint64(1)}
    for n in range(2, 4):
        g = grams[n - 1][:-1] * prime + code[n - 1:] if len(code) >= n else code[:0]
        grams[n] = g
    buckets, owners = [], []

    def add(values, of, salt):
        buckets.append(_mixed(values * prime + np.uint64(salt), log2))
        owners.append(of)

    for n in AFFIXES:
        g = grams[n]
        first, last = at[:len(g)] == 0, left[:len(g)] == n
        fits = left[:len(g)] >= n
        add(g[first & fits], owner[:len(g)][first & fits], 10 + n)
        add(g[last], owner[:len(g)][last], 20 + n)
    for n in NGRAMS:
        g = grams[n]
        fits = left[:len(g)] >= n
        add(g[fits], owner[:len(g)][fits], 30 + n)
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(size.max(initial=1)), prime)]).astype(np.uint64))
    whole = np.add.reduceat((code + np.uint64(1)) * power[at], ends - size) if len(words) else code
    if len(lexicon):
        place = np.minimum(np.searchsorted(lexicon, whole), len(lexicon) - 1)
        known = np.flatnonzero(lexicon[place] == whole)
        add(whole[known], known, LEXICON_SALT)
    return np.concatenate(buckets), np.concatenate(owners), whole


def emissions(weights: np.ndarray, buckets: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    """(n, labels) scores: the sum of each word's feature weights."""
    return np.stack([np.bincount(owners, weights[buckets, y], n) for y in range(weights.shape[1])], axis=1)


def potentials(scores: np.ndarray) -> np.ndarray:
    return np.maximum(np.exp(scores - scores.max(axis=1, keepdims=True)), FLOOR).astype(np.float32)


def forward_backward(b: np.ndarray, start: np.ndarray, trans: np.ndarray, first: np.ndarray):
    """(alpha, beta, marginals) of the stream; ``b``: potentials, ``start``: where sequences begin."""
    n, k = b.shape
    if k > BLOCK_LABELS:
        return _by_sequence(b, start, trans.astype(np.float32), first.astype(np.float32))
    blocks = -(-n // BLOCK)
    pad = blocks * BLOCK - n
    b = np.concatenate([b, np.ones((pad, k), np.float32)]).reshape(blocks, BLOCK, k).transpose(1, 0, 2).copy()
    s = np.concatenate([start, np.ones(pad, bool)]).reshape(blocks, BLOCK).T.copy()
    trans, first = trans.astype(np.float32), first.astype(np.float32)

    def ahead(state, t):  # state: (..., blocks, k)
        out = state @ trans
        here = s[t]
        if here.any():
            out[..., here, :] = state[..., here, :].sum(axis=-1, keepdims=True) * first
        out *= b[t]
        return out

    product = np.tile(np.eye(k, dtype=np.float32)[:, None, :], (1, blocks, 1))  # (row, block, column)
    for t in range(BLOCK):
        product = ahead(product, t)
        product /= product.max(axis=(0, 2))[None, :, None]
    enter, leave = np.full((blocks, k), 1 / k, np.float32), np.full((blocks, k), 1 / k, np.float32)
    each = product.transpose(1, 0, 2).astype(np.float64)
    state = enter[0].astype(np.float64)
    for i in range(blocks - 1):
        state = state @ each[i]
        state /= state.sum()
        enter[i + 1] = state
    state = leave[-1].astype(np.float64)
    for i in range(blocks - 1, 0, -1):
        state = each[i] @ state
        state /= state.sum()
        leave[i - 1] = state
    alpha, beta = np.empty_like(b), np.empty_like(b)
    state = enter
    for t in range(BLOCK):
        state = ahead(state, t)
        state /= state.sum(axis=1, keepdims=True)
        alpha[t] = state
    state = leave
    back = trans.T.copy()
    for t in range(BLOCK - 1, -1, -1):
        beta[t] = state
        weighted = b[t] * state
        state = weighted @ back
        if s[t].any():
            state[s[t]] = 1 / k
        state /= state.sum(axis=1, keepdims=True)
    flat = [x.transpose(1, 0, 2).reshape(-1, k)[:n] for x in (alpha, beta)]
    gamma = flat[0] * flat[1]
    gamma /= gamma.sum(axis=1, keepdims=True)
    return flat[0], flat[1], gamma


def _by_sequence(b: np.ndarray, start: np.ndarray, trans: np.ndarray, first: np.ndarray):
    """``forward_backward`` over all sequences side by side; the stream's first word starts one."""
    n, k = b.shape
    begin = np.flatnonzero(start)
    size = np.diff(begin, append=n)
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    longer = np.searchsorted(-size, -np.arange(size[0] + 1), side="left")  # sequences with a word at each place
    alpha, beta = np.empty_like(b), np.full_like(b, 1 / k)
    for t in range(size[0]):
        at = begin[:longer[t]] + t
        state = (alpha[at - 1] @ trans if t else first) * b[at]
        alpha[at] = state / state.sum(axis=1, keepdims=True)
    back = trans.T.copy()
    for t in range(size[0] - 2, -1, -1):
        at = begin[:longer[t + 1]] + t
        state = (b[at + 1] * beta[at + 1]) @ back
        beta[at] = state / state.sum(axis=1, keepdims=True)
    gamma = alpha * beta
    gamma /= gamma.sum(axis=1, keepdims=True)
    return alpha, beta, gamma


def _parts(start: np.ndarray, labels: int) -> list[slice]:
    """The stream in whole sequences, about CELLS // labels words each."""
    begin, most, cuts = np.flatnonzero(start), max(1, CELLS // labels), [0]
    while len(start) - cuts[-1] > most:
        place = np.searchsorted(begin, cuts[-1] + most, side="right") - 1
        if begin[place] <= cuts[-1]:  # one sequence is longer
            place += 1
        if place == len(begin):
            break
        cuts.append(int(begin[place]))
    return [slice(a, z) for a, z in zip(cuts, [*cuts[1:], len(start)], strict=True)]


def train(words: list[str], word_of: np.ndarray, label: np.ndarray, start: np.ndarray, labels: int,
          lexicon_min: int = 2, rounds: int = 30, rate: float = 0.15, decay: float = 1e-3):
    """Fit by maximum likelihood (Adam); returns (weights, trans, first, lexicon).

    ``words``: the distinct words; ``word_of``, ``label``, ``start``: for each place of the stream.
    """
    _, _, whole = word_features(words, np.empty(0, np.uint64))
    seen = np.bincount(word_of, minlength=len(words))
    lexicon = np.unique(whole[seen >= lexicon_min])
    log2 = buckets_log2(labels)
    buckets, owners, _ = word_features(words, lexicon, log2)
    weights = np.zeros((1 << log2, labels), np.float32)
    trans, first = np.zeros((labels, labels)), np.zeros(labels)
    inner = np.flatnonzero(~start)
    pairs = np.zeros((labels, labels))
    np.add.at(pairs, (label[inner - 1], label[inner]), 1)
    params = [weights, trans, first]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    parts = _parts(start, labels)
    for step in range(1, rounds + 1):
        scores = potentials(emissions(weights, buckets, owners, len(words)))
        t, f = np.exp(trans - trans.max()), np.exp(first - first.max())
        by_word, grad_t, grad_f = np.zeros((len(words), labels)), -pairs, np.zeros(labels)
        for part in parts:
            b, of, begins = scores[word_of[part]], word_of[part], start[part]
            alpha, beta, rest = forward_backward(b, begins, t, f)
            rest[np.arange(len(of)), label[part]] -= 1
            for y in range(labels):
                by_word[:, y] += np.bincount(of, rest[:, y], len(words))
            inside = np.flatnonzero(~begins)
            ahead = b[inside] * beta[inside]
            before = alpha[inside - 1]
            total = ((before @ t.astype(np.float32)) * ahead).sum(axis=1, keepdims=True)
            grad_t = grad_t + (before / total).T.astype(np.float64) @ ahead * t
            grad_f = grad_f + rest[begins].sum(axis=0)
        grad_w = np.stack([np.bincount(buckets, by_word[owners, y], len(weights)) for y in range(labels)], axis=1)
        for p, g, (m, v) in zip(params, (grad_w, grad_t, grad_f), moments, strict=True):
            g = g / len(word_of) + decay * p / len(word_of)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-10)).astype(p.dtype)
    return weights, trans, first, lexicon
