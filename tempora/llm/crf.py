"""Linear-chain conditional random field: training, Viterbi decoding, forward-backward.

The three operators that label sequences (DOM blocks, lines, words) share this small numeric
core. It works on score matrices: row = item of a sequence, column = label. A model is
emission weights over features, a transition matrix and start scores, all learned together by
maximum likelihood.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Chain:
    """weights: features x labels; trans: from x to; start: labels."""

    weights: np.ndarray
    trans: np.ndarray
    start: np.ndarray

    def emissions(self, items: np.ndarray, feats: np.ndarray, n: int) -> np.ndarray:
        """Scores of n items; feature feats[i] is on for item items[i]."""
        return np.stack([np.bincount(items, self.weights[feats, k], n) for k in range(self.weights.shape[1])], 1)


def _exp(scores: np.ndarray) -> np.ndarray:
    return np.exp(scores - scores.max(-1, keepdims=True)) + 1e-30


def _unit(x: np.ndarray) -> np.ndarray:
    return x / x.sum(-1, keepdims=True)


def fit(seqs: np.ndarray, mask: np.ndarray, labels: np.ndarray, items: np.ndarray, feats: np.ndarray, n_items: int, n_feats: int, n_labels: int, steps: int = 60, rate: float = 0.3, l2: float = 1e-4) -> Chain:
    """Maximum likelihood by Adam on whole batches.

    seqs: sequences x time, each entry the number of a distinct item; mask: which entries exist
    (a prefix of each row); labels: like seqs; items, feats: which features are on for each item.
    """
    s, t = seqs.shape
    total = max(1, int(mask.sum()))
    params = [np.zeros((n_feats, n_labels)), np.zeros((n_labels, n_labels)), np.zeros(n_labels)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    gold = np.eye(n_labels)[labels] * mask[..., None]
    pair_mask = mask[:, 1:, None, None]
    gold_pairs = np.einsum("sti,stj->ij", gold[:, :-1], gold[:, 1:] * mask[:, 1:, None])
    for step in range(1, steps + 1):
        chain = Chain(*params)
        e = _exp(chain.emissions(items, feats, n_items))[seqs]
        m, start = np.exp(chain.trans), np.exp(chain.start)
        alpha, beta = np.empty_like(e), np.ones_like(e)
        alpha[:, 0] = _unit(start * e[:, 0])
        for k in range(1, t):
            alpha[:, k] = _unit((alpha[:, k - 1] @ m) * e[:, k])
        for k in range(t - 2, -1, -1):
            back = _unit((e[:, k + 1] * beta[:, k + 1]) @ m.T)
            beta[:, k] = np.where(mask[:, k + 1, None], back, 1.0)
        post = _unit(alpha * beta) * mask[..., None]
        if t > 1:
            pairs = alpha[:, :-1, :, None] * m * (e * beta)[:, 1:, None, :]
            pairs = (pairs / pairs.sum((2, 3), keepdims=True) * pair_mask).sum((0, 1))
        else:
            pairs = np.zeros_like(m)
        diff = (post - gold).reshape(-1, n_labels)
        flat = seqs.reshape(-1)
        by_item = np.stack([np.bincount(flat, diff[:, k], n_items) for k in range(n_labels)], 1)
        grads = [np.stack([np.bincount(feats, by_item[items, k], n_feats) for k in range(n_labels)], 1), pairs - gold_pairs, (post[:, 0] - gold[:, 0]).sum(0)]
        for p, g, a, b in zip(params, grads, first, second, strict=True):
            g = g / total + l2 * p / 10
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return Chain(*params)


def viterbi(scores: np.ndarray, lengths: np.ndarray, chain: Chain) -> np.ndarray:
    """Best labels of many sequences laid end to end; lengths may be 0. Ties go to the lower label."""
    out = np.zeros(len(scores), np.int64)
    lengths = np.asarray(lengths, np.int64)
    begin = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    if not len(order):
        return out
    begin, lengths = begin[order], lengths[order]
    best = chain.start + scores[begin]
    back = []
    for k in range(1, int(lengths[0])):
        live = int(np.searchsorted(-lengths, -k))  # sequences of more than k items come first
        cand = best[:live, :, None] + chain.trans
        back.append(cand.argmax(1))
        best[:live] = cand.max(1) + scores[begin[:live] + k]
    now = best.argmax(1)
    for k in range(int(lengths[0]) - 1, -1, -1):
        live = int(np.searchsorted(-lengths, -k))
        out[begin[:live] + k] = now[:live]
        if k:
            now[:live] = back[k - 1][np.arange(live), now[:live]]
    return out


def marginals(scores: np.ndarray, lengths: np.ndarray, chain: Chain, block: int = 32) -> np.ndarray:
    """Label probabilities of every item by forward-backward, for many sequences laid end to end.

    Exact for any length: a sequence is cut into blocks, each block's product of transition
    matrices is formed for all blocks at once, the products carry the messages from block to
    block, and both passes then run inside all blocks at once.
    """
    n_labels = scores.shape[1]
    lengths = np.asarray(lengths, np.int64)
    lengths = lengths[lengths > 0]
    if not len(lengths):
        return np.zeros((0, n_labels))
    counts = -(-lengths // block)
    first = np.cumsum(counts) - counts  # first block of each sequence
    nb = int(counts.sum())
    seq = np.repeat(np.arange(len(lengths)), counts)
    part = np.arange(nb) - first[seq]
    at = (np.cumsum(lengths) - lengths)[seq] + part * block
    size = np.minimum(block, lengths[seq] - part * block)
    idx = at[:, None] + np.minimum(np.arange(block), size[:, None] - 1)
    on = np.arange(block) < size[:, None]
    e = _exp(scores)[idx]
    m, start = np.exp(chain.trans), np.exp(chain.start)
    head = part == 0
    prod = np.broadcast_to(np.eye(n_labels), (nb, n_labels, n_labels)).copy()
    for k in range(block):
        rows = on[:, k]
        step = (prod @ m) * e[:, k, None, :]
        if k == 0:
            step[head] = (start * e[head, 0])[:, None, :]
        step /= step.sum((1, 2), keepdims=True)
        prod = step if rows.all() else np.where(rows[:, None, None], step, prod)
    into, after = np.full((nb, n_labels), 1.0 / n_labels), np.ones((nb, n_labels))
    order = np.argsort(-counts, kind="stable")
    ranked = counts[order]
    for k in range(1, int(ranked[0])):
        b = first[order[: int(np.searchsorted(-ranked, -k))]] + k
        into[b] = _unit(np.einsum("bi,bij->bj", into[b - 1], prod[b - 1]))
    for k in range(int(ranked[0]) - 1, 0, -1):
        b = first[order[: int(np.searchsorted(-ranked, -k))]] + k
        after[b - 1] = _unit(np.einsum("bij,bj->bi", prod[b], after[b]))
    alpha = np.empty((block, nb, n_labels))
    now = into
    for k in range(block):
        step = (now @ m) * e[:, k]
        if k == 0:
            step[head] = start * e[head, 0]
        now = alpha[k] = np.where(on[:, k, None], _unit(step), now)
    out = np.empty((len(scores), n_labels))
    now = after
    for k in range(block - 1, -1, -1):
        rows = on[:, k]
        out[idx[rows, k]] = _unit(alpha[k][rows] * now[rows])
        now = np.where(rows[:, None], _unit((e[:, k] * now) @ m.T), now)
    return out
