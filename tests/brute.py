"""Slow and plain versions of the iterative jobs, to test against."""

import math
import re
from collections import OrderedDict


def word_list(texts, keep_space=False):
    pattern = r"\S+|\s+" if keep_space else r"\S+"
    return [w for text in texts for w in re.findall(pattern, text)]


def tallies(words):
    out = OrderedDict()
    for w in words:
        out[w] = out.get(w, 0) + 1
    return out


def glue(tokens, pair, new):
    out = []
    for t in tokens:
        if out and out[-1] is not None and (out[-1], t) == pair:
            out[-1:] = [new, None]  # None: a fresh symbol does not pair up again
        else:
            out.append(t)
    return [t for t in out if t is not None]


def learn(types, n_merges, by_score=False, prefix=""):
    """types: list of (tokens, freq) in corpus order."""
    types = [(list(t), f) for t, f in types]
    merges = []
    for _ in range(n_merges):
        pairs, single = OrderedDict(), {}
        for tokens, f in types:
            for t in tokens:
                single[t] = single.get(t, 0) + f
            for p in zip(tokens, tokens[1:]):
                pairs[p] = pairs.get(p, 0) + f
        if not pairs:
            break
        rate = {p: n / (single[p[0]] * single[p[1]]) if by_score else n for p, n in pairs.items()}
        top = max(rate.values())
        pair = next(p for p in rate if rate[p] == top)
        new = pair[0] + pair[1].removeprefix(prefix)
        merges.append((*pair, new))
        types = [(glue(t, pair, new), f) for t, f in types]
    return merges


def learn_indexed(types, n_merges, by_score=False, prefix=""):
    """The same as ``learn``, but only words that hold the merged pair are counted again."""
    words = [(list(t), f) for t, f in types]
    pairs, single, where = {}, {}, {}

    def count(n, sign):
        tokens, f = words[n]
        for t in tokens:
            single[t] = single.get(t, 0) + sign * f
        for p in zip(tokens, tokens[1:]):
            pairs[p] = pairs.get(p, 0) + sign * f
            where.setdefault(p, set()).add(n)

    def met(pair):
        for n in sorted(where[pair]):
            found = list(zip(words[n][0], words[n][0][1:]))
            if pair in found:
                return n, found.index(pair)

    for n in range(len(words)):
        count(n, 1)
    merges = []
    while len(merges) < n_merges:
        rate = {p: c / (single[p[0]] * single[p[1]]) if by_score else c for p, c in pairs.items() if c}
        if not rate:
            break
        top = max(rate.values())
        pair = min((p for p in rate if rate[p] == top), key=met)
        new = pair[0] + pair[1].removeprefix(prefix)
        merges.append((*pair, new))
        for n in list(where[pair]):
            count(n, -1)
            words[n] = (glue(words[n][0], pair, new), words[n][1])
            count(n, 1)
    return merges


def all_splits(word):
    if not word:
        return [[]]
    return [[word[:i], *rest] for i in range(1, min(len(word), 16) + 1) for rest in all_splits(word[i:])]


def best_split(word, logp):
    options = [s for s in all_splits(word) if all(p in logp for p in s)]
    if not options:
        return [c if c in logp else "<UNK>" for c in word]

    def total(split):
        score = 0.0
        for piece in split:
            score += logp[piece]
        return score

    return max(options, key=lambda s: (total(s), [len(p) for p in reversed(s)]))


def loss(types, logp):
    return sum(-f * sum(logp.get(p, math.log(1e-10)) for p in best_split(w, logp)) for w, f in types.items())


def pruned(types, seeds, target, special, ratio):
    logp = {**{s: math.log(1e-10) for s in special}, **seeds}
    while len(logp) > target:
        base = loss(types, logp)
        worth = [
            (round(loss(types, {k: v for k, v in logp.items() if k != t}) - base, 6), i, t)
            for i, t in enumerate(logp) if t not in special and len(t) > 1
        ]
        if not worth:
            break
        n = min(max(1, int(len(worth) * ratio)), len(logp) - target)
        for _, _, t in sorted(worth)[:n]:
            del logp[t]
    return logp
