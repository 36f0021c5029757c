"""Brute-force counters, for small inputs only."""

from itertools import combinations


def itemsets(baskets, needed):
    vocabulary = sorted({i for b in baskets for i in b})
    out = {}
    for k in range(1, len(vocabulary) + 1):
        for c in combinations(vocabulary, k):
            n = sum(set(c) <= set(b) for b in baskets)
            if n >= needed:
                out[c] = n
    return out


def contains(pattern, sequence):
    i = 0
    for element in sequence:
        if i < len(pattern) and set(pattern[i]) <= set(element):
            i += 1
    return i == len(pattern)


def patterns(sequences, needed, max_items):
    """Grow by one item at a time; every frequent pattern has a frequent prefix."""
    items = sorted({i for s in sequences for e in s for i in e})
    out, level = {}, [()]
    for _ in range(max_items):
        grown = set()
        for p in level:
            for i in items:
                grown.add((*p, (i,)))
                if p and i > p[-1][-1]:
                    grown.add((*p[:-1], (*p[-1], i)))
        level = []
        for p in grown:
            n = sum(contains(p, s) for s in sequences)
            if n >= needed:
                out[p] = n
                level.append(p)
    return out
