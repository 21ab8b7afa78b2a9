"""Brute-force versions that the operators are held against."""

import re
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text, width=5):
    words = WORD.findall((text or "").encode().lower())
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def components(nodes, links):
    """Smallest node reachable, by node."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard_components(texts):
    """doc_id -> component under 100 * intersection >= 75 * union, all pairs compared."""
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = sorted(sets)
    links = []
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                links.append((i, j))
    return components(ids, links), {i: len(s) for i, s in sets.items()}


def kneser_ney(train, order):
    """Interpolated modified Kneser-Ney over symbol lists: probability(context + symbol tuple)."""
    counts = {order: Counter()}
    for symbols in train:
        padded = [0] * (order - 1) + symbols
        for i in range(len(symbols)):
            counts[order][tuple(padded[i:i + order])] += 1
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    tables = {}
    for k, table in counts.items():
        of = Counter(table.values())
        n1, n2, n3, n4 = (of[i] for i in (1, 2, 3, 4))
        if n1 and n2 and n3 and n4:
            y = n1 / (n1 + 2 * n2)
            d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
            d = [min(max(v, 0.01), i + 0.99) for i, v in enumerate(d)]
        else:
            d = [0.5, 1.0, 1.5]
        total, spared = defaultdict(float), defaultdict(float)
        for g, c in table.items():
            total[g[:-1]] += c
            spared[g[:-1]] += d[min(c, 3) - 1]
        tables[k] = (table, d, total, spared)

    def probability(gram):
        if not gram:
            return 1 / 256
        table, d, total, spared = tables[len(gram)]
        low = probability(gram[1:])
        if gram[:-1] not in total:
            return low
        c = table.get(gram, 0)
        return ((c - d[min(c, 3) - 1] if c else 0.0) + spared[gram[:-1]] * low) / total[gram[:-1]]

    return probability
