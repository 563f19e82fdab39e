"""Plain restatements of what the operators return, for small inputs."""

import hashlib
import re
from collections import Counter

import xxhash


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def simhash(text):
    ws = words(lower(text or ""))
    parts = [" ".join(ws[i:i + 3]) for i in range(max(1, len(ws) - 2))] if ws else []
    hs = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def near_groups(prints, distance):
    """Smallest connected place for each fingerprint, all pairs compared."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= distance:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def without_repeats(texts, length):
    """(words, removed words, kept text) of each text."""
    all_words = [words(t) for t in texts]
    count = Counter(tuple(ws[i:i + length]) for ws in all_words for i in range(len(ws) - length + 1))
    out = []
    for ws in all_words:
        gone = set()
        for i in range(len(ws) - length + 1):
            if count[tuple(ws[i:i + length])] > 1:
                gone.update(range(i, i + length))
        out.append((len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return out


def targets(sizes, weights, most):
    """Shares by weight, capped at ``most`` times the size, the excess shared again."""
    capped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[k] for k in capped)
        share = sum(weights[k] for k in sizes if k not in capped)
        over = {k for k in sizes if k not in capped and rest * weights[k] > most * sizes[k] * share}
        if not over:
            return {k: most * sizes[k] if k in capped else rest * weights[k] / share for k in sizes}
        capped |= over


def smallest_capacity(sizes, shards):
    """Smallest capacity for contiguous shards, tried one by one from below."""
    c = max(max(sizes), -(-sum(sizes) // shards))
    while True:
        used, held = 1, 0
        for s in sizes:
            if held + s > c:
                used, held = used + 1, 0
            held += s
        if used <= shards:
            return c
        c += 1
