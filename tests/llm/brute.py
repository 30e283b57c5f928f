"""Plain versions of what the operators compute, for small inputs."""

import re

import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_classes(prints, ids):
    """Of each row the smallest id reachable over two differing bits."""
    root = {i: i for i in range(len(prints))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    small = {}
    for i in range(len(prints)):
        r = find(i)
        known = [x for x in (small.get(r), ids[i]) if x is not None]
        small[r] = min(known) if known else None
    return [small[find(i)] for i in range(len(prints))]


def bench_words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_contaminated(text, items, size=13):
    windows = set()
    for _, t in items:
        w = bench_words(t)
        windows.update(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1) if w else 0))
    w, hit = bench_words(text), set()
    for n in {len(x) for x in windows}:
        for k in range(len(w) - n + 1):
            if tuple(w[k : k + n]) in windows:
                hit.update(range(k, k + n))
    return len(hit) > 0 and 20 * len(hit) >= len(w)
