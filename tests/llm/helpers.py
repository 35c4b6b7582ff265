"""Inputs and small brute-force versions for the tests of tidewater.llm."""

import collections
import itertools
import random
import re

ODD = [None, "", " \t\n", "x", "word " * 3, "é" * 50, "a\u0000b c", "ß ü 漢字 🙂 end"]


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def bag(text):
    w = spaced(text)
    return collections.Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else collections.Counter()


def classes(ids, texts, threshold=0.8):
    """Least id of each near-duplicate class, by comparing all pairs."""
    bags = [bag(t) for t in texts]
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(ids)), 2):
        shared, both = sum((bags[a] & bags[b]).values()), sum((bags[a] | bags[b]).values())
        if both and shared >= threshold * both:
            parent[find(b)] = find(a)
    least = {}
    for k in range(len(ids)):
        least[find(k)] = min(least.get(find(k), ids[k]), ids[k])
    return [least[find(k)] for k in range(len(ids))]


def kept_words(ids, texts, n=13):
    """Words that window removal leaves, and how many it removes."""
    words = [spaced(t) for t in texts]
    first = {}
    for d, w in zip(ids, words):
        for i in range(len(w) - n + 1):
            key = tuple(w[i:i + n])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, w in zip(ids, words):
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i:i + n])] < d:
                gone.update(range(i, i + n))
        out.append((len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out
