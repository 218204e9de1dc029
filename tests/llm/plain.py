"""Plain single-process versions of the operators, by definition rather than by method."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXT_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def roots(nodes, edges):
    """Least reachable node of each node."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def contamination(docs, items, window=13):
    """doc_id to (n_words, n_hit, n_items, digest, contaminated)."""
    known = defaultdict(set)
    for item, text in items:
        words = TEXT_WORD.findall(lower(text))
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            known[tuple(words[i : i + n])].add(str(item))
    lengths = {len(w) for w in known}
    out = {}
    for doc, text in docs:
        words, hit, found = TEXT_WORD.findall(lower(text)), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if (w := tuple(words[i : i + n])) in known:
                    hit.update(range(i, i + n))
                    found |= known[w]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc] = (len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words))
    return out


def rule_counts(text):
    words = SPACE_WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    seen, duplicates = set(), 0
    for line in (text or "").split("\n"):
        if SPACE_WORD.search(line):
            duplicates += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), duplicates, len(repeated)


def isolation(values, trees, size):
    """Isolation score of one row: a walk down each tree."""

    def walk(tree, at=0):
        feature, value, child, path = (column[at] for column in tree)
        return path if feature < 0 else walk(tree, child + (values[feature] >= value))

    harmonic = 2 * (math.log(size - 1) + 0.5772156649) - 2 * (size - 1) / size
    return 2 ** (-sum(walk(t) for t in trees) / len(trees) / harmonic)


def calibrated(good, bad, share, grid):
    """Of all limits that refuse at most ``share`` of the good scores, the highest with the largest gain."""
    best = (0, math.inf)
    for limit in (k / grid for k in range(grid + 2)):
        lost, found = (sum(math.floor(x * grid) >= round(limit * grid) for x in rows) for rows in (good, bad))
        if lost <= share * len(good):
            best = max(best, (found / len(bad) - lost / len(good), limit))
    return best[1]


def simhash(text):
    words = SPACE_WORD.findall(lower(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def linked(prints, bits=3):
    distinct = sorted(set(prints))
    return [(a, b) for i, a in enumerate(distinct) for b in distinct[i + 1 :] if (a ^ b).bit_count() <= bits]


def removed_lines(docs, min_words):
    """For each document, in the order given by its key, the numbers of the lines in maximal repeats of earlier lines."""
    spoken, gone, places = {}, {}, defaultdict(list)
    for key, text in docs:
        lines = [(i, tuple(SPACE_WORD.findall(x))) for i, x in enumerate((text or "").split("\n"))]
        own = spoken[key] = [(i, words) for i, words in lines if words]
        out = gone[key] = set()
        for k, (_, line) in enumerate(own):
            for other, j in places[line]:
                theirs, n = spoken[other], 0
                if j and k and theirs[j - 1][1] == own[k - 1][1]:
                    continue  # the repeat begins earlier
                while k + n < len(own) and j + n < len(theirs) and own[k + n][1] == theirs[j + n][1]:
                    n += 1
                if sum(len(words) for _, words in own[k : k + n]) >= min_words:
                    out |= set(range(own[k][0], own[k + n - 1][0] + 1))
            places[line].append((key, k))
    return gone


def padding(histogram, upper):
    return sum(n * (min(b for b in upper if b >= x) - x) for x, n in histogram.items())
