"""Plain Python versions of the contracts, for the tests."""

import re
from collections import Counter

import xxhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def fingerprint(t):
    w = SPACE.findall(lower(t))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs))


def groups(fps, radius=2):
    """Smallest index reachable over links of at most ``radius`` bits."""
    best = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= radius and best[j] < best[i]:
                    best[i], changed = best[j], True
    return best


def rules(t):
    t = t or ""
    w = SPACE.findall(t)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if SPACE.search(line):
            dup += line in seen
            seen.add(line)
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t),
            "n_dup_lines": dup, "n_repeat_words": len(covered)}


def fewest_bins(sizes, cap):
    """Optimal number of bins by dynamic programming over subsets."""
    n = len(sizes)
    best = [(n + 1, 0)] * (1 << n)
    best[0] = (0, cap)
    for m in range(1 << n):
        used, fill = best[m]
        for i in range(n):
            if not m >> i & 1:
                nxt = (used, fill + sizes[i]) if fill + sizes[i] <= cap else (used + 1, sizes[i])
                best[m | 1 << i] = min(best[m | 1 << i], nxt)
    return best[-1][0]
