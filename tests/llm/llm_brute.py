"""Plain readings of the contracts, for small inputs."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeats(docs):
    """docs: (key, bytes) in order -> key: n_bytes, n_removed, n_spans, sha256 of the rest."""
    seen, out = set(), []
    for key, text in docs:
        gone = bytearray(len(text))
        for p in range(len(text) - 99):
            piece = text[p:p + 100]
            if piece in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(piece)
        kept = bytes(b for b, g in zip(text, gone) if not g)
        runs = sum(1 for k in range(len(text)) if gone[k] and not (k and gone[k - 1]))
        out.append((key, len(text), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept))
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, longest, base_failed."""
    words = WORD.findall(text)
    n = len(words)
    windows = Counter(tuple(words[i:i + 5]) for i in range(n - 4))
    hit = set()
    for i in range(n - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            hit |= set(range(i, i + 5))
    longest = 0
    for i in sorted(hit):
        for j in range(i):
            size = 0
            while i + size < n and words[i + size] == words[j + size]:
                size += 1
            longest = max(longest, size if size >= 5 else 0)
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), longest,
            n < 10 or 100 * len(hit) > 20 * n)


def bag(text):
    words = WORD.findall(text)
    if len(words) < 5:
        return Counter([tuple(words)]) if words else Counter()
    return Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def classes(docs, similarity=0.8):
    """docs: id -> text; id -> smallest id that it is linked to."""
    bags = {i: bag(t) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(docs)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = sum((bags[a] & bags[b]).values())
            every = sum(bags[a].values()) + sum(bags[b].values()) - both
            if every and both >= similarity * every:
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in docs}


def leaks(docs, items, min_tokens=13, min_share=(4, 5)):
    """Pairs that agree at some shift, from an agreeing token to another, long and well enough."""
    def tokens(text):
        return re.findall(r"[a-z0-9]+", text.lower())

    def stretch(same):
        for i in (k for k, s in enumerate(same) if s):
            n = 0
            for j in range(i, len(same)):
                n += same[j]
                size = j + 1 - i
                if same[j] and size >= min_tokens and min_share[1] * n >= min_share[0] * size:
                    yield size, n

    out = {}
    for d, text in docs.items():
        a = tokens(text)
        for k, item in items.items():
            b = tokens(item)
            found = [x for shift in range(-len(b) + 1, len(a)) for x in stretch(
                [a[i + shift] == b[i] for i in range(max(0, -shift), min(len(b), len(a) - shift))])]
            if found:
                out[d, k] = max(found)
    return out
