"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def unigram(docs):
    """doc_id -> (held_out, n_tokens, n_known, N, base)."""
    held = lambda d: d is None or zlib.crc32(str(d).encode()) % 7 == 2
    counts = Counter()
    for d, t in docs:
        if not held(d):
            counts.update([*words(lowered(t)), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t in docs:
        own = [*words(lowered(t)), None]
        base = sum(math.log10((counts[w] + 1) / (n + 1 * (v + 1))) for w in own)
        out.append((d, held(d), len(own), sum(counts[w] > 0 for w in own), n, base))
    return out


def repeats(docs, window=13):
    first = {}
    for d, t in docs:
        w = words(t)
        if d is not None:
            for k in range(len(w) - window + 1):
                g = tuple(w[k : k + window])
                first[g] = min(first.get(g, d), d)
    out = []
    for d, t in docs:
        w = words(t)
        gone = set()
        if d is not None:
            for k in range(len(w) - window + 1):
                if first[tuple(w[k : k + window])] < d:
                    gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingle_set(text, n=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1)))


def near(docs, threshold=0.8):
    """[(doc_id, copy_of, n_links, class_id)]"""
    docs = [(d, shingle_set(t)) for d, t in docs if d is not None]
    heads = {}
    for d, s in docs:
        if s:
            heads[s] = min(d, heads.get(s, d))
    by = defaultdict(set)
    for s in heads:
        for g in s:
            by[g].add(s)
    links = defaultdict(set)
    for s in heads:
        common = Counter(o for g in s for o in by[g] if o != s)
        for o, n in common.items():
            if n >= threshold * (len(s) + len(o) - n) - 1e-9:
                links[s].add(o)
    label = {}
    for s in sorted(heads, key=heads.get):
        if s in label:
            continue
        todo, group = [s], set()
        while todo:
            x = todo.pop()
            if x not in group:
                group.add(x)
                todo += links[x]
        for x in group:
            label[x] = min(heads[y] for y in group)
    return [(d, heads[s], len(links[s]), label[s]) if s else (d, d, 0, d) for d, s in docs]


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def pii(text):
    """[(start, kind number, end)]"""
    found = []
    for k, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m[0] if c.isdigit()]
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            if kind == "card":
                doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
                if not 12 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            found.append((m.start(), k, m.end()))
    return sorted(found)


def quality_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    grams = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    cover = {i for k in range(len(w) - 7) if grams[tuple(w[k : k + 8])] > 1 for i in range(k, k + 8)}
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(cover),
    )
