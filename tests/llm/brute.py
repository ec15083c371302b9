"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter


def repeats(rows, depth=100):
    """(doc, bytes, removed, spans, hash of what is left) with a set of all strings seen so far."""
    seen, out = set(), []
    for doc, text in sorted(((d, (t or "").encode()) for d, t in rows), key=lambda r: ((r[0] is not None), r[0] or 0, r[1])):
        gone = bytearray(len(text))
        for s in range(len(text) - depth + 1):
            window = text[s:s + depth]
            if window in seen:
                gone[s:s + depth] = b"\1" * depth
            seen.add(window)
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((doc, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


class Union:
    def __init__(self, ids):
        self.to = {i: i for i in ids}

    def find(self, i):
        while self.to[i] != i:
            self.to[i] = self.to[self.to[i]]
            i = self.to[i]
        return i

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.to[max(a, b)] = min(a, b)


def shingles(text, width):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(width))))


def jaccard(rows, width=3, part=90, whole=100):
    """(doc, shingles, component) by counting shared shingles through an index."""
    sets = {d: shingles(t, width) for d, t in rows}
    union, index = Union(sets), {}
    for d in sorted(sets):
        shared = Counter()
        for s in sets[d]:
            shared.update(index.get(s, ()))
            index.setdefault(s, []).append(d)
        for other, n in shared.items():
            if whole * n >= part * (len(sets[d]) + len(sets[other]) - n):
                union.join(d, other)
    return [(d, len(sets[d]), union.find(d)) for d in sorted(sets)]


def rows_of(df):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def bench_words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contaminated(docs, items, window=10):
    """(doc, words, hit words, items) with a dictionary of all windows."""
    wanted = {}
    for item, text in items:
        words = bench_words(text)
        n = min(window, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            wanted.setdefault(tuple(words[k:k + n]), set()).add("" if item is None else str(item))
    sizes, out = {len(w) for w in wanted}, []
    for doc, text in docs:
        words = bench_words(text)
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                items_of = wanted.get(tuple(words[k:k + n]))
                if items_of:
                    hit.update(range(k, k + n))
                    found |= items_of
        out.append((doc, len(words), sorted(hit), sorted(found)))
    return out


def phrases(rows, longest=4):
    """Counts of all phrases by lang, and of all words."""
    times, words = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))):
            found = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(found)
            for k in range(1, longest + 1):
                times.setdefault(lang, Counter()).update(zip(*(found[j:] for j in range(k))))
    return times, words


def collocations(rows, least, top):
    times, words = phrases(rows)
    out = []
    for lang, f in times.items():
        told = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            score, cut = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if not any(len(q) > len(p) and b >= least and 100 * b >= 80 * a and any(q[k:k + len(p)] == p for k in range(len(q))) for q, b in f.items() if b >= least):
                told.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        out += [(lang, k, p.decode(), -a, x, y, words[lang], -s) for k, (s, a, p, x, y) in enumerate(sorted(told)[:top], 1)]
    return sorted(out)


def variants(rows, shortest=7, every=31, ratio=10):
    """(word, form, root, n, near words, n of the form) by trying all pairs."""
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % every == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= shortest and k >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))
    out, form = [], {}
    told = {w: [v for v in n if abs(len(v) - len(w)) < 2 and near(w, v)] for w in n}
    for w, found in told.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(told[w]), n.get(form[w])))
    return sorted(out)


def noisy_or(text, weights):
    """(score, offending sentences) of a text by the definition, from the weights of its words and their first letters."""
    clean, offending = 1.0, []
    for m in re.finditer(r"[^.!?\n]+", text or ""):
        words = re.findall(r"[^\W\d_]+", m[0].lower())
        if words:
            z = weights[""] + sum(weights.get(f, 0.0) for w in words for f in [w, *(w[:n] + "^" for n in (4, 5) if len(w) >= n)])
            p = 1 / (1 + math.exp(-z)) if z > -700 else 0.0
            clean *= 1 - p
            offending += [f"{m.start()}:{m.end()}"] * (p >= 0.3)
    return 1 - clean, ",".join(offending) if 1 - clean >= 0.3 else ""
