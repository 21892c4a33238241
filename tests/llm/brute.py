"""Plain Python versions of the operators' contracts."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def crc_of_ids(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def roots(n, pairs):
    par = list(range(n))

    def find(a):
        while par[a] != a:
            par[a] = par[par[a]]
            a = par[a]
        return a

    for a, b in pairs:
        a, b = find(a), find(b)
        par[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def shingles(text, size):
    w = SPACED.findall((text or "").translate(LOW))
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def similar_pairs(sets, percent):
    seen, first, out = collections.defaultdict(list), {}, []
    for i, s in enumerate(sets):
        if not s:
            continue
        if s in first:
            out.append((first[s], i))
            continue
        first[s] = i
        for j, k in collections.Counter(j for x in s for j in seen[x]).items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                out.append((j, i))
        for x in s:
            seen[x].append(i)
    return out


def windows(items, size=13):
    out = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        m = min(size, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            out[tuple(w[k:k + m])].add(str(item))
    return out


def overlap(text, pats):
    w = words(text)
    hit, items = set(), set()
    for m in {len(p) for p in pats}:
        for k in range(len(w) - m + 1):
            if owners := pats.get(tuple(w[k:k + m])):
                items |= owners
                hit |= set(range(k, k + m))
    sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return len(w), len(hit), len(items), sha, len(hit) > 0 and 20 * len(hit) >= len(w)


PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))


def base_license(text):
    w = words(text)
    at = [(k, name) for p, name in PHRASES for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
    at.sort()
    return len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({n for _, n in at}))


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
