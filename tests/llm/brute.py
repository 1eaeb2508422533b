"""Plain single-process versions of the operators' results, for small inputs."""

import hashlib
import math
import re
import zlib

BASE = {
    "assign": re.compile(r"""(?P<k>(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}
LATER = {
    "private_key": re.compile(r"-----BEGIN(?: [A-Z0-9]+)* PRIVATE KEY-----"),
    "jwt": re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
}


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def secrets(text):
    text = text or ""
    base = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in pattern.finditer(text):
            n = len(m[2]) if kind == "assign" else len(m[0])
            if n >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                base.append((m.start(), rank, m.end(), kind))
    more = [(m.start(), 3 + i, m.end(), k) for i, (k, p) in enumerate(LATER.items()) for m in p.finditer(text)]
    show = lambda spans: ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))
    count = lambda kind: sum(s[3] == kind for s in base)
    return count("assign"), count("access"), count("hex"), hashlib.sha256(show(base).encode()).hexdigest(), show(base + more)


def warc(rows):
    """rows of (page_id, html) -> {page_id: (bytes, digest, type, refers)}"""
    digests = {p: hashlib.sha1((h or "").encode()).hexdigest() for p, h in rows}
    sizes = {p: len((h or "").encode()) for p, h in rows}
    top = {}
    for p, d in digests.items():
        top[d] = max(top.get(d, p), p)
    out = {}
    for p, d in digests.items():
        again = sizes[p] >= 1000 and top[d] != p
        out[p] = (sizes[p], d, "revisit" if again else "response", top[d] if again else None)
    return out


def shingles(text, k):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", low(text)) if x]
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(rows, k, num, den):
    """rows of (id, text) -> {id: (n_shingles, component)}"""
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    shared = {}
    for ids in by.values():
        for n, a in enumerate(ids):
            for b in ids[:n]:
                shared[a, b] = shared.get((a, b), 0) + 1
    for (a, b), n in shared.items():
        if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def words13(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def contamination(docs, items, width=13):
    wins = {}
    for item, text in items:
        w = words13(text)
        for i in range(max(1, len(w) - width + 1)) if w else ():
            wins.setdefault(tuple(w[i : i + width]), set()).add(str(item))
    lengths = {len(w) for w in wins}
    out = {}
    for i, text in docs:
        w, hit, found = words13(text), set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                owners = wins.get(tuple(w[s : s + n]))
                if owners:
                    hit.update(range(s, s + n))
                    found |= owners
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[i] = (len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w))
    return out


def media(text):
    raw = (text or "").encode()
    pay = raw + b"\0" * (-len(raw) % 64 if raw else 64)
    return len(raw), len(pay), hashlib.sha256(pay).hexdigest(), zlib.crc32(pay[-64:])


def exponent(shares, repetition, least=1.0):
    """The exponent whose most repeated source is taken `repetition` times when the least repeated is taken `least` times."""
    lo, hi = 0.0, 1.0
    spread = lambda a: max(p ** (a - 1) for p in shares) / min(p ** (a - 1) for p in shares) * least
    if spread(0.0) <= repetition:
        return 0.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if spread(mid) > repetition else (lo, mid)
    return hi


def entropy(shares, a):
    z = sum(p**a for p in shares)
    return -sum(p**a / z * math.log(p**a / z) for p in shares if p)
