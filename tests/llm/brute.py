"""Plain reference versions of the training-data operators for small inputs."""

import hashlib
import re
import zlib


def lower_az(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def crc(text):
    return zlib.crc32(str(text).encode())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower_az(text))


def shingles(text, size):
    w = words(text)
    n = min(size, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()


def near_components(rows, size, limit=80):
    """rows (id, text) → {id: smallest id reachable}, all pairs compared."""
    sets = [(i, shingles(t, size)) for i, t in rows]
    up = {i: i for i, _ in rows}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    by = {}
    for i, s in sets:
        for g in s:
            by.setdefault(g, []).append(i)
    size_of = {i: len(s) for i, s in sets}
    shared = {}
    for i, s in sets:
        for g in s:
            for j in by[g]:
                if j < i:
                    shared[i, j] = shared.get((i, j), 0) + 1
    for (i, j), n in shared.items():
        if 100 * n >= limit * (size_of[i] + size_of[j] - n):
            a, b = sorted((top(i), top(j)))
            up[b] = a
    return {i: top(i) for i, _ in rows}, size_of


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(digits[::-1]):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal_data(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                  "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
                  "phone": lambda: 9 <= len(digits) <= 15}[kind]()
            if ok:
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)
