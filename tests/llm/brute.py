"""Plain versions of the operators, for small inputs."""
import hashlib
import re
import unicodedata

import numpy as np
import xxhash

WS = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def classes(n, linked):
    """Smallest index reachable, per index; linked: pairs."""
    low = list(range(n))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i
    for a, b in linked:
        a, b = sorted((root(a), root(b)))
        low[b] = a
    return [root(i) for i in range(n)]


def exact(rows):
    """doc_id -> (keep_id, group_size, kept, sha) of rows (doc_id, text) with distinct ids."""
    groups = {}
    for i, t in rows:
        groups.setdefault(WS.sub(" ", t or ""), []).append(i)
    return {i: (min(g), len(g), i == min(g), sha(t)) for t, g in groups.items() for i in g}


def simhash(text, k=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(text)
    shingles = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def simhash_groups(rows, distance=3):
    """doc_id -> (fingerprint, component_id)."""
    rows = sorted(rows)
    f = np.array([simhash(t) for _, t in rows], np.uint64)
    pairs = []
    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[:i] ^ f[i]) <= distance):
            pairs.append((i, int(j)))
    low = classes(len(f), pairs)
    return {rows[i][0]: (f"{int(f[i]):016x}", rows[low[i]][0]) for i in range(len(f))}


def near_vectors(rows, cut=0.98):
    """vec_id -> (n_links, component_id) of rows (vec_id, embedding, label) with distinct ids."""
    rows = sorted(rows, key=lambda r: r[0])
    good = [v is not None and lab is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    pairs, n = [], [0] * len(rows)
    for i, (_, a, la) in enumerate(rows):
        for j, (_, b, lb) in enumerate(rows[:i]):
            if good[i] and good[j] and la == lb and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cut:
                    pairs.append((i, j))
                    n[i] += 1
                    n[j] += 1
    low = classes(len(rows), pairs)
    return {rows[i][0]: (n[i], rows[low[i]][0]) for i in range(len(rows))}


def remove_repeats(rows, width=50):
    """doc_id -> (n_bytes, n_removed, n_spans, kept) of rows (doc_id, text) with distinct ids."""
    seen, out = {}, {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - width + 1):
            if seen.setdefault(data[p:p + width], i) < i:
                gone[p:p + width] = True
        spans = int(np.sum(gone & ~np.r_[False, gone[:-1]])) if len(data) else 0
        out[i] = len(data), int(gone.sum()), spans, bytes(np.frombuffer(data, np.uint8)[~gone])
    return out


ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    text = text or ""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found, key=lambda f: (f[1], ("assign", "access", "hex").index(f[0])))


def phrases(word, words, edge="\x00"):
    """Greedy longest-match phrases of a framed word within framed words."""
    text, n, i = edge + word + edge, 0, 0
    framed = [edge + w + edge for w in words]
    while i < len(text):
        j = i + 1
        while j < len(text) and any(text[i:j + 1] in w for w in framed):
            j += 1
        i, n = j, n + 1
    return n


def has_letter(text):
    return any(c.isalpha() for c in text or "")


def nfc(text):
    return unicodedata.normalize("NFC", text)


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Words per source: the one level at which weight x level, cut at cap x size, adds up to the share of all sizes."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    low, high = 0.0, cap * sum(sizes) + 1.0
    for _ in range(200):
        level = (low + high) / 2
        if sum(min(a * level, cap * s) for a, s in zip(w, sizes)) < share * sum(sizes):
            low = level
        else:
            high = level
    return [min(a * high, cap * s) for a, s in zip(w, sizes)]
