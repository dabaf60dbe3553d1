"""Plain versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def op1(rows, path):
    from tokenizers import Tokenizer

    t, out, start = Tokenizer.from_file(path), [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return sorted(out)


def op7(rows, items, width=10):
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    windows = []
    for item, text in items:
        w = find(lowered(text))
        n = min(width, len(w))
        windows += [(str(item) if item is not None else "null", w[i : i + n]) for i in range(len(w) - n + 1) if n]
    out = []
    for doc_id, text in rows:
        w = find(lowered(text))
        hit, found = set(), set()
        for item, x in windows:
            for i in range(len(w) - len(x) + 1):
                if w[i : i + len(x)] == x:
                    hit |= set(range(i, i + len(x)))
                    found.add(item)
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def fingerprint(text, k=3):
    w = words(lowered(text))
    if not w:
        return 0
    k = min(k, len(w))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def op10(rows, distance=3):
    fps = [(d, fingerprint(t)) for d, t in rows]
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(fps):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, f"{f:016x}", least.get(find(i))) for i, (d, f) in enumerate(fps)]


def op3(rows, n=100):
    seen, out = set(), []
    for doc_id, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            w = b[i : i + n]
            if w in seen:
                gone[i : i + n] = b"\1" * n
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc_id, len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def op5(rows, n=13):
    first, out = {}, []
    for doc_id, text in rows:
        w = words(text)
        for i in range(len(w) - n + 1):
            first.setdefault(tuple(w[i : i + n]), doc_id)
    for doc_id, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < doc_id:
                gone |= set(range(i, i + n))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def op4_base(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {i + k for v in seen.values() if len(v) > 1 for i in v for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed
