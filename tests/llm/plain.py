"""Plain versions of the operators, and the awkward table that all of them must take."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def awkward(spark):
    """Nulls in all columns, empty and blank texts, repeated rows, ties, a long text, clashing extra columns."""
    long = "Lorem ipsum dolor sit amet. " * 4000
    rows = [
        (1, "The cat sat on the mat and the dog sat on the log.", "en", "a", 50, 7),
        (1, "The cat sat on the mat and the dog sat on the log.", "en", "a", 50, 7),
        (2, None, "en", "a", None, 7),
        (3, "", None, None, 0, None),
        (4, " \t\n\x0b ", "de", "b", 5, 7),
        (5, long, "en", None, len(long), 7),
        (6, "Ünïcödé 漢字 😀 x\u0301", "fr", "b", 12, None),
        (7, "one", "en", "a", 3, 7),
        (8, "one two", "en", "c", 7, 7),
        (None, "one two", None, "c", 7, 7),
        (9, "one two", None, "c", 7, 7),
        (10, "a\x00b 12 +1 (988) 555-2485 1.2.3.4 x@y.zz", "en", "c", 9, 7),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score long")


def fingerprint(text: str | None) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    ones = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        ones.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b, n in ones.items() if 2 * n > len(shingles))


def components(rows: list[tuple], max_bits: int = 3) -> dict:
    """Smallest id that each fingerprint reaches, over all pairs; ``rows`` are (id, fingerprint)."""
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    known = sorted({f for _, f in rows})
    for i, a in enumerate(known):
        for b in known[i + 1 :]:
            if (a ^ b).bit_count() <= max_bits:
                parent[find(a)] = find(b)
    least = {}
    for key, f in rows:
        if key is not None:
            least[find(f)] = min(least.get(find(f), key), key)
    return {f: least.get(find(f)) for f in known}


def repeats(texts: list[bytes], length: int) -> list[tuple[int, int, bytes]]:
    """Removed bytes, runs and what is left, for each text."""
    places = defaultdict(list)
    for i, t in enumerate(texts):
        for p in range(len(t) - length + 1):
            places[hashlib.md5(t[p : p + length]).digest()].append((i, p))
    gone = [bytearray(len(t)) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for i, p in found:
                gone[i][p : p + length] = b"\1" * length
    return [
        (sum(g), len(re.findall(b"\1+", bytes(g))), bytes(c for c, x in zip(t, g, strict=True) if not x)) for t, g in zip(texts, gone, strict=True)
    ]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind: str, value: str) -> bool:
    digits = re.sub(r"[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        twice = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(twice) % 10 == 0
    if kind == "phone":
        return 8 <= len(digits) <= 15
    return True


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if holds(k, m.group())]
