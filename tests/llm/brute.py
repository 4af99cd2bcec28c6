"""Plain versions of the corpus operators, to compare with on small inputs."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def lower(data: bytes) -> bytes:
    return bytes(b + 32 if 65 <= b <= 90 else b for b in data)


def quality(text: str | None) -> dict:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": repeated, "n_repeat_words": len(covered),
        "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words),
    }


def repeats(texts: list[bytes], length: int) -> list[tuple[int, int, int, bytes]]:
    """(n_bytes, n_removed, n_spans, kept) of each text."""
    times = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for i in range(len(t) - length + 1):
            if times[t[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int(np.count_nonzero(gone[:-1] & ~np.concatenate([[False], gone[:-2]]))) if len(t) else 0
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        out.append((len(t), int(gone.sum()), spans, kept))
    return out


def shingles(text: bytes) -> frozenset:
    words = WORD.findall(lower(text))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def near(rows: list[tuple[int | None, bytes | None]]) -> list[tuple[int, int | None]]:
    """(n_shingles, component id) of each row, comparing all rows that share a shingle."""
    sets = [shingles(t or b"") for _, t in rows]
    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    parent = list(range(len(rows)))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tested = set()
    for members in by.values():
        for i in members:
            for j in members:
                if i < j and (i, j) not in tested:
                    tested.add((i, j))
                    both = len(sets[i] & sets[j])
                    if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                        parent[top(i)] = top(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[top(i)].append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return [(len(sets[i]), least[top(i)]) for i in range(len(rows))]


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def digest_ids(ids: list[int]) -> str:
    return hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()


def crc_ids(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def top_k(vectors: dict[int, list[int]], queries: list[int], k: int) -> list[tuple[int, int, int, int]]:
    out = []
    for q in queries:
        scores = sorted(
            (-sum(a * b for a, b in zip(vectors[q], v, strict=True)), i) for i, v in vectors.items() if i != q
        )
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return out
