"""Small tables with the awkward rows, and plain versions of the operators to compare with."""

from __future__ import annotations

import hashlib
import random
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns beyond those of documents, some with names that operators use for their own.
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, shard int, Ord string, rows string"


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward_texts(seed: int = 1) -> list[str | None]:
    """Nulls, empty and blank texts, very long ones, copies, near copies, shared passages."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randrange(5, 120)) for _ in range(20)]
    shared = prose(rng, 30)
    near = base[3].split()
    near[-1] = "changed"
    return [
        None, "", " \t\n\x0b\f\r ", "one", "One two three", *base, base[0], base[0], base[1] + " ", " ".join(near),
        prose(rng, 40) + " " + shared + " " + prose(rng, 40), shared, prose(rng, 13) + "\n" + shared, base[2].upper(),
        "the " * 3000, "x" * 20_000, prose(rng, 4000), shared + " " + shared, "café naïve 日本語 \U0001f600   end", None, "",
    ]


def documents(spark, texts=None, seed: int = 1):
    texts = awkward_texts(seed) if texts is None else texts
    rows = [(k, t, "en", "src0" if k % 3 else f"src{k % 5}", None if t is None else len(t), 0.5, 7, 3, "o", "r") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, EXTRA).repartition(3)


def simhash(text: str | None, shingle: int = 4) -> int:
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(words[k: k + shingle]) for k in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(prints: dict[int, int], distance: int = 4) -> dict[int, int]:
    owner = {i: i for i in prints}

    def root(i):
        while owner[i] != i:
            i = owner[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = sorted((root(a), root(b)))
                owner[y] = x
    return {i: root(i) for i in ids}


def removal(texts: dict[int, str | None], window: int = 13) -> dict[int, tuple[int, int, str]]:
    words = {i: WORD.findall(t or "") for i, t in texts.items()}
    first: dict = {}
    for i in sorted(words):
        for k in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][k: k + window]), i)
    out = {}
    for i, w in words.items():
        gone = {j for k in range(len(w) - window + 1) if first[tuple(w[k: k + window])] < i for j in range(k, k + window)}
        kept = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out
