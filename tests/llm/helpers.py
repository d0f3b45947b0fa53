"""Plain versions of the operators, and rows that are hard to handle."""

import collections
import hashlib
import re
import zlib

#: Names that the operators use inside; documents may have columns of the same names.
CLASHING = ("fp", "key", "part", "x", "kh", "sh", "doc", "tag", "spans", "block", "component_id", "score", "place", "row", "kept", "node", "root", "data", "start", "held", "kept_key")


def edge_docs(spark, long_words=30_000):
    """Null in any column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(long_words))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
        (1, "another text under the same number", "en", None, 34),
        (None, None, None, None, None),
        (None, "a text without a number", None, "b", 23),
        (2, "", "en", "a", 0),
        (3, None, "de", "a", None),
        (4, long, "en", "a", len(long)),
        (5, long, "en", "a", len(long)),
        (6, "é ü \t\n — ￿ <|endoftext|> </s>", "fr", "c", 30),
        (-7, "   \n\t ", "fr", "c", 6),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING})


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def simhash(text: bytes, n: int = 4) -> int:
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in text))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps: list[int], radius: int = 4) -> list[int]:
    """For each row the first row it reaches."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def repeats(texts: list[bytes], window: int = 200) -> list[tuple[int, int, int, str]]:
    """n_bytes, n_removed, n_spans, kept_sha256 of each text."""
    counts = collections.Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if counts[t[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(x for x, y in zip(t, gone) if not y)
        runs = sum(1 for i, y in enumerate(gone) if y and (not i or not gone[i - 1]))
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def phrases(text: str) -> set[str]:
    """The phrases of an LZ78 parse."""
    found, w = set(), ""
    for c in text:
        if w + c in found:
            w += c
        else:
            found.add(w + c)
            w = ""
    return found


def crc_mod(doc_id, m: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % m
