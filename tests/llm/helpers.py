"""Small tables for the operators, and plain versions of what they compute."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash

BLANKS = re.compile(r"[\x20\x09-\x0D]+")
LONG = " ".join(f"word{i % 997}x{i}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(30))
# Names that operators use inside; as columns of an input they must not matter.
CLASHING = {c: f"'{c}'" for c in (
    "kept", "keep_id", "group_size", "text_sha256", "size", "head", "norm", "fp", "node", "root", "value", "mask", "row",
    "words", "lines", "content", "gram", "doc_no", "shared", "firsts", "anchor", "score", "positive", "toxic", "bin",
    "length", "rank", "piece", "group", "kept_doc_id", "open_id", "exact_id", "exact_digest", "carried", "n_words")}

ODD = [
    (1, "one two  three\tfour"),
    (2, "one two three four"),
    (2, "one two three four"),
    (2, "another text of a repeated id"),
    (3, None),
    (4, ""),
    (5, "   \n\t "),
    (None, "one two three four"),
    (None, None),
    (6, f"{PASSAGE} its own end " + " ".join(f"six{i}" for i in range(40))),
    (7, f"begin {PASSAGE} {PASSAGE} finish"),
    (8, f"begin {PASSAGE} {PASSAGE} finish"),
    (9, LONG),
    (10, LONG + " "),
    (11, "É​ü 日本 ▁ ß\x85x\xa0y\r\n  <|endoftext|> 🙂"),
    (-3, "a negative id"),
]


def table(spark, rows, **columns):
    """Documents with the columns the tables have, and the clashing ones."""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    more = {"lang": "'en'", "source": "'src0'", "n_chars": "cast(length(text) as bigint)", **CLASHING, **columns}
    return docs.selectExpr("*", *[f"{v} as `{k}`" for k, v in more.items()])


def words(text):
    return [w for w in BLANKS.split(text or "") if w]


def normal(text):
    return BLANKS.sub(" ", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def first(ids):
    """The least id; a null only where there is no other."""
    return min((i for i in ids if i is not None), default=None)


def exact_groups(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(normal(text), []).append(doc)
    return groups


def fingerprint(text):
    ws = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = words(ws)
    shingles = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] if len(ws) >= 3 else [" ".join(ws)] if ws else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def linked(values, bits=3):
    """Groups of numbers that links of few differing bits join."""
    left, groups = sorted(set(values)), []
    while left:
        group = [left.pop()]
        for x in group:
            near = [y for y in left if (x ^ y).bit_count() <= bits]
            group += near
            left = [y for y in left if y not in near]
        groups.append(group)
    return groups


def without_repeats(rows, window=20):
    """(id, text) in order -> removed places of each, judged on the input."""
    seen, out = set(), []
    for _, text in rows:
        ws, gone = words(text), set()
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i:i + window])
            if key in seen:
                gone.update(range(i, i + window))
            seen.add(key)
        out.append((ws, gone))
    return out


def repeat_words(ws):
    counts = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    return len({i + k for i in range(len(ws) - 2) if counts[tuple(ws[i:i + 3])] > 1 for k in range(3)})


def plain_hash(*parts):
    """The keyed hash of merge dropout, on Python's integers."""
    total, all_bits = 0x243F6A8885A308D3, (1 << 64) - 1
    for part in parts:
        x = (total ^ (part & all_bits)) * 0x9E3779B97F4A7C15 & all_bits
        x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & all_bits
        total = x ^ x >> 32
    return total
