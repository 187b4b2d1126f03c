"""Plain versions of what the operators compute, for comparison on small tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"
#: Rows every operator on documents has to stand: nulls, empty and very long texts, repeats.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (None, "a b c"), (None, None), (4, "one two"), (5, "one two"), (6, "x" * 50_000),
    (7, "word " * 20_000), (8, "é漢🙂 ß"), (8, "é漢🙂 ß"), (9, "ONE two"),
]


def odd_docs(spark, extra: bool = True):
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in ODD]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:  # columns whose names operators might be tempted to use themselves
        for name in ("score", "kept", "word", "rep", "__id_", "label", "a", "b"):
            docs = docs.selectExpr("*", f"'x' AS {name}")
    return docs


def empty_docs(spark):
    return odd_docs(spark, extra=False).where("false")


def shingles(text: str | None, lower) -> set:
    words = WORD.findall(lower(text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def near_groups(rows, percent: int = 85) -> dict:
    """doc_id -> (shingles, smallest doc_id of the component)."""
    sets = {i: shingles(t, ascii_lower) for i, t in rows}
    where, parent = defaultdict(list), {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in where[s])
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            where[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def leaks(rows, items, percent: int = 80) -> dict:
    """(doc_id, item_id) -> containment."""
    found = {}
    asked = {i: shingles(t, str.lower) for i, t in items}
    for doc_id, text in rows:
        own = shingles(text, str.lower)
        for item_id, s in asked.items():
            if s and 100 * len(own & s) >= percent * len(s):
                found[doc_id, item_id] = len(own & s) / len(s)
    return found
