"""A small corpus with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: The same rows with columns whose names the operators use inside.
CLASHING = SCHEMA + ", doc long, key long, h long, n int, words string, score double, held_out boolean, n_lines int, line int, hashes string, part int, component string"


def rows() -> list[tuple]:
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in "ba ce di fo gu ly ne pa ri so".split() for b in "nd rt st lm ck ps".split()]
    passage = [rng.choice(vocabulary) for _ in range(40)]

    def text(n: int) -> list[str]:
        return [rng.choice(vocabulary) for _ in range(n)]

    def lines(words: list[str]) -> str:
        return "\n".join(" ".join(words[i : i + 15]).capitalize() + "." for i in range(0, len(words), 15))

    out: list[tuple] = []
    for k in range(30):
        words = text(rng.randint(30, 120))
        if k % 5 == 0:
            words[10:10] = passage
        out.append((k, lines(words)))
        if k % 3 == 0:  # near and exact copies
            near = list(words)
            near[rng.randrange(len(near))] = "changed"
            out += [(100 + k, lines(near)), (200 + k, lines(words)), (300 + k, lines(words[:-1]))]
    out += [(400 + k, out[0][1]) for k in range(12)]
    out += [(500, None), (501, ""), (502, "   \n\t "), (503, "one"), (504, "one two"), (505, "One Two"), (506, "one two"), (None, None), (None, out[0][1])]
    out += [(507, "   é É é \x1f x"), (508, " ".join(text(4000))), (508, " ".join(text(4000))), (509, "a" * 5000), (510, "same line here\nsame line here\n\nsame line here")]
    out += [out[3], out[3]]  # repeated rows
    return [(i, t, None if k % 7 == 0 else "en", None if k % 11 == 0 else "s", None if t is None else len(t)) for k, (i, t) in enumerate(out)]


def frame(spark, clashing: bool = False, data: list[tuple] | None = None):
    data = rows() if data is None else data
    if clashing:
        return spark.createDataFrame([(*r, 9, 9, 9, 9, "w", 0.5, True, 3, 4, "x", 5, "c") for r in data], CLASHING)
    return spark.createDataFrame(data, SCHEMA)


def after_all(doc_id: int | None) -> int:
    return (1 << 63) - 1 if doc_id is None else doc_id


def repeats_removed(data: list[tuple], width: int) -> list[tuple]:
    first: dict[tuple, int] = {}
    for doc_id, text, *_ in data:
        words = (text or "").encode().split()
        for i in range(len(words) - width + 1):
            k = tuple(words[i : i + width])
            first[k] = min(first.get(k, after_all(doc_id)), after_all(doc_id))
    out = []
    for doc_id, text, *_ in data:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            if first[tuple(words[i : i + width])] < after_all(doc_id):
                gone[i : i + width] = [True] * width
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def one_apart(a: tuple, b: tuple) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) - len(b) == 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def lines_removed(data: list[tuple], near_words: int) -> list[tuple]:
    first: dict[tuple, tuple] = {}
    for doc_id, text, *_ in data:
        for number, line in enumerate((text or "").split("\n")):
            if words := tuple(line.encode().split()):
                first[words] = min(first.get(words, (after_all(doc_id), number)), (after_all(doc_id), number))
    near = {w for w in first if any(v != w and first[v] < first[w] and max(len(v), len(w)) >= near_words and one_apart(v, w) for v in first)}
    out = []
    for doc_id, text, *_ in data:
        kept, full, removed = [], 0, 0
        for number, line in enumerate(text.split("\n") if text is not None else []):
            words = tuple(line.encode().split())
            full += bool(words)
            if words and (words in near or first[words] != (after_all(doc_id), number)):
                removed += 1
            else:
                kept.append(line)
        out.append((doc_id, "\n".join(kept) if text is not None else None, full, removed))
    return out


def shingles(text: str | None, width: int) -> set[tuple]:
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def jaccard_groups(data: list[tuple], width: int, percent: int) -> list[tuple]:
    sets = [shingles(r[1], width) for r in data]
    parent = list(range(len(data)))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(data)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least: dict[int, int] = defaultdict(lambda: (1 << 63) - 1)
    for i, r in enumerate(data):
        least[root(i)] = min(least[root(i)], after_all(r[0]))
    name = lambda x: None if x == (1 << 63) - 1 else x
    return [(r[0], len(sets[i]), name(least[root(i)])) for i, r in enumerate(data)]


#: The stated base patterns for personal data.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    def valid(kind: str, value: str) -> bool:
        digits = re.sub("[^0-9]", "", value)
        if kind == "ip":
            return all(int(x) <= 255 for x in value.split("."))
        if kind == "card":
            return 16 <= len(digits) <= 19 and luhn(digits)
        return kind == "email" or 8 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, p in STATED.items() for m in re.finditer(p, text or "") if valid(k, m.group())]
