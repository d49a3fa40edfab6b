"""Awkward documents, and plain restatements of what the operations are to return."""

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = "n_words string, doc string, key string, label string, kept string, measures string, gone string, epoch string"


def prose(seed, n, letters="abcdefghij"):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(1, 7))) for _ in range(n))


def awkward_texts():
    base = prose(1, 120)
    words = base.split(" ")
    near = " ".join([*words[:60], "changed", *words[61:]])
    passage = prose(2, 60)
    return [
        None,
        "",
        " \t\n ",
        "a",
        "one two three",
        "One TWO three",
        base,
        base,
        base.upper(),
        near,
        " ".join([*words[:118], "end", "here"]),
        f"{prose(3, 40)} {passage} {prose(4, 30)}",
        f"{passage} {prose(5, 50)}",
        f"é{passage}漢字",
        "a" * 900,
        "ab" * 300,
        "ab" * 301,
        "x\n" * 400,
        f"{prose(6, 9)}\n" * 12,
        "### $$$ " * 80,
        prose(7, 30_000),
        f"{prose(7, 30_000)} tail",
        "\u0000\u0001 <|im_end|> <\\| 👍 ǅ",
    ]


def awkward_docs(spark, clashes=False):
    """Every text, two rows twice, rows without id, language or source."""
    rows = [(i, t, ("en", "de", None)[i % 3], ("s0", "s0", "s1", None)[i % 4], len(t or "")) for i, t in enumerate(awkward_texts())]
    rows += [rows[6], rows[11], (None, rows[6][1], None, None, None), (None, "lost and found", "en", "s1", 14)]
    docs = spark.createDataFrame(rows, DOCS)
    if clashes:
        docs = docs.selectExpr("*", *[f"'x' as `{c.split()[0]}`" for c in CLASHES.split(", ")])
    return docs


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def components(ids, linked):
    """Smallest id that links lead to; ``linked`` gives pairs."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def grams(text, size):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if 0 < len(words) < size:
        return {tuple(words)}
    return set(zip(*(words[k:] for k in range(size)), strict=False))


def near_duplicates(texts, size, percent):
    """By id: number of n-grams and component."""
    sets = {i: grams(t, size) for i, t in texts.items()}
    index = defaultdict(list)
    links = []
    for i in sorted(sets):
        common = Counter(other for g in sets[i] for other in index[g])
        links += [
            (other, i) for other, n in common.items() if 100 * n >= percent * (len(sets[i]) + len(sets[other]) - n)
        ]
        for g in sets[i]:
            index[g].append(i)
    root = components(sets, links)
    return {i: (len(sets[i]), root[i]) for i in sets}


def covered(texts, length):
    """By id: the bytes and, for each, whether a string that also starts earlier covers it."""
    seen, found = set(), {}
    for i in sorted(texts):
        raw = (texts[i] or "").encode()
        marks = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if raw[s : s + length] in seen:
                marks[s : s + length] = b"\1" * length
            seen.add(raw[s : s + length])
        found[i] = raw, marks
    return found


def sha(data):
    return hashlib.sha256(data).hexdigest()
