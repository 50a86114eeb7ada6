"""Small corpora with the awkward cases, and plain Python versions of the operators."""

import hashlib
import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0d]+")
#: Extra columns whose names the operators use themselves.
EXTRA = ["size", "kept", "n_words", "component_id", "ids", "repeats", "target", "held_out", "score",
         "__score", "spans", "__id", "__key", "__hit", "__h", "__w", "__bits", "__kept", "__place", "__times", "__round", "__d", "__k", "__n", "__s",
         "__e", "__node", "__shared", "__least", "__extras", "slice", "h", "copy", "taken", "served", "finish", "anchor", "band", "hub", "part", "row"]
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                     *[T.StructField(c, T.StringType()) for c in EXTRA]])


def words(text):
    return WORD.findall(text or "")


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), *["x"] * len(EXTRA))


def sentence(rng, n, vocabulary=400):
    letters = str.maketrans("0123456789", "abcdefghij")
    return " ".join(f"w{rng.randrange(vocabulary)}".translate(letters) for _ in range(n))


def corpus():
    """Copies, near copies, shared passages, periodic and very long texts, nulls, ties and repeated rows."""
    rng = random.Random(3)
    passage, base = sentence(rng, 70), sentence(rng, 120)
    rows = [row(100 + i, sentence(rng, rng.randrange(1, 150)), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", None]))
            for i in range(60)]
    rows += [row(200 + i, f"{sentence(rng, 20)} {passage}\n{sentence(rng, 15 + i)}", "en", "a") for i in range(6)]
    for i in range(12):  # edited copies of one text
        w = base.split()
        for _ in range(i):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append(row(300 + i, " ".join(w), "en", "b"))
    rows += [row(400 + i, base, "en", "a") for i in range(5)]
    rows += [row(500, " ".join(["same"] * 300)), row(501, " ".join(["same"] * 200)), row(502, "x y " * 150)]
    rows += [row(600, sentence(rng, 30000, 20000), "en", "a")]  # very long
    rows += [row(700, None), row(701, ""), row(702, " \n\t\x0b"), row(703, "one"), row(704, "One"), row(705, "çé 日本 🎉 \x85 a\xa0b")]
    rows += [row(None, base), row(None, "no id here"), row(None, None, None, None), row(800, passage, None, None)]
    rows += [row(801, sentence(rng, 60))] * 2 + [row(802, "tie one two three"), row(802, "tie of another text")]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, partitions=3):
    return spark.createDataFrame(rows, DOCS).repartition(partitions)


def remove_words(rows, width):
    """op9 by brute force: (n_words, n_removed, sha256) of each row, in order."""
    key = lambda r: float("inf") if r[0] is None else r[0]
    first = {}
    for r in rows:
        w = words(r[1])
        for i in range(len(w) - width + 1):
            g = tuple(w[i:i + width])
            first[g] = min(first.get(g, float("inf")), key(r))
    out = []
    for r in rows:
        w = words(r[1])
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i:i + width])] < key(r):
                gone.update(range(i, i + width))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((r[0], len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def remove_bytes(rows, width):
    """op3 by brute force."""
    from collections import Counter
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[i:i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for r, t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - width + 1):
            if seen[t[i:i + width]] > 1:
                gone[i:i + width] = b"\x01" * width
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((r[0], len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingle_set(text, size):
    w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in words(text)]
    if not w:
        return set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)}


def kept_ids(rows, size, percent=80):
    """Ids of the documents that ``one_of_each`` keeps; a document is an id with its text."""
    texts, apart = {}, []
    for i, text, *rest in rows:
        if i is not None:
            own = texts.setdefault(i, [])
            if text not in own:
                own.append(text)
                apart.append((i + 10**6 * (len(own) - 1), text, *rest))
    return [i % 10**6 for i, _, _, kept in near_groups(apart, size, percent) if kept]


def near_groups(rows, size, percent=80):
    """op4 by brute force: {doc_id: (n_shingles set, component, kept)} for rows with ids."""
    some = [(r[0], shingle_set(r[1], size)) for r in rows if r[0] is not None]
    parent = {i: i for i, _ in some}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, x) in enumerate(some):
        for b, y in some[:k]:
            if x and y and a != b and 100 * len(x & y) >= percent * len(x | y):
                a_, b_ = find(a), find(b)
                parent[max(a_, b_)] = min(a_, b_)
    return [(i, len(s), find(i), find(i) == i) for i, s in some]
