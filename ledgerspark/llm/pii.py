"""Operator 12: personal data, found in plain and in disguised form, as spans of the source text.

Two layers.

*Base* detectors are fixed patterns (email, ip, card, phone) over the text as it is:
leftmost, non-overlapping per kind, a match that fails its test is dropped and its
characters are not tried again. All scans are linear in the length of the text.

*Deobfuscation* runs the same detectors over a rewritten text. Three transducers
rewrite it, and each returns its edits, so that any span of the result can be mapped
back to source characters:

1. characters: homoglyphs, full-width and other compatibility forms and the digits of
   all scripts become ASCII (one for one); invisible characters are deleted;
2. spelled digits: runs with two or more digit words, or with one beside a dot word
   (English, German, French, Spanish), become digits; ``plus`` before a digit becomes ``+``;
3. at/dot disguises: dots between digits, and at and dot inside an address, where the
   whole shape ``local AT label (DOT label)+`` is there. A bare word ``at`` counts only
   if the first dot is disguised too, so prose such as "at example.com" stays clean.

A found span is added if its source differs from the rewritten characters (so the
disguise is inside the span) and no base span of its kind holds it. Base spans stay.

Rows: one per input row, repeated ids and ids of null included. A null text is an
empty text. Only ``doc_id`` and ``text`` are read, so other columns may have any name.
Spans are ordered by kind (email, ip, card, phone), start, end; equal spans come once.
A text is worked on whole, in one task, in time and memory proportional to its length
(a few copies of it at a time). An empty table gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.common import ship

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]
Edit = tuple[int, int, int, int]  # start and end in the old text, start and end in the new one

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_FIGURE_DOT = re.compile(r"[0-9]\.[0-9]")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# ------------------------------------------------------------ base detectors


def emails(text: str) -> list[Span]:
    """Work from each ``@`` outwards, so that long runs without one cost nothing."""
    found, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, m.end()))
        floor = m.end() if m else at + 1
        at = text.find("@", floor)
    return found


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def ips(text: str) -> list[Span]:
    if not _FIGURE_DOT.search(text):
        return []
    return [m.span() for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    found = []
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(m.span())
    return found


def phones(text: str) -> list[Span]:
    found = []
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append(m.span())
    return found


DETECTORS: dict[str, Callable[[str], list[Span]]] = {"email": emails, "ip": ips, "card": cards, "phone": phones}

# -------------------------------------------------------------- transducers

# Letters of other scripts that look like a Latin one, each above its Latin letter.
_ALIKE = (
    "аеорсухіјѕԁԛԝһӏАВЕКМНОРСТУХІЈЅԚԜ" "αοιυνρκτχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
    "aeopcyxijsdqwhlABEKMHOPCTYXIJSQW" "aoiuvpktxABEZHIKMNOPTYX",
)
# Hyphens, dots and a space that look like the ASCII ones.
_SIGNS = ("‐‑‒–—―−․。｡ ", "-------...\x20")
_INVISIBLE = re.compile("[­​-‏⁠-⁤﻿]+")
_FOREIGN = re.compile("[ ­ɐ-\U0010ffff]")
#: Below this code point only the characters listed above are rewritten (² is no 2, ª no a).
_COMPATIBLE_FROM = 0x250

# The digits' names, 0 to 9.
_DIGIT_NAMES = """
zero one two three four five six seven eight nine
null eins zwei drei vier fünf sechs sieben acht neun
zéro un deux trois quatre cinq six sept huit neuf
cero uno dos tres cuatro cinco seis siete ocho nueve
"""
_DIGIT = {name: str(k) for line in _DIGIT_NAMES.strip().splitlines() for k, name in enumerate(line.split())}
_NAME = "|".join(sorted(_DIGIT, key=len, reverse=True))
_PLUS = re.compile(r"(?<!\w)(?:plus|más)\x20(?=[0-9])", re.I)

# Words for the two signs; bare ones are taken only inside an address or between digits.
_AT_WORDS, _DOT_WORDS = "at|arroba|arobase|ät", "dot|punkt|point|punto"
_OPEN, _CLOSE = r"\x20?[(\[{<]\x20?", r"\x20?[)\]}>]\x20?"
_AT = re.compile(rf"(?P<hidden>{_OPEN}(?:{_AT_WORDS}|@){_CLOSE}|\x20@\x20)|(?P<bare>\x20(?:{_AT_WORDS})\x20)|@", re.I)
_DOT = re.compile(rf"{_OPEN}(?:{_DOT_WORDS}|\.){_CLOSE}|\x20(?:{_DOT_WORDS})\x20", re.I)
_GAP = rf"(?:{_DOT.pattern}|[\x20,-]{{1,2}})"
_SPELLED = re.compile(rf"(?<!\w)(?:(?:{_NAME})|[0-9]++)(?:{_GAP}(?:(?:{_NAME})|[0-9]++)(?!\w))++", re.I)
# Cheap signs, looked for in the lower-cased text, without which a transducer has nothing to do.
_NAMED = re.compile(rf"[^a-z](?:{_NAME})(?![a-z])")
_GOES_ON = re.compile(rf"{_GAP}(?:{_NAME}|[0-9])")
_FIGURE_BEFORE = re.compile(rf"[0-9]{_GAP}\Z")
_GAP_MOST = 12
_HIDDEN_AT = re.compile(rf"[(\[{{<]\x20?(?:{_AT_WORDS}|@)|\x20@\x20")
_HIDDEN_DOT = re.compile(rf"[(\[{{<]\x20?\.")
_PIECE = re.compile(rf"({_DOT.pattern})|([\x20,-]+)|([0-9]+)|(\w+)", re.I)
_LABEL = re.compile(r"[A-Za-z0-9-]++")
_TOP = re.compile(r"[A-Za-z]{2,24}")


class _Fold(dict):
    """Code point -> ASCII look-alike; what has none stays."""

    def __missing__(self, code: int) -> str:
        ch = chr(code)
        out = ch
        if code >= _COMPATIBLE_FROM:
            digit = unicodedata.decimal(ch, None)
            plain = str(digit) if digit is not None else unicodedata.normalize("NFKC", ch)
            if len(plain) == 1 and " " <= plain <= "~":
                out = plain
        self[code] = out
        return out


_FOLD = _Fold({**str.maketrans(*_ALIKE), **str.maketrans(*_SIGNS)})


def rewritten(text: str, edits: list[tuple[int, int, str]]) -> tuple[str, list[Edit]]:
    """``text`` with the pieces (start, end, new), in order, put in; and where they went."""
    parts, done, at, size = [], [], 0, 0
    for start, end, new in edits:
        parts += [text[at:start], new]
        size += start - at
        done.append((start, end, size, size + len(new)))
        size += len(new)
        at = end
    return "".join([*parts, text[at:]]), done


def fold_characters(text: str) -> tuple[str, list[Edit]]:
    """Look-alikes one for one; invisible characters go."""
    if not _FOREIGN.search(text):
        return text, []
    folded = text.translate(_FOLD)
    return rewritten(folded, [(*m.span(), "") for m in _INVISIBLE.finditer(folded)])


def fold_digits(text: str) -> tuple[str, list[Edit]]:
    """Runs of spelled digits; separators between two digit words go, dot words between digits
    become dots, separators beside figures become one character."""
    edits, low = [], " " + text.lower()
    if any(_GOES_ON.match(low, m.end()) or _FIGURE_BEFORE.search(low, max(0, m.start() - _GAP_MOST), m.start() + 1)
           for m in _NAMED.finditer(low)):
        for m in _SPELLED.finditer(text):
            pieces = [p.groups() for p in _PIECE.finditer(m.group())]
            words = sum(word is not None for *_, word in pieces)
            if words > 1 or words and any(dot for dot, *_ in pieces):  # one alone may be prose ("1373 un")
                edits.append((*m.span(), "".join(_joined(pieces))))
    out, first = rewritten(text, edits)
    plus = [(*m.span(), "+") for m in _PLUS.finditer(out)] if "plus " in low or "más " in low else []
    if not plus:
        return out, first
    out, second = rewritten(out, plus)
    return out, _composed(first, second)


def _joined(pieces: list[tuple[str | None, ...]]) -> Iterator[str]:
    for k, (dot, gap, figures, word) in enumerate(pieces):
        if dot:
            yield "."
        elif gap is None:
            yield figures or _DIGIT[word.lower()]
        elif not (pieces[k - 1][3] and pieces[k + 1][3]):
            yield "-" if "-" in gap else " "


def _composed(first: list[Edit], second: list[Edit]) -> list[Edit]:
    """The edits of two steps in a row as one list; edits that touch become one."""
    return [(*back((s, e), [first]), ns, ne) for s, e, ns, ne in _merged(first, second)]


def _merged(first: list[Edit], second: list[Edit]) -> list[tuple[int, int, int, int]]:
    """The changed stretches of the middle text with their places in the last one."""
    middle = sorted([(s, e) for _, _, s, e in first] + [(s, e) for s, e, _, _ in second])
    joined: list[list[int]] = []
    for s, e in middle:
        if joined and s < joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], e)
        else:
            joined.append([s, e])
    ends = [e[1] for e in second]
    out = []
    for s, e in joined:
        before = bisect_right(ends, s)
        shift = second[before - 1][3] - second[before - 1][1] if before else 0
        after = bisect_right(ends, e)
        shift_end = second[after - 1][3] - second[after - 1][1] if after else 0
        out.append((s, e, s + shift, e + shift_end))
    return out


def fold_signs(text: str) -> tuple[str, list[Edit]]:
    """At and dot disguises, where an address or figures stand around them."""
    low = text.lower()
    hidden = any(w in low for w in _DOT_WORDS.split("|")) or _HIDDEN_DOT.search(text)
    dots = [m.span() for m in _DOT.finditer(text)] if hidden else []
    if not dots and not _HIDDEN_AT.search(low):
        return text, []
    edits = {(s, e): "." for s, e in dots if s and e < len(text) and text[s - 1] in "0123456789" and text[e] in "0123456789"}
    starts, ends = {s: e for s, e in dots}, {e: s for s, e in dots}
    for m in _AT.finditer(text):
        if m.lastgroup is None and not dots:
            continue  # a plain address
        head = _head(text, m.start(), ends)
        tail = _tail(text, m.end(), starts)
        if head is None or tail is None:
            continue
        places, plain_first, top = tail
        if m.lastgroup == "bare" and (plain_first or not _TOP.fullmatch(top)):
            continue
        if m.lastgroup:
            edits[m.span()] = "@"
        edits |= dict.fromkeys(head + places, ".")
    last, chosen = -1, []
    for (s, e), new in sorted(edits.items()):
        if s >= last:  # tokens may share a space: the first has it
            chosen.append((s, e, new))
            last = e
    return rewritten(text, chosen)


def _head(text: str, end: int, dot_ends: dict[int, int]) -> list[Span] | None:
    """The disguised dots of the local part that ends at ``end``; None without a local part."""
    dots: list[Span] = []
    while True:
        start = end
        while start and text[start - 1] in _LOCAL:
            start -= 1
        if start == end:
            return dots[:-1] if dots else None  # a dot without a name before it is none of the address
        if start not in dot_ends:
            return dots
        dots.append((dot_ends[start], start))
        end = dot_ends[start]


def _tail(text: str, at: int, dot_starts: dict[int, int]) -> tuple[list[Span], bool, str] | None:
    """The disguised dots of the domain that starts at ``at``, if its first dot is a plain one, and its last label."""
    label = _LABEL.match(text, at)
    dots: list[Span] = []
    count, plain_first = 0, False
    while label:
        at = label.end()
        after = dot_starts.get(at) or (at + 1 if text[at:at + 1] == "." else None)
        following = _LABEL.match(text, after) if after else None
        if not following:
            return (dots, plain_first, label.group()) if count else None
        if at in dot_starts:
            dots.append((at, after))
        elif not count:
            plain_first = True
        count += 1
        label = following
    return None


TRANSDUCERS = (fold_characters, fold_digits, fold_signs)


def back(span: Span, steps: list[list[Edit]]) -> Span:
    """A span of the last text as a span of the source: an edit that it touches is in it as a whole."""
    start, end = span
    for edits in reversed(steps):
        news = [e[2] for e in edits]
        k = bisect_right(news, start) - 1
        s = start
        if k >= 0:
            s = edits[k][0] if edits[k][2] <= start < edits[k][3] else start + edits[k][1] - edits[k][3]
        k = bisect_right(news, end - 1) - 1
        e = end
        if k >= 0:
            e = edits[k][1] if edits[k][2] <= end - 1 < edits[k][3] else end + edits[k][1] - edits[k][3]
        start, end = s, e
    return start, end


def spans_of(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind number, start, end, base) of one text, in order."""
    base = [(k, *span) for k, kind in enumerate(KINDS) for span in DETECTORS[kind](text)]
    steps, now = [], text
    for step in TRANSDUCERS:
        now, edits = step(now)
        steps.append(edits)
    added = set()
    if now != text:
        held = [[s for k, *s in base if k == kind] for kind in range(len(KINDS))]
        for k, kind in enumerate(KINDS):
            firsts = [s[0] for s in held[k]]
            for span in DETECTORS[kind](now):
                start, end = back(span, steps)
                at = bisect_right(firsts, start) - 1
                if text[start:end] != now[slice(*span)] and not (at >= 0 and held[k][at][1] >= end):
                    added.add((k, start, end))
    return sorted([(*x, True) for x in base] + [(*x, False) for x in added])


SPANS = "array<struct<kind: string, start: long, end: long, base: boolean>>"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
    for batch in batches:
        spans = [[{"kind": KINDS[k], "start": s, "end": e, "base": b} for k, s, e, b in spans_of(text.as_py() or "")]
                 for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])


def find(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans`` (kind, start, end in code points, end exclusive; ``base`` false for added ones)."""
    ship(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_find, f"doc_id {id_type}, spans {SPANS}")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of its text replaced by ``[kind]``; overlapping spans become one, of the first one's kind.

    All other columns pass through, whatever their names.
    """
    ship(docs.sparkSession)
    at = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else redacted(t) for t in batch.column(at).to_pylist()]
            columns = [pa.array(texts, pa.string()) if k == at else batch.column(k) for k in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(clean, docs.schema)


def redacted(text: str) -> str:
    parts, at, name = [], 0, ""
    run: Span | None = None
    for start, end, kind in sorted((s, e, KINDS[k]) for k, s, e, _ in spans_of(text)):
        if run and start < run[1]:
            run = run[0], max(run[1], end)
            continue
        if run:
            parts += [text[at:run[0]], f"[{name}]"]
            at = run[1]
        run, name = (start, end), kind
    if run:
        parts += [text[at:run[0]], f"[{name}]"]
        at = run[1]
    return "".join([*parts, text[at:]])


def _listed(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12_pii: counts and digest of the base spans, and all spans, per document."""
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"),
    )
