"""Operator 6: document fingerprints by I-Match.

The terms of a text are its words (runs of letters, A to Z lower-cased). The lexicon
keeps terms whose document frequency lies in a band: neither the words that most
texts have nor those that a single text has. A fingerprint is made of ``CHAINS``
hashes. Each belongs to a randomised subset of the lexicon, the same for every text,
that keeps a term with probability 2^-l (``LEVELS``), and is the hash of all of the
text's distinct sorted terms in it: the first subset is the whole lexicon; dense
subsets tell short texts apart, sparse ones outlast the edits of long texts. A text
without a term in a subset has no hash there. The likeness of two fingerprints is the
share of equal hashes among those that either text has, and 1 for equal fingerprints.

Document frequencies are exact, for every term (its 64-bit hash): tasks reduce their
texts' terms, a shuffle by term adds them up, and the counts are written. The terms
above the band go to every task; there are at most 1 / MAX_SHARE times as many of
them as an average text has terms. A term below the band has one text, so it is sent
there, along with the texts. Cutting and joining texts can make a word at either end
of the new part that neither text has: for the at most two such terms of an edited
text its fingerprints with and without them are kept, and a look-up of the terms in
the counts settles which one holds.

``neighbours`` pairs every text with the one of the next id in one shuffle: texts go
to ranges of ids (cut by a histogram), are streamed in order, and the first text of
a range is also sent to the range before.

Defined cases: null text counts as empty; of a text without terms in the lexicon all
terms are hashed (copies may be so many that their words are above the band), and a
text without any term has a fingerprint of dashes; null ids sort last; rows with equal ids are ordered by a hash
of the text; a single document is its own successor; an empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.blocks import Block, U, blocks, mix
from ledgerspark.llm.common import NO_ID, bitmap, external_id, keyed, marked, written
from ledgerspark.llm.sharding import one_per_task, shard_bounds

#: A task reduces its terms every 2^BITS of them.
BITS = 20
CHAINS = 16
#: The subset of each hash keeps 2^-level of the lexicon, whatever the text.
LEVELS = (0, 4, 4, 5, 5, 6, 6, 7, 7, 8, 8, 9, 10, 11, 12, 13)
#: Band of document frequency: at least MIN_DOCS documents (two: a term below has one), at most MAX_SHARE of all.
MIN_DOCS, MAX_SHARE = 2, 0.1
SHARD_BYTES = 16 << 20
#: Key of the terms of a document with id, which sorts before its text.
FIRST = -2**63


def _terms(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """(text, term hash) of the distinct terms of a block, sorted."""
    b.letters()
    start, end, offsets = b.words()
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    h = b.word_hashes(start, end)
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
    return text[new], h[new]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms of a task's texts: how many texts have them, and which one if it is one."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def reduced() -> pa.RecordBatch:
        h, ids, keys = (np.concatenate(x) for x in zip(*held))
        terms, first, n = np.unique(h, return_index=True, return_counts=True)
        one = n == 1
        return pa.RecordBatch.from_arrays(
            [pa.array(terms.view(np.int64)), pa.array(n), pa.array(np.where(one, ids[first], 0)), pa.array(np.where(one, keys[first], 0))],
            names=["term", "n", "__id", "__key"])

    for b in blocks(batches):
        text, h = _terms(b)
        ids, keys = (b.rows.column(b.rows.schema.get_field_index(c)).to_numpy() for c in ("__id", "__key"))
        held.append((h, ids[text], keys[text]))
        size += len(h)
        if size >= 1 << BITS:
            yield reduced()
            held, size = [], 0
    if size:
        yield reduced()


@dataclass
class Lexicon:
    """``above``: hashes of the terms above the band, sorted. ``inside``: term of those in the band.
    ``alone``: term of those below it, with the __id and __key of their only text (__key is FIRST where there is an id)."""

    above: np.ndarray
    inside: DataFrame
    alone: DataFrame


def lexicon(docs: DataFrame, n_docs: int, max_share: float = MAX_SHARE) -> Lexicon:
    """Exact document frequencies of all terms, judged. The driver gets the terms above the band."""
    most = max(MIN_DOCS, int(n_docs * max_share))
    key = F.when(F.col("__id") == NO_ID, F.col("__key")).otherwise(F.lit(FIRST)).alias("__key")
    counts = docs.select("__id", key, "text").mapInArrow(_count, "term long, n long, __id long, __key long")
    counts = written(counts.groupBy("term").agg(F.sum("n").alias("n"), F.min("__id").alias("__id"), F.min("__key").alias("__key")), "imatch-terms")
    above = np.array([r["term"] for r in counts.where(F.col("n") > most).select("term").collect()], np.int64)
    return Lexicon(np.sort(above.view(U)), counts.where(F.col("n").between(MIN_DOCS, most)).select("term"),
                   counts.where(F.col("n") < MIN_DOCS).select("term", "__id", "__key"))


def _kept(text: np.ndarray, inside: np.ndarray, n: int) -> np.ndarray:
    """Which terms are hashed: those inside the lexicon, or all of a text that has none there."""
    return inside | ~(np.bincount(text[inside], minlength=n) > 0)[text]


def _hashes(text: np.ndarray, h: np.ndarray, n: int, chains: int) -> np.ndarray:
    """(n, chains) of 32-bit hashes of the terms ``h``, grouped by ``text``; 0 where a text has none in the subset."""
    out = np.zeros((n, chains), U)
    if not len(text):
        return out
    begin = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
    value = mix(h)
    for k in range(chains):
        if k % 4 == 0:  # sixteen bits of a mix decide on a subset
            u = mix(h + U((0x9E3779B97F4A7C15 * (k + 1)) & 0xFFFFFFFFFFFFFFFF))
        inside = ((u >> U(16 * (k % 4))) & U(0xFFFF)) < U(1 << (16 - LEVELS[k % len(LEVELS)]))
        total = np.add.reduceat(np.where(inside, value, U(0)), begin)
        some = np.logical_or.reduceat(inside, begin)
        out[text[begin], k] = np.where(some, (mix(total + U(k)) >> U(32)) | U(1), U(0))
    return out


def _all_terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, term hash) of the distinct terms of texts, sorted."""
    found, at = [(np.zeros(0, np.int64), np.zeros(0, U))], 0
    for b in blocks(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"])])):
        text, h = _terms(b)
        found.append((text + at, h))
        at += len(b.rows)
    return tuple(np.concatenate(x) for x in zip(*found))


def fingerprints(texts: list[bytes], outside: np.ndarray, chains: int = CHAINS) -> np.ndarray:
    """(texts, chains) of 32-bit hashes; 0 where a text has no term. The terms ``outside`` are not in the lexicon."""
    text, h = _all_terms(texts)
    has = _kept(text, ~np.isin(h, outside), len(texts))
    return _hashes(text[has], h[has], len(texts), chains)


def hexes(f: np.ndarray) -> list[str]:
    """Fingerprints as text: eight hex digits a hash, dashes for none."""
    return ["".join("--------" if x == 0 else f"{x:08x}" for x in row) for row in f.tolist()]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal hashes among those that either has, row by row; 1 for equal fingerprints."""
    some = (a != 0) | (b != 0)
    same = ((a == b) & some).sum(axis=1)
    return np.where((a == b).all(axis=1), 1.0, same / np.maximum(some.sum(axis=1), 1))


def _to_range(bounds: np.ndarray, firsts: dict[int, tuple[int, int]], before: dict[int, int]):
    """Rows to their range of ids; the first text of a range (with its terms) also goes to the range before."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            get = lambda c: b.column(b.schema.get_field_index(c)).to_numpy()  # noqa: E731, B023
            ids, keys = get("__id"), get("__key")
            part = np.searchsorted(bounds, ids, side="right").astype(np.int32)
            names = [*b.schema.names, "part", "tail"]
            cols = b.columns
            if "text" in names:  # packed for the shuffle
                text = names.index("text")
                cols[text] = pa.array([None if t is None else zlib.compress(t, 1) for t in cols[text].cast(pa.binary()).to_pylist()], pa.binary())
            terms = b.column(b.schema.get_field_index("term_of_one")).to_numpy(zero_copy_only=False) if "term_of_one" in names else np.zeros(len(part), bool)
            yield pa.RecordBatch.from_arrays([*cols, pa.array(part), pa.array(np.zeros(len(part), bool))], names=names)
            heads = [i for i, (p, x, y, z) in enumerate(zip(part.tolist(), ids.tolist(), keys.tolist(), terms.tolist()))
                     if firsts.get(p) == (x, y) or (z and x != NO_ID and p in firsts and firsts[p][0] == x)]
            if heads:
                some = [c.take(pa.array(heads)) for c in cols]
                yield pa.RecordBatch.from_arrays(
                    [*some, pa.array([before[p] for p in part[heads].tolist()], pa.int32()), pa.array([True] * len(heads))], names=names)

    return deal


def neighbours(docs: DataFrame, function, schema: str, shard_bytes: int = SHARD_BYTES, *, alone: DataFrame | None = None) -> DataFrame:
    """``function(rows)`` over all documents in the order of (__id, __key), given as lists of (id, text bytes, terms) of
    consecutive documents plus the one after them; it returns a record batch for all but the last. The terms are those
    that ``alone`` has for the document, or for all documents of its id."""
    light = written(docs.select("__id", "__key", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n")), "imatch-light")
    light = light.withColumn("n", F.col("n") + 64)
    bounds = shard_bounds(light.where(F.col("__id") != NO_ID), "__id", "n", shard_bytes)
    # the first (id, key) of every range, eight-byte values: as many rows as there are ranges
    dealt = light.select("__id", "__key").mapInArrow(_to_range(bounds, {}, {}), "__id long, __key long, part int, tail boolean")
    heads = {r["part"]: tuple(r["h"]) for r in dealt.groupBy("part").agg(F.min(F.struct("__id", "__key")).alias("h")).collect()}
    parts = sorted(heads)
    before = {p: parts[i - 1] for i, p in enumerate(parts)}

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: list[tuple[int, bytes, list[int]]] = []
        terms: list[int] = []
        size, part, done = 0, None, False
        for b in batches:
            get = lambda c: b.column(b.schema.get_field_index(c)).to_pylist()  # noqa: E731, B023
            for p, tail, x, t, one, term in zip(get("part"), get("tail"), get("__id"), get("text"), get("term_of_one"), get("term")):
                if p != part:
                    run, terms, size, part, done = [], [], 0, p, False
                if done:
                    continue
                if one:
                    terms.append(term)
                    continue
                t = b"" if t is None else zlib.decompress(t)
                if run and run[-1][0] == x != NO_ID:  # the terms of an id come before the first of its texts
                    terms = run[-1][2] + terms
                run.append((x, t, terms))
                size += len(t)
                terms = []
                if tail:  # rows that are copies of a range's first text come as several tails: one is enough
                    done = True
                if len(run) > 1 and (tail or size > 1 << 20):
                    yield function(run)
                    run, size = run[-1:], 0

    rows = docs.select("__id", "__key", "text", F.lit(False).alias("term_of_one"), F.lit(None).cast("long").alias("term"))
    if alone is not None:
        rows = rows.unionByName(alone.select("__id", "__key", F.lit(None).cast("string").alias("text"), F.lit(True).alias("term_of_one"), "term"))
    sent = rows.mapInArrow(_to_range(bounds, heads, before),
                           "__id long, __key long, text binary, term_of_one boolean, term long, part int, tail boolean")
    ordered = one_per_task(sent, len(bounds) + 1, "part").sortWithinPartitions("part", "tail", "__id", "__key", F.desc("term_of_one"))
    return ordered.mapInArrow(stream, schema)


def _edited(above: np.ndarray, chains: int, look_up: bool = False):
    """Fingerprints of the texts of a run, and of them with their last quarter replaced. Terms that only an edited text
    has are in the lexicon; with ``look_up``, they are given as ``made``, and ``edited_fingerprint`` and ``near_edited`` are
    lists: item 0 without any of them, 1 with the first, 2 with the second, 3 with both."""

    def judge(run: list[tuple[int, bytes, list[int]]]) -> pa.RecordBatch:
        texts = [t.decode("utf-8") for _, t, _ in run]
        here = range(len(run) - 1)
        cut = [len(texts[i]) - len(texts[i]) // 4 for i in here]
        edited = [(texts[i][:cut[i]] + texts[i + 1][:len(texts[i]) // 4]).encode() for i in here]
        # a term of one text is out wherever it comes up
        out = np.concatenate([above.astype(U), np.array([x for *_, terms in run for x in terms], np.int64).view(U)])
        text, h = _all_terms([t for _, t, _ in run])
        has = _kept(text, ~np.isin(h, out), len(run))
        own = _hashes(text[has], h[has], len(run), chains)
        text, h, known = *_all_terms(edited), h
        has = ~np.isin(h, out)
        made = has & ~np.isin(h, known) if look_up else np.zeros(len(h), bool)
        n_made = np.bincount(text[made], minlength=len(edited))
        place = np.zeros(len(h), np.int64)
        place[made] = np.arange(made.sum()) - (np.cumsum(n_made) - n_made)[text[made]]
        other = []
        for bits in range(1 << int(n_made.max())):
            some = _kept(text, has & (~made | ((bits >> place) & 1 == 1)), len(edited))
            other.append(_hashes(text[some], h[some], len(edited), chains))
        cols = [pa.array([run[i][0] for i in here], pa.int64()), pa.array([len(texts[i]) for i in here], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in edited]), pa.array(hexes(own[:-1]))]
        near = [likeness(own[:-1], x) for x in other]
        if look_up:
            lists = [1 << k for k in n_made.tolist()]
            prints = [hexes(x) for x in other]
            terms = np.split(h[made].view(np.int64), np.cumsum(n_made)[:-1])
            cols += [pa.array([[prints[v][i] for v in range(k)] for i, k in enumerate(lists)], pa.list_(pa.string())),
                     pa.array([[near[v][i] for v in range(k)] for i, k in enumerate(lists)], pa.list_(pa.float64())),
                     pa.array(likeness(own[:-1], own[1:])), pa.array([x.tolist() for x in terms], pa.list_(pa.int64()))]
        else:
            cols += [pa.array(hexes(other[0])), pa.array(near[0]), pa.array(likeness(own[:-1], own[1:]))]
        names = ["__id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        return pa.RecordBatch.from_arrays(cols, names=[*names, "made"] if look_up else names)

    return judge


def _settled(rows: DataFrame, inside: DataFrame) -> DataFrame:
    """``rows`` with one edited fingerprint and likeness each, by which of the terms ``made`` are ``inside`` the lexicon."""
    rows = written(rows.withColumn("__n", F.monotonically_increasing_id()), "imatch-edited")
    asked = rows.select("__n", F.posexplode("made").alias("place", "term"))
    terms = marked(inside, bitmap(asked, "term"), "term").where("__hit").select("term")
    found = written(asked.join(terms, "term").groupBy("__n").agg(F.sum(F.expr("shiftleft(1, place)")).cast("int").alias("bits")), "imatch-made")
    rows = marked(rows, bitmap(found, "__n"), "__n")
    rest = rows.where("not __hit").withColumn("bits", F.lit(None).cast("int"))
    both = rest.unionByName(rows.where("__hit").join(found, "__n", "left"))
    item = F.coalesce("bits", F.lit(0)) + 1
    return both.withColumns({c: F.element_at(c, item) for c in ("edited_fingerprint", "near_edited")})


def fingerprint_documents(docs: DataFrame, lex: Lexicon | None = None, chains: int = CHAINS) -> DataFrame:
    """doc_id and ``fingerprint`` of every text. Texts are joined with the terms that no other text has."""
    docs = keyed(docs.select("doc_id", "text"))
    lex = lexicon(docs, docs.count()) if lex is None else lex
    above = lex.above
    alone = lex.alone.groupBy("__id", F.col("__key").alias("__of")).agg(F.collect_list("term").alias("terms"))
    of = F.when(F.col("__id") == NO_ID, F.col("__key")).otherwise(F.lit(FIRST))
    rows = docs.select("__id", of.alias("__of"), "text").join(alone, ["__id", "__of"], "left").select("__id", "text", "terms")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            get = lambda c: b.rows.column(b.rows.schema.get_field_index(c))  # noqa: E731, B023
            out = np.concatenate([above, np.array([x for terms in get("terms").to_pylist() for x in terms or []], np.int64).view(U)])
            made = hexes(fingerprints([t or b"" for t in get("text").cast(pa.binary()).to_pylist()], out, chains))
            yield pa.RecordBatch.from_arrays([get("__id"), pa.array(made)], names=["__id", "fingerprint"])

    out = rows.mapInArrow(make, "__id long, fingerprint string")
    return out.select(external_id(F.col("__id")).alias("doc_id"), "fingerprint")


def query(spark, sf_dir: str) -> DataFrame:
    """op6: fingerprints of every document and its edited text, and their likenesses."""
    docs = keyed(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    lex = lexicon(docs, docs.count())
    schema = ("__id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint array<string>, "
              "near_edited array<double>, near_next double, made array<long>")
    out = _settled(neighbours(docs, _edited(lex.above, CHAINS, look_up=True), schema, alone=lex.alone), lex.inside)
    return out.select(external_id(F.col("__id")).alias("doc_id"), *[c.split()[0] for c in schema.split(", ")[1:-1]])
