"""Operator 3: repeated byte strings by suffix arrays.

Every byte that lies in a string of ``width`` bytes which also starts anywhere
else, in any text, is removed.

Sharding. Suffixes are dealt to shards by content, so that those which can share
``width`` bytes meet: every window of ``width`` bytes is represented by its
anchor, the part window (``part`` bytes) in it with the least hash. Equal windows
have equal anchors, so windows whose anchor occurs once in the corpus are done.
Consecutive windows with one anchor form a segment, the unit that is shuffled.
Copies of a segment collapse first (128-bit digest, with a count), so a group of
copies of any size costs a shard one segment.

Within a shard: a suffix array by Larsson-Sadakane refinement in numpy (order by
eight bytes, then double the depth, sorting only what is still tied) and common
prefixes of neighbours by Kasai's rule, walked for all segments of the shard at
once. A window repeats when a neighbour shares ``width`` bytes with it or its
segment has copies.

Across shards: an anchor with more than ``SHARD_SEGMENTS`` different segments is
split over several shards. Each hands on its suffix array: its different windows in
byte order, as places with their ``LEAD`` leading bytes and a 128-bit rolling hash
of all ``width`` bytes for what ties beyond them. The arrays are dealt by hash into
ranges (more ranges for more shards, so a range of an anchor stays of one size). In
a range the windows of one shard's array are looked up in another's by binary
search, byte by byte; the two arrays then become one, pair by pair, so what two
shards share is found wherever it stands.

Scale: a shard takes about a megabyte of segments at a time; only segments under
anchors with different segments are ever sorted. Texts are shuffled only where a
bit map of fixed size says that their document needs it.

Defined cases: null text counts as empty; texts under ``width`` bytes are kept
whole; equal texts of that length and more are removed in all places; rows equal
in id and text are copies of each other like any others; null ids are ordinary; an
empty table gives an empty result. Removing bytes may break UTF-8 sequences, so
kept texts are bytes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.blocks import Block, Rolling, U, blocks, runs
from ledgerspark.llm.common import bitmap, external_id, keyed, marked, written

PART = 128
#: Different segments of one anchor in a shard; more are split. Bytes that a shard sorts at a time.
SHARD_SEGMENTS = 2000
SHARD_BYTES = 1 << 20
#: Leading bytes of a window in the suffix arrays that shards hand on, and the bytes of one entry with its hash.
LEAD = 16
ENTRY = LEAD + 16
SEGMENT = "__id long, __key long, anchor long, d1 long, d2 long, first int, n int"


def _find_segments(width: int, part: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            values = Rolling(b.bytes.astype(U) + U(1)).windows(part)
            first, n, anchor = runs(len(b.bytes), b.offsets, values, width, part)
            if not len(first):
                continue
            doc = np.searchsorted(b.offsets, first, side="right") - 1
            raw = memoryview(b.bytes)
            digest = np.frombuffer(b"".join([
                hashlib.blake2b(raw[s:e], digest_size=16, salt=int(k).to_bytes(16, "little")).digest()
                for s, e, k in zip(first.tolist(), (first + n - 1 + width).tolist(), (anchor - first).tolist())]), np.int64)
            ids, keys = (b.rows.column(c).to_numpy() for c in ("__id", "__key"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (ids[doc], keys[doc], values[anchor].view(np.int64), digest[::2], digest[1::2],
                                       (first - b.offsets[doc]).astype(np.int32), n.astype(np.int32))],
                names=["__id", "__key", "anchor", "d1", "d2", "first", "n"])

    return find


def _heads(padded: np.ndarray, n: int) -> np.ndarray:
    """The next eight bytes at each of the first ``n`` places, as numbers in byte order."""
    head = np.zeros(n, U)
    for k in range(8):
        head = (head << U(8)) | padded[k:k + n]
    return head


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank) of all suffixes by their first ``depth`` bytes or more, by Larsson-Sadakane refinement.

    Suffixes that are equal that far share a rank. Beyond the end counts as zeros.
    """
    n = len(data)
    head = _heads(np.concatenate((data, np.zeros(8, np.uint8))), n)
    order = np.argsort(head)
    first = np.concatenate(([True], head[order][1:] != head[order][:-1])) if n else np.zeros(0, bool)
    group = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[order], rank[n] = group, -1
    have = 8
    while have < depth:
        single = first & np.append(first[1:], True)
        slots = np.flatnonzero(~single)  # what is still tied, in order
        if not len(slots):
            break
        step = min(have, depth - have)
        pos = order[slots]
        after = rank[np.minimum(pos + step, n)]
        by = np.argsort(rank[pos] * (n + 2) + after)
        pos, after = pos[by], after[by]
        order[slots] = pos
        old = rank[pos]
        new = np.concatenate(([True], (old[1:] != old[:-1]) | (after[1:] != after[:-1])))
        first[slots] |= new
        rank[pos] = np.maximum.accumulate(np.where(new, slots, 0))
        have += step
    return order, rank[:n]


def common_prefixes(data: np.ndarray, order: np.ndarray, rank: np.ndarray, lanes: np.ndarray, most: int) -> np.ndarray:
    """Common prefix, up to ``most``, of each listed suffix with the one before it in ``order``.

    ``order`` holds the listed suffixes only. Kasai's rule: going from a suffix to
    the next byte's, the prefix loses one byte at most, unless the neighbour's next
    byte is not listed. Suffixes of one rank are equal for ``most`` bytes; beyond
    that they are in no order, so nothing is carried over from them. ``lanes`` are (first, count) of runs of consecutive
    suffixes; all are walked side by side. Bytes are compared eight at a time.
    """
    n = len(data)
    head = _heads(np.concatenate((data, np.zeros(most + 8, np.uint8))), n + most)
    before = np.full(n + 1, -1, np.int64)
    before[order[1:]] = order[:-1]
    listed = np.zeros(n + 1, bool)
    listed[order] = True
    out = np.zeros(n, np.int64)
    lanes = lanes[np.argsort(-lanes[:, 1], kind="stable")]
    first, count = lanes[:, 0], lanes[:, 1]
    length = np.zeros(len(first), np.int64)
    for k in range(int(count[0]) if len(count) else 0):
        m = int(np.searchsorted(-count, -k, side="left"))  # lanes longer than k
        i = first[:m] + k
        j = before[i]
        has = j >= 0
        tied = has & (rank[i] == rank[j])
        now = np.where(tied, most, np.where(has, length[:m], 0))
        live = np.flatnonzero(has & ~tied)
        while len(live):
            differ = head[i[live] + now[live]] ^ head[j[live] + now[live]]
            equal = np.full(len(live), 8)
            for byte in range(8):
                equal -= differ >= (U(1) << U(8 * byte))
            now[live] += equal
            live = live[(equal == 8) & (now[live] < most)]
        np.minimum(now, most, out=now)
        out[i] = now
        length[:m] = np.where(has & ~tied & listed[np.minimum(j + 1, n)], np.maximum(now - 1, 0), 0)
    return out


def _extract(width: int):
    """Bytes of listed segments."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            lists = b.rows.column(b.rows.schema.get_field_index("segments")).to_pylist()
            raw = b.bytes.tobytes()
            rows = [(d, s) for d, ss in enumerate(lists) for s in ss]
            doc = np.array([d for d, _ in rows])
            ids, keys = (b.rows.column(c).to_numpy() for c in ("__id", "__key"))
            col = lambda name, kind: pa.array([s[name] for _, s in rows], kind)
            at = [int(b.offsets[d]) + s["first"] for d, s in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[doc]), pa.array(keys[doc]), col("anchor", pa.int64()), col("shard", pa.int32()),
                 col("shards", pa.int32()), col("single", pa.bool_()), col("first", pa.int32()),
                 pa.array([raw[a:a + s["n"] - 1 + width] for a, (_, s) in zip(at, rows)], pa.binary())],
                names=["__id", "__key", "anchor", "shard", "shards", "single", "first", "bytes"])

    return extract


#: Spans of repeated windows (part -1), or a shard's suffix array in one range of an anchor: entries end to end, no stops.
SHARD_OUT = ("anchor long, part int, ids array<long>, keys array<long>, starts array<int>, stops array<int>, "
             "suffixes binary, single array<boolean>")
RANGES_PER_SHARD = 16


def _lists(cuts: np.ndarray, *columns: np.ndarray) -> list[pa.ListArray]:
    return [pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(c)) for c in columns]


def repeated_windows(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of the texts that share ``width`` bytes with another one, by suffix array and common prefixes.

    Returns for every window its text, its place there, whether it repeats, and
    whether it is the first of its kind in suffix order.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    data = np.frombuffer(b"".join(texts), np.uint8)
    order, rank = suffix_array(data, width)
    count = np.maximum(sizes - width + 1, 0)
    text = np.repeat(np.arange(len(texts)), count)
    place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = begin[text] + place
    listed = np.zeros(len(data), bool)
    listed[start] = True
    order = order[listed[order]]
    lanes = np.stack([begin, count], axis=1)[count > 0]
    prefix = common_prefixes(data, order, rank, lanes, width)
    with_before = prefix[order] >= width
    repeats = np.zeros(len(data), bool)
    repeats[order] = with_before | np.append(with_before[1:], False)
    leads = np.zeros(len(data), bool)
    leads[order] = ~with_before
    return text, place, repeats[start], leads[start]


def _shards(width: int):
    """Sorted segments of shards to spans of repeated windows, and suffix arrays of split anchors."""
    names = [c.split()[0] for c in SHARD_OUT.split(", ")]

    def solve(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        text, place, repeats, leads = repeated_windows([r["bytes"] for r in rows], width)
        get = lambda name: np.array([r[name] for r in rows])[text]
        single, shards, anchors = get("single"), get("shards").astype(U), get("anchor")
        ids, keys, start = get("__id"), get("__key"), (get("first") + place).astype(np.int32)
        hit = np.flatnonzero(repeats & single)
        if len(hit):  # consecutive windows of a segment become one span
            new = np.concatenate(([True], (np.diff(hit) > 1) | (text[hit][1:] != text[hit][:-1])))
            a, z = hit[new], hit[np.append(np.flatnonzero(new)[1:], len(hit)) - 1]
            none = np.zeros(0, np.int64)
            at = np.array([0, len(a)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([0], pa.int64()), pa.array([-1], pa.int32()), *_lists(at, ids[a], keys[a], start[a], start[z] + np.int32(width)),
                 pa.array([None], pa.binary()), *_lists(np.zeros(2), none.astype(bool))], names=names)
        hand = np.flatnonzero((shards > 1) & leads)
        if len(hand):
            entries, spread = _entries([r["bytes"] for r in rows], text[hand], place[hand], width)
            part = ((spread >> U(32)) * (shards[hand] * U(RANGES_PER_SHARD)) >> U(32)).astype(np.int32)
            anchor = anchors[hand]
            by = np.lexsort((*entries.T[::-1], part, anchor))
            hand, part, anchor, entries = hand[by], part[by], anchor[by], entries[by].astype(">u8").tobytes()
            new = np.flatnonzero(np.concatenate(([True], (part[1:] != part[:-1]) | (anchor[1:] != anchor[:-1]))))
            cuts = np.append(new, len(hand))
            arrays = [entries[a * ENTRY:z * ENTRY] for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[new]), pa.array(part[new]), *_lists(cuts, ids[hand], keys[hand], start[hand]),
                 *_lists(np.zeros(len(cuts)), np.zeros(0, np.int32)), pa.array(arrays, pa.binary()),
                 *_lists(cuts, single[hand] & ~repeats[hand])], names=names)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        todo: list[dict] = []  # whole shards of anchors, about SHARD_BYTES of them
        size = 0
        for batch in batches:
            for r in batch.to_pylist():
                if size >= SHARD_BYTES and (r["anchor"], r["shard"]) != (todo[-1]["anchor"], todo[-1]["shard"]):
                    yield from solve(todo)
                    todo, size = [], 0
                todo.append(r)
                size += len(r["bytes"])
        if todo:
            yield from solve(todo)

    return shards


def _entries(texts: list[bytes], text: np.ndarray, place: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries of the listed windows, as rows of big-endian words: leading bytes, hash of the window. And one hash alone."""
    sizes = np.array([len(t) for t in texts], np.int64)
    at = (np.cumsum(sizes) - sizes)[text] + place
    data = np.frombuffer(b"".join(texts), np.uint8)
    head = _heads(np.concatenate((data, np.zeros(LEAD + 8, np.uint8))), len(data) + LEAD)
    values = data.astype(U) + U(1)
    hashes = [Rolling(values, lane).windows(width)[at] for lane in (0, 1)]
    return np.stack([*(head[at + k] for k in range(0, LEAD, 8)), *hashes], axis=1), hashes[0]


def shared_suffixes(arrays: list[np.ndarray]) -> np.ndarray:
    """Which entries of sorted suffix arrays stand in another of them too; each array holds an entry once.

    Two arrays at a time: every entry of the second is looked up in the first by binary search, an equal one
    marks both, the others go to their places in the first. So n arrays take log n rounds.
    """
    ends = np.cumsum([len(a) for a in arrays])
    shared = np.zeros(ends[-1], bool)

    def join(one: tuple, two: tuple) -> tuple:
        (a, rows_a), (b, rows_b) = one, two
        at = np.searchsorted(a, b)
        same = a[np.minimum(at, len(a) - 1)] == b  # at the end of a: greater than its last, so not equal
        shared[rows_a[at[same]]] = True
        shared[rows_b[same]] = True
        return np.insert(a, at[~same], b[~same]), np.insert(rows_a, at[~same], rows_b[~same])

    todo = [(a, np.arange(end - len(a), end)) for a, end in zip(arrays, ends.tolist())]
    while len(todo) > 1:
        todo = [join(*todo[k:k + 2]) if k + 1 < len(todo) else todo[k] for k in range(0, len(todo), 2)]
    return shared


def _merge(width: int):
    """Windows of split anchors that another shard has too. The input is sorted by (anchor, part)."""

    def settle(runs: list[dict]) -> pa.RecordBatch:
        get = lambda c, kind: np.concatenate([np.array(r[c], kind) for r in runs])
        shared = shared_suffixes([np.frombuffer(r["suffixes"], f"S{ENTRY}") for r in runs])
        out = np.flatnonzero(shared & get("single", bool))
        start = get("starts", np.int32)[out]
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (get("ids", np.int64)[out], get("keys", np.int64)[out], start, start + np.int32(width))],
            names=["__id", "__key", "start", "stop"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: list[dict] = []
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if runs and (runs[0]["anchor"], runs[0]["part"]) != (row["anchor"], row["part"]):
                    yield settle(runs)
                    runs = []
                runs.append(row)
        if runs:
            yield settle(runs)

    return merge


def repeated_spans(docs: DataFrame, width: int = 400, part: int = PART) -> DataFrame:
    """(__id, __key, start, stop): byte spans covered by strings of ``width`` bytes that start elsewhere too.

    ``docs`` needs __id, __key and text (see ``keyed``). The table is in the shared folder.
    """
    texts = docs.select("__id", "__key", "text")
    found = texts.mapInArrow(_find_segments(width, part), SEGMENT)
    alive = written(found.groupBy("anchor").count().where("count > 1").select("anchor"), "suffix-anchors")
    near = marked(found, bitmap(alive, "anchor"), "anchor").where("__hit").drop("__hit")
    cand = written(near.join(alive, "anchor"), "suffix-segments")

    same = ["anchor", "d1", "d2"]
    kinds = written(cand.groupBy(*same).agg(
        F.count("*").alias("copies"), F.min(F.struct("__id", "__key", "first", "n")).alias("one")), "suffix-kinds")
    copies = cand.join(kinds.where("copies > 1").select(*same), same)
    whole = copies.select("__id", "__key", F.col("first").alias("start"),
                          (F.col("first") + F.col("n") - 1 + width).alias("stop"))

    shards = kinds.groupBy("anchor").agg(F.count("*").alias("segments"))
    shards = shards.where("segments > 1").withColumn("shards", F.ceil(F.col("segments") / SHARD_SEGMENTS))
    rows = kinds.join(written(shards, "suffix-shards"), "anchor").select(
        "one.*", "anchor", F.pmod("d1", "shards").cast("int").alias("shard"),
        F.col("shards").cast("int").alias("shards"), (F.col("copies") == 1).alias("single"))
    fields = ["anchor", "shard", "shards", "single", "first", "n"]
    lists = written(rows.groupBy("__id", "__key").agg(F.collect_list(F.struct(*fields)).alias("segments")), "suffix-lists")
    there = marked(texts, bitmap(lists, "__id"), "__id").where("__hit").drop("__hit").dropDuplicates(["__id", "__key"])
    sent = there.join(lists, ["__id", "__key"]).mapInArrow(
        _extract(width), "__id long, __key long, anchor long, shard int, shards int, single boolean, first int, bytes binary")
    dealt = sent.repartition("anchor", "shard").sortWithinPartitions("anchor", "shard")
    solved = written(dealt.mapInArrow(_shards(width), SHARD_OUT), "suffix-solved")
    spans = F.explode(F.arrays_zip("ids", "keys", "starts", "stops")).alias("s")
    local = solved.where("part < 0").select(spans).select(
        F.col("s.ids").alias("__id"), F.col("s.keys").alias("__key"), F.col("s.starts").alias("start"), F.col("s.stops").alias("stop"))
    handed = solved.where("part >= 0").repartition("anchor", "part").sortWithinPartitions("anchor", "part")
    merged = handed.mapInArrow(_merge(width), "__id long, __key long, start int, stop int")
    return written(whole.unionByName(local).unionByName(merged), "suffix-spans")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in blocks(batches):
        raw = b.bytes.tobytes()
        kept, size, removed, n_spans, shas = [], [], [], [], []
        for i, spans in enumerate(b.rows.column(b.rows.schema.get_field_index("spans")).to_pylist()):
            here = raw[b.offsets[i]:b.offsets[i + 1]]
            n, out, at, gone, many = len(here), [], 0, 0, 0
            for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
                if start > at or not many:
                    out.append(here[at:start])
                    many += 1
                    at = start
                gone += max(0, stop - at)
                at = max(at, stop)
            out.append(here[at:])
            here = b"".join(out)
            kept.append(here)
            size.append(n)
            removed.append(gone)
            n_spans.append(many)
            shas.append(hashlib.sha256(here).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [b.rows.column(b.rows.schema.get_field_index("__id")), pa.array(kept, pa.binary()), pa.array(size, pa.int64()),
             pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(shas)],
            names=["__id", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeated_bytes(docs: DataFrame, width: int = 400, part: int = PART) -> DataFrame:
    """doc_id, kept (bytes), n_bytes (before), n_removed, n_spans (maximal removed runs) and kept_sha256 of every text."""
    docs = keyed(docs.select("doc_id", "text"))
    spans = repeated_spans(docs, width, part)
    lists = written(spans.groupBy("__id", "__key").agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "suffix-cuts")
    both = marked(docs, bitmap(lists, "__id"), "__id")
    plain = both.where("not __hit").select("__id", "text", F.lit(None).cast(lists.schema["spans"].dataType).alias("spans"))
    joined = both.where("__hit").join(lists, ["__id", "__key"], "left").select("__id", "text", "spans")
    schema = "__id long, kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    out = plain.mapInArrow(_cut, schema).unionByName(joined.mapInArrow(_cut, schema))
    return out.select(external_id(F.col("__id")).alias("doc_id"), "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def query(spark, sf_dir: str) -> DataFrame:
    """op3: bytes of 400-byte strings that start anywhere else too, removed from every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeated_bytes(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


SQL = """
WITH d AS (SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n
           FROM documents),
places AS (SELECT k, x, unnest(range(0, n - 399)) AS s FROM d),
w AS MATERIALIZED (SELECT k, s, md5_number(substr(x, 2 * s + 1, 800)) AS m FROM places),
hits AS (SELECT k, s, lag(s) OVER (PARTITION BY k ORDER BY s) AS p
         FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)),
numbered AS (SELECT k, s, sum(CASE WHEN p IS NULL OR s > p + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY s) AS g FROM hits),
spans AS (SELECT k, g, min(s) AS a, max(s) + 400 AS z FROM numbered GROUP BY k, g),
pieces AS (SELECT k, a, z, lead(a) OVER (PARTITION BY k ORDER BY a) AS b FROM spans),
cut AS (SELECT k, sum(z - a) AS n_removed, count(*) AS n_spans, min(a) AS head,
               string_agg(substr(x, 2 * z + 1, 2 * (coalesce(b, n) - z)), '' ORDER BY a) AS rest
        FROM pieces JOIN d USING (k) GROUP BY k)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(substr(x, 1, 2 * head) || rest, x))) AS kept_sha256
FROM d LEFT JOIN cut USING (k)
"""
