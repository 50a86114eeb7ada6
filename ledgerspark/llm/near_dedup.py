"""Operator 4: near-duplicate documents by SuperMinHash, banding, verification and union-find.

Texts are lower-cased (A to Z); a document's set holds its distinct shingles of
``size`` words. Documents whose Jaccard similarity is at least ``percent`` / 100
are linked, and linked documents share a component.

1. Signatures. Documents with equal sets are one class; only its representative
   (least id) goes on, so copies cost one row each and are never paired.
2. Banding. ``bands`` bands of ``rows`` slots. At the default 36 x 5 a pair at
   exactly 0.8 shares no band with probability 6e-7.
3. Hubs. A band value that several representatives share is a bucket; its hub is
   the member with the largest buckets, in a group of edited copies usually the
   original. Every member is verified against its hubs on the full sets: one row per
   member and bucket at most, never all pairs.
4. The rest, without loss. Two members of a bucket that are not both linked with its
   hub p may still be linked. With D(z) the symmetric difference of z and p,
   |x ^ y| = |D(x)| + |D(y)| - 2 |D(x) & D(y)|, and x and y are linked exactly when
   |x ^ y| <= r (|x| + |y|), r = (1 - s) / (1 + s). If x is not linked with p, that
   needs a common element of D(x) and D(y). So verification also returns D, and the
   members that are not linked are looked up among all members of their hub by the
   elements of D: counting common elements gives the exact similarity, pairs without
   one never appear, and only links leave the task. The looked-up members of a hub are
   split into blocks of about ``BLOCK_ELEMENTS`` elements, against which the others are
   streamed.
5. Components of the verified links by union-find and star rounds.

Scale: everything but step 3 works on hashes. Texts are shuffled only for
representatives in a bucket, found by a bit map of fixed size. Joins have plain
exchanges on both sides, which Spark splits when a bucket or hub is hot; a block of
step 4 is bounded, and its other side is streamed.

Defined cases: null, empty or wordless texts have n_shingles 0, are linked with
nothing and kept; a text with fewer than ``size`` words has its whole sequence as
one shingle; an id names a document, so rows that share an id share a component;
rows without id are linked with nothing and kept (component null); an empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.blocks import Block, U, blocks, mix
from ledgerspark.llm.common import EXTRAS, NO_ID, bitmap, external_id, internal_id, keyed, marked, packed, unpacked, written
from ledgerspark.llm.components import components
from ledgerspark.llm.minhash import shingles, superminhash

BANDS, ROWS = 36, 5


def _sign(size: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            b.lower()
            n = len(b.rows)
            text, values = shingles(b, size)
            count = np.bincount(text, minlength=n)
            slots = superminhash(text, values, n, bands * rows)
            band = np.zeros((n, bands), U)
            for k in range(rows):
                band = mix(band + slots[:, k::rows] + U(k + 1))
            band = mix(band + np.arange(1, bands + 1, dtype=U))
            sums = np.zeros((2, n), U)
            for k in range(2):
                np.add.at(sums[k], text, mix(values + U(k + 1)))
            get = lambda c: b.rows.column(b.rows.schema.get_field_index(c))
            flat = pa.array(band.ravel().view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), flat)
            yield pa.RecordBatch.from_arrays(
                [get("__id"), get("__key"), pa.array(count.astype(np.int64)), pa.array(sums[0].view(np.int64)),
                 pa.array(sums[1].view(np.int64)), lists],
                names=["__id", "__key", "n_shingles", "s1", "s2", "bands"])

    return sign


def _sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted shingle hashes of each text."""
    out: list[np.ndarray] = []
    for b in blocks(iter([pa.RecordBatch.from_arrays([texts], names=["text"])])):
        b.lower()
        text, values = shingles(b, size)
        cut = np.searchsorted(text, np.arange(len(b.rows) + 1))
        out += [values[cut[i]:cut[i + 1]] for i in range(len(b.rows))]
    return out


def _verify(size: int, percent: int):
    """Rows with texts ``left`` and ``right``, its hub: whether they are linked on the full sets, left's size and,
    where ``wide``, the hashed elements of left's difference to right (with the side they are on)."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 512):
                b = big.slice(at, 512)
                get = lambda c: b.column(b.schema.get_field_index(c))
                left, right = _sets(get("left"), size), _sets(get("right"), size)
                linked, sizes, parts = [], [], []
                for x, y, wide in zip(left, right, get("wide").to_pylist()):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    linked.append(100 * common >= percent * (len(x) + len(y) - common))
                    sizes.append(len(x))
                    parts.append(np.concatenate((mix(np.setdiff1d(x, y, assume_unique=True) + U(1)),
                                                 mix(np.setdiff1d(y, x, assume_unique=True) + U(2)))).view(np.int64) if wide else None)
                yield pa.RecordBatch.from_arrays(
                    [get("u"), get("u_key"), get("v"), get("v_key"), pa.array(linked), pa.array(sizes, pa.int64()),
                     pa.array(parts, pa.list_(pa.int64()))],
                    names=["u", "u_key", "v", "v_key", "linked", "n", "part"])

    return verify


#: Elements (and as many again for each member's own figures) that a block of looked-up members holds, and meetings
#: that are worked on at a time.
BLOCK_ELEMENTS, MEETINGS = 1 << 20, 1 << 21
MEMBER_COST = 8


class _Members:
    """Members of a hub with the sorted elements of their differences to it."""

    def __init__(self, u: np.ndarray, n: np.ndarray, sizes: np.ndarray, elements: np.ndarray, percent: int):
        self.u, self.n, self.sizes, self.elements = u, n, sizes, elements
        self.owner = np.repeat(np.arange(len(u)), sizes)
        #: A pair is linked if it has at least the sum of its two needs in common.
        self.need = (sizes - (100 - percent) / (100 + percent) * n) / 2

    def places(self, often: np.ndarray) -> np.ndarray:
        """Places of the elements in their member's order, the rarest first (``often`` counts them, ties by hash)."""
        by = np.lexsort((self.elements, often, self.owner))
        first = np.cumsum(self.sizes) - self.sizes
        out = np.empty(len(by), np.int64)
        out[by] = np.arange(len(by)) - first[self.owner[by]]
        return out


SLACK = 1e-6


class _Index:
    """Looked-up members by element.

    Prefix filtering: members x and y with t elements in common, each taken in one order of all elements, meet
    in x's first d(x) - t + 1 and y's first d(y) - t + 1 elements. With t >= need(x) + need(y), an element at
    place i of x matters to y only if need(x) - d(x) + i <= -need(y). The members of an element are sorted by that
    left side, so those that matter to y come first. The rarest elements come first in the order, so an element
    that all members of a hub share comes last, where it matters only to pairs that it may link.
    """

    def __init__(self, members: _Members, percent: int):
        self.members, self.percent = members, percent
        self.unique, seg, often = np.unique(members.elements, return_inverse=True, return_counts=True)
        left = (members.need - members.sizes)[members.owner] + members.places(often[seg])
        self.low = float(left.min(initial=0.0)) - 1
        self.width = float(left.max(initial=0.0)) - self.low + 2
        key = seg * self.width + (left - self.low)
        by = np.argsort(key, kind="stable")
        self.key, self.owner = key[by], members.owner[by]
        self.first = np.concatenate([[0], np.cumsum(often)])
        self.own = np.sort(self._pairs(members.owner, members.elements))
        self.by_u = np.argsort(members.u, kind="stable")
        #: Union-find over the members and, last, the hub's own component.
        self.root = np.arange(len(members.u) + 1)

    @staticmethod
    def _pairs(owner: np.ndarray, elements: np.ndarray) -> np.ndarray:
        return mix(elements.view(U) + mix(owner.astype(U) + U(1)))

    def links(self, asking: _Members) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(u, v) of the links between members that ask and looked-up ones; those that join nothing new are left out."""
        if not len(self.unique) or not len(asking.u):
            return
        seg = np.minimum(np.searchsorted(self.unique, asking.elements), len(self.unique) - 1)
        there = self.unique[seg] == asking.elements
        often = np.where(there, np.diff(self.first)[seg], 0)
        place = asking.places(often)
        at = np.clip(-asking.need[asking.owner] + SLACK - self.low, -0.5, self.width - 0.5)
        upto = np.searchsorted(self.key, seg * self.width + at, side="right") - self.first[seg]
        met = np.where(there, np.maximum(upto, 0), 0)
        # x's own need may be at most what is left of y from this place on
        most = (asking.sizes - asking.need)[asking.owner] - place + SLACK
        rows = np.flatnonzero(met)
        cuts = np.searchsorted(np.cumsum(met[rows]), np.arange(MEETINGS, met.sum() + MEETINGS, MEETINGS), side="right") if len(rows) else []
        lo = 0
        for hi in [*cuts, len(rows)]:
            hi = max(int(hi), lo + 1) if lo < len(rows) else lo
            some = rows[lo:hi]
            lo = hi
            if not len(some):
                continue
            n = met[some]
            k = np.repeat(self.first[seg[some]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            x, y = self.owner[k], np.repeat(asking.owner[some], n)
            fit = self.members.need[x] <= np.repeat(most[some], n)
            both = np.unique(y[fit] * len(self.members.u) + x[fit])
            yield from self._linked(asking, both // len(self.members.u), both % len(self.members.u))

    def _linked(self, asking: _Members, y: np.ndarray, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Judge pairs by counting what they have in common, some at a time."""
        first = np.cumsum(asking.sizes) - asking.sizes
        ends = np.cumsum(asking.sizes[y])
        for lo in range(0, int(ends[-1]) if len(ends) else 0, MEETINGS):
            some = slice(*np.searchsorted(ends, [lo, lo + MEETINGS], side="right"))
            ys, xs = y[some], x[some]
            if not len(ys):
                continue
            d = asking.sizes[ys]
            at = np.repeat(first[ys], d) + np.arange(d.sum()) - np.repeat(np.cumsum(d) - d, d)
            key = self._pairs(np.repeat(xs, d), asking.elements[at])
            here = self.own[np.minimum(np.searchsorted(self.own, key), len(self.own) - 1)] == key
            common = np.bincount(np.repeat(np.arange(len(ys)), d), weights=here, minlength=len(ys)).astype(np.int64)
            both, apart = asking.n[ys] + self.members.n[xs], d + self.members.sizes[xs] - 2 * common
            good = (common > 0) & (100 * (both - apart) >= self.percent * (both + apart)) & (asking.u[ys] != self.members.u[xs])
            yield self._joining(asking, ys[good], xs[good])

    def _joining(self, asking: _Members, y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The links that join two components: one that asks and is not looked up is linked with the hub."""
        u = self.members.u
        place = np.minimum(np.searchsorted(u, asking.u[y], sorter=self.by_u), len(u) - 1)
        node = self.by_u[place]
        node = np.where(u[node] == asking.u[y], node, len(u))
        while not np.array_equal(self.root, self.root[self.root]):
            self.root = self.root[self.root]
        new = []
        for k in np.flatnonzero(self.root[x] != self.root[node]).tolist():
            a, b = int(x[k]), int(node[k])
            while self.root[a] != a:
                a = int(self.root[a])
            while self.root[b] != b:
                b = int(self.root[b])
            if a != b:
                self.root[min(a, b)] = max(a, b)
                new.append(k)
        return asking.u[y[new]], u[x[new]]


def _look_up(percent: int):
    """Rows sorted by (v, v_key, block, role): the members of a block (role 0), then all members of its hub."""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, asked, index = None, [], None
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            v, key, block, role, u, n = (get(c).to_numpy() for c in ("v", "v_key", "block", "role", "u", "n"))
            sizes = get("part").value_lengths().to_numpy().astype(np.int64)
            first = np.concatenate([[0], np.cumsum(sizes)])
            elements = get("part").flatten().to_numpy()
            new = (np.diff(v) != 0) | (np.diff(key) != 0) | (np.diff(block) != 0) | (np.diff(role) != 0)
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if (v[a], key[a], block[a]) != hub:
                    hub, asked, index = (v[a], key[a], block[a]), [], None
                some = (u[a:b], n[a:b].astype(np.int64), sizes[a:b], elements[first[a]:first[b]])
                if role[a] == 0:
                    asked.append(some)
                    continue
                if index is None:
                    held = [np.concatenate(c) for c in zip(*asked)] if asked else [c[:0] for c in some]
                    index, asked = _Index(_Members(*held, percent), percent), []
                for left, right in index.links(_Members(*some, percent)):
                    yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["u", "v"])

    return look_up


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """``pairs`` (u, u_key, v, v_key, wide) judged on the full sets."""
    ends = pairs.select("u").unionByName(pairs.select(F.col("v").alias("u")))
    there = marked(texts, bitmap(ends, "u"), "__id").where("__hit").drop("__hit").dropDuplicates(["__id", "__key"])
    left = there.select(F.col("__id").alias("u"), F.col("__key").alias("u_key"), F.col("text").alias("left"))
    right = there.select(F.col("__id").alias("v"), F.col("__key").alias("v_key"), F.col("text").alias("right"))
    return pairs.join(left, ["u", "u_key"]).join(right, ["v", "v_key"]).mapInArrow(
        _verify(size, percent), "u long, u_key long, v long, v_key long, linked boolean, n long, part array<long>")


def links(signed: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(u, v): verified links between class representatives.

    ``signed`` has __id, __key, n_shingles, s1, s2 and bands of all documents with words.
    """
    texts = docs.select("__id", "__key", "text")
    first = written(signed.groupBy("s1", "s2").agg(F.min(F.struct("__id", "__key")).alias("r")).select("r.*"), "near-classes")
    reps = first.join(signed.select("__id", "__key", "bands"), ["__id", "__key"])
    rows = reps.select("__id", "__key", F.explode("bands").alias("band"))
    buckets = written(rows.groupBy("band").agg(F.count("*").alias("n"), F.min("__id").alias("low"), F.max("__id").alias("high"))
                      .where("low < high").select("band", "n"), "near-buckets")
    members = marked(rows, bitmap(buckets, "band"), "band").where("__hit").drop("__hit")
    members = written(members.join(buckets, "band"), "near-members")
    popular = written(members.groupBy("__id", "__key").agg(F.sum("n").alias("score")), "near-popular")
    members = written(members.join(popular, ["__id", "__key"]).select("band", "__id", "__key", "score"), "near-scored")
    # ties go to the least id
    hubs = members.groupBy("band").agg(F.max_by(F.struct("__id", "__key"), F.struct("score", -F.col("__id"), "__key")).alias("hub"))
    stars = members.join(written(hubs, "near-hubs"), "band").where("__id <> hub.__id").select(
        F.col("__id").alias("u"), F.col("__key").alias("u_key"), F.col("hub.__id").alias("v"), F.col("hub.__key").alias("v_key"))
    stars = written(stars.distinct(), "near-stars")
    wide = stars.groupBy("v", "v_key").count().where("count > 1").select("v", "v_key", F.lit(True).alias("wide"))
    stars = written(stars.join(wide, ["v", "v_key"], "left").withColumn("wide", F.coalesce("wide", F.lit(False))), "near-pairs")
    tested = written(_verified(stars, texts, size, percent), "near-tested")

    hub = ["v", "v_key"]
    open_ = tested.where("not linked and part is not null")
    blocks_ = written(open_.groupBy(*hub).agg((F.floor(F.sum(F.size("part") + MEMBER_COST) / BLOCK_ELEMENTS) + 1).cast("int").alias("blocks")), "near-open")
    asked = open_.join(blocks_, hub).withColumn("block", F.pmod(F.xxhash64("u", "u_key"), "blocks").cast("int"))
    others = tested.join(blocks_, hub).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cols = [*hub, "block", "role", "u", "n", "part"]
    rows = asked.withColumn("role", F.lit(0)).select(*cols).unionByName(others.withColumn("role", F.lit(1)).select(*cols))
    dealt = rows.repartition(*hub, "block").sortWithinPartitions(*hub, "block", "role")
    more = dealt.mapInArrow(_look_up(percent), "u long, v long").where("u <> v")
    return written(tested.where("linked").select("u", "v").unionByName(more), "near-links")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document. ``docs`` needs doc_id and text."""
    docs = keyed(docs.select("doc_id", "text"))
    signed = written(docs.select("__id", "__key", "text").mapInArrow(
        _sign(size, bands, rows), "__id long, __key long, n_shingles long, s1 long, s2 long, bands array<long>"), "near-signed")
    some = signed.where((F.col("n_shingles") > 0) & (F.col("__id") != NO_ID))
    found = components(links(some, docs, size, percent))
    classes = some.groupBy("s1", "s2").agg(F.min("__id").alias("node")).join(found, "node", "left")
    classes = written(classes.select("s1", "s2", F.coalesce("component", "node").alias("component")), "near-components")
    out = some.select("__id", "n_shingles", "s1", "s2").join(classes, ["s1", "s2"]).select("__id", "n_shingles", "component")
    none = signed.where((F.col("n_shingles") == 0) | (F.col("__id") == NO_ID)).select("__id", "n_shingles", F.col("__id").alias("component"))
    return out.unionByName(none).select(
        external_id(F.col("__id")).alias("doc_id"), "n_shingles", external_id(F.col("component")).alias("component_id"),
        (F.col("__id") == F.col("component")).alias("kept"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of every component, all columns kept.

    A document is an id with its text: of rows equal in both one stays. Where an id comes with several texts, the
    one with the least hash has the id, and the others stand behind all ids when a component chooses who stays.
    Rows without id all stay.
    """
    reads = ("doc_id", "text")
    rows = _told_apart(packed(docs, *reads))
    nodes = rows.select(F.col("__node").alias("doc_id"), "text")
    found = written(near_duplicates(nodes, size, percent).where("doc_id is not null"), "near-found")
    gone = found.where("not kept").select("doc_id").unionByName(
        found.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    rows = rows.withColumn("__id", internal_id("__node"))
    rows = marked(rows, bitmap(gone.withColumnRenamed("doc_id", "__id"), "__id"), "__id")
    own = [*reads, EXTRAS]
    whole = rows.where("not __hit or __node is null").select(*own)
    kept = found.where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    some = rows.where("__hit and __node is not null").join(kept, F.col("__node") == F.col("__kept"))
    rows = whole.unionByName(some.dropDuplicates(["__kept"]).select(*own))
    return rows.select(*unpacked(rows, docs, *reads))


def _told_apart(rows: DataFrame) -> DataFrame:
    """``rows`` plus ``__node``: the id, or where the id has several texts, for all but one a number of its own above 2^62."""
    keys = rows.select("doc_id", F.xxhash64("text").alias("__key")).where("doc_id is not null")
    several = keys.groupBy("doc_id").agg(F.min("__key").alias("__least"), F.max("__key").alias("__most")).where("__least < __most")
    several = written(several.select(F.col("doc_id").alias("__shared"), "__least"), "near-shared")
    rows = marked(rows.withColumns({"__key": F.xxhash64("text"), "__id": F.col("doc_id")}), bitmap(several, "__shared"), "__id")
    plain = rows.where("not __hit").withColumn("__node", F.col("doc_id").cast("long"))
    some = rows.where("__hit").join(several, F.col("doc_id") == F.col("__shared"), "left")
    own = F.pmod(F.xxhash64(F.lit("node"), "doc_id", "__key"), F.lit(1 << 61)) + F.lit(1 << 62)
    some = some.withColumn("__node", F.when(F.col("__key") != F.col("__least"), own).otherwise(F.col("doc_id").cast("long")))
    columns = [c for c in rows.columns if not c.startswith("__") or c == EXTRAS] + ["__node"]
    return plain.select(*columns).unionByName(some.select(*columns))


def query(spark, sf_dir: str) -> DataFrame:
    """op4: components of all documents on 2-word shingles at a similarity of 0.8."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=2)


SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) = 1 THEN words
    ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS ss FROM w),
n AS (SELECT doc_id, len(ss)::BIGINT AS n_shingles, ss FROM s),
e AS (SELECT doc_id, n_shingles, unnest(ss) AS g FROM n),
p AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id
  WHERE a.n_shingles * 100 >= 80 * b.n_shingles AND b.n_shingles * 100 >= 80 * a.n_shingles
  GROUP BY a.doc_id, b.doc_id, a.n_shingles, b.n_shingles
  HAVING 100 * count(*) >= 80 * (a.n_shingles + b.n_shingles - count(*))),
l AS (SELECT u, v FROM p UNION ALL SELECT v, u FROM p),
r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM n
  UNION
  SELECT r.doc_id, l.v FROM r JOIN l ON r.reached = l.u),
c AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id)
SELECT n.doc_id, n.n_shingles, c.component_id, n.doc_id = c.component_id AS kept
FROM n JOIN c USING (doc_id)
"""
