"""Problem 2: groups of records whose verses are nearly the same.

Method: PartEnum signatures. A record is the set of its neighbouring word pairs (hashed). Jaccard similarity g bounds the
symmetric difference of two sets of sizes n and m by (1-g)/(1+g) (n+m). Sets are banded by size (ratio g), and each signs
for its own band and, if a partner can be that large, for the next, so two similar sets meet in the band of the larger.
For a band the hashed feature domain is split into n1 parts of N2 subparts. In a part at most K2 subparts may differ: all
subsets of N2 - K2 subparts are enumerated and each gives one signature, the hash of all features in them.

* Breaking a part (leaving no signature in common) costs at least min(K2 + 1, subparts the set fills) differences. Parts
  are taken in one fixed order until their cost exceeds the most differences a partner may have: whichever part two
  similar sets first agree in lies within what both have written.
* Larger sets take a few more parts, so that similar ones agree in two to twelve of them (AGREE): chance meetings in a
  single signature are no candidates. A signature carries how much it counts.
* A set whose parts cost too little in all ("thin": short poems) signs besides with every two of its first features in
  hash order, of which a partner must share two (of a single feature: that one). If one of two similar sets is not thin
  they meet in a part, if both are thin in such a pair.

Parameters follow from the size band alone, so a set writes the same signatures in a corpus of any size: about 1.6 for
each feature. They travel packed (5 bytes and a 3-byte reference each), bucketed by hash, in one shuffle; a task meets
them bucket by bucket in sorted arrays of bounded length.

Hot signatures (a refrain shared by very many records) are not paired up. A signature with more than BUCKET members,
which a task that writes many notices before the shuffle, marks its members; marked sets are joined by their rarest
features instead (counted exactly among the marked): two similar sets share one of the rarest n - ceil(g n) + 1, and two
of the rarest n - ceil(g n) + 2, which decides where more than WIDE sets share one. That join is by sorting, so a key is
never held by a task; a refrain takes part only in sets it makes up by more than g.

Exact copies (equal 128-bit hash of the feature set) are one set throughout; membership says which records it stands for.

Defined results: records without two words (null, empty, blank verses) have no features, form no pairs and are their own
group; repeated sample_ids are one record, which keeps all its row indices and URLs; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qafila.llm.unify import words
from qafila.operators.components import components
from qafila.runtime import cut, scratch_path, small, spread

THRESHOLD = 0.6
#: Subparts of a part, and how many of them may differ.
N2, K2 = 3, 1
#: Features of a band's largest set for each part.
PER_PART = 2.0
#: Parts in which similar sets must agree, by the size of the band's largest set from which on so many are asked for.
AGREE = ((0, 1), (28, 2), (64, 3), (120, 4), (240, 6), (480, 12))
#: A signature counts WHOLE / (agreeing parts asked for); a pair is a candidate from WHOLE on.
WHOLE = 12
#: Members of a signature that are paired up; others are found by their rarest features.
BUCKET = 64
#: Marked sets at one rare feature beyond which two are asked for; of the features before a meeting the first few are kept.
WIDE, REMEMBERED = 4096, 16
#: Features signed at a time, and signatures met at a time.
CHUNK, MEET = 400_000, 1_000_000
_KEPT_WORDS = 500_000


class _WordHashes(dict):
    """The 64-bit hashes of words, filled as they are met and emptied when it holds too many."""

    def __missing__(self, w: str) -> int:
        if len(self) > _KEPT_WORDS:
            self.clear()
        self[w] = h = xxhash.xxh64_intdigest(w)
        return h


_WORD_HASH = _WordHashes()


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """Another, independent hash of 64-bit hashes."""
    z = x.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word of a text, in order."""
    ws = words(text)
    return np.fromiter(map(_WORD_HASH.__getitem__, ws), dtype=np.uint64, count=len(ws))


def features(verses: list[str | None] | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct pairs of neighbouring words, all verses in order."""
    h = word_hashes(" ".join(v for v in verses if v) if verses is not None else None)
    if len(h) < 2:
        return np.zeros(0, dtype=np.int64)
    return np.unique(_mix(_mix(h[:-1], 11) * np.uint64(3) + _mix(h[1:], 12), 13).astype(np.int64))


def set_key(feats: np.ndarray) -> tuple[int, int]:
    """128 bits that name a feature set."""
    raw = xxhash.xxh128_intdigest(feats.tobytes())
    return (raw >> 64) - (1 << 63), (raw & ((1 << 64) - 1)) - (1 << 63)


# ---------------------------------------------------------------- PartEnum
@lru_cache(maxsize=8)
def bands(upto: int, g: float) -> list[tuple[int, int]]:
    """(smallest, largest size) of each band in which a set of up to `upto` features or its partner may lie."""
    out, low = [], 1
    while low <= upto / g:
        out.append((low, int(low / g + 1e-9)))
        low = out[-1][1] + 1
    return out


@lru_cache(maxsize=8)
def enumeration(n2: int, k2: int) -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray]:
    """The subsets of n2 - k2 subparts; for each pattern of filled subparts which of them give a projection of their own,
    and what it costs to break the part."""
    subsets = list(combinations(range(n2), n2 - k2))
    own = np.zeros((1 << n2, len(subsets)), dtype=bool)
    for filled in range(1 << n2):
        seen = {0}
        for j, subset in enumerate(subsets):
            left = filled & sum(1 << i for i in subset)
            own[filled, j] = left not in seen
            seen.add(left)
    return subsets, own, np.array([min(k2 + 1, filled.bit_count()) for filled in range(1 << n2)])


def _differences(sizes: np.ndarray, top: int, g: float) -> np.ndarray:
    """The most differences to a partner of at most `top` features."""
    return np.floor((1 - g) / (1 + g) * (sizes + np.minimum(top, np.floor(sizes / g + 1e-9))) + 1e-9).astype(np.int64)


def _band_signatures(flat, owner, sizes, members, band: int, top: int, g: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures and their sets for the member sets of a band, and which of the members are thin."""
    n1, salt = max(1, math.ceil(top / PER_PART)), 2 * band
    place = np.full(len(sizes), -1)
    place[members] = np.arange(len(members))
    mine = place[owner] >= 0
    feats, cell = flat[mine], place[owner[mine]] * (n1 * N2)
    cell += (_mix(feats, salt) % np.uint64(n1 * N2)).astype(np.int64)
    content = np.zeros(len(members) * n1 * N2, dtype=np.uint64)
    np.add.at(content, cell, _mix(feats, salt + 1))
    filled = np.zeros(len(content), dtype=bool)
    filled[cell] = True
    content = content.reshape(-1, N2)
    subsets, own, costs = enumeration(N2, K2)
    pattern = filled.reshape(-1, N2) @ (1 << np.arange(N2))
    cost = costs[pattern].reshape(-1, n1)
    asked = max(t for least, t in AGREE if top >= least)
    most = _differences(sizes[members], top, g) + (asked - 1) * (K2 + 1)
    wanted = ((np.cumsum(cost, axis=1) - cost) <= most[:, None]).reshape(-1)
    part, who = np.tile(np.arange(n1, dtype=np.uint64), len(members)), np.repeat(members, n1)
    sigs, sets = [], []
    for j, subset in enumerate(subsets):
        at = np.flatnonzero(wanted & own[pattern, j])
        total = content[at][:, list(subset)].sum(axis=1, dtype=np.uint64)
        sigs.append(_counting(_mix(total + _mix(part[at], 500 + band), 700), asked))
        sets.append(who[at])
    return np.concatenate(sigs), np.concatenate(sets), members[cost.sum(axis=1) <= most]


def _counting(sig: np.ndarray, asked: int) -> np.ndarray:
    """Signatures whose four lowest bits say in how many of their kind a pair must agree."""
    return sig & ~np.uint64(15) | np.uint64(asked)


def _pair_signatures(feats: np.ndarray, g: float) -> np.ndarray:
    """Of a thin set: every two of its first n - ceil(g n) + 2 features in hash order; of a single feature that one."""
    n = len(feats)
    order = np.sort(_mix(feats, 900))[: n - math.ceil(g * n - 1e-9) + 2]
    if n == 1:
        return _counting(_mix(order, 901), 1)
    a, b = np.triu_indices(len(order), 1)
    return _counting(_mix(order[a] + _mix(order[b], 902), 903), 1)


def signatures(sets: list[np.ndarray], g: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, number of the set of each) of sets of features, none empty; a set has each signature once."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    flat, owner = np.concatenate(sets).view(np.uint64), np.repeat(np.arange(len(sets)), sizes)
    out, thin = [], set()
    partner = np.floor(sizes / g + 1e-9)
    for band, (low, top) in enumerate(bands(int(sizes.max()), g)):
        members = np.flatnonzero((sizes <= top) & (partner >= low))
        if len(members):
            sig, who, few = _band_signatures(flat, owner, sizes, members, band, top, g)
            out.append((sig, who))
            thin.update(few.tolist())
    for i in sorted(thin):
        sig = _pair_signatures(sets[i], g)
        out.append((sig, np.full(len(sig), i)))
    return np.concatenate([s for s, _ in out]), np.concatenate([w for _, w in out])


# ---------------------------------------------------------------- the written table: kind m(embers), f(eatures)
_ROW = pa.schema([("kind", pa.string()), ("sample_id", pa.string()), ("sid", pa.int64()), ("k0", pa.int64()), ("k1", pa.int64()), ("n", pa.int32()), ("features", pa.list_(pa.int64()))])
_ROW_DDL = "kind string, sample_id string, sid bigint, k0 bigint, k1 bigint, n int, features array<bigint>"
_TASK_BITS = 40


def _rows(kind: str, length: int, /, **columns) -> pa.RecordBatch:
    arrays = [pa.repeat(kind, length)] + [pa.array(columns[f.name], type=f.type) if f.name in columns else pa.nulls(length, f.type) for f in list(_ROW)[1:]]
    return pa.RecordBatch.from_arrays(arrays, schema=_ROW)


def _read_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records to members and their distinct sets, numbered (sid) by task and turn."""
    known: dict[tuple[int, int], int] = {}
    first = TaskContext.get().partitionId() << _TASK_BITS
    for batch in batches:
        sids, fresh = [], []
        for verses in batch.column("verses").to_pylist():
            f = features(verses)
            if not len(f):
                sids.append(None)
                continue
            key = set_key(f)
            if key not in known:
                known[key] = first + len(known)
                fresh.append((known[key], *key, len(f), f))
            sids.append(known[key])
        yield _rows("m", len(sids), sample_id=batch.column("sample_id").to_pylist(), sid=sids)
        if fresh:
            yield _rows("f", len(fresh), **{name: [x[i] for x in fresh] for i, name in enumerate(("sid", "k0", "k1", "n", "features"))})


class Sets:
    """The distinct feature sets of all records, written once to the shared folder."""

    def __init__(self, records: DataFrame, g: float = THRESHOLD) -> None:
        self.g, self.spark = g, records.sparkSession
        path = scratch_path(self.spark, "sets")
        rows = spread(records.filter("sample_id is not null").select("sample_id", "verses"))
        rows.mapInArrow(_read_sets, _ROW_DDL).write.option("compression", "zstd").partitionBy("kind").parquet(path)
        self._all = self.spark.read.schema(_ROW_DDL).parquet(path)
        # a set that several tasks met is the smallest of its numbers; one row a task, however many records are copies
        heads = self._kind("f", "sid", "k0", "k1")
        many = heads.groupBy("k0", "k1").agg(F.min("sid").alias("head"), F.count("*").alias("c")).filter("c > 1")
        self._copies = small(cut(heads.join(many, ["k0", "k1"]).filter("sid <> head").select("sid", "head")))

    def _kind(self, kind: str, *columns: str) -> DataFrame:
        return self._all.filter(F.col("kind") == kind).select(*columns)

    def membership(self) -> DataFrame:
        """sample_id, id; records without features have a null id."""
        both = self._kind("m", "sample_id", "sid").join(self._copies, "sid", "left")
        return both.select("sample_id", F.coalesce("head", "sid").alias("id")).distinct()

    def features(self) -> DataFrame:
        """id, n, features of each distinct set."""
        return self._kind("f", "sid", "n", "features").join(self._copies, "sid", "left_anti").withColumnRenamed("sid", "id")

    def size(self) -> int:
        """Features in all."""
        return self._kind("f", "n").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


# ---------------------------------------------------------------- packed signatures, met bucket by bucket
_PACKED = pa.schema([("bucket", pa.int64()), ("base", pa.int64()), ("sigs", pa.binary()), ("refs", pa.binary())])
_PACKED_DDL = "bucket bigint, base bigint, sigs binary, refs binary"
_MET = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("worth", pa.int32())])


def _planes(x: np.ndarray, width: int) -> bytes:
    """The low bytes of numbers, highest first, byte by byte: sorted numbers compress well this way."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width][:, ::-1].T).tobytes()


def _unplanes(raw: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(width, -1)
    out = np.zeros(planes.shape[1], dtype=np.uint64)
    for plane in planes:
        out = (out << np.uint64(8)) | plane
    return out


def _pack(buckets: int, bucket_size: int, g: float):
    """Signatures of sets in rows by bucket; bucket -1 - x lists sets that this task saw to be under a hot signature."""

    def packed(ids: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        sig, who = signatures(sets, g)
        ref = np.array(ids, dtype=np.int64)[who] - ids[0]
        bucket = (sig >> np.uint64(40)) % np.uint64(buckets)
        order = np.lexsort((sig & np.uint64((1 << 40) - 1), bucket))
        sig, ref, bucket = sig[order], ref[order], bucket[order].astype(np.int64)
        starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        turn = np.arange(len(sig)) - np.repeat(starts, np.diff(np.r_[starts, len(sig)]))
        marked = np.unique(ref[turn > bucket_size])  # enough of the signature's members go on for the bucket to see it is hot
        keep = turn <= bucket_size
        sig, ref, bucket = sig[keep], ref[keep], bucket[keep]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        rows = [(int(bucket[a]), ids[0], _planes(sig[a:b], 5), _planes(ref[a:b], 3)) for a, b in zip(cuts, np.r_[cuts[1:], len(sig)], strict=True)]
        if len(marked):
            rows.append((-1 - int(sig[0] % np.uint64(buckets)), ids[0], b"", _planes(marked, 3)))
        yield pa.RecordBatch.from_pylist([dict(zip(_PACKED.names, r, strict=True)) for r in rows], schema=_PACKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        sets: list[np.ndarray] = []
        held = 0
        for batch in batches:
            column = batch.column("features")
            ends, values = column.offsets.to_numpy(), column.values.to_numpy()
            for i, sid in enumerate(batch.column("id").to_pylist()):
                if ids and (held > CHUNK or not 0 <= sid - ids[0] < 1 << 24):
                    yield from packed(ids, sets)
                    ids, sets, held = [], [], 0
                ids.append(sid)
                sets.append(values[ends[i] : ends[i + 1]])
                held += len(sets[-1])
        if ids:
            yield from packed(ids, sets)

    return run


def _met(sig: np.ndarray, ids: np.ndarray, bucket_size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Pairs (a < b) of sets under one signature with what it counts, and the members of signatures that have too many."""
    order = np.argsort(sig, kind="stable")
    sig, ids = sig[order], ids[order]
    starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
    sizes = np.diff(np.r_[starts, len(sig)])
    worth = WHOLE // (sig & np.uint64(15)).astype(np.int64)
    parts = [(np.zeros(0, np.int64),) * 3]
    for size in np.unique(sizes[(sizes > 1) & (sizes <= bucket_size)]).tolist():
        at = starts[sizes == size]
        group = ids[at[:, None] + np.arange(size)]
        x, y = np.triu_indices(size, 1)
        a, b = group[:, x].reshape(-1), group[:, y].reshape(-1)
        parts.append((np.minimum(a, b), np.maximum(a, b), np.repeat(worth[at], len(x))))
    return [np.concatenate(c) for c in zip(*parts, strict=True)], ids[np.repeat(sizes > bucket_size, sizes)]


def _summed(a: np.ndarray, b: np.ndarray, worth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each pair once, with what its signatures count."""
    if not len(a):
        return a, b, worth
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    return a[starts], b[starts], np.minimum(WHOLE, np.add.reduceat(worth[order], starts))


def _meet(bucket_size: int):
    def told(a, b=None, worth=None) -> pa.RecordBatch:
        others = [pa.nulls(len(a), t) if x is None else pa.array(x, t) for x, t in ((b, pa.int64()), (worth, pa.int32()))]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), *others], schema=_MET)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sigs, ids, held, size = None, [], [], [], 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            if sigs:
                pairs, hot = _met(np.concatenate(sigs), np.concatenate(ids), bucket_size)
                held.append(_summed(*pairs))
                size += len(held[-1][0])
                if len(hot):
                    yield told(np.unique(hot))
            if size > MEET:
                yield told(*_summed(*(np.concatenate(c) for c in zip(*held, strict=True))))
                held, size = [], 0

        for batch in batches:
            for bucket, base, sig, ref in zip(*(batch.column(c).to_pylist() for c in _PACKED.names), strict=True):
                if bucket < 0:
                    yield told(base + _unplanes(ref, 3).astype(np.int64))
                    continue
                if bucket != now:
                    yield from close()
                    now, sigs, ids = bucket, [], []
                sigs.append(_unplanes(sig, 5))
                ids.append(base + _unplanes(ref, 3).astype(np.int64))
        yield from close()
        if size:
            yield told(*_summed(*(np.concatenate(c) for c in zip(*held, strict=True))))

    return run


def _candidates(sets: Sets) -> tuple[DataFrame, DataFrame]:
    """(a, b) sets that agree in as many parts as they must; (id) sets that are under a hot signature."""
    spark = sets.spark
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(tasks, -(-2 * sets.size() // MEET))  # hash buckets of about so many signatures, however large the corpus
    packed = sets.features().select("id", "features").mapInArrow(_pack(buckets, BUCKET, sets.g), _PACKED_DDL)
    placed = packed.repartition("bucket").sortWithinPartitions("bucket")
    met = cut(placed.mapInArrow(_meet(BUCKET), "a bigint, b bigint, worth int"))
    pairs = met.filter("b is not null").groupBy("a", "b").agg(F.sum("worth").alias("worth")).filter(F.col("worth") >= WHOLE).select("a", "b")
    return pairs, met.filter("b is null").select(F.col("a").alias("id")).distinct()


# ---------------------------------------------------------------- sets under hot signatures
def _by_rarest(hot: DataFrame, sets: Sets) -> DataFrame:
    """(a, b) among the hot sets: they meet at the rarest feature they share.

    A row says at which of a set's features, rarest first, it may meet others: one of the first n - ceil(g n) + 1, or if
    more than WIDE sets stand there, that one and the next shared. A pair is told where it first meets; what both have
    behind that place must suffice for their similarity.
    """
    g = sets.g
    each = sets.features().join(small(hot), "id", "left_semi").select("id", "n", F.explode("features").alias("f"))
    common = cut(each.groupBy("f").agg(F.count("*").alias("seen")).filter(F.col("seen") > 1))  # the others are shared by nobody
    least = F.ceil(F.col("n") * g - 1e-9).cast("int")
    ordered = (
        each.join(small(common), "f").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("seen", "f"))).alias("x"))
        .filter(F.size("x") >= least)
        .select("id", "n", least.alias("need"), F.transform("x", lambda e: e["f"]).alias("fs"))
    )
    ordered = cut(ordered)
    last = lambda shared: F.least(F.size("fs"), F.size("fs") - F.col("need") + shared) - 1
    place = lambda at: (F.slice("fs", 1, F.least(F.lit(REMEMBERED), at)).alias("before"), (F.size("fs") - at - 1).alias("after"))
    rows = ordered.withColumn("at", F.explode(F.sequence(F.lit(0), last(1))))
    rows = cut(rows.select("id", "n", "at", F.get("fs", F.col("at")).alias("key"), *place(F.col("at"))))
    wide = cut(rows.groupBy("key").agg(F.count("*").alias("c")).filter(F.col("c") > WIDE).select("key"))
    spread_out = rows.join(small(wide), "key", "left_semi").select("id", F.col("at").alias("one"), "key").join(ordered, "id")
    second = spread_out.filter(F.col("one") < last(2)).withColumn("at", F.explode(F.sequence(F.col("one") + 1, last(2))))
    second = second.select("id", "n", "at", F.xxhash64("key", F.get("fs", F.col("at"))).alias("key"), *place(F.col("at")))

    def meeting(at: DataFrame, shared: int) -> DataFrame:
        x, y = at.alias("x"), at.alias("y")
        enough = F.least("x.after", "y.after") + shared >= (F.col("x.n") + F.col("y.n")) * (g / (1 + g)) - 1e-9
        fits = F.least("x.n", "y.n") >= F.greatest("x.n", "y.n") * g - 1e-9
        first = F.size(F.array_intersect("x.before", "y.before")) < shared
        both = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.id") < F.col("y.id")) & fits & enough & first)
        return both.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))

    return meeting(rows.join(small(wide), "key", "left_anti"), 1).union(meeting(second, 2)).distinct()


def similar_sets(sets: Sets) -> DataFrame:
    """a < b, similarity of every two distinct feature sets of Jaccard similarity g or more, by their ids."""
    pairs, hot = _candidates(sets)
    if not hot.isEmpty():
        pairs = pairs.union(_by_rarest(cut(hot), sets)).distinct()
    pairs = cut(pairs)
    asked = cut(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    feats = sets.features().join(small(asked), "id", "left_semi")
    both = (
        pairs.join(feats.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("features").alias("fa")), "a")
        .join(feats.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("features").alias("fb")), "b")
        .withColumn("common", F.size(F.array_intersect("fa", "fb")))
    )
    similarity = F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))
    return both.select("a", "b", similarity.alias("similarity")).filter(F.col("similarity") >= sets.g - 1e-12)


def near_duplicates(records: DataFrame, g: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(membership, pairs between set ids)."""
    sets = Sets(records, g)
    return cut(sets.membership()), cut(similar_sets(sets))


def near_duplicate_pairs(records: DataFrame, g: float = THRESHOLD) -> DataFrame:
    """sample_id_a < sample_id_b of every two records whose pair sets are similar; the expansion of near_duplicates."""
    members, pairs = near_duplicates(records, g)
    named = members.filter("id is not null")
    loops = named.groupBy("id").agg(F.count("*").alias("c")).filter("c > 1").select(F.col("id").alias("a"), F.col("id").alias("b"))
    links = pairs.select("a", "b").union(loops)
    x = named.select(F.col("id").alias("a"), F.col("sample_id").alias("sa"))
    y = named.select(F.col("id").alias("b"), F.col("sample_id").alias("sb"))
    out = links.join(x, "a").join(y, "b").filter("a <> b or sa < sb")
    return out.select(F.least("sa", "sb").alias("sample_id_a"), F.greatest("sa", "sb").alias("sample_id_b"))


def near_duplicate_groups(records: DataFrame, g: float = THRESHOLD) -> DataFrame:
    """sample_id, group_id, links: one row per distinct record.

    group_id is the smallest sample_id of the group, links the similar other sets of the record's own. What a group was
    made from is a table of its own, see group_sources.
    """
    members, pairs = near_duplicates(records, g)
    parts = components(pairs.select("a", "b"))
    links = pairs.select("a").union(pairs.select("b")).groupBy("a").agg(F.count("*").alias("links")).withColumnRenamed("a", "id")
    of = members.join(parts.withColumnRenamed("node", "id"), "id", "left").join(links, "id", "left")
    # a set without partner is its own class, a record without features is alone
    key = F.coalesce(F.col("component").cast("string"), F.col("id").cast("string"), F.col("sample_id"))
    of = cut(of.select("sample_id", key.alias("class"), F.coalesce("links", F.lit(0)).alias("links")))
    heads = of.groupBy("class").agg(F.min("sample_id").alias("group_id"))
    return of.join(heads, "class").select("sample_id", "group_id", "links")


def group_sources(records: DataFrame, groups: DataFrame) -> DataFrame:
    """group_id, source_row_index, source_url: one row for each distinct source of a group, the other column null.

    Rows rather than arrays, as a group may hold a third of all records; sources without records give none.
    """
    loads = records.select("sample_id", "source_row_indices", "source_urls").join(groups.select("sample_id", "group_id"), "sample_id")
    source = lambda index, url: F.struct(index.alias("source_row_index"), url.alias("source_url"))
    nothing = lambda c, kind: F.coalesce(F.col(c), F.array().cast(kind))
    rows = F.transform(nothing("source_row_indices", "array<bigint>"), lambda x: source(x, F.lit(None).cast("string")))
    urls = F.transform(nothing("source_urls", "array<string>"), lambda x: source(F.lit(None).cast("bigint"), x))
    each = loads.select("group_id", F.explode(F.concat(rows, urls)).alias("s")).select("group_id", "s.*")
    return each.filter("source_row_index is not null or source_url is not null").distinct()
