"""Size-aware heavy-light self-join of documents on the Jaccard similarity of word shingles.

A document's set holds its distinct 5-word shingles (fewer words: the whole sequence as one). Two
sets link when their Jaccard similarity reaches ``SIMILAR``.

*Order.* All shingles are ordered by rarity: first by how many sets hold them, then by hash. A few
*common* shingles (held by more than about one set in a thousand, so at most a thousand times the
mean set size of them) come last. Linked sets of size n share a shingle among the first p = n -
ceil(0.8 n) + 1 of each, and a pair of shingles among the first p + 1.

*Light.* Small sets enumerate the 2-subsets of their first p + 1 shingles; two small sets are
candidates when they share one. *Heavy.* Large sets scan the inverted lists of their first p
shingles, which hold all sets. The size that divides them is the one with the least cost: subsets
written by the small, lists read by the large (``choose_boundary``). Private shingles, which
only one set holds, are never written.

*Components.* ``ngram_join`` asks only for what the links connect, so pairs inside a group of copies
are not enumerated: equal sets are one class; each list first links its members to its head, the member
for which fewest rarer shingles come first; only members that are still in different components are
then paired. A link that is skipped joins two documents that are connected already.

*Links.* ``links`` and ``link_counts`` skip none: all candidate pairs of different sets are verified.

*Pairing.* Wherever members of a list are paired, size and place in the order bound who meets whom
(``_paired``), before the pairs are verified on the sets. Rows of one template that are not similar
enough share a list, but are out of each other's reach there and never meet.

*Work.* Shingles are hashed to 64 bits in numpy. Counting them moves 6 bytes a shingle: the first
bits of the hash name the bucket whose task counts it, the next 48 are sent. A false match needs two
shingles to agree in all of these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.components import components
from tallymart.llm.frames import Shelf, pick, small_batches, text_key
from tallymart.llm.vocab import release
from tallymart.llm.words import WHITE, byte_class, mix, word_blocks

SIZE = 5
SIMILAR = 80  # in hundredths
WORDS = byte_class(WHITE, lower=True)
CHUNK = 1_000_000  # shingles sent at once
BUCKET = 600_000  # shingles counted at once
SMALL_LIMIT = 128  # sizes up to which enumerating subsets is considered
CLASSES = 10  # size classes of lists for each factor e
FEW = 8  # a shingle of fewer sets is never common


def needed(n):
    """The least overlap of a set of size n with any set it links to."""
    return -(-n * SIMILAR // 100)


def shingle_sets(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, set sizes, distinct shingles set by set, ascending)."""
    for first, end, words in word_blocks(texts, WORDS):
        hashes, count = words.hashes, np.diff(words.offsets)
        text = np.repeat(np.arange(end - first), count)
        found, owner = [], []
        for size in range(1, SIZE + 1):
            if size < SIZE:
                starts = words.offsets[:-1][count == size]
            else:
                starts = np.flatnonzero(text[: max(len(text) - SIZE + 1, 0)] == text[SIZE - 1 :])
            key = np.full(len(starts), size, np.uint64)
            for i in range(size):
                key = key * np.uint64(0xD6E8FEB86659FD93) + hashes[starts + i]
            found.append(mix(key))
            owner.append(text[starts])
        found, owner = np.concatenate(found), np.concatenate(owner)
        order = np.lexsort((found, owner))
        found, owner = found[order], owner[order]
        new = np.ones(len(found), bool)
        new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
        yield first, end, np.bincount(owner[new], minlength=end - first), found[new]


def set_ids(sizes: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """The same number for equal sets."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingles ^ np.uint64(0x5BD1E995)))])
    ends = np.cumsum(sizes)
    return mix(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64)).view(np.int64)


def _chunks(texts: pa.Array):
    """(first row, sizes, shingles) of about CHUNK shingles."""
    start, sizes, shingles, held = 0, [], [], 0
    for _, end, size, found in shingle_sets(texts):
        sizes.append(size)
        shingles.append(found)
        held += len(found)
        if held >= CHUNK or end == len(texts):
            yield start, np.concatenate(sizes), np.concatenate(shingles)
            start, sizes, shingles, held = end, [], [], 0


PROFILE = ["kind", "doc_id", "n", "sid", "k1", "k2"]


def _profiles(docs: DataFrame) -> DataFrame:
    """Kind 0: doc_id, set size, set id and text key of each row. Kind 1: shingle and its count where a chunk
    has it often."""

    def profile(batches):
        release()  # the process may hold what an earlier stage needed
        for batch in batches:
            for first, sizes, shingles in _chunks(batch.column(1)):
                rows = len(sizes)
                ids = pa.array(set_ids(sizes, shingles))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.zeros(rows, np.int32)),
                        batch.column(0).slice(first, rows),
                        pa.array(sizes.astype(np.int64)),
                        ids,
                        batch.column(2).slice(first, rows),
                        batch.column(3).slice(first, rows),
                    ],
                    PROFILE,
                )
                ordered = np.sort(shingles)
                edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
                count = np.diff(edges)
                often = count >= max(FEW // 2, rows // 500)
                if often.any():
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.ones(int(often.sum()), np.int32)),
                            pa.nulls(int(often.sum()), pa.int64()),
                            pa.array(count[often].astype(np.int64)),
                            pa.array(ordered[edges[:-1]][often].view(np.int64)),
                            pa.nulls(int(often.sum()), pa.int64()),
                            pa.nulls(int(often.sum()), pa.int64()),
                        ],
                        PROFILE,
                    )

    rows = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), "text", *text_key(F.col("text"))
    )
    return rows.mapInArrow(profile, ", ".join(f"{x} {'int' if x == 'kind' else 'long'}" for x in PROFILE))


SENT = "bucket int, chunk long, rest int, head binary, low binary, high binary, more binary"
SENT_TYPES = (pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4)


def _sent_table(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * len(SENT_TYPES)
    return pa.table(
        [pa.array(c, t) for c, t in zip(columns, SENT_TYPES, strict=True)],
        names=[part.split()[0] for part in SENT.split(", ")],
    )


def _split_keys(keys: np.ndarray) -> tuple[bytes, bytes]:
    """The lower 48 bits, as 32 and 16: what is sent of a shingle."""
    low = (keys & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()
    return low, ((keys >> np.uint64(32)) & np.uint64(0xFFFF)).astype("<u2").tobytes()


def _join_keys(low: bytes, high: bytes) -> np.ndarray:
    return np.frombuffer(low, "<u4").astype(np.int64) | (
        np.frombuffer(high, "<u2").astype(np.int64) << 32
    )


def _send(docs: DataFrame, common: np.ndarray, bits: int) -> DataFrame:
    """Each chunk's shingles by bucket (number of them per set, 48 bits of each), and a row of a
    negative bucket with its sets: ids, sizes, and common shingles in order.

    ``common`` is in order; equal sets of a chunk are sent once.
    """
    known = np.sort(common)
    rank = np.argsort(common, kind="stable")  # place in the order of each of ``known``

    def send(batches):
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for _, sizes, shingles in _chunks(batch.column(0)):
                chunk += 1
                ids = set_ids(sizes, shingles)
                once = np.zeros(len(sizes), bool)
                once[np.unique(ids, return_index=True)[1]] = True
                once &= sizes > 0
                wanted = np.repeat(once, sizes)
                ids, sizes, shingles = ids[once], sizes[once], shingles[wanted]
                owner = np.repeat(np.arange(len(sizes)), sizes)
                if len(known):
                    at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
                    often = known[at] == shingles
                    last = np.lexsort((rank[at[often]], owner[often]))
                    common_keys = key_of(shingles[often][last], bits)
                    common_count = np.bincount(owner[often], minlength=len(sizes))
                    shingles, owner = shingles[~often], owner[~often]
                else:
                    common_keys = np.empty(0, np.int64)
                    common_count = np.zeros(len(sizes), np.int64)
                facts = np.concatenate([ids, sizes, common_count]).astype("<i8").tobytes()
                keys = common_keys.astype("<i8").tobytes()
                aside = -1 - chunk % (1 << bits)
                rows = [(aside, chunk, len(sizes), facts, keys, b"", b"")]
                bucket = (shingles >> np.uint64(64 - bits)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")  # by bucket, then by set
                bucket, shingles, owner = bucket[order], shingles[order], owner[order]
                edges = np.searchsorted(bucket, np.arange((1 << bits) + 1))
                for b in np.flatnonzero(np.diff(edges)):
                    mine = slice(edges[b], edges[b + 1])
                    held = np.bincount(owner[mine], minlength=len(sizes))
                    wide = held.max() >= 1 << 16
                    rows.append(
                        (
                            int(b),
                            chunk,
                            int(wide),
                            held.astype("<u4" if wide else "<u2").tobytes(),
                            *_split_keys(shingles[mine]),
                            b"",
                        )
                    )
                for i in range(0, len(rows), 64):
                    yield from _sent_table(rows[i : i + 64]).to_batches()

    return pick(docs, "text").mapInArrow(send, SENT)


def key_of(shingles: np.ndarray, bits: int) -> np.ndarray:
    """Bucket and the 48 bits sent, as one number."""
    high = (shingles >> np.uint64(64 - bits)) << np.uint64(48)
    return (high | (shingles & np.uint64((1 << 48) - 1))).view(np.int64)


def _count(table: pa.Table) -> pa.Table:
    """Of one bucket: for each chunk the shingles that another set holds too (``head``: their sets,
    ``more``: by how many sets each is held). Rows of negative buckets pass as they are."""
    if table.column("bucket")[0].as_py() < 0:
        return table
    keys, owners = [], []
    for wide, head, low, high in zip(
        *(table.column(c).to_pylist() for c in ("rest", "head", "low", "high")), strict=True
    ):
        held = np.frombuffer(head, "<u4" if wide else "<u2").astype(np.int64)
        owners.append(np.repeat(np.arange(len(held), dtype=np.int32), held))
        keys.append(_join_keys(low, high))
    sizes = [len(x) for x in keys]
    every = np.concatenate(keys)
    order = np.argsort(every)
    ordered = every[order]
    edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
    repeats = np.diff(edges)
    count = np.empty(len(every), np.int64)
    count[order] = np.repeat(repeats, repeats)
    bucket = table.column("bucket")[0].as_py()
    out, at = [], 0
    for chunk, size, owner in zip(table.column("chunk").to_pylist(), sizes, owners, strict=True):
        mine = slice(at, at + size)
        shared = count[mine] > 1
        at += size
        if shared.any():
            held = owner[shared]
            wide = held[-1] >= 1 << 16  # owners ascend
            counts = np.minimum(count[mine][shared], (1 << 32) - 1).astype("<u4")
            owners_ = held.astype("<u4" if wide else "<u2").tobytes()
            keys_ = _split_keys(every[mine][shared].view(np.uint64))
            out.append((bucket, chunk, int(wide), owners_, *keys_, counts.tobytes()))
    return _sent_table(out)


SETS = "sid long, n int, private int, prefix array<long>, scan long, shared array<long>"


def _prefixes(chunk: pa.Table) -> pa.Table:
    """Of one chunk: each set that shares a shingle of its prefix.

    ``private`` shingles come before ``prefix``, which goes up to place p (from 0); ``shared`` are
    all shingles that another set holds; ``scan`` is the price of
    reading the inverted lists of the first p.
    """
    head = chunk.filter(pc.less(chunk.column("bucket"), 0))
    n_sets = head.column("rest")[0].as_py()
    facts = np.frombuffer(head.column("head")[0].as_py(), "<i8").reshape(3, n_sets)
    ids, sizes, common_count = facts
    common = np.frombuffer(head.column("low")[0].as_py(), "<i8")
    rest = chunk.filter(pc.greater_equal(chunk.column("bucket"), 0))
    parts: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in range(3)]
    for bucket, wide, owners, low, high, counts in zip(
        *(rest.column(c).to_pylist() for c in ("bucket", "rest", "head", "low", "high", "more")),
        strict=True,
    ):
        parts[0].append(np.frombuffer(owners, "<u4" if wide else "<u2"))
        parts[1].append(_join_keys(low, high) | (np.int64(bucket) << 48))
        parts[2].append(np.frombuffer(counts, "<u4"))
    owner, key, count = (np.concatenate(p).astype(np.int64) for p in parts)
    # Common shingles come last, in the order sent; their counts are not needed but for the cost.
    owner = np.concatenate([owner, np.repeat(np.arange(n_sets), common_count)])
    place = np.concatenate([count, (1 << 33) + np.arange(len(common))])
    key = np.concatenate([key, common])
    tie = np.concatenate([key[: len(count)], np.zeros(len(common), np.int64)])
    order = np.lexsort((tie, place, owner))
    owner, key, place = owner[order], key[order], place[order]
    held = np.bincount(owner, minlength=n_sets)
    private = sizes - held
    p = sizes - needed(sizes) + 1
    ends = np.cumsum(held)
    starts = ends - held
    first = np.maximum(np.minimum(p + 1 - private, held), 0)
    some = np.flatnonzero(np.minimum(p - private, held) > 0)
    # A member meets its list's head, and later the members that are still apart: its price grows
    # with the list, but far slower than the list.
    price = 1 + np.log2(np.maximum(np.minimum(place, 1 << 33), 1)).astype(np.int64)
    cost = np.concatenate([[0], np.cumsum(price)])
    upto = starts + np.minimum(np.maximum(p - private, 0), held)

    def lists(sizes_: np.ndarray) -> pa.Array:
        bounds = np.concatenate([[0], np.cumsum(sizes_)]).astype(np.int32)
        at = np.repeat(starts[some] - bounds[:-1], sizes_) + np.arange(bounds[-1])
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(key[at]))

    return pa.table(
        [
            pa.array(ids[some]),
            pa.array(sizes[some].astype(np.int32)),
            pa.array(private[some].astype(np.int32)),
            lists(first[some]),
            pa.array(cost[upto[some]] - cost[starts[some]]),
            lists(held[some]),
        ],
        names=["sid", "n", "private", "prefix", "scan", "shared"],
    )


def choose_boundary(costs: list[tuple[int, int, int]]) -> int:
    """Sizes up to the result are small. ``costs``: (size, subsets to write, price of the lists to
    read) of all sets of that size; the last size stands for all from there on."""
    best, least = 0, sum(scan for _, _, scan in costs)
    total = least
    for size, subsets, scan in sorted(costs):
        total += subsets - scan
        if size < SMALL_LIMIT and total < least:
            best, least = size, total
    return best


def _lists(sets: DataFrame, boundary: int) -> DataFrame:
    """Members of the lists: key, whether any two members are candidates (a list of small sets), sid,
    n, at (place of the shingle, or of the second of two, in the set's order) and large."""
    p = F.col("n") - F.ceil(F.col("n") * SIMILAR / 100).cast("int") + 1
    facts = ["sid", "n", (F.col("n") > boundary).alias("large")]
    single = sets.select(
        *facts,
        F.col("private"),
        p.alias("p"),
        F.posexplode("prefix").alias("i", "key"),
    )
    single = single.withColumn("at", F.col("private") + F.col("i")).where("at < p")
    single = single.select("key", F.lit(False).alias("light"), "sid", "n", "at", "large")
    if not boundary:
        return single
    small = sets.where((F.col("n") <= boundary) & (F.size("prefix") > 1))
    pairs = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.size("prefix") - 1),
            lambda i: F.transform(
                F.slice("prefix", i + 1, F.size("prefix")),
                lambda other, k: F.struct(
                    F.xxhash64(F.element_at("prefix", i), other).alias("key"),
                    (F.col("private") + i + k).cast("int").alias("at"),
                ),
            ),
        )
    )
    double = small.select(*facts, F.col("private"), F.explode(pairs).alias("pair"))
    return single.unionAll(
        double.select("pair.key", F.lit(True).alias("light"), "sid", "n", "pair.at", "large")
    )


def _may_link() -> Column:
    """Bounds on size and overlap for members "a" and "b" of one list."""

    def c(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    n, m = c("a", "n"), c("b", "n")
    sizes = F.least(n, m) * 100 >= F.greatest(n, m) * SIMILAR
    overlap = 1 + F.least(n - c("a", "at") - 1, m - c("b", "at") - 1)
    # overlap / (n + m - overlap) >= similar / 100
    enough = overlap * (100 + SIMILAR) >= (n + m) * SIMILAR
    return sizes & (F.col("light") | (enough & (c("a", "large") | c("b", "large"))))


def _paired(members: DataFrame, also: Column | None = None) -> DataFrame:
    """The pairs (u, v) of members "a" and "b" of a list that may link and meet ``also``.

    A list is the first that a pair of linked sets shares if the shingles before it are not shared,
    so the overlap there is at most what comes from its shingles on, and that bounds the size of the
    other set (``reach``). The larger member looks for the smaller, which is only there if its reach
    goes beyond its own size; both go by classes of size, so members out of each other's reach do not
    meet. Every linked pair is found in the first list it shares.
    """
    seen = F.when(F.col("light"), 2).otherwise(1)
    most = seen + F.col("n") - F.col("at") - 1
    members = members.withColumn("reach", F.floor(most * (100 + SIMILAR) / SIMILAR).cast("long") - F.col("n"))
    least = F.ceil(F.col("n") * SIMILAR / 100)
    furthest = F.least("n", "reach")
    size_class = lambda n: F.floor(F.log(n.cast("double")) * CLASSES + 1e-6).cast("int")
    # The larger of two is large if either is.
    looking = members.where((furthest >= least) & (F.col("light") | F.col("large"))).withColumn(
        "class", F.explode(F.sequence(size_class(least), size_class(furthest)))
    )
    found = members.where("reach >= n").withColumn("class", size_class(F.col("n")))
    larger = (F.col("a.n") > F.col("b.n")) | ((F.col("a.n") == F.col("b.n")) & (F.col("a.sid") > F.col("b.sid")))
    near = (F.col("b.n") <= F.col("a.reach")) & (F.col("a.n") <= F.col("b.reach"))
    pairs = looking.alias("a").join(found.alias("b"), ["key", "light", "class"])
    return (
        pairs.where(larger & near & _may_link() & (F.lit(True) if also is None else also))
        .select(F.greatest("a.sid", "b.sid").alias("u"), F.least("a.sid", "b.sid").alias("v"))
        .distinct()
    )


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) that link, with the sizes n_u and n_v and the overlap ``both``."""
    own = sets.select("sid", "n", "shared")
    u = own.toDF("u", "n_u", "shared_u")
    v = own.toDF("v", "n_v", "shared_v")
    both = F.size(F.array_intersect("shared_u", "shared_v"))
    return (
        pairs.join(u, "u")
        .join(v, "v")
        .withColumn("both", both)
        .where(F.col("both") * (100 + SIMILAR) >= (F.col("n_u") + F.col("n_v")) * SIMILAR)
        .select("u", "v", "n_u", "n_v", "both")
    )


def _indexed(docs: DataFrame, shelf: Shelf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, n, sid and text key of each row; sets that share a shingle of their prefix; lists)."""
    with small_batches(docs.sparkSession):
        profiles = shelf.put(_profiles(docs), "profiles")
    rows = profiles.where("kind = 0").drop("kind")
    n_rows, n_shingles = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    often = (
        profiles.where("kind = 1")
        .groupBy("sid")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= max(FEW, n_rows // 1000))
        .collect()  # at most n_shingles / (n_rows / 1000): a thousand times the mean set size
    )
    hashes = np.array([r.sid for r in often], np.int64).view(np.uint64)
    counts = np.array([r.n for r in often], np.int64)
    common = hashes[np.lexsort((hashes, counts))]
    bits = max(4, int(np.ceil(np.log2(max(1, n_shingles / BUCKET)))))
    counted = _send(docs, common, bits).groupBy("bucket").applyInArrow(_count, SENT)
    sets = counted.groupBy("chunk").applyInArrow(_prefixes, SETS)
    with small_batches(docs.sparkSession):
        sets = shelf.put(sets.dropDuplicates(["sid"]), "sets")
    m = F.size("prefix").cast("long")
    costs = (
        sets.groupBy(F.least("n", F.lit(SMALL_LIMIT)).alias("size"))
        .agg(F.sum(m * (m - 1) / 2).cast("long").alias("subsets"), F.sum("scan").alias("scan"))
        .collect()  # a row for each size up to SMALL_LIMIT
    )
    boundary = choose_boundary([(r["size"], r.subsets, r.scan) for r in costs])
    return rows, sets, _lists(sets, boundary)


def linked_sets(docs: DataFrame, shelf: Shelf) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, sid and text key of each row; sid and the component's root of linked sets)."""
    rows, sets, lists = _indexed(docs, shelf)
    heads = (
        lists.groupBy("key", "light")
        .agg(F.count("*").alias("members"), F.min(F.struct("at", "n", "sid", "large")).alias("head"))
        .where("members > 1")
        .select("key", "light", "head.*")
    )
    to_head = (
        lists.alias("a")
        .join(heads.alias("b"), ["key", "light"])
        .where(F.col("a.sid") != F.col("b.sid"))
        .where(_may_link())
        .select(F.greatest("a.sid", "b.sid").alias("u"), F.least("a.sid", "b.sid").alias("v"))
        .distinct()
    )
    first = components(_verified(to_head, sets).select("u", "v"), shelf, "first")
    placed = (
        lists.join(first, F.col("sid") == F.col("node"), "left")
        .withColumn("part", F.coalesce("root", "sid"))
        .drop("node", "root")
    )
    placed = shelf.put(placed, "placed", slim=True)
    mixed = (
        placed.groupBy("key", "light")
        .agg(F.min("part").alias("low"), F.max("part").alias("high"))
        .where("low <> high")
        .select("key", "light")
    )
    left = placed.join(mixed, ["key", "light"])
    across = _paired(left, F.col("a.part") != F.col("b.part"))
    more = _verified(across, sets)
    part = first.select(F.col("node").alias("x"), F.col("root").alias("y"))
    lifted = (
        more.join(part, F.col("u") == F.col("x"), "left")
        .select(F.coalesce("y", "u").alias("u"), "v")
        .join(part, F.col("v") == F.col("x"), "left")
        .select("u", F.coalesce("y", "v").alias("v"))
    )
    second = components(lifted, shelf, "second").toDF("x", "y")
    # Roots of the first round may hang under a root of the second.
    lower = first.join(second, F.col("root") == F.col("x"), "left").select(
        "node", F.coalesce("y", "root").alias("root")
    )
    roots = second.toDF("node", "root").join(first.select("node"), "node", "left_anti")
    return rows, shelf.put(lower.unionAll(roots), "roots", slim=True)


def ngram_join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links), set_id, group_id (the same
    number in a component; null for empty sets) and the text's key k1, k2 of each row.

    Null, empty and wordless texts have size 0 and are their own component. Repeated rows have equal
    sets and so one component; rows of one doc_id with different texts are documents of their own
    that bear the same name. Rows with a null doc_id link like others, but do not name a component
    unless no row of it has an id. An empty table gives no rows.
    """
    shelf = Shelf(docs.sparkSession, "ngram_join")
    rows, roots = linked_sets(docs, shelf)
    classes = rows.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("least"))
    part = classes.join(roots, F.col("sid") == F.col("node"), "left").select(
        "sid", "least", F.coalesce("root", "sid").alias("part")
    )
    names = part.groupBy("part").agg(F.min("least").alias("component"))
    named = part.join(names, "part").select(F.col("sid").alias("own"), "part", "component")
    return rows.join(named, (F.col("sid") == F.col("own")) & (F.col("n") > 0), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        F.col("sid").alias("set_id"),
        F.col("part").alias("group_id"),
        "k1",
        "k2",
    )


def _all_links(docs: DataFrame, shelf: Shelf) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, sid of each row; all linked pairs of different sets)."""
    rows, sets, lists = _indexed(docs, shelf)
    return rows, _verified(_paired(lists), sets)


def links(docs: DataFrame) -> DataFrame:
    """All links between different sets: set_u, set_v (set_u > set_v), doc_u and doc_v (the least
    doc_id of each set), n_u, n_v and n_both (the sizes and the overlap).

    Equal sets are one class, which links to another class once; every candidate pair of classes is
    verified, none is skipped because its sets are connected already. The count of the rows is the
    number of links.
    """
    rows, found = _all_links(docs, Shelf(docs.sparkSession, "ngram_links"))
    classes = rows.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("least"))
    return (
        found.join(classes.toDF("u", "doc_u"), "u")
        .join(classes.toDF("v", "doc_v"), "v")
        .select(
            F.col("u").alias("set_u"),
            F.col("v").alias("set_v"),
            "doc_u",
            "doc_v",
            F.col("n_u").cast("long").alias("n_u"),
            F.col("n_v").cast("long").alias("n_v"),
            F.col("both").cast("long").alias("n_both"),
        )
    )


def link_counts(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_id and n_links (links of the row's set to other sets) of each row."""
    shelf = Shelf(docs.sparkSession, "ngram_link_counts")
    rows, found = _all_links(docs, shelf)
    found = shelf.put(found.select("u", "v"), "links", slim=True)
    ends = found.select(F.col("u").alias("own")).unionAll(found.select("v"))
    counts = ends.groupBy("own").agg(F.count("*").alias("n_links"))
    return rows.join(counts, (F.col("sid") == F.col("own")) & (F.col("n") > 0), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("sid").alias("set_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS t
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k
  FROM s a JOIN s b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT u, v FROM both_ JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v
  WHERE 100 * k >= 80 * (x.n + y.n - k)
), reach AS (
  SELECT doc_id AS u, doc_id AS v FROM d
  UNION
  SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least_.component_id
FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u) least_ USING (doc_id)
"""
