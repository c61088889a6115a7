"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

*Classes.* Vectors of one label with the same entries are one class; everything below works on classes,
so a group of copies costs one row.

*Tiles.* A label's classes are dealt into tiles of about TILE_BYTES. Labels of more than one tile are
first divided by the nearest of a few pivots (a bounded sample of vectors), so that tiles are narrow: two
tiles whose centres are further apart than their radii and the threshold's angle cannot hold a link and
never meet. Each pair of tiles that may is one group of a shuffle, so a hot label is many tasks.

*Products.* Of a unit vector u, q = round(u / s) in int8 gives u = s q + e with |e| known exactly, so
u.v = s_u s_v (q_u . q_v) up to |e_u| |s_v q_v| + |e_v| |s_u q_u| + |e_u| |e_v|. The integer products of a
tile decide all pairs whose bound lies on one side of the threshold; the others are computed again in
double precision.

*Output.* A pair of tiles yields a row for each class that has a link there: the number of vectors
linked, and the root of its part of the graph, never the links one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.components import components
from tallymart.llm.frames import Shelf, pick, small_batches

SIMILAR = 0.98
TILE_BYTES = 1 << 22
BLOCK = 1024  # rows of a tile multiplied at once
PIVOTS = 64
# Float32 holds the integer products exactly up to this many entries.
EXACT_ENTRIES = (1 << 24) // 127**2
SLACK = 1e-6  # over the rounding of float32 scaling


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so that no square over- or underflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


class Quantised:
    """Int8 rows of unit vectors, with their scale, length and the exact length of the error."""

    def __init__(self, units: np.ndarray):
        scale = np.abs(units).max(axis=1, keepdims=True) / 127
        self.rows = np.rint(units / scale).astype(np.int8)
        restored = self.rows * scale
        self.scale = scale[:, 0]
        self.length = np.linalg.norm(restored, axis=1)
        self.error = np.linalg.norm(units - restored, axis=1)

    def bounds(self, mine: slice, other: Quantised, theirs: slice) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) bound of the product of each pair of two spans."""
        kind = np.float32 if self.rows.shape[1] <= EXACT_ENTRIES else np.float64
        near = self.rows[mine].astype(kind) @ other.rows[theirs].astype(kind).T
        near *= self.scale[mine, None].astype(kind)
        near *= other.scale[None, theirs].astype(kind)
        off = np.outer(self.error[mine], other.length[theirs] + other.error[theirs])
        off += np.outer(self.length[mine], other.error[theirs])
        off = off.astype(kind) + kind(SLACK)
        return near - off, near + off


def block_links(a: np.ndarray, b: np.ndarray, bounds: tuple[np.ndarray, np.ndarray], similar: float) -> np.ndarray:
    """Which pairs of unit rows reach ``similar``; only what the bounds leave open is computed again."""
    lower, upper = bounds
    linked = lower >= similar
    open_ = ~linked & (upper >= similar)
    rows, columns = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
    if 8 * np.count_nonzero(open_) > len(rows) * len(columns) > 0:
        exact = a[rows] @ b[columns].T >= similar
        inner = np.ix_(rows, columns)
        linked[inner] |= open_[inner] & exact
    else:
        i, j = np.nonzero(open_)
        for k in range(0, len(i), 1 << 16):
            part = slice(k, k + (1 << 16))
            near = np.einsum("ij,ij->i", a[i[part]], b[j[part]]) >= similar
            linked[i[part][near], j[part][near]] = True
    return linked


class Parts:
    """Connected parts of numbered nodes; the least number is a part's root."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def roots(self, nodes: range) -> np.ndarray:
        return np.array([self.find(x) for x in nodes], np.int64)

    def unite(self, linked: np.ndarray, rows: range, columns: range) -> None:
        """Each round joins every part to one it has a link to, so rounds are few."""
        while True:
            apart = linked & (self.roots(rows)[:, None] != self.roots(columns)[None, :])
            some = np.flatnonzero(apart.any(axis=1))
            if not len(some):
                return
            for i, j in zip(some.tolist(), apart[some].argmax(axis=1).tolist(), strict=True):
                x, y = self.find(rows[i]), self.find(columns[j])
                self.parent[max(x, y)] = min(x, y)


def tile_links(
    a: np.ndarray, copies_a: np.ndarray, b: np.ndarray | None, copies_b: np.ndarray | None, similar: float
) -> tuple[np.ndarray, np.ndarray]:
    """(vectors linked to each row, root of each row) of the rows of ``a`` and then of ``b``.

    Without ``b`` the pairs within ``a``, a row with itself left out.
    """
    own = b is None
    b_, copies_b_ = (a, copies_a) if own else (b, copies_b)
    qa = Quantised(a)
    qb = qa if own else Quantised(b_)
    total = len(a) if own else len(a) + len(b_)
    shift = 0 if own else len(a)
    counts, parts = np.zeros(total, np.int64), Parts(total)
    for i in range(0, len(a), BLOCK):
        mine = slice(i, min(i + BLOCK, len(a)))
        for j in range(i if own else 0, len(b_), BLOCK):
            theirs = slice(j, min(j + BLOCK, len(b_)))
            linked = block_links(a[mine], b_[theirs], qa.bounds(mine, qb, theirs), similar)
            if own and i == j:
                np.fill_diagonal(linked, False)
            if not linked.any():
                continue
            counts[mine] += linked.astype(np.float64).dot(copies_b_[theirs]).astype(np.int64)
            if not (own and i == j):
                back = linked.T.astype(np.float64).dot(copies_a[mine]).astype(np.int64)
                counts[shift + theirs.start : shift + theirs.stop] += back
            parts.unite(
                linked, range(mine.start, mine.stop), range(shift + theirs.start, shift + theirs.stop)
            )
    return counts, parts.roots(range(total))


def _entries(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64 if size == 8 else np.float32)


def _stored(embeddings: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, label, entries as bytes or null where nothing links, class), bytes of an entry."""
    size = 4 if dict(pick(embeddings, "embedding").dtypes)["embedding"] == "array<float>" else 8
    kind = pa.large_list(pa.float32() if size == 4 else pa.float64())

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2).cast(kind)
            out = []
            for vector in vectors:
                values = vector.values if vector.is_valid else None
                if values is None or values.null_count or not len(values):
                    out.append(None)
                    continue
                entries = values.to_numpy(zero_copy_only=False) + kind.value_type.to_pandas_dtype()(0)
                fits = np.isfinite(entries).all() and entries.any()  # adding 0 makes -0 plain
                out.append(entries.tobytes() if fits else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["vec_id", "label", "entries"]
            )

    rows = pick(embeddings, "vec_id", "label", "embedding")
    label = dict(rows.dtypes)["label"]
    rows = rows.select(F.col("vec_id").cast("long"), "label", "embedding")
    stored = rows.mapInArrow(store, f"vec_id long, label {label}, entries binary")
    usable = F.col("label").isNotNull() & F.col("entries").isNotNull()
    name = F.md5(F.concat(F.col("label").cast("string").cast("binary"), F.lit(b":"), F.col("entries")))
    return stored.withColumn("class", F.when(usable, name)), size


def _cells(classes: DataFrame, pivots: list[bytes], size: int) -> DataFrame:
    """Each class with the number of the pivot it is nearest to, among those of its length."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.float64 if size == 8 else np.float32
        units: dict[int, np.ndarray] = {}
        for length in {len(x) for x in pivots}:
            some = np.stack([np.frombuffer(x, kind) for x in pivots if len(x) == length])
            units[length] = unit_rows(some.astype(np.float64))
        for batch in batches:
            entries = batch.column("entries").to_pylist()
            lengths = np.array([len(x) for x in entries])
            cell = np.zeros(len(entries), np.int32)
            for length in set(lengths.tolist()) & set(units):
                mine = np.flatnonzero(lengths == length)
                vectors = np.frombuffer(b"".join([entries[i] for i in mine]), kind).reshape(len(mine), -1)
                cell[mine] = (unit_rows(vectors.astype(np.float64)) @ units[length].T).argmax(axis=1)
            yield batch.append_column("cell", pa.array(cell))

    fields = ", ".join(f"`{name}` {kind}" for name, kind in classes.dtypes)
    return classes.mapInArrow(nearest, f"{fields}, cell int")


TILE = "tile string, classes array<string>, copies array<long>, entries binary, centre array<double>, radius double"


def _tiles(dealt: DataFrame, size: int, label: str) -> DataFrame:
    """One row a tile: its classes, their copies and entries, centre and angular radius."""

    def pack(table: pa.Table) -> pa.Table:
        raw = pa.concat_arrays(table.column("entries").chunks)
        units = unit_rows(_entries(raw, size).reshape(len(raw), -1).astype(np.float64))
        centre = units.sum(axis=0)
        length = np.linalg.norm(centre)
        centre = centre / length if length > 1e-9 else units[0]
        radius = float(np.arccos(np.clip(units @ centre, -1, 1)).max())
        row = {
            "label": table.column("label")[0],
            "dim": table.column("dim")[0],
            "tile": table.column("tile")[0],
            "classes": pa.scalar(table.column("class").to_pylist()),
            "copies": pa.scalar(table.column("copies").to_pylist()),
            "entries": pa.scalar(b"".join(raw.to_pylist()), pa.binary()),
            "centre": pa.scalar(centre.tolist()),
            "radius": pa.scalar(radius),
        }
        return pa.table([pa.array([x.as_py()], x.type) for x in row.values()], names=list(row))

    return dealt.groupBy("label", "dim", "tile").applyInArrow(pack, f"label {label}, dim int, {TILE}")


def _compared(sides: DataFrame, size: int, similar: float) -> DataFrame:
    """(class, links, root) of every class that has a link within its pair of tiles."""

    def compare(table: pa.Table) -> pa.Table:
        tiles = sorted(table.to_pylist(), key=lambda row: row["tile"])
        kind = np.float64 if size == 8 else np.float32
        units, copies, names = [], [], []
        for tile in tiles:
            vectors = np.frombuffer(tile["entries"], kind).reshape(len(tile["classes"]), -1)
            units.append(unit_rows(vectors.astype(np.float64)))
            copies.append(np.array(tile["copies"], np.float64))
            names += tile["classes"]
        other = (units[1], copies[1]) if len(tiles) > 1 else (None, None)
        counts, roots = tile_links(units[0], copies[0], *other, similar)
        some = np.flatnonzero(counts)
        return pa.table(
            {
                "class": pa.array([names[i] for i in some], pa.string()),
                "links": counts[some],
                "root": pa.array([names[i] for i in roots[some]], pa.string()),
            }
        )

    return sides.groupBy("a", "b").applyInArrow(compare, "class string, links long, root string")


def embedding_dedup(
    embeddings: DataFrame, similar: float = SIMILAR, tile_bytes: int = TILE_BYTES, pivots: int = PIVOTS
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Rows link when their labels are equal and the cosine of their vectors, in double precision, reaches
    ``similar`` (over 0). Vectors of different length never link. Rows without a label and vectors that
    are null, empty, zero or hold null or non-finite entries link with nothing: no links, their own
    component, kept. Repeated rows count as other vectors. A null vec_id names no component unless no
    other id is there; a row without id is kept where its component has no id. Other columns are not
    read. An empty table gives no rows.
    """
    spark = embeddings.sparkSession
    shelf = Shelf(spark, "embedding_dedup")
    stored, size = _stored(embeddings)
    label = dict(stored.dtypes)["label"]
    rows = shelf.put(stored, "rows")
    classes = (
        rows.where("class IS NOT NULL")
        .groupBy("class", "label", "entries")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    )
    classes = shelf.put(classes, "classes")
    chosen = classes.orderBy(F.xxhash64("class")).limit(pivots).select("entries").collect()
    celled = _cells(classes, [bytes(r.entries) for r in chosen], size)
    celled = shelf.put(celled.withColumn("dim", (F.length("entries") / size).cast("int")), "cells")
    held = celled.groupBy("label", "dim", "cell").agg(F.count("*").alias("rows"))
    per_label = held.groupBy("label", "dim").agg(F.sum("rows").alias("all"))
    room = F.greatest(F.lit(1), F.floor(F.lit(tile_bytes) / (F.col("dim") * size)))
    plan = held.join(per_label, ["label", "dim"]).select(
        "label",
        "dim",
        "cell",
        (F.col("all") <= room).alias("single"),
        F.ceil(F.col("rows") / room).alias("buckets"),
    )
    bucket = F.pmod(F.xxhash64(F.lit(3), "class"), F.col("buckets"))
    place = F.when(F.col("single"), F.lit("all")).otherwise(F.concat_ws("/", "cell", bucket))
    dealt = celled.join(plan, ["label", "dim", "cell"]).withColumn(
        "tile", F.concat_ws("/", F.col("label").cast("string"), "dim", place)
    )
    with small_batches(spark):
        tiles = shelf.put(_tiles(dealt, size, label), "tiles")
    facts = tiles.select("label", "dim", "tile", "centre", "radius")
    product = F.aggregate(
        F.zip_with("x.centre", "y.centre", lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p
    )
    apart = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), product)))
    near = apart - F.col("x.radius") - F.col("y.radius") <= float(np.arccos(similar)) + SLACK
    met = (
        facts.alias("x")
        .join(facts.alias("y"), ["label", "dim"])
        .where((F.col("x.tile") == F.col("y.tile")) | ((F.col("x.tile") < F.col("y.tile")) & near))
        .select(F.col("x.tile").alias("a"), F.col("y.tile").alias("b"))
    )
    met = shelf.put(met, "met", slim=True)
    asked = met.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("tile"))
    sides = asked.join(tiles.select("tile", "classes", "copies", "entries"), "tile")
    with small_batches(spark, 16):
        found = shelf.put(_compared(sides, size, similar), "found", slim=True)
    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("class").alias("u"), F.col("root").alias("v")), shelf, "parts")
    part = (
        classes.select("class", "copies", "least")
        .join(counts, "class", "left")
        .join(roots.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("part", F.coalesce("root", "class"))
    )
    names = part.groupBy("part").agg(F.min("least").alias("component"))
    links = (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")
    known = part.join(names, "part").select(F.col("class").alias("own"), links, "component")
    known = shelf.put(known, "known", slim=True)
    component = F.when(F.col("own").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return rows.join(known, F.col("class") == F.col("own"), "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
