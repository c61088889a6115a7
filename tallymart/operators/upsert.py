"""Keyed upsert of one day's rows into a partitioned Parquet table.

Rules of the merge: a target row whose key equals a source key is replaced as a whole, other source
rows are added, other target rows stay. Keys compare with ``=``, so a row with a NULL in its key
never matches and is added on every run.

Work per run follows the day, not the table: a day that is not in the table yet is appended; only
when rows have to be replaced are the partitions concerned rewritten. There is one writer per table.

Lost executors cost repeated tasks only. Replacing or adding several folders is not one transaction,
so the step under way is noted, and its rows are staged, in a hidden folder beside the table
(``<base>/_<table>``): whoever runs next, with whatever scratch folder and spelling of the path, first
completes the rewrite or the append from the staged rows, or starts an incomplete first load again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date, datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.functions import all_present
from tallymart.operators.quality import moment
from tallymart.schemas import require_columns
from tallymart.sources.published import (
    file_system,
    find_published,
    path_exists,
    read_published,
    schema_note,
    stored_types,
    table_path,
)

CREATING, REWRITING, APPENDING, NOTHING = "creating", "rewriting", "appending", "nothing"
# Partitions of one merge that are named in the scan's filter; each is a short row on the driver.
NAMED_PARTITIONS = 10_000
# File systems on which moving a folder touches no data. Elsewhere staged rows are copied.
RENAMING = ("file", "hdfs", "viewfs", "abfs", "abfss")


def increment(df: DataFrame, inc_col: str, as_of: date | datetime | str) -> DataFrame:
    """The rows of the as-of day; late rows of earlier days are not part of it."""
    return df.where(F.col(inc_col) == moment(as_of, dict(df.dtypes)[inc_col]))


def require_unique_keys(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise ValueError when a key without NULLs occurs twice."""
    repeated = source.where(all_present(keys)).groupBy(*keys).count().where("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"Source rows are not unique on {list(keys)}")


def require_same_columns(table: DataFrame, df: DataFrame, partitions: Sequence[str]) -> None:
    """Raise ValueError unless the stored columns have the names and types of ``df``."""
    wanted = {name: kind for name, kind in df.dtypes if name not in partitions}
    stored = stored_types(table)
    differing = sorted({name for name, _ in wanted.items() ^ (stored or wanted).items()})
    if differing:
        raise ValueError(f"Columns differ from the published table in name or type: {differing}")


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target with its matching rows replaced and the remaining source rows added."""
    require_columns(target.columns, list(keys))
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source)


def _write(
    df: DataFrame,
    path: str,
    partitions: Sequence[str],
    mode: str,
    replace: str = "dynamic",
    sort_by: str = "",
) -> None:
    """Write in files of even size, however uneven the partitions are.

    REBALANCE gathers the rows of a partition, then lets adaptive execution split a large one over
    several tasks and merge small ones. Overwriting replaces the partitions written to
    (``dynamic``) or the whole table (``static``). Files sorted by ``sort_by`` let later scans skip
    the row groups of other days.
    """
    df = df.hint("rebalance", *partitions)
    if sort_by:
        df = df.sortWithinPartitions(*partitions, sort_by)
    writer = df.write.mode(mode)
    if partitions:
        writer = writer.option("partitionOverwriteMode", replace).partitionBy(*partitions)
    writer.parquet(path)


def _beside(path: str, name: str) -> str:
    """A file set of the table's own, in a folder that readers of ``<base>`` skip."""
    base, _, table = path.rpartition("/")
    return f"{base}/_{table}/{name}"


def _staged(df: DataFrame, path: str, name: str) -> DataFrame:
    """``df`` computed once into the table's own folder."""
    df.write.mode("overwrite").parquet(_beside(path, name))
    return df.sparkSession.read.schema(df.schema).parquet(_beside(path, name))


def _note(spark: SparkSession, path: str, step: str, as_of: str = "") -> None:
    note = spark.range(1).select(F.lit(step).alias("step"), F.lit(as_of).alias("as_of"))
    note.coalesce(1).write.mode("overwrite").parquet(_beside(path, "under_way"))


@contextmanager
def _noted(spark: SparkSession, path: str, step: str, as_of: str = "") -> Iterator[None]:
    """Note the step while it runs; when it fails the note stays."""
    _note(spark, path, step, as_of)
    yield
    _note(spark, path, NOTHING)


def _interrupted(spark: SparkSession, path: str) -> tuple[str, str]:
    """The step that an earlier run left unfinished, and its as-of moment.

    A note that was being replaced when its writer died has no row: the step before it was noted
    completely or had ended, and whatever follows a note had not begun.
    """
    note = _beside(path, "under_way")
    if not path_exists(spark, note):
        return NOTHING, ""
    found = spark.read.schema("step string, as_of string").parquet(note).first()
    return (found.step, found.as_of) if found else (NOTHING, "")


def is_loaded(spark: SparkSession, base: str, table: str) -> bool:
    """True when the first load is complete, so that only the as-of day matters from now on."""
    path = table_path(base, table)
    step = _interrupted(spark, path)[0]
    return step == REWRITING or (path_exists(spark, path) and step != CREATING)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _named(value: str | None, kind: str) -> str:
    """SQL of one partition value, given as text."""
    if value is None:
        return f"CAST(NULL AS {kind})"
    return "CAST('" + value.replace("\\", "\\\\").replace("'", "\\'") + f"' AS {kind})"


def in_partitions(values: Sequence[Sequence[str | None]], kinds: dict[str, str]) -> Column:
    """Rows whose partition columns (``kinds``: name to type) hold one of the rows of ``values``.

    One flat list of values, whatever their number, so the predicate is two levels deep; as it is on
    partition columns alone, the scan evaluates it on the folders. In a list of several columns NULL
    equals NULL; for one column it is asked for on its own.
    """
    names = list(kinds)
    if len(names) == 1:
        some = [_named(row[0], kinds[names[0]]) for row in values if row[0] is not None]
        listed = F.expr(f"{_quoted(names[0])} IN ({', '.join(some)})") if some else F.lit(False)
        found = F.coalesce(listed, F.lit(False))
        return found | F.col(_quoted(names[0])).isNull() if len(some) < len(values) else found
    rows = ", ".join(
        "struct(" + ", ".join(_named(v, kinds[p]) for p, v in zip(names, row, strict=True)) + ")"
        for row in values
    )
    return F.expr(f"struct({', '.join(map(_quoted, names))}) IN ({rows})") if values else F.lit(False)


def touched_rows(target: DataFrame, source: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Target rows of the partitions that ``source`` writes to.

    Up to NAMED_PARTITIONS they are named in the filter of the scan, which then lists and reads those
    folders only, however many rows ``source`` has. Beyond that they are joined, and the scan is
    still pruned by each column that has few enough values.
    """
    if not partitions:
        return target
    kinds = {p: target.schema[p].dataType.simpleString() for p in partitions}
    texts = [F.col(_quoted(p)).cast(kinds[p]).cast("string").alias(p) for p in partitions]
    named = source.select(*map(_quoted, partitions)).distinct()
    values = named.select(*texts).limit(NAMED_PARTITIONS + 1).collect()
    if len(values) <= NAMED_PARTITIONS:
        return target.where(in_partitions(values, kinds))
    for p in partitions:
        own = named.select(F.col(_quoted(p)).cast(kinds[p]).cast("string")).distinct()
        some = own.limit(NAMED_PARTITIONS + 1).collect()
        if len(some) <= NAMED_PARTITIONS:
            target = target.where(in_partitions(some, {p: kinds[p]}))
    same = reduce(and_, (target[p].eqNullSafe(named[p]) for p in partitions))
    return target.join(named, same, "left_semi")


def late_rows(
    df: DataFrame,
    base: str,
    table: str,
    keys: Sequence[str],
    inc_col: str,
    as_of: date | datetime | str,
    partitions: Sequence[str] | None = None,
) -> DataFrame:
    """One row: the rows of ``df`` of days before the as-of day, and how many of them the published
    table lacks (``missing``: no such key) or holds with other values (``differing``).

    A run publishes its own day only, so these stay unpublished; this tells how many there are and
    publishes nothing. The table is read in the partitions these rows lie in. A key with a NULL is
    never in the table. All rows are missing where there is no table.
    """
    spark, keys = df.sparkSession, list(keys)
    require_columns(df.columns, [*keys, inc_col])
    kind = dict(df.dtypes)[inc_col]
    late = df.where(F.col(inc_col) < moment(as_of, kind))
    path = table_path(base, table)
    stored = find_published(spark, path, df.schema)
    if stored is None:
        stored = df.limit(0)
    stored = touched_rows(stored.where(F.col(inc_col) < moment(as_of, kind)), late, list(partitions or []))
    values = [name for name in df.columns if name not in keys]
    held = stored.select(
        *(F.col(_quoted(name)).alias(f"key_{i}") for i, name in enumerate(keys)),
        F.struct(*map(_quoted, values), F.lit(True).alias("_there")).alias("_stored"),
    )
    same_key = reduce(and_, (F.col(_quoted(name)) == F.col(f"key_{i}") for i, name in enumerate(keys)))
    there = F.col("_stored._there").isNotNull()
    as_stored = reduce(
        and_, (F.col(_quoted(v)).eqNullSafe(F.col(f"_stored.{_quoted(v)}")) for v in values), F.lit(True)
    )
    return late.join(held, same_key, "left").agg(
        F.count(F.lit(1)).alias("late"),
        F.count_if(~there).alias("missing"),
        F.count_if(there & ~as_stored).alias("differing"),
    )


def publish(
    df: DataFrame,
    base: str,
    table: str,
    keys: Sequence[str],
    inc_col: str,
    as_of: date | datetime | str,
    partitions: Sequence[str] | None = None,
) -> str:
    """Create the table from all of ``df``, or merge the rows of the as-of day into it.

    Returns ``created``, ``unchanged``, ``appended`` or ``merged``. Partition columns must be part
    of the key: a replaced row must lie in the partition that is rewritten. Errors are raised, not
    logged away.
    """
    spark, keys, partitions = df.sparkSession, list(keys), list(partitions or [])
    require_columns(df.columns, keys)
    require_columns(df.columns, [inc_col])
    if not set(partitions) <= set(keys):
        raise ValueError(f"Partition columns {partitions} must be among the keys {keys}")
    path = table_path(base, table)

    sort_by = "" if inc_col in partitions else inc_col
    step, noted_as_of = _interrupted(spark, path)
    if step == REWRITING:  # the table may be gone until its staged rows are moved in
        rewrite(spark, path, partitions, df, sort_by)
    if step == CREATING or not path_exists(spark, path):
        with _noted(spark, path, CREATING):
            columns = spark.range(1).select(F.lit(df.schema.json()).alias("columns"))
            columns.coalesce(1).write.mode("overwrite").parquet(schema_note(path))
            _write(df, path, partitions, "overwrite", replace="static")
        return "created"
    if step == APPENDING:
        complete_append(spark, path, partitions, df, inc_col, noted_as_of)
    target = find_published(spark, path, df.schema)
    require_same_columns(target, df, partitions)

    staged = _staged(increment(df, inc_col, as_of), path, "increment")
    # Stated again on the stored rows, the day lets the scans of the target be pruned by them.
    source = increment(staged, inc_col, as_of)
    if source.isEmpty():
        return "unchanged"
    require_unique_keys(source, keys)

    # A key that holds the increment column can only match rows of the same day, and partitions are
    # part of the key.
    day = increment(target, inc_col, as_of) if inc_col in keys else target
    day = touched_rows(day, source, [p for p in partitions if p != inc_col])
    if day.join(source.select(*keys), keys, "left_semi").isEmpty():
        _staged(increment(target, inc_col, as_of), path, "before")
        with _noted(spark, path, APPENDING, str(as_of)):
            _write(source, path, partitions, "append")
        return "appended"

    if inc_col in keys and inc_col not in partitions:
        # The history that shares a partition with the day is carried over without a join.
        history = touched_rows(
            target.where(~F.col(inc_col).eqNullSafe(moment(as_of, day.schema[inc_col].dataType))),
            source,
            partitions,
        )
        merged = history.unionByName(merge_rows(day, source, keys))
    else:
        merged = merge_rows(day, source, keys)
    _write(merged, _beside(path, "merged"), partitions, "overwrite", "static", sort_by)
    rewrite(spark, path, partitions, df, sort_by)
    return "merged"


def rewrite(
    spark: SparkSession,
    path: str,
    partitions: Sequence[str],
    like: DataFrame,
    sort_by: str = "",
) -> None:
    """Put the staged merge result in place; doing it twice changes nothing.

    Staged rows lie in folders as the table's. Where moving a folder touches no data (RENAMING), each
    replaces its partition as it is, so rows are written once; a run that is cut short leaves the
    folders it has not moved yet. Elsewhere the rows are copied.
    """
    staged = _beside(path, "merged")
    with _noted(spark, path, REWRITING):
        if file_system(spark, path).getScheme() in RENAMING:
            _swap_in(spark, staged, path, len(partitions))
        else:
            merged = spark.read.schema(like.schema).parquet(staged)
            _write(merged, path, list(partitions), "overwrite", sort_by=sort_by)


def _swap_in(spark: SparkSession, staged: str, path: str, depth: int) -> None:
    """Move the folders of ``depth`` levels below ``staged`` (itself, if none) to ``path``."""
    files = file_system(spark, path)
    as_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def move(source: str, to: str) -> None:
        files.delete(as_path(to), True)
        files.mkdirs(as_path(to).getParent())
        if not files.rename(as_path(source), as_path(to)):
            raise OSError(f"Cannot move {source} to {to}")

    def walk(folder: str, to: str, levels: int) -> None:
        for status in files.listStatus(as_path(folder)):
            name = status.getPath().getName()
            if status.isDirectory():
                step = walk if levels > 1 else lambda a, b, _: move(a, b)
                step(f"{folder}/{name}", f"{to}/{name}", levels - 1)

    if not files.exists(as_path(staged)):
        return
    if depth:
        walk(staged, path, depth)
    else:
        move(staged, path)


def complete_append(
    spark: SparkSession,
    path: str,
    partitions: Sequence[str],
    like: DataFrame,
    inc_col: str,
    as_of: str,
) -> None:
    """Add what an interrupted append has not added; doing it twice changes nothing.

    Rows are counted, not matched by key: those of the day that were not there before the append
    are the ones it added, also where their key holds a NULL.
    """
    day = increment(read_published(spark, path, like.schema), inc_col, as_of)
    source, before = (
        spark.read.schema(like.schema).parquet(_beside(path, name))
        for name in ("increment", "before")
    )
    columns = like.columns
    added = day.select(*columns).exceptAll(before.select(*columns))
    missing = _staged(source.select(*columns).exceptAll(added), path, "missing")
    with _noted(spark, path, APPENDING, as_of):
        _write(missing, path, list(partitions), "append")
