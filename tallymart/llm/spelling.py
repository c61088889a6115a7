"""Spelling variants: words one edit apart, found by walking a distributed trie level by level.

*Words.* Runs of letters are counted in Python, a span of text at a time; only distinct words and their
numbers are shuffled.

*Trie.* A node is a word, or a prefix after which words go on differently; the nodes between are left out,
so an edge bears several letters. In sorted order these prefixes are just the common ones of neighbouring
words. Slices of the sorted words (range partitions) find theirs on their own; all they need from the
other slices is how the common prefixes shorten there, a few numbers a slice. The edge table is kept in
pages: connected nodes of which the largest has at most WIDE times the words below it that the least has.
So a page has a bounded number of nodes, each of at most one edge a letter of the alphabet, and a path
leads through few pages. Pages are dealt into buckets of about COPY words.

*Frontier.* A state (word, position, node, edits) says that the word's letters before the position, with
so many edits, spell the node. Level by level states are joined with the page of their node and walk on
in it: along an edge that spells the next letters; or with the one edit at the first letter that differs,
replaced by a later one or deleted. Those that leave the page are the next level's. A state of one edit
ends as a pair where word and node end together. Replacing by an earlier letter and inserting are the
same pairs seen from the other word. So every pair of near words is found just once.

*Hot nodes.* The states at a page come from words below its parent node, so a page is repeated in
proportion to these and the states are dealt over the copies.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.frames import Shelf, pick

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
LONG_ENOUGH = re.compile("[A-Za-zÀ-ÿ]{5,}")  # shorter runs are never words
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SPAN = 1 << 20  # code points of a text looked at together
HELD = 200_000  # words counted in a task before they are handed on
SLICE = 100_000  # words of a slice of the trie
COPY = 20_000  # words for which a page is repeated once more
WIDE = 4_096  # of the words below a page's nodes, the most over the least
LEAST_LENGTH, LEAST_COUNT, DELETED = 5, 3, 97


def spans(text: str) -> Iterator[str]:
    """The text in parts that end at no run of letters' inside."""
    at = 0
    while at < len(text):
        end = at + SPAN
        if end < len(text):
            run = LETTERS.match(text, end - 1)
            end = run.end() if run else end
        yield text[at:end]
        at = end


def count_words(doc_id: int | None, text: str, into: Counter) -> None:
    """Add the words of one text. A run depends on doc_id and its letters alone, so equal ones go together."""
    runs: Counter = Counter()
    for part in spans(text):
        lowered = part.encode("utf-8", "surrogatepass").translate(LOWER).decode("utf-8", "surrogatepass")
        runs.update(LONG_ENOUGH.findall(lowered))
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), prefix)
        if h % DELETED == 0:
            place = h % len(run)
            run = run[:place] + run[place + 1 :]
        if len(run) >= LEAST_LENGTH:
            into[run] += n


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words of at least five letters and three occurrences."""

    def handed_on(counts: Counter) -> pa.RecordBatch:
        columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(*batch.columns, strict=True):
                if text.is_valid:
                    count_words(doc_id.as_py(), text.as_py(), counts)
                if len(counts) >= HELD:
                    yield handed_on(counts)
                    counts = Counter()
        yield handed_on(counts)

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    counted = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def common(a: str, b: str) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 16:  # halve first: comparing slices is faster than letter by letter
        middle = (low + high) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle)
    while low < high and a[low] == b[low]:
        low += 1
    return low


Stack = list[tuple[int, int]]


def shortened(stack: Stack, length: int, place: int) -> Stack:
    """``stack`` holds the lengths that a word shares with the words on one side, ascending, each with the
    place from which on it is no more. Now that of its neighbour on the other side, which shares
    ``length`` with it."""
    while stack and stack[-1][0] >= length:
        stack.pop()
    stack.append((length, place))
    return stack


def backward(words: list[str]) -> Stack:
    """What the first word of a slice shares with the later words of the slice."""
    stack: Stack = []
    for i in range(len(words) - 1, 0, -1):
        shortened(stack, common(words[i - 1], words[i]), i)
    return stack


def forward(words: list[str]) -> Stack:
    """What the last word of a slice shares with the earlier words of the slice."""
    stack: Stack = []
    for i in range(1, len(words)):
        shortened(stack, common(words[i - 1], words[i]), i)
    return stack


def _beyond(outer: Stack, inner: Stack, start: int) -> Stack:
    """``outer`` seen through a slice that starts at ``start`` and has the summary ``inner``."""
    seen = [x for x in outer if not inner or x[0] < inner[0][0]]
    return seen + [(length, start + place) for length, place in inner]


def outside(slices: list[tuple[str, str, int, Stack, Stack]]) -> list[tuple[int, Stack, Stack]]:
    """For each slice (first word, last word, number of words, ``backward``, ``forward``): the place of its
    first word, what that shares with all words before it, and its last word with all words after it."""
    starts = [0]
    for _, _, number, _, _ in slices:
        starts.append(starts[-1] + number)
    before: list[Stack] = [[] for _ in slices]
    after: list[Stack] = [[] for _ in slices]
    for i in range(1, len(slices)):
        seen = _beyond(before[i - 1], slices[i - 1][4], starts[i - 1])
        before[i] = shortened(seen, common(slices[i - 1][1], slices[i][0]), starts[i])
    for i in range(len(slices) - 2, -1, -1):
        seen = _beyond(after[i + 1], slices[i + 1][3], starts[i + 1])
        after[i] = shortened(seen, common(slices[i][1], slices[i + 1][0]), starts[i + 1])
    return list(zip(starts, before, after, strict=False))


def page_class(words: int, total: int, wide: int) -> int:
    """0 for the nodes with the most words below; connected nodes of one class share a page."""
    number, scaled = 0, words * wide
    while scaled < total:
        number, scaled = number + 1, scaled * wide
    return number


Edge = tuple[str, int, str, str, bool, int]


def edges(
    words: list[str], start: int, before: Stack, after: Stack, total: int, copy_words: int, wide: int
) -> Iterator[Edge]:
    """(page, its copies, node, letters, whether a word ends there, copies of the page that begins there or
    0) of the edges to nodes that no earlier word has."""
    later = [list(after)]
    for i in range(len(words) - 1, 0, -1):
        later.append(shortened(list(later[-1]), common(words[i - 1], words[i]), start + i))
    earlier = list(before)
    for i, word in enumerate(words):
        if i:
            shortened(earlier, common(words[i - 1], word), start + i)
        shared = earlier[-1][0] if earlier else 0
        ends = later[len(words) - 1 - i]
        depths = sorted({*(x for x, _ in earlier if x), *(x for x, _ in ends if 0 < x < len(word)), len(word)})
        at, below = 0, total
        page, page_copies, kind = 0, 1 + total // copy_words, 0
        for depth in depths:
            first = max((place for x, place in earlier if x < depth), default=0)
            last = min((place for x, place in ends if x < depth), default=total)
            size = last - first
            child_kind = page_class(size, total, wide)
            out = 1 + below // copy_words if child_kind > kind else 0
            if depth > shared:
                yield word[:page], page_copies, word[:at], word[at:depth], depth == len(word), out
            if out:
                page, page_copies, kind = depth, out, child_kind
            at, below = depth, size


EDGES = "page string, copies int, node string, label string, word boolean, out int"


def trie(words: DataFrame, total: int, shelf: Shelf, slice_words: int, copy_words: int, wide: int) -> DataFrame:
    """The edge table of the trie of all words: see ``edges``. ``follow`` are the letters that follow where a
    page begins."""
    slices = max(1, -(-total // slice_words))
    ordered = words.select("word").repartitionByRange(slices, "word")
    ordered = shelf.put(ordered.withColumn("slice", F.spark_partition_id()), "ordered")
    sides = ("lengths", "places", "lengths_before", "places_before")
    outlined = "slice int, first string, last string, number long, "
    outlined += ", ".join(f"{name} array<int>" for name in sides)

    def outline(table: pa.Table) -> pa.Table:
        some = sorted(table.column("word").to_pylist())
        columns = [table.column("slice").slice(0, 1).combine_chunks()]
        columns += [pa.array([x]) for x in (some[0], some[-1], len(some))]
        for stack in (backward(some), forward(some)):
            for k in (0, 1):
                columns.append(pa.array([[x[k] for x in stack]], pa.list_(pa.int32())))
        return pa.table(columns, names=[field.split()[0] for field in outlined.split(", ")])

    outlines = ordered.groupBy("slice").applyInArrow(outline, outlined).orderBy("slice").collect()
    # Two words and a few numbers a slice.
    known = outside(
        [
            (
                r.first,
                r.last,
                r.number,
                list(zip(r.lengths, r.places, strict=True)),
                list(zip(r.lengths_before, r.places_before, strict=True)),
            )
            for r in outlines
        ]
    )
    by_slice = {r.slice: places for r, places in zip(outlines, known, strict=True)}

    def branches(table: pa.Table) -> pa.Table:
        some = sorted(table.column("word").to_pylist())
        found = list(edges(some, *by_slice[table.column("slice")[0].as_py()], total, copy_words, wide))
        types = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.int32()]
        columns = zip(*found, strict=True)
        names = [field.split()[0] for field in EDGES.split(", ")]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    found = shelf.put(ordered.groupBy("slice").applyInArrow(branches, EDGES), "edges")
    follow = (
        found.where("node = page")
        .groupBy(F.col("page").alias("child"))
        .agg(F.concat_ws("", F.collect_list(F.substring("label", 1, 1))).alias("follow"))  # bounded: letters
    )
    inner = found.where("out = 0").withColumn("follow", F.lit(""))
    leading = found.where("out > 0").withColumn("child", F.concat("node", "label"))
    return inner.unionByName(leading.join(follow, "child", "left").drop("child"))


class Pages:
    """The nodes of some pages with their edges by first letter: (letters, node there, whether it is a word,
    copies of the page that begins there or 0, letters that follow there)."""

    def __init__(self, rows: Iterator[tuple[str, str, bool, int, str | None]]):
        self.nodes: dict[str, dict[str, tuple[str, str, bool, int, str]]] = {}
        for node, label, is_word, out, follow in rows:
            edge = (label, node + label, is_word, out, follow or "")
            self.nodes.setdefault(node, {})[label[0]] = edge

    def walk(self, word: str, position: int, edits: int, node: str, is_word: bool, pairs: list, leaving: list) -> None:
        """Add near words to ``pairs`` and states that leave their page to ``leaving``: (position, edits,
        node, whether it is a word, copies)."""
        size, nodes = len(word), self.nodes
        while not edits:
            out = nodes.get(node, {})
            letter = word[position]
            if position + 1 == size and is_word:
                pairs.append(node)
            second = word[position + 1] if position + 1 < size else ""
            for first, edge in out.items():
                if first > letter:
                    self._edited(word, position, 0, edge, True, pairs, leaving)
                if first == second and first != letter:
                    self._edited(word, position, 0, edge, False, pairs, leaving)
            edge = out.get(letter)
            if edge is None:
                return
            label, child, is_word, copies, _ = edge
            if not word.startswith(label, position):
                same = common(label, word[position : position + len(label)])
                if position + same < size:
                    if label[same] > word[position + same]:
                        self._edited(word, position, same, edge, True, pairs, leaving)
                    self._edited(word, position, same, edge, False, pairs, leaving)
                return
            position += len(label)
            if position == size:
                return
            if copies:
                leaving.append((position, 0, child, is_word, copies))
                return
            node = child
        self._exactly(word, position, node, pairs, leaving)

    def _edited(self, word, position, same, edge, replaced, pairs, leaving) -> None:
        """One edit at the edge's letter of place ``same``: replaced by that letter or deleted."""
        label, child, is_word, copies, follow = edge
        at = position + same + 1
        if not word.startswith(label[same + 1 :] if replaced else label[same:], at):
            return
        position += len(label) if replaced else len(label) + 1
        if position == len(word):
            if is_word:
                pairs.append(child)
        elif copies:
            if word[position] in follow:
                leaving.append((position, 1, child, is_word, copies))
        else:
            self._exactly(word, position, child, pairs, leaving)

    def _exactly(self, word, position, node, pairs, leaving) -> None:
        """On from a node without further edits."""
        nodes, size = self.nodes, len(word)
        while True:
            out = nodes.get(node)
            edge = out.get(word[position]) if out else None
            if edge is None:
                return
            label, node, is_word, copies, follow = edge
            if not word.startswith(label, position):
                return
            position += len(label)
            if position == size:
                if is_word:
                    pairs.append(node)
                return
            if copies:
                if word[position] in follow:
                    leaving.append((position, 1, node, is_word, copies))
                return


STATE = "word string, position int, edits int, node string, is_word boolean, copies int"
STATE_TYPES = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.int32())


def _walk(states: pa.Table, edge_rows: pa.Table) -> pa.Table:
    """The states that leave a page, and near words as rows of position -1."""
    fields = ("node", "label", "word", "out", "follow")
    there = Pages(zip(*(edge_rows.column(c).to_pylist() for c in fields), strict=True))
    columns: list[list] = [[] for _ in STATE_TYPES]
    names = [field.split()[0] for field in STATE.split(", ")]
    for word, *state in zip(*(states.column(c).to_pylist() for c in names[:5]), strict=True):
        pairs: list = []
        leaving: list = []
        there.walk(word, *state, pairs, leaving)
        for near in pairs:
            leaving.append((-1, 1, near, True, 0))
        for row in leaving:
            columns[0].append(word)
            for column, value in zip(columns[1:], row, strict=True):
                column.append(value)
    return pa.table([pa.array(c, t) for c, t in zip(columns, STATE_TYPES, strict=True)], names=names)


def near_words(words: DataFrame, shelf: Shelf, slice_words: int, copy_words: int, wide: int) -> DataFrame:
    """(word, near) of each pair of words one edit apart, in one of its two orders."""
    total = words.count()
    buckets = 1 + 4 * total // copy_words
    bucket = F.pmod(F.hash("page", "copy"), F.lit(buckets)).alias("bucket")
    pages = trie(words, total, shelf, slice_words, copy_words, wide)
    pages = pages.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    pages = shelf.put(pages.select("node", "label", "word", "out", "follow", bucket), "pages")
    states = words.select(
        "word",
        F.lit(0).alias("position"),
        F.lit(0).alias("edits"),
        F.lit("").alias("node"),
        F.lit(False).alias("is_word"),
        F.lit(1 + total // copy_words).alias("copies"),
    )
    pairs, level = None, 0
    while True:
        dealt = states.withColumn("page", F.col("node")).withColumn("copy", F.pmod(F.hash("word"), F.col("copies")))
        walked = dealt.withColumn("bucket", bucket).groupBy("bucket").cogroup(pages.groupBy("bucket"))
        now = shelf.put(walked.applyInArrow(_walk, STATE), f"level{level}")
        found = now.where("position < 0").select("word", F.col("node").alias("near"))
        pairs = found if pairs is None else pairs.unionAll(found)
        states = now.where("position >= 0")
        level += 1
        if states.isEmpty():
            return pairs


def _roots(forms: DataFrame, shelf: Shelf) -> DataFrame:
    """(word, root): ``forms`` (word, form) followed to its end, in steps of doubled length.

    Along a chain n at least doubles with each form, so there is no circle and few rounds.
    """
    now, turn = shelf.put(forms.select("word", F.col("form").alias("root")), "roots0"), 0
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = now.join(onward, "root", "left")
        turn += 1
        after = shelf.put(
            further.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            f"roots{turn}",
        )
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")


def spelling(
    docs: DataFrame, slice_words: int = SLICE, copy_words: int = COPY, wide: int = WIDE
) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the corpus.

    Null, empty and letterless texts have no words; a null doc_id counts as an empty one in the hash that
    deletes letters. Repeated rows count again. Texts and words of any length are taken whole. Other
    columns are not read. A table without words gives no rows.
    """
    shelf = Shelf(docs.sparkSession, "spelling")
    words = shelf.put(vocabulary(docs), "words")
    if words.isEmpty():
        return docs.sparkSession.createDataFrame(
            [], "word string, form string, root string, n long, n_near long, form_n long"
        )
    pairs = near_words(words, shelf, slice_words, copy_words, wide)
    both = pairs.unionAll(pairs.select(F.col("near").alias("word"), F.col("word").alias("near")))
    best = (
        both.join(words.toDF("near", "near_n"), "near")
        .groupBy("word")
        .agg(
            F.count("*").alias("n_near"),
            F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near"))).alias("best"),
        )
        .select("word", "n_near", F.col("best.near").alias("best"), (-F.col("best.order")).alias("best_n"))
    )
    judged = words.join(best, "word", "left")
    judged = judged.withColumn("has", F.coalesce(F.col("best_n") >= 2 * F.col("n"), F.lit(False)))
    judged = judged.select(
        "word",
        F.when(F.col("has"), F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("has"), F.col("best_n")).alias("form_n"),
    )
    judged = shelf.put(judged, "judged")
    roots = _roots(judged.where("form IS NOT NULL"), shelf)
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
