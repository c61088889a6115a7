"""The operators as Spark jobs: hard rows, empty tables, clashing columns, brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallymart.llm import (
    decontamination,
    language,
    ngram_join,
    packing,
    quality_model,
    quality_rules,
    registry,
    sharding,
    token_counts,
    token_files,
    toxicity,
)
from tallymart.llm.components import components
from tallymart.llm.frames import Shelf, pick, rows_of, with_row
from tallymart.llm.vocab import library_tokenizer, sentence_tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "doc_id long, text string, lang string, source string, TEXT string, score string, `a.b` int, shard int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALPHANUMERIC = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PROSE = (
    "The harbour town woke slowly while gulls argued over scraps near the old customs house and a "
    "baker carried warm loaves across the wet square toward the market stalls"
)


def hard_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows, near copies."""
    words = PROSE.split()
    near = " ".join([*words[:-1], "stands"])
    long = " ".join(f"{w}{i}" for i in range(3000) for w in words[:3])
    return [
        (None, None, None, None, None),
        (None, PROSE, "en", None, 1),
        (None, PROSE, "en", "a", 1),
        (1, None, "en", "a", 0),
        (2, "", None, "a", 0),
        (3, " \n\t ", "en", "b", 3),
        (7, PROSE, "en", "b", 9),
        (7, PROSE, "en", "b", 9),
        (5, PROSE.upper(), "de", "b", 9),
        (8, near, "de", "b", 9),
        (9, long, "fr", "b", 9),
        (9, "another text of the same id", "fr", "c", 9),
        (-4, "one two", "fr", "c", 9),
        (11, "One two", "fr", "c", 9),
        (12, "123 456 !!", "fr", "c", 9),
    ]


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(hard_rows(), SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(7, 1, 0), (5, 0, 1), (8, 1, None), (None, 1, 1), (9, None, 0), (11, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [
        (1, " ".join(PROSE.split()[3:16])),
        (2, "One TWO"),
        (None, "carried warm loaves across the wet square toward the market"),
        (4, None),
        (5, " ?! "),
        (1, "no such words at all"),
        (6, "harbour, town; WOKE slowly while gulls argued over scraps near the"),
    ]
    return spark.createDataFrame(rows, "item_id long, text string")


def clashing(spark, rows):
    extra = [(a, b, c, d, "other", "high", 1, 99) for a, b, c, d, _ in rows]
    return spark.createDataFrame(extra, CLASHING)


OPERATORS = {
    "ngram_join": lambda d, la, b: ngram_join.ngram_join(d),
    "shards": lambda d, la, b: sharding.shards(d),
    "toxicity": lambda d, la, b: toxicity.toxicity(d, la),
    "token_files": lambda d, la, b: registry_token_files(d),
    "quality": lambda d, la, b: quality_model.quality(d, la),
    "quality_rules": lambda d, la, b: quality_rules.quality_rules(d),
    "contamination": lambda d, la, b: decontamination.contamination(d, b),
    "languages": lambda d, la, b: language.languages(d),
    "token_counts": lambda d, la, b: token_counts.token_counts(d),
    "pack": lambda d, la, b: packing.pack(d),
}


def registry_token_files(docs):
    folder = f"{Shelf(docs.sparkSession, 'test').folder}/files"
    token_files.write_token_files(docs, folder, segment=500, block=16)
    return token_files.read_token_files(docs.sparkSession, folder)


def plain(df):
    return sorted((tuple(map(str, row)) for row in df.collect()), key=repr)


@pytest.mark.parametrize("name", OPERATORS)
def test_hard_rows_clashing_columns_and_empty_tables(spark, hard, labels, benchmark, name):
    operator = OPERATORS[name]
    whole = plain(operator(hard, labels, benchmark))
    assert plain(operator(clashing(spark, hard_rows()), labels, benchmark)) == whole
    assert operator(hard.limit(0), labels.limit(0), benchmark.limit(0)).collect() == []
    if name != "pack":
        assert len(whole) == len(hard_rows())
    bare = spark.createDataFrame([(1, None, None, None, None)], SCHEMA)
    assert operator(bare, labels.limit(0), benchmark.limit(0)).count() == 1


def test_a_column_that_is_absent_is_named(hard):
    with pytest.raises(ValueError, match=r"\['words'\]"):
        pick(hard, "doc_id", "words")


def test_rows_survive_being_judged(spark):
    df = clashing(spark, hard_rows())
    assert plain(rows_of(with_row(df, "text"), df.columns)) == plain(df)


# N-gram Jaccard join


def brute_components(rows):
    sets = []
    for doc_id, text in rows:
        w = WORDS.findall((text or "").translate(UPPER))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for k, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(k)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [d for k, (d, _) in enumerate(rows) if find(k) == find(i) and d is not None]
        out.append((str(doc_id), str(len(sets[i])), str(min(ids) if ids else None)))
    return sorted(out, key=repr)


def joined(spark, rows):
    df = ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string"))
    return plain(df.select("doc_id", "n_shingles", "component_id"))


def test_join_on_hard_rows(spark):
    rows = [(a, b) for a, b, *_ in hard_rows()]
    assert joined(spark, rows) == brute_components(rows)


@pytest.mark.parametrize(("few", "boundary"), [(8, None), (10**9, 0), (2, 128)])
def test_join_against_all_pairs(spark, monkeypatch, few, boundary):
    """Chains of near copies, small sets at the threshold, shared passages; with many and no common
    shingles, and with either side of the boundary alone."""
    monkeypatch.setattr(ngram_join, "FEW", few)
    if boundary is not None:
        monkeypatch.setattr(ngram_join, "choose_boundary", lambda costs: boundary)
    dice = random.Random(few % 97)
    word = lambda: f"w{dice.randrange(4000)}"
    passage = [word() for _ in range(25)]
    rows = []
    for _ in range(14):
        text = [word() for _ in range(dice.choice([5, 8, 9, 14, 40, 120]))]
        if dice.random() < 0.5:
            text += passage
        for _ in range(dice.randrange(1, 6)):
            rows.append((len(rows) * 3, " ".join(text)))
            at = dice.randrange(len(text))
            text = text[:at] + [word()] + text[at + dice.randrange(2) :]
    dice.shuffle(rows)
    assert joined(spark, rows) == brute_components(rows)


def brute_links(rows):
    """{frozenset of two sets: overlap} of all linked pairs of different sets."""
    sets = set()
    for _, text in rows:
        w = WORDS.findall((text or "").translate(UPPER))
        if w:
            sets.add(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))))
    sets = list(sets)
    return sorted(
        (*sorted((len(a), len(b))), len(a & b))
        for i, a in enumerate(sets)
        for b in sets[:i]
        if 100 * len(a & b) >= 80 * len(a | b)
    )


@pytest.mark.parametrize(("few", "boundary"), [(8, None), (10**9, 0), (2, 128)])
def test_all_links_are_found(spark, monkeypatch, few, boundary):
    """Also those between sets that are connected already; equal sets link as one."""
    monkeypatch.setattr(ngram_join, "FEW", few)
    if boundary is not None:
        monkeypatch.setattr(ngram_join, "choose_boundary", lambda costs: boundary)
    dice = random.Random(few % 89)
    word = lambda: f"w{dice.randrange(4000)}"
    rows = [(a, b) for a, b, *_ in hard_rows()]
    for _ in range(10):
        base = [word() for _ in range(dice.choice([30, 60, 75, 90, 110, 200]))]
        for _ in range(7):
            text = list(base)
            for _ in range(dice.randrange(2)):
                text[dice.randrange(len(text))] = word()
            rows.append((len(rows) * 3, " ".join(text[: len(text) - dice.randrange(3)])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = ngram_join.links(df).collect()
    want = brute_links(rows)
    assert sorted((*sorted((r.n_u, r.n_v)), r.n_both) for r in found) == want
    assert len(want) > 30 and all(r.set_u > r.set_v for r in found)
    ends = [x for r in found for x in (r.set_u, r.set_v)]
    counted = ngram_join.link_counts(df).collect()
    assert len(counted) == len(rows)
    assert all(r.n_links == (ends.count(r.set_id) if r.n_shingles else 0) for r in counted)


def test_rows_of_a_template_are_not_paired(spark, monkeypatch):
    """12 shingles, 10 of them shared by all: similarity 10 / 14, so no two can link."""
    paired, verified = [], ngram_join._verified
    monkeypatch.setattr(
        ngram_join, "_verified", lambda pairs, sets: paired.append(pairs.count()) or verified(pairs, sets)
    )
    template = " ".join(f"t{i}" for i in range(14))
    rows = [(i, f"{template} a{i} b{i}") for i in range(60)]
    assert joined(spark, rows) == brute_components(rows)
    assert paired[1] == 0


def test_components_of_chains_and_stars(spark):
    dice = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(30)] + [(300, 299)]
    dice.shuffle(edges)
    shelf = Shelf(spark, "test")
    found = components(spark.createDataFrame(edges, "u long, v long"), shelf, "c")
    want = {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)} | {300: 299}
    assert dict(found.collect()) == want
    none = spark.createDataFrame([], "u long, v long")
    assert components(none, shelf, "d").collect() == []


# Sharding


def test_small_sources_are_spread_over_buckets(spark, monkeypatch):
    """Rows of equal fraction share no bucket, and the order is that of one plain sort."""
    largest, numbered = [], sharding._numbered

    def spy(df, keys, bucket, *rest):
        largest.append(df.groupBy(bucket.alias("b")).count().agg(F.max("count")).first()[0])
        return numbered(df, keys, bucket, *rest)

    monkeypatch.setattr(sharding, "_numbered", spy)
    sources = [f"a{i}" for i in range(2000)] + [f"b{i // 2}" for i in range(800)] + ["c"] * 300
    rows = [(i, f"text {i}", s) for i, s in enumerate(sources)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = sharding.shards(df, buckets=2).withColumn(
        "h", F.pmod(F.xxhash64(F.lit(17), "doc_id", "source", "text_crc32", "size"), F.lit(1 << 32))
    )
    order = sorted(found.collect(), key=lambda r: (r.fraction, r.h, r.source, r.doc_id))
    n = len(rows)
    assert len(order) == n
    for p, r in enumerate(order):
        assert r.shard == p * 16 // n and r.slot == p - -(-r.shard * n // 16)
    assert largest[1] < n / 8


def test_shards_match_the_mixture(spark):
    rows = [(i, f"text {i}", None, "hot" if i % 3 else f"s{i % 5}", 0) for i in range(1003)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = sharding.shards(df).toPandas()
    sizes = found.groupby("shard").size()
    assert len(sizes) == 16 and sizes.max() - sizes.min() <= 1
    for _, part in found.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    mixture = found.groupby(["source", "shard"]).size().unstack(fill_value=0)
    assert ((mixture.max(axis=1) - mixture.min(axis=1)) <= 3).all()
    assert (found["size"] == [len(f"text {i}") + 1 for i in found.doc_id]).all()
    assert (found.text_crc32 == [zlib.crc32(f"text {i}".encode()) for i in found.doc_id]).all()
    order = found.sort_values(["source", "source_rank"]).doc_id.tolist()
    assert order != sorted(order)
    again = sharding.shards(df.repartition(7), buckets=3).toPandas()
    same = ["doc_id", "shard", "slot"]
    assert found[same].sort_values("doc_id").values.tolist() == again[same].sort_values("doc_id").values.tolist()
    other = sharding.shards(df, seed=18).toPandas()
    assert found[same].sort_values("doc_id").values.tolist() != other[same].sort_values("doc_id").values.tolist()


# Tokens


def library_ids(name, text):
    ids = library_tokenizer(name).encode(text or "", add_special_tokens=False).ids + [0]
    return np.array(ids, "<u4")


def test_token_files_give_back_every_document(spark, hard):
    found = registry_token_files(hard).collect()
    rows = sorted(hard_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in sorted(found, key=lambda r: r.start)] == [r[0] for r in rows]
    want = sorted(
        (str(r[0]), library_ids("byte_bpe_50k.json", r[1]).tolist()) for r in rows
    )
    assert sorted((str(r.doc_id), r.ids) for r in found) == want
    start = 0
    for r in sorted(found, key=lambda r: r.start):
        assert (r.start, r.n_tokens) == (start, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens


def test_token_counts_on_hard_rows(hard):
    found = token_counts.token_counts(hard, limit=100, chunk=200, overlap=16).collect()
    want = sorted(
        (str(d), len((t or "").encode()), n, n > 100)
        for d, t, *_ in hard_rows()
        for n in [len(sentence_tokenizer("piece_bpe_32k.model").encode(t or ""))]
    )
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in found) == want


def test_packing_places_every_piece(spark, hard):
    found = packing.pack(hard, size=64).collect()
    want = []
    for doc_id, text, *_ in hard_rows():
        ids = library_ids("word_bpe_49k.json", text)
        for k, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            want.append((str(doc_id), k, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(want)
    content: dict = {}
    for r in found:
        content.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in content.values():
        upto = 0
        for offset, length in sorted(places):
            assert offset == upto
            upto += length
        assert upto <= 64
    total = sum(r.length for r in found)
    assert len(content) <= total / 64 * 1.05 + 1


# Decontamination


def test_contamination_against_brute_force(spark, hard, benchmark):
    def cut(text):
        return ALPHANUMERIC.findall((text or "").translate(UPPER))

    items = [("" if r.item_id is None else str(r.item_id), cut(r.text)) for r in benchmark.collect()]
    want = []
    for doc_id, text, *_ in hard_rows():
        words, hit, found = cut(text), set(), set()
        for item, own in items:
            size = min(len(own), 10)
            for window in {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else ():
                for at in range(len(words) - size + 1):
                    if tuple(words[at : at + size]) == window:
                        hit.update(range(at, at + size))
                        found.add(item)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        want.append(tuple(map(str, (doc_id, len(words), len(hit), len(found), digest, bool(hit)))))
    assert plain(decontamination.contamination(hard, benchmark)) == sorted(want, key=repr)
    assert any(row[-1] == "True" for row in want) and any(row[-1] == "False" for row in want)


def test_contamination_plan_is_native(spark, hard, benchmark, monkeypatch):
    plans = []
    put = Shelf.put

    def watched(self, df, name, slim=False):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return put(self, df, name, slim)

    monkeypatch.setattr(Shelf, "put", watched)
    df = decontamination.contamination(hard, benchmark)
    plans.append(df._jdf.queryExecution().executedPlan().toString())
    assert len(plans) >= 4
    for text in plans:
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", text)


# Classifiers


def test_scores_are_defined_without_labels(hard, labels):
    for found in (toxicity.toxicity(hard, labels.limit(0)), quality_model.quality(hard, labels.limit(0))):
        assert all(r.score == 0.5 for r in found.collect())
    unknown = language.languages(hard.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in unknown.collect()} == {("und", 0.0)}


def test_held_out_rows_teach_nothing(spark, labels):
    """Turning every held-out label changes no score."""
    rows = [(i, f"{'idiot scum' if i % 2 else 'kind'} word{i % 7} and {PROSE[: i % 40]}", "en", "a", 1) for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA)

    def scores(turn, operator, column, folds, held):
        own = [
            (i, (i % 2) ^ (turn and zlib.crc32(str(i).encode()) % folds == held))
            for i in range(120)
        ]
        la = spark.createDataFrame([(i, int(v)) for i, v in own], f"doc_id long, {column} int")
        return plain(operator(df, la))

    for operator, column, folds, held in (
        (toxicity.toxicity, "toxic", 3, 1), (quality_model.quality, "quality", 5, 0),
    ):
        first = scores(False, operator, column, folds, held)
        assert first == scores(True, operator, column, folds, held)
        assert {row[1] for row in first} == {"True", "False"}
    changed = df.withColumn(
        "lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "zz").otherwise(F.col("lang"))
    )
    assert plain(language.languages(df)) == plain(language.languages(changed))


SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def truth(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    return docs, {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}


def test_classifiers_on_the_given_tables(spark, truth):
    docs, marks = truth
    quality = {r.doc_id: r for r in registry.op5_quality(spark, SMALL).collect()}
    toxic = {r.doc_id: r for r in registry.op3_toxicity(spark, SMALL).collect()}
    tongue = registry.op8_language(spark, SMALL).collect()
    assert len(quality) == len(toxic) == len(tongue) == len(docs)
    for found, column in ((quality, "quality"), (toxic, "toxic")):
        held = [(r.predicted, marks[d][column]) for d, r in found.items() if r.held_out and d in marks]
        assert sum(a == b for a, b in held) >= 0.9 * len(held)
        assert all(0 <= r.score <= 1 for r in found.values())
    assert not any(r.predicted for d, r in toxic.items() if d in marks and not marks[d].toxic)
    held = [r for r in tongue if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)


# Pipeline


def test_stages_keep_columns_and_do_their_work(spark, hard, benchmark, tmp_path):
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    folder = str(tmp_path)
    for docs in (hard, hard.limit(0), clashing(spark, hard_rows())):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, folder).columns == docs.columns
        assert plain(corpus_pipeline.drop_toxic(spark, docs, folder)) == plain(docs)
    kept = corpus_pipeline.drop_near_copies(spark, hard, folder).collect()
    rows = [(a, b) for a, b, *_ in hard_rows()]
    parts = brute_components(rows)
    wordless = sum(row[1] == "0" for row in parts)
    # The two texts of id 9 are groups of their own that bear one name.
    assert len(kept) == wordless + len({row[2] for row in parts if row[1] != "0"}) + 1
    assert sorted(r.doc_id for r in kept if r.text and PROSE.split()[1] in r.text.lower()) == [5, 9]
    clean = corpus_pipeline.drop_contaminated(spark, hard, folder)
    marked = decontamination.contamination(hard, benchmark).where("NOT contaminated")
    assert plain(clean.select("doc_id")) == plain(marked.select("doc_id"))
    good = corpus_pipeline.drop_low_quality(spark, hard, folder)
    judged = quality_rules.quality_rules(hard).where("kept")
    assert plain(good.select("doc_id")) == plain(judged.select("doc_id"))


def test_pipeline_against_its_operators(spark, truth):
    """run() gives what the stages' decisions, taken one by one on plain lists, leave."""
    docs, _ = truth
    whole = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = toxicity.fit_on(whole, spark.read.parquet(f"{SMALL}/labels.parquet"), F.lit(True))
    scores = whole.select("doc_id", toxicity.score(model, "text").alias("s")).collect()
    left = [r.doc_id for r in scores if r.s < corpus_pipeline.TOXIC]
    verdicts = {r.doc_id: r.kept for r in registry.op6_quality_rules(spark, SMALL).collect()}
    left = sorted(d for d in left if verdicts[d])
    parts = brute_components([(d, docs[d].text) for d in left])
    left = {int(row[0]) for row in parts if row[0] == row[2]}
    dirty = {r.doc_id for r in registry.op7_decontamination(spark, SMALL).collect() if r.contaminated}
    packed = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in packed} == left - dirty
    assert len(packed) == sum(
        -(-len(library_ids("word_bpe_49k.json", docs[d].text)) // 2048) for d in left - dirty
    )


def swapped(steps):
    """Two words of 2**steps letters that every polynomial hash modulo 2**64 confuses from 10 steps on."""
    a, b = "a", "b"
    for _ in range(steps):
        a, b = a + b, b + a
    return a, b


@pytest.mark.parametrize("steps", [10, 12])
def test_texts_with_equal_polynomials_are_told_apart(spark, steps):
    one, other = swapped(steps)
    words = " ".join(f"w{i}" for i in range(30))
    rows = [(1, one), (2, other), (3, f"{words}\n{one} x\n{other} x"), (4, f"{words}\n{one} x\n{one} x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    joined = {r.doc_id: r.component_id for r in ngram_join.ngram_join(docs).collect()}
    assert joined[1] == 1 and joined[2] == 2
    rules = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    assert rules[3].n_dup_lines == 0 and rules[4].n_dup_lines == 1
    ids = {r.doc_id: zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in registry_token_files(docs).collect()}
    packed = [r for r in packing.pack(docs).collect() if r.piece == 0]
    for doc_id, text in rows:
        assert ids[doc_id] == zlib.crc32(np.array(library_ids("byte_bpe_50k.json", text), "<u4").tobytes())
        some = library_ids("word_bpe_49k.json", text)[:2048]
        mine = next(r for r in packed if r.doc_id == doc_id)
        assert mine.ids_crc32 == zlib.crc32(np.array(some, "<u4").tobytes())
