"""Near duplicates, repeated passages, top-k search and the pipeline against brute force."""

import math
import os
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tempoloom.llm import cdc, graph, neardup, topk
from tempoloom.llm.common import code_points
from tempoloom.llm.pii import Pseudonyms, session_key
from tempoloom.llm.q_cdc import op3_chunk_dedup
from tempoloom.llm.q_neardup import op2_bag_minhash_dedup
from tempoloom.llm.q_topk import SQL, op5_exact_top_k

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _words(rng, n):
    return ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 8))) for _ in range(n)]


def _corpus(seed=0):
    """Texts with groups of copies, chains of edits, short and empty ones; passages that texts share."""
    rng = random.Random(seed)
    out = [None, "", " ", "one two", "one two", "one  two", "one two three four"]
    for _ in range(12):
        base = _words(rng, rng.randrange(30, 200))
        for _ in range(rng.randrange(1, 9)):
            base = list(base)
            for _ in range(rng.randrange(0, 3)):
                base[rng.randrange(len(base))] = _words(rng, 1)[0]
            out.append(" ".join(base))
        out.append(" ".join(base[: len(base) * 9 // 10]))
    return out


def _classes(texts):
    """Components of all pairs of texts with a likeness of 0.8."""
    own = {i: neardup.shingles(t or "") for i, t in texts.items()}
    up = {i: i for i in texts}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in texts:
        for j in texts:
            if i < j and neardup.overlap(own[i], own[j]) >= 0.8:
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return {i: top(i) for i in texts}


def _table(spark, texts):
    return spark.createDataFrame([(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in texts.items()], DOCS)


@pytest.mark.parametrize("seed", [0, 1])
def test_classes_equal_all_pairs(spark, seed):
    texts = dict(enumerate(_corpus(seed)))
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(_table(spark, texts).repartition(5)).collect()}
    assert got == _classes(texts)


def test_a_large_group_is_one_class(spark):
    rng = random.Random(7)
    base = _words(rng, 120)
    texts = {}
    for i in range(900):
        own = list(base)
        own[rng.randrange(120)] = f"edit{i % 700}"
        texts[i] = " ".join(own)
    got = neardup.near_duplicates(_table(spark, texts))
    assert got.count() == 900 and got.select("class_id").distinct().count() == 1


def test_pairs_within_a_template_group(spark):
    """Texts of one template that are alike to 0.75, some pairs of them to 0.8 and more, as none of the leaders is."""
    rng = random.Random(21)
    template, texts = _words(rng, 300), {}
    for i in range(0, 240, 2):
        own = template + [f"own{i}x{j}" for j in range(50)]
        texts[i] = " ".join(own)
        texts[i + 1] = " ".join(own[:-37] + [f"other{i}x{j}" for j in range(37)]) if i % 3 == 0 else " ".join(template + [f"own{i + 1}x{j}" for j in range(50)])
    own = [neardup.shingles(texts[i]) for i in (0, 1, 2, 3)]
    assert 0.8 <= neardup.overlap(own[0], own[1]) < 0.82 and max(neardup.overlap(own[0], own[2]), neardup.overlap(own[2], own[3])) < 0.77
    order = list(texts)
    rng.shuffle(order)
    texts = dict(zip(order, texts.values(), strict=True))
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(_table(spark, texts)).collect()}
    assert got == _classes(texts) and len(set(got.values())) == 200


def test_texts_alike_to_one_member_of_a_large_class(spark):
    """Copies of one text with edits, and for some of them a text that is alike to that copy only."""
    rng = random.Random(22)
    base, texts, strangers = _words(rng, 300), {0: None}, set()
    texts[0] = " ".join(base)
    for i in range(1, 120):
        copy = base[:8] + [f"own{i}x{j}" for j in range(26)] + base[34:]
        texts[2 * i] = " ".join(copy)
        if i % 4 == 0:
            texts[2 * i + 1] = " ".join(copy[:200] + [f"other{i}x{j}" for j in range(26)] + copy[226:])
            strangers.add(2 * i + 1)
    own = [neardup.shingles(texts[i]) for i in (0, 8, 9)]
    assert min(neardup.overlap(own[0], own[1]), neardup.overlap(own[1], own[2])) >= 0.8 and neardup.overlap(own[0], own[2]) < 0.7
    order = rng.sample(range(1000), len(texts))
    texts = dict(zip(order, texts.values(), strict=True))
    want = _classes(texts)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(_table(spark, texts)).collect()}
    assert got == want and max(list(want.values()).count(c) for c in set(want.values())) > neardup.LARGE


def test_leaders_meet_each_other_once(spark):
    """Of n texts of a bucket that all lead, n * (n - 1) / 2 pairs are made; with some that don't, each of these meets all leaders."""
    schema = "band long, id long, n long, hosts array<long>, class long, leads boolean"
    rows = [(1, i, 10, [], i, True) for i in range(20)] + [(2, i, 10, [], i, i < 35) for i in range(30, 42)]
    members = spark.createDataFrame(rows, schema)
    got = [tuple(r) for r in neardup.beside_leaders(members, 0.8).collect()]
    want = {(i, k) for i in range(20) for k in range(i)} | {(30 + i, 30 + k) for i in range(12) for k in range(min(i, 5))}
    assert len(got) == 190 + 10 + 35 and {(max(p), min(p)) for p in got} == {(max(p), min(p)) for p in want}
    assert neardup.further_pairs(members, spark.createDataFrame([], "id long, lead long"), 0.8).count() == 235


@settings(max_examples=200, deadline=None)
@given(text=st.text(alphabet="ab \n\t\u00a0\u3000\u3001\x1fé東😀", max_size=60))
def test_words_have_hashes_of_their_own(text):
    from tempoloom.llm.common import word_hashes

    words, hashes = text.split(), word_hashes(text).tolist()
    assert len(words) == len(hashes) and len(set(words)) == len(set(hashes)) == len(set(zip(words, hashes, strict=True)))
    assert word_hashes(" ".join(words)).tolist() == hashes


def test_blocks_compare_as_pairs_do():
    rng = random.Random(23)
    texts = [" ".join(rng.choices("abcde", k=rng.randrange(1, 40))) for _ in range(60)]
    from tempoloom.llm.common import shingle_hashes, word_hashes

    own = [np.unique(shingle_hashes(word_hashes(t), 2), return_counts=True) for t in texts]
    block = neardup.Block()
    for i in range(30):
        block.add(i, i // 3, *own[i])
    for j in range(30, 60):
        like = {i for i in range(30) if neardup.overlap(neardup.shingles(texts[i], 2), neardup.shingles(texts[j], 2)) >= 0.3}
        got = block.alike(2, *own[j], 0.3)
        assert set(got) <= like and {i // 3 for i in got} == {i // 3 for i in like} - {2} and len(got) == len({i // 3 for i in got})
    assert neardup.Block().alike(0, *own[0], 0.3) == []


def test_columns_of_any_name(spark):
    df = spark.createDataFrame([(i, f"words that number {i // 2} has of its own", i, i, i, i, i) for i in range(8)], "doc_id long, text string, _kept long, k long, h long, c0 long, id long")
    out = neardup.without_near_duplicates(df)
    assert out.schema == df.schema and sorted(r.doc_id for r in out.collect()) == [0, 2, 4, 6]
    # of rows with one key and several texts the same one stays, however the rows lie
    df = spark.createDataFrame([(1, "one text of these"), (1, "another text of those"), (2, "a third")], "doc_id long, text string")
    assert len({tuple(sorted(map(tuple, neardup.without_near_duplicates(d).collect()))) for d in (df, df.repartition(3), df.orderBy("text"))}) == 1


def test_one_document_of_each_class_stays(spark):
    texts = dict(enumerate(_corpus(2)))
    df = _table(spark, texts)
    df = df.union(df.where("doc_id = 9")).union(df.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long")))
    out = neardup.without_near_duplicates(df)
    assert out.columns == df.columns
    ids = [r.doc_id for r in out.collect()]
    assert ids.count(None) == 1 and sorted(i for i in ids if i is not None) == sorted(set(_classes(texts).values()))
    assert neardup.near_duplicates(df.limit(0)).count() == 0 and neardup.without_near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)]
    up = {}
    for e in edges:
        for x in e:
            up.setdefault(x, x)

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: top(x) for x in linked}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_written_tables_last_as_long_as_they_should(spark):
    from pathlib import Path

    from tempoloom.llm import common

    before = common.written(spark.range(2), "own")
    with common.temporary(spark):
        inside = common.written(spark.range(3), "own")
        with common.kept():
            result = common.written(inside, "own")
        assert all(Path(t._written_to).is_dir() for t in (before, inside, result))
    assert Path(before._written_to).is_dir() and not Path(inside._written_to).exists() and result.count() == 3
    common.discard(before, result)
    assert not Path(before._written_to).exists() and not Path(result._written_to).exists()


def test_small_tables_are_few_files(spark):
    """Tables of a few rows are written in no more files than there are cores, larger ones in as many as their rows fill."""
    from pathlib import Path

    from tempoloom.llm import common

    files = lambda path: len(list(Path(path).glob("part-*.parquet")))
    many, cores = spark.range(200).repartition(50), spark.sparkContext.defaultParallelism
    for rows, want in ((0, cores), (200, cores), (10 * common.ROWS_A_FILE, 10), (10**9, 50), (None, 50)):
        table = common.written(many, "own", rows)
        assert files(table._written_to) == want and table.count() == 200
    texts = [" ".join(_words(random.Random(i // 3), 40)) for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    made = []
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        with common.temporary(spark):
            got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
            made = [(Path(p).name.split("-")[0], files(p)) for p in common._MADE.get() if Path(p).is_dir()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: i - i % 3 for i in range(300)}
    assert {"same", "many", "shared", "members", "classes"} <= {name for name, _ in made}
    assert all(n <= cores for name, n in made if name != "links"), made


# ---- substring dedup ---------------------------------------------------------------


def _gear(text):
    """The rolling hash one code point at a time."""
    h, hashes = 0, []
    for c in text:
        h = ((h << 1) + int(cdc._GEAR[ord(c) & 255]) + (((ord(c) >> 8) * int(cdc._HIGH) & 0xFFFFFFFF) >> 16)) & 0xFFFF
        hashes.append(h)
    out = []
    for i, h in enumerate(hashes):
        before, after = hashes[max(0, i - cdc.RADIUS) : i], hashes[i + 1 : i + 1 + cdc.RADIUS]
        if h > max(before, default=0) and h >= max(after, default=0):
            out.append(i + 1)
    return out if out and out[-1] == len(text) else [*out, len(text)]


@pytest.mark.parametrize("text", ["a", "abc" * 50, " ".join(_words(random.Random(5), 400)), "naïve 東京 😀 " * 40])
def test_boundaries_equal_the_rolling_hash(text):
    got, want = cdc.cut_points(code_points(text)), _gear(text)
    assert set(want) <= set(got) and (got == want or max(np.diff([0, *want])) > 8 * cdc.RADIUS)
    assert got[-1] == len(text) and max(np.diff([0, *got])) <= cdc.LONGEST and cdc.cut_points(code_points("")) == []


def test_boundaries_resist_insertions():
    text = " ".join(_words(random.Random(6), 500))
    a, b = set(cdc.cut_points(code_points(text))), {x - 7 for x in cdc.cut_points(code_points(text[:1000] + "INSERT " + text[1000:]))}
    assert not [x for x in a if x > 1040 and x not in b]


def _passages(seed=0):
    rng = random.Random(seed)
    shared = [_words(rng, n) for n in (51, 60, 90, 200)]
    short = _words(rng, 20)
    texts = {}
    for i in range(40):
        parts = [*rng.sample(shared, rng.randrange(0, 3)), short]
        rng.shuffle(parts)
        own = _words(rng, rng.randrange(10, 100))
        for p in parts:
            own += [*p, *_words(rng, rng.randrange(10, 60))]
        texts[i] = " ".join(own)
    return texts, [" ".join(p) for p in shared], " ".join(short)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_passages_stay_only_where_they_are_first(spark, seed):
    texts, shared, short = _passages(seed)
    df = _table(spark, texts)
    spans = cdc.repeated_spans(df)
    found = defaultdict(list)
    for r in spans.collect():
        found[r.id].append((r.start, r.end))
        assert texts[r.id][r.start : r.end] and r.words >= 50
    for p in shared:
        have = [i for i in sorted(texts) if p in texts[i]]
        for i in have[1:]:
            s = texts[i].index(p)
            assert any(a <= s and s + len(p) <= b for a, b in found[i]), (i, p)
    cut = {r.doc_id: r for r in cdc.without_spans(df, spans).collect()}
    for p in shared:
        assert sum(p in r.text for r in cut.values()) <= 1
    for i, t in texts.items():
        if not any(p in t for p in shared):
            assert cut[i].text == t
        assert cut[i].n_chars == len(cut[i].text)
    assert sum(short in r.text for r in cut.values()) > 30


def test_a_passage_with_one_word_changed(spark):
    """Of three documents, the first has another word in the middle of the passage that the other two share."""
    rng = random.Random(31)
    texts, want = {}, {}
    for i in range(0, 120, 3):
        before, after = " ".join(_words(rng, 60)), " ".join(_words(rng, 60))
        for j, year in enumerate(("2023", "2024", "2024")):
            texts[i + j] = " ".join([*_words(rng, 30), before, year, after, *_words(rng, 30)])
            want[i + j] = [before, after] if j == 1 else [f"{before} 2024 {after}"] if j == 2 else []
    found = defaultdict(list)
    for r in cdc.repeated_spans(_table(spark, texts)).collect():
        found[r.id].append(texts[r.id][r.start : r.end])
    for i, passages in want.items():
        assert bool(found[i]) == bool(passages) and all(any(p in f for f in found[i]) for p in passages), i


def test_short_lines_that_touch_are_no_passage(spark):
    rng = random.Random(12)
    lines = [" ".join(_words(rng, 20)) for _ in range(6)]
    texts = {i: " ".join([*_words(rng, 60), line, *_words(rng, 60)]) for i, line in enumerate(lines)}
    texts[9] = " ".join([*_words(rng, 30), *lines, *_words(rng, 30)])
    assert cdc.repeated_spans(_table(spark, texts)).count() == 0


def test_runs_of_one_word_are_repeats_too(spark):
    rng = random.Random(11)
    texts = {i: " ".join([*_words(rng, 40 + i), *["and"] * (80 + 7 * i), *_words(rng, 30)]) for i in range(5)}
    spans = cdc.repeated_spans(_table(spark, texts))
    cut = {r.doc_id: r.text for r in cdc.without_spans(_table(spark, texts), spans).collect()}
    assert all(cut[i].count(" and") < 40 for i in range(1, 5))


def test_edge_cases_of_repeats(spark):
    long = " ".join(_words(random.Random(9), 4000))
    df = spark.createDataFrame([(1, None), (2, ""), (3, long), (4, "x" + long), (4, "x" + long), (None, long), (5, "a" * 5000), (6, "日本" * 100)], "doc_id long, text string").withColumn("start", F.lit(1)).withColumn("id", F.lit("clash"))
    spans = cdc.repeated_spans(df)
    assert {r.id for r in spans.collect()} <= {4, 5, 6} and 4 in {r.id for r in spans.collect()}
    out = cdc.without_spans(df, spans)
    assert out.columns == df.columns and out.count() == 8
    assert cdc.repeated_spans(df.limit(0)).count() == 0 and cdc.without_spans(df.limit(0), cdc.repeated_spans(df.limit(0))).count() == 0


def _all_repeats(texts, words=50):
    """By brute force: for each document the places of its text, as booleans, that lie in passages of enough words which stand before, in texts of smaller keys or sooner in its own."""
    seen, out = {}, {}
    for i in sorted(texts):
        t = texts[i]
        begins = [k for k in range(len(t)) if not t[k].isspace() and (not k or t[k - 1].isspace())] + [len(t) + 1]
        covered = np.zeros(len(t), dtype=bool)
        for a, b in zip(begins, begins[words:], strict=False):
            window = t[a : b - 1].rstrip()
            if seen.get(window, (i, a)) < (i, a):
                covered[a : a + len(window)] = True
            seen.setdefault(window, (i, a))
        out[i] = covered
    return out


def _covered(spans, texts):
    out = {i: np.zeros(len(t), dtype=bool) for i, t in texts.items()}
    for r in spans:
        out[r.id][r.start : r.end] = True
    return out


def test_a_passage_whose_parts_are_first_elsewhere(spark):
    """The first documents hold a part each, so that no chunk is first in the one that holds the whole."""
    rng = random.Random(41)
    texts, want = {}, []
    for n, (i, cut) in enumerate([(60, (35, 25)), (80, (40, 40)), (80, (27, 54)), (200, (49, 49)), (56, (30, 20)), (120, (10, 100))]):
        passage = _words(rng, i)
        around = lambda words: " ".join([*_words(rng, 30), *words, *_words(rng, 30)])  # noqa: B023, E731
        texts[10 * n] = around(passage[: cut[0]])
        texts[10 * n + 1] = around(passage[cut[1] :])
        texts[10 * n + 5], texts[10 * n + 7] = around(passage), around(passage)
        want.append((10 * n + 7, " ".join(passage)))
    found = _covered(cdc.repeated_spans(_table(spark, texts)).collect(), texts)
    for i, p in want:
        at = texts[i].index(p)
        assert found[i][at : at + len(p)].all(), i


def test_short_words_and_scripts_without_spaces(spark):
    rng = random.Random(42)
    texts = {}
    for n in range(12):
        passage = " ".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=55))
        for k in range(2):
            texts[10 * n + k] = " ".join([*_words(rng, 30), passage, *_words(rng, 30)])
    han = "".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(2000))
    texts |= {200: han, 201: "前" + han[500:900] + "後", 202: han[:40]}
    spans = {r.id: r for r in cdc.repeated_spans(_table(spark, texts)).collect()}
    # 109 code points may hold no whole chunk that is in step
    assert len(spans.keys() & {10 * n + 1 for n in range(12)}) >= 11 and 202 not in spans
    assert (spans[201].start, spans[201].end, spans[201].words, spans[201].first_id) == (1, 401, 400, 200)
    assert cdc.word_begins(code_points(" one  two三四 five\n")).tolist()[-1] == 5


@pytest.mark.parametrize("seed", [0, 1])
def test_all_repeats_are_found(spark, seed):
    """Texts put together of sentences, some of them quoted in parts, against all windows of 50 words."""
    rng = random.Random(100 + seed)
    sentences = [_words(rng, rng.randrange(8, 40)) for _ in range(60)]
    texts = {}
    for i in range(80):
        own = []
        for _ in range(rng.randrange(1, 7)):
            k = rng.randrange(len(sentences))
            for s in sentences[k : k + rng.randrange(1, 5)]:
                own += s if rng.random() < 0.9 else s[: len(s) // 2]
            own += _words(rng, rng.randrange(0, 20))
        texts[i] = " ".join(own)
    want = _all_repeats(texts)
    got = _covered(cdc.repeated_spans(_table(spark, texts)).collect(), texts)
    missed = sum(int((want[i] & ~got[i]).sum()) for i in texts)
    assert missed <= 0.005 * sum(int(w.sum()) for w in want.values())
    # beside words cut at the ends, nothing else is taken
    assert all((got[i] & ~want[i]).sum() <= 20 * max(1, (np.diff(got[i].astype(int)) == 1).sum() + 1) for i in texts)


def test_rows_that_share_a_key_only(spark):
    rng = random.Random(43)
    a, b = " ".join(_words(rng, 120)), " ".join(_words(rng, 130))
    df = spark.createDataFrame([(1, a), (2, b), (3, a + " end"), (3, "x " + b), (3, "x " + b), (4, b)], "doc_id long, text string").withColumn("u", F.lit(1)).withColumn("_cut_id", F.lit(2)).withColumn("c0", F.lit(3)).withColumn("cut", F.lit(4))
    spans = cdc.repeated_spans(df)
    out = sorted((r.doc_id, r.text) for r in cdc.without_spans(df, spans).collect())
    # what is left of a text is its own part, and at most what its first words share with the other's
    assert len(out) == 6 and all(len(t) <= 8 for i, t in out[2:]) and out[:2] == [(1, a), (2, b)]
    assert cdc.without_spans(df, spans).columns == df.columns


def test_a_long_text_that_repeats_itself(spark):
    text = "again and " * 100_000
    spans = cdc.repeated_spans(spark.createDataFrame([(1, text), (2, "other")], "doc_id long, text string")).collect()
    assert _covered(spans, {1: text})[1].mean() > 0.99


# ---- search ---------------------------------------------------------------------------


def _vectors(n=400, dim=20, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x[50:200] = x[50]  # a very common vector: ties go to the smaller id
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows[3] = (3, None)
    rows[4] = (4, [float("nan")] * dim)
    rows[5] = (5, [None] * dim)
    rows[6] = (6, [float("inf")] * dim)
    rows[7] = (7, [1.0] * 3)
    return rows


def test_top_k_equals_all_scores(spark):
    rows = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = defaultdict(list)
    for r in topk.top_k(df.where("vec_id % 50 = 0"), df, 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    good = {i: np.floor(256 * np.array(v)).astype(int) for i, v in rows if v and len(v) == 20 and all(a is not None and np.isfinite(a) for a in v)}
    for q in range(0, 400, 50):
        best = sorted(((-int(good[q] @ good[i]), i) for i in good if i != q))[:5]
        assert got[q] == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]


def test_fewer_candidates_than_k_and_none(spark):
    df = spark.createDataFrame([(0, [0.5, 1.0]), (1, [1.0, 2.0]), (2, [-1.0, 0.1])], "vec_id long, embedding array<double>")
    assert topk.top_k(df.where("vec_id = 0"), df, 5).count() == 2
    assert topk.top_k(df.limit(0), df, 5).count() == 0 and topk.top_k(df, df.limit(0), 5).count() == 0


def test_bounds_are_bounds():
    rng = np.random.default_rng(1)
    q, x = rng.normal(size=(30, 37)), rng.normal(size=(50, 37))
    exact = q @ x.T
    last = None
    for s in topk.SEGMENTS:
        bound = topk.statistics(q, s) @ topk.statistics(x, s).T
        assert (bound >= exact - 1e-9).all()
        last = bound if last is None else np.minimum(last, bound)
    assert last.mean() < (topk.statistics(q, 1) @ topk.statistics(x, 1).T).mean()


@pytest.mark.parametrize("scale", [1.0, 2.0**20, 2.0**27])
def test_cells_hold_many_blocks(spark, monkeypatch, scale):
    """Small blocks and cells, ids that several rows share, and scores beyond doubles."""
    monkeypatch.setattr(topk, "BLOCK", 7)
    monkeypatch.setattr(topk, "HELD", 2)
    rng = np.random.default_rng(5)
    rows = [(i % 180, (rng.integers(-5, 6, size=4 + i % 3) * 0.5).tolist()) for i in range(200)]
    df = spark.createDataFrame([*rows, (0, None), (10, [None] * 4), (50, []), (None, [1.0] * 4)], "vec_id long, embedding array<double>").repartition(5)
    got = defaultdict(list)
    for r in topk.top_k(df.where("vec_id % 10 = 0"), df, 3, scale=scale).orderBy("query_id", "rank").collect():
        got[r.query_id].append((-r.score, r.vec_id))
    whole = [(i, [math.floor(scale * a) for a in v]) for i, v in rows]
    for q in range(0, 180, 10):
        own = min((v for i, v in rows if i == q))
        own = [math.floor(scale * a) for a in own]
        assert got[q] == sorted((-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in whole if i != q and len(v) == len(own))[:3]


def test_thresholds_drop_pairs():
    """Vectors in clusters, whose segments differ: most pairs need no exact score."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(20, 32)).repeat(2, axis=1)
    x = np.floor(256 * np.repeat(centres, 50, axis=0) + 8 * rng.normal(size=(1000, 64)))
    block = topk.Block(np.arange(1000), x, [topk.statistics(x, s) for s in topk.SEGMENTS], np.linalg.norm(x, axis=1))
    best = topk.Best(block.of(slice(0, 1000, 50)), 5)
    best.meet(block)
    first, before = best.exact, best.pairs
    best.meet(block)
    assert first == 20 * 999 and best.exact - first < 0.2 * (best.pairs - before)


# ---- queries on the test tables, and the pipeline -----------------------------------------

DATA = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@tables
def test_search_query_equals_its_sql(spark):
    import duckdb

    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{DATA}/embeddings.parquet'")
    want = sorted(c.execute(SQL["op5_exact_top_k"]).fetchall())
    assert sorted(tuple(r) for r in op5_exact_top_k(spark, DATA).select("query_id", "rank", "vec_id", "score").collect()) == want


@tables
def test_dedup_query_equals_all_pairs(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert {r.doc_id: r.class_id for r in op2_bag_minhash_dedup(spark, DATA).collect()} == _classes(texts)


@tables
def test_repeats_query(spark):
    """Against all windows of 50 words of the test table."""
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = op3_chunk_dedup(spark, DATA).withColumnRenamed("doc_id", "id").collect()
    want, got = _all_repeats(texts), _covered(rows, texts)
    missed = {i: int((want[i] & ~got[i]).sum()) for i in texts}
    # only within a word that is repeated without end may something stay
    endless = {i for i, t in texts.items() if re.search(r"(\S+ )\1{9}", t)}
    assert all(not n or i in endless for i, n in missed.items())
    assert sum(missed.values()) <= 0.01 * sum(int(w.sum()) for w in want.values())
    for r in rows:
        assert r.words >= 50 and texts[r.id][r.start : r.end] in texts[r.first_doc_id] and r.first_doc_id <= r.id


def test_pipeline(spark, tmp_path):
    """The five stages on a small corpus with planted cases, against plain versions of them."""
    rng = random.Random(3)
    passage = " ".join(_words(rng, 70))
    rows, good = [], set()
    for i in range(150):
        words = _words(rng, rng.randrange(60, 160))
        if i % 5 == 0:
            text = " ".join(w.upper() + "!!" for w in words)
        else:
            text = " ".join(words)
            good.add(i)
        rows.append([i, text, "en", f"s{i % 3}", 0])
    rows[21][1] = rows[11][1]  # an exact copy
    rows[31][1] = rows[12][1] + " more"  # a near copy
    for i in (13, 23, 33):
        rows[i][1] += f" {passage} end"
    rows[14][1] += " write to jo.doe@example.org or 10.1.2.3"
    for r in rows:
        r[4] = len(r[1])
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i in good), 0) for i in range(100)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    columns = docs.columns
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        seen.append({r.doc_id: r for r in docs.collect()} if number < 4 else docs.collect())
        assert number == 4 or docs.columns == columns
    assert set(seen[0]) == good
    assert set(seen[0]) - set(seen[1]) == {21, 31}
    assert set(seen[2]) == set(seen[1]) and [i for i in (13, 23, 33) if passage in seen[2][i].text] == [13]
    changed = {i for i in seen[2] if seen[2][i].text != seen[1][i].text}
    assert changed == {23, 33}
    own = Pseudonyms(session_key(spark))
    assert {i for i in seen[3] if seen[3][i].text != seen[2][i].text} == {14} and seen[3][14].text == own(seen[2][14].text) and "10.1.2.3" not in seen[3][14].text
    lengths = defaultdict(int)
    for r in seen[4]:
        lengths[r.doc_id] += r.length
    assert set(lengths) == set(seen[3]) and all(r.doc_tokens == lengths[r.doc_id] for r in seen[4])
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "start", "length").collect())) != []


def test_pipeline_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    rng = random.Random(3)
    names = "_id long, _kept long, _cut_id long, c0 long, id long, u long, band long, bucket long"
    rows = [(i, " ".join(_words(rng, 30)), "en", "s", 9, *range(8)) for i in range(12)] + [(None, None, None, None, None, *range(8))] * 2
    spark.createDataFrame(rows, f"{DOCS}, {names}").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(5)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.schema == docs.schema and out.count() == 14
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {*range(12), None}


def test_long_near_copies_are_one_class(spark):
    words = _words(random.Random(4), 150_000)
    texts = {1: " ".join(words), 2: " ".join([*words[:70_000], "edited", *words[70_001:]]), 3: " ".join(words[:100_000])}
    assert {r.doc_id: r.class_id for r in neardup.near_duplicates(_table(spark, texts)).collect()} == {1: 1, 2: 1, 3: 3}


def test_entry_without_the_tokenizers():
    """What llm needs may be absent: the other queries are there all the same."""
    import subprocess
    import sys
    from pathlib import Path

    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and not [n for n in q if n.startswith('op') and n[2].isdigit()] and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2], check=True, timeout=300)
