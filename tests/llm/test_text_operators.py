"""Small tests of the operators on texts, against libraries and brute force."""

import datetime
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tempoloom.llm import bpe, cotrain, orderminhash, packing, pii, secrets, tokencounts
from tempoloom.llm.bagminhash import bag_minhash
from tempoloom.llm.common import code_points, seeds
from tempoloom.llm.q_bpe import op4_bpe_round_trip
from tempoloom.llm.q_fingerprints import op1_order_minhash
from tempoloom.llm.q_packing import op10_harmonic_packing, packed
from tempoloom.llm.q_pii import op9_pii_pseudonyms
from tempoloom.llm.q_quality import op6_co_training
from tempoloom.llm.q_secrets import op8_secret_scan
from tempoloom.llm.q_tokens import op7_token_counts

#: Texts with what may go wrong: null, empty, blank, long, other scripts, special strings, ties and repeats.
TEXTS = [None, "", " ", "a", "word " * 40, "x" * 3000, "naïve café – 東京 😀\n\n  end", "it's we'll <|endoftext|> they've", "\t\n\r \x00 mixed\x0b", "The same text. " * 30, "The same text. " * 30, "١٢٣ 456 ½", "a" * 50 + " " * 70 + "b"]


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    """A folder with documents (and an extra column that operators use inside, too), labels, and empty tables beside it."""
    rng = random.Random(1)
    words = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "eta", "theta"]
    rows = [(i, t, "en", "s0", len(t or ""), "x") for i, t in enumerate(TEXTS)]
    for i in range(len(TEXTS), 180):
        good = i % 3 > 0
        text = " ".join(rng.choice(words) + rng.choice(["", ",", "."]) if good else rng.choice(words).upper() + "!!" for _ in range(rng.randrange(5, 400)))
        rows.append((i, text, rng.choice(["en", "de"]), f"s{i % 4}", len(text), "y"))
    root = tmp_path_factory.mktemp("tables")
    schema = "doc_id long, text string, lang string, source string, n_chars long, digest string"
    df = spark.createDataFrame(rows, schema)
    df.repartition(3).write.parquet(f"{root}/full/documents.parquet")
    df.limit(0).write.parquet(f"{root}/empty/documents.parquet")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(len(TEXTS), 120)] + [(None, 1, 0), (999, None, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{root}/full/labels.parquet")
    labels.limit(0).write.parquet(f"{root}/empty/labels.parquet")
    return f"{root}/full", f"{root}/empty", {r[0]: r[1] or "" for r in rows}


QUERIES = [op1_order_minhash, op4_bpe_round_trip, op6_co_training, op7_token_counts, op8_secret_scan, op9_pii_pseudonyms, op10_harmonic_packing]


@pytest.mark.parametrize("query", QUERIES)
def test_an_empty_table_gives_an_empty_table(spark, documents, query):
    assert query(spark, documents[1]).count() == 0


def test_null_keys_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, "a b", "e", "s", 3), (1, "a b", None, None, None), (1, "a b", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    assert orderminhash.fingerprints(df).select("fingerprint").distinct().count() == 1
    assert orderminhash.edit_sensitivity(df).count() == 3
    assert tokencounts.token_counts(df, public_tokenizers.path("byte_bpe_50k.json")).count() == 3
    assert secrets.secret_spans(df).count() == 3 and pii.pseudonymised(df, b"key").count() == 3
    assert sorted(r.n for r in packed(df).groupBy("doc_id").agg({"length": "sum"}).toDF("doc_id", "n").collect()) == [3, 6]
    model = cotrain.co_train((np.zeros((0, 1)),) * 2, np.zeros(0), None)
    assert cotrain.scored(df, model).where("keep").count() == 3 and cotrain.accepted(df, model).schema == df.schema


# ---- 1 ------------------------------------------------------------------------


def test_fingerprints_follow_the_definition(spark, documents):
    _, _, texts = documents
    got = {r.doc_id: r for r in op1_order_minhash(spark, documents[0]).collect()}
    ids = sorted(texts)
    for i, k in enumerate(ids):
        own, after = texts[k], texts[ids[(i + 1) % len(ids)]]
        edited = own[: len(own) - len(own) // 2] + after[: len(own) // 2]
        r = got[k]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        prints = [orderminhash.order_minhash(code_points(t)) for t in (own, edited, after)]
        assert r.fingerprint == orderminhash.text_of_fingerprint(prints[0]) and r.near_edited == orderminhash.likeness(*prints[:2]) and r.near_next == orderminhash.likeness(prints[0], prints[2])
    assert got[9].fingerprint == got[10].fingerprint and got[9].near_next == 1.0


def _plain_order_minhash(text, k, l, m):  # noqa: E741
    """The definition, one step at a time."""
    mask, step = 2**64 - 1, 0x9E3779B97F4A7C15

    def mix(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
        return x ^ (x >> 31)

    points = [ord(c) for c in text]
    k = min(k, len(points))
    kmers = []
    for i in range(len(points) - k + 1):
        h = 0
        for c in points[i : i + k]:
            h = (h * 0x100000001B3 + c) & mask
        kmers.append(mix(h))
    seen, numbered = Counter(), []
    for h in kmers:
        numbered.append(mix((h + (seen[h] + 1) * step) & mask) >> 32)
        seen[h] += 1
    salts = [int(x) for x in seeds(2 * m, 1)]
    out = []
    for j in range(m):
        add, times = salts[j] >> 32, (salts[m + j] >> 32) | 1
        order = sorted(range(len(kmers)), key=lambda i: (((numbered[i] ^ add) * times) & 0xFFFFFFFF, i))[: min(l, len(kmers))]
        value = min(l, len(kmers))
        for i in sorted(order):
            value = mix((value * step + kmers[i]) & mask)
        out.append(value >> 48)
    return out


@pytest.mark.parametrize("text", ["a", "abcdef", "abcabcabcabcabc", "the quick brown fox jumps over the lazy dog " * 3, "naïve 東京 😀 text", "z" * 100])
def test_order_minhash_equals_its_definition(text):
    assert orderminhash.order_minhash(code_points(text), m=16).tolist() == _plain_order_minhash(text, orderminhash.K, orderminhash.L, 16)


def test_followers_of_keys_beyond_doubles(spark):
    ids = [2**62 + 37 * i + 1 for i in range(80)] + [2**63 - 1]
    df = spark.createDataFrame([(i, f"text number {i} of several") for i in ids], "doc_id long, text string")
    got = list(orderminhash.edited_pairs(tuple(r) for r in orderminhash.with_followers(df, "doc_id", "text", 8).collect()))
    texts = [f"text number {i} of several" for i in ids]
    assert sorted((k, own, after) for k, own, _, after in got) == list(zip(ids, texts, texts[1:] + texts[:1], strict=True))


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_every_row_has_its_follower(spark, ranges):
    """Negative, null, repeated and very large keys; a key with a third of all rows; rows that are the same; a very long text."""
    rng = random.Random(7)
    keys = [None] * 4 + [-(2**63) + 5, -7, 0, 0, 0, 2**60, 2**60 + 1, 2**63 - 1] + [99] * 150 + [rng.randrange(-(2**62), 2**62) for _ in range(200)] + [2**60 + i for i in range(300)]
    rows = [(k, " ".join(rng.choices("abcdef", k=rng.randrange(0, 9)))) for k in keys] + [(99, "same")] * 40 + [(5, "long " * 60_000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "at long, h string").repartition(5)
    got = list(orderminhash.edited_pairs(tuple(r) for r in orderminhash.with_followers(df, "at", "h", ranges).collect()))
    from pyspark.sql import functions as F

    hashes = {r.h: r.x for r in df.select("h", F.xxhash64("h").alias("x")).collect()}
    order = sorted(rows, key=lambda r: (-(2**63) if r[0] is None else r[0], hashes[r[1]], r[1]))
    plain = [(a[0], a[1], b[1]) for a, b in zip(order, order[1:] + order[:1], strict=True)]
    by = lambda x: (x[0] is not None, x[0] or 0, x[1:])
    assert sorted(((k, own, after) for k, own, _, after in got), key=by) == sorted(plain, key=by)


def test_ranges_are_even(spark):
    df = spark.createDataFrame([(99 if i % 3 == 0 else 2**60 + i, f"text {i} " * (1 + i % 50)) for i in range(6000)], "doc_id long, text string").repartition(4)
    sizes = Counter()
    for r in orderminhash.with_followers(df, "doc_id", "text", 12).collect():
        sizes[r.bucket] += len(r.text)
    assert len(sizes) >= 11 and max(sizes.values()) <= 2 * np.median(list(sizes.values()))


def test_order_counts():
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(300)]
    a, b = " ".join(words), " ".join(words[150:] + words[:150])
    one, few = " ".join([*words[:100], "edited", *words[101:]]), " ".join(words[:200])
    f = {t: orderminhash.order_minhash(code_points(t), m=256) for t in (a, b, one, few)}
    like = lambda t: orderminhash.likeness(f[a], f[t])
    assert like(one) > 0.9 and like(b) < 0.7 and 0.2 < like(few) < like(one)


# ---- 4, 7, 10 ------------------------------------------------------------------


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(codec):
    import tiktoken

    return tiktoken.Encoding("reference", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def test_perfect_hash_is_minimal(codec):
    keys = np.unique(seeds(5000, 9))
    h = bpe.PerfectHash(keys)
    assert sorted(h(keys).tolist()) == list(range(len(keys))) and h.size == len(keys)
    assert sorted(codec.id.tolist()) == sorted(codec.ranks.values())


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(max_size=60), max_size=4))
def test_encoding_equals_the_library(codec, reference, texts):
    ids, at = codec.encode(texts)
    for i, t in enumerate(texts):
        own = ids[at[i] : at[i + 1]].tolist()
        assert own == reference.encode_ordinary(t) and codec.decode(own) == t.encode()


@settings(max_examples=600, deadline=None)
@given(texts=st.lists(st.text(alphabet="'' stmdrevl\n\tA1½!\u00a0\u3000é東\u0301😀", max_size=25), max_size=5))
def test_cutting_equals_the_regular_expression(codec, texts):
    import regex

    assert public_tokenizers.PATTERN == bpe.COMMON_PATTERN
    texts = [t for t in texts if t]
    begin = np.cumsum([0, *map(len, texts)])
    want = [int(b) + m.start() for b, t in zip(begin, texts, strict=False) for m in regex.finditer(bpe.COMMON_PATTERN, t)]
    assert not texts or bpe.common_starts(code_points("".join(texts)), begin[:-1]).tolist() == want


def test_other_patterns_are_cut_by_the_regular_expression(codec):
    own = bpe.Codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), r"\S+|\s+")
    ids, at = own.encode(["it's 10:30", "", "x"])
    assert own.decode(ids[at[0] : at[1]].tolist()) == b"it's 10:30" and at[1] == at[2] and len(at) == 4


def test_round_trip_query(spark, documents, reference):
    got = {r.doc_id: r for r in op4_bpe_round_trip(spark, documents[0]).collect()}
    for k, t in documents[2].items():
        ids = reference.encode_ordinary(t)
        assert tuple(got[k])[1:] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_token_counts(spark, documents, library):
    got = {r.doc_id: r for r in op7_token_counts(spark, documents[0]).collect()}
    for k, t in documents[2].items():
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert tuple(got[k])[1:] == (len(t.encode()), n, n > 512)


@settings(max_examples=200, deadline=None)
@given(text=st.text(alphabet=" \n\tab'é1!<|endoftext|>", max_size=200), most=st.integers(1, 20))
def test_parts_have_the_tokens_of_the_whole(library, text, most):
    parts = list(tokencounts.safe_parts(text, most))
    assert "".join(parts) == text
    assert [i for p in parts for i in library.encode(p, add_special_tokens=False).ids] == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "word_bpe_49k.json"])
def test_other_libraries(spark, documents, name):
    docs = spark.read.parquet(f"{documents[0]}/documents.parquet")
    assert tokencounts.token_counts(docs, public_tokenizers.path(name)).where("n_tokens > 0").count() > 40


def test_packing(spark, documents, library):
    rows = op10_harmonic_packing(spark, documents[0]).collect()
    ids = {k: np.array([*library.encode(t, add_special_tokens=False).ids, 0], dtype="<u4") for k, t in documents[2].items()}
    at, sequences = Counter(), defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == at[r.doc_id] and r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        at[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    assert at == {k: len(x) for k, x in ids.items()}
    padding = 0
    for s in sequences.values():
        end = 0
        for offset, n in sorted(s):
            assert offset == end
            end += n
        assert end <= 1024
        padding += 0 if end & (end - 1) == 0 else 1024 - end
    assert padding <= 0.01 * sum(map(len, ids.values()))


@settings(max_examples=100, deadline=None)
@given(lengths=st.lists(st.integers(1, 3000), max_size=60) | st.lists(st.integers(1, 40), max_size=300) | st.lists(st.integers(500, 700), max_size=120))
def test_bins_hold_every_piece_once(lengths):
    bins, out = packing.Harmonic(5), []
    for i, n in enumerate(lengths):
        whole = bins.whole(n)
        out += bins.full((i, 0), whole)
        if n > whole:
            out += bins.add((i, whole), n - whole, n > 1024)
    out += bins.rest()
    have, by = defaultdict(list), defaultdict(list)
    for (tag, begin), start, size, sequence, offset in out:
        have[tag].append((begin + start, size))
        by[sequence].append((offset, size))
        assert sequence >= 5
    for i, n in enumerate(lengths):
        at = 0
        for start, size in sorted(have[i]):
            assert start == at
            at += size
        assert at == n
    for pieces in by.values():
        end = 0
        for offset, size in sorted(pieces):
            assert offset == end
            end += size
        assert end == 1024 or end & (end - 1) == 0 and end < 1024


def test_bins_of_a_class_take_its_count():
    bins, out = packing.Harmonic(0), []
    for i, n in enumerate([512, 512, 256, 341, 256, 341, 256, 256, 342, 342]):
        out += bins.add(i, n)
    by = defaultdict(set)
    for tag, _, _, sequence, _ in out:
        by[sequence].add(tag)
    assert list(by.values()) == [{0, 1}, {2, 4, 6, 7}] and bins.open.keys() == {3} and [len(p) for *_, p in bins.waiting] == [2]
    out = bins.add(10, 340, True)  # the rest of a long document fills the room that waits
    assert [(x[0], x[1], x[2]) for x in out] == [(8, 0, 342), (9, 0, 342), (10, 0, 340)]


def test_most_documents_stay_whole(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=int(rng.paretovariate(1.1) * 100) % 3000))) for i in range(3000)]
    out = packed(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)).collect()
    pieces = Counter(r.doc_id for r in out)
    short = {r.doc_id for r in out if r.doc_tokens < 1024}
    assert sum(pieces[i] == 1 for i in short) > 0.9 * len(short)


def test_the_vocabulary_file_gives_the_librarys_ids(library):
    ranks, added = packing.plain_ranks(public_tokenizers.path("byte_bpe_50k.json"))
    assert len(ranks) + len(added) == library.get_vocab_size() and packing.plain_ranks(public_tokenizers.path("word_bpe_49k.json")) is None
    # a token that is a pre-token is the library's encoding of its bytes, too
    import regex

    for t, i in ranks.items():
        text = t.decode("utf-8", "replace")
        if text.encode() == t and regex.fullmatch(bpe.COMMON_PATTERN, text):
            assert library.encode(text, add_special_tokens=False).ids == [i]


@pytest.mark.parametrize("text", [" " * 1_500_000, "a" * 400_000, "x " + "\n" * 300_000 + " y" * 100_000, "東" * 300_000])
def test_long_texts_without_boundaries(spark, library, text):
    want = [*library.encode(text, add_special_tokens=False).ids, 0]
    rows = packed(spark.createDataFrame([(1, text)], "doc_id long, text string")).orderBy("start").collect()
    at = 0
    for r in rows:
        assert r.start == at and r.doc_tokens == len(want) and r.ids_crc32 == zlib.crc32(np.array(want[at : at + r.length], dtype="<u4").tobytes())
        at += r.length
    assert at == len(want)


# ---- 2 ---------------------------------------------------------------------------


@pytest.mark.parametrize("top", [2, 4, 30, 1000])
def test_bag_minhash_estimates_the_weighted_likeness(top):
    rng = np.random.default_rng(top)
    e = seeds(200, 8)
    a = rng.integers(0, top, 200)
    b = np.where(rng.random(200) < 0.7, a, rng.integers(0, top, 200))
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    m = 4096
    got = (bag_minhash(e[a > 0], a[a > 0], m) == bag_minhash(e[b > 0], b[b > 0], m)).mean()
    assert abs(got - want) < 4.5 * np.sqrt(want * (1 - want) / m)


def test_bag_minhash_does_not_depend_on_the_order():
    e, w = seeds(50, 8), np.arange(1, 51)
    p = np.random.default_rng(0).permutation(50)
    assert (bag_minhash(e, w) == bag_minhash(e[p], w[p])).all()


# ---- 6 ----------------------------------------------------------------------------


def test_held_out_accuracy(spark, documents):
    """Of the documents without a label."""
    rows = [r for r in op6_co_training(spark, documents[0]).collect() if r.doc_id >= 120]
    assert len(rows) == 60 and np.mean([r.keep == (r.doc_id % 3 > 0) for r in rows]) > 0.9


def _two_views(rng, n):
    y = rng.integers(0, 2, n).astype(float)
    return y, tuple((y * 2 - 1)[:, None] * s + rng.normal(size=(n, 6)) for s in (0.9, 0.7))


def test_views_teach_each_other():
    """With few labels, each view is better on held-out rows after the exchange than before."""
    before, after = [], []
    for seed in range(5):
        y, views = _two_views(np.random.default_rng(seed), 6000)
        few = slice(0, 40)
        passes = lambda *a: cotrain.pseudo_sums(tuple(v[40:3000] for v in views), *a)  # noqa: B023, E731
        for rounds, out in ((0, before), (3, after)):
            model = cotrain.co_train(tuple(v[few] for v in views), y[few], passes, rounds=rounds, confident=0.9)
            odds = model.odds(views[0][3000:], views[1][3000:])
            out.append([np.mean((o > 0) == (y[3000:] == 1)) for o in odds])
    assert (np.mean(after, axis=0) > np.mean(before, axis=0)).all() and np.mean(after, axis=0)[2] > 0.95


def test_sums_over_a_table_equal_those_of_its_rows(spark):
    y, views = _two_views(np.random.default_rng(9), 500)
    models = tuple(cotrain.Logistic.fitted(v[:100], y[:100]) for v in views)
    weights = tuple(m.weights * 0.5 for m in models)
    f4 = tuple(v.astype("<f4") for v in views)
    rows = [(str(i), None if i >= 100 else float(y[i]), f4[0][i].tobytes(), f4[1][i].tobytes()) for i in range(500)]
    table = spark.createDataFrame(rows, "id string, y double, t binary, m binary").repartition(7)
    got = cotrain.over_all(table, (6, 6))(models, weights, 0.8)
    want = cotrain.pseudo_sums(tuple(v[100:].astype(float) for v in f4), models, weights, 0.8)
    for a, b in zip(sum(got, []), sum(want, []), strict=True):
        assert a.weight == b.weight > 0 and np.allclose(a.packed(), b.packed())
    assert cotrain.over_all(table.limit(0), (6, 6))(models, weights, 0.8)[0][0].weight == 0


def test_one_class_gives_its_share():
    x = np.ones((20, 2))
    model = cotrain.co_train((x, x), np.ones(20), None)
    assert model.text is None and model.prior > 5


def test_accepted_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(i, "some words here" if i % 2 else "!!!! ####", "s", "en", 9, 1, 2, 3) for i in range(30)], "doc_id long, text string, source string, lang string, n_chars long, _id long, __n long, c0 long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(24)], "doc_id long, quality int")
    out = cotrain.accepted(df, cotrain.fit(df, labels))
    assert out.schema == df.schema and {r.doc_id for r in out.collect()} == set(range(1, 30, 2))


# ---- 8 -----------------------------------------------------------------------------


def _brute(text):
    """Base spans by a scan that knows nothing of the operator's patterns."""
    low, out = text, []
    word = re.compile(r"[A-Za-z0-9+/_.=-]")
    names = ["password", "passwd", "secret", "token", "api_key", "apikey"]
    at = 0
    fold = "".join(c.lower() if c.isascii() else c for c in low)
    while at < len(text):
        hit = next((n for n in names if fold.startswith(n, at)), None)
        if hit:
            e = at + len(hit)
            e += e < len(text) and text[e] in "\"'"
            while e < len(text) and text[e] == " ":
                e += 1
            if e < len(text) and text[e] in ":=":
                e += 1
                while e < len(text) and text[e] == " ":
                    e += 1
                e += e < len(text) and text[e] in "\"'"
                s = e
                while e < len(text) and word.match(text[e]):
                    e += 1
                if e > s:
                    if e - s >= 8:
                        out.append((at, 0, e))
                    at = e
                    continue
        at += 1
    for kind, start, chars, least in ((1, "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16), (2, "", "0123456789abcdef", 32)):
        at = 0
        while at < len(text):
            if text.startswith(start, at):
                e = at + len(start)
                while e < len(text) and text[e] in chars:
                    e += 1
                if e > at + len(start) or (not start and e > at):
                    if e - at >= least:
                        out.append((at, kind, e))
                    at = e
                    continue
            at += 1
    return sorted(out)


SECRETS = ["token = \"0123456789abcdef0123456789abcdef01234567\"", "password: token: abcdefghij", "PASSWD='short'", "api_key==abc", "AKIA" + "Z" * 12, "AKIA1", "AKIAAKIA" + "9" * 20, "é token=ſecret12 x secret = \"aaaa bbbb", "apikey : " + "v" * 9, "f" * 31 + " " + "e" * 32, "secret=token=abcdefgh"]


def test_base_spans_equal_a_plain_scan():
    rng = random.Random(3)
    parts = SECRETS + ["token", "secret", ":", "=", " ", "\"", "'", "AKIA", "deadbeef" * 3, "abc", "K", "\n", "api_key", "12345678"]
    for _ in range(1500):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 9)))
        assert secrets.scan(text)[0] == _brute(text), text


def test_weak_candidates_need_a_complement():
    weak = "Ab1" * 13 + "Z"
    assert secrets.scan(f"key {weak} here") == ([], [])
    base, linked = secrets.scan(f"id AKIA{'Q' * 12} key {weak} here")
    assert [k for _, k, _ in base] == [1] and [secrets.KINDS[k] for _, k, _ in linked] == ["secret"]
    assert secrets.scan(f"id AKIA{'Q' * 12} {'pad ' * 100} key {weak}")[1] == []
    assert [secrets.KINDS[k] for _, k, _ in secrets.scan(f"https://db.example.org/x password: abc AKIA{'Q' * 12}")[1]] == ["endpoint", "short"]
    assert secrets.scan("password: abc")[1] == [] and secrets.scan("see https://example.org/")[1] == []


def test_interval_join_equals_all_pairs():
    rng = np.random.default_rng(0)
    for _ in range(300):
        make = lambda n: np.sort(rng.integers(0, 400, n))[:, None] + np.array([[0, int(rng.integers(1, 30))]])
        a, b = make(int(rng.integers(0, 8))), make(int(rng.integers(0, 8)))
        want = [any(s - 50 <= y and x <= e + 50 for x, y in b) for s, e in a]
        assert secrets._near(a, b, 50).tolist() == want


def test_secret_query(spark, documents):
    df = spark.createDataFrame([(i, s) for i, s in enumerate([*SECRETS, None])], "doc_id long, text string")
    got = {r.doc_id: r for r in secrets.secret_spans(df).collect()}
    for i, s in enumerate(SECRETS):
        assert [(x.start, secrets.KINDS.index(x.kind), x.end) for x in got[i].base] == _brute(s)
    rows = op8_secret_scan(spark, documents[0]).collect()
    assert len(rows) == len(documents[2])
    for r in rows:
        base = _brute(documents[2][r.doc_id])
        assert r.base_sha256 == hashlib.sha256(secrets.joined(base).encode()).hexdigest() and (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in base) for n in range(3))


# ---- 9 -----------------------------------------------------------------------------


@pytest.mark.parametrize("size", [2, 3, 10, 97, 1000])
def test_permutations_are_permutations(size):
    assert sorted(pii.permute(i, size, b"k", b"t") for i in range(size)) == list(range(size))


def test_pseudonyms_keep_the_format_and_links():
    p, q = pii.Pseudonyms(b"one"), pii.Pseudonyms(b"two")
    text = "card 4111 1111 1111 1111, mail jo.doe7@example.org, on 2024-02-29 at 10.20.30.40, +1 (974) 555-3436, 123-45-6789, DE89 3704 0044 0532 0130 00 end"
    out = p(text)
    kinds = [k for _, _, k, _ in p.spans(text)]
    assert kinds == ["card", "mail", "date", "ip", "phone", "ssn", "iban"] and len(p.spans(out)) == 7 and [k for _, _, k, _ in p.spans(out)] == kinds
    assert p(text) == out != q(text) and all(text[s:e] not in out for s, e, _, _ in p.spans(text))
    card = re.search(r"card ([\d ]+),", out)[1]
    assert pii.luhn(card.replace(" ", "")) and [len(x) for x in card.split()] == [4, 4, 4, 4]
    assert p("again 4111 1111 1111 1111!") == f"again {card}!" and p("4111111111111111") == card.replace(" ", "")


@pytest.mark.parametrize("value", ["4111 1111 1111 1111", "4111111111111111", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"])
@pytest.mark.parametrize("text", ["{}", "{} 12/27", "{} 123", "{}-7", "{} USA", "{} PAID", "12 {}", "98 76 {} 12/27", "AB12 CD34 {} 1"])
def test_values_beside_further_groups(value, text):
    if value[0] != "4" and "-" in text:
        return
    text = f"pay {text.format(value)} now"
    at = text.index(value)
    assert [(s, e) for s, e, k, _ in pii.Pseudonyms(b"key").spans(text) if k in ("card", "iban")] == [(at, at + len(value))]


@pytest.mark.parametrize("text", ["", "4111111111111112", "999.1.1.1", "2023-02-30", "000-12-3456", "DE00 3704 0044 0532 0130 00", "a@b", "v1.2.3", "id 12345", "x4111111111111111", "pi 3.14159265358979"])
def test_values_that_fail_their_check_stay(text):
    assert pii.Pseudonyms(b"key")(text) == text


def test_only_texts_and_their_lengths_change(spark, documents):
    docs = spark.read.parquet(f"{documents[0]}/documents.parquet")
    out = pii.pseudonymised(docs, b"key")
    assert out.schema == docs.schema and out.exceptAll(docs).count() == 0
    one = spark.createDataFrame([(1, "x", "from 1.2.3.4 to", 15)], "doc_id long, extra string, text string, n_chars long")
    r = pii.pseudonymised(one, b"key", count="n_values").first()
    assert r.n_chars == len(r.text) and r.n_values == 1 and r.text != "from 1.2.3.4 to"


@pytest.mark.parametrize(
    "group",
    [
        ["2024-02-13", "2024/02/13", "13/02/2024", "13.02.2024", "02/13/2024", "2/13/2024", "2024-2-13", "13-02-2024"],
        ["2024-02-09", "2024-2-9", "09.02.2024", "9.2.2024", "02/09/2024"],
        ["+1 (974) 555-3436", "974-555-3436", "(974) 555-3436", "+19745553436", "974.555.3436"],
        ["+49 171 123 4567", "0171 123 4567"],
    ],
)
def test_one_value_has_one_pseudonym(group):
    p = pii.Pseudonyms(b"key")
    canon = lambda t: [c for n in re.findall(r"\d+", t) for c in n]
    out = [p(f"x {v} y")[2:-2] for v in group]
    assert all(len(a) == len(b) and re.sub(r"\d", "0", a) == re.sub(r"\d", "0", b) and a != b for a, b in zip(group, out, strict=True))
    if "2024" in group[0]:
        def fields(v, was):
            a = [int(x) for x in re.split(r"[-/.]", v)]
            day_first = "." in was or re.match(r"1[3-9][-/]", was)
            return (a[0], a[1], a[2]) if len(re.split(r"[-/.]", was)[0]) == 4 else (a[2], a[1], a[0]) if day_first else (a[2], a[0], a[1])

        assert len({fields(v, was) for v, was in zip(out, group, strict=True)}) == 1
    else:
        assert len({"".join(canon(v))[-9:] for v in out}) == 1


def test_letters_of_an_iban_are_replaced_too():
    out = pii.Pseudonyms(b"key")("GB82 WEST 1234 5698 7654 32")
    assert re.fullmatch(r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d", out) and "WEST" not in out
    s = out.replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def test_keys_come_from_the_session(spark):
    spark.conf.unset(pii.SETTING)
    one = pii.session_key(spark)
    assert len(one) == 32 and pii.session_key(spark) == one
    spark.conf.set(pii.SETTING, "own")
    assert pii.session_key(spark) == b"own"
    spark.conf.unset(pii.SETTING)


def _plain_permute(value, size, key, tweak):
    """The Feistel network once more, in steps."""
    import hmac

    a = 2
    while a * a < size:
        a += max(1, (math.isqrt(size) - a) // 2)
    while True:
        left, right = value // a, value % a
        for i in range(8):
            mixed = hmac.new(key, tweak + f"|{size}|{i}|{right}".encode(), "sha256").digest()
            left, right = right, (left + int.from_bytes(mixed, "big")) % a
        value = left * a + right
        if value < size:
            return value


def test_pseudonym_query_equals_a_plain_version(spark, tmp_path):
    """Whole texts made of known values and filling, one long, against replacements made one at a time."""
    key, rng = b"own", random.Random(12)
    card_body = lambda body: next(body + c for c in "0123456789" if pii.luhn(body + c))

    def card():
        v = card_body("4" + "".join(rng.choices("0123456789", k=14)))
        return v, card_body(f"{_plain_permute(int(v[:-1]), 10**15, key, b'card'):015d}")

    def ip():
        v = [rng.randrange(256) for _ in range(4)]
        n = _plain_permute(int.from_bytes(bytes(v), "big"), 2**32, key, b"ip")
        return ".".join(map(str, v)), ".".join(map(str, n.to_bytes(4, "big")))

    def phone():
        v = f"{rng.randrange(10**9, 10**10)}"
        w = f"{_plain_permute(int(v), 10**10, key, b'phone'):010d}"
        return f"{v[:3]}-{v[3:6]}-{v[6:]}", f"{w[:3]}-{w[3:6]}-{w[6:]}"

    def mail():
        v = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6))
        n = 0
        for c in v:
            n = n * 26 + ord(c) - 97
        n, w = _plain_permute(n, 26**6, key, b"mailexample.org|aaaaaa"), ""
        for _ in range(6):
            n, w = n // 26, chr(97 + n % 26) + w
        return f"{v}@example.org", f"{w}@example.org"

    def day():
        first = datetime.date(1900, 1, 1)
        days = [first + datetime.timedelta(n) for n in range((datetime.date(2100, 1, 1) - first).days)]
        own = days[rng.randrange(len(days))]
        group = lambda d: (d.month > 9, 0 if d.day < 10 else 1 if d.day < 13 else 2)
        like = [d for d in days if group(d) == group(own)]
        new = like[_plain_permute(like.index(own), len(like), key, b"date%d%d" % group(own))]
        return own.isoformat(), new.isoformat()

    rows, want = [(0, None, 1), (1, "", 0), (2, "no values", 9)], {0: (None, 1, 0), 1: ("", 0, 0), 2: ("no values", 9, 0)}
    for i in range(3, 60):
        before, after, n = [], [], rng.randrange(0, 9) if i else 0
        for _ in range(3000 if i == 30 else n):
            filling = " " + "".join(rng.choices("ghijkl ", k=rng.randrange(3, 60))) + " "
            v, w = rng.choice([card, ip, phone, mail, day] if i != 30 else [card, ip, phone, mail])()
            before += [filling, v]
            after += [filling, w]
        a, b = "".join(before), "".join(after)
        rows.append((i, a, len(a)))
        want[i] = (b, len(b), len(before) // 2)
    spark.createDataFrame(rows, "doc_id long, text string, n_chars long").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.conf.set(pii.SETTING, key.decode())
    got = {r.doc_id: (r.text, r.n_chars, r.n_values) for r in op9_pii_pseudonyms(spark, str(tmp_path)).collect()}
    spark.conf.unset(pii.SETTING)
    assert got == want


def test_long_local_parts_are_no_mail():
    text = "a" * 100_000 + "@example.org"
    assert pii.Pseudonyms(b"key")(text) == text


def test_long_texts_are_taken_whole(spark, tmp_path, reference):
    """Of some megabytes, with what is looked for at the very end."""
    rng = random.Random(15)
    filling = " ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=300_000))
    texts = {1: f"{filling} token=abcdefgh12345", 2: "x" * 1_000_000 + " mail jo.doe@example.org", 3: "\n" * 500_000}
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in op8_secret_scan(spark, str(tmp_path)).collect()}
    assert got[1].spans == f"assign:{len(texts[1]) - 19}:{len(texts[1])}" and got[2].n_assign == 0
    got = {r.doc_id: r for r in op9_pii_pseudonyms(spark, str(tmp_path)).collect()}
    assert [got[i].n_values for i in (1, 2, 3)] == [0, 1, 0] and got[2].text[:1_000_000] == texts[2][:1_000_000]
    got = {r.doc_id: r for r in op4_bpe_round_trip(spark, str(tmp_path)).collect()}
    assert all(got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items()) and got[1].n_tokens == len(reference.encode_ordinary(texts[1]))
    assert op6_co_training(spark, str(tmp_path)).count() == 3
    got = {r.doc_id: r for r in op1_order_minhash(spark, str(tmp_path)).collect()}
    assert got[1].edited_sha256 == hashlib.sha256((texts[1][: len(texts[1]) - len(texts[1]) // 2] + texts[2][: len(texts[1]) // 2]).encode()).hexdigest()
