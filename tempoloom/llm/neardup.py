"""Near-duplicate documents: BagMinHash signatures, bands, and the verified overlap of the multisets of word shingles.

1. Documents with the same words are one class from the start (digest).
2. Each distinct text gets a BagMinHash signature of 128 entries in 32 bands of
   4; a pair with a likeness of 0.8 misses all bands with a chance of 5e-8.
3. In each bucket of equal bands, every text is first paired with two leaders:
   the one that shares most buckets with others, which of edited copies is their
   origin or near it, and the one of the least hash of id and band, so it differs
   between bands. Both come from aggregates that combine before the shuffle.
4. Pairs are verified exactly: sum of minima over sum of maxima of the shingle
   counts is at least the threshold. The texts of a leader's partners are
   spread over groups of bounded size, each with one copy of the leader.
5. Classes are the connected components of the verified links.
6. Texts that share a bucket with a class of LARGE or more texts, but belong to a
   smaller one, are its guests. They are compared with that whole class and with
   its other guests: the shingles of all these are indexed in blocks of bounded
   size, and each guest meets each block once, not each text.
7. Where the other texts of a bucket are of several classes, those outside the
   bucket's largest class lead in turn, more of them in each round, and are tried
   against all texts of other classes that weren't guests beside them. So at the end any two texts of a bucket
   were compared, or are of one class, or differ too much in length. A bucket of
   texts that are alike costs no more than its leaders; one of n texts that are
   all just below the threshold has n * n / 2 pairs to compare.

Edge cases: a null text is empty; texts without words are one class; a text of
fewer than five words is one shingle; rows with a null key have no class; rows
that share a key are one document; extra columns are ignored; an empty table
gives an empty table; texts are compared whole, however long. The class id is
the least key of the class.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bagminhash import bag_minhash
from .common import U64, map_rows, mix64, shingle_hashes, text_of, word_hashes, written
from .graph import components

SHINGLE, LIKENESS, BANDS, ROWS = 5, 0.8, 32, 4
#: Texts that are verified against one copy of a leader in one group.
GROUP = 256
#: Texts from which a class is compared by blocks of its shingles, the shingles of a block, and the texts that meet one copy of it.
LARGE, BLOCK, GUESTS = 32, 1 << 20, 1024
#: About how many more leaders a bucket gets in its second round; each later round has as many times more.
MORE = 8


def bands_of(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    out = mix64(np.arange(1, bands + 1, dtype=U64))
    parts = signature[: bands * rows].reshape(bands, rows)
    with np.errstate(over="ignore"):
        for i in range(rows):
            out = mix64(out * U64(0x9E3779B97F4A7C15) + parts[:, i])
    return out.view(np.int64)


def overlap(a: Counter, b: Counter) -> float:
    """Weighted Jaccard likeness of two multisets; 1 for two empty ones."""
    if len(a) > len(b):
        a, b = b, a
    both = sum(min(n, b[x]) for x, n in a.items() if x in b)
    whole = a.total() + b.total() - both
    return both / whole if whole else 1.0


def shingles(text: str, size: int = SHINGLE) -> Counter:
    words = text.split()
    return Counter(zip(*(words[i:] for i in range(size)), strict=False)) if len(words) >= size else Counter([tuple(words)] if words else [])


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(key, digest of the words, shingles, bands); no bands for a text without words."""

    def each(rows_):
        for k, t in rows_:
            words = t.split()
            digest = xxhash.xxh3_128_hexdigest(" ".join(words).encode())
            own, counts = np.unique(shingle_hashes(word_hashes(t), size), return_counts=True)
            yield k, digest, int(counts.sum()), bands_of(bag_minhash(own, counts, bands * rows), bands, rows).tolist() if len(own) else []

    df = text_of(docs.where(F.col(key).isNotNull()), key, text=text)
    return map_rows(df, each, f"{key} {df.schema[key].dataType.simpleString()}, digest string, n long, bands array<long>", 1000)


def bucket_members(banded: DataFrame, texts: int) -> DataFrame:
    """(band, id, n, first, other) from (id, n, bands) of about so many texts, stored: the texts of each bucket of several, and its two first leaders."""
    keys = banded.select("id", "n", F.explode("bands").alias("band"))
    # written, so that the joins with them are of two plain shuffles, whose large partitions can be split
    many = written(keys.groupBy("band").agg(F.count("*").alias("many")).where("many > 1"), "many", texts * BANDS)
    members = written(keys.hint("merge").join(many.hint("merge"), "band"), "shared", texts * BANDS)
    rows = members.count()
    central = members.groupBy("id").agg(F.sum("many").alias("central"))
    leader = F.struct("id", "n")
    leads = members.hint("merge").join(central.hint("merge"), "id").groupBy("band").agg(F.max(F.struct("central", F.xxhash64("id").alias("h"), leader.alias("x"))).alias("first"), F.min(F.struct(F.xxhash64("id", "band").alias("h"), leader.alias("x"))).alias("other"))
    leads = leads.select("band", F.col("first.x").alias("first"), F.col("other.x").alias("other"))
    return written(members.hint("merge").join(written(leads, "leads", rows).hint("merge"), "band").select("band", "id", "n", "first", "other"), "members", rows)


def _long_enough(a: str, b: str, likeness: float):
    """Whether texts of a and b shingles can be alike: the likeness is at most the lesser over the greater."""
    return F.least(a, b) / F.greatest(a, b) >= likeness


def candidate_pairs(members: DataFrame, likeness: float = LIKENESS) -> DataFrame:
    """(id, lead) from bucket_members(): each text with the two leaders of each of its buckets."""
    both = members.select("id", "n", F.explode(F.array("first", "other")).alias("x")).select("id", "n", F.col("x.id").alias("lead"), F.col("x.n").alias("m"))
    return both.where((F.col("id") != F.col("lead")) & _long_enough("n", "m", likeness)).select("id", "lead").distinct()


def with_classes(members: DataFrame, classes: DataFrame) -> DataFrame:
    """The texts (id, ...) with their class."""
    return members.hint("merge").join(classes, F.col("id") == F.col("node"), "left").select(*members.columns, F.coalesce("component", "id").alias("class"))


def open_members(left: DataFrame, classes: DataFrame, leaders: int, rows: int) -> DataFrame:
    """(band, id, n, hosts, class, leads) of the texts (band, id, n, hosts), so many rows at most, in buckets that hold several classes; about so many in each lead, none of its largest class, and all where they are no more."""
    placed = with_classes(left, classes)
    by_class = placed.groupBy("band", "class").agg(F.count("*").alias("k"))
    buckets = by_class.groupBy("band").agg(F.max(F.struct("k", "class")).alias("main"), F.sum("k").alias("all"), F.count("*").alias("classes")).where("classes > 1")
    buckets = written(buckets.select("band", F.col("main.class").alias("main"), (F.col("all") - F.col("main.k")).alias("others")), "buckets", rows)
    chance = F.pmod(F.xxhash64("id", "band"), F.lit(1 << 30)) * F.col("others") < F.lit(leaders << 30)
    return placed.hint("merge").join(buckets.hint("merge"), "band").select("band", "id", "n", "hosts", "class", ((F.col("class") != F.col("main")) & chance).alias("leads"))


def guests(placed: DataFrame, large: DataFrame, likeness: float, rows: int) -> DataFrame:
    """(id, class): texts of placed (band, id, n, class), so many rows at most, that share a bucket with a larger class of large (class, size) and might be alike to one of its texts there."""
    sized = placed.hint("merge").join(large.hint("merge"), "class", "left")
    hosts = sized.where("size IS NOT NULL").groupBy("band", F.col("class").alias("host")).agg(F.max("size").alias("its"), F.min("n").alias("low"), F.max("n").alias("high"))
    both = sized.hint("merge").join(written(hosts, "hosts", rows).hint("merge"), "band")
    smaller = F.struct(F.coalesce("size", F.lit(1)).cast("long"), F.col("class")) < F.struct(F.col("its").cast("long"), F.col("host"))
    return both.where(smaller & (F.col("n") >= F.col("low") * likeness) & (F.col("n") * likeness <= F.col("high"))).select("id", F.col("host").alias("class")).distinct()


def hosted(guests_: DataFrame, classes: DataFrame, sizes: DataFrame, docs: DataFrame, key: str, text: str, size: int = SHINGLE, likeness: float = LIKENESS) -> DataFrame:
    """Links (a, b) of the guests (id, class) with texts of their host class and with its other guests: for each block of these one with each class that has a text alike. sizes: (id, n)."""
    hosts = guests_.select("id", F.col("class").alias("host"))
    few = written(hosts.groupBy("host").agg(F.ceil(F.count("*") / GUESTS).alias("turns")), "turns", guests_.count())
    placed = with_classes(hosts, classes)
    members = classes.select(F.col("node").alias("id"), F.col("component").alias("host")).hint("merge").join(few.hint("merge"), "host").select("id", "host", F.col("host").alias("class"))
    members = members.unionByName(placed).hint("merge").join(sizes.hint("merge"), "id")
    parts = written(members.groupBy("host").agg(F.ceil(F.sum("n") / BLOCK).alias("parts")).join(few.hint("merge"), "host"), "parts", few.count())
    all_ = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    inside = members.hint("merge").join(parts.hint("merge"), "host").select("id", "host", "class", F.pmod(F.xxhash64("id"), "parts").alias("part"), all_("turns").alias("turn"), F.lit(0).alias("role"))
    asking = placed.hint("merge").join(parts.hint("merge"), "host").select("id", "host", "class", all_("parts").alias("part"), F.pmod(F.xxhash64("id"), "turns").alias("turn"), F.lit(1).alias("role"))
    texts = text_of(docs, key, text=text).where(F.col(key).isNotNull()).withColumnsRenamed({key: "id", text: "body"})
    rows = inside.unionByName(asking).hint("merge").join(texts, "id").select("host", "part", "turn", "role", "id", "class", "body")
    kind = rows.schema["id"].dataType.simpleString()

    def each(rows_):
        at, block = None, Block()
        for host, part, turn, role, i, own_class, body in rows_:
            if at != (host, part, turn):
                at, block = (host, part, turn), Block()
            own, counts = np.unique(shingle_hashes(word_hashes(body), size), return_counts=True)
            if role == 0:
                block.add(i, own_class, own, counts)
            else:
                for other in block.alike(own_class, own, counts, likeness):
                    yield i, other

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_rows(rows.repartition(n, "host", "part", "turn").sortWithinPartitions("host", "part", "turn", "role"), each, f"a {kind}, b {kind}", 1000)


class Block:
    """The shingles of some texts, by 64-bit hashes, so that one text is compared with all of them at once."""

    def __init__(self):
        self.ids: list = []
        self.classes: list = []
        self.open: list[tuple[np.ndarray, np.ndarray]] = []
        self.hash: np.ndarray | None = None

    def add(self, i, own_class, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.ids.append(i)
        self.classes.append(own_class)
        self.open.append((hashes, counts))

    def alike(self, own_class, hashes: np.ndarray, counts: np.ndarray, likeness: float) -> list:
        """A text of each other class that has one which is alike enough to the one with these shingles."""
        if not self.ids:
            return []
        if self.hash is None:
            whole = np.concatenate([h for h, _ in self.open])
            order = np.argsort(whole, kind="stable")
            self.hash, self.count = whole[order], np.concatenate([c for _, c in self.open])[order]
            self.of = np.repeat(np.arange(len(self.ids)), [len(h) for h, _ in self.open])[order]
            self.total = np.array([int(c.sum()) for _, c in self.open])
            self.open = []
        low, high = np.searchsorted(self.hash, hashes, "left"), np.searchsorted(self.hash, hashes, "right")
        n = high - low
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        both = np.bincount(self.of[at], weights=np.minimum(self.count[at], np.repeat(counts, n)), minlength=len(self.ids))
        like = both / np.maximum(self.total + counts.sum() - both, 1)
        return list({self.classes[i]: self.ids[i] for i in np.flatnonzero(like >= likeness).tolist() if self.classes[i] != own_class}.values())


def beside_leaders(members: DataFrame, likeness: float) -> DataFrame:
    """(id, lead) from open_members(), for each bucket: its texts with its leaders of other classes, less those of guests of one class. Two leaders meet once, not each the other."""
    leads = members.where("leads").select("band", F.col("id").alias("lead"), F.col("n").alias("m"), F.col("class").alias("its"), F.col("hosts").alias("other_hosts"))
    once = ~F.col("leads") | (F.col("lead") < F.col("id"))
    return members.hint("merge").join(leads, "band").where(once & (F.col("class") != F.col("its")) & _long_enough("n", "m", likeness) & ~F.arrays_overlap("hosts", "other_hosts")).select("id", "lead")


def further_pairs(members: DataFrame, tried: DataFrame, likeness: float) -> DataFrame:
    """(id, lead) from open_members(): the pairs of beside_leaders() that were not tried before."""
    both = beside_leaders(members, likeness)
    both = both.groupBy(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).agg(F.min("lead").alias("lead"))
    before = tried.select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b"))
    return both.hint("merge").join(before, ["a", "b"], "left_anti").select(F.when(F.col("a") == F.col("lead"), F.col("b")).otherwise(F.col("a")).alias("id"), "lead")


def verified(pairs: DataFrame, docs: DataFrame, key: str, text: str, size: int = SHINGLE, likeness: float = LIKENESS) -> DataFrame:
    """The pairs (a, b) of pairs (id, lead) whose texts are alike."""
    sizes = written(pairs.groupBy("lead").agg(F.ceil(F.count("*") / GROUP).alias("parts")), "sizes", pairs.count())
    members = pairs.join(sizes, "lead").select("id", "lead", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"), F.lit(1).alias("role"))
    heads = sizes.select(F.col("lead").alias("id"), "lead", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"))
    texts = text_of(docs, key, text=text).where(F.col(key).isNotNull()).withColumnsRenamed({key: "id", text: "body"})
    # the same join at every size: a broadcast of the pairs would depend on how many there are
    rows = members.unionByName(heads).hint("merge").join(texts, "id").select("lead", "part", "role", "id", "body")
    kind = rows.schema["id"].dataType.simpleString()

    def each(rows_):
        head, own = None, Counter()
        for lead, part, role, i, body in rows_:
            if role == 0:
                head, own = (lead, part), shingles(body, size)
            elif head == (lead, part) and overlap(own, shingles(body, size)) >= likeness:
                yield lead, i

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_rows(rows.repartition(n, "lead", "part").sortWithinPartitions("lead", "part", "role"), each, f"a {kind}, b {kind}", 1000)


def linked(banded: DataFrame, texts: int, shared: DataFrame, docs: DataFrame, key: str, text: str, size: int = SHINGLE, likeness: float = LIKENESS) -> DataFrame:
    """(node, component): the classes of the texts (id, n, bands), about so many, by all links in their buckets and the given ones (a, b)."""
    members = bucket_members(banded, texts)
    rows = members.count()
    tried = written(candidate_pairs(members, likeness), "pairs", 2 * rows)
    stored = lambda links: written(components(links, texts), "classes", texts)
    classes = stored(verified(tried, docs, key, text, size, likeness).union(shared))
    more = lambda links: stored(links.union(classes.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    left = members.where((F.col("id") != F.col("first.id")) & (F.col("id") != F.col("other.id"))).select("band", "id", "n")
    none = F.array().cast(f"array<{members.schema['id'].dataType.simpleString()}>")
    large = written(classes.groupBy(F.col("component").alias("class")).agg(F.count("*").alias("size")).where(F.col("size") >= LARGE), "large", texts)
    if not large.isEmpty():
        placed = written(with_classes(left, classes), "placed", rows)
        left = placed.hint("merge").join(large, "class", "left_anti").select("band", "id", "n")
        met = written(guests(placed, large, likeness, rows), "guests", rows)
        links = written(hosted(met, classes, banded.select("id", "n"), docs, key, text, size, likeness), "links")
        if not links.isEmpty():
            classes = more(links)
        hosts = written(met.groupBy("id").agg(F.collect_set("class").alias("hosts")), "hosts", rows)
        left = left.hint("merge").join(hosts.hint("merge"), "id", "left").select("band", "id", "n", F.coalesce("hosts", none).alias("hosts"))
    else:
        left = left.withColumn("hosts", none)
    leaders = MORE
    while True:
        now = written(open_members(left, classes, leaders, rows), "open", rows)
        if now.isEmpty():
            return classes
        pairs = written(further_pairs(now, tried, likeness), "pairs")
        links = written(verified(pairs, docs, key, text, size, likeness), "links")
        if not links.isEmpty():
            classes = more(links)
        tried, left = tried.union(pairs), now.where(~F.col("leads")).select("band", "id", "n", "hosts")
        leaders *= MORE


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, likeness: float = LIKENESS) -> DataFrame:
    """(key, class_id): the class of each document with a key."""
    signed = written(signatures(docs, key, text, size), "signatures").withColumnRenamed(key, "id")
    texts = signed.count()
    same = written(signed.groupBy("digest").agg(F.min("id").alias("first")), "same", texts)
    banded = signed.join(same, "digest").where(F.col("id") == F.col("first")).select("id", "n", "bands")
    # a key that has several texts links their classes
    own = signed.join(same, "digest").select(F.col("id").alias("a"), F.col("first").alias("b"))
    shared = own.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high")).where("low <> high").select(F.col("low").alias("a"), F.col("high").alias("b"))
    classes = linked(banded, texts, shared, docs, key, text, size, likeness)
    return own.join(classes, F.col("b") == F.col("node"), "left").groupBy(F.col("a").alias(key)).agg(F.min(F.coalesce("component", "b")).alias("class_id"))


def without_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs less all but one document of each class; rows with a null key stay. Of rows that share the key of a class the one with the least hash of all its columns stays."""
    names = docs.columns
    rows = docs.toDF(*(f"c{i}" for i in range(len(names))))  # the columns of docs may have any name
    own = f"c{names.index(key)}"
    every = F.xxhash64(*rows.columns)
    kept = near_duplicates(docs, key, text).where(F.col(key) == F.col("class_id")).select(F.col(key).alias("k"))
    least = rows.groupBy(F.col(own).alias("k")).agg(F.min(every).alias("h"))
    kept = kept.join(least, "k")
    one = rows.join(kept, (F.col(own) == F.col("k")) & (every == F.col("h")), "left_semi").dropDuplicates([own])
    return one.unionByName(rows.where(F.col(own).isNull())).toDF(*names)
