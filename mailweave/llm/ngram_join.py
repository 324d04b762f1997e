"""Near duplicates: exact Jaccard self-join on word shingles by adaptive multi-match prefixes.

Two texts link when the sets of their five-word shingles have a Jaccard similarity of 0.75 or
more. If so, then in any order of shingles that is the same for all, the first n - o + l shingles
of both (n the size of a set, o = ceil(0.75 n)) have l in common. Three steps use this:

1. Texts with equal sets become one class, whose smallest id stands for it.
2. A wide filter with long prefixes, l = n / 4, in the order of the shingle hashes. A text goes on
   only if l shingles of its prefix are in other texts too. Shingles are counted by hash range:
   a block of texts sends its distinct shingles as packed arrays and gets their counts back, so
   the count of a shingle that is everywhere costs one entry per block.
3. The texts left are few. Their shingles are counted again, and ordered from rare to frequent.
   Each text chooses its own l: a longer prefix reads more postings but lets fewer candidates
   through to verification, as those must share l prefix shingles; the l with the lowest estimated
   cost is taken. Pairs share at least the smaller l of the two.

Within a posting list of thousands of near copies, pairs are not listed. First each text is
compared with one leader of its lists; links found merge texts into groups, and only pairs
whose texts are in different groups stay open. Of those, the first common shingle is in the prefix
for l = 1 of both texts, so from here on only these postings count. Pairs that meet so in short
lists are listed and verified, whatever else they share; long lists are compared chunk against
chunk within tasks, which return only links that still join groups. Components come out the same
as with all pairs.

Sets are compared by 64-bit hashes of the shingles.

Edge cases: a null, empty or blank text has an empty set and links with nothing. With fewer than
five words the whole sequence is the only shingle. Rows with the same id count as one document
with all their texts. A null id is never part of a group. Extra columns are not read. An empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailweave.llm.common import fresh, table
from mailweave.llm.components import components, root
from mailweave.operators.joins import attach
from mailweave.session import stored

WORDS = 5
NUM, DEN = 3, 4  # the threshold as a fraction
BLOCK = 1 << 19  # shingles of a block
BLOCK_TEXTS = 30_000
VERIFY_COST = 10  # a verification, in postings read
MOST_MATCHES = 16
ROUNDS = 2  # of comparisons with leaders
LONG_LIST = 48  # texts of a list whose pairs are not listed
CHUNK = 4096  # texts of a chunk of a long list, and
CHUNK_SHINGLES = 4 << 20  # their shingles
BUCKET_BYTES = 64 << 20  # of input whose shingles are counted in one group
_MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    if n < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=n)], dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    g = h[: n - WORDS + 1] * _MIX[0]
    for k in range(1, WORDS):
        g += h[k : n - WORDS + 1 + k] * _MIX[k]
        g ^= g >> np.uint64(31)
        g *= _MIX[0]
    return np.unique(g)


def prefix(n: int, matches: int) -> int:
    """Length of the prefix in which two linked sets share ``matches`` elements."""
    return n - -(-NUM * n // DEN) + matches


def first_pass(df: DataFrame, buckets: int) -> DataFrame:
    """Blocks of texts: a row with ids, set sizes and set hashes (bucket -1), and for each hash
    range the block's distinct prefix shingles, how often each occurs, and in which texts."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids: list = []
        sizes: list[int] = []
        keys: list[bytes] = []
        parts: list[np.ndarray] = []
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            block = (part << 32) + number
            lengths = np.array([len(p) for p in parts], dtype=np.int64)
            grams = np.concatenate(parts) if parts else np.empty(0, np.uint64)
            owner = np.repeat(np.arange(len(parts)), lengths)
            bucket = ((grams >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            token = (grams & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            order = np.lexsort((token, bucket))
            bucket, token, owner = bucket[order], token[order], owner[order]
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            rows = {"bucket": [-1], "ids": [ids], "sizes": [sizes], "keys": [keys], "tokens": [[]], "counts": [[]], "owners": [[]]}
            for b in np.nonzero(np.diff(cuts))[0]:
                mine = slice(cuts[b], cuts[b + 1])
                distinct, counts = np.unique(token[mine], return_counts=True)
                new = (int(b), [], [], [], distinct.view(np.int32), counts.astype(np.int16), owner[mine].astype(np.int16))
                for name, value in zip(rows, new):
                    rows[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * len(rows["bucket"]), pa.int64()),
                    pa.array(rows["bucket"], pa.int32()),
                    pa.array(rows["ids"], pa.list_(pa.int64())),
                    pa.array(rows["sizes"], pa.list_(pa.int64())),
                    pa.array(rows["keys"], pa.list_(pa.binary())),
                    pa.array(rows["tokens"], pa.list_(pa.int32())),
                    pa.array(rows["counts"], pa.list_(pa.int16())),
                    pa.array(rows["owners"], pa.list_(pa.int16())),
                ],
                names=["block", "bucket", "ids", "sizes", "keys", "tokens", "counts", "owners"],
            )

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                g = shingles(text.as_py())
                n = len(g)
                ids.append(doc)
                sizes.append(n)
                keys.append(xxhash.xxh3_128_digest(g.tobytes()) if n else None)
                parts.append(g[: prefix(n, -(-n // 4))] if n else g)
                held += len(parts[-1])
                if held >= BLOCK or len(ids) >= BLOCK_TEXTS:
                    yield from out()
                    number += 1
                    ids, sizes, keys, parts, held = [], [], [], [], 0
        if ids:
            yield from out()

    rows = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(
        blocks,
        "block bigint, bucket int, ids array<bigint>, sizes array<bigint>, keys array<binary>, "
        "tokens array<int>, counts array<smallint>, owners array<smallint>",
    )


def frequencies(sent: DataFrame, kind: str) -> DataFrame:
    """``(block, bucket, tokens, counts)`` -> ``(block, bucket, df)``: in how many texts of all
    blocks each token of the block is, at most 32767."""

    def count(whole: pa.Table) -> pa.Table:
        tokens = [np.asarray(t.values) for t in whole.column("tokens")]
        counts = np.concatenate([np.asarray(c.values) for c in whole.column("counts")]).astype(np.int64)
        _, back = np.unique(np.concatenate(tokens), return_inverse=True)
        total = np.minimum(np.bincount(back, counts), 32767).astype(np.int16)[back]
        ends = np.cumsum([len(t) for t in tokens])
        df = pa.array(np.split(total, ends[:-1]), pa.list_(pa.int16()))
        return pa.table({"block": whole.column("block"), "bucket": whole.column("bucket"), "df": df})

    rows = sent.select("block", "bucket", F.col("tokens").cast(f"array<{kind}>"), F.col("counts").cast("array<smallint>"))
    return rows.groupBy("bucket").applyInArrow(count, "block bigint, bucket int, df array<smallint>")


def may_link(blocks: DataFrame) -> DataFrame:
    """``doc_id`` of the texts with enough prefix shingles that are in other texts as well."""
    packed = blocks.filter("bucket >= 0")
    answers = frequencies(packed.select("block", "bucket", "tokens", "counts"), "int")
    asked = blocks.select("block", "bucket", "ids", "sizes", "counts", "owners")

    def decide(left: pa.Table, right: pa.Table) -> pa.Table:
        df = {b: np.asarray(d.values) for b, d in zip(right.column("bucket").to_pylist(), right.column("df"))}
        found = None
        sums = None
        for b, ids, sizes, counts, owners in zip(*[left.column(c) for c in ("bucket", "ids", "sizes", "counts", "owners")]):
            if b.as_py() == -1:
                found = np.array(ids.as_py(), dtype=object), np.asarray(sizes.values)
                continue
            own = np.asarray(owners.values)
            shared = np.repeat(df[b.as_py()] >= 2, np.asarray(counts.values))
            more = np.bincount(own[shared], minlength=BLOCK_TEXTS)
            sums = more if sums is None else sums + more
        ids, sizes = found
        if sums is None:
            return pa.table({"doc_id": pa.array([], pa.int64())})
        kept = (sizes > 0) & (sums[: len(sizes)] >= -(-sizes // 4))
        return pa.table({"doc_id": pa.array([i for i in ids[kept] if i is not None], pa.int64())})

    return asked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(decide, "doc_id bigint")


def sets_of(docs: DataFrame) -> DataFrame:
    """``(block, doc_id, n, grams)`` of texts; a block has about half a million shingles."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                grams = [shingles(t) for t in batch.column("text").to_pylist()]
                sizes = [len(g) for g in grams]
                before = np.cumsum([0, *sizes[:-1]]) + held
                held += sum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block + before // BLOCK, pa.int64()),
                        batch.column("doc_id"),
                        pa.array(sizes, pa.int64()),
                        pa.array([g.view(np.int64) for g in grams], pa.list_(pa.int64())),
                    ],
                    names=["block", "doc_id", "n", "grams"],
                )

    return docs.mapInArrow(sets, "block bigint, doc_id bigint, n bigint, grams array<bigint>")


def best_matches(df: np.ndarray, n: int) -> int:
    """The l with the lowest estimated cost, from the frequencies in prefix order."""
    most = min(MOST_MATCHES, -(-NUM * n // DEN))
    lengths = np.minimum(prefix(n, 0) + np.arange(1, most + 1), len(df))
    read = np.cumsum(df - 1)[lengths - 1]
    return int(np.argmin(read * (1 + VERIFY_COST / np.arange(1, most + 1)))) + 1


def postings(sets: DataFrame, buckets: int) -> DataFrame:
    """``(gram, doc_id, n, matches, place)`` of every prefix shingle that another text has too, with
    its place in the order of the text's shingles; ``first`` if it is in the prefix for l = 1."""

    def by_bucket(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bucket = ((grams >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return grams[order], np.searchsorted(bucket[order], np.arange(buckets + 1))

    def distinct(whole: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        grams = [np.asarray(g.values).view(np.uint64) for g in whole.column("grams")]
        return grams, *np.unique(np.concatenate(grams), return_counts=True)

    def send(whole: pa.Table) -> pa.Table:
        _, unique, counts = distinct(whole)
        ordered, cuts = by_bucket(unique)
        counts = np.minimum(counts[np.searchsorted(unique, ordered)], 32767).astype(np.int16)
        used = np.nonzero(np.diff(cuts))[0]
        return pa.table({
            "block": pa.array([whole.column("block")[0].as_py()] * len(used), pa.int64()),
            "bucket": pa.array(used, pa.int32()),
            "tokens": pa.array([ordered[cuts[b] : cuts[b + 1]].view(np.int64) for b in used], pa.list_(pa.int64())),
            "counts": pa.array([counts[cuts[b] : cuts[b + 1]] for b in used], pa.list_(pa.int16())),
        })

    def choose(left: pa.Table, right: pa.Table) -> pa.Table:
        grams, unique, _ = distinct(left)
        ordered, cuts = by_bucket(unique)
        df = np.empty(len(ordered), dtype=np.int64)
        for b, found in zip(right.column("bucket").to_pylist(), right.column("df")):
            df[cuts[b] : cuts[b + 1]] = np.asarray(found.values)
        known = np.empty(len(unique), dtype=np.int64)
        known[np.searchsorted(unique, ordered)] = df
        out: list[tuple] = []
        places: list[np.ndarray] = []
        first: list[np.ndarray] = []
        for doc, g in zip(left.column("doc_id").to_pylist(), grams):
            own = known[np.searchsorted(unique, g)]
            order = np.lexsort((g, own))
            n, own = len(g), own[order]
            matches = best_matches(own, n)
            chosen = order[: prefix(n, matches)]
            shared = np.nonzero(own[: len(chosen)] >= 2)[0]
            out.append((g[chosen[shared]], doc, n, matches))
            places.append(shared)
            first.append(shared < prefix(n, 1))
        times = [len(c) for c, *_ in out]
        spread = lambda k, kind: pa.array(np.repeat(np.array([o[k] for o in out], dtype=np.int64), times), kind)
        return pa.table({
            "gram": pa.array(np.concatenate([c for c, *_ in out]).view(np.int64)),
            "doc_id": spread(1, pa.int64()), "n": spread(2, pa.int64()), "matches": spread(3, pa.int64()),
            "place": pa.array(np.concatenate(places).astype(np.int32)), "first": pa.array(np.concatenate(first)),
        })

    sent = sets.select("block", "grams").groupBy("block").applyInArrow(
        send, "block bigint, bucket int, tokens array<bigint>, counts array<smallint>"
    )
    answers = frequencies(sent, "bigint")
    asked = sets.select("block", "doc_id", "grams")
    return asked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        choose, "gram bigint, doc_id bigint, n bigint, matches bigint, place int, first boolean"
    )


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets are similar enough."""
    side = lambda name: sets.select(F.col("doc_id").alias(name), F.col("n").alias(f"n_{name}"), F.col("grams").alias(f"g_{name}"))
    pairs = stored(pairs.select("a", "b"), "pairs")
    ends = stored(pairs.select("a").distinct(), "pair_ends")
    leaders = stored(attach(side("a"), ends, ["a"], ["a"], how="left_semi", unique=True), "pair_sets")
    with_b = attach(side("b"), pairs, ["b"], ["b"], how="inner", unique=True)
    both = with_b.join(leaders, "a")
    shared = F.size(F.array_intersect("g_a", "g_b"))
    return both.filter(100 * shared >= 75 * (F.col("n_a") + F.col("n_b") - shared)).select("a", "b")


def _fit(a: str, b: str):
    """Sets whose sizes differ too much cannot be similar."""
    return DEN * F.least(a, b) >= NUM * F.greatest(a, b)


def star_pairs(lists: DataFrame, turn: int) -> DataFrame:
    """Each text with the leader that it shares most with, among the leaders of its lists.

    The first leader of a list is its smallest id; later turns draw others by hash.
    """
    place = F.lit(0) if turn == 0 else F.xxhash64("doc_id", F.lit(turn))
    top = F.struct(place.alias("h"), F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("matches").alias("m_a"), F.col("component").alias("c_a"))
    leader = stored(lists.groupBy("gram").agg(F.min(top).alias("top")).select("gram", "top.*"), "leaders")
    met = lists.join(leader, "gram").filter("a != doc_id AND component != c_a").filter(_fit("n", "n_a"))
    pairs = met.groupBy("a", F.col("doc_id").alias("b")).agg(
        F.count(F.lit(1)).alias("shared"), F.min(F.least("matches", "m_a")).alias("least")
    )
    return pairs.filter("shared >= least").groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a"))


def short_list_pairs(lists: DataFrame) -> DataFrame:
    """Pairs of different groups that share a shingle of ``lists`` and can be similar enough.

    After the first shingle that two texts have in common they share at most what is left of
    either. Later ones give a lower bound, so a pair stays if any of its rows does.
    """
    side = lambda end: lists.select("gram", *[F.col(c).alias(f"{c}_{end}") for c in ("doc_id", "n", "place", "component")])
    met = side("a").join(side("b"), "gram").filter("doc_id_a < doc_id_b AND component_a != component_b").filter(_fit("n_a", "n_b"))
    most = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    met = met.filter(100 * most >= 75 * (F.col("n_a") + F.col("n_b") - most))
    return met.select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b")).distinct()


def long_list_links(lists: DataFrame, sizes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links within long lists that join different groups, enough of them to connect these.

    A list is cut into chunks and a task compares two chunks, whole sets against an inverted
    index of them, without a row per pair. A pair whose first common shingle is that of a long list
    is settled here.
    """
    chunks = F.greatest(F.ceil(F.col("m") / F.lit(float(CHUNK))), F.ceil(F.col("total") / F.lit(float(CHUNK_SHINGLES)))).cast("int")
    rows = lists.select("gram", "doc_id", "component").join(sizes, "gram").withColumn("k", chunks)
    rows = rows.withColumn("c", F.pmod(F.xxhash64("doc_id", F.lit("chunk")), F.col("k")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    rows = rows.select("gram", F.least("c", "other").alias("i"), F.greatest("c", "other").alias("j"), "c", "doc_id", "component")
    rows = rows.join(sets.select("doc_id", "grams"), "doc_id")

    def compare(whole: pa.Table) -> pa.Table:
        docs = whole.column("doc_id").to_numpy()
        groups = whole.column("component").to_numpy()
        chunk = whole.column("c").to_numpy()
        i, j = whole.column("i")[0].as_py(), whole.column("j")[0].as_py()
        sets_ = [np.asarray(g.values) for g in whole.column("grams")]
        n = np.array([len(g) for g in sets_])
        grams, code, counts = np.unique(np.concatenate(sets_), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(docs)), n)
        order = np.argsort(code, kind="stable")
        inverted = owner[order]
        starts = np.concatenate([[0], np.cumsum(counts)])
        ends = np.cumsum(n)
        parent: dict[int, int] = {}

        a, b = [], []
        for x in range(len(docs)):
            if i != j and chunk[x] != i:
                continue
            own = code[ends[x] - n[x] : ends[x]]
            own = own[counts[own] >= 2]
            spans = counts[own]
            at = np.repeat(starts[own] - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum())
            shared = np.bincount(inverted[at], minlength=len(docs))
            near = (100 * shared >= 75 * (n[x] + n - shared)) & (groups != groups[x])
            near &= (chunk == j) if i != j else (np.arange(len(docs)) > x)
            for y in np.nonzero(near)[0].tolist():
                p, q = root(parent, int(groups[x])), root(parent, int(groups[y]))
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    a.append(int(docs[x]))
                    b.append(int(docs[y]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("gram", "i", "j").applyInArrow(compare, "a bigint, b bigint")


def links(lists: DataFrame, sets: DataFrame) -> DataFrame | None:
    """Links that connect exactly the groups which all links would connect; None without any."""
    size = lists.count()
    if size == 0:
        return None
    found, opened = None, lists.withColumn("component", F.col("doc_id"))
    for turn in range(ROUNDS):
        new = stored(verified(star_pairs(opened, turn), sets), "new_links")
        found = new if found is None else found.union(new)
        groups = components(found).select(F.col("node").alias("doc_id"), F.col("component").alias("_c"))
        # Only lists with texts of several groups stay open.
        held = stored(
            lists.join(groups, "doc_id", "left").withColumn("component", F.coalesce("_c", "doc_id")).drop("_c"), "open_lists"
        )
        several = held.groupBy("gram").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("m"))
        several = stored(several.filter("x != y").select("gram", "m"), "several")
        opened = stored(held.join(several.select("gram"), "gram"), "open_lists")
        if opened.count() <= size // 8:
            break
    # The first shingle that a linked pair has in common is in the shortest prefix of both, so lists
    # need only those texts whose shortest prefix has the shingle. Shingles in common cannot be
    # counted over some of the lists only, so one of a short list is enough.
    opened = opened.filter("first")
    sizes = opened.groupBy("gram").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"))
    sizes = stored(sizes.filter(F.col("m") > LONG_LIST), "long_lists")
    short = opened.join(sizes, "gram", "left_anti")
    last = stored(verified(short_list_pairs(short), sets), "new_links")
    found = found.union(last)
    if sizes.isEmpty():
        return found
    return found.union(stored(long_list_links(opened, sizes, sets), "new_links"))


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, a row for each row of ``df``."""
    spark = df.sparkSession
    docs = df.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    size = size if size < 1 << 60 else 0  # unknown
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / BUCKET_BYTES))
    blocks = stored(first_pass(docs, buckets), "blocks")
    zipped = blocks.filter("bucket = -1").select(F.explode(F.arrays_zip("ids", "sizes", "keys")).alias("d"))
    thin = stored(zipped.select(F.col("d.ids").alias("doc_id"), F.col("d.sizes").alias("n_shingles"), F.col("d.keys").alias("key")), "thin")
    classes = stored(
        thin.filter("key IS NOT NULL AND doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("first")), "classes"
    )
    able = stored(may_link(blocks), "may_link")
    firsts = classes.select(F.col("first").alias("doc_id"))
    reps = stored(attach(able, firsts, ["doc_id"], ["doc_id"], how="left_semi", unique=True).distinct(), "may_link")
    sets = stored(sets_of(attach(docs, reps, ["doc_id"], ["doc_id"], how="left_semi", unique=True)), "sets")
    lists = stored(postings(sets, buckets), "postings")
    found = links(lists, sets)
    if found is None:
        named = classes.withColumn("component_id", F.col("first"))
    else:
        groups = components(found).select(F.col("node").alias("first"), "component")
        named = classes.join(groups, "first", "left").withColumn("component_id", F.coalesce("component", "first"))
    named = stored(named.select("key", "component_id"), "class_components")
    out = thin.join(named, "key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))


def op4_ngram_join(spark, sf_dir) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id. Documents without an id stay.

    Where an id stands in several rows, groups are those of rows: of rows with one id only those go
    that are near duplicates of another, and of these the row with the smallest hash of its text stays.
    """
    counts = docs.filter("doc_id IS NOT NULL").agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if counts[0] == counts[1]:
        found = stored(near_duplicates(docs), "near_duplicates")
        gone = stored(found.filter("doc_id != component_id").select("doc_id").distinct(), "copies")
        kept = attach(docs, gone, ["doc_id"], ["doc_id"], how="left_anti", unique=True)
        return kept.select(*docs.columns)
    (row,) = fresh(docs, "_row")
    number = F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())
    rows = stored(docs.withColumn(row, number), "rows")
    found = near_duplicates(rows, doc_id=row).filter("doc_id IS NOT NULL")
    found = stored(found.select(F.col("doc_id").alias(row), "component_id"), "near_duplicates")
    named = rows.select("doc_id", F.xxhash64("text").alias("_hash"), row).join(found, row)
    first = named.groupBy("component_id").agg(F.min(F.struct("doc_id", "_hash", row)).alias("first"))
    stays = stored(first.select(F.col(f"first.{row}").alias(row)), "kept_rows")
    kept = attach(rows.filter(F.col(row).isNotNull()), stays, [row], [row], how="left_semi", unique=True)
    return kept.unionByName(rows.filter(F.col(row).isNull())).select(*docs.columns)
