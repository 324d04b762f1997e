"""Language identification by interpolated Kneser-Ney models of characters.

The character 4-grams of every training text are counted per language, all of them, by Spark.
From the counts of a language follow the discounts and the continuation counts of shorter grams,
and with them the interpolated Kneser-Ney probability of every known gram. The model is a sorted
array of 64-bit gram hashes (four characters of 16 bits, so within the basic plane the hash is
the gram itself) with one column of log probabilities per language, and sorted arrays per order
for backing off where no language knows the gram. It is broadcast while it measures at most
``MODEL_BYTES``, grams times languages counted. A larger model stays in tables (``Tables``): the
discounts, totals and continuation counts are taken by Spark, from all grams, and the distinct grams
of the texts are joined to them. The probabilities are the same either way; no gram is left out.

The language of a text is the one with the lowest cross-entropy per character over the whole
text. A text is rejected when its cross-entropy lies above what training texts of that language
and length show: the limit per language is the 99.9 % quantile of the length-scaled excess of all
its training texts, widened by half. Medians and quantiles are exact, from distributed ranks. A
language with fewer than ``FEWEST`` texts takes the quantile over the texts of all languages,
and the greater of its own median and that of all. Rejection does not alter the predicted language.

Characters are lower-cased; runs of anything but letters are one gap.

Edge cases: a null text, or one without letters, is ``und`` with score 0 and is rejected. With no
training rows at all every text is ``und`` and rejected. Equal entropies go to the first language
in code-point order. Repeated rows are handled each. Extra columns are kept; columns with the
output's names are replaced. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailweave.llm.common import fresh, held_out, table
from mailweave.operators.joins import attach
from mailweave.operators.ranking import rank_within
from mailweave.session import stored

MODEL_BYTES = 64 << 20
TOP = 0.999
FEWEST = 1_000  # a 99.9 % quantile of fewer is their maximum
SCATTER = 400  # grams beyond which a text scatters no less
HELD_CHARS = 1 << 19
GAP = 32
UNKNOWN = "und"
OUTPUT = [
    T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("entropy", T.DoubleType()),
    T.StructField("n_letters", T.LongType()),
    T.StructField("accepted", T.BooleanType()),
]
_letters: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    """Which code points are letters; made once per worker."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _letters[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """4-gram hashes of all texts after each other, and the number of grams of each text.

    A text is three gaps, then its letters with one gap for anything between them.
    """
    joined = "\n".join(t.lower().replace("\n", " ") for t in texts) + "\n"
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = is_letter()[np.minimum(code, 0x10FFFF)]
    text_end = code == 10
    # Keep letters, the first gap after a letter, and every end.
    keep = letter | text_end
    keep[1:] |= letter[:-1]
    kept_end = text_end[keep]
    symbol = np.where(letter, code & 0xFFFF, GAP)[keep].astype(np.uint64)
    # Three more gaps before each text.
    starts = np.concatenate([[0], np.nonzero(kept_end)[0][:-1] + 1]) if len(texts) else np.empty(0, np.int64)
    padded = np.insert(symbol, np.repeat(starts, 3), GAP)
    ends = np.nonzero(kept_end)[0] + 3 * np.arange(1, len(texts) + 1)
    hashes = np.zeros(len(padded), dtype=np.uint64)
    for back in range(4):
        hashes[back:] |= padded[: len(padded) - back] << np.uint64(16 * back)
    real = np.ones(len(padded), dtype=bool)
    first = starts + 3 * np.arange(len(texts))
    for k in range(3):
        real[first + k] = False
    sizes = ends - first - 3 + 1
    return hashes[real], sizes


def groups(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about half a million characters, with the place of the first."""
    start = size = 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= HELD_CHARS:
            yield start, texts[start : k + 1]
            start, size = k + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def count_grams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, gram, n)`` over all rows; counts are summed in the tasks before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts):
            keys, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return keys, np.bincount(back, np.concatenate([p[1] for p in parts])).astype(np.int64)

        def out(name: str, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([name] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(counts)],
                names=["lang", "gram", "n"],
            )

        for batch in batches:
            frame = pd.DataFrame({"t": batch.column("text").to_pylist(), "l": batch.column("lang").to_pylist()})
            for name, part in frame.groupby("l", sort=False):
                for _, some in groups([t or "" for t in part["t"]]):
                    keys, counts = np.unique(grams(some)[0], return_counts=True)
                    parts = held.setdefault(name, [])
                    parts.append((keys, counts.astype(np.int64)))
                    if len(parts) >= 16:
                        held[name] = [merged(parts)]
                        if len(held[name][0][0]) > 1_000_000:
                            yield out(name, *held.pop(name)[0])
        for name, parts in held.items():
            yield out(name, *merged(parts))

    rows = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    return rows.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def discount_of(ones: int, twos: int) -> float:
    """The absolute discount from the numbers of grams that occur once and twice."""
    discount = ones / (ones + 2.0 * twos) if ones else 0.5
    return float(min(max(discount, 0.1), 0.95))


class Order:
    """One order of one language: discounted shares of known grams, and weights of the shorter."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys = keys
        discount = discount_of((counts == 1).sum(), (counts == 2).sum())
        self.contexts, back = np.unique(keys >> np.uint64(16), return_inverse=True)
        totals = np.bincount(back, counts)
        self.share = np.maximum(counts - discount, 0) / totals[back]
        self.weight = discount * np.bincount(back) / totals

    def add(self, keys: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        share = _look_up(self.keys, self.share, keys, 0.0)
        return share + _look_up(self.contexts, self.weight, keys >> np.uint64(16), 1.0) * shorter


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, absent: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), absent)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], absent)


class KneserNey:
    """The model of one language from its 4-gram counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order].astype(np.float64)
        self.orders = [Order(keys, counts)]
        for length in (3, 2, 1):
            # Continuation counts: in how many ways the longer gram begins.
            cut = np.uint64((1 << (16 * length)) - 1)
            keys, counts = np.unique(keys & cut, return_counts=True)
            self.orders.append(Order(keys, counts.astype(np.float64)))

    def probability(self, keys: np.ndarray) -> np.ndarray:
        p = np.full(len(keys), 1.0 / 65536)
        for length, order in zip((1, 2, 3, 4), reversed(self.orders)):
            cut = np.uint64((1 << (16 * length)) - 1) if length < 4 else np.uint64(2**64 - 1)
            p = order.add(keys & cut, p)
        return p


class Limits:
    """The languages and what their training texts show; set by :func:`calibrate`."""

    def __init__(self, langs: list[str]) -> None:
        self.langs = langs
        self.mean = np.zeros(len(langs))
        self.limit = np.full(len(langs), np.inf)

    def scaled_excess(self, entropy: np.ndarray, sizes: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """Short texts scatter more, by the root of their length up to a few hundred grams."""
        return (entropy - self.mean[lang]) * np.sqrt(np.minimum(sizes, SCATTER))

    def judge(self, letters: np.ndarray, h: np.ndarray | None, sizes: np.ndarray | None) -> dict[str, np.ndarray]:
        """The output columns of texts, which have letters or not, from their entropies and sizes."""
        n = len(letters)
        if not self.langs or n == 0:
            return {
                "lang_pred": np.full(n, UNKNOWN, dtype=object), "score": np.zeros(n), "entropy": np.full(n, np.nan),
                "n_letters": np.zeros(n, np.int64), "accepted": np.zeros(n, bool),
            }
        best = h.argmin(axis=1)
        low = h[np.arange(n), best]
        # Odds of the languages from the difference in entropy, with the weight of at most 100 grams.
        odds = np.exp2(-(h - low[:, None]) * (np.minimum(sizes, 100) / 2)[:, None])
        accepted = letters & (self.scaled_excess(low, sizes, best) <= self.limit[best])
        return {
            "lang_pred": np.where(letters, np.array(self.langs, dtype=object)[best], UNKNOWN),
            "score": np.where(letters, 1 / odds.sum(axis=1), 0.0),
            "entropy": np.where(letters, low, np.nan),
            "n_letters": np.where(letters, sizes, 0).astype(np.int64),
            "accepted": accepted,
        }


class Model(Limits):
    """All languages in memory."""

    def __init__(self, counted: pd.DataFrame) -> None:
        super().__init__(sorted(counted["lang"].unique()))
        self.models = []
        for lang in self.langs:
            own = counted[counted["lang"] == lang]
            self.models.append(KneserNey(own["gram"].to_numpy().view(np.uint64), own["n"].to_numpy()))
        known = [m.orders[0].keys for m in self.models]
        self.keys = np.unique(np.concatenate(known)) if known else np.empty(0, np.uint64)
        self.bits = self._bits(self.keys)

    def _bits(self, keys: np.ndarray) -> np.ndarray:
        out = np.empty((len(keys), len(self.langs)), dtype=np.float32)
        for k, m in enumerate(self.models):
            out[:, k] = -np.log2(m.probability(keys))
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per gram of each text under each language, and the number of grams."""
        keys, sizes = grams(texts)
        unique, back = np.unique(keys, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, unique), len(self.keys) - 1)
        bits = self.bits[at]
        unseen = self.keys[at] != unique
        bits[unseen] = self._bits(unique[unseen])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        out = np.empty((len(texts), len(self.langs)))
        for k in range(len(self.langs)):
            out[:, k] = np.add.reduceat(bits[:, k][back], starts, dtype=np.float64) / sizes
        return out, sizes

    def predict(self, texts: list[str]) -> dict[str, np.ndarray]:
        h, sizes = self.entropies(texts) if self.langs and texts else (None, None)
        return self.judge(with_letters(texts), h, sizes)


def with_letters(texts: list[str]) -> np.ndarray:
    return np.array([any(c.isalpha() for c in t) for t in texts], dtype=bool) if texts else np.empty(0, bool)


class Tables(Limits):
    """All languages as tables: for each length of gram the discounted shares of the grams,
    ``(gram, known)``, and the weights of what is shorter, ``(context, known)``, where ``known`` lists
    the languages that have any."""

    def __init__(self, counted: DataFrame, langs: list[str]) -> None:
        super().__init__(langs)
        place = F.create_map(*[F.lit(x) for k, name in enumerate(langs) for x in (name, k)])
        level = counted.select(F.element_at(place, F.col("lang")).alias("lang"), "gram", F.col("n").cast("bigint").alias("n"))
        self.shares, self.weights = {}, {}
        for length in (4, 3, 2, 1):
            if length < 4:
                # Continuation counts: in how many ways the longer gram begins.
                level = level.groupBy("lang", _last(F.col("gram"), length).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
            level = stored(level, "grams")
            facts = level.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).collect()
            discounts = F.create_map(*[F.lit(x) for r in facts for x in (r["lang"], discount_of(r["ones"], r["twos"]))])
            own = F.element_at(discounts, F.col("lang"))
            parted = level.withColumn("context", F.shiftrightunsigned("gram", 16))
            totals = stored(
                parted.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")), "contexts"
            )
            weight = F.struct("lang", (own * F.col("kinds") / F.col("total")).alias("value"))
            self.weights[length] = stored(totals.groupBy("context").agg(F.collect_list(weight).alias("known")), "weights")
            share = F.struct("lang", (F.greatest(F.col("n") - own, F.lit(0.0)) / F.col("total")).alias("value"))
            shared = parted.join(totals, ["lang", "context"])
            self.shares[length] = stored(shared.groupBy("gram").agg(F.collect_list(share).alias("known")), "shares")

    def bits(self, wanted: DataFrame) -> DataFrame:
        """``(gram, bits)`` of the distinct grams ``wanted(gram)``: bits in every language."""
        rows = wanted.select("gram")
        for length in (4, 3, 2, 1):
            key = _last(F.col("gram"), length)
            share = self.shares[length].select(F.col("gram").alias("key"), F.col("known").alias(f"share{length}"))
            weight = self.weights[length].select(F.col("context").alias("key"), F.col("known").alias(f"weight{length}"))
            rows = rows.withColumn("key", key).join(share, "key", "left").drop("key")
            rows = rows.withColumn("key", F.shiftrightunsigned(key, 16)).join(weight, "key", "left").drop("key")
        count = len(self.langs)

        def dense(column: pa.Array, absent: float) -> np.ndarray:
            out = np.full((len(column), count), absent)
            at = pc.list_parent_indices(column).to_numpy()
            known = pc.list_flatten(column)
            out[at, known.field("lang").to_numpy()] = known.field("value").to_numpy()
            return out

        def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                p = np.full((batch.num_rows, count), 1.0 / 65536)
                for length in (1, 2, 3, 4):
                    p = dense(batch.column(f"share{length}"), 0.0) + dense(batch.column(f"weight{length}"), 1.0) * p
                bits = pa.FixedSizeListArray.from_arrays(pa.array(-np.log2(p).ravel().astype(np.float32)), count)
                yield pa.RecordBatch.from_arrays([batch.column("gram"), bits.cast(pa.list_(pa.float32()))], names=["gram", "bits"])

        return rows.mapInArrow(evaluate, "gram bigint, bits array<float>")

    def entropies(self, rows: DataFrame) -> DataFrame:
        """``(row, size, h)`` of the texts ``rows(row, text)``: bits per gram in every language. Sums
        are taken in the tasks before the shuffle, so a long text is in no task as a whole."""

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, numbers = [t or "" for t in batch.column("text").to_pylist()], batch.column("row").to_numpy()
                for first, some in groups(texts):
                    keys, sizes = grams(some)
                    for k, own in enumerate(np.split(keys, np.cumsum(sizes)[:-1])):
                        unique, counts = np.unique(own, return_counts=True)
                        row = np.full(len(unique), numbers[first + k])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(row), pa.array(unique.view(np.int64)), pa.array(counts.astype(np.int64))], names=["row", "gram", "n"]
                        )

        counted = stored(rows.select("row", "text").mapInArrow(count, "row bigint, gram bigint, n bigint"), "text_grams")
        bits = stored(self.bits(counted.select("gram").distinct()), "bits")
        # A gram that is in very many texts is split.
        met = attach(counted, bits, ["gram"], ["row"], "inner")
        sums = [F.sum(F.col("n") * F.get("bits", F.lit(k)).cast("double")).alias(f"b{k}") for k in range(len(self.langs))]
        found = met.groupBy("row").agg(F.sum("n").alias("size"), *sums)
        h = F.array(*[F.col(f"b{k}") / F.col("size") for k in range(len(self.langs))])
        return found.select("row", "size", h.alias("h"))


def _last(gram: Column, length: int) -> Column:
    """The last ``length`` characters of a gram."""
    return gram if length == 4 else gram.bitwiseAND(F.lit((1 << (16 * length)) - 1))


def fit(training: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", most: int = MODEL_BYTES) -> Model | Tables:
    """Model and limits from all rows of ``training``."""
    counted = stored(count_grams(training, text, lang), "grams")
    langs = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    facts = counted.agg(F.count(F.lit(1)), F.count_distinct("gram")).first()
    # The counts by language with the arrays of all orders, and the dense array of all languages.
    model = Tables(counted, langs) if 64 * facts[0] + 4 * len(langs) * facts[1] > most else Model(counted.toPandas())
    calibrate(model, training, text, lang, key)
    return model


def calibrate(model: Model | Tables, training: DataFrame, text: str, lang: str, key: str, most: int | None = None) -> None:
    """Limits of rejection from all training texts; given ``most``, from about that many of each
    language, chosen by a hash."""
    rows = training.filter(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    rows = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    if not model.langs:
        return
    if most is not None:
        totals = rows.groupBy("lang").count().collect()
        pairs = [F.lit(v) for r in totals for v in (r["lang"], min(1.0, most / r["count"]))]
        # The upper 53 bits of the hash as a number in [0, 1); the text counts where ids are null or repeated.
        drawn = F.shiftrightunsigned(F.xxhash64("key", "text", F.lit("calibration")), 11) / F.lit(float(1 << 53))
        rows = rows.filter(drawn < F.create_map(*pairs)[F.col("lang")])
    seen = measured(model, rows)
    if most is None:
        set_all_limits(model, seen)
    else:
        set_limits(model, seen.toPandas())


def measured(model: Model | Tables, rows: DataFrame) -> DataFrame:
    """``(lang, h, n)`` of the texts ``rows(text, lang)``: the place of their language, bits per gram
    under it, and the number of grams, where there are two at least."""
    if isinstance(model, Tables):
        numbered = stored(rows.withColumn("row", F.monotonically_increasing_id()), "calibration")
        place = F.create_map(*[F.lit(x) for k, name in enumerate(model.langs) for x in (name, k)])
        own = numbered.select("row", F.element_at(place, F.col("lang")).alias("lang"))
        found = model.entropies(numbered).join(own, "row").filter("size > 1")
        return stored(found.select("lang", F.get("h", F.col("lang")).alias("h"), F.col("size").alias("n")), "entropies")
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        place = {name: k for k, name in enumerate(known.langs)}
        for frame in frames:
            for first, some in groups(frame["text"].tolist()):
                h, sizes = known.entropies(some)
                own = np.array([place.get(name, -1) for name in frame["lang"].iloc[first : first + len(some)]])
                fine = (own >= 0) & (sizes > 1)
                yield pd.DataFrame({"lang": own[fine], "h": h[np.arange(len(own)), own][fine], "n": sizes[fine]})

    found = stored(rows.select("text", "lang").mapInPandas(measure, "lang int, h double, n bigint"), "entropies")
    shared.unpersist()
    return found


POOLED = -1  # all languages together, beside their places


def quantiles(values: DataFrame, share: float) -> dict[int, tuple[float, int]]:
    """The exact quantile of ``values(lang, x)`` and their number, by language and of all together:
    between the two nearest values in proportion. Values are ranked by Spark; two a language reach the driver."""
    both = values.withColumn("lang", F.explode(F.array(F.col("lang"), F.lit(POOLED))))
    totals = {r["lang"]: r["n"] for r in both.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals:
        return {}
    wanted = {lang: (share * (n - 1), n) for lang, n in totals.items()}
    places = F.create_map(*[F.lit(x) for lang, (at, _) in wanted.items() for x in (lang, int(at))])
    ranked = rank_within(both, ["lang"], [F.col("x").asc()], "place", totals[POOLED])
    first = F.element_at(places, F.col("lang"))
    near = ranked.filter((F.col("place") == first) | (F.col("place") == first + 1))
    found = {(r["lang"], r["place"]): r["x"] for r in near.collect()}
    out = {}
    for lang, (at, n) in wanted.items():
        low = found[lang, int(at)]
        out[lang] = (low + (at - int(at)) * (found.get((lang, int(at) + 1), low) - low), n)
    return out


def set_all_limits(model: Limits, seen: DataFrame) -> None:
    """Limits as of :func:`set_limits` from a table ``seen(lang, h, n)`` of any size."""
    medians = quantiles(seen.select("lang", F.col("h").alias("x")), 0.5)
    if not medians:
        return
    for lang, (median, _) in medians.items():
        if lang != POOLED:
            model.mean[lang] = median
    means = F.create_map(*[F.lit(x) for k, mean in enumerate(model.mean.tolist()) for x in (k, mean)])
    scale = F.sqrt(F.least(F.col("n"), F.lit(SCATTER)).cast("double"))
    excess = seen.select("lang", ((F.col("h") - F.element_at(means, F.col("lang"))) * scale).alias("x"))
    tops = quantiles(excess, TOP)
    _take_limits(model, medians[POOLED][0], tops[POOLED][0], tops)


def set_limits(model: Limits, seen: pd.DataFrame) -> None:
    """Limits from the entropies ``h`` of texts with ``n`` grams under their language (its place)."""
    if seen.empty:
        return
    lang, h, n = (seen[c].to_numpy() for c in ("lang", "h", "n"))
    for k in np.unique(lang):
        model.mean[k] = np.median(h[lang == k])
    excess = model.scaled_excess(h, n, lang)
    tops = {k: (np.quantile(excess[lang == k], TOP), (lang == k).sum()) for k in np.unique(lang)}
    _take_limits(model, np.median(h), np.quantile(excess, TOP), tops)


def _take_limits(model: Limits, pooled_mean: float, pooled: float, tops: dict[int, tuple[float, int]]) -> None:
    widened = lambda top: 1.5 * max(top, 1.0)
    for k in range(len(model.langs)):
        top, texts = tops.get(k, (pooled, 0))
        if texts >= FEWEST:
            model.limit[k] = widened(top)
        else:
            model.mean[k], model.limit[k] = max(model.mean[k], pooled_mean), widened(pooled)


def predict_language(df: DataFrame, model: Model | Tables, text: str = "text") -> DataFrame:
    """All columns of ``df`` and ``lang_pred, score, entropy, n_letters, accepted``."""
    new = {f.name.lower() for f in OUTPUT}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    if isinstance(model, Tables):
        return _predicted_by_tables(df, model, text, [f.name for f in kept])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, some in groups([t or "" for t in batch.column(text).to_pylist()]):
                part = batch.slice(first, len(some))
                found = shared.value.predict(some)
                columns = [part.column(f.name) for f in kept]
                columns += [pa.array(found[f.name], from_pandas=True) if f.name != "lang_pred" else pa.array(found[f.name], pa.string()) for f in OUTPUT]
                yield pa.RecordBatch.from_arrays(columns, names=[*[f.name for f in kept], *[f.name for f in OUTPUT]])

    return df.mapInArrow(predict, T.StructType([*kept, *OUTPUT]))


def _predicted_by_tables(df: DataFrame, model: Tables, text: str, kept: list[str]) -> DataFrame:
    (row,) = fresh(df, "_row")
    rows = stored(df.withColumn(row, F.monotonically_increasing_id()), "texts")
    texts = rows.select(F.col(row).alias("row"), F.col(f"`{text}`").alias("text"))
    limits = Limits(model.langs)
    limits.mean, limits.limit = model.mean, model.limit
    shared = df.sparkSession.sparkContext.broadcast(limits)
    names = [f.name for f in OUTPUT]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = pc.list_flatten(batch.column("h")).to_numpy().reshape(batch.num_rows, -1)
            # A text without letters is a gap and nothing else: its one gram ends it.
            found = shared.value.judge(batch.column("letters").to_numpy(zero_copy_only=False), h, batch.column("size").to_numpy())
            columns = [pa.array(found[n], from_pandas=True) if n != "lang_pred" else pa.array(found[n], pa.string()) for n in names]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *columns], names=["row", *names])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = with_letters([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(letters)], names=["row", "letters"])

    marked = texts.mapInArrow(mark, "row bigint, letters boolean")
    measured = model.entropies(texts).join(marked, "row")
    schema = T.StructType([T.StructField("row", T.LongType()), *OUTPUT])
    judged = stored(measured.mapInArrow(judge, schema), "judged").withColumnRenamed("row", row)
    return rows.select(*[F.col(f"`{c}`") for c in kept], row).join(judged, row).drop(row)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")


def op2_language_id(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(training_rows(docs))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return predict_language(rows, model).select("doc_id", "held_out", "lang_pred", "score", "entropy", "accepted")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the others go."""
    model = fit(training_rows(docs))
    kept = docs.columns
    renamed = docs.toDF(*[f"c{k}" for k in range(len(kept))])
    named = predict_language(renamed, model, f"c{kept.index('text')}").filter("accepted")
    return named.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(kept)])
