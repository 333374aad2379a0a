"""Quality classifier: interpolated modified Kneser-Ney word models and count joins.

* Tokens are the words between white space, A-Z lower-cased; a word is known by its
  64-bit hash and a pair of words by the hash of both.
* The model is fitted on trusted text: all documents labelled quality 1 and not toxic.  A
  second model of the same kind is fitted on rejected text: all of quality 0 or toxic.
  (A caller may ask for a sample of about ``most`` of each; the query does not.)
* Trusted documents set the bars, so none is judged by a model that has seen it: they fall
  into ``FOLDS`` folds by a hash of the id, the counts are kept per fold, and a trusted
  document's values are those of the model without its fold.  All others have the whole model's.
* Pair counts, continuation counts and context sums are Spark tables sharded by pair and
  by word; discounted probabilities and back-off weights come from joins of a pair's
  count with its context's sums.  Pairs seen once are left to the lower order, the usual
  cut-off of the highest order (``MIN_PAIR``): their mass goes to the context's back-off.
* A document's words are joined with these tables.  Its perplexity is that of its words
  under the trusted model; few words say little, so the mean code length is drawn
  towards the language's trusted mean by ``PRIOR`` words.  Its peak is the largest
  log10 ratio of a word's continuation probabilities in the rejected and the trusted
  model (after how many different words it stands, so a passage that is often copied
  weighs once): one abusive word in a long text moves no mean, but it is a peak.
* Per language, the bars are quantiles of the trusted documents' values plus a margin;
  languages with under ``MIN_LANG`` trusted documents use those of all.  A document over
  a bar is rejected.

A text's code length is a sum of values of its words and of its pairs (``Lookup``).  The most
frequent rows of these tables are broadcast: ``MAX_ROWS`` / 2 words and 4 ``MAX_ROWS`` pairs at most.
For the others a bit tells most keys that no table has; what is left, a row per occurrence, is joined
with its table and summed per text.  Tables and shuffle files that no later step reads are deleted.

Defined results: null and empty texts have no words and a perplexity at their
language's mean, so they are kept; null languages are one language; without trusted
text everything is kept, without rejected text no word is a peak; several labels of
one document count once; every row gives one row, also rows that repeat; other columns
are ignored (``accepted`` keeps them).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, lower_ascii, packed, scratch, shuffles_dropped, split_words, stored, table

TRAIN_SHARE, MIN_PAIR = 0.5, 2
FOLDS = 2
PRIOR = 30.0
QUANTILE = 0.995
MARGIN, PEAK_MARGIN = 0.03, 0.2         # in log10 per word, in log10
MIN_LANG = 50
MAX_LANGS = 10_000
MAX_ROWS, MAX_IDS, MAX_BITS = 600_000, 2_000_000, 1 << 30
LEAST = 1e-15           # of a probability or weight whose logarithm is taken


def good_ids(labels: DataFrame) -> DataFrame:
    """doc_id of every trusted document."""
    return (labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
            .where("q = 1 and t = 0").select("doc_id"))


def bad_ids(labels: DataFrame) -> DataFrame:
    """doc_id of every rejected document."""
    return labels.where("doc_id is not null and (quality = 0 or toxic = 1)").select("doc_id").distinct()


def trusted_ids(good: DataFrame, most: int, share: float = TRAIN_SHARE) -> DataFrame:
    """doc_id of a sample, for callers that bound the model: those of ``good`` whose hash is in the share that leaves
    about ``most``, at most ``share``."""
    n = good.count()
    cut = min(share, most / max(n, 1))
    return good.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < round(cut * 1_000_003))


def word_pairs(text: Column) -> Column:
    """(prev, w): the hash of every word and of the word before it, 0 before the first."""
    words = F.transform(split_words(lower_ascii(text)), lambda w: F.xxhash64(w))
    return F.arrays_zip(F.concat(F.array(F.lit(0).cast("bigint")), words).alias("prev"), F.concat(words, F.array(F.lit(None).cast("bigint"))).alias("w"))


def pair_key(prev: Column, w: Column) -> Column:
    return F.xxhash64(prev, w)


def exploded(rows: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and (prev, w) for every word of ``text``; the pair behind the last word has a null w."""
    return rows.select(*keep, F.explode(word_pairs(F.col("text"))).alias("pair")).select(*keep, F.col("pair.prev").alias("prev"), F.col("pair.w").alias("w"))


def fold(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit("fold")), F.lit(FOLDS)).cast("int")


def _discounts(counts: DataFrame, names: list[str]) -> list[Column]:
    """Modified Kneser-Ney discount of each of the counts ``names``, from how many of them are 1, 2, 3, 4."""
    found = counts.agg(*(F.count(F.when(F.col(n) == c, 1)) for n in names for c in (1, 2, 3, 4))).first()
    out = []
    for k, n in enumerate(names):
        n1, n2, n3, n4 = found[4 * k: 4 * k + 4]
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        d = [max(0.0, min(c, c - (c + 1) * y * b / a if a else 0.75 * c / (c + 1))) for c, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        out.append(F.when(F.col(n) == 0, 0.0).when(F.col(n) == 1, d[0]).when(F.col(n) == 2, d[1]).otherwise(d[2]))
    return out


class Model:
    """``words`` (w, n, uni, back), ``pairs`` (key, w, n, p, back) and the probability of an unknown
    word; with folds also the columns uni_0, back_0, p_0 ... of the models without one fold, and
    ``without``, their probabilities of an unknown word.  n counts occurrences."""

    def __init__(self, words: DataFrame, pairs: DataFrame | None, unknown: float, without: list[float]):
        self.words, self.pairs, self.unknown, self.without = words, pairs, unknown, without


def kneser_ney(texts: DataFrame, least: int = MIN_PAIR, folder: str | None = None, lower_only: bool = False) -> Model:
    """The interpolated model of order 2 of ``texts``, with pairs from ``least`` occurrences on; if
    ``texts`` have a fold, also the models without one.  ``lower_only``: just the words' uni."""
    folder = folder or scratch(texts.sparkSession, "kneser-ney")
    folds = range(FOLDS) if "fold" in texts.columns else range(0)
    ends = ["", *(f"_{f}" for f in folds)]
    counts = exploded(texts, *["fold"] * bool(folds)).where("w is not null").groupBy("prev", "w")
    if folds:       # the folds' counts share a number in the shuffle
        bits = 62 // FOLDS
        counts = counts.agg(F.sum(F.when(F.col("fold") == 0, F.lit(1)).otherwise(F.lit(1 << bits))).alias("packed"))
        one = [F.shiftright("packed", bits * f).bitwiseAND(F.lit((1 << bits) - 1)) for f in folds]
        every = sum(one[1:], one[0])
        counts = counts.select("prev", "w", every.alias("n"), *((every - x).alias(f"n_{f}") for f, x in zip(folds, one, strict=True)))
    else:
        counts = counts.agg(F.count(F.lit(1)).alias("n"))
    # the lower order counts the distinct words in front
    ahead = [F.count(F.when(F.col(f"n{e}") > 0, 1)).alias(f"a{e}") for e in ends]
    if lower_only:
        follows = stored(counts.groupBy("w").agg(*ahead), "continuations", folder)
    else:
        counts = stored(counts.select("prev", "w", *(F.col(f"n{e}").cast("long").alias(f"n{e}") for e in ends)).sortWithinPartitions("prev"), "pair-counts", folder)     # in order it is a fifth smaller
        follows = stored(counts.groupBy("w").agg(*ahead), "continuations", folder)
    less = dict(zip(ends, _discounts(follows, [f"a{e}" for e in ends]), strict=True))
    sums = follows.agg(*(c for e in ends for c in (F.sum(f"a{e}"), F.sum(less[e]), F.count(F.when(F.col(f"a{e}") > 0, 1))))).first()
    unknown, uni = {}, []
    for k, e in enumerate(ends):
        total, rest, size = sums[3 * k: 3 * k + 3]
        unknown[e] = rest / total / (size + 1) if total else 1.0
        # a word that only the missing fold has is unknown
        uni.append(F.when(F.col(f"a{e}") > 0, (F.col(f"a{e}") - less[e]) / (total or 1) + unknown[e]).alias(f"uni{e}"))
    without = [unknown[e] for e in ends[1:]]
    if lower_only:
        return Model(follows.select("w", *uni), None, unknown[""], without)
    taken = dict(zip(ends, _discounts(counts, [f"n{e}" for e in ends]), strict=True))
    named = {e: F.col(f"n{e}") >= least for e in ends}
    contexts = stored(counts.groupBy("prev").agg(*(c for e in ends for c in (
        F.sum(f"n{e}").alias(f"all{e}"), F.sum(F.when(named[e], taken[e]).otherwise(F.col(f"n{e}"))).alias(f"taken{e}")))), "contexts", folder)
    back = [F.when(F.col(f"all{e}") > 0, F.col(f"taken{e}") / F.col(f"all{e}")).alias(f"back{e}") for e in ends]
    pairs = (counts.where(named[""]).join(contexts, "prev")
             .select(pair_key(F.col("prev"), F.col("w")).alias("key"), "w", "n", *(F.when(named[e], (F.col(f"n{e}") - taken[e]) / F.col(f"all{e}")).alias(f"p{e}") for e in ends), *back))
    words = follows.select("w", *uni).join(contexts.select(F.col("prev").alias("c"), F.col("all").alias("n"), *back), F.col("w") == F.col("c"), "full_outer")
    return Model(words.select(F.coalesce("w", "c").alias("w"), F.coalesce("n", F.lit(0)).alias("n"), *(f"{x}{e}" for x in ("uni", "back") for e in ends)), pairs, unknown[""], without)


def train(docs: DataFrame, good: DataFrame, bad: DataFrame, most: int | None = None, folder: str | None = None) -> tuple[Model, Model]:
    """The models of the trusted documents, with folds, and of the rejected (its words only); of
    samples of about ``most`` if that is given."""
    folder = folder or scratch(docs.sparkSession, "quality-models")

    def texts(ids: DataFrame) -> DataFrame:
        rows = docs.where("text is not null").select(F.col("doc_id"), "text")
        return rows.join(_few(ids.select(F.col("doc_id").alias("d"))), F.col("doc_id") == F.col("d"), "left_semi").select(fold(F.col("doc_id")).alias("fold"), "text")

    if most is not None:
        good, bad = stored(trusted_ids(good, most), "trusted-ids", folder), stored(trusted_ids(bad, most, 1.0), "rejected-ids", folder)
    return kneser_ney(texts(good), folder=f"{folder}/trusted"), kneser_ney(texts(bad).drop("fold"), folder=f"{folder}/rejected", lower_only=True)


def _few(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= MAX_IDS else ids


class Lookup:
    """Both models as one table of parts of a text's code length, which are sums over its words and pairs:
    ``words`` (key, n, u, b, low) and ``pairs`` (key, n, u).  u: log10 of a word's probability less that of
    an unknown word, of a pair what its own count adds; b: log10 of the back-off weight of a word in front;
    low: log10 of the word's probability in the rejected model.  With folds also u_0, b_0 ... under the
    models without one."""

    def __init__(self, good: Model, bad: Model):
        self.spark = good.words.sparkSession
        self.folder = folder = scratch(self.spark, "quality-lookup")
        self.ends = ["", *(f"_{f}" for f in range(len(good.without)))]
        self.unknown = [max(x, LEAST) for x in (good.unknown, *good.without)]
        self.unknown_bad = max(bad.unknown, LEAST)
        unknown = dict(zip(self.ends, self.unknown, strict=True))
        b = bad.words.where("uni is not null").select(F.col("w").alias("bw"), F.col("uni").alias("b_uni"))
        words = good.words.join(b, F.col("w") == F.col("bw"), "full_outer")
        uni = {e: F.greatest(F.coalesce(f"uni{e}", F.lit(x)), F.lit(LEAST)) for e, x in unknown.items()}
        back = {e: F.greatest(F.coalesce(f"back{e}", F.lit(1.0)), F.lit(LEAST)) for e in self.ends}
        lower_bad = F.greatest(F.coalesce("b_uni", F.lit(self.unknown_bad)), F.lit(LEAST))
        self.words = stored(words.select(
            F.coalesce("w", "bw").alias("key"), F.coalesce("n", F.lit(0)).cast("long").alias("n"), *(F.log10(uni[e] / x).alias(f"u{e}") for e, x in unknown.items()),
            *(F.log10(back[e]).cast("float").alias(f"b{e}") for e in self.ends), F.log10(lower_bad).alias("low")), "words", folder)
        own = good.words.select(F.col("w").alias("own"), *(f"uni{e}" for e in self.ends))
        self.pairs = stored(good.pairs.join(own, F.col("w") == F.col("own")).select(
            "key", F.col("n").cast("long").alias("n"), *(F.log10(1 + F.coalesce(f"p{e}", F.lit(0.0)) / (back[e] * uni[e])).cast("float").alias(f"u{e}") for e in self.ends)), "pairs", folder)

    def close(self) -> None:
        discard(self.spark, self.folder)


def head(rows: DataFrame, most: int) -> tuple[dict, DataFrame]:
    """(columns, the other rows): at most ``most`` rows, the most frequent, as numpy arrays in order of the key."""
    size = F.floor(8 * F.log2(F.col("n") + 1))      # classes of the counts: some hundred rows
    classes = sorted(((r["size"], r["rows"]) for r in rows.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("rows")).collect()), reverse=True)
    least, total = 1 << 30, 0
    for k, x in classes:
        total += x
        if total > most:
            break
        least = k
    top = rows.where(size >= least).drop("n").toArrow()
    order = np.argsort(top.column("key").to_numpy())
    return {c: top.column(c).to_numpy()[order] for c in top.column_names}, rows.where(size < least).drop("n")


def marked(rows: DataFrame) -> np.ndarray:
    """A bit for each value that the low bits of ``rows.key`` take, so that most absent keys are told
    without a join.  About 16 bits a key, at most MAX_BITS in all: beyond that more keys meet the join."""
    n = rows.count()
    size = min(MAX_BITS, max(1 << 15, 1 << (16 * n).bit_length()))
    at = F.col("key").bitwiseAND(F.lit(size - 1)) + 1
    found = rows.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).toArrow()
    bits = np.zeros(size // 8, np.uint8)
    for k, x in zip(found.column("bucket").to_pylist(), found.column("bits"), strict=True):
        part = np.frombuffer(x.as_buffer(), np.uint8)
        bits[(k - 1) << 12: ((k - 1) << 12) + len(part)] = part[:size // 8]
    return bits


def sums(docs: DataFrame, found: Lookup, folder: str) -> DataFrame:
    """The columns of ``docs`` but its text, and n_words, length and peak of every row under the model
    that its ``model`` names: 0 the whole one, f + 1 the one without fold f.  The head of the table is
    broadcast; for what else the table may have a row per occurrence is joined with it, from ``folder``.
    Discards the tables of ``found``."""
    words, other_words = head(found.words, MAX_ROWS // 2)
    pairs, other_pairs = head(found.pairs, 4 * MAX_ROWS)        # a quarter as wide
    other = stored(other_words.unionByName(other_pairs, allowMissingColumns=True), "less-frequent", folder)
    start = found.words.where("key = 0").select(*(f"b{e}" for e in found.ends)).first()
    unknown, low = [float(np.log10(x)) for x in found.unknown], float(np.log10(found.unknown_bad))
    held = docs.sparkSession.sparkContext.broadcast({"words": words, "pairs": pairs, "bits": marked(other), "ends": found.ends, "unknown": np.array(unknown), "low": low,
                                                     "start": np.array([x or 0.0 for x in (start or [0.0] * len(found.ends))])})
    del words, pairs
    found.close()
    kept = [c for c in docs.columns if c != "text"]
    hashes = docs.select(*kept, F.monotonically_increasing_id().alias("rid"), F.transform(split_words(lower_ascii(F.col("text"))), lambda w: F.xxhash64(w)).alias("words"))
    hashes = hashes.withColumn("pairs", F.zip_with(F.slice(F.concat(F.array(F.lit(0).cast("bigint")), "words"), F.lit(1), F.size("words")), "words", pair_key))

    def run(batches):
        h = held.value

        def seek(table_, keys):
            at = np.minimum(np.searchsorted(table_["key"], keys), max(len(table_["key"]) - 1, 0))
            hit = table_["key"][at] == keys if len(table_["key"]) else np.zeros(len(keys), bool)
            low = keys & (len(h["bits"]) * 8 - 1)
            return at, hit, ~hit & ((h["bits"][low >> 3] >> (low & 7).astype(np.uint8)) & 1).astype(bool)

        def valued(table_, name, at, models):
            out = table_[name][at]
            for k, e in enumerate(h["ends"][1:], 1):
                if (m := models == k).any():
                    out[m] = table_[f"{name}{e}"][at[m]]
            return out

        def summed(b):
            n = np.diff(b.column("words").offsets.to_numpy())
            docs_, ends = np.arange(len(n)), np.cumsum(n)
            doc, model = np.repeat(docs_, n), b.column("model").to_numpy()
            which, full = np.repeat(model, n), n > 0
            keys = b.column("words").flatten().to_numpy()
            at, hit, maybe = seek(h["words"], keys)
            last = np.zeros(len(keys), bool)
            last[ends[full] - 1] = True
            value, ratio = np.zeros(len(keys)), h["low"] - h["unknown"][which]
            at, of = at[hit], which[hit]
            u = valued(h["words"], "u", at, of)
            value[hit] = u + np.where(last[hit], 0.0, valued(h["words"], "b", at, of))
            ratio[hit] = h["words"]["low"][at] - u - h["unknown"][of]
            ratio[maybe] = -np.inf      # the join tells
            pair = b.column("pairs").flatten().to_numpy()
            at, hit, maybe_pair = seek(h["pairs"], pair)
            value[hit] += valued(h["pairs"], "u", at[hit], which[hit])
            length = -np.bincount(doc, value, len(n)) - n * h["unknown"][model] - full * h["start"][model]
            peak = np.full(len(n), -np.inf)
            if full.any():
                peak[full] = np.maximum.reduceat(ratio, (ends - n)[full])
            # a row of the document itself, its last word if asked for, other words, pairs
            own = (b.column("rid").to_numpy().astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            ask = [(docs_, own.view(np.int64)), *((doc[m], x[m]) for m, x in ((maybe & last, keys), (maybe & ~last, keys), (maybe_pair, pair)))]
            order = np.argsort(np.concatenate([4 * d + k for k, (d, _) in enumerate(ask)]), kind="stable")
            asked = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sum(np.bincount(d, minlength=len(n)) for d, _ in ask))]).astype(np.int32), np.concatenate([x for _, x in ask])[order])
            return pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), b.column("rid"), pa.array(n.astype(np.int64)), pa.array(length), pa.array(peak),
                                               pa.array(np.bincount(doc[maybe & last], minlength=len(n)) > 0), pa.array(np.bincount(doc[maybe], minlength=len(n))), asked],
                                              [*kept, "rid", "n_words", "length", "peak", "asks_last", "n_asked", "keys"])

        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                yield summed(batch.slice(k, 500))

    more = T._parse_datatype_string("rid bigint, n_words bigint, length double, peak double, asks_last boolean, n_asked bigint, keys array<bigint>")
    out = hashes.mapInArrow(run, T.StructType([*docs.select(*kept).schema.fields, *more.fields]))
    own = F.struct(*kept, "n_words", "length", "peak")
    asked = (out.select("rid", "model", "asks_last", "n_asked", own.alias("own"), F.posexplode("keys").alias("pos", "asked"))
             .select("rid", "asked", F.col("model").cast("byte").alias("model"), F.col("pos").between(1, F.col("n_asked")).alias("word"),
                     (F.col("asks_last") & (F.col("pos") == 1)).alias("last"), F.when(F.col("pos") == 0, F.col("own")).alias("own")))

    def chosen(values: list) -> Column:
        value = values[0]
        for k, x in enumerate(values[1:], 1):
            value = F.when(F.col("model") == k, x).otherwise(value)
        return value

    u, b = (F.coalesce(chosen([F.col(f"{x}{e}") for e in found.ends]), F.lit(0.0)) for x in "ub")
    ratio = F.when(F.col("word"), F.coalesce("low", F.lit(low)) - u - chosen([F.lit(x) for x in unknown]))
    rows = (asked.join(other, F.col("asked") == F.col("key"), "left")
            .select("rid", "own", (u + F.when(F.col("last"), 0.0).otherwise(b)).alias("more"), F.coalesce("own.peak", ratio).alias("ratio")))
    each = rows.groupBy("rid").agg(F.first("own", ignorenulls=True).alias("own"), F.sum("more").alias("more"), F.max("ratio").alias("peak"))
    return each.select(*(F.col(f"own.{c}") for c in kept), "own.n_words", (F.col("own.length") - F.col("more")).alias("length"), F.when(F.col("own.n_words") > 0, F.col("peak")).alias("peak"))


def measured(docs: DataFrame) -> DataFrame:
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return docs.select("doc_id", F.xxhash64("text").alias("tie"), "lang", size.alias("n_bytes"), "text")


def code_lengths(docs: DataFrame, good: Model, bad: Model) -> DataFrame:
    """(doc_id, tie, lang, n_bytes, n_words, length, peak) of every row; the length is in decimal
    digits under the trusted model.  With folds also length_0, peak_0 ... without one."""
    found = Lookup(good, bad)
    rows = measured(docs).withColumn("row", F.monotonically_increasing_id())
    each = sums(rows.withColumn("model", F.explode(F.array(*(F.lit(k) for k in range(len(found.ends)))))), found, scratch(docs.sparkSession, "quality-others"))
    values = [F.max(F.when(F.col("model") == k, F.col(x))).alias(f"{x}{e}") for k, e in enumerate(found.ends) for x in ("length", "peak")]
    return each.groupBy("row", "doc_id", "tie", "lang", "n_bytes", "n_words").agg(*values).drop("row")


def bars(lengths: DataFrame, good: DataFrame) -> DataFrame:
    """(lang, mean, bar, peak_bar) of languages with enough trusted documents, and a row of
    all (``whole``), from the code lengths of every trusted document."""
    each = stored(lengths.where("n_words > 0").join(good, "doc_id", "left_semi").select("lang", "n_words", "length", "peak"), "trusted-lengths")
    mean = lambda *by: each.groupBy(*by).agg((F.sum("length") / F.sum("n_words")).alias("mean"), F.count("*").alias("n"))
    by_lang = mean("lang").where(F.col("n") >= MIN_LANG).select(F.col("lang").alias("__l"), "mean")
    drawn = (F.col("length") + PRIOR * F.col("mean")) / (F.col("n_words") + PRIOR)
    high = F.expr(f"percentile_approx(drawn, {QUANTILE}, 10000)")
    highest = F.expr(f"percentile_approx(peak, {QUANTILE}, 10000)") + PEAK_MARGIN
    by_lang = stored(by_lang, "trusted-means")
    by_lang = F.broadcast(by_lang) if by_lang.count() <= MAX_LANGS else by_lang
    langs = (each.join(by_lang, F.col("lang").eqNullSafe(F.col("__l"))).withColumn("drawn", drawn)
             .groupBy("lang", "mean").agg((high + MARGIN).alias("bar"), highest.alias("peak_bar")).withColumn("whole", F.lit(False)))
    every = each.withColumn("mean", F.lit(_first(mean().select("mean"))))
    return langs.unionByName(every.withColumn("drawn", drawn).groupBy("mean").agg((high + MARGIN).alias("bar"), highest.alias("peak_bar"))
                             .withColumn("lang", F.lit(None).cast("string")).withColumn("whole", F.lit(True)))


def _first(df: DataFrame):
    row = df.first()
    return float(row[0]) if row and row[0] is not None else 0.0


def classify(docs: DataFrame, labels: DataFrame, most: int | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, tie, lang, n_bytes, n_words, perplexity (of a word) and its bar,
    peak (0 without words) and its bar, kept."""
    docs = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    good, bad = stored(good_ids(labels), "good"), stored(bad_ids(labels), "bad")
    spark = docs.sparkSession
    trained, folder = scratch(spark, "quality-models"), scratch(spark, "quality-others")
    with shuffles_dropped(spark):
        found = Lookup(*train(docs, good, bad, most, trained))
        discard(spark, trained)
        judged = measured(docs).join(_few(good.select(F.col("doc_id").alias("__d"))), F.col("doc_id") == F.col("__d"), "left")
        judged = judged.withColumn("model", F.when(F.col("__d").isNull(), 0).otherwise(fold(F.col("doc_id")) + 1)).drop("__d")
        lengths = stored(sums(judged, found, folder).drop("model"), "code-lengths")
        discard(spark, folder)
    table_ = stored(bars(lengths, good), "bars")        # a row per language
    whole = table_.where("whole").first()
    mean, bar, top = (whole["mean"], whole["bar"], whole["peak_bar"]) if whole and whole["bar"] is not None else (0.0, float("inf"), float("inf"))
    langs = table_.where("not whole and bar is not null").select(F.col("lang").alias("__l"), F.col("mean").alias("__m"), F.col("bar").alias("__b"), F.col("peak_bar").alias("__p"))
    langs = F.broadcast(langs) if langs.count() <= MAX_LANGS else langs
    d = lengths.join(langs, F.col("lang").eqNullSafe(F.col("__l")), "left")
    value = (F.col("length") + PRIOR * F.coalesce("__m", F.lit(mean))) / (F.col("n_words") + PRIOR)
    peak, top = F.coalesce("peak", F.lit(0.0)), F.coalesce("__p", F.lit(top))
    over = (value > F.coalesce("__b", F.lit(bar))) | ((F.col("n_words") > 0) & (peak > top))
    return d.select("doc_id", "tie", "lang", "n_bytes", "n_words", F.pow(F.lit(10.0), value).alias("perplexity"), F.pow(F.lit(10.0), F.coalesce("__b", F.lit(bar))).alias("bar"),
                    peak.alias("peak"), top.alias("peak_bar"), (~over).alias("kept"))


def accepted(docs: DataFrame, labels: DataFrame, most: int | None = None) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns."""
    gone = stored(classify(docs, labels, most).where("not kept").select("doc_id", "tie").distinct(), "not-kept")
    rows = packed(docs, k=F.col("doc_id"), t=F.xxhash64("text"))
    return rows.join(_few(gone), F.col("k").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("tie")), "left_anti").select("row.*")


def op8_quality_classifier(spark, sf_dir):
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("tie")
