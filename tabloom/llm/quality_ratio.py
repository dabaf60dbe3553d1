"""Quality rules: counts per text, and a hashed n-gram log-likelihood ratio of trusted texts against the whole corpus.

Words and word pairs are hashed to BUCKETS multinomial cells, once over trusted texts and once over all; a text's ratio is the mean
log ratio of its cells. A text is kept if it passes the base rules and its ratio reaches a fixed low quantile of the trusted
texts' own ratios: the same text always gets the same verdict. A fifth of the trusted texts, by hash of the id, gives the threshold
and the others the target cells, all of both; where one side is empty, all trusted texts are on both. Only built-in functions run on
the main path. Edge cases: null, empty and wordless texts have zero counts, ratio 0 and fail the base rule on length; without a
trusted text long enough for the base rules these decide alone; rows of one id are judged one by one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm import common
from tabloom.operators.frames import name

WHITE = r"[\x20\x09-\x0D]+"
WHITE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"
BUCKETS = 1 << 13
#: Rank error of the threshold is one in this many trusted texts.
ACCURACY = 100_000
#: Ids that are broadcast at most, 16 MB of them; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: A long holds 40 bits of a window's hash and its place below this.
PLACES = 1 << 24
#: Share of trusted texts whose ratio lies below the threshold.
LOW = 0.002
LEAST_WORDS, MOST_REPEATED = 50, 50
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio")


def words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(WHITE_CHARS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, WHITE))


def staged(df: DataFrame, **columns: Column) -> DataFrame:
    """`df` with columns worked out once a row: generated rows are a border that the optimiser moves no expression over."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def hashed(df: DataFrame, text: str) -> DataFrame:
    """`df` with own_words and own_hashes, each word's 64-bit hash."""
    own = staged(df, own_words=words(F.coalesce(name(text), F.lit(""))))
    return staged(own, own_hashes=F.transform("own_words", lambda x: F.xxhash64(x)))


def _twins(triples: Column) -> Column:
    """Pairs (i, j) of neighbours in the order of hashes whose windows have 40 hash bits in common; each long holds hash and place."""
    keys = F.sort_array(F.transform(triples, lambda h, i: h.bitwiseAND(F.lit(-PLACES)).bitwiseOR(i.cast("long"))))

    def pairs(k: Column) -> Column:
        n = F.greatest(F.size(k) - 1, F.lit(0))
        place = lambda x: x.bitwiseAND(F.lit(PLACES - 1)).cast("int")
        both = F.zip_with(
            F.slice(k, F.lit(1), n), F.slice(k, F.lit(2), n),
            lambda x, y: F.when(x.bitwiseXOR(y).bitwiseAND(F.lit(-PLACES)) == 0, F.struct(place(x).alias("i"), place(y).alias("j"))),
        )
        return F.filter(both, lambda x: x.isNotNull())

    return F.get(F.transform(F.array(keys), pairs), F.lit(0))


def _covered(places: Column) -> Column:
    """Words in the 3-word windows that start at these places."""
    return F.size(F.array_distinct(F.concat(places, F.transform(places, lambda i: i + 1), F.transform(places, lambda i: i + 2))))


def _repeated(w: Column, twins: Column) -> Column:
    """Words in 3-word windows that occur twice. Where hashes agree but words do not, all windows are compared as texts."""
    unlike = F.exists(twins, lambda x: F.exists(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda k: F.get(w, x["i"] + k) != F.get(w, x["j"] + k)))
    places = F.concat(F.transform(twins, lambda x: x["i"]), F.transform(twins, lambda x: x["j"]))
    starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0)))
    texts = F.sort_array(F.transform(starts, lambda x, i: F.struct(F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2)).alias("t"), i.alias("i"))))

    def compared(ranked: Column) -> Column:
        def beside(k: Column) -> Column:
            return F.coalesce(F.get(ranked, k)["t"], F.lit(" "))  # no window is one blank

        equal = F.transform(ranked, lambda x, k: F.when((x["t"] == beside(k + 1)) | ((k > 0) & (x["t"] == beside(k - 1))), x["i"]))
        return _covered(F.array_compact(equal))

    by_text = F.get(F.transform(F.array(texts), compared), F.lit(0))
    return F.when(F.size(w) >= PLACES, by_text).when(F.size(twins) == 0, 0).when(unlike, by_text).otherwise(_covered(places))


def base_columns(docs: DataFrame, text: str, weights: list[float]) -> DataFrame:
    """All columns of `docs`, the counts, base_failed and ratio."""
    source = F.coalesce(name(text), F.lit(""))
    hashes = F.col("own_hashes")
    triples = F.transform(
        F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - 2, F.lit(0))), lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2))
    )
    lines = F.filter(F.split(source, "\n"), lambda x: F.btrim(x, F.lit(WHITE_CHARS)) != "")
    own = staged(hashed(docs, text), own_twins=_twins(triples), own_lines=lines)
    own = staged(
        own, n_words=F.size("own_words").cast("long"), word_chars=F.length(F.array_join("own_words", "")).cast("long"),
        n_symbols=F.regexp_count(source, F.lit(SYMBOLS)).cast("long"),
        n_dup_lines=(F.size("own_lines") - F.size(F.array_distinct("own_lines"))).cast("long"),
        n_repeat_words=_repeated(F.col("own_words"), F.col("own_twins")).cast("long"), ratio=ratio(hashes, weights),
    ).drop("own_words", "own_hashes", "own_twins", "own_lines")
    return own.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def _cell(h: Column) -> Column:
    return h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def pair_hash(hashes: Column, h: Column, i: Column) -> Column:
    """Hash of a word and the next one; the last word stands alone."""
    return F.xxhash64(h, F.get(hashes, i + 1))


def trusted_ids(labels: DataFrame, id_column: str, label: str) -> DataFrame:
    """Ids labelled 1, and whether their texts are held back for the threshold."""
    good = labels.where(name(label) == 1).select(name(id_column).cast("long").alias("trusted_id")).where("trusted_id IS NOT NULL").distinct()
    return good.withColumn("held", F.pmod(F.xxhash64(F.col("trusted_id").cast("string"), F.lit(5)), F.lit(5)) == 0)


def ratio(hashes: Column, weights: list[float]) -> Column:
    """Mean log ratio over a text's n-grams; rounded so that the sum's last bits decide nothing."""
    # one string that folds to an array, not a literal per cell
    table = F.expr("CAST(split('" + ",".join(map(repr, weights)) + "', ',') AS array<double>)")
    both = F.transform(hashes, lambda h, i: F.get(table, _cell(h)) + F.get(table, _cell(pair_hash(hashes, h, i))))
    total = F.aggregate(both, F.lit(0.0), lambda t, x: t + x)
    return F.when(F.size(hashes) > 0, F.round(total / (2 * F.size(hashes)), 9)).otherwise(0.0)


def learn(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality"
) -> tuple[list[float], float | None]:
    """Log ratios per cell (add-one smoothing) and the threshold; one scan counts every document and the target texts."""
    good = trusted_ids(labels, id_column, label)
    side = F.broadcast(good) if good.count() <= BROADCAST_IDS else good
    own = docs.select(name(id_column).cast("long").alias("trusted_id"), name(text).alias("trusted_text")).join(side, "trusted_id", "left")
    hashes = F.col("own_hashes")
    singles, pairs = F.transform(hashes, _cell_of_word), F.transform(hashes, lambda h, i: _cell(pair_hash(hashes, h, i)))
    exploded = hashed(own, "trusted_text").select("held", F.explode(F.concat(singles, pairs)).alias("cell"))
    counts = exploded.groupBy("cell").agg(
        F.count("*").alias("raw"), F.count_if("held").alias("held"), F.count_if(~F.col("held")).alias("target")
    ).collect()  # BUCKETS rows at most
    sums = {k: sum(r[k] for r in counts) for k in ("raw", "held", "target")}
    if not sums["held"] + sums["target"]:
        return [0.0] * BUCKETS, None
    split = bool(sums["held"] and sums["target"])
    raw = {r["cell"]: r["raw"] for r in counts}
    target = {r["cell"]: r["target"] + (0 if split else r["held"]) for r in counts}
    all_raw, all_target = sums["raw"] + BUCKETS, sum(target.values()) + BUCKETS
    weights = [math.log((target.get(c, 0) + 1) / all_target) - math.log((raw.get(c, 0) + 1) / all_raw) for c in range(BUCKETS)]
    judges = hashed(own.where(F.col("held") if split else F.col("held").isNotNull()), "trusted_text").where(F.size("own_words") >= LEAST_WORDS)
    low = staged(judges, r=ratio(hashes, weights)).agg(F.percentile_approx("r", LOW, ACCURACY).alias("q")).first()["q"]
    if low is None and split:  # no text held back is long enough
        judges = hashed(own.where("held IS NOT NULL"), "trusted_text").where(F.size("own_words") >= LEAST_WORDS)
        low = staged(judges, r=ratio(hashes, weights)).agg(F.percentile_approx("r", LOW, ACCURACY).alias("q")).first()["q"]
    return weights, low


def _cell_of_word(h: Column) -> Column:
    return _cell(h)


def judge(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of `docs`, the base counts, base_failed, ratio and kept."""
    weights, low = learn(docs, labels, id_column, text)
    based = base_columns(common.nested(docs, text), "own_text", weights)
    good = F.lit(True) if low is None else F.col("ratio") >= low
    based = based.withColumn("kept", ~F.col("base_failed") & good)
    return common.unnested(based, docs, *[F.col(c) for c in RESULTS], names=RESULTS)


def report(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, counts, base_failed, kept, ratio)."""
    judged = judge(docs.select(name(id_column).alias(id_column), name(text).alias(text)), labels, id_column, text)
    return judged.select(id_column, *RESULTS)
