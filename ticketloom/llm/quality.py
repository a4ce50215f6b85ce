"""Quality rules: base limits, then robust outliers by minimum covariance determinants.

For each language and source the centre and scatter of transformed statistics are estimated from the
half of the documents that lies closest (deterministic starts, then concentration steps until no determinant falls), and documents
beyond a chi-square quantile of the squared Mahalanobis distance are rejected. A concentration step is
one grouped aggregate: documents fall into bins of log distance, each bin carries sums and products,
and the bins that hold the closest half give the next centre and scatter. Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm.frames import staged
from ticketloom.llm.wordarrays import map_texts

MIN_WORDS = 50
#: Fewer rows than this are pooled: a source with its language, then a language with the other small ones, then all of these with all rows.
MIN_GROUP = 200
#: Steps end when no log determinant falls by more than this, as a rule within ten.
SETTLED, MOST_STEPS = 1e-9, 50
#: As many rows as the floors' scatter counts for in an estimate; it matters in groups of a few rows only.
PRIOR_ROWS = 2.0
#: Rows that a start's scatter is said to come from: so many that nothing is added to it.
CERTAIN = 1e9
#: Share of documents that the limit would reject if all were normal.
TAIL = 1e-5

#: Transformed statistics and the least standard deviation that each is given: an estimate below it counts as singular.
STATISTICS = (("size", 0.5), ("length", 0.06), ("symbols", 0.025), ("lines", 0.08), ("repeats", 0.08), ("upper", 0.03))
D = len(STATISTICS)
X = [f"x{i}" for i in range(D)]
PAIRS = list(combinations_with_replacement(range(D), 2))
SYMBOLS = b"#*$%&|<>"
BINS = 16  # per unit of log distance


def counts(text: str | None) -> tuple[int, int, int, int, int, int, int]:
    """words, word_chars, symbols, duplicate lines, repeated words, lines with a word, capitals."""
    text = text or ""
    raw = text.encode()
    w = raw.split()
    seen: set[bytes] = set()
    lines = dups = 0
    for line in raw.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                dups += 1
            else:
                seen.add(line)
    repeated = 0
    triples = list(zip(w, w[1:], w[2:], strict=False))
    if len(set(triples)) < len(triples):
        first: dict[tuple, int] = {}
        again = np.zeros(len(w) + 1, np.int64)
        for k, t in enumerate(triples):
            if (at := first.setdefault(t, k)) != k:
                again[at : at + 3] = 1
                again[k : k + 3] = 1
        repeated = int(again.sum())
    chars = len(text) - sum(raw.count(b) for b in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
    symbols = sum(raw.count(bytes([b])) for b in SYMBOLS)
    upper = int(np.count_nonzero((np.frombuffer(raw, np.uint8) - np.uint8(65)) < 26))
    return len(w), chars, symbols, dups, repeated, lines, upper


def text_statistics(docs: DataFrame, id_col: str, text_col: str, group_cols: list[str]) -> DataFrame:
    """Per row: id, the group columns as text, the counts."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.array([counts(t) for t in batch.column(1).to_pylist()], np.int64).reshape(-1, len(names))
        keep = [batch.column(0), *[batch.column(2 + k) for k in range(len(group_cols))]]
        return pa.RecordBatch.from_arrays(keep + [pa.array(rows[:, k]) for k in range(len(names))],
                                          names=["id", *[f"g{k}" for k in range(len(group_cols))], *names])

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"),
                         *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")).alias(f"g{k}") for k, c in enumerate(group_cols)])
    schema = f"id {kind}, " + ", ".join(f"g{k} string" for k in range(len(group_cols))) + ", " + ", ".join(f"{n} bigint" for n in names)
    return map_texts(chosen, run, schema)


def transformed() -> list[Column]:
    share = lambda a, b: F.asin(F.sqrt(F.least(F.lit(1.0), F.col(a) / F.greatest(F.col(b), F.lit(1)))))
    return [
        F.log(F.greatest("n_words", F.lit(1))).alias("x0"),
        F.log(F.greatest(F.col("word_chars") / F.greatest("n_words", F.lit(1)), F.lit(0.5))).alias("x1"),
        share("n_symbols", "word_chars").alias("x2"), share("n_dup_lines", "n_lines").alias("x3"),
        share("n_repeat_words", "n_words").alias("x4"), share("n_upper", "word_chars").alias("x5"),
    ]


def chi2_quantile(p: float, d: int) -> float:
    """Quantile of the chi-square distribution by bisection of its series."""
    def below(x: float) -> float:
        term = total = 1.0 / (d / 2)
        k = d / 2
        while term > total * 1e-15:
            k += 1
            term *= x / 2 / k
            total += term
        return float(total * np.exp(-x / 2 + d / 2 * np.log(x / 2) - log_gamma(d / 2)))

    lo, hi = 1e-9, 20.0 * d + 200
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return (lo + hi) / 2


def log_gamma(x: float) -> float:
    from math import lgamma

    return lgamma(x)


def distance2() -> Column:
    """Squared Mahalanobis distance of x to the centre m under the inverse scatter p."""
    terms = [(1 if i == j else 2) * F.col(f"p{i}_{j}") * (F.col(f"x{i}") - F.col(f"m{i}")) * (F.col(f"x{j}") - F.col(f"m{j}")) for i, j in PAIRS]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return F.greatest(out, F.lit(0.0))


MODEL = ("grp string, start int, logdet double, scale double, " + ", ".join(f"m{i} double" for i in range(D)) + ", "
         + ", ".join(f"p{i}_{j} double" for i, j in PAIRS))


def model_names() -> list[str]:
    return [c.split()[0] for c in MODEL.split(", ")]


FLOORS = np.array([f for _, f in STATISTICS])


def floored(cov: np.ndarray, n: float) -> np.ndarray:
    """A scatter whose variances are at least the floors' and in which they count as much as PRIOR_ROWS rows."""
    full = (cov * n + np.diag(FLOORS**2) * PRIOR_ROWS) / (n + PRIOR_ROWS)
    return full + np.diag(np.maximum(FLOORS**2 - np.diag(full), 0)) + np.diag(FLOORS**2) * 1e-3


def to_model(sums: DataFrame) -> DataFrame:
    """Centre, inverse scatter and log determinant from n, sums and products; `scale` widens the scatter."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batches:
            out = []
            for r in f.to_dict("records"):
                mean = np.array([r[f"s{i}"] for i in range(D)]) / r["n"]
                cov = np.zeros((D, D))
                for i, j in PAIRS:
                    cov[i, j] = cov[j, i] = r[f"q{i}_{j}"] / r["n"] - mean[i] * mean[j]
                inverse = np.linalg.inv(floored(cov * r["scale"], r["n"]))
                out.append([r["grp"], r["start"], float(np.linalg.slogdet(floored(cov, r["n"]))[1]), r["scale"], *mean, *[inverse[i, j] for i, j in PAIRS]])
            yield pd.DataFrame(out, columns=model_names())

    return sums.mapInPandas(run, MODEL)


def first_models(stats: DataFrame) -> DataFrame:
    """Two starts per group: medians with absolute deviations, and the scatter of tanh scores about them."""
    long = stats.select("grp", F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col(f"x{i}").alias("x")) for i in range(D)])).alias("e")) \
        .select("grp", "e.k", "e.x")
    # values to a thousandth with their counts, so that a large group is only as long as its range
    binned = staged(long.groupBy("grp", "k", F.round("x", 3).alias("v")).agg(F.count("*").alias("n")), "values")
    centre = middle(binned)
    off = binned.join(centre, ["grp", "k"]).select("grp", "k", F.round(F.abs(F.col("v") - F.col("mid")), 3).alias("v"), "n")
    spread = middle(off.groupBy("grp", "k", "v").agg(F.sum("n").alias("n")))
    wide = lambda t, p: t.groupBy("grp").agg(*[F.max(F.when(F.col("k") == i, F.col("mid"))).alias(f"{p}{i}") for i in range(D)])
    both = wide(centre, "c").join(wide(spread, "w"), "grp")
    both = staged(both.select("grp", *[f"c{i}" for i in range(D)], *[F.greatest(F.col(f"w{i}") * 1.4826, F.lit(float(FLOORS[i]) / 4)).alias(f"w{i}") for i in range(D)]), "starts")
    plain = both.select("grp", F.lit(0).alias("start"), F.lit(CERTAIN).alias("n"), F.lit(1.0).alias("scale"), *[(F.col(f"c{i}") * CERTAIN).alias(f"s{i}") for i in range(D)],
                        *[((F.col(f"c{i}") * F.col(f"c{j}") + (F.col(f"w{i}") ** 2 if i == j else 0.0)) * CERTAIN).alias(f"q{i}_{j}") for i, j in PAIRS])
    z = stats.join(both, "grp").select("grp", *[F.tanh((F.col(f"x{i}") - F.col(f"c{i}")) / F.col(f"w{i}")).alias(f"z{i}") for i in range(D)])
    moments = z.groupBy("grp").agg(F.count("*").cast("double").alias("z_n"), *[F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"t{i}_{j}") for i, j in PAIRS]).join(both, "grp")
    bent = moments.select("grp", F.lit(1).alias("start"), F.lit(CERTAIN).alias("n"), F.lit(1.0).alias("scale"), *[(F.col(f"c{i}") * CERTAIN).alias(f"s{i}") for i in range(D)],
                          *[((F.col(f"c{i}") * F.col(f"c{j}") + F.col(f"t{i}_{j}") / F.col("z_n") * F.col(f"w{i}") * F.col(f"w{j}") * 2) * CERTAIN).alias(f"q{i}_{j}") for i, j in PAIRS])
    return to_model(plain.unionByName(bent))


def middle(binned: DataFrame) -> DataFrame:
    """Median of each group and statistic from values with their counts."""
    w = Window.partitionBy("grp", "k")
    run = binned.withColumn("upto", F.sum("n").over(w.orderBy("v"))).withColumn("all", F.sum("n").over(w))
    return run.where(F.col("upto") * 2 >= F.col("all")).groupBy("grp", "k").agg(F.min("v").alias("mid"))


def concentrate(stats: DataFrame, models: DataFrame) -> DataFrame:
    """One step: the model of the closest half of each group, and the scale that makes its rim normal."""
    near = stats.join(models.select("grp", "start", *[f"m{i}" for i in range(D)], *[f"p{i}_{j}" for i, j in PAIRS]), "grp")
    near = near.withColumn("bin", F.floor(F.log(distance2() + 1e-6) * BINS))
    bins = near.groupBy("grp", "start", "bin").agg(
        F.count("*").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(D)], *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}_{j}") for i, j in PAIRS])
    w = Window.partitionBy("grp", "start")
    bins = bins.withColumn("before", F.sum("n").over(w.orderBy("bin")) - F.col("n")).withColumn("all", F.sum("n").over(w))
    half = bins.where(F.col("before") < F.floor((F.col("all") + D + 2) / 2)).groupBy("grp", "start").agg(
        F.sum("n").cast("double").alias("n"), F.max("all").alias("all"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(D)],
        *[F.sum(f"q{i}_{j}").alias(f"q{i}_{j}") for i, j in PAIRS])
    # the closest half of a normal sample scatters less than all of it, by this factor
    return to_model(half.withColumn("scale", F.lit(half_factor())))


def half_factor() -> float:
    """Widens the scatter of the closest half of normal data to that of all: (1/2) / P(chi2 with d + 2 below the median of d)."""
    q = chi2_quantile(0.5, D)
    lo, hi = 0.0, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_quantile(max(mid, 1e-12), D + 2) < q else (lo, mid)
    return 0.5 / lo


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_group: int = MIN_GROUP) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, distance2, base_failed, kept) per row.

    base_failed: fewer than 50 words, or more than half of them in repeated three-word windows. Only
    rows that pass are estimated from and judged; they are kept unless too far from their group. Null
    languages and sources are groups of their own; groups under `min_group` are pooled, and where the pool of
    small languages stays too small, its rows are judged by an estimate from all rows that pass, however few.
    Null texts are empty and fail. Rows of equal statistics shape an estimate once, so that copies do not make it
    singular, and are judged each; other columns are not read; an empty table gives none. A long text is counted whole by one task.
    """
    raw = text_statistics(docs, id_col, text_col, [lang_col, source_col])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    raw = staged(raw.withColumn("base_failed", failed).select("*", *transformed()), "statistics")
    good = raw.where(~F.col("base_failed"))
    by_source = good.groupBy("g0", "g1").agg(F.count("*").alias("n"))
    small = F.col("n") < min_group
    by_lang = by_source.where(small).groupBy("g0").agg(F.sum("n").alias("pooled"))
    groups = by_source.join(by_lang, "g0", "left").select("g0", "g1", F.when(~small, F.concat(F.lit("s"), F.to_json(F.struct("g0", "g1"))))
                                                          .when(F.col("pooled") >= min_group, F.concat(F.lit("l"), F.col("g0"))).otherwise("all").alias("grp"))
    groups = staged(groups, "groups")
    shaped = good.join(groups, ["g0", "g1"]).select("grp", *X)
    n_pool = groups.where("grp = 'all'").join(by_source, ["g0", "g1"]).agg(F.sum("n")).collect()[0][0] or 0
    if 0 < n_pool < min_group:
        shaped = shaped.where("grp <> 'all'").unionByName(good.select(F.lit("all").alias("grp"), *X))
    stats = staged(shaped.distinct(), "vectors")
    columns = [c for c in model_names() if c not in ("grp", "start")]
    models = staged(concentrate(stats, staged(first_models(stats), "models")).withColumn("moving", F.lit(True)), "models")
    for _ in range(MOST_STEPS):
        moving = models.where("moving")
        if moving.isEmpty():
            break
        after = concentrate(stats, moving).select("grp", "start", *(F.col(c).alias(f"new_{c}") for c in columns))
        fell = F.coalesce(F.col("new_logdet") < F.col("logdet") - SETTLED, F.lit(False))
        models = staged(models.drop("moving").join(after, ["grp", "start"], "left").select(
            "grp", "start", *(F.when(fell, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in columns), fell.alias("moving")), "models")
    models = models.drop("moving")
    best = models.withColumn(
        "rank", F.row_number().over(Window.partitionBy("grp").orderBy("logdet", "start"))).where("rank = 1").drop("rank", "logdet", "scale", "start")
    best = staged(groups.join(best, "grp"), "models")
    limit = chi2_quantile(1 - TAIL, D)
    out = raw.join(best, ["g0", "g1"], "left").withColumn("distance2", F.when(~F.col("base_failed"), distance2()))
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "distance2", "base_failed",
                      (~F.col("base_failed") & (F.coalesce("distance2", F.lit(0.0)) <= limit)).alias("kept"))
