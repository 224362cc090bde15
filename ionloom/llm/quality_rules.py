"""Operator 7 (native): base rules, then robust multivariate outliers per language and source.

Base statistics come from array functions inside each row, over the whole text.  Five-word windows are compared by a 64-bit
hash; only texts in which a hash occurs twice have their windows sorted with their places.

Outliers: the base statistics become a vector (``VECTOR``).  For each (lang, source) the minimum-covariance-determinant
estimate has the deterministic starts of ``STARTS``, all centred at the medians and scaled by median absolute deviations (after
Hubert, Rousseeuw and Verdonck 2012).  Each takes ``c_steps`` concentration steps: the ``share`` of rows with the least Mahalanobis
distance gives the next mean and covariance.  The start whose last covariance has the least determinant is the estimate (ties:
the first).  Its distances are scaled so that their median is that of a chi-square variable (``d2``).

The estimate is then reweighted (Rousseeuw and Van Driessen 1999): mean and covariance of its core, the rows within the ``core``
quantile of the chi-square variable, give the distances that decide (``judged``).  Symbols, repeated lines and repeated words are zero in most
documents, so the core has next to no spread there: the square of each statistic's ``ORDINARY`` spread is added to its variance.  The
degrees of freedom are those that the core's own spread makes up, the sum of s / (s + added) over the variances s, 1 at least.  Rows
beyond the ``quantile`` of the chi-square variable with as many degrees are rejected.  Only rows that pass the base rules take part.

Groups with fewer than ``least_rows`` passing rows are judged by the estimate of their language over all its sources, languages
with fewer by that of all rows.

Scale: the texts are read once and the statistics written to the shared folder; each step is an aggregate with partial sums
or quantile sketches (``percentile_approx``), so a hot group needs no task that sees all its rows.  Joins are against one
row a group.

Edge cases: a null text is empty, has 0 words and fails; null lang or source forms a group of its own; a table with fewer
than ``least_rows`` passing rows in all has no estimate and rejects nothing; a constant statistic has ``ridge`` as variance, then the square of its ``ORDINARY`` spread.  Repeated rows are judged one by
one, ties share a verdict, extra columns are ignored, and an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ionloom.llm.common import WORD_SPACE, table, written

SYMBOLS = "#*$%&|<>"
_SPACE = "[\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class RuleParams:
    least_words: int = 10
    repeat_percent: int = 20
    window: int = 5
    share: float = 0.75
    c_steps: int = 3
    ridge: float = 0.01
    core: float = 0.975
    quantile: float = 0.9999
    least_rows: int = 20
    accuracy: int = 10_000


#: The statistic vector; each entry is a function of the base columns.
VECTOR = (
    lambda: F.log1p("n_words"),
    lambda: F.log1p(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))) * 3,
    lambda: F.log1p(F.col("n_symbols") * 20 / F.greatest(F.col("n_words"), F.lit(1))),
    lambda: F.log1p(F.col("n_dup_lines").cast("double")) / 2,
    lambda: F.log1p(F.col("n_repeat_words") * 20 / F.greatest(F.col("n_words"), F.lit(1))),
)
#: Spread of each entry that is ordinary in any group: a factor of 1.6 in length, 6 % in word length, 2 symbols in 100 words, one repeated line, 4 repeated words in 100.
ORDINARY = (0.5, 0.15, 0.25, 0.2, 0.5)
#: Starts of the estimate: uncorrelated statistics, and the covariances of their hyperbolic tangents and of their spatial signs.
STARTS = ("diagonal", "tanh", "sign")
#: Median of a chi-square variable with as many degrees of freedom as VECTOR has entries.
CHI_MEDIAN = 4.351


def base_statistics(docs: DataFrame, p: RuleParams = RuleParams()) -> DataFrame:
    """doc_id, lang, source and the base columns; whole texts, inside each row."""
    n = p.window
    t = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.coalesce(F.col("text"), F.lit("")).alias("t"))
    has_word = lambda x: F.length(F.translate(x, WORD_SPACE, "")) > 0
    t = t.withColumn("words", F.filter(F.split("t", _SPACE), lambda x: x != "")).withColumn("lines", F.filter(F.split("t", "\n"), has_word))
    chars = F.length("t")
    t = t.select(
        "doc_id", "lang", "source", "words", F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("t", WORD_SPACE, "")).cast("long").alias("word_chars"),
        (chars - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    window_hash = lambda i: F.xxhash64(*(F.get("words", i + k) for k in range(n)))
    t = t.withColumn("h", F.when(F.col("n_words") > n, F.transform(F.sequence(F.lit(0), F.size("words") - n), window_hash))).drop("words")
    t = t.withColumn("h", F.when(F.size(F.array_distinct("h")) < F.size("h"), F.col("h")))
    t = t.withColumn("z", F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).drop("h")
    same = lambda x, j: F.coalesce(F.get("z", j)["h"] == x["h"], F.lit(False))
    t = t.withColumn("at", F.sort_array(F.transform(F.filter("z", lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"]))).drop("z")
    # a window's start covers the words up to the next start, the window's length at most
    t = t.withColumn("cover", F.transform("at", lambda x, j: F.least(F.lit(n), F.coalesce(F.get("at", j + 1) - x, F.lit(n)))))
    return t.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.coalesce(F.aggregate("cover", F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")).alias("n_repeat_words"))


def base_failed(p: RuleParams = RuleParams()) -> Column:
    return (F.col("n_words") < p.least_words) | (100 * F.col("n_repeat_words") > p.repeat_percent * F.col("n_words"))


def _moments(rows: DataFrame, d: int, ridge: Sequence[float]) -> DataFrame:
    """Per group and start: means m_i and the lower Cholesky factor l_ij of the covariance plus ``ridge`` on its diagonal."""
    means = [F.avg(f"x{i}").alias(f"m{i}") for i in range(d)]
    products = [F.avg(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i in range(d) for j in range(i + 1)]
    out = rows.groupBy("g", "start").agg(*means, *products)
    out = out.select("g", "start", *(f"m{i}" for i in range(d)), *((F.col(f"s{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}") + (ridge[i] if i == j else 0.0)).alias(f"c{i}{j}") for i in range(d) for j in range(i + 1)))
    for j in range(d):
        left = sum((F.col(f"l{j}{k}") ** 2 for k in range(j)), F.lit(0.0))
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - left, F.lit(ridge[j] / 10))))
        out = out.withColumns({f"l{i}{j}": (F.col(f"c{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))) / F.col(f"l{j}{j}") for i in range(j + 1, d)})
    return out.select("g", "start", *(f"m{i}" for i in range(d)), *(f"l{i}{j}" for i in range(d) for j in range(i + 1)))


def _starts(good: DataFrame, mid: DataFrame, spread: DataFrame, d: int, ridge: float) -> DataFrame:
    """g, start, m_i and l_ij of every start; scatter of the transformed standard scores, scaled back to the statistics."""
    at = mid.join(spread, "g").select("g", *(f"m{i}" for i in range(d)), *(F.sqrt(F.pow(1.4826 * F.col(f"v{i}"), F.lit(2)) + ridge).alias(f"u{i}") for i in range(d)))
    at = written(at, "rules-scale")
    z = good.join(at, "g").select("g", *(((F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"u{i}")).alias(f"z{i}") for i in range(d)))
    norm = F.sqrt(sum((F.col(f"z{i}") ** 2 for i in range(d)), F.lit(0.0)))
    sign = lambda i: F.when(norm > 0, F.col(f"z{i}") / norm).otherwise(0.0)
    each = F.array(*(F.struct(F.lit(STARTS[k]).alias("start"), *(f(i).alias(f"x{i}") for i in range(d))) for k, f in ((1, lambda i: F.tanh(f"z{i}")), (2, sign))))
    shapes = _moments(z.select("g", F.explode(each).alias("e")).select("g", "e.*"), d, [ridge] * d)
    shapes = shapes.select("g", "start", *(F.col(f"l{i}{j}").alias(f"c{i}{j}") for i in range(d) for j in range(i + 1)))
    turned = at.join(shapes, "g").select("g", "start", *(f"m{i}" for i in range(d)), *((F.col(f"u{i}") * F.col(f"c{i}{j}")).alias(f"l{i}{j}") for i in range(d) for j in range(i + 1)))
    plain = at.select("g", F.lit(STARTS[0]).alias("start"), *(f"m{i}" for i in range(d)), *((F.col(f"u{i}") if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i in range(d) for j in range(i + 1)))
    return plain.unionByName(turned)


def _least_determinant(est: DataFrame, d: int) -> DataFrame:
    """The start of each group whose covariance has the least determinant, the product of the squares of l_ii; ties go to the first start."""
    place = F.array_position(F.array(*map(F.lit, STARTS)), F.col("start"))
    log_det = F.round(2 * sum((F.log(f"l{i}{i}") for i in range(d)), F.lit(0.0)), 9)
    rest = [c for c in est.columns if c not in ("g", "start")]
    best = est.groupBy("g").agg(F.min(F.struct(log_det.alias("log_det"), place.alias("place"), "start", *rest)).alias("b"))
    return best.select("g", "b.start", *(f"b.{c}" for c in rest))


def _distance(d: int) -> list[tuple[str, Column]]:
    """Forward substitution y = L^-1 (x - m); the squared distance is the sum of the squares."""
    out = []
    for i in range(d):
        out.append((f"y{i}", (F.col(f"x{i}") - F.col(f"m{i}") - sum((F.col(f"l{i}{k}") * F.col(f"y{k}") for k in range(i)), F.lit(0.0))) / F.col(f"l{i}{i}")))
    return out


def _freedom(d: int, ridge: Sequence[float]) -> Column:
    """Degrees of freedom of an estimate: the shares of its variances that ``ridge`` doesn't make up, 1 at least."""
    return F.greatest(sum((1 - ridge[i] / sum((F.col(f"l{i}{j}") ** 2 for j in range(i + 1)), F.lit(0.0)) for i in range(d)), F.lit(0.0)), F.lit(1.0))


def _chi_square(k: Column, share: float) -> Column:
    """Quantile of the chi-square variable with ``k`` degrees of freedom (Wilson and Hilferty 1931)."""
    return k * F.pow(1 - 2 / (9 * k) + NormalDist().inv_cdf(share) * F.sqrt(2 / (9 * k)), F.lit(3))


def _with_distance(rows: DataFrame, est: DataFrame, d: int, how: str = "inner", to: str = "d2") -> DataFrame:
    out = rows.join(est, "g", how)
    for name, c in _distance(d):
        out = out.withColumn(name, c)
    return out.withColumn(to, sum((F.col(f"y{i}") ** 2 for i in range(d)), F.lit(0.0)))


def _levels(stats: DataFrame, p: RuleParams) -> DataFrame:
    """source_key, lang_key and g of every (lang, source); g names the estimate: the group's, its language's or that of all rows."""
    sizes = stats.groupBy("source_key", "lang_key").agg(F.count_if(~F.col("base_failed")).alias("n"))
    langs = sizes.groupBy("lang_key").agg(F.sum("n").alias("n_lang"))
    total = sizes.agg(F.sum("n").alias("n_all"))
    g = F.when(F.col("n") >= p.least_rows, F.col("source_key")).when(F.col("n_lang") >= p.least_rows, F.col("lang_key")).when(F.col("n_all") >= p.least_rows, F.lit("all"))
    return written(sizes.join(langs, "lang_key").crossJoin(total).select("source_key", "lang_key", g.alias("g")), "rules-levels")


def _estimated(good: DataFrame, levels: DataFrame) -> DataFrame:
    """g and statistics of the passing rows, once for each estimate that they enter."""
    own = levels.where("g = source_key").select("source_key")
    langs = levels.where("g = lang_key").select("lang_key").distinct()
    everything = levels.where("g = 'all'").select("g").distinct()
    x = [c for c in good.columns if c not in ("source_key", "lang_key")]
    parts = (good.join(own, "source_key").select(F.col("source_key").alias("g"), *x), good.join(langs, "lang_key").select(F.col("lang_key").alias("g"), *x), good.crossJoin(everything).select("g", *x))
    return written(parts[0].unionAll(parts[1]).unionAll(parts[2]), "rules-good")


def quality_rules(docs: DataFrame, p: RuleParams = RuleParams()) -> DataFrame:
    """doc_id, base columns, base_failed, kept and the squared distances of every row: ``d2`` by the robust estimate, ``judged`` by the reweighted one as a
    multiple of its quantile, so that rows above 1 are rejected (both null without an estimate)."""
    d = len(VECTOR)
    stats = base_statistics(docs, p).withColumn("base_failed", base_failed(p))
    stats = stats.withColumn("source_key", F.concat(F.lit("source"), F.to_json(F.struct("lang", "source")))).withColumn("lang_key", F.concat(F.lit("lang"), F.to_json(F.struct("lang"))))
    stats = written(stats.withColumns({f"x{i}": f() for i, f in enumerate(VECTOR)}), "rules")
    levels = _levels(stats, p)
    good = _estimated(stats.where(~F.col("base_failed")).select("source_key", "lang_key", *(f"x{i}" for i in range(d))), levels)
    stats = stats.join(levels.drop("lang_key"), "source_key")
    median = lambda c: F.percentile_approx(c, 0.5, p.accuracy)
    mid = good.groupBy("g").agg(*(median(f"x{i}").alias(f"m{i}") for i in range(d)))
    mid = written(mid, "rules-mid")
    spread = good.join(mid, "g").groupBy("g").agg(*(median(F.abs(F.col(f"x{i}") - F.col(f"m{i}"))).alias(f"v{i}") for i in range(d)))
    est, ridge = _starts(good, mid, spread, d, p.ridge), [p.ridge] * d
    for _ in range(p.c_steps):
        est = written(est, "rules-step")
        near = _with_distance(good, est, d)
        cut = near.groupBy("g", "start").agg(F.percentile_approx("d2", p.share, p.accuracy).alias("cut"))
        est = _moments(_with_distance(good, est.join(cut, ["g", "start"]), d).where("d2 <= cut"), d, ridge)
    est = written(_least_determinant(written(est, "rules-step"), d), "rules-best")
    k = _freedom(d, ridge)
    mid = _with_distance(good, est, d).groupBy("g").agg(median("d2").alias("mid"))
    cut = F.greatest(F.col("mid") / _chi_square(k, 0.5), F.lit(1e-3)) * _chi_square(k, p.core)
    est = written(est.join(mid, "g").withColumns({"unit": F.greatest(F.col("mid") / CHI_MEDIAN, F.lit(1e-3)), "cut": cut}), "rules-core")
    ordinary = [x**2 for x in ORDINARY]
    last = written(_moments(_with_distance(good, est, d).where("d2 <= cut"), d, ordinary).drop("start"), "rules-reweighted")
    k = _freedom(d, ordinary)
    mid = _with_distance(good, last, d).groupBy("g").agg(median("d2").alias("mid"))
    # the core's spread falls short where it was cut off; it is never taken as larger than it is, as for groups that are mostly copies
    last = written(last.join(mid, "g").withColumn("cut", F.greatest(F.col("mid") / _chi_square(k, 0.5), F.lit(1.0)) * _chi_square(k, p.quantile)), "rules-end")
    out = _with_distance(stats, est, d, "left").select(*stats.columns, (F.col("d2") / F.col("unit")).alias("d2"))
    out = _with_distance(out, last, d, "left", "judged").withColumn("judged", F.col("judged") / F.col("cut"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("judged") <= 1, F.lit(True))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "d2", "judged", "lang", "source")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("d2", "judged", "lang", "source")


def rules_base_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base columns that ``op7_quality_rules`` judges, without the outlier step, which SQL can't express."""
    base = base_statistics(table(spark, sf_dir, "documents"))
    return base.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"))


BASE_ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT r, i, unnest(list_transform(range(1, len(w) - 3), lambda j: list_slice(w, j, j + 4))) AS five, unnest(range(1, len(w) - 3)) AS p0 FROM (SELECT r, w, 0 AS i FROM d)),
again AS (SELECT r, p0 FROM (SELECT r, p0, count(*) OVER (PARTITION BY r, five) AS n FROM g) WHERE n > 1),
cover AS (SELECT r, CAST(count(DISTINCT p) AS BIGINT) AS n FROM (SELECT r, unnest(range(p0, p0 + 5)) AS p FROM again) GROUP BY r),
base AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d)
SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
  n_words < 10 OR 100 * coalesce(n, 0) > 20 * n_words AS base_failed FROM base LEFT JOIN cover USING (r)
"""
