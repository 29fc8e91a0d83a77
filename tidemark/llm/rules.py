"""Quality rules and robust multivariate outliers (op 9), in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from tidemark.llm.common import WORD
from tidemark.operators.staging import stage

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
# Base rules
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of the words
# Statistics of the outlier test and the smallest spread that each is granted: a statistic
# that is 0 in nearly all documents must not reject every document where it is not.
FLOORS = {"log_words": 0.9, "log_length": 0.05, "symbols": 0.06, "repeated_lines": 0.3, "repeated_words": 0.3}
CHI2_HALF = 4.351460  # median of the chi-square distribution with 5 degrees of freedom


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, where it may occur many times."""
    return F.transform(F.array(value), body)[0]


def repeated_words(text: Column, window: int = 3) -> Column:
    """Words that lie in a window of ``window`` words found twice or more in the text.

    Hashes of all windows are sorted beside their positions; equal neighbours are the
    repeated ones. Their positions, sorted, cover words up to the next position.
    """
    hashes = _let(
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        lambda w: F.when(
            F.size(w) >= window,
            F.sort_array(
                F.transform(
                    F.sequence(F.lit(0), F.size(w) - window),
                    lambda i: F.struct(F.xxhash64(*(F.get(w, i + k) for k in range(window))).alias("h"), i.alias("i")),
                )
            ),
        ),
    )
    places = _let(
        hashes,
        lambda s: F.sort_array(
            F.filter(
                F.transform(
                    s,
                    lambda x, k: F.when(
                        (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["i"]
                    ),
                ),
                lambda i: i.isNotNull(),
            )
        ),
    )
    covered = _let(
        places,
        lambda p: F.aggregate(
            F.transform(p, lambda v, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - v, F.lit(window)))),
            F.lit(0).cast("long"),
            lambda total, n: total + n,
        ),
    )
    return F.coalesce(covered, F.lit(0).cast("long"))


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return F.coalesce(_let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))), F.lit(0)).cast("long")


def base_statistics(text: Column) -> dict[str, Column]:
    text = F.coalesce(text, F.lit(""))
    bare = F.translate(text, SPACE, "")
    return {
        "n_words": F.regexp_count(text, F.lit(WORD)).cast("long"),
        "word_chars": F.char_length(bare).cast("long"),
        "n_symbols": (F.char_length(bare) - F.char_length(F.translate(bare, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": repeated_lines(text),
        "n_repeat_words": repeated_words(text),
    }


NAMES = tuple(FLOORS)
PAIRS = [(i, j) for i in range(len(NAMES)) for j in range(i + 1)]


def _grouped(rows: DataFrame) -> GroupedData:
    """Rows by ``g``, combined in every task before they move.

    Behind a join on ``g`` Spark would aggregate where the join has put the rows, and the whole table's estimate
    takes all of them; another expression of ``g`` keeps it from that.
    """
    return rows.groupBy(F.concat("g", F.lit("")).alias("g"))


def _sums(rows: DataFrame) -> DataFrame:
    """Per group: number of rows, means and covariances."""
    parts = [F.count(F.lit(1)).alias("n")]
    parts += [F.avg(x).alias(f"m{i}") for i, x in enumerate(NAMES)]
    parts += [F.covar_pop(NAMES[i], NAMES[j]).alias(f"c{i}{j}") for i, j in PAIRS]
    return _grouped(rows).agg(*parts)


def _factored(table: DataFrame) -> DataFrame:
    """Means, and the Cholesky factor of the covariance with its granted spread."""
    for i, j in PAIRS:
        dot = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        if i == j:
            granted = F.col(f"c{i}{i}") + FLOORS[NAMES[i]] ** 2
            value = F.sqrt(F.greatest(granted - dot, F.lit(FLOORS[NAMES[i]] ** 2 / 4)))
        else:
            value = (F.col(f"c{i}{j}") - dot) / F.col(f"l{j}{j}")
        table = table.withColumn(f"l{i}{j}", value)
    return stage(table.drop("n", *(f"c{i}{j}" for i, j in PAIRS)), "moments")


def _leaned(estimates: DataFrame, groups: DataFrame, lean: float, columns: Sequence[str]) -> DataFrame:
    """Estimates of every group, drawn towards its language's, and those towards the whole table's.

    ``estimates`` has ``g, n`` and ``columns`` for groups, languages and the table, ``groups`` the names ``g, l, a`` of
    the three. A group of ``n`` rows counts ``n``, what it leans on ``lean``: no size decides anything by itself.
    """
    own, of_language, of_all = (
        estimates.select(F.col("g").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in ("n", *columns)))
        for name in ("g", "l", "a")
    )
    joined = groups.join(own, "g").join(of_language, "l").join(of_all, "a")

    def drawn(near: Column, far: Column, n: Column) -> Column:
        return (n * near + lean * far) / (n + lean)

    return joined.select(
        "g",
        F.col("n_g").alias("n"),
        *(
            drawn(F.col(f"{c}_g"), drawn(F.col(f"{c}_l"), F.col(f"{c}_a"), F.col("n_l")), F.col("n_g")).alias(c)
            for c in columns
        ),
    )


def _distances(rows: DataFrame, moments: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance ``d`` by forward substitution in the Cholesky factor."""
    joined, total = rows.join(moments, "g", "left"), F.lit(0.0)
    for i, x in enumerate(NAMES):
        dot = sum((F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        joined = joined.withColumn(f"z{i}", (F.col(x) - F.col(f"m{i}") - dot) / F.col(f"l{i}{i}"))
        total = total + F.col(f"z{i}") * F.col(f"z{i}")
    return joined.withColumn("d", total).select(*rows.columns, "d")


def _central(rows: DataFrame, share: float) -> DataFrame:
    """Rows no farther than the group's ``share`` quantile of ``d``."""
    limit = stage(_grouped(rows).agg(F.percentile_approx("d", share, 10_000).alias("limit")), "limit")
    return rows.join(limit, "g").filter("d <= limit").drop("d", "limit")


def robust_distances(
    rows: DataFrame, groups: DataFrame, share: float = 0.75, steps: int = 3, lean: float = 40.0
) -> DataFrame:
    """Append ``distance``: squared Mahalanobis distance by the group's minimum-covariance-
    determinant estimate.

    ``rows`` has the group ``g``, the statistics of :data:`FLOORS`, and ``judged``: whether the row gets a distance or only
    has part in an estimate. The search starts from
    the rows nearest to the medians (in units of the median deviations) and takes
    concentration steps: estimate mean and covariance on the ``share`` of nearest rows (ties at the quantile belong to it),
    measure all rows again. Each step lowers the determinant. The last estimate of a group is drawn towards
    the ones of its language and the table (``groups``, see :func:`_leaned`). Finally distances are scaled
    so that their median, drawn likewise, is that of a chi-square distribution. All estimates are
    aggregations per group combined before the shuffle; a group of any size is spread.
    """
    middle = stage(
        rows.groupBy("g").agg(*(F.percentile_approx(x, 0.5, 10_000).alias(f"m{i}") for i, x in enumerate(NAMES))),
        "medians",
    )
    off = rows.join(middle, "g")
    spread = stage(
        _grouped(off).agg(
            *(F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5, 10_000).alias(f"s{i}") for i, x in enumerate(NAMES))
        ),
        "deviations",
    )
    near = sum(
        (
            F.pow((F.col(x) - F.col(f"m{i}")) / F.greatest(1.4826 * F.col(f"s{i}"), F.lit(FLOORS[x])), 2)
            for i, x in enumerate(NAMES)
        ),
        F.lit(0.0),
    )
    measured = off.join(spread, "g").withColumn("d", near).select(*rows.columns, "d")
    for _ in range(steps - 1):
        measured = _distances(rows, _factored(_sums(_central(measured, share))))
    columns = [f"m{i}" for i in range(len(NAMES))] + [f"c{i}{j}" for i, j in PAIRS]
    last = stage(_sums(_central(measured, share)), "estimates")
    judged = _distances(rows.filter("judged"), _factored(_leaned(last, groups, lean, columns)))
    judged = judged.join(groups, "g").withColumn("each", F.explode(F.array("g", "l", "a")))
    half = F.percentile_approx("d", 0.5, 10_000).alias("half")
    halves = stage(judged.groupBy(F.col("each").alias("g")).agg(F.count(F.lit(1)).alias("n"), half), "scale")
    scale = stage(_leaned(halves, groups, lean, ["half"]).drop("n"), "scale")
    return (
        judged.filter("each = g")
        .join(scale, "g")
        .withColumn("distance", F.col("d") / F.greatest(F.col("half") / CHI2_HALF, F.lit(0.25)))
        .select(*rows.columns, "distance")
    )


def _with_estimates(vectors: DataFrame) -> DataFrame:
    """One row per estimate that a row has part in: its group's, which judges it, its language's and the table's."""
    estimates = F.array(
        F.struct("g", F.lit(True).alias("judged")),
        F.struct(F.col("l").alias("g"), F.lit(False).alias("judged")),
        F.struct(F.col("a").alias("g"), F.lit(False).alias("judged")),
    )
    placed = vectors.withColumn("e", F.explode(estimates))
    kept = [c for c in vectors.columns if c not in ("g", "l", "a")]
    return placed.select(*kept, "e.g", "e.judged")


def quality_rules(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    cut: float = 80.0,
    lean: float = 40.0,
) -> DataFrame:
    """Base statistics of every whole text, base rules, and the outlier verdict.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, distance``. Estimates are made per language and source from the rows
    that pass the base rules; a row is rejected when its squared robust distance exceeds
    ``cut``. The estimate of a group of ``n`` such rows is drawn towards the one of its language over all
    sources, and that towards the one of the whole table, with the weight of ``lean`` rows: small groups are
    judged by wider estimates, large ones by their own, and one more row changes little at any size.
    NULL languages and sources form groups of their own; NULL
    and empty texts have no words and fail the base rules. Rows that repeat an id are judged
    each; extra columns are ignored; an empty table gives no rows.
    """
    group = [F.coalesce(F.concat(F.lit("v"), F.col(c)), F.lit("n")) for c in (lang, source)]
    counted = df.select(
        F.col(doc_id).alias("doc_id"),
        # Names of the estimates: of the table, of languages, of languages and sources.
        F.lit("a").alias("a"),
        F.concat(F.lit("l"), group[0]).alias("l"),
        F.concat(F.lit("s"), F.concat_ws("\u0001", *group)).alias("g"),
        *(c.alias(n) for n, c in base_statistics(F.col(text)).items()),
    )
    rows = stage(
        counted.withColumn(
            "base_failed",
            (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
        ),
        "rules",
    )
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    vectors = rows.filter("not base_failed").select(
        *rows.columns,
        F.log1p("n_words").alias("log_words"),
        F.log(chars / words).alias("log_length"),
        F.sqrt(F.col("n_symbols") / chars).alias("symbols"),
        F.sqrt(F.col("n_dup_lines") * 10 / words).alias("repeated_lines"),
        F.sqrt(F.col("n_repeat_words") / words).alias("repeated_words"),
    )
    groups = stage(vectors.select("g", "l", "a").distinct(), "groups")
    judged = robust_distances(_with_estimates(vectors), groups, lean=lean)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    kept = F.col("distance") <= cut
    failed = rows.filter("base_failed").select(
        *columns, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance")
    )
    return judged.select(*columns, kept.alias("kept"), "distance").union(failed)
