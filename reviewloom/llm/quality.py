"""Quality rules: robust multivariate outliers per language and source. DataFrame functions only.

Each document that passes the base rules becomes a vector of transformed statistics. For
every (language, source) the minimum-covariance-determinant centre and scatter are estimated:
concentration steps take the mean and covariance of the nearest h = (n + p + 1) / 2 of the group's
n vectors of p statistics, until no determinant changes. They run from three starts: medians with
quartile ranges, medians with median deviations, and the shortest half of each statistic; the last
two hold as long as more than half of a group is clean. The start that ends with the least
determinant is kept for each group, concentrated again beside the groups of its language, and
reweighted: the last mean and covariance are those of all vectors within REWEIGHT. A document is
rejected if its squared Mahalanobis distance is over CUTOFF.

A step is one pass over the vectors: they are added up per (group, start, distance bin), combined in
every task before the shuffle, so a group with a third of all rows is some hundred rows there;
running sums over the bins of a group then give count, mean and covariance of the nearest share.
The bins are 0.5 % wide, so the share is exact to a bin. Small groups lean on the pooled scatter
of their language (PRIOR_SCATTER) and its centre (PRIOR_CENTRE), and a floor for each
statistic's deviation keeps constant statistics from making the matrix singular.

Defined cases: a null text has no words; null languages or sources are a group of their own; an
empty table gives an empty result; rows with equal doc_id are judged one by one. The row id that
the steps use is not in the result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.scratch import materialize
from .common import let

MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Transformed statistics and the least deviation that each is given.
FEATURES = {"word_length": 0.06, "symbols": 0.25, "capitals": 0.25, "dup_lines": 0.15, "repeats": 0.12}
STARTS = 3
#: Steps end when no log-determinant changes by more than TOLERANCE.
TOLERANCE = 0.01
CUTOFF = 60.0
PRIOR_SCATTER, PRIOR_CENTRE = 50.0, 10.0
_BINS = 200.0

_NAMES = list(FEATURES)
_P = len(_NAMES)
_PAIRS = [(i, j) for i in range(_P) for j in range(i + 1)]


def _chi2(x: float, k: int) -> float:
    """Distribution function of chi-squared with an odd number of degrees of freedom."""
    tail = sum((x / 2) ** (m / 2) * math.exp(-x / 2) / math.gamma(m / 2 + 1) for m in range(1, k, 2))
    return math.erf(math.sqrt(x / 2)) - tail


def _quantile(share: float) -> float:
    low, high = 0.0, 200.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2(mid, _P) < share else (low, mid)
    return low


def _consistency(share: float) -> float:
    """Makes the covariance of the nearest share consistent at the normal distribution."""
    return share / _chi2(_quantile(share), _P + 2)


#: The factors for the nearest 50, 51, ... 100 %.
_CONSISTENCY = [_consistency(k / 100) for k in range(50, 100)] + [1.0]
REWEIGHT = _quantile(0.975)


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def _repeated_words(words: Column) -> Column:
    """Words covered by 3-word windows that are found twice or more, in O(n log n)."""

    def covered(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            twin = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
            at = F.filter(s, lambda x, j: twin(x, j - 1) | twin(x, j + 1))
            return F.array_sort(F.transform(at, lambda x: x["i"]))

        def total(at: Column) -> Column:
            steps = F.transform(at, lambda a, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - a, F.lit(3))))
            return F.aggregate(steps, F.lit(0), lambda x, y: x + y)

        repeated = let(let(ordered, starts), total)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(repeated)

    def grams(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 3)
        hashes = F.transform(at, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(hashes, covered))

    return let(words, grams)


def statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns in the struct ``row``, and the base statistics of every text."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.struct(*keep).alias("row"), text.alias("text"))
    lines = F.transform(
        F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != ""), lambda x: F.md5(x)
    )
    counted = rows.select(
        "row",
        let(_words(F.col("text")), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), _repeated_words(w).cast("long").alias("n_repeat_words")
        )).alias("of_words"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        let(lines, lambda x: F.size(x).cast("long")).alias("n_lines"),
        F.length(F.translate("text", WHITE, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("text") - F.length(F.translate("text", UPPER, ""))).cast("long").alias("n_capitals"),
    )
    n, repeat = F.col("of_words.n_words"), F.col("of_words.n_repeat_words")
    return counted.select(
        "row", n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", repeat.alias("n_repeat_words"),
        ((n < MIN_WORDS) | (100 * repeat > 50 * n)).alias("base_failed"), "n_lines", "n_capitals",
    )


def _vectors(stats: DataFrame) -> DataFrame:
    """Transformed statistics: logarithms of lengths and of rates per thousand, and plain shares."""
    rate = lambda part, whole: F.log1p(F.lit(1000.0) * F.col(part) / F.greatest(F.col(whole), F.lit(1)))
    return stats.select(
        "*",
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))).alias("word_length"),
        rate("n_symbols", "word_chars").alias("symbols"),
        rate("n_capitals", "word_chars").alias("capitals"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("dup_lines"),
        (F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1))).alias("repeats"),
    )


def _start(vectors: DataFrame) -> DataFrame:
    """Centre and deviation of each statistic of a group for every start, from counts of thousandths."""
    bins = vectors.select("lang", "source", F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.floor(F.col(f) * 1000).alias("bin")) for k, f in enumerate(_NAMES)
    ])).alias("x")).groupBy("lang", "source", "x.k", "x.bin").count()
    key = Window.partitionBy("lang", "source", "k")
    half = 10**9 // 2
    run = bins.select(
        "*", F.sum("count").over(key.orderBy("bin")).alias("upto"), F.sum("count").over(key).alias("n")
    )
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("n"), F.col("bin")))
    # A row's place is the billionths of the group that lie before it; the shortest half from there ends at its last bin.
    place = F.floor((F.col("upto") - F.col("count")) * F.lit(2.0 * half) / F.col("n"))
    run = run.select("*", at(0.5).over(key).alias("median"), place.alias("place"))
    ahead = key.orderBy("place").rangeBetween(Window.unboundedPreceding, half - 1)
    run = run.select(
        "*", F.abs(F.col("bin") - F.col("median")).alias("far"),
        F.when(F.col("place") <= half, F.max("bin").over(ahead)).alias("end"),
    )
    run = run.select("*", F.sum("count").over(key.orderBy("far")).alias("within"))
    width = F.struct((F.col("end") - F.col("bin")).alias("width"), F.col("bin"))
    of = run.groupBy("lang", "source", "k").agg(
        (F.first("median") / 1000.0).alias("median"),
        ((at(0.75) - at(0.25)) / 1349.0).alias("quartiles"),
        (F.min(F.when(F.col("within") >= 0.5 * F.col("n"), F.col("far"))) / 674.5).alias("mad"),
        F.min(F.when(F.col("end").isNotNull(), width)).alias("short"),
    )
    short = F.col("short.width")
    starts = of.select("lang", "source", "k", F.explode(F.array(*[
        F.struct(F.lit(number).alias("start"), mid.alias("mid"), dev.alias("dev")) for number, (mid, dev) in enumerate((
            (F.col("median"), F.col("quartiles")), (F.col("median"), F.col("mad")),
            ((F.col("short.bin") + short / 2) / 1000.0, short / 1349.0),
        ))
    ])).alias("x")).select("lang", "source", "k", "x.*")
    one = lambda name, k: F.max(F.when(F.col("k") == k, F.col(name)))
    return starts.groupBy("lang", "source", "start").agg(
        *[one("mid", k).alias(f"m{k}") for k in range(_P)],
        *[
            (F.lit(1.0) / F.greatest(one("dev", i), F.lit(FEATURES[_NAMES[i]])) if i == j else F.lit(0.0)).alias(f"w{i}{j}")
            for i, j in _PAIRS
        ],
        F.lit(0.0).alias("log_det"),
    )


def _distance(vectors: DataFrame, model: DataFrame) -> DataFrame:
    """Adds d2, the squared length of W (x - m)."""
    joined = vectors.join(model, ["lang", "source"])
    z = ["(" + " + ".join(f"w{i}{j} * ({_NAMES[j]} - m{j})" for j in range(i + 1)) + ")" for i in range(_P)]
    return joined.withColumn("d2", F.expr(" + ".join(f"{x} * {x}" for x in z)))


def _concentrate(vectors: DataFrame, model: DataFrame, reweight: bool = False) -> DataFrame:
    """Centre and whitening matrix from the nearest h of each group, or from all within REWEIGHT if those are more."""
    sums = [F.expr(f"sum({x}) AS s{i}") for i, x in enumerate(_NAMES)]
    cross = [F.expr(f"sum({_NAMES[i]} * {_NAMES[j]}) AS c{i}{j}") for i, j in _PAIRS]
    bins = (
        _distance(vectors, model)
        .groupBy("lang", "source", "start", F.floor(F.log(F.col("d2") + 1e-6) * _BINS).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), *sums, *cross)
    )
    moments = ["n", *[f"s{i}" for i in range(_P)], *[f"c{i}{j}" for i, j in _PAIRS]]
    own = "PARTITION BY lang, source, start"
    run = bins.selectExpr(
        "lang", "source", "start", "bin", *[f"sum({m}) OVER ({own} ORDER BY bin) AS {m}" for m in moments], f"sum(n) OVER ({own}) AS all"
    )
    last = f"min(CASE WHEN n >= least(all, floor((all + {_P} + 1) / 2)) THEN bin END) OVER ({own})"
    if reweight:
        last = f"greatest({last}, {math.floor(math.log(REWEIGHT) * _BINS)})"
    run = run.selectExpr("*", f"{last} AS last").where("bin <= last")
    nearest = run.groupBy("lang", "source", "start").agg(F.max_by(F.struct(*moments, "all"), "bin").alias("x"))
    factor = f"get(array({', '.join(f'{c!r}D' for c in _CONSISTENCY)}), cast(floor(n * 100 / all) AS int) - 50)"
    if reweight:
        factor = f"{_consistency(0.975)!r}D"
    nearest = nearest.select("lang", "source", "start", "x.*").selectExpr("*", f"{factor} AS factor")
    centred = nearest.selectExpr(
        "lang", "source", "start", "n", *[f"s{i} / n AS s{i}" for i in range(_P)],
        *[f"factor * (c{i}{j} / n - s{i} * s{j} / (n * n)) AS c{i}{j}" for i, j in _PAIRS],
    )
    language = "OVER (PARTITION BY lang, start)"
    lean = lambda c, prior: f"(n * {c} + {prior}D * sum(n * {c}) {language} / sum(n) {language}) / (n + {prior}D)"
    return _whiten(centred.selectExpr(
        "lang", "source", "start", *[f"{lean(f's{i}', PRIOR_CENTRE)} AS m{i}" for i in range(_P)],
        *[f"{lean(f'c{i}{j}', PRIOR_SCATTER)} + {FEATURES[_NAMES[i]] ** 2 if i == j else 0.0!r}D AS a{i}{j}" for i, j in _PAIRS],
    ))


def _whiten(model: DataFrame) -> DataFrame:
    """w = inverse of the Cholesky factor of a: a few columns of a table with a row per group."""
    rest = lambda i, j: f"(a{i}{j}" + "".join(f" - l{i}{k} * l{j}{k}" for k in range(j)) + ")"
    for j in range(_P):
        model = model.selectExpr("*", f"sqrt(greatest({rest(j, j)}, 1e-9D)) AS l{j}{j}")
        if j + 1 < _P:
            model = model.selectExpr("*", *[f"{rest(i, j)} / l{j}{j} AS l{i}{j}" for i in range(j + 1, _P)])
    for off in range(_P):
        model = model.selectExpr("*", *[
            "-(" + " + ".join(f"l{j + off}{k} * w{k}{j}" for k in range(j, j + off)) + f") / l{j + off}{j + off} AS w{j + off}{j}"
            if off else f"1 / l{j}{j} AS w{j}{j}" for j in range(_P - off)
        ])
    log_det = "2 * (" + " + ".join(f"log(l{i}{i})" for i in range(_P)) + ") AS log_det"
    names = [*[f"m{i}" for i in range(_P)], *[f"w{i}{j}" for i, j in _PAIRS]]
    return model.selectExpr("lang", "source", "start", *names, log_det)


def _converge(vectors: DataFrame, model: DataFrame) -> DataFrame:
    """Concentration steps until no determinant changes.

    A step follows from the bins that count, of which there are finitely many choices; should it come back to
    determinants that it had before, it goes round in a circle, and ends too.
    """
    seen = set()
    while True:
        before = model.select("lang", "source", "start", F.col("log_det").alias("before"))
        model = materialize(_concentrate(vectors, model), "model")
        mark = F.sum(F.xxhash64("lang", "source", "start", F.round("log_det", 6)).cast("decimal(38,0)"))
        change, state = (
            model.join(before, ["lang", "source", "start"]).agg(F.max(F.abs(F.col("log_det") - F.col("before"))), mark).first()
        )
        if change is None or change <= TOLERANCE or state in seen:
            return model
        seen.add(state)


def _estimate(vectors: DataFrame) -> DataFrame:
    """The model of every group: least determinant of all starts, concentrated again, then reweighted."""
    model = _converge(vectors, materialize(_start(vectors), "model"))
    parts = [c for c in model.columns if c not in ("lang", "source", "start")]
    best = model.groupBy("lang", "source").agg(F.min_by(F.struct(*parts), F.struct("log_det", "start")).alias("x"))
    best = materialize(best.select("lang", "source", F.lit(0).alias("start"), "x.*"), "model")
    return materialize(_concentrate(vectors, _converge(vectors, best), reweight=True), "model")


def judge(docs: DataFrame, keep: list[str] | None = None, cutoff: float = CUTOFF) -> DataFrame:
    """The kept columns (all of docs, if not given; lang and source must be among them) in ``row``, the base statistics, base_failed, distance (null if base_failed) and kept.

    The statistics are written once, to shared storage; the steps read only the vectors.
    """
    key = lambda name: F.coalesce(F.col(f"row.{name}").cast("string"), F.lit("\x00")).alias(name)
    stats = materialize(_vectors(statistics(docs, keep or ["*"])).select("*", key("lang"), key("source")), "statistics")
    vectors = stats.where(~F.col("base_failed")).select("lang", "source", *_NAMES)
    model = _estimate(vectors)
    passed = _distance(stats.where(~F.col("base_failed")), model).select(*stats.columns, "d2")
    failed = stats.where("base_failed").withColumn("d2", F.lit(None).cast("double"))
    return passed.unionByName(failed).select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.col("d2").alias("distance"), (~F.col("base_failed") & (F.col("d2") <= cutoff)).alias("kept"),
    )


def digest(docs: DataFrame) -> DataFrame:
    """The verdict of every document by doc_id; texts are not carried along."""
    judged = judge(docs.select("doc_id", "text", "lang", "source"), keep=["doc_id", "lang", "source"])
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that are kept, with all their columns."""
    return judge(docs).where("kept").select("row.*")
