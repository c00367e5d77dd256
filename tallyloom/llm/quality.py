"""Quality rules: a robust multivariate outlier test per language and source.

Each document becomes a vector of transformed statistics. Per group, the minimum covariance
determinant estimate is found by concentration steps over all vectors of the group, and a
document is rejected by its Mahalanobis distance.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.arrays import LOWER, NOT_SPACE, Hasher, mix, per_document, pieces, runs, tidy, windows
from tallyloom.operators.bounded import check_size
from tallyloom.session import materialise

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True
PLAIN = np.zeros(256, dtype=bool)
PLAIN[97:123] = PLAIN[65:91] = PLAIN[48:58] = PLAIN[128:] = True

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_plain",
)
#: Vector entries are integers, thousandths of the transformed statistic, so that sums are exact in any order.
UNIT = 1000
NAMES = ("x0", "x1", "x2", "x3", "x4")


@tidy
def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = []
        for _, data, offsets in pieces(batch.column(1)):
            n = len(offsets) - 1
            starts, ends, docs = runs(data, offsets, NOT_SPACE)
            begins = (data & 0xC0) != 0x80
            points = np.concatenate(([0], np.cumsum(begins)))
            hasher = Hasher(data)
            words = hasher.of(starts, ends)
            salt = mix(docs.astype(np.uint64) + np.uint64(1))
            grams, first = windows(words, docs, 3)
            again = pd.Series(grams ^ salt[first]).duplicated(keep=False).to_numpy() if len(grams) else np.zeros(0, bool)
            repeated = np.zeros(len(words) + 3, dtype=bool)
            for k in range(3):
                repeated[first[again] + k] = True
            # lines that hold a word: their number is the count of line ends before the word
            end_of_line = np.concatenate(([0], np.cumsum(data == 10)))
            line_from = np.concatenate((np.flatnonzero(data == 10) + 1, offsets[:-1]))
            line_from = np.unique(line_from[line_from < max(len(data), 1)])
            held = np.unique(np.searchsorted(line_from, starts, "right") - 1) if len(starts) else np.zeros(0, np.int64)
            begin = line_from[held] if len(held) else np.zeros(0, np.int64)
            line_doc = np.searchsorted(offsets, begin, "right") - 1
            all_ends = np.sort(np.concatenate((np.flatnonzero(data == 10), offsets[1:])))
            # a line with a word ends behind its beginning, which may be where the document before ended
            stop = all_ends[np.searchsorted(all_ends, begin, "right")] if len(begin) else begin
            lines = hasher.of(begin, stop) ^ mix(line_doc.astype(np.uint64) + np.uint64(1))
            same = pd.Series(lines).duplicated().to_numpy() if len(lines) else np.zeros(0, bool)
            cut = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[offsets])
            parts.append(
                [
                    per_document(docs, n),
                    per_document(docs, n, points[ends] - points[starts]),
                    cut(SYMBOL[data]),
                    per_document(line_doc[same], n),
                    per_document(docs[repeated[: len(words)]], n),
                    np.diff(end_of_line[offsets]) + 1,
                    cut(PLAIN[data] & begins),
                ]
            )
        counts = [np.concatenate(c).astype(np.int64) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * len(COUNTS)
        keys = [batch.column(0), *(batch.column(k) for k in range(2, batch.num_columns))]
        names = [batch.schema.names[0], *batch.schema.names[2:]]
        yield pa.RecordBatch.from_arrays([*keys, *map(pa.array, counts)], names=[*names, *COUNTS])


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Counts of every whole text; null or empty texts have no words (and one empty line)."""
    kind = docs.schema[doc_id].dataType.simpleString()
    frame = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
        F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"),
    )
    return frame.mapInArrow(
        _statistics, f"doc_id {kind}, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
    )


def base_failed() -> Column:
    """Too short, or more than half of the words repeated."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _share(part: str, whole: str, weight: float = 20.0) -> Column:
    """Arc sine of the square root of a share, drawn to 0 in short texts."""
    share = F.col(part) / (F.col(whole) + F.lit(weight))
    return F.asin(F.sqrt(F.least(share, F.lit(1.0))))


def vector() -> list[Column]:
    """The transformed statistics: word length, symbols, letters and digits, repeated words, repeated lines."""
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    entries = [
        4 * F.log(chars / F.greatest(F.col("n_words"), F.lit(1))),
        4 * _share("n_symbols", "word_chars"),
        4 * F.asin(F.sqrt(F.least(F.col("n_plain") / chars, F.lit(1.0)))),
        _share("n_repeat_words", "n_words"),
        2 * _share("n_dup_lines", "n_lines", 10.0),
    ]
    return [F.round(UNIT * e).cast("long").alias(n) for n, e in zip(NAMES, entries)]


def chi_square(x: float, df: float) -> float:
    """Probability that a chi-square variable of ``df`` degrees is at most x (series)."""
    a, x = df / 2, x / 2
    if x <= 0:
        return 0.0
    term = total = 1 / a
    n = 0
    while term > total * 1e-15 and n < 10_000:
        n += 1
        term *= x / (a + n)
        total += term
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a)))


def chi_square_point(p: float, df: float) -> float:
    low, high = 0.0, 10.0 * df + 200
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, df) < p else (low, mid)
    return low


def _distance(n: int = len(NAMES)) -> Column:
    """Squared Mahalanobis distance of x0.. to the group's ``mu`` with its inverse ``inv``."""
    gap = [F.col(NAMES[i]) / UNIT - F.col("mu")[i] for i in range(n)]
    total = F.lit(0.0)
    for i in range(n):
        for j in range(i, n):
            total = total + (1 if i == j else 2) * F.col("inv")[i * n + j] * gap[i] * gap[j]
    return F.when(F.col("inv").isNotNull(), F.greatest(total, F.lit(0.0)))


FLOOR = (0.15, 0.15, 0.12, 0.08, 0.12)


def _estimate(scale: float):
    """Mean and inverse covariance per group from exact sums; ``scale`` makes the covariance consistent."""
    n = len(NAMES)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pandas()
            mus, invs, dets = [], [], []
            for _, row in rows.iterrows():
                count = float(row["m"])
                mu = np.array([float(row[f"s{i}"]) for i in range(n)]) / count / UNIT
                cov = np.zeros((n, n))
                for i in range(n):
                    for j in range(i, n):
                        cov[i, j] = cov[j, i] = float(row[f"s{i}_{j}"]) / count / UNIT**2 - mu[i] * mu[j]
                # a floor keeps statistics that hardly vary in a group from deciding on their own
                cov = cov * scale + np.diag(np.square(FLOOR))
                mus.append(mu.tolist())
                invs.append(np.linalg.inv(cov).ravel().tolist())
                dets.append(float(np.linalg.slogdet(cov)[1]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("grp"),
                    batch.column("size"),
                    pa.array(mus, pa.list_(pa.float64())),
                    pa.array(invs, pa.list_(pa.float64())),
                    pa.array(dets, pa.float64()),
                ],
                names=["grp", "size", "mu", "inv", "log_det"],
            )

    return run


#: Groups beside those of a language and source, or of a language: the languages left over, and the whole table.
LANGUAGES, EVERY = '{"rest":"languages"}', '{"rest":"table"}'

PARAMETERS = "grp string, size long, mu array<double>, inv array<double>, log_det double"


def _sums(frame: DataFrame, scale: float) -> DataFrame:
    """Parameters of each ``run`` from the rows given."""
    n = len(NAMES)
    wide = {x: F.col(x).cast("decimal(18,0)") for x in NAMES}
    out = [F.count(F.lit(1)).alias("m"), F.first("size").alias("size")]
    out += [F.sum(wide[x]).cast("double").alias(f"s{i}") for i, x in enumerate(NAMES)]
    out += [
        F.sum((wide[NAMES[i]] * wide[NAMES[j]]).cast("decimal(28,0)")).cast("double").alias(f"s{i}_{j}")
        for i in range(n) for j in range(i, n)
    ]
    found = frame.groupBy(F.col("run").alias("grp")).agg(*out).mapInArrow(_estimate(scale), PARAMETERS)
    return found.withColumnRenamed("grp", "run").withColumn("grp", F.expr("substring(run, 3)"))


def _attach(rows: DataFrame, groups: DataFrame, key: str, small: bool, how: str = "inner") -> DataFrame:
    """Rows with what belongs to their group. A group may hold a third of all rows, so rows are
    never dealt out by group alone: groups are broadcast if their number has been checked,
    and repeated per salt otherwise."""
    if small:
        return rows.join(F.broadcast(groups), key, how)
    salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts).cast("long")))
    return rows.join(salted, [key, "_salt"], how).drop("_salt")


#: Entries of the shapes that runs start from are whole parts of this.
_FINE = 10_000


def _shapes(n: int):
    """Three starts per group around its median: no correlation, that of squeezed entries, that of directions."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                spread = np.array(row["spread"])
                for k, kind in enumerate(("", "t", "u")):
                    shape = np.eye(n)
                    for i in range(n if kind else 0):
                        for j in range(i, n):
                            shape[i, j] = shape[j, i] = float(row[f"{kind}{i}_{j}"]) / row["m"] / _FINE**2
                    cov = shape * np.outer(spread, spread) * (n if kind == "u" else 1) + np.diag(np.square(FLOOR))
                    out.append((f"{k}|{row['grp']}", row["grp"], row["size"], row["mu"], np.linalg.inv(cov).ravel().tolist()))
            columns = list(zip(*out)) or [[]] * 5
            kinds = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["run", "grp", "size", "mu", "inv"])

    return run


def starts(vectors: DataFrame, small: bool) -> DataFrame:
    """Where the runs of each group start: run, grp, size, mu, inv, log_det (none yet). All sums are exact."""
    n = len(NAMES)
    quartiles = [F.percentile(x, [0.25, 0.5, 0.75]).alias(f"q_{x}") for x in NAMES]
    middle = vectors.groupBy("grp").agg(F.first("size").alias("size"), *quartiles)
    spread = [F.sqrt(F.pow((F.col(f"q_{x}")[2] - F.col(f"q_{x}")[0]) / UNIT / 1.349, 2) + FLOOR[i] ** 2) for i, x in enumerate(NAMES)]
    middle = materialise(
        middle.select("grp", "size", F.array(*[F.col(f"q_{x}")[1] / UNIT for x in NAMES]).alias("mu"), F.array(*spread).alias("spread"))
    )
    z = [(F.col(x) / UNIT - F.col("mu")[i]) / F.col("spread")[i] for i, x in enumerate(NAMES)]
    far = F.greatest(F.sqrt(sum((c * c for c in z), F.lit(0.0))), F.lit(1e-9))
    whole = lambda c: F.round(c * _FINE).cast("decimal(10,0)")
    placed = _attach(vectors, middle.select("grp", "mu", "spread"), "grp", small).select(
        "grp", *[whole(F.tanh(c)).alias(f"t{i}") for i, c in enumerate(z)], *[whole(c / far).alias(f"u{i}") for i, c in enumerate(z)]
    )
    sums = [
        F.sum(F.col(f"{kind}{i}") * F.col(f"{kind}{j}")).cast("double").alias(f"{kind}{i}_{j}")
        for kind in "tu" for i in range(n) for j in range(i, n)
    ]
    shapes = placed.groupBy("grp").agg(F.count(F.lit(1)).alias("m"), *sums)
    begun = middle.join(shapes, "grp").mapInArrow(_shapes(n), "run string, grp string, size long, mu array<double>, inv array<double>")
    return begun.withColumn("log_det", F.lit(float("inf")))


def _step(vectors: DataFrame, params: DataFrame, share: float, scale: float, small: bool) -> DataFrame:
    """One concentration step of every run: measure all rows, keep the nearest, estimate anew."""
    measured = _attach(vectors, params.select("grp", "run", "mu", "inv"), "grp", small).withColumn(
        "bin", F.floor(F.log1p(_distance()) * 200).cast("int")
    )
    bins = measured.groupBy("run", "bin").agg(F.count(F.lit(1)).alias("k"), F.first("size").alias("size"))
    # at most a few thousand bins per run, gathered by an aggregate that combines in the tasks
    limit = bins.groupBy("run").agg(
        F.first("size").alias("size"),
        F.array_sort(F.collect_list(F.struct("bin", "k"))).alias("bins"),
    ).select(
        "run",
        F.aggregate(
            "bins",
            F.struct(F.lit(0).cast("long").alias("seen"), F.lit(-1).alias("last")),
            lambda a, b: F.when(
                a["seen"] >= F.ceil(F.col("size") * share), a
            ).otherwise(F.struct((a["seen"] + b["k"]).alias("seen"), b["bin"].alias("last"))),
            lambda a: a["last"],
        ).alias("last"),
    )
    return _sums(_attach(measured, limit, "run", small).where("bin <= last"), scale)


def _least(params: DataFrame) -> DataFrame:
    """Of every group the run with the least determinant."""
    best = F.min_by(F.struct("run", "size", "mu", "inv", "log_det"), F.struct("log_det", "run")).alias("best")
    return params.groupBy("grp").agg(best).select("grp", "best.*")


def minimum_covariance(vectors: DataFrame, share: float = 0.75, most_steps: int = 30, small: bool = False) -> DataFrame:
    """Minimum covariance determinant parameters of each ``grp``.

    ``vectors`` has grp, size (rows of its group) and the vector's integers. Three runs start at the
    median with different shapes (:func:`starts`). A concentration step measures all rows,
    keeps the ``share`` nearest of each run (whole bins of the distance, so the choice does not
    hang on the order of rows) and estimates anew, which does not enlarge the determinant. After two steps
    the run with the least determinant goes on until no group's determinant gets smaller, ``most_steps`` at most.
    All rows take part in every step; what is gathered is one row per run and bin. ``small`` says that
    the number of groups has been checked.
    """
    n = len(NAMES)
    cut = chi_square_point(share, n)
    scale = share / chi_square(cut, n + 2)
    params = materialise(starts(vectors, small))
    for _ in range(2):
        params = materialise(_step(vectors, params, share, scale, small))
    params = materialise(_least(params))
    for _ in range(most_steps):
        after = _step(vectors, params, share, scale, small).join(params.select("run", F.col("log_det").alias("before")), "run")
        # whole bins may let a determinant grow again: then its run has come to its end, and keeps what it had
        gain = materialise(after.where("log_det < before - 1e-6").drop("before"))
        if gain.isEmpty():
            break
        params = materialise(gain.unionByName(params.join(gain.select("run"), "run", "left_anti")))
    return params.select("grp", "size", "mu", "inv", "log_det")


def outliers(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    confidence: float = 1 - 1e-9,
    smallest_group: int = 100,
    share: float = 0.75,
    judge_all: bool = False,
) -> DataFrame:
    """Counts of every document, its squared distance ``d2``, ``base_failed`` and ``kept``.

    Groups are (language, source); sources with fewer than ``smallest_group`` usable documents are
    taken together per language. If that is still fewer, ``judge_all`` takes the languages that are
    left over together, and if even they are fewer, measures them against the estimate over all usable documents
    of the table, however few: every document that passes the base rules has a distance. Without
    ``judge_all`` such a document has no distance (null) and stays. Documents that fail the base rules have no part in the estimates. A null
    language or source is a group of its own. Null, empty and white-space texts fail the base rules.
    Repeated rows count as often as they come and get the same verdict; an empty table gives an
    empty result. Other columns are ignored, whatever their names.
    """
    stats = materialise(statistics(docs, doc_id, text, lang, source).withColumn("base_failed", base_failed()))
    pair = F.to_json(F.struct("lang", "source"))  # leaves out nulls, so null is told from any text
    stats = stats.withColumn("pair", pair)
    per_source = stats.where(~F.col("base_failed")).groupBy("pair", "lang").agg(F.count(F.lit(1)).alias("size"))
    alone = F.col("size") >= smallest_group
    named = per_source.withColumn("grp", F.when(alone, F.col("pair")).otherwise(F.to_json(F.struct(F.struct("lang").alias("rest")))))
    totals = named.groupBy("grp").agg(F.sum("size").alias("size"))
    sizes = totals.where(F.col("size") >= smallest_group).withColumn("to", F.col("grp"))
    against_all = False
    if judge_all:
        usable = totals.agg(
            F.coalesce(F.sum("size"), F.lit(0)).alias("every"),
            F.coalesce(F.sum(F.when(F.col("size") < smallest_group, F.col("size"))), F.lit(0)).alias("left"),
        ).first()
        against_all = 0 < usable["left"] < smallest_group
        to, size = (EVERY, usable["every"]) if against_all else (LANGUAGES, usable["left"])
        left = totals.where(F.col("size") < smallest_group)
        sizes = sizes.unionByName(left.select("grp", F.lit(size).cast("long").alias("size"), F.lit(to).alias("to")))
    named = materialise(named.select("pair", "grp").join(sizes, "grp").select("pair", F.col("to").alias("grp"), "size"))
    small = check_size(named).small
    vectors = stats.select("doc_id", "lang", "source", "base_failed", "pair", *COUNTS, *vector())
    vectors = _attach(vectors, named, "pair", small, "left")
    usable_rows = vectors.where("grp is not null and not base_failed").select("grp", "size", *NAMES)
    if against_all:
        every = usable_rows.withColumn("grp", F.lit(EVERY)).withColumn("size", F.lit(size).cast("long"))
        usable_rows = usable_rows.where(F.col("grp") != EVERY).unionByName(every)
    params = minimum_covariance(usable_rows, share, small=small)
    cutoff = chi_square_point(confidence, len(NAMES))
    judged = _attach(vectors, params.select("grp", "mu", "inv"), "grp", small, "left")
    return judged.select(
        "doc_id", "lang", "source", *COUNTS, "base_failed",
        F.when(~F.col("base_failed"), _distance()).alias("d2"),
    ).withColumn("kept", ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cutoff))
