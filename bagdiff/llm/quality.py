"""Document quality by Bradley-Terry pairwise ranking.

Each text is read whole into the features of ``FEATURES``. A document's score is
linear in them; that a good document i beats a bad one j has probability
sigmoid(s_i - s_j). The weights minimise the logistic loss of the feature differences
of preference pairs, with a small ridge, by Newton steps on the driver, over at most
``PAIRS`` pairs of at most ``SAMPLE`` labelled documents, those with the smallest hash
of their id. The threshold is the quantile of the training scores at the share of
bad documents; scores are mapped to 0..1 so that it becomes ``THRESHOLD``. ``fit`` takes it from
the sample, ``calibrated`` from the scores of all labelled training documents, by a narrow join and
an approximate quantile whose rank is off by a millionth at most.

Features are computed in Spark tasks; only those of the bounded sample reach the
driver.

Defined results: a null, empty or wordless text has all features zero and gets their
score. Without documents of both labels there is no ranking and every score is 0.5.
Labels other than 0 and 1, and those whose document is missing, do not train; of
several labels for an id, or documents of one id, each combination trains. Equal
hashes are ordered by id. Repeated rows are scored each for itself; other columns
are kept.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bagdiff.llm.common import arrow_column, chunks

SAMPLE = 8_000
PAIRS = 40_000
THRESHOLD = 0.3

FEATURES = (
    "log_words",
    "log_mean_word",
    "upper",
    "symbols",
    "digits",
    "bars",
    "exclaims",
    "sentence_marks",
    "distinct_words",
    "distinct_pairs",
    "repeats",
    "top_word",
    "short_words",
    "marked_words",
    "upper_words",
    "line_copies",
    "log_line",
)


def features(text: str) -> list[float]:
    """The features of one whole text, in the order of FEATURES."""
    from collections import Counter
    from math import log1p

    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = len(text)
    counts = Counter(words)
    pairs = set(zip(words, words[1:], strict=False))
    lines = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(len, words))
    capitals = sum(1 for w in words if len(w) > 1 and w.isupper())
    plain = text.translate(_DROP)
    symbols = sum(map(text.count, "#$%&*@^~<>{}[]\\=+_"))
    marked = sum(1 for w in counts if w[-1] in _MARKS for _ in range(counts[w]))
    return [
        log1p(n),
        log1p(letters / n),
        (size - len(plain)) / size,
        symbols / size,
        sum(map(text.count, "0123456789")) / size,
        text.count("|") / n,
        text.count("!") / n,
        (text.count(".") + text.count(",")) / n,
        len(counts) / n,
        (len(pairs) + 1) / n,
        sum(1 for a, b in zip(words, words[1:], strict=False) if a == b) / n,
        max(counts.values()) / n,
        sum(c for w, c in counts.items() if len(w) <= 3) / n,
        marked / n,
        capitals / n,
        1 - len(set(lines)) / len(lines),
        log1p(n / len(lines)),
    ]


_DROP = {c: None for c in range(ord("A"), ord("Z") + 1)}
_MARKS = frozenset("#$%&*@^~<>{}[]\\=+_|!")


@dataclass
class Ranking:
    """Scores are ``weights . (features - mean) / spread``; ``cut`` is the threshold among them, ``scale`` their spread."""

    mean: object
    spread: object
    weights: object
    cut: float
    scale: float

    def raw(self, rows):
        import numpy as np

        return np.clip((rows - self.mean) / self.spread, -8, 8) @ self.weights

    def score(self, rows):
        """0 to 1; ``cut`` becomes THRESHOLD."""
        import numpy as np

        at = (self.raw(rows) - self.cut) / self.scale + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(at, -40, 40)))


def with_features(df: DataFrame, text: str = "text", into: str = "features") -> DataFrame:
    """``df`` with an array of doubles ``into``."""

    def run(batches):
        import pyarrow as pa

        for texts in batches:
            yield pa.array([features(t) for _, part in chunks(texts) for t in part], pa.list_(pa.float64()))

    return df.withColumn(into, arrow_column(run, "array<double>", F.col(text)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
    pairs: int = PAIRS,
) -> Ranking | None:
    """Learn from documents with a label 0 or 1; None without both."""
    import numpy as np

    usable = labels.filter(F.col(label).isin(0, 1) & F.col(id).isNotNull())
    usable = usable.select(F.col(id).alias("__id"), F.col(label).cast("int").alias("__label"))
    chosen = usable.orderBy(F.xxhash64("__id"), "__id", "__label").limit(sample)
    own = docs.select(F.col(id).alias("__doc"), F.col(text).alias("__text"))
    found = own.join(F.broadcast(chosen), F.col("__doc") == F.col("__id"))  # at most `sample` rows
    rows = with_features(found.select("__id", "__label", "__text"), "__text", "x").select("__id", "__label", "x")
    got = rows.orderBy("__id", "__label").limit(2 * sample).collect()
    y = np.array([r["__label"] for r in got], int)
    if not 0 < y.sum() < len(y):
        return None
    x = np.array([r["x"] for r in got], float)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = np.clip((x - mean) / spread, -8, 8)
    rng = np.random.default_rng(1)
    good, bad = x[y == 1], x[y == 0]
    diff = good[rng.integers(0, len(good), pairs)] - bad[rng.integers(0, len(bad), pairs)]
    weights, ridge = np.zeros(x.shape[1]), 1e-3 * np.eye(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(diff @ weights, -30, 30)))
        step = np.linalg.solve((diff * (p * (1 - p))[:, None]).T @ diff / pairs + ridge, diff.T @ (p - 1) / pairs + ridge @ weights)
        weights -= step
        if abs(step).max() < 1e-8:
            break
    raw = x @ weights
    cut = float(np.quantile(raw, 1 - y.mean()))
    return Ranking(mean, spread, weights, cut, float(max(raw.std() / 2, 1e-9)))


def with_raw(df: DataFrame, ranking: Ranking, text: str = "text", into: str = "raw") -> DataFrame:
    """``df`` with a double ``into``: the linear score. Rows are neither moved nor dropped."""
    shared = df.sparkSession.sparkContext.broadcast(ranking)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for texts in batches:
            rows = [features(t) for _, part in chunks(texts) for t in part]
            yield pa.array(shared.value.raw(np.array(rows, float).reshape(len(rows), len(FEATURES))), pa.float64())

    return df.withColumn(into, arrow_column(run, "double", F.col(text)))


def calibrated(
    ranking: Ranking, scored: DataFrame, labels: DataFrame, id: str = "doc_id", label: str = "quality", raw: str = "raw"
) -> Ranking:
    """``ranking`` with the threshold and spread of all labelled rows of ``scored`` (``id``, ``raw``), as many as there are."""
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(id).isNotNull())
    usable = usable.select(F.col(id).alias("__id"), F.col(label).cast("int").alias("__label"))
    own = scored.select(F.col(id).alias("__doc"), F.col(raw).alias("__raw"))
    rows = own.join(usable, F.col("__doc") == F.col("__id")).select("__raw", "__label")
    good, spread = rows.agg(F.avg("__label"), F.stddev_pop("__raw")).first()
    if good is None or not 0 < good < 1:
        return ranking
    cut = rows.agg(F.percentile_approx("__raw", 1 - good, 1_000_000)).first()[0]
    return replace(ranking, cut=float(cut), scale=float(max(spread / 2, 1e-9)))


def score_of(raw: Column, ranking: Ranking) -> Column:
    """The score of a linear score, as ``Ranking.score`` gives it."""
    from math import log

    at = (raw - F.lit(ranking.cut)) / F.lit(ranking.scale) + F.lit(log(THRESHOLD / (1 - THRESHOLD)))
    return 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), at))))


def with_score(df: DataFrame, ranking: Ranking | None, text: str = "text", into: str = "score") -> DataFrame:
    """``df`` with a double ``into``. Rows are neither moved nor dropped."""
    if ranking is None:
        return df.withColumn(into, F.lit(0.5))
    shared = df.sparkSession.sparkContext.broadcast(ranking)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for texts in batches:
            rows = [features(t) for _, part in chunks(texts) for t in part]
            yield pa.array(shared.value.score(np.array(rows, float).reshape(len(rows), len(FEATURES))), pa.float64())

    return df.withColumn(into, arrow_column(run, "double", F.col(text)))
