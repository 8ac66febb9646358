"""Operator 2: quality scores by Bradley-Terry ranking of preference pairs.

Each text becomes a vector of surface statistics.  The weights w minimise the mean
logistic loss of w.(x_preferred - x_rejected) over all pairs of a preferred and a
rejected labelled text, with a small ridge, by Newton steps.  w.x ranks all texts.
The threshold is the quantile of all training scores at the share of rejected
labels, and score = sigmoid(w.x - threshold).

All labelled training rows and all of their pairs count, without making the pairs:
the loss depends on a pair by its two scores only and is smooth in them, so within an
interval of scores a row is replaced by its interpolation weights on Chebyshev nodes
(`NODES` to an interval of length 1, which leaves errors of about 1e-14), and a step's
sums over pairs become sums over pairs of nodes.  A step is one pass over the rows'
vectors and sends the driver one small table for each interval that has scores; the
threshold is selected by four histograms.  `sample_rows`, if a caller gives it,
bounds the rows of each label (chosen by a hash of the id); no query does.

Defined results: a null text is the empty text; its vector is zeros and it is
scored like any other.  Without labels of both kinds all weights are zero and
every score is 0.5, predicted 1.  Repeated rows get equal scores; a null id is held
in (its remainder is null, held_out false).  Labels other than 0 and 1 and
labels of unknown ids are ignored.  An empty table gives an empty table.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.llm.common import append_columns, cut, text_chunks

PASS_CHARS = 1 << 19
#: Interpolation nodes in each interval of scores of length 1.
NODES = 14
#: Newton steps at most, and the length of a step that ends them.
STEPS, SETTLED = 30, 1e-6
#: Training rows for one task of a step: with cores to spare, and at most.
FEW_ROWS, MANY_ROWS = 20_000, 250_000
#: Rows whose products are held at a time.
ROWS_AT_ONCE = 4096
LOWER, UPPER, OTHER_LETTER, DIGIT, SPACE, LINE, STOP, QUOTE, SYMBOL, REST = range(10)

NAMES = (
    ["log_words", "word_length", "distinct_words", "repeated_neighbours", "distinct_lines", "log_line_words", "shouted_words", "marked_words", "stopped_words", "one_sign_words", "distinct_trigrams"]
    + [f"share_{k}" for k in ("lower", "upper", "other_letter", "digit", "space", "line", "stop", "quote", "symbol", "rest")]
)


@functools.cache
def character_kinds() -> np.ndarray:
    kinds = np.full(0x110000, REST, np.uint8)
    for cp in range(0x30000):
        c = chr(cp)
        category = unicodedata.category(c)
        if category == "Ll":
            kinds[cp] = LOWER
        elif category in ("Lu", "Lt"):
            kinds[cp] = UPPER
        elif category[0] == "L":
            kinds[cp] = OTHER_LETTER
        elif category[0] == "N":
            kinds[cp] = DIGIT
        elif c.isspace():
            kinds[cp] = SPACE
        elif c in ".,;:?":
            kinds[cp] = STOP
        elif c in "'\"()-’‘“”":
            kinds[cp] = QUOTE
        elif category[0] in "PS":
            kinds[cp] = SYMBOL
    kinds[10] = LINE
    return kinds


def features(texts: list[str]) -> np.ndarray:
    """One row a text, one column a name of NAMES."""
    kinds = character_kinds()
    sizes = np.array([len(t) for t in texts], np.int64)
    code_points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), sizes)
    counts = np.bincount(owner * 10 + kinds[code_points], minlength=10 * len(texts)).reshape(-1, 10)
    shares = counts / np.maximum(sizes, 1)[:, None]
    out = np.zeros((len(texts), len(NAMES)))
    out[:, -10:] = shares
    marks = frozenset("!#$%&*@^~|+=<>_/\\")
    for i, text in enumerate(texts):
        words = text.split()
        n = len(words)
        if not n:
            continue
        lines = [x for x in text.split("\n") if x.strip()]
        trigrams = set(zip(words, words[1:], words[2:]))
        out[i, :11] = (
            np.log1p(n),
            sum(map(len, words)) / n,
            len(set(words)) / n**0.8,
            sum(map(str.__eq__, words, words[1:])) / n,
            len(set(lines)) / max(1, len(lines)),
            np.log1p(n / max(1, len(lines))),
            sum(map(str.isupper, words)) / n,
            sum(w[-1] in marks for w in words) / n,
            sum(w[-1] in ".,;:?" for w in words) / n,
            sum(len(w) == 1 and not w.isalnum() for w in words) / n,
            len(trigrams) / max(1, n - 2),
        )
    return out


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = _standard(x, self.centre, self.scale) @ self.weights - self.threshold
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


@functools.cache
def _nodes() -> tuple[np.ndarray, np.ndarray]:
    """Chebyshev nodes of [-1, 1], and the matrix from Chebyshev polynomials at a point to its weights on the nodes."""
    k = np.arange(NODES)
    angle = (k + 0.5) * np.pi / NODES
    matrix = np.cos(np.outer(k, angle)) * 2 / NODES
    matrix[0] /= 2
    return np.cos(angle), matrix


def node_sums(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> dict[int, np.ndarray]:
    """By interval of the score z.w: for label 0 and 1 and each node, the sums of the products of (1, z) with itself."""
    left, right = np.triu_indices(z.shape[1] + 1)
    sums: dict[int, np.ndarray] = {}
    for at in range(0, len(z), ROWS_AT_ONCE):
        part, label = z[at : at + ROWS_AT_ONCE], y[at : at + ROWS_AT_ONCE]
        scores = part @ w
        interval = np.floor(scores).astype(np.int64)
        point = np.clip(2 * (scores - interval) - 1, -1, 1)
        on_node = np.cos(np.outer(np.arccos(point), np.arange(NODES))) @ _nodes()[1]
        wide = np.concatenate([np.ones((len(part), 1)), part], axis=1)
        products = wide[:, left] * wide[:, right]
        group = interval * 2 + label
        order = np.argsort(group, kind="stable")
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(group[order])) + 1, [len(order)]])
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            rows = order[lo:hi]
            key = int(group[rows[0]])
            own = sums.setdefault(key >> 1, np.zeros((2, NODES, len(left))))
            own[key & 1] += on_node[rows].T @ products[rows]
    return sums


def pair_slopes(sums: dict[int, np.ndarray], wide: int, pairs: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the mean log-likelihood over all pairs, from `node_sums` of all rows."""
    left, right = np.triu_indices(wide + 1)
    at = np.concatenate([k + (_nodes()[0] + 1) / 2 for k in sorted(sums)])
    bad, good = (np.concatenate([sums[k][label] for k in sorted(sums)]) for label in (0, 1))
    first = left == 0  # columns of 1 and z; the others are z with z
    gradient, cross = np.zeros(wide), np.zeros((wide, wide))
    half = np.zeros((wide, wide))
    upper = left[~first] - 1, right[~first] - 1
    of_bad, bent_bad = np.zeros(len(at)), np.zeros(len(at))
    for lo in range(0, len(at), 16 * NODES):
        own = good[lo : lo + 16 * NODES]
        lost = 1 / (1 + np.exp(np.clip(at[lo : lo + 16 * NODES, None] - at, -500, 500)))
        bent = lost * (1 - lost)
        gradient += (lost @ bad[:, 0]) @ own[:, first][:, 1:]
        half[upper] += (bent @ bad[:, 0]) @ own[:, ~first]
        cross += own[:, first][:, 1:].T @ (bent @ bad[:, first][:, 1:])
        of_bad += own[:, 0] @ lost
        bent_bad += own[:, 0] @ bent
    gradient -= of_bad @ bad[:, first][:, 1:]
    half[upper] += bent_bad @ bad[:, ~first]
    curve = half + np.triu(half, 1).T - cross - cross.T
    return gradient / pairs, curve / pairs


def _newton(wide: int, slopes: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], ridge: float) -> np.ndarray:
    w = np.zeros(wide)
    for _ in range(STEPS):
        gradient, curve = slopes(w)
        move = np.linalg.solve(curve + ridge * np.eye(wide), gradient - ridge * w)
        w = w + move * min(1.0, 5 / max(1e-12, np.linalg.norm(move)))
        if np.linalg.norm(move) < SETTLED:
            break
    return w


def _standard(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - centre) / scale, -8, 8)


def fit_pairs(x: np.ndarray, y: np.ndarray, shares: tuple[float, float] | None = None, pairs: int | None = None, ridge: float = 1e-3, seed: int = 7) -> Model:
    """Bradley-Terry weights from preferences of label 1 over label 0, over all pairs or so many drawn ones; shares: of the labels in all labelled rows."""
    wide = x.shape[1]
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Model(np.zeros(wide), np.ones(wide), np.zeros(wide), 0.0)
    centre, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = _standard(x, centre, scale)
    if pairs is None:
        w = _newton(wide, lambda w: pair_slopes(node_sums(z, y, w), wide, len(good) * len(bad)), ridge)
    else:
        draw = np.random.default_rng(seed)
        d = z[draw.choice(good, pairs)] - z[draw.choice(bad, pairs)]

        def slopes(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-np.clip(d @ w, -500, 500)))
            return d.T @ (1 - p) / pairs, (d * (p * (1 - p))[:, None]).T @ d / pairs

        w = _newton(wide, slopes, ridge)
    scores = z @ w
    rate = shares[0] / sum(shares) if shares else len(bad) / len(y)
    each = np.where(y == 1, (1 - rate) / len(good), rate / len(bad))
    order = np.argsort(scores)
    mass = np.cumsum(each[order])
    k = int(np.searchsorted(mass, rate - 1e-9))
    low, high = scores[order[min(k, len(order) - 1)]], scores[order[min(k + 1, len(order) - 1)]]
    return Model(centre, scale, w, float((low + high) / 2))


def feature_columns(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    def run(texts: pa.Array) -> list[pa.Array]:
        rows = [r for chunk in text_chunks(texts, PASS_CHARS) for r in features(chunk).tolist()]
        return [pa.array(rows, pa.list_(pa.float64()))]

    return append_columns(df, run, text, keep, [("features", T.ArrayType(T.DoubleType()), pa.list_(pa.float64()))])


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def labelled_sample(df: DataFrame, labels: DataFrame, label: str, train: Column, sample_rows: int, doc_id: str, text: str) -> tuple[DataFrame, tuple[int, int]]:
    """(text and y of about sample_rows training rows of each label, the labels' counts among all training rows)."""
    known = labels.select(F.col("doc_id").alias("__id"), F.col(f"`{label}`").cast("int").alias("y")).where("y in (0, 1) and __id is not null").where(train)
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    chance = F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) / (1 << 30)
    wanted = F.lit(False)
    for y, n in counts.items():
        wanted = wanted | ((F.col("y") == y) & (chance < min(1.0, sample_rows / n)))
    # bounded: about 2 * sample_rows rows of two numbers
    chosen = F.broadcast(known.where(wanted))
    rows = df.select(F.col(f"`{doc_id}`").alias("__doc"), F.col(f"`{text}`").alias("text"))  # further columns may have any names
    return rows.join(chosen, F.col("__doc") == F.col("__id")).select("text", "y"), (counts.get(0, 0), counts.get(1, 0))


def _vectors(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(features, y) of rows of (y, features as bytes)."""
    x = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float64).reshape(-1, len(NAMES))
    return x, batch.column(0).to_numpy().astype(np.int64)


def training_rows(df: DataFrame, labels: DataFrame, label: str, train: Column, doc_id: str, text: str) -> DataFrame:
    """(y, features as bytes) of all labelled training rows, materialised."""
    spark = df.sparkSession
    known = labels.select(F.col("doc_id").alias("__id"), F.col(f"`{label}`").cast("int").alias("y")).where("y in (0, 1) and __id is not null").where(train)
    docs = df.select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").alias("text")).where(F.col("__id").isNotNull()).where(train)

    def run(texts: pa.Array) -> list[pa.Array]:
        rows = [r.tobytes() for chunk in text_chunks(texts, PASS_CHARS) for r in features(chunk)]
        return [pa.array(rows, pa.binary())]

    # vectors travel, not texts
    made = append_columns(docs, run, "text", ["__id"], [("features", T.BinaryType(), pa.binary())])
    number = known.count()
    tasks = max(1, -(-number // MANY_ROWS), min(spark.sparkContext.defaultParallelism, -(-number // FEW_ROWS)))
    rows = made.join(known, "__id").repartition(tasks, "__id").sortWithinPartitions("y", "features")  # sums repeat alike
    return cut(rows.select("y", "features"), spark)


def _moments(rows: DataFrame) -> tuple[tuple[int, int], np.ndarray, np.ndarray]:
    """(numbers of rows of label 0 and 1, mean and deviation of each feature)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = _vectors(batch)
                mean = x.mean(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int((y == 0).sum())]), pa.array([int((y == 1).sum())]), pa.array([mean.tobytes()]), pa.array([((x - mean) ** 2).sum(axis=0).tobytes()])],
                    names=["bad", "good", "mean", "square"],
                )

    bad = good = 0
    mean, square = np.zeros(len(NAMES)), np.zeros(len(NAMES))
    for r in rows.mapInArrow(run, "bad long, good long, mean binary, square binary").collect():
        before, more = bad + good, r.bad + r.good
        bad, good = bad + r.bad, good + r.good
        gap = np.frombuffer(r["mean"]) - mean
        mean = mean + gap * more / (before + more)
        square = square + np.frombuffer(r.square) + gap**2 * before * more / (before + more)
    scale = np.sqrt(square / max(1, bad + good))
    return (bad, good), mean, np.where(scale > 1e-9, scale, 1.0)


def _all_node_sums(rows: DataFrame, centre: np.ndarray, scale: np.ndarray, w: np.ndarray) -> dict[int, np.ndarray]:
    """node_sums of all rows: added up in each task, then by interval."""

    def table(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["at", "sums"])

    def add(sums: dict[int, np.ndarray], more: Iterator[tuple[int, np.ndarray]]) -> None:
        for k, v in more:
            sums[k] = sums[k] + v if k in sums else v

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x, y = _vectors(batch)
            add(sums, node_sums(_standard(x, centre, scale), y, w).items())
        yield table(sums)

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            add(sums, zip(batch.column(0).to_pylist(), map(np.frombuffer, batch.column(1).to_pylist())))
        yield table(sums)

    schema = "at long, sums binary"
    added = rows.mapInArrow(one, schema).repartition(4, "at").sortWithinPartitions("at", "sums").mapInArrow(up, schema)
    return {r.at: np.frombuffer(r.sums).reshape(2, NODES, -1) for r in added.collect()}


def _middle(rows: DataFrame, centre: np.ndarray, scale: np.ndarray, w: np.ndarray, rank: int) -> float:
    """Between the scores of this rank (from 1) and the next, exactly: by histograms of 16 bits of a number in the scores' order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = (_standard(_vectors(batch)[0], centre, scale) @ w + 0.0).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits))], names=["k"])

    keys = cut(rows.mapInArrow(run, "k long"), rows.sparkSession)
    low, left = 0, rank
    for shift in (48, 32, 16, 0):
        # the highest bits are signed, the others aren't
        here = keys if shift == 48 else keys.where(F.shiftright("k", shift + 16) == low)
        part = F.shiftright("k", shift)
        counts = sorted((r.p, r.n) for r in here.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
        for low, n in counts:
            if left <= n:
                break
            left -= n
    upto, after = keys.agg(F.count(F.when(F.col("k") <= low, 1)), F.min(F.when(F.col("k") > low, F.col("k")))).first()
    high = low if upto > rank or after is None else after
    ends = np.array([low, high], np.int64)
    return float(np.where(ends < 0, ends ^ np.int64(2**63 - 1), ends).view(np.float64).mean())


def fit(df: DataFrame, labels: DataFrame, train: Column, label: str = "quality", text: str = "text", doc_id: str = "doc_id", sample_rows: int | None = None, ridge: float = 1e-3) -> Model:
    """Fits on all labelled rows for which `train` (an expression over __id) holds, or on about sample_rows of each label."""
    if sample_rows is not None:
        sample, counts = labelled_sample(df, labels, label, train, sample_rows, doc_id, text)
        rows = feature_columns(sample, "text", ["y"]).toPandas()
        if not len(rows):
            return fit_pairs(np.zeros((0, len(NAMES))), np.zeros(0))
        rows = rows.assign(first=rows.features.map(lambda f: tuple(f))).sort_values(["y", "first"], kind="stable")
        return fit_pairs(np.array(rows.features.tolist()), rows.y.to_numpy(), (counts[0], counts[1]) if min(counts) else None)
    rows = training_rows(df, labels, label, train, doc_id, text)
    (bad, good), centre, scale = _moments(rows)
    if not bad or not good:
        return fit_pairs(np.zeros((0, len(NAMES))), np.zeros(0))
    wide = len(NAMES)
    w = _newton(wide, lambda w: pair_slopes(_all_node_sums(rows, centre, scale, w), wide, bad * good), ridge)
    return Model(centre, scale, w, _middle(rows, centre, scale, w, bad))


def score(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds score (double, 0 to 1)."""

    def run(texts: pa.Array) -> list[pa.Array]:
        parts = [model.score(features(chunk)) for chunk in text_chunks(texts, PASS_CHARS)]
        return [pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())]

    keep = [c for c in (keep if keep is not None else df.columns) if c != "score"]
    return append_columns(df, run, text, keep, [("score", T.DoubleType(), pa.float64())])
