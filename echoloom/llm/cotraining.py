"""Quality classifier by co-training.

Two views of a document: its text content (kinds of characters, words, repetition; nothing of its
length), and the metadata that came with it (language, source, the stated number of characters;
nothing of its text).  Each view has its own logistic model, calibrated on labels held out (Platt).
Over rounds, each model labels the unlabelled documents that it is sure of by its calibrated chance,
all of them, and the other model is fitted again with these pseudo-labels beside its labelled rows.  A
logistic combination of the views, fitted on further labels held out, scores every document.

*Sizes.*  A document's features, WIDTH numbers, are computed once and stored.  The labelled rows are
a bounded sample (`most_labelled`, a parameter, by the least hashes of doc_id).  The unlabelled
documents are all others: a round is one pass over their features, which sums for each view and
pseudo-label the curvature and gradient of the loss; the sums (fixed size) are added up in a tree, so
that neither a task nor the driver ever holds more than FAN of them.  A pseudo-label weighs at most
half of a labelled row, and those of a class together at most half of its labelled rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echoloom.llm.bytehash import _LOWER, U64, PrefixHash, byte_batches, join_texts, to_bytes, word_spans
from echoloom.llm.common import give_back, stored

#: The default bound of the labelled sample.
LABELLED = 6000
ROUNDS = 3
#: A view hands over the documents that it is at least this sure of.
SURE = 0.97
RIDGE = 5.0
#: Hashed words of the text view, hashed names of the metadata view.
WORD_SLOTS, NAME_SLOTS = 128, 32
#: Sums that are added up at once, and feature rows that are.
FAN, ROWS = 32, 2048
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[[ord(c) for c in " \t\r\v\f"]] = 4
_KIND[ord("\n")] = 5
_KIND[[ord(c) for c in ".,;:?'\"-()"]] = 6
_KIND[128:] = 7
KINDS = 8
TEXT_STATS = KINDS + 8
TEXT_WIDTH = TEXT_STATS + WORD_SLOTS
#: Stated length, whether it is stated, and its octave.
OCTAVES = 16
META_STATS = 2 + OCTAVES
META_WIDTH = META_STATS + 3 * NAME_SLOTS
WIDTH = TEXT_WIDTH + META_WIDTH
VIEWS = (slice(0, TEXT_WIDTH), slice(TEXT_WIDTH, WIDTH))


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return sums[first[1:]] - sums[first[:-1]]


def text_features(texts: list[bytes]) -> np.ndarray:
    """The text view: shares of byte kinds, word and repetition statistics, hashed word shares."""
    n = len(texts)
    out = np.zeros((n, TEXT_WIDTH))
    buf, offsets = join_texts(texts)
    size = np.maximum(np.diff(offsets) - 1, 1)
    kinds = _KIND[buf]
    for k in range(KINDS):
        out[:, k] = _per_text(kinds == k, offsets) / size
    out[:, 5] -= 1 / size  # the newline put after each text
    start, end = word_spans(buf)
    first = np.searchsorted(start, offsets)
    count = np.diff(first)
    some = np.maximum(count, 1)
    sums = PrefixHash(_LOWER[buf])
    words = sums.ranges(start, end)
    width = (end - start).astype(np.float64)
    owner = np.repeat(np.arange(n), count)
    last, head = kinds[end - 1], kinds[start]
    out[:, 8] = _per_text(width, first) / some / 10
    out[:, 9] = np.sqrt(np.maximum(_per_text(width * width, first) / some - (out[:, 8] * 10) ** 2, 0)) / 10
    out[:, 10] = _per_text((last == 0) | (last == 6), first) / some
    out[:, 11] = _per_text(last == 0, first) / some
    out[:, 12] = _per_text((head == 2) & (last == 2), first) / some
    # Repetition: the share of words, and of word pairs, that stand in the text already.
    order = np.lexsort((words, owner))
    fresh = np.ones(len(words), dtype=bool)
    fresh[1:] = (words[order][1:] != words[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    out[:, 13] = np.bincount(owner[order][fresh], minlength=n) / some
    pairs = np.zeros_like(words)
    with np.errstate(over="ignore"):
        pairs[1:] = words[1:] * U64(0x9E3779B97F4A7C15) + words[:-1]
    order = np.lexsort((pairs, owner))
    fresh[1:] = (pairs[order][1:] != pairs[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    out[:, 14] = np.bincount(owner[order][fresh], minlength=n) / some
    out[:, 15] = _per_text(words[1:] == words[:-1], np.minimum(first, max(len(words) - 1, 0))) / some if len(words) > 1 else 0
    slot = (words >> U64(32)).astype(np.int64) % WORD_SLOTS
    sign = np.where((words & U64(1)) == 1, 1.0, -1.0)
    hashed = np.bincount(owner * WORD_SLOTS + slot, weights=sign, minlength=n * WORD_SLOTS).reshape(n, WORD_SLOTS)
    out[:, TEXT_STATS:] = hashed / np.sqrt(some)[:, None] / 4
    return out


def meta_features(named: list[tuple[str | None, str | None, int | None]]) -> np.ndarray:
    """The metadata view: language, source, and both together by hash; the stated length."""
    out = np.zeros((len(named), META_WIDTH))
    for i, (lang, source, chars) in enumerate(named):
        if chars is not None and chars >= 0:
            out[i, 0] = np.log1p(chars) / 10
            out[i, 1] = 1.0
            out[i, 2 + min(OCTAVES - 1, int(chars).bit_length())] = 1.0
        for k, name in enumerate((lang, source, (lang, source))):
            out[i, META_STATS + k * NAME_SLOTS + zlib.crc32(repr(name).encode("utf-8", "surrogatepass")) % NAME_SLOTS] = 1.0
    return out


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray]]:
    """Feature rows of a batch with columns text, lang, source, n_chars, some at a time."""
    start = 0
    named = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "n_chars"))))
    for part in byte_batches(enumerate(to_bytes(t.as_py()) for t in batch.column("text"))):
        place = slice(start, start + len(part))
        x = np.hstack([text_features([t for _, t in part]), meta_features(named[place])])
        yield place, x.astype(np.float32)
        start += len(part)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1))])


def loss_terms(x: np.ndarray, y, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Curvature and gradient of the logistic loss; the last coefficient is the constant."""
    x = _with_one(x)
    p = sigmoid(x @ beta)
    return (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x, x.T @ (p - y)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float, beside: tuple | None = None) -> np.ndarray:
    """Newton steps on the ridge-penalised logistic loss, halved until the loss falls.

    `beside` is (curvature, gradient, beta): a quadratic form around beta that is added to the loss.
    """
    start = np.zeros(x.shape[1] + 1) if beside is None else beside[2]
    more, slope = (0.0, 0.0) if beside is None else beside[:2]
    penalty = np.full(len(start), ridge)
    penalty[-1] = 1e-6

    def loss(beta: np.ndarray) -> float:
        margin, away = x @ beta[:-1] + beta[-1], beta - start
        beside_it = 0.0 if beside is None else slope @ away + 0.5 * away @ more @ away
        return float(np.logaddexp(0, margin).sum() - (y * margin).sum() + 0.5 * (penalty * beta * beta).sum() + beside_it)

    beta = start.copy()
    now = loss(beta)
    for _ in range(50):
        curve, grade = loss_terms(x, y, beta)
        curve, grade = curve + np.diag(penalty), grade + penalty * beta
        if beside is not None:
            curve, grade = curve + more, grade + slope + more @ (beta - start)
        step = np.linalg.solve(curve, grade)
        while (then := loss(beta - step)) > now + 1e-9 and np.abs(step).max() >= 1e-9:
            step = step / 2
        beta, now = beta - step, then
        if np.abs(step).max() < 1e-7:
            break
    return beta


@dataclass(frozen=True)
class Model:
    centre: np.ndarray
    scale: np.ndarray
    betas: tuple[np.ndarray, np.ndarray]
    platts: tuple[np.ndarray, np.ndarray]
    joint: np.ndarray
    threshold: float = 0.5

    def standard(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(np.float64) - self.centre) / self.scale

    def margins(self, x: np.ndarray) -> list[np.ndarray]:
        """Of standardised rows."""
        return [x[:, cut] @ beta[:-1] + beta[-1] for cut, beta in zip(VIEWS, self.betas)]

    def calibrated(self, x: np.ndarray) -> list[np.ndarray]:
        """Calibrated margins of standardised rows."""
        return [np.clip(m * p[0] + p[1], -12, 12) for m, p in zip(self.margins(x), self.platts)]

    def score(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.calibrated(self.standard(x))
        return sigmoid(self.joint[0] * a + self.joint[1] * b + self.joint[2]), sigmoid(a), sigmoid(b)


class Sums:
    """For each view and pseudo-label: curvature, gradient and number of the rows handed to it."""

    def __init__(self, flat: np.ndarray | None = None) -> None:
        self.shapes = [(w.stop - w.start + 1) for w in VIEWS for _ in (0, 1)]
        self.flat = np.zeros(sum(n * n + n + 1 for n in self.shapes)) if flat is None else flat

    def parts(self, view: int, label: int):
        at = sum(n * n + n + 1 for n in self.shapes[: 2 * view + label])
        n = self.shapes[2 * view + label]
        return self.flat[at : at + n * n].reshape(n, n), self.flat[at + n * n : at + n * n + n], self.flat[at + n * n + n :][:1]

    def add(self, model: Model, x: np.ndarray) -> None:
        """Rows go to a view where the other one is sure of their label."""
        x = model.standard(x)
        chances = [sigmoid(m) for m in model.calibrated(x)]
        for view, cut in enumerate(VIEWS):
            told = chances[1 - view]
            for label, some in ((0, told <= 1 - SURE), (1, told >= SURE)):
                if some.any():
                    curve, grade, count = self.parts(view, label)
                    more = loss_terms(x[some][:, cut], float(label), model.betas[view])
                    curve += more[0]
                    grade += more[1]
                    count += some.sum()


def _vectors(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f4").reshape(-1, WIDTH)


def _handed_over(unlabelled: DataFrame, model: Model) -> Sums:
    """One pass over all unlabelled features; the partitions' sums are added in a tree of FAN-wide nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                sums.add(model, _vectors(batch.column(0).slice(start, ROWS)))
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([sums.flat.tobytes()], pa.binary())], names=["node", "sums"])

    def together(key, table):
        total = sum(np.frombuffer(b, dtype=np.float64) for b in table.sort_by("node").column("sums").to_pylist())
        return pa.table({"node": pa.array([key[0].as_py()], pa.int64()), "sums": pa.array([total.tobytes()], pa.binary())})

    nodes = unlabelled.select("x").mapInArrow(run, "node long, sums binary")
    width = nodes.rdd.getNumPartitions()
    while width > 1:
        width = -(-width // FAN)
        nodes = nodes.withColumn("parent", F.floor(F.col("node") / FAN)).groupBy("parent").applyInArrow(together, "node long, sums binary")
    row = nodes.first()
    return Sums(None if row is None else np.frombuffer(row["sums"], dtype=np.float64).copy())


def co_train(x: np.ndarray, y: np.ndarray, handed_over) -> Model:
    """Fits both views on labelled rows and what `handed_over(model)` sums of the unlabelled ones.

    Of five labelled rows, in the order given, three fit the views, one calibrates and one combines.
    """
    turn = np.arange(len(x)) % 5
    own = turn < 3
    centre, scale = (x[own].mean(axis=0), x[own].std(axis=0)) if own.any() else (np.zeros(WIDTH), np.ones(WIDTH))
    scale = np.where(scale < 1e-6, 1.0, scale)
    x = (x - centre) / scale
    betas = tuple(fit_logistic(x[own][:, cut], y[own], RIDGE) for cut in VIEWS)
    def calibrate(model: Model) -> Model:
        return replace(model, platts=tuple(fit_logistic(m[turn == 3][:, None], y[turn == 3], 0.1) for m in model.margins(x)))

    model = calibrate(Model(centre, scale, betas, (np.zeros(2), np.zeros(2)), np.zeros(3)))
    for _ in range(ROUNDS if (turn == 3).any() else 0):
        sums = handed_over(model)
        betas = []
        for view, cut in enumerate(VIEWS):
            curve, grade = np.zeros((len(model.betas[view]),) * 2), np.zeros(len(model.betas[view]))
            for label in (0, 1):
                more, slope, count = sums.parts(view, label)
                weight = 0.5 * min(1.0, (y[own] == label).sum() / max(count[0], 1.0))
                curve, grade = curve + weight * more, grade + weight * slope
            betas.append(fit_logistic(x[own][:, cut], y[own], RIDGE, (curve, grade, model.betas[view])))
        model = calibrate(replace(model, betas=tuple(betas)))
    return replace(model, joint=fit_logistic(np.stack(model.calibrated(x), axis=1)[turn == 4], y[turn == 4], 0.1))


KINDS_OF = {"text": "string", "lang": "string", "source": "string", "n_chars": "long"}


def _columns(docs: DataFrame) -> list:
    """The columns that the views read; one that is missing, or cannot be cast, is null."""
    have = set(docs.columns)
    return [(F.col(c).try_cast(kind) if c in have else F.lit(None).cast(kind)).alias(c) for c, kind in KINDS_OF.items()]


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, x) for every row, stored: the features of both views as 4-byte floats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, x in _rows_of(batch):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(place.start, len(x)), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "x"])
        give_back()

    return stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_columns(docs)).mapInArrow(run, "doc_id long, x binary"))


def fit(known_features: DataFrame, labels: DataFrame, most_labelled: int = LABELLED) -> Model:
    """Fits on `features` of documents and labels (doc_id, quality).

    Null ids or labels take no part as labels; of a document's repeated labels the lowest counts, of
    rows that repeat a labelled id the one of the least feature bytes.  Every other row is unlabelled.
    A view, calibration or combination without any row is zero, so that without labels (with fewer than
    five not all three have one) every document scores one half and is kept.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.greatest(F.least(F.min("label"), F.lit(1)), F.lit(0)).alias("label"))
    ids = known_features.select("doc_id").where("doc_id is not null").distinct()
    chosen = stored(known.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labelled))
    sample = F.broadcast(chosen)  # at most `most_labelled` rows of two numbers
    rows = known_features.join(sample, "doc_id").groupBy("doc_id").agg(F.any_value("label").alias("label"), F.min("x").alias("x"))
    table = rows.orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()  # bounded as the sample is
    x = _vectors(table.column("x").combine_chunks()) if table.num_rows else np.zeros((0, WIDTH), dtype=np.float32)
    y = table.column("label").to_numpy().astype(np.float64)
    unlabelled = known_features.join(sample, "doc_id", "left_anti")
    return co_train(x.astype(np.float64), y, lambda model: _handed_over(unlabelled, model))


SCORES = "doc_id long, quality_score double, text_score double, meta_score double, kept boolean"


def score(known_features: DataFrame, model: Model) -> DataFrame:
    """(doc_id, quality_score, text_score, meta_score, kept) for every row of `features`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                total, text, meta = model.score(_vectors(batch.column("x")))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(total), pa.array(text), pa.array(meta), pa.array(total >= model.threshold)], names=[f.split()[0] for f in SCORES.split(", ")])

    return known_features.mapInArrow(run, SCORES)


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, all columns, that the classifier does not reject; one narrow pass."""
    packed = docs.select(*_columns(docs), F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("rest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for place, x in _rows_of(batch):
                keep[place] = model.score(x)[0] >= model.threshold
            yield batch.select(["text", "rest"]).filter(pa.array(keep))
        give_back()

    kept = packed.mapInArrow(run, packed.select("text", "rest").schema)
    return kept.select(*[(F.col("text") if c == "text" else F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])
