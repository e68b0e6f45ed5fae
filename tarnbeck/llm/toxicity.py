"""Toxicity: a factorization machine over hashed terms."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, slices

#: Training takes at most so many labelled rows.
TRAIN_ROWS = 12_000
#: Every bucket is a parameter of the machine, with so many factors.
BUCKETS, FACTORS = 1 << 20, 6
PREFIXES = (4, 5, 6)
#: Weight of the L1 penalty, in standard errors of a bucket's gradient under no effect; L2 of weights and factors.
L1, L2_WEIGHT, L2_FACTOR = 3.5, 1e-4, 1e-3
#: Passes over the live buckets between two looks at all of them, and after the last; such looks at most.
INNER, FINAL, LOOKS, SEED = 40, 150, 12, 11
#: Residuals are summed as whole multiples of this, so that sums don't depend on their order.
_GRAIN = 2.0**-40

_LETTERS = re.compile(r"[^\W\d_]+").findall
#: Words remembered at once, and the longest remembered; longer ones are hashed each time.
_MEMO_WORDS, _MEMO_LETTERS = 300_000, 32


def word_terms(word: str) -> tuple[int, ...]:
    """Hash buckets of a lower-case word: itself and its beginnings, which inflected and compound
    forms share."""
    own = [xxhash.xxh32_intdigest(word) % BUCKETS]
    own += [xxhash.xxh32_intdigest(word[:k] + "*") % BUCKETS for k in PREFIXES if len(word) >= k]
    return tuple(own)


class _Terms(dict):
    def __missing__(self, word: str):
        if len(word) > _MEMO_LETTERS:
            return word_terms(word)
        if len(self) >= _MEMO_WORDS:
            self.clear()
        out = self[word] = word_terms(word)
        return out


def text_terms(text: str, memo: _Terms) -> set[int]:
    out: set[int] = set()
    for w in set(_LETTERS(text.lower())):
        out.update(memo[w])
    return out


class FactorizationMachine:
    """score = sigmoid(w0 + sum w_i + sum over pairs <v_i, v_j>) over the buckets a text has. Buckets that
    the L1 penalty holds at nothing aren't stored."""

    def __init__(self, terms, w0: float, w: np.ndarray, v: np.ndarray):
        self.at = {int(t): i for i, t in enumerate(terms)}
        self.w0, self.w, self.v = w0, w, v
        self.v2 = (v * v).sum(1)

    def score(self, terms: set[int]) -> float:
        i = [self.at[t] for t in terms if t in self.at]
        z = self.w0
        if i:
            i.sort()
            xv = self.v[i].sum(0)
            z += float(self.w[i].sum()) + 0.5 * float((xv * xv).sum() - self.v2[i].sum())
        return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))


class _Fit:
    """Full-batch Adam on the logistic loss over the live buckets; row and col place their ones."""

    def __init__(self, y: np.ndarray):
        self.y, self.n = y, len(y)
        self.rate = min(max(float(y.mean()) if len(y) else 0.0, 1e-3), 1 - 1e-3)
        self.b = float(np.log(self.rate / (1 - self.rate)))
        self.p = np.zeros((0, FACTORS + 1))  # weight, factors
        self.rng = np.random.default_rng(SEED)

    def grow(self, k: int) -> None:
        new = np.concatenate([np.zeros((k, 1)), self.rng.normal(0, 0.02, (k, FACTORS))], 1)
        self.p = np.concatenate([self.p, new])

    def residual(self) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.z, -30, 30))) - self.y

    @property
    def z(self) -> np.ndarray:
        return getattr(self, "_z", np.full(self.n, self.b))

    def run(self, row: np.ndarray, col: np.ndarray, steps: int, penalty: np.ndarray | None, rate: float = 0.05) -> None:
        """row ascends. penalty: L1 of each live weight, by proximal steps; None for none."""
        n, k = self.n, len(self.p)
        size = np.bincount(row, minlength=n)
        some, start = np.nonzero(size)[0], np.cumsum(size) - size
        order = np.argsort(col, kind="stable")
        of, first = row[order], np.cumsum(np.bincount(col, minlength=k)) - np.bincount(col, minlength=k)
        m, s, mb, sb = np.zeros_like(self.p), np.zeros_like(self.p), 0.0, 0.0

        def forward():
            sums = np.zeros((n, FACTORS + 1))
            sums[some] = np.add.reduceat(self.p[col], start[some], axis=0)
            own = np.bincount(row, weights=(self.p[:, 1:] ** 2).sum(1)[col], minlength=n)
            self._z = self.b + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(1) - own)
            return sums

        for step in range(1, steps + 1):
            sums = forward()
            g = self.residual() / n
            sums[:, 0] = 1
            grad = np.add.reduceat((sums * g[:, None])[of], first, axis=0)
            grad[:, 1:] += (L2_FACTOR - grad[:, :1]) * self.p[:, 1:]
            grad[:, 0] += L2_WEIGHT * self.p[:, 0]
            m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * grad**2
            mb, sb = 0.9 * mb + 0.1 * g.sum(), 0.999 * sb + 0.001 * g.sum() ** 2
            scale = np.sqrt(s / (1 - 0.999**step)) + 1e-8
            self.p -= rate * (m / (1 - 0.9**step)) / scale
            if penalty is not None:
                self.p[:, 0] = np.sign(self.p[:, 0]) * np.maximum(np.abs(self.p[:, 0]) - rate * penalty / scale[:, 0], 0)
            self.b -= rate * (mb / (1 - 0.9**step)) / (np.sqrt(sb / (1 - 0.999**step)) + 1e-8)
        forward()


def _bucket(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode()) % 4


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> FactorizationMachine:
    """Fit on labelled rows whose crc32(id as text) mod 4 is not 2: all of them up to train_rows,
    beyond that about train_rows chosen by a hash of the id.

    All BUCKETS are parameters under an L1 penalty that is the same for each in standard errors of its
    gradient, so rare and common terms are treated alike and none is left out by a count. Most stay at
    nothing. Which don't is found by looks at the gradient of all buckets, summed in Spark: buckets that
    the penalty doesn't hold become live and are fitted, until a look finds no other. The live ones,
    with their factors, are then fitted to the end without L1. The driver gets the live buckets and,
    for each training row, which of them it has.

    Null labels, ids and texts don't train; of repeated ids, the greatest label and least text do; other
    columns of docs and labels are ignored. Without labels of both classes the machine gives every text
    the base rate.
    """
    spark = docs.sparkSession
    y = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where(
        "doc_id is not null and y is not null and crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2"
    )
    y = y.groupBy("doc_id").agg(F.max("y").alias("y"))
    n = y.count()
    if n > train_rows:
        y = y.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) < int(1_000_000 * train_rows / n))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    texts = texts.join(F.broadcast(y), "doc_id")  # bounded by train_rows
    # one text an id, however often an id is repeated
    texts = texts.groupBy("doc_id", "y").agg(F.min("text").alias("text"))

    def tokens(batches):
        memo = _Terms()
        for part in slices(batches, "text"):
            own = [np.array(sorted(text_terms(x, memo)), "<u4").tobytes() for x in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(own, pa.binary())], ["doc_id", "y", "own"])

    rows = materialize(texts.mapInArrow(tokens, "doc_id long, y int, own binary"), "training")
    got = rows.select("doc_id", "y").toArrow().sort_by("doc_id")
    ids, truth = got.column("doc_id").to_numpy(), (got.column("y").to_numpy() > 0).astype(np.float64)
    fit = _Fit(truth)
    live = np.zeros(0, np.int64)
    row = col = np.zeros(0, np.int64)
    penalty = np.zeros(0)
    if len(truth) and 0 < truth.sum() < len(truth):
        for _ in range(LOOKS):
            new, df = _escaped(spark, rows, ids, fit, live)
            if not len(new):
                break
            share = df / len(ids)
            penalty = np.concatenate([penalty, L1 * np.sqrt(fit.rate * (1 - fit.rate) * share * (1 - share) / len(ids))])
            live = np.concatenate([live, new])
            fit.grow(len(new))
            row, col = _ones(spark, rows, ids, live)
            fit.run(row, col, INNER, penalty)
        if len(live):
            fit.run(row, col, FINAL, None)
    discard(rows)
    order = np.argsort(live)
    return FactorizationMachine(live[order], fit.b, fit.p[order, 0], fit.p[order, 1:])


def _escaped(spark, rows: DataFrame, ids: np.ndarray, fit: _Fit, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets, but for the live ones, whose gradient the penalty doesn't hold, and in how many rows they are."""
    shared = spark.sparkContext.broadcast((ids, np.rint(fit.residual() / _GRAIN).astype(np.int64)))

    def run(batches):
        at, g = shared.value
        sums, counts = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for part in batches:
            place = np.searchsorted(at, part.column(0).to_numpy())
            for i, raw in zip(place, part.column(1), strict=True):
                own = np.frombuffer(raw.as_buffer(), "<u4")
                sums[own] += g[i]
                counts[own] += 1
        own = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(sums[own]), pa.array(counts[own])], ["term", "g", "df"])

    n = float(len(ids))
    summed = rows.select("doc_id", "own").mapInArrow(run, "term long, g long, df long").groupBy("term").agg(F.sum("g").alias("g"), F.sum("df").alias("df"))
    free = F.abs(F.col("g")) * _GRAIN > L1 * F.sqrt(fit.rate * (1 - fit.rate) * F.col("df") * (1 - F.col("df") / n))
    got = summed.where(free).select("term", "df").toArrow().sort_by("term")
    term, df = got.column("term").to_numpy(), got.column("df").to_numpy()
    new = ~np.isin(term, live)
    shared.unpersist()
    return term[new], df[new]


def _ones(spark, rows: DataFrame, ids: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the training rows have live buckets, by ascending row."""
    shared = spark.sparkContext.broadcast(live)

    def run(batches):
        place = np.full(BUCKETS, -1, np.int32)
        place[shared.value] = np.arange(len(shared.value))
        for part in batches:
            own = [place[np.frombuffer(raw.as_buffer(), "<u4")] for raw in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x[x >= 0].tobytes() for x in own], pa.binary())], ["doc_id", "own"])

    got = rows.select("doc_id", "own").mapInArrow(run, "doc_id long, own binary").toArrow().sort_by("doc_id")
    own = [np.frombuffer(x.as_buffer(), np.int32) for x in got.column("own")]
    shared.unpersist()
    return np.repeat(np.arange(len(own)), [len(x) for x in own]), np.concatenate([*own, np.zeros(0, np.int32)]).astype(np.int64)


def score(docs: DataFrame, machine: FactorizationMachine, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Score every whole text: doc_id, held_out, score, predicted (1 if score >= threshold).

    Null and empty texts have no terms and get the machine's base score. Nothing but the text enters
    a score. Rows are independent: repeated rows and null ids (held_out by the text of null, "None")
    need no rule. No shuffle; the machine is the only thing broadcast: its live buckets, BUCKETS at most.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        fm, memo = shared.value, _Terms()
        for part in slices(batches, "text"):
            s = [fm.score(text_terms(t or "", memo)) for t in part.column(1).to_pylist()]
            held = [_bucket(i) == 2 for i in part.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(held), pa.array(s, pa.float64()), pa.array([int(v >= threshold) for v in s], pa.int32())],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int"
    )


def keep_clean(docs: DataFrame, machine: FactorizationMachine, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows, with all their columns, whose text scores below threshold. Null and empty texts have the
    machine's base score; repeated rows and null ids are each judged alone; an empty table stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    at = docs.columns.index(text_col)

    def run(batches):
        fm, memo = shared.value, _Terms()
        for part in slices(batches, text_col):
            clean = [fm.score(text_terms(t or "", memo)) < threshold for t in part.column(at).to_pylist()]
            yield part.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
