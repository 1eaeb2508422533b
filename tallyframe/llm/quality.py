"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text features.

A document's score is the sum of the weights of the hashed slots that its text has: bare words (letters alone, so that marks around a
word don't hide it), shapes of words (kinds of characters, runs of letters and digits as one) at the least shares that they reach, and
levels of repetition. Ordered thresholds c0 < c1 < ... cut the score into grades: P(grade >= j) = sigmoid(score - c_j). All grades
share the weights. The model gives the expected grade and the tail probability P(grade >= least), by which rows are selected.

Ratings are graded from labels: 0 toxic, 1 low quality, 2 good. The model is fitted on a bounded sample of the labelled rows (SAMPLE_ROWS of
each grade, those whose hashed ids come first), weighted to the grades' numbers among all labels. Most slots are words that a few texts
have by chance; only those get a weight whose counts depart from independence of the grade (log-likelihood ratio) by more than the
largest departure expected of so many slots by chance. The strength of the squared penalty is the one under which
models of each half of the sample, with slots chosen on that half alone, give the other half the greatest likelihood. Every row of
the corpus is scored over its whole text.

Defined cases: null text is empty and has no slots; very long texts are hashed a megabyte at a time and count whole; labels without a
document or with null grades or ids are not fitted on; of repeated labels of an id the lowest grade counts; of an id's several texts the one
whose hash comes first is fitted on; ids of any type will do; ties in the sample's order are cut by id; repeated rows score alike; with
fewer than two grades every row is kept with the highest grade's probability 1; an empty table gives an empty result; extra columns
are kept, and columns of the names that scored() adds are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import fresh, materialize, mix, run_hashes

GRADES = 3
#: The bound of the fitting sample: so many labelled rows of each grade at most.
SAMPLE_ROWS = 2_500
SLOT_BITS = 30
STRENGTHS = (0.03, 0.1, 0.3, 1.0, 3.0)
STEPS = 300
#: Rows are kept whose probability of the top grade is at least this.
KEEP = 0.5

#: Shapes count as present at shares of at least 1/2, 1/4, 1/8, 1/16 and at all.
_SHARES = 5
_BARE = np.arange(256, dtype=np.uint8)
_BARE[[*range(33, 65), *range(91, 97), *range(123, 128)]] = 32
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[48:58], _SHAPE[65:91], _SHAPE[97:123], _SHAPE[128:] = 48, 1, 2, 2
_RUNS = np.zeros(256, bool)
_RUNS[[1, 2, 48]] = True


def _slots(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (mix(hashes ^ mix(np.array([kind], np.uint64))) >> np.uint64(64 - SLOT_BITS)).astype(np.int32)


def _levels(n: int, kind: int) -> np.ndarray:
    """Slots of the levels below n."""
    return _slots(np.arange(n, dtype=np.uint64), kind)


def _repeats(values: np.ndarray) -> int:
    """The share of values that occurred before, in eighths."""
    return int(8 * (1 - len(np.unique(values)) / len(values)))


def features(text: str | None) -> np.ndarray:
    """The distinct slots of a text, sorted."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    words, shape = run_hashes(_BARE[raw]), _SHAPE[raw]
    same = np.zeros(len(shape), bool)
    same[1:] = (shape[1:] == shape[:-1]) & _RUNS[shape[1:]]
    forms = run_hashes(shape[~same])
    found = [_slots(np.unique(words), 1)]
    if len(forms):
        kinds, n = np.unique(forms, return_counts=True)
        level = np.minimum(-np.log2(n / len(forms)), _SHARES - 1).astype(np.int64)
        found += [_slots(kinds[level <= k], 10 + k) for k in range(_SHARES)]
    if len(words) > 1:
        again = float((words[1:] == words[:-1]).mean())
        found += [_levels(int(8 * again), 20), _levels(_repeats(words), 21), _levels(_repeats(mix(words[1:] ^ mix(words[:-1]))), 22)]
    return np.unique(np.concatenate(found))


@dataclass
class OrdinalModel:
    """Weights of the sorted slots, increasing thresholds; there are as many as grades above the lowest."""

    slots: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, text: str | None) -> float:
        if not len(self.slots):
            return 0.0
        found = features(text)
        at = np.minimum(np.searchsorted(self.slots, found), len(self.slots) - 1)
        return float(self.weights[at[self.slots[at] == found]].sum())

    def tails(self, score: float) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ..."""
        return 1 / (1 + np.exp(-np.clip(score - self.thresholds, -60, 60)))


@dataclass
class _Sample:
    """Rows as pairs of (row, place of one of its slots), with the rows' grades and weights."""

    row: np.ndarray
    at: np.ndarray
    grades: np.ndarray
    weights: np.ndarray

    def part(self, rows: np.ndarray, slots: np.ndarray) -> _Sample:
        """Those rows and slots, both given as masks; slots keep their places."""
        ok = rows[self.row] & slots[self.at]
        return _Sample((np.cumsum(rows) - 1)[self.row[ok]], self.at[ok], self.grades[rows], self.weights[rows])


def _probabilities(s: _Sample, w: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(grade >= 0), ..., P(grade >= GRADES) of each row, and the probability of its own grade."""
    n = len(s.grades)
    score = np.bincount(s.row, w[s.at], n)
    tails = np.ones((n, GRADES + 1))
    tails[:, GRADES] = 0
    tails[:, 1:GRADES] = 1 / (1 + np.exp(-np.clip(score[:, None] - c, -60, 60)))
    rows = np.arange(n)
    return tails, np.maximum(tails[rows, s.grades] - tails[rows, s.grades + 1], 1e-9)


def fit(s: _Sample, n_slots: int, strength: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by gradient steps of adapted size on the penalised likelihood of cumulative logits, over all rows each.

    P(grade = j) = tail_j - tail_(j+1). Its log's derivative with respect to the score is 1 - tail_j - tail_(j+1), and the thresholds are
    kept in order by sorting, which is a projection.
    """
    share = s.weights / s.weights.sum()
    rows, n = np.arange(len(s.grades)), len(s.grades)
    x = np.concatenate((np.zeros(n_slots), np.linspace(-2.0, 0.0, GRADES - 1)))
    mean, square = np.zeros(len(x)), np.zeros(len(x))
    for t in range(1, STEPS + 1):
        tails, own = _probabilities(s, x[:n_slots], x[n_slots:])
        slope = (tails[rows, s.grades] + tails[rows, s.grades + 1] - 1) * share
        grad = np.empty(len(x))
        grad[:n_slots] = np.bincount(s.at, slope[s.row], n_slots) + strength / n * x[:n_slots]
        for j in range(1, GRADES):
            d = tails[:, j] * (1 - tails[:, j]) / own * share
            grad[n_slots + j - 1] = d[s.grades == j].sum() - d[s.grades == j - 1].sum()
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad * grad
        rate = 0.1 * min(1.0, 2 * (1 - t / (STEPS + 1)))
        x -= rate * mean / (1 - 0.9**t) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
        x[n_slots:].sort()
    return x[:n_slots], x[n_slots:]


def _departure(counts: list[Column], totals: list[int]) -> Column:
    """Twice the log-likelihood ratio of a slot's presence against independence of the grade."""
    n, seen = sum(totals), sum(counts, F.lit(0))
    terms = F.lit(0.0)
    for c, t in zip(counts, totals, strict=True):
        for o, e in ((c, seen * t / n), (F.lit(t) - c, (F.lit(n) - seen) * t / n)):
            terms = terms + F.when(o > 0, o * F.log(o / F.when(o > 0, e))).otherwise(0.0)
    return 2 * terms


def _chosen_slots(rows: DataFrame, totals: np.ndarray) -> pd.DataFrame:
    """(slot, all, half0, half1): the slots with a weight, and whether they are chosen on all rows, on half 0 and on half 1."""
    seen = rows.select("grade", "half", F.explode("slots").alias("slot"))
    one = lambda g, h: F.count_if((F.col("grade") == g) & (F.col("half") == h)).alias(f"n{g}{h}")
    counts = seen.groupBy("slot").agg(*(one(g, h) for g in range(GRADES) for h in range(2)))
    n_slots = counts.count()
    limit = 2 * float(np.log(max(n_slots, 2))) + 4

    def of(halves: tuple[int, ...]) -> Column:
        return _departure([sum((F.col(f"n{g}{h}") for h in halves), F.lit(0)) for g in range(GRADES)], [int(totals[g, list(halves)].sum()) for g in range(GRADES)])

    sizes = {"all": (0, 1), "half0": (0,), "half1": (1,)}
    scored_slots = counts.select("slot", *((of(h) if totals[:, list(h)].sum() else F.lit(0.0)).alias(name) for name, h in sizes.items()))
    best = F.greatest(*sizes)
    kept = scored_slots.where(best > limit)
    return kept.select("slot", *((F.col(name) > limit).alias(name) for name in sizes)).toPandas().sort_values("slot")


def _picked(slots: np.ndarray) -> Column:
    """The places in the sorted slots of those that a row has, as int32 bytes."""

    @F.pandas_udf("binary")
    def places(found: pd.Series) -> pd.Series:
        def one(f: np.ndarray) -> bytes:
            f = np.asarray(f, np.int32)
            at = np.minimum(np.searchsorted(slots, f), len(slots) - 1)
            return at[slots[at] == f].astype(np.int32).tobytes()

        return found.map(one)

    return places("slots")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality", toxic_col: str = "toxic") -> OrdinalModel | None:
    """The model fitted on a bounded sample of the labelled rows; None if there are fewer than two grades."""
    grade = F.when(F.col(toxic_col) > 0, 0).when(F.col(quality_col) <= 0, 1).when(F.col(quality_col) > 0, 2)
    graded = labels.select(F.col(id_col).alias("_id"), grade.alias("grade")).where("grade is not null and _id is not null").groupBy("_id").agg(F.min("grade").alias("grade"))
    parts = [graded.where(F.col("grade") == g).orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE_ROWS) for g in range(GRADES)]
    sample = parts[0].unionByName(parts[1]).unionByName(parts[2])
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    met = docs.select(F.col(id_col).alias("_id"), text.alias("text")).join(F.broadcast(sample), "_id")  # SAMPLE_ROWS bounds it
    texts = met.groupBy("_id", "grade").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"half": f["half"], "grade": f["grade"], "slots": [features(t) for t in f["text"]]})

    halves = texts.select(F.pmod(F.xxhash64("_id", F.lit(7)), F.lit(2)).cast("int").alias("half"), "grade", "text")
    rows = materialize(halves.mapInPandas(hashed, "half int, grade int, slots array<int>"), "graded-slots")
    totals = np.zeros((GRADES, 2), np.int64)
    for r in rows.groupBy("grade", "half").count().collect():
        totals[r["grade"], r["half"]] = r["count"]
    if (totals.sum(axis=1) > 0).sum() < 2:
        return None
    chosen = _chosen_slots(rows, totals)
    slots = chosen["slot"].to_numpy(np.int32)
    if not len(slots):
        vectors = rows.select("half", "grade", F.lit(b"").alias("at")).toPandas()
    else:
        vectors = rows.select("half", "grade", _picked(slots).alias("at")).toPandas()
    vectors = vectors.sort_values(["grade", "half", "at"], ignore_index=True)
    at = [np.frombuffer(a, np.int32).astype(np.int64) for a in vectors["at"]]
    numbers = dict(graded.groupBy("grade").count().collect())
    grades, halves_of = vectors["grade"].to_numpy(np.int64), vectors["half"].to_numpy()
    weight = np.array([numbers.get(g, 0) / max(totals[g].sum(), 1) for g in range(GRADES)])[grades]
    whole = _Sample(np.repeat(np.arange(len(at)), [len(a) for a in at]), np.concatenate(at), grades, weight / weight.mean())

    def held_out(strength: float) -> float:
        loss = 0.0
        for h in range(2):
            own, other = halves_of == h, halves_of != h
            mask = chosen[f"half{h}"].to_numpy(bool)
            held = whole.part(other, mask)
            loss -= float(held.weights @ np.log(_probabilities(held, *fit(whole.part(own, mask), len(slots), strength))[1]))
        return loss

    both = all((totals[:, h] > 0).sum() > 1 for h in range(2))
    strength = min(STRENGTHS, key=held_out) if both else STRENGTHS[-1]
    mask = chosen["all"].to_numpy(bool)
    w, c = fit(whole.part(np.ones(len(grades), bool), mask), len(slots), strength)
    return OrdinalModel(slots[mask], w[mask], c)


def _tails(docs: DataFrame, model: OrdinalModel, text_col: str) -> Column:
    """struct<p_low, p_good> of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("p_low double, p_good double")
    def tails(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        return pd.DataFrame([m.tails(m.score(t)) for t in texts], columns=["p_low", "p_good"])

    return tails(F.col(text_col).cast("string"))


def scored(docs: DataFrame, model: OrdinalModel | None, text_col: str = "text") -> DataFrame:
    """docs' columns and _expected_grade, _p_low (P(grade >= 1)), _p_good (P(grade >= 2)), which replace columns of these names."""
    if model is None:
        return docs.withColumns({"_expected_grade": F.lit(2.0), "_p_low": F.lit(1.0), "_p_good": F.lit(1.0)})
    p = fresh(docs, "_tf_p")
    rated = docs.withColumn(p, _tails(docs, model, text_col))
    return rated.withColumns({"_expected_grade": F.col(p).p_low + F.col(p).p_good, "_p_low": F.col(p).p_low, "_p_good": F.col(p).p_good}).drop(p)


def select_quality(docs: DataFrame, labels: DataFrame, keep: float = KEEP, **columns) -> DataFrame:
    """The rows of docs that the classifier keeps, with docs' columns."""
    model = train(docs, labels, **columns)
    if model is None:
        return docs
    p = fresh(docs, "_tf_p")
    rated = docs.withColumn(p, _tails(docs, model, columns.get("text_col", "text")))
    return rated.where(F.col(p).p_good >= keep).drop(p)
