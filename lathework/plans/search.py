"""Search for models: random draws, and generations of mutated and crossed candidates.

The driver holds candidate specs and scores only. Every candidate is cross-validated on one
cached table, a few candidates at a time; results go to a log, from which a run resumes
without fitting anything twice.
"""

from __future__ import annotations

import json
import threading
import warnings
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lathework.functions.columns import c
from lathework.functions.metrics import METRICS
from lathework.operators.resample import fold_column
from lathework.operators.trees import in_parallel
from lathework.plans.space import build, cand_id, complexity, draw_spec, draw_step, param_space, reject, spec_text
from lathework.sources.searchlog import SearchLog
from lathework.session import settle


@dataclass
class Result:
    spec: dict
    score: float
    std: float
    status: str

    @property
    def sort_key(self):
        worst = self.score is None or self.score != self.score
        return (float("inf") if worst else self.score, complexity(self.spec), cand_id(self.spec))


@dataclass
class Search:
    """Scores candidates on a table of ``features``, ``label`` and ``key``; smaller is better."""

    data: DataFrame
    key: str = "id"
    label: str = "label"
    folds: int = 5
    repeats: int = 1
    metric: str = "rmsle"
    max_eval_mins: float = 5.0
    parallelism: int = 2
    log: SearchLog | None = None
    space: dict = field(default_factory=param_space)
    results: dict = field(default_factory=dict)
    fits: int = 0

    def __post_init__(self):
        if METRICS[self.metric][1]:
            raise ValueError("the search minimises: choose an error measure")
        self._spark = self.data.sparkSession
        self._lock = threading.Lock()
        if self.log is not None:
            for r in self.log.table().collect():
                self.results[r["cand_id"]] = Result(json.loads(r["spec"]), r["score"], r["std"], r["status"])

    def __enter__(self):
        self.data = self.data.persist(StorageLevel.MEMORY_AND_DISK)
        return self

    def __exit__(self, *_):
        self.data.unpersist()

    def evaluate(self, spec: dict) -> Result:
        """Mean and deviation over folds; +inf for a candidate that fails or runs too long."""
        sc = self._spark.sparkContext
        tag = f"candidate-{cand_id(spec)}"
        late = threading.Event()

        def stop():
            late.set()
            sc.cancelJobsWithTag(tag)

        timer = threading.Timer(self.max_eval_mins * 60, stop)
        sc.addJobTag(tag)
        timer.start()
        try:
            scores = []
            for r in range(self.repeats):
                fold = fold_column(c(self.key), self.folds, r)
                for k in range(self.folds):
                    if late.is_set():
                        raise TimeoutError
                    scores.append(self._fold_score(spec, fold, k))
            return Result(spec, float(np.mean(scores)), float(np.std(scores)), "ok")
        except Exception as error:  # a broken candidate must not end the search
            status = "timeout" if late.is_set() else f"failed: {type(error).__name__}"
            return Result(spec, float("inf"), 0.0, status)
        finally:
            timer.cancel()
            sc.removeJobTag(tag)

    def _fold_score(self, spec, fold, k) -> float:
        fitted = build(spec, label=self.label, key=self.key).fit(self.data.filter(fold != k))
        with self._lock:
            self.fits += 1
        scored = fitted.transform(self.data.filter(fold == k))
        aggregate = METRICS[self.metric][0]
        value = scored.agg(aggregate(F.col(self.label), F.col("prediction")).alias("s")).first()["s"]
        return float("inf") if value is None else value

    def score_all(self, specs, generation=0) -> list[Result]:
        """Score what has no result yet, write it to the log, return all."""
        todo = {}
        for s in specs:
            if cand_id(s) not in self.results:
                todo.setdefault(cand_id(s), s)
        found = in_parallel(self._spark, self.evaluate, todo.values(), self.parallelism)
        for r in found:
            self.results[cand_id(r.spec)] = r
        if self.log is not None:
            self.log.append([
                (generation, cand_id(r.spec), spec_text(r.spec), complexity(r.spec), r.score, r.std, r.status)
                for r in found
            ])
        return [self.results[cand_id(s)] for s in specs]

    def table(self) -> DataFrame:
        """All results, best first."""
        rows = [
            (cand_id(r.spec), spec_text(r.spec), complexity(r.spec), r.score, r.std, r.status)
            for r in self.results.values()
        ]
        schema = "cand_id string, spec string, complexity int, score double, std double, status string"
        return self._spark.createDataFrame(rows, schema).orderBy("score", "complexity", "cand_id")

    def best(self) -> Result:
        return min(self.results.values(), key=lambda r: r.sort_key)

    def fit_front(self) -> dict:
        """The non-dominated candidates, each fitted on the whole table."""
        out = {}
        for r in front(self.results.values()):
            out[cand_id(r.spec)] = build(r.spec, label=self.label, key=self.key).fit(self.data)
        return out


def front(results) -> list[Result]:
    """Results that no simpler or equally simple one beats."""
    out, best = [], float("inf")
    ok = [r for r in results if r.status == "ok"]
    for level in sorted({complexity(r.spec) for r in ok}):
        here = [r for r in ok if complexity(r.spec) == level]
        top = min(r.score for r in here)
        if top < best:
            out += sorted((r for r in here if r.score == top), key=lambda r: r.sort_key)
            best = top
    return out


def random_search(search: Search, draws: int, seed=7, max_pre=2) -> DataFrame:
    """Different candidates drawn uniformly from the space."""
    rng = np.random.default_rng(seed)
    search.score_all(distinct_specs(search.space, draws, rng, max_pre))
    return search.table()


def distinct_specs(space: dict, count: int, rng, max_pre=2) -> list[dict]:
    out: dict = {}
    for _ in range(count * 50):
        if len(out) == count:
            break
        spec = draw_spec(space, rng, max_pre)
        out.setdefault(cand_id(spec), spec)
    short_of(count, len(out))
    return list(out.values())


def short_of(wanted: int, found: int) -> None:
    """Say so when a space gives fewer different candidates than asked for."""
    if found < wanted:
        warnings.warn(f"only {found} of {wanted} different candidates were found", stacklevel=3)


def population_search(search: Search, population=300, offspring=400, generations=100, seed=7, max_pre=2) -> DataFrame:
    """Generations: the population and its offspring compete for the next population.

    Non-dominated candidates survive first, then the best scores. A resumed run draws the
    same candidates again and takes their scores from the log.
    """
    rng = np.random.default_rng(seed)
    alive = search.score_all(distinct_specs(search.space, population, rng, max_pre))
    for g in range(1, generations + 1):
        children = breed([r.spec for r in alive], search.space, offspring, rng, max_pre)
        pool = {cand_id(r.spec): r for r in alive + search.score_all(children, g)}
        first = front(pool.values())
        chosen = {cand_id(r.spec) for r in first}
        rest = sorted((r for i, r in pool.items() if i not in chosen), key=lambda r: r.sort_key)
        alive = (first + rest)[:population]
    return search.table()


def breed(parents, space, count: int, rng, max_pre=2) -> list[dict]:
    """Offspring that differ from each other and from their parents."""
    seen = {cand_id(p) for p in parents}
    out = []
    for _ in range(count * 50):
        if len(out) == count:
            break
        # The better of two random parents; the list is sorted best first.
        at = [min(int(rng.integers(len(parents))), int(rng.integers(len(parents)))) for _ in range(2)]
        child = cross(parents[at[0]], parents[at[1]], rng) if rng.random() < 0.1 else mutate(parents[at[0]], space, rng, max_pre)
        if cand_id(child) not in seen:
            seen.add(cand_id(child))
            out.append(child)
    short_of(count, len(out))
    return out


def cross(a: dict, b: dict, rng) -> dict:
    """Steps of one parent in front of the estimator of the other."""
    return {"pre": list(a["pre"]), "est": b["est"]} if rng.random() < 0.5 else {"pre": list(b["pre"]), "est": a["est"]}


def mutate(spec: dict, space: dict, rng, max_pre=2) -> dict:
    """One change: a param, a step more, a step less, or another step."""
    pre, est = [list(s) for s in spec["pre"]], list(spec["est"])
    kind = rng.random()
    if kind < 0.4:
        at = int(rng.integers(len(pre) + 1))
        name, params = est if at == len(pre) else pre[at]
        options = {**space["preprocessors"], **space["estimators"]}[name]
        open_params = sorted(k for k, v in options.items() if len(v) > 1)
        if open_params:
            k = open_params[int(rng.integers(len(open_params)))]
            new = {**params, k: options[k][int(rng.integers(len(options[k])))]}
            if reject(name, new) is None:
                if at == len(pre):
                    est = [name, new]
                else:
                    pre[at] = [name, new]
    elif kind < 0.6 and len(pre) < max_pre:
        pre.insert(int(rng.integers(len(pre) + 1)), draw_step(space["preprocessors"], rng))
    elif kind < 0.8 and pre:
        pre.pop(int(rng.integers(len(pre))))
    else:
        est = draw_step(space["estimators"], rng)
    return {"pre": pre, "est": est}


def pareto_front(df: DataFrame, low: str, high: str, slices: int | None = None) -> DataFrame:
    """Rows that no other row beats: ``low`` as small and ``high`` as large as possible.

    A row stays if it holds the best ``high`` of its ``low`` level and every smaller level is
    worse; a row with a null in either column never stays. Levels are dealt into ranges of about
    equally many (``slices``, or as many as the session shuffles into). A prefix maximum over one
    row for each range takes out all levels that an earlier range beats, and only those left
    meet in a running maximum within their range.
    """
    levels = df.select(c(low).alias("_low"), c(high).alias("_high")).dropna().groupBy("_low").agg(F.max("_high").alias("_high"))
    dealt = levels.repartitionByRange(*([slices] if slices else []), F.col("_low"))
    placed = settle(dealt.withColumn("_slice", F.spark_partition_id()), "levels")
    before = W.rowsBetween(W.unboundedPreceding, -1)
    tops = placed.groupBy("_slice").agg(F.max("_high").alias("_top"))
    tops = tops.select("_slice", F.max("_top").over(before.orderBy("_slice")).alias("_earlier"))
    able = placed.join(tops, "_slice").filter(F.col("_earlier").isNull() | (F.col("_high") > F.col("_earlier")))
    inside = F.max("_high").over(before.partitionBy("_slice").orderBy("_low"))
    kept = able.withColumn("_limit", inside).filter(F.col("_limit").isNull() | (F.col("_high") > F.col("_limit")))
    match = (c(low) == F.col("_low")) & (c(high) == F.col("_high"))
    return df.join(kept.select("_low", "_high"), match, "left_semi")
