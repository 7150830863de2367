"""Pool-based active learning and the baseline classifier on pyspark.ml."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, NGram, Normalizer, RegexTokenizer, SQLTransformer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as T

#: Slices of the hash range; only slices that hold a cut are put in order.
SLICES = 4096


def hash_parts(df: DataFrame, cuts: dict[str, int], rest: str, row: str = "row_id", seed: int = 12) -> DataFrame:
    """part: rows in the order of a seeded hash, so many for each name in ``cuts``, the others ``rest``; sizes are exact."""
    h = F.xxhash64(F.lit(seed), F.col(row))
    d = df.withColumns({"__h": h, "__s": F.pmod(h, F.lit(SLICES)).cast("int")})
    counts = {r["__s"]: r["n"] for r in d.groupBy("__s").agg(F.count(F.lit(1)).alias("n")).collect()}
    ends, total = [], 0
    for name, n in cuts.items():
        total += n
        ends.append((name, total))
    part, mixed, before = F.lit(rest), {}, 0
    whole: dict[str, list[int]] = {}
    for s in sorted(counts):
        inside = [(name, end) for name, end in ends if end > before]
        first = inside[0] if inside else None
        if first and first[1] < before + counts[s]:
            mixed[s] = before
        elif first:
            whole.setdefault(first[0], []).append(s)
        before += counts[s]
    for name, slices in whole.items():
        part = F.when(F.col("__s").isin(slices), name).otherwise(part)
    plain = d.where(~F.col("__s").isin(list(mixed))) if mixed else d
    out = plain.withColumn("part", part)
    if mixed:
        start = F.lit(0)
        for s, b in mixed.items():
            start = F.when(F.col("__s") == s, b).otherwise(start)
        at = F.row_number().over(Window.partitionBy("__s").orderBy("__h", row)) + start
        named = F.lit(rest)
        for name, end in reversed(ends):
            named = F.when(F.col("__at") <= end, name).otherwise(named)
        cut = d.where(F.col("__s").isin(list(mixed))).withColumn("__at", at).withColumn("part", named).drop("__at")
        out = out.unionByName(cut)
    return out.drop("__h", "__s")


def split_sizes(n: int, test: float = 0.2, least_test: int = 1, seed_size: int = 50) -> tuple[int, int]:
    """Rows of the test and the seed part of n labelled rows; the pool keeps one at least. Fewer than six are too few."""
    if n < 6:
        raise ValueError(f"active learning needs at least 6 labelled rows, not {n}")
    tested = min(max(least_test, round(n * test)), n - 3)
    seeded = max(2, min(seed_size, n - tested - 1))
    if seeded + tested >= n:
        seeded = max(2, n - tested - 2)
    return tested, seeded if tested + seeded < n else seeded - 1


def bucket_split(df: DataFrame, test: float = 0.2, seed_size: int = 50, row: str = "row_id", seed: int = 12, label: str | None = None, least_test: int = 1) -> DataFrame:
    """part: test, seed or pool of each row, in the order of a seeded hash; with ``label``, a seed part of one label is an error."""
    tested, seeded = split_sizes(df.count(), test, least_test, seed_size)
    out = hash_parts(df, {"test": tested, "seed": seeded}, "pool", row, seed)
    if label and out.where("part = 'seed'").select(label).where(F.col(label).isNotNull()).distinct().limit(2).count() < 2:
        raise ValueError("the seed part needs two labels at least; change the seed or its size")
    return out


def stratified_split(df: DataFrame, label: str, test: float = 0.2, row: str = "row_id", seed: int = 42) -> DataFrame:
    """part: test or train within each label by a seeded hash."""
    u = F.pmod(F.xxhash64(F.lit(seed), F.col(label), F.col(row)), F.lit(1 << 30)) / float(1 << 30)
    return df.withColumn("part", F.when(u < test, "test").otherwise("train"))


def pipeline(text: str = "text", features: int = 20_000, min_df: int = 2, iterations: int = 100, c: float = 1.0, rows: int = 1) -> Pipeline:
    """Words and word pairs in one vocabulary, IDF, unit length, logistic regression with weights.

    The penalty is on the features as they are: unit vectors need no scaling, and the solver ends in tens of steps.
    """
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="__w", pattern=r"\b\w\w+\b", gaps=False),
            NGram(n=2, inputCol="__w", outputCol="__w2"),
            SQLTransformer(statement="SELECT *, concat(__w, __w2) AS __g FROM __THIS__"),
            CountVectorizer(inputCol="__g", outputCol="__c", vocabSize=features, minDF=min_df),
            IDF(inputCol="__c", outputCol="__t"),
            Normalizer(inputCol="__t", outputCol="__f"),
            LogisticRegression(featuresCol="__f", labelCol="__y", weightCol="__weight", maxIter=iterations, regParam=1.0 / (c * max(rows, 1)), standardization=False, probabilityCol="__p"),
        ]
    )


def balanced(df: DataFrame, label: str = "label") -> DataFrame:
    """__weight: rows over (classes x rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n").alias("__all"), F.count(F.lit(1)).alias("__k"))
    w = counts.join(F.broadcast(total), F.lit(True)).select(label, (F.col("__all") / (F.col("__k") * F.col("__n"))).alias("__weight"))
    return df.join(w, label)


class Classifier:
    """Text classifier; with a single class it predicts that class."""

    def __init__(self, text: str = "text", label: str = "label", **options) -> None:
        self.text, self.label, self.options = text, label, options
        self.model: PipelineModel | None = None
        self.labels: list[str] = []

    def fit(self, df: DataFrame) -> Classifier:
        rows = df.where(F.col(self.label).isNotNull() & F.col(self.text).isNotNull())
        self.labels = [r[0] for r in rows.select(self.label).distinct().orderBy(self.label).limit(1000).collect()]
        if len(self.labels) < 2:
            return self
        index = StringIndexer(inputCol=self.label, outputCol="__y", stringOrderType="alphabetAsc").fit(rows)
        data = balanced(index.transform(rows), self.label).cache()
        self.labels = list(index.labels)
        self.model = pipeline(self.text, rows=data.count(), **self.options).fit(data)
        data.unpersist()
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        """model_pred and proba (in the order of ``labels``) for rows with a text."""
        rows = df.where(F.col(self.text).isNotNull())
        if self.model is None:
            return rows.withColumns({"model_pred": F.lit(self.labels[0] if self.labels else None).cast("string"), "proba": F.array(F.lit(1.0))})
        names = F.array(*[F.lit(x) for x in self.labels])
        out = self.model.transform(rows).withColumns({"proba": vector_to_array("__p"), "model_pred": names[F.col("prediction").cast("int")]})
        return out.select(*rows.columns, "proba", "model_pred")


def entropy(p: Column) -> Column:
    return -F.aggregate(p, F.lit(0.0), lambda a, x: a + x * F.log(x + 1e-12))


def margin(p: Column) -> Column:
    s = F.sort_array(p, asc=False)
    return s[0] - F.coalesce(F.try_element_at(s, F.lit(2)), F.lit(0.0))


def query(predicted: DataFrame, strategy: str = "entropy", k: int = 20, row: str = "row_id", seed: int = 12) -> DataFrame:
    """The k rows to label next: highest entropy, smallest margin, or a seeded random choice."""
    score = {"entropy": entropy(F.col("proba")), "margin": margin(F.col("proba")), "random": F.pmod(F.xxhash64(F.lit(seed), F.col(row)), F.lit(1 << 30)) / float(1 << 30)}[strategy]
    out = predicted.withColumns({"selection_score": score, "strategy": F.lit(strategy), "model_confidence": F.array_max("proba")})
    return out.orderBy(F.asc("selection_score") if strategy == "margin" else F.desc("selection_score"), row).limit(k)


def metrics(pairs: DataFrame) -> DataFrame:
    """(accuracy, macro_precision, macro_recall, macro_f1, n) from (label, pred); classes without predictions count as 0."""
    cells = pairs.groupBy("label", "pred").agg(F.count(F.lit(1)).alias("n"))
    by_label = cells.groupBy(F.col("label").alias("c")).agg(F.sum("n").alias("actual"), F.sum(F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0)).alias("hit"))
    by_pred = cells.groupBy(F.col("pred").alias("c")).agg(F.sum("n").alias("predicted"))
    j = by_label.join(by_pred, "c", "full_outer").fillna(0, ["actual", "hit", "predicted"])
    p = F.coalesce(F.try_divide("hit", "predicted"), F.lit(0.0))
    r = F.coalesce(F.try_divide("hit", "actual"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    return j.agg(F.round(F.try_divide(F.sum("hit"), F.sum("actual")), 6).alias("accuracy"), F.round(F.avg(p), 6).alias("macro_precision"), F.round(F.avg(r), 6).alias("macro_recall"), F.round(F.avg(f1), 6).alias("macro_f1"), F.sum("actual").alias("n"))


def class_report(pairs: DataFrame) -> DataFrame:
    """(label, precision, recall, f1, support) of each class that occurs as label or prediction."""
    cells = pairs.groupBy("label", "pred").agg(F.count(F.lit(1)).alias("n"))
    right = F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0)
    by_label = cells.groupBy("label").agg(F.sum("n").alias("support"), F.sum(right).alias("hit"))
    by_pred = cells.groupBy(F.col("pred").alias("label")).agg(F.sum("n").alias("predicted"))
    j = by_label.join(by_pred, "label", "full_outer").fillna(0, ["support", "hit", "predicted"])
    p, r = F.coalesce(F.try_divide("hit", "predicted"), F.lit(0.0)), F.coalesce(F.try_divide("hit", "support"), F.lit(0.0))
    return j.select("label", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)), 6).alias("f1"), "support")


def f1_kind(df: DataFrame, label: str = "label", order: str = "row_id") -> tuple[str, object | None]:
    """('binary', positive label) for two labels, the positive one being that which appears last by ``order``; else ('macro', None)."""
    first = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.min(order).alias("at")).orderBy("at").limit(3).collect()
    return ("binary", first[1][label]) if len(first) == 2 else ("macro", None)


def evaluate(pairs: DataFrame, order: str = "row_id") -> DataFrame:
    """(accuracy, f1, f1_kind, n): F1 of the positive class for two labels, else the mean over classes."""
    kind, positive = f1_kind(pairs, "label", order)
    report = class_report(pairs)
    f1 = report.where(F.col("label") == F.lit(positive)) if kind == "binary" else report
    score = f1.agg(F.round(F.avg("f1"), 6).alias("f1"))
    base = pairs.agg(F.round(F.avg((F.col("label") == F.col("pred")).cast("double")), 6).alias("accuracy"), F.count(F.lit(1)).alias("n"))
    return base.join(F.broadcast(score), F.lit(True)).select("accuracy", "f1", F.lit(kind).alias("f1_kind"), "n")


#: Strategies of a query.
STRATEGIES = ("entropy", "margin", "random")


def strategy_name(value: str) -> str:
    name = str(value).strip().lower()
    if name not in STRATEGIES:
        raise ValueError(f"unknown strategy {value!r}; known: {', '.join(STRATEGIES)}")
    return name


def settings(config: dict | None) -> dict:
    """Settings of the active-learning stage, with defaults and names checked."""
    c = (config or {}).get("active_learning") or {}
    return {
        "enabled": bool(c.get("enabled", True)), "strategy": strategy_name(c.get("strategy", "entropy")), "iterations": int(c.get("n_iterations", 2)), "batch": int(c.get("batch_size", 20)),
        "seed_size": int(c.get("initial_seed_size", 50)), "test": float(c.get("test_holdout_fraction", 0.2)), "least_test": int(c.get("test_holdout_min", 1)), "seed": int(c.get("random_state", 12)),
        "simulation": bool(c.get("simulation_mode", True)),
    }


def oracle_column(columns: list[str], label: str = "label") -> str | None:
    """The column that stands in for a reviewer in a simulation."""
    return next((c for c in ("true_label", label) if c in columns), None)


def ingest(reviewed: DataFrame, row: str = "row_id", human: str = "human_label") -> DataFrame:
    """(row, label) of reviewed rows with a label; a review repeated for a row is an error."""
    rows = reviewed.where(~T.missing(human)).select(row, T.strip(human).alias("label"))
    if not rows.groupBy(row).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        raise ValueError(f"reviewed rows repeat a {row}")
    return rows


def oracle_labels(selected: DataFrame, pool: DataFrame, column: str, row: str = "row_id") -> DataFrame:
    """Selected rows with the pool's label as human_label; rows without one are an error."""
    known = pool.select(row, F.col(column).alias("human_label")).distinct()
    out = selected.drop("human_label").join(known, row, "left")
    if not out.where("human_label is null").isEmpty():
        raise ValueError(f"{column} is null for selected rows")
    return out


def compare_strategies(labeled: DataFrame, pool: DataFrame, test: DataFrame, strategies: tuple[str, ...] = STRATEGIES, **options) -> dict[str, list[dict]]:
    """A history of rounds for each strategy, all from the same start."""
    return {s: run_cycle(labeled, pool, test, strategy_name(s), **options) for s in strategies}


def learning_curve(spark, histories: dict[str, list[dict]]) -> DataFrame:
    """(strategy, iteration, n_labeled, accuracy, f1): the plot's data."""
    rows = [(s, h["iteration"], h["n_labeled"], h["accuracy"], h["f1"]) for s, hs in histories.items() for h in hs]
    return spark.createDataFrame(rows, "strategy string, iteration int, n_labeled bigint, accuracy double, f1 double")


class Review:
    """A loop with reviewers: each step fits on what is labelled, records its metrics, and gives the next queue.

    The labels so far, the history and the open queue are tables in ``folder``, so a step can resume on another cluster.
    """

    def __init__(self, folder: str, strategy: str = "entropy", k: int = 20, row: str = "row_id", **options) -> None:
        self.folder, self.strategy, self.k, self.row, self.options = folder, strategy_name(strategy), k, row, options

    def step(self, labeled: DataFrame, pool: DataFrame, test: DataFrame, round_: int) -> DataFrame:
        """The queue of a round: rows of the pool with an empty human_label; metrics go to the history."""
        from textloom.sources import sinks

        model = Classifier(**self.options).fit(labeled)
        m = metrics(model.predict(test).select("label", F.col("model_pred").alias("pred"))).first()
        sinks.write_json({"iteration": round_, "strategy": self.strategy, "n_labeled": labeled.count(), "accuracy": m["accuracy"], "f1": m["macro_f1"]}, f"{self.folder}/history/{round_:04d}.json")
        queue = query(model.predict(pool), self.strategy, self.k, self.row).drop("proba", "label")
        path = sinks.review_queue_file(queue, round_, f"{self.folder}/queue_{round_:04d}.parquet")
        return labeled.sparkSession.read.parquet(path)

    def advance(self, labeled: DataFrame, pool: DataFrame, reviewed: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Labelled rows and pool after a review: reviewed rows change sides."""
        new = ingest(reviewed, self.row)
        added = pool.drop("label").join(new, self.row)
        return labeled.unionByName(added.select(*labeled.columns)), pool.join(new.select(self.row), self.row, "left_anti")

    def history(self, spark) -> DataFrame:
        return spark.read.json(f"{self.folder}/history/*.json", multiLine=True).orderBy("iteration")


def latest_queue(paths: list[str]) -> str | None:
    """The queue file of the last round."""
    return max((p for p in paths if "queue_" in p), default=None)


def run_cycle(labeled: DataFrame, pool: DataFrame, test: DataFrame, strategy: str = "entropy", rounds: int = 2, k: int = 20, row: str = "row_id", **options) -> list[dict]:
    """Simulated loop: fit, evaluate, query, take the pool's labels, repeat. One entry of metrics per round."""
    from textloom.plans.staging import stage

    history = []
    for i in range(rounds + 1):
        model = Classifier(**options).fit(labeled)
        m = metrics(model.predict(test).select("label", F.col("model_pred").alias("pred"))).first()
        history.append({"iteration": i, "strategy": strategy, "n_labeled": labeled.count(), "accuracy": m["accuracy"], "f1": m["macro_f1"]})
        if i == rounds:
            break
        picked = stage(query(model.predict(pool), strategy, k, row).select(row), "picked")
        new = pool.join(picked, row, "left_semi")
        labeled = stage(labeled.unionByName(new), "labeled")
        pool = pool.join(picked, row, "left_anti")
    return history


def sample_efficiency(histories: dict[str, list[dict]], better: str = "entropy", base: str = "random", metric: str = "f1") -> dict:
    """Labels that one strategy saves to reach the other's final metric."""
    target = histories[base][-1][metric]
    reached = next((h["n_labeled"] for h in histories[better] if h[metric] >= target), None)
    return {"target": target, "needed": reached, "saved": None if reached is None else histories[base][-1]["n_labeled"] - reached}


def overlay_labels(base: DataFrame, accumulated: DataFrame, row: str = "row_id", order: str | None = None) -> DataFrame:
    """final_label taken from a row's first accumulated label, in the order of ``order``, where there is one; null labels don't count."""
    first = accumulated.where(F.col("label").isNotNull()).groupBy(row).agg(F.min_by("label", order or "label").alias("__new"))
    return base.join(first, row, "left").withColumn("final_label", F.coalesce("__new", "final_label")).drop("__new")


def ranked(df: DataFrame, by: str, order: list) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
