"""Reading level of documents by gradient-boosted regression trees.

Features are distributions over a text's words, sentences and windows: length (word length, vowel groups, sentence
length), vocabulary (corpus frequency of the words, variety, and the mean grade of the labelled texts that use them),
syntax (marks, short words, sentence ends) and cohesion (words that neighbouring windows share). None needs to know the
language, and the vocabulary ones don't need reliable punctuation, line breaks or case.

Word counts cover all documents; they are kept in a table of 2^17 hash buckets, whose size doesn't grow. The trees are
trained here on the labelled documents, at most TRAIN of them chosen by a hash of doc_id, each with the mean of its
raters' bands. Folds hold whole sources; predictions for the sources left out calibrate the thresholds between bands
and measure the model. Grades of words, which come from labels, are taken out of fold for training.

Null and blank texts get no band from ``found`` and a null band from ``grades``; texts may be of any length and are read
whole; repeated documents get the same band; without any label all get the middle band.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.normal import normal, words
from textloom.plans.staging import spread

#: Most labelled documents used; hash buckets of words; least words of a graded document.
TRAIN, BUCKETS, MIN_WORDS = 20_000, 1 << 17, 30
#: Folds of sources, and the trees' shape.
FOLDS, TREES, DEPTH, RATE, LEAF, BINS = 5, 120, 3, 0.08, 10, 32
#: Words of a cohesion window, and weight of the mean grade in a word's grade.
WINDOW, PRIOR = 25, 3.0
_VOWELS = re.compile(r"[aeiouyäöüáàâéèêíîóôúùûœæаеёиоуыэюя]+")
_ENDS = re.compile(r"[.!?…]+(?:\s|$)|\n\s*\n|\n")


class Lexicon:
    """Per-word numbers through a memo: length, vowel groups, hash bucket."""

    def __init__(self) -> None:
        self._clear()

    def _clear(self) -> None:
        self.memo: dict[str, int] = {}
        self.rows = np.zeros((4096, 3), np.int64)

    def __call__(self, ws: list[str]) -> np.ndarray:
        if len(self.memo) > 200_000:
            self._clear()
        memo = self.memo
        try:
            return self.rows[np.fromiter(map(memo.__getitem__, ws), np.int64, len(ws))]
        except KeyError:
            for w in ws:
                if w not in memo:
                    k = len(memo)
                    if k == len(self.rows):
                        self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                    self.rows[k] = len(w), len(_VOWELS.findall(w)), xxhash.xxh3_64_intdigest(w) % BUCKETS
                    memo[w] = k
            return self.rows[np.fromiter(map(memo.__getitem__, ws), np.int64, len(ws))]


class Bags:
    """The words of several texts as one array, with the start of each text; no text is empty."""

    def __init__(self, tokens: list[np.ndarray]) -> None:
        self.n = np.array([len(t) for t in tokens])
        self.start = np.concatenate([[0], np.cumsum(self.n)[:-1]])
        self.text = np.repeat(np.arange(len(tokens)), self.n)
        self.all = np.concatenate(tokens)

    def mean(self, x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, self.start) / self.n

    def ordered(self, x: np.ndarray) -> np.ndarray:
        """Values sorted within each text; they must lie in [0, 2^20)."""
        return np.sort((self.text << 20) | x) & ((1 << 20) - 1)

    def ranks(self, ordered: np.ndarray, shares: tuple[float, ...]) -> list[np.ndarray]:
        return [ordered[self.start + (q * (self.n - 1) + 0.5).astype(np.int64)] for q in shares]


#: Steps of the scale on which frequencies and grades are put in order.
STEPS = 1 << 16


def base_features(texts: list[tuple[str, str, list[str]]], bags: Bags, logf: np.ndarray) -> np.ndarray:
    """Features that need no labels, one row per text."""
    size, vowels, bucket = (bags.all[:, k] for k in range(3))
    n = bags.n
    m = bags.mean(size)
    f = logf[bucket].astype(float)
    fm = bags.mean(f)
    scaled = np.clip((f + 10.0) * (STEPS / 10.0), 0, STEPS).astype(np.int64)
    order = bags.ordered(bucket)
    new = np.ones(len(order), bool)
    new[1:] = (order[1:] != order[:-1]) | (bags.text[1:] != bags.text[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(order)))
    distinct = np.add.reduceat(new.astype(np.int64), bags.start)
    most = np.maximum.reduceat(counts, np.concatenate([[0], np.cumsum(distinct)[:-1]]))
    cols = [
        np.log(n), m, np.sqrt(np.maximum(bags.mean(size * size) - m * m, 0)), *(bags.mean((size >= k).astype(float)) for k in (7, 10, 13)), bags.mean((size <= 3).astype(float)),
        *bags.ranks(bags.ordered(np.minimum(size, 1000)), (0.5, 0.75, 0.9, 0.97)), bags.mean(vowels), bags.mean((vowels >= 4).astype(float)),
        fm, np.sqrt(np.maximum(bags.mean(f * f) - fm * fm, 0)), *bags.ranks(bags.ordered(scaled), (0.05, 0.25, 0.5)), distinct / np.sqrt(n), most / n,
    ]
    own = np.array([_text_features(flat, ws) for _, flat, ws in texts])
    return np.hstack([np.stack(cols, 1), own])


def _text_features(flat: str, ws: list[str]) -> list[float]:
    """Sentence lengths, marks, and words that neighbouring windows share."""
    n = len(ws)
    ends = sorted([x.count(" ") + 1 for x in _ENDS.split(flat) if x and not x.isspace()] or [n])
    shared = []
    before = None
    for i in range(0, n - WINDOW + 1, WINDOW):
        now = set(ws[i : i + WINDOW])
        if before is not None:
            both = len(before & now)
            shared.append(both / (len(before) + len(now) - both))
        before = now
    k = len(shared)
    c = sum(shared) / k if k else 0.15
    return [math.log(sum(ends) / len(ends)), math.log(ends[len(ends) // 2]), math.log(ends[-1]), len(ends) / n, *(flat.count(x) / n for x in ",;:(?-"), c, max(shared) - min(shared) if k else 0.0]


def word_features(bags: Bags, grade: np.ndarray) -> np.ndarray:
    """Distribution of the grades of each text's words."""
    g = grade[bags.all[:, 2]].astype(float)
    far = np.abs(g - 2.0)
    order = bags.ordered(np.clip((g - 1.0) * (STEPS / 2.0), 0, STEPS).astype(np.int64))
    cols = [bags.mean(g), *bags.ranks(order, (0.05, 0.25, 0.5, 0.75, 0.95)), bags.mean((g > 2.4).astype(float)), bags.mean((g < 1.6).astype(float)), bags.mean(g * far) / np.maximum(bags.mean(far), 1e-9)]
    return np.stack(cols, 1)


class Trees:
    """Gradient-boosted regression trees on binned features, squared loss."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, leaf: int = LEAF, seed: int = 7) -> None:
        self.trees, self.depth, self.rate, self.leaf, self.seed = trees, depth, rate, leaf, seed
        self.model: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1).astype(np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        b = self.bins(x)
        rng = np.random.default_rng(self.seed)
        self.base = float(y.mean())
        pred = np.full(len(y), self.base)
        n, m = b.shape
        width = BINS + 1
        offset = b + np.arange(m) * width
        for _ in range(self.trees):
            use = rng.random(n) < 0.7
            feats = np.sort(rng.choice(m, max(1, int(m * 0.6)), replace=False))
            feature = np.full((1 << self.depth) - 1, -1, np.int64)
            cut = np.zeros((1 << self.depth) - 1, np.int64)
            node = np.zeros(n, np.int64)
            res = y - pred
            for k in range((1 << self.depth) - 1):
                at = np.flatnonzero(use & (node == k))
                if len(at) < 2 * self.leaf:
                    continue
                cells = offset[at][:, feats].ravel()
                cnt = np.bincount(cells, minlength=m * width).reshape(m, width)[feats]
                tot = np.bincount(cells, weights=np.repeat(res[at], len(feats)), minlength=m * width).reshape(m, width)[feats]
                lc, ls = cnt.cumsum(1)[:, :-1], tot.cumsum(1)[:, :-1]
                rc, rs = len(at) - lc, res[at].sum() - ls
                ok = (lc >= self.leaf) & (rc >= self.leaf)
                gain = np.where(ok, ls**2 / np.maximum(lc, 1) + rs**2 / np.maximum(rc, 1), -np.inf)
                best = int(gain.argmax())
                if not ok.ravel()[best] or gain.ravel()[best] <= res[at].sum() ** 2 / len(at) + 1e-9:
                    continue
                feature[k], cut[k] = feats[best // (width - 1)], best % (width - 1)
                here = node == k
                node[here] = 2 * k + 1 + (b[here, feature[k]] > cut[k])
            # final place of every row: nodes without a cut keep their rows
            value = np.zeros((1 << (self.depth + 1)) - 1)
            cnt = np.bincount(node[use], minlength=len(value))
            tot = np.bincount(node[use], weights=res[use], minlength=len(value))
            value = self.rate * tot / np.maximum(cnt + 1.0, 1)
            self.model.append((feature, cut, value))
            pred = pred + value[node]
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        out = np.full(len(x), self.base)
        for feature, cut, value in self.model:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                inner = node < len(feature)
                f = np.where(inner, feature[np.minimum(node, len(feature) - 1)], -1)
                go = f >= 0
                side = b[np.arange(len(x)), np.maximum(f, 0)] > cut[np.minimum(node, len(cut) - 1)]
                node = np.where(go, 2 * node + 1 + side, node)
            out += value[node]
        return out


def grades_of_words(buckets: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Smoothed mean grade of the texts that use a word, by bucket."""
    n = np.zeros(BUCKETS)
    s = np.zeros(BUCKETS)
    for b, v in zip(buckets, y):
        n[b] += 1
        s[b] += v
    mean = float(y.mean()) if len(y) else 2.0
    return ((s + PRIOR * mean) / (n + PRIOR)).astype(np.float32)


def thresholds(pred: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """The cuts between bands that make most of the raters' bands right."""
    y = np.clip(np.round(y), 1, 3)

    def cut(low: float, high: float, below: np.ndarray) -> float:
        at = np.linspace(low, high, 61)
        return float(at[int(np.argmax([((pred < a) == below).mean() - 0.02 * abs(a - (low + high) / 2) for a in at]))])

    return cut(1.2, 1.8, y <= 1), cut(2.2, 2.8, y <= 2)


class Grader:
    """A trained model with what it needs to make features; goes to the workers."""

    def __init__(self, logf: np.ndarray, grade: np.ndarray, trees: Trees | None, cuts: tuple[float, float], report: dict) -> None:
        self.logf, self.grade, self.trees, self.cuts, self.report = logf, grade, trees, cuts, report

    def scores(self, rows: list[tuple[str, str, list[str]]], lexicon: Lexicon) -> np.ndarray:
        if self.trees is None:
            return np.full(len(rows), 2.0)
        bags = Bags([lexicon(ws) for _, _, ws in rows])
        return self.trees.predict(np.hstack([base_features(rows, bags, self.logf), word_features(bags, self.grade)]))

    def bands(self, scores: np.ndarray) -> np.ndarray:
        return 1 + (scores >= self.cuts[0]) + (scores >= self.cuts[1])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    buckets: dict[str, int] = {}
    for batch in batches:
        counts: Counter = Counter()
        for text in batch.column(0).to_pylist():
            if text:
                counts.update(words(normal(text)))
        if len(buckets) > 500_000:
            buckets.clear()
        for w, n in counts.items():
            b = buckets.get(w)
            if b is None:
                b = buckets[w] = xxhash.xxh3_64_intdigest(w) % BUCKETS
            total[b] += n
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])


def frequencies(documents: DataFrame) -> np.ndarray:
    """Log relative frequencies of the word buckets over all documents."""
    rows = spread(documents.select("text")).mapInArrow(_frequencies, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(BUCKETS)
    for r in rows:  # at most BUCKETS rows
        n[r["bucket"]] = r["n"]
    return np.log10((n + 1) / (n.sum() + 1)).astype(np.float32)


def _label_features(logf: np.ndarray):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon()
        for batch in batches:
            ids, src, y, rows = [], [], [], []
            for doc, source, grade, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                flat = normal(text or "")
                ws = words(flat)
                if len(ws) >= MIN_WORDS:
                    ids.append(doc), src.append(source), y.append(grade), rows.append((text, flat, ws))
            tokens = [lexicon(ws) for _, _, ws in rows]
            x = base_features(rows, Bags(tokens), logf).tolist() if rows else []
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(src, pa.string()), pa.array(y, pa.float64()), pa.array(x, pa.list_(pa.float64())), pa.array([t[:, 2].astype(np.int32) for t in tokens], pa.list_(pa.int32()))], names=["doc_id", "source", "y", "x", "b"])

    return go


def train(documents: DataFrame, labels: DataFrame) -> Grader:
    logf = frequencies(documents)
    per_doc = labels.where("band between 1 and 3").groupBy("doc_id").agg(F.avg("band").alias("y"))
    total = per_doc.count()
    if total > TRAIN:
        per_doc = per_doc.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(TRAIN / total * (1 << 30)))
    joined = documents.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), "text").join(per_doc, "doc_id").select("doc_id", "source", "y", "text")
    got = joined.mapInArrow(_label_features(logf), "doc_id bigint, source string, y double, x array<double>, b array<int>").toPandas().sort_values("doc_id")
    if len(got) < 4 * LEAF:
        return Grader(logf, grades_of_words([], np.empty(0)), None, (1.5, 2.5), {"documents": len(got)})
    y = got["y"].to_numpy(float)
    base = np.array(got["x"].tolist())
    bags = [np.asarray(b) for b in got["b"]]
    sets = [np.unique(b) for b in bags]
    fold = np.array([xxhash.xxh3_64_intdigest(s) % FOLDS for s in got["source"]])
    if len(np.unique(fold)) < 2:
        fold = np.arange(len(y)) % FOLDS
    inner = np.array([xxhash.xxh3_64_intdigest(str(d)) % FOLDS for d in got["doc_id"]])

    def features(train_at: np.ndarray, apply_at: np.ndarray) -> np.ndarray:
        grade = grades_of_words([sets[i] for i in train_at], y[train_at])
        return word_features(Bags([np.repeat(bags[i][:, None], 3, 1) for i in apply_at]), grade)

    def own_features(at: np.ndarray) -> np.ndarray:
        """Word grades of training documents, each from the others' labels."""
        out = np.zeros((len(at), 9))
        for k in range(FOLDS):
            held = inner[at] == k
            if held.any():
                out[held] = features(at[~held], at[held])
        return out

    every = np.arange(len(y))
    oof = np.full(len(y), float(y.mean()))
    for k in np.unique(fold):
        held, rest = every[fold == k], every[fold != k]
        if len(rest) < 4 * LEAF:
            continue
        model = Trees().fit(np.hstack([base[rest], own_features(rest)]), y[rest])
        oof[held] = model.predict(np.hstack([base[held], features(rest, held)]))
    cuts = thresholds(oof, y)
    trees = Trees().fit(np.hstack([base, own_features(every)]), y)
    rated = np.clip(np.round(y), 1, 3)
    band = 1 + (oof >= cuts[0]) + (oof >= cuts[1])
    report = {"documents": len(y), "rmse": float(np.sqrt(((oof - y) ** 2).mean())), "agreement": float((band == rated).mean()), "by_source": {s: float((band == rated)[(got["source"] == s).to_numpy()].mean()) for s in sorted(set(got["source"]))}}
    of = {s: (got["source"] == s).to_numpy() for s in report["by_source"]}
    report |= {"documents_of": {s: int(m.sum()) for s, m in of.items()}, "rmse_of": {s: float(np.sqrt(((oof - y)[m] ** 2).mean())) for s, m in of.items()}}
    return Grader(logf, grades_of_words(sets, y), trees, cuts, report)


def _grade(grader: Grader, min_words: int, with_score: bool):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon()
        for whole in batches:
            for at in range(0, max(whole.num_rows, 1), 1000):
                batch = whole.slice(at, 1000)
                rows, ids, empty = [], [], []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    flat = normal(text or "")
                    ws = words(flat)
                    if len(ws) >= min_words and ws:
                        rows.append((text, flat, ws)), ids.append(doc)
                    elif with_score:
                        empty.append(doc)
                s = grader.scores(rows, lexicon) if rows else np.empty(0)
                b = grader.bands(s).astype(np.int32).tolist()
                if with_score:
                    none = [None] * len(empty)
                    yield pa.RecordBatch.from_arrays([pa.array(ids + empty, pa.int64()), pa.array(b + none, pa.int32()), pa.array(np.round(s, 4).tolist() + none, pa.float64())], names=["doc_id", "band", "grade"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(b, pa.int32())], names=["doc_id", "band"])

    return go


def found(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, band) of every document of at least MIN_WORDS words."""
    grader = train(documents, labels)
    return spread(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")).mapInArrow(_grade(grader, MIN_WORDS, False), "doc_id bigint, band int")


def grades(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, band, grade) of every document; null for texts without words."""
    grader = train(documents, labels)
    return spread(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")).mapInArrow(_grade(grader, 1, True), "doc_id bigint, band int, grade double")


def by_source(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(source, documents, agreement, rmse): how the bands of left-out sources agree with their raters; source ``*`` for all.

    Documents are labelled ones, at most TRAIN of them, each graded by a model that saw none of its fold's sources.
    """
    report = train(documents, labels).report
    # too few labels make no model, and nothing to compare
    rows = [(s, report["documents_of"][s], float(a), report["rmse_of"][s]) for s, a in report.get("by_source", {}).items()]
    rows.append(("*", report["documents"], report.get("agreement"), report.get("rmse")))
    return documents.sparkSession.createDataFrame(rows, "source string, documents bigint, agreement double, rmse double")
