"""Near-duplicates: weighted minwise signatures, bands and verification.

The signature is a BagMinHash. Each element (a run of words) has the weight axis [0, w), w being its count. The axis is
cut into the dyadic ranges [0,1), [1,2), [2,4), [4,8), ...; each (element, range) owns a Poisson process of points over
time, with a rate of (length of range) x (signature size). A point carries a position of the signature and, in the
range that w cuts, a weight mark: it counts if the mark lies below w. Position i keeps the point that comes first. Two
bags agree in a position with a probability of exactly their weighted Jaccard similarity, since the first point of the
union of both bags lies in the intersection with that probability. Points are drawn only up to the horizon by which
all positions are expected to be filled, so a signature costs about m ln m draws whatever the number of elements; a
text whose positions are not all filled by then is drawn again with the horizon doubled.

Bands of ROWS positions give bucket keys. A text whose runs repeat has the buckets of two signatures, with its counts as
weights and with all weights 1 (drawn together), so repeats hide no pair. Classes (texts that differ in more than
formatting) that share a bucket are candidates, each pair once; a 248-bit sketch of the plain signature drops pairs
far below the threshold, and the words of both texts decide: by distinct runs, as the case is defined, or by multisets.

Chance of missing a pair, about (1 - s^5)^100: 0.04 at s = 0.5, 0.006 at 0.55, 0.0003 at 0.6, nothing to speak of above.
Sketches drop a pair of s = 0.5 with a probability under 0.001. Bucket keys of 40 bits bring a chance pair in 10^12, which
the sketches drop.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm import fieldcodes
from textloom.llm.components import components
from textloom.llm.fieldcodes import Encoder, halves
from textloom.llm.normal import normal, words
from textloom.plans.staging import sized, spread, stage

#: Shape of the signature: CUT x ROWS positions. Each stride makes CUT bands of positions so far apart.
CUT, ROWS = 50, 5
SIZE = CUT * ROWS
STRIDES = (1, 97, 43)
#: Bands of a text, and bits of their bucket keys.
BANDS, KEY_BITS = 100, 40
#: One bit of each of PARTS x PART_BITS positions makes the sketch.
PARTS, PART_BITS = 4, 62
SKETCHED = [f"s{k + 1}" for k in range(PARTS)]
#: Word run length, least words of a text and least similarity, as TESTDATA.md states them for p3.
RUN, MIN_WORDS, SIMILARITY = 3, 80, 0.5
#: Most row_ids (8 bytes each) that are broadcast; more meet in a shuffle.
FEW = 1_000_000
#: Classes in a bucket above which ``links`` compares with the bucket's centre first.
HOT = 32
_U = np.uint64
_G = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser with full avalanche; wraps around."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHashes:
    """64-bit hashes of words through a memo."""

    def __init__(self, most: int = 200_000) -> None:
        self.memo: dict[str, int] = {}
        self.most = most

    def __call__(self, ws: list[str]) -> np.ndarray:
        import xxhash

        memo = self.memo
        if len(memo) > self.most:
            memo.clear()
        try:
            return np.fromiter(map(memo.__getitem__, ws), np.uint64, len(ws))
        except KeyError:
            for w in ws:
                if w not in memo:
                    memo[w] = xxhash.xxh3_64_intdigest(w)
            return np.fromiter(map(memo.__getitem__, ws), np.uint64, len(ws))


def runs(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` consecutive words."""
    if len(h) < length:
        return h[:0]
    out = h[: len(h) - length + 1].copy()
    for j in range(1, length):
        out = mix(out + _G) ^ h[j : len(h) - length + 1 + j]
    return mix(out)


def sketch_floor(similarity: float, bits: int = PARTS * PART_BITS) -> int:
    """Agreeing sketch bits below which a pair of at least ``similarity`` is 3.5 standard deviations away."""
    p = (1 + similarity) / 2
    return int(bits * p - 3.5 * math.sqrt(bits * p * (1 - p)))


def dyadic(elements: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The Poisson processes of a bag: seeds, range lengths, the part of the range below the weight; how many are [0, 1)."""
    seeds, lengths, parts = [mix(elements)], [np.ones(len(elements))], [np.ones(len(elements))]
    low, level = 1, 1
    many = counts > 1
    e, c = elements[many], counts[many]
    while len(e):
        seeds.append(mix(e + _U((level * int(_G)) & 0xFFFFFFFFFFFFFFFF)))
        lengths.append(np.full(len(e), float(low)))
        parts.append(np.minimum(c - low, low).astype(float))
        low, level = low * 2, level + 1
        keep = c > low
        e, c = e[keep], c[keep]
    return np.concatenate(seeds), np.concatenate(lengths), np.concatenate(parts), len(elements)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """The BagMinHash of each bag of (distinct elements, counts): one row of 64-bit names of first points a bag."""
    return _signatures([dyadic(*bag) for bag in bags], size)


def plain_and_weighted(bags: list[tuple[np.ndarray, np.ndarray]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two signatures of each bag: with all weights 1 and with its counts; equal for a bag without repeats.

    The points of the plain signature are those of the ranges [0, 1), so both come from the same draws unless the counts
    are so high that these would be many.
    """
    weighted = np.zeros((len(bags), size), np.uint64)
    plain = np.zeros((len(bags), size), np.uint64)
    heavy = np.array([counts.sum() > HEAVY * len(elements) for elements, counts in bags], bool)
    together, apart = np.flatnonzero(~heavy), np.flatnonzero(heavy)
    if len(together):
        rows = np.zeros((len(together), size), np.uint64)
        weighted[together] = _signatures([dyadic(*bags[k]) for k in together], size, rows)
        plain[together] = rows
    if len(apart):
        weighted[apart] = _signatures([dyadic(*bags[k]) for k in apart], size)
        plain[apart] = _signatures([dyadic(bags[k][0], np.ones(len(bags[k][0]), int)) for k in apart], size)
    return plain, weighted


def _signatures(made: list, size: int, plain: np.ndarray | None = None) -> np.ndarray:
    out = np.zeros((len(made), size), np.uint64)
    weights = np.array([parts.sum() if plain is None else n for _, _, parts, n in made])
    slack = np.full(len(made), 3.5)
    todo = np.argsort(weights)
    while len(todo):
        again = []
        for chunk in np.split(todo, range(BATCH, len(todo), BATCH)):
            horizons = (math.log(size) + slack[chunk]) / weights[chunk]
            again.extend(chunk[~_drawn([made[b] for b in chunk], size, horizons, out, chunk, plain)])
        slack[again] = slack[again] * 2 + 2
        todo = np.array(again, dtype=np.int64)
    return out


#: Bags drawn together, of about the same weight; bags of more than HEAVY times their distinct elements are drawn apart.
BATCH, HEAVY = 12, 2


def _drawn(made: list, size: int, horizons: np.ndarray, out: np.ndarray, at_rows: np.ndarray, plain: np.ndarray | None) -> np.ndarray:
    """Draws all points before the horizons of some bags and writes their rows; False for bags with an empty position.

    ``plain`` takes the first points of the ranges [0, 1) alone, where asked for.
    """
    seeds, lengths, parts = (np.concatenate([m[k] for m in made]) for k in range(3))
    bag = np.repeat(np.arange(len(made), dtype=np.uint64), [len(m[0]) for m in made])
    first_range = np.concatenate([np.arange(len(m[0])) < m[3] for m in made])
    several = plain is not None and not first_range.all()
    until = np.repeat(horizons, [len(m[0]) for m in made])
    # time in units of each bag's horizon
    step = (1 / (lengths * until * size)).astype(np.float32)
    names, keys, firsts = [], [], []
    start, at = 0, None
    while len(seeds):
        expected = 1 / np.median(step)
        block = int(expected + 1.5 * math.sqrt(expected) + 2) if start == 0 else 12
        bits = seeds[None, :] + (np.arange(start, start + block, dtype=np.uint64) * _G)[:, None]
        bits ^= bits >> _U(32)
        bits *= _U(0xD6E8FEB86659FD93)
        bits ^= bits >> _U(32)
        bits *= _U(0xD6E8FEB86659FD93)
        t = (bits >> _U(40)).astype(np.float32)
        t += np.float32(0.5)
        np.log(t, out=t)
        np.subtract(np.float32(24 * math.log(2)), t, out=t)
        t *= step
        np.add.accumulate(t, axis=0, out=t)
        if start:
            t += at
        live = t < 1
        more = live[-1]
        cut = np.flatnonzero(parts < lengths)
        if len(cut):
            mark = (mix(bits[:, cut]) >> _U(11)).astype(np.float64) * 2.0**-53 * lengths[cut]
            more = more.copy()
            live[:, cut] &= mark < parts[cut]
        index = np.flatnonzero(live)
        name = bits.ravel()[index]
        spot = ((name & _U(0xFFFFFF)) * _U(size)) >> _U(24)
        spot += bag[index % len(seeds)] * _U(size)
        if several:
            firsts.append(first_range[index % len(seeds)])
            first_range = first_range[more]
        names.append(name)
        keys.append((spot << _U(24)) | (t.ravel()[index] * np.float32(1 << 24)).astype(np.uint64))
        seeds, step, parts, lengths, bag, at = seeds[more], step[more], parts[more], lengths[more], bag[more], t[-1][more]
        start += block
    name, key = (names[0], keys[0]) if len(names) == 1 else (np.concatenate(names), np.concatenate(keys))
    rows, filled = _first_points(name, key, len(made), size)
    ones = rows
    if several:
        low = np.concatenate(firsts)
        ones, ones_filled = _first_points(name[low], key[low], len(made), size)
        filled &= ones_filled
    out[at_rows[filled]] = rows[filled]
    if plain is not None:
        plain[at_rows[filled]] = ones[filled]
    return filled


def _first_points(name: np.ndarray, key: np.ndarray, bags: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first point of each position of each bag, and whether all of a bag's positions have one."""
    width = max(1, int(len(key)).bit_length())
    # sorted by bag, position and time; the low bits lead back to the point
    order = np.sort((key << _U(width)) | np.arange(len(key), dtype=np.uint64))
    spot = (order >> _U(width + 24)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], spot[1:] != spot[:-1]])) if len(spot) else np.empty(0, np.int64)
    filled = np.bincount(spot[first] // size, minlength=bags) == size
    rows = np.zeros((bags, size), np.uint64)
    rows.ravel()[spot[first]] = name[(order[first] & _U((1 << width) - 1)).astype(np.int64)]
    return rows, filled


def signature(elements: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The BagMinHash of one bag."""
    return signatures([(elements, counts)], size)[0]


def bands_and_sketch(sig: np.ndarray, bands: int = BANDS) -> tuple[np.ndarray, np.ndarray]:
    """Of each signature (a row): the bands' bucket keys, and bits of its positions."""
    at = np.concatenate([(np.arange(SIZE) * stride % SIZE).reshape(CUT, ROWS) for stride in STRIDES])[:bands]
    key = mix(np.arange(1, len(at) + 1, dtype=np.uint64) * _G)[None, :].repeat(len(sig), 0)
    for j in range(ROWS):
        key = mix(key ^ sig[:, at[:, j]])
    key >>= _U(64 - KEY_BITS)
    bits = (mix(sig[:, : PARTS * PART_BITS]) & _U(1)).reshape(len(sig), PARTS, PART_BITS) << np.arange(PART_BITS, dtype=np.uint64)
    return key.view(np.int64), bits.sum(axis=2, dtype=np.uint64).view(np.int64)


def buckets(bags: list[tuple[np.ndarray, np.ndarray]], bands: int = BANDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket keys of all bags in one array, how many each has, and the sketches of the plain signatures.

    A bag has the buckets of its weighted signature, and those of its plain one that differ: pairs meet whether they
    agree with or without regard to how often a run occurs.
    """
    if not bags:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, PARTS), np.int64)
    plain, weighted = plain_and_weighted(bags, SIZE)
    own, sketch = bands_and_sketch(plain, bands)
    more, _ = bands_and_sketch(weighted, bands)
    both = np.concatenate([own, more], axis=1)
    keep = np.ones(both.shape, bool)
    keep[:, own.shape[1] :] = own != more
    return both[keep], keep.sum(axis=1), sketch


def listed(has: np.ndarray, keys: np.ndarray, lengths: np.ndarray, sketch: np.ndarray) -> list[pa.Array]:
    """The columns s1.. and bands of a batch; ``has`` tells which rows have a signature."""
    counts, signs = np.zeros(len(has), np.int64), np.zeros((len(has), PARTS), np.int64)
    counts[has], signs[has] = lengths, sketch
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    out = [pa.array(signs[:, k], pa.int64(), mask=~has) for k in range(PARTS)]
    return [*out, pa.ListArray.from_arrays(offsets, pa.array(keys, pa.int64()), mask=pa.array(~has))]


def without(held: DataFrame, extra: DataFrame) -> DataFrame:
    """``held`` without the row_ids of ``extra``; wide rows only move where there are more than FEW ids."""
    extra = stage(extra, "extra")
    n = extra.count()
    if not n:
        return held
    return held.join(F.broadcast(extra) if n <= FEW else extra, "row_id", "left_anti")


def texts_of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """(row_id, text) of the rows named in ``ids``; texts only move where there are more than FEW ids."""
    ids = stage(ids.distinct(), "ids")
    return stage(texts.join(F.broadcast(ids) if ids.count() <= FEW else ids, "row_id", "left_semi"), "texts")


def alike(pairs: DataFrame, sketches: DataFrame, a: str, b: str, similarity: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose sketches leave room for the similarity; ``sketches`` has one (row_id, s1..) per id.

    Half of the sketch goes first, as most pairs fall by it; each half may drop a pair at the threshold in 1 of 4000.
    """
    def joined(pairs: DataFrame, names: list[str]) -> DataFrame:
        for side in (a, b):
            pairs = pairs.join(sketches.select(F.col("row_id").alias(side), *[F.col(n).alias(f"{side}_{n}") for n in names]), side)
        return pairs

    def apart(names: list[str]):
        return sum((F.bit_count(F.col(f"{a}_{n}").bitwiseXOR(F.col(f"{b}_{n}"))) for n in names), F.lit(0))

    half = SKETCHED[: PARTS // 2]
    bits = PART_BITS * len(half)
    first = joined(pairs, half).select(a, b, apart(half).alias("apart")).where(F.col("apart") <= bits - sketch_floor(similarity, bits))
    rest = SKETCHED[PARTS // 2 :]
    return joined(first, rest).where(F.col("apart") + apart(rest) <= PARTS * PART_BITS - sketch_floor(similarity)).select(a, b)


SIGNED = "row_id bigint, t_hi bigint, t_lo bigint, f_hi bigint, f_lo bigint, s1 bigint, s2 bigint, s3 bigint, s4 bigint, bands array<bigint>"


def _sign(run: int, min_words: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, hashes = Encoder(), WordHashes()
        seen: set = set()
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                yield sign_batch(whole.slice(at, 1000), enc, hashes, seen, run, min_words)

    return go


def sign_batch(batch: pa.RecordBatch, enc: Encoder, hashes: WordHashes, seen: set, run: int, min_words: int) -> pa.RecordBatch:
    ids: list = []
    keys: list[list] = [[], [], [], []]
    bags: list = []
    signed: list[bool] = []
    for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        if not text:
            continue
        flat = normal(text)
        ws = words(flat)
        if len(ws) < min_words:
            continue
        t, f = enc.keys(text, flat, "".join(ws))
        ids.append(row)
        for col, v in zip(keys, (*halves(t), *halves(f))):
            col.append(v)
        # letters seen before in this task: the first row's signature serves the class
        signed.append(t not in seen)
        if signed[-1]:
            if len(seen) < 1_000_000:
                seen.add(t)
            el = np.sort(runs(hashes(ws), run))
            first = np.flatnonzero(np.concatenate([[True], el[1:] != el[:-1]]))
            bags.append((el[first], np.diff(np.append(first, len(el)))))
    columns = listed(np.array(signed, bool), *buckets(bags))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (ids, *keys)] + columns, names=[x.split()[0] for x in SIGNED.split(", ")])


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a or b else 0.0


def multiset_jaccard(a: Counter, b: Counter) -> float:
    """Sum of the smaller counts over sum of the larger counts."""
    return (a & b).total() / (a | b).total() if a or b else 0.0


def word_runs(ws: list[str], run: int) -> set:
    return set(zip(*(ws[j:] for j in range(run))))


def _verify(run: int, least: float, multiset: bool):
    overlap = multiset_jaccard if multiset else jaccard

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            memo: dict = {}

            def of(text: str):
                got = memo.get(text)
                if got is None:
                    if len(memo) > 2000:
                        memo.clear()
                    ws = words(normal(text))
                    got = memo[text] = Counter(zip(*(ws[j:] for j in range(run)))) if multiset else word_runs(ws, run)
                return got

            a, b, ta, tb = (batch.column(k).to_pylist() for k in range(4))
            keep = [overlap(of(x), of(y)) >= least for x, y in zip(ta, tb)]
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    return go


def verified(pairs: DataFrame, texts: DataFrame, run: int = RUN, least: float = SIMILARITY, multiset: bool = False) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts agree; ``texts`` has one (row_id, text) per id.

    A run counts once a text, as the case is defined, or with ``multiset`` as often as it occurs.
    """
    texts = texts_of(texts, pairs.select(F.col("a").alias("row_id")).union(pairs.select(F.col("b").alias("row_id"))))
    left = texts.select(F.col("row_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("row_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_verify(run, least, multiset), "a bigint, b bigint")


class NearDuplicates:
    """Near-duplicate classes of a table and the staged tables behind them.

    Rows with null, empty or short texts (fewer than ``min_words`` words) have no near-duplicates. Texts that are the
    same but for formatting are one class, compared once; ``members`` maps rows to it. Very long texts are signed
    whole. An empty table gives empty results; further columns play no part.
    """

    def __init__(self, df: DataFrame, row: str = "row_id", text: str = "text", run: int = RUN, min_words: int = MIN_WORDS, similarity: float = SIMILARITY, multiset: bool = False) -> None:
        self.texts = df.select(F.col(row).cast("bigint").alias("row_id"), F.col(text).alias("text"))
        self.run, self.min_words, self.similarity, self.multiset = run, min_words, similarity, multiset
        self.signed = stage(spread(self.texts).mapInArrow(_sign(run, min_words), SIGNED), "signed")
        keyed = fieldcodes.closed_keys(self.signed.select("row_id", "t_hi", "t_lo", "f_hi", "f_lo", *SKETCHED))
        #: (row_id, rep): each row's class, named by the smallest row that carries a signature.
        self.keyed = stage(keyed.select("row_id", "k_hi", "k_lo", *SKETCHED), "keyed")
        first = F.min(F.when(F.col("s1").isNotNull(), F.struct("row_id", *SKETCHED)))
        classes = self.keyed.groupBy("k_hi", "k_lo").agg(first.alias("r"), F.count(F.lit(1)).alias("copies"))
        self.classes = stage(classes.select("k_hi", "k_lo", F.col("r.row_id").alias("rep"), *[F.col(f"r.{n}").alias(n) for n in SKETCHED], "copies"), "classes")

    def buckets(self) -> DataFrame:
        """(bucket, row_id) of representatives: a class of copies counts once in each of its buckets."""
        held = self.signed.where("bands is not null")
        extra = self.keyed.where("s1 is not null").select("row_id").join(self.classes.select(F.col("rep").alias("row_id")), "row_id", "left_anti")
        # about 24 bytes for each bucket of a text
        return sized(without(held, extra).select("row_id", F.explode("bands").alias("bucket")), 24 * BANDS * self.classes.count(), "bucket")

    def close(self, candidates: DataFrame) -> DataFrame:
        """The (a, b) of ``candidates`` that agree by sketch, and then by text."""
        near = stage(alike(candidates, self.classes.select(F.col("rep").alias("row_id"), *SKETCHED), "a", "b", self.similarity), "near")
        return stage(verified(near, self.texts, self.run, self.similarity, self.multiset), "pairs")

    def pairs(self) -> DataFrame:
        """(a, b), a < b: all representatives of near-duplicate classes; as many as there are near pairs."""
        keyed = self.buckets()
        left = keyed.select("bucket", F.col("row_id").alias("a"))
        right = keyed.select("bucket", F.col("row_id").alias("b"))
        return self.close(left.join(right, "bucket").where("a < b").select("a", "b").distinct())

    def links(self) -> DataFrame:
        """(a, b): verified links that connect the same representatives as ``pairs``, without the pairs of hot buckets.

        A bucket of more than HOT classes is compared with one of them, its centre. Members near the centre are linked
        by it; a member that isn't near it is compared with all of the bucket. So a hot family costs one
        comparison a member, and no connection is lost.
        """
        keyed = self.buckets()
        hot = stage(keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("centre")).where(F.col("n") > HOT).select("bucket", "centre"), "hot")
        if hot.isEmpty():
            return self.pairs()
        cold = keyed.join(hot, "bucket", "left_anti")
        left = cold.select("bucket", F.col("row_id").alias("a"))
        right = cold.select("bucket", F.col("row_id").alias("b"))
        member = stage(keyed.join(hot, "bucket").where("row_id <> centre"), "hot_members")
        star = member.select(F.col("centre").alias("a"), F.col("row_id").alias("b"))
        first = self.close(left.join(right, "bucket").where("a < b").select("a", "b").unionByName(star).distinct())
        far = member.join(first.select(F.col("a").alias("centre"), F.col("b").alias("row_id")), ["centre", "row_id"], "left_anti")
        far = stage(far.select("bucket", F.col("row_id").alias("x")), "far")
        if far.isEmpty():
            return first
        others = far.join(member.select("bucket", F.col("row_id").alias("y")), "bucket").where("x <> y")
        rest = others.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        return first.unionByName(self.close(rest))

    def members(self) -> DataFrame:
        """(row_id, rep) of every row of min_words words or more."""
        return self.keyed.select("row_id", "k_hi", "k_lo").join(self.classes.select("k_hi", "k_lo", "rep", "copies"), ["k_hi", "k_lo"]).select("row_id", "rep", "copies")


def found(df: DataFrame) -> DataFrame:
    """(row_id_a, row_id_b), row_id_a < row_id_b: all pairs of near-duplicate rows that are not the same record."""
    near = NearDuplicates(df)
    members = near.members()
    pairs = near.pairs()
    involved = pairs.select(F.col("a").alias("rep")).union(pairs.select(F.col("b").alias("rep"))).distinct()
    members = stage(members.join(involved, "rep", "left_semi"), "members")
    rows_a = members.select(F.col("rep").alias("a"), F.col("row_id").alias("ra"))
    rows_b = members.select(F.col("rep").alias("b"), F.col("row_id").alias("rb"))
    out = pairs.join(rows_a, "a").join(rows_b, "b")
    return out.select(F.least("ra", "rb").alias("row_id_a"), F.greatest("ra", "rb").alias("row_id_b"))


def linked(df: DataFrame) -> DataFrame:
    """(row_id, class_id, copies) of every row of MIN_WORDS words or more.

    ``class_id`` is the smallest row_id of all rows that a chain of near-duplicates connects with the row (its own where
    it has none), ``copies`` the number of rows that are the same record.
    """
    near = NearDuplicates(df)
    roots = components(near.links()).select(F.col("node").alias("rep"), "root")
    smallest = near.keyed.groupBy("k_hi", "k_lo").agg(F.min("row_id").alias("least"))
    classes = near.classes.select("k_hi", "k_lo", "rep", "copies").join(smallest, ["k_hi", "k_lo"]).join(roots, "rep", "left")
    classes = stage(classes.withColumn("root", F.coalesce("root", "rep")).select("k_hi", "k_lo", "root", "least", "copies"), "rooted")
    names = classes.groupBy("root").agg(F.min("least").alias("class_id"))
    named = classes.join(names, "root").select("k_hi", "k_lo", "class_id", "copies")
    return near.keyed.select("row_id", "k_hi", "k_lo").join(named, ["k_hi", "k_lo"]).select("row_id", "class_id", "copies")
