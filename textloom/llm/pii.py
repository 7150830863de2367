"""Personal information in free text: bootstrapped contextual extraction.

Seed entities (addresses in strict e-mail form, numbers in international or other fixed forms, streets by the commonest
street words, frequent given names) are found in the texts together with the words before them. These contexts and the
instances they precede (number shapes, street words, name words) make a bipartite graph per type. Spark scores it
iteratively: a context's confidence is the share of its occurrences that precede trusted instances, an instance's
score the share of its occurrences in trusted contexts; seeds stay trusted. Contexts of high confidence then find
identifiers of unseen form, names of any word, streets of any kind and numbers spelled out.

Matching works on folded text (NFKC, no format characters, lower case, no accents, one space for any white space
character), with offsets kept, so spellings in one case, full-width digits or invisible characters don't hide a case.
Null and empty texts give no rows; very long texts are read whole; a text may hold any number of cases.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.plans.staging import spread, stage

TYPES = ("email", "phone", "id_number", "address", "name")

# Seed entities.
SEED_GIVEN = frozenset(
    "peter anna tom john james mary emma grace oscar felix paul laura thomas david sarah maria lena greta jana silke moritz heike bernd "
    "klaus stefan jean claire sylvie luc pierre marie remi carmen elena lucia pablo jose juan ines ana нина марк павел иван ольга анна елена игорь роман мария".split()
)
SEED_STREETS = frozenset("street road lane avenue strasse weg rue avenue boulevard chemin calle avenida plaza улица ул проспект переулок".split())
TITLES = frozenset("mr mrs ms miss dr doctor prof herr frau le la el los docteur doctora dra m mme monsieur madame senor senora sr sra доктор др д врач".split())
SURE_TITLES = TITLES - {"la", "le", "el", "los", "m", "д", "miss"}
DIGIT_WORDS = frozenset(
    "zero oh one two three four five six seven eight nine null eins zwei zwo drei vier funf fuenf sechs sieben acht neun un deux trois quatre cinq sept huit neuf "
    "cero uno dos tres cuatro cinco seis siete ocho nueve ноль нуль один два три четыре пять шесть семь восемь девять double triple".split()
)
#: Number forms that are trusted from the start.
SEED_SHAPES = {
    "phone": re.compile(r"\+\d[\d ().\-/]{7,}$|00\d\d[ \-][\d \-]{7,}$|\(\d{3,4}\) ?\d{3}[\- ]\d{4}$|\(00\d\d\) ?\d{8,}$|\d{3}[.\-]\d{3}[.\-]\d{4}$"),
    "id_number": re.compile(r"\d{3}-\d\d-\d{4}$|[a-z]{2} \d\d \d\d \d\d [a-z]$|\d{2}\.?\d{3}\.?\d{3}-[a-z]$|\d{3}-\d{3}-\d{3} \d\d$|\d \d\d \d\d \d\d \d{3} \d{3} \d\d$|\d\d \d{6} [a-z] \d{3}$"),
}

EMAIL = re.compile(r"[a-z0-9][a-z0-9._%+\-]*(?: {0,2}@ {0,2}| {0,2}[(\[{<] ?at ?[)\]}>] {0,2}| at (?=[a-z0-9\-]+ dot ))[a-z0-9\-]+(?:(?: ?\. ?| {0,2}[(\[{<] ?(?:dot|punkt|punto|point) ?[)\]}>] {0,2}| dot )[a-z0-9\-]+)*(?:\.| dot | {0,2}[(\[{<] ?(?:dot|punkt|punto|point) ?[)\]}>] {0,2})[a-z]{2,}(?![\w@])")
NUMBER = re.compile(r"(?<![\w.,/\-])(?:[a-z]{2} \d\d \d\d \d\d [a-z](?!\w)|(?:\+ ?|\(\+?|[a-z]{1,4}-?)?\d[\da-z]*(?:(?:[ .\-/]|  | - |\) ?-?| ?\()\d[\da-z]*|[ \-][a-z](?=[ \-]\d)|-[a-z](?!\w))*)")
#: Five digits close to each other: without them a text has no long number.
_DIGITS = re.compile(r"\d(?:[^\w\n]{0,3}(?:[a-z]{1,4}[ \-]?)?\d){4}")
DATE = re.compile(r"\d{1,2}[./\-]\d{1,2}[./\-](?:\d\d|\d{4})$|\d{4}-\d\d?-\d\d?$")
_JOINERS = frozenset("de du des d la le les l del los las".split())
HOUSE = re.compile(r"\d{1,4}[a-f]?$")
SUFFIX = re.compile(r"[^\W\d_]{2,}?(strasse|str|weg|gasse|allee|platz|damm|ring|ufer|steig)$")
_WORD = re.compile(r"[^\W_]+")
_TOKEN = re.compile(r"[^\W_]+|[.!?;]")
_CAPS = regex.compile(r"(?<![\p{L}'’])(\p{Lu}\p{Ll}+\.?|\p{Lu}\.)(?: \p{Lu}\.)? (\p{Lu}\p{Ll}{2,}(?:-\p{Lu}\p{Ll}+)?)")

#: Confidence from which a context or instance counts; least distinct instances of a context.
TRUST, SUPPORT = 0.5, 2
#: Rounds of the iteration, and the confidence from which a context passes trust on within it.
ROUNDS, PASS_ON = 5, 0.15
#: Words in at least this share of the texts can't be part of a name by context alone.
COMMON = 0.004


class _Folds(dict):
    def __missing__(self, c: str) -> str:
        if c.isspace():
            got = " "
        elif unicodedata.category(c) in ("Cf", "Mn"):
            got = ""
        else:
            flat = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", c).lower())
            got = "".join("и" if x == "й" else "е" if x == "ё" else " " if x.isspace() else x for x in flat if unicodedata.category(x) not in ("Mn", "Cf")).replace("ß", "ss")
        self[c] = got
        return got


_FOLDS = _Folds()


def fold(text: str) -> str:
    """Folded text; see the module's docstring."""
    if text.isascii():
        return text.lower().replace("\n", " ").replace("\t", " ").replace("\r", " ")
    return "".join(map(_FOLDS.__getitem__, text))


def origins(text: str) -> list[int]:
    """For each character of the folded text, and its end, the offset in ``text``."""
    out: list[int] = []
    for i, c in enumerate(text):
        out.extend([i] * len(_FOLDS[c]))
    return [*out, len(text)]


def shape(span: str) -> str:
    return re.sub(r"[a-z]", "a", re.sub(r"\d", "0", re.sub(r" +", " ", span)))


class Tokens:
    """Words and sentence ends of a folded text with their places."""

    def __init__(self, s: str) -> None:
        self.s = s
        self.words: list[str] = _TOKEN.findall(s)
        self._starts: list[int] | None = None

    @property
    def starts(self) -> list[int]:
        if self._starts is None:
            at, find = 0, self.s.find
            out = self._starts = []
            for w in self.words:
                at = find(w, at)
                out.append(at)
                at += len(w)
        return self._starts

    def before(self, start: int) -> list[str]:
        """The last one to three words before a place, longest first; a sentence end counts as a word, a number as 0."""
        return self.contexts(bisect.bisect_left(self.starts, start))

    def contexts(self, i: int) -> list[str]:
        while i and (self.words[i - 1] in SURE_TITLES or (i > 1 and self.words[i - 1] == "." and self.words[i - 2] in SURE_TITLES)):
            i -= 1
        ws = ["|" if w in ".!?;" else "0" if w[0].isdigit() else w for w in self.words[max(0, i - 3) : i]]
        if i < 3:
            ws.insert(0, "|")
        return [" ".join(ws[k:]) for k in range(len(ws)) if ws[k:] != ["|"]]


def numbers(s: str) -> Iterator[tuple[int, int, str]]:
    """Spans of s that may be phone or identity numbers: at least seven digits and letters, no dates or decimals."""
    if not _DIGITS.search(s):
        return
    for m in NUMBER.finditer(s):
        span = m.group().rstrip(" (.-/")
        digits = sum(c.isdigit() for c in span)
        if digits < 5 or len(_WORD.findall(span)) > 9 or sum(c.isalnum() for c in span) < 7:
            continue
        if DATE.match(span):
            continue
        yield m.start(), m.start() + len(span), span


def spelled(s: str) -> Iterator[tuple[int, int]]:
    """Runs of at least six words that spell digits."""
    run: list[re.Match] = []
    for m in _WORD.finditer(s):
        if m.group() in DIGIT_WORDS:
            run.append(m)
            continue
        if len(run) >= 6:
            yield run[0].start(), run[-1].end()
        run = []
    if len(run) >= 6:
        yield run[0].start(), run[-1].end()


def last_words(ctx: dict[str, float]) -> frozenset:
    """Last words of the contexts of several words."""
    return frozenset(c.rsplit(" ", 1)[1] for c in ctx if " " in c)


def maybe_street(t: Tokens, kinds: dict[str, float], ctx: dict[str, float], ends: frozenset | None = None) -> bool:
    """Whether a number has a word of a known kind or a place after an address context near it; true wherever ``find`` may accept one.

    ``ends``: the contexts' last words, where known; a place after any other word has none of the contexts.
    """
    words = t.words
    ends = last_words(ctx) if ends is None else ends
    for i, w in enumerate(words):
        if not w[0].isdigit() or not HOUSE.match(w):
            continue
        if i and SUFFIX.match(words[i - 1]):
            return True
        for x in (*words[max(0, i - 5) : i], *words[i + 1 : i + 4]):
            if x in kinds or x in SEED_STREETS or x in ("gasse", "allee"):
                return True
        for k in range(max(1, i - 5), i + 1):
            before = words[k - 1]
            if before in ".!?;":
                before = "|"
            elif before[0].isdigit():
                before = "0"
            # titles are stepped over, so what is before them counts
            if before in ends or before == "|" or before in SURE_TITLES:
                if any(" " in c and c in ctx for c in t.contexts(k)):
                    return True
    return False


def streets(t: Tokens) -> Iterator[tuple[int, int, int, str]]:
    """(token, start, end, kind) of what may be a street with a house number; kind is the word that may name a street."""
    s, words = t.s, t.words
    if not any(w[0].isdigit() for w in words):
        return
    starts = t.starts
    for i, w in enumerate(words):
        if not w[0].isdigit() or not HOUSE.match(w) or (starts[i] and s[starts[i] - 1] in ":/.,+-(" ):
            continue
        end = starts[i] + len(w)
        if s[end : end + 1] in (":", "/", "%") or s[end : end + 2] in (",0", ".0") or (s[end : end + 1] in ",." and s[end + 1 : end + 2].isdigit()):
            continue
        if i + 1 < len(words) and len(words[i + 1]) == 1 and words[i + 1] in "abcdef" and s[end : end + 1] == " ":
            pass
        # words first: name and number, at most a comma between them
        if i and words[i - 1][0].isalpha() and s[starts[i - 1] + len(words[i - 1]) : starts[i]].strip() in ("", ","):
            m = SUFFIX.match(words[i - 1])
            if m:
                yield i - 1, starts[i - 1], end, "strasse" if m.group(1) == "str" else m.group(1)
            for k in range(1, 5):
                at = i - 1 - k
                if at < 0 or not words[at][0].isalpha() or s[starts[at] + len(words[at]) : starts[at + 1]].strip() not in ("", "/", "."):
                    break
                yield at, starts[at], end, words[at]
        # number first: English with the kind last, French with the kind first
        for k in range(1, 4 if i + 3 < len(words) and words[i + 3] in SEED_STREETS else 3):
            at = i + k
            if at >= len(words) or not words[at][0].isalpha():
                break
            gap = s[starts[at - 1] + len(words[at - 1]) : starts[at]].strip()
            if gap not in (("", ",", ".") if k == 1 else ("", ".", "'", "’")):
                break
            if k == 1 and len(words[at]) > 2 and at + 1 < len(words) and words[at + 1][0].isalpha():
                stop = at + 1
                while stop < min(at + 4, len(words) - 1) and words[stop] in _JOINERS and words[stop + 1][0].isalpha():
                    stop += 1
                yield i, starts[i], starts[stop] + len(words[stop]), words[at]
            elif gap == "" and len(words[at]) > 1:
                yield i, starts[i], starts[at] + len(words[at]), words[at]


def _edges_of(text: str, out: Counter, df: Counter) -> None:
    s = fold(text)
    t = Tokens(s)
    df.update(set(t.words))
    for a, _, span in numbers(s):
        k = shape(span)
        seed = span if SEED_SHAPES["phone"].match(span) or SEED_SHAPES["id_number"].match(span) else ""
        for c in t.before(a):
            out["n", c, k, seed] += 1
    kinds: dict[int, str] = {}
    for i, _, _, kind in streets(t):
        if kinds.get(i) not in SEED_STREETS:
            kinds[i] = kind
    for i, kind in kinds.items():
        for c in t.contexts(i)[:2]:
            out["a", c, kind, ""] += 1
    if not text.islower() and not text.isupper():
        at = origins(text) if len(s) != len(text) else None
        for m in _CAPS.finditer(text):
            given, last = fold(m.group(1)).strip("."), fold(m.group(2))
            start = bisect.bisect_left(at, m.start()) if at else m.start()
            if given in TITLES:
                start += len(given) + 1
            for c in t.before(start)[:2]:
                out["m", c, last if given in TITLES or len(given) == 1 else given, ""] += 1


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: Counter = Counter()
        df: Counter = Counter()
        for text, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text:
                _edges_of(text, out, df)
            # a body that is the text is the same evidence
            if body and body != text:
                _edges_of(body, out, df)
        agg: Counter = Counter()
        seeds: Counter = Counter()
        for (kind, c, k, span), n in out.items():
            agg[kind, c, k] += n
            if span:
                seeds[kind, c, k, "phone" if SEED_SHAPES["phone"].match(span) else "id_number"] += n
        rows = [(kind, c, k, n, seeds[kind, c, k, "phone"], seeds[kind, c, k, "id_number"]) for (kind, c, k), n in agg.items()]
        rows += [("w", "", w, n, 0, 0) for w, n in df.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string() if i < 3 else pa.int64()) for i in range(6)], names=["kind", "ctx", "inst", "n", "np", "ni"])


def _graph(edges: DataFrame) -> DataFrame:
    """(type, ctx, inst, n, seed): edges of each type's graph; seed is the trusted share of the edge's occurrences."""
    def seeded(kind: str, type_: str, seed) -> DataFrame:
        return edges.where(F.col("kind") == kind).select(F.lit(type_).alias("type"), "ctx", "inst", "n", seed.cast("double").alias("seed"))

    return (
        seeded("n", "phone", F.col("np") / F.col("n"))
        .unionByName(seeded("n", "id_number", F.col("ni") / F.col("n")))
        .unionByName(seeded("a", "address", F.col("inst").isin(*SEED_STREETS)))
        .unionByName(seeded("m", "name", F.col("inst").isin(*SEED_GIVEN)))
    )


def score(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scored contexts (type, ctx, conf, support) and instances (type, inst, score, n) after ROUNDS of the iteration."""
    graph = stage(_graph(edges), "graph")
    insts = graph.groupBy("type", "inst").agg((F.sum(F.col("n") * F.col("seed")) / F.sum("n")).alias("seed"), F.sum("n").alias("total"))
    insts = stage(insts.withColumn("score", F.col("seed")), "insts0")
    for k in range(ROUNDS):
        at = graph.join(insts.select("type", "inst", "score"), ["type", "inst"])
        ctx = at.groupBy("type", "ctx").agg((F.sum(F.col("n") * F.col("score")) / (F.sum("n") + 1.0)).alias("conf"), F.count_if(F.col("score") > 0.1).alias("support"), F.sum("n").alias("n"))
        ctx = stage(ctx, f"ctx{k}")
        back = graph.withColumn("two", (F.size(F.split("ctx", " ")) == 2).cast("double")).join(ctx.select("type", "ctx", "conf"), ["type", "ctx"]).groupBy("type", "inst").agg(F.max("conf").alias("best"), (F.sum(F.col("n") * F.col("conf") * F.col("two")) / F.greatest(F.lit(1.0), F.sum(F.col("n") * F.col("two")))).alias("mean"))
        new = back.join(insts.select("type", "inst", "seed", "total"), ["type", "inst"])
        # an instance is as good as the mean of its two-word contexts, one for each occurrence; number forms can't be
        # phone and identity numbers alike, so both types share the trust in a form
        rivals = Window.partitionBy(F.when(F.col("type").isin("phone", "id_number"), "number").otherwise(F.col("type")), "inst")
        m2 = F.col("mean") * F.col("mean")
        shared = F.least(F.lit(1.0), 1.5 * F.sum("mean").over(rivals)) * m2 / F.greatest(F.lit(1e-9), F.sum(m2).over(rivals))
        other = F.sum("seed").over(rivals) - F.col("seed")
        grown = F.when(F.col("best") >= PASS_ON, shared).otherwise(0.0)
        insts = stage(new.select("type", "inst", "seed", "total", F.when(F.col("seed") > 0.5, F.col("seed")).when(other > 0.5, 0.0).otherwise(F.greatest("seed", grown)).alias("score")), f"insts{k + 1}")
    return ctx, insts


class Model:
    """Trusted contexts and instances; a plain object that goes to the workers."""

    def __init__(self, ctx: dict[str, dict[str, float]], inst: dict[str, dict[str, float]], common: set[str]) -> None:
        self.ctx, self.inst, self.common = ctx, inst, common
        self._ac = None
        self.street_ends = last_words(ctx["address"])

    def name_contexts(self) -> ahocorasick.Automaton:
        if self._ac is None:
            self._ac = ahocorasick.Automaton()
            for c in self.ctx["name"]:
                key = " " + c.replace("| ", "").strip() + " "
                if "|" not in key and (" " in key.strip() or key.strip() not in self.common):
                    self._ac.add_word(key, (key, c.startswith("|") or len(c.split()) == 1))
            self._ac.make_automaton()
        return self._ac

    def __getstate__(self):
        return {"ctx": self.ctx, "inst": self.inst, "common": self.common, "street_ends": self.street_ends, "_ac": None}


#: Trusted contexts and instances (about 100 bytes each) that may be sent to all workers; beyond, texts meet their own in a shuffle.
SENT = 200_000


def trusted(df: DataFrame, text: str = "text", body: str | None = "body") -> tuple[DataFrame, set[str]]:
    """(key, type, score) of all trusted contexts (``c:``) and instances (``i:``) of the texts of ``df``; and the common words."""
    cols = [F.col(text).alias("a"), (F.col(body) if body else F.lit(None).cast("string")).alias("b")]
    raw = spread(df.select(*cols)).mapInArrow(_edges, "kind string, ctx string, inst string, n bigint, np bigint, ni bigint")
    edges = stage(raw.groupBy("kind", "ctx", "inst").agg(F.sum("n").alias("n"), F.sum("np").alias("np"), F.sum("ni").alias("ni")), "edges")
    ctx, insts = score(edges.where("kind <> 'w'"))
    best_ctx = ctx.where((F.col("conf") >= TRUST) & (F.col("support") >= SUPPORT)).select(F.concat(F.lit("c:"), "ctx").alias("key"), "type", F.col("conf").alias("score"))
    best_inst = insts.where((F.col("score") >= TRUST) & (F.col("total") >= 2)).select(F.concat(F.lit("i:"), "inst").alias("key"), "type", "score")
    table = stage(best_ctx.unionByName(best_inst), "trusted")
    counted = F.count_if(F.length("a") > 0) + F.count_if((F.length("b") > 0) & ~F.col("b").eqNullSafe(F.col("a")))
    total = df.select(*cols).select(counted).first()[0]
    # at most (mean words of a text / COMMON) words reach that share, and names among them don't count
    frequent = edges.where((F.col("kind") == "w") & (F.col("n") >= max(5.0, COMMON * total))).select("inst")
    given = table.where("type = 'name' and key like 'i:%'").select(F.substring("key", 3, 1 << 20).alias("inst"))
    return table, {r["inst"] for r in frequent.join(given, "inst", "left_anti").collect()} - SEED_GIVEN


def model_of(rows: Iterator[tuple[str, str, float]], common: set[str]) -> Model:
    """A model of (key, type, score) rows."""
    ctx: dict[str, dict[str, float]] = {t: {} for t in TYPES}
    inst: dict[str, dict[str, float]] = {t: {} for t in TYPES}
    for key, kind, value in rows:
        (ctx if key.startswith("c:") else inst)[kind][key[2:]] = value
    return Model(ctx, inst, common)


def fit(df: DataFrame, text: str = "text", body: str | None = "body") -> Model:
    """The model of all texts of ``df`` on the driver; for ``df`` of any size see ``trusted``."""
    table, common = trusted(df, text, body)
    return model_of(map(tuple, table.collect()), common)


def keys_of(text: str) -> set[str]:
    """All keys of the trusted table that ``find`` may ask for in a text."""
    s = fold(text)
    t = Tokens(s)
    out = {f"c:{c}" for i in range(len(t.words) + 1) for c in t.contexts(i)}
    ws = [w for w in t.words if w not in ".!?;"]
    for n in (1, 2, 3):
        for i in range(len(ws) - n + 1):
            gram = " ".join(ws[i : i + n])
            out |= {f"c:{gram}", f"c:| {gram}"}
    out |= {f"i:{w}" for w in t.words} | {f"i:{shape(span)}" for _, _, span in numbers(s)}
    # parts of names, and streets whose kind is the end of a word
    out |= {f"i:{m.group(1).strip('.')}" for m in _NAME_TOKEN.finditer(s)}
    return out | {f"i:{'strasse' if m.group(1) == 'str' else m.group(1)}" for w in t.words if (m := SUFFIX.match(w))}


def _row_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, 200):
            batch = whole.slice(start, 200)
            ids, keys = [], []
            for row, text, body in zip(*(batch.column(k).to_pylist() for k in range(3))):
                its = (keys_of(text) if text else set()) | (keys_of(body) if body and body != text else set())
                ids += [row] * len(its)
                keys += its
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.string())], names=["row_id", "key"])


def _applied(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work`` over all rows with the trusted table: sent whole where it is small, else joined to each row by its own keys."""
    table, common = trusted(df)
    rows = _both(df)
    if table.count() <= SENT:
        model = model_of(map(tuple, table.collect()), common)
        return rows.mapInArrow(work(lambda held: model), schema)
    met = rows.mapInArrow(_row_keys, "row_id bigint, key string").distinct().join(table, "key")
    held = stage(met.groupBy(F.col("row_id").alias("__r")).agg(F.collect_list(F.struct("key", "type", "score")).alias("held")), "held")
    every = rows.join(held, rows["row_id"].eqNullSafe(held["__r"]), "left").select("row_id", "text", "body", "held")
    return every.mapInArrow(work(lambda its: model_of(((x["key"], x["type"], x["score"]) for x in its or ()), common)), schema)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(row_id, text, body, held) of a batch; held is None where the model was sent."""
    cols = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
    return zip(*cols, *([[None] * batch.num_rows] if len(cols) == 3 else []))


_NAME_TOKEN = re.compile(r"[ ,.:\"'*_>|\-–—]*?([^\W\d_]+(?:-[^\W\d_]+)?\.?)")


def _name_at(s: str, at: int, model: Model) -> tuple[int, int] | None:
    """A name that starts at ``at``: up to three words after titles, none of them a common word."""
    got: list[re.Match] = []
    pos, titled = at, False
    while len(got) < 4:
        m = _NAME_TOKEN.match(s, pos)
        if not m:
            break
        w = m.group(1).strip(".")
        gap = s[pos : m.start(1)]
        if not got and w in TITLES and (w not in ("m", "д") or m.group(1).endswith(".")):
            titled = True
            pos = m.end()
            continue
        if got and re.search(r"[,.:\n|]", gap):
            break
        if got and got[-1].group(1).endswith(".") and len(got[-1].group(1)) > 2:
            break
        if len(w) > 1 and (w in model.common or got and w in TITLES):
            break
        got.append(m)
        pos = m.end()
    while got and len(got[-1].group(1).strip(".")) < 2:
        got.pop()
    known = any(m.group(1).strip(".") in model.inst["name"] or m.group(1).strip(".") in SEED_GIVEN for m in got)
    if not got or max(len(m.group(1).strip(".")) for m in got) < 3:
        return None
    if len(got) == 1 and not (titled or known):
        return None
    return got[0].start(1), got[-1].end(1) - got[-1].group(1).endswith(".")


def find(text: str, model: Model) -> list[tuple[int, int, str]]:
    """(start, end, type) in the folded text, by start; spans don't overlap."""
    s = fold(text)
    out: list[tuple[int, int, str]] = []

    def free(a: int, b: int) -> bool:
        return all(b <= x or a >= y for x, y, _ in out)

    if "@" in s or "at" in s:
        if "@" in s or re.search(r"[(\[{<] ?at ?[)\]}>]| at [a-z0-9\-]+ dot ", s):
            out += [(m.start(), m.end(), "email") for m in EMAIL.finditer(s)]
    t = Tokens(s)
    for a, b, span in numbers(s):
        if not free(a, b):
            continue
        best = None
        for c in t.before(a):
            scores = {k: model.ctx[k].get(c, 0) for k in ("phone", "id_number")}
            k = max(scores, key=scores.get)
            if scores[k] >= TRUST:
                best = k
                break
        if best is None:
            form = shape(span)
            scores = {k: 1.0 if SEED_SHAPES[k].match(span) else model.inst[k].get(form, 0) for k in ("phone", "id_number")}
            k = max(scores, key=scores.get)
            best = k if scores[k] >= 0.7 else None
        if best:
            out.append((a, b, best))
    spans: list[tuple[bool, int, int]] = []
    for i, a, b, kind in streets(t) if maybe_street(t, model.inst["address"], model.ctx["address"], model.street_ends) else ():
        sure = kind in SEED_STREETS or kind in ("gasse", "allee")
        known = sure or (kind not in model.common and model.inst["address"].get(kind, 0) >= TRUST)
        by = any(len(c.split()) > 1 and c in model.ctx["address"] for c in t.contexts(i))
        if known or by:
            spans.append((not sure, a, b))
    for _, a, b in sorted(spans, key=lambda x: (x[0], x[1] - x[2])):
        if free(a, b):
            out.append((a, b, "address"))
    if sum(map(DIGIT_WORDS.__contains__, t.words)) >= 6:
        for a, b in spelled(s):
            if free(a, b):
                near = t.before(a)
                as_id = any(c in model.ctx["id_number"] for c in near) and not any(c in model.ctx["phone"] for c in near)
                out.append((a, b, "id_number" if as_id else "phone"))
    words = [w for w in t.words if w not in ".!?;"]
    line = " " + " ".join(words) + " "
    hits = [(end, key) for end, (key, _) in model.name_contexts().iter(line)] if len(model.name_contexts()) else []
    if hits:
        ends = [a + len(w) for a, w in zip(t.starts, t.words) if w not in ".!?;"]
        at_word = {}
        pos = 0
        for i, w in enumerate(words):
            pos += len(w) + 1
            at_word[pos] = i
        for end, _ in hits:
            i = at_word.get(end)
            if i is None:
                continue
            name = _name_at(s, ends[i], model)
            if name and free(*name):
                out.append((*name, "name"))
    return sorted(out)


def _finder(model_for: Callable[[list | None], Model]):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row, text, body, held in _rows(batch):
                model = model_for(held)
                types = {t for _, _, t in find(text, model)} if text else set()
                out += [(row, "text", t) for t in sorted(types)]
                if body:
                    types = types if body == text else {t for _, _, t in find(body, model)}
                    out += [(row, "body", t) for t in sorted(types)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.string()), pa.array([r[2] for r in out], pa.string())], names=["row_id", "field", "pii_type"])

    return go


def _both(df: DataFrame) -> DataFrame:
    return spread(df.select(F.col("row_id").cast("bigint").alias("row_id"), "text", "body"))


def found(df: DataFrame) -> DataFrame:
    """(row_id, field, pii_type): each type found at least once in a field."""
    return _applied(df, _finder, "row_id bigint, field string, pii_type string")


def redact(text: str | None, model: Model) -> str | None:
    """The text with typed placeholders; null stays null."""
    if not text:
        return text
    spans = find(text, model)
    if not spans:
        return text
    at = origins(text)
    out, pos = [], 0
    for a, b, t in spans:
        out += [text[pos : at[a]], f"[{t.upper()}]"]
        pos = at[b - 1] + 1
    return "".join([*out, text[pos:]])


def _redactor(model_for: Callable[[list | None], Model]):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, bodies = [], []
            for _, text, body, held in _rows(batch):
                model = model_for(held)
                texts.append(redact(text, model))
                bodies.append(redact(body, model))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(bodies, pa.string())], names=["row_id", "text", "body"])

    return go


def redacted(df: DataFrame) -> DataFrame:
    """(row_id, text, body) with placeholders for what was found."""
    return _applied(df, _redactor, "row_id bigint, text string, body string")
