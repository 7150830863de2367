"""Languages of texts and of their segments by rank-order n-gram profiles.

A language's profile is the list of its PROFILE most frequent n-grams (two and three characters of blank-padded words,
and short words whole), in order. A segment's n-grams, most frequent first, are compared to each profile: an n-gram costs the
difference of its ranks, one that the profile lacks costs PROFILE. The language with the least mean cost wins; the
confidence is 1 - cost / next cost, carried to 0..1.

Profiles are trained here, on all records whose source declares the language. As some declarations are wrong, profiles
are made again from all sentences that the first profiles give to the language. A language that no source declares
starts from the sentences of all records that are full of its seed words. A segment farther from its language than all
but one in ODD of that language's own sentences comes out as ``und`` with confidence 0. All counts are whole numbers over
all records, so profiles and limits depend neither on partitions nor on a choice of records.

A text is cut into sentences and lines; each gets its distances, and one pass over them chooses the cheapest path that
pays for every change of language, so single odd words don't make a language but a whole sentence does. Null and blank
texts have no language; a sentence without letters takes that of its neighbours; very long texts are read whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.plans.staging import spread, stage

#: Ranks of a profile.
PROFILE = 1500
#: Least letters and words of a sentence that may bring in a language of its own.
LETTERS, WORDS = 12, 3
#: Least sentences that make a profile of an undeclared language; of so many own sentences one may lie beyond a language's limit.
ENOUGH, ODD = 40, 20_000
#: Steps of distance that limits are counted in; sentences and words that a task remembers.
STEPS, MEMO, HELD = 10_000, 50_000, 300_000
#: Words whose grams a task remembers, and segments that are measured at once.
WORDS_HELD, AT_ONCE = 100_000, 256
#: Least share of seed words in such a sentence, and how far beyond its language's own sentences an unknown one lies.
SEED_SHARE, BEYOND = 0.25, 1.12
#: Least letters of a segment that may come out as of no known language.
UNKNOWN_LETTERS = 60
#: Cost of a change of language, in letters x share of PROFILE; sentences without ends are cut into pieces of so many words.
CHANGE, PIECE = 2.2, 14
_TOKEN = re.compile(r"[^\W\d_]+")
# each begins with a set of characters or tries a run of characters only where it begins, so that a search skips all else
_CUT = re.compile(r"[.!?…\n|](?:(?<=[.!?…])[\"'»”)]*\s+|(?<=\n)\s*\n|(?<=\|)(?:\n\s*\n|\s+))")
_NOT_WORDS = re.compile(r"(?:(?<![^\s@])[^\s@]++)?@[^\s@]+|https?://\S+|(?<![^\W_])[^\W_][\w\-]*+(?:\.[\w\-]{2,})+")
_DOTTED = re.compile(r"\.(?<=[a-z0-9\-]\.)[a-z]{2}")
_MARK, _LABEL = re.compile(r"[©|·»›]"), re.compile(r"[^.!?]{0,30}:(?!.{40})")
_END = re.compile(r"[.!?…][\"'»”)]*\s*$")
_BLANKED = bytes(c if chr(c).isalpha() else 32 for c in range(128)) + bytes(128)

# Names of languages in English and in the language itself, and their codes.
NAMES = {
    "en": "en eng english anglais englisch ingles inglés английский",
    "de": "de deu ger german deutsch allemand aleman alemán немецкий",
    "fr": "fr fra fre french francais français franzosisch französisch frances francés французский",
    "es": "es spa spanish espanol español castellano spanisch espagnol испанский",
    "ru": "ru rus russian russisch russe ruso русский русскии",
    "it": "it ita italian italiano italienisch italien итальянский",
    "pt": "pt por portuguese portugues português португальский",
    "nl": "nl nld dut dutch nederlands нидерландский",
    "pl": "pl pol polish polski польский",
    "uk": "uk ukr ukrainian українська украинский",
    "tr": "tr tur turkish turkce türkçe турецкий",
    "zh": "zh zho chi chinese 中文 китайский",
    "ja": "ja jpn japanese 日本語 японский",
    "ar": "ar ara arabic العربية арабский",
}


# Frequent words that tell a language from its neighbours, folded; they start profiles of undeclared languages.
SEED_WORDS = {
    "en": "the and of to is was with that this have from not",
    "de": "der die und das ist nicht mit ein ich auf den wird",
    "fr": "le les et des est une dans je pas que pour avec",
    "es": "el los y las del una por con que es no se",
    "ru": "и в не на что я с как это но по из",
    "it": "il di che non per sono gli della una ho anche piu",
    "pt": "o nao uma com os do da em para mais eu voce",
    "nl": "het een van en ik niet dat met zijn voor ook maar",
    "pl": "nie sie jest na ze jak ale mam co przez juz od",
    "uk": "і не що на я та як це але від є про",
    "tr": "ve bir bu icin cok da ne ile var gibi daha olarak",
    "ar": "في من على ان الى عن هذا لا ما مع التي هو",
}


def declared(column: Column) -> Column:
    """The two-letter code meant by a free language entry: a code, a code with a region, or a name; else null."""
    flat = F.lower(F.trim(column))
    first = F.regexp_extract(flat, r"^([\p{L}]+)", 1)
    out = F.lit(None).cast("string")
    for code, names in NAMES.items():
        out = F.when(first.isin(*names.split()), code).otherwise(out)
    return out


class _Folds(dict):
    def __missing__(self, c: str) -> str:
        got = "".join(x for x in unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", c).lower()) if unicodedata.category(x) not in ("Mn", "Cf")) or ("" if unicodedata.category(c) in ("Mn", "Cf") else c)
        self[c] = got = got.replace("ß", "ss")
        return got


_FOLDS = _Folds()
_NOT_ASCII = re.compile(r"[^\x00-\x7f]+")


class _Runs(dict):
    def __missing__(self, run: str) -> str:
        if len(self) > MEMO:
            self.clear()
        self[run] = got = "".join(map(_FOLDS.__getitem__, run))
        return got


_RUNS = _Runs()


def _folded(found: re.Match) -> str:
    return _RUNS[found[0]]


def flat(text: str) -> str:
    """Lower case without accents, format characters, addresses and host names."""
    s = text.lower() if text.isascii() else _NOT_ASCII.sub(_folded, text).lower()
    return _NOT_WORDS.sub(" ", s) if "@" in s or "://" in s or _DOTTED.search(s) else s


def tokens(part: str) -> list[str]:
    """The runs of letters of a sentence."""
    return part.encode().translate(_BLANKED).decode().split() if part.isascii() else _TOKEN.findall(part)


def _blocks(text: str) -> Iterator[str]:
    """A text cut after the marks that _CUT finds, without what follows them."""
    at = 0
    for found in _CUT.finditer(text):
        cut = found.start()
        yield text[at : cut if text[cut] == "\n" else cut + 1]
        at = found.end()
    yield text[at:]


def grams(word: str) -> list[str]:
    """The n-grams of a word."""
    p = f" {word} "
    out = [p[i : i + n] for n in (2, 3) for i in range(len(p) - n + 1)]
    return out if len(word) > 6 else [*out, f"{p}*"]


def sentences(text: str) -> list[str]:
    """Sentences of a flat text, without blank ones. A line without a sentence end stays one if it is short, joins the
    next if that goes on in lower case, and is cut into pieces of PIECE words if it is long."""
    out = []
    for block in _blocks(text):
        if not block or not block.strip():
            continue
        lines = block.split("\n") if "\n" in block else [block]
        if len(lines) > 1 and max(map(len, lines)) > 60:
            lines = _unwrapped(lines)
        for line in lines:
            if len(line) > 220:
                ws = line.split()
                if len(ws) > PIECE * 3:
                    out += [" ".join(ws[k : k + PIECE]) for k in range(0, len(ws), PIECE)]
                    continue
            if line.strip():
                out.append(line)
    return out


def _unwrapped(lines: list[str]) -> list[str]:
    """Lines joined where one of more than half the longest's length has no end."""
    width = max(map(len, lines)) * 0.6
    out = [lines[0]]
    for prev, line in zip(lines, lines[1:]):
        if len(prev) >= width and not _END.search(prev):
            out[-1] += " " + line
        else:
            out.append(line)
    return out


class Profiles:
    """Rank tables of all languages over one gram dictionary, with a memo of words."""

    def __init__(self, ranked: dict[str, list[str]], limits: dict[str, float] | None = None) -> None:
        self.ranked = ranked
        #: Distance beyond which a segment isn't in the language.
        self.limits = limits or {}
        self._ready()

    def _ready(self) -> None:
        self.langs = sorted(self.ranked)
        every = sorted({g for r in self.ranked.values() for g in r})
        self.ids = {g: i for i, g in enumerate(every)}
        # doubled, as grams of equal counts have halves of ranks; the last column stands for grams that no profile has
        self.rank = np.full((len(self.langs), len(every) + 1), 1 << 29, np.int32)
        for k, lang in enumerate(self.langs):
            self.rank[k, [self.ids[g] for g in self.ranked[lang]]] = np.arange(0, 2 * len(self.ranked[lang]), 2)
        self.forget()

    def __getstate__(self):
        return {"ranked": self.ranked, "limits": self.limits}

    def __setstate__(self, state):
        self.ranked, self.limits = state["ranked"], state["limits"]
        self._ready()

    def forget(self) -> None:
        #: Places of words; the grams of the word at k are gram[start[k] : start[k + 1]].
        self.words: dict[str, int] = {}
        self.gram, self.start = np.empty(0, np.int32), np.zeros(1, np.int64)

    def placed(self, segments: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The places of all words of segments, good until words are forgotten, and where each segment's begin and the last's end."""
        if len(self.words) > WORDS_HELD:
            self.forget()
        every = [w for seg in segments for w in seg]
        known, none = self.words, len(self.ids)
        new = [w for w in dict.fromkeys(every) if w not in known]
        if new:
            its = [[self.ids.get(g, none) for g in grams(w)] for w in new]
            known.update(zip(new, range(len(known), len(known) + len(new))))
            self.gram = np.concatenate([self.gram, np.array([g for gs in its for g in gs], np.int32)])
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum([len(gs) for gs in its])])
        return np.fromiter(map(known.__getitem__, every), np.int64, len(every)), np.concatenate([[0], np.cumsum([len(seg) for seg in segments], dtype=np.int64)])

    def distances(self, segments: list[list[str]], placed: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Mean out-of-place distances, in shares of PROFILE, of segments (lists of words) to each language; and the segments' grams."""
        n = len(segments)
        places, ends = placed or self.placed(segments)
        out, total = np.ones((n, len(self.langs))), np.zeros(n)
        # few enough segments at a time that their grams stay in a core's cache
        for i in range(0, n, AT_ONCE):
            j = min(n, i + AT_ONCE)
            own = places[ends[i] : ends[j]]
            if len(own):
                self._measure(own, np.diff(ends[i : j + 1]), out[i:j], total[i:j])
        return out, total

    def _measure(self, places: np.ndarray, words: np.ndarray, out: np.ndarray, total: np.ndarray) -> None:
        """Fills ``out`` and ``total`` for segments of so many words each."""
        start = self.start[places]
        lens = self.start[places + 1] - start
        upto = np.cumsum(lens)
        of = self.gram[np.arange(upto[-1]) + np.repeat(start - upto + lens, lens)]
        bits = len(self.ids).bit_length()
        key = np.repeat(np.repeat(np.arange(len(words), dtype=np.int64 if bits > 30 - AT_ONCE.bit_length() else np.int32) << bits, words), lens) | of
        key.sort()
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.append(first, len(key)))
        seg, gram = key[first] >> bits, key[first] & ((1 << bits) - 1)
        # a gram's rank is the number of its segment's grams of larger counts; grams of equal counts share the middle rank
        values = None if count.max() < 64 else np.unique(count)
        level = count if values is None else np.searchsorted(values, count)
        width = int(level.max()) + 1
        cell = seg.astype(np.int64) * width + level
        alike = np.bincount(cell, minlength=len(words) * width).reshape(-1, width)
        larger = alike[:, ::-1].cumsum(1)[:, ::-1] - alike
        mid = (2 * larger + alike - 1).astype(np.int32).ravel()[cell]
        begin = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
        its = seg[begin]
        total[its] = grams = np.add.reduceat(count, begin)
        for k in range(len(self.langs)):
            d = self.rank[k].take(gram)
            d -= mid
            np.abs(d, out=d)
            np.minimum(d, 2 * PROFILE, out=d)
            out[its, k] = np.add.reduceat(d * count, begin) / 2 / grams / PROFILE


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of (lang, word, n)."""
    for batch in batches:
        by: dict[str, Counter] = {}
        for lang, w, n in zip(*(batch.column(k).to_pylist() for k in range(3))):
            c = by.setdefault(lang, Counter())
            for g in grams(w):
                c[g] += n
        rows = [(lang, g, n) for lang, c in by.items() for g, n in c.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], names=["lang", "gram", "n"])


def _ranked(words: DataFrame) -> dict[str, list[str]]:
    """Each language's grams by (lang, word, n), most frequent first."""
    out: dict[str, list[str]] = {}
    from pyspark.sql import Window

    counts = words.groupBy("lang", "word").agg(F.sum("n").alias("n")).mapInArrow(_count, "lang string, gram string, n bigint")
    at = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumn("rank", at).where(F.col("rank") <= PROFILE)
    for r in sorted(top.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


class _Measured:
    """Distances, letters and wholeness of sentences through a memo, as sentences come again and again."""

    def __init__(self, profiles: Profiles) -> None:
        self.profiles = profiles
        self.at: dict[str, int] = {}
        self.d, self.letters, self.whole = np.empty((0, len(profiles.langs))), np.empty(0), np.empty(0, bool)

    def __call__(self, parts: list[str]) -> np.ndarray:
        """The sentences' places in ``d``, ``letters`` and ``whole``, good until the next call."""
        if len(self.at) > MEMO:
            self.__init__(self.profiles)
        at = self.at
        new = [p for p in dict.fromkeys(parts) if p not in at]
        if new:
            cut = [tokens(p) for p in new]
            letters = [sum(map(len, ws)) for ws in cut]
            for p in new:
                at[p] = len(at)
            self.d = np.concatenate([self.d, self.profiles.distances(cut)[0]])
            self.letters = np.concatenate([self.letters, np.array(letters, float)])
            self.whole = np.concatenate([self.whole, np.array([_is_whole(p, n, len(ws)) for p, n, ws in zip(new, letters, cut)], bool)])
        return np.fromiter(map(at.__getitem__, parts), np.int64, len(parts))


def _is_whole(part: str, letters: int, words: int) -> bool:
    return bool(letters >= LETTERS and words >= WORDS and (letters >= 30 or _END.search(part)) and not _MARK.search(part) and not _LABEL.match(part))


READ = "row_id bigint, declared string, parts array<string>, own string, lang string, word string, n bigint"


def _reader(known: frozenset):
    """Each text's sentences, and in rows of their own the word counts that first profiles come from.

    ``own`` is 'd' for the words of texts by their declared language, and 's' for those of the sentences of a language outside
    ``known`` in which its seed words have a large share, more than any other's; the null word counts these sentences.
    """
    of: dict[str, list[str]] = {}
    for lang, ws in SEED_WORDS.items():
        for w in ws.split():
            of.setdefault(w, []).append(lang)
    may = {w for w, langs in of.items() if not known.issuperset(langs)}.__contains__

    def seeded(ws: list[str]) -> str | None:
        if len(ws) < 5 or sum(map(may, ws)) < SEED_SHARE * len(ws):
            return None
        n = Counter(lang for w in ws if w in of for lang in of[w]).most_common(2)
        full = n and n[0][0] not in known and n[0][1] >= SEED_SHARE * len(ws) and (len(n) == 1 or n[0][1] > 1.5 * n[1][1])
        return n[0][0] if full else None

    def batch_of(texts: list[tuple], counts: dict) -> pa.RecordBatch:
        words = [(own, lang, w, n) for (own, lang), c in counts.items() for w, n in c.items()]
        none, blank = [None] * len(texts), [None] * len(words)
        cols = [[t[0] for t in texts] + blank, [t[1] for t in texts] + blank, [t[2] for t in texts] + blank, *(none + [r[k] for r in words] for k in range(4))]
        types = [pa.int64(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[x.split()[0] for x in READ.split(", ")])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, Counter] = {}
        memo: dict[str, tuple] = {}
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                texts, said = [], {}
                for row, text, lang in zip(*(whole.slice(start, 500).column(k).to_pylist() for k in range(3))):
                    parts = sentences(flat(text)) if text else []
                    if not parts:
                        continue
                    texts.append((row, lang, parts))
                    declared = said.setdefault(lang, []) if lang is not None else None
                    for p in parts:
                        got = memo.get(p)
                        if got is None:
                            if len(memo) > MEMO:
                                memo.clear()
                            ws = tokens(p)
                            got = memo[p] = (ws, seeded(ws))
                        if declared is not None:
                            declared += got[0]
                        if got[1]:
                            c = counts.setdefault(("s", got[1]), Counter())
                            c.update(got[0])
                            c[None] += 1
                for lang, ws in said.items():
                    counts.setdefault(("d", lang), Counter()).update(ws)
                full = sum(map(len, counts.values())) > HELD
                yield batch_of(texts, counts if full else {})
                if full:
                    counts = {}
        yield batch_of([], counts)

    return go


OWN = "lang string, word string, step int, n bigint"


def _own_words(profiles: Profiles):
    """Word counts of the sentences that clearly belong to a language, and counts of their distances in STEPS (word null)."""

    langs = profiles.langs

    def batch_of(words: np.ndarray, steps: np.ndarray) -> pa.RecordBatch:
        names = list(profiles.words)
        at, far = np.flatnonzero(words), np.flatnonzero(steps)
        lang = [langs[k] for k in (at % len(langs)).tolist() + (far // (STEPS + 1)).tolist()]
        said = [names[k] for k in (at // len(langs)).tolist()] + [None] * len(far)
        cols = lang, said, [None] * len(at) + (far % (STEPS + 1)).tolist(), np.concatenate([words[at], steps[far]])
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int32(), pa.int64()))], names=[x.split()[0] for x in OWN.split(", ")])

    def none() -> tuple[np.ndarray, np.ndarray]:
        return np.zeros(0, np.int64), np.zeros(len(langs) * (STEPS + 1), np.int64)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # counts by place of the word and language, and by language and step
        words, steps = none()
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                if len(profiles.words) > WORDS_HELD:
                    yield batch_of(words, steps)
                    words, steps = none()
                    profiles.forget()
                # equal sentences are measured once and count as often as they occur
                times = Counter(p for parts in whole.slice(start, 2000).column(0).to_pylist() for p in parts if len(p) > 30)
                if not times:
                    continue
                cut = [tokens(p) for p in times]
                places, ends = profiles.placed(cut)
                d, _ = profiles.distances(cut, (places, ends))
                two = np.sort(d, axis=1)[:, :2]
                clear = two[:, 1] - two[:, 0] > 0.05 if d.shape[1] > 1 else np.ones(len(cut), bool)
                n = np.where(clear, np.fromiter(times.values(), np.int64, len(cut)), 0)
                nearest, far = d.argmin(1), np.ceil(two[:, 0] * STEPS).astype(np.int64)
                np.add.at(steps, nearest * (STEPS + 1) + far, n)
                words = np.concatenate([words, np.zeros(len(profiles.words) * len(langs) - len(words), np.int64)])
                per = np.diff(ends)
                np.add.at(words, places * len(langs) + np.repeat(nearest, per), np.repeat(n, per))
        yield batch_of(words, steps)

    return go


def _limits(steps: DataFrame) -> dict[str, float]:
    """BEYOND times the distance that one in ODD of a language's own sentences exceeds, the farthest where they are fewer."""
    by: dict[str, list] = {}
    for r in steps.groupBy("lang", "step").agg(F.sum("n").alias("n")).collect():  # at most STEPS rows a language
        by.setdefault(r["lang"], []).append((r["step"], r["n"]))
    out = {}
    for lang, got in by.items():
        above = sum(n for _, n in got) // ODD
        for step, n in sorted(got, reverse=True):
            above -= n
            if above < 0:
                out[lang] = BEYOND * step / STEPS
                break
    return out


def read(rows: DataFrame) -> DataFrame:
    """The staged sentences and word counts of (row_id, text, declared)."""
    known = {r[0] for r in rows.where(F.length(F.trim("text")) > 0).select("declared").distinct().collect()}  # languages of NAMES
    return stage(spread(rows.select("row_id", "text", "declared")).mapInArrow(_reader(frozenset(known - {None})), READ), "read")


def train(rows: DataFrame) -> Profiles:
    """Profiles from (row_id, text, declared), by all records of each declared language.

    Languages of SEED_WORDS that no source declares get a profile where all records together hold ENOUGH sentences
    in which their seed words prevail. Limits of distance come from the languages' own sentences.
    """
    return fitted(read(rows))


def fitted(got: DataFrame) -> Profiles:
    """Profiles from the tables that ``read`` staged."""
    first = _ranked(got.where("own = 'd' and word is not null").select("lang", "word", "n"))
    seeds = got.where("own = 's'").groupBy("lang").agg(F.sum(F.when(F.col("word").isNull(), F.col("n"))).alias("n")).collect()
    enough = [r["lang"] for r in seeds if r["n"] >= ENOUGH]  # languages of SEED_WORDS
    texts = got.where("parts is not null")
    if enough:
        first |= _ranked(got.where(F.col("lang").isin(enough) & (F.col("own") == "s") & F.col("word").isNotNull()).select("lang", "word", "n"))
    else:
        texts = texts.where("declared is not null")
    if not first:
        return Profiles({"en": []})
    own = stage(texts.select("parts").mapInArrow(_own_words(Profiles(first)), OWN), "own")
    again = _ranked(own.where("word is not null").select("lang", "word", "n"))
    return Profiles({lang: again.get(lang, r) for lang, r in first.items()}, _limits(own.where("step is not null")))


def path(d: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The cheapest language of each sentence when a change of language costs CHANGE."""
    best = d.argmin(1)
    if (best == best[0]).all():
        return best
    cost = (d * np.minimum(letters, 60)[:, None]).tolist()
    acc, back = cost[0], []
    for row in cost[1:]:
        m = acc.index(min(acc))
        most = acc[m] + CHANGE
        back.append([k if a <= most else m for k, a in enumerate(acc)])
        acc = [(a if a <= most else most) + c for a, c in zip(acc, row)]
    out = [acc.index(min(acc))]
    for row in reversed(back):
        out.append(row[out[-1]])
    return np.array(out[::-1])


SEGMENTS = "row_id bigint, segment int, start_sentence int, sentences int, letters bigint, lang string, confidence double, whole boolean"


def segments(profiles: Profiles, sizes: list[int], d: np.ndarray, letters: np.ndarray, wholes: np.ndarray) -> list[list[tuple]]:
    """(start sentence, sentences, letters, lang, confidence, whether it has a whole sentence) of each run of one language.

    ``sizes`` are the texts' numbers of sentences, whose distances, letters and wholeness come one text after another.
    """
    out: list[list[tuple]] = [[] for _ in sizes]
    ends = np.cumsum(sizes)
    if not len(d):
        return out
    best = d.argmin(1)
    text = np.repeat(np.arange(len(sizes)), sizes)
    change = np.flatnonzero((text[1:] == text[:-1]) & (best[1:] != best[:-1]))
    for k in np.unique(text[change]).tolist():
        i, j = ends[k] - sizes[k], ends[k]
        best[i:j] = path(d[i:j], letters[i:j])
    begin = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (best[1:] != best[:-1])]))
    total = np.add.reduceat(letters, begin)
    whole = np.logical_or.reduceat(wholes, begin)
    mean = np.add.reduceat(d * letters[:, None], begin) / np.maximum(total, 1)[:, None]
    two = np.sort(mean, axis=1)[:, :2] if mean.shape[1] > 1 else np.column_stack([mean, np.ones(len(mean))])
    sure = np.where(two[:, 1] > 0, np.clip((1 - two[:, 0] / np.where(two[:, 1] > 0, two[:, 1], 1)) * 3, 0.0, 1.0), 0.0)
    limit = np.array([profiles.limits.get(lang, 2.0) for lang in profiles.langs])
    its = best[begin]
    far = (total >= UNKNOWN_LETTERS) & (mean[np.arange(len(its)), its] > limit[its])
    sentence = begin - (ends - sizes)[text[begin]]
    run = zip(text[begin].tolist(), sentence.tolist(), np.diff(np.append(begin, len(d))).tolist(), total.astype(int).tolist(), its.tolist(), sure.tolist(), whole.tolist(), far.tolist())
    for k, i, n, held, lang, s, w, unknown in run:
        if held:
            out[k].append((i, n, held, "und", 0.0, w) if unknown else (i, n, held, profiles.langs[lang], round(s, 4), w))
    return out


def _segmented(profiles: Profiles, batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """(row_id, declared, segments) of batches of (row_id, declared, parts)."""
    measured = _Measured(profiles)
    for whole in batches:
        for start in range(0, max(whole.num_rows, 1), 500):
            ids, declared, texts = (whole.slice(start, 500).column(k).to_pylist() for k in range(3))
            at = measured([p for parts in texts for p in parts])
            d, letters, wholes = measured.d[at], measured.letters[at], measured.whole[at]
            yield list(zip(ids, declared, segments(profiles, [len(parts) for parts in texts], d, letters, wholes)))


def _segmenter(profiles: Profiles):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.float64(), pa.bool_()]
        for texts in _segmented(profiles, batches):
            rows = [(row, i, *seg) for row, _, segs in texts for i, seg in enumerate(segs)]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], names=[x.split()[0] for x in SEGMENTS.split(", ")])

    return go


def with_declared(df: DataFrame, sources: DataFrame, profiles: DataFrame) -> DataFrame:
    """(row_id, text, declared): the language that each record's source declares, null where it declares none."""
    spec = sources.select(F.col("id").alias("source_id"), "profile_id").join(profiles.select("profile_id", declared(F.col("language")).alias("declared")), "profile_id", "left")
    spec = spec.groupBy("source_id").agg(F.max("declared").alias("declared"))
    return df.select(F.col("row_id").cast("bigint").alias("row_id"), "text", "source_id").join(F.broadcast(spec), "source_id", "left").select("row_id", "text", "declared")


def labelled_segments(df: DataFrame, sources: DataFrame, topic_profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(segments, declared) of all records."""
    rows = with_declared(df, sources, topic_profiles)
    got = read(rows)
    seg = _texts(got).mapInArrow(_segmenter(fitted(got)), SEGMENTS)
    return seg, rows


def _texts(got: DataFrame) -> DataFrame:
    return spread(got.where("parts is not null").select("row_id", "declared", "parts"))


def found(df: DataFrame, sources: DataFrame, topic_profiles: DataFrame) -> DataFrame:
    """(row_id, lang) of each language of the records whose languages aren't just the declared one."""
    got = read(with_declared(df, sources, topic_profiles))
    return _texts(got).mapInArrow(_differs(fitted(got)), "row_id bigint, lang string")


def _differs(profiles: Profiles):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _segmented(profiles, batches):
            rows = []
            for row, want, segs in texts:
                most = max(segs, key=lambda s: s[2], default=None)
                got = {s[3] for s in segs if s[5] or s is most}
                if got and got != {want}:
                    rows += [(row, lang) for lang in sorted(got)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], names=["row_id", "lang"])

    return go


def by_record(df: DataFrame, sources: DataFrame, topic_profiles: DataFrame) -> DataFrame:
    """(row_id, declared, lang, confidence, langs): each record's main language, with the languages of its segments."""
    seg, rows = labelled_segments(df, sources, topic_profiles)
    main = seg.groupBy("row_id").agg(F.max_by("lang", F.struct("letters", "lang")).alias("lang"), F.round(F.sum(F.col("letters") * F.col("confidence")) / F.sum("letters"), 4).alias("confidence"), F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("langs"))
    return main.join(rows.select("row_id", "declared"), "row_id").select("row_id", "declared", "lang", "confidence", "langs")
