"""Search queries, search hits and source specs: the control plane of collection over small tables.

Hits are rows (provider, query, title, url, snippet, payload as JSON), candidates are rows too, so ranking, deduplication
and planning are the transforms of ``discovery``. No search is made here: hits come from a staged table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.functions import urls
from textloom.operators import discovery

# Terms, tags and parts of addresses that discovery goes by.
ASSET_TERMS = ("dataset", "csv", "parquet", "match results", "rankings", "stats")
TABLE_TERMS = ("dataset", "csv", "parquet", "table", "stats", "results")
TOPIC_STOPWORDS = ("historical", "analysis", "prediction", "ready", "data", "dataset", "years", "year", "last", "from", "with", "without", "pre", "match")
MODALITY_TAGS = {"audio": ("audio", "speech"), "image": ("image", "vision"), "text": ("text", "nlp"), "tabular": ("tabular", "csv", "timeseries")}
TASK_TAGS = {"classification": ("classification", "text-classification"), "qa": ("question-answering", "qa"), "translation": ("translation",), "summarization": ("summarization",)}
LANGUAGE_TAGS = {"english": ("english", "en"), "russian": ("russian", "ru"), "multilingual": ("multilingual",)}
TOPIC_MODALITY = {"text": ("text", "nlp", "nlp ", " caption", "transcript"), "image": ("image", "images", "photo", "vision"), "audio": ("audio", "speech", "sound"), "video": ("video",)}
DENIED_PATHS = ("/login", "/signin", "/sign-in", "/signup", "/register", "/account", "/auth/", "/oauth", "/private", "/cart", "/checkout")
DENIED_HOSTS = ("login.", "accounts.", "id.", "signin.")
FORUM = r"(?i)forum|thread|topic|discussion|community|board|message|posts?/|f=\d+|t=\d+|showthread|viewforum"
FORUM_WORDS = ("question", "answers", "discussion", "thread", "community")
EVIDENCE_KEYS = (
    "id", "full_name", "description", "tags", "topics", "stargazers_count", "license", "updated_at", "ref", "subtitle", "forum_score",
    "detected_kind", "risks", "resolved_url", "search_engine", "label", "page_url", "json_url", "method", "api_headers",
)
LANDING = (".html", ".htm", ".php", ".asp", ".aspx", ".jsp")
TRUST = {"huggingface": 1.0, "github": 0.85, "kaggle": 0.9, "web_forum": 0.35, "devtools_har": 0.7}
TYPES = {"huggingface": "hf_dataset", "github": "github_dataset", "kaggle": "kaggle"}

MOST_QUERIES, MOST_CHARS, MOST_TERMS = 4, 80, 6


# ---- words


def at_word(text: str, limit: int = MOST_CHARS) -> str:
    """Single spaces, cut before the word that would pass the limit; a longer first word is cut itself."""
    flat = " ".join(text.split())
    return flat if len(flat) <= limit else flat[:limit].rsplit(" ", 1)[0] or flat[:limit]


def at_word_column(c: Column | str, limit: int = MOST_CHARS) -> Column:
    """``at_word`` as a column."""
    x = T.strip(F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"\s+", " "))
    head = F.substring(x, 1, limit)
    return F.when(F.length(x) <= limit, x).otherwise(F.when(head.contains(" "), F.regexp_replace(head, r" [^ ]*$", "")).otherwise(head))


def terms(c: Column | str, most: int = MOST_TERMS) -> Column:
    """The first distinct words of a topic, three characters or longer, without words that all topics have."""
    found = F.regexp_extract_all(F.lower(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))), F.lit("([a-zA-Zа-яА-Я0-9_+-]{3,})"), 1)
    return F.slice(F.array_distinct(F.filter(found, lambda w: ~w.isin(*TOPIC_STOPWORDS))), 1, most)


def _distinct(queries: list[str], most: int = MOST_QUERIES) -> list[str]:
    seen: dict[str, str] = {}
    for q in map(at_word, queries):
        if q:
            seen.setdefault(q.casefold(), q)
    return list(seen.values())[:most]


def topic_terms(topic: str, hints: list[str] = ()) -> list[str]:
    found = [w.casefold() for w in hints] or re.findall(r"[a-zA-Zа-яА-Я0-9_+-]{3,}", (topic or "").casefold())
    return list(dict.fromkeys(w for w in found if w not in TOPIC_STOPWORDS))[:MOST_TERMS]


def query_plan(topic: str, modality: str | None = None, hints: dict | None = None) -> dict[str, list[str]]:
    """A few distinct queries for each provider, from the topic's terms and what its data is usually called."""
    hints = hints or {}
    domain = topic_terms(topic, hints.get("keywords") or [])
    assets = list(dict.fromkeys([*(TABLE_TERMS if modality == "tabular" else ASSET_TERMS), *(a.casefold() for a in hints.get("asset_terms", []))]))
    if years := hints.get("history_window_years"):
        assets.insert(0, f"{years} years")
    assets = assets[:MOST_TERMS]
    head, pair, goal = " ".join(domain[:3]), " ".join(domain[:2]), at_word(topic or "")
    base = [head, f"{head} dataset" if head else "dataset", f"{pair} {assets[0]}", " ".join(domain[:3] + assets[:2])]
    about = head or goal
    return {
        "huggingface": _distinct(base),
        "github": _distinct([*base, " ".join([*domain[:3], "github repository"])]),
        "kaggle": _distinct([*base, " ".join([*domain[:3], "kaggle dataset"])]),
        "web_forum": _distinct([f"{about} forum discussion", f"{about} community questions", f"{pair or goal} discussion board", goal, f"{about} {assets[0]} forum"]),
    }


def simple_queries(topic: str, facets: list[str | None] = (), keywords: list[str] = (), most: int = 5) -> list[str]:
    """The topic alone, with its facets, with its keywords, and with the words that data sets go by."""
    topic = (topic or "").strip()
    if not topic:
        return []
    more = lambda xs: " ".join([topic, *[x for x in xs if x]])
    return _distinct([topic, more(facets), more(list(keywords)[:3]), more(["dataset"]), more(["github repository"])], most)


def tagged(tags: Column, kinds: dict[str, tuple[str, ...]]) -> Column:
    """The first kind of which an array of tags holds a name; null for none."""
    low = F.transform(F.coalesce(tags, F.array().cast("array<string>")), F.lower)
    out = F.lit(None).cast("string")
    for kind, names in reversed(list(kinds.items())):
        out = F.when(F.arrays_overlap(low, F.array(*map(F.lit, names))), kind).otherwise(out)
    return out


def topic_modality(topic: Column | str) -> Column:
    """What a topic's words say about the kind of data; tables for all that says nothing."""
    x = F.lower(F.col(topic) if isinstance(topic, str) else topic)
    out = F.lit("tabular")
    for kind, words in reversed(list(TOPIC_MODALITY.items())):
        hit = F.lit(False)
        for w in words:
            hit = hit | x.contains(w)
        out = F.when(hit, kind).otherwise(out)
    return out


def topic_language(topic: Column | str) -> Column:
    """english, unless a topic names another language or several."""
    x = F.lower(F.col(topic) if isinstance(topic, str) else topic)
    some = lambda *words: F.greatest(*[x.contains(w) for w in words], F.lit(False))
    return F.when(some("казах", "kazakh"), "kazakh").when(some(" russian", " rus ", "русск"), "russian").when(some("french", " german", "spanish ", "italian", "mandarin", "chinese text"), "multilingual").otherwise("english")


# ---- addresses


def unwrapped(url: Column | str) -> Column:
    """The address inside a search engine's redirect (its ``uddg`` parameter), else the address itself."""
    u = F.col(url) if isinstance(url, str) else url
    inner = F.regexp_extract(u, r"[?&]uddg=([^&#]+)", 1)
    redirect = F.lower(u).rlike(r"^(?:https?:)?//(?:[^/?#]*\.)?duckduckgo\.com/l/") & (inner != "")
    return F.when(redirect, F.url_decode(inner)).otherwise(u)


def denied(url: Column | str, hosts: list[str] = ()) -> Column:
    """Whether an address is of a denied host, a log-in host, or a path behind a log-in or a cart."""
    u = F.col(url) if isinstance(url, str) else url
    host = F.lower(F.regexp_extract(F.coalesce(u, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))
    path = F.lower(F.regexp_extract(F.coalesce(u, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1))
    out = F.lit(False)
    for d in hosts:
        if d.strip():
            out = out | host.contains(d.strip().lower())
    for d in DENIED_HOSTS:
        out = out | host.startswith(d)
    for p in DENIED_PATHS:
        out = out | path.contains(p)
    return out


def forum_score(url: Column | str, title: Column | str, snippet: Column | str | None = None) -> Column:
    """How much an address and title look like a forum's, from 0.2 to 1."""
    u, t = (F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in (url, title))
    s = F.lit("") if snippet is None else F.coalesce(F.col(snippet) if isinstance(snippet, str) else snippet, F.lit(""))
    every = F.lower(F.concat_ws(" ", u, t, s))
    said = F.lit(False)
    for w in FORUM_WORDS:
        said = said | every.contains(w)
    return F.round(F.least(F.lit(1.0), F.lit(0.2) + F.when(u.rlike(FORUM) | t.rlike(FORUM), 0.5).otherwise(0.0) + F.when(said, 0.15).otherwise(0.0)), 4)


# ---- hits and candidates

HITS = "provider string, query string, title string, url string, snippet string, payload string"


def evidence(hits: DataFrame) -> DataFrame:
    """(evidence_id, provider, query, source_url, title, snippet, metadata): hits with the payload keys worth keeping."""
    kept = F.map_filter(F.from_json("payload", "map<string,string>"), lambda k, v: k.isin(*EVIDENCE_KEYS) & v.isNotNull())
    made = F.concat_ws(":", "provider", F.hex(F.xxhash64("query", "url", "title")))
    return hits.select(made.alias("evidence_id"), "provider", "query", F.col("url").alias("source_url"), "title", "snippet", F.to_json(kept).alias("metadata"))


def candidates(hits: DataFrame, topic: str, modality: str | None = None, task: str | None = None, language: str | None = None) -> DataFrame:
    """Candidates of all providers' hits, scored against a topic, with what each would take to run.

    An API-like page becomes an API source that can run; a page of a forum a scrape source that waits for selectors, ranked up by
    how much it looks like a forum.
    """
    get = lambda k: F.get_json_object("payload", f"$.{k}")
    tags = F.from_json(F.coalesce(get("tags"), get("topics")), "array<string>")
    page = F.coalesce(get("resolved_url"), get("page_url"), unwrapped("url"))
    web = F.col("provider") == "web_forum"
    manual = F.col("provider") == "devtools_har"
    kind = F.coalesce(get("detected_kind"), F.when(manual & get("json_url").isNotNull(), "api_json"), urls.kind(page))
    api = (web | manual) & (kind == "api_json")
    title = F.coalesce(get("full_name"), get("label"), F.when(F.col("provider") == "huggingface", get("id")), F.when(F.col("provider") == "kaggle", get("ref")), "title", page)
    about = F.coalesce(get("description"), get("subtitle"), "snippet")
    forum = F.coalesce(get("forum_score").try_cast("double"), forum_score(page, "title", "snippet"))
    rows = hits.withColumns({"__tags": tags, "__page": page, "__api": api, "__title": title, "__about": about, "__forum": forum})
    its_modality = F.when(web, F.when(F.col("__forum") >= 0.45, "text")).when(manual, "text").otherwise(tagged(F.col("__tags"), MODALITY_TAGS))
    its_task, its_language = tagged(F.col("__tags"), TASK_TAGS), tagged(F.col("__tags"), LANGUAGE_TAGS)
    fits = lambda got, wanted: F.coalesce((got == F.lit(wanted)).cast("double"), F.lit(0.0)) if wanted else F.lit(0.0)
    trust = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in TRUST.items() for x in kv]), F.col("provider")), F.lit(0.5))
    searched = F.concat_ws(" ", "__title", "__about", "__tags")
    score = discovery.relevance({
        "topic": discovery.topic_match(F.lit(topic), searched), "trust": trust, "richness": discovery.richness(F.coalesce(F.col("__tags"), F.array().cast("array<string>")), F.coalesce(F.length("__about") > 0, F.lit(False))),
        "modality": fits(its_modality, modality), "task": fits(its_task, task), "language": fits(its_language, language),
    })
    kinds = F.try_element_at(F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv]), F.col("provider"))
    return rows.select(
        F.concat_ws(":", "provider", F.lower(F.when(web | manual, urls.canonical("__page")).otherwise(F.col("__title")))).alias("candidate_id"),
        F.coalesce(kinds, F.when(F.col("__api"), "api").otherwise("scrape")).alias("type"),
        F.substring("__title", 1, 220).alias("name"),
        F.when(web | manual, F.col("__page")).otherwise(F.col("url")).alias("url"),
        F.when(F.col("__api"), F.coalesce(get("json_url"), "__page")).alias("endpoint"),
        F.when(F.col("provider").isin("huggingface", "kaggle"), F.col("__title")).alias("dataset_id"),
        F.when(F.col("provider") == "github", F.col("url")).alias("repo_url"),
        its_modality.alias("modality"), its_task.alias("task_type"), its_language.alias("language"),
        get("downloads").try_cast("bigint").alias("estimated_rows"),
        F.when(web, F.round(F.least(F.lit(1.0), score + 0.12 * F.col("__forum")), 4)).otherwise(score).alias("relevance"),
        (kinds.isNotNull() | F.col("__api")).alias("executable"),
        F.when(kinds.isNull() & ~F.col("__api"), "needs selectors or a probe").alias("reason"),
    )


def with_landing_twins(found: DataFrame) -> DataFrame:
    """A scrape twin, not executable, for each file address that looks like a page; one per address."""
    path = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1))
    page = F.lit(False)
    for ending in LANDING:
        page = page | path.endswith(ending)
    first = found.where((F.col("type") == "http_file") & page).withColumn("__u", urls.canonical("url"))
    one = first.groupBy("__u").agg(F.min_by(F.struct(*found.columns), "candidate_id").alias("c")).select("c.*")
    twins = one.withColumns({
        "candidate_id": F.concat("candidate_id", F.lit(":page")), "type": F.lit("scrape"), "name": F.concat("name", F.lit(" (page)")),
        "relevance": F.greatest(F.coalesce("relevance", F.lit(0.0)) - 0.05, F.lit(0.05)), "executable": F.lit(False), "reason": F.lit("a page, not a file"),
    })
    return found.unionByName(twins)


def specs(chosen: DataFrame) -> DataFrame:
    """Source specs of candidates; a repository page can't run until it is promoted to a data set."""
    repository = F.col("type") == "repository"
    made = F.concat_ws("_", "type", F.regexp_replace(F.lower("name"), r"[^a-z0-9]+", "_"))
    return chosen.select(
        made.alias("id"), "type", "name", "dataset_id", "repo_url", "url", "endpoint", "estimated_rows", F.lit(True).alias("enabled"),
        (F.col("executable") & ~repository).alias("executable"), F.when(repository, F.coalesce("reason", F.lit("a repository's page only"))).otherwise(F.col("reason")).alias("reason"),
    )


def catalog_score(topic: Column, modality: Column, task: Column, language: Column, labels: Column, size: Column, entry: dict[str, Column]) -> Column:
    """How well an entry of a fixed catalog fits a topic profile, from 0.2 to 1."""
    same = lambda a, b: F.coalesce(a == b, F.lit(False))
    named = F.exists(entry["tags"], lambda t: F.contains(F.lower(F.coalesce(topic, F.lit(""))), t)) & (F.coalesce(topic, F.lit("")) != "")
    total = (
        F.lit(0.2)
        + F.when(same(modality, entry["modality"]), 0.25).otherwise(0.0)
        + F.when(same(task, entry["task_type"]), 0.25).otherwise(0.0)
        + F.when(same(language, entry["language"]), 0.2).when(language.isNotNull() & same(entry["language"], F.lit("multilingual")), 0.1).otherwise(0.0)
        + F.when(named, 0.2).otherwise(0.0)
        + F.when(F.coalesce(labels & entry["supports_labels"], F.lit(False)), 0.1).otherwise(0.0)
        + F.when(F.coalesce(entry["estimated_rows"] >= size, F.lit(False)), 0.1).otherwise(0.0)
    )
    return F.round(F.least(total, F.lit(1.0)), 4)
