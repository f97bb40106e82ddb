"""Text, URL and hash expressions. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordmill.fixed_values import (
    AI_TITLE_TERMS,
    DEFAULT_ROLE_FAMILY,
    KNOWN_ENTITIES,
    RESERVED_REPO_OWNERS,
    ROLE_FAMILIES,
    SPACE,
    TRACKING_PARAMETERS,
    TRUNCATION_MARK,
    WORD,
)

REPO_PATTERN = r"https?://github\.com/([a-zA-Z0-9_\-.]+)/([a-zA-Z0-9_\-.]+)"


def blank_to_null(c: Column) -> Column:
    return F.when(c == "", None).otherwise(c)


def strip(c: Column) -> Column:
    """Trim every kind of Unicode white space, not only the blank."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def whole_words(terms: list[str]) -> str:
    """A pattern matching any of the terms where no word character touches it."""
    body = "|".join(t.replace(".", r"\.") for t in terms)
    return f"(?<!{WORD})({body})(?!{WORD})"


def contains_any(c: Column, words: list[str]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(c, F.lit(word))
    return hit


def normalize_whitespace(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), f"{SPACE}+", " "))


def normalize_title(c: Column) -> Column:
    return F.regexp_replace(F.lower(normalize_whitespace(c)), r"[.,:;\s]+$", "")


def normalize_authors(c: Column) -> Column:
    cleaned = F.filter(F.transform(c, normalize_whitespace), lambda a: a != "")
    return F.coalesce(F.array_distinct(cleaned), F.array().cast("array<string>"))


def arxiv_id(c: Column) -> Column:
    modern = F.regexp_extract(c, r"(\d{4}\.\d{4,5})(v\d+)?", 1)
    legacy = F.regexp_extract(c, r"([a-zA-Z\-]+/\d{7})(v\d+)?", 1)
    return F.coalesce(blank_to_null(modern), blank_to_null(legacy))


def arxiv_url(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("https://arxiv.org/abs/"), arxiv_id(c)), c)


def github_url(c: Column) -> Column:
    """First repository address found in the text, or null."""
    text = F.regexp_replace(F.regexp_replace(c, r"\.git/?$", ""), "/+$", "")
    owner = F.regexp_extract(text, REPO_PATTERN, 1)
    repo = F.regexp_extract(text, REPO_PATTERN, 2)
    usable = (owner != "") & ~F.lower(owner).isin(RESERVED_REPO_OWNERS)
    return F.when(usable, F.concat(F.lit("https://github.com/"), owner, F.lit("/"), repo))


def is_repo_url(c: Column) -> Column:
    return F.coalesce(strip(c).rlike(f"^{REPO_PATTERN}$"), F.lit(False))


def url_fingerprint(c: Column) -> Column:
    cleaned = F.regexp_replace(F.lower(strip(c)), "/+$", "")
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("")).otherwise(F.sha2(cleaned, 256))


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def content_bytes(c: Column) -> Column:
    return F.octet_length(c).cast("bigint")


def paper_hash(
    title: Column, authors: Column, abstract: Column, date: Column, url: Column, category: Column
) -> Column:
    """Equal for the same paper however it is spaced, ordered or versioned. The parts are joined
    with control characters that none of the normalised parts can hold. ``date`` is expected in
    its normalised form."""
    parts = [
        normalize_title(title),
        F.array_join(F.array_sort(normalize_authors(authors)), "\u0002"),
        normalize_whitespace(abstract),
        F.coalesce(date, F.lit("")),
        F.coalesce(arxiv_id(url), url, F.lit("")),
        F.lower(normalize_whitespace(category)),
    ]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)


def hamming64(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)).cast("bigint")


def record_identity(source_name: Column, url: Column) -> Column:
    return F.concat(F.lower(source_name), F.lit(":"), url_fingerprint(url))


def strip_tags(c: Column) -> Column:
    return strip(F.regexp_replace(c, "<[^>]+>", " "))


def snippet(c: Column, size: int = 500) -> Column:
    return F.substring(c, 1, size)


def role_family(title: Column, description: Column) -> Column:
    text = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(description, F.lit(""))))
    label = None
    for family, words in ROLE_FAMILIES:
        hit = contains_any(text, words)
        label = F.when(hit, F.lit(family)) if label is None else label.when(hit, F.lit(family))
    return label.otherwise(F.lit(DEFAULT_ROLE_FAMILY))


def entities_mentioned(c: Column) -> Column:
    """Known names in the text, in dictionary order. A plain search decides for nearly every name;
    the word-boundary pattern only looks at texts that hold the name somewhere."""
    text = F.lower(F.coalesce(c, F.lit("")))
    found = []
    for name in KNOWN_ENTITIES:
        term = name.lower()
        hit = F.contains(text, F.lit(term)) & text.rlike(whole_words([term]))
        found.append(F.when(hit, F.lit(name)))
    return F.array_except(F.array(*found), F.array(F.lit(None).cast("string")))


def is_ai_title(c: Column) -> Column:
    return F.lower(F.coalesce(c, F.lit(""))).rlike(whole_words(AI_TITLE_TERMS))


def token_estimate(c: Column) -> Column:
    size = F.length(F.coalesce(c, F.lit(""))).cast("bigint")
    quarter = F.shiftright(size, 2)
    return F.when(size == 0, F.lit(0).cast("bigint")).otherwise(
        F.greatest(F.lit(1).cast("bigint"), quarter)
    )


def words(c: Column) -> Column:
    """White-space separated words, none blank."""
    return F.filter(F.split(strip(F.coalesce(c, F.lit(""))), f"{SPACE}+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(f"[^{SPACE[1:-1]}]+")).cast("bigint")


def truncate_middle(c: Column, max_words: int = 2500) -> Column:
    top = int(max_words * 0.8)
    bottom = max_words - top
    all_words = words(c)
    head = F.array_join(F.slice(all_words, 1, top), " ")
    if bottom > 0:
        tail = F.array_join(F.slice(all_words, -bottom, bottom), " ")
    else:
        tail = F.lit("")
    return F.when(word_count(c) <= max_words, c).otherwise(
        F.concat(head, F.lit(TRUNCATION_MARK), tail)
    )


def paragraphs_of(c: Column, separator: str = "\n\n") -> Column:
    return F.split(c, F.lit(rf"\Q{separator}\E"), -1)


def chunk_starts(sizes: Column, max_words: int = 1500) -> Column:
    """Numbers of the paragraphs that begin a chunk when whole paragraphs of the given sizes are
    packed greedily. The fold keeps only these numbers, so its state is no larger than the result."""
    start = F.struct(
        F.array(F.lit(1)).alias("starts"), F.lit(0).alias("used"), F.lit(0).alias("at")
    )

    def step(acc: Column, n: Column) -> Column:
        at = acc["at"] + 1
        full = (acc["used"] + n > max_words) & (at > F.element_at(acc["starts"], -1))
        return F.struct(
            F.when(full, F.array_append(acc["starts"], at)).otherwise(acc["starts"]).alias("starts"),
            F.when(full, n).otherwise(acc["used"] + n).alias("used"),
            at.alias("at"),
        )

    return F.aggregate(sizes, start, step, lambda acc: acc["starts"])


def cut_chunks(paragraphs: Column, starts: Column, separator: str = "\n\n") -> Column:
    """Chunks from paragraphs and starts. Both should be columns, not expressions, or they would be
    computed anew for every chunk."""
    def cut(pos: Column, i: Column) -> Column:
        following = F.coalesce(F.get(starts, i + 1), F.size(paragraphs) + 1)
        return F.array_join(F.slice(paragraphs, pos, following - pos), separator)

    return F.transform(starts, cut)


def canonicalize_url(c: Column) -> Column:
    """https, lower-case host without ``www.``, no tracking parameters, no default file name, no
    trailing slash, remaining parameters in order."""
    bare = F.regexp_replace(strip(c), "#.*$", "")
    bare = F.regexp_replace(bare, "^(?i)https?://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), r"^www\.", "")
    path = F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, r"/index\.html$", "/"), "/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(
        F.filter(
            F.split(query, "&"),
            lambda p: (p != "") & ~F.substring_index(p, "=", 1).isin(TRACKING_PARAMETERS),
        )
    )
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.concat(F.lit("https://"), host, path, tail)


def url_path_date(c: Column) -> Column:
    """Date written in the path, as in ``/2026/09/10/``."""
    found = F.regexp_extract(c, r"/(\d{4}/\d{2}/\d{2})(/|$)", 1)
    return F.try_to_date(blank_to_null(found), "yyyy/MM/dd")


def is_web_url(c: Column) -> Column:
    return F.startswith(c, F.lit("http"))


def has_length(c: Column, least: int = 30) -> Column:
    """Text of at least so many characters; null has none."""
    return F.length(F.coalesce(c, F.lit(""))) >= least
