"""HTML pages without a DOM: noise removal, block text, meta tags, JSON-LD."""

from __future__ import annotations

import html as _html

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from recordmill.fixed_values import JSON_LD_DATE_KEYS, META_DATE_KEYS, NOISE_TAGS
from recordmill.functions.text import blank_to_null, strip, truncate_middle

_NOISE = r"(?is)<(?:!--.*?-->|(" + "|".join(NOISE_TAGS) + r")\b[^>]*>.*?</\1\s*>)"
# A tag begins with a letter, a slash, ``!`` or ``?``; a bare ``<`` is text. A ``>`` inside quotes does
# not end it. Where a tag does not end that way, because a quote is never closed, quotes count no more
# from there on, and tags end at the next ``>``.
_CLOSED = r"<[a-zA-Z/!?](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
_LOOSE = r"<[a-zA-Z/!?][^>]*+>"
_WELL_FORMED = rf"^(?:[^<]++|<(?![a-zA-Z/!?])|{_CLOSED})*+"
_TO_LAST_END = r"(?s)^.*>"
_META = r"(?is)<meta\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
_BLOCK_OPEN = r"(?i)<(?:p|h[1-4]|li|section)\b[^>]*>"
_BLOCK_EDGE = r"(?i)</?(?:p|h[1-4]|li|section|article|main|body|ul|ol|div|table|tr|td)\b[^>]*>"
_MARK = "\u0001"


@F.pandas_udf(StringType())
def _unescape(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else _html.unescape(v))


def decode_entities(c: Column) -> Column:
    """The five basic entities are decoded in the JVM. Rows holding any other reference go, whole,
    through the standard decoder instead, so that nothing is decoded twice."""
    rare = c.rlike(r"&(?!(?:amp|lt|gt|quot|apos);)#?[A-Za-z0-9]+;?")
    basic = c
    for name, sign in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        basic = F.replace(basic, F.lit(f"&{name};"), F.lit(sign))
    return F.coalesce(_unescape(F.when(rare, c)), basic)


def _bind(value: Column, body) -> Column:
    """``body`` over ``value``, which is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _before_last_end(c: Column, body) -> Column:
    """``body`` over the text up to its last ``>``; behind it no tag can end, so nothing is looked for."""
    return _bind(c, lambda t: _bind(F.regexp_extract(t, _TO_LAST_END, 0), lambda head: F.concat(
        body(head), F.substr(t, F.length(head) + 1))))


def without_tags(c: Column, sign: str) -> Column:
    """``sign`` in place of every tag, in time linear in the text. One possessive pass finds how far tags
    end as they should; the text up to there and the rest are each read once, and no place where a tag
    begins is ever scanned to the end of the text in vain."""
    def parts(t: Column) -> Column:
        def joined(good: Column) -> Column:
            rest = F.substr(t, F.length(good) + 1)
            return F.concat(
                F.regexp_replace(good, _CLOSED, sign), _before_last_end(rest, lambda r: F.regexp_replace(r, _LOOSE, sign)))

        return _bind(F.regexp_extract(t, _WELL_FORMED, 0), lambda good: F.when(
            F.length(good) == F.length(t), F.regexp_replace(t, _CLOSED, sign)).otherwise(joined(good)))

    return _bind(c, parts)


def drop_noise(c: Column) -> Column:
    """Without comments and the elements that never hold content."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), _NOISE, "")


def _attribute(tag: Column, name: str) -> Column:
    found = F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", 1)
    single = F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*'([^']*)'", 1)
    return blank_to_null(F.concat(found, single))


def meta_tags(c: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(_META), F.lit(0))


def meta_contents(tags: Column, attribute: str, value: str) -> Column:
    """Contents of all meta tags carrying the attribute value, in page order; null where a tag has
    no content."""
    dotted = value.replace(".", r"\.")
    pattern = rf"(?is)\b{attribute}\s*=\s*[\"']?{dotted}(?=[\"'\s/>])"
    return F.transform(F.filter(tags, lambda t: t.rlike(pattern)), lambda t: _attribute(t, "content"))


def meta_content(tags: Column, attribute: str, value: str) -> Column:
    return strip(F.get(meta_contents(tags, attribute, value), 0))


def element_text(c: Column, opening: str, tag: str) -> Column:
    """Text of the first element whose start tag matches ``opening``; null when there is none."""
    body = F.regexp_extract_all(c, F.lit(rf"(?is){opening}(.*?)</{tag}\s*>"), F.lit(1))
    return without_tags(F.get(body, 0), "")


def page_title(c: Column, tags: Column) -> Column:
    named = blank_to_null(meta_content(tags, "property", "og:title"))
    titled = element_text(c, r"<title\b[^>]*>", "title")
    headed = element_text(c, r"<h1\b[^>]*>", "h1")
    return F.coalesce(named, blank_to_null(strip(titled)), strip(headed), F.lit(""))


def canonical_link(c: Column, fallback: Column) -> Column:
    links = F.regexp_extract_all(c, F.lit(r"(?is)<link\b[^>]*>"), F.lit(0))
    canonical = F.filter(links, lambda t: t.rlike(r"(?is)\brel\s*=\s*[\"']?canonical\b"))
    return F.coalesce(_attribute(F.get(canonical, 0), "href"), fallback)


def meta_description(tags: Column) -> Column:
    named = meta_contents(tags, "name", "description")
    shared = meta_contents(tags, "property", "og:description")
    chosen = F.when(F.size(named) > 0, F.get(named, 0)).otherwise(F.get(shared, 0))
    return strip(F.coalesce(chosen, F.lit("")))


def meta_dates(tags: Column) -> Column:
    found = F.array(*[meta_content(tags, a, v) for a, v in META_DATE_KEYS])
    return F.array_compact(found)


def json_ld_objects(c: Column) -> Column:
    """All JSON-LD objects of a page as variants: a script is one object or a list of them; other
    JSON and broken JSON are left out."""
    pattern = (
        r"(?is)<script\b[^>]*type\s*=\s*[\"']application/ld\+json[\"'][^>]*>(.*?)</script\s*>"
    )
    scripts = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), F.lit(1))
    return flatten_json_objects(scripts)


def flatten_json_objects(texts: Column) -> Column:
    parsed = F.transform(texts, F.try_parse_json)
    nested = F.transform(
        F.filter(parsed, lambda v: v.isNotNull()),
        lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v)),
    )
    return F.filter(
        F.flatten(nested), lambda v: F.startswith(F.schema_of_variant(v), F.lit("OBJECT"))
    )


def json_ld_dates(objects: Column) -> Column:
    def dates(v: Column) -> Column:
        found = []
        for key in JSON_LD_DATE_KEYS:
            value = F.try_variant_get(v, f"$.{key}", "variant")
            text = F.try_variant_get(v, f"$.{key}", "string")
            found.append(F.when(F.schema_of_variant(value) == "STRING", text))
        return F.array_compact(F.array(*found))

    return F.flatten(F.transform(objects, dates))


def _up_to_close(tail: Column, tag: str) -> Column:
    """What follows a start tag, up to the end tag that belongs to it; all of it when none does.
    A running depth over the tags of that name finds the one that closes."""
    edge = rf"(?i)</?{tag}\b[^>]*>"

    def cut(tags: Column) -> Column:
        start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(-1).alias("close"))

        def step(state: Column, t: Column) -> Column:
            depth = state["depth"] + F.when(F.startswith(t, F.lit("</")), -1).otherwise(1)
            return F.struct(
                depth.alias("depth"), (state["at"] + 1).alias("at"),
                F.when((state["close"] < 0) & (depth < 0), state["at"]).otherwise(state["close"]).alias("close"),
            )

        close = F.aggregate(tags, start, step, lambda state: state["close"])

        def joined(k: Column) -> Column:
            pieces = _bind(F.split(tail, edge, -1), lambda p: F.transform(
                F.sequence(F.lit(0), k),
                lambda i: F.concat(F.get(p, i), F.when(i < k, F.get(tags, i)).otherwise(F.lit(""))),
            ))
            return F.when(k < 0, tail).otherwise(F.array_join(pieces, ""))

        return _bind(close, joined)

    return _bind(F.regexp_extract_all(tail, F.lit(edge), F.lit(0)), cut)


def main_container(clean: Column) -> Column:
    """Article, else main, else the first content-like div, else body, else all of it. Nested
    elements of the same name belong to the container; an unclosed one reaches to the end."""
    def inside(opening: str, tag: str) -> Column:
        first = rf"(?i)<{opening}"
        tail = F.get(F.split(clean, first, 2), 1)
        return F.when(clean.rlike(first), _bind(tail, lambda t: _up_to_close(t, tag)))

    content_div = r"div\b[^>]*class\s*=\s*[\"'][^\"'>]*(?:content|post|article|body|entry)[^>]*>"
    return F.coalesce(
        inside(r"article\b[^>]*>", "article"),
        inside(r"main\b[^>]*>", "main"),
        inside(content_div, "div"),
        inside(r"body\b[^>]*>", "body"),
        clean,
    )


def block_texts(container: Column) -> Column:
    """Texts over ten characters of paragraphs, headings, list items and sections. A block ends at
    the next block tag, so unclosed paragraphs do not swallow what follows. Entities are still
    encoded."""
    opened = _before_last_end(container, lambda t: F.regexp_replace(t, _BLOCK_OPEN, _MARK + "O$0"))
    marked = _before_last_end(opened, lambda t: F.regexp_replace(t, f"(?<!{_MARK}O)" + _BLOCK_EDGE, _MARK + "C"))
    pieces = F.filter(F.split(marked, _MARK), lambda p: F.startswith(p, F.lit("O")))
    texts = F.transform(pieces, lambda p: strip(without_tags(F.substr(p, F.lit(2)), "")))
    return F.filter(texts, lambda t: F.length(t) > 10)


def lines_of_text(c: Column) -> Column:
    """Every text node on its own line, no blank lines. Entities are still encoded."""
    lines = F.split(without_tags(c, "\n"), r"[\n\r\x0B\x0C\x1C-\x1E\x{85}\u2028\u2029]")
    return F.array_join(F.filter(F.transform(lines, strip), lambda t: t != ""), "\n")


# The functions below work on DataFrames: each intermediate text becomes a column, so that it is
# computed once however often the next step looks at it.


def decode_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: decode_entities(F.col(n)) for n in names})


def with_clean_text(df: DataFrame, html: str, out: str) -> DataFrame:
    """Adds the readable text of a page, line by line."""
    lines = df.withColumn("_denoised", drop_noise(F.col(html))).withColumn(
        out, lines_of_text(F.col("_denoised"))
    )
    return decode_columns(lines, out).drop("_denoised")


def with_main_text(df: DataFrame, html: str, out: str) -> DataFrame:
    """Adds the text of the main container, block by block; all of its lines when it has no block."""
    blocks = (
        df.withColumn("_denoised", drop_noise(F.col(html)))
        .withColumn("_container", main_container(F.col("_denoised")))
        .withColumn("_blocks", block_texts(F.col("_container")))
    )
    joined = blocks.withColumn(
        out,
        F.when(F.size("_blocks") > 0, F.array_join("_blocks", "\n\n")).otherwise(
            lines_of_text(F.col("_container"))
        ),
    )
    return decode_columns(joined, out).drop("_denoised", "_container", "_blocks")


def with_prepared_payload(df: DataFrame, html: str, out: str, max_words: int = 2500) -> DataFrame:
    """Adds the readable text, cut in the middle when it exceeds the word budget."""
    clean = with_clean_text(df, html, out)
    return clean.withColumn(out, truncate_middle(F.col(out), max_words))
