"""Text columns: title keys, clean-up, keyword tests, sentences and display forms.

All functions take and return Columns and use only built-in expressions. Character classes are spelled
out (`[^\\p{L}\\p{N}_\\s]`), since Java's `\\w` knows ASCII only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PUNCT = r"[^\p{L}\p{N}_\s]"
PUNCT_NOT_DASH = r"[^\p{L}\p{N}_\s-]"
NOT_ALNUM = r"[^a-z0-9]+"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def title_key(c: Column, style: str = "dedupe") -> Column:
    """A title as a match key; never join keys of different styles. Null gives ''.

    dedupe: punctuation deleted. eval: punctuation but '-' becomes a space. prep, venue: all but ASCII
    letters and digits becomes a space. rerank: spaces squeezed, then punctuation but '-' deleted.
    """
    c = F.lower(F.coalesce(c, F.lit("")))
    if style == "dedupe":
        return squeeze(F.regexp_replace(c, PUNCT, ""))
    if style == "eval":
        return squeeze(F.regexp_replace(c, PUNCT_NOT_DASH, " "))
    if style in ("prep", "venue"):
        return F.trim(F.regexp_replace(c, NOT_ALNUM, " "))
    if style == "rerank":
        return F.trim(F.regexp_replace(squeeze(c), PUNCT_NOT_DASH, ""))
    if style == "space":
        return squeeze(c)
    raise ValueError(f"unknown title style {style!r}")


#: The entities that are decoded, in this order.
ENTITIES = (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"))


def strip_html(c: Column) -> Column:
    c = F.regexp_replace(F.coalesce(c, F.lit("")), r"<[^>]+>", "")
    for name, char in ENTITIES:
        c = F.replace(c, F.lit(name), F.lit(char))
    return squeeze(c)


def as_text(c: Column, kind: T.DataType) -> Column:
    """A column of any type as text: lists and structs as JSON, texts as they are, null stays null."""
    return F.to_json(c) if isinstance(kind, T.ArrayType | T.StructType | T.MapType) else c.cast("string")


def venue_of(venue: Column, source: Column, journal: Column) -> Column:
    return F.coalesce(blank_to_null(venue), blank_to_null(source), blank_to_null(journal), F.lit(""))


def sanitize(c: Column) -> Column:
    """Line and paragraph separators and carriage returns as newlines; other control characters removed."""
    c = F.replace(F.coalesce(c, F.lit("")), F.lit("\u2028"), F.lit("\n"))
    c = F.replace(c, F.lit("\u2029"), F.lit("\n\n"))
    c = F.regexp_replace(c, r"\r\n?", "\n")
    return F.regexp_replace(c, r"[\x00-\x08\x0B-\x1F]", "")


def any_of(c: Column, words: tuple[str, ...]) -> Column:
    """Does any of the words occur as a substring?"""
    out = F.lit(False)
    for w in words:
        out = out | F.contains(c, F.lit(w))
    return out


def has_word(c: Column, word: str) -> Column:
    """Substring test; words of up to four characters must stand alone."""
    if len(word) > 4:
        return F.contains(c, F.lit(word))
    quoted = "".join("\\" + ch if not ch.isalnum() else ch for ch in word)
    return F.rlike(c, F.lit(rf"(^|[^\p{{L}}\p{{N}}_]){quoted}($|[^\p{{L}}\p{{N}}_])"))


def matches(c: Column, words: tuple[str, ...]) -> Column:
    """The words that occur, in the order given.

    Short words must stand alone: the text is cut into words once, by one pass of one pattern, and each
    short word is then a plain substring between blanks. The cut text is the variable of a lambda, so it is made once a row.
    """
    short = lambda w: len(w) <= 4 and w.replace("_", "a").isalnum()
    low = [(w, w.lower().strip()) for w in words]
    if not any(short(v) for _, v in low):
        return F.array_compact(F.array(*[F.when(has_word(c, v), F.lit(w)) for w, v in low]))
    spaced = F.concat(F.lit(" "), F.regexp_replace(c, r"[^\p{L}\p{N}_]+", " "), F.lit(" "))
    hit = lambda x, v: F.contains(x["s"], F.lit(f" {v} ")) if short(v) else has_word(x["c"], v)
    found = lambda x: F.array_compact(F.array(*[F.when(hit(x, v), F.lit(w)) for w, v in low]))
    return F.transform(F.array(F.struct(c.alias("c"), spaced.alias("s"))), found)[0]


def sentences(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, r"\."), lambda s: F.trim(s)), lambda s: s != "")


def key_findings(summary: Column, n: int = 3) -> Column:
    """Up to n findings: bullets, else dashed lines, else sentences."""
    s = F.coalesce(summary, F.lit(""))
    parts = lambda sep: F.filter(F.transform(F.split(s, sep), lambda x: F.trim(x)), lambda x: x != "")
    return F.slice(F.when(F.contains(s, F.lit("•")), parts("•")).when(F.contains(s, F.lit("\n-")), parts("\n-")).otherwise(F.transform(sentences(s), lambda x: F.concat(x, F.lit(".")))), 1, n)


def bullet_findings(summary: Column, n: int = 3) -> Column:
    """Up to n findings: what follows a bullet sign, else sentences."""
    s = F.when(summary == "No summary available.", "").otherwise(F.coalesce(summary, F.lit("")))
    bullets = F.regexp_extract_all(s, F.lit(r"[•\-*][ \t]*([^\n]+)"), F.lit(1))
    return F.slice(F.when(F.size(bullets) > 0, bullets).otherwise(sentences(s)), 1, n)


def why_it_matters(summary: Column, reason: Column) -> Column:
    first = F.trim(F.split_part(F.coalesce(summary, F.lit("")), F.lit("."), F.lit(1)))
    use = (F.length(first) > 20) & (summary != "No summary available.")
    return F.when(use, F.concat(first, F.lit("."))).otherwise(F.concat(F.lit("Flagged as must-read: "), reason, F.lit(".")))


#: Reviewer attributions that are cut off the front, in this order.
ATTRIBUTION = (
    r"(?i)^(claude'?s?|gemini'?s?|gpt'?s?|both|all|the)\s+(review|reviews|analysis|analyses|evaluation|evaluations)\s+(found|agree|agrees|indicate|indicates|suggest|suggests|show|shows|note|notes|highlight|highlights)\s+(that\s+)?",
    r"(?i)^according to (the )?(claude'?s?|gemini'?s?|gpt'?s?|reviewers?|analysis|analyses),?\s*",
    r"(?i)^(both|all) (reviewers?|models?|analyses) (agree|note|highlight|found|suggest)\s+(that\s+)?",
    r"(?i)^the (claude|gemini|gpt|ai|model) (review|analysis) (found|indicates|suggests|notes)\s+(that\s+)?",
)


def capital(c: Column) -> Column:
    """The capital of one letter, as one letter: ß gives ẞ, and letters whose capital takes several letters stay."""
    up = F.upper(c)
    return F.when(F.length(up) <= 1, up).otherwise(F.translate(c, "ß", "ẞ"))


def clean_reason(c: Column) -> Column:
    """Attribution removed, first letter a capital, at most two sentences."""
    c = F.trim(F.coalesce(c, F.lit("")))
    for p in ATTRIBUTION:
        c = F.regexp_replace(c, p, "")
    c = F.concat(capital(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))
    parts = F.split(c, r"(?<=[.!?])\s+")
    two = F.array_join(F.slice(parts, 1, 2), " ")
    two = F.when(F.endswith(two, F.lit(".")), two).otherwise(F.concat(two, F.lit(".")))
    return F.trim(F.when(F.size(parts) > 2, two).otherwise(c))


#: Topics looked for in a title, in this order.
TOPIC_CANCERS = ("lung", "breast", "colorectal", "pancreatic", "prostate", "ovarian", "liver")
TOPIC_TERMS = ("screening", "early detection", "biomarker", "liquid biopsy", "ctDNA", "diagnostic")


def _first_in(c: Column, words: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.when(F.contains(c, F.lit(w)), F.lit(w)) for w in words], F.lit(None).cast("string"))


def fallback_reason(title: Column, source: Column, venue: Column) -> Column:
    """A sentence made from the topic words of the title, else from venue or source."""
    low = F.lower(F.coalesce(title, F.lit("")))
    cancer, term = _first_in(low, TOPIC_CANCERS), _first_in(low, TOPIC_TERMS)
    return (
        F.when(cancer.isNotNull() & term.isNotNull(), F.format_string("This study addresses %s cancer %s, a key area for early detection research.", cancer, term))
        .when(cancer.isNotNull(), F.format_string("This research focuses on %s cancer, contributing to the early detection knowledge base.", cancer))
        .when(term.isNotNull(), F.format_string("This study explores %s methods relevant to cancer early detection.", term))
        .when(blank_to_null(venue).isNotNull(), F.format_string("Published in %s, this study may offer insights relevant to cancer early detection research.", venue))
        .when(blank_to_null(source).isNotNull(), F.format_string("From %s, this publication may contain findings relevant to early detection efforts.", source))
        .otherwise("This publication was identified as potentially relevant to cancer early detection research.")
    )


def ordinal_label(score: Column) -> Column:
    return F.when(score >= 80, "High").when(score >= 65, "Moderate").otherwise("Exploratory")


def truncated(c: Column, most: int = 1200) -> Column:
    """At most `most` characters: cut after the last period in the second half, else with '...'."""
    head = F.substring(c, 1, most)
    last = most - F.locate(".", F.reverse(head)) + 1
    has = (F.locate(".", F.reverse(head)) > 0) & (last > most / 2)
    return F.when(F.length(c) <= most, c).when(has, F.substring(head, F.lit(1), last.cast("int"))).otherwise(F.concat(F.rtrim(F.substring(c, 1, most - 3)), F.lit("...")))


def slug(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "-"), F.lit("-"))


def tags(c: Column, by_word: dict[str, str], venue: Column | None = None) -> Column:
    """Tags whose word occurs, then the slug of the venue, without repeats."""
    low = F.lower(F.coalesce(c, F.lit("")))
    found = [F.when(F.contains(low, F.lit(w)), F.lit(t)) for w, t in by_word.items()]
    return F.array_distinct(F.array_compact(F.array(*found, *([blank_to_null(slug(venue))] if venue is not None else []))))


def preview(c: Column, n: int = 200) -> Column:
    return F.substring(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\r\n\t]+", " "), 1, n)


def trigrams(c: Column) -> Column:
    """Phrases of three neighbouring words."""
    joined = lambda a, b: F.concat(a, F.lit(" "), b)
    after = lambda w, n: F.slice(w, F.lit(n + 1), F.greatest(F.lit(0), F.size(w) - n))
    # zipped with itself shifted; bound to one name, so the text is split once
    phrases = lambda w: F.array_compact(F.zip_with(F.zip_with(w, after(w, 1), joined), after(w, 2), joined))
    return F.transform(F.array(F.split(squeeze(F.lower(c)), " ")), phrases)[0]


def shares_trigram(title: Column, text: Column) -> Column:
    low = squeeze(F.lower(F.coalesce(text, F.lit(""))))
    return F.exists(trigrams(title), lambda g: F.contains(low, g))


def jaccard(a: Column, b: Column) -> Column:
    """Share of words of two keys in common."""
    x, y = F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " "))
    return F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))


def rationale(labels: Column) -> Column:
    """'[source/rater] text' of the labels that have a rationale, joined by ' | '."""
    some = F.filter(labels, lambda l: F.coalesce(l["rationale"], F.lit("")) != "")
    return F.array_join(F.transform(some, lambda l: F.concat(F.lit("["), l["source"], F.lit("/"), l["rater"], F.lit("] "), l["rationale"])), " | ")
