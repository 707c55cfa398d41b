"""JSON in free text: find the object, repair it, and validate reviews and evaluations as columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions.text import blank_to_null


def strip_fences(c: Column) -> Column:
    """The body of a fenced block that begins the text, else the text."""
    t = F.trim(F.coalesce(c, F.lit("")))
    body = F.regexp_replace(F.regexp_replace(t, r"^```[^\n]*\n?", ""), r"\n\s*```[^\n]*$", "")
    return F.trim(F.when(F.startswith(t, F.lit("```")), body).otherwise(t))


def no_trailing_commas(c: Column) -> Column:
    return F.regexp_replace(c, r",\s*([}\]])", "$1")


def object_text(c: Column) -> Column:
    """From the first '{' to the last '}', repaired; null if there is none."""
    return no_trailing_commas(blank_to_null(F.regexp_extract(strip_fences(c), r"(?s)\{.*\}", 0)))


def parses(c: Column) -> Column:
    """Is the object text valid JSON?"""
    return F.try_parse_json(object_text(c)).isNotNull()


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once a row, however often f names it."""
    return F.transform(F.array(value), f)[0]


def _fields(o: Column, *names: str) -> Column:
    """struct(object, names) of an object text: does it parse, and its fields as texts."""
    return F.struct(F.try_parse_json(o).isNotNull().alias("object"), *[F.get_json_object(o, f"$.{n}").alias(n) for n in names])


def field(c: Column, name: str) -> Column:
    return F.get_json_object(object_text(c), f"$.{name}")


def first_field(c: Column, *names: str) -> Column:
    return F.coalesce(*[blank_to_null(field(c, n)) for n in names])


def confidence_label(uncertainty: Column) -> Column:
    """low, medium or high from an uncertainty given as a number or in words."""
    low = F.lower(F.trim(uncertainty))
    number = F.when(F.rlike(low, F.lit(r"^-?\d+(\.\d+)?$")), low).cast("double")
    sure = 1 - number
    worded = F.when(F.contains(low, F.lit("low")), "high").when(F.contains(low, F.lit("high")), "low").otherwise("medium")
    return F.when(sure < 0.4, "low").when(sure < 0.7, "medium").when(sure.isNotNull(), "high").otherwise(worded)


def _list_text(c: Column, name: str) -> Column:
    return F.from_json(F.get_json_object(c, f"$.{name}"), "array<string>")


def review(c: Column, version: str = "v3") -> Column:
    """struct(relevancy_score, relevancy_reason, confidence, summary, concerns, valid) of a reviewer's answer."""
    return _once(object_text(c), lambda o: _reviewed(o, version))


def _reviewed(o: Column, version: str) -> Column:
    get = lambda n: F.get_json_object(o, f"$.{n}")
    whole = lambda x: F.when(F.rlike(x, F.lit(r"^-?\d+$")), x).cast("int")
    score = F.coalesce(whole(get("relevancy_score")), whole(get("relevancy_score_0_100")))
    if version.startswith("v1"):
        score = F.coalesce(score, F.least(F.lit(100), F.greatest(F.lit(0), whole(get("relevancy_rating_0_3")) * 33)))
    reason = F.coalesce(get("relevancy_reason"), F.array_join(_list_text(o, "key_reasons"), "; "), get("summary"))
    confidence = F.coalesce(get("confidence"), F.when(get("uncertainty").isNotNull(), confidence_label(get("uncertainty"))), F.lit("medium"))
    raw = get("concerns")
    listed = F.filter(F.transform(F.coalesce(_list_text(o, "concerns"), F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != "")
    concerns = F.when(raw.isNull() | F.lower(F.trim(raw)).isin("", "none"), F.array().cast("array<string>")).when(F.startswith(F.trim(raw), F.lit("[")), listed).otherwise(F.array(F.trim(raw)))
    valid = F.try_parse_json(o).isNotNull() & score.between(0, 100) & reason.isNotNull()
    return F.struct(score.alias("relevancy_score"), reason.alias("relevancy_reason"), confidence.alias("confidence"), F.coalesce(get("summary"), F.lit("")).alias("summary"), concerns.alias("concerns"), F.coalesce(valid, F.lit(False)).alias("valid"))


def evaluation(c: Column) -> Column:
    """struct(final_score, final_rating, final_reason, confidence, final_summary, error) of an evaluator's answer."""
    whole = lambda x: F.when(F.rlike(x, F.lit(r"^-?\d+$")), x).cast("int")

    def judged(x: Column) -> Column:
        score, rating, reason = x["final_relevancy_score"], x["final_relevancy_rating_0_3"], x["final_relevancy_reason"]
        error = (
            F.when(~x["object"], "no object")
            .when(score.isNull() | rating.isNull() | reason.isNull(), "missing field")
            .when(whole(score).isNull() | whole(rating).isNull(), "wrong type")
            .when(~whole(score).between(0, 100), "score out of range")
            .when(~whole(rating).between(0, 3), "rating out of range")
        )
        sure = F.coalesce(F.greatest(F.lit(0), F.least(F.lit(100), F.when(F.rlike(x["confidence"], F.lit(r"^-?\d+(\.\d+)?$")), x["confidence"]).cast("double").cast("int"))), F.lit(60))
        return F.struct(error.alias("error"), whole(score).alias("score"), whole(rating).alias("rating"), reason.alias("reason"), sure.alias("sure"), F.coalesce(x["final_summary"], reason).alias("summary"))

    def kept(x: Column) -> Column:
        ok = x["error"].isNull()
        return F.struct(F.when(ok, x["score"]).alias("final_score"), F.when(ok, x["rating"]).alias("final_rating"), F.when(ok, x["reason"]).alias("final_reason"), F.when(ok, x["sure"]).alias("confidence"), F.when(ok, x["summary"]).alias("final_summary"), x["error"].alias("error"))

    read = lambda o: _fields(o, "final_relevancy_score", "final_relevancy_rating_0_3", "final_relevancy_reason", "confidence", "final_summary")
    return _once(_once(_once(object_text(c), read), judged), kept)


def ranked_ids(c: Column) -> Column:
    """The list ranked_ids of an answer: parsed, else every quoted string after its opening bracket (cut-off answers)."""
    o = blank_to_null(F.regexp_extract(strip_fences(c), r"(?s)\{.*\}", 0))
    parsed = F.from_json(F.get_json_object(o, "$.ranked_ids"), "array<string>")
    body = F.regexp_extract(F.coalesce(c, F.lit("")), r'(?s)"ranked_ids"\s*:\s*\[([^\]]*)', 1)
    found = F.regexp_extract_all(body, F.lit(r'"([^"]+)"'), F.lit(1))
    return F.coalesce(parsed, F.when(F.size(found) > 0, found))


def review_score(json: Column) -> Column:
    """relevancy_score inside `review`, else at the top."""
    return F.coalesce(F.get_json_object(json, "$.review.relevancy_score"), F.get_json_object(json, "$.relevancy_score")).cast("int")


def as_list(c: Column) -> Column:
    """A text that may be null, a JSON list or plain words, as an array."""
    t = F.trim(c)
    return F.when(t.isNull() | (t == ""), F.array().cast("array<string>")).when(F.startswith(t, F.lit("[")), F.coalesce(F.from_json(t, "array<string>"), F.array(t))).otherwise(F.array(t))


def scored(c: Column, score: str = "credibility_score", reason: str = "credibility_reason") -> Column:
    """struct(score, reason, confidence, valid) of an answer with one score from 0 to 100 and a reason."""

    def judged(x: Column) -> Column:
        n = F.when(F.rlike(x[score], F.lit(r"^-?\d+$")), x[score]).cast("int")
        why, label = blank_to_null(x[reason]), F.lower(x["confidence"])
        sure = F.when(label.isin("low", "medium", "high"), label).otherwise("medium")
        ok = F.coalesce(x["object"] & n.between(0, 100) & why.isNotNull(), F.lit(False))
        return F.struct(F.when(ok, n).alias("score"), F.when(ok, why).alias("reason"), F.when(ok, sure).alias("confidence"), ok.alias("valid"))

    return _once(_once(object_text(c), lambda o: _fields(o, score, reason, "confidence")), judged)
