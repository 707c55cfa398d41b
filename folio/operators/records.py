"""Record shapes: wire rows, facts, reports, briefs, seeds and citation lanes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.functions.text import blank_to_null, truncated


def wire(df: DataFrame, full: bool = False, snippet: int = 500) -> DataFrame:
    """The public columns of a publication; `full` adds the text."""
    cols = ["id", "title", "source", F.coalesce(blank_to_null(F.col("venue")), "source").alias("venue"), F.col("published_date").cast("string").alias("published_date"), "url", F.substring(F.coalesce(blank_to_null(F.col("summary")), "raw_text", F.lit("")), 1, snippet).alias("summary")]
    return df.select(*cols, *(["raw_text"] if full else []))


def rerank_input(df: DataFrame, title: int = 250, snippet: int = 400) -> DataFrame:
    return df.select("id", F.substring("title", 1, title).alias("title"), F.substring(F.coalesce(blank_to_null(F.col("summary")), blank_to_null(F.col("raw_text")), F.lit("")), 1, snippet).alias("snippet"))


#: Topic tags and their words, in this order.
TAG_WORDS = {
    "breath-analysis": ("breath", "voc", "volatile organic", "exhaled"),
    "early-detection": ("early detection", "early diagnosis", "screening", "early-stage"),
    "diagnostics": ("diagnostic", "biomarker", "biosensor", "point-of-care"),
    "liquid-biopsy": ("liquid biopsy", "ctdna", "cell-free", "circulating tumor"),
    "clinical-trial": ("clinical trial", "clinical study", "phase i", "phase ii", "phase iii", "randomized"),
    "ai-ml": ("machine learning", "deep learning", "artificial intelligence", "neural network"),
}


def topic_tags(title: Column, summary: Column, venue: Column) -> Column:
    """'scientific', the topics whose words occur, the venue as a tag if it is short, 'high-relevancy'."""
    low = F.lower(F.concat_ws(" ", title, summary))
    found = []
    for tag, words in TAG_WORDS.items():
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(low, F.lit(w))
        found.append(F.when(hit, F.lit(tag)))
    v = F.lower(F.trim(F.coalesce(venue, F.lit(""))))
    for end in (" journal", " reviews", " communications"):
        v = F.replace(v, F.lit(end), F.lit(""))
    v = F.trim(F.regexp_replace(v, "[^a-z0-9]+", "-"), F.lit("-"))
    return F.array_compact(F.array(F.lit("scientific"), *found, F.when((v != "") & (F.length(v) <= 30), v), F.lit("high-relevancy")))


def fact_text(title: Column, raw_text: Column, venue: Column, most: int = 1200) -> Column:
    return truncated(F.concat_ws("\n\n", blank_to_null(title), F.concat(F.lit("Published in: "), blank_to_null(venue)), blank_to_null(F.trim(raw_text))), most)


def facts(df: DataFrame, least: int = 80) -> DataFrame:
    """Rows with a score of `least` or more, a title and a text, as facts."""
    d = df.where((F.col("score") >= least) & (F.coalesce(F.trim("title"), F.lit("")) != "") & (F.coalesce(F.trim("raw_text"), F.lit("")) != ""))
    return d.select(F.col("id").alias("source_id"), fact_text(F.col("title"), F.col("raw_text"), F.col("venue")).alias("fact"), topic_tags(F.col("title"), F.lit(""), F.col("venue")).alias("tags"))


def change_report(changes: DataFrame, cap: int = 10) -> DataFrame:
    """(source, place, line): a Markdown line for each of the newest `cap` rows of a source, then one that counts the rest."""
    w = Window.partitionBy("source").orderBy(F.col("published_date").desc_nulls_last(), "id")
    top = changes.withColumn("place", F.row_number().over(w)).where(F.col("place") <= cap)
    lines = top.select("source", "place", F.concat(F.lit("- ["), F.coalesce("status", F.lit("")), F.lit("] "), F.col("title"), F.lit(" ("), F.coalesce(F.col("published_date").cast("string"), F.lit("no date")), F.lit(")")).alias("line"))
    rest = changes.groupBy("source").agg((F.count(F.lit(1)) - cap).alias("n")).where("n > 0").select("source", F.lit(cap + 1).alias("place"), F.format_string("- and %d more", "n").alias("line"))
    return lines.unionByName(rest)


def must_read_lines(df: DataFrame) -> DataFrame:
    """Numbered Markdown lines of ranked rows."""
    return df.select("rank", F.concat(F.col("rank").cast("string"), F.lit(". **"), F.col("title"), F.lit("** - "), F.coalesce("source", F.lit("")), F.lit(", score "), F.coalesce(F.col("score").cast("string"), F.lit("-"))).alias("line"))


def brief(items: DataFrame, section: str, n: int = 10) -> DataFrame:
    """One row: the section's name, its first n items by rank as structs, and their number; an empty section has none."""
    top = items.orderBy("rank").limit(n).agg(F.array_sort(F.collect_list(F.struct("rank", "title", "url", "source"))).alias("items"))
    with_meta = lambda i: F.struct(i["rank"].alias("rank"), i["title"].alias("title"), i["url"].alias("url"), F.create_map(F.lit("source"), i["source"]).alias("meta"))
    top = top.withColumn("items", F.transform("items", with_meta))
    return top.select(F.lit(section).alias("section"), "items", F.size("items").alias("n_items"), F.when(F.size("items") == 0, "empty").otherwise("ok").alias("status"))


def items_to_seeds(df: DataFrame) -> DataFrame:
    """The best identifier of each item: DOI, then PMID, URL, id, title."""
    order = (("doi", "doi"), ("pmid", "pmid"), ("url", "url"), ("publication_id", "id"), ("title", "title"))
    best = F.coalesce(*[F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.struct(F.lit(kind).alias("type"), F.col(c).cast("string").alias("value"))) for c, kind in order if c in df.columns])
    return df.withColumn("_s", best).select(*df.columns, "_s.type", "_s.value")


def citation_lane(seeds: DataFrame, citations: DataFrame, top: int = 20) -> DataFrame:
    """Distinct ids that cite or are cited by the top seeds with a DOI or PMID (citations: id, cited_by[], references[])."""
    s = seeds.where("doi IS NOT NULL OR pmid IS NOT NULL").orderBy(F.col("score").desc_nulls_last(), "id").limit(top)
    return citations.join(s.select("id"), "id").select(F.explode(F.array_union(F.coalesce("cited_by", F.array().cast("array<string>")), F.coalesce("references", F.array().cast("array<string>")))).alias("neighbour")).distinct()


def lanes(**by_name: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with their lane, counts a lane)."""
    out = None
    for name, df in by_name.items():
        part = df.withColumn("lane", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out, out.groupBy("lane").agg(F.count(F.lit(1)).alias("n"))


def long_labels(df: DataFrame, key: str, labels: str) -> DataFrame:
    """One row a label."""
    return df.select(key, F.explode_outer(labels).alias("l")).select(key, "l.*")


def funnel_counts(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Rows that pass each flag, in one aggregate."""
    return df.agg(F.count(F.lit(1)).alias("raw"), *[F.count_if(c).alias(k) for k, c in flags.items()])


def reject_reasons(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Rows by the first check that fails."""
    reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks.items()], F.lit("ok"))
    return df.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def off_topic(text: Column, categories: dict[str, tuple[str, ...]], relevant: tuple[str, ...]) -> Column:
    """The first word of each category that occurs, unless a relevant word does."""
    low = F.lower(F.coalesce(text, F.lit("")))
    ok = F.lit(False)
    for w in relevant:
        ok = ok | F.contains(low, F.lit(w))
    hits = [F.coalesce(*[F.when(F.contains(low, F.lit(w)), F.concat(F.lit(f"{name}:"), F.lit(w))) for w in words], F.lit(None).cast("string")) for name, words in categories.items()]
    return F.when(ok, F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*hits)))


def canonical_item(df: DataFrame) -> DataFrame:
    """Evaluation items with clean identifiers, a title key and at least an empty list of labels."""
    from folio.functions.identifiers import comparable_url, normalize_doi, normalize_pmid, title_hash
    from folio.functions.text import title_key

    have = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    key = title_key(have("title"), "eval")
    labels = F.coalesce(F.col("labels"), F.array().cast(df.schema["labels"].dataType)) if "labels" in df.columns else F.array().cast("array<string>")
    return df.select(F.coalesce(blank_to_null(have("publication_id")), title_hash(key)).alias("publication_id"), F.trim(have("title")).alias("title"), key.alias("title_key"), normalize_doi(have("doi")).alias("doi"), normalize_pmid(have("pmid")).alias("pmid"), comparable_url(have("url")).alias("url"), labels.alias("labels"))


def paper_for_review(df: DataFrame) -> DataFrame:
    from folio.functions.text import sanitize

    text = lambda c: sanitize(F.col(c)) if c in df.columns else F.lit("")
    return df.select("id", *[text(c).alias(c) for c in ("title", "raw_text", "summary", "source")])


def sanitized(df: DataFrame, columns: tuple[str, ...] = ("title", "raw_text", "summary", "source")) -> DataFrame:
    """The record with its texts cleaned of control characters; other columns as they are."""
    from folio.functions.text import sanitize

    return df.withColumns({c: sanitize(F.col(c)) for c in columns if c in df.columns})


def enriched(pubs: DataFrame, must_reads: DataFrame, reviews: DataFrame, key: str = "id") -> DataFrame:
    """The digest's record of each publication: its own columns first, then must-reads, reviews and the evaluator's JSON.

    must_reads and reviews have one row an id at most and any of the columns named here; a score of zero
    is a score. Each side is one left join, and all fallbacks are one projection.
    """
    from folio.functions import jsonx, text
    from folio.functions.identifiers import link

    m = must_reads.select(F.col(key).alias("_mk"), F.struct(*[c for c in must_reads.columns if c != key]).alias("m"))
    t = reviews.select(F.col(key).alias("_tk"), F.struct(*[c for c in reviews.columns if c != key]).alias("t"))
    d = pubs.join(m, F.col(key) == F.col("_mk"), "left").join(t, F.col(key) == F.col("_tk"), "left")
    none = F.lit(None).cast("string")
    p_ = lambda c: F.col(c) if c in pubs.columns else none
    m_ = lambda c: F.col(f"m.{c}") if c in must_reads.columns else none
    t_ = lambda c: F.col(f"t.{c}") if c in reviews.columns else none
    own = F.col("final_relevancy_score") if "final_relevancy_score" in pubs.columns else F.lit(None).cast("int")
    legacy = own.isNull()
    e_ = lambda c: F.when(legacy, F.get_json_object(t_("gpt_eval_json"), f"$.{c}"))
    filled = lambda *c: F.coalesce(*[blank_to_null(x.cast("string")) for x in c])
    whole = lambda c: c.cast("int")
    score = F.coalesce(own, whole(t_("final_relevancy_score")), whole(e_("final_relevancy_score")), whole(m_("final_relevancy_score")), whole(p_("relevancy_score")))
    reviewer = lambda name: F.coalesce(whole(p_(f"{name}_score")), jsonx.review_score(t_(f"{name}_review_json")))
    reason = text.clean_reason(filled(p_("final_relevancy_reason"), m_("final_relevancy_reason"), t_("final_relevancy_reason"), e_("final_relevancy_reason")))
    listed = F.from_json(m_("key_findings"), "array<string>")
    findings = F.when(listed.isNotNull(), F.slice(listed, 1, 3)).when(blank_to_null(m_("key_findings")).isNotNull(), F.array(m_("key_findings"))).otherwise(text.key_findings(filled(m_("final_summary"), p_("summary"))))
    credibility = F.coalesce(whole(p_("credibility_score")), whole(m_("credibility_score")))
    return d.select(
        key, F.coalesce(blank_to_null(p_("title")), F.lit("Untitled Publication")).alias("title"), F.coalesce(blank_to_null(p_("source")), F.lit("Unknown Source")).alias("source"),
        F.coalesce(blank_to_null(p_("venue")), blank_to_null(p_("source")), F.lit("Unknown Venue")).alias("venue"), p_("published_date").alias("published_date"), link(p_("canonical_url"), p_("url"), p_("doi"), p_("pmid")).alias("link"),
        score.alias("relevancy_score"), text.ordinal_label(score).alias("relevancy_ordinal"), credibility.alias("credibility_score"), reviewer("claude").alias("claude_score"), reviewer("gemini").alias("gemini_score"),
        F.coalesce(blank_to_null(reason), text.fallback_reason(p_("title"), p_("source"), p_("venue"))).alias("why_it_matters"),
        F.coalesce(filled(p_("final_summary"), m_("final_summary"), t_("final_summary"), e_("final_summary"), p_("summary")), F.substring(p_("raw_text"), 1, 500), F.lit("")).alias("summary"),
        findings.alias("key_findings"), F.coalesce(p_("confidence").cast("string"), m_("confidence").cast("string"), t_("confidence").cast("string"), e_("confidence"), m_("credibility_confidence"), F.lit("")).alias("confidence"),
        F.coalesce(filled(p_("agreement_level"), m_("agreement_level"), t_("agreement_level"), e_("agreement_level")), F.lit("")).alias("agreement_level"), jsonx.as_list(filled(p_("disagreements"), e_("disagreements"))).alias("disagreements"),
        F.coalesce(filled(p_("credibility_signals_json"), m_("credibility_signals")), F.lit("{}")).alias("commercial_signals"), F.coalesce(filled(p_("credibility_reason"), m_("credibility_reason")), F.lit("")).alias("credibility_reason"),
    )


def must_reads_document(ranked: DataFrame, run_id: str, top: int = 5, score: str = "final_relevancy_score", key: str = "id") -> DataFrame:
    """One row for the must-reads file of a run: counts and the best rows as a list of structs with what columns they have."""
    best = ranked.orderBy(F.coalesce(F.col(score), F.lit(0)).desc(), key).limit(top)
    order = F.struct((-F.coalesce(F.col(score), F.lit(0))).alias("o"), F.col(key).alias("k"), F.struct(*ranked.columns).alias("r"))
    one = best.agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["r"]).alias("must_reads"))  # `top` rows
    total = ranked.agg(F.count(F.lit(1)).alias("total_candidates"))
    return one.crossJoin(F.broadcast(total)).select(F.lit(run_id).alias("run_id"), "total_candidates", F.size("must_reads").alias("must_reads_count"), "must_reads")


SECTION = "tool_id string, section_title string, period_start string, period_end string, narrative string, items array<string>"


def normalized_section(answers: DataFrame, json: str, fallback: dict[str, str]) -> DataFrame:
    """Sections from untrusted JSON: fields that are missing or garbled come from `fallback`, items are cleaned, others dropped."""
    s = answers.withColumn("_s", F.from_json(json, SECTION))
    item = lambda x: F.struct(F.coalesce(blank_to_null(F.trim(F.get_json_object(x, "$.title"))), F.lit("Untitled")).alias("title"), F.coalesce(F.trim(F.get_json_object(x, "$.summary")), F.lit("")).alias("summary"), F.get_json_object(x, "$.url").alias("url"), F.when(F.startswith(F.get_json_object(x, "$.meta"), F.lit("{")), F.get_json_object(x, "$.meta")).otherwise("{}").alias("meta"))
    items = F.transform(F.filter(F.coalesce("_s.items", F.array().cast("array<string>")), lambda x: F.startswith(F.trim(x), F.lit("{"))), item)
    fields = {c: F.coalesce(blank_to_null(F.col(f"_s.{c}")), F.lit(fallback.get(c))) for c in ("tool_id", "section_title", "period_start", "period_end")}
    return s.withColumns({**fields, "narrative": blank_to_null(F.col("_s.narrative")), "items": items}).drop("_s")


def flat_events(results: DataFrame, run_id: str, mode: str, reviewers: tuple[str, ...] = ("claude", "gemini"), names: dict[str, str] | None = None) -> DataFrame:
    """Review results as events for JSON lines: the evaluator's fields at the top, reviews only where they succeeded.

    results: id, title, source, url, for each reviewer <name>_review (struct success, review, latency_ms,
    model), evaluation (struct of the evaluator's fields).
    """
    done = lambda n: F.col(f"{n}_review.success")
    when_done = lambda n, f: F.when(done(n), F.col(f"{n}_review.{f}"))
    top = ("final_relevancy_score", "final_relevancy_reason", "final_summary", "agreement_level", "confidence")
    fields = [f for f in top if f in results.select("evaluation.*").columns]
    models = F.struct(*[when_done(n, "model").alias(n) for n in reviewers])
    return results.select(
        F.lit(run_id).alias("run_id"), F.lit(mode).alias("mode"), F.col("id").alias("publication_id"), "title", "source", "url",
        *[when_done(n, "review").alias(f"{n}_review") for n in reviewers], F.to_json("evaluation").alias("gpt_eval"), *[F.col(f"evaluation.{f}").alias(f) for f in fields],
        models.alias("model_names"), *[when_done(n, "latency_ms").alias(f"{n}_latency_ms") for n in reviewers],
    )
