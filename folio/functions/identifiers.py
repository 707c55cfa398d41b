"""Identifiers and URLs as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions.dates import page_date
from folio.functions.text import blank_to_null

#: Patterns of identifiers in running text.
DOI = r"(10\.\d{4,}/[^\s'\"<>\[\]]+)"
PMID = r"(?i)(?:pmid[:\s]*|pubmed\.ncbi\.nlm\.nih\.gov/)(\d{7,8})"
ARXIV = r"(?i)(?:arxiv[:\s]*|arxiv\.org/abs/)(\d{4}\.\d{4,5}(?:v\d+)?)"

#: What stands before a DOI in a URL, tried in this order; the last form takes one anywhere.
URL_DOI = (r"doi\.org/(10\.[^\s/]+/\S+)", r"doi/(10\.[^\s/]+/\S+)", r"(10\.\d{4,}/\S+)")
#: Places of a DOI in the URLs of publishers, tried in this order.
PUBLISHER_PLACES = (r"doi\.org/", r"dx\.doi\.org/", r"nature\.com/articles/", r"science\.org/doi/", r"cell\.com/.*/", r"nejm\.org/doi/full/", r"thelancet\.com/.*/", r"plos\.org/.*/", r"biorxiv\.org/.*/", r"medrxiv\.org/.*/")
#: The ids in PubMed URLs, after the host and at the end of the path.
PUBMED_PATH = r"(?i)pubmed\.ncbi\.nlm\.nih\.gov/(\d+)"
PUBMED_END = r"/(\d{7,8})/?(?:\?|$)"
#: The DOI form of JSON-LD values and the fields that may hold one, tried in this order.
LD_DOI = r"10\.\d{4,}/[^\s\"'<>)}\]]+[^\s\"'<>)}\].,;:]"
LD_DOI_FIELDS = ("doi", "@id", "identifier", "sameAs", "url")

#: Query parameters that only track visits.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "ref", "source", "mc_cid", "mc_eid", "_hsenc", "_hsmi")
#: Substrings that tell the type of a source, in this order.
SOURCE_TYPES = (("pubmed", "pubmed"), ("biorxiv", "biorxiv"), ("medrxiv", "medrxiv"), ("arxiv", "arxiv"), ("nature.com", "nature"), ("science.org", "science"), ("sciencemag.org", "science"), ("cell.com", "cell"), ("thelancet.com", "lancet"), ("nejm.org", "nejm"), ("jama", "jama"))


def extracted(c: Column, pattern: str, group: int = 1) -> Column:
    return blank_to_null(F.regexp_extract(F.coalesce(c, F.lit("")), pattern, group))


def doi_in(text: Column) -> Column:
    """The first DOI, lower-case, without end punctuation and without prose that runs on."""
    d = F.rtrim(F.lower(extracted(text, DOI)), F.lit(".,;:)"))
    return F.regexp_replace(d, r"([^a-z])[a-z]{2,}$", "$1")


def plain_doi(text: Column) -> Column:
    """The first DOI with nothing but end punctuation cut, as dedupe keys have it."""
    return F.rtrim(F.lower(extracted(text, r"(10\.\d{4,}/\S+)")), F.lit(".,;)"))


def normalize_doi(c: Column) -> Column:
    d = F.regexp_replace(F.lower(F.trim(c)), r"^(https?://(dx\.)?doi\.org/|doi:\s*)", "")
    return F.when(F.startswith(d, F.lit("10.")), d)


def doi_in_url(url: Column) -> Column:
    """DOI of a URL by the first form that fits; end slashes cut."""
    found = F.coalesce(*[extracted(url, f"(?i){p}") for p in URL_DOI])
    return normalize_doi(F.regexp_replace(found, r"[/\s]+$", ""))


def publisher_doi(url: Column) -> Column:
    """DOI at one of the known places of publishers' URLs, as it is written, without query and end punctuation."""
    found = F.coalesce(*[extracted(url, rf"(?i){p}(10\.\d{{4,}}/[^\s?#]+)") for p in PUBLISHER_PLACES])
    return F.regexp_replace(found, r"[.,;:]+$", "")


def pubmed_path_pmid(url: Column) -> Column:
    """The digits after the host of PubMed."""
    return extracted(url, PUBMED_PATH)


def pubmed_end_pmid(url: Column) -> Column:
    """Seven or eight digits that end the path of a PubMed URL."""
    return F.when(F.contains(url, F.lit("pubmed.ncbi.nlm.nih.gov")), extracted(url, PUBMED_END))


def normalize_pmid(c: Column) -> Column:
    return blank_to_null(F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", ""))


def pmid_in(text: Column) -> Column:
    return extracted(text, PMID)


def pmid_in_url(url: Column) -> Column:
    return F.coalesce(extracted(url, r"(?i)pubmed.*?/(\d+)"), extracted(url, r"(?i)PMID:?\s*(\d+)"))


def arxiv_in(text: Column) -> Column:
    return extracted(text, ARXIV)


def source_type(url: Column, source: Column) -> Column:
    both = F.lower(F.concat_ws(" ", F.coalesce(url, F.lit("")), F.coalesce(source, F.lit(""))))
    out = F.when(both == " ", None)
    for part, kind in SOURCE_TYPES:
        out = out.when(F.contains(both, F.lit(part)), kind)
    return out.otherwise("rss")


def normalize_url(c: Column) -> Column:
    """https, lower-case host, no tracking parameters, fragment or end slash; null for other schemes or no host."""
    u = F.trim(c)
    scheme = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    host = F.lower(F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    rest = F.regexp_replace(u, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*", "")
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: F.rlike(p, F.lit("^[^=]+=.")) & ~F.lower(F.split_part(p, F.lit("="), F.lit(1))).isin(*TRACKING))
    path = F.regexp_replace(F.regexp_extract(rest, r"^([^?#]*)", 1), r"(\d)[A-Za-z]{2,}$", "$1")

    def built(x: Column) -> Column:
        """From the parts, each made once a row."""
        path = F.when(x["path"] == "/", x["path"]).otherwise(F.rtrim(x["path"], F.lit("/")))
        tail = F.when(F.size(x["kept"]) > 0, F.concat(F.lit("?"), F.array_join(x["kept"], "&"))).otherwise("")
        return F.when(x["scheme"].isin("", "http", "https") & (x["host"] != ""), F.concat(F.lit("https://"), x["host"], path, tail))

    return F.transform(F.array(F.struct(scheme.alias("scheme"), host.alias("host"), path.alias("path"), kept.alias("kept"))), built)[0]


def doi_url(doi: Column) -> Column:
    return F.concat(F.lit("https://doi.org/"), doi)


def pubmed_url(pmid: Column) -> Column:
    return F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), pmid, F.lit("/"))


def resolve(url: Column, doi: Column, pmid: Column, source: Column, raw_text: Column, title: Column) -> Column:
    """struct(canonical_url, doi, pmid, source_type): by DOI, else PMID, else arXiv id, else the URL itself."""
    text = F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in (url, doi, pmid, raw_text, title)])
    d, p = F.coalesce(blank_to_null(doi), doi_in(text)), F.coalesce(blank_to_null(pmid), pmid_in(text))
    a = arxiv_in(text)
    kind = F.coalesce(source_type(url, source), F.when(a.isNotNull(), "arxiv"))
    best = normalize_url(F.coalesce(doi_url(d), pubmed_url(p), F.concat(F.lit("https://arxiv.org/abs/"), a), url))  # those made here have a host
    return F.struct(best.alias("canonical_url"), d.alias("doi"), p.alias("pmid"), kind.alias("source_type"))


def link(canonical: Column, url: Column, doi: Column, pmid: Column) -> Column:
    return F.coalesce(normalize_url(blank_to_null(canonical)), normalize_url(blank_to_null(url)), normalize_url(F.coalesce(doi_url(blank_to_null(doi)), pubmed_url(blank_to_null(pmid)))))


def comparable_url(c: Column) -> Column:
    return F.rtrim(F.lower(F.trim(c)), F.lit("/"))


def sha256(*parts: Column, sep: str = "|") -> Column:
    return F.sha2(F.concat_ws(sep, *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def record_id(title: Column, source: Column, url: Column) -> Column:
    return sha256(title, source, url)


def seed_id(doi: Column, pmid: Column, url: Column, value: Column) -> Column:
    first = F.coalesce(*[blank_to_null(c) for c in (doi, pmid, url, value)])
    return F.sha2(F.concat(F.lit("seed:"), first), 256)


def content_hash(text: Column) -> Column:
    return F.sha2(F.lower(F.trim(text)), 256)


def title_hash(key: Column) -> Column:
    return F.substring(F.sha2(key, 256), 1, 16)


def list_hash(words: Column) -> Column:
    """16 hex digits of the sha-256 of the sorted list as JSON with ', ' between items."""
    body = F.concat(F.lit('["'), F.array_join(F.array_sort(words), '", "'), F.lit('"]'))
    return F.substring(F.sha2(F.when(F.size(words) > 0, body).otherwise("[]"), 256), 1, 16)


def hmac_sha256(key: str, message: Column) -> Column:
    """HMAC from two nested sha2 calls over padded keys."""
    import hashlib

    k = key.encode()
    k = (hashlib.sha256(k).digest() if len(k) > 64 else k).ljust(64, b"\0")
    inner, outer = bytes(b ^ 0x36 for b in k), bytes(b ^ 0x5C for b in k)
    first = F.unhex(F.sha2(F.concat(F.lit(inner), message.cast("binary")), 256))
    return F.sha2(F.concat(F.lit(outer), first), 256)


def signed_url(base: str, key: str, **params: Column) -> Column:
    """base with the parameters in the order of their names and a signature over them."""
    query = F.concat_ws("&", *[F.concat(F.lit(f"{n}="), F.url_encode(params[n].cast("string"))) for n in sorted(params)])
    return F.concat(F.lit(base + "?"), query, F.lit("&sig="), hmac_sha256(key, query))


def signature_ok(url: Column, key: str) -> Column:
    query = F.regexp_extract(url, r"\?(.*)&sig=[0-9a-f]+$", 1)
    return F.coalesce(hmac_sha256(key, query) == F.regexp_extract(url, r"&sig=([0-9a-f]+)$", 1), F.lit(False))


#: Licence names that allow a copy to be attached, and the URL parts that tell them, most specific first.
ATTACHABLE = ("cc-by", "cc-by-sa", "cc0", "public-domain", "cc-by-nc", "cc-by-nc-sa", "cc-by-nc-nd")
LICENCE_URLS = (
    ("creativecommons.org/publicdomain/zero", "cc0"), ("creativecommons.org/publicdomain/mark", "public-domain"),
    ("creativecommons.org/licenses/by-nc-nd", "cc-by-nc-nd"), ("creativecommons.org/licenses/by-nc-sa", "cc-by-nc-sa"),
    ("creativecommons.org/licenses/by-nc", "cc-by-nc"), ("creativecommons.org/licenses/by-sa", "cc-by-sa"),
    ("creativecommons.org/licenses/by-nd", "cc-by-nd"), ("creativecommons.org/licenses/by", "cc-by"),
)


def licence(c: Column) -> Column:
    """The short name of a licence given by name or URL; 'unknown' if none is known."""
    low = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    out = F.when(low.isin(*ATTACHABLE, "bronze", "closed", "unknown"), low)
    for part, name in LICENCE_URLS:
        out = out.when(F.contains(low, F.lit(part)), name)
    return out.when(F.rlike(low, F.lit("public ?domain")), "public-domain").otherwise("unknown")


def attachable(name: Column) -> Column:
    return F.coalesce(F.lower(name).isin(*ATTACHABLE), F.lit(False))


def meta_content(html: Column, name: str) -> Column:
    """content of the first <meta> whose name or property is `name`, in either order of attributes."""
    n = name.replace(".", r"\.")
    a = extracted(html, rf"(?is)<meta[^>]*(?:name|property)=[\"']{n}[\"'][^>]*content=[\"']([^\"']*)[\"']")
    b = extracted(html, rf"(?is)<meta[^>]*content=[\"']([^\"']*)[\"'][^>]*(?:name|property)=[\"']{n}[\"']")
    return F.trim(F.coalesce(a, b))


def json_ld(html: Column) -> Column:
    """Bodies of the JSON-LD scripts of a page."""
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))


def ld_objects(html: Column) -> Column:
    """The JSON-LD objects of a page as texts; a list gives its items."""
    body = F.transform(json_ld(html), lambda b: F.trim(b))
    return F.flatten(F.transform(body, lambda b: F.when(F.startswith(b, F.lit("[")), F.coalesce(F.from_json(b, "array<string>"), F.array().cast("array<string>"))).otherwise(F.array(b))))


def _doi_of(c: Column) -> Column:
    return F.rtrim(blank_to_null(F.regexp_extract(F.coalesce(c, F.lit("")), LD_DOI, 0)), F.lit(".,;:"))


def ld_doi(o: Column) -> Column:
    """DOI of one JSON-LD object: each field may be a text, a structured identifier or a list of both."""
    found = []
    for name in LD_DOI_FIELDS:
        v = F.trim(F.get_json_object(o, f"$['{name}']"))
        named = lambda x: (F.get_json_object(x, "$['@type']") == "PropertyValue") & (F.get_json_object(x, "$.propertyID") == "doi")
        inner = F.coalesce(F.when(named(v), _doi_of(F.get_json_object(v, "$.value"))), _doi_of(F.coalesce(blank_to_null(F.get_json_object(v, "$.value")), F.get_json_object(v, "$['@value']"))))
        of_item = lambda x: F.when(F.startswith(F.trim(x), F.lit("{")), F.when(named(x), _doi_of(F.get_json_object(x, "$.value")))).otherwise(_doi_of(x))
        items = F.try_element_at(F.filter(F.transform(F.from_json(v, "array<string>"), of_item), lambda x: x.isNotNull()), F.lit(1))
        found.append(F.when(F.startswith(v, F.lit("{")), inner).when(F.startswith(v, F.lit("[")), items).otherwise(_doi_of(v)))
    return F.coalesce(*found)


def ld_metadata(o: Column) -> Column:
    """struct(title, published, source) of one JSON-LD object."""
    get = lambda n: blank_to_null(F.get_json_object(o, n))
    whole = get("$.publisher")
    publisher = F.when(F.startswith(whole, F.lit("{")), get("$.publisher.name")).otherwise(F.when(~F.startswith(whole, F.lit("[")), whole))
    return F.struct(F.coalesce(get("$.headline"), get("$.name")).alias("title"), page_date(F.coalesce(get("$.datePublished"), get("$.dateCreated"))).alias("published"), F.coalesce(publisher, get("$.isPartOf.name")).alias("source"))


def _first(c: Column) -> Column:
    return F.try_element_at(F.filter(c, lambda x: x.isNotNull()), F.lit(1))


def html_doi(html: Column) -> Column:
    """DOI of a page: citation_doi, dc.identifier, og:url, a doi.org link, then JSON-LD."""
    return F.coalesce(doi_in(meta_content(html, "citation_doi")), doi_in(meta_content(html, "dc.identifier")), doi_in(meta_content(html, "og:url")), doi_in(extracted(html, r"(?i)href=[\"'](https?://(?:dx\.)?doi\.org/[^\"']+)")), _first(F.transform(ld_objects(html), ld_doi)))


def html_title(html: Column) -> Column:
    t = F.trim(extracted(html, r"(?is)<title[^>]*>(.*?)</title>"))
    return F.coalesce(blank_to_null(meta_content(html, "og:title")), blank_to_null(meta_content(html, "citation_title")), blank_to_null(t), _first(F.transform(ld_objects(html), lambda o: ld_metadata(o)["title"])))


def html_date(html: Column) -> Column:
    """ISO form of the date of a page."""
    published = _first(F.transform(ld_objects(html), lambda o: ld_metadata(o)["published"]))
    return F.coalesce(*[page_date(meta_content(html, n)) for n in ("citation_publication_date", "article:published_time", "dc.date")], published)


def html_journal(html: Column) -> Column:
    return F.coalesce(blank_to_null(meta_content(html, "citation_journal_title")), blank_to_null(meta_content(html, "og:site_name")), _first(F.transform(ld_objects(html), lambda o: ld_metadata(o)["source"])))
