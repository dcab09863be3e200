"""Scalar functions over strings, identifiers, dates and pages, as Column expressions.

IDs in brackets are those of the operator inventory. Null in gives null out
unless a docstring says otherwise.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of identifiers, as the formats demand them.
DOI_IN_TEXT = r'[^A-z0-9\.](10\.[0-9]+(\.[0-9]+)*/[^%"# \?<>{}\^\[\]`\|\\\+]+)'
URL_IN_TEXT = r"(https?://([A-z]|[0-9]|%|&|\?|/|\.|_|~|-|:)+)"
RESOURCE = r"^(.+)/([a-z]{2})/(0[1-9]+0)?([1-9][0-9]*)$"
SNAPSHOT = r"^(.+)/([a-z]{2})/(0[1-9]+0)?([1-9][0-9]*)/prov/([a-z]{2})/([0-9]+)$"


def _or_null(value: Column) -> Column:
    return F.when(value != "", value)


def is_blank(c: Column) -> Column:
    """[SC-10] Null or white space only."""
    return c.isNull() | (F.trim(c) == "")


@cache
def _ascii_forms() -> tuple[dict[str, str], dict[str, str]]:
    """What is left of each other character by compatibility decomposition without what is not ASCII: one character, or several."""
    forms = {chr(i): unicodedata.normalize("NFKD", chr(i)).encode("ascii", "ignore").decode() for i in range(128, sys.maxunicode + 1) if not 0xD800 <= i < 0xE000}
    return {c: f for c, f in forms.items() if len(f) == 1}, {c: f for c, f in forms.items() if len(f) > 1}


def normalise_ascii(c: Column) -> Column:
    """[SC-01] Compatibility decomposition without what is not ASCII, character by character (an ASCII character is never moved by it).

    Built-ins only: nothing goes to Python. Plain ASCII is left alone, and the few
    characters that become several are looked up only in texts that have them.
    """
    one, several = _ascii_forms()
    table = F.create_map(*[F.lit(x) for kv in several.items() for x in kv])
    # Long classes of characters are slow in regular expressions, so single characters are looked up.
    pieces = F.regexp_extract_all(c, F.lit(r"[\x00-\x7F]+|[^\x00-\x7F]"), F.lit(0))
    long = F.array_join(F.transform(pieces, lambda x: F.when(x >= "\x80", F.coalesce(table[x], x)).otherwise(x)), "")
    plain = lambda x: F.regexp_replace(F.translate(x, "".join(one), "".join(one.values())), r"[^\x00-\x7F]+", "")
    others = F.regexp_replace(c, r"[\x00-\x7F]+", "")
    return F.when(~c.rlike(r"[^\x00-\x7F]"), c).when(F.translate(others, "".join(several), "") != others, plain(long)).otherwise(plain(c))


def normalise_name(c: Column) -> Column:
    """[SC-02] Lower-case letters and spaces of the ASCII form."""
    return F.regexp_replace(F.lower(normalise_ascii(c)), "[^A-Za-z ]", "")


def normalise_id(c: Column) -> Column:
    """[SC-03] Lower-case ASCII form with ``/`` as ``#`` and anything else but letters and digits as ``_``."""
    return F.regexp_replace(F.lower(F.replace(normalise_ascii(c), F.lit("/"), F.lit("#"))), "[^A-Za-z0-9#]", "_")


def url_decode(c: Column) -> Column:
    """Percent-decoding that leaves ``+`` alone; what cannot be decoded stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def encode_url(c: Column) -> Column:
    """[SC-07] Percent-encoding that keeps ``:`` and ``/``."""
    out = F.url_encode(c)
    for old, new in (("+", "%20"), ("*", "%2A"), ("%3A", ":"), ("%2F", "/"), ("%7E", "~")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def clean_entry(c: Column) -> Column:
    """[SC-06] A citation text fit for a URL: ``:`` as ``,``, ASCII, percent-encoded."""
    return encode_url(normalise_ascii(F.replace(c, F.lit(":"), F.lit(","))))


def normalise_doi(c: Column) -> Column:
    """[EX-01] The DOI from its first ``10.`` on: decoded, without white space and NULs, lower case; null if there is none."""
    tail = F.substring(c, F.instr(c, "10."), F.length(c))
    return F.when(F.instr(c, "10.") > 0, F.trim(F.lower(F.regexp_replace(url_decode(tail), r"(?U)[\s\x00]+", ""))))


def extract_doi(c: Column) -> Column:
    """[SC-04] The first DOI in a text, not at its very start, less one trailing dot or comma."""
    return _or_null(F.regexp_replace(F.regexp_extract(c, DOI_IN_TEXT, 1), r"[.,]$", ""))


def extract_url(c: Column) -> Column:
    """[SC-05] The first URL in a text, less a trailing slash and dot, and backslashes."""
    return _or_null(F.replace(F.regexp_replace(F.regexp_extract(c, URL_IN_TEXT, 1), r"/?\.?$", ""), F.lit("\\"), F.lit("")))


def pub_date(parts: Column) -> Column:
    """[SC-12] Lexical date of variable precision from [year, month, day]; the first of January means the year alone."""
    y, m, d = (F.get(parts, F.lit(i)) for i in range(3))
    full = m.isNotNull() & d.isNotNull() & ~((m == 1) & (d == 1))
    return F.when(full, F.format_string("%04d-%02d-%02d", y, m, d)).when(m.isNotNull() & d.isNull(), F.format_string("%04d-%02d", y, m)).when(y.isNotNull(), F.format_string("%04d", y))


def pub_date_type(lexical: Column) -> Column:
    """[SC-12] The XML Schema type of a lexical date."""
    return F.when(F.length(lexical) == 10, "date").when(F.length(lexical) == 7, "gYearMonth").when(F.length(lexical) == 4, "gYear")


def first_page(c: Column) -> Column:
    """[SC-13] What is before the first dash; the whole if there is none."""
    return F.regexp_replace(c, "[-–]+.*$", "")


def last_page(c: Column) -> Column:
    """[SC-13] What is behind the last dash; the whole if there is none."""
    return F.regexp_replace(c, "^.*[-–]+", "")


def clean_issn(c: Column) -> Column:
    """[SC-14] With a hyphen for an en dash; null for the null ISSN and blanks."""
    fixed = F.replace(c, F.lit("–"), F.lit("-"))
    return F.when((fixed != "0000-0000") & ~is_blank(fixed), fixed)


def clean_isbn(c: Column) -> Column:
    """[SC-14, RS-22] Without a URL in front, with hyphens for en dashes."""
    return F.replace(F.regexp_replace(c, "^https?://.*/", ""), F.lit("–"), F.lit("-"))


def isbn_variants(c: Column) -> Column:
    """[SC-20] The forms under which an ISBN may be known, in order of preference: as it is, without 978, without hyphens."""
    short = F.when(c.rlike("^978-?"), F.regexp_replace(c, "^978-?", ""))
    return F.array_compact(F.array_distinct(F.array(c, short, F.replace(c, F.lit("-"), F.lit("")), F.replace(short, F.lit("-"), F.lit("")))))


def join_titles(titles: Column) -> Column:
    """[RS-23] Trimmed titles that are not blank, joined by `` - ``; null if there are none."""
    return _or_null(F.array_join(F.filter(F.transform(titles, lambda t: F.trim(t)), lambda t: t != ""), " - "))


def issn_list(values: Column) -> Column:
    """[RS-22] An array of ISSNs without the null one."""
    return F.array_compact(F.transform(values, clean_issn))


def isbn_list(values: Column) -> Column:
    """[RS-22] An array of ISBNs without URLs in front."""
    return F.transform(values, clean_isbn)


def short_name(iri: Column) -> Column:
    """[SC-15] The two-letter class of a resource or of the subject of a snapshot."""
    return _or_null(F.when(F.instr(iri, "/prov/") > 0, F.regexp_extract(iri, SNAPSHOT, 2)).otherwise(F.regexp_extract(iri, RESOURCE, 2)))


def supplier_prefix(iri: Column) -> Column:
    """[SC-15] The supplier prefix, or the empty string."""
    return F.when(F.instr(iri, "/prov/") > 0, F.regexp_extract(iri, SNAPSHOT, 3)).otherwise(F.regexp_extract(iri, RESOURCE, 3))


def has_supplier_prefix(iri: Column) -> Column:
    """[SC-17]"""
    return supplier_prefix(iri) != ""


def resource_number(iri: Column) -> Column:
    """[SC-15] The number of a resource, or of the subject of a snapshot, of up to 38 digits."""
    return _or_null(F.when(F.instr(iri, "/prov/") > 0, F.regexp_extract(iri, SNAPSHOT, 4)).otherwise(F.regexp_extract(iri, RESOURCE, 4))).cast("decimal(38,0)")


def is_dataset(iri: Column) -> Column:
    """[SC-16] An IRI that does not end in a number."""
    return ~iri.rlike("/[0-9]+(-[0-9]+)?(/[0-9]+)?$")


def _up(n: Column, step: int) -> Column:
    """The least multiple of ``step`` that is not below ``n``, exact for any size of number."""
    return (n + F.lit(step - 1) - ((n + F.lit(step - 1)) % F.lit(step))).cast("decimal(38,0)")


def file_split(n: Column, per_file: int = 1000) -> Column:
    return _up(n, per_file)


def dir_split(n: Column, per_dir: int = 10_000) -> Column:
    return _up(n, per_dir)


def shard_path(iri: Column, base: str, base_dir: str, default_dir: str = "_", per_dir: int = 10_000, per_file: int = 1000) -> Column:
    """[SC-18, G-12] The file of a resource: class / prefix / directory number / file number, and the ``prov`` folder of its file for a snapshot.

    ``<base>prov/<kind>/<n>`` and dataset IRIs, which have no such number, lie beside them.
    """
    number = resource_number(iri)
    prefix = F.when(supplier_prefix(iri) != "", supplier_prefix(iri)).otherwise(F.lit(default_dir))
    stem = F.concat(F.lit(base_dir), short_name(iri), F.lit("/"), prefix, F.lit("/"), dir_split(number, per_dir).cast("string"), F.lit("/"), file_split(number, per_file).cast("string"))
    rest = F.substring(iri, len(base) + 1, 1 << 30)
    snapshot = F.concat(stem, F.lit("/prov/"), F.regexp_extract(iri, SNAPSHOT, 5), F.lit(".json"))
    alone = F.concat(F.lit(base_dir), rest, F.lit(".json"))
    dataset = F.concat(F.lit(base_dir), rest, F.lit("index.json"))
    return F.when(rest.rlike("^prov/[a-z]{2}/[0-9]+$"), alone).when(is_dataset(iri), dataset).when(F.instr(rest, "/prov/") > 0, snapshot).otherwise(F.concat(stem, F.lit(".json")))


def local_line(iri: Column, per_file: int = 1000) -> Column:
    """[SC-19] The place of a resource in its file, from 1."""
    n = resource_number(iri)
    return n - file_split(n, per_file) + F.lit(per_file)


def _part(c: Column, unit: str) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(c, rf"(\d+){unit}", 1), F.lit("")).cast("int"), F.lit(0))


def timespan_days(c: Column) -> Column:
    """[SC-24] Days of a timespan like ``P1Y2M3D``: 365 a year, 30 a month."""
    return _part(c, "Y") * 365 + _part(c, "M") * 30 + _part(c, "D")


def timespan_words(c: Column) -> Column:
    """[SC-23] A timespan in words."""
    words = [F.when(_part(c, u) > 0, F.concat(_part(c, u).cast("string"), F.lit(f" {w}"), F.when(_part(c, u) > 1, "s").otherwise(""))) for u, w in (("Y", "year"), ("M", "month"), ("D", "day"))]
    return F.concat_ws(", ", *words)


def capitalised(c: Column) -> Column:
    """[SC-22] First letter in upper case, the rest as it is."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))


def truncated(c: Column, n: int = 20) -> Column:
    """[SC-22] The first ``n`` characters and dots, if it is longer."""
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def split_dois(c: Column) -> Column:
    """[SC-26] ``a__b`` as an array of DOIs."""
    return F.split(c, "__")


def search_words(c: Column) -> Column:
    """[SC-21] Lower-case words of a citation text: without URLs, ``et al.`` and ``Available at:``."""
    plain = F.array_join(F.filter(F.split(c, r"(?U)\s+"), lambda w: ~w.rlike("^https?://")), " ")
    plain = F.replace(F.replace(plain, F.lit("et al."), F.lit("")), F.lit("Available at:"), F.lit(""))
    # Most texts have none of these, and need no pass for them.
    kept = F.when(c.contains("http") | c.contains("al.") | c.contains("at:"), plain).otherwise(c)
    return F.filter(F.split(F.lower(kept), r"(?U)\W+"), lambda w: w != "")


def strip_html(c: Column) -> Column:
    """[EX-04] Text without tags, with the common entities decoded."""
    out = F.regexp_replace(c, "<[^>]*>", "")
    for old, new in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def readable_type(iri: Column) -> Column:
    """[CQ-5] The local name of a type with spaces between its words."""
    return F.regexp_replace(F.element_at(F.split(iri, "[/#]"), -1), "([a-z])([A-Z])", "$1 $2")


def name_distance(a: Column, b: Column, method: str = "binary") -> Column:
    """[NM-02] 0 or 1 for equal and unequal names; with ``levenshtein`` the number of edits."""
    return F.levenshtein(a, b) if method == "levenshtein" else (a != b).cast("int")
