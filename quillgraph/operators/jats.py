"""Article XML: references, in-text pointers, sentences and discourse elements [SRC-04, EX-02, EX-14, EX-15, PT-*].

Each article is parsed once, in a map over Arrow batches; everything else is
DataFrame work over the rows that come out of it.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.schema import DISCOURSE

REF_DDL = "doc string, pos int, xmlid string, text string, doi string, pmid string, pmcid string, url string"
POINTER_DDL = "doc string, pos int, xmlid string, label string, tail string, before string, parent string, parent_path string, section string, sentence string, sentence_no int"
# Endings that do not end a sentence.
ABBREVIATIONS = ("al", "fig", "figs", "ref", "refs", "eq", "eqs", "dr", "prof", "mr", "mrs", "no", "vol", "e.g", "i.e", "cf", "vs", "approx", "ca", "etc", "sp", "spp", "st", "tab")
ARTICLE_DOI = "front/article-meta/article-id[@pub-id-type='doi']"


def parse(xml: str):
    """The root of an article; without its document type, and with named entities decoded."""
    if "<!DOCTYPE" in xml:
        xml = re.sub(r"<!DOCTYPE[^>\[]*(\[.*?\])?[^>]*>", "", xml, flags=re.S)
    if "&" in xml:
        known = {"&amp;", "&lt;", "&gt;", "&quot;", "&apos;"}
        xml = re.sub(r"&[A-Za-z][A-Za-z0-9]*;", lambda m: m[0] if m[0] in known else html.unescape(m[0]) if html.unescape(m[0]) != m[0] else " ", xml)
    return ElementTree.fromstring(xml.encode())


def _squeezed(text: str | None) -> str:
    return " ".join((text or "").split())


#: What stands between two pieces of a citation, by where they come from: names of a group of persons, or fields.
BETWEEN = {("names", "names"): ", ", ("fields", "names"): ", ", ("names", "fields"): ". "}
#: Between two fields, by whether the citation lists its elements or has running text.
BETWEEN_FIELDS = {"element-citation": ", ", "citation": ", ", "mixed-citation": " "}
LABELS = {"doi": "DOI: ", "pmid": "PMID: ", "pmcid": "PMC: "}
DASHES = ("-", "–")
MARKS = (*DASHES, *",.!?;:")
#: What some rule of :func:`tidied` applies to; most texts have nothing of it.
UNTIDY = r"^ |[-–( ] | [,.!?;:]|[-–,.!?;:] [-–]|[-–,.!?;:]{2}|\(\."


def tidied(text: str) -> str:
    """Spaces and marks of a text put together from pieces set right, mark by mark.

    No space stands before a mark but a dash's, none after a dash or a bracket
    that opens; of marks next to each other the last one stays; stops at the
    start of brackets go.
    """
    if not re.search(UNTIDY, text):
        return text
    out: list[str] = []
    for token in re.findall(r"[-–,.!?;:( ]|[^-–,.!?;:( ]+", text):
        last = out[-1] if out else ""
        if token == " ":
            if last not in ("", "(", *DASHES):
                out.append(token)
        elif token in MARKS:
            if last == " " and (token not in DASHES or len(out) > 1 and out[-2] in MARKS):
                out.pop()
                last = out[-1] if out else ""
            if last in MARKS:
                out[-1] = token
            elif not (last == "(" and token == "."):
                out.append(token)
        else:
            out.append(token)
    return "".join(out)


def citation_text(ref) -> str | None:
    """[EX-02] The reference as one text; what is put between two pieces depends on where both come from."""
    cited = next((e for e in ref if e.tag in BETWEEN_FIELDS), None)
    if cited is None:
        return None
    pieces, before, source = [cited.text or ""], "fields" if (cited.text or "").strip() else None, "fields"
    # Where to go on behind an element: its siblings, where they come from, and its following text.
    above: list[tuple] = []
    siblings = iter(cited)
    while True:
        for e in siblings:
            own = e.text
            if own and not own.isspace():
                if before:
                    pieces.append(BETWEEN.get((before, source)) or BETWEEN_FIELDS[cited.tag])
                before = source
            if e.tag == "pub-id":
                pieces.append(LABELS.get(e.get("pub-id-type"), ""))
            if own:
                pieces.append(own)
            if len(e):
                above.append((siblings, source, e.tail))
                siblings, source = iter(e), "names" if e.tag == "person-group" else source
                break
            if e.tail:
                pieces.append(e.tail)
        else:
            if not above:
                break
            siblings, source, tail = above.pop()
            if tail:
                pieces.append(tail)
    text = "".join(pieces)
    return tidied(_squeezed(text)) or None


def references(root) -> list[tuple]:
    """pos, xmlid, text, doi, pmid, pmcid, url of each reference of the lists."""
    out = []
    for pos, ref in enumerate(r for lists in root.iter("ref-list") for r in lists.findall("ref")):
        ids = {}
        for e in ref.iter("pub-id"):
            ids.setdefault(e.get("pub-id-type"), _squeezed("".join(e.itertext())))
        url = next((_squeezed("".join(e.itertext())) for e in ref.iter("ext-link")), None)
        out.append((pos, ref.get("id"), citation_text(ref), ids.get("doi"), ids.get("pmid"), ids.get("pmcid"), url if url and url.startswith("http") else None))
    return out


def sentences(text: str) -> list[tuple[int, int]]:
    """[PT-06] Start and end of each sentence; abbreviations and initials do not end one."""
    out, start = [], 0
    for m in re.finditer(r"[.!?]+[\])”\"']*\s+(?=[\[(\"“A-Z0-9])", text):
        before = text[start : m.start()].removesuffix("\n")
        word = before.rsplit(None, 1)[-1] if before and not before[-1].isspace() else ""
        last = word.lower().lstrip("([").rstrip(".")
        if text[m.start()] == "." and (last in ABBREVIATIONS or re.fullmatch(r"[a-z]", last)):
            continue
        out.append((start, m.end()))
        start = m.end()
    if start < len(text) or not out:
        out.append((start, len(text)))
    return out


def pointers(root) -> list[tuple]:
    """[PT-01, PT-02, PT-06] pos, xmlid, label, tail, before, parent, parent_path, section, sentence, sentence_no of pointers to references, in order."""
    known = {r.get("id") for r in root.iter("ref") if r.get("id")}
    out: list[tuple] = []

    def blocks(e, path, section):
        counts: dict[str, int] = {}
        for child in e:
            counts[child.tag] = counts.get(child.tag, 0) + 1
            here = f"{path}/{child.tag}[{counts[child.tag]}]"
            if child.tag in ("p", "title", "td", "th") or child.tag == "xref":
                block(child if child.tag != "xref" else e, here if child.tag != "xref" else path, section)
                if child.tag == "xref":
                    return
            elif child.tag != "ref-list":
                blocks(child, here, _squeezed("".join(child.find("title").itertext())) if child.tag == "sec" and child.find("title") is not None else section)

    def block(e, path, section):
        """A run of text with its pointers: their places in the text tell sentences and what stands around them."""
        text: list[str] = []
        found: list[tuple] = []
        length = 0

        def put(piece):
            nonlocal length
            if piece:
                text.append(piece)
                length += len(piece)

        def walk(parent, trail):
            for child in parent:
                if child.tag == "xref" and child.get("rid") in known:
                    found.append((length, child, parent.tag))
                if child.tag in ("p", "sec"):
                    put(" ")
                    blocks(parent, trail, section)
                    continue
                put(child.text)
                walk(child, f"{trail}/{child.tag}")
                put(child.tail)

        put(e.text)
        walk(e, path)
        if not found:
            return
        whole = "".join(text)
        spans = sentences(whole)
        ends = [b for _, b in spans]
        told: dict[int, str] = {}
        for k, (start, child, parent) in enumerate(found):
            label = "".join(child.itertext())
            no = min(bisect_right(ends, start), len(ends) - 1)
            if no not in told:
                told[no] = _squeezed(whole[spans[no][0] : spans[no][1]])
            after = found[k + 1][0] if k + 1 < len(found) else len(whole)
            out.append((len(out), child.get("rid"), _squeezed(label), whole[start + len(label) : after], whole[max(0, start - 2) : start], parent, path, section, told[no], no))

    blocks(root, f"/{root.tag}", None)
    return out


def _mapped(articles: DataFrame, rows_of, ddl: str, of_broken=None) -> DataFrame:
    """``articles`` (doc, xml) to rows; an article that cannot be parsed gives those of ``of_broken``, or none (see :func:`broken`)."""
    schema = pa.schema([(n, {"string": pa.string(), "int": pa.int32()}[t]) for n, t in (x.split() for x in ddl.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, xml in zip(batch.column("doc").to_pylist(), batch.column("xml").to_pylist()):
                try:
                    found = rows_of(parse(xml))
                except (ElementTree.ParseError, TypeError):
                    found = of_broken or []
                rows += [(doc, *r) for r in found]
            columns = list(zip(*rows)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)

    return articles.select("doc", "xml").mapInArrow(run, ddl)


def extract_references(articles: DataFrame) -> DataFrame:
    return _mapped(articles, references, REF_DDL)


def extract_pointers(articles: DataFrame) -> DataFrame:
    return _mapped(articles, pointers, POINTER_DDL)


def article_doi(articles: DataFrame) -> DataFrame:
    """[EX-14] doc and doi from the front matter."""
    return _mapped(articles, lambda root: [(_squeezed(e.text),) for e in [root.find(ARTICLE_DOI)] if e is not None], "doc string, doi string")


def broken(articles: DataFrame) -> DataFrame:
    """doc of articles that cannot be parsed."""
    return _mapped(articles, lambda root: [], "doc string", [()])


def census(articles: DataFrame) -> DataFrame:
    """[EX-15, AG-09] element, attribute (null for the element itself) and n, most frequent first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Counted where they are found: names are few, elements many.
        counts: Counter = Counter()
        for batch in batches:
            for xml in batch.column("xml").to_pylist():
                try:
                    root = parse(xml)
                except (ElementTree.ParseError, TypeError):
                    continue
                for e in root.iter():
                    counts[e.tag, None] += 1
                    for a in e.attrib:
                        counts[e.tag, a] += 1
        columns = [k for k, _ in counts], [a for _, a in counts], list(counts.values())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.string(), pa.int64()))], names=["element", "attribute", "n"])

    rows = articles.select("xml").mapInArrow(run, "element string, attribute string, n long")
    return rows.groupBy("element", "attribute").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "element", "attribute")


def pointer_lists(pointers: DataFrame) -> DataFrame:
    """[PT-03] Pointers (doc, pos, parent_path, before, tail, ...) with list_id, null outside of a list, and its text.

    A list is a run of pointers of one block between brackets, apart only by
    ``,``, ``;`` or a dash. A new run starts where something else stands between
    two pointers.
    """
    order = Window.partitionBy("doc").orderBy("pos")
    joined = F.trim(F.lag("tail").over(order)).rlike("^[,;–-]$") & (F.lag("parent_path").over(order) == F.col("parent_path"))
    rows = pointers.withColumn("list_no", F.sum(F.when(F.coalesce(joined, F.lit(False)), 0).otherwise(1)).over(order))
    run = Window.partitionBy("doc", "list_no")
    opened = F.max(F.when(F.trim("before").rlike(r"[\[(]$"), 1).otherwise(0)).over(run)
    closed = F.max(F.when(F.trim("tail").rlike(r"^[\])]"), 1).otherwise(0)).over(run)
    several = F.count("*").over(run) > 1
    in_list = several | ((opened == 1) & (closed == 1))
    return rows.withColumn("list_id", F.when(in_list, F.concat_ws("#", "doc", "list_no"))).withColumn("in_range", F.trim("tail").rlike("^[–-]$")).drop("list_no")


def expand_ranges(pointers: DataFrame, refs: DataFrame) -> DataFrame:
    """[PT-04, PT-05] Pointers with those that a dash between two stands for: no label, ordinals between those of both.

    ``refs`` (doc, pos, xmlid) gives the ordinals; labels are null in between, and
    shown as ``in sequence``.
    """
    order = Window.partitionBy("doc").orderBy("pos")
    number = refs.select("doc", "xmlid", F.col("pos").alias("ordinal"))
    rows = pointers.join(number, ["doc", "xmlid"], "left").withColumn("next_ordinal", F.lead("ordinal").over(order))
    between = rows.filter("in_range AND next_ordinal > ordinal + 1").select("doc", "pos", "list_id", "parent_path", "sentence", "sentence_no", F.explode(F.sequence(F.col("ordinal") + 1, F.col("next_ordinal") - 1)).alias("ordinal"))
    between = between.join(number, ["doc", "ordinal"]).select("doc", "pos", "list_id", "parent_path", "sentence", "sentence_no", "ordinal", "xmlid", F.lit("in sequence").alias("label"))
    own = rows.select("doc", "pos", "list_id", "parent_path", "sentence", "sentence_no", "ordinal", "xmlid", "label")
    return own.unionByName(between).withColumn("rank", F.row_number().over(Window.partitionBy("doc").orderBy("pos", "ordinal")))


def discourse(pointers: DataFrame) -> DataFrame:
    """[PT-08, PT-10] doc, path, class and parent of the discourse elements above the pointers; ancestors of no class are passed over.

    What is above an element is in its own path, so parents need no join, and
    the articles are parsed once.
    """
    steps = pointers.select("doc", F.split("parent_path", "/").alias("s")).distinct()
    path = lambda k: F.array_join(F.slice("s", F.lit(1), k), "/")
    classes = F.create_map(*[F.lit(x) for kv in DISCOURSE.items() for x in kv])
    chain = F.transform(F.sequence(F.lit(2), F.greatest(F.size("s"), F.lit(2))), lambda k: F.struct(path(k).alias("path"), classes[F.regexp_extract(path(k), r"([A-Za-z-]+)\[\d+\]$", 1)].alias("class")))
    chains = steps.select("doc", F.filter(chain, lambda x: x["class"].isNotNull()).alias("c"))
    rows = chains.select("doc", F.explode(F.transform("c", lambda x, i: F.struct(x["path"].alias("path"), x["class"].alias("class"), F.get("c", i - 1)["path"].alias("parent")))).alias("x"))
    return rows.select("doc", "x.path", "x.class", "x.parent").distinct()


def pointer_entities(pointers: DataFrame, entries: DataFrame) -> DataFrame:
    """[PT-09, PT-11..13] Pointers joined to entries (doc, xmlid, citing, cited), numbered from 1 within each citation."""
    rows = pointers.join(entries, ["doc", "xmlid"])
    pair = Window.partitionBy("citing", "cited")
    oci = F.concat_ws("-", "citing", "cited")
    order = [c for c in ("pos", "ordinal") if c in rows.columns]
    ordinal = F.row_number().over(pair.orderBy("doc", *order)).cast("string")
    return rows.withColumn("oci", F.concat(oci, F.lit("/"), ordinal)).withColumn("intrepid", F.concat(oci, F.lit("/"), ordinal, F.lit("-"), F.count("*").over(pair).cast("string")))


def context_links(pointers: DataFrame) -> DataFrame:
    """[PT-09] sentence and context of pointers (iri, list, sentence): each list a sentence holds, and each pointer outside of one, once."""
    return pointers.select("sentence", F.coalesce("list", "iri").alias("context")).distinct()
