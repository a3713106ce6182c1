"""Scalar functions over text, as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.schemas import ANSWER, TOPICS, TYPES


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def url_key(url: str | Column) -> Column:
    """The compact key of a URL: the MD5 of its UTF-8 bytes, in hex."""
    return F.md5(col(url))


def content_id(content: str | Column) -> Column:
    """SHA-256 of the bytes, lower hex; a stored document's id."""
    return F.sha2(col(content), 256)


def failed_id(url: str | Column) -> Column:
    """The id of a failed fetch; it doesn't depend on the crawl."""
    return F.concat(F.lit("failed-"), F.sha2(col(url), 256))


def duplicate_id(url: str | Column, crawl_id: str | Column) -> Column:
    """The id of a duplicate, one per URL and crawl."""
    return F.concat(F.lit("dup-"), F.sha2(F.concat(col(url), col(crawl_id)), 256))


def object_key(doc_id: str | Column, prefix: str = "documents/", suffix: str = ".docx") -> Column:
    return F.concat(F.lit(prefix), col(doc_id), F.lit(suffix))


def document_url(doc_id: str | Column, base: str) -> Column:
    return F.concat(F.lit(base), col(doc_id), F.lit(".docx"))


def filename_from_url(url: str | Column, default: str = "unknown.docx") -> Column:
    """The decoded last path segment; default for an empty one, a bad escape or no URL.

    URLs are parsed by java.net.URI, which rejects raw spaces and the like.
    """
    last = F.element_at(F.split(F.try_parse_url(col(url), F.lit("PATH")), "/"), -1)
    decoded = F.try_url_decode(F.replace(last, F.lit("+"), F.lit("%2B")))
    return F.coalesce(F.nullif(decoded, F.lit("")), F.lit(default))


def domain(url: str | Column, default: str = "unknown") -> Column:
    """The authority of a URL: port, user and case are kept."""
    return F.coalesce(F.nullif(F.try_parse_url(col(url), F.lit("AUTHORITY")), F.lit("")), F.lit(default))


def trim_spaces(text: str | Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(col(text), r"(?U)^\s+|\s+$", "")


def word_count(text: str | Column) -> Column:
    """Runs of anything but white space of any script."""
    return F.size(F.filter(F.split(col(text), r"(?U)\s+"), lambda x: x != ""))


def char_count(text: str | Column) -> Column:
    """Code points."""
    return F.length(col(text))


def js_length(text: str | Column) -> Column:
    """UTF-16 units: characters beyond the first plane count twice."""
    x = col(text)
    return F.length(x) + F.length(x) - F.length(F.regexp_replace(x, r"[\x{10000}-\x{10FFFF}]", ""))


def prefix(text: str | Column, n: int = 2000) -> Column:
    """The first n characters; null counts as empty."""
    return F.left(F.coalesce(col(text), F.lit("")), F.lit(n))


def short_id(doc_id: str | Column, head: int = 8, tail: int = 4) -> Column:
    x = col(doc_id)
    return F.concat(F.left(x, F.lit(head)), F.lit("..."), F.right(x, F.lit(tail)))


def json_list_length(json: str | Column, path: str) -> Column:
    """How many elements the list at a JSON path has; 0 if there is none."""
    return F.coalesce(F.json_array_length(F.get_json_object(col(json), path)), F.lit(0))


def without_images(pictures: str | Column) -> Column:
    """An array of picture structs without their image field."""
    return F.transform(col(pictures), lambda p: p.dropFields("image"))


def model_name(base: str | Column, version: str | Column) -> Column:
    """base-version, slashes turned to hyphens; 'unknown' and 'v0' where one is missing."""
    b = F.coalesce(F.nullif(col(base), F.lit("")), F.lit("unknown"))
    v = F.coalesce(F.nullif(col(version), F.lit("")), F.lit("v0"))
    return F.concat_ws("-", F.replace(b, F.lit("/"), F.lit("-")), v)


def label_of(value: str | Column, labels: Mapping[str, str]) -> Column:
    """The label of an id, or the id itself."""
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), col(value)), col(value)) if pairs else col(value)


def parse_answer(text: str | Column, types: tuple[str, ...] = TYPES, topics: tuple[str, ...] = TOPICS) -> Column:
    """A labelling model's answer as (document_type, document_topic, type_confidence, topic_confidence, confidence, reasoning).

    The outermost braces are parsed. Ids outside the taxonomy become 'general', or
    the taxonomy's first id where it has no 'general' (a deterministic choice).
    Without both ids and confidences the record is general/general with confidence 0.
    """
    answer = F.from_json(F.regexp_extract(col(text), r"(?s)\{.*\}", 0), ANSWER)

    def valid(value: Column, known: tuple[str, ...]) -> Column:
        return F.when(value.isin(list(known)), value).otherwise(F.lit("general" if "general" in known else known[0]))

    by_type, by_topic = answer["document_type"], answer["topic"]
    whole = reduce(
        lambda a, b: a & b, [x[f].isNotNull() for x in (by_type, by_topic) for f in ("id", "confidence")]
    )
    zero = F.lit(0.0)
    return F.when(
        whole,
        F.struct(
            valid(by_type["id"], types).alias("document_type"),
            valid(by_topic["id"], topics).alias("document_topic"),
            by_type["confidence"].alias("type_confidence"),
            by_topic["confidence"].alias("topic_confidence"),
            F.least(by_type["confidence"], by_topic["confidence"]).alias("confidence"),
            F.coalesce(answer["reasoning"], F.lit("")).alias("reasoning"),
        ),
    ).otherwise(
        F.struct(
            F.lit("general").alias("document_type"),
            F.lit("general").alias("document_topic"),
            zero.alias("type_confidence"),
            zero.alias("topic_confidence"),
            zero.alias("confidence"),
            F.lit("Failed to parse LLM response").alias("reasoning"),
        )
    )


def prompt(head: str, text: str | Column, filename: str | Column) -> Column:
    """A labelling prompt: the taxonomy's part, a line for the filename if there is one, and the text."""
    name = F.nullif(col(filename), F.lit(""))
    line = F.coalesce(F.concat(F.lit("\n- Filename: "), name), F.lit(""))
    return F.concat(F.lit(head), F.lit("\n\n## Document"), line, F.lit('\n"""\n'), col(text), F.lit('\n"""\n'))


def chunks(text: str | Column, size: int = 6000, step: int = 5800) -> Column:
    """Overlapping windows of a trimmed text, each trimmed, empty ones dropped; a short text is one chunk."""
    whole = trim_spaces(text)
    n = F.length(whole)
    starts = F.filter(
        F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(step)), lambda i: (i == 0) | (i + (size - step) < n)
    )
    cut = F.transform(starts, lambda i: trim_spaces(F.substring(whole, i + 1, F.lit(size))))
    return F.filter(cut, lambda x: x != "")


def band(confidence: str | Column, cuts: list[tuple[float, str]], below: str) -> Column:
    """The first name whose lower bound the value reaches, else below; null stays null."""
    x = col(confidence)
    out = F.when(x.isNull(), F.lit(None).cast("string"))
    for least, name in cuts:
        out = out.when(x >= least, name)
    return out.otherwise(below)


#: The bounds and names of the confidence histogram.
HISTOGRAM = [
    (0.9, "0.9-1.0"), (0.8, "0.8-0.9"), (0.7, "0.7-0.8"), (0.6, "0.6-0.7"),
    (0.5, "0.5-0.6"), (0.4, "0.4-0.5"), (0.3, "0.3-0.4"),
]
BELOW = "below 0.3"


def table_text(tables: str | Column) -> Column:
    """The text of array<array<array<string>>>: cells parted by ' | ', rows by a line feed, tables by two.

    Empty cells, rows and tables are dropped.
    """

    def some(x: Column) -> Column:
        return F.filter(x, lambda s: s != "")

    def row(cells: Column) -> Column:
        return F.array_join(some(F.transform(cells, lambda c: trim_spaces(F.coalesce(c, F.lit(""))))), " | ")

    def rows(t: Column) -> Column:
        return F.array_join(some(F.transform(t, row)), "\n")

    return F.array_join(some(F.transform(col(tables), rows)), "\n\n")


def correction_outcome(status: str | Column) -> Column:
    """(status, reason) of a repair's outcome."""
    s = col(status)

    def pair(a: Column, b: Column) -> Column:
        return F.struct(a.alias("status"), b.alias("reason"))

    none = F.lit(None).cast("string")
    return (
        F.when(s == "trimmed", pair(F.lit("corrected"), none))
        .when(s == "already-clean", pair(F.lit("already_clean"), none))
        .when(s.startswith("skipped-"), pair(F.lit("skipped"), F.substring(s, F.lit(len("skipped-") + 1), F.length(s))))
        .otherwise(pair(F.lit("skipped"), s))
    )
