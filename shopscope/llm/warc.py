"""WARC derivatives: a metadata and a plain-text conversion record for each response.

All of it is one projection of built-in string functions and one ``inline`` of
two records a row; nothing is shuffled. A derivative names the response it was
made from (WARC-Refers-To), keeps the response's HTTP headers and payload
digest, and carries digests of its own block. Identifiers are URNs derived
from what they name, so a task that runs again gives the same record.

A null page (html) is an empty payload; a null url leaves the target URI empty;
null ids are allowed and repeated pages give repeated records (with the same
identifiers, as their content is the same). Other columns are not read.

Character references are decoded once, by HTML's rules: all named ones, the old
names also without a semicolon, and numeric ones (what no character has is
U+FFFD), in the text, the title and the links. A no-break space from a
reference is a plain space. A tag begins with ``<`` and a letter, ``/``, ``!`` or
``?``; any other ``<`` is text. Line breaks inside ``pre`` are treated as any
others. A title or link is cut at no line end: references may bring one in.
"""

from __future__ import annotations

from html.entities import codepoint2name, html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE = "2024-01-01T00:00:00Z"
_BLOCK_TAGS = "p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|table|article|section|header|footer|main|aside|nav|body|html|title|blockquote|pre|form|figure"
#: (pattern, replacement), applied in this order; both Java's and RE2's syntax.
TEXT_STEPS = (
    (r"(?is)<script\b.*?(?:</script[^>]*>|\z)", " "),
    (r"(?is)<style\b.*?(?:</style[^>]*>|\z)", " "),
    (r"(?s)<!--.*?(?:-->|\z)", " "),
    (r"(?is)<title\b.*?(?:</title[^>]*>|\z)", " "),
    (rf"(?i)</?(?:{_BLOCK_TAGS})\b[^>]*>", "\n"),
    (r"<[A-Za-z/!?][^>]*>", ""),  # a < before anything else is text
)
#: Runs of blanks, and blanks about line ends, where there is something to change.
SPACE_STEPS = ((r"[ \t\r\x0B\x0C]{2,}|[\t\r\x0B\x0C]", " "), (r" \n[ \n]*|\n[ \n]+", "\n"), (r"\A[ \n]+", ""), (r"[ \n]+\z", ""))
_VALUE = r"(\"[^\"]*\"|'[^']*'|[^\s\"'<>=`][^\s>]*)"
TITLE = r"(?is)<title\b[^>]*>(.*?)</title"
#: Attribute values with their quotation marks, if any.
LANGUAGE = rf"(?i)<html\b[^>]*?[\s\"'/]lang\s*=\s*{_VALUE}"
LINK = rf"(?i)<a\b[^>]*?[\s\"'/]href\s*=\s*{_VALUE}"
RECORD = "page_id long, record_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, source_headers string, source_digest string, block_digest string, content_length long, content string"


def _uuid(key: Column) -> Column:
    h = F.md5(key)
    return F.concat(F.lit("urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"), F.substring(h, 13, 4),
                    F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12))


def _digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Pages (page_id, url, html) as response records: their identifier, HTTP headers, payload and its digest."""
    payload, uri = F.coalesce(F.col("html"), F.lit("")), F.coalesce(F.col("url"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), uri.alias("target_uri"), payload.alias("payload"), _digest(payload).alias("source_digest"))
    headers = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                       F.octet_length("payload").cast("string"), F.lit("\r\n"))
    key = F.concat_ws("|", F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), "target_uri", "source_digest")
    return rows.select("page_id", _uuid(key).alias("record_id"), "target_uri", F.lit(date).alias("warc_date"), headers.alias("source_headers"), "source_digest", "payload")


def _named() -> Column:
    """HTML's names (with their semicolon, if they have one) and what they stand for; frequent ones first, as a look-up reads in order."""
    frequent = {f"{n}{end}" for n in [*codepoint2name.values(), "apos"] for end in (";", "")}
    names = sorted(html5, key=lambda n: (n not in frequent, n))
    pairs = "\x01".join(f"{n}\x02{html5[n]}" for n in names)
    return F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02"))


#: References that most pages have, without their semicolon (a no-break space is written as a plain one).
_FREQUENT = [(n, html5[f"{n};"].replace("\u00a0", " ")) for n in ("amp", "nbsp", "lt", "gt", "quot", "copy", "middot", "mdash", "ndash", "rsquo", "hellip", "raquo", "laquo")]
_FREQUENT += [("#39", "'"), ("apos", "'"), ("#160", " ")]
#: Names that count without a semicolon, longer ones first.
_OLD = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
#: What the numbers 128 to 159 stand for: windows-1252 where it has a character.
_C1 = [bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)]


def _numbered(hexadecimal: Column) -> Column:
    """The character of a number in hexadecimal digits without leading zeros."""
    number = F.conv(F.substring(hexadecimal, 1, 7), 16, 10).cast("int")
    none = (F.length(hexadecimal) > 6) | (number == 0) | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    return F.when(none, F.lit("\ufffd")).when(
        number.between(128, 159), F.get(F.array(*map(F.lit, _C1)), number - 128)).otherwise(
        F.decode(F.unhex(F.lpad(hexadecimal, 8, "0")), "UTF-32"))


def _decoded(part: Column) -> Column:
    """A text from one ampersand to the next, with the reference it begins with decoded."""
    def begin(pattern: str) -> Column:
        return F.regexp_extract(part, pattern, 1)

    def instead(pattern: str, value: Column) -> Column:
        value = F.when(value == "\u00a0", F.lit(" ")).otherwise(value)
        return F.concat(value, F.regexp_replace(part, rf"\A{pattern}", ""))

    decimal, hexadecimal = r"&#0*([0-9]+);?", r"&#[xX]0*([0-9A-Fa-f]+);?"
    digits, name = begin(rf"\A{decimal}"), begin(r"\A&([A-Za-z][A-Za-z0-9]*;)")
    old = begin(rf"\A&({_OLD})")
    # eight decimal digits are above the last character
    from_decimal = F.when(F.length(digits) > 7, F.lit("FFFFFFF")).otherwise(F.conv(digits, 10, 16))
    value = F.try_element_at(_named(), name)
    return (F.when(~part.startswith("&"), part)
            .when(part.rlike(rf"\A{decimal}"), instead(decimal, _numbered(from_decimal)))
            .when(part.rlike(rf"\A{hexadecimal}"), instead(hexadecimal, _numbered(begin(rf"\A{hexadecimal}"))))
            .when(value.isNotNull(), instead(r"&[A-Za-z][A-Za-z0-9]*;", value))
            .when(old != "", instead(rf"&(?:{_OLD})", F.try_element_at(_named(), old)))
            .otherwise(part))


def unescaped(text: Column) -> Column:
    """``text`` with its character references decoded, each once: frequent ones by
    one look-up among a few, the others by all the rules."""
    few = F.str_to_map(F.lit("\x01".join(f"&{n}\x02{c}" for n, c in _FREQUENT)), F.lit("\x01"), F.lit("\x02"))
    parts = F.transform(F.split(text, "(?=&)"), lambda p: F.struct(p.alias("p"), F.substring_index(p, ";", 1).alias("head")))
    parts = F.transform(parts, lambda x: F.struct(x["p"].alias("p"), x["head"].alias("head"), F.try_element_at(few, x["head"]).alias("v")))

    def solved(x: Column) -> Column:
        size = F.length(x["head"])
        quick = x["v"].isNotNull() & (size < F.length(x["p"]))
        return F.when(quick, F.concat(x["v"], F.substring(x["p"], size + 2, F.length(x["p"])))).otherwise(_decoded(x["p"]))

    return F.when(text.contains("&"), F.array_join(F.transform(parts, solved), "")).otherwise(text)


def _replaced(text: Column, steps: tuple) -> Column:
    for pattern, with_ in steps:
        text = F.regexp_replace(text, pattern, with_)
    return text


def _bare(value: Column) -> Column:
    """An attribute value without its quotation marks."""
    return F.when(value.rlike("\\A[\"']"), F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def derivatives(found: DataFrame) -> DataFrame:
    """Two records for each response: ``metadata`` (title, language, links, and
    the conversion's identifier) and ``conversion`` (plain text)."""
    conversion_id = _uuid(F.concat_ws("|", F.lit("conversion"), "record_id", F.lit("text/plain")))
    metadata_id = _uuid(F.concat_ws("|", F.lit("metadata"), "record_id"))
    # step by step: what a column is used for more than once is computed once
    rows = found.withColumns({"text": _replaced(F.col("payload"), TEXT_STEPS), "title": F.regexp_extract("payload", TITLE, 1)})
    rows = rows.withColumns({"text": unescaped(F.col("text")), "title": unescaped(F.col("title"))})
    rows = rows.withColumns({
        "text": _replaced(F.col("text"), SPACE_STEPS), "conversion_id": conversion_id, "metadata_id": metadata_id,
        "language": _bare(F.regexp_extract("payload", LANGUAGE, 1)),
        "links": F.transform(F.regexp_extract_all("payload", F.lit(LINK), F.lit(1)), lambda x: unescaped(_bare(x)))})
    fields = F.concat(
        F.lit("title: "), "title", F.lit("\r\nlanguage: "), "language", F.lit("\r\nconversion: <"), "conversion_id", F.lit(">\r\n"),
        F.array_join(F.transform("links", lambda x: F.concat(F.lit("outlink: "), x, F.lit("\r\n"))), ""))
    rows = rows.withColumn("fields", fields)

    def record(kind: str, own_id: str, mime: str, content: str) -> Column:
        return F.struct(
            F.col("page_id"), F.lit(kind).alias("record_type"), F.col(own_id).alias("record_id"), F.col("record_id").alias("refers_to"),
            F.col("target_uri"), F.col("warc_date"), F.lit(mime).alias("content_type"), F.col("source_headers"), F.col("source_digest"),
            _digest(F.col(content)).alias("block_digest"), F.octet_length(content).cast("long").alias("content_length"), F.col(content).alias("content"))

    return rows.select(F.inline(F.array(
        record("metadata", "metadata_id", "application/warc-fields", "fields"),
        record("conversion", "conversion_id", "text/plain; charset=utf-8", "text"))))


def serialised(records: DataFrame) -> DataFrame:
    """Each record as the text of a WARC file: header lines, an empty line, the block."""
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), "record_type", F.lit("\r\nWARC-Record-ID: <"), "record_id", F.lit(">\r\nWARC-Refers-To: <"), "refers_to",
        F.lit(">\r\nWARC-Target-URI: "), "target_uri", F.lit("\r\nWARC-Date: "), "warc_date", F.lit("\r\nWARC-Block-Digest: "), "block_digest",
        F.lit("\r\nWARC-Source-Digest: "), "source_digest", F.lit("\r\nContent-Type: "), "content_type",
        F.lit("\r\nContent-Length: "), F.col("content_length").cast("string"), F.lit("\r\n\r\n"))
    return records.select("page_id", "record_id", F.concat(header, "content", F.lit("\r\n\r\n")).alias("record"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _oracle() -> str:
    """DuckDB SQL of the same records, written on its own: names are joined from a
    table, references taken apart at every ampersand, attributes unquoted by pattern."""
    text = "payload"
    line = lambda s: "chr(10)" if s == "\n" else _quoted(s)
    for pattern, with_ in TEXT_STEPS:
        text = f"regexp_replace({text}, {_quoted(pattern)}, {line(with_)}, 'g')"
    tidy = "decoded"
    for pattern, with_ in ((r"[ \t\r\x0B\x0C]+", " "), (r" ?\n[ \n]*", "\n"), (r"\A[ \n]+", ""), (r"[ \n]+\z", "")):
        tidy = f"regexp_replace({tidy}, {_quoted(pattern)}, {line(with_)}, 'g')"
    uuid = lambda k: f"'urn:uuid:' || regexp_replace(md5({k}), '(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})', '\\1-\\2-\\3-\\4-\\5')"
    end = "chr(13) || chr(10)"
    bare = lambda v: f"regexp_replace({v}, '^[\"'']((?s).*)[\"'']$', '\\1')"
    names = ", ".join(f"({_quoted(n)}, {_quoted(c)})" for n, c in sorted(html5.items()))
    old = "|".join(sorted((n for n in html5 if n[-1] != ";"), key=len, reverse=True))
    windows = ", ".join(str(ord(bytes([n]).decode("cp1252", "ignore") or chr(n))) for n in range(128, 160))
    return f"""
WITH names(ref, chars) AS (VALUES {names}),
r AS (
  SELECT row_number() OVER () AS k, page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS payload,
         'sha256:' || sha256(coalesce(html, '')) AS source_digest
  FROM pages
), i AS (
  SELECT *, {uuid("'response|' || coalesce(page_id::VARCHAR, '') || '|' || target_uri || '|' || source_digest")} AS rid,
         'HTTP/1.1 200 OK' || {end} || 'Content-Type: text/html; charset=utf-8' || {end} || 'Content-Length: ' || strlen(payload) || {end} AS source_headers
  FROM r
), encoded AS (
  SELECT k, 'text' AS what, 0 AS place, {text} AS s FROM i
  UNION ALL SELECT k, 'title', 0, regexp_extract(payload, {_quoted(TITLE)}, 1) FROM i
  UNION ALL SELECT k, 'link', unnest(generate_series(1, len(l))), unnest(l)
  FROM (SELECT k, list_transform(regexp_extract_all(payload, {_quoted(LINK)}, 1), lambda x: {bare("x")}) AS l FROM i)
), cut AS (
  SELECT k, what, place, unnest(generate_series(1, len(parts))) AS nth, unnest(parts) AS part
  FROM (SELECT *, string_split(s, '&') AS parts FROM encoded)
), seen AS (
  SELECT *, regexp_extract(part, '^#0*([0-9]+)', 1) AS dec, regexp_extract(part, '^#[xX]0*([0-9A-Fa-f]+)', 1) AS hex,
         regexp_extract(part, '^[A-Za-z][A-Za-z0-9]*;') AS name, regexp_extract(part, '^(?:{old})') AS bare_name
  FROM cut
), number AS (
  SELECT *, CASE WHEN dec <> '' THEN CASE WHEN length(dec) > 7 THEN 9999999 ELSE try_cast(dec AS BIGINT) END
                 WHEN hex <> '' THEN CASE WHEN length(hex) > 6 THEN 9999999 ELSE try_cast('0x' || hex AS BIGINT) END END AS code
  FROM seen
), known AS (
  SELECT n.*, a.chars AS of_name, b.chars AS of_bare,
         CASE WHEN code = 0 OR code > 1114111 OR code BETWEEN 55296 AND 57343 THEN chr(65533)
              WHEN code BETWEEN 128 AND 159 THEN chr([{windows}][code - 127])
              WHEN code IS NOT NULL THEN chr(code::INTEGER) END AS of_code
  FROM number n LEFT JOIN names a ON a.ref = name LEFT JOIN names b ON b.ref = bare_name
), solved AS (
  SELECT k, what, place, nth,
         CASE WHEN nth = 1 THEN part
              WHEN code IS NOT NULL THEN replace(of_code, chr(160), ' ') || regexp_replace(part, CASE WHEN dec <> '' THEN '^#[0-9]+;?' ELSE '^#[xX][0-9A-Fa-f]+;?' END, '')
              WHEN of_name IS NOT NULL THEN CASE WHEN of_name = chr(160) THEN ' ' ELSE of_name END || substr(part, length(name) + 1)
              WHEN of_bare IS NOT NULL THEN CASE WHEN of_bare = chr(160) THEN ' ' ELSE of_bare END || substr(part, length(bare_name) + 1)
              ELSE '&' || part END AS piece
  FROM known
), whole AS (
  SELECT k, what, place, string_agg(piece, '' ORDER BY nth) AS decoded FROM solved GROUP BY ALL
), t AS (
  SELECT i.*, {uuid("'conversion|' || rid || '|text/plain'")} AS cid, {uuid("'metadata|' || rid")} AS mid,
         (SELECT {tidy} FROM whole w WHERE w.k = i.k AND what = 'text') AS txt,
         (SELECT decoded FROM whole w WHERE w.k = i.k AND what = 'title') AS title,
         (SELECT string_agg('outlink: ' || decoded || {end}, '' ORDER BY place) FROM whole w WHERE w.k = i.k AND what = 'link') AS links
  FROM i
), f AS (
  SELECT *, 'title: ' || title || {end} || 'language: ' || {bare(f"regexp_extract(payload, {_quoted(LANGUAGE)}, 1)")} || {end}
         || 'conversion: <' || cid || '>' || {end} || coalesce(links, '') AS fields
  FROM t
), b AS (
  SELECT page_id, 'metadata' AS record_type, mid AS record_id, rid AS refers_to, target_uri, 'application/warc-fields' AS content_type, source_headers, source_digest, fields AS content FROM f
  UNION ALL
  SELECT page_id, 'conversion', cid, rid, target_uri, 'text/plain; charset=utf-8', source_headers, source_digest, txt FROM f
)
SELECT page_id, record_type, record_id, refers_to, target_uri, '{DATE}' AS warc_date, content_type, source_headers, source_digest,
       'sha256:' || sha256(content) AS block_digest, strlen(content)::BIGINT AS content_length, content
FROM b"""


ORACLE = _oracle()
