import gzip
import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from textmill.functions import records as R
from textmill.functions import text as T

CRLF = "\r\n"


def one(spark, column, *values, names=("x",), kinds=("binary",)):
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True))
    return spark.createDataFrame([tuple(values)], schema).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "data, pattern, at",
    [
        (b"\x01\x02\x03\x04\x05", b"\x01\x02", 0), (b"\x01\x02\x03\x04\x05", b"\x03\x04", 2), (b"\x01\x02\x03\x04\x05", b"\x04\x05", 3),
        (b"\x01\x02\x03\x04\x05", b"\x06\x07", -1), (b"", b"\x01\x02", -1), (b"\x01\x02\x03", b"\x02", 1),
        (b"A\r\n\r\nB", b"\r\n\r\n", 1), (b"\x01\x02", b"\x01\x02\x03\x04", -1), (b"ab", b"", 0),
    ],
)
def test_find_pattern(spark, data, pattern, at):
    assert one(spark, R.find_pattern("x", pattern), bytearray(data)) == at


def warc(body, status=200, head="Content-Type: application/octet-stream", warc_length=True, tail=b"", name="Content-Length"):
    http = f"HTTP/1.1 {status} OK{CRLF}{head}{CRLF}{CRLF}".encode() if head else f"HTTP/1.1 {status} OK{CRLF}{CRLF}".encode()
    line = f"{name}: {len(http) + len(body)}{CRLF}" if warc_length else ""
    return f"WARC/1.0{CRLF}WARC-Type: response{CRLF}{line}{CRLF}".encode() + http + body + tail


@pytest.mark.parametrize(
    "raw, content, status, kind",
    [
        (warc(b"hello"), b"hello", 200, "application/octet-stream"),
        (warc(b"x", 404), b"x", 404, "application/octet-stream"),
        (warc(b"x", 500), b"x", 500, "application/octet-stream"),
        (warc(b"x", head="content-type: text/plain"), b"x", 200, "text/plain"),
        (warc(b"\x00\xff\x50\x4b\x03\x04"), b"\x00\xff\x50\x4b\x03\x04", 200, "application/octet-stream"),
        (warc(b""), b"", 200, "application/octet-stream"),
        (warc(b"hello", head="Content-Length: 5", tail=b"\r\n\r\n"), b"hello", 200, ""),
        (warc(b"hello", tail=b"\r\n\r\n"), b"hello", 200, "application/octet-stream"),
        (warc(b"hello", warc_length=False, tail=b"\r\n\r\n"), b"hello\r\n\r\n", 200, "application/octet-stream"),
        (warc(b"hello", head="Content-Length: 9999999", warc_length=False), b"hello", 200, ""),
        (warc(b"hello", head=""), b"hello", 200, ""),
    ],
)
def test_parse_warc(spark, raw, content, status, kind):
    r = one(spark, R.parse_warc("x"), bytearray(raw))
    assert (bytes(r.content), r.http_status, r.content_type, r.content_length, r.error) == (content, status, kind, len(content), None)


def test_parse_warc_errors(spark):
    a = one(spark, R.parse_warc("x"), bytearray(b"no separator"))
    b = one(spark, R.parse_warc("x"), bytearray(b"WARC/1.0\r\n\r\nHTTP/1.1 200 OK\r\nX: y"))
    assert a.content is None and b.content is None and a.error != b.error


def test_validate_docx(spark):
    pad = b"\x00" * 120
    both = b"[Content_Types].xml word/document.xml"
    cases = [
        (b"PK\x03\x04" + both + pad, None), (b"\x00" * 50, "too small"), (b"NOT_A_ZIP_FILE" + pad, "wrong magic bytes"),
        (b"PK\x03\x04word/document.xml" + pad, "[Content_Types].xml"), (b"PK\x03\x04[Content_Types].xml" + pad, "word/document"),
        (b"PK\x03\x04\x00\x00[Content_Types].xml\x00word/document\x00" + pad, None),
    ]
    for data, error in cases:
        r = one(spark, R.validate_docx("x"), bytearray(data))
        assert r.is_valid == (error is None)
        assert r.error is None if error is None else error in r.error


def test_gunzip(spark):
    assert bytes(one(spark, R.gunzip_or_raw("x"), bytearray(gzip.compress(b"abc")))) == b"abc"
    assert bytes(one(spark, R.gunzip_or_raw("x"), bytearray(b"plain"))) == b"plain"


def docx(comment=b""):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("[Content_Types].xml", "<x/>" * 20)
        z.writestr(
            "word/document.xml",
            '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body><w:p><w:r><w:t>Hello</w:t></w:r></w:p>'
            "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>",
        )
        z.comment = comment
    return out.getvalue()


def test_zip_tail(spark):
    base, tail = docx(), b"\r\n\r\n"
    at = base.index(b"Hello")
    cases = [
        (base, "already-clean", None), (base + tail, "trimmed", base), (base + b"junkjunk", "skipped-excess-differs", None),
        (base + b"\r\n\r", "skipped-excess-differs", None), (base + tail + b"x", "skipped-excess-differs", None),
        (b"plain text, no archive at all here", "skipped-non-zip", None), (docx(b"comment"), "already-clean", None), (docx(b"comment") + tail, "trimmed", docx(b"comment")),
        (docx(b"PK\x05\x06 in a comment that is long enough to hold a record") + tail, "skipped-no-eocd", None),
        (b"PK\x03\x04" + b"x" * 40, "skipped-no-eocd", None), (base[:-10], "skipped-no-eocd", None), (base[:-2] + b"\xff\xff", "skipped-no-eocd", None),
        (base[:at] + b"Jello" + base[at + 5 :] + tail, "skipped-testzip-failed", None), (b"PK\x03\x04", "skipped-non-zip", None), (b"", "skipped-non-zip", None), (None, None, None),
        (base + b"y" * 70_000, "skipped-no-eocd", None), (docx(b"c" * 65_535) + tail, "skipped-no-eocd", None), (docx(b"c" * 65_531) + tail, "trimmed", docx(b"c" * 65_531)),
    ]
    rows = spark.createDataFrame([(i, x and bytearray(x) if x is not None else None) for i, (x, _, _) in enumerate(cases)], "i int, x binary")
    for r in rows.select("i", R.repaired("x").alias("r")).collect():
        _, status, candidate = cases[r.i]
        assert (r.r.status, r.r.candidate and bytes(r.r.candidate)) == (status, candidate), (r.i, status)


def test_extraction(spark):
    rows = spark.createDataFrame([(bytearray(docx()),), (bytearray(b"bad"),)], "x binary").select(R.extracted("x").alias("r")).collect()
    good, bad = rows[0].r, rows[1].r
    assert good.text == "Hello" and good.tables == [[["a", "b"]]] and good.error is None
    assert bad.error and bad.text is None


def test_table_text(spark):
    tables = [[["a", " b "], ["", " "]], [[]], [["c"]]]
    assert one(spark, T.table_text("x"), tables, kinds=("array<array<array<string>>>",)) == "a | b\n\nc"


def test_language(spark):
    text = "the cat and the dog is in the house of the man and it was on the mat with all"
    r = spark.createDataFrame([(text,), ("short",), (None,)], "x string").select(R.language("x").alias("r")).collect()
    assert r[0].r.language == "en" and r[1].r.language == "unknown" and r[2].r.confidence == 0.0


@pytest.mark.parametrize(
    "url, name",
    [
        ("https://example.com/doc.docx", "doc.docx"), ("https://example.com/files/reports/doc.docx", "doc.docx"),
        ("https://example.com/my%20doc.docx", "my doc.docx"), ("https://example.com/file%26name%3D1.docx", "file&name=1.docx"),
        ("https://example.com/doc.docx?v=1", "doc.docx"), ("https://example.com/", "unknown.docx"),
        ("https://example.com/files/", "unknown.docx"), ("https://example.com", "unknown.docx"), ("not a valid url", "unknown.docx"),
        ("https://example.com/a+b.docx", "a+b.docx"), ("https://example.com/a%zz", "unknown.docx"),
    ],
)
def test_filename(spark, url, name):
    assert one(spark, T.filename_from_url("x"), url, kinds=("string",)) == name


def test_hash_and_ids(spark):
    for data in (b"", b"\x00\xff", b"B" * (1 << 20)):
        assert one(spark, T.content_id("x"), bytearray(data)) == hashlib.sha256(data).hexdigest()
    df = spark.createDataFrame([("u", "A"), ("u", "B"), ("v", "A")], "url string, crawl string")
    ids = [r[0] for r in df.select(T.duplicate_id("url", "crawl")).collect()]
    assert len(set(ids)) == 3 and all(i.startswith("dup-") for i in ids)
    assert len({r[0] for r in df.select(T.failed_id("url")).collect()}) == 2


def test_text_functions(spark):
    def s(column, x):
        return one(spark, column, x, kinds=("string",))

    assert s(T.word_count("x"), " a b\n c ") == 3
    assert s(T.trim_spaces("x"), "  a  ") == "a"
    assert s(T.char_count("x"), "a😀") == 2 and s(T.js_length("x"), "a😀") == 3
    assert s(T.json_list_length("x", "$.t"), '{"t": [1, 2]}') == 2 and s(T.json_list_length("x", "$.t"), "{}") == 0
    assert s(T.domain("x"), "https://U@Ex.org:80/a") == "U@Ex.org:80" and s(T.domain("x"), "no url") == "unknown"
    assert s(T.chunks("x", 10, 8), "a" * 25) == ["a" * 10, "a" * 10, "a" * 9]
    assert s(T.chunks("x"), "  ") == [] and s(T.chunks("x"), " ab ") == ["ab"]
    assert s(T.label_of("x", {"a": "A"}), "a") == "A" and s(T.label_of("x", {"a": "A"}), "b") == "b"
    assert s(T.correction_outcome("x"), "skipped-no-eocd").asDict() == {"status": "skipped", "reason": "no-eocd"}
    assert s(T.prompt("H", "x", F.lit("f.docx")), "t") == 'H\n\n## Document\n- Filename: f.docx\n"""\nt\n"""\n'
    pictures = [((b"x", 1),)]
    df = spark.createDataFrame([([(1, "im")],)], "p array<struct<n: int, image: string>>")
    assert df.select(T.without_images("p").alias("r")).first().r[0].asDict() == {"n": 1} and pictures


def test_answers(spark):
    def s(x):
        return one(spark, T.parse_answer("x"), x, kinds=("string",))

    good = s('ok {"document_type": {"id": "legal", "confidence": 0.9}, "topic": {"id": "zzz", "confidence": 0.4}} end')
    assert (good.document_type, good.document_topic, good.confidence, good.reasoning) == ("legal", "general", 0.4, "")
    for bad in ("", "{", '{"document_type": {"id": "legal"}}', None):
        r = s(bad)
        assert (r.document_type, r.confidence, r.reasoning) == ("general", 0.0, "Failed to parse LLM response")


def test_compression_hands_results_over_in_pieces(spark):
    import pyarrow as pa

    values = [bytes([i]) * 700_000 for i in range(9)] + [None, b""]
    pieces = list(R.in_pieces(pa.array(values, pa.binary()), lambda x: x + b"."))
    assert [x for p in pieces for x in p.to_pylist()] == [None if v is None else v + b"." for v in values]
    assert max(p.nbytes for p in pieces) < 2 * R.PIECE_BYTES and list(R.in_pieces(pa.array([], pa.binary()), len)) == []
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x binary").coalesce(1)
    got = {r.i: r for r in rows.select("i", R.gunzip_or_raw(R.gzipped("x")).alias("x"), R.gunzip_or_raw("x").alias("raw")).collect()}
    assert all(got[i].x == v and got[i].raw == v for i, v in enumerate(values))
