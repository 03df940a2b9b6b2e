import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from newsflow.functions import dates, ids, lexical, people, text, urls


def evaluate(spark, values, use, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r[1] for r in sorted(rows.select("i", use(F.col("v"))).collect())]


NAMES = [
    ("1. Tin", False), ("Ai đúng?", False), ("Hay quá!", False), ("A", False), ("0912345678 An", False),
    ("15/12 An", False), ("7:30 An", False), ("a b c d e f g", False), ("Báo a b c d e f g", True),
    ("BÁO a b c d e f g", True), ("a b c d e f, g", True), ("Mayer", False), ("Lan Anh", True),
    ("  Lan Anh  ", True), ("x" * 101, False), ("x" * 100, True), ("Ảnh: Lan", False), ("", False), (None, False),
]


def test_is_valid_author(spark):
    assert evaluate(spark, [n for n, _ in NAMES], people.is_valid_author) == [ok for _, ok in NAMES]


AUTHORS = [
    ("An Lan và Bình (TTXVN)", ["An Lan"]), ("Minh, Tú - Hà", ["Minh", "Tú", "Hà"]), ("(TTXVN)", ["Unknown"]),
    ("Minh VÀ Tú", ["Minh"]), ("Vàng Anh", ["Vàng Anh"]), ("a-b", ["a", "b"]), (" , ", ["Unknown"]),
]


def test_split_authors(spark):
    assert evaluate(spark, [a for a, _ in AUTHORS], people.split_authors) == [out for _, out in AUTHORS]


DATES = [
    ("2026-04-06T19:33:59+07:00", dt.datetime(2026, 4, 6, 19, 33)),
    ("Thứ hai, 6/4/2026, 17:02", dt.datetime(2026, 4, 6, 17, 2)),
    ("14:29 06/02/2024", dt.datetime(2024, 2, 6, 14, 29)),
    ("6-4-2026", dt.datetime(2026, 4, 6)),
    ("31/02/2024, 10:00", None), ("25:00 06/02/2024", None), ("0000-01-01 10:00", None),
    ("2026-04-06", None), ("", None), (None, None),
    ("2026-04-06  7:05", dt.datetime(2026, 4, 6, 7, 5)),
]


def test_parse_publish_date(spark):
    assert evaluate(spark, [d for d, _ in DATES], dates.parse_publish_date) == [out for _, out in DATES]


def test_first_publish_date_skips_the_impossible(spark):
    found = evaluate(spark, [["31/02/2024, 10:00", "01/03/2024"], []], dates.first_publish_date, "array<string>")
    assert found == [dt.datetime(2024, 3, 1), None]


STORED = [
    ("2024-02-29 01:02:03", True), ("2024-2-9 1:2:3", True), ("2023-02-29 01:02:03", False),
    ("2024-02-29 01:02:60", False), ("2024-02-29 01:02", False), ("2024-02-29 01:02:03 ", False),
    ("2024-02-29 01:02:03\n", False), ("Unknown", False), (None, False),
]


def test_stored_timestamp(spark):
    found = evaluate(spark, [d for d, _ in STORED], dates.stored_timestamp)
    assert [f is not None for f in found] == [ok for _, ok in STORED]


def test_format_publish_date(spark):
    rows = spark.sql("SELECT timestamp_ntz'2024-02-06 14:29:00' AS v UNION ALL SELECT NULL")
    assert {r[0] for r in rows.select(dates.format_publish_date(F.col("v"))).collect()} == {
        "2024-02-06 14:29:00", "Unknown"}


CLEAN = [
    ("A Ảnh: AFP. B", "A  B"), ("A ẢNH: AFP. B", "A  B"), ("A. Bản quyền thuộc về X.\nB", "A."),
    (" a  b\x1cc\t", "a b c"), ("Viİdeo: không. deo: x. z", "Viİdeo: không. deo: x. z"),
    ("vİdeo: x. y", "vİdeo: x. y"), (None, ""), ("", ""),
    ("một Vid" "Chia sẻ bài viết qua email" "eo: hai. ba", "một Video: hai. ba"),
]


def test_clean_text(spark):
    """The last case: removing one piece of boilerplate may put another together."""
    import re

    def expected(value):
        out = re.sub(r"\s+", " ", value or "")
        for pattern in text.JUNK_PATTERNS:
            out = re.sub(pattern, "", out, flags=re.IGNORECASE)
        return out.strip()

    values = [v for v, _ in CLEAN]
    found = evaluate(spark, values, text.clean_text)
    plain = [i for i, v in enumerate(values) if "İ" not in (v or "")]
    assert [found[i] for i in plain] == [expected(values[i]) for i in plain]
    assert found[0] == "A  B" and found[2] == "A."


def test_white_space_is_that_of_unicode(spark):
    spaces = "".join(chr(c) for c in range(0x3100) if chr(c).isspace())
    assert evaluate(spark, [f"a{spaces}b{spaces}"], text.clean_text) == ["a b"]
    assert sorted(text.SPACE_CHARS) == sorted(spaces)


LINKS = [
    ("https://d/a/b?x=1#f", "/x", "https://d/x"), ("https://d/a/b", "c", "https://d/a/c"),
    ("https://d", "c", "https://d/c"), ("https://d/a/b", "../c", "https://d/c"), ("https://d/a/b/", "./c", "https://d/a/b/c"),
    ("https://d/a/b", "../../../c", "https://d/c"), ("https://d/a", "//e/f", "https://e/f"),
    ("https://d/a", "http://e/f", "http://e/f"), ("https://d/a/b?x", "?y=2", "https://d/a/b?y=2"),
    ("https://d/a/b", "c/..", "https://d/a/"), ("https://d/a/b", "", "https://d/a/b"),
    ("https://d/a/b", "/x/../y?q=a/../b", "https://d/y?q=a/../b"),
]


def test_resolve_link(spark):
    from urllib.parse import urljoin

    rows = spark.createDataFrame([(i, b, l) for i, (b, l, _) in enumerate(LINKS)], "i INT, b STRING, l STRING")
    found = [r[1] for r in sorted(rows.select("i", urls.resolve_link(F.col("b"), F.col("l"))).collect())]
    assert found == [out for _, _, out in LINKS]
    assert found == [urljoin(b, l) for b, l, _ in LINKS]


KINDS = [
    ("https://d/x/y.html", "article"), ("https://d/news", "category"), ("https://d/a/b", "category"),
    ("https://d/a/b/c", None), ("http://d/x", None), ("https://d/x.amp", "article"),
]


def test_link_kind(spark):
    assert evaluate(spark, [u for u, _ in KINDS], lambda u: urls.link_kind(u, F.lit("d"))) == [k for _, k in KINDS]


@pytest.mark.parametrize("url,domain", [("https://a.b/c", "a.b"), ("a.b/c", "a.b/c"), ("x//b", "b")])
def test_domain_of(spark, url, domain):
    assert evaluate(spark, [url], urls.domain_of) == [domain]


def test_point_id_is_uuid5(spark):
    rows = spark.createDataFrame([(a, c) for a in (1, 7, 123456789012) for c in (0, 3, 99)], "a BIGINT, c INT")
    for a, c, found in rows.select("a", "c", ids.point_id(F.col("a"), F.col("c"))).collect():
        assert found == str(uuid.uuid5(uuid.NAMESPACE_DNS, f"article_{a}_chunk_{c}"))
    assert str(uuid.uuid5(uuid.NAMESPACE_DNS, "article_7_chunk_3")) == "aac26458-5d34-5dc7-9994-56171d070dce"


def test_token_counts_and_weights(spark):
    found = evaluate(spark, ["b a B, a_a", "", None], lexical.token_counts)
    assert [[tuple(e) for e in row] for row in found] == [[("a", 3), ("b", 2)], [], []]


def test_max_by_token_keeps_the_largest(spark):
    rows = spark.sql("SELECT from_json('[{\"id\":5,\"weight\":1},{\"id\":2,\"weight\":3},{\"id\":5,\"weight\":2}]', 'array<struct<id:int,weight:double>>') AS e")
    assert [tuple(x) for x in rows.select(lexical.max_by_token(F.col("e"))).first()[0]] == [(2, 3.0), (5, 2.0)]


def test_cosine(spark):
    rows = spark.sql("SELECT array(3F, 4F) AS a, array(4F, 3F) AS b, array(0F, 0F) AS z")
    assert rows.select(F.round(lexical.cosine(F.col("a"), F.col("b")), 6), lexical.cosine(F.col("a"), F.col("z"))).first()[:] == (0.96, 0.0)
