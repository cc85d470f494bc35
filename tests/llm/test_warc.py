"""WARC archives: round trips of any payload, and the contract of revisits."""

import hashlib

from pyspark.sql import functions as F

from orderlens.llm import warc
from orderlens.session import staged

SCHEMA = "page_id long, url string, html string, record_type string"


def captured(spark, rows, folder, with_payload=True):
    pages = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    warc.write_archives(pages, str(folder))
    return staged(warc.read_records(spark, str(folder), with_payload)), pages


def expected(rows):
    owner = {}
    for page, url, html in rows:
        if len((html or "").encode()) >= 1000:
            key = (page is not None, page or 0, url is not None, url or "")
            owner[html] = max(owner.get(html, key), key)
    out = []
    for page, url, html in rows:
        raw = (html or "").encode()
        first = owner.get(html)
        mine = (page is not None, page or 0, url is not None, url or "")
        again = first is not None and first != mine
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", first[1] if again else None))
    return sorted(out, key=str)


def found(records):
    rows = warc.assemble(records).select(
        "metadata.page_id",
        "first.payload_bytes",
        "first.payload_digest",
        "exchange.record_type",
        F.when(F.col("exchange.record_type") == "revisit", F.col("first.page_id")),
    )
    return sorted((tuple(r) for r in rows.collect()), key=str)


TRAP = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabc" * 40


def test_payloads_of_any_kind(spark, tmp_path):
    rows = [
        (1, "http://a/1", "x" * 1000),
        (5, "http://a/5", "x" * 1000),
        (3, None, "x" * 1000),
        (4, "http://a/4", "x" * 999),
        (6, "http://a/6", "x" * 999),
        (7, "http://a/\r\nX: 7", None),
        (8, "http://a/8", ""),
        (9, "http://a/9", TRAP),
        (10, "http://a/10", TRAP),
        (11, "http://a/11", "é中\U0001f600" * 700),
        (12, "http://a/12", "line\r\n" * 200_000),
        (None, "http://a/n", "x" * 1000),
        (13, "http://a/13", "same row"),
        (13, "http://a/13", "same row"),
    ]
    records, _ = captured(spark, rows, tmp_path / "w")
    assert found(records) == expected(rows)
    payloads = {bytes(r.payload).decode() for r in records.where("record_type = 'response'").collect()}
    assert payloads == {h or "" for _, _, h in rows}
    light, _ = captured(spark, rows, tmp_path / "v", with_payload=False)
    assert found(light) == expected(rows)


def test_captures_are_assembled_by_concurrent_ids(spark, tmp_path):
    records, _ = captured(spark, [(1, "http://a/1", "y" * 2000), (2, "http://a/2", "y" * 2000)], tmp_path / "w")
    rows = {r.metadata.page_id: r for r in warc.assemble(records).collect()}
    assert all(r.request.target_uri == f"http://a/{page}" for page, r in rows.items())
    assert rows[1]["first"].id == rows[2].record_id == rows[2]["first"].id
    partial = records.where("record_type <> 'request'")
    assert all(r.request is None for r in warc.assemble(partial).collect())


def test_a_broken_archive_is_an_error(tmp_path):
    import io

    import pytest

    whole = b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert list(warc.parse(io.BytesIO(whole * 2)))[1][1] == b"abc"
    for broken in (whole[:-6], whole[:20], b"junk\r\n" + whole):
        with pytest.raises(ValueError):
            list(warc.parse(io.BytesIO(broken)))


def test_empty_table(spark, tmp_path):
    records, _ = captured(spark, [], tmp_path / "w")
    assert found(records) == []
