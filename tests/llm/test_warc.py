"""WARC archives: round trips, revisits, equal files whatever the partitions, and archives that were tampered with."""

import base64
import glob
import gzip
import hashlib
import os
import random

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from annospark.llm import warc
from annospark.llm.common import shared_folder

PAGES = "page_id long, url string, html string, kind string, part int, digest string"


def pages(spark, rows):
    """Rows (page_id, url, html) with extra columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, "k", 9, "d") for r in rows], PAGES)


def plain(path: str) -> str:
    return path.removeprefix("file:")


def archive(spark, rows, **more):
    path = shared_folder(spark, "warc")
    warc.write_pages(rows, path, **more)
    return path


def digest(html) -> str:
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows, least=0):
    """Result by the contract, where ids are unique."""
    out = []
    for page_id, _, html in rows:
        size = len((html or "").encode())
        head = max(p for p, _, h in rows if (h or "") == (html or ""))
        revisit = size >= least and page_id != head
        out.append((page_id, size, digest(html), "revisit" if revisit else "response", head if revisit else None))
    return sorted(out)


HTML = [None, "", "<p>a</p>", "<p>a</p>", "ünï 漢字\r\n\r\nHTTP/1.1 200 OK", "WARC/1.1\r\nContent-Length: 5\r\n\r\n", "x" * 300_000, "<p>a</p>", "\x00", "", "x" * 300_000]


def rows_of(html):
    return [(i * 7 % 1000 - 20, None if i % 5 == 0 else f"http://h.example/{i}?a b\r\nX: y", h) for i, h in enumerate(html)]


def test_round_trip_with_nulls_odd_urls_and_equal_payloads(spark):
    rows = rows_of(HTML)
    path = archive(spark, pages(spark, rows))
    got = warc.read_pages(spark, path, payloads=True).collect()
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected(rows)
    html = {p: h or "" for p, _, h in rows}
    by_record = {r.record_id: r for r in got}
    assert len(by_record) == len(rows)
    for r in got:
        if r.record_type == "response":
            assert bytes(r.payload).decode() == html[r.page_id] and warc.payload_at(spark, path, r.file, r.offset, r.length).decode() == html[r.page_id]
        else:
            head = by_record[r.refers_to_record]
            assert r.payload is None and head.page_id == r.refers_to and head.record_type == "response" and head.payload_digest == r.payload_digest
        assert "\r" not in r.url and " " not in r.url


def test_small_payloads_are_all_responses(spark):
    rows = rows_of(HTML)
    got = warc.read_pages(spark, archive(spark, pages(spark, rows), revisit_bytes=9)).collect()
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected(rows, 9)


def test_null_ids_repeated_ids_and_repeated_rows(spark):
    rows = [(5, "u", "same"), (5, "u", "same"), (5, "v", "same"), (5, "u", "other"), (None, "u", "same"), (None, "n", "lone"), (None, "n", "lone"), (3, "w", "same")]
    got = sorted(((r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_pages(spark, archive(spark, pages(spark, rows))).collect()), key=str)
    same, other, lone = digest("same"), digest("other"), digest("lone")
    assert got == sorted([
        (5, same, "response", None), (5, same, "revisit", 5), (5, same, "revisit", 5), (5, other, "response", None), (None, same, "revisit", 5),
        (None, lone, "response", None), (None, lone, "revisit", None), (3, same, "revisit", 5),
    ], key=str)


def test_empty_table(spark):
    path = archive(spark, pages(spark, []))
    assert warc.read_pages(spark, path).count() == 0 and spark.read.parquet(f"{path}/manifest").count() == 0


def test_files_depend_on_rows_alone_and_roll_by_compressed_size(spark):
    rng = random.Random(3)
    html = ["".join(rng.choice("abcdefgh <>\n") for _ in range(rng.randrange(4000))) for _ in range(600)]
    html += html[:200] + ["hot"] * 300
    rows = [(i, f"http://x/{i}", h) for i, h in enumerate(html)]
    rng.shuffle(rows)
    files = []
    for n in (1, 7):
        path = archive(spark, pages(spark, rows).repartition(n), range_bytes=1 << 18, file_bytes=20_000)
        files.append({os.path.basename(f): open(f, "rb").read() for f in glob.glob(f"{plain(path)}/data/*.gz")})
        assert not [f for f in os.listdir(f"{plain(path)}/data") if f.endswith(".tmp")]
        rows = rows[::-1]
    assert files[0] == files[1] and len({f.split("-")[1] for f in files[0]}) > 3
    assert all(len(x) < 20_000 + 5_000 for x in files[0].values()) and any(f.endswith("-00001.warc.gz") for f in files[0])
    manifest = {r.file: (r.records, r.bytes, r.sha1) for r in spark.read.parquet(f"{path}/manifest").collect()}
    assert {f: (len(x), base64.b32encode(hashlib.sha1(x).digest()).decode()) for f, x in files[0].items()} == {f: m[1:] for f, m in manifest.items()}
    assert sum(m[0] for m in manifest.values()) == len(rows)
    # In order of names the ids ascend, and any gzip reader gives the same text.
    whole = b"".join(gzip.decompress(files[0][f]) for f in sorted(files[0]))
    ids = [int(x.split(b"\r\n")[0]) for x in whole.split(b"\r\nX-Page-ID: ")[1:]]
    assert ids == sorted(ids) and len(ids) == len(rows)
    got = warc.read_pages(spark, path).collect()
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected(rows)


def test_what_a_lost_attempt_has_left_is_not_read(spark, tmp_path):
    path = archive(spark, pages(spark, [(1, "u", "a"), (2, "u", "b")]))
    open(f"{plain(path)}/data/part-000000-00009.warc.gz", "wb").write(b"junk")
    assert warc.read_pages(spark, path).count() == 2


def test_commit_may_be_repeated(spark):
    path = archive(spark, pages(spark, [(1, "u", "a"), (2, "u", "b")]))
    staged = spark.read.parquet(f"{path}/staged")
    assert staged.mapInArrow(warc._commit(warc._qualified(spark, path) + "/data"), warc._FILES).count() == staged.count()
    name = os.listdir(f"{plain(path)}/data")[0]
    os.remove(f"{plain(path)}/data/{name}")
    with pytest.raises(PythonException):
        staged.mapInArrow(warc._commit(warc._qualified(spark, path) + "/data"), warc._FILES).count()


def test_tampered_archives_are_refused(spark):
    path = archive(spark, pages(spark, [(i, "u", f"text {i}" * 50) for i in range(20)]))
    name = next(f for f in sorted(os.listdir(f"{plain(path)}/data")) if f.endswith(".gz"))
    file = f"{plain(path)}/data/{name}"
    was = open(file, "rb").read()
    changed = gzip.compress(gzip.decompress(was).replace(b"text 3text", b"text 4text", 1))
    for content in (changed, was[:-40], was + was):
        open(file, "wb").write(content)
        for crc in glob.glob(f"{plain(path)}/data/.*.crc"):
            os.remove(crc)
        with pytest.raises(PythonException):
            warc.read_pages(spark, path).count()
    open(file, "wb").write(was)
    assert warc.read_pages(spark, path).agg(F.count("*")).first()[0] == 20
