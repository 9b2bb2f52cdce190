"""WARC archives: exact round trip, chunking, revisits and damage."""

import hashlib
import random

import pytest
from tokenweave.llm import warc


def pages(n=40):
    rng = random.Random(3)
    body = ["<p>" + "é€x"[k % 3] * rng.choice([0, 10, 999, 1000, 3000, 90_000]) for k in range(12)]
    rows = [(i * 7, f"http://h/{i}?a b\r\nX: 1", rng.choice(body)) for i in range(n)]
    return rows + [(1000, None, None), (1001, "", ""), (None, "u", body[0] * 50 + "z" * 2000), (1002, "u", body[0] * 50 + "z" * 2000),
                   (1002, "u", body[0] * 50 + "z" * 2000), (3, "u", body[0] * 50 + "z" * 2000), (1003, "long", "y\r\n\r\n" * 200_000)]


def expected(rows):
    top = {}
    for i, _, html in rows:
        if i is not None:
            top[html] = max(top.get(html, i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= 1000 and i is not None and i < top[html]
        out.append((str(i), len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", str(top[html]) if revisit else None))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, digest string, payload int").repartition(4)


@pytest.mark.parametrize("chunk", [300, 32 << 10])
def test_round_trip(spark, tmp_path, chunk):
    rows = pages()
    path = str(tmp_path / "table")
    warc.write_archives(frame(spark, rows), path, chunk_bytes=chunk)
    got = warc.read_archives(spark, path).collect()
    assert sorted(((str(r.page), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(rows)
    table = spark.read.parquet(path)
    assert table.selectExpr("max(octet_length(data))").collect()[0][0] <= chunk
    assert {r.record_type for r in got} == {"response", "revisit"}


def test_exported_files_are_warc(spark, tmp_path):
    rows = pages(20)
    warc.write_archives(frame(spark, rows), str(tmp_path / "t"), chunk_bytes=500)
    done = warc.export_archives(spark, str(tmp_path / "t"), f"file://{tmp_path}/out").collect()
    files = sorted((tmp_path / "out").glob("*.warc"))
    assert len(files) == len(done) >= 1
    kinds, bodies = [], {}
    for f in files:
        data = f.read_bytes()
        while data:  # a plain reader of the format
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            assert head.startswith(b"WARC/1.1\r\n") and len(head.split(b"\r\n")) - 1 == len(fields)
            block, data = rest[:int(fields["Content-Length"])], rest[int(fields["Content-Length"]):]
            assert data.startswith(b"\r\n\r\n")
            data = data[4:]
            kinds.append(fields["WARC-Type"])
            if kinds[-1] == "response":
                body = block.partition(b"\r\n\r\n")[2]
                assert hashlib.sha1(body).hexdigest() == fields["WARC-Payload-Digest"][5:]
                bodies.setdefault(fields["WARC-Record-ID"], body)
    assert len(kinds) == len(rows)
    assert {b.decode() for b in bodies.values()} == {r[2] or "" for r in rows}


def test_damage_is_found(spark, tmp_path):
    path = str(tmp_path / "t")
    warc.write_archives(frame(spark, [(1, "u", "a" * 5000)]), path, chunk_bytes=1000)
    table = spark.read.parquet(path)
    bad = str(tmp_path / "bad")
    table.withColumn("data", table.data.substr(1, 999)).write.partitionBy("oversized").parquet(bad)
    with pytest.raises(Exception, match="damaged|cut short"):
        warc.read_archives(spark, bad).collect()
    gap = str(tmp_path / "gap")
    table.where("chunk_no <> 2").write.partitionBy("oversized").parquet(gap)
    with pytest.raises(Exception, match="out of order"):
        warc.read_archives(spark, gap).collect()


def test_empty_table(spark, tmp_path):
    warc.write_archives(frame(spark, pages()).limit(0), str(tmp_path / "t"))
    assert warc.read_archives(spark, str(tmp_path / "t")).collect() == []
