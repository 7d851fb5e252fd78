import hashlib
import zlib

import pytest

from ledgerloom.llm import warc
from ledgerloom.llm.common import file_system


def pages(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return df.selectExpr("*", "1 AS key", "2 AS file", "3 AS digest", "4 AS offset") if extra else df


def brute(rows):
    out = []
    for i, url, html in rows:
        data = (html or "").encode()
        first = None
        if len(data) >= 1000:
            same = [j for j, _, h in rows if (h or "").encode() == data and j is not None]
            first = max(same, default=None)
        revisit = first is not None and i != first
        out.append((i, url, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


ROWS = [(i, f"http://h{i % 4}.example.com/{i % 9}?q=ü", "x" * (i * 37) + ("é" if i % 3 else "")) for i in range(60)]
ROWS += [(100 + i, "https://hot.example.org/", "same " * 300) for i in range(30)] + [(200 + i, "https://hot.example.org/", "short") for i in range(5)]
ROWS += [(300, None, None), (301, "", ""), (302, "not a url", "a"), (303, "http://u:p@[::1]:8080/x\r\ny", "b" * 2000), (None, "//x", "b" * 2000),
         (304, "http://127.0.0.1:80", "\r\n\r\nContent-Length: 3\r\n\r\n")]


def test_every_record_comes_back(spark):
    got = sorted(map(tuple, warc.archive_and_read(spark, pages(spark, ROWS, extra=True)).collect()), key=str)
    want = [(i, u if u is None else u.replace("\r", "%0D").replace("\n", "%0A"), *r) for i, u, *r in brute(ROWS)]
    assert got == sorted(want, key=str)


def test_index_blocks_and_directory(spark, tmp_path):
    folder = f"file://{tmp_path}"
    captures = warc.write(pages(spark, ROWS), f"{folder}/archive")
    directory = warc.index(captures, f"{folder}/index", lines=7)
    assert directory.count() >= len(ROWS) // 7
    wanted = spark.createDataFrame([("https://hot.example.org/", 110), ("https://hot.example.org/", 999), ("http://absent/", 1),
                                    (None, 300)], "url string, page_id long")
    rows = warc.lookup(wanted, directory, f"{folder}/archive", f"{folder}/index").collect()
    assert sorted((r.page_id, r.record_type) for r in rows) == [(110, "revisit"), (300, "response")]
    # every record is a gzip member of its own
    c = captures.first()
    fs, root = file_system(f"{folder}/archive")
    with fs.open_input_file(f"{root}/{c.file}") as f:
        assert zlib.decompress(f.read_at(c.length, c.offset), 31).startswith(b"WARC/1.1\r\n")


def test_damage_is_found(spark, tmp_path):
    folder = f"file://{tmp_path}"
    captures = warc.write(pages(spark, [(1, "http://a/", "text")]), f"{folder}/archive")
    c = captures.first()
    z = zlib.compressobj(3, zlib.DEFLATED, 31)
    data = z.compress(warc.record(1, "http://a/", b"tex!", hashlib.sha1(b"text").hexdigest(), None)) + z.flush()
    (tmp_path / "archive" / c.file).write_bytes(data)
    directory = warc.index(captures.selectExpr("key", "page_id", "file", "offset", f"{len(data)}L AS length"), f"{folder}/index")
    with pytest.raises(Exception, match="damaged record"):
        warc.lookup(pages(spark, [(1, "http://a/", "")]), directory, f"{folder}/archive", f"{folder}/index").collect()


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "http://a/", "y" * 1500)] * 3 + [(0, "http://a/", "y" * 1500)]
    got = sorted(map(tuple, warc.archive_and_read(spark, pages(spark, rows)).collect()))
    assert [(r[0], r[4], r[5]) for r in got] == [(0, "revisit", 1)] + [(1, "response", None)] * 3
    assert warc.archive_and_read(spark, pages(spark, [])).count() == 0


def test_keys_sort_hosts_together():
    assert warc.url_key("https://User@WWW.Example.com:443/a?b#c") == "com,example,www)/a?b"
    assert warc.url_key("http://10.0.0.1:8080") == "10.0.0.1:8080)/"
    assert warc.url_key(None) == ")"
