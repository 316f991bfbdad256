"""Archives with damaged, foreign and nested records, and what the reader tells of them."""

from __future__ import annotations

import gzip
import random
import time

import pytest

from rowtide.llm import warc


def records(n, rng, size=800):
    return [warc.record_bytes(i, f"http://x/{i}", rng.randbytes(rng.randrange(size)), None) for i in range(n)]


def read(spark, tmp_path, data, width):
    """Ids of the records and the damaged stretches of one archive."""
    path = tmp_path / "a.warc.gz"
    path.write_bytes(data)
    files = spark.createDataFrame([(str(path), len(data))], "path string, n_bytes long")
    members = warc.read_members(files, width)
    rows = members.orderBy("start").collect()
    damaged = [(r.low, r.high) for r in warc.damaged_stretches(files, members).orderBy("low").collect()]
    return [r.page_id for r in rows], damaged


def member(text):
    return gzip.compress(text.replace("\n", "\r\n").encode())


@pytest.mark.parametrize("width", [3000, 1 << 20])
def test_a_damaged_record_costs_no_other(spark, tmp_path, width):
    parts = records(200, random.Random(1))
    begin = sum(map(len, parts[:100]))
    whole = b"".join(parts)
    assert read(spark, tmp_path, whole, width) == (list(range(200)), [])
    cut = whole[:-5]
    assert read(spark, tmp_path, cut, width) == (list(range(199)), [(len(whole) - len(parts[-1]), len(cut))])
    broken = bytearray(whole)
    middle = begin + len(parts[100]) // 2
    broken[middle : middle + 4] = bytes(b ^ 0x55 for b in broken[middle : middle + 4])
    ids = [i for i in range(200) if i != 100]
    assert read(spark, tmp_path, bytes(broken), width) == (ids, [(begin, begin + len(parts[100]))])
    wrong = warc.record_bytes(7, "u", b"payload", None)
    wrong = gzip.compress(gzip.decompress(wrong).replace(b"payload\r\n", b"pay1oad\r\n"))
    data = parts[0] + wrong + b"junk" + parts[1]
    end = len(parts[0])
    assert read(spark, tmp_path, data, width) == ([0, 1], [(end, end + len(wrong) + 4)])


def test_other_versions_and_folded_lines(spark, tmp_path):
    old = member("WARC/1.0\nWARC-Type: metadata\nX-Page-ID: 5\nWARC-Target-URI: http://a\n\tb\nContent-Length: 2\n\nhi\n\n")
    parts = records(2, random.Random(2))
    assert read(spark, tmp_path, parts[0] + old + parts[1], 1 << 20) == ([0, 5, 1], [])
    path = tmp_path / "a.warc.gz"
    files = spark.createDataFrame([(str(path), path.stat().st_size)], "path string, n_bytes long")
    rows = warc.read_archives(files).where("page_id = 5").collect()
    assert [(r.url, r.record_type, r.payload) for r in rows] == [("http://a b", "metadata", None)]
    assert read(spark, tmp_path, member("WARC/2.0\nContent-Length: 0\n\n\n\n"), 100)[0] == []


@pytest.mark.parametrize("width", [500, 4096, 1 << 20])
def test_records_within_a_record_are_not_read(spark, tmp_path, width):
    """Payloads that do not compress lie in the archive as they are, with all members they hold."""
    rng = random.Random(4)
    inner = b"".join(warc.record_bytes(900 + i, None, rng.randbytes(700), None) for i in range(12))
    parts = [warc.record_bytes(i, None, inner if i % 7 == 3 else rng.randbytes(900), None) for i in range(30)]
    assert read(spark, tmp_path, b"".join(parts), width) == (list(range(30)), [])
    broken = b"".join(parts)[:-9]
    assert read(spark, tmp_path, broken, width)[0] == list(range(29))


def test_time_is_in_proportion_to_the_records(tmp_path):
    data = warc.record_bytes(1, "http://x", b"page", None) * 40_000
    (tmp_path / "cut").write_bytes(data[:-5])
    seconds = []
    for n in (10_000, 40_000):
        size = len(data) // 40_000 * n - 5
        with open(tmp_path / "cut", "rb") as source:
            began = time.process_time()
            assert sum(1 for _ in warc.read_range(source, size, 0, size)) == n - (n == 40_000)
            seconds.append(time.process_time() - began)
    assert seconds[1] < 10 * seconds[0]
