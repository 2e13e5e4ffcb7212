"""WARC writer and splittable reader: round trips and planted difficulties."""

import glob
import gzip
import hashlib
import io
import random

import pytest

from churnlens.llm.store import folder
from churnlens.llm.warc import members, read_archives, record, round_trip, write_archives

SCHEMA = "page_id long, url string, html string, digest string, payload long"


def expected(rows):
    best = {}
    for page_id, _, html in rows:
        p = (html or "").encode()
        if len(p) >= 1000 and page_id is not None:
            best[p] = max(best.get(p, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        p = (html or "").encode()
        to = best.get(p) if page_id is not None and best.get(p, page_id) != page_id else None
        out.append((page_id, len(p), hashlib.sha1(p).hexdigest(), "revisit" if to is not None else "response", to))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    return sorted(map(tuple, round_trip(df, folder(spark, "warc")).collect()), key=str)


@pytest.fixture(scope="module")
def pages():
    rnd = random.Random(2)
    texts = ["<p>" + "".join(rnd.choice("abcdéß \r\n") for _ in range(n)) for n in (0, 10, 990, 1200, 5000)]
    rows = [(i, f"http://x/{i}", rnd.choice(texts)) for i in range(300)]
    rows += [(1000 + i, "u", "y" * 996 + "é") for i in range(3)]   # 998 bytes: never revisited
    rows += [(2000 + i, "u", "y" * 998 + "é") for i in range(3)]   # exactly 1000 bytes
    rows += [(5, None, None), (6, "a\r\nb", ""), (None, "n", "z" * 2000), (7, "n", "z" * 2000), (7, "n", "z" * 2000),
             (3, "n", "z" * 2000), (9, "big", "".join(rnd.choice("ab<>é") for _ in range(400_000))),
             (10, "crlf", "WARC/1.0\r\n\r\n" * 200)]
    return rows


def test_round_trip(spark, pages):
    assert run(spark, pages) == expected(pages)


def test_empty(spark):
    assert run(spark, []) == []


def test_ranges_own_each_record_once(spark, pages):
    path = folder(spark, "warc")
    df = spark.createDataFrame([(*r, "c", 1) for r in pages], SCHEMA)
    write_archives(df, path)
    whole = sorted((r.page_id, r.offset, r.archive) if r.page_id is not None else (-1, r.offset, r.archive)
                   for r in read_archives(spark, path).collect())
    tiny = sorted((r.page_id, r.offset, r.archive) if r.page_id is not None else (-1, r.offset, r.archive)
                  for r in read_archives(spark, path, split_bytes=777).collect())
    assert whole == tiny and len(whole) == len(pages)
    # any gzip reader accepts the archives
    for name in glob.glob(path.removeprefix("file:") + "/part-*"):
        with gzip.open(name) as f:
            assert f.read().count(b"WARC-Type") >= 0


def test_false_magic_and_damage():
    inner = gzip.compress(b"not a record")
    noise = [b"\x1f\x8b\x08", b"\x1f\x8b\x08\x00garbage", inner, b"\x1f\x8b", b"\x00" * 7]
    good = [record(i, "u", bytes([i]) * (i * 50), "d", None) for i in range(1, 9)]
    data, starts = b"", []
    for i, member in enumerate(good):
        data += noise[i % len(noise)]
        starts.append(len(data))
        data += member
    for split in (1, 13, 64, len(data)):
        for chunk in (7, 1 << 20):
            got = [at for s in range(0, len(data), split)
                   for at, _ in members(io.BytesIO(data), len(data), s, min(s + split, len(data)), chunk)]
            assert got == starts
    with pytest.raises(EOFError):
        list(members(io.BytesIO(good[3][:-4]), len(good[3]) - 4, 0, len(good[3])))
