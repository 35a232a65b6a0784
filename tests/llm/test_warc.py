import hashlib
import random

import pytest
from pyspark.sql import functions as F

from plantlake.llm.warc import HTTP, MAGIC, archived_pages, broken_files, read_archives, write_archives

SCHEMA = "page_id bigint, url string, html string, value string, digest string, id int, file int"


@pytest.fixture
def small_splits(llm):
    """Files are read in splits of a few KB, so that chains cross many of them."""
    names = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: llm.conf.get(k) for k in names}
    for k, v in names.items():
        llm.conf.set(k, v)
    yield llm
    for k, v in before.items():
        llm.conf.set(k, v)


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "v", "d", 1, 2) for r in rows], SCHEMA)


def record(body: str, kind="response") -> str:
    return f"{MAGIC}WARC-Type: {kind}\r\nX-Row-Id: 999\r\nContent-Type: text/html\r\nContent-Length: {len(body.encode())}\r\n\r\n{body}\r\n\r\n"


def brute(rows):
    groups, out = {}, []
    for r in rows:
        groups.setdefault(r[2] or "", []).append(r)
    for text, same in groups.items():
        same.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or ""))
        raw = text.encode()
        for k, r in enumerate(same):
            again = k > 0 and len(raw) >= 100
            out.append((r[0], len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", same[0][0] if again else None))
    return sorted(out, key=str)


def hostile(rng):
    """Payloads with the magic, whole records, records that claim what follows, and ends that look like ends of records."""
    body = "p" * 300
    inner = record(body)
    claims = f"{MAGIC}Content-Length: 700\r\n\r\nshort"
    texts = [
        inner, inner * 30, "x" + inner, inner[:-4], "\r\n\r\n" + inner, claims, claims * 20, MAGIC, MAGIC * 50, "\r\n\r\n" + MAGIC, "WARC/1.1", "\r\n", "\r\n\r\n" * 5,
        HTTP, HTTP + inner, record(inner) * 3, "é漢😀" * 60 + inner, f"{MAGIC}Content-Length: {10**17}\r\n\r\n", f"{MAGIC}Content-Length: x\r\n\r\n",
        inner + "z" * 9000 + inner, "\x00\x01" * 80 + MAGIC, "W" * 3000 + "WARC/1.1\r" + MAGIC,
    ]
    urls = ["http://a/WARC/1.1", "http://a/ b\r\nContent-Length: 3", None, "", "http://a/é"]
    return [(k, rng.choice(urls), t) for k, t in enumerate(texts)] + [(100 + k, rng.choice(urls), t) for k, t in enumerate(texts[:6])]


def plain(rng):
    letters = "abc <p>\n\ré"
    return [(1000 + k, f"http://h/{k}", "".join(rng.choices(letters, k=rng.randint(0, 900)))) for k in range(120)]


AWKWARD = [
    (None, None, None), (None, "u", "q" * 200), (None, "u", "q" * 200), (5000, "u", "q" * 200), (5000, "u", "q" * 200), (5000, None, "q" * 200), (4999, "u", "q" * 200),
    (6000, "u", "q" * 99), (6001, "u", "q" * 99), (6001, "u", "q" * 99), (6002, "u", "q" * 100), (6003, "u", "q" * 100), (6004, "u", ""), (6005, "u", None),
    (7000, "u", "long " * 60_000), (7001, "u", "long " * 60_000),
]


def test_archives_come_back_in_many_splits(small_splits):
    rng = random.Random(5)
    rows = plain(rng) + hostile(rng) + AWKWARD
    got = archived_pages(pages_of(small_splits, rows).repartition(3), compression="none")
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_archives_come_back_from_whole_files(llm):
    rng = random.Random(6)
    rows = plain(rng) + hostile(rng) + AWKWARD
    assert sorted(map(tuple, archived_pages(pages_of(llm, rows)).collect()), key=str) == brute(rows)


def test_one_file_of_many_splits_and_records_that_span_several(small_splits, tmp_path):
    rng = random.Random(7)
    rows = [(k, "u", record("b" * rng.randint(0, 200)) * rng.randint(0, 60)) for k in range(40)] + [(99, "u", "t" * 20_000 + MAGIC)]
    path = str(tmp_path / "one")
    small_splits.conf.set("spark.sql.files.maxPartitionBytes", "1000000")
    write_archives(pages_of(small_splits, rows), path + "/parts", compression="none")
    small_splits.read.option("lineSep", MAGIC).text(path + "/parts").filter("value <> ''").coalesce(1).select(
        F.concat(F.lit(MAGIC), "value").alias("value")
    ).write.option("lineSep", "#").text(path + "/joined")
    small_splits.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    # The joined text has a mark after each piece, which no chain survives; without the marks the records are whole again.
    [file] = (tmp_path / "one/joined").glob("*.txt")
    pieces = file.read_bytes().replace(b"#" + MAGIC.encode(), MAGIC.encode())
    (tmp_path / "whole.warc").write_bytes(pieces.removesuffix(b"#"))
    got = read_archives(small_splits, str(tmp_path / "whole.warc"))
    assert got.filter("not intact").count() == 0
    said = sorted((int(r.id), r.payload_bytes, r.payload_digest) for r in got.collect())
    assert [s[:1] + s[1:] for s in said if s[0] == 99] == [(99, 20_010, hashlib.sha256(rows[-1][2].encode()).hexdigest())]
    assert broken_files(small_splits, str(tmp_path / "whole.warc")).count() == 0


def test_a_chain_that_breaks_is_reported(small_splits, tmp_path):
    whole = "".join(record("b" * n) for n in (10, 5000, 20))
    (tmp_path / "a.warc").write_text(whole, newline="")
    (tmp_path / "b.warc").write_text(whole.replace("Content-Length: 5000", "Content-Length: 4000"), newline="")
    (tmp_path / "c.warc").write_text("junk" + whole, newline="")
    broken = {r.file.rsplit("/", 1)[1]: r.pos for r in broken_files(small_splits, str(tmp_path)).collect()}
    first = len(record("b" * 10))
    assert broken == {"b.warc": first + len(record("b" * 5000)) - 1000, "c.warc": 0}
    read = {(r.file.rsplit("/", 1)[1], r.payload_bytes) for r in read_archives(small_splits, str(tmp_path)).collect()}
    assert read == {("a.warc", 10), ("a.warc", 5000), ("a.warc", 20), ("b.warc", 10), ("b.warc", 4000)}


def test_empty_table(llm):
    assert archived_pages(pages_of(llm, [])).collect() == []


def test_equal_payloads_are_stored_once(llm, tmp_path):
    rows = [(k, "u", "same " * 2000) for k in range(200)]
    write_archives(pages_of(llm, rows), str(tmp_path / "w"), compression="none")
    stored = sum(f.stat().st_size for f in (tmp_path / "w").glob("*.txt"))
    assert stored < 2 * 10_000 + 200 * 700
    assert read_archives(llm, str(tmp_path / "w")).filter("record_type = 'response'").count() == 1
