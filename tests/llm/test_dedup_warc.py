"""Exact dedup and WARC archives against brute force, with edge cases and forced recursion."""
import glob
import gzip
import hashlib
import random
import zlib

import pytest
from conftest import SF_SMALL

from tidewatch.llm import exact_dedup, warc

from .conftest import EDGE


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute_dedup(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    out = []
    for i, t in rows:
        g = groups[lower(t)]
        keep = max((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("table_bytes", [exact_dedup.TABLE_BYTES, 2000])
def test_decisions(spark, docs_of, table_bytes):
    got = exact_dedup.decisions(docs_of(EDGE), table_bytes=table_bytes).collect()
    assert sorted(map(tuple, got), key=str) == brute_dedup(EDGE)


def test_recursion_and_hot_group(spark, docs_of):
    random.seed(1)
    rows = [(i, "hot text " * 20 if i % 3 == 0 else random.choice("abAB") * (i % 97) + str(i % 50)) for i in range(900)]
    df = docs_of(rows).repartition(7)
    got = exact_dedup.decisions(df, table_bytes=4000).collect()
    assert sorted(map(tuple, got), key=str) == brute_dedup(rows)
    kept = exact_dedup.deduplicate(df, table_bytes=4000)
    assert kept.columns == df.columns
    want = {}
    for i, t in rows:
        want[lower(t)] = (i, t)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(want.values())


def test_deduplicate_edges(spark, docs_of):
    kept = exact_dedup.deduplicate(docs_of(EDGE)).collect()
    by_text = {}
    for r in kept:
        by_text.setdefault(lower(r.text), []).append(r.doc_id)
    assert all(len(v) == 1 for v in by_text.values())
    assert by_text[lower(EDGE[3][1])] == [6] and by_text[""] == [2]
    assert all(r.row == 7 and r.hits == 7 for r in kept)


def test_empty(spark, docs_of):
    assert exact_dedup.decisions(docs_of([])).collect() == []
    assert exact_dedup.deduplicate(docs_of([])).collect() == []


PAGES = "page_id long, url string, html string, page int, digest int, payload int"
LONG = "<html>" + "x" * 100 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"


def brute_warc(rows):
    first = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if len(p) >= 100:
            k = hashlib.sha256(p).hexdigest()
            best = first.get(k, "none")
            first[k] = i if best == "none" or best is None or i is not None and i < best else best
    taken, out = set(), []
    for i, _, h in rows:
        p = (h or "").encode()
        k = hashlib.sha256(p).hexdigest()
        if len(p) < 100 or (i == first[k] and k not in taken):
            taken.add(k)
            out.append((i, len(p), k, "response", None))
        else:
            out.append((i, len(p), k, "revisit", first[k]))
    return sorted(out, key=str)


def test_warc_round_trip(spark):
    rows = [(1, "http://a/", None), (2, None, ""), (3, "http://b/\r\nX: y", LONG), (4, "http://c/", LONG), (4, "http://c/", LONG), (5, "http://d/", "short"),
            (6, "http://e/", "short"), (None, "http://f/", LONG), (7, "u", "é" * 60), (8, "u", "é" * 60), (9, "u", "y" * 300000), (10, "u", "\r\n" * 80), (3, "http://b/", LONG)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], PAGES).repartition(3)
    got = warc.round_trip(df, records_per_file=2)
    assert sorted(map(tuple, got.select("page", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str) == brute_warc(rows)


def members(content):
    """The gzip members of a file, each inflated by itself."""
    out = []
    while content:
        step = zlib.decompressobj(31)
        out.append(step.decompress(content))
        assert step.eof
        content = step.unused_data
    return out


def test_warc_files(spark, tmp_path):
    """A member per record after a warcinfo, files bounded in bytes and records, distinct record ids."""
    random.seed(3)
    noise = lambda n: "".join(random.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=n))
    rows = [(i, f"http://a/{i}", noise(4000), 1, 2, 3) for i in range(60)]
    rows += [(5, "u", "small", 1, 2, 3), (5, "u", "small", 1, 2, 3), (5, "u", "tiny", 1, 2, 3), (5, "u", noise(300), 1, 2, 3), (90, "u", rows[7][2], 1, 2, 3)]
    rows.append((91, "big", noise(1000) * 18000, 1, 2, 3))   # 18 MB: its member does not end with a zero byte
    path = str(tmp_path / "out")
    got = warc.round_trip(spark.createDataFrame(rows, PAGES).coalesce(1), path=path, file_bytes=30000)
    assert sorted(map(tuple, got.select("page", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str) == brute_warc([r[:3] for r in rows])
    ids, files = [], glob.glob(f"{path}/*/part-*")
    for name in files:
        with open(name, "rb") as f:
            content = f.read()
        if not content:   # Spark's file of an empty first partition
            continue
        first, *rest = members(content)
        rest = [m for m in rest if m]
        assert first.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and rest
        assert len(content) < 30000 + 2800 + 400 or len(rest) == 1 or b"Target-URI: big" in rest[-1]
        for m in rest:
            (head, block), = warc._parse(m)
            assert block.startswith(b"HTTP/1.1 200 OK\r\n")
            ids.append(head["warc-record-id"])
    assert len(files) > 4 and len(ids) == len(set(ids)) == len(rows)


def test_warc_of_other_writers():
    """Plain files, several records in a member, blocks that are no HTTP message."""
    one = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Type: text/html\r\nContent-Length: 9\r\n\r\nab\r\n\r\ncde\r\n\r\n"
    for content in (one * 3000, gzip.compress(one * 3000), gzip.compress(one) * 3000, gzip.compress(one * 2) + gzip.compress(b"") + gzip.compress(one * 2998)):
        got = list(warc._parse(content))
        assert len(got) == 3000 and {warc._payload(*r) for r in got} == {b"ab\r\n\r\ncde"}
    with pytest.raises(ValueError):
        list(warc._parse(one[:-8]))


def test_warc_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).collect() == []


def test_warc_table(spark, tmp_path):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    path = str(tmp_path / "out")
    warc.archive(pages, path)
    back = warc.read_records(spark, f"{path}/responses", with_payload=True)
    stored = {r.page: r.payload for r in back.collect()}
    given = {r.page_id: r.html for r in pages.collect()}
    assert stored and all(given[i] == p for i, p in stored.items())
    with pytest.raises(FileExistsError):
        warc.round_trip(pages, path=path)
