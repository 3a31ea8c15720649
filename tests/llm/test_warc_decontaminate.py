import gzip
import hashlib
import random
import re
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from docketline.llm.common import scratch
from docketline.llm.decontaminate import SuffixAutomaton, decontaminate
from docketline.llm.warc import (_inflate, normalise, read_archives, read_index, split_records, warc_records,
                                 write_monolithic)
from tests.llm.util import HARD, frame, lower, prose


# ---- WARC
PAGES = ([(i, f"http://a/{i}", f"<p>{prose(i % 7, 40)}</p>") for i in range(60)]
         + [(100, None, None), (101, "u", ""), (102, "u\r\nX: y", "short"), (103, "u", "short"), (104, "u", "\r\n\r\nWARC/1.1\r\n" * 20),
            (None, "u", f"<p>{prose(1, 40)}</p>"), (None, "u", "only without an id " * 9), (None, "u", "only without an id " * 9),
            (0, "http://a/0", f"<p>{prose(0, 40)}</p>"), (105, "u", "é中" * 30_000), (106, "u", "é中" * 30_000)])


def brute_pages(rows):
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if h == html and p is not None] if len(raw) >= 100 else []
        first = min(same) if same else None
        again = first is not None and page != first
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [16 << 20, 0])
def test_archives_round_trip(spark, limit):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("value", F.lit("x")).repartition(3)
    folder = scratch(spark, "test-warc")
    write_monolithic(warc_records(pages, broadcast_bytes=limit), f"{folder}/crawl")
    assert normalise(spark, f"{folder}/crawl", f"{folder}/archives") == len(PAGES)
    rows = read_archives(spark, f"{folder}/archives", block_bytes=1000).drop("target_uri").collect()
    assert sorted(map(tuple, rows), key=repr) == brute_pages(PAGES)
    # every index row is one gzip member, and the members make up the file
    path = folder.replace("file:", "")
    for name, part in groupby(read_index(spark, f"{folder}/archives").orderBy("archive", "offset").collect(), lambda r: r.archive):
        raw, at = open(f"{path}/archives/{name}", "rb").read(), 0
        for r in part:
            assert r.offset == at
            record = zlib.decompress(raw[at:at + r.length], 31)
            assert len(record) == r.raw_length and record.endswith(b"\r\n\r\n") and b"X: y" not in record.split(b"\r\n")
            at += r.length
        assert at == len(raw)
    # a second run, as after a lost executor, leaves the same files; normalised archives can be normalised
    assert normalise(spark, f"{folder}/crawl", f"{folder}/archives") == len(PAGES)
    assert normalise(spark, f"{folder}/archives", f"{folder}/again", pattern="*.warc.gz") == len(PAGES)


def test_empty_archives(spark):
    folder = scratch(spark, "test-warc")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    write_monolithic(warc_records(pages), f"{folder}/crawl")
    assert normalise(spark, f"{folder}/crawl", f"{folder}/archives") == 0
    assert read_archives(spark, f"{folder}/archives").count() == 0


def test_truncated_streams_raise():
    record = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    blocks = [record[i:i + 3] for i in range(0, len(record), 3)]
    assert [r for r, _ in split_records(iter(blocks * 2))] == [record] * 2
    with pytest.raises(ValueError):
        list(split_records(iter([record[:-8]])))
    import io
    packed = gzip.compress(record)
    assert b"".join(_inflate(io.BytesIO(packed * 2))) == record * 2
    with pytest.raises(ValueError):
        list(_inflate(io.BytesIO(packed[:-4])))


# ---- decontamination
def item_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))


def brute_hits(docs, items, window):
    out = []
    for d, t in docs:
        w, hit, found = item_words(t), set(), set()
        for i, s in items:
            v = item_words(s)
            m = min(window, len(v))
            for a in range(len(v) - m + 1 if v else 0):
                for p in range(len(w) - m + 1):
                    if w[p:p + m] == v[a:a + m]:
                        hit |= set(range(p, p + m))
                        found.add("null" if i is None else str(i))
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [8 << 20, 300])
def test_hits(spark, block):
    rng = random.Random(3)
    items = [(i, prose(50 + i, rng.randint(10, 25), 60)) for i in range(8)]
    items += [(20, items[0][1]), (21, "Two, WORDS"), (22, "solo"), (23, None), (24, ""), (25, "..."), (None, prose(60, 12, 60)),
              (26, " ".join(items[1][1].split()[3:16])), (27, "a b a b a b a b a b a b a b")]
    docs = [x for x in HARD if x[0] != 7] + [(7, prose(7, 400, 60)), (40, "a b " * 30), (41, "x two words, solo. y")]
    for i in range(40):
        w = prose(900 + i, rng.randint(0, 50), 60).split()
        s = item_words(rng.choice(items)[1])
        a = rng.randint(0, 5)
        w[len(w) // 2:len(w) // 2] = s[a:a + rng.randint(5, 20)]
        docs.append((100 + i, " ".join(w)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate(frame(spark, docs, 4), bench, window=10, block_bytes=block).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, sorted(r["items"])) for r in got), key=repr) == brute_hits(docs, items, 10)
    for r in got:
        assert r.n_hit == sum(b - a for a, b in r.hit_spans)
        assert r.keep == (r.n_hit < 0.5 * r.n_words or r.n_hit == 0)
    texts = {(d, t or "") for d, t in docs}
    assert all((r.doc_id, r.text) in texts for r in got if not r.n_hit)
    assert all(len(item_words(r.text)) == r.n_words - r.n_hit for r in got if r.n_hit)


def test_no_items_or_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontaminate(frame(spark, HARD), none).collect()} == {0}
    assert decontaminate(frame(spark, []).limit(0), none).count() == 0


def test_automaton_tracks_longest_matches():
    rng = random.Random(8)
    for _ in range(40):
        items = [(str(k), [rng.randrange(3) for _ in range(rng.randint(1, 9))]) for k in range(5)]
        text = [rng.randrange(3) for _ in range(40)]
        spans, found = SuffixAutomaton(items, 4).scan(text)
        hit, names = set(), set()
        for k, w in items:
            m = min(4, len(w))
            for a in range(len(w) - m + 1):
                for p in range(len(text) - m + 1):
                    if text[p:p + m] == w[a:a + m]:
                        hit |= set(range(p, p + m))
                        names.add(int(k))
        assert {x for a, b in spans for x in range(a, b)} == hit and found == names
