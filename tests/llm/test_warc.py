import base64
import hashlib
import random
from collections import defaultdict

import pytest

from histdim.llm import warc

FAKE = ("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:666>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")
BODIES = ["", "plain", FAKE, "\n" + FAKE, "x\r\n\r\n" + FAKE + FAKE, "\r\n\r\n" + FAKE + "WARC/1.1\r\n", "a\r\n\r\nWARC/1.1",
          "a\nWARC/1.1\r\nWARC/1.1\r\n", "\r\n\r\nWARC/1.1\r\nContent-Length: 99999999\r\n\r\n", "plain", "été 😀\r\n\r\n",
          "\r\n", "\n", "WARC/1.1\r\n", "z" * 5000 + "\r\n\r\n" + FAKE * 40 + "end", "q" * 20000]


def want(rows, min_bytes=0):
    first = defaultdict(list)
    for i, _, body in rows:
        if i is not None:
            first[body or ""].append(i)
    out = []
    for i, _, body in rows:
        data = (body or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        least = min(first[body or ""], default=None)
        again = len(data) >= min_bytes and least is not None and i != least
        out.append((None if i is None else str(i), len(data), digest, "revisit" if again else "response", str(least) if again else None))
    return sorted(out, key=str)


def round_trip(spark, rows, path, parts=2, **options):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(parts)
    warc.write(pages, path, **options)
    got = warc.read(spark, path).collect()
    return sorted([(r.record_id or None, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str)


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: [spark.conf.set(k, str(n)) for k in old]
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("split", [100_000_000, 3000, 257])
def test_round_trip_with_hostile_payloads(spark, scratch, small_splits, split):
    rnd = random.Random(split)
    rows = [(k, f"http://h/{k} x", body) for k, body in enumerate(BODIES * 2)]
    rows += [(100 + k, "u", "".join(rnd.choice(["WARC/1.1\r\n", "\r\n", "\n", "a", FAKE]) for _ in range(rnd.randrange(9))))
             for k in range(40)]
    rows.append((300, "u\r\nWARC/1.1\r\n", None))
    small_splits(split)
    assert round_trip(spark, rows, scratch + "/w") == want(rows)


def test_sizes_below_the_least_are_never_revisits(spark, scratch):
    rows = [(k, "u", "aa" if k % 2 else "long enough") for k in range(8)]
    assert round_trip(spark, rows, scratch + "/w", min_bytes=5) == want(rows, 5)


def test_shuffled_groups_agree(spark, scratch, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_GROUPS", 0)
    rows = [(k, "u", f"body {k % 5}") for k in range(40)]
    assert round_trip(spark, rows, scratch + "/w") == want(rows)


def test_nulls_ties_and_empty_table(spark, scratch):
    rows = [(1, None, None), (1, None, None), (None, "u", "x"), (2, "u", "x"), (None, "u", "only null"), (3, "", "")]
    assert round_trip(spark, rows, scratch + "/w") == want(rows)
    assert round_trip(spark, [], scratch + "/e") == []


def test_a_cut_off_record_ends_the_chain(spark, scratch):
    import glob
    rows = [(k, "u", f"body {k}" * 9) for k in range(6)]
    round_trip(spark, rows, scratch + "/w", parts=1)
    data = b"".join(open(f, "rb").read() for f in sorted(glob.glob(scratch + "/w/part-*")))
    import os
    os.makedirs(scratch + "/c")
    with open(scratch + "/c/one.warc", "wb") as f:
        f.write(data[:-20])
    with open(scratch + "/c/two.warc", "wb") as f:
        f.write(b"junk" + data)
    open(scratch + "/c/three.warc", "wb").close()
    assert warc.read(spark, scratch + "/c").count() == 5
