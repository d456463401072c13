import base64
import collections
import gzip
import hashlib

import pytest
from pyarrow import fs

from corpuscope.llm import warc
from corpuscope.session import scratch_path

from . import cases

SCHEMA = "page_id long, url string, html string, page string, sha string, first string"


def pages():
    rows = [(i, f"http://a.example/{i % 7}?q={i} x", t) for i, (_, t) in enumerate(cases.corpus(n=30))]
    rows += [(900 + i, None, "same page\r\n\r\nwith breaks") for i in range(40)]
    # An id-less copy, and the response's own row several times.
    rows += [(None, "http://n.example", "same page\r\n\r\nwith breaks")] + [rows[-40]] * 3
    rows += [(None, None, "twice without id")] * 2
    return rows + [(None, "http://null.example", "no id"), (990, "http://b\r\n.example", None)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("least", [0, 50])
def test_round_trip(spark, least):
    rows = pages()
    groups = collections.defaultdict(list)
    for p, _, h in rows:
        groups[(h or "").encode()].append(p)
    want, responded = [], set()
    for p, _, h in rows:
        data = (h or "").encode()
        first = min(groups[data], key=lambda x: (x is None, x or 0))
        again = len(data) >= least and (p != first or data in responded)
        if p == first:
            responded.add(data)
        want.append((str(p), len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                     "revisit" if again else "response", str(first) if again else "None"))
    got = warc.report(frame(spark, rows), least).collect()
    assert sorted((str(r[0]), r[1], r[2], r[3], str(r[4])) for r in got) == sorted(want)


def test_index_and_ranges(spark, monkeypatch):
    rows = pages()
    folder = scratch_path(spark, "warc-test")
    index = warc.write(frame(spark, rows), folder)
    system, path = fs.FileSystem.from_uri(folder)
    for r in index.collect():
        with system.open_input_file(f"{path}/{r.file}") as file:
            data = gzip.decompress(file.read_at(r.length, r.offset))
        fields, _, payload = warc.parsed(data)
        assert fields["WARC-Payload-Digest"] == f"sha1:{r.digest}" and fields["WARC-Type"] == r.type
        assert "\n" not in fields["WARC-Target-URI"]
    by_page = {p: (h or "").encode() for p, _, h in rows}
    chosen = index.where("page % 3 = 0 AND type = 'response'")
    want = {r.page: by_page[r.page] for r in chosen.collect()}
    for gap, size in ((0, 1), (1 << 20, 1 << 20), (100, 2000)):
        monkeypatch.setattr(warc, "GAP", gap)
        monkeypatch.setattr(warc, "RANGE", size)
        assert {r.page: bytes(r.payload) for r in warc.read(chosen, folder).collect()} == want


def test_empty_table(spark):
    assert warc.report(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
