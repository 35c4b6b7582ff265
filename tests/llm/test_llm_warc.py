import hashlib
import os
import sys

import pytest
import zstandard

sys.path.insert(0, os.path.dirname(__file__))
from helpers import ODD  # noqa: E402

from tidewater.llm import warc  # noqa: E402
from tidewater.session import scratch_path  # noqa: E402


def test_round_trip(spark):
    big, other = "<p>é</p>" * 40, "y" * 99
    rows = [(5, "http://a/ x", big), (3, "http://b/", big), (9, None, big), (4, "u", other), (6, "u", other), (3, "http://b/", big), (None, "n", big)]
    rows += [(100 + k, f"http://o/{k}\r\nX: y", t) for k, t in enumerate(ODD)] + [(200, "l", "z" * 5_000_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    path = scratch_path(spark, "warc-test")
    warc.write_archive(df, path, bundle_bytes_=3000)
    got = warc.read_archive(spark, path).collect()
    assert len(got) == len(rows)
    found = {r.record_id: r for r in got}
    for key, _, html in rows:
        data, r = (html or "").encode(), found[f"urn:page:{'null' if key is None else key}"]
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        again = html == big and key != 3
        assert (r.record_type, r.refers_to) == (("revisit", "urn:page:3") if again else ("response", None))
        assert r.payload == (None if again else data)


def test_index_points_into_frames(spark):
    df = spark.createDataFrame([(k, "u", f"{k} " * 3000) for k in range(60)], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-test")
    warc.write_archive(df, path)
    files = {r.path: bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect()}
    entries = warc.record_index(spark, path).collect()
    assert len(entries) == 60 and len({e.frame for e in entries}) > 1
    for e in entries:
        bundle = warc.Bundle(files[e.path])
        fields, payload = warc.parse_record(bundle.frame(e.frame)[e.offset:e.offset + e.length])
        assert fields["warc-record-id"] == f"<{e.record_id}>"
        assert payload == f"{e.record_id.rpartition(':')[2]} ".encode() * 3000
    whole = b"".join(zstandard.ZstdDecompressor().stream_reader(c, read_across_frames=True).read() for c in files.values())
    assert whole.count(b"WARC/1.1\r\n") == 60


def test_damage_and_empty(spark):
    with pytest.raises(ValueError):
        warc.Bundle(b"no table at all, surely not")
    path = scratch_path(spark, "warc-test")
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archive(empty, path)
    assert warc.revisits(empty).count() == 0
