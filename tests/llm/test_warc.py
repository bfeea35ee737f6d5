import gzip
import os

import pytest

from pitwall.llm import warc

PAGES = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, None, "same"), (4, "http://a/\r\n4", "other é"), (5, "http://a/5", None),
         (6, "http://a/6", ""), (7, "u", "x" * 5000), (7, "u", "x" * 5000), (9, "w", "a\r\n\r\nWARC/1.1\r\n\r\n"), (None, "n", "alone"), (-3, "m", "same"),
         (8, "v", "x" * 5000)]


def want(pages, min_bytes=0):
    best = {}
    for i, _, h in pages:
        best[h or ""] = max(best.get(h or "", -(1 << 62)), i if i is not None else -(1 << 62))
    out, seen = [], set()
    for i, _, h in pages:
        data = (h or "").encode()
        first = best[h or ""] == (i if i is not None else -(1 << 62)) and (i, h or "") not in seen
        seen.add((i, h or ""))
        if first or len(data) < min_bytes:
            out.append((i, len(data), warc.digest(data), "response", None))
        else:
            out.append((i, len(data), warc.digest(data), "revisit", best[h or ""]))
    return sorted(out, key=str)


def frame(spark, pages):
    return spark.createDataFrame([(*p, "zzz") for p in pages], "page_id long, url string, html string, sum string").repartition(3)


@pytest.mark.parametrize("min_bytes,roll", [(0, 64 << 20), (5, 200)])
def test_round_trip(spark, tmp_dir, min_bytes, roll):
    folder = f"file://{tmp_dir}/warc"
    manifest = warc.write_warc(frame(spark, PAGES), folder, min_bytes=min_bytes, roll_bytes=roll, range_bytes=4000)
    rows = warc.read_warc(spark, folder).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)
    assert got == want(PAGES, min_bytes)
    bodies = {(i, h or "") for i, _, h in PAGES}
    assert all((r.page_id, bytes(r.payload).decode()) in bodies for r in rows if r.record_type == "response")
    files = sorted(f for f in os.listdir(f"{tmp_dir}/warc") if f.endswith(".warc.gz"))
    assert files == sorted(r.file for r in manifest.collect()) and (roll > 1000 or len(files) > 3)
    assert not [f for f in os.listdir(f"{tmp_dir}/warc") if f.startswith(".tmp")]
    assert gzip.open(f"{tmp_dir}/warc/{files[0]}").read().startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_reruns_make_the_same_files(spark, tmp_dir):
    sums = []
    for k, n in enumerate((2, 5)):
        m = warc.write_warc(frame(spark, PAGES).repartition(n), f"file://{tmp_dir}/{k}", roll_bytes=200, range_bytes=4000)
        sums.append(sorted(tuple(r) for r in m.collect()))
    assert sums[0] == sums[1]


def test_files_that_the_manifest_lacks_do_not_exist(spark, tmp_dir):
    folder = f"file://{tmp_dir}/w"
    warc.write_warc(frame(spark, PAGES[:3]), folder)
    with open(f"{tmp_dir}/w/pages-lost-00000.warc.gz", "wb") as f:
        f.write(b"half a file")
    assert warc.read_warc(spark, folder).count() == 3


def test_empty_table(spark, tmp_dir):
    folder = f"file://{tmp_dir}/e"
    warc.write_warc(frame(spark, PAGES[:1]).where("false"), folder)
    assert warc.read_warc(spark, folder).collect() == []


def test_revisits_name_the_record_of_their_payload(spark, tmp_dir):
    """A page with several payloads has numbered records."""
    pages = [(5, "u", "aaa"), (5, "u", "bbb"), (5, "u", "bbb"), (1, "v", "aaa"), (2, "w", "bbb"), (3, "x", "ccc"), (5, "u", "ccc")]
    folder = f"{tmp_dir}/w"
    manifest = warc.write_warc(frame(spark, pages), f"file://{folder}")
    digests, refers = {}, []
    for row in manifest.collect():
        with open(f"{folder}/{row.file}", "rb") as f:
            for data in warc.members(f):
                fields, _ = warc.parsed(data)
                if fields["WARC-Type"] == "response":
                    digests[fields["WARC-Record-ID"]] = fields["WARC-Payload-Digest"]
                elif fields["WARC-Type"] == "revisit":
                    refers.append((fields["WARC-Refers-To"], fields["WARC-Payload-Digest"]))
    assert len(refers) == 4 and all(digests[r] == d for r, d in refers)


def test_read_back_in_many_tasks(spark, tmp_dir):
    pages = [(k, "u", f"{k} " * 300) for k in range(300)]
    warc.write_warc(frame(spark, pages), f"file://{tmp_dir}/m", roll_bytes=100, range_bytes=4000)
    from pyspark.sql import functions as F
    read = warc.read_warc(spark, f"file://{tmp_dir}/m")
    assert read.groupBy(F.spark_partition_id()).count().count() > 20
