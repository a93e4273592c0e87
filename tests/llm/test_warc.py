import base64
import hashlib

import pytest

from weftline.llm import warc
from weftline.llm.files import at

ROWS = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, None, None), (4, "http://a/\n4", ""), (5, "u", "é" * 3), (6, "u", "<p>x</p>"), (6, "u", "<p>x</p>"), (7, "v", "only"), (7, "v", "only"), (None, "n", "only"), (None, "n", "alone"), (8, "w", "a\r\n\r\nb")]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, record_type string, kind int").repartition(4)


def brute(rows):
    out, first = [], {}
    for i, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        revisit = data in first
        original = first.setdefault(data, i)
        out.append((i, len(data), digest, "revisit" if revisit else "response", original if revisit else None))
    return sorted(out, key=str)


def read(spark, rows, **options):
    folder = warc.folder_for(pages(spark))
    return warc.read(warc.write(pages(spark, rows), folder, **options), folder, with_payload=True)


def test_against_brute_force(spark):
    got = read(spark, ROWS).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS)


def test_payloads_come_back(spark):
    got = {bytes(r.payload).decode() for r in read(spark, ROWS).where("record_type = 'response'").collect()}
    assert got == {h or "" for _, _, h in ROWS}


def test_rolls_and_is_deterministic(spark):
    rows = [(k, f"http://x/{k}", f"<p>{hashlib.sha256(str(k).encode()).hexdigest() * 20}</p>") for k in range(300)]
    contents = []
    for _ in range(2):
        folder = warc.folder_for(pages(spark))
        manifest = warc.write(pages(spark, rows), folder, roll_bytes=4000)
        files = sorted(r.file for r in manifest.collect())
        fs, path = at(folder)
        contents.append({f: fs.open_input_file(f"{path}/{f}").read() for f in files})
        assert manifest.agg({"n_records": "sum"}).first()[0] == 300 and len(files) > 8
        assert warc.read(manifest, folder).count() == 300
    assert contents[0] == contents[1]


def test_headers(spark):
    folder = warc.folder_for(pages(spark))
    manifest = warc.write(pages(spark), folder)
    fs, path = at(folder)
    seen = []
    for r in manifest.collect():
        with fs.open_input_stream(f"{path}/{r.file}", compression=None) as s:
            for m in warc._members(s):
                headers, block = warc.parse(m)
                assert m.startswith(b"WARC/1.1\r\n") and m.endswith(b"\r\n\r\n") and headers["WARC-Block-Digest"] == "sha1:" + warc.base32_sha1(block)
                seen.append(headers)
    ids = [h["WARC-Record-ID"] for h in seen]
    assert len(set(ids)) == len(ids)
    by_id = {h["WARC-Record-ID"]: h for h in seen}
    for h in seen:
        if h["WARC-Type"] == "revisit":
            assert by_id[h["WARC-Refers-To"]]["WARC-Type"] == "response" and by_id[h["WARC-Refers-To"]]["WARC-Payload-Digest"] == h["WARC-Payload-Digest"]


def test_empty(spark):
    folder = warc.folder_for(pages(spark))
    manifest = warc.write(pages(spark).limit(0), folder)
    assert manifest.count() == 0 and warc.read(manifest, folder).count() == 0


def test_small_payloads_stay_whole(spark):
    got = read(spark, ROWS, min_bytes=6)
    assert {r.record_type for r in got.where("payload_bytes < 6").collect()} == {"response"}


def test_manifest_lies_in_the_folder_and_files_are_held_against_it(spark):
    folder = warc.folder_for(pages(spark))
    written = warc.write(pages(spark), folder)
    again = warc.manifest_of(spark, folder)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, written.collect()))
    assert warc.read(again, folder).count() == len(ROWS)
    fs, path = at(folder)
    name = again.first().file
    data = fs.open_input_file(f"{path}/{name}").read()
    last = max(k for k in range(len(data)) if data[k : k + 3] == b"\x1f\x8b\x08")
    for broken in (data[:last], data[:-4], data + data[last:]):
        with fs.open_output_stream(f"{path}/{name}", compression=None) as out:
            out.write(broken)
        with pytest.raises(Exception, match="not those of the manifest"):
            warc.read(again, folder).collect()
